"""Decisions on records, evidence, recoveries, readers of documents: small cases with known results."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.operators import changes, evidence, intervals, media, recovery, speakers, transitions, vectors, views
from turnweave.plans.catalogue import QUERIES
from turnweave.sources import interchange


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


WORDS = "source string, word long, text string, w_start double, w_end double"
REGIONS = "source string, region_id string, r_start double, r_end double, label string, heard string"


def words(spark, *texts, step=1.0, length=0.8):
    return frame(spark, [("s", i, t, i * step, i * step + length) for i, t in enumerate(texts)], WORDS)


def test_sentence_utterances(spark):
    texts = frame(spark, [("a", "The sea-green boat ran. He fell! Oh"), ("b", "One two."), ("c", "Half a word.ly said.")], "source string, text string")
    told = [("a", i, t) for i, t in enumerate(["The", "seagreen", "boat", "ran.", "—", "He", "fell!", "Oh", "—"])] + [("b", 0, "one"), ("b", 1, "three")]
    told += [("c", i, t) for i, t in enumerate(["Half", "a", "word.ly", "said."])]
    found, problems = evidence.sentence_utterances(texts, frame(spark, told, "source string, word long, text string"))
    got = sorted((r.source, r.word_start, r.word_end, r.text) for r in found.collect())
    assert got == [("a", 0, 5, "The sea-green boat ran."), ("a", 5, 7, "He fell!"), ("a", 7, 9, "Oh"), ("c", 0, 4, "Half a word.ly said.")]
    assert [(r.source, r.problem) for r in problems.collect()] == [("b", "texts differ")]


def test_derived_utterances_of_all_conversations(spark, sf_dir):
    sentence = re.compile(r".+?(?:[.!?]+(?=\s|$)|$)", re.S)
    letters = lambda t: "".join(w.lower().replace("ß", "ss") for w in re.findall(r"\w+(?:['’]\w+)*", t))
    talk = {}
    for r in sorted(spark.read.parquet(f"{sf_dir}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        talk.setdefault(r.conv_id, []).extend((r.text or "").split())
    want = []
    for source, said in talk.items():
        at, reach = 0, 0
        parts = [x.strip() for x in sentence.findall(" ".join(said)) if letters(x)]
        total, seen = 0, []
        for part in parts:
            total += len(letters(part))
            while reach < total:
                reach += len(letters(said[at]))
                at += 1
            while at < len(said) and not letters(said[at]):
                at += 1
            seen.append((part, at))
        want += [(source, part, 0 if k == 0 else seen[k - 1][1], end if k + 1 < len(seen) else len(said)) for k, (part, end) in enumerate(seen)]
    assert sorted(map(tuple, QUERIES["derived_utterances"](spark, sf_dir).collect())) == sorted(want)


def test_fragment_resolver_against_a_plain_fold(spark):
    rng = random.Random(5)
    rows = [(k % 3, k, rng.choice([None, None, None, "x", "y"]), rng.choice([None, [], ["x"], ["x", "y"], ["y", "z"]])) for k in range(300)]
    got = {(r.s, r.i): (r.resolved, r.step) for r in speakers.resolve_fragments(frame(spark, rows, "s int, i int, sp string, c array<string>"), ["s"], "i", "sp", "c").collect()}
    for s in range(3):
        mine = [r for r in rows if r[0] == s]
        now = [r[2] for r in mine]
        for k, (_, i, given, among) in enumerate(mine):
            step = None
            if given is None and among:
                left = now[k - 1] if k and now[k - 1] in among else None
                right = mine[k + 1][2] if k + 1 < len(mine) and mine[k + 1][2] in among else None
                if {left, right} - {None} and len({left, right} - {None}) == 1:
                    now[k], step = left or right, "consistent" if left and right else "left" if left else "right"
            assert got[(s, i)] == (now[k], step)


def test_sentences_against_python(spark, sf_dir):
    sentence = re.compile(r".+?(?:[.!?]+(?=\s|$)|$)", re.S)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["sentences"](spark, sf_dir).collect():
        assert (r.n_sentences, r.complete) == (len(sentence.findall(docs[r.doc_id])), bool(re.search(r"[.!?]$", docs[r.doc_id].rstrip(" ")))), r.doc_id


def test_word_spans_and_boundaries(spark):
    df = frame(spark, [([("Hi",), ("there.",), ("Bye",)], ["Hi there. ", "Bye"]), ([("a",)], ["b c"])], "w array<struct<text:string>>, s array<string>")
    got = df.select(T.joined_words(F.col("w")).alias("j"), "s").select("j", T.segment_ends(F.col("s")).alias("e"), T.boundary_words(F.col("j.spans"), F.col("s")).alias("b")).collect()
    assert got[0].j.text == "Hi there. Bye" and [(x.start, x.end) for x in got[0].j.spans] == [(0, 2), (3, 9), (10, 13)]
    assert (got[0].e, got[0].b) == ([9, 13], [1, 2]) and got[1].b == [None]


def test_edge_suggestions(spark):
    schema = "source string, candidate int, start double, end double, text string, issues array<int>"
    cands = [("s", 1, 0.0, 2.0, "we talk abou", []), ("s", 2, 10.0, 12.0, "big house", []), ("s", 3, 20.0, 24.0, "red car", []), ("s", 4, 0.0, 2.0, "we talk abou", [3]), ("s", 5, 30.0, 31.0, "fine day", [])]
    regions = [("s", "e", 0.5, 3.0, "x", "We talk about"), ("s", "o", 9.0, 12.0, "x", "the big house"), ("s", "a", 19.0, 21.0, "y", "nothing here"), ("s", "l", 21.5, 26.0, "x", "Red car went"), ("s", "p", 29.0, 31.0, "x", "Over. fine day")]
    got = {r.candidate: (r.method, r.edge, r.time, r.region_id, r.conflicting_region_id) for r in evidence.edge_suggestions(frame(spark, cands, schema), frame(spark, regions, REGIONS), 10).collect()}
    assert got == {1: ("end_extension", "end", 3.0, "e", None), 2: ("start_extension", "start", 9.0, "o", None), 3: ("start_conflict", "start", 21.5, "l", "a")}


def test_split_of_words_and_places(spark):
    halves = frame(spark, [("s", "t", "left", 0.0, 2.5, 2.5), ("s", "t", "right", 2.5, 5.0, 2.5)], "source string, turn string, side string, start double, end double, cut double")
    told = frame(spark, [("s", 0, "a", 0.0, 1.0), ("s", 1, "b", 2.0, 2.9), ("s", 2, "c", 2.2, 3.4), ("s", 3, "d", 4.0, 4.5)], WORDS)
    assert {(r.side, r.word) for r in evidence.split_words(halves, told, "turn", 5).collect()} == {("left", 0), ("left", 1), ("right", 2), ("right", 3)}
    regions = [("s", "r1", 0.0, 1.0, "x", None), ("s", "r2", 1.0, 1.1, "y", None), ("s", "r3", 1.1, 2.0, "y", None), ("s", "r4", 2.0, 3.0, None, None), ("s", "r5", 3.0, 4.0, "y", None)]
    turns = frame(spark, [("s", "t", ["r1", "r2", "r3", "r4", "r5"])], "source string, turn_id string, source_regions array<string>")
    assert [(r.after_region_id, r.time) for r in evidence.split_candidates(frame(spark, regions, REGIONS), turns, 5).collect()] == [("r2", 1.1)]
    projected = frame(spark, [("s", 1, [0, 1]), ("s", 2, [0, 2]), ("s", 3, [])], "source string, range int, words array<bigint>")
    assert [r.problem for r in evidence.projection_problems(projected).orderBy("range").collect()] == [None, "gap", "no words"]
    assert {(r.range, r.first, r.last, r.transcript) for r in evidence.projected_text(projected, told, "range").collect()} == {(1, 0, 1, "a b"), (2, 0, 2, "a c")}


def test_recovery_candidates(spark):
    told = words(spark, "we", "went", "home", "then", "to", "bed", "at", "ten", "—", "ok")
    regions = frame(spark, [("s", "a", 0.0, 2.9, "x", "we went home"), ("s", "b", 3.0, 5.9, "x", "then to bed"), ("s", "c", 30.0, 33.0, "x", "at ten"), ("s", "d", 33.0, 34.0, "x", "ok"), ("s", "e", 40.0, 41.0, "x", "no such words")], REGIONS)
    matches = recovery.region_matches(told, regions).cache()
    got = {r.region_id: (r.n_matches, r["first"], r["last"], r.fits) for r in matches.withColumn("fits", recovery.fits_region()).collect()}
    assert got == {"a": (1, 0, 2, True), "b": (1, 3, 5, True), "c": (1, 6, 7, False), "d": (2, None, None, False), "e": (0, None, None, False)}
    assert {r.word for r in recovery.inferred_boundaries(matches, 10).collect()} == {2, 5}
    none = frame(spark, [], "source string, word long")
    after = frame(spark, [("s", "f", 50.0, 50.9, "x", "ok")], REGIONS)
    more = recovery.region_matches(words(spark, "we", "went", "home", "then", "to", "bed", "at", "ten", "ok"), regions.where("region_id <> 'd'").union(after.withColumns({"r_start": F.lit(8.0), "r_end": F.lit(8.9)})))
    moved = more.withColumns({"r_start": F.when(F.col("region_id") == "c", 5.95).otherwise(F.col("r_start")), "r_end": F.when(F.col("region_id") == "c", 5.99).otherwise(F.col("r_end"))})
    assert [(r.region_id, r["first"], r["last"]) for r in recovery.displaced_phrases(moved, none).collect()] == [("c", 6, 7)]
    assert recovery.displaced_phrases(moved, frame(spark, [("s", 7)], "source string, word long")).count() == 0
    sides = {(r.side, r.region_id) for r in recovery.boundary_texts(frame(spark, [("s", 2)], "source string, word long"), matches).collect()}
    assert sides == {("left", "a"), ("right", "b")}
    issues = frame(spark, [("s", 2), ("s", 5)], "source string, boundary long")
    assert {(r.region_id, r["first"], r["last"]) for r in recovery.anchors(issues, matches, none).collect()} == {("a", 0, 2), ("b", 3, 5), ("c", 6, 7)}


def test_boundaries_inside_regions(spark):
    told = words(spark, "one", "two", "three", "four", "five", "six")
    regions = frame(spark, [("s", "a", 0.0, 3.9, "x", "one two three four"), ("s", "b", 4.0, 6.0, "x", "something else")], REGIONS)
    matches, places = recovery.region_matches(told, regions), recovery.match_places(told, regions)
    marks = frame(spark, [("s", 1), ("s", 4), ("s", 5)], "source string, word long")
    assert {r.word for r in recovery.validated_boundaries(marks, told, matches, places, 5).collect()} == {4, 5}
    got = [(r.region_id, r["first"], r["last"]) for r in recovery.boundary_candidates(marks, told, matches, places, 5).collect()]
    assert got == [("b", 4, 4)]


def test_zero_runs(spark):
    told = frame(spark, [("s", 0, "big", 0.0, 0.5), ("s", 1, "red", 0.5, 0.5), ("s", 2, "dog", 0.5, 0.9), ("s", 3, "hi", 5.0, 5.0), ("s", 4, "xx", 9.0, 9.0)], WORDS)
    regions = frame(spark, [("s", "a", 0.0, 1.0, "x", "big red dog"), ("s", "b", 4.5, 5.5, "x", "hi"), ("s", "c", 8.5, 9.5, "x", "quite other")], REGIONS)
    issues = frame(spark, [("s", "zero_duration", 1, 1), ("s", "zero_duration", 3, 3), ("s", "zero_duration", 4, 4)], "source string, issue string, first long, last long")
    matches = recovery.region_matches(told, regions)
    none = frame(spark, [], "source string, word long")
    assert sorted((r.region_id, r["first"], r["last"]) for r in recovery.zero_runs(issues, told, matches, none, 5).collect()) == [("a", 0, 2), ("b", 3, 3)]
    assert [r.region_id for r in recovery.zero_runs(issues, told, matches, frame(spark, [("s", 0)], "source string, word long"), 5).collect()] == ["b"]


RECOVERED = "source string, region_id string, r_start double, r_end double, word long, text string, new_start double, new_end double"


def test_recoveries_checked_compared_and_trimmed(spark):
    told = words(spark, "a", "b", "c", "d", "e")
    rows = [("s", "r", 0.5, 2.6, 1, "b", 0.6, 1.2), ("s", "r", 0.5, 2.6, 2, "c", 1.2, 3.4), ("s", "q", 4.0, 4.5, 4, "x", 4.5, 4.5)]
    got = frame(spark, rows, RECOVERED)
    assert {(r.word, r.problem) for r in recovery.recovery_problems(got, told).collect()} == {(2, "outside"), (4, "other tokens")}
    r = recovery.compared(got.where("region_id = 'r'"), told).first()
    assert (r.old_start, r.old_end, r.new_start, r.new_end, r.overlap) == (1.0, 2.8, 0.6, 3.4, True) and round(r.start_delta, 9) == -0.4
    cut = {x.word: (x.new_start, x.new_end) for x in recovery.trimmed(got, told, frame(spark, [], "source string, word long")).collect()}
    assert cut == {1: (0.8, 1.2), 2: (1.2, 3.0)}
    moved = told.withColumn("w_end", F.when(F.col("word") == 2, 3.4).otherwise(F.col("w_end")))
    conflicts = recovery.conflicts_after(got.where("region_id = 'r'"), moved)
    assert [(x.recovered, x.conflicting) for x in conflicts.collect()] == [(2, 3)]
    regions = frame(spark, [("s", "r", 0.5, 2.6, "x", ""), ("s", "z", 3.1, 3.5, "x", "")], REGIONS)
    assert recovery.unclaimed_conflicts(conflicts, told, regions.where("region_id = 'r'"), 5).count() == 1 and recovery.unclaimed_conflicts(conflicts, told, regions, 5).count() == 0
    spans = {x.region_id: (x["first"], x["last"], x.fine) for x in recovery.recovery_spans(got).collect()}
    assert spans == {"r": (1, 2, True), "q": (4, 4, False)}
    assert [x.region_id for x in recovery.accepted_at_boundary(got.withColumn("r_end", F.lit(3.4))).select("region_id").distinct().collect()] == ["r"]
    assert recovery.clamped(frame(spark, [("s", "r", 10.0, 12.0, 1, "b", -0.5, 9.0)], RECOVERED)).first().new_end == 12.0


def test_stranded_and_rescued_words(spark):
    told = words(spark, "we", "went", "um", "er", "back", "home", "now")
    regions = frame(spark, [("s", "a", 0.0, 1.9, "x", "we went"), ("s", "b", 2.0, 3.0, "x", "hmm"), ("s", "c", 4.0, 5.9, "x", "back home")], REGIONS)
    matches = recovery.region_matches(told, regions)
    back = frame(spark, [("s", "c", 4.0, 5.9, 4, "back", 4.1, 4.5), ("s", "c", 4.0, 5.9, 5, "home", 4.5, 5.9)], RECOVERED)
    assert [(r.region_id, r["first"], r["last"]) for r in recovery.stranded(told, matches, back, 5).collect()] == [("b", 2, 3)]
    told = words(spark, "go", "on", "bat", "two", "three", "end")
    regions = frame(spark, [("s", "a", 0.0, 1.9, "x", "go on"), ("s", "b", 2.0, 5.0, "x", "but two three")], REGIONS)
    matches = recovery.region_matches(told, regions)
    back = frame(spark, [("s", "a", 0.0, 1.9, 0, "go", 0.0, 0.5), ("s", "a", 0.0, 1.9, 1, "on", 0.5, 1.9)], RECOVERED)
    conflicts = frame(spark, [("s", "a", 1, 2)], "source string, region_id string, recovered long, conflicting long")
    assert [(r.region_id, r["first"], r["last"]) for r in recovery.rescued(conflicts, told, matches, back, 5).collect()] == [("b", 2, 4)]


def test_speaker_change(spark):
    turns = frame(spark, [("t1", "s", 0.0, 4.0), ("t2", "s", 10.0, 11.2), ("t3", "s", 20.0, 20.5)], "id string, source_id string, source_start double, source_end double")
    assert [(r.turn_id, r.boundary) for r in changes.boundaries(turns, with_words=False, step=0.5).orderBy("turn_id", "boundary").collect()] == [("t1", b) for b in (1.0, 1.5, 2.0, 2.5, 3.0)]
    places = changes.boundaries(turns, with_words=True, step=1.0)
    assert [(r.turn_id, round(r.boundary, 6)) for r in places.orderBy("turn_id", "boundary").collect()] == [("t1", 1.0), ("t1", 2.0), ("t1", 3.0), ("t2", 10.6)]
    flat = changes.flanks(places.where("turn_id = 't1'")).withColumn("source_id", F.lit("s"))
    windows, pairs = changes.analysis_windows(flat)
    assert windows.count() == 4 and pairs.count() == 3  # windows that two boundaries share come once
    ids = {(r.w_start, r.w_end): r.window_id for r in windows.collect()}
    vecs = [(ids[(0.0, 1.0)], [1.0, 0.0]), (ids[(1.0, 2.0)], [0.06, 1.0]), (ids[(2.0, 3.0)], [0.06, 1.0])]
    known = frame(spark, [(w, e, v) for w, v in vecs for e in ("one", "two")], "window_id string, encoder string, vector array<double>")
    scored = changes.score(pairs, known, ("one", "two"))
    assert {r.boundary: round(r.divergence, 2) for r in scored.collect()} == {1.0: 0.94, 2.0: 0.0}
    told = {r.turn_id: (r.status, r.n_changes, r.strongest) for r in changes.turn_evidence(turns, flat, scored).collect()}
    assert told == {"t1": ("suspected", 2, 1.0), "t2": ("insufficient_evidence", 0, None), "t3": ("insufficient_evidence", 0, None)}
    r = changes.totals(changes.turn_evidence(turns, flat, scored)).first()
    assert (r.analysed, r.comparisons, r.suspected) == (1, 2, 1)
    stored = frame(spark, [("t1", 1, [1.0, 2.0, 3.0000000001]), ("t2", 1, [9.0]), ("t3", 2, [])], "turn_id string, version int, boundaries array<double>")
    assert {r.turn_id: r.current for r in changes.is_current(stored, places, {"version": 1}).collect()} == {"t1": True, "t2": False, "t3": False}
    reasons = frame(spark, [(["a", "suspected_speaker_change"], "clear"), (None, "suspected")], "r array<string>, s string")
    assert [r[0] for r in reasons.select(changes.review_reasons(F.col("r"), F.col("s"))).collect()] == [["a"], ["suspected_speaker_change"]]


def test_turns_from_regions(spark):
    regions = [(f"r{i}", "s" if i < 6 else "q", float(i), i + 1.0 if i != 4 else 6.5, "rejected" if i == 3 else None) for i in range(8)]
    regions = frame(spark, regions, "id string, source_id string, source_start double, source_end double, status string")
    turns = frame(spark, [("t1", "s", ["r1"], "hello", "en")], "id string, source_id string, source_regions array<string>, transcript string, language string")
    asked = {"new": ["r1", "r2"], "plain": ["r0"], "order": ["r2", "r0"], "gone": ["r9"], "twice": ["r0", "r0"], "mixed": ["r5", "r6"], "bad": ["r3"], "over": ["r4", "r5"], "same": ["r1"], "other": ["r1"], "none": []}
    rows = [(k, v, "bye" if k == "other" else None, None) for k, v in asked.items()]
    out = transitions.turns_of_regions(regions, turns, frame(spark, rows, "request string, region_ids array<string>, transcript string, language string"))
    assert {r.request: (r.existing, r.source_start, r.source_end) for r in out.rows.collect()} == {"plain": (None, 0.0, 1.0), "same": ("t1", 1.0, 2.0)}
    assert {r.request: r.reason for r in out.refused.collect()} == {"new": "belongs to another turn", "order": "out of order", "gone": "missing", "twice": "a region twice", "mixed": "several sources", "bad": "rejected", "over": "overlapping", "other": "exists otherwise", "none": "no region"}


def test_splits_and_merges_keep_their_history(spark):
    turns = frame(spark, [("t1", "s", 0.0, 4.0, ["r1", "r2"], None, None), ("t2", "s", 5.0, 6.0, ["r3"], ["t0", "t1"], ["split:t0"]), ("t3", "s", 7.0, 8.0, ["r3"], None, None)], "id string, source_id string, source_start double, source_end double, source_regions array<string>, root_ids array<string>, operations array<string>")
    regions = frame(spark, [("r1", 0.0, 2.0), ("r2", 1.5, 4.0), ("r3", 5.0, 6.0)], "id string, source_start double, source_end double")
    out = transitions.split_turns(turns, regions, frame(spark, [("t1", 1.8), ("t2", 5.5), ("t9", 1.0), ("t3", 9.0)], "id string, split_time double"))
    assert {(r.id, r.side, tuple(r.source_regions), r.source_end, tuple(r.operations)) for r in out.rows.collect()} == {("t1", "left", ("r1", "r2"), 1.8, ("split:t1:left:1.8",)), (None, "right", ("r1", "r2"), 4.0, ("split:t1:right:1.8",))}
    assert {r.id: r.reason for r in out.refused.collect()} == {"t2": "shared region", "t9": "missing", "t3": "outside"}
    merged = transitions.merged_provenance(turns.where("id <> 't3'").withColumn("into", F.lit("t1")), ["into"], ["source_start"]).first()
    assert (merged.root_ids, merged.operations) == (["t1", "t0"], ["split:t0", "merge:t1+t2"])


def test_edges_texts_and_voices(spark):
    base = "id string, source_start double, source_end double, source_regions array<string>, transcript string, language string, artifacts string"
    turns = frame(spark, [("t1", 0.0, 2.0, ["a"], "we tal", "en", "f"), ("t2", 5.0, 6.0, ["b", "c"], "hi", "en", "f"), ("t3", 7.0, 8.0, ["d"], "no", "en", "f")], base)
    hints = [("t1", "suggested", "end", 2.5, "e", None, "we tal", "we talk"), ("t2", "suggested", "start", 4.5, "q", "b", "hi", None), ("t3", "suggested", "end", 6.0, "e", None, "no", "no")]
    out = transitions.accept_edge(turns, frame(spark, hints, "id string, status string, edge string, time double, region_id string, conflicting_region_id string, candidate_text string, heard_text string"))
    assert {(r.id, r.source_start, r.source_end, tuple(r.source_regions), r.transcript, r.artifacts) for r in out.rows.collect()} == {("t1", 0.0, 2.5, ("a", "e"), "we talk", None), ("t2", 4.5, 6.0, ("c", "q"), "hi", None), ("t3", 7.0, 8.0, ("d",), "no", "f")}
    assert [(r.id, r.reason) for r in out.refused.collect()] == [("t3", "no range")]
    out = transitions.accept_alignment(turns, frame(spark, [("t1", "suggested", 1.0, 3.0, ["z"]), ("t2", "done", 1.0, 3.0, ["z"])], "id string, status string, source_start double, source_end double, region_ids array<string>"))
    assert [(r.source_start, r.source_end, r.source_regions, r.artifacts) for r in out.rows.where("id = 't1'").collect()] == [(1.0, 3.0, ["z"], None)] and out.refused.first().reason == "not suggested"
    out = transitions.edit_turns(turns, frame(spark, [("t1", " new ", None), ("t2", "  ", None)], "id string, transcript string, language string"))
    assert {r.id: r.transcript for r in out.rows.collect()} == {"t1": "new", "t2": "hi", "t3": "no"} and out.refused.first().reason == "blank"
    voices = frame(spark, [("voice-000004", "Ann", "en", ["A"], False, None)], "id string, character string, language string, aliases array<string>, ignored boolean, notes string")
    new = transitions.new_voices(voices, frame(spark, [("Bo", "en", None, None, None), (" ", "de", ["x"], True, "n")], "character string, language string, aliases array<string>, ignored boolean, notes string"))
    assert {(r.id, r.character, r.ignored) for r in new.collect()} == {("voice-000005", None, True), ("voice-000006", "Bo", False)}
    assert transitions.rename_voices(voices, frame(spark, [("voice-000004", "")], "id string, character string")).rows.first().character is None
    assert transitions.set_ignored(voices, frame(spark, [("voice-000004", True)], "id string, ignored boolean")).rows.first().ignored is True
    assert [r.aliases for r in views.voice_list(voices).collect()] == ["A"]
    states = frame(spark, [("a", None, None), ("b", None, "other"), ("c", "rejected", "bad"), ("d", "lost", None)], "id string, status string, reason string")
    assert {r.id: (r.state, r.problem) for r in transitions.region_states(states).collect()} == {"a": ("pending", None), "b": ("pending", "pending with a reason"), "c": ("rejected", "rejected without a reason"), "d": ("lost", "unknown state")}


def test_plans_and_markers(spark):
    plan = frame(spark, [("s", 0, 2, 0.0, 3.0, "x", [], [], [0, 1, 2]), ("s", 3, 4, 3.0, 3.0, None, [3], [4], [3, 4]), ("s", 5, 9, 5.0, 6.0, "x", [], [], [5, 6])], "source string, first long, last long, start double, end double, speaker string, unresolved array<int>, issues array<int>, word_numbers array<bigint>")
    got = transitions.planned_turns(plan).orderBy("first").collect()
    assert [(r.status, r.reasons) for r in got[:2]] == [("ready", []), ("review", ["unresolved_speaker", "unresolved_words", "invalid_alignment"])]
    problems = transitions.plan_problems(plan, words(spark, *"abcdef").withColumnRenamed("word", "word"))
    assert {r["first"]: r.problem for r in problems.collect()} == {3: "no range", 5: "ends differ"}
    turns = frame(spark, [("t1", "s", 0, 2, "automatic"), ("t2", "s", 4, 5, "automatic"), ("t3", "s", 7, 8, "manual")], "id string, source_id string, first long, last long, creation string")
    planned = frame(spark, [("s", 0, 2), ("s", 5, 6), ("s", 7, 9)], "source_id string, first long, last long")
    assert {(r["first"], r.action) for r in transitions.upsert_turns(turns, planned).collect()} == {(0, "skip"), (5, "stale"), (7, "create")}
    kind = "array<struct<first:bigint,last:bigint>>"
    sources = frame(spark, [("s", None, None, None, None), ("q", "automatic", "asr", [(1, 2)], None)], f"id string, marker_mode string, marker_evidence string, marker_ranges {kind}, automatic_ranges {kind}")
    auto = transitions.mark_complete(sources, turns.select("source_id", "first", "last"), "automatic", "asr")
    assert {r.id: r.complete for r in transitions.marker_state(auto, turns, "asr").collect()} == {"s": True, "q": True}
    curated = transitions.mark_complete(auto, frame(spark, [("s", 0, 8)], "source_id string, first long, last long"), "curated", "asr")
    state = {r.id: (r.marked, r.curated, r.complete) for r in transitions.marker_state(curated, turns, "asr").collect()}
    assert state == {"s": (True, True, False), "q": (True, True, True)}
    assert {r.id: len(r.automatic_ranges) for r in curated.collect()} == {"s": 3, "q": 0}
    assert not transitions.marker_state(curated, turns, "other").where("marked").count()
    old = frame(spark, [("t", "s", 0.05, 9.95, False, True, "complete"), ("u", "x", 0.0, 1.0, True, None, "clipped")], "id string, source_id string, source_start double, source_end double, near_start boolean, near_end boolean, boundary_status string")
    new = {r.id: (r.near_start, r.near_end, r.boundary_status) for r in transitions.refresh_boundaries(old, frame(spark, [("s", 10.0)], "source_id string, duration double")).collect()}
    assert new == {"t": (True, True, None), "u": (None, None, None)}


FORMS = "map<string,struct<path:string,purposes:array<string>,duration:double,media_start:double,stream_index:int,channel_mode:string>>"


def test_media(spark):
    forms = {"raw": ("a.wav", ["boundary_analysis", "review"], 10.0, 2.0, 0, "mono"), "clean": ("b.wav", ["context"], 10.0, -1.0, None, None)}
    two = {k: (p, ["review"], d, m, i, c) for k, (p, _, d, m, i, c) in forms.items()}
    sources = frame(spark, [("s", forms), ("q", two)], f"id string, forms {FORMS}")
    form = media.form_named(F.col("forms"), "raw")
    r = sources.where("id = 's'").select(media.to_media_time(form, F.lit(1.5)).alias("a"), media.from_media_time(form, F.lit(1.5)).alias("b"), media.from_media_time(form, F.lit(3.0)).alias("c"), media.has_media_mapping(form).alias("d"), media.to_media_time(media.form_named(F.col("forms"), "clean"), F.lit(1.0)).alias("e"), media.only_form_for(F.col("forms"), "review").alias("f"), media.first_form_for(F.col("forms"), "context").alias("g"), media.form_named(F.col("forms"), "none").alias("h")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f.key, r.g.key, r.h) == (3.5, None, 1.0, True, None, "raw", "clean", None)
    assert {r.id: r.problem for r in media.form_problems(sources, "review").collect()} == {"s": None, "q": "several"}
    assert {r.id: r.problem for r in media.form_problems(sources, "context", required=False).collect()} == {"s": None, "q": None}
    turns = frame(spark, [("t1", "s", 0.05, 9.0), ("t2", "s", 3.0, 11.0), ("t3", "q", 0.0, 1.0)], "id string, source_id string, source_start double, source_end double")
    got = {r.id: (r.form, r.near_start, r.near_end, r.problem) for r in media.boundary_evidence(turns, sources).collect()}
    assert got == {"t1": ("raw", True, False, None), "t2": ("raw", None, None, "beyond the end"), "t3": (None, None, None, None)}
    new = frame(spark, [("s", "derived", "raw", ("c.wav", ["x"], 10.0, None, None, None)), ("s", "clean", "raw", ("z", [], 1.0, None, None, None)), ("q", "d", "nope", ("z", [], 1.0, None, None, None))], f"id string, name string, parent string, form {FORMS[11:-1]}")
    out = {r.id: r.forms for r in media.with_form(sources, new).collect()}
    assert out["s"]["derived"].media_start == 2.0 and out["s"]["clean"].path == "b.wav" and set(out["q"]) == {"raw", "clean"}
    changed = media.set_provenance(sources, frame(spark, [("s", "clean", 1.0, 3, "center")], "id string, name string, media_start double, stream_index int, channel_mode string"))
    assert {r.id: r.forms["clean"].stream_index for r in changed.collect()} == {"s": 3, "q": None}
    streams = frame(spark, [("a", 0, "eng", False), ("a", 1, "deu", True), ("b", 0, None, None), ("c", 0, None, None), ("c", 1, None, None)], "source string, stream_index int, language string, is_default boolean")
    asked = frame(spark, [("a", None, "ENG"), ("b", None, None), ("c", None, None), ("d", None, None)], "source string, stream_index int, language string")
    got = {r.source: (r.stream_index, r.rule, r.problem) for r in media.choose_stream(streams, asked).collect()}
    assert got == {"a": (0, "language", None), "b": (0, "only", None), "c": (None, None, "ambiguous"), "d": (None, None, "no stream")}
    got = {r.source: (r.stream_index, r.rule, r.problem) for r in media.choose_stream(streams, frame(spark, [("a", None, None), ("c", 1, None), ("b", 7, None)], "source string, stream_index int, language string")).collect()}
    assert got == {"a": (1, "default", None), "c": (1, "asked", None), "b": (None, None, "no such stream")}
    clips = frame(spark, [("t1", 0.0, 9.2), ("t2", 3.5, 11.0)], "id string, clip_start double, clip_end double")
    assert {r.id for r in media.stale_clips(turns, clips).collect()} == {"t2", "t3"}
    kept = media.without_form(frame(spark, [({"w": ("raw",)}, {"e": ("clean",)})], "transcripts map<string,struct<representation:string>>, embeddings map<string,struct<representation:string>>"), "raw").first()
    assert kept.transcripts == {} and set(kept.embeddings) == {"e"}
    state = media.compatible(frame(spark, [("a", "m1"), ("b", None), ("c", "m2")], "k string, model string"), frame(spark, [(x, "m1") for x in "abcd"], "k string, model string"), ["k"], ["model"])
    assert {r.k: r.state for r in state.collect()} == {"a": "same", "b": "same", "c": "conflict", "d": "absent"}
    modes = frame(spark, [("5.1(side)",), ("stereo",), (None,)], "l string").select(media.channel_mode(F.col("l")))
    assert [r[0] for r in modes.collect()] == ["center", "mono", "mono"]


def test_levels_padding_and_clips(spark):
    samples = frame(spark, [("s", t, 0.1 if t < 60 else 0.0) for t in range(120)], "source string, t int, v double")
    cuts = frame(spark, [("s", 30), ("s", 60), ("s", 90), ("s", 900)], "source string, cut int")
    got = {r.cut: r.pad for r in intervals.edge_levels(cuts, samples, ["source"], "cut", "t", "v", 10).withColumn("pad", intervals.needs_padding({"before": F.col("before"), "after": F.col("after")})).collect()}
    assert got == {30: True, 60: False, 90: False, 900: False}


def test_observations(spark):
    good = {"schema_version": 1, "turn_id": "t", "source_id": "s", "confirmed_voice_id": "v", "predicted_voice_id": "v", "correct": True, "top_score": 0.9, "runner_up_score": 0.5, "margin": 0.4, "encoder_count": 1, "total_source_support": 2}
    bad = [{"schema_version": 2}, {"turn_id": " "}, {"correct": False}, {"predicted_voice_id": None, "correct": False}, {"runner_up_score": None}, {"encoder_count": -1}]
    lines = [json.dumps(good)] + [json.dumps(good | b) for b in bad] + ["nothing"]
    ok, wrong = vectors.read_observations(frame(spark, [(x,) for x in lines], "observation string"))
    assert ok.count() == 1 and sorted(r.reason for r in wrong.collect()) == sorted(["unknown schema version", "an id is missing", "correct does not fit the voices", "a score without a prediction", "a margin without both scores", "a negative count", "no object"])
    again, _ = vectors.read_observations(vectors.write_observations(ok))
    assert again.first() == ok.first()
    seen = vectors.observe(frame(spark, [("t1", "v", 0.3)], "query_id string, top_label string, margin double"), frame(spark, [("t1", "s", "v"), ("t2", "s", "v")], "query_id string, source_id string, confirmed string"))
    assert {r.query_id: r.correct for r in seen.collect()} == {"t1": True, "t2": False}
    vecs = frame(spark, [("a", [1.0], 1), ("b", [1.0], 2), ("c", [float("nan")], 1), ("d", None, 1), ("e", [0.0], 1)], "turn_id string, vector array<double>, dimension int")
    assert {r.turn_id: r.problem for r in vectors.valid_vectors(vecs).collect()} == {"a": None, "b": "wrong dimension", "c": "not finite", "d": "no vector", "e": "zero"}
    turns = frame(spark, [("a", ["raw"]), ("b", ["other"])], "id string, representations array<string>")
    assert tuple(vectors.fully_embedded(turns, vecs, "raw").first()) == (1, True) and tuple(vectors.fully_embedded(turns, vecs, "other").first()) == (1, False)
    units = vecs.select(vectors.unit(F.col("vector"))).collect()
    assert [r[0] for r in units] == [[1.0], [1.0], None, None, None]
    live = vectors.reference_turns(frame(spark, [("t1", "assigned", "manual", "v1"), ("t2", "assigned", "manual", "v2"), ("t3", "assigned", "auto", "v1")], "id string, assignment_status string, method string, voice_id string"), frame(spark, [("v1", None), ("v2", True)], "id string, ignored boolean"))
    assert [r.id for r in live.collect()] == ["t1"]


def test_conflict_runs_keep_all_regions_of_their_run(spark):
    rng = random.Random(2)
    rows = [("s", i, sorted({str(rng.randrange(i, i + 4)) for _ in range(2)})) for i in range(0, 120, 2)]
    got = {r.i: r.run for r in speakers.merged_region_runs(frame(spark, rows, "s string, i int, r array<string>"), ["s"], "i", "r").collect()}
    want, run, held = {}, 0, set()
    for _, i, regions in rows:
        run, held = (run, held | set(regions)) if held & set(regions) else (run + 1, set(regions))
        want[i] = run
    assert got == want and max(want.values()) > 5


def write(path, name, doc):
    path.mkdir(exist_ok=True)
    (path / name).write_text(json.dumps(doc))


def test_readers(spark, tmp_path):
    head = {"format": "speech-detector-output", "version": 1, "detector": {"name": "d", "parameters": {"b": 1}}, "source": {"path": "x.wav", "duration": 10.0}}
    write(tmp_path / "d", "a.json", head | {"regions": [{"start": 0, "end": 2, "label": "A"}, {"start": 3, "end": 3}, {"start": -1, "end": 2}, {"start": 9, "end": 11}, {"end": 1}]})
    write(tmp_path / "d", "b.json", head | {"format": "other", "regions": []})
    write(tmp_path / "d", "c.json", head | {"version": 9, "regions": []})
    (tmp_path / "d" / "e.json").write_text("{broken")
    rows, bad = interchange.detector_output(spark, str(tmp_path / "d"))
    assert [(r.start, r.end, r.label, r.detector_parameters) for r in rows.collect()] == [(0.0, 2.0, "A", {"b": "1"})]
    assert sorted(r.reason for r in bad.collect()) == sorted(["empty", "starts before 0", "ends behind its source", "no range", "unknown format", "unknown version", "no document of this form"])
    write(tmp_path / "t", "a.json", {"format": "speech-transcript-output", "version": 1, "transcriber": {"name": "w"}, "representation": "raw", "hypotheses": [{"region_id": "r1", "text": "hi", "confidence": 0.5}, {"region_id": "r2"}, {"region_id": "r2"}, {"text": "no"}]})
    rows, bad = interchange.transcript_output(spark, str(tmp_path / "t"))
    assert [r.region_id for r in rows.collect()] == ["r1"] and sorted(r.reason for r in bad.collect()) == ["a region twice", "a region twice", "no region"]
    write(tmp_path / "e", "a.json", {"format": "speech-embedding-output", "version": 1, "record_type": "turn", "encoder": {"name": "e"}, "representation": "raw", "embeddings": [{"turn_id": "t1", "dimension": 2, "vector": [1, 2]}, {"turn_id": "t2", "dimension": 3, "vector": [1, 2]}, {"turn_id": "t3", "dimension": 1}]})
    rows, bad = interchange.embedding_output(spark, str(tmp_path / "e"))
    assert [(r.id, r.record_type) for r in rows.collect()] == [("t1", "turn")] and sorted(r.reason for r in bad.collect()) == ["no vector", "wrong dimension"]
    word = lambda t, a, b: {"text": t, "start": a, "end": b}
    chunk = lambda i, s, *w: {"index": i, "start": s, "end": s + 5, "language": "en", "text": "", "words": list(w)}
    head = {"format": "speech-continuous-asr-output"}
    write(tmp_path / "c", "a.json", head | {"version": 2, "chunks": [chunk(0, 0.0, word("a", 1, 2)), chunk(1, 10.0, word("b", 1, 2), word("c", 3, 2))]})
    write(tmp_path / "c", "b.json", head | {"version": 1, "language": "de", "words": [word("x", 0, 1)]})
    write(tmp_path / "c", "c.json", head | {"version": 2, "chunks": [chunk(1, 0.0)]})
    rows, bad = interchange.continuous_output(spark, str(tmp_path / "c"))
    assert sorted((r.language, r.word, r.text, r.w_start) for r in rows.collect()) == [("de", 0, "x", 0.0), ("en", 0, "a", 1.0), ("en", 1, "b", 11.0)]
    assert sorted(r.reason for r in bad.collect()) == ["chunks out of order", "ends before it starts"]
    head = {"format": "speech-forced-alignment-output", "version": 1}
    write(tmp_path / "f", "a.json", head | {"language": "en", "text": "Sea-green boat", "words": [word("seagreen", 0, 1), word("boat", 1, 2)]})
    write(tmp_path / "f", "b.json", head | {"alignments": [{"index": 0, "text": "a b", "words": [word("a", 0, 1), word("c", 1, 2)]}, {"index": 5, "text": "", "words": []}]})
    rows, bad = interchange.alignment_output(spark, str(tmp_path / "f"))
    assert sorted((r.alignment, r.word, r.text) for r in rows.collect()) == [(0, 0, "seagreen"), (0, 1, "boat")] and sorted(r.reason for r in bad.collect()) == ["other words than its text", "out of order"]
    write(tmp_path / "b", "a.json", {"format": "speech-utterance-boundary-output", "version": 1, "word_count": 4, "boundary_after_word_indices": [1, 3, 3, 9]})
    rows, bad = interchange.boundary_output(spark, str(tmp_path / "b"))
    assert sorted(r.word for r in rows.collect()) == [1, 3] and sorted(r.reason for r in bad.collect()) == ["a word twice", "no such word"]
    file = rows.first().document
    rows, bad = interchange.boundary_output(spark, str(tmp_path / "b"), frame(spark, [(file, 7)], "document string, n_words long"))
    assert rows.count() == 0 and [r.reason for r in bad.collect()] == ["other words than those told"]
    rows, bad = interchange.diarization_segments(frame(spark, [("0.5 1.5 speaker_1",), ("2 1 speaker_0",), ("x",)], "value string"))
    assert [(r.start, r.end, r.speaker) for r in rows.collect()] == [(0.5, 1.5, "speaker_1")] and sorted(r.reason for r in bad.collect()) == ["no range", "no segment"]


def test_review_views(spark):
    turns = [(f"t{i}", "s", float(i), i + 1.0, "assigned" if i == 1 else None, "v1" if i == 1 else None, "reviewed" if i == 2 else None, None, i == 0, False, "review" if i != 3 else "ready") for i in range(4)]
    turns = frame(spark, turns, "id string, source_id string, source_start double, source_end double, assignment_status string, voice_id string, review_status string, boundary_status string, near_start boolean, near_end boolean, pipeline_status string")
    assert [r.id for r in views.cursors(turns, automatic_only=True).orderBy("position").collect()] == ["t0", "t1"]
    assert sorted((r.into, r.id) for r in views.merge_requests(turns, frame(spark, [("t1",), ("t3",)], "id string")).collect()) == [("t1", "t1"), ("t1", "t2")]
    ranked = frame(spark, [("t0", "v1", 0.9, 1), ("t0", "v2", 0.5, 2), ("t1", "v2", 0.4, 1)], "query_id string, label string, score double, rank int")
    voices = frame(spark, [("v1", "Ann", "en", None), ("v2", None, None, True)], "id string, character string, language string, ignored boolean")
    assert {(r.label, r.character, r.percent, r.ignored) for r in views.candidates_view(ranked, voices, 1).collect()} == {("v1", "Ann", "90.0%", False), ("v2", None, "40.0%", True)}
    got = {r.id: (r["mode"], r.n_candidates, r.candidates and r.candidates[0].label) for r in views.review_view(turns, frame(spark, [("t0", "prefill")], "query_id string, mode string"), ranked, voices, 1).collect()}
    assert got == {"t0": ("prefill", 1, "v1"), "t1": ("none", 1, "v2"), "t2": ("none", 0, None), "t3": ("none", 0, None)}
    start, end = views.context_range(F.lit(0.5), F.lit(9.8), F.lit(10.0), 1.0)
    assert tuple(turns.select(start, end).first()) == (0.0, 10.0)


@pytest.mark.parametrize("name", ["chunk_plan", "fragment_resolver", "sentences", "text_match_spans", "derived_utterances"])
def test_queries_without_sql_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
