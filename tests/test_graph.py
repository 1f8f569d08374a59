"""Alignment, utterance graph, commits, automatic and curated changes, held against plain Python."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnweave.operators import automatic, curated, effective, graph, linked, spans
from turnweave.sources.catalog import Catalog, Conflict, bad_json_lines, line_numbers, with_new_ids
from turnweave.sources.stages import Stages

WORDS = "source string, word long, text string, w_start double, w_end double"
REGIONS = "source string, region_id string, r_start double, r_end double, label string, heard string"
CELL = 20


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def evenly(candidates):
    """A made aligner: the words of a candidate share its region evenly."""
    step = (F.col("r_end") - F.col("r_start")) / F.size("words")
    flat = candidates.select("source", "region_id", "first", "r_start", step.alias("step"), F.posexplode("words").alias("k", "w"))
    return flat.select("source", "region_id", "first", F.col("w.word").alias("word"), F.col("w.text").alias("text"), (F.col("r_start") + F.col("k") * F.col("step")).alias("new_start"), (F.col("r_start") + (F.col("k") + 1) * F.col("step") - 0.01).alias("new_end"))


def by_python(batch):
    """The same as a function over Arrow batches."""
    out = []
    for x in batch.to_pylist():
        step = (x["r_end"] - x["r_start"]) / len(x["words"])
        out += [(x["source"], x["region_id"], x["first"], w["word"], w["text"], x["r_start"] + k * step, x["r_start"] + (k + 1) * step - 0.01) for k, w in enumerate(x["words"])]
    names = ["source", "region_id", "first", "word", "text", "new_start", "new_end"]
    return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], pa.schema([("source", pa.string()), ("region_id", pa.string()), ("first", pa.int64()), ("word", pa.int64()), ("text", pa.string()), ("new_start", pa.float64()), ("new_end", pa.float64())]))


def recording(rng, source, regions=24):
    """Words and regions: each region of two to five own words; some words without length, too long, or said elsewhere than their region lies."""
    words, held, at = [], [], 0.0
    for r in range(regions):
        n = rng.randrange(2, 6)
        start, end = at, at + n * 1.0
        texts = [f"{source}{r}x{k}" for k in range(n)]
        shift = rng.choice([0, 0, 0, 2.0]) if 0 < r < regions - 1 else 0
        for k, t in enumerate(texts):
            a = start + k + shift
            kind = rng.random()
            words.append([source, len(words), t, a, a if kind < 0.12 else a + 6.0 if kind < 0.17 else a + 0.9])
        held.append((source, f"r{r}", start, end, rng.choice(["x", "y"]), " ".join(texts)))
        at = end + rng.choice([0.0, 0.0, 0.5, 7.0])
    for k in range(1, len(words)):
        words[k][3] = max(words[k][3], words[k - 1][3])
        words[k][4] = max(words[k][3], words[k][4])
    return [tuple(w) for w in words], held


def planned(words, regions):
    """Candidates of the first four kinds, by plain loops in the order of the rules."""
    tokens = [w[2] for w in words]
    matches = []
    for _, rid, a, b, _, heard in sorted(regions, key=lambda r: (r[2], r[3], r[1])):
        said = heard.split()
        places = [k for k in range(len(tokens)) if tokens[k : k + len(said)] == said]
        if len(places) == 1:
            matches.append((rid, a, b, places[0], places[0] + len(said) - 1))
    zero, run, gaps, bad = [], [], [], set()
    for k, (_, _, _, a, b) in enumerate(words):
        if b - a <= 1e-6:
            run.append(k)
            bad.add(k)
        else:
            zero += [tuple(run)] if run else []
            run = []
        if b - a > 5.0:
            bad.add(k)
        if k and a - words[k - 1][4] > 5.0:
            gaps.append(k - 1)
    zero += [tuple(run)] if run else []
    out, claimed = [], set()
    for rid, a, b, i, j in matches:
        mine = set(range(i, j + 1))
        if mine & bad and not mine & claimed:
            claimed |= mine
            out.append((rid, a, b, i, j, effective.WORD))
    fits = lambda m: min(words[m[4]][4], m[2]) > max(words[m[3]][3], m[1]) and abs(words[m[3]][3] - m[1]) <= 1 and abs(words[m[4]][4] - m[2]) <= 1
    more = []
    for at, m in enumerate(matches):
        if fits(m) or m[4] - m[3] < 1 or set(range(m[3], m[4] + 1)) & claimed:
            continue
        before, after = [x for x in matches[:at] if fits(x)], [x for x in matches[at + 1 :] if fits(x)]
        if before and after and before[-1][4] < m[3] and m[4] < after[0][3]:
            more.append((*m, effective.PHRASE))
    near = {}
    for g in gaps:
        for m in matches:
            if (m[4] == g or m[3] == g + 1) and not set(range(m[3], m[4] + 1)) & claimed:
                near.setdefault((m[3], m[4]), {})[m[0]] = m
    more += [(*next(iter(x.values())), effective.GAP) for x in near.values() if len(x) == 1]
    used = set(claimed)
    for c in sorted(more, key=lambda c: (c[5], c[1], c[2], c[3], c[0])):
        mine = set(range(c[3], c[4] + 1))
        if not mine & used:
            used |= mine
            out.append(c)
    return out, bad


def test_planned_candidates(spark):
    """Claims of four kinds against a plain fold, source by source (every zero run lies in a region with an only place, so none is claimed by itself)."""
    rng = random.Random(11)
    made = {s: recording(rng, s) for s in ("a", "b", "c")}
    words, regions = (frame(spark, [r for m in made.values() for r in m[k]], schema) for k, schema in ((0, WORDS), (1, REGIONS)))
    out = effective.effective_alignment(words, regions, effective.by_batches(by_python), CELL)
    first = out.candidates.where(F.col("kind") < effective.STRANDED)
    got = sorted((r.source, r.region_id, r.r_start, r.r_end, r["first"], r["last"], r.kind) for r in first.collect())
    assert got == sorted((s, *c) for s, (w, r) in made.items() for c in planned(w, r)[0])
    times = {(r.source, r.word): (r.w_start, r.w_end) for r in out.words.collect()}
    assert len(times) == sum(len(w) for w, _ in made.values())
    told = out.recoveries.collect()
    assert len({(r.source, r.word) for r in told}) == len(told) and {r.kind for r in told} >= {effective.WORD}
    assert all(times[r.source, r.word] == (r.new_start, r.new_end) for r in told)
    again = {(r.source, r.word) for r in told}
    assert all(times[s, w[1]] == (w[3], w[4]) for s, (ws, _) in made.items() for w in ws if (s, w[1]) not in again)
    bad = {(s, k) for s, (w, r) in made.items() for k in planned(w, r)[1]}
    lost = {(r.source, r.word) for r in out.suppressed.collect()}
    assert bad - again <= lost and not {x for x in bad & again if times[x][1] - times[x][0] > 0.05} & lost - {x for x in lost if x not in bad}


def test_zero_runs_and_refused_times(spark):
    """A run of words without length in a region whose text isn't found, in a source for each aligner: one that is right, others that leave the region, say other
    words, repeat a word or go back in time; and rows with nulls."""
    rows = [("good", 0.0, 0.9), ("morning", 1.0, 1.9), ("dear", 3.0, 3.0), ("my", 3.0, 3.0), ("frend", 3.0, 3.0), ("bye", 6.0, 6.9)]
    regions = [("r0", 0.0, 2.0, "x", "good morning"), ("r1", 2.5, 4.5, "x", "dear my friend"), ("r2", 6.0, 7.0, "y", "bye")]
    sources = ["right", "leaves", "others", "repeats", "back"]
    words = frame(spark, [(s, k, *r) for s in sources for k, r in enumerate(rows)] + [(None, 0, None, None, None), ("right", 6, None, 8.0, 9.0)], WORDS)
    held = frame(spark, [(s, *r) for s in sources for r in regions] + [(None, None, None, None, None, None)], REGIONS)
    when = lambda s, value, c: F.when(F.col("source") == s, value).otherwise(F.col(c))

    def spoilt(candidates):
        told = evenly(candidates)
        return told.withColumns({"new_end": when("leaves", F.col("new_end") + 9, "new_end"), "text": when("others", F.lit("other"), "text"), "word": when("repeats", F.lit(2).cast("long"), "word"), "new_start": when("back", F.col("new_start") - F.col("word") % 2 * 1.5, "new_start")})

    out = effective.effective_alignment(words, held, spoilt, CELL)
    assert {(r.source, r.word, r.kind) for r in out.recoveries.collect()} == {("right", k, effective.ZERO) for k in (2, 3, 4)}
    lost = {(s, k) for s in sources[1:] for k in (2, 3, 4)}
    assert {(r.source, r.word) for r in out.unresolved.collect()} == lost == {(r.source, r.word) for r in out.suppressed.collect()}
    assert out.words.count() == words.count()
    none = effective.effective_alignment(words.limit(0), held, evenly, CELL)
    assert none.words.count() == 0 and none.recoveries.count() == 0


def test_stages_work_once(spark, tmp_path):
    rng = random.Random(3)
    made = [recording(rng, s, 8) for s in ("a", "b")]
    words, regions = (frame(spark, [r for m in made for r in m[k]], schema) for k, schema in ((0, WORDS), (1, REGIONS)))
    segment = lambda w: w.where("word % 4 = 3").select("source", "word")
    asked = []

    def align(candidates):
        asked.append(1)
        return evenly(candidates)

    names = {"aligner": "even 1", "segmenter": "fours"}
    first = Stages(spark, str(tmp_path / "stages"))
    told = graph.build_utterances(first, words, regions, align, segment, names, CELL)
    assert first.worked == ["alignment", "sentences", "boundaries", "speakers", "candidates"] and asked
    rows = sorted(map(str, told["candidates"].collect()))
    held = {(r.source, n) for r in told["candidates"].collect() for n in r.word_numbers}
    usable = {(r.source, r.word) for r in words.join(told["suppressed"], ["source", "word"], "left_anti").collect()}
    assert held == usable
    asked.clear()
    again = Stages(spark, str(tmp_path / "stages"))
    told = graph.build_utterances(again, words.repartition(3), regions, align, segment, names, CELL)
    assert again.worked == [] and not asked and sorted(map(str, told["candidates"].collect())) == rows
    # A lost result is worked out again, and nothing else: what follows has been told from the same marks.
    (home,) = [p for p in (tmp_path / "stages" / "speakers").iterdir()]
    (home / "_tables" / "_SUCCESS").unlink()
    lost = Stages(spark, str(tmp_path / "stages"))
    graph.build_utterances(lost, words, regions, align, segment, names, CELL)
    assert lost.worked == ["speakers"] and not asked
    other = Stages(spark, str(tmp_path / "stages"))
    graph.build_utterances(other, words, regions, align, lambda w: w.where("word % 5 = 0").select("source", "word"), names | {"segmenter": "fives"}, CELL)
    assert other.worked == ["sentences", "boundaries", "speakers", "candidates"]


def test_commits_are_whole(spark, tmp_path):
    schema = "id int, v string"
    one, two = Catalog(spark, str(tmp_path / "c")), Catalog(spark, str(tmp_path / "c"))
    one.commit({"turns": frame(spark, [(1, "a")], schema), "marks": frame(spark, [(1, "x")], schema)})
    base = two.head()
    one.commit({"turns": frame(spark, [(1, "b")], schema)}, {"marks": frame(spark, [(2, "y")], schema)}, base=one.head())
    with pytest.raises(Conflict):  # made from a state that is no longer the newest
        two.commit({"turns": frame(spark, [(9, "z")], schema), "marks": frame(spark, [], schema)}, base=base)
    assert [tuple(r) for r in two.read("turns").collect()] == [(1, "b")] and two.read("marks").count() == 2
    assert [tuple(r) for r in two.read("turns", at=base[1]).collect()] == [(1, "a")]
    # A writer that dies over the commit file leaves the state before, and the next one goes on.
    number = one.head()[0] + 1
    (tmp_path / "c" / "_commits" / f"{number:010d}.json").write_text('{"turns": {"ver')
    assert one.head()[0] == number - 1 and one.read("turns").count() == 1
    one.append("turns", frame(spark, [(3, "c")], schema), key="id")
    assert one.read("turns").count() == 2
    slow = two.head()
    one.append("turns", frame(spark, [(4, "d")], schema))
    with pytest.raises(Conflict):
        two.commit(added={"turns": frame(spark, [(4, "e")], schema)}, base=slow)
    # Evidence is written once.
    evidence = frame(spark, [("s", "qwen", "hello"), (None, "qwen", None)], "source string, name string, text string")
    assert {r.action for r in one.attach("evidence", evidence, ["source", "name"]).collect()} == {"insert"}
    assert {r.action for r in one.attach("evidence", evidence, ["source", "name"]).collect()} == {"skip"} and one.read("evidence").count() == 2
    with pytest.raises(ValueError, match="different"):
        one.attach("evidence", evidence.withColumn("text", F.lit("other")).union(frame(spark, [("t", "qwen", "new")], "a string, b string, c string")), ["source", "name"])
    assert one.read("evidence").count() == 2


TURNS = ", ".join(f"{k} {v}" for k, v in graph.TURN.items())
SOURCES = "id string, marker_mode string, marker_evidence string, marker_ranges array<struct<first:bigint,last:bigint>>, automatic_ranges array<struct<first:bigint,last:bigint>>"


def test_plans_are_applied(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "c"))
    old = [
        ("turn-000007", "a", 0.0, 2.0, ["r0"], "kept text", "en", graph.METHOD, 0, 1, "y", "review", ["x"]), ("turn-000003", "b", 0.0, 2.0, ["r0"], "old", "en", graph.METHOD, 0, 2, None, "ready", []),
        ("turn-000004", "b", 5.0, 6.0, ["r9"], "by hand", "en", "manual", 0, 1, None, None, None),
    ]
    catalog.commit({"turns": frame(spark, old, TURNS), "sources": frame(spark, [(s, None, None, None, None) for s in "abcd"], SOURCES)})
    words = frame(spark, [(s, k, f"w{k}", k * 1.0, k + 0.9) for s in "abcd" for k in range(6)], WORDS)
    regions = frame(spark, [(s, f"r{k}", k * 2.0, k * 2 + 2.0, "x", "") for s in "abcd" for k in range(3)], REGIONS)
    plan = [("a", 0, 1, 0.0, 1.9, "x", "w0 w1", [0, 1], "ready", []), ("a", 2, 5, 2.0, 5.9, None, "w2", [2, 3, 4, 5], "review", ["unresolved_speaker"]), ("b", 0, 1, 0.0, 1.9, "x", "w0 w1", [0, 1], "ready", []), ("c", 0, 1, 0.0, 1.9, "x", "w", [0, 9], "ready", [])]
    planned = frame(spark, plan, "source string, first long, last long, start double, end double, speaker string, text string, word_numbers array<long>, status string, reasons array<string>")
    out = graph.apply_utterances(catalog, planned, words, regions, "de", "qwen", CELL)
    assert {(r.source_id, r.reason) for r in out.refused.collect()} == {("b", "stale turn"), ("c", "invalid plan")}
    assert [tuple(r) for r in out.counts.collect()] == [("a", 1, 1, 1)]
    turns = {r.id: r for r in catalog.read("turns").collect()}
    assert set(turns) == {"turn-000003", "turn-000004", "turn-000007", "turn-000008"}
    assert (turns["turn-000007"].speaker, turns["turn-000007"].pipeline_status, turns["turn-000007"].transcript) == ("x", "ready", "kept text")
    new = turns["turn-000008"]
    assert (new.source_regions, new.transcript, new.language, new["first"], new["last"], new.review_reasons) == (["r1", "r2"], "w2", "de", 2, 5, ["unresolved_speaker"])
    marks = {r.id: r for r in catalog.read("sources").collect()}
    assert [tuple(x) for x in marks["a"].marker_ranges] == [(0, 1), (2, 5)] and marks["b"].marker_mode is None and len(marks) == 4
    again = graph.apply_utterances(catalog, planned.where("source = 'a'"), words, regions, "de", "qwen", CELL)
    assert [tuple(r) for r in again.counts.collect()] == [("a", 0, 2, 1)] and catalog.read("turns").count() == 4


def test_linked_records(spark):
    rng = random.Random(6)
    links = [(f"n{rng.randrange(120):03d}", f"n{rng.randrange(120):03d}") for _ in range(70)] + [(f"p{k:03d}", f"p{k + 1:03d}") for k in range(40)] + [("q", "q"), (None, "n001"), ("z", None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a and b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r.id: r.root for r in linked.components(frame(spark, links, "a string, b string"), "a", "b").collect()}
    assert got == {x: find(x) for x in root}
    wants = [(k, t) for k in range(120) for t in rng.sample(range(60), rng.randrange(1, 4))] + [(500, None)]
    got = {r.k: r.taken for r in linked.chosen_in_order(frame(spark, wants, "k int, t int"), "k", "t", ["k"]).collect()}
    used, want = set(), {500: True}
    for k in range(120):
        mine = {t for x, t in wants if x == k}
        want[k] = not mine & used
        used |= mine if want[k] else set()
    assert got == want


def test_regions_reconciled(spark):
    columns = "id string, source_id string, source_start double, source_end double, status string, reason string, notes string, text string, language string"
    row = lambda i, a=0.0, b=1.0, status=None, text="said ", s="s", lang="en": (i, s, a if a is None else float(a), b if b is None else float(b), status, None, None, text, lang)
    regions = [row("r0"), row("r1", 1, 2), row("r2", 2, 3), row("r3", 3, 3.05), row("r4", 4, 5, text=" "), row("r5", 5, 6, "rejected"), row("r6", 6, 7), row("r7", 7, 8), row("r8", 8, 9, lang=""), row("r9", 9, 10), row("q", None, None), row("t0", 0, 1, s="t", text=None)]
    turns = frame(spark, [("u1", "s", ["r6"]), ("u2", "s", ["r7", "r9"]), ("u3", "s", ["r9"])], "id string, source_id string, source_regions array<string>")
    runs = frame(spark, [("s", 1, ["r0", "r1"]), ("s", 2, ["r1", "r2"]), ("s", 3, ["r5", "r8"]), ("s", 4, ["r6", "r7"]), ("s", 5, ["r2", "none"]), ("s", 6, ["r6"])], "source_id string, run long, region_ids array<string>")
    out = automatic.reconcile_regions(frame(spark, regions, columns), turns, runs)
    told = {(tuple(r.region_ids), r.creation == automatic.RUN_METHOD): (r.action, r.reason) for r in out.decisions.collect()}
    run, single = lambda *ids: told[ids, True], lambda i: told[(i,), False]
    assert run("r0", "r1") == ("created", None) and run("r1", "r2") == ("refused", "taken") and run("r5", "r8") == ("refused", "not pending") and run("r2", "none") == ("refused", "missing") and run("r6") == ("skipped", "reconciled")
    assert run("r6", "r7") == ("refused", "different turns")
    want = {"r0": "skipped", "r1": "skipped", "r2": "created", "r3": "unresolved", "r4": "unresolved", "r5": "skipped", "r6": "skipped", "r7": "skipped", "r8": "created", "r9": "refused", "q": "unresolved", "t0": "unresolved"}
    assert {i: single(i)[0] for i in want} == want
    made = {tuple(r.source_regions): (r.source_start, r.source_end, r.transcript, r.language) for r in out.turns.collect()}
    assert made == {("r0", "r1"): (0.0, 2.0, None, None), ("r2",): (2.0, 3.0, "said", "en"), ("r8",): (8.0, 9.0, "said", None)}
    counts = {r.source_id: (r.created, r.skipped, r.unresolved, r.refused) for r in out.counts.collect()}
    assert counts == {"s": (3, 5, 3, 5), "t": (0, 0, 1, 0)}
    states = frame(spark, [("s", 0, "merge_candidate", ["r6", "r7"], "both", "en"), ("s", 1, "merge_candidate", ["r7", "r9"], "x", None), ("s", 2, "conflict", ["r6", "r7"], "x", None), ("s", 3, "merge_candidate", ["r6"], "x", None), ("s", 4, "merge_candidate", ["r6", "r0"], "x", None)], "source string, utterance long, status string, region_ids array<string>, text string, language string")
    asked, refused = automatic.merges_of_candidates(states, frame(spark, regions, columns), turns)
    assert [(r.utterance, r.turn_ids, r.transcript) for r in asked.collect()] == [(0, ["u1", "u2"], "both")]
    assert {(r.utterance, r.reason) for r in refused.collect()} == {(1, "not reconciled"), (2, "no candidate"), (3, "one region"), (4, "not reconciled")}


CURATED = "id string, source_id string, source_start double, source_end double, source_regions array<string>, transcript string, language string, voice_id string, artifacts string, root_ids array<string>, operations array<string>, first long, last long, n_words long"


def dataset(spark):
    rows = [(f"t{k}", "s", k * 4.0, k * 4 + 4.0, [f"r{2 * k}", f"r{2 * k + 1}"], f"text {k}", "en", "v", "clip", None, None, k * 4, k * 4 + 3, 4) for k in range(6)]
    rows.append(("o", "other", 0.0, 4.0, ["z"], "other", "en", "w", "clip", None, None, 0, 3, 4))
    turns = frame(spark, rows, CURATED)
    held = frame(spark, [(r[1], r[0], r[11], r[12]) for r in rows], "source string, turn_id string, first long, last long")
    words = frame(spark, [(s, k, f"w{k}", k * 1.0, k + 0.9) for s in ("s", "other") for k in range(24)], WORDS)
    return turns, held, frame(spark, [(s, None, None, None, None) for s in ("s", "other")], SOURCES), words


def test_merges_are_components(spark, tmp_path):
    turns, held, sources, words = dataset(spark)
    asked = frame(spark, [("m1", ["t0", "t1"], "said"), ("m2", ["t1", "t2"], None), ("m3", ["t4", "t4"], None), ("m4", ["t3", "t5"], None), ("m5", ["o", "t4"], None), ("m6", ["o", "none"], None)], "request string, turn_ids array<string>, transcript string")
    out = curated.merge_and_refresh(turns, held, sources, words, asked.where("request in ('m1', 'm2', 'm3', 'm4')"), "qwen")
    assert {(r.request, r.reason) for r in out.refused.collect()} == {("m3", "one turn"), ("m4", "gap")}
    now = {r.id: r for r in out.turns.collect()}
    assert set(now) == {"t0", "t3", "t4", "t5", "o"} and [r.id for r in out.changed.collect()] == ["t0"]
    t = now["t0"]
    assert (t.source_start, t.source_end, t.source_regions, t.transcript, t.voice_id, t.artifacts, t["first"], t["last"], t.n_words) == (0.0, 12.0, [f"r{k}" for k in range(6)], "said", "v", None, 0, 11, 12)
    assert t.root_ids == ["t0", "t1", "t2"] and t.operations == ["merge:t0+t1+t2"]
    assert {(r.turn_id, r["first"], r["last"]) for r in out.turn_words.where("source = 's'").collect()} == {("t0", 0, 11), ("t3", 12, 15), ("t4", 16, 19), ("t5", 20, 23)}
    marks = {r.id: r for r in out.sources.collect()}
    assert marks["s"].marker_mode == "curated" and [tuple(x) for x in marks["s"].marker_ranges] == [(0, 11), (12, 15), (16, 19), (20, 23)] and marks["other"].marker_mode is None
    refused = curated.merge_and_refresh(turns, held, sources, words, asked.where("request in ('m5', 'm6')"), "qwen").refused
    assert {(r.request, r.reason) for r in refused.collect()} == {("m5", "missing"), ("m6", "missing")}
    assert [r.reason for r in curated.merge_and_refresh(turns, held, sources, words, asked.where("request = 'm5'"), "qwen").refused.collect()] == ["several sources"]
    catalog = Catalog(spark, str(tmp_path / "c"))
    catalog.commit({"turns": turns, "turn_words": held, "sources": sources})
    base = catalog.head()
    curated.commit(catalog, out, base)
    with pytest.raises(Conflict):
        curated.commit(catalog, out, base)
    assert catalog.read("turns").count() == 5 and catalog.read("turn_words").count() == 5


def test_splits_and_trims(spark):
    turns, held, sources, words = dataset(spark)
    regions = frame(spark, [(f"r{k}", k * 2.0, k * 2 + 2.0) for k in range(12)] + [("z", 0.0, 4.0)], "id string, source_start double, source_end double")
    asked = frame(spark, [("t1", 6.2), ("t2", 99.0), ("t3", 14.0), ("t3", 13.0), ("none", 1.0), ("t4", 16.2)], "id string, split_time double")
    out = curated.split_and_refresh(turns, held, sources, words, regions, asked, "qwen")
    assert {(r.id, r.reason) for r in out.refused.collect()} == {("t2", "outside"), ("t3", "repeated"), ("none", "missing"), ("t4", "a side without words")}
    now = {r.id: r for r in out.turns.collect()}
    assert len(now) == 8 and now["turn-000001"].transcript == "w6 w7" and now["t1"].transcript == "w4 w5" and (now["t1"].source_end, now["t1"].artifacts) == (6.2, None)
    assert (now["t1"].source_regions, now["turn-000001"].source_regions) == (["r2", "r3"], ["r3"])
    assert {(r.turn_id, r["first"], r["last"]) for r in out.turn_words.where("turn_id in ('t1', 'turn-000001')").collect()} == {("t1", 4, 5), ("turn-000001", 6, 7)}
    trims = frame(spark, [("t0", 1.2, 3.0), ("t1", 3.0, 8.0), ("t2", 9.0, 9.0), ("t3", 12.0, 12.2), ("none", 0.0, 1.0), ("t5", 20.0, 24.0), ("t5", 20.0, 23.0)], "id string, source_start double, source_end double")
    out = curated.trim_and_refresh(turns, held, sources, words, trims, "qwen", CELL)
    assert {(r.id, r.reason) for r in out.refused.collect()} == {("t1", "overlaps"), ("t2", "no range"), ("t3", "no words"), ("none", "missing"), ("t5", "repeated")}
    t = next(r for r in out.turns.collect() if r.id == "t0")
    assert (t.source_start, t.source_end, t["first"], t["last"], t.n_words, t.transcript, t.artifacts, t.voice_id) == (1.2, 3.0, 1, 2, 2, "w1 w2", None, "v")
    assert out.turns.count() == 7 and spans.sizes(out.turn_words, ["turn_id"]).where("turn_id = 't0'").first().n == 2


def test_lines_are_numbered(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 5)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{json.dumps({'id': k})}\n" if k % 7 or k % 2 else f"bad {k}\n" if k % 3 else "\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        told = {(r.file[-7], r.line): r.value for r in line_numbers(spark, str(tmp_path)).collect()}
        bad = {(r.file[-7], r.line) for r in bad_json_lines(spark, str(tmp_path), "id long").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {(name, k + 1): line for name in "ab" for k, line in enumerate((tmp_path / f"{name}.jsonl").read_text().split("\n")[:-1])}
    assert told == want and bad == {x for x, line in want.items() if line.startswith("bad")}


def test_new_ids_are_one_count(spark):
    """Ids of more rows than the ranges are sampled from follow one another, none twice."""
    rows = spark.range(20_000).select(F.xxhash64("id").alias("place"), F.repeat(F.col("id").cast("string"), 20).alias("text"))
    old = spark.range(1).select(F.lit("turn-000041").alias("id"))
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", "5")
    try:
        got = with_new_ids(rows, old, "turn", ["place"]).orderBy("place").collect()  # with the text, which a count does without
    finally:
        spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")
    assert [r.id for r in got] == [f"turn-{k:06d}" for k in range(42, 20_042)]
