import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.operators import alignment, curation, intervals, speakers, vectors
from turnweave.sources.catalog import Catalog, attach_by_name, import_plan, next_ids, read_json_lines, unknown_references
from turnweave.streaming import sessions


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_overlap_join_against_all_pairs(spark):
    rng = random.Random(3)
    make = lambda n: [(i, rng.choice("ab"), s := rng.randint(0, 300), s + rng.choice([0, 1, 7, 90])) for i in range(n)]
    a, b = make(60), make(60)
    got = intervals.overlap_join(frame(spark, a, "i int, k string, s long, e long"), frame(spark, b, "j int, k string, t long, f long"), ["k"], ("s", "e"), ("t", "f"), 25)
    want = {(i, j) for i, k, s, e in a for j, m, t, f in b if k == m and min(e, f) > max(s, t)}
    found = [(r.i, r.j) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)


def test_overlap_join_with_a_few_absurd_intervals(spark):
    rng = random.Random(4)
    make = lambda n: [(i, rng.choice("ab"), s := rng.randint(0, 3000), s + rng.choice([0, 1, 7, 90, 900, 40_000, 10**15])) for i in range(n)]
    a, b = make(80), make(80)
    got = intervals.overlap_join(frame(spark, a, "i int, k string, s long, e long"), frame(spark, b, "j int, k string, t long, f long"), ["k"], ("s", "e"), ("t", "f"), 2)
    want = {(i, j) for i, k, s, e in a for j, m, t, f in b if k == m and min(e, f) > max(s, t)}
    found = [(r.i, r.j) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    points = intervals.point_join(frame(spark, [(i, k, float(s)) for i, k, s, _ in a], "i int, k string, p double"), frame(spark, b, "j int, k string, t long, f long"), ["k"], "p", ("t", "f"), 2)
    want = {(i, j) for i, k, s, _ in a for j, m, t, f in b if k == m and t <= s <= f}
    found = [(r.i, r.j) for r in points.collect()]
    assert set(found) == want and len(found) == len(want)


def test_overlapping_ids_without_pairs(spark):
    """Against all pairs: spans of very different lengths, absurd ends, nulls and repeated ids; and no pair goes through a shuffle."""
    rng = random.Random(5)
    span = lambda: (a := rng.randrange(-3000, 3000), a + rng.choice([0, 1, 7, 60, 900, 40_000, 5_000_000, -5]))
    left = [(rng.choice("ab"), k, *span()) for k in range(150)] + [("a", 1000, 0, 10**15), ("a", 1001, None, 5), (None, 1002, 0, 9), ("a", 7, 3, 90), ("b", None, 0, 50), ("a", 1003, -(10**12), 0)]
    right = [(rng.choice("ab"), k, *span()) for k in range(150)] + [("a", 2000, 5, 10**15), ("b", 2001, -(10**15), 1), (None, 2002, 0, 9)]
    want = {}
    for s, i, a, b in left:
        hits = [(c, d, j) for t, j, c, d in right if s is not None and s == t and None not in (a, b) and min(b, d) > max(a, c)]
        want.setdefault((s, i), []).extend(hits)
    df = lambda rows, names: frame(spark, rows, "s string, {} long, {} long, {} long".format(*names))
    got = intervals.overlapping_ids(df(left, "iab"), df(right, "jcd"), ["s"], "i", "j", ("a", "b"), ("c", "d"), 50)
    rows = got.collect()
    assert len(rows) == len(left)
    for r in rows:
        hits = sorted(want[(r.s, r.i)]) if r.i is not None else []
        assert (r.n, r.ids) == (len(hits), ",".join(str(j) for *_, j in hits)) or r.i is None
    many = spark.range(20_000).select(F.lit("s").alias("s"), F.col("id").alias("i"), (F.col("id") * 0).alias("a"), (F.col("id") * 0 + 10).alias("b"))
    few = many.where("i < 300").withColumnsRenamed({"i": "j", "a": "c", "b": "d"})
    done = intervals.overlapping_ids(many, few, ["s"], "i", "j", ("a", "b"), ("c", "d"), 50)._jdf.queryExecution()
    assert done.toRdd().count() == 20_000
    assert max(moved(done.executedPlan())) < 20_000_000  # of 6,000,000 pairs


def test_region_conflicts_without_pairs(spark):
    words = spark.range(20_000).select(F.lit("s").alias("s"), F.col("id").alias("i"), (F.col("id") * 0).alias("a"), (F.col("id") * 0 + 300).alias("b"))
    tiles = spark.range(300).select(F.lit("s").alias("s"), F.col("id").alias("j"), F.col("id").alias("c"), (F.col("id") + 1).alias("d"), (F.col("id") % 2).cast("string").alias("l"))
    done = speakers.region_conflicts(words, tiles, ["s"], "i", ("a", "b"), ("c", "d"), "j", "l", 500).select("i", "labels")._jdf.queryExecution()
    assert done.toRdd().count() == 20_000
    assert max(moved(done.executedPlan())) < 20_000_000


def moved(plan):
    """Bytes of each shuffle of a plan that has run."""
    children = plan.children()
    below = [children.apply(i) for i in range(children.size())]
    below += [plan.executedPlan()] if plan.nodeName().startswith("AdaptiveSparkPlan") else [plan.plan()] if "QueryStage" in plan.nodeName() else []
    own = [plan.metrics().apply("dataSize").value()] if plan.nodeName() == "Exchange" else []
    return own + [n for p in below for n in moved(p)]


def test_rows_beside_and_running_values_across_cells(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.randrange(0, 200) * rng.choice([1, 40]), i, rng.randrange(100)) for i in range(150)]
    df = frame(spark, rows, "k string, s long, i int, v int")
    out = intervals.beside(intervals.beside(df, ["k"], ["s", "i"], ["i"], 7), ["k"], ["s", "i"], ["i"], 7, after=True, name="_after")
    out = intervals.running_max(out, ["k"], ["s", "i"], F.col("v"), 7, "top", before_only=True)
    out = intervals.running_sum(out, ["k"], ["s", "i"], F.col("v"), 7, "total")
    for key in "ab":
        mine = sorted((s, i, v) for k, s, i, v in rows if k == key)
        got = sorted((r.s, r.i, r["_before"] and r["_before"].i, r["_after"] and r["_after"].i, r.top, r.total) for r in out.where(F.col("k") == key).collect())
        ids = [None, *(i for _, i, _ in mine), None]
        want = [(s, i, ids[n], ids[n + 2], max((x[2] for x in mine[:n]), default=None), sum(x[2] for x in mine[: n + 1])) for n, (s, i, _) in enumerate(mine)]
        assert got == want


def test_point_on_shared_edge_lies_in_both(spark):
    points = frame(spark, [("a", 10.0)], "k string, p double")
    spans = frame(spark, [("a", 1, 0, 10), ("a", 2, 10, 20), ("a", 3, 11, 20)], "k string, id int, s long, e long")
    assert {r.id for r in intervals.point_join(points, spans, ["k"], "p", ("s", "e"), 4).collect()} == {1, 2}


def test_attribution_methods(spark):
    words = frame(spark, [("s", 1, 0, 10), ("s", 2, 20, 30), ("s", 3, 40, 50), ("s", 4, 60, 70), ("s", 5, 80, 90), ("s", 6, 5, 5)], "source string, w int, a long, b long")
    regions = frame(spark, [("s", 0, 12, "x"), ("s", 20, 25, "x"), ("s", 24, 30, None), ("s", 40, 45, "x"), ("s", 44, 50, "y"), ("s", 60, 70, None)], "source string, c long, d long, label string")
    got = {r.w: (r.speaker, r.method) for r in speakers.attribute_words(words, regions, ["source"], "w", ("a", "b"), ("c", "d"), "label", 10).collect()}
    assert got == {1: ("x", "single_overlapping_region"), 2: ("x", "consistent_overlapping_regions"), 3: (None, "conflicting_overlapping_speakers"), 4: (None, "no_speaker_label"), 5: (None, "no_overlapping_region"), 6: (None, "no_overlapping_region")}


def test_fragments_use_what_was_resolved_before(spark):
    rows = [("s", i, sp, c) for i, (sp, c) in enumerate([("x", None), (None, ["x", "y"]), (None, ["x", "y"]), (None, ["y", "z"]), ("z", None), (None, ["x", "y"])])]
    got = speakers.resolve_fragments(frame(spark, rows, "s string, i int, sp string, c array<string>"), ["s"], "i", "sp", "c").orderBy("i").collect()
    assert [r.resolved for r in got] == ["x", "x", "x", "z", "z", None]
    assert [r.step for r in got] == [None, "left", "left", "right", None, None]


def test_utterances_cut_for_each_reason(spark):
    rows = [("s", 0, 0, 1, "x", False, "a"), ("s", 1, 1, 2, "x", True, "b"), ("s", 2, 2, 3, "y", False, "c"), ("s", 3, 3, 4, None, False, "d"), ("s", 4, 50, 51, "x", False, "e")]
    got = speakers.utterances(frame(spark, rows, "s string, i int, a int, b int, sp string, sat boolean, t string"), ["s"], "i", ("a", "b"), "sp", "sat", "t", 5).orderBy("first").collect()
    assert [(r.first, r.last, r.speaker, r.end_boundary, r.text) for r in got] == [(0, 1, "x", "speaker_change+sat", "a b"), (2, 3, "y", "alignment_gap", "c d"), (4, 4, "x", "source_end", "e")]


def plan(spark, duration, regions, **more):
    """Chunks of one source; regions are (start, end, text)."""
    rows = [("s", i, a, b, t) for i, (a, b, t) in enumerate(regions)]
    blocks = speakers.speech_blocks(frame(spark, rows, "source string, id int, a double, b double, t string"), ["source"], ("a", "b"), "id", "t", 30)
    got = speakers.plan_chunks(frame(spark, [("s", float(duration))], "source string, d double"), blocks, "source", "d", **more).orderBy("index").collect()
    return [(r.start, r.end, r.boundary) for r in got]


def test_chunk_plan_cuts_behind_a_sentence(spark):
    assert plan(spark, 120, [(0.0, 49.8, "A sentence ends here."), (50.8, 110.0, "More speech")]) == [(0.0, 50.3, "sentence_gap"), (50.3, 120.0, "source_end")]


def test_chunk_plan_goes_on_to_the_first_safe_gap(spark):
    assert plan(spark, 200, [(0.0, 100.0, "long"), (101.0, 199.8, "more")]) == [(0.0, 100.5, "speech_gap"), (100.5, 200.0, "source_end")]


def test_chunk_plan_refuses_to_cut_speech(spark):
    assert plan(spark, 400, [(0.0, 390.0, "all of it")]) == [(0.0, None, "refused")]
    assert plan(spark, 230, [(0.0, 229.8, "all of it")]) == [(0.0, 230.0, "source_end")]
    assert plan(spark, 230, [(0.0, 225.0, "all of it")]) == [(0.0, 225.25, "source_gap"), (225.25, 230.0, "source_end")]


def test_chunk_plan_merges_speech_and_cuts_silence_where_it_likes(spark):
    assert plan(spark, 150, [(0.0, 70.0, "a"), (40.0, 60.0, "b."), (71.0, 149.8, "c")]) == [(0.0, 70.5, "speech_gap"), (70.5, 150.0, "source_end")]
    assert plan(spark, 300, [(0.0, 10.0, "a")]) == [(0.0, 60.0, "source_gap"), (60.0, 120.0, "source_gap"), (120.0, 180.0, "source_gap"), (180.0, 240.0, "source_gap"), (240.0, 300.0, "source_end")]
    assert plan(spark, 200, []) == [(0.0, 60.0, "source_gap"), (60.0, 120.0, "source_gap"), (120.0, 180.0, "source_gap"), (180.0, 200.0, "source_end")]
    assert plan(spark, 150, [(100.0, 140.0, "late")]) == [(0.0, 60.0, "source_gap"), (60.0, 140.25, "source_gap"), (140.25, 150.0, "source_end")]


def test_chunk_plan_against_a_plain_walk(spark):
    """Many sources, told apart, against a walk over whole lists."""
    rng = random.Random(8)
    rows, want, lengths = [], [], []
    for source in range(12):
        t, regions = rng.choice([0.0, 3.0, 90.0]), []
        for i in range(rng.randrange(0, 60)):
            end = t + rng.choice([2.0, 9.0, 30.0, 70.0])
            regions.append((t, end, rng.choice(["done.", "and"])))
            rows.append((source, i, t, end, regions[-1][2]))
            t = end + rng.choice([0.1, 0.4, 0.5, 1.5, 20.0, 150.0])
        length = t + rng.choice([0.0, 0.3, 40.0])
        lengths.append((source, length))
        cuts = [((a[1] + b[0]) / 2, a[2] == "done.") for a, b in zip(regions, regions[1:]) if b[0] - a[1] >= 0.5]
        zones = [(a[1] + 0.25, b[0] - 0.25) for a, b in zip(regions, regions[1:]) if b[0] - a[1] >= 0.5]
        if not regions:
            zones = [(0.0, length)]
        else:
            zones += [(0.0, regions[0][0] - 0.25)] * (regions[0][0] >= 0.5) + [(regions[-1][1] + 0.25, length)] * (length - regions[-1][1] >= 0.5)
        zones.sort()
        at, index = 0.0, 0
        while at < length:
            target = at + 60
            silent = [z for z in zones if z[0] <= at <= z[1] and target <= z[1]]
            low, high = max(at + 1, target - 15), min(length, target + 15)
            near = [c for c in cuts if low <= c[0] <= high]
            options = [(x, "sentence_gap") for x, s in near if s] or [(x, "speech_gap") for x, s in near] + [(target, "source_gap")] * any(a <= target <= b for a, b in zones) * (low <= target <= high)
            far = [c for c in cuts if high < c[0] <= at + 240]
            later = [(x, "sentence_gap") for x, s in far if s] or [(x, "speech_gap") for x, s in far] or [(max(a, high), "source_gap") for a, b in zones if high <= b and a <= at + 240]
            if length - at <= 75:
                end, why = length, "source_end"
            elif silent:
                end, why = (target, "source_gap") if target < length else (length, "source_end")
            elif options:
                end, why = min(options, key=lambda c: abs(c[0] - target))
            elif later:
                end, why = min(later)
            else:
                end, why = (length, "source_end") if length <= at + 240 else (None, "refused")
            want.append((source, index, at, end, why))
            if end is None:
                break
            at, index = end, index + 1
    regions = frame(spark, rows, "source int, id int, a double, b double, t string")
    got = speakers.plan_chunks(frame(spark, lengths, "source int, d double"), speakers.speech_blocks(regions, ["source"], ("a", "b"), "id", "t", 100), "source", "d").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_region_conflicts_need_exact_contiguity_and_count_missing_labels(spark):
    words = frame(spark, [("s", 1, 5, 15), ("s", 2, 25, 35)], "s string, w int, a long, b long")
    regions = frame(spark, [("s", 1, 0, 10, "x"), ("s", 2, 10, 20, None), ("s", 3, 20, 30, "x"), ("s", 4, 31, 40, "y")], "s string, r int, c long, d long, l string")
    got = speakers.region_conflicts(words, regions, ["s"], "w", ("a", "b"), ("c", "d"), "r", "l", 10).collect()
    assert [(r.w, r.region_ids, r.labels) for r in got] == [(1, "1,2", "x,<unknown>")]


def test_similar_texts(spark):
    pairs = [("hello there", "hello there"), ("abc", "xyz"), (None, ""), ("Sea-green boat!", "seagreen boat"), ("...", "..."), ("one two three four five six seven", "one two three four five six eleven")]
    got = {(r.a, r.b): r.similar for r in speakers.similar_texts(frame(spark, pairs, "a string, b string"), "a", "b").collect()}
    assert [got[p] for p in pairs] == [True, False, False, True, False, True]
    texts = ["the cat sat", "the cat sits", "a cat sat there", "the", "", "the cat, sat!"]
    rows = [(x, y) for x in texts for y in texts]
    for r in speakers.similar_texts(frame(spark, rows, "a string, b string"), "a", "b").collect():
        x, y = re.findall(r"\w+", r.a), re.findall(r"\w+", r.b)
        ratio = lambda p, q: difflib.SequenceMatcher(None, p, q, autojunk=False).ratio() if p and q else 0.0
        assert (r.token_ratio, r.char_ratio) == (ratio(x, y), ratio("".join(x), "".join(y)))


def test_text_spans_finds_every_place(spark):
    tokens = frame(spark, [("s", i, t) for i, t in enumerate("a b a b c a".split())], "s string, i long, t string")
    targets = frame(spark, [("s", 1, ["a", "b"]), ("s", 2, ["c"]), ("s", 3, []), ("s", 4, ["a", "x"])], "s string, target_id int, target array<string>")
    got = {(r.target_id, r.first, r.last) for r in alignment.text_spans(tokens, ["s"], targets, "i", "t", "target").collect()}
    assert got == {(1, 0, 1), (1, 2, 3), (2, 4, 4)}


def test_ranking_averages_the_best_three_and_breaks_ties_by_label(spark):
    refs = frame(spark, [(i, [float(x), (1 - x * x) ** 0.5], 7) for i, x in enumerate((0.9, 0.8, 0.7, 0.1))] + [(9, [1.0, 0.0], 3), (10, [1.0, 0.0], 2), (11, [0.0, 0.0], 1), (12, None, 1)], "ref_id long, vector array<double>, label long")
    asked = frame(spark, [(100, [1.0, 0.0])], "query_id long, vector array<double>")
    got = vectors.rank_voices(asked, refs).orderBy("rank").collect()
    assert [(r.label, round(r.score, 6), r.support) for r in got] == [(2, 1.0, 1), (3, 1.0, 1), (7, 0.8, 4)]
    assert vectors.rank_voices(asked.where("false"), refs).count() == 0
    named = refs.select(F.concat(F.lit("turn-"), "ref_id").alias("ref_id"), "vector", F.concat(F.lit("voice-"), "label").alias("label"))
    mine = frame(spark, [("turn-9", [1.0, 0.0]), ("turn-77", [1.0, 0.0, 0.0])], "query_id string, vector array<double>")
    assert [(r.query_id, r.label, round(r.score, 6)) for r in vectors.rank_voices(mine, named).orderBy("rank").collect()] == [("turn-9", "voice-2", 1.0), ("turn-9", "voice-7", 0.8)]
    many = vectors.rank_voices(frame(spark, [(k, [1.0, 0.0]) for k in range(100, 107)], "query_id long, vector array<double>"), refs, block=3)
    assert many.count() == 21


def test_calibration_keeps_rules_that_nobody_meets(spark):
    seen = frame(spark, [(True, 0.4, 5, 2, 2), (False, None, 5, 2, 2)], "correct boolean, margin double, support int, source_support int, encoder_count int")
    got = vectors.calibration_report(seen, (0.0, 0.5), (1,), (1,), (1,)).orderBy("minimum_margin").collect()
    assert [(r.total, r.eligible, r.precision, r.coverage) for r in got] == [(2, 1, 1.0, 0.5), (2, 0, None, 0.0)]


def test_curation(spark):
    regions = frame(spark, [("a", None), ("b", "rejected"), ("c", "rejected"), ("d", None)], "id string, status string")
    turns = frame(spark, [(["a"],), (["c"],)], "members array<string>")
    got = {r.id: r.effective for r in curation.effective_status(regions, turns, "id", "status", "members").collect()}
    assert got == {"a": "reconciled", "b": "rejected", "c": "conflict", "d": "pending"}
    same = curation.same_rows(regions, regions).first()[0]
    assert same and not curation.same_rows(regions, regions.limit(1)).first()[0]
    new = curation.update_where(regions, F.col("status") == "rejected", status=F.lit("pending"))
    assert new.where("status = 'pending'").count() == 2 and new.where("status is null").count() == 2


def test_imports(spark, tmp_path):
    old = frame(spark, [(1, "x"), (2, "y"), (4, None)], "k int, v string")
    new = frame(spark, [(1, "x"), (2, "z"), (3, "q"), (4, None), (5, "a"), (5, "b")], "k int, v string")
    assert {r.k: r.action for r in import_plan(old, new, ["k"], ["v"]).collect()} == {1: "skip", 2: "conflict", 3: "insert", 4: "skip", 5: "conflict"}
    (tmp_path / "r.jsonl").write_text('{"id": "region-000004", "source_start": 1.5}\nnot json\n')
    good, bad = read_json_lines(spark, str(tmp_path), "id string, source_start double")
    assert [r.id for r in good.collect()] == ["region-000004"] and bad.count() == 1
    assert next_ids(good, "id", "region").first().next_id == "region-000005"
    assert next_ids(frame(spark, [("region-1000000",), ("turn-7",), ("region-x",)], "id string"), "id", "region").first().next_id == "region-1000001"


def test_catalog(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "one"))
    three = frame(spark, [(1, "x"), (2, "y"), (3, None)], "id int, v string")
    assert catalog.read("turns", schema="id int, v string").count() == 0
    with pytest.raises(KeyError):
        catalog.read("turns")
    catalog.append("turns", three, key="id")
    for bad in ([(3, "z")], [(4, "z"), (4, "z")], [(None, "z")]):
        with pytest.raises(ValueError):
            catalog.append("turns", frame(spark, bad, "id int, v string"), key="id")
    assert catalog.replace("turns", three.where("id < 3")) == 2
    catalog.append("turns", frame(spark, [(9, "n")], "id int, v string"), key="id")
    assert sorted(map(tuple, catalog.read("turns").collect())) == [(1, "x"), (2, "y"), (9, "n")] and catalog.read("turns").columns == ["id", "v"]
    assert catalog.read("turns", 1).count() == 3 and catalog.versions("turns") == [1, 2]
    catalog.update("turns", frame(spark, [(2, None)], "id int, v string"))
    assert {r.id: r.v for r in catalog.read("turns").collect()} == {1: "x", 2: None, 9: "n"}
    with pytest.raises(KeyError):
        catalog.update("turns", frame(spark, [(7, "q")], "id int, v string"))
    with pytest.raises(ValueError):
        catalog.update("turns", frame(spark, [(1, "q"), (1, "r")], "id int, v string"))
    assert catalog.get("turns", 9).v == "n" and catalog.get("turns", 5) is None
    catalog.append("turns", three.where("id = 1"))
    with pytest.raises(ValueError):
        catalog.get("turns", 1)
    Catalog(spark, str(tmp_path / "two")).append("turns", three)
    assert {(r.dataset, r.id) for r in catalog.datasets("turns").collect()} == {("one", 1), ("one", 2), ("one", 9), ("two", 1), ("two", 2), ("two", 3)}
    known = frame(spark, [("a", "w1"), ("a", "w2")], "region string, name string")
    told = attach_by_name(known, frame(spark, [("a", "w1", "new"), ("b", "w1", "t")], "region string, name string, text string"), "region", "name")
    assert {(r.region, r.action) for r in told.collect()} == {("a", "skip"), ("b", "insert")}
    assert [r.region for r in unknown_references(told, "region", frame(spark, [("a",)], "id string")).collect()] == ["b"]


def test_texts(spark):
    row = frame(spark, [("Straße l’été, isn't! Été? ok",)], "t string").select(T.lexical_tokens(F.col("t")).alias("a"), T.plain_tokens(F.col("t")).alias("b"), T.sentences(F.col("t")).alias("s"), T.ends_sentence(F.col("t")).alias("e")).first()
    assert row.a == ["strasse", "l'été", "isn't", "été", "ok"]
    assert row.b == ["strasse", "lété", "isn't", "été", "ok"]
    assert [x.strip() for x in row.s] == ["Straße l’été, isn't!", "Été?", "ok"] and row.e is False


def test_sessions_stream(spark, tmp_path):
    rows = [("a", 1000), ("a", 1010), ("a", 1100), ("b", 1005), ("a", 3000)]
    frame(spark, rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("t")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    sessions.run_to_table(sessions.sessions(stream, "k", "t", "30 seconds", "1 second"), "sess", str(tmp_path / "cp"))
    assert {(r.k, r.n) for r in spark.table("sess").collect()} >= {("a", 2), ("a", 1), ("b", 1)}
    frame(spark, rows + rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("t")).coalesce(1).write.parquet(str(tmp_path / "twice"))
    twice = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "twice"))
    sessions.run_to_table(sessions.import_once(twice, ["k", "t"], "t", "1 hour"), "once", str(tmp_path / "cp2"))
    assert sorted((r.k, int(r.t.timestamp())) for r in spark.table("once").collect()) == sorted(rows)
    sessions.run_to_table(sessions.sliding_counts(stream, "k", "t", "60 seconds", "30 seconds", "1 second"), "slid", str(tmp_path / "cp3"), "complete")
    assert spark.table("slid").where("k = 'b'").agg(F.sum("n")).first()[0] == 2


def test_speaker_context_stream(spark, tmp_path):
    told = [("a", 0, "x"), ("a", 1, None), ("a", 2, None), ("b", 0, None), ("b", 1, "y"), ("a", 3, "x"), ("a", 4, None), ("a", 5, "y"), ("b", 2, None), ("b", 3, "y"), ("b", 4, None)]
    for part, rows in enumerate((told[:5], told[5:])):
        frame(spark, rows, "source string, word long, speaker string").coalesce(1).write.parquet(str(tmp_path / "in" / f"{part}.parquet"))
    stream = spark.readStream.schema("source string, word long, speaker string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    sessions.run_to_table(sessions.speaker_context(stream), "context", str(tmp_path / "cp"))
    got = {(r.source, r.word): r.filled for r in spark.table("context").collect()}
    assert got == {("a", 0): "x", ("a", 1): "x", ("a", 2): "x", ("a", 3): "x", ("a", 4): None, ("a", 5): "y", ("b", 0): None, ("b", 1): "y", ("b", 2): "y", ("b", 3): "y"}


def test_stream_that_reuses_what_is_done(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    catalog.append("done", frame(spark, [(1, "old")], "id int, text string"))
    frame(spark, [(1, 0), (2, 0), (2, 1), (3, 0)], "id int, copy int").coalesce(1).write.parquet(str(tmp_path / "in"))
    worked = []

    def compute(rows):
        worked.append(sorted(r.id for r in rows.collect()))
        return rows.select("id", F.lit("new").alias("text"))

    for k in range(2):  # the second time from the beginning, as after a lost checkpoint
        stream = spark.readStream.schema("id int, copy int").parquet(str(tmp_path / "in"))
        sessions.merge_batches(stream, str(tmp_path / f"cp{k}"), ["id"], lambda: catalog.read("done"), lambda rows: catalog.append("done", rows), compute)
    assert worked == [[2, 3], []] and {(r.id, r.text) for r in catalog.read("done").collect()} == {(1, "old"), (2, "new"), (3, "new")}
