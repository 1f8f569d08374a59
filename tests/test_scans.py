"""Running values and neighbours with null keys and places, operators over sources with equal numbers, sets of words, streams that close."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnweave.operators import alignment, evidence, intervals, recovery, spans, speakers
from turnweave.streaming import sessions


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


ROWS = [(s, t, k, v) for k, (s, t, v) in enumerate(
    [("a", 0, 1), ("a", 5, None), ("a", 900, 3), ("a", None, 4), ("b", 0, None), ("b", 3, 2), (None, 0, 7), (None, 2000, None), (None, None, 5), ("a", 901, None), ("b", 5000, 9), ("b", 9000, None), (None, 2001, 1)]
)]


def by_id(df, *columns):
    return {r.id: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_scans_are_windows(spark, width):
    """Over cells as over one window, rows with null keys and null places included."""
    df = frame(spark, ROWS, "s string, t long, id long, v long")
    w = Window.partitionBy("s").orderBy("t", "id")
    past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    want = df.withColumns({
        "b": F.lag("v").over(w), "a": F.lead("v").over(w), "m": F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "m0": F.max("v").over(past), "n": F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
        "n0": F.coalesce(F.sum("v").over(past), F.lit(0)), "l": F.last("v", True).over(past), "l1": F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "r": F.first("v", True).over(future),
    })
    by, order, v = ["s"], ["t", "id"], F.col("v")
    got = intervals.beside(intervals.beside(df, by, order, ["v"], width, name="b"), by, order, ["v"], width, after=True, name="a").withColumns({"b": F.col("b.v"), "a": F.col("a.v")})
    got = intervals.running_max(intervals.running_max(got, by, order, v, width, "m"), by, order, v, width, "m0", before_only=True)
    got = intervals.running_sum(intervals.running_sum(got, by, order, v, width, "n"), by, order, v, width, "n0", before_only=True)
    got = intervals.known_beside(intervals.known_beside(got, by, order, v, width, "l"), by, order, v, width, "l1", inclusive=True)
    got = intervals.known_beside(got, by, order, v, width, "r", after=True)
    columns = ["b", "a", "m", "m0", "n", "n0", "l", "l1", "r"]
    assert by_id(got, *columns) == by_id(want, *columns)


def test_a_long_source_is_many_tasks(spark):
    """A source of a million words goes through cells, more than one task works on it, and none has the lot."""
    words = spark.range(1_000_000).select(F.lit("s").alias("s"), "id", F.when(F.col("id") % 1000 == 0, F.concat(F.lit("x"), (F.col("id") / 1000).cast("int") % 2)).alias("speaker"))
    out = speakers.fill_consistent_context(words, ["s"], "id", "speaker")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would go to one task again
    try:
        parts = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 700_000
    assert out.where("filled is not null").count() == 1000
    named = words.withColumn("c", F.when(F.col("speaker").isNull(), F.array(F.lit("x0"), F.lit("x1"))))
    told = speakers.resolve_fragments(named, ["s"], "id", "speaker", "c").groupBy("step").count().collect()
    assert {r["step"]: r["count"] for r in told} == {None: 2000 - 1, "left": 998_001}


def test_users_of_scans_keep_null_keys(spark):
    rows = [(None, 0, 0, 10), (None, 1, 12, 20), ("a", 0, 0, 10), ("a", 1, None, None)]
    df = frame(spark, rows, "s string, id long, a long, b long")
    assert intervals.bounded_padding(df, ["s"], ("a", "b"), "id", 3, 5).count() == 4
    assert {(r.s, r.block_start) for r in intervals.merge_touching(df, ["s"], ("a", "b"), "id", 5).collect()} == {(None, 0), (None, 12), ("a", 0), ("a", None)}
    assert {(r.source, r.word) for r in evidence.timeline_problems(frame(spark, [(None, 0, 5.0, 6.0), (None, 1, 1.0, 2.0)], "source string, word long, w_start double, w_end double")).collect()} == {(None, 1)}
    issues = alignment.timing_issues(frame(spark, [(None, k, float(k), float(k) + (0 if k % 2 else 0.5)) for k in range(4)], "s string, i long, a double, b double"), ["s"], "i", ("a", "b"), 5, 0)
    assert {(r.s, r.issue, r.first) for r in issues.collect()} == {(None, "zero_duration", 1), (None, "zero_duration", 3)}


def test_equal_numbers_in_two_sources(spark):
    words = frame(spark, [("a", 0, 0.0, 1.0), ("b", 0, 0.0, 1.0), (None, 0, 0.0, 1.0)], "s string, word long, a double, b double")
    regions = frame(spark, [("a", 1, 0.0, 2.0, "X"), ("a", 2, 0.5, 2.0, "X"), ("b", 1, 5.0, 6.0, "Y")], "s string, region long, c double, d double, label string")
    spanned = ("a", "b"), ("c", "d")
    got = {r.s: (r.n_regions, r.speaker) for r in speakers.attribute_words(words, regions, ["s"], "word", *spanned, "label", 10).collect()}
    assert got == {"a": (2, "X"), "b": (0, None), None: (0, None)}
    assert {(r.s, r.word, r.ids) for r in intervals.overlapping_ids(words, regions, ["s"], "word", "region", *spanned, 10).collect()} == {("a", 0, "1,2"), ("b", 0, ""), (None, 0, "")}
    covered = intervals.coverage(regions, words, ["s"], "region", ("c", "d"), ("a", "b"), 10).collect()
    assert {(r.s, r.region, r.covered) for r in covered} == {("a", 1, 1.0), ("a", 2, 0.5), ("b", 1, 0.0)}
    tiles = frame(spark, [("a", 1, 0.0, 0.5, "X"), ("a", 2, 0.5, 2.0, "Y"), ("b", 1, 0.0, 2.0, "X"), ("b", 2, 2.0, 3.0, "Y")], "s string, region long, c double, d double, label string")
    met = speakers.region_conflicts(words, tiles, ["s"], "word", *spanned, "region", "label", 10).collect()
    assert [(r.s, r.word, r.region_ids) for r in met] == [("a", 0, "1,2")]
    frames = frame(spark, [("a", 0, [1.0, 0.0]), ("b", 0, [0.0, 1.0])], "s string, f long, v array<double>")
    windows = frame(spark, [("a", 1, 0.0, 0.5), ("b", 1, 0.0, 0.5)], "s string, w long, c double, d double")
    assert {(r.s, r.dominant) for r in speakers.activity_window(frames, windows, ["s"], "w", ("c", "d"), "f", "v", 1.0).collect()} == {("a", 0), ("b", 1)}
    told = frame(spark, [("a", 0, "hey", 0.0, 1.0), ("b", 0, "you", 0.0, 1.0)], "source string, word long, text string, w_start double, w_end double")
    ranges = frame(spark, [("a", 7, 0.0, 2.0), ("b", 7, 5.0, 6.0)], "source string, range long, c double, d double")
    utterances = frame(spark, [("a", 0, 0, 1), ("b", 0, 0, 1)], "source string, utterance long, word_start long, word_end long")
    held = evidence.project_ranges(ranges, told, utterances, "range", ("c", "d"), 10)
    assert {(r.source, tuple(r.words), tuple(r.complete)) for r in held.collect()} == {("a", (0,), (0,)), ("b", (), ())}
    points = evidence.midpoint_states(words, regions, ["s"], "word", F.lit(0.6), ("c", "d"), "label", 10).collect()
    assert {(r.s, r.n_regions) for r in points} == {("a", 2), ("b", 0), (None, 0)}
    heard = "source string, region_id long, r_start double, r_end double, label string, heard string"
    sides = frame(spark, [(s, k, k * 1.0, k + 1.0, "x", "t") for s in "ab" for k in range(2)], heard)
    rows = evidence.boundary_evidence(sides, told, utterances, 10).collect()
    assert {(r.source, r.left_id, r.left_text, r.right_text) for r in rows} == {("a", 0, "hey", None), ("b", 0, "you", None)}


def numbers(rows):
    out = {}
    for key, a, b in rows:
        out.setdefault(key, set()).update(range(a, b + 1))
    return {k: v for k, v in out.items() if v}


def test_sets_of_words(spark):
    rng = random.Random(1)
    schema = "source string, first long, last long"
    a, b = ([(rng.choice("xyz"), s, s + rng.randrange(-1, 400)) for s in rng.choices(range(20_000), k=40)] for _ in range(2))
    sets = [spans.normal(frame(spark, rows, schema), ["source"]) for rows in (a, b)]
    told = lambda df: numbers(map(tuple, df.select("source", "first", "last").collect()))
    want_a, want_b = numbers(a), numbers(b)
    assert told(sets[0]) == want_a
    parts = sorted(map(tuple, sets[0].collect()))
    assert all(p[0] != q[0] or p[2] + 1 < q[1] for p, q in zip(parts, parts[1:], strict=False))
    meet = {k: want_a[k] & want_b.get(k, set()) for k in want_a if want_a[k] & want_b.get(k, set())}
    assert told(spans.intersection(*sets, ["source"])) == meet
    less = {k: v - want_b.get(k, set()) for k, v in want_a.items() if v - want_b.get(k, set())}
    assert told(spans.difference(*sets, ["source"], ["source"])) == less
    flat = frame(spark, [(k, n) for k, v in want_a.items() for n in v for _ in range(1 + n % 2)] + [("x", None)], "source string, word long")
    assert sorted(map(tuple, spans.ranges_of(flat, ["source"]).select("source", "first", "last").collect())) == sorted(map(tuple, sets[0].select("source", "first", "last").collect()))
    assert {(r.source, r.n) for r in spans.sizes(sets[0], ["source"]).collect()} == {(k, len(v)) for k, v in want_a.items()}


def test_restricted_projection(spark):
    words = frame(spark, [("s", k, "  " if k == 5 else f" w{k} ", k * 1.0, k * 1.0 if k == 6 else k + 0.5) for k in range(12)], "source string, word long, text string, w_start double, w_end double")
    utterances = frame(spark, [("s", u, u * 4, u * 4 + 4) for u in range(3)], "source string, utterance long, word_start long, word_end long")
    schema = "source string, turn string, first long, last long"
    held = frame(spark, [("s", "t", 0, 8), ("s", "u", 9, 11)], schema)
    allowed = frame(spark, [("s", 3, 6), ("s", 8, 20)], "source string, first long, last long")
    met = spans.intersection(held, allowed, ["source"])
    kept, told = spans.restricted(held, met, utterances, words, ["source", "turn"])
    assert numbers((r.turn, r.first, r.last) for r in kept.collect()) == {"t": {3, 4, 5, 6, 8}, "u": {9, 10, 11}}
    got = {r.turn: (r.first, r.last, r.n_words, r.n_suspicious, r.complete, r.touched, r.transcript) for r in told.collect()}
    assert got == {"t": (3, 8, 5, 1, [], [0, 1, 2], "w3 w4 w6 w8"), "u": (9, 11, 3, 0, [], [2], "w9 w10 w11")}
    both = spans.utterances_of(frame(spark, [("s", "v", 4, 9)], schema), utterances, ["source", "turn"]).collect()
    assert {(r.utterance, r.complete) for r in both} == {(1, True), (2, False)}


def test_claims_in_chains(spark):
    """Chains of spans are decided as one list in order would be."""
    rng = random.Random(8)
    rows = []
    for k in range(300):
        first = rng.randrange(3000) if k % 3 else rng.randrange(200)
        rows.append((rng.choice("ab"), first, first + rng.randrange(12), f"r{k}", rng.randrange(3)))
    df = frame(spark, rows, "source string, first long, last long, region_id string, kind int")
    for order in (["first", "last", "region_id"], ["kind", "region_id"]):
        got = {r.region_id for r in recovery.without_overlaps(df, order).collect()}
        index = {"first": 1, "last": 2, "region_id": 3, "kind": 4}
        want, used = set(), set()
        for r in sorted(rows, key=lambda r: [r[index[c]] for c in order]):
            mine = {(r[0], n) for n in range(r[1], r[2] + 1)}
            if not mine & used:
                used |= mine
                want.add(r[3])
        assert got == want


def test_context_stream_that_closes(spark, tmp_path):
    """Words out of order, told twice, and what waits when a source ends."""
    told = [[("a", 2, None, False), ("a", 0, "x", False), ("b", 1, "y", False)], [("a", 1, None, False), ("a", 3, "x", False), ("a", 0, "z", False), ("a", 4, None, False)], [("a", 6, None, True), ("a", 5, None, False), ("b", 0, None, False), ("c", 0, None, True)]]
    for part, rows in enumerate(told):
        frame(spark, rows, "source string, word long, speaker string, ended boolean").coalesce(1).write.parquet(str(tmp_path / "in" / f"{part}.parquet"))
    stream = spark.readStream.schema("source string, word long, speaker string, ended boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    sessions.run_to_table(sessions.speaker_context(stream), "closing", str(tmp_path / "cp"))
    got = [(r.source, r.word, r.filled) for r in spark.table("closing").collect()]
    assert sorted(got) == [("a", 0, "x"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("a", 4, None), ("a", 5, None), ("b", 0, None), ("b", 1, "y")]


def test_speech_sessions_stream(spark, tmp_path):
    batches = [[("a", 10.0, 20.0), ("a", 30.0, 40.0), ("b", 5.0, 6.0)], [("a", 19.0, 30.0), ("a", 50.0, 50.0), ("a", 100.0, 101.0)], [("b", 500.0, 501.0), ("a", 500.0, 501.0)], [("b", 900.0, 901.0)]]
    for part, rows in enumerate(batches):
        frame(spark, rows, "source string, start double, end double").withColumn("t", F.timestamp_micros((F.col("start") * 1e6).cast("long"))).coalesce(1).write.parquet(str(tmp_path / "in" / f"{part}.parquet"))
    stream = spark.readStream.schema("source string, start double, end double, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    sessions.run_to_table(sessions.speech_sessions(stream, "t", "30 seconds"), "speech", str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.table("speech").collect()}
    assert got >= {("a", 10.0, 40.0, 3), ("b", 5.0, 6.0, 1), ("a", 100.0, 101.0, 1)} and not [r for r in got if r[1] == r[2]]
