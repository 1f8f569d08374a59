"""Frames of speakers' activity: packed, checked, read by windows, and brought into a catalog with their record."""

import math
import random

import pytest
from pyspark.sql import functions as F

from turnweave.operators import activity, speakers
from turnweave.sources.catalog import Catalog, Conflict

KEY = ["source_id", "name"]
FRAMES = "source_id string, name string, frame long, values array<double>"
EVIDENCE = "source_id string, name string, model string, representation string, frame_duration double, segments array<struct<start:double,end:double,label:string>>"


def made(source, name, n, shift=0.0, speakers_=3):
    rng = random.Random(f"{source}{name}{n}")
    return [(source, name, f, [round(rng.random() + shift, 3) for _ in range(speakers_)]) for f in range(n)]


def plain(rows, windows, duration):
    """Each window's frames, means and first loudest speaker."""
    out = {}
    for source, wid, start, end in windows:
        held = [v for s, _, f, v in rows if s == source]
        out[(source, wid)] = (0, None, None)
        if source is None or start is None or end is None:
            continue
        first = max(0, math.floor(start / duration))
        chosen = held[first : max(first + 1, math.floor(end / duration))]
        if chosen:
            means = [sum(x) / len(chosen) for x in zip(*chosen, strict=True)]
            out[(source, wid)] = (len(chosen), [round(m, 9) for m in means], means.index(max(means)))
    return out


@pytest.mark.parametrize("size", [1, 7, 750])
def test_windows_over_blocks(spark, size):
    rows = made("a", "d", 100) + made("b", "d", 13, 0.5)
    rng = random.Random(3)
    windows = [(s, k, t := rng.uniform(-2, 11), t + rng.choice([0, 0.01, 0.3, 4, 30])) for s in ("a", "b", "c") for k in range(12)]
    windows += [("a", 90, 0.0, 1e12), ("a", 91, None, 1.0), ("a", 92, 1.0, None), (None, 93, 0.0, 1.0), ("a", 94, 9.9, 9.9), ("a", 95, 10.0, 11.0), ("a", 96, 5.0, 2.0), ("a", 97, -5.0, -4.0)]
    frames = spark.createDataFrame(rows, FRAMES)
    asked = spark.createDataFrame(windows, "source_id string, w long, s double, e double")
    blocks = activity.packed(frames, KEY, "frame", "values", size)
    assert blocks.count() == math.ceil(100 / size) + math.ceil(13 / size)
    back = activity.unpacked(blocks, KEY)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    got = {(r.source_id, r.w): (r.n_frames, r.means and [round(m, 9) for m in r.means], r.dominant) for r in activity.activity_in_windows(blocks, asked, ["source_id"], "w", ("s", "e"), 0.1, size).collect()}
    assert got == plain(rows, windows, 0.1)
    short = asked.where("e < 1000 AND s > -3 AND s <= e")
    same = {(r.source_id, r.w): r.dominant for r in speakers.activity_window(frames.drop("name"), short, ["source_id"], "w", ("s", "e"), "frame", "values", 0.1).collect()}
    assert {k: got[k][2] for k in same} == same


def test_ties_repeated_rows_and_empty_tables(spark):
    frames = spark.createDataFrame([("a", "d", 0, [0.5, 0.5]), ("a", "d", 0, [0.5, 0.5]), ("a", "d", 1, [0.5, 0.5])], FRAMES)
    windows = spark.createDataFrame([("a", 1, 0.0, 9.0), ("a", 1, 0.0, 9.0)], "source_id string, w long, s double, e double").withColumn("values", F.lit("clash")).withColumn("block", F.lit(1))
    blocks = activity.packed(frames.withColumn("block", F.lit(5)).withColumn("sums", F.lit("x")), KEY, "frame", "values", 10)
    assert [(r.n_frames, r.n_speakers) for r in blocks.collect()] == [(2, 2)]
    got = activity.activity_in_windows(blocks, windows.limit(1), ["source_id"], "w", ("s", "e"), 1.0, 10).collect()
    assert [(r.n_frames, r.dominant, r.means) for r in got] == [(2, 0, [0.5, 0.5])]
    none = frames.limit(0)
    empty = activity.packed(none, KEY, "frame", "values")
    assert empty.count() == 0 and activity.frame_problems(none, KEY, "frame", "values").count() == 0 and activity.block_problems(empty, KEY).count() == 0
    assert [(r.n_frames, r.dominant) for r in activity.activity_in_windows(empty, windows, ["source_id"], "w", ("s", "e"), 1.0).collect()] == [(0, None)]
    assert activity.activity_in_windows(blocks, windows.limit(0), ["source_id"], "w", ("s", "e"), 1.0).count() == 0


def test_frame_problems(spark):
    bad = {
        "no frame number": [(None, [1.0]), (0, [1.0])],
        "negative frame": [(-1, [1.0]), (0, [1.0])],
        "no speakers": [(0, []), (1, [1.0])],
        "different numbers of speakers": [(0, [1.0]), (1, [1.0, 2.0])],
        "not a number": [(0, [1.0, float("nan")]), (1, [1.0, 2.0])],
        "repeated frame": [(0, [1.0]), (0, [1.0])],
        "missing frame": [(0, [1.0]), (2, [1.0])],
    }
    rows = [(name, "d", f, v) for name, held in bad.items() for f, v in held] + [("null list", "d", 0, None), ("null value", "d", 0, [None]), (None, "d", 1, [1.0]), ("good", "d", 0, [1.0])]
    got = {r.source_id: r.problem for r in activity.frame_problems(spark.createDataFrame(rows, FRAMES), KEY, "frame", "values").collect()}
    assert got == {**{name: name for name in bad}, "null list": "no speakers", "null value": "not a number", None: "missing frame"}


def test_block_problems(spark):
    blocks = activity.packed(spark.createDataFrame(made("a", "d", 30), FRAMES), KEY, "frame", "values", 10)
    assert activity.block_problems(blocks, KEY).count() == 0
    changed = blocks.withColumn("values", F.when(F.col("block") == 1, F.reverse("values")).otherwise(F.col("values")))
    moved = blocks.withColumn("source_id", F.lit("b"))
    for wrong, why in ((changed, "checksum"), (moved, "checksum"), (blocks.union(blocks.where("block = 2")), "repeated block"), (blocks.where("block <> 1"), "missing frame"), (blocks.where("block > 0"), "missing frame")):
        assert [r.problem for r in activity.block_problems(wrong, KEY).collect()] == [why]


def catalog_with_sources(spark, root):
    catalog = Catalog(spark, str(root))
    form = "map<string,struct<media_start:double,purposes:array<string>>>"
    catalog.append("sources", spark.createDataFrame([("a", {"mono": (0.0, ["asr"])}), ("b", {"mono": (0.0, ["asr"])}), ("c", None)], f"id string, forms {form}"), "id")
    return catalog


def said(result):
    return {(r.source_id, r.name): (r.action, r.reason) for r in result.actions.collect()}


def test_activity_is_imported_once_with_its_record(spark, tmp_path):
    catalog = catalog_with_sources(spark, tmp_path)
    row = lambda source, name="d", model="m", form="mono", duration=0.08: (source, name, model, form, duration, [(0.0, 1.0, "S0")])
    evidence = [row("a"), row("a"), row("b", "x"), row("z"), row("c"), row("a", "bad duration", duration=0.0), row("b", "no frames"), row("b", "holes"), row("a", "twice"), row("a", "twice", "other"), (None, "d", "m", "mono", 0.08, None)]
    frames = made("a", "d", 25) + made("b", "x", 5) + made("z", "d", 2) + made("c", "d", 2) + made("a", "bad duration", 2) + made("a", "twice", 2) + [("b", "holes", 3, [1.0])] + made("b", "stray", 4)
    frames = spark.createDataFrame(frames, FRAMES)
    first = activity.import_activity(catalog, spark.createDataFrame(evidence, EVIDENCE), frames, size=10)
    assert said(first) == {
        ("a", "d"): ("insert", None), ("b", "x"): ("insert", None), ("z", "d"): ("refuse", "unknown source"), ("c", "d"): ("refuse", "unknown representation"), ("a", "bad duration"): ("refuse", "frame duration"),
        ("b", "no frames"): ("refuse", "no frames"), ("b", "holes"): ("refuse", "missing frame"), ("a", "twice"): ("refuse", "different data"), (None, "d"): ("refuse", "unknown source"),
    }
    assert {(r.source_id, r.name, r.n_frames, r.n_speakers, r.block_size) for r in catalog.read("diarization").collect()} == {("a", "d", 25, 3, 10), ("b", "x", 5, 3, 10)}
    assert {(r.source_id, r.name, r.block, r.n_frames) for r in catalog.read("diarization_blocks").collect()} == {("a", "d", 0, 10), ("a", "d", 1, 10), ("a", "d", 2, 5), ("b", "x", 0, 5)}
    head = catalog.head()[0]

    again = spark.createDataFrame([row("a"), row("b", "x", "other"), row("b", "new")], EVIDENCE)
    second = activity.import_activity(catalog, again.where("name <> 'new'"), frames, size=10)
    assert said(second) == {("a", "d"): ("skip", None), ("b", "x"): ("refuse", "different data")} and second.number is None and catalog.head()[0] == head
    other = spark.createDataFrame(made("a", "d", 25, 1.0) + made("b", "new", 3), FRAMES)
    third = activity.import_activity(catalog, again.where("model <> 'other'"), other, size=10)
    assert said(third) == {("a", "d"): ("refuse", "different data"), ("b", "new"): ("insert", None)}
    assert catalog.read("diarization_blocks").where("source_id = 'a'").count() == 3 and catalog.read("diarization").count() == 3


def test_records_and_blocks_that_no_longer_agree(spark, tmp_path):
    catalog = catalog_with_sources(spark, tmp_path)
    evidence = spark.createDataFrame([("a", "d", "m", "mono", 0.08, None)], EVIDENCE)
    frames = spark.createDataFrame(made("a", "d", 25), FRAMES)
    activity.import_activity(catalog, evidence, frames, size=10)
    blocks = catalog.read("diarization_blocks")
    catalog.replace("diarization_blocks", blocks.where("block < 2"))
    assert said(activity.import_activity(catalog, evidence, frames, size=10)) == {("a", "d"): ("refuse", "stored blocks differ")}
    catalog.commit({"diarization_blocks": blocks, "diarization": catalog.read("diarization").limit(0)})
    assert said(activity.import_activity(catalog, evidence, frames, size=10)) == {("a", "d"): ("refuse", "blocks without a record")}


def test_a_writer_who_was_overtaken_adds_nothing(spark, tmp_path, monkeypatch):
    catalog = catalog_with_sources(spark, tmp_path)
    evidence, frames = spark.createDataFrame([("a", "d", "m", "mono", 0.08, None)], EVIDENCE), spark.createDataFrame(made("a", "d", 3), FRAMES)
    base = catalog.head()
    catalog.append("sources", spark.createDataFrame([("q", None)], catalog.read("sources").schema), "id")
    monkeypatch.setattr(catalog, "head", lambda seen=[base]: seen.pop() if seen else Catalog.head(catalog))
    with pytest.raises(Conflict):
        activity.import_activity(catalog, evidence, frames)
    assert not {"diarization", "diarization_blocks"} & set(Catalog(spark, str(tmp_path)).head()[1])
