"""Speakers' activity by frames, packed into blocks.

A recogniser gives a number for each speaker and frame, a dozen frames a second. A row a frame is mostly keys, so frames are stored in blocks of
`size`: first_frame, n_frames, n_speakers, a list a speaker with that speaker's values, the lists' sums, and a checksum. A window over many frames takes the sums of the
blocks that it covers and reads values at its two ends only.

`by` are the keys of one recording's activity. Null keys are kept as a key of their own when packing and join nothing when read. Rows that repeat a frame count as one, the one
with the smallest values. Frames that are null or negative, and blocks whose frames have different numbers of speakers, are told by `frame_problems`; `packed` leaves out the first and
gives the second nulls for the speakers that a frame lacks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.operators.intervals import Span, overlap_join, with_sides
from turnweave.operators.media import form_named
from turnweave.sources.catalog import Catalog, import_plan
from turnweave.sources.scratch import settled

SIZE = 750  # frames a block: a minute of frames of 0.08 seconds
HELD = ["first_frame", "n_frames", "n_speakers", "values", "sums"]


def _checksum(by: list[str]) -> Column:
    return F.xxhash64(*by, "block", *HELD)


def _one_a_frame(frames: DataFrame, by: list[str], frame: str, values: str) -> DataFrame:
    told = frames.select(*by, F.col(frame).cast("long").alias("_f"), F.col(values).cast("array<double>").alias("_v"))
    return told.where("_f >= 0").groupBy(*by, "_f").agg(F.min("_v").alias("_v"))


def packed(frames: DataFrame, by: list[str], frame: str, values: str, size: int = SIZE) -> DataFrame:
    """by, block, first_frame, n_frames, n_speakers, values (a list a speaker), sums (a number a speaker), checksum: a row for each run of `size` frame
    numbers that has any. Values stand close together, so frames with a gap among them, which `frame_problems` tells, must not be packed."""
    rows = _one_a_frame(frames, by, frame, values).withColumn("block", F.floor(F.col("_f") / size).cast("long"))
    held = rows.groupBy(*by, "block").agg(F.array_sort(F.collect_list(F.struct("_f", "_v"))).alias("_r"))  # `size` frames at most
    most = F.coalesce(F.array_max(F.transform("_r", lambda r: F.size(r["_v"]))), F.lit(0))
    speakers = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    lists = F.transform(speakers, lambda s: F.transform("_r", lambda r: F.get(r["_v"], s)))
    told = held.select(*by, "block", F.get("_r", F.lit(0))["_f"].alias("first_frame"), F.size("_r").alias("n_frames"), F.greatest(most, F.lit(0)).alias("n_speakers"), lists.alias("values"))
    return told.withColumn("sums", F.transform("values", _total)).withColumn("checksum", _checksum(by))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))


def unpacked(blocks: DataFrame, by: list[str]) -> DataFrame:
    """by, frame, values: the frames that were packed, of blocks without a gap."""
    rows = blocks.where("n_frames > 0").select(*by, "first_frame", "values", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1)).alias("_i"))
    return rows.select(*by, (F.col("first_frame") + F.col("_i")).alias("frame"), F.transform("values", lambda s: F.get(s, F.col("_i"))).alias("values"))


def frame_problems(frames: DataFrame, by: list[str], frame: str, values: str) -> DataFrame:
    """by and problem, the first that holds: 'no frame number', 'negative frame', 'no speakers', 'different numbers of speakers', 'not a number', 'repeated frame', 'missing
    frame'. Keys without a problem have no row."""
    v = F.col(values).cast("array<double>")
    wrong = F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = frames.select(*by, F.col(frame).cast("long").alias("_f"), F.coalesce(F.size(v), F.lit(0)).alias("_n"), wrong.alias("_w"))
    once = rows.groupBy(*by, "_f").agg(F.count(F.lit(1)).alias("_c"), F.min("_n").alias("_n"), F.max("_n").alias("_n2"), F.max("_w").alias("_w"))
    told = once.groupBy(*by).agg(
        F.max(F.col("_f").isNull()).alias("_none"), F.min("_f").alias("_f0"), F.max("_f").alias("_f1"), F.count("_f").alias("_k"), F.min("_n").alias("_n"), F.max("_n2").alias("_n2"),
        F.max("_w").alias("_w"), F.max("_c").alias("_c"),
    )
    problem = F.when(F.col("_none"), "no frame number").when(F.col("_f0") < 0, "negative frame").when(F.col("_n") < 1, "no speakers").when(F.col("_n") != F.col("_n2"), "different numbers of speakers")
    problem = problem.when(F.col("_w"), "not a number").when(F.col("_c") > 1, "repeated frame").when(F.col("_k") != F.col("_f1") + 1, "missing frame")
    return told.select(*by, problem.alias("problem")).where("problem IS NOT NULL")


def block_problems(blocks: DataFrame, by: list[str]) -> DataFrame:
    """by and problem, the first that holds of stored blocks: 'checksum' (a block isn't what was packed), 'repeated block', 'missing frame' (the blocks don't follow
    one another from frame 0 on), 'different numbers of speakers'. Sound keys have no row."""
    said = blocks.select(*by, "block", "first_frame", "n_frames", "n_speakers", (~F.col("checksum").eqNullSafe(_checksum(by))).alias("_bad"))
    told = said.groupBy(*by).agg(
        F.max("_bad").alias("_bad"), F.count("*").alias("_k"), F.count_distinct("block").alias("_b"), F.min("first_frame").alias("_f0"), F.sum("n_frames").alias("_n"),
        F.max(F.col("first_frame") + F.col("n_frames")).alias("_f1"), F.min("n_speakers").alias("_s"), F.max("n_speakers").alias("_s2"),
    )
    problem = F.when(F.col("_bad"), "checksum").when(F.col("_k") != F.col("_b"), "repeated block").when((F.col("_f0") != 0) | (F.col("_n") != F.col("_f1")), "missing frame")
    return told.select(*by, problem.when(F.col("_s") != F.col("_s2"), "different numbers of speakers").alias("problem")).where("problem IS NOT NULL")


def activity_in_windows(blocks: DataFrame, windows: DataFrame, on: list[str], window_id: str, span: Span, frame_duration: float, size: int = SIZE) -> DataFrame:
    """on, window_id, n_frames, means, dominant, dominant_activity: of each window [start, end) the mean of every speaker's activity over the frames from the one that its start lies in
    up to the one that its end lies in, that one left out, one at least, as far as there are frames, and the first speaker with the largest mean. Nulls, and 0 frames,
    where there is no frame, where the window's ends are null, and for null keys. A window id twice in a recording is one window, both spans together.

    Pairs of windows and blocks are found among blocks' headers; values are joined to those pairs only whose window ends within the block."""
    first = F.greatest(F.lit(0), F.floor(F.col(span[0]) / frame_duration)).cast("long")
    timed = windows.where(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull())
    asked = timed.select(*on, F.col(window_id).alias("_w"), first.alias("_a"), F.floor(F.col(span[1]) / frame_duration).cast("long").alias("_z"))
    asked = asked.withColumn("_z", F.greatest(F.col("_a") + 1, "_z"))
    heads = blocks.select(*on, F.col("block").alias("_block"), F.col("first_frame").alias("_c"), (F.col("first_frame") + F.col("n_frames")).alias("_d"), F.col("sums").alias("_sums"))
    pairs = overlap_join(asked, heads, on, ("_a", "_z"), ("_c", "_d"), size)
    inside = (F.col("_a") <= F.col("_c")) & (F.col("_z") >= F.col("_d"))
    whole = pairs.where(inside).select(*on, "_w", (F.col("_d") - F.col("_c")).alias("_n"), "_sums")
    cut = pairs.where(~inside).drop("_sums").join(blocks.select(*on, F.col("block").alias("_block"), "values"), [*on, "_block"])
    at, n = F.greatest("_a", "_c") - F.col("_c"), F.least("_z", "_d") - F.greatest("_a", "_c")
    part = cut.select(*on, "_w", n.alias("_n"), F.transform("values", lambda s: _total(F.slice(s, (at + 1).cast("int"), n.cast("int")))).alias("_sums"))
    flat = whole.unionByName(part).select(*on, "_w", "_n", F.posexplode("_sums").alias("_s", "_v"))
    sums = flat.groupBy(*on, "_w", "_s").agg(F.sum("_n").alias("_n"), (F.sum("_v") / F.sum("_n")).alias("_m"))
    told = sums.groupBy(*on, "_w").agg(F.max("_n").alias("n_frames"), F.array_sort(F.collect_list(F.struct("_s", "_m"))).alias("_r"), F.max_by("_s", F.struct("_m", -F.col("_s"))).alias("dominant"), F.max("_m").alias("dominant_activity"))
    told = told.select(*on, F.col("_w").alias(window_id), "n_frames", F.transform("_r", lambda x: x["_m"]).alias("means"), "dominant", "dominant_activity")
    return with_sides(windows.select(*on, window_id).distinct(), told, [*on, window_id]).withColumn("n_frames", F.coalesce("n_frames", F.lit(0)).cast("long"))


class Imported(NamedTuple):
    actions: DataFrame  # source_id, name, action: 'insert', 'skip' or 'refuse', reason
    number: int | None  # the commit, None where there was nothing to add


def import_activity(catalog: Catalog, evidence: DataFrame, frames: DataFrame, table: str = "diarization", blocks: str = "diarization_blocks", sources: str = "sources", size: int = SIZE) -> Imported:
    """Brings recognisers' evidence into a catalog: `evidence` (source_id, name, model, representation, frame_duration, and what else is to be kept, segments say)
    and its `frames` (source_id, name, frame, values). Evidence under (source_id, name) is written once. Records and blocks of all that is new go in by one
    commit, so neither is ever there without the other; equal evidence is skipped, and what differs is refused, as is evidence of a source or a representation that isn't there, with a frame
    duration that isn't positive, without frames, with unsound frames, whose stored blocks are no longer those of its record, or that comes twice and differs. The good ones
    of a batch go in all the same. Frames without evidence are left out. A record gets n_frames, n_speakers, block_size and checksum (of its blocks, in any order)."""
    base = catalog.head()
    key = ["source_id", "name"]
    made = settled(packed(frames, key, "frame", "values", size))
    problems = frame_problems(frames, key, "frame", "values")
    held = catalog.read(blocks, at=base[1]) if blocks in base[1] else made.limit(0)
    record = settled(_matched(evidence, _summary(made, key).withColumn("block_size", F.lit(size)), key))
    stored = catalog.read(table, at=base[1]) if table in base[1] else record.limit(0)
    unknown = form_named(F.col("_forms"), F.col("representation")).isNull()
    known = catalog.read(sources, at=base[1]).select(F.col("id").alias("source_id"), F.col("forms").alias("_forms"), F.lit(True).alias("_known"))
    told = _matched(record, known, ["source_id"])
    told = _matched(told, problems, key)
    told = _matched(told, import_plan(stored, record, key, [c for c in record.columns if c not in key]), key)
    told = _matched(told, block_problems(held, key).select(*key, F.lit(True).alias("_broken")), key)
    told = _matched(told, _summary(held, key).select(*key, F.col("checksum").alias("_held")), key)
    reason = F.when(F.col("_known").isNull(), "unknown source").when(unknown, "unknown representation").when(~F.coalesce(F.col("frame_duration") > 0, F.lit(False)), "frame duration")
    reason = reason.when(F.col("checksum").isNull() & F.col("problem").isNull(), "no frames").when(F.col("problem").isNotNull(), F.col("problem")).when(F.col("action") == "conflict", "different data")
    reason = reason.when((F.col("action") == "skip") & (F.col("_broken").isNotNull() | ~F.col("_held").eqNullSafe(F.col("checksum"))), "stored blocks differ").when((F.col("action") == "insert") & F.col("_held").isNotNull(), "blocks without a record")
    actions = settled(told.select(*key, F.when(reason.isNotNull(), "refuse").otherwise(F.col("action")).alias("action"), reason.alias("reason")).distinct())
    new = actions.where("action = 'insert'").select(*key)
    if new.isEmpty():
        return Imported(actions, None)
    added = {table: _those(record.dropDuplicates(key), new, key), blocks: _those(made, new, key)}
    return Imported(actions, catalog.commit(added=added, base=base))


def _summary(blocks: DataFrame, by: list[str]) -> DataFrame:
    """by, n_frames, n_speakers and checksum of each recording's blocks."""
    whole = F.sum(F.xxhash64("block", "checksum").cast("decimal(20,0)")).cast("string")
    return blocks.groupBy(*by).agg(F.sum("n_frames").alias("n_frames"), F.max("n_speakers").alias("n_speakers"), whole.alias("checksum"))


def _matched(left: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """`left`, whole, with what was found for its keys, null ones included."""
    told = found.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(c for c in found.columns if c not in keys))
    return left.join(told, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left").drop(*(f"_k_{k}" for k in keys))


def _those(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    told = keys.select(*(F.col(k).alias(f"_k_{k}") for k in on))
    return rows.join(told, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in on], "left_semi")
