"""Turns as they are reconciled, merged, split, trimmed and reviewed: DataFrames in, DataFrames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.operators.intervals import Span, beside


def effective_status(regions: DataFrame, turns: DataFrame, region_id: str, status: str, members: str) -> DataFrame:
    """Adds effective: 'reconciled' for a region that one turn uses, else its own status or 'pending'. A region that two turns use,
    or that is rejected and used, is 'conflict'."""
    used = turns.select(F.explode(members).alias(region_id)).groupBy(region_id).agg(F.count("*").alias("_n"))
    own = F.coalesce(F.col(status), F.lit("pending"))
    n = F.coalesce("_n", F.lit(0))
    effective = F.when((n > 1) | ((n > 0) & (own == "rejected")), "conflict").when(n == 1, "reconciled").otherwise(own)
    return regions.join(used, region_id, "left").withColumn("effective", effective).drop("_n")


def merge_turns(turns: DataFrame, into: list[str], order: list[str], span: Span, voice: str, language: str, text: str) -> DataFrame:
    """One row per group `into`: hull, n_turns, voice (if there is but one), n_voices, language (if unanimous), transcript
    (trimmed texts in order, joined by a space, empty ones left out)."""
    said = F.struct(*order, F.trim(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    out = turns.groupBy(*into).agg(
        F.min(span[0]).alias("start"), F.max(span[1]).alias("end"), F.count("*").alias("n_turns"), F.count_distinct(voice).alias("n_voices"), F.min(voice).alias("_v"),
        F.when((F.min(language) == F.max(language)) & (F.count(language) == F.count("*")), F.min(language)).alias("language"), F.array_sort(F.collect_list(said)).alias("_t"),
    )
    joined = F.array_join(F.filter(F.transform("_t", lambda x: x["t"]), lambda t: t != ""), " ")
    return out.select(*into, "start", "end", "n_turns", F.when(F.col("n_voices") == 1, F.col("_v")).alias("voice"), "n_voices", "language", joined.alias("transcript"))


def split_regions(regions: DataFrame, cut: Column, span: Span) -> DataFrame:
    """Adds side: regions that start before the cut go left, those that end after it go right, those that do both to both."""
    sides = F.array_compact(F.array(F.when(F.col(span[0]) < cut, "left"), F.when(F.col(span[1]) > cut, "right")))
    return regions.withColumn("side", F.explode(sides))


def word_side(span: Span, cut: Column) -> Column:
    """The side of a word that both halves have: that of its middle."""
    return F.when((F.col(span[0]) + F.col(span[1])) / 2 < cut, "left").otherwise("right")


def trim_allowed(turns: DataFrame, by: list[str], span: Span, new: Span, tie: str, width: int, slack: float = 0) -> DataFrame:
    """Adds allowed: the new range is not empty or negative, and overlaps neither neighbour more than the old one did."""
    order = [*span, tie]
    turns = beside(beside(turns, by, order, [span[1]], width, name="_before"), by, order, [span[0]], width, after=True, name="_after")
    before, after = F.col(f"_before.{span[1]}"), F.col(f"_after.{span[0]}")
    grew = lambda old, now: F.coalesce(F.greatest(now, F.lit(0)) > F.greatest(old, F.lit(0)) + slack, F.lit(False))
    worse = grew(before - F.col(span[0]), before - F.col(new[0])) | grew(F.col(span[1]) - after, F.col(new[1]) - after)
    return turns.withColumn("allowed", (F.col(new[0]) >= 0) & (F.col(new[1]) > F.col(new[0])) & ~worse).drop("_before", "_after")


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Rows with columns replaced where the condition holds; elsewhere, and where it is null, they stay."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()})


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: whether both have the same rows, repeated ones as often."""
    gone = left.exceptAll(right).limit(1).select(F.lit(1).alias("x"))
    new = right.exceptAll(left).limit(1).select(F.lit(1).alias("x"))
    return gone.union(new).agg((F.count("*") == 0).alias("same"))
