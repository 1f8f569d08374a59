"""Sets of words as ranges of their numbers: a turn of a million words in a row is one row.

A set is rows (keys..., first, last) of ranges that neither overlap nor touch; keys name the set, `source` among them. Sets are joined by the cells of their numbers, so that
neither a long source nor a long set is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnweave.operators.evidence import suspicious, words_of_ranges
from turnweave.operators.intervals import beside, overlap_join, running_max
from turnweave.operators.speakers import WORDS_CELL

CELL = 256


def ranges_of(numbers: DataFrame, keys: list[str], word: str = "word") -> DataFrame:
    """Single numbers (keys, word), repeated or not, as a set. Rows without a number are none."""
    once = numbers.where(F.col(word).isNotNull()).select(*keys, F.col(word).cast("bigint").alias("_w")).distinct()
    near = beside(once, keys, ["_w"], ["_w"], WORDS_CELL, name="_p")
    opened = near.withColumn("_new", F.when(F.coalesce(F.col("_p._w") + 1 != F.col("_w"), F.lit(True)), F.col("_w"))).drop("_p")
    named = running_max(opened, keys, ["_w"], F.col("_new"), WORDS_CELL, "first")
    return named.groupBy(*keys, "first").agg(F.max("_w").alias("last"))


def normal(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Any ranges (keys, first, last) as a set: empty ones go, those that overlap or touch become one."""
    some = ranges.where("last >= first").select(*keys, F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"))
    order = ["first", "last"]
    reached = running_max(some, keys, order, F.col("last"), WORDS_CELL, "_reach", before_only=True)
    opened = reached.withColumn("_new", F.when(F.coalesce(F.col("_reach") + 1 < F.col("first"), F.lit(True)), F.col("first")))
    named = running_max(opened, keys, order, F.col("_new"), WORDS_CELL, "_block")
    return named.groupBy(*keys, F.col("_block").alias("first")).agg(F.max("last").alias("last"))


def _shared(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of ranges with a number in common; b's are _first and _last."""
    left = a.withColumns({"_a": F.col("first") - 0.25, "_b": F.col("last") + 0.25})
    right = b.withColumnsRenamed({"first": "_first", "last": "_last"}).withColumns({"_c": F.col("_first") - 0.25, "_d": F.col("_last") + 0.25})
    return overlap_join(left, right, on, ("_a", "_b"), ("_c", "_d"), CELL).drop("_a", "_b", "_c", "_d")


def intersection(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """What ranges of both sets with equal `on` share; other keys of both stay (their names must differ)."""
    met = _shared(a, b, on)
    return met.select(*(c for c in met.columns if c not in ("first", "last", "_first", "_last")), F.greatest("first", "_first").alias("first"), F.least("last", "_last").alias("last"))


def difference(a: DataFrame, b: DataFrame, keys: list[str], on: list[str]) -> DataFrame:
    """Of set a (keys, first, last) what no range of b (on, first, last) with equal `on` has."""
    cuts = intersection(a.withColumns({"_from": F.col("first"), "_to": F.col("last")}), normal(b.select(*on, "first", "last"), on), on)
    whole = [*keys, "_from", "_to"]
    order = Window.partitionBy(*whole).orderBy("first")
    after = cuts.withColumn("_next", F.lead("first").over(order)).select(*whole, (F.col("last") + 1).alias("first"), (F.coalesce("_next", F.col("_to") + 1) - 1).alias("last"))
    heads = cuts.groupBy(*whole).agg(F.min("first").alias("_cut")).select(*whole, F.col("_from").alias("first"), (F.col("_cut") - 1).alias("last"))
    met = [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate([*keys, "first", "last"])]
    touched = cuts.select(*(F.col(k).alias(f"_k{n}") for n, k in enumerate([*keys, "_from", "_to"]))).distinct()
    rest = a.select(*keys, "first", "last").join(touched, met, "left_anti")
    return rest.unionByName(after.unionByName(heads).where("first <= last").select(*keys, "first", "last"))


def sizes(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n (numbers), n_ranges, first, last: a set's hull; without gaps where n = last - first + 1."""
    return ranges.groupBy(*keys).agg(F.sum(F.col("last") - F.col("first") + 1).alias("n"), F.count("*").alias("n_ranges"), F.min("first").alias("first"), F.max("last").alias("last"))


def projected(ranges: DataFrame, words: DataFrame, range_id: str, span: tuple[str, str], width: int) -> DataFrame:
    """source, range_id, first, last: the words of ranges of time as a set of numbers."""
    return ranges_of(words_of_ranges(ranges, words, range_id, span, width), ["source", range_id])


def utterances_of(held: DataFrame, utterances: DataFrame, keys: list[str]) -> DataFrame:
    """keys, utterance, complete: the utterances (source, utterance, word_start, word_end) of which a set (keys, among them source) has words, and whether it has
    all."""
    whole = utterances.where("word_end > word_start").select("source", "utterance", F.col("word_start").alias("first"), (F.col("word_end") - 1).alias("last"), (F.col("word_end") - F.col("word_start")).alias("_size"))
    met = intersection(held, whole, ["source"])
    told = met.groupBy(*keys, "utterance", "_size").agg(F.sum(F.col("last") - F.col("first") + 1).alias("_n"))
    return told.select(*keys, "utterance", (F.col("_n") == F.col("_size")).alias("complete"))


def restricted(held: DataFrame, allowed: DataFrame, utterances: DataFrame, words: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(set, summary) of what a projection (keys, first, last) keeps of the allowed words (keys, first, last). The summary, for each set that keeps any: keys, first, last,
    n_words, n_suspicious, complete and touched (lists of utterances), transcript (the words' trimmed texts that aren't empty, null without any)."""
    kept = intersection(held, allowed, keys)
    told = utterances_of(kept, utterances, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("complete"), F.col("utterance")))).alias("complete"), F.array_sort(F.collect_list("utterance")).alias("touched"))
    one = words.select("source", F.col("word").alias("first"), F.col("word").alias("last"), F.trim("text").alias("_t"), suspicious().alias("_odd"))
    spoken = intersection(kept, one, ["source"])
    said = F.array_sort(F.collect_list(F.when(F.col("_t") != "", F.struct("first", "_t"))))
    texts = spoken.groupBy(*keys).agg(F.array_join(F.transform(said, lambda x: x["_t"]), " ").alias("_text"), F.count_if("_odd").alias("n_suspicious"))
    summary = sizes(kept, keys).withColumnRenamed("n", "n_words").drop("n_ranges").join(told, keys, "left").join(texts, keys, "left")
    return kept, summary.select(*keys, "first", "last", "n_words", "n_suspicious", "complete", "touched", F.when(F.col("_text") != "", F.col("_text")).alias("transcript"))
