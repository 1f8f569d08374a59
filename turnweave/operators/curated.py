"""Turns merged, split and trimmed together with all that depends on them: regions, word sets, transcripts, provenance, clips and the marker of their source.

Tables of a catalog: turns (id, source_id, source_start, source_end, source_regions, transcript, language, voice_id, artifacts, root_ids, operations, first, last, n_words),
turn_words (source, turn_id, first, last: each turn's words as a set of ranges, `spans`), sources (id, marker_..., as `transitions.mark_complete` has them). A change is a plan of new
tables and refusals; `commit` puts its tables into a catalog in one step.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.operators import spans, transitions
from turnweave.operators.curation import merge_turns, trim_allowed
from turnweave.operators.linked import components
from turnweave.sources.catalog import Catalog, with_new_ids
from turnweave.sources.scratch import settled


class Curated(NamedTuple):
    turns: DataFrame
    turn_words: DataFrame
    sources: DataFrame
    refused: DataFrame
    changed: DataFrame  # ids of turns that are new or other than before


def commit(catalog: Catalog, plan: Curated, base: tuple[int, dict]) -> int:
    """The plan's three tables in one commit, made from the state `base` that it was planned on; nothing if another writer was faster (`Conflict`)."""
    return catalog.commit({"turns": plan.turns, "turn_words": plan.turn_words, "sources": plan.sources}, base=base)


def _curated_sources(sources: DataFrame, turns: DataFrame, touched: DataFrame, evidence: str) -> DataFrame:
    """Sources whose turns were changed by hand carry a curated marker with the word ranges that their turns have now."""
    mine = touched.select("source_id").distinct()
    ranges = turns.join(mine, "source_id", "left_semi").where("first is not null").select("source_id", "first", "last")
    marked = transitions.mark_complete(sources.join(mine, sources["id"] == mine["source_id"], "left_semi"), ranges, "curated", evidence)
    return sources.join(mine, sources["id"] == mine["source_id"], "left_anti").unionByName(marked)


def _summaries(turn_words: DataFrame, words: DataFrame) -> DataFrame:
    """id, first, last, n_words and transcript of turns' word sets."""
    held = turn_words.withColumnRenamed("turn_id", "id")
    one = words.select("source", F.col("word").alias("first"), F.col("word").alias("last"), F.trim("text").alias("_t"))
    said = F.array_sort(F.collect_list(F.when(F.col("_t") != "", F.struct("first", "_t"))))
    texts = spans.intersection(held, one, ["source"]).groupBy("source", "id").agg(F.array_join(F.transform(said, lambda x: x["_t"]), " ").alias("_text"))
    told = spans.sizes(held, ["source", "id"]).join(texts, ["source", "id"], "left")
    return told.select("id", "first", "last", F.col("n").alias("n_words"), F.when(F.col("_text") != "", F.col("_text")).alias("_said"))


def merge_and_refresh(turns: DataFrame, turn_words: DataFrame, sources: DataFrame, words: DataFrame, requests: DataFrame, evidence: str) -> Curated:
    """Merges the turns that requests (request, turn_ids; and, if they have the columns, transcript and language) name. Requests that share turns are one merge, so a+b and b+c give
    a+b+c: the groups are the connected components of the requests.

    The merged turn has the id of the group's first turn in time, the hull of ranges, all regions in order of their turns, the union of word sets, provenance of all, no clips, and no voice unless they
    agree. Its transcript is the turns' joined, or that of the only request of the group that brings one. A request is refused with its whole group where a turn is 'missing' or of
    'several sources', where it names fewer than two turns ('one turn'), or where the words of the group's turns leave a 'gap' between them, or are none ('no words')."""
    asked = requests.select("request", F.explode("turn_ids").alias("id"))
    few = requests.where(F.coalesce(F.size(F.array_distinct("turn_ids")), F.lit(0)) < 2).select("request", F.lit("one turn").alias("reason"))
    good = asked.join(few, "request", "left_anti")
    heads = good.groupBy("request").agg(F.min("id").alias("_head"))
    group = settled(components(good.join(heads, "request"), "id", "_head").withColumnRenamed("root", "into"))
    mine = group.join(turns, "id", "left")
    held = group.join(turn_words.withColumnRenamed("turn_id", "id"), "id")
    union = spans.normal(held.select("source", "into", "first", "last"), ["source", "into"])
    sets = spans.sizes(union, ["source", "into"]).groupBy("into").agg(F.sum("n").alias("_n"), F.min("first").alias("_first"), F.max("last").alias("_last"))
    checks = mine.groupBy("into").agg(F.bool_or(F.col("source_id").isNull()).alias("_missing"), (F.count_distinct("source_id") > 1).alias("_many")).join(sets, "into", "left")
    reason = F.when(F.col("_missing"), "missing").when(F.col("_many"), "several sources").when(F.col("_n").isNull(), "no words").when(F.col("_last") - F.col("_first") + 1 != F.col("_n"), "gap")
    checks = settled(checks.select("into", reason.alias("reason")))
    of_request = good.join(group, "id").select("request", "into").distinct()
    refused = few.unionByName(of_request.join(checks.where("reason is not null"), "into").select("request", "reason"))
    go = settled(mine.join(checks.where("reason is null").select("into"), "into", "left_semi"))

    order = ["source_start", "source_end", "id"]
    first = go.groupBy("into").agg(F.min_by("id", F.struct(*order)).alias("_keep"), F.first("source_id").alias("source_id"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*order, "source_regions"))), lambda x: x["source_regions"])).alias("_regions"))
    merged = merge_turns(go, ["into"], order, ("source_start", "source_end"), "voice_id", "language", "transcript").select("into", F.col("start").alias("source_start"), F.col("end").alias("source_end"), F.col("voice").alias("voice_id"), "language", "transcript")
    provenance = transitions.merged_provenance(go, ["into"], order)
    own = [c for c in ("transcript", "language") if c in requests.columns]
    brought = of_request.join(requests, "request").groupBy("into").agg(*(F.when(F.count_distinct(c) == 1, F.min(c)).alias(f"_{c}") for c in own)) if own else None
    out = first.join(merged, "into").join(provenance, "into").join(sets, "into")
    if brought is not None:
        out = out.join(brought, "into", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in own})
    values = {"id": F.col("_keep"), "source_regions": F.array_distinct("_regions"), "artifacts": F.lit(None), "first": F.col("_first"), "last": F.col("_last"), "n_words": F.col("_n")}
    kept = [c for c in turns.columns if c not in values and c in out.columns]
    kinds = dict(turns.dtypes)
    new = settled(out.select(*(values[c].cast(kinds[c]).alias(c) if c in values else F.col(c).cast(kinds[c]).alias(c) if c in kept else F.lit(None).cast(kinds[c]).alias(c) for c in turns.columns)))
    gone = go.select("id")
    all_turns = turns.join(gone, "id", "left_anti").unionByName(new)
    ranges = union.join(first.select("into", F.col("_keep").alias("turn_id")), "into").select("source", "turn_id", "first", "last")
    all_words = turn_words.join(gone.select(F.col("id").alias("turn_id")), "turn_id", "left_anti").select("source", "turn_id", "first", "last").unionByName(ranges)
    return Curated(all_turns, all_words, _curated_sources(sources, all_turns, new, evidence), refused, new.select("id"))


def split_and_refresh(turns: DataFrame, turn_words: DataFrame, sources: DataFrame, words: DataFrame, regions: DataFrame, requests: DataFrame, evidence: str) -> Curated:
    """Splits turns at requests' times (id, split_time). The left half keeps the id, the right one gets a new one; regions go to the side that they reach into, words to that of their
    middle, and both halves take the transcript of their words. Refused, beside what `split_turns` refuses: a turn that is asked for twice ('repeated'), a half without words
    ('a side without words')."""
    once = requests.groupBy("id").agg(F.count("*").alias("_n"), F.first("split_time").alias("split_time"))
    halves = transitions.split_turns(turns, regions, once.where("_n = 1").select("id", "split_time"))
    mine = settled(halves.rows)
    cut = mine.where("side = 'left'").select("split_from", F.col("source_end").alias("_cut"))
    held = turn_words.join(cut, turn_words["turn_id"] == cut["split_from"]).select("source", "split_from", "first", "last", "_cut")
    at = words.select("source", "word", ((F.col("w_start") + F.col("w_end")) / 2).alias("_middle"))
    sided = spans.intersection(held, at.select("source", F.col("word").alias("first"), F.col("word").alias("last"), "_middle"), ["source"])
    parts = settled(spans.ranges_of(sided.withColumn("side", F.when(F.col("_middle") < F.col("_cut"), "left").otherwise("right")), ["source", "split_from", "side"], "first"))
    sides = parts.groupBy("split_from").agg(F.count_distinct("side").alias("_n"))
    empty = mine.select("split_from").distinct().join(sides.where("_n = 2"), "split_from", "left_anti").select(F.col("split_from").alias("id"), F.lit("a side without words").alias("reason"))
    refused = halves.refused.unionByName(once.where("_n > 1").select("id", F.lit("repeated").alias("reason"))).unionByName(empty)
    go = mine.join(empty.select(F.col("id").alias("split_from")), "split_from", "left_anti")
    left = go.where("side = 'left'")
    right = with_new_ids(go.where("side = 'right'").drop("id"), turns, "turn", ["split_from"])
    both = settled(left.select("id", "split_from", "side", "source_start", "source_end", "source_regions", "root_ids", "operations").unionByName(right.select("id", "split_from", "side", "source_start", "source_end", "source_regions", "root_ids", "operations")))
    ranges = settled(parts.join(both.select("split_from", "side", F.col("id").alias("turn_id")), ["split_from", "side"]).select("source", "turn_id", "first", "last"))
    told = _summaries(ranges, words)
    old = turns.select(F.col("id").alias("split_from"), F.struct(*(c for c in turns.columns if c != "id")).alias("_old"))
    out = both.join(told, "id").join(old, "split_from")
    made = {c: F.col(c) for c in ("id", "source_start", "source_end", "source_regions", "root_ids", "operations", "first", "last", "n_words")} | {"transcript": F.col("_said"), "artifacts": F.lit(None)}
    kinds = dict(turns.dtypes)
    new = settled(out.select(*(made[c].cast(kinds[c]).alias(c) if c in made else F.col(f"_old.{c}").alias(c) for c in turns.columns)))
    gone = both.select(F.col("split_from").alias("id")).distinct()
    all_turns = turns.join(gone, "id", "left_anti").unionByName(new)
    all_words = turn_words.join(gone.select(F.col("id").alias("turn_id")), "turn_id", "left_anti").select("source", "turn_id", "first", "last").unionByName(ranges)
    return Curated(all_turns, all_words, _curated_sources(sources, all_turns, new, evidence), refused, new.select("id"))


def trim_and_refresh(turns: DataFrame, turn_words: DataFrame, sources: DataFrame, words: DataFrame, requests: DataFrame, evidence: str, width: int) -> Curated:
    """Sets turns' ranges of time to requests' (id, source_start, source_end). A turn keeps the words that it has and that lie in the new range with their middle; its transcript is theirs and
    its clips go. Refused: 'missing', 'repeated', 'no range' (empty or below 0), 'overlaps' (more of a neighbour than before), 'no words'."""
    once = requests.groupBy("id").agg(F.count("*").alias("_times"), F.first("source_start").alias("_s"), F.first("source_end").alias("_e"))
    spanned = turns.select("id", "source_id", "source_start", "source_end").join(once, "id", "left").withColumns({"_ns": F.coalesce("_s", "source_start"), "_ne": F.coalesce("_e", "source_end")})
    judged = trim_allowed(spanned, ["source_id"], ("source_start", "source_end"), ("_ns", "_ne"), "id", width)
    missing = once.join(turns.select("id"), "id", "left_anti").select("id", F.lit("missing").alias("reason"))
    range_ok = F.coalesce((F.col("_s") >= 0) & (F.col("_e") > F.col("_s")), F.lit(False))
    reason = F.when(F.col("_times") > 1, "repeated").when(~range_ok, "no range").when(~F.col("allowed"), "overlaps")
    asked = settled(judged.where("_times is not null").select("id", "_s", "_e", reason.alias("reason")))
    go = asked.where("reason is null").select("id", "_s", "_e")
    held = turn_words.join(go, turn_words["turn_id"] == go["id"]).select("source", "turn_id", "first", "last", "_s", "_e")
    at = words.select("source", F.col("word").alias("first"), F.col("word").alias("last"), ((F.col("w_start") + F.col("w_end")) / 2).alias("_middle"))
    kept = spans.intersection(held, at, ["source"]).where("_middle >= _s and _middle < _e")
    ranges = settled(spans.ranges_of(kept, ["source", "turn_id"], "first"))
    empty = go.join(ranges.select(F.col("turn_id").alias("id")).distinct(), "id", "left_anti").select("id", F.lit("no words").alias("reason"))
    refused = missing.unionByName(asked.where("reason is not null").select("id", "reason")).unionByName(empty)
    told = _summaries(ranges, words).join(go, "id").withColumnsRenamed({"first": "_f", "last": "_l", "n_words": "_n"})
    made = {"source_start": "_s", "source_end": "_e", "first": "_f", "last": "_l", "n_words": "_n", "transcript": "_said"}
    kinds = dict(turns.dtypes)
    both = turns.join(told, "id")
    new = settled(both.select(*(F.col(made[c]).cast(kinds[c]).alias(c) if c in made else F.lit(None).cast(kinds[c]).alias(c) if c == "artifacts" else turns[c] for c in turns.columns)))
    gone = new.select("id")
    all_turns = turns.join(gone, "id", "left_anti").unionByName(new)
    all_words = turn_words.join(gone.select(F.col("id").alias("turn_id")), "turn_id", "left_anti").select("source", "turn_id", "first", "last").unionByName(ranges)
    return Curated(all_turns, all_words, _curated_sources(sources, all_turns, new, evidence), refused, gone)
