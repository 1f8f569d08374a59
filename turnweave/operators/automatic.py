"""Regions that become turns by themselves: runs that a word goes through, then single regions with a usable transcript; and turns that a transcript's utterance makes one."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.operators.curation import effective_status
from turnweave.operators.linked import chosen_in_order
from turnweave.sources.scratch import settled

# How such turns are made, and the seconds that a region must last.
RUN_METHOD, REGION_METHOD = "automatic_continuous_word_fragmentation", "automatic_transcript_reconciliation"
LEAST = 0.1


class Reconciled(NamedTuple):
    turns: DataFrame  # source_id, source_start, source_end, source_regions, transcript, language, creation; without ids
    decisions: DataFrame  # source_id, region_ids, creation, action, reason
    counts: DataFrame  # source_id, created, skipped, unresolved, refused


def reconcile_regions(regions: DataFrame, turns: DataFrame, runs: DataFrame) -> Reconciled:
    """Regions (id, source_id, source_start, source_end, status, reason, text, language), turns (source_regions) and fragment runs (source_id, run, region_ids) of all sources.

    Runs come first, in order of their number. A run becomes a turn without a transcript if all its regions are pending and none is in an earlier run of this time; it is
    'skipped' if one turn has them all ('reconciled'), and refused if they belong to several turns ('different turns'), if one isn't pending ('not pending'), isn't there ('missing')
    or went to an earlier run ('taken'). Then every region that no run took: used and rejected ones are 'skipped', shorter ones than LEAST and those without text
    'unresolved', a region that two turns use refused ('conflict'); the others become turns. Each region is used once. Null keys and times are 'unresolved'."""
    state = settled(effective_status(regions, turns, "id", "status", "source_regions").select("id", "source_id", "source_start", "source_end", "text", "language", F.col("effective").alias("state")))
    owner = turns.withColumn("_turn", F.monotonically_increasing_id()).select("_turn", F.explode("source_regions").alias("id"))
    flat = runs.select("source_id", "run", "region_ids", F.explode("region_ids").alias("id"))
    met = flat.join(state.drop("source_id", "text", "language"), "id", "left").join(settled(owner).groupBy("id").agg(F.min("_turn").alias("_turn")), "id", "left")
    told = met.groupBy("source_id", "run", "region_ids").agg(
        F.bool_or(F.col("state").isNull()).alias("_missing"), F.bool_and(F.col("state") == "reconciled").alias("_used"), F.count_distinct("_turn").alias("_turns"), F.bool_and(F.col("state") == "pending").alias("_free"),
        F.min("source_start").alias("source_start"), F.max("source_end").alias("source_end"),
    )
    action = F.when(F.col("_missing"), "missing").when(F.col("_used") & (F.col("_turns") == 1), "reconciled").when(F.col("_used"), "different turns").when(~F.col("_free"), "not pending")
    told = settled(told.withColumn("_why", action))
    wanted = told.where("_why is null").select(F.struct("source_id", "run").alias("request"), "run", F.explode("region_ids").alias("id"))
    got = chosen_in_order(wanted, "request", "id", ["run"]).select("request.*", "taken")
    ranked = told.join(got, ["source_id", "run"], "left").withColumn("_why", F.when(F.col("taken") == F.lit(False), "taken").otherwise(F.col("_why")))
    ranked = settled(ranked.withColumn("action", F.when(F.col("_why").isNull(), "created").when(F.col("_why") == "reconciled", "skipped").otherwise("refused")))
    made = ranked.where("action = 'created'")
    by_run = ranked.select("source_id", "region_ids", F.lit(RUN_METHOD).alias("creation"), "action", F.col("_why").alias("reason"))

    taken = made.select(F.explode("region_ids").alias("id")).distinct().withColumn("_taken", F.lit(True))
    text = F.trim("text")
    length = F.col("source_end") - F.col("source_start")
    single = state.join(taken, "id", "left")
    why = F.when(F.col("_taken"), "reconciled").when(F.col("state").isin("reconciled", "rejected", "conflict"), F.col("state")).when(~F.coalesce(length >= LEAST, F.lit(False)), "short").when(F.coalesce(text, F.lit("")) == "", "no text").when(F.col("source_id").isNull(), "no source")
    single = single.withColumn("_why", why)
    single = settled(single.withColumn("action", F.when(F.col("_why").isNull(), "created").when(F.col("_why").isin("reconciled", "rejected"), "skipped").when(F.col("_why") == "conflict", "refused").otherwise("unresolved")))
    by_region = single.select("source_id", F.array("id").alias("region_ids"), F.lit(REGION_METHOD).alias("creation"), "action", F.col("_why").alias("reason"))

    none = F.lit(None).cast("string")
    new = made.select("source_id", "source_start", "source_end", F.col("region_ids").alias("source_regions"), none.alias("transcript"), none.alias("language"), F.lit(RUN_METHOD).alias("creation"))
    language = F.when(F.col("language") != "", F.col("language"))
    new = new.unionByName(single.where("action = 'created'").select("source_id", "source_start", "source_end", F.array("id").alias("source_regions"), text.alias("transcript"), language.alias("language"), F.lit(REGION_METHOD).alias("creation")))
    decisions = by_run.unionByName(by_region)
    # A run that is used already counts for nothing, as its regions are skipped one by one.
    counted = by_run.where("action <> 'skipped'").unionByName(by_region)
    counts = counted.groupBy("source_id").agg(*(F.count_if(F.col("action") == a).alias(a) for a in ("created", "skipped", "unresolved", "refused")))
    return Reconciled(new, decisions, counts)


def merges_of_candidates(states: DataFrame, regions: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests, refused) for utterances that are merge candidates (source, utterance, status, region_ids in order, text, language): requests are source, utterance, turn_ids (each turn of
    the regions once, in order), transcript, language. Refused, with a reason: 'no candidate', 'one region', 'not reconciled' (a region is pending, rejected, in conflict or not there),
    'one turn'."""
    state = effective_status(regions, turns, "id", "status", "source_regions").select("id", F.col("effective").alias("_state"))
    owner = turns.select(F.col("id").alias("_turn"), F.explode("source_regions").alias("id"))
    flat = states.select("source", "utterance", F.posexplode("region_ids").alias("_at", "id")).join(state, "id", "left").join(owner, "id", "left")
    told = flat.groupBy("source", "utterance").agg(F.bool_and(F.coalesce(F.col("_state") == "reconciled", F.lit(False))).alias("_all"), F.array_sort(F.collect_list(F.struct("_at", "_turn"))).alias("_t"))
    out = states.join(told, ["source", "utterance"], "left").withColumn("turn_ids", F.array_distinct(F.transform("_t", lambda x: x["_turn"])))
    reason = F.when(~F.col("status").eqNullSafe("merge_candidate"), "no candidate").when(F.coalesce(F.size("region_ids"), F.lit(0)) < 2, "one region").when(~F.coalesce("_all", F.lit(False)), "not reconciled").when(F.size("turn_ids") < 2, "one turn")
    out = out.withColumn("reason", reason)
    return out.where("reason is null").select("source", "utterance", "turn_ids", F.col("text").alias("transcript"), "language"), out.where("reason is not null").select("source", "utterance", "reason")
