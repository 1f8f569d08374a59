"""What a reviewer sees: lists with their states in words, cursors over turns, candidates with their voices.

Turns have id, source_id, source_start, source_end, assignment_status, voice_id, review_status, boundary_status, near_start, near_end, pipeline_status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.operators.curation import effective_status

ORDER = ["source_id", "source_start", "source_end", "id"]


def review_status() -> Column:
    return F.coalesce("review_status", F.lit("pending"))


def boundary_status() -> Column:
    return F.coalesce("boundary_status", F.lit("unknown"))


def boundary_text() -> Column:
    """Empty away from the source's edges, else which edge is near and how it was judged."""
    edges = F.concat_ws(" and ", F.when(F.col("near_start"), "start"), F.when(F.col("near_end"), "end"))
    return F.when(edges == "", "").otherwise(F.concat(F.lit("near source "), edges, F.lit(": "), boundary_status()))


def assignment_text() -> Column:
    return F.when(F.col("assignment_status") == "assigned", F.concat(F.lit("assigned to "), F.coalesce("voice_id", F.lit("?")))).otherwise(F.coalesce("assignment_status", F.lit("unassigned")))


def turn_list(turns: DataFrame) -> DataFrame:
    return turns.select("id", "source_id", "source_start", "source_end", assignment_text().alias("assignment"), review_status().alias("review"), boundary_text().alias("boundary"))


def region_list(regions: DataFrame, turns: DataFrame) -> DataFrame:
    """id, source_id, source_start, source_end and state: the effective one, with the turn or the reason."""
    held = turns.select(F.explode("source_regions").alias("id"), F.col("id").alias("_turn")).groupBy("id").agg(F.min("_turn").alias("_turn"))
    out = effective_status(regions, turns, "id", "status", "source_regions").join(held, "id", "left")
    said = F.when(F.col("effective") == "reconciled", F.concat(F.lit("reconciled: "), "_turn")).when(F.col("effective") == "rejected", F.concat(F.lit("rejected: "), F.coalesce("reason", F.lit("?")))).otherwise(F.col("effective"))
    return out.select("id", "source_id", "source_start", "source_end", said.alias("state"))


def voice_list(voices: DataFrame) -> DataFrame:
    return voices.select("id", F.coalesce("character", F.lit("-")).alias("character"), F.coalesce("language", F.lit("-")).alias("language"), F.array_join(F.coalesce("aliases", F.array().cast("array<string>")), ", ").alias("aliases"), F.coalesce("ignored", F.lit(False)).alias("ignored"))


def cursors(turns: DataFrame, automatic_only: bool = False) -> DataFrame:
    """source_id, id, position (from 1), the turns before and after it in its source, and the nearest pending ones before and behind it, itself where there is none.
    With `automatic_only`, turns are those that the pipeline wants reviewed and that aren't."""
    seen = turns.where((F.col("pipeline_status") == "review") & (review_status() != "reviewed")) if automatic_only else turns
    w = Window.partitionBy("source_id").orderBy(*ORDER[1:])
    pending = F.when(review_status() == "pending", F.col("id"))
    before, behind = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    return seen.select(
        "source_id", "id", F.row_number().over(w).alias("position"), F.lag("id").over(w).alias("previous"), F.lead("id").over(w).alias("next"),
        F.coalesce(F.last(pending, True).over(before), F.col("id")).alias("previous_pending"), F.coalesce(F.first(pending, True).over(behind), F.col("id")).alias("next_pending"),
    )


def merge_requests(turns: DataFrame, asked: DataFrame) -> DataFrame:
    """(into, id): each asked-for turn (id) and the one behind it in its source, to be merged into the first; one without a successor gives no rows."""
    w = Window.partitionBy("source_id").orderBy(*ORDER[1:])
    pairs = turns.withColumn("_next", F.lead("id").over(w)).join(asked.select("id"), "id", "left_semi").where("_next is not null")
    return pairs.select(F.col("id").alias("into"), F.explode(F.array("id", "_next")).alias("id"))


def candidates_view(ranked: DataFrame, voices: DataFrame, limit: int | None = None) -> DataFrame:
    """Ranked labels (query_id, label, score, rank) with their voices' names, and the score in percent; `limit` is how many are shown."""
    shown = ranked if limit is None else ranked.where(F.col("rank") <= limit)
    named = voices.select(F.col("id").alias("label"), "character", "language", F.coalesce("ignored", F.lit(False)).alias("ignored"))
    return shown.join(named, "label", "left").withColumn("percent", F.format_string("%.1f%%", F.col("score") * 100))


def review_view(turns: DataFrame, modes: DataFrame, ranked: DataFrame, voices: DataFrame, limit: int = 3) -> DataFrame:
    """One row a turn: its texts, the review mode (query_id, mode; of all candidates), and its first candidates as an array in order."""
    top = candidates_view(ranked, voices, limit).groupBy(F.col("query_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "label", "character", "score"))), lambda x: F.struct(x["label"].alias("label"), x["character"].alias("character"), x["score"].alias("score"))).alias("candidates"))
    out = turn_list(turns).join(modes.select(F.col("query_id").alias("id"), "mode"), "id", "left").join(top, "id", "left")
    return out.withColumns({"mode": F.coalesce("mode", F.lit("none")), "n_candidates": F.coalesce(F.size("candidates"), F.lit(0))})


def context_range(start: Column, end: Column, duration: Column, padding: float) -> tuple[Column, Column]:
    """A range widened for listening, inside its source."""
    return F.greatest(F.lit(0.0), start - padding), F.least(end + padding, duration)
