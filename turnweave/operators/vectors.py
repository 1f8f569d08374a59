"""Vector similarity, voice ranking and calibration of decision rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2_000  # vectors in a block; a task holds one block of queries and one of references at a time


def cosine(left: Column, right: Column) -> Column:
    """In doubles; null where a length is 0 or the dimensions differ."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(left) == F.size(right), F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))))


def _matrix(lists: pa.Array) -> np.ndarray:
    if len(lists) == 0:
        return np.zeros((0, 0))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _pair_scores(top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a block of queries and one of references in; (query, label, its references here, its `top` best similarities) out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                asked, refs = batch.column("asked")[k].values, batch.column("refs")[k].values
                q, x = _unit(asked.field("vector")), _unit(refs.field("vector"))
                labels = refs.field("label").dictionary_encode()
                score = q @ x.T
                own = asked.field("hash").to_numpy()[:, None] == refs.field("hash").to_numpy()[None, :]
                score[own] = -np.inf
                code = labels.indices.to_numpy()
                for c in np.unique(code):
                    mine = np.flatnonzero(code == c)
                    part, n = score[:, mine], (~own[:, mine]).sum(1)
                    best = -np.sort(-part, axis=1)[:, :top]
                    rows = np.flatnonzero(n)
                    held = np.minimum(n[rows], best.shape[1])
                    flat = best[rows][np.arange(best.shape[1])[None, :] < held[:, None]]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)), pa.int32()), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([asked.field("id").take(pa.array(rows)), pa.array([labels.dictionary[int(c)].as_py()] * len(rows), labels.dictionary.type), pa.array(n[rows].astype(np.int64)), lists], names=["query_id", "label", "n", "best"])

    return run


def _unit(lists: pa.Array) -> np.ndarray:
    x = _matrix(lists)
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def _packed(vectors: DataFrame, on: list[str], size: int, name: str, *columns: str) -> DataFrame:
    """(on, _dim, `name`_block, blocks, `name`): vectors dealt into blocks of about `size` by a hash of their id."""
    blocks = vectors.groupBy(*on, "_dim").agg(F.ceil(F.count("*") / size).alias("blocks"))
    dealt = vectors.join(blocks, [*on, "_dim"]).withColumn(f"{name}_block", F.pmod(F.xxhash64("id"), "blocks"))
    return dealt.groupBy(*on, "_dim", f"{name}_block", "blocks").agg(F.collect_list(F.struct("id", F.xxhash64("id").alias("hash"), "vector", *columns)).alias(name))


def rank_voices(queries: DataFrame, references: DataFrame, top: int = 3, block: int = BLOCK, on: list[str] | None = None) -> DataFrame:
    """query_id, label, score (mean of its `top` best similarities), support (number of references) and rank by (-score, label).

    `queries` has (query_id, vector), `references` (ref_id, vector, label), ids and labels of any type; a vector is never compared
    with itself (equal ids). `on` names columns (encoder, model, representation) that must agree; dimensions always must. Vectors of length
    0, null vectors and null labels are left out.

    Both sides are packed into blocks, and each block of references meets each block of queries as one row: two matrices, whose product
    leaves the task as each query's few best for a label.
    """
    on = on or []
    live = lambda df: df.where(F.col("vector").isNotNull() & F.exists("vector", lambda x: x != 0)).withColumn("_dim", F.size("vector"))
    asked = live(queries.select(*on, F.col("query_id").alias("id"), F.col("vector").cast("array<double>").alias("vector")))
    refs = live(references.where("label is not null").select(*on, F.col("ref_id").alias("id"), F.col("vector").cast("array<double>").alias("vector"), "label"))
    q = _packed(asked, on, block, "asked").drop("blocks")
    counts = asked.groupBy(*on, "_dim").agg(F.ceil(F.count("*") / block).alias("_asked"))
    r = _packed(refs, on, block, "refs", "label").drop("blocks").join(counts, [*on, "_dim"])
    r = r.withColumn("asked_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_asked") - 1)))
    pairs = r.join(q, [*on, "_dim", "asked_block"]).select("asked", "refs")
    kinds = dict(queries.dtypes)["query_id"], dict(references.dtypes)["label"]
    best = pairs.mapInArrow(_pair_scores(top), f"query_id {kinds[0]}, label {kinds[1]}, n bigint, best array<double>")
    total = best.groupBy("query_id", "label").agg(F.sum("n").alias("support"), F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, top).alias("b"))
    score = F.aggregate("b", F.lit(0.0), lambda s, x: s + x) / F.size("b")
    scored = total.select("query_id", "label", score.alias("score"), "support")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "label")))


def reference_turns(turns: DataFrame, voices: DataFrame) -> DataFrame:
    """Turns whose vectors others are compared with: assigned by hand, to a voice that is not ignored."""
    live = voices.where(~F.coalesce("ignored", F.lit(False))).select(F.col("id").alias("voice_id"))
    return turns.where("assignment_status = 'assigned' and method = 'manual'").join(live, "voice_id", "left_semi")


def combine_encoders(ranked: DataFrame) -> DataFrame:
    """query_id, label, score (plain mean over the encoders that know the label), encoder_count, by_encoder (map encoder to score), support
    (map), and rank by (-score, label). `ranked` has encoder beside the columns of `rank_voices`; an encoder twice is an error."""
    told = F.array_sort(F.collect_list(F.struct("encoder", "score", "support")))
    out = ranked.groupBy("query_id", "label").agg(told.alias("_e"))
    twice = F.size(F.array_distinct(F.transform("_e", lambda x: x["encoder"]))) < F.size("_e")
    out = out.withColumn("_e", F.when(twice, F.raise_error(F.lit("an encoder ranks a label twice"))).otherwise(F.col("_e")))
    mean = F.aggregate("_e", F.lit(0.0), lambda s, x: s + x["score"]) / F.size("_e")
    pairs = lambda c: F.map_from_entries(F.transform("_e", lambda x: F.struct(x["encoder"], x[c])))
    out = out.select("query_id", "label", mean.alias("score"), F.size("_e").alias("encoder_count"), pairs("score").alias("by_encoder"), pairs("support").alias("support"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "label")))


def least_support(support: Column) -> Column:
    """The smallest value of a map, 0 for an empty or missing one."""
    return F.coalesce(F.array_min(F.map_values(support)), F.lit(0).cast("long"))


def unit(vector: Column) -> Column:
    """The vector over its length, in doubles; null where the length is 0 or a value is no finite number."""
    v = F.transform(vector, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (length > 0)
    return F.when(fine, F.transform(v, lambda x: x / length))


def summarise(ranked: DataFrame) -> DataFrame:
    """query_id, top_label, top_score, runner_up_score, margin (null without a runner-up), support."""
    first = lambda c, k: F.max(F.when(F.col("rank") == k, F.col(c)))
    out = ranked.where("rank <= 2").groupBy("query_id").agg(first("label", 1).alias("top_label"), first("score", 1).alias("top_score"), first("score", 2).alias("runner_up_score"), first("support", 1).alias("support"))
    return out.withColumn("margin", F.col("top_score") - F.col("runner_up_score"))


MARGINS = (0.0, 0.05, 0.1, 0.15, 0.2, 0.3)
REFERENCES, SOURCES, ENCODERS = (1, 2, 4), (1, 2, 3), (1, 2)


def calibration_report(observed: DataFrame, margins: tuple[float, ...] = MARGINS, references: tuple[int, ...] = REFERENCES, sources: tuple[int, ...] = SOURCES, encoders: tuple[int, ...] = ENCODERS) -> DataFrame:
    """One row per rule of the grid: total, eligible, correct, error, precision (null if none is eligible) and coverage.

    `observed` has correct, margin, support, source_support and encoder_count. A missing margin, or a null, meets no threshold.
    Every observation meets the grid as an array literal and is counted before the shuffle.
    """
    grid = F.array(*(F.struct(F.lit(float(m)).alias("minimum_margin"), F.lit(r).alias("minimum_references"), F.lit(s).alias("minimum_sources"), F.lit(e).alias("minimum_encoders")) for m in margins for r in references for s in sources for e in encoders))
    x = observed.select("correct", "margin", "support", "source_support", "encoder_count", F.explode(grid).alias("r")).select("*", "r.*")
    ok = F.coalesce((F.col("margin") >= F.col("minimum_margin")) & (F.col("support") >= F.col("minimum_references")) & (F.col("source_support") >= F.col("minimum_sources")) & (F.col("encoder_count") >= F.col("minimum_encoders")), F.lit(False))
    keys = ["minimum_margin", "minimum_references", "minimum_sources", "minimum_encoders"]
    out = x.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(ok).alias("eligible"), F.count_if(ok & F.col("correct")).alias("correct"))
    out = out.withColumns({"error": F.col("eligible") - F.col("correct"), "precision": F.try_divide(F.col("correct"), F.col("eligible")), "coverage": F.try_divide(F.col("eligible"), F.col("total"))})
    return out


RULE = ["margin", "references", "sources", "encoders"]


def meets_rule(rule: dict[str, float | None]) -> Column:
    """Whether a row (margin, support, source_support, encoder_count) has a prediction and meets a rule's thresholds minimum_margin,
    minimum_references, minimum_sources, minimum_encoders; one that is None asks nothing, and a null meets none that asks."""
    columns = {"minimum_margin": "margin", "minimum_references": "support", "minimum_sources": "source_support", "minimum_encoders": "encoder_count"}
    out = F.col("top_label").isNotNull()
    for name, column in columns.items():
        if rule.get(name) is not None:
            out = out & (F.col(column) >= rule[name])
    return F.coalesce(out, F.lit(False))


def evaluate_rule(observed: DataFrame, rule: dict[str, float | None]) -> DataFrame:
    """One row: total, eligible, correct, error, precision, coverage of one rule, and trusted: at least rule minimum_eligible rows
    are eligible and the precision is known and at least rule minimum_precision."""
    ok = meets_rule(rule)
    out = observed.agg(F.count("*").alias("total"), F.count_if(ok).alias("eligible"), F.count_if(ok & F.col("correct")).alias("correct"))
    precision = F.try_divide(F.col("correct"), F.col("eligible"))
    out = out.withColumns({"error": F.col("eligible") - F.col("correct"), "precision": precision, "coverage": F.try_divide(F.col("eligible"), F.col("total"))})
    trusted = (F.col("eligible") >= rule.get("minimum_eligible", 0)) & F.coalesce(F.col("precision") >= rule.get("minimum_precision", 0.0), F.lit(False))
    return out.withColumn("trusted", trusted)


def classify_review(candidates: DataFrame, observed: DataFrame, suggest: dict[str, float | None], prefill: dict[str, float | None]) -> DataFrame:
    """Adds mode to candidates (top_label, margin, support, source_support, encoder_count): 'prefill' if the row meets that rule and the
    observations trust it, else 'suggest' by the same two tests, else 'none'."""
    trust = lambda rule, name: evaluate_rule(observed, rule).select(F.col("trusted").alias(name))
    both = candidates.join(F.broadcast(trust(prefill, "_prefill"))).join(F.broadcast(trust(suggest, "_suggest")))  # one row each
    mode = F.when(meets_rule(prefill) & F.col("_prefill"), "prefill").when(meets_rule(suggest) & F.col("_suggest"), "suggest").otherwise("none")
    return both.withColumn("mode", mode).drop("_prefill", "_suggest")


def summarise_observations(observed: DataFrame) -> DataFrame:
    """One row: total, predicted (with a top_label), correct, and accuracy among the predicted, null if there are none."""
    right = F.count_if("correct")
    return observed.agg(F.count("*").alias("total"), F.count("top_label").alias("predicted"), right.alias("correct"), F.try_divide(right, F.count("top_label")).alias("accuracy"))


OBSERVATION = "schema_version int, turn_id string, source_id string, confirmed_voice_id string, predicted_voice_id string, correct boolean, top_score double, runner_up_score double, margin double, encoder_count int, embedding_scores map<string,double>, support map<string,bigint>, source_support map<string,bigint>, total_source_support bigint"
VERSION = 1


def observe(summary: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Observations: each confirmed turn (query_id, source_id, confirmed) with what was predicted for it, if anything was. correct is whether
    the prediction is the confirmed voice."""
    out = confirmed.join(summary, "query_id", "left")
    return out.withColumn("correct", F.coalesce(F.col("top_label") == F.col("confirmed"), F.lit(False)))


def read_observations(lines: DataFrame, column: str = "observation") -> tuple[DataFrame, DataFrame]:
    """(good, bad): observations parsed from JSON, and those that break a rule, with the reason."""
    parsed = lines.withColumn("_o", F.from_json(column, OBSERVATION))
    o = lambda name: F.col(f"_o.{name}")
    blank = lambda name: F.coalesce(F.trim(o(name)) == "", F.lit(True))
    reason = (
        F.when(F.coalesce(F.left(F.ltrim(column), F.lit(1)) != "{", F.lit(True)), "no object").when(~o("schema_version").eqNullSafe(F.lit(VERSION)), "unknown schema version")
        .when(blank("turn_id") | blank("source_id") | blank("confirmed_voice_id"), "an id is missing").when(o("correct").isNull(), "correct is missing")
        .when(o("correct") != o("predicted_voice_id").eqNullSafe(o("confirmed_voice_id")), "correct does not fit the voices")
        .when(o("predicted_voice_id").isNull() & o("top_score").isNotNull(), "a score without a prediction")
        .when(o("margin").isNotNull() & (o("top_score").isNull() | o("runner_up_score").isNull()), "a margin without both scores")
        .when(F.least(o("encoder_count"), o("total_source_support")) < 0, "a negative count")
    )
    told = parsed.withColumn("reason", reason)
    return told.where("reason is null").select("_o.*"), told.where("reason is not null").drop("_o")


def write_observations(observations: DataFrame) -> DataFrame:
    """The observations as JSON, nulls spelt out, one column `observation`."""
    return observations.select(F.to_json(F.struct(*observations.columns), {"ignoreNullFields": "false"}).alias("observation"))


def valid_vectors(rows: DataFrame, vector: str = "vector", dimension: str = "dimension") -> DataFrame:
    """Adds problem: why a vector can't be used (null if it can): 'no vector', 'wrong dimension', 'not finite', 'zero'."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    problem = F.when(v.isNull() | (F.size(v) == 0), "no vector").when(F.col(dimension).isNotNull() & (F.size(v) != F.col(dimension)), "wrong dimension").when(~finite, "not finite").when(F.forall(v, lambda x: x == 0), "zero")
    return rows.withColumn("problem", problem)


def fully_embedded(turns: DataFrame, embeddings: DataFrame, representation: str) -> DataFrame:
    """One row: n, how many turns have the representation (in the array `representations`), and complete, whether each of those has a valid
    vector: what is complete need not be computed again."""
    good = valid_vectors(embeddings).where("problem is null").select(F.col("turn_id").alias("id")).distinct().withColumn("_has", F.lit(True))
    mine = turns.where(F.array_contains("representations", representation)).join(good, "id", "left")
    return mine.agg(F.count("*").alias("n"), F.coalesce(F.bool_and(F.coalesce("_has", F.lit(False))), F.lit(True)).alias("complete"))
