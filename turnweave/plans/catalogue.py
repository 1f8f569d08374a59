"""Queries over the driver's tables, each by the library's operators, and the SQL that they are held against.

Events stand for detected speech: a source is an event type, an interval begins at `ts` and lasts `value` times ten seconds, its
label is the user modulo 4; words are the same rows lasting `value` seconds. Embeddings are turns with a vector and a voice.
Conversations are turns in order. Times are whole microseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.functions.intervals import midpoint, near_source_edge, overlap
from turnweave.operators import alignment, curation, evidence, intervals, speakers, vectors
from turnweave.sources.catalog import import_plan

SECOND = 1_000_000
CELL = 600 * SECOND
R, W = ("r_start", "r_end"), ("w_start", "w_end")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros(c: str) -> F.Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _micros("ts")
    return _table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("region_id"), start.alias("r_start"), (start + F.round(F.col("value") * 1e7).cast("long")).alias("r_end"), F.pmod("user_id", F.lit(4)).alias("label"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _micros("ts")
    return _table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("word_id"), start.alias("w_start"), (start + F.round(F.col("value") * 1e6).cast("long")).alias("w_end"))


# Named parts of the oracles.
_R = "r AS (SELECT event_type AS source, event_id AS region_id, epoch_us(ts) AS r_start, epoch_us(ts) + CAST(round(value * 1e7) AS BIGINT) AS r_end, user_id % 4 AS label FROM events)"
_W = "w AS (SELECT event_type AS source, event_id AS word_id, epoch_us(ts) AS w_start, epoch_us(ts) + CAST(round(value * 1e6) AS BIGINT) AS w_end FROM events)"
_B = f"""{_R}, o AS (SELECT *, max(r_end) OVER (PARTITION BY source ORDER BY r_start, r_end, region_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR r_start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY r_start, r_end, region_id ROWS UNBOUNDED PRECEDING) AS b FROM o),
blocks AS (SELECT source, min(r_start) AS block_start, max(r_end) AS block_end, count(*) AS n_intervals FROM n GROUP BY source, b)"""
_C = "c AS (SELECT conv_id, turn, CASE WHEN role <> 'system' THEN role END AS speaker, role, text FROM conversations)"
_E = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"
_COS = "list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))"
_RANK = f"""{_E}, s AS (SELECT a.vec_id AS query_id, b.label, b.vec_id AS ref_id, {_COS} AS sim FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY sim DESC, ref_id) AS i FROM s),
m AS (SELECT query_id, label, avg(CASE WHEN i <= 3 THEN sim END) AS score, count(*) AS support FROM k GROUP BY query_id, label),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) AS rank FROM m)"""
_SUM = f"""{_RANK}, summary AS (SELECT query_id, max(CASE WHEN rank = 1 THEN label END) AS top_label, max(CASE WHEN rank = 1 THEN score END) AS top_score, max(CASE WHEN rank = 2 THEN score END) AS runner_up_score, max(CASE WHEN rank = 1 THEN support END) AS support FROM ranked WHERE rank <= 2 GROUP BY query_id),
obs AS (SELECT s.*, top_score - runner_up_score AS margin, e.label AS confirmed, s.top_label = e.label AS correct, s.support % 3 + 1 AS source_support, 1 AS encoder_count FROM summary s JOIN embeddings e ON e.vec_id = s.query_id)"""


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return vectors.rank_voices(asked, e.select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("vector"), "label"))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("label").alias("confirmed"))
    out = vectors.summarise(_ranked(spark, sf_dir)).join(truth, "query_id")
    return out.withColumns({"correct": F.col("top_label") == F.col("confirmed"), "source_support": F.col("support") % 3 + 1, "encoder_count": F.lit(1)})


@_query(f"WITH {_RANK} SELECT query_id, label, round(score, 6) AS score, support, rank FROM ranked")
def voice_rank_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).withColumn("score", F.round("score", 6)).withColumn("rank", F.col("rank").cast("long"))


@_query(f"WITH {_SUM} SELECT query_id, top_label, round(top_score, 6) AS top_score, round(runner_up_score, 6) AS runner_up_score, support, round(margin, 6) AS margin FROM obs")
def voice_summary_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vectors.summarise(_ranked(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("top_score", "runner_up_score", "margin")})


@_query(f"WITH {_E} SELECT a.vec_id AS left_id, b.vec_id AS right_id, round({_COS}, 6) AS similarity FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")
def voice_pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    left = e.select(F.col("vec_id").alias("left_id"), F.col("embedding").alias("a"), (F.col("vec_id") + 1).alias("right_id"))
    right = e.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("b"))
    return left.join(right, "right_id").select("left_id", "right_id", F.round(vectors.cosine(F.col("a"), F.col("b")), 6).alias("similarity"))


@_query(
    f"WITH {_SUM}, g AS (SELECT * FROM (VALUES (0.0), (0.05), (0.1), (0.15), (0.2), (0.3)) a(minimum_margin), (VALUES (1), (2), (4)) b(minimum_references), (VALUES (1), (2), (3)) c(minimum_sources), (VALUES (1), (2)) d(minimum_encoders)), "
    "t AS (SELECT g.*, count(*) AS total, count(*) FILTER (WHERE margin >= minimum_margin AND support >= minimum_references AND source_support >= minimum_sources AND encoder_count >= minimum_encoders) AS eligible, "
    "count(*) FILTER (WHERE correct AND margin >= minimum_margin AND support >= minimum_references AND source_support >= minimum_sources AND encoder_count >= minimum_encoders) AS correct FROM obs, g GROUP BY ALL) "
    "SELECT CAST(minimum_margin AS DOUBLE) AS minimum_margin, minimum_references, minimum_sources, minimum_encoders, total, eligible, correct, eligible - correct AS error, round(correct / nullif(eligible, 0), 6) AS precision, round(eligible / total, 6) AS coverage FROM t"
)
def calibration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.calibration_report(_observed(spark, sf_dir)).withColumns({"precision": F.round("precision", 6), "coverage": F.round("coverage", 6)})


@_query(f"WITH {_SUM} SELECT count(*) AS total, count(top_label) AS predicted, count(*) FILTER (WHERE correct) AS correct, round(count(*) FILTER (WHERE correct) / nullif(count(top_label), 0), 6) AS accuracy FROM obs")
def calibration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.summarise_observations(_observed(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


SUGGEST = {"minimum_margin": 0.0, "minimum_references": 2, "minimum_eligible": 2, "minimum_precision": 0.1}
PREFILL = {"minimum_margin": 0.05, "minimum_references": 4, "minimum_sources": 2, "minimum_eligible": 1, "minimum_precision": 0.2}


@_query(
    f"""WITH {_SUM}, p AS (SELECT count(*) FILTER (WHERE margin >= 0.05 AND support >= 4 AND source_support >= 2) AS n, count(*) FILTER (WHERE correct AND margin >= 0.05 AND support >= 4 AND source_support >= 2) AS c FROM obs),
sg AS (SELECT count(*) FILTER (WHERE margin >= 0 AND support >= 2) AS n, count(*) FILTER (WHERE correct AND margin >= 0 AND support >= 2) AS c FROM obs)
SELECT query_id, CASE WHEN margin >= 0.05 AND support >= 4 AND source_support >= 2 AND p.n >= 1 AND coalesce(p.c / nullif(p.n, 0) >= 0.2, false) THEN 'prefill' WHEN margin >= 0 AND support >= 2 AND sg.n >= 2 AND coalesce(sg.c / nullif(sg.n, 0) >= 0.1, false) THEN 'suggest' ELSE 'none' END AS mode FROM obs, p, sg"""
)
def review_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _observed(spark, sf_dir)
    return vectors.classify_review(seen, seen, SUGGEST, PREFILL).select("query_id", "mode")


_HALVES = """e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), h AS (SELECT vec_id, label, 'first' AS encoder, v[1:32] AS v FROM e UNION ALL SELECT vec_id, label, 'second', v[33:64] FROM e WHERE vec_id % 3 > 0),
s AS (SELECT a.vec_id AS query_id, a.encoder, b.label, list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS sim FROM h a JOIN h b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND a.encoder = b.encoder),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id, encoder, label ORDER BY sim DESC) AS i FROM s), m AS (SELECT query_id, encoder, label, avg(CASE WHEN i <= 3 THEN sim END) AS score, count(*) AS support FROM k GROUP BY ALL)"""


@_query(f"WITH {_HALVES}, c AS (SELECT query_id, label, avg(score) AS score, count(*) AS encoder_count, min(support) AS least_support FROM m GROUP BY ALL) SELECT query_id, label, round(score, 6) AS score, encoder_count, least_support, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) AS rank FROM c")
def encoders_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two encoders: the halves of a vector, of which every third has but one."""
    e = _table(spark, sf_dir, "embeddings")
    parts = []
    for encoder, at, rows in (("first", 1, e), ("second", 33, e.where("vec_id % 3 > 0"))):
        v = rows.select("vec_id", F.slice("embedding", at, 32).alias("vector"), "label")
        ranked = vectors.rank_voices(v.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "ref_id"))
        parts.append(ranked.select("query_id", "label", "score", "support", F.lit(encoder).alias("encoder")))
    out = vectors.combine_encoders(parts[0].union(parts[1]))
    return out.select("query_id", "label", F.round("score", 6).alias("score"), F.col("encoder_count").cast("long").alias("encoder_count"), vectors.least_support(F.col("support")).alias("least_support"), F.col("rank").cast("long").alias("rank"))


@_query(
    f"""WITH {_R}, {_W}, p AS (SELECT w.word_id, r.label FROM w JOIN r ON r.source = w.source AND r.r_start < w.w_end AND w.w_start < r.r_end AND least(r.r_end, w.w_end) > greatest(r.r_start, w.w_start)),
g AS (SELECT word_id, count(*) AS n, min(label) AS lo, max(label) AS hi FROM p GROUP BY word_id)
SELECT w.word_id, coalesce(n, 0) AS n_regions, CASE WHEN lo = hi THEN lo END AS speaker, CASE WHEN n IS NULL THEN 'no_overlapping_region' WHEN lo IS NULL THEN 'no_speaker_label' WHEN lo <> hi THEN 'conflicting_overlapping_speakers' WHEN n = 1 THEN 'single_overlapping_region' ELSE 'consistent_overlapping_regions' END AS method
FROM w LEFT JOIN g USING (word_id)"""
)
def interval_overlap_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.attribute_words(_words(spark, sf_dir), _regions(spark, sf_dir), ["source"], "word_id", W, R, "label", CELL).drop("source")


@_query(
    f"""WITH {_R}, {_W}, p AS (SELECT w.word_id, r.* FROM w JOIN r ON r.source = w.source AND least(r.r_end, w.w_end) > greatest(r.r_start, w.w_start)),
g AS (SELECT word_id, count(*) AS n, string_agg(CAST(region_id AS VARCHAR), ',' ORDER BY r_start, r_end, region_id) AS ids FROM p GROUP BY word_id)
SELECT w.word_id, coalesce(n, 0) AS n, coalesce(ids, '') AS ids FROM w LEFT JOIN g USING (word_id)"""
)
def overlapping_region_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlapping_ids(_words(spark, sf_dir), _regions(spark, sf_dir), ["source"], "word_id", "region_id", W, R, CELL).drop("source")


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge_touching(_regions(spark, sf_dir), ["source"], R, "region_id", CELL)


@_query(f"WITH {_B} SELECT * FROM blocks")
def merge_speech_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocks(spark, sf_dir)


@_query(
    f"""WITH {_B}, g AS (SELECT source, block_end AS gap_start, lead(block_start) OVER (PARTITION BY source ORDER BY block_start, block_end) AS gap_end FROM blocks)
SELECT source, gap_start, gap_end, (gap_start + gap_end) // 2 AS cut, gap_start + 250000 AS zone_start, gap_end - 250000 AS zone_end FROM g WHERE gap_end - gap_start >= 500000"""
)
def speech_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.gaps(_blocks(spark, sf_dir), ["source"], SECOND // 2, CELL)


@_query(
    f"""WITH {_R}, chunks AS (SELECT source, h AS hour, CAST(h * 3600000000 AS BIGINT) AS c_start, CAST((h + 1) * 3600000000 AS BIGINT) AS c_end FROM (SELECT source, unnest(range(min(r_start) // 3600000000, max(r_end) // 3600000000 + 1)) AS h FROM r GROUP BY source))
SELECT source, hour, c_start, c_end, row_number() OVER (PARTITION BY source ORDER BY hour) - 1 AS index FROM chunks c WHERE EXISTS (SELECT 1 FROM r WHERE r.source = c.source AND r.r_start < c.c_end AND r.r_end > c.c_start AND r.r_end > r.r_start)"""
)
def chunks_with_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = 3600 * SECOND
    regions = _regions(spark, sf_dir)
    hours = regions.groupBy("source").agg(F.floor(F.min("r_start") / hour).alias("a"), F.floor(F.max("r_end") / hour).alias("b"))
    chunks = hours.select("source", F.explode(F.sequence("a", "b")).alias("hour")).withColumns({"c_start": F.col("hour") * hour, "c_end": (F.col("hour") + 1) * hour})
    return intervals.keep_overlapping(chunks, regions, ["source"], ("c_start", "c_end"), R, CELL, "hour").withColumn("index", F.col("index").cast("long"))


@_query()
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each source in seconds from its first region; a region of label 0 ends a sentence."""
    regions = _regions(spark, sf_dir).withColumn("heard", F.when(F.col("label") == 0, "Done.").otherwise("and"))
    length = regions.groupBy("source").agg(F.min("r_start").alias("zero"), ((F.max("r_end") - F.min("r_start")) / SECOND).alias("duration"))
    blocks = speakers.speech_blocks(regions, ["source"], R, "region_id", "heard", CELL).join(length, "source")
    shifted = blocks.select("source", *(((F.col(c) - F.col("zero")) / SECOND).alias(c) for c in ("block_start", "block_end")), "ends_sentence")
    return speakers.plan_chunks(length, shifted, "source", "duration", 3600.0, 900.0, 4 * 3600.0, 0.5)


def _talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.when(F.col("role") != "system", F.col("role")).alias("speaker"), "role", "text")


@_query(
    f"""WITH {_C}, m AS (SELECT *, count(speaker) OVER (PARTITION BY conv_id ORDER BY turn) AS run, last_value(speaker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS l, first_value(speaker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM c)
SELECT conv_id, min(turn) AS first, max(turn) AS last, count(*) AS n, any_value(l) AS left_speaker, any_value(r) AS right_speaker FROM m WHERE speaker IS NULL GROUP BY conv_id, run"""
)
def speaker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.unresolved_runs(_talk(spark, sf_dir), ["conv_id"], "turn", "speaker")


@_query(
    f"""WITH {_C} SELECT conv_id, turn, coalesce(speaker, CASE WHEN l = r THEN l END) AS filled FROM (SELECT *, last_value(speaker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS l, first_value(speaker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM c)"""
)
def context_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.fill_consistent_context(_talk(spark, sf_dir), ["conv_id"], "turn", "speaker").select("conv_id", "turn", "filled")


@_query(
    f"""WITH {_C}, n AS (SELECT *, last_value(speaker IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, lead(speaker) OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM c)
SELECT conv_id, turn, coalesce(speaker, CASE WHEN l IS NULL OR r IS NULL OR l = r THEN coalesce(l, r) END) AS resolved, CASE WHEN speaker IS NULL THEN CASE WHEN l = r THEN 'consistent' WHEN r IS NULL AND l IS NOT NULL THEN 'left' WHEN l IS NULL AND r IS NOT NULL THEN 'right' END END AS step FROM n"""
)
def fragment_resolver(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _talk(spark, sf_dir).select("conv_id", "turn", "speaker", F.when(F.col("speaker").isNull(), F.array(F.lit("user"), F.lit("assistant"))).alias("candidates"))
    return speakers.resolve_fragments(words, ["conv_id"], "turn", "speaker", "candidates").select("conv_id", "turn", "resolved", "step")


@_query(
    f"""WITH {_W}, x AS (SELECT source, word_id, w_start, w_end, lead(w_start) OVER p AS nxt FROM w WINDOW p AS (PARTITION BY source ORDER BY w_start)),
y AS (SELECT *, CASE WHEN nxt IS NULL THEN 'source_end' WHEN nxt - w_end > 60000000 THEN 'alignment_gap' ELSE '' END AS why FROM x),
z AS (SELECT *, coalesce(sum(CASE WHEN why <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY w_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM y)
SELECT source, min(w_start) AS first, max(w_start) AS last, min(w_start) AS "start", max(w_end) AS "end", count(*) AS n_words, arg_max(why, w_start) AS end_boundary FROM z GROUP BY source, run"""
)
def utterance_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir).withColumns({"speaker": F.lit(None).cast("string"), "sat": F.lit(False), "text": F.lit("")})
    return speakers.utterances(words, ["source"], "w_start", W, "speaker", "sat", "text", 60 * SECOND, CELL).select("source", "first", "last", "start", "end", "n_words", "end_boundary")


@_query(
    f"""WITH {_C}, x AS (SELECT *, lead(speaker) OVER (PARTITION BY conv_id ORDER BY turn) AS nx, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM c),
y AS (SELECT *, CASE WHEN nt IS NULL THEN 'source_end' WHEN speaker <> nx THEN 'speaker_change' ELSE '' END AS why FROM x),
z AS (SELECT *, coalesce(sum(CASE WHEN why <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM y)
SELECT conv_id, min(turn) AS first, max(turn) AS last, CASE WHEN count(DISTINCT speaker) = 1 THEN min(speaker) END AS speaker, arg_max(why, turn) AS end_boundary FROM z GROUP BY conv_id, run"""
)
def speaker_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _talk(spark, sf_dir).withColumns({"a": F.col("turn") * 10, "b": F.col("turn") * 10 + 5, "sat": F.lit(False)})
    return speakers.utterances(words, ["conv_id"], "turn", ("a", "b"), "speaker", "sat", "text", 1000).select("conv_id", "first", "last", "speaker", "end_boundary")


@_query(
    f"""WITH {_W}, m AS (SELECT *, CASE WHEN w_end - w_start <= 1000000 THEN 1 ELSE 0 END AS z FROM w), n AS (SELECT *, CASE WHEN z = 1 AND coalesce(lag(z) OVER p, 0) = 0 THEN 1 ELSE 0 END AS f FROM m WINDOW p AS (PARTITION BY source ORDER BY w_start)),
k AS (SELECT *, sum(f) OVER (PARTITION BY source ORDER BY w_start) AS run FROM n), g AS (SELECT source, w_start, w_end, lead(w_start) OVER (PARTITION BY source ORDER BY w_start) AS nxt FROM w)
SELECT source, 'zero_duration' AS issue, min(w_start) AS first, max(w_start) AS last FROM k WHERE z = 1 GROUP BY source, run
UNION ALL SELECT source, 'long_word', w_start, w_start FROM w WHERE w_end - w_start > 120000000
UNION ALL SELECT source, 'long_gap', w_start, nxt FROM g WHERE nxt - w_end > 120000000"""
)
def alignment_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.timing_issues(_words(spark, sf_dir), ["source"], "w_start", W, 120 * SECOND, SECOND, CELL)


_CONFLICTS = f"""{_R}, {_W}, x AS (SELECT *, lead(region_id) OVER p AS right_id, lead(label) OVER p AS nl, lead(r_start) OVER p AS ns FROM r WINDOW p AS (PARTITION BY source ORDER BY r_start, r_end, region_id)),
pairs AS (SELECT source, region_id AS left_id, right_id, r_end AS boundary, ns - r_end AS gap FROM x WHERE right_id IS NOT NULL AND label IS DISTINCT FROM nl)"""


@_query(f"WITH {_CONFLICTS} SELECT p.source, left_id, right_id, boundary, gap, word_id FROM pairs p JOIN w ON w.source = p.source AND w_start < boundary AND boundary < w_end")
def boundary_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.conflict_spans(_regions(spark, sf_dir), _words(spark, sf_dir), ["source"], R, W, "label", "region_id", "word_id", CELL)


@_query(
    f"""WITH {_CONFLICTS}, o AS (SELECT p.*, r.r_start FROM pairs p JOIN r ON r.region_id = left_id), n AS (SELECT *, CASE WHEN lag(right_id) OVER (PARTITION BY source ORDER BY r_start) = left_id THEN 0 ELSE 1 END AS f FROM o),
k AS (SELECT *, sum(f) OVER (PARTITION BY source ORDER BY r_start) AS run FROM n) SELECT source, CAST(run AS BIGINT) AS run, count(*) AS n_pairs, min(boundary) AS first_boundary FROM k GROUP BY source, run"""
)
def conflict_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = intervals.beside(_regions(spark, sf_dir), ["source"], [*R, "region_id"], ["region_id", "label"], CELL, after=True, name="r")
    pairs = r.where(F.col("r").isNotNull() & ~F.col("label").eqNullSafe(F.col("r.label"))).withColumn("right_id", F.col("r.region_id"))
    runs = speakers.chained_runs(pairs, ["source"], "r_start", "region_id", "right_id", CELL)
    return runs.groupBy("source", F.col("run").cast("long").alias("run")).agg(F.count("*").alias("n_pairs"), F.min("r_end").alias("first_boundary"))


@_query(
    "WITH f AS (SELECT label, unnest(range(1, len(embedding) + 1)) - 1 AS speaker, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), m AS (SELECT label, speaker, avg(v) AS mean FROM f GROUP BY label, speaker) "
    "SELECT label, arg_max(speaker, mean) AS dominant, round(max(mean), 6) AS top_mean, count(*) AS n_speakers FROM m GROUP BY label"
)
def activity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.mean_activity(_table(spark, sf_dir, "embeddings"), ["label"], "embedding").withColumn("top_mean", F.round("top_mean", 6))


@_query(
    f"""WITH {_R}, {_W}, m AS (SELECT source, word_id, (w_start + w_end) / 2 AS mid FROM w), p AS (SELECT m.word_id, r.region_id, r.label FROM m JOIN r ON r.source = m.source AND r_start <= mid AND mid <= r_end),
g AS (SELECT word_id, count(*) AS n, count(DISTINCT label) AS labels FROM p GROUP BY word_id)
SELECT word_id, coalesce(n, 0) AS n_regions, CASE WHEN n IS NULL THEN 'no_matching_region' WHEN labels > 1 THEN 'multiple_speakers' ELSE 'candidate' END AS status FROM w LEFT JOIN g USING (word_id)"""
)
def midpoint_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.midpoint_states(_words(spark, sf_dir), _regions(spark, sf_dir), ["source"], "word_id", midpoint(F.col("w_start"), F.col("w_end")), R, "label", CELL).drop("source")


@_query(
    f"""WITH {_R}, {_W} SELECT r.region_id, count(w.word_id) AS n_words, count(*) FILTER (WHERE w_start >= r_start AND w_end <= r_end) AS n_covered, count(*) FILTER (WHERE w_end - w_start > 2000000) AS n_suspicious, min(w_start) AS first_start, max(w_end) AS last_end
FROM r JOIN w ON w.source = r.source AND least(r_end, w_end) > greatest(r_start, w_start) GROUP BY r.region_id"""
)
def turn_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = intervals.overlap_join(_regions(spark, sf_dir), _words(spark, sf_dir), ["source"], R, W, CELL)
    return pairs.groupBy("region_id").agg(F.count("*").alias("n_words"), F.count_if((F.col("w_start") >= F.col("r_start")) & (F.col("w_end") <= F.col("r_end"))).alias("n_covered"), F.count_if(F.col("w_end") - F.col("w_start") > 2 * SECOND).alias("n_suspicious"), F.min("w_start").alias("first_start"), F.max("w_end").alias("last_end"))


@_query(f"WITH {_R}, {_W} SELECT r.region_id, CAST(coalesce(sum(CASE WHEN w_start IS NOT NULL THEN least(r_end, w_end) - greatest(r_start, w_start) END), 0) AS BIGINT) AS covered FROM r LEFT JOIN w ON w.source = r.source AND least(r_end, w_end) > greatest(r_start, w_start) GROUP BY r.region_id")
def speech_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.coverage(_regions(spark, sf_dir), _words(spark, sf_dir), ["source"], "region_id", R, W, CELL).drop("source")


@_query(
    "WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'rejected' END AS status FROM orders), n AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 AND l_quantity > 25 GROUP BY 1) "
    "SELECT s.o_orderkey, CASE WHEN n > 1 OR (n > 0 AND status = 'rejected') THEN 'conflict' WHEN n = 1 THEN 'reconciled' ELSE coalesce(status, 'pending') END AS effective FROM s LEFT JOIN n ON l_orderkey = s.o_orderkey"
)
def effective_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for regions, large first lines for turns that use one."""
    regions = _table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "rejected").alias("status"))
    turns = _table(spark, sf_dir, "lineitem").where("l_linenumber <= 2 and l_quantity > 25").select(F.array("l_orderkey").alias("members"))
    return curation.effective_status(regions, turns, "o_orderkey", "status", "members").select("o_orderkey", "effective")


@_query("SELECT conv_id, turn, len(t) AS n_tokens, array_to_string(t, '|') AS tokens FROM (SELECT conv_id, turn, list_transform(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{M}\\p{N}_]+(?:[''’][\\p{L}\\p{M}\\p{N}_]+)*'), lambda x: replace(replace(lower(x), 'ß', 'ss'), '’', '''')) AS t FROM conversations)")
def tokens_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.lexical_tokens(F.col("text"))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(t).cast("long").alias("n_tokens"), F.array_join(t, "|").alias("tokens"))


@_query("SELECT conv_id, turn, array_to_string(list_filter(list_transform(regexp_split_to_array(replace(lower(coalesce(text, '')), 'ß', 'ss'), '\\s+'), lambda x: regexp_replace(x, '[^\\p{L}\\p{N}'']', '', 'g')), lambda x: x <> ''), '|') AS tokens FROM conversations")
def tokens_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(T.plain_tokens(F.col("text")), "|").alias("tokens"))


@_query()
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.sentences(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(s).cast("long").alias("n_sentences"), T.ends_sentence(F.col("text")).alias("complete"))


@_query(
    f"""WITH {_C}, t AS (SELECT conv_id, turn, role, unnest(list_distinct(list_filter(list_transform(regexp_split_to_array(replace(lower(coalesce(text, '')), 'ß', 'ss'), '\\s+'), lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}'']', '', 'g')), lambda x: x <> ''))) AS tok FROM c),
s AS (SELECT conv_id, role, count(DISTINCT tok) AS n_tokens, min(turn) AS first_turn, max(turn) AS last_turn FROM t GROUP BY conv_id, role)
SELECT conv_id, role, n_tokens, first_turn, last_turn, row_number() OVER (PARTITION BY conv_id ORDER BY n_tokens DESC, last_turn - first_turn, role DESC) AS rank FROM s"""
)
def speaker_lexical_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evidence.lexical_evidence(_talk(spark, sf_dir), ["conv_id"], "role", "text", ("turn", "turn"))
    return out.select("conv_id", "role", "n_tokens", F.col("start").alias("first_turn"), F.col("end").alias("last_turn"), F.col("rank").cast("long").alias("rank"))


@_query(f"WITH {_R} SELECT region_id, unnest(range(r_start + 60000000, r_end - 60000000 + 1, 30000000)) AS boundary FROM r WHERE r_start + 60000000 <= r_end - 60000000")
def change_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.grid_points(_regions(spark, sf_dir), R, 60 * SECOND, 30 * SECOND).select("region_id", "boundary")


@_query(
    f"""WITH {_R} SELECT region_id, greatest(r_start - 250000, CASE WHEN b <= r_start THEN b ELSE 0 END, 0) AS clip_start, least(r_end + 250000, CASE WHEN a >= r_end THEN a ELSE r_end + 250000 END) AS clip_end
FROM (SELECT *, lag(r_end) OVER p AS b, lead(r_start) OVER p AS a FROM r WINDOW p AS (PARTITION BY source ORDER BY r_start, r_end, region_id))"""
)
def padding_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.bounded_padding(_regions(spark, sf_dir), ["source"], R, "region_id", SECOND // 4, CELL).select("region_id", "clip_start", "clip_end")


@_query(f"WITH {_R}, s AS (SELECT source, min(r_start) AS z, max(r_end) AS d FROM r GROUP BY source) SELECT region_id, r_start - z <= 3600000000 AS near_start, d - r_end <= 3600000000 AS near_end FROM r JOIN s USING (source)")
def near_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    whole = r.groupBy("source").agg(F.min("r_start").alias("z"), F.max("r_end").alias("d"))
    near_start, near_end = near_source_edge(F.col("r_start") - F.col("z"), F.col("r_end") - F.col("z"), F.col("d") - F.col("z"), 3600 * SECOND)
    return r.join(whole, "source").select("region_id", near_start.alias("near_start"), near_end.alias("near_end"))


@_query(
    f"""WITH {_C} SELECT conv_id, min(turn) AS "start", max(turn) AS "end", count(*) AS n_turns, CASE WHEN count(DISTINCT speaker) = 1 THEN min(speaker) END AS voice, count(DISTINCT speaker) AS n_voices,
CASE WHEN min(role) = max(role) AND count(role) = count(*) THEN min(role) END AS language, coalesce(string_agg(nullif(trim(coalesce(text, '')), ''), ' ' ORDER BY turn), '') AS transcript FROM c GROUP BY conv_id"""
)
def merge_turns_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.merge_turns(_talk(spark, sf_dir), ["conv_id"], ["turn"], ("turn", "turn"), "speaker", "role", "text")


@_query(
    f"""WITH {_R}, t AS (SELECT source, (min(r_start) + max(r_end)) / 2 AS cut FROM r GROUP BY source), s AS (SELECT source, 'left' AS side, r_start, r_end FROM r JOIN t USING (source) WHERE r_start < cut UNION ALL SELECT source, 'right', r_start, r_end FROM r JOIN t USING (source) WHERE r_end > cut)
SELECT source, side, count(*) AS n, min(r_start) AS "start", max(r_end) AS "end" FROM s GROUP BY source, side"""
)
def split_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    cuts = r.groupBy("source").agg(midpoint(F.min("r_start"), F.max("r_end")).alias("cut"))
    return curation.split_regions(r.join(cuts, "source"), F.col("cut"), R).groupBy("source", "side").agg(F.count("*").alias("n"), F.min("r_start").alias("start"), F.max("r_end").alias("end"))


@_query(
    f"""WITH {_R}, x AS (SELECT *, r_start - 30000000 AS ns, r_end + 30000000 AS ne, lag(r_end) OVER p AS b, lead(r_start) OVER p AS a FROM r WINDOW p AS (PARTITION BY source ORDER BY r_start, r_end, region_id))
SELECT region_id, ns >= 0 AND ne > ns AND NOT coalesce(greatest(b - ns, 0) > greatest(b - r_start, 0), false) AND NOT coalesce(greatest(ne - a, 0) > greatest(r_end - a, 0), false) AS allowed FROM x"""
)
def trim_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir).withColumns({"ns": F.col("r_start") - 30 * SECOND, "ne": F.col("r_end") + 30 * SECOND})
    return curation.trim_allowed(r, ["source"], R, ("ns", "ne"), "region_id", CELL).select("region_id", "allowed")


@_query(
    "WITH n AS (SELECT user_id, event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY ALL), o AS (SELECT DISTINCT l_suppkey AS user_id, 'view' AS event_type FROM lineitem) "
    "SELECT n.user_id, n.event_type, CASE WHEN lo <> hi THEN 'conflict' WHEN o.user_id IS NULL THEN 'insert' ELSE 'conflict' END AS action FROM n LEFT JOIN o USING (user_id, event_type)"
)
def import_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = _table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    existing = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("user_id"), F.lit("view").alias("event_type")).distinct().withColumn("value", F.lit(-1.0))
    return import_plan(existing, incoming, ["user_id", "event_type"], ["value"])


@_query(
    "WITH z AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) + 1 AS b FROM events), p AS (SELECT event_type, least((epoch_us(ts) - a) * 200 // (b - a), 199) AS bucket, max(abs(value - 200)) AS peak FROM events, z GROUP BY ALL) "
    "SELECT event_type, CAST(bucket AS BIGINT) AS bucket, round(peak, 6) AS peak, round(peak / max(peak) OVER (PARTITION BY event_type), 6) AS level FROM p"
)
def waveform_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_type", _micros("ts").alias("at"), (F.col("value") - 200).alias("value"))
    whole = e.agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    return intervals.envelope(e.join(F.broadcast(whole)), ["event_type"], "at", "value", F.col("a"), F.col("b"), 200).select("event_type", "bucket", F.round("peak", 6).alias("peak"), F.round("level", 6).alias("level"))


_TILES = f"""{_R}, {_W}, t AS (SELECT source, region_id, r_start, coalesce(lead(r_start) OVER (PARTITION BY source ORDER BY r_start, region_id), r_end) AS r_end, nullif(label, 3) AS label FROM r)"""


@_query(
    f"""WITH {_TILES}, p AS (SELECT w.word_id, t.* FROM w JOIN t ON t.source = w.source AND least(t.r_end, w.w_end) > greatest(t.r_start, w.w_start)), q AS (SELECT *, coalesce(lag(r_end) OVER (PARTITION BY word_id ORDER BY r_start, r_end, region_id) = r_start, true) AS j FROM p)
SELECT word_id, string_agg(CAST(region_id AS VARCHAR), ',' ORDER BY r_start, r_end, region_id) AS region_ids FROM q GROUP BY word_id HAVING count(*) > 1 AND count(DISTINCT coalesce(label, -1)) > 1 AND bool_and(j)"""
)
def word_region_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions here last until the next one starts, so that they touch exactly; those of label 3 have none."""
    tiles = intervals.beside(_regions(spark, sf_dir), ["source"], ["r_start", "region_id"], ["r_start"], CELL, after=True, name="n")
    tiles = tiles.withColumns({"r_end": F.coalesce("n.r_start", "r_end"), "label": F.nullif("label", F.lit(3))}).drop("n")
    return speakers.region_conflicts(_words(spark, sf_dir), tiles, ["source"], "word_id", W, R, "region_id", "label", CELL).select("word_id", "region_ids")


@_query()
def text_match_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the words of each turn, all of them, are said in its conversation: target_id is the first turn with these words,
    first and last are places among the conversation's words. Turns without a conversation are one conversation."""
    talk = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    each = Window.partitionBy("conv_id", "turn", "role", "text").orderBy(F.lit(1))
    talk = talk.withColumn("copy", F.row_number().over(each)).withColumn("words", T.lexical_tokens(F.col("text")))
    flat = talk.select("conv_id", "turn", "role", "text", "copy", F.posexplode("words").alias("i", "token"))
    tokens = flat.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text", "copy", "i")).cast("long") - 1).select("conv_id", "at", "token")
    targets = talk.where(F.size("words") > 0).groupBy("conv_id", F.col("words").alias("target")).agg(F.min("turn").alias("target_id"))
    return alignment.text_spans(tokens, ["conv_id"], targets, "at", "token", "target")


@_query("SELECT r_name, n_name, count(*) AS n, round(sum(s_acctbal), 2) AS total FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY CUBE (r_name, n_name)")
def star_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, n, s = (_table(spark, sf_dir, x) for x in ("region", "nation", "supplier"))
    j = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.cube("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal"), 2).alias("total"))


@_query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@_query("SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer FULL JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def star_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    j = _table(spark, sf_dir, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "full")
    return j.groupBy("c_custkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))


@_query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity >= 45")
def star_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = _table(spark, sf_dir, "lineitem").where("l_quantity >= 45")
    return _table(spark, sf_dir, "part").join(large, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey").distinct()


@_query("SELECT o_orderkey, o_custkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS recent, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS quarter FROM orders")
def star_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0), Window.partitionBy("o_custkey").orderBy("o_totalprice", "o_orderkey")
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.avg("o_totalprice").over(a), 4).alias("recent"), F.ntile(4).over(b).cast("long").alias("quarter"))


@_query(f"WITH {_R} SELECT a.region_id, CAST(coalesce(sum(CASE WHEN b.region_id IS NOT NULL THEN greatest(0, least(a.r_end, b.r_end) - greatest(a.r_start, b.r_start)) END), 0) AS BIGINT) AS shared FROM r a LEFT JOIN r b ON a.source = b.source AND b.region_id = a.region_id + 1 GROUP BY a.region_id")
def neighbour_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _regions(spark, sf_dir)
    other = r.select("source", (F.col("region_id") - 1).alias("region_id"), F.col("r_start").alias("s"), F.col("r_end").alias("e"))
    return r.join(other, ["source", "region_id"], "left").select("region_id", F.coalesce(overlap(F.col("r_start"), F.col("r_end"), F.col("s"), F.col("e")) * F.col("s").isNotNull().cast("long"), F.lit(0)).cast("long").alias("shared"))


from turnweave.plans import dialogue, records  # noqa: E402  (they add their queries to the ones above)

__all__ = ["ORACLE_SQL", "QUERIES", "dialogue", "records"]
