"""Queries over conversations as recordings, and over decisions on turns, with the SQL that they are held against.

A conversation is a recording: its words are the pieces between white space, numbered through, one second apart and three quarters long; every seventh
(3, 10, ...) has no length, every eleventh (5, 16, ...) lasts 2.5 seconds. Each turn with words is a region around them and an utterance. Embeddings
are turns with voices; their states are made from their numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.operators import changes, evidence, intervals, recovery, speakers, transitions, views
from turnweave.plans.catalogue import _query, _table
from turnweave.sources.catalog import new_regions, with_new_ids
from turnweave.sources.scratch import dealt

CELL = 64

_CW = r"""cw AS (SELECT conv_id AS source, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS word, turn, role, t AS text, doc FROM (SELECT conv_id, turn, role, text AS doc, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM (SELECT *, regexp_extract_all(coalesce(text, ''), '\S+') AS w FROM conversations))),
words AS (SELECT source, word, turn, text, CAST(word AS DOUBLE) AS w_start, word + CASE WHEN word % 7 = 3 THEN 0.0 WHEN word % 11 = 5 THEN 2.5 ELSE 0.75 END AS w_end FROM cw),
regions AS (SELECT source, turn AS region_id, CAST(min(word) AS DOUBLE) AS r_start, max(word) + 0.875 AS r_end, nullif(any_value(role), 'system') AS label, any_value(doc) AS heard, min(word) AS word_start, max(word) + 1 AS word_end FROM cw GROUP BY source, turn)"""


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("heard"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0)).alias("w"))
    counted = intervals.running_sum(talk, ["conv_id"], ["turn"], F.size("w"), 1024, "base", before_only=True)
    flat = counted.select(F.col("conv_id").alias("source"), "turn", "role", "heard", "base", F.posexplode("w").alias("i", "text")).withColumn("word", F.col("base") + F.col("i"))
    length = F.when(F.col("word") % 7 == 3, 0.0).when(F.col("word") % 11 == 5, 2.5).otherwise(0.75)
    return dealt(flat.select("source", "word", "turn", "role", "heard", "text", F.col("word").cast("double").alias("w_start"), (F.col("word") + length).alias("w_end")))


def _regions(words: DataFrame) -> DataFrame:
    out = words.groupBy("source", F.col("turn").alias("region_id")).agg(F.min("w_start").alias("r_start"), (F.max("word") + 0.875).alias("r_end"), F.nullif(F.min("role"), F.lit("system")).alias("label"), F.min("heard").alias("heard"), F.min("word").alias("word_start"), (F.max("word") + 1).alias("word_end"))
    return out.withColumn("utterance", F.col("region_id"))


def _said(numbers: str) -> Column:
    return F.array_join(F.transform(numbers, lambda x: x.cast("string")), ",")


_LIST = "coalesce(string_agg(CAST({} AS VARCHAR), ',' ORDER BY {}){}, '')"


@_query(
    f"""WITH {_CW}, t AS (SELECT source, region_id, r_start + 2.25 AS s, r_end + 3.125 AS e FROM regions),
p AS (SELECT t.source, t.region_id, w.word, w.w_end - w.w_start <= 0 OR w.w_end - w.w_start > 2 AS odd FROM t JOIN words w ON w.source = t.source AND ((least(e, w_end) > greatest(s, w_start)) OR (w_end = w_start AND s <= w_start + 1e-6 AND w_start <= e + 1e-6))),
u AS (SELECT p.source, p.region_id, r.region_id AS utterance, count(*) = r.word_end - r.word_start AS whole FROM p JOIN regions r ON r.source = p.source AND r.word_start <= p.word AND p.word < r.word_end GROUP BY p.source, p.region_id, r.region_id, r.word_end, r.word_start),
a AS (SELECT source, region_id, string_agg(CAST(word AS VARCHAR), ',' ORDER BY word) AS words, coalesce(string_agg(CAST(word AS VARCHAR), ',' ORDER BY word) FILTER (WHERE odd), '') AS suspicious FROM p GROUP BY ALL),
b AS (SELECT source, region_id, coalesce(string_agg(CAST(utterance AS VARCHAR), ',' ORDER BY utterance) FILTER (WHERE whole), '') AS complete, string_agg(CAST(utterance AS VARCHAR), ',' ORDER BY utterance) AS touched FROM u GROUP BY ALL)
SELECT t.source, t.region_id, coalesce(words, '') AS words, coalesce(suspicious, '') AS suspicious, coalesce(complete, '') AS complete, coalesce(touched, '') AS touched FROM t LEFT JOIN a USING (source, region_id) LEFT JOIN b USING (source, region_id)"""
)
def projected_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions moved by some seconds: their words and utterances."""
    words = _words(spark, sf_dir)
    regions = _regions(words)
    key = F.concat_ws(":", "source", "region_id")
    moved = regions.select("source", "region_id", key.alias("range"), (F.col("r_start") + 2.25).alias("s"), (F.col("r_end") + 3.125).alias("e"))
    out = evidence.project_ranges(moved, words.select("source", "word", "w_start", "w_end"), regions.select("source", "utterance", "word_start", "word_end"), "range", ("s", "e"), CELL)
    return moved.select("source", "region_id", "range").join(out, ["source", "range"]).select("source", "region_id", *(_said(c).alias(c) for c in ("words", "suspicious", "complete", "touched")))


@_query(
    f"""WITH {_CW}, moved AS (SELECT source, region_id, r_start - 1.5 AS r_start, r_end + CASE WHEN region_id % 2 = 0 THEN 1.75 ELSE -1.5 END AS r_end, label, heard FROM regions WHERE word_end - word_start > 4),
x AS (SELECT *, lead(region_id) OVER p AS right_id, lead(r_start) OVER p AS right_start, lead(label) OVER p AS rl FROM moved WINDOW p AS (PARTITION BY source ORDER BY r_start, r_end, region_id)),
pw AS (SELECT m.source, m.region_id, w.word FROM moved m JOIN words w ON w.source = m.source AND least(m.r_end, w.w_end) > greatest(m.r_start, w.w_start)),
f AS (SELECT x.source, x.region_id, max(a.word) AS left_word FROM x JOIN pw a ON a.source = x.source AND a.region_id = x.region_id GROUP BY ALL), g AS (SELECT source, region_id AS right_id, min(word) AS right_word FROM pw GROUP BY ALL),
sh AS (SELECT x.source, x.region_id, string_agg(CAST(a.word AS VARCHAR), ',' ORDER BY a.word) AS shared FROM x JOIN pw a ON a.source = x.source AND a.region_id = x.region_id JOIN pw b ON b.source = x.source AND b.region_id = x.right_id AND b.word = a.word GROUP BY ALL),
cr AS (SELECT DISTINCT x.source, x.region_id FROM x JOIN words w ON w.source = x.source AND w_start < x.r_end AND x.r_end < w_end)
SELECT x.source, x.region_id AS left_id, x.right_id, x.r_end AS boundary, x.right_start - x.r_end AS gap, x.right_start = x.r_end AS touching, x.label IS NOT DISTINCT FROM x.rl AS same_label, left_word, right_word, lw.text AS left_text, rw.text AS right_text, lu.region_id AS left_utterance, ru.region_id AS right_utterance,
coalesce(lu.region_id = ru.region_id, false) AS same_utterance, coalesce(shared, '') AS shared_words, cr.source IS NOT NULL AS word_crosses
FROM x LEFT JOIN f ON f.source = x.source AND f.region_id = x.region_id LEFT JOIN g ON g.source = x.source AND g.right_id = x.right_id LEFT JOIN words lw ON lw.source = x.source AND lw.word = left_word LEFT JOIN words rw ON rw.source = x.source AND rw.word = right_word
LEFT JOIN regions lu ON lu.source = x.source AND lu.word_start <= left_word AND left_word < lu.word_end LEFT JOIN regions ru ON ru.source = x.source AND ru.word_start <= right_word AND right_word < ru.word_end LEFT JOIN sh ON sh.source = x.source AND sh.region_id = x.region_id LEFT JOIN cr ON cr.source = x.source AND cr.region_id = x.region_id WHERE x.right_id IS NOT NULL"""
)
def turn_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence between regions that were moved so that they overlap or leave gaps."""
    words = _words(spark, sf_dir)
    regions = _regions(words)
    moved = regions.where("word_end - word_start > 4").withColumns({"r_start": F.col("r_start") - 1.5, "r_end": F.col("r_end") + F.when(F.col("region_id") % 2 == 0, 1.75).otherwise(-1.5)})
    key = F.concat_ws(":", "source", "region_id")
    out = evidence.boundary_evidence(moved.withColumn("region_id", F.struct("source", F.col("region_id").alias("turn"))).select("source", "region_id", "r_start", "r_end", "label", "heard"), words.select("source", "word", "text", "w_start", "w_end"), regions.select("source", "utterance", "word_start", "word_end"), CELL)
    return out.select("source", F.col("left_id.turn").alias("left_id"), F.col("right_id.turn").alias("right_id"), "boundary", "gap", "touching", "same_label", "left_word", "right_word", "left_text", "right_text", "left_utterance", "right_utterance", "same_utterance", _said("shared_words").alias("shared_words"), "word_crosses")


_TOKENS = r"list_transform(regexp_extract_all({}, '[\p{{L}}\p{{M}}\p{{N}}_]+(?:[''’][\p{{L}}\p{{M}}\p{{N}}_]+)*'), lambda x: replace(replace(lower(x), 'ß', 'ss'), '’', ''''))"
_MATCH = f"""{_CW}, wt AS (SELECT source, word, {_TOKENS.format("text")} AS ts FROM words), tk AS (SELECT source, word, unnest(ts) AS token, unnest(range(len(ts))) AS i, len(ts) AS n FROM wt),
st AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY word, i) AS pos FROM tk), ls AS (SELECT source, list(token ORDER BY pos) AS l FROM st GROUP BY source), tg AS (SELECT source, region_id, r_start, r_end, {_TOKENS.format("heard")} AS t FROM regions),
hit AS (SELECT tg.source, tg.region_id, a.word AS first, b.word AS last FROM tg JOIN ls ON ls.source = tg.source JOIN st a ON a.source = tg.source AND a.i = 0 AND len(t) > 0 AND l[a.pos:a.pos + len(t) - 1] = t JOIN st b ON b.source = tg.source AND b.pos = a.pos + len(t) - 1 AND b.i = b.n - 1),
m AS (SELECT tg.source, tg.region_id, any_value(r_start) AS r_start, any_value(r_end) AS r_end, count(first) AS n_matches, CASE WHEN count(first) = 1 THEN min(first) END AS first, CASE WHEN count(first) = 1 THEN min(last) END AS last FROM tg LEFT JOIN hit USING (source, region_id) GROUP BY tg.source, tg.region_id)"""


def _matches(words: DataFrame) -> DataFrame:
    return recovery.region_matches(words.select("source", "word", "text", "w_start", "w_end"), _regions(words))


@_query(f"WITH {_MATCH} SELECT source, region_id, n_matches, first, last FROM m")
def region_text_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(_words(spark, sf_dir)).select("source", "region_id", F.col("n_matches").cast("long").alias("n_matches"), "first", "last")


@_query(f"WITH {_MATCH}, x AS (SELECT *, lead(first) OVER p AS nf, lead(r_start) OVER p AS ns FROM m WINDOW p AS (PARTITION BY source ORDER BY r_start, r_end, region_id)) SELECT DISTINCT source, last AS word FROM x WHERE last + 1 = nf AND r_end <= ns")
def inferred_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.inferred_boundaries(_matches(_words(spark, sf_dir)), CELL)


@_query(
    f"""WITH {_MATCH}, z AS (SELECT source, word, w_end - w_start <= 1e-6 AS z, w_end - w_start > 2 AS l FROM words), i AS (SELECT source, 'zero_duration' AS issue, word FROM z WHERE z UNION ALL SELECT source, 'long_word', word FROM z WHERE l)
SELECT m.source, m.region_id, m.first, m.last, string_agg(DISTINCT issue, '+' ORDER BY issue) AS issues FROM m JOIN i ON i.source = m.source AND m.first <= i.word AND i.word <= m.last GROUP BY ALL"""
)
def issue_recoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir)
    length = F.col("w_end") - F.col("w_start")
    issues = words.select("source", F.when(length <= 1e-6, "zero_duration").when(length > 2, "long_word").alias("issue"), F.col("word").alias("first"), F.col("word").alias("last")).where("issue is not null")
    return recovery.issue_candidates(issues, _matches(words)).select("source", "region_id", "first", "last", F.array_join("issues", "+").alias("issues"))


@_query(
    f"""WITH {_MATCH}, b AS (SELECT source, word FROM words WHERE word % 5 = 2), e AS (SELECT b.source, b.word, w.w_end AS be, n.w_start AS ns, n.w_end AS ne FROM b JOIN words w USING (source, word) JOIN words n ON n.source = b.source AND n.word = b.word + 1),
c AS (SELECT e.*, r.region_id, r.r_start, r.r_end, count(*) OVER (PARTITION BY e.source, e.word) AS k FROM e JOIN regions r ON r.source = e.source AND r.r_start < be AND be < r.r_end),
gone AS (SELECT DISTINCT c.source, c.word FROM c JOIN hit h ON h.source = c.source AND h.region_id = c.region_id AND h.first <= c.word AND h.last > c.word WHERE k = 1 AND ns < r_end AND ne > r_start)
SELECT b.source, b.word FROM b ANTI JOIN gone USING (source, word)"""
)
def validated_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth word stands for a sentence's end."""
    words = _words(spark, sf_dir).select("source", "word", "turn", "role", "heard", "text", "w_start", "w_end")
    regions, marks = _regions(words), words.where("word % 5 = 2").select("source", "word")
    return recovery.validated_boundaries(marks, words, regions, recovery.match_places(words, regions), CELL)


_TURNS = """t AS (SELECT turn_id, source_id, source_start, source_end FROM (SELECT conv_id * 100 + turn AS turn_id, conv_id AS source_id, turn * 4.0 AS source_start, turn * 4.0 + 0.75 + len(text) % 9 * 0.5 AS source_end FROM conversations)),
pl AS (SELECT *, unnest(CASE WHEN source_end - source_start >= 2 THEN list_transform(range(CAST(floor((source_end - source_start - 2 + 1e-9) / 0.25) AS BIGINT) + 1), lambda i: least(source_start + 1 + i * 0.25, source_end - 1)) WHEN source_end - source_start >= 1 THEN [(source_start + source_end) / 2] ELSE [] END) AS boundary FROM t)"""
_SPOKEN = "v AS (SELECT conv_id AS source_id, turn * 4.0 + k * 0.5 AS w_start, turn * 4.0 + k * 0.5 + (3 + (turn + k) % 3) * 0.125 AS w_end FROM (SELECT conv_id, turn, unnest(range(8)) AS k FROM conversations) WHERE (conv_id + k) % 5 > 0)"


def _turn_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = _table(spark, sf_dir, "conversations")
    start = F.col("turn") * 4.0
    turns = turn.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("conv_id").alias("source_id"), start.alias("source_start"), (start + 0.75 + F.char_length("text") % 9 * 0.5).alias("source_end"))
    return changes.boundaries(turns, with_words=True)


@_query(f"WITH {_TURNS} SELECT turn_id, source_id, boundary FROM pl")
def speaker_change_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_places(spark, sf_dir).select("turn_id", "source_id", "boundary")


@_query(
    f"""WITH {_TURNS}, {_SPOKEN}, sd AS (SELECT *, unnest(['left', 'right']) AS side FROM pl), sz AS (SELECT *, least(1.0, CASE WHEN side = 'left' THEN boundary - source_start ELSE source_end - boundary END) AS size FROM sd),
tr AS (SELECT *, unnest(range(16)) AS shift FROM sz WHERE size >= 0.5), w AS (SELECT *, CASE WHEN side = 'left' THEN boundary - shift * 0.05 - size ELSE boundary + shift * 0.05 END AS ws, CASE WHEN side = 'left' THEN boundary - shift * 0.05 ELSE boundary + shift * 0.05 + size END AS we FROM tr),
k AS (SELECT w.turn_id, w.boundary, w.side, w.shift, w.ws, w.we, round(sum(least(we, w_end) - greatest(ws, w_start)), 9) AS speech FROM w JOIN v ON v.source_id = w.source_id AND least(we, w_end) > greatest(ws, w_start) WHERE ws >= source_start AND we <= source_end GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY turn_id, boundary, side ORDER BY speech DESC, shift) AS n FROM k), g AS (SELECT * FROM o WHERE n = 1 AND speech / (we - ws) >= 0.5)
SELECT a.turn_id, a.boundary, round(a.ws, 6) AS left_start, round(a.we, 6) AS left_end, round(b.ws, 6) AS right_start, round(b.we, 6) AS right_end, CASE WHEN least(a.we - a.ws, b.we - b.ws) >= 1 - 1e-6 THEN 'full' ELSE 'adaptive' END AS kind FROM g a JOIN g b ON a.side = 'left' AND b.side = 'right' AND a.turn_id = b.turn_id AND a.boundary = b.boundary"""
)
def speaker_change_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k")).where("(conv_id + k) % 5 > 0")
    start = F.col("turn") * 4.0 + F.col("k") * 0.5
    words = word.select(F.col("conv_id").alias("source_id"), start.alias("w_start"), (start + (3 + (F.col("turn") + F.col("k")) % 3) * 0.125).alias("w_end"))
    out = changes.best_windows(_turn_places(spark, sf_dir), words, 8)
    return out.select("turn_id", "boundary", *(F.round(c, 6).alias(c) for c in ("left_start", "left_end", "right_start", "right_end")), changes.window_kind().alias("kind"))


_VT = """tt AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS voice_id, CASE WHEN vec_id % 4 = 0 THEN 'assigned' WHEN vec_id % 4 = 1 THEN 'ignore' WHEN vec_id % 4 = 2 THEN 'unknown' END AS assignment_status, CASE WHEN vec_id % 3 = 0 THEN 'reviewed' END AS review_status,
CASE WHEN vec_id % 5 = 0 THEN 'rejected' WHEN vec_id % 5 = 1 THEN 'accepted' END AS curation_status, vec_id % 7 = 0 AS near_start, vec_id % 11 = 0 AS near_end, NULL AS boundary_status, 'o' || vec_id AS observation FROM embeddings)"""


def _state_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    state = F.when(v % 4 == 0, "assigned").when(v % 4 == 1, "ignore").when(v % 4 == 2, "unknown")
    return _table(spark, sf_dir, "embeddings").select(
        v.alias("id"), F.col("label").cast("string").alias("voice_id"), state.alias("assignment_status"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("double").alias("confidence"), F.when(v % 3 == 0, "reviewed").alias("review_status"),
        F.when(v % 5 == 0, "rejected").when(v % 5 == 1, "accepted").alias("curation_status"), (v % 7 == 0).alias("near_start"), (v % 11 == 0).alias("near_end"), F.lit(None).cast("string").alias("boundary_status"), F.concat(F.lit("o"), v).alias("observation"),
    )


def _told(decided: transitions.Decided, *columns: str) -> DataFrame:
    return decided.rows.join(decided.refused, "id", "full_outer").select("id", *columns, "reason")


@_query(
    f"""WITH {_VT}, q AS (SELECT vec_id AS id, CAST((label + 1) % 12 AS VARCHAR) AS v FROM embeddings WHERE vec_id % 6 < 2 UNION ALL SELECT vec_id, '1' FROM embeddings WHERE vec_id % 50 = 0 UNION ALL SELECT -vec_id - 1, '2' FROM embeddings WHERE vec_id % 90 = 0), c AS (SELECT id, count(*) AS n, min(v) AS v FROM q GROUP BY id),
x AS (SELECT coalesce(tt.id, c.id) AS id, tt.*  EXCLUDE (id), n, v, CASE WHEN n IS NULL THEN NULL WHEN tt.id IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' WHEN CAST(v AS INT) > 9 THEN 'no such voice' END AS reason FROM tt FULL JOIN c ON c.id = tt.id)
SELECT id, CASE WHEN n = 1 AND reason IS NULL THEN v ELSE voice_id END AS voice_id, CASE WHEN n = 1 AND reason IS NULL THEN 'assigned' ELSE assignment_status END AS assignment_status, CASE WHEN n = 1 AND reason IS NULL THEN 'manual' END AS method, CASE WHEN n = 1 AND reason IS NULL THEN NULL ELSE observation END AS observation, reason FROM x"""
)
def turns_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    voices = e.select(F.col("label").cast("string").alias("id")).distinct()
    asked = e.where("vec_id % 6 < 2").select(F.col("vec_id").alias("id"), ((F.col("label") + 1) % 12).cast("string").alias("voice_id"))
    asked = asked.union(e.where("vec_id % 50 = 0").select("vec_id", F.lit("1"))).union(e.where("vec_id % 90 = 0").select(-F.col("vec_id") - 1, F.lit("2")))
    asked = asked.withColumns({"method": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    return _told(transitions.assign_turns(_state_turns(spark, sf_dir), voices, asked), "voice_id", "assignment_status", "method", "observation")


@_query(
    f"""WITH {_VT}, a AS (SELECT * REPLACE (CASE WHEN assignment_status = 'ignore' THEN NULL ELSE voice_id END AS voice_id, CASE WHEN assignment_status = 'ignore' THEN NULL ELSE observation END AS observation, CASE WHEN assignment_status = 'ignore' THEN 'rejected' ELSE curation_status END AS curation_status, CASE WHEN assignment_status = 'ignore' THEN 'reviewed' ELSE review_status END AS review_status, CASE WHEN assignment_status = 'ignore' THEN 'unknown' ELSE assignment_status END AS assignment_status) FROM tt),
b AS (SELECT * REPLACE (CASE WHEN id % 9 = 0 THEN 'pending' ELSE review_status END AS review_status) FROM a),
c AS (SELECT * REPLACE (CASE WHEN id % 9 = 1 THEN 'rejected' ELSE curation_status END AS curation_status, CASE WHEN id % 9 = 1 THEN 'reviewed' ELSE review_status END AS review_status) FROM b),
d AS (SELECT * REPLACE (CASE WHEN id % 2 = 0 AND (near_start OR near_end) THEN 'clipped' ELSE boundary_status END AS boundary_status) FROM c),
e AS (SELECT * REPLACE (CASE WHEN id % 9 = 2 THEN 'reviewed' ELSE review_status END AS review_status, CASE WHEN id % 9 = 2 THEN CASE WHEN curation_status = 'rejected' THEN 'rejected' ELSE 'accepted' END ELSE curation_status END AS curation_status, CASE WHEN id % 9 = 2 THEN CASE WHEN assignment_status = 'assigned' THEN 'n' || id END ELSE observation END AS observation) FROM d),
f AS (SELECT * REPLACE (CASE WHEN id % 9 = 3 THEN 'pending' ELSE review_status END AS review_status, CASE WHEN id % 9 = 3 THEN 'pending' ELSE curation_status END AS curation_status, CASE WHEN id % 9 = 3 THEN NULL ELSE observation END AS observation) FROM e),
g AS (SELECT * REPLACE (CASE WHEN id % 9 = 4 THEN 'unknown' ELSE assignment_status END AS assignment_status, CASE WHEN id % 9 = 4 THEN NULL ELSE voice_id END AS voice_id, CASE WHEN id % 9 = 4 THEN NULL ELSE observation END AS observation) FROM f)
SELECT id, voice_id, assignment_status, review_status, curation_status, boundary_status, observation FROM g"""
)
def turns_decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transition after another: migration, review, curation, boundary, end of a review, its reopening, a voice forgotten."""
    turns = transitions.migrate_ignored(_state_turns(spark, sf_dir))
    ask = lambda rest, **more: _table(spark, sf_dir, "embeddings").where(rest).select(F.col("vec_id").alias("id"), *(F.lit(v).alias(k) for k, v in more.items()))
    turns = transitions.set_review(turns, ask("vec_id % 9 = 0", status="pending")).rows
    turns = transitions.set_curation(turns, ask("vec_id % 9 = 1", status="rejected")).rows
    turns = transitions.set_boundary_review(turns, ask("vec_id % 2 = 0", status="clipped")).rows
    seen = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("n"), "vec_id").alias("observation"))
    turns = transitions.finish_review(turns, seen, ask("vec_id % 9 = 2")).rows
    turns = transitions.reopen_review(turns, ask("vec_id % 9 = 3")).rows
    turns = transitions.forget_voice(turns, ask("vec_id % 9 = 4")).rows
    return turns.select("id", "voice_id", "assignment_status", "review_status", "curation_status", "boundary_status", "observation")


_EV = "er AS (SELECT event_id AS id, event_type AS source_id, CAST(epoch_us(ts) AS DOUBLE) AS source_start, epoch_us(ts) + round(value * 1e6) AS source_end, CASE WHEN event_id % 8 = 1 THEN 'rejected' END AS status, CASE WHEN event_id % 8 = 1 THEN 'other' END AS reason FROM events)"


def _event_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    old = F.col("event_id") % 8 == 1
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("source_id"), at.alias("source_start"), (at + F.round(F.col("value") * 1e6)).alias("source_end"), F.when(old, "rejected").alias("status"), F.when(old, "other").alias("reason"), F.lit(None).cast("string").alias("notes"))


def _used(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").where("event_id % 5 = 0").select(F.col("event_id").alias("id"), F.array("event_id").alias("source_regions"))


@_query(
    f"""WITH {_EV}, q AS (SELECT event_id AS id, (['non_speech', 'other', 'bad'])[event_id % 9 // 3 + 1] AS r FROM events WHERE event_id % 3 = 0),
x AS (SELECT er.*, q.r, CASE WHEN q.r IS NULL THEN NULL WHEN q.r = 'bad' THEN 'no such reason' WHEN er.id % 5 = 0 THEN 'belongs to a turn' WHEN status = 'rejected' AND reason <> q.r THEN 'rejected otherwise' END AS refused FROM er LEFT JOIN q USING (id))
SELECT id, CASE WHEN r IS NOT NULL AND refused IS NULL THEN 'rejected' ELSE status END AS status, CASE WHEN r IS NOT NULL AND refused IS NULL THEN r ELSE reason END AS why, refused AS reason FROM x"""
)
def regions_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    why = F.element_at(F.array(*map(F.lit, ("non_speech", "other", "bad"))), (F.floor(F.col("event_id") % 9 / 3) + 1).cast("int"))
    asked = _table(spark, sf_dir, "events").where("event_id % 3 = 0").select(F.col("event_id").alias("id"), why.alias("reason"), F.lit(None).cast("string").alias("notes"))
    out = transitions.reject_regions(_event_regions(spark, sf_dir), _used(spark, sf_dir), asked)
    return out.rows.select("id", "status", F.col("reason").alias("why")).join(out.refused, "id", "left").select("id", "status", "why", "reason")


@_query(f"WITH {_EV} SELECT id, source_id, CASE WHEN id % 5 = 0 THEN CASE WHEN status = 'rejected' THEN 'conflict' ELSE 'reconciled: ' || id END WHEN status = 'rejected' THEN 'rejected: ' || reason ELSE 'pending' END AS state FROM er")
def region_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = _used(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    return views.region_list(_event_regions(spark, sf_dir), used).select("id", "source_id", "state")


@_query(
    """WITH t AS (SELECT conv_id AS source_id, turn AS id, CASE WHEN turn % 3 = 1 THEN 'reviewed' END AS r FROM conversations)
SELECT source_id, id, row_number() OVER w AS position, lag(id) OVER w AS previous, lead(id) OVER w AS next,
coalesce(last_value(CASE WHEN r IS NULL THEN id END IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), id) AS previous_pending, coalesce(first_value(CASE WHEN r IS NULL THEN id END IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), id) AS next_pending
FROM t WINDOW w AS (PARTITION BY source_id ORDER BY id)"""
)
def review_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), F.col("turn").alias("id"), F.col("turn").cast("double").alias("source_start"), (F.col("turn") + 1.0).alias("source_end"), F.when(F.col("turn") % 3 == 1, "reviewed").alias("review_status"))
    return views.cursors(turns).withColumn("position", F.col("position").cast("long"))


@_query(f"WITH {_VT} SELECT id, CASE WHEN assignment_status = 'assigned' THEN 'assigned to ' || voice_id ELSE coalesce(assignment_status, 'unassigned') END AS assignment, coalesce(review_status, 'pending') AS review, CASE WHEN near_start AND near_end THEN 'near source start and end: unknown' WHEN near_start THEN 'near source start: unknown' WHEN near_end THEN 'near source end: unknown' ELSE '' END AS boundary FROM tt")
def turn_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _state_turns(spark, sf_dir).withColumns({"source_id": F.lit("s"), "source_start": F.lit(0.0), "source_end": F.lit(1.0)})
    return views.turn_list(turns).select("id", "assignment", "review", "boundary")


@_query(
    """WITH r AS (SELECT user_id AS source_id, event_type AS detector, CAST(floor(value) AS DOUBLE) AS source_start, nullif(user_id % 3, 0) AS detector_label, event_id % 2 = 0 AS old FROM events),
d AS (SELECT DISTINCT source_id, detector, source_start, detector_label FROM r WHERE NOT old) SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM r WHERE old AND r.source_id = d.source_id AND r.detector = d.detector AND r.source_start = d.source_start AND r.detector_label IS NOT DISTINCT FROM d.detector_label)"""
)
def regions_imported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events are a detector's output, even ones were imported before."""
    e = _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source_id"), F.col("event_type").alias("detector"), F.lit(None).cast("string").alias("detector_model"), F.lit(None).cast("string").alias("detector_revision"), F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2")).alias("detector_parameters"),
        F.floor("value").cast("double").alias("source_start"), (F.floor("value") + 1.0).alias("source_end"), F.nullif(F.col("user_id") % 3, F.lit(0)).alias("detector_label"), "event_id",
    )
    return new_regions(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")).select("source_id", "detector", "source_start", "detector_label")


@_query("SELECT c_custkey, 'voice-' || lpad(CAST(120 + row_number() OVER (ORDER BY c_name, c_custkey) AS VARCHAR), 6, '0') AS id FROM customer")
def ids_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = spark.range(1).select(F.explode(F.array(F.lit("voice-000120"), F.lit("voice-7"), F.lit("voice-x"), F.lit("turn-000900"))).alias("id"))
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_new_ids(rows, old, "voice", ["c_name", "c_custkey"]).select("c_custkey", "id")


@_query(
    """WITH s AS (SELECT event_type AS source, event_id, CAST(epoch_us(ts) AS DOUBLE) AS a, epoch_us(ts) + round(value * 1e6) AS b FROM events WHERE event_id % 2 = 0), v AS (SELECT event_type AS source, CAST(epoch_us(ts) AS DOUBLE) AS c, epoch_us(ts) + round(value * 1e7) AS d FROM events WHERE event_id % 2 = 1),
z AS (SELECT source, max(b) + 5e5 AS duration FROM s GROUP BY source), x AS (SELECT s.*, duration, lag(b) OVER w AS pb, lead(a) OVER w AS na FROM s JOIN z USING (source) WINDOW w AS (PARTITION BY source ORDER BY a, b)),
h AS (SELECT x.event_id, min(c) AS c, max(d) AS d FROM x JOIN v ON v.source = x.source AND least(b, d) > greatest(a, c) WHERE pb IS NULL OR na IS NULL GROUP BY 1)
SELECT x.event_id, CASE WHEN pb IS NULL THEN greatest(0, least(a, coalesce(c, a)) - 1e6) ELSE (pb + a) / 2 END AS clip_start, CASE WHEN na IS NULL THEN least(duration, greatest(b, coalesce(d, b)) + 1e6) ELSE (b + na) / 2 END AS clip_end FROM x LEFT JOIN h USING (event_id)"""
)
def segment_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events are segments of one second a unit of value, odd ones speech of ten."""
    at = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    e = _table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), "event_id", at.alias("a"), (at + F.round(F.col("value") * 1e6)).alias("b"), (at + F.round(F.col("value") * 1e7)).alias("d"))
    segments = e.where("event_id % 2 = 0").select("source", "event_id", "a", "b")
    segments = segments.join(segments.groupBy("source").agg((F.max("b") + 5e5).alias("duration")), "source")
    speech = e.where("event_id % 2 = 1").select("source", F.col("a").alias("c"), "d")
    return intervals.clip_bounds(segments, speech, ["source"], ("a", "b"), ("c", "d"), "duration", 1e6, 600_000_000).select("event_id", "clip_start", "clip_end")


@_query(
    """WITH f AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), w AS (SELECT DISTINCT label, k, k * 0.25 AS s, k * 0.25 + 0.75 AS e, CAST(floor(k * 0.25 / 0.125) AS BIGINT) AS a, greatest(CAST(floor(k * 0.25 / 0.125) AS BIGINT) + 1, CAST(floor((k * 0.25 + 0.75) / 0.125) AS BIGINT)) AS b FROM (SELECT label, unnest(range(12)) AS k FROM f)),
m AS (SELECT label, k, avg(v[1]) AS m0, avg(v[2]) AS m1, avg(v[3]) AS m2, avg(v[4]) AS m3 FROM w LEFT JOIN f USING (label) WHERE f.frame >= a AND f.frame < b GROUP BY ALL)
SELECT w.label, w.k, CASE greatest(m0, m1, m2, m3) WHEN m0 THEN 0 WHEN m1 THEN 1 WHEN m2 THEN 2 WHEN m3 THEN 3 END AS dominant, round(greatest(m0, m1, m2, m3), 6) AS activity FROM w LEFT JOIN m USING (label, k)"""
)
def activity_at_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label's vectors are frames of four speakers, 0.125 seconds each."""
    e = _table(spark, sf_dir, "embeddings").select("label", "vec_id", F.slice("embedding", 1, 4).alias("v"))
    frames = intervals.running_sum(e, ["label"], ["vec_id"], F.lit(1), 64, "frame", before_only=True).select("label", "frame", "v")
    start = F.col("k") * 0.25
    windows = e.select("label").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11)))).select("label", "k", F.struct("label", "k").alias("window"), start.alias("s"), (start + 0.75).alias("e"))
    out = speakers.activity_window(frames, windows, ["label"], "window", ("s", "e"), "frame", "v", 0.125)
    return out.select("window.label", F.col("window.k").cast("long").alias("k"), F.col("dominant"), F.round(F.array_max("means"), 6).alias("activity"))


@_query(
    f"""WITH {_CW}, b AS (SELECT source, word, CASE WHEN word % 13 = 4 THEN w_start - 20 ELSE w_start END AS w_start, CASE WHEN word % 17 = 5 THEN w_start - 0.5 ELSE w_end END AS w_end FROM words), x AS (SELECT *, lag(w_start) OVER (PARTITION BY source ORDER BY word) AS p FROM b)
SELECT source, word, CASE WHEN w_start < 0 THEN 'negative start' WHEN w_end < w_start THEN 'ends before it starts' ELSE 'out of order' END AS problem FROM x WHERE w_start < 0 OR w_end < w_start OR w_start < p - 1e-6"""
)
def timeline_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _words(spark, sf_dir).withColumns({"w_end": F.when(F.col("word") % 17 == 5, F.col("w_start") - 0.5).otherwise(F.col("w_end")), "w_start": F.when(F.col("word") % 13 == 4, F.col("w_start") - 20).otherwise(F.col("w_start"))})
    return evidence.timeline_problems(w.select("source", "word", "w_start", "w_end")).select("source", "word", "problem")


@_query()
def derived_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of each conversation over its words. (No SQL: the sentence pattern looks ahead; tests hold it against plain Python.)"""
    words = _words(spark, sf_dir)
    texts = words.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word", "text"))), lambda x: x["text"]), " ").alias("text"))
    found, _ = evidence.sentence_utterances(texts, words.select("source", "word", "text"))
    return found.select("source", "text", "word_start", "word_end")


@_query("SELECT doc_id, CASE WHEN trim(coalesce(text, '')) <> '' THEN trim(text) END IS NOT NULL AS has_text FROM documents")
def said_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.said(F.col("text")).isNotNull().alias("has_text"))


@_query(
    f"""WITH {_CW}, g AS (SELECT source, region_id, r_start + 0.25 AS r_start, r_end - CASE WHEN region_id % 4 = 1 THEN 30 ELSE 0.25 END AS r_end, coalesce(label, 'none') AS label FROM regions WHERE region_id % 5 <> 4), u AS (SELECT source, word // 40 AS utterance, w_start, w_end FROM words),
m AS (SELECT u.source, utterance, region_id, any_value(label) AS label, min(w_start) AS a, max(w_end) AS b FROM u JOIN g ON g.source = u.source AND r_start <= (w_start + w_end) / 2 AND (w_start + w_end) / 2 <= r_end GROUP BY ALL),
x AS (SELECT *, a - lag(b) OVER (PARTITION BY source, utterance ORDER BY a, b, region_id) AS gap FROM m), t AS (SELECT source, utterance, count(*) AS n, count(DISTINCT label) AS l, max(gap) AS gap FROM x GROUP BY ALL)
SELECT source, utterance, coalesce(n, 0) AS n_regions, gap, CASE WHEN n IS NULL THEN 'candidate' WHEN l > 1 THEN 'conflict' WHEN n = 1 THEN 'reconciled' ELSE 'merge_candidate' END AS status FROM (SELECT DISTINCT source, utterance FROM u) LEFT JOIN t USING (source, utterance)"""
)
def utterance_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 40 words are an utterance; regions are cut short or missing."""
    words = _words(spark, sf_dir)
    regions = _regions(words).where("region_id % 5 <> 4").withColumns({"r_start": F.col("r_start") + 0.25, "r_end": F.col("r_end") - F.when(F.col("region_id") % 4 == 1, 30.0).otherwise(0.25), "label": F.coalesce("label", F.lit("none"))})
    return evidence.utterance_states(words.select("source", F.floor(F.col("word") / 40).alias("utterance"), "w_start", "w_end"), regions, CELL)


@_query(
    f"""WITH {_CW}, g AS (SELECT source, r_start - 1.5 AS r_start, r_end + 1.25 AS r_end, label FROM regions WHERE region_id % 5 <> 4), p AS (SELECT w.source, w.word, label FROM words w JOIN g ON g.source = w.source AND least(r_end, w_end) > greatest(r_start, w_start)),
a AS (SELECT source, word, count(*) AS n, min(label) AS lo, max(label) AS hi FROM p GROUP BY ALL)
SELECT w.source, w.word, coalesce(n, 0) AS n_regions, CASE WHEN lo = hi THEN lo END AS speaker, CASE WHEN n IS NULL THEN 'no_overlapping_region' WHEN lo IS NULL THEN 'no_speaker_label' WHEN lo <> hi THEN 'conflicting_overlapping_speakers' WHEN n = 1 THEN 'single_overlapping_region' ELSE 'consistent_overlapping_regions' END AS method
FROM words w LEFT JOIN a USING (source, word)"""
)
def attributed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and regions are numbered within their source."""
    words = _words(spark, sf_dir)
    regions = _regions(words).where("region_id % 5 <> 4").select("source", (F.col("r_start") - 1.5).alias("r_start"), (F.col("r_end") + 1.25).alias("r_end"), "label")
    return speakers.attribute_words(words, regions, ["source"], "word", ("w_start", "w_end"), ("r_start", "r_end"), "label", CELL)


@_query(
    f"""WITH {_CW}, p AS (SELECT r.source, r.region_id, w.word, least(r_end + 2, w_end) - greatest(r_start, w_start) AS part, w_start, w_end FROM regions r JOIN words w ON w.source = r.source AND least(r_end + 2, w_end) > greatest(r_start, w_start)),
a AS (SELECT source, region_id, sum(part) AS covered, count(*) AS n, string_agg(CAST(word AS VARCHAR), ',' ORDER BY w_start, w_end, word) AS ids FROM p GROUP BY ALL)
SELECT r.source, r.region_id, round(coalesce(covered, 0), 6) AS covered, coalesce(n, 0) AS n, coalesce(ids, '') AS ids FROM regions r LEFT JOIN a USING (source, region_id)"""
)
def covered_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each region, two seconds longer, its source's words cover, and which they are."""
    words = _words(spark, sf_dir).select("source", "word", "w_start", "w_end")
    regions = _regions(_words(spark, sf_dir)).select("source", "region_id", "r_start", (F.col("r_end") + 2).alias("r_end"))
    spans = ("r_start", "r_end"), ("w_start", "w_end")
    held = intervals.coverage(regions, words, ["source"], "region_id", *spans, CELL).join(intervals.overlapping_ids(regions, words, ["source"], "region_id", "word", *spans, CELL), ["source", "region_id"])
    return held.select("source", "region_id", F.round("covered", 6).alias("covered"), "n", "ids")
