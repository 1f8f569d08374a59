"""Where a turn's speaker may change: boundaries with a window of speech on both sides, and the distance of the two voices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.operators.intervals import overlap_join
from turnweave.operators.vectors import cosine

# Seconds of a full and a least window, and the divergences from which a change is suspected.
WINDOW, STEP, LEAST_WINDOW, MAX_SHIFT, SHIFT_STEP, LEAST_SPEECH = 1.0, 0.25, 0.5, 0.75, 0.05, 0.5
FULL_THRESHOLD = ADAPTIVE_THRESHOLD = 0.92
EDGE = 1e-6


def window_kind() -> Column:
    """'full' if both windows (left_start to left_end, right_start to right_end) are a full one long, else 'adaptive'."""
    both = F.least(F.col("left_end") - F.col("left_start"), F.col("right_end") - F.col("right_start"))
    return F.when(both >= WINDOW - EDGE, "full").otherwise("adaptive")


def suspected(full: float = FULL_THRESHOLD, adaptive: float = ADAPTIVE_THRESHOLD) -> Column:
    return F.col("divergence") >= F.when(window_kind() == "full", full).otherwise(adaptive)


def boundaries(turns: DataFrame, with_words: bool, window: float = WINDOW, step: float = STEP, least: float = LEAST_WINDOW) -> DataFrame:
    """(turn_id, source_id, source_start, source_end, boundary): from one window behind the start to one before the end, in steps, the last place
    included only if a step meets it; with words, a turn too short for that but of two least windows has its middle."""
    length = F.col("source_end") - F.col("source_start")
    first = F.col("source_start") + window
    n = F.floor((length - 2 * window + 1e-9) / step).cast("int")
    grid = F.transform(F.sequence(F.lit(0), n), lambda i: F.least(first + i * step, F.col("source_end") - window))
    middle = F.array((F.col("source_start") + F.col("source_end")) / 2)
    places = F.when(length >= 2 * window, grid).when(F.lit(with_words) & (length >= 2 * least), middle)
    base = turns.where("source_start >= 0 and source_end > source_start").select(F.col("id").alias("turn_id"), "source_id", "source_start", "source_end")
    return base.withColumn("boundary", F.explode(places))


def best_windows(places: DataFrame, words: DataFrame, width: int, window: float = WINDOW, least: float = LEAST_WINDOW, max_shift: float = MAX_SHIFT, shift_step: float = SHIFT_STEP, ratio: float = LEAST_SPEECH) -> DataFrame:
    """(turn_id, boundary, left_start, left_end, right_start, right_end): on each side the window with most speech, of those the one nearest
    to the boundary, shifted away from it by up to `max_shift` and inside the turn. A side with less than `least` of room, or with speech in less
    than `ratio` of its window, drops the boundary. `words` has source_id, w_start, w_end; words that overlap count twice."""
    sides = F.explode(F.array(F.lit("left"), F.lit("right")))
    shifts = F.explode(F.sequence(F.lit(0), F.floor((F.lit(max_shift) + 1e-9) / shift_step).cast("int")))
    room = F.when(F.col("side") == "left", F.col("boundary") - F.col("source_start")).otherwise(F.col("source_end") - F.col("boundary"))
    tried = places.withColumn("side", sides).withColumn("size", F.least(F.lit(window), room)).where(F.col("size") >= least).withColumn("shift", shifts)
    away = F.col("shift") * shift_step
    tried = tried.withColumn("ws", F.when(F.col("side") == "left", F.col("boundary") - away - F.col("size")).otherwise(F.col("boundary") + away))
    tried = tried.withColumn("we", F.when(F.col("side") == "left", F.col("boundary") - away).otherwise(F.col("boundary") + away + F.col("size")))
    tried = tried.where("ws >= source_start and we <= source_end").select("turn_id", "source_id", "boundary", "side", "shift", "ws", "we")
    heard = overlap_join(tried, words.select("source_id", "w_start", "w_end"), ["source_id"], ("ws", "we"), ("w_start", "w_end"), width)
    part = F.least("we", "w_end") - F.greatest("ws", "w_start")
    covered = heard.groupBy("turn_id", "boundary", "side", "shift", "ws", "we").agg(F.sum(part).alias("speech"))
    best = covered.groupBy("turn_id", "boundary", "side").agg(F.max_by(F.struct("ws", "we", "speech"), F.struct(F.round("speech", 9), -F.col("shift"))).alias("b"))
    good = best.where(F.col("b.speech") / (F.col("b.we") - F.col("b.ws")) >= ratio)
    pick = lambda side, end: F.max(F.when(F.col("side") == side, F.col(f"b.{end}"))).alias(f"{side}_{'start' if end == 'ws' else 'end'}")
    both = good.groupBy("turn_id", "boundary").agg(pick("left", "ws"), pick("left", "we"), pick("right", "ws"), pick("right", "we"))
    return both.where("left_start is not null and right_start is not null")


def flanks(places: DataFrame, window: float = WINDOW) -> DataFrame:
    """The same columns without words: a full window on each side."""
    b = F.col("boundary")
    return places.select("turn_id", "boundary", (b - window).alias("left_start"), b.alias("left_end"), b.alias("right_start"), (b + window).alias("right_end"))


def analysis_windows(bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(windows, pairs): each distinct window (window_id, w_start, w_end, to 9 decimals) of a source once, and each boundary's left and right
    window_id: a window that several boundaries share is encoded once. `bounds` has source_id."""
    ends = lambda side: F.struct(F.round(f"{side}_start", 9).alias("w_start"), F.round(f"{side}_end", 9).alias("w_end"))
    name = lambda side: F.sha2(F.concat_ws("|", "source_id", F.round(f"{side}_start", 9).cast("string"), F.round(f"{side}_end", 9).cast("string")), 256)
    both = bounds.withColumns({"left_id": name("left"), "right_id": name("right")})
    one = lambda side: both.select("source_id", F.col(f"{side}_id").alias("window_id"), ends(side).alias("_w")).select("source_id", "window_id", "_w.*")
    return one("left").union(one("right")).dropDuplicates(["window_id"]), both.select("turn_id", "boundary", "left_id", "right_id")


def score(pairs: DataFrame, vectors: DataFrame, encoders: tuple[str, str]) -> DataFrame:
    """(turn_id, boundary, similarities by encoder, mean_similarity, disagreement, divergence) from two encoders' vectors (window_id, encoder,
    vector); a boundary without all four vectors gives no row."""
    side = lambda end: pairs.join(vectors.select(F.col("window_id").alias(f"{end}_id"), "encoder", F.col("vector").alias(end)), f"{end}_id")
    both = side("left").select("turn_id", "boundary", "encoder", "left").join(side("right").select("turn_id", "boundary", "encoder", "right"), ["turn_id", "boundary", "encoder"])
    said = both.withColumn("_c", cosine(F.col("left"), F.col("right"))).where("_c is not null")
    a, b = (F.max(F.when(F.col("encoder") == e, F.col("_c"))).alias(f"{e}_similarity") for e in encoders)
    out = said.groupBy("turn_id", "boundary").agg(a, b).where(" and ".join(f"{e}_similarity is not null" for e in encoders))
    x, y = (F.col(f"{e}_similarity") for e in encoders)
    out = out.withColumns({"mean_similarity": (x + y) / 2, "disagreement": F.abs(x - y)})
    return out.withColumn("divergence", 1 - F.col("mean_similarity"))


def turn_evidence(turns: DataFrame, bounds: DataFrame, changes: DataFrame, full: float = FULL_THRESHOLD, adaptive: float = ADAPTIVE_THRESHOLD) -> DataFrame:
    """turn_id, status ('suspected', 'clear', or 'insufficient_evidence' without any comparison), n_changes, strongest (boundary of the largest
    divergence, the first of equal ones) and its divergence. Boundaries meet changes to 9 decimals."""
    key = F.round("boundary", 9).alias("_b")
    met = bounds.select("turn_id", key, "left_start", "left_end", "right_start", "right_end").join(changes.select("turn_id", key, "boundary", "divergence"), ["turn_id", "_b"])
    told = met.withColumn("suspected", suspected(full, adaptive)).groupBy("turn_id").agg(
        F.bool_or("suspected").alias("_any"), F.count("*").alias("n_changes"), F.max_by(F.struct("boundary", "divergence"), F.struct("divergence", -F.col("boundary"))).alias("_m")
    )
    out = turns.select(F.col("id").alias("turn_id")).join(told, "turn_id", "left")
    status = F.when(F.col("_any").isNull(), "insufficient_evidence").when(F.col("_any"), "suspected").otherwise("clear")
    return out.select("turn_id", status.alias("status"), F.coalesce("n_changes", F.lit(0)).alias("n_changes"), F.col("_m.boundary").alias("strongest"), F.col("_m.divergence").alias("divergence"))


def review_reasons(reasons: Column, status: Column) -> Column:
    """A turn's reasons for review, of which 'suspected_speaker_change' is this analysis' own: there if suspected, else taken out."""
    rest = F.filter(F.coalesce(reasons, F.array().cast("array<string>")), lambda r: r != "suspected_speaker_change")
    return F.when(status == "suspected", F.concat(rest, F.array(F.lit("suspected_speaker_change")))).otherwise(rest)


def totals(evidence: DataFrame) -> DataFrame:
    """One row: turns with a comparison, comparisons, suspected turns."""
    return evidence.agg(F.count_if(F.col("n_changes") > 0).alias("analysed"), F.coalesce(F.sum("n_changes"), F.lit(0)).alias("comparisons"), F.count_if(F.col("status") == "suspected").alias("suspected"))


def is_current(stored: DataFrame, planned: DataFrame, settings: dict[str, float]) -> DataFrame:
    """turn_id and current: whether stored evidence (turn_id, version, step, full_threshold, adaptive_threshold, boundaries) has these settings
    and exactly the planned boundaries (turn_id, boundary), in order, to 9 decimals. What is current need not be analysed again."""
    want = planned.groupBy("turn_id").agg(F.array_sort(F.collect_list(F.round("boundary", 9))).alias("_want"))
    same = F.transform("boundaries", lambda b: F.round(b, 9)) == F.coalesce("_want", F.array().cast("array<double>"))
    for name, value in settings.items():
        same = same & F.col(name).eqNullSafe(F.lit(value))
    return stored.join(want, "turn_id", "left").select("turn_id", F.coalesce(same, F.lit(False)).alias("current"))
