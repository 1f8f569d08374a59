"""What words, regions and transcripts say about each other: words of a range, evidence at boundaries between regions, sentences over aligned
words, suggestions for a turn's edges.

Tables: words (source, word: its number from 0, text, w_start, w_end); regions (source, region_id, r_start, r_end, label, heard: what a second
recogniser heard); utterances (source, utterance, word_start, word_end: the last left out); candidates (source, candidate, start, end, text,
issues). Times are seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.operators.intervals import beside, overlap_join, point_join, running_sum, with_sides
from turnweave.operators.speakers import WORDS_CELL
from turnweave.sources.scratch import dealt

EDGE = 1e-6
LONG_WORD = 2.0  # seconds; longer words are suspicious, as those without length are
W, R = ("w_start", "w_end"), ("r_start", "r_end")


def suspicious() -> Column:
    length = F.col("w_end") - F.col("w_start")
    return (length <= 0) | (length > LONG_WORD)


def words_of_ranges(ranges: DataFrame, words: DataFrame, range_id: str, span: tuple[str, str], width: int, zero_length: bool = True) -> DataFrame:
    """(source, range_id, word, suspicious): words that share time with a range; and, if asked for, words without length in it or at its edges."""
    a = ranges.select("source", range_id, F.col(span[0]).alias("_s"), F.col(span[1]).alias("_e"))
    over = overlap_join(a, words, ["source"], ("_s", "_e"), W, width).select("source", range_id, "word", suspicious().alias("suspicious"))
    if not zero_length:
        return over
    wider = a.withColumns({"_s": F.col("_s") - EDGE, "_e": F.col("_e") + EDGE})
    dots = point_join(words.where("w_end = w_start"), wider, ["source"], "w_start", ("_s", "_e"), width)
    return over.union(dots.select("source", range_id, "word", F.lit(True)))


def project_ranges(ranges: DataFrame, words: DataFrame, utterances: DataFrame, range_id: str, span: tuple[str, str], width: int) -> DataFrame:
    """source, range_id, words, suspicious, complete and touched: the numbers, in order, of the words of each range, of the suspicious ones among them, of
    the utterances that lie in it with all their words, and of those that have some. `spans.projected` says the same as ranges of numbers, for long ranges."""
    mine = words_of_ranges(ranges, words, range_id, span, width)
    numbers = mine.groupBy("source", range_id).agg(F.array_sort(F.collect_set("word")).alias("words"), F.array_sort(F.collect_set(F.when(F.col("suspicious"), F.col("word")))).alias("suspicious"))
    held = utterance_of_words(mine.select("source", range_id, "word").distinct(), utterances)
    met = held.groupBy("source", range_id, "utterance", "word_start", "word_end").agg(F.count("*").alias("_n"))
    told = met.groupBy("source", range_id).agg(
        F.array_sort(F.collect_list(F.when(F.col("_n") == F.col("word_end") - F.col("word_start"), F.col("utterance")))).alias("complete"), F.array_sort(F.collect_list("utterance")).alias("touched")
    )
    out = with_sides(ranges, numbers.join(told, ["source", range_id], "left"), ["source", range_id])
    empty = F.array().cast("array<bigint>")
    return out.select("source", range_id, *(F.coalesce(F.col(c).cast("array<bigint>"), empty).alias(c) for c in ("words", "suspicious", "complete", "touched")))


def utterance_of_words(rows: DataFrame, utterances: DataFrame) -> DataFrame:
    """Rows (source, word) with the utterances that have the word: one, where utterances don't overlap."""
    ends = utterances.withColumns({"_a": F.col("word_start").cast("double"), "_b": F.col("word_end") - 1.0}).where("word_end > word_start")
    return point_join(rows, ends, ["source"], "word", ("_a", "_b"), 64).drop("_a", "_b")


def projection_problems(projected: DataFrame) -> DataFrame:
    """Adds problem: 'no words', or 'gap' where the words' numbers don't follow one another."""
    span = F.element_at("words", -1) - F.element_at("words", 1) + 1
    return projected.withColumn("problem", F.when(F.size("words") < 1, "no words").when(span != F.size("words"), "gap"))


def projected_text(projected: DataFrame, words: DataFrame, range_id: str) -> DataFrame:
    """source, range_id, first, last, transcript of projections (source, range_id, words)."""
    flat = projected.select("source", range_id, F.explode("words").alias("word")).join(words.select("source", "word", "text"), ["source", "word"])
    told = flat.groupBy("source", range_id).agg(F.min("word").alias("first"), F.max("word").alias("last"), F.array_sort(F.collect_list(F.struct("word", "text"))).alias("_w"))
    return told.select("source", range_id, "first", "last", F.array_join(F.transform("_w", lambda x: F.trim(x["text"])), " ").alias("transcript"))


def split_words(halves: DataFrame, words: DataFrame, turn: str, width: int) -> DataFrame:
    """(source, turn, side, word) of a turn's halves (source, turn, side, start, end, cut): a word that both have goes where its middle is."""
    ranges = halves.withColumn("_half", F.struct(turn, "side", "cut"))
    held = words_of_ranges(ranges, words, "_half", ("start", "end"), width).select("source", "_half", "word").distinct().join(words.select("source", "word", *W), ["source", "word"])
    middle = F.when((F.col("w_start") + F.col("w_end")) / 2 < F.col("_half.cut"), "left").otherwise("right")
    twice = held.groupBy("source", F.col(f"_half.{turn}").alias(turn), "word").agg(F.count("*").alias("_n"), F.first("_half.side").alias("_side"), F.first(middle).alias("_middle"))
    return twice.select("source", turn, F.when(F.col("_n") > 1, F.col("_middle")).otherwise(F.col("_side")).alias("side"), "word")


def timeline_problems(words: DataFrame) -> DataFrame:
    """Words (source, word, w_start, w_end) that break a timeline, with the problem: a negative start, an end before the start, a start before
    that of the word before."""
    out = beside(words, ["source"], ["word"], ["w_start"], WORDS_CELL)
    problem = F.when(F.col("w_start") < 0, "negative start").when(F.col("w_end") < F.col("w_start"), "ends before it starts").when(F.col("w_start") < F.col("_before.w_start") - EDGE, "out of order")
    return out.withColumn("problem", problem).where("problem is not null").drop("_before")


def boundary_evidence(regions: DataFrame, words: DataFrame, utterances: DataFrame, width: int) -> DataFrame:
    """One row for each two regions that follow one another in a source: left_id, right_id, boundary, right_start, gap, touching, labels and whether
    they are the same (null equals null), the left's last and the right's first word with its text and utterance, whether both lie in one
    utterance, words that both regions have, whether a word crosses the boundary, suspicious words of the three, and what was heard left and right."""
    held = regions.select("source", "region_id", "r_start", "r_end", "label", "heard")
    columns = ["region_id", "r_start", "r_end", "label", "heard"]
    pairs = beside(held, ["source"], ["r_start", "r_end", "region_id"], columns, width, after=True, name="_r").where("_r is not null")
    pairs = pairs.select(
        "source", F.col("region_id").alias("left_id"), F.col("_r.region_id").alias("right_id"), F.col("r_end").alias("boundary"), F.col("_r.r_start").alias("right_start"), F.col("label").alias("left_label"),
        F.col("_r.label").alias("right_label"), F.col("heard").alias("left_heard"), F.col("_r.heard").alias("right_heard"),
    )
    of = words_of_ranges(regions, words, "region_id", R, width, zero_length=False)
    sets = of.groupBy("source", "region_id").agg(F.array_sort(F.collect_set("word")).alias("_w"), F.array_sort(F.collect_set(F.when(F.col("suspicious"), F.col("word")))).alias("_x"))
    left, right = (sets.select("source", F.col("region_id").alias(f"{x}_id"), F.col("_w").alias(f"_{x}"), F.col("_x").alias(f"_{x}_odd")) for x in ("left", "right"))
    over = point_join(pairs.select("source", "left_id", "boundary"), words, ["source"], "boundary", W, width).where("w_start < boundary and boundary < w_end")
    crossing = over.groupBy("source", "left_id").agg(F.array_sort(F.collect_set("word")).alias("_c"), F.array_sort(F.collect_set(F.when(suspicious(), F.col("word")))).alias("_c_odd"))
    out = pairs.join(left, ["source", "left_id"], "left").join(right, ["source", "right_id"], "left").join(crossing, ["source", "left_id"], "left")
    none = F.array().cast("array<bigint>")
    arrays = {c: F.coalesce(F.col(c).cast("array<bigint>"), none) for c in ("_left", "_right", "_c", "_left_odd", "_right_odd", "_c_odd")}
    out = out.withColumns(arrays).withColumns({"left_word": F.try_element_at("_left", F.lit(-1)), "right_word": F.try_element_at("_right", F.lit(1))})
    named = words.select("source", "word", F.col("text").alias("_t"))
    spoken = utterance_of_words(words.select("source", "word"), utterances).groupBy("source", "word").agg(F.min("utterance").alias("_u"))
    for side in ("left", "right"):
        known = named.join(spoken, ["source", "word"], "left").select("source", F.col("word").alias(f"{side}_word"), F.col("_t").alias(f"{side}_text"), F.col("_u").alias(f"{side}_utterance"))
        out = out.join(known, ["source", f"{side}_word"], "left")
    return out.select(
        "source", "left_id", "right_id", "boundary", "right_start", (F.col("right_start") - F.col("boundary")).alias("gap"), (F.col("right_start") == F.col("boundary")).alias("touching"), "left_label", "right_label",
        F.col("left_label").eqNullSafe(F.col("right_label")).alias("same_label"), "left_word", "right_word", "left_text", "right_text", "left_utterance", "right_utterance",
        F.coalesce(F.col("left_utterance") == F.col("right_utterance"), F.lit(False)).alias("same_utterance"), F.array_sort(F.array_intersect("_left", "_right")).alias("shared_words"), (F.size("_c") > 0).alias("word_crosses"),
        F.array_sort(F.array_distinct(F.concat("_left_odd", "_right_odd", "_c_odd"))).alias("suspicious_words"), "left_heard", "right_heard",
    )


def sentence_utterances(texts: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(utterances, problems): a source's text (source, text) cut into sentences, and the words (source, word, text) that each takes.

    Sentences and words are lined up by the letters of their tokens, whatever their spaces and hyphens. A source whose two letter sequences differ
    is a problem ('texts differ'), as is one with a sentence that ends inside a word ('cut word'); it gives no utterances. Words without letters
    go with the sentence before them, at the beginning with the first."""
    said = texts.select("source", F.posexplode(F.transform(T.sentences(F.col("text")), lambda x: F.trim(x))).alias("_k", "sentence"))
    said = said.withColumn("_letters", F.array_join(T.lexical_tokens(F.col("sentence")), "")).where("_letters <> ''").withColumn("_n", F.char_length("_letters"))
    said = running_sum(said, ["source"], ["_k"], F.col("_n"), WORDS_CELL, "_stop")
    lettered = words.withColumn("_letters", F.array_join(T.lexical_tokens(F.col("text")), "")).withColumn("_n", F.char_length("_letters"))
    lettered = running_sum(lettered, ["source"], ["word"], F.col("_n"), WORDS_CELL, "_stop")
    whole = lambda df, order, name: df.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_letters"))), lambda x: x["_letters"]), "").alias(name))
    both = whole(said, "_k", "_a").join(whole(lettered, "word", "_b"), "source", "full_outer")
    differ = both.where(~F.coalesce(F.col("_a"), F.lit("")).eqNullSafe(F.coalesce(F.col("_b"), F.lit("")))).select("source", F.lit("texts differ").alias("problem"))
    ends = lettered.where("_n > 0").select("source", "_stop", F.col("word").alias("_last"))
    met = said.join(ends, ["source", "_stop"], "left")
    cut = met.where("_last is null").select("source", F.lit("cut word").alias("problem")).distinct().join(dealt(differ), "source", "left_anti")
    problems = dealt(differ.union(cut))
    good = met.join(problems, "source", "left_anti")
    numbered = beside(good, ["source"], ["_k"], ["_last"], WORDS_CELL)
    total = words.groupBy("source").agg(F.max("word").alias("_end"))
    placed = beside(numbered.withColumnRenamed("_before", "_p"), ["source"], ["_k"], ["_k"], WORDS_CELL, after=True, name="_next").join(total, "source")
    # Words without letters behind a sentence are its own: it ends where the next word with letters begins.
    firsts = lettered.where("_n > 0").select("source", (F.col("_stop") - F.col("_n")).alias("_from"), F.col("word").alias("_first"))
    placed = placed.join(firsts.select("source", F.col("_from").alias("_stop"), F.col("_first").alias("_follows")), ["source", "_stop"], "left")
    stop = F.when(F.col("_next").isNull(), F.col("_end") + 1).otherwise(F.col("_follows"))
    out = placed.withColumn("word_end", stop)
    out = beside(out, ["source"], ["_k"], ["word_end"], WORDS_CELL, name="_q")
    return out.select("source", F.col("_k").alias("place"), F.col("sentence").alias("text"), F.coalesce("_q.word_end", F.lit(0)).alias("word_start"), "word_end"), problems


def edge_suggestions(candidates: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """Of utterance candidates without alignment issues: what a second recogniser suggests about their edges, at most one row each.

    source, candidate, method, edge, time, region_id, conflicting_region_id, candidate_text, heard_text. In this order, and only where exactly
    one region qualifies: 'end_extension' (a region goes on behind the end and hears the same words, the last one longer);
    'start_extension' (a region begins earlier and hears the same words behind others of the same sentence); 'start_conflict' (the one region
    around the start hears something else, and a later one begins with the candidate's first words)."""
    mine = candidates.where(F.coalesce(F.size("issues"), F.lit(0)) < 1).withColumn("_c", T.plain_tokens(F.col("text"))).where(F.size("_c") > 0)
    heard = regions.withColumn("heard_text", T.said(F.col("heard"))).withColumn("_h", T.plain_tokens(F.col("heard_text")))
    near = overlap_join(mine.select("source", "candidate", "start", "end", F.col("text").alias("candidate_text"), "_c"), heard.select("source", "region_id", "r_start", "r_end", "heard_text", "_h"), ["source"], ("start", "end"), R, width, touching=True)
    n, m = F.size("_c"), F.size("_h")
    known = F.col("heard_text").isNotNull() & (m > 0)
    last, other = F.element_at("_c", -1), F.try_element_at("_h", n)
    ending = known & (F.col("r_start") < F.col("end")) & (F.col("end") < F.col("r_end")) & (m >= n) & (F.slice("_c", F.lit(1), n - 1) == F.slice("_h", F.lit(1), n - 1)) & (F.char_length(other) > F.char_length(last)) & F.startswith(other, last)
    pieces = F.filter(F.regexp_extract_all("heard_text", F.lit(r"\S+"), F.lit(0)), lambda w: F.size(T.plain_tokens(w)) > 0)
    before = F.array_join(F.slice(pieces, F.lit(1), m - n), " ")
    opening = known & (F.col("r_start") < F.col("start") - 0.001) & (F.col("r_end") > F.col("start")) & (m > n) & (F.slice("_h", m - n + 1, n) == F.col("_c")) & ~before.rlike("[.!?…]")
    around = (F.col("r_start") < F.col("start")) & (F.col("start") < F.col("r_end"))
    second = (n < 2) | (m < 2) | (F.try_element_at("_c", F.lit(2)) == F.try_element_at("_h", F.lit(2)))
    later = known & (F.col("r_start") > F.col("start") + 0.001) & (F.col("r_start") < F.col("end")) & (F.element_at("_c", 1) == F.try_element_at("_h", F.lit(1))) & second
    row = F.struct("region_id", "r_start", "r_end", "heard_text", "_h")
    pick = lambda when: F.collect_list(F.when(F.coalesce(when, F.lit(False)), row))
    told = near.groupBy("source", "candidate", "candidate_text", "_c").agg(pick(ending).alias("_e"), pick(opening).alias("_o"), pick(around).alias("_a"), pick(later).alias("_l"))
    one = lambda c: F.size(c) == 1
    of = lambda c, f: F.try_element_at(c, F.lit(1))[f]
    differs = of("_a", "heard_text").isNotNull() & ~F.coalesce(F.try_element_at(of("_a", "_h"), F.lit(1)) == F.element_at("_c", 1), F.lit(False))
    method = F.when(one("_e"), "end_extension").when(one("_o"), "start_extension").when(one("_a") & differs & one("_l"), "start_conflict")
    chosen = lambda f: F.when(F.col("method") == "end_extension", of("_e", f)).when(F.col("method") == "start_extension", of("_o", f)).otherwise(of("_l", f))
    out = told.withColumn("method", method).where("method is not null")
    return out.select(
        "source", "candidate", "method", F.when(F.col("method") == "end_extension", "end").otherwise("start").alias("edge"), F.when(F.col("method") == "end_extension", of("_e", "r_end")).otherwise(chosen("r_start")).alias("time"),
        chosen("region_id").alias("region_id"), F.when(F.col("method") == "start_conflict", of("_a", "region_id")).alias("conflicting_region_id"), "candidate_text", chosen("heard_text").alias("heard_text"),
    )


def split_candidates(regions: DataFrame, turns: DataFrame, width: int, least: float = 0.2) -> DataFrame:
    """(turn_id, after_region_id, time): places to split a turn: behind the region before a stable one (at least `least` long) whose label differs
    from that of the stable region before it. `turns` has source, turn_id, source_regions; unlabelled regions are not compared."""
    mine = turns.select("source", "turn_id", F.explode("source_regions").alias("region_id")).join(regions.select("source", "region_id", "r_start", "r_end", "label"), ["source", "region_id"])
    order = ["r_start", "r_end", "region_id"]
    placed = beside(mine, ["turn_id"], order, ["region_id", "r_end"], width, name="_prior")
    stable = placed.where((F.col("r_end") - F.col("r_start") >= least - EDGE) & F.col("label").isNotNull())
    pairs = beside(stable, ["turn_id"], order, ["label"], width, name="_left").where(F.col("_left.label") != F.col("label"))
    return pairs.select("turn_id", F.col("_prior.region_id").alias("after_region_id"), F.col("_prior.r_end").alias("time"))


def midpoint_states(words: DataFrame, regions: DataFrame, on: list[str], word_id: str, point: Column, span: tuple[str, str], label: str, width: int) -> DataFrame:
    """on, word_id, n_regions and status of words by the regions that contain `point`, their middle, ends included: 'no_matching_region', 'multiple_speakers'
    (labels differ), else 'candidate'."""
    placed = words.select(*on, word_id, point.alias("_at"))
    hits = point_join(placed, regions.select(*on, *span, label), on, "_at", span, width).groupBy(*on, word_id).agg(F.count("*").alias("_n"), (F.min(label) != F.max(label)).alias("_many"))
    status = F.when(F.col("_n").isNull(), "no_matching_region").when(F.col("_many"), "multiple_speakers").otherwise("candidate")
    return with_sides(words, hits, [*on, word_id]).select(*on, word_id, F.coalesce("_n", F.lit(0)).alias("n_regions"), status.alias("status"))


def utterance_states(words: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """Utterances (source, utterance, of words with w_start, w_end) by the regions around their words' middles: n_regions, gap (the largest between
    words of regions that follow one another) and status: 'candidate' without a region, 'conflict' with several labels, 'reconciled' with one region,
    'merge_candidate' with several of one label."""
    at = words.withColumn("_at", (F.col("w_start") + F.col("w_end")) / 2)
    hits = point_join(at, regions.select("source", "region_id", "r_start", "r_end", "label"), ["source"], "_at", R, width)
    met = hits.groupBy("source", "utterance", "region_id", "label").agg(F.min("w_start").alias("_a"), F.max("w_end").alias("_b"))
    w = Window.partitionBy("source", "utterance").orderBy("_a", "_b", "region_id")
    met = met.withColumn("_gap", F.col("_a") - F.lag("_b").over(w))
    told = met.groupBy("source", "utterance").agg(F.count("*").alias("n_regions"), F.count_distinct("label").alias("_labels"), F.max("_gap").alias("gap"))
    out = words.select("source", "utterance").distinct().join(told, ["source", "utterance"], "left")
    status = F.when(F.col("n_regions").isNull(), "candidate").when(F.col("_labels") > 1, "conflict").when(F.col("n_regions") == 1, "reconciled").otherwise("merge_candidate")
    return out.select("source", "utterance", F.coalesce("n_regions", F.lit(0)).alias("n_regions"), "gap", status.alias("status"))


def lexical_evidence(texts: DataFrame, by: list[str], speaker: str, text: str, span: tuple[str, str]) -> DataFrame:
    """by, speaker, n_tokens (distinct ones that the speaker's texts have), start, end (their hull) and rank: most tokens first, of equal ones the
    shorter hull, then the later name."""
    flat = texts.select(*by, speaker, *dict.fromkeys(span), F.explode(T.token_set(F.col(text))).alias("_t"))
    told = flat.groupBy(*by, speaker).agg(F.count_distinct("_t").alias("n_tokens"), F.min(span[0]).alias("start"), F.max(span[1]).alias("end"))
    return told.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n_tokens"), F.col("end") - F.col("start"), F.desc(speaker))))
