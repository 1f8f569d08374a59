"""Who speaks: attribution of words to speakers, filling of gaps, runs."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.functions import text as T
from turnweave.operators.intervals import Span, beside, known_beside, merge_touching, overlap_join, overlapped, running_max, running_sum, with_sides

WORDS_CELL = 4096  # words of a source in a cell, where order is their number

# How a word came by its speaker.
METHODS = ["no_overlapping_region", "no_speaker_label", "conflicting_overlapping_speakers", "single_overlapping_region", "consistent_overlapping_regions"]


def attribute_words(words: DataFrame, regions: DataFrame, on: list[str], word_id: str, word_span: Span, region_span: Span, label: str, width: int) -> DataFrame:
    """on, word_id, n_regions, speaker and method. A word gets a speaker if the regions that overlap it have one label between
    them; unlabelled regions don't count as a label, but a second region makes the finding 'consistent'. Words are numbered within `on`."""
    keys = [*on, word_id]
    pairs = overlap_join(words.select(*keys, *word_span), regions.select(*on, *region_span, label), on, word_span, region_span, width)
    found = pairs.groupBy(*keys).agg(F.count("*").alias("n_regions"), F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    out = with_sides(words, found, keys).withColumn("n_regions", F.coalesce("n_regions", F.lit(0)))
    one = F.col("_lo") == F.col("_hi")
    method = (
        F.when(F.col("n_regions") == 0, METHODS[0]).when(F.col("_lo").isNull(), METHODS[1]).when(~one, METHODS[2])
        .when(F.col("n_regions") == 1, METHODS[3]).otherwise(METHODS[4])
    )
    return out.select(*keys, "n_regions", F.when(one, F.col("_lo")).alias("speaker"), method.alias("method"))


def unresolved_runs(words: DataFrame, by: list[str], order: str, speaker: str, width: int = WORDS_CELL) -> DataFrame:
    """Longest runs of words without a speaker: by, first, last, n, left_speaker, right_speaker. A run is named by the place of the speaker before it, carried
    from cell to cell."""
    known = F.col(speaker).isNotNull()
    marked = known_beside(words, by, [order], F.when(known, F.struct(F.col(order).alias("at"), F.col(speaker).alias("s"))), width, "_left")
    marked = known_beside(marked, by, [order], F.col(speaker), width, "_right", after=True).where(~known)
    runs = marked.groupBy(*by, F.col("_left.at").alias("_run")).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"), F.first("_left.s").alias("left_speaker"), F.first("_right").alias("right_speaker"))
    return runs.drop("_run")


def fill_consistent_context(words: DataFrame, by: list[str], order: str, speaker: str, width: int = WORDS_CELL) -> DataFrame:
    """Adds filled: the speaker, or where it is missing the one that speaks both before and after."""
    out = known_beside(words, by, [order], F.col(speaker), width, "_l")
    out = known_beside(out, by, [order], F.col(speaker), width, "_r", after=True)
    return out.withColumn("filled", F.coalesce(F.col(speaker), F.when(F.col("_l") == F.col("_r"), F.col("_l")))).drop("_l", "_r")


def resolve_fragments(words: DataFrame, by: list[str], order: str, speaker: str, candidates: str, width: int = WORDS_CELL) -> DataFrame:
    """Adds resolved and step, word by word: a word in conflict takes its left neighbour's speaker as resolved so far, or its right
    neighbour's as given, if the conflict has it and the two don't disagree. `candidates` is an array, empty or null for words
    without a conflict.

    Only a run's last word has a right neighbour with a speaker, so what goes through a run from the left is the speaker before it or nothing: it reaches a word
    if all words of the run before have it among their candidates. Three values are carried over cells, and nothing is folded: the last speaker with its place,
    and the place of the last word that stopped it.
    """
    known = F.col(speaker).isNotNull()
    out = known_beside(words, by, [order], F.when(known, F.struct(F.col(order).alias("at"), F.col(speaker).alias("s"))), width, "_l")
    has = lambda c: F.coalesce(F.array_contains(candidates, c), F.lit(False))
    stopped = F.when(~known & ~has(F.col("_l.s")), F.col(order))
    out = running_max(out, by, [order], stopped, width, "_stop", before_only=True)
    out = beside(out, by, [order], [speaker], width, after=True, name="_r")
    left = F.when(F.coalesce(F.col("_stop") < F.col("_l.at"), F.lit(True)) & has(F.col("_l.s")), F.col("_l.s"))
    right = F.when(has(F.col(f"_r.{speaker}")), F.col(f"_r.{speaker}"))
    out = out.withColumns({"_a": F.when(~known, left), "_b": F.when(~known, right)})
    agreed = F.when(F.col("_a").isNull() | F.col("_b").isNull() | (F.col("_a") == F.col("_b")), F.coalesce("_a", "_b"))
    said = F.when(agreed.isNull(), None).when(F.col("_a") == F.col("_b"), "consistent").when(F.col("_a").isNotNull(), "left").otherwise("right")
    return out.withColumns({"resolved": F.coalesce(F.col(speaker), agreed), "step": said}).select(*words.columns, "resolved", "step")


def utterances(words: DataFrame, by: list[str], order: str, span: Span, speaker: str, boundary: str, text: str, long_gap: int, width: int = WORDS_CELL) -> DataFrame:
    """Runs of words, cut after a word where the speaker changes (both known), at a sentence boundary, or before a gap longer
    than `long_gap`: by, first, last, start, end, n_words, speaker (if one), speakers, end_boundary, text. `width` is the length of a cell of `order`."""
    out = beside(words, by, [order], [speaker, span[0]], width, after=True, name="_n")
    reasons = F.concat_ws("+", F.when(F.col(speaker) != F.col(f"_n.{speaker}"), "speaker_change"), F.when(F.col(boundary), "sat"), F.when(F.col(f"_n.{span[0]}") - F.col(span[1]) > long_gap, "alignment_gap"))
    cut = out.withColumn("_why", F.when(F.col("_n").isNull(), "source_end").otherwise(reasons)).drop("_n")
    runs = running_sum(cut, by, [order], (F.col("_why") != "").cast("long"), width, "_run", before_only=True).groupBy(*by, "_run").agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.min(span[0]).alias("start"), F.max(span[1]).alias("end"), F.count("*").alias("n_words"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(speaker).alias("s"), F.col(text).alias("t"), F.col("_why").alias("w")))).alias("_w"),
    )
    speakers = F.array_distinct(F.filter(F.transform("_w", lambda x: x["s"]), lambda s: s.isNotNull()))
    out = runs.withColumn("_sp", speakers)
    return out.select(*by, "first", "last", "start", "end", "n_words", F.when(F.size("_sp") == 1, F.get("_sp", F.lit(0))).alias("speaker"), F.array_join("_sp", ",").alias("speakers"), F.element_at("_w", -1)["w"].alias("end_boundary"), F.array_join(F.transform("_w", lambda x: x["t"]), " ").alias("text"))


def chained_runs(pairs: DataFrame, by: list[str], order: str, left: str, right: str, width: int = WORDS_CELL) -> DataFrame:
    """Adds run: pairs chain while one's `right` is the next one's `left`."""
    out = beside(pairs, by, [order], [right], width, name="_b")
    new = F.coalesce((F.col(f"_b.{right}") != F.col(left)).cast("long"), F.lit(1))
    return running_sum(out, by, [order], new, width, "run").drop("_b")


def region_conflicts(words: DataFrame, regions: DataFrame, on: list[str], word_id: str, word_span: Span, region_span: Span, region_id: str, label: str, width: int) -> DataFrame:
    """Words that overlap two or more regions which follow one another without any gap and have two or more labels, a missing
    label being one: on, word_id, region_ids, labels."""
    more = [F.col(region_id).alias("id"), F.coalesce(F.col(label).cast("string"), F.lit("<unknown>")).alias("l")]
    own, _, pairs = overlapped(words, regions, on, word_id, word_span, region_span, more, width)
    got = own.union(pairs).withColumnRenamed("_r", "r")
    n = F.size("r")
    joined = F.forall(F.zip_with(F.slice("r", F.lit(1), n - 1), F.slice("r", F.lit(2), n - 1), lambda a, b: a["e"] == b["s"]), lambda x: x)
    labels = F.array_distinct(F.transform("r", lambda x: x["l"]))
    return got.where((n > 1) & joined & (F.size(labels) > 1)).select(*on, word_id, F.array_join(F.transform("r", lambda x: x["id"].cast("string")), ",").alias("region_ids"), F.array_join(labels, ",").alias("labels"))


def mean_activity(frames: DataFrame, by: list[str], values: str) -> DataFrame:
    """by, mean and dominant: the mean of each speaker's activity over frames, and the first speaker with the largest."""
    flat = frames.select(*by, F.posexplode(values).alias("speaker", "v"))
    means = flat.groupBy(*by, "speaker").agg(F.avg(F.col("v").cast("double")).alias("mean"))
    best = means.groupBy(*by).agg(F.max_by("speaker", F.struct("mean", -F.col("speaker"))).alias("dominant"), F.max("mean").alias("top_mean"), F.count("*").alias("n_speakers"))
    return best


def speech_blocks(regions: DataFrame, by: list[str], span: Span, tie: str, text: str, width: int) -> DataFrame:
    """Merged speech: by, block_start, block_end, n_intervals, and whether the interval that ends last ends a sentence."""
    return merge_touching(regions.where(F.col(span[1]) > F.col(span[0])), by, span, tie, width, {"ends_sentence": T.ends_sentence(F.col(text))})


class _Walk:
    """One source's chunks, told block by block in order; what is held reaches no further back than the current chunk."""

    def __init__(self, duration: float, target: float, search: float, most: float, gap: float) -> None:
        self.duration, self.target, self.search, self.most, self.gap = duration, target, search, most, gap
        self.start, self.index, self.refused = 0.0, 0, False
        self.end: float | None = None  # of the speech so far
        self.sentence = False
        self.cuts: deque[tuple[float, bool]] = deque()
        self.silences: deque[tuple[float, float]] = deque()

    def block(self, start: float, end: float, sentence: bool) -> list[tuple]:
        half = self.gap / 2
        if self.end is None:
            if start >= self.gap:
                self.silences.append((0.0, start - half))
        elif start - self.end >= self.gap:
            self.cuts.append((self.end + (start - self.end) / 2, self.sentence))
            self.silences.append((self.end + half, start - half))
        self.end, self.sentence = end, sentence
        return self._chunks(start)

    def finish(self) -> list[tuple]:
        if self.end is None:
            self.silences.append((0.0, self.duration))
        elif self.duration - self.end >= self.gap:
            self.silences.append((self.end + self.gap / 2, self.duration))
        return self._chunks(float("inf"))

    def _chunks(self, known: float) -> list[tuple]:
        """The chunks that nothing behind `known` can change."""
        out = []
        while not self.refused and self.start < self.duration and (known == float("inf") or self.start + self.most < known):
            end, why = self._next()
            out.append((self.index, self.start, end, why))
            self.refused = end is None
            self.start, self.index = self.start if end is None else end, self.index + 1
            while self.cuts and self.cuts[0][0] <= self.start:
                self.cuts.popleft()
            while self.silences and self.silences[0][1] < self.start:
                self.silences.popleft()
        return out

    def _next(self) -> tuple[float | None, str]:
        start, target, limit = self.start, self.start + self.target, self.start + self.most
        if self.duration - start <= self.target + self.search:
            return self.duration, "source_end"
        if any(a <= start and target <= b for a, b in self.silences):
            return min(target, self.duration), "source_gap" if target < self.duration else "source_end"
        low, high = max(start + 1.0, target - self.search), min(self.duration, target + self.search, limit)
        near = [(t, "sentence_gap" if s else "speech_gap") for t, s in self.cuts if low <= t <= high]
        if low <= target <= high and any(a <= target <= b for a, b in self.silences):
            near.append((target, "source_gap"))
        best = [c for c in near if c[1] == "sentence_gap"] or near
        if best:
            return min(best, key=lambda c: abs(c[0] - target))
        far = [(t, "sentence_gap" if s else "speech_gap") for t, s in self.cuts if high < t <= limit]
        far = [c for c in far if c[1] == "sentence_gap"] or far or [(max(a, high), "source_gap") for a, b in self.silences if max(a, high) <= min(b, limit)]
        if far:
            return min(far, key=lambda c: c[0])
        return (self.duration, "source_end") if self.duration <= limit else (None, "refused")


def plan_chunks(sources: DataFrame, blocks: DataFrame, by: str, duration: str, target: float = 60.0, search: float = 15.0, most: float = 240.0, least_gap: float = 0.5) -> DataFrame:
    """Cuts of each source (by, duration) at silences of its speech `blocks` (by, block_start, block_end, ends_sentence): by, index, start,
    end, boundary.

    From each position: the rest if it is at most target + search; `target` itself if all of that lies in one silence; else the cut within
    `search` of the target that is nearest to it, behind a sentence's end if there is one ('sentence_gap'), else in another silence
    ('speech_gap', or 'source_gap' for the target inside a long one); else the first such cut up to `most`. Continuous speech is never
    cut: where it is longer than `most`, the plan ends with a row 'refused' whose end is null.

    A cut depends on the one before. Blocks go through sorted by source and time, and a source's walk holds only what lies within `most` of
    its position, so a source of any length is one pass in bounded memory.
    """
    rows = sources.select(by, F.col(duration).cast("double").alias("_d")).join(blocks.select(by, F.col("block_start").cast("double").alias("_s"), F.col("block_end").cast("double").alias("_e"), "ends_sentence"), by, "left")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, at = None, None
        for frame in frames:
            out = []
            for key, d, s, e, sentence in frame.itertuples(index=False, name=None):
                if at is None or key != source:
                    out += [(source, *x) for x in at.finish()] if at else []
                    source, at = key, _Walk(d, target, search, most, least_gap)
                if s == s:
                    out += [(source, *x) for x in at.block(s, e, bool(sentence))]
            yield pd.DataFrame(out, columns=[by, "index", "start", "end", "boundary"])
        if at:
            yield pd.DataFrame([(source, *x) for x in at.finish()], columns=[by, "index", "start", "end", "boundary"])

    ordered = rows.repartition(by).sortWithinPartitions(by, "_s", "_e")
    return ordered.mapInPandas(walk, f"{by} {dict(sources.dtypes)[by]}, index bigint, start double, end double, boundary string")


def similar_texts(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Adds token_ratio, char_ratio and similar. Texts are compared as their lexical tokens, and as these tokens' letters joined: twice what
    the longest matching blocks share over the sum of lengths. Similar is a char_ratio of 0.95, or of 0.82 with a token_ratio of 0.65; texts
    without a token have ratios of 0 and are similar to nothing. Each distinct pair is compared once."""
    from difflib import SequenceMatcher

    def ratio(a: object, b: object) -> float:
        return SequenceMatcher(None, a, b, autojunk=False).ratio() if len(a) and len(b) else 0.0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [ratio(list(a), list(b)) for a, b in zip(frame["_a"], frame["_b"], strict=True)]
            chars = [ratio("".join(a), "".join(b)) for a, b in zip(frame["_a"], frame["_b"], strict=True)]
            yield frame.assign(token_ratio=words, char_ratio=chars)

    told = pairs.withColumns({"_a": T.lexical_tokens(F.col(left)), "_b": T.lexical_tokens(F.col(right))})
    same = F.when(F.size("_a") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    easy = told.where("_a = _b").select(*pairs.columns, same.alias("token_ratio"), same.alias("char_ratio"))
    hard = told.where("_a <> _b")
    found = hard.select("_a", "_b").distinct().mapInPandas(run, "_a array<string>, _b array<string>, token_ratio double, char_ratio double")
    out = easy.unionByName(hard.join(found, ["_a", "_b"]).select(*pairs.columns, "token_ratio", "char_ratio"))
    return out.withColumn("similar", (F.col("char_ratio") >= 0.95) | ((F.col("token_ratio") >= 0.65) & (F.col("char_ratio") >= 0.82)))


def merged_region_runs(conflicts: DataFrame, by: list[str], order: str, regions: str) -> DataFrame:
    """Adds run to conflicts (with an array `regions`): one joins the run before it while it shares a region with any conflict of that run so
    far. Each row carries only the latest place of its regions: it joins if that place lies in the current run, which begins
    where a row shared nothing with what was since the run's own beginning; a run is folded alone, between rows that share nothing with
    any row before them."""
    w = Window.partitionBy(*by).orderBy(order)
    placed = conflicts.withColumn("_row", F.row_number().over(w))
    flat = placed.select(*by, "_row", F.explode(regions).alias("_r"))
    seen = flat.withColumn("_last", F.lag("_row").over(Window.partitionBy(*by, "_r").orderBy("_row"))).groupBy(*by, "_row").agg(F.max("_last").alias("_last"))
    marked = placed.join(seen, [*by, "_row"], "left")
    part = marked.withColumn("_part", F.sum(F.col("_last").isNull().cast("int")).over(Window.partitionBy(*by).orderBy("_row")))
    parts = part.groupBy(*by, "_part").agg(F.array_sort(F.collect_list(F.struct("_row", "_last"))).alias("_w"))
    start = F.struct(F.lit(0).alias("first"), F.array().cast("array<struct<_row:int,first:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first = F.when(x["_last"] >= acc["first"], acc["first"]).otherwise(x["_row"])
        return F.struct(first.alias("first"), F.concat(acc["out"], F.array(F.struct(x["_row"].alias("_row"), first.alias("first")))).alias("out"))

    told = parts.select(*by, F.explode(F.aggregate("_w", start, step)["out"]).alias("_x")).select(*by, F.col("_x._row").alias("_row"), F.col("_x.first").alias("_first"))
    runs = placed.join(told, [*by, "_row"])
    return runs.withColumn("run", F.dense_rank().over(Window.partitionBy(*by).orderBy("_first"))).drop("_row", "_first")


def activity_window(frames: DataFrame, windows: DataFrame, on: list[str], window_id: str, span: Span, frame: str, values: str, frame_duration: float) -> DataFrame:
    """on, window_id, means and dominant: of each window [start, end) the mean of every speaker's activity over the frames from the one that
    its start lies in up to the one that its end lies in, that one left out, one at least, and the first speaker with the largest mean; nulls where there is no frame."""
    first = F.greatest(F.lit(0), F.floor(F.col(span[0]) / frame_duration)).cast("long")
    last = F.greatest(first + 1, F.floor(F.col(span[1]) / frame_duration).cast("long"))
    wanted = windows.select(*on, window_id, F.explode(F.sequence(first, last - 1)).alias("_f"))
    flat = wanted.join(frames.select(*on, F.col(frame).alias("_f"), values), [*on, "_f"]).select(*on, window_id, F.posexplode(values).alias("_s", "_v"))
    means = flat.groupBy(*on, window_id, "_s").agg(F.avg(F.col("_v").cast("double")).alias("_m"))
    got = means.groupBy(*on, window_id).agg(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_m"))), lambda x: x["_m"]).alias("means"), F.max_by("_s", F.struct("_m", -F.col("_s"))).alias("dominant"))
    return with_sides(windows, got, [*on, window_id])
