"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(events: DataFrame, by: str, time: str, gap: str, late: str) -> DataFrame:
    """Speech sessions of each source: events less than `gap` apart, closed once the watermark is `late` past their end."""
    timed = events.withWatermark(time, late)
    return timed.groupBy(by, F.session_window(time, gap)).agg(F.count("*").alias("n")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def envelope(samples: DataFrame, time: str, value: str, bucket: str, late: str) -> DataFrame:
    """Least and largest value of each bucket of time."""
    timed = samples.withWatermark(time, late)
    return timed.groupBy(F.window(time, bucket)).agg(F.min(value).alias("low"), F.max(value).alias("high")).select(F.col("window.start").alias("start"), "low", "high")


def sliding_counts(events: DataFrame, by: str, time: str, size: str, step: str, late: str) -> DataFrame:
    timed = events.withWatermark(time, late)
    return timed.groupBy(by, F.window(time, size, step)).agg(F.count("*").alias("n")).select(by, F.col("window.start").alias("start"), "n")


def import_once(rows: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """Rows of a stream, each key once within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what there is, into an in-memory table (for tests and small reports)."""
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


CONTEXT = "source string, word bigint, speaker string, filled string"


def speaker_context(words: DataFrame, idle_seconds: int | None = None) -> DataFrame:
    """A stream of words (source, word, speaker and, if sources end, ended) with `filled`: the speaker, or where it is missing the one that speaks both before and after.

    Words are numbered from 0 and may come in any order: one that comes early waits until those before it are there, one that was told already is left out. A run of words
    without a speaker waits for the next speaker. A row with `ended` (its word the number of words, whether all have come or not) closes its source: what waits comes out, in order,
    without a speaker after it, and the state goes; so does a source of which nothing has come for `idle_seconds`, if that is given. Until then a source's state is its last
    speaker, the run that waits and the words that are early, nothing that was told before."""

    def told(key: str, last: str | None, run: list[int], word: int, speaker: str) -> list[tuple]:
        return [(key, w, None, speaker if speaker == last else None) for w in run] + [(key, word, speaker, speaker)]

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nxt, last, run, early, names, end = state.get if state.exists else (0, None, [], [], [], None)
        run, ahead, out = list(run), dict(zip(early, names, strict=True)), []
        closing = state.hasTimedOut
        for frame in frames:
            for word, speaker, ended in zip(frame["word"].tolist(), frame["speaker"].tolist(), frame["ended"].tolist(), strict=True):
                if ended is True or ended == 1:
                    end = int(word)
                elif word >= nxt:
                    ahead.setdefault(int(word), speaker if isinstance(speaker, str) else None)
        while ahead and (nxt in ahead or closing):
            nxt = nxt if nxt in ahead else min(ahead)
            speaker = ahead.pop(nxt)
            if speaker is None:
                run.append(nxt)
            else:
                out += told(key[0], last, run, nxt, speaker)
                last, run = speaker, []
            nxt += 1
        if closing or (end is not None and nxt >= end):
            out += [(key[0], w, None, None) for w in run]
            state.remove()
        else:
            state.update((nxt, last, run, list(ahead), list(ahead.values()), end))
            if idle_seconds is not None:
                state.setTimeoutDuration(idle_seconds * 1000)
        yield pd.DataFrame(out, columns=["source", "word", "speaker", "filled"])

    kind = "next bigint, last string, waiting array<bigint>, early array<bigint>, names array<string>, words bigint"
    timeout = GroupStateTimeout.NoTimeout if idle_seconds is None else GroupStateTimeout.ProcessingTimeTimeout
    marked = words if "ended" in words.columns else words.withColumn("ended", F.lit(False))
    return marked.groupBy("source").applyInPandasWithState(step, CONTEXT, kind, "append", timeout)


BLOCKS = "source string, block_start double, block_end double, n_intervals bigint"


def speech_sessions(intervals: DataFrame, time: str, late: str) -> DataFrame:
    """Merged speech of a stream of intervals (source, start, end in seconds, and `time`, the timestamp that the start is): source, block_start, block_end, n_intervals.

    Intervals that overlap or touch are one block. A block comes out once the watermark, `late` behind the largest `time`, has passed its end, for no interval that is on time can
    touch it then; the state of a source is the blocks that are open. An interval that is later than that begins a block of its own. Empty intervals and those without a place
    are left out."""

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        blocks = list(zip(*state.get, strict=True)) if state.exists else []
        for frame in frames:
            some = frame[frame["end"] > frame["start"]]
            blocks += [(a, b, 1) for a, b in zip(some["start"].tolist(), some["end"].tolist(), strict=True)]
        merged: list[list] = []
        for a, b, n in sorted(blocks):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
                merged[-1][2] += n
            else:
                merged.append([a, b, n])
        mark = state.getCurrentWatermarkMs() / 1000
        done, rest = [m for m in merged if m[1] < mark], [m for m in merged if m[1] >= mark]
        if rest:
            state.update(tuple(list(x) for x in zip(*rest, strict=True)))
            state.setTimeoutTimestamp(max(int(min(m[1] for m in rest) * 1000) + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(key[0], *m) for m in done], columns=["source", "block_start", "block_end", "n_intervals"])

    timed = intervals.withWatermark(time, late)
    kind = "starts array<double>, ends array<double>, counts array<bigint>"
    return timed.groupBy("source").applyInPandasWithState(step, BLOCKS, kind, "append", GroupStateTimeout.EventTimeTimeout)


def merge_batches(stream: DataFrame, checkpoint: str, key: list[str], read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], compute: Callable[[DataFrame], DataFrame]) -> None:
    """Runs a stream over what there is, batch by batch: rows whose key the table (`read`, None at first) has already are left out, of equal keys in a
    batch one stays, and only for the others `compute` (a recogniser, say) runs and `write` adds its rows. A batch that is told again after
    a failure finds its rows in the table and adds nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        fresh = rows.dropDuplicates(key)
        table = read()
        if table is not None:
            fresh = fresh.join(table.select(*key).distinct(), key, "left_anti")
        write(compute(fresh))

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
