"""Quality rules: repetition coverage by rolling hashes.

Each text is cut into words (maximal runs outside space and \\x09-\\x0d). For n = 2..10 a rolling hash names every
n-word window; windows whose hash occurs twice or more in the same text are duplicated. The rules compare the characters
inside duplicated windows and lines with all word characters. Lines and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.llm import ragged as R

# Percent of word characters above which a rule rejects: the most frequent n-gram (n 2 to 4), and all n-grams found
# twice or more (n 5 to 10; short windows recur by chance in short texts, so their limits are wider).
TOP_PERCENT = {2: 20, 3: 18, 4: 16}
COVER_PERCENT = {5: 30, 6: 25, 7: 20, 8: 16, 9: 13, 10: 10}
DUP_LINE_PERCENT = 30
DUP_LINE_CHARS_PERCENT = 20
SYMBOLS_PERCENT = 25
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars"]
_COUNTS += [f"top{n}_chars" for n in TOP_PERCENT] + [f"dup{n}_chars" for n in COVER_PERCENT]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _groups(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, how often its (text, hash) occurs and whether it is the first of its kind."""
    count, first = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    if len(h) == 0:
        return count, first
    key = R.mix(h ^ R.mix(doc.astype(R.U64) + R.U64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    sizes = np.diff(np.append(starts, len(k)))
    count[order] = np.repeat(sizes, sizes)
    first[order[starts]] = True
    return count, first


def _sums(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    if len(doc):
        starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[starts]] = np.add.reduceat(values.astype(np.int64), starts)
    return out


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of `_COUNTS` for each text; null counts as empty."""
    data, offs = R.buffer(texts)
    n_docs = len(texts)
    s, e, doc = R.word_spans(data, offs)
    out = {c: np.zeros(n_docs, np.int64) for c in _COUNTS}
    out["n_symbols"] = np.bincount(np.searchsorted(offs, np.flatnonzero(_SYMBOL[data]), "right") - 1, minlength=n_docs).astype(np.int64)
    if len(s) == 0:
        return out
    leads = np.append(((data & 0xC0) != 0x80).view(np.uint8), np.uint8(0))
    chars = np.add.reduceat(leads, np.column_stack([s, e]).ravel(), dtype=np.int64)[::2]
    out["n_words"] = np.bincount(doc, minlength=n_docs).astype(np.int64)
    out["word_chars"] = _sums(doc, chars, n_docs)

    nl = np.flatnonzero(data == 10)
    line_doc = np.concatenate([np.arange(n_docs), np.searchsorted(offs, nl, "right") - 1])
    start = np.concatenate([offs[:-1], nl + 1])
    order = np.lexsort((start, line_doc))
    start, line_doc = start[order], line_doc[order]
    end = np.minimum(np.append(nl, len(data))[np.searchsorted(nl, start)], offs[line_doc + 1])
    lo, hi = np.searchsorted(s, start), np.searchsorted(s, end)
    real = hi > lo
    start, end, line_doc, lo, hi = (x[real] for x in (start, end, line_doc, lo, hi))
    _, first = _groups(line_doc, R.span_hash(data, start, end))
    ends_at = np.append(0, np.cumsum(chars))
    out["n_lines"] = _sums(line_doc, np.ones(len(line_doc)), n_docs)
    out["n_dup_lines"] = _sums(line_doc, ~first, n_docs)
    out["dup_line_chars"] = _sums(line_doc, np.where(first, 0, ends_at[hi] - ends_at[lo]), n_docs)

    h = R.span_hash(data, s, e)
    for n in range(2, 11):
        g, at = R.rolling(h, doc, n)
        count, first = _groups(doc[at], g)
        twice = count > 1
        if n in TOP_PERCENT:
            pick = twice & first
            np.maximum.at(out[f"top{n}_chars"], doc[at[pick]], count[pick] * (ends_at[at[pick] + n] - ends_at[at[pick]]))
        if n == 3 or n in COVER_PERCENT:
            edge = np.zeros(len(s) + 1, np.int64)
            np.add.at(edge, at[twice], 1)
            np.add.at(edge, at[twice] + n, -1)
            covered = np.cumsum(edge[:-1]) > 0
            if n == 3:
                out["n_repeat_words"] = _sums(doc, covered, n_docs)
            else:
                out[f"dup{n}_chars"] = _sums(doc, np.where(covered, chars, 0), n_docs)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in R.chunks(batches, "text"):
        found = measure(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[c]) for c in _COUNTS)], names=["doc_id", *_COUNTS])


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id as `doc_id`, the counts, `base_failed`, `failed_rules` and `kept`.

    Other columns are not carried, so their names cannot clash. A null or empty text has zero counts and fails the base
    rule; a null id stays null; repeated rows give repeated results. No shuffle; memory follows a chunk of about 1 MB
    of text, or the longest single text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_measured, schema)
    over = lambda part, whole, percent: F.col(part) * 100 > F.col(whole) * percent
    rules = {f"top{n}": over(f"top{n}_chars", "word_chars", p) for n, p in TOP_PERCENT.items()}
    rules |= {f"dup{n}": over(f"dup{n}_chars", "word_chars", p) for n, p in COVER_PERCENT.items()}
    rules["dup_lines"] = over("n_dup_lines", "n_lines", DUP_LINE_PERCENT)
    rules["dup_line_chars"] = over("dup_line_chars", "word_chars", DUP_LINE_CHARS_PERCENT)
    rules["symbols"] = over("n_symbols", "n_words", SYMBOLS_PERCENT)
    failed = F.concat_ws(",", *(F.when(cond, F.lit(name)) for name, cond in rules.items()))
    base = (F.col("n_words") < MIN_WORDS) | over("n_repeat_words", "n_words", 50)
    return rows.withColumns({"base_failed": base, "failed_rules": failed}).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
