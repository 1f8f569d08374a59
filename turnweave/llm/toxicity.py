"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams (with its borders) and of itself. Each of these has an embedding (in a table
of hashed rows); their average is the word's vector, and a linear softmax gives its chance of being toxic. A document is toxic
as soon as one of its words is, so a document's chance is a noisy-or over its distinct words; embeddings and softmax are
trained jointly, in numpy, on documents' labels alone. An unseen misspelling or inflexion shares most of its n-grams with
words that were seen. A document's score is a logistic function of its two most toxic distinct words.

Training uses a bounded sample of labelled rows (`SAMPLE_TOXIC` and `SAMPLE_CLEAN`, the first by a hash of the id). The
model that tasks get is one float per row of the table, whatever the corpus. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.bpe import _gather
from turnweave.llm.lineage import small_batches

SAMPLE_TOXIC, SAMPLE_CLEAN = 2500, 5000
ROWS = 1 << 17  # of the embedding table
WIDTH = 8
SIZES = (3, 4, 5)
EPOCHS = 40
RATE = 0.3
APART, APART_LEAST = 0.25, 200  # of the sample: not for the embeddings, but for the final logistic function; of fewer labelled rows none
TEXT_BYTES = 1 << 20
LEAST = -12.0  # a word's logit where a document has none
U = R.U64

# Words: runs of ASCII letters and digits and of all other characters beyond ASCII, in lower case.
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Distinct (text, word) pairs, ordered by text: text index and word index; and the distinct words themselves."""
    data, offs = R.buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    s, e, doc = R.word_spans(data, offs, BREAK)
    if len(s) == 0:
        z = np.zeros(0, np.int64)
        return z, z, pa.array([], pa.string())
    h = R.span_hash(data, s, e)
    _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    size = (e - s)[at]
    flat = data[_gather(s[at], size)]
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(flat)])
    key = np.unique(doc * len(at) + inverse)
    return key // len(at), key % len(at), words.cast(pa.string())


def bags(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table for each word's n-grams and itself, word by word, and each word's number of them."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data, offs = R.buffer(pc.binary_join_element_wise("<", words, ">", ""))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    word = np.searchsorted(offs, leads, "right") - 1
    h = R.mix(points.astype(U) + U(17))
    owner, rows = [np.arange(n)], [R.span_hash(data, offs[:-1], offs[1:])]
    for size in SIZES:
        g, at = R.rolling(h, word, size)
        owner.append(word[at])
        rows.append(g)
    owner, rows = np.concatenate(owner), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    return (rows[order] & U(ROWS - 1)).astype(np.int64), np.bincount(owner, minlength=n)


@dataclass
class Model:
    rows: np.ndarray  # what each table row adds to a word's logit, by the linear softmax
    bias: float
    final: tuple[float, float, float]  # weights of the most toxic word, of the second, and a constant

    def logits(self, words: pa.Array) -> np.ndarray:
        rows, n = bags(words)
        if len(n) == 0:
            return np.zeros(0)
        return np.add.reduceat(self.rows[rows], np.cumsum(n) - n, dtype=np.float64) / n + self.bias

    def top_two(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        doc, word, words = words_of(texts)
        return _top_two(doc, self.logits(words)[word], len(texts))

    def scores(self, texts: pa.Array) -> np.ndarray:
        first, second = self.top_two(texts)
        a, b, c = self.final
        return _sigmoid(a * first + b * second + c)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _top_two(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    first, second = np.full(n, LEAST), np.full(n, LEAST)
    if len(doc):
        order = np.lexsort((-value, doc))
        d, v = doc[order], np.maximum(value[order], LEAST)
        new = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        first[d[new]] = v[new]
        more = new[np.append(np.diff(new), len(d) - new[-1]) > 1]
        second[d[more]] = v[more + 1]
    return first, second


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float | np.ndarray = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (the constant last) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], 1e-6)
    keep[:-1] = ridge
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + keep * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> Model:
    """Embeddings and softmax by full-batch Adam on the noisy-or likelihood, both classes weighted alike; then the final
    logistic function, on rows set apart. Where fewer than APART_LEAST rows are labelled, or one of the two parts would have one class alone,
    nothing is set apart, and the function is fitted on the rows that the embeddings saw: its scores are then surer than they should be. One class alone, or no row, gives a model that scores all texts by the share of toxic labels."""
    y = np.asarray(labels, np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(ROWS, np.float32), 0.0, (0.0, 0.0, float(np.log(share / (1 - share)))))
    rng = np.random.default_rng(seed)
    apart = np.flatnonzero(rng.random(len(y)) < APART) if len(y) >= APART_LEAST else np.arange(len(y))
    fit = np.setdiff1d(np.arange(len(y)), apart) if len(y) >= APART_LEAST else apart
    if y[fit].min() == y[fit].max() or y[apart].min() == y[apart].max():
        fit = apart = np.arange(len(y))
    model = _embed(texts.take(pa.array(fit)), y[fit], rng)
    first, second = model.top_two(texts.take(pa.array(apart)))
    a, b, c = _logistic(np.column_stack([first, second]), y[apart], np.ones(len(apart)), ridge=0.1)
    return Model(model.rows, model.bias, (float(a), float(b), float(c)))


def _embed(texts: pa.Array, y: np.ndarray, rng: np.random.Generator) -> Model:
    doc, word, words = words_of(texts)
    blocks = [(a, min(a + 20_000, len(words))) for a in range(0, len(words), 20_000)]
    found = [bags(words.slice(a, b - a)) for a, b in blocks]
    bag, n = [rows.astype(np.int32) for rows, _ in found], np.concatenate([k for _, k in found])
    table = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    soft = rng.normal(0, 0.5, WIDTH)
    bias = -6.0
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    m_t, v_t = np.zeros_like(table), np.zeros_like(table)
    m_s, v_s = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)
    for step in range(1, EPOCHS + 1):
        one = table @ soft.astype(np.float32)
        value = bias + np.concatenate([np.add.reduceat(one[rows], np.cumsum(n[a:b]) - n[a:b]) for rows, (a, b) in zip(bag, blocks, strict=True)]) / n
        p = _sigmoid(value)
        none = np.bincount(doc, np.log1p(-np.minimum(p[word], 1 - 1e-9)), minlength=len(y))  # log chance of no toxic word
        some = np.maximum(-np.expm1(none), 1e-9)
        pull = weight * np.where(y > 0, -np.exp(none) / some, 1.0)
        slope = np.bincount(word, pull[doc] * p[word], minlength=len(n))
        whole = np.zeros(ROWS)  # the loss's slope in a row's own logit
        for rows, (a, b) in zip(bag, blocks, strict=True):
            whole += np.bincount(rows, np.repeat(slope[a:b] / n[a:b], n[a:b]), minlength=ROWS)
        grad_t = np.outer(whole, soft).astype(np.float32)
        grad_s = np.append(table.T @ whole, slope.sum())
        move_t = _adam(grad_t, m_t, v_t, step)
        move_s = _adam(grad_s, m_s, v_s, step)
        table -= move_t
        soft -= move_s[:-1]
        bias -= move_s[-1]
    return Model((table @ soft.astype(np.float32)).astype(np.float32), float(bias), (1.0, 0.0, 0.0))


def _adam(grad: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> np.ndarray:
    """The step to take; m and v are the running means of the slope and of its square."""
    m *= 0.9
    m += 0.1 * grad
    v *= 0.98
    v += 0.02 * grad * grad
    return RATE / step**0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-8)


def agreed(labels: DataFrame) -> DataFrame:
    """(doc_id, label): the labels of documents whose labels, 0 or 1, are all the same; a document with both has none."""
    told = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    return told.where("label = _most").drop("_most")


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct words, in place of the text."""
    for batch in R.chunks(batches, "text", TEXT_BYTES):
        doc, word, words = words_of(batch.column("text"))
        ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(word)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pc.binary_join(lists, " ")], names=["doc_id", "label", "words"])


def sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> pa.Table:
    """(text, label) of at most `toxic` and `clean` labelled documents, those with the smallest hash of their id: their distinct words, which
    are all that training looks at. A document with several rows gives one of them, the first by its words."""
    known = agreed(labels)
    pick = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k, most in ((1, toxic), (0, clean))]
    chosen = F.broadcast(pick[0].union(pick[1]))  # at most toxic + clean rows of two numbers
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = small_batches(docs.select("doc_id", "text").join(chosen, "doc_id")).select("doc_id", "label", "text")
    worded = rows.mapInArrow(_worded, f"doc_id {kind}, label int, words string")
    return worded.groupBy("doc_id", "label").agg(F.min("words").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "label").toArrow()


def _scored(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text", TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(batch.column("text")))], names=["doc_id", "held_out", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts, and texts without a word, get the score of a text whose words say nothing. Labels of held-out
    rows are never read, null labels and ids aside; labels that name no document do nothing; repeated labels
    of a document count once, contradicting ones not at all. Without labels of both classes every text gets the share of toxic labels. Repeated rows are scored alike.
    Other columns are not carried. The text alone decides a score.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(F.col(id_col)).alias("held_out"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(~held_out(F.col("doc_id")))
    table = sample(rows, known)
    model = train(table.column("text").combine_chunks(), table.column("label").to_numpy())
    scored = small_batches(rows).mapInArrow(_scored(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
