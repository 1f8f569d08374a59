"""Quality classifier by co-training two views of a document.

The content view sees the text alone: frequencies of hashed byte trigrams and shares of capitals, marks, digits, repeated
words and lines. The page-metadata view sees only what is recorded beside it: language, source and the recorded length. Each view is a
ridge logistic regression. In every round both views score all unlabelled documents, on Spark; each labels those it is surest of, both classes in
the proportion of the labels, and hands them to the other view, which is then fitted again. How many it hands over is a share of the corpus
(`HANDED_SHARE`), within the bounds that a fit on one machine sets (`HANDED_LEAST`, `HANDED_MOST`). A fold of the labels that neither view is fitted
on calibrates both, and a logistic function of the two calibrated logits scores all documents.

The labelled sample is bounded (`LABELLED`, the first by a hash of the id). A round is one pass over the texts that keeps two numbers a document;
scoring is another, without a shuffle, by a model of a few thousand numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.lineage import park_counted, small_batches
from turnweave.llm.toxicity import _logistic, _sigmoid, agreed

LABELLED = 6000
ROUNDS = 2
HANDED_SHARE, HANDED_LEAST, HANDED_MOST = 0.002, 150, 3000  # rows that a view hands over in a round: a share of all documents, within bounds
SURE = 1.0  # logit of the least sure row that is handed over
GRAMS = 512
STATS = 14
SHRINK = 400  # bytes; frequencies of shorter texts are drawn to 0
RIDGE = (150.0, 2.0)  # of hashed frequencies and places, and of shares and measures
HASHED = 32  # places for languages, and as many for sources
FOLD = 0.3  # of the labelled sample, for calibration
TEXT_BYTES = 1 << 18
THRESHOLD = 0.5
U = R.U64

_KIND = np.zeros(256, np.uint8)  # 1 capital, 2 digit, 3 mark, 4 other letter
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[97:123] = 4
_KIND[128:] = 4
# Marks that prose has.
_PROSE = np.zeros(256, bool)
_PROSE[list(b".,;:'\"()-?")] = True


def content(texts: pa.Array) -> np.ndarray:
    """The content view: a row of GRAMS frequencies and STATS shares for each text; null counts as empty."""
    data, offs = R.buffer(texts)
    n = len(texts)
    out = np.zeros((n, GRAMS + STATS), np.float32)
    length = np.diff(offs)
    if len(data) == 0:
        return out
    doc = np.repeat(np.arange(n, dtype=np.int32), length)
    if len(data) > 2:
        code = R.BYTE_CODE[data].astype(np.uint32)
        gram = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:]
        gram ^= gram >> np.uint32(15)
        inside = doc[:-2] == doc[2:]
        cell = doc[:-2][inside].astype(np.int64) * GRAMS + (gram[inside] % np.uint32(GRAMS))
        out[:, :GRAMS] = np.bincount(cell, minlength=n * GRAMS).reshape(n, GRAMS)
        out[:, :GRAMS] /= (length + SHRINK)[:, None]
    kinds = np.bincount(doc.astype(np.int64) * 5 + _KIND[data], minlength=n * 5).reshape(n, 5)
    odd = np.bincount(doc[(_KIND[data] == 3) & ~_PROSE[data]], minlength=n)
    letters = np.maximum(kinds[:, 1] + kinds[:, 4], 1)
    s, e, w = R.word_spans(data, offs)
    words = np.bincount(w, minlength=n)
    many = np.maximum(words, 1)
    h = R.span_hash(data, s, e) if len(s) else np.zeros(0, U)
    same = (h[1:] == h[:-1]) & (w[1:] == w[:-1])
    again = np.bincount(w[1:][same], minlength=n)
    first = np.unique(R.mix(h ^ R.mix(w.astype(U))), return_index=True)[1] if len(h) else np.zeros(0, np.int64)
    fresh = np.bincount(w[first], minlength=n)
    grams, at = R.rolling(h, w, 3)
    firsts = np.unique(R.mix(grams ^ R.mix(w[at].astype(U))), return_index=True)[1] if len(grams) else np.zeros(0, np.int64)
    triples, distinct = np.bincount(w[at], minlength=n), np.bincount(w[at][firsts], minlength=n)
    size = np.maximum(length, 1)
    ends = np.bincount(w[_KIND[data[e - 1]] == 3], minlength=n) if len(s) else np.zeros(n)
    bare = np.bincount(w[(e - s == 1) & (_KIND[data[s]] == 3)], minlength=n) if len(s) else np.zeros(n)
    stats = [kinds[:, 1] / letters, kinds[:, 2] / size, kinds[:, 3] / size, odd / size, again / many, fresh / many, 1 - distinct / np.maximum(triples, 1), ends / many, bare / many, (length / many).clip(0, 40) / 40, kinds[:, 0] / size, words < 5, np.sqrt(again / many), length / (length + SHRINK)]
    out[:, GRAMS:] = np.column_stack(stats)
    return out


LENGTHS = 24  # places for the recorded length, by its binary logarithm


def metadata(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """The page-metadata view: a row of places for language, source and recorded length (null ones have places of their own), and the length itself."""
    n = len(lang)
    out = np.zeros((n, 2 * HASHED + LENGTHS + 1), np.float32)
    for k, column in enumerate((lang, source)):
        names, at = R.buffer(column)
        place = (R.span_hash(np.append(names, np.uint8(0)), at[:-1], at[1:]) % U(HASHED)).astype(np.int64)
        out[np.arange(n), k * HASHED + place] = 1
    size = pc.fill_null(n_chars, -1).to_numpy(zero_copy_only=False).astype(np.float64)
    place = np.where(size < 0, LENGTHS - 1, np.minimum(np.log2(np.maximum(size, 0) + 1), LENGTHS - 2)).astype(np.int64)
    out[np.arange(n), 2 * HASHED + place] = 1
    out[:, -1] = np.log1p(np.maximum(size, 0)) / 10
    return out


META = ("lang", "source", "n_chars")
SIZES = (GRAMS + STATS, 2 * HASHED + LENGTHS + 1)


@dataclass
class View:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the constant last
    calibration: tuple[float, float] = (1.0, 0.0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.calibration[0] * (((x - self.mean) / self.scale).clip(-8, 8) @ self.weights[:-1] + self.weights[-1]) + self.calibration[1]


@dataclass
class Model:
    content: View
    metadata: View
    weights: np.ndarray  # of the two calibrated logits, and a constant

    def scores(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each document: the chance of good quality by content, by metadata, and by both."""
        a, b = self.content.logits(content(batch.column("text"))), self.metadata.logits(metadata(*(batch.column(c) for c in META)))
        return _sigmoid(a), _sigmoid(b), _sigmoid(a * self.weights[0] + b * self.weights[1] + self.weights[2])


def _fit(x: np.ndarray, y: np.ndarray, hashed: int) -> View:
    mean, scale = x.mean(0), x.std(0) + 1e-4
    z = ((x - mean) / scale).clip(-8, 8).astype(np.float64)
    weight = np.where(y > 0, 0.5 * len(y) / max(y.sum(), 1), 0.5 * len(y) / max(len(y) - y.sum(), 1))
    return View(mean, scale, _logistic(z, y, weight, ridge=np.where(np.arange(x.shape[1]) < hashed, *RIDGE), steps=12))


def _flat(y: np.ndarray) -> Model:
    """For labels of one class alone, or none: every document gets the share of good ones."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    views = [View(np.zeros(n), np.ones(n), np.append(np.zeros(n), np.log(share / (1 - share)))) for n in SIZES]
    return Model(views[0], views[1], np.array([0.5, 0.5, 0.0]))


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, surest: Callable[[list[View], set[int], float], list[tuple[np.ndarray, np.ndarray, np.ndarray]]], rounds: int = ROUNDS, seed: int = 5) -> Model:
    """Fits both views on labelled rows. `surest` gives for both views' present state, and the rows that were handed over before, each view's surest
    unlabelled rows: (names, features of both views side by side, labels)."""
    if len(y) == 0 or y.min() == y.max():
        return _flat(y)
    apart = np.random.default_rng(seed).random(len(y)) < FOLD
    if any(y[m].min(initial=1) == y[m].max(initial=0) for m in (apart, ~apart)):
        apart = np.zeros(len(y), bool)
    fold = apart if apart.any() else np.ones(len(y), bool)
    xs, ys = [x[~apart] for x in views], [y[~apart], y[~apart]]
    hashed = (GRAMS, 2 * HASHED + LENGTHS)
    models = [_fit(*parts) for parts in zip(xs, ys, hashed, strict=True)]
    given: set[int] = set()
    for _ in range(rounds):
        gifts = surest(models, given, float(y.mean()))
        for k in (0, 1):
            names, x, labels = gifts[1 - k]
            mine = x[:, : SIZES[0]] if k == 0 else x[:, SIZES[0] :]
            xs[k], ys[k] = np.concatenate([xs[k], mine]), np.concatenate([ys[k], labels])
            given.update(names.tolist())
            models[k] = _fit(xs[k], ys[k], hashed[k])
    for k in (0, 1):
        a, b = _logistic(models[k].logits(views[k][fold])[:, None], y[fold], np.ones(fold.sum()), ridge=0.1)
        models[k].calibration = (float(a), float(b))
    both = np.column_stack([m.logits(x[fold]) for m, x in zip(models, views, strict=True)])
    return Model(models[0], models[1], _logistic(both, y[fold], np.ones(fold.sum()), ridge=0.1))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in R.chunks(batches, "text", TEXT_BYTES):
        x = np.column_stack([content(batch.column("text")), metadata(*(batch.column(c) for c in META))])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("label"), lists], names=["name", "label", "x"])


def _judged(views: list[View]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text", TEXT_BYTES):
            a, b = views[0].logits(content(batch.column("text"))), views[1].logits(metadata(*(batch.column(c) for c in META)))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(a, pa.float64()), pa.array(b, pa.float64())], names=["name", "by_0", "by_1"])

    return run


def _table(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, labels and features of a few rows, one a name (of equal names the first by its features), in the order of their names."""
    one = rows.mapInArrow(_featured, "name bigint, label int, x array<float>").groupBy("name").agg(F.min(F.struct("label", "x")).alias("r")).orderBy("name")
    table = one.select("name", "r.label", "r.x").toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, sum(SIZES)), np.float32)
    return table.column("name").to_numpy(), table.column("label").to_numpy(), x


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Co-trains on at most `labelled` labelled documents, those with the smallest hash of their id, and on what the views hand each other.

    `docs` has doc_id, text, lang, source, n_chars; `labels` has doc_id, label; contradicting labels of a document count as none. The driver gets the
    sample's features, two numbers of the surest documents at a time, and the features of those handed over."""
    docs = small_batches(docs.where("doc_id is not null").withColumn("name", F.xxhash64("doc_id")))
    known = agreed(labels)
    pick = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled // 2) for k in (0, 1)]
    chosen = F.broadcast(pick[0].union(pick[1]))  # at most `labelled` rows of two numbers
    columns = ["name", "label", "text", *META]
    _, y, x = _table(docs.join(chosen, "doc_id").select(columns))
    free = docs.join(known.select("doc_id"), "doc_id", "left_anti") if labels_may_be_large(known) else docs.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti")

    def surest(views: list[View], given: set[int], share: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        judged, (n, *_) = park_counted(free.select("name", "text", *META).mapInArrow(_judged(views), "name bigint, by_0 double, by_1 double"))
        handed = int(min(max(HANDED_SHARE * n, HANDED_LEAST), HANDED_MOST))
        taken, picks = set(given), []
        for k in (0, 1):
            bad, good = round(handed * (1 - share)), round(handed * share)
            mine = []
            for most, label, order, sure in ((bad, 0, F.asc(f"by_{k}"), F.col(f"by_{k}") < -SURE), (good, 1, F.desc(f"by_{k}"), F.col(f"by_{k}") > SURE)):
                # As many more as were handed over before, for these are passed over.
                best = judged.where(sure).orderBy(order, "name").limit(most + len(taken)).select("name").collect()  # a bounded number of names
                fresh = [name for name in dict.fromkeys(r["name"] for r in best) if name not in taken][:most]
                taken.update(fresh)
                mine += [(name, label) for name in fresh]
            picks.append(mine)
        spark = docs.sparkSession
        told = spark.createDataFrame([x for mine in picks for x in mine], "name bigint, label int")
        names, labels_, features = _table(docs.join(F.broadcast(told), "name").select(columns))
        out = []
        for mine in picks:
            at = np.flatnonzero(np.isin(names, np.array([name for name, _ in mine], np.int64)))
            out.append((names[at], features[at], labels_[at].astype(np.float64)))
        return out

    return co_train((x[:, : SIZES[0]], x[:, SIZES[0] :]), y.astype(np.float64), surest, rounds)


BROADCAST_LABELS = 200_000  # labelled ids up to this number are broadcast, more are joined by a shuffle of the documents


def labels_may_be_large(known: DataFrame) -> bool:
    return known.limit(BROADCAST_LABELS + 1).count() > BROADCAST_LABELS


def _scored(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text", TEXT_BYTES):
            a, b, both = model.scores(batch)
            scores = [pa.array(x, pa.float64()) for x in (a, b, both)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *scores], names=["doc_id", "by_content", "by_metadata", "score"])

    return run


def _kept(model: Model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text", TEXT_BYTES):
            *_, both = model.scores(batch)
            yield batch.filter(pa.array(both >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, whatever their columns, that `quality` keeps; their order within a partition stays."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    model = fit(_columns(docs, id_col, text_col), known)
    special = {text_col: "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}
    inner = docs.select(*(F.col(f"`{c}`").alias(special.get(c, f"c{k}")) for k, c in enumerate(docs.columns)), *(F.lit(None).cast("bigint" if c == "n_chars" else "string").alias(c) for c in META if c not in docs.columns))
    out = small_batches(inner).mapInArrow(_kept(model, threshold), ", ".join(f"{c} {t}" for c, t in inner.dtypes))
    return out.select(*(F.col(special.get(c, f"c{k}")).alias(c) for k, c in enumerate(docs.columns)))


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    beside = ((F.col(c) if c in docs.columns else F.lit(None)).cast("bigint" if c == "n_chars" else "string").alias(c) for c in META)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *beside)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, by_content, by_metadata, score (chances of good quality) and kept (score >= threshold).

    Null and empty texts have empty features and are scored like any other; missing or null language and source count as
    empty, a missing or null n_chars has a place of its own. Labels that are null or name no document do nothing; repeated labels of a document count
    once, contradicting ones not at all. A document with several rows trains with one of them. Labels of one class,
    or none, score all documents by the share of good labels. Repeated rows are scored alike. Columns beyond these aren't carried.
    """
    rows = _columns(docs, id_col, text_col)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    model = fit(rows, known)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = small_batches(rows).mapInArrow(_scored(model), f"doc_id {kind}, by_content double, by_metadata double, score double")
    return scored.withColumn("kept", F.col("score") >= threshold)
