"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are sets of distinct word shingles. An item of q shingles is contained in a document at `percent` when the
document has at least c = ceil(percent q / 100) of them. Items are partitioned by size, each partition twice as large as the one before.
An item's MinHash signature is its smallest hashes, k of them, k fixed by the partition: twice as many as its largest item may miss, and
a few more. (Hashes that many items share count as the largest, so a phrase common to all items is in few signatures.)
At most q - c hashes are missing from a document that contains the item, so at least k - (q - c) of its signature are there: that is
the partition's containment bound, and with it the search loses nothing. Documents are not cut down to signatures of fixed
length, as those of long documents would lose short items. They keep the shingles that two fixed-size filters let through: one
of all signatures (is the document a candidate at all?), one of all item shingles. The kept rows meet the signatures, the
bound names the candidate pairs, and only these are verified, shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.lineage import park, small_batches

FILTER_WORDS = 1 << 19  # of 64 bits; the filters' size is fixed
BROADCAST_ROWS = 200_000  # rows of signatures up to this number are broadcast, more are joined by a shuffle
SHARED = 4  # items; hashes that more have count as the largest
U = R.U64

# Words: runs of ASCII letters and digits and of all other characters beyond ASCII, in lower case.
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def shingle_sets(texts: pa.Array, widths: list[int], whole: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) of the windows of each width; `whole`: texts of fewer words give their whole sequence."""
    data, offs = R.buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    s, e, doc = R.word_spans(data, offs, BREAK)
    h = R.span_hash(data, s, e)
    ds, gs = [], []
    for n in widths:
        g, at = R.rolling(h, doc, n)
        ds.append(doc[at])
        gs.append(g)
    if whole:
        words = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
        for n in range(1, whole):
            g, at = R.rolling(h, doc, n)
            keep = words[doc[at]] == n
            ds.append(doc[at][keep])
            gs.append(g[keep])
    return R.distinct_per_text(np.concatenate(gs), np.concatenate(ds))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = U(1) << (h >> U(58)) | U(1) << (h >> U(52) & U(63)) | U(1) << (h >> U(46) & U(63))
    return (h & U(FILTER_WORDS - 1)).astype(np.int64), mask


def _items(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text"):
            d, g = shingle_sets(batch.column("text"), [width], width)
            n = np.bincount(d, minlength=batch.num_rows)
            key = np.zeros(batch.num_rows, U)
            np.add.at(key, d, R.mix(g))
            place, mask = _bits(g)
            words = _word_counts(batch.column("text"))[d]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(d)), pa.array(key[d].view(np.int64)), pa.array(g.view(np.int64)), pa.array(n[d].astype(np.int64)), pa.array(np.minimum(words, width).astype(np.int64)), pa.array(place), pa.array(mask.view(np.int64))],
                names=["item_id", "item_key", "hash", "n_item", "width", "place", "mask"],
            )

    return run


def signature(n_item: Column, percent: int) -> tuple[Column, Column]:
    """Of an item of so many shingles: the length of its signature, by its size partition, and how many of it a document must have."""
    least = lambda q: F.ceil(q * percent / F.lit(100.0))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(n_item.cast("double"))) + 1) - 1
    length = F.least(n_item, (2 * (largest - least(largest)) + 4).cast("long"))
    return length, F.greatest(F.lit(1).cast("long"), length - (n_item - least(n_item)))


def _word_counts(texts: pa.Array) -> np.ndarray:
    data, offs = R.buffer(texts)
    return np.bincount(R.word_spans(data, offs, BREAK)[2], minlength=len(texts))


def _hits(widths: list[int], sketches: bytes, shingles: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, full = np.frombuffer(sketches, U), np.frombuffer(shingles, U)
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in R.chunks(batches, "text"):
            d, g = shingle_sets(batch.column("text"), widths)
            place, mask = _bits(g)
            candidate = np.zeros(batch.num_rows, bool)
            candidate[d[first[place] & mask == mask]] = True
            keep = candidate[d] & (full[place] & mask == mask)
            d, g = d[keep], g[keep]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(d)), pa.array(d + row), pa.array(g.view(np.int64))], names=["doc_id", "row", "hash"])
            row += batch.num_rows

    return run


def _filter(items: DataFrame) -> np.ndarray:
    """The fixed-size filter of some item shingles; at most FILTER_WORDS rows reach the driver."""
    out = np.zeros(FILTER_WORDS, np.int64)
    table = items.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    out[table.column("place").to_numpy()] = table.column("mask").to_numpy()
    return out


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): each item of which a document has at least `percent` of the shingles.

    An item of fewer than `width` words is one shingle, its whole sequence; one without words is found nowhere. Null and
    empty texts contain nothing. Rows with one doc_id give one row for an item, with the largest share. Repeated rows of an item
    count once; different texts under one item_id are searched apart and give one row, that of the largest share. Other columns are not read.
    The doc_id may be of any type, a struct included.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    rows = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    grams = rows.mapInArrow(_items(width), f"item_id {item_kind}, item_key bigint, hash bigint, n_item bigint, width bigint, place bigint, mask bigint")
    grams = grams.dropDuplicates(["item_id", "item_key", "hash"])
    common = grams.groupBy("hash").agg((F.count("*") > SHARED).alias("common"))
    order = Window.partitionBy("item_id", "item_key").orderBy("common", "hash")
    length, need = signature(F.col("n_item"), percent)
    index = grams.join(common, "hash").withColumn("in_sketch", F.row_number().over(order) <= length).withColumn("need", need)
    index = park(index.select(F.struct("item_id", "item_key").alias("item"), "hash", "n_item", "width", "place", "mask", "in_sketch", "need"))
    widths = [r[0] for r in index.select("width").distinct().collect()] or [width]  # at most `width` values
    full, sketch = _filter(index), _filter(index.where("in_sketch"))
    texts = small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    hits = park(texts.mapInArrow(_hits(widths, sketch.tobytes(), full.tobytes()), f"doc_id {kind}, row bigint, hash bigint"))
    signed = index.where("in_sketch").select("hash", "item", "need")
    if signed.count() <= BROADCAST_ROWS:
        signed = F.broadcast(signed)
    pairs = hits.join(signed, "hash").groupBy("row", "item", "need").agg(F.count("*").alias("n")).where("n >= need")
    wanted = pairs.select("row", "item").join(index.select("item", "hash", "n_item"), "item")
    found = hits.join(wanted, ["row", "hash"]).groupBy("row", "doc_id", "item", "n_item").agg(F.count("*").alias("n_shared"))
    found = found.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    best = found.groupBy("doc_id", F.col("item.item_id").alias("item_id")).agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_item", "n_shared")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_item", "m.n_shared", F.round(F.col("m.n_shared") / F.col("m.n_item"), 6).alias("containment"))


ORACLE = """
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(text), '[a-z0-9\\x{80}-\\x{10FFFF}]+') FROM benchmark),
grams AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k:k+4], ' '))) AS g FROM words WHERE len(w) >= 5),
q AS (SELECT id, count(*) AS n_item FROM grams WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, q.n_item, count(*) AS n_shared, round(count(*) / q.n_item, 6) AS containment
FROM grams d JOIN grams i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i' JOIN q ON q.id = i.id
GROUP BY d.id, i.id, q.n_item HAVING count(*) * 100 >= q.n_item * 80
"""
