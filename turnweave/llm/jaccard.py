"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word n-grams. Hash every n-gram to one bit of a sketch and flip that bit: two
documents' sketches differ in at most as many bits as their sets differ in n-grams. Sets with |A and B| >= t |A or B| differ
in at most (|A|+|B|)(1-t)/(1+t) n-grams, and their sizes in a ratio of at least t. So:

1. Documents with equal sets form a class, named by a 64-bit hash; the rest works on classes.
2. Sizes are cut into overlapping bands such that any linkable pair shares a band. In a band whose pairs differ in at most
   D n-grams the sketch has D + 1 segments of 2^20 bits; a linkable pair agrees on a whole segment (pigeonhole). Each
   (band, segment, bits) is one join key. An empty segment says little. Where few are empty, they are cut again under another
   hash, which loses no pair for the same reason. Where many are, the sketch has D + 1 + m segments: a linkable pair agrees on
   m + 1, so a document with at most m empty ones needs no key for these; one with more keeps them.
3. In rounds, each class, and later each component, is tried against one leader of its buckets; the class that meets most others leads. That is linear in the classes,
   and the components of the links found close most buckets. In those that still hold several components all pairs that
   cross components are compared. Pairs whose sketches, of a bit an n-gram and 512 at least, differ in too many bits are dropped before that
   (Hamming distance bounds the difference from below), the others are verified on their whole texts. No linked pair of different components is
   left, so components are exact.
4. Numbers of links are counted only when asked for: links lie within components, so in each component of more than two classes
   all pairs are compared, in squares of two blocks of at most BLOCK classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.bpe import _gather
from turnweave.llm.lineage import components, followed, joined_roots, park, park_counted, small_batches

SEGMENT_BITS = 1 << 20
SKETCH_BITS = 512  # of the smallest sketch for the Hamming test of a pair; a larger set has a bit for each n-gram at least
BLOOM_BITS = 1 << 26  # of the filter that spares texts in no candidate pair; its size is fixed
BLOCK = 64  # classes; a task holds the texts of two blocks
PAIR_BLOCK = 512  # classes; a task holds the sketches of two blocks
PAIRS = 1 << 17  # of a square that are tested at once
ROUNDS = 4  # of attempts at most, before all that is left is compared
PAIR = "a bigint, b bigint, ra bigint, rb bigint"  # two classes and their components' roots
U = R.U64


class Bands:
    """Bands of set sizes for a least similarity in percent."""

    def __init__(self, percent: int, largest: int) -> None:
        edges = [1]
        while len(edges) < 6 or len(edges) % 2 or edges[-4] <= largest:
            edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
        self.edges = np.array(edges, np.int64)
        top = self.edges[3::2] - 1  # band k holds cells 2k, 2k+1 and 2k+2
        self.segments = 2 * top * (100 - percent) // (100 + percent) + 1
        least = self.edges[: 2 * len(top) : 2]
        spare = self.segments * np.exp(-least / self.segments)
        self.again = spare <= 1.5  # cut empty segments again only where they are few
        self.spare = np.full(len(top), -1, np.int64)  # segments beyond D + 1, or -1
        for k in np.flatnonzero(~self.again):
            first = wanted = int(self.segments[k])
            for _ in range(200):
                empty = wanted * np.exp(-least[k] / wanted)
                if first + int(np.ceil(empty + 2 * np.sqrt(empty) + 1)) <= wanted or wanted > 4 * first:
                    break
                wanted = first + int(np.ceil(empty + 2 * np.sqrt(empty) + 1))
            if wanted < first * (1 + spare[k]):
                self.spare[k], self.segments[k] = wanted - first, wanted
            else:
                self.again[k] = True

    def of(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, band) for each document that can have a partner with another set."""
        cell = np.searchsorted(self.edges, size, "right") - 1
        doc = np.flatnonzero(size > 0)
        band = cell[doc] // 2
        below = (cell[doc] % 2 == 0) & (band > 0)
        doc, band = np.concatenate([doc, doc[below]]), np.concatenate([band, band[below] - 1])
        useful = self.segments[band] > 1
        return doc[useful], band[useful]


def _segment_keys(g: np.ndarray, prefix: np.ndarray, start: np.ndarray, size: np.ndarray, segments: np.ndarray, again: np.ndarray, spare: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all segments of all rows; a row is a document in a band."""
    row = np.repeat(np.arange(len(size)), size)
    t = R.mix(g[_gather(start, size)] + U(0x51ED270B * (depth + 1)))
    seg = ((t >> U(32)) * segments[row].astype(U)) >> U(32)
    bit = R.mix((seg << U(20) | (t & U(SEGMENT_BITS - 1))) + U(977 + depth))
    base = np.cumsum(segments) - segments
    cell = base[row] + seg.astype(np.int64)
    order = np.argsort(cell, kind="stable")
    c = cell[order]
    value = np.zeros(int(segments.sum()), U)
    if len(c):
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        value[c[first]] = np.bitwise_xor.reduceat(bit[order], first)
    full = np.zeros(len(value), bool)
    full[c] = True
    owner = np.repeat(np.arange(len(size)), segments)
    key = R.mix(R.mix(prefix[owner] + (np.arange(len(value)) - base[owner]).astype(U)) ^ value)
    more = ~full & again[owner] & (depth < 2)
    spared = ~full & (np.bincount(owner[~full], minlength=len(size)) <= spare)[owner]
    rows, keys = owner[~more & ~spared], key[~more & ~spared]
    if more.any():
        o = owner[more]
        sub, sub_keys = _segment_keys(g, key[more], start[o], size[o], segments[o], again[o], spare[o], depth + 1)
        rows, keys = np.concatenate([rows, o[sub]]), np.concatenate([keys, sub_keys])
    return rows, keys


def signatures(texts: pa.Array, n_gram: int, percent: int, with_keys: bool) -> dict[str, np.ndarray | pa.Array]:
    """For each text: set size, class hash, sketch; and the join keys with their texts' indices."""
    d, g, _ = R.shingles(texts, n_gram)
    n_docs = len(texts)
    n = np.bincount(d, minlength=n_docs).astype(np.int64)
    start = np.cumsum(n) - n
    cls = np.zeros(n_docs, U)
    real = np.flatnonzero(n)
    if len(g):
        both = np.add.reduceat(R.mix(g), start[real]) ^ R.mix(np.bitwise_xor.reduceat(R.mix(g * U(0x9FB21C651E98DF25)), start[real]))
        cls[real] = R.mix(both + n[real].astype(U))
    out = {"n": n, "cls": cls.view(np.int64)}
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    place = np.cumsum(bits) - bits
    flips = np.bincount(place[d] + (R.mix(g + U(3)) & (bits[d] - 1).astype(U)).astype(np.int64), minlength=int(bits.sum())) & 1
    packed = np.packbits(flips.astype(np.uint8), bitorder="little")
    out["sketch"] = pa.Array.from_buffers(pa.large_binary(), n_docs, [None, pa.py_buffer(np.append(place, bits.sum()) // 8), pa.py_buffer(packed)]).cast(pa.binary())
    if with_keys:
        bands = Bands(percent, int(n.max(initial=1)))
        doc, band = bands.of(n)
        rows, keys = _segment_keys(g, R.mix(band.astype(U) + U(101)), start[doc], n[doc], bands.segments[band], bands.again[band], bands.spare[band]) if len(doc) else (doc, np.zeros(0, U))
        out["key_doc"], out["keys"] = doc[rows], keys.view(np.int64)
    return out


def _sets(n_gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text"):
            sig = signatures(batch.column("text"), n_gram, percent, False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sig["n"]), pa.array(sig["cls"])], names=["doc_id", "n_shingles", "cls"])

    return run


def _keyed(n_gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text", R.CHUNK_BYTES // 2):
            sig = signatures(batch.column("text"), n_gram, percent, True)
            order = np.argsort(sig["key_doc"], kind="stable")
            counts = np.bincount(sig["key_doc"], minlength=batch.num_rows)
            keys = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(sig["keys"][order]))
            pick = pa.array(np.flatnonzero(counts))
            yield pa.RecordBatch.from_arrays([pa.array(sig["cls"]).take(pick), keys.take(pick)], names=["cls", "keys"])

    return run


def _sketched(n_gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "text"):
            sig = signatures(batch.column("text"), n_gram, percent, False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sig["n"]), pa.array(sig["cls"]), sig["sketch"]], names=["doc_id", "n_shingles", "cls", "sketch"])

    return run


class Sketches:
    """Parity sketches of several lengths, all powers of two. A longer one folds to a shorter: its parts flip each other's bits, as its n-grams would
    have done in the shorter one. Two sketches are compared at the length of the shorter."""

    def __init__(self, cells: pa.Array) -> None:
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in cells]
        self.size = np.array([len(x) for x in raw], np.int64)
        self.at: dict[int, np.ndarray] = {}
        self.bits: dict[int, np.ndarray] = {}
        for size in np.unique(self.size):
            rows = np.flatnonzero(self.size >= size)
            self.at[size] = np.full(len(raw), -1)
            self.at[size][rows] = np.arange(len(rows))
            self.bits[size] = np.stack([np.bitwise_xor.reduce(raw[k].reshape(-1, size), axis=0) for k in rows]).view(np.uint64)

    def apart(self, i: np.ndarray | int, to: np.ndarray) -> np.ndarray:
        """In how many bits sketch i, or each of several, differs from each of `to`: never more than the sets differ."""
        i = np.broadcast_to(i, to.shape)
        common = np.minimum(self.size[i], self.size[to])
        out = np.zeros(len(to), np.int64)
        for size in np.unique(common):
            mine = common == size
            at, bits = self.at[size], self.bits[size]
            mine = np.flatnonzero(mine)
            for k in range(0, len(mine), step := max(1, (4 << 20) // int(size))):
                part = mine[k : k + step]
                out[part] = np.bitwise_count(bits[at[to[part]]] ^ bits[at[i[part]]]).sum(1, dtype=np.int64)
        return out


def _may_link(n: np.ndarray, sketches: Sketches, i: np.ndarray | int, to: np.ndarray, percent: int) -> np.ndarray:
    """Which of `to` may be linked with i, by their sizes and sketches."""
    fits = 100 * np.minimum(n[i], n[to]) >= percent * np.maximum(n[i], n[to])
    left = to[fits]
    j = np.broadcast_to(i, to.shape)[fits]
    fits[fits] = (100 + percent) * sketches.apart(j, left) <= (100 - percent) * (n[j] + n[left])
    return fits


def _passing(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs with both sizes and sketches those that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "ra", "rb"]
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                k = batch.num_rows
                n = np.concatenate([batch.column("na").to_numpy(), batch.column("nb").to_numpy()])
                sketches = Sketches(pa.concat_arrays([batch.column("ka"), batch.column("kb")]))
                ok = pa.array(_may_link(n, sketches, np.arange(k), np.arange(k) + k, percent))
                yield pa.RecordBatch.from_arrays([batch.column(x).filter(ok) for x in names], names=names)

    return run


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted rows, cut so that rows with equal `names` come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        same = np.ones(batch.num_rows - 1, bool)
        for name in names:
            x = batch.column(name).to_numpy()
            same &= x[1:] == x[:-1]
        last = int(np.flatnonzero(np.append(True, ~same))[-1])  # where the last run begins
        if held and last == 0 and all(held[0].column(x)[0] == batch.column(x)[0] for x in names):
            held.append(batch)
            continue
        held.append(batch.slice(0, last))
        yield pa.Table.from_batches(held)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, cls) those whose key several classes have."""
    held = None  # the row before, while it is the first of its key
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key, cls = batch.column("key").to_numpy(), batch.column("cls").to_numpy()
        same = np.zeros(len(key) + 1, bool)  # as the row before
        same[1:-1] = key[1:] == key[:-1]
        same[0] = last is not None and key[0] == last
        keep = same[:-1] | same[1:]
        if held is not None and same[0]:
            key, cls, keep = np.append(held[0], key), np.append(held[1], cls), np.append(True, keep)
        held = None if same[-2] else (key[-1:], cls[-1:])
        last = key[-1]
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(cls[keep])], names=["key", "cls"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, root, cls) in, a key's rows and a root's rows in it one after another, the best ones first; of each root in a key but the first its
    first cls (b, rb) and that of the key (a, ra) out."""
    last = None  # (key, root) of the row before, and cls and root of its key's first row
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key, cls, root = (batch.column(x).to_numpy() for x in ("key", "cls", "root"))
        carried = last is not None and key[0] == last[0]
        new = np.append(not carried, key[1:] != key[:-1])
        other = np.append(not carried or root[0] != last[1], new[1:] | (root[1:] != root[:-1]))
        group = np.cumsum(new) - (0 if carried else 1)
        first_cls, first_root = (np.append(last[2], cls[new]), np.append(last[3], root[new])) if carried else (cls[new], root[new])
        a, ra = first_cls[group], first_root[group]
        last = key[-1], root[-1], a[-1], ra[-1]
        out = other & ~new & (ra != root)
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (a, cls, ra, root)], names=["a", "b", "ra", "rb"])


def _crossed(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (key, lo, hi) in; of each square the pairs of different roots that may link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ("key", "lo", "hi")):
            column = lambda c, t=table: t.column(c).to_numpy()
            cls, root, n = column("cls"), column("root"), column("n")
            sketches = Sketches(table.column("sketch").combine_chunks())
            key, lo, hi, block = column("key"), column("lo"), column("hi"), column("block")
            new = np.append(True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
            start = np.flatnonzero(new)
            behind = np.append(start[1:], len(key))[np.cumsum(new) - 1] - np.arange(len(key)) - 1  # rows of a square behind each row
            ends = np.cumsum(behind)
            at = 0
            while at < len(key):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                i = np.repeat(np.arange(at, stop), behind[at:stop])
                j = _gather(np.arange(at, stop) + 1, behind[at:stop])
                at = stop
                fits = (root[i] != root[j]) & ((lo[i] == hi[i]) | (block[i] != block[j]))
                i, j = i[fits], j[fits]
                fits = _may_link(n, sketches, i, j, percent)
                i, j = i[fits], j[fits]
                if len(i):
                    i, j = np.where(root[j] < root[i], j, i), np.where(root[j] < root[i], i, j)  # a is of the smaller root
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cls[i], cls[j], root[i], root[j])], names=["a", "b", "ra", "rb"])

    return run


def _packed_texts(n_gram: int, percent: int, bloom: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(cls, zstd of the text) of the documents that the filter lets through; a batch repeats no class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(bloom, np.int64)
        pack = zstandard.ZstdCompressor(level=3)
        for batch in R.chunks(batches, "text"):
            at = batch.column("at").to_numpy(zero_copy_only=False)
            hit = (words[at >> 6] >> (at & 63)) & 1 == 1
            batch = batch.filter(pc.and_(pa.array(hit), pc.is_valid(batch.column("text"))))
            if batch.num_rows == 0:
                continue
            cls = signatures(batch.column("text"), n_gram, percent, False)["cls"]
            out = np.unique(cls, return_index=True)[1]
            z = [pack.compress(batch.column("text")[int(k)].as_buffer()) for k in out]
            size = pc.binary_length(batch.column("text")).take(pa.array(out, pa.int64())).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cls[out]), pa.array(z, pa.binary()), size], names=["cls", "z", "size"])

    return run


def _verified(n_gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in R.slices(whole, whole.column("size").to_numpy(), R.CHUNK_BYTES)):
            za, zb = batch.column("za"), batch.column("zb")
            texts = [unpack.decompress(z[k].as_buffer()) for k in range(batch.num_rows) for z in (za, zb)]
            d, g, _ = R.shingles(pa.array(texts, pa.binary()).cast(pa.string()), n_gram)
            size = np.bincount(d, minlength=2 * batch.num_rows)
            pair = d >> 1
            key = R.mix(g ^ R.mix(pair.astype(U) + U(7)))
            order = np.argsort(key, kind="stable")
            key = key[order]
            twice = np.flatnonzero(key[1:] == key[:-1])
            both = np.bincount(pair[order[twice]], minlength=batch.num_rows)
            union = size[::2] + size[1::2] - both
            ok = 100 * both >= percent * union
            names = ["a", "b", "ra", "rb"]
            yield pa.RecordBatch.from_arrays([batch.column(x).filter(pa.array(ok)) for x in names], names=names)

    return run


def _square(cls: np.ndarray, second: np.ndarray, n: np.ndarray, sketches: Sketches, z: pa.Array, n_gram: int, percent: int, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Each class's links to others in a square of two blocks, or of one block with itself."""
    rows = np.arange(len(cls))
    left = rows if alone else rows[~second]
    near = []
    for i in left:
        to = rows[i + 1 :] if alone else rows[second]
        to = to[_may_link(n, sketches, i, to, percent)]
        near.append((i, to))
    used = np.unique(np.concatenate([[i, *to] for i, to in near if len(to)] or [np.zeros(0, np.int64)])).astype(np.int64)
    links = np.zeros(len(cls), np.int64)
    if len(used) == 0:
        return cls, links
    unpack = zstandard.ZstdDecompressor()
    at, grams = [], []
    for k in used:
        g = R.shingles(pa.array([unpack.decompress(z[int(k)].as_buffer())], pa.binary()).cast(pa.string()), n_gram)[1]
        at.append(np.full(len(g), k))
        grams.append(g)
    at, ids = np.concatenate(at), np.unique(np.concatenate(grams), return_inverse=True)[1]
    start = np.searchsorted(at, rows)
    stop = np.searchsorted(at, rows, "right")
    mark = np.zeros(ids.max(initial=-1) + 1, bool)
    for i, to in near:
        if len(to):
            own = ids[start[i] : stop[i]]
            mark[own] = True
            both = np.array([np.count_nonzero(mark[ids[start[j] : stop[j]]]) for j in to])
            mark[own] = False
            linked = to[100 * both >= percent * (n[i] + n[to] - both)]
            links[i] += len(linked)
            links[linked] += 1
    return cls, links


def _squares(n_gram: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (root, lo, hi) in; (cls, n_links) of each class in each square out."""

    def counted(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: table.column(c).to_numpy()
        sketches = Sketches(table.column("sketch"))
        lo, hi = column("lo")[0], column("hi")[0]
        cls, links = _square(column("cls"), column("block") != lo, column("n"), sketches, table.column("z"), n_gram, percent, lo == hi)
        return pa.RecordBatch.from_arrays([pa.array(cls), pa.array(links)], names=["cls", "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = np.column_stack([batch.column(c).to_numpy() for c in ("root", "lo", "hi")])
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and tuple(key[a]) != last:
                    yield counted(held)
                    held = []
                held.append(batch.slice(a, b - a))
                last = tuple(key[a])
        if held:
            yield counted(held)

    return run


class JaccardJoin:
    """The join over one table of documents, step by step; `result` is what callers want.

    Defined results: a null or empty text, or one of white space, has an empty set and is linked with nothing; a text of
    fewer words than an n-gram has its whole sequence as its one n-gram; repeated rows are members of one class; rows that share
    a doc_id but not a text are separate documents; a null doc_id takes part, and names no component. Other columns are
    not read.
    """

    def __init__(self, docs: DataFrame, n_gram: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.n_gram, self.percent = n_gram, percent
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.docs = small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
        rows = self.docs.mapInArrow(_sketched(n_gram, percent), f"doc_id {self.kind}, n_shingles bigint, cls bigint, sketch binary")
        self.rows = park(rows)
        self.classes = park(self.rows.where("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.min("sketch").alias("sketch")))

    def members(self) -> DataFrame:
        """(key, cls): the buckets that several classes share."""
        keyed = self.docs.mapInArrow(_keyed(self.n_gram, self.percent), "cls bigint, keys array<bigint>")
        once = keyed.groupBy("cls").agg(F.first("keys").alias("keys"))
        flat = once.select("cls", F.explode("keys").alias("key"))
        return flat.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(_shared, "key bigint, cls bigint")

    def _texts(self, ends: DataFrame) -> DataFrame:
        """(cls, packed text, its size) of these classes, and of a few others."""
        ends = ends.join(self.classes.select("cls", "rep"), "cls")
        place = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(BLOOM_BITS))
        at = ends.select(place("rep").alias("at"))
        words = at.groupBy(F.shiftright("at", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        bloom = np.zeros(BLOOM_BITS // 64, np.int64)
        for batch in words.toArrow().to_batches():  # at most BLOOM_BITS / 64 rows, whatever the corpus
            bloom[batch.column("w").to_numpy()] = batch.column("bits").to_numpy()
        packed = self.docs.withColumn("at", place("doc_id")).mapInArrow(_packed_texts(self.n_gram, self.percent, bloom.tobytes()), "cls bigint, z binary, size bigint")
        return park(packed.dropDuplicates(["cls"]))

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        left, right = (self.classes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}")) for x in "ab")
        return small_batches(pairs.join(left, "a").join(right, "b")).mapInArrow(_passing(self.percent), PAIR)

    def verify(self, pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, int]:
        """The pairs (a, b, with their roots ra, rb) of classes that do link, by their whole texts, and their number. The side that many
        pairs share is `a`: it is joined first, while a row is a few numbers."""
        left, right = (texts.select(F.col("cls").alias(x), F.col("z").alias(f"z{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
        both = self._near(pairs).join(left, "a").join(right, "b").select("a", "b", "ra", "rb", "za", "zb", (F.col("size_a") + F.col("size_b")).alias("size"))
        links, seen = park_counted(small_batches(both).mapInArrow(_verified(self.n_gram, self.percent), PAIR))
        return links, seen[0]

    def _attempt(self, rooted: DataFrame, tried: DataFrame | None) -> DataFrame:
        """For each component but the first of its buckets one pair that was not tried yet: with the bucket leader with which it shares
        most buckets. Components and classes come in the order of their weights, so pairs lead to heavier roots and never in a circle."""
        order = ["key", F.desc("root_weight"), "root", F.desc("weight"), "cls"]
        stars = rooted.repartition("key").sortWithinPartitions(*order).select("key", "root", "cls").mapInArrow(_stars, PAIR)
        shared = stars.groupBy("rb", "ra", "a", "b").agg(F.count("*").alias("n"))
        if tried is not None:
            shared = shared.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        best = shared.groupBy("rb").agg(F.max_by(F.struct("a", "b", "ra"), F.struct("n", -F.col("a"), -F.col("b"))).alias("m"))
        return best.select("m.a", "m.b", "m.ra", "rb")

    def _weighed(self, members: DataFrame) -> DataFrame:
        """Members with the weight of their class: how many others it meets in all its buckets. A text that many copies were made from meets each
        of them in most buckets, its copies meet one another in fewer: so it leads its buckets, and one attempt joins each copy to it."""
        sizes = members.groupBy("key").agg(F.count("*").alias("size"))
        weights = members.join(sizes, "key").groupBy("cls").agg(F.sum("size").alias("weight"))
        self.weights = park(weights)
        return members.join(self.weights, "cls")

    def _open(self, members: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
        """(key, cls, weight, root, root_weight) of the buckets that still hold several components, and their number."""
        heavy = self.weights.select(F.col("cls").alias("root"), F.col("weight").alias("root_weight"))
        roots = found.join(heavy, "root").withColumnRenamed("node", "cls")
        rooted = members.select("key", "cls", "weight").join(roots, "cls", "left").withColumns({"root": F.coalesce("root", "cls"), "root_weight": F.coalesce("root_weight", "weight")})
        keys = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        opened, seen = park_counted(rooted.join(keys, "key", "left_semi").select("key", "cls", "weight", "root", "root_weight"))
        return opened, seen[0]

    def _crossing(self, rooted: DataFrame) -> DataFrame:
        """All pairs of classes of different components in a bucket whose sizes and sketches allow a link. A bucket is
        compared in squares of two blocks of about PAIR_BLOCK classes, and the tests are made before a pair leaves its task."""
        blocks = rooted.groupBy("key").agg(F.ceil(F.count("*") / PAIR_BLOCK).alias("blocks"))
        placed = rooted.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("cls", "key"), "blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        squares = placed.withColumn("other", other).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
        squares = squares.join(self.classes.drop("rep"), "cls").select("key", "lo", "hi", "block", "cls", "root", "n", "sketch")
        sorted_ = squares.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
        return sorted_.mapInArrow(_crossed(self.percent), PAIR).distinct()

    def links(self) -> DataFrame | None:
        """The components (node, root) of all links between classes, without the roots themselves; None if no bucket is shared.

        Each round tries one pair for each component of the buckets that are still open, so what is tried is linear in the
        classes. Its links are pointers to heavier roots, one a root, and followed to their ends. Rounds end when few attempts succeed;
        then the pairs that cross components in a bucket are compared, all of them, so no link between two components is left.
        """
        members, seen = park_counted(self.members())
        if not seen[0]:
            return None
        self.texts = self._texts(members.select("cls").distinct())
        members = park(self._weighed(members))
        rooted = members.withColumns({"root": F.col("cls"), "root_weight": F.col("weight")})
        found = tried = None
        for _ in range(ROUNDS):
            pairs, (n_pairs,) = park_counted(self._attempt(rooted, tried))
            if not n_pairs:
                break
            links, n_links = self.verify(pairs, self.texts)
            tried = pairs if tried is None else tried.union(pairs)
            if n_links:
                found = joined_roots(found, followed(links.select(F.col("rb").alias("node"), F.col("ra").alias("root"))))
                rooted, n_open = self._open(rooted, found)
                if not n_open:
                    return found
            if n_links * 10 < n_pairs:
                break
        crossing = self._crossing(rooted)
        crossing, (n_pairs,) = park_counted(crossing if tried is None else crossing.join(tried, ["a", "b"], "left_anti"))
        if not n_pairs:
            return found
        links, n_links = self.verify(crossing, self.texts)
        return joined_roots(found, park(components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b"))))) if n_links else found

    def degrees(self, found: DataFrame) -> DataFrame:
        """(cls, n_links): the exact number of other classes that a class is linked with, for the classes in components."""
        found = found.union(found.select("root", "root").distinct())
        sizes = found.groupBy("root").agg(F.count("*").alias("members"))
        ranked = found.join(sizes, "root").withColumnRenamed("node", "cls")
        pairs = ranked.where("members = 2").select("cls", F.lit(1).cast("long").alias("n_links"))  # the link that joins them
        many = park(ranked.where("members > 2").join(self.classes, "cls"))
        place = F.row_number().over(Window.partitionBy("root").orderBy("n", "cls")) - 1
        many = many.withColumn("block", F.floor(place / BLOCK).cast("long")).join(self.texts, "cls")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("members") - 1) / BLOCK).cast("long")))
        squares = many.withColumn("other", other).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
        squares = squares.select("root", "lo", "hi", "block", "cls", "n", "sketch", "z")
        counted = squares.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi").mapInArrow(_squares(self.n_gram, self.percent), "cls bigint, n_links bigint")
        return pairs.union(counted.groupBy("cls").agg(F.sum("n_links").alias("n_links")))

    def groups(self) -> tuple[DataFrame, DataFrame | None]:
        """(cls, component_id) of all classes; and the components (node, root) of those with links."""
        found = self.links()
        if found is None:
            return self.classes.select("cls", F.col("rep").alias("component_id")), None
        named = self.classes.select("cls", "rep").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
        return named.join(ids, "root").select("cls", "component_id"), found

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id (smallest doc_id reachable, itself included). A null component_id, of rows without a
        doc_id and without a partner, stays null."""
        named = park(self.groups()[0])
        out = self.rows.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
        return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

    def counted(self) -> DataFrame:
        """`components` and n_links, the class's exact number of links to other classes. All pairs within a component are compared for
        that, block by block: the work grows with the square of a component, where `components` grows with its size."""
        named, found = self.groups()
        links = self.degrees(found) if found is not None else named.select("cls", F.lit(0).cast("long").alias("n_links")).limit(0)
        named = park(named.join(links, "cls", "left").select("cls", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
        out = self.rows.select("doc_id", "n_shingles", "cls").join(named, "cls", "left")
        return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, n_gram: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False) -> DataFrame:
    """See `JaccardJoin`; one row per input row: doc_id, n_shingles, component_id and, if asked for, n_links."""
    join = JaccardJoin(docs, n_gram, percent, id_col, text_col)
    return join.counted() if count_links else join.components()
