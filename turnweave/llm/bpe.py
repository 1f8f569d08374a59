"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

1. Each task cuts its texts into pre-tokens, block by block (about `BLOCK_BYTES` of text): a list of the block's distinct
   words, and for each pre-token in its position the word's number in that list.
2. The blocks' distinct words are shuffled by word, so all lists that hold a word meet in one task. There the words of all
   lists are made distinct and encoded once, all together: a vectorised merge loop that merges in each word its leftmost pair
   of lowest rank, round by round (`merged`).
3. The ids meet the blocks' numbers again (a cogroup by block), are joined to them and reassembled by position.

Pre-tokens and words travel packed, a block's list or numbers as one value: as rows of their own (one for each distinct word of a
block, about 24,000 a MB of the test texts in blocks of 8 MB) they would need more than the 1.5 x input of disk that the
operator has. Words and numbers come from two passes over the texts, which costs less than shuffling the numbers twice. A block is
named by its partition and its place there, so copies of a text are blocks of their own; its content's hash goes along, and
two passes that disagree are an error. Input that is not read from files is written first (`encode`). Decoding joins ids with
the token-byte table, whose size is that of the vocabulary file, within the task.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.lineage import park, small_batches

BLOCK_BYTES = 2 << 20
PIECE_BYTES = 1 << 18  # of a block that are cut into words at once
LIST_BYTES = 24 << 20  # of words that are made distinct at once; a part with more, for want of partitions, is worked off in several goes
LONG = 64  # bytes; longer words are merged one by one

# White space of the pre-token pattern.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that stand alone after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


@functools.cache
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def pre_tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where pre-tokens start (all bytes belong to one), and the number of pre-tokens before each text."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _classes()[points]
    n = len(points)
    first = np.zeros(n + 3, bool)  # a text begins; the padding ends the last text
    first[n:] = True
    texts = np.searchsorted(leads, offs[:-1])
    first[texts[offs[:-1] < offs[1:]]] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    starts = run.copy()
    after = np.flatnonzero(run[1:] & ~first[1:n] & (kind[:-1] == SPACE)) + 1
    starts[after - 1] = True
    starts[after] = points[after - 1] != 0x20
    quote = np.flatnonzero(starts & run & (points == 0x27))
    quote = quote[~first[quote + 1]]
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        a = points[quote + 1]
        second = ~first[quote + 2]
        b = np.where(second, np.append(points, [0, 0])[np.minimum(quote + 2, n)], 0)
        taken = np.where(np.isin(a, [ord(c) for c in SHORT_ENDINGS]), 2, 0)
        for x, y in LONG_ENDINGS:
            taken[(a == ord(x)) & (b == ord(y))] = 3
        quote, taken = quote[taken > 0], taken[taken > 0]
        starts[quote + 1] = False
        rest = quote + taken
        rest = rest[~first[rest]]
        starts[rest[kind[rest] == LETTER]] = True
    s = leads[starts]
    return s, np.searchsorted(s, offs)


def _gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[0], start[0]+1, ... of all spans, one after another."""
    total = int(size.sum())
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def _planes(x: np.ndarray) -> np.ndarray:
    """uint32 values as four byte planes, which pack better."""
    return np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).ravel()


def _from_planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(4, -1).T).ravel().view(np.uint32)


def _dictionary(data: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pre-tokens, frequent ones first: start, size, hash; and each pre-token's number."""
    e = np.append(s[1:], len(data))
    h = R.span_hash(data, s, e)
    _, at, inverse, counts = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    number = np.empty(len(at), np.int64)
    order = np.argsort(-counts, kind="stable")
    number[order] = np.arange(len(at))
    at = at[order]
    inverse = number[inverse]
    size = (e - s)[at]
    if not np.array_equal((e - s), size[inverse]) or not np.array_equal(data[_gather(s[at][inverse], e - s)], data):
        raise ValueError("two words of one block share a 64-bit hash")
    return s[at], size, h[at], inverse


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks: rows, name, hash of the content, bytes, starts of pre-tokens, pre-tokens before each text."""
    name = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

    def block(held: list[pa.RecordBatch]) -> tuple[pa.Table, int, int, np.ndarray, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        data, offs = R.buffer(table.column("text"))
        starts, counts = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        first = 0
        while first < len(offs) - 1:  # text by text, some at a time: the cutting needs many times a piece's size
            last = max(first + 1, int(np.searchsorted(offs, offs[first] + PIECE_BYTES, "right")) - 1)
            s, before = pre_tokens(data[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
            starts.append(s + offs[first])
            counts.append(before[1:] + counts[-1][-1])
            first = last
        s, before = np.concatenate(starts), np.concatenate(counts)
        whole = R.span_hash(data, np.zeros(1, np.int64), np.full(1, len(data)))
        content = R.mix(whole + R.mix(offs.astype(R.U64) + np.arange(len(offs), dtype=R.U64) * R.U64(31)).sum())
        return table, name, int(content.view(np.int64)[0]), data, s, before

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in R.chunks(batches, "text", BLOCK_BYTES):
        more = batch.column("text").nbytes
        if held and size + more > BLOCK_BYTES:
            yield block(held)
            held, size = [], 0
            name += 1
        held.append(batch)
        size += more
    if held:
        yield block(held)


def _words(parts: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each block's distinct words, a row for each of the parts that its words fall into by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(parts, np.int64)
        for _, name, content, data, s, _ in _cut(batches):
            if len(s) == 0:
                continue
            at, length, h, _ = _dictionary(data, s)
            to = (h % R.U64(len(parts))).astype(np.int64)
            order = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[order], np.arange(len(parts) + 1))
            full = np.flatnonzero(np.diff(edges))
            payloads = []
            for p in full:
                mine = order[edges[p] : edges[p + 1]]
                payloads.append(_pack(_planes(np.diff(mine, prepend=0)), _planes(length[mine]), data[_gather(at[mine], length[mine])]))
            yield pa.RecordBatch.from_arrays([pa.array(names[full]), pa.array(np.full(len(full), name)), pa.array(np.full(len(full), content)), pa.array(payloads, pa.binary())], names=["part", "block", "content", "payload"])

    return run


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's word numbers and the ids of its rows."""
    for table, name, content, data, s, before in _cut(batches):
        number = _dictionary(data, s)[3] if len(s) else np.zeros(0, np.int64)
        ids = pa.concat_arrays(table.column("doc_id").chunks)
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        payload = _pack(before.astype(np.int64), _planes(number))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content]), pa.array([payload], pa.binary()), lists], names=["block", "content", "payload", "ids"])


@functools.cache
def _merges(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id of each byte; and all pairs of tokens that make a token: keys left << 32 | right, ascending, and its id."""
    table = ranks(path)
    single = np.array([table[bytes([b])] for b in range(256)], np.int64)
    pairs = [(table[t[:k]] << 32 | table[t[k:]], rank) for t, rank in table.items() for k in range(1, len(t)) if t[:k] in table and t[k:] in table]
    keys, made = (np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return single, keys, made


NONE = np.int64(1 << 40)  # no pair


def _paired(left: np.ndarray, right: np.ndarray, keys: np.ndarray, made: np.ndarray) -> np.ndarray:
    """The id of each pair's token, or NONE."""
    if len(keys) == 0:
        return np.full(len(left), NONE)
    want = left << 32 | right
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return np.where(keys[at] == want, made[at], NONE)


def merged(data: np.ndarray, size: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words that lie one after another in `data`, and each word's number of ids.

    In every round each word that still has a mergeable pair merges one, the leftmost of its lowest rank."""
    single, keys, made = _merges(path)
    n = len(size)
    ids = single[data]
    word = np.repeat(np.arange(n), size)
    long = size > LONG
    done_word, done_ids = [word[:0]], [ids[:0]]
    if long.any():
        start = np.cumsum(size) - size
        for k in np.flatnonzero(long):
            found = _merged_alone(ids[start[k] : start[k] + size[k]].tolist(), path)
            done_word.append(np.full(len(found), k))
            done_ids.append(np.array(found, np.int64))
        short = ~long[word]
        word, ids = word[short], ids[short]
    pair = np.full(len(ids), NONE)  # of a token and the one after it
    inner = np.flatnonzero(word[1:] == word[:-1])
    pair[inner] = _paired(ids[inner], ids[inner + 1], keys, made)
    while len(ids):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        count = np.diff(np.append(first, len(word)))
        least = np.minimum.reduceat(pair, first)
        busy = least < NONE
        if not busy.all():
            stay = np.repeat(busy, count)
            done_word.append(word[~stay])
            done_ids.append(ids[~stay])
            word, ids, pair = word[stay], ids[stay], pair[stay]
            least, count = least[busy], count[busy]
            if len(ids) == 0:
                break
        hit = np.flatnonzero(pair == np.repeat(least, count))
        hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]  # the leftmost of each word
        ids[hit] = pair[hit]
        keep = np.ones(len(ids), bool)
        keep[hit + 1] = False
        moved = np.cumsum(keep) - 1
        word, ids, pair = word[keep], ids[keep], pair[keep]
        hit = moved[hit]
        for at in (hit, hit - 1):  # pairs that begin with, or end in, the new token
            at = at[at >= 0]
            nxt = np.minimum(at + 1, len(ids) - 1)
            inside = (at + 1 < len(ids)) & (word[nxt] == word[at])
            fresh = np.full(len(at), NONE)
            fresh[inside] = _paired(ids[at[inside]], ids[nxt[inside]], keys, made)
            pair[at] = fresh
    word, ids = np.concatenate(done_word), np.concatenate(done_ids)
    order = np.argsort(word, kind="stable")
    return ids[order], np.bincount(word, minlength=n)


def _merged_alone(ids: list[int], path: str) -> list[int]:
    """One long word, by a heap of its pairs and a linked list of its tokens."""
    _, keys, made = _merges(path)
    pairs = _pair_table(path)
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(pairs[key], k, ids[k], ids[k + 1]) for k in range(n - 1) if (key := ids[k] << 32 | ids[k + 1]) in pairs]
    heapq.heapify(heap)
    while heap:
        made_id, k, left, right = heapq.heappop(heap)
        nxt = after[k]
        if ids[k] != left or nxt >= n or ids[nxt] != right:
            continue
        ids[k], ids[nxt] = made_id, -1
        after[k] = after[nxt]
        if after[k] < n:
            before[after[k]] = k
        for a, b in ((before[k], k), (k, after[k])):
            if a >= 0 and b < n and (key := ids[a] << 32 | ids[b]) in pairs:
                heapq.heappush(heap, (pairs[key], a, ids[a], ids[b]))
    return [x for x in ids if x >= 0]


@functools.cache
def _pair_table(path: str) -> dict[int, int]:
    _, keys, made = _merges(path)
    return dict(zip(keys.tolist(), made.tolist(), strict=True))


def _encode_words(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Encodes the distinct words of a part's lists, each once, and hands every list its ids."""

    def coded(held: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = [_from_planes(length).astype(np.int64) for _, _, _, length, _ in held]
        size, data = np.concatenate(sizes), np.concatenate([words for *_, words in held])
        end = np.cumsum(size)
        h = R.span_hash(data, end - size, end)
        _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        if not np.array_equal(size[at][inverse], size) or not np.array_equal(data[_gather((end - size)[at][inverse], size)], data):
            raise ValueError("two words share a 64-bit hash")
        ids, count = merged(data[_gather((end - size)[at], size[at])], size[at], path)
        start = np.cumsum(count) - count
        out, base = [], 0
        for (_, _, step, _, _), length in zip(held, sizes, strict=True):
            mine = inverse[base : base + len(length)]
            base += len(length)
            out.append(_pack(step, _planes(count[mine]), _planes(ids[_gather(start[mine], count[mine])])))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held]), pa.array([x[1] for x in held]), pa.array(out, pa.binary())], names=["block", "content", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for block, content, payload in zip(*(batch.column(c) for c in ("block", "content", "payload")), strict=True):
                parts = _unpack(payload.as_buffer(), np.uint8, np.uint8, np.uint8)
                held.append((block.as_py(), content.as_py(), *parts))
                size += len(parts[2])
                if size >= LIST_BYTES:
                    yield coded(held)
                    held, size = [], 0
        if held:
            yield coded(held)

    return run


def _reassemble(numbers: pa.Table, words: pa.Table) -> pa.Table:
    """The rows of a block: the ids of each pre-token's word, in order."""
    contents = pa.compute.unique(pa.concat_arrays([c for t in (numbers, words) for c in t.column("content").chunks]))
    if numbers.num_rows != 1 or len(contents) != 1:
        raise ValueError("two passes over the texts gave different blocks: write the input first")
    parts = [[_from_planes(x) for x in _unpack(p.as_buffer(), np.uint8, np.uint8, np.uint8)] for p in words.column("payload")]
    n_words = max((int(step.sum()) for step, _, _ in parts if len(step)), default=-1) + 1
    start, size = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
    flat, base = [], 0
    for step, count, ids in parts:
        at = np.cumsum(step.astype(np.int64))
        count = count.astype(np.int64)
        start[at], size[at] = base + np.cumsum(count) - count, count
        flat.append(ids.astype(np.int32))
        base += len(ids)
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    before, planes = _unpack(numbers.column("payload")[0].as_buffer(), np.int64, np.uint8)
    number = _from_planes(planes)
    counts = size[number]
    offs = np.append(0, np.cumsum(counts))[before]
    found = ids[_gather(start[number], counts)] if len(number) else ids[:0]
    lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(found, pa.int32()))
    return pa.table({"doc_id": numbers.column("ids")[0].values, "ids": lists})


def _parts(spark: SparkSession) -> list[int]:
    """As many numbers as there are shuffle partitions, each of which falls into a partition of its own."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = spark.range(20 * n + 100).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("to")).agg(F.min("id").alias("id"))
    return [r["id"] for r in some.collect()]  # at most n rows


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", from_files: bool = False) -> DataFrame:
    """One row per input row: `doc_id` and `ids` (array<int>), the text's byte-level BPE ids without special tokens.

    Null and empty texts give an empty array. Repeated rows and null ids are kept. Other columns are not carried. Two
    shuffles move packed blocks; a frequent word, a hot source or a copied text adds nothing to any one task, since a
    block lists a word once and blocks are equally large. A single text longer than a block is a block of its own. The texts
    are read twice: unless the caller says that `docs` is a plain read of files, they are written to the shared folder first.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = small_batches(rows if from_files else park(rows))
    parts = _parts(docs.sparkSession)
    words = rows.mapInArrow(_words(parts), "part bigint, block bigint, content bigint, payload binary")
    coded = words.repartition(len(parts), "part").mapInArrow(_encode_words(ranks_path), "block bigint, content bigint, payload binary")
    numbers = rows.mapInArrow(_numbers, f"block bigint, content bigint, payload binary, ids array<{kind}>")
    return numbers.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(_reassemble, f"doc_id {kind}, ids array<int>")


def _decoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        size = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            size[rank] = len(token)
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(t for t, _ in sorted(table.items(), key=lambda x: x[1])), np.uint8)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists = batch.column("ids")
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or (size[ids] == 0).any()):
                    raise ValueError("an id is not in the token-byte table")
                counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ends = np.append(0, np.cumsum(size[ids]))[np.append(0, np.cumsum(counts))]
                data = flat[_gather(start[ids], size[ids])]
                out = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                out = pa.compute.if_else(pa.compute.is_null(lists), pa.scalar(None, pa.binary()), out)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, out], names=["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded` (binary): the bytes of `ids`, by a join with the token-byte table that every task holds (one row per
    rank of the vocabulary file). Null ids give null; an id outside the table is an error."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(ranks_path), f"doc_id {kind}, ids array<int>, decoded binary")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(counts)).tolist()
        shas = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        decoded = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in batch.column("decoded")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded bytes."""
    kind = decoded.schema["doc_id"].dataType.simpleString()
    return decoded.mapInArrow(_digested, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
