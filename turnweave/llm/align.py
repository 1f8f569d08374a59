"""Two tokenizers' tokens of the same text, aligned byte for byte.

A byte-level BPE vocabulary (A) and a piece vocabulary (B, which puts a space before a text) cut the bytes of space+text. Python
tokenises, and so that equal work is done once it numbers what recurs: of a block of texts it gives the distinct stretches between places where
tokens of both end (distinct by their ids on both sides), with both lists of ids and of the byte offsets where tokens end, and for
each text the numbers of its stretches in order. From there on the arrays are worked on by Spark's higher-order functions. They are
interpreted, so what is dear in them is done for each distinct stretch of a block (5 a kB on sf0.1) and not for each token (780 a kB). They look for
cuts in a stretch as in a text: where texts were cut into stretches saves work and settles nothing.

- Cuts are the ends that both have. Between two cuts lies a group of A and B tokens.
- All ends of a stretch go into one sorted array of numbers, end << 32 | side << 31 | place, A's before B's. The element at place r of
  it that is A's token i has r - i ends of B before it, so it is linked with B's token r - i; likewise the other way round, where B's
  end is no cut. Each end is thus exactly one link: A tokens + B tokens - cuts.
- A text's groups and links are those of its stretches, one after another.
- A text's links go into a written table, once a distinct stretch of the text with the number of times; texts with a link of the same pair of ids are
  counted. Counts meet the links again by a broadcast of the HOT most frequent pairs, at most that many, and a shuffle join for the rest.

A's ids are those of the vocabulary in JSON; its merges are carried out by tiktoken, which cuts texts in the same way (held against the
`tokenizers` library over all code points) in a quarter of the time. Where white space runs on for WIDE characters, which tiktoken can't
take, `tokenizers` itself encodes the text.

Null and empty texts, and texts whose tokens' bytes aren't those of space+text (characters that B normalises away), have no
tokens: zeros and ''. Rows are told apart by place, so repeated rows and null ids are documents of their own. Other columns are not
carried. A text of any length is one block at least; its arrays are one row.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.llm import bpe
from turnweave.llm import ragged as R
from turnweave.llm.lineage import park, park_counted, small_batches

BLOCK_BYTES = 1 << 20
WIDE = 10_000
HOT = 400_000  # pairs of ids that are broadcast at most, 24 bytes each
SIDE, PLACE = 1 << 31, (1 << 31) - 1
BLOCK = "▁"  # fixed value: how pieces write a space


def json_tokens(path: str) -> dict[bytes, int]:
    """The id of each token's bytes in a byte-level BPE vocabulary, special tokens left out. Ids must be in the order of the merges, so that they are
    ranks as well."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that such a vocabulary writes as themselves; the others follow from U+0100 on
    letters = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {x["content"] for x in said.get("added_tokens", [])}
    table = {bytes(letters[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in special}
    order = [table[bytes(letters[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))] for m in said["model"]["merges"]]
    if any(x >= y for x, y in itertools.pairwise(order)):
        raise ValueError("the merges are not in the order of their tokens' ids")
    return table


class _Coder(NamedTuple):
    """How a tokenizer encodes texts, its tokens' bytes one after another, and where each begins."""

    encode: Callable[[list[str]], list[list[int]]]
    told: np.ndarray
    at: np.ndarray


@functools.lru_cache(maxsize=1)
def _coders(a_path: str, b_path: str) -> tuple[_Coder, _Coder]:
    import public_tokenizers
    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    table = json_tokens(a_path)
    fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    slow = Tokenizer.from_file(a_path)
    slow.encode_special_tokens = True
    wide = re.compile(rf"\s{{{WIDE}}}")

    def encode_a(texts: list[str]) -> list[list[int]]:
        return [slow.encode(t, add_special_tokens=False).ids if len(t) > WIDE and wide.search(t) else fast.encode_ordinary(t) for t in texts]

    model = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(BLOCK, " ").encode() for i, p in pieces]
    a_bytes = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        a_bytes[i] = token

    def coder(encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes]) -> _Coder:
        return _Coder(encode, np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(t) for t in tokens])))

    return coder(encode_a, a_bytes), coder(lambda texts: model.encode([t[1:] for t in texts], num_threads=1), b_bytes)


def _encoded(texts: list[str], data: np.ndarray, offs: np.ndarray, coder: _Coder) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, the byte offsets in their text where they end, the number of ids before each text, and for each text whether the tokens' bytes are its own."""
    found = coder.encode(texts)
    before = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))
    ids = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(before[-1]))
    length = (coder.at[1:] - coder.at[:-1])[ids]
    ends = np.append(0, np.cumsum(length))
    said = ends[before]  # bytes told before each text
    told = coder.told[bpe._gather(coder.at[:-1][ids], length)]
    same = np.diff(said) == np.diff(offs)
    if np.array_equal(said, offs):
        same[np.searchsorted(offs, np.flatnonzero(told != data), "right") - 1] = False
    else:
        for k in np.flatnonzero(same):
            same[k] = np.array_equal(told[said[k] : said[k + 1]], data[offs[k] : offs[k + 1]])
    return ids, ends[1:] - np.repeat(said[:-1], np.diff(before)), before, same & (np.diff(offs) > 1)


def _list_of(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)


def _numbered(ids: tuple[np.ndarray, np.ndarray], ends: tuple[np.ndarray, np.ndarray], size: int) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The stretches between ends that both sides have, of `size` bytes in which both sides' tokens end at `ends`: equal ones under one number, spelled
    as A's ids and then the complements of B's; and where they end."""
    ending = np.zeros((2, size + 1), bool)
    for own, at in zip(ending, ends, strict=True):
        own[at] = True
    last = [np.flatnonzero(other[at]) for other, at in zip(ending[::-1], ends, strict=True)]
    first_a, first_b = (np.append(0, x + 1) for x in last)  # tokens of a side before each stretch
    spelled = np.empty(len(ids[0]) + len(ids[1]), np.int32)
    spelled[np.arange(len(ids[0])) + np.repeat(first_b[:-1], np.diff(first_a))] = ids[0]
    spelled[np.arange(len(ids[1])) + np.repeat(first_a[1:], np.diff(first_b))] = ~ids[1]
    at = (first_a + first_b) * spelled.itemsize
    words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(spelled)])
    return words.dictionary_encode(), ends[0][last[0]]


def _sides(words: pa.Array, coders: tuple[_Coder, _Coder]) -> pa.Array:
    """a_ids, a_ends, b_ids, b_ends of each stretch as `_numbered` spells it."""
    raw = words.buffers()
    offs = np.frombuffer(raw[1], np.int64)[: len(words) + 1] // 4 if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.int32)[: offs[-1]] if len(words) else np.zeros(0, np.int32)
    of = np.repeat(np.arange(len(words)), np.diff(offs))
    out = []
    for own, ids, coder in zip((data >= 0, data < 0), (data, ~data), coders, strict=True):
        mine, counts = ids[own], np.bincount(of[own], minlength=len(words))
        ends = np.append(0, np.cumsum((coder.at[1:] - coder.at[:-1])[mine]))
        out += [_list_of(pa.array(x, pa.int32()), counts) for x in (mine, ends[1:] - np.repeat(ends[np.cumsum(counts) - counts], counts))]
    return pa.StructArray.from_arrays(out, ["a_ids", "a_ends", "b_ids", "b_ends"])


def _tokenise(a_path: str, b_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(a_path, b_path)
        for batch in R.chunks(batches, "text", BLOCK_BYTES):
            texts = [f" {t or ''}" for t in batch.column("text").to_pylist()]
            data, offs = R.buffer(pa.array(texts, pa.large_string()))
            found = [_encoded(texts, data, offs, c) for c in coders]
            keep = found[0][3] & found[1][3]
            counts = [np.where(keep, np.diff(before), 0) for _, _, before, _ in found]
            whole = [np.repeat(keep, np.diff(before)) for _, _, before, _ in found]
            ids = tuple(f[0][w] for f, w in zip(found, whole, strict=True))
            ends = tuple(f[1][w] + np.repeat(offs[:-1], n) for f, w, n in zip(found, whole, counts, strict=True))
            numbered, ended = _numbered(ids, ends, len(data))
            own = np.diff(np.searchsorted(ended, offs, "right"))  # stretches of each text
            numbers, n = numbered.indices.to_numpy(), max(1, len(numbered.dictionary))
            kinds, times = np.unique(np.repeat(np.arange(len(texts)) * n, own) + numbers, return_counts=True)
            kinds = _list_of(pa.StructArray.from_arrays([pa.array(kinds % n, pa.int32()), pa.array(times, pa.int32())], ["stretch", "times"]), np.bincount(kinds // n, minlength=len(texts)))
            docs = [batch.column("doc_id"), *(pa.array(c, pa.int32()) for c in counts), _list_of(pa.array(numbers, pa.int32()), own), kinds]
            docs = pa.StructArray.from_arrays(docs, ["doc_id", "n_a", "n_b", "stretches", "kinds"])
            block = [_list_of(x, np.array([len(x)])) for x in (docs, _sides(numbered.dictionary, coders))]
            yield pa.RecordBatch.from_arrays(block, names=["docs", "told"])

    return run


def tokenised(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a block of texts. docs: doc_id, n_a, n_b, the numbers of its stretches in order, and kinds, how many times it has each of them, for each row of the block.
    told: each distinct stretch of the block, by number from 0, as a_ids, a_ends, b_ids, b_ends: both tokenizers' ids and the byte offsets in the stretch
    where their tokens end."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    sides = ", ".join(f"{c}: array<int>" for c in ("a_ids", "a_ends", "b_ids", "b_ends"))
    return rows.mapInArrow(_tokenise(a_path, b_path), f"docs array<struct<doc_id: {kind}, n_a: int, n_b: int, stretches: array<int>, kinds: array<struct<stretch: int, times: int>>>>, told array<struct<{sides}>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _placed(ends: Column, side: int) -> Column:
    return F.transform(ends, lambda e, i: F.shiftleft(e.cast("bigint"), 32).bitwiseOR(i.cast("bigint") + F.lit(side)))


def _line(a_ends: Column, b_ends: Column) -> Column:
    """All ends in order, as end << 32 | side << 31 | place."""
    return F.sort_array(F.concat(_placed(a_ends, 0), _placed(b_ends, SIDE)))


def _links(line: Column, a_ids: Column, b_ids: Column) -> Column:
    """Each link as A's id << 32 | B's id, in order of bytes."""

    def link(v: Column, r: Column) -> Column:
        own = v.bitwiseAND(F.lit(PLACE)).cast("int")
        pair = lambda i, j: F.shiftleft(F.get(a_ids, i).cast("bigint"), 32).bitwiseOR(F.get(b_ids, j).cast("bigint"))
        cut = F.shiftright(F.get(line, r - 1), 32) == F.shiftright(v, 32)
        return F.when(v.bitwiseAND(F.lit(SIDE)) == 0, pair(own, r - own)).when(F.coalesce(cut, F.lit(False)), None).otherwise(pair(r - own, own))

    return F.array_compact(F.transform(line, link))


def _said(line: Column, ids: Column, side: int) -> Column:
    """One side's ids in order, those of a group comma-joined: a string a group."""
    beside = -1 if side else 1  # of two ends that make a cut A's comes first

    def token(told: Column) -> Callable[[Column, Column], Column]:
        def one(v: Column, r: Column) -> Column:
            cut = F.shiftright(F.get(line, r + beside), 32) == F.shiftright(v, 32)
            text = F.concat(F.get(told, v.bitwiseAND(F.lit(PLACE)).cast("int")), F.when(cut, ";").otherwise(","))
            return F.when(v.bitwiseAND(F.lit(SIDE)) == side, text)

        return one

    joined = _let(ids.cast("array<string>"), lambda told: F.array_join(F.transform(line, token(told)), ""))
    return F.split(F.rtrim(joined, F.lit(";")), ";")


def _groups(line: Column, a_ids: Column, b_ids: Column) -> Column:
    """Each group as `a1,a2|b1`."""
    both = F.zip_with(_said(line, a_ids, 0), _said(line, b_ids, SIDE), lambda a, b: F.concat(a, F.lit("|"), b))
    return F.when(F.size(line) > 0, both).otherwise(F.array().cast("array<string>"))


def _told(made: Callable[[Column, Column, Column], Column]) -> Column:
    """What is made of each stretch's line and ids."""
    return F.transform("told", lambda s: _let(_line(s["a_ends"], s["b_ends"]), lambda line: made(line, s["a_ids"], s["b_ids"])))


def _rows(blocks: DataFrame, groups: Callable[[Column, Column, Column], Column], more: Callable[[Column], list[Column]]) -> DataFrame:
    """doc_id, n_a, n_b and `more`, which is told from one of docs and from columns with each stretch's groups and links: one row for each of the blocks' rows."""
    whole = blocks.select("docs", _told(groups).alias("groups"), _told(_links).alias("links"))  # columns, since lambdas copy what they pass on
    counts = lambda d: [d[c].cast("long").alias(c) for c in ("n_a", "n_b")]
    return whole.select(F.inline(F.transform("docs", lambda d: F.struct(d["doc_id"].alias("doc_id"), *counts(d), *more(d)))))


def aligned(blocks: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, groups (`a1,a2|b1`) and links (A's id << 32 | B's id) of whole texts, both in order of bytes."""

    def whole(d: Column, of: str) -> Column:
        return F.flatten(F.transform(d["stretches"], lambda k: F.get(of, k))).alias(of)

    return _rows(blocks, _groups, lambda d: [whole(d, "groups"), whole(d, "links")])


def digested(blocks: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, groups_sha256 (of the groups, joined by ;, '' without tokens), and what `aligned` lists as links by stretches in no order: parts, of times and
    links."""

    def more(d: Column) -> list[Column]:
        said = F.array_join(F.transform(d["stretches"], lambda k: F.get("groups", k)), ";")
        parts = F.transform(d["kinds"], lambda k: F.struct(k["times"].alias("times"), F.get("links", k["stretch"]).alias("links")))
        return [F.when(F.size(d["stretches"]) > 0, F.sha2(said, 256)).otherwise("").alias("groups_sha256"), parts.alias("parts")]

    return _rows(blocks, lambda *x: F.array_join(_groups(*x), ";"), more)


def pair_counts(lined: DataFrame) -> DataFrame:
    """pair, n_docs, best: in how many documents a pair of ids is linked, and whether that is its A id's highest. `lined` has parts."""
    counts = lined.select(F.explode(F.array_distinct(F.flatten("parts.links"))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    counts = park(counts)
    top = counts.groupBy(F.shiftright("pair", 32).alias("_a")).agg(F.max("n_docs").alias("_top"))
    return counts.join(top, F.shiftright("pair", 32) == F.col("_a")).select("pair", "n_docs", (F.col("n_docs") == F.col("_top")).alias("best"))


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least n_docs such that no more than `most` pairs have that or more, told from a histogram of 256 steps at most."""
    step = F.floor(F.log2("n_docs") * 4).cast("int")
    told = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("n_docs").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, 1 << 62
    for x in told:
        total += x["n"]
        if total > most:
            break
        least = x["least"]
    return least


def scored(lined: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """row, n_links, n_best and count_sum of the rows of `lined` (row, parts) that have links."""
    least = _hot_from(counts, hot)
    flat = lined.select("row", F.inline("parts")).select("row", F.col("times").cast("long").alias("times"), F.explode("links").alias("pair"))
    often = counts.where(F.col("n_docs") >= least)
    sums = F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n_docs") * F.col("times")).alias("count_sum")
    told = flat.join(F.broadcast(often), "pair").groupBy("row").agg(*sums)  # at most `hot` rows
    if least > 1:
        rest = flat.join(F.broadcast(often.select("pair")), "pair", "left_anti").join(counts.where(F.col("n_docs") < least), "pair")
        told = told.unionByName(rest.groupBy("row").agg(*sums)).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")))
    return told


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is their A id's highest), count_sum (over links), groups_sha256 (of
    `a1,a2|b1;a3|b2,b3`; '' without tokens): one row a row. A pair's count is the number of documents that have it linked."""
    told = ["doc_id", "n_a", "n_b", "groups_sha256"]
    lined = park(digested(tokenised(docs, a_path, b_path, id_col, text_col)).select(F.monotonically_increasing_id().alias("row"), *told, "parts"))
    counts, _ = park_counted(pair_counts(lined))
    found = lined.select("row", *told).join(scored(lined.select("row", "parts"), counts, hot), "row", "left")
    n_links, n_best, count_sum = (F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum"))
    n_groups = (F.col("n_a") + F.col("n_b") - n_links).alias("n_groups")  # each end is a link, one that both have a single one
    return found.select("doc_id", "n_a", "n_b", n_groups, n_links, n_best, count_sum, "groups_sha256")
