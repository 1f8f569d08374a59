"""Fingerprints of documents: a Merkle tree over pieces, paragraphs and sections, in DataFrame functions only.

A text is cut into words, each with the space behind it. Pieces are runs of words, cut behind a word whose hash is lower than those of the three words on
either side, so that a change moves the cuts next to it only; the first SINGLES words are a piece each, which keeps short texts
comparable; a paragraph's end, a line feed, always cuts. A section ends with an empty line or with a paragraph whose digest begins with
SECTION, so long texts without empty lines have sections too. A piece's digest is the SHA-256 of its text; a paragraph's that of its pieces'
digests, a section's that of its paragraphs', the root's that of the sections'.

The fingerprint is a string of four parts, joined by '.': the root (64 hexadecimal digits), the sections, the paragraphs and the pieces. A section or a paragraph is
SHORT digits of its digest, '-' and the number of children; a piece is PIECE digits; each list is comma-joined. Equal texts have equal
fingerprints, and texts with equal roots are equal but for a collision of SHA-256. `likeness` reads two fingerprints: twice the distinct pieces they share over the sum of
distinct pieces, 1 for equal roots. `edits` goes down two trees and gives the pieces of the one that the other doesn't have, with their place.

Null texts are empty. The empty text has one piece, the empty one. Repeated rows have equal fingerprints. A word of any length, as a text without spaces is one,
is a piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SINGLES = 8
SECTION = "0"
SHORT, PIECE = 8, 6
REACH = 3  # words on either side that a cut's hash is compared with

CELL_ROWS = 64  # documents in a cell of neighbours, about
SAMPLED = 8  # keys that are looked at for each cell's edge
MOST_KEYS = 1 << 16  # keys that are looked at, at most: 33 characters each


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _runs(ends: Column, items: Column, joined: Callable[[Column], Column]) -> Column:
    """`joined` of each run of `items` that ends at a place of `ends`."""

    def one(end: Column, k: Column) -> Column:
        first = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
        return joined(F.transform(F.sequence(first, end), lambda i: F.get(items, i)))

    return F.transform(ends, one)


def _places(items: Column, is_end: Callable[[Column, Column], Column]) -> Column:
    """Where runs of `items` end; the last place always does."""
    return F.array_compact(F.transform(items, lambda x, i: F.when(is_end(x, i) | (i == F.size(items) - 1), i)))


def pieces(text: Column) -> Column:
    """The pieces of a text, an array that joins to it."""

    def cut(words: Column) -> Column:
        def with_hashes(h: Column) -> Column:
            def ends(word: Column, i: Column) -> Column:
                least = F.get(h, i)
                low = F.lit(True)
                for k in range(1, REACH + 1):
                    low = low & F.coalesce(least < F.get(h, i - k), F.lit(True)) & F.coalesce(least < F.get(h, i + k), F.lit(True))
                return (i < SINGLES) | F.endswith(word, F.lit("\n")) | low

            return _let(_places(words, ends), lambda at: _runs(at, words, lambda run: F.array_join(run, "")))

        return _let(F.transform(words, lambda w: F.xxhash64(w)), with_hashes)

    return _let(F.split(text, "(?<=[ \n])(?=[^ \n])|(?<=\n)"), cut)


def _parents(mark: str, digests: Column, ends: Column) -> Column:
    """Digests of the runs of children that end at `ends`."""
    return _runs(ends, digests, lambda run: F.sha2(F.concat(F.lit(mark), F.array_join(run, "")), 256))


def _listed(digests: Column, ends: Column) -> Column:
    size = lambda e, k: e - F.coalesce(F.get(ends, k - 1), F.lit(-1))
    return F.array_join(F.transform(ends, lambda e, k: F.concat(F.substring(F.get(digests, k), 1, SHORT), F.lit("-"), size(e, k).cast("string"))), ",")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""

    def with_pieces(parts: Column) -> Column:
        def with_leaves(leaves: Column) -> Column:
            def with_paragraphs(p_ends: Column) -> Column:
                def with_digests(paragraphs: Column) -> Column:
                    blank = lambda k: F.get(parts, F.get(p_ends, k)) == F.lit("\n")
                    s_ends = _places(p_ends, lambda _, k: F.coalesce(blank(k), F.lit(False)) | F.startswith(F.get(paragraphs, k), F.lit(SECTION)))

                    def with_sections(at: Column) -> Column:
                        def all_of(sections: Column) -> Column:
                            root = F.sha2(F.concat(F.lit("root"), F.array_join(sections, "")), 256)
                            short = F.array_join(F.transform(leaves, lambda d: F.substring(d, 1, PIECE)), ",")
                            return F.concat_ws(".", root, _listed(sections, at), _listed(paragraphs, p_ends), short)

                        return _let(_parents("section", paragraphs, at), all_of)

                    return _let(s_ends, with_sections)

                return _let(_parents("paragraph", leaves, p_ends), with_digests)

            return _let(_places(parts, lambda x, _: F.endswith(x, F.lit("\n"))), with_paragraphs)

        return _let(F.transform(parts, lambda p: F.sha2(p, 256)), with_leaves)

    return _let(pieces(F.coalesce(text, F.lit(""))), with_pieces)


def _part(printed: Column, which: int) -> Column:
    return F.get(F.split(printed, "[.]"), which)


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: how many of their distinct pieces two fingerprints share."""
    leaves = lambda x: F.array_distinct(F.split(_part(x, 3), ","))
    shared = _let(leaves(a), lambda x: _let(leaves(b), lambda y: 2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))))
    return F.when(_part(a, 0) == _part(b, 0), 1.0).otherwise(shared.cast("double"))


def edits(df: DataFrame, printed: str, other: str, keys: list[str]) -> DataFrame:
    """keys, section, paragraph, piece (numbers from 0): the pieces of `printed` that differ from `other`, found by going down branches that `other` doesn't have.
    Rows with equal roots give none."""
    level = lambda c, k: F.transform(F.split(_part(F.col(c), k), ","), lambda x: F.struct(F.split_part(x, F.lit("-"), F.lit(1)).alias("d"), F.nullif(F.split_part(x, F.lit("-"), F.lit(2)), F.lit("")).cast("int").alias("n")))
    digests = lambda c, k: F.transform(level(c, k), lambda x: x["d"])
    apart = df.where(_part(F.col(printed), 0) != _part(F.col(other), 0))
    known = [F.col(c) for c in keys]

    def opened(rows: DataFrame, k: int, name: str, inside: list[str]) -> DataFrame:
        """Rows of level k that `other` lacks, of parents that it lacks: keys, the place within the whole, and the range of its children."""
        out = rows.select(*known, *inside, F.posexplode(level(printed, k)).alias("_i", "_x"), digests(other, k).alias("_o"))
        own = Window.partitionBy(*keys).orderBy("_i")
        out = out.withColumn("_end", F.sum(F.coalesce("_x.n", F.lit(0))).over(own))
        return out.where(~F.array_contains("_o", F.col("_x.d"))).select(*known, *inside, F.col("_i").alias(name), (F.col("_end") - F.coalesce("_x.n", F.lit(0))).alias(f"_{name}_first"), F.col("_end").alias(f"_{name}_end"))

    sections = opened(apart, 1, "section", [])
    paragraphs = opened(apart, 2, "paragraph", []).join(sections, keys).where("paragraph >= _section_first and paragraph < _section_end")
    leaves = opened(apart, 3, "piece", []).join(paragraphs, keys).where("piece >= _paragraph_first and piece < _paragraph_end")
    return leaves.select(*known, "section", "paragraph", "piece")


def _key(id_col: str, text_col: str) -> Column:
    """Text that sorts as (has an id, id, hash of the text)."""
    digits = lambda x: F.lpad(F.hex(x), 16, "0")
    some = F.coalesce(F.col(id_col).cast("bigint"), F.lit(0).cast("bigint")).bitwiseXOR(F.lit(-(1 << 63)))
    return F.concat(F.when(F.col(id_col).isNull(), "0").otherwise("1"), digits(some), digits(F.xxhash64(text_col)))


def with_next(docs: DataFrame, id_col: str, text_col: str, columns: dict[str, Column]) -> DataFrame:
    """Adds next: `columns` (expressions on a document's row, which are added as well) of the next document in descending order of id (those without an id last, equal ids by their texts' hash); of the last one it
    is the first.

    Cells of about CELL_ROWS documents lie between keys that really occur, taken evenly from a sample (one key in CELL_ROWS / SAMPLED, at most
    MOST_KEYS, on the driver). A cell's first document is known by its key, so it goes along to the cell before as a guest; everything else is one shuffle
    by cell and a sort within. The columns are worked out behind the shuffle. Rows equal in id and text lie in one cell.
    """
    keyed = docs.withColumn("_key", _key(id_col, text_col))
    shown = keyed.select("_key").withColumn("_h", F.xxhash64("_key", F.lit("sample")))
    some = shown.where(F.pmod("_h", F.lit(CELL_ROWS // SAMPLED)) == 0).orderBy("_h").limit(MOST_KEYS).select("_key")
    found = sorted({r["_key"] for r in some.union(shown.groupBy().agg(F.max("_key"))).collect() if r[0] is not None})
    edges = sorted({*found[:-1][SAMPLED - 1 :: SAMPLED], *found[-1:]}) or ["1"]
    step = max(1, int(len(edges) ** 0.5))
    coarse = F.split(F.lit(",".join(edges[::step])), ",")
    fine = F.split(F.lit(";".join(",".join(edges[k : k + step]) for k in range(0, len(edges), step))), ";")
    # The number of edges below a key: whole blocks of them first, then within the block that the key lies in.
    key, block = F.col("_key"), F.col("_block")
    placed = keyed.withColumn("_block", F.size(F.filter(coarse, lambda e: e < key)) - 1)
    placed = placed.withColumn("_fine", F.split(F.coalesce(F.get(fine, F.greatest(F.lit(0), block)), F.lit("")), ","))
    cell = F.when(block < 0, 0).otherwise(block * step + F.size(F.filter("_fine", lambda e: e < key)))
    is_edge = F.array_contains("_fine", key) | F.array_contains(coarse, key)
    placed = placed.withColumns({"_cell": cell, "_is_edge": is_edge})
    place = lambda at, guest: F.struct(at.alias("cell"), F.lit(guest).alias("guest"))
    own, as_guest = place(F.col("_cell"), False), place(F.when(key == F.lit(edges[-1]), 0).otherwise(F.col("_cell") + 1), True)
    told = F.explode(F.when(F.col("_is_edge"), F.array(own, as_guest)).otherwise(F.array(own))).alias("_at")
    dealt = placed.select(*docs.columns, "_key", told).select(*docs.columns, "_key", F.col("_at.cell").alias("_cell"), F.col("_at.guest").alias("_guest")).repartition("_cell")
    order = Window.partitionBy("_cell").orderBy("_guest", F.desc("_key"))
    out = dealt.withColumns(columns).withColumn("next", F.lead(F.struct(*columns)).over(order))
    return out.where("not _guest").select(*docs.columns, *(c for c in columns if c not in docs.columns), "next")


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n / 2) characters replaced by as many (or all) of the other's first."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(other, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row a row. Null texts count as empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    told = with_next(rows, "doc_id", "text", {"text": F.col("text"), "fingerprint": fingerprint(F.col("text"))})
    told = told.withColumn("_edited", edited(F.col("text"), F.col("next.text"))).withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    return told.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next.fingerprint")).alias("near_next"),
    )
