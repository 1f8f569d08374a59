"""How far the sources of a language differ in their words: joint count histograms.

Each task tallies its texts' terms by (lang, source), with the number of documents that have them; tallies are summed by key. A language
keeps the terms of at least LEAST_DOCS of its documents, and each kept term is one row with its counts by source, `by_source`, an array with an entry for each
source that has it. (Such an array is no longer than the square root of the result, which has a row for each pair of sources of a language.)

Terms with equal `by_source` are one pattern with a multiplicity. Patterns give, for each pair of sources, the distinct combinations
(count here, count there) with the number of terms that have it. Combinations with a zero on one side are implied: a source's own
histogram of counts goes to every other source of the language, less what the joint combinations have of it, and what then is missing of all kept
terms is the combination (0, 0). The divergence is worked out once for each combination and multiplied. Whole numbers
throughout: p = 1 + floor(SCALE * (count + 1) / (N + V)), f = floor((p - q) ** 2 / q).

Null text, lang and source are ''. A text without terms adds its (lang, source) only; repeated rows are documents of their own; ties in value are
ranked by the item's bytes; an empty table has no groups; other columns are not read. Sums that don't fit 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.llm import bpe
from turnweave.llm import ragged as R
from turnweave.llm.lineage import park, park_counted, small_batches

CHUNK_BYTES = 2 << 20
LEAST_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
BROADCAST_ROWS = 200_000  # groups (lang, source) up to this number are broadcast, some small values each

# ASCII characters that terms consist of; all others beyond ASCII belong to terms too.
LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B)]
BETWEEN = np.ones(256, bool)  # bytes between terms
BETWEEN[LETTERS] = False
BETWEEN[0x80:] = False


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and n_docs of each chunk of texts."""
    for batch in R.chunks(batches, "text", CHUNK_BYTES):
        data, offs = R.buffer(batch.column("text"))
        data = R.lowered(data)
        start, end, doc = R.word_spans(data, offs, BETWEEN)
        if len(start) == 0:
            continue
        lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
        n_sources = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
        size = end - start
        _, at, term = np.unique(R.span_hash(data, start, end), return_index=True, return_inverse=True)
        if not np.array_equal(size, size[at][term]) or not np.array_equal(data[bpe._gather(start, size)], data[bpe._gather(start[at][term], size)]):
            raise ValueError("two terms of one chunk share a 64-bit hash")
        held, n = np.unique(doc * len(at) + term, return_counts=True)  # by document and term
        doc, term = held // len(at), held % len(at)
        keys, where = np.unique(group[doc] * len(at) + term, return_inverse=True)
        group, term = keys // len(at), keys % len(at)
        begin, size = start[at][term], size[at][term]
        words = pa.Array.from_buffers(pa.large_string(), len(keys), [None, pa.py_buffer(np.append(0, np.cumsum(size))), pa.py_buffer(data[bpe._gather(begin, size)])])
        sums = [np.bincount(where, weights=n).astype(np.int64), np.bincount(where)]
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(group // n_sources)), source.dictionary.take(pa.array(group % n_sources)), words.cast(pa.string()), *map(pa.array, sums)],
            names=["lang", "source", "term", "n", "n_docs"],
        )


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total (occurrences in the language), by_source (array of source, n; sources without the term left out) of docs (lang, source,
    text, none null)."""
    kind = "lang string, source string, term string, n bigint, n_docs bigint"
    tallies = small_batches(docs.select("lang", "source", "text")).mapInArrow(_tally, kind)
    counts = tallies.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    by_term = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("by_source"))
    return by_term.where(F.col("n_docs") >= least_docs).drop("n_docs")


def _share(n: str | Column, total: str, v: str = "v") -> Column:
    """p of a count within a total."""
    count = (F.col(n) if isinstance(n, str) else n).cast("decimal(20,0)") + 1
    p = F.call_function("div", count * F.lit(SCALE).cast("decimal(10,0)"), (F.col(total) + F.col(v)).cast("decimal(20,0)"))
    return p.cast("bigint") + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class _Groups:
    """The groups of the input: lang, source, n_all (its occurrences of kept terms), v (kept terms of its language), lang_all."""

    def __init__(self, docs: DataFrame, kept: DataFrame) -> None:
        own = kept.select("lang", F.explode("by_source").alias("_x")).groupBy("lang", F.col("_x.source").alias("source")).agg(F.sum("_x.n").alias("n_all"))
        langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_all"))
        zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_all", "v", "lang_all")}
        self.rows, (n,) = park_counted(docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").withColumns(zero))
        self.few = n <= BROADCAST_ROWS

    def renamed(self, **names: str) -> DataFrame:
        out = self.rows.select("lang", *(F.col(old).alias(new) for old, new in names.items()))
        return F.broadcast(out) if self.few else out


def joint_histograms(kept: DataFrame, groups: _Groups) -> DataFrame:
    """lang, a, b, x, y, terms: for each two sources a < b of a language how many kept terms occur x times in a and y times in b, zeros included."""
    patterns = kept.groupBy("lang", "by_source").agg(F.count("*").alias("terms"))
    one = patterns.select("lang", "terms", "by_source", F.posexplode("by_source").alias("_i", "_a"))
    rest = F.slice("by_source", F.col("_i") + 2, F.size("by_source"))
    two = one.select("lang", "terms", "_a", F.explode(rest).alias("_b"))
    met = two.groupBy("lang", F.col("_a.source").alias("a"), F.col("_b.source").alias("b"), F.col("_a.n").alias("x"), F.col("_b.n").alias("y")).agg(F.sum("terms").alias("terms"))

    def cells(df: DataFrame, *told: tuple[Column, Column, Column]) -> DataFrame:
        named = [F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), n.alias("terms")) for x, y, n in told]
        return df.select("lang", "a", "b", F.inline(F.array(*named)))

    x, y, n, none = F.col("x"), F.col("y"), F.col("terms"), F.lit(0)
    both = cells(met, (x, y, n), (x, none, -n), (none, y, -n), (none, none, n))
    alone = one.groupBy("lang", F.col("_a.source").alias("source"), F.col("_a.n").alias("n")).agg(F.sum("terms").alias("terms"))
    beside = alone.join(groups.renamed(source="other"), "lang").where("source <> other").withColumns({"a": F.least("source", "other"), "b": F.greatest("source", "other")})
    first = F.col("source") == F.col("a")
    one_side = cells(beside, (F.when(first, F.col("n")).otherwise(0), F.when(first, 0).otherwise(F.col("n")), n), (none, none, -n))
    pairs = groups.rows.select("lang", F.col("source").alias("a"), "v").join(groups.renamed(source="b"), "lang").where("a < b")
    all_terms = cells(pairs, (none, none, F.col("v")))
    return both.unionByName(one_side).unionByName(all_terms).groupBy("lang", "a", "b", "x", "y").agg(F.sum("terms").alias("terms")).where("terms <> 0")


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.withColumn("rank", F.row_number().over(order))


def source_pairs(kept: DataFrame, groups: _Groups) -> DataFrame:
    """lang, source, item (another source), value, rank."""
    cells = joint_histograms(kept, groups)
    sides = lambda p, q, x, y: F.struct(F.col(p).alias("source"), F.col(q).alias("item"), F.col(x).alias("n"), F.col(y).alias("m"))
    ways = cells.select("lang", "terms", F.inline(F.array(sides("a", "b", "x", "y"), sides("b", "a", "y", "x"))))
    ways = ways.join(groups.renamed(source="source", n_all="p_all", v="v"), ["lang", "source"]).join(groups.renamed(source="item", n_all="q_all"), ["lang", "item"])
    told = ways.select("lang", "source", "item", (_apart(_share("n", "p_all"), _share("m", "q_all")) * F.col("terms")).alias("value"))
    every = groups.rows.select("lang", "source").join(groups.renamed(source="item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    return _ranked(told.unionByName(every).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def source_terms(kept: DataFrame, groups: _Groups, top: int = TOP) -> DataFrame:
    """lang, source, item (a kept term that is more frequent here than in the language), value, rank up to `top`."""
    flat = kept.select("lang", "term", "total", F.explode("by_source").alias("_x")).select("lang", F.col("term").alias("item"), "total", F.col("_x.source").alias("source"), F.col("_x.n").alias("n"))
    told = flat.join(groups.renamed(source="source", n_all="p_all", lang_all="q_all", v="v"), ["lang", "source"])
    told = told.select("lang", "source", "item", _share("n", "p_all").alias("p"), _share("total", "q_all").alias("q")).where("p > q")
    return _ranked(told.select("lang", "source", "item", _apart(F.col("p"), F.col("q")).alias("value"))).where(F.col("rank") <= top)


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: of each source the divergence from every other source of its language (part 'pair'), and its `top`
    terms by what they add to the divergence from the language (part 'term')."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(said("lang"), said("source"), said("text"))
    kept = park(kept_terms(docs, least_docs))
    groups = _Groups(docs, kept)
    parts = source_pairs(kept, groups).withColumn("part", F.lit("pair")), source_terms(kept, groups, top).withColumn("part", F.lit("term"))
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 3
), groups AS (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS lang_all FROM kept GROUP BY lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) + l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (l.lang_all + l.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), told AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM told
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
