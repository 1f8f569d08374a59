"""Records that hang together or exclude each other: connected components, and choices in order, by rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.sources.scratch import settled


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, root) of all ids that links (a, b) name: root is the smallest id that links lead to. Each round hangs every node's larger neighbours on its smallest one,
    then its smaller ones on the smallest of them, until nothing moves; the number of rounds grows with the logarithm of the longest chain. Nulls link nothing."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    names = settled(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct())
    edges = settled(pairs.where("u <> v").distinct())
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state, seen = mark(edges), None
    while state != seen:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = settled(down.where("u <> v").distinct())
        state, seen = mark(edges), state
    return names.join(edges.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def chosen_in_order(wants: DataFrame, request: str, thing: str, order: list[str]) -> DataFrame:
    """request, taken: requests want things (one row a request and thing, `order` the same in all rows of a request). In order, a request gets all its things, or, if one of them has
    gone to an earlier request, none.

    A round decides every request that comes first at all its undecided things, and those that want a thing that is gone; who comes first at a thing is a minimum by
    thing, so a thing that very many want is one row of an aggregate and no pairs. Rounds go on until all is decided, as many as the longest chain of
    requests each of which waits for the one before. Requests without things get nothing to hold and are taken."""
    rows = settled(wants.select(request, F.col(thing).alias("_t"), F.struct(*order, request).alias("_o")))
    open_, done = rows, None
    while not open_.isEmpty():
        first = open_.where("_t is not null").groupBy("_t").agg(F.min("_o").alias("_first"))
        marked = open_.join(first, "_t", "left").groupBy(request).agg(F.bool_and(F.coalesce(F.col("_first") == F.col("_o"), F.lit(True))).alias("_mine"))
        won = settled(marked.where("_mine").select(request))
        gone = open_.join(won, request, "left_semi").where("_t is not null").select("_t").distinct()
        rest = open_.join(won, request, "left_anti")
        lost = settled(rest.join(gone, "_t", "left_semi").select(request).distinct())
        now = won.withColumn("taken", F.lit(True)).union(lost.withColumn("taken", F.lit(False)))
        done = now if done is None else done.union(now)
        open_ = settled(rest.join(lost, request, "left_anti"))
    return done if done is not None else rows.select(request, F.lit(True).alias("taken")).distinct()
