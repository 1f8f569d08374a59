"""Cutting lineage and joining links into components, in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def shared_dir(df: DataFrame) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset and Spark is local, as in tests, one under /tmp/checkpoints; on
    a cluster a folder of one machine would lose the other machines' parts, so there it is an error."""
    spark = df.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.conf.get("spark.master", "")
    if not named and not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (named or "file:///tmp/checkpoints").rstrip("/")


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, after its session's Arrow batches were bounded to 4 MB where they had Spark's own bound of 64 MB: several tasks hold a
    few batches each, in the JVM and in Python, and texts are long. It changes memory, not results."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, "64MB") in ("64MB", "67108864b", "67108864"):
        conf.set(name, "4MB")
    return df


def park(df: DataFrame) -> DataFrame:
    """Writes `df` as a Parquet table in the shared folder and reads it back: later steps start from files that survive
    the loss of any executor."""
    path = f"{shared_dir(df)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def park_counted(df: DataFrame, *more: Column) -> tuple[DataFrame, tuple]:
    """`park`, and what is observed while writing: the number of rows, and `more` aggregates."""
    seen = Observation()
    table = park(df.observe(seen, F.count(F.lit(1)).alias("n"), *(c.alias(f"m{k}") for k, c in enumerate(more))))
    return table, (seen.get["n"], *(seen.get[f"m{k}"] for k in range(len(more))))


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a bigint, b bigint): a row (node, root) for each node but the roots; root is the
    smallest node of its component. Alternating large-star and small-star steps; each step's edges are written to the shared
    folder, and only their count and checksum reach the driver."""
    check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges, state = park_counted(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), check)
    seen = None
    while state[0] and state != seen:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        seen = state
        edges, state = park_counted(small.where("u <> v").distinct(), check)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def followed(pointers: DataFrame) -> DataFrame:
    """(node, root) of pointers (node, root), one a node and without circles: each followed to its end, the distance doubling in every
    step."""
    now = pointers
    while True:
        beyond = now.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        now, (_, moved) = park_counted(now.join(beyond, "root", "left").select("node", F.coalesce("_next", "root").alias("root"), "_next"), F.count("_next"))
        now = now.drop("_next")
        if not moved:
            return now


def joined_roots(found: DataFrame | None, more: DataFrame) -> DataFrame:
    """Components (node, root) known before and those of their roots (node, root) as one table."""
    if found is None:
        return more
    moved = found.join(more.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left")
    return park(moved.select("node", F.coalesce("_new", "root").alias("root")).union(more.select("node", "root")))
