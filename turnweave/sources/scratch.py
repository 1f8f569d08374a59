"""Cutting lineage: tables that a longer computation has finished; and how tables are joined whose size Spark can't tell."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame) -> DataFrame:
    """`df` for joins that deal it out by their keys. Spark guesses the size of exploded rows by that of the rows or packed files they came from, which can be a thousandth
    of it, and would send through the driver what it holds for small; and of every table that it sends, however small, the driver keeps 30 MB."""
    return df.hint("merge")


def settled(df: DataFrame) -> DataFrame:
    """`df`, worked out once and written by `checkpoint()` to the folder that the cluster names in spark.checkpoint.dir, so that it survives the loss of
    executors. Where none is named and Spark is local, as in tests, one is set; on a cluster that is an error, for a folder of one machine
    would lose the others' parts."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named, master = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.master", "")
        if not named and not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or "file:///tmp/checkpoints")
    return dealt(df.checkpoint(eager=True))
