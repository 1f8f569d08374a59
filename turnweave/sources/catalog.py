"""Record collections on disk: sources, regions, turns, voices and evidence, as Parquet; and JSON lines."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from turnweave.sources.scratch import settled

REGION_SCHEMA = "id string, source_id string, source_start double, source_end double, detector string, detector_label string"


class Conflict(Exception):
    """Another writer has committed since the state that a change was made from."""


class Catalog:
    """Tables under one root folder, changed by commits that take effect whole or not at all.

    Rows lie in part folders that Spark has finished; a commit is a small file _commits/NUMBER.json that names the parts of every table. It is made by creating that
    file, which fails if it is there: of two writers who started from one state the second is refused (`Conflict`), whatever tables they changed, and a writer who dies
    before that leaves folders that nothing refers to. Readers take the newest whole commit file. Ids are unique: an append whose ids are there already, or
    twice in the batch, is refused, as are updates of ids that are missing or named twice. (Creating a file exclusively is what HDFS and local file systems do;
    a store without it needs a lock of its own.)

    A table's version grows when its rows are replaced; an append belongs to the version that it adds to.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str) -> tuple[Any, Any]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _numbers(self) -> list[int]:
        fs, where = self._path("_commits")
        names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _commit_file(self, number: int) -> dict | None:
        """What a commit says; None if its writer died while writing it."""
        fs, where = self._path(f"_commits/{number:010d}.json")
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def head(self) -> tuple[int, dict]:
        """The newest commit's number, 0 before the first, and its tables: for each its version and parts."""
        for number in reversed(self._numbers()):
            said = self._commit_file(number)
            if said is not None:
                return number, said
        return 0, {}

    def versions(self, table: str) -> list[int]:
        """Versions of a table, oldest first."""
        said = (self._commit_file(n) for n in self._numbers())
        return sorted({x[table]["version"] for x in said if x and table in x})

    def _tables_at(self, table: str, version: int) -> dict:
        for number in reversed(self._numbers()):
            said = self._commit_file(number)
            if said and said.get(table, {}).get("version") == version:
                return said
        raise KeyError(f"no version {version} of {table}")

    def read(self, table: str, version: int | None = None, schema: str | None = None, at: dict | None = None) -> DataFrame:
        """The table as the newest commit has it, or at the end of a version, or as of the tables of a `head`. A table that isn't there is empty if a schema
        is given, else an error."""
        now = at if at is not None else self.head()[1] if version is None else self._tables_at(table, version)
        if table not in now:
            if schema:
                return self.spark.createDataFrame([], schema)
            raise KeyError(f"no table {table}")
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*(f"{self.root}/{table}/{part}" for part in now[table]["parts"]))

    def commit(self, replaced: dict[str, DataFrame] | None = None, added: dict[str, DataFrame] | None = None, base: tuple[int, dict] | None = None) -> int:
        """Replaces whole tables and adds rows to others in one step, and returns the commit's number. `base` is the head that the change was made from; if
        another commit is there by now, nothing is changed (`Conflict`)."""
        number, tables = base if base is not None else self.head()
        made = {}
        for change in (replaced or {}, added or {}):
            for table, rows in change.items():
                part = f"part-{uuid.uuid4().hex}"
                rows.write.parquet(f"{self.root}/{table}/{part}")
                old = made.get(table, tables.get(table))
                made[table] = {"version": old["version"] if old else 1, "parts": [*old["parts"], part] if old else [part]} if change is added else {"version": old["version"] + 1 if old else 1, "parts": [part]}
        if self.head()[0] != number:
            raise Conflict(f"commit {number} is not the newest")
        after = max([number, *self._numbers()]) + 1
        fs, where = self._path(f"_commits/{after:010d}.json")
        try:
            stream = fs.create(where, False)
        except Py4JJavaError as error:
            raise Conflict(f"commit {after} is there already") from error
        try:
            stream.write(bytearray(json.dumps({**tables, **made}).encode()))
        finally:
            stream.close()
        return after

    def append(self, table: str, rows: DataFrame, key: str | None = None) -> None:
        """Adds rows. With `key`, refuses ids that the batch has twice or not at all, or that the table has. Without, it doesn't matter what others add meanwhile."""
        base = self.head()
        if key:
            bad = key_clashes(rows, key, self.read(table, at=base[1]).select(key) if table in base[1] else None).first()
            if bad:
                raise ValueError(f"{table}: {bad['reason']}: {bad[key]}")
            self.commit(added={table: rows}, base=base)
            return
        for _ in range(100):
            try:
                self.commit(added={table: rows}, base=base)
                return
            except Conflict:
                base = self.head()
        raise Conflict(f"{table}: others kept committing")

    def replace(self, table: str, rows: DataFrame, base: tuple[int, dict] | None = None) -> int:
        """Makes `rows` the table, whole, and returns its new version. `rows` may come from the table itself."""
        base = base or self.head()
        self.commit({table: rows}, base=base)
        return base[1].get(table, {"version": 0})["version"] + 1

    def update(self, table: str, changes: DataFrame, key: str = "id") -> int:
        """Replaces the columns of `changes` in the rows that its keys name, nulls included."""
        base = self.head()
        now = self.read(table, at=base[1])
        first = update_clashes(now, changes, key).first()
        if first:
            raise (KeyError if first["reason"] == "missing" else ValueError)(f"{table}: {first['reason']}: {first[key]}")
        return self.replace(table, changed(now, changes, key), base)

    def attach(self, table: str, rows: DataFrame, key: list[str]) -> DataFrame:
        """Write-once evidence: adds rows under new keys in one commit and returns the keys with the action, as `import_plan` says. Where a key is there with an
        equal record nothing is added; if one is there with another, or comes twice with different ones, all is refused."""
        base = self.head()
        if table not in base[1]:
            held = self.spark.createDataFrame([], rows.schema)
        else:
            held = self.read(table, at=base[1])
        plan = settled(import_plan(held, rows, key, [c for c in rows.columns if c not in key]))
        clash = plan.where("action = 'conflict'").first()
        if clash:
            raise ValueError(f"{table}: there already, and different: {[clash[k] for k in key]}")
        fresh = plan.where("action = 'insert'").select(*(F.col(k).alias(f"_{k}") for k in key))
        if not fresh.isEmpty():
            new = rows.dropDuplicates(key).join(fresh, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left_semi")
            self.commit(added={table: new}, base=base)
        return plan

    def get(self, table: str, record_id: object, key: str = "id") -> Row | None:
        """The row with this id, None if there is none; two are an error."""
        found = self.read(table).where(F.col(key) == F.lit(record_id)).limit(2).collect()
        if len(found) > 1:
            raise ValueError(f"{table}: several rows with {key} {record_id}")
        return found[0] if found else None

    def datasets(self, table: str) -> DataFrame:
        """The table in all datasets beside this one, this one included, with a column `dataset`, the folder's name."""
        parent = self.root.rsplit("/", 1)[0]
        fs, where = Catalog(self.spark, parent)._path("")
        parts = []
        for name in sorted(x.getPath().getName() for x in fs.listStatus(where) if x.isDirectory()):
            one = Catalog(self.spark, f"{parent}/{name}")
            if table in one.head()[1]:
                parts.append(one.read(table).withColumn("dataset", F.lit(name)))
        if not parts:
            raise KeyError(f"no dataset has a table {table}")
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out


def key_clashes(rows: DataFrame, key: str, existing: DataFrame | None = None) -> DataFrame:
    """(key, reason) of what keeps rows from being inserted: 'no id', 'repeated', 'exists'."""
    batch = rows.groupBy(key).agg(F.count("*").alias("_n"))
    bad = batch.select(key, F.when(F.col(key).isNull(), "no id").when(F.col("_n") > 1, "repeated").alias("reason")).where("reason is not null")
    if existing is None:
        return bad
    return bad.union(batch.join(existing.select(key), key, "left_semi").select(key, F.lit("exists").alias("reason")))


def update_clashes(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """(key, reason) of what keeps changes from being applied: 'missing', 'repeated', 'ambiguous' (several rows have the id)."""
    wanted = changes.groupBy(key).agg(F.count("*").alias("_n"))
    held = table.join(wanted.select(key), key, "left_semi").groupBy(key).agg(F.count("*").alias("_m"))
    both = wanted.join(held, key, "left")
    reason = F.when(F.col("_n") > 1, "repeated").when(F.col("_m").isNull(), "missing").when(F.col("_m") > 1, "ambiguous")
    return both.select(key, reason.alias("reason")).where("reason is not null")


def changed(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """`table` with the columns of `changes` (one row a key) in place of its own where a key is named."""
    new = [c for c in changes.columns if c != key]
    side = changes.select(F.col(key), F.struct(*new).alias("_new"))
    out = table.join(side, key, "left")
    return out.select(*(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in table.columns))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): records of the schema, and the lines that are none, with their file. Blank lines are neither.
    `bad_json_lines` gives their numbers too."""
    text = spark.read.text(path).where("trim(value) <> ''")
    rows = text.select("value", F.col("_metadata.file_path").alias("file"), F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    wrong = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return rows.where(~wrong).select("r.*").drop("_corrupt"), rows.where(wrong).select("file", F.col("value").alias("_corrupt"))


def line_numbers(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value: all lines of text files with their numbers. The reader's parts of a file are numbered within, and each part gets the count
    of the parts of its file before it."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value")
    within = Window.partitionBy("file", "_block").orderBy("_at")
    counts = text.groupBy("file", "_block").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return text.withColumn("_in", F.row_number().over(within)).join(before, ["file", "_block"]).select("file", (F.col("_before") + F.col("_in")).alias("line"), "value")


def bad_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file, line, _corrupt: the lines of JSON files that are no records of the schema, with their numbers."""
    said = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = line_numbers(spark, path).where("trim(value) <> ''").withColumn("_r", said)
    return rows.where(F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()).select("file", "line", F.col("value").alias("_corrupt"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def canonical(value: Column) -> Column:
    """A map<string, string> as JSON with sorted keys, so equal maps give equal texts; null stays null."""
    return F.when(value.isNotNull(), F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value)))))


def import_plan(existing: DataFrame, incoming: DataFrame, key: list[str], payload: list[str]) -> DataFrame:
    """Incoming rows with action: 'insert' for a new key, 'skip' for an equal record, 'conflict' for another one under the same
    key. Nulls equal nulls. A key that comes twice with different records is a conflict as well."""
    mark = lambda df, name: df.select(*key, F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256).alias(name))
    old = mark(existing, "_old").groupBy(*key).agg(F.min("_old").alias("_old"), F.max("_old").alias("_old2"))
    new = mark(incoming, "_new").groupBy(*key).agg(F.min("_new").alias("_new"), F.max("_new").alias("_new2"))
    both = new.alias("n").join(old.alias("o"), [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in key], "left")
    clash = (F.col("_new") != F.col("_new2")) | (F.col("_old") != F.col("_new")) | (F.col("_old2") != F.col("_new"))
    action = F.when(F.coalesce(clash, F.col("_new") != F.col("_new2")), "conflict").when(F.col("_old").isNull(), "insert").otherwise("skip")
    return both.select(*(F.col(f"n.{c}") for c in key), action.alias("action"))


REGION_IDENTITY = ["source_id", "detector", "detector_model", "detector_revision", "detector_parameters", "source_start", "source_end", "detector_label"]


def new_regions(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming regions whose identity (source, detector with model, revision and canonical parameters, range, label; nulls equal nulls)
    neither the table nor an earlier row of the batch has, one row each."""
    ident = lambda df: df.withColumn("detector_parameters", canonical(F.col("detector_parameters")))
    new, old = ident(incoming).dropDuplicates(REGION_IDENTITY), ident(existing).select(*REGION_IDENTITY).distinct()
    return new.alias("n").join(old.alias("o"), [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in REGION_IDENTITY], "left_anti")


def attach_by_name(existing: DataFrame, incoming: DataFrame, record: str, name: str) -> DataFrame:
    """Incoming hypotheses with action: 'insert', or 'skip' where the record has one of this name already, whatever it says."""
    have = existing.select(record, name).distinct().withColumn("_have", F.lit(True))
    return incoming.join(have, [record, name], "left").withColumn("action", F.when(F.col("_have"), "skip").otherwise("insert")).drop("_have")


def unknown_references(rows: DataFrame, column: str, table: DataFrame, key: str = "id") -> DataFrame:
    """The values of `column` that no row of `table` has as its key, each once; a null is unknown as well."""
    return rows.select(F.col(column)).distinct().join(table.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def largest_number(rows: DataFrame, column: str, prefix: str) -> Column:
    return F.coalesce(F.max(F.expr(f"try_cast(regexp_extract({column}, '^{prefix}-([0-9]+)$', 1) as bigint)")), F.lit(0))


def next_ids(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """One row: the largest number after `prefix` in ids like prefix-000123, and the id that follows; ids of another shape say nothing."""
    top = rows.agg(largest_number(rows, column, prefix).alias("largest"))
    return top.withColumn("next_id", padded(prefix, F.col("largest") + 1))


def padded(prefix: str, number: Column, width: int = 6) -> Column:
    """prefix-000123; a longer number is not cut."""
    text = number.cast("string")
    return F.concat(F.lit(f"{prefix}-"), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def with_new_ids(rows: DataFrame, existing: DataFrame, prefix: str, order: list[str], column: str = "id") -> DataFrame:
    """`rows` with ids that follow the largest of `existing`, in the order given, without gaps. Rows are ranged by `order` over the
    partitions and numbered within them; what is carried from partition to partition is one count each. The ranges come from a sample, another one each time, so rows
    are stored with their numbers before they are counted."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = settled(ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order))))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    top = existing.agg(largest_number(existing, column, prefix).alias("_top"))
    numbered = ranged.join(F.broadcast(before), "_part").join(F.broadcast(top))  # a row for each partition, and one row
    return numbered.withColumn(column, padded(prefix, F.col("_top") + F.col("_before") + F.col("_in"))).drop("_part", "_in", "_before", "_top")
