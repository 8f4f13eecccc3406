"""A versioned table of parquet files: atomic merge, update, delete, append and overwrite without a table format's jar.

Layout: ``path/data/<attempt>/`` holds the files that one attempt to write made, ``path/_versions/<n>.json`` lists the files of
version n with the partition of each, and the highest readable one is current.  Every attempt has a folder of its own, so that
two writers never touch each other's files.  A version is claimed by creating its file, which fails if it is there: of two
writers from one version one wins, the other gets an error and may try again.  What a lost attempt wrote is never read.

A change rewrites only the files that hold rows it touches; an append rewrites none.  Reads, updates and deletes skip the
files of other partitions.  Paths go through Hadoop's file system, so a shared store works as a local disk does.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Table:
    """One table.  keys: its unique key; partition: an optional column by which files are laid out."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], partition: str | None = None, protected: tuple[str, ...] = (), event_time: str | None = None) -> None:
        if not keys:
            raise ValueError("a table needs a key")
        self.spark, self.path, self.keys, self.partition, self.protected, self.event_time = spark, path.rstrip("/"), keys, partition, protected, event_time

    def _fs(self) -> tuple[JavaObject, JavaObject]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), jvm

    def _manifest(self) -> tuple[int, int, dict]:
        """The highest number taken, the current version (the highest that can be read) and its manifest."""
        fs, jvm = self._fs()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)
        for n in numbers:
            text = self.spark.read.text(f"{self.path}/_versions/{n}.json", wholetext=True).first()
            try:
                return numbers[0], n, json.loads(text[0])
            except (TypeError, ValueError):  # claimed, but its writer hasn't finished or was lost
                continue
        return (numbers or [0])[0], 0, {"schema": None, "files": {}}

    @property
    def version(self) -> int:
        return self._manifest()[1]

    def exists(self) -> bool:
        return self.version > 0

    def read(self, empty: T.StructType | None = None, partitions: set[str] | None = None) -> DataFrame:
        """The current rows, of all or of some partitions; a table that isn't there is empty with the schema given."""
        _, version, manifest = self._manifest()
        if not version:
            if empty is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], empty)
        return self._rows(manifest, self._files(manifest, partitions))

    def _files(self, manifest: dict, partitions: set[str] | None) -> list[str]:
        return [f for f, p in manifest["files"].items() if partitions is None or p in partitions]

    def _rows(self, manifest: dict, files: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in files]) if files else self.spark.createDataFrame([], schema)

    def _part(self) -> Column:
        return F.lit("all") if self.partition is None else F.regexp_replace(F.coalesce(F.col(self.partition).cast("string"), F.lit("null")), r"[^A-Za-z0-9._-]", "_")

    def _commit(self, rows: DataFrame, keep: dict[str, str], base: int) -> int:
        """Write rows beside the files kept.  Rows of one partition are spread over as many tasks as their size asks for."""
        attempt = uuid.uuid4().hex
        out = rows.withColumn("__part", self._part())
        if self.partition is not None:
            out = out.hint("rebalance", F.col("__part"))
        out.write.partitionBy("__part").parquet(f"{self.path}/data/{attempt}")
        fs, jvm = self._fs()
        P = jvm.org.apache.hadoop.fs.Path
        files = dict(keep)
        for folder in fs.listStatus(P(f"{self.path}/data/{attempt}")):
            name = folder.getPath().getName()
            if name.startswith("__part="):
                files |= {f"{attempt}/{name}/{f.getPath().getName()}": name[7:] for f in fs.listStatus(folder.getPath())}
        taken, current, _ = self._manifest()
        if current != base:
            raise RuntimeError(f"another writer made version {current}")
        new = taken + 1
        fs.mkdirs(P(f"{self.path}/_versions"))
        try:
            stream = fs.create(P(f"{self.path}/_versions/{new}.json"), False)  # fails if it is there
        except Py4JJavaError as e:
            raise RuntimeError(f"another writer made version {new}") from e
        stream.write(bytearray(json.dumps({"schema": rows.schema.jsonValue(), "files": files}).encode()))
        stream.close()
        return new

    def overwrite(self, rows: DataFrame) -> int:
        return self._commit(rows, {}, self.version)

    def append(self, rows: DataFrame) -> int:
        """The rows added without regard to keys; no file is rewritten."""
        _, version, manifest = self._manifest()
        if not version:
            return self._commit(rows, {}, 0)
        return self._commit(rows.select(*self._columns(manifest)), manifest["files"], version)

    def _columns(self, manifest: dict) -> list[str]:
        return [f["name"] for f in manifest["schema"]["fields"]]

    def _same(self, left: str, right: str) -> Column:
        return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in self.keys])

    def _touched(self, manifest: dict, source: DataFrame) -> list[str]:
        """The files that hold a key of the source; with a partition in the source, only its own are looked through."""
        partitions = None
        if self.partition is not None and self.partition in source.columns:
            partitions = {r[0] for r in source.select(self._part().alias("p")).distinct().collect()}  # as many as the layout has
        files = self._files(manifest, partitions)
        if not files:
            return []
        at = F.regexp_extract("_metadata.file_path", r"([0-9a-f]{32}/__part=[^/]*/[^/]*)$", 1)
        rows = self._rows(manifest, files).select(*self.keys, F.url_decode(at).alias("__file")).alias("t")
        hit = rows.join(source.select(*self.keys).alias("s"), self._same("t", "s"), "left_semi").select("__file").distinct()
        return [r[0] for r in hit.collect()]  # names of files

    def merge(self, source: DataFrame) -> int:
        """Update the rows with the source's keys (compared null-safe), insert the others.

        The source must have each key once.  Protected columns and ``created_timestamp`` stay as they are in the table, and a
        source row with an older event time than the table's leaves it as it is.  With a partition, a key stays in its own.
        """
        if not source.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError("the source has a key more than once")
        _, version, manifest = self._manifest()
        if not version:
            return self._commit(source, {}, 0)
        touched = self._touched(manifest, source)
        columns = self._columns(manifest)
        t = self._rows(manifest, touched).withColumn("__there", F.lit(True)).alias("t")
        there, given = F.coalesce(F.col("t.__there"), F.lit(False)), F.col("s.__given")
        s = source.withColumn("__given", F.lit(True)).alias("s")
        both = s.join(t, self._same("s", "t"), "full")
        newer = F.lit(True) if self.event_time is None else F.coalesce(F.col(f"s.{self.event_time}") >= F.col(f"t.{self.event_time}"), F.lit(True))
        take = F.coalesce(given, F.lit(False)) & (~there | newer)
        out = []
        for c in columns:
            if c not in source.columns:
                out.append(F.col(f"t.{c}").alias(c))
            elif c in self.protected or c == "created_timestamp":
                out.append(F.when(take & ~there, F.col(f"s.{c}")).when(there, F.coalesce(F.col(f"t.{c}"), F.when(take, F.col(f"s.{c}")))).alias(c))
            else:
                out.append(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        return self._commit(both.select(*out), self._kept(manifest, touched), version)

    def _kept(self, manifest: dict, touched: list[str]) -> dict[str, str]:
        gone = set(touched)
        return {f: p for f, p in manifest["files"].items() if f not in gone}

    def update_columns(self, source: DataFrame, columns: list[str]) -> int:
        """Set these columns of the rows that the source has by key; no row is added."""
        _, version, manifest = self._manifest()
        if not version:
            raise FileNotFoundError(self.path)
        touched = self._touched(manifest, source)
        if not touched:
            return version
        new = source.select(*self.keys, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit")).alias("s")
        rows = self._rows(manifest, touched).alias("t").join(new, self._same("t", "s"), "left")
        out = [F.when(F.col("s.__hit"), F.col(f"s.__{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in columns else F.col(f"t.{c}") for c in self._columns(manifest)]
        return self._commit(rows.select(*out), self._kept(manifest, touched), version)

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows with these keys."""
        _, version, manifest = self._manifest()
        touched = self._touched(manifest, keys) if version else []
        if not touched:
            return version
        rows = self._rows(manifest, touched).alias("t").join(keys.select(*self.keys).alias("s"), self._same("t", "s"), "left_anti")
        return self._commit(rows, self._kept(manifest, touched), version)

    def register(self, name: str) -> None:
        """The current rows as a temporary view."""
        self.read().createOrReplaceTempView(name)


def read_partitions(spark: SparkSession, path: str, by: str, first: str, last: str) -> DataFrame:
    """The partitions of a folder ``path/by=value`` from first to last; the others' files are not read."""
    return spark.read.parquet(path).where(F.col(by).cast("string").between(first, last))


def commented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The columns with a comment in their metadata, such as ``PII Level 1``."""
    for c, text in comments.items():
        if c in df.columns:
            df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def audited(df: DataFrame, source_system: str, batch_id: str, now: Column) -> DataFrame:
    """The audit block of a load."""
    return df.withColumns({"source_system": F.lit(source_system), "batch_id": F.lit(batch_id), "created_timestamp": now, "updated_timestamp": now})


def write_partitioned(df: DataFrame, path: str, by: str = "ingest_date") -> None:
    """Parquet by day; a repeated load replaces its own days only."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
