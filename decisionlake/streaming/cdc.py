"""Change feeds and event feeds as streams: latest state by merge, deletes with tombstones, duplicates dropped, marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from decisionlake.operators.conform import envelope, latest_per_key
from decisionlake.sources.tables import Table


def apply_changes(batch: DataFrame, table: Table, key: str, order: str) -> None:
    """Merge a batch of flattened changes; a delete stays as a tombstone with its number, so that late changes can't revive it.

    The table has the column ``is_deleted``; an older number never overwrites a newer one (the table's event time is the order).
    """
    flat = batch.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    latest = latest_per_key(flat, [key], [order])
    if not latest.isEmpty():
        table.merge(latest)


def current(table: Table) -> DataFrame:
    """The live rows."""
    return table.read().where("NOT is_deleted").drop("is_deleted")


def changes(stream: DataFrame) -> DataFrame:
    """A change stream flattened, with ``is_deleted``."""
    return envelope(stream).withColumn("is_deleted", F.coalesce(F.lower("__op") == "d", F.lit(False))).drop("__op")


def follow_changes(spark: SparkSession, path: str, schema: T.StructType, table: Table, key: str, order: str, checkpoint: str, per_batch: int = 100) -> StreamingQuery:
    """Apply all change files that are there and not yet applied, then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", "true").parquet(path)
    writer = changes(stream).writeStream.foreachBatch(lambda df, _: apply_changes(df, table, key, order)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def once_within(stream: DataFrame, identifier: str, time: str, late: str = "1 day") -> DataFrame:
    """Events once per identifier, repeats within the lateness dropped; the state forgets what is older."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([identifier])


def follow_files(spark: SparkSession, path: str, schema: T.StructType, sink: str, checkpoint: str, keep: Column | None = None, day: str = "ingest_date", flush: str | None = None) -> StreamingQuery:
    """An incremental file scan: new parquet files to a sink by batch and day, bad rows to ``sink/_rejected``.

    Every batch has a folder of its own that a retry overwrites, so that nothing comes twice.  flush: how often to look for
    files (such as ``15 minutes``); without it, what is there is taken and the query ends.
    """
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def land(df: DataFrame, batch: int) -> None:
        good = df if keep is None else df.where(F.coalesce(keep, F.lit(False)))
        good.write.mode("overwrite").partitionBy(day).parquet(f"{sink}/batch={batch}")
        if keep is not None:
            df.where(~F.coalesce(keep, F.lit(False))).write.mode("overwrite").parquet(f"{sink}/_rejected/batch={batch}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if flush is None else writer.trigger(processingTime=flush)).start()


def broker_changes(spark: SparkSession, servers: str, topic: str, schema: T.StructType, starting: str = "earliest", **options: str) -> DataFrame:
    """A change stream from a message broker whose values are JSON envelopes ``before, after, op, ts_ms``; needs Spark's Kafka source.

    Messages that aren't an envelope, such as the empty ones after deletes, are left out.
    """
    raw = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting} | options).load()
    return envelopes(raw.select(F.col("value").cast("string").alias("value")), schema)


def envelopes(values: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON texts ``value`` as envelopes of records of the schema, with or without the broker's ``payload`` around them."""
    envelope_ = T.StructType([T.StructField("before", schema), T.StructField("after", schema), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    body = F.coalesce(F.get_json_object("value", "$.payload"), F.col("value"))
    return values.select(F.from_json(body, envelope_).alias("e")).where("e.op IS NOT NULL").select("e.*")
