"""Running streams over files: read, drain to a table, ingest into the raw zone."""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shelfspark import schema
from shelfspark.operators.clean import dedup
from shelfspark.session import exists, run_folder

#: Days before the newest date within which a key that comes again is known from the stream's state.
OPEN_DAYS = 62


def file_stream(spark: SparkSession, folder: str, name: str, table_schema, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files of one name pattern as a stream; a micro-batch takes a bounded number of files."""
    return (
        spark.readStream.schema(table_schema)
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


class LateRows(StreamingQueryListener):
    """Adds up the rows that the stateful operators of each stream drop because they came after the watermark.

    A query keeps only its last progress records; a listener sees all of them.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        name = str(event.progress.id)
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[name] = self.dropped.get(name, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.id)].set()

    def of(self, query, patience: float = 60.0) -> int:
        """The count of an ended query, once its last event has arrived."""
        self.ended[str(query.id)].wait(patience)
        return self.dropped.get(str(query.id), 0)


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Process everything that is there, then return the written table.

    Output, checkpoint and the number of rows that came too late live in the shared folder, so a lost executor or driver
    resumes where the log ends.
    """
    return drained(stream, name)[0]


def drained(stream: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """As ``drain``, with the one-row table (``late_rows``) that is written next to the output."""
    spark = stream.sparkSession
    folder = run_folder(spark, name)
    late = LateRows()
    spark.streams.addListener(late)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{folder}/rows")
            .option("checkpointLocation", f"{folder}/state")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        counted = spark.range(1).select(F.lit(late.of(query)).cast("long").alias("late_rows"))
    finally:
        spark.streams.removeListener(late)
    counted.write.mode("append").parquet(f"{folder}/late")
    written = spark.read.schema("late_rows long").parquet(f"{folder}/late").agg(F.sum("late_rows").alias("late_rows"))
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows"), written


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB on the executors' disks, with changelog checkpoints.

    A query takes these settings into its checkpoint, so they are put back once it has started.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest(
    stream: DataFrame, zone: str, state: str, keys: Sequence[str] = tuple(schema.SALES_KEY), event: str = "date", open_days: int = OPEN_DAYS
) -> list[dict]:
    """Write the rows of each micro-batch whose key the zone does not hold yet, and a profile of the batch.

    Keys of the last ``open_days`` before the newest date are known from the stream's state: one entry per key, dropped
    when its day closes. Such a micro-batch reads its own rows and no stored ones. Rows older than that, which the state
    no longer knows, are taken in a second pass over the same files and compared with the stored months they touch, so
    nothing is too late. ``open_days`` should span the days over which facts usually come in; a bulk load in no order of
    time is better done by ``stage_upload``, or with a span that covers it.

    Of equal keys the row of the earliest micro-batch stays, in one batch the smallest. A replayed batch overwrites its
    own folder with the same rows. Returns the progress records of the first pass.
    """
    progress = _ingest_open(stream, zone, f"{state}/open", keys, event, open_days)
    _ingest_old(stream, zone, f"{state}/old", keys, event, open_days)
    return progress


def _write_batch(fresh: DataFrame, zone: str, part: str, number: int, event: str) -> DataFrame:
    """Rows by part of the job, batch and month; returns what was written."""
    path = f"{zone}/rows/part={part}/batch={number}"
    fresh.withColumn("month", F.date_format(event, "yyyy-MM")).write.mode("overwrite").partitionBy("month").parquet(path)
    if not exists(fresh.sparkSession, path):
        return fresh.limit(0)
    return fresh.sparkSession.read.schema(fresh.schema).parquet(path)


def _write_profile(rows: DataFrame, written: DataFrame, zone: str, part: str, number: int, event: str) -> None:
    seen = rows.agg(
        F.count("*").alias("rows"), F.min(event).alias("min_date"), F.max(event).alias("max_date"),
        F.sum("units").alias("units"), F.count_if(F.col("units").isNull()).alias("missing_units"),
    )
    new = {"new_rows": written.agg(F.count("*")).scalar(), "newest": written.agg(F.max(event)).scalar()}
    seen.withColumns(new).write.mode("overwrite").parquet(f"{zone}/profile/part={part}/batch={number}")


def _ingest_open(stream: DataFrame, zone: str, state: str, keys: Sequence[str], event: str, open_days: int) -> list[dict]:
    """First rows of keys, by a running aggregate per key whose state closes with the watermark."""
    spark = stream.sparkSession
    columns = stream.columns
    rest = [c for c in columns if c not in keys]
    # all rows of a micro-batch have one time, which its log keeps for a replay
    timed = stream.withColumns({"_day": F.col(event).cast("timestamp"), "_at": F.current_timestamp()})
    others = [k for k in keys if k != event]
    first = timed.withWatermark("_day", f"{open_days} days").groupBy("_day", *others).agg(
        F.min(F.struct("_at", *rest)).alias("_first"), F.max("_at").alias("_last")
    )

    def write(batch: DataFrame, number: int) -> None:
        values = {event: F.col("_day").cast("date")} | {c: F.col(f"_first.{c}") for c in rest}
        # a key that came before is updated too, but not first seen in this batch
        fresh = batch.where(F.col("_first._at") == F.col("_last")).select(*[values.get(c, F.col(c)).alias(c) for c in columns])
        written = _write_batch(fresh, zone, "open", number, event)
        # raw rows are counted in the second pass
        _write_profile(written.limit(0), written, zone, "open", number, event)

    with keyed_state(spark):
        query = (
            first.writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def _ingest_old(stream: DataFrame, zone: str, state: str, keys: Sequence[str], event: str, open_days: int) -> None:
    """Rows of closed days that the zone does not hold; profiles of the raw batches."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # the newest day of all was new when it came, so the first pass has written it
        newest = spark.read.parquet(f"{zone}/profile/part=open").agg(F.max("newest").alias("d")).first().d if exists(spark, f"{zone}/profile/part=open") else None
        # one day more than the state lets go: what both passes see is found in the zone
        closed = batch.where(F.col(event) <= F.date_sub(F.lit(newest), open_days)) if newest else batch.limit(0)
        old = dedup(closed, [c for c in batch.columns if c not in keys], keys)
        months = closed.select(F.date_format(event, "yyyy-MM").alias("month")).distinct().persist()
        if not months.isEmpty() and exists(spark, f"{zone}/rows"):
            known = spark.read.option("basePath", f"{zone}/rows").parquet(f"{zone}/rows")
            known = known.where((F.col("part") == "open") | (F.col("batch") < number)).join(months, "month", "left_semi")
            old = old.join(known.select(*keys), list(keys), "left_anti")
        written = _write_batch(old, zone, "old", number, event)
        _write_profile(batch, written, zone, "old", number, event)
        months.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def zone_rows(spark: SparkSession, zone: str) -> DataFrame:
    """All rows of an ingest zone."""
    return spark.read.option("basePath", f"{zone}/rows").parquet(f"{zone}/rows").drop("part", "batch", "month")
