"""Incremental daily loads as a Structured Streaming query.

The daily run is a schedule plus an idempotent keyed upsert. Here new raw
response files arriving in a folder drive it: a file stream source picks them
up, every micro-batch is transformed with the same batch functions, validated,
and merged into the target table in ``foreachBatch``. The sink is the keyed
upsert, so a micro-batch replayed after a failure (between the table write
and the offset commit) leaves the very same table: the load is exactly-once
in effect. ``trigger(availableNow=True)`` processes what is there and stops,
which is how a scheduled run uses it; a processing-time trigger keeps it
running.

Rolling frames reach across micro-batches with a ``RollingState``: a versioned
table that holds each city's last hours. Epoch e reads the state that epoch
e - 1 published (version e) and publishes version e + 1, after its rows are in
the target; a replayed epoch finds the very state it saw first. Without one,
frames see only the rows of their micro-batch.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airshed.functions.clean import to_spec
from airshed.operators.daily import AQ_SPEC, last_rows
from airshed.operators.quality import Expectation, gate, run_suite
from airshed.schemas import TableSpec
from airshed.session import checkpoint_dir
from airshed.sources.versioned import Version, merge_versioned, read_table, versions, write_version


@dataclass(frozen=True)
class RollingState:
    """Where the carried rows live, and how a raw micro-batch becomes the rows
    that frames run over. The loader's ``transform`` then takes (those rows,
    carried rows or None) and gives daily rows. Micro-batches have to come in
    the order of time, whole days each."""

    path: str
    hourly: Callable[[DataFrame], DataFrame]
    spec: tuple = AQ_SPEC

    def carried(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        known = [n for n in versions(spark, self.path) if n <= epoch]
        return read_table(spark, self.path, known[-1]) if known else None

    def carry(self, spark: SparkSession, epoch: int, hours: DataFrame, carried: DataFrame | None) -> None:
        if epoch + 1 in versions(spark, self.path):
            return  # a replayed epoch: its state is there
        base = Version(epoch, hours.schema, None)
        write_version(spark, self.path, last_rows(hours, self.spec, carried=carried), base, None, ["city_id"], replace_all=True)


def start_loader(
    spark: SparkSession,
    raw_dir: str,
    raw_schema: T.StructType,
    transform: Callable[..., DataFrame],
    target_path: str,
    spec: TableSpec,
    suite: list[Expectation] | None = None,
    checkpoint_location: str | None = None,
    now: Callable[[], dt.datetime] | None = None,
    available_now: bool = True,
    processing_time: str = "1 hour",
    max_files_per_trigger: int | None = None,
    state: RollingState | None = None,
) -> StreamingQuery:
    """Start the loader; returns the running query (``awaitTermination`` it).

    ``transform`` maps a micro-batch of raw rows to daily rows keyed by
    (date, city_id). The checkpoint lives in the shared checkpoint folder
    unless ``checkpoint_location`` names one.
    """
    # one checkpoint per table and target folder: loaders of the same table don't share it
    mark = hashlib.sha256(target_path.rstrip("/").encode()).hexdigest()[:16]
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/airshed-stream-{spec.name}-{mark}"
    reader = spark.readStream.schema(raw_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_dir)

    def load(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        # Validation, the key check and the merge all read the daily frame:
        # keep it (far smaller than the raw batch) for the batch's lifetime.
        hours = state.hourly(batch).persist(StorageLevel.MEMORY_AND_DISK) if state else None
        carried = state.carried(session, epoch_id) if state else None
        daily = (transform(hours, carried) if state else transform(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if suite:
                gate(run_suite(daily, suite))
            stamp = now() if now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            merge_versioned(session, target_path, to_spec(daily, spec), list(spec.keys), now=stamp, target_schema=spec.schema())
            if state:
                state.carry(session, epoch_id, hours, carried)
        finally:
            daily.unpersist()
            if state:
                hours.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
