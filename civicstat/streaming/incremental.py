"""Incremental runs of the batch operators over a long table arriving as files.

The reference has no streaming construct.  For data that lands file by
file (a long indicator table refreshed per source), the same operators run
under Structured Streaming:

* ``validate_batches`` applies a check function (any ``DataFrame ->
  checks`` operator of ``operators.quality`` / ``operators.profile``) to every
  micro-batch with ``foreachBatch`` and writes the rows to one parquet
  partition per batch id (a replayed batch overwrites, never duplicates);
* ``running_coverage`` keeps rows / non-null values per (section,
  geography) as streaming state (the coverage matrix G3 and completeness
  counts A5 over everything seen so far).

Both write their progress and state under the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted query or a lost executor resumes
from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from civicstat.operators.longform import GEOGRAPHY, SECTION, VALUE
from civicstat.session import checkpoint_dir


def long_table_stream(spark: SparkSession, path: str, schema: StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream of the long table (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _location(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def validate_batches(stream: DataFrame, check: Callable[[DataFrame], DataFrame], sink_path: str,
                     name: str, checkpoint_location: str | None = None,
                     available_now: bool = True) -> StreamingQuery:
    """Run ``check`` on every micro-batch; its rows land in ``batch_id=<n>``.

    Each batch overwrites its own partition folder, so a batch replayed
    after a failure replaces its earlier output instead of duplicating it
    (idempotent sink); reading ``sink_path`` yields a ``batch_id`` column.
    """
    root = sink_path.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        check(batch).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    writer = (stream.writeStream.foreachBatch(per_batch).queryName(name)
              .option("checkpointLocation", _location(stream.sparkSession, name, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def running_coverage(stream: DataFrame, table_name: str, name: str = "coverage",
                     checkpoint_location: str | None = None, available_now: bool = True,
                     sink_path: str | None = None) -> StreamingQuery:
    """Rows and non-null values per (section, geography) over all batches so far.

    A streaming aggregation with map-side partial aggregation; its state is
    one row per (section, geography), bounded by the dimension sizes.  With
    ``sink_path`` every trigger overwrites that parquet folder with the
    current totals (complete mode through ``foreachBatch``); without it the
    totals stay in a memory table named ``table_name`` for interactive use.
    """
    agg = stream.groupBy(SECTION, GEOGRAPHY).agg(
        F.count(F.lit(1)).alias("rows"), F.count(VALUE).alias("non_null_values"))
    writer = agg.writeStream.outputMode("complete").queryName(table_name).option(
        "checkpointLocation", _location(stream.sparkSession, name, checkpoint_location))
    if sink_path:
        writer = writer.foreachBatch(lambda batch, _id: batch.write.mode("overwrite").parquet(sink_path))
    else:
        writer = writer.format("memory")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
