"""Streaming ingest of lap files (S1 over a landing directory, as a stream).

The reference only ingests in batch; here the same S1 cleaning runs incrementally
on files as they land. Each micro-batch is appended to the ``race_data`` table
partitioned by year/circuit; the checkpoint location makes the file source and the
sink exactly-once across restarts. No state is kept between batches, so no
watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.lapfiles import LANDING_SCHEMA, PARTITIONS, ingest_race_laps


def race_laps_stream(spark: SparkSession, landing: str, fmt: str = "parquet", schema=None,
                     max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of cleaned race laps from files arriving under ``landing``
    (partition folders ``year=/circuit=`` supply those columns)."""
    raw = (spark.readStream.format(fmt).schema(schema or LANDING_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .load(landing))
    return ingest_race_laps(raw)


def start_race_laps_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                           fmt: str = "parquet", trigger_once: bool = False) -> StreamingQuery:
    """Start the stream: landing files -> S1 -> append to the partitioned table."""
    w = (race_laps_stream(spark, landing, fmt).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).partitionBy(*PARTITIONS).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start(table_path)
