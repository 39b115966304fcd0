"""Exactly-once ingest of a landing folder of trip files.

The file source records every file it has handed out in the checkpoint, so a
path is handed out once; each micro-batch then overwrites the partitions of its own files
(``_source_file, _source_path``), so a batch replayed after a failure rewrites what the same
files wrote, and later part files of a known source file add to it.  Each batch also enters
its files in the table's ledger (path, length, modification time): a file that changed under
its path, which the file source never hands out again, is loaded anew from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import tables as TB
from ..schemas import RAW_TRIPS
from ..sources import ledger as LG
from ..sources.ingest import CHUNK, ingest_trips, landing_path, load_files


def stream_ingest(spark: SparkSession, landing_dir: str, table: str, checkpoint: str,
                  landing_schema: T.StructType, raw_schema: T.StructType = RAW_TRIPS, root: str | None = None,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None, source_file_col: str | None = None):
    """Start (and with ``available_now`` run to completion) the landing -> raw ingest stream.

    ``checkpoint`` must be a durable shared path; it is the exactly-once ledger.
    ``source_file_col`` names a column (e.g. a partition column of the landing
    layout) to use as ``_source_file`` instead of the file's path below ``landing_dir``.
    Returns the ``StreamingQuery``.
    """
    reader = spark.readStream.schema(landing_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = landing_path(landing_dir)
    file_col = F.col(source_file_col) if source_file_col else path
    stream = reader.parquet(landing_dir).select(
        "*", file_col.alias("__file"), path.alias("__path"), F.col("_metadata.file_size").alias("__length"),
        F.col("_metadata.file_modification_time").alias("__modified"), F.col("_metadata.row_index").alias("__row"))
    parts = ["_source_file", "_source_path"]

    def reload_changed(session: SparkSession) -> None:
        changed = LG.changed(LG.listing(session, [landing_dir], landing_dir), table).select("path").collect()
        if changed:
            load_files(session, [LG.as_path(r["path"]) for r in changed], table, root, replace=True,
                       source_file_col=source_file_col, schema=landing_schema, landing_root=landing_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        raw = ingest_trips(batch, raw_schema, source_file="__file", source_path="__path", row_index=F.col("__row"))
        if TB.kind(batch.sparkSession, table) is None:
            TB.write_version(raw, table, root, partition_by=parts, chunk=CHUNK)
        else:
            TB.overwrite_partitions(raw, table, parts, chunk=CHUNK)
        LG.record(batch.select(F.col("__path").alias("_source_path"), F.col("__length").alias("length"),
                               F.col("__modified").alias("modified")).distinct(), table, root)
        if not available_now:
            reload_changed(batch.sparkSession)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
        if spark.catalog.tableExists(LG.name_of(table)):
            reload_changed(spark)
    return q
