"""Incremental ingest of arriving and growing log files. Every batch is read by the batch plans."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.ingest import failures_of, read_records, records_of, tagged_records
from ..sources.files import range_partitions, read_heads
from ..sources.headers import examine, header_errors
from .folder import LogFolder


def watch_logs(
    spark: SparkSession, folder: str, manifests: str, glob: str | None = None, files_per_task: int = 1000
) -> DataFrame:
    """Stream of the files of a folder: (path, length, seen, problem), contents unread.

    All names count, hidden ones as well, and files that arrive late with old times. A log that has grown comes again with
    the length that was ``seen`` before; one that became shorter does not. A folder below that cannot be listed,
    and a link to one, is a row with its ``problem``, once. What was seen is kept in ``manifests``, a folder in shared storage
    that belongs to one query, like its checkpoint.
    """
    spark.dataSource.register(LogFolder)
    reader = spark.readStream.format("logfolder").option("manifests", manifests).option("files_per_task", files_per_task)
    return (reader.option("glob", glob) if glob else reader).load(folder)


def ingest_batch(files: DataFrame, target: str, batch: int, channel: str | None = None) -> None:
    """Reads the files of one batch of ``watch_logs`` and writes ``target``/records/batch=... and
    ``target``/errors/batch=... Writing a batch again replaces it."""
    spark = files.sparkSession
    listed = files.where("problem is null").drop("problem").repartition(range_partitions(spark))
    heads = read_heads(listed).persist(StorageLevel.MEMORY_AND_DISK)
    # Legacy logs have no parts that stay as they are: those are read once, as they were first.
    logs = examine(heads).where("problem is not null or format = 'evtx' or seen = 0")
    # One pass over the bytes feeds both tables.
    tagged = tagged_records(logs, channel).persist(StorageLevel.MEMORY_AND_DISK)
    unlisted = files.where("problem is not null").select("path", F.lit("locate").alias("stage"), F.col("problem").alias("message"))
    errors = unlisted.unionByName(header_errors(heads.where("seen = 0"))).unionByName(failures_of(tagged))
    records_of(tagged).drop("seen").write.mode("overwrite").parquet(f"{target}/records/batch={batch}")
    errors.write.mode("overwrite").parquet(f"{target}/errors/batch={batch}")
    tagged.unpersist()
    heads.unpersist()


def stream_logs(files: DataFrame, target: str, checkpoint: str, channel: str | None = None, **trigger) -> list:
    """Starts the ingest of a stream of ``files`` and returns its queries: records into ``target``/records, what
    cannot be read into ``target``/errors, both Parquet and exactly once.

    ``files`` comes from ``watch_logs`` and is read by byte ranges, a grown log from its first new chunk; a stream with a
    ``content`` column (log bytes out of a table) works too. ``target`` and ``checkpoint`` must lie in
    storage that all executors share. The default trigger takes what is there and ends.
    """
    trigger = trigger or {"availableNow": True}
    if "content" not in files.columns:
        writer = files.writeStream.foreachBatch(lambda batch, number: ingest_batch(batch, target, number, channel))
        return [writer.option("checkpointLocation", f"{checkpoint}/files").trigger(**trigger).start()]

    def start(rows: DataFrame, name: str):
        writer = rows.writeStream.format("parquet").option("path", f"{target}/{name}").outputMode("append")
        return writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start()

    return [start(read_records(files, channel), "records"), start(header_errors(files), "errors")]
