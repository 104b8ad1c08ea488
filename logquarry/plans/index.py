"""A stored index of chunks: which channels, event ids and times each holds, so that later scans read only those."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.files import EVTX_CHUNK_SIZE, list_logs, range_partitions, read_heads
from ..sources.headers import examine
from ..sources.units import RANGE_CHUNKS, log_ranges
from .ingest import heads_of_listing, records_of, tagged_records, unit_records

#: Of a chunk with more different event ids or channels than this, the index says that it may hold any.
MOST_VALUES = 256


_DATE = "_modified"


def _dated(heads: DataFrame) -> DataFrame:
    return heads.withColumn(_DATE, F.col("modificationTime"))


def index_logs(spark: SparkSession, path: str | Sequence[str], glob: str | None = None, bytes_per_task: int = 128 << 20) -> DataFrame:
    """One row per written chunk of the evtx logs below ``path``: (path, length, modificationTime, chunk_index, records,
    first_time, last_time, channels, event_ids). Store it, and give it to ``scan_indexed``.

    A log that gives no record has a row with no chunk, so that a later scan knows it. A chunk's rows are grouped where they
    are decoded; 64 KiB bound them.
    """
    heads, tasks = heads_of_listing(list_logs(spark, path, glob), bytes_per_task)
    wanted = ["filetime", "channel", "event_id"]
    records = records_of(tagged_records(examine(heads, ("evtx",)), partitions=tasks, columns=wanted))

    def few(values):
        return F.when(F.size(values) <= MOST_VALUES, values)

    chunks = records.groupBy("path", "chunk_index").agg(
        F.count("*").alias("records"),
        F.min("filetime").alias("first_time"),
        F.max("filetime").alias("last_time"),
        few(F.sort_array(F.collect_set("channel"))).alias("channels"),
        few(F.sort_array(F.collect_set("event_id"))).alias("event_ids"),
    )
    logs = examine(_dated(heads), ("evtx",)).where("problem is null")
    logs = logs.select("path", "length", F.col(_DATE).alias("modificationTime"))
    columns = ["chunk_index", "records", "first_time", "last_time", "channels", "event_ids"]
    return logs.join(chunks, "path", "left").select("path", "length", "modificationTime", *columns)


def indexed_ranges(
    logs: DataFrame,
    index: DataFrame,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
    times: tuple[int, int] | None = None,
) -> DataFrame:
    """Units of ``examine``d ``logs`` (with their ``modificationTime``) that may hold matching records. Logs that are not in
    the index as they are now are read whole; of the others only the chunks whose entries match, next to each other in one unit."""
    state = ["path", "length", "modificationTime"]
    known = index.select(*state).distinct()
    fresh = logs.join(known, state, "left_semi")
    unknown = logs.join(known, state, "left_anti")
    matching = index.where("chunk_index is not null")
    if channels is not None:
        named = F.array(*[F.lit(c) for c in channels]).cast("array<string>")
        matching = matching.where(F.col("channels").isNull() | F.arrays_overlap("channels", named))
    if event_ids is not None:
        named = F.array(*[F.lit(i) for i in event_ids]).cast("array<bigint>")
        matching = matching.where(F.col("event_ids").isNull() | F.arrays_overlap("event_ids", named))
    if times is not None:
        matching = matching.where((F.col("last_time") >= times[0]) & (F.col("first_time") <= times[1]))
    # Neighbours share the difference of slot and rank; a log has at most as many rows as chunks.
    rank = F.row_number().over(Window.partitionBy("path").orderBy("chunk_index"))
    island = matching.select(*state, "chunk_index", (F.col("chunk_index") - rank).alias("island"))
    ranges = island.groupBy(*state, "island", F.floor(F.col("chunk_index") / RANGE_CHUNKS)).agg(
        F.min("chunk_index").cast("long").alias("_first"), (F.max("chunk_index") + 1).cast("long").alias("_stop")
    )
    parts = fresh.join(ranges.drop("island"), state).withColumn("_index", F.lit(None).cast("int"))
    units = log_ranges(unknown)
    return parts.select(*units.columns).unionByName(units)


def scan_indexed(
    spark: SparkSession,
    path: str | Sequence[str],
    index: DataFrame,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
    times: tuple[int, int] | None = None,
    columns: Sequence[str] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Records of the evtx logs below ``path`` that match: as ``scan_logs`` with the same filters, and between two
    ``times`` (FILETIME, both included), but chunks that the index rules out are not read."""
    listing = list_logs(spark, path, glob).repartition(range_partitions(spark))
    logs = examine(_dated(read_heads(listing)), ("evtx",)).where("problem is null").drop("problem")
    logs = logs.withColumnRenamed(_DATE, "modificationTime")
    units = indexed_ranges(logs, index, channels, event_ids, times).repartition(range_partitions(spark))
    timed = columns is not None and times is not None and "filetime" not in columns
    wanted = [*columns, "filetime"] if timed else columns
    records = records_of(unit_records(units.drop("modificationTime"), wanted, channels, event_ids))
    if times is not None:
        records = records.where(F.col("filetime").between(*times))
    return records.drop("filetime") if timed else records


def bytes_of(units: DataFrame) -> DataFrame:
    """One row with the bytes of log that reading the units takes."""
    size = F.when(F.col("_stop").isNotNull(), (F.col("_stop") - F.col("_first")) * EVTX_CHUNK_SIZE).otherwise(F.col("length"))
    return units.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
