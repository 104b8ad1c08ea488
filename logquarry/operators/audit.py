"""What a log declares against what could be read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.decode import chunk_totals, evt_totals
from ..sources.files import (
    EVTX_CHUNK_SIZE,
    EVTX_HEADER_SIZE,
    EVT_HEADER_SIZE,
    range_partitions,
    slot_count,
)
from ..sources.headers import evt_log_headers, evtx_log_headers, examine, readable_evt, slot_states
from ..sources.units import log_ranges, slot_totals


def audit_slots(heads: DataFrame, slots: DataFrame) -> DataFrame:
    """One row per evtx log. ``slots`` are all its chunk rows, ``heads`` its file headers.

    The decode pass returns two numbers per chunk, which are summed on the map side first.
    """
    states = slot_states(slots.select("path", "chunk_index", "chunk"))
    return _declared_against(heads, _counted(states).groupBy("path").agg(*_slot_sums()))


def _counted(states: DataFrame) -> DataFrame:
    # Slots never written travel without their bytes: they hold no records.
    return chunk_totals(states.withColumn("chunk", F.when(F.col("is_written"), F.col("chunk")).otherwise(F.lit(b""))))


def _slot_sums() -> list[Column]:
    return [
        F.count_if("is_written").alias("slots_parsed"),
        F.count_if(~F.col("is_written")).alias("slots_skipped"),
        F.sum("records").alias("records"),
        F.sum("decode_errors").alias("decode_errors"),
    ]


_COUNTED = ("slots_parsed", "slots_skipped", "records", "decode_errors")


def _declared(headers: DataFrame, *carried: str) -> DataFrame:
    length = F.col("length")
    tail = F.pmod(length - EVTX_HEADER_SIZE, F.lit(EVTX_CHUNK_SIZE))
    return headers.select(
        "path",
        F.col("chunk_count").alias("chunk_count_declared"),
        slot_count(length).alias("slots_by_length"),
        tail.alias("truncated_bytes"),
        "is_dirty",
        "is_full",
        *carried,
    )


def _declared_against(heads: DataFrame, per_log: DataFrame) -> DataFrame:
    joined = _declared(evtx_log_headers(heads)).join(per_log, "path", "left")
    return _with_incomplete(joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in _COUNTED}))


def _with_incomplete(audit: DataFrame) -> DataFrame:
    return audit.withColumn("is_incomplete", F.col("chunk_count_declared") > F.col("slots_parsed"))


def audit_stored(heads: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per stored evtx log, given ``read_heads`` of the listing: as ``audit_slots``, with ``read_error`` for a
    log that could not be read to its end. Four numbers per byte range leave the tasks, and no log bytes."""
    logs = examine(heads, ("evtx",)).where("problem is null").drop("problem")
    units = log_ranges(logs).repartition(partitions or range_partitions(heads.sparkSession))
    totals = slot_totals(units).groupBy("path").agg(
        *[F.sum(c).alias(c) for c in _COUNTED], F.min("read_error").alias("read_error")
    )
    return _declared_against(heads, totals)


def log_audit(files: DataFrame) -> DataFrame:
    """Audit of the evtx logs among in-memory ``files``, in one pass over them: what a log declares follows its slots. A
    log without any has one empty slot that counts nowhere."""
    logs = _declared(evtx_log_headers(files.withColumn("_bytes", F.col("content"))), "_bytes")
    declared = [c for c in logs.columns if c != "_bytes"]
    last = F.greatest(F.col("slots_by_length"), F.lit(1)) - 1
    slots = logs.select(*declared, "_bytes", F.explode(F.sequence(F.lit(0), last)).alias("chunk_index"))
    start = F.col("chunk_index") * EVTX_CHUNK_SIZE + (EVTX_HEADER_SIZE + 1)
    chunk = F.substring("_bytes", start, F.lit(EVTX_CHUNK_SIZE))
    states = slot_states(slots.select(*declared, chunk.alias("chunk"))).withColumn(
        "is_written", F.when(F.col("slots_by_length") > 0, F.col("is_written"))
    )
    return _with_incomplete(_counted(states).groupBy(*declared).agg(*_slot_sums()))


def evt_audit(files: DataFrame) -> DataFrame:
    """One row per legacy log: its flags, the records it declares and the records that were read.

    A wrapped log gives no records; its ``is_wrapped`` flag and ``end_before_start`` say why.
    """
    declared = evt_log_headers(files)
    logs = declared.select(
        "path",
        "is_dirty",
        "is_wrapped",
        "is_archived",
        (F.col("end_offset") < F.col("start_offset")).alias("end_before_start"),
        F.when(
            F.col("end_offset") > EVT_HEADER_SIZE,
            F.col("last_record_number") - F.col("first_record_number") + 1,
        ).otherwise(F.lit(0)).alias("records_declared"),
    )
    counted = evt_totals(readable_evt(files).drop("length", "modificationTime"))
    per_log = counted.groupBy("path").agg(F.sum("records").alias("records"))
    return logs.join(per_log, "path", "left").withColumn("records", F.coalesce("records", F.lit(0)))
