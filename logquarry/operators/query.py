"""Filters, counts and order over event records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def query(
    records: DataFrame,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
) -> DataFrame:
    """Records that meet all given criteria. Plain predicates: Catalyst pushes them to the scan of
    ingested records."""
    if channels is not None:
        records = records.where(F.col("channel").isin(*channels))
    if event_ids is not None:
        records = records.where(F.col("event_id").isin(*event_ids))
    return records


def query_all(records: DataFrame) -> DataFrame:
    """All records."""
    return query(records)


def first_positions(records: DataFrame, *by: str) -> DataFrame:
    """(path, ``by`` columns, first): where each value appears first in each log.

    The position is one number, so the partial aggregate hashes; a struct would sort every record.
    """
    position = F.expr("shiftleft(cast(chunk_index as bigint), 32) + record_index")
    per_log = records.groupBy("path", *by).agg(F.min(position).alias("_at"))
    first = F.expr(
        "struct(path, cast(_at div 4294967296 as int) as chunk_index, cast(_at % 4294967296 as int) as record_index)"
    )
    return per_log.select("path", *by, first.alias("first"))


def channels(records: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """Distinct channels in order of first appearance: (channel, first).

    ``logs(path, channel)`` adds the channels of legacy logs, which exist without any record.
    """
    seen = first_positions(records, "channel").drop("path")
    if logs is not None:
        empty = logs.select(
            "channel",
            F.struct("path", F.lit(0).alias("chunk_index"), F.lit(0).alias("record_index")).alias("first"),
        )
        seen = seen.unionByName(empty)
    return seen.groupBy("channel").agg(F.min("first").alias("first")).orderBy("first")


def channels_per_log(records: DataFrame) -> DataFrame:
    """(path, channel, first) of each log on its own."""
    return first_positions(records, "channel")


def event_count(records: DataFrame, channel: str) -> DataFrame:
    """One row with the number of records of exactly this channel; 0 if there are none."""
    return records.agg(F.count_if(F.col("channel") == channel).alias("event_count"))


def count_matching(
    records: DataFrame,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
) -> DataFrame:
    """One row with the number of records ``query`` returns."""
    return query(records, channels, event_ids).agg(F.count("*").alias("event_count"))


def failed_logons(records: DataFrame) -> DataFrame:
    """The usual first question: failed logons of the Security log."""
    return count_matching(records, ["Security"], [4625])


def canonical_order(records: DataFrame) -> DataFrame:
    """Logs by path, then physical order: chunk slot and position in it, not record id."""
    return records.orderBy("path", "chunk_index", "record_index")
