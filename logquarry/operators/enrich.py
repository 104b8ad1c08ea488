"""Records in common-schema names, with where they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.levels import lookup_sql

# Channels with an artifact of their own. All others are Other(channel).
ARTIFACTS = {
    "Application": "Application",
    "Security": "Security",
    "Setup": "Setup",
    "System": "System",
    "Microsoft-Windows-Sysmon/Operational": "Sysmon",
    "Microsoft-Windows-PowerShell/Admin": "PowerShell",
    "Microsoft-Windows-PowerShell/Operational": "PowerShell",
    "PowerShellCore/Operational": "PowerShell",
    "Windows PowerShell": "PowerShell",
}
_PREFIX = "Windows::WinEvt::"

# The definition whose logs carry a channel.
CHANNEL_DEFINITIONS = {
    "Application": "WindowsXMLEventLogApplication",
    "Security": "WindowsXMLEventLogSecurity",
    "System": "WindowsXMLEventLogSystem",
    "Microsoft-Windows-Sysmon/Operational": "WindowsXMLEventLogSysmon",
    "Microsoft-Windows-PowerShell/Admin": "WindowsXMLEventLogPowerShell",
    "Microsoft-Windows-PowerShell/Operational": "WindowsXMLEventLogPowerShell",
    "PowerShellCore/Operational": "WindowsXMLEventLogPowerShell",
    "Windows PowerShell": "WindowsXMLEventLogPowerShell",
    "Microsoft-Windows-TerminalServices-LocalSessionManager/Operational": "WindowsXMLEventLogTerminalServices",
}


def artifact_of(channel: str = "channel") -> Column:
    """Artifact name of a channel; the match is exact and case-sensitive."""
    known = lookup_sql(channel, ARTIFACTS)
    return F.expr(f"concat('{_PREFIX}', coalesce({known}, concat('Other(', {channel}, ')')))")


def classify_channel(records: DataFrame) -> DataFrame:
    """Adds ``artifact``; the channel itself stays as it is."""
    return records.withColumn("artifact", artifact_of("channel"))


def with_provenance(
    records: DataFrame, acquisition: str = "ImageRead", recovery: str = "Allocated"
) -> DataFrame:
    """Adds one source id per real file, and how the bytes were acquired and recovered.

    The id is a hash of the path: stable over runs, and no global numbering is needed.
    """
    return records.withColumns(
        {
            "source_id": F.sha2("path", 256),
            "acquisition": F.lit(acquisition),
            "recovery": F.lit(recovery),
        }
    )


_COMMON_NAMES = {
    "@timestamp": "timestamp",
    "event.record_id": "record_id",
    "event.code": "event_id",
    "event.provider": "provider",
    "event.channel": "channel",
    "log.level": "level",
    "host.name": "computer",
    "user.id": "user_sid",
    "event.strings": "strings",
    "event.data": "raw_data",
    "event.time_written": "time_written",
    "event.category": "category",
    "evtx.file.checksum_valid": "file_checksum_valid",
    "evtx.chunk.checksum_valid": "chunk_checksum_valid",
    "evtx.record.decode_error": "decode_error",
}
_PROVENANCE = ["source_id", "acquisition", "recovery"]


def enrich(records: DataFrame, host: str | Column, acquisition: str = "ImageRead") -> DataFrame:
    """Records under common-schema names. ``artifact.host`` is the host the log comes from (a name, or a
    column where the records are of many), ``host.name`` the computer the record names. ``definition`` and ``located_by`` are taken over where present."""
    source = with_provenance(classify_channel(records), acquisition)
    common = [F.col(old).alias(new) for new, old in _COMMON_NAMES.items() if old in source.columns]
    located = [
        F.col(c).alias(f"artifact.{c}") for c in ("definition", "located_by") if c in source.columns
    ]
    return source.select(
        *common,
        (F.lit(host) if isinstance(host, str) else host).alias("artifact.host"),
        F.col("artifact").alias("artifact.name"),
        F.col("path").alias("artifact.path"),
        *located,
        *_PROVENANCE,
        *[c for c in ("chunk_index", "record_index", "data") if c in source.columns],
    )


def channel_definition(channel: str = "channel") -> Column:
    """The definition a record's own channel belongs to, NULL if none."""
    return F.expr(lookup_sql(channel, CHANNEL_DEFINITIONS))


def mismatched_attribution(records: DataFrame) -> DataFrame:
    """Records whose channel belongs to another definition than the path they were found at: renamed
    or planted logs. Undecodable records name no channel and are left out."""
    by_channel = channel_definition("channel")
    return records.withColumn("channel_definition", by_channel).where(
        (F.col("channel") != "") & ~F.col("channel_definition").eqNullSafe(F.col("definition"))
    )
