"""File and chunk headers as plain projections, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binary import flag, u16, u32, u32_array, u32_sql, u64
from .files import EVTX_CHUNK_SIZE, EVTX_HEADER_SIZE, EVT_HEADER_SIZE, detect_format

# Fixed values of the formats. The magic is the text ElfChnk and a NUL.
EVTX_CHUNK_MAGIC_HEX = "456C6643686E6B00"
CHUNK_HEADER_SIZE = 512
FLAG_DIRTY = 0x1
FLAG_FULL = 0x2
EVT_FLAG_WRAP = 0x2
EVT_FLAG_ARCHIVED = 0x8

_EVTX_READABLE = f"format = 'evtx' and octet_length(head) = {EVTX_HEADER_SIZE}"
_EVT_READABLE = f"format = 'evt' and {u32_sql('head', 44)} = {EVT_HEADER_SIZE}"
_FILE_CHECKSUM = f"crc32(substring(head, 1, 120)) = {u32_sql('head', 124)}"


def _with_head(files: DataFrame) -> DataFrame:
    if "head" in files.columns:
        return files
    return files.withColumn("head", F.substring("content", 1, EVTX_HEADER_SIZE))


def _file_columns(files: DataFrame) -> list[str]:
    return [c for c in files.columns if c not in ("content", "head", "read_error", "modificationTime", "format")]


def evtx_log_headers(files: DataFrame) -> DataFrame:
    """Header fields of every readable evtx file. A wrong checksum is a flag, not an error."""
    head, flags = "head", u32_sql("head", 120)
    return detect_format(_with_head(files)).where(_EVTX_READABLE).select(
        *_file_columns(files),
        u64(head, 8).alias("first_chunk_number"),
        u64(head, 16).alias("last_chunk_number"),
        u64(head, 24).alias("next_record_id"),
        u32(head, 32).alias("header_size"),
        u16(head, 36).alias("minor_version"),
        u16(head, 38).alias("major_version"),
        u16(head, 40).alias("header_block_size"),
        u16(head, 42).alias("chunk_count"),
        F.expr(flags).alias("flags"),
        flag(flags, FLAG_DIRTY).alias("is_dirty"),
        flag(flags, FLAG_FULL).alias("is_full"),
        u32(head, 124).alias("checksum"),
        F.expr(_FILE_CHECKSUM).alias("checksum_valid"),
    )


def evt_log_headers(files: DataFrame) -> DataFrame:
    """Header fields of every readable legacy file."""
    head, flags = "head", u32_sql("head", 36)
    return detect_format(_with_head(files)).where(_EVT_READABLE).select(
        *_file_columns(files),
        u32(head, 8).alias("major_version"),
        u32(head, 12).alias("minor_version"),
        u32(head, 16).alias("start_offset"),
        u32(head, 20).alias("end_offset"),
        u32(head, 24).alias("last_record_number"),
        u32(head, 28).alias("first_record_number"),
        u32(head, 32).alias("max_size"),
        F.expr(flags).alias("flags"),
        flag(flags, FLAG_DIRTY).alias("is_dirty"),
        flag(flags, EVT_FLAG_WRAP).alias("is_wrapped"),
        flag(flags, EVT_FLAG_ARCHIVED).alias("is_archived"),
        u32(head, 40).alias("retention"),
    )


def readable_evtx(files: DataFrame) -> DataFrame:
    """evtx files whose header parses, with ``format`` and ``file_checksum_valid`` added."""
    return (
        detect_format(_with_head(files))
        .where(_EVTX_READABLE)
        .withColumn("file_checksum_valid", F.expr(_FILE_CHECKSUM))
        .drop("head", "read_error")
    )


def readable_evt(files: DataFrame) -> DataFrame:
    """Legacy files whose header parses, with ``format`` added."""
    return detect_format(_with_head(files)).where(_EVT_READABLE).drop("head", "read_error")


def examine(files: DataFrame, expected: tuple[str, ...] = ("evtx", "evt")) -> DataFrame:
    """Files with what their heads say: ``format``, ``file_checksum_valid`` and ``problem``, which is NULL for a
    log that can be read; the heads themselves are left out."""
    probed = detect_format(_with_head(files))
    checksum = f"if(format = 'evtx' and octet_length(head) >= 128, {_FILE_CHECKSUM}, null)"
    return probed.withColumns({"file_checksum_valid": F.expr(checksum), "problem": F.expr(_problem(probed, expected))}).drop(
        "head", "read_error", "content", "modificationTime"
    )


def log_units(files: DataFrame) -> DataFrame:
    """Decode units of all readable in-memory files: one row per written evtx chunk and one per evt
    file, bytes in ``chunk``, told apart by ``format``. One scan serves both formats."""
    carried = [c for c in files.columns if c not in ("content", "head", "length", "modificationTime")]
    slots = f"greatest((octet_length(content) - {EVTX_HEADER_SIZE}) div {EVTX_CHUNK_SIZE}, 0L)"
    start = f"chunk_index * {EVTX_CHUNK_SIZE} + {EVTX_HEADER_SIZE + 1}"
    readable = detect_format(_with_head(files)).where(f"({_EVTX_READABLE}) or ({_EVT_READABLE})")
    indexed = readable.where(f"format = 'evt' or {slots} > 0").selectExpr(
        *carried,
        "content",
        "format",
        f"if(format = 'evtx', {_FILE_CHECKSUM}, null) as file_checksum_valid",
        f"explode(sequence(0, if(format = 'evtx', cast({slots} as int) - 1, 0))) as chunk_index",
    )
    units = indexed.withColumn(
        "chunk", F.expr(f"if(format = 'evtx', substring(content, {start}, {EVTX_CHUNK_SIZE}), content)")
    ).drop("content")
    valid = f"if(format = 'evtx', {_EVENTS_CHECKSUM} and {_HEADER_CHECKSUM}, null)"
    written = _chunk_header(units).where((F.col("format") == "evt") | _written("_header"))
    return written.withColumn("chunk_checksum_valid", F.expr(valid)).drop("_header")


def header_errors(files: DataFrame) -> DataFrame:
    """One row for each file that cannot be read as a log: unreadable, no log, or a bad header."""
    return _errors(files, ("evtx", "evt"))


def evtx_errors(files: DataFrame) -> DataFrame:
    """Same where only evtx logs are expected: any other file is an error."""
    return _errors(files, ("evtx",))


def _errors(files: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    probed = detect_format(_with_head(files))
    failed = _failed(probed)
    return probed.selectExpr(
        "path",
        f"if({failed} is not null, 'read', 'header') as stage",
        f"concat(path, ': ', {_problem(probed, expected)}) as message",
    ).where("message is not null")


def _failed(probed: DataFrame) -> str:
    return "read_error" if "read_error" in probed.columns else "cast(null as string)"


def _problem(probed: DataFrame, expected: tuple[str, ...]) -> str:
    failed, known = _failed(probed), ", ".join(f"'{name}'" for name in expected)
    return f"""case
      when {failed} is not null then {failed}
      when format is null or format not in ({known}) then 'not an event log'
      when format = 'evtx' and octet_length(head) < {EVTX_HEADER_SIZE} then 'file is shorter than its header'
      when format = 'evt' and {u32_sql('head', 44)} != {EVT_HEADER_SIZE} then 'file header size copies differ'
    end"""


def _chunk_header(chunks: DataFrame) -> DataFrame:
    """Adds ``_header``, the first 512 bytes: later fields then copy those and not 64 KiB."""
    return chunks.withColumn("_header", F.substring("chunk", 1, CHUNK_HEADER_SIZE))


_FREE = u32_sql("_header", 48)
_EVENTS_CHECKSUM = f"""if({_FREE} between {CHUNK_HEADER_SIZE} and {EVTX_CHUNK_SIZE},
  crc32(substring(chunk, {CHUNK_HEADER_SIZE + 1}, cast({_FREE} - {CHUNK_HEADER_SIZE} as int)))
    = {u32_sql('_header', 52)},
  false)"""
_HEADER_CHECKSUM = f"""crc32(concat(substring(_header, 1, 120), substring(_header, 129, {CHUNK_HEADER_SIZE - 128})))
  = {u32_sql('_header', 124)}"""


def _written(column: str) -> Column:
    return F.expr(f"substring({column}, 1, 8) = X'{EVTX_CHUNK_MAGIC_HEX}'")


def skip_unwritten(chunks: DataFrame) -> DataFrame:
    """Drops slots that were allocated but never written."""
    return chunks.where(_written("chunk"))


def chunk_headers(chunks: DataFrame) -> DataFrame:
    """Header fields and both checksums of every written chunk."""
    head = "_header"
    carried = [c for c in chunks.columns if c != "chunk"]
    return _chunk_header(chunks).where(_written(head)).select(
        *carried,
        u64(head, 8).alias("first_record_number"),
        u64(head, 16).alias("last_record_number"),
        u64(head, 24).alias("first_record_id"),
        u64(head, 32).alias("last_record_id"),
        u32(head, 44).alias("last_record_offset"),
        u32(head, 48).alias("free_space_offset"),
        u32(head, 52).alias("events_checksum"),
        F.expr(_EVENTS_CHECKSUM).alias("events_checksum_valid"),
        u32(head, 120).alias("flags"),
        u32(head, 124).alias("header_checksum"),
        F.expr(_HEADER_CHECKSUM).alias("header_checksum_valid"),
        u32_array(head, 128, 64).alias("name_buckets"),
        u32_array(head, 384, 32).alias("template_buckets"),
    )


def flag_integrity(chunks: DataFrame) -> DataFrame:
    """Written chunks with ``chunk_checksum_valid``; bad chunks are flagged and kept."""
    valid = F.expr(f"{_EVENTS_CHECKSUM} and {_HEADER_CHECKSUM}")
    flagged = _chunk_header(chunks).where(_written("_header"))
    return flagged.withColumn("chunk_checksum_valid", valid).drop("_header")


def slot_states(chunks: DataFrame) -> DataFrame:
    """Adds ``is_written`` to every slot."""
    return chunks.withColumn("is_written", _written("chunk"))
