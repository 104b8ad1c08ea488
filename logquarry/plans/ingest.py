"""Whole plans: log bytes to records, evidence to enriched records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.enrich import enrich
from ..operators.query import count_matching
from ..operators.mapping import RECORD_COLUMNS, map_data, map_event, map_evt, map_texts, map_units, record_columns
from ..sources.catalog import bodies_of_evidence, expand_patterns, locate_logs
from ..sources.decode import decode_chunks, decode_data, decode_evt, decode_units
from ..sources.files import (
    given_paths,
    held,
    list_below,
    list_roots,
    range_partitions,
    read_heads,
    split_chunks,
    with_channel,
)
from ..sources.headers import (
    evtx_errors,
    examine,
    flag_integrity,
    header_errors,
    log_units,
    readable_evt,
    readable_evtx,
)
from ..sources.units import EVT_RANGE, SYSTEM_FIELDS, UNIT_COLUMNS, Wanted, log_ranges, read_failures, read_units

_HOST, _SYSTEM_ROOT = "_evidence_host", "_evidence_system_root"
_NOT_CARRIED = ("content", "head", "read_error", "modificationTime", "length", "chunk")


def _carried(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in _NOT_CARRIED]


def records_of_chunks(chunks: DataFrame, typed: bool = False) -> DataFrame:
    """Records of evtx chunks. ``chunks`` has path, format, file_checksum_valid, chunk_index, chunk
    and whatever else should follow each record. ``typed`` adds ``typed_data``, see ``map_event``."""
    flagged = flag_integrity(chunks).drop("length", "modificationTime")
    if typed:
        return record_columns(map_data(decode_data(flagged)), [*_carried(flagged), "typed_data"])
    return record_columns(map_event(decode_chunks(flagged)), _carried(flagged))


def read_evtx(files: DataFrame, typed: bool = False) -> DataFrame:
    """Records of the evtx files among ``files(path, content, ...)``."""
    return records_of_chunks(split_chunks(readable_evtx(files)), typed)


def read_evt(files: DataFrame, channel: str | None = None) -> DataFrame:
    """Records of the legacy files among ``files(path, content, ...)``."""
    logs = with_channel(readable_evt(files), channel).drop("length", "modificationTime")
    return record_columns(map_evt(decode_evt(logs)), _carried(logs))


def log_files_union(evtx: DataFrame, evt: DataFrame) -> DataFrame:
    """Records of both formats in one DataFrame."""
    return evtx.unionByName(evt, allowMissingColumns=True)


def read_records(files: DataFrame, channel: str | None = None) -> DataFrame:
    """Records of all logs among ``files(path, content, ...)``, whatever their format, in one scan."""
    units = with_channel(log_units(files), channel)
    return record_columns(map_units(decode_units(units)), _carried(units))


_TEXT_COLUMNS = {"path", "format", "chunk_index", "record_index", *RECORD_COLUMNS} - {"data"}


def tagged_records(
    logs: DataFrame,
    channel: str | None = None,
    partitions: int | None = None,
    columns: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
    evt_range: int = EVT_RANGE,
) -> DataFrame:
    """One pass over ``examine``d logs: their records, and a row with ``read_error`` for what cannot be read.

    ``columns`` are the record columns that are wanted (path, format and position always come). Without ``data`` among
    them, tasks hand over the texts of single fields instead of whole documents. ``channels`` and ``event_ids`` are
    tested in the decoder, which steps over the rest of a record that has others. Legacy logs of more than
    ``evt_range`` bytes are read by several tasks.
    """
    logs = with_channel(logs.where("problem is null").drop("problem"), channel)
    if channels is not None:
        logs = logs.where((F.col("format") != "evt") | F.col("channel").isin(*channels))
    units = log_ranges(logs, evt_range=evt_range).repartition(partitions or range_partitions(logs.sparkSession))
    return unit_records(units, columns, channels, event_ids)


def unit_records(
    units: DataFrame,
    columns: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
) -> DataFrame:
    """``tagged_records`` of units (``log_ranges``)."""
    needed = None
    if columns is not None and _TEXT_COLUMNS.issuperset(columns):
        tested = [*columns, *(["channel"] if channels is not None else []), *(["event_id"] if event_ids is not None else [])]
        needed = [f for f in SYSTEM_FIELDS if f in tested]
    legacy_data = columns is None or not {"strings", "raw_data"}.isdisjoint(columns)
    decoded = read_units(units, Wanted(needed, channels, event_ids, legacy_data))
    if "channel" not in units.columns:  # modern logs only
        decoded = decoded.withColumn("channel", F.lit(None).cast("string"))
    mapped = map_units(decoded) if needed is None else map_texts(decoded, needed)
    carried = [c for c in _carried(units) if c not in UNIT_COLUMNS]
    records = record_columns(mapped, [*carried, "read_error"])
    if channels is not None or event_ids is not None:
        records = records.where(F.col("read_error").isNotNull() | _matches(channels, event_ids))
    if columns is not None:
        always = ["path", "format", "chunk_index", "record_index"]
        records = records.select(*always, *[c for c in columns if c not in always], "read_error")
    return records


def _matches(channels: Sequence[str] | None, event_ids: Sequence[int] | None) -> Column:
    test = F.lit(True)
    if channels is not None:
        test = test & F.col("channel").isin(*channels)
    return test if event_ids is None else test & F.col("event_id").isin(*event_ids)


def records_of(tagged: DataFrame) -> DataFrame:
    """The records of ``tagged_records``."""
    return tagged.where("read_error is null").drop("read_error")


def failures_of(tagged: DataFrame) -> DataFrame:
    """One error row for each log of ``tagged_records`` that could not be read to its end."""
    return _failures(tagged.where("read_error is not null").select("path", F.col("read_error").alias("message")))


def _failures(failed: DataFrame) -> DataFrame:
    if not failed.isStreaming:  # one row a log, however many of its ranges failed
        failed = failed.groupBy("path").agg(F.min("message").alias("message"))
    return failed.select("path", F.lit("read").alias("stage"), F.concat("path", F.lit(": "), "message").alias("message"))


def read_stored_records(
    heads: DataFrame, channel: str | None = None, partitions: int | None = None, **wanted
) -> DataFrame:
    """Records of stored logs, given ``read_heads`` of their listing. Reads byte ranges: no log travels through a
    shuffle and one huge log is shared by many tasks. ``wanted`` are the options of ``tagged_records``."""
    return records_of(tagged_records(examine(heads), channel, partitions, **wanted))


def read_errors(heads: DataFrame, expected: tuple[str, ...] = ("evtx", "evt")) -> DataFrame:
    """One error row for each stored log whose head or whose bytes cannot be read. Evaluating it reads all ranges, and
    decodes none."""
    logs = examine(heads, expected)
    units = log_ranges(logs.where("problem is null").drop("problem"))
    units = units.repartition(range_partitions(heads.sparkSession))
    found = header_errors(heads) if "evt" in expected else evtx_errors(heads)
    return found.unionByName(_failures(read_failures(units)))


def scan_logs(
    spark: SparkSession,
    path: str | Sequence[str],
    glob: str | None = None,
    channel: str | None = None,
    bytes_per_task: int = 128 << 20,
    columns: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of all files under ``path``; options as in ``tagged_records``.

    Files are listed and their heads read once, by one job whose result is kept; it also tells the bytes, which the
    number of tasks follows.
    """
    listing, unlisted = list_below(spark, path, glob)
    heads, tasks = heads_of_listing(listing, bytes_per_task)
    records = read_stored_records(heads, channel, tasks, columns=columns, channels=channels, event_ids=event_ids)
    return records, unlisted.unionByName(read_errors(heads))


def count_in_logs(
    spark: SparkSession,
    path: str | Sequence[str],
    channels: Sequence[str] | None = None,
    event_ids: Sequence[int] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """``count_matching`` of all logs below ``path``: records that don't match are not decoded."""
    columns = [c for c, given in (("channel", channels), ("event_id", event_ids)) if given is not None]
    records, _ = scan_logs(spark, path, glob, columns=columns, channels=channels, event_ids=event_ids)
    return count_matching(records, channels, event_ids)


def failed_logons_of(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``failed_logons`` of all logs below ``path``."""
    return count_in_logs(spark, path, ["Security"], [4625], glob)


def heads_of_listing(listing: DataFrame, bytes_per_task: int) -> tuple[DataFrame, int]:
    """Heads of the listed files, read once by as many tasks as their number asks for, and the tasks that their
    bytes ask for."""
    spark = listing.sparkSession
    files, size = listing.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    # An explicit number: the planner would merge these few bytes into one task.
    spread = listing.repartition(max(1, min(files, max(range_partitions(spark), files // 64))))
    # Logs differ in size, so a few tasks a core keep all cores busy.
    return held(read_heads(spread)), max(3 * spark.sparkContext.defaultParallelism, -(-int(size) // bytes_per_task))


def ingest_logs(
    spark: SparkSession,
    path: str | Sequence[str],
    target: str,
    glob: str | None = None,
    channel: str | None = None,
    bytes_per_task: int = 128 << 20,
) -> tuple[DataFrame, DataFrame]:
    """Writes all records below ``path`` to ``target`` as Parquet and returns (records, errors), both read from there.

    One pass over the bytes feeds both: what a task cannot read is a row of its own among the records.
    """
    listing, unlisted = list_below(spark, path, glob)
    heads, tasks = heads_of_listing(listing, bytes_per_task)
    tagged = tagged_records(examine(heads), channel, tasks)
    outcome = F.when(F.col("read_error").isNull(), "record").otherwise("failure")
    tagged.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(target)
    stored = spark.read.schema(T.StructType([*tagged.schema.fields, T.StructField("outcome", T.StringType())])).parquet(target)
    records = stored.where("outcome = 'record'").drop("outcome", "read_error")
    failures = stored.where("outcome = 'failure'").select("path", F.col("read_error").alias("message"))
    return records, unlisted.unionByName(header_errors(heads)).unionByName(_failures(failures))


def collect_logs(
    spark: SparkSession,
    roots: Sequence[str],
    catalog: DataFrame,
    host: str | Column,
    system_root: str | None = None,
    acquisition: str = "ImageRead",
    bytes_per_task: int = 128 << 20,
) -> tuple[DataFrame, DataFrame]:
    """(enriched records, errors) of every evtx log the catalog finds below ``roots``.

    Evidence of many hosts is one run: ``host`` is then an expression of ``path``, each of whose values is
    a body of evidence of its own. Only located files are opened: first their headers, by as many tasks
    as their number asks for, then their chunks by byte range.
    """
    listing, root_errors = list_roots(spark, roots)
    patterns, pattern_errors = expand_patterns(catalog, system_root)
    key = None
    if isinstance(host, Column):
        listing, key = listing.withColumn(_HOST, host), F.col(_HOST)
    located = locate_logs(listing, patterns, evidence=key)
    errors = root_errors.unionByName(pattern_errors)
    return _collected(located, errors, key if key is not None else host, acquisition, bytes_per_task)


def collect_evidence(
    spark: SparkSession,
    bodies: Sequence[tuple[str, str, str | None]],
    catalog: DataFrame,
    acquisition: str = "ImageRead",
    bytes_per_task: int = 128 << 20,
) -> tuple[DataFrame, DataFrame]:
    """``collect_logs`` for ``bodies`` of evidence (root, host, system root), each with a system root of its own.

    A file belongs to the body with the longest root above it, so one root may lie below another. The bodies are
    named on the driver, as the roots of any listing are.
    """
    rows = [(q, host, system) for root, host, system in bodies for q in given_paths(spark, root)[0]]
    listing, root_errors = list_roots(spark, [root for root, _, _ in bodies])
    listing = listing.dropDuplicates(["path"])  # nested roots list a file more than once
    owned = bodies_of_evidence(listing, spark.createDataFrame(rows, "root string, host string, system_root string"))
    owned = owned.withColumnsRenamed({"host": _HOST, "system_root": _SYSTEM_ROOT})
    patterns, pattern_errors = expand_patterns(catalog, by_host=True)
    located = locate_logs(owned, patterns, evidence=F.col(_HOST), system_root=F.col(_SYSTEM_ROOT)).drop(_SYSTEM_ROOT)
    errors = root_errors.dropDuplicates(["path"]).unionByName(pattern_errors)
    return _collected(located, errors, F.col(_HOST), acquisition, bytes_per_task)


def _collected(located: DataFrame, found: DataFrame, host, acquisition: str, bytes_per_task: int):
    heads, tasks = heads_of_listing(held(located), bytes_per_task)
    records = records_of(tagged_records(examine(heads, ("evtx",)), None, tasks))
    return enrich(records, host, acquisition), found.unionByName(read_errors(heads, ("evtx",)))
