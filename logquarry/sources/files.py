"""Where log bytes come from: listings, whole files, byte ranges, and what format they hold."""

from __future__ import annotations

import fnmatch
import re
import sys
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.binary import u32_sql
from ..functions.levels import lookup_sql
from .storage import FileCursor, list_folder, repeat_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the formats. The magic is the text ElfFile and a NUL.
EVTX_FILE_MAGIC_HEX = "456C6646696C6500"
EVTX_HEADER_SIZE = 4096
EVTX_CHUNK_SIZE = 65536
EVT_HEADER_SIZE = 48
EVT_SIGNATURE = 0x654C664C

ERROR_SCHEMA = "path string, stage string, message string"
RANGE_CHUNKS = 256  # 16 MiB of log per task unit


LISTING_SCHEMA = "path string, length bigint, modificationTime timestamp"


def given_paths(spark: SparkSession, path: str | Sequence[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """The files and folders that the given paths name, and those that match nothing, each with what is wrong."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    units, missing = [], []
    for given in [path] if isinstance(path, str) else path:
        try:
            pattern = jvm.org.apache.hadoop.fs.Path(given)
            found = pattern.getFileSystem(conf).globStatus(pattern)
        except Py4JJavaError as problem:
            found, reason = None, str(problem.java_exception)
        else:
            reason = f"Path does not exist: {given}"
        if not found:
            missing.append((given, reason))
        units += [status.getPath().toString() for status in found or []]
    return units, missing


def name_pattern(glob: str | None):
    """The glob of a file name as a regular expression; ``{a,b}`` are alternatives."""
    if glob is None:
        return re.compile("", re.S)
    choice = re.search(r"\{([^{}]*)\}", glob)
    if choice is None:
        return re.compile(fnmatch.translate(glob))
    parts = [name_pattern(glob[: choice.start()] + x + glob[choice.end() :]).pattern for x in choice[1].split(",")]
    return re.compile("|".join(parts))


_LISTED = f"{LISTING_SCHEMA}, problem string, is_folder boolean"


def _list(folders: DataFrame, glob: str | None, below: bool) -> DataFrame:
    """``_LISTED`` rows of what lies in each of ``folders(path)``, and with ``below`` of all that lies below. A folder
    that cannot be listed, and a link to one, is a row with its problem: links are followed nowhere."""

    def run(batches):
        matches = name_pattern(glob)
        types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.bool_()]
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                open_, rows = [unit], []
                while open_:
                    folder = open_.pop()
                    try:
                        for found, kind, size, time in list_folder(folder):
                            if kind == "file":
                                if matches.match(found.rpartition("/")[2]):
                                    rows.append((found, size, time, None, False))
                            elif kind == "link":
                                rows.append((found, None, None, "a link to a folder is not followed", False))
                            elif below:
                                open_.append(found)
                            else:
                                rows.append((found, None, None, None, True))
                    except OSError as problem:
                        rows.append((folder, None, None, str(problem), False))
                    if len(rows) >= 10_000 or not open_:
                        columns = [pa.array(x, t) for x, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
                        yield pa.RecordBatch.from_arrays(columns, ["path", "length", "modificationTime", "problem", "is_folder"])
                        rows = []

    return folders.mapInArrow(run, _LISTED)


def _walk(spark: SparkSession, units: list[str], glob: str | None) -> DataFrame:
    """``LISTING_SCHEMA`` and ``problem`` of all files of the units, whatever their names.

    Folders are opened in rounds, each a job over those the last one found, until there are enough of them for the
    tasks; these then walk what lies below. The driver sees the numbers of folders, not their names.
    """
    wanted = 4 * spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(unit,) for unit in units], "path string").repartition(max(1, min(len(units), wanted)))
    parts = []
    for _ in range(4):
        level = held(_list(folders, glob, below=False))
        parts.append(level.where("not is_folder"))
        folders = level.where("is_folder").select("path")
        count = folders.count()
        if not count or count >= wanted:
            break
        folders = folders.repartition(count)
    if count:
        parts.append(_list(folders.repartition(wanted), glob, below=True))
    return reduce(DataFrame.unionByName, parts).drop("is_folder")


def list_logs(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file below ``path``, whatever its name; none is opened.

    Tasks walk the folders. Fails on a path that matches nothing; folders below it that cannot be listed,
    and links to folders, are left out here, see ``list_roots``.
    """
    return list_below(spark, path, glob)[0]


def list_below(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``list_logs``, and one error row for each folder below that cannot be listed and each link to a folder."""
    units, missing = given_paths(spark, path)
    if missing:
        raise FileNotFoundError(missing[0][1])
    return _listing_and_errors(held(_walk(spark, units, glob)))


def _listing_and_errors(walked: DataFrame) -> tuple[DataFrame, DataFrame]:
    unlisted = walked.where("problem is not null").select("path", F.lit("locate").alias("stage"), F.col("problem").alias("message"))
    return walked.where("problem is null").drop("problem"), unlisted


def read_logs(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime, content), one row per file of up to 2 GiB.

    Use it for collections of ordinary logs; ``list_logs`` with ``read_heads`` and ``read_chunks`` reads byte
    ranges instead and has no size limit. A file that cannot be read, or is larger, has no content: one
    row of ``header_errors``.
    """

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            for row, (file, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                try:
                    content = cursor.read(file, 0, size) if size < 1 << 31 else None
                except OSError:
                    cursor.close()
                    content = None
                columns = [*batch.slice(row, 1).columns, pa.array([content], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "content"])
        cursor.close()

    return list_logs(spark, path, glob).mapInArrow(run, f"{LISTING_SCHEMA}, content binary")


def list_roots(spark: SparkSession, roots: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Listing of all roots, and one error row for each root and each folder below that cannot be listed, and for
    each link to a folder."""
    units, missing = given_paths(spark, roots)
    listing, unlisted = _listing_and_errors(held(_walk(spark, units, None)))
    failed = spark.createDataFrame([(root, "locate", reason) for root, reason in missing], ERROR_SCHEMA)
    return listing, failed.unionByName(unlisted)


def _format_sql(head: str) -> str:
    return f"""case
      when substring({head}, 1, 8) = X'{EVTX_FILE_MAGIC_HEX}' then 'evtx'
      when octet_length({head}) >= {EVT_HEADER_SIZE} and {u32_sql(head, 0)} = {EVT_HEADER_SIZE}
        and {u32_sql(head, 4)} = {EVT_SIGNATURE} then 'evt'
    end"""


def detect_format(files: DataFrame) -> DataFrame:
    """Adds ``format`` (evtx, evt or NULL) from the first bytes, never from the file name."""
    if "head" in files.columns:
        return files.withColumn("format", F.expr(_format_sql("head")))
    probe = files.withColumn("_probe", F.substring("content", 1, EVT_HEADER_SIZE))
    return probe.withColumn("format", F.expr(_format_sql("_probe"))).drop("_probe")


def heads_of(files: DataFrame) -> DataFrame:
    """Replaces ``content`` by ``head``, the first 4096 bytes."""
    return files.withColumn("head", F.substring("content", 1, EVTX_HEADER_SIZE)).drop("content")


def read_heads(listing: DataFrame) -> DataFrame:
    """Adds ``head`` (first 4096 bytes) and ``read_error`` by reading only those bytes."""

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            heads, errors = [], []
            for path in batch.column("path").to_pylist():
                try:
                    heads.append(cursor.read(path, 0, EVTX_HEADER_SIZE))
                    errors.append(None)
                except OSError as problem:
                    cursor.close()
                    heads.append(None)
                    errors.append(str(problem))
            columns = [*batch.columns, pa.array(heads, pa.binary()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names, "head", "read_error"]
            )
        cursor.close()

    schema = T.StructType(
        [*listing.schema.fields, T.StructField("head", T.BinaryType()), T.StructField("read_error", T.StringType())]
    )
    return listing.mapInArrow(run, schema)


def held(frame: DataFrame) -> DataFrame:
    """The rows of a listing or of heads, worked out once and kept by the executors; lost ones are worked out again."""
    return frame.persist()


def slot_count(length: Column) -> Column:
    """Chunk slots of a log by its length; a trailing part of a chunk does not count."""
    slots = F.call_function("div", length - EVTX_HEADER_SIZE, F.lit(EVTX_CHUNK_SIZE))
    return F.greatest(slots, F.lit(0)).cast("int")


def split_chunks(files: DataFrame) -> DataFrame:
    """One row per 64 KiB slot of in-memory evtx files: (..., chunk_index, chunk).

    Only slot numbers are exploded; the slice happens in the same codegen stage, so no array of
    chunk copies is built. No shuffle: spread large single files with ``read_chunks`` instead.
    """
    carried = [c for c in files.columns if c != "content"]
    slots = F.octet_length("content") if "length" not in files.columns else F.col("length")
    indexed = files.where(slot_count(slots) > 0).select(
        *carried,
        "content",
        F.explode(F.sequence(F.lit(0), slot_count(slots) - 1)).alias("chunk_index"),
    )
    start = F.col("chunk_index") * EVTX_CHUNK_SIZE + (EVTX_HEADER_SIZE + 1)
    return indexed.select(
        *carried,
        "chunk_index",
        F.substring("content", start, F.lit(EVTX_CHUNK_SIZE)).alias("chunk"),
    )


def read_chunks(
    heads: DataFrame, partitions: int | None = None, range_chunks: int = RANGE_CHUNKS
) -> DataFrame:
    """One row per 64 KiB slot of stored evtx files, read by byte ranges.

    Only range descriptors are shuffled, never log bytes, so one huge log spreads over many tasks.
    """
    carried = [c for c in heads.columns if c not in ("head", "read_error", "modificationTime")]
    slots = slot_count(F.col("length"))
    ranges = heads.where(slots > 0).select(
        *carried,
        slots.alias("_slots"),
        F.explode(F.sequence(F.lit(0), slots - 1, F.lit(range_chunks))).alias("_first"),
    )
    # AQE would merge these tiny rows into one task; an explicit count keeps them spread.
    ranges = ranges.repartition(partitions or range_partitions(heads.sparkSession))

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            keep = batch.select(carried)
            paths = batch.column("path").to_pylist()
            firsts, ends = batch.column("_first").to_pylist(), batch.column("_slots").to_pylist()
            for row, (path, first, slots_here) in enumerate(zip(paths, firsts, ends)):
                for start in range(first, min(first + range_chunks, slots_here), 64):
                    stop = min(start + 64, first + range_chunks, slots_here)
                    data = cursor.read(
                        path,
                        EVTX_HEADER_SIZE + EVTX_CHUNK_SIZE * start,
                        EVTX_CHUNK_SIZE * (stop - start),
                    )
                    view = memoryview(data)
                    chunks = [
                        view[i * EVTX_CHUNK_SIZE : (i + 1) * EVTX_CHUNK_SIZE]
                        for i in range(len(data) // EVTX_CHUNK_SIZE)
                    ]
                    if len(chunks) < stop - start:
                        raise OSError(f"{path} became shorter while it was read")
                    yield pa.RecordBatch.from_arrays(
                        [
                            *repeat_rows(keep, [row] * len(chunks)),
                            pa.array(range(start, stop), pa.int32()),
                            pa.array(chunks, pa.binary()),
                        ],
                        names=[*carried, "chunk_index", "chunk"],
                    )
        cursor.close()

    schema = T.StructType(
        [
            *[f for f in heads.schema.fields if f.name in carried],
            T.StructField("chunk_index", T.IntegerType()),
            T.StructField("chunk", T.BinaryType()),
        ]
    )
    return ranges.mapInArrow(run, schema)


def range_partitions(spark: SparkSession) -> int:
    """Tasks for range reads where no size is known: never fewer than the shuffle setting."""
    cores = spark.sparkContext.defaultParallelism
    return max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))


def task_count(listing: DataFrame, bytes_per_task: int = 128 << 20) -> int:
    """Tasks for reading the listed files: a small job over their sizes. Their number follows the bytes."""
    total = listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    cores = listing.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-int(total) // bytes_per_task))


# The channel a legacy log belongs to, by its file name.
EVT_CHANNELS = {
    "appevent.evt": "Application",
    "secevent.evt": "Security",
    "sysevent.evt": "System",
}


def base_name(path: Column) -> Column:
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def with_channel(
    files: DataFrame, channel: str | None = None, names: dict[str, str] = EVT_CHANNELS
) -> DataFrame:
    """Adds the ``channel`` of legacy logs: the given one, else by lower-cased file name, else empty."""
    if channel is not None:
        return files.withColumn("channel", F.lit(channel))
    name = F.lower(base_name(F.col("path")))
    by_name = F.expr(lookup_sql("_name", names))
    named = files.withColumn("_name", name)
    return named.withColumn("channel", F.coalesce(by_name, F.lit(""))).drop("_name")
