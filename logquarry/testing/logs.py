"""The ``events`` table as event logs: as records (a projection) and as log bytes (a Spark job)."""

from __future__ import annotations

import struct
import sys
from collections import namedtuple

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.binary import timestamp_to_filetime
from ..functions.levels import normalise_level
from ..sources.storage import open_file, read_range, resolve
from .writer import ChunkWriter, El, Filled, Hole, Slot, Value, evt_file, evt_record, evtx_file, sid_bytes, text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 3000  # event ids per host: bounds every log, so the number of logs grows with the data
PER_CHUNK = 60  # records per chunk
CHANNELS = {
    "error": "Security",
    "click": "Application",
    "view": "System",
    "purchase": "Microsoft-Windows-Sysmon/Operational",
    "signup": "Windows PowerShell",
}
_BLOCK = 4096  # of local file systems
_ZEROS = bytes(_BLOCK)
FILES_SCHEMA = "path string, length bigint, content binary"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def channel_of(event_type: Column) -> Column:
    return F.coalesce(*[F.when(event_type == k, v) for k, v in CHANNELS.items()], F.lit(""))


def path_of(event_id: Column, channel: Column, extension: str = "evtx") -> Column:
    """Hosts with an even number keep the system layout, the others a copied, flat one."""
    host = F.call_function("div", event_id, F.lit(BLOCK))
    folder = F.when(host % 2 == 0, "/Windows/System32/winevt/Logs/").otherwise("/CopiedFiles/eventlogs/Logs/")
    name = F.replace(channel, F.lit("/"), F.lit("%4"))
    return F.concat(F.lit("/evidence/host"), host.cast("string"), folder, name, F.lit("." + extension))


def _event_columns() -> dict[str, Column]:
    event_id, kind = F.col("event_id"), F.col("event_type")
    return {
        "path": path_of(event_id, channel_of(kind)),
        "record_id": event_id,
        "code": F.lit(4624) + event_id % 2,
        "timestamp": F.col("ts").cast("timestamp"),
        "channel": channel_of(kind),
        "provider": F.concat(F.lit("provider-"), kind),
        "level_text": (event_id % 7).cast("string"),
        "computer": F.concat(F.lit("HOST"), (F.col("user_id") % 10).cast("string")),
        "user_sid": F.when(event_id % 11 != 0, F.concat(F.lit("S-1-5-21-"), F.col("user_id").cast("string"))),
        "cents": F.round(F.col("value") * 100).cast("bigint").cast("string"),
        "props": F.col("props"),
        "k": F.regexp_extract("props", "[0-9]+", 0),
    }


def event_records(events: DataFrame) -> DataFrame:
    """``events`` in the columns of decoded records, without any log bytes."""
    base = events.select([c.alias(n) for n, c in _event_columns().items()])
    position = F.row_number().over(Window.partitionBy("path").orderBy("record_id")) - 1
    return base.select(
        "path",
        F.lit("evtx").alias("format"),
        F.call_function("div", position, F.lit(PER_CHUNK)).cast("int").alias("chunk_index"),
        (position % PER_CHUNK).cast("int").alias("record_index"),
        "record_id",
        F.col("code").alias("event_id"),
        "timestamp",
        "provider",
        "channel",
        "computer",
        normalise_level("level_text").alias("level"),
        "level_text",
        "user_sid",
        F.create_map(
            F.lit("winlog.event_data.cents"), F.col("cents"),
            F.lit("winlog.event_data.props"), F.col("props"),
            F.lit("winlog.user_data.EventXML.K"), F.col("k"),
        ).alias("data"),
        F.lit(None).cast("string").alias("decode_error"),
    )


# -- modern logs ---------------------------------------------------------------------------------

_SYSTEM_SLOTS = El(
    "System",
    El("Provider", Name=Slot(0)),
    El("EventID", Slot(1, kind=0x06)),
    El("Level", Slot(2, kind=0x04)),
    El("Channel", Slot(3)),
    El("Computer", Slot(4)),
    El("Security", UserID=Slot(5, optional=True, kind=0x13)),
)
TEMPLATE = El(
    "Event",
    _SYSTEM_SLOTS,
    Slot(6, kind=0x21),
    El("UserData", El("EventXML", El("K", Slot(7)))),
)


class Known(dict):
    """The texts of one log as values, each made once."""

    def __missing__(self, value: str) -> Value:
        self[value] = made = text(value)
        return made


class KnownSids(dict):
    """The same of users."""

    def __missing__(self, value: str) -> Value:
        self[value] = made = Value(0x13, sid_bytes(value))
        return made


class KnownBytes(dict):
    """The same as bytes with the type code ahead."""

    def __missing__(self, value: str) -> bytes:
        self[value] = made = text(value).standalone()
        return made


_BODIES = El("EventData", El("Data", Hole(0), Name=text("cents")), El("Data", Hole(1), Name=text("props")))


def _bodies(row, texts: KnownBytes) -> Filled:
    return Filled(_BODIES, [texts[row.cents], texts[row.props]])


def _plain_document(body: El, first: int, **security) -> El:
    """A whole event around its data; ``first`` is the number of its first own value."""
    provider, code, level, channel, computer, k = map(Hole, range(first, first + 6))
    return El(
        "Event",
        El(
            "System",
            El("Provider", Name=provider),
            El("EventID", code),
            El("Level", level),
            El("Channel", channel),
            El("Computer", computer),
            El("Security", **security),
        ),
        body,
        El("UserData", El("EventXML", El("K", k))),
    )


def _plain_documents(body: El, first: int) -> tuple[El, El]:
    """Without and with a user."""
    return _plain_document(body, first), _plain_document(body, first, UserID=Hole(first + 6))


def _plain(row, event_data: Filled, documents: tuple[El, El], texts: KnownBytes) -> Filled:
    values = [row.provider, str(row.code), row.level_text, row.channel, row.computer, row.k]
    if row.user_sid is not None:
        values.append(row.user_sid)
    return Filled(documents[row.user_sid is not None], [*event_data.values, *[texts[v] for v in values]])


def _instance_values(row, event_data: Filled, texts: Known, sids: KnownSids) -> list:
    sid = Value(0x00) if row.user_sid is None else sids[row.user_sid]
    return [
        texts[row.provider],
        Value(0x06, row.code.to_bytes(2, "little")),
        Value(0x04, bytes([int(row.level_text)])),
        texts[row.channel],
        texts[row.computer],
        sid,
        event_data,
        texts[row.k],
    ]


_FREE_SLOT = 8  # the first that TEMPLATE doesn't use
# Values that need a declared size: they can only be substitutions.
_SIZED = {"int16s": 0x85, "uint32s": 0x88, "texts": 0x81, "none": 0x81, "size4": 0x10}
_INLINE = ["int8", "uint8", "int16", "uint16", "int32", "uint32", "int64", "uint64", "real32", "real64", "bool", "binary",
           "guid", "size", "filetime", "sid", "hex32", "hex64", "ansi", "null", "systime"]
_TYPED = El(
    "EventData",
    *[El("Data", Hole(place), Name=text(k)) for place, k in enumerate(_INLINE)],
    *[El("Data", Slot(place, kind=kind), Name=text(k)) for place, (k, kind) in enumerate(_SIZED.items(), _FREE_SLOT)],
)


_AUTHORITY = (5).to_bytes(6, "big")


def _typed(row, _texts: KnownBytes) -> Filled:
    """One Data per value type, all derived from the record id and its time."""
    n, pack, ansi = row.record_id, struct.pack, row.props.encode()
    return Filled(_TYPED, [
        pack("<Bb", 0x03, n % 256 - 128),
        pack("<BB", 0x04, n % 256),
        pack("<Bh", 0x05, -(n % 30000)),
        pack("<BH", 0x06, n % 65536),
        pack("<Bi", 0x07, -n),
        pack("<BI", 0x08, n),
        pack("<Bq", 0x09, -n * 1_000_000_007),
        pack("<BQ", 0x0A, n * 1_000_000_007),
        pack("<Bf", 0x0B, n / 4),
        pack("<Bd", 0x0C, int(row.cents) / 100),
        pack("<BI", 0x0D, n % 2),
        pack("<BI", 0x0E, 4) + pack(">I", n),
        pack("<BIHH8s", 0x0F, n, n % 65536, 7, bytes(range(8))),
        pack("<BQ", 0x10, n),
        pack("<BQ", 0x11, row.filetime),
        pack("<BBB6sII", 0x13, 1, 2, _AUTHORITY, 21, n),
        pack("<BI", 0x14, n),
        pack("<BQ", 0x15, n),
        pack("<BH", 0x02, len(ansi)) + ansi,
        b"\x00",
        pack("<B8H", 0x12, 2024, 2, 4, 29, n % 24, n % 60, 7, n % 1000),
    ])


def _sized(row) -> list[Value]:
    n, pack = row.record_id, struct.pack
    data = [
        pack("<3h", -(n % 30000), 0, n % 7),
        pack("<2I", n, 4_294_967_295),
        f"a,{n}\0\0b\0".encode("utf-16-le"),
        b"",
        pack("<I", n),
    ]
    return [Value(kind, each) for kind, each in zip(_SIZED.values(), data)]


_ODD_DATA = El(
    "EventData",
    El("Data", text("first"), Name=text("A")),
    El("Data", Hole(0)),
    El("Data", Hole(1), Name=text("A")),
    El("Binary", Hole(2)),
)


def _odd_data(row, texts: KnownBytes) -> Filled:
    """A repeated name, an unnamed Data and the Binary element."""
    binary = Value(0x0E, struct.pack(">I", row.record_id)).standalone()
    return Filled(_ODD_DATA, [texts[row.props], texts[row.cents], binary])


# Whole events around their data: the document without a user, and with one.
_PLAIN_BODIES, _PLAIN_TYPED, _PLAIN_ODD = (
    _plain_documents(body, count) for body, count in ((_BODIES, 2), (_TYPED, len(_INLINE)), (_ODD_DATA, 3))
)


def _hostile(writer: ChunkWriter, number: int):
    """Content built to never end: an array of Null, a template inside itself, a huge count."""
    buf = writer.buf
    buf += b"\x0f\x01\x01\x00"
    if number % 3 == 0:
        # The unique key keeps the definition inside this record.
        writer.instance(("null array", number), El("Event", Slot(0)), [Value(0x80, b"\0\0\0\0")])
    elif number % 3 == 1:
        at = len(buf) + 10
        inner = struct.pack("<BBIII", 0x0C, 1, 7, at, 0) + b"\0"
        buf += struct.pack("<BBIII16xI", 0x0C, 1, 7, at, 0, len(inner)) + inner + struct.pack("<I", 0)
    else:
        at = len(buf) + 10
        buf += struct.pack("<BBIII16xI", 0x0C, 1, 7, at, 0, 1) + b"\0" + struct.pack("<I", 0xFFFFFFFF)
    buf.append(0x00)


def _rows(group: pa.Table, order: str) -> list[tuple]:
    """The rows of one log by their ids."""
    group = group.sort_by(order)
    return list(map(namedtuple("Row", group.column_names)._make, zip(*map(_items, group.columns))))


def _items(column: pa.ChunkedArray) -> list:
    # Integers with a null among them would become floats.
    if column.null_count and not pa.types.is_string(column.type):
        return column.to_pylist()
    return column.to_numpy().tolist()


def _file(path: str, log: bytes) -> pa.Table:
    columns = [pa.array([path], pa.string()), pa.array([len(log)], pa.int64()), pa.array([log], pa.binary())]
    return pa.table(columns, names=["path", "length", "content"])


def _write_log(rows: list[tuple], variant: frozenset) -> bytes:
    templated = "templated" in variant
    shape, documents = _bodies, _PLAIN_BODIES
    if "typed" in variant:
        shape, documents = _typed, _PLAIN_TYPED
    elif "odd_data" in variant:
        shape, documents = _odd_data, _PLAIN_ODD
    texts, values, sids = KnownBytes(), Known(), KnownSids()
    chunks = []
    per_chunk = PER_CHUNK // 3 if "typed" in variant else PER_CHUNK
    for start in range(0, len(rows), per_chunk):
        writer, number = ChunkWriter(), start // per_chunk
        group = rows[start : start + per_chunk]
        for position, row in enumerate(group):

            def content(w, row=row):
                if "bad_records" in variant and row.record_id % 50 == 0:
                    w.buf += b"\x0f\x01\x01\x00\x04\x00"
                elif "no_root" in variant and row.record_id % 50 == 0:
                    w.fragment(El("Other", text("x")))
                elif "hostile" in variant and row.record_id % 50 == 0:
                    _hostile(w, row.record_id // 50)
                elif templated:
                    w.buf += b"\x0f\x01\x01\x00"
                    sized = _sized(row) if shape is _typed else ()
                    w.instance(row.channel, TEMPLATE, [*_instance_values(row, shape(row, texts), values, sids), *sized])
                    w.buf.append(0x00)
                else:
                    w.fragment(_plain(row, shape(row, texts), documents, texts))

            broken = "broken_frames" in variant and number == 1 and position == len(group) - 1
            writer.record(row.record_id, row.filetime, content, broken)
        chunks.append(writer.finish(start + 1, "bad_checksums" in variant and number % 2 == 1))
    if "unwritten" in variant:
        chunks.append(bytes(65536))
    log = evtx_file(chunks, rows[-1].record_id + 1, flags=1 if "dirty" in variant else 0,
                    bad_checksum="bad_header" in variant)
    return log[:-30_000] if "cut" in variant else log


def evtx_logs(events: DataFrame, *variant: str) -> DataFrame:
    """``events`` as evtx files (path, length, content): one log per host and channel.

    Variants: templated, typed, odd_data, bad_records, no_root, hostile, broken_frames,
    bad_checksums, bad_header, dirty, unwritten, cut.
    """
    options = frozenset(variant)
    rows = events.select(
        *[c.alias(n) for n, c in _event_columns().items() if n != "timestamp"],
        timestamp_to_filetime("cast(ts as timestamp)").alias("filetime"),
    )

    def encode(group: pa.Table) -> pa.Table:
        rows = _rows(group, "record_id")
        return _file(rows[0].path, _write_log(rows, options))

    return _spread(rows).groupBy("path").applyInArrow(encode, FILES_SCHEMA)


def _spread(rows: DataFrame) -> DataFrame:
    """One shuffle by log with a fixed task count: AQE would merge the small rows into one task."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism,
                int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, "path")


# -- legacy logs -----------------------------------------------------------------------------------

EVT_NAMES = {"error": "SecEvent", "click": "AppEvent", "view": "SysEvent"}  # others keep their type


def evt_path_of(event_id: Column, event_type: Column) -> Column:
    host = F.call_function("div", event_id, F.lit(BLOCK)).cast("string")
    name = F.coalesce(*[F.when(event_type == k, v) for k, v in EVT_NAMES.items()], event_type)
    return F.concat(F.lit("/evidence/host"), host, F.lit("/Windows/System32/config/"), name, F.lit(".evt"))


def evt_logs(events: DataFrame, *variant: str) -> DataFrame:
    """``events`` as legacy files. Variants: bad_signature (ids divisible by 100), wrapped."""
    options = frozenset(variant)
    rows = events.select(
        evt_path_of(F.col("event_id"), F.col("event_type")).alias("path"),
        "event_id",
        "event_type",
        "user_id",
        "props",
        F.unix_seconds(F.date_trunc("second", F.col("ts").cast("timestamp"))).alias("seconds"),
    )

    def encode(group: pa.Table) -> pa.Table:
        rows, records = _rows(group, "event_id"), []
        for row in rows:
            n = row.event_id
            bad = "bad_signature" in options and n % 100 == 0
            records.append(
                evt_record(
                    n, row.seconds, row.seconds + 1, 0x40000000 + 4624 + n % 2, 1 << n % 5, n % 9,
                    "provider-" + row.event_type, f"HOST{row.user_id % 10}",
                    b"" if n % 11 == 0 else sid_bytes(f"S-1-5-21-{row.user_id}"),
                    [] if n % 13 == 0 else [row.event_type, row.props],
                    b"" if n % 3 == 0 else struct.pack(">I", n),
                    0 if bad else 0x654C664C,
                )
            )
        first = rows[0].event_id
        log = evt_file(records, first, 2, start=4096, end=48) if "wrapped" in options else evt_file(records, first)
        return _file(rows[0].path, log)

    return _spread(rows).groupBy("path").applyInArrow(encode, FILES_SCHEMA)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes ``content`` under ``folder`` (a folder all executors share) and lists what it wrote."""

    def run(batches):
        for batch in batches:
            written = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                target = f"{folder.rstrip('/')}/{path.lstrip('/')}"
                _write_file(target, content.as_buffer())
                written.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], names=["path"])

    return files.select("path", "content").mapInArrow(run, "path string")


def grow_files(parts: DataFrame, folder: str) -> DataFrame:
    """Puts ``content`` behind the first ``at`` bytes of the files under ``folder`` and lists them. A file is replaced as
    a whole, from a folder beside it, so a task may run again."""

    def run(batches):
        for batch in batches:
            grown = []
            for path, at, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                target, made = (f"{place.rstrip('/')}/{path.lstrip('/')}" for place in (folder, f"{folder.rstrip('/')}-growing"))
                with open_file(target) as file:
                    first = read_range(file, 0, at)
                if len(first) < at:
                    raise OSError(f"{target} has {len(first)} bytes of {at}")
                _write_file(made, first + content.as_py())
                resolve(target)[0].move(resolve(made)[1], resolve(target)[1])
                grown.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(grown, pa.string())], names=["path"])

    return parts.select("path", "at", "content").mapInArrow(run, "path string")


def _write_file(target: str, content):
    """Chunks are zeros behind their last record. Local files leave out whole blocks of these, so they take no disk."""
    system, location = resolve(target)
    system.create_dir(location.rpartition("/")[0], recursive=True)
    if not isinstance(system, fs.LocalFileSystem):
        with system.open_output_stream(location) as out:
            out.write(content)
        return
    data, start = bytes(content), 0
    with open(location, "wb") as out:
        for at in range(0, len(data) + _BLOCK, _BLOCK):
            if at >= len(data) or data.startswith(_ZEROS, at):
                if start < at:
                    out.seek(start)
                    out.write(data[start:at])
                start = at + _BLOCK
        out.truncate(len(data))
