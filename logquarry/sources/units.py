"""The read job over stored logs: byte ranges in, event records out, in one pass over the bytes.

A unit is a range of 64 KiB slots of a modern log, or a stretch of records of a legacy one. Tasks read a unit,
check its checksums and decode it; log bytes never leave Python. What cannot be read becomes a row with
``read_error`` among the records, and the rest of the job goes on.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.binxml import ChunkDecoder, frame_records
from ..functions.evtrecords import Window, chains, log_bounds, walk
from .decode import DECODED_FIELDS, EVT_TYPE, RECORD_FIELDS, SYSTEM_FIELDS, TEXT, evt_struct, node_array
from .files import EVTX_CHUNK_SIZE, EVTX_HEADER_SIZE, RANGE_CHUNKS, range_partitions, slot_count
from .headers import CHUNK_HEADER_SIZE, EVTX_CHUNK_MAGIC_HEX
from .storage import FileCursor, repeat_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEP_CHUNKS = 64  # read at once
_ROWS_PER_BATCH = 4096
_WORK_PER_BATCH = 1 << 26
_LARGEST_SIGNED = (1 << 63) - 1
_CHUNK_MAGIC = bytes.fromhex(EVTX_CHUNK_MAGIC_HEX)
#: Larger legacy logs are read in ranges of so many bytes.
EVT_RANGE = RANGE_CHUNKS * EVTX_CHUNK_SIZE

UNIT_FIELDS = [
    T.StructField("_first", T.LongType()),  # slot, or byte of the first record (NULL: what the header says)
    T.StructField("_stop", T.LongType()),  # slot or byte after the unit (NULL: the end of the log)
    T.StructField("_index", T.IntegerType()),  # record_index of the first record of a legacy unit
]
UNIT_COLUMNS = [f.name for f in UNIT_FIELDS]
_PLACE_FIELDS = [
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("chunk_checksum_valid", T.BooleanType()),
]


# -- units -------------------------------------------------------------------------------------------------


def log_ranges(logs: DataFrame, range_chunks: int = RANGE_CHUNKS, evt_range: int = EVT_RANGE) -> DataFrame:
    """Units of readable logs ``(path, length, format, ...)``. Of a modern log with a length that was ``seen`` before, only
    the slots after it. Only large legacy logs are opened: their records have
    no fixed places, so tasks look for record starts in every range first."""
    slots = slot_count(F.col("length"))
    begin = slot_count(F.col("seen")) if "seen" in logs.columns else F.lit(0)
    modern = logs.where((F.col("format") == "evtx") & (slots > begin)).select(
        "*", slots.alias("_slots"), F.explode(F.sequence(begin, slots - 1, F.lit(range_chunks))).alias("_at")
    )
    none = F.lit(None)
    modern = modern.select(
        *logs.columns,
        F.col("_at").cast("long").alias("_first"),
        F.least(F.col("_at") + range_chunks, "_slots").cast("long").alias("_stop"),
        none.cast("int").alias("_index"),
    )
    legacy = logs.where("format = 'evt'")
    whole = legacy.select("*", *[none.cast(f.dataType).alias(f.name) for f in UNIT_FIELDS])
    if logs.isStreaming:  # a stream has no second pass; a window still bounds the memory
        return modern.unionByName(whole)
    small = whole.where(F.col("length") <= evt_range)
    return modern.unionByName(small).unionByName(evt_stretches(legacy.where(F.col("length") > evt_range), evt_range))


def evt_stretches(logs: DataFrame, size: int) -> DataFrame:
    """Units of large legacy logs. In each range of ``size`` bytes a task follows the records that may start there to
    where they leave it. From the start in the header, those pieces are put together."""
    names = logs.columns
    pieces = [T.StructField(n, T.LongType()) for n in ("_begin", "_end", "_entry", "_count", "_leads")]
    ranges = logs.withColumn("_range", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))))

    def look(batches):
        with_cursor = FileCursor()
        for batch in batches:
            paths, lengths, starts = (batch.column(n).to_pylist() for n in ("path", "length", "_range"))
            for row, (path, length, start) in enumerate(zip(paths, lengths, starts)):
                found = []
                try:
                    window = Window(length, lambda pos, size, path=path: with_cursor.read(path, pos, size))
                    bounds = log_bounds(window)
                    if bounds is not None and start < bounds[1]:
                        if start <= bounds[0] < start + size or start == 0:
                            found.append((*bounds, -1, 0, 0))  # where to begin
                        stop = min(start + size, bounds[1])
                        found += [(*bounds, *run) for run in chains(window, start, stop, bounds[1])]
                except OSError:  # the pass over the records meets it again
                    with_cursor.close()
                if found:
                    columns = [pa.array(values, pa.int64()) for values in zip(*found)]
                    kept = repeat_rows(batch.select(names), [row] * len(found))
                    yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *[f.name for f in pieces]])
        with_cursor.close()

    looked = ranges.repartition(range_partitions(logs.sparkSession)).mapInArrow(look, T.StructType([*logs.schema.fields, *pieces]))

    def stitch(group):
        begin, end = group.column("_begin")[0].as_py(), group.column("_end")[0].as_py()
        runs = {
            entry: (count, leads)
            for entry, count, leads in zip(*(group.column(n).to_pylist() for n in ("_entry", "_count", "_leads")))
        }
        units, pos, index = [], begin, 0
        while pos + 4 <= end:
            count, leads = runs.get(pos, (0, -1))
            if leads < 0:  # the log ends here, or no run begins at this record: one unit to the end
                units.append((pos, None, index))
                break
            units.append((pos, leads, index))
            pos, index = leads, index + count
        kinds = [to_arrow_type(f.dataType) for f in UNIT_FIELDS]
        columns = [pa.array(v, k) for v, k in zip(zip(*units), kinds)] if units else [pa.array([], k) for k in kinds]
        kept = group.select(names).take(pa.array([0] * len(units), pa.int64()))
        return pa.table([*kept.columns, *columns], names=[*names, *UNIT_COLUMNS])

    # A group has the runs of one log: at most 4 GiB / size ranges, in sound logs one run each.
    return looked.groupBy("path").applyInArrow(stitch, T.StructType([*logs.schema.fields, *UNIT_FIELDS]))


# -- records -----------------------------------------------------------------------------------------------


def chunk_valid(chunk) -> bool:
    """Whether both checksums of a chunk are right."""
    free, events_sum = struct.unpack_from("<II", chunk, 48)
    if not CHUNK_HEADER_SIZE <= free <= EVTX_CHUNK_SIZE or zlib.crc32(chunk[CHUNK_HEADER_SIZE:free]) != events_sum:
        return False
    header = zlib.crc32(chunk[128:CHUNK_HEADER_SIZE], zlib.crc32(chunk[:120]))
    return header == struct.unpack_from("<I", chunk, 124)[0]


def written_chunks(cursor: FileCursor, path: str, first: int, stop: int, every: bool = False):
    """(slot, bytes) of the slots of a modern log; those never written only with ``every``, as None."""
    for start in range(first, stop, _STEP_CHUNKS):
        count = min(_STEP_CHUNKS, stop - start)
        data = cursor.read(path, EVTX_HEADER_SIZE + EVTX_CHUNK_SIZE * start, EVTX_CHUNK_SIZE * count)
        for i in range(len(data) // EVTX_CHUNK_SIZE):
            chunk = data[i * EVTX_CHUNK_SIZE : (i + 1) * EVTX_CHUNK_SIZE]
            if chunk[:8] == _CHUNK_MAGIC:
                yield start + i, chunk
            elif every:
                yield start + i, None
        if len(data) < EVTX_CHUNK_SIZE * count:
            raise OSError("file became shorter while it was read")


class Wanted:
    """What a pass is to give. ``fields``: texts of these System fields instead of all nodes. ``channels`` and
    ``event_ids`` leave out records that surely have others; a few others may come through."""

    def __init__(self, fields: Sequence[str] | None, channels=None, event_ids=None, legacy_data: bool = True):
        self.legacy_data = legacy_data  # whether strings and data of legacy records are asked for
        self.fields = None if fields is None else tuple(fields)
        self.channels = None if channels is None else frozenset(channels)
        self.event_ids = None if event_ids is None else frozenset(event_ids)
        # A record that cannot be decoded has no channel and the event id 0. Only a full decode tells which do.
        defaults = (self.channels is None or "" in self.channels) and (self.event_ids is None or 0 in self.event_ids)
        self.filters = not defaults
        self.probe = (("Channel", "EventID") if self.filters else ())

    def rules_out(self, channel: str | None, event_id: str | None) -> bool:
        if self.channels is not None and "" not in self.channels and (channel or "") not in self.channels:
            return True
        if self.event_ids is None or 0 in self.event_ids or event_id is None:
            return False
        return event_id.isascii() and event_id.isdigit() and int(event_id) not in self.event_ids


class _Rows:
    """Collects records into batches."""

    def __init__(self, keep: pa.RecordBatch, fields: list[T.StructField], wanted: Wanted):
        self.keep, self.wanted = keep, wanted
        self.kinds = {f.name: to_arrow_type(f.dataType) for f in fields}
        self.rows, self.values, self.nodes, self.offsets, self.evts, self.size = [], [], [], [0], [], 0

    def add(self, row: int, place: tuple, record: tuple, texts=None, evt=None, error=None, work: int = 0):
        self.rows.append(row)
        self.values.append((*place, *record, error, *(texts or (None,) * len(self.wanted.fields or ()))))
        self.offsets.append(len(self.nodes))
        self.evts.append(evt)
        self.size += work

    @property
    def full(self) -> bool:
        return len(self.rows) >= _ROWS_PER_BATCH or self.size > _WORK_PER_BATCH

    def batch(self) -> pa.RecordBatch:
        texts = [TEXT + f for f in self.wanted.fields or ()]
        names = ["chunk_index", "chunk_checksum_valid", "record_index", "record_id", "filetime", "decode_error", "read_error", *texts]
        columns = {n: pa.array(v, self.kinds[n]) for n, v in zip(names, zip(*self.values))}
        if self.wanted.fields is None:
            columns["nodes"] = node_array(self.nodes, self.offsets)
        columns["evt"] = evt_struct(self.evts)
        kept = repeat_rows(self.keep, self.rows)
        out = pa.RecordBatch.from_arrays(
            [*kept, *[columns[n] for n in self.kinds]], names=[*self.keep.schema.names, *self.kinds]
        )
        self.rows, self.values, self.offsets, self.evts, self.size = [], [], [0], [], 0
        self.nodes.clear()
        return out


def _modern(rows: _Rows, row: int, cursor: FileCursor, path: str, first: int, stop: int, wanted: Wanted):
    paths = [(f"Event[0]/System[0]/{SYSTEM_FIELDS[f][0]}[0]", SYSTEM_FIELDS[f][1]) for f in wanted.fields or ()]
    for slot, chunk in written_chunks(cursor, path, first, stop):
        place, decoder = (slot, chunk_valid(chunk)), ChunkDecoder(chunk, rows.nodes)
        for index, (record_id, ticks, start, end) in enumerate(frame_records(chunk)):
            if wanted.filters:
                known = decoder.system_texts(start, end, wanted.probe)
                if known is not None and wanted.rules_out(*known):
                    continue
            at = len(rows.nodes)
            error, texts = decoder.decode(start, end), None
            if wanted.fields is not None:
                found = {node[0]: node for node in rows.nodes[at:]}
                del rows.nodes[at:]
                texts = [_text(found.get(p), attribute) for p, attribute in paths]
            if record_id > _LARGEST_SIGNED or ticks > _LARGEST_SIGNED:
                error = error or f"header value out of range: id {record_id}, time {ticks}"
                record_id = record_id if record_id <= _LARGEST_SIGNED else None
                ticks = ticks if ticks <= _LARGEST_SIGNED else None
            rows.add(row, place, (index, record_id, ticks, error), texts, work=decoder.work_done)
            if rows.full:
                yield rows.batch()


def _text(node: tuple | None, attribute: str | None) -> str | None:
    if node is None:
        return None
    return node[3] if attribute is None else dict(node[2]).get(attribute)


def _legacy(rows: _Rows, row: int, cursor: FileCursor, path: str, length: int, unit: tuple, wanted: Wanted):
    window = Window(length, lambda pos, size: cursor.read(path, pos, size))
    bounds = log_bounds(window)
    if bounds is None:
        return
    first, stop, index = unit
    for after, record, used in walk(window, bounds[0] if first is None else first, bounds[1]):
        if wanted.event_ids is None or record[3] & 0xFFFF in wanted.event_ids:
            if not wanted.legacy_data:
                record = (*record[:9], [], b"")
            rows.add(row, (0, None), (index or 0, None, None, None), evt=record, work=used)
            if rows.full:
                yield rows.batch()
        index = (index or 0) + 1
        if stop is not None and after >= stop:
            return


def read_units(units: DataFrame, wanted: Wanted | None = None) -> DataFrame:
    """Decoded records of the units: their columns, chunk_index, chunk_checksum_valid, record_index, record_id, filetime,
    decode_error, ``nodes`` or the texts of the wanted fields, and ``evt`` for legacy records. A unit that
    cannot be read to its end gives the records before, and a row with ``read_error`` and none of a record."""
    wanted = wanted or Wanted(None)
    kept = [f for f in units.schema.fields if f.name not in (*UNIT_COLUMNS, "length")]
    names = [f.name for f in kept]
    if wanted.fields is None:
        decoded = [f for f in DECODED_FIELDS if f.name == "nodes"]
    else:
        decoded = [T.StructField(TEXT + f, T.StringType()) for f in wanted.fields]
    errors = [T.StructField(n, T.StringType()) for n in ("decode_error", "read_error")]
    added = [*_PLACE_FIELDS, *RECORD_FIELDS, *errors, *decoded, T.StructField("evt", EVT_TYPE)]

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            rows = _Rows(batch.select(names), added, wanted)
            columns = [batch.column(n).to_pylist() for n in ("path", "format", "length", *UNIT_COLUMNS)]
            for row, (path, kind, length, first, stop, index) in enumerate(zip(*columns)):
                try:
                    if kind == "evtx":
                        yield from _modern(rows, row, cursor, path, first, stop, wanted)
                    else:
                        yield from _legacy(rows, row, cursor, path, length, (first, stop, index), wanted)
                except OSError as problem:
                    cursor.close()
                    rows.add(row, (None, None), (None, None, None, None), error=str(problem))
            if rows.rows:
                yield rows.batch()
        cursor.close()

    return units.mapInArrow(run, T.StructType([*kept, *added]))


def read_failures(units: DataFrame) -> DataFrame:
    """(path, message) of the units whose bytes cannot be read: the same pass without decoding."""

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            found = []
            columns = [batch.column(n).to_pylist() for n in ("path", "format", "length", *UNIT_COLUMNS)]
            for path, kind, length, first, stop, _ in zip(*columns):
                try:
                    if kind == "evtx":
                        for _chunk in written_chunks(cursor, path, first, stop):
                            pass
                    else:
                        window = Window(length, lambda pos, size, path=path: cursor.read(path, pos, size))
                        first, stop = first or 0, length if stop is None else stop
                        for pos in range(first, stop, _STEP_CHUNKS * EVTX_CHUNK_SIZE):
                            window.hold(pos, min(_STEP_CHUNKS * EVTX_CHUNK_SIZE, stop - pos))
                except OSError as problem:
                    cursor.close()
                    found.append((path, str(problem)))
            if found:
                yield pa.RecordBatch.from_pylist([{"path": p, "message": m} for p, m in found])
        cursor.close()

    return units.mapInArrow(run, "path string, message string")


def slot_totals(units: DataFrame) -> DataFrame:
    """(path, slots_parsed, slots_skipped, records, decode_errors) of each unit of modern logs, and ``read_error``."""
    fields = ("slots_parsed", "slots_skipped", "records", "decode_errors")

    def run(batches):
        cursor = FileCursor()
        for batch in batches:
            found = []
            for path, first, stop in zip(*(batch.column(n).to_pylist() for n in ("path", "_first", "_stop"))):
                parsed = skipped = records = errors = 0
                problem = None
                try:
                    for _slot, chunk in written_chunks(cursor, path, first, stop, every=True):
                        parsed, skipped = parsed + (chunk is not None), skipped + (chunk is None)
                        nodes: list = []
                        decoder = ChunkDecoder(chunk or b"", nodes)
                        for record_id, ticks, start, end in frame_records(chunk) if chunk else ():
                            records += 1
                            failed = decoder.decode(start, end) is not None
                            errors += failed or record_id > _LARGEST_SIGNED or ticks > _LARGEST_SIGNED
                            nodes.clear()
                except OSError as failure:
                    cursor.close()
                    problem = str(failure)
                found.append(dict(zip(("path", *fields, "read_error"), (path, parsed, skipped, records, errors, problem))))
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=kinds)
        cursor.close()

    kinds = pa.schema([("path", pa.string()), *[(f, pa.int64()) for f in fields], ("read_error", pa.string())])
    return units.where("format = 'evtx'").mapInArrow(run, ", ".join(["path string", *[f"{f} bigint" for f in fields], "read_error string"]))
