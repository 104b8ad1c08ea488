"""The decode job: chunk or file bytes in, one row per event record out. Map-only, no shuffle."""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.binxml import ChunkDecoder, frame_records
from ..functions.evtrecords import Window, evt_records, log_bounds, walk
from ..functions.layouts import SYSTEM, DataDecoder, Known
from ..functions.values import json_of
from .storage import open_file, read_range, repeat_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
            T.StructField("is_leaf", T.BooleanType()),
        ]
    )
)
RECORD_FIELDS = [
    T.StructField("record_index", T.IntegerType()),
    T.StructField("record_id", T.LongType()),
    T.StructField("filetime", T.LongType()),
]
#: System fields that can be read by themselves: column, element, attribute.
SYSTEM_FIELDS = {
    "event_id": ("EventID", None),
    "channel": ("Channel", None),
    "computer": ("Computer", None),
    "level": ("Level", None),
    "provider": ("Provider", "Name"),
    "user_sid": ("Security", "UserID"),
}
TEXT = "_text_"  # prefix of the columns that hold their texts
DECODED_FIELDS = [
    T.StructField("nodes", NODE_TYPE),
    T.StructField("decode_error", T.StringType()),
]
EVT_TYPE = T.StructType(
    [
        T.StructField("record_number", T.LongType()),
        T.StructField("time_generated", T.LongType()),
        T.StructField("time_written", T.LongType()),
        T.StructField("event_id_raw", T.LongType()),
        T.StructField("event_type", T.IntegerType()),
        T.StructField("category", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("computer", T.StringType()),
        T.StructField("user_sid", T.StringType()),
        T.StructField("strings", T.ArrayType(T.StringType())),
        T.StructField("data", T.BinaryType()),
    ]
)

_TEXT = pa.string()
_ROWS_PER_BATCH = 4096
_NODES_PER_BATCH = 1 << 14
_WORK_PER_BATCH = 1 << 26  # bounds the memory of a batch of unusually large records
_BYTES_PER_BATCH = 1 << 25
_WORK_OF_ARRAY = 1 << 20  # a VARIANT has 16 MiB, and JSON at most six characters for one
_LARGEST_SIGNED = (1 << 63) - 1


def _carried(frame: DataFrame, dropped: str) -> list[T.StructField]:
    return [f for f in frame.schema.fields if f.name != dropped]


def node_array(nodes: list[tuple], offsets: list[int]) -> pa.Array:
    paths, names, attributes, texts, leaves = zip(*nodes) if nodes else ((),) * 5
    counts, pairs = [0], []
    for attrs in attributes:
        pairs += attrs
        counts.append(len(pairs))
    keys, values = zip(*pairs) if pairs else ((), ())
    attrs = pa.MapArray.from_arrays(
        pa.array(counts, pa.int32()), pa.array(keys, _TEXT), pa.array(values, _TEXT)
    )
    structs = pa.StructArray.from_arrays(
        [pa.array(paths, _TEXT), pa.array(names, _TEXT), attrs, pa.array(texts, _TEXT), pa.array(leaves, pa.bool_())],
        names=["path", "name", "attrs", "text", "is_leaf"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def _decode_chunk_rows(keep: pa.RecordBatch, chunks: pa.Array, typed: bool = False):
    """Batches of (kept columns, record_index, record_id, filetime, nodes, decode_error), and the nodes' ``typed``."""
    found, nodes, offsets, size = [], [], [0], 0

    def flush():
        rows, *columns = zip(*found)
        kinds = (pa.int32(), pa.int64(), pa.int64(), _TEXT)
        *headers, errors = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        columns = [*repeat_rows(keep, rows), *headers, node_array(nodes, offsets), errors]
        names = [*keep.schema.names, "record_index", "record_id", "filetime", "nodes", "decode_error"]
        if typed:
            texts = pa.array([json_of(node[3]) for node in nodes], _TEXT)
            columns, names = [*columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts)], [*names, "typed"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for row in range(len(chunks)):
        chunk = chunks[row].as_py()
        decoder = ChunkDecoder(chunk, nodes, typed)
        for index, (record_id, ticks, start, end) in enumerate(frame_records(chunk)):
            found.append((row, *_header(index, record_id, ticks, decoder.decode(start, end))))
            offsets.append(len(nodes))
            size += decoder.work_done
            if len(found) >= _ROWS_PER_BATCH or len(nodes) >= _NODES_PER_BATCH or size > _WORK_PER_BATCH:
                yield flush()
                nodes.clear()
                found, offsets, size = [], [0], 0
    if found:
        yield flush()


def _decode_evt_rows(keep: pa.RecordBatch, paths: list[str], contents: pa.Array | None):
    """Batches of (kept columns, record_index, evt). A file that cannot be read gives what was read of it."""
    for row, path in enumerate(paths):
        data = contents[row].as_py() if contents is not None else None
        pending, start, held_bytes = [], 0, 0
        for record, used in evt_records(data) if data is not None else _stored_evt_records(path):
            pending.append(record)
            held_bytes += used
            if len(pending) == _ROWS_PER_BATCH or held_bytes > _BYTES_PER_BATCH:
                yield _evt_batch(keep, row, start, pending)
                start += len(pending)
                pending, held_bytes = [], 0
        if pending:
            yield _evt_batch(keep, row, start, pending)


def _stored_evt_records(path: str):
    try:
        with open_file(path) as file:
            window = Window(file.size(), lambda pos, size: read_range(file, pos, size))
            bounds = log_bounds(window)
            for _, record, used in walk(window, *bounds) if bounds is not None else ():
                yield record, used
    except OSError:
        return  # ``read_units`` reports it; here the other files go on


def evt_struct(records: list[tuple | None]) -> pa.Array:
    """Raw legacy records as one column; None is a row without one."""
    kind = to_arrow_type(EVT_TYPE)
    if not any(records):
        return pa.nulls(len(records), kind)
    nothing = (None,) * kind.num_fields
    columns = [pa.array(values, field.type) for values, field in zip(zip(*(r or nothing for r in records)), kind)]
    return pa.StructArray.from_arrays(columns, fields=list(kind), mask=pa.array([r is None for r in records]))


def _evt_batch(keep: pa.RecordBatch, row: int, start: int, records: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            *repeat_rows(keep, [row] * len(records)),
            pa.array(range(start, start + len(records)), pa.int32()),
            evt_struct(records),
        ],
        names=[*keep.schema.names, "record_index", "evt"],
    )


def decode_chunks(chunks: DataFrame, typed: bool = False) -> DataFrame:
    """Decodes every record of every chunk: (..., record_index, record_id, filetime, nodes,
    decode_error), where ... are all columns of ``chunks`` but the bytes.

    A record that cannot be decoded keeps its row, with ``decode_error`` and no nodes. ``typed`` adds a column of that name:
    the text of each node as JSON by the type of its value.
    """
    carried = _carried(chunks, "chunk")
    names = [f.name for f in carried]

    def run(batches):
        for batch in batches:
            yield from _decode_chunk_rows(batch.select(names), batch.column("chunk"), typed)

    added = [T.StructField("typed", T.ArrayType(T.StringType()))] if typed else []
    return chunks.mapInArrow(run, T.StructType([*carried, *RECORD_FIELDS, *DECODED_FIELDS, *added]))


def decode_data(chunks: DataFrame) -> DataFrame:
    """Records of chunks as ``decode_chunks`` gives them, with what ``map_event`` asks of their nodes instead of these: the
    texts of the System fields, ``data``, and the JSON forms of its values in the same order: as one array in ``json``, or, where
    that would be large, each by itself in ``jsons``."""
    carried = _carried(chunks, "chunk")
    names = [f.name for f in carried]
    fields = [(f"{SYSTEM}{element}[0]", attribute) for element, attribute in SYSTEM_FIELDS.values()]
    added = [
        *RECORD_FIELDS,
        T.StructField("decode_error", T.StringType()),
        *[T.StructField(TEXT + f, T.StringType()) for f in SYSTEM_FIELDS],
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("json", T.StringType()),
        T.StructField("jsons", T.ArrayType(T.StringType())),
    ]
    kinds = [to_arrow_type(f.dataType) for f in added[:-3]]

    def decoded(keep: pa.RecordBatch, chunks: pa.Array, known: Known):
        found, offsets, size = [], [0], 0
        data = keys, texts, jsons = [], [], []
        arrays, singles = [], []

        def flush():
            rows, *columns = zip(*found)
            columns = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            items = pa.array(keys, _TEXT), pa.array(texts, _TEXT)
            columns.append(pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), *items))
            columns += pa.array(arrays, _TEXT), pa.array(singles, pa.list_(_TEXT))
            return pa.RecordBatch.from_arrays([*repeat_rows(keep, rows), *columns], [*names, *[f.name for f in added]])

        for row in range(len(chunks)):
            chunk = chunks[row].as_py()
            decoder = DataDecoder(chunk, fields, known, *data)
            for index, (record_id, ticks, start, end) in enumerate(frame_records(chunk)):
                system, error = decoder.record(start, end)
                found.append((row, *_header(index, record_id, ticks, error), *system))
                offsets.append(len(keys))
                size += decoder.work_done
                small = decoder.work_done < _WORK_OF_ARRAY
                arrays.append(f"[{','.join(jsons)}]" if small else None)
                singles.append(None if small else jsons.copy())
                jsons.clear()
                if len(found) >= _ROWS_PER_BATCH or len(keys) >= _NODES_PER_BATCH or size > _WORK_PER_BATCH:
                    yield flush()
                    for items in (*data, arrays, singles):
                        items.clear()
                    found, offsets, size = [], [0], 0
        if found:
            yield flush()

    def run(batches):
        known = Known()
        for batch in batches:
            yield from decoded(batch.select(names), batch.column("chunk"), known)

    return chunks.mapInArrow(run, T.StructType([*carried, *added]))


def _header(index: int, record_id: int, ticks: int, error: str | None) -> tuple:
    """Position, id, time and error of a record; ids and times that a column can't hold are none."""
    if record_id > _LARGEST_SIGNED or ticks > _LARGEST_SIGNED:
        error = error or f"header value out of range: id {record_id}, time {ticks}"
        record_id = record_id if record_id <= _LARGEST_SIGNED else None
        ticks = ticks if ticks <= _LARGEST_SIGNED else None
    return index, record_id, ticks, error


def decode_units(units: DataFrame) -> DataFrame:
    """Both formats in one pass: chunks of evtx files and whole evt files, both in ``chunk``, told apart
    by ``format``. Gives the columns of ``decode_chunks`` and ``evt``; each format leaves the other's NULL.
    """
    carried = _carried(units, "chunk")
    names = [f.name for f in carried]
    added = [*RECORD_FIELDS, *DECODED_FIELDS, T.StructField("evt", EVT_TYPE)]
    out_names = [*names, *[f.name for f in added]]

    def complete(part: pa.RecordBatch, like: dict[str, pa.DataType]) -> pa.RecordBatch:
        columns = [
            part.column(name) if name in part.schema.names else pa.nulls(part.num_rows, like[name])
            for name in out_names
        ]
        return pa.RecordBatch.from_arrays(columns, names=out_names)

    kinds = {f.name: to_arrow_type(f.dataType) for f in added}

    def run(batches):
        for batch in batches:
            is_evt = pc.equal(batch.column("format"), "evt")
            for part, decode in ((batch.filter(pc.invert(is_evt)), None), (batch.filter(is_evt), "evt")):
                if not part.num_rows:
                    continue
                keep, data = part.select(names), part.column("chunk")
                if decode is None:
                    rows = _decode_chunk_rows(keep, data)
                else:
                    rows = _decode_evt_rows(keep, part.column("path").to_pylist(), data)
                for decoded in rows:
                    yield complete(decoded, kinds)

    return units.mapInArrow(run, T.StructType([*carried, *added]))


def frame_chunks(chunks: DataFrame) -> DataFrame:
    """Record boundaries without decoding: (..., record_index, record_id, filetime, binxml_start,
    binxml_end), offsets relative to the chunk."""
    carried = _carried(chunks, "chunk")
    names = [f.name for f in carried]

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for row, chunk in enumerate(batch.column("chunk").to_pylist()):
                for index, (record_id, ticks, start, end) in enumerate(frame_records(chunk)):
                    rows.append(row)
                    found.append(
                        (
                            index,
                            record_id if record_id <= _LARGEST_SIGNED else None,
                            ticks if ticks <= _LARGEST_SIGNED else None,
                            start,
                            end,
                        )
                    )
            if rows:
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*repeat_rows(batch.select(names), rows), *columns],
                    names=[*names, "record_index", "record_id", "filetime", "binxml_start", "binxml_end"],
                )

    bounds = [T.StructField(n, T.IntegerType()) for n in ("binxml_start", "binxml_end")]
    return chunks.mapInArrow(run, T.StructType([*carried, *RECORD_FIELDS, *bounds]))


def chunk_totals(chunks: DataFrame) -> DataFrame:
    """(..., records, decode_errors) per chunk: the decode pass without its output."""
    carried = _carried(chunks, "chunk")
    names = [f.name for f in carried]

    def run(batches):
        for batch in batches:
            records, errors = [], []
            for chunk in batch.column("chunk").to_pylist():
                nodes, total, bad = [], 0, 0
                decoder = ChunkDecoder(chunk, nodes)
                for record_id, ticks, start, end in frame_records(chunk):
                    total += 1
                    failed = decoder.decode(start, end) is not None
                    bad += failed or record_id > _LARGEST_SIGNED or ticks > _LARGEST_SIGNED
                    nodes.clear()
                records.append(total)
                errors.append(bad)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(records, pa.int64()), pa.array(errors, pa.int64())],
                names=[*names, "records", "decode_errors"],
            )

    totals = [T.StructField(n, T.LongType()) for n in ("records", "decode_errors")]
    return chunks.mapInArrow(run, T.StructType([*carried, *totals]))


def evt_totals(files: DataFrame) -> DataFrame:
    """(..., records) of legacy logs: the pass over their records without its output."""
    held = "content" in files.columns
    carried = _carried(files, "content")
    names = [f.name for f in carried]

    def run(batches):
        for batch in batches:
            contents = batch.column("content") if held else None
            counts = []
            for row, path in enumerate(batch.column("path").to_pylist()):
                data = contents[row].as_py() if held else None
                counts.append(sum(1 for _ in (evt_records(data) if data is not None else _stored_evt_records(path))))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(counts, pa.int64())], [*names, "records"])

    return files.mapInArrow(run, T.StructType([*carried, T.StructField("records", T.LongType())]))


def decode_evt(files: DataFrame) -> DataFrame:
    """Raw records of legacy logs: (..., record_index, evt struct).

    ``content`` may be NULL or missing: the task then reads the file itself, through a window. Here one file is one
    unit; ``log_ranges`` with ``read_units`` divides large ones and reports those that cannot be read.
    """
    held = "content" in files.columns
    carried = _carried(files, "content")
    names = [f.name for f in carried]

    def run(batches):
        for batch in batches:
            contents = batch.column("content") if held else None
            yield from _decode_evt_rows(batch.select(names), batch.column("path").to_pylist(), contents)

    schema = T.StructType(
        [*carried, T.StructField("record_index", T.IntegerType()), T.StructField("evt", EVT_TYPE)]
    )
    return files.mapInArrow(run, schema)
