"""Decoded nodes and raw legacy fields to the columns of one event record.

All of it is SQL over the ``nodes`` array: array lookups for the System fields, array functions for
the event data. Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binary import FILETIME_EPOCH_MICROS
from ..functions.layouts import BINARY as _BINARY, DATA as _DATA, SYSTEM as _SYSTEM, USER_DATA as _USER_DATA
from ..functions.levels import level_sql, parse_unsigned_sql
from ..sources.decode import SYSTEM_FIELDS, TEXT

RECORD_COLUMNS = [
    "record_id", "event_id", "timestamp", "filetime", "provider", "channel", "computer", "level",
    "user_sid", "data", "strings", "raw_data", "time_written", "category",
    "file_checksum_valid", "chunk_checksum_valid", "decode_error",
]


def _node(element: str, attribute: str | None) -> str:
    """Text or attribute of one System child; NULL if there is none. Compiles to one array lookup."""
    at = f"cast(array_position(nodes.path, '{_SYSTEM}{element}[0]') as int) - 1"
    return f"get(nodes.text, {at})" if attribute is None else f"get(nodes.attrs, {at})['{attribute}']"


def _system_columns(text) -> dict[str, str]:
    """The System columns; ``text`` gives the SQL of the text of a field."""
    return {
        "event_id": f"coalesce({parse_unsigned_sql(text('event_id'), 0xFFFFFFFF)}, 0L)",
        "timestamp": f"timestamp_micros(filetime div 10 - {FILETIME_EPOCH_MICROS})",
        "provider": f"coalesce({text('provider')}, '')",
        "channel": f"coalesce({text('channel')}, '')",
        "computer": f"coalesce({text('computer')}, '')",
        "level": level_sql(text("level")),
        "user_sid": text("user_sid"),
    }


_SYSTEM_COLUMNS = _system_columns(lambda field: _node(*SYSTEM_FIELDS[field]))

# (k, v) of each EventData/Data in order: by its Name, else by its position among them.
_DATA_TAIL = f"substring(n.path, {len(_DATA) + 1})"
_EVENT_DATA_PAIRS = f"""concat(
  transform(
    filter(nodes, n -> startswith(n.path, '{_DATA}') and instr({_DATA_TAIL}, '/') = 0),
    n -> struct(
      concat('winlog.event_data.', coalesce(n.attrs['Name'], rtrim(']', {_DATA_TAIL}))) as k,
      n.text as v)),
  transform(
    filter(nodes, n -> n.path = '{_BINARY}'),
    n -> struct('winlog.event_data.binary' as k, n.text as v)))"""

# (dotted key, v) of each non-blank leaf under UserData. The escapes of node paths are undone last.
_DOTTED = rf"replace(regexp_replace(substring(n.path, {len(_USER_DATA) + 1}), r'\[[0-9]+\]', ''), '/', '.')"
_USER_DATA_PAIRS = rf"""transform(
  filter(nodes, n -> startswith(n.path, '{_USER_DATA}') and n.is_leaf and n.text rlike r'(?U)\S'),
  n -> struct(
    concat('winlog.user_data.',
      replace(replace(replace({_DOTTED}, '%5B', '['), '%2F', '/'), '%25', '%')) as k,
    n.text as v))"""

# Of equal keys the last one counts. Rows without duplicates skip the check of every pair.
_LAST_WINS = """map_from_entries(if(
  size(array_distinct(_pairs.k)) = size(_pairs),
  _pairs,
  filter(_pairs, (x, i) -> not exists(slice(_pairs, i + 2, size(_pairs)), y -> y.k = x.k))))"""


def _with_sql(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    return frame.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def _with_data(decoded: DataFrame, pairs: str) -> DataFrame:
    return _with_sql(_with_sql(decoded, {"_pairs": pairs}), {"data": _LAST_WINS}).drop("_pairs")


def map_system(decoded: DataFrame) -> DataFrame:
    """Adds the System fields. Absent ones get defaults, so undecodable records keep their row."""
    return _with_sql(decoded, _SYSTEM_COLUMNS)


def map_event_data(decoded: DataFrame) -> DataFrame:
    """Adds ``data`` with the EventData fields."""
    return _with_data(decoded, _EVENT_DATA_PAIRS)


def map_user_data(decoded: DataFrame) -> DataFrame:
    """Adds ``data`` with the UserData fields."""
    return _with_data(decoded, _USER_DATA_PAIRS)


# How the text of a value becomes its typed form. Text that is none of the kind gives NULL.
_TYPED = {
    "text": "{v}",
    "signed": "try_cast({v} as bigint)",
    "unsigned": "try_cast({v} as decimal(20,0))",
    "float": "try_cast({v} as double)",
    "bool": "case {v} when 'true' then true when 'false' then false end",
    "binary": "if({v} rlike '^0x([0-9a-f]{{2}})*$', unhex(substring({v}, 3)), null)",
    "date": "try_cast({v} as timestamp)",
    "array": "if({v} = '', array(), split({v}, ','))",
}


def typed_value(key: str, kind: str) -> Column:
    """A ``data`` value in typed form: text, signed, unsigned, float, bool, binary, date or array.

    Dates keep microseconds. The map itself holds text, as the logs' own renderers show it.
    """
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(_TYPED[kind].format(v=f"data['{quoted}']"))


_EVTX_NULLS = {
    "strings": "cast(null as array<string>)",
    "raw_data": "cast(null as string)",
    "time_written": "cast(null as timestamp)",
    "category": "cast(null as int)",
}


def map_event(decoded: DataFrame) -> DataFrame:
    """All record columns of decoded evtx records, and ``typed_data`` where they were decoded ``typed``: the values of
    ``data`` as VARIANT, by the types they have in the log. Arrays, numbers, truth values and Null keep them."""
    both = f"concat({_EVENT_DATA_PAIRS}, {_USER_DATA_PAIRS})"
    mapped = _with_sql(decoded, {**_SYSTEM_COLUMNS, "_pairs": both})
    mapped = _with_sql(mapped, {"data": _LAST_WINS, **_EVTX_NULLS})
    if "typed" in decoded.columns:
        zipped = "zip_with(nodes, typed, (n, t) -> struct(n.path, n.attrs, n.is_leaf, n.text, t as json))"
        # Unlike the texts, blank leaves of UserData have no place here either; their nodes are the same.
        typed = both.replace("filter(nodes,", f"filter({zipped},").replace("n.text as v", "n.json as v")
        mapped = _with_sql(mapped, {"_pairs": typed})
        mapped = _with_sql(mapped, {"typed_data": f"transform_values({_LAST_WINS}, (k, v) -> parse_json(v))"}).drop("typed")
    return mapped.drop("nodes", "_pairs")


def map_data(decoded: DataFrame) -> DataFrame:
    """As ``map_event`` of records decoded ``typed``, from those of ``decode_data``."""
    columns = _system_columns(lambda field: f"`{TEXT}{field}`") | _EVTX_NULLS
    # An array is parsed at once; its items are the same as if each was parsed by itself.
    values = "if(jsons is null, cast(parse_json(json) as array<variant>), transform(jsons, v -> parse_json(v)))"
    columns["typed_data"] = f"map_from_arrays(map_keys(data), {values})"
    return _with_sql(decoded, columns).drop("json", "jsons", *[TEXT + f for f in SYSTEM_FIELDS])


_EVT_COLUMNS = {
    "chunk_index": "0",
    "record_id": "evt.record_number",
    "event_id": "evt.event_id_raw & 65535",
    "timestamp": "timestamp_seconds(evt.time_generated)",
    "filetime": "cast(null as bigint)",
    "provider": "evt.source",
    "computer": "evt.computer",
    "level": level_sql("evt.event_type", "evt"),
    "user_sid": "evt.user_sid",
    "data": "cast(map() as map<string,string>)",
    "strings": "if(size(evt.strings) > 0, evt.strings, null)",
    "raw_data": "nullif(lower(hex(evt.data)), '')",
    "time_written": "timestamp_seconds(evt.time_written)",
    "category": "evt.category",
    "file_checksum_valid": "cast(null as boolean)",
    "chunk_checksum_valid": "cast(null as boolean)",
    "decode_error": "cast(null as string)",
}


def map_evt(raw: DataFrame) -> DataFrame:
    """All record columns of raw legacy records; ``channel`` comes with the file."""
    return _with_sql(raw, _EVT_COLUMNS).drop("evt")


def map_units(decoded: DataFrame) -> DataFrame:
    """All record columns of both formats decoded in one pass; ``channel`` is that of legacy files."""
    modern = {**_SYSTEM_COLUMNS, **_EVTX_NULLS, "data": _LAST_WINS, "record_id": "record_id"}
    legacy = {**_EVT_COLUMNS, "channel": "channel"}
    pairs = {"_pairs": f"concat({_EVENT_DATA_PAIRS}, {_USER_DATA_PAIRS})"}
    columns = {name: f"if(format = 'evt', {legacy[name]}, {sql})" for name, sql in modern.items()}
    return _with_sql(_with_sql(decoded, pairs), columns).drop("nodes", "evt", "_pairs")


def map_texts(decoded: DataFrame, fields: Sequence[str]) -> DataFrame:
    """As ``map_units``, from the texts of some System fields; the other columns of modern records are NULL."""
    modern = _system_columns(lambda field: f"`{TEXT}{field}`" if field in fields else "cast(null as string)")
    modern |= _EVTX_NULLS | {"record_id": "record_id", "data": "cast(null as map<string,string>)"}
    legacy = {**_EVT_COLUMNS, "channel": "channel"}
    columns = {name: f"if(format = 'evt', {legacy[name]}, {sql})" for name, sql in modern.items()}
    return _with_sql(decoded, columns).drop("evt", *[TEXT + f for f in fields])


def record_columns(mapped: DataFrame, carried: list[str]) -> DataFrame:
    """One column order for both formats."""
    first = ["path", "format", "chunk_index", "record_index"]
    others = [c for c in carried if c not in first and c not in RECORD_COLUMNS]
    return mapped.select(*first, *RECORD_COLUMNS, *others)
