"""Text form of one binary-XML value. Runs inside the decode tasks."""

from __future__ import annotations

import codecs
import json
import struct
import sys
from datetime import date, datetime
from decimal import Decimal
from operator import itemgetter

from pyspark import cloudpickle

# Executors get this code with the closure and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BadRecord(ValueError):
    """The bytes of one record do not follow the format."""


# Fixed values of the format: value type codes.
NULL = 0x00
WSTRING = 0x01
STRING = 0x02
INT8 = 0x03
UINT8 = 0x04
INT16 = 0x05
UINT16 = 0x06
INT32 = 0x07
UINT32 = 0x08
INT64 = 0x09
UINT64 = 0x0A
REAL32 = 0x0B
REAL64 = 0x0C
BOOL = 0x0D
BINARY = 0x0E
GUID = 0x0F
SIZE = 0x10
FILETIME = 0x11
SYSTIME = 0x12
SID = 0x13
HEX32 = 0x14
HEX64 = 0x15
BINXML = 0x21
ARRAY_FLAG = 0x80


_FIRST_DAY = date(1601, 1, 1).toordinal()


def float_text(value: float) -> str:
    """Shortest round-trip digits, never an exponent, no ``.0`` on whole numbers."""
    text = repr(value)
    if "n" in text:  # inf, -inf, nan
        return text if value == value else "NaN"
    if "e" in text:
        text = format(Decimal(text), "f")
    return text[:-2] if text.endswith(".0") else text


def filetime_text(ticks: int) -> str:
    """ISO-8601 UTC with seven fractional digits. Any 64-bit value has one: years beyond 9999 are written
    with all their digits."""
    seconds, fraction = divmod(ticks, 10_000_000)
    minutes, second = divmod(seconds, 60)
    start = _MINUTES.get(minutes)
    if start is None:
        if len(_MINUTES) >= 4096:
            _MINUTES.clear()
        start = _MINUTES[minutes] = _minute_text(minutes)
    return f"{start}{second:02d}.{fraction:07d}Z"


_MINUTES: dict[int, str] = {}  # texts up to the minute, of this worker


def _minute_text(minutes: int) -> str:
    days, minute = divmod(minutes, 1440)
    # The calendar repeats every 146,097 days; within one period, ``date`` knows it.
    periods, day = divmod(days, 146_097)
    at = date.fromordinal(_FIRST_DAY + day)
    return f"{at.year + 400 * periods:04d}-{at.month:02d}-{at.day:02d}T{minute // 60:02d}:{minute % 60:02d}:"


def systime_text(parts: tuple[int, ...]) -> str:
    year, month, _weekday, day, hour, minute, second, millis = parts
    try:
        instant = datetime(year, month, day, hour, minute, second)
    except ValueError as problem:
        raise BadRecord(f"SYSTEMTIME: {problem}") from None
    return f"{instant.isoformat()}.{millis * 10_000:07d}Z"


def guid_text(data: bytes) -> str:
    h = data[:16].hex()
    return f"{{{h[6:8]}{h[4:6]}{h[2:4]}{h[:2]}-{h[10:12]}{h[8:10]}-{h[14:16]}{h[12:14]}-{h[16:20]}-{h[20:]}}}"


def sid_text(data: bytes) -> str | None:
    """``S-1-...``, or None when the bytes are no SID."""
    if len(data) < 8 or len(data) < 8 + 4 * data[1]:
        return None
    subs = data[1]
    return ("S-%d-%d" + "-%d" * subs) % (data[0], int.from_bytes(data[2:8], "big"), *struct.unpack_from(f"<{subs}I", data, 8))


def utf16_text(data: bytes) -> str:
    return codecs.utf_16_le_decode(data, "replace", True)[0]


def utf16_cstring(data: bytes, start: int, limit: int) -> tuple[str, int]:
    """NUL-terminated UTF-16 text at ``start`` and the position after its terminator."""
    stop = data.find(b"\0\0", start, limit)
    while stop >= 0 and (stop - start) % 2:
        stop = data.find(b"\0\0", stop + 1, limit)
    if stop < 0:
        raise BadRecord("text without terminator")
    return utf16_text(data[start:stop]), stop + 2


# Values of fixed width: type -> (struct layout, width, function from the unpacked item to text).
# Layouts stay text: compiled ones cannot travel with a closure.
_FIXED = {
    INT8: ("<b", str),
    UINT8: ("<B", str),
    INT16: ("<h", str),
    UINT16: ("<H", str),
    INT32: ("<i", str),
    UINT32: ("<I", str),
    INT64: ("<q", str),
    UINT64: ("<Q", str),
    REAL32: ("<f", float_text),
    REAL64: ("<d", float_text),
    BOOL: ("<I", lambda v: "true" if v else "false"),
    GUID: ("16s", guid_text),
    SIZE: ("<Q", str),
    FILETIME: ("<Q", filetime_text),
    HEX32: ("<I", "0x{:08x}".format),
    HEX64: ("<Q", "0x{:016x}".format),
}
_FIXED = {kind: (layout, struct.calcsize(layout), show) for kind, (layout, show) in _FIXED.items()}


def read_value(buf: bytes, pos: int, kind: int, size: int | None, limit: int):
    """Value at ``pos`` and the position after it.

    The value is None (Null), its display text, or ``(start, end)`` of a nested fragment. ``size``
    is the declared byte length of a substitution; without it the value carries its own length.
    """
    if kind == WSTRING and size is None:  # by far the most frequent value
        end = pos + 2 + 2 * int.from_bytes(buf[pos : pos + 2], "little")
        if end > limit:
            raise BadRecord("value ends beyond its record")
        return utf16_text(buf[pos + 2 : end]), end
    if kind & ARRAY_FLAG:
        return _read_array(buf, pos, kind & ~ARRAY_FLAG, size, limit)
    if size is not None and pos + size > limit:
        raise BadRecord("value ends beyond its record")

    fixed = _FIXED.get(kind)
    if fixed is not None:
        layout, width, show = fixed
        if kind == SIZE and size == 4:
            layout, width = "<I", 4
        if pos + width > limit:
            raise BadRecord("value ends beyond its record")
        # A declared size that differs from the width still says where the next value starts.
        after = pos + (width if size is None else size)
        return show(struct.unpack_from(layout, buf, pos)[0]), after

    if kind == NULL:
        return None, pos + (size or 0)
    if kind == SYSTIME:
        if pos + 16 > limit:
            raise BadRecord("value ends beyond its record")
        return systime_text(struct.unpack_from("<8H", buf, pos)), pos + (16 if size is None else size)

    if kind == WSTRING:
        if size % 2:
            raise BadRecord("odd byte length of a UTF-16 value")
    elif kind in (STRING, BINXML):
        if size is None:
            size, pos = read_uint(buf, pos, 2, limit), pos + 2
    elif kind == BINARY:
        if size is None:
            size, pos = read_uint(buf, pos, 4, limit), pos + 4
    elif kind == SID:
        if size is None:
            if pos + 2 > limit:
                raise BadRecord("value ends beyond its record")
            size = 8 + 4 * buf[pos + 1]
    else:
        raise BadRecord(f"unsupported value type 0x{kind:02x}")

    end = pos + size
    if end > limit:
        raise BadRecord("value ends beyond its record")
    if kind == BINXML:
        return (pos, end), end
    data = buf[pos:end]
    if kind == WSTRING:
        return utf16_text(data), end
    if kind == STRING:
        return data.decode("utf-8", "replace"), end
    if kind == SID:
        text = sid_text(data)
        if text is not None:
            return text, end
    return "0x" + data.hex(), end


def _read_array(buf: bytes, pos: int, kind: int, size: int | None, limit: int):
    items, end = array_items(buf, pos, kind, size, limit)
    return ",".join([item if isinstance(item, str) else "" for item in items]), end


def array_items(buf: bytes, pos: int, kind: int, size: int | None, limit: int) -> tuple[list, int]:
    """The items of an array as ``read_value`` gives them, and the position after it."""
    if size is None:
        raise BadRecord("array value without a byte size")
    end = pos + size
    if end > limit:
        raise BadRecord("value ends beyond its record")
    if kind in (WSTRING, STRING):
        text = (utf16_text if kind == WSTRING else lambda b: b.decode("utf-8", "replace"))(buf[pos:end])
        return (text[:-1] if text.endswith("\0") else text).split("\0") if size else [], end
    items = []
    while pos < end:
        item, after = read_value(buf, pos, kind, None, end)
        if after == pos:
            raise BadRecord("array item without bytes")
        items.append(item)
        pos = after
    return items, end


class Typed(str):
    """Display text of a value that also has a JSON form: a number, a truth value, null or an array."""

    json = "null"


class Number(Typed):
    json = property(lambda self: json.dumps(self) if self in ("NaN", "inf", "-inf") else str(self))


class Truth(Typed):
    json = property(str)


class Hex(Typed):
    json = property(lambda self: str(int(self, 16)))


class Shown(Typed):
    """A value that JSON can only hold as text."""

    json = property(lambda self: _quoted(self))


_quoted = json.encoder.encode_basestring_ascii
_NUMBERS = (INT8, UINT8, INT16, UINT16, INT32, UINT32, INT64, UINT64, SIZE, REAL32, REAL64)


def _json(kind: int, text) -> str:
    if not isinstance(text, str):  # Null, or elements where a value stands
        return "null"
    if kind == BOOL or kind in _NUMBERS and text not in ("NaN", "inf", "-inf"):
        return text
    return str(int(text, 16)) if kind in (HEX32, HEX64) else json.dumps(text)


def typed_value(value, buf: bytes, pos: int, kind: int, size: int | None, limit: int):
    """``value``, which ``read_value`` gave for the same bytes, with its JSON form. Texts stay plain."""
    if isinstance(value, tuple) or kind in (WSTRING, STRING, NULL):
        return value
    if kind & ARRAY_FLAG:
        found = Typed(value)
        items, _ = array_items(buf, pos, kind & ~ARRAY_FLAG, size, limit)
        found.json = f"[{','.join(_json(kind & ~ARRAY_FLAG, item) for item in items)}]"
        return found
    return _FORMS.get(kind, Shown)(value)


_FORMS = {**dict.fromkeys(_NUMBERS, Number), BOOL: Truth, HEX32: Hex, HEX64: Hex}


def json_of(text: str) -> str:
    return text.json if isinstance(text, Typed) else _quoted(text)


def typed_form(kind: int):
    """What makes the text of a single value ``Typed``; None for texts, which stay plain, and Null."""
    return None if kind in (WSTRING, STRING, NULL) else _FORMS.get(kind, Shown)


def json_form(kind: int):
    """Function from the text of a single value to the JSON form that its ``typed_form`` has; None where it is the text."""
    return _JSON_FORMS.get(kind, _quoted)


_JSON_FORMS = {
    **dict.fromkeys((*_NUMBERS, BOOL)),
    **dict.fromkeys((REAL32, REAL64), lambda text: _quoted(text) if text in ("NaN", "inf", "-inf") else text),
    **dict.fromkeys((HEX32, HEX64), lambda text: str(int(text, 16))),
}


def read_array(buf: bytes, pos: int, kind: int, size: int, limit: int) -> tuple[str, str, int]:
    """Text and JSON form of an array, and the position after it."""
    kind &= ~ARRAY_FLAG
    end = pos + size
    if kind in _FIXED and end <= limit and size % _FIXED[kind][1] == 0:  # items one after the other, read at once
        layout, _, show = _FIXED[kind]
        texts = [show(item) for item, in struct.iter_unpack(layout, buf[pos:end])]
        form = _JSON_FORMS.get(kind, _quoted)
        return ",".join(texts), f"[{','.join(texts if form is None else map(form, texts))}]", end
    items, end = array_items(buf, pos, kind, size, limit)
    return ",".join([item if isinstance(item, str) else "" for item in items]), f"[{','.join([_json(kind, x) for x in items])}]", end


# Inline values of fixed width: struct code and function to their text. That of Null is empty here.
_IN_RUNS = {kind: (layout.lstrip("<"), show) for kind, (layout, _, show) in _FIXED.items()}
_IN_RUNS |= {NULL: ("0s", bytes.decode), SYSTIME: ("16s", lambda data: systime_text(struct.unpack("<8H", data)))}


def picker(places: list[int]):
    """Function that gives the items at these places as a tuple."""
    if len(places) > 1:
        return itemgetter(*places)
    return (lambda items: (items[places[0]],)) if places else lambda items: ()


class FixedRun:
    """Bytes that stay the same with values of fixed width between them, read at once. A part is (bytes, type, or -1
    for four bytes that may differ)."""

    def __init__(self, parts: list[tuple[bytes, int]]):
        layout, same, given, self.same, self.shows = "<", [], [], [], []
        for before, kind in parts:
            layout += f"{len(before)}s"
            same.append(len(same) + len(given))
            self.same.append(before)
            if kind < 0:
                layout += "4x"
                continue
            code, show = _IN_RUNS[kind]
            layout += code
            given.append(len(same) + len(given))
            self.shows.append(show)
        packed = struct.Struct(layout)
        self.unpack_from, self.width = packed.unpack_from, packed.size
        self.pick_same, self.pick_given = picker(same), picker(given)
        self.same = tuple(self.same)

    def read(self, buf: bytes, pos: int, found: list) -> bool:
        """Adds the texts; False where the bytes are others. Fails as ``struct`` does beyond the end."""
        items = self.unpack_from(buf, pos)
        if self.pick_same(items) != self.same:
            return False
        found += [show(item) for show, item in zip(self.shows, self.pick_given(items))]
        return True


def is_fixed(kind: int) -> bool:
    return kind in _IN_RUNS


def read_uint(buf: bytes, pos: int, width: int, limit: int) -> int:
    if pos + width > limit:
        raise BadRecord("record ends inside a field")
    return int.from_bytes(buf[pos : pos + width], "little")
