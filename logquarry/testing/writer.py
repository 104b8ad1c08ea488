"""Writes event-log bytes for checks: the reading code has no other source of known input."""

from __future__ import annotations

import struct
import sys
import zlib

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_SIZE = 65536


def utf16(text: str) -> bytes:
    return text.encode("utf-16-le", "surrogatepass")


def sid_bytes(text: str) -> bytes:
    revision, authority, *subs = map(int, text.split("-")[1:])
    return bytes([revision, len(subs)]) + authority.to_bytes(6, "big") + struct.pack(f"<{len(subs)}I", *subs)


class Value:
    """A typed value: its type code and its bytes as a substitution."""

    def __init__(self, kind: int, data: bytes = b""):
        self.kind, self.data = kind, data

    def standalone(self) -> bytes:
        size = len(self.data)
        prefix = {0x01: ("<H", size // 2), 0x02: ("<H", size), 0x0E: ("<I", size), 0x21: ("<H", size)}
        layout = prefix.get(self.kind)
        return bytes([self.kind]) + (struct.pack(*layout) if layout else b"") + self.data


def text(value: str) -> Value:
    return Value(0x01, utf16(value))


class Slot:
    """A substitution: slot number, declared type, and whether Null omits it."""

    def __init__(self, index: int, optional: bool = False, kind: int = 0x01):
        self.index, self.optional, self.kind = index, optional, kind


class El:
    """An element; children are elements, values, slots or raw token bytes."""

    def __init__(self, name: str, *children, **attrs):
        self.name, self.children, self.attrs = name, children, attrs.items()
        self.flat: dict[bool, list] = {}  # inside of templates and outside: see ``_flat``


class Hole:
    """A place in a document for the value with this number."""

    def __init__(self, index: int):
        self.index = index


class Filled:
    """A document that many records share, and the values of one: each as its bytes with the type code ahead. Once a chunk
    has all of its names, only the values are written anew."""

    def __init__(self, document: El, values: list[bytes]):
        self.document, self.values = document, values


_NAME, _HOLE, _LIST, _LIST_END, _END = range(5)


def _token(item) -> bytes:
    if isinstance(item, Value):
        return b"\x05" + item.standalone()
    if isinstance(item, Slot):
        return struct.pack("<BHB", 0x0E if item.optional else 0x0D, item.index, item.kind)
    return item


def _flat(el: El, in_template: bool) -> list[tuple[bytes, int, object]]:
    """An element as bytes that are always the same, and what follows each: a name, a value, the size of an attribute list or
    its end. Documents are walked once, not in each chunk."""
    steps = el.flat.get(in_template)
    if steps is not None:
        return steps
    steps, same = [], bytearray()

    def then(kind: int, what=None):
        steps.append((bytes(same), kind, what))
        same.clear()

    def content(item):
        nonlocal same
        if isinstance(item, El):
            same += (b"\x41" if item.attrs else b"\x01") + (b"\xff\xff" if in_template else b"") + b"\0\0\0\0"
            then(_NAME, item.name)
            if item.attrs:
                then(_LIST)
                for name, value in item.attrs:
                    same.append(0x06)
                    then(_NAME, name)
                    content(value)
                then(_LIST_END)
            same += b"\x02" if item.children else b"\x03"
            for child in item.children:
                content(child)
            same += b"\x04" if item.children else b""
        elif isinstance(item, Hole):
            same.append(0x05)
            then(_HOLE, item.index)
        else:
            same += _token(item)

    content(el)
    then(_END)
    el.flat[in_template] = steps
    return steps


class ChunkWriter:
    def __init__(self):
        self.buf = bytearray(512)
        self.pieces: dict[El, list] = {}
        self.values: list[bytes] = []
        self.cuts: list[tuple] = []
        self.names: dict[str, int] = {}
        self.templates: dict[object, int] = {}
        self.ids: list[int] = []
        self.last_offset = 512

    @property
    def used(self) -> int:
        return len(self.buf)

    def name(self, name: str):
        at = self.names.get(name)
        if at is not None:
            self.buf += struct.pack("<I", at)
            return
        at = self.names[name] = len(self.buf) + 4
        data = utf16(name)
        self.buf += struct.pack("<IIHH", at, 0, 0, len(data) // 2) + data + b"\0\0"

    def content(self, item):
        if isinstance(item, El):
            self.element(item)
        elif isinstance(item, Filled):
            self.filled(item)
        else:
            self.buf += _token(item)

    def element(self, el: El, in_template: bool = False):
        buf, cuts, lists = self.buf, self.cuts, []
        for same, kind, what in _flat(el, in_template):
            buf += same
            if kind == _NAME:
                self.name(what)
            elif kind == _HOLE:
                start = len(buf)
                buf += self.values[what]
                cuts.append((start, len(buf), what))
            elif kind == _LIST:
                lists.append((len(buf), len(cuts)))
                buf += b"\0\0\0\0"
            elif kind == _LIST_END:
                at, inside = lists.pop()
                size = len(buf) - at - 4
                struct.pack_into("<I", buf, at, size)
                holes = cuts[inside:]
                if holes:  # the size of the list follows the values in it
                    fixed = size - sum(after - start for start, after, _ in holes)
                    cuts.insert(inside, (at, at + 4, (fixed, [index for _, _, index in holes])))

    def fragment(self, *roots):
        self.buf += b"\x0f\x01\x01\x00"
        for root in roots:
            self.content(root)
        self.buf.append(0x00)

    def filled(self, part: Filled):
        """The element of a document. Its bytes between the values, and the sizes of attribute lists that hold some, stay
        the same."""
        pieces = self.pieces.get(part.document)
        if pieces is not None:
            buf, values = self.buf, part.values
            *inner, tail = pieces
            for before, index in inner:
                buf += before
                if type(index) is tuple:
                    fixed, inside = index
                    buf += (fixed + sum(len(values[i]) for i in inside)).to_bytes(4, "little")
                else:
                    buf += values[index]
            buf += tail
            return
        known, start, self.values, self.cuts = len(self.names), len(self.buf), part.values, []
        self.element(part.document)
        if len(self.names) == known:
            pieces = []
            for at, after, index in self.cuts:
                pieces.append((bytes(self.buf[start:at]), index))
                start = after
            self.pieces[part.document] = [*pieces, bytes(self.buf[start:])]

    def instance(self, key, body: El, values: list):
        """A template instance; the body is written at the first use of ``key``. A value that is an
        element is written as a nested fragment."""
        self.buf += struct.pack("<BBI", 0x0C, 0x01, 7)
        at = self.templates.get(key)
        if at is None:
            at = self.templates[key] = len(self.buf) + 4
            self.buf += struct.pack("<I4x16xI", at, 0)
            self.buf += b"\x0f\x01\x01\x00"
            self.element(body, True)
            self.buf.append(0x00)
            struct.pack_into("<I", self.buf, at + 20, len(self.buf) - at - 24)
        else:
            self.buf += struct.pack("<I", at)
        self.buf += struct.pack("<I", len(values))
        table = len(self.buf)
        self.buf += bytes(4 * len(values))
        sizes = []
        for value in values:
            if type(value) is Value:
                self.buf += value.data
                sizes += len(value.data), value.kind
            else:
                start = len(self.buf)
                self.fragment(value)
                sizes += len(self.buf) - start, 0x21
        struct.pack_into("<" + "HBx" * len(values), self.buf, table, *sizes)

    def record(self, record_id: int, filetime: int, write, break_frame: bool = False):
        start = self.last_offset = len(self.buf)
        self.buf += struct.pack("<4sIQQ", b"\x2a\x2a\0\0", 0, record_id, filetime)
        write(self)
        size = len(self.buf) - start + 4
        struct.pack_into("<I", self.buf, start + 4, size)
        self.buf += struct.pack("<I", size ^ 1 if break_frame else size)
        self.ids.append(record_id)

    def finish(self, first_number: int = 1, bad_checksum: bool = False) -> bytes:
        free = len(self.buf)
        if free > CHUNK_SIZE:
            raise ValueError("records do not fit into one chunk")
        chunk = self.buf + bytes(CHUNK_SIZE - free)
        ids = self.ids or [0]
        struct.pack_into(
            "<8sQQQQIIII", chunk, 0, b"ElfChnk\0", first_number, first_number + len(self.ids) - 1,
            ids[0], ids[-1], 128, self.last_offset, free, zlib.crc32(chunk[512:free]) ^ bad_checksum,
        )
        for table, offsets, buckets in ((128, self.names, 64), (384, self.templates, 32)):
            for bucket, at in enumerate(list(offsets.values())[:buckets]):
                struct.pack_into("<I", chunk, table + 4 * bucket, at)
        struct.pack_into("<I", chunk, 124, zlib.crc32(chunk[:120] + chunk[128:512]))
        return bytes(chunk)


def evtx_file(chunks: list[bytes], next_id: int = 1, flags: int = 0, bad_checksum: bool = False) -> bytes:
    head = bytearray(4096)
    struct.pack_into(
        "<8sQQQIHHHH", head, 0, b"ElfFile\0", 0, max(len(chunks) - 1, 0), next_id, 128, 1, 3, 4096, len(chunks)
    )
    struct.pack_into("<II", head, 120, flags, zlib.crc32(head[:120]) ^ bad_checksum)
    return bytes(head) + b"".join(chunks)


def evt_record(
    number: int, generated: int, written: int, event_id: int, kind: int, category: int, source: str,
    computer: str, sid: bytes = b"", strings=(), data: bytes = b"", signature: int = 0x654C664C,
) -> bytes:
    names = utf16(source) + b"\0\0" + utf16(computer) + b"\0\0"
    sid_at = 56 + len(names)
    strings_at = sid_at + len(sid)
    joined = b"".join(utf16(s) + b"\0\0" for s in strings)
    data_at = strings_at + len(joined)
    pad = -(data_at + len(data)) % 4
    size = data_at + len(data) + pad + 4
    head = struct.pack(
        "<6I4H6I", size, signature, number, generated, written, event_id, kind, len(strings), category,
        0, 0, strings_at, len(sid), sid_at, len(data), data_at,
    )
    return head + names + sid + joined + data + bytes(pad) + struct.pack("<I", size)


def evt_file(
    records: list[bytes], first: int = 1, flags: int = 0, start: int = 48, end: int | None = None
) -> bytes:
    body = b"".join(records)
    end = 48 + len(body) if end is None else end
    last = first + len(records) - 1
    return struct.pack("<12I", 48, 0x654C664C, 1, 1, start, end, last, first, 1 << 20, flags, 0, 48) + body
