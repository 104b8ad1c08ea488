"""The event data of a record without its document: System texts, and keys with texts and JSON forms.

Records of one template that have values of the same types differ in the values alone. Such a layout is found once, by
decoding marks in place of the values; every further record only reads its values and puts them where the marks came
out. A record without a known layout is decoded as a whole, and what is asked for is taken from its nodes. Layouts
hold names and texts but no offsets, so all chunks of a task share them.
"""

from __future__ import annotations

import re
import struct
import sys
from bisect import bisect
from codecs import utf_16_le_decode

from pyspark import cloudpickle

from .binxml import (
    _CLOSE,
    _DESCRIPTOR,
    _OPEN,
    _SLOT,
    _TEXT,
    END_OF_FRAGMENT,
    FRAGMENT_HEADER,
    MAX_WORK,
    TEMPLATE_INSTANCE,
    ChunkDecoder,
    Shape,
    Values,
)
from .values import ARRAY_FLAG, BINXML, NULL, WSTRING, BadRecord, Typed, json_form, json_of, picker, read_array, read_value

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYSTEM = "Event[0]/System[0]/"
DATA = "Event[0]/EventData[0]/Data["
BINARY = "Event[0]/EventData[0]/Binary[0]"
USER_DATA = "Event[0]/UserData[0]/"
EVENT_KEY, USER_KEY = "winlog.event_data.", "winlog.user_data."

# White space as Unicode has it: ``str.strip`` would take four control characters more.
_BLANKS = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_MARK = chr(0xE000)  # for private use
_MAX_KNOWN, _MAX_SHAPES = 1024, 8


class Mark(str):
    """Stands for the value with this number."""

    index: int


def _mark(index: int) -> Mark:
    mark = Mark(_MARK)
    mark.index = index
    return mark


def blank(text: str) -> bool:
    return not text or text.isspace() and not text.strip(_BLANKS)


def data_of(nodes: list[tuple]) -> list[tuple]:
    """(key, text, whether it counts only with a text) of the event data in order: each EventData/Data by its Name, else
    by its position, the Binary, and the leaves of UserData by their path."""
    data, binary, user = [], [], []
    for path, _, attrs, text, leaf in nodes:
        if path.startswith(DATA):
            place = path[len(DATA) :]
            if "/" not in place:
                name = next((value for key, value in attrs if key == "Name"), None)
                data.append((name if type(name) is Mark else EVENT_KEY + (place.rstrip("]") if name is None else name), text, False))
        elif path == BINARY:
            binary.append((EVENT_KEY + "binary", text, False))
        elif leaf and path.startswith(USER_DATA):
            dotted = re.sub(r"\[[0-9]+\]", "", path[len(USER_DATA) :]).replace("/", ".")
            # The escapes of node paths are undone last.
            user.append((USER_KEY + dotted.replace("%5B", "[").replace("%2F", "/").replace("%25", "%"), text, True))
    return data + binary + user


class Layout:
    """Where the values of a record go. Values have the numbers of their slots, then those inside nested fragments
    follow, then the ``consts``."""

    def __init__(self, nodes: list[tuple], fields: list[tuple], forms: list, work: int):
        """``forms``: of each value the function to its JSON form, or the slot of an array. Fails with ``BadRecord`` where
        values are more than a whole text or attribute."""
        self.consts: list = []
        self.work, count = work, len(forms)

        def place(text) -> int:
            if type(text) is Mark:
                return text.index
            if text is not None and _MARK in text:
                raise BadRecord("a value is part of a text")
            self.consts.append(text)
            return count + len(self.consts) - 1

        found = {path: (attrs, text) for path, _, attrs, text, _ in nodes if path.startswith(SYSTEM)}
        system = []
        for path, attribute in fields:
            attrs, text = found.get(path, ((), None))
            system.append(place(text if attribute is None else dict(attrs).get(attribute)))
        keys, places, self.made, self.arrays, self.fixed, self.may_be_blank = [], [], [], [], [], []
        for key, text, needs_text in data_of(nodes):
            if _MARK in key:
                raise BadRecord("a value is part of a name")
            at = place(text)
            if at >= count:
                if needs_text and blank(text):
                    continue
                self.fixed.append((len(keys), json_of(text)))
            else:
                form = forms[at]
                if type(form) is int:
                    self.arrays.append((len(keys), form))
                elif form is not None:
                    self.made.append((len(keys), form))
                if needs_text:
                    self.may_be_blank.append(len(keys))
            keys.append(key)
            places.append(at)
        self.keys, self.unique = keys, len(set(keys)) == len(keys)
        self.pick, self.pick_system = picker(places), picker(system)
        marks = [text.index for _, _, attrs, text, _ in nodes for text in (text, *[v for _, v in attrs]) if type(text) is Mark]
        self.uses = max((marks.count(mark) for mark in set(marks)), default=0)


class Known:
    """What the chunks of a task have shown: template bodies, shapes of nested fragments, and layouts."""

    def __init__(self):
        self.bodies: dict[tuple, int] = {}
        self.shapes: dict[tuple, list[Shape]] = {}
        self.layouts: dict[tuple, Layout | None] = {}

    def bound(self):
        """Logs may hold any number of layouts: beyond this one starts anew."""
        if len(self.layouts) + len(self.bodies) + len(self.shapes) > _MAX_KNOWN:
            self.__init__()


def _frozen(steps: list[tuple]) -> tuple | None:
    """The steps of a body as a key; None where templates or fragments stand inside."""
    found = []
    for kind, a, b, c in steps:
        if kind > _SLOT:
            return None
        typed = a if kind == _TEXT else c
        found.append((kind, a, tuple(b) if type(b) is list else b, c, typed.json if isinstance(typed, Typed) else ""))
    return tuple(found)


class DataDecoder(ChunkDecoder):
    """Decodes the records of one chunk to the texts of System fields, given by path and attribute, and to
    event data: ``keys``, ``texts`` and ``jsons``, which it appends to. Of equal keys the last counts."""

    def __init__(self, chunk: bytes, fields: list[tuple], known: Known, keys: list[str], texts: list[str], jsons: list[str]):
        super().__init__(chunk, [], True)
        known.bound()
        self.fields, self.known, self.keys, self.texts, self.jsons = fields, known, keys, texts, jsons
        self.body_keys: dict[int, object] = {}
        self.symbols: dict[tuple, list] | None = None
        self.refs: list[int] | None = None

    def record(self, start: int, end: int) -> tuple[tuple, str | None]:
        """The System texts of a record, and what went wrong, if anything."""
        system = self._known(start, end)
        if system is not None:
            return system, None
        nodes = self.nodes
        error = self.decode(start, end)
        found = {node[0]: node for node in nodes if node[0].startswith(SYSTEM)}
        system = []
        for path, attribute in self.fields:
            node = found.get(path)
            system.append(None if node is None else node[3] if attribute is None else dict(node[2]).get(attribute))
        self._add([(key, text, json_of(text)) for key, text, needs_text in data_of(nodes) if not (needs_text and blank(text))])
        nodes.clear()
        return tuple(system), error

    def _add(self, rows: list[tuple]):
        last = {key: at for at, (key, _, _) in enumerate(rows)}
        for at, (key, text, json) in enumerate(rows):
            if last[key] == at:
                self.keys.append(key)
                self.texts.append(text)
                self.jsons.append(json)

    def _known(self, start: int, end: int) -> tuple | None:
        """Adds a record of a known layout: one template instance, its values, and nested fragments of known shape."""
        buf = self.buf
        try:
            pos = start + 5
            if buf[start] & 0x0F != FRAGMENT_HEADER or buf[pos - 1] & 0x0F != TEMPLATE_INSTANCE:
                return None
            uint = int.from_bytes
            at = uint(buf[pos + 5 : pos + 9], "little")
            pos += 9
            if at == pos:
                pos += 24 + uint(buf[pos + 20 : pos + 24], "little")
            values_at = pos + 4 + 4 * uint(buf[pos : pos + 4], "little")
            if values_at > end:
                return None
            table = buf[pos + 4 : values_at]
            kinds = table[2::4]
            layouts, body = self.known.layouts, self._body_key(at)
            if (body, kinds) not in layouts:  # a layout that comes once is not worth it
                layouts[body, kinds] = None
                return None
            values, inner, shapes, arrays, pos = [], [], [], {}, values_at
            for size, kind in struct.iter_unpack(_DESCRIPTOR, table):
                if kind == WSTRING and not size & 1 and pos + size <= end:
                    values.append(utf_16_le_decode(buf[pos : pos + size], "replace", True)[0])
                    pos += size
                elif kind == BINXML:
                    stop = pos + size
                    if stop > end:
                        return None
                    shape = self.shapes.get(buf[pos : pos + 5] + buf[pos + 9 : pos + 13]) or self._shape_known(pos, stop)
                    texts = self._texts(shape, pos, stop) if shape is not None else None
                    if texts is None:
                        return None
                    shapes.append(shape)
                    inner += texts
                    values.append(None)
                    pos = stop
                elif kind & ARRAY_FLAG:
                    text, arrays[len(values)], pos = read_array(buf, pos, kind, size, end)
                    values.append(text)
                else:
                    text, pos = read_value(buf, pos, kind, size, end)
                    values.append(text)
            if pos > end or pos < end and buf[pos] & 0x0F != END_OF_FRAGMENT:
                return None
        except (BadRecord, IndexError, struct.error):
            return None
        key = (body, kinds, *[shape.origin for shape in shapes])
        if shapes and key not in layouts or layouts[key] is None:
            layouts[key] = self._layout(at, kinds, shapes) or 0
        layout = layouts[key]
        if layout == 0:
            return None
        values += inner
        work = layout.work + layout.uses * sum(map(len, filter(None, values)))
        if work > MAX_WORK:
            return None
        self.work = MAX_WORK - work
        for shape in shapes:
            shape.hits += 1
        values += layout.consts
        texts = layout.pick(values)
        jsons = list(texts)
        for place, form in layout.made:
            jsons[place] = form(jsons[place])
        for place, slot in layout.arrays:
            jsons[place] = arrays[slot]
        for place, json in layout.fixed:
            jsons[place] = json
        if layout.unique and not any([blank(texts[place]) for place in layout.may_be_blank]):
            self.keys += layout.keys
            self.texts += texts
            self.jsons += jsons
        else:
            left_out = {place for place in layout.may_be_blank if blank(texts[place])}
            self._add([row for place, row in enumerate(zip(layout.keys, texts, jsons)) if place not in left_out])
        return layout.pick_system(values)

    def _body_key(self, at: int) -> object:
        """The same for equal bodies of all chunks."""
        key = self.body_keys.get(at)
        if key is None:
            frozen, bodies = _frozen(self._body(at)), self.known.bodies
            key = self.body_keys[at] = object() if frozen is None else bodies.setdefault(frozen, len(bodies))
        return key

    def _learn(self, start: int, end: int) -> tuple[list[tuple], Shape | None]:
        refs = self.refs = []
        try:
            steps, shape = super()._learn(start, end)
        finally:
            self.refs = None
        if shape is not None:
            for ref in refs:
                piece = bisect(shape.starts, ref) - 1
                shape.named.append((piece, ref - shape.starts[piece], self.names[self._uint(ref, 4)]))
            shape.origin = object()
            root = self.names.get(self._uint(start + 9, 4))
            others = self.known.shapes.setdefault((self.buf[start : start + 5], root), [])
            if len(others) < _MAX_SHAPES:
                others.append(shape)
        return steps, shape

    def _name(self, pos: int):
        if self.refs is not None:
            self.refs.append(pos)
        return super()._name(pos)

    def _shape_known(self, start: int, end: int) -> Shape | None:
        """The shape that a fragment has with another one in another chunk, where names stand elsewhere."""
        buf = self.buf
        others = self.known.shapes.get((buf[start : start + 5], self.names.get(self._uint(start + 9, 4))))
        if others is None:
            return None
        offsets = {name: at.to_bytes(4, "little") for at, name in self.names.items()}
        for other in others:
            shape = other.with_names(offsets)
            if shape is not None and self._texts(shape, start, end) is not None:
                self.shapes[buf[start : start + 5] + buf[start + 9 : start + 13]] = shape
                return shape
        return None

    def _layout(self, at: int, kinds: bytes, shapes: list[Shape]) -> Layout | None:
        values, forms, inside, shapes = Values(), [], [], list(shapes)
        first = len(kinds)
        symbols = {}
        for slot, kind in enumerate(kinds):
            if kind == BINXML:
                shape = shapes.pop(0)
                marks = [_mark(first + len(inside) + i) for i in range(len(shape.kinds))]
                marks = [self.nothing if kind == NULL else mark for kind, mark in zip(shape.kinds, marks)]
                symbols[-1 - slot, 0] = self._filled(shape, marks)
                inside += map(json_form, shape.kinds)
                values.append((-1 - slot, 0))
                forms.append(None)
            else:
                values.append(None if kind == NULL else _mark(slot))
                forms.append(slot if kind & ARRAY_FLAG else json_form(kind))
        nodes, self.symbols = self.nodes, symbols
        self.work, self.roots, self.open = MAX_WORK, [], set()
        try:
            self._fill(self._body(at), values, ["", {}, [], -1])
            return Layout(nodes, self.fields, forms + inside, self.work_done) if self._event_only(0) else None
        except (BadRecord, IndexError, struct.error):
            return None
        finally:
            self.symbols = None
            nodes.clear()

    def _span(self, span: tuple[int, int], values: Values | None, around, frame: list):
        if self.symbols is None:
            super()._span(span, values, around, frame)
            return
        if span in self.open:
            raise BadRecord("fragment contains itself")
        self.open.add(span)
        steps = self.symbols[span]
        self._fill([(_OPEN, *around, None), *steps, (_CLOSE, None, None, None)] if around is not None else steps, values, frame)
        self.open.remove(span)
