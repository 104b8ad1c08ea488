"""Decoder of one 64 KiB chunk: frames its records and turns each one into flat document nodes.

A fragment is first read into a short list of steps with open slots. Template bodies are read once
per chunk; every record then only fills the slots of the finished list. All offsets are relative
to the chunk, so chunks share nothing and each one can be decoded anywhere.
"""

from __future__ import annotations

import copy
import struct
import sys

from pyspark import cloudpickle

from .values import NULL, WSTRING, BadRecord, FixedRun, Typed, is_fixed, read_value, typed_form, typed_value, utf16_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_HEADER_SIZE = 512
RECORD_MAGIC = b"\x2a\x2a\x00\x00"
_RECORD_HEADER = "<4sIQQ"
_DESCRIPTOR = "<HBx"

NO_ROOT = "BinXML fragment decoded but contained no Event root element"  # fixed value

# Fixed values of the format: token types (low nibble of the token byte).
END_OF_FRAGMENT = 0x00
OPEN_ELEMENT = 0x01
CLOSE_START = 0x02
CLOSE_EMPTY = 0x03
END_ELEMENT = 0x04
VALUE = 0x05
ATTRIBUTE = 0x06
CDATA = 0x07
CHAR_REF = 0x08
ENTITY_REF = 0x09
PI_TARGET = 0x0A
PI_DATA = 0x0B
TEMPLATE_INSTANCE = 0x0C
NORMAL_SUBSTITUTION = 0x0D
CONDITIONAL_SUBSTITUTION = 0x0E
FRAGMENT_HEADER = 0x0F

_VALUE_TOKENS = (VALUE, NORMAL_SUBSTITUTION, CONDITIONAL_SUBSTITUTION)

# Step kinds. A leaf is an element with nothing but one text or slot inside.
_LEAF, _OPEN, _CLOSE, _TEXT, _SLOT, _INSTANCE, _SPAN = range(7)

# What one row can hold: characters of output, a step counted as _STEP_COST. A record has 64 KiB, but
# templates can multiply it. Nesting has no limit of its own: it ends, or a fragment contains itself.
MAX_WORK = 1 << 27
_STEP_COST = 64
_NO_ATTRIBUTES: list = []


class RowFull(BadRecord):
    """The record gives more than one row can hold."""


class Values(list):
    """Substitution values, told apart by where they were read."""

    at = -1


def frame_records(chunk: bytes):
    """(record id, filetime, start, end) of each record until the first broken frame."""
    scan_end = min(int.from_bytes(chunk[48:52], "little"), len(chunk))
    pos = CHUNK_HEADER_SIZE
    while pos + 4 <= scan_end and pos + 24 <= len(chunk):
        magic, size, record_id, filetime = struct.unpack_from(_RECORD_HEADER, chunk, pos)
        after = pos + size
        if magic != RECORD_MAGIC or size < 28 or after > len(chunk):
            return
        if chunk[after - 4 : after] != chunk[pos + 4 : pos + 8]:
            return
        yield record_id, filetime, pos + 24, after - 4
        pos = after


class Shape:
    """What fragments of one kind in a chunk have in common: their bytes between the values, and their steps with
    places for the values. ``plans`` are their nodes by where they stand in the document."""

    misses = hits = 0

    def __init__(self, parts: list[tuple], tail: bytes, ended: bool, steps: list[tuple], holes: list[int]):
        self.tail, self.ended, self.steps, self.holes = tail, ended, steps, holes
        self.pieces = [*[before for before, _ in parts], tail]
        self.named: list[tuple] = []  # (piece, offset in it, name) of the references to names
        self.kinds = [kind for _, kind in parts if kind >= 0]  # of the values
        self.forms = [typed_form(kind) for kind in self.kinds]
        self.plans: dict[tuple, tuple | None] = {}
        # Runs of values of fixed width, and after each the bytes before a value of another type, if one follows.
        self.runs: list[tuple[FixedRun | None, bytes, int]] = []
        run = []
        for before, kind in parts:
            if kind < 0 or is_fixed(kind):
                run.append((before, kind))
            else:
                self.runs.append((FixedRun(run) if run else None, before, kind))
                run = []
        if run:
            self.runs.append((FixedRun(run), b"", -1))

    def with_names(self, offsets: dict[tuple, bytes]) -> Shape | None:
        """The same shape in a chunk with the names at other offsets; None where it lacks one."""
        pieces = list(map(bytearray, self.pieces))
        for piece, at, name in self.named:
            if name not in offsets:
                return None
            pieces[piece][at : at + 4] = offsets[name]
        other = copy.copy(self)
        other.pieces, other.runs = list(map(bytes, pieces)), []
        *rest, other.tail = other.pieces
        rest = iter(rest)
        for run, before, kind in self.runs:
            if run is not None:
                run = copy.copy(run)
                run.same = tuple([next(rest) for _ in run.same])
            other.runs.append((run, next(rest) if kind >= 0 else before, kind))
        return other


class ChunkDecoder:
    """Decodes the records of one chunk, appending (path, name, attributes, text, is leaf) rows.

    Fields are read without a check each; what a token took is checked against the end of its
    record once it is complete. Reads never leave the chunk. With ``typed``, texts of single values that are no
    text by type are ``Typed``.
    """

    def __init__(self, chunk: bytes, nodes: list[tuple], typed: bool = False):
        self.buf, self.typed, self.nothing = chunk, typed, Typed() if typed else ""
        self.nodes = nodes
        self.names: dict[int, tuple[str, str]] = {}
        self.bodies: dict[int, list | None] = {}
        self.places: dict[int, dict | None] = {}
        self.shapes: dict[bytes, Shape] = {}
        self.names_inside = False

    def decode(self, start: int, end: int) -> str | None:
        """Appends the nodes of the record's Event element; returns what went wrong, if anything."""
        nodes, first = self.nodes, len(self.nodes)
        self.work, self.roots, self.open = MAX_WORK, [], set()
        # Frames of plain functions lie on the heap; a chunk's bytes bound their number.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1 << 20))
        partial = None
        try:
            self._fill(self._steps(start, end, False), None, ["", {}, [], -1])
        except RowFull as problem:
            partial = str(problem)
        except BadRecord as problem:
            del nodes[first:]
            return str(problem)
        except (IndexError, struct.error):
            del nodes[first:]
            return "record ends inside a field"
        return partial if self._event_only(first) else NO_ROOT

    def _event_only(self, first: int) -> bool:
        """Leaves the first root with that name, if there is one, of the nodes from ``first`` on."""
        nodes = self.nodes
        wanted = next((i for i, row in enumerate(self.roots) if nodes[row][1] == "Event"), None)
        if wanted is None:
            del nodes[first:]
            return False
        if len(self.roots) > 1:
            if wanted + 1 < len(self.roots):
                del nodes[self.roots[wanted + 1] :]
            del nodes[first : self.roots[wanted]]
        return True

    @property
    def work_done(self) -> int:
        """Work of the last record: grows with the text it gave."""
        return MAX_WORK - self.work

    # -- single fields ---------------------------------------------------------------------

    def system_texts(self, start: int, end: int, wanted: tuple) -> list | None:
        """What ``decode`` would give for some System fields if it finds no error, without reading the rest of the
        record. None where only ``decode`` can tell. A field is an element or (element, attribute)."""
        buf = self.buf
        try:
            pos = start + 5
            if buf[start] & 0x0F != FRAGMENT_HEADER or buf[pos - 1] & 0x0F != TEMPLATE_INSTANCE:
                return None
            at = self._uint(pos + 5, 4)
            pos += 9
            if at == pos:
                pos += 24 + self._uint(pos + 20, 4)
            if at not in self.places:
                self.places[at] = self._system_places(self._body(at))
            places = self.places[at]
            if places is None:
                return None
            count = self._uint(pos, 4)
            values_at = pos + 4 + 4 * count
            if values_at > end:
                return None
            declared = struct.unpack_from(f"<{2 * count}H", buf, pos + 4)
            after = values_at + sum(declared[::2])
            if after > end or after < end and buf[after] & 0x0F != END_OF_FRAGMENT:
                return None  # something follows the template
            texts = []
            for field in wanted:
                text = places.get(field)
                if type(text) is tuple:
                    slot, absent = text
                    value = None
                    if slot < count:
                        value_at = values_at + sum(declared[: 2 * slot : 2])
                        value, _ = read_value(buf, value_at, declared[2 * slot + 1] & 0xFF, declared[2 * slot], end)
                    if type(value) is tuple:
                        return None
                    text = absent if value is None else value
                texts.append(text)
            return texts
        except (BadRecord, IndexError, struct.error):
            return None

    def _system_places(self, steps: list[tuple]) -> dict | None:
        """Text, or (slot, text without a value), of each plain child of Event/System in a template; the first of a
        name counts. None where what fills the slots could change the document around them."""
        if [kind == _OPEN and a[1] for kind, a, _, _ in steps[:2]] != ["Event", "System"]:
            return None
        places, depth, inside = {}, 2, True
        for kind, a, b, text in steps[2:]:
            if kind == _CLOSE:
                depth -= 1
                inside = inside and depth > 1
            elif kind == _TEXT:
                continue
            elif depth == 0 or kind > _OPEN and inside and depth == 2:
                return None
            elif kind <= _OPEN:
                if inside and depth == 2 and a[1] not in places:
                    if kind == _OPEN or len({name for name, _ in b}) < len(b):
                        return None
                    places[a[1]] = (text[0], "") if type(text) is tuple else text
                    for name, value in b:
                        places[a[1], name] = (value[0], None if value[1] else "") if type(value) is tuple else value
                depth += kind == _OPEN
        return places

    # -- reading ---------------------------------------------------------------------------

    def _uint(self, pos: int, width: int) -> int:
        return int.from_bytes(self.buf[pos : pos + width], "little")

    def _steps(self, pos: int, end: int, in_template: bool, cuts: list | None = None) -> list[tuple]:
        """Steps of a fragment. ``cuts`` takes (start, end, step or -1) of the bytes that may differ in a fragment of
        the same shape, and last (end, end, last token)."""
        buf, steps, opened, kind = self.buf, [], 0, -1
        while pos < end:
            token = buf[pos]
            pos += 1
            kind = token & 0x0F
            if kind == OPEN_ELEMENT:
                if cuts is not None:
                    cuts.append((pos, pos + 4, -1))
                name, attrs, is_open, pos = self._element(token, pos, end, in_template)
                if not is_open:
                    steps.append((_LEAF, name, attrs, ""))
                elif buf[pos] & 0x0F in _VALUE_TOKENS:  # one value and nothing else makes a leaf
                    at, is_value = pos + 1, buf[pos] & 0x0F == VALUE
                    step, pos = self._value(buf[pos] & 0x0F, pos + 1, end)
                    if cuts is not None and is_value:
                        leaf = buf[pos] & 0x0F == END_ELEMENT and step[0] != _SPAN
                        cuts.append((at, pos, len(steps) + (not leaf)))
                    if buf[pos] & 0x0F == END_ELEMENT and step[0] != _SPAN:
                        text = step[1] if step[0] == _TEXT else step[1:3]
                        steps.append((_LEAF, name, attrs, text))
                        pos += 1
                    else:
                        opened += 1
                        steps += (_OPEN, name, attrs, None), step
                else:
                    opened += 1
                    steps.append((_OPEN, name, attrs, None))
            elif kind in _VALUE_TOKENS:
                at = pos
                step, pos = self._value(kind, pos, end)
                if cuts is not None and kind == VALUE:
                    cuts.append((at, pos, len(steps)))
                steps.append(step)
            elif kind == END_ELEMENT and opened:
                steps.append((_CLOSE, None, None, None))
                opened -= 1
            elif kind == TEMPLATE_INSTANCE:
                step, pos = self._instance(pos, end)
                steps.append(step)
            elif kind in (CDATA, PI_DATA):
                size = 2 * self._uint(pos, 2)
                pos += 2
                if kind == CDATA:
                    steps.append((_TEXT, utf16_text(buf[pos : pos + size]), None, None))
                pos += size
            elif kind == CHAR_REF:
                code = self._uint(pos, 2)
                pos += 2
                if not 0xD800 <= code <= 0xDFFF:
                    steps.append((_TEXT, chr(code), None, None))
            elif kind == ENTITY_REF:
                (name, _), pos = self._name(pos)
                steps.append((_TEXT, f"&{name};", None, None))
            elif kind == PI_TARGET:
                _, pos = self._name(pos)
            elif kind == FRAGMENT_HEADER and not opened:
                pos += 3
            elif kind == END_OF_FRAGMENT and not opened:
                break
            else:
                raise BadRecord(f"unexpected token 0x{token:02x}")
            if pos > end:
                raise BadRecord("record ends inside a field")
        if opened:
            raise BadRecord("fragment ends inside an element")
        if cuts is not None:
            cuts.append((pos, pos, kind))
        return steps

    # -- fragments of one shape ------------------------------------------------------------

    def _learn(self, start: int, end: int) -> tuple[list[tuple], Shape | None]:
        """The steps of a fragment, and its shape where another one can have it: no name or template is defined inside,
        and no fragment nested."""
        cuts, self.names_inside = [], False
        steps = self._steps(start, end, False, cuts)
        _, stop, last = cuts.pop()
        if self.names_inside or any(step[0] >= _INSTANCE for step in steps):
            return steps, None
        parts, holes, pos = [], [], start
        for at, after, step in cuts:
            if step < 0:
                parts.append((self.buf[pos:at], -1))
            else:
                parts.append((self.buf[pos : at + 1], self.buf[at]))
                holes.append(step)
            pos = after
        shape = Shape(parts, self.buf[pos:stop], last == END_OF_FRAGMENT, steps, holes)
        shape.starts = [start, *[after for _, after, _ in cuts]]
        return steps, shape

    def _texts(self, shape: Shape, pos: int, end: int) -> list | None:
        """The values of a fragment with the bytes of ``shape``; None for any other."""
        buf, found = self.buf, []
        try:
            for run, before, kind in shape.runs:
                if run is not None:
                    if not run.read(buf, pos, found):
                        return None
                    pos += run.width
                if kind < 0:
                    break
                if not buf.startswith(before, pos):
                    return None
                at = pos + len(before)
                value, pos = read_value(buf, at, kind, None, end)
                found.append("" if value is None else value)
        except (BadRecord, IndexError, struct.error):
            return None
        if not buf.startswith(shape.tail, pos):
            return None
        pos += len(shape.tail)
        return found if pos == end or shape.ended and pos < end else None

    def _plan(self, shape: Shape, prefix: str, ordinals: dict) -> tuple | None:
        """(path, name, attrs, text, is leaf, hole, slot) of each node, the work without texts from values, and how often
        each label stands at the top. None where texts stand beside elements, or attributes have slots."""
        found, stack, work = [], [], _STEP_COST * (len(shape.steps) + 1)
        counts = top = dict(ordinals)
        holes = {step: number for number, step in enumerate(shape.holes)}
        for number, (kind, a, b, c) in enumerate(shape.steps):
            if kind == _CLOSE:
                row, above, prefix = stack.pop()
                found[row][4] = not counts
                counts = above
                continue
            if kind > _OPEN or type(b) is tuple:
                return None
            name, label = a
            path = f"{prefix}{label}[{counts.get(label, 0)}]"
            counts[label] = counts.get(label, 0) + 1
            hole, slot = holes.get(number, -1), -1
            if type(c) is tuple:
                slot, c = c[0], ""
            work += len(path) + (len(c) if kind == _LEAF and hole < 0 else 0)
            found.append([path, name, b, c if kind == _LEAF and hole < 0 else "", True, hole, slot])
            if kind == _OPEN:
                stack.append((len(found) - 1, counts, prefix))
                counts, prefix = {}, path + "/"
        return [tuple(row) for row in found], work, top

    def _fill_shape(self, span: tuple[int, int], values: Values | None, frame: list) -> list[tuple] | None:
        """Fills a fragment by its shape, if it has a known one; else gives its steps."""
        start, end = span
        buf = self.buf
        key = buf[start : start + 5] + buf[start + 9 : start + 13]
        shape = self.shapes.get(key)
        if shape is None or shape.misses > 8 + shape.hits:
            if shape is not None:
                return self._steps(start, end, False)
            steps, shape = self._learn(start, end)
            if shape is not None:
                self.shapes[key] = shape
            return steps
        texts = self._texts(shape, start, end)
        if texts is None:
            steps, other = self._learn(start, end)
            if other is not None:
                other.misses, other.hits = shape.misses + 1, shape.hits
                self.shapes[key] = other
            else:
                shape.misses += 1
            return steps
        shape.hits += 1
        if self.typed:
            texts = self._typed(shape, texts)
        prefix, ordinals, _, row = frame
        place = (prefix, *ordinals.items())
        if place not in shape.plans:
            shape.plans[place] = self._plan(shape, prefix, ordinals) if row >= 0 else None
        plan = shape.plans[place]
        if plan is not None:
            rows, work, top = plan
            nodes, first, nothing = self.nodes, len(self.nodes), self.nothing
            count = len(values) if values is not None else -1
            for path, name, attrs, text, leaf, hole, slot in rows:
                if hole >= 0:
                    text = texts[hole]
                    work += len(text)
                elif slot >= 0:
                    text = values[slot] if slot < count else None
                    if type(text) is tuple or count < 0:
                        break
                    if text is None:
                        text = nothing
                    work += len(text)
                nodes.append((path, name, attrs, text, leaf))
            else:
                if work <= self.work:
                    self.work -= work
                    ordinals.update(top)
                    return None
            del nodes[first:]
        return self._filled(shape, texts)

    def _typed(self, shape: Shape, texts: list) -> list:
        nothing = self.nothing
        return [
            nothing if kind == NULL else text if form is None else form(text)
            for kind, form, text in zip(shape.kinds, shape.forms, texts)
        ]

    @staticmethod
    def _filled(shape: Shape, texts: list) -> list[tuple]:
        steps = list(shape.steps)
        for number, text in zip(shape.holes, texts):
            kind, a, b, _ = steps[number]
            steps[number] = (_TEXT, text, None, None) if kind == _TEXT else (kind, a, b, text)
        return steps

    def _element(self, token: int, pos: int, end: int, in_template: bool):
        buf = self.buf
        pos += 6 if in_template else 4  # dependency id only in templates; data size unused
        name, pos = self._name(pos)
        if token & 0x40 == 0 and buf[pos] == CLOSE_START:
            return name, _NO_ATTRIBUTES, True, pos + 1
        attrs, fixed = [], True
        if token & 0x40:
            list_end = pos + 4 + self._uint(pos, 4)
            pos += 4
            while pos < list_end:
                if buf[pos] & 0x0F != ATTRIBUTE:
                    raise BadRecord("attribute expected")
                (attr, _), pos = self._name(pos + 1)
                kind = buf[pos] & 0x0F
                if kind not in _VALUE_TOKENS:
                    raise BadRecord("attribute without a value")
                (kind, a, b, _), pos = self._value(kind, pos + 1, end)
                if kind == _SLOT:
                    fixed = False
                    attrs.append((attr, (a, b)))
                else:  # a nested fragment has no text form
                    attrs.append((attr, a if kind == _TEXT else ""))
        if fixed and len(attrs) > 1:
            attrs = list(dict(reversed(attrs)).items())  # the first attribute of a name counts
        closing = buf[pos] & 0x0F
        if closing not in (CLOSE_START, CLOSE_EMPTY):
            raise BadRecord(f"unexpected token 0x{buf[pos]:02x} in a start tag")
        return name, attrs if fixed else tuple(attrs), closing == CLOSE_START, pos + 1

    def _value(self, kind: int, pos: int, end: int):
        if kind == VALUE:
            at = pos
            value, pos = read_value(self.buf, at + 1, self.buf[at], None, end)
            if self.typed:
                value = typed_value(value, self.buf, at + 1, self.buf[at], None, end)
            step = (_SPAN, *value, None) if isinstance(value, tuple) else (_TEXT, self.nothing if value is None else value, None, None)
            return step, pos
        # The declared type that follows the slot number is not needed.
        return (_SLOT, self._uint(pos, 2), kind == CONDITIONAL_SUBSTITUTION, None), pos + 3

    def _name(self, pos: int):
        """A name with its form in node paths, and the position after the reference."""
        at = int.from_bytes(self.buf[pos : pos + 4], "little")
        pos += 4
        entry = self.names.get(at)
        if entry is not None and at != pos:
            return entry, pos
        if entry is None:
            size = 2 * self._uint(at + 6, 2)
            if at + 8 + size > len(self.buf):
                raise BadRecord("name ends beyond its chunk")
            name = utf16_text(self.buf[at + 8 : at + 8 + size])
            label = name
            for mark in "%/[":  # would be read as path structure
                label = label.replace(mark, f"%{ord(mark):02X}")
            entry = self.names[at] = (name, label)
        if at == pos:  # the name sits inside its first use
            self.names_inside = True
            pos += 10 + 2 * self._uint(at + 6, 2)
        return entry, pos

    def _instance(self, pos: int, end: int):
        buf = self.buf
        at = self._uint(pos + 5, 4)
        pos += 9
        if at == pos:  # the definition sits inside its first use
            pos += 24 + self._uint(pos + 20, 4)
        if pos + 4 > end:
            raise BadRecord("template ends beyond its record")
        steps = self._body(at)
        values_at = pos + 4 + 4 * self._uint(pos, 4)
        if values_at > end:
            raise BadRecord("more substitutions than the record has room for")
        values = Values()
        values.at = pos
        for size, kind in struct.iter_unpack(_DESCRIPTOR, buf[pos + 4 : values_at]):
            if kind == WSTRING and not size & 1 and values_at + size <= end:  # the usual case
                values.append(utf16_text(buf[values_at : values_at + size]))
                values_at += size
            else:
                at = values_at
                value, values_at = read_value(buf, at, kind, size, end)
                values.append(typed_value(value, buf, at, kind, size, end) if self.typed else value)
        return (_INSTANCE, steps, values, None), values_at

    def _body(self, at: int) -> list[tuple]:
        steps = self.bodies.get(at)
        if steps is None:
            if at in self.bodies:
                raise BadRecord("template contains itself")
            start = at + 24
            if start > len(self.buf):
                raise BadRecord("template beyond its chunk")
            end = min(start + self._uint(at + 20, 4), len(self.buf))
            self.bodies[at] = None
            try:
                steps = self._steps(start, end, True)
            finally:
                del self.bodies[at]
            self.bodies[at] = steps
        return steps

    # -- filling ---------------------------------------------------------------------------

    def _span(self, span: tuple[int, int], values: Values | None, around, frame: list):
        """Fills a nested fragment. One that is open already with the same values would never end."""
        key = (*span, values.at if values is not None else -1)
        if key in self.open:
            raise BadRecord("fragment contains itself")
        self.open.add(key)
        steps = self._fill_shape(span, values, frame) if around is None else self._steps(*span, False)
        if steps is None:
            self.open.remove(key)
            return
        if around is not None:
            steps = [(_OPEN, *around, None), *steps, (_CLOSE, None, None, None)]
        self._fill(steps, values, frame)
        self.open.remove(key)

    def _fill(self, steps: list[tuple], values: Values | None, frame: list):
        """Runs the steps inside ``frame``: [path prefix, ordinals by label, texts, row]."""
        nodes, stack = self.nodes, []
        prefix, ordinals, texts, row = frame
        work = self.work - _STEP_COST * (len(steps) + 1)
        for kind, a, b, c in steps:
            if kind <= _OPEN:  # a leaf or the start of any other element
                if type(c) is tuple:
                    c = self._slot(c[0], values)
                    if type(c) is tuple:  # the slot holds elements: no leaf after all
                        self.work = work
                        self._span(c, values, (a, b), [prefix, ordinals, texts, row])
                        work = self.work
                        continue
                    if c is None:
                        c = self.nothing
                name, label = a
                if label in ordinals:
                    path = f"{prefix}{label}[{ordinals[label]}]"
                    ordinals[label] += 1
                else:
                    path = f"{prefix}{label}[0]"
                    ordinals[label] = 1
                if row < 0:
                    self.roots.append(len(nodes))
                if type(b) is tuple:
                    b = self._attributes(b, values)
                    work -= sum(len(value) for _, value in b)
                work -= len(path)
                if kind == _OPEN:
                    stack.append((prefix, ordinals, texts, row))
                    prefix, ordinals, texts, row = path + "/", {}, [], len(nodes)
                    nodes.append((path, name, b, "", True))
                else:
                    work -= len(c)
                    nodes.append((path, name, b, c, True))
            elif kind == _CLOSE:
                path, name, attrs, _, _ = nodes[row]
                nodes[row] = (path, name, attrs, "".join(texts), not ordinals)
                prefix, ordinals, texts, row = stack.pop()
            elif kind == _TEXT:
                work -= len(a)
                texts.append(a)
            else:
                inner = a
                if kind == _SLOT:
                    inner = self._slot(a, values)
                    if type(inner) is not tuple:
                        if inner is not None:
                            work -= len(inner)
                            texts.append(inner)
                        continue
                elif kind == _SPAN:
                    inner = (a, b)
                self.work = work
                if kind == _INSTANCE:
                    self._fill(a, b, [prefix, ordinals, texts, row])
                else:
                    self._span(inner, values, None, [prefix, ordinals, texts, row])
                work = self.work
            if work < 0:
                raise RowFull("record gives more than a row can hold")
        self.work = work

    def _slot(self, index: int, values: Values | None):
        if values is None:
            raise BadRecord("substitution outside of a template")
        return values[index] if index < len(values) else None

    def _attributes(self, attrs: tuple, values: list | None) -> list[tuple[str, str]]:
        found: dict[str, str] = {}
        for name, value in attrs:
            if type(value) is tuple:
                slot, optional = value
                value = self._slot(slot, values)
                if value is None and optional:
                    continue
                if not isinstance(value, str):
                    value = ""
            found.setdefault(name, value)  # the first attribute of a name counts
        return list(found.items())
