import struct

import pytest
from builders import FILETIME, UNDECODABLE, chunk_of, decode, event, raw
from hypothesis import given, settings, strategies as st

from logquarry.functions.binxml import NO_ROOT, frame_records
from logquarry.testing.writer import ChunkWriter, El, Slot, Value, text


def texts(nodes):
    return {path: value for path, _, _, value, _ in nodes}


def attrs(nodes):
    return {path: dict(pairs) for path, _, pairs, _, _ in nodes}


def instance(body, *values, key="t"):
    def write(writer: ChunkWriter):
        writer.buf += b"\x0f\x01\x01\x00"
        writer.instance(key, body, list(values))
        writer.buf.append(0)

    return write


def only(chunk):
    (_, error, nodes), = decode(chunk)
    return error, nodes


def test_plain_elements_in_document_order():
    error, nodes = only(chunk_of(event("Security")))
    assert error is None
    assert [n[0] for n in nodes][:3] == ["Event[0]", "Event[0]/System[0]", "Event[0]/System[0]/Provider[0]"]
    assert texts(nodes)["Event[0]/System[0]/Channel[0]"] == "Security"
    assert attrs(nodes)["Event[0]/System[0]/Provider[0]"] == {"Name": "P"}
    assert [n[4] for n in nodes][:3] == [False, False, True]


def test_names_and_templates_written_once_serve_later_records():
    body = El("Event", El("A", Slot(0)), El("A", Slot(1)))
    found = decode(chunk_of(*[instance(body, text(f"x{i}"), text(f"y{i}")) for i in range(3)]))
    assert [texts(n)["Event[0]/A[1]"] for _, _, n in found] == ["y0", "y1", "y2"]


def test_a_reference_ahead_of_the_definition():
    """The first record uses a template that only the second one defines."""
    use = struct.pack("<BBII", 0x0C, 1, 7, 0) + struct.pack("<IHBB", 1, 2, 1, 0) + "w".encode("utf-16-le")
    writer = ChunkWriter()
    writer.record(1, FILETIME, raw(b"\x0f\x01\x01\x00" + use + b"\0"))
    writer.record(2, FILETIME, instance(El("Event", El("Later", Slot(0))), text("v")))
    chunk = bytearray(writer.finish())
    struct.pack_into("<I", chunk, 512 + 24 + 4 + 6, writer.templates["t"])
    assert [texts(n)["Event[0]/Later[0]"] for _, _, n in decode(bytes(chunk))] == ["w", "v"]


def test_conditional_null_is_omitted_and_normal_null_is_empty():
    body = El("Event", El("A", c=Slot(0, optional=True), n=Slot(0)), El("B", Slot(0)), El("C", Slot(0, optional=True)))
    error, nodes = only(chunk_of(instance(body, Value(0, bytes(4)))))
    assert error is None
    assert attrs(nodes)["Event[0]/A[0]"] == {"n": ""}
    assert texts(nodes)["Event[0]/B[0]"] == texts(nodes)["Event[0]/C[0]"] == ""


def test_a_slot_beyond_the_values_is_null():
    _, nodes = only(chunk_of(instance(El("Event", El("A", Slot(9)), x=Slot(8, optional=True)))))
    assert texts(nodes)["Event[0]/A[0]"] == ""
    assert attrs(nodes)["Event[0]"] == {}


def test_a_nested_fragment_becomes_children_and_shifts_ordinals():
    body = El("Event", El("D", text("a")), Slot(0), El("D", text("b")))
    _, nodes = only(chunk_of(instance(body, El("D", text("inner")))))
    assert texts(nodes) == {"Event[0]": "", "Event[0]/D[0]": "a", "Event[0]/D[1]": "inner", "Event[0]/D[2]": "b"}


def test_a_nested_fragment_in_an_attribute_has_no_text():
    _, nodes = only(chunk_of(instance(El("Event", a=Slot(0)), El("X"))))
    assert attrs(nodes)["Event[0]"] == {"a": ""}


def test_a_nested_fragment_uses_the_values_around_it():
    body = El("Event", Slot(0), El("Z", text("z")))
    _, nodes = only(chunk_of(instance(body, El("X", Slot(1)), text("outer"))))
    assert texts(nodes)["Event[0]/X[0]"] == "outer"


def test_text_tokens():
    inner = b"\x07\x02\x00" + "cd".encode("utf-16-le")  # CDATA
    inner += b"\x08\x41\x00" + b"\x08\x00\xd8"  # a character, and one that is none
    inner += b"\x0b\x01\x00p\x00"  # processing instruction data
    _, nodes = only(chunk_of(El("Event", text("a"), inner, text("b"))))
    assert texts(nodes)["Event[0]"] == "acdAb"


def test_entity_reference_stays_literal():
    def write(writer):
        writer.buf += b"\x0f\x01\x01\x00\x01" + bytes(4)
        writer.name("Event")
        writer.buf += b"\x02\x09"
        writer.name("amp")
        writer.buf += b"\x0a"
        writer.name("target")
        writer.buf += b"\x04\x00"

    _, nodes = only(chunk_of(write))
    assert texts(nodes)["Event[0]"] == "&amp;"


def test_the_first_event_of_several_roots_counts():
    def write(writer):
        writer.fragment(El("Other", text("o")), El("Event", text("1")), El("Event", text("2")), El("Tail"))

    _, nodes = only(chunk_of(write))
    assert texts(nodes) == {"Event[0]": "1"}


def test_the_first_attribute_of_a_name_counts():
    def write(writer):
        writer.buf += b"\x0f\x01\x01\x00\x41" + bytes(4)
        writer.name("Event")
        size_at = len(writer.buf)
        writer.buf += bytes(4)
        for value in ("first", "second"):
            writer.buf.append(0x46)
            writer.name("a")
            writer.buf += b"\x05" + text(value).standalone()
        struct.pack_into("<I", writer.buf, size_at, len(writer.buf) - size_at - 4)
        writer.buf += b"\x03\x00"

    _, nodes = only(chunk_of(write))
    assert attrs(nodes)["Event[0]"] == {"a": "first"}


def test_names_with_path_marks_cannot_fake_structure():
    _, nodes = only(chunk_of(El("Event", El("EventData[0]/Data[0]", text("x")))))
    assert nodes[1][:2] == ("Event[0]/EventData%5B0]%2FData%5B0][0]", "EventData[0]/Data[0]")


def test_deep_elements_are_no_problem():
    def write(writer):
        writer.buf += b"\x0f\x01\x01\x00"
        for name in ["Event"] + ["N"] * 1500:
            writer.buf += b"\x01" + bytes(4)
            writer.name(name)
            writer.buf += b"\x02"
        writer.buf += b"\x04" * 1501 + b"\x00"

    _, nodes = only(chunk_of(write))
    assert len(nodes) == 1501
    assert [n[4] for n in nodes[-2:]] == [False, True]


@pytest.mark.parametrize(
    "content, message",
    [
        (UNDECODABLE, "unexpected token 0x04"),
        (El("Other", text("x")), NO_ROOT),
        (raw(b""), NO_ROOT),
        (raw(b"\x0d\x00\x00\x01"), "substitution outside of a template"),
        (raw(b"\x01"), None),
        (raw(b"\x01" + bytes(4) + b"\xff\xff\xff\xff"), None),
        (raw(b"\x0c" + bytes(9) + b"\xff\xff\xff\xff"), None),
        (raw(b"\x05\x7e"), "unsupported value type 0x7e"),
        (raw(b"\x05\x01\xff\xff"), "value ends beyond its record"),
        (instance(El("Event", Slot(0)), Value(0x80, bytes(4))), "array item without bytes"),
    ],
)
def test_bad_content_is_an_error_of_its_record_only(content, message):
    found = decode(chunk_of(event("A"), content, event("B")))
    assert [e is None for _, e, _ in found] == [True, False, True]
    assert found[1][2] == []
    if message:
        assert found[1][1] == message


def test_a_fragment_that_contains_itself_ends_with_an_error():
    body = El("Event", El("S", text("s")), Slot(0))
    itself = Value(0x21, b"\x0e\x00\x00\x21" * 3)  # three times the slot it stands in
    error, _ = only(chunk_of(instance(body, itself)))
    assert error == "fragment contains itself"


def test_text_multiplied_by_templates_is_whole():
    body = El("Event", El("A"), *[El("B", Slot(0)) for _ in range(1500)])
    error, nodes = only(chunk_of(instance(body, text("x" * 15000))))
    assert error is None and len(nodes) == 1502 and {n[3] for n in nodes[2:]} == {"x" * 15000}


def test_what_exceeds_a_row_keeps_what_was_read(monkeypatch):
    monkeypatch.setattr("logquarry.functions.binxml.MAX_WORK", 1 << 16)
    body = El("Event", El("A"), *[El("B", Slot(0)) for _ in range(100)])
    error, nodes = only(chunk_of(instance(body, text("x" * 15000))))
    assert error == "record gives more than a row can hold" and 2 < len(nodes) < 102


@pytest.mark.parametrize("depth", [70, 5000])
def test_deeply_nested_fragments_are_read(depth):
    inner = b"\x07\x04\x00" + "deep".encode("utf-16-le")
    for _ in range(depth):
        inner = b"\x05\x21" + struct.pack("<H", len(inner)) + inner
    error, nodes = only(chunk_of(instance(El("Event", El("A", Slot(0))), Value(0x21, inner))))
    assert error is None and texts(nodes)["Event[0]/A[0]"] == "deep"


def test_filetime_beyond_year_9999():
    from logquarry.functions.values import filetime_text

    assert filetime_text((1 << 63) - 1) == "30828-09-14T02:48:05.4775807Z"
    assert filetime_text(0) == "1601-01-01T00:00:00.0000000Z"
    assert filetime_text((1 << 64) - 1) == "60056-05-28T05:36:10.9551615Z"


def test_framing_ends_at_the_first_broken_record():
    writer = ChunkWriter()
    for number in range(4):
        writer.record(number, FILETIME, lambda w: w.fragment(El("Event")), break_frame=number == 2)
    assert [r for r, *_ in frame_records(writer.finish())] == [0, 1]


# -- random templates against a plain reading of the same elements ---------------------------------

names = st.sampled_from(["A", "B", "Event"])
leaf_values = st.one_of(st.just(Slot(0)), st.just(Slot(1, optional=True)), st.just(Slot(2)), st.builds(text, st.text("xy", max_size=2)))


def element(children):
    def build(name, items, attributes):
        return El(name, *items, **attributes)

    return st.builds(build, names, st.lists(children, max_size=4), st.dictionaries(st.sampled_from("ab"), leaf_values, max_size=2))


bodies = st.recursive(element(leaf_values), lambda inner: element(st.one_of(inner, leaf_values)), max_leaves=8)
plain_texts = st.builds(text, st.text("pq", max_size=3))
fragments = st.recursive(
    st.builds(lambda n, t: El(n, t), names, plain_texts),
    lambda inner: st.builds(lambda n, items: El(n, *items), names, st.lists(inner, max_size=3)),
    max_leaves=4,
)
slot_values = st.lists(st.one_of(plain_texts, st.just(Value(0)), fragments), max_size=3)


def expected_nodes(el: El, values: list, prefix: str = "", ordinals: dict | None = None) -> list:
    """Rows of an element, straight from the definition of paths, texts and leaves."""
    ordinals = {} if ordinals is None else ordinals
    path = f"{prefix}{el.name}[{ordinals.setdefault(el.name, 0)}]"
    ordinals[el.name] += 1

    def resolve(item):
        if not isinstance(item, Slot):
            return item
        value = values[item.index] if item.index < len(values) else Value(0)
        null = isinstance(value, Value) and value.kind == 0
        return None if null and item.optional else value

    def shown(item):
        return item.data.decode("utf-16-le") if isinstance(item, Value) and item.kind == 1 else ""

    attributes = {name: shown(resolve(item)) for name, item in el.attrs if resolve(item) is not None}
    inside, inner_ordinals, words = [], {}, []
    for child in map(resolve, el.children):
        if isinstance(child, El):
            inside += expected_nodes(child, values, path + "/", inner_ordinals)
        elif child is not None:
            words.append(shown(child))
    return [(path, el.name, attributes, "".join(words), not inside), *inside]


@settings(max_examples=300, deadline=None)
@given(bodies, st.lists(slot_values, min_size=1, max_size=3))
def test_random_templates(body, records):
    root = El("Event", El("S", text("s")), body, Slot(0), El("T", Slot(1)))
    found = decode(chunk_of(*[instance(root, *values) for values in records]))
    for values, (_, error, nodes) in zip(records, found):
        assert error is None
        assert [(p, n, dict(a), t, leaf) for p, n, a, t, leaf in nodes] == expected_nodes(root, values)


def sample_chunk():
    body = El("Event", El("System", El("EventID", Slot(0)), El("Channel", Slot(1))), Slot(2), El("U", El("K", Slot(3))))
    data = El("EventData", El("Data", text("v"), Name=text("n")), El("Data", Value(0x08, bytes(4))))
    numbers = Value(0x88, struct.pack("<3I", 1, 2, 3))
    return chunk_of(*[instance(body, Value(0x06, b"\x07\x00"), text("Ch"), data, numbers) for _ in range(3)], event("A"))


SAMPLE = sample_chunk()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(48, 2000), st.integers(0, 255)), min_size=1, max_size=12))
def test_damaged_bytes_never_break_the_chunk(changes):
    chunk = bytearray(SAMPLE)
    for at, value in changes:
        chunk[at] = value
    for _, error, nodes in decode(bytes(chunk)):
        assert (error is None) == bool(nodes)
        assert all(isinstance(shown, str) for _, _, _, shown, _ in nodes)


def typed_logs(count=40):
    """Chunks of records with one Data per value type, the last one cut inside."""
    from collections import namedtuple

    from logquarry.testing.logs import _write_log

    names = "record_id code channel provider level_text computer user_sid cents props k filetime"
    row = namedtuple("Row", names)
    rows = [
        row(n, 4624, "Security", "p", "3", "H", None, str(n * 37), "x" * (n % 5), str(n), FILETIME + n) for n in range(count)
    ]
    log = _write_log(rows, frozenset(("templated", "typed")))
    return [log[at : at + 65536] for at in range(4096, len(log), 65536)]


@pytest.mark.parametrize("typed", [False, True])
def test_fragments_of_one_shape_are_parsed_once_a_chunk(typed, monkeypatch):
    from logquarry.functions.binxml import ChunkDecoder
    from logquarry.functions.values import json_of

    def decoded(chunk):
        nodes, elements = [], []
        decoder = ChunkDecoder(chunk, nodes, typed)
        parse = decoder._element
        decoder._element = lambda *given: elements.append(1) or parse(*given)
        errors = [decoder.decode(start, end) for _, _, start, end in frame_records(chunk)]
        return errors, [(*node, json_of(node[3])) for node in nodes], len(elements)

    chunks = typed_logs()
    found = [decoded(chunk) for chunk in chunks]
    monkeypatch.setattr(ChunkDecoder, "_fill_shape", lambda self, span, values, frame: self._steps(*span, False))
    plain = [decoded(chunk) for chunk in chunks]
    assert [f[:2] for f in found] == [p[:2] for p in plain]
    assert all(f[2] * 4 < p[2] for f, p in zip(found, plain))


@given(st.lists(st.tuples(st.text(max_size=4), st.integers(-128, 127), st.booleans()), min_size=3, max_size=12), st.integers(0, 400))
@settings(max_examples=60, deadline=None)
def test_shapes_change_nothing_in_odd_or_damaged_fragments(items, damage):
    from logquarry.functions.binxml import ChunkDecoder

    def body(value, number, extra):
        more = [El("X", text(value))] if extra else []
        return El("D", El("A", text(value), n=text("a")), El("B", Value(0x03, struct.pack("<b", number))), *more)

    shell = El("Event", Slot(0, kind=0x21))
    chunk = bytearray(chunk_of(*[instance(shell, body(*item)) for item in items]))
    chunk[512 + damage * 2] ^= damage & 0xFF

    def run():
        nodes = []
        decoder = ChunkDecoder(bytes(chunk), nodes)
        return [decoder.decode(start, end) for _, _, start, end in frame_records(bytes(chunk))], nodes

    found, used = run(), ChunkDecoder._fill_shape
    ChunkDecoder._fill_shape = lambda self, span, values, frame: self._steps(*span, False)
    try:
        assert found == run()
    finally:
        ChunkDecoder._fill_shape = used


def test_batches_of_decoded_records_are_bounded_by_their_nodes():
    import pyarrow as pa

    from logquarry.sources import decode as sources

    chunks = pa.array(typed_logs(1200))
    keep = pa.RecordBatch.from_arrays([pa.array(range(len(chunks)))], names=["chunk_index"])
    batches = list(sources._decode_chunk_rows(keep, chunks))
    assert sum(b.num_rows for b in batches) == 1200 and len(batches) > 1
    assert all(len(b.column("nodes").flatten()) < 20_000 for b in batches)
