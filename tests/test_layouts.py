"""Event data by layouts against the same taken from whole documents."""

import struct

import logquarry as lq
import pytest
from builders import chunk_of, event, log_of
from hypothesis import given, settings, strategies as st
from logquarry.functions.binxml import frame_records
from logquarry.functions.layouts import SYSTEM, DataDecoder, Known
from logquarry.sources.decode import SYSTEM_FIELDS, decode_chunks
from logquarry.sources.headers import readable_evtx
from logquarry.testing.logs import evtx_logs
from logquarry.testing.writer import El, Slot, Value, text
from test_binxml import typed_logs

FIELDS = [(f"{SYSTEM}{element}[0]", attribute) for element, attribute in SYSTEM_FIELDS.values()]


def records(chunks, by_layout=True):
    """(System texts, error, data) of each record, and how many were decoded as a whole."""
    found, whole, known = [], [], Known()
    for chunk in chunks:
        keys, texts, jsons = [], [], []
        decoder = DataDecoder(chunk, FIELDS, known, keys, texts, jsons)
        decode = decoder.decode
        decoder.decode = lambda *given, decode=decode: whole.append(1) or decode(*given)
        if not by_layout:
            decoder._known = lambda *given: None
        for _, _, start, end in frame_records(chunk):
            first = len(keys)
            system, error = decoder.record(start, end)
            found.append((*system, error, *zip(keys[first:], texts[first:], jsons[first:])))
    return found, len(whole)


def test_records_of_known_layouts_are_not_decoded_as_documents():
    chunks = typed_logs(400)
    found, whole = records(chunks)
    wanted, _ = records(chunks, by_layout=False)
    assert found == wanted and len(found) == 400
    assert whole <= len(chunks) + 3  # the first of each chunk has its names, and every layout is seen once before


def templated(shell, *values):
    def write(writer):
        writer.buf += b"\x0f\x01\x01\x00"
        writer.instance(id(shell), shell, list(values))
        writer.buf.append(0)

    return write


def shell(name):
    """Slots in attributes, beside texts and elements, twice, of equal names, and outside of the event."""
    data = [
        El("Data", Slot(0), Name=text("a")), El("Data", Slot(1)), El("Data", Slot(0), Name=text(name)), El("Data", Name=text("a")),
        El("Data", Slot(2, True, 0x08), text("x"), Name=text("mixed")), El("Data", El("Inner", Slot(0)), Slot(1), Name=text("deep")),
    ]
    system = El("System", El("Provider", Name=Slot(0)), El("EventID", Slot(2, kind=8)), El("Security", UserID=Slot(1, True)))
    user = El("UserData", El("X", El("Y", Slot(1)), El("Y", Slot(3, kind=0x21)), El("Z.1", text(" "))))
    return El("Event", system, El("EventData", *data, El("Binary", Slot(4, kind=0x81))), Slot(3, kind=0x21), user)


texts = st.sampled_from(["", " ", "\u00a0", "\x1c", "v", 'a,"b\\', "\ue000", "\u00e9"])
items = st.lists(st.tuples(texts, st.one_of(texts, st.none()), st.integers(0, 2**32 - 1), texts, st.booleans()), min_size=4, max_size=10)


@given(items, st.sampled_from(["a", "b", "\ue000"]), st.integers(0, 900), st.integers(0, 255))
@settings(max_examples=150, deadline=None)
def test_layouts_change_nothing_in_odd_or_damaged_records(items, name, place, damage):
    plain, named = shell(name), El("Event", El("EventData", El("Data", Slot(0), Name=Slot(1))))

    def record(first, second, number, inner, other):
        second = Value(0) if second is None else text(second)
        nested = El("More", El("Data", text(inner), Name=text("n")), Slot(0))
        joined = Value(0x81, "\0".join([first, inner, ""]).encode("utf-16-le"))
        return templated(named if other else plain, text(first), second, Value(8, struct.pack("<I", number)), nested, joined)

    chunks = [chunk_of(*[record(*item) for item in part]) for part in (items, items[::-1])]
    damaged = bytearray(chunks[1])
    damaged[512 + place] ^= damage
    chunks.append(bytes(damaged))
    assert records(chunks)[0] == records(chunks, by_layout=False)[0]


@pytest.mark.parametrize("variant", [("templated", "typed"), ("templated", "odd_data", "bad_records"), ("typed",), ("templated", "hostile")])
def test_typed_records_have_the_columns_of_their_documents(spark, variant):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    files = evtx_logs(table, *variant).persist()
    found = lq.read_evtx(files, typed=True)
    chunks = lq.flag_integrity(lq.split_chunks(readable_evtx(files))).drop("length", "modificationTime")
    wanted = lq.map_event(decode_chunks(chunks, True))
    columns = [c for c in found.columns if c not in ("data", "typed_data")]

    def rows(frame):
        plain = frame.selectExpr(*columns, "array_sort(map_entries(data)) d", "to_json(transform_values(typed_data, (k, v) -> to_json(v))) t")
        return sorted(map(repr, plain.collect()))

    assert rows(found) == rows(wanted) and found.count() == table.count()
    files.unpersist()


def test_data_by_its_document_where_names_are_values(spark):
    odd = El("Event", El("EventData", El("Data", Slot(0), Name=Slot(1)), El("Data", text("z"), Name=text("k"))))
    write = [templated(odd, text(str(n)), text("k" if n == 2 else f"k{n}")) for n in range(4)]
    files = spark.createDataFrame([("/a", bytearray(log_of(*write, event("A"))))], "path string, content binary")
    found = lq.read_evtx(files, typed=True).orderBy("record_index").selectExpr("data", "channel").collect()
    assert [{k.rpartition(".")[2]: v for k, v in row.data.items()} for row in found] == [
        {"k0": "0", "k": "z"}, {"k1": "1", "k": "z"}, {"k": "z"}, {"k3": "3", "k": "z"}, {},
    ]
    assert [row.channel for row in found] == ["", "", "", "", "A"]


def test_large_data_is_parsed_value_by_value(spark):
    many = El("Event", El("EventData", *[El("Data", Slot(0), Name=text(f"k{i}")) for i in range(600)]))
    files = spark.createDataFrame([("/a", bytearray(log_of(*[templated(many, text(c * size)) for c, size in zip('a"b', (2000, 1900, 3))])))], "path string, content binary")
    rows = lq.read_evtx(files, typed=True).orderBy("record_index").collect()
    for row, value in zip(rows, ("a" * 2000, '"' * 1900, "bbb")):
        assert {k: v.toPython() for k, v in row.typed_data.items()} == row.data == {f"winlog.event_data.k{i}": value for i in range(600)}
