"""The pass over stored logs: filters in the decoder, failures as rows, large legacy logs in pieces."""

import os
import random
import struct

import pytest
from builders import UNDECODABLE, chunk_of, decode, event, log_of, raw
from test_evt import record

import logquarry as lq
from logquarry.functions.binxml import ChunkDecoder, frame_records
from logquarry.functions.evtrecords import Window, chains, evt_records, log_bounds, walk
from logquarry.plans import ingest
from logquarry.testing.logs import TEMPLATE
from logquarry.testing.writer import ChunkWriter, El, Slot, Value, evt_file, evtx_file, sid_bytes, text


@pytest.fixture
def store(tmp_path):
    def write(contents, root=None):
        for path, data in contents.items():
            target = tmp_path / path.lstrip("/")
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(data)
        return str(tmp_path)

    return write


def short(path):
    return path.rpartition("/")[2]


# -- failures ---------------------------------------------------------------------------------------------


def shortened(store):
    """Five logs; three of them lose their end after they are listed."""
    logs = {f"/{name}.evtx": evtx_file([chunk_of(event(name), first_id=i) for i in range(1, 71)]) for name in "ABC"}
    logs |= {f"/{name}.evt": evt_file([record(n) for n in range(1, 90)]) for name in "DE"}
    root = store(logs)

    def cut():
        os.truncate(f"{root}/A.evtx", 4096 + 65536 * 66 + 100)
        os.truncate(f"{root}/B.evtx", 4096)
        os.truncate(f"{root}/D.evt", 2000)

    return root, cut


def test_a_log_that_becomes_shorter_is_one_error(spark, store):
    root, cut = shortened(store)
    heads = lq.read_heads(lq.list_logs(spark, root)).persist()
    heads.count()
    cut()
    tagged = lq.tagged_records(lq.examine(heads), partitions=3)
    found = lq.records_of(tagged).groupBy("path").count().collect()
    assert {short(r.path): r["count"] for r in found} == {"A.evtx": 66, "C.evtx": 70, "E.evt": 89}
    for errors in (lq.failures_of(tagged), lq.read_errors(heads)):
        rows = errors.collect()
        assert sorted(short(r.path) for r in rows) == ["A.evtx", "B.evtx", "D.evt"]
        assert {r.stage for r in rows} == {"read"} and all("became shorter" in r.message for r in rows)


def test_one_pass_feeds_records_and_errors(spark, store, tmp_path_factory, monkeypatch):
    root, cut = shortened(store)
    store({"/junk.evtx": b"junk"})
    heads_of = ingest.heads_of_listing

    def then_cut(listing, bytes_per_task):
        heads, tasks = heads_of(listing, bytes_per_task)
        heads.count()
        cut()
        return heads, tasks

    monkeypatch.setattr(ingest, "heads_of_listing", then_cut)
    records, errors = lq.ingest_logs(spark, root, str(tmp_path_factory.mktemp("lake")) + "/t")
    assert records.count() == 66 + 70 + 89 and "read_error" not in records.columns
    assert sorted((short(r.path), r.stage) for r in errors.collect()) == [
        ("A.evtx", "read"), ("B.evtx", "read"), ("D.evt", "read"), ("junk.evtx", "header"),
    ]


def test_a_log_that_vanishes_is_an_error_of_its_own(spark, store):
    root = store({"/a.evtx": log_of(event("A")), "/b.evt": evt_file([record(1)]), "/c.evtx": log_of(event("C"))})
    heads = lq.read_heads(lq.list_logs(spark, root)).persist()
    heads.count()
    for name in ("a.evtx", "b.evt"):
        os.rename(f"{root}/{name}", f"{root}/{name}.moved")
    assert [r.channel for r in lq.read_stored_records(heads).collect()] == ["C"]
    assert sorted((short(r.path), r.stage) for r in lq.read_errors(heads).collect()) == [("a.evtx", "read"), ("b.evt", "read")]


# -- filters and columns in the decoder ---------------------------------------------------------------------


def instance(channel, code, level="4", extra=None):
    """A record by the template of the generated logs."""

    def write(writer: ChunkWriter):
        writer.buf += b"\x0f\x01\x01\x00"
        values = [text("P"), code, Value(0x04, bytes([int(level)])), channel, text("HOST"), Value(0x13, sid_bytes("S-1-5-19"))]
        writer.instance("one", TEMPLATE, [*values, extra or El("EventData", El("Data", text("1"), Name=text("a"))), text("k")])
        writer.buf.append(0)

    return write


def number(n):
    return Value(0x06, struct.pack("<H", n))


ODD = [
    instance(text("Security"), number(4625)),
    instance(text("Security"), number(4624)),
    instance(text("System"), number(4625)),
    instance(text("Security"), text(" 4625 ")),
    instance(text("Security"), text("4625x")),
    instance(Value(0x00), number(4625)),  # no channel
    instance(text(""), number(0)),
    instance(El("Inner", text("x")), number(4625)),  # elements where the channel stands
    instance(text("Security"), number(4625), extra=Value(0x21, b"\x0f\x01\x01\x00\x04\x00")),  # undecodable behind
    instance(text("Security"), Value(0x12, b"\xff" * 16)),  # a date that is none
    event("Security", code="4625"),
    event("Security", El("EventData", El("Data", text("x"))), code="4624"),
    UNDECODABLE,
    raw(b"\x0f\x01\x01\x00\x0c"),
]
FILTERS = [
    {"channels": ["Security"], "event_ids": [4625]}, {"channels": ["Security"]}, {"event_ids": [4625, 4624]}, {"channels": [""]},
    {"event_ids": [0]}, {"channels": ["", "System"], "event_ids": [0, 4625]}, {"channels": [], "event_ids": [1]}, {},
]


def test_filters_in_the_decoder_change_nothing(spark, store):
    root = store({
        "/a.evtx": evtx_file([chunk_of(*ODD), chunk_of(*ODD[::-1], first_id=40)]),
        "/SecEvent.evt": evt_file([record(n, 4624 + n % 2) for n in range(9)]),
        "/AppEvent.evt": evt_file([record(n, 4625) for n in range(4)]),
    })
    everything, _ = lq.scan_logs(spark, root)
    for wanted in FILTERS:
        full = lq.query(everything, wanted.get("channels"), wanted.get("event_ids")).collect()
        for columns in (None, everything.columns, ["event_id", "channel", "decode_error"], ["provider", "strings", "level"], ["record_id"]):
            found, _ = lq.scan_logs(spark, root, columns=columns, **wanted)
            want = full if columns is None else [r.asDict() for r in full]
            got = found.collect()
            if columns is None:
                assert sorted(got, key=repr) == sorted(want, key=repr)
            else:
                names = found.columns
                assert set(columns) | {"path", "format", "chunk_index", "record_index"} == set(names)
                assert sorted((repr(tuple(r)) for r in got)) == sorted(repr(tuple(r[n] for n in names)) for r in want)


def test_single_fields_are_those_of_a_full_decode():
    wanted = ("Channel", "EventID", ("Provider", "Name"), ("Security", "UserID"), "Level", "None")
    chunk, seen = chunk_of(*ODD), 0
    decoder = ChunkDecoder(chunk, [])
    for (_, _, start, end), (_, error, nodes) in zip(frame_records(chunk), decode(chunk)):
        texts = decoder.system_texts(start, end, wanted)
        if texts is not None and error is None:
            by_path = {n[0]: n for n in nodes}
            for field, found in zip(wanted, texts):
                node = by_path.get(f"Event[0]/System[0]/{field if isinstance(field, str) else field[0]}[0]")
                assert found == (None if node is None else node[3] if isinstance(field, str) else dict(node[2]).get(field[1]))
            seen += 1
    assert seen >= 6


@pytest.mark.parametrize(
    "body",
    [
        El("Event", Slot(0), El("System", El("Channel", Slot(1)))),  # a slot that may hold another System
        El("Event", El("System", Slot(0), El("Channel", Slot(1)))),
        El("Event", El("System", El("Channel", El("x"), Slot(1)))),
        El("Other", El("System", El("Channel", Slot(1)))),
        El("Event", El("Before"), El("System", El("Channel", Slot(1)))),
    ],
)
def test_templates_that_only_a_full_decode_understands(body):
    def write(writer: ChunkWriter):
        writer.buf += b"\x0f\x01\x01\x00"
        writer.instance("odd", body, [text("x"), text("C")])
        writer.buf.append(0)

    chunk = chunk_of(write)
    ((_, _, start, end),) = frame_records(chunk)
    assert ChunkDecoder(chunk, []).system_texts(start, end, ("Channel",)) is None


def test_the_first_of_repeated_fields_counts():
    body = El("Event", El("System", El("Channel", Slot(1)), El("Channel", Slot(0)), El("System", El("Channel", text("no")))), El("System", El("Level", text("9"))))

    def write(writer: ChunkWriter):
        writer.buf += b"\x0f\x01\x01\x00"
        writer.instance("odd", body, [text("x"), text("C")])
        writer.buf.append(0)

    chunk = chunk_of(write)
    ((_, _, start, end),) = frame_records(chunk)
    found = ChunkDecoder(chunk, []).system_texts(start, end, ("Channel", "Level"))
    assert found in (["C", None], None)


# -- large legacy logs ----------------------------------------------------------------------------------------


def reading(log):
    return Window(len(log), lambda pos, size: log[pos : pos + size])


def legacy_logs():
    rng = random.Random(11)

    def some(count, **options):
        return [record(n, strings=["s" * rng.randrange(40)], data=rng.randbytes(rng.randrange(0, 60)), **options) for n in range(count)]

    inside = record(7, data=record(1) + record(2))  # whole records in the data of another
    broken = bytearray(record(9))
    broken[-1] ^= 1
    whole = evt_file(some(200))
    return {
        "/plain.evt": whole,
        "/inside.evt": evt_file([*some(30), inside, *some(30), inside, inside, *some(9)]),
        "/bad.evt": evt_file([*some(120), bytes(broken), *some(50)]),
        "/signature.evt": evt_file([*some(60), record(1, signature=0), *some(60)]),
        "/cut.evt": whole[: len(whole) - 777],
        "/late.evt": evt_file(some(90)),
        "/large.evt": evt_file([*some(20), record(1, data=b"x" * 9000), *some(20), record(2, strings=["y" * 3000]), *some(5)]),
        "/junk.evt": evt_file([*some(10)]) + os.urandom(3000),
        "/one.evt": evt_file([record(1)]),
        "/none.evt": evt_file([]),
        "/wrapped.evt": evt_file(some(60), flags=2, start=4096, end=48),
    }


def test_a_window_reads_what_the_whole_log_gives():
    for log in legacy_logs().values():
        window, bounds = reading(log), log_bounds(reading(log))
        want = [r for r, _ in evt_records(log)]
        got = [r for _, r, _ in walk(window, *bounds)] if bounds else []
        assert got == want


def test_runs_lead_from_range_to_range():
    for log in legacy_logs().values():
        bounds = log_bounds(reading(log))
        if bounds is None:
            continue
        places, pos = [], bounds[0]
        for after, _, _ in walk(reading(log), *bounds):
            places.append(pos)
            pos = after
        for size in (500, 4096):
            pos, count = bounds[0], 0
            for start in range(0, bounds[1], size):
                stop = min(start + size, bounds[1])
                runs = {first: (n, leads) for first, n, leads in chains(reading(log), start, stop, bounds[1])}
                if start <= pos < stop and pos in runs:
                    inside = sum(start <= p < stop and p >= pos for p in places)
                    assert runs[pos][0] == inside
                    pos, count = runs[pos][1] if runs[pos][1] >= 0 else 1 << 62, count + inside


@pytest.mark.parametrize("size", [600, 5000])
def test_large_legacy_logs_are_read_in_pieces(spark, store, size):
    logs = legacy_logs()
    root = store(logs)
    heads = lq.read_heads(lq.list_logs(spark, root))
    whole = lq.read_stored_records(heads).orderBy("path", "record_index").collect()
    assert len(whole) == sum(len(list(evt_records(log))) for log in logs.values())
    pieces = lq.log_ranges(lq.examine(heads).where("problem is null").drop("problem"), evt_range=size)
    if size == 600:
        assert pieces.where("path like '%plain.evt'").count() > 20
    assert lq.read_stored_records(heads, evt_range=size).orderBy("path", "record_index").collect() == whole


# -- audit ----------------------------------------------------------------------------------------------------


def test_stored_audit_counts_as_the_audit_in_memory(spark, store):
    logs = {
        "/a.evtx": evtx_file([chunk_of(*ODD), bytes(65536), chunk_of(event("A"), first_id=9)], flags=1) + b"tail",
        "/b.evtx": evtx_file([]),
        "/c.evtx": b"junk",
    }
    root = store(logs)
    stored = lq.audit_stored(lq.read_heads(lq.list_logs(spark, root)), 2).drop("read_error")
    assert sorted(stored.collect()) == sorted(lq.log_audit(lq.read_logs(spark, root)).select(stored.columns).collect())
    assert stored.where("path like '%a.evtx'").first().decode_errors >= 3


# -- listing --------------------------------------------------------------------------------------------------


def test_links_to_folders_are_errors_at_every_level(spark, store):
    root = store({"/x/a.evtx": log_of(event("A")), "/x/y/z/b.evtx": log_of(event("B")), "/target/c.evtx": log_of(event("C"))})
    os.symlink(f"{root}/target", f"{root}/top")
    os.symlink(f"{root}/target", f"{root}/x/y/z/low")
    os.symlink(f"{root}/target/c.evtx", f"{root}/x/file.evtx")
    records, errors = lq.scan_logs(spark, root)
    assert sorted(r.channel for r in records.collect()) == ["A", "B", "C", "C"]
    assert sorted((short(r.path), r.stage) for r in errors.collect()) == [("low", "locate"), ("top", "locate")]
    _, errors = lq.list_roots(spark, [root])
    assert errors.count() == 2


def test_wide_and_deep_folders_are_listed_by_tasks(spark, store):
    names = [f"/w/{i}/{i % 3}/f{i}.evt" for i in range(90)] + [f"/flat/{i}.evt" for i in range(400)] + ["/a/b/c/d/e/f/g.evt"]
    root = store({name: b"" for name in names})
    listing = lq.list_logs(spark, root)
    assert listing.count() == len(names) and listing.select("path").distinct().count() == len(names)
    store({"/later.evt": b""})
    assert lq.list_logs(spark, root).count() == len(names) + 1  # nothing of an earlier listing is kept


# -- typed values ---------------------------------------------------------------------------------------------


def test_values_keep_their_types(spark, store):
    kinds = {
        "i": Value(0x07, struct.pack("<i", -5)), "u": Value(0x0A, struct.pack("<Q", 2**64 - 1)), "f": Value(0x0C, struct.pack("<d", 1e300)),
        "nan": Value(0x0C, struct.pack("<d", float("nan"))), "t": Value(0x0D, struct.pack("<I", 1)), "n": Value(0x00), "s": text('a,"b\\'),
        "h": Value(0x14, struct.pack("<I", 255)), "g": Value(0x0F, bytes(16)), "a": Value(0x81, "x,y\0\0z\0".encode("utf-16-le")), "e": Value(0x87, b""),
        "r": Value(0x8B, struct.pack("<2f", 0.5, float("inf"))), "b": Value(0x8D, struct.pack("<2I", 0, 1)), "m": Value(0x8F, bytes(32)),
    }
    slots = [El("Data", Slot(8 + i, kind=v.kind), Name=text(k)) for i, (k, v) in enumerate(kinds.items())]
    data = El("EventData", *slots, El("Data", Name=text("none")))
    inline = {k: v for k, v in kinds.items() if not v.kind & 0x80}
    mixed = El("Event", El("System", El("Channel", text("C"))), El("UserData", El("X", text("1"), El("Y", text("2")))))

    def write(writer: ChunkWriter):
        writer.buf += b"\x0f\x01\x01\x00"
        values = [text("P"), number(1), Value(0x04, b"\4"), text("C"), text("H"), Value(0x00), data, Value(0x08, struct.pack("<I", 7))]
        writer.instance("one", TEMPLATE, [*values, *kinds.values()])
        writer.buf.append(0)

    files = spark.createDataFrame([("/a", bytearray(log_of(write, event("A", El("EventData", *[El("Data", v, Name=text(k)) for k, v in inline.items()])), mixed, UNDECODABLE)))], "path string, content binary")
    typed = lq.read_evtx(files, typed=True)
    plain = lq.read_evtx(files)
    assert typed.drop("typed_data").collect() == plain.collect()
    rows = typed.orderBy("record_index").collect()
    for row in rows[:2]:
        found = {k.rpartition(".")[2]: v.toPython() for k, v in row.typed_data.items()}
        assert found.pop("K", 7) == 7
        assert float(found.pop("f")) == 1e300 and int(found.pop("u")) == 2**64 - 1
        zero = "{00000000-0000-0000-0000-000000000000}"
        want = {
            "i": -5, "nan": "NaN", "t": True, "n": None, "s": 'a,"b\\', "h": 255, "g": zero, "a": ["x,y", "", "z"], "e": [],
            "r": [0.5, "inf"], "b": [False, True], "m": [zero, zero], "none": "",
        }
        assert found == (want if row is rows[0] else {k: v for k, v in want.items() if k in inline})
    assert {k: v.toPython() for k, v in rows[2].typed_data.items()} == {"winlog.user_data.X.Y": "2"}
    assert rows[3].typed_data == {}


# -- bodies of evidence -----------------------------------------------------------------------------------------


def test_each_body_has_its_own_system_root(spark, store):
    log = log_of(event("System"))
    root = store({
        "/a/WINNT/System32/winevt/Logs/System.evtx": log, "/a/Windows/System32/winevt/Logs/System.evtx": log,
        "/a/inner/Windows/System32/winevt/Logs/System.evtx": log, "/ab/copied/System.evtx": log, "/c/X/System32/winevt/Logs/System.evtx": log,
        "/a/inner/deep/OS/System32/winevt/Logs/System.evtx": log,
    })
    bodies = [(f"{root}/a", "A", r"C:\WINNT"), (f"{root}/a/inner", "I", "D:/Windows"), (f"{root}/ab", "B", None), (f"{root}/c/", "C", r"C:\X"), (f"{root}/none", "N", None), (f"{root}/a/inner/deep", "D", r"\OS")]
    records, errors = lq.collect_evidence(spark, bodies, lq.default_catalog(spark))
    found = sorted((r["artifact.host"], r["artifact.path"].removeprefix(f"file:{root}"), r["artifact.located_by"]) for r in records.collect())
    assert found == [
        ("A", "/a/WINNT/System32/winevt/Logs/System.evtx", "location"),
        ("B", "/ab/copied/System.evtx", "file_name"),
        ("C", "/c/X/System32/winevt/Logs/System.evtx", "location"),
        ("D", "/a/inner/deep/OS/System32/winevt/Logs/System.evtx", "location"),
        ("I", "/a/inner/Windows/System32/winevt/Logs/System.evtx", "location"),
    ]
    assert [(e.stage, "none" in e.message) for e in errors.collect()] == [("locate", True)]


# -- the index of chunks ----------------------------------------------------------------------------------------


def test_an_index_leaves_out_chunks(spark, store, tmp_path_factory):
    def chunk(channel, code, first):
        return chunk_of(*[event(channel, code=code) for _ in range(3)], first_id=first)

    many = [chunk("Security" if i in (3, 4, 9) else "System", "4625" if i in (4, 7) else "1", 10 * i) for i in range(12)]
    root = store({"/a.evtx": evtx_file(many), "/b.evtx": evtx_file(many[:2]), "/e.evtx": evtx_file([]), "/u.evtx": log_of(UNDECODABLE), "/junk": b"x"})
    target = str(tmp_path_factory.mktemp("index")) + "/i"
    lq.index_logs(spark, root).write.parquet(target)
    index = spark.read.parquet(target)
    assert index.count() == 16 and index.where("path like '%a.evtx' and chunk_index = 4").first().event_ids == [4625]

    def found(**wanted):
        return sorted(tuple(r) for r in lq.scan_indexed(spark, root, index, columns=["record_id", "channel", "event_id"], **wanted).collect())

    def plain(**wanted):
        return sorted(tuple(r) for r in lq.scan_logs(spark, root, "*.evtx", columns=["record_id", "channel", "event_id"], **wanted)[0].collect())

    for wanted in ({"channels": ["Security"]}, {"event_ids": [4625]}, {"channels": ["Security"], "event_ids": [4625]}, {"event_ids": [0]}, {"channels": [""]}, {"channels": []}, {}):
        assert found(**wanted) == plain(**wanted)
    heads = lq.read_heads(lq.list_logs(spark, root))
    logs = lq.examine(heads.withColumn("t", heads["modificationTime"])).where("problem is null").withColumnRenamed("t", "modificationTime")
    units = lq.indexed_ranges(logs, index, channels=["Security"])
    assert sorted((r._first, r._stop) for r in units.collect()) == [(3, 5), (9, 10)]
    assert lq.bytes_of(units).first().bytes == 3 * 65536
    # A log that has changed, and a new one, are read whole.
    store({"/b.evtx": evtx_file([chunk("Security", "4625", 1)]), "/n.evtx": evtx_file([chunk("Security", "4625", 7)])})
    assert found(channels=["Security"]) == plain(channels=["Security"])
    assert len(found(channels=["Security"])) == 15
    whole = lq.scan_indexed(spark, root, index, event_ids=[4625])
    assert whole.columns == lq.scan_logs(spark, root)[0].columns and whole.count() == 12
    from builders import FILETIME

    assert lq.scan_indexed(spark, root, index, times=(FILETIME, FILETIME), columns=["record_id"]).count() == len(plain())
    assert lq.scan_indexed(spark, root, index, times=(FILETIME + 1, FILETIME + 9)).count() == 0
