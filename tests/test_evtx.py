"""Modern logs from bytes to records."""

import pytest
from builders import FILETIME, LOGS, UNDECODABLE, chunk_of, event, files, log_of
from pyspark.sql import functions as F

import logquarry as lq
from logquarry.testing.writer import ChunkWriter, El, Slot, Value, evtx_file, text


def rows(frame):
    return lq.canonical_order(frame).collect()


def test_one_record(spark):
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("Security"))})))
    assert (row.record_id, row.event_id, row.provider, row.channel, row.computer) == (1, 7, "P", "Security", "HOST")
    assert (row.level, row.user_sid, row.decode_error, row.data) == ("Information", None, None, {})
    assert str(row.timestamp) == "2024-02-03 14:10:23.595970"
    assert row.filetime == FILETIME
    assert row.file_checksum_valid and row.chunk_checksum_valid


@pytest.mark.parametrize(
    "code, expected",
    [(" 4625 ", 4625), ("+7", 7), ("-7", 0), ("7.5", 0), ("", 0), ("x", 0), ("4294967295", 4294967295),
     ("4294967296", 0), ("99999999999999999999999", 0), ("\u2003 8\u2003", 8), ("1 2", 0)],
)
def test_event_id_text(spark, code, expected):
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A", code=code))})))
    assert row.event_id == expected


@pytest.mark.parametrize(
    "level, expected",
    [("1", "Critical"), (" 2 ", "Error"), ("3", "Warning"), ("5", "Verbose"), ("0", "Information"),
     ("6", "Information"), ("256", "Information"), ("", "Information")],
)
def test_level_text(spark, level, expected):
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A", level=level))})))
    assert row.level == expected


def test_event_data_keys(spark):
    data = El(
        "EventData",
        El("Data", text("1"), Name=text("A")),
        El("Data", text("unnamed")),
        El("Data", text("2"), Name=text("A")),
        El("Data", Name=text("empty")),
        El("Other", text("ignored")),
        El("Data", El("Inner", text("ignored")), text("kept"), Name=text("mixed")),
        El("Binary", Value(0x0E, b"\xab\x01")),
        El("Binary", text("second")),
    )
    second = El("EventData", El("Data", text("no"), Name=text("B")))
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A", data, second))})))
    prefix = "winlog.event_data."
    assert row.data == {
        prefix + "A": "2", prefix + "1": "unnamed", prefix + "empty": "", prefix + "mixed": "kept",
        prefix + "binary": "0xab01",
    }


def test_binary_element_beats_data_of_that_name(spark):
    data = El("EventData", El("Binary", text("element")), El("Data", text("data"), Name=text("binary")))
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A", data))})))
    assert row.data == {"winlog.event_data.binary": "element"}


def test_user_data_flattens_leaves(spark):
    user = El(
        "UserData",
        El("EventXML", El("ProcessId", text(" 4 ")), El("Blank", text(" \u2003")), El("B", El("C", text("x"))), text("dropped")),
        El("EventXML", El("ProcessId", text("last"))),
        El("Odd/Name%5B", text("y")),
        El("Leaf", text("z"), a=text("dropped")),
    )
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A", user))})))
    prefix = "winlog.user_data."
    assert row.data == {
        prefix + "EventXML.ProcessId": "last", prefix + "EventXML.B.C": "x", prefix + "Odd/Name%5B": "y",
        prefix + "Leaf": "z",
    }


def test_security_user(spark):
    root = El("Event", El("System", El("Security", UserID=text("S-1-5-19"))))
    (row,) = rows(lq.read_evtx(files(spark, {"/a": log_of(root)})))
    assert (row.user_sid, row.channel, row.provider, row.computer) == ("S-1-5-19", "", "", "")


def test_undecodable_record_keeps_its_row(spark):
    first, bad = rows(lq.read_evtx(files(spark, {"/a": log_of(event("A"), UNDECODABLE)})))
    assert first.decode_error is None
    assert (bad.record_id, bad.event_id, bad.channel, bad.level, bad.user_sid) == (2, 0, "", "Information", None)
    assert bad.decode_error and str(bad.timestamp) == "2024-02-03 14:10:23.595970"


def test_header_values_beyond_signed_range_are_errors_of_their_record(spark):
    writer = ChunkWriter()
    writer.record(1 << 63, FILETIME, lambda w: w.fragment(event("A")))
    writer.record(5, (1 << 64) - 1, lambda w: w.fragment(event("A")))
    first, second = rows(lq.read_evtx(files(spark, {"/a": evtx_file([writer.finish()])})))
    assert (first.record_id, second.timestamp) == (None, None)
    assert "out of range" in first.decode_error and "out of range" in second.decode_error


def test_a_wrong_checksum_flags_and_keeps(spark):
    log = bytearray(log_of(event("A")))
    log[4096 + 512 + 40] ^= 0xFF
    header = bytearray(log_of(event("A")))
    header[30] ^= 0xFF
    found = {r.path: r for r in rows(lq.read_evtx(files(spark, {"/chunk": bytes(log), "/file": bytes(header)})))}
    assert (found["/chunk"].chunk_checksum_valid, found["/chunk"].file_checksum_valid) == (False, True)
    assert (found["/file"].chunk_checksum_valid, found["/file"].file_checksum_valid) == (True, False)


def test_the_two_chunk_checksums_are_independent(spark):
    events_bad = bytearray(log_of(event("A")))
    events_bad[4096 + 600] ^= 1
    header_bad = bytearray(log_of(event("A")))
    header_bad[4096 + 200] ^= 1
    short = bytearray(log_of(event("A")))
    short[4096 + 48 : 4096 + 52] = (100).to_bytes(4, "little")
    logs = files(spark, {"/e": bytes(events_bad), "/h": bytes(header_bad), "/s": bytes(short)})
    found = {r.path: (r.events_checksum_valid, r.header_checksum_valid) for r in lq.chunk_headers(lq.split_chunks(logs)).collect()}
    assert found == {"/e": (False, True), "/h": (True, False), "/s": (False, False)}


def test_chunk_header_fields(spark):
    (row,) = lq.chunk_headers(lq.split_chunks(files(spark, {"/a": log_of(event("A"), event("B"), first_id=9)}))).collect()
    assert (row.first_record_id, row.last_record_id, row.first_record_number, row.last_record_number) == (9, 10, 1, 2)
    assert len(row.name_buckets) == 64 and len(row.template_buckets) == 32
    assert row.last_record_offset > 512 and row.free_space_offset > row.last_record_offset


def test_unsigned_64_bit_header_fields(spark):
    log = bytearray(log_of(event("A")))
    log[24:32] = b"\xff" * 8
    (row,) = lq.evtx_log_headers(files(spark, {"/a": bytes(log)})).collect()
    assert row.next_record_id == 2**64 - 1
    assert row.checksum_valid is False


def test_slots_follow_the_length_and_broken_ones_stop_alone(spark):
    first, third = chunk_of(event("A"), event("A")), chunk_of(event("C"), first_id=7)
    log = evtx_file([first, bytes(65536), third]) + bytes(1000)
    logs = files(spark, {"/a": log})
    assert lq.split_chunks(logs).count() == 3
    assert [(r.chunk_index, r.record_index, r.record_id) for r in rows(lq.read_evtx(logs))] == [(0, 0, 1), (0, 1, 2), (2, 0, 7)]
    (audit,) = lq.log_audit(logs).collect()
    assert (audit.chunk_count_declared, audit.slots_by_length, audit.slots_parsed, audit.slots_skipped) == (3, 3, 2, 1)
    assert (audit.truncated_bytes, audit.records, audit.decode_errors, audit.is_incomplete) == (1000, 3, 0, True)


@pytest.mark.parametrize("cut", [lambda log: log[:40_000], lambda log: log[:4096] + bytes(65536), lambda log: log[:4096]])
def test_logs_without_readable_chunks_are_empty_and_audited(spark, cut):
    logs = files(spark, {"/a": cut(log_of(event("System")))})
    assert lq.read_evtx(logs).count() == 0
    assert lq.header_errors(logs).count() == 0
    (audit,) = lq.log_audit(logs).collect()
    assert audit.is_incomplete and audit.records == 0


def test_one_bad_file_is_one_error_and_the_others_are_read(spark):
    logs = files(spark, {
        f"{LOGS}/System.evtx": log_of(event("System"))[:16],
        f"{LOGS}/Application.evtx": b"\xaa" * 4096,
        f"{LOGS}/Security.evtx": log_of(event("Security")),
        f"{LOGS}/Empty.evtx": b"",
    })
    errors = {r.path.rpartition("/")[2]: r.message for r in lq.header_errors(logs).collect()}
    assert set(errors) == {"System.evtx", "Application.evtx", "Empty.evtx"}
    assert all(name in message for name, message in errors.items())
    assert [r.channel for r in rows(lq.read_records(logs))] == ["Security"]


def test_record_order_is_physical(spark):
    log = evtx_file([chunk_of(event("B"), first_id=50), chunk_of(event("A"), event("B"), first_id=3)])
    records = lq.read_evtx(files(spark, {"/b": log, "/a": log_of(event("C"))}))
    assert [(r.path, r.record_id) for r in rows(records)] == [("/a", 1), ("/b", 50), ("/b", 3), ("/b", 4)]
    assert [r.channel for r in lq.channels(records).collect()] == ["C", "B", "A"]


def test_channels_of_an_empty_log(spark):
    assert lq.channels(lq.read_evtx(files(spark, {"/a": evtx_file([chunk_of()])}))).collect() == []


def test_counts(spark):
    records = lq.read_evtx(files(spark, {"/a": log_of(event("Security", code="4625"), event("Security"), event("System", code="4625"))}))
    assert lq.event_count(records, "Security").first().event_count == 2
    assert lq.event_count(records, "security").first().event_count == 0
    assert lq.failed_logons(records).first().event_count == 1
    assert lq.query(records, event_ids=[4625]).count() == 2
    assert lq.query(records, channels=[]).count() == 0
    assert lq.query_all(records).count() == 3


def test_other_columns_follow_the_records(spark):
    logs = files(spark, {"/a": log_of(event("A"))}).withColumn("case_id", F.lit(42))
    assert rows(lq.read_evtx(logs))[0].case_id == 42


def test_a_templated_log_reads_like_a_plain_one(spark):
    template = El("Event", El("System", El("EventID", Slot(0)), El("Channel", Slot(1))), Slot(2))

    def record(w, code=1):
        w.buf += b"\x0f\x01\x01\x00"
        w.instance("t", template, [text(str(code)), text("Ch"), El("EventData", El("Data", text("v"), Name=text("n")))])
        w.buf.append(0)

    records = rows(lq.read_evtx(files(spark, {"/a": log_of(record, record)})))
    assert [(r.event_id, r.channel, r.data) for r in records] == [(1, "Ch", {"winlog.event_data.n": "v"})] * 2


def test_typed_values(spark):
    shown = {"i": "-5", "u": str(2**64 - 1), "f": "2.5", "b": "true", "x": "0x00ab", "d": "2024-02-03T14:10:23.5959706Z",
             "a": "1,2", "e": "", "t": "it's"}
    records = spark.createDataFrame([(shown,)], "data map<string,string>")
    kinds = {"i": "signed", "u": "unsigned", "f": "float", "b": "bool", "x": "binary", "d": "date", "a": "array", "e": "array", "t": "text"}
    row = records.select(*[lq.typed_value(k, kind).alias(k) for k, kind in kinds.items()]).first()
    assert (row.i, int(row.u), row.f, row.b, bytes(row.x), row.a, row.e, row.t) == (
        -5, 2**64 - 1, 2.5, True, b"\x00\xab", ["1", "2"], [], "it's")
    assert str(row.d) == "2024-02-03 14:10:23.595970"
    wrong = records.select(*[lq.typed_value("t", k).alias(k) for k in ("signed", "unsigned", "float", "bool", "binary", "date")])
    assert set(wrong.first()) == {None}
    assert records.select(lq.typed_value("it's", "text").alias("v")).first().v is None


def test_plain_logs_are_written_from_the_bytes_between_their_values(monkeypatch):
    from collections import namedtuple

    from logquarry.testing import logs

    names = "record_id filetime code channel provider level_text computer user_sid cents props k"
    row, calls, element = namedtuple("Row", names), [], ChunkWriter.element
    rows = [
        row(n, 10**17 + n, 4624, "System", f"provider-{'x' * (n % 3)}", "4", f"HOST{n}", f"S-1-5-21-{n}" if n % 11 else None, str(7**(n % 9)), "{}", "1")
        for n in range(1, 61)
    ]
    monkeypatch.setattr(ChunkWriter, "element", lambda *given, **named: (calls.append(1), element(*given, **named)))
    for variant in ((), ("odd_data",), ("templated",)):
        calls.clear()
        log = logs._write_log(rows, frozenset(variant))
        assert len(calls) < 100

        def whole(self, part):
            self.values, self.cuts = part.values, []
            self.element(part.document)

        with monkeypatch.context() as patch:
            patch.setattr(ChunkWriter, "filled", whole)
            assert logs._write_log(rows, frozenset(variant)) == log
