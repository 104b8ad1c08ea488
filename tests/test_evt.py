"""Legacy logs from bytes to records."""

import struct

from builders import event, files, log_of

import logquarry as lq
from logquarry.testing.writer import evt_file, evt_record, sid_bytes


def record(number, event_id=100, **options):
    return evt_record(number, 1_700_000_000 + number, 1_700_000_001 + number, event_id, options.pop("kind", 1), 3, "App", "HOST", **options)


def rows(frame):
    return lq.canonical_order(frame).collect()


def test_records_of_a_log(spark):
    log = evt_file([
        record(1, 0x40001000, strings=["a", ""], data=b"\x00\xff", sid=sid_bytes("S-1-5-19")),
        record(2, 200, kind=16, sid=b"\x01\x09"),
    ])
    first, second = rows(lq.read_evt(files(spark, {"/x/APPEVENT.EVT": log})))
    assert (first.record_id, first.event_id, first.channel, first.level) == (1, 0x1000, "Application", "Error")
    assert (first.provider, first.computer, first.user_sid) == ("App", "HOST", "S-1-5-19")
    assert (first.strings, first.raw_data, first.category, first.format) == (["a", ""], "00ff", 3, "evt")
    assert str(first.timestamp) == "2023-11-14 22:13:21" and str(first.time_written) == "2023-11-14 22:13:22"
    assert (second.strings, second.raw_data, second.user_sid, second.level) == (None, None, None, "Information")
    assert (second.chunk_index, second.record_index, second.data) == (0, 1, {})


def test_a_given_channel_wins_over_the_file_name(spark):
    logs = files(spark, {"/x/SecEvent.Evt": evt_file([record(1)])})
    assert rows(lq.read_evt(logs))[0].channel == "Security"
    assert rows(lq.read_evt(logs, "Custom"))[0].channel == "Custom"


def test_reading_ends_at_the_first_bad_record(spark):
    beyond = bytearray(record(2, sid=sid_bytes("S-1-5-19")))
    struct.pack_into("<I", beyond, 44, 1 << 20)
    trailer = bytearray(record(2))
    trailer[-1] ^= 1
    logs = {
        "/signature": evt_file([record(1), record(2, signature=0), record(3)]),
        "/sid": evt_file([record(1), bytes(beyond), record(3)]),
        "/trailer": evt_file([record(1), bytes(trailer), record(3)]),
        "/cut": evt_file([record(1), record(2)])[:-10],
    }
    found = rows(lq.read_evt(files(spark, logs)))
    assert [(r.path, r.record_id) for r in found] == [(p, 1) for p in sorted(logs)]


def test_header_decides_what_is_read(spark):
    two = [record(1), record(2)]
    bad_trailer = bytearray(evt_file(two))
    bad_trailer[44] = 0
    logs = files(spark, {
        "/wrapped": evt_file(two, flags=2, start=4096, end=48),
        "/late": evt_file(two, start=48 + len(two[0])),
        "/bad": bytes(bad_trailer),
        "/archived": evt_file(two, flags=9),
    })
    assert [(r.path, r.record_id) for r in rows(lq.read_evt(logs))] == [("/archived", 1), ("/archived", 2), ("/late", 2)]
    headers = {r.path: r for r in lq.evt_log_headers(logs).collect()}
    assert set(headers) == {"/wrapped", "/late", "/archived"}
    assert headers["/wrapped"].is_wrapped and not headers["/wrapped"].is_dirty
    assert headers["/archived"].is_archived and headers["/archived"].is_dirty
    assert [(r.path, r.stage) for r in lq.header_errors(logs).collect()] == [("/bad", "header")]
    audit = {r.path: r for r in lq.evt_audit(logs).collect()}
    assert audit["/wrapped"].end_before_start and audit["/wrapped"].records == 0
    assert audit["/archived"].records == audit["/archived"].records_declared == 2


def test_channel_exists_without_records(spark):
    logs = files(spark, {"/SysEvent.evt": evt_file([])})
    found = lq.channels(lq.read_evt(logs), lq.with_channel(logs).select("path", "channel"))
    assert [r.channel for r in found.collect()] == ["System"]


def test_both_formats_in_one_frame(spark):
    logs = files(spark, {"/a.evtx": log_of(event("Security")), "/SysEvent.evt": evt_file([record(5)]), "/c": b"none"})
    assert {(r.format, r.channel, r.record_id) for r in lq.read_records(logs).collect()} == {
        ("evtx", "Security", 1), ("evt", "System", 5),
    }
