"""Stored evidence: listing, locating, range reads, enrichment, streaming."""

import os

import pytest
from builders import LOGS, UNDECODABLE, chunk_of, event, log_of
from pyspark.sql import functions as F

import logquarry as lq
from logquarry.testing.writer import evt_file, evt_record, evtx_file

SYSMON = "Microsoft-Windows-Sysmon/Operational"


@pytest.fixture
def store(tmp_path):
    def write(contents):
        for path, data in contents.items():
            target = tmp_path / path.lstrip("/")
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(data)
        return str(tmp_path)

    return write


def collect(spark, *roots, system_root=r"C:\Windows"):
    enriched, errors = lq.collect_logs(spark, list(roots), lq.default_catalog(spark), "TEST-HOST", system_root)
    return enriched.orderBy("`artifact.path`", "chunk_index", "record_index").collect(), errors.collect()


def test_logs_at_their_locations(spark, store):
    root = store({
        f"{LOGS}/Security.evtx": log_of(event("Security")),
        f"{LOGS}/Microsoft-Windows-Sysmon%4Operational.evtx": log_of(event(SYSMON)),
        f"{LOGS}/Windows PowerShell.evtx": log_of(event("Windows PowerShell")),
        f"{LOGS}/Unlisted.evtx": log_of(event("Unlisted")),
        "/copies/Security.evtx": log_of(event("Security")),
    })
    records, errors = collect(spark, root)
    assert errors == []
    assert [r["artifact.path"].rpartition("/")[2] for r in records] == [
        "Microsoft-Windows-Sysmon%4Operational.evtx", "Security.evtx", "Windows PowerShell.evtx",
    ]
    sysmon, security, _ = records
    assert (sysmon["event.channel"], sysmon["artifact.name"]) == (SYSMON, "Windows::WinEvt::Sysmon")
    assert (sysmon["artifact.definition"], sysmon["artifact.located_by"]) == ("WindowsXMLEventLogSysmon", "location")
    assert (sysmon["artifact.host"], sysmon["host.name"], sysmon["event.code"]) == ("TEST-HOST", "HOST", 7)
    assert sysmon["@timestamp"] is not None
    assert sysmon.source_id != security.source_id
    assert (security.acquisition, security.recovery) == ("ImageRead", "Allocated")


def test_a_flat_copy_is_found_by_file_name(spark, store):
    copied = "/LiveResponseData/CopiedFiles/eventlogs/Logs"
    root = store({
        f"{copied}/Security.evtx": log_of(event("Security")),
        f"{copied}/System.evtx": log_of(event("System")),
        f"{copied}/Microsoft-Windows-DhcpNap%4Admin.evtx": log_of(event("Dhcp")),
    })
    records, errors = collect(spark, root)
    assert errors == []
    assert [(r["artifact.definition"], r["artifact.located_by"]) for r in records] == [
        ("WindowsXMLEventLogSecurity", "file_name"), ("WindowsXMLEventLogSystem", "file_name"),
    ]


def test_errors_name_what_could_not_be_read(spark, store):
    root = store({
        f"{LOGS}/System.evtx": log_of(event("System"))[:16],
        f"{LOGS}/Application.evtx": b"\xaa" * 4096,
        f"{LOGS}/Security.evtx": log_of(event("Security"), UNDECODABLE),
    })
    records, errors = collect(spark, root, root + "/no such folder")
    assert sorted(e.stage for e in errors) == ["header", "header", "locate"]
    assert all(any(name in e.message for name in ("System.evtx", "Application.evtx", "no such folder")) for e in errors)
    assert [r["artifact.name"] for r in records] == ["Windows::WinEvt::Security", "Windows::WinEvt::Other()"]
    assert records[1]["evtx.record.decode_error"] and records[1]["@timestamp"] is not None


def test_a_file_that_cannot_be_opened_is_one_error(spark, store):
    root = store({"/a.evtx": log_of(event("A"))})
    gone = spark.createDataFrame([(root + "/gone.evtx", 69632)], "path string, length bigint")
    heads = lq.read_heads(lq.list_logs(spark, root).select("path", "length").union(gone))
    (error,) = lq.header_errors(heads).collect()
    assert error.stage == "read" and "gone.evtx" in error.message
    assert [r.channel for r in lq.read_stored_records(heads).collect()] == ["A"]


def test_nothing_there_is_no_error(spark, store):
    assert collect(spark, store({"/other/file.txt": b"x"})) == ([], [])


def test_unresolved_patterns_are_errors(spark):
    catalog = spark.createDataFrame(
        [("A", r"%%environ_systemroot%%\a.evtx"), ("B", r"%%users.homedir%%\b.evtx"), ("C", r"D:\x\c.evtx")],
        "definition string, pattern string",
    )
    patterns, errors = lq.expand_patterns(catalog, r"C:\WINNT")
    assert {r.definition: r.location for r in patterns.collect()} == {"A": "winnt/a.evtx", "C": "x/c.evtx"}
    assert [(r.stage, "homedir" in r.message) for r in errors.collect()] == [("locate", True)]
    unknown, _ = lq.expand_patterns(catalog)
    assert unknown.where("definition = 'A'").first().location == "a.evtx"


def test_a_large_catalog_is_not_broadcast(spark, monkeypatch):
    from logquarry.sources import catalog as module

    listing = spark.range(50).selectExpr("concat('/copies/', id, '/System', id % 7, '.evtx') as path", "id as length")
    patterns, _ = lq.expand_patterns(
        spark.createDataFrame([(f"D{i}", rf"\logs\System{i}.evtx") for i in range(5)], "definition string, pattern string")
    )
    small = lq.locate_logs(listing, patterns)
    monkeypatch.setattr(module, "_BROADCAST_PATTERNS", 3)
    large = lq.locate_logs(listing, patterns)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    monkeypatch.undo()
    monkeypatch.setattr(module, "_BROADCAST_BYTES", 30)
    wide = lq.locate_logs(listing, patterns)
    assert "ResolvedHint" not in wide._jdf.queryExecution().analyzed().toString()
    assert sorted(small.collect()) == sorted(large.collect()) == sorted(wide.collect())
    assert small.count() == 36


def test_a_path_is_taken_once_by_the_first_definition(spark):
    catalog = spark.createDataFrame(
        [("B", r"\logs\x.evtx"), ("A", r"\logs\x.evtx")], "definition string, pattern string"
    )
    listing = spark.createDataFrame([("/c/LOGS/X.evtx",), ("/c/LOGS/X.evtx",), ("/c/oldlogs/x.evtx",)], "path string")
    found = lq.locate_logs(listing, lq.expand_patterns(catalog)[0]).collect()
    assert [(r.path, r.definition, r.located_by) for r in found] == [("/c/LOGS/X.evtx", "A", "location")]


def test_range_reads_give_what_whole_files_give(spark, store):
    chunks = [chunk_of(event("A"), event("B"), first_id=10 * i) for i in range(7)]
    evt = evt_file([evt_record(1, 5, 6, 7, 1, 0, "S", "C", strings=["x"])])
    root = store({
        "/one %4 log.evtx": evtx_file(chunks) + b"tail", "/empty.evtx": evtx_file([]), "/SysEvent.evt": evt, "/junk": b"junk",
    })
    files = lq.read_logs(spark, root)
    whole = lq.read_records(files)
    apart = lq.log_files_union(lq.read_evtx(files), lq.read_evt(files))
    ranged, errors = lq.scan_logs(spark, root)
    key = ["path", "chunk_index", "record_index"]
    assert ranged.schema.simpleString() == whole.schema.simpleString() == apart.schema.simpleString()
    assert ranged.orderBy(key).collect() == whole.orderBy(key).collect() == apart.orderBy(key).collect()
    assert ranged.count() == 15
    assert [e.path.rpartition("/")[2] for e in errors.collect()] == ["junk"]
    heads = lq.read_heads(lq.list_logs(spark, root, "*.evtx"))
    split = lq.read_chunks(heads, partitions=3, range_chunks=2)
    assert split.rdd.getNumPartitions() == 3
    assert sorted(r.chunk_index for r in split.collect()) == list(range(7))
    assert [bytes(r.chunk) for r in split.orderBy("chunk_index").collect()] == chunks


def test_the_listing_reads_no_contents(spark, store):
    plan = lq.list_logs(spark, store({"/a.evtx": b"x"}))._jdf.queryExecution().toString()
    assert "content" not in plan.split("Physical Plan")[1]


def test_classification(spark):
    channels = ["Application", "Security", "System", "Setup", SYSMON, "Windows PowerShell", "PowerShellCore/Operational",
                "security", "", "Vendor/X", "Microsoft-Windows-TerminalServices-LocalSessionManager/Operational"]
    rows = lq.classify_channel(spark.createDataFrame([(c,) for c in channels], "channel string")).collect()
    short = {r.channel: r.artifact.removeprefix("Windows::WinEvt::") for r in rows}
    assert short.pop("Windows PowerShell") == short.pop("PowerShellCore/Operational") == "PowerShell"
    assert short.pop(SYSMON) == "Sysmon"
    for known in ("Application", "Security", "System", "Setup"):
        assert short.pop(known) == known
    assert all(name == f"Other({channel})" for channel, name in short.items())


def test_stream_takes_new_files_once(spark, store, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("stream"))

    def run():
        for query in lq.stream_logs(lq.watch_logs(spark, root, target + "/seen"), target, target + "/checkpoint"):
            query.awaitTermination()
        return (
            sorted((r.path.rpartition("/")[2], r.channel) for r in spark.read.parquet(target + "/records").collect()),
            sorted(r.path.rpartition("/")[2] for r in spark.read.schema("path string").parquet(target + "/errors").collect()),
        )

    root = store({"/a.evtx": log_of(event("A")), "/junk.evtx": b"junk"})
    assert run() == ([("a.evtx", "A")], ["junk.evtx"])
    store({"/b.evtx": log_of(event("B")), "/SysEvent.evt": evt_file([evt_record(1, 5, 6, 7, 1, 0, "S", "C")])})
    assert run() == ([("SysEvent.evt", "System"), ("a.evtx", "A"), ("b.evtx", "B")], ["junk.evtx"])
    assert os.path.isdir(target + "/checkpoint")
    # Hidden names, an old time, a log that grew by a chunk, a link: each arrives once, and nothing again.
    store({"/_x/c.evtx": log_of(event("C")), "/.d.evtx": log_of(event("D")), "/a.evtx": evtx_file([chunk_of(event("A")), chunk_of(event("A2"), event("A3"), first_id=2)])})
    os.utime(root + "/_x/c.evtx", (1, 1))
    os.symlink(root + "/_x", root + "/link")
    want = [(".d.evtx", "D"), ("SysEvent.evt", "System"), ("a.evtx", "A"), ("a.evtx", "A2"), ("a.evtx", "A3"), ("b.evtx", "B"), ("c.evtx", "C")]
    for _ in range(2):
        assert run() == (want, ["junk.evtx", "link"])


def test_filters_on_ingested_records_reach_the_scan(spark, store, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("table")) + "/records"
    lq.scan_logs(spark, store({"/a.evtx": log_of(event("Security", code="4625"))}))[0].write.parquet(target)
    counted = lq.failed_logons(spark.read.parquet(target))
    plan = counted._jdf.queryExecution().toString()
    assert "EqualTo(channel,Security)" in plan and "EqualTo(event_id,4625)" in plan
    assert "ReadSchema: struct<event_id:bigint,channel:string>" in plan
    assert counted.first().event_count == 1


def test_decode_does_not_shuffle_log_bytes(spark, store):
    root = store({"/a.evtx": log_of(event("A"))})
    records, _ = lq.scan_logs(spark, root)
    plan = records._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert all("REPARTITION_BY_NUM" in line for line in exchanges if "path" not in line)  # listing, heads, ranges
    assert "chunk#" not in "".join(exchanges) and "content" not in plan
    whole = lq.read_records(lq.read_logs(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "content" in line for line in whole.splitlines())


def test_hidden_names_and_patterns_of_names(spark, store):
    names = ["/_x/a.evtx", "/.x/b.evtx", "/y/_c.evtx", "/y/d.evt", "/y/e.txt", "/y/f %20{.evtx"]
    root = store({name: b"x" for name in names})
    found = {r.path[r.path.index(root.rpartition("/")[2]) + len(root.rpartition("/")[2]) :] for r in lq.list_logs(spark, root).collect()}
    assert found == set(names)
    assert lq.list_logs(spark, root, "*.{evt,evtx}").count() == 5 and lq.list_logs(spark, root + "/y").count() == 4
    assert lq.list_logs(spark, root + "/y/d.evt").count() == 1
    listing, errors = lq.list_roots(spark, [root, root + "/none"])
    assert listing.count() == 6 and [r.stage for r in errors.collect()] == ["locate"]


def test_located_logs_are_read_by_several_tasks(spark, store):
    from pyspark.sql import functions as F

    logs = {f"/h{i}/Windows/System32/winevt/Logs/System.evtx": log_of(event("System")) for i in range(24)}
    logs |= {f"/h{i}/copied/System.evtx": log_of(event("System")) for i in range(24, 30)}
    host = F.regexp_extract("path", "/(h[0-9]+)/", 1)
    enriched, errors = lq.collect_logs(spark, [store(logs)], lq.default_catalog(spark), host, r"C:\Windows")
    rows = enriched.select("`artifact.host`", "`artifact.located_by`").collect()
    assert sorted(r[0] for r in rows) == sorted(f"h{i}" for i in range(30)) and errors.count() == 0
    assert sum(r[1] == "file_name" for r in rows) == 6


def test_mismatched_attribution(spark):
    rows = [("System", "WindowsXMLEventLogSystem"), ("Security", "WindowsXMLEventLogSystem"), ("", "WindowsXMLEventLogSystem"),
            ("Vendor/X", "WindowsXMLEventLogSecurity")]
    records = spark.createDataFrame(rows, "channel string, definition string").withColumn("n", F.lit(1))
    assert {r.channel for r in lq.mismatched_attribution(records).collect()} == {"Security", "Vendor/X"}
