"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as contract
import pytest
from logquarry.testing.checks import ORACLES, QUERIES
from run_checks import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["event_count"]


def test_queries_hand_log_bytes_to_python_in_small_batches(spark):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    QUERIES["a2_event_count_unknown"](spark, SF)
    chunks = spark.range(0, 400, 1, 1).selectExpr("cast(repeat('x', 65536) as binary) as chunk")
    found = [row.size for row in chunks.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 400 * 65536 and max(found) < 5 << 20


# Passes over the writer of logs that a query needs: e3 asks for the names of the logs first.
PASSES = {"e3_mismatched_attribution": 2, "h6_log_audit": 1, "s9_log_files_union": 1, "t1_stream_growing_logs": 1}


@pytest.mark.parametrize("name", list(PASSES))
def test_logs_are_not_written_more_often_than_needed(spark, con, monkeypatch, tmp_path, name):
    from logquarry.testing import logs

    write, marks = logs._write_log, str(tmp_path / "marks")

    def noted(rows, variant):
        with open(marks, "ab") as out:
            out.write(b".")
        return write(rows, variant)

    monkeypatch.setattr(logs, "_write_log", noted)
    QUERIES[name](spark, SF).collect()
    written = con.sql("SELECT count(*) FROM (SELECT DISTINCT event_id // 3000, event_type FROM events)").fetchall()[0][0]
    assert (tmp_path / "marks").stat().st_size == PASSES[name] * written


def test_growing_logs_are_stored_once(spark, con, monkeypatch, tmp_path):
    from logquarry.testing import checks, logs

    folders = iter(range(100))

    def scratch(_spark):
        return str(tmp_path / str(next(folders)))

    monkeypatch.setattr(checks, "scratch", scratch)
    assert compare(spark, con, "t1_stream_growing_logs", SF) is None
    stored = [file.stat() for file in tmp_path.rglob("*.evtx")]
    sizes = [row.length for row in logs.evtx_logs(logs.events(spark, SF), "templated").collect()]
    # The logs, and of each what it grew by, which is not more than 4 KiB and the larger half of its chunks.
    assert sum(sizes) < sum(s.st_size for s in stored) < 2 * sum(sizes)
    assert sum(s.st_size for s in stored) <= sum(size + 65536 * -(-(size // 65536) // 2) for size in sizes)


def test_unused_space_of_logs_takes_no_disk(spark, tmp_path):
    import os

    from logquarry.testing.logs import grow_files, write_files

    logs = {
        "/a/log": b"x" * 5000 + bytes(60536) + b"y" * 10 + bytes(65526), "/b/zeros": bytes(131072), "/b/odd": bytes(4096) + b"z" + bytes(5000),
        "/none": b"", "/full": b"f" * 8192,
    }
    files = spark.createDataFrame([(p, bytearray(c)) for p, c in logs.items()], "path string, content binary")
    assert write_files(files, str(tmp_path)).count() == len(logs)
    assert {p: (tmp_path / p[1:]).read_bytes() for p in logs} == logs
    probe = tmp_path / "probe"
    with open(probe, "wb") as out:
        os.truncate(out.fileno(), 1 << 20)
    if os.stat(probe).st_blocks == 0:  # the file system keeps holes
        assert sum((tmp_path / p[1:]).stat().st_blocks * 512 for p in logs) <= 40960 < sum(map(len, logs.values()))
    parts = spark.createDataFrame([("/a/log", 4096, bytearray(b"new")), ("/full", 8192, bytearray(bytes(9000)))], "path string, at int, content binary")
    for _ in range(2):  # a task may run again
        assert grow_files(parts, str(tmp_path)).count() == 2
        assert (tmp_path / "a/log").read_bytes() == b"x" * 4096 + b"new"
        assert (tmp_path / "full").read_bytes() == b"f" * 8192 + bytes(9000)
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["full", "log", "none", "odd", "probe", "zeros"]
