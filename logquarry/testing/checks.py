"""Registered queries, each with the SQL that gives the same rows straight from ``events``.

The Spark side turns the table into log bytes, reads them back and runs the operator; the SQL side
never sees a byte. Logs are bounded (see ``logs.BLOCK``), their number grows with the table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import logquarry as lq

from ..functions.binary import filetime_to_timestamp, hex_encode, timestamp_to_filetime, unix_seconds_to_timestamp
from ..functions.levels import display_event_id, normalise_level
from ..sources.files import held
from .logs import BLOCK, CHANNELS, event_records, events, evt_logs, evtx_logs, grow_files, write_files

Query = Callable[[SparkSession, str], DataFrame]
#: Log bytes a Python worker gets at once: with Spark's 64 MiB its memory grows with the bytes of a task up to there.
BATCH_BYTES = "4m"
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder in the storage the cluster shares; a temporary one where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/logquarry-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="logquarry-")


def stored(spark: SparkSession, files: DataFrame) -> str:
    """Writes the files into shared storage and returns the folder."""
    folder = scratch(spark)
    write_files(files, folder).count()
    return folder


def below(path: Column) -> Column:
    """The path inside the scratch folder."""
    return F.regexp_replace(path, "^.*?(/evidence/)", "/evidence/")


def plain(records: DataFrame) -> DataFrame:
    """Records in flat columns of types both engines share."""
    data = F.col("data")
    return records.select(
        below(F.col("path")).alias("path"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "provider",
        "channel",
        "computer",
        "level",
        "user_sid",
        data["winlog.event_data.cents"].alias("cents"),
        data["winlog.event_data.props"].alias("props"),
        data["winlog.user_data.EventXML.K"].alias("k"),
    )


_CASE_CHANNEL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CHANNELS.items()) + " ELSE '' END"
_LEVEL = "CASE {0} WHEN 1 THEN 'Critical' WHEN 2 THEN 'Error' WHEN 3 THEN 'Warning' WHEN 5 THEN 'Verbose' ELSE 'Information' END"
EV = f"""WITH base AS (
  SELECT e.*, {_CASE_CHANNEL} AS channel, event_id // 3000 AS host FROM events e
), located AS (
  SELECT *, '/evidence/host' || host || CASE WHEN host % 2 = 0 THEN '/Windows/System32/winevt/Logs/'
    ELSE '/CopiedFiles/eventlogs/Logs/' END || replace(channel, '/', '%4') || '.evtx' AS path
  FROM base
), ev AS (
  SELECT path, host, event_type, value,
    (row_number() OVER (PARTITION BY path ORDER BY event_id) - 1) // 60 AS chunk_index,
    (row_number() OVER (PARTITION BY path ORDER BY event_id) - 1) % 60 AS record_index,
    count(*) OVER (PARTITION BY path) AS in_log,
    event_id AS record_id, 4624 + event_id % 2 AS event_id, ts AS "timestamp",
    'provider-' || event_type AS provider, channel, 'HOST' || (user_id % 10) AS computer,
    {_LEVEL.format("event_id % 7")} AS level,
    CASE WHEN event_id % 11 <> 0 THEN 'S-1-5-21-' || user_id END AS user_sid,
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents, props,
    regexp_extract(props, '[0-9]+') AS k
  FROM located
)
"""
_RECORD = """path, chunk_index, record_index, record_id, event_id, "timestamp", provider, channel, computer,
  level, user_sid, cents, props, k"""
EV_RECORDS = f"{EV} SELECT {_RECORD} FROM ev"

EVT = f"""WITH base AS (
  SELECT e.*, event_id // 3000 AS host,
    CASE event_type WHEN 'error' THEN 'SecEvent' WHEN 'click' THEN 'AppEvent' WHEN 'view' THEN 'SysEvent'
      ELSE event_type END AS file
  FROM events e
), evt AS (
  SELECT '/evidence/host' || host || '/Windows/System32/config/' || file || '.evt' AS path,
    row_number() OVER (PARTITION BY host, file ORDER BY event_id) - 1 AS record_index,
    event_id AS record_id, 4624 + event_id % 2 AS event_id, date_trunc('second', ts) AS "timestamp",
    'provider-' || event_type AS provider,
    CASE event_type WHEN 'error' THEN 'Security' WHEN 'click' THEN 'Application' WHEN 'view' THEN 'System'
      ELSE '' END AS channel,
    'HOST' || (user_id % 10) AS computer,
    CASE event_id % 5 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'Information' END AS level,
    CASE WHEN event_id % 11 <> 0 THEN 'S-1-5-21-' || user_id END AS user_sid,
    CASE WHEN event_id % 13 <> 0 THEN event_type || '|' || props END AS strings,
    CASE WHEN event_id % 3 <> 0 THEN printf('%08x', event_id) END AS raw_data,
    date_trunc('second', ts) + INTERVAL 1 SECOND AS time_written, event_id % 9 AS category
  FROM base
)
"""
_EVT_RECORD = """path, record_index, record_id, event_id, "timestamp", provider, channel, computer, level,
  user_sid, strings, raw_data, time_written, category"""


def plain_evt(records: DataFrame) -> DataFrame:
    return records.select(
        below(F.col("path")).alias("path"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "provider",
        "channel",
        "computer",
        "level",
        "user_sid",
        F.array_join("strings", "|").alias("strings"),
        "raw_data",
        F.col("time_written").cast("timestamp_ntz").alias("time_written"),
        F.col("category").cast("bigint").alias("category"),
    )


# -- sources ---------------------------------------------------------------------------------------

_LOG_SIZES = f"""{EV} SELECT path, 4096 + 65536 * (max(chunk_index) + 1) AS length FROM ev GROUP BY path"""


@check(_LOG_SIZES)
def s1_read_logs(spark, sf):
    folder = stored(spark, evtx_logs(events(spark, sf)))
    files = lq.read_logs(spark, folder, "*.evtx")
    return files.select(below(F.col("path")).alias("path"), F.octet_length("content").cast("bigint").alias("length"))


@check(_LOG_SIZES)
def s1_list_logs(spark, sf):
    folder = stored(spark, evtx_logs(events(spark, sf)))
    return lq.list_logs(spark, folder).select(below(F.col("path")).alias("path"), "length")


@check(f"""{EV} SELECT CASE host % 3 WHEN 0 THEN replace(path, '/evidence/', '/evidence/_export/')
  WHEN 1 THEN replace(path, '/evidence/', '/evidence/.hidden/') ELSE path END AS path, count(*) AS records
FROM ev GROUP BY ALL""")
def s1_hidden_names(spark, sf):
    """Names that file listings usually pass over are evidence as well."""
    files = evtx_logs(events(spark, sf), "templated")
    host = F.regexp_extract("path", "^/evidence/host([0-9]+)", 1).cast("int") % 3
    folder = F.when(host == 0, "/evidence/_export/").when(host == 1, "/evidence/.hidden/").otherwise("/evidence/")
    placed = files.withColumn("path", F.concat(folder, F.substring_index("path", "/evidence/", -1)))
    records, _ = lq.scan_logs(spark, stored(spark, placed))
    return records.groupBy(below(F.col("path")).alias("path")).agg(F.count("*").alias("records"))


@check(EV_RECORDS)
def s1_scan_logs_by_range(spark, sf):
    folder = stored(spark, evtx_logs(events(spark, sf), "templated"))
    records, _ = lq.scan_logs(spark, folder)
    return plain(records)


def mixed_files(spark, sf) -> DataFrame:
    """Both formats, and per host one file that is no log and one cut to 16 bytes."""
    table = events(spark, sf)
    added = """inline(if(endswith(path, '/System.evtx'), array(
        struct(path, length, content),
        struct(replace(path, 'System.evtx', 'Cut.evtx') as path, 16L as length, substring(content, 1, 16) as content),
        struct(replace(path, 'System.evtx', 'Garbage.evtx') as path, 256L as length, unhex(repeat('AA', 256)) as content)),
      array(struct(path, length, content))))"""
    evtx = evtx_logs(table).select(F.expr(added))
    return evtx.unionByName(evt_logs(table))


_EVT_FILES = """SELECT DISTINCT '/evidence/host' || (event_id // 3000) || '/Windows/System32/config/' ||
  CASE event_type WHEN 'error' THEN 'SecEvent' WHEN 'click' THEN 'AppEvent' WHEN 'view' THEN 'SysEvent'
  ELSE event_type END || '.evt' AS path FROM events"""


@check(f"""{EV} SELECT DISTINCT path, 'evtx' AS format FROM ev
UNION ALL SELECT path, 'evt' FROM ({_EVT_FILES})
UNION ALL SELECT DISTINCT replace(path, 'System.evtx', 'Cut.evtx'), 'evtx' FROM ev WHERE channel = 'System'
UNION ALL SELECT DISTINCT replace(path, 'System.evtx', 'Garbage.evtx'), NULL FROM ev WHERE channel = 'System'""")
def s2_detect_format(spark, sf):
    return lq.detect_format(mixed_files(spark, sf)).select("path", "format")


def evidence_listing(spark, sf) -> DataFrame:
    """A listing of both formats plus, per host, a log that no definition names."""
    from .logs import channel_of, evt_path_of, path_of

    table = events(spark, sf)
    evtx = table.select(path_of(F.col("event_id"), channel_of(F.col("event_type"))).alias("path"))
    evt = table.select(evt_path_of(F.col("event_id"), F.col("event_type")).alias("path"))
    other = evtx.select(
        F.replace("path", F.lit("System.evtx"), F.lit("Microsoft-Windows-DhcpNap%4Admin.evtx")).alias("path")
    )
    return evtx.union(evt).union(other).distinct()


_DEFINITION = """'WindowsXMLEventLog' || CASE channel WHEN 'Windows PowerShell' THEN 'PowerShell'
  WHEN 'Microsoft-Windows-Sysmon/Operational' THEN 'Sysmon' ELSE channel END"""


@check(f"""{EV} SELECT DISTINCT path, {_DEFINITION} AS definition,
  CASE WHEN host % 2 = 0 THEN 'location' ELSE 'file_name' END AS located_by FROM ev""")
def s3_locate_logs(spark, sf):
    patterns, _ = lq.expand_patterns(lq.default_catalog(spark), r"C:\Windows")
    host = F.regexp_extract("path", "^/evidence/([^/]+)/", 1)
    found = lq.locate_logs(evidence_listing(spark, sf), patterns, evidence=host)
    return found.select("path", "definition", "located_by")


@check(f"""{EV} SELECT {_DEFINITION} AS definition, 'location' AS located_by, count(DISTINCT path) AS logs
FROM ev WHERE host % 2 = 0 GROUP BY 1""")
def s4_expand_patterns(spark, sf):
    """One body of evidence: logs at their location keep copies elsewhere from being taken."""
    patterns, _ = lq.expand_patterns(lq.default_catalog(spark))
    found = lq.locate_logs(evidence_listing(spark, sf), patterns)
    return found.groupBy("definition", "located_by").agg(F.count("*").alias("logs"))


@check(f"{EVT} SELECT {_EVT_RECORD} FROM evt")
def s5_read_evt(spark, sf):
    return plain_evt(lq.read_evt(evt_logs(events(spark, sf))))


@check(f"""{EVT}, cut AS (
  SELECT *, min(CASE WHEN record_id % 100 = 0 THEN record_id END) OVER (PARTITION BY path) AS stop FROM evt
) SELECT {_EVT_RECORD} FROM cut WHERE stop IS NULL OR record_id < stop""")
def s5_read_evt_until_bad_record(spark, sf):
    return plain_evt(lq.read_evt(evt_logs(events(spark, sf), "bad_signature")))


@check(f"{EVT} SELECT {_EVT_RECORD} FROM evt")
def s5_read_evt_in_pieces(spark, sf):
    """Stored legacy logs, each read in ranges of 8 KiB by tasks of their own."""
    heads = lq.read_heads(lq.list_logs(spark, stored(spark, evt_logs(events(spark, sf)))))
    return plain_evt(lq.read_stored_records(heads, evt_range=8192))


@check(ORACLES["s5_read_evt_until_bad_record"])
def s5_read_evt_in_pieces_until_bad_record(spark, sf):
    heads = lq.read_heads(lq.list_logs(spark, stored(spark, evt_logs(events(spark, sf), "bad_signature"))))
    return plain_evt(lq.read_stored_records(heads, evt_range=8192))


@check(f"{EVT} SELECT path, any_value(channel) AS channel FROM evt GROUP BY path")
def s6_with_channel(spark, sf):
    files = evt_logs(events(spark, sf)).select("path")
    return lq.with_channel(files).select("path", "channel")


@check(f"""{EV} SELECT path, max(chunk_index) + 1 AS chunks, 65536 * (max(chunk_index) + 1) AS bytes
FROM ev GROUP BY path""")
def s7_split_chunks(spark, sf):
    chunks = lq.split_chunks(evtx_logs(events(spark, sf)))
    return chunks.groupBy("path").agg(
        F.count("*").alias("chunks"), F.sum(F.octet_length("chunk")).alias("bytes")
    )


@check(f"{EV} SELECT path, chunk_index, record_index, record_id, \"timestamp\" FROM ev")
def s8_frame_records(spark, sf):
    framed = lq.frame_chunks(lq.skip_unwritten(lq.split_chunks(evtx_logs(events(spark, sf), "templated"))))
    return framed.select(
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        filetime_to_timestamp("filetime").cast("timestamp_ntz").alias("timestamp"),
    )


@check(f"""{EV} SELECT path, chunk_index, record_index, record_id FROM ev
WHERE NOT (chunk_index = 1 AND (record_index = 59 OR chunk_index * 60 + record_index = in_log - 1))""")
def s8_frame_records_until_broken(spark, sf):
    """A broken frame ends its own chunk only."""
    framed = lq.frame_chunks(lq.split_chunks(evtx_logs(events(spark, sf), "broken_frames")))
    return framed.select(
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
    )


@check(f"""{EV}, {EVT.replace("WITH base AS", "base2 AS").replace("FROM base\n", "FROM base2\n")}
SELECT 'evtx' AS format, path, chunk_index, record_index, record_id, event_id, "timestamp", channel, level FROM ev
UNION ALL SELECT 'evt', path, 0, record_index, record_id, event_id, "timestamp", channel, level FROM evt""")
def s9_log_files_union(spark, sf):
    """One DataFrame over both formats; the files that are no logs do not stop the others. Each format reads all files,
    so they are stored first."""
    files = lq.read_logs(spark, stored(spark, mixed_files(spark, sf)))
    records = lq.log_files_union(lq.read_evtx(files), lq.read_evt(files))
    return both_formats(records.withColumn("path", below(F.col("path"))))


def both_formats(records: DataFrame) -> DataFrame:
    return records.select(
        "format",
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "channel",
        "level",
    )


@check(ORACLES["s9_log_files_union"])
def s9_read_records_in_one_scan(spark, sf):
    return both_formats(lq.read_records(mixed_files(spark, sf)))


# -- decoding --------------------------------------------------------------------------------------


@check(EV_RECORDS)
def d1_decode_plain(spark, sf):
    return plain(lq.read_evtx(evtx_logs(events(spark, sf))))


@check(EV_RECORDS)
def d1_decode_templates(spark, sf):
    return plain(lq.read_evtx(evtx_logs(events(spark, sf), "templated")))


@check(f"""{EV} SELECT record_id, node.path AS node_path, node.text AS text FROM ev, LATERAL (
  SELECT * FROM (VALUES
    ('Event[0]', ''), ('Event[0]/System[0]', ''), ('Event[0]/System[0]/Provider[0]', ''),
    ('Event[0]/System[0]/EventID[0]', CAST(ev.event_id AS VARCHAR)),
    ('Event[0]/System[0]/Level[0]', CAST(ev.record_id % 7 AS VARCHAR)),
    ('Event[0]/System[0]/Channel[0]', ev.channel), ('Event[0]/System[0]/Computer[0]', ev.computer),
    ('Event[0]/System[0]/Security[0]', ''), ('Event[0]/EventData[0]', ''),
    ('Event[0]/EventData[0]/Data[0]', ev.cents), ('Event[0]/EventData[0]/Data[1]', ev.props),
    ('Event[0]/UserData[0]', ''), ('Event[0]/UserData[0]/EventXML[0]', ''),
    ('Event[0]/UserData[0]/EventXML[0]/K[0]', ev.k)) t(path, text)) node""")
def d1_decoded_nodes(spark, sf):
    decoded = lq.decode_chunks(lq.split_chunks(evtx_logs(events(spark, sf), "templated")))
    node = F.explode("nodes").alias("node")
    return decoded.select("record_id", node).select("record_id", F.col("node.path").alias("node_path"), "node.text")


def _undecodable_sql(message: str) -> str:
    bad = "record_id % 50 = 0"
    texts = ", ".join(f"CASE WHEN {bad} THEN '' ELSE {c} END AS {c}" for c in ("provider", "channel", "computer"))
    return f"""{EV} SELECT path, chunk_index, record_index, record_id,
      CASE WHEN {bad} THEN 0 ELSE event_id END AS event_id, "timestamp", {texts},
      CASE WHEN {bad} THEN 'Information' ELSE level END AS level,
      CASE WHEN {bad} THEN NULL ELSE user_sid END AS user_sid,
      CASE WHEN {bad} THEN {message} END AS decode_error FROM ev"""


def undecodable(spark, sf, variant: str) -> DataFrame:
    records = lq.read_evtx(evtx_logs(events(spark, sf), variant))
    return records.select(
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "provider",
        "channel",
        "computer",
        "level",
        "user_sid",
        "decode_error",
    )


@check(_undecodable_sql("'unexpected token 0x04'"))
def d2_undecodable_records(spark, sf):
    return undecodable(spark, sf, "bad_records")


@check(_undecodable_sql("'BinXML fragment decoded but contained no Event root element'"))
def d3_no_root_records(spark, sf):
    return undecodable(spark, sf, "no_root")


@check(_undecodable_sql("""CASE (record_id // 50) % 3 WHEN 0 THEN 'array item without bytes'
  WHEN 1 THEN 'template contains itself' ELSE 'more substitutions than the record has room for' END"""))
def d2_hostile_records(spark, sf):
    return undecodable(spark, sf, "hostile")


# -- headers and integrity ---------------------------------------------------------------------------


@check(f"""{EV} SELECT path, max(chunk_index) + 1 AS chunk_count, max(chunk_index) AS last_chunk_number,
  max(record_id) + 1 AS next_record_id, CAST(128 AS BIGINT) AS header_size, CAST(3 AS BIGINT) AS major_version, CAST(1 AS BIGINT) AS minor_version,
  CAST(4096 AS BIGINT) AS header_block_size, TRUE AS is_dirty, FALSE AS is_full, TRUE AS checksum_valid FROM ev GROUP BY path""")
def h1_evtx_log_headers(spark, sf):
    headers = lq.evtx_log_headers(evtx_logs(events(spark, sf), "dirty"))
    numbers = ("chunk_count", "last_chunk_number", "next_record_id", "header_size", "major_version",
               "minor_version", "header_block_size")
    return headers.select(
        "path", *[F.col(c).cast("bigint").alias(c) for c in numbers], "is_dirty", "is_full", "checksum_valid"
    )


@check(f"""{EVT} SELECT path, CAST(1 AS BIGINT) AS major_version, CAST(1 AS BIGINT) AS minor_version, CAST(4096 AS BIGINT) AS start_offset, CAST(48 AS BIGINT) AS end_offset,
  min(record_id) AS first_record_number, min(record_id) + count(*) - 1 AS last_record_number,
  CAST(2 AS BIGINT) AS flags, FALSE AS is_dirty, TRUE AS is_wrapped, FALSE AS is_archived FROM evt GROUP BY path""")
def h2_evt_log_headers(spark, sf):
    headers = lq.evt_log_headers(evt_logs(events(spark, sf), "wrapped"))
    return headers.select(
        "path", "major_version", "minor_version", "start_offset", "end_offset", "first_record_number",
        "last_record_number", "flags", "is_dirty", "is_wrapped", "is_archived",
    )


@check(f"""{EV} SELECT path, chunk_index, min(record_id) AS first_record_id, max(record_id) AS last_record_id,
  chunk_index * 60 + 1 AS first_record_number, chunk_index * 60 + count(*) AS last_record_number, CAST(0 AS BIGINT) AS flags,
  chunk_index % 2 = 0 AS events_checksum_valid, TRUE AS header_checksum_valid, CAST(64 AS BIGINT) AS name_buckets,
  CAST(32 AS BIGINT) AS template_buckets, CAST(1 AS BIGINT) AS used_templates FROM ev GROUP BY path, chunk_index""")
def h3_chunk_headers(spark, sf):
    headers = lq.chunk_headers(lq.split_chunks(evtx_logs(events(spark, sf), "templated", "bad_checksums")))
    numbers = ("chunk_index", "first_record_id", "last_record_id", "first_record_number", "last_record_number", "flags")
    return headers.select(
        "path",
        *[F.col(c).cast("bigint").alias(c) for c in numbers],
        "events_checksum_valid",
        "header_checksum_valid",
        F.size("name_buckets").cast("bigint").alias("name_buckets"),
        F.size("template_buckets").cast("bigint").alias("template_buckets"),
        F.size(F.filter("template_buckets", lambda b: b > 0)).cast("bigint").alias("used_templates"),
    )


@check(f"{EV} SELECT path, max(chunk_index) + 1 AS written, max(chunk_index) + 2 AS slots FROM ev GROUP BY path")
def h4_skip_unwritten(spark, sf):
    chunks = lq.split_chunks(evtx_logs(events(spark, sf), "unwritten")).select("path", "chunk_index", "chunk")
    slots = chunks.groupBy("path").agg(F.count("*").alias("slots"))
    written = lq.skip_unwritten(chunks).groupBy("path").agg(F.count("*").alias("written"))
    return written.join(slots, "path").select("path", "written", "slots")


@check(f"""{EV} SELECT path, chunk_index, record_index, record_id, channel, chunk_index % 2 = 0 AS chunk_checksum_valid,
  FALSE AS file_checksum_valid FROM ev""")
def h5_flag_integrity(spark, sf):
    records = lq.read_evtx(evtx_logs(events(spark, sf), "bad_checksums", "bad_header"))
    return records.select(
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
        "channel",
        "chunk_checksum_valid",
        "file_checksum_valid",
    )


def flat_audit(audit: DataFrame) -> DataFrame:
    numbers = ("chunk_count_declared", "slots_by_length", "slots_parsed", "slots_skipped", "truncated_bytes",
               "records", "decode_errors")
    return audit.select(
        "path", *[F.col(c).cast("bigint").alias(c) for c in numbers], "is_dirty", "is_full", "is_incomplete"
    )


@check(f"""{EV} SELECT path, max(chunk_index) + 2 AS chunk_count_declared, max(chunk_index) + 2 AS slots_by_length,
  max(chunk_index) + 1 AS slots_parsed, CAST(1 AS BIGINT) AS slots_skipped, CAST(0 AS BIGINT) AS truncated_bytes, count(*) AS records,
  CAST(sum(CASE WHEN record_id % 50 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS decode_errors,
  TRUE AS is_dirty, FALSE AS is_full, TRUE AS is_incomplete FROM ev GROUP BY path""")
def h6_log_audit(spark, sf):
    """An unwritten slot is counted as declared by this writer, so the log shows as incomplete."""
    return flat_audit(lq.log_audit(evtx_logs(events(spark, sf), "unwritten", "bad_records", "dirty")))


@check(f"""{EV} SELECT path, max(chunk_index) + 1 AS chunk_count_declared, max(chunk_index) AS slots_by_length,
  max(chunk_index) AS slots_parsed, CAST(0 AS BIGINT) AS slots_skipped, CAST(35536 AS BIGINT) AS truncated_bytes,
  CAST(sum(CASE WHEN chunk_index * 60 < ((in_log - 1) // 60) * 60 THEN 1 ELSE 0 END) AS BIGINT) AS records,
  CAST(0 AS BIGINT) AS decode_errors, FALSE AS is_dirty, FALSE AS is_full, TRUE AS is_incomplete FROM ev GROUP BY path""")
def h6_log_audit_truncated(spark, sf):
    """Logs cut inside their last chunk: its records are missing, and the audit says so."""
    return flat_audit(lq.log_audit(evtx_logs(events(spark, sf), "cut")))


@check(f"""{EVT} SELECT path, FALSE AS is_dirty, TRUE AS is_wrapped, FALSE AS is_archived, TRUE AS end_before_start,
  CAST(0 AS BIGINT) AS records_declared, CAST(0 AS BIGINT) AS records FROM evt GROUP BY path""")
def h6_evt_audit(spark, sf):
    return lq.evt_audit(evt_logs(events(spark, sf), "wrapped")).select(
        "path", "is_dirty", "is_wrapped", "is_archived", "end_before_start",
        F.col("records_declared").cast("bigint").alias("records_declared"), "records",
    )


@check(ORACLES["h6_log_audit"])
def h6_audit_stored(spark, sf):
    """The same from stored logs: tasks hand over four numbers a byte range."""
    folder = stored(spark, evtx_logs(events(spark, sf), "unwritten", "bad_records", "dirty"))
    audit = flat_audit(lq.audit_stored(lq.read_heads(lq.list_logs(spark, folder))))
    return audit.withColumn("path", below(F.col("path")))


# -- projections -----------------------------------------------------------------------------------


def decoded(spark, sf, *variant: str) -> DataFrame:
    return lq.decode_chunks(lq.split_chunks(evtx_logs(events(spark, sf), *variant)))


@check(f"""{EV} SELECT record_id, event_id, "timestamp", provider, channel, computer, level, user_sid FROM ev""")
def p1_map_system(spark, sf):
    mapped = lq.map_system(decoded(spark, sf))
    return mapped.select(
        "record_id", "event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "provider",
        "channel", "computer", "level", "user_sid",
    )


@check(f"""{EV} SELECT record_id, cents AS a, props AS unnamed, '0x' || printf('%08x', record_id) AS "binary",
  CAST(3 AS BIGINT) AS fields FROM ev""")
def p2_map_event_data(spark, sf):
    """A repeated name keeps the last value; a Data without name gets its position."""
    data = F.col("data")
    return lq.map_event_data(decoded(spark, sf, "odd_data")).select(
        "record_id",
        data["winlog.event_data.A"].alias("a"),
        data["winlog.event_data.1"].alias("unnamed"),
        data["winlog.event_data.binary"].alias("binary"),
        F.size(data).cast("bigint").alias("fields"),
    )


@check(f"{EV} SELECT record_id, k, CAST(1 AS BIGINT) AS fields FROM ev")
def p3_map_user_data(spark, sf):
    data = F.col("data")
    return lq.map_user_data(decoded(spark, sf, "templated")).select(
        "record_id", data["winlog.user_data.EventXML.K"].alias("k"), F.size(data).cast("bigint").alias("fields")
    )


@check(f"{EVT} SELECT {_EVT_RECORD} FROM evt")
def p4_map_evt(spark, sf):
    files = lq.with_channel(evt_logs(events(spark, sf)))
    return plain_evt(lq.map_evt(lq.decode_evt(files)))


@check(f"""SELECT event_id, {_LEVEL.format("event_id % 7")} AS evtx_level,
  CASE event_id % 5 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'Information' END AS evt_level FROM events""")
def p5_normalise_level(spark, sf):
    return events(spark, sf).select(
        "event_id",
        normalise_level("cast(event_id % 7 as string)").alias("evtx_level"),
        normalise_level("shiftleft(1, cast(event_id % 5 as int))", "evt").alias("evt_level"),
    )


@check("SELECT event_id, (4624 + event_id) % 65536 AS shown_id FROM events")
def p6_display_event_id(spark, sf):
    raw = f"{0x40000000 + 4624} + event_id"
    return events(spark, sf).select("event_id", display_event_id(raw).alias("shown_id"))


@check("""SELECT event_id, '0x' || lower(hex(props)) AS evtx_hex, lower(hex(props)) AS evt_hex FROM events""")
def p7_hex_encode(spark, sf):
    data = "cast(props as binary)"
    return events(spark, sf).select(
        "event_id", hex_encode(data).alias("evtx_hex"), hex_encode(data, "").alias("evt_hex")
    )


@check("SELECT event_id, ts AS from_filetime, date_trunc('second', ts) AS from_seconds FROM events")
def p8_to_timestamp(spark, sf):
    timed = events(spark, sf).select(
        "event_id",
        timestamp_to_filetime("cast(ts as timestamp)").alias("ticks"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"),
    )
    return timed.select(
        "event_id",
        filetime_to_timestamp("ticks").cast("timestamp_ntz").alias("from_filetime"),
        unix_seconds_to_timestamp("seconds").cast("timestamp_ntz").alias("from_seconds"),
    )


TYPED = ["int8", "uint8", "int16", "uint16", "int32", "uint32", "int64", "uint64", "real32", "real64", "bool",
         "binary", "guid", "size", "filetime", "sid", "hex32", "hex64", "ansi", "null"]
_N = "record_id"
_TYPED_SQL = {
    "int8": f"CAST({_N} % 256 - 128 AS VARCHAR)",
    "uint8": f"CAST({_N} % 256 AS VARCHAR)",
    "int16": f"CAST(-({_N} % 30000) AS VARCHAR)",
    "uint16": f"CAST({_N} % 65536 AS VARCHAR)",
    "int32": f"CAST(-{_N} AS VARCHAR)",
    "uint32": f"CAST({_N} AS VARCHAR)",
    "int64": f"CAST(-{_N} * 1000000007 AS VARCHAR)",
    "uint64": f"CAST({_N} * 1000000007 AS VARCHAR)",
    "real32": f"regexp_replace(CAST(CAST({_N} AS DOUBLE) / 4 AS VARCHAR), '\\.0$', '')",
    "real64": "regexp_replace(CAST(CAST(cents AS DOUBLE) / 100 AS VARCHAR), '\\.0$', '')",
    "bool": f"CASE WHEN {_N} % 2 = 1 THEN 'true' ELSE 'false' END",
    "binary": f"'0x' || printf('%08x', {_N})",
    "guid": f"'{{' || printf('%08x', {_N}) || '-' || printf('%04x', {_N} % 65536) || '-0007-0001-020304050607}}'",
    "size": f"CAST({_N} AS VARCHAR)",
    "filetime": """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '0Z'""",
    "sid": f"'S-1-5-21-' || {_N}",
    "hex32": f"'0x' || printf('%08x', {_N})",
    "hex64": f"'0x' || printf('%016x', {_N})",
    "ansi": "props",
    "null": "''",
}


@check(f"{EV} SELECT record_id, " + ", ".join(f'{_TYPED_SQL[c]} AS t_{c}' for c in TYPED) + " FROM ev")
def p9_render_values(spark, sf):
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated", "typed"))
    data = F.col("data")
    return records.select("record_id", *[data[f"winlog.event_data.{c}"].alias(f"t_{c}") for c in TYPED])


@check(f"""{EV} SELECT record_id, -record_id AS t_int32, CAST(record_id AS DOUBLE) * 1000000007 AS t_uint64,
  CAST(cents AS DOUBLE) / 100 AS t_real64, record_id % 2 = 1 AS t_bool, printf('%08X', record_id) AS t_binary,
  "timestamp" AS t_filetime, CAST(NULL AS BIGINT) AS no_number FROM ev""")
def p9_typed_values(spark, sf):
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated", "typed"))

    def typed(name: str, kind: str) -> Column:
        return lq.typed_value(f"winlog.event_data.{name}", kind)

    return records.select(
        "record_id",
        typed("int32", "signed").alias("t_int32"),
        typed("uint64", "unsigned").cast("double").alias("t_uint64"),
        typed("real64", "float").alias("t_real64"),
        typed("bool", "bool").alias("t_bool"),
        F.hex(typed("binary", "binary")).alias("t_binary"),
        typed("filetime", "date").cast("timestamp_ntz").alias("t_filetime"),
        typed("ansi", "signed").alias("no_number"),
    )


@check(f"""{EV} SELECT record_id, -(record_id % 30000) || ',0,' || record_id % 7 AS t_int16s, record_id || ',4294967295' AS t_uint32s,
  'a,' || record_id || ',,b' AS t_texts, '' AS t_none, CAST(record_id AS VARCHAR) AS t_size4,
  '2024-02-29T' || printf('%02d:%02d', record_id % 24, record_id % 60) || ':07.' || printf('%03d0000Z', record_id % 1000) AS t_systime FROM ev""")
def p9_render_arrays(spark, sf):
    """Arrays, dates by their parts and sizes of four bytes, as log viewers show them."""
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated", "typed"))
    names = ("int16s", "uint32s", "texts", "none", "size4", "systime")
    return records.select("record_id", *[F.col("data")[f"winlog.event_data.{c}"].alias(f"t_{c}") for c in names])


_VARIANTS = {
    "int8": (f"CAST({_N} % 256 - 128 AS BIGINT)", "bigint"),
    "uint32": (_N, "bigint"),
    "int64": (f"-{_N} * 1000000007", "bigint"),
    "real64": ("CAST(cents AS DOUBLE) / 100", "double"),
    "bool": (f"{_N} % 2 = 1", "boolean"),
    "binary": (f"'0x' || printf('%08x', {_N})", "string"),
    "sid": (f"'S-1-5-21-' || {_N}", "string"),
    "hex32": (_N, "bigint"),
    "hex64": (_N, "bigint"),
    "size4": (_N, "bigint"),
    "ansi": ("props", "string"),
}


@check(f"""{EV} SELECT record_id, {", ".join(f"{sql} AS t_{name}" for name, (sql, _) in _VARIANTS.items())},
  -(record_id % 30000) AS first, record_id % 7 AS third, 'a,' || record_id AS text, '' AS empty, 'b' AS last,
  CAST(0 AS BIGINT) AS none, TRUE AS is_null FROM ev""")
def p9_variant_values(spark, sf):
    """Values by their types: items with commas stay whole, Null is null."""
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated", "typed"), typed=True)
    value = F.col("typed_data")

    def item(name: str, path: str, kind: str) -> Column:
        return F.variant_get(value[f"winlog.event_data.{name}"], path, kind)

    return records.select(
        "record_id",
        *[item(name, "$", kind).alias(f"t_{name}") for name, (_, kind) in _VARIANTS.items()],
        item("int16s", "$[0]", "bigint").alias("first"),
        item("int16s", "$[2]", "bigint").alias("third"),
        item("texts", "$[0]", "string").alias("text"),
        item("texts", "$[1]", "string").alias("empty"),
        item("texts", "$[2]", "string").alias("last"),
        F.size(item("none", "$", "array<string>")).cast("bigint").alias("none"),
        F.is_variant_null(value["winlog.event_data.null"]).alias("is_null"),
    )


_ARTIFACT = """'Windows::WinEvt::' || CASE channel WHEN 'Windows PowerShell' THEN 'PowerShell'
  WHEN 'Microsoft-Windows-Sysmon/Operational' THEN 'Sysmon' ELSE channel END"""


@check(f"""SELECT channel, artifact, count(*) AS records FROM (
  SELECT ev_channel AS channel, {_ARTIFACT.replace("CASE channel", "CASE ev_channel").replace("ELSE channel", "ELSE ev_channel")} AS artifact
  FROM (SELECT {_CASE_CHANNEL} AS ev_channel FROM events)
  UNION ALL SELECT 'Vendor/' || event_type, 'Windows::WinEvt::Other(Vendor/' || event_type || ')' FROM events
) GROUP BY 1, 2""")
def p10_classify_channel(spark, sf):
    table = events(spark, sf)
    known = event_records(table).select("channel")
    vendor = table.select(F.concat(F.lit("Vendor/"), F.col("event_type")).alias("channel"))
    classified = lq.classify_channel(known.union(vendor))
    return classified.groupBy("channel", "artifact").agg(F.count("*").alias("records"))


# -- enrichment ------------------------------------------------------------------------------------

_COMMON = """"timestamp" AS at_timestamp, event_id AS event_code, record_id AS event_record_id, channel AS event_channel,
  computer AS host_name"""


def common_names(enriched: DataFrame) -> DataFrame:
    names = {
        "event_code": "event.code", "event_record_id": "event.record_id", "event_channel": "event.channel",
        "host_name": "host.name", "artifact_host": "artifact.host", "artifact_name": "artifact.name",
    }
    return enriched.select(
        F.col("`@timestamp`").cast("timestamp_ntz").alias("at_timestamp"),
        *[F.col(f"`{old}`").alias(new) for new, old in names.items()],
        below(F.col("`artifact.path`")).alias("artifact_path"),
        *[F.col(f"`artifact.{c}`").alias(f"artifact_{c}") for c in ("definition", "located_by")
          if f"artifact.{c}" in enriched.columns],
    )


@check(f"""{EV} SELECT {_COMMON}, 'TEST-HOST' AS artifact_host, {_ARTIFACT} AS artifact_name, path AS artifact_path
FROM ev""")
def e1_enrich(spark, sf):
    return common_names(lq.enrich(event_records(events(spark, sf)), "TEST-HOST"))


def host_of_path() -> Column:
    return F.regexp_extract("path", "/evidence/([^/]+)/", 1)


@check(f"""{EV} SELECT {_COMMON}, 'host' || host AS artifact_host, {_ARTIFACT} AS artifact_name, path AS artifact_path,
  {_DEFINITION} AS artifact_definition, CASE WHEN host % 2 = 0 THEN 'location' ELSE 'file_name' END AS artifact_located_by
FROM ev""")
def e1_collect_logs(spark, sf):
    """The whole job over stored files of many hosts: list, locate, read headers, read chunks, decode, enrich."""
    table = events(spark, sf)
    folder = stored(spark, evtx_logs(table, "templated"))
    enriched, _ = lq.collect_logs(spark, [folder], lq.default_catalog(spark), host_of_path(), r"C:\Windows")
    return common_names(enriched)


@check(f"""{EV}, placed AS (
  SELECT *, 'Host' || host AS body, CASE host % 3 WHEN 0 THEN 'WinNT' WHEN 1 THEN 'Windows' ELSE 'OS' END AS folder FROM ev
) SELECT {_COMMON}, body AS artifact_host, {_ARTIFACT} AS artifact_name,
  CASE WHEN host % 2 = 0 THEN '/evidence/host' || host || '/' ELSE '/evidence/host' || (host - 1) || '/image/' END || folder ||
    '/System32/winevt/Logs/' || replace(channel, '/', '%4') || '.evtx' AS artifact_path,
  {_DEFINITION} AS artifact_definition, 'location' AS artifact_located_by FROM placed""")
def e1_collect_evidence(spark, sf):
    """Bodies of evidence with system roots of their own, every second one inside another."""
    files = evtx_logs(events(spark, sf), "templated")
    host = F.regexp_extract("path", "/evidence/host([0-9]+)/", 1).cast("int")
    system = F.element_at(F.array(F.lit("WinNT"), F.lit("Windows"), F.lit("OS")), host % 3 + 1)
    root = F.when(host % 2 == 0, F.concat(F.lit("/evidence/host"), host)).otherwise(F.concat(F.lit("/evidence/host"), host - 1, F.lit("/image")))
    name = F.substring_index("path", "/", -1)
    placed = files.withColumn("path", F.concat(root, F.lit("/"), system, F.lit("/System32/winevt/Logs/"), name))
    folder = stored(spark, placed)
    hosts = events(spark, sf).agg(F.max("event_id")).first()[0] // BLOCK + 1
    bodies = [
        (folder + (f"/evidence/host{h}" if h % 2 == 0 else f"/evidence/host{h - 1}/image"), f"Host{h}", "C:\\" + ("WinNT", "Windows", "OS")[h % 3])
        for h in range(hosts)
    ]
    return common_names(lq.collect_evidence(spark, bodies, lq.default_catalog(spark))[0])


@check(f"""{EV} SELECT path, sha256(path) AS source_id, 'ImageRead' AS acquisition, 'Allocated' AS recovery,
  count(*) AS records FROM ev GROUP BY path""")
def e2_with_provenance(spark, sf):
    records = lq.with_provenance(lq.read_evtx(evtx_logs(events(spark, sf), "templated")))
    return records.groupBy("path", "source_id", "acquisition", "recovery").agg(F.count("*").alias("records"))


@check(f"""{EV} SELECT replace(path, 'Security.evtx', 'System.evtx') AS path, record_id, channel,
  'WindowsXMLEventLogSystem' AS definition, 'WindowsXMLEventLogSecurity' AS channel_definition
FROM ev WHERE channel = 'Security'""")
def e3_mismatched_attribution(spark, sf):
    """Every Security log sits where the System log belongs."""
    files = evtx_logs(events(spark, sf), "templated")
    planted = files.where(~F.col("path").endswith("/System.evtx")).withColumn(
        "path", F.replace("path", F.lit("Security.evtx"), F.lit("System.evtx"))
    )
    patterns, _ = lq.expand_patterns(lq.default_catalog(spark), r"C:\Windows")
    host = F.regexp_extract("path", "^/evidence/([^/]+)/", 1)
    # Locating reads its listing more than once: the names are kept, so the logs are not written anew for each.
    located = lq.locate_logs(held(planted.select("path")), patterns, evidence=host)
    records = lq.read_evtx(planted.join(located, "path"))
    return lq.mismatched_attribution(records).select("path", "record_id", "channel", "definition", "channel_definition")


# -- filters and errors ------------------------------------------------------------------------------


@check(f"""{EV} SELECT {_RECORD} FROM ev WHERE channel IN ('Security', 'System') AND event_id = 4625""")
def f1_query(spark, sf):
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated"))
    return plain(lq.query(records, channels=["Security", "System"], event_ids=[4625]))


@check(f"{EVT} SELECT {_EVT_RECORD} FROM evt WHERE channel = 'Application' AND event_id IN (4624, 4625)")
def f1_query_evt(spark, sf):
    records = lq.read_evt(evt_logs(events(spark, sf)))
    return plain_evt(lq.query(records, channels=["Application"], event_ids=[4624, 4625]))


@check(EV_RECORDS)
def f2_query_all(spark, sf):
    return plain(lq.query_all(lq.read_evtx(evtx_logs(events(spark, sf), "templated"))))


@check(f"""{EV} SELECT {_RECORD} FROM ev WHERE channel IN ('Security', 'System') AND event_id = 4625""")
def f1_scan_filtered(spark, sf):
    """Both predicates are tested in the decoder; records that fail them are not decoded."""
    folder = stored(spark, evtx_logs(events(spark, sf), "templated"))
    return plain(lq.scan_logs(spark, folder, channels=["Security", "System"], event_ids=[4625])[0])


@check(f"""{EV} SELECT {_RECORD} FROM ev WHERE channel = 'Security' AND event_id = 4625""")
def f1_scan_indexed(spark, sf):
    """A second question to the same logs: chunks that a stored index rules out are not read."""
    folder, table = stored(spark, evtx_logs(events(spark, sf), "templated")), scratch(spark) + "/index"
    lq.index_logs(spark, folder).write.parquet(table)
    return plain(lq.scan_indexed(spark, folder, spark.read.parquet(table), channels=["Security"], event_ids=[4625]))


@check(f"{EVT} SELECT path, record_index, record_id, level FROM evt WHERE channel = 'Application' AND event_id = 4625")
def f1_scan_filtered_evt(spark, sf):
    folder = stored(spark, evt_logs(events(spark, sf)))
    wanted = {"columns": ["record_id", "level"], "channels": ["Application"], "event_ids": [4625]}
    records, _ = lq.scan_logs(spark, folder, **wanted)
    index = F.col("record_index").cast("bigint").alias("record_index")
    return records.select(below(F.col("path")).alias("path"), index, "record_id", "level")


@check(f"""{EV} SELECT path, 'record' AS kind, count(*) AS n, NULL AS message FROM ev GROUP BY path
UNION ALL SELECT DISTINCT path, 'error', 1, path || ': file became shorter while it was read' FROM ev WHERE channel = 'System'""")
def f3_read_failures(spark, sf):
    """Logs that are shorter than they were when listed: one error each, and all records that are there."""
    heads = lq.read_heads(lq.list_logs(spark, stored(spark, evtx_logs(events(spark, sf), "templated"))))
    longer = F.when(F.col("path").endswith("/System.evtx"), F.col("length") + 3 * 65536).otherwise(F.col("length"))
    tagged = lq.tagged_records(lq.examine(heads.withColumn("length", longer)))
    records = lq.records_of(tagged).groupBy("path").agg(F.count("*").alias("n"))
    records = records.select("path", F.lit("record").alias("kind"), "n", F.lit(None).cast("string").alias("message"))
    failures = lq.failures_of(tagged).select("path", F.lit("error").alias("kind"), F.lit(1).cast("long").alias("n"), "message")
    shown = F.regexp_replace("message", "^.*?(/evidence/)", "/evidence/").alias("message")
    return records.unionByName(failures).select(below(F.col("path")).alias("path"), "kind", "n", shown)


@check(f"""{EV} SELECT 'record' AS kind, path, count(*) AS n FROM ev GROUP BY path
UNION ALL SELECT DISTINCT 'error', replace(path, 'System.evtx', name || '.evtx'), 1
FROM ev, (VALUES ('Cut'), ('Garbage')) t(name) WHERE channel = 'System'""")
def u1_ingest_logs(spark, sf):
    """One pass over stored logs into one table, from which records and errors are read."""
    files = mixed_files(spark, sf).where("path like '%.evtx'")
    records, errors = lq.ingest_logs(spark, stored(spark, files), scratch(spark) + "/lake")
    found = records.select(F.lit("record").alias("kind"), "path").unionByName(errors.select(F.lit("error").alias("kind"), "path"))
    return found.groupBy("kind", below(F.col("path")).alias("path")).agg(F.count("*").alias("n"))


@check(f"""{EV}, hosts AS (SELECT DISTINCT path FROM ev WHERE channel = 'System')
SELECT replace(path, 'System.evtx', 'Cut.evtx') AS path, 'header' AS stage,
  replace(path, 'System.evtx', 'Cut.evtx') || ': file is shorter than its header' AS message FROM hosts
UNION ALL SELECT replace(path, 'System.evtx', 'Garbage.evtx'), 'header',
  replace(path, 'System.evtx', 'Garbage.evtx') || ': not an event log' FROM hosts""")
def f3_header_errors(spark, sf):
    return lq.header_errors(mixed_files(spark, sf))


@check(f"""{EV} SELECT DISTINCT path, 'header' AS stage, path || CASE channel
  WHEN 'System' THEN ': file is shorter than its header' ELSE ': not an event log' END AS message
FROM ev WHERE channel IN ('System', 'Application')""")
def f3_collect_errors(spark, sf):
    """Located logs that cannot be read: one error each, naming the log. The others are still read."""
    files = evtx_logs(events(spark, sf))
    broken = files.withColumn(
        "content",
        F.when(F.col("path").endswith("/System.evtx"), F.substring("content", 1, 16))
        .when(F.col("path").endswith("/Application.evtx"), F.unhex(F.repeat(F.lit("AA"), 4096)))
        .otherwise(F.col("content")),
    )
    folder = stored(spark, broken)
    _, errors = lq.collect_logs(spark, [folder], lq.default_catalog(spark), host_of_path(), r"C:\Windows")
    shown = F.regexp_replace("message", "^.*?(/evidence/)", "/evidence/")
    return errors.select(below(F.col("path")).alias("path"), "stage", shown.alias("message"))


# -- aggregates and order ------------------------------------------------------------------------------


@check(f"""{EV}, marked AS (
  SELECT path, chunk_index, record_index, CASE WHEN record_id % 50 = 0 THEN '' ELSE channel END AS channel FROM ev
), ranked AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY path, chunk_index, record_index) AS r FROM marked)
SELECT channel, path, chunk_index, record_index FROM ranked WHERE r = 1""")
def a1_channels(spark, sf):
    """Undecodable records contribute the empty channel."""
    found = lq.channels(lq.read_evtx(evtx_logs(events(spark, sf), "bad_records")))
    return found.select(
        "channel",
        "first.path",
        F.col("first.chunk_index").cast("bigint").alias("chunk_index"),
        F.col("first.record_index").cast("bigint").alias("record_index"),
    )


@check(ORACLES["a1_channels"])
def a1_channels_from_logs(spark, sf):
    """Only the channel leaves the tasks."""
    folder = stored(spark, evtx_logs(events(spark, sf), "bad_records"))
    found = lq.channels(lq.scan_logs(spark, folder, columns=["channel"])[0])
    return found.select(
        "channel",
        below(F.col("first.path")).alias("path"),
        F.col("first.chunk_index").cast("bigint").alias("chunk_index"),
        F.col("first.record_index").cast("bigint").alias("record_index"),
    )


@check(f"""{EVT} SELECT channel, min(path) AS path FROM evt GROUP BY channel""")
def a1_channels_evt(spark, sf):
    """Wrapped logs hold no readable record and still name their channel."""
    files = evt_logs(events(spark, sf), "wrapped")
    logs = lq.with_channel(files).select("path", "channel")
    return lq.channels(lq.read_evt(files), logs).select("channel", "first.path")


@check(f"""{EV}, marked AS (
  SELECT path, chunk_index, record_index, CASE WHEN record_id % 50 = 0 THEN '' ELSE channel END AS channel FROM ev
) SELECT path, channel, min(chunk_index * 60 + record_index) AS first_position FROM marked GROUP BY path, channel""")
def a1_channels_per_log(spark, sf):
    found = lq.channels_per_log(lq.read_evtx(evtx_logs(events(spark, sf), "bad_records")))
    position = F.col("first.chunk_index").cast("bigint") * 60 + F.col("first.record_index")
    return found.select("path", "channel", position.alias("first_position"))


@check(f"{EV} SELECT count(*) AS event_count FROM ev WHERE channel = 'Microsoft-Windows-Sysmon/Operational'")
def a2_event_count(spark, sf):
    records = lq.read_evtx(evtx_logs(events(spark, sf), "templated"))
    return lq.event_count(records, "Microsoft-Windows-Sysmon/Operational")


@check("SELECT count(*) AS event_count FROM events WHERE event_type = 'no such type'")
def a2_event_count_unknown(spark, sf):
    return lq.event_count(lq.read_evtx(evtx_logs(events(spark, sf), "templated")), "No-Such-Channel")


@check(f"{EV} SELECT count(*) AS event_count FROM ev WHERE channel = 'Security' AND event_id = 4625")
def a3_failed_logons(spark, sf):
    return lq.failed_logons(lq.read_evtx(evtx_logs(events(spark, sf), "templated")))


@check(f"{EV} SELECT count(*) AS event_count FROM ev WHERE channel = 'Security' AND event_id = 4625")
def a3_failed_logons_from_logs(spark, sf):
    """The usual first question to stored logs: records of other channels and ids are not decoded."""
    folder = stored(spark, evtx_logs(events(spark, sf), "templated"))
    return lq.failed_logons_of(spark, folder)


@check(f"{EV} SELECT count(*) AS event_count FROM ev WHERE channel = 'Security' AND event_id = 4625")
def a3_failed_logons_ingested(spark, sf):
    """Same on records written to a table first: both predicates reach the Parquet scan."""
    target = scratch(spark) + "/records"
    lq.read_evtx(evtx_logs(events(spark, sf), "templated")).write.parquet(target)
    return lq.failed_logons(spark.read.parquet(target))


@check(f"{EV} SELECT path, chunk_index, record_index, record_id FROM ev")
def o1_canonical_order(spark, sf):
    ordered = lq.canonical_order(lq.read_evtx(evtx_logs(events(spark, sf), "templated")))
    return ordered.select(
        "path",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("record_index").cast("bigint").alias("record_index"),
        "record_id",
    )


@check(f"""{EV} SELECT CAST(0 AS BIGINT) AS part, count(*) AS items FROM (
    SELECT DISTINCT path FROM ev WHERE channel = 'System' UNION ALL SELECT DISTINCT path FROM ev WHERE channel = 'System')
UNION ALL SELECT 1, 2 * count(*) FROM ev""")
def u1_errors_ahead_of_records(spark, sf):
    """Errors and records as separate DataFrames; here counted in the order they are reported."""
    files = mixed_files(spark, sf)
    errors = lq.header_errors(files).select(F.lit(0).cast("bigint").alias("part"))
    records = lq.read_records(files).select(F.lit(1).cast("bigint").alias("part"))
    return errors.union(records).groupBy("part").agg(F.count("*").alias("items")).orderBy("part")


# -- streaming -------------------------------------------------------------------------------------


@check(EV_RECORDS)
def t1_stream_logs(spark, sf):
    """Files arriving in a folder, ingested by Structured Streaming; read back from its sink."""
    folder, target = stored(spark, evtx_logs(events(spark, sf), "templated")), scratch(spark)
    queries = lq.stream_logs(lq.watch_logs(spark, folder, target + "/seen"), target, target + "/checkpoint")
    for query in queries:
        query.awaitTermination()
    return plain(spark.read.parquet(target + "/records"))


@check(f"""{EV} SELECT DISTINCT replace(path, 'System.evtx', name || '.evtx') AS path, 'header' AS stage
FROM ev, (VALUES ('Cut'), ('Garbage')) t(name) WHERE channel = 'System'""")
def t1_stream_errors(spark, sf):
    folder, target = stored(spark, mixed_files(spark, sf)), scratch(spark)
    for query in lq.stream_logs(lq.watch_logs(spark, folder, target + "/seen"), target, target + "/checkpoint"):
        query.awaitTermination()
    return spark.read.parquet(target + "/errors").select(below(F.col("path")).alias("path"), "stage")


@check(ORACLES["s1_hidden_names"])
def t1_stream_hidden_names(spark, sf):
    files = evtx_logs(events(spark, sf), "templated")
    host = F.regexp_extract("path", "^/evidence/host([0-9]+)", 1).cast("int") % 3
    folder = F.when(host == 0, "/evidence/_export/").when(host == 1, "/evidence/.hidden/").otherwise("/evidence/")
    placed = files.withColumn("path", F.concat(folder, F.substring_index("path", "/evidence/", -1)))
    source, target = stored(spark, placed), scratch(spark)
    for query in lq.stream_logs(lq.watch_logs(spark, source, target + "/seen"), target, target + "/checkpoint"):
        query.awaitTermination()
    records = spark.read.parquet(target + "/records")
    return records.groupBy(below(F.col("path")).alias("path")).agg(F.count("*").alias("records"))


@check(EV_RECORDS)
def t1_stream_growing_logs(spark, sf):
    """Logs whose last chunks are written after a first run: every record arrives once. Logs are written once, in two
    parts: what they grow by waits in a folder named by its place in them."""
    base, target = scratch(spark), scratch(spark)
    folder, later = f"{base}/drop", f"{base}/later"
    logs = evtx_logs(events(spark, sf), "templated").withColumn(
        "at", F.expr("cast(4096 + 65536 * ((octet_length(content) - 4096) div 65536 div 2) as int)")
    )
    parts = logs.select(F.expr("""inline(array(
      struct('/drop' || path as path, substring(content, 1, at) as content),
      struct('/later/' || at || path as path, substring(content, at + 1) as content)))"""))

    def ingest():
        for query in lq.stream_logs(lq.watch_logs(spark, folder, target + "/seen"), target, target + "/checkpoint"):
            query.awaitTermination()

    write_files(parts, base).count()
    ingest()
    growth = lq.read_logs(spark, later).select(
        below(F.col("path")).alias("path"),
        F.regexp_extract("path", "/later/([0-9]+)/evidence/", 1).cast("int").alias("at"),
        "content",
    )
    grow_files(growth, folder).count()
    ingest()
    return plain(spark.read.parquet(target + "/records"))
