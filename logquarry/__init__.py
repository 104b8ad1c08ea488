"""Windows event logs as Spark DataFrames: distributed reading, record operators, audit."""

from .operators.audit import audit_slots, audit_stored, evt_audit, log_audit
from .operators.enrich import (
    artifact_of,
    classify_channel,
    enrich,
    mismatched_attribution,
    with_provenance,
)
from .operators.mapping import (
    map_event,
    map_event_data,
    map_evt,
    map_system,
    map_user_data,
    typed_value,
)
from .operators.query import (
    canonical_order,
    channels,
    channels_per_log,
    count_matching,
    event_count,
    failed_logons,
    query,
    query_all,
)
from .plans.ingest import (
    collect_evidence,
    collect_logs,
    count_in_logs,
    failed_logons_of,
    failures_of,
    ingest_logs,
    log_files_union,
    read_errors,
    read_evt,
    read_evtx,
    read_records,
    read_stored_records,
    records_of,
    records_of_chunks,
    scan_logs,
    tagged_records,
)
from .plans.index import bytes_of, index_logs, indexed_ranges, scan_indexed
from .sources.catalog import bodies_of_evidence, default_catalog, expand_patterns, locate_logs
from .sources.decode import chunk_totals, decode_chunks, decode_evt, decode_units, frame_chunks
from .sources.files import (
    detect_format,
    heads_of,
    list_logs,
    list_roots,
    read_chunks,
    read_heads,
    read_logs,
    split_chunks,
    task_count,
    with_channel,
)
from .sources.headers import (
    chunk_headers,
    evt_log_headers,
    evtx_errors,
    examine,
    evtx_log_headers,
    flag_integrity,
    header_errors,
    log_units,
    skip_unwritten,
)
from .sources.units import Wanted, log_ranges, read_units
from .streaming.ingest import stream_logs, watch_logs

__all__ = [name for name in dir() if not name.startswith("_")]
