"""Finding logs through a catalog of named definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import base_name

_ROOT_TOKEN = "%%environ_systemroot%%"
_BROADCAST_PATTERNS, _BROADCAST_BYTES = 10_000, 8 << 20
_LOGS = _ROOT_TOKEN + r"\System32\winevt\Logs" + "\\"

# The definitions that name modern event logs, in reading order, and their files.
DEFINITIONS = {
    "WindowsXMLEventLogApplication": ["Application.evtx"],
    "WindowsXMLEventLogPowerShell": [
        "Microsoft-Windows-PowerShell%4Operational.evtx",
        "Windows PowerShell.evtx",
    ],
    "WindowsXMLEventLogSecurity": ["Security.evtx"],
    "WindowsXMLEventLogSysmon": ["Microsoft-Windows-Sysmon%4Operational.evtx"],
    "WindowsXMLEventLogSystem": ["System.evtx"],
    "WindowsXMLEventLogTerminalServices": [
        "Microsoft-Windows-TerminalServices-LocalSessionManager%4Operational.evtx"
    ],
}


def default_catalog(spark: SparkSession) -> DataFrame:
    """(definition, pattern): where Windows keeps the logs named above."""
    rows = [(name, _LOGS + file) for name, files in DEFINITIONS.items() for file in files]
    return spark.createDataFrame(rows, "definition string, pattern string")


def root_folder(system_root: Column) -> Column:
    """A host's system root as part of a location: lower-case, without its drive; empty where it isn't known."""
    plain = F.translate(F.lower(F.coalesce(system_root, F.lit(""))), "\\", "/")
    return F.trim(F.regexp_replace(plain, "^[a-z]:", ""), F.lit("/"))


def expand_patterns(
    catalog: DataFrame, system_root: str | None = None, by_host: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Catalog with ``location`` (lower-case ``/`` path suffix), and errors for what stays unresolved.

    The system root token becomes the host's folder without its drive. Without a known one the
    location matches below any root. With ``by_host`` the token stays, for ``locate_logs`` to put each host's own in.
    """
    plain = F.translate(F.lower("pattern"), "\\", "/")
    resolved = plain if by_host else F.replace(plain, F.lit(_ROOT_TOKEN), root_folder(F.lit(system_root)))
    location = F.ltrim(F.regexp_replace(resolved, "^[a-z]:", ""), F.lit("/"))
    expanded = catalog.withColumn("location", location)
    unresolved = F.replace(F.col("location"), F.lit(_ROOT_TOKEN if by_host else ""), F.lit("")).rlike("%%[^%]+%%")
    errors = expanded.where(unresolved).select(
        F.lit(None).cast("string").alias("path"),
        F.lit("locate").alias("stage"),
        F.concat("definition", F.lit(": source "), "pattern", F.lit(" was not searched: unresolved token")).alias("message"),
    )
    return expanded.where(~unresolved), errors


def _is_small(patterns: DataFrame) -> bool:
    """Whether rows and bytes stay within what every executor can hold without notice."""
    width = sum((F.octet_length(column) for column in patterns.columns), F.lit(0))
    probe = patterns.limit(_BROADCAST_PATTERNS + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return probe.rows <= _BROADCAST_PATTERNS and probe.bytes <= _BROADCAST_BYTES


def bodies_of_evidence(listing: DataFrame, bodies: DataFrame) -> DataFrame:
    """Adds ``host`` and ``system_root`` of the body of evidence a file belongs to: of ``bodies(root, host, system_root)``
    the one with the longest root that the path lies below. Files below none are left out.

    A path is joined by each of its folders, so nested roots and any number of bodies need no comparison of pairs.
    """
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    found = listing.select("path", F.explode(above).alias("root")).join(
        bodies.select(F.rtrim(F.col("root"), F.lit("/")).alias("root"), "host", "system_root"), "root"
    )
    longest = F.max(F.struct(F.length("root").alias("n"), "host", "system_root")).alias("body")
    found = found.groupBy("path").agg(longest).select("path", "body.host", "body.system_root")
    return listing.join(found, "path")


def locate_logs(
    listing: DataFrame, catalog: DataFrame, evidence: Column | None = None, system_root: Column | None = None
) -> DataFrame:
    """Listing rows some definition names, with ``definition`` and ``located_by``.

    ``catalog`` comes from ``expand_patterns``. A definition's logs are taken from its locations; in
    a body of evidence that has none of them, by the file names the locations end in. ``evidence``
    tells the bodies of evidence apart (default: the listing is one); ``system_root`` is the one of each, where the
    catalog was expanded ``by_host``. Each path appears once, for
    the first definition by name. The catalog joins by file name, so no pair of rows is compared
    without a common name. It is broadcast if it is known to be small; a larger one is shuffled.
    """
    patterns = catalog.select(
        "definition", "location", F.substring_index("location", "/", -1).alias("_name")
    )
    small = _is_small(patterns)
    if small:
        patterns = F.broadcast(patterns)
    lowered = F.translate(F.lower("path"), "\\", "/")
    carried = [c for c in listing.columns if c != "path"]
    named = listing.select(
        "path",
        F.struct(*carried, F.lit(True).alias("_listed")).alias("_file"),
        (evidence if evidence is not None else F.lit("")).alias("_evidence"),
        F.lower(base_name(F.col("path"))).alias("_name"),
        F.concat(F.lit("/"), F.ltrim(lowered, F.lit("/"))).alias("_lower"),
        root_folder(system_root if system_root is not None else F.lit(None)).alias("_root"),
    )
    # The folder may be empty: then what follows it begins the location.
    location = f"ltrim('/', replace(location, '{_ROOT_TOKEN}', _root))"
    matches = named.join(patterns, "_name").select(
        "path",
        "_file",
        "_evidence",
        "definition",
        F.expr(f"endswith(_lower, concat('/', {location}))").alias("_at_location"),
    )
    placed = matches.where("_at_location").select("_evidence", "definition").distinct()
    placed = placed.withColumn("_placed", F.lit(True))
    if small and evidence is None:  # then there are no more of them than patterns
        placed = F.broadcast(placed)
    kept = matches.join(placed, ["_evidence", "definition"], "left").where(
        "_at_location or _placed is null"
    )
    # From here on only files some definition names are left; the rest is never shuffled.
    located_by = F.expr("if(_at_location, 'location', 'file_name')").alias("located_by")
    first = kept.groupBy("path").agg(
        F.min(F.struct("definition", F.expr("not _at_location").alias("_by_name"), located_by)).alias("_first"),
        F.max("_file").alias("_file"),
    )
    return first.select("path", *[F.col(f"_file.{c}") for c in carried], "_first.definition", "_first.located_by")
