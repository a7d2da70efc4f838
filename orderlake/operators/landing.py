"""Landing gate: S8, J4, J5, Q3–Q7, K6, K7, Q14.

The file listing is a DataFrame (``binaryFile`` with the ``content`` column
pruned, so no bytes travel in rows). Files known by place, size and time are
not read again, so a run reads what landed since the last one.

The registry keeps every version of a path. A path's newest version counts:
corrected bytes supersede the former ones, faulty bytes withdraw the path until
it is good again. A content (MD5) is handed to readers once, from the path that
brought it first, or another that holds it when that one has changed.

The only Python
step is a ``mapInPandas`` that, per file and on the executor, hashes the bytes
in chunks and reads the Parquet footer. Routing, duplicate detection and the
contract check are DataFrame expressions and joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import (COLUMN_ALIASES, CONTRACT_PARQUET_TYPES, FILE_TYPE_RULES, REGISTRY_SCHEMA, REQUIRED_COLUMNS,
                       VERSIONS_SCHEMA)
from ..sinks import parquet as sink

INSPECT_SCHEMA = ("path string, md5 string, columns array<string>, "
                  "physical map<string,string>, read_error string, io_error string")
# Hadoop names of schemes that the file reader knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
CHUNK = 8 * 1024 * 1024


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """S8 listing: every file below ``root`` (path, length, modification
    time); ``content`` is never selected, so it is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))


def _inspect_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per file: chunked MD5 of the bytes and the footer's column names and
    physical types. Runs inside executor tasks. Bytes that can't be fetched
    are an ``io_error`` (the file is left for the next run); bytes that are no
    Parquet file are a ``read_error`` (Q4)."""
    import hashlib

    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            md5, cols, phys, err, io_err = None, None, None, None, None
            try:
                scheme, colon, rest = path.partition(":")
                fs, p = pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)
                h = hashlib.md5()
                with fs.open_input_stream(p) as f:
                    while chunk := f.read(CHUNK):
                        h.update(chunk)
                md5 = h.hexdigest()
                f = fs.open_input_file(p)
            except Exception as exc:  # noqa: BLE001 - reported, retried by the next run
                io_err = f"{type(exc).__name__}: {exc}"
            else:
                try:
                    with f:
                        pf = pq.ParquetFile(f)
                        cols = list(pf.schema_arrow.names)
                        phys = {pf.schema.column(i).path.split(".")[0]: pf.schema.column(i).physical_type
                                for i in range(len(pf.schema))}
                except Exception as exc:  # noqa: BLE001 - becomes the quarantine reason (Q4)
                    err = f"unreadable Parquet footer: {exc}"
            rows.append((path, md5, cols, phys, err, io_err))
        yield pd.DataFrame(rows, columns=["path", "md5", "columns", "physical", "read_error", "io_error"])


def detect_file_type(rel_path: Column) -> Column:
    """Q5: first matching path segment wins (H21: segments, not substrings)."""
    p = F.concat(F.lit("/"), F.lower(rel_path))
    expr = None
    for needle, ftype in FILE_TYPE_RULES:
        cond = p.contains("/" + needle)
        expr = F.when(cond, F.lit(ftype)) if expr is None else expr.when(cond, F.lit(ftype))
    return expr.otherwise(F.lit(None).cast("string"))


def _contract_array(ftype: Column, table: dict[str, Sequence[str]]) -> Column:
    expr = None
    for t, cols in table.items():
        arr = F.array(*[F.lit(c) for c in cols])
        expr = F.when(ftype == t, arr) if expr is None else expr.when(ftype == t, arr)
    return expr.otherwise(F.array().cast("array<string>"))


def _canonical(columns: Column) -> Column:
    """Column names with transition aliases replaced by contract names."""
    names = {a: c for c, aliases in COLUMN_ALIASES.items() for a in aliases}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform(columns, lambda c: F.coalesce(F.element_at(known, c), c))


def _type_fault(file_type: Column) -> Column:
    """The first contract column whose physical type differs, as a reason."""
    expected = F.create_map(*[x for t, m in CONTRACT_PARQUET_TYPES.items()
                              for c, pt in m.items() for x in (F.lit(f"{t}.{c}"), F.lit(pt))])

    def want(c):
        return F.element_at(expected, F.concat(file_type, F.lit("."), c))
    bad = F.get(F.array_sort(F.filter(F.map_keys("physical"), lambda c: (
        want(c).isNotNull() & (want(c) != F.element_at(F.col("physical"), c))))), 0)
    return F.when(bad.isNotNull(), F.concat(
        F.lit("Column '"), bad, F.lit("' has physical type "), F.element_at(F.col("physical"), bad),
        F.lit(", expected "), want(bad)))


def landing_decisions(spark: SparkSession, listing: DataFrame, root: str,
                      registry: DataFrame | None = None,
                      run_ts: datetime | str | None = None,
                      required: dict[str, Sequence[str]] = REQUIRED_COLUMNS,
                      check_types: bool = False, known: DataFrame | None = None) -> DataFrame:
    """T1 core: one decision row per Parquet file in ``listing``.

    status: ``validated`` | ``quarantined`` | ``duplicate`` | ``retry``.
    Validity is decided first. Of the valid files, those are duplicates whose
    bytes (MD5) were validated before under another path (``registry``: its
    versions) or occur under an earlier path in this batch; a wrong copy never
    claims a hash (H20), and a path that gets former bytes of its own back is
    validated. Quarantined files are checked again on re-drop. A file whose
    bytes could not be fetched is ``retry``: neither quarantined nor
    registered. Files in ``known`` (same path, size and time) are duplicates
    without being read; ``was_read`` tells. ``check_types`` also compares
    footer physical types (H11).
    """
    prefix = root.rstrip("/") + "/"
    files = listing.where(F.lower("path").endswith(".parquet"))          # Q6
    rel = F.regexp_replace("path", r"^.*?" + _escape_tail(prefix), "")
    files = files.withColumn("filename", rel).withColumn("file_type", detect_file_type(rel))
    same = ["path", "length", "modificationTime"]
    unread = files if known is None else files.join(known.select(*same).distinct(), same, "left_anti")
    inspected = unread.select("path").mapInPandas(_inspect_files, INSPECT_SCHEMA)
    d = unread.join(inspected, "path", "left")

    # Required columns absent from the footer; the first one is named.
    have = F.coalesce(_canonical(F.col("columns")), F.array().cast("array<string>"))
    missing = F.get(F.array_except(_contract_array(F.col("file_type"), required), have), 0)
    # fixed values: the reason texts are part of the quarantine contract
    fault = (F.when(F.col("file_type").isNull(), F.lit("Could not determine file type from path"))
              .when(F.col("read_error").isNotNull(), F.col("read_error"))
              .when(missing.isNotNull(), F.concat(F.lit("Required column '"), missing, F.lit("' missing from "),
                                                  F.col("file_type"), F.lit(" file"))))
    if check_types:
        fault = F.coalesce(fault, _type_fault(F.col("file_type")))
    d = d.withColumn("failure_reason", F.coalesce("io_error", fault))
    # The path that brought a content first, or else its first path here; faulty files stand alone
    content = F.when(F.col("failure_reason").isNull(), F.col("md5")).otherwise(F.concat(F.lit("path:"), "path"))
    d = d.withColumn("_content", content)
    if registry is not None:
        d = d.join(_owners(registry).select(F.col("md5").alias("_content"), F.col("owner").alias("_owner")), "_content", "left")
    else:
        d = d.withColumn("_owner", F.lit(None).cast("string"))
    first = F.min("path").over(Window.partitionBy("_content"))
    d = d.withColumn("_first", F.coalesce("_owner", first))
    status = (F.when(F.col("io_error").isNotNull(), F.lit("retry"))
               .when(F.col("failure_reason").isNotNull(), F.lit("quarantined"))
               .when(F.col("path") != F.col("_first"), F.lit("duplicate"))
               .otherwise(F.lit("validated")))
    ts = F.lit(str(run_ts)).cast("timestamp") if run_ts is not None else F.current_timestamp()
    cols = ["path", "filename", "file_type", "length", "modificationTime", "md5"]
    out = d.select(*cols, status.alias("status"), "failure_reason", F.lit(True).alias("was_read"))
    if known is not None:
        hit = files.join(known.select(*same, "md5").dropDuplicates(same), same)
        out = out.unionByName(hit.select(*cols, F.lit("duplicate").alias("status"),
                                         F.lit(None).cast("string").alias("failure_reason"),
                                         F.lit(False).alias("was_read")))
    return out.withColumns({"first_seen_at": ts, "processed_at": ts})


def _escape_tail(prefix: str) -> str:
    """Regex for the listing root, tolerant of the scheme form Spark adds
    (``file:/x`` vs ``/x``)."""
    import re
    tail = prefix.split(":", 1)[1] if ":" in prefix.split("/", 1)[0] else prefix
    return re.escape(tail.lstrip("/"))


def registry_rows(decisions: DataFrame) -> DataFrame:
    """K6: what a run tells the registry: the version of every path it has read."""
    return decisions.where(F.col("status").isin("validated", "duplicate", "quarantined") & F.col("md5").isNotNull()
                           & F.col("was_read")).select(*VERSIONS_SCHEMA.fieldNames())


def one_per_content(versions: DataFrame) -> DataFrame:
    """K6: one row per MD5 of a known type: first seen and last processed over
    all its versions, the rest from its validated one, or else from the newest."""
    best = F.max_by(F.struct("path", "filename", "file_type", "status", "failure_reason"),
                    F.struct(F.col("status") == "validated", "processed_at", "path"))
    one = versions.where(F.col("status").isin("validated", "quarantined") & F.col("file_type").isNotNull()).groupBy("md5").agg(
        best.alias("b"), F.min("first_seen_at").alias("first_seen_at"), F.max("processed_at").alias("processed_at"))
    return one.select("md5", "b.*", "first_seen_at", "processed_at").select(*REGISTRY_SCHEMA.fieldNames())


def _owners(versions: DataFrame) -> DataFrame:
    """md5, owner: the path that a content was validated under first."""
    return versions.where(F.col("status") == "validated").groupBy("md5").agg(
        F.min_by("path", F.struct("processed_at", "path")).alias("owner"))


def current_versions(versions: DataFrame) -> DataFrame:
    """The newest version of each path."""
    row = F.struct(*VERSIONS_SCHEMA.fieldNames())
    newest = F.max_by(row, F.struct("processed_at", "modificationTime", "md5"))
    return versions.groupBy("path").agg(newest.alias("v")).select("v.*")


def known_files(versions: DataFrame) -> DataFrame:
    """Good current versions: their bytes need not be read again."""
    return current_versions(versions).where(F.col("status").isin("validated", "duplicate"))


def read_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry's versions, or None before its first row."""
    if not sink.path_exists(spark, path):
        return None
    return spark.read.schema(VERSIONS_SCHEMA).parquet(path)


def read_table(spark: SparkSession, path: str, schema=REGISTRY_SCHEMA) -> DataFrame | None:
    """The registry by content (K6), or None before its first row."""
    versions = read_versions(spark, path)
    return None if versions is None else one_per_content(versions).select(*schema.fieldNames())


def update_registry(spark: SparkSession, registry_path: str, decisions: DataFrame) -> None:
    """K6: appends the versions that differ from what the registry has as
    their path's current one. Everything read from it is a least or newest
    row, so a retry that appends again changes nothing."""
    new = registry_rows(decisions)
    versions = read_versions(spark, registry_path)
    if versions is not None:
        same = ["path", "md5", "length", "modificationTime"]
        bad = F.col("status") == "quarantined"
        now = current_versions(versions).select(*same, bad.alias("_bad"))
        new = new.withColumn("_bad", bad).join(now, [*same, "_bad"], "left_anti").drop("_bad")
    new.hint("rebalance").write.mode("append").parquet(registry_path)


def manifest(versions: DataFrame, file_type: str | None = None) -> DataFrame:
    """K7: the paths readers may consume (no bytes are copied): each good
    content once, from its owner if that still holds it, else from its least path."""
    good = known_files(versions).where(F.col("file_type").isNotNull())
    if file_type is not None:
        good = good.where(F.col("file_type") == file_type)
    at = good.join(_owners(versions), "md5").groupBy("md5", "file_type").agg(
        F.min_by("path", F.struct(F.col("path") != F.col("owner"), "path")).alias("path"))
    return at.select("path", "file_type")


def manifest_paths(spark: SparkSession, registry_path: str, file_type: str, dates) -> dict[str, list[str]]:
    """K7: validated files by the date in their name (``{type}_{date}.parquet``,
    a file or a folder of part files). For ``dates`` None: the files of each
    drop below ``segments/`` by its name, and those of the newest under the key
    ``latest``. The names of the asked dates only come to the driver."""
    versions = read_versions(spark, registry_path)
    if versions is None:
        return {}
    files = manifest(versions, file_type)
    if dates is None:
        drop = F.regexp_extract("path", r"segments/([^/]+)", 1)
        files = files.withColumn("drop", F.when(drop.startswith("part-"), F.lit("")).otherwise(drop))
        drops: dict[str, list[str]] = {}
        for r in files.collect():
            drops.setdefault(r["drop"], []).append(r["path"])
        drops = {d: sorted(p) for d, p in drops.items()}
        return {**drops, "latest": drops[max(drops)]} if drops else {}
    day = F.regexp_extract("path", file_type + r"_(\d{4}-\d{2}-\d{2})\.parquet", 1)
    out: dict[str, list[str]] = {}
    for r in files.withColumn("day", day).where(F.col("day").isin([str(d) for d in dates])).collect():
        out.setdefault(r["day"], []).append(r["path"])
    return {d: sorted(p) for d, p in out.items()}


def inputs_present(versions: DataFrame | None, needed: Sequence[str] = ("orders", "events", "user_segments"),
                   run_date=None) -> dict[str, int]:
    """Q14 (H22 fix): files per needed type in the registry's manifest, so a
    repeated run finds what an earlier one validated, and not what a faulty
    re-drop has withdrawn. With ``run_date`` orders and events count only under
    that date's name."""
    if versions is None:
        return {t: 0 for t in needed}
    m = manifest(versions)
    if run_date is not None:
        m = m.where((F.col("file_type") == "user_segments") | F.col("path").contains(f"_{run_date}.parquet"))
    counts = {r["file_type"]: r["n"] for r in m.groupBy("file_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {t: int(counts.get(t, 0)) for t in needed}
