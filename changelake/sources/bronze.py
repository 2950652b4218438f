"""Reading raw change logs from Parquet.

A raw table directory holds one full-load file at the top plus change files in
dated sub-folders (``YYYY/MM/DD/...``). A plain ``spark.read.parquet(dir)``
only lists the top level, so the reader always walks the tree
(``recursiveFileLookup``) and only takes ``*.parquet`` files (``_SUCCESS``
markers and other droppings are skipped).

Files are read under an explicit schema; ``check_schema`` compares every file's
footer with that schema first, because a column missing from some files would
otherwise read silently as NULL.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schema_diff import schema_drift_rows, DriftError

# The footer reader travels by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_bronze(spark: SparkSession, path: str | Sequence[str], schema: StructType, *,
                recursive: bool = True, glob: str = "*.parquet",
                check_schema: str = "off") -> DataFrame:
    """Typed scan of one raw table directory (all nested files), or of listed files.

    ``check_schema``: ``off`` | ``warn`` | ``error`` -- compare each file's
    layout with ``schema`` before reading.
    """
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if check_schema != "off":
        check_layouts(spark, path, schema, check_schema, recursive=recursive, glob=glob)
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*map(_literal, path))


def _literal(path: str) -> str:
    """A listed file's path, its wildcard characters taken as they are."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def check_layouts(spark: SparkSession, path: str | Sequence[str], schema: StructType, on_drift: str = "error",
                  **kw) -> int:
    """Compare every file's layout with ``schema``; a missing or retyped column
    raises ``DriftError`` (``error``) or is logged (``warn``). Returns the rows
    that the footers name: exact, however often tasks were run."""
    layouts = file_schemas(spark, path, **kw).collect()   # distinct layouts, not files
    problems = [r for r in _drift(layouts, schema) if r["status"] in ("missing", "retyped")]
    if problems and on_drift == "error":
        raise DriftError(path, problems)
    if problems:
        import logging
        logging.getLogger(__name__).warning("schema drift in %s: %s", path, problems)
    return sum(r["rows"] for r in layouts)


def list_files(spark: SparkSession, path: str | Sequence[str], *, recursive: bool = True,
               glob: str = "*.parquet") -> DataFrame:
    """(path, modified, bytes) of every file under ``path``; no content is read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path = path if isinstance(path, str) else [_literal(p) for p in path]
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def file_schemas(spark: SparkSession, path: str | Sequence[str], *, recursive: bool = True,
                 glob: str = "*.parquet") -> DataFrame:
    """(schema, files, rows): the distinct file layouts under ``path``, as JSON,
    with how many files and rows have each.

    Executors list the files and read each one's footer by range requests: its
    length, its last bytes, then the footer itself. Only the distinct layouts ever
    reach the driver. Schemes without a file system here raise ``ValueError``.
    """
    files = list_files(spark, path, recursive=recursive, glob=glob).select("path")
    first = files.first()
    if first is not None:
        open_store(first.path, options := store_options(spark))   # fails here, not in a task
    else:
        options = {}

    def read(batches):
        return _read_footers(batches, options)

    return (files.mapInPandas(read, "schema string, rows bigint").groupBy("schema")
            .agg(F.count("*").alias("files"), F.sum("rows").alias("rows")))


#: Settings of the object stores that executors need to read by range.
_STORE_SETTINGS = ("fs.s3a.endpoint", "fs.s3a.endpoint.region", "fs.s3a.access.key", "fs.s3a.secret.key",
                   "fs.s3a.session.token")


def store_options(spark: SparkSession) -> dict[str, str]:
    """The session's object-store settings that are set."""
    conf = spark._jsc.hadoopConfiguration()
    return {k: v for k in _STORE_SETTINGS if (v := conf.get(k))}


def split_uri(uri: str) -> tuple[str, str, str]:
    """(scheme, authority, path) of a path as Hadoop prints it: nothing in it is
    percent-encoded, and ``#`` or ``?`` belong to names."""
    scheme, authority, place = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)", uri).groups("")
    return scheme.lower(), authority, place


def store_path(uri: str) -> str:
    """Where a file lies in its store: bucket or container first, if it has one."""
    scheme, authority, place = split_uri(uri)
    return place if scheme in ("", "file", "hdfs") else authority.partition("@")[0] + place


def open_store(uri: str, options: Mapping[str, str] | None = None):
    """(file system, path in it) for a file's URI, by its scheme:

    file, hdfs      the local disk and HDFS
    s3a, s3n, s3    an S3 store, with the session's endpoint, region and keys
    abfss, abfs     an Azure container, ``container@account.host``
    gs              a Google bucket
    """
    import pyarrow.fs as pafs

    options = options or {}
    scheme, authority, _ = split_uri(uri)
    place = store_path(uri)
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), place
    if scheme == "hdfs":
        return pafs.HadoopFileSystem(authority.split(":")[0] or "default", int(authority.partition(":")[2] or 0)), place
    if scheme in ("s3a", "s3n", "s3"):
        given = {"endpoint_override": options.get("fs.s3a.endpoint"), "region": options.get("fs.s3a.endpoint.region"),
                 "access_key": options.get("fs.s3a.access.key"), "secret_key": options.get("fs.s3a.secret.key"),
                 "session_token": options.get("fs.s3a.session.token")}
        return pafs.S3FileSystem(**{k: v for k, v in given.items() if v}), place
    if scheme in ("abfss", "abfs"):
        container, _, host = authority.partition("@")
        return pafs.AzureFileSystem(account_name=host.split(".")[0]), place
    if scheme == "gs":
        return pafs.GcsFileSystem(), place
    raise ValueError(f"cannot read footers from {scheme}://; check_schema='off' skips them")


def _read_footers(batches, options):
    import pandas as pd
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    stores = {}
    for pdf in batches:
        out = []
        for name in pdf["path"]:
            root = "/".join(name.split("/")[:3]) if "://" in name else name.split("/")[0]
            if root not in stores:
                stores[root] = open_store(name, options)[0]
            fs, place = stores[root], store_path(name)
            with fs.open_input_file(place) as source:
                f = pq.ParquetFile(source)
                out.append((from_arrow_schema(f.schema_arrow, prefer_timestamp_ntz=True).json(), f.metadata.num_rows))
        yield pd.DataFrame(out, columns=["schema", "rows"])


def footer_drift(spark: SparkSession, path: str, expected: StructType, **kw) -> list[dict]:
    """Drift rows over all file layouts: (column_name, expected_type,
    actual_type, status, files, rows), one per column and way of drifting."""
    return _drift(file_schemas(spark, path, **kw).collect(), expected)   # distinct layouts, not files


def _drift(layouts, expected: StructType) -> list[dict]:
    total: dict[tuple, list[int]] = {}
    for layout in layouts:
        actual = StructType.fromJson(json.loads(layout["schema"]))
        for r in schema_drift_rows(expected, actual):
            key = (r["column_name"], r["expected_type"], r["actual_type"], r["status"])
            seen = total.setdefault(key, [0, 0])
            seen[0] += layout["files"]
            seen[1] += layout["rows"]
    names = ("column_name", "expected_type", "actual_type", "status", "files", "rows")
    return [dict(zip(names, (*k, *v))) for k, v in sorted(total.items(), key=str)]
