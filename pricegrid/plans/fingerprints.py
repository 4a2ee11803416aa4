"""Digests that tell whether a finished stage is the one a run would make.

A stage's digest covers its settings, the source of the modules that compute it
and the digests of its input stages; that of the first stage also covers the
given frames. Frames that read files only are told by their plan and the path,
size and time of every file; any other frame by its rows, counted and summed as
row hashes in one pass, whatever their order.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_LEAVES = ("LogicalRelation", "DataSourceV2Relation")
NAME = "_fingerprint"


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps([canonical(p) for p in parts]).encode()).hexdigest()


def canonical(value):
    """Settings as JSON values: mappings and sets in order, data classes by field."""
    if is_dataclass(value):
        return canonical(asdict(value))
    if isinstance(value, dict):
        return {"mapping": sorted(([str(k), canonical(v)] for k, v in value.items()), key=lambda item: item[0])}
    if isinstance(value, (set, frozenset)):
        return sorted((canonical(v) for v in value), key=str)
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return value if isinstance(value, (str, int, float, bool, type(None))) else repr(value)


def code(*modules) -> str:
    """Version of some modules: a digest of their source."""
    return digest(*[inspect.getsource(m) for m in modules])


def rows_digest(df: DataFrame) -> str:
    """Digest of a frame's columns and rows in any order, copies included."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    other = F.xxhash64(F.lit("other"), *[F.col(f"`{c}`") for c in df.columns])
    found = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.sum(other.cast("decimal(38,0)"))).first()
    return digest(df.schema.json(), *[str(v) for v in found])


def frame_digest(df: DataFrame) -> str:
    """Digest of what a frame would give."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    kinds = [leaves.apply(k).getClass().getSimpleName() for k in range(leaves.size())]
    if not all(kind in FILE_LEAVES for kind in kinds) or not plan.deterministic():
        return rows_digest(df)
    # Running numbers of columns and lambda variables differ from build to build.
    text = re.sub(r"\b([a-z]+)_\d+\b", r"\1", re.sub(r"#\d+L?", "", plan.toString()))
    conf, files = spark._jsc.hadoopConfiguration(), []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        files.append((name, status.getLen(), status.getModificationTime()))
    return digest(text, df.schema.json(), files)


def read(spark, folder):
    """The digest kept with a finished table, None without one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{NAME}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    stream = fs.open(path)  # Spark's readers pass over names with an underscore
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write(spark, folder, value):
    """Keep the digest with a table; overwriting the table removes it first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{NAME}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(value.encode()))
    finally:
        out.close()
