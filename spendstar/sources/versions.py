"""Versioned warehouse folders: a rebuild becomes visible in one step.

Every load writes all its tables into a folder of its own under
``<root>/versions/``.  Only when the last table is complete does ``commit``
put a new manifest in the place of the old one, by one rename (atomic on HDFS
and local file systems; on an object store use a committer or a catalog whose
single-object put is atomic).  Readers resolve the tables through the
manifest, so they see the old load or the new one, never a mixture, and a load
that dies leaves the old one in place.  Old versions stay readable until
``expire`` removes them.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

MANIFEST = "CURRENT.json"
FOLDER = "versions"


class NoWarehouseError(FileNotFoundError):
    """The folder holds no committed load."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def new_version(root: str) -> str:
    """The name of a version folder that no other load uses; names sort by time."""
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


def version_path(root: str, version: str) -> str:
    return _join(root, FOLDER, version)


def commit(spark: SparkSession, root: str, version: str, content: dict) -> dict:
    """Make ``version`` the current load of ``root``; returns the manifest."""
    manifest = dict(content, version=version)
    fs, temp = _path(spark, _join(root, f".{MANIFEST}.{version}"))
    out = fs.create(temp, True)
    try:
        out.write(bytearray(json.dumps(manifest, indent=1, sort_keys=True).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = fs.makeQualified(_path(spark, _join(root, MANIFEST))[1])
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(temp), target, options)
    return manifest


def current(spark: SparkSession, root: str) -> dict:
    """The manifest of the current load."""
    fs, path = _path(spark, _join(root, MANIFEST))
    if not fs.exists(path):
        raise NoWarehouseError(f"no committed load in {root} ({MANIFEST} is missing)")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[str]:
    """All version folders, oldest first, committed or not."""
    fs, path = _path(spark, _join(root, FOLDER))
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all version folders but the current one and the ``keep - 1``
    newest others; returns the removed names.  Run it when no load is running:
    an unfinished load's folder is a version too."""
    now = current(spark, root)["version"]
    others = [v for v in versions(spark, root) if v != now]
    gone = others[:max(0, len(others) - max(0, keep - 1))]
    for v in gone:
        fs, path = _path(spark, version_path(root, v))
        fs.delete(path, True)
    return gone
