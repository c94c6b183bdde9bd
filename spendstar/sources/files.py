"""What a file's first bytes say: its encoding and its line ending.

A listing job names the files; the driver reads at most ``HEAD`` bytes of each
through the file system the path names (any that Hadoop knows), of a compressed
file the first bytes of its text.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

HEAD = 64 * 1024
# --- fixed values: byte-order marks, longest first ---------------------------
MARKS = (
    (b"\xff\xfe\x00\x00", "UTF-32LE"),
    (b"\x00\x00\xfe\xff", "UTF-32BE"),
    (b"\xef\xbb\xbf", "UTF-8"),
    (b"\xff\xfe", "UTF-16LE"),
    (b"\xfe\xff", "UTF-16BE"),
)


def listed(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def files_of(spark: SparkSession, paths: str | Iterable[str]) -> list[tuple[str, int]]:
    """(path, length) of every file, by path; contents are not read."""
    rows = spark.read.format("binaryFile").load(listed(paths)).select("path", "length").collect()
    return sorted((r.path, r.length) for r in rows)


def head(spark: SparkSession, path: str, length: int) -> bytes:
    """The first bytes of a file, ``HEAD`` at most; a compressed one is unpacked."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    stream = p.getFileSystem(conf).open(p)
    try:
        io = jvm.org.apache.commons.io
        if codec is None:
            return bytes(io.IOUtils.toByteArray(stream, min(length, HEAD)))
        stream = codec.createInputStream(stream)
        return bytes(io.IOUtils.toByteArray(io.input.BoundedInputStream(stream, HEAD)))
    finally:
        stream.close()


def encoding_of(start: bytes, default: str = "UTF-8") -> str:
    """The encoding that a byte-order mark names; ``default`` without one."""
    for mark, name in MARKS:
        if start.startswith(mark):
            return name
    return default


def line_ending_of(start: bytes, encoding: str, default: str = "\n") -> str:
    r"""The first line's ending: ``\r\n``, ``\n``, or ``\r`` where no ``\n`` is seen.

    So a lone carriage return inside a field is data in a file whose lines end
    otherwise.  ``default`` if no line ends within the head.
    """
    text = start.decode(encoding, errors="ignore")
    feed = text.find("\n")
    if feed > 0 and text[feed - 1] == "\r":
        return "\r\n"
    if feed >= 0:
        return "\n"
    return "\r" if "\r" in text else default


def sniff(spark: SparkSession, paths: str | Iterable[str], encoding: str | None = None,
          line_sep: str | None = None) -> dict[tuple[str, str], list[str]]:
    """Files by (encoding, line ending); a given value is taken for all files."""
    found = files_of(spark, paths)
    if encoding and line_sep:
        return {(encoding, line_sep): [p for p, _ in found]} if found else {}

    def kind(file: tuple[str, int]) -> tuple[str, str]:
        start = head(spark, *file) if file[1] else b""
        name = encoding or encoding_of(start)
        return name, line_sep or line_ending_of(start, name)

    out: dict[tuple[str, str], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for (path, _), k in zip(found, pool.map(kind, found)):
            out.setdefault(k, []).append(path)
    return out
