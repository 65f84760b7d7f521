"""Large single files spread over tasks: members of zip archives (S4), records of a JSON array.

Spark gives such a file to one task, and ``binaryFile`` cannot hold more than 2 GB.  Here the driver's plan knows only
paths and lengths (file listing reads no content); tasks open the file themselves and read the ranges they need.  Python
workers reach storage through ``pyarrow.fs`` (local, HDFS, S3, GCS), never through the driver.

Defined cases: an empty file, an archive without matching members and an empty array give no rows.
"""

from __future__ import annotations

import fnmatch
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 10_000
BLOCK_BYTES = 32 << 20
READ_BYTES = 1 << 20


def files_of(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, length) of the files at ``path`` whose name matches; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")


def _open(path: str):
    """A seekable file; only the ranges asked for are read."""
    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(name)


def archive_members(spark: SparkSession, path: str, member_glob: str = "*.csv") -> DataFrame:
    """(path, member, bytes): one row per matching member, from the central directory at each archive's end."""
    def names(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for p in pdf["path"]:
                with _open(p) as raw, zipfile.ZipFile(raw) as z:
                    rows = [(p, m.filename, m.compress_size) for m in z.infolist() if fnmatch.fnmatch(m.filename, member_glob)]
                yield pd.DataFrame(rows, columns=["path", "member", "bytes"])

    return files_of(spark, path, "*.zip").mapInPandas(names, "path string, member string, bytes bigint")


def read_archive_members(spark: SparkSession, path: str, schema: str | T.StructType, member_glob: str = "*.csv",
                         fmt: str = "csv") -> DataFrame:
    """Rows of the CSV/Parquet members of zip archives at ``path``.

    Members, not archives, are spread over the tasks (repeated names in one archive: the last one, as zip readers do).
    CSV members are read as strings in chunks and cast by Spark to ``schema`` (an id ``00123`` keeps its zeros), Parquet
    members batch by batch.  A task holds one chunk."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = [f.name for f in st.fields]
    raw = T.StructType([T.StructField(n, T.StringType()) for n in names]) if fmt == "csv" else st

    def rows_of(z: zipfile.ZipFile, member: str):
        with z.open(member) as fh:
            if fmt == "csv":
                for chunk in pd.read_csv(fh, dtype=str, chunksize=CHUNK_ROWS):
                    chunk = chunk[names].astype(object)
                    yield chunk.where(chunk.notna(), None)
            else:
                for part in pq.ParquetFile(fh).iter_batches(CHUNK_ROWS, columns=names):
                    yield part.to_pandas()[names]

    def expand(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for p, members in pdf.groupby("path")["member"]:
                with _open(p) as fh, zipfile.ZipFile(fh) as z:
                    for member in members:
                        yield from rows_of(z, member)

    members = archive_members(spark, path, member_glob).dropDuplicates(["path", "member"])
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = members.repartition(tasks, "path", "member")
    return spread.mapInPandas(expand, raw).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])


_MARKS = re.compile(rb"\\.|[\"{}\[\]]", re.DOTALL)


def _marks(fh, start: int, end: int) -> Iterator[tuple[int, int]]:
    """(offset, byte) of the quotes and brackets in start..end that no backslash escapes, read in small parts."""
    skip, at = 0, start
    while start and at:  # is the first byte escaped? count the backslashes before it
        fh.seek(max(0, at - 64))
        before = fh.read(at - max(0, at - 64))
        tail = len(before) - len(before.rstrip(b"\\"))
        skip ^= tail & 1
        if tail < len(before):
            break
        at -= len(before)
    at = start + skip
    fh.seek(at)
    while at < end:
        part = fh.read(min(READ_BYTES, end - at))
        if not part:
            return
        open_escape = (len(part) - len(part.rstrip(b"\\"))) & 1
        if open_escape and at + len(part) < end:
            part += fh.read(1)
        for m in _MARKS.finditer(part):
            if m.end() - m.start() == 1:
                yield at + m.start(), part[m.start()]
        at += len(part)


def block_state(fh, start: int, end: int) -> tuple[int, int, int]:
    """What a block does to a reader's state: (1 if its quotes are odd, depth gained if it starts outside a string,
    depth gained if it starts inside one)."""
    odd, depth = 0, [0, 0]
    for _, c in _marks(fh, start, end):
        if c == 34:
            odd ^= 1
        else:
            depth[odd] += 1 if c in b"{[" else -1
    return odd, depth[0], depth[1]


def block_records(fh, start: int, end: int, length: int, inside: bool, depth: int, base: int, most: int) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, bytes, closed) of the objects that begin in the block at nesting ``base``, read to their end."""
    at = None
    for offset, c in _marks(fh, start, length):
        if at is None and offset >= end:
            return
        if at is not None and offset - at > most:
            break
        if c == 34:
            inside = not inside
        elif not inside:
            if c in b"{[":
                if c == 123 and depth == base and at is None:
                    at = offset
                depth += 1
            else:
                depth -= 1
                if at is not None and depth == base:
                    here = fh.tell()
                    fh.seek(at)
                    yield at, fh.read(offset + 1 - at), True
                    fh.seek(here)
                    at = None
    if at is not None:
        fh.seek(at)
        yield at, fh.read(min(most, length - at)), False


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.json",
                      block_bytes: int = BLOCK_BYTES, max_record_bytes: int = 64 << 20) -> DataFrame:
    """S1, split: the records of large JSON arrays (or JSON lines, or objects put one after another).

    Two passes over blocks of a file, each block a row of its own task.  The first finds what a block does to the
    state "inside a string, at which depth" for both possible beginnings; a running sum over the blocks (one small
    row each) then gives every block its true beginning; the second pass cuts out the objects that begin in it.
    Columns: those of ``schema``, ``_rescued`` (the text of a record that is no valid JSON, else null), ``_path``,
    ``_offset``.  A record that never closes, or is longer than ``max_record_bytes``, is one flagged row that holds
    its beginning; what it swallows (up to the file's end, if it never closes) is not read as records.
    """
    files = files_of(spark, path, glob).filter("length > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(block_bytes).cast("bigint"))
    blocks = files.select("path", "length", F.explode(starts).alias("start"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = blocks.withColumn("end", F.least(F.col("start") + block_bytes, "length"))

    def states(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                with _open(r.path) as fh:
                    first = fh.read(READ_BYTES).lstrip(b"\xef\xbb\xbf \t\r\n")[:1] if r.start == 0 else b""
                    rows.append((r.path, r.length, r.start, r.end, *block_state(fh, r.start, r.end), int(first == b"[")))
            yield pd.DataFrame(rows, columns=["path", "length", "start", "end", "odd", "outside", "inside", "base"])

    kinds = "path string, length bigint, start bigint, end bigint, odd int, outside bigint, inside bigint, base int"
    state = blocks.repartition(tasks, "path", "start").mapInPandas(states, kinds)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = state.withColumn("_in", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    gained = F.when(F.col("_in") == 1, F.col("inside")).otherwise(F.col("outside"))
    state = state.withColumn("_gained", gained).withColumn("_depth", F.coalesce(F.sum("_gained").over(before), F.lit(0)))
    state = state.withColumn("base", F.max("base").over(Window.partitionBy("path")))
    todo = state.select("path", "length", "start", "end", "_in", "_depth", "base").repartition(tasks, "path", "start")

    def records(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for p, length, start, end, inside, depth, base in pdf.itertuples(index=False):
                rows, size = [], 0
                with _open(p) as fh:
                    for offset, text, closed in block_records(fh, start, end, length, bool(inside), depth, base, max_record_bytes):
                        rows.append((p, offset, text.decode("utf-8", "replace"), closed))
                        size += len(text)
                        if size > READ_BYTES:
                            yield pd.DataFrame(rows, columns=["path", "offset", "text", "closed"])
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "offset", "text", "closed"])

    texts = todo.mapInPandas(records, "path string, offset bigint, text string, closed boolean")
    wide = T.StructType([*schema.fields, T.StructField("_rescued", T.StringType())])
    parsed = F.from_json("text", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rescued"})
    rows = texts.withColumn("_r", parsed)
    bad = F.when(~F.col("closed") | F.col("_r").isNull() | F.col("_r._rescued").isNotNull(), F.col("text"))
    return rows.select(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields], bad.alias("_rescued"),
                       F.col("path").alias("_path"), F.col("offset").alias("_offset"))
