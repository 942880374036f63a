"""Web archives with a two-level capture index.

Writing: every page becomes a gzip member in an archive file, one file per task attempt. A response holds the payload;
of pages with equal payloads all but that with the smallest id become revisits of it. The table of captures that the
write returns names files of successful attempts only, so a lost executor leaves an orphan file and no wrong row.

Index: captures are sorted by reversed-host key over all partitions. Each partition writes its lines as compressed
blocks and, behind them, a sparse directory with the first key of each block. A short table of the partitions' first
keys leads to the directories.

Lookup: keys are searched in the table of partitions, then in a directory, by bisection; the blocks that may hold a key
are read by byte range, and so are the records that their lines name. A key with very many captures spreads over as many
tasks as it has blocks.

Null urls have the empty key, null html is an empty payload. Pages with a null id never become the target of a revisit;
equal payloads that only such pages have are all responses. Rows that repeat an id and a payload with the smallest id are
all responses, and no record refers to one of them by its record id, as they share the page. Names of records are unique.
An address is written as it is but for blanks, control characters and what isn't ASCII; where that changes it, another
header holds the address itself. A very long payload is one record, held in memory while it is packed. Empty tables give
no files, captures or answers.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import bound_batches
from tagloom.llm.host_reputation import host_of
from tagloom.operators.sizing import small_or_whole, staged, staging_path

LINES = 1024
DATE = "1970-01-01T00:00:00Z"
#: Bytes of archives, and blocks of the index, that a task reads; beyond MAX_TASKS tasks get more.
RANGE = 16 << 20
BLOCKS = 64
MAX_TASKS = 100_000
CAPTURES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
NAMES = CAPTURES.fieldNames()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, for reads by byte range."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def url_key(url: Column) -> Column:
    """Host labels in reverse, then what follows the host, without a fragment; the url itself where it has no host."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    reverse = F.concat(F.array_join(F.reverse(F.split(host_of(url), r"\.")), ","), F.lit(")"), rest)
    return F.when(F.contains(text, F.lit("://")), reverse).otherwise(text)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _shared_name(page_id: int, digest_: str) -> str:
    """Name of the one response others refer to."""
    return record_name(f"page:{page_id}:{digest_}")


def record(
    url: str | None, page_id: int | None, payload: bytes, refers_to: int | None, name: str | None = None, known: bool = True
) -> bytes:
    """One archive record: a response with its payload, or a revisit with the headers it would have.

    ``name`` is the record's own; without one it is the response others refer to. ``known`` tells whether the response
    a revisit refers to has such a name.
    """
    told = digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_shared_name(page_id, told) if name is None else record_name(name)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{told}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        address = re.sub(r"[^\x21-\x7e]", lambda m: quote(m[0]), url)
        lines.append(f"WARC-Target-URI: {address}")
        if address != url:
            lines.append("X-Target-URI: " + quote(url, safe=""))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if known:
            lines.append(f"WARC-Refers-To: {_shared_name(refers_to, told)}")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What ``record`` wrote; a payload that doesn't match its digest is an error."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    announced = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, url = fields["WARC-Type"], fields.get("WARC-Target-URI")
    if kind == "response" and (len(payload) != announced or digest(payload) != told):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    return {
        "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
        "url": unquote(fields["X-Target-URI"]) if "X-Target-URI" in fields else url,
        "record_type": kind,
        "payload": payload if kind == "response" else None,
        "payload_bytes": announced,
        "payload_digest": told,
        "refers_to": int(fields["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in fields else None,
    }


def _new_file(folder: str, name: str):
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    file = f"{name}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
    return f"{folder}/{file}", system.open_output_stream(f"{path}/{file}")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_payload: int = 0) -> DataFrame:
    """Write all pages into archives under ``folder``; the table of captures, staged."""
    payload = F.coalesce(pages[f"`{html}`"].cast("string"), F.lit(""))
    rows = pages.select(
        pages[f"`{key}`"].cast("bigint").alias("page_id"),
        pages[f"`{url}`"].cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    named = rows.filter(F.octet_length("payload") >= min_payload).groupBy("sha", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("page_id").isNull().alias("z"), "page_id", "n"))
    copies = named.groupBy("sha").agg(least.alias("least"), F.sum("n").alias("n")).filter("n > 1")
    copies = copies.select("sha", F.col("least.page_id").alias("first"), (F.col("least.n") == 1).alias("known"))
    of = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    shared = F.coalesce(F.col("known") & F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    # few groups of copies are broadcast, so that payloads stay where they are
    linked = rows.join(small_or_whole(copies), "sha", "left").select(
        url_key(F.col("url")).alias("key"), "page_id", "url", "payload", of, shared.alias("shared"), F.coalesce("known", F.lit(False)).alias("known")
    )

    bound_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, at = None, "", 0
        for batch in batches:
            if out is None:
                file, out = _new_file(folder, "warc")
            found = []
            for name, page, address, body, refers, shared, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                own = None if shared and page is not None else f"{file}:{at}"
                member = packer.compress(record(address, page, body, refers, own, known)) + packer.flush()
                out.write(member)
                kind = "response" if refers is None else "revisit"
                found.append((name, page, len(body), digest(body), kind, refers, file, at, len(member)))
                at += len(member)
            yield _table(found, CAPTURES)
        if out is not None:
            out.close()

    return staged(linked.mapInArrow(write, CAPTURES), "captures")


def _table(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], names=arrow.names)


PARTS = "first string, last string, file string, offset bigint, length bigint, lines bigint"


def build_index(captures: DataFrame, folder: str, lines: int = LINES) -> DataFrame:
    """Write the index of all captures under ``folder``; the table of its partitions, staged, a row for each file."""
    ordered = captures.select(*NAMES).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    parts = T._parse_datatype_string(PARTS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, waiting, directory, total = None, 0, [], [], 0

        def flush(rows: list[list]) -> int:
            block = zlib.compress("\n".join(json.dumps(r) for r in rows).encode(), 6)
            out.write(block)
            directory.append([rows[0][0], rows[-1][0], at, len(block)])
            return at + len(block)

        for batch in batches:
            if out is None:
                file, out = _new_file(folder, "index")
            waiting += [list(r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            while len(waiting) >= lines:
                at, total = flush(waiting[:lines]), total + lines
                waiting = waiting[lines:]
        if out is None:
            return
        if waiting:
            total += len(waiting)
            at = flush(waiting)
        if directory:
            tail = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(tail)
            yield _table([(directory[0][0], directory[-1][1], file, at, len(tail), total)], parts)
        out.close()

    return staged(ordered.mapInArrow(write, parts), "index")


def _read(system_of: dict, file: str, offset: int, length: int) -> bytes:
    if system_of.get("file") != file:
        if system_of.get("open"):
            system_of["open"].close()
        system, path = file_system(file)
        system_of |= {"file": file, "open": system.open_input_file(path)}
    return system_of["open"].read_at(length, offset)


def find_blocks(keys: DataFrame, index: DataFrame) -> DataFrame:
    """``key`` and the byte range of each block that may hold it, by bisection in partitions and directories."""
    rows = index.select("first", "last", "file", "offset", "length").orderBy("first", "last", "file").collect()  # a row per index file
    parts = keys.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
    schema = T._parse_datatype_string("key string, file string, offset bigint, length bigint")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parts.value
        firsts, lasts = [p[0] for p in known], [p[1] for p in known]
        opened, at, directory = {}, None, []
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                for part in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    if at != part:
                        directory = json.loads(zlib.decompress(_read(opened, *known[part][2:5])))
                        at, heads, tails = part, [d[0] for d in directory], [d[1] for d in directory]
                    for _, _, offset, length in directory[bisect_left(tails, key) : bisect_right(heads, key)]:
                        found.append((key, known[part][2], offset, length))
            yield _table(found, schema)

    distinct = keys.select(F.coalesce(F.col("key"), F.lit("")).alias("key")).distinct()
    return distinct.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(search, schema)


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """The captures of all ``key`` values, by range reads of index blocks."""
    found = staged(find_blocks(keys, index), "blocks")
    tasks = min(MAX_TASKS, max(1, math.ceil(found.count() / BLOCKS)))
    blocks = found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, at, lines = {}, None, {}
        for batch in batches:
            found = []
            for key, *place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != place:
                    at, lines = place, {}
                    for line in zlib.decompress(_read(opened, *place)).decode().split("\n"):
                        row = json.loads(line)
                        lines.setdefault(row[0], []).append(tuple(row))
                found += lines.get(key, ())
            yield _table(found, CAPTURES)

    return blocks.mapInArrow(read, CAPTURES)


RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
    ]
)


def read_records(captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that captures name, by range reads of the archives; payloads are checked either way."""
    places = staged(captures.select("file", "offset", "length"), "places")
    tasks = min(MAX_TASKS, max(1, math.ceil((places.agg(F.sum("length")).first()[0] or 0) / RANGE)))
    # a given number, or Spark would put the few bytes of the places into one task, which then reads all archives
    placed = places.repartitionByRange(tasks, "file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            found, held = [], 0
            for place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                r = parse(zlib.decompress(_read(opened, *place), 31))
                if not with_payload:
                    r["payload"] = None
                found.append(tuple(r[n] for n in RECORDS.fieldNames()))
                held += len(r["payload"] or b"")
                if held > 16 << 20:
                    yield _table(found, RECORDS)
                    found, held = [], 0
            yield _table(found, RECORDS)

    return placed.sortWithinPartitions("file", "offset").mapInArrow(read, RECORDS)


def archive(pages: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Captures and index of all pages, in new folders of the session's shared folder."""
    folder = staging_path(pages.sparkSession, "archives")
    captures = write_archives(pages, f"{folder}/warc", **options)
    return captures, build_index(captures, f"{folder}/index")
