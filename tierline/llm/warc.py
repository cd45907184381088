"""WARC archives of pages, found again through a two-level index of captures.

Writing: one gzip member per record, one archive file per task, in the folder
all machines share. Of equal payloads one is a response and the others are
revisits that refer to it. A task names its files anew each time it runs, and
only the rows of the run that succeeded are kept, so a lost executor leaves at
most a file nobody refers to.

Index: captures sorted by reversed-host key go into compressed blocks; the
directory has the first and last key of each block and where it is stored. A
lookup searches the directory by halving, reads the range of each block that
can hold its keys once, and then the ranges of the records, adjacent ones
together. The directory has a bounded number of rows: blocks grow beyond that.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.workspace import new_dir

MIN_SHARED = 100
DATE = "2024-01-01T00:00:00Z"
BLOCK_ENTRIES = 1_000
DIRECTORY_ROWS = 1_000_000
# Up to this many digests of repeated payloads are broadcast; beyond, the pages are joined by a shuffle.
FEW_DIGESTS = 100_000
READ_AHEAD = 4_000_000
FILE_PART = 64_000_000

ENTRY = "key string, file string, at long, size long"


@cache
def _files(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then port and path: pages of a domain are neighbours. Null is empty."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url or ""
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    if not host:
        return url or ""
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest


def record(page: dict) -> bytes:
    """One record as a gzip member. A revisit has the HTTP headers of its page, but no payload."""
    payload = (page["html"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if page["kind"] == "revisit" else http + payload
    number = lambda x: "" if x is None else str(x)
    head = [
        "WARC/1.1",
        f"WARC-Type: {page['kind']}",
        f"WARC-Record-ID: <urn:page:{number(page['page_id'])}:{page['row']}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(page['url'] or '', safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Payload-Digest: sha256:{page['digest']}",
    ]
    if page["kind"] == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{number(page['refers_to'])}:{page['refers_row']}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


def parsed(raw: bytes) -> dict:
    """Headers and payload of an unpacked record; the payload of a response is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    page = lambda name: (lambda x: int(x) if x else None)(fields[name].split(":")[2]) if name in fields else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']} does not hold what its digest says")
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if response else None,
    }


def _typed(df: DataFrame) -> DataFrame:
    """Adds digest, kind, refers_to and refers_row; of equal payloads the smallest page id, then the first row, responds."""
    spark = df.sparkSession
    path = new_dir(spark, "pages")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    staged = df.select("page_id", "url", "html").withColumns({"row": F.monotonically_increasing_id(), "digest": F.sha2(payload, 256), "size": F.octet_length(payload)})
    staged.write.parquet(path)
    rows = spark.read.parquet(path)
    first = F.min(F.struct(F.isnull("page_id").alias("none"), "page_id", "row")).alias("first")
    repeated = rows.filter(F.col("size") >= MIN_SHARED).groupBy("digest").agg(F.count("*").alias("n"), first).filter("n > 1")
    repeated = repeated.select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.row").alias("refers_row"))
    kept = new_dir(spark, "repeated")
    repeated.write.parquet(kept)
    repeated = spark.read.parquet(kept)
    joined = rows.join(F.broadcast(repeated) if repeated.count() <= FEW_DIGESTS else repeated, "digest", "left")
    other = F.col("refers_row").isNotNull() & (F.col("refers_row") != F.col("row"))
    return joined.withColumns(
        {
            "kind": F.when(other, "revisit").otherwise("response"),
            "refers_to": F.when(other, F.col("refers_to")),
        }
    )


@dataclass(frozen=True)
class Archive:
    folder: str


def write(df: DataFrame, folder: str | None = None) -> Archive:
    """Archives and index of pages (page_id, url, html); null html is an empty payload, other columns are not kept."""
    spark = df.sparkSession
    folder = folder or new_dir(spark, "warc")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        name, out, at = "", None, 0
        try:
            for batch in batches:
                entries = []
                for page in batch.to_pylist():
                    if out is None:
                        files.create_dir(path, recursive=True)
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out = files.open_output_stream(f"{path}/{name}", compression=None)
                    data = record(page)
                    out.write(data)
                    entries.append({"key": url_key(page["url"]), "file": name, "at": at, "size": len(data)})
                    at += len(data)
                if entries:
                    yield pa.RecordBatch.from_pylist(entries, pa.schema([("key", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))
        finally:
            if out is not None:
                out.close()

    captures = f"{folder}/captures"
    _typed(df).drop("size").mapInArrow(store, ENTRY).write.parquet(captures)
    _index(spark, folder, spark.read.parquet(captures))
    return Archive(folder)


def _index(spark: SparkSession, folder: str, captures: DataFrame) -> None:
    """Blocks of sorted captures, and the directory of blocks."""
    per_block = max(BLOCK_ENTRIES, captures.count() // DIRECTORY_ROWS + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        name, out, at = "", None, 0
        held: list[dict] = []
        names = ["first", "last", "file", "at", "size"]

        def stored() -> pa.RecordBatch:
            nonlocal name, out, at
            if out is None:
                files.create_dir(path, recursive=True)
                name = f"index-{uuid.uuid4().hex}.cdx"
                out = files.open_output_stream(f"{path}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps([e["key"], e["file"], e["at"], e["size"]]) for e in held).encode(), 6)
            out.write(data)
            at += len(data)
            row = [held[0]["key"], held[-1]["key"], name, at - len(data), len(data)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names)

        try:
            for batch in batches:
                for entry in batch.to_pylist():
                    held.append(entry)
                    if len(held) == per_block:
                        yield stored()
            if held:
                yield stored()
        finally:
            if out is not None:
                out.close()

    # The order is by all columns, so that captures of one very common key are spread over partitions too.
    ordered = captures.repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    ordered.mapInArrow(pack, "first string, last string, file string, at long, size long").write.parquet(f"{folder}/directory")
    rows = spark.read.parquet(f"{folder}/directory").orderBy("first", "last").toArrow()
    files, path = _files(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/directory.arrow", compression=None) as out, pa.ipc.new_file(out, rows.schema) as writer:
        writer.write_table(rows)


@cache
def _directory(folder: str) -> dict[str, np.ndarray]:
    files, path = _files(folder)
    with files.open_input_file(f"{path}/directory.arrow") as source:
        table = pa.ipc.open_file(source).read_all()
    return {name: np.array(table[name].to_pylist(), object) for name in table.schema.names}


def _ranges(entries: list[dict]) -> Iterator[list[dict]]:
    """Runs of neighbouring ranges of one file, each read at once."""
    run: list[dict] = []
    for e in entries:
        far = run and (e["file"] != run[-1]["file"] or e["at"] != run[-1]["at"] + run[-1]["size"] or e["at"] - run[0]["at"] > READ_AHEAD)
        if far:
            yield run
            run = []
        run.append(e)
    if run:
        yield run


def lookup(urls: DataFrame, archive: Archive, url_col: str = "url") -> DataFrame:
    """All captures (key, file, at, size) of the given addresses; each address counts once, null as an empty one."""
    folder = archive.folder

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = _directory(folder)
        for batch in batches:
            keys = np.array(batch.column("key").to_pylist(), object)
            if not len(keys) or not len(directory["first"]):
                continue
            low = np.searchsorted(directory["last"], keys, "left")
            high = np.searchsorted(directory["first"], keys, "right")
            n = np.maximum(high - low, 0)
            block = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int64)), pa.array(np.repeat(keys, n), pa.string())], ["block", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = _directory(folder)
        files, path = _files(folder)
        for batch in batches:
            blocks = np.asarray(batch.column("block"))
            keys = batch.column("key").to_pylist()
            edges = np.flatnonzero(np.diff(blocks, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(blocks)]):
                wanted = set(keys[a:b])
                at = int(blocks[a])
                with files.open_input_file(f"{path}/{directory['file'][at]}") as source:
                    data = zlib.decompress(source.read_at(directory["size"][at], directory["at"][at]))
                found = [e for e in map(json.loads, data.decode().split("\n")) if e[0] in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)] if found else [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64())], ["key", "file", "at", "size"])

    keys = urls.select(F.col(f"`{url_col}`").alias("url")).distinct().mapInArrow(keyed, "key string").distinct()
    places = keys.mapInArrow(search, "block long, key string").repartition("block").sortWithinPartitions("block")
    return places.mapInArrow(read, ENTRY)


def records(captures: DataFrame, archive: Archive) -> DataFrame:
    """The records of captures, read by range: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload."""
    folder = archive.folder
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for run in _ranges(batch.to_pylist()):
                with files.open_input_file(f"{path}/{run[0]['file']}") as source:
                    start = run[0]["at"]
                    data = source.read_at(run[-1]["at"] + run[-1]["size"] - start, start)
                rows = [parsed(gzip.GzipFile(fileobj=io.BytesIO(data[e["at"] - start : e["at"] - start + e["size"]])).read()) for e in run]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)

    part = F.floor(F.col("at") / FILE_PART)
    near = captures.repartition("file", part).sortWithinPartitions("file", "at")
    return near.mapInArrow(read, schema)


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT d, min(page_id) AS first FROM p WHERE n >= {MIN_SHARED} GROUP BY d
)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= {MIN_SHARED}
"""
