"""WARC archives and their two-level capture index.

Archives are WARC 1.1 files, one gzip member per record, written by the tasks to the shared folder. The index holds a
line per record under its reversed-host URL key, in key order, in compressed blocks, a file of blocks for each task and
beside it a sparse directory of the first and last key of each block. A look-up searches the directories by bisection,
opens only blocks that can hold the key, searches them by bisection, and then reads the records' byte ranges alone.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import fresh_path, staged

DATE = "2024-01-01T00:00:00Z"
#: Records in an index block, and bytes of archives that one task reads back, about.
BLOCK_LINES, READ_BYTES = 2_000, 4 << 20
LINE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
LINES = "key string, page_id long, file string, offset long, length long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Reversed-host key: com,example,www)/path?query, without scheme, port of it, or letter case of the host."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + rest


def record(kind: str, url: str | None, page_id: int | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit holds the HTTP head alone, with the length of the payload it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(i))}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda b: dict(x.split(": ", 1) for x in b.decode().split("\r\n")[1:] if ": " in x)
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, path: str, smallest: int = 0) -> DataFrame:
    """Write a record per row of pages under path; returns the staged index lines: key, page_id, file, offset, length.

    Of the records of equal payload of at least `smallest` bytes, the one of the largest page_id is the response and
    others revisit it. Rows that share that largest id are all responses; null ids revisit, or are responses where the
    whole group has none.
    """
    body = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body")).withColumn("sha", F.sha1("body"))
    groups = rows.select("page_id", "sha", F.length("body").alias("n")).groupBy("sha").agg(F.max("page_id").alias("latest"), F.count("*").alias("copies"), F.first("n").alias("n"))
    groups = groups.where((F.col("copies") > 1) & (F.col("n") >= smallest)).select("sha", "latest")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, f"{path}/{uuid.uuid4().hex}.warc.gz", 0  # a retried task writes another file
        for b in batches:
            lines = []
            for page_id, url, payload, latest in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is None:
                    fs, local = _open(name)
                    fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(local, compression=None)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                kind = "response" if latest is None or latest == page_id else "revisit"
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = packer.compress(record(kind, url, page_id, payload, digest, latest)) + packer.flush()
                out.write(raw)
                lines.append((url_key(url), page_id, name, at, len(raw)))
                at += len(raw)
            if lines:
                yield _batch(lines, LINE)
        if out is not None:
            out.close()

    marked = rows.join(groups, "sha", "left").select("page_id", "url", "body", "latest")
    return staged(marked.mapInArrow(write, LINES), "captures")


def _batch(rows: list, fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)


def write_index(lines: DataFrame, path: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index of lines under path; returns the staged table of its parts, one row for each file of blocks:
    file, directory, first_key, last_key."""
    fields = pa.schema([(c, pa.string()) for c in ("file", "directory", "first_key", "last_key")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, held, sparse, at = f"{path}/{uuid.uuid4().hex}", None, [], [], 0  # a retried task writes other files

        def close(rows: list[tuple]) -> None:
            nonlocal at
            data = zlib.compress("\n".join(json.dumps(r) for r in rows).encode())
            out.write(data)
            sparse.append((rows[0][0], rows[-1][0], at, len(data)))
            at += len(data)

        for b in batches:
            held += zip(*[c.to_pylist() for c in b.columns], strict=True)
            if held and out is None:
                fs, local = _open(name)
                fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(f"{local}.blocks", compression=None)
            while len(held) >= block_lines:
                close(held[:block_lines])
                held = held[block_lines:]
        if held:
            close(held)
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{local}.directory", compression=None) as f:
                f.write(zlib.compress(json.dumps(sparse).encode()))
            yield _batch([(f"{name}.blocks", f"{name}.directory", sparse[0][0], sparse[-1][1])], fields)

    # The page's number breaks ties: many captures of one URL spread over parts.
    ordered = lines.select("key", "page_id", "file", "offset", "length").repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return staged(ordered.mapInArrow(pack, "file string, directory string, first_key string, last_key string"), "index")


def _read(file: str, offset: int | None = None, length: int | None = None) -> bytes:
    fs, local = _open(file)
    with fs.open_input_file(local) as f:
        if offset is None:
            return zlib.decompress(f.read())
        f.seek(offset)
        return zlib.decompress(f.read(length))


def look_up(keys: DataFrame, parts: DataFrame) -> DataFrame:
    """Index lines (key, page_id, file, offset, length) of all captures under the keys (key), each key once or more.

    The table of parts goes to every task: a row for each task that wrote the index. A key of many captures fills many
    blocks, which are opened by as many tasks.
    """
    top = sorted((r["first_key"], r["last_key"], r["file"], r["directory"]) for r in parts.collect())
    firsts, lasts = [t[0] for t in top], [t[1] for t in top]
    wanted = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("key", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sparse, low, high = None, [], [], []
        for b in batches:
            hits = []
            for key in b.column(0).to_pylist():
                for _, _, file, directory in top[bisect_left(lasts, key) : bisect_right(firsts, key)]:
                    if directory != now:
                        now, sparse = directory, json.loads(_read(directory))
                        low, high = [x[0] for x in sparse], [x[1] for x in sparse]
                    hits += [(file, offset, length, key) for _, _, offset, length in sparse[bisect_left(high, key) : bisect_right(low, key)]]
            if hits:
                yield _batch(hits, wanted)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, known = None, [], []
        for b in batches:
            out = []
            for file, offset, length, key in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (file, offset) != now:
                    now, lines = (file, offset), [json.loads(x) for x in _read(file, offset, length).split(b"\n")]
                    known = [x[0] for x in lines]
                out += lines[bisect_left(known, key) : bisect_right(known, key)]
            if out:
                yield _batch(out, LINE)

    asked = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    blocks = asked.mapInArrow(find, "file string, offset long, length long, key string")
    return blocks.repartition("file", "offset").sortWithinPartitions("file", "offset", "key").mapInArrow(opened, LINES)


def keys_of(pages: DataFrame) -> DataFrame:
    """key of each row of pages (url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.string())], names=["key"])

    return pages.select(F.col("url").cast("string").alias("url")).mapInArrow(run, "key string")


def read_range(file: str, offset: int, length: int, opened: dict) -> bytes:
    """The record at a byte range of an archive. opened: the file handle kept by the caller."""
    if file not in opened:
        for f in opened.values():
            f.close()
        opened.clear()
        fs, local = _open(file)
        opened[file] = fs.open_input_file(local)
    opened[file].seek(offset)
    return zlib.decompress(opened[file].read(length), 31)


def read_captures(lines: DataFrame) -> DataFrame:
    """Range-read the records of index lines: page_id, payload_bytes, payload_digest, record_type, refers_to, payload."""
    fields = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 500):
                rows = []
                for file, offset, length in zip(*[c.to_pylist() for c in b.slice(at, 500).columns], strict=True):
                    warc, http, payload = parse(read_range(file, offset, length, opened))
                    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"damaged record in {file} at {offset}")
                    number = lambda k: int(warc[k]) if k in warc else None  # noqa: B023, E731
                    rows.append((number("Page-ID"), int(http["Content-Length"]), digest, kind, number("Refers-To-Page-ID"), payload if kind == "response" else None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)
        for f in opened.values():
            f.close()

    # Dealt by what is read, not by the size of the lines: a number of its own keeps them from being drawn together.
    total = lines.agg(F.sum("length")).first()[0] or 0
    tasks, piece = total // READ_BYTES + 1, F.floor(F.col("offset") / READ_BYTES)
    dealt = lines.select("file", "offset", "length").repartition(tasks, "file", piece).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_pages(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Write, index, look up every page's URL and read back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, one row per page.

    Null html is an empty payload. Null urls and ids keep their row. An empty table gives an empty result.
    """
    path = fresh_path(pages.sparkSession, "warc")
    parts = write_index(write_archives(pages, f"{path}/archives", smallest), f"{path}/index")
    found = staged(look_up(keys_of(pages), parts), "found")
    return read_captures(found).drop("payload")
