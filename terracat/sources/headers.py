"""Headers of point cloud files: fixed fields and the descriptors of extra dimensions, by the public LAS 1.4 layout."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the format: places of the fields, sizes of records, and data types of extra dimensions.
AT = {"header_size": 94, "data_offset": 96, "n_records": 100, "point_format": 104, "old_count": 107, "bbox": 179, "count": 247}
RECORD_HEAD, DESCRIPTOR, EXTRA_USER, EXTRA_ID = 54, 192, b"LASF_Spec", 4
TYPES = ["undefined", "uint8", "int8", "uint16", "int16", "uint32", "int32", "uint64", "int64", "float32", "float64"]
#: Bytes that are fetched at a time.
BLOCK = 4096
FORMATS = {"u": "<Q", "i": "<q", "f": "<d"}
DIM = "struct<name:string,type:string,nodata:double,scale:double,offset:double>"
SCHEMA = f"path string, point_format int, n_points long, xmin double, ymin double, zmin double, xmax double, ymax double, zmax double, dims array<{DIM}>, error string, bytes_read long"
_DIM = pa.struct([("name", pa.string()), ("type", pa.string()), ("nodata", pa.float64()), ("scale", pa.float64()), ("offset", pa.float64())])
_FIELDS = pa.schema([("path", pa.string()), ("point_format", pa.int32()), ("n_points", pa.int64()), *((c, pa.float64()) for c in ("xmin", "ymin", "zmin", "xmax", "ymax", "zmax")), ("dims", pa.list_(_DIM)), ("error", pa.string()), ("bytes_read", pa.int64())])


class Ranged:
    """Ranges of a file by blocks: the last block is kept, what was read is counted."""

    def __init__(self, fetch: Callable[[int, int], bytes], block: int = BLOCK):
        self.fetch, self.block, self.at, self.held, self.bytes_read = fetch, block, 0, b"", 0

    def read(self, at: int, size: int) -> bytes:
        """size bytes from at on; struct.error where the file ends before."""
        if not self.at <= at <= at + size <= self.at + len(self.held):
            self.at, self.held = at, self.fetch(at, max(size, self.block))
            self.bytes_read += len(self.held)
        got = self.held[at - self.at : at - self.at + size]
        if len(got) < size:
            raise struct.error("cut off")
        return got


def extra_dims(file: Ranged, start: int, n_records: int) -> list[dict]:
    """Descriptors in the records behind a header; bodies of other records are not read."""
    dims, at = [], start
    for _ in range(n_records):
        head = file.read(at, RECORD_HEAD)
        user, ident, size = head[2:18].rstrip(b"\0"), *struct.unpack_from("<HH", head, 18)
        body = file.read(at + RECORD_HEAD, size) if user == EXTRA_USER and ident == EXTRA_ID else b""
        for d in range(0, len(body) - DESCRIPTOR + 1, DESCRIPTOR):
            code, options = body[d + 2], body[d + 3]
            kind = TYPES[code] if code < len(TYPES) else TYPES[0]
            nodata = struct.unpack_from(FORMATS.get(kind[0], "<d"), body, d + 40)[0] if options & 1 and code else None
            scale, offset = (struct.unpack_from("<d", body, d + p)[0] if options & bit else plain for p, bit, plain in ((112, 8, 1.0), (136, 16, 0.0)))
            dims.append({"name": body[d + 4 : d + 36].rstrip(b"\0").decode("utf-8", "replace"), "type": kind, "nodata": None if nodata is None else float(nodata), "scale": scale, "offset": offset})
        at += RECORD_HEAD + size
    return dims


def header(file: Ranged) -> dict:
    """Fields of one header; raises struct.error or ValueError where it is cut off or none."""
    if file.read(0, 4) != b"LASF":
        raise ValueError("no point cloud header")
    size, _, n_records, fmt = struct.unpack("<HIIB", file.read(AT["header_size"], 11))
    box = struct.unpack("<6d", file.read(AT["bbox"], 48))
    count = struct.unpack("<Q", file.read(AT["count"], 8))[0] if size >= AT["count"] + 8 else 0
    named = dict(zip(("xmax", "xmin", "ymax", "ymin", "zmax", "zmin"), box, strict=True))
    return named | {"point_format": fmt & 0x3F, "n_points": count or struct.unpack("<I", file.read(AT["old_count"], 4))[0], "dims": extra_dims(file, size, n_records)}


def header_row(path: str, file: Ranged) -> dict:
    try:
        row = header(file) | {"error": None}
    except (struct.error, ValueError) as e:
        row = {"error": "no point cloud header" if isinstance(e, ValueError) else "cut off"}
    return row | {"path": path, "bytes_read": file.bytes_read}


@dataclass
class FilePart(InputPartition):
    """Files of one task."""

    paths: list[str]


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.per_task, self.ends = options["path"], int(options.get("files_per_task", 200)), tuple(options.get("extensions", ".las,.laz").split(","))

    def partitions(self) -> list[InputPartition]:
        store, at = fs.FileSystem.from_uri(self.root if ":" in self.root else f"file://{self.root}")
        listed = store.get_file_info(fs.FileSelector(at, recursive=True))
        paths = sorted(f.path[len(at) :].lstrip("/") for f in listed if f.type == fs.FileType.File and f.path.lower().endswith(self.ends))
        return [FilePart(paths[k : k + self.per_task]) for k in range(0, len(paths), self.per_task)]

    def read(self, part: FilePart | None) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(self.root if ":" in self.root else f"file://{self.root}")
        rows = []
        for path in part.paths if part else ():  # a folder without files has one task without a part
            with store.open_input_file(f"{at.rstrip('/')}/{path}") as f:
                rows.append(header_row(path, Ranged(lambda place, size, f=f: f.read_at(size, place))))
        yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)


class PointHeaders(DataSource):
    """spark.read.format("point_headers").load(folder): a row for each point cloud file below the folder, of its header alone.

    Options: extensions (of files, by comma), files_per_task. Files of any size: of each, the blocks are read that hold
    the header and the records behind it. Empty folders give no rows, files that are none of these an error in their row.
    """

    @classmethod
    def name(cls) -> str:
        return "point_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(dict(self.options))


def scan_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of the point cloud files below a folder."""
    spark.dataSource.register(PointHeaders)
    return spark.read.format("point_headers").load(folder)


def header_bytes(point_format: int, n_points: int, box: tuple[float, ...], dims: list[tuple[str, int, float | None, float, float]], old: bool = False) -> bytes:
    """A header of box (xmin, ymin, zmin, xmax, ymax, zmax) with descriptors (name, type code, nodata, scale, offset), compressed-flag set."""
    size = 227 if old else 375
    raw = bytearray(size)
    raw[:4] = b"LASF"
    body = b""
    for name, code, nodata, scale, offset in dims:
        one = bytearray(DESCRIPTOR)
        one[2], one[3] = code, (nodata is not None) | 8 | 16
        one[4 : 4 + len(name)] = name.encode()
        if nodata is not None:
            kind = FORMATS[TYPES[code][0]]
            struct.pack_into(kind, one, 40, nodata if kind == "<d" else int(nodata))
        struct.pack_into("<d", one, 112, scale)
        struct.pack_into("<d", one, 136, offset)
        body += bytes(one)
    record = struct.pack("<H16sHH32s", 0, EXTRA_USER, EXTRA_ID, len(body), b"") + body if dims else b""
    struct.pack_into("<HIIB", raw, AT["header_size"], size, size + len(record), int(bool(dims)), point_format | 0x80)
    struct.pack_into("<6d", raw, AT["bbox"], box[3], box[0], box[4], box[1], box[5], box[2])
    if old:
        struct.pack_into("<I", raw, AT["old_count"], n_points)
    else:
        struct.pack_into("<Q", raw, AT["count"], n_points)
    return bytes(raw) + record


def write_headers(items: DataFrame, folder: str, padding: int = 0) -> None:
    """Write a file for each of items (path, point_format, n_points, xmin..zmax, dims array<struct<name, code, nodata, scale, offset>>,
    keep int or null: bytes that are left of the header, old boolean: the layout of 227 bytes), with so many bytes behind it."""
    box = ("xmin", "ymin", "zmin", "xmax", "ymax", "zmax")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                raw = header_bytes(r["point_format"], r["n_points"], tuple(r[c] for c in box), [tuple(d[c] for c in ("name", "code", "nodata", "scale", "offset")) for d in r["dims"]], r["old"])
                store.create_dir(f"{at}/{r['path']}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{at}/{r['path']}") as f:
                    f.write(raw + b"\0" * padding if r["keep"] is None else raw[: r["keep"]])
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], names=["n"])

    items.mapInArrow(run, "n long").agg({"n": "sum"}).collect()  # one number
