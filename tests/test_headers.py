"""Header files written byte by byte, after the public layout, and what the source reads of them."""

import os
import struct

from terracat.sources.headers import BLOCK, scan_headers


def by_hand(version, point_format, box, points, records=b"", n_records=0, size=None):
    """Fields in the order of the layout."""
    size = size or {2: 227, 3: 235, 4: 375}[version]
    out = b"LASF" + struct.pack("<HH", 0, 0) + b"\0" * 16 + bytes([1, version]) + b"\0" * 32 + b"\0" * 32 + struct.pack("<HH", 1, 2020)
    assert len(out) == 94
    old = points if version < 4 else 0
    out += struct.pack("<HII", size, size + len(records), n_records) + bytes([point_format]) + struct.pack("<H", 30) + struct.pack("<I", old) + b"\0" * 20
    out += struct.pack("<3d", 0.01, 0.01, 0.01) + struct.pack("<3d", 0, 0, 0) + struct.pack("<6d", *box)
    if version >= 3:
        out += struct.pack("<Q", 0)
    if version >= 4:
        out += struct.pack("<QI", 0, 0) + struct.pack("<Q", points) + b"\0" * 120
    assert len(out) == size
    return out + records


def record(user, ident, body):
    return struct.pack("<H", 0) + user.ljust(16, b"\0") + struct.pack("<HH", ident, len(body)) + b"\0" * 32 + body


def dimension(name, code, options, nodata=b"", scale=0.0, offset=0.0):
    out = b"\0\0" + bytes([code, options]) + name.ljust(32, b"\0") + b"\0" * 4 + nodata.ljust(24, b"\0") + b"\0" * 48
    return (out + struct.pack("<3d", scale, 0, 0) + struct.pack("<3d", offset, 0, 0)).ljust(192, b"\0")


BOX = (20.0, 10.0, 40.0, 30.0, 6.0, 5.0)  # max and min of x, y, z


def test_files(spark, tmp_path):
    dims = dimension(b"Amp", 3, 1 | 8, struct.pack("<Q", 9), scale=0.5) + dimension(b"Dev", 9, 16, offset=2.0)
    big = record(b"other", 7, b"x" * 60_000)
    files = {
        "a/old.las": by_hand(2, 3, BOX, 77),
        "a/middle.LAS": by_hand(3, 1, BOX, 78),
        "b/new.laz": by_hand(4, 6 | 0x80, BOX, 5_000_000_000, big + record(b"LASF_Spec", 4, dims), 2),
        "b/cut_header.las": by_hand(4, 6, BOX, 1)[:200],
        "b/cut_record.las": by_hand(4, 6, BOX, 1, record(b"LASF_Spec", 4, dims)[:100], 1),
        "b/cut_list.las": by_hand(4, 6, BOX, 1, b"", 3),
        "b/empty.las": b"",
        "b/none.las": b"PK\x03\x04" + b"\0" * 500,
        "b/notes.txt": b"LASF",
    }
    for name, raw in files.items():
        os.makedirs(tmp_path / name.partition("/")[0], exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    with open(tmp_path / "b/new.laz", "ab") as f:  # a long file: a hole of 3 GB
        f.truncate(3 << 30)
    got = {r.path: r for r in scan_headers(spark, f"file://{tmp_path}").collect()}
    assert got.keys() == files.keys() - {"b/notes.txt"}
    assert [(got[k].point_format, got[k].n_points, got[k].dims) for k in ("a/old.las", "a/middle.LAS")] == [(3, 77, []), (1, 78, [])]
    new = got["b/new.laz"]
    assert (new.point_format, new.n_points, new.xmin, new.xmax, new.ymin, new.ymax, new.zmin, new.zmax) == (6, 5_000_000_000, 10.0, 20.0, 30.0, 40.0, 5.0, 6.0)
    assert [tuple(d) for d in new.dims] == [("Amp", "uint16", 9.0, 0.5, 0.0), ("Dev", "float32", None, 1.0, 2.0)]
    assert {k: r.error for k, r in got.items() if r.error} == {"b/cut_header.las": "cut off", "b/cut_record.las": "cut off", "b/cut_list.las": "cut off", "b/empty.las": "cut off", "b/none.las": "no point cloud header"}
    assert max(r.bytes_read for r in got.values()) <= 3 * BLOCK


def test_tasks(spark, tmp_path):
    for k in range(7):
        (tmp_path / f"{k}.las").write_bytes(by_hand(2, k % 4, BOX, k))
    scan_headers(spark, str(tmp_path))
    df = spark.read.format("point_headers").option("files_per_task", 3).load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 3 and sorted(r.n_points for r in df.collect()) == list(range(7))
    assert spark.read.format("point_headers").option("extensions", ".xyz").load(str(tmp_path)).collect() == []
