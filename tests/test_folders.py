"""Tiles stored by blocks of a bounded number, each tile's rows together."""

import glob

from terracat.sources import folders


def _stored(spark, tmp_path, monkeypatch, columns, rows):
    path = str(tmp_path / f"t{columns}")
    monkeypatch.setattr(folders, "shared_path", lambda *_: path)
    points = spark.sql(f"select id as x, cast(id % {columns} as bigint) as tile_col, cast(id div {columns} % {rows} as bigint) as tile_row from range({3 * columns * rows}) union all select -1, null, 5")
    return path, points, folders.tile_partitions(points)


def test_many_tiles_few_folders(spark, tmp_path, monkeypatch):
    path, points, got = _stored(spark, tmp_path, monkeypatch, 70, 40)
    blocks = glob.glob(f"{path}/block_col=*/block_row=*")
    assert len(blocks) <= 512 + 1 and len(glob.glob(f"{path}/**/*.parquet", recursive=True)) <= 2 * 512
    assert sorted(got.collect(), key=str) == sorted(points.collect(), key=str)
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True)[:20]:
        tiles = [(r.tile_col, r.tile_row) for r in spark.read.parquet(file).select("tile_col", "tile_row").collect()]
        assert tiles == sorted(tiles)  # tile by tile


def test_few_tiles_a_folder_each(spark, tmp_path, monkeypatch):
    path, points, got = _stored(spark, tmp_path, monkeypatch, 4, 3)
    assert len(glob.glob(f"{path}/block_col=*/block_row=*")) == 12 + 1
    assert got.where("tile_col = 2 and tile_row = 1").count() == 3 and got.count() == points.count()
