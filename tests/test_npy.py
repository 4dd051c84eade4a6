"""The data source of NumPy array files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.sources import npy


def rows(df):
    return sorted((r.path.rsplit("/", 1)[-1], r.i, r.j, r.value) for r in df.collect())


ARRAYS = {
    "mask.npy": np.arange(60, dtype=np.int32).reshape(12, 5),
    "columns.npy": np.asfortranarray(np.arange(21, dtype=np.uint16).reshape(7, 3)),
    "big_endian.npy": np.array([[1.5, -2.5]], ">f4"),
    "vector.npy": np.array([3, 4, 5], np.int8),
    "number.npy": np.float64(7.0),
    "layers.npy": np.arange(24).reshape(2, 3, 4),
    "flags.npy": np.array([[True, False], [False, True]]),
    "sub/nan.npy": np.array([[math.inf, 0.0]]),
    "empty.npy": np.zeros((0, 4)),
}


def wanted(name):
    a = np.asarray(ARRAYS[name])
    a = a.reshape(a.shape[0], math.prod(a.shape[1:])) if a.ndim > 1 else a.reshape(1, a.size)
    return [(name.rsplit("/", 1)[-1], i, j, float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1])]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("arrays")
    (path / "sub").mkdir()
    (path / "_temporary").mkdir()
    for name, a in ARRAYS.items():
        np.save(path / name, a)
    np.save(path / "_temporary" / "half.npy", np.zeros(3))
    (path / "notes.txt").write_text("no array")
    return path


@pytest.mark.parametrize("range_bytes", [1, 40, 1 << 20])
def test_all_kinds_of_arrays(spark, folder, range_bytes):
    assert rows(npy.read_arrays(spark, str(folder), range_bytes=range_bytes)) == sorted(x for n in ARRAYS for x in wanted(n))


def test_large_arrays_become_several_tasks_and_ranges_are_left_out(spark, tmp_path):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1000, (400, 300)).astype(np.int32)
    np.save(tmp_path / "a.npy", a)
    whole = npy.read_arrays(spark, str(tmp_path), range_bytes=40 * 300 * 4)
    assert whole.rdd.getNumPartitions() == 10
    total = whole.agg(F.sum("value"), F.sum(F.col("value") * F.col("i")), F.sum(F.col("value") * F.col("j")), F.count(F.lit(1))).first()
    assert tuple(total) == (a.sum(), (a.sum(1) * np.arange(400)).sum(), (a.sum(0) * np.arange(300)).sum(), a.size)
    some = whole.filter("i >= 100 AND i < 130")
    assert some.rdd.getNumPartitions() == 1 and some.agg(F.sum("value")).first()[0] == a[100:130].sum()
    for test, want in (("i = 399", a[399].sum()), ("i > 398", a[399].sum()), ("i <= 0", a[0].sum()), ("i > 5 AND i <= 6 AND j = 2", a[6, 2]), ("i IN (3, 390)", a[3].sum() + a[390].sum())):
        assert whole.filter(test).agg(F.sum("value")).first()[0] == want
    assert whole.filter("i > 1000").count() == 0 and whole.filter("i < 0").count() == 0
    only = npy.read_arrays(spark, str(tmp_path / "a.npy"), columns=("value",))
    assert only.columns == ["value"] and only.agg(F.sum("value")).first()[0] == a.sum()


def test_a_header_is_enough_to_plan(tmp_path):
    """A mask of a gigabyte, of which only the header is there to be read, is planned as many ranges."""
    with open(tmp_path / "large.npy", "wb") as f:
        np.lib.format.write_array_header_1_0(f, {"descr": "<i4", "fortran_order": False, "shape": (16384, 16384)})
        f.truncate(f.tell() + 16384 * 16384 * 4)
    parts = npy.NpyReader({"path": f"file:{tmp_path}"}).partitions()
    assert len(parts) == 16 and sum(p.count for p in parts) == 16384
    batch = next(npy.NpyReader({"path": f"file:{tmp_path}", "columns": "i,value"}).read(parts[-1]))
    assert batch.schema.names == ["i", "value"] and batch.num_rows <= npy.BATCH and batch.column("i")[0].as_py() == parts[-1].first


def test_written_and_read_back(spark, tmp_path):
    rng = np.random.default_rng(1)
    masks = {f"Well{k}_Tile{k % 3}.npy": np.where(rng.random((20 + k, 30)) < 0.3, rng.integers(1, 99, (20 + k, 30)), 0) for k in range(9)}
    data = [(n, int(i), int(j), float(m[i, j])) for n, m in masks.items() for i, j in zip(*np.nonzero(m), strict=True)]
    df = spark.createDataFrame(data, "path string, i int, j int, value double").repartition(5)
    npy.write_arrays(df, str(tmp_path / "out"), "uint8")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(masks)
    for n in masks:
        a = np.load(tmp_path / "out" / n)
        assert a.dtype == np.uint8 and np.array_equal(a, masks[n][: a.shape[0], : a.shape[1]]) and a.sum() == masks[n].sum()
    assert rows(npy.read_arrays(spark, str(tmp_path / "out")).filter("value > 0")) == sorted(data)
    npy.write_arrays(df.limit(0), str(tmp_path / "none"))
    assert npy.read_arrays(spark, str(tmp_path / "none")).count() == 0


def test_broken_files_fail(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(100))
    data = (tmp_path / "a.npy").read_bytes()
    (tmp_path / "a.npy").write_bytes(data[:-8])
    with pytest.raises(Exception, match="cut short"):
        npy.read_arrays(spark, str(tmp_path)).count()
    (tmp_path / "a.npy").write_bytes(b"something else")
    with pytest.raises(Exception, match="not an array file"):
        npy.read_arrays(spark, str(tmp_path)).count()


def test_small_files_share_a_task(spark, tmp_path, monkeypatch):
    """Many small files are planned without being opened, and read by few tasks."""
    for k in range(600):
        np.save(tmp_path / f"m{k}.npy", np.full((2, 3), k))
    np.save(tmp_path / "nan.npy", np.array([[math.nan, -1.0, 0.0, 2.0]]))
    whole = npy.read_arrays(spark, str(tmp_path))
    assert whole.rdd.getNumPartitions() == 3
    total = whole.filter("path NOT LIKE '%nan.npy'").agg(F.count(F.lit(1)), F.sum("value"), F.countDistinct("path")).first()
    assert tuple(total) == (3600, 6 * sum(range(600)), 600)
    assert whole.filter("value > 597").count() == 2 * 6 + 1 and whole.filter("value >= 597 AND i = 1 AND j = 2").count() == 3
    assert sorted(r.j for r in whole.filter("path LIKE '%nan.npy' AND value >= 0").collect()) == [0, 2, 3]
    monkeypatch.setattr(npy, "read_header", None)  # nothing is opened
    assert len(npy.NpyReader({"path": f"file:{tmp_path}"}).partitions()) == 3
