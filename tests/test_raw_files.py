"""Listing, damaged inputs, raw file sinks, dense patches."""

import json
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomprep.operators import patches as D
from loomprep.operators import vision as Z
from loomprep.sources import file_sink as S
from loomprep.sources.listing import list_data_files
from loomprep.sources.rejects import read_with_rejects


def names(paths):
    return [p.rpartition("/")[2] for p in paths]


def test_listing(spark, tmp_path):
    d = tmp_path / "a folder{1}"
    (d / "z.parquet").mkdir(parents=True)
    for n in ("b.parquet", "a.parquet", "c.txt", "y[1].parquet", ".hidden.parquet", "x y.parquet"):
        (d / n).write_bytes(b"")
    (d / "z.parquet" / "part-0.parquet").write_bytes(b"")
    (d / "z.parquet" / "_SUCCESS").write_bytes(b"")
    listed = lambda spec, base=None: names(list_data_files(spark, spec, base))
    for head in (str(d), f"file:{d}", f"file://{d}"):
        assert listed(f" {head}/[ab].parquet , ,{head}/c.txt,{head}/a.parquet,{head}/a.parquet") == [
            "a.parquet", "b.parquet", "c.txt", "a.parquet", "a.parquet"]
        assert listed(f"{head}/y[1].parquet") == ["y[1].parquet"]
        assert listed(f"{head}/*.parquet") == ["a.parquet", "b.parquet", "x y.parquet", "y[1].parquet"]
        assert listed(f"{head}/z.parquet") == ["part-0.parquet"]
        for missing in ("none.parquet", "*.none"):
            with pytest.raises(FileNotFoundError):
                listed(f"{head}/{missing}")
    assert listed("c.txt,x y.parquet", str(d)) == ["c.txt", "x y.parquet"]
    assert listed([f"{d}/c.txt"]) == ["c.txt"]
    with pytest.raises(ValueError):
        listed(" , ")


@pytest.fixture
def ten_files(spark, tmp_path):
    for k in range(10):
        out = tmp_path / f"w{k}"
        spark.range(k * 3000, (k + 1) * 3000).selectExpr("id", "sha2(string(id), 256) as t").coalesce(1).write \
            .option("parquet.block.size", 4096).option("parquet.page.size", 2048).parquet(str(out))
        shutil.copy(next(out.glob("*.parquet")), tmp_path / f"f{k}.parquet")
    return tmp_path


def test_one_truncated_file_among_ten(spark, ten_files):
    f = ten_files / "f4.parquet"
    raw = f.read_bytes()
    f.write_bytes(raw[:len(raw) // 2])
    rows, rejects = read_with_rejects(spark, f"{ten_files}/f*.parquet", ["id"])
    assert sorted(r.id for r in rows.collect()) == [i for i in range(30_000) if i // 3000 != 4]
    (r,) = rejects.collect()
    assert r.source_file.endswith("f4.parquet") and r.rows_read == 0 and r.rows_held is None
    assert r.error.startswith("unreadable")


def test_a_damaged_page_keeps_the_rows_before_it(spark, ten_files):
    f = ten_files / "f7.parquet"
    raw = bytearray(f.read_bytes())
    at = len(raw) * 3 // 4
    raw[at:at + 4000] = bytes(4000)
    f.write_bytes(bytes(raw))
    rows, rejects = read_with_rejects(spark, f"{ten_files}/f*.parquet")
    (r,) = rejects.collect()
    kept = sorted(x.id for x in rows.where("id >= 21000 and id < 24000").collect())
    assert rows.where("id < 21000 or id >= 24000").count() == 27_000
    assert kept == list(range(21_000, 21_000 + len(kept))) and 0 <= len(kept) < 3000
    assert (r.rows_read, r.rows_held) == (len(kept), 3000) and "lost rows" in r.error


def test_nothing_to_reject_and_nothing_readable(spark, ten_files):
    spark.range(0).selectExpr("id", "'' as t").coalesce(1).write.parquet(str(ten_files / "none"))
    shutil.copy(next((ten_files / "none").glob("*.parquet")), ten_files / "f_none.parquet")
    rows, rejects = read_with_rejects(spark, f"{ten_files}/f*.parquet")
    assert rows.count() == 30_000 and rejects.count() == 0
    (ten_files / "x.parquet").write_bytes(b"nothing")
    rows, rejects = read_with_rejects(spark, f"{ten_files}/x.parquet", schema="id long")
    assert rows.columns[:1] == ["id"] and rows.count() == 0 and rejects.count() == 1
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"


def test_a_file_for_each_key(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(40).selectExpr("concat('d/', id % 3, '/k', id, '.bin') as name",
                                    "case when id > 0 then cast(repeat(string(id), 5) as binary) end as content")
    S.write_files(df.repartition(5), out)
    found = {os.path.relpath(os.path.join(b, f), out): open(os.path.join(b, f), "rb").read()
             for b, _, fs in os.walk(out) for f in fs}
    manifest = json.loads(found.pop(S.MANIFEST))
    assert found == {f"d/{k % 3}/k{k}.bin": (str(k) * 5).encode() if k else b"" for k in range(40)}
    assert manifest["files"] == 40 and manifest["bytes"] == sum(map(len, found.values()))
    with pytest.raises(Exception, match="exists"):
        S.write_files(df, out)
    assert len(found) == 40


@pytest.mark.parametrize("name", ["'same'", "cast(null as string)", "'../x'", "'/x'", "'_x'", "''", "'a/'"])
def test_odd_file_names_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError):
        S.write_files(spark.range(2).selectExpr(f"{name} as name", "cast('c' as binary) as content"),
                      str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()


def test_a_repeated_task_and_a_failed_job(spark, tmp_path):
    # two attempts of one task, the first lost after its files: nothing is doubled or left over
    out = str(tmp_path / "twice")

    class Task:
        @staticmethod
        def get():
            return type("C", (), {"partitionId": staticmethod(lambda: 0)})

    import pyarrow as pa
    import pyspark
    original, pyspark.TaskContext = pyspark.TaskContext, Task
    try:
        writer = S.RawFiles({"path": out, "kind": "files"}).writer(None, False)
        batch = pa.record_batch({"name": ["a", "b"], "content": [b"1", b"22"]})

        def dying():
            yield batch
            raise OSError("lost")
        with pytest.raises(OSError):
            writer.write(dying())
        message = writer.write(iter([batch]))
    finally:
        pyspark.TaskContext = original
    writer.commit([message])
    assert sorted(os.listdir(out)) == [S.MANIFEST, "a", "b"]
    failing = str(tmp_path / "failing")
    bad = spark.range(10).selectExpr("concat('n', id) as name",
                                     "cast(if(id = 7, raise_error('no'), 'x') as binary) as content")
    with pytest.raises(Exception):
        bad.write.format(S.FORMAT).mode("append").option("path", failing).option("kind", "files").save()
    assert not os.path.exists(failing)


def test_vector_dumps(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(500, 6)) * 10.0 ** rng.integers(-3, 4, (500, 1))).astype(np.float32)
    order = rng.permutation(500)
    df = spark.createDataFrame([(int(k), x[k].tolist()) for k in order], "vec_id long, embedding array<double>")
    path = str(tmp_path / "f32")
    manifest = S.dump_vectors(df.repartition(3), path, rows_per_part=90)
    assert manifest["rows"] == 500 and manifest["dimension"] == 6 and len(manifest["parts"]) > 2
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    raw = b"".join(open(f"{path}/{f}", "rb").read() for f in parts)
    assert raw == x.astype("<f4").tobytes()
    (tmp_path / "t.npy").write_bytes(open(f"{path}/header.npy", "rb").read() + raw)
    assert (np.load(tmp_path / "t.npy") == x).all()
    got = S.read_vectors(spark, path).orderBy("position").collect()
    assert [r.position for r in got] == list(range(500)) and (np.array([r.vector for r in got]) == x).all()
    S.dump_vectors(df, str(tmp_path / "b"), kind="bf16")
    got = np.array([r.vector for r in S.read_vectors(spark, str(tmp_path / "b")).orderBy("position").collect()])
    step = 2.0 ** (np.floor(np.log2(np.abs(x.astype(float)))) - 7)
    assert (got == np.rint(x / step) * step).all()
    odd = np.array([0.0, -0.0, np.inf, -np.inf, np.nan], np.float32)
    back = S.decode(S.encode(odd, "bf16"), "bf16")
    assert np.array_equal(back, odd, equal_nan=True)
    assert S.dump_vectors(df.limit(0), str(tmp_path / "e"))["rows"] == 0
    assert S.read_vectors(spark, str(tmp_path / "e")).count() == 0
    for bad in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [None, 1.0])]):
        with pytest.raises(Exception, match="dimension"):
            S.dump_vectors(spark.createDataFrame(bad, "vec_id long, embedding array<double>"), str(tmp_path / "x"))
        assert not (tmp_path / "x").exists()


def pixel_oracle(spark, images, patch, merge, temporal, width):
    """(item, t) -> values by ``vision.patchify``: a row for each pixel value."""
    rows = Z.pixel_rows(images, "item", "values", F.col("h"), F.col("w"), F.col("c"), rgb=True, carry=("w",))
    out: dict = {}
    for r in Z.patchify(rows, "item", "w", patch, merge, temporal).collect():
        out.setdefault((r.item, r.t), []).append((r.token, r.elem, r.c, r.v))
    return {k: bytes(v[3] for v in sorted(x)) for k, x in out.items()}


def test_dense_patches_equal_pixel_rows(spark):
    rng = np.random.default_rng(1)
    sizes = [(8, 12, 3), (4, 16, 1), (8, 8, 4)]
    rows = [(k, rng.integers(0, 256, h * w * c).tolist(), h, w, c) for k, (h, w, c) in enumerate(sizes * 3)]
    df = spark.createDataFrame(rows, "item int, values array<int>, h int, w int, c int")
    got = D.dense_patches(df, ["item"], D.pixel_bytes("values"), "h", "w", "c", patch=2, merge=2, temporal=2)
    assert {(r.item, r.t): bytes(r.patches) for r in got.collect()} == pixel_oracle(spark, df, 2, 2, 2, "w")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_a_frame_of_real_size_in_one_row(spark):
    rng = np.random.default_rng(3)
    frames = [rng.integers(0, 256, (384, 384, 3), dtype=np.uint8) for _ in range(3)]
    df = spark.createDataFrame([("v", k, bytearray(f.tobytes())) for k, f in enumerate(frames)],
                               "video string, at int, px binary")
    got = {r.t: r for r in D.dense_patches(df, ["video"], "px", F.lit(384), F.lit(384), F.lit(3),
                                           frame="at").collect()}
    assert sorted(got) == [0, 1] and got[0].grid_h == got[0].grid_w == 24
    y, x = np.mgrid[0:384, 0:384]
    token = ((y // 32) * 12 + x // 32) * 4 + (y // 16 % 2) * 2 + x // 16 % 2
    for t, pair in ((0, frames[:2]), (1, [frames[2]] * 2)):
        values = np.frombuffer(got[t].patches, np.uint8).reshape(576, 512, 3)
        for k, f in enumerate(pair):
            element = (k * 16 + y % 16) * 16 + x % 16
            assert (values[token, element] == f[:, :, ::-1]).all()


def test_odd_frames(spark):
    rows = [(1, bytearray(16), 4, 4), (2, None, 4, 4), (3, bytearray(15), 4, 4), (4, bytearray(20), 4, 5),
            (5, bytearray(0), -1, -1), (6, bytearray(16), None, 4)]
    df = spark.createDataFrame(rows, "item int, px binary, h int, w int")
    got = D.dense_patches(df, ["item"], "px", "h", "w", F.lit(1), patch=2, merge=2, temporal=1, rgb=False)
    assert {r.item: r.error for r in got.collect()} == {
        1: None, 2: "payload", 3: "payload", 4: "size", 5: "size", 6: "no frame"}
    assert D.dense_patches(df.limit(0), ["item"], "px", "h", "w", F.lit(1)).count() == 0
