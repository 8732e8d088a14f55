"""File spec resolution, image frames, patch sink."""

import os
import struct
import tempfile
import zlib

import pytest
from pyspark.sql import functions as F

from loomprep.sources import files as FS


def touch(p, data=b"x"):
    with open(p, "wb") as f:
        f.write(data)


def test_resolve_data_files():
    d = tempfile.mkdtemp()
    for n in ["b.parquet", "a.parquet", "c.txt"]:
        touch(os.path.join(d, n))
    os.mkdir(os.path.join(d, "z.parquet"))
    got = FS.resolve_data_files(f" {d}/*.parquet , ,{d}/c.txt,{d}/a.parquet")
    assert got == [f"{d}/a.parquet", f"{d}/b.parquet", f"{d}/c.txt", f"{d}/a.parquet"]
    assert FS.resolve_data_files("c.txt", base_dir=d) == [f"{d}/c.txt"]
    with pytest.raises(FileNotFoundError):
        FS.resolve_data_files(f"{d}/missing.parquet")
    with pytest.raises(FileNotFoundError):
        FS.resolve_data_files(f"{d}/*.none")
    with pytest.raises(ValueError):
        FS.resolve_data_files(" , ")


def test_read_parquet_files_prunes(spark):
    from conftest import SF01
    df = FS.read_parquet_files(spark, f"{SF01}/conversations.parquet", ["question", "answer", "text", "role"])
    assert df.columns == ["text", "role", "source_file"]


def png(width, height, rgb):
    raw = b"".join(b"\x00" + bytes(rgb[y * width * 3:(y + 1) * width * 3]) for y in range(height))

    def chunk(kind, data):
        c = struct.pack(">I", len(data)) + kind + data
        return c + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_frames_in_path_order_and_bgr(spark):
    d = tempfile.mkdtemp()
    vid = os.path.join(d, "video1")
    os.mkdir(vid)
    for i in [2, 10, 1]:
        touch(os.path.join(vid, f"f{i}.png"), png(2, 2, [i, 20, 30] * 4))
    fr = FS.read_frames(spark, vid).orderBy("frame_idx").collect()
    assert [os.path.basename(r.origin) for r in fr] == ["f1.png", "f10.png", "f2.png"]
    assert [r.frame_idx for r in fr] == [0, 1, 2]
    assert list(fr[0].data[:3]) == [30, 20, 1]            # BGR order in Spark's image source


def test_patch_sink_fails_if_exists(spark):
    d = tempfile.mkdtemp()
    df = spark.range(3)
    FS.write_patches(df, os.path.join(d, "p"))
    with pytest.raises(Exception):
        FS.write_patches(df, os.path.join(d, "p"))


def test_safe_source_reports(spark):
    df, st = FS.safe_source(lambda: spark.read.parquet("/nonexistent/x.parquet"), "a long", spark, "wiki")
    assert df.count() == 0 and st["ok"] is False and "wiki" == st["source"]


def test_payload_choice(spark):
    from loomprep.sources.captioned import with_payload
    rows = [(1, bytearray(b"abc"), "/x/a.png"), (2, bytearray(b""), "/x/b.png"), (3, None, "/x/missing.png"), (4, None, None)]
    df = spark.createDataFrame(rows, "item_id long, b binary, p string") \
        .selectExpr("item_id", "named_struct('bytes', b, 'path', p) AS image")
    files = spark.createDataFrame([("/x/a.png", bytearray(b"FILE-A")), ("/x/b.png", bytearray(b"FILE-B"))],
                                  "path string, data binary")
    got = {r.item_id: (bytes(r.payload) if r.payload is not None else None)
           for r in with_payload(df, files).collect()}
    assert got == {1: b"abc", 2: b"FILE-B", 3: None, 4: None}


def test_decode_bytes_with_caller_decoder(spark):
    from pyspark.sql import types as T
    from loomprep.operators.inference import decode_bytes

    def png_size(b):
        if b[:8] != b"\x89PNG\r\n\x1a\n":
            return None
        w, h = struct.unpack(">II", b[16:24])
        return {"width": w, "height": h}

    rt = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
    df = spark.createDataFrame([(1, bytearray(png(3, 2, [0] * 18))), (2, bytearray(b"junk")), (3, None)],
                               "id long, b binary")
    got = {r.id: (r.d.width, r.d.height) for r in df.select("id", decode_bytes("b", png_size, rt).alias("d")).collect()}
    assert got == {1: (3, 2), 2: (None, None), 3: (None, None)}


def test_apply_tokenizer_matches_stand_in_and_captures_errors(spark):
    import hashlib
    from conftest import SF01
    from pyspark.sql import functions as F
    from loomprep.operators import messages as M, prepare as P
    from loomprep.operators.inference import apply_tokenizer

    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers do not import tests
    vocab, start, end = P.DEFAULT_VOCAB, P.MSG_START_ID, P.MSG_END_ID

    def hid(w):
        return int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % vocab

    def tokenize(msgs, gen):
        out = []
        for m in msgs:
            if m["role"] == "boom":
                raise ValueError("bad role")
            out += [start, hid(m["role"])]
            for it in m["content"]:
                out += [hid(w) for w in (it["text"] or "").split()]
            out.append(end)
        return out + ([start, hid("assistant")] if gen else [])

    conv = spark.read.parquet(f"{SF01}/conversations.parquet").where(F.col("conv_id") < 20)
    m = M.conversation_messages(conv)
    gen = M.generation_flag("messages")
    r = m.select("conv_id", P.render_chat("messages", gen)["input_ids"].alias("a"),
                 apply_tokenizer("messages", gen, tokenize).alias("b")).collect()
    assert all(x.a == x.b.input_ids and x.b.error is None for x in r)
    bad = spark.createDataFrame([(1,)], "k int").select(
        F.array(M.text_message(F.lit("boom"), F.lit("x"))).alias("messages"))
    e = bad.select(apply_tokenizer("messages", F.lit(False), tokenize).alias("t")).first().t
    assert e.input_ids is None and "bad role" in e.error


def test_read_captioned_order_repeats_and_scalar_answers(spark):
    from pyspark.sql import functions as F
    from loomprep.sources.captioned import read_captioned
    d = tempfile.mkdtemp()
    a = spark.createDataFrame([("q1", " cap a "), ("q2", None)], "question string, answer string")
    a.coalesce(1).write.parquet(os.path.join(d, "a"))
    b = spark.createDataFrame([("q3", " cap b ")], "question string, answer string")
    b.coalesce(1).write.parquet(os.path.join(d, "b"))
    fa = [f for f in os.listdir(os.path.join(d, "a")) if f.endswith(".parquet")][0]
    fb = [f for f in os.listdir(os.path.join(d, "b")) if f.endswith(".parquet")][0]
    spec = f"{d}/b/{fb}, {d}/a/*.parquet, {d}/b/{fb}"
    rows = read_captioned(spark, spec).orderBy("item_id").collect()
    assert [r.question for r in rows] == ["q3", "q1", "q2", "q3"]
    assert rows[1].answer == [" cap a "] and rows[2].answer is None
    assert all(r.image is None and r.has_image is False for r in rows)
