"""Inline edge rows (the test tables do not cover them)."""

from pyspark.sql import functions as F

from loomprep.functions import text as T
from loomprep.functions.constants import ZH_IMAGE_PROMPTS
from loomprep.operators import messages as M
from loomprep.operators import prepare as P
from loomprep.operators import sequence as Q
from loomprep.operators import vision as Z
from loomprep.operators.sampling import quota_targets


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_cjk(spark):
    df = spark.createDataFrame([("描述图片内容",), ("describe",), ("ひらがな",), (None,)], "x string")
    assert [r.r for r in df.select(T.contains_cjk("x").alias("r")).collect()] == [True, False, False, False]


def test_whitespace_collapse_keeps_zwsp(spark):
    assert one(spark, T.normalize_text("x"), "a　b c\x1cd​e\n") == "a b c d​e"
    assert one(spark, T.normalize_text("x"), "a　b c\x1cd​e\n") == " ".join("a　b c\x1cd​e\n".split())


def test_cut_leaves_space(spark):
    assert one(spark, T.normalize_text("x", 3), "ab cd") == "ab "


def test_python_split_equivalence(spark):
    samples = ["  x\t\ty  ", "\x85a\xa0b c　", "\x1c\x1d\x1e\x1fz", "no-space", "", "​ ​"]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r.r for r in df.select(T.collapse_whitespace("x").alias("r")).collect()]
    assert got == [" ".join(s.split()) for s in samples]


def test_captions(spark):
    df = spark.createDataFrame([([" x ", "", None],), ([],), (None,)], "a array<string>")
    got = [r.c for r in df.select(M.pick_caption("a", F.lit(1)).alias("c")).collect()]
    assert got == ["x", "", ""]


def test_prompt_mode_source_empty_question(spark):
    df = spark.createDataFrame([("  ", 0), (None, 5), (" what  is it ", 1)], "q string, r long")
    got = [r.p for r in df.select(M.caption_prompt("q", "r", "source").alias("p")).collect()]
    assert got == [ZH_IMAGE_PROMPTS[0], ZH_IMAGE_PROMPTS[5 % 4], "what is it"]


def test_backfill_target(spark):
    _, tgt = quota_targets(10, 4, 6, F.lit(1))
    assert spark.range(1).select(tgt.alias("t")).first().t == 9


def test_admission_reasons(spark):
    df = spark.createDataFrame([(10, None), (11, None), (2048, None), (2049, None), (None, "boom")],
                               "n int, e string")
    got = [r.r for r in df.select(P.skip_reason("n", "e").alias("r")).collect()]
    assert got == ["short", None, None, "long", "error"]


def test_pixel_cap(spark):
    df = spark.createDataFrame([(800, 600), (100, 100)], "w int, h int")
    r = df.select(Z.pixel_cap_dims("w", "h", 147456).alias("d")).collect()
    assert (r[0].d.width, r[0].d.height) == (443, 333)
    assert (r[1].d.width, r[1].d.height) == (100, 100)


def test_visual_tokens(spark):
    df = spark.createDataFrame([(8, 384, 384)], "f int, h int, w int")
    g = df.select(Q.grid_thw("f", "h", "w").alias("g")).first().g
    assert (g.t, g.h, g.w) == (4, 24, 24)
    assert df.select(Q.visual_tokens(F.lit(4), F.lit(24), F.lit(24)).alias("n")).first().n == 576


def test_temporal_pad(spark):
    import datetime as dt
    rows = [(1, i, dt.datetime(2024, 1, 1, 0, i)) for i in range(5)]
    df = spark.createDataFrame(rows, "video long, frame long, ts timestamp")
    g = Z.temporal_groups(df, "video", ["ts", "frame"], temporal=2).orderBy("group_t", "slot").collect()
    assert [(r.group_t, r.frame) for r in g] == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 4), (2, 4)]


def test_system_message_and_language(spark):
    msgs = F.array(M.text_message("user", F.col("x")))
    got = one(spark, M.with_system_message(msgs), "描述这个视频")
    assert got[0].role == "system" and "中文" in got[0].content[0].text
    got = one(spark, M.with_system_message(F.array(M.text_message("system", F.lit("s")), M.text_message("user", F.col("x")))), "hi")
    assert [m.role for m in got] == ["system", "user"]
    assert one(spark, M.message_language(F.array().cast(M.MESSAGES)), "x") == "en"


def test_resize_dims(spark):
    df = spark.createDataFrame([(384, 384), (1000, 500), (100, 120)], "h int, w int")
    r = [(x.d.height, x.d.width) for x in df.select(Z.resize_dims("h", "w").alias("d")).collect()]
    assert r[0] == (384, 384)
    for h, w in r:
        assert h % 32 == 0 and w % 32 == 0 and 256 * 256 <= h * w <= 384 * 384 + 32 * 384


def test_bf16_round_matches_bits(spark):
    import numpy as np
    from loomprep.operators.vectors import bf16_round
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(0, 1, 2000), rng.normal(0, 1e-3, 500), [0.0, 1.0, -2.0, 3.0, 0.1]]).astype(np.float32)
    bits = vals.view(np.uint32).astype(np.uint64)
    rounded = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16 << 16).astype(np.uint32).view(np.float32)
    df = spark.createDataFrame([(float(v),) for v in vals], "x float")
    got = [r.y for r in df.select(bf16_round("x").alias("y")).collect()]
    assert np.array_equal(np.array(got, dtype=np.float32), rounded)


def test_trim_output(spark):
    df = spark.createDataFrame([([1, 2], [1, 2, 7, 8, 99, 5])], "i array<int>, o array<int>")
    assert one_row(df, Q.trim_output(F.col("i"), F.col("o"), 99, 128)) == [7, 8]
    assert one_row(df, Q.trim_output(F.col("i"), F.col("o"), 99, 1)) == [7]


def one_row(df, expr):
    return df.select(expr.alias("r")).first().r


def test_visual_mask_padding(spark):
    df = spark.createDataFrame([([1, 151655, 151656, 2],)], "ids array<int>")
    m = one_row(df, Q.visual_mask("ids", chunk=3))
    assert m == [False, True, True, False, False, False]


def test_assembly_gate_rejects_long_conversations(spark):
    from conftest import SF01
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    msgs, rej = M.assemble_conversations(conv, 300)
    sizes = {r.conv_id: r.n_tokens for r in M.conversation_sizes(conv).collect()}
    assert {r.conv_id for r in msgs.collect()} == {c for c, n in sizes.items() if n <= 300}
    assert {r.conv_id for r in rej.collect()} == {c for c, n in sizes.items() if n > 300}
    assert {r.skip_reason for r in rej.collect()} == {"long"}
    # the size is the rendered length of the stand-in renderer
    r = msgs.withColumn("enc", P.render_chat("messages", M.generation_flag("messages")))
    for row in r.select("conv_id", F.size("enc.input_ids").alias("n")).collect():
        assert row.n == sizes[row.conv_id]


def test_lift_messages_shapes(spark):
    df = spark.createDataFrame([("hello",)], "t string")
    m = df.select(M.lift_messages(F.col("t"), "text").alias("m")).first().m
    assert [(x.role, x.content[0].type, x.content[0].text) for x in m] == [("user", "text", "hello")]
    one_msg = df.select(M.lift_messages(M.text_message("assistant", F.col("t")), "message").alias("m")).first().m
    assert [x.role for x in one_msg] == ["assistant"]


def test_long_form_language_equals_array_form(spark):
    from conftest import SF01
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    a = {r.conv_id: r.lang for r in M.first_user_language(conv).collect()}
    b = {r.conv_id: r.lang for r in M.conversation_messages(conv)
         .select("conv_id", M.message_language("messages").alias("lang")).collect()}
    assert a == b
    zh = spark.createDataFrame([(1, 0, "system", "x"), (1, 1, "user", "描述"), (2, 0, "assistant", "y")],
                               "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.lang for r in M.first_user_language(zh).collect()} == {1: "zh", 2: "en"}


def test_block_shuffle_order(spark):
    from loomprep.operators.sampling import block_shuffle_order
    from loomprep.functions.hashing import seeded_key
    df = spark.range(0, 50).withColumn("k", seeded_key(1, "id"))
    got = [r.id for r in df.orderBy(*block_shuffle_order("id", "k", 10)).collect()]
    assert sorted(got[:10]) == list(range(10)) and sorted(got[40:]) == list(range(40, 50))
    assert got[:10] != list(range(10))


def test_next_positions(spark):
    ids = [11, 151652, 151655, 151655, 151655, 151655, 12]
    t = spark.createDataFrame([(0, p, x) for p, x in enumerate(ids)], "sample_id long, pos int, token_id int")
    g = spark.createDataFrame([(0, "image", 0, 1, 4, 4)], "sample_id long, modality string, ordinal int, t int, h int, w int")
    r = Q.next_positions(Q.sequence_positions(t, g)).first()
    assert (r.next_pos, r.delta) == (5, -2)


def test_patch_vectors(spark):
    rows = [(0, 0, y, x, 0, y * 4 + x) for y in range(4) for x in range(4)]
    df = spark.createDataFrame(rows, "item long, frame int, y int, x int, c int, v int")
    p = Z.patch_vectors(Z.patchify(df, "item", 4, patch=2, merge=1, temporal=1), "item")
    got = {r.token: r.values for r in p.collect()}
    assert got[0] == [0, 1, 4, 5] and got[3] == [10, 11, 14, 15]


def test_render_length_equals_rendered_size(spark):
    from conftest import SF01
    conv = spark.read.parquet(f"{SF01}/conversations.parquet")
    m = M.conversation_messages(conv)
    m = m.withColumn("messages", F.when(F.col("conv_id") < 5, F.concat(
        F.array(M.message("user", M.media_item("image", F.lit("x")), M.text_item(F.lit("a b")))),
        F.col("messages"))).otherwise(F.col("messages")))
    gen = M.generation_flag("messages")
    r = m.select(F.size(P.render_chat("messages", gen)["input_ids"]).alias("a"),
                 P.render_length("messages", gen).alias("b")).collect()
    assert all(x.a == x.b for x in r) and len(r) > 0


def test_normalize_matches_python_on_random_unicode(spark):
    import random
    from loomprep.functions.constants import WHITESPACE_CHARS
    rng = random.Random(11)
    alphabet = list(WHITESPACE_CHARS) + list("abc xyz") + ["​", "一", "鿿", "あ", "\U0001F600",
                                                            "é", "é", "﻿", "\x00", "⁠"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: (r.n, r.l) for r in df.select("i", T.normalize_text("t", 17).alias("n"),
                                              F.length(T.normalize_text("t", 17)).alias("l")).collect()}
    for i, t in enumerate(texts):
        want = " ".join(t.split())[:17]
        assert got[i] == (want, len(want)), (t, got[i])


def test_render_error_becomes_error_reject(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, None), (3, "x")], "id long, t string")
    msgs = F.array(M.text_message("user", F.col("t")))
    enc = df.select("id", P.render_chat(msgs, F.lit(False)).alias("e")).select("id", "e.input_ids", "e.error")
    ok, rej = P.length_admission(enc)
    assert [r.id for r in ok.collect()] == [1]
    assert {r.id: r.skip_reason for r in rej.collect()} == {2: "error", 3: "short"}
    empty = spark.createDataFrame([(1,)], "k int").select(F.array().cast(M.MESSAGES).alias("m"))
    assert empty.select(P.render_chat("m", F.lit(False))["error"].alias("e")).first().e == "render_failed"


def test_canonical_messages_shapes(spark):
    a = spark.createDataFrame([([("user", "描述")],)], "messages array<struct<role:string,content:string>>")
    m = a.select(M.canonical_messages(a).alias("m")).first().m
    assert m[0].content[0].type == "text" and m[0].content[0].text == "描述"
    assert a.select(M.message_language(M.canonical_messages(a)).alias("l")).first().l == "zh"
    b = spark.createDataFrame([(("assistant", [("text", "hi")]),)],
                              "messages struct<role:string,content:array<struct<type:string,text:string>>>")
    mb = b.select(M.canonical_messages(b).alias("m")).first().m
    assert [(x.role, x.content[0].text, x.content[0].image_ref) for x in mb] == [("assistant", "hi", None)]
    c = spark.createDataFrame([("plain text",)], "messages string")
    mc = c.select(M.canonical_messages(c).alias("m")).first().m
    assert [(x.role, x.content[0].text) for x in mc] == [("user", "plain text")]


def test_pixel_rows_channels(spark):
    df = spark.createDataFrame([(1, bytearray([10, 20, 30, 255]), 4), (2, bytearray([7]), 1),
                                (3, bytearray([1, 2, 3]), 3)], "k long, d binary, nc int")
    px = df.select("k", F.transform(F.expr("transform(sequence(0, length(d) - 1), i -> ascii(substr(d, i + 1, 1)))"),
                                    lambda x: x).alias("p"), "nc")
    rows = Z.pixel_rows(px, "k", "p", F.lit(1), F.lit(1), F.col("nc")).collect()
    got = sorted((r.k, r.c, r.v) for r in rows)
    assert got == [(1, 0, 30), (1, 1, 20), (1, 2, 10), (2, 0, 7), (2, 1, 7), (2, 2, 7), (3, 0, 3), (3, 1, 2), (3, 2, 1)]


def test_vector_candidates_first_hit_wins(spark):
    from loomprep.operators.vectors import vector_export
    df = spark.createDataFrame([(1, None, [1.0, 2.0]), (2, [3.0, 4.0], [5.0, 6.0])],
                               "vec_id long, `llm.model.embed_tokens.weight` array<float>, `embed_tokens.weight` array<float>")
    got = {r.vec_id: r.vector for r in vector_export(df, bf16=False).collect()}
    assert got == {1: [1.0, 2.0], 2: [3.0, 4.0]}
    import pytest
    with pytest.raises(KeyError):
        vector_export(spark.range(1).withColumnRenamed("id", "vec_id"))


def test_image_message_flags(spark):
    df = spark.createDataFrame([("请描述", "a cat")], "p string, c string")
    m = df.select(M.image_messages("p", "c", F.lit("item:1"), use_assistant=True,
                                   require_lang_match=False, system=False).alias("m")).first().m
    assert [x.role for x in m] == ["user", "assistant"]
    assert [i.type for i in m[0].content] == ["image", "text"] and m[1].content[0].text == "a cat"
    m2 = df.select(M.image_messages("p", "c", F.lit("item:1"), use_assistant=True).alias("m")).first().m
    assert [x.role for x in m2] == ["system", "user"]          # languages differ: no assistant turn
    assert "中文" in m2[0].content[0].text
    m3 = df.select(M.image_messages("p", "c", F.lit("item:1"), system_override="Be brief.").alias("m")).first().m
    assert m3[0].content[0].text == "Be brief."
