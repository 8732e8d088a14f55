"""Cases beyond the test tables: long conversations, many turns, null keys,
outlying ids, file specs as URIs, images given by path, empty sets."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from loomprep.operators import messages as M
from loomprep.operators import prepare as P
from loomprep.operators import ranking as R
from loomprep.operators import vision as Z
from loomprep.plans import catalog
from loomprep.plans.compare import compare
from loomprep.session import ensure_checkpoint_dir
from loomprep.sources import captioned as C
from loomprep.sources import files as FS
from loomprep.sources import tokens as K
from loomprep.streaming import text_stream as ST

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_tables(spark, tmp_path_factory):
    """The test tables with a 20-turn, a 3,000-word and a Chinese conversation."""
    folder = tmp_path_factory.mktemp("long")
    for name in os.listdir(SF):
        if not name.startswith("conversations"):
            os.symlink(f"{SF}/{name}", folder / name)
    rows = [(9001, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of many words") for t in range(20)]
    rows += [(9002, 0, "user", "w " * 3000), (9002, 1, "assistant", "v " * 10)]
    rows += [(9003, 0, "user", "描述图片内容 please"), (9003, 1, "assistant", "好的 图片")]
    one = folder / "one"
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    df.union(spark.createDataFrame(rows, df.schema)).coalesce(1).write.parquet(str(one))
    part = next(f for f in os.listdir(one) if f.endswith(".parquet"))
    shutil.copy(one / part, folder / "conversations.parquet")
    return str(folder)


@pytest.mark.parametrize("name,key,want", [
    ("conversation_messages", "conv_id", {9001, 9002, 9003}), ("message_language", "conv_id", {9002, 9003}),
    ("with_system_message", "conv_id", {9002, 9003}), ("generation_flag", "conv_id", {9002}),
    ("render_chat", "conv_id", {9002}), ("same_language", "conv_id", {9001, 9003}),
    ("sequence_chunks", "sample_id", {(9002 << 32)}), ("capacity_reasons", "sample_id", {(9002 << 32)}),
    ("sequence_positions", "sample_id", {(9001 << 32) + t for t in range(20)})])
def test_nothing_is_cut(spark, long_tables, name, key, want):
    df = catalog.QUERIES[name](spark, long_tables)
    assert compare(df, catalog.ORACLE[name], long_tables)["match"]
    assert want <= {r[0] for r in df.select(key).distinct().collect()}


def test_languages_differ(spark, long_tables):
    got = {r.conv_id: r.lang for r in catalog.QUERIES["message_language"](spark, long_tables).collect()}
    assert got[9003] == "zh" and got[9001] == "en"
    head = catalog.QUERIES["with_system_message"](spark, long_tables).where("conv_id = 9003").first()
    assert M.SYSTEM_PROMPT_ZH == head.first_text and head.n_messages == 3
    reasons = {r.sample_id: r.skip_reason for r in
               catalog.QUERIES["capacity_reasons"](spark, long_tables).collect()}
    assert reasons[9002 << 32] == "over_context"


def test_turns_have_ids_of_their_own(spark):
    rows = [(c, t, "assistant", "a\nb") for c in range(3) for t in range(40)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pages = spark.createDataFrame([(k, "u", "h") for k in range(200)], "page_id long, url string, html string")
    assert K.text_sequences(conv).select("sample_id").distinct().count() == 120
    c = C.captioned_images(conv, pages)
    assert c.select("item_id").distinct().count() == c.count() == 120


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(3, True), (None, True), (1, True), (7, True)], "id long, ok boolean")
    got = {r.id: r.valid_rank for r in R.valid_rank(df, "ok", "id").collect()}
    assert got == {None: 0, 1: 1, 3: 2, 7: 3}
    frames = spark.createDataFrame([(1, None, 5), (None, "2024-01-01", 6), (None, None, 7), (1, "2024-01-01", 8)],
                                   "video long, at string, n long").withColumn("at", F.to_timestamp("at"))
    out = Z.temporal_groups(frames, "video", ["at", "n"], temporal=2).where("not is_pad").collect()
    assert sorted(r.n for r in out) == [5, 6, 7, 8]


def test_rank_buckets_follow_the_ids(spark):
    n = 100_000
    outlier = spark.range(n).union(spark.createDataFrame([(10 ** 12,)], "id long"))
    files = spark.range(n).select((F.shiftleft(F.col("id") % 64, 40) + F.col("id")).alias("id"))
    for df in (outlier, files):
        held = df.groupBy(R.range_bucket(df, "id").alias("b")).count()
        assert held.count() > 1000 and held.agg(F.max("count")).first()[0] < n // 100
        ranked = R.valid_rank(df, F.lit(True), "id")
        want = {k: r for r, k in enumerate(sorted(r.id for r in df.collect()))}
        assert {r.id: r.valid_rank for r in ranked.collect()} == want


@pytest.fixture
def captioned_folder(spark, tmp_path):
    folder = tmp_path / "a folder+x%20"
    folder.mkdir()
    for k, name in enumerate(["y[1].parquet", "b.parquet"]):
        out = tmp_path / f"w{k}"
        spark.createDataFrame([(f"q{k}", ["c"])], "question string, answer array<string>").coalesce(1) \
            .write.parquet(str(out))
        shutil.copy(next(out.glob("*.parquet")), folder / name)
    return folder


def test_file_specs(spark, captioned_folder):
    d = captioned_folder
    questions = lambda spec: [r.question for r in C.read_captioned(spark, spec).orderBy("item_id").collect()]
    assert FS.resolve_data_files(f"{d}/y[1].parquet") == [f"{d}/y[1].parquet"]
    assert questions(f"{d}/y[1].parquet,{d}/b.parquet,{d}/y[1].parquet") == ["q0", "q1", "q0"]
    assert questions(f"{d}/*.parquet") == ["q1", "q0"]
    assert questions(f"file://{d}/b.parquet") == ["q1"]
    assert questions(f"file://{d}/*.parquet") == ["q1", "q0"]
    for missing in (f"{d}/none.parquet", f"file://{d}/none.parquet", f"file://{d}/*.none"):
        with pytest.raises(FileNotFoundError):
            C.read_captioned(spark, missing)


def test_images_by_path(spark):
    image = "struct<bytes:binary,path:string>"
    rows = [(1, ["c"], (b"x", None)), (2, ["c"], (None, "p1")), (3, ["c"], (None, "p2")), (4, ["c"], None)]
    df = C.normalize_captioned(spark.createDataFrame(rows, f"item_id long, answer array<string>, image {image}"))
    files = spark.createDataFrame([("p1",), ("p1",)], "path string")
    got = {r.item_id: r.has_image for r in C.with_found_images(df, files).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}


def test_large_image_and_empty_set(spark):
    df = spark.createDataFrame([(50_000, 50_000)], "w int, h int")
    r = df.select(Z.pixel_cap_dims("w", "h").alias("d")).first().d
    assert r.width == r.height == 384
    empty = spark.createDataFrame([], "attention_mask array<tinyint>, has_image boolean")
    with pytest.raises(Exception, match="no usable batches"):
        P.token_totals(empty).collect()
    assert P.token_totals(empty, require=False).first().batches == 0


def test_quota_not_reached_is_reported(spark, tmp_path):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    d.limit(20).write.parquet(str(tmp_path / "in"))
    rows, state = ST.collect_until_quota(
        spark, ST.text_stream(spark, str(tmp_path / "in"), d.schema).select("doc_id"), 50, "doc_id", timeout=3)
    assert rows.count() == 20 and state["complete"] is False


def test_state_read_failure_is_raised(spark, tmp_path):
    broken = tmp_path / "state" / "batch=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        ST._rows_before(spark, str(tmp_path / "state"), 5)
    assert ST._rows_before(spark, str(tmp_path / "nothing"), 5) == 0


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_sort_limit_is_checked(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(5)], "seq long, n_tokens int")
    assert P.sort_by_length(df, "desc", max_rows=5).count() == 5
    with pytest.raises(Exception, match="more than 4 rows"):
        P.sort_by_length(df, "desc", max_rows=4).collect()
