"""Rows that share an id, or have none, keep their identity in the mixes; frequent ids
are split; a busy hour of one video is ranked by many tasks."""

import os
from collections import Counter

from pyspark.sql import functions as F

from loomprep.operators import calibration as C
from loomprep.operators import ranking as R
from loomprep.operators import sampling as S
from loomprep.operators import sequence as Q
from loomprep.operators import vision as Z
from loomprep.plans import text_queries as T
from loomprep.plans.compare import compare


def test_round_robin_takes_each_row_once(spark):
    rows = [(5, "en", "x" * 200), (5, "en", "y" * 200), (5, "en", "y" * 200), (None, "en", "z" * 200),
            (None, "fr", "w" * 200), (7, "fr", None), (8, "fr", "v" * 300), (None, "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = S.round_robin_mix(df, "en,fr", 50, min_chars=1, languages=["en", "fr"])
    taken = Counter((r.doc_id, r.lang, r.text) for r in got.collect())
    assert all(n <= Counter(rows)[k] for k, n in taken.items())
    assert sorted(r.seq for r in got.collect()) == list(range(sum(taken.values())))
    alone = S.round_robin_mix(df, "en", 50, min_chars=1)
    assert Counter((r.doc_id, r.text) for r in alone.collect()) == Counter(
        (i, t) for i, l, t in rows if l == "en" and t)


def test_repeated_and_null_ids_match_the_sql(spark, tmp_path):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    some = d.where("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") - 7)
    null = d.where("doc_id % 11 = 0").withColumn("doc_id", F.lit(None).cast("long"))
    d.union(some).union(some).union(null).toPandas().astype({"doc_id": "Int64"}).to_parquet(
        tmp_path / "documents.parquet")
    for f in os.listdir("/root/testdata/sf0.001"):
        if f != "documents.parquet":
            os.symlink(f"/root/testdata/sf0.001/{f}", tmp_path / f)
    r = compare(T.round_robin_mix(spark, str(tmp_path)), T._rr_sql(T.NUM_CALIB), str(tmp_path))
    assert r["match"] and r["spark_rows"] > 30, r


def test_each_image_sample_is_taken_once(spark):
    rows = [(5, "q1", ["a"], True), (5, "q1", ["a"], True), (5, "q2", ["b"], True), (None, "q3", ["c"], True),
            (None, "q3", ["d"], True), (6, None, None, True), (7, "q4", ["e"], False), (8, "", [None], True),
            (8, None, [None], True), (9, "q5", ["f", "g"], True)]
    df = spark.createDataFrame(rows, "item_id long, question string, answer array<string>, has_image boolean")
    valid = [r for r in rows if r[3]]
    got = C.sampled_images(df, F.lit(100), 100, use_assistant=False).collect()
    assert Counter(r.item_id for r in got) == Counter(r[0] for r in valid)
    assert len(got) == len(valid) and len({r.shuffle_key for r in got}) == len(valid)
    for n in (1, 3, 6):          # a smaller sample is a part of the larger one
        less = C.sampled_images(df, F.lit(n), 100).collect()
        assert len(less) == n and not Counter(map(repr, less)) - Counter(map(repr, got))
    again = C.sampled_images(df.repartition(5, "question"), F.lit(100), 100, use_assistant=False).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, got))


def test_frequent_ids_are_split_by_their_share(spark):
    n = 60_000
    tokens = spark.range(n).select(F.col("id").alias("sample_id"), F.lit(0).alias("pos"), F.when(
        F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 11).otherwise(F.col("id") % 5000).cast("int").alias("token_id"))
    vectors = spark.range(4900).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float")).alias("embedding"))
    ways = {r["_hot"]: r["_ways"] for r in Q.frequent_ways(tokens, "token_id", 32).collect()}
    assert set(ways) == {7, 11} and ways[7] in (11, 12) and ways[11] in (3, 4)
    want = Q.embedding_gather(tokens, vectors)
    got = Q.embedding_gather(tokens, vectors.hint("shuffle_hash"), salt="auto")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = sorted(r.n for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert held[-1] <= 3 * held[len(held) // 2], held
    none = tokens.where("sample_id < 0")
    assert Q.embedding_gather(none, vectors, salt="auto").count() == 0


def test_a_busy_hour_is_split(spark):
    events = spark.range(40_000).selectExpr("id as event_id", "if(id % 3 = 0, 1, id % 50) as user_id",
                                            "timestamp_seconds(1700000000 + id / 40) as ts")
    held = events.groupBy("user_id", Z._order_bucket(events, "ts").alias("b")).count()
    assert held.agg(F.max("count")).first()[0] < 200
    got = Z.temporal_groups(events, "user_id", ["ts", "event_id"], temporal=2)
    first = {(r.user_id, r.event_id): r.frame_idx for r in got.where("not is_pad").collect()}
    seen: Counter = Counter()
    for e in range(40_000):
        u = 1 if e % 3 == 0 else e % 50
        assert first[u, e] == seen[u]
        seen[u] += 1


def test_range_bucket_is_one_literal(spark):
    df = spark.range(5000)
    bucket = R.range_bucket(df, "id")
    assert str(df.select(bucket)._jdf.queryExecution().optimizedPlan()).count("percentile") == 0
    got = [r.b for r in df.select("id", bucket.alias("b")).orderBy("id").collect()]
    assert got == sorted(got) and len(set(got)) > 1500
    assert df.limit(0).select(R.range_bucket(df.limit(0), "id")).count() == 0
