"""Padded batches of samples whose keys repeat or are null."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from loomprep.operators import sequence as Q
from loomprep.plans import catalog
from loomprep.plans.compare import compare
from loomprep.sources import tokens as K
from test_plans import plan


def test_every_sample_is_in_one_batch(spark):
    rows = [(1, [1]), (1, [1, 2]), (1, [1, 2, 3]), (2, [4]), (None, [5, 6]), (None, [5]), (3, [])]
    df = spark.createDataFrame(rows, "sample_id long, input_ids array<int>")
    got = Q.pad_batches(df, 2).collect()
    real = Counter((r.sample_id, tuple(i for i, m in zip(r.input_ids, r.attention_mask) if m)) for r in got)
    assert real == Counter((k, tuple(v)) for k, v in rows)
    assert sorted((r.batch_id, r.slot) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]
    assert [r.sample_id for r in sorted(got, key=lambda r: (r.batch_id, r.slot))] == [1, 1, 1, 2, 3, None, None]
    for r in got:
        assert len(r.input_ids) == max(len(x.input_ids) for x in got if x.batch_id == r.batch_id)


@pytest.mark.parametrize("name", ["pad_batches", "mask_positions"])
def test_repeated_and_null_keys_match_the_sql(spark, tmp_path, name):
    for f in os.listdir(SF001):
        if f != "conversations.parquet":
            os.symlink(f"{SF001}/{f}", tmp_path / f)
    conv = spark.read.parquet(f"{SF001}/conversations.parquet").limit(40)
    some = conv.where(F.col("turn") < 2)
    null = conv.limit(1).withColumn("conv_id", F.lit(None).cast(conv.schema["conv_id"].dataType))
    both = conv.union(some).union(some.limit(5)).union(null).union(null).union(
        null.withColumn("turn", F.lit(None).cast(conv.schema["turn"].dataType)))
    both.toPandas().astype({"conv_id": "Int64", "turn": "Int32"}).to_parquet(tmp_path / "conversations.parquet")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    r = compare(df, catalog.ORACLE[name], str(tmp_path))
    assert r["match"] and r["spark_rows"] > 40, r


def test_token_rows_are_sorted_once_and_not_shuffled(spark):
    p = plan(catalog.QUERIES["mask_positions"](spark, SF001))
    above = p[:p.index("Generate posexplode")]       # what is done with token rows
    assert above.count("Sort [") == 1 and "Exchange" not in above, above


def test_token_rows_of_a_task_follow_the_limit_not_the_table(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 4000, raising=False)
    df = catalog.QUERIES["mask_positions"](spark, SF001)
    per = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per) <= 4000 < sum(per), per
    r = compare(df, catalog.ORACLE["mask_positions"], SF001)
    assert r["match"], r


def test_row_tasks_hold_for_any_text(spark, monkeypatch):
    df = spark.createDataFrame([("a " * 3000,), ("a",), ("",), (None,)], "text string")
    least = spark.sparkContext.defaultParallelism
    assert K.row_tasks(df, 4) == K.row_tasks(df.where("text is null")) == least
    monkeypatch.setattr(K, "ROWS_PER_TASK", 100)
    for copies in (1, 4):                # 3,000 words and one
        assert K.row_tasks(df, copies) == -(-3001 * copies // 100) > least


def test_masks_of_unpartitioned_rows_with_repeated_and_null_keys(spark):
    """Each row's own length and positions, the largest position of all rows of its sample_id."""
    masks = {(1, 0): [0, 1, 1, 1], (1, 1): [1, 1], (None, 2): [0, 0, 0], (None, 3): [1], (2, 4): [1, 0, 1]}
    rows = [(k, slot, pos, 7, m) for (k, slot), ms in masks.items() for pos, m in enumerate(ms)]
    df = spark.createDataFrame(rows[::-1], "sample_id long, slot int, pos int, token_id int, mask int")
    got = Q.mask_positions(df, ["slot"])
    assert got.columns == [*df.columns, "position", "delta"]
    by = {}
    for r in got.orderBy("slot", "pos").collect():
        by.setdefault(r.slot, []).append((r.position, r.delta))
    assert by == {0: [(1, -1), (0, -1), (1, -1), (2, -1)], 1: [(0, 1), (1, 1)], 2: [(1, -1)] * 3, 3: [(0, 1)],
                  4: [(0, -1), (1, -1), (1, -1)]}
