"""The stream's shuffle buffer: order, bounded state, early stop, repeated batches."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loomprep.session import ensure_checkpoint_dir
from loomprep.streaming import shuffle_buffer as SB
from loomprep.streaming import text_stream as ST

SCHEMA = "doc_id long, lang string, n long"
LANGS = ["en", "fr", None]


def folder_of(spark, files, rows_each=60):
    """``files`` parquet files with rising doc_ids, the oldest first."""
    src, rows = tempfile.mkdtemp(prefix="loomprep-buffer-"), []
    for k in range(files):
        part = [(k * rows_each + i, LANGS[(i * i + k) % 3], 7 * i) for i in range(rows_each)]
        out = tempfile.mkdtemp(prefix="loomprep-part-")
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("overwrite").parquet(out)
        (one,) = [f for f in os.listdir(out) if f.endswith(".parquet")]
        path = os.path.join(src, f"f{k:02d}.parquet")
        os.link(os.path.join(out, one), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
        rows += part
    return src, rows


def plain_order(rows, buffer, seed=42):
    """arrival_index of each row: blocks of the arrival order, each sorted by its hash."""
    out = {}
    for lang in LANGS:
        mine = [r for r in rows if r[1] == lang]
        for at in range(0, len(mine), buffer):
            block = sorted(mine[at:at + buffer], key=lambda r: hashlib.md5(
                f"{seed}:{r[0]}".encode()).hexdigest())
            out |= {r[0]: at + k for k, r in enumerate(block)}
    return out


def stream_of(spark, src):
    return ST.text_stream(spark, src, SCHEMA, max_files_per_trigger=1)


def run(spark, src, **kw):
    return SB.shuffled_until_quota(spark, stream_of(spark, src), "lang", "doc_id", arrival=["doc_id"], **kw)


def test_whole_stream_in_buffer_order(spark):
    src, rows = folder_of(spark, 4)
    got, report = run(spark, src, buffer=32)
    assert {r.doc_id: r.arrival_index for r in got.collect()} == plain_order(rows, 32)
    assert sorted((r.doc_id, r.lang, r.n) for r in got.collect()) == sorted(rows)
    assert not report["stopped"] and sum(report["input_rows"]) == len(rows)


def test_stops_after_the_files_needed_and_repeats_its_last_batch(spark):
    src, rows = folder_of(spark, 10)
    name = "buffer-" + os.path.basename(src)
    want = {i: a for i, a in plain_order(rows, 16).items() if a < 40}
    got, report = run(spark, src, buffer=16, quota=40, keys=["en", "fr", ""], name=name)
    assert {r.doc_id: r.arrival_index for r in got.collect()} == want
    # the third language file fills every buffer to its 48th row: no further file is read
    held = {lang: 0 for lang in LANGS}
    for needed in range(10):
        for r in rows[needed * 60:(needed + 1) * 60]:
            held[r[1]] += 1
        if min(n // 16 * 16 for n in held.values()) >= 40:
            break
    assert report["stopped"] and report["batches"] == list(range(needed + 1)) and needed < 9
    assert sum(report["input_rows"]) <= (needed + 1) * 60
    # the last batch was not committed: it runs once more from the state before it
    again, second = run(spark, src, buffer=16, quota=40, keys=["en", "fr", ""], name=name)
    assert second["batches"] == [needed] and second["stopped"]
    assert {r.doc_id: r.arrival_index for r in again.collect()} == want


def test_state_stays_below_the_buffer(spark):
    src, rows = folder_of(spark, 5)
    name = "state-" + os.path.basename(src)
    run(spark, src, buffer=24, name=name)
    checkpoint = f"{ensure_checkpoint_dir(spark)}/{name}/_checkpoint"
    for batch in range(5):
        held = (spark.read.format("statestore").option("stateVarName", "held").option("batchId", batch)
                .load(checkpoint).groupBy("key._key").count().collect())
        seen = rows[:(batch + 1) * 60]
        assert {r[0]: r[1] for r in held} == {
            lang or "": n for lang in LANGS if (n := sum(r[1] == lang for r in seen) % 24)}
    left = SB.left_in_buffers(spark, checkpoint, 24)
    assert left.groupBy("_key").count().agg(F.max("count")).first()[0] < 24


@pytest.mark.parametrize("keys", [(), ("en", "xx")])
def test_short_and_empty_streams(spark, keys):
    src, rows = folder_of(spark, 2, rows_each=5)
    got, report = run(spark, src, buffer=1000, quota=3, keys=keys)
    want = {i: a for i, a in plain_order(rows, 1000).items() if a < 3}
    assert {r.doc_id: r.arrival_index for r in got.collect()} == want and not report["stopped"]
    empty, _ = run(spark, tempfile.mkdtemp(prefix="loomprep-empty-"), buffer=4, quota=3, keys=keys)
    assert empty.columns == ["doc_id", "lang", "n", "arrival_index"] and empty.count() == 0


def test_null_and_equal_ids(spark):
    src = tempfile.mkdtemp(prefix="loomprep-odd-")
    rows = [(None, "en", 1), (None, "en", 2), (5, "en", 3), (5, "en", 3), (6, None, 4)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(src)
    got, _ = run(spark, src, buffer=2)
    assert sorted((r.doc_id or 0, r.lang or "", r.n) for r in got.collect()) == sorted(
        (a or 0, b or "", c) for a, b, c in rows)
    assert sorted((r.lang or "", r.arrival_index) for r in got.collect()) == [
        ("", 0), ("en", 0), ("en", 1), ("en", 2), ("en", 3)]
