"""Streaming = batch, replay idempotence, quota stop, progress counts."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from loomprep.operators.sampling import bottomk_sample
from loomprep.operators.prepare import with_progress
from loomprep.streaming import text_stream as ST


def split_documents(spark, parts=4):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    root = tempfile.mkdtemp(prefix="loomprep-stream-")
    for k in range(parts):
        d.where(F.pmod("doc_id", F.lit(parts)) == k).write.parquet(os.path.join(root, f"part{k}"))
    src = tempfile.mkdtemp(prefix="loomprep-src-")
    for k in range(parts):
        for f in os.listdir(os.path.join(root, f"part{k}")):
            if f.endswith(".parquet"):
                os.link(os.path.join(root, f"part{k}", f), os.path.join(src, f"p{k}-{f}"))
    return d, src


def test_stream_equals_batch(spark):
    d, src = split_documents(spark)
    s = ST.text_stream(spark, src, d.schema, max_files_per_trigger=1)
    cleaned = ST.clean_texts(s).select("doc_id", "text_norm", "has_cjk", "sample_source")
    name = "st1_out"
    q = cleaned.writeStream.format("memory").queryName(name).outputMode("append") \
        .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.table(name).collect()}
    want = {tuple(r) for r in ST.clean_texts(d).select("doc_id", "text_norm", "has_cjk", "sample_source").collect()}
    assert got == want and len(got) > 0


def test_running_sample_equals_batch_bottomk(spark):
    d, src = split_documents(spark)
    s = ST.text_stream(spark, src, d.schema, max_files_per_trigger=1).select("doc_id", "lang")
    q, read = ST.running_sample(spark, s, 50, "doc_id", seed=42)
    q.awaitTermination()
    got = sorted(r.doc_id for r in read().collect())
    want = sorted(r.doc_id for r in bottomk_sample(d.select("doc_id"), 50, "doc_id", seed=42).collect())
    assert got == want


def test_quota_stop(spark):
    d, src = split_documents(spark)
    s = ST.clean_texts(ST.text_stream(spark, src, d.schema, max_files_per_trigger=1)).select("doc_id", "text_norm")
    rows, state = ST.collect_until_quota(spark, s, 300, "doc_id")
    assert rows.count() == 300
    assert state["count"] >= 300
    assert rows.select("arrival").distinct().count() == 300


def test_progress_observation(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    df, obs = with_progress(d.select("doc_id"), "docs")
    df.collect()
    assert obs.get["rows"] == d.count()


def test_running_sample_replay_is_idempotent(spark):
    """Running the same micro-batch id twice leaves the same sample."""
    d, src = split_documents(spark)
    s = ST.text_stream(spark, src, d.schema, max_files_per_trigger=2).select("doc_id", "lang")
    q, read = ST.running_sample(spark, s, 40, "doc_id", seed=3, name="replay-test")
    q.awaitTermination()
    first = sorted(r.doc_id for r in read().collect())
    # restart from the same checkpoint: no new data, nothing changes
    q2, read2 = ST.running_sample(spark, ST.text_stream(spark, src, d.schema).select("doc_id", "lang"),
                                  40, "doc_id", seed=3, name="replay-test")
    q2.awaitTermination()
    assert sorted(r.doc_id for r in read2().collect()) == first
    want = sorted(r.doc_id for r in bottomk_sample(d.select("doc_id"), 40, "doc_id", seed=3).collect())
    assert first == want


def test_streaming_progress_listener(spark):
    import time
    d, src = split_documents(spark)
    s = ST.clean_texts(ST.text_stream(spark, src, d.schema, max_files_per_trigger=1)).select("doc_id")
    counter = ST.ProgressCounter("clean")
    spark.streams.addListener(counter)
    try:
        q = ST.observed(s, "clean").writeStream.format("noop") \
            .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(50):                       # listener events arrive asynchronously
            if counter.totals.get("rows") == ST.clean_texts(d).count():
                break
            time.sleep(0.2)
        assert counter.totals.get("rows") == ST.clean_texts(d).count()
        assert counter.batches >= 2
    finally:
        spark.streams.removeListener(counter)


def test_quota_restart_gives_same_rows(spark):
    d, src = split_documents(spark)
    mk = lambda: ST.clean_texts(ST.text_stream(spark, src, d.schema, max_files_per_trigger=1)).select("doc_id")
    rows1, _ = ST.collect_until_quota(spark, mk(), 250, "doc_id", name="quota-restart")
    first = sorted((r.doc_id, r.arrival) for r in rows1.collect())
    rows2, _ = ST.collect_until_quota(spark, mk(), 250, "doc_id", name="quota-restart")
    assert sorted((r.doc_id, r.arrival) for r in rows2.collect()) == first and len(first) == 250


def slow(df, seconds):
    """The rows after a wait in every task."""
    def wait(batches):
        import time
        time.sleep(seconds)
        yield from batches
    return df.mapInArrow(wait, df.schema)


def test_quota_waits_for_a_running_batch(spark):
    d, src = split_documents(spark, parts=1)
    s = ST.text_stream(spark, src, d.schema).select("doc_id")
    rows, state = ST.collect_until_quota(spark, slow(s, 4), 40, "doc_id", timeout=1.0)
    assert rows.count() == 40 and state["complete"] is True


def test_quota_query_waits_for_its_batch(spark, monkeypatch):
    from loomprep.plans import catalog  # noqa: F401
    from loomprep.plans import stream_queries as SQ
    clean = ST.clean_texts
    monkeypatch.setattr(ST, "clean_texts", lambda df: slow(clean(df).select("doc_id"), 12))
    assert SQ.stream_until_quota(spark, SF01).count() == SQ.QUOTA


def test_quota_query_without_clean_rows(spark, tmp_path):
    from loomprep.plans import catalog  # noqa: F401
    from loomprep.plans import stream_queries as SQ
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    d.withColumn("text", F.lit("")).write.parquet(str(tmp_path / "documents.parquet"))
    got = SQ.stream_until_quota(spark, str(tmp_path))
    assert got.columns == ["doc_id", "arrival"] and got.count() == 0
