"""Streaming text cleaning and bounded sampling (ST1-ST4).

ST1 reuses the batch column functions on a ``readStream`` source (append
mode, stateless).  ST2 keeps a running bottom-k sample: each micro-batch
merges the previous sample with the new rows (bottom-k is mergeable) and
writes the result under its ``batchId``, so a replayed batch rewrites the
same folder (idempotent).  ST3 stops a stream once a quota of clean rows has
arrived; ST4 reports running counts through ``observe``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import MAX_TEXT_CHARS, MIN_TEXT_CHARS, SEED, TEXT_SOURCE_PREFIX
from ..functions.hashing import seeded_key
from ..functions.text import contains_cjk, normalize_text
from ..operators.messages import text_sample_messages
from ..session import ensure_checkpoint_dir


def clean_texts(df: DataFrame, text: str = "text", lang: str = "lang", min_chars: int = MIN_TEXT_CHARS,
                max_chars: int = MAX_TEXT_CHARS, source_prefix: str = TEXT_SOURCE_PREFIX) -> DataFrame:
    """Normalise, drop short texts, tag CJK, wrap as a text sample.  Works on
    batch and streaming frames alike."""
    n = normalize_text(text, max_chars)
    d = df.withColumn("text_norm", n).where(F.length("text_norm") >= int(min_chars))
    return d.select("*", contains_cjk("text_norm").alias("has_cjk"),
                    F.concat(F.lit(source_prefix), F.col(lang)).alias("sample_source"),
                    text_sample_messages("text_norm").alias("messages"))


def text_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A parquet ``readStream`` with a fixed schema (optionally files or bytes per trigger)."""
    r = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def _work_dir(spark: SparkSession, name: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name


def _written(spark: SparkSession, root: str) -> DataFrame | None:
    """The dataset at ``root``; None if nothing has been written there yet.  Any
    other failure to read it is raised."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _batches_before(spark: SparkSession, root: str, batch_id: int):
    """Largest committed batch id below ``batch_id`` in the state dataset
    (found through Spark, so any shared file system works)."""
    d = _written(spark, root)
    if d is None:
        return None
    r = d.where(F.col("batch") < batch_id).agg(F.max("batch").alias("b")).first()
    return None if r is None else r.b


def running_sample(spark: SparkSession, stream: DataFrame, k: int, id_col: str, seed=SEED,
                   name: str | None = None, trigger_available_now: bool = True):
    """Start a query that maintains the bottom-k sample by ``md5(seed:id)``.

    State is one parquet dataset partitioned by ``batch`` in the session's
    shared checkpoint folder; batch ``b`` holds the sample after micro-batch
    ``b`` and is written with dynamic partition overwrite, so a replayed
    batch rewrites exactly its own partition.  Returns ``(query,
    read_sample)``; ``read_sample()`` gives the latest sample."""
    name = name or f"sample-{uuid.uuid4().hex[:8]}"
    root = _work_dir(spark, name) + "/state"
    ckpt = _work_dir(spark, name) + "/_checkpoint"

    def merge(batch: DataFrame, batch_id: int):
        sess = batch.sparkSession
        cur = batch.select(id_col, *[c for c in batch.columns if c != id_col]) \
            .withColumn("sample_key", seeded_key(seed, id_col))
        prev_id = _batches_before(sess, root, batch_id)
        if prev_id is not None:
            prev = sess.read.parquet(root).where(F.col("batch") == prev_id).drop("batch")
            cur = prev.unionByName(cur.select(*prev.columns))
        top = cur.orderBy("sample_key", id_col).limit(int(k)).withColumn("batch", F.lit(int(batch_id)))
        (top.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(root))
        # the last two versions are enough: a replay needs the one before
        if batch_id >= 2:
            _remove(sess, f"{root}/batch={batch_id - 2}")

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if trigger_available_now else w
    q = w.start()

    def read_sample():
        last = _batches_before(spark, root, 1 << 62)
        return None if last is None else spark.read.parquet(root).where(F.col("batch") == last).drop("batch")
    return q, read_sample


def _rows_before(spark: SparkSession, root: str, batch_id: int) -> int:
    d = _written(spark, root)
    return 0 if d is None else d.where(F.col("batch") < batch_id).count()


def collect_until_quota(spark: SparkSession, stream: DataFrame, quota: int, id_col: str, seed=SEED,
                        name: str | None = None, digits: int = 2, timeout: float = 60.0,
                        trigger_available_now: bool = False):
    """Append clean rows in shuffled order until ``quota`` rows have
    arrived; the driver stops the query then, or after ``timeout`` seconds in
    which no new rows came and no micro-batch was running
    (``progress["complete"]`` tells which).  With ``trigger_available_now`` the
    stream reads all that is there and ends by itself; there is no timeout.

    Each micro-batch is the shuffle buffer: its rows are ordered by
    ``md5(seed:id)`` (bucketed rank) after the rows of earlier batches.  A
    batch's arrival offset is the number of rows committed by earlier batches
    (read from the output itself), and each batch overwrites only its own
    partition, so a replayed batch or a restarted driver produces the same
    rows.  Returns ``(rows, progress)``: the first ``quota`` rows by arrival
    index and the per-batch counts."""
    from ..operators.ranking import bucketed_rank, hash_bucket
    name = name or f"quota-{uuid.uuid4().hex[:8]}"
    root = _work_dir(spark, name) + "/rows"
    state = {"batches": []}

    def append(batch: DataFrame, batch_id: int):
        sess = batch.sparkSession
        offset = _rows_before(sess, root, batch_id)
        if offset >= quota:
            return
        keyed = batch.withColumn("_k", seeded_key(seed, id_col))
        ranked = bucketed_rank(keyed, ["_k", id_col], hash_bucket("_k", digits), out="_r")
        out = ranked.withColumn("arrival", F.col("_r") + F.lit(offset)).drop("_k", "_r") \
            .withColumn("batch", F.lit(int(batch_id)))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(root))
        state["batches"].append({"batch": batch_id, "rows_before": offset})

    w = stream.writeStream.foreachBatch(append) \
        .option("checkpointLocation", _work_dir(spark, name) + "/_checkpoint")
    q = (w.trigger(availableNow=True) if trigger_available_now else w).start()
    have, waited_since = -1, time.monotonic()
    try:
        while q.isActive:
            q.awaitTermination(0.5)
            status = q.status
            busy = status["isTriggerActive"] and status["isDataAvailable"]
            now = _rows_before(spark, root, 1 << 62)
            if now != have or busy:
                have, waited_since = now, time.monotonic()
            if have >= quota or not trigger_available_now and time.monotonic() - waited_since > timeout:
                break
    finally:
        failure = q.exception()
        q.stop()
    if failure is not None:
        raise failure
    rows = _written(spark, root)
    if rows is None:
        rows = spark.createDataFrame([], stream.schema).withColumn("arrival", F.lit(0).cast("bigint"))
    else:
        rows = rows.where(F.col("arrival") < quota).drop("batch")
    state["count"] = _rows_before(spark, root, 1 << 62)
    state["complete"] = state["count"] >= quota
    return rows, state


def observed(stream: DataFrame, name: str = "progress", reason: str | None = None) -> DataFrame:
    """Running counts of a stream without per-row printing: rows per
    micro-batch (and per reject reason), reported in each batch's
    ``observedMetrics``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if reason:
        for r in ("error", "short", "long"):
            aggs.append(F.count_if(F.col(reason) == r).alias(r))
    return stream.observe(name, *aggs)


class ProgressCounter:
    """A ``StreamingQueryListener`` that sums the observed metrics of every
    micro-batch (``counter.totals``) -- the streaming counterpart of the
    progress prints of a sequential loop."""

    def __new__(cls, name: str = "progress"):
        from pyspark.sql.streaming import StreamingQueryListener

        class _Listener(StreamingQueryListener):
            def __init__(self):
                self.totals: dict[str, int] = {}
                self.batches = 0

            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                m = event.progress.observedMetrics.get(name)
                if m is None:
                    return
                self.batches += 1
                for k, v in m.asDict().items():
                    self.totals[k] = self.totals.get(k, 0) + int(v or 0)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass
        return _Listener()
