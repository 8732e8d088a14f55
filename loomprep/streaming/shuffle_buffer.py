"""A bounded shuffle buffer over a stream, read until a quota (ST3).

Rows of a key (a language, a source) enter the key's buffer in arrival order.
When it holds ``buffer`` rows they leave together in the order of ``md5(seed:id)``,
so a row moves at most one buffer's length: the stream is shuffled in order of
``(arrival index div buffer, hash)`` without ever being held as a whole.  What the
buffers hold when the source ends is read from the state itself.

The buffers are keyed state on the RocksDB store: one list and one counter for
each key, at most ``buffer - 1`` rows between micro-batches.  The source's rate
limit (files or bytes a trigger) bounds a micro-batch.  Each micro-batch writes
its own partition of the output, and state and output of a repeated batch are
those of the first attempt.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions.constants import SEED
from ..functions.hashing import seeded_key
from .text_stream import _work_dir, _written

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HELD, _ARRIVED = "held", "arrived"


class _Buffer(StatefulProcessor):
    """``rows`` of one key: the key, arrival columns, the shuffle order, then the
    stream's columns."""

    def __init__(self, buffer: int, schema: T.StructType, n_arrival: int):
        self.buffer, self.schema, self.n_arrival = buffer, schema, n_arrival
        self.names = ["_key", "_index", *schema.names]

    def init(self, handle) -> None:
        self.held = handle.getListState(_HELD, self.schema)
        self.arrived = handle.getValueState(_ARRIVED, "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = Row(*self.names)
        new = sorted((tuple(r)[1:] for r in rows), key=lambda r: [
            (v is not None, v) for v in r[:self.n_arrival]])
        n = self.arrived.get()[0] if self.arrived.exists() else 0
        at = 0
        while at < len(new):
            room = self.buffer - n % self.buffer
            part = new[at:at + room]
            if len(part) < room:
                self.held.appendList(part)
            else:
                whole = [tuple(r) for r in self.held.get()] if room < self.buffer else []
                self.held.clear()
                whole = sorted(whole + part, key=lambda r: r[self.n_arrival])
                for place, r in enumerate(whole):
                    yield out(*key, n // self.buffer * self.buffer + place, *r)
            n += len(part)
            at += len(part)
        self.arrived.update((n,))

    def close(self) -> None:
        pass


class QuotaReached(Exception):
    """Ends a stream whose quota the last micro-batch has filled."""


def _keyed(stream: DataFrame, key: str, id_col: str, arrival: Sequence[str], seed) -> DataFrame:
    """(_key, _a0 .., _order, _c0 ..): arrival columns, the hash (ties by arrival) and the
    stream's columns under names of their own."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in arrival]
    order = F.concat_ws(":", seeded_key(seed, id_col), *[F.lpad(p, 20, "0") for p in place])
    return stream.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
                         *[F.col(c).alias(f"_a{k}") for k, c in enumerate(arrival)],
                         order.alias("_order"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(stream.columns)])


def buffered(stream: DataFrame, key: str, id_col: str, arrival: Sequence[str], buffer: int,
             seed=SEED) -> DataFrame:
    """The stream's full buffers: (_key, _index, .., _c0 ..) where ``_index`` is the
    place of the row in its key's shuffled order.  The columns may be of any type
    but structs."""
    rows = _keyed(stream, key, id_col, arrival, seed)
    held = T.StructType(rows.schema.fields[1:])
    out = T.StructType([T.StructField("_key", T.StringType()), T.StructField("_index", T.LongType()),
                        *held.fields])
    return rows.groupBy("_key").transformWithState(
        _Buffer(int(buffer), held, len(arrival)), out, outputMode="Append", timeMode="None")


def left_in_buffers(spark: SparkSession, checkpoint: str, buffer: int) -> DataFrame:
    """What the buffers of a stopped stream hold, in shuffled order: (_key, _index, _c0 ..)."""
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    held = state(_HELD).select(F.col("key._key").alias("_key"), "list_element.*")
    arrived = state(_ARRIVED).select(F.col("key._key").alias("_of"), F.col("value.n").alias("_n"))
    own = Window.partitionBy("_key").orderBy("_order")       # less than a buffer
    index = F.col("_n") - F.pmod("_n", F.lit(int(buffer))) + F.row_number().over(own) - 1
    return held.join(arrived, F.col("_key") == F.col("_of")).withColumn("_index", index.cast("long"))


def shuffled_until_quota(spark: SparkSession, stream: DataFrame, key: str, id_col: str, *,
                         arrival: Sequence[str], buffer: int, quota: int | None = None,
                         keys: Sequence[str] = (), seed=SEED, name: str | None = None):
    """The first ``quota`` rows (all, if None) of every key in shuffled order, as
    ``(rows, report)``: the stream's columns and ``arrival_index``.

    ``arrival``: columns that order the rows of a micro-batch.  The stream ends
    with the micro-batch after which each of ``keys`` has its quota; without
    ``keys``, or while one of them is short, it is read to its end.  A stream of
    the same ``name`` goes on where the last one ended.

    Null keys share one buffer (an empty key); rows with a null id or equal ids
    are kept each; an empty stream gives no rows."""
    name = name or f"shuffled-{uuid.uuid4().hex[:8]}"
    root, checkpoint = _work_dir(spark, name) + "/rows", _work_dir(spark, name) + "/_checkpoint"
    report: dict = {"batches": [], "stopped": False}
    kept = ["_key", "_index", *[f"_c{k}" for k in range(len(stream.columns))]]

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select(*kept).withColumn("batch", F.lit(int(batch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(root))
        report["batches"].append(batch_id)
        if quota is None or not keys:
            return
        done = _written(batch.sparkSession, root)
        if done is not None:
            full = {r[0] for r in done.where(F.col("batch") <= batch_id).groupBy("_key").agg(
                F.max("_index").alias("m")).where(F.col("m") >= quota - 1).collect()}
            if full >= set(keys):
                report["stopped"] = True
                raise QuotaReached(f"{quota} rows of each key")

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)                  # kept by the query that is started
    try:
        query = (buffered(stream, key, id_col, arrival, buffer, seed).writeStream.foreachBatch(write)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not report["stopped"]:
            raise
    report["input_rows"] = [p.numInputRows for p in query.recentProgress]
    rows = _written(spark, root)
    found = None if rows is None else rows.select(*kept)
    if not report["stopped"]:
        try:
            tail = left_in_buffers(spark, checkpoint, buffer).select(*kept)
            found = tail if found is None else found.unionByName(tail)
        except SparkRuntimeException as exc:
            if exc.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":     # no rows so far
                raise
    if found is None:
        found = spark.createDataFrame([], T.StructType([
            T.StructField("_key", T.StringType()), T.StructField("_index", T.LongType()),
            *[T.StructField(f"_c{k}", f.dataType) for k, f in enumerate(stream.schema.fields)]]))
    if quota is not None:
        found = found.where(F.col("_index") < int(quota))
    return found.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(stream.columns)],
                        F.col("_index").alias("arrival_index")), report
