"""Connected components over a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from each of ``n`` nodes over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def components(links: DataFrame) -> DataFrame:
    """vertex, component (its smallest reachable vertex) for every vertex of the
    links (columns a and b, longs).

    Each round takes the smallest component among the neighbours and then that
    component's own component; rounds go on until nothing changes, each one
    written to the shared folder.  Neighbours are reduced to minima on the map
    side; the joins have no row for a pair of vertices that is not a link."""
    both = materialize(links.union(links.select("b", "a")).distinct().toDF("a", "b"), "links")
    labels = materialize(both.groupBy(F.col("a").alias("vertex")).agg(
        F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("vertex")).groupBy("a").agg(
            F.min("component").alias("near"))
        hooked = labels.join(near, F.col("vertex") == F.col("a")).select(
            "vertex", F.col("component").alias("old"),
            F.least("component", "near").alias("component"))
        target = labels.select(F.col("vertex").alias("at"), F.col("component").alias("onward"))
        after = materialize(hooked.join(target, F.col("component") == F.col("at")).select(
            "vertex", "old", F.least("component", "onward").alias("component")), "labels")
        labels = after.select("vertex", "component")
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return labels
