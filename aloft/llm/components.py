"""Connected components over an edge table by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Every round is a pair of grouped minima and joins; no component is ever gathered in a
task.  The result of each round is written to the shared folder, so a lost executor
costs at most one round and the plan never grows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import saved


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                    .alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has columns u, v of one orderable type.  Returns (u, v): every vertex that is
    not the smallest of its component, with that smallest vertex.  Self-links and
    repeated edges do no harm; an empty table gives an empty result."""
    e = (edges.where(F.col("u") != F.col("v"))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = saved(e, "edges")
    before = None
    while True:
        now = _signature(e)
        if now == before or now[0] == 0:
            return e
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"),
                         F.col("m").alias("v")).distinct())
        e = saved(small, "edges")


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of ``n`` vertices over edges (i, j), within one task."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label
