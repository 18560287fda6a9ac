"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut in the shared checkpoint folder; on a cluster spark.checkpoint.dir must name one, a local session makes its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            import tempfile

            folder = f"file://{tempfile.mkdtemp(prefix='navlattice-')}"
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Edges that one task solves in memory.
FEW = 50_000


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the components of all edges of a task: labels spread along edges and jump to their labels' labels."""
    pairs = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
    a, b = (np.concatenate([np.zeros(0, np.int64), *(p[side] for p in pairs)]) for side in (0, 1))
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[label[far]])], names=["a", "b"])


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = settled) -> DataFrame:
    """(node, component) for edges (a, b) of longs: the smallest node that is reachable, for every node with an edge.

    Each round points every node's larger neighbours, then its smaller ones, at
    the smallest of them.  Minima are aggregated before the shuffle; the edges
    of one hub meet its minimum in a join of rows of 16 bytes, which adaptive
    execution splits where they are many.  Every round ends in `keep`, which
    cuts the lineage; once no more than FEW edges are left, one task ends the
    search, with the same result.  A self-loop keeps a node in the result; no edges give no
    rows; nulls are ignored.
    """
    edges = edges.where("a is not null and b is not null")
    alone = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    ordered = lambda e: e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = keep(ordered(edges)), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        if state[0] <= FEW:
            now = keep(now.coalesce(1).mapInArrow(_solved, "a long, b long"))
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = keep(ordered(small))
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = found.unionByName(now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component")))
    return found.unionByName(alone.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
