"""Connected components whose rounds end in written tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import graph
from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b) of longs: the smallest node that is reachable, for every node with an edge."""
    return graph.components(edges, lambda df: written(df, "edges"))
