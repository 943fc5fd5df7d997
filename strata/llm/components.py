"""Connected components of a link table, without a hot node or a large group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize

#: links that one task may finish by union-find (16 bytes each)
FINISH = 300_000


def forest(u, v):
    """Union-find over two arrays of node ids: distinct nodes and the smallest node reachable of each."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(nodes)))
    half = len(u)
    for a, b in zip(at[:half].tolist(), at[half:].tolist(), strict=True):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    for i in range(len(parent)):
        parent[i] = parent[parent[i]]
    return nodes, nodes[np.array(parent, np.int64)] if len(nodes) else nodes


def _contract(batches):
    """Links of a task to a forest of its own: (node, smallest node), fewer than its nodes."""
    import numpy as np
    import pyarrow as pa

    u, v, n = [], [], 0
    for b in batches:
        u.append(b.column(0).to_numpy(zero_copy_only=False))
        v.append(b.column(1).to_numpy(zero_copy_only=False))
        n += b.num_rows
        if n > 2_000_000:  # bounded memory: what is left over only stays less contracted
            nodes, root = forest(np.concatenate(u), np.concatenate(v))
            keep = nodes != root
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(root[keep])], ["u", "v"])
            u, v, n = [], [], 0
    if u:
        nodes, root = forest(np.concatenate(u), np.concatenate(v))
        keep = nodes != root
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(root[keep])], ["u", "v"])


def connected_components(links: DataFrame, finish: int = FINISH) -> DataFrame:
    """(node, component) of every node of links (u, v); component is the smallest node reachable. Nodes are longs.

    Each task first contracts its links to a forest. While many are left, every
    node takes the smallest neighbour's smallest neighbour as its parent, and
    links are drawn between parents; each round at least halves the nodes of a
    component, and the rounds' maps are composed. Few links (a fixed bound) are
    finished by one task. Hot nodes are only ever aggregated by min (combined
    before the shuffle) or joined with tables of one row a node.
    """
    links = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u != v")
    edges = materialize(links.mapInArrow(_contract, "u long, v long"), "links")
    maps: list[DataFrame] = []
    n = edges.count()
    while n > finish:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        parent = materialize(least.alias("a").join(least.alias("b"), F.col("a.m") == F.col("b.u")).select(F.col("a.u").alias("u"), F.col("b.m").alias("p")), "parents")
        drop_table(least)
        new = edges.join(parent, "u").select(F.col("p").alias("a"), "v").join(parent.select(F.col("u").alias("v"), F.col("p").alias("b")), "v")
        new = new.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u != v").distinct()
        new = materialize(new.mapInArrow(_contract, "u long, v long"), "links")
        drop_table(edges)
        edges = new
        maps.append(parent)
        n = edges.count()
    last = materialize(edges.coalesce(1).mapInArrow(_finish, "node long, component long"), "roots")
    drop_table(edges)
    for parent in reversed(maps):
        # a node's component is that of its parent; a parent in no later link is its own
        step = parent.join(last.withColumnRenamed("node", "p"), "p", "left").select(F.col("u").alias("node"), F.coalesce("component", "p").alias("component"))
        last = materialize(step, "roots")
    return last


def _finish(batches):
    import numpy as np
    import pyarrow as pa

    got = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    if got:
        nodes, root = forest(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(root, pa.int64())], ["node", "component"])
