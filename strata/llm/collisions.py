"""Near-duplicate vectors by collision counting over one-dimensional projections (operator 6).

Every vector is projected on many random directions. A pair at the threshold
lies within a query-centred window of known width on a known share of the
projections, a pair of unrelated vectors on far fewer; pairs that collide on
enough projections (COUNT_SIGMA below the mean at the threshold) are verified by
their exact cosine.

Counting over whole projections would touch a fixed share of all pairs. So
projections also form L groups of g, each cut into cells: only vectors that
share all g cells of some group meet, in one task, sorted by one projection.
There the windows of COUNTED projections are counted for the pairs inside the
sort's window. g grows with the logarithm of the rows, L keeps the recall at the
threshold (closer pairs: higher).

Equal vectors are one representative with a weight. A pair that meets in several
groups counts in the first. No pair is written: tasks give partial counts by
vector, and a spanning forest of the links found. A cell of many vectors is dealt
out by blocks: each pair of blocks is a task's unit, so no task holds a group.

Cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing (n_links 0, component their own id); vectors of different
lengths do not link; equal vectors link with one another; a row with a null
vec_id links with nothing and has a null component; rows that share a vec_id are
counted each; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components, forest

SEED, COUNTED, COUNT_SIGMA = 20_260, 32, 4.5
#: width of a cell (a projection of unrelated unit vectors has deviation 1), half width of a window at the threshold in deviations, recall of the groups at the threshold
CELL, WINDOW_SIGMA, RECALL = 1.5, 1.645, 0.995
#: unrelated vectors that a vector meets in a cell, and rows of a block
STRANGERS, BLOCK = 8, 1500
#: rows of a unit whose pairs are all counted, and rows of the units that are counted at once
SMALL, TOGETHER = 64, 4000


def _within(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def _same_cell(deviation: float, cell: float = CELL) -> float:
    """Chance that two projections, their difference normal with this deviation, share a cell of random offset."""
    z = cell / deviation
    return _within(z) - math.sqrt(2 / math.pi) / z * (1 - math.exp(-z * z / 2))


def plan(n: int, threshold: float) -> tuple[int, int]:
    """g and L for n vectors."""
    far, near = _same_cell(math.sqrt(2)), _same_cell(math.sqrt(2 - 2 * threshold))
    g = max(2, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return g, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near**g)))


@lru_cache(maxsize=128)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


@lru_cache(maxsize=8)
def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((n, dim))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, vecs = [], []
        for v in b.column(1).to_pylist():
            x = None
            if v and None not in v:
                x = np.array(v, np.float64)
                if not np.isfinite(x).all() or not x.any():
                    x = None
            if x is None:
                keys.append(None)
                vecs.append(None)
            else:
                x = x + 0.0  # no negative zero
                raw = x.tobytes()
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                vecs.append((x / (m := np.abs(x).max()) / np.linalg.norm(x / m)).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "k", "vec"])


def _codes(units: np.ndarray, g: int, groups: int, seed: int) -> np.ndarray:
    """A 32-bit code of the g cells for each vector and group."""
    dim = units.shape[1]
    v = units @ _directions(dim, g * groups, seed).T
    cells = np.floor((v + np.random.default_rng([seed, 1]).uniform(0, CELL, g * groups)) / CELL).astype(np.int64)
    mix = np.random.default_rng([seed, 2, dim]).integers(1, 1 << 62, g * groups) | 1
    h = (cells * mix).reshape(len(units), groups, g).sum(2)
    h ^= h >> 29
    h = h * 0x1B873593 * 2 + h
    return ((h ^ (h >> 32)) & 0xFFFFFFFF).astype(np.uint32)


def near_vectors(vectors: DataFrame, threshold: float = 0.95, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding)."""
    rows = materialize(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_vectors, "vec_id long, k binary, vec binary"), "vectors")
    valid = rows.where("k is not null and vec_id is not null")
    classes = materialize(valid.groupBy("k").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "classes")
    reps = materialize(valid.join(classes, "k").where("vec_id = rep").dropDuplicates(["k"]).select("rep", "weight", "vec"), "reps")
    g, groups = plan(reps.count(), threshold)

    def codes(batches):
        for b in batches:
            by: dict[int, list[int]] = {}
            vecs = b.column(2).to_pylist()
            for i, v in enumerate(vecs):
                by.setdefault(len(v), []).append(i)
            for at in by.values():
                units = np.stack([np.frombuffer(vecs[i], np.float64) for i in at])
                c = _codes(units, g, groups, seed)
                n = len(at)
                idx = np.tile(np.array(at), groups)
                take = lambda k, idx=idx: b.column(k).take(pa.array(idx))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(groups, dtype=np.int32), n)), pa.array(c.T.reshape(-1).astype(np.int64)), take(0)], ["grp", "code", "rep"])

    # what meets is found from (group, code, id) alone; vectors move only where two or more meet
    cells = materialize(reps.mapInArrow(codes, "grp int, code long, rep long"), "cells")
    sizes = cells.groupBy("grp", "code").agg(F.count("*").alias("size")).where("size > 1")
    met = cells.join(sizes, ["grp", "code"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks.cast("long")).cast("int")
    # block b meets every block: units (i, j) with i <= j and b one of them
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.withColumns({"blocks": blocks, "own": own}).select("grp", "code", "rep", "own", other.alias("other"))
    units = met.select("grp", "code", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep").join(reps, "rep")
    found = _count(units, threshold, g, groups, seed)
    found = materialize(found, "found")
    counts = found.groupBy("a").agg(F.sum("w").alias("linked"))
    links = found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = connected_components(links)
    known = classes.join(counts, classes.rep == counts.a, "left").join(roots, classes.rep == roots.node, "left")
    known = known.select("k", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = valid.select("vec_id", "k").join(known, "k").select("vec_id", "n_links", "component_id")
    alone = rows.where("k is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _count(units: DataFrame, threshold: float, g: int, groups: int, seed: int) -> DataFrame:
    """(a, w, b): w vectors linked with a, counted here; or a link of the forest (b not null, w 0)."""
    delta = math.sqrt(2 - 2 * threshold)
    window = WINDOW_SIGMA * delta
    share = _within(WINDOW_SIGMA)
    least = share * COUNTED - COUNT_SIGMA * math.sqrt(COUNTED * share * (1 - share))

    def pairs(v, p, c, grp, lo, hi, own):
        """Links between rows lo and the rows hi of a unit, both positions in the sort by the first projection."""
        count = np.zeros((len(lo), len(hi)), np.int16)
        for k in range(COUNTED):
            count += np.abs(p[lo, k][:, None] - p[hi, k][None, :]) <= window
        ok = count >= least
        if own is not None:  # two blocks: each block by itself is another unit
            ok &= own[lo][:, None] != own[hi][None, :]
        for t in range(grp):  # counted in an earlier group
            ok &= c[lo, t][:, None] != c[hi, t][None, :]
        a, b = np.nonzero(ok)
        a, b = lo[a], hi[b]
        keep = a < b
        a, b = a[keep], b[keep]
        dots = np.einsum("ij,ij->i", v[a], v[b]) if len(a) else np.zeros(0)
        keep = dots >= threshold
        return a[keep], b[keep]

    def unit(grp, i, j, own, reps, weights, v):
        p = v @ _directions(v.shape[1], COUNTED, seed + 1).T
        order = np.argsort(p[:, 0], kind="stable")
        v, p, reps, weights, own = v[order], p[order], reps[order], weights[order], own[order]
        c = _codes(v, g, groups, seed)
        reach = 5 * delta
        n_links = np.zeros(len(v), np.int64)
        us, vs = [], []
        for s in range(0, len(v), 256):
            lo = np.arange(s, min(s + 256, len(v)))
            hi = np.arange(s, np.searchsorted(p[:, 0], p[lo[-1], 0] + reach, "right"))
            a, b = pairs(v, p, c, grp, lo, hi, own if i != j else None)
            np.add.at(n_links, a, weights[b])
            np.add.at(n_links, b, weights[a])
            if len(a):
                nodes, root = forest(a, b)
                tree = nodes != root
                us.append(nodes[tree])
                vs.append(root[tree])
        if not us:
            return None
        nodes, root = forest(np.concatenate(us), np.concatenate(vs))
        tree = nodes != root
        at = np.flatnonzero(n_links)
        return reps[at], n_links[at], reps[nodes[tree]], reps[root[tree]]

    def run(batches):
        """Units come one after another; small ones are counted many at once."""
        held, key, few, rows = [], None, [], 0
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(8)]
            for grp, code, i, j, own, rep, weight, vec in zip(*cols, strict=True):
                k = (grp, code, i, j)
                if k != key:
                    few, rows = few + by_length(key, held), rows + len(held)
                    if rows > TOGETHER:
                        yield from done(few)
                        few, rows = [], 0
                    held, key = [], k
                held.append((own, rep, weight, vec))
        yield from done(few + by_length(key, held))

    def by_length(key, held):
        by: dict[int, list] = {}
        for h in held:
            by.setdefault(len(h[3]), []).append(h)
        return [(key, part) for part in by.values() if len(part) > 1]

    def done(units):
        small: dict[int, list] = {}
        for key, part in units:
            if len(part) <= SMALL:
                small.setdefault(len(part[0][3]), []).append((key, part))
                continue
            own, reps, weights = (np.array([h[k] for h in part]) for k in range(3))
            yield from given(unit(key[0], key[2], key[3], own, reps, weights, np.stack([np.frombuffer(h[3], np.float64) for h in part])))
        for parts in small.values():
            yield from given(together(parts))

    def given(out):
        if out:
            a, w, u, v = out
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, u]), pa.int64()), pa.array(np.concatenate([w, np.zeros(len(u), np.int64)]), pa.int64()), pa.array(np.concatenate([np.zeros(len(a), np.int64), v]), pa.int64(), mask=np.arange(len(a) + len(u)) < len(a))], ["a", "w", "b"])

    def together(units):
        """Links of many small units: all pairs inside each, in one pass over their projections."""
        rows = [h for _, part in units for h in part]
        own, reps, weights = (np.array([h[k] for h in rows]) for k in range(3))
        v = np.stack([np.frombuffer(h[3], np.float64) for h in rows])
        p, c = v @ _directions(v.shape[1], COUNTED, seed + 1).T, _codes(v, g, groups, seed)
        left, right, of, two, at = [], [], [], [], 0
        for key, part in units:
            x, y = _pairs(len(part))
            left.append(x + at)
            right.append(y + at)
            of += [key[0]] * len(x)
            two += [key[2] != key[3]] * len(x)
            at += len(part)
        left, right, of, two = np.concatenate(left), np.concatenate(right), np.array(of), np.array(two)
        keep = np.flatnonzero(~two | (own[left] != own[right]))
        found = []
        for s in range(0, len(keep), 50_000):
            k = keep[s : s + 50_000]
            a, b = left[k], right[k]
            ok = np.count_nonzero(np.abs(p[a] - p[b]) <= window, axis=1) >= least
            a, b, k = a[ok], b[ok], k[ok]
            ok = (c[a] == c[b]).argmax(axis=1) == of[k]  # else counted in an earlier group
            a, b = a[ok], b[ok]
            found.append(np.stack([a, b])[:, np.einsum("ij,ij->i", v[a], v[b]) >= threshold])
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        if not len(a):
            return None
        n_links = np.bincount(a, weights[b], len(rows)).astype(np.int64) + np.bincount(b, weights[a], len(rows)).astype(np.int64)
        nodes, root = forest(reps[a], reps[b])
        tree, at = nodes != root, np.flatnonzero(n_links)
        return reps[at], n_links[at], nodes[tree], root[tree]

    key = ["grp", "code", "i", "j"]
    return units.select(*key, "own", "rep", "weight", "vec").repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, w long, b long")
