"""Exact Jaccard join on word n-grams by T-occurrence search (operator 8).

A document is the set of its shingles of k words. Two documents whose Jaccard
similarity is t or more share T = ceil(t * n) shingles at least, n the size of
either. So a document whose shingles occur in fewer than T inverted lists with
another document in them links with nothing, and of the others, under any order
of all shingles, one of the first s - T + 1 of each is common to both, s the
number of its shingles that any other document has. The order is by length of
the list, so nearly all documents drop out before any pair is looked at.

* Equal texts are one class, and one of them is read on.
* The inverted lists are built in buckets of the hash space. A task sends each
  bucket one packed array for a block of documents, not a row for each shingle;
  a bucket's task merges the arrays, drops lists of one document and sends each
  block its shared shingles with the lengths of their lists.
* Documents that can link (s >= T) and share one of their first s - T + 1 lists,
  directly or over others, form a unit. Units are searched in tasks of BLOCK or
  two times BLOCK documents: a larger one is dealt out by pairs of blocks.
* The search in a unit is DivideSkip: of a document's lists the L longest are set
  aside, the short ones are merged by counting, what occurs T - L times or more
  is looked up in the long lists by binary search, and pairs that reach the
  overlap that their sizes require are links.

No pair is written: tasks give each document's number of links, and a spanning
forest of the links found.

Cases: null text, or text without words, is the empty set and links with
nothing, not even with an equal row; a text with fewer words than k is one
shingle of all its words; a null doc_id has a null component and links with
nothing; rows that share a doc_id are one node; equal rows are in one class and
are links of one another; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize, small, worker_memo
from .components import connected_components, forest

#: shingles and documents of a block that a task packs, shingles of a bucket that a task merges, documents of a block in a search
PACKED, PACKED_DOCS, BUCKET, BLOCK = 500_000, 4096, 4_000_000, 512
#: share of a merged list's cost that a probe is taken for, as in DivideSkip's choice of L
MU = 0.1
#: bits of a shingle's hash besides those of its bucket, and of the fewest buckets
BITS, LEAST_BUCKETS = 48, 7
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_TABLE = bytes(32 if c in b"\t\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Words(dict):
    """Hashes of words, made once (bounded)."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, k: int, memo: dict[bytes, int] | None = None) -> np.ndarray:
    """64-bit hashes of the shingles, in order and with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map((_Words() if memo is None else memo).__getitem__, words), np.uint64, n)
    k = min(k, n)
    m = n - k + 1
    x = np.full(m, k, np.uint64)
    for i in range(k):
        y = h[i : i + m] * _MUL[i % 8] + np.uint64(i + 1)
        x = (x ^ (y ^ (y >> np.uint64(31)))) * _MUL[(i + 3) % 8]
    x ^= x >> np.uint64(29)
    x *= _MUL[6]
    return x ^ (x >> np.uint64(32))


def required(n, num: int, den: int):
    """Shingles that a document of n shares with any other at the threshold num / den at least."""
    return -(-num * n // den)


def _planes(x: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of each value, byte by byte, so that equal ones lie together."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _values(raw: bytes, n: int, size: int, at: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T
    return out.view("<u8").reshape(-1)


def pack(tokens: np.ndarray, docs: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Ascending tokens as differences, places of documents and, if given, lengths of lists."""
    import zstandard

    raw = _planes(np.diff(tokens, prepend=np.zeros(1, np.uint64)), 7) + _planes(docs, 2)
    return zstandard.ZstdCompressor(level=1).compress(raw if counts is None else raw + _planes(counts, 5))


def unpack(raw: bytes, counted: bool = False) -> tuple[np.ndarray, ...]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = len(raw) // (14 if counted else 9)
    tokens, docs = np.cumsum(_values(raw, n, 7, 0), dtype=np.uint64), _values(raw, n, 2, 7 * n).astype(np.int64)
    return (tokens, docs, _values(raw, n, 5, 9 * n).astype(np.int64)) if counted else (tokens, docs)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def _blocks(k: int, bits: int):
    """Rows (bucket, block, payload) of (doc_id, h1, h2, text): a block's shingles by bucket, and what is known of its documents in a row of a negative bucket, which passes through."""

    def flush(block: int, docs: list[tuple], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        tokens, place = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, place = tokens[order], place[order]
        cuts = np.searchsorted(tokens, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(BITS)).tolist()
        null = np.array([d[0] is None for d in docs], np.int64)
        known = np.concatenate([np.array([d[0] or 0 for d in docs], np.int64), null, sizes, np.array([d[1] for d in docs], np.int64), np.array([d[2] for d in docs], np.int64)])
        rows = [(-1 - block % 997, block, known.tobytes())]
        rows += [(b, block, pack(tokens[s:e], place[s:e])) for b, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)) if s < e]
        return _batch(rows, [pa.int32(), pa.int64(), pa.binary()], ["bucket", "block", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, block = worker_memo("shingle words", _Words), TaskContext.get().partitionId() << 32
        docs, sets, size = [], [], 0
        shift = np.uint64(64 - BITS - bits)
        for b in batches:
            for d, h1, h2, t in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                x = np.unique(shingles(t, k, memo) >> shift)
                docs.append((d, h1, h2))
                sets.append(x)
                size += len(x)
                if size >= PACKED or len(docs) >= PACKED_DOCS:
                    yield flush(block, docs, sets)
                    docs, sets, size, block = [], [], 0, block + 1
        if docs:
            yield flush(block, docs, sets)

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, kind, payload) of sorted rows (bucket, block, payload): the shingles of each block that lists of two documents or more hold, with the lengths of these."""

    def merged(blocks: list[int], payloads: list[bytes]):
        got = [unpack(p) for p in payloads]
        tokens = np.concatenate([g[0] for g in got])
        docs = np.concatenate([g[1] + (i << 16) for i, g in enumerate(got)])
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        length = np.diff(np.append(first, len(tokens)))
        counts = np.repeat(length, length)
        shared = counts > 1
        tokens, docs, counts = tokens[shared], docs[shared], counts[shared]
        order = np.argsort(docs >> 16, kind="stable")
        tokens, docs, counts = tokens[order], docs[order], counts[order]
        cuts = np.searchsorted(docs >> 16, np.arange(len(blocks) + 1)).tolist()
        for b, s, e in zip(blocks, cuts, cuts[1:], strict=False):
            if s < e:
                yield b, 1, pack(tokens[s:e], docs[s:e] & 0xFFFF, counts[s:e])

    def out(rows):
        return _batch(list(rows), [pa.int64(), pa.int32(), pa.binary()], ["block", "kind", "payload"])

    key, blocks, payloads = None, [], []
    for b in batches:
        known = []
        for bucket, block, payload in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket < 0:
                known.append((block, 0, payload))
                continue
            if bucket != key:
                if blocks:
                    yield out(merged(blocks, payloads))
                key, blocks, payloads = bucket, [], []
            blocks.append(block)
            payloads.append(payload)
        if known:
            yield out(known)
    if blocks:
        yield out(merged(blocks, payloads))


def _documents(num: int, den: int):
    """(doc_id, n, h1, h2, need, tokens) of sorted rows (block, kind, payload): the shared shingles of each document that may link, the shortest lists first, and how many of them it must meet a partner in."""

    def block(payloads: list[tuple[int, bytes]]) -> pa.RecordBatch:
        known = np.frombuffer(next(p for kind, p in payloads if kind == 0), np.int64).reshape(5, -1)
        ids, null, n, h1, h2 = known
        got = [unpack(p, True) for kind, p in payloads if kind]
        tokens, docs, counts = (np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((tokens, counts, docs))
        tokens, docs = tokens[order].astype("<u8"), docs[order]
        cuts = np.searchsorted(docs, np.arange(len(n) + 1))
        need = np.where((n > 0) & (null == 0), np.maximum(0, np.diff(cuts) - required(n, num, den) + 1), 0)
        sets = [tokens[s:e].tobytes() if k else None for s, e, k in zip(cuts.tolist(), cuts[1:].tolist(), need.tolist(), strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(ids, mask=null > 0), pa.array(n), pa.array(h1), pa.array(h2), pa.array(need, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "n", "h1", "h2", "need", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            for of, kind, payload in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if of != key:
                    if held:
                        yield block(held)
                    key, held = of, []
                held.append((kind, payload))
        if held:
            yield block(held)

    return run


def _first_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, doc): the lists in which a document must meet a partner."""
    for b in batches:
        need = b.column(1).to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(t, "<i8", int(k)) for t, k in zip(b.column(2).to_pylist(), need.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64), pa.int64()), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), need), pa.int64())], ["token", "doc"])


def search(sets: list[np.ndarray], n: np.ndarray, num: int, den: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places (x, y) whose sets are num / den similar or more, by DivideSkip; n: the whole sizes of the sets, of which only shared shingles are given. own: only pairs of a document of part 0 with one of part 1."""
    size = np.array([len(s) for s in sets], np.int64)
    at, total = np.repeat(np.arange(len(sets)), size), len(sets)
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(tokens, kind="stable")
    owner = at[order]
    length = np.bincount(tokens)
    ends = np.cumsum(length)
    starts = ends - length
    #: every (list, document) in order, for probes by binary search
    keys = tokens[order] * total + owner
    cuts = np.cumsum(size)
    asked = np.flatnonzero(own == 0) if own is not None else np.arange(total)
    xs, ys = [], []
    for x in asked.tolist():
        t = int(required(int(n[x]), num, den))
        if size[x] < t:
            continue
        lists = tokens[cuts[x] - size[x] : cuts[x]]
        lists = lists[np.argsort(length[lists], kind="stable")]
        aside = min(t - 1, int(t / (MU * np.log2(max(2, int(length[lists[-1]]))) + 1)))
        cut = len(lists) - aside
        short, long = lists[:cut], lists[cut:]
        count = np.bincount(np.concatenate([owner[s:e] for s, e in zip(starts[short].tolist(), ends[short].tolist(), strict=True)]), minlength=total)
        near = np.flatnonzero(count >= t - aside)
        near = near[near > x] if own is None else near[own[near] == 1]
        if not len(near):
            continue
        m = n[near]
        overlap = count[near]
        if aside:
            probes = (long[:, None] * total + near[None, :]).ravel()
            found = np.searchsorted(keys, probes)
            overlap = overlap + (keys[np.minimum(found, len(keys) - 1)] == probes).reshape(aside, -1).sum(0)
        near = near[den * overlap >= num * (n[x] + m - overlap)]
        if len(near):
            xs.append(np.full(len(near), x))
            ys.append(near)
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _search(num: int, den: int):
    """(a, w, b) of sorted rows (unit, i, j, own, doc, n, weight, tokens): w texts linked with document a, counted here, or (w 0) a link a, b of the spanning forest."""

    def found(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        own, doc, n, weight = (np.array([h[c] for h in held], np.int64) for c in range(4))
        if len(held) < 2:
            return
        two = key[1] != key[2]
        x, y = search([np.frombuffer(h[4], "<u8") for h in held], n, num, den, (own == key[2]).astype(np.int64) if two else None)
        keep = doc[x] != doc[y]
        x, y = x[keep], y[keep]
        if not len(x):
            return
        counts = np.bincount(x, weight[y], len(doc)).astype(np.int64) + np.bincount(y, weight[x], len(doc)).astype(np.int64)
        nodes, root = forest(x, y)
        tree = nodes != root
        at = np.flatnonzero(counts)
        a, w = np.concatenate([doc[at], doc[nodes[tree]]]), np.concatenate([counts[at], np.zeros(int(tree.sum()), np.int64)])
        b = np.concatenate([np.zeros(len(at), np.int64), doc[root[tree]]])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(w), pa.array(b, mask=np.arange(len(a)) < len(at))], ["a", "w", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in range(8)), strict=True):
                if row[:3] != key:
                    if held:
                        yield from found(key, held)
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield from found(key, held)

    return run


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every row; similarity num / den or more of k-word shingles links."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), "text")
    rows = materialize(texts.select("doc_id", "h1", "h2", F.octet_length("text").cast("long").alias("size")), "texts")
    classes = materialize(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("cid"), F.count("doc_id").alias("weight"), F.max("size").alias("size")), "classes")
    bits = max(LEAST_BUCKETS, ((classes.agg(F.sum("size")).first()[0] or 0) // (5 * BUCKET)).bit_length())
    reps = classes.select("cid", F.col("h1").alias("r1"), F.col("h2").alias("r2"))
    few = small(reps)
    read = texts.join(few, F.col("doc_id").eqNullSafe(F.col("cid")) & (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")), "left_semi").select("doc_id", "h1", "h2", "text")
    if few is reps:  # dealt out anew: written, so that a block holds the same documents whenever a task runs again
        read = materialize(read, "representatives")
    pieces = read.mapInArrow(_blocks(k, bits), "bucket int, block long, payload binary")
    lists = pieces.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(_lists, "block long, kind int, payload binary")
    known = lists.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_documents(num, den), "doc_id long, n long, h1 long, h2 long, need long, tokens binary")
    known = materialize(known.dropDuplicates(["h1", "h2"]), "shingles")
    if few is reps:
        drop_table(read)

    active = known.where("need > 0").join(classes.select("h1", "h2", "weight"), ["h1", "h2"])
    met = known.where("need > 0").select("doc_id", "need", "tokens").mapInArrow(_first_lists, "token long, doc long")
    met = materialize(met.distinct(), "lists")
    least = met.groupBy("token").agg(F.min("doc").alias("lo"), F.count("*").alias("c")).where("c > 1").select("token", "lo")
    units = connected_components(met.join(least, "token").select(F.col("lo").alias("u"), F.col("doc").alias("v")))
    drop_table(met)
    sizes = units.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    dealt = units.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # block b of a unit meets every block: (i, j) with i <= j and b one of them
    dealt = dealt.select(F.col("component").alias("unit"), "node", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("unit", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")
    key = ["unit", "i", "j"]
    asked = dealt.join(active, dealt.node == active.doc_id).select(*key, "own", "doc_id", "n", "weight", "tokens")
    found = materialize(asked.repartition(*key).sortWithinPartitions(*key, "doc_id").mapInArrow(_search(num, den), "a long, w long, b long"), "links")

    # rows of one doc_id and several texts are one node
    several = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    same = rows.where("size > 0").join(several, "doc_id", "left_semi").join(classes, ["h1", "h2"]).select(F.col("doc_id").alias("u"), F.col("cid").alias("v"))
    roots = connected_components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same))
    counts = found.groupBy("a").agg(F.sum("w").alias("linked"))
    of = classes.join(known.select("h1", "h2", "n"), ["h1", "h2"]).join(roots, F.col("cid") == roots.node, "left").join(counts, F.col("cid") == counts.a, "left")
    of = of.select("h1", "h2", "n", F.coalesce("component", "cid").alias("component"), (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("links"))
    links = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("links")).otherwise(F.lit(0).cast("long"))
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "h1", "h2").join(of, ["h1", "h2"]).select("doc_id", F.col("n").alias("n_shingles"), links.alias("n_links"), component.alias("component_id"))
