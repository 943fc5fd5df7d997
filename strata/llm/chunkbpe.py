"""BPE encoding and decoding with reuse of content-defined chunks (operator 3).

A rolling hash over the last WINDOW characters cuts a text into chunks, so equal
passages of different documents give equal chunks. A worker encodes a chunk once,
as if it were a text, and keeps its ids (bounded memo). Only the ids near a join
of two chunks can be wrong: a word that the cut has torn. So the text around each
join, from the last whole word of the left chunk to the first whole word of the
right one, is encoded again, and its ids take the place of those of the edges if
they begin and end exactly with the chunks' own ids of those two words. Where
they do not agree, the window grows by a word on either side and is encoded
again, until they agree or it spans the text. A chunk without a whole word goes
wholly into the window. Words end at places where the pre-tokenizer always cuts
(wordbpe.py), so agreement there settles all that lies beyond.

Cases: null text is the empty text (no ids, decoded as the empty text); texts of
any length; equal rows are encoded each; columns besides doc_id and text are not
read. Tokenizers without sure cuts are used on whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_memo
from .wordbpe import WordEncoder

WINDOW, MEAN_BITS, SHORTEST, LONGEST = 16, 8, 64, 4096
#: bytes of the chunks whose ids a worker keeps, and what a chunk has besides its characters and ids
KEPT, CHUNK = 40_000_000, 420
_BASE, _MIX = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93
_CUT = re.compile("[ \n]")


class Cutter:
    """Places where the rolling hash of the last WINDOW characters has MEAN_BITS leading zeros."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.power) < n:
            with np.errstate(over="ignore"):
                self.power, self.inverse = (self.powers(b, 2 * n) for b in (_BASE, pow(_BASE, -1, 2**64)))

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        x = np.full(n, base, np.uint64)
        x[0] = 1
        return np.cumprod(x, dtype=np.uint64)

    def places(self, text: str) -> list[int]:
        x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(x)
        if n <= SHORTEST:
            return [n] if n else []
        self.grow(n)
        s = np.cumsum(x * self.inverse[:n], dtype=np.uint64)
        s[WINDOW:] -= s[:-WINDOW].copy()
        h = s * self.power[:n] * np.uint64(_MIX)
        out, last = [], 0
        for p in [*(np.flatnonzero(h >> np.uint64(64 - MEAN_BITS) == 0) + 1).tolist(), n]:
            while p - last > LONGEST:
                last += LONGEST
                out.append(last)
            if p - last >= SHORTEST or p == n:
                if p > last:
                    out.append(p)
                last = p
        return out


class ChunkEncoder:
    def __init__(self, path: str, kept: int = KEPT):
        self.words = WordEncoder(path)
        self.cutter = Cutter()
        self.memo: dict[str, tuple | None] = {}
        self.kept, self.used, self.made, self.repaired = kept, 0, 0, 0
        self.chunked = self.words.kind == "words"

    def cut(self, text: str) -> list[str]:
        out, at = [], 0
        for p in self.cutter.places(text):
            out.append(text[at:p])
            at = p
        return out

    def learn(self, chunks: set[str]) -> None:
        """Keep (ids, place of the first whole word, its end, bytes of ids before and in it, the same of the last one) of each new chunk; None if it has no whole word."""
        if self.used > self.kept:
            self.memo, self.used = {}, 0
        fresh = list(chunks.difference(self.memo))
        self.made += len(fresh)
        spans = []
        for t in fresh:
            a = _CUT.search(t)
            z = max(t.rfind(" "), t.rfind("\n"))
            if a is None or a.start() == z:
                spans.append(None)
                continue
            a = a.start()
            b = _CUT.search(t, a + 1).start()
            spans.append((a, b, max(t.rfind(" ", 0, z), t.rfind("\n", 0, z)), z))
        # one call for all texts, edges and words
        got = iter(self.words.encode_many([x for t, s in zip(fresh, spans, strict=True) if s for x in (t, t[: s[0]], t[s[0] : s[1]], t[s[2] : s[3]], t[s[3] :])]))
        for t, s in zip(fresh, spans, strict=True):
            self.used += CHUNK + len(t)
            if s is None:
                self.memo[t] = None
                continue
            ids, head, first, last, tail = next(got), next(got), next(got), next(got), next(got)
            self.used += len(ids)
            self.memo[t] = (ids, s, len(head), first, last, len(ids) - len(tail))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        w = self.words
        own = [self.chunked and not any(a in t for a in w.added) for t in texts]
        cut = [self.cut(t) if o else [] for t, o in zip(texts, own, strict=True)]
        self.learn(set().union(*cut))
        joined, windows = [], {}
        for text, chunks in zip(texts, cut, strict=True):
            parts: list = []  # middles of chunks, and windows (start, end, ids of the word before, of the word after) between them
            start, before, at = 0, b"", 0
            for t in chunks:
                if (c := self.memo[t]) is not None:
                    ids, (a, b, y, _), n, first, last, end = c
                    if at == 0:
                        parts.append(None)
                    else:
                        parts.append((start, at + b, before, first))
                        windows[text[start : at + b]] = None
                    parts.append(ids[(n if at else 0) : end])
                    start, before = at + y, last
                at += len(t)
            last_one = self.memo[chunks[-1]] if chunks else None
            if parts and last_one is not None:  # the text ends with its last chunk
                parts[-1] = parts[-1] + last_one[0][last_one[5] :]
            elif chunks:
                parts.append((start, at, before, b""))
                windows[text[start:]] = None
            joined.append(parts)
        for x, e in zip(windows, w.tokenizer.encode_batch_fast(list(windows), add_special_tokens=False), strict=True):
            windows[x] = np.array(e.ids, "<u4").tobytes()
        self.repaired += len(windows)
        out = []
        for text, o, parts in zip(texts, own, joined, strict=True):
            if not o:
                out.append(w.whole(text))
                continue
            pieces: list[bytes] | None = []
            for p in parts:
                if type(p) is tuple:
                    p = self.agreed(text, p, windows[text[p[0] : p[1]]])
                    if p is None:
                        pieces = None
                        break
                if p:
                    pieces.append(p)
            out.append(w.whole(text) if pieces is None else b"".join(pieces))
        return out

    def agreed(self, text: str, window: tuple, ids: bytes) -> bytes | None:
        """Ids of the torn word between the two whole ones; None if no window but the whole text agrees."""
        a, b, before, after = window
        while True:
            if len(ids) >= len(before) + len(after) and ids.startswith(before) and ids.endswith(after):
                return ids[len(before) : len(ids) - len(after)]
            grown = max(text.rfind(" ", 0, a), text.rfind("\n", 0, a), 0)
            end = _CUT.search(text, b + 1)
            if grown == a and b == len(text):
                return None
            left, right = text[grown:a], text[b : end.start() if end else len(text)]
            a, b = grown, b + len(right)
            before, ids, after = self.words.whole(left) + before, self.words.whole(text[a:b]), after + self.words.whole(right)


def encode_decode(docs: DataFrame, tokenizer: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_memo(f"chunks {tokenizer}", lambda: ChunkEncoder(tokenizer))
        decode = enc.words.decode
        for b in batches:
            n, a, c, ids, texts = [], [], [], [], []
            rows = [t or "" for t in b.column(1).to_pylist()]
            for k in range(0, len(rows), 256):
                for raw in enc.many(rows[k : k + 256]):
                    decoded = decode(raw)
                    n.append(len(raw) // 4)
                    a.append(hashlib.sha256(raw).hexdigest())
                    c.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        ids.append(raw)
                        texts.append(decoded)
            cols, names = [b.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(c)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary()), pa.array(texts)] * with_ids, names + ["ids", "decoded"] * with_ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids)
