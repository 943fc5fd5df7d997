"""Exact BPE encoding through a bounded memo of words.

A BPE tokenizer first cuts a text into pre-tokens and merges inside each. Where
the pre-tokenizer is sure to cut, a text can be encoded in pieces and the ids
joined. Two kinds are known, told from the tokenizer's own file:

* byte-level with its standard pattern and no normalizer: a single blank between
  two visible characters starts a pre-token, and a line feed between two visible
  characters is one;
* words matched by a pattern with white space dropped: every blank and line
  feed is a cut.

In both, a change between an ASCII letter and an ASCII sign other than the
apostrophe is a cut as well. Any other tokenizer, and any text that holds the
content of an added token or (byte-level) two white-space characters in a row or
a rare one, is encoded whole.

Texts are cut by numpy, many at once, and their pieces are looked up by 64-bit
hashes (of bytes, length and whether a blank goes before) in a table of open
addressing, which gives the place of a piece's ids in a pool. A piece that is new
and holds plain Latin characters alone goes to the tokenizer's own model
pre-token by pre-token, any other through the whole tokenizer. A table that is
full starts anew, so memory is bounded: 16 bytes a slot, and the ids.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from .common import worker_memo

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: slots of the table (a power of two), characters of the texts that are cut at once, bytes of the longest piece that is kept
SLOTS, TOGETHER, LONGEST = 1 << 22, 250_000, 200
#: white space other than a blank and a line feed
_OTHER = re.compile(r"[^\S \n]")
_SINGLE = re.compile(r"(?<=\S)(?= \S)")
#: visible characters whose case, class and composition no version of Unicode changes
_PLAIN = re.compile("[!-~¡-įı-ſ]+")
#: signs of ASCII that end a word, but for the one that begins a contraction
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: classes of bytes: blank, line feed, end of a text, letter, sign, and bytes of other white space or that may begin it
_BLANK, _FEED, _END, _LETTER, _SIGN, _RARE = range(1, 7)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[32, 10, 0]] = _BLANK, _FEED, _END
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[[ord(c) for c in _SIGNS]] = _SIGN
_CLASS[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = _RARE
_BASE, _MIX = 0x9E3779B97F4A7C15 | 1, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
#: the byte-level pre-tokenizer's standard pattern (fixed value)
_BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next free one above 255."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


_LETTERS = byte_letters()


def letters(text: str) -> str:
    return text if text.isascii() and " " not in text else text.encode().decode("latin-1").translate(_LETTERS)


class Table:
    """Open addressing of 64-bit hashes (not 0) to runs of a pool of ids."""

    def __init__(self, slots: int):
        self.slots, self.shift = slots, np.uint64(65 - slots.bit_length())
        self.clear()

    def clear(self) -> None:
        self.keys, self.runs, self.used = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int64), 0
        self.pool, self.end = np.zeros(1 << 16, np.uint32), 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The run (place * 2**20 + length) of each, -1 if it is new."""
        out = np.full(len(hashes), -1, np.int64)
        slot, left = (hashes >> self.shift).astype(np.int64), np.arange(len(hashes))
        while len(left):
            seen = self.keys[slot]
            hit = seen == hashes[left]
            out[left[hit]] = self.runs[slot[hit]]
            on = ~hit & (seen != 0)
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        return out

    def add(self, hashes: np.ndarray, runs: np.ndarray) -> None:
        """Distinct hashes that are not there."""
        self.used += len(hashes)
        slot, left = (hashes >> self.shift).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[left[free]]  # of several for one slot the last stays
            mine = self.keys[slot] == hashes[left]
            self.runs[slot[mine]] = runs[left[mine]]
            left, slot = left[~mine], (slot[~mine] + 1) & (self.slots - 1)

    def store(self, ids: list[bytes]) -> np.ndarray:
        """Runs of new ids at the end of the pool."""
        length = np.array([len(x) // 4 for x in ids], np.int64)
        new = np.frombuffer(b"".join(ids), "<u4")
        if self.end + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.end], np.zeros(self.end + 2 * len(new), np.uint32)])
        self.pool[self.end : self.end + len(new)] = new
        runs = ((self.end + np.cumsum(length) - length) << 20) | length
        self.end += len(new)
        return runs


class WordEncoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit bytes; decode(ids) what the tokenizer decodes them to."""

    def __init__(self, path: str, slots: int = SLOTS):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec.get("model") or {}
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        #: what all added tokens begin with: a piece without it holds none
        self.mark = os.path.commonprefix(self.added)
        self.kind = "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.kind, self.pattern = "bytes", regex.compile(_BYTE_PATTERN)
        elif pre.get("type") == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
            split = pre["pretokenizers"][0]
            if split["behavior"] == "Removed" and split["invert"] and r"[^\s\p{L}\p{N}]+" in split["pattern"].get("Regex", ""):
                self.kind, self.pattern = "words", regex.compile(split["pattern"]["Regex"])
        if any(" " in t or "\n" in t for t in self.added) or any(t.get("normalized") for t in spec.get("added_tokens", [])) or model.get("dropout"):
            self.kind = "whole"
        #: what the normalizer does to plain characters is known
        steps = [n["type"] for n in (norm or {}).get("normalizers", [norm] if norm else [])]
        self.lowers = "Lowercase" in steps
        self.direct = self.kind != "whole" and bool(self.mark or not self.added) and model.get("type") == "BPE" and set(steps) <= {"NFC", "Replace", "Lowercase"}
        #: tokens are joined by a blank when the file names no decoder
        self.joins = spec.get("decoder") is None
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.raw = [i.to_bytes(4, "little") for i in range(self.size)]
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)] if self.joins else []
        self.merge = self.tokenizer.model.tokenize
        self.feed = self.whole("\n")
        self.table = Table(slots)
        self.power, self.inverse = (self._powers(x, 4 * TOGETHER) for x in (_BASE, pow(_BASE, -1, 2**64)))
        #: how many pieces were encoded
        self.made = 0

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        x = np.full(n, base, np.uint64)
        x[0] = 1
        return np.cumprod(x, dtype=np.uint64)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def decode(self, ids: bytes) -> str:
        of = memoryview(ids).cast("I").tolist()
        return " ".join(map(self.tokens.__getitem__, of)) if self.joins else self.tokenizer.decode(of, skip_special_tokens=False)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        run, size = [], 0
        for i, t in enumerate(texts):
            if self.kind == "whole" or "\0" in t or len(t) > TOGETHER or (self.mark in t and any(a in t for a in self.added)) or (self.kind == "bytes" and (t[-1:] == " " or "  " in t or "\n\n" in t or " \n" in t or "\n " in t)):
                out[i] = self._apart(t)
                continue
            raw = t.encode("utf-8", "surrogatepass")
            if run and size + len(raw) > 2 * TOGETHER:
                self._run(run, texts, out)
                run, size = [], 0
            run.append((i, raw))
            size += len(raw)
        if run:
            self._run(run, texts, out)
        return out

    def _run(self, run: list[tuple[int, bytes]], texts: list[str], out: list) -> None:
        """The ids of some texts, from their pieces: an event is a blank, line feed or end of a text, which no piece holds, or the place of a cut."""
        raw = b"\0" + b"\0".join([r for _, r in run]) + b"\0"
        x = np.frombuffer(raw, np.uint8)
        c = _CLASS[x]
        apart = (c >= _BLANK) & (c <= _END)
        event = apart.copy()
        event[1:] |= ((c[:-1] == _LETTER) & (c[1:] == _SIGN)) | ((c[:-1] == _SIGN) & (c[1:] == _LETTER))
        at = np.flatnonzero(event)
        kind = np.where(apart[at], c[at], 0)[:-1]
        start, end = at[:-1] + apart[at[:-1]], at[1:]
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x.astype(np.uint64) * self.inverse[: len(x)], out=total[1:])
        h = (total[end] - total[start]) * self.power[end]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX[0]) + (end - start).astype(np.uint64) * np.uint64(_MIX[1])
        if self.kind == "bytes":
            h += (kind == _BLANK).astype(np.uint64) * np.uint64(_MIX[2])
        h ^= h >> np.uint64(29)
        h[h == 0] = 1
        solid = np.flatnonzero(end > start)
        if self.table.used + len(solid) > self.table.slots * 6 // 10:
            self.table.clear()
        runs = np.zeros(len(start), np.int64)
        runs[solid] = self.table.find(h[solid])
        new = solid[runs[solid] < 0]
        if len(new):
            hashes, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            of = new[first]
            blank = (kind[of] == _BLANK).tolist()
            made = self.table.store(self.learn([raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(start[of].tolist(), end[of].tolist(), strict=True)], blank))
            keep = end[of] - start[of] <= LONGEST
            self.table.add(hashes[keep], made[keep])
            runs[new] = made[back]
        if self.kind == "bytes":  # a line feed's ids go before the piece after it
            feed = self.table.store([self.feed])[0]
            runs = np.stack([np.where(kind == _FEED, feed, 0), runs], axis=1).ravel()
        length = runs & 0xFFFFF
        ends = np.cumsum(length)
        ids = self.table.pool[np.repeat((runs >> 20) - (ends - length), length) + np.arange(ends[-1])].astype("<u4")
        step = len(runs) // len(kind)
        first = np.flatnonzero(kind == _END) * step
        cuts = np.append((ends - length)[first], ends[-1]).tolist()
        rare = set()
        if self.kind == "bytes":  # white space that is neither blank nor line feed, or may be
            rare = set((np.searchsorted(np.flatnonzero(c == _END), np.flatnonzero(c == _RARE)) - 1).tolist())
            rare = {k for k in rare if _OTHER.search(texts[run[k][0]])}
        for k, (i, _) in enumerate(run):
            out[i] = self._apart(texts[i]) if k in rare else ids[cuts[k] : cuts[k + 1]].tobytes()

    def _apart(self, text: str) -> bytes:
        """A byte-level text with runs of white space, cut where single blanks are sure; else the whole text."""
        if self.kind != "bytes" or any(t in text for t in self.added):
            return self.whole(text)
        parts = self.tokenizer.encode_batch_fast(_SINGLE.split(text), add_special_tokens=False)
        return b"".join([array("I", e.ids).tobytes() for e in parts])

    def learn(self, pieces: list[str], blank: list[bool]) -> list[bytes]:
        """The ids of pieces; byte-level: of a blank and the piece where one goes before it."""
        out, rest, merge, raw, byte, lowers, mark = [], [], self.merge, self.raw, self.kind == "bytes", self.lowers, self.mark
        self.made += len(pieces)
        for k, (p, b) in enumerate(zip(pieces, blank, strict=True)):
            if not self.direct:
                rest.append(k)
                out.append(b"")
            elif p.isascii() and p.isalpha():  # one pre-token, nearly always
                out.append(b"".join([raw[t.id] for t in merge("\u0120" + p if byte and b else p.lower() if lowers else p)]))
            elif _PLAIN.fullmatch(p) and not (mark and mark in p):
                text = p.lower() if lowers else " " + p if byte and b else p
                out.append(b"".join([raw[t.id] for q in ([text] if text.isalpha() else self.pattern.findall(text)) for t in merge(letters(q))]))
            else:
                rest.append(k)
                out.append(b"")
        if rest:
            texts = [" " + pieces[k] if byte and blank[k] else pieces[k] for k in rest]
            for k, e in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                out[k] = array("I", e.ids).tobytes()
        return out


def encoder(path: str, slots: int = SLOTS) -> WordEncoder:
    """One per Python worker, so that its table lasts over batches and tasks."""
    return worker_memo(f"words {path} {slots}", lambda: WordEncoder(path, slots))
