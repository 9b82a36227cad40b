"""Encoding of a corpus with a public byte-level BPE tokenizer, by a pair occurrence index.

All new pieces of a batch lie end to end in one array. An index maps each pair, by its rank, to all its positions; the
active ranks are applied in ascending order, each to all positions at once, and only the lists of the neighbouring
pairs are updated. A piece is a part of a pre-token that no token can reach across (no token of the vocabulary holds
the two bytes at the cut side by side), so the ids of a pre-token are exactly those of its pieces in a row, and text
without spaces shares most of its pieces.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level BPE cuts a text into pre-tokens.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_CHARS = 1_500_000  # characters encoded at a time, unless one text is longer
CACHE_PIECES = 400_000  # pieces a worker remembers; past that it starts afresh


def _byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in vocabulary files of this kind, by their rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def load_merges(path: str) -> dict:
    """Arrays of a byte-level BPE vocabulary file: the id of each byte, merges by rank, byte pairs inside tokens."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, letters = model["vocab"], _byte_letters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    byte_id = np.zeros(256, np.int64)
    for ch, b in letters.items():
        byte_id[b] = vocab[ch]
    inside = np.zeros((256, 256), bool)
    for a, b in merges:
        raw = [letters[ch] for ch in a + b]
        inside[raw[:-1], raw[1:]] = True
    return {"left": left, "right": right, "made": made, "byte_id": byte_id, "inside": inside}


class PairIndex:
    """Merges of a vocabulary, applied to many pieces at once."""

    def __init__(self, tables: dict):
        self.left, self.right, self.made, self.byte_id, self.inside = (tables[k] for k in ("left", "right", "made", "byte_id", "inside"))
        key = self.left << 20 | self.right
        self.rank_of = np.argsort(key, kind="stable")
        self.keys = key[self.rank_of]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is none."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def merge(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and the offset of each piece; ``begins`` are the pieces' starts in ``raw``."""
        n = len(raw)
        tok = self.byte_id[raw]
        first = np.zeros(n + 1, bool)
        first[begins] = True
        first[n] = True
        nxt = np.arange(1, n + 1)
        nxt[first[1:]] = -1
        prv = np.arange(-1, n - 1)
        prv[first[:-1]] = -1
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(pos: np.ndarray, rank: np.ndarray) -> None:
            ok = rank >= 0
            pos, rank = pos[ok], rank[ok]
            if not len(pos):
                return
            order = np.argsort(rank, kind="stable")
            pos, rank = pos[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, p in zip(rank[np.r_[0, cuts]].tolist(), np.split(pos, cuts)):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(heap, r)

        start = np.flatnonzero(nxt >= 0)
        add(start, self.ranks(tok[start], tok[start + 1]))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            pos = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[r], self.right[r]
            to = nxt[pos]
            pos = pos[alive[pos] & (to >= 0) & (tok[pos] == a) & (tok[to] == b)]
            if a == b and len(pos) > 1:
                keep, last = [], -1  # of overlapping places the leftmost goes first
                for p in pos.tolist():
                    if p != last:
                        keep.append(p)
                        last = nxt[p]
                pos = np.array(keep)
            if not len(pos):
                continue
            gone = nxt[pos]
            after = nxt[gone]
            tok[pos] = self.made[r]
            alive[gone] = False
            nxt[pos] = after
            on = after >= 0
            prv[after[on]] = pos[on]
            before = prv[pos]
            p = np.concatenate([before[before >= 0], pos[on]])
            add(p, self.ranks(tok[p], tok[nxt[p]]))
        count = np.add.reduceat(alive, begins) if len(begins) else np.zeros(0, np.int64)
        return tok[alive].astype(np.int32), np.concatenate([[0], np.cumsum(count)])


def _hash_pieces(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece, its length mixed in."""
    base = 0xD6E8FEB86659FD93
    inv = np.uint64(pow(base, -1, 1 << 64))
    n = len(raw)
    down = np.full(n + 1, inv, np.uint64)
    up = np.full(n + 1, np.uint64(base), np.uint64)
    down[0] = up[0] = 1
    np.multiply.accumulate(down, out=down)
    np.multiply.accumulate(up, out=up)
    v = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(v * down[:n], out=s[1:])
    h = (s[ends] - s[begins]) * up[ends] + (ends - begins).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x94D049BB133111EB)


def _gather(offsets: np.ndarray, values: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ragged rows ``which`` in a row, and the length of each."""
    size = (offsets[1:] - offsets[:-1])[which]
    total = int(size.sum())
    shift = np.repeat(offsets[:-1][which] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(which) else np.zeros(0, np.int64)
    return values[np.arange(total) + shift], size


class Encoder:
    """Ids of many texts; remembers pieces between calls."""

    def __init__(self, tables: dict):
        import regex

        self.find = regex.compile(PATTERN).findall
        self.index = PairIndex(tables)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted hashes of pieces
        self.row = np.empty(0, np.int64)
        self.offsets, self.values = np.zeros(1, np.int64), np.empty(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the number of ids of each text."""
        seen: dict[str, int] = {}
        which: list[int] = []
        count = np.zeros(len(texts), np.int64)
        put = seen.setdefault
        for i, t in enumerate(texts):
            words = self.find(t)
            count[i] = len(words)
            which += [put(w, len(seen)) for w in words]
        if not seen:
            return np.empty(0, np.int32), count
        blob = [w.encode("utf-8", "replace") for w in seen]
        raw = np.frombuffer(b"".join(blob), np.uint8)
        size = np.fromiter(map(len, blob), np.int64, len(blob))
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = ~self.index.inside[raw[:-1], raw[1:]]
        ends = np.cumsum(size)
        cut[0] = True
        cut[ends] = True
        marks = np.flatnonzero(cut)
        begins, stops = marks[:-1], marks[1:]
        h = _hash_pieces(raw, begins, stops)
        at = self._rows(h, raw, begins, stops)
        ids, lens = _gather(self.offsets, self.values, at)
        word_pieces = np.searchsorted(stops, ends, side="right")
        piece_ends = np.concatenate([[0], np.cumsum(lens)])
        word_off = piece_ends[np.concatenate([[0], word_pieces])]
        out, n = _gather(word_off, ids, np.array(which, np.int64))
        upto = np.concatenate([[0], np.cumsum(n)])
        last = np.cumsum(count)
        return out, upto[last] - upto[last - count]

    def _rows(self, h: np.ndarray, raw: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Row of each piece in the remembered ones; new pieces are merged first."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, uniq), len(self.known) - 1)
            new = self.known[at] != uniq
        else:
            new = np.ones(len(uniq), bool)
        if new.any():
            b, e = begins[first[new]], stops[first[new]]
            order = np.argsort(b)
            b, e = b[order], e[order]
            span = e - b
            fresh_begin = np.cumsum(span) - span
            own = raw[np.repeat(b - fresh_begin, span) + np.arange(int(span.sum()))]
            ids, off = self.index.merge(own, fresh_begin)
            rows = len(self.offsets) - 1 + np.arange(len(b))
            self.offsets = np.concatenate([self.offsets, off[1:] + self.offsets[-1]])
            self.values = np.concatenate([self.values, ids])
            known = np.concatenate([self.known, uniq[new][order]])
            row = np.concatenate([self.row, rows])
            by = np.argsort(known, kind="stable")
            self.known, self.row = known[by], row[by]
        return self.row[np.searchsorted(self.known, uniq)][back]


_encoders: dict[str, Encoder] = {}


def encode_texts(docs: DataFrame, tokenizer: str = "/opt/tokenizers/byte_bpe_50k.json", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each row's whole text, without special tokens; their strings are ordinary text.

    A null and an empty text both give an empty list; rows with a null key stay. The vocabulary is read once on the
    driver and broadcast; its size is that of the public file, whatever the corpus.
    """
    tables = docs.sparkSession.sparkContext.broadcast(load_merges(tokenizer))
    schema = pa.schema([(key, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tables.value))
        for batch in batches:
            keys, texts = batch.column(0).cast(pa.int64()), batch.column(1).to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b] or "") <= BLOCK_CHARS):
                    size += len(texts[b] or "")
                    b += 1
                ids, n = coder.encode([t or "" for t in texts[a:b]])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), lists], schema=schema)
                a = b

    return docs.select(F.col(key).cast("bigint").alias(key), F.col(text).alias(text)).mapInArrow(run, f"{key} bigint, ids array<int>")
