"""Benchmark decontamination by the q-gram lemma.

A passage within k edits of an item of m characters keeps at least
m - q + 1 - k*q of the item's q-grams, and its shared q-grams lie on at most
2k + 1 neighbouring diagonals (place in the text minus place in the item).
So per text the shared q-grams are counted in bands of diagonals, each twice as
wide as needed and overlapping by half, regions that reach the bound are kept,
and a banded alignment of item and region decides.

Items of fewer than q characters have no q-gram: they are looked up as they are,
at the words' borders.

Items are dealt to the tasks in blocks of bounded size; each block meets every
text once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


Q = 8
EDITS = 0.1                  # edits allowed per character of an item
MIN_CHARS = 1                # every item that has a word is searched for
BLOCK_CHARS = 8_000_000      # characters of items that are sent to the tasks at once
ITEM_CHARS = 40              # an item counts as so many characters at least there
_SLOTS = 21
_OUTSIDE = np.uint32(0xFFFFFFFF)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _wordlike(a: np.ndarray) -> np.ndarray:
    return (a >= 128) & (a != 160) & ((a < 0x2000) | (a > 0x206F)) & ((a < 0x3000) | (a > 0x3004)) | (a >= 48) & (a <= 57) | (a >= 97) & (a <= 122)


_TABLE = bytes(c if _wordlike(np.array([c]))[0] else 32 for c in range(256))


def normal(text: str) -> np.ndarray:
    """Code points of the text in lower case, every run of other characters than letters and digits one blank,
    none at the ends.  Bytes where all of them fit (no copy), else 32 bits each."""
    low = text.lower()
    try:
        return np.frombuffer(b" ".join(low.encode("latin-1").translate(_TABLE).split()), np.uint8)
    except UnicodeEncodeError:
        a = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = _wordlike(a)
        a = np.where(ok, a, np.uint32(32))[ok | np.concatenate([[False], ok[:-1]])]
        return a[:-1] if len(a) and a[-1] == 32 else a


def grams(a: np.ndarray) -> np.ndarray:
    """The q-gram that starts at each place, one byte a character; characters that fall on the same byte only add
    chances for the alignment to refuse."""
    if len(a) < Q:
        return np.zeros(0, np.uint64)
    low = a if a.dtype == np.uint8 else (a ^ (a >> 8)).astype(np.uint8)
    return np.ndarray((len(a) - Q + 1,), "<u8", np.ascontiguousarray(low), strides=(1,))


def _unspaced(a: np.ndarray) -> np.ndarray:
    """Characters of scripts that put no blanks between words (Thai to Myanmar, Khmer, kana, Han): each borders on words."""
    return ((a >= 0x0E00) & (a <= 0x0EFF) | (a >= 0x1000) & (a <= 0x109F) | (a >= 0x1780) & (a <= 0x17FF) | (a >= 0x2E80) & (a <= 0x312F)
            | (a >= 0x31A0) & (a <= 0xA4CF) & ~((a >= 0x3200) & (a <= 0x33FF)) | (a >= 0xF900) & (a <= 0xFAFF) | (a >= 0xFF00) & (a <= 0xFF0F)
            | (a >= 0xFF1A) & (a <= 0xFF20) | (a >= 0xFF66) & (a <= 0xFF9F) | (a >= 0x20000) & (a <= 0x3FFFF))


def borders(a: np.ndarray) -> np.ndarray:
    """For each place from 0 to len(a): whether a word can begin or end there."""
    free = (a == 32) | _unspaced(a) if a.dtype != np.uint8 else a == 32
    return np.concatenate([[True], free[1:] | free[:-1], [True]]) if len(a) else np.ones(1, bool)


def _slot(g: np.ndarray) -> np.ndarray:
    return (g * _MULT) >> np.uint64(64 - _SLOTS)


def _keys(a: np.ndarray, m: int) -> np.ndarray:
    """The m characters (fewer than q) from each place as one number, one byte a character as in grams()."""
    return grams(np.concatenate([a, np.zeros(Q - 1, a.dtype)])) & np.uint64((1 << 8 * m) - 1)


class Items:
    """A block of items, indexed by q-gram."""

    def __init__(self, items: list[tuple], edits: float = EDITS):
        self.ids, self.codes, self.k = [], [], []
        grams_, owner, place = [], [], []
        short: dict[int, dict[bytes, list]] = {}  # by length, by text: the ids
        for item, text in items:
            a = normal(text or "").astype(np.uint32)
            if len(a) < MIN_CHARS:
                continue
            if len(a) < Q:
                short.setdefault(len(a), {}).setdefault(a.tobytes(), []).append(item)
                continue
            n = len(self.codes)
            self.ids.append(item)
            self.codes.append(a)
            # so many edits that the bound stays at 1 shared q-gram or more
            self.k.append(min(int(len(a) * edits), (len(a) - Q) // Q))
            g = grams(a)
            grams_.append(g)
            owner.append(np.full(len(g), n))
            place.append(np.arange(len(g)))
        g = np.concatenate(grams_) if grams_ else np.zeros(0, np.uint64)
        order = np.argsort(g, kind="stable")
        self.grams = g[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, int)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, int)
        self.slots = np.zeros(1 << _SLOTS, bool)
        self.slots[_slot(self.grams)] = True
        self.size = np.array([len(c) for c in self.codes], dtype=int)
        self.edits = np.array(self.k, dtype=int)
        self.need = self.size - Q + 1 - self.edits * Q
        self.short = []  # of each length: it, sorted keys, texts and ids in that order
        for m, ids in short.items():
            codes = np.frombuffer(b"".join(ids), np.uint32).reshape(-1, m)
            keys = _keys(codes.reshape(-1), m)[::m]
            order = np.argsort(keys, kind="stable")
            ids = list(ids.values())
            self.short.append((m, keys[order], codes[order], [ids[i] for i in order]))

    def search(self, text: str | None) -> dict[int, tuple[int, int]]:
        """item -> (edits, place) of the best passage of the text within the item's budget."""
        if not text:
            return {}
        a = normal(text)
        out = self._near(a) if len(self.grams) else {}
        return out | self._exact(a) if self.short else out

    def _exact(self, a: np.ndarray) -> dict[int, tuple[int, int]]:
        """The items without q-grams that stand in the text between borders."""
        out: dict[int, tuple[int, int]] = {}
        border = borders(a)
        for m, keys, codes, ids in self.short:
            if len(a) < m:
                continue
            at = np.flatnonzero(border[:len(a) - m + 1] & border[m:])
            key = _keys(a, m)[at]
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            # texts that fall on the same key one by one
            while (more := lo < hi).any():
                at, lo, hi = at[more], lo[more], hi[more]
                same = (a[at[:, None] + np.arange(m)] == codes[lo]).all(1)
                first, where = np.unique(lo[same], return_index=True)
                for i, p in zip(first.tolist(), at[same][where].tolist()):
                    out |= {item: (0, p + m) for item in ids[i]}
                lo = lo + 1
        return out

    def _near(self, a: np.ndarray) -> dict[int, tuple[int, int]]:
        g = grams(a)
        at = np.flatnonzero(self.slots[_slot(g)])
        if not len(at):
            return {}
        lo, hi = np.searchsorted(self.grams, g[at], "left"), np.searchsorted(self.grams, g[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            return {}
        # every (place in the text, place in an item) of a shared q-gram
        which = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, diagonal = self.owner[which], np.repeat(at, n) - self.place[which]
        enough = np.bincount(item, minlength=len(self.size)) >= self.need
        item, diagonal, place = item[enough[item]], diagonal[enough[item]], self.place[which][enough[item]]
        out: dict[int, tuple[int, int]] = {}
        if not len(item):
            return out
        half = 2 * self.edits[item] + 1
        low = np.floor_divide(diagonal, half)
        # each shared q-gram is in two bands, low - 1 and low; one number per (item, band)
        shift = 1 - int(low.min())
        span = int(low.max()) + shift + 1
        band = np.concatenate([item * span + low + shift, item * span + low + shift - 1])
        place = np.concatenate([place, place])
        bands, back, count = np.unique(band, return_inverse=True, return_counts=True)
        full = count >= self.need[bands // span]
        if not full.any():
            return out
        # a q-gram of the item counts once in a band
        sure = full[back]
        widest = int(self.size.max())
        bands, count = np.unique(np.unique(band[sure] * widest + place[sure]) // widest, return_counts=True)
        bands = bands[count >= self.need[bands // span]]
        for i, b in zip((bands // span).tolist(), (bands % span - shift).tolist()):
            k, m = int(self.edits[i]), int(self.size[i])
            # an alignment through a diagonal of the band strays k from it at most
            start, width = b * (2 * k + 1) - k, 2 * (2 * k + 1) + 2 * k
            region = np.full(m + width, _OUTSIDE, np.uint32)
            inside = a[max(0, start):max(0, start + m + width)]
            region[max(0, -start):max(0, -start) + len(inside)] = inside
            best = align(self.codes[i], region, k)
            if best is not None and (i not in out or best[0] < out[i][0]):
                out[i] = (best[0], start + best[1])
        return {self.ids[i]: v for i, v in out.items()}


def align(item: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int] | None:
    """(edits, end) of the passage of the region nearest to the item, if within k edits.

    Only the band of diagonals 0 .. len(region) - len(item) is filled, a row of
    them per character of the item; the start is free on every diagonal, an
    insertion run is a running minimum.  What lies outside the text matches
    nothing, which costs what leaving out the item's character costs.
    """
    whole = _find(item, region)
    if whole >= 0:
        return 0, whole + len(item)
    width = len(region) - len(item)
    ramp = np.arange(width + 1)
    row = np.zeros(width + 1, int)
    far = np.array([len(item) + 1])
    for i, ch in enumerate(item.tolist()):
        new = np.minimum(row + (region[i:i + width + 1] != ch), np.concatenate([row[1:], far]) + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
        if row.min() > k:
            return None
    d = int(row.argmin())
    return int(row[d]), len(item) + d


def _find(item: np.ndarray, region: np.ndarray) -> int:
    p, b, i = -1, region.astype("<u4").tobytes(), item.astype("<u4").tobytes()
    while (p := b.find(i, p + 1)) >= 0:
        if p % 4 == 0:
            return p // 4
    return -1


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Items in blocks of at most BLOCK_CHARS (one longer item is a block of its own)."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").filter(F.length("text") >= MIN_CHARS).orderBy("item_id", "text").toLocalIterator():
        n = max(len(r["text"]), ITEM_CHARS)
        if block and size + n > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def _search(items_of, schema_names: list[str], text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(items_of.value)
        for b in batches:
            found = [items.search(t) for t in b.column(text).to_pylist()]
            cols = [b.column(c) for c in schema_names]
            hits = [[{"item_id": i, "edits": e} for i, (e, _) in sorted(f.items(), key=lambda x: (x[0] is None, x[0] or 0))] for f in found]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(hits, kind)], [*schema_names, out])
    return run


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks") -> DataFrame:
    """All rows and columns with ``leaks``: array of (item_id, edits) of the items within their edit budget.

    Null and empty texts, null items and items without a word give nothing;
    items under Q characters when normalised count where they stand unchanged
    between borders of words (in scripts without blanks, anywhere); an item id
    with several texts is one entry per text block; repeated rows get equal
    results; a column named as ``out`` is replaced.
    """
    keep = [f for f in docs.schema if f.name != out]
    names = [f.name for f in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"`{out}` array<struct<item_id:bigint,edits:int>>"])
    result, first = docs.select(*names), True
    for block in _blocks(benchmark):
        items = docs.sparkSession.sparkContext.broadcast(block)
        if first:
            result, first = result.mapInArrow(_search(items, names, text, out), schema), False
        else:
            more = f"__{out}"
            result = result.mapInArrow(_search(items, [*names, out], text, more), schema + f", `{more}` array<struct<item_id:bigint,edits:int>>")
            result = result.withColumn(out, F.concat(out, more)).drop(more)
    if first:
        result = result.withColumn(out, F.array().cast("array<struct<item_id:bigint,edits:int>>"))
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no passage of the benchmark, with their own columns."""
    return find_items(docs, benchmark, out="__leaks").filter(F.size("__leaks") == 0).drop("__leaks")


