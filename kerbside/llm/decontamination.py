"""Benchmark decontamination: windows as long as a benchmark item, found by SimHash, verified exactly.

Every document is read with windows of each item's number of words; one with fewer words than the item
is one window as a whole. A window and an item
are sets of word shingles with multiplicities; similarity is the sum of smaller
multiplicities over the sum of larger ones. Windows that hold too few shingles of the
benchmark for any item of their length are left out, which loses nothing. The others get
a 64-bit SimHash; it is split in blocks, and an index over each block finds every item
whose fingerprint differs by at most ``RADIUS`` bits, as such an item differs from the
window by at most ``RADIUS`` / blocks bits in at least one of them. Candidates are then compared exactly.

The benchmark is indexed in parts of bounded size; each part is sent to every task.

Defined cases: null and empty texts and items have no words and match nothing; an item of
fewer than five words is one shingle and only matches itself; equal items each match;
repeated rows give repeated hits once; an empty benchmark gives no hits.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.texts import Hashes, keyed, map_blocks, mixed, offsets, runs_hashed

WORDS, PERCENT = 5, 75
#: Bits by which linked fingerprints may differ. At similarity 0.75 the mean is 11 and the deviation 3.
RADIUS = 23
BLOCKS, BLOCK_BITS = 4, 16
#: Bytes of benchmark text indexed at once.
PART_BYTES = 4 << 20
FILTER_BITS = 22
#: Text bytes searched at once.
SEARCHED_BYTES = 1 << 20


def word_list(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of bit sums."""
    return np.packbits(sums > 0, axis=-1, bitorder="little").view(np.uint64)[..., 0]


def bit_signs(shingles: np.ndarray) -> np.ndarray:
    """A row of ones and minus ones a shingle."""
    bits = np.unpackbits(mixed(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


class BlockIndex:
    """Finds all fingerprints within ``RADIUS`` bits, by tables over blocks of their bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        near = RADIUS // BLOCKS
        self.masks = np.array(
            [sum(1 << b for b in bits) for k in range(near + 1) for bits in combinations(range(BLOCK_BITS), k)], np.int64
        )
        # Fewer items than neighbours of a block: these are looked at one by one, without tables (2 MB a length of items).
        self.few = len(prints) * 8 <= len(self.masks)
        self.tables = []
        for block in range(0 if self.few else BLOCKS):
            value = self._block(prints, block)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1))))

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        return (prints >> np.uint64(block * BLOCK_BITS) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) numbers of all pairs within the radius."""
        found = []
        if self.few:
            for a in range(0, len(prints), 4096):
                differ = prints[a:a + 4096, None] ^ self.prints[None, :]
                close = np.zeros(differ.shape, bool)
                for block in range(BLOCKS):
                    close |= np.bitwise_count(self._block(differ, block)) <= RADIUS // BLOCKS
                window, item = np.nonzero(close)
                found.append((window + a, item))
        else:
            for window, value in enumerate(prints):
                for block, (order, start) in enumerate(self.tables):
                    at = int(self._block(value[None], block)[0]) ^ self.masks
                    some = at[start[at + 1] > start[at]]
                    items = [order[start[x]:start[x + 1]] for x in some]
                    if items:
                        items = np.concatenate(items)
                        found.append((np.full(len(items), window), items))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=1)
        within = np.bitwise_count(prints[pairs[0]] ^ self.prints[pairs[1]]) <= RADIUS
        return pairs[0][within], pairs[1][within]


class Items:
    """A part of the benchmark: its shingles, fingerprints and multiplicities, by length in words."""

    def __init__(self, rows: list[tuple[object, str]]):
        hashes = Hashes()
        by_length: dict[int, list] = {}
        every: dict[int, list] = {}
        for item, text in rows:
            words = word_list(text)
            if not words:
                continue
            width = min(WORDS, len(words))
            codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
            own = runs_hashed(codes, width)
            every.setdefault(width, []).append(own)
            by_length.setdefault(len(words), []).append((item, fingerprint(bit_signs(own).sum(0)[None])[0], shingle_counts(words)))
        self.lengths = {
            n: ([i for i, _, _ in found], BlockIndex(np.array([p for _, p, _ in found], np.uint64)), [c for _, _, c in found])
            for n, found in sorted(by_length.items())
        }
        self.known = {width: np.unique(np.concatenate(parts)) for width, parts in every.items()}
        self.filters = {}
        for width, known in self.known.items():
            self.filters[width] = np.zeros(1 << FILTER_BITS, bool)
            self.filters[width][(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, width: int, shingles: np.ndarray) -> np.ndarray:
        """Places whose shingle some item has."""
        at = np.flatnonzero(self.filters[width][(shingles >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        known = self.known[width]
        spot = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        return at[known[spot] == shingles[at]]


def shingle_counts(words: list[bytes]) -> Counter:
    width = min(WORDS, len(words))
    return Counter(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both)


def enough(count: int, other: int | None = None) -> int:
    """Common shingles that windows of ``count`` and ``other`` (or ``count``) shingles need."""
    return -(-(count + (count if other is None else other)) * PERCENT // (100 + PERCENT))


def document_hits(words: list[bytes], shingles: dict[int, np.ndarray], hits: dict[int, np.ndarray], items: Items):
    """(item, first word, words, similarity), the best window of each item in one document."""
    best: dict = {}
    sums: dict[int, np.ndarray] = {}
    for n, (ids, index, counts) in items.lengths.items():
        width = min(WORDS, n)
        size, places = n - width + 1, hits[width]
        last = max(0, len(words) - n)
        own = min(size, len(words) - width + 1)  # shingles of a window
        k = enough(size, own)
        if own < k or len(places) < k:
            continue
        # A window holds its least number of hits when its k-th hit from some place on is near enough.
        close = np.flatnonzero(places[k - 1:] - places[:len(places) - k + 1] < own)
        starts = [np.arange(max(0, places[c + k - 1] - own + 1), min(last, places[c]) + 1) for c in close]
        if not starts:
            continue
        starts = np.unique(np.concatenate(starts))
        if width not in sums:
            signs = bit_signs(shingles[width])
            sums[width] = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)))
        prints = fingerprint(sums[width][starts + own] - sums[width][starts])
        windows: dict[int, Counter] = {}
        for w, i in zip(*(x.tolist() for x in index.near(prints)), strict=True):
            if w not in windows:
                windows[w] = shingle_counts(words[starts[w]:starts[w] + n])
            alike = similarity(windows[w], counts[i])
            if 100 * alike >= PERCENT and alike > best.get(ids[i], (0, 0, 0.0))[2]:
                best[ids[i]] = (int(starts[w]), min(n, len(words)), alike)
    return [(item, *found) for item, found in best.items()]


def _find(rows: DataFrame, items: Items, kind: str, item_kind: str) -> DataFrame:
    hashes: list[Hashes] = []

    def work(block):
        own = hashes[0] if hashes else hashes.append(Hashes()) or hashes[0]
        words = [word_list(t) for t in block[1]]
        starts = offsets([len(w) for w in words])
        codes = np.fromiter(map(own.__getitem__, (w for ws in words for w in ws)), np.uint64, starts[-1])
        shingles = {width: runs_hashed(codes, width) for width in items.known}
        hits = {width: items.hits(width, s) for width, s in shingles.items()}
        out = {"key": [], "item": [], "start_word": [], "n_words": [], "similarity": []}
        some = np.unique(np.concatenate([np.searchsorted(starts, h, "right") - 1 for h in hits.values()] or [np.empty(0, np.int64)]))
        for d in some.tolist():
            a, b = starts[d], starts[d + 1]
            inside = {}
            for width, h in hits.items():
                lo, hi = np.searchsorted(h, (a, b - width + 1))
                inside[width] = h[lo:hi] - a
            local = {width: s[a:max(a, b - width + 1)] for width, s in shingles.items()}
            for row in document_hits(words[d], local, inside, items):
                for name, value in zip(out, (block[0][d].as_py(), *row), strict=True):
                    out[name].append(value)
        return out

    return map_blocks(rows, work, f"key {kind}, item {item_kind}, start_word long, n_words long, similarity double", SEARCHED_BYTES, with_key=False)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item, start_word, n_words, similarity) for every item that a document holds nearly whole."""
    kind, item_kind = dict(docs.dtypes)[key], dict(benchmark.dtypes)[item]
    known = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null").distinct()
    parts = max(1, -(-(known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    rows, found = keyed(docs, key, text), None
    for part in range(parts):
        own = known.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        here = _find(rows, Items(sorted(((r.item, r.text) for r in own), key=repr)), kind, item_kind)
        found = here if found is None else found.unionAll(here)
    best = found.groupBy("key", "item").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("before"), "n_words")).alias("best")
    )
    return best.select(
        F.col("key").alias(key), F.col("item").alias(item), (-F.col("best.before")).alias("start_word"),
        F.col("best.n_words").alias("n_words"), F.col("best.similarity").alias("similarity"),
    )


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
