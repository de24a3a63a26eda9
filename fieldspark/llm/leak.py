"""Evaluation passages inside a training corpus.

An item is looked for in two sizes of window: windows of its own size, for copies of the whole item with some words
changed, and windows of ``words`` words, the shortest passage to report, for parts of it. All windows are compared by
64-bit SimHash fingerprints. Cut into blocks of bits, two fingerprints within the radius must nearly agree in at least
one block (exactly, with one block more than the radius; up to one bit, with half as many), so looking up each block
finds every window within the radius. Candidates are verified by the exact weighted Jaccard similarity of their
five-word shingles (weights: rarity among all items' shingles; a shingle the item lacks weighs as much as the rarest),
and each verified window tells whether ``words`` consecutive words of the item stand in it unchanged.

Windows of an item's size come in sizes that grow by GRID; an item takes the largest that fits and is looked for by its
beginning and by its end, and verified over its whole length.

The items are the query set; the corpus is never shuffled. The items are shipped in blocks of about BLOCK_WORDS words, one
pass over the corpus per block, whose finds are written down before the next one begins. A worker indexes a block once.

Defined results
- a word is a run of letters or digits; case, punctuation, markup, spacing, invisible characters and
  the encoding of a character make no difference.
- NULL or empty text, and items or documents with fewer than ``words`` words: no rows.
- an item that repeats a passage, or a passage repeated in the document, counts once per pair.
- repeated documents (same id) are one; an empty table on either side gives no rows.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.session import cut

WORDS = 12
SHINGLE = 5
RADIUS = 2
SIMILARITY = 0.8
#: Radius of item-sized windows: the shingle similarity allows about one changed word in 50, some 4 of 64 bits.
ITEM_RADIUS = 7
GRID = 1.25
#: Words of items per pass over the corpus: a few MB shipped to each worker.
BLOCK_WORDS = 250_000
CHUNK_BYTES = 2_000_000

_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_MARKS = re.compile(r"[<&]")


@lru_cache(maxsize=1)
def _tools():
    import regex

    return regex.compile(r"[\p{Cf}\p{Cc}\p{Variation_Selector}--[\t-\r\x85]]+", regex.V1), regex.compile(r"[^\p{L}\p{N}\p{M}]+")


def plain(text: str) -> str:
    """Text with one blank between words: entities decoded, tags and invisible characters gone, one encoding per character."""
    if _MARKS.search(text):
        for _ in range(2):
            text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
        text = _TAG.sub(" ", text)
    if not text.isascii():
        invisible, other = _tools()
        text = invisible.sub("", unicodedata.normalize("NFKC", text))
        text = unicodedata.normalize("NFC", text.casefold())
        text = other.sub(" ", text)
    return text


# Bytes: letters and digits (and every byte of a longer character) stand for themselves, the rest for 0.
_CLASS = np.zeros(256, dtype=np.uint8)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _CLASS[_a:_b] = np.arange(_a, _b)
_CLASS[65:91] = np.arange(97, 123)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = 2 * CHUNK_BYTES
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _BASE, dtype=np.uint64)), np.cumprod(np.full(n, inverse, dtype=np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end of every word. Whatever the place, equal words have equal hashes."""
    b = _CLASS[np.frombuffer(data, dtype=np.uint8)]
    word = np.zeros(len(b) + 2, dtype=bool)
    word[1:-1] = b != 0
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers()
    if len(b) > len(up):  # one text longer than a chunk
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.cumprod(np.full(len(b), _BASE, dtype=np.uint64)), np.cumprod(np.full(len(b), inverse, dtype=np.uint64))
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(b * up[: len(b)], out=sums[1:])
    raw = (sums[end] - sums[start]) * down[start]
    return _mix(raw ^ ((end - start).astype(np.uint64) << np.uint64(56))), start, end


def window_simhash(words: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of ``size`` words: each bit by majority of the words' hash bits."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    step = 1 << 15
    for a in range(0, n, step):
        part = words[a : min(a + step, n) + size - 1]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        # sliding sums from sums of 1, 2, 4, ... neighbours
        total, have, power, width, rest = None, 0, bits, 1, size
        while rest:
            if rest & 1:
                piece = power[have:]
                total = piece if total is None else total[: len(power) - have] + piece[: len(total)]
                have += width
            rest >>= 1
            if rest:
                power = power[:-width] + power[width:]
                width *= 2
        m = min(step, n - a)
        out[a : a + m] = np.packbits(total[:m] > size // 2, axis=1).view(np.uint64).ravel()
    return out


def grid_size(n: int) -> int:
    """The largest window size of the grid that an item of n words holds; 0 if it is shorter than a passage."""
    size, step = 0, float(WORDS)
    while int(step) <= n:
        size, step = int(step), step * GRID
    return size


def sized_simhashes(words: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """The SimHash of every window, for several sizes, from one table of running sums (modulo 2^16, as no window is longer)."""
    out = {z: np.empty(max(0, len(words) - z + 1), dtype=np.uint64) for z in sizes}
    step, most = 1 << 14, max(sizes, default=0)
    for a in range(0, len(words), step):
        part = words[a : a + step + most - 1]
        sums = np.zeros((len(part) + 1, 64), dtype=np.uint16)
        np.cumsum(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.uint16, out=sums[1:])
        for z, prints in out.items():
            m = min(step, len(part) - z + 1, len(prints) - a)
            if m > 0:
                prints[a : a + m] = np.packbits((sums[z : z + m] - sums[:m]) > z // 2, axis=1).view(np.uint64).ravel()
    return out


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hash of every five-word shingle."""
    n = len(words) - SHINGLE + 1
    h = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(SHINGLE):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)])
    return h


def _blocks(count: int) -> list[tuple[np.uint64, np.uint64]]:
    """Shift and mask of each of ``count`` nearly equal blocks of 64 bits."""
    cuts = np.linspace(0, 64, count + 1).astype(int)
    return [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Prints:
    """Fingerprints, found again within a radius by blocks of bits: ``slack`` bits may differ in the block that is looked up.

    With (radius + 1) / (slack + 1) blocks, rounded up, some block of two fingerprints within the radius differs by at most ``slack`` bits.
    """

    def __init__(self, prints: np.ndarray, radius: int, slack: int = 0):
        self.prints, self.radius, self.sorted = prints, radius, []
        for shift, mask in _blocks(-(-(radius + 1) // (slack + 1))):
            key = (prints >> shift) & mask
            own = np.arange(len(prints))
            if slack:
                flips = [np.uint64(0), *[np.uint64(1 << i) for i in range(int(mask).bit_length())]]
                own, key = np.tile(own, len(flips)), np.concatenate([key ^ f for f in flips])
            order = np.argsort(key, kind="stable")
            # a bitmap over the block's low bits rejects most windows before the binary search
            low = np.uint64(min(int(mask), (1 << 20) - 1))
            bitmap = np.zeros(int(low) + 1, dtype=bool)
            bitmap[key & low] = True
            self.sorted.append((shift, mask, key[order], own[order], low, bitmap))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``prints``, place in the own fingerprints) of the pairs within the radius: all of them."""
        left, right = [], []
        for shift, mask, keys, own, low, bitmap in self.sorted:
            key = (prints >> shift) & mask
            at = np.flatnonzero(bitmap[key & low])
            if not len(at):
                continue
            lo, hi = np.searchsorted(keys, key[at], "left"), np.searchsorted(keys, key[at], "right")
            n = hi - lo
            text_w = np.repeat(at, n)
            item_w = own[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            near = np.bitwise_count(prints[text_w] ^ self.prints[item_w]) <= self.radius
            left.append(text_w[near])
            right.append(item_w[near])
        if not left:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pairs = np.unique(np.concatenate(left) * len(self.prints) + np.concatenate(right))
        return pairs // len(self.prints), pairs % len(self.prints)


class Items:
    """A block of items: fingerprints of their passages and of their item-sized windows, and their weighted shingles."""

    def __init__(self, ids: list[int], texts: list[str], size: int, radius: int, counts: dict[int, int] | None = None, n_items: int | None = None):
        self.size = size
        words, hashes, item, pos = [], [], [], []
        for k, t in enumerate(texts):
            data = plain(t).encode("utf-8", "ignore")
            h, s, e = word_hashes(data)
            low = data.lower()
            words.append([low[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)])
            hashes.append(h)
            n = max(0, len(h) - size + 1)
            item += [k] * n
            pos += range(n)
        self.ids, self.words = ids, words
        self.item, self.pos = np.array(item, dtype=np.int64), np.array(pos, dtype=np.int64)
        self.prints = np.concatenate([window_simhash(h, size) for h in hashes] or [np.zeros(0, dtype=np.uint64)])
        self.passages = Prints(self.prints, radius)
        self.candidates = self.passages.candidates
        # item-sized windows: (item, whether by its end) per grid size
        self.whole: dict[int, tuple[list[tuple[int, bool]], Prints]] = {}
        by_size: dict[int, list[int]] = {}
        for k, h in enumerate(hashes):
            if grid_size(len(h)) > size:
                by_size.setdefault(grid_size(len(h)), []).append(k)
        for z, ks in by_size.items():
            ends = [(k, end) for k in ks for end in (False, True)]
            prints = np.concatenate([window_simhash(hashes[k][-z:] if end else hashes[k][:z], z) for k, end in ends])
            self.whole[z] = (ends, Prints(prints, ITEM_RADIUS, slack=1))
        # shingles and weights by place, for windows, and as sorted sets, for whole items
        self.places = [shingle_hashes(h) for h in hashes]
        if counts is None:
            u, c = np.unique(np.concatenate([np.unique(g) for g in self.places] or [np.zeros(0, dtype=np.uint64)]), return_counts=True)
            counts = dict(zip(u.tolist(), c.tolist(), strict=True))
        n = n_items or max(1, len(words))
        self.rarest = float(np.log1p(n))
        weights = [np.array([np.log1p(n / counts.get(x, 1)) for x in g.tolist()]) for g in self.places]
        self.flat, self.flat_weights = np.concatenate(self.places or [np.zeros(0, dtype=np.uint64)]), np.concatenate(weights or [np.zeros(0)])
        self.first = np.cumsum([0] + [len(g) for g in self.places])
        self.sets = []
        for g, w in zip(self.places, weights, strict=True):
            u, at = np.unique(g, return_index=True)
            self.sets.append((u, w[at], float(w[at].sum())))
        self.passage_hashes = [np.unique(_runs(h, size)) for h in hashes]

    def similarity(self, k: int, shingles: np.ndarray, least: float = 0.0) -> float:
        """Weighted Jaccard similarity of item k and a text's shingles; 0 if it cannot reach ``least``."""
        own, weights, total = self.sets[k]
        if not len(own):
            return 0.0
        at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
        hit = own[at] == shingles
        shared = np.zeros(len(own), dtype=bool)
        shared[at[hit]] = True
        common = float(weights[shared].sum())
        if common < least * total:
            return 0.0
        return common / (total + self.rarest * len(set(shingles[~hit].tolist())))

    def window_similarities(self, shingles: np.ndarray, at: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs (place in a text, window of an item): weighted Jaccard similarity of their shingles, and whether they are equal one by one."""
        step = np.arange(self.size - SHINGLE + 1)
        mine = shingles[at[:, None] + step]
        own_at = (self.first[self.item[windows]] + self.pos[windows])[:, None] + step
        theirs, weights = self.flat[own_at], self.flat_weights[own_at]
        once = lambda x: ~np.tril(x[:, :, None] == x[:, None, :], -1).any(axis=2)  # noqa: E731 (a shingle counts once per window)
        equal = mine[:, :, None] == theirs[:, None, :]
        weights = weights * once(theirs)
        lacking = (once(mine) & ~equal.any(axis=2)).sum(axis=1)
        return (weights * equal.any(axis=1)).sum(axis=1) / (weights.sum(axis=1) + self.rarest * lacking), (mine == theirs).all(axis=1)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    h = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)])
    return h


def scan(items: Items, ids: list[int], texts: list[str], similarity: float) -> list[tuple]:
    """doc, item, window, similarity, exact, part: verified windows of a batch of texts; part: passage, or item (window: -1)."""
    if not len(items.prints):
        return []
    parts = [plain(t).encode("utf-8", "ignore") for t in texts]
    # one buffer for the batch; the separator keeps words apart, windows over a text's end are left out
    data = b"\x00".join(parts)
    hashes, start, end = word_hashes(data)
    size = items.size
    if len(hashes) < size:
        return []
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
    doc = np.searchsorted(offsets, start, "right") - 1
    prints = sized_simhashes(hashes, sorted({size, *items.whole}))
    shingles = shingle_hashes(hashes)
    out = []

    def inside(z: int) -> np.ndarray:
        n = len(hashes) - z + 1
        return np.flatnonzero(doc[:n] == doc[z - 1 :][:n]) if n > 0 else np.zeros(0, dtype=np.int64)

    within = inside(size)
    text_w, item_w = items.candidates(prints[size][within])
    for a in range(0, len(text_w), 1 << 14):
        at, windows = within[text_w[a : a + (1 << 14)]], item_w[a : a + (1 << 14)]
        sims, same = items.window_similarities(shingles, at, windows)
        good = sims >= similarity
        for w, v, sim, exact in zip(at[good].tolist(), windows[good].tolist(), sims[good].tolist(), same[good].tolist(), strict=True):
            k, p = int(items.item[v]), int(items.pos[v])
            # equal hashes are checked word by word
            exact = exact and [data[start[i] : end[i]].lower() for i in range(w, w + size)] == items.words[k][p : p + size]
            out.append((ids[doc[w]], items.ids[k], p, 1.0 if exact else sim, exact, "passage"))
    first = np.searchsorted(doc, np.arange(len(texts)), "left")
    last = np.searchsorted(doc, np.arange(len(texts)), "right")
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for z, (ends, index) in items.whole.items():
        within = inside(z)
        text_w, item_w = index.candidates(prints[z][within])
        places = set()
        for w, v in zip(within[text_w].tolist(), item_w.tolist(), strict=True):
            k, by_end = ends[v]
            n = len(items.words[k])
            places.add((k, max(int(first[doc[w]]), w + z - n) if by_end else w, w + z if by_end else min(int(last[doc[w]]), w + n)))
        for k, a, b in places:
            sim = items.similarity(k, shingles[a : b - SHINGLE + 1], similarity)
            if sim >= similarity:
                pair = (int(doc[a]), k)
                had = best.get(pair, (0.0, a, b))
                best[pair] = (max(had[0], sim), min(had[1], a), max(had[2], b))
    for (d, k), (sim, a, b) in best.items():
        exact = bool(np.isin(_runs(hashes[a:b], size), items.passage_hashes[k]).any())
        out.append((ids[d], items.ids[k], -1, sim, exact, "item"))
    return out


_INDEXED: dict[str, Items] = {}


def _indexed(name: str, shipped, words: int, radius: int) -> Items:
    """The block's index, built once per worker process."""
    if name not in _INDEXED:
        _INDEXED.clear()
        ids, texts, counts, n = shipped.value
        _INDEXED[name] = Items(ids, texts, words, radius, counts, n)
    return _INDEXED[name]


def _shingles(items: DataFrame) -> DataFrame:
    """item_id, h: the distinct shingles of every item."""

    def run(batches):
        for pdf in batches:
            each = [(i, np.unique(shingle_hashes(word_hashes(plain(t).encode("utf-8", "ignore"))[0])).view(np.int64)) for i, t in zip(pdf["item_id"], pdf["text"], strict=True)]
            yield pd.DataFrame({"item_id": np.repeat([i for i, _ in each], [len(h) for _, h in each]).astype("int64"), "h": np.concatenate([h for _, h in each] or [np.zeros(0, dtype=np.int64)])})

    return items.select("item_id", "text").mapInPandas(run, "item_id bigint, h bigint").distinct()


def leaked_windows(docs: DataFrame, items: DataFrame, words: int = WORDS, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, window, similarity, exact, part of every window of an item found in a document.

    docs: doc_id, text; items: item_id, text. Only the query set (items) visits the driver, block by
    block; documents stay where they are read. part: passage (window: its first word in the item) or item (window -1).
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, window int, similarity double, exact boolean, part string"
    if words < SHINGLE:
        raise ValueError("a passage must have at least as many words as a shingle")

    def one_pass(block: list, counts: dict[int, int] | None, n: int) -> DataFrame:
        shipped = spark.sparkContext.broadcast(([r[0] for r in block], [r[1] for r in block], counts, n))
        name = uuid.uuid4().hex

        def run(batches):
            own = _indexed(name, shipped, words, radius)
            for pdf in batches:
                ids, texts, held = [], [], 0
                found: list[tuple] = []
                for ident, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                    if not text:
                        continue
                    ids.append(ident)
                    texts.append(text)
                    held += len(text)
                    if held >= CHUNK_BYTES // 2:
                        found += scan(own, ids, texts, similarity)
                        ids, texts, held = [], [], 0
                if ids:
                    found += scan(own, ids, texts, similarity)
                if found:
                    yield pd.DataFrame(found, columns=["doc_id", "item_id", "window", "similarity", "exact", "part"])

        return docs.where("text is not null").select("doc_id", "text").mapInPandas(run, schema)

    rows = items.where("item_id is not null and length(text) > 0").select("item_id", "text").groupBy("item_id", "text").agg(F.lit(1).alias("one")).drop("one")
    n, chars = rows.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    blocks = -(-int(chars) // (6 * BLOCK_WORDS))  # a word takes about six characters
    if blocks == 1:
        return one_pass([tuple(r) for r in rows.collect()], None, n)
    # many items: a part of them at a time, with the shingle counts of all
    rows = cut(rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))))
    own = cut(_shingles(rows))
    counts = cut(own.join(own.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "h").join(rows.select("item_id", "block").distinct(), "item_id").select("block", "h", "n").distinct())
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        block = [tuple(r) for r in rows.where(F.col("block") == b).select("item_id", "text").collect()]
        if block:
            common = {int(r["h"]) % (1 << 64): r["n"] for r in counts.where(F.col("block") == b).collect()}
            out = out.unionByName(cut(one_pass(block, common, n)))
    return out


def leaks(windows: DataFrame) -> DataFrame:
    """doc_id, item_id pairs with how much of the item was found: exact and near passages, similarity of the best passage and of the whole item."""
    passage, whole = F.col("part") == "passage", F.col("part") == "item"
    return windows.groupBy("doc_id", "item_id").agg(
        F.count_distinct(F.when(F.col("exact") & passage, F.col("window"))).alias("exact_windows"), F.count_distinct(F.when(passage, F.col("window"))).alias("windows"),
        F.max(F.when(passage, F.col("similarity"))).alias("similarity"), F.max(F.when(whole, F.col("similarity"))).alias("item_similarity"),
    )
