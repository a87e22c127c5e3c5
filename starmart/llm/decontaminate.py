"""Benchmark decontamination by the q-gram lemma (operator 9).

A text holds a benchmark item if a stretch of it is within the item's edit
budget, ``EDIT_SHARE`` of its characters. Such a stretch of an item of n
characters shares at least n + 1 - Q * (k + 1) of the item's q-grams with it, and
they lie on neighbouring diagonals (place in the text less place in the item).
So shared q-grams are counted in overlapping diagonal bands of twice the budget;
bands that reach the bound are verified by a banded alignment.

Texts and items are compared in lower case with single blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.text import batches, range_hashes
from starmart.staging import Staging

Q = 10
EDIT_SHARE = 0.08
# Items of a block together have about so many characters; blocks are searched
# one after the other.
BLOCK_CHARS = 4_000_000
BATCH_CHARS = 1 << 18
# A q-gram of more items than this is left out where the lemma allows it, and
# texts with more shared q-grams, counted per item, are searched in smaller runs.
HOT_ITEMS = 32
MOST_SHARED = 4_000_000
_SIEVE_SHIFT = np.uint64(64 - 22)
HIT = "id BIGINT, item_id BIGINT, start BIGINT, stop BIGINT, edits BIGINT"


def normalized(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def budget(n: int) -> int:
    """Edits allowed for an item of n characters; small enough that the lemma
    demands a shared q-gram at least."""
    return max(0, min(int(EDIT_SHARE * n), n // Q - 1))


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, high: int):
    """(edits, start, stop) of the stretch of ``text`` that is nearest to
    ``item``, the alignment staying on diagonals low..high. Ties: the first end,
    then the last start."""
    width = high - low + 1
    big = len(item) + width + 1
    diagonals = np.arange(low, high + 1)
    # Cost * scale - start: one minimum yields the least cost, then the last start.
    scale = len(text) + len(item) + 2
    inside = (diagonals >= 0) & (diagonals <= len(text))
    row = np.where(inside, -np.clip(diagonals, 0, None), big * scale)
    step = np.arange(width) * scale
    padded = np.concatenate([text.astype(np.int64), np.full(1, -1)])
    for i in range(1, len(item) + 1):
        at = diagonals + i - 1  # the character that the diagonal step reads
        valid = (at >= 0) & (at < len(text))
        read = padded[np.where(valid, at, len(text))]
        across = row + np.where(valid, (read != item[i - 1]) * scale, big * scale)
        skip = np.concatenate([row[1:], [big * scale]]) + scale  # item character without text
        best = np.minimum(across, skip)
        # Text characters without item: a running minimum along the row.
        row = np.minimum.accumulate(best - step) + step
        ends = diagonals + i
        row = np.where((ends >= 0) & (ends <= len(text)), row, big * scale)
    place = int(np.argmin(-(-row // scale)))
    cost = int(-(-row[place] // scale))
    return cost, int(cost * scale - row[place]), int(diagonals[place]) + len(item)


class BenchmarkIndex:
    """Q-grams of a block of items; items of fewer than Q characters are looked
    up whole, equal items once.

    The lemma demands ``bounds`` shared q-grams of an item. Without some of its
    q-grams it demands that many fewer of the rest, so those that very many items
    have are left out of an item as long as it demands another one.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.ids: dict[str, list[int]] = {}
        for i, t in items:
            if t:
                self.ids.setdefault(t, []).append(i)
        self.texts = list(self.ids)
        self.items = [_codes(t) for t in self.texts]
        grams, owners, offsets, self.short = [], [], [], {}
        for place, codes in enumerate(self.items):
            if len(codes) < Q:
                h = range_hashes(codes, np.array([0]), np.array([len(codes)]))
                self.short.setdefault(len(codes), {}).setdefault(int(h[0]), []).append(place)
                continue
            at = np.arange(len(codes) - Q + 1)
            grams.append(range_hashes(codes, at, at + Q))
            owners.append(np.full(len(at), place))
            offsets.append(at)
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.lengths = np.array([len(c) for c in self.items], np.int64)
        self.budgets = np.array([budget(int(n)) for n in self.lengths], np.int64)
        bounds = self.lengths + 1 - Q * (self.budgets + 1)
        grams, owners, offsets = join(grams, np.uint64), join(owners, np.int64), join(offsets, np.int64)
        hot = self._hot(grams, owners)
        spared = bounds - np.bincount(owners[hot], minlength=len(bounds))
        out = hot & (spared[owners] >= 1)
        self.bounds = np.where(spared >= 1, spared, bounds)
        grams, owners, offsets = grams[~out], owners[~out], offsets[~out]
        order = np.argsort(grams, kind="stable")
        self.grams, self.owners, self.offsets = grams[order], owners[order], offsets[order]
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.grams >> _SIEVE_SHIFT).astype(np.int64)] = True

    @staticmethod
    def _hot(grams: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """Which entries have a q-gram of more than HOT_ITEMS items."""
        if not len(grams):
            return np.zeros(0, bool)
        order = np.lexsort((owners, grams))
        g, o = grams[order], owners[order]
        new = np.concatenate([[True], g[1:] != g[:-1]])
        first = new | np.concatenate([[True], o[1:] != o[:-1]])  # of an item, per q-gram
        group = np.cumsum(new) - 1
        out = np.empty(len(grams), bool)
        out[order] = np.bincount(group, first)[group] > HOT_ITEMS
        return out

    def hits(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """``search`` with the ids of the items."""
        for text, item, *span in self.search(texts):
            for i in self.ids[self.texts[item]]:
                yield (text, i, *span)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, start, stop, edits): the nearest stretch of
        each item that a text holds. ``texts`` are normalized."""
        joined = _codes("\x00".join(texts) + "\x00")
        ends = np.flatnonzero(joined == 0) if "\x00" not in "".join(texts) else None
        if ends is None:  # a text with the separator in it: one by one
            ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        shared = self._shared(joined)
        if len(texts) > 1 and int(shared[2].sum()) > MOST_SHARED:
            half = len(texts) // 2
            later = self.search(texts[half:])
            return self.search(texts[:half]) + [(t + half, *rest) for t, *rest in later]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}

        def keep(text: int, item: int, start: int, stop: int, edits: int) -> None:
            best = found.get((text, item))
            if best is None or (edits, start) < (best[2], best[0]):
                found[text, item] = (start, stop, edits)

        for size, known in self.short.items():
            at = np.arange(max(0, len(joined) - size + 1))
            hashes = range_hashes(joined, at, at + size)
            for p in np.flatnonzero(np.isin(hashes, np.array(list(known), np.uint64))):
                text = int(np.searchsorted(ends, p))
                for item in known[int(hashes[p])]:
                    begin = int(p - starts[text])
                    if np.array_equal(joined[p : p + size], self.items[item]):
                        if p + size <= ends[text]:
                            keep(text, item, begin, begin + size, 0)
        for text, item, low, high in self._bands(shared, len(joined), starts, ends):
            codes = joined[starts[text] : ends[text]]
            k = int(self.budgets[item])
            begin = max(0, low - k)
            end = high + int(self.lengths[item]) + k + 1
            exact = texts[text].find(self.texts[item], begin, max(begin, end))
            if exact >= 0:  # no edits: needs no alignment
                keep(text, item, exact, exact + int(self.lengths[item]), 0)
                continue
            stretch = codes[begin:end]
            edits, start, stop = banded_distance(
                self.items[item], stretch, low - k - begin, high + k - begin
            )
            if edits <= k:
                keep(text, item, begin + start, begin + stop, edits)
        return [(t, i, *span) for (t, i), span in found.items()]

    def _shared(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the texts with a q-gram of an item, where the index has it,
        and how often."""
        if not len(self.grams) or len(joined) < Q:
            return (np.zeros(0, np.int64),) * 3
        at = np.arange(len(joined) - Q + 1)
        hashes = range_hashes(joined, at, at + Q)
        at = np.flatnonzero(self.sieve[(hashes >> _SIEVE_SHIFT).astype(np.int64)])
        hashes = hashes[at]
        first = np.searchsorted(self.grams, hashes, "left")
        n = np.searchsorted(self.grams, hashes, "right") - first
        return at[n > 0], first[n > 0], n[n > 0]

    def _bands(self, shared, size: int, starts, ends) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, lowest, highest diagonal) of bands at the bound."""
        at, first, n = shared
        if not len(at):
            return
        entry = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        item, offset = self.owners[entry], self.offsets[entry]
        text = np.searchsorted(ends, at)
        # Diagonals from the start of the whole run of texts, shifted above 0.
        shift = int(self.lengths.max())
        diagonal = at - offset + shift
        stride = self.budgets[item] + 1
        lower = diagonal // stride
        bands = int((size + 2 * shift) + 2)
        key = (text * len(self.items) + item) * bands
        # A hit counts in the band that begins in its own interval and in the one before.
        keys = np.concatenate([key + lower, key + np.maximum(lower - 1, 0)])
        offsets = np.concatenate([offset, offset])
        order = np.lexsort((offsets, keys))
        keys, offsets = keys[order], offsets[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (offsets[1:] != offsets[:-1])
        held, count = np.unique(keys[new], return_counts=True)
        owner = held // bands % len(self.items)
        for k in held[count >= np.maximum(1, self.bounds[owner])]:
            pair, band = divmod(int(k), bands)
            t, i = divmod(pair, len(self.items))
            step = int(self.budgets[i]) + 1
            low = band * step - shift - int(starts[t])
            yield t, i, low, low + 2 * step - 1


def _blocked(benchmark: DataFrame, id_col: str, text_col: str, staging: Staging) -> tuple[DataFrame, int]:
    """Items with the number of their block, and how many blocks there are."""
    rows = benchmark.select(
        F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")
    ).where("text IS NOT NULL")
    chars = rows.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return staging.save(rows.withColumn("block", block), "items"), blocks


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    staging: Staging | None = None,
) -> DataFrame:
    """(id, item_id, start, stop, edits): the nearest stretch, in the normalized
    text, of every item that a text holds. Null and blank texts and items give
    none. Repeated rows of either table, and rows with null ids, count like any
    other, so a repeated row repeats its hits.

    Every block of items is matched against all texts, which are neither cut nor
    shuffled. A block's hits are written before the next one is read, so the driver
    and the executors hold one block at a time, however many there are."""
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    items, blocks = _blocked(benchmark, item_id_col, item_text_col, staging)
    found = None
    for number in range(blocks):
        block = items.where(F.col("block") == number).select("item_id", "text").collect()
        shared = spark.sparkContext.broadcast([(i, normalized(t)) for i, t in block])

        def search(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = BenchmarkIndex(shared.value)
            for part in parts:
                ids = part["id"].tolist()
                texts = [normalized(t) for t in part["text"]]
                hits = []
                for run in batches([len(t) for t in texts], BATCH_CHARS):
                    for t, i, *span in index.hits(texts[run]):
                        hits.append((ids[run.start + t], i, *span))
                out = pd.DataFrame(hits, columns=["id", "item_id", "start", "stop", "edits"])
                yield out.astype({"id": "Int64", "item_id": "Int64"})

        hits = staging.save(rows.mapInPandas(search, HIT), "hits")
        shared.destroy()
        found = hits if found is None else found.unionAll(hits)
    return found
