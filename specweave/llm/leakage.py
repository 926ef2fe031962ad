"""Evaluation texts leaking into training text: spaced-seed hashing.

A text is a row of words (runs of letters and digits of the ``latin_form``, case aside).  Fixed masks choose some of the
positions of every window; the hashes of the chosen words join corpus and evaluation windows.  Around every hit the two
texts are laid over each other and compared word by word.

Equal runs of 12 words hold a window of every mask of up to that length, so one mask finds them all.  Tolerant overlaps need
the two masks below: whichever words are replaced, one of the masks falls on equal words (a test goes through all choices in
overlaps of 12 to 19 words and in windows of 20; longer overlaps hold such a window, or ten equal words in a row).

The evaluation items are the stated query set: they are indexed in blocks of at most ``BLOCK_WORDS`` words, one block at a
time, and its index is broadcast to one pass over the corpus, so what the driver and the broadcast hold has a fixed bound
however many items come.

Defined results
    * null and empty texts, and items of fewer words than the threshold, are in no row;
    * ``p9_found``: a run of at least 12 equal words; ``p9_tolerant``: an overlap of at least 12 words of which at most one
      in ten is replaced, with its length and the number of replaced words (the longest overlap of the pair);
    * repeated items and documents each have rows of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.llm.visual import latin_form
from specweave.session import Shelf, table

#: Equal words in a row that make a leak, and the share of replaced words that a tolerant overlap may have.
MIN_RUN = 12
MAX_REPLACED = 0.1
#: Words of evaluation items in one broadcast index (about 40 bytes each).
BLOCK_WORDS = 500_000
#: Fixed masks over the positions of a window (1: the word counts): of equal runs, and of tolerant overlaps.
MASKS = ("111010110111",)
TOLERANT_MASKS = ("11110111", "11101111")

_WORD = re.compile(r"[^\W_]+")
#: ASCII bytes: letters in lower case, digits as they are, everything else a blank.
_PLAIN = bytes(ord(chr(i).lower()) if chr(i).isalnum() and i < 128 else 32 for i in range(256))


def words(text: str) -> list[bytes]:
    if text.isascii():
        return text.encode().translate(_PLAIN).split()
    return [w.encode("utf-8", "surrogatepass") for w in _WORD.findall(latin_form(text).casefold())]


class _Hashes(dict):
    """Word -> 64-bit hash; forgets everything when it has grown to its bound."""

    bound = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hashed(text: str | None, cache: _Hashes) -> np.ndarray:
    if not text:
        return np.empty(0, dtype=np.uint64)
    own = words(text)
    return np.fromiter(map(cache.__getitem__, own), dtype=np.uint64, count=len(own))


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """One hash per window of the mask's length."""
    n = len(h) - len(mask) + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        for i, bit in enumerate(mask):
            if bit == "1":
                out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n] + np.uint64(i)
                out ^= out >> np.uint64(29)
    return out


class SeedIndex:
    """The windows of a bounded block of evaluation items, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str | None], masks: tuple[str, ...] = MASKS) -> None:
        cache = _Hashes()
        self.masks = masks
        self.ids, self.items = ids, [hashed(t, cache) for t in texts]
        self.tables = []
        for mask in masks:
            parts = [seeds(h, mask) for h in self.items]
            value = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
            item = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            at = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.empty(0, dtype=np.int64)
            order = np.argsort(value, kind="stable")
            self.tables.append((value[order], item[order], at[order]))

    def hits(self, texts: list[np.ndarray]) -> dict[int, set[tuple[int, int]]]:
        """Per text with hits: (item, shift); ``shift`` is the text's position minus the item's.

        All texts are gone through in one array; windows across two texts are left out.
        """
        found: dict[int, set[tuple[int, int]]] = {}
        ends = np.cumsum([len(h) for h in texts]) if texts else np.empty(0, dtype=np.int64)
        whole = np.concatenate(texts) if texts else np.empty(0, dtype=np.uint64)
        for mask, (value, item, at) in zip(self.masks, self.tables):
            own = seeds(whole, mask)
            if not len(own) or not len(value):
                continue
            left = np.searchsorted(value, own, "left")
            pos = np.flatnonzero(value[np.minimum(left, len(value) - 1)] == own)
            text = np.searchsorted(ends, pos, "right")
            inside = pos + len(mask) <= ends[text]
            pos, text = pos[inside], text[inside]
            if not len(pos):
                continue
            first = left[pos]
            times = np.searchsorted(value, own[pos], "right") - first
            which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
            start = ends[text] - np.array([len(texts[t]) for t in text])
            shift = np.repeat(pos - start, times) - at[which]
            for t, i, s in zip(np.repeat(text, times).tolist(), item[which].tolist(), shift.tolist()):
                found.setdefault(t, set()).add((i, s))
        return found

    def overlaps(self, h: np.ndarray) -> set[tuple[int, int]]:
        return self.hits([h]).get(0, set())

    def compared(self, h: np.ndarray, item: int, shift: int) -> np.ndarray:
        """Word by word: whether text and item agree where they lie over each other."""
        own = self.items[item]
        start, end = max(0, shift), min(len(h), shift + len(own))
        return h[start:end] == own[start - shift : end - shift]


def longest_run(same: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    return int((edges[1::2] - edges[::2]).max()) if len(edges) else 0


def longest_tolerant(same: np.ndarray, share: float) -> tuple[int, int]:
    """Length and replaced words of the longest stretch that begins and ends with equal words and in which at most
    ``share`` of the words are replaced."""
    ok = np.flatnonzero(same)
    best = (0, 0)
    bad = np.concatenate(([0], np.cumsum(~same)))
    # stretch i..j is allowed iff bad(j+1) - bad(i) <= share * (j + 1 - i): for each i the last j under a monotone level
    level = bad - share * np.arange(len(bad))
    suffix_low = np.minimum.accumulate(level[::-1])[::-1]
    for i in ok:
        last = _last_at_most(level, i + 1, suffix_low, level[i] + 1e-9)
        if last is None:
            continue
        j = last - 1
        while j > i and not same[j]:
            j -= 1
        length = int(j - i + 1)
        if length > best[0]:
            best = (length, int(bad[j + 1] - bad[i]))
    return best


def _last_at_most(level: np.ndarray, start: int, suffix_low: np.ndarray, bound: float) -> int | None:
    """The last index >= start at which ``level`` is at most ``bound``."""
    lo, hi = start, len(level) - 1
    if lo > hi or suffix_low[lo] > bound:
        return None
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if suffix_low[mid] <= bound:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _blocks(items: DataFrame, block_words: int, masks: tuple[str, ...]) -> Iterator[tuple[SeedIndex, bool]]:
    """Indexes over the evaluation items, each of at most ``block_words`` words (or a single longer item), one at a time;
    and whether it is the only one."""
    plain = items.select("item_id", "text").filter("text is not null")
    total = plain.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-int(total) * 2 // block_words))
    for k in range(n):
        rows = plain.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()  # bounded by block_words
        yield SeedIndex([r.item_id for r in rows], [r.text for r in rows], masks), n == 1


def leaks(documents: DataFrame, items: DataFrame, tolerant: bool = False, min_run: int = MIN_RUN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id of the documents that hold a passage of an item; with ``tolerant`` also ``overlap`` and ``replaced``."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text").filter("text is not null")

    def scan(shared) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index, cache = shared.value, _Hashes()
            for pdf in batches:
                rows = []
                texts = [hashed(t, cache) for t in pdf["text"]]
                for k, pairs in index.hits(texts).items():
                    best: dict[int, tuple[int, int]] = {}
                    for item, shift in pairs:
                        same = index.compared(texts[k], item, shift)
                        got = longest_tolerant(same, MAX_REPLACED) if tolerant else (longest_run(same), 0)
                        if got[0] >= min_run and got > best.get(item, (0, 0)):
                            best[item] = got
                    rows += [(pdf["doc_id"].iloc[k], index.ids[item], *got) for item, got in best.items()]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "overlap", "replaced"])

        return texts.mapInPandas(run, "doc_id bigint, item_id int, overlap int, replaced int")

    shelf, found = Shelf(spark), []
    for index, alone in _blocks(items, block_words, TOLERANT_MASKS if tolerant else MASKS):
        shared = spark.sparkContext.broadcast(index)
        if alone:
            found.append(scan(shared))
        else:  # written before the next index is made
            found.append(shelf.keep(scan(shared)))
            shared.destroy()
    pairs = reduce(DataFrame.unionByName, found)
    return pairs if tolerant else pairs.select("doc_id", "item_id")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return leaks(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p9_tolerant(spark: SparkSession, root: str) -> DataFrame:
    return leaks(table(spark, root, "documents"), table(spark, root, "eval_items"), tolerant=True)
