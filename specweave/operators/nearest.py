"""Comparisons of the entities of a document without moving pairs: each one's nearest other, and likely duplicates.

A document's entities are cut into blocks, and each two blocks meet in a task; small documents come together in buckets.
Within a task no pair is left out: all features but the likeness of names are counted exactly from inverted lists (or, in
small documents, pair by pair), the likeness gets an upper bound, and names are compared in the order of the bounds until no
bound is above the best pair found.  So the result is that of all pairs, and what is moved grows with the entities.

Defined results: entities without document and entities alone in their document have no row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specweave.operators import duplicates
from specweave.sources.lexicons import Lexicon

#: Entities of a block; documents up to SMALL entities are compared pair by pair; entities of small documents per bucket.
BLOCK, SMALL, BUCKET = 8192, 48, 4096
#: Pairs of small documents and different names that are compared at once.
PAIRS, NAMES = 50_000, 256


@dataclass
class Sets:
    """A set of codes for each row: ``codes[starts[i]:starts[i + 1]]``, sorted; ``width``: number of different codes."""

    starts: np.ndarray
    codes: np.ndarray
    width: int

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def of(self, row: int) -> np.ndarray:
        return self.codes[self.starts[row] : self.starts[row + 1]]


def _sets(rows: np.ndarray, codes: np.ndarray, n: int, width: int) -> Sets:
    keys = np.unique(rows.astype(np.int64) * max(width, 1) + codes)
    return Sets(np.searchsorted(keys, np.arange(n + 1, dtype=np.int64) * max(width, 1)), keys % max(width, 1), width)


def _sets_of(lists: pd.Series) -> Sets:
    """Sets of texts; null counts as a text of its own, a null list is empty."""
    lists = [x if x is not None else () for x in lists]
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    codes, seen = pd.factorize(np.array([t for x in lists for t in x], dtype=object), use_na_sentinel=False)
    return _sets(rows, codes, len(lists), len(seen))


def _trigrams(lists: pd.Series) -> Sets:
    """Sets of character trigrams, as ``duplicates.shingles`` makes them; a character takes 21 bits."""
    lists = [x if x is not None else () for x in lists]
    texts = [t for x in lists for t in x]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64) + 1
    padded = np.concatenate([chars, np.zeros(2, dtype=np.int64)])
    at = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - at
    second, third = np.where(left > 1, padded[1 : len(chars) + 1], 0), np.where(left > 2, padded[2 : len(chars) + 2], 0)
    kept = (left >= 3) | (at == 0)
    codes, seen = pd.factorize((chars | second << 21 | third << 42)[kept])
    return _sets(np.repeat(owner, sizes)[kept], codes, len(lists), len(seen))


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[k], ..., starts[k] + sizes[k] - 1 of every k."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _overlaps(sets: Sets, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared part of the sets of rows a and b, pair by pair."""
    n = sets.sizes
    width = max(sets.width, 1)
    keys = np.repeat(np.arange(len(n), dtype=np.int64), n) * width + sets.codes
    asked = np.repeat(b.astype(np.int64), n[a]) * width + sets.codes[_expanded(sets.starts[a], n[a])]
    place = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
    shared = np.bincount(np.repeat(np.arange(len(a)), n[a]), weights=keys[place] == asked if len(keys) else None, minlength=len(a))
    return shared / np.maximum(n[a] + n[b] - shared, 1)


class Postings:
    """For each code the columns that have it."""

    def __init__(self, sets: Sets, columns: np.ndarray) -> None:
        sizes = sets.sizes[columns]
        codes = sets.codes[_expanded(sets.starts[columns], sizes)]
        order = np.argsort(codes, kind="stable")
        self.columns = np.repeat(np.arange(len(columns)), sizes)[order]
        self.starts = np.searchsorted(codes[order], np.arange(sets.width + 1))
        self.sizes = sizes

    def hits(self, codes: np.ndarray) -> np.ndarray:
        """The columns of all the codes, one after the other."""
        return np.concatenate([self.columns[self.starts[c] : self.starts[c + 1]] for c in codes]) if len(codes) else self.columns[:0]


class Frame:
    """Entities with everything that they are compared by, as codes."""

    def __init__(self, rows: pd.DataFrame, links: dict[str, set[str]]) -> None:
        self.n = len(rows)
        code = lambda c: pd.factorize(rows[c])[0]
        self.document, self.entity, self.type, self.normal = code("document_id"), code("entity_id"), code("entity_type"), code("normalized_entity_name")
        self.chunks, self.attributes, self.grams = _sets_of(rows["source_chunks"]), _sets_of(rows["source_attributes"]), _trigrams(rows["texts"])
        self.name, names = pd.factorize(rows["entity_name"].fillna(""))
        self.names = [str(x) for x in names]
        known: dict[str, int] = {k: i for i, k in enumerate(links)}
        own = [{k for k in keys if k in known} for keys in rows["keys"]]
        heard = [set().union(*(links[k] for k in keys)) if keys else () for keys in own]
        flat = lambda sets: _sets(np.repeat(np.arange(self.n), [len(x) for x in sets]), np.array([known[k] for x in sets for k in x], dtype=np.int64), self.n, len(known))
        self.keys, self.heard = flat(own), flat(heard)

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=bool)
        for k in np.flatnonzero((self.heard.sizes[a] > 0) & (self.keys.sizes[b] > 0)):
            out[k] = len(np.intersect1d(self.heard.of(a[k]), self.keys.of(b[k]))) > 0
        return out


def _total(name: float, exact: float, kind: float, chunks: float, attributes: float, evidence: float, link: float) -> float:
    return math.fsum(w * f for w, f in zip(duplicates.WEIGHTS.values(), (name, exact, kind, chunks, attributes, evidence, link)))


def _pairwise(f: Frame, a: np.ndarray, b: np.ndarray, best: np.ndarray) -> None:
    """Raises ``best`` to the composites of the pairs."""
    same = lambda x: ((x[a] == x[b]) & (x[a] >= 0)).astype(float)
    names = np.fromiter((duplicates.token_set_ratio(f.names[x], f.names[y]) / 100.0 for x, y in zip(f.name[a], f.name[b])), dtype=float, count=len(a))
    parts = np.stack([names, same(f.normal), same(f.type), _overlaps(f.chunks, a, b), _overlaps(f.attributes, a, b), np.zeros(len(a)), f.linked(a, b).astype(float)])
    weights = np.array(list(duplicates.WEIGHTS.values()))
    low = weights @ parts
    floor = np.full(f.n, -1.0)
    np.maximum.at(floor, a, low)
    np.maximum.at(floor, b, low)
    n, m = f.grams.sizes[a], f.grams.sizes[b]
    most = low + duplicates.WEIGHTS["evidence_overlap"] * np.minimum(n, m) / np.maximum(np.maximum(n, m), 1) + 1e-9
    kept = np.flatnonzero(most >= np.minimum(floor[a], floor[b]))
    parts = parts[:, kept]
    parts[5] = _overlaps(f.grams, a[kept], b[kept])
    full = np.fromiter((_total(*p) for p in parts.T.tolist()), dtype=float, count=len(kept))
    np.maximum.at(best, a[kept], full)
    np.maximum.at(best, b[kept], full)


class _Names:
    """Bounds of the likeness of names: of their words the characters in common, and the length of the words in common."""

    def __init__(self, names: list[str]) -> None:
        words = [sorted(set(x.split())) for x in names]
        self.sizes = np.array([len(" ".join(w)) for w in words], dtype=np.float32)
        spots: dict[tuple[str, int], int] = {}
        rows, columns = [], []
        for i, w in enumerate(words):
            seen: dict[str, int] = {}
            for x in " ".join(w):
                seen[x] = seen.get(x, 0) + 1
                rows.append(i)
                columns.append(spots.setdefault((x, seen[x]), len(spots)))
        self.bags = np.zeros((len(names), max(len(spots), 1)), dtype=np.float32)
        self.bags[rows, columns] = 1
        codes, seen_words = pd.factorize(np.array([x for w in words for x in w], dtype=object))
        self.words = _sets(np.repeat(np.arange(len(names)), [len(w) for w in words]), codes, len(names), len(seen_words))
        self.lengths = np.array([len(x) + 1 for x in seen_words], dtype=np.float32)

    def bounds(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """No less than the likeness of each of the names ``rows`` with each of ``columns``."""
        sizes = self.sizes[columns]
        out = 2 * (self.bags[rows] @ self.bags[columns].T) / np.maximum(self.sizes[rows][:, None] + sizes, 1)
        met = Postings(self.words, columns)
        for k, row in enumerate(rows):
            codes = self.words.of(row)
            hits = met.hits(codes)
            shared = np.bincount(hits, weights=np.repeat(self.lengths[codes], met.starts[codes + 1] - met.starts[codes]), minlength=len(columns))
            at = np.flatnonzero(shared)
            length = shared[at] - 1
            out[k, at] = np.maximum(out[k, at], 2 * length / (length + np.minimum(self.sizes[row], sizes[at])))
        return out


def _searched(f: Frame, names: _Names, rows: np.ndarray, columns: np.ndarray, best: np.ndarray) -> None:
    """Raises ``best`` of the rows to their highest composite with any of the columns."""
    w = duplicates.WEIGHTS
    met = [(Postings(s, columns), s, weight) for s, weight in ((f.chunks, w["chunk_overlap"]), (f.attributes, w["attribute_overlap"]), (f.grams, w["evidence_overlap"]))]
    keys = Postings(f.keys, columns)
    theirs, place = np.unique(f.name[columns], return_inverse=True)
    order = rows[np.argsort(f.name[rows], kind="stable")]
    mine, begin = np.unique(f.name[order], return_index=True)
    ends = np.append(begin[1:], len(order))
    kinds, normals, entities = f.type[columns], f.normal[columns], f.entity[columns]
    for k in range(0, len(mine), NAMES):
        bounds = names.bounds(mine[k : k + NAMES], theirs) * np.float32(w["name_sim"] * (1 + 1e-5)) + np.float32(1e-6)
        for bound, x, lo, hi in zip(bounds, mine[k : k + NAMES], begin[k : k + NAMES], ends[k : k + NAMES]):
            spread = bound[place].astype(float)
            for i in order[lo:hi]:
                most = spread + w["type_match"] * (kinds == f.type[i]) if f.type[i] >= 0 else spread.copy()
                if f.normal[i] >= 0:
                    most += w["normalized_exact"] * (normals == f.normal[i])
                for posted, sets, weight in met:
                    codes = sets.of(i)
                    hits = posted.hits(codes)
                    if not len(hits):
                        continue
                    if 8 * len(hits) < len(columns):
                        at, shared = np.unique(hits, return_counts=True)
                        most[at] += weight * shared / (len(codes) + posted.sizes[at] - shared)
                    else:
                        shared = np.bincount(hits, minlength=len(columns))
                        most += weight * shared / (len(codes) + posted.sizes - shared)
                linked = np.unique(keys.hits(f.heard.of(i)))
                most[linked] += w["alias_link"]
                most[entities == f.entity[i]] = -1.0
                _settle(f, i, columns, most, spread, linked, best)


def _settle(f: Frame, i: int, columns: np.ndarray, most: np.ndarray, spread: np.ndarray, linked: np.ndarray, best: np.ndarray) -> None:
    """Compares row ``i`` with the columns in the order of their bounds ``most`` until no bound is above the best pair."""
    weight, name = duplicates.WEIGHTS["name_sim"], f.names[f.name[i]]
    value = lambda j: most[j] - spread[j] + weight * duplicates.token_set_ratio(name, f.names[f.name[columns[j]]]) / 100.0
    at = int(most.argmax())
    if most[at] <= max(best[i] - 1e-9, -0.5):
        return
    top = value(at)
    left = np.flatnonzero(most > max(top, best[i]) - 1e-9)
    for j in left[np.argsort(-most[left], kind="stable")].tolist():
        if most[j] <= max(top, best[i]) - 1e-9:
            break
        if (now := value(j)) > top:
            top, at = now, j
    a, b = np.array([i]), columns[at : at + 1]
    same = lambda x: float(x[i] == x[b[0]] and x[i] >= 0)
    likeness = duplicates.token_set_ratio(name, f.names[f.name[b[0]]]) / 100.0
    best[i] = max(best[i], _total(likeness, same(f.normal), same(f.type), *(_overlap(s, i, b[0]) for s in (f.chunks, f.attributes, f.grams)), float(at in linked)))


def _overlap(sets: Sets, i: int, j: int) -> float:
    a, b = sets.of(i), sets.of(j)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(len(a) + len(b) - shared, 1)


def _nearest(rows: pd.DataFrame, links: dict[str, set[str]]) -> pd.DataFrame:
    """Compares the entities of one bucket of documents or of two blocks (``side`` 0 and 1) of a document."""
    rows = rows.sort_values("document_id", kind="stable", ignore_index=True)
    f = Frame(rows, links)
    best = np.full(f.n, -1.0)
    names, side = _Names(f.names), rows["side"].to_numpy()
    if side.any():
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        _searched(f, names, a, b, best)
        _searched(f, names, b, a, best)
    else:
        first, n = np.unique(f.document, return_index=True)[1], np.bincount(f.document)
        for k in np.flatnonzero(n > SMALL):
            one = np.arange(first[k], first[k] + n[k])
            _searched(f, names, one, one, best)
        after = np.where(n > SMALL, 0, first + n)[f.document] - np.arange(f.n) - 1
        after = np.maximum(after, 0)
        sums, lo = np.cumsum(after), 0
        while lo < f.n:
            hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + PAIRS, side="right")))
            here = np.arange(lo, hi)
            a, b = np.repeat(here, after[here]), _expanded(here + 1, after[here])
            differ = f.entity[a] != f.entity[b]
            if differ.any():
                _pairwise(f, a[differ], b[differ], best)
            lo = hi
    found = best >= 0
    return pd.DataFrame({"document_id": rows["document_id"][found], "entity_id": rows["entity_id"][found], "nearest": best[found]})


def _met(f: Frame, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a document that have one normal name and a chunk or attribute in common, or an alias link; of two blocks
    only pairs across."""
    a, b = [], []
    for sets in (f.chunks, f.attributes):
        row = np.repeat(np.arange(f.n), sets.sizes)
        kept = f.normal[row] >= 0
        row = row[kept]
        key = (f.document[row] * np.int64(f.n) + f.normal[row]) * max(sets.width, 1) + sets.codes[kept]
        order = np.argsort(key, kind="stable")
        row, key = row[order], key[order]
        after = np.searchsorted(key, key, side="right") - np.arange(len(key)) - 1
        a.append(np.repeat(row, after))
        b.append(row[_expanded(np.arange(len(key)) + 1, after)])
    own, heard = (np.repeat(np.arange(f.n), x.sizes) for x in (f.keys, f.heard))
    key = f.document[own] * np.int64(max(f.keys.width, 1)) + f.keys.codes
    own = own[np.argsort(key, kind="stable")]
    key = np.sort(key)
    asked = f.document[heard] * np.int64(max(f.keys.width, 1)) + f.heard.codes
    lo = np.searchsorted(key, asked)
    n = np.searchsorted(key, asked, side="right") - lo
    x, y = np.repeat(heard, n), own[_expanded(lo, n)]
    one, two = np.concatenate([*a, np.minimum(x, y)]), np.concatenate([*b, np.maximum(x, y)])
    one, two = np.minimum(one, two), np.maximum(one, two)
    pairs = np.unique(one * np.int64(f.n) + two)
    one, two = pairs // f.n, pairs % f.n
    apart = (f.entity[one] != f.entity[two]) & ((side[one] != side[two]) | (not side.any()))
    return one[apart], two[apart]


def _features(rows: pd.DataFrame, links: dict[str, set[str]]) -> pd.DataFrame:
    """The pairs of a task that can be duplicates, with their features."""
    f = Frame(rows, links)
    a, b = _met(f, rows["side"].to_numpy())
    letter = pd.factorize(rows["letter"])[0]
    kind, exact = (f.type[a] == f.type[b]) & (f.type[a] >= 0), (f.normal[a] == f.normal[b]) & (f.normal[a] >= 0)
    blocked = kind | (letter[a] == letter[b])
    a, b, kind, exact = a[blocked], b[blocked], kind[blocked], exact[blocked]
    ids = rows["entity_id"].to_numpy()
    names = [duplicates.token_set_ratio(f.names[x], f.names[y]) / 100.0 for x, y in zip(f.name[a], f.name[b])]
    values = (np.array(names, dtype=float), exact.astype(float), kind.astype(float), *(_overlaps(s, a, b) for s in (f.chunks, f.attributes, f.grams)), f.linked(a, b).astype(float))
    first = [x < y for x, y in zip(ids[a], ids[b])]
    return pd.DataFrame({"document_id": rows["document_id"].to_numpy()[a], "a": np.where(first, ids[a], ids[b]), "b": np.where(first, ids[b], ids[a]), **dict(zip(duplicates.WEIGHTS, values))})


def _tasks(entities: DataFrame, lexicon: Lexicon, block: int, work, schema: str) -> DataFrame:
    """``work`` over all buckets and pairs of blocks."""
    links: dict[str, set[str]] = {}
    for x, y in duplicates.alias_pairs(lexicon):
        links.setdefault(x, set()).add(y)
        links.setdefault(y, set()).add(x)
    texts = F.transform("supporting_evidence", lambda e: F.lower(F.coalesce(e["text"], F.lit(""))))
    letter = F.lower(F.substring(F.coalesce("normalized_entity_name", F.lit("")), 1, 1))
    rows = entities.filter("document_id is not null and entity_id is not null").select(
        "document_id", "entity_id", "entity_name", "normalized_entity_name", "entity_type", "source_chunks", "source_attributes", texts.alias("texts"), duplicates.name_keys().alias("keys"), letter.alias("letter")
    )
    buckets = max(1, entities.count() // BUCKET)
    big = entities.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    sized = rows.join(F.broadcast(big), "document_id", "left")  # one row for every ``block`` entities at most
    few = sized.filter("n is null").withColumns({"key": F.concat(F.lit("bucket "), F.pmod(F.xxhash64("document_id"), F.lit(buckets)).cast("string")), "side": F.lit(0)})
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("entity_name", "entity_id")) - 1
    many = sized.filter("n is not null").withColumn("own", F.floor(place / block)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / block))))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    many = many.withColumns({"key": F.concat_ws(" ", F.lit("blocks"), low, high, "document_id"), "side": F.when(F.col("own") > F.col("other"), 1).otherwise(0)}).drop("own", "other")
    return few.unionByName(many).drop("n").groupBy("key").applyInPandas(lambda x: work(x, links), schema)


def nearest(entities: DataFrame, lexicon: Lexicon = Lexicon(), block: int = BLOCK) -> DataFrame:
    """document_id, entity_id, nearest: the highest composite of each entity with any other of its document."""
    found = _tasks(entities, lexicon, block, _nearest, "document_id string, entity_id string, nearest double")
    return found.groupBy("document_id", "entity_id").agg(F.max("nearest").alias("nearest"))


def likely_pairs(entities: DataFrame, lexicon: Lexicon = Lexicon(), block: int = BLOCK) -> DataFrame:
    """document_id, a, b and the seven features of all pairs that have one normal name and a chunk or attribute in common, or
    an alias link (and are blocked together)."""
    features = ", ".join(f"{x} double" for x in duplicates.WEIGHTS)
    return _tasks(entities, lexicon, block, _features, f"document_id string, a string, b string, {features}")
