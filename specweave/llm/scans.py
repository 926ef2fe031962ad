"""Noise in text from scanned pages: a hidden Markov model labels the lines, paragraphs are reassembled accordingly.

Every line (and every part of a line behind a wide gap) is labelled ``header``, ``number``, ``body`` or ``break`` (heading,
table row, label) by the most probable path of a hidden Markov model.  Its emissions are layout features (place in block
and page, shape, recurrence on other pages of the document) and the line's words.  The model is trained here on lines
that label themselves: lines that recur at page edges are headers, wrapped lines inside blocks are body, and so on.

Word counts of the whole corpus tell cut words from compounds, and misread words from real ones: a word is misread if a
known confusion of characters turns it into a word that is far more frequent.

Defined results
    * null, empty and blank texts have no defects and give no paragraph;
    * a block without page or without document is its page's only block as far as edges are concerned (it is an edge);
    * repeated rows have defects of their own (each has its own record_id);
    * only characters within words and numbers count as misread; cells of tables are compared without their first and
      last word, which may be cut off.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.session import Shelf, table

#: Blocks that the model is trained on: the ones with the smallest hash of their record_id.
TRAIN_BLOCKS = 6_000
#: A word is known if it occurs so often, whatever the size of the corpus.
KNOWN = 5
#: Known words in the broadcast counts: if there are more, the most frequent ones.
KNOWN_WORDS = 500_000
#: A misread word is at least this much rarer than the word it stands for.
RARER = 20
#: A block at a page's edge of fewer characters is an edge as a whole, a longer one by its first and last line.
SHORT_BLOCK = 160
#: Distinct words that one task holds before it passes its counts on.
FLUSH_WORDS = 200_000

STATES = ("header", "number", "body", "break")
#: Where a line recurs on other pages of its document: nowhere, inside of blocks only, at page edges.
RECURS = ("", "inner", "edge")

#: What scanning makes of characters (read -> meant); single characters and pairs.
MISREAD_SYMBOLS = {"†": "t", "@": "a", "!": "i", "£": "f", "5": "sS", "0": "oO", "1": "lIi", "9": "gq", "8": "B", "6": "bG", "ü": ("ti",), "|": "lI", "$": "sS", "3": "E", "2": "Z"}
MISREAD_LETTERS = {"c": ("e",), "rn": ("m",), "ri": ("n",), "ii": ("u",), "li": ("h",), "cl": ("d",), "vv": ("w",), "l": ("i", "I", "t"), "I": ("l", "i"), "m": ("rn",), "e": ("c",), "h": ("b", "li"), "d": ("cl",), "u": ("ii",), "n": ("ri",), "tl": ("d",), "lc": ("k",), "iii": ("m",), "w": ("vv",), "o": ("c",)}
#: Letters that are read for digits.
DIGIT_LETTERS = {"l": "1", "I": "1", "|": "1", "!": "1", "O": "0", "o": "0", "S": "5", "B": "8", "b": "6", "Z": "2"}

#: Classes of characters that are read for each other, and of pairs that are read for one letter.
_ONE = str.maketrans({"†": "t", "@": "a", "!": "i", "l": "i", "I": "i", "1": "i", "|": "i", "5": "s", "S": "s", "$": "s", "0": "o", "O": "o", "9": "g", "8": "b", "B": "b", "6": "b", "£": "f", "c": "e", "ü": "ti"})
_DRAWN_AS = {"rn": "m", "ii": "u", "h": "u", "ei": "d", "vv": "w"}
_DRAWN = re.compile("|".join(_DRAWN_AS))

_WORD = re.compile(r"[^\s|()\[\]{}<>\"“”„;:,.?–—=*/+]+(?:-[^\s|()\[\]{}<>\"“”„;:,.?–—=*/+]+)*")
_GAP = re.compile(r"[ \t]{3,}")
_ROMAN = r"(?=[ivxlcdm])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
_NUMBER = re.compile(rf"^(?:(?:page|pages|p|pg|sheet|seite|folio|pag)\b\.?)?\s*[-–—\[(|~*]*\s*(?:\d{{1,6}}|{_ROMAN})\s*[-–—\])|~*]*\s*(?:(?:of|/|von|de)\s*\d{{1,6}})?\s*[-–—\])]*$", re.I)
_PART_NUMBER = re.compile(rf"(?<![^\W_])(?:\d{{1,6}}|{_ROMAN})(?![^\W_])", re.I)
_CUT = re.compile(r"(\S*[^\W\d_])[-‐‑¬­]")
_HEAD = re.compile(r"^([^\W\d_]\S*)")
_DIGITS = re.compile(r"^[0-9lIOoSBbZ!|]+$")
_EDGE_PUNCT = ".,;:!?)(]["


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def _strip(word: str) -> str:
    return word.strip("'’`-‐‑¬­")


def whole_words(text: str) -> Iterator[str]:
    """The words of a text; of a table's cells those between the first and the last, which may be cut off."""
    if "|" not in text:
        yield from words_of(text)
        return
    for line in text.split("\n"):
        if line.lstrip().startswith("|"):
            for cell in line.split("|"):
                yield from words_of(" ".join(cell.split()[1:-1]))
        else:
            yield from words_of(line)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter[str] = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            held.update(map(_strip, whole_words(text)))
            if len(held) >= FLUSH_WORDS:
                yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                held = Counter()
    yield pd.DataFrame({"word": pd.Series(list(held), dtype="object"), "n": pd.Series(list(held.values()), dtype="int64")})


def word_counts(blocks: DataFrame, shelf: Shelf) -> dict[str, int]:
    """Counts of the known words, over all blocks; of the ``KNOWN_WORDS`` most frequent ones if there are more."""
    counted = blocks.select("text").filter("text is not null").mapInPandas(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(f"word <> '' and n >= {KNOWN}")
    return {r.word: r.n for r in shelf.keep(counted).orderBy(F.desc("n"), "word").limit(KNOWN_WORDS).collect()}  # bounded


def drawn(word: str) -> str:
    """A form in which a word and its misreadings fall together, also where several characters were misread."""
    return _DRAWN.sub(lambda m: _DRAWN_AS[m.group()], word.translate(_ONE).replace("ri", "n")).lower()


class _Kept(dict):
    """Results of a function by word; forgets everything when it has grown to its bound."""

    bound = 300_000

    def __init__(self, work) -> None:
        super().__init__()
        self.work = work

    def __missing__(self, word: str):
        if len(self) >= self.bound:
            self.clear()
        out = self[word] = self.work(word)
        return out


class Reader:
    """Tells misread words from real ones by corpus counts."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        self.compounds = {w.lower() for w in counts if "-" in w}
        self.tails = {w.split("-", 1)[1] for w in self.compounds} | {w.rsplit("-", 1)[1] for w in self.compounds}
        self.known = {w.lower() for w in counts if "-" not in w}
        self.alike: dict[str, list[str]] = {}
        for w in counts:
            if len(w) >= 4 and "-" not in w:
                self.alike.setdefault(drawn(w), []).append(w)
        self._meant: dict[str, str | None] = {}
        self._corrected = _Kept(self._correct)
        self._misread = _Kept(self._is_misread)
        self.numeric = _Kept(lambda word: bool(_PART_NUMBER.search(self.corrected(word))))
        self.folded = _Kept(lambda word: self.corrected(word).lower())

    def count(self, word: str) -> int:
        n = self.counts.get(word, 0)
        if not n and word[:1].isupper():
            n = self.counts.get(word.lower(), 0) // 2  # a sentence may begin with any word
        elif not n and word[:1].islower():
            n = self.counts.get(word[:1].upper() + word[1:], 0) // 2
        return n

    def _candidates(self, word: str, rules: dict) -> Iterator[str]:
        """Words that differ by one reading, and by the same reading at every place it occurs."""
        for read, meant in rules.items():
            if read not in word:
                continue
            for other in meant:
                at = word.find(read)
                while at >= 0:
                    yield word[:at] + other + word[at + len(read) :]
                    at = word.find(read, at + 1)
                if word.count(read) > 1:
                    yield word.replace(read, other)

    def meant(self, word: str) -> str | None:
        """The word that a misread one stands for; None if it stands for itself."""
        if word in self._meant:
            return self._meant[word]
        if len(self._meant) > 300_000:
            self._meant.clear()
        out = self._search(word)
        self._meant[word] = out
        return out

    def _search(self, word: str) -> str | None:
        if word.isdigit():
            return None
        own = self.count(word)
        digits = any(c.isdigit() for c in word)
        if digits and not own and len(word) <= 7 and _DIGITS.match(word):
            return "".join(DIGIT_LETTERS.get(c, c) for c in word)
        if len(word) < 2:
            return None
        floor, lower = max(RARER * own, 5), word.lower()
        best, most = None, 0
        found = list(self._candidates(word, MISREAD_SYMBOLS))
        if len(word) >= 3:
            found += self._candidates(word, MISREAD_LETTERS)
        if not own:
            found += self.alike.get(drawn(word), ())
        for candidate in found:
            n = self.count(candidate)
            if n >= floor and n > most and candidate.lower() != lower:
                best, most = candidate, n
        return best

    def corrected(self, word: str) -> str:
        """A whole word, or a compound part by part, as it was meant."""
        return self._corrected[word]

    def _correct(self, word: str) -> str:
        whole = self.meant(word)
        if whole is not None or "-" not in word or self.count(word):
            return whole or word
        return "-".join(self.meant(p) or p for p in word.split("-"))

    def _is_misread(self, word: str) -> bool:
        bare = _strip(word)
        return bool(bare) and self.corrected(bare) != bare

    def misread(self, text: str) -> bool:
        """Whether a whole word of the text is misread."""
        return any(map(self._misread.__getitem__, whole_words(text)))

    def is_compound(self, left: str, right: str) -> bool:
        """Whether a line's end falls on a compound's own hyphen."""
        a, b = left.lower().strip(_EDGE_PUNCT), right.lower().strip(_EDGE_PUNCT)
        if f"{a}-{b}" in self.compounds or "-".join([a.rsplit("-", 1)[-1], b]) in self.compounds:
            return True
        a, b = self.corrected(a), self.corrected(b)
        if f"{a}-{b}" in self.compounds:
            return True
        return a + b not in self.known and b in self.tails and b not in ("ed", "ing")


# -- lines and features ----------------------------------------------------------------------------------------------


def segments(text: str) -> list[tuple[int, str]]:
    """(line, text) of the non-blank lines, cut at wide gaps except in tables."""
    out = []
    for i, line in enumerate(text.split("\n")):
        bare = line.strip()
        if bare:
            out += [(i, bare)] if bare.startswith("|") else [(i, part) for part in _GAP.split(bare) if part]
    return out


def unread_number(text: str, reader: Reader) -> str:
    """``text`` with misread words and digits as they were meant."""
    return _WORD.sub(lambda m: reader.corrected(m.group()), text)


def number_shape(text: str, reader: Reader, words: list[str] | None = None) -> bool:
    """Whether a line is a page's number, with or without words around it; a line of more than a dozen words is none."""
    words = words_of(text) if words is None else words
    if len(words) > 12:
        return False
    if _NUMBER.match(text) or any(map(reader.numeric.__getitem__, words)) and _NUMBER.match(unread_number(text, reader)):
        return True
    return bool(re.fullmatch(r"[0-9lIOSB]{1,4}", text) and any(c.isdigit() for c in text))


def skeleton(text: str) -> str:
    return re.sub(r"\d+", "#", " ".join(text.lower().split()))


def line_hash(text: str) -> int:
    """The hash of a line's skeleton, the same as on the JVM."""
    h = xxhash.xxh64_intdigest(skeleton(text).encode("utf-8", "surrogatepass"), seed=42)
    return h - (1 << 64) if h >> 63 else h


def features(segs: list[tuple[int, str]], edge: bool, recurs: dict[int, str], reader: Reader) -> list[tuple]:
    """Per segment: place, shape, recurrence ('edge', 'inner' or '') and words."""
    out = []
    last = segs[-1][0] if segs else 0
    first = segs[0][0] if segs else 0
    for k, (line, text) in enumerate(segs):
        alone = first == last
        place = ("edge" if edge else "inner") + ("-alone" if alone else "-first" if line == first else "-last" if line == last else "-mid")
        gap = k > 0 and segs[k - 1][0] == line
        words = words_of(text)
        if number_shape(text, reader, words):
            shape = "number-gap" if gap else "number"
        elif text.startswith("|"):
            shape = "row"
        elif re.fullmatch(r"[^\s:]+(?: [^\s:]+)?: [^.]{1,40}", text):
            shape = "label"
        elif len(text) > 75:
            shape = "long"
        elif text[-1] in ".!?" or re.search(r"[^\W\d_][-‐‑¬­]$", text[-3:]):
            shape = "sentence"
        elif text[:1].islower():
            shape = "running"
        elif re.match(r"\d+(\.\d+)* +\S", text):
            shape = "numbered"
        else:
            shape = "short"
        ws = tuple(dict.fromkeys(map(reader.folded.__getitem__, words)))
        out.append((place, shape, recurs.get(line_hash(text), "") if recurs else "", ws))
    return out


class LineModel:
    """Hidden Markov model over segments: categorical place and shape, recurrence, and a bag of words per state."""

    def __init__(self, sequences: list[tuple[list[tuple], list[str]]], rounds: int = 2) -> None:
        self.n = {s: i for i, s in enumerate(STATES)}
        self._fit(sequences)
        for _ in range(rounds):  # the labels of the model's own best path; only numbers and running text keep their own
            self._fit([(f, [given if given in ("number", "body") else got for given, got in zip(labels, self.path(f))]) for f, labels in sequences])

    def _fit(self, sequences: list[tuple[list[tuple], list[str]]]) -> None:
        start, step = Counter(), Counter()
        place, shape, recur, word, total = Counter(), Counter(), Counter(), Counter(), Counter()
        seen: set[str] = set()
        for feats, labels in sequences:
            before = None
            for (p, sh, r, ws), s in zip(feats, labels):
                if s:
                    (start.update([s]) if before is None else step.update([(before, s)]))
                    place[s, p] += 1
                    shape[s, sh] += 1
                    recur[s, r] += 1
                    total[s] += 1
                    for w in ws:
                        word[s, w] += 1
                        seen.add(w)
                before = s or None
        log = math.log
        places = len({k[1] for k in place}) or 1
        # a line may be anywhere: pages are merged, so a header can come to stand amid a paragraph
        spread = lambda p, n: log(0.8 * p + 0.2 / n)
        self.start = [log((start[s] + 1) / (sum(start.values()) + len(STATES))) for s in STATES]
        self.step = [[spread((step[a, b] + 1) / (sum(step[a, c] for c in STATES) + len(STATES)), 4 * len(STATES)) for b in STATES] for a in STATES]
        self.into = [[self.step[a][b] for a in range(len(STATES))] for b in range(len(STATES))]
        self.place = {p: [spread((place[s, p] + 0.5) / (total[s] + 4), places) for s in STATES] for p in {k[1] for k in place}}
        self.shape = {p: [log((shape[s, p] + 0.05) / (total[s] + 0.5)) for s in STATES] for p in {k[1] for k in shape}}
        self.recur = {r: [spread((recur[s, r] + 0.5) / (total[s] + 1), 4) for s in STATES] for r in RECURS}
        # how much a word speaks for a state, against its rate over all states
        self.word = {}
        for w in seen:
            rates = [(word[s, w] + 0.1) / (total[s] + 5) for s in STATES]
            mean = sum(rates) / len(rates)
            self.word[w] = [log(x / mean) for x in rates]
        self.none = [0.0] * len(STATES)
        self._memo: dict[tuple, list[float]] = {}

    def emission(self, f: tuple) -> list[float]:
        place, shape, recurs, ws = f
        base = self._memo.get(f[:3])
        if base is None:
            base = self._memo[f[:3]] = [sum(x) for x in zip(self.place.get(place, self.none), self.shape.get(shape, self.none), self.recur[recurs])]
        word = self.word
        voted = [word[w] for w in ws if w in word]
        if not voted:
            return base
        scale = 1.0 if len(voted) <= 6 else 6.0 / len(voted)
        return [b + scale * sum(v) for b, v in zip(base, zip(*voted))]

    def path(self, feats: list[tuple]) -> list[str]:
        """The most probable labels."""
        if not feats:
            return []
        score = [s + x for s, x in zip(self.start, self.emission(feats[0]))]
        back = []
        for f in feats[1:]:
            came, after = [], []
            for x, steps in zip(self.emission(f), self.into):
                ways = [a + b for a, b in zip(score, steps)]
                best = max(ways)
                came.append(ways.index(best))
                after.append(best + x)
            score = after
            back.append(came)
        at = score.index(max(score))
        out = [at]
        for came in reversed(back):
            at = came[at]
            out.append(at)
        return [STATES[i] for i in reversed(out)]


def self_labels(feats: list[tuple], kind: str | None) -> list[str]:
    """Labels of the segments that label themselves; '' for the others."""
    out = []
    for place, shape, where, _ in feats:
        recurs = where == "edge"
        edge_alone = place == "edge-alone"
        if shape in ("number", "number-gap") and (edge_alone or shape == "number-gap"):
            out.append("number")
        elif shape in ("row", "label"):
            out.append("break")
        elif recurs and edge_alone and shape in ("short", "numbered"):
            out.append("header")
        elif shape in ("long", "sentence", "running") and not recurs:
            out.append("body")
        elif shape == "numbered" and not recurs or kind == "heading" and place == "inner-alone":
            out.append("break")
        else:
            out.append("")
    return out


# -- the operator ----------------------------------------------------------------------------------------------------


def recurring_lines(blocks: DataFrame, shelf: Shelf) -> DataFrame:
    """record_id, recurring: the hashes of the block's segments, as skeletons, that stand on two or more pages of the
    document, each with whether they do so at page edges.

    The lines of all blocks count, whatever the block's length and place, and every block that holds such a line is marked.
    A line is at a page's edge if it belongs to a short block there, or is the first or last line of a longer one.  Only
    hashes and places of the lines are shuffled.
    """
    plain = lambda c: F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), r"\d+", "#")
    rows = blocks.filter("document_id is not null").select(
        "record_id", "document_id", "page", "edge", (F.char_length("text") < SHORT_BLOCK).alias("short"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S")).alias("lines")
    )
    rows = rows.withColumn("n", F.size("lines"))  # columns of their own, so that no line computes them again
    cut = F.transform("lines", lambda x, i: F.struct((F.col("edge") & (F.col("short") | (i == 0) | (i == F.col("n") - 1))).alias("at_edge"), F.when(x.rlike(r"^\s*\|"), F.array(x)).otherwise(F.split(x, r"[ \t]{3,}")).alias("parts")))
    segs = F.flatten(F.transform(cut, lambda x: F.transform(x["parts"], lambda part: F.struct(plain(part).alias("line"), x["at_edge"].alias("at_edge")))))
    each = rows.select("record_id", "document_id", "page", F.explode(segs).alias("seg")).filter("seg.line <> ''")
    parts = shelf.keep(each.select("record_id", "document_id", "page", F.xxhash64("seg.line").alias("line"), "seg.at_edge"))
    outer = F.when(F.col("at_edge"), F.col("page"))
    again = (
        parts.groupBy("document_id", "line")
        .agg(F.min("page").alias("p"), F.max("page").alias("q"), F.coalesce(F.min(outer) != F.max(outer), F.lit(False)).alias("outer"))
        .filter("p <> q")
        .select("document_id", "line", "outer")
    )
    return parts.select("record_id", "document_id", "line").join(again, ["document_id", "line"]).groupBy("record_id").agg(F.collect_set(F.struct("line", "outer")).alias("recurring"))


def placed(blocks: DataFrame, shelf: Shelf) -> DataFrame:
    """record_id, document_id, page, ord, kind, text, edge (first or last block of its page), recurring (skeletons of its
    segments that stand on two or more pages of the document, by whether they do so at page edges)."""
    b = blocks.select("record_id", "document_id", "page", "ord", "kind", "text").filter("text is not null")
    ends = b.filter("document_id is not null and page is not null").groupBy("document_id", "page").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    b = b.join(ends, ["document_id", "page"], "left").withColumn("edge", F.coalesce((F.col("ord") == F.col("lo")) | (F.col("ord") == F.col("hi")), F.lit(True))).drop("lo", "hi")
    return b.join(recurring_lines(b, shelf), "record_id", "left")


def recurrences(recurring) -> dict[int, str]:
    """Hash of a skeleton -> where it recurs, of the marks of a block."""
    return {m["line"]: "edge" if m["outer"] else "inner" for m in recurring} if recurring is not None else {}


def trained(rows: DataFrame, reader: Reader, train_blocks: int = TRAIN_BLOCKS) -> LineModel:
    """The line model, trained on the ``train_blocks`` blocks with the smallest hashes."""
    sample = rows.select("kind", "text", "edge", "recurring", F.xxhash64("record_id").alias("h")).orderBy("h").limit(train_blocks).collect()  # bounded
    sequences = []
    for r in sample:
        feats = features(segments(r.text), r.edge, recurrences(r.recurring), reader)
        sequences.append((feats, self_labels(feats, r.kind)))
    return LineModel(sequences)


class Page:
    """Labels, defects and repaired text of one block."""

    def __init__(self, text: str, edge: bool, recurring: dict[int, str], reader: Reader, model: LineModel) -> None:
        self.segs = segments(text)
        self.labels = model.path(features(self.segs, edge, recurring, reader))
        self.reader = reader
        self.defects: set[str] = set()
        for label in self.labels:
            if label == "header":
                self.defects.add("header")
            elif label == "number":
                self.defects.add("page_number")
        self.text = self._joined()
        if self._misread():
            self.defects.add("chars")

    def _misread(self) -> bool:
        aside = [text for (_, text), label in zip(self.segs, self.labels) if label in ("header", "number")]
        return self.reader.misread(self.text) or any(map(self.reader.misread, aside))

    def _joined(self) -> str:
        """Body lines as one paragraph, breaks on lines of their own."""
        out: list[str] = []
        before = ""  # the last word of the open paragraph
        for (_, text), label in zip(self.segs, self.labels):
            if label in ("header", "number"):
                continue
            goes_on = bool(_CUT.fullmatch(before)) and text[:1].islower()  # a cut word overrules the labels
            if text.startswith("|") or label == "break" and not goes_on:
                out += ["\n", text] if out else [text]
                last = text.rsplit(None, 1)[-1]
                before = last if _CUT.fullmatch(last) and not text.startswith("|") else ""
                continue
            if before:
                cut, head = _CUT.fullmatch(before), _HEAD.match(text)
                if cut and head:
                    compound = self.reader.is_compound(cut.group(1), head.group(1))
                    if not compound:
                        self.defects.add("hyphenation")
                    out[-1] = out[-1][:-1] + ("-" if compound else "")
                else:
                    out.append(" ")
            elif out:
                out.append("\n")
            out.append(text)
            before = text.rsplit(None, 1)[-1]
        return "".join(out)

    def readable(self) -> str:
        def fix(m: re.Match) -> str:
            bare = _strip(m.group())
            return m.group().replace(bare, self.reader.corrected(bare)) if bare else m.group()

        return "\n".join(line if line.startswith("|") else _WORD.sub(fix, line) for line in self.text.split("\n"))


def _prepared(blocks: DataFrame):
    spark = blocks.sparkSession
    shelf = Shelf(spark)
    rows = shelf.keep(placed(blocks, shelf))
    counts = word_counts(blocks, shelf)
    model = trained(rows, Reader(counts))
    return rows, spark.sparkContext.broadcast((counts, model))


def _page(shared, held: list, text: str, edge: bool, recurring) -> Page:
    if not held:
        counts, model = shared.value
        held += [Reader(counts), model]
    return Page(text, edge, recurrences(recurring), *held)


def scan_defects(blocks: DataFrame) -> DataFrame:
    """record_id, defect of every block: hyphenation, chars, header, page_number."""
    rows, shared = _prepared(blocks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for pdf in batches:
            out = [(i, d) for i, t, e, r in zip(pdf["record_id"], pdf["text"], pdf["edge"], pdf["recurring"]) for d in sorted(_page(shared, held, t, e, r).defects)]
            yield pd.DataFrame(out, columns=["record_id", "defect"])

    return rows.select("record_id", "text", "edge", "recurring").mapInPandas(run, "record_id bigint, defect string")


def readable_paragraphs(blocks: DataFrame) -> DataFrame:
    """record_id, document_id, page, ord, text: the repaired text of every block that isn't furniture only."""
    rows, shared = _prepared(blocks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for pdf in batches:
            fixed = [_page(shared, held, t, e, r).readable() for t, e, r in zip(pdf["text"], pdf["edge"], pdf["recurring"])]
            yield pdf[["record_id", "document_id", "page", "ord"]].assign(text=fixed)

    return rows.select("record_id", "document_id", "page", "ord", "text", "edge", "recurring").mapInPandas(run, "record_id bigint, document_id string, page int, ord int, text string").filter("text <> ''")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return scan_defects(table(spark, root, "blocks"))


def p4_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return readable_paragraphs(table(spark, root, "blocks"))
