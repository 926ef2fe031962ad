"""Encoding of the whole corpus with a public byte-level BPE tokenizer, by prefix dynamic programming.

For every prefix of a piece's bytes there is exactly one token that its encoding ends with.  Going through the bytes once,
each prefix's last token is the longest vocabulary entry ending there that is compatible with the last token of what comes
before it; compatible means that the two tokens side by side encode to themselves.  Stored, these last tokens make
appending exact (only new bytes are looked at) and confine re-encoding after an edit to the piece's changed end.

Defined results
    * null and empty texts give an empty list; blank texts are encoded like any other;
    * strings that look like special tokens are ordinary text; no special token is added;
    * unpaired surrogates (no UTF-8) are replaced by U+FFFD.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from specweave.session import table

#: Where the vocabulary files lie; a parameter of everything below.
TOKENIZERS = os.environ.get("SPECWEAVE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces whose ids one worker keeps, and the longest piece that is kept.
KEPT_PIECES = 200_000
KEPT_BYTES = 64


class PrefixEncoder:
    """Byte-level BPE over one vocabulary file (lines of base64 bytes and rank)."""

    def __init__(self, path: str, pattern: str = PIECES) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self._fits: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}
        self._pieces: dict[str, list[int]] = {}

    def _merged(self, data: bytes) -> list[int]:
        """Plain merging of a short byte string; only ever asked for one token or two."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _reachable(self, token: int) -> bool:
        if token not in self._alone:
            self._alone[token] = self._merged(self.bytes_of[token]) == [token]
        return self._alone[token]

    def compatible(self, before: int, token: int) -> bool:
        """Whether the two tokens side by side encode to themselves."""
        key = (before, token)
        if key not in self._fits:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            self._fits[key] = self._merged(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
        return self._fits[key]

    def extend(self, data: bytes, last: list[int]) -> None:
        """Complete ``last``, the last token of each prefix of ``data``; entries already there are kept."""
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.ranks.get(data[start:end])
                if token is not None and self._reachable(token) and (start == 0 or self.compatible(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def tokens(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix, read backwards from its last tokens."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]

    def piece(self, text: str) -> list[int]:
        ids = self._pieces.get(text)
        if ids is None:
            data = text.encode("utf-8", "replace")
            last: list[int] = []
            self.extend(data, last)
            ids = self.tokens(last)
            if len(data) <= KEPT_BYTES:
                if len(self._pieces) >= KEPT_PIECES:
                    self._pieces.clear()
                self._pieces[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self.piece(piece)
        return out


class GrowingText:
    """An encoded text that can be appended to and edited without encoding all of it again.

    The last tokens of each piece's prefixes are kept.  Before an edit all pieces stay that end at least one piece ahead of
    it; behind it all stay from the first piece on that begins where one began before, because how a text is cut from there
    on depends on nothing to its left.  In between, prefixes common to an old and a new piece are reused.
    """

    def __init__(self, encoder: PrefixEncoder, text: str = "") -> None:
        self.encoder, self.text = encoder, ""
        self.pieces: list[tuple[int, str, list[int]]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace_from(self, start: int, tail: str) -> None:
        """Replace everything from ``start`` on by ``tail``."""
        self.replace(start, len(self.text), tail)

    def replace(self, start: int, end: int, new: str) -> int:
        """Replace the characters from ``start`` to ``end`` by ``new``; the number of pieces that were encoded again."""
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        keep = bisect_left(self.pieces, start, key=lambda p: p[0] + len(p[1]))
        keep = max(0, keep - 1)  # the cut before the change may depend on what follows it
        begin = self.pieces[keep][0] if keep < len(self.pieces) and keep else 0
        old = {at: (piece, last) for at, piece, last in self.pieces[keep:] if at < end}
        behind = bisect_left(self.pieces, end, key=lambda p: p[0])
        tail = self.pieces[behind:]
        starts = {at + shift: i for i, (at, _, _) in enumerate(tail)}
        made = []
        for m in self.encoder.pattern.finditer(self.text, begin):
            if m.start() >= start + len(new) and m.start() in starts:
                made += [(at + shift, piece, last) for at, piece, last in tail[starts[m.start()] :]]
                break
            data, last = m.group().encode("utf-8", "replace"), []
            if m.start() in old:
                before, known = old[m.start()]
                common = os.path.commonprefix([data, before.encode("utf-8", "replace")])
                last = known[: len(common)]
            self.encoder.extend(data, last)
            made.append((m.start(), m.group(), last))
        again = len(made) if not tail else sum(at < start + len(new) for at, _, _ in made)
        self.pieces = self.pieces[:keep] + made
        return again

    def ids(self) -> list[int]:
        return [t for _, _, last in self.pieces for t in self.encoder.tokens(last)]


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoded(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids of every document.  ``folder`` is read on the executors."""
    path = os.path.join(folder, vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, PrefixEncoder(path))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [encoder.encode(t) for t in pdf["text"]]})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id bigint, ids array<int>")


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return encoded(table(spark, root, "documents"))
