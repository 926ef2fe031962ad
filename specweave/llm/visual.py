"""How a text looks: one spelling for characters that can't be told apart on the page.

``base_form`` replaces what never shows: full-width forms, compatibility ligatures, no-break and other blanks of one
blank's kind, zero-width characters, decomposed accents, CR LF.  Look-alike letters of other scripts are left to the
script-aware repair of ``lookalikes``; ``latin_form`` maps them to Latin where only a comparison is wanted.
"""

from __future__ import annotations

import re
import unicodedata

#: Letters that look like a Latin one, by script (letter and its double, alternating).
CYRILLIC = dict(zip(*[iter("аaеeоoрpсcуyхxѕsіiјjһhԁdԛqԝwӏlёëїïАAВBЕEЅSІIЈJКKМMНHОOРPСCТTУYХXԌGҮYЁËЇÏ")] * 2))
GREEK = dict(zip(*[iter("οoνvΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX")] * 2))
#: Ligatures and other single characters drawn like a sequence.
DRAWN = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǆ": "dž", "ǉ": "lj", "ǌ": "nj", "…": "..."}
#: Code points of blanks that print as one blank, of hyphens, and of characters that print nothing.
BLANK_POINTS = (0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x202F, 0x205F, 0x3000)
HYPHEN_POINTS = (0x2010, 0x2011)
INVISIBLE_POINTS = (0xAD, 0x34F, 0x61C, 0x180E, 0x200B, 0x200E, 0x200F, 0x202A, 0x202B, 0x202C, 0x202D, 0x202E, 0x2060, 0x2061, 0x2062, 0x2063, 0x2064, 0x2066, 0x2067, 0x2068, 0x2069, 0xFEFF)

_TABLE: dict[int, str | None] = {ord(c): s for c, s in DRAWN.items()}
_TABLE |= dict.fromkeys(BLANK_POINTS, " ") | dict.fromkeys(HYPHEN_POINTS, "-") | dict.fromkeys(INVISIBLE_POINTS, None)
_TABLE |= {p: chr(p - 0xFEE0) for p in range(0xFF01, 0xFF5F)}
_TABLE |= {p: unicodedata.normalize("NFKC", chr(p)) for p in range(0xFF61, 0xFFA0)}
_TABLE[0xB5] = "μ"
_JOINERS = re.compile("[‌‍]")
_TO_LATIN = CYRILLIC | GREEK
#: Most texts hold few of these characters; a search for them is much faster than a translation of every character.
_PLAIN = {chr(p): s or "" for p, s in _TABLE.items()}
_CHANGED, _DOUBLED = re.compile("[" + re.escape("".join(_PLAIN)) + "]"), re.compile("[" + "".join(_TO_LATIN) + "]")


def _joins(a: str, b: str) -> bool:
    """Whether a joiner between ``a`` and ``b`` shows: between pictographs, or within Arabic and Indic writing."""

    def shaped(c: str) -> bool:
        return "؀" <= c <= "෿" or "က" <= c <= "႟" or "ក" <= c <= "៿"

    def picture(c: str) -> bool:
        return unicodedata.category(c) in ("So", "Sk") or c == "️"

    return bool(a and b) and (shaped(a) and shaped(b) or picture(a) and picture(b))


def base_form(text: str) -> str:
    """``text`` with one spelling for everything that prints alike, look-alike letters excepted."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if text.isascii():
        return text
    text = _CHANGED.sub(lambda m: _PLAIN[m.group()], text)
    if "‌" in text or "‍" in text:
        whole = text
        text = _JOINERS.sub(lambda m: m.group() if _joins(whole[m.start() - 1 : m.start()], whole[m.end() : m.end() + 1]) else "", whole)
    return unicodedata.normalize("NFC", text)


def latin_form(text: str) -> str:
    """The base form with look-alike letters in Latin: equal for texts that read the same."""
    if text.isascii() and "\r" not in text:
        return text
    return unicodedata.normalize("NFC", _DOUBLED.sub(lambda m: _TO_LATIN[m.group()], base_form(text)))
