"""What a printed bibliography entry says, read without knowing its style."""

from __future__ import annotations

import re
from typing import NamedTuple

from quirelake.functions.fold import bare

# Single characters that scanning confuses, folded to one of them, and then pairs that look like one letter.
_ALIKE = str.maketrans("i10a59chfz", "lloosgebts")
_PAIRS = (("rn", "m"), ("el", "d"), ("vv", "w"), ("ll", "u"), ("rl", "n"))
# Words of serial titles, and words that say nothing about which work is meant.
_SERIAL = "journal annals archives bulletin proceedings transactions review letters reports advances acta zeitschrift revue"
_EMPTY = "with from under that this their vol accessed available online reprinted press via further general some recent"
# Signs that a work is a sequel or a part of another.
_SEQUEL = re.compile(r"\b(?:further|part\s+(?:[ivx]+|\d+)|ii|iii|iv|second|sequel|continued|supplement|erratum|reply|addendum)\b")
_NUMBER_OF = {"second": "ii", "part 2": "ii", "part ii": "ii", "part 3": "iii", "part iii": "iii", "part 1": "i", "part i": "i"}
_HEADER = re.compile(r"\n[ \t]*(?:[-–—] ?\d{1,4} ?[-–—]|\d{1,4}|p\. ?\d+|page \d+ of \d+|\d+/\d+|(?:references|bibliography|literature cited|works cited)\s+\d+|\d+\s+(?:references|bibliography|literature cited|works cited))[ \t]*(?=\n|\Z)", re.IGNORECASE)
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-­‐][ \t]*\n\s*(?=[^\W\d_])")
_REMARK = re.compile(r"\(?accessed [^).]*\)?|https?://\S+|\bdoi:?\s*\S+|\b10\.\d{4,9}/\S+|available online\.?|reprinted\.?", re.IGNORECASE)
_WORDS = re.compile(r"[^\W_]+")
_YEARS = [re.compile(p) for p in (r"\((1[5-9]\d\d|20\d\d)[a-z]?\)", r"\b(1[5-9]\d\d|20\d\d);\s*\d", r",\s(1[5-9]\d\d|20\d\d)(?:,\sp\.|\.?\s*\Z)", r"(?<![\d–-])\b(1[5-9]\d\d|20\d\d)\b(?!\s*[–-]\s*\d)(?!\()")]
_PAGES = re.compile(r"(?<![\d/.])(\d{1,5})\s*[-–—]\s*(\d{1,5})(?![\d/])")


def skeleton(word: str) -> str:
    """The form that all scan readings of a lower-case word share, near enough."""
    word = word.translate(_ALIKE)
    for pair, one in _PAIRS:
        word = word.replace(pair, one)
    return word


_SERIALS = tuple(skeleton(w)[:4] for w in _SERIAL.split())
_SAYS_NOTHING = frozenset(skeleton(w) for w in _EMPTY.split())


class Entry(NamedTuple):
    words: int
    year: int | None
    pages: str | None
    sequel: str
    tokens: list[str]


def one_line(text: str) -> str:
    """The entry as one line: running headers out, broken words joined."""
    if "\n" in text:
        text = _HYPHEN.sub("", _HEADER.sub("", text))
    return " ".join(text.split())


def sequel_of(text: str) -> str:
    """The sequel signs in a lower-case title or entry, one word each, sorted; empty for none."""
    found = {_NUMBER_OF.get(s := " ".join(m.split()), s.removeprefix("part ")) for m in _SEQUEL.findall(text)}
    return " ".join(sorted(found))


def read_entry(text: str | None) -> Entry:
    """Word count (split at white space), year, pages, sequel signs and the distinct skeleton tokens.

    Words of four letters or more count; those of a serial's title after ``of`` are cut to their
    first three letters, so that abbreviations compare. ``further`` may stand anywhere in an entry, so
    it is no sign of a sequel here. Null and empty text give an empty entry.
    """
    if not text:
        return Entry(0, None, None, "", [])
    n = len(text.split())
    line = _REMARK.sub(" ", one_line(text))
    year = next((int(m.group(1)) for p in _YEARS if (m := p.search(line))), None)
    found = _PAGES.findall(line)
    pages = "-".join(found[-1]) if found else None
    low = bare(line)
    tokens: set[str] = set()
    words = _WORDS.findall(low)
    serial = 0
    for i, w in enumerate(words):
        if w.isdigit():
            continue
        s = skeleton(w)
        if i + 1 < len(words) and words[i + 1] in ("of", "ot", "0f") and (s[:4] in _SERIALS or w in ("j", "arch", "ann", "bull", "proc", "trans")):
            serial = 4
        if serial:
            serial -= 1
            if serial < 2 and len(s) >= 3:
                tokens.add("=" + s[:3])
            continue
        if len(s) >= 4 and s not in _SAYS_NOTHING:
            tokens.add(s)
    return Entry(n, year, pages, sequel_of(low.replace("further", " ")), sorted(tokens))
