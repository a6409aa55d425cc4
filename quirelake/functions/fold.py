"""Unicode folding of names and titles, in plain Python and as Arrow column functions.

The Python functions are pure; the column functions apply them once per distinct value of a batch.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode default-ignorable code points, as ranges of hexadecimal numbers.
IGNORABLE_RANGES = (
    "00AD 034F 061C 115F-1160 17B4-17B5 180B-180F 200B-200F 202A-202E 2060-206F 3164 FE00-FE0F FEFF FFA0 "
    "FFF0-FFF8 1BCA0-1BCA3 1D173-1D17A E0000-E0FFF"
)
# Letters of Cyrillic and Greek script that look like a Latin letter, each pair written together.
LOOKALIKES = (
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ӏl ѵv "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԌG ԚQ ԜW ҺH ӀI ЗZ "
    "αa οo νv ρp υu ιi "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
)


def _class(ranges: str) -> str:
    parts = []
    for item in ranges.split():
        low, _, high = item.partition("-")
        parts.append(f"\\U{int(low, 16):08X}-\\U{int(high or low, 16):08X}")
    return "".join(parts)


IGNORABLE = re.compile(f"[{_class(IGNORABLE_RANGES)}]")
SPACES = re.compile(r"[^\S ]+| {2,}")
WORD = re.compile(r"[^\W\d_]+")
TO_LATIN = {ord(pair[0]): pair[1] for pair in LOOKALIKES.split()}
TO_CYRILLIC = {ord(pair[1]): pair[0] for pair in reversed(LOOKALIKES.split()) if "Ѐ" <= pair[0] <= "ӿ"}
LATIN = re.compile("[A-Za-zªºÀ-ɏḀ-ỿ]")
FOREIGN = re.compile("[Ͱ-ϿЀ-ԯᲀ-᲏ἀ-῿ⷠ-ⷿꙀ-ꚟ]")
_ASCII = re.compile(r"[ -~]*\Z")


def _relatinise(match: re.Match) -> str:
    word = match.group()
    if LATIN.search(word) and FOREIGN.search(word):
        made = word.translate(TO_LATIN)
        # letters that look like no Latin one say that the word is of the other script
        return word.translate(TO_CYRILLIC) if FOREIGN.search(made) else made
    return word


def same_look(text: str | None) -> str | None:
    """``text`` in the one form of all texts that look like it, its case kept; null stays null.

    Ignorable characters go, every run of white space becomes one U+0020, compatibility forms are
    composed (NFKC), and within a word that mixes scripts the look-alike letters become Latin.
    """
    if text is None:
        return None
    if _ASCII.match(text):
        return SPACES.sub(" ", text).strip(" ")
    text = unicodedata.normalize("NFKC", IGNORABLE.sub("", text))
    text = WORD.sub(_relatinise, IGNORABLE.sub("", text))
    return SPACES.sub(" ", unicodedata.normalize("NFKC", text)).strip(" ")


def canonical(text: str | None) -> str | None:
    """:func:`same_look` with full case folding: the form in which texts compare."""
    if text is None:
        return None
    return unicodedata.normalize("NFKC", same_look(text).casefold())


def fold_name(text: str | None) -> str | None:
    """Compatibility decomposition without combining marks, lower case; null stays null."""
    if text is None:
        return None
    if text.isascii():
        return text.lower()
    kept = (c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return "".join(kept).lower()


def bare(text: str | None) -> str | None:
    """:func:`canonical` without accents: the form in which careless spellings compare."""
    if text is None:
        return None
    text = canonical(text)
    return text if text.isascii() else fold_name(text)


def per_distinct(function: Callable, kind: str = "string") -> Callable[[Column], Column]:
    """A column function that applies ``function`` once to each distinct value of an Arrow batch."""

    def over(values: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(values, use_na_sentinel=True)
        made = [function(v) for v in distinct] + [function(None)]
        return pd.Series([made[c] for c in codes], dtype=object)

    over.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, kind)


def column(function: Callable) -> Callable[[Column | str], Column]:
    """``function`` (text to text) as a column function, made when first used in a session."""
    made: list[Callable] = []

    def apply(value: Column | str) -> Column:
        if not made:
            made.append(per_distinct(function))
        return made[0](F.col(value) if isinstance(value, str) else value)

    return apply


same_look_column = column(same_look)
canonical_column = column(canonical)
fold_name_column = column(fold_name)
bare_column = column(bare)
