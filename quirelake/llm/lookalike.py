"""Problem 6: text that looks the same, brought to one form, with what had to be changed."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.functions.fold import FOREIGN, IGNORABLE, LATIN, WORD, canonical

FULL_WIDTH = re.compile("[！-｠￠-￦｡-ﾟ]")
LIGATURE = re.compile("[ﬀ-ﬆﬓ-ﬗĲĳŉǄ-ǌǱ-ǳ]")
COMBINING = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]")
INVISIBLE = re.compile(IGNORABLE.pattern[:-1] + r"\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]")
OTHER_SPACE = re.compile(r"[^\S ]")
GREEK = re.compile("[Ͱ-Ͽἀ-῿]")


def traits(text: str | None) -> list[str]:
    """The kinds of disguise in ``text``, in a fixed order; none for null and for plain ASCII words."""
    if text is None or (text.isascii() and text.isprintable()):
        return []
    found = [name for name, what in (("full_width", FULL_WIDTH), ("ligature", LIGATURE), ("combining", COMBINING), ("invisible", INVISIBLE), ("space", OTHER_SPACE)) if what.search(text)]
    if FOREIGN.search(text):
        plain = unicodedata.normalize("NFKC", INVISIBLE.sub("", text))
        for word in WORD.findall(plain):
            foreign = FOREIGN.findall(word)
            greek = sum(bool(GREEK.match(c)) for c in foreign)
            if foreign and (LATIN.search(word) or 0 < greek < len(foreign)):
                found.append("mixed_script")
                break
    return found


#: What a normal form may still hold that makes its text a disguise: marks that compose with nothing, and letters of another script.
_LEFT = re.compile(f"{COMBINING.pattern}|{FOREIGN.pattern}")


def unified(text: str | None) -> tuple[str | None, list[str]]:
    """The canonical form of ``text``, and the kinds of disguise, which are looked for only where the form isn't just the text in lower case."""
    form = canonical(text)
    if form is None or form == text.lower() and not _LEFT.search(form):
        return form, []
    return form, traits(text)


def unify_text(df: DataFrame, column: str, into: str = "form", traits_into: str = "traits") -> DataFrame:
    """``df`` with the canonical form of a text column and the kinds of disguise found in it.

    The form is NFKC, full case folding, one U+0020 for each run of white space, no
    default-ignorable characters and, in words of mixed script, Latin letters for their look-alikes.
    Each distinct value of a batch is worked once; there is no shuffle. A null value gives a null
    form and no traits, an empty one an empty form. Columns of these names are replaced.
    """

    def over(values: pd.Series) -> pd.DataFrame:
        codes, distinct = pd.factorize(values, use_na_sentinel=True)
        made = [unified(v) for v in distinct] + [(None, [])]
        return pd.DataFrame({"form": pd.Series([made[c][0] for c in codes], dtype=object), "traits": pd.Series([made[c][1] for c in codes], dtype=object)})

    over.__annotations__ = {"values": pd.Series, "return": pd.DataFrame}
    udf = F.pandas_udf(over, "form string, traits array<string>")
    made = "__unified"
    out = df.withColumn(made, udf(F.col(column)))
    return out.withColumns({into: F.col(f"{made}.form"), traits_into: F.col(f"{made}.traits")}).drop(made)
