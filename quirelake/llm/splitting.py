"""Problem 7: oversized texts cut at natural boundaries, with overlap.

Every place where a text may be cut has a strength. A sparse table answers, for any range of
boundaries, where the strongest is; the cutter asks it once for the end of a piece and once for the
start of the next. The table has as many levels as the longest range needs, so a text of n boundaries
costs O(n log limit) however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of boundary with their strength; a boundary lies at the end of the match.
STRENGTHS = (
    (9, re.compile(r"\n(?=#{1,2} )")),
    (8, re.compile(r"\n(?=#{3,6} )")),
    (7, re.compile(r"\n(?=<page_number>)")),
    (6, re.compile(r"\n[ \t]*\n(?:[ \t]*\n)*")),
    (5, re.compile(r"[.!?…]['\"”’)\]]*\s+(?=[\"“'‘(\[]?[^\W\d_a-z])|[。！？]")),
    (4, re.compile(r"\n")),
    (3, re.compile(r"[;:,–—]\s+")),
    (2, re.compile(r"\s+")),
)
#: Within these a cut is a last resort: its strength falls by 7, below a word's.
WHOLE = re.compile(r"(?:(?<=\n)|\A)```.*?\n```|\$\$.*?\$\$|\$[^$\n]+\$|<page_number>[^<]*</page_number>", re.DOTALL)
HARD = -9
#: Places between letters that end a piece only where nothing else offers itself.
_JOINING = re.compile("[̀-ͯ‍︀-️\U0001f3fb-\U0001f3ff]")


class Piece(NamedTuple):
    number: int
    start: int
    end: int
    overlap: int


class StrongestCut:
    """Range-maximum index over boundary strengths; of equal ones the rightmost. ``widest`` is the longest range that is asked for, in letters."""

    def __init__(self, text: str, widest: int | None = None) -> None:
        strength = np.full(len(text) + 1, HARD, np.int8)
        for value, pattern in reversed(STRENGTHS):
            ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
            strength[ends] = value
        for m in WHOLE.finditer(text):
            strength[m.start() + 1 : m.end()] = np.where(strength[m.start() + 1 : m.end()] > HARD, strength[m.start() + 1 : m.end()] - 7, HARD)
        self.places = np.flatnonzero(strength > HARD)
        self.text = text
        level = strength[self.places].astype(np.int64) * (len(self.places) + 1) + np.arange(len(self.places))
        self.levels = [level]
        # no range has more boundaries than letters and one
        most = len(level) if widest is None else min(len(level), widest + 1)
        while 2 * (step := 1 << (len(self.levels) - 1)) <= most:
            last = self.levels[-1]
            self.levels.append(np.maximum(last[:-step], last[step:]))

    def best(self, low: int, high: int) -> int:
        """The strongest boundary at a place from ``low`` to ``high``; without one, ``high`` or just before, not within a joined character."""
        a, b = int(np.searchsorted(self.places, low)), int(np.searchsorted(self.places, high, "right"))
        if a < b:
            k = (b - a).bit_length() - 1
            found = max(self.levels[k][a], self.levels[k][b - (1 << k)])
            return int(self.places[found % (len(self.places) + 1)])
        at = high
        while at > low and at < len(self.text) and _JOINING.match(self.text[at]):
            at -= 1
        return at if at > low else high


def pieces(text: str | None, limit: int = 6000, overlap: tuple[int, int] = (300, 700), least: float = 0.5) -> list[Piece]:
    """The pieces of ``text``: each at most ``limit`` code points, each after the first starting within
    the one before, ``overlap`` code points before its end.

    A piece that is not the last ends at the strongest boundary between ``least * limit`` and
    ``limit``. None for null and empty; one piece for a text within the limit.
    """
    if not text:
        return []
    low, high = overlap
    if not 0 <= low <= high < least * limit:
        raise ValueError("the overlap must be below the least piece")
    if len(text) <= limit:
        return [Piece(0, 0, len(text), 0)]
    index, out, start, over = StrongestCut(text, max(limit - int(least * limit), high - low)), [], 0, 0
    while len(text) - start > limit:
        end = index.best(start + int(least * limit), start + limit)
        out.append(Piece(len(out), start, end, over))
        start = index.best(end - high, end - low)
        over = end - start
    return [*out, Piece(len(out), start, len(text), over)]


def split_oversized(df: DataFrame, keys: tuple[str, ...], text: str = "text", limit: int = 6000, overlap: tuple[int, int] = (300, 700), with_text: bool = True) -> DataFrame:
    """Pieces of every text: ``keys``, ``piece`` (from 0), ``start``, ``end_at``, ``overlap_chars`` and ``piece_text``.

    Texts within the limit are one piece and never leave the JVM; only longer ones go to Python. A
    map without shuffle. Null and empty texts have no piece. Other columns are not read;
    ``with_text`` false leaves ``piece_text`` out.
    """
    source = df.select(*keys, F.col(text).cast("string").alias("__text")).where("length(__text) > 0")
    extra = [("piece", T.IntegerType()), ("start", T.IntegerType()), ("end_at", T.IntegerType()), ("overlap_chars", T.IntegerType())] + [("piece_text", T.StringType())] * with_text
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, t) for n, t in extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cut = [], []
            for i, value in enumerate(batch.column(len(keys)).to_pylist()):
                made = pieces(value, limit, overlap)
                rows += [i] * len(made)
                cut += [(*p, value[p.start : p.end]) if with_text else p for p in made]
            taken = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keys))]
            parts = list(zip(*cut)) if cut else [()] * len(extra)
            yield pa.RecordBatch.from_arrays(taken + [pa.array(v, pa.string() if n == "piece_text" else pa.int32()) for v, (n, _) in zip(parts, extra)], schema.names)

    size = F.length("__text")
    whole = [F.lit(0).alias("piece"), F.lit(0).alias("start"), size.alias("end_at"), F.lit(0).alias("overlap_chars")] + [F.col("__text").alias("piece_text")] * with_text
    within = source.where(size <= limit).select(*keys, *whole)
    return within.unionByName(source.where(size > limit).mapInArrow(run, schema))
