"""Arrow column functions for text whose rule is sequential: fences, tables, scripts, similarity.

The plain functions beside them are pure and tested alone.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.functions.fold import column

_FENCE = re.compile(r"\s*(`{3,}|~{3,})\s*([^`\s]*)\s*")


class Fence(NamedTuple):
    """A line that opens or closes fenced code: its mark, repeated, and its info word."""

    mark: str
    info: str

    def ended_by(self, other: Fence | None) -> bool:
        return other is not None and not other.info and other.mark.startswith(self.mark)


def fence_of(line: str) -> Fence | None:
    found = _FENCE.fullmatch(line)
    return Fence(*found.groups()) if found else None


def fence_code(content: str | None) -> str | None:
    """Code in a fence longer than any run of backticks in it; one outer fence that it has already goes, closed or not, its info stays."""
    if content is None:
        return None
    lines = content.split("\n")
    opened = fence_of(lines[0])
    if opened:
        closed = len(lines) > 1 and opened.ended_by(fence_of(lines[-1]))
        lines = lines[1 : len(lines) - closed]
    longest = max(map(len, re.findall("`+", "\n".join(lines))), default=0)
    mark = "`" * max(3, longest + 1)
    return "\n".join([mark + (opened.info if opened else ""), *lines, mark])


def repair_doubled_fences(text: str | None) -> str | None:
    """A block between two bare fences of three backticks that has fences within becomes one block, fenced by T15.

    One walk over the lines knows the block that is open and the fence open within it; the line after a
    bare opener may open one too. Blocks with an info word or another mark are passed over whole, and
    what is never closed is left alone. Applying it twice changes nothing more.
    """
    if not text or "```" not in text:
        return text
    out: list[str] = []
    block: list[str] = []
    outer: Fence | None = None
    inner: Fence | None = None
    fences = 0
    for line in text.split("\n"):
        mark = fence_of(line)
        if outer is None:
            if mark is None:
                out.append(line)
            else:
                outer, inner, block, fences = mark, None, [line], 0
            continue
        block.append(line)
        wrapper = block[0] == "```"
        fences += wrapper and mark is not None
        if not wrapper:
            done = outer.ended_by(mark)
        elif inner is not None:
            done, inner = False, None if inner.ended_by(mark) else inner
        else:
            done = line == "```" and len(block) > 2
            inner = None if done else mark
        if done:
            out += fence_code("\n".join(block[1:-1]).strip()).split("\n") if fences > 1 else block
            outer = None
    return "\n".join(out + (block if outer else []))


class _Rows(HTMLParser):
    """Cells of the first table: text with row and column spans, row by row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list]] = []
        self.depth = 0
        self.done = self.open = False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth and tag == "tr":
            self.rows.append([])
            self.open = False
        elif self.depth and tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            named = dict(attrs)
            self.rows[-1].append([[], *(int(v) if (v := (named.get(k) or "").strip()).isdigit() and int(v) > 0 else 1 for k in ("rowspan", "colspan"))])
            self.open = True

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.open = False
        elif tag == "table" and self.depth:
            self.depth -= 1
            self.done = self.done or not self.depth

    def handle_data(self, data):
        if self.open and not self.done and data.strip():
            self.rows[-1][-1][0].append(data.strip())


def html_table_to_pipes(source: str | None) -> str | None:
    """The first HTML table as a pipe table; without one the stripped input, for an empty one ''.

    A cell that spans rows or columns is repeated in each; a bad span counts as 1; short rows are padded.
    """
    if source is None:
        return None
    if "<table" not in source.lower():
        return source.strip()
    parser = _Rows()
    parser.feed(source)
    grid: list[dict[int, str]] = [{} for _ in parser.rows]
    for r, cells in enumerate(parser.rows):
        at = 0
        for parts, down, across in cells:
            while at in grid[r]:
                at += 1
            text = " ".join(" ".join(parts).split()).replace("|", "\\|")
            for y in range(r, min(r + down, len(grid))):
                for x in range(at, at + across):
                    grid[y].setdefault(x, text)
            at += across
    width = max((max(row, default=-1) + 1 for row in grid), default=0)
    if not width:
        return ""
    lines = ["| " + " | ".join(row.get(x, "") for x in range(width)) + " |" for row in grid if row]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]])


def strip_orphan_marks(text: str | None) -> str | None:
    """Combining characters that follow no letter go."""
    if text is None or text.isascii():
        return text
    out: list[str] = []
    for c in text:
        if unicodedata.combining(c) and not (out and out[-1].isalpha()):
            continue
        out.append(c)
    return "".join(out)


_TWICE = re.compile(r"([\^_])\s*\{([^{}]*)\}\s*\1\s*\{([^{}]*)\}")
_MATH = re.compile(r"\$\$(.*?)\$\$|\$(.*?)\$", re.DOTALL)


def merge_double_scripts(text: str | None) -> str | None:
    """``^{a}^{b}`` as ``^{a b}``, the same for ``_``, until none is left."""
    while text and (made := _TWICE.sub(r"\1{\2 \3}", text)) != text:
        text = made
    return text


def normalise_math(text: str | None) -> str | None:
    """Formulas without padding inside their dollars, double scripts merged."""
    if text is None:
        return None

    def one(m: re.Match) -> str:
        mark = "$$" if m.group(1) is not None else "$"
        return mark + merge_double_scripts((m.group(1) if m.group(1) is not None else m.group(2)).strip()) + mark

    return _MATH.sub(one, text)


_LINK = re.compile(r"(!?\[[^\]]*\]\()([^)\s]+)(\))")


def relative_links(text: str | None, base: str) -> str | None:
    """Links to files under ``base`` relative to it; other paths and URLs stay."""
    if text is None:
        return None
    root = base.rstrip("/") + "/"
    return _LINK.sub(lambda m: m.group(1) + m.group(2).removeprefix(root) + m.group(3), text)


def words(text: str | None) -> list[str]:
    """Words of Latin letters and digits of the decomposed lower-case text; letters of other scripts part words as signs do."""
    return re.findall("[a-z0-9]+", unicodedata.normalize("NFKD", text or "").lower())


def normal_title(title: str | None) -> str:
    return " ".join(re.sub("[^a-z0-9 ]", " ", (title or "").lower()).split())


def title_similarity(a: str | None, b: str | None) -> float:
    """The matching-blocks ratio of two normalised titles; the order of the arguments matters."""
    return difflib.SequenceMatcher(None, normal_title(a), normal_title(b)).ratio()


def names_similar(a: str, b: str) -> bool:
    """Whether two folded family names are equal, one holds the other (both four letters or more), or agree to 0.8."""
    if a == b or len(a) >= 4 and len(b) >= 4 and (a in b or b in a):
        return True
    return difflib.SequenceMatcher(None, a, b).ratio() >= 0.8


fence_code_column = column(fence_code)
repair_fences_column = column(repair_doubled_fences)
html_table_column = column(html_table_to_pipes)
orphan_marks_column = column(strip_orphan_marks)
double_scripts_column = column(merge_double_scripts)
normalise_math_column = column(normalise_math)


def relative_links_column(value: Column | str, base: str) -> Column:
    return column(lambda t: relative_links(t, base))(value)


def title_similarity_column(a: Column | str, b: Column | str) -> Column:
    """T6 as a column; each distinct pair of a batch once."""

    def over(left: pd.Series, right: pd.Series) -> pd.Series:
        seen: dict[tuple, float] = {}
        out = []
        for pair in zip(left, right):
            if pair not in seen:
                seen[pair] = title_similarity(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype=float)

    over.__annotations__ = {"left": pd.Series, "right": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, "double")(a, b)


def words_column(value: Column | str) -> Column:
    def over(values: pd.Series) -> pd.Series:
        return values.map(words)

    over.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, "array<string>")(value)


def register(spark) -> None:
    """The similarity, folding and table functions for use in SQL text."""
    from quirelake.functions.fold import fold_name

    for name, function, kind in (("fold_name", fold_name, "string"), ("title_similarity", title_similarity, "double"), ("html_table_to_pipes", html_table_to_pipes, "string"), ("repair_doubled_fences", repair_doubled_fences, "string")):
        spark.udf.register(name, function, kind)
