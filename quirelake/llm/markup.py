"""Problem 1: residue of HTML, Markdown, wiki and LaTeX markup, turned into clean text.

A text is cut into flat blocks at blank lines. Each block's markup is resolved, then a small
decision tree looks at its word count and link density and at those of its neighbours, and says
whether the block is content or page furniture. Headings, lists, tables, fenced code, formulas and
page markers stay.
"""

from __future__ import annotations

import functools
import html
import html.entities
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML and of the JATS tag set in catalogue abstracts, as they occur in running text.
TAGS = (
    "a abbr address article aside audio b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav "
    "nowiki ol option p pre q ref references s samp script section select small span strike strong style sub summary sup table tbody td tfoot th "
    "thead time title tr tt u ul var video"
)
# LaTeX commands of running text by what becomes of their argument.
KEEP_ARGUMENT = "textbf textit emph texttt underline textsc textrm textsf textsl textnormal textup textmd mbox hbox text uppercase url path centerline textquote"
DROP_ARGUMENT = "label index vspace hspace bibliographystyle bibliography usepackage documentclass input include includegraphics pagestyle thispagestyle setcounter"
REFERENCE = "cite citep citet citeauthor citeyear ref eqref pageref autoref cref nameref"
HEADINGS = "part chapter section subsection subsubsection paragraph subparagraph title"
BARE = (
    "noindent indent newpage clearpage pagebreak linebreak newline smallskip medskip bigskip centering par item maketitle tableofcontents hfill vfill "
    "quad qquad ldots dots textendash textemdash textbackslash textasciitilde textquotedblleft textquotedblright LaTeX TeX small large Large huge "
    "footnotesize normalsize tiny it bf em sc tt rm sf itshape bfseries ttfamily textregistered texttrademark copyright S P ss ae oe o l aa AE OE O L AA i j"
)
SYMBOLS = {"ldots": "…", "dots": "…", "textendash": "–", "textemdash": "—", "textbackslash": "\\", "textasciitilde": "~", "textquotedblleft": "“", "textquotedblright": "”", "S": "§", "P": "¶", "ss": "ß", "ae": "æ", "oe": "œ", "o": "ø", "l": "ł", "aa": "å", "AE": "Æ", "OE": "Œ", "O": "Ø", "L": "Ł", "AA": "Å", "i": "i", "j": "j", "copyright": "©", "textregistered": "®", "texttrademark": "™", "LaTeX": "LaTeX", "TeX": "TeX", "newline": "\n", "linebreak": "\n", "quad": " ", "qquad": " "}
ACCENTS = {'"': "\u0308", "'": "\u0301", "`": "\u0300", "^": "\u0302", "~": "\u0303", "=": "\u0304", ".": "\u0307", "u": "\u0306", "v": "\u030c", "H": "\u030b", "c": "\u0327", "d": "\u0323", "b": "\u0331", "r": "\u030a", "k": "\u0328"}
MATH_ENVIRONMENTS = "equation align gather multline eqnarray displaymath math"


def _any(words: str) -> str:
    return "|".join(sorted(words.split(), key=len, reverse=True))


_ATTRIBUTES = r"(?:\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?)*\s*/?"
_ARGUMENT = r"\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}"

#: Spans that are left as they are.
PROTECTED = [
    ("fence", r"(?:(?<=\n)|\A)(?P<mark>`{3,}|~{3,})[^\n]*(?:\n|\Z)(?:.*?\n)??(?:(?P=mark)[`~]*[ \t]*(?=\n|\Z)|\Z)"),
    ("page", r"<page_number>\s*\d+\s*</page_number>"),
    ("display", r"\$\$.*?\$\$"),
    ("inline", r"(?<!\\)\$(?=[^\s$])[^$\n]*(?:\n[^$\n]+)?(?<![\s\\])\$(?!\d)"),
    ("codespan", r"(?<!`)`[^`\n']+`(?!`)"),
]
#: Markup by kind, the first that fits wins.
KINDS = [
    ("comment", r"<!--.*?-->"),
    ("drop_element", r"<(?P<gone>script|style)\b[^>]*>.*?</(?P=gone)\s*>"),
    ("note", r"<ref\b[^<>]*?(?:/>|>.*?</ref\s*>)"),
    ("html_table", r"<table\b[^<>]*>.*?</table\s*>"),
    ("html_heading", r"<h(?P<level>[1-6])\b[^<>]*>(?P<heading>.*?)</h(?P=level)\s*>"),
    ("sub", r"<sub\b[^<>]*>(?P<below>[^<>]*)</sub\s*>"),
    ("sup", r"<sup\b[^<>]*>(?P<above>[^<>]*)</sup\s*>"),
    ("anchor", r"<a\b[^<>]*>(?P<anchored>.*?)</a\s*>"),
    ("autolink", r"<(?P<uri>(?:https?|ftp|mailto):[^\s<>]+)>"),
    ("tag", rf"</?(?P<tag>(?i:{_any(TAGS)})|[A-Za-z]+:[A-Za-z][\w-]*){_ATTRIBUTES}>"),
    ("entity", r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"),
    ("image", r"!\[(?P<alt>[^\]\n]*)\]\([^()\n]*(?:\([^()\n]*\)[^()\n]*)*\)"),
    ("link", r"\[(?P<linked>[^\[\]\n]+)\]\((?!\s)[^()\s]+(?:\([^()\s]*\)[^()\s]*)*(?:\s+(?:\"[^\"\n]*\"|'[^'\n]*'))?\)"),
    ("definition", r"(?:(?<=\n)|\A)\[[^\[\]\n]+\]:[ \t]+<?\S*[/.]\S+[^\n]*"),
    ("reference_link", r"\[(?P<relinked>[^\[\]\n]*[^\W\d_][^\[\]\n]*)\]\[[^\[\]\n]*\]"),
    ("wiki_link", r"\[\[(?P<wiki>[^\[\]\n]*[^\W\d_][^\[\]\n]*)\]\]"),
    ("outer_link", r"\[(?:https?|ftp)://[^\s\]]+(?:[ \t]+(?P<outer>[^\]\n]+))?\]"),
    ("template", r"\{\{(?P<template>[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)*)\}\}"),
    ("wiki_table", r"(?:(?<=\n)|\A)\{\|(?P<cells>.*?)\n\|\}"),
    ("wiki_heading", r"(?:(?<=\n)|\A)(?P<bars>={2,6})[ \t]*(?P<wikihead>[^=\n](?:[^\n]*[^=\n])?)[ \t]*(?P=bars)[ \t]*(?=\n|\Z)"),
    ("magic", r"__(?:[A-Z]{3,})__"),
    ("wiki_emphasis", r"(?P<ticks>'{2,5})(?=[^\s'])(?P<ticked>[^\n]*?[^\s'])(?P=ticks)(?!')"),
    ("emphasis", r"(?<![\w*\\])(?P<stars>\*{1,3})(?=[^\s*])(?P<starred>(?:[^*\n]|\n(?!\s*\n))*?[^\s*\\])(?P=stars)(?![\w*])"),
    ("underscore", r"(?<![\w\\])(?P<unders>_{1,3})(?=[^\s_])(?P<undered>[^_\n]*(?:_[^_\W]+[^_\n]*)*?[^\s_\\])(?P=unders)(?!\w)"),
    ("struck", r"~~(?=\S)(?P<struck>[^~\n]*[^\s~])~~"),
    ("quote", r"(?:(?<=\n\n)|\A)>[^\n]*(?:\n[ ]{0,3}>[^\n]*)*"),
    ("environment", rf"\\begin\{{(?P<env>[A-Za-z]+)\*?\}}(?:\[[^\]]*\])?(?P<within>.*?)\\end\{{(?P=env)\*?\}}"),
    ("begin_end", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?"),
    ("tex_heading", rf"\\(?P<rank>{_any(HEADINGS)})\*?{_ARGUMENT.replace('(', '(?P<texhead>', 1)}"),
    ("tex_footnote", r"\\(?:footnote|footnotetext|thanks)" + _ARGUMENT.replace("(", "(?P<foot>", 1)),
    ("tex_script", r"\\text(?P<script>super|sub)script" + _ARGUMENT.replace("(", "(?P<scripted>", 1)),
    ("tex_link", r"\\href\{[^{}]*\}" + _ARGUMENT.replace("(", "(?P<href>", 1)),
    ("tex_reference", rf"~?\\(?P<refer>{_any(REFERENCE)})\*?(?:\[[^\]]*\])*\{{(?P<refkey>[^{{}}]*)\}}"),
    ("tex_keep", rf"\\(?:{_any(KEEP_ARGUMENT)})" + _ARGUMENT.replace("(", "(?P<kept>", 1)),
    ("tex_drop", rf"\\(?:{_any(DROP_ARGUMENT)})\*?(?:\[[^\]]*\])*\{{[^{{}}]*\}}"),
    ("tex_group", r"\{\\(?:it|bf|em|sc|tt|rm|sf|itshape|bfseries|ttfamily|small|large)\b\s*(?P<grouped>(?:[^{}]|\{[^{}]*\})*)\}"),
    ("tex_accent", r"\\(?P<accent>[\"'`^~=.]|[uvHcdbrk](?=\{))\s*\{?(?P<letter>\\?[A-Za-z])\}?"),
    ("tex_bare", rf"\\(?P<bare>{_any(BARE)})(?![A-Za-z])(?:\{{\}})?[ \t]?"),
    ("tex_quote", r"``(?P<quoted>[^`\n]+?(?:\n[^`\n]+?)?)''"),
    ("tex_single", r"(?<![\w`])`(?P<single>[^`'\n]+)'(?!\w)"),
    ("escape", r"\\(?P<escaped>[\\`*_{}\[\]()#+.!|<>~$%&^-])"),
]
#: Groups whose content is cleaned again.
_INNER = "heading below above anchored alt linked relinked outer wikihead ticked starred undered struck texhead foot scripted href kept grouped quoted single".split()
#: What may begin with each character, so that no other alternative is tried there.
STARTS = {
    "<": "page comment drop_element note html_table html_heading sub sup anchor autolink tag",
    "&": "entity",
    "!": "image",
    "[": "definition link reference_link wiki_link outer_link",
    "{": "template wiki_table tex_group",
    "=": "wiki_heading",
    "_": "magic underscore",
    "'": "wiki_emphasis",
    "*": "emphasis",
    "~": "fence struck tex_reference",
    ">": "quote",
    "`": "fence codespan tex_quote tex_single",
    "$": "display inline",
    "\\": "environment begin_end tex_heading tex_footnote tex_script tex_link tex_reference tex_keep tex_drop tex_accent tex_bare escape",
}
_WHAT = dict(PROTECTED + KINDS)
AT = {c: re.compile("|".join(f"(?P<k_{name}>{_WHAT[name]})" for name in names.split()), re.DOTALL) for c, names in STARTS.items()}
TRIGGER = re.compile(r"[<&\[{_*~\\`$]|!\[|''|(?:(?<=\n)|\A)(?:==|>)")
SCREEN = re.compile(r"[<&*_~\\{`]|''|\]\(|\]\[|\]:|\[\[|\[h|\[f|\n==|\A==|\n\n ?>|\A ?>")
_KEPT = frozenset(name for name, _ in PROTECTED)
_ENTITY_NAMES = frozenset(html.entities.html5)
#: Kinds whose text a reader follows elsewhere: they make a block's link density.
_LINKS = frozenset("anchor autolink image link definition reference_link wiki_link outer_link".split())
_BLANK = re.compile(r"\n[ \t]*\n\s*")


class Cells(HTMLParser):
    """The rows of a table: a list of cell texts each, row and column spans repeated."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict[int, str]] = []
        self.carried: dict[int, tuple[int, str]] = {}
        self.open: tuple[int, int, list[str]] | None = None

    @staticmethod
    def span(attributes: list, name: str) -> int:
        value = dict(attributes).get(name) or "1"
        return max(1, min(int(value), 1000)) if value.isdigit() else 1

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag == "tr":
            self.finish()
            self.rows.append({c: text for c, (left, text) in self.carried.items() if left > 0})
            self.carried = {c: (left - 1, text) for c, (left, text) in self.carried.items() if left > 1}
        elif tag in ("td", "th"):
            self.finish()
            self.open = (self.span(attributes, "rowspan"), self.span(attributes, "colspan"), [])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.finish()

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[2].append(data)

    def finish(self) -> None:
        if not self.open:
            return
        down, across, parts = self.open
        self.open = None
        if not self.rows:
            self.rows.append({})
        row, at, text = self.rows[-1], 0, " ".join("".join(parts).split())
        for _ in range(across):
            while at in row:
                at += 1
            row[at] = text
            if down > 1:
                self.carried[at] = (down - 1, text)

    def grid(self) -> list[list[str]]:
        self.finish()
        width = max((max(r, default=-1) + 1 for r in self.rows), default=0)
        return [[r.get(c, "") for c in range(width)] for r in self.rows if r]


def pipe_rows(grid: list[list[str]]) -> str:
    """A grid as a pipe table, its first row as the head."""
    if not grid:
        return ""
    lines = ["| " + " | ".join(c.replace("|", "\\|") for c in row) + " |" for row in grid]
    return "\n".join([lines[0], "|" + "---|" * len(grid[0]), *lines[1:]])


def _html_table(source: str) -> str:
    cells = Cells()
    cells.feed(source)
    return pipe_rows(cells.grid())


def _wiki_table(cells: str) -> str:
    rows: list[list[str]] = []
    for line in cells.split("\n")[1:]:
        line = line.strip()
        if line.startswith("|-"):
            rows.append([])
        elif line[:1] in ("|", "!") and not line.startswith("|+"):
            if not rows:
                rows.append([])
            for cell in re.split(r"\|\||!!", line[1:]):
                attributes, bar, text = cell.rpartition("|")
                rows[-1].append((text if bar and "=" in attributes else cell).strip())
    rows = [r for r in rows if r]
    width = max(map(len, rows), default=0)
    return pipe_rows([r + [""] * (width - len(r)) for r in rows])


def _list(within: str, mark: str) -> str:
    items = [" ".join(x.split()) for x in re.split(r"\\item\b(?:\[[^\]]*\])?", within)[1:]]
    return "\n".join(f"{i}. {x}" if mark == "1" else f"- {x}" for i, x in enumerate(items, 1))


class Cleaned(NamedTuple):
    text: str
    kinds: list[str]
    links: int
    linked_words: int


def resolve(text: str, depth: int = 0) -> Cleaned:
    """``text`` with its markup resolved, and the kinds of markup met, in order, with repeats."""
    kinds: list[str] = []
    tally = [0, 0]

    def inner(part: str) -> str:
        if depth > 6 or not SCREEN.search(part):
            return part
        made = resolve(part, depth + 1)
        kinds.extend(made.kinds)
        tally[0] += made.links
        tally[1] += made.linked_words
        return made.text

    def one(kind: str, m: re.Match) -> str:
        g = m.group
        if kind == "entity":
            if g()[1] != "#" and g()[1:] not in _ENTITY_NAMES:
                return g()
            kinds.append(kind)
            return html.unescape(g()).replace("\xa0", " ")
        kinds.append(kind)
        made = _convert(kind, m, inner)
        if kind in _LINKS:
            tally[0] += 1
            tally[1] += len(made.split())
        return made

    out, done = [], 0
    for trigger in TRIGGER.finditer(text):
        at = trigger.start()
        if at < done or (m := AT[text[at]].match(text, at)) is None:
            continue
        kind = next(k for k in m.groupdict() if k[:2] == "k_" and m[k] is not None)[2:] if m.lastgroup[:2] != "k_" else m.lastgroup[2:]
        if kind not in _KEPT:
            out += text[done:at], one(kind, m)
            done = m.end()
        else:
            out.append(text[done : m.end()])
            done = m.end()
    return Cleaned("".join(out) + text[done:], kinds, *tally)


def _convert(kind: str, m: re.Match, inner) -> str:
    """What the markup ``m`` of ``kind`` becomes."""
    g = m.group
    if kind in ("comment", "drop_element", "note", "definition", "magic", "tex_drop", "begin_end"):
        return ""
    if kind == "html_table":
        return "\n\n" + _html_table(g()) + "\n\n"
    if kind == "wiki_table":
        return "\n\n" + inner(_wiki_table(g("cells"))) + "\n\n"
    if kind in ("html_heading", "wiki_heading", "tex_heading"):
        level = {"h": lambda: int(g("level")), "w": lambda: len(g("bars")), "t": lambda: {"part": 1, "chapter": 1, "title": 1, "section": 2, "subsection": 3}.get(g("rank"), 4)}[kind[0]]()
        return "\n\n" + "#" * level + " " + " ".join(inner(g({"h": "heading", "w": "wikihead", "t": "texhead"}[kind[0]])).split()) + "\n\n"
    if kind == "sub":
        return "_" + inner(g("below"))
    if kind == "sup":
        return "^" + inner(g("above"))
    if kind == "tex_script":
        return ("^" if g("script") == "super" else "_") + inner(g("scripted"))
    if kind == "autolink":
        return g("uri")
    if kind == "tag":
        name = g("tag").lower().rpartition(":")[2]
        if name in ("br", "hr"):
            return "\n"
        if name in ("p", "div", "ul", "ol", "section", "article", "blockquote", "table", "dl", "header", "footer", "nav", "pre", "title", "sec"):
            return "\n\n"
        if name in ("li", "dt", "dd", "tr"):
            return "" if g().startswith("</") else "\n- " if name == "li" else "\n"
        return " " if name in ("td", "th") else ""
    if kind == "wiki_link":
        space, _, _ = g("wiki").partition(":")
        parts = [p.strip() for p in g("wiki").split("|")]
        if space.strip().lower() == "category":
            return ""
        if space.strip().lower() in ("file", "image"):
            return inner(parts[-1]) if len(parts) > 1 else ""
        return inner(parts[-1] or parts[0])
    if kind == "template":
        name, bar, rest = g("template").partition("|")
        name = name.strip().lower()
        if name in ("math", "mvar"):
            return f"${rest.strip()}$"
        return inner(rest.rpartition("|")[2]) if bar and name in ("lang", "nowrap", "em", "abbr", "sic", "small", "convert") else ""
    if kind == "quote":
        return inner(re.sub(r"(?m)^[ ]{0,3}>[ ]?", "", g()))
    if kind == "environment":
        name, within = g("env"), g("within")
        if name in MATH_ENVIRONMENTS.split():
            return f"\n\n$$\n{within.strip()}\n$$\n\n"
        if name in ("itemize", "enumerate", "description"):
            return "\n\n" + inner(_list(within, "1" if name == "enumerate" else "-")) + "\n\n"
        if name in ("verbatim", "lstlisting"):
            return f"\n\n```\n{within.strip(chr(10))}\n```\n\n"
        return "\n\n" + inner(within) + "\n\n"
    if kind == "tex_footnote":
        return f" ({inner(g('foot'))})"
    if kind == "tex_reference":
        tie = " " if g().startswith("~") else ""
        return tie + (f"[{g('refkey')}]" if g("refer").startswith("cite") else g("refkey"))
    if kind == "tex_accent":
        return unicodedata.normalize("NFC", g("letter").strip("\\") + ACCENTS[g("accent")])
    if kind == "tex_bare":
        name = g("bare")
        return "\n- " if name == "item" else SYMBOLS.get(name, "")
    if kind == "escape":
        return "\n" if g("escaped") == "\\" else g("escaped")
    if kind in ("tex_quote", "tex_single"):
        return f"“{inner(g('quoted'))}”" if kind == "tex_quote" else f"‘{inner(g('single'))}’"
    groups = m.groupdict()
    return next((inner(groups[name]) for name in _INNER if groups.get(name) is not None), "")


class Block(NamedTuple):
    """A flat block: its clean text, words, share of words within links, and number of links."""

    text: str
    words: int
    density: float
    links: int


# The blocks of the labelled table, in source form. Prose with and without links, captions and short lines are content;
# navigation and lists of links are furniture.
CONTENT = """\
The error of the motor decreases with the size of the sample.
As reported earlier, it holds.
It is short.
The record is long and has many words in it, so that it reads as one paragraph of a text about motors.
Two sets of data were used to test it, and neither showed what the first report had claimed.
See [the model](https://x.org/a) for more.
A [[model]] of the observation.
Consult <https://x.org/a> for the value.
The method of [Boyd](https://x.org/b) was extended by [Lee and Kahn](https://x.org/l) and then applied by [others](https://x.org/o) to the motors of the second plant without further change.
Following [earlier work](https://x.org/1), [two surveys](https://x.org/2) and [a later note](https://x.org/3), we measured the error again under the same conditions as before.
In [[thermodynamics]], the [[entropy]] of a [[closed system]] never decreases, which [[Rudolf Clausius|Clausius]] stated in the form that is still in use today.
The [[motor]] was built in the [[town]] by the [[company]] that had made the [[pump]].
<a href='/a'>The first report</a> and <a href='/b'>the second report</a> disagree about the size of the error, as <a href='/c'>a third one</a> points out.
Figure 3. The error of the motor by the size of the sample.
Table 2: Values of the sample.
![a curve of the error](crops/p1.png)
[[File:a.png|thumb|A curve of the model]]
Results are given below.
Proof. It follows from the first lemma.
We thank [the plant](https://x.org/p) for its help.
The code is kept [here](https://x.org/code).
[https://x.org/a the model]
(see [the appendix](https://x.org/app))
Keywords: motor, error, sample
Boyd, S. (2004). Errors of motors. [doi](https://doi.org/10.1/x)
No effect was found in the second sample (Lee 2001), though the first had shown one ([Boyd 1999](https://x.org/b); [Kahn 2000](https://x.org/k)).
"""
FURNITURE = """\
[Home](/) | [About](/about) | [Contact](/contact) | [Login](/login)
[Terms](/terms) [Privacy](/privacy) [Imprint](/imprint)
<a href='/p'>Previous</a> <a href='/n'>Next</a> <a href='/t'>Top</a>
[Home](/) > [Science](/s) > [Physics](/s/p) > [Motors](/s/p/m)
[Read more](/more) [Share](/share) [Print](/print)
[One](/1) [Two](/2) [Three](/3) [Four](/4) [Five](/5) [Six](/6)
[Jobs](/jobs) / [Press](/press) / [Help](/help) / [Site map](/map)
<a href='/de'>Deutsch</a> <a href='/fr'>Français</a> <a href='/es'>Español</a> <a href='/it'>Italiano</a>
[Subscribe](/s) [Follow us](/f) [Newsletter](/n) [Feed](/feed)
[Top stories of the week](/a) [What the plant does next](/b) [Ten motors that failed](/c)
"""


def labelled() -> list[tuple[str, str, str, int]]:
    """The small labelled table: a block between two neighbours, and whether it is content (1) or furniture (0).

    Every block stands between prose, at both ends of a text, and beside furniture.
    """
    good, bad = CONTENT.splitlines(), FURNITURE.splitlines()
    out = []
    for label, blocks in ((1, good), (0, bad)):
        for i, block in enumerate(blocks):
            prose = [good[(i + k) % len(good)] for k in (3, 4, 8)]
            links = [bad[(i + k) % 10] for k in (1, 2)]
            out += [(prose[0], block, prose[1], label), (prose[2], block, "", label), ("", block, prose[0], label)]
            if label == 0 or len(block.split()) > 7:
                out += [(links[0], block, prose[1], label), (prose[0], block, links[1], label)]
            if label == 0:
                out += [(links[0], block, links[1], label), ("", block, links[0], label), (links[1], block, "", label)]
    return out


def features(before: Block | None, block: Block, after: Block | None) -> list[float]:
    """Word count and link density of a block and of its neighbours."""
    none = Block("", 0, 0.0, 0)
    before, after = before or none, after or none
    return [block.words, block.density, before.words, before.density, after.words, after.density]


class Node(NamedTuple):
    feature: int
    at: float
    low: object
    high: object


def grow(x: np.ndarray, y: np.ndarray, depth: int = 4) -> Node | float:
    """A classification tree by Gini impurity; the first of equal splits, leaves hold the share of ones."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return float(y.mean())
    best: tuple[float, int, float] | None = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            impurity = sum(2 * p * (1 - p) * n for p, n in ((y[low].mean(), low.sum()), (y[~low].mean(), (~low).sum())))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return float(y.mean())
    low = x[:, best[1]] <= best[2]
    return Node(best[1], float(best[2]), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@functools.lru_cache(maxsize=1)
def tree() -> Node | float:
    """The tree trained on :func:`labelled`, once per process."""
    rows, labels = [], []
    for before, middle, after, label in labelled():
        rows.append(features(*(block_of(part) if part else None for part in (before, middle, after))))
        labels.append(label)
    return grow(np.array(rows, float), np.array(labels, float))


def is_content(values: list[float]) -> bool:
    node = tree()
    while isinstance(node, Node):
        node = node.low if values[node.feature] <= node.at else node.high
    return node >= 0.5


def block_of(source: str, made: Cleaned | None = None) -> Block:
    made = made or resolve(source)
    words = len(made.text.split())
    return Block(made.text, words, made.linked_words / words if words else float(made.links > 0), made.links)


#: Blocks that are never dropped: headings, lists, tables, quotes, code, formulas, images with a caption, page markers.
_STRUCTURE = re.compile(r"\s*(?:#{1,6}\s|[-*+]\s|\d+[.)]\s|\||```|~~~|\$|<page_number>)")


def is_structure(block: Block) -> bool:
    """Whether a block keeps its place whatever its words and links: its clean text begins a heading, list, table, code, formula or page marker, or has a formula in it."""
    return bool(_STRUCTURE.match(block.text)) or "$" in block.text or "```" in block.text


_CHUNKS = re.compile("|".join(f"(?:{what})" for _, what in PROTECTED[:3]), re.DOTALL)


def flat_blocks(text: str) -> list[str]:
    """``text`` cut at blank lines that are not within fenced code or a display formula."""
    cuts, at = [], 0
    spans = [m.span() for m in _CHUNKS.finditer(text)]
    k = 0
    for m in _BLANK.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] < m.start() < spans[k][1]:
            continue
        cuts.append(text[at : m.start()])
        at = m.end()
    cuts.append(text[at:])
    return [c for c in cuts if c.strip()]


class Clean(NamedTuple):
    text: str | None
    kinds: list[str]
    dropped: int


def clean_text(text: str | None) -> Clean:
    """The clean text, the kinds of markup that were in it, and how many blocks with words the tree dropped.

    A text without markup stays as it is, null and empty too. Structure is never dropped, nor is a
    block without links; blocks that resolve to nothing (comments, categories) fall away uncounted.
    """
    if not text or not SCREEN.search(text):
        return Clean(text, [], 0)
    made = resolve(text)
    if not made.kinds:
        return Clean(text, [], 0)
    blocks = [block_of(b) for b in _merged(flat_blocks(text))]
    kept, dropped = [], 0
    for i, b in enumerate(blocks):
        if not b.text.strip():
            continue
        before, after = blocks[i - 1] if i else None, blocks[i + 1] if i + 1 < len(blocks) else None
        if not b.links or is_structure(b) or is_content(features(before, b, after)):
            kept.append(b.text)
        else:
            dropped += 1
    out = re.sub(r"[ \t]+\n", "\n", "\n\n".join(kept))
    return Clean(re.sub(r"\n{3,}", "\n\n", out).strip(), made.kinds, dropped)


_OPENERS = (("{|", "|}"), ("\\begin{", "\\end{"), ("<!--", "-->"), ("<table", "</table"), ("{{", "}}"))


def _merged(blocks: list[str]) -> list[str]:
    """Blocks put together again where a table, environment, comment or template spans a blank line."""
    out: list[str] = []
    for b in blocks:
        if out and any(out[-1].count(o) > out[-1].count(c) and c in "".join(blocks) for o, c in _OPENERS if o in out[-1]):
            out[-1] += "\n\n" + b
        else:
            out.append(b)
    return out


def clean_markup(df: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """One row for each row of ``df``: ``keys``, ``kinds`` (markup met, sorted, without repeats), ``n_marks``, ``n_dropped`` (blocks of furniture) and ``clean``.

    A map without shuffle; other columns are not read. Null text gives null ``clean`` and no kinds,
    empty text stays empty.
    """
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField("kinds", T.StringType()), T.StructField("n_marks", T.IntegerType()), T.StructField("n_dropped", T.IntegerType()), T.StructField("clean", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [clean_text(v) for v in batch.column(len(keys)).to_pylist()]
            columns = [pa.array([",".join(sorted(set(m.kinds))) for m in made], pa.string()), pa.array([len(m.kinds) for m in made], pa.int32()), pa.array([m.dropped for m in made], pa.int32()), pa.array([m.text for m in made], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], [f.name for f in fields])

    return df.select(*keys, F.col(text).cast("string")).mapInArrow(run, T.StructType(fields))
