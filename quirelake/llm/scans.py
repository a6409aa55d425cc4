"""Problem 3: traces of scanning (broken words, misread characters, running headers) repaired.

One pass counts the words of the corpus, pre-aggregated in each task. In SQL, rare words meet their
frequent confusable variants by the difference of anagram hashes: the hash of a word is the sum of
the fifth powers of its characters, so a misreading such as ``m`` to ``rn`` changes it by a constant
whatever the word. A second pass takes edge lines out, joins broken words by evidence of the corpus
and applies the best-ranked correction of each word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.session import release, stage

# Characters and what scanning makes of them, true form first.
MISREADINGS = (
    "i>l l>1 i>1 o>0 s>5 g>9 e>c a>o t>f h>b u>ii w>vv d>cl m>rn ri>n rn>m li>h nn>im b>6 z>2 b>8 q>9 "
    "l>i c>e f>t b>h ii>u vv>w cl>d o>c o>a n>ri"
)
#: A correction needs a variant at least so many times as frequent as the word itself: less for a
#: long word, which rarely resembles another by chance, and least for a digit among letters.
RATIO = 10
RATIO_LONG = 5
RATIO_DIGIT = 2
LONG = 9
#: Bits of the filter that tells which words can have a correction at all: its size is fixed, whatever the data.
FILTER_BITS = 1 << 24
#: Entries a task holds before it hands its counts on.
HELD_WORDS = 200_000

_PROTECTED = re.compile(r"(?:(?<=\n)|\A)(`{3,}|~{3,})[^\n]*\n(?:.*?\n)??(?:\1[^\n]*(?=\n|\Z)|\Z)|\$\$.*?\$\$|\$[^$\n]+\$|<page_number>[^<]*</page_number>", re.DOTALL)
_TOKEN = re.compile(r"[^\W_]+(?:-[^\W\d_]+)*")
_HYPHENS = "-­‐"
_BREAK = re.compile(rf"(?<=[^\W_])[{_HYPHENS}][ \t]*\n([ \t\n]*)(?=[^\W_])")
#: Both halves of a break that has been marked.
_HALF = re.compile("(?:[^\\W_]*\0)+[^\\W_]+")
#: A word broken before a page marker, and its rest after it.
_TAIL = re.compile(rf"([^\W_]+)[{_HYPHENS}][ \t]*\n\s*\Z")
_HEAD = re.compile(r"\s*([a-z][^\W_]*)")
_SOFT = re.compile("(?<=[^\\W_])­(?=[^\\W_])")
_NUMBER_LINE = re.compile(r"\d{1,4}|[Pp]\.[ ]?\d{1,4}|[Pp]age[ ]\d+(?:[ ]of[ ]\d+)?|\d{1,4}[ ]?/[ ]?\d{1,4}|[-–—]+[ ]?\d{1,4}[ ]?[-–—]+|\[?\bpage[ ]\d+\]?")
# Headings that run along the pages of a bibliography.
_RUNNING = r"(?i:references|bibliography|literature cited|works cited|index|contents|appendix|notes)"
_NAMED = re.compile(
    rf"{_RUNNING}[ \t]+\d{{1,4}}|\d{{1,4}}[ \t]+{_RUNNING}|\d{{1,4}}[ \t]+\S+(?:[ ]\S+){{0,2}}[ ]et al\.?|\S+(?:[ ]\S+){{0,2}}[ ]et al\.?[ \t]+\d{{1,4}}"
    r"|CHAPTER[ ]\d+\.?[ ][^a-z]+|Chapter[ ]\d+\.?[ ][^.]+[ ]\d{1,4}|(?:[A-Z][\w.&'-]*|of|and|the|for|in|on)(?:[ ](?:[A-Z][\w.&'-]*|of|and|the|for|in|on|&))+,?[ ]Vol\.[ ]?\d+(?:,[ ]No\.[ ]?\d+)?(?:[ ,]+\d+)?"
    r"|(?:\d{1,4}[ \t]+)?[A-Z][\w.&'-]*(?:[ ](?:[A-Z][\w.&'-]*|of|and|the|for|in|on|&)){2,}[ \t]+\d{1,4}|\d{1,4}[ \t]+[A-Z][\w.&'-]*(?:[ ](?:[A-Z][\w.&'-]*|of|and|the|for|in|on|&)){2,}"
)
_SPACED = re.compile(r"\d{1,4}(?:[ ]{2,}|\t)\S.*[^.,;:]|\S.*[^.,;:](?:[ ]{2,}|\t)\d{1,4}")
_HEADING = re.compile(r"^#{1,6}[ \t]+(?:\d+(?:\.\d+)*\.?[ \t]+)?(.*)$", re.MULTILINE)
_STRUCTURE = re.compile(r"\s*(?:#{1,6} |[-*+•] |\d+[.)] |\(\d+\) |\||>|<page_number>|\[\d+\]|\[\[|\{[|{]|!|\\(?:begin|end|item)\b|</?[A-Za-z])")
_PLAIN = re.compile(r"[^\W_]+")
_DIGIT = re.compile(r"\d")


class Repaired(NamedTuple):
    text: str
    hyphens: int
    misread: int
    edges: int


def _bare(line: str) -> str:
    return " ".join(_PLAIN.findall(line)).lower()


def is_edge(line: str, title: str) -> bool:
    """Whether a line is a page number or a running header; ``title`` is the bare first heading of its text."""
    line = line.strip()
    if not line or len(line) > 90:
        return False
    if not _DIGIT.search(line) and not (title and title[:3] == line[:3].lower()):
        return False
    if line[0] in "#|>" or line.startswith("<page_number>"):
        return False
    if _NUMBER_LINE.fullmatch(line):
        return True
    if line[-1] in ".,;:" and not line.endswith("al."):
        return False
    if _NAMED.fullmatch(line) or _SPACED.fullmatch(line) and not re.match(r"\d+[.)]", line):
        return True
    if title:
        core = re.sub(r"^\d+\s+|\s+\d+$", "", line)
        words = _bare(core)
        if words.count(" ") >= 2 and title.startswith(words) and (core != line or core.isupper() or words.count(" ") >= 3):
            return True
    return False


def spans(text: str) -> list[tuple[bool, str]]:
    """``text`` in parts: (True, code or formula or page marker) and (False, prose)."""
    if "`" not in text and "$" not in text and "<page_number>" not in text and "~~~" not in text:
        return [(False, text)]
    out, at = [], 0
    for m in _PROTECTED.finditer(text):
        out += (False, text[at : m.start()]), (True, m.group())
        at = m.end()
    return [*out, (False, text[at:])]


def _title(text: str) -> str:
    m = _HEADING.search(text)
    return _bare(m.group(1)) if m else ""


def without_edges(prose: str, title: str) -> tuple[str, int]:
    """``prose`` without its edge lines, and how many there were; a blank line beside one goes with it where a sentence runs on.

    A single line has no edge: it is the whole text, not a line within one.
    """
    if "\n" not in prose:
        return prose, 0
    lines = prose.split("\n")
    kept: list[str] = []
    n, gap = 0, False
    for line in lines:
        if len(line) <= 90 and is_edge(line, title):
            n += 1
            gap = True
            continue
        if gap and kept:
            if not line.strip():
                continue
            while len(kept) > 1 and not kept[-1].strip():
                kept.pop()
            begins = line.lstrip()[:1]
            runs_on = kept[-1].strip() and not _STRUCTURE.match(line) and not kept[-1].startswith("#") and (begins.islower() or kept[-1].rstrip()[-1:] not in ".!?:")
            if not runs_on and kept[-1].strip():
                kept.append("")
        gap = False
        kept.append(line)
    return ("\n".join(kept), n) if n else (prose, 0)


def _halves(m: re.Match) -> tuple[str, str]:
    """The letters on both sides of a break."""
    text, at = m.string, m.start()
    while at and text[at - 1].isalnum():
        at -= 1
    return text[at : m.start()], _PLAIN.match(text, m.end()).group()


def _joined(a: str, b: str) -> bool:
    """Whether the halves may be one word: letters go on in the same manner of writing."""
    return b[0].islower() or b[0].isdigit() or a.isupper() and b.isupper()


def without_noise(text: str) -> tuple[list[tuple[bool, str]], int, int]:
    """The parts of ``text`` without edge lines and with words rejoined that go on after a page marker; how many of each."""
    title = _title(text) if text.startswith("#") else ""
    parts, edges, joined = spans(text), 0, 0
    for i, (protected, part) in enumerate(parts):
        if not protected and "\n" in part:
            part, n = without_edges(part, title)
            parts[i] = (False, part)
            edges += n
    for i in range(0, len(parts) - 2, 2):
        if not parts[i + 1][1].startswith("<page_number>"):
            continue
        tail, head = _TAIL.search(parts[i][1]), _HEAD.match(parts[i + 2][1])
        if tail and head:
            joined += 1
            parts[i] = (False, parts[i][1][: tail.end(1)] + head.group(1) + "\n\n")
            parts[i + 2] = (False, "\n\n" + parts[i + 2][1][head.end() :].lstrip())
    return parts, edges, joined


def words_of(text: str | None) -> tuple[list[str], list[str]]:
    """The lower-case words of the prose of ``text`` (compounds as one and in parts), and its breaks, each written ``a-b``."""
    words: list[str] = []
    breaks: list[str] = []
    if not text:
        return words, breaks

    def close(m: re.Match) -> str:
        a, b = _halves(m)
        if not _joined(a, b):
            return m.group()
        breaks.append(f"{a}-{b}".lower())
        return "\0"

    for protected, part in without_noise(text)[0]:
        if protected:
            continue
        if "\n" in part:
            part = _BREAK.sub(close, part)
            if "\0" in part:
                part = _HALF.sub(" ", part)
        if "\xad" in part:
            part = _SOFT.sub("", part)
        for w in _TOKEN.findall(part.lower()):
            words.append(w)
            if "-" in w:
                words.extend(w.split("-"))
    return words, breaks


Noise = tuple[list[tuple[bool, str]], int, int]


def asked_words(noise: Noise, longest: int) -> set[str]:
    """Every word and break that :func:`repair` may look up in a text (by its :func:`without_noise`), whichever breaks are closed.

    A run of halves can become one word in as many ways as it has parts; those of more than ``longest``
    letters, which no correction has, are left out.
    """
    out: set[str] = set()

    def mark(m: re.Match) -> str:
        a, b = _halves(m)
        if not _joined(a, b):
            return m.group()
        out.add(f"{a}-{b}".lower())
        return "\0"

    def spread(m: re.Match) -> str:
        halves = m.group().lower().split("\0")
        for i in range(len(halves)):
            run = ""
            for half in halves[i:]:
                run += half
                if len(run) > longest:
                    break
                out.add(run)
        return " "

    for protected, part in noise[0]:
        if protected:
            continue
        if "\n" in part:
            part = _BREAK.sub(mark, part)
        if "\xad" in part:
            part = _SOFT.sub("", part)
        if "\0" in part:
            part = _HALF.sub(spread, part)
        out.update(_PLAIN.findall(part.lower()))
    return out


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``kind`` (w: word, b: break), ``word`` and ``n`` over all distinct texts; counts are summed in each task before the shuffle.

    A text counts once however many rows hold it: copies are no evidence of how a word is spelt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        breaks: Counter[str] = Counter()

        def made() -> pa.RecordBatch:
            kinds = ["w"] * len(words) + ["b"] * len(breaks)
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([*words, *breaks], pa.string()), pa.array([*words.values(), *breaks.values()], pa.int64())], ["kind", "word", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                w, b = words_of(value)
                words.update(w)
                breaks.update(b)
            if len(words) + len(breaks) > HELD_WORDS:
                yield made()
                words.clear()
                breaks.clear()
        yield made()

    counted = df.select(F.col(text).cast("string")).distinct().mapInArrow(run, "kind string, word string, n bigint")
    return counted.groupBy("kind", "word").agg(F.sum("n").alias("n"))


def confusions() -> list[tuple[str, str, int]]:
    """(misread, true, what to add to the anagram hash of a word with the former to get the latter's)."""
    value = lambda s: sum(ord(c) ** 5 for c in s)
    return [(bad, good, value(good) - value(bad)) for good, _, bad in (pair.partition(">") for pair in MISREADINGS.split())]


def corrections(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word`` and ``instead``: the best-ranked correction of each word that has one.

    A word qualifies when the replacement of one misreading turns it into another word at least
    ``ratio`` times as frequent (less for long words and for digits). Variants rank by frequency, then by the order of the list of
    misreadings, then by spelling. Breaks whose hyphenated form is more frequent than the closed one
    come out as themselves (``a-b`` to ``a-b``): there the hyphen stays.
    """
    words = counts.where("kind = 'w'").select("word", "n")
    # a character's share of the hash: its fifth power, for scripts far up the table a hash of it, so that sums stay exact
    share = "IF(c = '', 0L, IF(ascii(c) < 1500, CAST(pow(ascii(c), 5) AS BIGINT), pmod(xxhash64(c), 17592186044416L)))"
    lexicon = words.where("word rlike '^[\\\\p{L}\\\\p{Nd}]{3,}$' AND word rlike '\\\\p{L}.*\\\\p{L}'").withColumn("h", F.expr(f"aggregate(split(word, ''), 0L, (a, c) -> a + {share})"))
    rules = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(bad).alias("bad"), F.lit(good).alias("good"), F.lit(d).cast("bigint").alias("delta")) for i, (bad, good, d) in enumerate(confusions())))
    asked = lexicon.select("word", "n", "h", F.explode(rules).alias("rule")).where("contains(word, rule.bad)").select("word", "n", "rule.*", F.expr("h + rule.delta").alias("h"))
    needed = f"CASE WHEN bad rlike '[0-9]' THEN {RATIO_DIGIT} WHEN length(word) >= {LONG} THEN {RATIO_LONG} ELSE {ratio} END * n"
    known = lexicon.where(f"n >= {min(ratio, RATIO_DIGIT)}").select(F.col("word").alias("instead"), F.col("n").alias("n_instead"), "h")
    # tables of words grow with the corpus: none of them is to be broadcast
    pairs = asked.join(known.hint("merge"), "h").where(f"n_instead >= {needed}")
    at = "concat(array_join(slice(p, 1, k), bad), good, array_join(slice(p, k + 1, size(p)), bad))"
    pairs = pairs.withColumn("p", F.expr("split(word, bad)")).where(F.expr(f"exists(sequence(1, size(p) - 1), k -> {at} = instead)"))
    best = pairs.groupBy("word").agg(F.max_by("instead", F.struct("n_instead", -F.col("rank"), "instead")).alias("instead"))
    broken = counts.where("kind = 'b'").select("word", F.regexp_replace("word", "-", "").alias("closed"))
    kept = (
        broken.join(words.select("word", F.col("n").alias("n_open")).hint("merge"), "word")
        .join(words.select(F.col("word").alias("closed"), F.col("n").alias("n_closed")).hint("merge"), "closed", "left")
        .where("n_open > coalesce(n_closed, 0)")
        .select("word", F.col("word").alias("instead"))
    )
    return best.unionByName(kept)


def _recase(word: str, instead: str) -> str:
    if word.isupper() and len(word) > 1:
        return instead.upper()
    return instead[0].upper() + instead[1:] if word[0].isupper() else instead


def _unwrap(prose: str) -> str:
    """Lines of one paragraph joined; headings, lists, tables and quotes keep their lines."""
    out: list[str] = []
    for line in prose.split("\n"):
        if out and line.strip() and out[-1].strip() and not _STRUCTURE.match(line) and not _STRUCTURE.match(out[-1][:40]) and not line.startswith("    "):
            out[-1] = f"{out[-1].rstrip()} {line.strip()}"
        elif out and line.strip() and re.match(r"\s*(?:[-*+•] |\d+[.)] )", out[-1]) and not _STRUCTURE.match(line) and line[:1].islower():
            out[-1] = f"{out[-1].rstrip()} {line.strip()}"
        else:
            out.append(line)
    return "\n".join(out)


def repair(text: str | None, instead: dict[str, str], one_line: bool = False, noise: Noise | None = None) -> Repaired:
    """``text`` repaired by the corrections ``instead``, with the number of each kind of repair.

    ``one_line`` makes a single line of it, as a bibliography entry is; ``noise`` is its :func:`without_noise` where that is known. Null and empty stay as they are.
    """
    if not text:
        return Repaired(text, 0, 0, 0)
    n = [0, 0, 0]

    def close(m: re.Match) -> str:
        a, b = _halves(m)
        if not _joined(a, b) or f"{a}-{b}".lower() in instead:
            return "-"
        n[0] += 1
        return ""

    def correct(m: re.Match) -> str:
        word = m.group()
        found = instead.get(word.lower())
        if found is None or "-" in found:
            return word
        n[1] += 1
        return _recase(word, found)

    def prose(part: str) -> str:
        if "\n" in part:
            part = _BREAK.sub(close, part)
        if "\xad" in part:
            part = _SOFT.sub("", part)
        if instead and not instead.keys().isdisjoint(_PLAIN.findall(part.lower())):
            part = _PLAIN.sub(correct, part)
        return _unwrap(part) if "\n" in part else part

    parts, n[2], n[0] = noise or without_noise(text)
    joined = [part if protected else prose(part) for protected, part in parts]
    out = "".join(joined)
    if one_line:
        out = " ".join(out.split())
    return Repaired(out, *n)


def _filter_of(table: DataFrame) -> tuple[np.ndarray, int]:
    """The Bloom filter of the words of ``table`` and the length of its longest; at most ``FILTER_BITS / 32`` rows come to the driver."""
    h = F.xxhash64("word")
    places = F.explode(F.array(F.pmod(h, F.lit(FILTER_BITS)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(FILTER_BITS)))).alias("p")
    cells = table.select(places).groupBy(F.expr("p DIV 32").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, CAST(p % 32 AS INT)))").alias("bits"))
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in cells.toLocalIterator():
        bits[r.cell] = r.bits
    return bits, table.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).first()[0]


class _MayHave(dict):
    """What the filter says of each word, asked once; kept for so many words at a time."""

    def __init__(self, bits: np.ndarray) -> None:
        super().__init__()
        self.bits = bits

    def __missing__(self, word: str) -> bool:
        if len(self) >= HELD_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode(), 42)
        made = self[word] = all(self.bits[(p := q % FILTER_BITS) >> 5] >> (p & 31) & 1 for q in (h, h >> 32))
        return made


def repair_scans(df: DataFrame, keys: tuple[str, ...], text: str = "text", one_line: str | None = None, with_text: bool = True) -> DataFrame:
    """One row for each row of ``df``: ``keys``, ``n_hyphens``, ``n_misread``, ``n_edges`` and ``repaired``.

    ``one_line`` is an SQL condition for rows that are to become one line. Null text gives null and
    zeros. Corrections are learnt from all texts of ``df``. A text none of whose words can have one, by a
    filter of fixed size, is repaired where it is read; the words of the others are joined with the
    corrections, however many there are. Other columns are not read.
    """
    spark = df.sparkSession
    source = df.select(*keys, F.col(text).cast("string").alias("__text"), F.expr(one_line or "false").alias("__line"), F.monotonically_increasing_id().alias("__row"))
    counts = stage(word_counts(source, "__text"))
    table = stage(corrections(counts))
    release(counts)
    shared = spark.sparkContext.broadcast(_filter_of(table))
    told = [T.StructField(n, T.IntegerType()) for n in ("n_hyphens", "n_misread", "n_edges")] + [T.StructField("repaired", T.StringType())] * with_text
    own, k = [df.schema[c] for c in keys], len(keys)
    waiting = [T.StructField("__row", T.LongType()), T.StructField("__line", T.BooleanType()), T.StructField("__text", T.StringType()), T.StructField("__words", T.ArrayType(T.StringType()))]
    kinds = [pa.int32()] * 3 + [pa.string()] * with_text
    cut = lambda r: (r.hyphens, r.misread, r.edges, *([r.text] * with_text))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, longest = shared.value
        may = _MayHave(bits)
        for batch in batches:
            done, wait = [], []
            for value, line, row in zip(*(c.to_pylist() for c in batch.columns[k:])):
                noise = without_noise(value) if value else None
                words = [w for w in asked_words(noise, longest) if may[w]] if noise else []
                done.append((None,) * len(kinds) if words else cut(repair(value, {}, line, noise)))
                wait.append((row, line, value, words) if words else (None,) * 4)
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)] + [pa.array(c, t) for c, t in zip(zip(*wait), (pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *columns], [f.name for f in (*own, *told, *waiting)])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut(repair(value, dict(instead or ()), line)) for line, value, instead in zip(*(c.to_pylist() for c in batch.columns[k:]))]
            columns = [pa.array(c, t) for c, t in zip(zip(*made), kinds)] if made else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *columns], [f.name for f in (*own, *told)])

    passed = stage(source.select(*keys, "__text", "__line", "__row").mapInArrow(first, T.StructType([*own, *told, *waiting])))
    rest = passed.where("__row IS NOT NULL")
    found = rest.select("__row", F.explode("__words").alias("word")).join(table.hint("merge"), "word").groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("word", "instead"))).alias("__instead"))
    late = rest.select(*keys, "__row", "__line", "__text").join(found.hint("merge"), "__row", "left").select(*keys, "__line", "__text", "__instead").mapInArrow(second, T.StructType([*own, *told]))
    return passed.where("__row IS NULL").select(*keys, *(f.name for f in told)).unionByName(late)
