"""Problem 5: records of two catalogues that share no key, matched with a confidence.

Candidate pairs come from MinHash blocks across attributes: a row of the title's MinHash with the
start or end of an author's name, bands of the title where a side has no authors, and the DOI. Years
more than one apart never meet; a name's end that many records have is blocked by the year as well,
which loses no pair. Candidates are verified natively by the words of their titles; a logistic
classifier is trained on weak labels that the data gives itself, and its scores are calibrated on
pairs it wasn't trained on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions.entries import sequel_of, skeleton
from quirelake.functions.fold import bare
from quirelake.llm.trie import osa
from quirelake.session import release, stage

#: Bands of four MinHash rows of the title where a side lacks authors; single rows with an author's name and with a DOI.
BANDS, ROWS, SINGLES, DOI_ROWS = 12, 4, 4, 3
#: Letters at the start and at the end of a name that make a block: one edit leaves one of them whole in a long name.
HEAD, TAIL = 5, 6
#: Ends of names that more records have are blocked by the year too.
FREQUENT = 5000
#: Words with which a title can tell a work by itself; shorter ones of records without authors meet by their DOI only.
TELLING = 4
#: Share of common title words from which a candidate pair is compared further; titles of fewer than TELLING words are in any case.
VERIFIED = 0.2
#: Records of both sides whose blocks are joined at once, and parts that all blocks are divided into at most: only one part's shuffles are on disk at a time.
PART_RECORDS, PARTS = 50_000, 16
#: A title's sketch is a number: of its low bits each distinct word sets one, the bits above are the number of words, which all larger ones share.
_SKETCH_BITS, _SKETCH_WORDS = 56, 127
#: Pairs that the classifier is trained on at most: the first by a hash of both ids.
SAMPLE = 20_000
CONFIDENT = 0.3

_WORD = re.compile(r"[^\W_]+")
_DOI = re.compile(r"1[0o]\.\d{4,9}/\S+", re.IGNORECASE)
_PRIME = np.uint64((1 << 61) - 1)
_rng = np.random.RandomState(20)
_A = _rng.randint(1, 1 << 31, BANDS * ROWS).astype(np.uint64)
_B = _rng.randint(0, 1 << 31, BANDS * ROWS).astype(np.uint64)
# Short words without which titles compare.
_STOP = frozenset("the and for with from under via into over this that its are was were des der die das und les del der".split())


class Record(NamedTuple):
    tokens: list[str]
    sequel: str
    year: int | None
    doi: str | None
    authors: list[str]
    venue: list[str]
    ends: list[str]


def doi_form(text: str | None) -> str | None:
    """A DOI in lower case without resolver, prefix and closing punctuation; null where there is none."""
    m = _DOI.search(text or "")
    return "10" + m.group().lower()[2:].rstrip(".,;:)]}>'\"") if m else None


_skeleton = lru_cache(1 << 16)(skeleton)
_bare = lru_cache(1 << 16)(bare)


def title_tokens(title: str | None) -> tuple[list[str], str]:
    """The distinct skeleton words (three letters or more) of a title, and its sequel signs."""
    low = bare(title) or ""
    lead = low.lstrip("\"'“( ")
    sequel = sequel_of(lead if lead.startswith("further") else low.replace("further", " "))
    signs = {"further", "part", "ii", "iii", "iv", *sequel.split()}
    every = _WORD.findall(low)
    found = {_skeleton(w) for w in every if len(w) >= 3 and w not in _STOP and w not in signs}
    return sorted(found or {_skeleton(w) for w in every}), sequel


def author_words(authors) -> list[str]:
    """For each author the words of three letters or more of all fields in one string, accents and case folded."""
    out = []
    for a in authors or ():
        if a:
            out.append(" ".join(w for w in _WORD.findall(_bare(f"{a.get('family') or ''} {a.get('given') or ''}")) if len(w) >= 3))
    return [a for a in out if a]


def record(title: str | None, authors, year: int | None, doi: str | None, venue: str | None) -> Record:
    """A record in comparable form; ``ends`` are the starts and ends of all words of its authors' names.

    Every word counts: which one is the longest changes with what is shortened, left out or put first.
    """
    tokens, sequel = title_tokens(title)
    names = author_words(authors)
    words = {w for a in names for w in a.split()}
    ends = {w[:HEAD] + "-" for w in words} | {"-" + w[-TAIL:] for w in words if len(w) > TAIL}
    return Record(tokens, sequel, year, doi_form(doi), names, sorted({w[:3] for w in _WORD.findall(_bare(venue) or "") if len(w) > 2 and w not in _STOP}), sorted(ends))


@lru_cache(1 << 16)
def _hash32(text: str) -> int:
    return xxhash.xxh32_intdigest(text) - (1 << 31)


@lru_cache(1 << 16)
def _seed(token: str) -> int:
    return xxhash.xxh32_intdigest(token)


def signatures(words: np.ndarray, starts: np.ndarray, bands: tuple[int, ...] = ()) -> np.ndarray:
    """MinHash rows of lists of hashed words, none empty, that begin at ``starts``: the single rows, or a hash for each of the ``bands``."""
    h = (words.astype(np.int64) + (1 << 31)).astype(np.uint64)
    at = [i * ROWS + r for i in bands for r in range(ROWS)] or list(range(SINGLES))
    rows = np.minimum.reduceat((h[:, None] * _A[at] + _B[at]) % _PRIME, starts)
    if not bands:
        return rows.astype(np.int64)
    made = np.zeros((len(starts), len(bands)), np.uint64)
    for r in range(ROWS):
        made = made * np.uint64(0x9E3779B97F4A7C15) + rows[:, r::ROWS]
    return made.view(np.int64)


def _sketch(words: list[int]) -> int:
    bits = 0
    for w in words:
        bits |= 1 << w % _SKETCH_BITS
    return bits | min(len(words), _SKETCH_WORDS) << _SKETCH_BITS


def may_share(a: Column, b: Column) -> Column:
    """Whether titles with these sketches may have the words in common that :func:`verified` asks for; never false where they have.

    A bit that only one of them has stands for a word at least that the other lacks.
    """
    bits = lambda x: F.bit_count(x.bitwiseAND(F.lit((1 << _SKETCH_BITS) - 1)))
    n = lambda x: F.shiftrightunsigned(x, _SKETCH_BITS)
    most = F.least(n(a) - bits(a), n(b) - bits(b)) + bits(a.bitwiseAND(b))
    return (most >= VERIFIED * (n(a) + n(b) - most)) | (F.least(n(a), n(b)) < TELLING) | (F.greatest(n(a), n(b)) == _SKETCH_WORDS)


def verified(a: Column, b: Column) -> Column:
    """Whether titles with these words are compared further."""
    shared = F.size(F.array_intersect(a, b))
    return (shared >= VERIFIED * (F.size(a) + F.size(b) - shared)) | (F.least(F.size(a), F.size(b)) < TELLING)


_FIELDS = {
    "id": ("bigint", pa.int64()), "form": ("bigint", pa.int64()), "words": ("array<int>", pa.list_(pa.int32())), "text": ("string", pa.string()), "sequel": ("string", pa.string()), "year": ("int", pa.int32()), "doi": ("string", pa.string()),
    "authors": ("array<string>", pa.list_(pa.string())), "venue": ("array<string>", pa.list_(pa.string())), "ends": ("array<int>", pa.list_(pa.int32())), "rows": ("array<bigint>", pa.list_(pa.int64())), "sketch": ("bigint", pa.int64()),
}


def prepare(df: DataFrame, key: str) -> DataFrame:
    """The records of ``df`` (``key``, ``title``, ``authors``, ``year``, ``doi``, ``container_title``) in comparable form, by a map without shuffle.

    ``form`` is equal for records that compare alike; ``text`` has the title's words. Records without a title have no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, *columns = (c.to_pylist() for c in batch.columns)
            made = [record(*values) for values in zip(*columns)]
            titled = [i for i, r in enumerate(made) if r.tokens]
            words = [[_hash32(t) for t in r.tokens] for r in made]
            rows: list[list[int] | None] = [None] * len(made)
            if titled:
                sizes = [len(words[i]) for i in titled]
                flat = np.fromiter((w for i in titled for w in words[i]), np.int64, sum(sizes))
                for i, row in zip(titled, signatures(flat, np.r_[0, np.cumsum(sizes)[:-1]]).tolist()):
                    rows[i] = row
            form = [xxhash.xxh64_intdigest(repr(r)) - (1 << 63) for r in made]
            values = [ids, form, words, [" " + " ".join(r.tokens) + " " for r in made]]
            values += [[getattr(r, n) for r in made] for n in ("sequel", "year", "doi", "authors", "venue")] + [[[_hash32(e) for e in r.ends] for r in made], rows, [_sketch(w) for w in words]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(values, _FIELDS.values())], list(_FIELDS))

    chosen = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), "title", "authors", F.col("year").cast("int"), "doi", "container_title")
    return chosen.mapInArrow(run, ", ".join(f"{n} {k}" for n, (k, _) in _FIELDS.items()))


def _near_years(pairs: DataFrame) -> DataFrame:
    return pairs.where("ya IS NULL OR yb IS NULL OR abs(ya - yb) <= 1")


def _banded(records: DataFrame, bands: tuple[int, ...]) -> DataFrame:
    """``f``, ``y``, ``sketch``, ``i`` and ``band`` of ``records`` (``f``, ``y``, ``sketch``, ``words``) for these bands of their titles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            ends = column.offsets.to_numpy()
            if len(ends) < 2:
                continue
            made = signatures(column.values.to_numpy()[ends[0] : ends[-1]], (ends - ends[0])[:-1], bands)
            repeated = pa.array(np.repeat(np.arange(len(batch)), len(bands)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(repeated) for k in range(3)), pa.array(np.tile(np.array(bands, np.int32), len(batch))), pa.array(made.reshape(-1))], ["f", "y", "sketch", "i", "band"])

    return records.select("f", "y", "sketch", "words").mapInArrow(run, "f bigint, y int, sketch bigint, i int, band bigint")


def blocked_pairs(a: DataFrame, b: DataFrame, parts: int = 1) -> Iterator[DataFrame]:
    """The pairs of :func:`candidate_pairs`, repeats included, in ``parts`` of the blocks, with the sketches ``sa`` and ``sb`` of their titles."""
    sides = {s: df.select(F.col("form").alias("f"), F.col("year").alias("y"), "words", "rows", "ends", "doi", "sketch").where("rows IS NOT NULL") for s, df in (("a", a), ("b", b))}
    named = lambda s: sides[s].select(F.explode("ends").alias("end"))
    frequent = stage(named("a").union(named("b")).groupBy("end").agg(F.count("*").alias("n")).where(f"n > {FREQUENT}").select("end", F.lit(True).alias("often")))

    def filed(s: str, other: str, part: int) -> DataFrame:
        dated = F.expr(f"array(y DIV 2 * 4, (y + 1) DIV 2 * 4 + 1, {'2L' if other == 'a' else '3L'})")
        marks = F.when(F.col("often").isNull(), F.expr("array(-1L)")).when(F.col("y").isNull(), F.expr("array(2L, 3L)")).otherwise(dated)
        own = sides[s].select("f", "y", "sketch", "rows", F.explode(F.filter("ends", lambda e: F.pmod(e, F.lit(parts)) == part)).alias("end"))
        rows = own.join(frequent, "end", "left").select("f", "y", "sketch", "end", F.explode(marks).alias("mark"), "rows")
        return rows.select("f", "y", "sketch", "end", "mark", F.posexplode("rows").alias("i", "row")).select("f", "y", "sketch", F.xxhash64("end", "mark", "i", "row").alias("key"))

    def numbered(s: str) -> DataFrame:
        return sides[s].where("doi IS NOT NULL").select("f", "y", "sketch", "doi", F.posexplode(F.slice("rows", 1, DOI_ROWS)).alias("i", "row"))

    def pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        of = lambda df, s: df.select(*on, F.col("f").alias(f"f{s}"), F.col("y").alias(f"y{s}"), F.col("sketch").alias(f"s{s}"))
        return _near_years(of(left, "a").join(of(right, "b"), on)).select("fa", "fb", "sa", "sb")

    for part in range(parts):
        made = [pairs(filed("a", "b", part), filed("b", "a", part), ["key"])]
        if bands := tuple(i for i in range(BANDS) if i % parts == part):
            telling = {s: df.where(f"size(words) >= {TELLING}") for s, df in sides.items()}
            nameless, every = ({s: _banded(df.where(c), bands) for s, df in telling.items()} for c in ("size(ends) = 0", "true"))
            made += [pairs(nameless["a"], every["b"], ["i", "band"]), pairs(every["a"], nameless["b"], ["i", "band"])]
        if part == 0:
            made.append(pairs(numbered("a"), numbered("b"), ["doi", "i", "row"]))
        yield reduce(DataFrame.union, made)


def candidate_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs ``fa`` and ``fb`` of classes that share a block and whose years are at most one apart (or missing).

    Classes that have authors meet by a MinHash row of the title and the start or end of a word of an author's name. Where more than
    ``FREQUENT`` classes share that end, the year is part of the block: each year belongs to two pairs
    of years, so that neighbours share one, and classes without a year have blocks of their own, which
    all of the other side are filed in. Classes without authors meet all others by bands of the title;
    equal DOIs meet with a row of the title.
    """
    return reduce(DataFrame.union, (p.select("fa", "fb") for p in blocked_pairs(a, b))).distinct()


FEATURES = ("title_jaccard", "title_contained", "title_words", "trigrams", "same_sequel", "year_gap", "year_missing", "author_share", "authors_missing", "doi_same", "doi_other", "venue_share")


def _author_share(left: list[str], right: list[str]) -> float:
    """The share of the shorter list's authors that have a word in the other list, up to one edit."""
    if len(left) > len(right):
        left, right = right, left
    others = {w for a in right for w in a.split()}
    hits = 0
    for a in left:
        words = sorted(a.split(), key=len, reverse=True)[:3]
        long = [w for w in words if len(w) >= 5] or words
        if any(w in others for w in long[:2]) or any(abs(len(w) - len(o)) < 2 and len(w) > 5 and (w[:3] == o[:3] or w[-3:] == o[-3:]) and osa(w, o) <= 1 for w in long[:1] for o in others):
            hits += 1
    return hits / len(left)


def pair_columns() -> list[Column]:
    """The values of :data:`FEATURES` for a row with two prepared classes ``a`` and ``b``, all but the authors' share native."""
    a, b = (lambda n: F.col(f"a.{n}")), (lambda n: F.col(f"b.{n}"))
    both = lambda n: F.size(F.array_intersect(a(n), b(n)))
    size = lambda n: (F.size(a(n)), F.size(b(n)))
    years, dois = a("year").isNotNull() & b("year").isNotNull(), a("doi").isNotNull() & b("doi").isNotNull()
    names = (F.size(a("authors")) > 0) & (F.size(b("authors")) > 0)
    venues = (F.size(a("venue")) > 0) & (F.size(b("venue")) > 0)
    of = lambda c: F.when(c, 1.0).otherwise(0.0)
    return [
        both("words") / F.greatest(F.lit(1), sum(size("words"), F.lit(0)) - both("words")),
        both("words") / F.greatest(F.lit(1), F.least(*size("words"))),
        F.least(*size("words"), F.lit(8)) / 8,
        _trigrams(a("text"), b("text")),
        of(F.coalesce(a("sequel"), F.lit("")) == F.coalesce(b("sequel"), F.lit(""))),
        F.when(years, F.least(F.lit(3.0), F.abs(a("year") - b("year")).cast("double"))).otherwise(0.0),
        of(~years),
        F.when(names, author_share(a("authors"), b("authors"))).otherwise(0.0),
        of(~names),
        of(dois & (a("doi") == b("doi"))),
        of(dois & (a("doi") != b("doi"))),
        F.when(venues, both("venue") / F.greatest(F.lit(1), F.least(*size("venue")))).otherwise(0.5),
    ]


def _trigrams(left: Column, right: Column) -> Column:
    """The share of distinct trigrams that two texts have in common."""
    grams = lambda x: F.when(F.length(x) < 3, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - 2), lambda i: F.substring(x, i, F.lit(3)))))
    share = lambda g: 2 * F.size(F.array_intersect(g["a"], g["b"])) / F.greatest(F.lit(1), F.size(g["a"]) + F.size(g["b"]))
    # an array of one, so that both sides' trigrams are made once
    return F.get(F.transform(F.array(F.struct(grams(left).alias("a"), grams(right).alias("b"))), share), F.lit(0))


def author_share(left: Column, right: Column) -> Column:
    """:func:`_author_share` as an Arrow column function."""

    def over(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_author_share(list(x), list(y)) if x is not None and y is not None and len(x) and len(y) else 0.0 for x, y in zip(left, right)], dtype=float)

    over.__annotations__ = {"left": pd.Series, "right": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, "double")(left, right)


#: Share of eight words that a title needs to tell a work by itself: five, more than stock titles
#: have; and what is left of a title without its second part, where authors agree: four.
DISTINCTIVE, SHORTENED = 5 / 8, 4 / 8


def weak_label(f: np.ndarray) -> np.ndarray:
    """1 where several attributes agree, 0 where one rules the pair out, -1 where neither is plain."""
    v = dict(zip(FEATURES, f.T))
    likely = (v["title_jaccard"] >= 0.7) & (v["author_share"] >= 0.5) & (v["year_gap"] <= 1)
    likely |= (v["title_contained"] >= 0.99) & (v["title_words"] >= SHORTENED) & (v["author_share"] >= 0.6) & (v["year_gap"] <= 1)
    likely |= (v["authors_missing"] == 1) & (v["title_words"] >= DISTINCTIVE) & ((v["title_jaccard"] >= 0.7) | (v["trigrams"] >= 0.9)) & (v["year_missing"] == 0)
    sure = (v["doi_same"] == 1) & (v["title_jaccard"] >= 0.5) & (v["author_share"] > 0)
    against = (v["same_sequel"] == 0) | (v["year_gap"] > 1) | (v["title_jaccard"] < 0.34) & (v["trigrams"] < 0.5) | (v["authors_missing"] == 0) & (v["author_share"] == 0)
    against |= (v["authors_missing"] == 1) & (v["title_words"] < DISTINCTIVE) & (v["doi_same"] == 0)
    return np.where(against, 0, np.where(likely | sure, 1, -1))


class Classifier(NamedTuple):
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    offset: float

    def confidence(self, f: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of a match."""
        z = np.c_[(f - self.mean) / self.scale, np.ones(len(f))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30)))

    def column(self, f: Column) -> Column:
        """:meth:`confidence` of an array of features, natively."""
        z = F.lit(float(self.weights[-1]))
        for i in range(len(FEATURES)):
            z = z + (F.get(f, F.lit(i)) - float(self.mean[i])) / float(self.scale[i]) * float(self.weights[i])
        z = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), float(self.slope) * z + float(self.offset)))
        return 1 / (1 + F.exp(-z))


def admissible(f: Column) -> Column:
    """The exact check after the classifier: what one work may not have by definition, other signs of a sequel, years more than one apart, or wholly other authors."""
    v = {n: F.get(f, F.lit(i)) for i, n in enumerate(FEATURES)}
    return (v["same_sequel"] == 1) & (v["year_gap"] <= 1) & ~((v["authors_missing"] == 0) & (v["author_share"] == 0))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 400) -> np.ndarray:
    w, step = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = 0.9 * step - 0.3 * (x.T @ (p - y) / len(y) + ridge * w)
        w = w + step
    return w


def fit(f: np.ndarray) -> Classifier:
    """The classifier of weakly labelled pairs: weights from two thirds, calibration (Platt's) from the rest.

    Without pairs of both labels it falls back on fixed weights for title, authors and year.
    """
    y = weak_label(f) if len(f) else np.empty(0)
    f, y = f[y >= 0] if len(f) else f, y[y >= 0]
    if len(set(y.tolist())) < 2 or len(y) < 30:
        weights = np.zeros(len(FEATURES) + 1)
        for name, value in (("title_jaccard", 8), ("author_share", 4), ("authors_missing", 2), ("year_gap", -1), ("doi_same", 3)):
            weights[FEATURES.index(name)] = value
        weights[-1] = -7
        return Classifier(weights, np.zeros(len(FEATURES)), np.ones(len(FEATURES)), 1.0, 0.0)
    mean, scale = f.mean(0), f.std(0) + 1e-3
    x = np.c_[(f - mean) / scale, np.ones(len(f))]
    held = np.arange(len(f)) % 3 == 0
    w = _logistic(x[~held], y[~held], 1e-3)
    z = np.c_[x[held] @ w, np.ones(held.sum())]
    # the targets of Platt's method, which keep the slope finite
    plus, minus = y[held].sum(), (1 - y[held]).sum()
    slope, offset = _logistic(z, np.where(y[held] == 1, (plus + 1) / (plus + 2), 1 / (minus + 2)), 0.0)
    return Classifier(w, mean, scale, float(slope), float(offset))


def match_records(left: DataFrame, right: DataFrame, keys: tuple[str, str], least: float = CONFIDENT, sample: int = SAMPLE) -> DataFrame:
    """Pairs of the two tables' keys (in this order) that describe the same work, with ``confidence``.

    Both have ``title``, ``authors`` (array of ``family`` and ``given``), ``year``, ``doi`` and
    ``container_title``; any may be null, other columns are not read. Records that compare alike are
    one class: classes are compared, and a pair of matched classes stands for all its members.
    Records without a title match nothing. The keys must be unique; rows with a null key are left out.
    """
    told = [n for n in _FIELDS if n not in ("id", "form")]

    def classes(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        every = stage(prepare(df, key))
        one = stage(every.groupBy("form").agg(F.first(F.struct(*told)).alias("r")).select("form", "r.*"))
        ids = stage(every.select("form", "id"))
        release(every)
        return one, ids

    (ca, a), (cb, b) = classes(left, keys[0]), classes(right, keys[1])
    parts = max(1, min(PARTS, -(-(ca.count() + cb.count()) // PART_RECORDS)))
    met = []
    for pairs in blocked_pairs(ca, cb, parts):
        pairs = pairs.where(may_share(F.col("sa"), F.col("sb"))).select("fa", "fb").repartition("fa").distinct()
        pairs = pairs.join(ca.select(F.col("form").alias("fa"), F.col("words").alias("wa")), "fa").join(cb.select(F.col("form").alias("fb"), F.col("words").alias("wb")), "fb")
        met.append(stage(pairs.where(verified(F.col("wa"), F.col("wb"))).select("fa", "fb")))
    pairs = reduce(DataFrame.union, met).distinct()
    compared = ["words", "text", "sequel", "year", "doi", "authors", "venue"]
    records = pairs.join(cb.select(F.col("form").alias("fb"), F.struct(*compared).alias("b")), "fb").join(ca.select(F.col("form").alias("fa"), F.struct(*compared).alias("a")), "fa")
    featured = stage(records.select("fa", "fb", F.array(*pair_columns()).alias("f")))
    release(ca, cb, *met)
    chosen = featured.orderBy(F.xxhash64("fa", "fb"), "fa", "fb").limit(sample).select("f").collect()
    model = fit(np.array([r.f for r in chosen], float).reshape(-1, len(FEATURES)))
    kept = featured.where(admissible(F.col("f"))).select("fa", "fb", model.column(F.col("f")).alias("confidence")).where(F.col("confidence") >= least)
    of_a, of_b = a.select(F.col("form").alias("fa"), F.col("id").alias(keys[0])), b.select(F.col("form").alias("fb"), F.col("id").alias(keys[1]))
    return kept.join(of_a, "fa").join(of_b, "fb").select(*keys, F.round("confidence", 4).alias("confidence"))
