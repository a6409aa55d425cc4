"""Problem 4: spellings of one person or organisation linked by a trie join.

Spellings are read into a family name and a given name (or an organisation's place and the initials
of its words). Distinct family names are sharded into tries by halves that names within one edit must
share; each shard's trie is searched with a Levenshtein automaton. A rare name is linked to its
frequent neighbour, never along a chain. Then every token order of a spelling is checked: it is read
in the order in which most other rows name the same person. Within a family, initials, full given
names and familiar forms tell people apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions.fold import bare, same_look
from quirelake.llm.trie import Trie
from quirelake.llm.components import components
from quirelake.session import stage

# Particles of family names, words within organisations' names, and kinds of organisations.
PARTICLES = frozenset("van von de der den di da du del della dos la le el al bin ibn ten ter zu zur af av".split())
LINKING = frozenset("for of the and in on at de des der du für et".split())
KINDS = ("institut", "inst", "center", "centre", "ctr", "department", "dept", "laborator", "lab", "committee", "comm", "society", "soc", "universit", "univ", "school", "college", "academy", "acad", "agency", "bureau", "office", "association", "assoc", "council", "consortium", "group", "foundation", "ministry", "hospital", "library", "museum", "project", "team")
#: A task holds a trie of so many names at most, and asks it so many queries; larger shards are split both ways.
SHARD_NAMES, SHARD_QUERIES = 50_000, 20_000
#: Shortest name that may differ by an edit: of three letters, one edit makes any other.
LEAST_LETTERS = 4
#: So many times the rows of a name its frequent neighbour has, whoever bears it; with the same initial more rows than it are enough.
SUPPORT = 5

_PART = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*\.?")


class Reading(NamedTuple):
    """A family name (of a double one the first part, ``tail`` being the rest) or a place, the full given name, its initial, and an organisation's keys."""

    kind: str
    family: str
    given: str
    initial: str
    keys: list[str]
    tail: str = ""


def words(text: str | None) -> list[str]:
    """The words of a name field in their common look, case and a final full stop kept; hyphenated names whole."""
    return _PART.findall(same_look(text) or "")


def is_organisation(family: str | None, given: str | None) -> bool:
    """Whether a name is an organisation's: no given name, and a kind of organisation or an acronym before a word."""
    if given:
        return False
    found = [w for w in words(family)]
    low = [bare(w).rstrip(".") for w in found]
    if any(w.startswith(KINDS) and len(w) >= 3 for w in low) and (len(found) >= 3 or any(w in LINKING for w in low)):
        return True
    if len(found) >= 4 and "for" in low:
        return True
    return len(found) == 2 and found[0].isupper() and len(found[0]) == 3 and found[0].isalpha() and "," not in (family or "") and not (found[1].isupper() and len(found[1]) > 3)


def read_organisation(family: str) -> Reading:
    """Place and initials of an organisation; its keys are the place with every pair of initials."""
    text = same_look(family) or ""
    found = words(text)
    low = [bare(w).rstrip(".") for w in found]
    inside = re.search(r"\(([^()]+)\)", text)
    place = None
    if inside:
        place = bare((words(inside.group(1)) or [""])[-1])
    elif "," in text and len(words(text.rpartition(",")[2])) == 1:
        place = bare(words(text.rpartition(",")[2])[0])
    elif len(low) > 2 and low[-2] == "of":
        place = low[-1]
    elif len(found) == 2 and found[0].isupper():
        place = low[1]
    elif low:
        place = low[0]
    rest = list(low)
    if place in rest:
        rest.reverse()
        rest.remove(place)
        rest.reverse()
    short = len(found) == 2 and found[0].isupper() and len(rest) == 1
    letters = sorted(rest[0]) if short else sorted(w[0] for w in rest if w and w not in LINKING)
    keys = sorted({a + b for a, b in combinations(letters, 2)}) or ["".join(letters)]
    return Reading("o", place or "", "", "".join(letters), keys)


def _looks(word: str, known: dict[str, tuple[int, int, int]]) -> int:
    """Above 0: a family name; below: a given name; 0: not known."""
    f, g, _ = known.get(bare(word).rstrip("."), (0, 0, 0))
    return (f > 2 * g and f > 1) - (g > f)


def _is_initials(word: str) -> bool:
    plain = word.rstrip(".")
    return len(plain) == 1 or len(plain) == 2 and plain.isupper()


def _small(text: str | None) -> bool:
    """Whether a name has a longer word that isn't in capitals, so that two capitals beside it are initials."""
    return any(len(w) > 2 and not w.isupper() for w in words(text))


def _is_particle(word: str, mixed: bool) -> bool:
    return bare(word) in PARTICLES and not (mixed and len(word) == 2 and word.isupper())


def read_name(family: str | None, given: str | None, known: dict[str, tuple[int, int, int]]) -> Reading:
    """A name read whatever its order; ``known`` tells of its words how often each is a family and a given
    name and after how many names it stands behind a hyphen."""
    if is_organisation(family, given):
        return read_organisation(family)
    text = same_look(family) or ""
    if not given and "," in text:
        text, _, given = text.partition(",")
    mixed = _small(family) or _small(given)
    first = [w for w in words(text) if not _is_particle(w, mixed)]
    second = [w for w in words(given) if not _is_particle(w, mixed)]
    long_first = [w for w in first if not _is_initials(w)]
    long_second = [w for w in second if not _is_initials(w)]
    if not second:
        # one field holds all: the family name is the word that is known as one, else the one in capitals, else the longest
        def rank(w: str) -> tuple:
            return (_looks(w, known), "-" in w, w.isupper() and len(w) > 2 and not all(x.isupper() for x in long_first), len(w))

        pick = max(long_first, key=rank, default=None)
        if pick is None:
            return Reading("p", bare("".join(first)), "", "", [])
        at = first.index(pick)
        chosen, others = [pick], first[:at] + first[at + 1 :]
        if at + 1 < len(first) and known.get(bare(first[at + 1]), (0, 0, 0))[2] > 4 and not _is_initials(first[at + 1]):
            chosen.append(first[at + 1])
            others = first[:at] + first[at + 2 :]
        first, second = chosen, others
    elif long_second:
        a = max((_looks(w, known) for w in long_first), default=-1 if not long_first else 0)
        b = max((_looks(w, known) for w in long_second), default=0)
        if b > a:
            first, second = [w for w in second if not _is_initials(w)], [w for w in second if _is_initials(w)] + first
    elif not long_first:
        return Reading("p", bare("".join(first)), "", bare(second[0])[:1] if second else "", [])
    # initials within the family field belong to the given name
    second = second + [w for w in first if _is_initials(w)] if any(not _is_initials(w) for w in first) else second
    first = [w for w in first if not _is_initials(w)] or first
    name, _, tail = "-".join(bare(w).rstrip(".") for w in first).replace("'", "").replace("’", "").partition("-")
    full = [w for w in second if not _is_initials(w)]
    lead = bare(second[0]) if second else ""
    if full and second and _is_initials(second[0]) and second.index(full[0]) > 0 and len(second) > 1 and family and given and bare(full[0])[:1] != lead[:1]:
        lead = bare(full[0]) if _looks(full[0], known) < 0 else lead
    word = bare(full[0]) if full and not full[0].endswith(".") else ""
    return Reading("p", name, word.rstrip("."), lead[:1], [], tail)


def readings(family: str | None, given: str | None, known: dict[str, tuple[int, int, int]]) -> list[Reading]:
    """A name in every token order: as :func:`read_name` reads it first, then with each other full word as the family name.

    A word that is known as a given name is no family name beside one that isn't: given names are few, so the rows that
    seem to have one for a family name grow with the table, and would outnumber the rows of any person.
    """
    first = read_name(family, given, known)
    if first.kind == "o":
        return [first]
    out = [first]
    mixed = _small(family) or _small(given)
    every = [w for field in (family, given) for w in words(field) if not _is_particle(w, mixed)]
    plain = lambda w: bare(w).rstrip(".").replace("'", "").replace("’", "")
    looks = _looks(first.family, known)
    for i, w in enumerate(every):
        if _is_initials(w) or w.endswith(".") or _looks(w, known) < 0 <= looks:
            continue
        name, _, tail = plain(w).partition("-")
        rest = every[:i] + every[i + 1 :]
        if rest and len(name) >= LEAST_LETTERS and all(name != r.family for r in out):
            full = next((plain(o) for o in rest if not _is_initials(o) and not o.endswith(".")), "")
            out.append(Reading("p", name, full, plain(rest[0])[:1], [], tail))
    return out


def _halves(name: str, length: int) -> tuple[str, str]:
    """What the halves of a name of ``length`` letters are where ``name`` differs from it in the other half only."""
    return name[: length // 2], name[len(name) - (length - length // 2) :]


def _shards(kind: str, name: str) -> tuple[list[str], list[str]]:
    """The shards that a name is filed in, and those it asks for names of its own length or one letter less.

    One edit leaves a half whole; a transposition across the middle leaves the halves of the name with
    these letters put back.
    """
    n, m = len(name), len(name) // 2
    mark = lambda length, i, half: f"{kind}{length}|{i}|{half}"
    filed = [mark(n, i, h) for i, h in enumerate(_halves(name, n))]
    back = name[: m - 1] + name[m] + name[m - 1] + name[m + 1 :] if m else name
    return filed, [*filed, mark(n, 0, back[:m]), *(mark(n - 1, i, h) for i, h in enumerate(_halves(name, n - 1)))]


def trie_join(names: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of the distinct strings of ``name`` of one ``kind`` that are one edit apart (a transposition being one), with ``kind``.

    A shard, the names filed under one half, is a trie; the names that could have that half are its
    queries. Both are split over tasks where there are many. Names of fewer than ``LEAST_LETTERS``
    letters are left out; no name of any shard is.
    """
    schema = "kind string, shard string, role int, name string"

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, shards, roles, texts = [], [], [], []
            for kind, name in zip(*(c.to_pylist() for c in batch.columns)):
                filed, asked = _shards(kind, name)
                every = [(s, 0) for s in filed] + [(s, 1) for s in sorted(set(asked))]
                kinds += [kind] * len(every)
                shards += [s for s, _ in every]
                roles += [r for _, r in every]
                texts += [name] * len(every)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(shards, pa.string()), pa.array(roles, pa.int32()), pa.array(texts, pa.string())], ["kind", "shard", "role", "name"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie = None, Trie()
        for batch in batches:
            kinds, left, right = [], [], []
            for kind, shard, role, name in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    now, trie = shard, Trie()
                if role == 0:
                    trie.add(name)
                    continue
                for other, d in trie.near(name, 1):
                    if d == 1:
                        kinds.append(kind)
                        left.append(min(name, other))
                        right.append(max(name, other))
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string())], ["kind", "a", "b"])

    filed = names.select("kind", "name").where(f"length(name) >= {LEAST_LETTERS}").distinct().mapInArrow(file, schema)
    filed = stage(filed)
    load = filed.groupBy("shard").agg(F.sum("role").alias("queries"), F.sum(1 - F.col("role")).alias("filed")).where("queries > 0 AND filed > 0 AND NOT (queries = 1 AND filed = 1)")
    load = load.select("shard", F.ceil(F.col("filed") / SHARD_NAMES).cast("int").alias("tries"), F.ceil(F.col("queries") / SHARD_QUERIES).cast("int").alias("parts"))
    own = lambda n: F.array(F.pmod(F.xxhash64("name"), F.col(n).cast("bigint")).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spread = filed.join(load, "shard").withColumn("t", F.explode(F.when(F.col("role") == 0, own("tries")).otherwise(every("tries")))).withColumn("q", F.explode(F.when(F.col("role") == 1, own("parts")).otherwise(every("parts"))))
    spread = spread.select("kind", F.concat_ws("|", "shard", F.col("t").cast("string"), F.col("q").cast("string")).alias("shard"), "role", "name")
    # as many tasks as the session shuffles to: the bytes are few but the search is costly, so they aren't joined again
    tasks = max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), names.sparkSession.sparkContext.defaultParallelism)
    return spread.repartition(tasks, "shard").sortWithinPartitions("shard", "role").mapInArrow(search, "kind string, a string, b string").distinct()


def canonical_names(bearers: DataFrame) -> DataFrame:
    """``kind``, ``name`` and ``fam``, the name that a rare one is read as, for those that have one.

    ``bearers`` has ``kind``, ``name``, ``initial`` and ``n`` (rows). A neighbour by one edit takes a
    name over when it has ``SUPPORT`` times its rows, or when it has more of the rows with the
    same initial (of equals, the first by spelling). Only names that nothing takes over take others: links are one step long. A
    name whose takers are all taken over themselves stays.
    """
    bearers = stage(bearers)
    total = bearers.groupBy("kind", "name").agg(F.sum("n").alias("n"))
    pairs = stage(trie_join(total.select("kind", "name")))
    both = pairs.unionByName(pairs.select("kind", F.col("b").alias("a"), F.col("a").alias("b")))
    weighed = both.join(total.select("kind", F.col("name").alias("a"), F.col("n").alias("na")), ["kind", "a"]).join(total.select("kind", F.col("name").alias("b"), F.col("n").alias("nb")), ["kind", "b"])
    own = bearers.where("initial <> ''")
    alike = pairs.join(own.select("kind", F.col("name").alias("a"), "initial", F.col("n").alias("x")), ["kind", "a"]).join(own.select("kind", F.col("name").alias("b"), "initial", F.col("n").alias("y")), ["kind", "b", "initial"])
    alike = alike.groupBy("kind", "a", "b").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    alike = alike.unionByName(alike.select("kind", F.col("b").alias("a"), F.col("a").alias("b"), F.col("y").alias("x"), F.col("x").alias("y")))
    takes = weighed.join(alike, ["kind", "a", "b"], "left").where(f"nb >= {SUPPORT} * na OR (x IS NOT NULL AND (nb > na OR (nb = na AND b < a)))")
    takes = stage(takes.select("kind", F.col("a").alias("name"), F.col("b").alias("taker"), "nb"))
    free = takes.join(takes.select("kind", F.col("name").alias("taker")).distinct(), ["kind", "taker"], "left_anti")
    return free.groupBy("kind", "name").agg(F.max_by("taker", F.struct("nb", "taker")).alias("fam"))


def _vocabulary(forms: DataFrame) -> DataFrame:
    """``word`` with ``f``, ``g`` and ``s``: how many rows have it as a family name, as a full given name, and how many names it follows after a hyphen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int, str | None]] = []
            for family, given, n in zip(*(c.to_pylist() for c in batch.columns)):
                if not given or is_organisation(family, given):
                    continue
                for w in words(family):
                    if not _is_initials(w) and bare(w) not in PARTICLES:
                        out.append((bare(w).rstrip("."), n, 0, None))
                        head, hyphen, tail = bare(w).rpartition("-")
                        if hyphen:
                            out.append((tail, 0, 0, head))
                for w in words(given):
                    if not _is_initials(w) and not w.endswith(".") and bare(w) not in PARTICLES:
                        out.append((bare(w), 0, n, None))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "f", "g", "head"])

    seen = forms.select("family", "given", "n").mapInArrow(run, "word string, f bigint, g bigint, head string")
    return seen.groupBy("word").agg(F.sum("f").alias("f"), F.sum("g").alias("g"), F.countDistinct("head").alias("s"))


def read_names(forms: DataFrame) -> DataFrame:
    """``form`` with ``order`` (0: as it is read, then its other token orders), ``kind``, ``name``, ``word``, ``initial``, ``keys`` and ``tail`` of each distinct spelling (``form``, ``family``, ``given``, ``n``)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for form, family, given in zip(*(c.to_pylist() for c in batch.columns)):
                own = {bare(w).rstrip(".") for field in (family, given) for w in words(field)}
                own |= {part for w in own for part in w.split("-")}
                ids += [form] * len(own)
                found += sorted(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["form", "word"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for form, f, g, m in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(form, i, *r) for i, r in enumerate(readings(f, g, {k: (x["f"], x["g"], x["s"]) for k, x in (m or ())})) if r.family]
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["form", "order", "kind", "name", "word", "initial", "keys", "tail"])

    vocabulary = _vocabulary(forms)
    tokens = forms.select("form", "family", "given").mapInArrow(split, "form bigint, word string")
    known = tokens.join(vocabulary, "word").groupBy("form").agg(F.map_from_entries(F.collect_list(F.struct("word", F.struct("f", "g", "s")))).alias("known"))
    return forms.join(known, "form", "left").select("form", "family", "given", "known").mapInArrow(read, "form bigint, order int, kind string, name string, word string, initial string, keys array<string>, tail string")


def _given_initials(aliases: DataFrame, people: DataFrame) -> DataFrame:
    """``fam``, ``initial`` and ``meant``: the initial of the full given name that an initial stands for in a family where that name, or a familiar form only it has, is written out."""
    low = aliases.select(F.lower(F.trim("given")).alias("full"), F.lower(F.trim("alias")).alias("alias"))
    only = low.groupBy("alias").agg(F.count("*").alias("k"), F.first("full").alias("full")).where("k = 1").select(F.col("alias").alias("word"), "full")
    itself = low.select(F.col("full").alias("word"), "full").distinct()
    meant = itself.unionByName(only.join(itself.select("word"), "word", "left_anti"))
    forms_of = low.select("full", F.substring("alias", 1, 1).alias("initial")).distinct()
    found = people.select("fam", "word").distinct().join(meant, "word").join(forms_of, "full").where("initial <> substring(full, 1, 1)")
    return found.groupBy("fam", "initial").agg(F.min(F.substring("full", 1, 1)).alias("meant"))


def _apart(people: DataFrame, part: str, known: DataFrame) -> DataFrame:
    """``people`` with ``{part}_apart``: their ``part`` (full given name, or second part of a double name) where it tells them from the others of their family and initial, else empty.

    It does where two rows or more write it out and it is neither near to the one that most rows have (two edits, an abbreviation) nor, by
    ``known`` (``w``, ``of``: full forms of a name), another form of it.
    """
    full = people.where(F.col(part) != "").groupBy("fam", "initial", part).agg(F.sum("n").alias("m"))
    main = full.groupBy("fam", "initial").agg(F.max_by(part, F.struct("m", part)).alias("main"))
    own = full.where("m > 1").join(main, ["fam", "initial"]).where(f"levenshtein({part}, main) > 2 AND NOT startswith({part}, main) AND NOT startswith(main, {part})")
    own = own.join(known.select(F.col("w").alias(part), "of"), part, "left").join(known.select(F.col("w").alias("main"), F.col("of").alias("of_main")), "main", "left")
    own = own.where("NOT coalesce(arrays_overlap(of, of_main), false)").select("fam", "initial", part, F.col(part).alias(f"{part}_apart"))
    return people.join(own, ["fam", "initial", part], "left").withColumn(f"{part}_apart", F.coalesce(f"{part}_apart", F.lit("")))


def link_names(rows: DataFrame, aliases: DataFrame, key: str = "name_id", family: str = "family", given: str = "given") -> DataFrame:
    """``key`` and ``entity``, a number that all rows naming one person or organisation share; null where there is no name.

    ``aliases`` has ``given`` and ``alias``. Equal spellings are worked once, however many rows
    have them. People of one family name are told apart by the initials of their given names and of the familiar
    forms of these, and, with the same initial, by given names that two rows each write out and that differ by more
    than an edit. A person's row without a given name joins the only person of its family name, or stays
    with its like. Null or blank names have no entity. The key must not be null.
    """
    texts = rows.select(key, F.col(family).cast("string").alias("family"), F.nullif(F.trim(F.col(given).cast("string")), F.lit("")).alias("given"))
    texts = texts.withColumn("form", F.xxhash64("family", "given"))
    forms = stage(texts.where("trim(coalesce(family, '')) <> '' OR given IS NOT NULL").groupBy("form").agg(F.first("family").alias("family"), F.first("given").alias("given"), F.count("*").alias("n")))
    read = stage(read_names(forms).join(forms.select("form", "n"), "form"))
    # the support of a name comes from first readings; other orders count with nothing, so that they only find what is there
    held = F.when(F.col("order") == 0, F.col("n")).otherwise(F.lit(0))
    taken = canonical_names(read.groupBy("kind", "name", "initial").agg(F.sum(held).alias("n")))
    placed = stage(read.join(taken, ["kind", "name"], "left").withColumn("fam", F.coalesce("fam", "name")))
    # every token order is checked: the one whose person most other rows name is the reading
    persons = placed.where("order = 0 AND initial <> ''").groupBy("kind", "fam", "initial").agg(F.sum("n").alias("rows_of"))
    several = placed.where("kind = 'p'").groupBy("form").agg(F.max("order").alias("orders")).where("orders > 0").select("form")
    ranked = placed.join(several, "form").join(persons, ["kind", "fam", "initial"], "left")
    others = F.coalesce(F.col("rows_of"), F.lit(0)) - F.when(F.col("order") == 0, F.col("n")).otherwise(0)
    best = ranked.groupBy("form").agg(F.max_by("order", F.struct(others, -F.col("order"))).alias("order"))
    chosen = placed.join(best, ["form", "order"], "left_semi").unionByName(placed.where("order = 0").join(several, "form", "left_anti"))
    chosen = stage(chosen.select("form", "kind", "fam", "word", "initial", "keys", "tail", "n"))
    people = chosen.where("kind = 'p'")
    people = people.join(_given_initials(aliases, people.where("word <> ''")), ["fam", "initial"], "left").withColumn("initial", F.coalesce("meant", "initial")).drop("meant", "keys")
    people = stage(people)
    alone = people.where("initial <> ''").groupBy("fam").agg(F.countDistinct("initial").alias("k"), F.first("initial").alias("sole")).where("k = 1").select("fam", "sole")
    people = people.join(alone, "fam", "left").withColumn("initial", F.when(F.col("initial") == "", F.coalesce("sole", F.lit(""))).otherwise(F.col("initial")))
    people = stage(people.drop("k", "sole"))
    low = aliases.select(F.lower(F.trim("given")).alias("g"), F.lower(F.trim("alias")).alias("w"))
    known = low.union(low.select("g", F.col("g").alias("w"))).distinct().groupBy("w").agg(F.collect_set("g").alias("of"))
    known = stage(known)
    people = _apart(_apart(people, "word", known), "tail", known.limit(0))
    persons = people.select("form", F.xxhash64(F.lit("p"), "fam", "initial", "word_apart", "tail_apart").alias("entity"))
    # organisations of one place share at least two initials
    node = lambda *c: F.xxhash64(*c)
    firms = chosen.where("kind = 'o'").withColumn("own", node(F.lit("o"), "fam", "initial"))
    edges = firms.select(F.col("own").alias("a"), "fam", F.explode("keys").alias("k")).select("a", node(F.lit("k"), "fam", "k").alias("b")).distinct()
    firms = firms.join(components(edges).withColumnRenamed("node", "own"), "own", "left").select("form", F.coalesce("component", "own").alias("entity"))
    entity = persons.unionByName(firms)
    return texts.select(key, "form").join(entity, "form", "left").select(key, "entity")
