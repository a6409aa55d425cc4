"""Printed references resolved against catalogue records.

``refs`` has ``doc_id``, ``ref_idx``, ``raw_text``, ``title``, ``authors``, ``year``, ``doi``,
``container_title``, ``volume``; ``candidates`` has ``cand_id`` (order of preference), ``title``,
``authors``, ``year``, ``doi``, ``abstract``, ``source``, ``provider_type``. A catalogue is a table
that is joined, not a service that is asked row by row.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.config import CitationConfig
from quirelake.functions import blocks, pairs
from quirelake.functions import text as X
from quirelake.functions.fold import fold_name
from quirelake.session import stage

_LATIN = re.compile(r"[a-z][a-z' .-]*")
DEFAULT = CitationConfig()
#: Between the names of a list, and the pairs that are looked at at once.
_APART, _PAIRS = "\x1f", 400_000


def _people(authors, with_given: bool) -> list[str]:
    return [fold_name(a["family"]) for a in authors if a and a["family"] and (a["given"] or not with_given)] if authors is not None else []


def authors_disagree(printed, listed) -> bool:
    """R2: whether both lists name people in Latin letters and no printed one (given name and all) resembles a listed one."""
    return _names_disagree(_people(printed, True), _people(listed, False))


def _names_disagree(printed: list[str], right: list[str]) -> bool:
    left = [n for n in printed if _LATIN.fullmatch(n)]
    if not left or not right or not all(_LATIN.fullmatch(n) for n in right):
        return False
    return not any(blocks.names_similar(a, b) for a in left for b in right)


def first_family(authors) -> str | None:
    names = [a["family"] for a in authors[:1] if a] if authors is not None and len(authors) else []
    return fold_name(names[0]) if names and names[0] else None


def judge(title, authors, year, other_title, other_authors, other_year, config: CitationConfig = DEFAULT) -> tuple[float, bool]:
    """Title similarity (of the printed title to the other), and whether the pair is accepted.

    From the upper bar on years may differ by the tolerance, a missing one being no objection, and the
    authors must not disagree; from the lower bar on the year must be the same and the first family too.
    """
    similarity = blocks.title_similarity(title, other_title)
    if similarity >= config.accept:
        apart = year is not None and other_year is not None and abs(year - other_year) > config.year_tolerance
        return similarity, not apart and not authors_disagree(authors, other_authors)
    family = first_family(authors)
    return similarity, similarity >= config.near and year is not None and year == other_year and family is not None and family == first_family(other_authors)


def zip_extracted(raw: DataFrame, extracted: DataFrame) -> DataFrame:
    """Raw references with what was extracted at the same place, nulls where nothing was."""
    return raw.join(extracted, ["doc_id", "ref_idx"], "left")


def match_by_doi(refs: DataFrame, candidates: DataFrame, doi: Column) -> DataFrame:
    """J3 (a) and J4: the first candidate with a title and the same DOI, case aside: ``doc_id``, ``ref_idx``, ``cand_id``."""
    left = refs.select("doc_id", "ref_idx", F.lower(doi).alias("k")).where("k IS NOT NULL")
    right = candidates.where("title IS NOT NULL AND doi IS NOT NULL").select(F.lower(X.extract_doi("doi")).alias("k"), "cand_id").where("k IS NOT NULL").groupBy("k").agg(F.min("cand_id").alias("cand_id"))
    return left.join(right, "k").select("doc_id", "ref_idx", "cand_id")


def title_keys(text: str, family: str | None, year: int | None) -> tuple[list[str], list[str]]:
    """Blocks of a normalised title, core ones and others: pairs of its five longest words (core: of its three longest, or a title's only word), each word of up to four, the first and last 16 letters, and first family and year.

    A pair between the two bars is accepted only with equal first families and years, so the last of these loses no such pair.
    """
    every = sorted(set(text.split(" ")), key=lambda w: (-len(w), w))
    w, close = every[:5], text.replace(" ", "")
    core = [" ".join(sorted(p)) for p in combinations(w[:3], 2)]
    rest = [" ".join(sorted((x, y))) for i, x in enumerate(w) for y in w[max(i + 1, 3) :]]
    if len(every) <= 4:
        (core if len(every) == 1 else rest).extend(w)
    rest += ["<" + close[:16], ">" + close[-16:]]
    if family is not None and year is not None:
        rest.append(f"@{family}|{year}")
    return core, rest


def _title_parts(with_given: bool):
    """An Arrow column function of (title, authors, year): the normalised title, its blocks, the first family, and the folded names that R2 looks at."""

    def over(titles: pd.Series, authors: pd.Series, years: pd.Series) -> pd.DataFrame:
        texts, families = [blocks.normal_title(t) for t in titles], [first_family(a) for a in authors]
        core, rest = zip(*(title_keys(t, f, None if pd.isna(y) else int(y)) for t, f, y in zip(texts, families, years))) if texts else ((), ())
        return pd.DataFrame({"n": texts, "core": list(core), "rest": list(rest), "family": families, "people": [_APART.join(_people(a, with_given)) for a in authors]})

    over.__annotations__ = {"titles": pd.Series, "authors": pd.Series, "years": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(over, "n string, core array<string>, rest array<string>, family string, people string")


def _judged_blocks(config: CitationConfig, misses: bool, best: bool):
    """The function of :func:`title_pairs` over whole blocks: every pair of a block held against the exact bounds, those that remain judged as by :func:`judge`."""
    least = config.near

    def over(batches):
        rows = pa.Table.from_batches(b) if (b := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        left, right = (part.sort_by("k") for part in (rows.filter(pc.field("__c").is_valid()), rows.filter(pc.field("__c").is_null())))
        if not left.num_rows or not right.num_rows:
            return
        number = lambda t, c: t[c].to_numpy()
        (a, p, m), (b, q, n) = (pairs.encode(t["n"].to_pylist()) for t in (left, right))
        core, other_core = number(left, "core"), number(right, "core")
        year, other_year = (number(t, "year").astype(float) for t in (left, right))  # null: not a number
        begin = np.searchsorted(number(right, "k"), number(left, "k"), "left")
        count = np.searchsorted(number(right, "k"), number(left, "k"), "right") - begin
        open_rows = np.flatnonzero(count)
        ends = np.cumsum(count[open_rows])
        first = 0
        while first < len(open_rows):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _PAIRS, "right")))
            own = open_rows[first:last]
            first = last
            x = np.repeat(own, count[own])
            y = np.arange(len(x)) + np.repeat(begin[own] - (np.cumsum(count[own]) - count[own]), count[own])
            both = m[x] + n[y]
            keep = 2 * np.minimum(m[x], n[y]) >= least * both
            x, y, both = x[keep], y[keep], both[keep]
            most = np.floor((1 - least) * both + 1e-9).astype(np.int64)
            if misses:
                ask = ~(core[x] & other_core[y])
                keep = ~ask
                keep[ask] = pairs.edits(a, p[x[ask]], m[x[ask]], b, q[y[ask]], n[y[ask]], most[ask], 1)
            else:
                keep = pairs.edits(a, p[x], m[x], b, q[y], n[y], most, 2)
            x, y = x[keep], y[keep]
            similarity = pairs.ratios(a, p[x], m[x], b, q[y], n[y], 0.0 if misses else least)
            if not misses:
                keep = similarity >= least
                x, y, similarity = x[keep], y[keep], similarity[keep]
            apart = np.abs(year[x] - other_year[y])
            accepted = (similarity >= config.accept) & ~(apart > config.year_tolerance)
            r = np.flatnonzero(accepted)
            accepted[r] = [not _names_disagree(*([v for v in t.split(_APART) if v] for t in z)) for z in zip(left["people"].take(x[r]).to_pylist(), right["people"].take(y[r]).to_pylist())]
            r = np.flatnonzero((similarity < config.accept) & (similarity >= config.near) & (apart == 0))
            accepted[r] = [f is not None and f == g for f, g in zip(left["family"].take(x[r]).to_pylist(), right["family"].take(y[r]).to_pylist())]
            if best:
                # the most similar below the bar of each reference in the block, with all of its equals
                low = (similarity < least) & ~accepted
                top = np.full(left.num_rows, -1.0)
                np.maximum.at(top, x[low], similarity[low])
                keep = ~low | (similarity == top[x])
                x, y, similarity, accepted = x[keep], y[keep], similarity[keep], accepted[keep]
            out = [left["__c"].take(x), *(right[c].take(y) for c in ("cand_id", "source", "preprint")), pa.array(similarity), pa.array(accepted)]
            yield from pa.table(out, names=["__c", "cand_id", "source", "preprint", "similarity", "accepted"]).to_batches()

    return over


def title_pairs(refs: DataFrame, candidates: DataFrame, config: CitationConfig = DEFAULT, misses: bool = True, best: bool = False) -> DataFrame:
    """Pairs of references and candidates that meet in a block of :func:`title_keys`, with ``similarity`` and ``accepted``, and the candidate's ``source`` and ``preprint``.

    The blocks replace a provider's title search. Pairs on two of the three longest words are kept whatever
    their similarity, as near misses; those that only the other blocks give must be within the edit distance that the lower bar
    allows. Without ``misses`` only pairs from the lower bar on, all that can be accepted or come before one that is; with ``best`` also what can be a reference's near miss, in each
    block the most similar of its pairs below the bar. A block's pairs are made and
    judged where the block is, as arrays, and only what remains of them is shuffled.
    """
    misses = misses or config.accept < config.near
    # references that read alike are compared once
    own = refs.where(X.searchable("title")).select("doc_id", "ref_idx", "title", "authors", "year").withColumn("__c", F.xxhash64("title", "authors", "year"))
    alike = own.groupBy("__c").agg(*(F.first(c).alias(c) for c in ("title", "authors", "year")))
    id_type, c_type = candidates.schema["cand_id"].dataType, candidates.schema["source"].dataType
    records = candidates.where(X.searchable("title")).withColumn("preprint", X.is_preprint("provider_type", "doi"))

    def keyed(df: DataFrame, with_given: bool, *ids: Column) -> DataFrame:
        rows = df.withColumn("__p", _title_parts(with_given)("title", "authors", "year"))
        kept = lambda core: lambda k: F.struct(F.xxhash64(k).alias("k"), F.lit(core).alias("core"))
        return rows.withColumn("__k", F.explode(F.concat(F.transform("__p.core", kept(True)), F.transform("__p.rest", kept(False))))).select("__k.k", "__k.core", *ids, F.col("year").cast("int").alias("year"), "__p.n", "__p.family", "__p.people")

    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    left = keyed(alike, True, F.col("__c"), none(id_type, "cand_id"), none(c_type, "source"), none("boolean", "preprint"))
    right = keyed(records, False, none("bigint", "__c"), F.col("cand_id"), F.col("source"), F.col("preprint"))
    parts = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = left.unionByName(right).repartition(parts, "k").mapInArrow(_judged_blocks(config, misses, best), T.StructType([T.StructField("__c", T.LongType()), T.StructField("cand_id", id_type), T.StructField("source", c_type), T.StructField("preprint", T.BooleanType()), T.StructField("similarity", T.DoubleType()), T.StructField("accepted", T.BooleanType())]))
    # a pair may meet in several blocks
    return own.select("doc_id", "ref_idx", "__c").join(made.repartition("__c").distinct(), "__c").drop("__c")


def best_match(pairs: DataFrame) -> DataFrame:
    """Of each reference's accepted pairs the most similar, the first of equals."""
    w = Window.partitionBy("doc_id", "ref_idx").orderBy(F.desc("similarity"), "cand_id")
    return pairs.where("accepted AND similarity > 0").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def chain_match(pairs: DataFrame, config: CitationConfig = DEFAULT) -> DataFrame:
    """J5 with O5: published before preprint, then the providers' order, then similarity; at most ``search_candidates`` of each provider are considered.

    A top-k by provider, as the search would give it, and the first acceptable of it.
    """
    order = F.coalesce(F.array_position(F.array(*(F.lit(p) for p in config.providers)), F.col("source")).cast("int"), F.lit(0))
    top = Window.partitionBy("doc_id", "ref_idx", "source").orderBy(F.desc("similarity"), "cand_id")
    hits = pairs.withColumn("__rank", F.row_number().over(top)).where(F.col("__rank") <= config.search_candidates).where("accepted")
    w = Window.partitionBy("doc_id", "ref_idx").orderBy("preprint", F.when(order == 0, 99).otherwise(order), "__rank", "cand_id")
    return hits.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__rank")


def near_misses(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """O3: each reference's most similar rejected candidate, the first of equals: ``provider``, ``near_similarity`` (three digits), ``near_title``, ``near_year``."""
    w = Window.partitionBy("doc_id", "ref_idx").orderBy(F.desc("similarity"), "cand_id")
    best = pairs.where("NOT accepted").withColumn("__n", F.row_number().over(w)).where("__n = 1")
    named = candidates.select("cand_id", F.col("title").alias("near_title"), F.col("year").alias("near_year"))
    return best.join(named, "cand_id").select("doc_id", "ref_idx", F.col("source").alias("provider"), F.round("similarity", 3).alias("near_similarity"), "near_title", "near_year")


def merge(refs: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """References with the matched record's fields where it has them; a record's year earlier than the printed one is passed over.

    ``matches`` has ``doc_id``, ``ref_idx``, ``cand_id`` and ``route``; an empty list of authors
    counts as missing. References without a match keep their guess and have ``verified`` false.
    """
    c = candidates.select("cand_id", *(F.col(n).alias(f"c_{n}") for n in ("title", "year", "doi", "abstract", "authors", "source", "provider_type")))
    rows = refs.join(matches.select("doc_id", "ref_idx", "cand_id", "route"), ["doc_id", "ref_idx"], "left").join(c, "cand_id", "left")
    wins = lambda n: F.coalesce(X.or_null(F.col(f"c_{n}")), F.col(n))
    year = F.when(F.col("c_year").isNull() | (F.col("c_year") == 0) | (F.col("c_year") < F.coalesce("year", F.lit(0))), F.col("year")).otherwise(F.col("c_year"))
    abstract = F.col("c_abstract") if "abstract" not in refs.columns else wins("abstract")
    return rows.select(
        "doc_id", "ref_idx", wins("title").alias("title"), year.alias("year"), wins("doi").alias("doi"), abstract.alias("abstract"),
        F.when(F.size("c_authors") > 0, F.col("c_authors")).otherwise(F.col("authors")).alias("authors"),
        "container_title", "volume", F.col("route").isNotNull().alias("verified"), F.col("route").alias("match"),
        F.col("c_source").alias("source"), F.col("c_provider_type").alias("provider_type"),
    )


def dedup_pool(pool: DataFrame, order: str = "cand_idx", key: str = "doc_id") -> DataFrame:
    """Candidates with a DOI are kept once by DOI; those without go when an earlier kept one has their title. The first wins.

    ``order`` must be unique within ``key``. Rows with neither are kept.
    """
    title, doi = X.or_null(X.normalize_title("title")), F.lower(X.or_null(F.col("doi")))
    rows = pool.withColumn("__t", title).withColumn("__d", doi)
    by_doi = Window.partitionBy(key, "__d").orderBy(order)
    by_title = Window.partitionBy(key, "__t").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__first", F.when(F.col("__d").isNotNull(), F.row_number().over(by_doi) == 1).otherwise(F.lit(True)))
    rows = rows.withColumn("__seen", F.coalesce(F.max(F.when(F.col("__first"), 1)).over(by_title), F.lit(0)))
    return rows.where(F.col("__first") & (F.col("__d").isNotNull() | F.col("__t").isNull() | (F.col("__seen") == 0))).drop("__t", "__d", "__first", "__seen")


def union_pools(first: DataFrame, second: DataFrame, key: str = "doc_id") -> DataFrame:
    """The earlier pool before the newer one, then :func:`dedup_pool`; ``cand_idx`` numbers the result."""
    both = first.withColumn("__p", F.lit(0)).unionByName(second.withColumn("__p", F.lit(1)))
    both = both.withColumn("cand_idx", F.row_number().over(Window.partitionBy(key).orderBy("__p", "cand_idx")) - 1).drop("__p")
    return dedup_pool(both, key=key)


def resolve(refs: DataFrame, candidates: DataFrame, own: DataFrame | None = None, config: CitationConfig = DEFAULT, misses: bool = True) -> DataFrame:
    """The cascade: the document's own pool, then a DOI printed in the raw text, then titles; the first route that hits counts.

    ``own`` has ``doc_id`` besides a candidate's columns. Each route sees only what is left. Gives R3's
    columns with T18's ``type`` and the near miss of unverified references, which is left out without ``misses``. The judged pairs are written once.
    """
    matched = None
    left = refs
    if own is not None:
        named = own.withColumn("__k", F.concat_ws("|", "doc_id", F.lower(X.extract_doi("doi"))))
        keyed = left.withColumn("__k", F.concat_ws("|", "doc_id", F.lower(F.coalesce(X.extract_doi("raw_text"), X.extract_doi("doi")))))
        matched = keyed.join(named.where("title IS NOT NULL AND doi IS NOT NULL").groupBy("__k").agg(F.min("cand_id").alias("cand_id")), "__k").select("doc_id", "ref_idx", "cand_id", F.lit("caller").alias("route"))
        left = left.join(matched, ["doc_id", "ref_idx"], "left_anti")
        candidates = candidates.unionByName(own.select(*candidates.columns))
    by_doi = match_by_doi(left, candidates, X.extract_doi("raw_text")).withColumn("route", F.lit("doi"))
    rest = left.join(by_doi, ["doc_id", "ref_idx"], "left_anti")
    judged = stage(title_pairs(rest, candidates, config, misses, best=True))
    by_title = chain_match(judged, config).select("doc_id", "ref_idx", "cand_id", F.col("source").alias("route"))
    found = by_doi.unionByName(by_title) if matched is None else matched.unionByName(by_doi).unionByName(by_title)
    out = merge(refs, found, candidates)
    if misses:
        out = out.join(near_misses(judged, candidates), ["doc_id", "ref_idx"], "left")
    return out.withColumn("type", X.csl_type("source", "provider_type", "container_title"))


def fill_abstracts(resolved: DataFrame, candidates: DataFrame) -> DataFrame:
    """A reference matched through crossref without an abstract takes that of another record with its DOI."""
    others = candidates.where("abstract IS NOT NULL AND doi IS NOT NULL").groupBy(F.lower(X.extract_doi("doi")).alias("__k")).agg(F.min_by("abstract", "cand_id").alias("__a"))
    rows = resolved.withColumn("__k", F.when((F.col("match") == "crossref") & F.col("abstract").isNull(), F.lower(X.extract_doi("doi")))).join(others, "__k", "left")
    return rows.withColumn("abstract", F.coalesce("abstract", "__a")).drop("__k", "__a")


def identify_sources(sources: DataFrame, records: DataFrame, config: CitationConfig = DEFAULT) -> DataFrame:
    """``doc_id`` and ``cand_id`` of the record that a document is: by DOI without more ado, by title from the upper bar on, or from the lower with the same year and first family."""
    by_id = match_by_doi(sources.withColumn("ref_idx", F.lit(0)), records, X.extract_doi("doi")).select("doc_id", "cand_id")
    rest = sources.join(by_id, "doc_id", "left_anti").withColumn("ref_idx", F.lit(0))
    found = best_match(title_pairs(rest, records, config, misses=False))
    return by_id.unionByName(found.select("doc_id", "cand_id"))


def hydrate(cited: DataFrame, works: DataFrame, batch: int = 100) -> DataFrame:
    """``doc_id`` and ``referenced`` (array of ids) to the works they name, in order, with ``batch`` as a request would be cut."""
    each = cited.select("doc_id", F.posexplode("referenced").alias("cand_idx", "work_id")).withColumn("batch", F.floor(F.col("cand_idx") / batch).cast("int"))
    return each.join(works, "work_id")


def caller_references(rows: DataFrame) -> DataFrame:
    """Entries of a caller's bibliography in either spelling of their fields, as candidates; entries that say nothing go.

    Text columns that may be missing: title, article-title, volume-title, unstructured, doi, DOI, year, author.
    """
    have = {c: F.col(f"`{c}`").cast("string") for c in rows.columns}
    pick = lambda *names: F.coalesce(*(X.or_null(have[n]) for n in names if n in have), F.lit(None).cast("string"))
    author = pick("author")
    out = rows.select(
        *(c for c in ("doc_id", "cand_idx") if c in rows.columns), pick("title", "article-title", "volume-title", "unstructured").alias("title"), pick("doi", "DOI").alias("doi"),
        F.substring(pick("year"), 1, 4).try_cast("int").alias("year"),
        F.when(author.isNotNull(), F.array(F.struct(author.alias("family"), F.lit(None).cast("string").alias("given")))).alias("authors"),
    )
    return out.where("title IS NOT NULL OR doi IS NOT NULL")


def normalise_s2(raw: DataFrame) -> DataFrame:
    """``title``, ``year``, ``abstract``, ``externalIds`` (map), ``publicationTypes``, ``authors`` (array of ``name``) to a candidate."""
    names = F.transform("authors", lambda a: X.split_full_name(a["name"]))
    return raw.select(*_keys(raw), "title", F.col("year").cast("int").alias("year"), F.element_at("externalIds", "DOI").alias("doi"), "abstract", names.alias("authors"), F.lit("semanticscholar").alias("source"), F.when(F.size("publicationTypes") > 0, F.get("publicationTypes", F.lit(0))).alias("provider_type"))


def normalise_crossref(raw: DataFrame) -> DataFrame:
    """``title`` (array), ``issued`` (``date_parts``), ``DOI``, ``abstract`` with JATS tags, ``author``, ``type`` to a candidate."""
    people = F.filter(F.transform("author", lambda a: F.struct(a["family"].alias("family"), a["given"].alias("given"))), lambda a: F.coalesce(a["family"], F.lit("")) != "")
    return raw.select(*_keys(raw), F.when(F.size("title") > 0, F.get("title", F.lit(0))).alias("title"), F.get(F.get(F.col("issued.date_parts"), F.lit(0)), F.lit(0)).cast("int").alias("year"), F.col("DOI").alias("doi"), X.or_null(F.trim(F.regexp_replace("abstract", "<[^>]+>", ""))).alias("abstract"), people.alias("authors"), F.lit("crossref").alias("source"), F.col("type").alias("provider_type"))


def normalise_openalex(raw: DataFrame) -> DataFrame:
    """``display_name``, ``title``, ``publication_year``, ``doi`` (URL), ``abstract_inverted_index``, ``authorships``, ``type`` to a candidate."""
    names = F.transform("authorships", lambda a: X.split_full_name(a["author"]["display_name"]))
    return raw.select(*_keys(raw), F.coalesce("display_name", "title").alias("title"), F.col("publication_year").cast("int").alias("year"), F.regexp_replace("doi", "^https://doi.org/", "").alias("doi"), X.reconstruct_abstract("abstract_inverted_index").alias("abstract"), names.alias("authors"), F.lit("openalex").alias("source"), F.col("type").alias("provider_type"))


def _keys(raw: DataFrame) -> list[str]:
    return [c for c in ("doc_id", "cand_id", "cand_idx", "work_id") if c in raw.columns]


def source_bundle(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """``doc_id``, ``title`` (the bundle's, else the first heading's) and ``doi`` (the explicit one, else the shorthand's)."""
    joined = docs.select("doc_id", X.source_title("markdown").alias("__h")).join(meta, "doc_id", "left")
    return joined.select("doc_id", F.coalesce(X.or_null(F.col("title")), F.col("__h")).alias("title"), F.coalesce(X.or_null(F.col("doi")), X.or_null(F.col("short_doi"))).alias("doi"))


def route_counts(resolved: DataFrame) -> DataFrame:
    """References by match route; unverified ones under ``unverified``."""
    return resolved.groupBy(F.coalesce("match", F.lit("unverified")).alias("route")).agg(F.count(F.lit(1)).alias("n"))


def lookup_outcomes(lookups: DataFrame) -> DataFrame:
    """Lookups by provider, with one column for each outcome in a fixed order."""
    outcomes = ["ok", "missing", "429", "5xx", "4xx", "timeout", "error"]
    return lookups.groupBy("provider").pivot("outcome", outcomes).count().na.fill(0, outcomes)


def stats_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts of ``after`` less those of ``before`` by provider and outcome, those that changed."""
    joined = after.withColumnRenamed("n", "__a").join(before.withColumnRenamed("n", "__b"), ["provider", "outcome"], "full")
    return joined.select("provider", "outcome", (F.coalesce("__a", F.lit(0)) - F.coalesce("__b", F.lit(0))).cast("bigint").alias("n")).where("n <> 0")


def describe_reference(family: Column, year: Column, title: Column) -> Column:
    """``Boyd 2004 "Title"`` of what is there."""
    return F.concat_ws(" ", family, year.cast("string"), F.when(title.isNotNull(), F.concat(F.lit('"'), title, F.lit('"'))))


def describe_outcome(verified: Column, route: Column, similarity: Column, near: Column) -> Column:
    """``verified: route (0.97)`` or ``unverified (best: …)``."""
    done = F.concat(F.lit("verified: "), route, F.coalesce(F.concat(F.lit(" ("), F.format_number(similarity, 2), F.lit(")")), F.lit("")))
    return F.when(verified, done).otherwise(F.concat(F.lit("unverified"), F.coalesce(F.concat(F.lit(" (best: "), near, F.lit(")")), F.lit(""))))


def report_lines(resolved: DataFrame, extracted: DataFrame) -> DataFrame:
    """K7: the report of each document as rows ``doc_id``, ``line_no``, ``line``: a head with counts by route, verified references with what changed, unverified ones at the end."""
    e = extracted.select("doc_id", "ref_idx", F.col("title").alias("e_title"), F.col("year").alias("e_year"), F.col("doi").alias("e_doi"))
    rows = resolved.join(e, ["doc_id", "ref_idx"], "left").withColumn("similarity", blocks.title_similarity_column(F.col("e_title"), F.col("title")))
    number = F.lpad((F.col("ref_idx") + 1).cast("string"), 3, " ")
    year = F.when(F.col("e_year").eqNullSafe(F.col("year")), F.coalesce(F.col("year").cast("string"), F.lit("-"))).otherwise(F.concat(F.coalesce(F.col("e_year").cast("string"), F.lit("-")), F.lit("->"), F.coalesce(F.col("year").cast("string"), F.lit("-"))))
    gained = F.when(F.col("doi").isNotNull() & F.col("e_doi").isNull(), " | +doi").otherwise("")
    good = F.concat(F.lit("["), number, F.lit("] "), F.rpad(F.coalesce("match", F.lit("?")), 15, " "), F.lit(" title-sim "), F.format_number("similarity", 2), F.lit(" | year "), year, gained, F.lit(" | "), F.substring(F.coalesce("title", F.lit("")), 1, 90))
    miss = F.coalesce(F.concat(F.lit("best reject: "), "provider", F.lit(" sim "), F.col("near_similarity").cast("string"), F.lit(" | "), F.substring("near_title", 1, 70)), F.lit("no candidate from any provider"))
    bad = F.concat(F.lit("["), number, F.lit("] "), F.substring(F.coalesce("e_title", F.lit("")), 1, 80), F.lit(" -- "), miss)
    body = rows.select("doc_id", F.when(F.col("verified"), 1).otherwise(2).alias("part"), "ref_idx", F.when(F.col("verified"), good).otherwise(bad).alias("line"))
    counts = resolved.groupBy("doc_id", "match").agg(F.count(F.lit(1)).alias("n"), F.count_if("verified").alias("v"))
    head = counts.groupBy("doc_id").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.when(F.col("match").isNotNull(), F.concat_ws(": ", "match", F.col("n").cast("string"))))).alias("routes"))
    head = head.select("doc_id", F.lit(0).alias("part"), F.lit(-1).alias("ref_idx"), F.concat(F.lit("resolved "), F.col("v").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" references ("), F.array_join("routes", ", "), F.lit(")")).alias("line"))
    order = Window.partitionBy("doc_id").orderBy("part", "ref_idx")
    return head.unionByName(body).withColumn("line_no", F.row_number().over(order)).select("doc_id", "line_no", "line")


def export_citations(resolved: DataFrame, verified_only: bool = True) -> DataFrame:
    """K8: ``doc_id``, ``ref_idx`` and ``citation``, the JSON of the CrossRef-like fields that have a value; title or DOI required."""
    family = F.when(F.size("authors") > 0, F.col("authors")[0]["family"])
    fields = (("article-title", F.col("title")), ("DOI", F.col("doi")), ("author", family), ("year", F.col("year").cast("string")), ("journal-title", F.col("container_title")), ("volume", F.col("volume")))
    rows = resolved.where("coalesce(title, '') <> '' OR coalesce(doi, '') <> ''")
    if verified_only:
        rows = rows.where("verified")
    return rows.select("doc_id", "ref_idx", F.to_json(F.struct(*(X.or_null(v).alias(n) for n, v in fields)), {"ignoreNullFields": "true"}).alias("citation"))
