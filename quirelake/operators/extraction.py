"""Extracted reference rows put beside the raw entries they were read from.

A language model's rows may be skipped, doubled or mislabelled, so each is checked against the entry
it claims. The model itself is a function that is passed in; a rule-based stand-in works offline.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions import text as X
from quirelake.functions.blocks import words
from quirelake.functions.entries import one_line, read_entry
from quirelake.functions.fold import fold_name

_NUMERIC = re.compile(r"\[?\(?(\d+)[\]).]?")
_LEADING = re.compile(r"^\s*\[?(\d+)[\]. ]?\s")
AUTHORS = "array<struct<family: string, given: string>>"


def _printed_number(raw: str | None) -> str | None:
    found = _LEADING.match(raw or "")
    return found.group(1) if found else None


def _key_number(row: dict) -> str | None:
    found = _NUMERIC.fullmatch((row.get("citation_key") or "").strip())
    return found.group(1) if found else None


def row_fits(row: dict, raw: str | None) -> bool:
    """Whether a row can have been read from an entry.

    A purely numeric key must be the number printed in front, where there is one. Of the first six
    title words longer than three letters (else the first three words) six tenths, one at least, must
    be printed; where the title has no such word, all words of the first surname. With nothing to check the row fits.
    """
    key, printed = _key_number(row), _printed_number(raw)
    if key and printed and key != printed:
        return False
    have, title = set(words(raw)), words(row.get("title"))
    probe = [w for w in title if len(w) > 3][:6] or title[:3]
    if probe:
        return sum(w in have for w in probe) >= max(1, 0.6 * len(probe))
    authors = row.get("authors") or []
    return have.issuperset(words(authors[0].get("family")) if authors and authors[0] else ())


def claims(rows: list[dict], raws: list[str]) -> Iterator[tuple[int, int]]:
    """J1, what is asked: (row, place) of every place a row may belong to, row by row, the likeliest place first.

    These are the line it declares, the first place with the number of its key printed, and its own place where rows and
    entries are as many and no valid line is declared twice. A line out of range is no declaration.
    """
    lines = [line if line is not None and 0 < line <= len(raws) else None for line in (r.get("line") for r in rows)]
    valid = [line for line in lines if line]
    number_at: dict[str | None, int] = {}
    for place, raw in enumerate(raws):
        number_at.setdefault(_printed_number(raw), place)
    in_order = len(rows) == len(raws) and len(valid) == len(set(valid))
    for k, (row, line) in enumerate(zip(rows, lines)):
        key = _key_number(row)
        for place in (line - 1 if line else None, number_at.get(key) if key else None, k if in_order else None):
            if place is not None:
                yield k, place


def align_rows(rows: list[dict], raws: list[str]) -> list[dict | None]:
    """For each raw entry the row that belongs to it, or none: of the :func:`claims`, in order, each that fits, whose row has no place yet and whose place is free."""
    held: dict[int, int] = {}
    settled: set[int] = set()
    for k, place in claims(rows, raws):
        if k not in settled and place not in held and row_fits(rows[k], raws[place]):
            held[place] = k
            settled.add(k)
    return [rows[held[i]] if i in held else None for i in range(len(raws))]


def batches(refs: DataFrame, size: int = 50) -> DataFrame:
    """``batch`` and ``line`` (from 1) of each reference within its document, in order."""
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("ref_idx")) - 1
    return refs.withColumn("__p", place).withColumns({"batch": F.floor(F.col("__p") / size).cast("int"), "line": (F.pmod(F.col("__p"), F.lit(size)) + 1).cast("int")}).drop("__p")


def batch_keys(refs: DataFrame, settings: str = "") -> DataFrame:
    """``doc_id``, ``batch`` and ``cache_key`` of each batch: the hash of its lines in order and of the settings that matter."""
    each = refs.groupBy("doc_id", "batch").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("lines"))
    return each.select("doc_id", "batch", F.sha2(F.concat(F.lit(settings), F.to_json(F.transform("lines", lambda x: x["text"]))), 256).alias("cache_key"))


def align_extracted(raw: DataFrame, rows: DataFrame) -> DataFrame:
    """J1 by document: ``raw`` (``doc_id``, ``ref_idx``, ``text``) with the fields of the rows (``doc_id``, ``row_no``, ``line``, ``citation_key``, ``title``, ``authors``, ``year``).

    Every raw entry stays; an entry no row fits has nulls.
    """
    entries = raw.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ref_idx", "text"))).alias("raws"))
    given = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("row_no", "line", "citation_key", "title", "authors", "year"))).alias("rows"))
    schema = T.StructType([raw.schema["doc_id"], raw.schema["ref_idx"], T.StructField("row_no", rows.schema["row_no"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, refs, found = [], [], []
            for i, (raws, own) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for r, row in zip(raws, align_rows(own or [], [x["text"] for x in raws])):
                    docs.append(i)
                    refs.append(r["ref_idx"])
                    found.append(row["row_no"] if row else None)
            kind = pa.int64() if schema["row_no"].dataType == T.LongType() else pa.int32()
            index = pa.int64() if schema["ref_idx"].dataType == T.LongType() else pa.int32()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(refs, index), pa.array(found, kind)], ["doc_id", "ref_idx", "row_no"])

    placed = entries.join(given, "doc_id", "left").select("doc_id", "raws", "rows").mapInArrow(run, schema)
    return placed.join(rows.drop("line"), ["doc_id", "row_no"], "left")


def sanitise_keys(rows: DataFrame) -> DataFrame:
    """A purely numeric ``citation_key`` goes unless it is the number printed in front of ``text``."""
    digits = F.regexp_extract("citation_key", r"^\[?\(?(\d+)[\]).]?$", 1)
    keep = (digits == "") | F.coalesce(digits == X.leading_number("text"), F.lit(False))
    return rows.withColumn("citation_key", F.when(keep, F.col("citation_key")))


def invented(row: dict, raw: str | None) -> list[str]:
    """Names of the fields of a row that its entry doesn't print."""
    raw = raw or ""
    have, flat = set(words(raw)), fold_name(raw)
    digits = lambda v: re.sub(r"\D", "", str(v or ""))
    out = []
    if row.get("year") and str(row["year"]) not in raw:
        out.append("year")
    if row.get("doi") and fold_name(row["doi"]).rpartition("doi.org/")[2] not in "".join(flat.split()):
        out.append("doi")
    if row.get("volume") and digits(row["volume"]) not in digits(raw):
        out.append("volume")
    if row.get("page_range") and not all(p in raw for p in re.findall(r"\d+", row["page_range"])):
        out.append("page_range")
    authors = row.get("authors") or []
    family = words(authors[0].get("family") if authors and authors[0] else "")
    if family and not all(w in have for w in family):
        out.append("author")
    title = words(row.get("title"))
    if title and sum(w in have for w in title) < 0.6 * len(title):
        out.append("title")
    return out


def invented_fields(rows: DataFrame, key: str = "ext_id") -> DataFrame:
    """P16 over a table of rows with their ``text``: ``key`` and ``fields``, the names joined by commas."""
    schema = T.StructType([rows.schema[key], T.StructField("fields", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [",".join(invented(r, r["text"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], schema.names)

    return rows.select(key, "text", "title", "authors", "year", "doi", "volume", "page_range").mapInArrow(run, schema)


_PERSON = r"(?!and\b)[^\W\d_][\w'’-]+"
#: ``Family, I. J.`` and ``I. J. Family``, the two ways in which bibliographies print a name.
_INVERTED = re.compile(rf"((?:{_PERSON} )*{_PERSON}), ((?:[^\W\d_]\.[ -]?)+)")
_STRAIGHT = re.compile(rf"((?:[^\W\d_]\.[ -]?)+) ?((?:{_PERSON} )*{_PERSON})")
_VOLUME = re.compile(r"\b(\d{1,4})\s*(?:\(\d+(?:[-–]\d+)?\))?\s*[,:]\s*(?:pp?\.\s*)?(\d+\s*[-–]\s*\d+)")
_DOI = re.compile(r"10\.\d{4,9}/[^\s\"'<>]+")


def rule_authors(lead: str) -> list[dict]:
    """The names at the head of an entry, in either way of printing them; none where it begins otherwise."""
    out: list[dict] = []
    at = 0
    while at < len(lead):
        found = _INVERTED.match(lead, at) or _STRAIGHT.match(lead, at)
        if not found:
            break
        inverted = found.re is _INVERTED
        family, given = (found.group(1), found.group(2)) if inverted else (found.group(2), found.group(1))
        out.append({"family": family.strip(" ."), "given": given.strip() or None})
        at = found.end()
        joint = re.compile(r"[\s,;.]*(?:\band\b|&)?\s*").match(lead, at)
        at = joint.end() if joint and joint.end() > at else len(lead)
    return out


def rule_extractor(raws: list[str]) -> list[dict]:
    """The offline stand-in for the model: key, authors, year, a rough title, journal, volume, pages and DOI of each line, in order; a line that says nothing gives no row."""
    out = []
    for i, raw in enumerate(raws, 1):
        entry = read_entry(raw)
        if not entry.words:
            continue
        line = one_line(raw or "")
        number = _LEADING.match(line)
        body = line[number.end() :] if number else line
        quoted = re.search(r"[“\"]([^”\"]{8,}?)[,.]?[”\"]", body)
        parts = [p for p in re.split(r"(?<=[a-z)]{2})\.\s+", body) if len(p) > 20]
        title = quoted.group(1) if quoted else (parts[1] if len(parts) > 1 else None)
        after = body[body.find(title) + len(title) :] if title else ""
        journal = re.match(r"[\s,.”\"]*(?:in:?\s+)?([^\W\d_][^,\d]{4,80}?)[,.]?\s*(?:vol\.?\s*)?(?=\d|,)", after, re.IGNORECASE)
        volume, doi = _VOLUME.search(after or body), _DOI.search(line)
        lead = body[: body.find(title)] if title else body
        out.append({
            "line": i, "citation_key": f"[{number.group(1)}]" if number else None, "title": title, "authors": rule_authors(lead.lstrip()), "year": entry.year,
            "container_title": journal.group(1).strip() if journal else None, "volume": volume.group(1) if volume else None, "page_range": volume.group(2) if volume else None, "doi": doi.group().rstrip(".,;:)]}") if doi else None,
        })
    return out


#: The fields of an extracted row, in the order of the output.
FIELDS = {"citation_key": "string", "title": "string", "authors": AUTHORS, "year": "int", "container_title": "string", "volume": "string", "page_range": "string", "doi": "string"}
ROW = ", ".join(f"{n}: {k}" for n, k in FIELDS.items())


def ask_model(model: Callable[[list[str]], list[dict]], raws: list[str]) -> list[dict | None]:
    """The row of each line, or none. Lines that the model leaves out are asked again once, then in halves down to single lines; a call that fails gives none."""

    def ask(places: list[int]) -> list[int]:
        """Asks for lines by their places; gives those that stay open."""
        try:
            for i, row in zip(places, align_rows(model([raws[i] for i in places]), [raws[i] for i in places])):
                got[i] = row or got[i]
        except Exception:  # a failing batch must not end the job
            pass
        return [i for i in places if got[i] is None]

    got: list[dict | None] = [None] * len(raws)
    left = ask(list(range(len(raws))))
    pending = [left] if left and len(raws) > 1 else []
    while pending:
        part = pending.pop(0)
        rest = ask(part)
        if rest and len(part) > 1:
            middle = (len(rest) + 1) // 2
            pending += [half for half in (rest[:middle], rest[middle:]) if half and len(half) < len(part)]
    return got


def extract_batches(refs: DataFrame, model: Callable[[list[str]], list[dict]] = rule_extractor, size: int = 50, cache: DataFrame | None = None, settings: str = "") -> DataFrame:
    """Every reference (``doc_id``, ``batch``, ``ref_idx``) with the :data:`FIELDS`, nulls where the model gave nothing, and its batch's ``cache_key`` and ``cached``.

    A batch of ``size`` goes to the model at once, unless ``cache`` (as :func:`cache_entries` gives it) has its key: then
    the model isn't asked. ``settings`` names what else the answer depends on, such as the model.
    """
    kept = batches(refs, size)
    lines = kept.groupBy("doc_id", "batch").agg(F.array_sort(F.collect_list(F.struct("line", "ref_idx", "text"))).alias("lines")).join(batch_keys(kept, settings), ["doc_id", "batch"])
    known = cache.groupBy("cache_key").agg(F.first("items").alias("items")) if cache is not None else None
    asked = lines.join(known, "cache_key", "left") if known is not None else lines.withColumn("items", F.lit(None).cast(f"array<struct<{ROW}>>"))
    index = refs.schema["ref_idx"]
    schema = T.StructType([refs.schema["doc_id"], T.StructField("batch", T.IntegerType()), T.StructField("cache_key", T.StringType()), T.StructField("cached", T.BooleanType()), index, *T._parse_datatype_string(f"struct<{ROW}>").fields])
    people = pa.list_(pa.struct([("family", pa.string()), ("given", pa.string())]))
    kinds = [pa.bool_(), pa.int64() if index.dataType == T.LongType() else pa.int32(), *(people if n == "authors" else pa.int32() if n == "year" else pa.string() for n in FIELDS)]

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            at, rows = [], []
            for i, (own, items) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                hit = items is not None and len(items) == len(own)
                for x, g in zip(own, items if hit else ask_model(model, [v["text"] or "" for v in own])):
                    at.append(i)
                    rows.append((hit, x["ref_idx"], *((g or {}).get(n) for n in FIELDS)))
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns[:3]), *(pa.array(c, t) for c, t in zip(columns, kinds))], schema.names)

    return asked.select("doc_id", "batch", "cache_key", "lines", "items").mapInArrow(run, schema)


def extract_all(refs: DataFrame, model: Callable[[list[str]], list[dict]] = rule_extractor, size: int = 50, cache: DataFrame | None = None, settings: str = "") -> DataFrame:
    """``doc_id``, ``ref_idx`` and the :data:`FIELDS` of every reference, as :func:`extract_batches`."""
    return extract_batches(refs, model, size, cache, settings).select("doc_id", "ref_idx", *FIELDS)


def cache_entries(extracted: DataFrame) -> DataFrame:
    """``cache_key`` and ``items``, the rows in order, of the batches of :func:`extract_batches` of which every line has a row; others are asked again next time."""
    whole = extracted.groupBy("doc_id", "batch", "cache_key").agg(F.bool_and(F.coalesce("title", "citation_key", F.get("authors", F.lit(0))["family"]).isNotNull()).alias("all"), F.array_sort(F.collect_list(F.struct("ref_idx", F.struct(*FIELDS).alias("row")))).alias("rows"))
    return whole.where("all").groupBy("cache_key").agg(F.first(F.transform("rows", lambda r: r["row"])).alias("items"))


def extraction_quality(rows: DataFrame) -> DataFrame:
    """By ``model``: share of references no row was placed at, and invented fields per 100 placed ones (``fields`` as P16 gives them, null where not placed)."""
    n = F.size(F.filter(F.split("fields", ","), lambda x: x != ""))
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_refs"), F.round(F.avg(F.col("fields").isNull().cast("int")), 4).alias("unplaced_share"), F.round(100 * F.sum(n) / F.nullif(F.count("fields"), F.lit(0)), 2).alias("invented_per_100")
    )


def cache_stats(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Batches by whether their ``cache_key`` is in ``cache``: ``cached`` or ``extracted``, with ``n``."""
    joined = wanted.join(cache.select("cache_key", F.lit(True).alias("__hit")).distinct(), "cache_key", "left")
    return joined.groupBy(F.when(F.col("__hit"), "cached").otherwise("extracted").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def newer_models(models: DataFrame) -> DataFrame:
    """``name`` and ``newer``: models of the same family with a higher version, sorted by it."""
    parsed = models.select("name", X.model_version("name").alias("v")).where("v IS NOT NULL").select("name", "v.version", "v.family")
    other = parsed.toDF("newer", "newer_version", "family")
    return parsed.join(other, "family").where("newer_version > version").select("name", "newer", "newer_version")
