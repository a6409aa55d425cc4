"""Repair of bibliographies: split entries, boilerplate, index runs, order, gaps.

All take a table with ``doc`` (key), ``ref_idx`` (order within it), ``page``, ``number`` and
``text`` and give one of the same columns; entries are ordered by ``ref_idx``, then by the columns
named in ``ties``. Other columns are kept where a row stays one row. A null page never counts as later
than another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions import text as X


def _order(doc: str, ties: tuple[str, ...], backwards: bool = False) -> WindowSpec:
    names = ("ref_idx", *ties)
    return Window.partitionBy(doc).orderBy(*(F.desc_nulls_last(n) if backwards else F.asc_nulls_first(n) for n in names))


def join_entry(head: Column, tail: Column) -> Column:
    """Two parts of an entry with one blank between, or none where the first ends in an address."""
    h, t = F.rtrim(head), F.ltrim(tail)
    last = F.regexp_extract(h, r"(?U)(\S+)$", 1)
    address = F.contains(last, F.lit("://")) | F.startswith(F.lower(last), F.lit("www."))
    return F.when(address, F.concat(h, t)).otherwise(F.concat(h, F.lit(" "), t))


def merge_split_entries(refs: DataFrame, doc: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """A fragment without a number that begins like a continuation joins the entry before it when it stands on a later page.

    Later means later than the page of the last entry that isn't a fragment; where pages never
    decrease this equals folding entry by entry. Gives ``doc``, ``ref_idx``, ``page``, ``number``
    and ``text`` of each whole entry; null texts count as no continuation.
    """
    w = _order(doc, ties)
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(w) == 1
    like = F.col("number").isNull() & X.leading_number("text").isNull() & X.looks_continued("text")
    rows = refs.withColumn("__whole", first | ~F.coalesce(like, F.lit(False)))
    base = F.last(F.when(F.col("__whole"), F.struct("page")), ignorenulls=True).over(so_far)["page"]
    rows = rows.withColumn("__joins", F.coalesce(~F.col("__whole") & (F.col("page") > base), F.lit(False)))
    rows = rows.withColumn("__entry", F.sum(F.when(F.col("__joins"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("__at", F.row_number().over(w))
    parts = rows.groupBy(doc, "__entry").agg(F.array_sort(F.collect_list(F.struct("__at", "ref_idx", "page", "number", "text"))).alias("parts"))
    head = F.col("parts")[0]
    whole = F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(1))), head["text"], lambda a, p: join_entry(a, p["text"]))
    text = F.when(F.size("parts") == 1, head["text"]).otherwise(whole)
    return parts.select(doc, head["ref_idx"].alias("ref_idx"), head["page"].alias("page"), head["number"].alias("number"), text.alias("text"))


def drop_trailing_boilerplate(refs: DataFrame, doc: str = "doc_id", ties: tuple[str, ...] = (), most: int = 3) -> DataFrame:
    """The run of boilerplate at the very end of a bibliography goes, at most three entries."""
    w = _order(doc, ties, backwards=True)
    rows = refs.withColumn("__n", F.row_number().over(w)).withColumn("__run", F.min(X.is_boilerplate("text")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where(~(F.col("__run") & (F.col("__n") <= most))).drop("__n", "__run")


def drop_index_entries(refs: DataFrame, doc: str = "doc_id", ties: tuple[str, ...] = (), least: int = 5) -> DataFrame:
    """A run of index lines that reaches the end of a bibliography goes when it has five or more."""
    w = _order(doc, ties, backwards=True)
    rows = refs.withColumn("__run", F.min(X.is_index_entry("text")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    length = F.count_if("__run").over(Window.partitionBy(doc))
    return rows.withColumn("__len", length).where(~(F.col("__run") & (F.col("__len") >= least))).drop("__run", "__len")


def sort_key() -> Column:
    """The printed number of an entry as an int: of ``number`` where there is one, else of the text's start; null where neither is clean."""
    own = F.trim("number")
    return F.when(F.col("number").isNotNull(), F.when(own.rlike(r"^[+-]?\d+$"), own.try_cast("int"))).otherwise(X.leading_number("text").try_cast("int"))


def _clean(doc: str) -> tuple[WindowSpec, Column]:
    all_of = Window.partitionBy(doc)
    return all_of, (F.count("__key").over(all_of) == F.count(F.lit(1)).over(all_of)) & (F.size(F.collect_set("__key").over(all_of)) == F.count(F.lit(1)).over(all_of))


def sort_by_number(refs: DataFrame, doc: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """O2: entries with ``position`` (from 0), by printed number where every entry has one and they run without gap or repeat, else as they stand."""
    rows = refs.withColumn("__key", sort_key())
    stats = rows.groupBy(doc).agg(
        ((F.count("__key") == F.count(F.lit(1))) & (F.countDistinct("__key") == F.count(F.lit(1))) & (F.max("__key") - F.min("__key") + 1 == F.count(F.lit(1)))).alias("__sorts")
    )
    rows = rows.join(stats, doc)
    order = Window.partitionBy(doc).orderBy(F.when(F.col("__sorts"), F.col("__key")).asc_nulls_first(), F.asc_nulls_first("ref_idx"), *(F.asc_nulls_first(t) for t in ties))
    return rows.withColumn("position", F.row_number().over(order) - 1).drop("__key", "__sorts")


def missing_numbers(refs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc`` and ``missing``, the numbers from 1 to the greatest that no entry has; for bibliographies whose numbers are clean, unique and incomplete."""
    rows = refs.select(doc, sort_key().alias("k"))
    stats = rows.groupBy(doc).agg(F.count("k").alias("clean"), F.count(F.lit(1)).alias("n"), F.collect_set("k").alias("have"), F.max("k").alias("top"))
    good = stats.where("clean = n AND size(have) = n AND top >= 1")
    return good.select(doc, F.array_except(F.sequence(F.lit(1), "top"), "have").alias("missing")).where("size(missing) > 0")


def recover_from_layer(entries: list[dict], layer: str, shortest: int = 20, prefix: int = 40) -> list[dict]:
    """J16 for one bibliography: entries with gaps filled from the text layer of the document.

    For each missing number the nearest present neighbours' beginnings bound a span of the layer; a
    span that holds the printed number exactly once, with twenty characters or more from there on, gives
    the entry, which then is a neighbour itself. The entry has no ``number`` and its predecessor's page.
    """
    flat = lambda s: re.sub(r"\s+", " ", re.sub(r"-\n(?=[a-z])", "", s or ""))

    def key(e: dict) -> int | None:
        if e["number"] is not None:
            return int(e["number"]) if re.fullmatch(r"\s*[+-]?\d+\s*", e["number"]) else None
        m = re.match(r"\s*\[?(\d+)[\]. ]?\s", e["text"] or "")
        return int(m.group(1)) if m else None

    keys = [key(e) for e in entries]
    if not keys or None in keys or len(set(keys)) < len(keys):
        return entries
    by_key = dict(zip(keys, entries))
    text, out = flat(layer), list(entries)
    for n in sorted(set(range(1, max(keys) + 1)) - set(keys)):
        below, above = max((k for k in by_key if k < n), default=None), min((k for k in by_key if k > n), default=None)
        if below is None or above is None:
            continue
        a, b = text.find(flat(by_key[below]["text"])[:prefix]), text.find(flat(by_key[above]["text"])[:prefix])
        if a < 0 or b <= a:
            continue
        hits = [m.start() for m in re.finditer(rf"(?:^|(?<=\s))\[?{n}[\].]\s", text[a:b])]
        found = text[a:b][hits[0] :].strip() if len(hits) == 1 else ""
        if len(found) < shortest:
            continue
        entry = {"page": by_key[below]["page"], "number": None, "text": found}
        out.insert(next(i for i, e in enumerate(out) if e is by_key[below]) + 1, entry)
        by_key[n] = entry
    return out


_ENTRY = "struct<page: int, number: string, text: string>"


def recover_missing(refs: DataFrame, layers: DataFrame, doc: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """Entries (``doc``, ``ref_idx``, ``page``, ``number``, ``text``) with gaps filled from ``layers`` (``doc``, ``layer_text``).

    Only bibliographies with a gap and a layer go to Python; all others pass as they are, renumbered from 0.
    """
    base = refs.select(doc, "ref_idx", "page", "number", "text", *ties)
    gaps = missing_numbers(base, doc).select(doc).join(layers.where("trim(coalesce(layer_text, '')) <> ''"), doc)
    w = _order(doc, ties)
    whole = base.withColumn("ref_idx", F.row_number().over(w) - 1)
    lists = whole.join(gaps, doc).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("ref_idx", "page", "number", "text"))).alias("entries"), F.first("layer_text").alias("layer_text"))
    schema = T.StructType([refs.schema[doc], T.StructField("ref_idx", T.IntegerType()), T.StructField("page", T.IntegerType()), T.StructField("number", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, (entries, layer) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                made = recover_from_layer(entries, layer)
                rows += [i] * len(made)
                out += [(k, e["page"], e["number"], e["text"]) for k, e in enumerate(made)]
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.string())))], schema.names)

    filled = lists.select(doc, "entries", "layer_text").mapInArrow(run, schema)
    rest = whole.join(gaps.select(doc), doc, "left_anti").select(doc, F.col("ref_idx").cast("int"), F.col("page").cast("int"), "number", "text")
    return rest.unionByName(filled)


def repair_references(refs: DataFrame, doc: str = "doc_id", layers: DataFrame | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Split entries joined, boilerplate dropped, gaps filled where ``layers`` is given, sorted; ``position`` is the final order."""
    rows = drop_trailing_boilerplate(merge_split_entries(refs, doc, ties), doc)
    if layers is not None:
        rows = recover_missing(rows, layers, doc)
    return sort_by_number(rows, doc)


def render_references(refs: DataFrame, doc: str = "doc_id", order: str = "ref_idx", ties: tuple[str, ...] = ()) -> DataFrame:
    """K6: ``doc`` and ``markdown``: for each page its marker and its entries, ``[number] text`` where there is a number; blank lines between.

    Entries without a page come first, without a marker.
    """
    line = F.when(F.coalesce("number", F.lit("")) != "", F.concat(F.lit("["), "number", F.lit("] "), "text")).otherwise(F.col("text"))
    pages = refs.groupBy(doc, "page").agg(F.array_sort(F.collect_list(F.struct(order, *ties, line.alias("line")))).alias("lines"))
    body = F.concat_ws("\n\n", X.page_marker("page"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n\n"))
    return pages.select(doc, "page", body.alias("body")).groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("page", F.lit(-1)).alias("p"), "body"))), lambda x: x["body"]), "\n\n").alias("markdown"))
