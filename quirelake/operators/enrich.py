"""Figures: captions found in the text, crops paired with them, descriptions put in place."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.functions import text as X

# The kinds of figure that a description may name.
FIGURE_TYPES = (
    "line_plot convergence_plot scatter_plot bar_chart contour_field_plot vector_flow_plot mesh_discretization geometry_schematic experimental_setup block_diagram "
    "nn_architecture phase_portrait time_series spectrum_plot heatmap_matrix graph_tree algorithm_listing table_image multi_panel_composite non_figure"
).split()
_CAPTION = re.compile("(?m)" + X.CAPTION)
_MARKER = re.compile(X.PAGE_MARKER)
GUTTER = 0.05


def lines_of(docs: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """``doc``, ``line_no`` (from 1), ``line`` and ``start`` (its offset in code points)."""
    split = F.split(F.col(text), "\n", -1)
    starts = F.aggregate(split, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda a, s: F.struct((a["at"] + F.length(s) + 1).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])
    return docs.select(doc, F.posexplode(F.arrays_zip(split.alias("line"), starts.alias("start"))).alias("p", "x")).select(doc, (F.col("p") + 1).alias("line_no"), F.col("x.line").alias("line"), F.col("x.start").alias("start"))


def page_at(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Lines with ``page``, that of the last page marker at or before them, null before the first."""
    own = F.element_at(F.col("__n"), -1)
    w = Window.partitionBy(doc).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("__n", X.page_numbers("line"))
    return rows.withColumn("page", F.last(F.when(F.size("__n") > 0, own), ignorenulls=True).over(w)).drop("__n")


def caption_lines(docs: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """every line that begins like a caption: ``doc``, ``line_no``, ``start``, ``page``, ``number``, ``caption``, ``upper``, ``line``."""
    rows = page_at(lines_of(docs, doc, text), doc).where(F.col("line").rlike(X.CAPTION))
    kind = F.regexp_extract("line", X.CAPTION, 1)
    return rows.select(doc, "line_no", "start", "page", F.regexp_extract("line", X.CAPTION, 2).alias("number"), F.trim(F.trim(F.trim(F.regexp_extract("line", X.CAPTION, 3)), F.lit("*"))).alias("caption"), (F.upper(kind) == kind).alias("upper"), "line")


def captions(docs: DataFrame, known: DataFrame | None = None, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """One caption for each figure number of a document: the first, but the first in capitals before any other.

    ``known`` (``doc``, ``text``) lists captions the layout model saw: a line whose number it covers
    must be the beginning of a known caption, or begin with one (J11). ``rank`` keeps the order in
    which the numbers were first met.
    """
    rows = caption_lines(docs, doc, text)
    if known is not None:
        k = known.select(doc, F.regexp_extract("text", X.CAPTION, 2).alias("number"), X.caption_text("text").alias("__k")).where("number <> ''")
        covered = k.select(doc, "number").distinct().withColumn("__c", F.lit(True))
        line = X.caption_text("line")
        # a match implies the same number, so the comparison is within it
        good = rows.withColumn("__l", line).join(k, [doc, "number"]).where(F.startswith(F.col("__k"), F.col("__l")) | F.startswith(F.col("__l"), F.col("__k"))).select(doc, "line_no").distinct().withColumn("__g", F.lit(True))
        rows = rows.join(covered, [doc, "number"], "left").join(good, [doc, "line_no"], "left").where("__c IS NULL OR __g").drop("__c", "__g")
    first = F.min("line_no").over(Window.partitionBy(doc, "number"))
    pick = F.row_number().over(Window.partitionBy(doc, "number").orderBy(F.desc("upper"), "line_no"))
    rows = rows.withColumns({"__first": first, "__n": pick}).where("__n = 1")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(doc).orderBy("__first")) - 1).drop("__first", "__n")


def axis_gap(a: Column, b: Column, axis: int) -> Column:
    """The gap of two boxes on an axis (0: x, 1: y); 0 where they overlap or touch."""
    return F.greatest(b[axis] - a[axis + 2], a[axis] - b[axis + 2], F.lit(0.0))


def nearest_captions(crops: DataFrame, regions: DataFrame) -> DataFrame:
    """``doc_id``, ``page``, ``crop_idx`` and ``cap_idx`` of the caption a crop overlaps on an axis at the least gap, then the least centre distance, then the first; null where it overlaps none."""
    pairs = crops.select("doc_id", "page", "crop_idx", F.col("bbox").alias("a")).join(regions.select("doc_id", "page", "cap_idx", F.col("bbox").alias("b")), ["doc_id", "page"], "left")
    x, y = axis_gap(F.col("a"), F.col("b"), 0), axis_gap(F.col("a"), F.col("b"), 1)
    centre = lambda i: (F.col("a")[i] + F.col("a")[i + 2] - F.col("b")[i] - F.col("b")[i + 2]) / 2
    able = F.col("cap_idx").isNotNull() & ~((x > 0) & (y > 0))
    key = F.struct(F.greatest(x, y), centre(0) * centre(0) + centre(1) * centre(1), "cap_idx")
    return pairs.groupBy("doc_id", "page", "crop_idx").agg(F.min_by("cap_idx", F.when(able, key)).alias("cap_idx"))


def _gaps(a, b) -> tuple[float, float]:
    return max(b[0] - a[2], a[0] - b[2], 0.0), max(b[1] - a[3], a[1] - b[3], 0.0)


def grow(boxes: list, members: set[int], captions_: list) -> set[int]:
    """J10, second half: on a page of one caption, crops a gutter (a twentieth of the page's span) from a member join, until none does."""
    everything = boxes + captions_
    near = GUTTER * ((max(b[2] for b in everything) - min(b[0] for b in everything)) or 1.0)
    todo, front = set(range(len(boxes))) - members, list(members)
    while front:
        m = front.pop()
        joins = {c for c in todo if min(g := _gaps(boxes[c], boxes[m])) == 0 and max(g) <= near}
        todo -= joins
        members |= joins
        front += sorted(joins)
    return members


def pair_crops(crops: DataFrame, regions: DataFrame) -> DataFrame:
    """``doc_id``, ``page``, ``crop_idx``, ``cap_idx`` for each crop that belongs to a caption.

    With all boxes of a page given, by O6, and on a page of one caption grown over its gutters; with
    any missing, one caption takes all crops and several pair by place.
    """
    page = ["doc_id", "page"]
    c = crops.groupBy(page).agg(F.min(F.col("bbox").isNotNull()).alias("boxed"))
    r = regions.groupBy(page).agg(F.min(F.col("bbox").isNotNull()).alias("cap_boxed"), F.count(F.lit(1)).alias("n_caps"))
    facts = c.join(r, page).withColumn("geometry", F.col("boxed") & F.col("cap_boxed")).select(*page, "geometry", "n_caps")
    rows = crops.join(facts, page)
    by_place = rows.where("NOT geometry").withColumn("__k", F.row_number().over(Window.partitionBy(page).orderBy("crop_idx")))
    caps = regions.withColumn("__k", F.row_number().over(Window.partitionBy(page).orderBy("cap_idx"))).select(*page, "__k", "cap_idx")
    placed = by_place.withColumn("__k", F.when(F.col("n_caps") == 1, 1).otherwise(F.col("__k"))).join(caps, [*page, "__k"]).select(*page, "crop_idx", "cap_idx")
    boxed = rows.where("geometry").select(*page, "crop_idx", "bbox", "n_caps")
    near = nearest_captions(boxed, regions)
    several = near.join(facts.where("n_caps > 1").select(*page), page)
    single = near.join(facts.where("geometry AND n_caps = 1").select(*page), page).join(crops.select(*page, "crop_idx", "bbox"), [*page, "crop_idx"])
    cap_box = regions.select(*page, F.col("cap_idx").alias("only"), F.col("bbox").alias("cap_bbox"))
    lists = single.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("crop_idx", "bbox", F.col("cap_idx").isNotNull().alias("in")))).alias("items")).join(cap_box, page)

    def over(items: pd.Series, boxes: pd.Series) -> pd.Series:
        out = []
        for rows_, cap in zip(items, boxes):
            members = {i for i, r_ in enumerate(rows_) if r_["in"]}
            if members:
                members = grow([list(r_["bbox"]) for r_ in rows_], members, [list(cap)])
            out.append([rows_[i]["crop_idx"] for i in sorted(members)])
        return pd.Series(out)

    over.__annotations__ = {"items": pd.Series, "boxes": pd.Series, "return": pd.Series}
    grown = lists.select(*page, "only", F.explode(F.pandas_udf(over, "array<int>")("items", "cap_bbox")).alias("crop_idx")).select(*page, "crop_idx", F.col("only").alias("cap_idx"))
    return placed.unionByName(several.where("cap_idx IS NOT NULL").select(*page, "crop_idx", "cap_idx")).unionByName(grown)


def crop_names(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """pairs with ``number`` and ``name``: ``fig_<number>``, with ``_<panel>`` in crop order where a figure has several."""
    w = Window.partitionBy("doc_id", "page", "cap_idx")
    rows = pairs.join(numbers, ["doc_id", "page", "cap_idx"])
    panel = F.row_number().over(w.orderBy("crop_idx"))
    safe = F.regexp_replace("number", r"[^\w.-]", "_")
    return rows.withColumn("name", F.concat(F.lit("fig_"), safe, F.when(F.count(F.lit(1)).over(w) > 1, F.concat(F.lit("_"), panel.cast("string"))).otherwise(""), F.lit(".png")))


def rename_placeholders(docs: DataFrame, named: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """documents whose crop placeholders carry the figure's number and file name; unpaired ones stay."""
    each = named.select(doc, F.concat(F.lit("![FIGURE_CROP "), F.col("page").cast("string"), F.lit(":"), F.col("crop_idx").cast("string"), F.lit("](")).alias("old"), F.concat(F.lit("![FIGURE "), "number", F.lit("]("), "name").alias("new"))
    lists = each.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("old", "new"))).alias("__names"))
    tail = lambda t, n: F.regexp_replace(t, F.concat(F.lit(r"\Q"), n["old"], F.lit(r"\E[^)]*")), n["new"])
    return docs.select(doc, text).join(lists, doc, "left").select(doc, F.when(F.col("__names").isNull(), F.col(text)).otherwise(F.aggregate("__names", F.col(text), tail)).alias("markdown"))


def paper_headers(docs: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """``doc``, ``title`` (first heading of level one) and ``abstract`` (the first prose paragraph of 300 characters, squeezed, cut at 2000); '' where there is none."""
    paragraphs = F.transform(F.split(F.col(text), "\n\n"), lambda p: F.trim(p, F.lit(" \n\t")))
    heads, prose = F.filter(paragraphs, lambda p: F.startswith(p, F.lit("# "))), F.filter(paragraphs, lambda p: X.is_prose(p) & (F.length(p) >= 300))
    title = X.caption_text(F.regexp_replace(F.get(heads, F.lit(0)), "^[# ]+", ""))
    return docs.select(doc, F.coalesce(title, F.lit("")).alias("title"), F.coalesce(F.substring(X.squeeze(F.get(prose, F.lit(0))), 1, 2000), F.lit("")).alias("abstract"))


def neighbour_context(docs: DataFrame, found: DataFrame, n: int = 2, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """``doc``, ``number``, ``before`` and ``after``: up to ``n`` prose paragraphs on each side of the caption's paragraph."""
    split = F.split(F.col(text), "\n\n", -1)
    starts = F.aggregate(split, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda a, s: F.struct((a["at"] + F.length(s) + 2).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])
    items = F.transform(F.arrays_zip(split.alias("p"), starts.alias("s")), lambda x: F.struct(x["s"].alias("s"), x["p"].alias("p"), X.is_prose(F.trim(x["p"], F.lit(" \n\t"))).alias("prose")))
    rows = docs.select(doc, items.alias("items")).join(found.select(doc, "number", F.col("start").alias("at")), doc)
    side = lambda keep: F.transform(F.filter("items", keep), lambda x: X.squeeze(x["p"]))
    own = F.array_max(F.transform(F.filter("items", lambda x: x["s"] <= F.col("at")), lambda x: x["s"]))
    rows = rows.withColumn("own", own)
    before, after = side(lambda x: x["prose"] & (x["s"] < F.col("own"))), side(lambda x: x["prose"] & (x["s"] > F.col("own")))
    return rows.select(doc, "number", F.array_join(F.slice(before, F.greatest(F.size(before) - n + 1, F.lit(1)), n), "\n\n").alias("before"), F.array_join(F.slice(after, 1, n), "\n\n").alias("after"))


def describe_tasks(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """one task for each figure with crops: ``doc_id``, ``page``, ``cap_idx``, ``paths`` in crop order and ``cache_key`` of their contents."""
    rows = pairs.join(files, ["doc_id", "page", "crop_idx"])
    lists = rows.groupBy("doc_id", "page", "cap_idx").agg(F.array_sort(F.collect_list(F.struct("crop_idx", "path", "sha256"))).alias("c"))
    return lists.select("doc_id", "page", "cap_idx", F.transform("c", lambda x: x["path"]).alias("paths"), F.sha2(F.concat_ws("|", F.transform("c", lambda x: x["sha256"])), 256).alias("cache_key"))


def no_describer(paths: list[str]) -> dict | None:
    """The offline describer: knows nothing."""
    return None


def describe_figures(tasks: DataFrame, cache: DataFrame | None = None, describer: Callable[[list[str]], dict | None] = no_describer) -> DataFrame:
    """Tasks with ``figure_type`` and ``description`` from ``cache`` (by ``cache_key``) or from ``describer``.

    One failing figure gives nulls and no error; a non-figure is described as such and left out when spliced.
    """
    known = tasks.join(cache, "cache_key", "left_semi").join(cache, "cache_key") if cache is not None else None
    rest = tasks.join(cache, "cache_key", "left_anti") if cache is not None else tasks
    schema = T.StructType([*rest.schema.fields, T.StructField("figure_type", T.StringType()), T.StructField("description", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = rest_names.index("paths")
        for batch in batches:
            kinds, texts = [], []
            for paths in batch.column(at).to_pylist():
                try:
                    made = describer(paths) or {}
                except Exception:  # a figure that can't be described stays without words
                    made = {}
                kinds.append(made.get("figure_type") if made.get("figure_type") in FIGURE_TYPES else None)
                texts.append(made.get("description") if kinds[-1] else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.string()), pa.array(texts, pa.string())], schema.names)

    rest_names = rest.columns
    made = rest.mapInArrow(run, schema)
    return made.unionByName(known.select(*schema.names)) if known is not None else made


def figure_stats(described: DataFrame, cache: DataFrame) -> DataFrame:
    """A10: figures by outcome: cached, described or failed."""
    hit = described.join(cache.select("cache_key", F.lit(True).alias("__h")).distinct(), "cache_key", "left")
    return hit.groupBy(F.when(F.col("__h"), "cached").when(F.col("description").isNotNull(), "described").otherwise("failed").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def splice_descriptions(docs: DataFrame, described: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """each description as a quoted block after its caption's line; ``described`` has ``doc``, ``start`` (of the caption's line), ``line``, ``figure_type``, ``description``."""
    label = F.concat(F.lit("\n\n> **Figure description (auto, "), F.regexp_replace("figure_type", "_", " "), F.lit("):** "), "description")
    at = F.col("start") + F.length("line")
    cuts = described.where("description IS NOT NULL AND figure_type <> 'non_figure'").groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), label.alias("put")))).alias("cuts"))
    joined = docs.select(doc, text).join(cuts, doc, "left")
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col("cuts"), i - 1)["at"])
    head = F.array_join(F.transform("cuts", lambda x, i: F.concat(F.substring(F.col(text), before(i) + 1, x["at"] - before(i)), x["put"])), "")
    tail = F.substring(F.col(text), F.element_at("cuts", -1)["at"] + 1, F.length(text))
    return joined.select(doc, F.when(F.size("cuts") > 0, F.concat(head, tail)).otherwise(F.col(text)).alias("markdown"))
