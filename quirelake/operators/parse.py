"""Layout regions to page-marked markdown, captions, crops and raw references.

``regions`` has ``doc_id``, ``page``, ``idx``, ``label``, ``native_label``, ``content``, ``bbox``
(x1, y1, x2, y2 or null) and ``image_path``; see :mod:`quirelake.schemas`.
"""

from __future__ import annotations

from functools import cmp_to_key

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions import blocks
from quirelake.functions import text as X

# Labels of the layout model by what becomes of their regions.
ABANDONED = ("header", "footer", "number", "aside_text", "footer_image", "header_image")
FORMULAS = ("display_formula", "inline_formula")
FIGURES = ("chart", "image")
#: Parts of the page's width: lines this near are level, and columns overlap at least so much; wider regions stand alone.
LEVEL, OVERLAP, WIDE = 0.01, 0.5, 0.6


def restore_labels(regions: DataFrame, raw: DataFrame) -> DataFrame:
    """``native_label`` taken from ``raw`` (``doc_id``, ``page``, ``position``, ``native_label``) by position, ``<div>`` tags taken off.

    A region without a counterpart keeps its content and has no native label.
    """
    at = regions.withColumn("position", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("idx")) - 1).drop("native_label")
    joined = at.join(raw.select("doc_id", "page", "position", "native_label"), ["doc_id", "page", "position"], "left")
    return joined.withColumn("content", F.trim(F.regexp_replace("content", r"(?i)</?div[^>]*>", ""))).drop("position")


def dispatch(regions: DataFrame) -> DataFrame:
    """Each region with ``kind`` (abandon, body, caption, reference, reference_number, figure) and ``out``, its markdown.

    The native label counts before the coarse one; an unknown or missing label is body text. Python
    sees the content of tables and algorithms only.
    """
    label = F.coalesce(X.or_null(F.col("native_label")), F.col("label"), F.lit(""))
    c = F.trim(F.coalesce("content", F.lit("")), F.lit(" \t\n\r"))
    one = lambda kind, out: F.struct(F.lit(kind).alias("kind"), out.alias("out"))
    empty = F.lit("")
    number = F.trim(c, F.lit("() "))
    rules = (
        (label.isin(*ABANDONED), one("abandon", empty)),
        (label.isin(*FORMULAS), one("body", X.wrap_formula(c))),
        (label.isin(*FIGURES), one("figure", empty)),
        (label == "doc_title", one("body", F.concat(F.lit("# "), X.strip_heading_prefix(c)))),
        (label == "paragraph_title", one("body", F.concat(F.lit("## "), X.strip_heading_prefix(c)))),
        ((label == "footnote") & (c == ""), one("abandon", empty)),
        (label == "footnote", one("body", F.concat(F.lit("> **Footnote:** "), c))),
        (label == "figure_title", one("caption", c)),
        (label == "reference", one("reference_number", c)),
        (label == "reference_content", one("reference", c)),
        (label == "table", one("body", F.col("__special"))),
        (label == "algorithm", one("body", F.col("__special"))),
        (label == "formula_number", one("body", F.when(c == "", "").otherwise(F.concat(F.lit("("), number, F.lit(")"))))),
    )
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, value)
    special = F.when(label == "table", blocks.html_table_column(F.when(label == "table", c))).when(label == "algorithm", blocks.fence_code_column(F.when(label == "algorithm", c)))
    return regions.withColumn("__special", special).withColumn("__d", chain.otherwise(one("body", c))).withColumns({"kind": F.col("__d.kind"), "out": F.col("__d.out")}).drop("__d", "__special")


def keep(regions: DataFrame) -> DataFrame:
    """Without abandoned regions."""
    return regions.where("kind <> 'abandon'")


def column_runs(regions: DataFrame) -> DataFrame:
    """O1, first half: regions with ``run``, numbered from 1 in index order; a run is as far as narrow neighbours share a column.

    A page with any malformed box has null ``run``: it stays in index order.
    """
    page = Window.partitionBy("doc_id", "page")
    order = page.orderBy(F.coalesce("idx", F.lit(0)))
    good = F.coalesce(F.size("bbox") == 4, F.lit(False)) & ~F.exists(F.coalesce("bbox", F.array(F.lit(None).cast("double"))), lambda v: v.isNull())
    rows = regions.withColumn("__good", F.min(good).over(page))
    at = lambda box, i: F.get(box, F.lit(i))
    width = F.max(at(F.col("bbox"), 2)).over(page) - F.min(at(F.col("bbox"), 0)).over(page)
    rows = rows.withColumn("__w", F.when(width == 0, 1.0).otherwise(width)).withColumn("__b", F.lag("bbox").over(order))
    a, b = F.col("__b"), F.col("bbox")
    wide = lambda x: (at(x, 2) - at(x, 0)) > WIDE * F.col("__w")
    shared = F.least(at(a, 2), at(b, 2)) - F.greatest(at(a, 0), at(b, 0)) > OVERLAP * F.least(at(a, 2) - at(a, 0), at(b, 2) - at(b, 0))
    goes_on = F.coalesce(a.isNotNull() & ~wide(a) & ~wide(b) & shared, F.lit(False))
    rows = rows.withColumn("__new", F.when(goes_on, 0).otherwise(1))
    return rows.withColumn("run", F.when(F.col("__good"), F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))).drop("__good", "__b", "__new").withColumnRenamed("__w", "page_width")


def _sorted_run(items: list, width: float) -> list[int]:
    def by_top(x, y):
        d = x[1] - y[1]
        return 0 if abs(d) <= LEVEL * width else (-1 if d < 0 else 1)

    return [i[0] for i in sorted(items, key=cmp_to_key(by_top))]


def reading_order(regions: DataFrame) -> DataFrame:
    """O1: regions with ``position`` (from 0) in reading order.

    Within a run of one column the top edge decides, tops within a hundredth of the page's width being
    level; that comparison isn't transitive, so runs in which two tops come that close are sorted by it in
    Python, all others natively.
    """
    rows = column_runs(regions).withColumn("__k", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(F.coalesce("idx", F.lit(0)))))
    rows = rows.withColumn("__run", F.coalesce("run", F.lit(0)))
    runs = rows.groupBy("doc_id", "page", "__run").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__k").alias("k"), F.when(F.col("run").isNotNull(), F.get("bbox", F.lit(1))).alias("top")))).alias("items"), F.first("page_width").alias("width")
    )

    def over(items: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([None if i is None else _sorted_run([(x["k"], x["top"]) for x in i], w) for i, w in zip(items, width)])

    over.__annotations__ = {"items": pd.Series, "width": pd.Series, "return": pd.Series}
    tops = F.array_sort(F.transform("items", lambda x: x["top"]))
    close = F.exists(F.sequence(F.lit(1), F.greatest(F.size("items") - 1, F.lit(1))), lambda i: (F.size("items") > 1) & (F.get(tops, i) - F.get(tops, i - 1) <= LEVEL * F.col("width")))
    close = F.coalesce(close, F.lit(False)) & (F.col("__run") > 0)
    native = F.transform(F.array_sort(F.transform("items", lambda x: F.struct(x["top"].alias("top"), x["k"].alias("k")))), lambda x: x["k"])
    fuzzy = F.pandas_udf(over, "array<int>")(F.when(close, F.col("items")), "width")
    ks = F.when(F.col("__run") == 0, F.transform("items", lambda x: x["k"])).when(close, fuzzy).otherwise(native)
    placed = runs.select("doc_id", "page", "__run", F.posexplode(ks).alias("__at", "__k"))
    joined = rows.drop("__run").join(placed, ["doc_id", "page", "__k"])
    order = Window.partitionBy("doc_id", "page").orderBy("__run", "__at")
    return joined.withColumn("position", F.row_number().over(order) - 1).drop("__k", "__run", "__at", "run", "page_width")


def pair_numbers(rows: DataFrame) -> DataFrame:
    """A reference number joined to the reference next to it (either side, the number's own next first), as ``number``.

    Greedy from the left within a page, by a native fold over its regions; a number without a partner
    goes, a reference without one has null. ``rows`` has ``position``, ``kind`` and ``out``.
    """
    item = F.struct("position", "kind", "out")
    pages = rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    bare = lambda t: F.trim(F.trim(F.trim(t), F.lit("[]().")))
    made = lambda x, n: F.struct(x["position"].alias("position"), x["kind"].alias("kind"), x["out"].alias("out"), n.alias("number"))
    none = F.lit(None).cast("string")
    state = F.struct(F.array().cast("array<struct<position:int,kind:string,out:string,number:string>>").alias("done"), F.lit(None).cast("struct<position:int,kind:string,out:string>").alias("held"))
    held_as = lambda s: F.when(s["held"].isNull() | (s["held"]["kind"] == "reference_number"), s["done"]).otherwise(F.concat(s["done"], F.array(made(s["held"], none))))

    def step(s: Column, x: Column) -> Column:
        pair = ((s["held"]["kind"] == "reference_number") & (x["kind"] == "reference")) | ((s["held"]["kind"] == "reference") & (x["kind"] == "reference_number"))
        joined = F.when(x["kind"] == "reference", made(x, bare(s["held"]["out"]))).otherwise(made(s["held"], bare(x["out"])))
        blank = F.lit(None).cast("struct<position:int,kind:string,out:string>")
        return F.when(F.coalesce(pair, F.lit(False)), F.struct(F.concat(s["done"], F.array(joined)).alias("done"), blank.alias("held"))).otherwise(F.struct(held_as(s).alias("done"), x.alias("held")))

    cast = F.transform("items", lambda x: F.struct(x["position"].cast("int").alias("position"), x["kind"].alias("kind"), x["out"].alias("out")))
    folded = F.aggregate(cast, state, step, held_as)
    return pages.select("doc_id", "page", F.explode(folded).alias("x")).select("doc_id", "page", "x.*")


def reclaim_references(rows: DataFrame) -> DataFrame:
    """Body regions that begin like an entry and stand beside references, directly or through their like, become references.

    The closed form of repeating it until nothing changes: in every longest run of references and such
    regions that holds a reference, all are references.
    """
    order = Window.partitionBy("doc_id", "page").orderBy("position")
    able = (F.col("kind") == "reference") | ((F.col("kind") == "body") & F.col("out").rlike(X.MISLABELED_ENTRY))
    rows = rows.withColumn("__able", F.coalesce(able, F.lit(False)))
    rows = rows.withColumn("__run", F.sum(F.when(F.col("__able"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "page", "__run", "__able")
    has = F.max(F.col("kind") == "reference").over(run)
    return rows.withColumn("kind", F.when(F.col("__able") & has, "reference").otherwise(F.col("kind"))).drop("__able", "__run")


def emit(rows: DataFrame) -> DataFrame:
    """P5: regions with text, figures as placeholder lines; ``crop_idx`` counts the figures of a page from 0, ``body`` says what goes into the page."""
    order = Window.partitionBy("doc_id", "page").orderBy("position")
    figure = F.col("kind") == "figure"
    kept = rows.where(figure | (F.trim(F.coalesce("out", F.lit("")), F.lit(" \t\n")) != ""))
    kept = kept.withColumn("crop_idx", F.when(figure, F.count_if(figure).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1))
    line = F.concat(F.lit("![FIGURE_CROP "), F.col("page").cast("string"), F.lit(":"), F.col("crop_idx").cast("string"), F.lit("](crops/p"), F.col("page").cast("string"), F.lit("_"), F.col("crop_idx").cast("string"), F.lit(".png)"))
    return kept.withColumn("body", F.when(figure, line).when(F.col("kind").isin("body", "caption"), F.col("out")))


def assemble(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """``doc_id`` and ``markdown``: for each page of ``pages`` its marker, then its body parts, blank lines between."""
    parts = rows.where("body IS NOT NULL").groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "body"))), lambda x: x["body"]), "\n\n").alias("body"))
    each = pages.select("doc_id", "page").distinct().join(parts, ["doc_id", "page"], "left").select("doc_id", "page", F.concat_ws("\n\n", X.page_marker("page"), "body").alias("part"))
    return each.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "part"))), lambda x: x["part"]), "\n\n").alias("markdown"))


def raw_references(rows: DataFrame) -> DataFrame:
    """The references that the pages hold, as ``doc_id``, ``ref_idx``, ``page``, ``number`` and ``text``."""
    order = Window.partitionBy("doc_id").orderBy("page", "position")
    return rows.where("kind = 'reference'").select("doc_id", (F.row_number().over(order) - 1).alias("ref_idx"), "page", "number", F.col("out").alias("text"))


def parse_regions(regions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Regions to (markdown, captions, references): O1, P1 to P6 in their order."""
    ordered = keep(dispatch(reading_order(regions)))
    rows = emit(reclaim_references(pair_numbers(ordered)))
    captions = rows.where("kind = 'caption'").select("doc_id", "page", "position", F.col("out").alias("text"))
    return assemble(rows, regions), captions, raw_references(rows)


def match_crops(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """``doc_id``, ``page``, ``crop_idx`` with ``path``: the file of the wanted name, else the first unused one of the page, else null.

    ``wanted`` has ``image_path``; ``files`` has ``doc_id``, ``name`` and ``page``.
    """
    exact = wanted.join(files.select("doc_id", F.col("name").alias("path")), (wanted["image_path"] == F.col("path")) & (wanted["doc_id"] == files["doc_id"]), "left").select(wanted["*"], "path")
    left = exact.where("path IS NULL").withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("crop_idx"))).drop("path")
    used = exact.where("path IS NOT NULL").select("doc_id", F.col("path").alias("name"))
    free = files.join(used, ["doc_id", "name"], "left_anti").withColumn("__n", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("name"))).select("doc_id", "page", "__n", F.col("name").alias("path"))
    fallback = left.join(free, ["doc_id", "page", "__n"], "left").drop("__n")
    return exact.where("path IS NOT NULL").unionByName(fallback)


def page_parts(pages: DataFrame, most: int = 100) -> DataFrame:
    """Pages (``doc_id``, ``page`` from 1) with ``part`` and ``page_in_part``; a document within ``most`` pages is one part."""
    return pages.withColumns({"part": F.floor((F.col("page") - 1) / most).cast("int"), "page_in_part": (F.pmod(F.col("page") - 1, F.lit(most)) + 1).cast("int")})


def merge_parts(parts: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``part``, ``page``) with ``page`` counted through the parts before, whose ``n_pages`` ``parts`` tells."""
    before = F.coalesce(F.sum("n_pages").over(Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = parts.select("doc_id", "part", before.alias("__before"))
    return rows.join(shift, ["doc_id", "part"]).withColumn("page", (F.col("page") + F.col("__before")).cast("int")).drop("__before")
