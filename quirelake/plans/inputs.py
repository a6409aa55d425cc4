"""The domain's tables in the shapes that the operators read, each with the SQL that gives the same.

The SQL strings are common table expressions that the queries' oracles begin with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.session import table


def docs(spark: SparkSession, root: str) -> DataFrame:
    """Parsed papers: ``doc_id`` and ``markdown``."""
    return table(spark, root, "parse_results").select(F.col("paper_id").alias("doc_id"), "markdown")


DOCS = "docs AS (SELECT paper_id AS doc_id, markdown FROM parse_results)"


def refs(spark: SparkSession, root: str) -> DataFrame:
    """Raw references: ``doc_id``, ``ref_idx`` (place in the bibliography, rows loaded twice one after the other), ``page``, ``number``, ``text``, ``ref_id``."""
    place = F.row_number().over(Window.partitionBy("paper_id").orderBy("ref_idx", "ref_id")) - 1
    return table(spark, root, "raw_refs").select(F.col("paper_id").alias("doc_id"), place.alias("ref_idx"), "page", F.col("ref_number").alias("number"), "text", "ref_id")


REFS = (
    "refs AS (SELECT paper_id AS doc_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY ref_idx, ref_id) - 1 AS INTEGER) AS ref_idx, page, ref_number AS number, text, ref_id FROM raw_refs)"
)


def extracted(spark: SparkSession, root: str) -> DataFrame:
    """The first extraction of each raw reference beside it, nulls where there is none; ``raw_text`` is the printed entry."""
    rows = table(spark, root, "extracted_refs")
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy("ref_id").orderBy("ext_id"))).where("__n = 1").drop("__n")
    raw = refs(spark, root).withColumnRenamed("text", "raw_text")
    return raw.join(first, "ref_id", "left").select("doc_id", "ref_idx", "ref_id", "raw_text", "number", "page", "ext_id", "citation_key", "title", "authors", "year", "doi", "container_title", "volume", "page_range")


EXTRACTED = (
    REFS + ", firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY ext_id) AS n FROM extracted_refs) WHERE n = 1)"
    ", extracted AS (SELECT r.doc_id, r.ref_idx, r.ref_id, r.text AS raw_text, r.number, r.page, f.ext_id, f.citation_key, f.title, f.authors, f.year, f.doi, f.container_title, f.volume, f.page_range FROM refs r LEFT JOIN firsts f ON r.ref_id = f.ref_id)"
)


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Catalogue records as candidates, the providers named as the rules know them."""
    provider = F.when(F.col("provider") == "semantic_scholar", "semanticscholar").otherwise(F.col("provider"))
    return table(spark, root, "candidates").select("cand_id", "title", "authors", "year", "doi", F.lit(None).cast("string").alias("abstract"), provider.alias("source"), "provider_type")


def paragraphs(spark: SparkSession, root: str) -> DataFrame:
    """Paragraphs of the papers: ``doc_id``, ``idx`` (from 0) and ``paragraph``."""
    return docs(spark, root).select("doc_id", F.posexplode(F.split("markdown", "\n\n", -1)).alias("idx", "paragraph"))


PARAGRAPHS = (
    DOCS + ", split AS (SELECT doc_id, string_split(markdown, chr(10) || chr(10)) AS ps FROM docs)"
    ", paragraphs AS (SELECT doc_id, CAST(unnest(generate_series(0, len(ps) - 1)) AS INTEGER) AS idx, unnest(ps) AS paragraph FROM split)"
)


def lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the papers: ``doc_id``, ``line_no`` (from 1) and ``line``."""
    return docs(spark, root).select("doc_id", F.posexplode(F.split("markdown", "\n", -1)).alias("p", "line")).select("doc_id", (F.col("p") + 1).alias("line_no"), "line")


LINES = (
    DOCS + ", cut AS (SELECT doc_id, string_split(markdown, chr(10)) AS ls FROM docs)"
    ", lines AS (SELECT doc_id, CAST(unnest(generate_series(1, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line FROM cut)"
)

_REGION_LABEL = """CASE WHEN idx = 0 THEN 'doc_title' WHEN paragraph LIKE '#%' THEN 'paragraph_title' WHEN paragraph LIKE '$$%' THEN 'display_formula'
    WHEN idx % 11 = 5 THEN 'header' WHEN idx % 13 = 6 THEN 'footnote' WHEN idx % 17 = 7 THEN 'stamp' WHEN idx % 19 = 8 THEN 'chart' WHEN idx % 7 = 3 THEN 'figure_title' ELSE 'text' END"""


def regions(spark: SparkSession, root: str) -> DataFrame:
    """Layout regions made of the papers' paragraphs, twelve to a page in two columns, with a label by content and place; every third neighbour swapped in index order."""
    rows = paragraphs(spark, root).withColumn("label", F.expr(_REGION_LABEL))
    rows = rows.withColumns({"page": F.expr("CAST(idx DIV 12 + 1 AS INT)"), "k": F.expr("CAST(idx % 12 AS INT)")})
    swapped = F.expr("CASE WHEN k % 6 = 1 THEN k + 1 WHEN k % 6 = 2 THEN k - 1 ELSE k END")
    box = F.expr("array(CAST(IF(k < 6, 50, 520) AS DOUBLE), CAST(100 + 130 * (k % 6) AS DOUBLE), CAST(IF(k < 6, 480, 950) AS DOUBLE), CAST(200 + 130 * (k % 6) AS DOUBLE))")
    return rows.select(F.col("doc_id"), "page", swapped.cast("int").alias("idx"), F.lit("text").alias("label"), F.col("label").alias("native_label"), F.col("paragraph").alias("content"), box.alias("bbox"), F.lit(None).cast("string").alias("image_path"))


REGIONS = (
    PARAGRAPHS + f", labelled AS (SELECT doc_id, idx, paragraph, CAST(idx // 12 + 1 AS INTEGER) AS page, CAST(idx % 12 AS INTEGER) AS k, {_REGION_LABEL} AS label FROM paragraphs)"
    # a page of one column has only wide regions, which stay in index order
    ", swapped AS (SELECT *, CAST(CASE WHEN k % 6 = 1 THEN k + 1 WHEN k % 6 = 2 THEN k - 1 ELSE k END AS INTEGER) AS idx_in_page, max(k) OVER (PARTITION BY doc_id, page) AS top FROM labelled)"
    ", regions AS (SELECT doc_id, page, idx_in_page AS idx, CASE WHEN top <= 5 THEN CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY idx_in_page) - 1 AS INTEGER) ELSE k END AS position, label, paragraph AS content FROM swapped)"
)


def reference_regions(spark: SparkSession, root: str) -> DataFrame:
    """Regions of bibliography pages, forty entries to a page: an entry's number as its own region before it (every third) or after it (every fourth of the rest), every fifth mislabelled as body, a heading on each page."""
    rows = refs(spark, root).withColumn("page", F.expr("CAST(ref_idx DIV 40 + 1 AS INT)"))
    number = F.expr("concat('[', CAST(ref_idx + 1 AS STRING), ']')")
    text = F.when(F.expr("ref_idx % 5 = 4"), F.concat(number, F.lit(" "), "text")).otherwise(F.col("text"))
    kind = F.when(F.expr("ref_idx % 5 = 4"), "body").otherwise("reference")
    entry = rows.select("doc_id", "page", (F.col("ref_idx") * 3 + 1).alias("position"), kind.alias("kind"), text.alias("out"))
    before = rows.where("ref_idx % 5 <> 4 AND ref_idx % 3 = 0").select("doc_id", "page", (F.col("ref_idx") * 3).alias("position"), F.lit("reference_number").alias("kind"), number.alias("out"))
    after = rows.where("ref_idx % 5 <> 4 AND ref_idx % 3 <> 0 AND ref_idx % 4 = 0").select("doc_id", "page", (F.col("ref_idx") * 3 + 2).alias("position"), F.lit("reference_number").alias("kind"), number.alias("out"))
    head = rows.select("doc_id", "page").distinct().select("doc_id", "page", F.lit(-1).alias("position"), F.lit("body").alias("kind"), F.lit("## References").alias("out"))
    return entry.unionByName(before).unionByName(after).unionByName(head)


REFERENCE_REGIONS = (
    REFS + ", paged AS (SELECT *, CAST(ref_idx // 40 + 1 AS INTEGER) AS p, '[' || CAST(ref_idx + 1 AS VARCHAR) || ']' AS mark FROM refs)"
    ", ref_regions AS (SELECT doc_id, p AS page, ref_idx * 3 + 1 AS position, CASE WHEN ref_idx % 5 = 4 THEN 'body' ELSE 'reference' END AS kind, CASE WHEN ref_idx % 5 = 4 THEN mark || ' ' || text ELSE text END AS out FROM paged"
    " UNION ALL SELECT doc_id, p, ref_idx * 3, 'reference_number', mark FROM paged WHERE ref_idx % 5 <> 4 AND ref_idx % 3 = 0"
    " UNION ALL SELECT doc_id, p, ref_idx * 3 + 2, 'reference_number', mark FROM paged WHERE ref_idx % 5 <> 4 AND ref_idx % 3 <> 0 AND ref_idx % 4 = 0"
    " UNION ALL SELECT DISTINCT doc_id, p, -1, 'body', '## References' FROM paged)"
)


def lookups(spark: SparkSession, root: str) -> DataFrame:
    """Provider lookups made of the event stream: an error is a 429, a search misses."""
    rows = table(spark, root, "events")
    provider = F.element_at(F.array(F.lit("crossref"), F.lit("openalex"), F.lit("semanticscholar")), (F.col("user_id") % 3 + 1).cast("int"))
    outcome = F.when(F.col("event_type").isin("error", "view"), "429").when(F.col("event_type") == "search", "missing").otherwise("ok")
    return rows.select("event_id", "ts", provider.alias("provider"), outcome.alias("outcome"))


LOOKUPS = (
    "lookups AS (SELECT event_id, ts, CASE user_id % 3 WHEN 0 THEN 'crossref' WHEN 1 THEN 'openalex' ELSE 'semanticscholar' END AS provider,"
    " CASE WHEN event_type IN ('error', 'view') THEN '429' WHEN event_type = 'search' THEN 'missing' ELSE 'ok' END AS outcome FROM events)"
)
