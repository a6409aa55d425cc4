"""Queries of parsing, bibliography repair and chunking over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.functions import text as X
from quirelake.operators import chunk as C
from quirelake.operators import parse as P
from quirelake.operators import references as R
from quirelake.plans import inputs as I
from quirelake.session import table

TIES = ("ref_id",)
_MARK = r"<page_number>\s*(\d+)\s*</page_number>"


def parse1_dispatch(spark: SparkSession, root: str) -> DataFrame:
    return P.dispatch(I.regions(spark, root)).select("doc_id", "page", "idx", "kind", "out")


def parse2_kept(spark: SparkSession, root: str) -> DataFrame:
    return P.keep(P.dispatch(I.regions(spark, root))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def parse3_pairs(spark: SparkSession, root: str) -> DataFrame:
    return P.pair_numbers(I.reference_regions(spark, root)).select("doc_id", F.col("page").cast("int").alias("page"), "position", "kind", "out", "number")


def parse4_reclaimed(spark: SparkSession, root: str) -> DataFrame:
    return P.reclaim_references(I.reference_regions(spark, root)).select("doc_id", "page", F.col("position").cast("int").alias("position"), "kind", "out")


def _ordered(spark: SparkSession, root: str) -> DataFrame:
    return P.keep(P.dispatch(P.reading_order(I.regions(spark, root))))


def parse5_emitted(spark: SparkSession, root: str) -> DataFrame:
    rows = P.emit(_ordered(spark, root).withColumn("number", F.lit(None).cast("string")))
    return rows.where("body IS NOT NULL").select("doc_id", "page", "position", F.col("crop_idx").cast("int").alias("crop_idx"), "body")


def parse6_markdown(spark: SparkSession, root: str) -> DataFrame:
    return P.parse_regions(I.regions(spark, root))[0]


def parse7_crops(spark: SparkSession, root: str) -> DataFrame:
    figures = P.emit(_ordered(spark, root).withColumn("number", F.lit(None).cast("string"))).where("kind = 'figure'")
    wanted = figures.select("doc_id", "page", F.col("crop_idx").cast("int").alias("crop_idx"), F.concat(F.lit("p"), "page", F.lit("_"), "crop_idx", F.lit(".png")).alias("image_path"))
    files = wanted.select("doc_id", F.when(F.col("page") % 2 == 0, F.col("image_path")).otherwise(F.concat(F.lit("scan_"), "image_path")).alias("name"), "page")
    return P.match_crops(wanted, files)


def o1_runs(spark: SparkSession, root: str) -> DataFrame:
    return P.column_runs(I.regions(spark, root)).select("doc_id", "page", "idx", F.col("run").cast("int").alias("run"))


def o1_reading_order(spark: SparkSession, root: str) -> DataFrame:
    return P.reading_order(I.regions(spark, root)).select("doc_id", "page", F.col("position").cast("int").alias("position"), "native_label", "content")


def s2_parts(spark: SparkSession, root: str) -> DataFrame:
    pages = I.docs(spark, root).select("doc_id", F.explode(X.page_numbers("markdown")).alias("page"))
    return P.page_parts(pages).select("doc_id", "page", "part", "page_in_part")


def s4_labels(spark: SparkSession, root: str) -> DataFrame:
    regions = I.regions(spark, root)
    raw = regions.withColumn("position", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("idx")) - 1).select("doc_id", "page", "position", "native_label")
    plain = regions.withColumns({"native_label": F.lit(None).cast("string"), "content": F.concat(F.lit('<div align="center">'), "content", F.lit("</div>"))})
    return P.restore_labels(plain, raw).select("doc_id", "page", "idx", "native_label", "content")


def w19_offset_pages(spark: SparkSession, root: str) -> DataFrame:
    papers = table(spark, root, "parse_results").select(F.col("lib_id").alias("doc_id"), "paper_id", F.coalesce("n_pages", F.lit(1)).alias("n_pages"))
    parts = papers.withColumn("part", F.row_number().over(Window.partitionBy("doc_id").orderBy("paper_id")) - 1)
    rows = parts.select("doc_id", "part", "paper_id", F.lit(1).alias("page"))
    return P.merge_parts(parts, rows).select(F.col("doc_id").alias("lib_id"), "paper_id", F.col("page").alias("first_page"))


def w7_merged_entries(spark: SparkSession, root: str) -> DataFrame:
    return R.merge_split_entries(I.refs(spark, root), ties=TIES).select("doc_id", "ref_idx", "page", "number", "text")


def w8_without_boilerplate(spark: SparkSession, root: str) -> DataFrame:
    rows = I.refs(spark, root)
    noted = rows.withColumn("text", F.when(F.col("ref_id") % 3 == 0, F.concat(F.lit("Copyright © the authors. "), "text")).otherwise(F.col("text")))
    return R.drop_trailing_boilerplate(noted, ties=TIES).select("ref_id")


def w9_without_index(spark: SparkSession, root: str) -> DataFrame:
    return R.drop_index_entries(I.refs(spark, root), ties=TIES, least=1).select("ref_id")


def o2_sorted_refs(spark: SparkSession, root: str) -> DataFrame:
    return R.sort_by_number(I.refs(spark, root), ties=TIES).select("ref_id", F.col("position").cast("int").alias("position"))


def _numbered(spark: SparkSession, root: str) -> DataFrame:
    """The first entry of each printed number; entries without one take part with their number read from the text, where no other has it."""
    rows = I.refs(spark, root).withColumn("number", F.coalesce("number", X.leading_number("text")))
    first = F.row_number().over(Window.partitionBy("doc_id", "number").orderBy("ref_idx", "ref_id"))
    return rows.withColumn("__n", first).where("number IS NOT NULL AND __n = 1").drop("__n")


def a5_missing_numbers(spark: SparkSession, root: str) -> DataFrame:
    gaps = R.missing_numbers(_numbered(spark, root))
    return gaps.select("doc_id", F.explode("missing").alias("number"))


def j16_recovered(spark: SparkSession, root: str) -> DataFrame:
    rows = _numbered(spark, root)
    layers = rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_idx", F.concat("number", F.lit(". "), "text").alias("t")))), lambda x: x["t"]), "\n").alias("layer_text"))
    holed = rows.where("number NOT IN ('2', '5')").withColumn("text", F.concat("number", F.lit(". "), "text")).withColumn("number", F.lit(None).cast("string"))
    return R.recover_missing(holed, layers)


def k6_references_markdown(spark: SparkSession, root: str) -> DataFrame:
    return R.render_references(I.refs(spark, root), ties=TIES)


def g5_repaired(spark: SparkSession, root: str) -> DataFrame:
    return R.repair_references(I.refs(spark, root), ties=TIES).select("doc_id", F.col("position").cast("int").alias("position"), "page", "number", "text")


def c1_sections(spark: SparkSession, root: str) -> DataFrame:
    return C.split_sections(I.docs(spark, root))


def c3_chunks(spark: SparkSession, root: str) -> DataFrame:
    return C.chunk_markdown(I.docs(spark, root))


def w1_pages(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "chunks").withColumn("idx", F.row_number().over(Window.partitionBy("paper_id").orderBy("chunk_index", "chunk_id")))
    return C.inherit_pages(rows, "paper_id").select("chunk_id", "page_start", "page_end")


def w2_merged(spark: SparkSession, root: str) -> DataFrame:
    rows = I.docs(spark, root).select("doc_id", F.posexplode(C.merge_small(F.split("markdown", "\n\n", -1), 1000)).alias("piece", "text"))
    return rows.select("doc_id", "piece", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("md5"))


def w5_without_back_matter(spark: SparkSession, root: str) -> DataFrame:
    """Papers with their own bibliography put behind them under a heading, which has to go again."""
    entries = R.render_references(I.refs(spark, root), ties=TIES).select("doc_id", F.col("markdown").alias("refs"))
    whole = I.docs(spark, root).join(entries, "doc_id", "left").select("doc_id", F.concat_ws("\n\n", "markdown", F.concat(F.lit("# References\n\n"), "refs")).alias("markdown"))
    return C.drop_back_matter(whole)


def _refined(spark: SparkSession, root: str):
    """Every paper from regions on: body regions and bibliography pages as one document."""
    from quirelake.operators.pipeline import refine

    body = I.regions(spark, root)
    pages = body.groupBy("doc_id").agg(F.max("page").alias("last"))
    entries = I.refs(spark, root).join(pages, "doc_id")
    none = F.lit(None).cast("string")
    cited = entries.select("doc_id", (F.col("last") + 1 + F.floor(F.col("ref_idx") / 40)).cast("int").alias("page"), F.col("ref_idx").alias("idx"), F.lit("text").alias("label"), F.lit("reference_content").alias("native_label"), F.col("text").alias("content"), F.lit(None).cast("array<double>").alias("bbox"), none.alias("image_path"))
    return refine(body.unionByName(cited), I.catalogue(spark, root), misses=False)


def b1_refined(spark: SparkSession, root: str) -> DataFrame:
    return _refined(spark, root).chunks.select("doc_id", "idx", "page_start", "page_end", "overlap_chars", "overlap_mode", "text")


def b1_links(spark: SparkSession, root: str) -> DataFrame:
    """Of the same run, by document: its marker style, markers linked and refused, references, those with authors read, those resolved."""
    made = _refined(spark, root)
    refs = made.extracted.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_refs"), F.count_if(F.size("authors") > 0).alias("n_with_authors"))
    resolved = made.resolved.groupBy("doc_id").agg(F.count_if("verified").alias("n_resolved"))
    links = made.links.select("doc_id", "style", F.size("markers").alias("n_markers"), F.size("ambiguous").alias("n_refused"))
    return links.join(refs, "doc_id", "left").join(resolved, "doc_id", "left")


QUERIES = {
    n: f
    for n, f in globals().items()
    if callable(f) and n in (
        "parse1_dispatch parse2_kept parse3_pairs parse4_reclaimed parse5_emitted parse6_markdown parse7_crops o1_runs o1_reading_order s2_parts s4_labels w19_offset_pages w7_merged_entries w8_without_boilerplate "
        "w9_without_index o2_sorted_refs a5_missing_numbers j16_recovered k6_references_markdown g5_repaired c1_sections c3_chunks w1_pages w2_merged w5_without_back_matter b1_refined b1_links"
    ).split()
}

_TRIM = "trim(coalesce({0}, ''), ' ' || chr(9) || chr(10) || chr(13))"
_C = _TRIM.format("content")
_FORMULA = r"'$$' || chr(10) || trim(regexp_replace(trim(regexp_replace(trim(c), '^\$\$', '')), '\$\$$', '')) || chr(10) || '$$'"
_DISPATCH = f"""{I.REGIONS}, src AS (SELECT doc_id, page, idx, position, label, {_C} AS c FROM regions),
    dispatched AS (SELECT doc_id, page, idx, position, CASE WHEN label = 'header' OR (label = 'footnote' AND c = '') THEN 'abandon' WHEN label = 'chart' THEN 'figure' WHEN label = 'figure_title' THEN 'caption' ELSE 'body' END AS kind,
        CASE WHEN label IN ('header', 'chart') OR (label = 'footnote' AND c = '') THEN '' WHEN label = 'display_formula' THEN {_FORMULA}
            WHEN label IN ('doc_title', 'paragraph_title') THEN CASE label WHEN 'doc_title' THEN '# ' ELSE '## ' END || regexp_replace(regexp_replace(trim(c), '^[-*] \\s*', ''), '^#+\\s*', '')
            WHEN label = 'footnote' THEN '> **Footnote:** ' || c ELSE c END AS out FROM src)"""
_KEPT = _DISPATCH + """, kept AS (SELECT * FROM dispatched WHERE kind <> 'abandon'),
    emitted AS (SELECT doc_id, page, position, kind, out, CAST(CASE WHEN kind = 'figure' THEN sum(CASE WHEN kind = 'figure' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY position) - 1 END AS INTEGER) AS crop_idx
        FROM kept WHERE kind = 'figure' OR trim(out, ' ' || chr(9) || chr(10)) <> ''),
    bodies AS (SELECT doc_id, page, position, kind, crop_idx, CASE WHEN kind = 'figure' THEN '![FIGURE_CROP ' || page || ':' || crop_idx || '](crops/p' || page || '_' || crop_idx || '.png)' ELSE out END AS body FROM emitted)"""
_CONT = r"""(number IS NULL AND regexp_extract(text, '^\s*\[?(\d+)[\]. ]?\s', 1) = '' AND regexp_matches(ltrim(text), '^\p{Ll}')
    AND lower(rtrim(regexp_extract(ltrim(text), '^(\S+)', 1), ',.')) NOT IN ('van','von','de','del','della','der','den','da','di','du','la','le','les','ter','ten','te'))"""
_KEY = r"""CASE WHEN number IS NOT NULL THEN CASE WHEN regexp_matches(trim(number), '^[+-]?\d+$') THEN try_cast(trim(number) AS INTEGER) END ELSE try_cast(nullif(regexp_extract(text, '^\s*\[?(\d+)[\]. ]?\s', 1), '') AS INTEGER) END"""
_SQ = r"trim(regexp_replace(text, '[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}\x{1680}\x{2028}\x{2029}\x{85}\x{1c}-\x{1f}\x{b}]+', ' ', 'g'))"
_PAGES = r"\d{1,4}(?:\s*[-–]\s*\d{1,4})?(?:[\s,]+\d{1,4}(?:\s*[-–]\s*\d{1,4})?)*"
_W = r"[\p{L}\p{N}_''’-]"
_INDEX = f"""({_SQ} <> '' AND NOT regexp_matches({_SQ}, '(^|\\D)(1[5-9]\\d\\d|20\\d\\d)(\\D|$)') AND (regexp_matches({_SQ}, '^(?:[^\\d()\\[\\]]{{1,80}}?[\\s,.]*)?{_PAGES}[.,]?$') OR regexp_matches({_SQ}, '^\\p{{L}}{_W}*(?:[\\s-]{_W}+)*,(?:\\s*\\p{{L}}{{1,2}}\\.)+$')))"""

ORACLES = {
    "parse1_dispatch": f"WITH {_DISPATCH} SELECT doc_id, page, idx, kind, out FROM dispatched",
    "parse2_kept": f"WITH {_DISPATCH} SELECT kind, count(*) AS n FROM dispatched WHERE kind <> 'abandon' GROUP BY kind",
    "parse4_reclaimed": f"""WITH {I.REFERENCE_REGIONS}, able AS (SELECT *, kind = 'reference' OR (kind = 'body' AND regexp_matches(out, '^\\s*\\[?\\d{{1,3}}[\\].]\\s')) AS able FROM ref_regions),
        runs AS (SELECT *, sum(CASE WHEN able THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY position) AS run FROM able)
        SELECT doc_id, page, CAST(position AS INTEGER) AS position, CASE WHEN able AND bool_or(kind = 'reference') OVER (PARTITION BY doc_id, page, run, able) THEN 'reference' ELSE kind END AS kind, out FROM runs""",
    "parse5_emitted": f"WITH {_KEPT} SELECT doc_id, page, position, crop_idx, body FROM bodies",
    "parse6_markdown": f"""WITH {_KEPT}, each AS (SELECT doc_id, page, string_agg(body, chr(10) || chr(10) ORDER BY position) AS body FROM bodies GROUP BY doc_id, page),
        whole AS (SELECT p.doc_id, p.page, '<page_number>' || p.page || '</page_number>' || coalesce(chr(10) || chr(10) || body, '') AS part FROM (SELECT DISTINCT doc_id, page FROM regions) p LEFT JOIN each e ON p.doc_id = e.doc_id AND p.page = e.page)
        SELECT doc_id, string_agg(part, chr(10) || chr(10) ORDER BY page) AS markdown FROM whole GROUP BY doc_id""",
    "o1_reading_order": f"WITH {I.REGIONS} SELECT doc_id, page, position, label AS native_label, content FROM regions",
    "o1_runs": f"WITH {I.REGIONS} SELECT doc_id, page, idx_in_page AS idx, CAST(CASE WHEN top <= 5 THEN row_number() OVER (PARTITION BY doc_id, page ORDER BY idx_in_page) ELSE idx_in_page // 6 + 1 END AS INTEGER) AS run FROM swapped",
    "c1_sections": f"""WITH {I.LINES}, f AS (SELECT *, starts_with(ltrim(line), '```') AS mark, count(*) FILTER (starts_with(ltrim(line), '```')) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS marks FROM lines),
        h AS (SELECT *, sum(CASE WHEN NOT mark AND marks % 2 = 0 AND regexp_matches(line, '^(#{{1,6}})\\s+(.*?)\\s*$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS s FROM f),
        t AS (SELECT doc_id, s, trim(string_agg(line, chr(10) ORDER BY line_no), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM h GROUP BY doc_id, s)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS section, text FROM t WHERE text <> ''""",
    "s2_parts": f"""WITH {I.DOCS}, p AS (SELECT doc_id, unnest(list_transform(regexp_extract_all(markdown, '{_MARK}', 1), lambda x: CAST(x AS INTEGER))) AS page FROM docs)
        SELECT doc_id, page, CAST((page - 1) // 100 AS INTEGER) AS part, CAST((page - 1) % 100 + 1 AS INTEGER) AS page_in_part FROM p""",
    "s4_labels": f"WITH {I.REGIONS} SELECT doc_id, page, idx, label AS native_label, trim(content) AS content FROM regions".replace("trim(content)", "trim(regexp_replace(content, '(?i)</?div[^>]*>', '', 'g'))"),
    "w19_offset_pages": "SELECT lib_id, paper_id, CAST(1 + coalesce(sum(coalesce(n_pages, 1)) OVER (PARTITION BY lib_id ORDER BY paper_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS first_page FROM parse_results",
    "w7_merged_entries": f"""WITH {I.REFS}, m AS (SELECT *, row_number() OVER w = 1 OR NOT coalesce({_CONT}, false) AS whole FROM refs WINDOW w AS (PARTITION BY doc_id ORDER BY ref_idx, ref_id)),
        b AS (SELECT *, last_value(CASE WHEN whole THEN coalesce(page, -999999) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ref_idx, ref_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM m),
        j AS (SELECT *, coalesce(NOT whole AND base <> -999999 AND page > base, false) AS joins FROM b),
        e AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY ref_idx, ref_id) AS entry FROM j)
        SELECT doc_id, min(ref_idx) AS ref_idx, arg_min(page, ref_idx) FILTER (NOT joins) AS page, arg_min(number, ref_idx) FILTER (NOT joins) AS number,
            CASE WHEN count(*) = 1 THEN min(text) ELSE string_agg(CASE WHEN joins THEN ltrim(rtrim(text)) ELSE rtrim(text) END, ' ' ORDER BY ref_idx) END AS text FROM e GROUP BY doc_id, entry""",
    "w8_without_boilerplate": f"""WITH {I.REFS}, r AS (SELECT *, row_number() OVER w AS n, bool_and(ref_id % 3 = 0) OVER (PARTITION BY doc_id ORDER BY ref_idx DESC, ref_id DESC ROWS UNBOUNDED PRECEDING) AS run FROM refs WINDOW w AS (PARTITION BY doc_id ORDER BY ref_idx DESC, ref_id DESC))
        SELECT ref_id FROM r WHERE NOT (run AND n <= 3)""",
    "w9_without_index": f"""WITH {I.REFS}, r AS (SELECT ref_id, bool_and({_INDEX}) OVER (PARTITION BY doc_id ORDER BY ref_idx DESC, ref_id DESC ROWS UNBOUNDED PRECEDING) AS run FROM refs) SELECT ref_id FROM r WHERE NOT run""",
    "o2_sorted_refs": f"""WITH {I.REFS}, k AS (SELECT *, {_KEY} AS k FROM refs), s AS (SELECT doc_id, count(k) = count(*) AND count(DISTINCT k) = count(*) AND max(k) - min(k) + 1 = count(*) AS sorts FROM k GROUP BY doc_id)
        SELECT ref_id, CAST(row_number() OVER (PARTITION BY k.doc_id ORDER BY CASE WHEN sorts THEN k END NULLS FIRST, ref_idx, ref_id) - 1 AS INTEGER) AS position FROM k JOIN s ON k.doc_id = s.doc_id""",
    "a5_missing_numbers": f"""WITH {I.REFS}, f AS (SELECT doc_id, coalesce(number, nullif(regexp_extract(text, '^\\s*\\[?(\\d+)[\\]. ]?\\s', 1), '')) AS number FROM refs),
        k AS (SELECT DISTINCT doc_id, number, CASE WHEN regexp_matches(trim(number), '^[+-]?\\d+$') THEN try_cast(trim(number) AS INTEGER) END AS k FROM f WHERE number IS NOT NULL),
        s AS (SELECT doc_id, list(k) AS have, max(k) AS top FROM k GROUP BY doc_id HAVING count(k) = count(*) AND count(DISTINCT k) = count(*) AND max(k) >= 1), n AS (SELECT doc_id, have, unnest(generate_series(1, top)) AS number FROM s)
        SELECT doc_id, CAST(number AS INTEGER) AS number FROM n WHERE NOT list_contains(have, CAST(number AS INTEGER))""",
    "k6_references_markdown": f"""WITH {I.REFS}, p AS (SELECT doc_id, page, string_agg(CASE WHEN coalesce(number, '') <> '' THEN '[' || number || '] ' || text ELSE text END, chr(10) || chr(10) ORDER BY ref_idx, ref_id) AS body FROM refs GROUP BY doc_id, page)
        SELECT doc_id, string_agg(coalesce('<page_number>' || page || '</page_number>' || chr(10) || chr(10), '') || body, chr(10) || chr(10) ORDER BY page NULLS FIRST) AS markdown FROM p GROUP BY doc_id""",
    "w1_pages": """SELECT chunk_id, coalesce(page_start, l) AS page_start, coalesce(page_end, l) AS page_end FROM (SELECT *, last_value(page_end IGNORE NULLS) OVER (PARTITION BY paper_id ORDER BY chunk_index, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM chunks)""",
    "w2_merged": f"""WITH RECURSIVE {I.PARAGRAPHS}, fold AS (SELECT doc_id, 0 AS idx, 0 AS piece, paragraph AS text FROM paragraphs WHERE idx = 0
        UNION ALL SELECT p.doc_id, p.idx, CASE WHEN length(p.paragraph) < 1000 OR length(f.text) < 1000 THEN f.piece ELSE f.piece + 1 END, CASE WHEN length(p.paragraph) < 1000 OR length(f.text) < 1000 THEN f.text || chr(10) || chr(10) || p.paragraph ELSE p.paragraph END
        FROM fold f JOIN paragraphs p ON p.doc_id = f.doc_id AND p.idx = f.idx + 1)
        SELECT doc_id, CAST(piece AS INTEGER) AS piece, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS md5 FROM (SELECT doc_id, piece, arg_max(text, idx) AS text FROM fold GROUP BY doc_id, piece)""",
}
