"""Queries whose answer is known by construction: input made of the tables' values by a rule, the SQL restates what must come out.

They cover operators that SQL can't follow on real text: fences, tables, scripts, links, markers, runs of entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import blocks
from quirelake.operators import chunk as C
from quirelake.operators import linking as L
from quirelake.plans import inputs as I
from quirelake.session import table


def _titles(spark: SparkSession, root: str) -> DataFrame:
    """Catalogue titles that are plain letters and blanks."""
    return table(spark, root, "candidates").where("title rlike '^[A-Za-z]+( [A-Za-z]+)*$'").select("cand_id", "title")


_TITLES = "titles AS (SELECT cand_id, title FROM candidates WHERE regexp_matches(title, '^[A-Za-z]+( [A-Za-z]+)*$'))"


def t15_fenced(spark: SparkSession, root: str) -> DataFrame:
    """Titles as code: bare, with backticks in them, fenced with an info word, and fenced without an end."""
    code = F.expr("CASE cand_id % 4 WHEN 0 THEN title WHEN 1 THEN concat('a ```` b ', title) WHEN 2 THEN concat('```py\\n', title, '\\n```') ELSE concat('~~~py\\n', title) END")
    return _titles(spark, root).select("cand_id", blocks.fence_code_column(code).alias("code"))


def t16_fences(spark: SparkSession, root: str) -> DataFrame:
    """Titles between blocks that were fenced twice: with an info word, bare, with text before the inner fence, and once only."""
    text = F.expr(
        "concat('before\\n\\n', CASE cand_id % 4 WHEN 0 THEN concat('```\\n```py\\n', title, '\\n```\\n```') WHEN 1 THEN concat('```\\n```\\n', title, '\\n```\\n```') WHEN 2 THEN concat('```\\nListing\\n```py\\n', title, '\\n```\\n```') ELSE concat('```\\n', title, '\\n```') END, '\\n\\nafter')"
    )
    return _titles(spark, root).select("cand_id", blocks.repair_fences_column(text).alias("markdown"))


def t17_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables of three rows: a title over two columns, a cell over two rows, a bar in a cell, a short row."""
    html = F.expr("concat('<table><tr><th colspan=\"2\">', title, '</th><th>n</th></tr><tr><td rowspan=2>', cand_id, '</td><td>a | b</td><td>1</td></tr><tr><td>x</td></tr></table>')")
    return _titles(spark, root).select("cand_id", blocks.html_table_column(html).alias("markdown"))


def t23_scripts(spark: SparkSession, root: str) -> DataFrame:
    """Formulas padded and with scripts twice in a row, twice and thrice."""
    formula = F.expr("concat('Let $ x^{', cand_id, '}^{b} $ and $$ y_{a} _{b}_{', cand_id, '} $$ be ^{a}^{b}.')")
    return _titles(spark, root).select("cand_id", blocks.normalise_math_column(formula).alias("markdown"))


def t28_links(spark: SparkSession, root: str) -> DataFrame:
    """Links below the base folder, elsewhere, and to the web."""
    text = F.expr("concat('![', title, '](/data/lib/crops/p', cand_id, '.png) [b](/data/other/', cand_id, ') [c](https://x.org/data/lib/d)')")
    return _titles(spark, root).select("cand_id", blocks.relative_links_column(text, "/data/lib").alias("markdown"))


def w4_planted(spark: SparkSession, root: str) -> DataFrame:
    """Prose with a run of entries or index lines without a heading, long enough or not, with a page marker and a bridged remark in it.

    The length of the run is told by the id; what must go goes, the marker is handed to the prose behind.
    """
    n = F.expr("CAST(cand_id % 24 AS INT)")
    line = F.when(F.expr("cand_id % 2 = 0"), F.lit("Boyd, S. On motors. 1999.")).otherwise(F.lit("motors, 12, 14-15"))
    run = F.array_join(F.array_repeat(line, n + 1), "\n\n")
    text = F.concat(F.lit("Prose about "), "title", F.lit(" that goes on.\n\n"), run, F.lit("\n\nA remark.\n\n<page_number>7</page_number>\n\n"), line, F.lit("\n\nProse behind it, which says more."))
    return C.drop_back_matter(_titles(spark, root).select("cand_id", text.alias("markdown")), "cand_id")


def _cited(spark: SparkSession, root: str) -> DataFrame:
    """Documents that say of each of their references, by its place, one of five things: in brackets with another, in parentheses as an equation, as author and year in both forms, as a range."""
    rows = I.extracted(spark, root)
    n, family = F.col("ref_idx") + 1, F.when(F.size("authors") > 0, F.col("authors")[0]["family"])
    said = (
        F.when(F.col("ref_idx") % 5 == 0, F.concat(F.lit("It was shown in ["), n.cast("string"), F.lit(", 1].")))
        .when(F.col("ref_idx") % 5 == 1, F.concat(F.lit("By Eq. ("), n.cast("string"), F.lit(") it holds.")))
        .when(F.col("ref_idx") % 5 == 2, F.concat(F.lit("others agree ("), family, F.lit(" et al., "), F.col("year").cast("string"), F.lit(").")))
        .when(F.col("ref_idx") % 5 == 3, F.concat(F.lit("as "), family, F.lit(" et al. ("), F.col("year").cast("string"), F.lit(") agree.")))
        .otherwise(F.concat(F.lit("In $x_{[1]}$ see ["), n.cast("string"), F.lit("-"), (n + 1).cast("string"), F.lit("].")))
    )
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_idx", said.alias("s")))), lambda x: x["s"]), "\n\n").alias("markdown"))


def _cited_links(spark: SparkSession, root: str) -> DataFrame:
    return L.scan_markers(_cited(spark, root), I.extracted(spark, root))


def l1_planted(spark: SparkSession, root: str) -> DataFrame:
    rows = L.explode_markers(_cited_links(spark, root))
    return rows.select("doc_id", "text", F.array_join(F.transform("refs", lambda x: x.cast("string")), ",").alias("refs"))


def j12_planted(spark: SparkSession, root: str) -> DataFrame:
    return L.uncited(_cited_links(spark, root), I.extracted(spark, root))


def a2_planted(spark: SparkSession, root: str) -> DataFrame:
    return _cited_links(spark, root).groupBy("style").agg(F.count(F.lit(1)).alias("n_docs"))


_NAMES = "t15_fenced t16_fences t17_tables t23_scripts t28_links w4_planted l1_planted j12_planted a2_planted".split()
QUERIES = {n: globals()[n] for n in _NAMES}

_N = "chr(10)"
#: Compatibility forms of Latin letters, by their numbers, and what they stand for.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")


def _plain(value: str) -> str:
    out = f"translate({value}, '{_WIDE}', '{_PLAIN}')"
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        out = f"replace({out}, '{a}', '{b}')"
    blank = r"[\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
    return f"regexp_replace({out}, '{blank}', ' ', 'g')"


def fold(value: str) -> str:
    """SQL of a folded name."""
    return f"strip_accents(lower({_plain(value)}))"


def decomposed(value: str) -> str:
    """SQL of a text in lower case whose accents are signs of their own, here blanks."""
    return f"lower(array_to_string(list_transform(string_split({_plain(value)}, ''), lambda c: CASE WHEN strip_accents(c) <> c THEN strip_accents(c) || ' ' ELSE c END), ''))"


_NAME = r"[A-Z][\p{L}\p{N}_''’-]+"
_MARKS = f"""WITH {I.EXTRACTED}, styles AS (SELECT doc_id, CASE WHEN present > 0 AND present * 2 >= n AND numbered * 2 >= present THEN 'numbered' ELSE 'author-year' END AS style FROM (SELECT doc_id, count(*) AS n,
        count(*) FILTER (trim(coalesce(citation_key, '')) <> '') AS present, count(*) FILTER (regexp_matches(trim(coalesce(citation_key, '')), '^\\[?\\(?\\d+[\\]).]?$')) AS numbered FROM extracted GROUP BY doc_id)),
    numbers AS (SELECT doc_id, coalesce(try_cast(nullif(regexp_extract(citation_key, '(\\d+)', 1), '') AS INTEGER), ref_idx + 1) AS number, max(ref_idx) AS ref FROM extracted GROUP BY 1, 2),
    named AS (SELECT doc_id, {fold('authors[1].family')} AS family, year, max(ref_idx) AS ref FROM extracted WHERE len(authors) > 0 AND authors[1].family <> '' AND year IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) = 1),
    said AS (SELECT e.doc_id, e.ref_idx, e.ref_idx + 1 AS n, CASE WHEN len(authors) > 0 THEN authors[1].family END AS family, year, style FROM extracted e JOIN styles s ON e.doc_id = s.doc_id),
    b1 AS (SELECT s.doc_id, '[' || s.n || ', 1]' AS text, a.ref || ',' || b.ref AS refs, s.ref_idx AS k, [a.ref, b.ref] AS rs FROM said s JOIN numbers a ON s.doc_id = a.doc_id AND s.n = a.number JOIN numbers b ON s.doc_id = b.doc_id AND b.number = 1 WHERE s.ref_idx % 5 = 0 AND style = 'numbered' AND s.n < 1000),
    b2 AS (SELECT s.doc_id, '[' || s.n || '-' || (s.n + 1) || ']' AS text, a.ref || ',' || b.ref AS refs, s.ref_idx AS k, [a.ref, b.ref] AS rs FROM said s JOIN numbers a ON s.doc_id = a.doc_id AND s.n = a.number JOIN numbers b ON s.doc_id = b.doc_id AND b.number = s.n + 1 WHERE s.ref_idx % 5 = 4 AND style = 'numbered' AND s.n < 999),
    c1 AS (SELECT s.doc_id, '(' || s.family || ' et al., ' || s.year || ')' AS text, CAST(m.ref AS VARCHAR) AS refs, s.ref_idx AS k, [m.ref] AS rs FROM said s JOIN named m ON s.doc_id = m.doc_id AND {fold('s.family')} = m.family AND s.year = m.year WHERE s.ref_idx % 5 = 2 AND style = 'author-year' AND regexp_matches(s.family, '^{_NAME}$')),
    c2s AS (SELECT *, regexp_extract(family, '({_NAME})$', 1) AS last FROM said WHERE ref_idx % 5 = 3 AND style = 'author-year'),
    c2 AS (SELECT s.doc_id, s.last || ' et al. (' || s.year || ')' AS text, CAST(m.ref AS VARCHAR) AS refs, s.ref_idx AS k, [m.ref] AS rs FROM c2s s JOIN named m ON s.doc_id = m.doc_id AND {fold('s.last')} = m.family AND s.year = m.year WHERE s.last <> ''),
    marks AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM c1 UNION ALL SELECT * FROM c2)"""
ORACLES = {
    "t15_fenced": f"""WITH {_TITLES} SELECT cand_id, CASE cand_id % 4 WHEN 0 THEN '```' || {_N} || title || {_N} || '```' WHEN 1 THEN '`````' || {_N} || 'a ```` b ' || title || {_N} || '`````' ELSE '```py' || {_N} || title || {_N} || '```' END AS code FROM titles""",
    "t16_fences": f"""WITH {_TITLES} SELECT cand_id, 'before' || {_N} || {_N} || CASE cand_id % 4 WHEN 0 THEN '```py' || {_N} || title || {_N} || '```' WHEN 2 THEN '````' || {_N} || 'Listing' || {_N} || '```py' || {_N} || title || {_N} || '```' || {_N} || '````'
        ELSE '```' || {_N} || title || {_N} || '```' END || {_N} || {_N} || 'after' AS markdown FROM titles""",
    "t17_tables": f"""WITH {_TITLES} SELECT cand_id, '| ' || title || ' | ' || title || ' | n |' || {_N} || '| --- | --- | --- |' || {_N} || '| ' || cand_id || ' | a \\| b | 1 |' || {_N} || '| ' || cand_id || ' | x |  |' AS markdown FROM titles""",
    "t23_scripts": f"WITH {_TITLES} SELECT cand_id, 'Let $x^{{' || cand_id || ' b}}$ and $$y_{{a b ' || cand_id || '}}$$ be ^{{a}}^{{b}}.' AS markdown FROM titles",
    "t28_links": f"WITH {_TITLES} SELECT cand_id, '![' || title || '](crops/p' || cand_id || '.png) [b](/data/other/' || cand_id || ') [c](https://x.org/data/lib/d)' AS markdown FROM titles",
    "w4_planted": f"""WITH {_TITLES}, p AS (SELECT cand_id, 'Prose about ' || title || ' that goes on.' AS head, CASE WHEN cand_id % 2 = 0 THEN 'Boyd, S. On motors. 1999.' ELSE 'motors, 12, 14-15' END AS line, CAST(cand_id % 24 AS INTEGER) + 1 AS n, {_N} || {_N} AS gap FROM titles)
        SELECT cand_id, head || gap || CASE WHEN n + 1 >= CASE WHEN cand_id % 2 = 0 THEN 10 ELSE 20 END THEN '<page_number>7</page_number>' || gap ELSE repeat(line || gap, n) || 'A remark.' || gap || '<page_number>7</page_number>' || gap || line || gap END || 'Prose behind it, which says more.' AS text FROM p""",
    "l1_planted": f"{_MARKS} SELECT doc_id, text, refs FROM marks",
    "j12_planted": f"{_MARKS}, used AS (SELECT DISTINCT doc_id, unnest(rs) AS ref FROM marks) SELECT e.doc_id, e.ref_idx FROM extracted e LEFT JOIN used u ON e.doc_id = u.doc_id AND e.ref_idx = u.ref WHERE u.ref IS NULL",
    "a2_planted": f"{_MARKS} SELECT CASE style WHEN 'numbered' THEN 'numbered-bracket' ELSE style END AS style, count(*) AS n_docs FROM styles GROUP BY 1",
}
