"""Queries of the native text functions and predicates over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import blocks
from quirelake.functions import text as X
from quirelake.functions.fold import fold_name_column
from quirelake.plans import inputs as I
from quirelake.plans.planted import decomposed, fold
from quirelake.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, source: str | Callable, key: str | tuple[str, ...], columns: dict[str, Column | Callable], sql: str | None) -> None:
    """A query that adds ``columns`` to the key of a table (or of a derived input); ``sql`` is its oracle."""
    keys = (key,) if isinstance(key, str) else key

    def run(spark: SparkSession, root: str) -> DataFrame:
        rows = table(spark, root, source) if isinstance(source, str) else source(spark, root)
        return rows.select(*keys, *((c() if callable(c) and not isinstance(c, Column) else c).alias(n) for n, c in columns.items()))

    QUERIES[name] = run
    if sql:
        ORACLES[name] = sql


_SPACE = r"[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}\x{1680}\x{2028}\x{2029}\x{85}\x{1c}-\x{1f}\x{b}]"


def _squeezed(value: str) -> str:
    return f"trim(regexp_replace({value}, '{_SPACE}+', ' ', 'g'))"



_add(
    "t1_page_markers", "parse_results", "paper_id",
    {"n_markers": lambda: F.size(X.page_numbers("markdown")), "page_start": lambda: X.page_start("markdown"), "page_end": lambda: X.page_end("markdown"), "bare_chars": lambda: F.length(X.strip_page_markers("markdown"))},
    r"""SELECT paper_id, CAST(len(ps) AS INTEGER) AS n_markers, list_min(ps) AS page_start, list_max(ps) AS page_end, CAST(length(bare) AS INTEGER) AS bare_chars FROM (
        SELECT paper_id, list_transform(regexp_extract_all(markdown, '<page_number>\s*(\d+)\s*</page_number>', 1), lambda x: CAST(x AS INTEGER)) AS ps, regexp_replace(markdown, '<page_number>\s*(\d+)\s*</page_number>', '', 'g') AS bare FROM parse_results)""",
)
_add("t2_leading_number", "raw_refs", "ref_id", {"number": lambda: X.leading_number("text")}, r"SELECT ref_id, nullif(regexp_extract(text, '^\s*\[?(\d+)[\]. ]?\s', 1), '') AS number FROM raw_refs")
_add("t3_fold_name", "author_names", "name_id", {"folded": lambda: fold_name_column("family")}, f"SELECT name_id, {fold('family')} AS folded FROM author_names")
_add(
    "t4_extract_doi", "raw_refs", "ref_id", {"doi": lambda: X.extract_doi("text")},
    r"""SELECT ref_id, nullif(regexp_replace(regexp_extract(text, '(?i)(10\.\d{4,9}/[^\s"''<>]+)', 1), '[.,;:)\]}]+$', ''), '') AS doi FROM raw_refs""",
)
_add("t5_normal_title", "candidates", "cand_id", {"title": lambda: X.normalize_title("title")}, "SELECT cand_id, trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS title FROM candidates")
_add("t7_words", "raw_refs", "ref_id", {"n_words": lambda: F.size(blocks.words_column("text"))}, f"SELECT ref_id, CAST(len(regexp_extract_all({decomposed('text')}, '[a-z0-9]+')) AS INTEGER) AS n_words FROM raw_refs")


def _full_names(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "author_names").select("name_id", F.concat_ws(" ", "given", "family").alias("name"))


_add(
    "t8_split_name", _full_names, "name_id", {"family": lambda: X.split_full_name("name")["family"], "given": lambda: X.split_full_name("name")["given"]},
    f"""WITH n AS (SELECT name_id, string_split({_squeezed("concat_ws(' ', given, family)")}, ' ') AS w FROM author_names)
        SELECT name_id, rtrim(w[-1], ',') AS family, nullif(array_to_string(w[1:len(w) - 1], ' '), '') AS given FROM n""",
)


def t9_abstract(spark: SparkSession, root: str) -> DataFrame:
    """Titles turned into inverted indexes and back."""
    words = table(spark, root, "candidates").select("cand_id", F.posexplode(F.split(X.squeeze("title"), " ")).alias("p", "w"))
    index = words.groupBy("cand_id", "w").agg(F.array_sort(F.collect_list("p")).alias("ps")).groupBy("cand_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("index"))
    return index.select("cand_id", X.reconstruct_abstract("index").alias("abstract"))


QUERIES["t9_abstract"] = t9_abstract
ORACLES["t9_abstract"] = f"SELECT cand_id, {_squeezed('title')} AS abstract FROM candidates WHERE title IS NOT NULL"
_add(
    "t11_number_group", "extracted_refs", "ext_id", {"numbers": lambda: F.array_join(X.expand_number_group(F.concat_ws(", ", F.coalesce("volume", F.lit("x")), F.coalesce("page_range", F.lit("1-3")))), " ")},
    r"""WITH g AS (SELECT ext_id, string_split_regex(coalesce(volume, 'x') || ', ' || coalesce(page_range, '1-3'), '[,;]') AS ps FROM extracted_refs),
        e AS (SELECT ext_id, list_transform(ps, lambda p: CASE WHEN regexp_matches(trim(p), '^\d+$') THEN [CAST(trim(p) AS INTEGER)]
            WHEN regexp_matches(trim(p), '^\d{1,3}\s*[-–]\s*\d{1,3}$') AND CAST(regexp_extract(trim(p), '^(\d{1,3})', 1) AS INTEGER) < CAST(regexp_extract(trim(p), '(\d{1,3})$', 1) AS INTEGER)
                AND CAST(regexp_extract(trim(p), '(\d{1,3})$', 1) AS INTEGER) - CAST(regexp_extract(trim(p), '^(\d{1,3})', 1) AS INTEGER) <= 50
            THEN CAST(generate_series(CAST(regexp_extract(trim(p), '^(\d{1,3})', 1) AS INTEGER), CAST(regexp_extract(trim(p), '(\d{1,3})$', 1) AS INTEGER)) AS INTEGER[]) END) AS ls FROM g)
        SELECT ext_id, CASE WHEN len(list_filter(ls, lambda x: x IS NULL)) = 0 THEN array_to_string(list_transform(flatten(ls), lambda x: CAST(x AS VARCHAR)), ' ') END AS numbers FROM e""",
)
_add(
    "t12_collapsed", "parse_results", "paper_id", {"markdown": lambda: X.collapse_math("markdown")},
    r"""WITH p AS (SELECT paper_id, string_split(markdown, '$$') AS ps FROM parse_results)
        SELECT paper_id, array_to_string(list_transform(ps, lambda p, i: CASE WHEN i % 2 = 0 AND (len(ps) % 2 = 1 OR i < len(ps)) AND contains(p, chr(10)) THEN trim(regexp_replace(p, '\s*\n\s*', ' ', 'g')) ELSE p END), '$$') AS markdown FROM p""",
)


def t13_formula(spark: SparkSession, root: str) -> DataFrame:
    """Every display formula of every paper."""
    each = table(spark, root, "parse_results").select("paper_id", F.posexplode(F.regexp_extract_all("markdown", F.lit(r"(?s)(\$\$.*?\$\$)"), F.lit(1))).alias("place", "formula"))
    return each.select("paper_id", "place", X.wrap_formula("formula").alias("formula"))


QUERIES["t13_formula"] = t13_formula
ORACLES["t13_formula"] = r"""WITH l AS (SELECT paper_id, regexp_extract_all(markdown, '(?s)(\$\$.*?\$\$)', 1) AS fs FROM parse_results), f AS (SELECT paper_id, CAST(unnest(generate_series(0, len(fs) - 1)) AS INTEGER) AS place, trim(unnest(fs)) AS t FROM l)
    SELECT paper_id, place, '$$' || chr(10) || trim(regexp_replace(trim(regexp_replace(t, '^\$\$', '')), '\$\$$', '')) || chr(10) || '$$' AS formula FROM f"""
_add("t14_heading", I.lines, ("doc_id", "line_no"), {"text": lambda: X.strip_heading_prefix("line")}, f"WITH {I.LINES} SELECT doc_id, line_no, regexp_replace(regexp_replace(trim(line), '^[-*] \\s*', ''), '^#+\\s*', '') AS text FROM lines")
_add(
    "t18_csl_type", "candidates", "cand_id", {"type": lambda: X.csl_type("provider", "provider_type", "container_title")},
    """SELECT cand_id, CASE
        WHEN provider = 'semantic_scholar' AND provider_type IN ('JournalArticle', 'Review') THEN 'article-journal' WHEN provider = 'semantic_scholar' AND provider_type = 'Conference' THEN 'paper-conference'
        WHEN provider = 'semantic_scholar' AND provider_type = 'Book' THEN 'book' WHEN provider = 'semantic_scholar' AND provider_type = 'BookSection' THEN 'chapter' WHEN provider = 'semantic_scholar' AND provider_type = 'Dataset' THEN 'dataset'
        WHEN provider = 'crossref' AND provider_type = 'journal-article' THEN 'article-journal' WHEN provider = 'crossref' AND provider_type = 'proceedings-article' THEN 'paper-conference' WHEN provider = 'crossref' AND provider_type = 'posted-content' THEN 'article'
        WHEN provider = 'crossref' AND provider_type = 'monograph' THEN 'book' WHEN provider = 'openalex' AND provider_type = 'article' THEN 'article-journal' WHEN provider = 'openalex' AND provider_type = 'preprint' THEN 'article'
        WHEN provider IN ('crossref', 'openalex') AND provider_type IN ('book', 'report') THEN provider_type WHEN provider IN ('crossref', 'openalex') AND provider_type = 'book-chapter' THEN 'chapter' WHEN provider IN ('crossref', 'openalex') AND provider_type = 'dissertation' THEN 'thesis'
        WHEN trim(coalesce(container_title, '')) <> '' THEN 'article-journal' ELSE 'article' END AS type FROM candidates""",
)
_add("t19_preprint", "candidates", "cand_id", {"preprint": lambda: X.is_preprint("provider_type", "doi")}, "SELECT cand_id, coalesce(provider_type IN ('preprint', 'posted-content'), false) OR coalesce(starts_with(lower(doi), '10.48550/'), false) AS preprint FROM candidates")
_add("t20_searchable", "extracted_refs", "ext_id", {"searchable": lambda: X.searchable("title")}, r"SELECT ext_id, coalesce(regexp_matches(title, '\p{L}'), false) AS searchable FROM extracted_refs")
_add(
    "t21_query", "candidates", "cand_id", {"query": lambda: X.catalogue_query("title")},
    r"SELECT cand_id, regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(title, '[?*~]', ' ', 'g'), '[ \t\n\r\f\x{b}]+', ' ', 'g')), '\bAND\b', 'and', 'g'), '\bOR\b', 'or', 'g'), '\bNOT\b', 'not', 'g') AS query FROM candidates",
)
_add("t22_orphans", "extracted_refs", "ext_id", {"title": lambda: blocks.orphan_marks_column("title")}, r"SELECT ext_id, regexp_replace(regexp_replace(title, '(\p{L}\p{Mn})\p{Mn}+', '\1', 'g'), '(^|[^\p{L}\p{Mn}])\p{Mn}+', '\1', 'g') AS title FROM extracted_refs")
_add("t24_math", "parse_results", "paper_id", {"markdown": lambda: blocks.normalise_math_column("markdown")}, r"SELECT paper_id, regexp_replace(markdown, '(?s)(\$\$)\s*(.*?)\s*\$\$|(\$)\s*(.*?)\s*\$', '\1\3\2\4\1\3', 'g') AS markdown FROM parse_results")
_add("t25_heading_text", "documents", "doc_id", {"heading": lambda: X.heading_text("title")}, f"SELECT doc_id, upper(rtrim({_squeezed('title')}, '.')) AS heading FROM documents")
_add("t26_caption_text", "documents", "doc_id", {"caption": lambda: X.caption_text("title")}, f"SELECT doc_id, trim({_squeezed('title')}, '* ') AS caption FROM documents")
_add("t27_layer_text", "raw_refs", "ref_id", {"text": lambda: X.layer_text("text")}, f"SELECT ref_id, regexp_replace(regexp_replace(text, '-\\n([a-z])', '\\1', 'g'), '{_SPACE}+', ' ', 'g') AS text FROM raw_refs")
_FIRST = "regexp_extract(markdown, '(?m)^#[ ]+(.+)$', 1)"
_add("t29_source_title", "parse_results", "paper_id", {"title": lambda: X.source_title("markdown")}, f"SELECT paper_id, nullif({_squeezed(_FIRST)}, '') AS title FROM parse_results")
_add(
    "t30_chunk_name", "chunks", "chunk_id", {"name": lambda: X.chunk_name(F.col("paper_id").cast("string"), "chunk_index", "page_start", "page_end")},
    """SELECT chunk_id, CASE WHEN page_start IS NULL THEN paper_id || ' chunk ' || chunk_index WHEN page_start = coalesce(page_end, page_start) THEN paper_id || ' pages ' || page_start ELSE paper_id || ' pages ' || page_start || '-' || page_end END AS name FROM chunks""",
)
_STATUS = "CASE event_type WHEN 'error' THEN 429 WHEN 'search' THEN 404 WHEN 'signup' THEN 503 WHEN 'click' THEN 400 END"
_add(
    "t31_error_class", "events", "event_id", {"class": lambda: X.error_class(F.expr(_STATUS), F.lit("timeout")), "retryable": lambda: X.is_retryable(F.expr(_STATUS), F.lit("timeout"))},
    f"""WITH s AS (SELECT event_id, {_STATUS} AS s FROM events) SELECT event_id, CASE WHEN s = 404 THEN 'missing' WHEN s = 429 THEN '429' WHEN s >= 500 THEN '5xx' WHEN s IS NOT NULL THEN '4xx' ELSE 'timeout' END AS class,
        CASE WHEN s IS NOT NULL THEN s = 429 OR s >= 500 ELSE true END AS retryable FROM s""",
)
_URL = "concat('https://api.', CASE provider WHEN 'crossref' THEN 'crossref.org' WHEN 'openalex' THEN 'openalex.org' ELSE 'semanticscholar.org' END, '/works?q=', CAST(cand_id AS VARCHAR(20)), '&mailto=a@b.org')"
_add("t34_cache_key", "candidates", "cand_id", {"key": lambda: X.cache_key(F.expr(_URL.replace("VARCHAR(20)", "STRING")))}, f"SELECT cand_id, sha256(regexp_replace({_URL}, '&mailto=[^&]*', '', 'g')) AS key FROM candidates")
_add("t35_provider", "candidates", "cand_id", {"label": lambda: X.provider_label(F.expr(_URL.replace("VARCHAR(20)", "STRING")))}, "SELECT cand_id, replace(provider, '_', '') AS label FROM candidates")


def t36_newer_models(spark: SparkSession, root: str) -> DataFrame:
    from quirelake.operators.extraction import newer_models

    names = table(spark, root, "candidates").select(F.concat("provider", F.lit("-"), (F.col("cand_id") % 4).cast("string"), F.lit(".5-flash")).alias("name")).distinct()
    return newer_models(names)


QUERIES["t36_newer_models"] = t36_newer_models
ORACLES["t36_newer_models"] = """WITH m AS (SELECT DISTINCT provider, cand_id % 4 AS v FROM candidates)
    SELECT a.provider || '-' || a.v || '.5-flash' AS name, b.provider || '-' || b.v || '.5-flash' AS newer, CAST(b.v AS DOUBLE) + 0.5 AS newer_version FROM m a JOIN m b ON a.provider = b.provider AND b.v > a.v"""

_INDEX_ENTRY = r"^[^\n]{2,90}?,\s*\d{1,4}(?:\s*[-–]\s*\d{1,4})?(?:\s*,\s*\d{1,4}(?:\s*[-–]\s*\d{1,4})?)*\.?$"
_ENTRY_START = r"^(?:(?:\[\d{1,4}\]|\(\d{1,4}\)|\d{1,4}\.)\s*\S|[A-Z][\p{L}\p{N}_''’-]+,\s*(?:[A-Z]\.|[A-Z][a-z]+))"
_PAGES = r"\d{1,4}(?:\s*[-–]\s*\d{1,4})?(?:[\s,]+\d{1,4}(?:\s*[-–]\s*\d{1,4})?)*"
_W = r"[\p{L}\p{N}_''’-]"
_add("parse9_back_matter_line", "raw_refs", "ref_id", {"entry": lambda: X.is_back_matter_paragraph("text")}, f"SELECT ref_id, regexp_matches(text, '{_INDEX_ENTRY}') OR regexp_matches(text, '{_ENTRY_START}') AS entry FROM raw_refs")
_MARK = r"<page_number>\s*(\d+)\s*</page_number>"
_add(
    "parse10_paragraph_kind", I.paragraphs, ("doc_id", "idx"), {"kind": lambda: X.paragraph_kind("paragraph")},
    f"""WITH {I.PARAGRAPHS}, s AS (SELECT doc_id, idx, trim(paragraph, ' ' || chr(9) || chr(10) || chr(13)) AS s FROM paragraphs)
        SELECT doc_id, idx, CASE WHEN s = '' OR regexp_matches(s, '^{_MARK}$') OR regexp_matches(s, '^(?:!\\[FIGURE|> \\*\\*Figure description|\\**\\s*(?:FIGURE|Fig\\.?)\\s*\\d)') THEN 'neutral'
            WHEN regexp_matches(s, '^(#{{1,6}})\\s+([^\\n]*?)\\s*$') THEN 'heading' WHEN regexp_matches(s, '{_INDEX_ENTRY}') THEN 'index'
            WHEN length(s) <= 600 AND regexp_matches(s, '{_ENTRY_START}') AND regexp_matches(s, '\\b(?:1[89]|20)\\d{{2}}[a-z]?\\b') THEN 'reference' ELSE 'body' END AS kind FROM s""",
)
_add(
    "parse11_prose", I.paragraphs, ("doc_id", "idx"), {"prose": lambda: X.is_prose("paragraph")},
    f"""WITH {I.PARAGRAPHS}, s AS (SELECT doc_id, idx, trim(paragraph) AS s FROM paragraphs)
        SELECT doc_id, idx, s <> '' AND NOT (regexp_matches(s, '^{_MARK}$') OR regexp_matches(s, '^(?:#|!\\[|\\$\\$|>|\\|)') OR regexp_matches(s, '^[ \\t]*\\**[ \\t]*(FIGURE|Figure|FIG|Fig)\\.?[ \\t]*(\\d+(?:\\.\\d+)?)\\b[.:]?[ \\t]*([^\\n]*)$')) AS prose FROM s""",
)
_add(
    "parse12_index_entry", "raw_refs", "ref_id", {"entry": lambda: X.is_index_entry("text")},
    f"""WITH s AS (SELECT ref_id, {_squeezed('text')} AS s FROM raw_refs)
        SELECT ref_id, s <> '' AND NOT regexp_matches(s, '(^|\\D)(1[5-9]\\d\\d|20\\d\\d)(\\D|$)') AND (regexp_matches(s, '^(?:[^\\d()\\[\\]]{{1,80}}?[\\s,.]*)?{_PAGES}[.,]?$') OR regexp_matches(s, '^\\p{{L}}{_W}*(?:[\\s-]{_W}+)*,(?:\\s*\\p{{L}}{{1,2}}\\.)+$')) AS entry FROM s""",
)
_add(
    "parse13_boilerplate", "raw_refs", "ref_id", {"boilerplate": lambda: X.is_boilerplate("text")},
    "SELECT ref_id, contains(lower(text), 'conflict of interest') OR contains(lower(text), 'copyright ©') OR contains(lower(text), 'creative commons') OR contains(lower(text), 'open-access article distributed') AS boilerplate FROM raw_refs",
)
_add(
    "parse14_continued", "raw_refs", "ref_id", {"continued": lambda: X.looks_continued("text")},
    r"SELECT ref_id, regexp_matches(ltrim(text), '^\p{Ll}') AND lower(rtrim(regexp_extract(ltrim(text), '^(\S+)', 1), ',.')) NOT IN ('van','von','de','del','della','der','den','da','di','du','la','le','les','ter','ten','te') AS continued FROM raw_refs",
)
