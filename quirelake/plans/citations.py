"""Queries of extraction checks, citation linking and resolution over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.functions import requests as Q
from quirelake.functions import text as X
from quirelake.operators import extraction as E
from quirelake.operators import linking as L
from quirelake.operators import resolve as R
from quirelake.plans import inputs as I
from quirelake.plans.planted import fold
from quirelake.session import table
from quirelake.sources import writers


def a1_style(spark: SparkSession, root: str) -> DataFrame:
    return L.marker_style(I.extracted(spark, root))


def j8_numbers(spark: SparkSession, root: str) -> DataFrame:
    return L.number_index(I.extracted(spark, root)).select("doc_id", "number", F.col("ref_idx").cast("int").alias("ref_idx"))


def j9_names(spark: SparkSession, root: str) -> DataFrame:
    return L.author_year_index(I.extracted(spark, root))


def t10_citekeys(spark: SparkSession, root: str) -> DataFrame:
    return L.citekeys(I.extracted(spark, root))


def _bodies(spark: SparkSession, root: str) -> DataFrame:
    """Each paper's text with a citation of every reference of its own behind it: numbered, in parentheses, by author and year in both forms, and decoys."""
    rows = I.extracted(spark, root)
    n = F.col("ref_idx") + 1
    family = F.when(F.size("authors") > 0, F.col("authors")[0]["family"])
    said = (
        F.when(F.col("ref_idx") % 5 == 0, F.concat(F.lit("It was shown in ["), n.cast("string"), F.lit(", 1].")))
        .when(F.col("ref_idx") % 5 == 1, F.concat(F.lit("By Eq. ("), n.cast("string"), F.lit(") and (0, 1) it holds.")))
        .when(F.col("ref_idx") % 5 == 2, F.concat(F.lit("Others agree ("), family, F.lit(" et al., "), F.col("year").cast("string"), F.lit(").")))
        .when(F.col("ref_idx") % 5 == 3, F.concat(family, F.lit(" et al. ("), F.col("year").cast("string"), F.lit(") agree.")))
        .otherwise(F.concat(F.lit("In $x_{[1]}$ see ["), n.cast("string"), F.lit("-"), (n + 1).cast("string"), F.lit("].")))
    )
    lists = rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_idx", said.alias("s")))), lambda x: x["s"]), "\n\n").alias("said"))
    return I.docs(spark, root).join(lists, "doc_id", "left").select("doc_id", F.concat_ws("\n\n", "markdown", "said").alias("markdown"))


def _links(spark: SparkSession, root: str) -> DataFrame:
    return L.scan_markers(_bodies(spark, root), I.extracted(spark, root))


def l1_markers(spark: SparkSession, root: str) -> DataFrame:
    rows = L.explode_markers(_links(spark, root))
    return rows.select("doc_id", "marker_no", "start", "end_at", "text", F.array_join(F.transform("refs", lambda x: x.cast("string")), ",").alias("refs"))


def l5_styles(spark: SparkSession, root: str) -> DataFrame:
    return _links(spark, root).select("doc_id", "style", F.size("markers").alias("n_markers"), F.size("ambiguous").alias("n_ambiguous"))


def j12_uncited(spark: SparkSession, root: str) -> DataFrame:
    return L.uncited(_links(spark, root), I.extracted(spark, root))


def j15_rewritten(spark: SparkSession, root: str) -> DataFrame:
    bodies, refs = _bodies(spark, root), I.extracted(spark, root)
    return L.rewrite(bodies, L.marker_keys(L.scan_markers(bodies, refs), L.citekeys(refs)))


def a2_forms(spark: SparkSession, root: str) -> DataFrame:
    return _links(spark, root).groupBy("style").agg(F.count(F.lit(1)).alias("n_docs"))


def a8_equation_tags(spark: SparkSession, root: str) -> DataFrame:
    tags = F.transform(F.regexp_extract_all("markdown", F.lit(r"\\tag\{\[?(\d{1,3})\]?\}"), F.lit(1)), lambda x: x.cast("int"))
    return I.docs(spark, root).select("doc_id", F.coalesce(F.array_max(tags), F.lit(0)).alias("top"))


def j2_zipped(spark: SparkSession, root: str) -> DataFrame:
    raw = I.refs(spark, root)
    rows = I.extracted(spark, root).where("ext_id IS NOT NULL").select("doc_id", "ref_idx", "title", "year")
    return R.zip_extracted(raw, rows).select("ref_id", "title", "year")


def r7_keys(spark: SparkSession, root: str) -> DataFrame:
    rows = I.extracted(spark, root).where("ext_id IS NOT NULL").withColumn("text", F.col("raw_text"))
    return E.sanitise_keys(rows).select("ext_id", "citation_key")


def parse15_fits(spark: SparkSession, root: str) -> DataFrame:
    """J1 with P15: extracted rows placed again at the entries they fit, by declared line."""
    rows = table(spark, root, "extracted_refs").join(table(spark, root, "raw_refs").select("ref_id", "paper_id"), "ref_id")
    rows = rows.select(F.col("paper_id").alias("doc_id"), F.col("ext_id").alias("row_no"), "line", "citation_key", "title", "authors", "year")
    placed = E.align_extracted(I.refs(spark, root), rows)
    return placed.select("doc_id", "ref_idx", "row_no")


def parse16_invented(spark: SparkSession, root: str) -> DataFrame:
    rows = I.extracted(spark, root).where("ext_id IS NOT NULL").withColumn("text", F.col("raw_text"))
    return E.invented_fields(rows)


def a9_quality(spark: SparkSession, root: str) -> DataFrame:
    rows = I.extracted(spark, root)
    fields = parse16_invented(spark, root)
    joined = rows.join(fields, "ext_id", "left").withColumn("model", F.concat(F.lit("reader-"), (F.col("doc_id") % 3).cast("string")))
    return E.extraction_quality(joined)


def x1_extracted(spark: SparkSession, root: str) -> DataFrame:
    return E.extract_all(I.refs(spark, root))


def _fields(df: DataFrame) -> DataFrame:
    authors = F.array_join(F.transform("authors", lambda a: F.concat_ws(", ", a["family"], a["given"])), "; ")
    return df.withColumn("authors", authors)


def x1_printed(spark: SparkSession, root: str) -> DataFrame:
    """Entries printed in one style from the catalogue's fields and read back: two authors, year, title in quotes, journal, volume and pages."""
    text = F.expr("concat('[', cand_id, '] Family', cand_id % 97, ', A. and Other', cand_id % 89, ', B. “Title ', cand_id, ' on crystals,” Journal of Optics, ', cand_id % 50 + 1, '(2), 1', cand_id % 9, '-', 20 + cand_id % 9, ', ', 1950 + cand_id % 70, '. doi:10.5555/x.', cand_id)")
    printed = table(spark, root, "candidates").select((F.col("cand_id") % 211).alias("doc_id"), F.col("cand_id").alias("ref_idx"), text.alias("text"))
    return _fields(E.extract_all(printed)).select("ref_idx", *E.FIELDS)


def x6_requests(spark: SparkSession, root: str) -> DataFrame:
    """The requests that each extracted reference would lead to: a search at each service, and by its DOI."""
    rows = table(spark, root, "extracted_refs")
    urls = {f"search_{p}": Q.search_url(p, F.col("title"), 5, "a@b.org") for p in Q.BASES} | {f"doi_{p}": Q.doi_url(p, F.col("doi"), "a@b.org") for p in ("semanticscholar", "openalex")}
    return rows.select("ext_id", *(u.alias(n) for n, u in urls.items()))


def x6_lists(spark: SparkSession, root: str) -> DataFrame:
    """The requests for the works that each service's records name, in batches of ids."""
    rows = j7_hydrated(spark, root).groupBy("doc_id", "batch").agg(F.array_sort(F.collect_list(F.struct("cand_idx", F.concat(F.lit("W"), F.col("work_id").cast("string")).alias("w")))).alias("ws"))
    return rows.select("doc_id", "batch", Q.works_url(F.transform("ws", lambda x: x["w"]), "a@b.org").alias("url"))


def x1_cached(spark: SparkSession, root: str) -> DataFrame:
    """A second run over whole bibliographies with the first one's cache: by whether a batch of which every line was read is asked again."""
    first = E.extract_batches(I.refs(spark, root))
    again = E.extract_batches(I.refs(spark, root), cache=E.cache_entries(first))
    whole = E.cache_entries(first).select("cache_key", F.lit(True).alias("whole"))
    return again.join(whole, "cache_key", "left").groupBy((F.coalesce("whole", F.lit(False)) == F.col("cached")).alias("agrees")).agg(F.count(F.lit(1)).alias("n"))


def x1_batches(spark: SparkSession, root: str) -> DataFrame:
    return E.batches(I.refs(spark, root)).select("ref_id", "batch", "line")


def a11_cache(spark: SparkSession, root: str) -> DataFrame:
    wanted = E.batch_keys(E.batches(I.refs(spark, root)))
    return E.cache_stats(wanted, wanted.where("doc_id % 2 = 0").select("cache_key"))


def j4_by_doi(spark: SparkSession, root: str) -> DataFrame:
    return R.match_by_doi(I.extracted(spark, root), I.catalogue(spark, root), X.extract_doi("doi")).select("doc_id", F.col("ref_idx").cast("int").alias("ref_idx"), "cand_id")


def r1_judged(spark: SparkSession, root: str) -> DataFrame:
    return R.title_pairs(I.extracted(spark, root), I.catalogue(spark, root)).select("doc_id", "ref_idx", "cand_id", F.round("similarity", 4).alias("similarity"), "accepted")


def j5_chain(spark: SparkSession, root: str) -> DataFrame:
    pairs = R.title_pairs(I.extracted(spark, root), I.catalogue(spark, root), misses=False)
    return R.chain_match(pairs).select("doc_id", "ref_idx", "cand_id", "source")


def o3_near_misses(spark: SparkSession, root: str) -> DataFrame:
    return R.near_misses(R.title_pairs(I.extracted(spark, root), I.catalogue(spark, root), best=True), I.catalogue(spark, root))


def j3_best(spark: SparkSession, root: str) -> DataFrame:
    pairs = R.title_pairs(I.extracted(spark, root), I.catalogue(spark, root), misses=False)
    return R.best_match(pairs).select("doc_id", "ref_idx", "cand_id", F.round("similarity", 4).alias("similarity"))


def _resolved(spark: SparkSession, root: str) -> DataFrame:
    return R.resolve(I.extracted(spark, root), I.catalogue(spark, root))


def r4_resolved(spark: SparkSession, root: str) -> DataFrame:
    return _resolved(spark, root).select("doc_id", "ref_idx", "title", "year", "doi", "verified", "match", "type", "near_similarity")


def r3_merged(spark: SparkSession, root: str) -> DataFrame:
    matches = j4_by_doi(spark, root).withColumn("route", F.lit("doi"))
    merged = R.merge(I.extracted(spark, root), matches, I.catalogue(spark, root))
    return merged.select("doc_id", F.col("ref_idx").cast("int").alias("ref_idx"), "title", "year", "verified", "source")


def r6_pool(spark: SparkSession, root: str) -> DataFrame:
    pool = I.catalogue(spark, root).select(F.col("source").alias("doc_id"), F.col("cand_id").alias("cand_idx"), "title", "doi")
    return R.dedup_pool(pool).select("doc_id", "cand_idx")


def u1_pools(spark: SparkSession, root: str) -> DataFrame:
    """Each year's records (those without a year as one pool too), the published catalogue's before those of all others."""
    pool = I.catalogue(spark, root).select(F.coalesce("year", F.lit(0)).alias("doc_id"), F.col("cand_id").alias("cand_idx"), "title", "doi", "source")
    both = R.union_pools(pool.where("source = 'crossref'"), pool.where("source IS NULL OR source <> 'crossref'"))
    return both.select("doc_id", "cand_idx", "title", "source")


def r8_semanticscholar(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "candidates").where("provider = 'semantic_scholar'")
    raw = rows.select("cand_id", "title", "year", F.lit(None).cast("string").alias("abstract"), F.create_map(F.lit("DOI"), "doi").alias("externalIds"), F.array("provider_type").alias("publicationTypes"), F.transform("authors", lambda a: F.struct(F.concat_ws(" ", a["given"], a["family"]).alias("name"))).alias("authors"))
    return R.normalise_s2(raw).select("cand_id", "title", "year", "doi", "provider_type", F.size("authors").alias("n_authors"))


def r9_crossref(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "candidates").where("provider = 'crossref'")
    raw = rows.select("cand_id", F.array("title").alias("title"), F.struct(F.array(F.array("year")).alias("date_parts")).alias("issued"), F.col("doi").alias("DOI"), F.concat(F.lit("<jats:p>"), "title", F.lit("</jats:p>")).alias("abstract"), F.col("authors").alias("author"), F.col("provider_type").alias("type"))
    return R.normalise_crossref(raw).select("cand_id", "title", "year", "doi", "abstract", "provider_type")


def r10_openalex(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "candidates").where("provider = 'openalex'")
    raw = rows.select("cand_id", F.col("title").alias("display_name"), F.lit(None).cast("string").alias("title"), F.col("year").alias("publication_year"), "doi", F.create_map(F.lit("of"), F.array(F.lit(1)), F.lit("Theory"), F.array(F.lit(0)), F.lit("all"), F.array(F.lit(2))).alias("abstract_inverted_index"), F.transform("authors", lambda a: F.struct(F.struct(F.concat_ws(" ", a["given"], a["family"]).alias("display_name")).alias("author"))).alias("authorships"), F.col("provider_type").alias("type"))
    return R.normalise_openalex(raw).select("cand_id", "title", "year", "doi", "abstract", "provider_type")


def r11_bundles(spark: SparkSession, root: str) -> DataFrame:
    meta = table(spark, root, "parse_results").select(F.col("paper_id").alias("doc_id"), F.when(F.col("paper_id") % 2 == 0, F.col("docname")).alias("title"), F.when(F.col("paper_id") % 3 == 0, F.lit("10.1/x")).alias("doi"), F.lit("10.1/y").alias("short_doi"))
    return R.source_bundle(I.docs(spark, root), meta)


def r5_abstracts(spark: SparkSession, root: str) -> DataFrame:
    pool = I.catalogue(spark, root).withColumn("abstract", F.when(F.col("source") == "openalex", F.concat(F.lit("On "), "title")))
    hits = j4_by_doi(spark, root).join(pool.select("cand_id", F.col("source").alias("route")), "cand_id")
    return R.fill_abstracts(R.merge(I.extracted(spark, root), hits, pool), pool).select("doc_id", "ref_idx", "match", "abstract")


def j6_sources(spark: SparkSession, root: str) -> DataFrame:
    sources = table(spark, root, "extracted_refs").select(F.col("ext_id").alias("doc_id"), "title", "authors", "year", "doi")
    return R.identify_sources(sources, I.catalogue(spark, root))


def j7_hydrated(spark: SparkSession, root: str) -> DataFrame:
    cited = table(spark, root, "candidates").groupBy(F.col("provider").alias("doc_id")).agg(F.array_sort(F.collect_list("cand_id")).alias("referenced"))
    works = table(spark, root, "candidates").select(F.col("cand_id").alias("work_id"), "title")
    return R.hydrate(cited, works).select("doc_id", "work_id", "cand_idx", "batch", "title")


def j17_caller(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "extracted_refs").select(F.col("ext_id").alias("cand_idx"), F.when(F.col("ext_id") % 2 == 0, F.col("title")).alias("title"), F.when(F.col("ext_id") % 2 == 1, F.col("title")).alias("article-title"), F.col("doi").alias("DOI"), F.concat(F.col("year").cast("string"), F.lit("-05-01")).alias("year"), F.lit(None).cast("string").alias("author"))
    return R.caller_references(rows).select("cand_idx", "title", "doi", "year")


def _by_doi(spark: SparkSession, root: str) -> DataFrame:
    """All references resolved by their DOI alone, which SQL can follow."""
    return R.merge(I.extracted(spark, root), j4_by_doi(spark, root).withColumn("route", F.lit("doi")), I.catalogue(spark, root))


def a6_routes(spark: SparkSession, root: str) -> DataFrame:
    return R.route_counts(_by_doi(spark, root))


def a6_outcomes(spark: SparkSession, root: str) -> DataFrame:
    return R.lookup_outcomes(I.lookups(spark, root))


def a7_difference(spark: SparkSession, root: str) -> DataFrame:
    rows = I.lookups(spark, root)
    count = lambda df: df.groupBy("provider", "outcome").agg(F.count(F.lit(1)).alias("n"))
    return R.stats_difference(count(rows.where("event_id % 2 = 0")), count(rows))


def k7_report(spark: SparkSession, root: str) -> DataFrame:
    return R.report_lines(_resolved(spark, root), I.extracted(spark, root))


def k8_export(spark: SparkSession, root: str) -> DataFrame:
    return R.export_citations(_by_doi(spark, root))


def g6_descriptions(spark: SparkSession, root: str) -> DataFrame:
    rows = I.extracted(spark, root).where("ext_id IS NOT NULL")
    family = F.when(F.size("authors") > 0, F.col("authors")[0]["family"])
    return rows.select("ext_id", R.describe_reference(family, F.col("year"), F.col("title")).alias("said"))


def k3_manifests(spark: SparkSession, root: str) -> DataFrame:
    links, refs = _links(spark, root), I.extracted(spark, root)
    return writers.citation_manifests(_resolved(spark, root), links, L.uncited(links, refs))


def b6_citations(spark: SparkSession, root: str) -> DataFrame:
    """The citation stage of every paper: index lines out, extraction, resolution, route by route."""
    from quirelake.operators.references import drop_index_entries

    kept = drop_index_entries(I.refs(spark, root), ties=("ref_id",))
    guess = E.extract_all(kept.select("doc_id", "ref_idx", "text"))
    rows = kept.select("doc_id", "ref_idx", F.col("text").alias("raw_text")).join(guess, ["doc_id", "ref_idx"], "left")
    return R.resolve(rows, I.catalogue(spark, root), misses=False).select("doc_id", "ref_idx", "title", "verified", "match")


_NAMES = (
    "a1_style j8_numbers j9_names t10_citekeys l1_markers l5_styles j12_uncited j15_rewritten a2_forms a8_equation_tags j2_zipped r7_keys parse15_fits parse16_invented a9_quality x1_extracted x1_printed x6_requests x6_lists x1_cached x1_batches a11_cache j4_by_doi r1_judged "
    "j5_chain o3_near_misses j3_best r4_resolved r3_merged r6_pool u1_pools r8_semanticscholar r9_crossref r10_openalex r11_bundles r5_abstracts j6_sources j7_hydrated j17_caller a6_routes a6_outcomes a7_difference k7_report k8_export "
    "g6_descriptions k3_manifests b6_citations"
).split()
QUERIES = {n: globals()[n] for n in _NAMES}

_X = f"WITH {I.EXTRACTED}"
_DOI = r"""lower(nullif(regexp_replace(regexp_extract({0}, '(?i)(10\.\d{{4,9}}/[^\s"''<>]+)', 1), '[.,;:)\]}}]+$', ''), ''))"""
_BYDOI = f"""{_X}, k AS (SELECT {_DOI.format('doi')} AS k, min(cand_id) AS cand_id FROM candidates WHERE title IS NOT NULL AND doi IS NOT NULL GROUP BY 1),
    hits AS (SELECT e.doc_id, e.ref_idx, k.cand_id FROM extracted e JOIN k ON {_DOI.format('e.doi')} = k.k)"""
_SOURCE = "CASE WHEN provider = 'semantic_scholar' THEN 'semanticscholar' ELSE provider END"
_SQUEEZE = r"trim(regexp_replace({0}, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{1680}}\x{{2028}}\x{{2029}}\x{{85}}\x{{1c}}-\x{{1f}}\x{{b}}]+', ' ', 'g'))"
_NT = "nullif(trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), '')"
_QUOTED = "replace(replace(url_encode({0}), '%2F', '/'), '%7E', '~')"
_CALM = r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(title, '[?*~]', ' ', 'g'), '[ \t\n\r\f\x{{b}}]+', ' ', 'g')), '\bAND\b', 'and', 'g'), '\bOR\b', 'or', 'g'), '\bNOT\b', 'not', 'g')), '')".replace("{{", "{").replace("}}", "}")
ORACLES = {
    "a1_style": f"""{_X}, c AS (SELECT doc_id, count(*) AS n, count(*) FILTER (trim(coalesce(citation_key, '')) <> '') AS present, count(*) FILTER (regexp_matches(trim(coalesce(citation_key, '')), '^\\[?\\(?\\d+[\\]).]?$')) AS numbered FROM extracted GROUP BY doc_id)
        SELECT doc_id, CASE WHEN present > 0 AND present * 2 >= n AND numbered * 2 >= present THEN 'numbered' ELSE 'author-year' END AS style FROM c""",
    "j8_numbers": f"{_X} SELECT doc_id, coalesce(try_cast(nullif(regexp_extract(citation_key, '(\\d+)', 1), '') AS INTEGER), ref_idx + 1) AS number, max(ref_idx) AS ref_idx FROM extracted GROUP BY 1, 2",
    "j9_names": f"""{_X}, k AS (SELECT doc_id, {fold('authors[1].family')} AS family, year, ref_idx FROM extracted WHERE len(authors) > 0 AND authors[1].family <> '' AND year IS NOT NULL)
        SELECT doc_id, family, year, CAST(max(ref_idx) AS INTEGER) AS ref_idx FROM k GROUP BY doc_id, family, year HAVING count(*) = 1""",
    "t10_citekeys": f"""{_X}, k AS (SELECT doc_id, ref_idx, year, CASE WHEN len(authors) > 0 THEN regexp_replace({fold('authors[1].family')}, '[^a-z0-9]+', '', 'g') ELSE '' END AS f FROM extracted) SELECT doc_id, ref_idx, CASE WHEN f <> '' THEN f || '_' || year END AS citekey FROM k""",
    "a6_routes": f"{_BYDOI} SELECT CASE WHEN h.cand_id IS NULL THEN 'unverified' ELSE 'doi' END AS route, count(*) AS n FROM extracted e LEFT JOIN hits h ON e.doc_id = h.doc_id AND e.ref_idx = h.ref_idx GROUP BY 1",
    "r5_abstracts": f"""{_BYDOI}, others AS (SELECT {_DOI.format('doi')} AS k, 'On ' || arg_min(title, cand_id) AS a FROM candidates WHERE title IS NOT NULL AND doi IS NOT NULL AND provider = 'openalex' GROUP BY 1)
        SELECT e.doc_id, e.ref_idx, {_SOURCE} AS "match", CASE WHEN c.provider = 'openalex' THEN 'On ' || c.title WHEN c.provider = 'crossref' THEN o.a END AS abstract
        FROM extracted e LEFT JOIN hits h ON e.doc_id = h.doc_id AND e.ref_idx = h.ref_idx LEFT JOIN candidates c ON h.cand_id = c.cand_id LEFT JOIN others o ON o.k = {_DOI.format("coalesce(nullif(c.doi, ''), e.doi)")}""",
    "k8_export": f"""{_BYDOI}, m AS (SELECT e.doc_id, e.ref_idx, coalesce(nullif(c.title, ''), e.title) AS title, coalesce(nullif(c.doi, ''), e.doi) AS doi, CASE WHEN len(c.authors) > 0 THEN c.authors ELSE e.authors END AS authors,
            CASE WHEN c.year IS NULL OR c.year = 0 OR c.year < coalesce(e.year, 0) THEN e.year ELSE c.year END AS year, e.container_title, e.volume FROM extracted e JOIN hits h ON e.doc_id = h.doc_id AND e.ref_idx = h.ref_idx JOIN candidates c ON h.cand_id = c.cand_id),
        j AS (SELECT doc_id, ref_idx, [CASE WHEN title <> '' THEN '"article-title":' || to_json(title) END, CASE WHEN doi <> '' THEN '"DOI":' || to_json(doi) END, CASE WHEN len(authors) > 0 AND authors[1].family <> '' THEN '"author":' || to_json(authors[1].family) END,
            CASE WHEN year IS NOT NULL THEN '"year":"' || year || '"' END, CASE WHEN container_title <> '' THEN '"journal-title":' || to_json(container_title) END, CASE WHEN volume <> '' THEN '"volume":' || to_json(volume) END] AS fs FROM m WHERE coalesce(title, '') <> '' OR coalesce(doi, '') <> '')
        SELECT doc_id, ref_idx, '{{' || array_to_string(list_filter(fs, lambda f: f IS NOT NULL), ',') || '}}' AS citation FROM j""",
    "a11_cache": f"""WITH {I.REFS}, b AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY ref_idx) - 1) // 50 AS batch, ref_idx, text FROM refs), k AS (SELECT doc_id, batch, to_json(list(text ORDER BY ref_idx)) AS key FROM b GROUP BY doc_id, batch)
        SELECT CASE WHEN key IN (SELECT key FROM k WHERE doc_id % 2 = 0) THEN 'cached' ELSE 'extracted' END AS outcome, count(*) AS n FROM k GROUP BY 1""",
    "a8_equation_tags": f"WITH {I.DOCS} SELECT doc_id, coalesce(list_max(list_transform(regexp_extract_all(markdown, '\\\\tag\\{{\\[?(\\d{{1,3}})\\]?\\}}', 1), lambda x: CAST(x AS INTEGER))), 0) AS top FROM docs",
    "j2_zipped": f"{_X} SELECT ref_id, title, year FROM extracted",
    "r7_keys": f"""{_X} SELECT ext_id, CASE WHEN NOT regexp_matches(citation_key, '^\\[?\\(?(\\d+)[\\]).]?$') OR regexp_extract(citation_key, '^\\[?\\(?(\\d+)[\\]).]?$', 1) = nullif(regexp_extract(raw_text, '^\\s*\\[?(\\d+)[\\]. ]?\\s', 1), '') THEN citation_key END AS citation_key FROM extracted WHERE ext_id IS NOT NULL""",
    "x1_batches": f"WITH {I.REFS}, p AS (SELECT ref_id, row_number() OVER (PARTITION BY doc_id ORDER BY ref_idx) - 1 AS p FROM refs) SELECT ref_id, CAST(p // 50 AS INTEGER) AS batch, CAST(p % 50 + 1 AS INTEGER) AS line FROM p",
    "x1_printed": """SELECT cand_id AS ref_idx, '[' || cand_id || ']' AS citation_key, 'Title ' || cand_id || ' on crystals' AS title, 'Family' || cand_id % 97 || ', A.; Other' || cand_id % 89 || ', B.' AS authors,
        CAST(1950 + cand_id % 70 AS INTEGER) AS year, 'Journal of Optics' AS container_title, CAST(cand_id % 50 + 1 AS VARCHAR) AS volume, '1' || cand_id % 9 || '-' || (20 + cand_id % 9) AS page_range, '10.5555/x.' || cand_id AS doi FROM candidates""",
    "x6_requests": f"""SELECT ext_id, 'https://api.semanticscholar.org/graph/v1/paper/search?query=' || {_QUOTED.format('title')} || '&fields=title,year,abstract,authors,externalIds,publicationTypes&limit=5' AS search_semanticscholar,
        'https://api.crossref.org/works?query.bibliographic=' || {_QUOTED.format('title')} || '&rows=5&mailto=a%40b.org' AS search_crossref, 'https://api.openalex.org/works?search=' || {_QUOTED.format(_CALM)} || '&per-page=5&mailto=a%40b.org' AS search_openalex,
        'https://api.semanticscholar.org/graph/v1/paper/DOI:' || {_QUOTED.format('doi')} || '?fields=title,year,abstract,authors,externalIds,publicationTypes' AS doi_semanticscholar,
        'https://api.openalex.org/works/doi:' || {_QUOTED.format('doi')} || '?select=id,display_name,publication_year,authorships,doi,abstract_inverted_index,type&mailto=a%40b.org' AS doi_openalex FROM extracted_refs""",
    "x6_lists": """WITH p AS (SELECT provider AS doc_id, cand_id, row_number() OVER (PARTITION BY provider ORDER BY cand_id) - 1 AS k FROM candidates)
        SELECT doc_id, CAST(k // 100 AS INTEGER) AS batch, 'https://api.openalex.org/works?filter=openalex_id:' || string_agg('W' || cand_id, '|' ORDER BY k) || '&per-page=100&select=id,display_name,publication_year,authorships,doi,abstract_inverted_index,type&mailto=a%40b.org' AS url FROM p GROUP BY doc_id, k // 100""",
    "x1_cached": "SELECT true AS agrees, count(*) AS n FROM raw_refs",
    "j4_by_doi": f"{_BYDOI} SELECT doc_id, ref_idx, cand_id FROM hits",
    "r3_merged": f"""{_BYDOI} SELECT e.doc_id, e.ref_idx, coalesce(nullif(c.title, ''), e.title) AS title, CASE WHEN c.year IS NULL OR c.year = 0 OR c.year < coalesce(e.year, 0) THEN e.year ELSE c.year END AS year,
        c.cand_id IS NOT NULL AS verified, {_SOURCE} AS source FROM extracted e LEFT JOIN hits h ON e.doc_id = h.doc_id AND e.ref_idx = h.ref_idx LEFT JOIN candidates c ON h.cand_id = c.cand_id""",
    "r6_pool": f"""WITH p AS (SELECT {_SOURCE} AS doc_id, cand_id AS cand_idx, {_NT} AS t, lower(nullif(doi, '')) AS d FROM candidates),
        f AS (SELECT *, CASE WHEN d IS NOT NULL THEN row_number() OVER (PARTITION BY doc_id, d ORDER BY cand_idx) = 1 ELSE true END AS first FROM p),
        s AS (SELECT *, coalesce(max(CASE WHEN first THEN 1 END) OVER (PARTITION BY doc_id, t ORDER BY cand_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM f)
        SELECT doc_id, cand_idx FROM s WHERE first AND (d IS NOT NULL OR t IS NULL OR seen = 0)""",
    "u1_pools": f"""WITH p AS (SELECT coalesce(year, 0) AS doc_id, row_number() OVER (PARTITION BY coalesce(year, 0) ORDER BY CASE provider WHEN 'crossref' THEN 0 ELSE 1 END, cand_id) - 1 AS cand_idx, title, {_SOURCE} AS source, {_NT} AS t, lower(nullif(doi, '')) AS d FROM candidates),
        f AS (SELECT *, CASE WHEN d IS NOT NULL THEN row_number() OVER (PARTITION BY doc_id, d ORDER BY cand_idx) = 1 ELSE true END AS first FROM p),
        s AS (SELECT *, coalesce(max(CASE WHEN first THEN 1 END) OVER (PARTITION BY doc_id, t ORDER BY cand_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM f)
        SELECT doc_id, CAST(cand_idx AS INTEGER) AS cand_idx, title, source FROM s WHERE first AND (d IS NOT NULL OR t IS NULL OR seen = 0)""",
    "r8_semanticscholar": "SELECT cand_id, title, year, doi, provider_type, CAST(CASE WHEN authors IS NULL THEN NULL ELSE len(authors) END AS INTEGER) AS n_authors FROM candidates WHERE provider = 'semantic_scholar'",
    "r9_crossref": "SELECT cand_id, title, year, doi, trim(title) AS abstract, provider_type FROM candidates WHERE provider = 'crossref'",
    "r10_openalex": "SELECT cand_id, title, year, regexp_replace(doi, '^https://doi.org/', '') AS doi, 'Theory of all' AS abstract, provider_type FROM candidates WHERE provider = 'openalex'",
    "r11_bundles": f"""SELECT paper_id AS doc_id, coalesce(CASE WHEN paper_id % 2 = 0 THEN nullif(docname, '') END, nullif({_SQUEEZE.format("regexp_extract(markdown, '(?m)^#[ ]+(.+)$', 1)")}, '')) AS title, CASE WHEN paper_id % 3 = 0 THEN '10.1/x' ELSE '10.1/y' END AS doi FROM parse_results""",
    "j7_hydrated": "SELECT provider AS doc_id, cand_id AS work_id, CAST(row_number() OVER (PARTITION BY provider ORDER BY cand_id) - 1 AS INTEGER) AS cand_idx, CAST((row_number() OVER (PARTITION BY provider ORDER BY cand_id) - 1) // 100 AS INTEGER) AS batch, title FROM candidates",
    "j17_caller": "SELECT ext_id AS cand_idx, nullif(title, '') AS title, nullif(doi, '') AS doi, year FROM extracted_refs WHERE nullif(title, '') IS NOT NULL OR nullif(doi, '') IS NOT NULL",
    "a6_outcomes": f"""WITH {I.LOOKUPS} SELECT provider, count(*) FILTER (outcome = 'ok') AS ok, count(*) FILTER (outcome = 'missing') AS missing, count(*) FILTER (outcome = '429') AS "429", count(*) FILTER (outcome = '5xx') AS "5xx",
        count(*) FILTER (outcome = '4xx') AS "4xx", count(*) FILTER (outcome = 'timeout') AS timeout, count(*) FILTER (outcome = 'error') AS error FROM lookups GROUP BY provider""",
    "a7_difference": f"WITH {I.LOOKUPS} SELECT provider, outcome, count(*) FILTER (event_id % 2 <> 0) AS n FROM lookups GROUP BY provider, outcome HAVING count(*) FILTER (event_id % 2 <> 0) <> 0",
    "g6_descriptions": f"""{_X} SELECT ext_id, concat_ws(' ', CASE WHEN len(authors) > 0 THEN authors[1].family END, CAST(year AS VARCHAR), '"' || title || '"') AS said FROM extracted WHERE ext_id IS NOT NULL""",
}
