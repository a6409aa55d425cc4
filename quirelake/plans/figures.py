"""Queries of figure enrichment, typesetting, manifests, checkpoints and streams over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.functions import text as X
from quirelake.operators import enrich as E
from quirelake.operators import typeset as Y
from quirelake.operators.chunk import chunk_markdown
from quirelake.plans import inputs as I
from quirelake.session import shared_dir, table
from quirelake.sources import readers, writers
from quirelake.streaming import batch as B


def _texts(spark: SparkSession, root: str) -> DataFrame:
    """Corpus documents, whose captions the figure operators read."""
    return table(spark, root, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("markdown"))


def t37_pages(spark: SparkSession, root: str) -> DataFrame:
    return E.page_at(E.lines_of(I.docs(spark, root))).select("doc_id", "line_no", "start", "page")


def f1_captions(spark: SparkSession, root: str) -> DataFrame:
    return E.caption_lines(_texts(spark, root)).select("doc_id", "line_no", "page", "number", "caption", "upper")


def w10_captions(spark: SparkSession, root: str) -> DataFrame:
    return E.captions(_texts(spark, root)).select("doc_id", "number", "caption", "rank")


def j11_known_captions(spark: SparkSession, root: str) -> DataFrame:
    docs = _texts(spark, root)
    known = E.caption_lines(docs).where("line_no % 2 = 1").select("doc_id", F.substring("line", 1, 40).alias("text"))
    return E.captions(docs, known).select("doc_id", "number", "caption")


def w12_headers(spark: SparkSession, root: str) -> DataFrame:
    return E.paper_headers(I.docs(spark, root))


def w11_context(spark: SparkSession, root: str) -> DataFrame:
    docs = _texts(spark, root)
    return E.neighbour_context(docs, E.captions(docs))


def _boxes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Crops and captions of the papers' pages: boxes by paragraph, every fifth a caption, the two after it crops, one diagonal to it."""
    rows = I.regions(spark, root).withColumn("k", F.col("idx"))
    captions = rows.where("k IN (0, 6)").select("doc_id", "page", (F.col("k") / 6).cast("int").alias("cap_idx"), "bbox", F.col("content").alias("text"))
    crops = rows.where("k IN (1, 2, 7, 9)").select("doc_id", "page", (F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("k")) - 1).alias("crop_idx"), "bbox")
    return crops, captions


def o6_nearest(spark: SparkSession, root: str) -> DataFrame:
    return E.nearest_captions(*_boxes(spark, root))


def j10_pairs(spark: SparkSession, root: str) -> DataFrame:
    return E.pair_crops(*_boxes(spark, root)).select("doc_id", "page", F.col("crop_idx").cast("int").alias("crop_idx"), "cap_idx")


def _named(spark: SparkSession, root: str) -> DataFrame:
    numbers = _boxes(spark, root)[1].select("doc_id", "page", "cap_idx", F.concat("page", F.lit("."), "cap_idx").alias("number"))
    return E.crop_names(j10_pairs(spark, root), numbers)


def f2_crop_names(spark: SparkSession, root: str) -> DataFrame:
    return _named(spark, root).select("doc_id", "page", "crop_idx", "number", "name")


def f2_renamed(spark: SparkSession, root: str) -> DataFrame:
    lines = _boxes(spark, root)[0].select("doc_id", F.struct("page", "crop_idx", F.concat(F.lit("![FIGURE_CROP "), "page", F.lit(":"), "crop_idx", F.lit("](crops/x.png)")).alias("l")).alias("s"))
    docs = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["l"]), "\n\n").alias("markdown"))
    return E.rename_placeholders(docs, _named(spark, root))


def _tasks(spark: SparkSession, root: str) -> DataFrame:
    pairs = j10_pairs(spark, root)
    files = pairs.select("doc_id", "page", "crop_idx", F.concat_ws("/", "doc_id", "page", "crop_idx").alias("path")).withColumn("sha256", F.sha2("path", 256))
    return E.describe_tasks(pairs, files)


def f3_tasks(spark: SparkSession, root: str) -> DataFrame:
    return _tasks(spark, root).withColumn("paths", F.array_join("paths", ","))


def f4_described(spark: SparkSession, root: str) -> DataFrame:
    tasks = _tasks(spark, root)
    cache = tasks.where("page = 1").select("cache_key", F.lit("line_plot").alias("figure_type"), F.lit("A curve.").alias("description"))
    made = E.describe_figures(tasks, cache, lambda paths: {"figure_type": "bar_chart", "description": f"{len(paths)} bars."})
    return made.select("doc_id", "page", "cap_idx", "figure_type", "description")


def a10_figure_stats(spark: SparkSession, root: str) -> DataFrame:
    tasks = _tasks(spark, root)
    cache = tasks.where("page = 1").select("cache_key", F.lit("line_plot").alias("figure_type"), F.lit("A curve.").alias("description"))
    return E.figure_stats(E.describe_figures(tasks, cache), cache)


def f5_spliced(spark: SparkSession, root: str) -> DataFrame:
    docs = _texts(spark, root)
    found = E.captions(docs).select("doc_id", "start", "line", F.lit("line_plot").alias("figure_type"), F.concat(F.lit("Figure "), "number").alias("description"))
    return E.splice_descriptions(docs, found)


def w16_candidates(spark: SparkSession, root: str) -> DataFrame:
    return Y.heading_candidates(I.docs(spark, root))


def w13_levels(spark: SparkSession, root: str) -> DataFrame:
    return Y.resolve_levels(Y.headings(I.docs(spark, root))).select("doc_id", F.col("pos").cast("int").alias("pos"), "level")


def _levels(spark: SparkSession, root: str) -> DataFrame:
    return Y.headings(I.docs(spark, root)).select("doc_id", "pos", F.when(F.col("pos") < 2, "chapter").when(F.col("pos") % 4 == 3, "not_heading").otherwise("section").alias("level"))


def w14_chapters(spark: SparkSession, root: str) -> DataFrame:
    return Y.apply_levels(I.docs(spark, root), _levels(spark, root))


def w15_promoted(spark: SparkSession, root: str) -> DataFrame:
    found = Y.headings(I.docs(spark, root)).withColumn("text", F.when(F.col("pos") % 3 == 1, F.concat((F.col("pos") + 1).cast("string"), F.lit("-1. "), "text")).otherwise(F.col("text")))
    return Y.promote_orphans(Y.resolve_levels(found)).select("doc_id", "pos", "level")


def w17_notes(spark: SparkSession, root: str) -> DataFrame:
    docs = I.docs(spark, root).select("doc_id", F.regexp_replace("markdown", r"\n\nLet ", "\n\n> **Footnote:** Let ").alias("markdown"))
    return Y.convert_footnotes(docs)


def b7_prepared(spark: SparkSession, root: str) -> DataFrame:
    return Y.prepare(I.docs(spark, root))


def o7_errors(spark: SparkSession, root: str) -> DataFrame:
    logs = table(spark, root, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"(?m)^(\S+) (\S+).*$", "! $1").alias("log"))
    return Y.error_counts(logs).select("doc_id", "error", "n", "rank")


def k1_manifests(spark: SparkSession, root: str) -> DataFrame:
    return writers.chunk_manifests(chunk_markdown(I.docs(spark, root)))


def k5_review(spark: SparkSession, root: str) -> DataFrame:
    return writers.review_copies(I.docs(spark, root))


def k10_guard(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "parse_results")
    recorded = F.when(F.col("paper_id") % 4 == 0, F.sha2("markdown", 256)).when(F.col("paper_id") % 4 != 1, F.sha2("docname", 256))
    return writers.edit_guard(rows.select("paper_id", F.col("markdown").alias("content"), recorded.alias("recorded"), (F.col("paper_id") % 4 == 2).alias("overwrite"))).select("paper_id", "action")


def g4_manifest_keys(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "parse_results").select("paper_id", F.sha2("markdown", 256).alias("content_id"))
    return rows.select("paper_id", readers.manifest_key("1", "content_id", {"model": "layout"}).alias("key"))


def s5_checkpoint(spark: SparkSession, root: str) -> DataFrame:
    """Papers whose text was parsed before, by content: parses of the same text under another id."""
    rows = table(spark, root, "parse_results").select("paper_id", F.sha2("markdown", 256).alias("manifest_key"))
    done = rows.groupBy("manifest_key").agg(F.min("paper_id").alias("done_as"))
    reused, again = readers.split_by_checkpoint(rows.join(done, "manifest_key").where("paper_id <> done_as").select("paper_id", "manifest_key"), done)
    return reused.select("paper_id", "done_as")


def b4_missing_parts(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "parse_results").select("paper_id", F.col("paper_id").alias("manifest_key"))
    done = table(spark, root, "chunks").select(F.col("paper_id").alias("manifest_key")).distinct()
    return readers.split_by_checkpoint(rows, done)[1].select("paper_id")


def s8_meta(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "parse_results").select("paper_id", F.concat(F.lit("file:///data//"), "docname").alias("path"))
    meta = table(spark, root, "parse_results").where("lib_id % 2 = 0").groupBy("docname").agg(F.max("paper_id").alias("latest")).select(F.concat(F.lit("/data/"), "docname").alias("path"), "latest")
    return readers.join_meta(docs, meta).select("paper_id", "latest")


def w18_cooldown(spark: SparkSession, root: str) -> DataFrame:
    return B.cooldown_batch(I.lookups(spark, root), after=2, seconds=600).select("event_id", "provider", "asked")


def b2_streamed_chunks(spark: SparkSession, root: str) -> DataFrame:
    """The chunks of all papers by the streaming engine, read back; equal to the batch."""
    import uuid

    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = f"{root}/parse_results.parquet"
    schema = spark.read.parquet(source).schema
    docs = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(source if _is_folder(spark, source) else f"{root}/parse_results.parque[t]")
    query = B.stream_chunks(docs.select(F.col("paper_id").alias("doc_id"), "markdown"), f"{base}/chunks", f"{base}/state", dead_letters=f"{base}/dead")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/chunks").drop("batch")


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


_NAMES = (
    "t37_pages f1_captions w10_captions j11_known_captions w12_headers w11_context o6_nearest j10_pairs f2_crop_names f2_renamed f3_tasks f4_described a10_figure_stats f5_spliced w16_candidates w13_levels w14_chapters w15_promoted "
    "w17_notes b7_prepared o7_errors k1_manifests k5_review k10_guard g4_manifest_keys s5_checkpoint b4_missing_parts s8_meta w18_cooldown b2_streamed_chunks"
).split()
QUERIES = {n: globals()[n] for n in _NAMES}

_CAPTION = r"^[ \t]*\**[ \t]*(FIGURE|Figure|FIG|Fig)\.?[ \t]*(\d+(?:\.\d+)?)\b[.:]?[ \t]*([^\n]*)$"
_DLINES = (
    "d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), dlines AS (SELECT doc_id, CAST(unnest(generate_series(1, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line FROM d),"
    r" paged AS (SELECT *, last_value(CASE WHEN len(ns) > 0 THEN ns[-1] END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS page FROM (SELECT *, list_transform(regexp_extract_all(line, '<page_number>\s*(\d+)\s*</page_number>', 1), lambda x: CAST(x AS INTEGER)) AS ns FROM dlines)),"
    f" caps AS (SELECT doc_id, line_no, page, regexp_extract(line, '{_CAPTION}', 2) AS number, trim(trim(trim(regexp_extract(line, '{_CAPTION}', 3)), '*')) AS caption, upper(regexp_extract(line, '{_CAPTION}', 1)) = regexp_extract(line, '{_CAPTION}', 1) AS upper FROM paged WHERE regexp_matches(line, '{_CAPTION}'))"
)
_HEAD = r"^(#{1,2})\s+(.*)$"
_HEADS = f"{I.LINES}, heads AS (SELECT doc_id, line_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS INTEGER) AS pos, regexp_extract(line, '{_HEAD}', 2) AS text FROM lines WHERE regexp_matches(line, '{_HEAD}'))"
_NORM = r"upper(rtrim(trim(regexp_replace(text, '[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), '.'))"
ORACLES = {
    "t37_pages": f"""WITH {I.LINES}, s AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start,
        list_transform(regexp_extract_all(line, '<page_number>\\s*(\\d+)\\s*</page_number>', 1), lambda x: CAST(x AS INTEGER)) AS ns FROM lines)
        SELECT doc_id, line_no, start, last_value(CASE WHEN len(ns) > 0 THEN ns[-1] END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS page FROM s""",
    "f1_captions": f"WITH {_DLINES} SELECT * FROM caps",
    "w10_captions": f"""WITH {_DLINES}, p AS (SELECT *, min(line_no) OVER (PARTITION BY doc_id, number) AS first, row_number() OVER (PARTITION BY doc_id, number ORDER BY upper DESC, line_no) AS n FROM caps)
        SELECT doc_id, number, caption, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS INTEGER) AS rank FROM p WHERE n = 1""",
    "w13_levels": f"WITH {_HEADS} SELECT doc_id, pos, CASE WHEN {_NORM} = lag({_NORM}) OVER (PARTITION BY doc_id ORDER BY pos) THEN 'not_heading' ELSE 'section' END AS level FROM heads",
    "w16_candidates": f"""WITH {_HEADS}, h AS (SELECT *, lead(line_no) OVER (PARTITION BY doc_id ORDER BY pos) AS until FROM heads), b AS (SELECT h.doc_id, h.pos, string_agg(trim(l.line, ' ' || chr(9)), ' ' ORDER BY l.line_no) AS t FROM h JOIN lines l ON l.doc_id = h.doc_id AND l.line_no > h.line_no AND (h.until IS NULL OR l.line_no < h.until) WHERE trim(l.line, ' ' || chr(9)) <> '' GROUP BY 1, 2)
        SELECT h.doc_id, h.pos, coalesce(lag(h.text) OVER (PARTITION BY h.doc_id ORDER BY h.pos), '') AS preceding, h.text, coalesce(substring(b.t, 1, 220), '') AS following FROM h LEFT JOIN b ON h.doc_id = b.doc_id AND h.pos = b.pos""",
    "k10_guard": """SELECT paper_id, CASE paper_id % 4 WHEN 0 THEN 'proceed' WHEN 1 THEN 'back_up_and_proceed' WHEN 2 THEN 'back_up_and_overwrite' ELSE 'back_up_and_refuse' END AS action FROM parse_results""",
    "s5_checkpoint": "SELECT p.paper_id, d.done_as FROM parse_results p JOIN (SELECT markdown, min(paper_id) AS done_as FROM parse_results GROUP BY markdown) d ON p.markdown = d.markdown WHERE p.paper_id <> d.done_as",
    "b4_missing_parts": "SELECT paper_id FROM parse_results WHERE paper_id NOT IN (SELECT paper_id FROM chunks WHERE paper_id IS NOT NULL)",
    "s8_meta": "SELECT p.paper_id, m.latest FROM parse_results p LEFT JOIN (SELECT docname, max(paper_id) AS latest FROM parse_results WHERE lib_id % 2 = 0 GROUP BY docname) m ON p.docname = m.docname",
    "o6_nearest": f"""WITH {I.REGIONS}, r AS (SELECT doc_id, page, idx AS k, CASE WHEN kk < 6 THEN 50.0 ELSE 520.0 END AS x1, 100.0 + 130 * (kk % 6) AS y1, CASE WHEN kk < 6 THEN 480.0 ELSE 950.0 END AS x2, 200.0 + 130 * (kk % 6) AS y2 FROM (SELECT doc_id, page, idx_in_page AS idx, k AS kk FROM swapped)),
        c AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY k) - 1 AS INTEGER) AS crop_idx FROM r WHERE k IN (1, 2, 7, 9)), m AS (SELECT *, CAST(k / 6 AS INTEGER) AS cap_idx FROM r WHERE k IN (0, 6)),
        g AS (SELECT c.doc_id, c.page, c.crop_idx, m.cap_idx, greatest(m.x1 - c.x2, c.x1 - m.x2, 0.0) AS gx, greatest(m.y1 - c.y2, c.y1 - m.y2, 0.0) AS gy, (c.x1 + c.x2 - m.x1 - m.x2) / 2 AS cx, (c.y1 + c.y2 - m.y1 - m.y2) / 2 AS cy FROM c LEFT JOIN m ON c.doc_id = m.doc_id AND c.page = m.page),
        q AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, crop_idx ORDER BY CASE WHEN cap_idx IS NULL OR (gx > 0 AND gy > 0) THEN 1 ELSE 0 END, greatest(gx, gy), cx * cx + cy * cy, cap_idx) AS n FROM g)
        SELECT doc_id, page, crop_idx, CASE WHEN gx > 0 AND gy > 0 THEN NULL ELSE cap_idx END AS cap_idx FROM q WHERE n = 1""",
}
_PAIRED = ORACLES["o6_nearest"].replace("SELECT doc_id, page, crop_idx, CASE WHEN", ", near AS (SELECT doc_id, page, crop_idx, CASE WHEN") + ")"
ORACLES |= {
    "j10_pairs": _PAIRED + " SELECT * FROM near WHERE cap_idx IS NOT NULL",
    "f2_crop_names": _PAIRED + """ SELECT doc_id, page, crop_idx, page || '.' || cap_idx AS number, 'fig_' || page || '.' || cap_idx || CASE WHEN count(*) OVER (PARTITION BY doc_id, page, cap_idx) > 1
        THEN '_' || row_number() OVER (PARTITION BY doc_id, page, cap_idx ORDER BY crop_idx) ELSE '' END || '.png' AS name FROM near WHERE cap_idx IS NOT NULL""",
    "w15_promoted": f"""WITH {_HEADS}, t AS (SELECT doc_id, pos, CASE WHEN pos % 3 = 1 THEN (pos + 1) || '-1. ' || text ELSE text END AS text FROM heads),
        l AS (SELECT *, CASE WHEN {_NORM} = lag({_NORM}) OVER (PARTITION BY doc_id ORDER BY pos) THEN 'not_heading' ELSE 'section' END AS level FROM t),
        k AS (SELECT doc_id, pos, text, lead(text) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM l WHERE level <> 'not_heading')
        SELECT l.doc_id, l.pos, CASE WHEN regexp_matches(trim(k.after), '^\\d+-1\\.') AND upper(rtrim(trim(k.text), '.')) <> 'EXERCISES' THEN 'chapter' ELSE l.level END AS level FROM l LEFT JOIN k ON l.doc_id = k.doc_id AND l.pos = k.pos""",
    "k5_review": r"""WITH p AS (SELECT paper_id AS doc_id, string_split(markdown, '$$') AS ps FROM parse_results)
        SELECT doc_id, array_to_string(list_transform(ps, lambda p, i: CASE WHEN i % 2 = 0 AND (len(ps) % 2 = 1 OR i < len(ps)) AND contains(p, chr(10)) THEN trim(regexp_replace(p, '\s*\n\s*', ' ', 'g')) ELSE p END), '$$') AS markdown FROM p""",
    "g4_manifest_keys": """SELECT paper_id, sha256('{"version":"1","content_id":"' || sha256(markdown) || '","model":"layout"}') AS key FROM parse_results""",
    "w18_cooldown": f"""WITH RECURSIVE {I.LOOKUPS}, o AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY ts, event_id) AS k FROM lookups),
        fold AS (SELECT provider, k, event_id, true AS asked, CASE WHEN outcome = '429' THEN 1 ELSE 0 END AS streak, CAST(NULL AS TIMESTAMP) AS until FROM o WHERE k = 1
            UNION ALL SELECT o.provider, o.k, o.event_id, f.until IS NULL OR o.ts >= f.until, CASE WHEN f.until IS NOT NULL AND o.ts < f.until THEN f.streak WHEN o.outcome <> '429' OR f.streak >= 1 THEN 0 ELSE f.streak + 1 END,
                CASE WHEN f.until IS NOT NULL AND o.ts < f.until THEN f.until WHEN o.outcome = '429' AND f.streak >= 1 THEN o.ts + INTERVAL 600 SECOND END FROM fold f JOIN o ON o.provider = f.provider AND o.k = f.k + 1)
        SELECT event_id, provider, asked FROM fold""",
}

_SPACES = r"[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}\x{1680}\x{2028}\x{2029}\x{85}\x{1c}-\x{1f}\x{b}]+"
_flat = lambda value: f"trim(regexp_replace({value}, '{_SPACES}', ' ', 'g'))"
_told = lambda value: f"trim(regexp_replace({value}, '{_SPACES}', ' ', 'g'), '* ')"
_EDGES = "' ' || chr(9) || chr(10)"
_IS_PROSE = (
    r"(s <> '' AND NOT (regexp_matches(s, '^<page_number>\s*(\d+)\s*</page_number>$') OR regexp_matches(s, '^(?:#|!\[|\$\$|>|\|)')"
    r" OR regexp_matches(s, '^[ \t]*\**[ \t]*(FIGURE|Figure|FIG|Fig)\.?[ \t]*(\d+(?:\.\d+)?)\b[.:]?[ \t]*([^\n]*)$')))"
)
_TASKS = _PAIRED + """, tasks AS (SELECT doc_id, page, cap_idx, count(*) AS n, string_agg(doc_id || '/' || page || '/' || crop_idx, ',' ORDER BY crop_idx) AS paths,
    sha256(string_agg(sha256(doc_id || '/' || page || '/' || crop_idx), '|' ORDER BY crop_idx)) AS cache_key FROM near WHERE cap_idx IS NOT NULL GROUP BY doc_id, page, cap_idx)"""
_CHOSEN = f"""{_DLINES}, placed AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM dlines),
    picked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, number ORDER BY upper DESC, line_no) AS pick FROM caps), chosen AS (SELECT p.doc_id, p.line_no, p.number, l.start FROM picked p JOIN placed l ON p.doc_id = l.doc_id AND p.line_no = l.line_no WHERE pick = 1)"""
ORACLES |= {
    "f2_renamed": _PAIRED + """, named AS (SELECT doc_id, page, crop_idx, page || '.' || cap_idx AS number, 'fig_' || page || '.' || cap_idx || CASE WHEN count(*) OVER (PARTITION BY doc_id, page, cap_idx) > 1
        THEN '_' || row_number() OVER (PARTITION BY doc_id, page, cap_idx ORDER BY crop_idx) ELSE '' END || '.png' AS name FROM near WHERE cap_idx IS NOT NULL)
        SELECT c.doc_id, string_agg(CASE WHEN n.name IS NULL THEN '![FIGURE_CROP ' || c.page || ':' || c.crop_idx || '](crops/x.png)' ELSE '![FIGURE ' || n.number || '](' || n.name || ')' END, chr(10) || chr(10) ORDER BY c.page, c.crop_idx) AS markdown
        FROM near c LEFT JOIN named n ON c.doc_id = n.doc_id AND c.page = n.page AND c.crop_idx = n.crop_idx GROUP BY c.doc_id""",
    "f3_tasks": _TASKS + " SELECT doc_id, page, cap_idx, paths, cache_key FROM tasks",
    "f4_described": _TASKS + " SELECT doc_id, page, cap_idx, CASE WHEN page = 1 THEN 'line_plot' ELSE 'bar_chart' END AS figure_type, CASE WHEN page = 1 THEN 'A curve.' ELSE n || ' bars.' END AS description FROM tasks",
    "a10_figure_stats": _TASKS + " SELECT CASE WHEN page = 1 THEN 'cached' ELSE 'failed' END AS outcome, count(*) AS n FROM tasks GROUP BY 1",
    "f5_spliced": f"""WITH {_CHOSEN} SELECT l.doc_id, string_agg(line || CASE WHEN c.number IS NULL THEN '' ELSE chr(10) || chr(10) || '> **Figure description (auto, line plot):** Figure ' || c.number END, chr(10) ORDER BY l.line_no) AS markdown
        FROM dlines l LEFT JOIN chosen c ON l.doc_id = c.doc_id AND l.line_no = c.line_no GROUP BY l.doc_id""",
    "w12_headers": f"""WITH {I.PARAGRAPHS}, t AS (SELECT doc_id, idx, trim(paragraph, {_EDGES}) AS s FROM paragraphs),
        h AS (SELECT doc_id, arg_min({_told("regexp_replace(s, '^[# ]+', '')")}, idx) AS title FROM t WHERE starts_with(s, '# ') GROUP BY doc_id), a AS (SELECT doc_id, arg_min({_flat('s')}[1:2000], idx) AS abstract FROM t WHERE {_IS_PROSE} AND length(s) >= 300 GROUP BY doc_id)
        SELECT d.doc_id, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract FROM (SELECT paper_id AS doc_id FROM parse_results) d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN a ON d.doc_id = a.doc_id""",
    "w11_context": f"""WITH {_CHOSEN}, ps AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10) || chr(10)) AS ps FROM documents), p AS (SELECT doc_id, unnest(generate_series(0, len(ps) - 1)) AS idx, unnest(ps) AS p FROM ps),
        q AS (SELECT doc_id, idx, p, trim(p, {_EDGES}) AS s, coalesce(sum(length(p) + 2) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM p),
        own AS (SELECT c.doc_id, c.number, max(q.idx) AS own FROM chosen c JOIN q ON c.doc_id = q.doc_id AND q.at <= c.start GROUP BY c.doc_id, c.number), prose AS (SELECT doc_id, idx, {_flat('p')} AS p FROM q WHERE {_IS_PROSE}),
        b AS (SELECT o.doc_id, number, idx, p, row_number() OVER (PARTITION BY o.doc_id, number ORDER BY idx DESC) AS n FROM own o JOIN prose r ON o.doc_id = r.doc_id AND idx < own), f AS (SELECT o.doc_id, number, idx, p, row_number() OVER (PARTITION BY o.doc_id, number ORDER BY idx) AS n FROM own o JOIN prose r ON o.doc_id = r.doc_id AND idx > own),
        bs AS (SELECT doc_id, number, string_agg(p, chr(10) || chr(10) ORDER BY idx) AS before FROM b WHERE n <= 2 GROUP BY doc_id, number), fs AS (SELECT doc_id, number, string_agg(p, chr(10) || chr(10) ORDER BY idx) AS after FROM f WHERE n <= 2 GROUP BY doc_id, number)
        SELECT o.doc_id, o.number, coalesce(before, '') AS before, coalesce(after, '') AS after FROM own o LEFT JOIN bs ON o.doc_id = bs.doc_id AND o.number = bs.number LEFT JOIN fs ON o.doc_id = fs.doc_id AND o.number = fs.number""",
    "j11_known_captions": f"""WITH {_DLINES}, k AS (SELECT doc_id, regexp_extract(substring(line, 1, 40), '{_CAPTION}', 2) AS number, {_told('substring(line, 1, 40)')} AS k FROM dlines WHERE line_no % 2 = 1 AND regexp_matches(line, '{_CAPTION}')),
        lined AS (SELECT c.*, {_told('l.line')} AS told FROM caps c JOIN dlines l ON c.doc_id = l.doc_id AND c.line_no = l.line_no),
        good AS (SELECT * FROM lined l WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = l.doc_id AND k.number = l.number AND k.number <> '') OR EXISTS (SELECT 1 FROM k WHERE k.doc_id = l.doc_id AND k.number = l.number AND (starts_with(k.k, l.told) OR starts_with(l.told, k.k)))),
        p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, number ORDER BY upper DESC, line_no) AS n FROM good) SELECT doc_id, number, caption FROM p WHERE n = 1""",
    "w17_notes": rf"""WITH p AS (SELECT paper_id AS doc_id, string_split(replace(markdown, chr(10) || chr(10) || 'Let ', chr(10) || chr(10) || '> **Footnote:** Let '), chr(10) || chr(10)) AS ps FROM parse_results), q AS (SELECT doc_id, unnest(generate_series(0, len(ps) - 1)) AS idx, unnest(ps) AS p FROM p),
        n AS (SELECT *, idx > 0 AND regexp_matches(trim(p, {_EDGES}), '(?s)^> \*\*Footnote:\*\* (.+)$') AS note FROM q), k AS (SELECT *, sum(CASE WHEN note THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx) AS k, coalesce(lead(note) OVER (PARTITION BY doc_id ORDER BY idx), false) AS next FROM n)
        SELECT doc_id, string_agg(CASE WHEN note THEN '[^' || k || ']: ' || substring(trim(p, {_EDGES}), 17) ELSE p END || CASE WHEN next THEN '[^' || (k + 1) || ']' ELSE '' END, chr(10) || chr(10) ORDER BY idx) AS markdown FROM k GROUP BY doc_id""",
    "o7_errors": rf"""WITH {_DLINES}, e AS (SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '^\S+ \S+') THEN regexp_extract(line, '^(\S+) \S+', 1) WHEN regexp_matches(line, '^! (.+)$') THEN regexp_extract(line, '^! (.+)$', 1) END AS error FROM dlines),
        c AS (SELECT doc_id, error, count(*) AS n, min(line_no) AS first FROM e WHERE error IS NOT NULL GROUP BY doc_id, error) SELECT doc_id, error, n, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS INTEGER) AS rank FROM c""",
}
