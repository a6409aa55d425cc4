"""Figures, typesetting, sources, sinks, settings, streams and the driver's contract."""

from __future__ import annotations

import json
import os

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quirelake import config
from quirelake.operators import enrich as E
from quirelake.operators import typeset as Y
from quirelake.sources import providers, readers, writers
from quirelake.streaming import batch as B

MD = "# Title\n\n<page_number>1</page_number>\n\n" + "Prose words here. " * 20 + "\n\nFigure 1. lower\n\n<page_number>2</page_number>\n\nFIGURE 1. CAPS\n\nMore prose.\n\n**Fig. 2.1** bold**\n\nEnd."


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, markdown string")


def test_captions_and_context(spark):
    df = docs(spark, MD, None, "")
    got = {r.number: r for r in E.captions(df).collect()}
    assert (got["1"].caption, got["1"].page, got["1"].rank) == ("CAPS", 2, 0) and (got["2.1"].caption, got["2.1"].page) == ("bold", 2)
    known = spark.createDataFrame([(0, "Figure 1. lower and more of it")], "doc_id int, text string")
    assert {r.number: r.caption for r in E.captions(df, known).collect()} == {"1": "lower", "2.1": "bold"}
    head = E.paper_headers(df).orderBy("doc_id").collect()
    assert head[0].title == "Title" and head[0].abstract.startswith("Prose") and head[2].title == ""
    context = {r.number: (r.before, r.after) for r in E.neighbour_context(df, E.captions(df), 1).collect()}
    assert context["1"][1] == "More prose." and context["2.1"] == ("More prose.", "End.")
    out = E.splice_descriptions(df, E.captions(df).select("doc_id", "start", "line", F.lit("bar_chart").alias("figure_type"), F.lit("Bars.").alias("description")))
    text = {r.doc_id: r.markdown for r in out.collect()}
    assert "FIGURE 1. CAPS\n\n> **Figure description (auto, bar chart):** Bars.\n\nMore" in text[0] and text[1] is None


def test_crop_pairing(spark):
    crop = "doc_id string, page int, crop_idx int, bbox array<double>"
    cap = "doc_id string, page int, cap_idx int, bbox array<double>"
    box = lambda *v: [float(x) for x in v]
    crops = spark.createDataFrame([("d", 1, 0, box(0, 0, 10, 10)), ("d", 1, 1, box(0, 30, 10, 40)), ("d", 2, 0, box(0, 0, 40, 40)), ("d", 2, 1, box(42, 0, 80, 40)), ("d", 2, 2, box(300, 300, 310, 310)), ("d", 3, 0, None), ("d", 3, 1, None), ("d", 4, 0, None), ("d", 4, 1, None)], crop)
    caps = spark.createDataFrame([("d", 1, 0, box(0, 12, 10, 14)), ("d", 1, 1, box(0, 42, 10, 44)), ("d", 2, 0, box(0, 45, 40, 50)), ("d", 3, 0, box(0, 0, 1, 1)), ("d", 4, 0, box(0, 0, 1, 1)), ("d", 4, 1, None)], cap)
    assert rows(E.pair_crops(crops, caps).select("page", "crop_idx", "cap_idx")) == [(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 0), (3, 0, 0), (3, 1, 0), (4, 0, 0), (4, 1, 1)]
    numbers = caps.select("doc_id", "page", "cap_idx", F.concat("page", F.lit(".1")).alias("number"))
    names = {(r.page, r.crop_idx): r.name for r in E.crop_names(E.pair_crops(crops, caps), numbers).collect()}
    assert names[1, 0] == "fig_1.1.png" and names[2, 1] == "fig_2.1_2.png"
    assert E.pair_crops(crops.limit(0), caps).count() == 0


def test_describer_failures_and_cache(spark):
    tasks = spark.createDataFrame([("d", 1, 0, ["a"], "k1"), ("d", 1, 1, ["b"], "k2")], "doc_id string, page int, cap_idx int, paths array<string>, cache_key string")
    cache = spark.createDataFrame([("k1", "bar_chart", "Bars.")], "cache_key string, figure_type string, description string")

    def bad(paths):
        raise ValueError

    assert rows(E.describe_figures(tasks, cache, bad).select("cap_idx", "description")) == [(0, "Bars."), (1, None)]
    assert dict(rows(E.figure_stats(E.describe_figures(tasks, cache, bad), cache))) == {"cached": 1, "failed": 1}


def test_heading_levels(spark):
    text = "# CHAPTER 1\n\n# Start\n\n## One\n\n## One.\n\nbody\n\n## EXERCISES\n\n## Two\n\n## 2-1. First\n\ntext"
    df = docs(spark, text, None)
    plain = {r.pos: r.level for r in Y.resolve_levels(Y.headings(df)).collect()}
    assert plain == {0: "section", 1: "section", 2: "section", 3: "not_heading", 4: "section", 5: "section", 6: "section"}
    levels = spark.createDataFrame([(0, 0, "chapter"), (0, 1, "chapter"), (0, 4, "odd")], "doc_id int, pos int, level string")
    out = {r.doc_id: r.markdown for r in Y.apply_levels(df, levels).collect()}
    assert out[0] == "# CHAPTER 1: Start\n\n\n## One\n\nOne.\n\nbody\n\n## EXERCISES\n\n# Two\n\n## 2-1. First\n\ntext"
    candidates = Y.heading_candidates(df, 10).orderBy("pos").collect()
    assert candidates[3].following == "body" and candidates[3].preceding == "One" and candidates[0].preceding == ""
    notes = Y.convert_footnotes(docs(spark, "> **Footnote:** x\n\na\n\n> **Footnote:** y\n\n> **Footnote:** z")).first().markdown
    assert notes == "> **Footnote:** x\n\na[^1]\n\n[^1]: y[^2]\n\n[^2]: z"
    logs = spark.createDataFrame([(1, "! A\nx\n! B\n! A"), (2, None)], "doc_id int, log string")
    assert rows(Y.error_counts(logs)) == [(1, "A", 2, 1), (1, "B", 1, 2)]
    assert "<page_number>" not in Y.prepare(docs(spark, MD)).first().markdown


def test_settings(tmp_path):
    file = tmp_path / "c.toml"
    file.write_text('[chunk]\nmax_chars = 100\n[citations]\naccept = 1\nproviders = ["crossref"]\n')
    made = config.load_config(file)
    assert made.chunk.max_chars == 100 and made.citations.accept == 1.0 and made.citations.providers == ("crossref",)
    for bad in ("[x]\na = 1\n", "[chunk]\nx = 1\n", "[chunk]\nmax_chars = true\n", "[chunk]\nmax_chars = 1.5\n", '[citations]\nproviders = ["a"]\n', "[citations]\nproviders = []\n", "[citations]\nretries = 0\n"):
        file.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load_config(file)
    secret = tmp_path / "a.env"
    secret.write_text("QUIRELAKE_T1=x\n#no=1\n")
    with pytest.warns(UserWarning):
        secret.chmod(0o644)
        assert config.load_secrets(tmp_path) == ["QUIRELAKE_T1"]
    assert os.environ.pop("QUIRELAKE_T1") == "x"


def test_guard_and_atomic_write(tmp_path, spark):
    file = tmp_path / "r.md"
    assert writers.guard(file) == "proceed"
    writers.write_read_only(file, "one")
    assert writers.guard(file) == "proceed" and oct(file.stat().st_mode)[-3:] == "444"
    file.chmod(0o644)
    file.write_text("edited")
    with pytest.raises(writers.HandEdited):
        writers.guard(file)
    assert writers.guard(file, overwrite=True) == "back_up_and_overwrite" and len(list(tmp_path.glob("r.md.edited-*"))) == 1
    (tmp_path / "r.md.sha256").unlink()
    assert writers.guard(file) == "back_up_and_proceed"
    df = spark.createDataFrame([("a", None, None), ("b", "x", False), ("b", "x", True), (None, "x", False)], "content string, recorded string, overwrite boolean")
    assert sorted(r.action for r in writers.edit_guard(df).collect()) == ["back_up_and_overwrite", "back_up_and_proceed", "back_up_and_refuse", "proceed"]


def test_client():
    calls, now = [], [0.0]

    def transport(url):
        calls.append(url)
        if "limited" in url:
            raise providers.LookupFailed(429)
        if "gone" in url:
            raise providers.LookupFailed(404)
        return {"url": url}

    client = providers.Client("p", transport, attempts=2, cooldown_s=600, clock=lambda: now[0], sleep=lambda s: None)
    assert client.get("a&mailto=x") and client.get("a&mailto=y") and len(calls) == 1
    assert client.get("gone") is None and calls.count("gone") == 1
    client.get("limited1"), client.get("limited2"), client.get("gone"), client.get("limited3"), client.get("limited4")
    assert client.get("b") is not None
    for i in range(3):
        client.get(f"limited{i + 5}")
    assert client.get("c") is None and client.get("a") is not None and client.outcomes["cooling"] == 1
    now[0] = 601
    assert client.get("c") is not None
    with pytest.raises(providers.LookupFailed):
        providers.with_backoff(lambda: transport("limited"), 2, sleep=lambda s: None)


def test_manifests_and_readers(spark, tmp_path):
    chunks = spark.createDataFrame([("d", 1, "b", 2, 3, 5, "PARA"), ("d", 0, "a", None, None, 0, "-")], "doc_id string, idx int, text string, page_start int, page_end int, overlap_chars int, overlap_mode string")
    made = json.loads(writers.chunk_manifests(chunks).first().manifest)
    assert made["schema_version"] == 1 and [c["name"] for c in made["chunks"]] == ["d chunk 0", "d pages 2-3"]
    writers.write_texts(writers.chunk_manifests(chunks), str(tmp_path / "out"))
    assert (tmp_path / "out" / "doc_id=d").exists()
    (tmp_path / "docs" / "one").mkdir(parents=True)
    (tmp_path / "docs" / "one" / "text.md").write_text("# T\n\ntext")
    assert rows(readers.read_markdown(spark, str(tmp_path / "docs" / "*" / "*.md")).select("doc_id", "markdown")) == [("one", "# T\n\ntext")]
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 /Type /Page x /Type/Page /Type /Pages")
    assert readers.read_pdfs(spark, str(tmp_path)).first().n_pages == 2
    df = spark.createDataFrame([("key=s3cr%t and s3cr%25t",)], "t string")
    assert df.select(readers.secret_free(F.col("t"), ["s3cr%t"]).alias("t")).first().t == "key=*** and ***"
    wanted = spark.createDataFrame([("a", "1"), ("b", "2")], "p string, manifest_key string")
    done, again = readers.split_by_checkpoint(wanted, spark.createDataFrame([("1", "x")], "manifest_key string, out string"))
    assert rows(done.select("p", "out")) == [("a", "x")] and rows(again.select("p")) == [("b",)]


def brute_cooldown(outcomes, after, seconds):
    streak, until, asked = 0, None, []
    for ts, o in outcomes:
        if until is not None and ts < until:
            asked.append(False)
            continue
        asked.append(True)
        streak = streak + 1 if o == "429" else 0
        if streak == after:
            streak, until = 0, ts + pd.Timedelta(seconds=seconds)
    return asked


def test_cooldown_batch_and_stream_agree(spark, tmp_path):
    import random

    rng = random.Random(2)
    base = pd.Timestamp("2024-01-01")
    items = [(i, (base + pd.Timedelta(seconds=30 * i)).to_pydatetime(), rng.choice("pq"), rng.choice(["429", "429", "ok"])) for i in range(200)]
    df = spark.createDataFrame(items, "event_id bigint, ts timestamp, provider string, outcome string")
    want = {}
    for p in "pq":
        own = [x for x in items if x[2] == p]
        want |= dict(zip((x[0] for x in own), brute_cooldown([(pd.Timestamp(x[1]), x[3]) for x in own], 3, 300)))
    assert {r.event_id: r.asked for r in B.cooldown_batch(df, 3, 300).collect()} == want
    for part in range(2):
        df.where(f"event_id DIV 100 = {part}").coalesce(1).write.parquet(str(tmp_path / "in" / f"{part}"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = B.cooldown_stream(stream, 3, 300).writeStream.format("memory").queryName("cooling").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.event_id: r.asked for r in spark.sql("SELECT event_id, asked FROM cooling").collect()} == want


def test_streamed_chunks_equal_the_batch(spark, data):
    import __spark_entry__ as entry

    queries = entry.queries()
    assert rows(queries["b2_streamed_chunks"](spark, data)) == rows(queries["c3_chunks"](spark, data))


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout.split()[0]) > 100, done.stderr


def test_contract(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100


ORACLES = ["t1_page_markers", "t8_split_name", "t18_csl_type", "parse10_paragraph_kind", "parse1_dispatch", "parse6_markdown", "o1_reading_order", "w2_merged", "w7_merged_entries", "o2_sorted_refs", "k6_references_markdown", "r6_pool", "r3_merged", "w10_captions", "w16_candidates", "o6_nearest", "p7_found"]


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, data, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{data}/{f}')")
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = entry.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_whole_pipeline(spark):
    from quirelake import schemas
    from quirelake.operators.pipeline import refine

    items = [("d", 1, 0, "text", "doc_title", "A title", None, None), ("d", 1, 1, "text", "text", "As [1] and [2] show, it holds. " * 40, None, None), ("d", 2, 0, "text", "reference", "[1]", None, None), ("d", 2, 1, "text", "reference_content", "Boyd, S. “Learning convex optostratification from colour,” J. of X, 2009.", None, None)]
    items += [("d", 2, 2, "text", "text", "[2] Lee, K. “Smooth manifolds and periodic things revisited,” J. of Y, 2012.", None, None), ("void", 1, 0, "text", "header", "h", None, None)]
    regions = spark.createDataFrame(items, schemas.REGIONS)
    catalogue = spark.createDataFrame([(1, "Learning convex optostratification from colour", [("Boyd", "S.")], 2009, None, None, "crossref", "book")], "cand_id bigint, title string, authors array<struct<family:string,given:string>>, year int, doi string, abstract string, source string, provider_type string")
    out = refine(regions, catalogue)
    assert [(r.ref_idx, r.verified) for r in out.resolved.orderBy("ref_idx").collect()] == [(0, True), (1, False)]
    text = {r.doc_id: r.markdown for r in out.markdown.collect()}["d"]
    # authors and year of the unverified entry are read from print, so its marker gets a key too
    assert "[boyd_2009]" in text and "[lee_2012]" in text and rows(out.failed) == [("void", "no text")]
    assert {r.doc_id for r in out.chunks.collect()} == {"d"} and rows(out.links.select("doc_id", "style"))[0] == ("d", "numbered-bracket")
    assert refine(regions.limit(0), catalogue).chunks.count() == 0


def test_author_year_documents_link_and_a_second_run_asks_nothing(spark):
    from quirelake import schemas
    from quirelake.operators import extraction
    from quirelake.operators.pipeline import refine

    items = [("d", 1, 0, "text", "text", "As Boyd et al. (2009) show, it holds (see Lee, 2012). Nobody (1999) knows.", None, None)]
    items += [("d", 2, 0, "text", "reference_content", "Boyd, S. “Learning convex optostratification from colour,” Journal of X, 2009.", None, None), ("d", 2, 1, "text", "reference_content", "Lee, K. “Smooth manifolds and periodic things revisited,” Journal of Y, 2012.", None, None)]
    regions = spark.createDataFrame(items, schemas.REGIONS)
    catalogue = spark.createDataFrame([], "cand_id bigint, title string, authors array<struct<family:string,given:string>>, year int, doi string, abstract string, source string, provider_type string")
    first = refine(regions, catalogue)
    links = first.links.first()
    assert links.style == "author-year" and [list(m.refs) for m in links.markers] == [[0], [1]] and "Nobody (1999)" in links.ambiguous

    def never(raws):
        raise AssertionError("asked again")

    again = refine(regions, catalogue, model=never, cache=extraction.cache_entries(first.extracted))
    assert again.links.first().markers == links.markers and {r.cached for r in again.extracted.collect()} == {True}


def test_cache_files(tmp_path):
    from quirelake.sources import files

    path = files.cache_path(tmp_path / "c", "key")
    assert files.cache_path(None, "key") is None and files.read_cached(path) is None
    files.write_cached(path, {"a": 1})
    assert files.read_cached(path) == {"a": 1}
    path.write_text("{broken")
    assert files.read_cached(path) is None and files.read_cached(None) is None
    for name in ("p1_0.png", "fig_2.1.png", "mine.png"):
        (tmp_path / name).write_bytes(b"")
    assert files.clear_crops(tmp_path) == 2 and (tmp_path / "mine.png").exists()


def test_requests_hold_no_key_and_credentials_stay_on_their_host(spark):
    from quirelake.functions import requests as Q

    df = spark.createDataFrame([("Why SGD does NOT converge? a/b é", "10.1/x (y)", ["W1", "W2"]), ("???", None, []), (None, None, None)], "t string, d string, ids array<string>")
    got = df.select(Q.search_url("openalex", df.t, 3, "a@b.org"), Q.search_url("crossref", df.t), Q.doi_url("openalex", df.d, source=True), Q.works_url(df.ids), Q.references_url(F.lit("p 1"))).collect()
    assert got[0][0] == "https://api.openalex.org/works?search=Why%20SGD%20does%20not%20converge%20a/b%20%C3%A9&per-page=3&mailto=a%40b.org" and got[1][0] is None and got[2][0] is None
    assert got[0][1] == "https://api.crossref.org/works?query.bibliographic=Why%20SGD%20does%20NOT%20converge%3F%20a/b%20%C3%A9&rows=1" and got[0][3].startswith("https://api.openalex.org/works?filter=openalex_id:W1|W2&per-page=100")
    assert "doi:10.1/x%20%28y%29?select=" in got[0][2] and "/paper/p%201/references" in got[0][4]
    keys = {"openalex": "k1", "semanticscholar": "k2"}
    sent = Q.headers("openalex", keys, "a@b.org")
    assert sent == {"User-Agent": "quirelake/0.1 (mailto:a@b.org)", "Authorization": "Bearer k1"} and Q.headers("semanticscholar", keys, "a@b.org") == {"User-Agent": "quirelake/0.1", "x-api-key": "k2"} and "Authorization" not in Q.headers("crossref", keys)
    assert Q.redirected(sent, "https://api.openalex.org/x", "https://api.openalex.org/y") == sent and set(Q.redirected(sent, "https://api.openalex.org/x", "https://other.org/y")) == {"User-Agent"}
