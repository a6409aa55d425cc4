"""Linking, extraction checks and resolution: rules, brute force, awkward tables."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quirelake.functions import blocks
from quirelake.operators import extraction as E
from quirelake.operators import linking as L
from quirelake.operators import resolve as R

AUTHORS = "array<struct<family:string,given:string>>"
REFS = f"doc_id string, ref_idx int, citation_key string, authors {AUTHORS}, year int"
NUMBERS = {1: 0, 2: 1, 3: 2, 7: 6, 8: 7}
NUMBERED = [
    ("a [1] b [7,8] c [2-3]", "bracket", [[0], [6, 7], [1, 2]], []), ("unit [0,1] square", "bracket", [], ["[0,1]"]), ("in $x_{[1]}$ and $$[2]$$", "bracket", [], []), ("[3-2] [1-90]", "bracket", [], []),
    ("see (1, 2) here", "paren", [[0, 1]], []), ("Eq. (2) and equations (3)", "paren", [], ["(2)", "(3)"]), ("x\n\n(2)\n\ny", "paren", [], ["(2)"]), (r"\tag{[2]} equations (7, 8)", "paren", [[6, 7]], []), ("", "bracket", [], []), (None, "paren", [], []),
    ("(see [1]) and [[2]]", "bracket", [[0], [1]], []), ("(2)", "paren", [], ["(2)"]), ("😀 [1] $a$ [3] $b$", "bracket", [[0], [2]], []),
]


def test_numbered(spark):
    docs = spark.createDataFrame([(str(i), t[0]) for i, t in enumerate(NUMBERED)], "doc_id string, markdown string")
    numbers = spark.createDataFrame([(str(i), k, v) for i in range(len(NUMBERED)) for k, v in NUMBERS.items()], "doc_id string, number int, ref_idx int")
    tops = spark.createDataFrame([("7", 2)], "doc_id string, top int")
    got = L.numbered_tokens(L.tokens(docs), tops, numbers).orderBy("start").collect()
    for i, (text, form, kept, rejected) in enumerate(NUMBERED):
        own = [r for r in got if r.doc_id == str(i) and r.form == form]
        assert [list(r.refs) for r in own if r.good] == kept and [r.token for r in own if not r.good] == rejected
        assert all(text[r.start : r.end_at] == r.token for r in own)


def test_author_year(spark):
    text = "As (see Höhn et al., 2020; Lee, 2021) and Lee and Kim (2021b) say, (Doe, 1999) not. (Lee, 2021) Doe (1999)."
    docs = spark.createDataFrame([("d", text)], "doc_id string, markdown string")
    names = spark.createDataFrame([("d", "hohn", 2020, 0), ("d", "lee", 2021, 1)], "doc_id string, family string, year int, ref_idx int")
    got = L.named_tokens(L.tokens(docs), names).orderBy("start").collect()
    assert [list(r.refs) for r in got if r.good] == [[0, 1], [1], [1]] and [r.token for r in got if not r.good] == ["(2021b)", "(Doe, 1999)", "Doe (1999)", "(1999)"]
    assert all(text[r.start : r.end_at] == r.token for r in got)


def test_links_end_to_end(spark):
    refs = spark.createDataFrame(
        [("n", 0, "[1]", [("Höhn", "A.")], 2020), ("n", 1, "2.", [("Lee", "K.")], 2021), ("n", 2, None, None, None), ("y", 0, None, [("Höhn", "A.")], 2020), ("y", 1, None, [("Lee", None)], 2021), ("y", 2, None, [("Lee", "B.")], 2021), ("y", 3, None, [], 2021)], REFS
    )
    docs = spark.createDataFrame([("n", "😀 a [1] b [1, 2] c [3] d [9]"), ("y", "Hohn et al. (2020) and (Lee, 2021)"), ("none", "x [1]"), ("void", None)], "doc_id string, markdown string")
    links = L.scan_markers(docs, refs)
    got = {r.doc_id: (r.style, [(m.start, m.text, list(m.refs)) for m in r.markers], list(r.ambiguous)) for r in links.collect()}
    assert got["n"] == ("numbered-bracket", [(4, "[1]", [0]), (10, "[1, 2]", [0, 1]), (19, "[3]", [2])], ["[9]"])
    assert got["y"] == ("author-year", [(0, "Hohn et al. (2020)", [0])], ["(2020)", "(Lee, 2021)"])
    assert got["none"] == ("author-year", [], []) and got["void"] == ("author-year", [], [])
    assert rows(L.uncited(links, refs)) == [("y", 1), ("y", 2), ("y", 3)]
    keys = L.citekeys(refs)
    assert rows(keys.where("doc_id = 'y'")) == [("y", 0, "hohn_2020"), ("y", 1, "lee_2021"), ("y", 2, "lee_2021"), ("y", 3, None)]
    out = {r.doc_id: r.markdown for r in L.rewrite(docs, L.marker_keys(links, keys)).collect()}
    assert out["n"] == "😀 a [hohn_2020] b [hohn_2020; lee_2021] c [3] d [9]" and out["y"] == "[hohn_2020] and (Lee, 2021)" and out["none"] == "x [1]" and out["void"] is None
    assert L.scan_markers(docs.limit(0), refs).count() == 0 and L.scan_markers(docs, refs.limit(0)).count() == 4


def test_style_and_number_index(spark):
    make = lambda d, keys: [(d, i, k, None, None) for i, k in enumerate(keys)]
    refs = spark.createDataFrame(make("a", ["[1]", "(2)", None]) + make("b", [None, None, "[1]"]) + make("c", ["Boy20", "[2]"]) + make("d", ["Boy20", "Lee21", "[1]"]) + make("e", ["[2]", "[2]", None]), REFS)
    assert dict(rows(L.marker_style(refs))) == {"a": "numbered", "b": "author-year", "c": "numbered", "d": "author-year", "e": "numbered"}
    assert [r for r in rows(L.number_index(refs)) if r[0] == "e"] == [("e", 2, 1), ("e", 3, 2)]


def test_row_fits_and_alignment():
    raws = ["[1] Boyd, S. Convex optimization methods. 2004.", "[2] Lee, J. Smooth manifolds revisited. 2012.", "[3] Kim, K. Deep networks explained. 2020."]
    row = lambda line, key, title: {"line": line, "citation_key": key, "title": title, "authors": []}
    good = [row(1, "[1]", "Convex optimization methods"), row(2, "[2]", "Smooth manifolds revisited"), row(3, "[3]", "Deep networks explained")]
    assert E.align_rows(good, raws) == good
    assert E.align_rows([good[0], good[2]], raws) == [good[0], None, good[2]]
    echoed = [row(1, None, "Convex optimization methods"), row(1, None, "Smooth manifolds revisited"), row(3, None, "Deep networks explained")]
    assert E.align_rows(echoed, raws) == [echoed[0], None, echoed[2]]
    assert E.align_rows([row(2, "[3]", "Deep networks explained")], raws) == [None, None, row(2, "[3]", "Deep networks explained")]
    assert not E.row_fits(row(1, "[2]", "Convex optimization methods"), raws[0]) and not E.row_fits(row(1, None, "Other things entirely"), raws[0])
    assert E.row_fits({"title": None, "authors": [{"family": "Boyd"}]}, raws[0]) and not E.row_fits({"title": None, "authors": [{"family": "Lee"}]}, raws[0])
    assert E.row_fits({"title": None, "authors": []}, raws[0]) and E.row_fits({"title": "Оптика", "authors": None}, raws[0])
    odd = [row(2, None, "Smooth manifolds"), row(2, None, "Smooth manifolds again"), row(9, None, "nowhere"), row(1, None, "Convex optimization")]
    assert E.align_rows(odd, raws) == [odd[3], odd[0], None]
    beyond = [row(57, None, "Convex optimization methods"), row(57, None, "Smooth manifolds revisited"), row(58, None, "Deep networks explained")]
    assert E.align_rows(beyond, raws) == beyond
    assert E.invented({"year": 1999, "title": "Convex optimization methods", "doi": "10.1/x", "authors": [{"family": "Lee"}]}, raws[0]) == ["year", "doi", "author"]


def test_extract_all_survives_a_bad_model(spark):
    refs = spark.createDataFrame([("d", i, t) for i, t in enumerate(["[1] Boyd, S. “Convex methods for all,” J. of X, 2004.", None, "", "[2] Lee. “Smooth manifolds revisited,” 2012."])] + [("e", 0, "x")], "doc_id string, ref_idx int, text string")
    got = {(r.doc_id, r.ref_idx): (r.title, r.year) for r in E.extract_all(refs, size=2).collect()}
    assert got["d", 0] == ("Convex methods for all", 2004) and got["d", 1] == (None, None) and got["d", 3][1] == 2012 and len(got) == 5

    def broken(raws):
        if len(raws) > 1:
            raise ValueError("too many")
        return E.rule_extractor(raws)

    assert {(r.doc_id, r.ref_idx): (r.title, r.year) for r in E.extract_all(refs, broken, size=2).collect()}["d", 0][1] in (2004, None)
    assert E.extract_all(refs.limit(0)).count() == 0


def test_extraction_reads_all_fields_and_asks_once(spark):
    entries = ["[1] Boyd, S. P., and Lee, K. “Convex methods for all,” Journal of Optics, 22(1), 7-9, 2004. doi:10.5555/x.1.", "[2] A. Kim and B. van Dyk. “Smooth manifolds revisited,” Acta Optica, 3, 11-12, 2012.", None]
    refs = spark.createDataFrame([("d", i, t) for i, t in enumerate(entries)], "doc_id string, ref_idx int, text string")
    first = E.extract_batches(refs, size=2)
    got = {r.ref_idx: r for r in first.collect()}
    assert [(a.family, a.given) for a in got[0].authors] == [("Boyd", "S. P."), ("Lee", "K.")] and [(a.family, a.given) for a in got[1].authors] == [("Kim", "A."), ("van Dyk", "B.")]
    assert (got[0].container_title, got[0].volume, got[0].page_range, got[0].doi, got[0].year) == ("Journal of Optics", "22", "7-9", "10.5555/x.1", 2004) and got[2].title is None

    def never(raws):
        raise AssertionError("asked again")

    again = {r.ref_idx: r for r in E.extract_batches(refs, never, size=2, cache=E.cache_entries(first)).collect()}
    assert [again[i].cached for i in range(3)] == [True, True, False] and all(again[i].title == got[i].title and again[i].authors == got[i].authors for i in range(3))


def test_acceptance():
    a = [{"family": "Höhn", "given": "A."}]
    ok = lambda *x: R.judge(*x)[1]
    assert ok("Compressed sensing", a, 2006, "Compressed sensing", [{"family": "Hohn", "given": None}], 2007)
    assert ok("Compressed sensing", None, None, "Compressed sensing", None, 1990)
    assert not ok("Compressed sensing", a, 2006, "Compressed sensing", a, 2009)
    assert not ok("Compressive sensing", a, 2006, "Compressed sensing", [{"family": "Donoho", "given": "D."}], 2006)
    assert ok("Compressed sensing of x", a, 2006, "Compressed sensing for y", a, 2006) and not ok("Compressed sensing of x", a, 2006, "Compressed sensing for y", a, 2007)
    assert not R.authors_disagree([{"family": "OpenAI", "given": None}], a) and not R.authors_disagree(a, [{"family": "Колмогоров", "given": "А."}])


REF = f"doc_id string, ref_idx int, raw_text string, title string, authors {AUTHORS}, year int, doi string, container_title string, volume string"
CAND = f"cand_id bigint, title string, authors {AUTHORS}, year int, doi string, abstract string, source string, provider_type string"


def test_cascade(spark):
    t = "Learning convex optostratification from periodic colour"
    refs = spark.createDataFrame(
        [("d", 0, "x doi:10.1234/AB.1.", "Wrong title", [("Boyd", "S.")], 2001, None, "J", "3"), ("d", 1, "raw", t, [("Boyd", "S.")], 2009, None, None, None), ("d", 2, "raw", "Entirely different words here", [], 2009, None, None, None), ("d", 3, None, None, None, None, None, None, None), ("d", 4, "raw", "94", None, None, None, None, None)], REF
    )
    cands = spark.createDataFrame(
        [(1, "The true title", [("Lee", "K.")], 2000, "https://doi.org/10.1234/ab.1", "abs", "openalex", "article"), (2, t, [("Boyd", "Steve")], 2008, None, None, "openalex", "preprint"), (3, t.upper(), [("Boyd", "Steve")], 2010, "10.9999/z", None, "crossref", "journal-article"), (4, t + " films", [("Kim", "J.")], 2009, None, None, "crossref", "book"), (5, None, None, None, "10.1234/ab.1", None, "crossref", None)], CAND
    )
    out = {r.ref_idx: r for r in R.resolve(refs, cands).collect()}
    assert (out[0].match, out[0].title, out[0].year, out[0].verified, out[0].type) == ("doi", "The true title", 2001, True, "article-journal")
    assert (out[1].match, out[1].year, out[1].doi) == ("crossref", 2010, "10.9999/z") and not out[2].verified and not out[3].verified and not out[4].verified and len(out) == 5
    own = cands.where("cand_id = 1").withColumns({"cand_id": F.lit(99).cast("bigint"), "doc_id": F.lit("d")})
    first = {r.ref_idx: r.match for r in R.resolve(refs, cands, own).collect()}
    assert first[0] == "caller" and first[1] == "crossref"
    lines = [r.line for r in R.report_lines(R.resolve(refs, cands), refs).orderBy("line_no").collect()]
    assert lines[0] == "resolved 2/5 references (crossref: 1, doi: 1)" and len(lines) == 6
    exported = {r.ref_idx: r.citation for r in R.export_citations(R.resolve(refs, cands)).collect()}
    assert set(exported) == {0, 1} and '"article-title":"The true title"' in exported[0] and "null" not in exported[0]
    assert R.resolve(refs.limit(0), cands).count() == 0 and R.resolve(refs, cands.limit(0)).where("verified").count() == 0


def test_best_of_equals_is_first(spark):
    t = "Learning convex optostratification from periodic colour"
    refs = spark.createDataFrame([("d", 0, "raw", t, None, 2009, None, None, None)], REF)
    cands = spark.createDataFrame([(i, t, None, 2009, None, None, "crossref", "book") for i in (7, 3, 5)], CAND)
    assert R.best_match(R.title_pairs(refs, cands)).first().cand_id == 3


def test_misread_long_words_are_found(spark):
    pairs = [
        ("Learning longitudinal cytocrystallization from robust carbon via laminar viscosity", "Learning lon9itudinal cytocrystalhzation from robust carbon via laminar viscosity", 0.9),
        ("Kernel of polysynchronization in localisation of a cold river", "Kernel of polys ynchronization in localization of a cold river", 0.9), ("Compressed sensing", "Compressive sensing", 0.75), ("Quick measured signals", "Quick measuring signal", 0.75),
    ]
    a = [("Boyd", "S.")]
    refs = spark.createDataFrame([("d", i, "raw", y, a, 2009, None, None, None) for i, (_, y, _) in enumerate(pairs)], REF)
    cands = spark.createDataFrame([(i, x, a, 2009, None, None, "crossref", "book") for i, (x, _, _) in enumerate(pairs)], CAND)
    got = {(r.ref_idx, r.cand_id): r for r in R.title_pairs(refs, cands).collect()}
    for i, (_, _, least) in enumerate(pairs):
        assert got[i, i].similarity >= least and got[i, i].accepted


def test_titles_of_a_block_are_compared_where_it_is(spark):
    """All pairs of a block against difflib, made without a join on blocks."""
    import difflib
    import random

    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("abcdei") for _ in range(k))
    bases = [f"{word(5)} {word(9)} {word(3)} of {word(7)} isoparametrization" for _ in range(12)]
    noisy = lambda t: "".join(rng.choice(["", "x", c + "e"]) if rng.random() < 0.12 else c for c in t)
    refs = [("d", i, "raw", noisy(rng.choice(bases)), [(rng.choice(["Boyd", "Kim"]), "S.")], rng.choice([2008, 2009, 2011, None]), None, None, None) for i in range(60)]
    cands = [(i, noisy(rng.choice(bases)), [(rng.choice(["Boyd", "Kim"]), "S.")], rng.choice([2008, 2009, None]), None, None, "crossref", "book") for i in range(60)]
    a, b = spark.createDataFrame(refs, REF), spark.createDataFrame(cands, CAND)
    people = lambda v: [{"family": f, "given": g} for f, g in v]
    keys = lambda t, v, y: [set(k) for k in R.title_keys(blocks.normal_title(t), R.first_family(people(v)), y)]

    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, d in enumerate(y, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    want = {}
    for _, i, _, t, v, y, *_ in refs:
        for c, u, w, z, *_ in cands:
            (core, rest), (core2, rest2) = keys(t, v, y), keys(u, w, z)
            x, o = blocks.normal_title(t), blocks.normal_title(u)
            both = len(x) + len(o)
            if not (core | rest) & (core2 | rest2) or 2 * min(len(x), len(o)) < 0.75 * both:
                continue
            if core & core2 or edits(x, o) <= int(0.25 * both + 1e-9):
                want[i, c] = R.judge(t, people(v), y, u, people(w), z)
    made = R.title_pairs(a, b)
    got = {(r.ref_idx, r.cand_id): (r.similarity, r.accepted) for r in made.collect()}
    assert got == want and len(want) > 150 and sum(k for _, k in want.values()) > 5
    assert all(s == difflib.SequenceMatcher(None, blocks.normal_title(refs[i][3]), blocks.normal_title(cands[c][1])).ratio() for (i, c), (s, _) in got.items())
    few = {(r.ref_idx, r.cand_id): (r.similarity, r.accepted) for r in R.title_pairs(a, b, misses=False).collect()}
    assert few == {k: v for k, v in want.items() if v[0] >= 0.75}
    short = R.title_pairs(a, b, best=True)
    missed = lambda df: sorted(map(tuple, R.near_misses(df, b).collect()))
    assert missed(short) == missed(made) and missed(made) and short.count() < len(want)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_distances_of_many_pairs():
    """Batches against difflib and the plain recurrence: empty, equal, long and very long texts."""
    import difflib
    import random

    import numpy as np

    from quirelake.functions import pairs

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab cde"[: rng.choice([2, 6])]) for _ in range(rng.choice([0, 1, 2, 5, 30, 90, 150, 199, 230]))) for _ in range(300)]
    others = ["".join(rng.choice(["", "ax", "b"]) if rng.random() < rng.choice([0, 0.1, 0.4]) else c for c in t) for t in texts]
    (a, p, m), (b, q, n) = pairs.encode(texts), pairs.encode(others)
    want = np.array([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(texts, others)])
    assert (pairs.ratios(a, p, m, b, q, n) == want).all()
    high = pairs.ratios(a, p, m, b, q, n, 0.75)
    assert ((high >= 0.75) == (want >= 0.75)).all() and (high[want >= 0.75] == want[want >= 0.75]).all()
    most = np.floor(0.25 * (m + n) + 1e-9).astype(int)
    near = np.flatnonzero((abs(m - n) <= most) & (m < 120) | (m >= 230))[:150]
    near = near[abs(m - n)[near] <= most[near]]
    for change in (1, 2):

        def distance(x, y):
            row = list(range(len(y) + 1))
            for i, c in enumerate(x, 1):
                new = [i]
                for j, d in enumerate(y, 1):
                    new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + change * (c != d)))
                row = new
            return row[-1]

        got = pairs.edits(a, p[near], m[near], b, q[near], n[near], most[near], change)
        assert list(got) == [distance(texts[i], others[i]) <= most[i] for i in near]


def brute_dedup(pool):
    dois, titles, kept = set(), set(), []
    for i, title, doi in pool:
        t = blocks.normal_title(title) or None
        d = doi.lower() if doi else None
        if d in dois if d else t in titles and t is not None:
            continue
        kept.append(i)
        if d:
            dois.add(d)
        if t:
            titles.add(t)
    return kept


def test_pool_dedup(spark):
    import random

    rng = random.Random(9)
    for _ in range(4):
        pool = [(i, rng.choice(["A", "b", "C c", None, ""]), rng.choice([None, None, "10.1/x", "10.1/Y", "10.1/y", ""])) for i in range(40)]
        df = spark.createDataFrame([("d", *p) for p in pool], "doc_id string, cand_idx int, title string, doi string")
        assert sorted(r.cand_idx for r in R.dedup_pool(df).collect()) == brute_dedup(pool)
    assert R.union_pools(df, df).count() == len(brute_dedup([(i, t, d) for k in (0, 1) for i, t, d in pool]))


def test_normalisers(spark):
    s2 = spark.createDataFrame([(1, "T", 2001, None, {"DOI": "10.1/a"}, ["Review"], [("Ada Lovelace Jr.",)]), (2, "U", None, None, {}, [], None)], "cand_id bigint, title string, year int, abstract string, externalIds map<string,string>, publicationTypes array<string>, authors array<struct<name:string>>")
    got = R.normalise_s2(s2).orderBy("cand_id").collect()
    assert (got[0].doi, got[0].provider_type, got[0].authors[0].family) == ("10.1/a", "Review", "Lovelace") and (got[1].doi, got[1].provider_type) == (None, None)
    caller = spark.createDataFrame([("a", None, None, "2004-05"), (None, "b", "10.1/x", "year"), (None, None, None, None)], ["title", "article-title", "DOI", "year"])
    assert rows(R.caller_references(caller).select("title", "doi", "year")) == [("a", None, 2004), ("b", "10.1/x", None)]
