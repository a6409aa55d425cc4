"""Near-duplicates, names, matching and components against brute force and on awkward tables."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quirelake.functions.entries import read_entry, skeleton
from quirelake.llm.trie import osa
from quirelake.llm import matching as M
from quirelake.llm import names as N
from quirelake.llm import neardup as D
from quirelake.llm.components import components


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "path", "star", "loops", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
        "path": [(i, i + 1) for i in range(40)],
        "star": [(0, i) for i in range(1, 40)] + [(0, 1)],
        "loops": [(5, 5), (7, 7), (7, 8)],
        "empty": [],
    }[shape]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in components(df).collect()} == union_find(edges)


def brute_pairs(sets, threshold, rarest=1 << 16):
    df = Counter(t for _, _, ts in sets for t in ts)
    w = {t: round(1000 * (1 + math.log(len(sets) / max(n, len(sets) / rarest)))) for t, n in df.items()}
    out = set()
    for (a, x, s), (b, y, t) in combinations(sets, 2):
        s, t = set(s), set(t)
        if x == y and s and t:
            shared, union = sum(w[k] for k in s & t), sum(w[k] for k in s | t)
            if shared / union >= threshold:
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("threshold, group, rarest", [(0.4, 256, 1 << 16), (0.62, 3, 1 << 16), (0.8, 256, 8), (0.4, 1, 8)])
def test_token_group_matrix_loses_no_pair(spark, monkeypatch, threshold, group, rarest):
    """As brute force, also where groups are split and rare tokens weigh alike."""
    monkeypatch.setattr(D, "GROUP", group)
    monkeypatch.setattr(D, "RAREST", rarest)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    sets = []
    for i in range(120):
        base = rng.sample(words, 8) if i % 3 == 0 or not sets else list(sets[-1][2])
        for _ in range(rng.randrange(3)):
            base[rng.randrange(len(base))] = rng.choice(words)
        sets.append((i, rng.choice(["p", "q", None]), sorted(set(base))))
    sets.append((999, "p", []))
    df = spark.createDataFrame(sets, "id bigint, block string, tokens array<string>")
    weighed = D.weighted_sets(df).select("*", F.lit(threshold).alias("threshold"), F.col("id").alias("tag"))
    found = D.token_group_pairs(weighed).collect()
    got = {(r.a, r.b) for r in found}
    assert got == brute_pairs(sets, threshold, rarest) and len(found) == len(got)
    assert all((r.tag_a, r.tag_b) == (r.a, r.b) for r in found)
    assert D.token_group_pairs(weighed.limit(0)).count() == 0


ENTRY = "Boyd, S., & Lee, K. ({y}). Variational optodynamics for periodic morphology in surface crystals. Journal of Industrial Mechanics, 22(1), {p}."


def test_entry_groups(spark):
    a = ENTRY.format(y=1998, p="1201-1205")
    texts = [
        (1, a), (2, a), (3, a.replace("optodynamics", "optodynarnics")), (4, "BOYD, S.; LEE, K.. Variational\noptody-\nnamics for periodic morphology in surface crystals. J. of Ind. Mechanics, 22, 1998."),
        (5, ENTRY.format(y=1999, p="1201-1205")), (6, a.replace("crystals.", "crystals, II.")), (7, "Ibid., p. 3."), (8, None), (9, ""), (10, "Boyd, S., & Lee, K. (1998). Quite another title about other things entirely. Journal of Industrial Mechanics, 22(1), 7-9."),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "ref_id bigint, text string, entry string")
    got = {r.ref_id: r.entry for r in D.entry_groups(df).collect()}
    assert got[1] == got[2] == got[3] == got[4] == 1
    assert got[5] == 5 and got[6] == 6 and got[10] == 10
    assert got[7] is None and got[8] is None and got[9] is None and len(got) == 10
    pairs = rows(D.pairs_within(D.entry_groups(df), "ref_id", "entry", ("ref_id_a", "ref_id_b")))
    assert pairs == sorted(combinations([1, 2, 3, 4], 2))
    links = {r.ref_id: r.n_links for r in D.entry_groups(df, links=True).collect()}
    assert links[1] == links[2] >= 1 and links[5] == 0 and links[8] is None
    assert D.entry_groups(df.limit(0)).count() == 0


def test_skeleton_joins_scan_readings():
    for good, bad in (("modern", "modem"), ("could", "c0uld"), ("framework", "framevvork"), ("marine", "manne"), ("uniform", "iiniform"), ("stability", "5tability"), ("synthetic", "syntbetic")):
        assert skeleton(good) == skeleton(bad)
    assert read_entry(None).words == 0 and read_entry("x " * 20000).words == 20000


@pytest.mark.parametrize("cuts", [(10**9, 10**9), (7, 5)])
def test_trie_join_equals_brute_force(spark, monkeypatch, cuts):
    """Whole shards and shards split both ways give all neighbours of a kind, and none of another."""
    monkeypatch.setattr(N, "SHARD_NAMES", cuts[0])
    monkeypatch.setattr(N, "SHARD_QUERIES", cuts[1])
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdeo") for _ in range(rng.randrange(3, 10))) for _ in range(60)]
    names = set(base)
    for b in base:
        k = rng.randrange(len(b) - 1)
        names |= {b[:k] + b[k + 1] + b[k] + b[k + 2 :], b[:k] + b[k + 1 :], b[:k] + "z" + b[k + 1 :], b + "o", "prefix" + b}
        m = len(b) // 2
        names.add(b[: m - 1] + b[m] + b[m - 1] + b[m + 1 :])
    df = spark.createDataFrame([(k, n) for n in names for k in ("po" if n < "c" else "p")], "kind string, name string")
    got = {tuple(r) for r in N.trie_join(df).collect()}
    want = {(k, min(a, b), max(a, b)) for a, b in combinations([n for n in names if len(n) >= N.LEAST_LETTERS], 2) if osa(a, b) == 1 for k in ("po" if max(a, b) < "c" else "p")}
    assert got == want


def test_rare_names_link_to_frequent_ones_without_chains(spark):
    bearers = [("p", "kopisenunok", "h", 20), ("p", "kopisenunak", "h", 1), ("p", "kopisenuna", "h", 1), ("p", "kopisenunek", "r", 15), ("p", "zelofes", "a", 2), ("p", "zelofas", "b", 2), ("o", "kopisenunok", "", 1), ("p", "kopsienunok", "x", 3)]
    got = {(r.kind, r.name): r.fam for r in N.canonical_names(spark.createDataFrame(bearers, "kind string, name string, initial string, n int")).collect()}
    # kopisenuna's only neighbour is itself taken over; two frequent names stay apart, as do equals of other initials
    assert got == {("p", "kopisenunak"): "kopisenunok", ("p", "kopsienunok"): "kopisenunok"}


def test_token_orders_are_checked(spark):
    """A spelling whose words could each be the family name is read as the person that other rows name."""
    spellings = [(1, "Martin", "Thomas"), (2, "Thomas", "M."), (3, "Thomas", "M."), (4, "Thomas", "Martin"), (5, "Martin Thomas", None), (6, "Thomas", "M"), (7, "Xen.", "Thomasin"), (8, "Thomasin", "X."), (9, "Thomasin-Orru", "X."), (10, "DE", "Thomasin"), (11, "Thomasin", "Dorothy E."), (12, "Kahn", "John"), (13, "Kahn", "Jane"), (14, "Kahn", "John"), (15, "Kahn", "Jane")]
    df = spark.createDataFrame(spellings, "name_id bigint, family string, given string")
    got = {r.name_id: r.entity for r in N.link_names(df, spark.createDataFrame([], "given string, alias string")).collect()}
    assert len({got[i] for i in (1, 2, 3, 4, 5, 6)}) == 1
    assert len({got[i] for i in (7, 8, 9)}) == 1 and got[10] == got[11] != got[7]
    assert got[12] == got[14] != got[13] == got[15]


def test_a_frequent_given_name_takes_no_rows(spark):
    """However many rows seem to have a given name for a family name, people who bear it stay with their own rows."""
    families = ["Senelapomok", "Serineskemel", "Sozovuskitak", "Shokifivatek"]
    spellings = [(10 * i + j, f, g) for i, f in enumerate(families) for j, g in enumerate(("Lucia", "Lucia", "L."))]
    df = spark.createDataFrame(spellings + [(100 + i, "Lucia S.", None) for i in range(9)], "name_id bigint, family string, given string")
    got = {r.name_id: r.entity for r in N.link_names(df, spark.createDataFrame([], "given string, alias string")).collect()}
    assert all(got[10 * i] == got[10 * i + 1] == got[10 * i + 2] for i in range(4)) and len({got[10 * i] for i in range(4)}) == 4


def test_link_names(spark):
    spellings = [
        (1, "Kopisenunok", "Harold"), (2, "KOPISENUNOK", "H."), (3, "Kopisenunok", "Hal"), (4, "Harold", "Kopisenunok"), (5, "Kopisenunko", "Harold"), (6, "Kopisenunok, Harold", None),
        (7, "Kopisenunok", "P."), (8, "van der Kopisenunok", "Patricia"), (9, "Кopisеnunok", "Pat"), (10, "Institute for Marine Botany, Hefastusival", None), (11, "The Institute for Marine Botany of Hefastusival", None),
        (12, "IMB Hefastusival", None), (13, "Marine Botany, Inst. for (Hefastusival)", None), (14, None, None), (15, "", " "), (16, "Center for Applied Optics, Hefastusival", None), (17, "Kopisenunok", "Harold"), (18, "Robert Zelofeshigok", None), (19, "Zelofeshigok", "Bob"), (20, "Zelofeshigok", "B."),
    ]
    more = [(100 + i, f"Family{chr(97 + i)}nak", g) for i in range(8) for g in ("Harold",)] + [(200 + i, f"Person{chr(97 + i)}tal", "Robert") for i in range(8)]
    df = spark.createDataFrame([(*s, 1) for s in spellings + more], "name_id bigint, family string, given string, entity int")
    aliases = spark.createDataFrame([("Harold", "Hal"), ("Patricia", "Pat"), ("Robert", "Bob")], "given string, alias string")
    got = {r.name_id: r.entity for r in N.link_names(df, aliases).collect()}
    assert len({got[i] for i in (1, 2, 3, 4, 5, 6, 17)}) == 1
    assert got[7] == got[8] == got[9] != got[1]
    assert len({got[i] for i in (10, 11, 12, 13)}) == 1 and got[16] != got[10]
    assert got[18] == got[19] == got[20]
    assert got[14] is None and got[15] is None and len(got) == len(spellings) + len(more)
    assert N.link_names(df.limit(0), aliases).count() == 0


AUTHORS = "array<struct<family:string,given:string>>"


def test_match_records(spark):
    kinds = f"id bigint, title string, authors {AUTHORS}, year int, doi string, container_title string, confidence int"
    boyd, lee = [("Kopisenunok", "H.")], [("Zelofeshigok", "R.")]
    left = [
        (1, "Learning convex optostratification from periodic colour", boyd, 2009, None, None, 0), (2, "LEARNING CONVEX OPTOSTRATIFICATION FROM PERIODIC C0LOUR", [("H.", "Kopisenunok")], 2010, None, None, 0),
        (3, "Learning convex optostratification from periodic colour", lee, 2009, None, None, 0), (4, None, None, None, None, None, 0), (5, "", [], 2009, None, None, 0), (6, "Annual report", boyd, 1990, None, None, 0), (1 + 6, "Learning convex optostratification from periodic colour", boyd, 2009, None, None, 0),
    ]
    right = [
        (11, "Learning convex optostratification from periodic colour", [("Kopisenunok", "Harold")], 2009, "10.5555/x.1", "J", 0), (12, "Learning convex optostratification from periodic colour: Part II", [("Kopisenunok", "Harold")], 2012, None, None, 0),
        (13, "Annual report", lee, 1990, None, None, 0), (14, None, None, None, None, None, 0), (15, "Annual report", [("Kopisenunok", "H.")], 1990, None, None, 0),
    ]
    a, b = spark.createDataFrame(left, kinds).withColumnRenamed("id", "ext_id"), spark.createDataFrame(right, kinds).withColumnRenamed("id", "cand_id")
    got = {(r.ext_id, r.cand_id): r.confidence for r in M.match_records(a, b, ("ext_id", "cand_id")).collect()}
    assert set(got) == {(1, 11), (2, 11), (7, 11), (6, 15)} and all(0 < c <= 1 for c in got.values())
    assert M.match_records(a.limit(0), b, ("ext_id", "cand_id")).count() == 0


def classes(spark, side, records):
    """Prepared classes of (id, title, authors, year, doi)."""
    kinds = f"id bigint, title string, authors {AUTHORS}, year int, doi string, container_title string"
    return M.prepare(spark.createDataFrame([(*r, None) for r in records], kinds), "id")


def features(spark, left, right):
    a, b = classes(spark, "a", [(1, *left)]), classes(spark, "b", [(2, *right)])
    row = a.select(F.struct("*").alias("a")).join(b.select(F.struct("*").alias("b"))).select(F.array(*M.pair_columns()).alias("f")).first()
    return dict(zip(M.FEATURES, row.f))


def met(spark, left, right):
    """Whether two records share a block, with the frequent ends blocked by year and without."""
    a, b = classes(spark, "a", [(1, *left)]), classes(spark, "b", [(2, *right)])
    return M.candidate_pairs(a, b).count() > 0


def test_blocks_find_what_brute_force_finds(spark, data):
    """Of all pairs that are like by title, authors and year, nearly all share a block."""
    a, b = M.prepare(spark.read.parquet(f"{data}/extracted_refs.parquet"), "ext_id"), M.prepare(spark.read.parquet(f"{data}/candidates.parquet"), "cand_id")
    pairs = {(r.fa, r.fb) for r in M.candidate_pairs(a, b).collect()}
    left, right = a.collect(), b.collect()
    sure = found = 0
    for r in left:
        for o in right:
            x, y = set(r.words), set(o.words)
            if len(x) > 4 and len(x & y) >= 0.5 * len(x | y) and r.sequel == o.sequel and (r.year is None or o.year is None or abs(r.year - o.year) <= 1) and r.authors and o.authors and M._author_share(r.authors, o.authors) >= 0.5:
                sure += 1
                found += (r.form, o.form) in pairs
    assert sure > 20 and found >= 0.97 * sure


def test_frequent_ends_lose_no_pair(spark, data, monkeypatch):
    """Blocks by year give the pairs that blocks without year give."""
    a, b = M.prepare(spark.read.parquet(f"{data}/extracted_refs.parquet"), "ext_id"), M.prepare(spark.read.parquet(f"{data}/candidates.parquet"), "cand_id")
    plain = {tuple(r) for r in M.candidate_pairs(a, b).collect()}
    monkeypatch.setattr(M, "FREQUENT", 0)
    assert {tuple(r) for r in M.candidate_pairs(a, b).collect()} == plain


def test_blocks_in_parts_lose_no_pair(spark, data):
    """Parts of the blocks give together the pairs of all blocks, each a share of them; no sketch rules out a pair that the words let through."""
    a, b = M.prepare(spark.read.parquet(f"{data}/extracted_refs.parquet"), "ext_id"), M.prepare(spark.read.parquet(f"{data}/candidates.parquet"), "cand_id")
    whole = {tuple(r) for r in M.candidate_pairs(a, b).collect()}
    words = {r.form: set(r.words) for r in a.select("form", "words").union(b.select("form", "words")).collect()}
    parts = [p.withColumn("ok", M.may_share(F.col("sa"), F.col("sb"))).select("fa", "fb", "ok").distinct().collect() for p in M.blocked_pairs(a, b, 3)]
    assert {(r.fa, r.fb) for p in parts for r in p} == whole and max(map(len, parts)) < 0.7 * sum(map(len, parts))
    like = {(x, y) for x, y in whole if len(words[x] & words[y]) >= M.VERIFIED * len(words[x] | words[y]) or min(len(words[x]), len(words[y])) < M.TELLING}
    told = {(r.fa, r.fb) for p in parts for r in p if r.ok}
    assert like <= told and len(told) < len(whole)


def test_matches_in_parts_leave_little(spark, data, monkeypatch):
    """As with one part; of what is staged, the ids, the frequent ends and the features are left."""
    a, b = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("extracted_refs", "candidates"))
    whole = rows(M.match_records(a, b, ("ext_id", "cand_id")))
    monkeypatch.setattr(M, "PART_RECORDS", 80)
    before = _stages(spark)
    parted = M.match_records(a, b, ("ext_id", "cand_id"))
    assert len(_stages(spark) - before) <= 4 and rows(parted) == whole and len(whole) > 20


@pytest.mark.parametrize("typed, listed", [
    (("CQI, Brezokoremel", None), ("Center for Quantum Immunology, Brezokoremel", None)), (("Inst. for Theor. Immunology, Puhufupudel", None), ("Institute for Theoretical Immunology, Puhufupudel", None)),
    (("Gifochalusen, Center for Experimental Cryptology", None), ("Center for Experimental Cryptology, Gifochalusen", None)), (("Boyd", "Alexandrina"), ("Boyd", "A.")),
])
def test_any_word_of_an_author_makes_a_block(spark, typed, listed):
    make = lambda a: ("Adaptive growth of crystals in periodic water", [a], 2000, None)
    assert met(spark, make(typed), make(listed))


def test_what_a_record_lacks_does_not_part_it(spark):
    title = "Adaptive growth of optical crystals in periodic water"
    full = (title, [("Kopisenunok", "H.")], 2000, "10.5555/x.1")
    for other in ((title, [], 2000, None), (title, None, None, None), (title, [("Kopisenunok", "H.")], None, None), (title, [("Zelofeshigok", "R.")], 2001, "10.5555/x.1")):
        assert met(spark, full, other) and met(spark, other, full)
    assert not met(spark, full, (title, [("Kopisenunok", "H.")], 2002, None)) and not met(spark, full, (None, None, None, None))


def test_misspelt_short_titles_are_compared_whole(spark):
    make = lambda t: (t, [("Kopisenunok", "H.")], 2000, "10.5555/x.1")
    v = features(spark, make("Optical crystalography methds"), make("Optical crystallography methods"))
    assert v["trigrams"] > 0.5 and v["author_share"] == 1 and v["doi_same"] == 1 and 0 < v["title_jaccard"] < 0.34


def test_native_confidence_equals_numpy(spark, data):
    f = [[0.2, 0.3, 1, 0.2, 1, 0, 0, 0.5, 0, 0, 0, 0], [1, 1, 1, 1, 1, 0, 0, 1, 0, 0, 0, 1], [1, 1, 1, 1, 0, 3, 0, 0, 0, 0, 0, 1]]
    df = spark.createDataFrame([([float(x) for x in r],) for r in f], "f array<double>")
    model = M.fit(np.empty((0, len(M.FEATURES))))
    got = df.select(model.column(F.col("f")).alias("p"), M.admissible(F.col("f")).alias("ok")).collect()
    assert np.allclose([r.p for r in got], model.confidence(np.array(f, float))) and [r.ok for r in got] == [True, True, False]


def test_calibration_orders_pairs():
    model = M.fit(np.empty((0, len(M.FEATURES))))
    good = [1, 1, 1, 1, 1, 0, 0, 1, 0, 0, 0, 1]
    bad = [0.2, 0.3, 1, 0.2, 1, 0, 0, 0.5, 0, 0, 0, 0]
    p = model.confidence(np.array([good, bad], float))
    assert p[0] > 0.9 > p[1]


def _stages(spark):
    """Names of the folders that are staged now."""
    import os

    from quirelake.session import shared_dir

    there = shared_dir(spark).removeprefix("file://")
    return {n for n in os.listdir(there) if n.startswith("stage-")} if os.path.isdir(there) else set()


def test_entries_are_compared_in_parts(spark, data, monkeypatch):
    """Parts give the groups that one comparison gives; each holds a share of the classes, and what is worked on is deleted."""
    refs = spark.read.parquet(f"{data}/raw_refs.parquet")
    whole = rows(D.entry_groups(refs, links=True))
    sizes, grouped = [], D._grouped

    def counted(weighed):
        sizes.append(weighed.count())
        return grouped(weighed)

    monkeypatch.setattr(D, "_grouped", counted)
    monkeypatch.setattr(D, "PART_SETS", 80)
    before = _stages(spark)
    parted = D.entry_groups(refs, links=True)
    assert rows(parted) == whole
    assert len(sizes) >= 3 and max(sizes) < 0.5 * sum(sizes)
    # what is left: the rows' classes, each part's pairs, and the links of the components
    assert len(_stages(spark) - before) <= len(sizes) + 4


def test_a_stage_leaves_no_shuffle_files(spark):
    import glob
    import os

    from quirelake.session import release, stage

    def shuffled():
        store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {os.path.basename(p) for d in store.localDirsString() for p in glob.glob(f"{d}/*/shuffle_*.data")}

    before = shuffled()
    made = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert shuffled() <= before and made.count() == 7
    release(made)
