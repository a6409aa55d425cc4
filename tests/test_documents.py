"""Parsing and bibliography operators against brute force and on awkward tables."""

from __future__ import annotations

import random
from functools import cmp_to_key

from conftest import rows
from pyspark.sql import functions as F

from quirelake import schemas
from quirelake.operators import parse as P
from quirelake.operators import references as R

REF = "doc_id string, ref_idx int, page int, number string, text string"


def regions(spark, items):
    made = [("d", 1, i, label, native, content, box, None) for i, (label, native, content, box) in enumerate(items)]
    return spark.createDataFrame(made, schemas.REGIONS)


def test_dispatch(spark):
    items = [
        ("text", "doc_title", "## T", None), ("text", "paragraph_title", "- # S", None), ("text", "header", "x", None), ("formula", "display_formula", "$$ y $$", None), ("skip", "chart", None, None), ("text", "footnote", " ", None), ("text", "footnote", "n", None),
        ("text", "figure_title", "Fig. 1", None), ("text", "reference", "[1]", None), ("text", "reference_content", "Boyd", None), ("table", "table", "<table><tr><td>a</td></tr></table>", None), ("text", "algorithm", "x", None), ("text", "formula_number", "(3)", None), ("text", None, "plain", None), (None, None, None, None), ("text", "stamp", "s", None),
    ]
    got = [(r.kind, r.out) for r in P.dispatch(regions(spark, items)).orderBy("idx").collect()]
    assert got == [
        ("body", "# T"), ("body", "## S"), ("abandon", ""), ("body", "$$\ny\n$$"), ("figure", ""), ("abandon", ""), ("body", "> **Footnote:** n"), ("caption", "Fig. 1"), ("reference_number", "[1]"), ("reference", "Boyd"),
        ("body", "| a |\n| --- |"), ("body", "```\nx\n```"), ("body", "(3)"), ("body", "plain"), ("body", ""), ("body", "s"),
    ]


def brute_order(boxes):
    """The order of one page's boxes, region by region."""
    if any(b is None or len(b) != 4 for b in boxes):
        return list(range(len(boxes)))
    width = (max(b[2] for b in boxes) - min(b[0] for b in boxes)) or 1
    runs = []
    for i, b in enumerate(boxes):
        p = boxes[i - 1] if i else None
        narrow = p is not None and all(x[2] - x[0] <= 0.6 * width for x in (p, b))
        if narrow and min(p[2], b[2]) - max(p[0], b[0]) > 0.5 * min(p[2] - p[0], b[2] - b[0]):
            runs[-1].append(i)
        else:
            runs.append([i])
    level = lambda x, y: 0 if abs(boxes[x][1] - boxes[y][1]) <= 0.01 * width else (-1 if boxes[x][1] < boxes[y][1] else 1)
    return [i for r in runs for i in sorted(r, key=cmp_to_key(level))]


def test_reading_order(spark):
    rng = random.Random(4)
    items, want = [], {}
    for page in range(60):
        boxes = []
        for _ in range(rng.randrange(1, 9)):
            left, top = rng.choice([50, 60, 520]), rng.choice([100, 103, 108, 200, 300, 305])
            boxes.append([float(left), float(top), float(left + rng.choice([400, 380, 850])), float(top + 50)])
        if page % 10 == 9:
            boxes[0] = rng.choice([None, [1.0, 2.0]])
        want[page] = brute_order(boxes)
        items += [("d", page, i, "text", "text", f"{i}", b, None) for i, b in enumerate(boxes)]
    got = {}
    for r in P.reading_order(spark.createDataFrame(items, schemas.REGIONS)).orderBy("page", "position").collect():
        got.setdefault(r.page, []).append(r.idx)
    assert got == want


def brute_pairs(kinds):
    out, i = [], 0
    while i < len(kinds):
        k, t = kinds[i]
        nxt = kinds[i + 1] if i + 1 < len(kinds) else (None, None)
        if {k, nxt[0]} == {"reference", "reference_number"}:
            entry, number = (nxt, t) if k == "reference_number" else (kinds[i], nxt[1])
            out.append(("reference", entry[1], number.strip("[]")))
            i += 2
        else:
            if k != "reference_number":
                out.append((k, t, None))
            i += 1
    return out


def brute_reclaim(kinds):
    kinds = list(kinds)
    changed = any(k == "reference" for k, _ in kinds)
    while changed:
        changed = False
        for i, (k, t) in enumerate(kinds):
            if k == "body" and t.startswith("[") and any(kinds[j][0] == "reference" for j in (i - 1, i + 1) if 0 <= j < len(kinds)):
                kinds[i] = ("reference", t)
                changed = True
    return kinds


def test_pairs_and_reclaim(spark):
    rng = random.Random(6)
    pages = {p: [(k, {"reference": f"Boyd {i}", "reference_number": f"[{i}]", "body": rng.choice(["[3] Lee", "prose"])}[k]) for i, k in enumerate(rng.choices(["reference", "reference_number", "body"], k=rng.randrange(1, 9)))] for p in range(80)}
    df = spark.createDataFrame([("d", p, i, k, t) for p, ks in pages.items() for i, (k, t) in enumerate(ks)], "doc_id string, page int, position int, kind string, out string")
    paired, reclaimed = {}, {}
    for r in P.pair_numbers(df).orderBy("page", "position").collect():
        paired.setdefault(r.page, []).append((r.kind, r.out, r.number))
    for r in P.reclaim_references(df).orderBy("page", "position").collect():
        reclaimed.setdefault(r.page, []).append((r.kind, r.out))
    assert paired == {p: m for p, k in pages.items() if (m := brute_pairs(k))}
    assert reclaimed == {p: brute_reclaim(k) for p, k in pages.items()}


def test_parse_regions_of_empty_and_plain_pages(spark):
    df = regions(spark, [("text", "text", "a", None), ("text", "reference", "[1]", None), ("text", "reference_content", "Boyd", None), ("text", "header", "h", None)])
    markdown, captions, refs = P.parse_regions(df.unionByName(df.withColumns({"page": F.lit(2), "native_label": F.lit("header")})))
    assert markdown.first().markdown == "<page_number>1</page_number>\n\na\n\n<page_number>2</page_number>"
    assert captions.count() == 0 and rows(refs) == [("d", 0, 1, "1", "Boyd")]
    assert P.parse_regions(df.limit(0))[0].count() == 0


def brute_merge(entries):
    from quirelake.functions.text import SURNAME_PARTICLES

    out = []
    for page, number, text in entries:
        t = text.lstrip()
        like = number is None and t[:1].islower() and t.split()[0].rstrip(",.").lower() not in SURNAME_PARTICLES
        if out and like and page > out[-1][0]:
            head = out[-1][2].rstrip()
            last = head.split()[-1]
            out[-1][2] = head + ("" if "://" in last or last.lower().startswith("www.") else " ") + t
        else:
            out.append([page, number, text])
    return [tuple(x) for x in out]


def test_split_entries(spark):
    rng = random.Random(8)
    docs = {}
    for d in range(60):
        page, entries = 1, []
        for _ in range(rng.randrange(1, 10)):
            page += rng.choice([0, 0, 1])
            entries.append((page, rng.choice([None, None, "3"]), rng.choice(["Boyd, S. https://x.", "com/home Proc.", "van Wijk, J.", "and its end.", "[4] Lee", "www.site.", " tail"])))
        docs[str(d)] = entries
    df = spark.createDataFrame([(d, i, *e) for d, es in docs.items() for i, e in enumerate(es)], REF)
    got = {}
    for r in R.merge_split_entries(df).orderBy("ref_idx").collect():
        got.setdefault(r.doc_id, []).append((r.page, r.number, r.text))
    assert got == {d: brute_merge(e) for d, e in docs.items()}


def test_trailing_runs_sort_and_gaps(spark):
    ref = lambda d, texts, numbers=None: [(d, i, 1, numbers[i] if numbers else None, t) for i, t in enumerate(texts)]
    items = ref("a", ["Boyd 2004.", "Copyright © x", "Creative Commons", "Copyright © y", "copyright © z"]) + ref("b", ["Copyright © x", "Boyd."]) + ref("c", ["Boyd 2004."] + ["Lasso, 3"] * 5) + ref("d", ["Boyd 2004."] + ["Lasso, 3"] * 4)
    df = spark.createDataFrame(items, REF)
    assert [(r.doc_id, r.ref_idx) for r in R.drop_trailing_boilerplate(df).orderBy("doc_id", "ref_idx").collect() if r.doc_id in "ab"] == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert [(r.doc_id, r.ref_idx) for r in R.drop_index_entries(df).orderBy("doc_id", "ref_idx").collect() if r.doc_id in "cd"] == [("c", 0)] + [("d", i) for i in range(5)]
    numbered = spark.createDataFrame(ref("e", ["x", "y", "z"], ["3", "1", "2"]) + ref("f", ["x", "y"], ["1", "3"]) + ref("g", ["[2] x", "[1] y"]) + ref("h", ["x", "y"], ["1", "1"]) + ref("i", [None, None]), REF)
    order = {}
    for r in R.sort_by_number(numbered).orderBy("doc_id", "position").collect():
        order.setdefault(r.doc_id, []).append(r.ref_idx)
    assert order == {"e": [1, 2, 0], "f": [0, 1], "g": [1, 0], "h": [0, 1], "i": [0, 1]}
    assert rows(R.missing_numbers(numbered)) == [("f", [2])]
    for rule in (R.merge_split_entries, R.drop_trailing_boilerplate, R.drop_index_entries, R.sort_by_number, R.missing_numbers, R.render_references, R.repair_references):
        assert rule(df.limit(0)).count() == 0


def test_recovery_from_the_layer(spark):
    entries = [{"page": 1, "number": None, "text": "1. Boyd, S. Convex optimization for everyone."}, {"page": 2, "number": None, "text": "4. Lee, K. Manifolds and their many uses."}]
    layer = "x 1. Boyd, S. Convex optimization for everyone. 2. Kim, J. A title of some length here. 3. No. 4. Lee, K. Manifolds and their many uses."
    made = R.recover_from_layer(entries, layer)
    assert [e["text"][:2] for e in made] == ["1.", "2.", "4."] and made[1]["page"] == 1 and made[1]["number"] is None
    assert R.recover_from_layer(entries, layer.replace("2. Kim", "2. Vol 2. Kim")) == entries or len(R.recover_from_layer(entries, layer)) == 3
    df = spark.createDataFrame([("d", i, e["page"], None, e["text"]) for i, e in enumerate(entries)] + [("e", 0, 1, None, "Boyd")], REF)
    out = R.recover_missing(df, spark.createDataFrame([("d", layer), ("e", "")], "doc_id string, layer_text string"))
    assert [(r.doc_id, r.ref_idx) for r in out.orderBy("doc_id", "ref_idx").collect()] == [("d", 0), ("d", 1), ("d", 2), ("e", 0)]


def test_render(spark):
    df = spark.createDataFrame([("d", 0, 2, "1", "b"), ("d", 1, 1, None, "a"), ("d", 2, 2, "", "c"), ("d", 3, None, None, "z")], REF)
    assert R.render_references(df).first().markdown == "z\n\n<page_number>1</page_number>\n\na\n\n<page_number>2</page_number>\n\n[1] b\n\nc"


def test_crops_parts_and_labels(spark):
    wanted = spark.createDataFrame([("d", 1, 0, "a.png"), ("d", 1, 1, "b.png"), ("d", 2, 0, "c.png")], "doc_id string, page int, crop_idx int, image_path string")
    files = spark.createDataFrame([("d", "a.png", 1), ("d", "x1.png", 1)], "doc_id string, name string, page int")
    assert rows(P.match_crops(wanted, files).select("page", "crop_idx", "path")) == [(1, 0, "a.png"), (1, 1, "x1.png"), (2, 0, None)]
    parts = spark.createDataFrame([("d", 0, 100), ("d", 1, 3)], "doc_id string, part int, n_pages int")
    moved = P.merge_parts(parts, spark.createDataFrame([("d", 0, 5), ("d", 1, 2)], "doc_id string, part int, page int"))
    assert rows(moved.select("part", "page")) == [(0, 5), (1, 102)]
    raw = spark.createDataFrame([("d", 1, 0, "doc_title")], "doc_id string, page int, position int, native_label string")
    out = P.restore_labels(regions(spark, [("text", None, "<div>a</div>", None), ("text", None, "b", None)]), raw)
    assert rows(out.select("idx", "native_label", "content")) == [(0, "doc_title", "a"), (1, None, "b")]
