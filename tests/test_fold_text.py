"""Folding and native text functions, case by case and held against SQL on the small tables."""

from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirelake.functions import blocks, fold
from quirelake.functions import text as X


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "v string")
    r = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return list(r)


@pytest.mark.parametrize(
    "text, made",
    [("Ｋｅｓｔｏ", "kesto"), ("Straße", "strasse"), ("a‍b­ c  d", "ab c d"), ("Böb", "böb"), ("Pаrk", "park"), ("ﬁne", "fine"), ("Нина", "нина"), ("Стогаcем", "стогасем"), ("", ""), (None, None)],
)
def test_canonical(text, made):
    assert fold.canonical(text) == made


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_canonical_is_idempotent(text):
    once = fold.canonical(text)
    assert fold.canonical(once) == once or fold.canonical(fold.canonical(once)) == fold.canonical(once)


def test_columns_per_distinct_value(spark):
    df = spark.createDataFrame([("Höhn",), ("Höhn",), (None,), ("",)], "v string")
    assert [r.c for r in df.select(fold.fold_name_column("v").alias("c")).collect()] == ["hohn", "hohn", None, ""]


@pytest.mark.parametrize("text, made", [("[12] Boyd", "12"), ("12. Boyd", "12"), ("7 Boyd", "7"), ("12Boyd", None), ("Boyd 12", None), ("", None), (None, None)])
def test_leading_number(spark, text, made):
    assert one(spark, text, X.leading_number("v")) == [made]


@pytest.mark.parametrize("text, made", [("see 10.1000/ab.c), x", "10.1000/ab.c"), ("no", None), (None, None), ("DOI:10.12345/X;", "10.12345/X")])
def test_doi(spark, text, made):
    assert one(spark, text, X.extract_doi("v")) == [made]


@pytest.mark.parametrize("text, made", [("1, 3-5; 8", [1, 3, 4, 5, 8]), ("5-3", None), ("1-99", None), ("x", None), ("2", [2]), (None, None)])
def test_number_group(spark, text, made):
    assert one(spark, text, X.expand_number_group("v")) == [made]


@pytest.mark.parametrize("text, family, given", [("Ada B. Lovelace", "Lovelace", "Ada B."), ("Sammy Davis Jr.", "Davis", "Sammy"), ("Plato", "Plato", None), ("Jr", "Jr", None), ("John Smith, III", "Smith", "John")])
def test_split_name(spark, text, family, given):
    assert one(spark, text, X.split_full_name("v")["family"], X.split_full_name("v")["given"]) == [family, given]


@pytest.mark.parametrize("text, made", [("$$ x $$", "$$\nx\n$$"), (r"\[ y \]", "$$\ny\n$$"), ("z", "$$\nz\n$$"), ("", "$$\n\n$$")])
def test_formula(spark, text, made):
    assert one(spark, text, X.wrap_formula("v")) == [made]


@pytest.mark.parametrize("text, made", [("a\n$$\nx\n+ y\n$$\nb", "a\n$$x + y$$\nb"), ("a $$x$$ b", "a $$x$$ b"), ("open $$\nx", "open $$\nx"), ("", ""), (None, None)])
def test_collapse_math(spark, text, made):
    assert one(spark, text, X.collapse_math("v")) == [made]


@pytest.mark.parametrize("text, made", [("Lasso, 68, 86-93", True), ("Buja, A. 110, 297, 441", True), ("Salojärvi, J.", True), ("Boyd, S. Convex. 2004.", False), ("", False), (None, False)])
def test_index_entry(spark, text, made):
    assert one(spark, text, X.is_index_entry("v")) == [made]


@pytest.mark.parametrize("text, made", [("com/home Proc.", True), ("van Wijk, J.", False), ("Boyd", False), ("", False), (None, False)])
def test_continued(spark, text, made):
    assert one(spark, text, X.looks_continued("v")) == [made]


def test_fences():
    assert blocks.fence_code("x = 1") == "```\nx = 1\n```"
    assert blocks.fence_code("```py\nx\n```") == "```py\nx\n```"
    assert blocks.fence_code("a ``` b") == "````\na ``` b\n````"
    doubled = "t\n```\n```py\nx\n```\n```\nu"
    once = blocks.repair_doubled_fences(doubled)
    assert once == "t\n```py\nx\n```\nu"
    assert blocks.repair_doubled_fences(once) == once
    assert blocks.repair_doubled_fences("```\n```py\nx") == "```\n```py\nx"
    assert blocks.fence_code(None) is None and blocks.repair_doubled_fences(None) is None
    assert blocks.fence_code("```python\nx=1") == "```python\nx=1\n```"
    assert blocks.fence_code("Listing:\n```py\nx\n```") == "````\nListing:\n```py\nx\n```\n````"


@pytest.mark.parametrize("text, made", [
    ("```\n```\nx\n```\n```\nafter", "```\nx\n```\nafter"), ("```\nSnip\n\n```py\nx\n```\n```\n\n## Next", "````\nSnip\n\n```py\nx\n```\n````\n\n## Next"), ("a\n\n```\nfor x:\n    y\n```\n\nb", "a\n\n```\nfor x:\n    y\n```\n\nb"),
    ("```\n~~~py\nx\n~~~\n```\nu", "```py\nx\n```\nu"), ("```\n````\n```\nno closer\n```\n````\n```\nu", "````\n```\nno closer\n```\n````\nu"), ("t\n```\nx\nnever closed", "t\n```\nx\nnever closed"), ("```py\n```\n```\nx\n```", "```py\n```\n```\nx\n```"),
])
def test_doubled_fences(text, made):
    assert blocks.repair_doubled_fences(text) == made and blocks.repair_doubled_fences(made) == made


def test_tables():
    made = blocks.html_table_to_pipes("<table><tr><td rowspan=2>a</td><td>b|c</td></tr><tr><td>d</td></tr><tr><td colspan='x'>e</td></tr></table>")
    assert made == "| a | b\\|c |\n| --- | --- |\n| a | d |\n| e |  |"
    assert blocks.html_table_to_pipes("<table></table>") == ""
    assert blocks.html_table_to_pipes("  no table ") == "no table"


def test_scripts_and_links():
    assert blocks.merge_double_scripts("x^{a}^{b}^{c}") == "x^{a b c}"
    assert blocks.normalise_math("$ a $ and $$ b_{1}_{2} $$") == "$a$ and $$b_{1 2}$$"
    assert blocks.relative_links("![x](/d/a.png) [y](http://z)", "/d") == "![x](a.png) [y](http://z)"
    assert blocks.strip_orphan_marks("́á ́") == "á "


def test_similarity_depends_on_order():
    a, b = "Compressed sensing", "Compressive sensing"
    assert 0.85 < blocks.title_similarity(a, b) < 1
    assert blocks.title_similarity(None, None) == 1.0 or blocks.title_similarity(None, None) == 0.0


def test_abstract_round_trip(spark):
    df = spark.createDataFrame([({"b": [1, 3], "a": [0], "c": [2]},), ({},), (None,)], "m map<string,array<int>>")
    assert [r.t for r in df.select(X.reconstruct_abstract("m").alias("t")).collect()] == ["a b c b", None, None]


def test_rows_helper(spark):
    assert rows(spark.range(2).select(F.col("id"))) == [(0,), (1,)]
