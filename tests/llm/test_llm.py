"""Operators of the training-corpus package: rules, round trips, held-out accuracy, awkward tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm import lookalike, markup, mixing, queries, reading, scans, tokens

CLEAN = [
    ("<b>x</b> is <i class=\"t\">y</i>.<br/>Then z.", "x is y.\nThen z."), ("A&nbsp;b &amp; c &#8211; d", "A b & c – d"), ("See [the model](https://x.org/a_(b)) for more.", "See the model for more."), ("**a** and *b* and ~~c~~ \\*d\\*", "a and b and c *d*"),
    ("It is ''q'' and '''w'''. [[model|the model]] {{math|x + y}}", "It is q and w. the model $x + y$"), ("The \\textbf{s} grew 12\\%.\\footnote{A note.} na\\\"{\\i}ve ``w''", "The s grew 12%. (A note.) naïve “w”"), ("Text.\n\n[[Category:Models]]", "Text."), ("Intro.\n\n__NOTOC__\n\nMore.", "Intro.\n\nMore."),
    ("<h3>Head</h3>\n\n<ul><li>a</li><li>b</li></ul>", "### Head\n\n- a\n- b"), ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "- a\n- b"), ("== H ==\n\nText.", "## H\n\nText."), ("{| class=\"w\"\n! a !! b\n|-\n| 1 || 2\n|}", "| a | b |\n|---|---|\n| 1 | 2 |"), ("> quoted words\n\nText.", "quoted words\n\nText."), ("As in [the text][1], it is.\n\n[1]: https://x.org/a", "As in the text, it is."),
]
KEPT = [
    "Here i < j and k > m, so it holds.", "As in [12] and [3, 4], it is.", "If a == b then it is so*.", "The R&D budget was 5 * 3 units.", "Item #3 costs 4 & 5 units.", "The set {1, 2} and [0, 1) of x ~ N(0, 1) and P(A | B).", "It is run_school_id in the file.",
    "```\n<b>x</b> \\textbf{y}\n```", "Let $\\alpha_{ij} \\le \\frac{3}{2}$ be.", "$$\n\\mathbf{A} x\n$$", "<page_number>3</page_number>", "# Head\n\n- item\n\n1. item", "| a | b |\n|---|---|\n| 1 | 2 |", "You don't and it's the worker's.", "",
]


@pytest.mark.parametrize("text, made", CLEAN)
def test_markup_is_resolved(text, made):
    out, kinds, _ = markup.clean_text(text)
    assert out == made and kinds


@pytest.mark.parametrize("text", KEPT)
def test_what_is_no_markup_stays(text):
    assert markup.clean_text(text) == (text, [], 0)


@given(st.text(alphabet="ab *_~[]()<>&;{}|\\$`'=\n#!.", max_size=80))
@settings(max_examples=400, deadline=None)
def test_markup_never_fails(text):
    out, kinds, _ = markup.clean_text(text)
    assert out is not None and (kinds or out == text)


def test_furniture_tree():
    nav = "[Home](/) | [About](/about) | [Contact](/contact) | [Login](/login)\n\nThe error of the motor decreases with the size of it."
    assert markup.clean_text(nav)[0] == "The error of the motor decreases with the size of it."


# Blocks that the labelled table doesn't have: content (1) and furniture (0) with their neighbours.
HELD_OUT = [
    ("The pump was opened.", "Its [valve](/v) and its [seal](/s) were replaced by parts that [a maker](/m) had sent, and the pump ran again for a year.", "It was closed later.", 1),
    ("The pump was opened.", "As [[Galileo]] wrote, [[Jupiter]] has four [[moon]]s that can be seen with a small [[telescope]] on a clear night.", "", 1),
    ("", "We follow [Smith](/a), who follows [Jones](/b), who in turn follows [Brown](/c) in nearly all that matters here.", "[Home](/) [Up](/u) [Down](/d)", 1),
    ("The pump was opened.", "Details are in [the report](/r).", "It was closed later.", 1), ("The pump was opened.", "See [here](/h) and [there](/t) too.", "It was closed later.", 1),
    ("", "A survey of [pumps](/p) made in the north before the war and of those made after it.", "", 1), ("Short.", "Fig. 2: [Pump](/p) after a year of use.", "Text goes on here for a while.", 1),
    ("The pump was opened.", "[Index](/i) | [Glossary](/g) | [Authors](/a) | [Feedback](/f)", "", 0), ("", "[Start](/) [Archive](/a) [Search](/s) [Log in](/l)", "The pump was opened.", 0),
    ("[Start](/) [Archive](/a)", "[Tags](/t) [Topics](/o) [People](/p) [Places](/x)", "[Terms](/t) [Privacy](/p) [Cookies](/c)", 0), ("The pump was opened.", "<a href='/1'>First</a> <a href='/2'>Second</a> <a href='/3'>Third</a> <a href='/4'>Last</a>", "[Terms](/t) [Privacy](/p) [Cookies](/c)", 0),
    ("", "[Pumps of the north and their makers](/1) [Why seals fail in winter](/2) [A year with a new valve](/3)", "[Older posts](/o) [Newer posts](/n)", 0),
]


def test_held_out_blocks():
    made = [markup.is_content(markup.features(*(markup.block_of(p) if p else None for p in (a, b, c)))) == bool(label) for a, b, c, label in HELD_OUT]
    assert all(m for m, (*_, label) in zip(made, HELD_OUT) if label) and sum(made) >= 0.9 * len(made)


@pytest.mark.parametrize("kept", ["# [All](/a) [the](/b) [links](/c)", "- [one](/1)\n- [two](/2)\n- [three](/3)", "```\n[a](/1) [b](/2) [c](/3)\n```", "$$\nx_{[1]}\n$$", "| [a](/1) | [b](/2) |\n|---|---|", "1. [one](/1) [two](/2)"])
def test_structure_is_never_dropped(kept):
    out, _, dropped = markup.clean_text(f"<b>x</b> [Home](/) [Up](/u) [Down](/d) [Top](/t)\n\n{kept}\n\n[Terms](/t) [Privacy](/p) [Cookies](/c) [Jobs](/j)")
    words = [w for w in re.findall(r"\w+", re.sub(r"\]\([^)]*\)", "]", kept))]
    assert all(w in out for w in words) and dropped <= 2


def test_linked_prose_is_kept_and_drops_are_counted():
    prose = "The work of [A](/a) was used by [B](/b) and then by [C](/c) in the plants of the second town over there, where it had been known for long."
    out, kinds, dropped = markup.clean_text(f"One paragraph of text.\n\n{prose}\n\nAnother paragraph of text.")
    assert "The work of A was used by B and then by C" in out and dropped == 0 and kinds == ["link"] * 3
    assert markup.clean_text("[Home](/) | [About](/about) | [Contact](/contact) | [Login](/login)\n\nThe error of the motor decreases with the size of it.").dropped == 1


def test_markup_table(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", "c"), (2, None, "c"), (3, "", "c"), (4, "plain", "c"), (4, "plain", "c"), (5, "**a** " * 50000, "c")], "rec_id bigint, text string, clean string")
    out = {r.rec_id: r for r in markup.clean_markup(df, ("rec_id",)).collect()}
    assert out[1].clean == "x" and out[2].clean is None and out[3].clean == "" and out[4].n_marks == 0 and out[5].n_marks == 50000
    assert markup.clean_markup(df, ("rec_id",)).count() == 6 and markup.clean_markup(df.limit(0), ("rec_id",)).count() == 0


LOOKS = [("Ｋｅsto", ["full_width"]), ("ﬁne", ["ligature"]), ("e\u0301a", ["combining"]), ("a\u200db", ["invisible"]), ("a\u00a0b", ["space"]), ("Pаrk", ["mixed_script"]), ("Нина", []), ("café — “x” CO₂ α and β", []), ("", []), (None, [])]


@pytest.mark.parametrize("text, found", LOOKS)
def test_traits(text, found):
    assert lookalike.traits(text) == found


def test_unify_table(spark):
    df = spark.createDataFrame([(1, "Pаrk", "c"), (2, None, "c"), (3, "", "c"), (4, "Park", "c"), (4, "Park", "c"), (5, "Ａ" * 200000, "c")], "id bigint, v string, form string")
    out = {r.id: r for r in lookalike.unify_text(df, "v").collect()}
    assert out[1].form == out[4].form == "park" and out[2].form is None and out[3].form == "" and len(out[5].form) == 200000
    assert list(out[1].traits) == ["mixed_script"] and list(out[2].traits) == []
    assert lookalike.unify_text(df.limit(0), "v").count() == 0


def test_tokens_round_trip_and_other_library(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(tokens.rank_file().replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    texts = ["Hello world", "", None, "<|endoftext|> is text", "naïve 👩‍🔬 𝔼 שלום", "a  b\n\n c\t", "x" * 3000, ("word and " * 30000), "a" * 10 + " " * 50 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumnRenamed("text", "text")
    encoded = tokens.encode_corpus(df)
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert got == {i: (other.encode(t, add_special_tokens=False).ids if t else []) for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in tokens.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in tokens.encode_corpus(df, counts_only=True).collect()} == {k: len(v) for k, v in got.items()}
    assert tokens.encode_corpus(df.limit(0)).count() == 0


@given(st.text(alphabet="ab 1.\n'é", max_size=300), st.integers(1, 40))
@settings(max_examples=300, deadline=None)
def test_parts_encode_as_the_whole(text, size):
    parts = list(tokens.safe_parts(text, size))
    path = tokens.rank_file()
    assert "".join(parts) == text
    assert [int(i) for p in parts for i in tokens.encode(p, path)] == [int(i) for i in tokens.encode(text, path)]


def scanned(spark):
    rng = random.Random(1)
    words = "conservation framework modern stability synthetic could uniform marine hypothesis interpretation".split()
    clean = [" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(300)]
    broken = [
        (1001, "the conserva-\ntion of frarnework"), (1002, "modem 5tability"), (1003, "some words\n\n- 48 -\n\nand others could be"), (1004, "Bulletin of Marine Optics 360\nthe uniform"), (1005, "merely\nwrapped conservation"), (1006, None), (1007, ""),
        (1008, "```\n218\n138\n```\ncould"), (1009, "Page 360 of 397"), (1010, "Toganushidal-\nLinn modern"), (1011, "hypo\u00adthesis framework"), (1012, "see <page_number>3</page_number> here"),
    ]
    return spark.createDataFrame([(i, t, "c") for i, t in [*enumerate(clean), *broken]], "rec_id bigint, text string, repaired string")


def test_copies_of_a_noisy_text_are_repaired(spark):
    df = scanned(spark).select("rec_id", "text")
    copies = spark.createDataFrame([(5000 + i, "the frarnework of 5tability") for i in range(150)], df.schema)
    out = {r.rec_id: r for r in scans.repair_scans(df.unionByName(copies), ("rec_id",)).collect()}
    assert all(out[5000 + i].repaired == "the framework of stability" and out[5000 + i].n_misread == 2 for i in range(150))


def test_marked_rows_come_from_the_whole_method(spark, data):
    """p1_found has the rows of the whole cleaning, blocks and tree included."""
    assert "n_dropped" in queries.p1_clean(spark, data).columns
    assert rows(queries.p1_found(spark, data)) == rows(queries.p1_clean(spark, data).where("n_marks > 0").select("tbl", "rec_id"))


def test_scan_repair(spark):
    df = scanned(spark)
    out = {r.rec_id: r for r in scans.repair_scans(df, ("rec_id",)).collect()}
    assert out[1001].repaired == "the conservation of framework" and (out[1001].n_hyphens, out[1001].n_misread) == (1, 1)
    assert out[1002].repaired == "modern stability" and out[1002].n_misread == 2
    assert out[1003].n_edges == 1 and "48" not in out[1003].repaired and out[1004].n_edges == 1 and out[1009].n_edges == 0
    assert out[1005].repaired == "merely wrapped conservation" and not (out[1005].n_hyphens + out[1005].n_misread + out[1005].n_edges)
    assert out[1006].repaired is None and out[1007].repaired == "" and out[1008].n_edges == 0 and out[1012].n_edges == 0
    assert out[1010].n_hyphens == 0 and out[1010].repaired == "Toganushidal-Linn modern"
    assert all(not (r.n_misread + r.n_hyphens + r.n_edges) for k, r in out.items() if k < 1000)
    assert scans.repair_scans(df.limit(0), ("rec_id",)).count() == 0


def test_joined_corrections_equal_the_whole_table(spark):
    """Rows repaired by the join are as those repaired with every correction at hand; a word broken twice is one of them."""
    more = [(2000 + i, f"international θεωρίας теория0l {i}") for i in range(60)] + [(2100, "the inte-\nmatio-\nnal framework"), (2101, "a-\nb-\nc-\nd " * 300), (2102, "intemational"), (2102, "intemational"), (None, "modem")]
    df = scanned(spark).select("rec_id", "text").unionByName(spark.createDataFrame(more, "rec_id bigint, text string"))
    table = {r.word: r.instead for r in scans.corrections(scans.word_counts(df)).collect()}
    assert table["intemational"] == "international"
    got = rows(scans.repair_scans(df, ("rec_id",)))
    want = [(r.rec_id, (m := scans.repair(r.text, table)).hyphens, m.misread, m.edges, m.text) for r in df.collect()]
    assert got == sorted(want, key=repr)
    assert ("international" in dict((g[0], g[4]) for g in got)[2100]) and scans.repair_scans(df.limit(0), ("rec_id",)).count() == 0


def test_corrections_in_other_scripts(spark):
    df = spark.createDataFrame([(i, f"физикаrnая {i}") for i in range(30)] + [(99, "физикаmая"), (98, "x" * 60 + "rn")] + [(200 + i, "x" * 60 + f"m {i}") for i in range(30)], "id int, text string")
    table = {r.word: r.instead for r in scans.corrections(scans.word_counts(df)).collect()}
    assert table == {"физикаmая": "физикаrnая", "x" * 60 + "rn": "x" * 60 + "m"}


def test_anagram_hash_matches_brute_force(spark):
    counts = [("w", w, n) for w, n in (("modern", 900), ("modem", 3), ("marine", 800), ("manne", 2), ("could", 700), ("c0uld", 300), ("form", 500), ("farm", 400), ("xyz", 1))]
    df = spark.createDataFrame(counts, "kind string, word string, n bigint")
    got = {r.word: r.instead for r in scans.corrections(df).collect()}
    want = {}
    for _, w, n in counts:
        able = []
        for rank, (bad, good, _) in enumerate(scans.confusions()):
            for at in range(len(w)):
                if w.startswith(bad, at):
                    v = w[:at] + good + w[at + len(bad) :]
                    m = {x: c for _, x, c in counts}.get(v, 0)
                    ratio = 2 if any(c.isdigit() for c in bad) else 5 if len(w) >= 9 else 10
                    if m >= ratio * n:
                        able.append((m, -rank, v))
        if able:
            want[w] = max(able)[2]
    assert got == want and got["c0uld"] == "could" and "farm" not in got


def test_mix_holds_shares(spark):
    rng = random.Random(2)
    docs = [(i, s, rng.randrange(1, 200)) for i, s in enumerate(rng.choices(["big", "mid", "small"], [70, 25, 5], k=6000))] + [(9001, None, 5), (9002, "other", 5), (9003, "mid", 0), (9004, "mid", None)]
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.1, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_sources(sizes, targets, buckets=16)
    got, shares = mix.collect(), {r.source: r for r in report.collect()}
    have = {s: sum(n for _, x, n in docs if x == s and n) for s in ("big", "mid", "small")}
    weights = {"big": 5 / 9, "mid": 3 / 9, "small": 1 / 9}
    budget = min(have[s] * k / weights[s] for s, k in (("big", 1), ("mid", 2), ("small", 3)))
    assert abs(sum(r.n_tokens for r in got) - budget) < 700
    for s, w in weights.items():
        assert abs(shares[s].actual_share - w) < 0.01 and abs(shares[s].weight - w) < 1e-9
    assert shares["none"].n_tokens == 0 and set(shares) == {"big", "mid", "small", "none"}
    most = {}
    for r in got:
        most[r.source, r.doc_id] = most.get((r.source, r.doc_id), 0) + 1
    assert all(n <= {"big": 1, "mid": 2, "small": 3}[s] for (s, _), n in most.items()) and len({(r.doc_id, r.copy) for r in got}) == len(got)
    times = [r.finish_at for r in got]
    assert times == sorted(times)
    # brute force: the cumulative tokens of each source in the mix's order give the virtual time
    sent = dict.fromkeys(weights, 0)
    for r in got:
        sent[r.source] += r.n_tokens
        assert abs(sent[r.source] / weights[r.source] - r.finish_at) < 1e-3
    half = [r for r in got if r.finish_at <= budget / 2]
    assert abs(sum(r.n_tokens for r in half if r.source == "mid") / sum(r.n_tokens for r in half) - weights["mid"]) < 0.02
    assert mixing.mix_sources(sizes.limit(0), targets)[0].count() == 0


def test_levels_on_held_out_labels(spark, data):
    import pandas as pd

    folder = data.replace("sf0.001", "sf0.1")
    docs, labels = pd.read_parquet(f"{folder}/documents.parquet"), pd.read_parquet(f"{folder}/level_labels.parquet")
    joined = labels.merge(docs, on="doc_id")
    train = np.random.RandomState(0).rand(len(joined)) < 0.7
    model = reading.fit(list(joined.text[train]), list(joined.level[train]))
    got = np.array([reading.predict(reading.prose_words(t), model) for t in joined.text[~train]])
    assert (got == joined.level[~train].values).mean() > 0.9


def test_levels_table(spark):
    easy, hard = "We can see the red hat and the big dog in the sun. ", "The ergodic regularization of the manifold is contingent upon the parametrization of this hypothesis. "
    docs = [(i, easy * 8) for i in range(40)] + [(100 + i, hard * 8) for i in range(40)] + [(900, None), (901, ""), (902, "Das ist nicht der Hund und die Katze mit dem Ball. " * 9), (903, easy), (904, easy * 40000)]
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id bigint, text string, level int")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 4) for i in range(40)] + [(5, None), (6, 9)], "doc_id bigint, level int")
    model = reading.fit_levels(df.drop("level"), labels)
    out = {r.doc_id: r for r in reading.reading_levels(df, model).collect()}
    assert all(out[i].level == 1 for i in range(40)) and all(out[100 + i].level == 4 for i in range(40))
    assert (out[900].n_words, out[900].level, out[901].level) == (0, None, None) and not out[902].english and out[904].level == 1 and out[903].n_words == 13
    empty = reading.fit_levels(df.drop("level").limit(0), labels)
    assert reading.reading_levels(df.limit(0), empty).count() == 0 and reading.predict(["x"], empty) in (1, 2, 3, 4)


def test_words_are_graded_by_all_labelled_texts(spark):
    easy, hard = "We can see the red hat and the big dog in the sun. ", "The ergodic regularization of the manifold is contingent upon the parametrization of this hypothesis. "
    docs = [(i, (easy, hard)[i % 2] * 3 + f"word{chr(97 + i // 8)}x") for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, (1, 4)[i % 2]) for i in range(80)], "doc_id bigint, level int")
    small, whole = reading.fit_levels(df, labels, sample=20), reading.fit([t for _, t in docs], [(1, 4)[i % 2] for i in range(80)])
    assert small.grades == pytest.approx(whole.grades) and {f"word{chr(97 + i)}x" for i in range(10)} <= set(small.grades)


def test_queries_run(spark, data):
    for name, query in queries.QUERIES.items():
        df = query(spark, data)
        assert df.count() >= 0, name
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@given(st.text(alphabet="aBé ßİΩμаЕ\u0301\u0303q\u200b\u00a0Ａﬁ²–…", max_size=12))
@settings(max_examples=500, deadline=None)
def test_disguises_show_in_the_normal_form(text):
    """No disguise is missed by looking only where the normal form is not the text with its case folded."""
    form, kinds = lookalike.unified(text)
    assert kinds == lookalike.traits(text) and form == lookalike.canonical(text)
