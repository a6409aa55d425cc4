"""Splitting: invariants on random texts, defined results for odd input."""

from __future__ import annotations

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm import splitting as S

TEXT = st.lists(st.sampled_from(["# Head\n\n", "word ", "Sentence one. ", "Two! ", "\n\n", "\n", "<page_number>3</page_number>\n\n", "```\ncode\n```\n", "x" * 90]), max_size=120).map("".join)


@given(TEXT, st.integers(60, 200))
@settings(max_examples=200, deadline=None)
def test_pieces_cover_and_overlap(text, limit):
    low, high = limit // 20, limit // 9
    made = S.pieces(text, limit, (low, high))
    if not text:
        assert made == []
        return
    assert made[0].start == 0 and made[-1].end == len(text)
    for before, p in zip([None, *made], made):
        assert p.end - p.start <= limit
        if before:
            assert p.start == before.end - p.overlap and low <= p.overlap <= high + 1 and p.end > before.end


def brute(text: str, low: int, high: int) -> int:
    strength = {}
    for value, pattern in reversed(S.STRENGTHS):
        for m in pattern.finditer(text):
            strength[m.end()] = value
    for m in S.WHOLE.finditer(text):
        for p in range(m.start() + 1, m.end()):
            if p in strength:
                strength[p] -= 7
    able = [(v, p) for p, v in strength.items() if low <= p <= high]
    return max(able)[1] if able else high


@given(TEXT, st.integers(0, 400), st.integers(1, 200))
@settings(max_examples=200, deadline=None)
def test_sparse_table_equals_scan(text, low, width):
    high = min(len(text), low + width)
    if low < high:
        assert S.StrongestCut(text).best(low, high) == S.StrongestCut(text, width).best(low, high) == brute(text, low, high)


def test_split_table(spark):
    texts = [(1, "a. " * 4000), (2, None), (3, ""), (4, "short"), (5, "z" * 13000), (1, "a. " * 4000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in texts], "rec_id bigint, text string, piece string")
    out = S.split_oversized(df, ("rec_id",))
    by = {}
    for r in out.collect():
        by.setdefault(r.rec_id, []).append(r)
    assert set(by) == {1, 3 + 1, 5} and len(by[4]) == 1 and len(by[1]) % 2 == 0
    assert all(len(r.piece_text) <= 6000 and r.end_at - r.start == len(r.piece_text) for v in by.values() for r in v)
    assert all(300 <= r.overlap_chars <= 700 for v in by.values() for r in v if r.piece)
    assert S.split_oversized(df.limit(0), ("rec_id",)).count() == 0
