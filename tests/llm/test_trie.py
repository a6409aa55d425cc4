"""The trie's automaton against plain edit distances."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm.trie import Trie, osa


@given(st.lists(st.text("abc", min_size=1, max_size=6), max_size=20), st.text("abc", min_size=1, max_size=6), st.integers(0, 2))
@settings(max_examples=300, deadline=None)
def test_trie_finds_all_within_bound(words, query, bound):
    found = dict(Trie(words).near(query, bound))
    assert found == {w: osa(w, query) for w in words if osa(w, query) <= bound}
