"""Malformed pages: layout elements, scripts and comments that are never closed."""

import pytest

from colloquia.llm.langid import visible_text


@pytest.mark.parametrize("page,words", [
    ("a<header>b<p>c</p>", "a b c"), ("a<nav>b<nav>c", "a b c"), ("a<NAV>b</Nav >c<nav>d", "a c d"),
    ("a<aside>b<footer>c</footer>d", "a b d"), ("a<header>b</headers>c", "a b c"),
    ("a<nav>b<script>c</nav>d", "a d"), ("a<header>b<script>c</script>d<style>e", "a b d"),
    ("a<script>b<p>c", "a"), ("a<!-- b", "a"), ("</nav>a<nav>b", "a b")])
def test_visible_text(page, words):
    assert visible_text(page).split() == words.split()


def test_many_unclosed_elements_are_searched_for_once():
    assert len(visible_text("<nav>x" * 200_000).split()) == 200_000
