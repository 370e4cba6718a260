"""op3 on pages of a million characters of tags, and on stubs and odd names."""

import time

import pytest

from riskgraph.llm.html_lbd import main_text

PARAGRAPH = "<p>" + "A sentence of the article, long enough to count. " * 8 + "</p>"


@pytest.mark.parametrize("opening", ["<b>", "<font></span>", "<div><tr><td>", "<table><tr>", "<p><li>", "<ul><li><a>", "</td>"])
def test_a_megabyte_of_unclosed_tags_takes_seconds(opening):
    page = PARAGRAPH + opening * (1_000_000 // len(opening)) + PARAGRAPH
    start = time.process_time()
    text = main_text(page)
    assert time.process_time() - start < 5
    assert text.startswith("A sentence of the article")


def test_nested_paragraphs_inside_many_inline_elements():
    assert main_text("<b>" * 3000 + "<p>x</p>" * 3000).count("x") in (0, 3000)


def test_a_stub_of_an_article_does_not_hide_the_page():
    body = "long text here, and more of it. " * 30
    assert body.strip() in main_text(f"<article><p>A</p></article><div>{body}</div>")
    assert main_text(f"<article><p>{body}</p></article><div>A</div>") == body.strip()


def test_an_entry_keeps_its_text_whatever_else_it_is_called():
    body = "paragraph text " * 20
    assert main_text(f'<div class="entry related-topic"><p>{body}</p></div>') == body.strip()
    assert main_text(f'<div class="related"><p>{body}</p></div><div><p>{body}b</p></div>') == (body + "b").strip()


def test_unmatched_ends_close_nothing():
    body = "words of the text " * 20
    assert main_text(f"</div></span><div><p>{body}</i></b></p></div></td>") == body.strip()
