"""Letters whose lower case is longer than themselves move no position."""

import pytest

from riskgraph.llm.html_lbd import main_text

SAID = "This paragraph is long enough to be kept as the article's own text, and it has to stay whole. " * 3


@pytest.mark.parametrize("tag", ["script", "STYLE", "textarea", "iframe"])
def test_text_after_raw_elements_stays(tag):
    page = (f"<html><body><p>{'İ' * 50} {SAID}</p><{tag}>var x = 1;</{tag.swapcase()}>"
            f"<p>First {SAID}</p><p>Second {SAID}</p></body></html>")
    text = main_text(page)
    assert "First" in text and "Second" in text and text.count("stay whole") == 9
    assert "var x" not in text
