import pytest

from lotmill.llm.html_text import main_text

PROSE = "Some long text, which goes on and on, and says a lot. It ends here."


@pytest.mark.parametrize("page, want", [
    (f'<article><h1 id="social-media-rules">Rules</h1><p>{PROSE}</p><h2 id="how-to-search">How to search</h2><p class="legal">{PROSE}</p></article>',
     ["Rules", PROSE, "How to search", PROSE]),
    (f'<article><p>{PROSE}</p><section id="related-work"><p>{PROSE}</p></section><section id="discussion"><p>{PROSE}</p></section></article>', [PROSE] * 3),
    (f'<body><div class="content has-sidebar"><p>{PROSE}</p></div></body>', [PROSE]),
    (f'<body><div id="search-results-page"><div><p>{PROSE}</p><p>{PROSE}</p></div></div></body>', [PROSE] * 2),
    (f'<body><form><div id="search-results-page"><div><p>{PROSE}</p></div></div></form></body>', [PROSE]),
])
def test_names_lose_no_prose(page, want):
    assert main_text(page).split("\n") == want


def test_named_containers_still_go():
    page = f'<article><p>{PROSE}</p><div class="related-posts"><p>{PROSE}</p></div><div class="ad">Buy.</div><ul class="share"><li>Send.</ul></article>'
    assert main_text(page) == PROSE
