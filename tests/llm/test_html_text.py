import html
import math
import re
import time

import pytest

from lotmill.llm import html_text
from lotmill.llm.html_text import blocks, extract_main_text, main_text, op8_tag_path_ratios, ratios

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div id="wrap"><div class="main-menu"><a href=x>Home</a> <a>About us</a></div>
<div class="post"><h2>Title &amp; more</h2><p>Some long text, which goes on.&nbsp; And <b>on</b>
  and on.<br>More.</p><script>var t = "</p>";</script><ul><li>One item.<li>Two &lt;items&gt;.</ul>
<div class="comments"><p>Great post, really! I liked it very much, thank you.</p></div></div>
<aside>Side</aside><form>Name <input> <button>Go</button></form><div class="cookie-notice">We use cookies.</div></div><footer>(c)</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == "Title & more\nSome long text, which goes on. And on and on. More.\nOne item.\nTwo <items>."


def test_best_path_is_prose():
    paths, pieces = blocks(PAGE)
    scores = ratios(paths, pieces)
    best = max(scores, key=scores.get)
    assert paths.label[best] in ("p", "h2") and paths.label[paths.parent[best]] == "div.post"
    menu = next(p for p, text, _ in pieces if "About" in text)
    assert scores[menu] < 0.01 * scores[best]


PROSE = "It was late in the year, and nobody had seen the ferry for a week. The harbour lay still; even the gulls had gone."
BODY = "".join(f"<p>{PROSE} ({k})</p>" for k in range(5))
TEXT = "\n".join(f"{PROSE} ({k})" for k in range(5))
MENU = "<ul><li><a href=/a>Home</a><li><a href=/b>News of today</a><li><a href=/c>About us</a></ul>"
LINKS = '<div><div><a href=/1>Ten things to know about boats</a></div><div><a href=/2>Why we moved north</a></div></div>'
REPLY = '<div class="{0}"><article class="comment"><p>Great post, really! I liked it very much, thank you.</p></article></div>'

UNNAMED = [  # pages that name nothing: only the ratios tell
    (f"<body><div>{MENU}</div><div><h2>The ferry</h2>{BODY}</div><div>{LINKS}</div></body>", f"The ferry\n{TEXT}"),
    (f"<body><div><div>{LINKS}</div><div><div><h2>The ferry</h2></div><div>{BODY}<ul><li>One boat.<li>Two oars.</ul></div></div></div>{MENU}</body>",
     f"The ferry\n{TEXT}\nOne boat.\nTwo oars."),
    (f"<body>{MENU}<h1>The ferry</h1>{BODY}{LINKS}</body>", f"The ferry\n{TEXT}"),
    (f"<table><tr><td>{MENU}</td><td><div>{BODY}</div></td></tr></table>", TEXT),
]


@pytest.mark.parametrize("page, want", UNNAMED)
def test_pages_without_names(page, want):
    assert main_text(page) == want


def test_ratios_decide(monkeypatch):
    monkeypatch.setattr(html_text, "ratios", lambda paths, pieces, width=1.0: {p: 1.0 for p, _, _ in pieces})
    assert all(main_text(page) != want for page, want in UNNAMED)
    assert main_text(PAGE).startswith("Title") is False


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "page-with-comments", "site search-page", "post-header-layout", "hidden-xs-down", "sidebar", "comments"])
@pytest.mark.parametrize("inner", ["<article>{0}</article>", "<div>{0}</div>", "<main>{0}</main>", "{0}"])
def test_wrappers_of_any_name(name, inner):
    page = f'<body><nav>{MENU}</nav><div class="{name}">{inner.format("<h1>The ferry</h1>" + BODY)}</div><footer>(c) All rights, and so on.</footer></body>'
    assert main_text(page) == f"The ferry\n{TEXT}"


@pytest.mark.parametrize("page", [
    f'<main>{BODY}<section class="comments">{REPLY.format("x") * 9}</section></main>', f'<div>{BODY}</div><div id="comments">{REPLY.format("reply") * 9}</div>',
    f"<article>{BODY}<aside><p>{PROSE}</p></aside><form><p>{PROSE}</p><button>Send</button></form></article><footer><p>{PROSE} {PROSE}</p></footer>",
    f'<form action=/><div role=navigation>{MENU}</div><div class="cookie-notice"><p>We use cookies, as all do. More is said here.</p></div><div>{BODY}</div></form>',
    f"<article>{BODY}<p hidden>{PROSE}</p><div style='display: none'>{PROSE}</div><script>'{PROSE}'</script></article>",
])
def test_boilerplate_goes(page):
    assert main_text(page) == TEXT


def test_short_articles_beside_long_footers():
    page = f"<nav>{MENU}</nav><article><h1>Note</h1><p>So it is.</p></article><footer><p>{PROSE}</p><p>{PROSE}</p></footer>"
    assert main_text(page) == "Note\nSo it is."


def test_depth_is_linear():
    def took(depth):
        began = time.process_time()
        assert main_text("<div>" * depth + "deep, text." + "</div>" * depth) == "deep, text."
        assert main_text("<div><p>so it goes, on and on.</p>" * depth).count("\n") == depth - 1
        return time.process_time() - began

    took(500)
    assert took(12_000) < 4 * took(6_000) + 0.2


def test_given_pages(spark, duck, sf_dir):
    want = {}
    for page_id, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want[page_id] = "\n".join(p for p in parts if p)
    got = op8_tag_path_ratios(spark, sf_dir)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_edges(spark):
    rows = [
        (1, None), (1, ""), (2, "no markup at all, just text."), (None, "<p title='a>b'>x &eacute; z.</p><!-- <p>no</p> --><p hidden>no</p>"), (3, "<nav>only a menu</nav>"),
        (4, "<article>" + "<p>word, word. " * 50_000 + "</article>"), (5, "<p"), (6, "<script>never closed"), (7, "<div>" * 3000 + "deep, text."),
    ]
    df = spark.createDataFrame([(i, "u", h, 1) for i, h in rows], "page_id long, url string, html string, N_CHARS int")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = [r.text for r in got.collect()]
    assert found[:5] == ["", "", "no markup at all, just text.", "x é z.", ""]
    assert found[5].count("\n") == 49_999 and found[6:8] == ["", ""] and found[8] == "deep, text."
    assert extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("part, shown", [
    ('<ul><li><a href=/1>One boat</a><li><a href=/2>Two oars, and a sail</a></ul>', "One boat\nTwo oars, and a sail"), ("<blockquote><a href=/q>As somebody said: it was late.</a></blockquote>", "As somebody said: it was late."),
])
@pytest.mark.parametrize("holder", ["article", "div"])
def test_links_in_the_middle_of_an_article_stay(part, shown, holder):
    page = f"<body><nav>{MENU}</nav><{holder}>{BODY}{part}{BODY}</{holder}><div>{LINKS}</div></body>"
    assert main_text(page) == f"{TEXT}\n{shown}\n{TEXT}"
    assert main_text(page.replace("<ul>", '<ul class="related">').replace("<blockquote>", '<blockquote hidden>')) == f"{TEXT}\n{TEXT}"


def given():
    import duckdb

    want = {}
    for page_id, page in duckdb.execute("SELECT page_id, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want[page] = "\n".join(p for p in parts if p)
    return want


def test_ratios_find_the_given_articles_without_names(monkeypatch):
    """No word list and no element that holds articles: text and punctuation by path tell articles from adverts."""
    monkeypatch.setattr(html_text, "NEVER_NAMES", frozenset())
    monkeypatch.setattr(html_text, "HOLDERS", frozenset())
    pages = given()
    assert sum(main_text(page) == want for page, want in pages.items()) >= 0.95 * len(pages)
    monkeypatch.setattr(html_text, "ratios", lambda paths, pieces, width=1.0: {p: paths.weight[p] for p, _, _ in pieces})
    assert sum(main_text(page) == want for page, want in pages.items()) <= 0.05 * len(pages)


def test_ratios_equal_brute_force():
    """Each path's sums, smoothed over its neighbours in page order, row by row."""
    for page in [PAGE, *[p for p, _ in UNNAMED], *list(given())[:40]]:
        paths, pieces = blocks(page)
        order = list(dict.fromkeys(p for p, _, _ in pieces))
        mine = {p: [x for x in pieces if x[0] == p] for p in order}
        part = {p: paths.weight[p] * (0.95 * (1 - sum(min(n, len(t)) for _, t, n in mine[p]) / sum(len(t) for _, t, _ in mine[p])) + 0.05) for p in order}
        mean = lambda p, f: sum(f(t) for _, t, _ in mine[p]) / len(mine[p])
        marks = lambda t: sum(c in ".,;:!?…。，、！？；：¿¡" for c in t)


        def raw(p):  # a heading is worth what follows it, where that is more
            own, after = (mean(p, len), mean(p, marks)), order[order.index(p) + 1 :]
            return max(own, raw(after[0])) if paths.label[p] in html_text.HEADINGS and after else own

        want = {}
        for k, p in enumerate(order):
            near = [(math.exp(-((j - k) ** 2) / 2) * min(1, part[q] / part[p]) * (1 if paths.parent[q] == paths.parent[p] else 0.1), q) for j, q in enumerate(order) if abs(j - k) <= 2]
            smooth = lambda i: sum(w * raw(q)[i] for w, q in near) / sum(w for w, _ in near)
            want[p] = math.log(1 + smooth(0)) * (1 + math.log(1 + smooth(1))) * part[p]
        got = ratios(paths, pieces)
        assert got.keys() == want.keys() and all(math.isclose(got[p], want[p], rel_tol=1e-9) for p in got)
