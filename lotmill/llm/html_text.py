"""Main text of web pages by tag-path ratios.

Every piece of text hangs at the end of a path of tags from the root.  For each path of a page the length of text and
the number of punctuation marks are divided by the number of pieces and smoothed over neighbouring paths, mostly over those
of the same parent; a heading is worth what follows it.  Both, taken by their logarithms, and the share of text outside links are fused into one score.  Tags, roles and the words of class names
and ids weigh: a path through a menu, a form or a box named so has a small part of its score, one through an article
several times as much.  Nothing of them decides by itself: a wrapper of the whole page weighs on all paths alike.

The path of the greatest score by its text points to the content.  From its element the region grows to the one around as
long as what that adds scores well enough beside what is there already (the less it adds, the more alike), and within the region a threshold on the score
chooses the paths; lists of links and linked quotes stay where content stands on both sides of them.  Only what a browser does not show as text (scripts, styles, hidden elements) is left out at once.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, without

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_MARKS = re.compile(r"[.,;:!?…。，、！？；：¿¡]")

# Elements of HTML by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template noscript iframe svg math object canvas video audio xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
NEVER = frozenset("nav footer aside button select option optgroup menu dialog".split())
#: These may be around a whole page or an article's heading.
RARELY = frozenset("header form fieldset".split())
HOLDERS = frozenset(["article", "main"])
LISTS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Elements whose class names and ids count; those of headings, paragraphs and the like are anchors and styles.
NAMED = frozenset("div section ul ol dl table article main".split())
#: In has-sidebar, no-ads and the like the name tells of something beside the element.
BESIDE = frozenset("has with without no".split())
#: Words in class names and ids of elements that seldom hold an article.
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar toolbar "
    "comment comments commentlist respond reply replies disqus discussion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay dialog newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations pagination pager skip copyright legal hidden form search".split()
)
#: What a path's score is multiplied with for an element that seldom holds an article, for the first that mostly does,
#: and for a header inside that one, which holds its heading.
SELDOM, MOSTLY, HEADING = 0.03, 4.0, 0.5
#: Where all that is left stands in elements that seldom hold an article, prose scores at least this without their weight.
PROSE = 6.0
#: A path of links only keeps this much of its score.
LINKS = 0.05
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a neighbouring path of another parent counts in smoothing, beside one of the same parent.
APART = 0.1
#: The region grows to the element around it if what that adds scores so much of what is there (by text): ``GROW`` where it
#: adds ``LARGE`` of the text or more, and nearly alike where it adds little, as a sentence of an advert does.
GROW, ALIKE, LARGE = 0.5, 0.95, 1.0
#: Paths of the region that have this much of the best score are content.
CONTENT = 0.08


def _words(tag: str, value: str) -> list[str]:
    """Words of a class name or id that tell what the element is."""
    if tag in HOLDERS:  # a holder's own name has to be one of them, not a part of it
        return value.lower().split()
    return [w.lower() for name in value.split() if (found := _NAME.findall(name)) and found[0].lower() not in BESIDE for w in found]


def _weight(tag: str, attributes: str, held: bool) -> float:
    """What an element weighs on the scores of the paths through it; 0 if it is hidden.  ``held``: inside a holder."""
    seldom = tag in NEVER or tag in RARELY
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            if tag in NAMED and (tag, name) != ("section", "id"):  # a section's id is its anchor
                seldom |= any(w in NEVER_NAMES for w in _words(tag, value))
        elif name == "role":
            seldom |= value.lower() in NEVER_ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 0.0
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return 0.0
    if seldom:
        return HEADING if tag == "header" and held else SELDOM
    return MOSTLY if tag in HOLDERS and not held else 1.0


def _label(tag: str, attributes: str) -> str:
    """Tag, with the words of its class where it is a container."""
    if tag in ("div", "section", "td", "ul", "ol") and "class" in attributes.lower():
        for m in _ATTRIBUTE.finditer(attributes):
            if m[1].lower() == "class":
                return tag + "." + ".".join(_NAME.findall(m[2] or m[3] or m[4] or ""))
    return tag


class Paths:
    """The tag paths of a page, each known by number: parent, label, weight, and whether a holder is on it."""

    def __init__(self) -> None:
        self.parent, self.label, self.own, self.weight, self.held, self.never = [-1], [""], [1.0], [1.0], [False], [False]
        self.numbers: dict[tuple[int, str, float], int] = {}

    def below(self, parent: int, tag: str, attributes: str) -> int:
        weight = _weight(tag, attributes, self.held[parent])
        key = (parent, _label(tag, attributes), weight)
        if (number := self.numbers.get(key)) is None:
            number = self.numbers[key] = len(self.parent)
            self.parent.append(parent)
            self.label.append(key[1])
            self.own.append(weight)
            self.weight.append(self.weight[parent] * weight)
            self.never.append(self.never[parent] or tag in NEVER)
            self.held.append(self.held[parent] or tag in HOLDERS)
        return number


def blocks(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The paths, and the pieces of text in page order: path, text, length of links."""
    paths = Paths()
    out: list[tuple[int, str, int]] = []
    tags: list[str] = []
    path = [0]
    opened: Counter[str] = Counter()
    text: list[str] = []
    links = in_link = 0

    def flush() -> None:
        nonlocal links
        if text:
            piece = " ".join(entities.unescape("".join(text)).split())
            if piece and paths.weight[path[-1]]:
                out.append((path[-1], piece, links))
            text.clear()
        links = 0

    def close(upto: int) -> None:
        opened.subtract(tags[upto:])
        del tags[upto:], path[upto + 1 :]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = page[at:stop]
            text.append(piece)
            if in_link:
                links += len(piece)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            text.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
        elif closing:
            flush()
            if opened[tag]:
                k = len(tags) - 1
                while tags[k] != tag:
                    k -= 1
                close(k)
            in_link = 0
        elif tag in RAW:
            if tag in ("svg", "math"):
                flush()
            if not m[3].rstrip(">").endswith("/"):
                done = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = done.end() if done else end
        else:
            flush()
            in_link = 0
            if tag in LISTS:
                same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
                if any(opened[t] for t in same):
                    for k in range(len(tags) - 1, -1, -1):
                        if tags[k] in LISTS[tag]:
                            break
                        if tags[k] in same:
                            close(k)
                            break
            if tags and tags[-1] == "p":
                close(len(tags) - 1)
            tags.append(tag)
            opened[tag] += 1
            path.append(paths.below(path[-1], tag, m[3].rstrip(">/").strip()))
    flush()
    return paths, out


def unlinked(pieces: list[tuple[int, str, int]]) -> dict[int, float]:
    """What links leave of each path's score: all without links, ``LINKS`` of a path of links only."""
    sums: dict[int, list[int]] = {}
    for path, text, linked in pieces:
        s = sums.setdefault(path, [0, 0])
        s[0] += len(text)
        s[1] += min(linked, len(text))
    return {p: (1 - LINKS) * (1 - x / n) + LINKS for p, (n, x) in sums.items()}


def ratios(paths: Paths, pieces: list[tuple[int, str, int]], width: float = 1.0) -> dict[int, float]:
    """Score of each path: smoothed text and punctuation ratios, fused, with the path's links and its weight."""
    sums: dict[int, list[int]] = {}
    for path, text, _ in pieces:
        s = sums.setdefault(path, [0, 0, 0])
        s[0] += len(text)
        s[1] += len(_MARKS.findall(text))
        s[2] += 1
    order = list(sums)
    part = [x * paths.weight[p] for p, x in unlinked(pieces).items()]  # what links and weights leave of a path
    raw = [(s[0] / s[2], s[1] / s[2]) for s in sums.values()]
    for k in range(len(order) - 2, -1, -1):  # a heading is worth what follows it
        if paths.label[order[k]] in HEADINGS and raw[k + 1] > raw[k]:
            raw[k] = raw[k + 1]
    kernel = [math.exp(-(d * d) / (2 * width * width)) for d in range(3)]
    scores = {}
    for k, path in enumerate(order):
        near = []
        for j in range(max(0, k - 2), min(len(order), k + 3)):
            along = 1.0 if paths.parent[order[j]] == paths.parent[path] else APART
            near.append((kernel[abs(j - k)] * (along if j != k else 1.0) * min(1.0, part[j] / part[k]), raw[j]))
        total = sum(w for w, _ in near)
        length, marks = (sum(w * r[i] for w, r in near) / total for i in (0, 1))
        scores[path] = math.log1p(length) * (1 + math.log1p(marks)) * part[k]
    return scores


def main_text(page: str) -> str:
    """The article's blocks, joined by line feeds."""
    paths, pieces = blocks(page)
    if not pieces:
        return ""
    scores = ratios(paths, pieces)
    mass = [0] * len(paths.parent)
    for path, text, _ in pieces:
        mass[path] += len(text)
    able = [p for p in scores if not paths.never[p]]
    if not able:  # menus, footers and the like only
        return ""
    best = max(able, key=lambda p: scores[p] * math.log1p(mass[p]))
    if paths.weight[best] < 1 and scores[best] < PROSE * paths.weight[best]:
        return ""
    chain = set()  # what is around the best path holds the article, whatever its name
    p = best
    while p >= 0:
        chain.add(p)
        p = paths.parent[p]
    weight = [1.0]
    for p in range(1, len(mass)):
        weight.append(weight[paths.parent[p]] * (max(1.0, paths.own[p]) if p in chain else paths.own[p]))
    scores = {p: s * weight[p] / paths.weight[p] for p, s in scores.items()}
    limit = CONTENT * scores[best]
    under = [float(n) if scores.get(p, 0.0) >= limit else 0.0 for p, n in enumerate(mass)]  # of what could be content
    worth = [scores.get(p, 0.0) * n for p, n in enumerate(under)]
    for p in range(len(mass) - 1, 0, -1):  # a path's number is greater than its parent's
        under[paths.parent[p]] += under[p]
        worth[paths.parent[p]] += worth[p]
    region = max(0, paths.parent[best])
    while (around := paths.parent[region]) >= 0:
        more, adds = under[around] - under[region], worth[around] - worth[region]
        need = GROW + (ALIKE - GROW) * max(0.0, 1 - more / (LARGE * under[region]))
        if more > 0 and adds / more < need * worth[region] / under[region]:
            break
        region = around
    inside = [False] * len(mass)
    for p in range(len(mass)):
        inside[p] = p == region or p > 0 and inside[paths.parent[p]]
    kept = [inside[path] and scores[path] >= limit for path, _, _ in pieces]
    linked = {p: scores[p] / x if weight[p] >= 1 else 0.0 for p, x in unlinked(pieces).items()}
    k = 0
    while k < len(pieces):  # lists of links and linked quotes between two pieces of content belong to it
        end = k
        while end < len(pieces) and not kept[end] and inside[pieces[end][0]] and linked[pieces[end][0]] >= limit:
            end += 1
        if end > k and k and end < len(pieces) and kept[k - 1] and kept[end]:
            kept[k:end] = [True] * (end - k)
        k = max(end, k + 1)
    return "\n".join(text for (_, text, _), keep in zip(pieces, kept) if keep)


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows with ``text`` (main text, empty if there is none) and ``n_chars`` (its code points) in place of the page.

    Defined results: a null page counts as empty and gives an empty text, as does a page of menus, forms and notices only;
    broken markup is read as far as it goes; an element that is not closed ends with the page; pages of any length and depth
    are read whole, in linear time; null urls and ids stay; repeated rows give repeated results; an empty table gives an empty
    result; input columns named as an output column are replaced.
    """
    @F.pandas_udf("string")
    def extract(page: pd.Series) -> pd.Series:
        return page.map(main_text)

    kept = without(pages, ["text", "n_chars"])
    out = kept.withColumn("text", extract(text_or_empty(html_col))).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.drop(html_col)


def op8_tag_path_ratios(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_main_text(pages.select("page_id", "url", "html"))
