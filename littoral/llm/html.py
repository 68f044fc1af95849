"""HTML extraction from streaming parser events and text-to-tag ratios.

The standard library's parser sends events; a line is the text between two block tags, with the
tags met in it and the container it lies in. The logarithm of its text (outside links) per tag is
its ratio. Boilerplate elements and roles give the ratio no weight, class and id names of
boilerplate little, as does a place outside of ``article`` and ``main`` where these hold most of
the page's other text. Ratios are smoothed by a Gaussian over neighbouring lines and split into
two clusters by a threshold: the upper one is content.

Containers of one kind (boilerplate or not, inside an article or not) form a region. A region
whose text is content for the most part is taken whole, short lines included; one with hardly any
is left out; in between, its inner containers are judged the same way and its own lines one by one. Where only
regions with names of noise are left, the one with most content stands.

Defined cases: null or empty pages and pages without text give an empty text; unclosed tags
end with their parent or the page; very long pages are parsed as a stream; equal pages give
equal results; an empty table gives no rows; input columns named like an output column are
replaced, all others are kept.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from littoral.llm.common import Kept, small_batches

# HTML element names by their role on a page.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frame h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINER = frozenset(
    "article aside blockquote body button details dialog div dl fieldset figure footer form head header html iframe main menu nav noscript object ol section select svg table template td textarea title ul canvas audio video".split()
)
#: Elements whose text is no text of the page.
HIDDEN = frozenset("button canvas audio video head iframe noscript object script select style svg template textarea title".split())
#: Boilerplate; so is a header outside of an article.
FURNITURE = frozenset("aside dialog footer form menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: A class or id is noise if it is made of such words, or of them and FILLER.
NOISE = re.compile(
    r"ad|ads|adv|advert\w*|adsense|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|paywall|popup|promos?|promoted|related|replies|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|subscription|toolbar|widget",
    re.I,
)
#: Noise outside of an article only, inside one its title.
TITLES = frozenset("header masthead".split())
FILLER = frozenset("area bar block body bottom box button buttons container form icons inner item items left link links list posts right section site slot top unit wrap wrapper".split())
#: Weights of the ratio of lines in containers with a name of noise, and of lines outside of the article.
NAMED, OUTSIDE = 0.15, 0.2
SIGMA = 1.5
#: The threshold lies between the clusters, but no higher than three characters a tag.
CEILING = float(np.log1p(3))
#: Shares of content from which a region is taken whole, and up to which it is left out.
WHOLE, NOTHING = 0.8, 0.2


class _Lines(HTMLParser):
    """Collects lines (text, tags met, characters of links, container) and containers."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int]] = []  # name, hidden, container
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.linked: list[int] = []
        self.owner: list[int] = []
        self.parent, self.kind, self.furniture, self.noisy = [-1], [""], [False], [False]  # of containers
        self.now: list[str] = []
        self.met = self.links = self.in_link = 0

    def _break(self) -> None:
        if self.now:
            text = " ".join("".join(self.now).split())
            self.now = []
            if text:
                self.texts.append(text)
                self.tags.append(self.met)
                self.linked.append(min(self.links, len(text)))
                self.owner.append(self.stack[-1][2] if self.stack else 0)
                self.met = 0
            self.links = 0

    def _inside(self) -> bool:
        return any(x[0] in ("article", "main") for x in self.stack)

    def _furniture(self, tag: str, attrs: list) -> bool:
        if tag in FURNITURE or tag == "header" and not self._inside():
            return True
        return tag not in ("article", "main", "body", "html") and any(k == "role" and v and v.lower() in ROLES for k, v in attrs)

    def _named(self, tag: str, attrs: list) -> bool:
        """Whether class or id speak of noise; so does an article in an article, a comment or a teaser."""
        inside = self._inside()
        if tag in ("main", "body", "html"):
            return False
        if tag == "article" and any(x[0] == "article" for x in self.stack):
            return True
        for token in " ".join(v for k, v in attrs if v and k in ("class", "id")).split():
            parts = [x for x in re.split(r"[_-]+", token.lower()) if x and x not in FILLER]
            if parts and all(map(NOISE.fullmatch, parts)) and not (inside and TITLES.issuperset(parts)):
                return True
        return False

    def _close(self, tag: str) -> None:
        """A block ends an open p, and a list item the one before."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == "p" or name == "li" and tag == "li":
                del self.stack[i:]
            elif name != "span":
                break

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self._break()
            if tag != "br":
                self._close(tag)
        self.met += 1
        self.in_link += tag == "a"
        own = tag in ("p", "span", "li") and bool(attrs)
        if tag in CONTAINER or own and (self._named(tag, attrs) or self._furniture(tag, attrs)):
            if tag in ("article", "main"):  # an open menu or head above was left unclosed
                while self.stack and self.stack[-1][0] in ("head", "title", "nav", "header", "ul"):
                    self.stack.pop()
                self.in_link = 0
            above = self.stack[-1] if self.stack else ("", False, 0)
            furniture, named = self._furniture(tag, attrs), self._named(tag, attrs)
            container = above[2]
            if furniture or named or tag in ("article", "main", "section", "div", "body", "td"):
                self.parent.append(container)
                self.kind.append(tag)
                self.furniture.append(furniture or self.furniture[container])
                self.noisy.append(named)
                container = len(self.parent) - 1
            self.stack.append((tag, above[1] or tag in HIDDEN, container))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in CONTAINER:  # HTML does not close such tags by a slash
            self.handle_starttag(tag, attrs)
        else:
            if tag in BLOCK:
                self._break()
            self.met += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._break()
        self.met += 1
        self.in_link = max(0, self.in_link - (tag == "a"))
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._break()
                del self.stack[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.cdata_elem is None and not (self.stack and self.stack[-1][1]):
            self.now.append(data)
            if self.in_link:
                self.links += len(data)


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means over neighbouring lines."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach : reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach : reach + len(ratio)] / weight


def threshold(values: np.ndarray) -> float:
    """Between the means of the two clusters of values, CEILING at most."""
    low, high = values.min(), values.max()
    for _ in range(20):  # two means on a line
        above = values >= (low + high) / 2
        if above.all():
            break
        low, high = values[~above].mean(), values[above].mean()
    return min((low + high) / 2, CEILING)


def content_lines(chars: np.ndarray, tags: np.ndarray, weight: np.ndarray, region: np.ndarray) -> np.ndarray:
    """Which lines belong to the cluster of higher ratio of text to tags, smoothed within their region."""
    ratio = weight * np.log1p(chars / np.maximum(tags, 1))
    smooth = np.zeros(len(ratio))
    order = np.argsort(region, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(region[order])) + 1):
        smooth[own] = smoothed(ratio[own])
    return (smooth > 0) & (smooth >= threshold(smooth))


def _regions(parser: _Lines, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each container the first one of its region, and the weight of its lines."""
    parent, n, owner = parser.parent, len(parser.parent), np.array(parser.owner)
    main = [k in ("article", "main") for k in parser.kind]

    def noise(free: bool) -> list[bool]:
        """Containers under a name of noise; ``free``: an article or main element under one is none."""
        out = [False] * n
        for i in range(1, n):
            out[i] = parser.noisy[i] or out[parent[i]] and not (free and main[i])
        return out

    noisy = noise(False)
    if not any(m and not x for m, x in zip(main, noisy, strict=True)):
        noisy = noise(True)
    inside = [False] * n
    for i in range(1, n):
        inside[i] = (main[i] or inside[parent[i]]) and not noisy[i]
    mark = [(f, x, y) for f, x, y in zip(parser.furniture, noisy, inside, strict=True)]
    first = np.arange(n)
    for i in range(1, n):
        if mark[i] == mark[parent[i]]:
            first[i] = first[parent[i]]
    held = np.array([(not f and not x, y) for f, x, y in mark]).reshape(n, 2)[owner]
    apart = chars[held[:, 1]].sum() * 2 >= chars[held[:, 0]].sum() and held[:, 1].any()
    weight = np.array([0.0 if f else (NAMED if x else 1.0) * (OUTSIDE if apart and not y else 1.0) for f, x, y in mark])
    return first, weight


def main_text(page: str | None) -> str:
    if not page:
        return ""
    parser = _Lines()
    parser.feed(page)
    parser.close()
    parser._break()
    if not parser.texts:
        return ""
    owner, parent = np.array(parser.owner), parser.parent
    chars = np.array([len(t) for t in parser.texts])
    first, weight = _regions(parser, chars)
    good = content_lines(chars - np.array(parser.linked), np.array(parser.tags), weight[owner], first[owner])
    whole = np.bincount(owner, chars, minlength=len(parent))
    content = np.bincount(owner, chars * good, minlength=len(parent))
    for i in range(len(parent) - 1, 0, -1):
        if first[i] != i:
            whole[parent[i]] += whole[i]
            content[parent[i]] += content[i]
    state = np.full(len(parent), 2)  # 0: left out, 1: taken whole, 2: line by line
    for i in range(len(parent)):
        if first[i] != i and state[parent[i]] < 2:
            state[i] = state[parent[i]]
        elif whole[i]:
            share = content[i] / whole[i]
            state[i] = 1 if share >= WHOLE else 0 if share <= NOTHING else 2
    taken = np.where(state[owner] == 2, good, state[owner] == 1)
    if taken.any() and weight[owner][taken].max() < OUTSIDE:  # nothing but names of noise: the region with most content
        taken &= first[owner] == np.bincount(first[owner], chars * taken).argmax()
    return " ".join(t for t, x in zip(parser.texts, taken, strict=True) if x)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points)."""

    @F.arrow_udf("string")
    def text_of(html: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in html], pa.string())

    small_batches(pages.sparkSession)
    kept = Kept(pages, "html")
    return kept.back(kept.frame.withColumn("text", text_of(F.col("html"))).withColumn("n_chars", F.length("text").cast("long")), "text", "n_chars")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
