"""Main text of web pages by tag-path ratios.

Every block of text on a page belongs to a path of tags from the root. Per path, the length of its
text outside links and its punctuation are held against its number of blocks; the ratios are smoothed
over neighbouring paths, fused and cut at a threshold. The deepest element that holds most of the text
of the paths above it is where the article is. Markup only settles what the ratios leave open: if that
element lies in one marked as the article, the whole of that one is the text, short blocks included;
and an element whose class merely resembles the name of furniture is left out only if its own ratio is low.

A page is read once from front to end, in time proportional to its length, however deep or broken it is.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the markup language.
# ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split())
# Their content is no text until the matching end tag.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
# An open p ends before these.
ENDS_P = BLOCK - frozenset("body html title td th tr tbody thead tfoot caption legend summary".split())
ENDS_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
             "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Elements that are never part of the main text.
FURNITURE = frozenset("nav header footer aside form menu button select input dialog search fieldset head".split())
# Words in class, id or role that name such parts.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent notice "
    "notices popup modal newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations widget toolbar pagination pager skip copyright disclaimer alert complementary contentinfo "
    "search".split())
# Words that name readers' comments, which are prose like the article.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
# ---------------------------------------------------------------------------

# A quote counts only behind an equals sign; nothing is tried twice.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)>")
# For pages with a quote that no other one ends: a tag ends at the next angle.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in RAW}
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?。，！？؟।]")


# How an element's own markup names it.
_CONTENT, _MAYBE, _FURNITURE = 0, 1, 2


def _named(tag: str, attributes: str) -> int:
    if tag in FURNITURE:
        return _FURNITURE
    if not attributes or tag in ("html", "body", "article", "main"):
        return _CONTENT
    if _HIDDEN.search(attributes):
        return _FURNITURE
    found = _CONTENT
    for match in _NAMED.finditer(attributes):
        for name in (match[1] or match[2] or match[3] or "").lower().split():
            parts = re.split(r"[-_:]+", name)
            if name in FURNITURE_WORDS or not COMMENT_WORDS.isdisjoint(parts):
                return _FURNITURE
            if not FURNITURE_WORDS.isdisjoint(parts):
                found = _MAYBE
    return found


class _Page:
    """The blocks of a page and the tree of their paths; equal tags of one parent are one node."""

    def __init__(self, page: str):
        # Nodes: parent and tag; a parent comes before its children.
        self.parent, self.tag = [0], [""]
        self._node: dict[tuple[int, str], int] = {}
        # Blocks: (node, text, characters in links, how the elements around it are named).
        self.blocks: list[tuple[int, str, int, int]] = []
        # Open elements: (tag, node, named, inside an article, inside a link); where each tag is open.
        self._open: list[tuple[str, int, int, bool, bool]] = []
        self._where: dict[str, list[int]] = {}
        self._blocks_open: list[int] = []
        self._parts: list[str] = []
        self._linked, self._place = 0, None
        self._read(page)
        self._flush()

    def _child(self, node: int, tag: str) -> int:
        key = (node, tag)
        if key not in self._node:
            self._node[key] = len(self.parent)
            self.parent.append(node)
            self.tag.append(tag)
        return self._node[key]

    def _flush(self) -> None:
        if self._parts:
            text = _SPACE.sub(" ", html.unescape("".join(self._parts))).strip()
            if text:
                self.blocks.append((self._place[0], text, self._linked, self._place[1]))
        self._parts, self._linked, self._place = [], 0, None

    def _add(self, raw: str) -> None:
        if not raw:
            return
        if self._place is None:
            if raw.isspace():
                return
            top = self._open[-1] if self._open else ("", 0, _CONTENT, False, False)
            self._place = (top[1], top[2])
        self._parts.append(raw)
        if self._open and self._open[-1][4]:
            self._linked += len(raw)

    def _last(self, tag: str) -> int:
        """Where a tag is open innermost, -1 if nowhere."""
        places = self._where.get(tag)
        return places[-1] if places else -1

    def _close(self, k: int) -> None:
        if self._blocks_open and self._blocks_open[-1] >= k:
            self._flush()
        while len(self._open) > k:
            self._where[self._open.pop()[0]].pop()
        while self._blocks_open and self._blocks_open[-1] >= k:
            self._blocks_open.pop()

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
            inner = self._blocks_open[-1] if self._blocks_open else -1
            if tag in ENDS_P and inner >= 0 and self._last("p") == inner:
                self._close(inner)
        if tag in ENDS_SAME:
            same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            k = max(map(self._last, same))
            if k > max(map(self._last, ENDS_SAME[tag])):
                self._close(k)
        if attributes.endswith("/") and tag not in BLOCK:
            return
        above = self._open[-1] if self._open else ("", 0, _CONTENT, False, False)
        named = _named(tag, attributes)
        if tag == "header" and above[3]:
            named = _CONTENT  # the heading of an article belongs to it
        if tag in BLOCK:
            self._blocks_open.append(len(self._open))
        self._where.setdefault(tag, []).append(len(self._open))
        self._open.append((tag, self._child(above[1], tag) if tag in BLOCK else above[1], max(above[2], named),
                           above[3] or tag in ("article", "main"), above[4] or tag == "a"))

    def _end(self, tag: str) -> None:
        k = self._last(tag)
        if k < 0:
            if tag == "p":
                self._flush()
        elif tag in BLOCK or not self._blocks_open or k > self._blocks_open[-1]:
            self._close(k)

    def _read(self, page: str) -> None:
        tags, at = _TAG, 0
        while (start := page.find("<", at)) >= 0:
            self._add(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(page)
            elif page.startswith("<![CDATA[", start):
                end = page.find("]]>", start)
                self._add(page[start + 9:end if end >= 0 else len(page)])
                at = end + 3 if end >= 0 else len(page)
            elif page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                at = end + 1 if end >= 0 else len(page)
            elif not (page[start + 1:start + 2].isalpha() or page.startswith("</", start)):
                self._add("<")
                at = start + 1
            else:
                token = tags.match(page, start)
                if token is None and page.find(">", start) >= 0 and tags is _TAG:
                    tags = _PLAIN_TAG  # from here on: a quote has no end
                    token = tags.match(page, start)
                if token is None:
                    if page.find(">", start) < 0:  # no tag can end any more
                        self._add(page[start:])
                        return
                    self._add("<")
                    at = start + 1
                else:
                    at = self._token(page, token)
        self._add(page[at:])

    def _token(self, page: str, token: re.Match) -> int:
        """Handles a tag; where reading goes on."""
        tag = token[2].lower()
        if token[1]:
            self._end(tag)
        elif tag in RAW:
            if tag in BLOCK:
                self._flush()
            end = _RAW_END[tag].search(page, token.end())
            return end.end() if end else len(page)
        elif tag == "br":
            self._add(" ")
        elif tag in VOID:
            if tag in BLOCK:
                self._flush()
        else:
            self._begin(tag, token[3])
        return token.end()


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.concatenate([[0.0], values, [0.0]])
    return 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]


def main_text(page: str | None) -> str:
    """Blocks of the main text, two line feeds between them; empty if there are none."""
    tree = _Page(page or "")
    blocks = [x for x in tree.blocks if x[3] < _FURNITURE]
    if not blocks:
        return ""
    paths: dict[int, int] = {}
    number = np.array([paths.setdefault(x[0], len(paths)) for x in blocks])
    n = len(paths)
    count = np.bincount(number, minlength=n)
    own = np.array([max(0, len(x[1]) - x[2]) for x in blocks])
    marks = np.array([len(_PUNCTUATION.findall(x[1])) for x in blocks])
    text = np.bincount(number, own, n)
    points = np.bincount(number, marks, n)
    # Smoothing lifts a short path among long ones; a rich path beside poor ones keeps its own ratio.
    fused = np.maximum(np.sqrt(_smooth(text / count) * (1 + _smooth(points / count))),
                       np.sqrt(text / count * (1 + points / count)))
    # Links alone are no content, whatever their neighbours.
    content = (fused >= (fused.mean() - fused.std()) * (1 - 1e-9)) & (text > 0)
    if not content.any():
        content = text > 0
    # A doubtful block needs a third of the ratio of an average path, and little of it in links.
    doubtful = np.array([x[3] == _MAYBE for x in blocks])
    poor = (3 * np.sqrt(own * (1.0 + marks)) < fused.mean()) | (3 * own < 2 * np.array([len(x[1]) for x in blocks]))
    kept = ~(doubtful & poor)

    # What each element holds of the content paths: children come behind their parents.
    weight = np.zeros(len(tree.parent))
    for node, k in paths.items():
        weight[node] = text[k] if content[k] else 0
    for node in range(len(weight) - 1, 0, -1):
        weight[tree.parent[node]] += weight[node]
    depth = np.zeros(len(weight), dtype=np.int64)
    article = np.zeros(len(weight), dtype=np.int64)  # the outermost one a node lies in
    for node in range(1, len(weight)):
        above = tree.parent[node]
        depth[node] = depth[above] + 1
        article[node] = article[above] or (node if tree.tag[node] in ("article", "main") else 0)
    leaf = np.array([t in ("p", "li", "h1", "h2") for t in tree.tag])
    fit = np.flatnonzero((weight >= 0.6 * weight[0]) & ~leaf)
    root = int(fit[np.argmax(depth[fit])])
    # Upwards as long as what comes in is as rich as what is there.
    rich = np.zeros(len(weight))
    for node, k in paths.items():
        rich[node] = text[k] * fused[k] if content[k] else 0
    for node in range(len(rich) - 1, 0, -1):
        rich[tree.parent[node]] += rich[node]
    up = root
    while up:
        up = tree.parent[up]
        more = weight[up] - weight[root]
        if more > 0:
            if (rich[up] - rich[root]) * weight[root] < 0.7 * rich[root] * more:
                break
            root = up
    whole = bool(article[root])
    root = int(article[root]) or root
    inside = np.zeros(len(weight), dtype=bool)
    inside[root] = True
    for node in range(root + 1, len(weight)):
        inside[node] = inside[tree.parent[node]]
    return "\n\n".join(x[1] for x, k, keep in zip(blocks, number, kept) if keep and inside[x[0]] and (whole or content[k]))


def main_text_column(page: Column) -> Column:
    """Main text of a column of pages; empty for null, empty or textless ones."""

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page) for page in pages.to_pylist()], pa.string())

    return extracted(page)


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (its code points) to every row of a table of pages.

    One row in, one row out; nothing is shuffled. Null and empty pages, and pages of markup alone,
    have empty text. Columns of the two names are replaced; repeated rows stay.
    """
    return (
        df.drop("text", "n_chars").withColumn("text", main_text_column(F.col(page)))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
