"""Main-text extraction by tag-path ratios (operator 4).

A page is read once, in linear time, into text nodes: one per block of text, with its root-to-leaf path of
block tags. Per path, text length and punctuation are aggregated over the page; both ratios per node and the
path's share of text are fused into its score, link text counting for nothing and paths that the markup marks as menu,
advert, comments and the like for nothing either (the only use of markup hints; a hint on what holds nearly all of
the page's text says nothing, and class names count as whole: ``has-sidebar`` or ``alert-fatigue`` are no hints). Scores are smoothed over
the containers of the tree: a node takes over the mean score of the text that stands directly in its
container or in one around it, and a heading the score of what follows it there. Nodes whose smoothed score
reaches a share of the page's mean are the content; nothing else selects or drops a node.

Inline tags are transparent; text of one block is one line. Nesting is read to any depth.

Defined results: null or empty html gives an empty text of 0 characters; malformed, unclosed or
mis-nested tags are read leniently (a tag without an end drops the rest, as in browsers); very long or deep
pages take time in proportion to their length; of nodes that tie, all are kept or all dropped; repeated rows
are each extracted; other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces

#: Fixed values of HTML: elements without rendered text, those of raw text, block elements, elements that end an open one of their kind.
_HIDDEN = frozenset("script style title textarea noscript template iframe object svg math select button datalist canvas audio video".split())
_RAW = frozenset("script style title textarea iframe".split())
_BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot caption tr td th blockquote pre figure figcaption "
    "header footer nav aside form fieldset legend address details summary hgroup center dialog menu hr search head".split()
)
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_STOP = frozenset("ul ol dl table td th div article section main body".split())
#: Elements that group others; text in any other block stands directly in the group around it.
_GROUPS = frozenset("html body main article section div header footer nav aside form fieldset details hgroup center dialog menu search td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements, roles and class or id words that mark what isn't article text.
_AROUND = frozenset("nav footer aside form menu dialog head search fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
_MARKS = frozenset(
    "nav navbar navigation menu menubar footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert warning comment comments disqus reply replies share sharing social related recommended breadcrumb breadcrumbs "
    "newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination pager masthead topbar copyright".split()
)
#: Words that class names of such parts also hold; a name with any other word (``has``, ``policy``) is no hint.
_PLAIN = frozenset(
    "site page main global top bottom left right upper lower primary secondary inner outer box block bar list item items links link buttons button icons icon wrapper wrap container "
    "content area section group panel row column col header heading title body form nav text slot unit zone message messages pane region menu view desktop mobile".split()
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_INSIDE = re.compile(r"[^>\"']*")
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_PUNCT = re.compile(r"[,.;:!?…。，、；：！？¿¡]")
#: Open blocks among which an element is looked for that a new one of its kind ends.
NEAR = 256
#: Share of the page's plain text beyond which a hint says nothing.
WHOLE = 0.9


def _names(value: str, inside_article: bool) -> bool:
    """Whether a class or id names what isn't article text: a word that does, and none that isn't plain beside it."""
    for name in value.split():
        words = {w.lower() for w in _WORDS.findall(name)}
        hints = words & _MARKS or words & {"header"} and not inside_article
        if hints and words <= _MARKS | _PLAIN:
            return True
    return False


def _marked(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in _AROUND or (tag == "header" and not inside_article):
        return True
    for m in _NAMED.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main", "article"):
            if _names(value, inside_article):
                return True
    return False


class _Finder:
    """``str.find`` from ever later places; a string that isn't found once is never searched for again."""

    def __init__(self, page: str):
        self.page, self.gone = page, set()
        self.lower = None

    def __call__(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        i = self.page.find(what, at)
        if i < 0:
            self.gone.add(what)
        return i

    def closer(self, tag: str, at: int) -> int:
        """Place of ``</tag`` in any case."""
        if self.lower is None:
            low = self.page.lower()
            self.lower = low if len(low) == len(self.page) else re.sub("[A-Z]", lambda m: m[0].lower(), self.page)
        if f"</{tag}" in self.gone:
            return -1
        i = self.lower.find(f"</{tag}", at)
        if i < 0:
            self.gone.add(f"</{tag}")
        return i


def _tokens(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """(text before, closing?, tag, attributes) of each tag in page order; the last has no tag. Linear in the page."""
    find, at, text = _Finder(page), 0, 0
    while (i := find("<", at)) >= 0:
        m = _TAG.match(page, i)
        if m is None:
            after = page[i + 1 : i + 2]
            if page.startswith("<!--", i):
                end = find("-->", i + 4)
                end = len(page) if end < 0 else end + 3
            elif after and after in "!?":
                end = find(">", i)
                end = len(page) if end < 0 else end + 1
            else:  # a plain character
                at = i + 1
                continue
            yield page[text:i], False, "", ""
            text = at = end
            continue
        end = m.end()
        while True:
            end = _INSIDE.match(page, end).end()
            if end >= len(page) or page[end] == ">":
                break
            close = find(page[end], end + 1)
            if close < 0:  # a quote without its fellow counts as a plain character
                close = end
            end = close + 1
        tag = m[2].lower()
        attributes = page[m.end() : end]
        before, text = page[text:i], min(end + 1, len(page))
        if tag in _HIDDEN and not m[1] and not attributes.endswith("/"):
            close = find.closer(tag, text)
            if close >= 0 or tag in _RAW:
                over = find(">", close) if close >= 0 else -1
                text = len(page) if over < 0 else over + 1
            yield before, False, "", ""
        else:
            yield before, bool(m[1]), tag, attributes
        at = text
    yield page[text:], False, "", ""


class Node(NamedTuple):
    """A block of text."""

    path: int  # number of its tag path
    element: int  # number of its block element, 0 outside all
    heading: bool
    chars: int  # outside links
    text: str


class Page:
    """Text nodes and block elements of a page; elements are numbered in page order, so parents come first."""

    def __init__(self, page: str):
        read: list[tuple[int, int, str]] = []  # element, plain characters, text
        hinted = [False]
        #: per element: parent, tag, path, marked, nearest group (itself or around it)
        self.parent, self.tag, self.path, self.marked, self.group = [0], [""], [0], [False], [0]
        self.paths: dict[tuple[int, str, bool], int] = {}
        stack, open_ = [0], Counter()
        parts: list[tuple[str, bool]] = []
        links = articles = 0

        def flush() -> None:
            if not parts:
                return
            text = " ".join(entities.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = sum(len(t) for t, a in parts if a)
                plain = len(text) if not linked else max(0, len(text) - len(" ".join(entities.unescape("".join(t for t, a in parts if a)).split())))
                read.append((stack[-1], plain, text))
            parts.clear()

        def pop_to(i: int) -> None:
            nonlocal articles
            for e in stack[i:]:
                open_[self.tag[e]] -= 1
                articles -= self.tag[e] in ("article", "main")
            del stack[i:]

        for before, closing, tag, attributes in _tokens(page):
            if before:
                parts.append((before, links > 0))
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                parts.append((" ", False))
            if tag not in _BLOCKS:
                continue
            flush()
            if closing:
                if open_[tag]:
                    i = len(stack) - 1
                    while self.tag[stack[i]] != tag:
                        i -= 1
                    pop_to(i)
                continue
            if self.tag[stack[-1]] == "p":
                pop_to(len(stack) - 1)
            if tag in _ENDS and any(open_[t] for t in _ENDS[tag]):
                for i in range(len(stack) - 1, max(0, len(stack) - 1 - NEAR), -1):
                    own = self.tag[stack[i]]
                    if own in _ENDS[tag]:
                        pop_to(i)
                        if tag != "tr" or not any(self.tag[e] in ("tr", "td", "th") for e in stack[-2:]):
                            break
                    elif own in _STOP:
                        break
            if tag in _VOID:
                continue
            up = stack[-1]
            hinted.append(_marked(tag, attributes, articles > 0))
            stack.append(len(self.tag))
            open_[tag] += 1
            articles += tag in ("article", "main")
            self.parent.append(up)
            self.tag.append(tag)
            self.group.append(stack[-1] if tag in _GROUPS else self.group[up])
        flush()

        held = [0] * len(self.tag)  # plain characters below each element
        for e, plain, _ in read:
            held[e] += plain
        for e in range(len(held) - 1, 0, -1):
            held[self.parent[e]] += held[e]
        for e in range(1, len(held)):
            up = self.parent[e]
            self.marked.append(self.marked[up] or hinted[e] and (held[e] <= WHOLE * held[0] or held[e] == 0))
            self.path.append(self.paths.setdefault((self.path[up], self.tag[e], self.marked[e]), len(self.paths) + 1))
        self.nodes = [Node(self.path[e], e, self.tag[e] in _HEADINGS, plain, text) for e, plain, text in read]


def path_scores(page: Page) -> np.ndarray:
    """Fused tag-path ratio of each node: mean length by mean punctuation of its path by the root of its share of text; 0 where it's marked."""
    n = len(page.paths) + 1
    path = np.array([x.path for x in page.nodes], np.int64)
    chars = np.bincount(path, [x.chars for x in page.nodes], n)
    punct = np.bincount(path, [len(_PUNCT.findall(x.text)) for x in page.nodes], n)
    count = np.maximum(np.bincount(path, minlength=n), 1)
    ratio = chars / count * (1 + punct / count) * np.sqrt(chars / max(chars.max(), 1))
    return np.where([page.marked[x.element] for x in page.nodes], 0.0, ratio[path])


def smoothed(page: Page, scores: np.ndarray) -> np.ndarray:
    """Scores after smoothing over containers.

    The text that stands directly in a group (in blocks that aren't groups) has a mean score, weighted by
    length. All text below a group takes it over if that text is at least half of what the group holds, else
    only the direct text; direct text of the page's own body is never taken over by groups below it.
    """
    n = len(page.tag)
    group = np.array([page.group[x.element] for x in page.nodes], np.int64)
    size = np.array([len(x.text) for x in page.nodes], float)
    size[[page.marked[x.element] and not page.marked[page.parent[g]] for x, g in zip(page.nodes, group.tolist(), strict=True)]] = 0
    body = np.array([not x.heading for x in page.nodes])
    if not body.any():
        body[:] = True
    direct = np.bincount(group, size, n)
    weight = np.bincount(group, size * body, n)
    mean = np.divide(np.bincount(group, size * body * scores, n), weight, out=np.zeros(n), where=weight > 0)
    whole = direct.copy()
    for e in range(n - 1, 0, -1):  # children come after their parents
        if not (page.marked[e] and not page.marked[page.parent[e]]):
            whole[page.parent[e]] += whole[e]
    handed = [0.0] * n
    for e in range(1, n):
        up = page.parent[e]
        handed[e] = 0.0 if page.marked[e] else handed[up]
        if page.group[e] == e and page.tag[e] not in ("html", "body") and 2 * direct[e] >= whole[e]:
            handed[e] = max(handed[e], float(mean[e]))
    out = np.maximum(scores, np.maximum(mean[group], [handed[x.element] for x in page.nodes]))
    out[[page.marked[x.element] for x in page.nodes]] = scores[[page.marked[x.element] for x in page.nodes]]
    # a heading stands for what follows it inside its own group
    last = [0] * n  # number of the last element below each, to tell what lies inside
    for e in range(n - 1, -1, -1):
        last[e] = max(last[e], e)
        last[page.parent[e]] = max(last[page.parent[e]], last[e])
    for i in range(len(page.nodes) - 2, -1, -1):
        x, after, g = page.nodes[i], page.nodes[i + 1], int(group[i])
        if x.heading and not page.marked[x.element] and g <= after.element <= last[g]:
            out[i] = max(out[i], out[i + 1])
    return out


def main_text(page: str | None, share: float = 0.25) -> str:
    """Lines of the nodes whose smoothed score reaches ``share`` of the page's mean, weighted by length."""
    read = Page(page) if page else None
    if read is None or not read.nodes:
        return ""
    scores = smoothed(read, path_scores(read))
    size = np.array([len(x.text) for x in read.nodes], float)
    if not scores.any():
        return ""
    seen = scores > 0
    cut = share * float((scores * size)[seen].sum() / size[seen].sum())
    return "\n".join(x.text for x, s in zip(read.nodes, scores.tolist(), strict=True) if s >= cut and s > 0)


def extract(pages: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Per page: the id columns, text, n_chars."""
    rows = pages.select(*id_cols, F.col(html_col).alias("_html"))
    kinds = dict(rows.dtypes)
    names = [*id_cols, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, htmls in pieces(batches, "_html", 8_000_000):
            texts = [main_text(h) for h in htmls]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in id_cols), "text string, n_chars long"]))
