"""Main text of HTML pages from streaming parser events, text-to-tag ratios and their smoothed clusters.

The standard-library parser's events become lines: a line is the text between
two block-level tags, with the tags met inside it, the share of it in links,
and the innermost section it stands in. Elements that are never main text are
marked by tag or role (navigation, footer, form, script, ...) or named by class
or id; a name alone counts only as far as the element's text bears it out (see
``_boilerplate_lines``), so layout wrappers keep what they hold. A line's text-to-tag ratio is its characters over its tags. The
ratios are smoothed by a Gaussian over neighbouring lines and the lines above
the threshold (the mean of the two centres of a two-means clustering) form the
content cluster. Content regions are the deepest section with at least ``SHARE``
of the cluster's text and the section of every other line of the cluster, each
widened from a list, table or figure to what it stands in, and to the page's
article or main element around it. All lines of the regions that are not
boilerplate are kept, so short paragraphs between long ones stay, and so do
lines that stand directly in the sections that join the regions.

Defined cases: null, empty and text-free pages give the empty text; unclosed
and misnested tags are closed where their section ends; without any section
the body's lines are taken, before and after the content cluster only those
that are not mostly links.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.5        # lines
SHARE = 0.6
SKIP = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "map"}
DROP = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea", "fieldset", "label"}
SECTION = {"html", "body", "div", "section", "article", "main", "table", "td", "tr", "tbody", "thead", "ul", "ol", "dl", "figure", "center", "details"} | DROP
BLOCK = SECTION | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "th", "hr", "address", "figcaption", "caption", "summary", "option", "legend", "hgroup", "search"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar", "tablist"}
# fixed words, as they stand in class and id names split at non-letters
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation",
         "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "header", "masthead", "topbar", "toolbar", "comment", "comments", "disqus",
         "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter",
         "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "pagination", "pager", "copyright", "skip", "disclaimer", "feedback", "paywall"}
# of these, names that layout wrappers have too; the others name what is in the element
LAYOUT = {"banner", "nav", "navbar", "navigation", "menu", "sidebar", "aside", "footer", "header", "masthead", "topbar", "toolbar", "notice", "notices", "notification",
          "alert", "modal", "overlay", "widget", "skip", "feedback", "paywall", "share", "sharing", "social", "promo", "promotion"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
PARTS = {"ul", "ol", "dl", "table", "tbody", "thead", "tr", "figure", "details"}     # sections that stand among paragraphs
NO_MARK, IN_LAYOUT, NAMED, DROPPED = range(4)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _mark(tag: str, attrs: list) -> int:
    """Whether the element is dropped, or only named like boilerplate or its layout."""
    if tag in DROP:
        return DROPPED
    mark = NO_MARK
    for k, v in attrs:
        if not v:
            if k in ("hidden",):
                return DROPPED
            continue
        if k == "role" and v.strip().lower() in ROLES:
            return DROPPED
        if k == "aria-hidden" and v.strip().lower() == "true":
            return DROPPED
        if k in ("class", "id") and tag not in ("html", "body", "article", "main"):
            names = {w.lower() for w in _WORD.findall(v)} & NAMES
            if names - LAYOUT:
                mark = NAMED
            elif names and tag not in HEADINGS:
                mark = max(mark, IN_LAYOUT)
        if k == "style" and "display:none" in v.replace(" ", "").lower():
            return DROPPED
    return mark


class _Lines(HTMLParser):
    """Parser events to lines: (text, tags, link characters, section)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.tags, self.linked = [], [], 0, 0
        self.stack: list[tuple[str, int]] = []           # open elements: (tag, section)
        self.sections = [(-1, "html", NO_MARK)]          # (parent, tag, mark)
        self.skip, self.links = 0, 0

    def updatepos(self, i, j):
        return j              # line numbers are not used

    def _section(self):
        return self.stack[-1][1] if self.stack else 0

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.tags, self.linked, self._section()))
            self.tags = 0
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.skip:       # a head that was never closed
            self.skip = 0
            self.stack = [x for x in self.stack if x[0] not in SKIP]
        if tag in SKIP:
            self.flush() if tag not in ("svg", "math") else None
            self.skip += 1
            self.stack.append((tag, self._section()))
            return
        if self.skip:
            return
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if tag in VOID:
            return
        section = self._section()
        bad = _mark(tag, attrs)
        if tag not in BLOCK and not bad:
            if tag == "a":
                self.links += 1
            return
        if bad and tag not in BLOCK:
            self.flush()
        if tag in SECTION or bad:
            self.sections.append((section, tag, bad))
            section = len(self.sections) - 1
        elif any(t == tag for t, _ in self.stack[-1:]):     # <p> or <li> closes the one before
            self.stack.pop()
            section = self._section()
        self.stack.append((tag, section))

    def handle_endtag(self, tag):
        if self.skip:
            if tag in SKIP and any(t == tag for t, _ in self.stack):
                while self.stack and self.stack[-1][0] != tag:
                    self.stack.pop()
                self.stack.pop()
                self.skip = sum(t in SKIP for t, _ in self.stack)
            return
        if tag == "a":
            self.links = max(0, self.links - 1)
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        # a block that only lies outside the section it is in closes nothing
        if at is not None and (tag in SECTION or not any(t in SECTION for t, _ in self.stack[at + 1:])):
            self.flush()
            del self.stack[at:]
        elif tag in BLOCK:
            self.flush()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in (SKIP | BLOCK):
            self.handle_endtag(tag)

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())


def _smooth(x: np.ndarray) -> np.ndarray:
    r = int(3 * SIGMA)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / SIGMA) ** 2)
    return np.convolve(x, k, "same")[:len(x)] / np.convolve(np.ones(len(x)), k, "same")[:len(x)] if len(x) > 2 * r else np.array(
        [np.dot(x, w) / w.sum() for w in np.exp(-0.5 * ((np.arange(len(x)) - np.arange(len(x))[:, None]) / SIGMA) ** 2)])


def _threshold(x: np.ndarray) -> float:
    """Mean of the centres of two clusters (two-means on the line)."""
    lo, hi = float(x.min()), float(x.max())
    for _ in range(20):
        cut = (lo + hi) / 2
        a, b = x[x <= cut], x[x > cut]
        if not len(b):
            break
        new = (float(a.mean()), float(b.mean()))
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2


def _cluster(lines: list, ids: list[int]) -> list[int]:
    """Those of the lines ``ids`` that are above the threshold."""
    ratio = np.array([(len(t) - linked) / max(1, tags) for t, tags, linked, _ in lines])
    smooth = _smooth(ratio)
    cut = _threshold(smooth[ids])
    return [i for i in ids if smooth[i] >= cut] or ids


def _boilerplate_lines(lines: list, sections: list) -> list[bool]:
    """Whether each line stands in an element that is no main text.

    Dropped elements are. A layout name counts if most of the element's text is
    links or outside the content cluster, and not for an article or main element
    inside it. Another name counts unless nearly all of the page's cluster that
    has no such name is in the element, and not for a main element inside it.
    """
    paths, dropped = [], []
    for k, (parent, _, mark) in enumerate(sections):
        paths.append([*(paths[parent] if k else []), k] if mark in (IN_LAYOUT, NAMED) else paths[parent] if k else [])
        if sections[k][1] == "main":
            paths[k] = []
        elif sections[k][1] == "article":
            paths[k] = [s for s in paths[k] if sections[s][2] == NAMED]
        dropped.append(mark == DROPPED or (k > 0 and dropped[parent]))
    out = [dropped[x[3]] for x in lines]
    rest = [i for i, x in enumerate(out) if not x]
    if not rest or not any(paths[lines[i][3]] for i in rest):
        return out
    cluster = set(_cluster(lines, rest))
    text, linked, content, free = {}, {}, {}, 0
    for i in rest:
        t, _, link, section = lines[i]
        for s in paths[section]:
            text[s] = text.get(s, 0) + len(t)
            linked[s] = linked.get(s, 0) + link
            content[s] = content.get(s, 0) + len(t) * (i in cluster)
        if i in cluster and not any(sections[s][2] == NAMED for s in paths[section]):
            free += len(t)
    whole = free + sum(content[s] for s in content if sections[s][2] == NAMED and not any(sections[p][2] == NAMED for p in paths[s] if p != s))
    inner = {s: 0 for s in content}      # the part of ``free`` in an element is not outside it
    for i in rest:
        if i in cluster and not any(sections[s][2] == NAMED for s in paths[lines[i][3]]):
            for s in paths[lines[i][3]]:
                inner[s] += len(lines[i][0])

    def bad(s: int) -> bool:
        if 2 * linked[s] >= text[s]:
            return True
        if sections[s][2] == IN_LAYOUT:
            return 2 * content[s] < text[s] and 2 * content[s] < whole
        return not content[s] or content[s] < 9 * (free - inner[s])

    verdict = {s: bad(s) for s in text}
    for i in rest:
        out[i] = any(verdict[s] for s in paths[lines[i][3]])
    return out


def main_text(html: str | None) -> str:
    """The page's main text: blocks of the content regions joined by two newlines."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines, sections = parser.lines, parser.sections
    boiler = _boilerplate_lines(lines, sections)
    good = [i for i, x in enumerate(boiler) if not x]
    if not good:
        return ""
    cluster = _cluster(lines, good)
    # text of the content cluster below each section
    mass: dict[int, int] = {}
    for i in cluster:
        s = lines[i][3]
        while s >= 0:
            mass[s] = mass.get(s, 0) + len(lines[i][0])
            s = sections[s][0]
    total = sum(len(lines[i][0]) for i in cluster)
    depth: dict[int, int] = {0: 0}
    for s in range(1, len(sections)):
        depth[s] = depth[sections[s][0]] + 1

    def up(s: int) -> list[int]:
        """The section and those around it."""
        out = []
        while s >= 0:
            out.append(s)
            s = sections[s][0]
        return out

    def widened(s: int) -> int:
        while sections[s][1] in PARTS and s:
            s = sections[s][0]
        around = [x for x in up(s) if sections[x][1] in ("article", "main")]
        return next((x for x in around if sections[x][1] == "article"), around[-1] if around else s)

    first = max((s for s in mass if mass[s] >= SHARE * total), key=lambda s: (depth[s], mass[s]))
    regions = {widened(first)}
    for i in cluster:
        if not regions.intersection(up(lines[i][3])):
            regions.add(widened(lines[i][3]))
    # sections that join the regions, up to the lowest one around all
    paths = [up(r) for r in regions]
    shared = set(paths[0]).intersection(*paths[1:])
    lowest = max(shared, key=lambda s: depth[s])
    joining = {s for p in paths for s in p if depth[s] >= depth[lowest]} - regions

    def stays(i: int) -> bool:
        text, _, linked, s = lines[i]
        while s >= 0 and s not in regions and sections[s][1] in PARTS:
            s = sections[s][0]
        inside = regions.intersection(up(s))
        if any(r and sections[r][1] != "body" for r in inside) or (inside and cluster[0] <= i <= cluster[-1]):
            return True
        return bool(inside or s in joining) and 2 * linked < len(text)

    return "\n\n".join(lines[i][0] for i in good if stays(i))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars of every page."""
    schema = ", ".join([f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep] + ["text string", "n_chars long"])

    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column(b.schema.get_field_index(html_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, html_col).mapInArrow(run, schema)
