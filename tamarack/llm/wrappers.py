"""Main text of web pages by inferred wrappers: union-free regular expressions over a host's token streams.

A page becomes a stream of block tags and text slots (inline markup belongs to the slot).  Repetitions in a stream are
folded into repeated groups.  The streams of a host are then aligned with each other, one after the other and in a tree
of tasks, until one expression is left: what only one side has becomes an optional group, repetitions on either side
become repeated groups, and texts that differ become slots.  Every page of a host takes part.

A page is matched to its host's expression, which is read as an automaton, and each of its slots is bound to a place of
the expression.  The wrapper tells, per place, where it stands (its open block elements), how many words it holds in the
host and whether it says the same on every page.  A page's main text is what is bound in the article: all slots inside
``article`` (else ``main``, else elements named like content, else the innermost element that holds most of the host's
words, those that vary from page to page where there are such), without those in menus, headers, footers, asides and
hidden elements.  What is only named like a sidebar, notice, advert or comment (and a form) is left out, however long it
is, where the article around it keeps words of its own besides headings, or where another element does that is an
article, main or named like content; where nothing does, if it holds no more than half of the host's words.  A name says
so by its last word (``post-comments``, but not ``has-comments`` or ``comments-open``), and an element that is also
named like content is content.

Defined cases: a null or empty html gives an empty text; a null url is the host ''; broken markup is read leniently
(an unclosed element ends with its parent); a null page_id is kept; repeated rows give repeated results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.staging import Stage

# HTML elements by what they do.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SILENT = set("script style template noscript iframe object svg math head title textarea select option button canvas audio video map".split())
RAW = set("script style textarea title noscript iframe template".split())  # their content is no markup, or isn't shown
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {  # an open element that such a start tag ends
    "p": BLOCKS - {"html", "body"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
}
ASIDE = {"nav", "footer", "aside", "menu", "dialog"}
FORMS = {"form", "fieldset"}  # may also hold a whole page
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Names of classes, ids and roles, as whole words.
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ad|ads|advert|adverts|advertisement|advertising|"
    r"sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|"
    r"subscription|signup|login|share|sharing|social|comment|comments|disqus|reply|replies|respond|related|recommended|breadcrumb|"
    r"breadcrumbs|pagination|pager|toolbar|widget|widgets|search|skip|copyright|contentinfo|complementary|search|dialog)(?:$|[\s_-])",
    re.IGNORECASE,
)
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|text|body|main)(?:$|[\s_-])", re.IGNORECASE)
OWN_HEADING = re.compile(r"\b(?:article|post|entry|story|content)[_-]header\b", re.IGNORECASE)
HEADING = re.compile(r"\b(?:header|masthead)\b", re.IGNORECASE)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
INSIDE = re.compile(r"/~?(?:article|main)(?:[./]|$)")
IN_ARTICLE = re.compile(r"/~?article(?:[./]|$)")
# A name that speaks of what an element has, or how it is set, not of what it is.
MODIFIER = re.compile(r"^(?:has|have|with|without|no|non|is|show|hide)[_-]|[_-](?:open|closed|enabled|disabled|left|right)$", re.IGNORECASE)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG = re.compile(r"""</?([a-zA-Z][-\w:]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?([a-zA-Z][-\w:]*)([^>]*)>""")
SPACES = re.compile(r"\s+")

ALIGNED = 3_000_000  # cells of a table; longer alignments are cut where a longest one passes


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _named(tag: str, attributes: str, inside: bool) -> tuple[str, bool, bool]:
    """(signature, hidden, named like something aside) of a start tag, which may stand inside an article or main element."""
    names, hidden = [], False
    if attributes and not attributes.isspace():
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                names.append(a or b or c)
            elif name == "hidden" or (name == "style" and HIDDEN.search(a or b or c)) or (name == "aria-hidden" and (a or b or c) == "true"):
                hidden = True
    text = " ".join(names)
    signature = tag + ("." + re.sub(r"[0-9/!~]+", "", text.lower()) if text else "")
    # A heading is never aside by its name, and an article's own heading is no page header.
    named = "" if tag in HEADINGS else (HEADING if inside else OWN_HEADING).sub(" ", text)
    said = [n for n in named.split() if not MODIFIER.search(n)]
    return signature, hidden, any(ASIDE_NAMES.search(n) for n in said) and not any(_like_content(n) for n in said)


def _like_content(name: str) -> bool:
    """Whether one class, id or role names content and nothing aside."""
    return bool(CONTENT_NAMES.search(name)) and not ASIDE_NAMES.search(name)


def _is_body(element: str) -> bool:
    """Whether an element of a path is an article, main or named like content."""
    tag, _, names = element.lstrip("~").partition(".")
    return tag in ("article", "main") or (tag != "body" and not element.startswith("~") and any(map(_like_content, names.split())))


def read_page(page: str) -> tuple[list[str], list[tuple[str, str]]]:
    """(tokens, slots): block tags and slots in page order, and per slot (path, text).

    A token is a start tag's signature, ``/`` and an end tag, or ``#`` and a slot's path.  A path joins the signatures
    of the open block elements by ``/``; an element that is aside by what it is has ``!`` before it, one that only its
    name (or a form) makes so has ``~``, which the host's statistics confirm or not.  An article or main element clears
    the ``~`` above it.
    """
    tokens: list[str] = []
    slots: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # (tag, path below it)
    text: list[str] = []
    silent = 0  # depth of inline elements whose text isn't shown
    remembered: dict[tuple[str, str, bool], tuple[str, bool, bool]] = {}

    def path() -> str:
        return stack[-1][1] if stack else ""

    def flush() -> None:
        if text:
            shown = SPACES.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if shown:
                tokens.append("#" + path())
                slots.append((path(), shown))

    def close(at: int) -> None:
        while len(stack) > at:
            tokens.append("/" + stack.pop()[0])

    position, size, has_comment_end = 0, len(page), True
    while position < size:
        start = page.find("<", position)
        if start < 0:
            start = size
        if start > position and not silent:
            text.append(page[position:start])
        if start == size:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4) if has_comment_end else -1
            has_comment_end = end >= 0
            position = end + 3 if end >= 0 else size
            continue
        following = page[start + 1 : start + 2]
        if following in ("!", "?"):
            end = page.find(">", start)
            position = end + 1 if end >= 0 else size
            continue
        found = TAG.match(page, start)
        if not found:
            if not silent:
                text.append("<")
            position = start + 1
            continue
        position = found.end()
        tag = (found[1] or found[3]).lower()
        attributes = found[2] if found[1] else found[4]
        if following != "/":
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, position)
                position = end.end() if end else size
                continue
            if tag in VOID and tag != "hr":
                if tag == "br" and not silent:
                    text.append(" ")
                continue
            if tag in SILENT and tag not in BLOCKS:
                if not attributes.endswith("/"):
                    silent += 1
                continue
            if tag not in BLOCKS:
                continue
            flush()
            # Start tags that end what is open: look no further than the innermost such element's container.
            for at in range(len(stack) - 1, -1, -1):
                open_tag = stack[at][0]
                ends = CLOSED_BY.get(open_tag)
                if ends and tag in ends:
                    close(at)
                    break
                if open_tag in ("div", "table", "ul", "ol", "dl", "section", "article", "main", "body", "blockquote"):
                    break
            if tag == "hr":
                continue
            above = path()
            inside = bool(INSIDE.search(above))
            key = (tag, attributes, inside)
            named = remembered.get(key)
            if named is None:
                named = remembered[key] = _named(tag, attributes, inside)
            signature, hidden, maybe = named
            mark = "!" if hidden or tag in ASIDE or (tag == "header" and not inside) else "~" if maybe or tag in FORMS else ""
            # An article or body that is only named like something aside is still read.
            if tag in ("html", "body", "article", "main"):
                mark = "!" if attributes and HIDDEN.search(attributes) else "~" if maybe and tag == "article" else ""
                if tag in ("article", "main") and not maybe and not IN_ARTICLE.search(above):
                    above = above.replace("/~", "/")
            tokens.append(signature)
            stack.append((tag, f"{above}/{mark}{signature}"))
        else:
            if tag in SILENT and tag not in BLOCKS:
                silent = max(0, silent - 1)
                continue
            if tag not in BLOCKS or tag == "hr":
                if tag == "br" and not silent:
                    text.append(" ")
                continue
            flush()
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
    flush()
    close(0)
    return tokens, slots


# An expression is a list of items: ["t", tag], ["s", path, text digest or "", words, pages], ["+", items], ["?", items].


def shape(item: list) -> str:
    """What an item looks like, without its statistics."""
    if item[0] in "ts":
        return item[0] + item[1]
    return item[0] + "(" + "\x1f".join(map(shape, item[1])) + ")"


def has_slot(items: list[list]) -> bool:
    return any(i[0] == "s" or (i[0] in "+?" and has_slot(i[1])) for i in items)


def united(a: list, b: list) -> list:
    """Two items of the same shape as one."""
    if a[0] == "t":
        return a
    if a[0] == "s":
        return ["s", a[1], a[2] if a[2] == b[2] else "", a[3] + b[3], a[4] + b[4]]
    return [a[0], [united(x, y) for x, y in zip(a[1], b[1], strict=True)]]


def varying(item: list) -> list:
    """An item of a repeated group: its texts are no labels."""
    if item[0] == "t":
        return item
    return ["s", item[1], "", item[3], item[4]] if item[0] == "s" else [item[0], [varying(x) for x in item[1]]]


def fold(items: list[list]) -> list[list]:
    """Immediate repetitions as repeated groups, short ones first."""
    keys = [shape(i) for i in items]
    codes, period = _codes(keys), 0
    while period := _next_period(codes, period):
        n = len(items)
        # How long, from each place, the stream goes on like it does one period later.
        run = _agreements(codes, period)
        out, i = [], 0
        while i < n:
            if i < len(run) and run[i] >= period and has_slot(items[i : i + period]):
                times = int(run[i]) // period + 1
                body = [varying(x) for x in items[i : i + period]]
                for k in range(1, times):
                    body = [united(x, varying(y)) for x, y in zip(body, items[i + k * period : i + (k + 1) * period], strict=True)]
                # A group that follows the same group joins it.
                if out and out[-1][0] == "+" and shape(out[-1]) == shape(["+", body]):
                    out[-1] = united(out[-1], ["+", body])
                else:
                    out.append(["+", body])
                i += times * period
            else:
                out.append(items[i])
                i += 1
        if len(out) < n:
            items, keys = out, [shape(x) for x in out]
            codes = _codes(keys)
    return items


def _agreements(codes: np.ndarray, period: int) -> np.ndarray:
    """From each place, how many items in a row equal the one a period later."""
    differ = np.flatnonzero(codes[period:] != codes[:-period])
    places = np.arange(len(codes) - period)
    ends = np.append(differ, len(places))
    return ends[np.searchsorted(ends, places)] - places


def _next_period(codes: np.ndarray, above: int) -> int:
    """The shortest period above ``above`` with which something is repeated at once; 0 without one.

    A repeated stretch of 2w to 4w items holds a window of w items that starts at a multiple of w and comes again one
    period later, so only distances between equal windows are tried; windows of doubled length are named by pairs.
    """
    n = len(codes)
    for period in range(above + 1, min(4, n // 2 + 1)):
        if (_agreements(codes, period) >= period).any():
            return period
    names, w = codes, 1
    while 4 * w <= n:
        # Names of windows of 2w items.
        names = np.unique(names[:-w] * np.int64(n + 1) + names[w:], return_inverse=True)[1]
        w *= 2
        if 4 * w - 1 <= above:
            continue
        order = np.argsort(names, kind="stable")
        start = np.arange(0, len(names), w)
        at = np.empty(len(names), np.int64)
        at[order] = np.arange(len(names))
        at, distances = at[start], []
        while len(start):
            at = at + 1
            inside = at < len(order)
            at, start = at[inside], start[inside]
            other = order[at]
            near = (names[other] == names[start]) & (other - start < 4 * w)
            at, start = at[near], start[near]
            distances.append(other[near] - start)
        found = np.unique(np.concatenate(distances))
        for period in found[(found >= 2 * w) & (found > above) & (2 * found <= n)]:
            if (_agreements(codes, int(period)) >= period).any():
                return int(period)
    return 0


def _codes(keys: list[str]) -> np.ndarray:
    """Equal numbers for equal keys."""
    numbers: dict[str, int] = {}
    return np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)


def expression(page: str) -> list[list]:
    """A page's own expression."""
    tokens, slots = read_page(page)
    at, items = 0, []
    for t in tokens:
        if t[0] == "#":
            path, text = slots[at]
            at += 1
            digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
            items.append(["s", path, digest, text.count(" ") + 1, 1])
        else:
            items.append(["t", t])
    return fold(items)


def _wrapped(items: list[list], groups: list[list]) -> list[list]:
    """Single occurrences of the bodies of groups, as such groups."""
    for group in groups:
        body = [shape(x) for x in group[1]]
        k, keys = len(body), [shape(x) for x in items]
        out, i = [], 0
        while i < len(items):
            if keys[i : i + k] == body:
                inner = items[i : i + k]
                out.append([group[0], [varying(x) for x in inner] if group[0] == "+" else inner])
                i += k
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def aligned(a: list[list], b: list[list]) -> list[list]:
    """One expression for two: common items meet, the others become optional."""
    groups = lambda x: [i for i in x if i[0] in "+?"]
    a, b = _wrapped(a, groups(b)), _wrapped(b, groups(a))
    x, y = [shape(i) for i in a], [shape(i) for i in b]
    if x == y:
        return [united(i, j) for i, j in zip(a, b, strict=True)]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    out = [united(i, j) for i, j in zip(a[:head], b[:head], strict=True)]
    p, q = a[head : len(a) - tail], b[head : len(b) - tail]
    out += _middle(p, q)
    out += [united(i, j) for i, j in zip(a[len(a) - tail :], b[len(b) - tail :], strict=True)]
    return fold(out)


def _optional(items: list[list]) -> list[list]:
    """A run that only one side has; what is optional already stays so."""
    out: list[list] = []
    run: list[list] = []
    for i in items:
        if i[0] == "?":
            out += [["?", run]] if run else []
            run = []
            out.append(i)
        else:
            run.append(i)
    return out + ([["?", run]] if run else [])


def _middle(p: list[list], q: list[list]) -> list[list]:
    """The longest common subsequence of shapes, with optional runs between."""
    out, i, j = [], 0, 0
    for k, m in [*_matched([shape(x) for x in p], [shape(x) for x in q]), (len(p), len(q))]:
        out += _optional(p[i:k]) + _optional(q[j:m])
        if k < len(p):
            out.append(united(p[k], q[m]))
        i, j = k + 1, m + 1
    return out


def _matched(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence, in linear memory (Hirschberg)."""
    n, m = len(x), len(y)
    if not n or not m:
        return []
    if n > 1 and n * m > ALIGNED:
        half = n // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return _matched(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in _matched(x[half:], y[cut:])]
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
    found, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return found


def _lengths(x: list[str], y: list[str]) -> np.ndarray:
    """How long a common subsequence x has with each beginning of y: a row of the table as bits of one number."""
    at: dict[str, int] = {}
    for j, c in enumerate(y):
        at[c] = at.get(c, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for c in x:
        same = row & at.get(c, 0)
        row = ((row + same) | (row - same)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def inferred(expressions: list[list[list]]) -> list[list]:
    """One expression for many: equal shapes first, then pairs, halving their number each time."""
    by_shape: dict[str, list[list]] = {}
    for e in expressions:
        key = "\x1f".join(map(shape, e))
        by_shape[key] = [united(i, j) for i, j in zip(by_shape[key], e, strict=True)] if key in by_shape else e
    # Shortest first, so that the regular pages come before the odd ones.
    left = [by_shape[k] for k in sorted(by_shape, key=lambda k: (len(k), k))]
    while len(left) > 1:
        left = [aligned(left[i], left[i + 1]) if i + 1 < len(left) else left[i] for i in range(0, len(left), 2)]
    return left[0] if left else []


class Wrapper:
    """A host's expression as an automaton over its items, and what it says about its slots."""

    def __init__(self, items: list[list], pages: int):
        self.pages = pages
        self.keys: list[str] = [""]  # per place of the expression: the token it takes; place 0 is before the first
        self.labels: list[str] = [""]  # the digest of a text that is the same on all pages
        self.slots: list[tuple[int, str, int]] = []  # (place, path, words)
        self.follow: list[dict[int, None]] = [{}]
        nullable, first, last = self._built(items, False)
        self.follow[0] = dict.fromkeys(first)
        self.ends = set(last) | ({0} if nullable else set())
        self.steps: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.sums = self._sums((path, n) for _, path, n in self.slots if "/!" not in path)
        self.keeps = self._keeps()
        self.stands: dict[str, int | None] = {}
        self.words: dict[str, int] = {}  # varying words by path, or all where none vary
        shown = [(path, n, self.labels[place]) for place, path, n in self.slots if not self._aside(path)]
        for path, n, label in shown:
            if not label or all(x[2] for x in shown):
                self.words[path] = self.words.get(path, 0) + n
        self.root: str | None = None

    def _built(self, items: list[list], repeated: bool) -> tuple[bool, list[int], list[int]]:
        """Adds the places of some items; (may be left out, first places, last places)."""
        nullable, first, last = True, [], []
        for i in items:
            if i[0] in "ts":
                place, skip = len(self.keys), False
                fixed = i[0] == "s" and i[2] and not repeated and i[4] >= self.pages > 1
                self.keys.append(i[0] + i[1])
                self.labels.append(i[2] if fixed else "")
                self.follow.append({})
                if i[0] == "s":
                    self.slots.append((place, i[1], i[3]))
                begin, end = [place], [place]
            else:
                skip, begin, end = self._built(i[1], repeated or i[0] == "+")
                if i[0] == "+":
                    for p in end:
                        self.follow[p].update(dict.fromkeys(begin))
                skip = skip or i[0] == "?"
            for p in last:
                self.follow[p].update(dict.fromkeys(begin))
            if nullable:
                first = first + begin
            last = last + end if skip else end
            nullable = nullable and skip
        return nullable, first, last

    @staticmethod
    def _sums(words: Iterable[tuple[str, int]]) -> dict[str, int]:
        """Words below each element."""
        sums: dict[str, int] = {}
        for path, n in words:
            parts = path.split("/")
            for k in range(1, len(parts) + 1):
                key = "/".join(parts[:k])
                sums[key] = sums.get(key, 0) + n
        return sums

    def _keeps(self) -> set[str]:
        """Articles, main elements and what is named like content that hold words, besides headings and what is only
        named aside; '' if there is any."""
        found: set[str] = set()
        for _, path, _ in self.slots:
            if "/!" in path or path.rpartition("/")[2].partition(".")[0] in HEADINGS:
                continue
            end = len(path)
            while end > 0:
                start = path.rfind("/", 0, end)
                element = path[start + 1 : end]
                if _is_body(element):
                    found.add(path[:end])
                    if "/~" not in path[: start + 1] and not element.startswith("~"):
                        found.add("")
                if element.startswith("~"):
                    break
                end = start
        return found

    def _aside(self, path: str) -> bool:
        """Whether a path is aside: by an element that is, or by one so named that the text can do without."""
        if "/!" in path:
            return True
        at = path.find("/~")
        while at >= 0:
            end = path.find("/", at + 1)
            element = path if end < 0 else path[:end]
            around, start = "", at
            while start > 0 and not around:
                before = path.rfind("/", 0, start)
                around = path[:start] if _is_body(path[before + 1 : start]) else ""
                start = before
            if around in self.keeps or (not around and self.sums.get("", 0) >= 2 * self.sums.get(element, 0)):
                return True
            at = path.find("/~", at + 1)
        return False

    def container(self) -> str:
        """The innermost element that holds most of the varying words."""
        total, best = sum(self.words.values()), ""
        sums = self._sums(self.words.items())
        for key in sorted(sums, key=lambda k: k.count("/")):
            tag = key.rpartition("/")[2].partition(".")[0]
            if 2 * sums[key] > total and key.startswith(best) and tag not in ("p", "li", "h1", "h2", "h3", "td", "tr"):
                best = key
        return best

    def bound(self, tokens: list[str]) -> list[int] | None:
        """The place of the expression that each of a page's tokens is bound to; None if the page doesn't match.

        Of several ways the one that goes on with a group, and takes an optional one, comes first.
        """
        states, trail = (0,), []
        for t in tokens:
            key = "s" + t[1:] if t[0] == "#" else "t" + t
            step = self.steps.get((states, key))
            if step is None:
                found: dict[int, int] = {}
                for k, p in enumerate(states):
                    for q in self.follow[p]:
                        if self.keys[q] == key and q not in found:
                            found[q] = k
                if len(self.steps) >= 100_000:
                    self.steps.clear()
                step = self.steps[states, key] = (tuple(found), tuple(found.values()))
            if not step[0]:
                return None
            trail.append(step)
            states = step[0]
        at = next((k for k, p in enumerate(states) if p in self.ends), None)
        if at is None:
            return None
        places = []
        for here, back in reversed(trail):
            places.append(here[at])
            at = back[at]
        return places[::-1]

    def _stands(self, path: str) -> int | None:
        """Where a slot stands: in an article 0, main 1, something named like content 2, elsewhere 3; aside None."""
        if path not in self.stands:
            if self._aside(path):
                stands = None
            elif IN_ARTICLE.search(path):
                stands = 0
            elif re.search(r"/~?main(?:[./]|$)|\.(?:[^/]*\s)?main(?:[\s/]|$)", path):
                stands = 1
            else:
                stands = 2 if any(CONTENT_NAMES.search(s.partition(".")[2]) for s in path.split("/") if "." in s) else 3
            self.stands[path] = stands
        return self.stands[path]

    def article(self, page: str) -> str:
        """A page's main text: its blocks, joined by line breaks."""
        tokens, slots = read_page(page)
        places = self.bound(tokens)
        bound = [self.keys[p][1:] for p in places if self.keys[p][0] == "s"] if places is not None else [p for p, _ in slots]
        shown = [(self._stands(p), p, t) for p, (_, t) in zip(bound, slots, strict=True)]
        at = min((s for s, *_ in shown if s is not None), default=3)
        chosen = [(p, t) for s, p, t in shown if s == at]
        if at == 3:
            if self.root is None:
                self.root = self.container()
            chosen = [x for x in chosen if x[0].startswith(self.root)] or chosen
        return "\n".join(t for _, t in chosen)


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper, pages): one expression per host, as JSON, from all its pages."""

    def of_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, list] = {}
            for url, page in zip(batch["url"], batch["html"], strict=True):
                found.setdefault(host_of(url), []).append(expression(page))
            yield pd.DataFrame(
                [(h, json.dumps(inferred(e)), len(e), i) for i, (h, e) in enumerate(found.items())], columns=["host", "wrapper", "pages", "part"]
            )

    def of_parts(parts: pd.DataFrame) -> pd.DataFrame:
        ordered = parts.sort_values(["wrapper", "pages"])
        merged = inferred([json.loads(w) for w in ordered["wrapper"]])
        return pd.DataFrame({"host": parts["host"].iloc[:1], "wrapper": [json.dumps(merged)], "pages": [int(parts["pages"].sum())], "part": [0]})

    schema = "host string, wrapper string, pages long, part int"
    level = pages.select("url", F.coalesce("html", F.lit("")).alias("html")).mapInPandas(of_pages, schema)
    # A tree: a host's parts meet in up to 64 groups first, then in one.
    for groups in (64, 1):
        level = level.withColumn("part", F.pmod(F.xxhash64("wrapper", "pages"), F.lit(groups)).cast("int"))
        level = level.groupBy("host", "part").applyInPandas(of_parts, schema)
    return level.select("host", "wrapper", "pages")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    wrappers = Stage(infer(pages), "wrappers").df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            out = []
            for w, n, page in zip(batch["wrapper"], batch["pages"], batch["html"], strict=True):
                key = w or ""
                if key not in known:
                    if len(known) >= 1_000:
                        known.clear()
                    known[key] = Wrapper(json.loads(w) if w else [], int(n) if w else 0)
                out.append(known[key].article(page))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out})

    keyed = _with_host(pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")))
    joined = keyed.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper", "pages")
    return joined.mapInPandas(run, "page_id string, url string, text string").withColumn("page_id", F.col("page_id").cast("long"))


def _with_host(pages: DataFrame) -> DataFrame:
    """The pages with their host, by the same rule as when wrappers are inferred."""

    @F.pandas_udf("string")
    def named(urls: pd.Series) -> pd.Series:
        return urls.map(host_of)

    return pages.withColumn("host", named(F.coalesce("url", F.lit(""))))


def op3(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
