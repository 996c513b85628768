"""Main text of web pages by union-free wrappers, inferred for each host from its pages.

Pages are token streams: opening and closing block tags with their classes, and text. ``infer`` aligns the streams of one
layout of a host two by two. Where they agree a tag stays; where they do not, the odd one becomes an optional group, a run of like
groups becomes one repeated group, a sequence of siblings that comes again and again becomes a repeated group of them, and
texts become slots. The result is a regular expression without alternatives, the wrapper.
Pages of a host have one layout if their containers that may hold main text are nested alike (``layout``).

``Slots`` numbers the slots of a wrapper by their position in it, and matches a page's groups against the wrapper in order:
so each text of a page has a slot, also where two slots lie under the same tags. Groups are classified: kinds that the tag or a class
names as navigation, advert, form, comment and so on are left out with all inside; of the others the main region is an article or main
group, or else the group that holds most of the layout's text. A text that stands in one slot on at least ``CONSTANT`` distinct pages,
and on most distinct pages of the layout, belongs to the template and is left out; so a boilerplate paragraph is told apart
from its neighbours in a repeated group. A class that only contains such a word does not bar a group with most of the text.
``extract`` reads a page again and keeps the other texts of the region. A page without text in its layout's region, or of no
known host, is classified alone.

For scale the streams are first reduced to their shapes, that is with runs collapsed and texts blanked; a layout has few distinct
shapes. They are merged in groups of at most about ``FAN``, level by level, until a layout has one wrapper. Statistics of slots
and of their texts are DataFrame aggregates; only a layout's slots and template texts come together.

Cases: a null or empty html gives an empty text; pages with a null or odd url share no template and are read each alone; a page without
tags is text outside any group and is kept whole; tags left open are closed at the end; equal pages count as one for
the template and give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read, stored

FAN = 32
#: Distinct pages on which a slot must have the same text to belong to the template, if they are most of the layout's.
CONSTANT = 5
#: Levels of nesting that a wrapper tells apart.
DEEP = 60
#: Longest sequence of different siblings that is looked for as a repeated one, and what its group's name starts with.
PERIOD = 6
SEQUENCE = "+"
#: Pairs of siblings up to which the best alignment of two lists is looked for, and how far a name is looked for beyond.
TABLE = 250_000
NEAR = 64

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

# Fixed values of HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "ruby", "rb", "rp", "rt", "rtc", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPE = {"ul", "ol", "dl", "table", "article", "section", "main", "aside", "nav", "div", "body", "html"}

#: Tags whose groups are not main text.
OUT_TAGS = {
    "nav", "header", "footer", "aside", "form", "button", "select", "input", "dialog", "menu", "head", "fieldset", "datalist", "output", "progress", "meter",
}
#: Words in a class, id or role that name such groups.
OUT_WORDS = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toc", "sidebar", "side", "aside", "widget", "widgets", "complementary",
    "related", "recommended", "recommendations", "share", "sharing", "social", "comment", "comments", "commentlist", "respond", "replies", "reply", "disqus",
    "footer", "header", "masthead", "contentinfo", "login", "search", "pagination", "pager", "toolbar", "skip", "dialog", "hidden", "copyright", "disclaimer", "tags",
}
#: Those that stay out however much text they hold.
REPLY_WORDS = {"comment", "comments", "commentlist", "respond", "replies", "reply", "disqus"}
IN_TAGS = {"article", "main"}
IN_WORDS = {"article", "main", "content", "post", "entry", "story", "articlebody", "main-content", "post-content", "entry-content", "article-body"}


def group_name(tag: str, attributes: str) -> str:
    """A tag with its classes, id and role; numbers in them are blanked, for they number single groups."""
    if not attributes or not attributes.strip(" /"):
        return tag
    kinds = []
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role"):
            kinds += re.sub(r"\d+", "0", value.lower()).split()
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            kinds.append("hidden")
    return ".".join([tag, *sorted(set(kinds))])


def out_strength(name: str, inside: bool) -> int:
    """If a group is by its name no main text: 2 by its tag, a whole class or a word for comments, 1 by a word within a class, else 0.

    The header of an article is part of it, unless a class says otherwise.
    """
    tag, *kinds = name.split(".")
    if tag in OUT_TAGS and not (tag == "header" and inside):
        return 2
    if tag in ("html", "body"):
        return 0
    kinds = [k for k in kinds if k not in IN_WORDS]
    if any(k in OUT_WORDS for k in kinds):
        return 2
    words = {w for k in kinds for w in re.split(r"[-_]+", k)} & OUT_WORDS
    return 2 if words & REPLY_WORDS else 1 if words else 0


def out_of_text(name: str, inside: bool) -> bool:
    return out_strength(name, inside) > 0


def into_text(name: str) -> bool:
    tag, *kinds = name.split(".")
    return tag in IN_TAGS or tag in ("div", "section", "td") and any(k in IN_WORDS for k in kinds)


def tokens(page: str | None) -> Iterator[tuple[str, str]]:
    """("open", group), ("close", tag), ("break", ""), ("text", raw): texts of raw elements are skipped, inline tags are no tokens."""
    if not page:
        return
    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        m = TOKEN.match(page, lt)
        if m is None:  # a bare "<" is text
            nxt = page.find("<", lt + 1)
            nxt = end if nxt < 0 else nxt
            yield "text", page[at:nxt]
            at = nxt
            continue
        if lt > at:
            yield "text", page[at:lt]
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if closing:
            if tag not in INLINE or tag in ("span", "label"):
                yield "close", tag
        elif tag in VOID:
            if tag in ("br", "hr"):
                yield "break", ""
        elif tag in RAW:
            if not attributes.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
        elif tag in INLINE:
            name = group_name(tag, attributes) if tag in ("span", "label") and attributes else tag
            if "." in name and out_of_text(name, True):
                yield "open", name
            elif tag in ("span", "label"):
                yield "inline", tag
        elif attributes.rstrip().endswith("/") and tag in ("path", "use"):
            continue
        else:
            yield "open", group_name(tag, attributes)


def texts(page: str | None) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path of groups, text, block number) of each text; paths always start at the page itself."""
    path: list[str] = []
    block = 0
    for kind, value in tokens(page):
        if kind == "text":
            if value and not value.isspace():
                yield tuple(path), value, block
            elif value:
                yield tuple(path), " ", block
        elif kind == "break":
            block += 1
        elif kind == "inline":
            path.append(f"~{value}")
        elif kind == "open":
            tag = value.split(".")[0]
            if tag == "span" or tag == "label":
                path.append(value)
                continue
            block += 1
            shut = CLOSES.get(tag)
            if shut:
                for k in range(len(path) - 1, -1, -1):
                    t = path[k].split(".")[0]
                    if t in shut:
                        del path[k:]
                        break
                    if t in SCOPE:
                        break
            for k in range(len(path) - 1, -1, -1):  # a block ends an open paragraph
                if path[k].split(".")[0] == "p":
                    del path[k:]
                    break
                if path[k][0] != "~":
                    break
            path.append(value)
        else:
            inline = value in ("span", "label")
            block += not inline
            for k in range(len(path) - 1, -1, -1):
                t = path[k].lstrip("~").split(".")[0]
                if t == value:
                    del path[k:]
                    break
                if inline and path[k][0] != "~" and t not in ("span", "label"):
                    break


def slots(page: str | None) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """``texts`` with plain inline groups left out of the paths.

    Groups nested deeper than ``DEEP`` count as part of that group; the first of them that is by its name no main text stays, so its
    texts are still told apart. All texts stay.
    """
    for path, text, block in texts(page):
        path = tuple(x for x in path if x[0] != "~")
        if len(path) > DEEP:
            path = path[:DEEP] + next(((x,) for x in path[DEEP:] if out_of_text(x, True)), ())
        yield path, text, block


# A wrapper is a list of groups [name, repeated, optional, groups]; the name "#" is a text slot.


def tree(page: str | None) -> list:
    """The page's groups in order; a slot "#" holds its (text, block number) instead of groups."""
    root: list = []
    last: tuple[str, ...] = ()
    stack: list[list] = [root]
    seen_block = -1
    for path, text, block in slots(page):
        n = 0
        while n < min(len(path), len(last)) and path[n] == last[n] and (n + 1 < len(path) or block == seen_block or path != last):
            n += 1
        del stack[n + 1 :]
        for name in path[n:]:
            group = [name, False, False, []]
            stack[-1].append(group)
            stack.append(group[3])
        if not stack[-1] or stack[-1][-1][0] != "#":
            stack[-1].append(["#", False, False, []])
        stack[-1][-1][3].append((text, block))
        last, seen_block = path, block
    return root


def shape(page: str | None) -> list:
    """The page as a wrapper of its own: runs of like groups collapsed, texts blanked."""
    return collapse(blank(tree(page)), page=True)


def blank(groups: list) -> list:
    return [[name, repeated, optional, [] if name == "#" else blank(inner)] for name, repeated, optional, inner in groups]


def periods(names: list[str]) -> Iterator[tuple[int, int, int]]:
    """Cuts a list of names, no two neighbours alike, into (start, length, times): sequences that follow each other at least twice, else single names."""
    i, n = 0, len(names)
    while i < n:
        for d in range(2, PERIOD + 1):
            m = i
            while m + d < n and names[m] == names[m + d]:
                m += 1
            if m - i >= d:
                times = (m - i) // d + 1
                yield i, d, times
                i += d * times
                break
        else:
            yield i, 1, 1
            i += 1


def folded(groups: list) -> list:
    """Siblings with sequences that come again put into groups of their own, named by the sequence after ``SEQUENCE``."""
    if len(groups) < 4:
        return groups
    runs: list[list] = []
    for g in groups:
        if runs and runs[-1][0][0] == g[0]:
            runs[-1].append(g)
        else:
            runs.append([g])
    if len(runs) < 4:
        return groups
    out: list = []
    for start, d, times in periods([r[0][0] for r in runs]):
        if d == 1:
            out += runs[start]
            continue
        name = SEQUENCE + " ".join(r[0][0] for r in runs[start : start + d])
        for k in range(times):
            out.append([name, False, False, [g for r in runs[start + k * d : start + (k + 1) * d] for g in r]])
    return out


def collapse(groups: list, page: bool = False) -> list:
    """Runs of groups with one name become a repeated group; a run's members are aligned with each other.

    Sequences are looked for in a ``page`` only, and by ``match`` in the same way: so each page's groups occur in its wrapper.
    """
    out: list = []
    for name, repeated, optional, inner in folded(groups) if page else groups:
        inner = collapse(inner, page)
        if out and out[-1][0] == name:
            a = out[-1]
            out[-1] = [name, name != "#", a[2] and optional, align(a[3], inner)]
        else:
            out.append([name, repeated, optional, inner])
    return out


def in_order(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of like names in ascending order: the most there are, or for lists beyond ``TABLE`` each name's next place."""
    n, m = len(a), len(b)
    pairs, i, j = [], 0, 0
    if n * m > TABLE:
        places: dict[str, list[int]] = {}
        for k, name in enumerate(b):
            places.setdefault(name, []).append(k)
        for i, name in enumerate(a):
            own = places.get(name, [])
            k = bisect.bisect_left(own, j)
            if k < len(own) and own[k] - j <= i - (pairs[-1][0] if pairs else -1) + NEAR:
                pairs.append((i, own[k]))
                j = own[k] + 1
        return pairs
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n and j < m:
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: list, b: list) -> list:
    """The two lists of groups as one: like groups in order are matched, all others are optional."""
    if a == b:
        return a
    out, i, j = [], 0, 0
    for x, y in [*in_order([g[0] for g in a], [g[0] for g in b]), (len(a), len(b))]:
        out += [[g[0], g[1], True, g[3]] for g in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append([a[x][0], a[x][1] or b[y][1], a[x][2] or b[y][2], align(a[x][3], b[y][3])])
        i, j = x + 1, y + 1
    return collapse(out)


def infer(wrappers: list[list]) -> list:
    """One wrapper for several, aligned one after another from the longest on."""
    ordered = sorted(wrappers, key=lambda w: (-len(json.dumps(w)), json.dumps(w)))
    out = ordered[0]
    for w in ordered[1:]:
        out = align(out, w)
    return out


def expression(wrapper: list) -> str:
    """The wrapper as text: ``(...)+`` repeats, ``(...)?`` is optional, ``#`` is a text slot."""
    parts = []
    for name, repeated, optional, inner in wrapper:
        x = "#" if name == "#" else f"<{name}>{expression(inner)}</>"
        parts.append(f"({x}){'*' if repeated and optional else '+' if repeated else '?'}" if repeated or optional else x)
    return "".join(parts)


def paths(wrapper: list, above: tuple = ()) -> Iterator[tuple[str, ...]]:
    """The paths of all slots."""
    for name, _, _, inner in wrapper:
        if name == "#":
            yield above
        else:
            yield from paths(inner, above if name[0] == SEQUENCE else (*above, name))


def barred(p: tuple[str, ...], heavy: frozenset = frozenset(), least: int = 1) -> bool:
    """If a group on the path is no main text by a name of strength ``least`` or more; ``heavy`` groups are not judged by weak names."""
    for k, x in enumerate(p):
        strength = out_strength(x, any(into_text(y) for y in p[:k]))
        if strength >= max(least, 2 if p[: k + 1] in heavy else 1):
            return True
    return False


def heavy_groups(known: dict, mass: dict) -> frozenset:
    """Groups that hold more than half of the text outside strongly barred groups: a word in their class does not make them an advert."""
    weight: dict[tuple[str, ...], int] = {}
    total = 0
    for s, path in known.items():
        n = mass.get(s, 0)
        if n and not barred(path, least=2):
            total += n
            for k in range(1, len(path) + 1):
                weight[path[:k]] = weight.get(path[:k], 0) + n
    return frozenset(p for p, n in weight.items() if 2 * n > total)


def region_of(known: dict, mass: dict) -> list:
    """Of slots with their paths those of the main region; ``mass`` has the characters of each."""
    heavy = heavy_groups(known, mass)
    left = [s for s in sorted(known) if not barred(known[s], heavy)]
    for wanted in (lambda x: x.split(".")[0] == "article", lambda x: x.split(".")[0] == "main", into_text):
        region = [s for s in left if any(wanted(x) for x in known[s])]
        if region:
            return region
    # The deepest group that holds most of the text.
    region, depth = left, 0
    while region:
        total = sum(mass.get(s, 0) for s in region)
        below: dict[tuple[str, ...], int] = {}
        for s in region:
            if len(known[s]) > depth:
                top = known[s][: depth + 1]
                below[top] = below.get(top, 0) + mass.get(s, 0)
        top = max(below, key=lambda x: (below[x], x), default=None)
        if top is None or below[top] < 0.7 * total or top[-1].split(".")[0] in ("p", "h1", "li", "td", "tr", "blockquote", "pre"):
            break
        region, depth = [s for s in region if known[s][: depth + 1] == top], depth + 1
    return region


def main_paths(wrapper: list, stats: dict[tuple[str, ...], tuple[int, int, bool]], pages: int) -> list[tuple[str, ...]]:
    """Paths of the slots with main text. ``stats``: per path its pages, characters, and if its text is always the same."""
    region = region_of({p: p for p in paths(wrapper)}, {p: c for p, (_, c, _) in stats.items()})
    free = [p for p in region if not (stats.get(p, (0, 0, False))[2] and stats[p][0] >= CONSTANT and 2 * stats[p][0] > pages)]
    return free if sum(stats.get(p, (0, 0, False))[1] for p in free) * 2 > sum(stats.get(p, (0, 0, False))[1] for p in region) else region


#: Groups that lay a page out, and how many of them below the body tell layouts apart.
CONTAINERS = {"html", "body", "div", "section", "main", "article"}
LEVELS = 3


def layout(wrapper: list) -> str:
    """How the containers of a shape that may hold main text are nested, down to the first that is named as such."""
    found = set()

    def walk(groups: list, above: tuple[str, ...], depth: int) -> None:
        for name, _, _, inner in groups:
            tag, *kinds = name.split(".")
            if tag not in CONTAINERS or out_of_text(name, False):
                continue
            here = above if tag in ("html", "body") else (*above, ".".join([tag, *(k for k in kinds if k in IN_WORDS)]))
            if here != above:
                found.add("/".join(here))
            if not into_text(name) and depth < LEVELS:
                walk(inner, here, depth + (here != above))

    walk(wrapper, (), 0)
    return " ".join(sorted(found))


class Slots:
    """A wrapper whose slots are numbered by their position in it; ``path`` has the path of each."""

    def __init__(self, wrapper: list):
        self.path: dict[int, tuple[str, ...]] = {}
        self.top = self.numbered(wrapper, ())
        self.out = {s for s, p in self.path.items() if barred(p, least=2)}

    def numbered(self, wrapper: list, above: tuple[str, ...]) -> list:
        out = []
        for name, _, _, inner in wrapper:
            if name == "#":
                self.path[len(self.path)] = above
                out.append((name, len(self.path) - 1))
            else:
                out.append((name, self.numbered(inner, above if name[0] == SEQUENCE else (*above, name))))
        return out

    def match(self, groups: list) -> Iterator[tuple[int, list]]:
        """(slot, texts) of each slot of a page's groups in order; -1 where the wrapper has none."""
        return ((slot, texts) for slot, texts, _ in self.located(groups))

    def located(self, groups: list) -> Iterator[tuple[int, list, tuple[str, ...]]]:
        """``match`` with the path of each slot."""
        memo: dict = {}

        def choose(groups: list, nodes: list) -> tuple[int, list]:
            """The most slots that groups and nodes match in order, and each run of like groups with its node."""
            key = id(groups), id(nodes)
            if key in memo:
                return memo[key][:2]
            runs: list = []
            whole = folded(groups)
            for g in whole:
                if runs and runs[-1][0][0] == g[0]:
                    runs[-1].append(g)
                else:
                    runs.append([g])
            at = {name: k for k, (name, _) in enumerate(nodes)}
            own = [at.get(r[0][0]) for r in runs]
            if len(at) == len(nodes) and None not in own and all(x < y for x, y in zip(own, own[1:])):
                pairs = [(r, nodes[k]) for r, k in zip(runs, own)]
            elif len(runs) * len(nodes) > TABLE:
                met = dict(in_order([r[0][0] for r in runs], [name for name, _ in nodes]))
                pairs = [(r, nodes[met[i]] if i in met else None) for i, r in enumerate(runs)]
            else:
                pairs = best_pairs(runs, nodes)
            # what was made here is kept, for its identity is a key
            memo[key] = sum(score(r, node) for r, node in pairs if node is not None), pairs, whole
            return memo[key][:2]

        def best_pairs(runs: list, nodes: list) -> list:
            n, m = len(runs), len(nodes)
            best = [[0] * (m + 1) for _ in range(n + 1)]
            hit: dict = {}
            for i in range(n - 1, -1, -1):
                for j in range(m - 1, -1, -1):
                    best[i][j] = max(best[i + 1][j], best[i][j + 1])
                    if runs[i][0][0] == nodes[j][0]:
                        hit[i, j] = score(runs[i], nodes[j])
                        best[i][j] = max(best[i][j], best[i + 1][j + 1] + hit[i, j])
            out, i, j = [], 0, 0
            while i < n:
                if j < m and hit.get((i, j), 0) and best[i][j] == best[i + 1][j + 1] + hit[i, j]:
                    out.append((runs[i], nodes[j]))
                    i, j = i + 1, j + 1
                elif j < m and best[i][j] == best[i][j + 1]:
                    j += 1
                else:
                    out.append((runs[i], None))
                    i += 1
            return out

        def score(run: list, node: tuple) -> int:
            return len(run) if node[0] == "#" else sum(choose(g[3], node[1])[0] for g in run)

        def place(groups: list, nodes: list, path: tuple) -> Iterator[tuple[int, list, tuple]]:
            for run, node in choose(groups, nodes)[1]:
                for g in run:
                    if g[0] == "#":
                        yield -1 if node is None else node[1], g[3], path
                    else:
                        yield from place(g[3], nothing if node is None else node[1], path if g[0][0] == SEQUENCE else (*path, g[0]))

        nothing: list = []
        yield from place(groups, self.top, ())


def host_of(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


def joined(found: Iterator[tuple[str, int]]) -> str:
    """Texts with their blocks as one: references decoded, white space in a block one space, blocks joined by one space."""
    parts: list[str] = []
    last = None
    for text, block in found:
        if block != last:
            parts.append(" ")
        parts.append(text)
        last = block
    return " ".join(entities.unescape("".join(parts)).split())


def main_text(page: str | None, kept: set[tuple[str, ...]]) -> str:
    """The texts of the slots under kept paths."""
    return joined((text, block) for path, text, block in slots(page) if path in kept)


def alone(page: str | None) -> str:
    """The main text of a page that is classified by itself."""
    mass: dict = {}
    for path, text, _ in slots(page):
        mass[path] = mass.get(path, 0) + len(" ".join(text.split()))
    return main_text(page, set(main_paths(shape(page), {p: (1, c, False) for p, c in mass.items()}, 1)))


def digest(text: str) -> int:
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


def slot_text(texts: list[tuple[str, int]]) -> str:
    return " ".join("".join(t for t, _ in texts).split())


def read_page(page: str | None, known: Slots | None, kept: set[int], template: set[tuple[int, int]]) -> str:
    """The page's texts in kept slots without the template's, or what ``alone`` gives if those slots have no text here.

    A text that the wrapper has no slot for goes by its path.
    """
    if known is not None:
        places = {known.path[s] for s in kept}
        region = [(slot, texts) for slot, texts, path in known.located(tree(page)) if slot in kept or slot < 0 and path in places]
        if any(slot_text(texts) for _, texts in region):
            return joined(x for slot, texts in region if not template or (slot, digest(slot_text(texts))) not in template for x in texts)
    return alone(page)


def layout_key(url: str | None, wrapper: list) -> int | None:
    """One number for a host and layout; none for a page without a host."""
    host = host_of(url)
    return digest(f"{host}\n{layout(wrapper)}") if host else None


def with_layout(pages: DataFrame) -> DataFrame:
    """Adds the number of the page's layout (null without a host) and its shape as JSON."""

    @F.pandas_udf("layout long, shape string")
    def read_shape(url: pd.Series, page: pd.Series) -> pd.DataFrame:
        rows = []
        for u, p in zip(url, page):
            w = shape(p) if host_of(u) else None
            rows.append((None, None) if w is None else (layout_key(u, w), json.dumps(w, separators=(",", ":"))))
        return pd.DataFrame({"layout": pd.array([r[0] for r in rows], "Int64"), "shape": [r[1] for r in rows]})

    found = pages.withColumn("_found", read_shape("url", "html"))
    return found.select(*pages.columns, F.col("_found.layout").alias("_layout"), F.col("_found.shape").alias("_shape"))


def survey(pages: DataFrame) -> DataFrame:
    """Rows (layout, wrapper, pages): the distinct shapes of each layout of a host, from pages ``with_layout``."""
    rows = pages.where("_layout is not null").groupBy(F.col("_layout").alias("layout"), F.col("_shape").alias("wrapper"))
    return rows.agg(F.count("*").alias("pages"))


def wrappers(pages: DataFrame) -> DataFrame:
    """Rows (layout, pages, wrapper): one wrapper as JSON for each layout of a host."""
    merged = stored(survey(pages))

    def join(d: pd.DataFrame) -> pd.DataFrame:
        w = infer([json.loads(x) for x in d["wrapper"]])
        return pd.DataFrame({"layout": [d["layout"].iloc[0]], "wrapper": [json.dumps(w, separators=(",", ":"))], "pages": [d["pages"].sum()]})

    while True:
        most = merged.groupBy("layout").count().agg(F.max("count")).first()[0] or 0
        merged = stored(merged.groupBy("layout", F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // FAN) or 1)).alias("part")).applyInPandas(
            lambda key, d: join(d), "layout long, wrapper string, pages long"))
        if most <= FAN:
            return merged


def text_counts(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (layout, slot, text, pages, chars): on how many distinct pages of a layout each text stands in each slot; slot -1 has the layout's pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}
        for b in batches:
            rows = []
            for key, page, wrapper in zip(b["_layout"], b["html"], b["wrapper"]):
                if wrapper not in memo:
                    memo[wrapper] = Slots(json.loads(wrapper))
                    while len(memo) > 1000:
                        del memo[next(iter(memo))]
                slots_of, own = memo[wrapper], digest(page or "")
                rows.append((key, -1, 0, own, 0))
                seen: dict = {}
                for slot, texts in slots_of.match(tree(page)):
                    if slot >= 0 and slot not in slots_of.out and (text := slot_text(texts)):
                        at = slot, digest(text)
                        seen[at] = seen.get(at, 0) + len(text)
                rows += [(key, *at, own, n) for at, n in seen.items()]
            yield pd.DataFrame(rows, columns=["layout", "slot", "text", "page", "chars"])

    rows = pages.select("_layout", "html").where("_layout is not null").join(known.select(F.col("layout").alias("_layout"), "wrapper"), "_layout")
    found = rows.select("_layout", "html", "wrapper").mapInPandas(run, "layout long, slot int, text long, page long, chars long")
    return found.groupBy("layout", "slot", "text").agg(F.count_distinct("page").alias("pages"), F.sum("chars").alias("chars"))


def classified(pages: DataFrame) -> DataFrame:
    """Rows (layout, wrapper, kept, template): the slots of the main region, and the slot and digest of each template text in it."""
    known = wrappers(pages)
    counts = stored(text_counts(pages, known))
    size = counts.where("slot = -1").select("layout", F.col("pages").alias("all"))
    often = counts.where((F.col("slot") >= 0) & (F.col("pages") >= CONSTANT)).join(size, "layout").where("2 * pages > all")
    mass = counts.where("slot >= 0").groupBy("layout", "slot").agg(F.sum("chars").alias("chars"))
    mass = mass.groupBy("layout").agg(F.collect_list(F.struct("slot", "chars")).alias("mass"))
    often = often.groupBy("layout").agg(F.collect_list(F.struct("slot", "text", "chars")).alias("often"))

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, wrapper, mass, often in zip(b["layout"], b["wrapper"], b["mass"], b["often"]):
                chars = {} if mass is None else {x["slot"]: x["chars"] for x in mass}
                kept = region_of(Slots(json.loads(wrapper)).path, chars)
                own = [] if often is None else [x for x in often if x["slot"] in set(kept)]
                if 2 * sum(x["chars"] for x in own) >= sum(chars.get(s, 0) for s in kept):
                    own = []  # a template that is most of the text is no template
                rows.append((key, wrapper, kept, [{"slot": x["slot"], "text": x["text"]} for x in own]))
            yield pd.DataFrame(rows, columns=["layout", "wrapper", "kept", "template"])

    rows = known.select("layout", "wrapper").join(mass, "layout", "left").join(often, "layout", "left")
    return rows.mapInPandas(classify, "layout long, wrapper string, kept array<int>, template array<struct<slot: int, text: long>>")


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text), one for each page."""
    pages = stored(with_layout(pages.select("page_id", "url", "html")))  # each page is taken apart once for its shape, not once per step
    known = stored(classified(pages)).select(F.col("layout").alias("_layout"), F.to_json(F.struct("wrapper", "kept", "template")).alias("_known"))

    @F.pandas_udf("string")
    def read_text(page: pd.Series, known: pd.Series) -> pd.Series:
        memo: dict = {None: (None, set(), set())}
        out = []
        for p, k in zip(page, known):
            if k not in memo:
                x = json.loads(k)
                memo[k] = Slots(json.loads(x["wrapper"])), set(x["kept"]), {(t["slot"], t["text"]) for t in x["template"]}
            out.append(read_page(p, *memo[k]))
        return pd.Series(out, dtype=object)

    rows = pages.select("page_id", "url", "html", "_layout").join(known, "_layout", "left")
    return rows.select("page_id", "url", read_text("html", "_known").alias("text"))


def op7_main_text(spark: SparkSession, root: str) -> DataFrame:
    return extract(read(spark, root, "pages")).withColumn("n_chars", F.length("text").cast("long"))
