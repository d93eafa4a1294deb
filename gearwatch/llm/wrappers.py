"""Main text of web pages by wrapper induction.

A page is read once, into a tree of its containers and its text blocks, each inside a container.
Per host the commonest container tree is the template; every other tree is aligned with it by
simple tree matching, so containers of different pages fall into the same slot. Slots whose text
is the same on different pages are template, varying slots are content: those inside ``article`` and
``main`` where these hold most of the varying prose, else all that are more than lists of links.
Only distinct trees are aligned, and slots are told apart by sums.

Elements such as ``nav`` or ``form`` never are content. A container that is only named like a menu
or an advert is not either, unless it holds the article or, on a host without, most of the varying prose.
"""

from __future__ import annotations

import html
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Mark of a container that is named like something apart from the text.
NAMED_APART = "~"

# Elements by their role in HTML, and names pages give to what is not their text.
CONTAINERS = frozenset("main article section div nav aside header footer form dialog".split())
BLOCKS = CONTAINERS | frozenset(
    "body html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption hr address fieldset legend details summary option".split()
)
UNSEEN = frozenset("head title script style noscript template iframe svg math object button select textarea canvas audio video".split())
APART = frozenset("nav aside footer form dialog".split())
MAIN = frozenset("article main".split())
LISTED = frozenset("p ul ol dl table".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "subscription share sharing social related recommended comment comments disqus respond login signup search widget "
    "pagination pager toolbar masthead".split()
)

TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
CLASSES = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""\b(?:hidden(?=[\s/>=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none)""", re.I)


# --- reading a page ---------------------------------------------------------------------------


def label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Name of an element for matching, whether it is named as apart, and whether it is hidden."""
    names = [w for m in NAMED.finditer(attributes) for w in re.split(r"[\s_-]+", "".join(filter(None, m.groups())).lower())]
    named = tag not in MAIN and bool(APART_NAMES.intersection(names))
    classes = " ".join("".join(filter(None, m.groups())).lower() for m in CLASSES.finditer(attributes))
    shown = ".".join(sorted({re.sub(r"[^a-z_-]", "", c) for c in classes.split()} - {""}))
    return f"{tag}.{shown}" if shown else tag, named, bool(HIDDEN.search(attributes))


def read_page(page: str, labels: dict | None = None) -> tuple[str, list[tuple[int, int, str, int]]]:
    """Outline of the containers, and blocks (container, apart, text, characters in links).

    The outline is one line ``depth label`` per container, in page order; container 0 is the page.
    ``apart`` is 1 for what can never be content. ``labels`` remembers labels from page to page.
    """
    labels = {} if labels is None else labels
    outline = ["0 page"]
    stack = [("page", 0, False)]
    held: Counter = Counter()
    listed: list[str] = []  # open lists, paragraphs and tables that are named as apart
    blocks: list[tuple[int, int, str, int]] = []
    pieces: list[str] = []
    linked, in_link, skipped = 0, 0, ""

    def look(tag: str, attributes: str) -> tuple[str, bool, bool]:
        if (tag, attributes) not in labels:
            if len(labels) >= 10_000:
                labels.clear()
            labels[tag, attributes] = label(tag, attributes)
        return labels[tag, attributes]

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((stack[-1][1], int(stack[-1][2] or bool(listed)), text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not skipped:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    for m in TAG.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        ending, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if skipped:
            if ending and tag == skipped:
                skipped = ""
            continue
        if tag in UNSEEN:
            if not ending and not attributes.endswith("/") and re.compile(f"</{tag}", re.I).search(page, at):
                skipped = tag
                if tag not in ("head", "title"):
                    pieces.append(" ")
            continue
        if tag == "a":
            in_link = 0 if ending else 1
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCKS:
            close()
            in_link = 0
            if listed and tag in LISTED and (tag == listed[-1] or tag != "p" and listed[-1] == "p"):
                if ending or listed[-1] == "p":  # the next block ends a paragraph
                    listed.pop()
            if tag in LISTED and not ending and attributes:
                _, named, hidden = look(tag, attributes)
                if named or hidden:
                    listed.append(tag)
            if tag in CONTAINERS:
                if not ending:
                    name, named, hidden = look(tag, attributes)
                    inside = held["article"] + held["main"] > 0
                    apart = stack[-1][2] or hidden or tag in APART or (tag == "header" and not inside)
                    outline.append(f"{len(stack)} {name}{NAMED_APART if named else ''}")
                    stack.append((tag, len(outline) - 1, apart))
                    held[tag] += 1
                elif held[tag]:
                    listed.clear()
                    while True:
                        gone = stack.pop()[0]
                        held[gone] -= 1
                        if gone == tag:
                            break
    say(page[at:])
    close()
    return "\n".join(outline), blocks


# --- trees --------------------------------------------------------------------------------------


def tree(outline: str) -> tuple[list[str], list[list[int]], list[int]]:
    """Labels, children and parents of the containers of an outline."""
    labels, children, parents, path = [], [], [], []
    for i, line in enumerate(outline.split("\n")):
        depth, name = line.split(" ", 1)
        del path[int(depth) :]
        labels.append(name)
        children.append([])
        parents.append(path[-1] if path else -1)
        if path:
            children[path[-1]].append(i)
        path.append(i)
    return labels, children, parents


def _best_order(gains: np.ndarray, trace: bool) -> tuple[int, list[tuple[int, int]]]:
    """Greatest sum of gains of pairs in order, and the pairs; a bit per pair of places is kept."""
    n, m = gains.shape
    above = np.zeros(m + 1, dtype=np.int64)
    taken, upward = [], []
    for i in range(n):
        met = above[:-1] + gains[i]
        row = np.concatenate([[0], np.maximum.accumulate(np.maximum(above[1:], met))])
        if trace:
            taken.append(np.packbits((gains[i] > 0) & (row[1:] == met)))
            upward.append(np.packbits(row[1:] == above[1:]))
        above = row
    pairs = []
    i, j = (n, m) if trace else (0, 0)
    while i and j:
        byte, bit = (j - 1) >> 3, 7 - ((j - 1) & 7)
        if taken[i - 1][byte] >> bit & 1:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif upward[i - 1][byte] >> bit & 1:
            i -= 1
        else:
            j -= 1
    return int(above[-1]), pairs


class Matching:
    """Simple tree matching of two outlines: equal roots match, children in order so that most do.

    Subtrees of one shape are compared once, equal shapes not at all.
    """

    def __init__(self, outline: str, template: str):
        self.trees = [tree(outline), tree(template)]
        self.shapes: dict = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.ids = [self._numbered(*t[:2]) for t in self.trees]
        self.known: dict[tuple[int, int], int] = {}

    def _numbered(self, labels: list[str], children: list[list[int]]) -> list[int]:
        ids = [0] * len(labels)
        for i in range(len(labels) - 1, -1, -1):
            kids = tuple(ids[c] for c in children[i])
            if (labels[i], kids) not in self.shapes:
                self.shapes[labels[i], kids] = len(self.label)
                self.label.append(labels[i])
                self.kids.append(kids)
                self.size.append(1 + sum(self.size[k] for k in kids))
            ids[i] = self.shapes[labels[i], kids]
        return ids

    def _pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        """Different shapes with one label among the children of two shapes."""
        right: dict[str, set[int]] = {}
        for y in self.kids[b]:
            right.setdefault(self.label[y], set()).add(y)
        return [(x, y) for x in set(self.kids[a]) for y in right.get(self.label[x], ()) if x != y]

    def _gains(self, a: int, b: int) -> np.ndarray:
        """Matched containers per pair of children; equal shapes match whole."""
        rows: dict[int, np.ndarray] = {}
        for x in set(self.kids[a]):
            gain = {y: self.size[x] if x == y else self.known.get((x, y), 0) for y in set(self.kids[b])}
            rows[x] = np.array([gain[y] for y in self.kids[b]], dtype=np.int64)
        if not rows or not self.kids[b]:
            return np.zeros((len(self.kids[a]), len(self.kids[b])), dtype=np.int64)
        return np.stack([rows[x] for x in self.kids[a]])

    def slots(self) -> list[int]:
        """For each container its partner in the template, -1 without one."""
        roots = self.ids[0][0], self.ids[1][0]
        waiting = [roots]
        while waiting:
            a, b = waiting[-1]
            below = [] if a == b else [p for p in self._pairs(a, b) if p not in self.known]
            if below:
                waiting += below
                continue
            waiting.pop()
            self.known[a, b] = self.size[a] if a == b else 1 + _best_order(self._gains(a, b), False)[0]
        (labels, children, _), (_, others, _) = self.trees
        slot = [-1] * len(labels)
        open_pairs = [(0, 0)]
        while open_pairs:
            x, y = open_pairs.pop()
            slot[x] = y
            a, b = self.ids[0][x], self.ids[1][y]
            if a == b:
                open_pairs += zip(children[x], others[y])
            else:
                pairs = _best_order(self._gains(a, b), True)[1]
                open_pairs += [(children[x][i], others[y][j]) for i, j in pairs]
        return slot


def align(outline: str, template: str) -> list[tuple[int, int]]:
    """For each container its slot, and the slot that guards it.

    The slot is the template container it is matched with, or the slot of its parent. Guard is the
    slot of the innermost container around it, or itself, that is named as apart and not inside
    ``article`` or ``main``: -1 if there is none, -2 if it has no partner.
    """
    labels, _, parents = tree(outline)
    matched = Matching(outline, template).slots()
    out: list[tuple[int, int]] = []
    for i, s in enumerate(matched):
        above = out[parents[i]] if i else (0, -1)
        guard = above[1]
        if labels[i].endswith(NAMED_APART):
            guard = s if s >= 0 else -2
        elif labels[i].split(".")[0] in MAIN:
            guard = -1
        out.append((s if s >= 0 else above[0], guard))
    return out


def content_slots(template: str, prose: dict[int, int], whole: dict[int, int], constant: set[int]) -> list[tuple[int, int]]:
    """(slot, guard) of all slots whose text is content; ``guard`` as in ``align``.

    ``prose`` and ``whole`` are characters outside links and all characters per slot, ``constant``
    the slots with one text on different pages.
    """
    labels, children, parents = tree(template)
    total = [0 if i in constant else prose.get(i, 0) for i in range(len(parents))]
    for i in range(len(parents) - 1, 0, -1):
        total[parents[i]] += total[i]
    guards = [g for _, g in align(template, template)]
    # The outermost article or main around each slot.
    around = [-1] * len(labels)
    for i, name in enumerate(labels):
        around[i] = around[parents[i]] if i and around[parents[i]] >= 0 else i if name.split(".")[0] in MAIN else -1
    article = any(prose.get(i) for i, a in enumerate(around) if a >= 0 and guards[i] == -1)
    cleared = {i for i, name in enumerate(labels) if name.endswith(NAMED_APART) and 2 * total[i] > total[0] and not article}
    live = [g == -1 or g in cleared for g in guards]
    own = [0 if i in constant or not live[i] else prose.get(i, 0) for i in range(len(labels))]
    inside = sum(x for x, a in zip(own, around) if a >= 0)
    mains = {a for a in around if a >= 0}
    # An article of which nothing varies is the same text twice, not template.
    fixed = {a for a in mains if not any(prose.get(i) for i in range(len(labels)) if around[i] == a and i not in constant)}
    first = bool(mains) and 2 * inside >= sum(own)
    found = []
    for i in range(len(labels)):
        if not live[i] or (first and around[i] < 0):
            continue
        if i in constant and around[i] not in fixed:
            continue
        if not first and 2 * prose.get(i, 0) < whole.get(i, 0):
            continue
        found.append((i, guards[i]))
    return found


# --- the operator -----------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """Host of an address in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per row of ``pages``.

    ``text`` are the blocks in content slots, in page order, joined by an empty line. A container
    without partner counts as part of the one around it. A page without any block in its host's
    content gives all blocks that are not apart. A slot is template only if two pages with different
    text have the same in it, so nothing is template on a host of one page or of copies of one.
    Null or empty html gives an empty text; pages without a host form one group. Repeated rows
    each get a row; long pages, deep nesting and thousands of siblings are read whole; other columns
    are ignored.
    """
    blocks_type = "array<struct<node:int,apart:int,text:string,linked:int>>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels: dict = {}
        for batch in batches:
            found = [read_page(p, labels) for p in batch.pop("_html")]
            prose = []
            for _, blocks in found:
                by_node: dict[int, tuple[int, int, int]] = {}
                for node, apart, text, linked in blocks:
                    if not apart:
                        chars, whole, mark = by_node.get(node, (0, 0, 0))
                        by_node[node] = chars + len(text) - linked, whole + len(text), zlib.crc32(text.encode("utf-8", "replace"), mark)
                prose.append([{"node": n, "chars": c, "whole": w, "mark": m} for n, (c, w, m) in by_node.items()])
            yield batch.assign(
                outline=[o for o, _ in found],
                blocks=[[dict(zip(("node", "apart", "text", "linked"), b)) for b in bs] for _, bs in found],
                prose=prose,
            )

    picked = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host_of(F.col(url_col)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "_html")
    prose_type = "array<struct<node:int,chars:long,whole:long,mark:long>>"
    parsed, _ = stored(picked.mapInPandas(read, f"{fields}, outline string, blocks {blocks_type}, prose {prose_type}"), "pages")

    outlines, _ = stored(parsed.groupBy("host", "outline").agg(F.count("*").alias("n")), "outlines")
    templates = outlines.groupBy("host").agg(F.max_by("outline", F.struct("n", "outline")).alias("template"))

    @F.pandas_udf("array<struct<slot:int,guard:int>>")
    def slots(outline: pd.Series, template: pd.Series) -> pd.Series:
        return pd.Series([[{"slot": s, "guard": g} for s, g in align(o, t)] for o, t in zip(outline, template)])

    aligned, _ = stored(outlines.join(templates, "host").select("host", "outline", slots("outline", "template").alias("slots")), "aligned")
    each = parsed.select("host", "outline", "prose").join(aligned, ["host", "outline"])
    placed = F.transform("prose", lambda p: F.struct(p.alias("p"), F.get("slots", p["node"]).alias("at")))
    # What tells pages apart is text that nothing guards.
    open_marks = F.transform(F.filter(placed, lambda x: x["at"]["guard"] == -1), lambda x: F.struct(x["at"]["slot"], x["p"]["mark"]))
    each = each.select("host", F.xxhash64(open_marks).alias("page"), F.explode(placed).alias("x")).where("x.at.guard <> -2")
    sums = each.groupBy("host", F.col("x.at.slot").alias("slot")).agg(
        F.sum("x.p.chars").alias("chars"), F.sum("x.p.whole").alias("whole"),
        ((F.min("x.p.mark") == F.max("x.p.mark")) & (F.min("page") < F.max("page"))).alias("constant"),
    )

    def choose(key, group: pd.DataFrame) -> pd.DataFrame:
        at = group["slot"]
        chosen = content_slots(
            group["template"].iloc[0], dict(zip(at, group["chars"])), dict(zip(at, group["whole"])), set(at[group["constant"]])
        )
        return pd.DataFrame({"host": [key[0]], "content": [[{"slot": s, "guard": g} for s, g in chosen]]})

    content = sums.join(templates, "host").groupBy("host").applyInPandas(choose, "host string, content array<struct<slot:int,guard:int>>")
    # A guard is cleared where the content has slots it guards.
    open_node = "array_contains(transform(content, c -> c.slot), s.slot) AND (s.guard = -1 OR array_contains(transform(content, c -> c.guard), s.guard))"
    rules = aligned.join(content, "host").select(
        F.col("host").alias("_h"), F.col("outline").alias("_o"),
        F.expr(f"filter(transform(slots, (s, i) -> CASE WHEN {open_node} THEN i END), i -> i IS NOT NULL)").alias("nodes"),
        F.expr("filter(transform(slots, (s, i) -> CASE WHEN s.guard = -1 THEN i END), i -> i IS NOT NULL)").alias("unguarded"),
    )
    rules, _ = stored(rules, "rules")
    ruled = parsed.join(rules, (F.col("host") == F.col("_h")) & (F.col("outline") == F.col("_o")), "left")
    free = F.filter("blocks", lambda b: b["apart"] == 0)
    inside = F.filter(free, lambda b: F.array_contains("nodes", b["node"]))
    rest = F.filter(free, lambda b: F.coalesce(F.array_contains("unguarded", b["node"]), F.lit(True)))
    wanted = F.array_join(F.transform(F.when(F.size(inside) > 0, inside).otherwise(rest), lambda b: b["text"]), "\n\n")
    out = ruled.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), wanted.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
