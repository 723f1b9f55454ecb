"""Main text of web pages by wrappers inferred from the pages of each host (operator 12).

A page is read as a stream of block tags and text runs. Its wrapper is a
union-free regular expression over them: nested sequences of elements, groups
and text slots, any of which may be optional or repeated. Wrappers are merged by
aligning their sequences: what only one side has becomes optional, equal
neighbours and equal runs of neighbours become repeated, texts that differ
become slots. A slot keeps counts (texts, characters, characters in links) and
the least and largest hash of its texts, so that template text is known as such.

Pages of one host with the same wrapper are counted by ordinary aggregation;
distinct wrappers of a host are merged in rounds of small groups, so a host with
a third of all pages is never in one task. The page is then parsed along its
host's wrapper: the text of slots in the article is kept, that of template slots
and of navigation, notices and so on, known by element, class or role, is not.
Wrappers are sent to all tasks only below a checked size, else joined by host.

Where a host has no article or main element, the smallest part of the wrapper
with most of the text that is neither template nor links is the article.

Edge cases: a null or empty html gives the empty text. A null url, or one
without a host, counts as the host "". Unclosed and stray tags are repaired as
browsers do for p, li, dt, dd, td, th, tr and option; other unclosed elements
end with their parent. A br is white space. Elements deeper than DEPTH get no
place of their own in a wrapper, but their text stays. Repeated rows are
extracted row by row. An empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import join_back, materialize

#: Elements below this depth are not nodes of a wrapper.
DEPTH = 60
#: Wrappers merged by one task at a time, on average, and texts after which an equal text is a template's.
MERGED, TEMPLATE = 32, 8
#: Bytes of wrappers that are sent to every task at most.
SENT = 16 << 20
#: Rows of counts that a task holds before it passes them on.
HELD = 20_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without markup inside, and where they end.
RAW = {k: re.compile(f"</{k}", re.I | re.A) for k in "script style textarea title iframe noscript xmp noembed noframes".split()}
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes, and the elements that it doesn't reach beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}
#: An end tag closes nothing outside of the cell it is in, but for these.
CELLS, BEYOND = ("td", "th", "table"), frozenset("td th table tr tbody thead tfoot body html article main".split())
PARAGRAPH = ("p",)
#: Elements, and words of classes, ids and roles, whose text is no part of an article.
OUTSIDE = frozenset("nav footer aside menu head script style template svg math canvas object audio video select button datalist dialog map applet".split())
WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside rail footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup signin login share sharing social related recommended recommendations trending comment comments commentlist discussion disqus reply replies respond pagination pager copyright legal disclaimer widget widgets skip search searchbox complementary contentinfo dialog hidden outbrain taboola".split()
)
READERS = frozenset("comment comments commentlist discussion disqus reply replies".split())
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|[^<]+|<""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PLAIN, SKIPPED, MAIN, WEAK = "#", "#!", "#m", "#w"


def _words(value: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())


@lru_cache(1 << 14)
def element(name: str, attrs: str, in_article: bool) -> tuple[str, bool, bool]:
    """The element's name in a wrapper, whether its text is outside of articles, and whether it is an article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)} if attrs else {}
    classes = sorted({c for c in found.get("class", "").lower().split() if re.fullmatch(r"[a-z_-]+", c)})
    words = {w for k in ("class", "id", "role") for w in _words(found.get(k, ""))}
    if in_article:
        words -= {"header", "banner"}
    article = name in ("article", "main") or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I))
    if name in ("html", "body"):
        words = set()
    elif article:
        words &= READERS
    outside = hidden or name in OUTSIDE or name == ("form" if in_article else "header") or bool(words & WORDS)
    return ".".join([name, *classes]) + ("!" if outside else ""), outside, article and not outside


class Page:
    """A tree of [name, children]; a child is such a list or the number of a run. runs: (kind, text, characters in links, number of the block)."""

    def __init__(self, source: str):
        self.runs: list[tuple[str, str, int]] = []
        self.root: list = ["", []]
        #: Open elements: tag, node, outside, article, weak; the state of what is inside them.
        self.stack = [("", self.root, False, False, False)]
        self.buffer: list[str] = []
        self.links, self.link_at, self.block = 0, None, 0
        self.open: Counter[str] = Counter()
        self._read(source)
        self._flush()

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                _, node, outside, article, weak = self.stack[-1]
                node[1].append(len(self.runs))
                self.runs.append((SKIPPED if outside else MAIN if article else WEAK if weak else PLAIN, text, min(self.links, len(text)), self.block))
            self.buffer, self.links = [], 0

    def _open(self, name: str, attrs: str) -> None:
        inside = self.stack[-1]
        sig, outside, article = (element if len(attrs) < 500 else element.__wrapped__)(name, attrs, inside[3])
        if name not in BLOCK and not outside and not self.open[name]:
            return
        self._flush()
        self.block += name in BLOCK
        node = inside[1]
        if len(self.stack) < DEPTH:
            node = [sig, []]
            inside[1][1].append(node)
        self.open[name] += 1
        self.stack.append((name, node, inside[2] or outside, inside[3] or article, not article and (inside[4] or name == "form")))

    def _pop(self, upto: int) -> None:
        """Closes all elements from this place of the stack on."""
        self._flush()
        for x in self.stack[upto:]:
            self.open[x[0]] -= 1
            self.block += x[0] in BLOCK
        del self.stack[upto:]
        if self.link_at is not None and self.link_at > len(self.stack):
            self.link_at = None

    def _close(self, names, stop) -> None:
        for i in range(len(self.stack) - 1, 0, -1) if any(self.open[x] for x in names) else ():
            if self.stack[i][0] in names:
                return self._pop(i)
            if self.stack[i][0] in stop:
                return None
        return None

    def _text(self, raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        self.buffer.append(text)
        if self.link_at is not None:
            self.links += len(text)

    def _read(self, source: str) -> None:
        # What follows the last ">" has no tags; an unfinished one is dropped.
        at, end = 0, source.rfind(">") + 1
        tail = re.split(r"<[a-zA-Z/!?]", source[end:], maxsplit=1)[0]
        while at < end:
            m = TOKEN.match(source, at, end)
            at = m.end()
            name = m["name"] or m["name2"]
            if not name:
                token = m[0]
                if m["cdata"] is not None:
                    self._text(m["cdata"])
                elif not token.startswith(("<!", "<?")):
                    self._text(token)
                continue
            name, attrs = name.lower(), m["attrs"] or m["attrs2"] or ""
            if m["end"] or m["end2"]:
                if name == "a":
                    self.link_at = None
                if name == "p":
                    self._close(PARAGRAPH, BLOCK)
                else:
                    self._close((name,), () if name in BEYOND else CELLS)
            elif name == "br":
                self.buffer.append(" ")
            elif name in RAW:
                if not (close := RAW[name].search(source, at)):
                    return
                at = close.start()
            elif name == "a":
                self.link_at = len(self.stack)
                if "class" in attrs:
                    self._open(name, attrs)
            elif name in VOID:
                if name == "hr":
                    self._flush()
                    self.block += 1
            else:
                if name in BLOCK:
                    self._close(PARAGRAPH, BLOCK)
                if name in CLOSES:
                    self._close(*CLOSES[name])
                self._open(name, attrs)
                if attrs.endswith("/") and name not in BLOCK and self.stack[-1][0] == name:
                    self._pop(len(self.stack) - 1)
        if tail:
            self._text(tail)


# --- wrappers: items are [key, kids, repeated, optional, counts]; a group's key is that of its kids in brackets ----


def fold(items: list) -> list:
    """items with equal neighbours, and equal runs of up to three, merged into repeated ones."""
    for k in (1, 2, 3):
        out, i = [], 0
        while i < len(items):
            keys = [x[0] for x in items[i : i + k]]
            j = i + k
            while len(keys) == k and [x[0] for x in items[j : j + k]] == keys:
                j += k
            if j == i + k:
                out.append(items[i])
                i += 1
                continue
            first = items[i : i + k]
            for at in range(i + k, j, k):
                first = [merge(a, b) for a, b in zip(first, items[at : at + k], strict=True)]
            if k == 1:
                first[0][2] = True
                out += first
            else:
                out.append(["(" + " ".join(keys) + ")", first, True, False, None])
            i = j
        items = out
    return items


def merge(a: list, b: list) -> list:
    """One item for two of the same key."""
    counts = a[4] and [a[4][0] + b[4][0], a[4][1] + b[4][1], a[4][2] + b[4][2], min(a[4][3], b[4][3]), max(a[4][4], b[4][4])]
    return [a[0], align(a[1], b[1]), a[2] or b[2], a[3] or b[3], counts]


def _grouped(items: list, groups: dict[tuple, str]) -> list:
    """items with each run that is a group on the other side as a group of its own."""
    out, i = [], 0
    while i < len(items):
        for keys, key in groups.items():
            if tuple(x[0] for x in items[i : i + len(keys)]) == keys:
                out.append([key, items[i : i + len(keys)], False, False, None])
                i += len(keys)
                break
        else:
            out.append(items[i])
            i += 1
    return out


def align(a: list, b: list) -> list:
    """One sequence for two: common items merged, all others optional."""
    if not a and not b:
        return []
    groups = lambda s: {tuple(y[0] for y in x[1]): x[0] for x in s if x[0][0] == "("}
    ga, gb = groups(a), groups(b)
    a, b = _grouped(a, gb) if gb else a, _grouped(b, ga) if ga else b
    ka, kb = [x[0] for x in a], [x[0] for x in b]
    if ka == kb:
        return [merge(x, y) for x, y in zip(a, b, strict=True)]
    pairs = _common(ka, kb)
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [[*z[:3], True, z[4]] for z in a[i:x] + b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    return fold(out)


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence: the longest one, or of very long sequences each item's next place."""
    if len(a) * len(b) > 1 << 16:
        places: dict[str, list[int]] = {}
        for j in range(len(b) - 1, -1, -1):
            places.setdefault(b[j], []).append(j)
        out, last = [], -1
        for i, x in enumerate(a):
            while (p := places.get(x)) and p[-1] <= last:
                p.pop()
            if p:
                last = p.pop()
                out.append((i, last))
        return out
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def wrapper_of(page: Page) -> list:
    """The items of one page."""

    def items(children: list) -> list:
        out = []
        for c in children:
            if isinstance(c, int):
                kind, text, links, _ = page.runs[c]
                h = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                out.append([kind, [], False, False, [1, len(text), links, h, h]])
            else:
                out.append([c[0], items(c[1]), False, False, None])
        return fold(out)

    return items(page.root[1])


def flat(items: list) -> tuple[str, list[list[int]]]:
    """A wrapper as one string without counts, and the counts of its slots in order."""
    tokens, counts = [], []

    def walk(items: list) -> None:
        for key, kids, repeated, optional, n in items:
            tokens.append(json.dumps([key, int(repeated), int(optional)], ensure_ascii=False))
            if n:
                counts.append(n)
            else:
                walk(kids)
                tokens.append("0")

    walk(items)
    return "[" + ",".join(tokens) + "]", counts


def unflat(shape: str, counts) -> list:
    counts, stack = iter(counts), [[]]
    for t in json.loads(shape):
        if t == 0:
            stack.pop()
            continue
        key, repeated, optional = t
        slot = key[0] == "#"
        item = [key, [], bool(repeated), bool(optional), [int(x) for x in next(counts)] if slot else None]
        stack[-1].append(item)
        if not slot:
            stack.append(item[1])
    return stack[0]


def decide(items: list) -> list:
    """The wrapper with each slot's counts replaced by whether its text is kept."""
    slots: list[tuple[list, bool]] = []

    def walk(items: list, repeated: bool) -> None:
        for x in items:
            if x[4]:
                slots.append((x, repeated or x[2]))
            walk(x[1], repeated or x[2])

    walk(items, False)
    varied = {x[0] for x, _ in slots if x[4][3] != x[4][4]}
    keep = {id(x) for x, repeated in slots if x[0] != SKIPPED and not (x[0] in varied and not repeated and x[4][0] >= TEMPLATE and x[4][3] == x[4][4])}
    few_links = {id(x) for x, _ in slots if x[0] in (PLAIN, WEAK) and id(x) in keep and 2 * x[4][2] <= x[4][1]}

    def weight(x: list) -> int:
        return (x[4][1] if id(x) in few_links else 0) + sum(map(weight, x[1]))

    # Down from the whole page to the smallest part of several blocks with four fifths of what is neither template nor links.
    part = ["", items, False, False, None]
    while part[1]:
        best = max(part[1], key=weight)
        if 5 * weight(best) < 4 * weight(part) or not weight(best) or not any(x[1] for x in best[1]):
            break
        part = best
    chosen: set[int] = set()

    def below(x: list) -> None:
        if id(x) in few_links:
            chosen.add(id(x))
        for y in x[1]:
            below(y)

    below(part)

    def marked(items: list) -> list:
        return [[x[0], marked(x[1]), x[2], x[3], (id(x) in keep if x[0] == MAIN else id(x) in chosen) if x[4] else None] for x in items]

    return marked(items)


def text_by(page: Page, decided: list) -> str:
    """The page's text along a decided wrapper."""
    kept: list[bool] = [kind == MAIN for kind, *_ in page.runs]

    def match(children: list, items: list) -> None:
        at = 0
        for c in children:
            key = page.runs[c][0] if isinstance(c, int) else c[0]
            for k in [*range(at, len(items)), *range(at)]:
                x = items[k]
                hit = x if x[0] == key else next((y for y in x[1] if y[0] == key), None) if x[0][0] == "(" else None
                if hit:
                    at = k if hit is not x or x[2] else k + 1
                    if isinstance(c, int):
                        kept[c] = hit[4]
                    else:
                        match(c[1], hit[1])
                    break

    match(page.root[1], decided)
    for kind in (MAIN, PLAIN, WEAK):
        if any(k == kind for k, *_ in page.runs):
            found: dict[int, list[str]] = {}
            for (k, text, _, block), yes in zip(page.runs, kept, strict=True):
                if yes and k == kind:
                    found.setdefault(block, []).append(text)
            if found or kind == MAIN:
                return "\n".join(map(" ".join, found.values()))
    return ""


# --- over tables -------------------------------------------------------------------------------------------------


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def shapes(pages: DataFrame) -> DataFrame:
    """host, shape and counts (one array a slot) of every distinct wrapper of one page."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(h, s, p, *c) for (h, s), cs in held.items() for p, c in enumerate(cs or [[1, 0, 0, 0, 0]])], columns=["host", "shape", "slot", "n", "chars", "links", "low", "high"])

        size = 0
        for batch in batches:
            for h, source in zip(batch["host"], batch["html"], strict=True):
                shape, counts = flat(wrapper_of(Page(source)))
                if (old := held.get((h, shape))) is None:
                    held[h, shape] = counts
                    size += len(counts) + 1
                else:
                    for a, b in zip(old, counts, strict=True):
                        a[:] = a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])
                if size > HELD:
                    yield rows()
                    held, size = {}, 0
        yield rows()

    each = pages.mapInPandas(count, "host string, shape string, slot int, n long, chars long, links long, low long, high long")
    slots = each.groupBy("host", "shape", "slot").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.min("low").alias("low"), F.max("high").alias("high"))
    counted = slots.groupBy("host", "shape").agg(F.sort_array(F.collect_list(F.struct("slot", F.array("n", "chars", "links", "low", "high").alias("c")))).alias("s"))
    return counted.select("host", "shape", F.col("s.c").alias("counts"))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, shape and counts: one wrapper a host."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shape")
        merged = None
        for shape, counts in zip(rows["shape"], rows["counts"], strict=True):
            x = unflat(shape, counts)
            merged = x if merged is None else align(merged, x)
        shape, counts = flat(merged)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "shape": [shape], "counts": [counts]})

    found = materialize(shapes(pages))
    while True:
        n = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        if (n.agg(F.max("n")).first()[0] or 1) == 1:
            return found
        # Some MERGED of a host's wrappers meet in one group, in an order that doesn't depend on partitions.
        placed = join_back(found, n.select("host", F.col("n").alias("__of"), F.col("n").alias("__rows")), ["host"], "__rows")
        placed = placed.withColumn("__group", F.pmod(F.xxhash64("shape"), F.ceil(F.col("__of") / MERGED)))
        found = materialize(placed.groupBy("host", "__group").applyInPandas(one, "host string, shape string, counts array<array<bigint>>"))


@lru_cache(256)
def _decided(wrapper: str) -> list:
    shape, counts = json.loads(wrapper)
    return decide(unflat(shape, json.loads(counts)))


@F.pandas_udf(T.StringType())
def _extract(html: pd.Series, wrapper: pd.Series) -> pd.Series:
    return pd.Series([text_by(Page(h), _decided(w)) if h else "" for h, w in zip(html, wrapper, strict=True)], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text."""
    rows = pages.select(pages["page_id"], pages["url"], host(pages["url"]).alias("host"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    found = wrappers(rows.select("host", "html"))
    found = materialize(found.select("host", F.to_json(F.array(F.col("shape"), F.to_json("counts"))).alias("w")))
    if (found.agg(F.sum(F.length("w"))).first()[0] or 0) <= SENT:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        joined = join_back(rows, found.join(rows.groupBy("host").agg(F.count(F.lit(1)).alias("__rows")), "host"), ["host"], "__rows")
    return joined.select("page_id", "url", _extract("html", "w").alias("text"))


def op12(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
