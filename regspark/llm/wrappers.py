"""Operator 3. Main text by wrappers: union-free expressions inferred from the token streams of a host's pages.

A page is a stream of tags and texts. A wrapper is an expression over them: tags in their order, text slots
(#) and constant texts (=); a part occurs once, optionally (?), or repeatedly (+, *). Two wrappers are
aligned level by level along a longest common subsequence of their tags; a mismatch becomes an
optional group, like tags of one level become a repeated group, texts that differ become a slot. A
page alone is a wrapper of itself, so inference is the same step from two pages to all:

1. Names are counted per host and place: one that fewer than 2 % of a host's pages have there (the id of a
   heading, say, or a hash) gives way to its tag, so that a wrapper's size depends on the template, not
   on the number of pages. Below ``DEEPEST`` levels nodes count as their parents.
2. Texts are counted per host, place and text over different stories. Pages whose longest text (but for those that
   nearly all pages have) is the same are one story: revisions of an article do not make it a template. A slot whose
   texts mostly recur (in three stories or more: menus, rotating adverts, footers) is a slot of the template; a
   text that nearly all pages and stories have is a constant of the wrapper. Where constants would take more than a
   third of what a host's articles hold, they are its articles.
3. Each task folds the pages of a host that it reads into one wrapper; wrappers of a host are folded in
   salted groups, then once more. What moves is wrappers, counts and digests; no group of pages is collected.
4. The wrapper decides: the main text is what fills the content slots under the article (or main) tag or, without
   one, under the lowest tag that holds all of them. Constants and template slots are left out there too, and so
   are repeated groups of links that most pages have; headings stay where content follows. Kinds of tags and
   names (menus, headers, footers, asides, forms, adverts, comments, scripts) only settle what the
   wrapper cannot tell: comments differ from page to page, and a host may have a page or two.
5. Each page is matched with its host's wrapper, and the texts that fill its content slots are joined.

Defined cases: null and empty html give an empty text; a url without host is a host of its own; a page of which
the wrapper leaves nothing is judged by itself; broken markup is read as far as it goes (unclosed tags end
with their parents, paragraphs with the next block); very long and very deep pages are whole; repeated rows each get
their own result and count as one page of their host; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, small, small_batches
from .words import slices

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: The kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg math iframe object canvas title head".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
#: Inline tags that a new block ends if they were left open.
INLINE_AT_BLOCK = frozenset("b i em strong u s small span a font".split())
OUT = frozenset("nav header footer aside form button select input label menu dialog script style noscript template iframe object svg math canvas head title textarea option".split())
OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|advertisement|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side|aside|widget\w*|related|recommend\w*|share|sharing|social|comments?|comment\w*|replies|reply|discussion|disqus|responses?|cookies?|consent|notice|notices|alert|popup|modal|newsletter|subscribe|subscription|signup|login|search|pagination|pager|toolbar|copyright|disclaimer|complementary|navigation|contentinfo|legal|skip|hidden)(?:$|[\s_-]|\d)",
    re.I,
)

#: Classes and roles that are no main text inside an article either.
OUT_INSIDE = re.compile(
    r"(?:^|\s)(?:(?:ads?|advert\w*|advertisement)(?:[_-]\S*)?|\S+[_-]ads?|sponsored|promo|promotion|comments?|comments?[_-](?:list|section|area|box|thread|form|wrapper|container)|replies|disqus|nav|navbar|navigation|menu|breadcrumbs?|sidebar|share|sharing|social|related|recommended|newsletter|subscribe|pagination|pager|toolbar|cookies?|popup|modal|complementary|contentinfo|search)(?=$|\s)",
    re.I,
)
#: Levels of a wrapper, well under Python's recursion limit.
DEEPEST = 150
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption figcaption legend summary".split())
#: Tags that say nothing by themselves.
CONTAINERS = frozenset("div section td center".split())
NOTHING: frozenset[int] = frozenset()


def stream(page: str) -> Iterator[tuple[str, str, str]]:
    """(open, tag, class, role and #id names), (close, tag, ''), (text, raw text, '')."""
    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            yield "close", tag, ""
            continue
        names = " ".join(("#" if n.lower() == "id" else "") + (a or b or c).strip() for n, a, b, c in ATTRIBUTE.findall(m[3])) if m[3] else ""
        yield "open", tag, re.sub(r"\d+", "", names).strip().lower()
        if tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            yield "close", tag, ""


def key_of(tag: str, names: str, inner: str = "") -> str:
    """How a tag is known in its level: its names, and for mere containers what they hold."""
    return tag + (f".{names}" if names else "") + (f"\x1f{inner}" if inner else "")


def parts_of(key: str) -> tuple[str, str]:
    """(tag, names) of a key."""
    tag, _, names = key.partition("\x1f")[0].partition(".")
    return tag, names


def mark_of(place: str, key: str) -> int:
    """A key below the tags of a place, as a signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(f"{place}/{key}".encode("utf-8", "replace")) - (1 << 63)


def plain(tag: str, names: str) -> str:
    """The key of a rare name: its tag, and whether is_out() knows the name."""
    known = ""
    if OUT_INSIDE.search(" ".join(n for n in names.split() if not n.startswith("#"))):
        known = "ad"
    elif OUT_NAMES.search(names.replace("#", " ")):
        known = "#ad"
    return key_of(tag if tag.isalnum() else "x-", known)


def marks_of(page: str) -> set[int]:
    """Places of all names of a page."""
    found: set[int] = set()
    for _ in walk(page, seen=found):
        pass
    return found


class Tree:
    """The tags of a page as they nest, and its texts and block borders in order."""

    def __init__(self, page: str) -> None:
        self.tags, self.names, self.parents, self.depths = [""], [""], [0], [0]
        self.inner: list[set[str]] = [set()]
        self.events: list[tuple[int, str, str]] = []
        path = [0]
        for kind, value, names in stream(page):
            if kind == "text":
                self.events.append((path[-1], "text", value))
                if not value.isspace():
                    self.inner[path[-1]].add("#")
            elif kind == "open":
                if value in BLOCK:
                    while self.tags[path[-1]] in INLINE_AT_BLOCK or value != "br" and self.tags[path[-1]] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                        path.pop()
                    if value in ("li", "dd", "dt", "tr", "td", "th", "option") and self.tags[path[-1]] == value:
                        path.pop()
                    self.events.append((path[-1], "break", ""))
                if value not in VOID:
                    if value in BLOCK and value != "br":
                        self.inner[path[-1]].add(value)
                    for column, x in ((self.tags, value), (self.names, names), (self.parents, path[-1]), (self.depths, len(path)), (self.inner, set())):
                        column.append(x)
                    path.append(len(self.tags) - 1)
            else:
                if value in BLOCK:
                    self.events.append((path[-1], "break", ""))
                if any(self.tags[n] == value for n in path):
                    while self.tags[path.pop()] != value:
                        pass

    def paths(self, frequent: frozenset[int] | None, seen: set[int] | None) -> list[tuple[str, ...]]:
        """The keys from the top to each tag. What a container holds, and then its names, count as long as
        they are frequent there (None: all are); all places of names are added to seen."""
        out, places = [()], [""]
        for n in range(1, len(self.tags)):
            tag, names, parent = self.tags[n], self.names[n], self.parents[n]
            if self.depths[n] > DEEPEST:
                out.append(out[parent])
                places.append(places[parent])
                continue
            place = f"{places[parent]}/{tag}"
            inner = ",".join(sorted(self.inner[n])) if tag in CONTAINERS else ""
            key = key_of(tag, names, inner)
            if (names or inner or not tag.isalnum()) and (seen is not None or frequent is not None):
                marks = [(mark_of(place, k), k) for k in ((key, key_of(tag, names)) if inner else (key,)) if k != tag]
                if seen is not None:
                    seen.update(m for m, _ in marks)
                if frequent is not None:
                    key = next((k for m, k in marks if m in frequent), plain(tag, names))
            out.append((*out[parent], key))
            places.append(place)
        return out


def walk(page: str, frequent: frozenset[int] | None = None, seen: set[int] | None = None) -> Iterator[tuple[tuple[str, ...], str, str]]:
    """(path of keys, event, text): event text, or break where a block begins or ends."""
    tree = Tree(page)
    paths = tree.paths(frequent, seen)
    for n, event, text in tree.events:
        yield paths[n], event, text


def slot_mark(path: tuple[str, ...] | list[str]) -> int:
    """The place of a text slot, as a signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest("/".join(path).encode("utf-8", "replace")) - (1 << 63)


def text_mark(slot: int, text: str) -> int:
    """A text in its place."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"), slot + (1 << 63)) - (1 << 63)


def spoken(page: str, frequent: frozenset[int] | None) -> list[tuple[tuple[str, ...], int, int, int]]:
    """(path, its slot, words, the text's mark) of a page's texts, in order."""
    found, slots = [], {}
    for path, event, text in walk(page, frequent):
        if event == "text" and (own := squeeze(text)):
            slot = slots.get(path)
            if slot is None:
                slot = slots[path] = slot_mark(path)
            found.append((path, slot, own.count(" ") + 1, text_mark(slot, own)))
    return found


def texts_of(texts: list[tuple[tuple[str, ...], int, int, int]]) -> dict[tuple[int, int], tuple[int, bool]]:
    """(slot, text in it) of a page's texts: (words, whether it is an article's own, headings apart)."""
    found, inside = {}, {}
    for path, slot, words, mark in texts:
        if slot not in inside:
            tags = [parts_of(k)[0] for k in path]
            inside[slot] = ("article" in tags or "main" in tags) and not HEADINGS.intersection(tags)
        found[slot, mark] = words, inside[slot]
    return found


def squeeze(text: str) -> str:
    return " ".join(html.unescape(text).split())


def empty() -> dict:
    return {"pages": 0, "most": 1, "kids": {}, "slots": {}}


def wrapper_of(page: str, frequent: frozenset[int] | None = None) -> dict:
    """A page as a wrapper: nodes by key in page order, like neighbours folded into a repeated one."""
    return wrapper_from(spoken(page, frequent))


def wrapper_from(texts: list[tuple[tuple[str, ...], int, int, int]]) -> dict:
    root, nodes = empty(), {}
    root["pages"] = 1
    for path, _, n, mark in texts:
        known = nodes.get(path)
        if known is None:
            node = root
            for key in path:
                kid = node["kids"].get(key)
                if kid is None:
                    kid = node["kids"][key] = empty()
                    kid["pages"] = 1
                node = kid
            known = nodes[path] = node, any(k == "a" or k.startswith("a.") for k in path)
        node, is_link = known
        own = node["slots"].get("text")
        if own is None:
            own = node["slots"]["text"] = {"fixed": mark, "words": 0, "links": 0, "n": 0}
        else:
            node["most"] = 2
            if own["fixed"] != mark:
                own["fixed"] = None
        own["words"] += n
        own["n"] += 1
        if is_link:
            own["links"] += n
    return root


def in_order(a: list[str], b: list[str]) -> list[str]:
    """The different keys of both, aligned along a longest common subsequence."""
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i] == b[j] else max(length[i + 1][j], length[i][j + 1])
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(a[i])
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            out.append(a[i])
            i += 1
        else:
            out.append(b[j])
            j += 1
    return list(dict.fromkeys([*out, *a[i:], *b[j:]]))


def align(a: dict, b: dict) -> dict:
    """Both wrappers in one. A node that one of them lacks becomes optional (fewer pages than its parent
    has), texts that differ become a slot."""
    one, two = list(a["kids"]), list(b["kids"])
    kids = {}
    for key in one if one == two else in_order(one, two):
        x, y = a["kids"].get(key), b["kids"].get(key)
        kids[key] = align(x, y) if x and y else x or y
    x, y = a["slots"].get("text"), b["slots"].get("text")
    both = {"fixed": x["fixed"] if x["fixed"] == y["fixed"] else None, **{c: x[c] + y[c] for c in ("words", "links", "n")}} if x and y else x or y
    return {"pages": a["pages"] + b["pages"], "most": max(a["most"], b["most"]), "kids": kids, "slots": {"text": both} if both else {}}


def expression(node: dict, key: str = "", parent_pages: int | None = None) -> str:
    """The wrapper as a regular expression: # a slot, = a shared text, ? optional, + and * repeated."""
    inner = "".join(("=" if s["fixed"] else "#") for s in node["slots"].values()) + "".join(expression(k, n, node["pages"]) for n, k in node["kids"].items())
    if not key:
        return inner
    optional = parent_pages is not None and node["pages"] < parent_pages
    sign, shown = {(0, 0): "", (0, 1): "?", (1, 0): "+", (1, 1): "*"}[node["most"] > 1, optional], key.partition("\x1f")[0]
    return f"(<{shown}>{inner}</>){sign}" if sign else f"<{shown}>{inner}</>"


class Rules:
    """What of a host's wrapper is main text. shared: the marks of its template slots."""

    def __init__(self, wrapper: dict, shared: frozenset[int] = NOTHING) -> None:
        self.wrapper, self.pages, self.shared = wrapper, wrapper["pages"], shared
        self.out: list[list[str]] = []

    def is_template(self, path: list[str]) -> bool:
        return bool(self.shared) and slot_mark(path) in self.shared

    def content(self, node: dict, path: list[str]) -> int:
        """Words of the node's own content slots, links apart."""
        return 0 if self.is_template(path) else sum(s["words"] - s["links"] for s in node["slots"].values())

    def is_out(self, key: str, node: dict, path: list[str], inside: bool) -> bool:
        """Whether a node is left out by its kind, or as a group of links; an article's own header belongs to it."""
        tag, names = parts_of(key)
        if tag in OUT:
            return not (tag == "header" and inside)
        if inside and self.is_link_group(node):
            return True
        if not names or tag in ("body", "html"):
            return False
        named = bool(OUT_NAMES.search(names.replace("#", " ")))
        if not inside:
            return named
        if OUT_INSIDE.search(" ".join(n for n in names.split() if not n.startswith("#"))):
            return True
        if not named:
            return False
        slots = list(all_slots(node))
        return (not has_heading(node) and not self.words_in(node, path)) or 2 * sum(s["links"] for s in slots) > sum(s["words"] for s in slots)

    def is_link_group(self, node: dict) -> bool:
        """Whether most pages, and several, have three links or more there and hardly another word."""
        if node["pages"] < 3 or 2 * node["pages"] <= self.pages:
            return False
        slots = list(all_slots(node))
        links = [s for s in slots if s["links"]]
        return sum(s["n"] for s in links) >= 3 * node["pages"] and sum(s["links"] for s in slots) >= 0.9 * sum(s["words"] for s in slots)

    def words_in(self, node: dict, path: list[str], inside: bool = False) -> int:
        """Words of all content slots of what is not left out."""
        own = self.content(node, path)
        return own + sum(self.words_in(k, [*path, key], inside) for key, k in node["kids"].items() if not self.is_out(key, k, [*path, key], inside))

    def tagged(self, wanted: str) -> list[tuple[list[str], dict]]:
        """The outermost nodes of a tag, outside what is left out."""
        found, stack = [], [([], self.wrapper)]
        while stack:
            path, node = stack.pop()
            for key, kid in node["kids"].items():
                if not self.is_out(key, kid, [*path, key], False):
                    (found if parts_of(key)[0] == wanted else stack).append(([*path, key], kid))
        return found if sum(self.words_in(n, p, True) for p, n in found) else []

    def lowest(self) -> tuple[list[str], dict]:
        """The lowest node that holds all content words."""
        node, path = self.wrapper, []
        while True:
            inner = [(self.words_in(k, [*path, key]), key) for key, k in node["kids"].items() if not self.is_out(key, k, [*path, key], False)]
            if not inner or max(inner)[0] < max(self.words_in(node, path), 1) or parts_of(max(inner)[1])[0] in ("p", *HEADINGS, "li", "ul", "ol", "table", "pre", "blockquote", "section"):
                return path, node
            path = [*path, max(inner)[1]]
            node = node["kids"][path[-1]]

    def keep(self, node: dict, path: list[str], heading: bool, names_count: bool) -> None:
        if heading or not self.is_template(path):
            self.out.append(path)
        for key, kid in node["kids"].items():
            own = [*path, key]
            # above the article's own node, names mean what they mean on the page
            above = names_count and (not path or parts_of(path[-1])[0] in ("html", "body"))
            if self.is_out(key, kid, own, not above):
                continue
            is_heading = heading or parts_of(key)[0] in HEADINGS
            if is_heading or self.words_in(kid, own, True) or not any_template(self, kid, own):
                self.keep(kid, own, is_heading, names_count)

    def kept_paths(self) -> list[list[str]]:
        """Paths of the content slots."""
        articles = self.tagged("article") or self.tagged("main")
        if self.shared:
            plain = Rules(self.wrapper)
            tagged = plain.tagged("article") or plain.tagged("main")
            # where most of what the articles hold recurs, pages are copies of each other, not templates
            if 2 * sum(self.words_in(n, p, True) for p, n in tagged) < sum(plain.words_in(n, p, True) for p, n in tagged):
                self.shared, articles = NOTHING, tagged
        for path, node in articles or [self.lowest()]:
            self.keep(node, path, False, not articles)
        return self.out


def any_template(rules: Rules, node: dict, path: list[str]) -> bool:
    return bool(node["slots"]) and rules.is_template(path) or any(any_template(rules, k, [*path, key]) for key, k in node["kids"].items())


def all_slots(node: dict) -> Iterator[dict]:
    yield from node["slots"].values()
    for kid in node["kids"].values():
        yield from all_slots(kid)


def has_heading(node: dict) -> bool:
    return any(parts_of(key)[0] in HEADINGS or has_heading(kid) for key, kid in node["kids"].items())


def settled(wrapper: dict, shared: frozenset[int] = NOTHING) -> tuple[list[list[str]], frozenset[int]]:
    """Paths of the content slots, and the marks that still count (none where pages are copies of each other)."""
    own = Rules(wrapper, shared)
    return own.kept_paths(), own.shared


def kept_paths(wrapper: dict, shared: frozenset[int] = NOTHING) -> list[list[str]]:
    return settled(wrapper, shared)[0]


def text_under(page: str, paths: set[tuple[str, ...]], frequent: frozenset[int] | None = None, shared: frozenset[int] = NOTHING) -> str:
    """The texts in the given slots, less the wrapper's constants (but headings), block by block."""
    blocks, own, slots = [], [], {}
    for path, event, text in walk(page, frequent):
        if event == "break":
            if own:
                blocks.append("".join(own))
                own = []
        elif path in paths:
            if shared and path not in slots:
                slots[path] = None if any(parts_of(k)[0] in HEADINGS for k in path) else slot_mark(path)
            if not shared or slots[path] is None or text_mark(slots[path], squeeze(text)) not in shared:
                own.append(text)
    return "\n".join(b for b in map(squeeze, [*blocks, "".join(own)]) if b)


def main_text(page: str, paths: set[tuple[str, ...]], frequent: frozenset[int] | None = None, shared: frozenset[int] = NOTHING) -> str:
    """The page's main text by its host's wrapper, or by its own if it has nothing there."""
    return text_under(page, paths, frequent, shared) or text_under(page, {tuple(p) for p in kept_paths(wrapper_of(page))})


def folded(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[tuple, dict]]:
    held: dict[tuple, dict] = {}
    for batch in batches:
        for r in batch.to_pylist():
            key, own = tuple(r[c] for c in group), json.loads(r["wrapper"])
            held[key] = align(held[key], own) if key in held else own
    yield from held.items()


def host_of(url: str):
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit("")), F.lit("?"))


def frequent_names(pages: DataFrame, least_percent: int = 2, held_names: int = 100_000) -> DataFrame:
    """host, frequent (marks as bytes) of the hosts (host, html) that have names on few pages: the others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = list(held.items())
            held.clear()
            columns = ([h for (h, _), _ in rows], [m for (_, m), _ in rows], [n for _, n in rows])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["host", "mark", "n"])

        for batch in slices(batches):
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
                held.update((host, m) for m in marks_of(page))
                if len(held) > held_names:
                    yield out()
        yield out()

    counts = materialise(pages.mapInArrow(count, "host string, mark long, n long").groupBy("host", "mark").agg(F.sum("n").alias("n")), "names")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    rated = counts.join(small(materialise(sizes, "hosts"), 100_000), "host").withColumn("often", F.col("n") * 100 >= F.col("pages") * least_percent)
    some = rated.groupBy("host").agg(F.min("often").alias("all_often"), F.collect_list(F.when(F.col("often"), F.col("mark"))).alias("marks"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["host"], pa.array([np.array(m, np.int64).tobytes() for m in batch["marks"].to_pylist()], pa.binary())], ["host", "frequent"])

    return materialise(some.filter(~F.col("all_often")).select("host", "marks").mapInArrow(pack, "host string, frequent binary"), "frequent-names")


def marks_in(packed: bytes | None, known: dict) -> frozenset[int] | None:
    if packed is None:
        return None
    if packed not in known:
        known.clear() if len(known) > 100 else None
        known[packed] = frozenset(np.frombuffer(packed, np.int64).tolist())
    return known[packed]


#: What one pass over the pages tells: each task's wrapper of a host, and the texts of each page.
TOLD = "host string, salt int, wrapper string, page long, slot long, text long, words int, inside boolean"


def tell(pages: DataFrame, salts: int = 16) -> DataFrame:
    """TOLD of all pages (host, html, frequent): rows with a wrapper (a tree as JSON), and rows with a text."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[str, dict] = {}
        known: dict[bytes, frozenset] = {}
        types = {"page": pa.int64(), "slot": pa.int64(), "text": pa.int64(), "words": pa.int32(), "inside": pa.bool_()}
        columns = ["host", "salt", "wrapper", *types]
        for batch in slices(batches):
            hosts, rows = [], []
            for host, page, names in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), batch["frequent"].to_pylist(), strict=True):
                texts = spoken(page, marks_in(names, known))
                own = wrapper_from(texts)
                held[host] = align(held[host], own) if host in held else own
                digest = xxhash.xxh3_64_intdigest(page.encode("utf-8", "replace")) - (1 << 63)
                found = texts_of(texts)
                hosts += [host] * len(found)
                rows += [(digest, *m, *about) for m, about in found.items()]
            nothing = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *nothing, *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types.values()))], columns)
        salt = TaskContext.get().partitionId() % salts
        own = [pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()), pa.array([json.dumps(w) for w in held.values()], pa.string())]
        yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(held), t) for t in types.values())], columns)

    return pages.mapInArrow(of_task, TOLD)


def infer(told: DataFrame) -> DataFrame:
    """host, wrapper of all pages that were told of."""

    def fold_with(group: list[str]):
        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [(*key, json.dumps(w)) for key, w in folded(batches, group)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int32() if name == "salt" else pa.string()) for c, name in enumerate([*group, "wrapper"])], [*group, "wrapper"])

        return fold

    parts = told.filter("wrapper is not null").select("host", "salt", "wrapper")
    some = parts.repartition("host", "salt").mapInArrow(fold_with(["host", "salt"]), "host string, salt int, wrapper string")
    return some.repartition("host").mapInArrow(fold_with(["host"]), "host string, wrapper string")


def shared_marks(told: DataFrame, pages: DataFrame, least_stories: int = 4, recurs: int = 3, nearly_all: int = 90) -> DataFrame:
    """host, shared (marks as bytes): template slots and constant texts of the hosts that have at least least_stories
    different stories, of what was told of all pages (host, html)."""

    # pages that are equal count once
    places = materialise(told.filter("wrapper is null").select("host", "page", "slot", "text", "words", "inside").distinct(), "places")
    text = ["host", "slot", "text"]
    seen = materialise(places.groupBy(*text).agg(F.count(F.lit(1)).alias("n"), F.first("words").alias("words"), F.first("inside").alias("inside")), "texts")
    hosts = materialise(pages.select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "pages-of-hosts")
    large = small(hosts.filter(F.col("pages") >= least_stories), 100_000)
    # at most a page's texts a host
    constant = materialise(seen.join(large, "host").filter(F.col("n") * 100 >= F.col("pages") * nearly_all).select(*text, "words", "inside", "n"), "constants")
    held = seen.filter("inside").groupBy("host").agg(F.sum(F.col("n") * F.col("words")).alias("held"))
    taken = constant.filter("inside").groupBy("host").agg(F.sum(F.col("n") * F.col("words")).alias("taken"))
    revisions = taken.join(held, "host").filter(F.col("taken") * 3 > F.col("held")).select("host")
    rated = places.join(constant.select(*text, F.lit(True).alias("lasts")), text, "left").groupBy("host", "page").agg(F.max(F.when(F.col("lasts").isNull(), F.struct("words", "text"))).alias("longest"))
    stories = materialise(rated.select("host", "page", F.coalesce("longest.text", "page").alias("story")), "stories")
    several = materialise(stories.groupBy("host").agg(F.count_distinct("story").alias("stories")).filter(F.col("stories") >= least_stories), "several-stories")
    several = small(several, 100_000)
    told = places.join(several, "host", "left_semi").join(stories, ["host", "page"]).groupBy(*text, "story").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(told.groupBy(*text).agg(F.count(F.lit(1)).alias("n")), "texts-of-stories")
    slots = counts.groupBy("host", "slot").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") >= recurs, F.col("n"))).alias("again"))
    template = slots.filter(F.col("again") * 2 > F.col("all")).select("host", F.col("slot").alias("mark"))
    lasting = counts.join(several, "host").filter(F.col("n") * 100 >= F.col("stories") * nearly_all).select(*text)
    lasting = lasting.join(constant.select(*text, "inside"), text)
    lasting = lasting.join(revisions.withColumn("revised", F.lit(True)), "host", "left").filter(~(F.col("inside") & F.col("revised").isNotNull())).select("host", F.col("text").alias("mark"))
    every = template.unionByName(lasting).groupBy("host").agg(F.collect_list("mark").alias("marks"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["host"], pa.array([np.array(m, np.int64).tobytes() for m in batch["marks"].to_pylist()], pa.binary())], ["host", "shared"])

    out = materialise(every.mapInArrow(pack, "host string, shared binary"), "shared-marks")
    discard(places, seen, hosts, constant, stories, counts)
    return out


def rules(wrappers: DataFrame, shared: DataFrame) -> DataFrame:
    """host, paths (JSON) of the content slots, shared (the marks that count)."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, frozenset] = {}
        for batch in slices(batches):
            found = [settled(json.loads(w), marks_in(s, known) or NOTHING) for w, s in zip(batch["wrapper"].to_pylist(), batch["shared"].to_pylist(), strict=True)]
            marks = pa.array([own if counts else None for (_, counts), own in zip(found, batch["shared"].to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["host"], pa.array([json.dumps(paths) for paths, _ in found], pa.string()), marks], ["host", "paths", "shared"])

    return wrappers.join(shared, "host", "left").mapInArrow(decide, "host string, paths string, shared binary")


def main_texts(pages: DataFrame, most_broadcast: int = 5_000) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    own = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    names = frequent_names(own.select("host", "html"))
    own = own.join(small(names, most_broadcast), "host", "left")
    seen = own.select("host", "html", "frequent")
    told = materialise(tell(seen), "told")
    learned = materialise(rules(infer(told), shared_marks(told, seen)), "wrapper-rules")
    discard(told)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set] = {}
        marks: dict[bytes, frozenset] = {}
        for batch in slices(batches):
            texts = []
            for page, paths, names, shared in zip(*(batch[c].to_pylist() for c in ("html", "paths", "frequent", "shared")), strict=True):
                if paths not in known:
                    known.clear() if len(known) > 1000 else None
                    known[paths] = {tuple(p) for p in json.loads(paths)}
                texts.append(main_text(page, known[paths], marks_in(names, marks), marks_in(shared, marks) or NOTHING))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    both = own.join(small(learned, most_broadcast), "host").select("page_id", "url", "html", "paths", "frequent", "shared")
    return both.mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op3_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
