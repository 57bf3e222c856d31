"""Main text of web pages by wrappers: union-free regular expressions inferred for each template of a host.

A page is a tree of block elements with texts in between. The trees of all pages of a host that
have the same way from the root to their main part are aligned one after the other. Where texts
differ, the wrapper gets a text slot; where an element is missing on either side, it becomes
optional; equal elements below one parent become one repeated group. Slots count the texts that
come most often in them.

Each page is then matched against the wrapper of its template, element by element. Texts that most of
the pages with their slot have belong to the template and go; elements named by a word that sites use for
menus or notices stay if their slots vary and link little. Where pages have no article or main
element, the part whose slots vary most and link least is the main part.

Each task aligns its own pages, and the wrappers of the tasks are merged, so structures move and no html.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gneiss.llm.common import SALTS, stored

BROADCAST_BYTES = 64 * 1024**2
#: Kinds of element below one parent, and texts counted in a slot, that a wrapper tells apart, the most frequent ones. Others
#: are matched with nothing and keep their text.
KINDS, COUNTED = 64, 256
#: Wrappers that a task holds before it passes them on, and the tasks that merge one template before the last one does.
HELD, SPREAD = 512, 64
#: Pages from which a wrapper tells what belongs to the template.
LEAST_PAGES = 3
#: Elements below this depth are blocks of their ancestor at it; their end tags are their own.
DEPTH = 100

# Element names of HTML, and words that sites use in class, id and role.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SKIPPED = set("script style noscript template iframe svg canvas object embed select option textarea button head title audio video map datalist".split())
OUTSIDE = set("nav footer aside form menu dialog".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
UNWANTED = set("ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs cookie "
               "cookies consent gdpr notice notices alert footer masthead comment comments respond disqus share sharing social related newsletter subscribe "
               "signup login popup modal overlay widget contentinfo complementary search".split())
#: Of these, words that articles use too: within the main part, text that varies over the host's pages overrules them.
WEAK = set("alert banner notice notices related search widget".split())
#: Words that say where something stands; other words next to an unwanted one, as in social-science, say what it is about.
PLACES = set("area article bar block body bottom box button buttons by col column container content feed field form grid group head heading holder icon icons in inner "
             "item items label left line link links list main module of on outer page pane panel post posts region right row section side site slot tabs text the "
             "title to toggle top unit wrap wrapper zone".split())
#: Elements of running text, which a word of a name doesn't make a menu or notice.
RUNNING = set("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption".split())
#: Elements whose texts may recur in articles: headings, labels and cells.
RECURRING = set("h1 h2 h3 h4 h5 h6 dt dd td th tr caption figcaption pre summary".split())
#: First parts of names that tell of something elsewhere, as in with-sidebar.
ABOUT = set("with without has no not is".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
MAIN = set("article main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Element:
    """A block element: its name, its mark (name, class and role), and its texts and elements in order."""

    name: str
    mark: str
    inside: list = field(default_factory=list)
    wanted: bool = True
    main: bool = False
    weak: bool = False


@dataclass
class Text:
    """A run of text within a block, and how many of its characters are in links."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def value(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def parse(page: str | None) -> Element:
    """The tree of block elements. Inline elements are dissolved; unclosed and stray tags are mended."""
    root = Element("html", "html")
    stack, links, at, skipping = [root], 0, 0, []
    # Names of open elements below the depth, and whether they are wanted.
    deep: list[tuple[str, bool]] = []
    page = page or ""

    def add(text: str) -> None:
        if text and not skipping and all(wanted for _, wanted in deep):
            inside = stack[-1].inside
            if not inside or not isinstance(inside[-1], Text):
                inside.append(Text())
            inside[-1].parts.append(text)
            inside[-1].linked += len(text) if links else 0

    def split() -> None:
        """End the running text, so that the next one starts a block."""
        if stack[-1].inside and isinstance(stack[-1].inside[-1], Text):
            stack[-1].inside.append(None)

    for token in TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag in SKIPPED:
            if token["close"]:
                if tag in skipping:
                    del skipping[skipping.index(tag) :]
            elif not token["attrs"].endswith("/") and tag not in VOID:
                skipping.append(tag)
        elif skipping and tag not in ("body", "article", "main"):
            continue
        elif tag == "a":
            links = 0 if token["close"] else 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCKS:
            skipping.clear()
            if token["close"]:
                if any(name == tag for name, _ in deep):
                    while deep.pop()[0] != tag:
                        pass
                elif any(e.name == tag for e in stack[1:]):
                    deep.clear()
                    while stack.pop().name != tag:
                        pass
                links = 0
                split()
                continue
            if tag in ("html", "body"):
                continue
            closed = CLOSES.get(tag, {"p"})
            while deep and deep[-1][0] in closed:
                deep.pop()
            while not deep and stack[-1].name in closed and len(stack) > 1:
                stack.pop()
            found = {a[0].lower(): (a[1] or a[2] or a[3]).lower() for a in ATTRIBUTE.findall(token["attrs"])}
            inner = any(e.main for e in stack)
            # Ids of headings and within the main part are anchors, named after what is written there.
            named = ("class", "role") if inner or tag in HEADINGS else ("class", "id", "role")
            names = [re.split(r"[_-]+", name) for name in " ".join(found.get(k, "") for k in named).split()]
            words = {word for parts in names if parts[0] not in ABOUT for word in parts} & UNWANTED
            # Numbers in names tell pages apart, not templates.
            mark = " ".join([tag, found.get("class", ""), found.get("role", "")]).strip()
            element = Element(tag, re.sub(r"\d+", "0", mark))
            element.main = tag in MAIN or found.get("role") in MAIN or found.get("itemprop") == "articlebody"
            placed = tag not in OUTSIDE and (tag != "header" or inner)
            element.wanted = placed and not words
            told = [parts for parts in names if parts[0] not in ABOUT and words & set(parts)]
            about = all(any(w not in UNWANTED and w not in PLACES and not w.isdigit() and w for w in parts) for parts in told)
            element.weak = placed and bool(words) and (words <= WEAK or tag in RUNNING or about)
            if tag == "hr":
                split()
            else:
                if len(stack) < DEPTH:
                    stack[-1].inside.append(element)
                    stack.append(element)
                else:
                    split()
                    deep.append((tag, element.wanted))
        # Other tags are inline and vanish.
    add(page[at:])
    return root


@dataclass
class Group:
    """A part of a wrapper: an element or a text, optional or repeated, with its own parts.

    ``pages`` is the number of pages that have it; ``often`` counts texts of a slot, never too high, so that all with more
    than a ``COUNTED``-th of its texts are there.
    """

    mark: str
    optional: bool = False
    repeated: bool = False
    constant: str | None = None
    size: int = 0
    linked: int = 0
    main: bool = False
    wanted: bool = True
    weak: bool = False
    inside: list["Group"] = field(default_factory=list)
    pages: int = 1
    often: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, item: "Element | Text") -> "Group":
        if isinstance(item, Text):
            value = item.value()
            digest = xxhash.xxh3_64_hexdigest(value)
            return cls("#", constant=digest, size=len(value), linked=item.linked, often={digest: 1})
        parts = [cls.of(x) for x in item.inside if x is not None and (isinstance(x, Element) or x.value())]
        return cls(item.mark, main=item.main, wanted=item.wanted, weak=item.weak, inside=collapse(parts))

    def merge(self, other: "Group", same_page: bool = False) -> "Group":
        """Become the expression that matches what either matches."""
        self.constant = self.constant if self.constant == other.constant else None
        self.optional, self.repeated = self.optional or other.optional, self.repeated or other.repeated
        self.size, self.linked = self.size + other.size, self.linked + other.linked
        self.main, self.wanted, self.weak = self.main or other.main, self.wanted and other.wanted, self.weak and other.weak
        self.pages = max(self.pages, other.pages) if same_page else self.pages + other.pages
        for digest, n in other.often.items():
            own = self.often.get(digest, 0)
            self.often[digest] = max(own, n) if same_page else own + n
        if len(self.often) > COUNTED:
            # What all of them can spare goes, which leaves half of the counters.
            spare = sorted(self.often.values())[len(self.often) // 2]
            self.often = {d: n - spare for d, n in self.often.items() if n > spare}
        self.inside = align(self.inside, other.inside, same_page)
        return self


def collapse(parts: list[Group], same_page: bool = True) -> list[Group]:
    """Equal elements below one parent become one repeated group, where the first of them stands."""
    out: dict[str, Group] = {}
    for part in parts:
        if part.mark in out:
            out[part.mark].merge(part, same_page).repeated = True
        else:
            out[part.mark] = part
    if len(out) <= KINDS:
        return list(out.values())
    most = set(sorted(out, key=lambda m: (-out[m].pages, m))[:KINDS])
    return [g for m, g in out.items() if m in most]


def align(a: list[Group], b: list[Group], same_page: bool = False) -> list[Group]:
    """Align two sequences by their longest common marks; what has no partner is optional.

    Partners that stand in another order are merged by ``collapse``.
    """
    if not a or not b:
        return [_optional(x) for x in a or b]
    if [x.mark for x in a] == [x.mark for x in b]:
        return [x.merge(y, same_page) for x, y in zip(a, b)]
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i].mark == b[j].mark else max(length[i + 1][j], length[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i].mark == b[j].mark:
            out.append(a[i].merge(b[j], same_page))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return collapse(out + [_optional(x) for x in a[i:] + b[j:]], same_page)


def _optional(part: Group) -> Group:
    part.optional = True
    return part


@dataclass
class Wrapper:
    """What extraction needs of a template's wrapper.

    ``path``: the marks from the root to the main part, where no element is named so. ``parts``: a tree of [texts of the
    template, whether the slots overrule a word of the name, parts by mark].
    """

    path: list[str] = field(default_factory=list)
    parts: list = field(default_factory=lambda: [[], False, {}])

    def told(self) -> bool:
        return bool(self.path or self.parts[0] or self.parts[1] or self.parts[2])


def infer(roots: list[Group]) -> Wrapper:
    """Align the pages, or wrappers of pages, of a template; pick the main part and what the template holds."""
    whole = roots[0]
    for other in roots[1:]:
        whole.merge(other)
    best: tuple[float, list[str]] = (0.0, [])

    def told(group: Group, path: list[str]) -> tuple[int, int]:
        """Characters and linked characters of the slots below a wanted group; notes the best element."""
        nonlocal best
        own, linked = 0, 0
        if not group.wanted:
            return 0, 0
        for part in group.inside:
            if part.mark == "#":
                if part.constant is None:
                    own, linked = own + part.size, linked + part.linked
            elif part.mark.startswith(("p", "h", "li", "ul", "ol", "blockquote", "pre", "table", "t", "d")) and not part.mark.startswith(("header", "div")):
                size, in_links = told(part, path)
                own, linked = own + size, linked + in_links
            else:
                told(part, [*path, part.mark])
        if own - 2 * linked > best[0]:
            best = own - 2 * linked, path
        return own, linked

    def has_main(group: Group) -> bool:
        return group.wanted and (group.main or any(has_main(g) for g in group.inside))

    def slots(group: Group) -> tuple[int, int]:
        """Characters and linked characters of all slots below a group."""
        found = [(p.size, p.linked) if p.mark == "#" and p.constant is None else slots(p) for p in group.inside]
        return sum(x[0] for x in found), sum(x[1] for x in found)

    def parts(group: Group) -> list:
        texts, inner = [], {}
        for part in group.inside:
            if part.mark == "#":
                texts += sorted(d for d, n in part.often.items() if part.pages >= LEAST_PAGES and 2 * n > part.pages)
            else:
                found = parts(part)
                if found[0] or found[1] or found[2]:
                    inner[part.mark] = found
        size, linked = slots(group) if group.weak else (0, 0)
        return [texts, size > 2 * linked, inner]

    told(whole, [])
    return Wrapper([] if has_main(whole) else best[1], parts(whole))


def mains(element: Element, named: bool = False) -> list[Element]:
    """The main elements; with ``named`` also those that are only kept out by a word of a name around them."""
    if not element.wanted and not (named and element.name not in OUTSIDE and element.name != "header"):
        return []
    return [element] if element.main else [m for e in element.inside if isinstance(e, Element) for m in mains(e, named)]


def template(root: Element) -> str:
    """A name for the template of a page: the marks down to its first main element, or those of its outer elements."""

    def way(element: Element) -> list[str] | None:
        if element.main:
            return [element.mark]
        for part in element.inside:
            if isinstance(part, Element) and (below := way(part)) is not None:
                return [element.mark, *below]
        return None

    found = way(root)
    if found is None:
        found = ["#", *sorted({e.mark for e in root.inside if isinstance(e, Element) and e.name not in RUNNING})]
    return xxhash.xxh3_64_hexdigest("\n".join(found))


def extract(page: str | None, wrapper: "Wrapper | dict[str, Wrapper] | None") -> str:
    """The main text: the blocks of the main part that the wrapper of the page's template leaves.

    Texts of the template go but for headings, labels and cells within the main part. A page of which the template would
    take more than it leaves is a copy of others, and keeps them.
    """
    root = parse(page)
    known = (wrapper.get(template(root)) if isinstance(wrapper, dict) else wrapper) or Wrapper()

    def reached(element: Element, path: list[str], parts: list) -> list[tuple[Element, list]]:
        if not path:
            return [(element, parts)]
        return [x for e in element.inside if isinstance(e, Element) and e.mark == path[0] for x in reached(e, path[1:], matched(parts, e))]

    def matched(parts: list, element: Element) -> list:
        return parts[2].get(element.mark) or [(), False, {}]

    def below(element: Element, parts: list, wanted: set[int]) -> list[tuple[Element, list]]:
        """The wanted elements with the parts of the wrapper that match them, in page order."""
        if id(element) in wanted:
            return [(element, parts)]
        return [x for e in element.inside if isinstance(e, Element) for x in below(e, matched(parts, e), wanted)]

    starts = mains(root) or mains(root, True)
    found = below(root, known.parts, {id(e) for e in starts}) if starts else reached(root, known.path, known.parts) if known.path else []
    inner = bool(found)
    blocks: list[tuple[str, bool]] = []

    def walk(element: Element, parts: list) -> None:
        texts = () if inner and element.name in RECURRING else parts[0]
        for part in element.inside:
            if isinstance(part, Element):
                own = matched(parts, part)
                if part.wanted or inner and part.weak and own[1]:
                    walk(part, own)
            elif part is not None:
                value = part.value()
                if value:
                    blocks.append((value, bool(texts) and xxhash.xxh3_64_hexdigest(value) in texts))

    for start, parts in found or [(root, known.parts)]:
        walk(start, parts)
    kept = [value for value, gone in blocks if not gone]
    size = sum(map(len, kept))
    if inner and sum(len(value) for value, _ in blocks) > 2 * size:
        kept = [value for value, _ in blocks]
    return "\n".join(kept)


def host(url: Column) -> Column:
    """The host of a url in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _to_tuple(group: Group) -> list:
    return [group.mark, group.optional, group.repeated, group.constant, group.size, group.linked, group.main, group.wanted, group.weak,
            [_to_tuple(g) for g in group.inside], group.pages, group.often]


def _from_tuple(row: list) -> Group:
    return Group(*row[:9], [_from_tuple(g) for g in row[9]], *row[10:])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrappers of each host's templates as JSON, from all of its pages.

    Each task aligns its own pages; the results are merged by up to ``SPREAD`` tasks for each template, and then by one.
    """
    columns = "host string, template string, task int, tree string"

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Group] = {}

        def passed_on() -> pa.RecordBatch:
            rows = [(name, key, json.dumps(_to_tuple(tree))) for (name, key), tree in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["host", "template", "tree"])

        for batch in batches:
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                root = parse(page.as_py())
                key, tree = (name, template(root)), Group.of(root)
                if key in held:
                    held[key].merge(tree)
                else:
                    held[key] = tree
                if len(held) >= HELD:
                    yield passed_on()
        yield passed_on()

    def merged(table: pa.Table) -> Group:
        whole = None
        for tree in sorted(table.column("tree").to_pylist()):
            group = _from_tuple(json.loads(tree))
            whole = whole.merge(group) if whole else group
        return whole

    def combine(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).set_column(3, "tree", pa.array([json.dumps(_to_tuple(merged(table)))]))

    def fit(table: pa.Table) -> pa.Table:
        found = infer([merged(table)])
        tree = [json.dumps([found.path, found.parts])] if found.told() else []
        return table.slice(0, len(tree)).select(["host", "template"]).append_column("tree", pa.array(tree, pa.string()))

    rows = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(shrink, "host string, template string, tree string")
    rows = rows.select("host", "template", (F.spark_partition_id() % SPREAD).alias("task"), "tree")
    rows = rows.groupBy("host", "template", "task").applyInArrow(combine, columns)
    rows = rows.groupBy("host", "template").applyInArrow(fit, "host string, template string, tree string")
    # Most templates tell nothing and are gone; the rest of a host come together.
    each = F.concat(F.lit('"'), "template", F.lit('":'), "tree")
    return rows.groupBy("host").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(each)), ","), F.lit("}")).alias("wrapper"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per page row: page_id, url and text, the blocks of the main text joined by ``\\n``.

    Character references are decoded, white space within a block becomes one space. A null or
    empty html gives an empty text; pages without a host share wrappers. Repeated rows and null
    ids are pages like others; an empty table gives no rows. Wrappers of up to ``BROADCAST_BYTES``
    are broadcast; larger ones are joined on the host, whose rows are spread over salts, as one
    host may have a third of all pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[str, Wrapper]] = {}
        for batch in batches:
            texts = []
            for page, text in zip(batch.column("html"), batch.column("wrapper")):
                key = text.as_py() or "{}"
                if key not in known:
                    if len(known) >= HELD:
                        known.clear()
                    known[key] = {name: Wrapper(*found) for name, found in json.loads(key).items()}
                texts.append(extract(page.as_py(), known[key]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    known = stored(wrappers(pages), "wrappers")
    size = known.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(known), "host", "left")
    else:
        spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(SALTS)).cast("int")).join(spread, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string")
