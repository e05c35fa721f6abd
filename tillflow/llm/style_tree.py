"""Main text of web pages by site style trees.

The pages of a host are merged into one tree.  An element stands under its
path, the tags and class names from the root down.  Over the pages that have
the element, the tree counts the ways it is presented (the sequence of its
children) and its contents.  The importance of a branch is the larger of the
two entropies, each divided by the largest it could be: a menu or a notice is
presented alike and says the same on all pages, an article differs.  Equal
pages of a host count once, and one page more is taken for granted on which
everything is important, so that a few pages prove little (``smoothed``).

Every text is a leaf under its element's path.  A leaf's importance is the
information of meeting its text there: 0 if every page of the host that has the
path has the text, 1 if one page has it; the mean over the path's texts is the
entropy above.  So a licence line among the paragraphs of every article goes
and the paragraphs stay.

All shown elements and texts of a page are nodes of the tree.  A block's score
is the least importance from the root down to its leaf, times a prior weight
from names: elements whose tag, role or class says menu, advert, form and the
like weigh little.  Blocks of a score below LEAST_IMPORTANCE go.  Where a page
has an article or main element, its blocks are looked at first (``chosen``).

Each page is parsed once, in time that grows as its length, whatever its
markup.  What leaves the parse are the texts of its blocks, two hashes per
container and one per leaf; counts are aggregated in two steps, so that a
host that holds a third of all pages is counted by many tasks.
"""

from __future__ import annotations

import functools
import html as markup
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import host_of
from .scratch import stored
from .words import slices

#: Blocks below this score go.
LEAST_IMPORTANCE = 0.2
#: Pages of full importance that count besides those that a path has.
PRIOR_PAGES = 1.0
#: What a block's score is multiplied by for a tag, or a name, that says it is not the page's text.
TAG_WEIGHT, NAME_WEIGHT = 0.05, 0.1

TAG_NAME = re.compile(r"[^\s/>]+")
#: A name, and perhaps a value: in quotes, which count at its start only, or up to a blank or the tag's end.
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
TAG_END = re.compile(r"[\s/]*>")
LONG_REFERENCE = re.compile(r"&#(?:[0-9]{4000,}|[xX][0-9a-fA-F]{4000,});?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd mstyle merror mpadded mphantom "
    "menclose maction mspace semantics annotation annotation-xml".split()
)
#: Tags that end an open svg, as they are no part of a drawing.
BREAKS_OUT = frozenset(
    "article aside b big blockquote body br center code dd div dl dt em embed footer form h1 h2 h3 h4 h5 h6 header hr i img li main menu meta nav ol p pre ruby s "
    "section small span strong strike sub sup table tt u ul var".split()
)
HIDDEN_TAGS = frozenset("head template svg".split())
NOISE_TAGS = frozenset("nav footer aside form button input select dialog menu audio video canvas".split())
HEAD_CONTENT = frozenset("title base basefont bgsound link meta style script noscript noframes template".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table div section article main body td".split())
CLOSABLE = frozenset({"p"}.union(*CLOSES.values()))
BARS = frozenset("article main body".split())

# Names in classes, ids and roles that say that a branch is not the page's text.
NOISE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer ad ads adv advert adverts advertisement advertising adsense banner sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login search "
    "form comment comments discussion disqus respond replies reply share sharing social related recommended pagination pager toolbar widget copyright "
    "complementary contentinfo masthead topbar skip".split()
)
HEADER_NAMES = frozenset({"header"})
#: Parts of a name that turn it into a word about the layout or the page: no-sidebar, has-menu, search-results.
NEGATING, LAYOUT = frozenset("no non not without has have with".split()), frozenset("result results".split())


#: Contents are hashed as sequences, modulo a prime, so that those of an element follow from its parts'.
PRIME, STEP = (1 << 61) - 1, 0x1F3D5B79A2C4E6


class Element:
    """An element of full weight is 1, of a branch that is not shown 0."""

    __slots__ = ("tag", "path", "weight", "article", "parent", "number", "children", "content", "factor")

    def __init__(self, tag: str, path: int, weight: float, article: bool, parent: Element | None):
        self.tag, self.path, self.weight, self.article, self.parent = tag, path, weight, article, parent
        self.number = -1  # among the page's containers, once it or something in it has text
        self.children: list[str] = []
        self.content, self.factor = 0, 1

    def says(self, content: int, factor: int) -> None:
        """Appends a sequence of texts."""
        self.content, self.factor = (self.content * factor + content) % PRIME, self.factor * factor % PRIME


def unescaped(text: str) -> str:
    """Character references decoded; numbers of thousands of digits, which stand for nothing, are one replacement character."""
    return markup.unescape(LONG_REFERENCE.sub("\ufffd", text) if "&#" in text else text)


def attributes_at(html: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes of the tag whose name ends at ``at``, whether it ends in a slash, and where the tag ends; -1 if it doesn't.

    A value in quotes that are never closed ends as one without quotes.  A quote
    that is looked for in vain was the page's last, so this happens once.
    """
    found: dict[str, str] = {}
    while not (end := TAG_END.match(html, at)):
        m = ATTRIBUTE.match(html, at)
        if not m:
            return found, False, -1
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), value)
        at = m.end()
    return found, "/" in end[0], end.end()


def names_of(attributes: dict[str, str]) -> set[str]:
    """Parts of classes, id and roles that say what the element is."""
    found: set[str] = set()
    for name in " ".join(attributes.get(a, "") for a in ("class", "id", "role")).split():
        parts = [n.lower() for n in NAME_PARTS.findall(name)]
        if parts and parts[0] not in NEGATING and parts[-1] not in LAYOUT:
            found.update(parts)
        if name.lower() == "hidden":
            found.add("hidden")
    return found


def not_shown(attributes: dict[str, str]) -> bool:
    if attributes.get("hidden", "false").lower() != "false":
        return True
    style = [d.partition(":") for d in attributes.get("style", "").lower().split(";")]
    shown = [value.split("!")[0].strip() for name, _, value in style if name.strip() == "display"]
    return bool(shown) and shown[-1] == "none"


@functools.cache
def raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I)


def leaf_of(path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path}:{text}") >> 1


class Page:
    """Blocks of text (in an article, weight, container, leaf, text) and the elements of a page, from one pass over its markup."""

    def __init__(self, html: str):
        self.blocks: list[tuple[bool, float, int, int, str]] = []
        self.elements: list[Element] = []
        self.containers: list[Element] = []
        self.stack = [Element("", 0, 1.0, False, None)]
        #: depths of the open elements of each tag, of those that bar an end tag, and of those that a start tag may close or stop at
        self.open: dict[str, list[int]] = {}
        self.bars: list[int] = [0]
        self.closable: list[int] = []
        self.text: list[str] = []
        at, size = 0, len(html)
        while at < size:
            start = html.find("<", at)
            if start < 0 or start + 1 == size:
                break
            kind = html[start + 1]
            if html.startswith("<!--", start):
                self.text.append(html[at:start])
                end = html.find("-->", start + 4)
                at = end + 3 if end >= 0 else size
            elif kind in "!?":
                self.text.append(html[at:start])
                end = html.find(">", start)
                at = end + 1 if end >= 0 else size
            elif (kind.isascii() and kind.isalpha()) or (kind == "/" and html[start + 2 : start + 3].isascii() and html[start + 2 : start + 3].isalpha()):
                self.text.append(html[at:start])
                at = self.tag(html, start)
            else:
                self.text.append(html[at : start + 1])
                at = start + 1
        if at < size:
            self.text.append(html[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()
        self.elements.append(self.stack[0])

    def tag(self, html: str, start: int) -> int:
        """Handles the tag at ``start``; where the markup goes on.  A tag that the end of the page cuts off is none."""
        closing = html[start + 1] == "/"
        name = TAG_NAME.match(html, start + 1 + closing)
        tag = name[0].lower()
        attributes, empty, at = attributes_at(html, name.end())
        if at < 0:
            return len(html)
        if closing:
            self.end(tag)
        elif tag in RAW and not (empty and self.stack[-1].tag == "svg"):
            close = raw_end(tag).search(html, at)
            at = close.end() if close else len(html)
        else:
            self.start(tag, attributes, empty)
        return at

    def flush(self) -> None:
        """Ends a block: the text so far belongs to the innermost open element."""
        text = " ".join(unescaped("".join(self.text)).split())
        self.text = []
        if text:
            self.close_head()
        top = self.stack[-1]
        if text and top.weight:
            up = top
            while up is not None and up.number < 0:
                up.number = len(self.containers)
                self.containers.append(up)
                up = up.parent
            self.blocks.append((top.article, top.weight, top.number, leaf_of(top.path, text), text))
            top.says(xxhash.xxh3_64_intdigest(text) % PRIME, STEP)

    def close_head(self) -> None:
        """A head ends, closed or not, where anything starts that is no head content."""
        if self.stack[-1].tag == "head":
            self.leave()

    def enter(self, element: Element) -> None:
        depth = len(self.stack)
        self.open.setdefault(element.tag, []).append(depth)
        if element.tag in BARS:
            self.bars.append(depth)
        if element.tag in SCOPES or element.tag in CLOSABLE:
            self.closable.append(depth)
        self.stack.append(element)

    def leave(self) -> Element:
        element, depth = self.stack.pop(), len(self.stack)
        self.open[element.tag].pop()
        for depths in (self.bars, self.closable):
            if depths and depths[-1] == depth and depth:
                depths.pop()
        return element

    def pop(self) -> None:
        self.flush()
        element = self.leave()
        if element.weight:
            self.elements.append(element)
            # a branch that weighs less says nothing of those around it
            if element.weight == element.parent.weight:
                element.parent.says(element.content, element.factor)

    def start(self, tag: str, attributes: dict[str, str], empty: bool) -> None:
        if tag not in HEAD_CONTENT:
            self.close_head()
        if self.stack[-1].tag == "svg":
            if tag in BREAKS_OUT:
                self.pop()
            elif tag != "svg":
                return
        if tag == "svg" and empty:
            return
        if tag in ("mtd", "mspace"):
            self.text.append(" ")
        if tag == "br":
            self.text.append(" ")
        if tag in VOID or tag in INLINE:
            if tag in ("hr", "img"):
                self.text.append(" ")
            return
        self.flush()
        closed = CLOSES.get(tag, frozenset())
        at = len(self.closable) - 1
        while at >= 0:
            depth = self.closable[at]
            open_ = self.stack[depth].tag
            if open_ == "p" or open_ in closed:
                while len(self.stack) > depth:
                    self.pop()
                if not closed:
                    break
            elif open_ in SCOPES:
                break
            at -= 1
        parent = self.stack[-1]
        names = names_of(attributes)
        article = parent.article or tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article")
        weight = parent.weight
        if tag not in ("html", "body"):
            if tag in HIDDEN_TAGS or not_shown(attributes):
                weight = 0.0
            elif tag == "form":  # may hold the whole page
                weight *= NAME_WEIGHT
            elif tag in NOISE_TAGS or (tag == "header" and not parent.article):
                weight *= TAG_WEIGHT
            elif tag not in ("article", "main") and not (NOISE_NAMES | {"hidden"}).isdisjoint(names) or (not parent.article and not HEADER_NAMES.isdisjoint(names)):
                weight *= NAME_WEIGHT
        named = f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}"
        path = xxhash.xxh3_64_intdigest(f"{parent.path}/{named}") >> 1
        parent.children.append(named)
        self.enter(Element(tag, path, weight, article, parent))

    def end(self, tag: str) -> None:
        if tag in INLINE or tag in VOID:
            return
        self.flush()
        depths = self.open.get(tag)
        if depths and (depths[-1] >= self.bars[-1] or tag in ("body", "html")):
            depth = depths[-1]
            while len(self.stack) > depth:
                self.pop()

    def main_blocks(self, scores: list[float] | None = None) -> list[str]:
        """The texts of the page, by its blocks' scores; without, by their weights."""
        rows = zip(self.blocks, scores or [b[1] for b in self.blocks], strict=True)
        return chosen([(article, score, text) for (article, *_, text), score in rows])


def chosen(blocks: list[tuple[bool, float, str]]) -> list[str]:
    """Of blocks (in an article, score, text) those of the page's text: in articles of a full score, else of a full score.

    An article inside a branch with a name of noise may be the page's own,
    with its wrapper named after the layout, or a teaser beside the text;
    the longer of it and the text of full score outside is taken.  If every
    block is below, those with the best score stay.
    """
    inside = [b for b in blocks if b[0]]
    full = [b for b in blocks if b[1] >= LEAST_IMPORTANCE]
    found = [b for b in full if b[0]] or full
    if inside and not any(b[0] for b in full):
        most = max(b[1] for b in inside)
        wrapped = [b for b in inside if b[1] >= most]
        long = lambda blocks: sum(len(b[2]) for b in blocks)
        # below two names, or below a tag of noise, it is a teaser
        if not full or most >= NAME_WEIGHT and long(wrapped) > long(full):
            found = wrapped
    if not found and blocks:
        most = max(b[1] for b in blocks)
        found = [b for b in blocks if b[1] >= most]
    return [text for *_, text in found]


def parsed(pages: DataFrame) -> DataFrame:
    """Per page (key, url, host, html): its blocks as a row, and a row for each of its nodes.

    A container has path, presentation and content; a leaf has its element's
    path, no presentation, and its own name as content.  A page's containers
    are ``nodes`` (paths), each with the number of the one around it in ``up``
    (-1: none); a block has its container's number and its leaf.
    """
    key = pages.schema["key"].dataType.simpleString()
    block = pa.struct([("article", pa.bool_()), ("weight", pa.float64()), ("node", pa.int32()), ("leaf", pa.int64()), ("text", pa.string())])
    hashed = lambda x: xxhash.xxh3_64_intdigest(x) >> 1

    def nodes_of(page: Page) -> list[dict]:
        paths = {c.path for c in page.containers}
        found: dict[int, list[Element]] = {}
        for element in page.elements:
            if element.path in paths:
                found.setdefault(element.path, []).append(element)
        made = []
        for path, same in found.items():
            whole = Element("", 0, 1.0, False, None)
            for e in same:
                whole.says(e.content, e.factor)
            made.append({"path": path, "shown": hashed("|".join(c for e in same for c in e.children)), "said": whole.content})
        return made + [{"path": p, "said": leaf} for p, leaf in {(page.containers[n].path, leaf) for _, _, n, leaf, _ in page.blocks}]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "html"):
            rows: dict[str, list] = {c: [] for c in ("of", "row", "host", "page", "path", "shown", "said", "blocks", "nodes", "up")}
            for i, (host, html) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                page, n = Page(html), n + 1
                own = {"of": i, "row": (part << 40) + n, "host": host, "page": hashed(html)}
                whole = {
                    "blocks": [dict(zip(("article", "weight", "node", "leaf", "text"), b, strict=True)) for b in page.blocks],
                    "nodes": [c.path for c in page.containers], "up": [c.parent.number if c.parent else -1 for c in page.containers],
                }
                for row in [*nodes_of(page), whole]:
                    row = own | row
                    for c, values in rows.items():
                        values.append(row.get(c))
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.list_(block), pa.list_(pa.int64()), pa.list_(pa.int32())]
            columns = [pa.array(rows[c], k) for c, k in zip(list(rows)[1:], kinds, strict=True)]
            whole = pa.array([b is not None for b in rows["blocks"]], pa.bool_())
            # nodes need neither key nor address
            page_of = pa.array([i if b is not None else None for i, b in zip(rows["of"], rows["blocks"], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(page_of), batch.column("url").take(page_of), whole, *columns], ["key", "url", "whole", *list(rows)[1:]])

    return pages.mapInArrow(
        task, f"key {key}, url string, whole boolean, row bigint, host string, page bigint, path bigint, shown bigint, said bigint, "
        "blocks array<struct<article:boolean,weight:double,node:int,leaf:bigint,text:string>>, nodes array<bigint>, up array<int>",
    )


def judged(rows: DataFrame) -> DataFrame:
    """(key, url, text) of pages (key, url, blocks, nodes, up) with the importance of their low nodes (map ``low``, null: none)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("key", "url").schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for blocks, nodes, up, low in zip(*(batch.column(c).to_pylist() for c in ("blocks", "nodes", "up", "low")), strict=True):
                least = dict(low or [])
                worth = [least.get(n, 1.0) for n in nodes]
                for i in by_depth(up) if least else []:
                    if up[i] >= 0:
                        worth[i] = min(worth[i], worth[up[i]])
                scored = [(b["article"], b["weight"] * min(worth[b["node"]], least.get(b["leaf"], 1.0)), b["text"]) for b in blocks]
                texts.append(" ".join(chosen(scored)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], ["key", "url", "text"])

    return rows.select("key", "url", "blocks", "nodes", "up", "low").mapInArrow(task, f"{schema}, text string")


def by_depth(up: list[int]) -> list[int]:
    """Containers so that each comes after the one around it."""
    inner: list[list[int]] = [[] for _ in up]
    order = []
    for i, above in enumerate(up):
        if above < 0:
            order.append(i)
        else:
            inner[above].append(i)
    for i in order:  # grows while it is gone through
        order.extend(inner[i])
    return order


def importance(containers: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of containers (host, page, path, shown, said), equal pages counted once."""
    once = containers.select("host", "path", "page", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("shown").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("said").alias("value")))).alias("v"))
    once = once.select("host", "path", "page", "v.kind", "v.value").distinct()
    counts = once.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("logs"))
    entropy = F.when(F.col("pages") > 1, 1 - F.col("logs") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    return sums.groupBy("host", "path").agg(F.max("pages").alias("pages"), F.max(entropy).alias("importance"))


def smoothed(importance_: Column) -> Column:
    """Importance with PRIOR_PAGES pages of full importance added to a path's pages."""
    return (F.col("pages") * importance_ + PRIOR_PAGES) / (F.col("pages") + PRIOR_PAGES)


def low_nodes(nodes: DataFrame, least: float) -> DataFrame:
    """(host, node, importance) of the containers and leaves whose smoothed importance is below ``least``.

    Leaves of one page are left out before they meet their path, so that a path
    with many texts is no hot key: on one page's word nothing is low.
    """
    paths = stored(importance(nodes.where("shown IS NOT NULL")), "paths")
    leaves = nodes.where("shown IS NULL").select("host", "path", "said", "page").distinct().groupBy("host", "path", "said").agg(F.count("*").alias("n"))
    leaves = leaves.where(F.col("n") > 1).join(paths.select("host", "path", "pages"), ["host", "path"])
    information = smoothed(F.when(F.col("pages") > 1, 1 - F.log("n") / F.log("pages")).otherwise(1.0))
    found = leaves.select("host", F.col("said").alias("node"), information.alias("importance"))
    found = found.unionByName(paths.select("host", F.col("path").alias("node"), smoothed(F.col("importance")).alias("importance")))
    return found.where(F.col("importance") < least)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: float = LEAST_IMPORTANCE) -> DataFrame:
    """One row per row of ``pages``: key, url, text (empty if none).

    Character references are decoded, white space in a block is one space,
    blocks are joined by one space in page order.  Null and empty html give the
    empty text; pages without url are one host.  Repeated rows stay.  If every
    block of a page is of low score, those with the best stay.  Attribute
    values whose quotes are never closed end at the tag's end; a tag that the
    end of the page cuts off is dropped.  Other columns are not read.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    table = stored(parsed(rows), "blocks", by="whole")
    low = stored(low_nodes(table.where(~F.col("whole")), least), "low")
    whole = table.where("whole")
    # Written, so that its size is known and few removals don't move the texts.
    names = F.array_union("nodes", F.transform("blocks", lambda b: b["leaf"]))
    met = whole.select("row", "host", F.explode(names).alias("node")).join(low, ["host", "node"])
    of_row = stored(met.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("node", "importance"))).alias("low")), "low_of_rows")
    found = judged(whole.join(of_row, "row", "left"))
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text")
