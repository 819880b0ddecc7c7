"""Main text of web pages by a site style tree.

Pages of a host are merged into one tree: an element is known by its path of tags with
class, id, role and place among its like. Two entropies tell how much a branch matters. Presentation: how
evenly the pages of the host spread over the child sequences seen under it (one fixed
layout says little). Content: how evenly each text below it spreads over the pages (a
text on every page says nothing, one that is on a single page says most). A branch's
importance joins the two, children weighing with their texts; a branch is cut if it and
all branches below it are of low importance. A single text is a leaf of its path and is
judged alike, so that a line of every page goes out of a path that also holds the text.

All branches that show text enter the tree, also those inside an article. Names are a
prior. What the markup names as navigation, notice, advert, form, comment and the like
stays only with an importance near the highest, and goes on a host with too few pages for
entropies. Names are whole class words or ids, and a name says nothing where the branch holds
the page's longest article or main (one outside of named branches, if there is any). On a page
without an article, a form, header or the like that holds paragraphs, and in them most of the
page's text, wraps its main text. Comments, notices, menus and adverts never do, however long.
A page of nothing but named parts has no main text. In an article the entropies may cut up to three quarters of a page's text; where
they would take more, the page is a variant of others and not a layout. Pages count once for
each main text on a host, so copies of an article are no layout either.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import broadcast_if_small, slices
from tabulark.session import stage_table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# HTML's element kinds
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dir", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul",
}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# What is never shown as text
UNSHOWN = {
    "script", "style", "noscript", "template", "head", "title", "textarea", "input", "iframe", "object",
    "embed", "svg", "canvas", "audio", "video", "noembed", "noframes", "xmp", "map", "datalist",
}
# Markup that names its content as no part of the main text
NOISE_TAGS = {
    "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset",
}
NOISE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
    "alertdialog", "alert", "menu", "menubar", "toolbar", "tablist",
}
NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
    "disclaimer", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
    "widget", "widgets",
}
# Names that pages also give to what wraps their main text
WRAPPERS = {
    "banner", "form", "header", "modal", "overlay", "respond", "sidebar", "toolbar", "topbar", "widget",
    "widgets",
}
KEPT_TAGS = {"article", "main"}
# elements of running text
PROSE_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
# elements that repeat with the text: their number among siblings says nothing
TEXT_TAGS = {
    "p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "dt", "dd", "blockquote", "pre",
    "option",
}

# a branch that is named as noise has to differ from page to page in texts and in layout
LOW, NAMED_LOW, LEAST_PAGES, DECAY = 0.25, 0.95, 4, 0.9


class Element:
    """An open element. roots: paths of the named branches around it, itself included;
    marks: those of them that are inline, since the last block; home: the block's path;
    article: number of the outermost article or main around it, or -1."""

    __slots__ = ("article", "home", "marks", "noise", "order", "path", "roots", "tag", "tags")

    def __init__(
        self, tag: str, path: str, noise: bool, article: int, roots: tuple = (), marks: tuple = (),
        home: str | None = None,
    ):
        self.tag, self.path, self.noise, self.article = tag, path, noise, article
        self.roots, self.marks, self.home = roots, marks, path if home is None else home
        self.tags: list[str] = []
        self.order: dict[str, int] = {}


class Block(NamedTuple):
    """A text block; text is without the named inline branches, parts has (raw text, their
    paths) if there are any; roots are the named branches around it; article is the number of
    the outermost article or main around it, or -1."""

    path: str
    text: str
    parts: list[tuple[str, tuple]] | None
    article: int
    roots: tuple


class Page(NamedTuple):
    blocks: list[Block]
    layouts: dict[str, str]
    named: set[str]  # paths of the named branches


def unshown(tag: str, attributes: dict[str, str]) -> bool:
    return tag in UNSHOWN or "hidden" in attributes


def named_noise(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in NOISE_TAGS or (tag == "header" and not inside):
        return True
    if attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    names = set(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split())
    if inside:  # the headline of an article
        names.discard("header")
    return not NOISE_WORDS.isdisjoint(names)


def clean(raw: str) -> str:
    if "&" in raw:
        raw = html.unescape(raw)
    return " ".join(raw.split())


def without(block: Block, void: set[str]) -> Block:
    """The block without the named branches in void around it."""
    roots = tuple(r for r in block.roots if r not in void)
    if block.parts is None or not any(void.intersection(m) for _, m in block.parts):
        return block._replace(roots=roots)
    parts = [(t, tuple(r for r in marks if r not in void)) for t, marks in block.parts]
    text = clean("".join([t for t, marks in parts if not marks]))
    return block._replace(
        text=text, roots=roots, parts=parts if any(marks for _, marks in parts) else None
    )


def wrapper(path: str) -> bool:
    """Whether all that names the branch as noise are names of wrappers."""
    name, _, _ = path.rpartition(">")[2].rpartition("[")
    words = set((name or path.rpartition(">")[2]).lower().replace(".", " ").split())
    return words.isdisjoint((NOISE_TAGS | NOISE_ROLES | NOISE_WORDS) - WRAPPERS)


def overruled(blocks: list[Block], holders: list[tuple]) -> set[str]:
    """The named branches whose name says nothing on this page: those that hold its longest
    article or main, one outside of named branches if there is any with text; on a page
    without an article, wrappers whose paragraphs are more than half of the page's text.
    holders: the named branches around each article."""
    prose: dict[str, int] = {}
    articles = [0] * len(holders)
    total = 0
    for b in blocks:
        n = len(b.text)
        total += n + sum(len(clean(t)) for t, marks in b.parts or () if marks)
        if b.article >= 0:
            articles[b.article] += n
        if b.roots and b.path.rpartition(">")[2].partition(".")[0] in PROSE_TAGS:
            for r in b.roots:
                prose[r] = prose.get(r, 0) + n
    free = [k for k, n in enumerate(articles) if n and not holders[k]]
    if free:
        return set()
    if any(articles):
        # an article among comments is a comment
        inside = holders[articles.index(max(articles))]
        return set(inside) if all(map(wrapper, inside)) else set()
    return {r for r, n in prose.items() if 2 * n > total and wrapper(r)}


def parse_page(page: str) -> Page:
    """Text blocks in page order, and the sequence of child elements of each path."""
    root = Element("", "", False, -1)
    stack = [root]
    blocks: list[Block] = []
    layouts: dict[str, str] = {}
    named: dict[str, int] = {}
    holders: list[tuple] = []
    pending: list[tuple[str, tuple]] = []
    at, n = 0, len(page)

    def flush() -> None:
        if pending:
            text = clean("".join([t for t, marks in pending if not marks]))
            parts = list(pending) if any(marks for _, marks in pending) else None
            pending.clear()
            if text or parts:
                e = stack[-1]
                roots = e.roots[: len(e.roots) - len(e.marks)]
                blocks.append(Block(e.home, text, parts, e.article, roots))

    def close(count: int) -> None:
        flush()
        for _ in range(count):
            e = stack.pop()
            if not e.noise:
                layouts[e.path] = ",".join(e.tags)

    while at < n:
        m = TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at and not stack[-1].noise:
            pending.append((page[at:stop], stack[-1].marks))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        top = stack[-1]
        if tag in INLINE and (m[1] or not m[3].strip() or top.noise):
            # only inline elements that are hidden or named, and what nests in them, are on the stack
            if top.tag == tag and m[1]:
                stack.pop()
                if not top.noise:
                    layouts[top.path] = ",".join(top.tags)
            elif top.tag == tag:
                stack.append(top)
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(len(stack) - depth)
                    break
            continue
        if tag in VOID:
            if not top.noise:
                if tag == "hr":
                    flush()
                else:
                    pending.append((" ", top.marks))
            continue
        attributes = {
            k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[3])
        } if m[3].strip() else {}
        noise = top.noise or unshown(tag, attributes)
        name_says = not noise and named_noise(tag, attributes, top.article >= 0)
        if tag in INLINE and not noise and not name_says:
            if top.tag == tag:  # its end must not close the named one
                stack.append(top)
            continue
        if tag not in INLINE:
            flush()
            closing = {"p"} if tag in CLOSES_P else SIBLINGS.get(tag, set())
            for depth in range(len(stack) - 1, 0, -1):
                e = stack[depth]
                if e.tag in closing:
                    close(len(stack) - depth)
                    break
                if e.tag in ("div", "article", "section", "ul", "ol", "table", "td", "body", "main"):
                    break
            top = stack[-1]
            noise = noise or top.noise
        name = tag
        for key in ("class", "id", "role"):
            if attributes.get(key):
                name += f".{' '.join(attributes[key].replace('>', ' ').split())}"
        if not top.noise:
            if not top.tags or top.tags[-1] != name:
                top.tags.append(name)
        if tag not in TEXT_TAGS:
            top.order[name] = place = top.order.get(name, 0) + 1
            name += f"[{place}]"
        path = f"{top.path}>{name}"
        own = (path,) if name_says and not noise else ()
        for p in own:
            named.setdefault(p, top.article)
        inline, article = tag in INLINE, top.article
        if tag in KEPT_TAGS and article < 0 and not noise:
            article = len(holders)
            holders.append(top.roots)
        stack.append(Element(
            tag, path, noise, article, top.roots + own,
            top.marks + own if inline else (), top.home if inline else None,
        ))
        if tag in RAW and not page[at - 2 : at] == "/>":
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            stack.pop()
            at = end.end() if end else n
    close(len(stack) - 1)
    flush()
    if named:
        void = overruled(blocks, holders)
        if void:
            blocks = [without(b, void) for b in blocks]
            return Page([b for b in blocks if b.text or b.parts], layouts, named.keys() - void)
    return Page(blocks, layouts, set(named))


def parse(page: str) -> tuple[list[tuple[str, str, bool]], dict[str, str]]:
    """(blocks, layouts) of a page as the names alone have it: blocks are (path, text, whole)
    in page order, without what the markup names as noise; whole marks blocks of an article."""
    found = parse_page(page)
    blocks = [(b.path, b.text, b.article >= 0) for b in found.blocks if b.text and not b.roots]
    return blocks, found.layouts


def ancestors(path: str) -> list[str]:
    found = []
    while path:
        found.append(path)
        path = path.rpartition(">")[0]
    return found


def text_of(block: Block, stay: set[str]) -> str:
    """The block's text with the named inline branches that stay."""
    if block.parts is None or not stay:
        return block.text
    return clean("".join([t for t, marks in block.parts if stay.issuperset(marks)]))


def line_name(path: str, text: str) -> str:
    """Name of one text below a path, as :func:`judged` has it."""
    import xxhash

    return f"{path}\n{xxhash.xxh3_64_intdigest(text) >> 1}"


def main_blocks(page: Page, cut: set[str], stay: set[str], lines: set[str]) -> list[str]:
    """Texts that stay: named branches only if in ``stay``, others unless their importance
    or that of their text is low; in articles at most three quarters go that way."""
    found = []
    for b in page.blocks:
        if stay.issuperset(b.roots):
            text = text_of(b, stay)
            if text:
                low = bool(cut) and not cut.isdisjoint(ancestors(b.path))
                low = low or (bool(lines) and line_name(b.path, b.text) in lines)
                found.append((text, low, b.article >= 0))
    whole = sum(len(t) for t, _, w in found if w)
    variant = 4 * sum(len(t) for t, low, w in found if w and low) > 3 * whole
    kept = [t for t, low, w in found if not low or (w and variant)]
    return kept or [t for t, _, _ in found]


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


FEATURES = "host string, path string, named boolean, node long, kind int, value long, page long"


def style_features(pages: DataFrame) -> DataFrame:
    """Rows for each page: the child sequence of each path (kind 0, with host, path and
    whether it is a named branch) and the texts right below a path (kind 1, by ``node``, the
    path's hash, alone). page is the hash of the text that the names leave, so that
    copies can count once. pages: host, html."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def number(x: str) -> int:
            return xxhash.xxh3_64_intdigest(x) >> 1

        for part in slices(batches, "html"):
            rows: list[tuple] = []
            for host, page in zip(
                part.column("host").to_pylist(), part.column("html").to_pylist()
            ):
                found = parse_page(page or "")
                own = number("\n".join([b.text for b in found.blocks if not b.roots]))
                node = {p: number(f"{host}\n{p}") for p in found.layouts}
                rows += [
                    (host, p, p in found.named, node[p], 0, number(s), own)
                    for p, s in found.layouts.items() if p
                ]
                texts = {(b.path, b.text) for b in found.blocks if b.path and b.text}
                for b in found.blocks:
                    for t, marks in b.parts or ():
                        if marks and not t.isspace():
                            texts.add((marks[-1], clean(t)))
                rows += [(None, None, None, node[p], 1, number(t), own) for p, t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in
                 enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(),
                            pa.int64()))],
                ["host", "path", "named", "node", "kind", "value", "page"],
            )

    return pages.mapInArrow(features, FEATURES)


def upwards(path: str = "path"):
    """The path and those above it, as rows."""
    parts = F.split(path, ">")
    return F.explode(F.transform(
        F.sequence(F.lit(2), F.size(parts)), lambda i: F.concat_ws(">", F.slice(parts, 1, i))
    ))


def count_features(features: DataFrame) -> DataFrame:
    """``node, kind, value, c, host, path, named``: c is the number of distinct pages."""
    carried = [F.max(k).alias(k) for k in ("host", "path", "named")]
    once = features.groupBy("node", "kind", "value", "page").agg(*carried)
    return once.groupBy("node", "kind", "value").agg(F.count("*").alias("c"), *carried)


def node_importance(counts: DataFrame, decay: float = DECAY) -> DataFrame:
    """``host, path, named, pages, importance`` of the style nodes that hold text.

    With m pages, a text on c of them has content entropy log(c)/log(m); content importance
    is the mean of one minus that over all texts of the branch. Presentation importance is
    the entropy, to base m, of the child sequences of the node, and has the weight that
    ``decay`` leaves. A node of one page has importance 1.
    """
    c = F.col("c").cast("double")
    layout = counts.where("kind = 0").groupBy("node").agg(
        F.sum("c").alias("pages"), F.sum(c * F.log(c)).alias("clog"),
        *[F.max(k).alias(k) for k in ("host", "path", "named")],
    )
    own = counts.where("kind = 1").groupBy("node").agg(
        F.count("*").alias("texts"), F.sum(F.log(c)).alias("logs")
    )
    texts = (
        layout.join(own, "node").select("host", upwards().alias("path"), "texts", "logs")
        .groupBy("host", "path").agg(F.sum("texts").alias("texts"), F.sum("logs").alias("logs"))
    )
    m = F.col("pages").cast("double")
    content = F.lit(1.0) - F.col("logs") / (F.col("texts") * F.log(m))
    presentation = F.lit(1.0) - F.col("clog") / (m * F.log(m))
    return layout.join(texts, ["host", "path"]).select(
        "host", "path", "named", "pages",
        F.when(F.col("pages") == 1, 1.0)
        .otherwise((1 - decay) * presentation + decay * content).alias("importance"),
    )


def judged(
    counts: DataFrame, low: float = LOW, least_pages: int = LEAST_PAGES,
    named_low: float = NAMED_LOW, decay: float = DECAY,
) -> DataFrame:
    """``host, what, name``: branches that are cut (what 'cut'), named branches that stay
    ('stay') and single texts that are cut ('line')."""
    nodes = stage_table(node_importance(counts, decay), "nodes")
    seen = nodes.where(F.col("pages") >= least_pages)
    highest = nodes.select("host", upwards().alias("path"), "importance").groupBy(
        "host", "path").agg(F.max("importance").alias("highest"))
    cut = seen.where(F.col("importance") < low).join(highest, ["host", "path"]).where(
        F.col("highest") < low)
    stay = seen.where(F.col("named") & (F.col("importance") >= named_low))
    layout = counts.where("kind = 0").groupBy("node").agg(
        F.sum("c").alias("pages"), F.max("host").alias("host"), F.max("path").alias("path")
    ).where(F.col("pages") >= least_pages)
    content = F.lit(1.0) - F.log(F.col("c").cast("double")) / F.log(F.col("pages").cast("double"))
    lines = (
        counts.where("kind = 1 AND c > 1").select("node", "value", "c").join(layout, "node")
        .where(decay * content < low)
    )
    return (
        cut.select("host", F.lit("cut").alias("what"), F.col("path").alias("name"))
        .union(stay.select("host", F.lit("stay"), "path"))
        .union(lines.select("host", F.lit("line"), F.concat_ws("\n", "path", "value")))
    )


def judgement(
    rows: DataFrame, low: float = LOW, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """:func:`judged` of pages (host, html)."""
    counts = stage_table(count_features(style_features(rows.select("host", "html"))), "counts")
    return judged(counts, low, least_pages)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    low: float = LOW, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``id, url, text, n_chars`` of every page.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined in page order by a line break. A null or empty page gives an empty
    text, a null url counts as a host of its own. Branches are cut below importance
    ``low`` on hosts that show them on ``least_pages`` distinct pages or more, unless that would
    leave nothing of what the names leave; a page of named parts alone has an empty text. Repeated rows are pages like any other; other
    columns are not read.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"),
    )
    kinds = ("cut", "stay", "line")
    said = stage_table(
        judgement(rows, low, least_pages).groupBy("host").agg(
            *[F.collect_set(F.when(F.col("what") == k, F.col("name"))).alias(k) for k in kinds]
        ),
        "cut",
    )
    # a host's lists have its style nodes only: as long as its layouts differ, not its pages
    joined = rows.join(broadcast_if_small(said, 20_000), "host", "left").select(
        "id", "url", "html", *kinds
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = []
            lists = [part.column(k).to_pylist() for k in kinds]
            for page, *said in zip(part.column("html").to_pylist(), *lists):
                texts.append("\n".join(main_blocks(parse_page(page or ""), *[set(x or ()) for x in said])))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    found = joined.mapInArrow(extract, f"id {id_type}, url string, text string, n_chars long")
    return found.withColumnRenamed("id", id_col)
