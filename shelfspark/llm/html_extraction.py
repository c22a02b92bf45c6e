"""Main text of pages by consensus: containers are scored per page, their paths are voted on per host, winners are re-extracted."""

from __future__ import annotations

import html as charrefs
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfspark.llm.common import stored

#: What a container's text counts for its parent's score: an ancestor wins once the best child holds less of the text.
FADE = 0.65
#: What the score of a container named as an article is multiplied by.
NAMED = 1.2
#: Paths with at least this share of a host's votes are kept, so a host has few. Pages without one fall back on their own best.
KEPT_VOTES = 0.02
#: Of table cells on the winning path those with less than this share of the best one's score are left out.
CELL = 0.2
#: Blocks below so many characters count for a quarter: menus and notices are made of such.
SHORT = 25

# Fixed values of HTML: elements whose content is no markup, elements without content, elements without a part in the layout.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "abbr acronym b bdi bdo big cite code data del dfn em font i kbd mark q rp rt ruby s samp small strike strong sub sup time tt u var".split()
)
CONTAINED = frozenset("a ins label span".split())
NO_BLOCK = INLINE | CONTAINED | VOID | frozenset("td th html body".split())
CLOSES_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
#: A start tag on the left ends an open element on the right, as far as the nearest of the bounds.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset("p li pre tr dd dt".split())

# Elements, roles and class words of what is no article.
NO_ARTICLE_TAGS = frozenset("head nav footer aside form script style noscript template svg canvas object iframe audio video button select datalist textarea title dialog menu math".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads adsbygoogle adv alert alerts advert adverts advertisement advertising adsense banner banners billboard breadcrumb breadcrumbs comment commentlist "
    "comments consent cookie cookies copyright disqus dropdown footer gdpr login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pager paginate pagination paywall popup promo promoted promotion recommended related "
    "reply replies respond response responses rss search share sharing sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription taboola "
    "toc toolbar topbar widget widgets".split()
)
HEADER_WORDS = frozenset("header headers".split())
ARTICLE_WORDS = frozenset("article articlebody body content entry main post story text".split())
#: Class words that say the element has or lacks what the next word names.
ABOUT = frozenset("has have is no not with without hide show".split())
#: First words of classes that name the subject of an article.
SUBJECTS = frozenset("cat category keyword subject tag term topic".split())

TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)|/[^>]*+(?:>|\Z))")
ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden|style)(?![^\s=/>])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
DIGITS = re.compile(r"\d+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element that holds text: its place in the tree, what its name says, and the text found directly in it."""

    __slots__ = ("tag", "label", "parent", "path", "depth", "block", "out", "header", "parts", "score", "chars", "linked", "links")

    def __init__(self, tag: str, label: str, parent: Node | None, out: bool = False, header: bool = False):
        self.tag, self.label, self.parent, self.out, self.header = tag, label, parent, out, header
        self.path = xxhash.xxh64_intdigest(label, parent.path if parent else 0)
        self.depth = parent.depth + 1 if parent else 0
        self.block = self.depth if parent is None or tag in CLOSES_P else parent.block
        self.parts: list[Node | str] = []
        self.score = 0.0
        self.chars = self.linked = self.links = 0

    def inner(self) -> list[Node]:
        return [p for p in self.parts if type(p) is not str]


def _named(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The generalised label (tag, classes, id, numbers as 0), whether the name says it is no article, and whether a header."""
    classes, words, away = [], [], tag in NO_ARTICLE_TAGS
    if attributes and not attributes.isspace():
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), charrefs.unescape("".join(values))
            if name in ("class", "id"):
                mark = "." if name == "class" else "#"
                classes += [mark + DIGITS.sub("0", c.lower()) for c in value.split()]
                words += [[w.lower() for w in WORDS.findall(c)] for c in value.split()]
            elif name == "role":
                away = away or value.strip().lower() in NO_ARTICLE_ROLES
            elif name == "style":
                away = away or UNSEEN.search(value) is not None
            else:
                away = away or name == "hidden" or value.strip().lower() == "true"
    said = {
        w for parts in words if parts and parts[0] not in SUBJECTS for i, w in enumerate(parts)
        # of an article's own classes only the first word tells what it is
        if not (i and (parts[i - 1] in ABOUT or tag == "article"))
    } if tag != "main" else set()
    header = tag == "header" or (tag not in HEADINGS and not said.isdisjoint(HEADER_WORDS))
    return tag + "".join(sorted(set(classes))), away or not said.isdisjoint(NO_ARTICLE_WORDS), header


def parse(page: str) -> Node:
    """The tree of a page, tolerant of missing and stray tags as browsers are.

    Unclosed paragraphs, items and cells end where the next one begins; formatting elements are looked through; the
    content of scripts and the like is left out; what is not closed at the end is closed there.
    """
    root = node = Node("", "", None)
    at, end = 0, len(page)
    # the open elements of each name, outermost first
    opened: dict[str, list[Node]] = {}

    def deepest(names) -> Node | None:
        return max((opened[n][-1] for n in names if opened.get(n)), key=lambda n: n.depth, default=None)

    def closed(upto: Node) -> Node:
        """Closes all from the current element to ``upto``; the element around it."""
        here = node
        while here is not upto.parent:
            opened[here.tag].pop()
            here = here.parent
        return here

    while at < end:
        tag = TAG.search(page, at)
        if tag is None:
            node.parts.append(page[at:])
            break
        if tag.start() > at:
            node.parts.append(page[at:tag.start()])
        at = tag.end()
        if tag[1] or tag[2]:
            # a comment, which may be as short as <!-->, or a declaration
            close = page.find("-->", at - 2) + 2 if tag[1] and page.find("-->", at - 2) >= 0 else -1 if tag[1] else page.find(">", at)
            at = end if close < 0 else close + 1
            continue
        if not tag[4]:
            continue
        name = tag[4].lower()
        if opened.get("head") and (name == "body" or name in CLOSES_P or name in CONTAINED) and not tag[3]:
            node = closed(opened["head"][0])
        if name in INLINE or name in ("html", "body"):
            continue
        if tag[3]:
            found = deepest([name])
            # the end of a paragraph or of an element inside a line does not reach out of the block around it
            if found is not None and (found.depth >= node.block or not (name in CONTAINED or name == "p")):
                node = closed(found)
            elif name == "br":
                node.parts.append(" ")
            continue
        if name in CLOSES_P and opened.get("p"):
            node = closed(opened["p"][-1])
        if name in ENDS:
            names, bounds = ENDS[name]
            bound = deepest(bounds)
            while (found := deepest(names)) is not None and (bound is None or found.depth > bound.depth):
                node = closed(found)
        if name in VOID:
            if name == "br":
                node.parts.append(" ")
            elif name == "hr":
                node.parts.append(Node("hr", "hr", node, out=True))
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end if close is None else (page.find(">", close.end()) + 1 or end)
            continue
        label, away, header = _named(name, tag[5])
        node = Node(name, label, node, away or (name == "header" and node is root), header)
        node.parent.parts.append(node)
        opened.setdefault(name, []).append(node)
    return root


def _is_container(node: Node) -> bool:
    """Whether an element holds blocks rather than being one; a cell does if there is a block in it, as in pages laid out by tables."""
    if node.tag in ("td", "th"):
        return any(p.tag not in NO_BLOCK for p in node.inner())
    return node.tag not in NO_BLOCK and node.tag not in BLOCKS


def measure(root: Node) -> None:
    """Characters, linked characters and links of every element, and scores of containers, without recursion.

    Each block gives its unlinked characters to its container, and faded to the containers above; what stands in menus,
    footers, adverts and the like gives nothing.
    """
    order, stack = [], [(root, False, False)]
    while stack:
        node, away, link = stack.pop()
        if node.out and node.tag not in NO_ARTICLE_TAGS and any(p.tag == "main" for p in node.inner()):
            node.out = False  # a frame named after what else is in it
        away, link = away or node.out, link or node.tag == "a"
        order.append(node)
        node.chars = sum(len(" ".join(p.split())) for p in node.parts if type(p) is str)
        node.linked, node.links = node.chars if link else 0, int(node.tag == "a")
        node.score = 0.0 if away or link else float(node.chars)
        stack += [(p, away, link) for p in node.inner()]
    for node in reversed(order):
        if _is_container(node):
            if node.tag in ("article", "main") or not ARTICLE_WORDS.isdisjoint(WORDS.findall(node.label)):
                node.score *= NAMED
            gives = node.score * FADE
        else:
            gives, node.score = node.score, 0.0
            if node.tag in BLOCKS and node.chars < SHORT:
                gives *= 0.25
        if node.parent is not None:
            node.parent.score += gives
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.links += node.links


def scores(root: Node) -> dict[int, float]:
    """The score of each path that has one; of several containers on a path the best counts."""
    found: dict[int, float] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.score > 0:
            found[node.path] = max(found.get(node.path, 0.0), node.score)
        stack += node.inner()
    return found


def _is_menu(node: Node) -> bool:
    """A list or box of links only."""
    return node.tag in ("ul", "ol", "dl", "div", "section", "p", "table") and node.links >= 3 and node.linked >= 0.8 * node.chars


def blocks(tops: list[Node]) -> list[str]:
    """The text of the elements ``tops`` and all in them but for what is no article, one string per block."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    for top in tops:
        stack: list[Node | str | None] = [top]
        while stack:
            part = stack.pop()
            if part is None:
                flush()
            elif type(part) is str:
                line.append(charrefs.unescape(part) if "&" in part else part)
            elif part is not top and (part.out or part.header or _is_menu(part)):
                flush()
                # of a header inside an article the headings stay
                for heading in _headings(part) if not part.out and part.header else []:
                    stack += [None, heading, None]
            elif part.tag in ("td", "th"):
                stack += [" ", *reversed(part.parts), " "]
            elif part.tag in NO_BLOCK:
                stack += reversed(part.parts)
            else:
                flush()
                stack += [None, *reversed(part.parts)]
        flush()
    return out


def _headings(header: Node) -> list[Node]:
    """The headings in a header, last first."""
    found, stack = [], header.inner()
    while stack:
        node = stack.pop()
        if node.tag in HEADINGS and not node.out:
            found.append(node)
        elif not node.out:
            stack += node.inner()
    return found


def _has_title(top: Node) -> bool:
    stack = [top]
    while stack:
        node = stack.pop()
        if node.tag == "h1":
            return True
        stack += [p for p in node.inner() if not p.out]
    return False


def _title_before(top: Node) -> list[Node]:
    """The first heading in front of the container: beside it, or in the header of the article it belongs to."""
    found: list[Node] = []
    for part in top.parent.inner() if top.parent else []:
        if part is top:
            break
        own = part.header and (top.parent.tag == "article" or not ARTICLE_WORDS.isdisjoint(WORDS.findall(part.label)))
        titles = [h for h in _headings(part) if h.tag == "h1"] if own and not part.out else [part] if part.tag == "h1" and not part.out else []
        found = titles[-1:] or found
    return found


def extract(page: str, votes: dict[int, float]) -> str:
    """The text below the path on which the host's votes and the page's own scores agree best; blocks joined by a line end.

    The root of the score is taken, so that a page needs far more text elsewhere to go against its host.
    """
    root = parse(page)
    measure(root)
    own = scores(root)
    if not own:
        # only links, or nothing
        return "\n".join(blocks([root]))
    best = max(own, key=lambda path: (votes.get(path, 0.0) * own[path] ** 0.5, own[path], path))
    tops, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.path == best:
            # cells of a page laid out by a table look alike: those with hardly any text are frame
            if node.tag not in ("td", "th") or node.score >= CELL * own[best]:
                tops.append(node)
        else:
            stack += [p for p in reversed(node.inner()) if not p.out]
    if not any(_has_title(t) for t in tops):
        tops = _title_before(tops[0]) + tops
    return "\n".join(blocks(tops))


# ---- in Spark -------------------------------------------------------------------------------------------------------

VOTE = pa.schema([("host", pa.string()), ("path", pa.int64()), ("label", pa.string())])


def _signed(path: int) -> int:
    return path - (1 << 64) if path >= 1 << 63 else path


def _label(node: Node) -> str:
    """The last four steps of a path, for people who read the table of paths."""
    steps: list[str] = []
    while node.parent is not None and len(steps) < 4:
        steps.append(node.label)
        node = node.parent
    return "/".join(reversed(steps))


def best_container(page: str) -> Node | None:
    """The container with the highest score; of equal ones that with the larger path hash, then the first."""
    root = parse(page)
    measure(root)
    best, stack = None, [root]
    while stack:
        node = stack.pop()
        if node.score > 0 and (best is None or (node.score, node.path) > (best.score, best.path)):
            best = node
        stack += reversed(node.inner())
    return best


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            best = best_container(page.as_py())
            if best is not None:
                rows.append((host, _signed(best.path), _label(best)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(VOTE)], schema=VOTE)


def host_of(url: str = "url"):
    """The host of an address in lower case, without user and port; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The winning paths: one row per host and path (a hash, and its last steps) with the share of the host's votes.

    Each page votes for its best container. Votes are summed before they move, so a host with a third of all pages is a
    few rows per task. Paths with less than ``KEPT_VOTES`` of a host's votes do not win; that bounds the paths of a host,
    and pages that hold none of them are extracted by their own best container.
    """
    text = pages.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    votes = text.mapInArrow(_votes, "host string, path long, label string")
    summed = stored(votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.min("label").alias("label")), "html-votes")
    totals = summed.groupBy("host").agg(F.sum("votes").alias("total"))
    return (
        summed.join(totals, "host").filter(F.col("votes") >= KEPT_VOTES * F.col("total"))
        .select("host", "path", "label", (F.col("votes") / F.col("total")).alias("votes"))
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, cache = [], {}
        paths = batch.column("paths")
        for key, at, page in zip(batch.column("host").to_pylist(), range(len(batch)), batch.column("html")):
            if key not in cache:
                found = paths[at].as_py() or []
                cache[key] = {p["path"] % (1 << 64): p["votes"] for p in found}
            texts.append(extract(page.as_py(), cache[key]))
        names = [n for n in batch.schema.names if n not in ("host", "html", "paths")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], [*names, "text"])


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` of the article, ``n_chars``.

    The table of winning paths is written, so that Spark knows its size: below its broadcast limit it goes to every task
    and pages do not move; above it pages are shuffled by host, and Spark splits a host that is hot. Each page is then
    parsed again and the text below the winning path taken, less menus, adverts, forms, comments and the like.

    Null or empty html gives an empty text; a null url counts as the empty host, whose pages vote together; repeated rows
    give repeated rows; an empty table gives none. Ties between paths go by the page's own score, then by the larger hash.
    """
    found = host_paths(pages, url_col=url_col, html_col=html_col)
    found = stored(found.groupBy("host").agg(F.collect_list(F.struct("path", "votes")).alias("paths")), "html-paths")
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).join(found, "host", "left")
    kind = dict(rows.dtypes)
    out = rows.mapInArrow(
        _extracted, f"page_id {kind['page_id']}, url {kind['url']}, text string"
    )
    return out.withColumn("n_chars", F.length("text").cast("long"))
