"""Main text of web pages: site templates are element subtrees that recur across a host's pages.

A first pass hashes the element subtrees of every page in two ways: with their text, and by structure alone (tag,
class, id, role and place in the page, and the kinds of its children, however many). Spark counts on how many distinct
pages of its host each occurs, and on how many of them outside the main part. A second pass deletes the subtrees that
recur on the host, then those whose tag or role says that they are no text, and joins the blocks that are left of the
main part: the article or articles, else the main element, else the part that holds most of the page's text outside
links.

Structure alone only tells menus, adverts and the like, which are named or full of links, and only outside the main
part: in it, paragraphs are alike on all pages. Inside the main part a subtree that recurs with its text is deleted if
it is a container, and never most of the part: many pages of a host may hold the same article, and a template is what
surrounds it. There, class names count only as whole words and on containers. A line break ends a block.

Results for odd input: a null, empty or blank page has an empty text; markup that is cut off or nested wrongly is read
as far as it goes, a quote that is never closed ends with its tag; pages of any depth and length are read in linear
time and without recursion; pages without a host count as one host; equal pages get equal results and count once; no
pages give no rows; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, released, staged
from .shingles import kept, sliced

#: A subtree is a template when it is on at least so many distinct pages of its host, outside the article on ENOUGH of
#: them (on a small host: on SMALL_SHARE of them), or, wherever it stands, on MIN_SHARE of them.
MIN_PAGES, ENOUGH, SMALL_SHARE, MIN_SHARE = 5, 20, 0.1, 0.5

OPENING = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: What may end a tag, or begin a quoted value in it.
STOP = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"""(?<![\w\-])(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# Element names by kind, and class words of what is no part of a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
ENDS_P = BLOCK - {"br", "html", "body", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
DROPPED = frozenset("nav footer aside form button select input option datalist head script style textarea title noscript template iframe object embed applet canvas svg audio video dialog menu noembed noframes map frameset xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login sidebar widget widgets related recommended share sharing social breadcrumb breadcrumbs menu menus nav navbar navigation toolbar footer header masthead topbar comment comments commentlist disqus replies respond pagination pager search skip".split()
)
#: Class and id names that say the same inside an article.
INSIDE = frozenset("ad ads advert advertisement sponsored promo cookie-notice cookie-banner notice newsletter comments comment-list commentlist comments-area disqus_thread replies respond share-buttons social-share related-posts related-articles breadcrumb breadcrumbs pagination".split())
CONTAINERS = frozenset("div section aside ul ol dl table header footer nav form figure details fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table td th body html article section div".split())


class Node:
    """An element; ``hash`` of its subtree with the text, ``shape`` of its structure, ``size`` and ``links``: characters of its text, and of these in links."""

    __slots__ = ("tag", "attrs", "parts", "parent", "hash", "shape", "size", "links")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parts, self.parent = tag, attrs, [], parent


def tag_end(page: str, at: int) -> int:
    """The place behind the tag whose attributes begin at ``at``, -1 if there is no end; a quote that is never closed counts for nothing."""
    while stop := STOP.search(page, at):
        if stop[0] == ">":
            return stop.end()
        close = page.find(stop[0][-1], stop.end())
        at = close + 1 if close >= 0 else stop.end()
    return -1


def parsed(page: str) -> list[Node]:
    """All elements of a page, each before its children; the first is the page itself."""
    root = Node("#", "", None)
    nodes, stack = [root], [root]
    opened: dict[str, list[int]] = {}  # where in the stack the open elements of a tag are
    scopes: list[int] = [0]
    closing: dict[str, re.Pattern] = {}

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop().tag
            opened[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    at, end = 0, len(page)
    while at < end:
        m = OPENING.search(page, at)
        if not m:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        if not m[2]:  # a comment or a declaration
            mark = "-->" if m[0] == "<!--" else ">"
            stop = page.find(mark, m.end())
            at = stop + len(mark) if stop >= 0 else end
            continue
        at = tag_end(page, m.end())
        if at < 0:  # cut off within a tag
            break
        attrs = page[m.end() : at - 1]
        tag = m[2].lower()
        if m[1]:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if tag in ENDS_P and opened.get("p") and opened["p"][-1] > scopes[-1]:
            close(opened["p"][-1])
        if tag in SIBLINGS and (last := max((opened[t][-1] for t in SIBLINGS[tag] if opened.get(t)), default=0)) > scopes[-1] - (tag in ("td", "th", "dd", "dt")):
            close(last)
        node = Node(tag, attrs, stack[-1])
        nodes.append(node)
        stack[-1].parts.append(node)
        if tag in VOID or attrs.endswith("/") and tag in ("path", "rect", "circle", "use"):
            continue
        if tag in RAW:
            if tag not in closing:
                closing[tag] = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I)
            stop = closing[tag].search(page, at)
            node.parts.append(page[at : stop.start() if stop else end])
            at = stop.end() if stop else end
            continue
        opened.setdefault(tag, []).append(len(stack))
        if tag in SCOPES:
            scopes.append(len(stack))
        stack.append(node)
    return nodes


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def remembered(function: Callable, *args):
    """``function(*args)``; a worker remembers up to 20,000 results of each function, since pages of a site are written alike."""
    known = kept(function.__name__, dict)
    if args not in known:
        if len(known) >= 20_000:
            known.clear()
        known[args] = function(*args)
    return known[args]


def attributes_of(attrs: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attrs)} if attrs else {}


def kind_of(tag: str, attrs: str) -> str:
    """Tag and names of an element, without numbers."""
    a = remembered(attributes_of, attrs)
    return " ".join([tag, *sorted(re.sub(r"[0-9]+", "0", f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}").split())])


def measure(nodes: list[Node]) -> None:
    """Set hashes and sizes of all elements; children come after their parents, so the last is first."""
    for node in reversed(nodes):
        own, shapes, size, links = [node.tag], set(), 0, 0
        for part in node.parts:
            if isinstance(part, str):
                text = " ".join(part.split())
                own.append(text)
                size += len(text)
            else:
                own.append(str(part.hash))
                shapes.add(part.shape)
                size += part.size
                links += part.links
        if node.tag in RAW:
            size = 0
        node.hash, node.shape = digest("\x1f".join(own)), digest("\x1f".join([remembered(kind_of, node.tag, node.attrs), *map(str, sorted(shapes))]))
        node.size, node.links = size, size if node.tag == "a" else links


def is_no_text(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element's tag, role or class says that it is no part of the text; ``inside`` the main part fewer names do."""
    a = remembered(attributes_of, attrs)
    if tag in DROPPED or "hidden" in a or a.get("aria-hidden") == "true" or a.get("role") in ROLES or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    names = f"{a.get('class', '')} {a.get('id', '')}"
    if tag == "article":
        return "comment" in names
    if tag in ("main", "body", "html", "#"):
        return False
    if inside:
        return tag in CONTAINERS and not INSIDE.isdisjoint(names.split())
    return tag in CONTAINERS and not WORDS.isdisjoint(re.split(r"[^a-z]+", re.sub(r"(side|nav|top)-?bar", r"\1bar", names)))


def main_parts(nodes: list[Node]) -> list[Node]:
    """The article, or all articles that are no comments and in no other one (the main element instead if it holds all of several); without one the largest main element, else, from the body on, the part that holds most of the text outside links."""
    gone: set[int] = set()
    for node in nodes:
        if id(node.parent) in gone or remembered(is_no_text, node.tag, node.attrs, False):
            gone.add(id(node))
    there = lambda tag: [x for x in nodes if x.tag == tag and x.size and id(x) not in gone]
    if articles := there("article"):
        every, within = {id(x) for x in articles}, set()
        for node in nodes:
            if id(node.parent) in within or id(node.parent) in every:
                within.add(id(node))
        articles = [x for x in articles if id(x) not in within]
        if len(articles) > 1:
            held = dict.fromkeys(map(id, articles), 1)  # how many articles an element holds
            for node in reversed(nodes):
                if node.parent and id(node) in held:
                    held[id(node.parent)] = held.get(id(node.parent), 0) + held[id(node)]
            if mains := [x for x in there("main") if held.get(id(x)) == len(articles)]:
                return mains[:1]
        return articles
    for tag in ("main", "body", "#"):
        if found := there(tag):
            best = max(found, key=lambda x: x.size)
            break
    else:
        return [nodes[0]]
    while best.tag != "main":
        text = [x for x in best.parts if isinstance(x, Node) and id(x) not in gone and (x.size - x.links) * 10 >= 7 * (best.size - best.links) > 0 and x.tag in CONTAINERS | {"html", "body", "center"}]
        if not text:
            break
        best = text[0]
    return [best]


def around(nodes: list[Node], parts: list[Node]) -> set[int]:
    """Identities of the elements that neither hold a main part nor are in one; of a page whose main part is all of it, none."""
    holds: set[int] = set()
    for part in parts:
        up = part.parent
        while up and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    inner = {id(part) for part in parts}
    for node in nodes:
        if id(node.parent) in inner:
            inner.add(id(node))
    return {id(x) for x in nodes} - holds - inner


def places(nodes: list[Node], out: set[int]) -> dict[int, int]:
    """For elements around the main part that are named or full of links: the hash of their structure and place."""
    path: dict[int, int] = {}
    found: dict[int, int] = {}
    for node in nodes if out else []:
        name = remembered(kind_of, node.tag, node.attrs)
        path[id(node)] = digest(f"{path.get(id(node.parent), '')} {name}")
        if id(node) in out and node.size and (" " in name or node.tag in ("nav", "header", "footer", "aside", "form") or node.links * 2 > node.size):
            found[id(node)] = digest(f"{path[id(node)]} {node.shape}")
    return found


def main_text(page: str | None, recurring: frozenset[int] | set[int] = frozenset(), lists: bool = True) -> str:
    """The text of a page without the subtrees whose hashes are ``recurring``; ``lists``: and without what tags, roles and names tell, main part only."""
    if not page:
        return ""
    nodes = parsed(page)
    measure(nodes)
    parts = main_parts(nodes)
    out = around(nodes, parts)
    place = places(nodes, out)
    article = parts[0].tag in ("article", "main")
    size = sum(x.size for x in parts)
    tops = parts if lists and article else [next((x for x in nodes if x.tag == "body"), nodes[0])]
    blocks: list[str] = []
    open_block: list[str] = []

    def close() -> None:
        if open_block:
            if text := " ".join(entities.unescape("".join(open_block)).split()):
                blocks.append(text)
            open_block.clear()

    def gone(node: Node) -> bool:
        outside = id(node) in out
        if place.get(id(node)) in recurring or node.hash in recurring and node.size * 2 < size and (node.tag in CONTAINERS or outside or not article):
            return True
        return lists and (remembered(is_no_text, node.tag, node.attrs, article and not outside) or node.tag == "header" and not article) or node.tag in RAW or node.tag == "head"

    stack = [(iter(top.parts), top) for top in reversed(tops)]
    while stack:
        part = next(stack[-1][0], None)
        if part is None:
            node = stack.pop()[1]
            if node.tag in BLOCK:
                close()
            elif node.tag in ("td", "th"):
                open_block.append(" ")
        elif isinstance(part, str):
            open_block.append(part)
        else:
            if part.tag in BLOCK:
                close()
            if not gone(part):
                stack.append((iter(part.parts), part))
    close()
    return "\n".join(blocks)


def hashes_of(page: str) -> dict[int, int]:
    """For every hash of a block with text, and of a place around the main part: whether it stands outside the main part."""
    nodes = parsed(page)
    measure(nodes)
    parts = main_parts(nodes)
    out = around(nodes, parts)
    if parts[0].tag not in ("article", "main"):  # any block may be a template where nothing says what the text is
        out_text = {id(x) for x in nodes}
    else:
        out_text = out
    found: dict[int, int] = {}
    for node in nodes:
        if node.size and node.tag in BLOCK:
            found[node.hash] = max(found.get(node.hash, 0), int(id(node) in out_text))
    return found | dict.fromkeys(places(nodes, out).values(), 1)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of a page, those inside the main part and those around it."""
    for batch in sliced(batches, text="html"):
        found = [hashes_of(page) if page else {} for page in batch.column("html").to_pylist()]
        sides = [pa.array([[h for h, out in f.items() if out == side] for f in found], pa.list_(pa.int64())) for side in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), *sides], names=["host", "page", "inside", "outside"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, text="html"):
        gone = [frozenset(x or ()) for x in batch.column("gone").to_pylist()]
        texts = [main_text(page, g) for page, g in zip(batch.column("html").to_pylist(), gone, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, page, gone): for every page (host, page, html; page is a hash of the html) that has some, the hashes of its subtrees that are templates of its host; equal pages are one.

    A page's own hashes meet those of its host's templates by (host, hash), so that no row has more than a page's.
    """
    own = pages.select("host", "page", "html").mapInArrow(_subtrees, "host string, page long, inside array<long>, outside array<long>")
    own = staged(own.dropDuplicates(["host", "page"]), "subtrees")
    whole = staged(own.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    each = F.concat(F.transform("inside", lambda h: F.struct(h.alias("hash"), F.lit(0).alias("outside"))), F.transform("outside", lambda h: F.struct(h.alias("hash"), F.lit(1).alias("outside"))))
    rows = own.select("host", "page", F.explode(each).alias("e")).select("host", "page", "e.hash", "e.outside")
    count = rows.groupBy("host", "hash").agg(F.count("*").alias("n"), F.sum("outside").alias("around")).where(F.col("n") >= min_pages)
    enough = F.greatest(F.lit(min_pages), F.least(F.lit(ENOUGH), F.ceil(SMALL_SHARE * F.col("pages"))))
    often = staged(count.join(broadcast_if_small(whole), "host").where((F.col("around") >= enough) | (F.col("n") >= min_share * F.col("pages"))).select("host", "hash"), "templates")
    out = rows.join(broadcast_if_small(often), ["host", "hash"]).groupBy("host", "page").agg(F.collect_list("hash").alias("gone"))
    out = staged(out, "templates-of-pages")
    released(own, whole, often)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"), F.xxhash64(html_col).alias("page"))
    p = p.join(templates(p).hint("merge"), ["host", "page"], "left")  # the same plan for few pages and for many
    return p.select("id", "url", "host", "html", "gone").mapInArrow(_texts, f"page_id {dict(p.dtypes)['id']}, url string, text string, n_chars long")


def op8_site_template_removal(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
