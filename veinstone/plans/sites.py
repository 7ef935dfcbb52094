"""A bounded walk over the links of sites: which pages of each site are visited, breadth first, by joins on the frontier.

The links of all pages are read once, in one pass without a shuffle; from then on only addresses move. A round takes
the links of the pages visited in the round before, drops what the site has seen, and gives each site its next few
pages; so there are at most as many rounds as pages to a site, and no task holds the links of a site but the first few.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LINK_HINTS, MOST_PAGES
from ..functions import textkeys as K
from ..staging import broadcast_if_small, staged

ANCHOR = re.compile(r"<a\b([^>]*)>(.*?)(?=</a\b|<a\b|\Z)", re.I | re.S)
HREF = re.compile(r"""(?<![\w\-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TAG = re.compile(r"<[^>]*>?")


def links_of(url: str, page: str | None, hints: tuple[str, ...] = LINK_HINTS) -> list[tuple[str, bool]]:
    """(address, hinted) of the links of a page in their order, resolved against its own address, without what follows #; an address that makes no sense is passed over."""
    found = []
    for attributes, label in ANCHOR.findall(page or ""):
        if not (m := HREF.search(attributes)):
            continue
        href = html.unescape(m[1] or m[2] or m[3] or "").strip()
        try:
            target = urldefrag(urljoin(url, href))[0]
        except ValueError:
            continue
        said = f"{href} {html.unescape(TAG.sub('', label)).strip()}".lower()
        found.append((target, any(h in said for h in hints)))
    return found


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(url, i, target, hinted) for url, page in zip(batch["url"], batch["html"], strict=True) for i, (target, hinted) in enumerate(links_of(url, page))]
        yield pd.DataFrame(rows, columns=["url", "position", "target", "hinted"]).astype({"position": "int32", "hinted": "bool"})


def site_of(url: Column) -> Column:
    """Scheme and host of an address, in small letters; null without them."""
    scheme, host = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)), K.host_of(url)
    return F.when((scheme != "") & (host != ""), F.concat(scheme, F.lit("://"), host))


def links(pages: DataFrame) -> DataFrame:
    """(url, position, target, hinted) for all links of ``pages`` (url, html) to the page's own site; of the same link only the first counts, hinted if any is."""
    p = pages.where("url IS NOT NULL").select(F.substring_index("url", "#", 1).alias("url"), "html")
    found = p.mapInPandas(_links, "url string, position int, target string, hinted boolean")
    own = found.where(site_of(F.col("target")) == site_of(F.col("url")))
    return own.groupBy("url", "target").agg(F.min(F.when(F.col("hinted"), F.col("position"))).alias("h"), F.min("position").alias("p")).select("url", F.coalesce("h", "p").alias("position"), "target", F.col("h").isNotNull().alias("hinted"))


def walk(pages: DataFrame, starts: DataFrame | None = None, most: int = MOST_PAGES, deepest: int = 1, others: bool = False) -> DataFrame:
    """(site, url, page_id, turn, depth): the pages that are visited of every site, the first at turn 0; ``page_id`` is null for an address that no page has, which takes a turn all the same.

    A site is entered at its address in ``starts`` (site, url), or at its page with the lowest id. From there hinted
    links are followed in their order, and with ``others`` those without a hint behind them, down to ``deepest`` links
    away. Links back, links to a page itself and to other sites lead nowhere; of pages with one address the lowest id counts.
    """
    known = pages.where("url IS NOT NULL").groupBy(F.substring_index("url", "#", 1).alias("url")).agg(F.min("page_id").alias("page_id"))
    known = staged(known.withColumn("site", site_of(F.col("url"))).where("site IS NOT NULL"), "known-pages")
    if starts is None:
        starts = known.groupBy("site").agg(F.min_by("url", "page_id").alias("url"))
    visited = staged(starts.select("site", F.substring_index("url", "#", 1).alias("url")).dropDuplicates(["site"]).select("site", "url", F.lit(0).alias("turn"), F.lit(0).alias("depth")), "visited")
    edges = staged(links(pages), "links").where("hinted" if not others else "true")
    rounds, frontier = [visited], visited
    for depth in range(1, min(deepest, most - 1) + 1):
        seen = reduce(DataFrame.unionByName, rounds)
        taken = staged(seen.groupBy("site").agg(F.count("*").cast("int").alias("taken")), "taken")
        met = broadcast_if_small(frontier).join(edges, "url").groupBy("site", "target").agg(F.min(F.struct(~F.col("hinted"), "turn", "position")).alias("order"))
        new = met.withColumnRenamed("target", "url").join(seen.select("site", "url"), ["site", "url"], "left_anti")
        next_up = Window.partitionBy("site").orderBy("order", "url")
        new = new.withColumn("k", F.row_number().over(next_up)).where(F.col("k") < most).join(broadcast_if_small(taken), "site")
        new = new.select("site", "url", (F.col("taken") + F.col("k") - 1).alias("turn"), F.lit(depth).alias("depth")).where(F.col("turn") < most)
        frontier = staged(new, "visited")
        if not frontier.staged_rows:
            break
        rounds.append(frontier)
    return reduce(DataFrame.unionByName, rounds).join(known.select("url", "page_id"), "url", "left").select("site", "url", "page_id", "turn", "depth")


def site_codes(visited: DataFrame, pages: DataFrame) -> DataFrame:
    """(site, page_url, code_type, code, context) on the visited pages."""
    text = F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    seen = visited.where("page_id IS NOT NULL").select("site", F.col("url").alias("page_url"), "page_id")
    return pages.select("page_id", "html").join(seen, "page_id").select("site", "page_url", F.explode(K.company_codes(text)).alias("c")).select("site", "page_url", "c.*")
