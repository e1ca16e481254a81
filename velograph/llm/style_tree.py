"""Main text of web pages by a site style tree (operator 6).

All pages of a host are merged into one tree: a node is an element's path of
labels (tag, class, id) from the root, a presentation of it is the sequence of
its children's labels. Over the ``m`` pages that have a node (a page that shows it in
several ways counts once for each),

* its presentation importance is the entropy, to base m, of the presentations;
* the content importance of a text below it is 1 - H, where H is the entropy of
  the text over those pages (1 for a text on every page, 0 for one on one page);
* the node's importance mixes both, the content with weight GAMMA ** (number of
  presentations); content counts by the mean over all different texts below.

What an element is for counts first: scripts, styles, forms, menus, headers,
footers, sidebars, adverts, notices and comment sections (by tag, role, or a word
of class or id) have importance 0, and an article or main element itself 1; what
is below it counts by its computed importance. Branches below ``LOW`` are cut from
each page, if at least ``MIN_PAGES`` pages have them and the host's pages differ as
a whole; the rest is the main text. Pages that have an article (or else a main)
element take their text from it, whatever is cut above it; one that would lose
every block to cuts keeps them.

Statistics are sums over (host, path, text) keys with map-side combining, so a
host with a third of all pages is no hot task. The cut branches are sent to all
tasks if there are at most ``SMALL`` of them; otherwise pages join them by host.

Defined results: null html gives no text; markup that is never closed is closed
at the end; elements nested deeper than ``DEPTH`` nodes are part of their ancestor's node
(their texts stay blocks of their own); a null or odd url belongs to the host ''. Repeated pages give equal
rows. Columns of the input other than the result's are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from velograph.llm.scratch import Scratch

GAMMA = 0.9
LOW = 0.2
MIN_PAGES = 4
SMALL = 500_000
DEPTH = 256  # deeper elements belong to the node of their ancestor at this depth

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
                    "section summary table tbody td tfoot th thead tr ul").split())
#: Elements that end an open element of the same kind before them.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
#: What may stand in a head element; anything else ends it.
HEAD = frozenset("title meta link script style base noscript template".split())
SCOPES = frozenset("ul ol dl table select body html article div section".split())
#: What never belongs to an article's text: by tag, by role, by a word of class or id.
ASIDE_TAGS = frozenset("head nav header footer aside form button select menu dialog noscript script style template iframe svg object".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
ASIDE_WORDS = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
                         "breadcrumb breadcrumbs sidebar aside footer header masthead comment comments disqus cookie cookies consent notice "
                         "notices gdpr popup modal newsletter subscribe signup login share sharing social related recommended pagination "
                         "pager toolbar widget skip search").split())
MAIN_TAGS = ("article", "main")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Element:
    __slots__ = ("tag", "code", "parts", "aside", "main", "top", "mute", "children", "block")

    def __init__(self, tag, code, parts, aside, main, top=0, mute=False, block=None):
        self.tag, self.code, self.parts, self.aside, self.main, self.top, self.mute = tag, code, parts, aside, main, top, mute
        self.children: list[str] = []
        self.block = block or self  # the block whose text this is


def walk(page: str, nodes: bool = False) -> Iterator[tuple]:
    """Events of a page in order: ("text", path parts, is aside, kind of main, top, text)
    for each block, and with ``nodes`` ("node", path parts, is aside, kind of main, top,
    child labels) where an element ends. ``top`` is the number of parts down to the
    article or main element, itself included."""
    root = Element("", 0, (), False, 0)
    stack = [root]
    where: defaultdict[str, list[int]] = defaultdict(list)  # places of the open elements of each tag
    scopes = [0]  # where elements that an open p or list item does not reach beyond stand
    buffer: list[str] = []
    owner = root

    def flush():
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                yield ("text", owner.parts, owner.aside, owner.main, owner.top, text)

    def close(count):
        for _ in range(count):
            done = stack.pop()
            where[done.tag].pop()
            if scopes[-1] == len(stack):
                scopes.pop()
            if nodes:
                yield ("node", done.parts, done.aside, done.main, done.top, done.children)

    at = 0
    while True:
        m = TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece and not stack[-1].mute:
            if not buffer:
                owner = stack[-1].block
            buffer.append(piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCKS:
                yield from flush()
            if where[tag]:
                yield from close(len(stack) - where[tag][-1])
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag not in HEAD and where["head"]:
            yield from flush()
            yield from close(len(stack) - where["head"][0])
        if tag in BLOCKS:
            yield from flush()
            # an open p, or an element that this one follows, ends unless a scope stands between
            for ended in (("p",), SIBLINGS.get(tag, ())):
                depth = max((where[t][-1] for t in ended if where[t]), default=0)
                if depth > scopes[-1]:
                    yield from close(len(stack) - depth)
        if tag in VOID:
            continue
        attributes = {a[0].lower(): (a[1] or a[2] or a[3]).lower() for a in ATTRIBUTE.findall(m[3] or m[6] or "")}
        above = stack[-1]
        inline = tag not in BLOCKS and tag not in RAW and tag not in ASIDE_TAGS
        label = f"{tag}.{attributes.get('class', '')}#{attributes.get('id', '')}"
        words = WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}") if attributes else ()
        aside = (above.aside or tag in ASIDE_TAGS or tag in RAW or attributes.get("role") in ASIDE_ROLES
                 or tag not in ("html", "body", *MAIN_TAGS) and not ASIDE_WORDS.isdisjoint(words)
                 or tag == "article" and not {"comment", "comments"}.isdisjoint(words))
        main = above.main or (0 if aside else 2 if tag == "article" else 1 if tag == "main" or attributes.get("role") == "main" else 0)
        if tag == "article" and not aside:
            main = 2
        if not above.children or above.children[-1] != label:
            above.children.append(label)
        code = _hash(f"{above.code}/{label}")
        mute = above.mute or (aside and not above.aside and tag not in BLOCKS)  # inside a block that stays: no text of it
        parts = (*above.parts, code) if (aside or not inline) and len(above.parts) < DEPTH else above.parts
        if tag in SCOPES:
            scopes.append(len(stack))
        where[tag].append(len(stack))
        stack.append(Element(tag, code, parts, aside, main, len(parts) if main > above.main else above.top, mute, None if tag in BLOCKS else above.block))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
            if not end:
                break
        if (m[3] or m[6] or "").endswith("/") and tag in ("svg", "path", "circle"):
            yield from close(1)
    yield from flush()
    yield from close(len(stack) - 1)


def host(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _features(batches):
    """Distinct (host, node, presentation or text) of every page."""
    for batch in batches:
        hosts, nodes, above, kinds, found, mains = [], [], [], [], [], []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if page is None:
                continue
            seen = set()
            h = _hash(host(url))
            for kind, parts, _, main, top, what in walk(page, nodes=True):
                if not parts:
                    continue
                row = (parts[-1], kind == "text", _hash(what if kind == "text" else "\n".join(what)))
                if row not in seen:
                    seen.add(row)
                    hosts.append(h)
                    nodes.append(parts[-1])
                    above.append(list(parts))
                    kinds.append(kind == "text")
                    found.append(row[2])
                    mains.append(main > 0 and top == len(parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(above, pa.list_(pa.int64())), pa.array(kinds, pa.bool_()),
             pa.array(found, pa.int64()), pa.array(mains, pa.bool_())], names=["host", "node", "parts", "is_text", "what", "main"])


FEATURES = "host long, node long, parts array<long>, is_text boolean, what long, main boolean"


def importance(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, node, pages, importance) for every node of every host's style tree."""
    source = pages.select(F.col(url).alias("url"), F.col(page).alias("html"))
    scratch = Scratch(pages.sparkSession, "style-tree")
    uses = scratch.write(source.mapInArrow(_features, FEATURES).groupBy("host", "node", "is_text", "what")
                         .agg(F.count("*").alias("n"), F.first("parts").alias("parts"), F.max("main").alias("main")), "uses")
    shown = uses.where("NOT is_text").groupBy("host", "node").agg(
        F.sum("n").alias("pages"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log("n")).alias("s"),
        F.first("parts").alias("parts"), F.max("main").alias("main"))
    shown = shown.withColumn("shape", F.when(F.col("pages") > 1, F.log("pages") - F.col("s") / F.col("pages")).otherwise(0.0)
                             / F.greatest(F.log("pages"), F.lit(math.log(2))))
    shown = scratch.write(shown, "shown")
    texts = uses.where("is_text").select("host", "n", F.explode("parts").alias("node"))
    texts = texts.groupBy("host", "node", "n").agg(F.count("*").alias("times"))
    texts = texts.join(shown.select("host", "node", "pages"), ["host", "node"])
    spread = F.when(F.col("pages") > 1, F.log(F.least("n", "pages")) / F.log("pages")).otherwise(0.0)
    content = texts.groupBy("host", "node").agg(
        (1 - F.sum(F.col("times") * spread) / F.sum("times")).alias("content"))
    weight = F.pow(F.lit(GAMMA), F.least("kinds", F.lit(1000)))
    value = (1 - weight) * F.col("shape") + weight * F.coalesce("content", F.col("shape"))
    return (shown.join(content, ["host", "node"], "left")
            .select("host", "node", "pages", F.element_at("parts", 1).alias("root"),
                    F.when(F.col("main"), F.lit(1.0)).otherwise(F.greatest(value, F.lit(0.0))).alias("importance")))


def low_branches(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, node) of the branches to cut: rare ones, and those of hosts that only
    repeat one page, stay."""
    scratch = Scratch(pages.sparkSession, "style-tree-low")
    nodes = scratch.write(importance(pages, url, page), "nodes")
    varied = nodes.where(F.col("node") == F.col("root")).where(F.col("importance") >= 2 * LOW).select("host", F.col("node").alias("root"))
    return nodes.where((F.col("importance") < LOW) & (F.col("pages") >= MIN_PAGES)).join(varied, ["host", "root"]).select("host", "node")


def main_text(page: str | None, cut: frozenset | set) -> str:
    """Blocks that are neither aside nor in a cut branch, joined by empty lines."""
    if not page:
        return ""
    by_main: dict[int, list[tuple[bool, str]]] = {0: [], 1: [], 2: []}
    for _, parts, aside, main, top, text in walk(page):
        stays = cut.isdisjoint(parts[top:])
        if not aside and (main or stays):
            by_main[main].append((stays, text))
            if main == 2:
                by_main[1].append((stays, text))
    blocks = by_main[2] or by_main[1] or by_main[0]
    return "\n\n".join([text for stays, text in blocks if stays] or [text for _, text in blocks])


def extract(pages: DataFrame, url: str = "url", page: str = "html", small: int = SMALL) -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    spark = pages.sparkSession
    low = Scratch(spark, "style-tree-cut").write(low_branches(pages, url, page), "low")
    names = [c for c in pages.columns if c not in ("text", "n_chars", page)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*names).schema.fields)
    source = pages.select(*names, F.col(page).alias("__llm_html"), F.col(url).alias("__llm_url"))
    shared = None
    if low.count() <= small:
        rows: dict[int, set[int]] = {}
        for r in low.toLocalIterator():  # at most ``small`` rows
            rows.setdefault(r.host, set()).add(r.node)
        shared = spark.sparkContext.broadcast(rows)
    else:
        hosts = F.udf(lambda u: _hash(host(u)), "long")
        lists = low.groupBy("host").agg(F.collect_set("node").alias("__llm_cut"))
        source = source.withColumn("__llm_host", hosts("__llm_url")).join(lists, F.col("__llm_host") == lists["host"], "left").select(*source.columns, "__llm_cut")

    def run(batches):
        nothing: frozenset = frozenset()
        for batch in batches:
            if shared is not None:
                cuts = [shared.value.get(_hash(host(u)), nothing) for u in batch.column("__llm_url").to_pylist()]
            else:
                cuts = [set(c or ()) for c in batch.column("__llm_cut").to_pylist()]
            texts = [main_text(p, c) for p, c in zip(batch.column("__llm_html").to_pylist(), cuts, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string()),
                                              pa.array(np.array([len(t) for t in texts], np.int64))], names=[*names, "text", "n_chars"])

    return source.mapInArrow(run, f"{fields}, text string, n_chars long")
