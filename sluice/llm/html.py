"""Main text of web pages by wrapper induction (operator 4).

Pages of one host share templates, one per layout. Every page is parsed into a tree, and each text
node of its main part gets a key: its path of elements and its text. Over all pages of a host it is
counted on how many distinct pages each key occurs. A key on at least one page in :data:`SHARE` of
its layout's pages, or of the host's, and on :data:`LEAST` pages or more, belongs to the template and
goes; whatever a smaller share holds is content. Two nodes with one key have equal texts below equal
elements, which is what tree matching of two pages would call constant, for any number of siblings.

A page's layout is the set of containers with their class names (those without digits) that frame
its article, down to two levels below the body.

Copies count once. A first count takes pages with equal keys as one; the second takes pages with
equal varying slots (what the first calls no template, outside zones of noise) as one, and only its
result is used.

What a page is made of also counts. Elements for navigation, footers, asides, buttons and dialogs are
dropped, scripts and styles never enter the tree, and if there is an article (else a main element),
the text is taken from it, whatever the names around it. Names of noise (:data:`NOISE`, compared with
whole tokens of class, id and role) are only a prior next to the template: a text below them is
template from one page in :data:`HINTED` on, if they hold no more than half of the text. Beyond that, outside articles, what such an element (or a
form, or a header) holds goes as a zone, unless it holds most of the page's text that is no template.
Containers named for reader comments (:data:`COMMENTS`) are zones within an article as well.

Counts are map-side combined, so a hot host has no hot task; templates meet the pages by joins on
the layout and on the host, salted :data:`SALTS` times.

Text: character references decoded, white space within a block becomes one space, blocks in page
order are joined by a newline. Defined cases: a NULL or empty page, or one without text, gives
the empty text; a NULL or odd url is host ``""``; repeated rows each get their result and are
copies of each other; paragraphs, list items, table cells and the head end where browsers end them
(the head with the first text or element of a body), stray end tags are ignored, a ``<`` that opens
no tag is text, and a formula's text stays in its sentence. Trees are walked without recursion limits: nesting beyond :data:`DEEPEST` is flattened.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.frames import pick, store

SHARE = 2
HINTED = 4
LEAST = 3
SALTS = 16
DEEPEST = 200

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select object canvas audio video annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img td th label "
                   "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msup msub msubsup mover munder munderover mtable mtr mtd".split())
DROPPED = frozenset("head nav footer aside button dialog menu search".split())
LIKELY = frozenset("form fieldset".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figure figcaption".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table tbody thead tfoot div section article main body aside nav header footer form blockquote td th li".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar "
    "footer masthead topbar comment comments disqus respond replies reactions share sharing social related recommended widget toolbar skip "
    "cookie-notice cookie-banner cookie-consent ad-banner ad-container site-header site-footer page-header page-footer main-nav site-nav nav-menu nav-bar "
    "skip-link comment-list comments-area related-posts social-share share-buttons sharing-buttons widget-area".split())
COMMENTS = frozenset("comment comments comment-list comment-section comments-section comments-area disqus disqus_thread respond replies".split())
FRAME = frozenset("body div section article main header footer nav aside form".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


# What class, id or role say of an element: nothing, a hint that lowers the share, or a zone that goes unless it holds most.
NO, HINT, ZONE = 0, 1, 2


class Node:
    """An element, or a block of text (``tag`` is then "")."""

    __slots__ = ("tag", "kids", "text", "dropped", "noise", "frame")

    def __init__(self, tag: str, text: str = "", dropped: bool = False, noise: int = NO):
        self.tag, self.kids, self.text, self.dropped, self.noise, self.frame = tag, [], text, dropped, noise, None


def _names(attributes: str, digits: bool = True) -> set[str]:
    """Whole tokens of class, id and role in small letters; on request only those without a digit."""
    if not attributes.strip():
        return set()
    names = {w for _, a, b, c in _NAMED.findall(attributes) for w in (a or b or c).lower().split()}
    return names if digits else {w for w in names if not any(map(str.isdigit, w))}


def _noise(tag: str, attributes: str, inside: bool, article: bool) -> int:
    """What the names of an element say; ``inside`` an article or main element, its own header stays.

    Names judge no html, body, article or main element (but an article within an article), and
    within an article or for prose in a main element they are only a hint. A container that is
    named for reader comments is a zone anywhere.
    """
    if tag in ("html", "body", "main") or (tag == "article" and not article):
        return NO
    if tag in LIKELY or (tag == "header" and not inside):
        return ZONE
    if tag == "header" or not attributes.strip():
        return NO
    names = _names(attributes)
    if names.isdisjoint(NOISE | COMMENTS) and (inside or "header" not in names):
        return NO
    if tag not in PROSE and not names.isdisjoint(COMMENTS):
        return ZONE
    return HINT if (article and tag != "article") or (inside and tag in PROSE) else ZONE


def parse(html: str) -> Node:
    """The tree of a page without what is dropped by element name; texts are merged per block."""
    root = Node("html")
    root.frame = set()
    stack, run, at, article, inside = [root], [], 0, 0, 0

    def flush() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            run.clear()
            if text and stack[-1].tag == "head":
                pop()
            if text and not any(n.dropped for n in stack):
                stack[-1].kids.append(Node("", text))

    def pop() -> None:
        nonlocal article, inside
        gone = stack.pop()
        article -= gone.tag == "article"
        inside -= gone.tag in ("article", "main")

    for m in _TAG.finditer(html):
        if m.start() < at:
            continue  # inside raw text
        if m.start() > at:
            run.append(html[at : m.start()])
        at = m.end()
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if slash:
            if tag in INLINE:
                if tag in ("td", "th"):
                    run.append(" ")
                continue
            flush()
            if any(n.tag == tag for n in stack[1:]):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = _ENDS[tag].search(html, at)
            at = end.end() if end else len(html)
            run.append(" ")
            continue
        if tag in INLINE:
            run.append(" " if tag in ("br", "td", "th", "img") else "")
            continue
        flush()
        if tag in VOID or tag == "html" or len(stack) >= DEEPEST:
            continue
        if stack[-1].tag == "head":
            pop()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    while len(stack) > k:
                        pop()
                    break
                if stack[k].tag in SCOPE:
                    break
        elif tag in SAME:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SAME[tag]:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k].tag in SCOPE and stack[k].tag not in ("td", "th"):
                    break
        if not inside and tag in FRAME and len(stack) <= 3:
            root.frame.add(" ".join([str(len(stack)), tag, *sorted(_names(attributes, digits=False))]))
        node = Node(tag, "", tag in DROPPED, _noise(tag, attributes, inside > 0, article > 0))
        if not any(n.dropped for n in stack) and not node.dropped:
            stack[-1].kids.append(node)
        article += tag == "article"
        inside += tag in ("article", "main")
        stack.append(node)
    if at < len(html):
        run.append(html[at:])
    flush()
    return root


def blocks(node: Node) -> list[Node]:
    """Text nodes in page order."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if n.tag:
            todo += reversed(n.kids)
        else:
            out.append(n)
    return out


def main_part(root: Node) -> Node:
    """The article with most text, else the main element, else the page."""
    best = None
    for tag in ("article", "main"):
        todo, found = [root], []
        while todo:
            n = todo.pop()
            if n.tag == tag:
                found.append(n)
            else:
                todo += reversed(n.kids)
        if found:
            best = max(found, key=lambda n: sum(len(b.text) for b in blocks(n)))
            if blocks(best):
                return best
    return best if best is not None and not blocks(root) else root


class Page:
    """What a page's main part is made of: text blocks, a key of place and text for each, and zones.

    Zone 0 is the part itself; ``over`` has the zone around each zone, ``zones`` the zone of each
    block. A key's last bits say that the block lies below a hint (1) or in a zone (2), not counting
    those that hold most of the part's text.
    """

    __slots__ = ("layout", "texts", "keys", "zones", "over")

    def __init__(self, html: str):
        root = parse(html)
        self.layout = _hash("\n".join(sorted(root.frame)))
        self.texts, self.keys, self.zones, self.over = [], [], [], [0]
        part = main_part(root)
        around, kinds, zone_of, groups = [0], [NO], [0], []
        todo = [(part, "", 0)]
        while todo:
            node, path, group = todo.pop()
            if node.tag:
                path = f"{path}/{node.tag}"
                if node.noise and node is not part:
                    around.append(group)
                    kinds.append(node.noise)
                    if node.noise == ZONE:
                        self.over.append(zone_of[group])
                        zone_of.append(len(self.over) - 1)
                    else:
                        zone_of.append(zone_of[group])
                    group = len(around) - 1
                todo += [(kid, path, group) for kid in reversed(node.kids)]
            else:
                self.texts.append(node.text)
                self.keys.append(_hash(f"{path}\n{node.text}") & ~3)
                groups.append(group)
        self.zones = [zone_of[g] for g in groups]
        if len(around) > 1:
            size = [0] * len(around)
            for text, g in zip(self.texts, groups):
                size[g] += len(text)
            for g in range(len(around) - 1, 0, -1):
                size[around[g]] += size[g]
            bits = [0] * len(around)
            for g in range(1, len(around)):
                bits[g] = bits[around[g]] | (kinds[g] if 2 * size[g] <= size[0] else 0)
            self.keys = [k | bits[g] for k, g in zip(self.keys, groups)]


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def kept(texts: list[str], keys: list[int], zones: list[int], over: list[int], template: set[int]) -> str:
    """The blocks that the template does not hold, without zones that hold no more than half of them."""
    left = [(t, z) for t, k, z in zip(texts, keys, zones) if k not in template]
    if len(over) == 1:
        return "\n".join(t for t, _ in left)
    size = [0] * len(over)
    for t, z in left:
        size[z] += len(t)
    for z in range(len(over) - 1, 0, -1):
        size[over[z]] += size[z]
    gone = [False] * len(over)
    for z in range(1, len(over)):
        gone[z] = gone[over[z]] or 2 * size[z] <= size[0]
    return "\n".join(t for t, z in left if not gone[z])


def main_text(html: str, template: Iterable[int]) -> str:
    """The main text of a page, given the keys of its layout's template."""
    page = Page(html)
    return kept(page.texts, page.keys, page.zones, page.over, set(template))


def _keys(batches):
    for batch in batches:
        pages = [Page(h) for h in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p.layout for p in pages], pa.int64()), pa.array([[*dict.fromkeys(p.keys)] for p in pages], pa.list_(pa.int64()))],
            names=["host", "layout", "keys"])


def _blocks(batches):
    for batch in batches:
        pages = [Page(h) for h in batch.column(3).to_pylist()]
        lists = [pa.array([getattr(p, name) for p in pages], pa.list_(kind))
                 for name, kind in (("texts", pa.string()), ("keys", pa.int64()), ("zones", pa.int32()), ("over", pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([p.layout for p in pages], pa.int64()), *lists],
                                         names=["page_id", "url", "host", "layout", "texts", "keys", "zones", "over"])


def _kept(batches):
    for batch in batches:
        texts = [kept(t, k, z, o, {*(a or ()), *(b or ())}) for t, k, z, o, a, b in zip(*(c.to_pylist() for c in batch.columns[2:8]))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def _grouped(pages: DataFrame) -> DataFrame:
    """Ids of the two groups a page belongs to, its layout and its whole host, and a salt for joins on them."""
    return pages.withColumns({"layout": F.xxhash64("host", "layout"), "host": F.xxhash64("host"), "salt": F.pmod(F.xxhash64("keys"), F.lit(SALTS))})


def _called(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``id, salt, template``: per group the keys that a share of its pages holds; at most nodes-a-page / share keys."""
    held = (counts.where(F.col("n") >= LEAST).join(totals, "id").where(F.col("n") * F.when(F.col("key").bitwiseAND(1) == 1, HINTED).otherwise(SHARE) >= F.col("total"))
            .groupBy("id").agg(F.collect_list("key").alias("template")))
    return held.select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), "template")


def _with_template(pages: DataFrame, called: DataFrame) -> DataFrame:
    """``pages`` with ``own`` and ``shared``, the templates of the layout and of the host."""
    own = called.select(F.col("id").alias("layout"), "salt", F.col("template").alias("own"))
    shared = called.select(F.col("id").alias("host"), "salt", F.col("template").alias("shared"))
    return pages.join(own, ["layout", "salt"], "left").join(shared, ["host", "salt"], "left")


def wrappers(view: DataFrame) -> DataFrame:
    """The templates of all layouts and hosts, counted over every page."""
    ids = F.explode(F.array("layout", "host")).alias("id")
    pages = store(_grouped(view.select("host", "html").mapInArrow(_keys, "host string, layout long, keys array<long>")
                           .where(F.size("keys") > 0)).distinct(), "pages")
    totals = pages.select(ids).groupBy("id").agg(F.count("*").alias("total"))
    counts = pages.select(ids, F.explode("keys").alias("key")).groupBy("id", "key").agg(F.count("*").alias("n"))
    first = store(_called(counts, totals), "candidates")
    # copies: the same varying slots, whatever constant nodes a copy has besides; each counts once
    template = F.concat(F.coalesce("own", F.array().cast("array<long>")), F.coalesce("shared", F.array().cast("array<long>")))
    slots = F.array_except("keys", "template")
    plain = F.filter(slots, lambda k: k.bitwiseAND(3) == 0)
    apart = (_with_template(pages, first).select("layout", "host", "keys", template.alias("template"))
             .select("layout", "host", F.xxhash64(F.when(F.size(plain) > 0, plain).otherwise(slots)).alias("slots"),
                     F.array_intersect("keys", "template").alias("keys")))
    totals = apart.select(ids, "slots").distinct().groupBy("id").agg(F.count("*").alias("total"))
    counts = apart.select(ids, "slots", F.explode("keys").alias("key")).distinct().groupBy("id", "key").agg(F.count("*").alias("n"))
    return store(_called(counts, totals), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    view = pick(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    blocks_ = view.mapInArrow(_blocks, "page_id long, url string, host string, layout long, texts array<string>, keys array<long>, "
                            "zones array<int>, over array<int>")
    joined = _with_template(_grouped(blocks_), wrappers(view)).select("page_id", "url", "texts", "keys", "zones", "over", "own", "shared")
    return (joined.mapInArrow(_kept, "page_id long, url string, text string")
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
