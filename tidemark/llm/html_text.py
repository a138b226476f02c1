"""Main text of web pages by a site style tree.

Every page is parsed into blocks of text, each under a *style path*: the tags
and classes from the body down to it, without the inline ones.  The pages of a
host are merged by style path into one tree; the leaves below a path are the
block texts that stand there.  Importance is an entropy over the host's
different pages, m of them:

* a branch has a content part (how varied its text is) and a presentation part
  (how varied the layouts are in which its parent shows its children);
* a leaf on k different pages is a feature with an entropy of ln k / ln m, so
  its importance is 1 - ln k / ln m.

What the evidence takes from the importance is weighed by 1 - 1/m: two pages
prove nothing, five say enough, and there is no least number of pages.  A branch
or leaf of low importance (a menu, a notice, a footer that every page repeats)
goes from every page of the host, also where it is longer than the article and
where it shares its style path with the article.  An article or main element is
evidence for its text, so the threshold in it is half as high.

Copies of one article prove nothing either, so m counts *different* pages.
Pages of equal text are one.  A page's own text is what stands on less than
half of the host's pages of unequal text; pages with the same own text are one,
and a page with hardly any own text (an advert beside a copied article) counts
as one with the pages that share its longest block.

The tree cannot convict what changes from page to page, such as adverts, nor
what single pages hold.  There the prior decides: tags and roles of menus,
headers, footers, sidebars, notices, forms, scripts and styles, and class names
of nothing but such words.  A class name that only ends in such a word is weak
evidence: it holds unless the element has most of the page's text.  Where a
page has an article or main element, text outside of it is none of the
article's.

The tree is built by partial aggregation, so a host with a third of all pages
is no single group; pages meet their host's row through a join in which hosts
of more than a share of all pages are salted by their size.

Defined cases: null and empty html give empty text; null url is a host of its
own; unclosed, misnested and unknown tags are tolerated; rows with equal
page_id are pages of their own; an empty table gives no rows; columns other
than page_id, url and html are not read.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

RAW = frozenset(["script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "select"])
#: Raw elements that, without an end tag, last to their parent's end or the next block.
OPEN_RAW = frozenset(["noscript", "template", "svg", "iframe", "select"])
VOID = frozenset(["br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"])
INLINE = frozenset(["a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "dfn", "em", "font", "i", "ins", "kbd", "label",
                    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
                    "del", "big", "acronym", "img", "wbr"])
BOILER_TAGS = frozenset(["nav", "footer", "aside", "form", "button", "dialog", "menu", "head", "fieldset", "object", "canvas",
                         "audio", "video", "map", "datalist", "input"])
BOILER_ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"])
#: Words of class and id values (cut at other characters) that mark what is not the article.
BOILER_WORDS = frozenset(
    ["ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "promo", "sponsor",
     "sponsored", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "aside", "widget",
     "footer", "header", "masthead", "cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "newsletter",
     "subscribe", "subscription", "signup", "login", "form", "comment", "comments", "respond", "replies", "disqus",
     "share", "sharing", "social", "related", "recommended", "pagination", "pager", "copyright", "legal", "toolbar"])
#: Words that mark a compound name (``related-posts``) also where they do not end it.
BOILER_FIRST = frozenset(["related", "recommended", "sponsored", "advert", "advertisement", "comment", "comments", "cookie",
                          "newsletter", "breadcrumb"])
#: Words of class names that say nothing of the content.
CONTAINERS = frozenset(["box", "wrapper", "wrap", "container", "area", "section", "block", "list", "item", "inner", "unit",
                        "slot", "link", "links", "bar", "main", "top", "bottom", "site", "page"])
#: Tags that end an open element of the left kind when they start.
P_ENDERS = frozenset(["p", "div", "ul", "ol", "dl", "table", "article", "section", "aside", "nav", "header", "footer", "form",
                      "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figure", "hr", "main", "fieldset", "address"])
SELF_ENDERS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
               "tr": frozenset(["table", "thead", "tbody", "tfoot"]), "td": frozenset(["tr", "table"]),
               "th": frozenset(["tr", "table"]), "option": frozenset(["select"])}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
CUT = re.compile(r"[^a-z]+")


@dataclass
class Element:
    tag: str
    path: str
    boiler: bool
    article: bool
    inline: bool = False
    weak: int = 0  # number of the outermost element with a weak mark, 0 for none


@dataclass
class Block:
    path: str
    boiler: bool
    article: bool
    weak: int = 0
    parts: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(htmllib.unescape("".join(self.parts)).split())


def _named(name: str) -> int:
    """2: the class or id is made of boilerplate words; 1: it ends in one; 0: neither."""
    words = [w for w in CUT.split(name) if w]
    words = [w for w in words if w not in CONTAINERS] or words
    if words and all(w in BOILER_WORDS for w in words):
        return 2
    return int(bool(words) and (words[-1] in BOILER_WORDS or words[0] in BOILER_FIRST))


def _marks(tag: str, attrs: str, in_article: bool) -> tuple[str, bool, bool]:
    """(class part of the style path, is boilerplate by tag, role or class, may be by a class name's end)"""
    boiler, weak = tag in BOILER_TAGS or (tag == "header" and not in_article), False
    if not attrs or "=" not in attrs:
        return "", boiler, weak
    values = {k.lower(): htmllib.unescape(v.strip("\"'")).lower() for k, v in ATTR.findall(attrs)}
    names = (values.get("class", "") + " " + values.get("id", "")).split()
    words = {w for n in names for w in CUT.split(n) if w}
    if tag not in ("body", "html", "article", "main"):
        mark = max(map(_named, names), default=0)
        boiler, weak = boiler or mark == 2 or values.get("role", "") in BOILER_ROLES, mark == 1
    boiler = boiler or values.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs) is not None
    return "".join("." + w for w in sorted(words)), boiler, weak


def _weigh(blocks: list[Block]) -> list[Block]:
    """Weak marks hold unless their element has most of the words that nothing else marks."""
    if any(b.weak for b in blocks):
        words: dict[int, int] = {}
        for b in blocks:
            if not b.boiler:
                words[b.weak] = words.get(b.weak, 0) + len(b.text().split())
        total = sum(words.values())
        for b in blocks:
            b.boiler = b.boiler or (b.weak > 0 and 2 * words.get(b.weak, 0) <= total)
    return blocks


def parse_blocks(page: str) -> list[Block]:
    """The page's non-empty text blocks in page order."""
    stack = [Element("", "", False, False)]
    blocks: list[Block] = []
    open_block: Block | None = None
    weak_marks = 0
    at, n = 0, len(page)

    def top() -> Element:
        return stack[-1]

    def text(s: str) -> None:
        nonlocal open_block
        if not s:
            return
        if open_block is None:
            e = top()
            open_block = Block(e.path, e.boiler, e.article, e.weak)
            blocks.append(open_block)
        open_block.parts.append(s)

    def close_to(k: int) -> None:
        nonlocal open_block
        if any(not e.inline for e in stack[k:]):
            open_block = None
        del stack[k:]

    endless: set[str] = set()  # raw tags without a further end tag
    while at < n:
        m = TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close_to(k)
                    break
                if tag in INLINE and not stack[k].inline and stack[k].tag not in OPEN_RAW:
                    break
            else:
                if tag == "p":
                    open_block = None
            continue
        if tag in RAW:
            if tag not in INLINE:
                open_block = None
            if tag == "svg" and m.group(3).rstrip().endswith("/"):
                continue
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in OPEN_RAW:
                endless.add(tag)
                stack.append(Element(tag, f"{top().path}/{tag}", True, top().article, weak=top().weak))
            else:
                at = n
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                open_block = None
            continue
        if tag in P_ENDERS:
            if endless and (first := next((k for k in range(1, len(stack)) if stack[k].tag in OPEN_RAW), 0)):
                close_to(first)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close_to(k)
                    break
                if not stack[k].inline:
                    break
        if tag in SELF_ENDERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close_to(k)
                    break
                if stack[k].tag in SELF_ENDERS[tag]:
                    break
        e, inline = top(), tag in INLINE
        cls, boiler, weak = _marks(tag, m.group(3), e.article)
        article = e.article or tag in ("article", "main")
        if inline and not boiler and not weak:
            stack.append(Element(tag, e.path, e.boiler, article, True, e.weak))
            continue
        open_block = None
        if m.group(3).rstrip().endswith("/") and tag not in P_ENDERS:
            continue
        weak_marks += weak
        stack.append(Element(tag, f"{e.path}/{tag}{cls}", e.boiler or boiler, article, weak=e.weak or (weak_marks if weak else 0)))
    return _weigh([b for b in blocks if any(p.strip() for p in b.parts)])


def leaf(path: str, text: str) -> str:
    """Name of the leaf that a block's text is below its style path."""
    return f"{path}#{xxhash.xxh64_hexdigest(text)}"


def main_text(page: str, low: frozenset[str] = frozenset()) -> str:
    """The article's blocks, without low leaves and those under a low style path."""
    blocks = parse_blocks(page)
    inside = any(b.article and not b.boiler for b in blocks)
    kept = ((b.path, b.text()) for b in blocks if not b.boiler and (b.article or not inside))
    return " ".join(t for path, t in kept if t and not (low and (leaf(path, t) in low or _under(path, low))))


def _under(path: str, low: frozenset[str]) -> bool:
    while path:
        if path in low:
            return True
        path = path.rpartition("/")[0]
    return False


def host_of() -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


#: Own words from which a page is no copy under a changing advert.
OWN_WORDS = 8
#: A host with more than this share of all pages is dealt out; there are fewer such hosts than its inverse.
HOT_SHARE = 1 / 4096
#: Pages of a host that are never worth a further part.
PART_PAGES = 32


def join_host(rows: DataFrame, per_host: DataFrame, per: DataFrame, salt: F.Column) -> DataFrame:
    """Rows with their host's row of ``per_host``; ``per`` is (host, pages).

    The table of hot hosts has less than 1 / HOT_SHARE rows whatever the input,
    so it is broadcast; other hosts have one part.
    """
    part = F.greatest(F.lit(float(PART_PAGES)), F.lit(HOT_SHARE) * F.lit(per.agg(F.sum("pages")).first()[0] or 0))
    hot = F.broadcast(per.where(F.col("pages") > part).select("host", F.ceil(F.col("pages") / part).alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    left = rows.join(hot, "host", "left").withColumn("salt", F.pmod(salt, parts)).drop("parts")
    right = (per_host.join(hot, "host", "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("parts"))
    return left.join(right, ["host", "salt"], "left").drop("salt")


_BLOCKS = "host string, sig long, paths array<string>, texts array<string>, words array<int>, article array<boolean>"


def _page_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page: style path, text's hash and word count of each unmarked block."""
    fields = [pa.field("host", pa.string()), pa.field("sig", pa.int64()), pa.field("paths", pa.list_(pa.string())),
              pa.field("texts", pa.list_(pa.string())), pa.field("words", pa.list_(pa.int32())), pa.field("article", pa.list_(pa.bool_()))]
    for batch in batches:
        rows = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            blocks = [(b, b.text()) for b in parse_blocks(page or "") if not b.boiler]
            paths, texts = [b.path for b, _ in blocks], [xxhash.xxh64_hexdigest(t) for _, t in blocks]
            sig = xxhash.xxh64_intdigest("\n".join(f"{p}#{t}" for p, t in zip(paths, texts, strict=True))) - 2**63
            rows.append((host, sig, paths, texts, [len(t.split()) for _, t in blocks], [b.article for b, _ in blocks]))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=pa.schema(fields))


def page_key(texts: list[str], words: list[int], article: list[bool], common: frozenset[str]) -> str:
    """What tells the host's different pages apart: the own text, or the longest block where that is next to nothing.

    In an article element at least half of the words must be own, elsewhere a
    quarter or ``OWN_WORDS``.
    """
    inside = any(article)
    rows = [(t, w) for t, w, a in zip(texts, words, article, strict=True) if a or not inside]
    own = [(t, w) for t, w in rows if t not in common]
    own_words, total = sum(w for _, w in own), sum(w for _, w in rows)
    if own and (2 * own_words >= total if inside else 4 * own_words >= total or own_words >= OWN_WORDS):
        return "".join(t for t, _ in own)
    return max(rows, key=lambda r: (r[1], r[0]), default=("", 0))[0]


_NODES = "host string, node string, leaf boolean, article boolean, key long, content long, layout long"


def _page_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and node: branches with hashes of their text and of
    their parent's layout, and the leaves that are common on the host."""
    names = [f.split()[0] for f in _NODES.split(", ")]
    types = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]

    def number(t: str) -> int:
        return xxhash.xxh64_intdigest(t) - 2**63

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            common = frozenset(r["common"] or ())
            key = number(page_key(r["texts"], r["words"], r["article"], common))
            below: dict[str, list[str]] = {}
            children: dict[str, dict[str, None]] = {}
            in_article: dict[str, bool] = {}
            for path, t, a in zip(r["paths"], r["texts"], r["article"], strict=True):
                if t in common:
                    in_article[f"{path}#{t}"] = a
                while path:
                    below.setdefault(path, []).append(t)
                    in_article[path] = in_article.get(path, False) or a
                    parent = path.rpartition("/")[0]
                    children.setdefault(parent, {})[path] = None
                    path = parent
            for node, a in in_article.items():
                if node in below:
                    layout = number("\n".join(children[node.rpartition("/")[0]]))
                    rows.append((r["host"], node, False, a, key, number("\n".join(below[node])), layout))
                else:
                    rows.append((r["host"], node, True, a, key, 0, 0))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def host_pages(pages: DataFrame) -> DataFrame:
    """(host, pages); every row is a page."""
    return materialise(pages.groupBy(host_of().alias("host")).agg(F.count(F.lit(1)).alias("pages")), "host-pages")


def low_branches(pages: DataFrame, threshold: float = 0.25, per: DataFrame | None = None) -> DataFrame:
    """(host, path, pages, importance) of branches and leaves below the threshold.

    With evidence = 1 - 1/pages, a branch has importance
    1 - evidence * (1 - content) * (1 - presentation), both entropies divided
    by the log of the number of different pages that show it; a leaf on k of
    the host's pages has 1 - evidence * ln k / ln pages.  Of a host's leaves
    only those on half of its pages or more are looked at: they are no more
    than twice the blocks of a mean page, so they fit an array.
    """
    per = host_pages(pages) if per is None else per
    # Copies of a page are one row from here on.
    found = materialise(pages.select(host_of().alias("host"), "html").where("html is not null").mapInArrow(_page_blocks, _BLOCKS)
                        .where("size(paths) > 0").dropDuplicates(["host", "sig"]), "style-blocks")
    counts = materialise(found.groupBy("host").agg(F.count(F.lit(1)).alias("different")), "style-counts")
    texts = (found.select("host", F.explode(F.array_distinct("texts")).alias("t")).groupBy("host", "t").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1"))
    common = (texts.join(counts, "host").where("2 * n >= different").groupBy("host").agg(F.collect_list("t").alias("common")))
    nodes = join_host(found, materialise(common, "style-common"), per, F.col("sig")).drop("sig").mapInArrow(_page_nodes, _NODES)
    nodes = materialise(nodes.groupBy("host", "node", "leaf", "key")
                        .agg(F.max("article").alias("article"), F.min("content").alias("content"), F.min("layout").alias("layout")),
                        "style-nodes")
    plogp = F.sum(F.col("n") * F.ln(F.col("n").cast("double")))
    evidence = 1 - 1 / F.col("pages")

    def entropy(name: str) -> DataFrame:
        g = (nodes.where("NOT leaf").groupBy("host", "node", name).agg(F.count(F.lit(1)).alias("n"), F.max("article").alias("article"))
             .groupBy("host", "node").agg(F.sum("n").alias("pages"), F.max("article").alias("article"), plogp.alias("s")))
        h = F.when(F.col("pages") > 1, (F.ln("pages") - F.col("s") / F.col("pages")) / F.ln("pages")).otherwise(1.0)
        return g.select("host", "node", "pages", "article", h.alias(name))

    branches = entropy("content").join(entropy("layout").drop("pages", "article"), ["host", "node"]).withColumn(
        "importance", 1 - evidence * (1 - F.col("content")) * (1 - F.col("layout")))
    keys = (nodes.where("NOT leaf").groupBy("host", "key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("one").alias("pages")))
    leaves = (nodes.where("leaf").groupBy("host", "node").agg(F.count(F.lit(1)).alias("k"), F.max("article").alias("article"))
              .join(keys, "host").where("pages > 1").withColumn("importance", 1 - evidence * F.ln("k") / F.ln("pages")))
    cols = ["host", F.col("node").alias("path"), "pages", "article", "importance"]
    return (branches.select(*cols).unionByName(leaves.select(*cols))
            .where(F.col("importance") < F.when(F.col("article"), threshold / 2).otherwise(threshold)).drop("article"))


def extract_main_text(pages: DataFrame, threshold: float = 0.25) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    rows = pages.select("page_id", "url", "html")
    per = host_pages(rows)
    low = low_branches(rows, threshold, per)
    per_host = materialise(low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low")), "style-tree")
    keyed = rows.withColumn("host", host_of())
    # Only hosts with low branches take part; without any, no page is moved.
    joined = (keyed.withColumn("low", F.lit(None).cast("array<string>")) if per_host.isEmpty()
              else join_host(keyed, per_host, per, F.xxhash64("page_id", "url", "html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", frozenset(low or ()))
                     for h, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                   pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    id_type = rows.schema["page_id"].dataType.simpleString()
    return (joined.select("page_id", "url", "html", "low")
            .mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long"))
