import math
import random
from collections import Counter

import pytest
import xxhash

from tidemark.llm.html_text import OWN_WORDS, extract_main_text, leaf, low_branches, main_text, parse_blocks

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="ad">Buy</div><!-- <p>no</p> -->
<div id="cookie-notice">We use cookies</div><article class="post"><header><h1>Head &amp; line</h1></header>
<p>One <b>bo</b>ld&nbsp;text<br>next<p>Two   words &lt;b&gt; &#233;
<form>Subscribe</form><div class="comments"><p>First!</p></div><aside>Side</aside></article><footer>&copy; all</footer>"""


def test_article_only():
    assert main_text(PAGE) == "Head & line One bold text next Two words <b> é"


def test_tolerates_anything():
    assert main_text("") == "" and main_text("plain") == "plain" and main_text("<p>a<p>b</div></p>c") == "a b c"
    assert main_text("<body><p>a <i>b</p><p>c</i> d") == "a b c d"
    assert main_text("<p>a<script>if (a<b) x</script>b") == "a b"
    assert main_text("<p>x <a href='a>b'>y</a> z") == "x y z"
    assert main_text("<p>1 < 2 and <") == "1 < 2 and <"
    assert main_text("<p>cut <b attr=") == "cut"
    assert [b.text() for b in parse_blocks("<ul><li>a<li>b</ul><table><tr><td>c<td>d")] == ["a", "b", "c", "d"]


def test_style_tree_removes_what_a_host_repeats(spark):
    def page(k, body):
        return (k, f"http://h.example/{k}", f"<html><body><div class='top'>Same on all</div><div class='main'>{body}</div></body></html>")

    pages = [page(k, f"<p>text number {k} of this host</p>") for k in range(12)]
    # Copies of one article under the same host say nothing about its importance.
    pages += [(100 + k, f"http://copy.example/{k}", f"<body><div class='x{k}'>{k}</div><div class='main'><p>the one long article</p></div>") for k in range(12)]
    pages += [(200, None, "<p>no host</p>"), (201, "http://h.example/n", None), (202, "http://h.example/e", "")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, low int")
    low = {(r.host, r.path.split("/")[-1].partition("#")[0]) for r in low_branches(df.select("page_id", "url", "html")).collect()}
    assert low == {("h.example", "div.top")}
    out = {r.page_id: r for r in extract_main_text(df).collect()}
    assert len(out) == len(pages)
    assert out[3].text == "text number 3 of this host" and out[3].n_chars == 26
    assert out[105].text == "5 the one long article"
    assert (out[200].text, out[201].text, out[202].text, out[202].n_chars) == ("no host", "", "", 0)


def test_few_pages_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>")], "page_id long, url string, html string")
    assert [r.text for r in extract_main_text(df).collect()] == ["a", "a"]
    assert extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ["svg", "select", "template", "noscript", "iframe"])
def test_raw_element_without_end_keeps_the_rest(tag):
    assert main_text(f"<article><p>One.</p><{tag}>junk<p>Two.</p></article><p>Out.</p>") == "One. Two."
    assert main_text(f"<div><p>One <a><{tag}>junk</a> more.</p></div><div>Two.</div>") == "One more. Two."
    assert main_text(f"<p>One.</p><{tag}>junk</{tag}><p>Two.</p>") == "One. Two."


def test_self_closed_svg_and_endless_script():
    assert main_text("<p>One.</p><svg width='1'/><p>Two.</p><svg><text>x</text></svg><p>Three.</p>") == "One. Two. Three."
    assert main_text("<p>One.</p><script>var x; <p>Two.</p>") == "One."


NOTICE = "By reading on you agree to what this notice says, " * 12


@pytest.mark.parametrize("shape", [
    "<body><div><p>{notice}</p></div><div><p>{body}</p></div></body>",  # the same style path as the article
    "<body><div class='x'>{notice}</div><div class='y'><p>{body}</p></div></body>",
    "<body><div class='y'><p>{body}</p></div><section>{notice}</section></body>",
])
def test_unmarked_notice_longer_than_the_article_goes(spark, shape):
    bodies = [f"Report {k} tells of town {k * 7} and of its {k + 3} wells." for k in range(40)]
    rows = [(k, f"http://n.example/{k}", shape.format(notice=NOTICE, body=b)) for k, b in enumerate(bodies)]
    # Exact copies of one page, many more than there are different pages, change nothing.
    rows += [(100 + k, f"http://n.example/c{k}", rows[0][2]) for k in range(90)]
    out = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[k] for k in range(40)] == bodies
    assert {out[100 + k] for k in range(90)} == {bodies[0]}


def test_evidence_grows_with_the_pages(spark):
    def rows(n):
        return [(k, f"http://h{n}.example/{k}", f"<div class='t'>Same on all</div><div class='m'>own text {k} of page {k * k}</div>")
                for k in range(n)]

    for n, kept in [(2, True), (4, True), (5, False), (7, False)]:
        out = extract_main_text(spark.createDataFrame(rows(n), "page_id long, url string, html string")).collect()
        assert all(r.text.startswith("Same on all") == kept for r in out), n


def test_near_copies_in_article_elements_stay(spark):
    """Pages that share most of their article are one page: what they share is no menu."""
    body = "".join(f"<p>Paragraph {i} of the article that was copied.</p>" for i in range(9))
    rows = [(k, f"http://c.example/{k}", f"<article>{body}<p>Edition {k} only.</p></article>") for k in range(20)]
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text.startswith("Paragraph 0") and r.text.endswith(f"Edition {r.page_id} only.") for r in out)


def test_class_names_are_judged_whole():
    assert main_text("<div class='post ad-free'><p>All of it.</p></div>") == "All of it."
    assert main_text("<article><p>One.</p><div class='side-note'>Two.</div></article>") == "One. Two."
    assert main_text("<div class='post has-sidebar'><p>One two three.</p></div><div class='x'>Four.</div>") == "One two three. Four."
    assert main_text("<div><p>The article of five words.</p></div><div class='blog-comments'>First!</div>") == "The article of five words."
    for name in ["ad", "ad-box", "cookie-notice", "site-footer", "comment-list", "related-posts", "nav_links"]:
        assert main_text(f"<div><p>The article itself.</p></div><div class='{name}'>junk</div>") == "The article itself.", name


def _brute_low(pages, threshold=0.25):
    """The tree in plain Python over whole pages, with texts instead of hashes."""
    hosts = {}
    for url, page in pages:
        host = url.split("//")[1].split("/")[0]
        blocks = tuple((b.path, b.text(), b.article) for b in parse_blocks(page or "") if not b.boiler)
        if blocks:
            hosts.setdefault(host, set()).add(blocks)
    low = set()
    for host, different in hosts.items():
        df = Counter(t for blocks in different for t in {t for _, t, _ in blocks})
        common = {t for t, n in df.items() if n > 1 and 2 * n >= len(different)}
        shown, article, keys = {}, {}, set()
        for blocks in different:
            inside = any(a for _, _, a in blocks)
            rows = [t for _, t, a in blocks if a or not inside]
            own = [t for t in rows if t not in common]
            o, w = sum(len(t.split()) for t in own), sum(len(t.split()) for t in rows)
            if own and (2 * o >= w if inside else 4 * o >= w or o >= OWN_WORDS):
                key = tuple(own)
            else:
                key = max(rows, key=lambda t: (len(t.split()), xxhash.xxh64_hexdigest(t)))
            keys.add(key)
            below, children = {}, {}
            for path, t, a in blocks:
                if t in common:
                    shown.setdefault((path, t), {})[key] = None
                    article[path, t] = article.get((path, t), False) or a
                parts = path.split("/")
                for d in range(len(parts), 1, -1):
                    p, up = "/".join(parts[:d]), "/".join(parts[:d - 1])
                    below.setdefault(p, []).append(t)
                    children.setdefault(up, {})[p] = None
                    article[p] = article.get(p, False) or a
            for p, ts in below.items():
                shown.setdefault(p, {}).setdefault(key, (tuple(ts), tuple(children[p.rpartition("/")[0]])))
        for node, by_key in shown.items():
            m = len(keys) if isinstance(node, tuple) else len(by_key)
            if m < 2:
                continue
            if isinstance(node, tuple):
                importance = 1 - (1 - 1 / m) * math.log(len(by_key)) / math.log(m)
            else:
                parts = [sum(n / m * math.log(m / n) for n in Counter(v[i] for v in by_key.values()).values()) / math.log(m) for i in (0, 1)]
                importance = 1 - (1 - 1 / m) * (1 - parts[0]) * (1 - parts[1])
            if importance < (threshold / 2 if article[node] else threshold):
                low.add((host, leaf(*node) if isinstance(node, tuple) else node))
    return low


def test_tree_against_plain_python(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(260):
        host = rnd.choice(["a", "a", "a", "b", "b", "c", "d", "e"])
        def some(n):
            return " ".join(rnd.choices(words, k=n))
        parts = [f"<div class='top'>{host} start</div>" if rnd.random() < 0.9 else f"<div class='top'>{some(2)}</div>",
                 f"<div><p>{host} notice {' long' * 30}</p></div>" if rnd.random() < 0.8 else "",
                 "".join(f"<div><p>{some(9)}</p></div>" for _ in range(rnd.randint(0, 4))),
                 f"<section><ul><li>x</li><li>{rnd.choice('pq')}</li></ul></section>" if rnd.random() < 0.7 else ""]
        body = "".join(parts)
        rows.append((k, f"http://{host}.example/{k}", f"<body><article>{body}</article>" if host == "b" else f"<body>{body}"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.host, r.path) for r in low_branches(df).collect()}
    want = _brute_low([(u, h) for _, u, h in rows])
    assert got == want and len(want) > 8
    by_host = {}
    for host, node in want:
        by_host.setdefault(host, set()).add(node)
    texts = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert texts == {k: main_text(h, frozenset(by_host.get(u.split("//")[1].split("/")[0], ()))) for k, u, h in rows}
