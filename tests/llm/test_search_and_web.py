"""Nearest neighbours, link graph and page extraction against brute force."""

import random

import numpy as np
import pytest

from tests.llm.cases import CLASH
from tillcast.llm import linkgraph, vptree, wrapper

# -- nearest neighbours --------------------------------------------------------------


def _vectors(spark, extra=""):
    r = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=6)]) for i in range(900)]
    rows += [(2000 + i, [1.0] * 6) for i in range(300)]  # ties
    rows += [(3000, None), (3001, []), (3002, [0.0] * 6), (3003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3004, [float("nan")] * 6), (3005, [float("inf")] * 6),
             (None, [1.0] * 6), (100, rows[100][1]), (5, rows[5][1]), (4000, [1.0, 2.0]), (4001, [1.0, 2.5])]
    return rows, spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")


def _brute(rows, k):
    ok = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % 100 == 0:
            d = []
            for i, v in ok:
                if i != q and len(v) == len(x):
                    total = 0.0  # component by component (the built-in sum compensates rounding)
                    for a, b in zip(x, v):
                        gap = float(np.float32(a)) - float(np.float32(b))
                        total += gap * gap
                    d.append((float(np.sqrt(total)), i))
            out[q] = sorted(d)[:k]
    return out


@pytest.mark.parametrize("shard,block", [(8192, 4096), (100, 4)])
def test_exact_search_equals_brute_force(spark, shard, block):
    rows, df = _vectors(spark)
    got = {}
    for r in vptree.search(df.filter("vec_id % 100 = 0"), df.repartition(3), shard_rows=shard, query_block=block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = _brute(rows, 10)
    assert set(got) == {q for q, d in want.items() if d}
    for q, found in got.items():
        assert [(s, i) for _, s, i in sorted(found)] == want[q]
        assert [n for n, _, _ in sorted(found)] == list(range(1, len(found) + 1))


def test_relaxed_search_prunes_and_recalls():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 4))
    tree = vptree.Tree(np.arange(4000), x)
    q = r.normal(size=(40, 4))
    cost, answers = {}, {}
    for factor in (1.0, 1.5):
        best = vptree.Best(40, 10)
        cost[factor] = tree.search(q, np.full(40, -1), best, factor)
        answers[factor] = best.ids
    exact = np.argsort(vptree.distances(q, x), axis=1)[:, :10]
    assert np.array_equal(answers[1.0], exact)
    assert cost[1.5] < cost[1.0] < 40 * 4000
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(answers[1.5], exact)]) >= 0.9


def test_search_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vptree.search(df, df).count() == 0
    with pytest.raises(ValueError):
        vptree.search(df, df, factor=0.5)


# -- link graph --------------------------------------------------------------------------

def _pages(spark, rows, extra=()):
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows],
                                 "page_id long, url string, html string" + "".join(f", `{c}` string" for c in extra))


def link(*urls):
    return "".join(f'<p><a class="x" href="{u}">t</a></p>' for u in urls)


PAGES = [(1, "http://Good.ORG/a?x#y", link("http://friend.net/z", "/local")), (2, "https://sub.example.org/es/1", ""), (3, "https://example.org/en/12", None),
         (4, "https://example.org/en/2", ""), (5, "http://a.com/fr/x", ""), (6, "http://b.com/de/x", ""), (7, "http://b.com/en", ""),
         (8, "http://farm.net/x", link("http://b.com/de/", "HTTP://b.com/q", "https://b.com")), (9, "http://friend.net", link("http://b.com/")),
         (10, None, link("http://b.com")), (11, "no url", ""), (12, "", ""), (13, "http://good.org", ""), (1, "http://Good.ORG/a?x#y", link("http://friend.net/z", "/local")),
         (14, "http://notexample.org/es/", ""), (15, "ftp://far.net/a", ""), (16, "http://friend.net/b", link("http://good.org/")), (None, "http://a.com/fr/", "")]


def _brute_verdicts(pages):
    import re
    split = []
    for i, u, h in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        split.append((i, m[1].lower() if m else "", m[2] if m else "", h or ""))
    rule = {}
    for _, host, path, _ in split:
        fits = [(h + p, k) for k, h, p in linkgraph.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule[host, path] = max(fits, key=lambda x: len(x[0]), default=(None, None))
    hosts = {h for _, h, _, _ in split if h}
    share = lambda h, v: np.mean([rule[a, p][1] == v for _, a, p, _ in split if a == h])
    good, bad = ({h: share(h, v) for h in hosts} for v in ("allow", "block"))
    edges = {}
    for _, h, _, html in split:
        for u in re.findall(r'href="([a-zA-Z]+://[^"]*)"', html):
            t = re.match(r"^.*?://([^/?#]*)", u)[1].lower()
            if h and t and t != h:
                edges[h, t] = edges.get((h, t), 0) + 1
                hosts.add(t)
    out_n = {h: sum(n for (a, _), n in edges.items() if a == h) for h in hosts}
    in_n = {h: sum(n for (_, b), n in edges.items() if b == h) for h in hosts}
    t, d = dict(good), dict(bad)
    for _ in range(linkgraph.ITERATIONS):
        t, d = ({h: 0.15 * good.get(h, 0) + 0.85 * sum(t.get(a, 0) * n / out_n[a] for (a, b), n in edges.items() if b == h) for h in hosts},
                {h: 0.15 * bad.get(h, 0) + 0.85 * sum(d.get(b, 0) * n / in_n[b] for (a, b), n in edges.items() if a == h) for h in hosts})
    return [(i, h, p, rule[h, p][0], rule[h, p][1] or ("block" if h and d[h] > t[h] else "allow")) for i, h, p, _ in split]


def test_verdicts_equal_brute_force(spark):
    got = linkgraph.judge(_pages(spark, PAGES, CLASH)).select("page_id", "url_verdict.*").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["page_id"], r[1], r["path"], r["rule"], r["verdict"]) for r in got), key=key) == sorted(_brute_verdicts(PAGES), key=key)
    by = {r["page_id"]: r["verdict"] for r in got}
    assert by[8] == "block" and by[15] == "allow" and by[11] == "allow" and by[13] == "allow"


def test_verdicts_equal_sql(spark):
    """The registered SQL on a table with links between hosts."""
    import duckdb
    import pandas as pd
    from tillcast.llm.queries import ORACLE
    pages = pd.DataFrame([r for r in PAGES if r[0] is not None], columns=["page_id", "url", "html"])  # noqa: F841
    got = duckdb.sql(ORACLE["op9_linkgraph"]).fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(_brute_verdicts([r for r in PAGES if r[0] is not None]), key=key)


def test_link_graph_empty(spark):
    assert linkgraph.judge(_pages(spark, [(1, "x", "y")]).limit(0)).count() == 0


# -- pages -----------------------------------------------------------------------------------

def _article(seed, n=4):
    r = random.Random(seed)
    return [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "caf&eacute;"]) for _ in range(12)) for _ in range(n)]


def _page(paras, tag="article", attrs="", end="</body></html>"):
    body = "".join(f"<p>{p}</p>" for p in paras)
    return (f'<html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/x">menu {paras[0][:5]}</a></li></ul></nav>'
            f'<div class="cookie-notice">We use cookies</div><div id="sidebar"><p>side {paras[-1][:9]}</p></div><{tag}{attrs}><h1>Head</h1>{body}<div class="ad">buy</div></{tag}>'
            f'<section id="comments"><p>I disagree with {paras[0][:7]}</p></section><form><p>Subscribe</p></form><aside>more</aside><footer>&copy; site</footer>{end}')


def _plain(paras):
    return "\n\n".join(["Head", *(p.replace("&eacute;", "é") for p in paras)])


def test_main_text_of_pages(spark):
    rows, want = [], {}
    for k in range(6):
        rows.append((k, f"http://one.com/{k}", _page(_article(k, 2 + k))))
        want[k] = _plain(_article(k, 2 + k))
    for k in range(10, 15):  # no article element: the slot that varies is found by alignment
        rows.append((k, f"http://two.com/{k}", _page(_article(k, 3), "div", ' class="body"', "")))
        want[k] = _plain(_article(k, 3))
    rows += [(20, "http://lone.com", _page(_article(20), "div")), (21, None, None), (22, "http://two.com/z", ""), (0, "http://one.com/0", _page(_article(0, 2))),
             (23, "http://deep.com", "<div>" * 2000 + "a<p>b &amp c" + "</div>" * 2000), (24, "http://broken.com", "<article><p><b>un<br>closed<p>two\n  lines &am")]
    want |= {20: _plain(_article(20)), 21: "", 22: "", 23: "a\n\nb & c", 24: "un closed\n\ntwo lines &am"}
    got = wrapper.extract(_pages(spark, rows, [*CLASH, "main_text"])).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["main_text"] == want[r["page_id"]], r["page_id"]


def test_copies_of_a_page_are_one_reference(spark):
    """Whichever page has the copies, the slot that varies is found."""
    template = "<html><body><div class='top'>" + "<p>one more line that every page has</p>" * 9 + "</div><div class='body'>"
    pages = [template + "".join(f"<p>{p}</p>" for p in _article(70 + k, 3)) + "</div></body></html>" for k in range(4)]
    rows = [(10 * h + k, f"http://copies{h}.com/{k}", pages[k if k < 4 else h]) for h in range(4) for k in range(9)]
    for r in wrapper.extract(_pages(spark, rows)).collect():
        k = r["page_id"] % 10
        want = _article(70 + (k if k < 4 else r["page_id"] // 10), 3)
        assert r["main_text"] == "\n\n".join(p.replace("&eacute;", "é") for p in want), r["page_id"]


def test_ids_and_single_words_do_not_cost_text(spark):
    def page(k):
        t = [f"text {k} number {j} of this page" for j in range(6)]
        return (f'<body><nav>menu</nav><article><p>{t[0]}</p><h2 id="search">{t[1]}</h2><p id="notice-period">{t[2]}</p><section id="social"><p>{t[3]}</p></section>'
                f'<div class="skip-lines">{t[4]}</div><table class="menu-prices"><tr><td>{t[5]}</table><div class="comment-list"><p>reader {k}</p></div>'
                f'<div class="ad">buy {k}</div></article></body>'), "\n\n".join(t)
    for sites in (1, 5):  # all pages of one host, or one page a host
        rows = [(k, f"http://w{k % sites}.com/{k}", page(k)[0]) for k in range(5)]
        for r in wrapper.extract(_pages(spark, rows)).collect():
            assert r["main_text"] == page(r["page_id"])[1]


def test_template_lines_inside_the_content_go(spark):
    """Two layouts of one host, each with constant lines beside varying paragraphs."""
    one = lambda t: f'<body><div class="wrap"><p>Brand of the site</p>{"".join(f"<p>{x}</p>" for x in t)}<p>All rights kept</p></div></body>'
    two = lambda t: f'<body><section class="top">Another brand</section><section class="text"><div>{"</div><div>".join(t)}</div><div>Printed daily</div></section></body>'
    texts = {k: [f"line {j} of page {k} " * 5 for j in range(2 + k % 3)] for k in range(12)}
    rows = [(k, f"http://both.com/{k}", (one if k % 2 else two)(t)) for k, t in texts.items()]
    for r in wrapper.extract(_pages(spark, rows)).collect():
        assert r["main_text"] == "\n\n".join(x.strip() for x in texts[r["page_id"]]), r["page_id"]


def test_long_lists_of_blocks_are_matched_in_linear_memory():
    import time
    import tracemalloc
    page = lambda n, extra: wrapper.parse("<div>" + "".join(f"<p>{k}</p>" if k % 50 else "<ul><li>a</ul>" for k in range(n)) + extra + "</div>")
    a, b = page(10_000, "<table><tr><td>x</table>"), page(9_300, "<dl><dt>y</dl>")
    began = time.time()
    tracemalloc.start()
    pairs = wrapper.match(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) > 9_300 and peak < 64 << 20 and time.time() - began < 60
    assert all(x.label == y.label for x, y in pairs)


def test_pages_of_the_given_table_equal_their_article(spark):
    """The given pages have one template: everything in the article, block by block."""
    import html as entities
    import re
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r["main_text"] for r in wrapper.extract(df).collect()}
    for r in df.collect():
        body = re.search(r"(?s)<article[^>]*>(.*?)(</article>|$)", r["html"] or "")
        inner = re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "", body[1]) if body else ""
        parts = [" ".join(entities.unescape(re.sub(r"(?s)<[^>]*>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:h1|p)[^>]*>", inner)]
        assert found[r["page_id"]] == "\n\n".join(x for x in parts if x), r["page_id"]


def test_both_join_ways_agree(spark):
    df = _pages(spark, [(k, f"http://h{k % 3}.com/{k}", _page(_article(k))) for k in range(9)])
    a, b = ({r["page_id"]: r["main_text"] for r in wrapper.extract(df, broadcast_bytes=n).collect()} for n in (1 << 20, 0))
    assert a == b and len(a) == 9


def test_tree_matching_size():
    a, b = wrapper.parse("<div><p>x</p><ul><li>1<li>2</ul></div>"), wrapper.parse("<div><ul><li>1</ul><p>y</p></div>")
    assert len(wrapper.match(a, b)) == 4  # root, div, ul, li


def test_pages_empty(spark):
    assert wrapper.extract(_pages(spark, [(1, "x", "y")]).limit(0)).count() == 0


def test_long_lists_are_aligned_far_from_the_diagonal():
    many = "".join(f"<p>{k}</p>" for k in range(100))
    a = wrapper.parse(f"<div><h1>x</h1>{many}<h2>x</h2></div>")
    b = wrapper.parse(f"<div><h3>y</h3>{'<blockquote>y</blockquote>' * 70}{many}{'<hr>' * 10}</div>")
    pairs = wrapper.match(a, b)
    assert len(pairs) == 102 and all(x.text() == y.text() for x, y in pairs)  # root, div, 100 paragraphs
    rows = lambda s, ks: wrapper.parse("<table>" + "".join(f"<tr><td>{s}{k}</td><td>{k % 9}</td></tr>" for k in ks) + "</table>")
    pairs = wrapper.match(rows("a", range(150)), rows("b", range(60, 260)))  # every row has a partner, the second cells of all agree
    assert sum(x.tag == "tr" for x, _ in pairs) == 150
    assert sum(x.tag == "td" and x.text() == y.text() for x, y in pairs) == 150
