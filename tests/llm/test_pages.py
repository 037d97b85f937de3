"""Extraction of articles: parsing, the style tree against a recursive version, and whole sites."""

import math
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import pytest
from loopwise.llm import pages as operator
from loopwise.llm.html import FLOW, article_of, parse
from loopwise.llm.pages import article_text, extract_articles, style_tree, unimportant

SCHEMA = "page_id long, url string, html string, text string"


def text(html):
    return article_text(parse(html), set())


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<p><b>a.<br><p>b <i>c</i></p>", "a.\nb c"),
        ("<div>x<p>y</p>z</div>", "x\ny\nz"),
        ("a < b &amp; c&nbsp; d &eacute;&#233;&lt;p>", "a < b & c d éé<p>"),
        ("<table><tr><td>1<td>2<tr><td>3</table>after", "1\n2\n3\nafter"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"),
        ("<h1>a<h2>b</h2>c", "a\nb\nc"),
        ('<script>if (a < b) t = "</p>";</script>x<style>p{}</style>', "x"),
        ("x<script>y", "x"),
        ("x<!-- <p>y -->z<!-- end", "xz"),
        ("<!-->x", "x"),
        ('<a title="x>y" href=z>q</a>', "q"),
        ('<p id="a>b</p>c', "b\nc"),
        ("<head><title>t</title><p>x", "x"),
        ("<p>x</div></p></body>tail</html>", "x\ntail"),
        ("<nav>n</nav><header>h</header><main><h1>t</h1>x</main><aside>s</aside><footer>f</footer>", "t\nx"),
        ("<form>q</form><article><header><h1>T</h1><p>by</p></header><p>x <span class='ad'>buy</span> y</p><footer>f</footer></article>", "T\nx y"),
        ("<article><p>x</p><section id='comments'><article class='comment'><p>c</p></article></section></article>", "x"),
        ("<div class='page has-sidebar'><article>k</article></div><div class='sidebar'>s</div>", "k"),
        ("<form><article>k</article><div>q</div></form>", "k"),
        ("<div role='main'><p>x</p></div><div>y</div>", "x"),
        ("<div itemprop='articleBody'><p>x</p></div><div>y</div>", "x"),
        ("<div class='site-header'><h1>s</h1></div><div class='cookie-notice'>c</div><div class='ad'>a</div><p>x</p><p style='display: none'>h</p><p hidden>h</p>", "x"),
        ("<p>x<button>b</button><select><option>o</select><textarea><p>t</textarea> y</p>", "x y"),
        ("<svg><text>t</text></svg>out<noscript><p>n</p></noscript>", "out"),
        ("<p>shade broadside address</p><p class='shaded'>added</p>", "shade broadside address\nadded"),
    ],
)
def test_text_of_a_page(html, want):
    assert text(html) == want


def test_long_and_odd_pages_take_linear_time():
    for html in ("<div>" * 100_000 + "x", "<p>x" * 100_000, "</div>" * 100_000 + "x", "<td></p>" * 50_000, "<table><td><p>" * 30_000 + "</p></tr>" * 30_000, "<!" * 100_000, "<a " * 100_000, '<a b="' * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "&amp" * 100_000, "<a =" + " " * 200_000, "<ul><li>" * 30_000 + "</b>" * 30_000):
        article_of(parse(html))


SITE = "<html><body><div class='top'><ul><li><a href='/a'>Start</a><li><a href='/b'>Shop</a></ul></div><div class='story'>{}</div><div class='end'>Call us<div>All rights</div></div></body></html>"


def site(n, host="h.example", said=False):
    words = "one two three four five six seven eight nine ten".split()
    out = []
    for i in range(n):
        body = "".join(f"<p>{words[(i + k) % 10]} {i} {k}</p>" for k in range(1 + i % 4))
        out.append((i, f"http://{host}/{i}", SITE.format(f"<article>{body}<div class='x'>Join <a href='/j'>us</a></div></article>" if said else body), "clash"))
    return out


def merged(rows):
    """Style trees as nested dicts and the importance of each container, by recursion from the definition."""
    trees = {}
    seen = set()

    def build(page, i, node):
        kids = page.children[i]
        node["tag"] = page.tag[i]
        style = node["styles"].setdefault(tuple("#" if k < 0 else page.label[k] for k in kids), {"n": 0, "kids": [{"pages": 0, "styles": {}, "texts": []} for _ in kids]})
        node["pages"] += 1
        style["n"] += 1
        for k, child in zip(kids, style["kids"], strict=True):
            if k < 0:
                child["pages"] += 1
                child["texts"].append(Counter([("t", page.texts[-1 - k]), *(("a", x) for x in page.links[-1 - k])]))
            else:
                build(page, k, child)

    for _, url, html, *_ in rows:
        page = parse(html)
        if (urlsplit(url).hostname, html) not in seen:
            seen.add((urlsplit(url).hostname, html))
            build(page, 0, trees.setdefault((urlsplit(url).hostname, page.label[0]), {"pages": 0, "styles": {}, "texts": []}))

    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts) / math.log(m)

    out = []

    def importance(node, path):
        m = node["pages"]
        if node["texts"]:
            features = defaultdict(list)
            for page in node["texts"]:
                for f, c in page.items():
                    features[f].append(c)
            return 1.0 if m == 1 else 1 - sum(entropy(c, m) for c in features.values()) / len(features)
        own = 1.0 if m == 1 else entropy([s["n"] for s in node["styles"].values()], m)
        weight = 0.9 ** len(node["styles"])
        below, kids = 0.0, False
        for key, s in node["styles"].items():
            if s["kids"]:
                kids = True
                below += s["n"] / m * sum(importance(c, (*path, key, i)) for i, c in enumerate(s["kids"])) / len(s["kids"])
            else:
                below += s["n"] / m * own
        value = (1 - weight) * own + weight * below if kids else own
        if node["tag"] not in FLOW and node["tag"] not in ("html", "body", "article", "main"):
            out.append((m, round(value, 9)))
        return value

    for tree in trees.values():
        importance(tree, ())
    return Counter(out)


def test_importance_equals_the_merged_trees(spark, monkeypatch):
    rows = site(14) + site(9, "g.example") + site(1, "single.example") + [(90, "http://h.example/x", "<body><div>" + "".join(f"<div>{k}</div>" for k in range(5)) + "</div></body>", "")] * 3
    rows += [(91, "http://h.example/y", "<body><div>" + "".join(f"<div>{k % 2}</div>" for k in range(5)) + "</div></body>", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = []
    real = operator.materialise
    monkeypatch.setattr(operator, "materialise", lambda d, name: kept.append((name, real(d, name))) or kept[-1][1])
    unimportant(df).collect()
    boxes = dict(kept)["containers"]
    got = Counter()
    for r in boxes.groupBy("name").agg({"pages": "sum", "importance": "avg"}).join(boxes.selectExpr("name", "importance * pages w", "pages").groupBy("name").sum("w", "pages"), "name").collect():
        got[r["sum(pages)"], round(r["sum(w)"] / r["sum(pages)"], 9)] += 1
    assert got == merged(rows)


def test_layouts_count_exact_copies_once(spark):
    rows = site(4) * 3
    layouts, nodes = style_tree(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["pages"] for r in layouts.collect()) == [1, 1, 1, 1] and nodes.count() > 0


def found(df):
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    rows = df.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return Counter((r["page_id"], r["text"]) for r in rows)


@pytest.mark.parametrize("most", [10**6, -1])  # removed branches are broadcast, or joined
def test_frame_without_names_is_found_by_the_tree(spark, monkeypatch, most):
    monkeypatch.setattr(operator, "BROADCAST_BRANCHES", most)
    rows = site(12) + [(100 + i, u, h, "") for i, u, h, _ in site(2, "small.example")]
    want = Counter((i, text(h.split("<div class='story'>")[1].split("<div class='end'>")[0])) for i, _, h, _ in rows[:12])
    want += Counter((i, text(h)) for i, _, h, _ in rows[12:])
    assert found(extract_articles(spark.createDataFrame(rows, SCHEMA).repartition(4))) == want


def test_a_repeated_box_in_the_article_goes_repeated_paragraphs_stay(spark):
    rows = site(12, said=True)
    copies = [(50 + i, f"http://h.example/c{i}", SITE.format(f"<article><p>the same passage</p><p>on many pages</p><div class='x'>Join <a href='/j'>us</a></div></article><i>{i}</i>"), "") for i in range(8)]
    got = found(extract_articles(spark.createDataFrame(rows + copies, SCHEMA)))
    assert all("Join" not in t for _, t in got) and sum("the same passage\non many pages" == t for _, t in got.elements()) == 8


def test_pages_that_are_all_alike_keep_their_text(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class='a'><div>only this</div></div><!-- {i} --></body>", "") for i in range(6)]
    near = [(i, f"http://g.example/{i}", f"<body><article><div class='a'>the same story on all pages</div><p>{i}</p></article></body>", "") for i in range(6)]
    got = found(extract_articles(spark.createDataFrame(rows + near, SCHEMA)))
    assert sum(c for (_, t), c in got.items() if t == "only this") == 6 and sum("the same story" in t for _, t in got) == 6


def test_odd_rows(spark):
    odd = [(None, None, None, None), (1, None, "<p>a", "x"), (1, None, "<p>a", "x"), (2, "no url", "<p>b</p>", ""), (3, "http://[bad", "<p>c", ""), (4, "http://h.example/", "", ""), (5, "http://h.example/", "<p>" + "long " * 200_000, "")]
    got = found(extract_articles(spark.createDataFrame(odd, SCHEMA)))
    assert got == Counter({(None, ""): 1, (1, "a"): 2, (2, "b"): 1, (3, "c"): 1, (4, ""): 1, (5, ("long " * 200_000).strip()): 1})
    assert extract_articles(spark.createDataFrame([], SCHEMA)).count() == 0
