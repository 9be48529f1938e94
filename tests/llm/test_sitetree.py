"""Main text of pages: fixed templates, damaged markup, and the site tree against its definition."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from dispatchlake.llm import dom, sitetree

SCHEMA = "page_id long, url string, html string, text string, n_chars long, key long, kind int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, 2, 3) for i, u, h in rows], SCHEMA)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def plain(page):
    return sitetree.extract_text("http://a.example/", page, lambda key: False)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a<b>b</b>c<p>d", "abc d"),
        ("<article><h1>T</h1><p><b>x<br><p>y &amp; z&ampq &am</article><footer>f</footer>", "T x y & z&q &am"),
        ("<nav><ul><li>n<li>m</ul><article>a</article>", "a"),
        ("<article><!-- c --><script>var t='</p>';</script>a\n\n b&nbsp;c<style>p{}</style></article>", "a b c"),
        ("<body><header>site</header><main><header><h1>T</h1></header>a<aside>s</aside><form>f</form></main>", "T a"),
        ("<article>a<div class='comments'><p>c</div>b</article><article class=comment>d</article>", "a b"),
        ("<form action=/x><article>a</article></form>", "a"),
        ("<div id=cookieNotice>c</div><div class='post-body'>long text of it</div><div>o</div>", "long text of it"),
        ("<div class=ad>x</div><p>a</p><ul><li><a href=/>one</a><li><a href=/>two</a></ul>", "a"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<article>a < b <c d='>'>e</c></article>", "a < b e"),
        ("<p title=it's>a</p>b's", "a b's"),
        ("<article>x<!-- open", "x"),
        ("<script>never ends", ""),
        ("<title>t</title>", ""),
        ("", ""),
        (None, ""),
        ("<<<>>></p></div>&#x41;&#0;", "<<<>>> A�"),
    ],
)
def test_text_of_one_page(page, text):
    assert plain(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "in" + "</div>" * 5000 + "<p>out"
    assert plain(deep) == "in out"
    long = "<article>" + "<p>word one</p>" * 20_000 + "</article>"
    assert plain(long) == " ".join(["word one"] * 20_000)
    assert plain("<a '" * 5000 + "x") is not None


def site(rnd, pages=30):
    """Pages without names: menus and a footer of few variants, a text of its own, one common block inside."""
    rows = []
    for i in range(pages):
        own = "".join(f"<p>{' '.join(rnd.choices('abcdefgh', k=12))} {i}-{j}</p>" for j in range(rnd.randrange(2, 5)))
        rows.append(
            (i, "http://www.site.example/%d" % i,
             f"<div><span>menu</span> of all</div><div><div>{own}</div><div>Tell a friend</div></div><div>Made by us</div>")
        )
    return rows


def test_branches_of_a_site_go_by_importance(spark, monkeypatch):
    rows = site(random.Random(4))
    rows += [(100, "http://other.example/", rows[0][2]), (101, None, rows[1][2]), (102, "http://www.site.example/x", None)]
    rows += [(None, "http://x.example/", "<article>q</article>"), (0, rows[0][1], rows[0][2])]
    got = texts(sitetree.main_text(table(spark, rows)))
    for i, _, page in rows[:30]:
        assert got[i] == " ".join(re.findall("<p>(.*?)</p>", page))
    # a site of one page shows no template
    assert got[100].startswith("menu of all") and got[101].endswith("Made by us") and got[102] == "" and got[None] == "q"
    monkeypatch.setattr(sitetree, "BROADCAST_KEYS", 0)
    assert texts(sitetree.main_text(table(spark, rows))) == got


def test_repeated_articles_stay(spark):
    same = "<nav>n {0}</nav><article><h1>t</h1><p>one text</p><div>more</div></article><footer>f</footer>"
    rows = [(i, "http://a.example/%d" % i, same.format(i)) for i in range(12)]
    assert set(texts(sitetree.main_text(table(spark, rows))).values()) == {"t one text more"}


def test_importance_equals_its_definition(spark):
    rnd = random.Random(7)
    rows = [(i, "http://a.example/", "".join(
        f"<div><div>{'<p>x</p>' * rnd.randrange(3)}<ul>{rnd.choice('ab')}</ul></div>{rnd.choice('cde')}</div>"
        for _ in range(rnd.randrange(1, 3))) + f"<p>{i % 17}</p>") for i in range(40)]
    seen, styles, where, content = defaultdict(set), defaultdict(dict), {}, defaultdict(Counter)
    for i, url, page in rows:
        parsed = dom.read(page)
        roles = sitetree.Roles(parsed)
        tree = sitetree.Tree(parsed, roles, "a.example")
        mark = tuple(t for _, t in sitetree.blocks(parsed.events, lambda n: True))
        keys = sitetree._leaf_keys(parsed, tree)
        for key, style, parent, *_ in tree.rows:
            seen[key].add(mark)
            styles[key][mark] = style
            where[key] = parent
        for (key, text), n in Counter((keys[n], t) for n, t in sitetree.blocks(parsed.events, lambda n: True)).items():
            content[key][(text, mark)] = n

    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts) / math.log(m)

    def value(key):
        m, by_style = len(seen[key]), Counter(styles[key].values())
        if m == 1:
            return 1.0
        if set(by_style) == {0}:
            features = {t for t, _ in content[key]}
            return 1 - sum(entropy([n for (t, _), n in content[key].items() if t == f], m) for f in features) / max(1, len(features))
        damp = sitetree.GAMMA ** len(by_style)
        below = 0.0
        for style, count in by_style.items():
            nodes = [k for k, p in where.items() if p == key and all(styles[key].get(x) == style for x in seen[k])]
            below += count / m * sum(value(k) for k in nodes) / len(nodes)
        return (1 - damp) * entropy(by_style.values(), m) + damp * below

    sitetree_min, sitetree.MIN_PAGES = sitetree.MIN_PAGES, 2
    try:
        got = {r.key: 1 - r.lost for r in sitetree.composite(sitetree.importance(table(spark, rows).select("url", "html"))).collect()}
    finally:
        sitetree.MIN_PAGES = sitetree_min
    shared = {k for k in seen if len(seen[k]) > 1 and where[k] != 0}
    assert shared == set(got) - {sitetree.digest("a.example")} and len(shared) > 10
    for key in shared:
        assert abs(got[key] - value(key)) < 1e-9


def test_given_pages_give_their_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = sitetree.main_text(pages).collect()
    source = {r.page_id: r for r in pages.collect()}
    assert len(got) == len(source)
    for r in got:
        article = re.search("<article>(.*)</article>", source[r.page_id].html, re.S)[1]
        article = re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", article))
        assert r.text == " ".join(html.unescape(article).split())
        assert (r.url, r.n_chars) == (source[r.page_id].url, len(r.text))


def test_no_pages(spark):
    none = sitetree.main_text(table(spark, []))
    assert none.count() == 0 and none.columns == ["page_id", "url", "text", "n_chars"]
