import html
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from loomprep.llm import html_extract as H


def text(source, low=frozenset()):
    return H.Page(source).main_text(low)


@pytest.mark.parametrize("source,want", [
    ("", ""),
    ("plain  text &amp; more", "plain text & more"),
    ("<article><h1>T</h1><p><b>one<br>two<p>three</article><footer>f</footer>", "T\n\none two\n\nthree"),
    ("<p>a<!-- x <p>y --> b</p><script>var t='</p>';</script><style>p{}</style>c", "a b\n\nc"),
    ("<nav><ul><li>m</ul></nav><div class='ad'>x</div><div id='content'>A<div>B</div>C</div>D",
     "A\n\nB\n\nC"),
    ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</article>", "T\n\nx"),
    ("<article><p>x</p><aside>s</aside><form>f<input></form><section class='comments'><article>"
     "<p>reader</article></section><p>y</p></article>", "x\n\ny"),
    ("<article><p>1 < 2 &lt;b&gt; &#233;&nbsp;z</p><p>&amp</p>&am<p", "1 < 2 <b> é z\n\n&\n\n&am"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>",
     "a\n\nb\n\nc\n\nd\n\ne"),
    ("<main><p>m</p></main><p>out</p>", "m"),
    ("<article><p>x <span class='advert'>buy</span> y</p></article>", "x\n\ny"),
    ("<article><p title='a>b'>q</p><textarea><p>t</textarea></article>", "q"),
    ("<article><p>a</p></article><p>b</p><article><p>c</p></article>", "a\n\nc"),
    ("<title>t</title><body class='has-sidebar'><p>kept</p></body>", "kept"),
    ("<div role='navigation'>n</div><p>k</p><div class='cookieBanner'>c</div>", "k")])
def test_page(source, want):
    assert text(source) == want


LONG = "Many words of the body stand here, one after another, in a row."


@pytest.mark.parametrize("source", [
    "<div class='post-title'>T</div><div class='body'><p>{}</p></div>",
    "<div class='entry-meta'>by A</div><div class='body'><p>{}</p></div>",
    "<main><p>{}</p><article class='card'><p>T</p></article></main>",
    "<main><p>{}</p></main><article><p>T</p></article>"])
def test_a_small_marked_part_does_not_take_the_body(source):
    assert LONG in text(source.format(LONG))


def test_a_low_mark_does_not_empty_the_page(spark):
    rows = [(k, f"http://a.example.com/{k}", f"<div class='main'><h1>Site</h1></div>"
             f"<div class='body'><p>{LONG} {k}</p></div>") for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {k: f"{LONG} {k}" for k in range(12)}


@pytest.mark.parametrize("source", [
    "<div class='content has-sidebar'><p>{}</p><div class='sidebar'>s</div></div>",
    "<div class='wrap no-sidebar'><p>{}</p></div>",
    "<div class='with-header'><article><p>{}</p></article></div><p>" + "o" * 60 + "</p>",
    "<div class='layout-rail'><article><p>{}</p></article><div class='rail'>r</div></div>",
    "<div class='layout-rail'><main><p>{}</p></main></div><div class='comments'>" + "c" * 60 + "</div>",
    "<main><div class='layout-rail'><p>{}</p></div></main>",
    "<div class='header-wrap'><div class='layout-rail'><article><p>{}</p></article></div></div>",
    "<article class='post category-social'><p>{}</p></article>",
    "<article class='tag-legal tag-newsletter'><p>{}</p></article><p>o</p>"])
def test_names_do_not_drop_the_main_part(source):
    assert text(source.format(LONG)) == LONG


def test_a_card_beside_does_not_drop_the_main_part():
    assert LONG in text(f"<div class='layout-rail'><article><p>{LONG}</p></article></div><article>T</article>")


def test_names_still_drop_what_is_beside():
    assert text(f"<article><p>{LONG}</p></article><section class='comments'><article><p>{LONG} no"
                "</p></article></section>") == LONG


def site(n=30):
    rows = []
    for k in range(n):
        rows.append((k, f"http://a.example.com/{k}", "<body><div class='x1'><p>Same words on every page</p>"
                     f"</div><div class='x2'><h2>Title {k}</h2><p>Body number {k}</p><p>More {k * 7}</p>"
                     "</div><div class='x3'>All rights</div></body>"))
    rows += [(100 + k, f"http://b.example.com/{k}", "<body><p>copied article</p></body>") for k in range(30)]
    rows += [(200, None, None), (201, "", ""), (202, "x", "<p>few"), (0, *rows[0][1:])]
    return rows


def test_repeated_branches_go_and_copies_stay(spark):
    rows = site()
    df = spark.createDataFrame([(*r, "h", [1]) for r in rows],
                               "page_id long, url string, html string, host string, low array<int>")
    got = sorted((r.page_id, r.url, r.text) for r in H.extract(df).na.fill("").collect())
    want = []
    for i, u, _ in rows:
        want.append((i, u or "", f"Title {i}\n\nBody number {i}\n\nMore {i * 7}" if i < 100 else
                     "copied article" if i < 200 else "few" if i == 202 else ""))
    assert got == sorted(want)
    assert H.extract(df.limit(0)).count() == 0


def plain(source):
    """The test tables' layout, read another way."""
    part = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", part))
    out = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in out if b)


def test_query_on_a_table(spark):
    path = "/root/testdata/sf0.1"
    pages = {r.page_id: r for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    got = H.op2_html_extract(spark, path).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text)


HOSTILE = {
    "unclosed quote": lambda n: "<a " * n + '">',
    "mixed quotes": lambda n: "<a \"' " * n + '">',
    "unclosed inline": lambda n: "<font>" * n + "<p>ab" * n,
    "nested adverts": lambda n: '<div class="ad">x' * n,
    "nested main": lambda n: '<div class="main">x' * n,
    "unclosed blocks": lambda n: "<div>x" * n,
    "unclosed script": lambda n: "<script>" + "</script " * n,
    "closing tags without opening": lambda n: "<div>x" * n + "</b>" * n,
    "lone brackets": lambda n: "<" * n}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time(kind):
    def seconds(n):
        source, start = HOSTILE[kind](n), time.process_time()
        H.Page(source).main_text(frozenset([1]))
        return time.process_time() - start
    assert seconds(64_000) < 16 * max(seconds(8_000), 0.05)


@pytest.mark.parametrize("source,want", [
    ("<a <b>x", "x"), ("a <b \"> c", "a <b \"> c"), ("<p <q 'z'>t", "t"), ("k <i 'x' \"y", "k"),
    ("a <b '> c <b>d", "a <b '> c d"),
    ("&#" + "9" * 6000 + ";x", "\ufffdx"), ("&#" + "0" * 6000 + "65;x", "Ax"),
    ("<script>a</script b", ""), ("<!-- a", ""), ("x</>y<?z?>w", "xyw")])
def test_odd_markup(source, want):
    assert text(source) == want


def test_a_very_long_page(spark):
    body = " ".join(f"w{k}" for k in range(300_000))
    df = spark.createDataFrame([(1, "http://a", f"<nav>m</nav><article><p>{body}</p></article>")],
                               "page_id long, url string, html string")
    assert H.extract(df).first().text == body


def random_tree(rng, depth):
    """(name, text, children) of nested div elements."""
    text = rng.choice(["", "", "same", f"own {rng.randint(0, 10 ** 6)}"])
    children = [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 2))] if depth else []
    return rng.choice("ab"), text, children


def markup(tree):
    name, text, children = tree
    return f"<div class='x{name}'>{text}{''.join(map(markup, children))}</div>"


def plain_importance(pages):
    """A style tree of nested dicts, read from the trees that the pages were made of."""
    shows, texts = defaultdict(set), defaultdict(set)

    def visit(tree, path, page):
        path += (tree[0],)
        shows[path].add((len(tree[2]), page))
        if tree[1]:
            texts[path].add((tree[1], page))
        for c in tree[2]:
            visit(c, path, page)

    # equal pages count once
    def words(tree):
        return ([tree[1]] if tree[1] else []) + [w for c in tree[2] for w in words(c)]
    for trees in pages:
        for t in trees:
            visit(t, (), tuple(w for t in trees for w in words(t)))
        shows[()].add((len(trees), tuple(w for t in trees for w in words(t))))

    def entropy(seen):
        n = Counter(v for v, _ in seen)
        total = sum(n.values())
        return -sum(c / total * math.log(c / total) for c in n.values()) / math.log(total) if total > 1 else None

    def rate(path):
        own, content = entropy(shows[path]), entropy(texts[path]) if path in texts else None
        weight = {p: max(len(shows[p]), len(texts.get(p, ()))) for p in shows if p[:-1] == path and p}
        below = sum(result.setdefault(p, rate(p)) * w for p, w in weight.items()) / sum(
            weight.values()) if weight else None
        parts = [x for x in (content, below) if x is not None]
        if not parts:
            return 1.0 if own is None else own
        return max(parts) if own is None else max(max(parts), (own + max(parts)) / 2)

    result: dict = {}
    result[()] = rate(())
    return sorted((len(p), max(len(shows[p]), len(texts.get(p, ()))), round(v, 9)) for p, v in result.items())


@pytest.mark.parametrize("depth", [3, 18])
def test_importance_is_that_of_a_plain_style_tree(spark, depth):
    rng = random.Random(depth)
    pages = [[random_tree(rng, min(depth, 4)) for _ in range(rng.randint(1, 3))] for _ in range(60)]
    if depth > 4:                           # the lower levels are judged branch by branch
        for trees in pages:
            for _ in range(depth - 4):
                trees[:] = [("d", rng.choice(["", "same"]), list(trees))]
    pages += pages[:5]
    rows = [(k, "http://a.example.com/x", "".join(map(markup, t))) for k, t in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.level, r.pages, round(r.total, 9)) for r in H.importance(df).collect())
    want = plain_importance(pages)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-6 for g, w in zip(got, want))
