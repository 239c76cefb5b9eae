"""Wrapper induction: tree matching against brute force, slots without telling names, odd trees."""

import random
import time
from functools import cache

import pytest

from weftline.llm import wrapper

SCHEMA = "page_id long, url string, html string"


def random_tree(rng, depth):
    return (rng.choice("abc"), tuple(random_tree(rng, depth - 1) for _ in range(rng.randint(0, 4))) if depth else ())


def as_runs(tree):
    rows = []

    def walk(node, depth):
        rows.append([depth, node[0], []])
        for child in node[1]:
            walk(child, depth + 1)

    walk(tree, 1)
    return wrapper.from_skeleton(rows)


@cache
def brute(a, b):
    """Largest matching of two trees with one label, by trying every way to go on."""

    @cache
    def forests(x, y):
        if not x or not y:
            return 0
        best = max(forests(x[1:], y), forests(x, y[1:]))
        return max(best, brute(x[0], y[0]) + forests(x[1:], y[1:])) if x[0][0] == y[0][0] else best

    return 1 + forests(a[1], b[1])


@pytest.mark.parametrize("cells", [wrapper.CELLS, 1])
def test_tree_matching_equals_brute_force(cells):
    rng = random.Random(1)
    for _ in range(300):
        a, b = (("#root", (("r", random_tree(rng, 3)[1]),)) for _ in range(2))
        x, y = as_runs(a[1][0]), as_runs(b[1][0])
        matching = wrapper.Matching(cells)
        assert matching.score(x, y) == 1 + brute(a[1][0], b[1][0])
        work, matched = [(x, y)], 0
        while work:
            u, v = work.pop()
            matched += 1
            assert u.label == v.label
            pairs = matching.children(u, v)
            where = sorted((u.children.index(p), v.children.index(q)) for p, q in pairs)
            assert where == sorted(where, key=lambda w: w[1]) and len({i for i, _ in where}) == len({j for _, j in where}) == len(where)
            work += pairs
        assert matched == matching.score(x, y)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n))


def plain_page(rng, i):
    """A page of divs without a name or a telling element, and its article."""
    paragraphs = [prose(rng, rng.randint(15, 60)) for _ in range(rng.randint(1, 5))]
    title = f"Title {i}"
    menu = "".join(f"<li><a href=/{k}>{prose(rng, 1)}</a></li>" for k in range(5))
    advert = f"<div>{prose(rng, 8)}</div>" if rng.random() < 0.8 else ""
    html = (
        f"<html><body><div><ul>{menu}</ul></div>{advert}<div><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}"
        f"<div>Follow us everywhere</div></div><div>&copy; site {prose(rng, 2)}</div></body></html>"
    )
    return html, " ".join([title, *paragraphs])


def test_slots_choose_the_content_without_telling_names(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(60):
        html, text = plain_page(rng, i)
        rows.append((i, f"http://www.site{i % 3}.com/{i}", html))
        want[i] = text
    for i in range(60, 66):  # hosts of one page, together a domain's; and a domain of one
        html, text = plain_page(rng, i)
        rows.append((i, f"http://h{i}.small.org/{i}", html))
        want[i] = text
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert all(wrapper.extract(html) != want[i] for i, _, html in rows)


def test_copies_of_an_article_are_no_template(spark):
    rng = random.Random(3)
    copied = "<h1>Same</h1><p>" + prose(rng, 80) + "</p>"
    page = "<html><body><div>Menu {}</div><div>{}</div><div>Imprint</div></body></html>"
    rows = [(i, "http://a.com/", page.format(prose(rng, 3), copied if i < 27 else f"<h1>T{i}</h1><p>{prose(rng, 40)}</p>")) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    own = wrapper.extract(f"<div>{copied}</div>")
    assert all(got[i] == own for i in range(27)) and all(got[i].startswith(f"T{i} ") for i in range(27, 30))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p>one</p><section id="related-work"><p>two</p></section><div class="social-science">three</div></article>', "one two three"),
        ('<article><p>one</p><div class="related-posts">x</div><div id="commentList">x</div><div class="cookie-notice bar">x</div></article>', "one"),
        ('<body><div role="navigation">x</div><div role="main">y</div></body>', "y"),
        ("<a href=x><div>a <b>block</b></div></a> tail", "a block tail"),
    ],
)
def test_names_count_as_a_whole(page, text):
    assert wrapper.extract(page) == text


def test_a_form_around_everything_is_no_furniture(spark):
    rng = random.Random(4)
    texts = [prose(rng, 30) for _ in range(6)]
    rows = [(i, "http://f.com/", f"<body><form><div>Menu</div><div><p>{t}</p></div></form></body>") for i, t in enumerate(texts)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(6)] == texts


def test_very_wide_very_deep_and_very_long_pages(spark):
    wide = ["".join(f"<p>p{i}x{k}</p><ul><li>u{i}</li></ul>" for i in range(2000)) for k in range(4)]
    deep = "<div>" * 5000 + "{}" + "</div>" * 5000
    body = "<body><div>Menu</div><div><h1>{}</h1>{}</div><div>End</div></body>"
    rows = [(i, "http://w.com/", body.format(f"T{i}", f"<h2>{i}</h2>" * (i % 2) + wide[i])) for i in range(4)]
    rows += [(10 + i, "http://d.com/", deep.format(f"<p>inner {i}</p><h2>x</h2>")) for i in range(4)]
    rows += [(20 + i, "http://l.com/", body.format(f"T{i}", f"<p>{'long word ' * 300_000}{i}</p>")) for i in range(3)]
    rows += [(30 + i, "http://m.com/", "</x>" * 3000 + "<div><span>" * 3000 + f"n{i}") for i in range(3)]
    began = time.time()
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert time.time() - began < 60
    assert [got[k] for k in range(4)] == [f"T{k} {f'{k} ' * (k % 2)}" + " ".join(f"p{i}x{k}" for i in range(2000)) for k in range(4)]  # equal items are template
    assert [got[10 + i] for i in range(4)] == [f"inner {i}" for i in range(4)]  # the heading is template
    assert all(got[20 + i] == f"T{i} {'long word ' * 300_000}{i}" for i in range(3))
    assert [got[30 + i] for i in range(3)] == [f"n{i}" for i in range(3)]


def test_levels_outside_the_article_change_nothing():
    for levels in (1, 28, 32, 200):
        page = "<div>" * levels + "<article><p>real text</p></article>" + "</div>" * levels + "<p>outside</p>"
        assert wrapper.extract(page) == "real text"


def test_skeletons_go_round():
    root = wrapper.run_tree(wrapper.parse("<body><div class='a b' id=c><p>x<p>y</div><div><ul><li>z</ul></div></body>"))
    again = wrapper.from_skeleton(wrapper.skeleton(root))
    assert again.shape == root.shape and [r.path for r in wrapper.inside(again)] == [r.path for r in wrapper.inside(root)]


def six_pages(spark, body):
    """Texts of six pages of one host by their wrapper, and by structure; ``body`` makes a page's body from its prose."""
    rng = random.Random(6)
    rows = [(i, "http://c.com/", f"<body><nav>Menu</nav>{body(lambda n: prose(rng, n), i)}<footer>End</footer></body>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    return [got[i] for i in range(6)], [wrapper.extract(h) for _, _, h in rows]


@pytest.mark.parametrize(
    "body",
    [
        lambda p, i: f"<main><section class=intro><p>{p(40)}</p></section><section class=body><p>{p(100)}</p></section><section class=end><p>{p(40)}</p></section></main>",
        lambda p, i: f"<article><p>{p(30)}</p></article><article class=second><p>{p(30)}</p></article>",
        lambda p, i: f"<article><div class=content><p>{p(120)}</p></div><div class=tail><p>{p(30)}</p></div></article>",
        lambda p, i: f"<article><h2>Summary</h2><p>{p(20)}</p><h2>Details</h2><div><h3>More</h3><p>{p(60)}</p></div></article>",
        lambda p, i: f"<main><div>{p(5)}<div><div><p>{p(90)}</p></div></div></div><table><tr><td>{p(9)}</td></tr></table></main>",
        lambda p, i: f"<div class=page><article><p>{p(50)}</p></article><aside>{p(30)}</aside></div>",
    ],
)
def test_nothing_of_an_article_is_lost(spark, body):
    got, by_structure = six_pages(spark, body)
    assert got == by_structure and all(got)


def test_constant_headings_of_content_without_telling_elements(spark):
    got, _ = six_pages(spark, lambda p, i: f"<div>Menu here</div><div><h1>T{i}</h1><h2>Summary</h2><p>{p(20)}</p><div><h2>Details</h2><p>{p(60)}</p></div><h2>Share</h2></div>")
    assert all(t.startswith(f"T{i} Summary ") and " Details " in t and not t.endswith("Share") and "Menu" not in t for i, t in enumerate(got))


def random_article(rng, depth, own):
    """Nested sections with text of the page's own and constant headings before it."""
    out = []
    for _ in range(rng.randint(1, 3)):
        kind = rng.choice(["p", "ul", "h3", "div", "section"]) if depth else "p"
        text = own(rng)
        if kind == "ul":
            out.append(f"<ul><li>{text}<li>{own(rng)}</ul>")
        elif kind == "h3":
            out.append(f"<h3>Part</h3><p>{text}</p>")
        elif kind == "p":
            out.append(f"<p>{text}</p>")
        else:
            out.append(f"<{kind} class=k{rng.randint(0, 2)}>{random_article(rng, depth - 1, own)}</{kind}>")
    return "".join(out)


@pytest.mark.parametrize("tag", ["article", "main"])
def test_random_articles_equal_the_reading_by_structure(spark, tag):
    words = random.Random(7)
    own = lambda rng: prose(words, rng.randint(5, 25))
    rows = []
    for host in range(25):
        for i in range(6):
            article = random_article(random.Random(host), 3, own)  # one shape a host, other texts a page
            rows.append((10 * host + i, f"http://h{host}.com/", f"<body><div class=top><p>Welcome</p></div><{tag}>{article}</{tag}><div>Imprint</div></body>"))
    got = {r["page_id"]: r["text"] for r in wrapper.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: wrapper.extract(h) for i, _, h in rows}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p data-a=it's>Main text it's here</p><p>second</p>", "Main text it's here second"),
        ('<p title="abc>first para</p>', "first para"),
        ("<p title='a > b' class = \"x>y\">one</p>", "one"),
        ("<p it's>one</p><div class='menu' it's>x</div>two", "one two"),
        ("<div class=menu data-x=\"a>x</div><p>one", "one"),
        ("<p>one</p><p class=", "one"),
        ("<p>one<a ' href=x>two</a></p>", "onetwo"),
        ("one <!-- two", "one"),
        ("a<p/>b<br/>c", "a b c"),
    ],
)
def test_attributes_and_quotes(page, text):
    assert wrapper.extract(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<p>" + "<a '" * 250_000, '<a x="' * 170_000, "<a x='\"" * 140_000, "<!" * 500_000, "<?" * 500_000, "<a<" * 300_000, "<!--" * 250_000, "<li><ul>" + "<b>" * 150_000 + "<li>" * 130_000,
        "<p>" + "<i>" * 100_000 + "<div>" * 100_000, "<a b=c d>" * 100_000, "<table>" + "<td>" * 200_000, "<a " + "x=y " * 250_000, "<script>" * 120_000, "<a =" * 250_000,
    ],
)
def test_a_hostile_page_takes_no_longer_than_others(page):
    began = time.process_time()
    wrapper.parse(page)
    assert time.process_time() - began < 4
