import html
import re

import numpy as np

from gearwatch.llm import wrappers


def plain_article(page):
    """What the given pages hold in their article element."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1).replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, blocks string, text string")
    got = wrappers.main_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    return sorted(((r.page_id or 0, r.text) for r in got))


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in wrappers.main_text(pages).collect()} == want


def page(body, menu="Home News", note="Read us daily"):
    return (
        f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><div class='menu'>{menu}</div>"
        f"<div><p>{note}</p></div><div class=story>{body}</div><div id=comments><p>first!</p></div><footer>&copy;</footer></body></html>"
    )


def test_varying_slots_are_content_without_semantic_elements(spark):
    rows = [(i, "http://h.example/x", page(f"<h1>Title {i}</h1><p>Body &amp; <b>soul</b>\n of {i}<br>end"), "x", "y", "z") for i in range(5)]
    # A page of the same host with a container more.
    rows.append((5, "HTTP://H.example/y?z", page("<p>Other</p>").replace("<div class=story>", "<div class=ad>Buy</div><div class=story>"), "x", "y", "z"))
    want = [(i, f"Title {i}\n\nBody & soul of {i} end") for i in range(5)] + [(5, "Other")]
    assert texts(spark, rows) == want


def test_odd_pages(spark):
    rows = [
        (1, None, None, "x", "y", "z"),
        (2, "no address", "", "x", "y", "z"),
        (3, "http://a.example/", "just text &lt;3 &amp &am", "x", "y", "z"),
        (4, "http://b.example/", "<article><p>open <nav>menu</nav><p>closed</article><script>never closed", "x", "y", "z"),
        (4, "http://b.example/", "<article><p>open <nav>menu</nav><p>closed</article><script>never closed", "x", "y", "z"),
        (None, "http://c.example/", "<main><p>a < b <!-- no --> c<p hidden>d</main>", "x", "y", "z"),
        (6, "http://d.example/", "<div>" * 500 + "<p>deep</p>" + "</div>" * 500, "x", "y", "z"),
        (7, "http://e.example/", "<main>" + "<p>word word</p>" * 5000 + "</main>", "x", "y", "z"),
    ]
    got = dict(texts(spark, rows))
    assert got[1] == got[2] == "" and got[3] == "just text <3 & &am"
    assert got[4] == "open\n\nclosed\n\nnever closed" or got[4] == "open\n\nclosed"
    assert got[0].startswith("a < b c") and got[6] == "deep"
    assert got[7].count("\n\n") == 4999
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert wrappers.main_text(empty).count() == 0


def test_alignment_matches_in_order():
    template = "0 page\n1 nav\n1 div.a\n2 div\n1 div.b"
    slots = lambda o: [s for s, _ in wrappers.align(o, template)]
    assert slots(template) == [0, 1, 2, 3, 4]
    assert slots("0 page\n1 div.a\n1 div.new\n2 div\n1 div.b") == [0, 2, 0, 0, 4]
    assert slots("0 page") == [0]


def test_what_guards_a_container():
    template = "0 page\n1 div.menu~\n2 div\n2 article\n3 div"
    assert [g for _, g in wrappers.align(template, template)] == [-1, 1, 1, -1, -1]
    assert wrappers.align("0 page\n1 div.ad~", template) == [(0, -1), (0, -2)]


def test_many_siblings_and_deep_nesting_are_aligned():
    rng = np.random.default_rng(1)
    wide = lambda: "0 page\n" + "\n".join(f"1 div.{'abc'[i]}\n2 div.{'xy'[j]}" for i, j in zip(rng.integers(0, 3, 3000), rng.integers(0, 2, 3000)))
    slots = wrappers.align(wide(), wide())
    assert len(slots) == 6001 and len({s for s, _ in slots}) > 3000
    deep = "\n".join(f"{i} div" for i in range(20_000))
    assert [s for s, _ in wrappers.align(deep, deep + "\n1 div")] == list(range(20_000))


def plain_size(left, right):
    """Simple tree matching by its recursive definition; trees are (label, children)."""
    if left[0] != right[0]:
        return 0
    table = [[0] * (len(right[1]) + 1) for _ in range(len(left[1]) + 1)]
    for i, x in enumerate(left[1], 1):
        for j, y in enumerate(right[1], 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_size(x, y))
    return 1 + table[-1][-1]


def test_most_containers_are_matched():
    rng = np.random.default_rng(4)

    def grown(depth):
        return ("abc"[rng.integers(3)], [grown(depth + 1) for _ in range(rng.integers(0, 4 if depth < 4 else 1))])

    def outline(node, depth=0):
        return [f"{depth} {node[0]}"] + [line for kid in node[1] for line in outline(kid, depth + 1)]

    for _ in range(200):
        x, y = ("page", grown(1)[1]), ("page", grown(1)[1])
        own, other = "\n".join(outline(x)), "\n".join(outline(y))
        slots = wrappers.Matching(own, other).slots()
        assert sum(s >= 0 for s in slots) == plain_size(x, y)
        labels, _, parents = wrappers.tree(own)
        wanted, _, above = wrappers.tree(other)
        taken = [s for s in slots if s >= 0]
        assert taken == sorted(set(taken))
        assert all(s < 0 or (labels[i] == wanted[s] and (i == 0 or above[s] == slots[parents[i]])) for i, s in enumerate(slots))


def test_content_is_what_varies():
    template = "0 page\n1 div\n2 div.x\n2 div.y\n1 div.ads~"
    chosen = lambda prose, constant=(): [s for s, _ in wrappers.content_slots(template, prose, prose, set(constant))]
    assert chosen({2: 50, 3: 50, 4: 5}) == [0, 1, 2, 3]
    assert chosen({2: 50, 3: 50, 4: 5}, [3]) == [0, 1, 2]
    assert chosen({2: 5, 4: 50}) == [0, 1, 2, 3, 4]  # named like adverts, but it is the text
    assert [s for s, _ in wrappers.content_slots(template, {2: 9, 3: 1}, {2: 10, 3: 50}, set())] == [0, 1, 2]  # links go


def test_an_article_keeps_its_title_and_lead(spark):
    """Sections hold most of an article, and pages have several of them."""
    def article(i, sections):
        inner = "".join(f"<section><p>{'section words ' * 30}{i} {k}</p></section>" for k in range(sections))
        return f"<html><body><div class='x'><p>Same line everywhere</p></div><article><h1>Title {i}</h1><p>Lead {i}</p>{inner}</article></body></html>"

    rows = [(i, "http://a.example/", article(i, 1 + (i == 5)), "", "", "") for i in range(6)]
    for (i, text), n in zip(texts(spark, rows), [1] * 5 + [2]):
        blocks = text.split("\n\n")
        assert blocks[:2] == [f"Title {i}", f"Lead {i}"] and len(blocks) == 2 + n


def test_names_alone_decide_nothing_about_the_text(spark):
    bodies = [
        "<article class='post comments-open'><p>{}</p></article>",
        "<main class='has-sidebar'><p>{}</p></main>",
        "<div class='content no-ads'><p>{}</p></div>",
        "<div id='page' class='header-menu-fixed'><div class='menu'><p>Home</p></div><article><p>{}</p></article></div>",
        "<article><ul class='menu'><li>Home {0}</ul><p class='advert'>Buy {0}<p>{0}</p></article>",
    ]
    rows = [(10 * k + i, f"http://h{k}.example/", b.format(f"some words of text {i}"), "", "", "") for k, b in enumerate(bodies) for i in range(4)]
    assert texts(spark, rows) == [(r[0], f"some words of text {r[0] % 10}") for r in rows]


def test_copies_of_a_page_are_no_template(spark):
    same = "<div><p>An article</p></div><div class='ad'><p>{}</p></div>"
    rows = [(i, "http://a.example/", same.format(i), "", "", "") for i in range(3)]
    assert texts(spark, rows) == [(i, "An article") for i in range(3)]
