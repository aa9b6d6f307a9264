"""URL judging and main text extraction."""

import random

import pytest

from slyglot.llm import html_wrapper, url_markov
from slyglot.llm.queries import URL_RULES

PAGE = "page_id long, url string, html string, host string, score double"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 0.0) for i, (u, h) in enumerate(rows)], PAGE)


def test_hosts_paths_and_longest_rule(spark):
    urls = [
        "http://A.Example.NET/en/1?x=/de/", "https://example.net/fr/2", "http://b.net", "http://example.com/de/#a", "https://w.org/fr/x", "http://myexample.net/en/1",
        "http://notorg/fr/", "no scheme", None, "", "http://x.org:80/fr/", "://net/", "http://w.org?q=/fr/",
    ]
    rows = {r.page_id: r for r in url_markov.judge(pages(spark, [(u, "") for u in urls]), URL_RULES).collect()}
    assert [(rows[i].host, rows[i].path) for i in range(len(urls))] == [
        ("a.example.net", "/en/1"), ("example.net", "/fr/2"), ("b.net", ""), ("example.com", "/de/"), ("w.org", "/fr/x"), ("myexample.net", "/en/1"),
        ("notorg", "/fr/"), ("", ""), ("", ""), ("", ""), ("x.org:80", "/fr/"), ("net", "/"), ("w.org", ""),
    ]
    assert [rows[i].rule for i in range(len(urls))] == [
        "example.net/en/", "net/", None, "example.com/de/", "org/fr/", "net/", None, None, None, None, None, "net/", None,
    ]
    assert all(rows[i].verdict == v for i, v in ((0, "allow"), (1, "block"), (3, "block"), (4, "allow"), (5, "block")))
    assert all(r.verdict in ("allow", "block") for r in rows.values())


def test_models_separate_unruled_urls(spark):
    good = [f"http://site{i}.org/fr/garden-{i}" for i in range(60)] + [f"http://shop.org/en/garden-{i}" for i in range(10)]
    bad = [f"http://x{i}.net/casino-{i}" for i in range(60)] + [f"http://y.biz/en/casino-{i}" for i in range(10)]
    rows = url_markov.judge(pages(spark, [(u, None) for u in good + bad]), URL_RULES).collect()
    unruled = {r.page_id: r.verdict for r in rows if r.rule is None}
    assert len(unruled) == 20 and all(v == ("allow" if i < 70 else "block") for i, v in unruled.items())
    assert url_markov.judge(pages(spark, []), URL_RULES).count() == 0


def test_repeated_and_null_pages_are_judged_each(spark):
    table = pages(spark, [("http://a.org/en/1", "")] * 2).union(spark.createDataFrame([(None, None, None, None, None), (0, "http://a.org/en/1", None, None, None)], PAGE))
    rows = url_markov.judge(table, URL_RULES).collect()
    assert len(rows) == 4 and len({(r.verdict, r.score) for r in rows if r.path == "/en/1"}) == 1


FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><a href=/>Site</a></header><div id="cookie-notice">We use cookies</div><nav><ul><li>A<li>B</ul></nav><!-- <p>no</p> -->
<main><article class="post"><h1>Title &amp; more</h1><p>One <b>two</b>
 three<p>Four &lt;five&gt;&nbsp;six<ul><li>a</li><li>b</ul><div class="ad">Buy</div><table><tr><td>x<td>y</tr></table><form>Find</form></article>
<section class="comments"><p>Nice!</p></section></main><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_blocks_of_one_page():
    assert html_wrapper.extract(FULL, set(), set()) == "Title & more\nOne two three\nFour <five> six\na\nb\nx\ny"
    for text, expected in (("", ""), ("plain < text", "plain < text"), ("<p>a<p>b</p></i>c", "a\nb\nc"), ("<p>a<br>b", "a b"), ("<script>x", ""), ("<div hidden>x</div>y", "y")):
        assert html_wrapper.extract(text, set(), set()) == expected
    own = "<header><h1>Site</h1></header><article><header><h1>Title</h1><p>By me</p><div class=share><h2>Share</h2></div></header><p>Text</p></article>"
    assert html_wrapper.extract(own, set(), set()) == "Title\nText"
    named = '<div class="site-header">Site</div><div class="entry-header"><h1 class="page-header">Title</h1></div><p>Text</p>'
    assert html_wrapper.extract(named, set(), set()) == "Title\nText"
    assert html_wrapper.extract("<div>" * 3000 + "x", set(), set()) == "x"


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar">{}</div>', '<div class="site no-sidebar">{}</div>', '<div class="long-form">{}</div>', '<div class="post post-search">{}</div>',
    '<article class="post has-comments">{}</article>', '<section id="comments-on-caesar">{}</section>', '<div id="legal-article">{}</div>',
    '<div data-id="reply-3">{}</div>', '<div data-role="header">{}</div>', '<div data-hidden="false">{}</div>', '<div aria-label="Hidden gems">{}</div>',
    '<div title="a hidden valley">{}</div>', '<div class="comments">{}</div>', '<div id="reviews">{}</div>', '<div class="wrap"><article><p>Teaser.</p></article>{}</div>',
    '<div class="cookie-notice">We use cookies</div><div class="article-body">{}</div><div class="article-comments">Nice one!</div>',
    "<nav>" + "<div>" * 500 + "Deep menu" + "</div>" * 500 + "</nav><div>{}</div>",
])
def test_names_and_other_attributes_do_not_lose_the_article(page):
    told = "<p>It was a long way over the hills.</p><p>Then <math><mi>x</mi></math> was found, and all was well.</p>"
    text = html_wrapper.extract("<body>" + page.format(told) + "<footer>by me</footer></body>", set(), set())
    assert text.removeprefix("Teaser.\n") == "It was a long way over the hills.\nThen x was found, and all was well."


def test_names_mark_what_stands_beside_the_article():
    story = "<p>" + "A story that is long enough to be the most of all text. " * 5 + "</p>"
    for name in ("sidebar", "site-header", "comment-list", "related-links", "ad", "entry-comments", "page-footer", "newsletter box"):
        assert html_wrapper.extract(f'<body>{story}<div class="{name}">Something beside it</div></body>', set(), set()) == story[3:-5], name


def test_a_very_long_page_is_read_whole():
    lines = [f"Line {i} of a very long page" for i in range(20_000)]
    assert html_wrapper.extract("<body>" + "".join(f"<p>{t}" for t in lines) + "</body>", set(), set()) == "\n".join(lines)


def test_simple_tree_matching_keeps_order():
    tree = lambda *names: html_wrapper.Node("body", children=[html_wrapper.Node(n) for n in names])
    size, pairs = html_wrapper.align(tree("p", "div", "p", "ul"), tree("div", "ul", "p"))
    assert size == 3 and len(pairs) == 3
    assert html_wrapper.align(tree("p"), html_wrapper.Node("div"))[0] == 0


def plain_matching(a, b):
    """The size of the largest matching of two trees that keeps order and parents, by trying all."""
    if a.name != b.name:
        return 0

    def lists(xs, ys):
        if not xs or not ys:
            return 0
        return max(lists(xs[1:], ys), lists(xs, ys[1:]), plain_matching(xs[0], ys[0]) + lists(xs[1:], ys[1:]) if xs[0].name == ys[0].name else 0)

    return 1 + (a.text != "" and a.text == b.text) + lists(a.children, b.children)


def random_tree(rng, depth=0):
    node = html_wrapper.Node(rng.choice("pd") if depth else "page", rng.choice(["", "x", "y"]) if depth > 1 else "")
    if depth < 3 and not node.text:
        node.children = [random_tree(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return node


def test_alignment_equals_the_largest_matching():
    rng = random.Random(2)
    for _ in range(300):
        a, b = random_tree(rng), random_tree(rng)
        size, pairs = html_wrapper.align(a, b)
        assert size == plain_matching(a, b) and len(pairs) <= size


def plain_pairs(a, b):
    """Size and pairs of a matching by the whole table of every two lists; of equal ones it has the later pairs."""
    if a.name != b.name:
        return 0, []
    m, n = len(a.children), len(b.children)
    best, found = [[0] * (n + 1) for _ in range(m + 1)], {}
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            found[i, j] = plain_pairs(x, y)
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + found[i, j][0])
    pairs, i, j = [(a, b)], m, n
    while i and j:
        if found[i, j][0] and best[i][j] == best[i - 1][j - 1] + found[i, j][0]:
            pairs += found[i, j][1]
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + (a.text != "" and a.text == b.text) + best[m][n], pairs


@pytest.mark.parametrize("few,kept", [(1000, 10**6), (0, 10**6), (0, 0), (5, 20)])
def test_alignment_of_lists_of_any_length_is_by_the_whole_table(monkeypatch, few, kept):
    """The same size and the same equal texts, whichever way the lists are matched."""
    monkeypatch.setattr(html_wrapper, "PAIRS", few)
    monkeypatch.setattr(html_wrapper, "KEPT", kept)
    rng, same = random.Random(4), lambda pairs: {x.text for x, y in pairs if x.text and x.text == y.text}

    def tree(depth=0):
        text = rng.choice(["", "x", "y", "z", f"u{rng.randint(0, 20)}"]) if depth > 1 else ""
        node = html_wrapper.Node(rng.choice("pd") if depth else "page", text)
        if depth < 3 and not text:
            node.children = [tree(depth + 1) for _ in range(rng.randint(0, 7))]
        return node

    for _ in range(200):
        a, b = tree(), tree()
        (size, pairs), (wanted, plain) = html_wrapper.align(a, b), plain_pairs(a, b)
        assert size == wanted and same(pairs) == same(plain)


@pytest.mark.parametrize("n", [20, 300, 3000])
def test_a_line_that_moved_does_not_unsettle_a_long_list(n):
    leaf = lambda key: [(1, 7, 0), (2, 0, key)]
    lines = [row for key in range(1, n + 1) for row in leaf(key)]
    found = html_wrapper.constants([[(0, 5, 0), *leaf(n + 1), *lines], [(0, 5, 0), *lines, *leaf(n + 1)]])
    assert found == set(range(1, n + 1))


def test_very_long_lists_are_aligned_in_whole():
    line = lambda text: html_wrapper.Node("p", children=[html_wrapper.Node("#", text)])
    page = lambda i: html_wrapper.Node("page", children=[line(f"{i} {j}" if j % 2 else f"line {j}") for j in range(20_000)])
    size, pairs = html_wrapper.align(page(1), page(2))
    assert size == 1 + 2 * 20_000 + 10_000 and len(pairs) == 40_001


def test_aligned_pages_show_their_constant_nodes():
    def tree(page):
        parsed = html_wrapper.parse(page)
        kept = html_wrapper._content(parsed)
        return html_wrapper.tree_of(parsed, kept), {html_wrapper._key(b): b.text for b in kept}

    body = lambda i, extra: f"<body><nav>Menu</nav><div><p>Read our terms</p>{extra}<p>Story {i}</p></div><div><b>Printed in Rome</b></div></body>"
    pages = [tree(body(i, "<p>More</p>" * (i % 3))) for i in range(4)]
    texts = {k: t for _, known in pages for k, t in known.items()}
    assert {texts[k] for k in html_wrapper.constants([t for t, _ in pages])} >= {"Read our terms", "Printed in Rome"}
    assert not {texts[k] for k in html_wrapper.constants([t for t, _ in pages])} & {f"Story {i}" for i in range(4)}
    long = lambda i: tree("<body>" + "".join(f"<p>Line {j if j % 2 else (i, j)}</p>" for j in range(500)) + "</body>")
    (a, known), (b, _) = long(1), long(2)
    assert {known[k] for k in html_wrapper.constants([a, b])} == {f"Line {j}" for j in range(1, 500, 2)}
    assert tree("<div>" * 300 + "x")[0] == [] and html_wrapper.constants([[], []]) == set()


def test_constant_nodes_become_template_and_copies_do_not(spark):
    body = lambda i: f"<body><div><p>Read our terms</p><p>Story number {i} is long</p><p>Printed in Rome</p></div></body>"
    rows = [(f"http://a.org/{i}", body(i)) for i in range(8)] + [(f"http://b.org/{i}", body(1)) for i in range(8)] + [("http://c.org/", body(1)), (None, None), ("x", "")]
    found = {r.page_id: r for r in html_wrapper.main_text(pages(spark, rows)).collect()}
    assert [found[i].text for i in range(8)] == [f"Story number {i} is long" for i in range(8)]
    whole = "Read our terms\nStory number 1 is long\nPrinted in Rome"
    assert {found[i].text for i in range(8, 17)} == {whole} and found[8].n_chars == len(whole)
    assert found[17].text == found[18].text == "" and found[18].n_chars == 0
    assert html_wrapper.main_text(pages(spark, [])).count() == 0


def test_prose_and_article_lists_at_a_path_of_links_stay(spark):
    links = "".join(f"<li><a href=/{j}>Link number {j}</a></li>" for j in range(5))
    bare = lambda i: f"<body><div><p>Story {i} is told here</p><ul>{links}{'<li>Plain prose in a list</li>' if i == 19 else ''}</ul></div></body>"
    own = lambda i: f"<body><article><p>Story {i} is told here</p><ul><li><a href=/{i}>Source of story {i}</a></li></ul></article></body>"
    rows = [(f"http://a.org/{i}", bare(i)) for i in range(20)] + [(f"http://b.org/{i}", own(i)) for i in range(20)]
    found = {r.page_id: r.text for r in html_wrapper.main_text(pages(spark, rows)).collect()}
    assert found[0] == "Story 0 is told here" and found[19] == "Story 19 is told here\nPlain prose in a list"
    assert all(found[20 + i] == f"Story {i} is told here\nSource of story {i}" for i in range(20))


def test_odd_pages_and_a_second_layout_leave_the_template(spark):
    body = lambda i: f"<body><div><p>Read our terms</p><p>Story number {i} is quite long</p><p>Printed in Rome</p></div></body>"
    other = lambda i: f"<body><section><p>All rights kept</p><p>Note number {i} is quite long</p></section></body>"
    rows = [(f"http://a.org/{i}", body(i)) for i in range(6)] + [("http://a.org/e", None), ("http://a.org/x", "<h1>Error 500</h1>")]
    rows += [(f"http://b.org/{i}", other(i) if i % 4 == 0 else body(i)) for i in range(40)]
    found = [r.text for r in sorted(html_wrapper.main_text(pages(spark, rows)).collect(), key=lambda r: r.page_id)]
    assert found[:8] == [*(f"Story number {i} is quite long" for i in range(6)), "", "Error 500"]
    assert found[8:] == [f"{'Note' if i % 4 == 0 else 'Story'} number {i} is quite long" for i in range(40)]


def test_near_copies_of_an_article_keep_it(spark):
    told = [f"Paragraph {j} of the one article tells at length what came to pass" for j in range(10)]
    copy = lambda i: "".join(f"<p>{t}{f', edition {i}' if j == i % 3 else ''}</p>" for j, t in enumerate(told))
    page = lambda inner: f"<body><article><p>Read our terms</p>{inner}</article></body>"
    rows = [(f"http://a.org/{i}", page(copy(i))) for i in range(6)]
    rows += [(f"http://b.org/{i}", page(copy(i))) for i in range(20)] + [(f"http://b.org/s{i}", page(f"<p>Story {i} was told by {i + 7} people</p>")) for i in range(10)]
    found = [r.text.split("\n") for r in sorted(html_wrapper.main_text(pages(spark, rows)).collect(), key=lambda r: r.page_id)]
    assert all(len(lines) == 11 for lines in found[:6])
    assert all(len(lines) == 10 and lines[9] == told[9] for lines in found[6:26])
    assert found[26:] == [[f"Story {i} was told by {i + 7} people"] for i in range(10)]


def test_deep_pages_are_aligned_as_flat_ones(spark):
    """The wrapper of a host is the same whatever depth its pages nest to."""
    flat = [(f"http://x.org/{i}", f"<p>Our terms apply to you</p><p>{'Story %d about it. ' % i * 5}</p>") for i in range(6)]
    texts = [
        sorted((r.page_id, r.text) for r in html_wrapper.main_text(pages(spark, [(u, "<div>" * depth + h) for u, h in flat])).collect())
        for depth in (0, 150, 300, 3000)
    ]
    assert "Our terms" not in texts[0][0][1] and all(t == texts[0] for t in texts)
    deep = [html_wrapper._grown([(i, 7, 0) for i in range(5000)] + [(5000, 0, 9)]) for _ in range(2)]
    size, pairs = html_wrapper.align(*deep)
    assert size == 5001 + 2 - 1 + 1 and len(pairs) == 5002
