"""Main text of hand-made pages."""

from __future__ import annotations

import pytest
from tierline.llm import html as H

ARTICLE = "<article><h1>Title</h1><p>One <b>two</b>\n three&amp;four.</p><p>Five</p></article>"


def text(page):
    return H.main_text(page, set(), set())


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>menu</nav>{ARTICLE}<footer>f</footer></body></html>",
         "Title\nOne two three&four.\nFive"),
        (f"<div class='ad'>buy</div><div id=sidebar>s</div>{ARTICLE}<section class='comments'><article>me too</article></section>",
         "Title\nOne two three&four.\nFive"),
        ("<article><header><h1>In</h1></header><aside>no</aside><form>no<input></form><p>yes</p><script>var a='</p><p>';</script></article>", "In\nyes"),
        ("<header>site</header><main><p>a<p>b<ul><li>c<li>d</ul></main>", "a\nb\nc\nd"),
        ("<p><b>bold<br><p>next</p>", "bold\nnext"),
        ("<p>a<!-- <p>no</p> -->b</p><!-- open <p>c", "ab"),
        ("<p>x <span class='share'>tweet</span> y</p>", "x y"),
        ("<p>cut off here <a href='x", "cut off here"),
        ("<p>cut <a href=\"x>inner</a> end</p>", "cut inner end"),
        ("<p hidden>no</p><div style='display: none'>no</div><p aria-hidden=true>no</p><p>yes</p>", "yes"),
        ("<p>1 < 2 &am &notit; &#233;&#x41; &nbsp; end</p>", "1 < 2 &am ¬it; éA end"),
        ("<textarea>no</textarea><table><tr><td>a<td>b</table>", "a\nb"),
        ("<article class='card loading'><p>kept: not an ad</p></article>", "kept: not an ad"),
    ],
)
def test_pages(page, expected):
    assert text(page) == expected


def test_very_long_and_deep_pages():
    assert text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("<" * 20_000) == "<" * 20_000
    assert text("<p>" + "<b>x</i>" * 20_000) == "x" * 20_000


def test_style_tree_removes_what_pages_of_a_host_share(spark):
    def page(i):
        return (
            "<body><div><p>Welcome to our site</p><div><p>Sign up today</p></div></div>"
            f"<div><h2>Story {i}</h2><p>Body number {i} of the story</p><p>Read more stories</p></div></body>"
        )

    rows = [(i, f"https://Host.example/{i}", page(i), "x") for i in range(12)]
    rows += [(100, "https://small.example/", page(0), "x"), (101, None, None, "x"), (102, "no host", "", "x"), rows[3], rows[3]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {}
    out = H.extract(pages)
    assert out.columns == ["page_id", "url", "text"]
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[2] == ["Story 2\nBody number 2 of the story"]
    assert len(got[3]) == 3 and len(set(got[3])) == 1
    assert got[100][0].startswith("Welcome")  # too few pages to tell
    assert got[101] == got[102] == [""]
    assert H.extract(pages.limit(0)).collect() == []


def test_repeated_articles_stay(spark):
    rows = [(i, "http://h.example/a", f"<body><div>boilerplate</div>{ARTICLE}</body>") for i in range(10)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Title\nOne two three&four.\nFive"}


def test_tree_judges_pages_with_articles(spark):
    def page(i):
        return (
            "<body><div class=top>Welcome to our site</div><article class=card>Our picks of the week</article>"
            f"<div class=story><p>Story {i} is told at some length in a plain element.</p></div></body>"
        )

    def inner(i):
        return f"<body><main><p>Report {i}, with figures and names of its own.</p><div><p>Read more reports</p></div></main></body>"

    rows = [(i, "http://a.example/", page(i)) for i in range(12)] + [(100 + i, "http://b.example/", inner(i)) for i in range(12)]
    rows += [(200, "http://c.example/", page(7))]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Our picks of the week\nStory 3 is told at some length in a plain element."
    assert got[103] == "Report 3, with figures and names of its own."
    assert got[200].endswith("Story 7 is told at some length in a plain element.")  # no statistics


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content no-sidebar'>{ARTICLE}</div>",
        f"<div class='layout with-sidebar'>{ARTICLE}<div class='sidebar'>s</div></div>",
        f"<div id='sidebar'>{ARTICLE}<p>s</p></div>",
        "<article><h1 class='share-price'>Title</h1><p id='reply-from-minister'>One two three&amp;four.</p><p class='sponsored-research'>Five</p></article>",
        "<div class='alert-history'>Title</div><p class='popular-science'>One two three&amp;four.</p><p class='social-policy'>Five</p>",
        f"<div class='cookie-banner'>c</div><div id='ad-1'>b</div><div class='left-sidebar'>s</div><div class='share-buttons'></div>{ARTICLE}",
    ],
)
def test_names_tell_as_a_whole(page):
    assert text(page) == "Title\nOne two three&four.\nFive"


STORY = "<h1>Title</h1><p>One <b>two</b>\n three&amp;four.</p><p>Five</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout with-header'>{ARTICLE}</div>",
        f"<div class='page has-fixed-header'>{ARTICLE}</div>",
        f"<div class='page has-fixed-header'><header>h</header>{STORY}</div>",
        f"<body><form action=x><input>{ARTICLE}</form></body>",
        f"<body><form action=x><div class=menu>m</div>{STORY}<footer>f</footer></form></body>",
        f"<div class='elementor-widget text'>{STORY}</div>",
        "<div class='elementor-widget'><h1>Title</h1></div><div class='elementor-widget'><p>One two three&amp;four.</p></div>"
        "<div class='elementor-widget'><p>Five</p></div>",
        f"<div class='main-content sidebar-right'>{STORY}</div><div class='sidebar'>s</div>",
        f"<div class='nav-open'><div class='sidebar'>s</div>{STORY}</div>",
        f"<div class='header'>h</div><div class='story'>{STORY}</div><form>Search <input></form>",
        f"<div class='story'>{STORY}</div><div class='comments'><p>{'I think so too. ' * 20}</p></div>",
    ],
)
def test_names_never_take_the_text_along(page):
    assert text(page) == "Title\nOne two three&four.\nFive"


@pytest.mark.parametrize("depth", [10, 510, 520, 5000])
def test_elements_are_told_apart_at_any_depth(depth):
    inside = f"<script>var x = 'code';</script><nav>menu here</nav><style>p</style><div class=ad>buy</div>{STORY}"
    assert text("<div>" * depth + inside + "</div>" * depth + "<footer>f</footer>") == "Title\nOne two three&four.\nFive"
    assert text("<b>" * depth + inside) == "Title\nOne two three&four.\nFive"


def test_unmatched_tags_in_deep_pages_are_quick():
    import time

    began = time.time()
    assert text("<div>" * 30_000 + "</x></p></section>" * 30_000 + "end").endswith("end")
    assert time.time() - began < 20


def plain_tree(pages, threshold=H.THRESHOLD, min_pages=H.MIN_PAGES):
    """The same judgements by one host's tree in plain Python: (nodes, texts,
    weak, known) from the pages' blocks and elements."""
    import math
    from collections import Counter, defaultdict

    shapes, held, parents = defaultdict(Counter), Counter(), {}
    for page in pages:
        blocks, elements = H.parse(page or "")
        own = defaultdict(set)
        for e in elements:
            own[e.path].add(" ".join(e.shape))
        for path, s in own.items():
            shapes[path][tuple(sorted(s))] += 1
        for path, text in {(b.chain, b.text) for b in blocks if b.chain}:
            held[path, text] += 1
            parents[path[-1]] = path
    m = {p: sum(c.values()) for p, c in shapes.items() if sum(c.values()) >= min_pages}
    content, below = {}, defaultdict(lambda: [0.0, 0])
    for (chain, text), n in held.items():
        if chain[-1] in m:
            content[chain, text] = 1 - math.log(min(n, m[chain[-1]])) / math.log(m[chain[-1]])
            for node in chain[:-1]:
                below[node][0] += n * content[chain, text]
                below[node][1] += n
    nodes = set()
    for p in m:
        if p in below:
            counts = shapes[p].values()
            entropy = -sum(n / m[p] * math.log(n / m[p]) for n in counts) / math.log(m[p])
            kept = H.G ** len(counts)
            if (1 - kept) * entropy + kept * below[p][0] / below[p][1] < threshold:
                nodes.add(p)
    pair = {k: k[0][-1] ^ H._digest(k[1]) for k in content}
    texts = {pair[k] for k, c in content.items() if c < threshold}
    weak = {pair[k] for k, c in content.items() if threshold <= c < H.BESIDE}
    return nodes, texts, weak, {k[0][-1] for k in content}


def test_against_a_plain_style_tree(spark):
    import random

    rng = random.Random(4)
    words = [f"word{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    common = [say(4) for _ in range(6)]

    def page():
        parts = [f"<div class='top'><p>{common[0]}</p><ul>{''.join(f'<li>{c}</li>' for c in common[1:3])}</ul></div>"]
        if rng.random() < 0.6:
            parts.append(f"<div class='promo-box'><p>{rng.choice(common)}</p></div>")
        body = "".join(f"<p>{say(12)}</p>" for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.5:
            body += f"<div><p>{common[5]}</p></div>"
        kind = rng.choice(["article", "div", "div class='story'"])
        parts.append(f"<{kind}><h1>{say(3)}</h1>{body}</{kind.split()[0]}>")
        parts.append(f"<section><h2>{common[3]}</h2><div><a>{rng.choice(common)}</a></div></section>")
        return "<html><body>" + "".join(parts) + "</body></html>"

    rows = [(i, f"http://h{i % 3}.example/{i}", page()) for i in range(120)]
    rows += [(500, "http://few.example/", page()), (501, "http://h0.example/", None), (502, "http://h0.example/", rows[0][2])]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    hosts = {}
    for _, url, page_html in rows:
        hosts.setdefault(url.split("/")[2], []).append(page_html)
    judged = {host: plain_tree(pages) for host, pages in hosts.items()}
    assert any(texts for _, texts, _, _ in judged.values()) and any(nodes for nodes, *_ in judged.values())
    for i, url, page_html in rows:
        assert got[i] == H.main_text(page_html, *judged[url.split("/")[2]]), i
    # What all pages begin with is gone there (its words may stand elsewhere too).
    for i, _, page_html in rows[:120]:
        assert got[i].split("\n").count(common[0]) < page_html.count(f">{common[0]}<")
