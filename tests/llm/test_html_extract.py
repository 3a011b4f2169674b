import random

import pytest

from rollcall.llm.html_extract import best_region, extract, main_text, nodes, weights

P = "Some words of an article that go on for a while and then stop."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>only a title</title></head><body></body></html>", ""),
        (f"<article><h1>Head &amp; shoulders</h1><p><b>{P}<br><p>a&nbsp;&#233;  \n b</p></article>", f"Head & shoulders\n{P}\na é b"),
        (f"<nav><a href='/'>Home</a></nav><article><p>{P}</p><p>Fin.</p></article><footer>&copy; me</footer>", f"{P}\nFin."),
        (f"<body><header>Site</header><main><article><header><h1>One</h1></header><p>{P}</p></article></main><aside>x y z</aside></body>", f"One\n{P}"),
        (f"<article><p>{P}</p><div class='ad'>Buy this now please.</div><p>{P}</p></article>", f"{P}\n{P}"),
        (f"<article><p>{P}</p><script>var t = '</p>' + \"<p>no</p>\";</script><style>p{{}}</style><p>x</p></article>", f"{P}\nx"),
        (f"<article><p>{P}</p></article><section id=comments><p>I like this a lot, really, thank you for it all.</p></section>", P),
        (f"<div><a href=1>a</a> <a href=2>b</a></div><div><p>{P}</p><p>{P}</p></div><div><a href=3>c</a></div>", f"{P}\n{P}"),
        (f"<div class='cookie-consent'>{P}</div><div><p>{P} two</p><p>{P}</p></div>", f"{P} two\n{P}"),
        (f"<article><p>a < b and 3 <4 {P}</article>", f"a < b and 3 <4 {P}"),
        (f"<article><!-- <p>no</p> --><p title='a > b'>{P}</p></article>", P),
        (f"<article><ul><li>{P}<li>two</ul><table><tr><td>{P}<td>y</table></article>", f"{P}\ntwo\n{P}\ny"),
        (f"<div>Site name</div><div id=x>Tuesday edition</div><div><h1>One</h1><p>{P}</p><div>{P} z</div></div><div>Next story</div>", f"One\n{P}\n{P} z"),
        (f"<article><p>{P}</p><article class='comment'><p>{P} Me too.</p></article></article>", P),
        (f"<div id=content><h2>Two</h2>{P}<br>{P}</div><div class=comments><p>{P}</p></div><div role=alert>{P}</div>", f"Two\n{P} {P}"),
        (f"<article><div>One</div><p>{P}</p><ul><li>a</li></ul><div>Fin.</div></article><div>Next</div>", f"One\n{P}\na\nFin."),
        (f"<article><p>wo<i>rd</i>s {P}</p>", f"words {P}"),
    ],
)
def test_pages(page, want):
    assert main_text(page) == want


def test_weights_and_region():
    w = weights()
    assert all(v < 0 if f.startswith("tag") else v > 0 for f, v in w.items()) and w["word article"] > 100 * w["word aside"]
    r = random.Random(1)
    for _ in range(200):
        scores = [r.choice([-3.0, -1.0, 0.5, 2.0]) for _ in range(r.randint(0, 12))]
        a, b = best_region(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0.0, *sums])


TEXT = "The paper tells that rain fell on the mill for three days and nobody could cross the river at all. " * 4
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"


@pytest.mark.parametrize("name", "related promotion legal-news social-history share-price ad-free-story comment-piece post-notice-board has-sidebar no-comments".split())
def test_no_word_of_a_class_decides_alone(name):
    page = f"<html><body>{NAV}<div class='{name}'><h1>Head</h1><p>{TEXT}</p></div><footer>&copy; paper</footer></body></html>"
    assert main_text(page) == f"Head\n{TEXT.strip()}"


def test_forms_around_and_articles_that_are_none():
    body = f"{NAV}<div><h1>Head</h1><p>{TEXT}</p></div><footer>&copy; paper</footer>"
    want = f"Head\n{TEXT.strip()}"
    for page in (f"<body><form action='/'>{body}</form></body>", f"<body><form><div class='legal'>{body}</div></form></body>", f"<script>var t='<article>'</script><body>{body}</body>", f"<!-- <main> --><body>{body}</body>", f"<body><article class='teaser'>x</article>{body}</body>"):
        assert main_text(page) == want
    comments = "<section id='comments'><h3>9 comments</h3>" + f"<div class='comment'><p>{TEXT}</p></div>" * 9 + "</section>"
    assert main_text(f"<body>{NAV}<article><p>Short.</p><p>{TEXT}</p></article>{comments}</body>") == f"Short.\n{TEXT.strip()}"


def brute(page):
    """The text of the best of all regions, tried one by one; the first of equals, the longest from its start."""
    w, own = weights(), nodes(page)
    score = [n.n * w.get(n.feature, -0.05) for n in own]
    best, span = 1e-12, (0, 0)
    for i in range(len(own)):
        total = 0.0
        for j in range(i, len(own)):
            total += score[j]
            if total > best + 1e-9:
                best, span = total, (i, j + 1)
    lines = {}
    for n in own[slice(*span)]:
        if not n.aside:
            lines[n.block] = lines.get(n.block, "") + n.text
    return "\n".join(t for t in (" ".join(x.split()) for x in lines.values()) if t)


def test_equals_brute_force_over_all_regions():
    r = random.Random(7)
    parts = [f"<p>{P}</p>", "<p>Fin.</p>", "<a href='/'>Home</a>", "<div>Site</div>", f"<div class='ad'>{P}</div>", "<li>x", "<h2>Head</h2>", "loose words here", f"<aside><p>{P}</p></aside>", "<br>", f"<div id='menu'><a>{P}</a></div>", "<script>x</script>", f"<footer>{P}</footer>", "</div>", "<div>", "<article>", "</article>"]
    seen = set()
    for _ in range(300):
        page = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        assert main_text(page) == brute(page), page
        seen.add(bool(brute(page)))
    assert seen == {True, False}


def test_very_long_page_through_spark(spark):
    page = f"<body>{NAV}<article>" + f"<p class='a'>{P} <b>x</b></p>" * 20_000 + "</article></body>"
    out = extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first()
    assert out.text == "\n".join([f"{P} x"] * 20_000) and out.n_chars == len(out.text)


def test_hostile_markup_is_linear():
    for page in ("<form>" * 50_000 + "x y z", "<div class=ad>" * 50_000 + TEXT, "<" * 50_000, "<a \"" * 30_000, "<div>" * 100_000, "<b>" * 50_000 + "<center>" * 50_000, "<i>" * 50_000 + "</b>" * 50_000, "<a \">" * 30_001, "<!--" * 30_000, "<script>" * 20_000, "</p>" * 50_000, "&" * 50_000, "x" * 300_000):
        assert isinstance(main_text(page), str)


def test_table(spark):
    rows = [(1, "http://a/", f"<article><p>{P}</p></article>", "x"), (1, None, None, "y"), (None, "u", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract(pages)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "http://a/", P, len(P)), (1, None, "", 0), (None, "u", "", 0)], key=str)
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("start", ['<p title="A hidden valley">', '<p data-x="/page?id=share">', '<p data-role="banner">', "<p data-x='class=menu'>", '<p data-class="ad" x-hidden>', "<p data-x=/a?role=alert>"])
def test_only_whole_attribute_names_count(start):
    assert main_text(f"<article><p>{P}</p>{start}{P} z</p></article>") == f"{P}\n{P} z"
    for hidden in ("<p hidden>", "<p title='a b'hidden>", "<p TITLE=a CLASS='ad'>", "<p role = banner>"):
        assert main_text(f"<article><p>{P}</p>{hidden}{P} z</p></article>") == P


def test_math_and_unclosed_elements_keep_the_text():
    assert main_text(f"<article><p>{P} <math><mi>x</mi></math></p></article>") == f"{P} x"
    for tag in ("svg", "select", "noscript"):
        assert P in main_text(f"<article><p>Before it all.</p><{tag}><p>{P}</p></article>")
    assert isinstance(main_text("<svg>" * 20_000), str)


def test_scripts_without_spaces_have_words():
    """Han, kana and Thai prose in plain elements after a menu."""
    for first, last in ((0x4E00, 0x9000), (0x3041, 0x3096), (0x0E01, 0x0E2E)):
        r = random.Random(first)
        blocks = ["".join(chr(r.randint(first, last)) for _ in range(r.randint(30, 80))) for _ in range(8)]
        menu = "".join(f'<a href="/{i}">{blocks[0][i : i + 2]}</a> ' for i in range(2))
        for tag in ("div", "p"):
            page = f"<html><body><div>{menu}</div>" + "".join(f"<{tag}>{b}</{tag}>" for b in blocks) + "</body></html>"
            assert main_text(page) == "\n".join(blocks)
