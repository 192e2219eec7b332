import time
from collections import Counter

from veilmark.llm import html
from veilmark.llm.html import Page


def text(source):
    return "\n\n".join(t for _, t in Page(source).slots())


def test_blocks():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>H</header><nav><ul><li>N</li></ul></nav>'
        '<div class="cookie-notice">C</div><!-- <p>x</p> --><main><h1>A&eacute;&amp;&#33;</h1><p><b>one \n two<br>three<p>four <span class="ad">buy</span> five</p>'
        '<div id="comments"><p>bad</p></div><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><form>f</form></main><aside>s</aside><footer>F</footer></body></html>'
    )
    assert text(page) == "Aé&!\n\none two three\n\nfour five\n\nx\n\ny\n\n1\n\n2"
    assert text("") == "" and text("just 1 < 2 & text") == "just 1 < 2 & text"
    assert text('<p title="a>b">q</p><SCRIPT>x</p>') == "q"
    assert text("<p>a<p unclosed 'quote>b") == "a\n\nb"
    assert text("<body><p>menu of the day</p><div class='menu'>x</div>") == "menu of the day"


def test_templates_go_and_slots_stay(spark):
    def page(i):
        return f"<body><div><p>Welcome to our site</p></div><div><p>Story {i} of the day</p><p>Shared passage</p></div><div><p>All rights</p><p>{i}</p></div></body>"

    rows = [(i, f"http://h.com/{i}", page(i)) for i in range(6)] + [(6, "http://h.com/6", "<article><p>Welcome to our site</p></article>")]
    rows += [(7, "http://other.com/", "<p>Alone</p>"), (8, None, None), (9, "http://h.com", ""), (9, "http://h.com", "<p>twice</p>"), (None, None, "<p>" + "w " * 50_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS path", "3 AS text")
    got = [tuple(r) for r in html.extract(table).collect()]
    assert len(got) == len(rows) and all(n == len(t) for *_, t, n in got)
    by_id = {i: t for i, _, t, _ in got if i not in (9, None)}
    assert by_id[3].split("\n\n")[-3:] != [] and "Story 3 of the day" in by_id[3] and "3" in by_id[3].split("\n\n")
    assert by_id[6] == "Welcome to our site" and by_id[7] == "Alone" and by_id[8] == ""
    assert sorted(t for i, _, t, _ in got if i == 9) == ["", "twice"]
    assert html.extract(table.limit(0)).count() == 0


def test_constant_text_of_an_element_is_template(spark):
    rows = [(i, "http://h.com/", f"<body><div class=top>Welcome</div><div class=text>Story {i}</div></body>") for i in range(5)]
    rows += [(9, "http://two.com/", "<body><div class=top>Welcome</div></body>")]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Story {i}" for i in range(5)}, 9: "Welcome"}


def test_an_article_that_is_apart_does_not_mark_the_main_text():
    story = "<div><p>one</p><p>two</p></div>"
    for apart in ("aside", "nav", "div class='related-posts'", "section role=complementary"):
        assert text(f"<body>{story}<{apart}><article><p>teaser</p></article></{apart.split()[0]}></body>") == "one\n\ntwo"
    assert text("<body><aside><article>teaser</article></aside><article>story</article><p>other</p></body>") == "story"


def test_copies_and_parts_of_a_host_are_no_template(spark):
    def page(i):
        return f"<body><div class=top>Welcome</div><div class=text>Story {i}</div></body>"

    quote = "<body><div class=top>Welcome</div><blockquote>Told once</blockquote></body>"
    rows = [(i, "http://one.com/", page(0)) for i in range(5)]  # copies of one page
    rows += [(10 + i, "http://h.com/", page(i)) for i in range(9)] + [(20 + i, "http://h.com/", quote) for i in range(4)]
    rows += [(30 + i, "http://h.com/", f"<body><div class=top>Welcome</div><div class=text>Part {i}</div><h2 class=part>Same head</h2></body>") for i in range(3)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(table).collect()}
    want = {i: "Welcome\n\nStory 0" for i in range(5)} | {10 + i: f"Story {i}" for i in range(9)}
    assert got == want | {20 + i: "Told once" for i in range(4)} | {30 + i: f"Part {i}\n\nSame head" for i in range(3)}


def test_sections_and_headings_of_an_article_stay(spark):
    kept = "<header><h1>Head</h1></header><section id='discussion'><p>a</p></section><section id='related-work'><h2 id=comments>b</h2></section>"
    kept += "<div class='form-of-government'>c</div><p class='market-share'>d <span class=form>e</span></p>"
    gone = "<div class='share-buttons'>x</div><div id=comments>x</div><div class='newsletter form'>x</div><p>f <span class=ad>x</span></p>"
    assert text(f"<article>{kept}{gone}</article>") == "Head\n\na\n\nb\n\nc\n\nd e\n\nf"
    assert text("<body><div id='discussion'>x</div><p>y</p></body>") == "y"
    pages = [f"<article><p>Story {i}</p><p>Shared passage</p><div class='social'>Follow us</div><div class='search'>Case {i}</div></article>" for i in range(4)]
    table = spark.createDataFrame([(i, "http://h.com/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(table).collect()}
    assert got == {i: f"Story {i}\n\nShared passage\n\nCase {i}" for i in range(4)}


def extracted(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html.extract(table).collect()}


MENU = "<div class=qz><ul><li>Start here</li><li>All stories</li></ul><p>Tell a friend</p></div>"
SHARED = "<p>A passage that all pages of this host hold in the same words</p>"


def story(i):
    return f"<h1>Title {i}</h1><p>Story {i} begins in a town by the sea</p>{SHARED}<p>and story {i} ends there again</p>"


def told(i):
    return "\n\n".join([f"Title {i}", f"Story {i} begins in a town by the sea", SHARED[3:-4], f"and story {i} ends there again"])


def test_template_inside_an_article_goes_under_any_name(spark):
    line = "<div class=k7>Send this page on</div>"
    rows = [(i, "http://h.com/", f"<body><article>{MENU}{story(i)}{line}</article></body>") for i in range(5)]
    rows += [(9, "http://one.com/", f"<body><article>{MENU}{story(9)}{line}</article></body>")]  # nothing to compare with
    want = {i: told(i) for i in range(5)}
    assert extracted(spark, rows) == want | {9: "Start here\n\nAll stories\n\nTell a friend\n\n" + told(9) + "\n\nSend this page on"}


def test_template_without_an_article_goes_with_all_below_it(spark):
    rows = [(i, "http://h.com/", f"<body>{MENU}<div class=t>{story(i)}</div></body>") for i in range(5)]
    assert extracted(spark, rows) == {i: told(i) for i in range(5)}


def test_copies_with_small_changes_stay_whole(spark):
    body = "<h1>One title for all</h1><blockquote>" + "many words " * 20 + "</blockquote>"
    rows = [(i, "http://h.com/", f"<body><article>{body}<p>Version {i}</p></article></body>") for i in range(4)]
    rows += [(10 + i, "http://two.com/", f"<body class=c{i}><article>{story(0)}</article></body>") for i in range(4)]  # equal texts
    whole = "One title for all\n\n" + ("many words " * 20).strip()
    assert extracted(spark, rows) == {i: f"{whole}\n\nVersion {i}" for i in range(4)} | {10 + i: told(0) for i in range(4)}


def test_templates_equal_brute_force(spark):
    """Vectors written out page by page."""
    sources = [f"<body>{MENU}<article>{story(i % 4)}<div class=a>Fixed</div><div class=b>{i % 2}</div></article><p>{i % 3}</p></body>" for i in range(12)]
    sources += ["<body><article><div class=a>Other</div></article></body>", *sources[:5]]
    two = [f"<div class=x>One</div><div class=y>{i}</div>" for i in range(3)]
    rows = [("h.com", s) for s in sources] + [("two.com", s) for s in two]
    table = spark.createDataFrame(rows, "host string, html string")
    got = {(r["host"], r["path"], r["text"]) for r in html.templates(html.occurrences(table)).collect()}
    want = set()
    for host, of in (("h.com", sources), ("two.com", two)):
        pages = list({p.digest(): p for p in map(Page, of)}.values())
        vectors = {}
        for k, page in enumerate(pages):
            for token, n in Counter(page.tokens()).items():
                vectors.setdefault(token, [0] * len(pages))[k] = n
        for (path, text), v in vectors.items():
            on = sum(n > 0 for n in v)
            if text and v == vectors[path, 0] and on >= html.SUPPORT and 2 * on > len(pages):
                want.add((host, path, text))
    assert got == want and len({h for h, *_ in want}) == 2 and len(want) > 3


def test_deep_pages_are_read_once():
    deep = "<div>a<p>b" * 3000 + "</div>" * 3000
    started = time.monotonic()
    page = Page(deep)
    everything = set(page.tokens())
    assert page.text(set()).count("b") == 3000 and page.text(everything) == "" and time.monotonic() - started < 20
