import time

import pytest

from ledgerline.llm.html_extract import DEEPEST, Slot, extract_main_text, fold_page, main_text, merge, parse


def text_of(page):
    return main_text(parse(page), None)


def test_blocks_entities_and_white_space():
    assert text_of("<body><article><h1>A &amp B&nbsp;&#233;</h1><p>one\n <b>two</b>three<br>four<p>five</article>") == \
        "A & B é\none twothree four\nfive"
    assert text_of("<div><ul><li>a<li>b</ul>tail</div>") == "a\nb\ntail"
    assert text_of("<table><tr><td>x<td>y<tr><td>z</table>") == "x\ny\nz"
    assert text_of("a < b <c>d</c> <!-- no --> <![CDATA[raw & <x>]]> <p title='>'>e") == "a < b\nd\nraw & <x>\ne"
    assert text_of("") == "" and text_of("plain") == "plain"
    assert text_of("<p>" * 3000 + "deep") == "deep"


def test_what_is_no_content():
    page = """<html><head><title>t</title></head><body><header>h</header><nav>n</nav><div class="ad x">ad</div>
      <div id=cookie-notice>c</div><aside>s</aside><main><article><header><h1>Title</h1></header><p>Text</p>
      <script>var x="<p>no</p>";</script><style>p{}</style><form><p>f</p></form><span class="advert">a</span>
      <section class="comments"><p>comment</p></section></article></main><footer>f</footer><noscript>n</noscript></body>"""
    assert text_of(page) == "Title\nText"


def site(i, body, extra=""):
    return (f"<html><body><div class=top><p>Welcome to our site</p></div><div class=box>{extra}<div class=story><p>Start {i}</p>"
            f"<p>{body}</p><p>Read our terms here</p></div></div><div class=end><p>All done</p></div></body></html>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://a.example/{i}", site(i, f"Body number {i} " * (i % 7 + 5), "<div class=x>New</div>" if i % 5 == 0 else ""), "h")
            for i in range(40)]
    rows += [(100, None, None, None), (101, "no url", "", "h"), (102, "https://User@B.example:80/x", "<p>One page", "h"),
             (None, "http://a.example/n", site(99, "Body of null id " * 9), "h"), (3, rows[3][1], rows[3][2], "h"),
             (103, "http://a.example/l", site(7, "very long &lt; " * 20000), "h"), (104, "http://a.example/o", "<p>Other</p>", "h")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_template_text_goes_and_varying_text_stays(pages):
    for small in (32_000_000, 0):
        rows = extract_main_text(pages, broadcast_bytes=small).collect()
        assert len(rows) == pages.count()
        got = {r.page_id: r.text for r in rows}
        for i in range(40):
            assert got[i] == f"Start {i}\n" + " ".join(f"Body number {i}" for _ in range(i % 7 + 5))
        assert got[100] == "" and got[101] == "" and got[102] == "One page" and got[104] == "Other"
        assert got[None] == "Start 99\n" + " ".join(["Body of null id"] * 9)
        assert got[103] == "Start 7\n" + " ".join(["very long <"] * 20000)
        assert all(r.n_chars == len(r.text) for r in rows)


def test_empty(pages):
    assert extract_main_text(pages.limit(0)).count() == 0


def test_merged_templates_count_like_one(spark):
    def fold(ids):
        top = Slot("#root", "#root")
        for i in ids:
            fold_page(top, [parse(site(i, f"b {i}", "<div class=x>New</div>" if i % 3 else ""))], object())
        return top

    def shape(s):
        return s.label, s.pages, s.chars, [shape(k) for k in s.kids]
    assert shape(merge(fold(range(10)), fold(range(10, 25)))) == shape(fold(range(25)))


@pytest.mark.parametrize("others", [1, 100])
def test_copies_of_a_page_count_once(spark, others):
    copy = site(1000, "A story told on twenty equal pages</p><ul><li>Only here</ul><p>Its end")
    rows = [(i, f"http://a.example/{i}", copy) for i in range(20)]
    rows += [(100 + i, f"http://a.example/o{i}", site(i, f"Other body {i}")) for i in range(others)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i in range(20):
        assert {"Only here", "Start 1000", "A story told on twenty equal pages"} <= set(got[i].split("\n"))
    assert all({f"Start {i}", f"Other body {i}"} <= set(got[100 + i].split("\n")) for i in range(others))
    if others >= 10:
        assert all("Read our terms here" not in t and "Welcome to our site" not in t for t in got.values())


def texts_of(spark, pages):
    """Sets of blocks that op3 finds in the pages of one host, in order."""
    rows = [(i, f"http://a.example/{i}", p) for i, p in enumerate(pages)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    return [r.text.split("\n") for r in got]


def test_varying_text_beside_the_core_stays(spark):
    body = "A long body of words that goes on and on "
    plain = [f"<body><div class=top><p>Our site</p></div><div class=head><p>Title {i}</p></div><div class=story><p>{body * 9}{i}</p></div>"
             f"<div class=more><p>Appended section {i}</p></div><div class=end><p>All done</p></div></body>" for i in range(30)]
    heads = [f"<body><div class=top><p>Our site</p></div><main><h1>Head {i}</h1><article><p>{body * 9}{i}</p></article></main></body>"
             for i in range(30)]
    rare = [f"<body><div class=top><p>Our site</p></div><div class=story></div><div class=late><p>Elsewhere {i}</p></div></body>"
            for i in range(3)]
    for i, got in enumerate(texts_of(spark, plain + rare)[:30]):
        assert got == [f"Title {i}", (body * 9).strip() + f" {i}", f"Appended section {i}"]
    for i, got in enumerate(texts_of(spark, plain + rare)[30:]):
        assert got == [f"Elsewhere {i}"]
    for i, got in enumerate(texts_of(spark, heads)):
        assert got == [f"Head {i}", (body * 9).strip() + f" {i}"]


def test_names_of_wrappers_and_headings(spark):
    body = "A long body of words that goes on and on "

    def page(i, wrapper, inner="div"):
        return (f"<body><div class=top><p>Our site</p></div><div {wrapper}><{inner} class=story><h2 id=social-media-and-search>Part {i}</h2>"
                f"<p>{body * 9}{i}</p></{inner}></div><div class=menu><p>Menu {i}</p></div><div class='box ad'><p>Buy {i}</p></div></body>")
    for wrapper in ("class='layout has-sidebar'", "id=page class=header-fixed", "class=search", "role=form"):
        for inner in ("div", "article"):
            for i, got in enumerate(texts_of(spark, [page(i, wrapper, inner) for i in range(20)])):
                assert got == [f"Part {i}", (body * 9).strip() + f" {i}"]
    assert text_of(page(1, "class=search", "article")) == f"Part 1\n{body * 9}1"
    assert text_of("<section class=comments><article class=comment>no</article></section><p>yes</p><p class=share>no</p>") == "yes"


def test_no_cap_hides_a_template_text(spark):
    def long(i):
        many = "".join(f"<p>Paragraph {i} {k}</p>" for k in range(100))
        notice = "<p>Read our terms here</p>" if i > 1 else ""
        return f"<body><div class=story id=post-{'abcdefghij'[i % 10]}>{many}{notice}</div></body>"
    for i, got in enumerate(texts_of(spark, [long(i) for i in range(60)])):
        assert got == [f"Paragraph {i} {k}" for k in range(100)]

    def varied(i):
        rare = "".join(f"<div class=r{'abcdefghijklmnopqrst'[i % 20]}{'abcdefghijklmnopqrst'[k]}><p>Rare {i % 20} {k}</p></div>" for k in range(20))
        return f"<body>{rare}<div class=story><p>Story {i}</p></div></body>"
    rows = [(i, f"http://a.example/{i}", varied(i)) for i in range(240)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7, "page_id")
    for limit in (1000, 30):
        for r in extract_main_text(pages, limit=limit).collect():
            assert r.text == f"Story {r.page_id}"


def nested(n):
    return "<html><body><main>" + "".join(f"<div>a{i}" for i in range(n)) + "".join(f"</div>b{i}" for i in range(n)) + "</main>"


def test_deep_pages_keep_all_text_in_order(spark):
    for n in (5, DEEPEST - 4, DEEPEST, DEEPEST + 1, 3 * DEEPEST):
        assert text_of(nested(n)).split("\n") == [f"a{i}" for i in range(n)] + [f"b{i}" for i in range(n)]
    inner = "<div>" * DEEPEST + "<p>a<hr>b</p><nav><ul><li>menu</li></ul>menu</nav>c<div class='comments'><p>no</p>no</div><p>d</p>"
    assert text_of(inner) == "a\nb\nc\nd"
    rows = [(i, "http://deep.example/", "<div>" * (100_000 + i) + f"text {i}") for i in range(12)]
    rows += [(20, "http://deep.example/", "<center>" * 100_000 + "other" + "</center>" * 100_000 + "end")]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(12)} | {20: "other\nend"}


@pytest.mark.parametrize("page", [
    '<div a="' * 125_000, '<div a="' * 125_000 + ">x", '<a ">"' * 150_000, "<a " * 300_000 + ">x", "<a" * 400_000, "<!" * 400_000,
    "<![CDATA[" * 100_000 + ">", "<p><table>" + "<center>" * 50_000 + "</p>" * 100_000, "<article>" * 80_000,
    "<span hidden>" * 60_000 + "</span>" * 9, "</script" * 100_000, "<!--" * 200_000])
def test_unclosed_markup_takes_no_quadratic_time(page):
    begin = time.process_time()
    text_of(page)
    assert time.process_time() - begin < 20  # a second or two; by the square it would be many minutes


def test_markup_that_is_not_closed():
    assert text_of('<div a="x>one') == "one" and text_of('<p b=">">two') == "two"
    assert text_of("three<div") == "three<div" and text_of("four<!-- x<p>five") == "four"
    assert text_of("six<![CDATA[x>seven") == "six" + "seven"
    assert text_of("<p>&#" + "9" * 6000 + "; &#" + "0" * 30 + "65;") == "� A"


def test_style_names_on_text_inside_an_article_drop_nothing():
    assert text_of('<article><h2 class="header">Title</h2><p class="notice">An important paragraph.</p></article>') == \
        "Title\nAn important paragraph."
    assert text_of('<p>He said <b class="notice">never again</b> and left.') == "He said never again and left."
    assert text_of('<main><p class="comment">x</p><p class="banner">y</p><div class="notice">z</div><p class="ad">w</p></main>') == "y"
    assert text_of('<div><p class="notice">z</p><p>y <span class="sponsored">x</span><span hidden>w</span></p></div>') == "y"
