from cdcspark.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href=/x>Menu</a></li></ul></nav><header>Site name</header><div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p>First   <b>bold</b>&nbsp;text<br>goes on<p>Second &eacute;&#233; <!-- no --> paragraph that is long enough
<ul><li>one<li>two</ul><form><input> send</form></article>
<aside>Side</aside><section class="comments"><p>A reader says a lot of things here that are long, long, long and longer than all else on the page</p></section>
<footer>&copy; me</footer></body></html>"""
TEXT = "Head & line\nFirst bold text goes on\nSecond éé paragraph that is long enough\none\ntwo"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, paths string")


def test_main_text():
    assert html.extract(PAGE, []) == TEXT


def test_broken_markup():
    assert html.extract("<article><p>one <b>two</p><p>three</article", []) == "one two\nthree"
    assert html.extract("<p>a < b and c > d</p>", []) == "a < b and c > d"
    assert html.extract("<p>cut <a href='x", []) == "cut"
    assert html.extract("<p title=\"no end>one</p><p>two</p>", []) == "one\ntwo"
    assert html.extract("<script>never ends <p>x</p>", []) == ""
    assert html.extract("</p></div>plain", []) == "plain"
    assert html.extract("<p>&amp &lt;p&gt; &unknown; &#x41;</p>", []) == "& <p> &unknown; A"


def test_numbers_in_classes_are_generalised():
    a, b = (html.vote(f'<div class="post-{i} entry"><p>some text of the post</p></div>')[0] for i in (7, 123))
    assert a == b == "/div.entry.post-#"


def test_a_host_agrees_on_its_path(spark):
    common = '<div class="main"><p>{}</p></div><div class="extra"><p>{}</p></div>'
    rows = [(i, f"https://user@Host.example:80/{i}", common.format("the article " * 6, "other")) for i in range(9)]
    # On one page the text beside the article is the longer one; the host's path decides.
    rows.append((9, "http://host.example/9", common.format("short article", "a longer text that stands beside it " * 5)))
    rows.append((10, "http://other.example/", common.format("short article", "a longer text that stands beside it " * 5)))
    got = {r.page_id: r.text for r in html.main_text(pages(spark, rows)).collect()}
    assert got[9] == "short article" and got[10].startswith("a longer text") and got[0] == ("the article " * 6).strip()


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "no markup  at\nall"), (4, "u", "<nav>x</nav>"), (4, "u", "<nav>x</nav>"), (None, None, PAGE)]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html.main_text(pages(spark, rows)).collect())
    assert got == [(0, TEXT, len(TEXT)), (1, "", 0), (2, "", 0), (3, "no markup at all", 16), (4, "", 0), (4, "", 0)]
    assert html.main_text(pages(spark, [])).collect() == []


def test_a_long_page_is_read_whole():
    paragraphs = [f"paragraph {i} é" for i in range(20_000)]
    page = "<article>" + "".join(f"<p>{p}" for p in paragraphs)
    assert html.extract(page, ["/article"]) == "\n".join(paragraphs)
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert html.extract(deep, []) == "x"


def test_attribute_values_are_not_searched_for_names():
    for attributes in ['style="overflow:hidden"', 'title="A hidden valley"', "data-hidden=1", 'data-x="a hidden id=search"', "title='class=ad'"]:
        assert html.extract(f"<article {attributes}><div {attributes}><p {attributes}>kept text</p></div></article>", []) == "kept text", attributes
    page = '<article><p>see <a href="/view?id=search">the link</a> and <a href=/view?role=search>another</a> in long text</p></article>'
    assert html.extract(page, []) == "see the link and another in long text"
    assert html.vote('<div class="post" title="a class=other"><p>some text</p></div>')[0] == "/div.post"
    for attributes in ["hidden", "HIDDEN", 'hidden=""', "data-x=1 hidden", 'title="x"hidden', "aria-hidden=true", "class=ad", "CLASS = 'ad'"]:
        assert html.extract(f"<article><p>kept</p><div {attributes}>gone</div></article>", []) == "kept", attributes


def test_whole_names_mark_surroundings():
    for name in ["content with-sidebar", "has-sidebar", "no-sidebar", "elementor-widget-text-editor", "article-header", "entry-header",
                 "search-results", "container right-sidebar", "no-comments", "widget-content", "notice-board-text"]:
        for page in [f"<div class='{name}'><p>kept text</p></div>", f"<div id='{name.split()[-1]}x'><p>kept text</p></div>"]:
            assert html.extract(page, []) == "kept text", name
    for name in ["ad", "ad-slot-3", "ad_300x250", "sidebar", "left-sidebar", "site-header", "post-comments", "related-posts", "cookie-notice",
                 "comment-list", "header__nav", "main-nav", "Share-Buttons", "x comments"]:
        assert html.extract(f"<div><p>kept text</p><div class='{name}'><p>gone</p></div></div>", []) == "kept text", name


def test_headings_inside_an_article_stay():
    for head in ["<div class=header><h1>Head</h1></div>", "<header class=header><h1>Head</h1></header>", "<h1 class=header>Head</h1>",
                 "<div class=article-header><h1>Head</h1></div>", "<h2 class=widget>Head</h2>", "<div class=entry-header><h2>Head</h2></div>"]:
        assert html.extract(f"<article>{head}<p>text of the article</p></article>", []) == "Head\ntext of the article", head


def test_surroundings_that_hold_the_article_stay():
    article = "<article><h1>Head</h1><p>text of the article</p></article>"
    for around in ["<div class=sidebar>{}</div>", "<div id=widget><div class=modal>{}</div></div>", "<form>{}</form>", "<div hidden>{}</div>",
                   "<aside>{}</aside>", "<span class=ad>{}</span>"]:
        assert html.extract("<body><nav>menu</nav>" + around.format(article) + "</body>", []) == "Head\ntext of the article", around
        assert html.extract(around.format("<main><p>text</p></main>"), []) == "text", around
    assert html.extract("<div class=widget><h1>Head</h1><p>text</p></div>", []) == "Head\ntext"
    # What else is marked goes: teasers and comments are not the page's article, wherever that stands.
    other = "<div class=related><article><p>a teaser that is longer than the article, by far and for sure</p></article></div>"
    assert html.extract(article + other, []) == html.extract(other + article, []) == "Head\ntext of the article"
    other = "<div class=comments><article class=comment><p>a long comment on the text above it, by a reader</p></article></div>"
    assert html.extract("<div><p>the text</p></div>" + other, []) == "the text"
    assert html.extract("<article><p>one <span class=ad>two <b>x</b></span> three</p></article>", []) == "one three"


LEAD, BODY = "a short lead", "the body of the article, which is the longest part of it by far"


def test_articles_in_several_containers():
    want = f"Head\n{LEAD}\n{BODY}"
    for page in [
        f"<article><h1>Head</h1><section class=lead>{LEAD}</section><section class=body>{BODY}</section></article>",
        f"<article><h1>Head</h1><p>{LEAD}</p><div class=entry-content><p>{BODY}</p></div></article>",
        f"<main><h1>Head</h1><article><p>{LEAD}</p></article><article><p>{BODY}</p></article></main>",
        f"<article><h1>Head</h1><p>{LEAD}</p><blockquote>{BODY}</blockquote></article>",
        f"<article><h1>Head</h1><ul><li>{LEAD}<li>{BODY}</ul></article>",
        f"<article><h1>Head</h1><table><tr><td>{LEAD}<td>{BODY}</table></article>",
        f"<div class=post><h1>Head</h1><div class=lead>{LEAD}</div><div class=entry-content><p>{BODY}</p></div></div>",
        f"<div class=post><h2>Head</h2><p>{LEAD}</p><blockquote>{BODY}</blockquote></div>",
        f"<body><h1>Head</h1><div>{LEAD}</div><div>{BODY}</div></body>",
    ]:
        for around in ["{}", "<body><nav><a href=/x>menu</a></nav><div id=page>{}</div><div class=sidebar>side</div></body>"]:
            if "<body>" not in page or around == "{}":
                assert html.extract(around.format(page), []) == want, (page, around)
    # Below the page's layout nothing is joined: what has no heading and stands beside navigation is another column.
    page = f"<div id=page><nav>menu</nav><div class=post><p>{LEAD}</p><p>{BODY}</p></div><div class=column><p>other</p></div></div>"
    assert html.extract(page, []) == f"{LEAD}\n{BODY}"
    page = f"<div id=page><div class=post><p>{BODY}</p></div><div class=column><a href=/x>a link</a> <a href=/x>and links</a></div></div>"
    assert html.extract(page, []) == BODY


def test_pages_of_another_template_keep_their_article(spark):
    common = "<div class=main><p>the article {} says what it says</p></div>"
    rows = [(i, f"http://a.b/{i}", common.format(i)) for i in range(9)]
    rows.append((9, "http://a.b/9", f"<div class=main><p>a note</p></div><article><h1>Head</h1><p>{LEAD}</p><p>{BODY}</p></article>"))
    got = {r.page_id: r.text for r in html.main_text(pages(spark, rows)).collect()}
    assert got[9] == f"Head\n{LEAD}\n{BODY}" and got[0] == "the article 0 says what it says"
