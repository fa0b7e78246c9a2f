from lastmile.llm.html import blocks, main_text, parse

PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a>'
    '</li></ul></nav><!-- ad --><div class="ad">buy</div><article><h1>Title&amp;</h1><p><b>One<br><p>Two  &lt;b&gt;\n three</p></article>'
    "<footer>&copy; x</footer></body></html>"
)


def text(html):
    return " ".join(t for t, _ in blocks(html)[0])


def test_article_without_furniture():
    assert text(PAGE) == "Title& One Two <b> three"
    assert text(PAGE.replace("</body></html>", "")) == text(PAGE)
    extra = '<aside>side</aside><form><label>Name</label><input></form><div id="comments"><p>me too</p></div><section class="cookie-notice">ok</section>'
    assert text(PAGE.replace("</article>", extra + "</article>")) == text(PAGE)
    comments = '<section><article class="comment"><p>first!</p></article></section>'
    assert text(PAGE.replace("<footer>", comments + "<footer>")) == text(PAGE)


def test_inline_markup_joins_and_blocks_part():
    assert text("<article><p>a<i>b</i>c <span>d</span></p>e<ul><li>f<li>g</ul><table><tr><td>h<td>i</table></article>") == "abc d e f g h i"


def test_pages_without_article():
    assert text("<body><header>top</header><main><p>in</p></main><p>out</p></body>") == "in"
    assert text("<body><div id='menu'>m</div><p>one</p><div><p>two</p></div></body>") == "one two"
    assert text("plain &amp; simple") == "plain & simple"


def test_broken_and_empty_pages():
    assert [text(x) for x in ("", " \n", "<article></article>", "<article><p", "<!-- open <p>x</p>")] == [""] * 5
    assert text("<article><p>a < b & c &nope; &#233;</p></article></div></p>") == "a < b & c &nope; é"
    assert text('<article><p title="a>b" class=x>t</p><a href="x>y</a></article>').startswith("t")
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert text(f"<article>{deep}</article>") == "x" and len(parse(deep)) == 6001


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string").repartition(3)


def test_recurring_subtrees_of_a_host_go(spark):
    prose = "<p>" + "a passage that many pages share " * 6 + "</p>"
    box = '<div class="xyz"><p>Follow us</p></div>'
    rows = [(i, f"http://h.example/{i}", f"<body><div>Top menu</div><article><p>text {i}</p>{prose}{box}</article></body>") for i in range(12)]
    rows += [(100 + i, f"http://k{i}.example/", f"<body><article><p>text</p>{box}</article></body>") for i in range(12)]
    rows += [(200 + i, "http://c.example/", f"<body><article><p>copy</p>{box}</article></body>") for i in range(12)]
    rows += [(300 + i, "https://N.example:80/x", f"<body><div>Site {'x'}</div><p>own {i}</p></body>") for i in range(12)]
    found = {r.page_id: r.text for r in main_text(pages(spark, *rows)).collect()}
    shared = " ".join(("a passage that many pages share " * 6).split())
    assert all(found[i] == f"text {i} {shared}" for i in range(12))  # the box goes, shared prose stays
    assert all(found[100 + i] == "text Follow us" for i in range(12))  # on twelve hosts once each
    assert all(found[200 + i] == "copy Follow us" for i in range(12))  # copies of one page count once
    assert all(found[300 + i] == f"own {i}" for i in range(12))  # no article: the template is all that goes


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, None, "k", 1), (1, None, None, "k", 1), (None, "not a url", "<article>é x</article>", "l", 2)],
        "page_id long, url string, html string, page_key string, n_chars int",
    )
    found = sorted((str(r.page_id), r.page_key, r.text, r.n_chars) for r in main_text(docs).collect())
    assert found == [("1", "k", "", 0), ("1", "k", "", 0), ("None", "l", "é x", 3)]
    assert main_text(pages(spark)).count() == 0


LONG = "words of the page's own story that go on and on "


def test_furniture_words_on_what_holds_the_prose_do_not_count():
    prose = f"<p>{LONG * 4}</p><p>{LONG * 5}end</p>"
    wanted = text(f"<article>{prose}</article>")
    ad = '<div class="ad">buy</div><div class="related"><p>more</p></div>'
    for page in (
        '<body><div id="page" class="has-sidebar">{}</div></body>', '<body><div id="page" class="sidebar">{}</div></body>', '<main class="no-ads">{}</main>',
        '<article class="post with-comments">{}</article>', '<article><section class="related">{}</section></article>', '<article><div class="notice">{}</div></article>',
        '<div class="menu"><article>{}</article></div>',
    ):
        assert text(page.format(prose + ad)) == wanted, page
        assert text(page.format("<p>short one</p><b>x y z</b>" + ad)) == "short one x y z", page
    comments = f'<div id="comments"><p>{"I say so too " * 30}</p></div>' * 3
    assert text(f"<article>{prose}</article>{comments}") == text(f"<article>{prose}{comments}</article>") == wanted
    advert = f'<div class="ad"><p>{"buy this " * 30}</p></div>'
    assert text(f"{advert}<article><p>brief</p></article>{comments}") == "brief"


def by_id(spark, rows):
    return {r.page_id: r.text for r in main_text(pages(spark, *rows)).collect()}


def test_article_that_is_only_a_card(spark):
    card = "<article class='card'><h2>Read this next</h2><p>It is good</p></article>"
    rows = [(i, "http://h.example/x", f"<body>{card}<div><p>{LONG * 3}number {i}</p></div></body>") for i in range(12)]
    rows += [(100 + i, "http://m.example/x", f"<body>{card}<main><p>{LONG * 3}number {i}</p></main></body>") for i in range(12)]
    rows += [(200, "http://one.example/x", rows[0][2])]
    rows += [(300 + i, "http://a.example/x", f"<body><div>{'Site words ' * 40}</div><article><p>brief {i}</p></article><div>by {i}</div></body>") for i in range(12)]
    rows += [(400, "http://b.example/x", f"<body><article><p>four words of news</p></article><div><a>{'more links ' * 40}</a></div></body>")]
    found = by_id(spark, rows)
    assert all(found[i] == found[100 + i] == f"{LONG * 3}number {i}" for i in range(12))  # the recurring card goes with the templates
    assert found[200] == f"Read this next It is good {LONG * 3}number 0"
    assert all(found[300 + i] == f"brief {i}" for i in range(12))  # the article holds half of what is left without the template
    assert found[400] == "four words of news"


def test_shared_passages_in_any_element_stay(spark):
    passage = LONG * 3 + "end"
    forms = ["<div>{}</div>", "<section>{}</section>", "<div><p><b>{}</b></p></div>", "<div><p><span>{}</span></p></div>", "<div>words <i>{}</i></div>", "<div><p><b>a</b><br><i>{}</i></p></div>"]
    rows = [(100 * k + i, f"http://h{k}.example/", f"<body><article><p>own {i}</p>{form.format(passage)}<div>Follow us</div></article></body>") for k, form in enumerate(forms) for i in range(12)]
    found = by_id(spark, rows)
    for i, _, html in rows:
        assert found[i] == text(html).removesuffix(" Follow us") and passage in found[i] and "Follow" not in found[i]


LONG = " ".join(f"word{k}" for k in range(40))


def test_prose_stays_in_forms_hidden_wrappers_and_named_parts_of_an_article():
    body = f'<nav><a href="/">menu</a></nav><article><h1>Title</h1><p>{LONG}</p><p>end</p></article>'
    want = f"Title {LONG} end"
    assert text(f"<body>{body}</body>") == want
    # the whole page in a form, or shown by a script
    for wrapper in ('<form id="aspnetForm" method="post">', '<form role="form">', '<div style="display: none">', "<div hidden>", '<div aria-hidden="true">'):
        name = "form" if "form" in wrapper else "div"
        assert text(f"<body>{wrapper}{body}</{name}></body>") == want, wrapper
        box = '<div style="display:none"><p>subscribe now</p></div><form><p>your name</p></form>'
        assert text(f"<body>{wrapper}{body}{box}</{name}></body>") == want
    # but not a hidden box or a form beside the text, however long
    for box in (f"<div hidden><p>{LONG}</p></div>", f"<form><p>{LONG}</p></form>"):
        assert text(f"<body>{body}{box}</body>") == want
    # headings, paragraphs and sections with prose
    inner = f'<h2 id="related-work">Related work</h2><p class="notice">{LONG}</p><h2 id="search">Search</h2><section id="related-work"><p>{LONG}</p></section>'
    assert text(f"<body><article><p>{LONG} {LONG} {LONG}</p>{inner}</article></body>") == f"{LONG} {LONG} {LONG} Related work {LONG} Search {LONG}"
    # lists of links, short boxes, comments and adverts are furniture still
    links = '<section class="related"><ul>' + f'<li><a href="/x">{LONG}</a>' * 3 + "</ul></section>"
    extra = f'{links}<div class="share">share this</div><p class="advert">{LONG}</p><section class="comments"><p>{LONG}</p></section>'
    assert text(f"<body><article><p>{LONG} {LONG} {LONG} {LONG} {LONG}</p>{extra}</article></body>") == " ".join([LONG] * 5)
