from tabulark.llm.style_tree import extract_main_text, parse

PAGE = (
    "<body><div><div>Subscribe now</div><div>Home | About</div></div>"
    "<div><div><h2>Title {0}</h2><p>Text number {0} of this &amp; that.</p></div></div>"
    "<div><div>All rights</div></div></body>"
)


def texts(pages):
    return {r.page_id: r.text for r in extract_main_text(pages).collect()}


def test_blocks_references_and_white_space():
    page = (
        "<title>no</title><nav><a href='/x'>menu</a></nav><!-- ad --><script>var t='</p>';</script>"
        "<article><h1>A &lt;b&gt;</h1><p><b>one\n two&nbsp; three<br>four<p>f<i>iv</i>e"
        "<ul><li>x<li>y</ul><span class='ad'>buy <span>now</span></span>end</article>"
        "<footer>&copy; me</footer><div id='comments'>I agree</div><form>mail</form>"
    )
    assert [t for _, t, _ in parse(page)[0]] == [
        "A <b>", "one two three four", "five", "x", "y", "end",
    ]


def test_entropy_cuts_what_all_pages_of_a_host_show(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(8)]
    rows += [(50, "http://single.example/", PAGE.format(50)), (51, None, None), (52, "x", "")]
    rows += [(60, "http://h.example/again", PAGE.format(3))]
    got = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got[3] == got[60] == "Title 3\nText number 3 of this & that."
    # one page of a host tells nothing about its layout
    assert got[50].startswith("Subscribe now\nHome | About\nTitle 50")
    assert got[51] == got[52] == ""


def test_copies_of_an_article_stay(spark):
    page = "<nav>m</nav><article><p>Same text.</p></article>"
    rows = [(i, "https://c.example/", page) for i in range(9)] + [(9, "https://c.example/", "plain")]
    got = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert set(got.values()) == {"Same text.", "plain"}


def test_empty_table_clashing_columns_and_long_page(spark):
    schema = "page_id long, url string, html string, text string, host string, cut string"
    rows = [(1, "http://a/", "<p>" + "word " * 300_000, "t", "h", "c")]
    pages = spark.createDataFrame(rows, schema)
    found = extract_main_text(pages).collect()[0]
    assert found.n_chars == len(found.text) == 5 * 300_000 - 1
    assert extract_main_text(pages.limit(0)).count() == 0
    assert extract_main_text(pages).columns == ["page_id", "url", "text", "n_chars"]


def test_code_points(spark):
    pages = spark.createDataFrame([(1, "u", "<p>𝔘é&#128512;</p>")], "page_id long, url string, html string")
    row = extract_main_text(pages).collect()[0]
    assert row.text == "𝔘é😀" and row.n_chars == 3


def test_boilerplate_inside_an_article_is_cut_and_names_are_only_a_prior(spark):
    page = (
        "<body><nav>Home</nav><article><h1>Title {0}</h1><p>Text number {0} of this.</p>"
        "<p>Read more on our site.</p><div class='author-box'><p>About the author</p></div></article>"
        "<aside>{1}</aside><footer>All rights</footer></body>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i, "<b>x</b>")) for i in range(8)]
    # on this host the aside differs from page to page in texts and layout
    kinds = ["<p>Note {0}</p>", "<h2>Note {0}</h2><p>more {0}</p>", "<ul><li>Note {0}</ul>", "<pre>Note {0}</pre>",
             "<h3>Note {0}</h3>", "<h4>Note {0}</h4><p>and {0}</p>"]
    rows += [(100 + i, f"http://a.example/{i}", page.format(i, k.format(i))) for i, k in enumerate(kinds)]
    # copies of an article with a notice each are no layout
    copy = "<article><h1>One title</h1><p>One text.</p></article><footer>{0}</footer>"
    rows += [(200 + i, f"http://c.example/{i}", copy.format(i)) for i in range(8)]
    got = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got[3] == "Title 3\nText number 3 of this."
    assert got[101] == "Title 1\nText number 1 of this.\nNote 1\nmore 1"
    assert all(got[200 + i] == "One title\nOne text." for i in range(8))


def test_a_variant_of_an_article_stays_whole(spark):
    page = "<article><p>Shared text of many words that all the pages have.</p><p>Own {0}.</p></article>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(8)]
    got = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got[2] == "Shared text of many words that all the pages have.\nOwn 2."


def test_named_inline_branches_leave_the_sentence_whole():
    page = "<p>One <span class='share'>tweet</span> two <span id='x'>three</span> four</p>"
    assert [t for _, t, _ in parse(page)[0]] == ["One two three four"]


def test_names_are_whole_class_words_and_never_take_the_article(spark):
    pages = [
        "<div class='content-sidebar-wrap'><article><header class='entry-header'><h1>T</h1></header>"
        "<p>Body text.</p></article></div>",
        "<body class='no-sidebar'><div class='sidebar left'><article><header class='header'><h1>T</h1></header>"
        "<p>Body text.</p></article><nav>menu</nav></div><footer>f</footer></body>",
        "<form id='respond'><div><h1>T</h1><p>Body text.</p></div></form><div class='ad big'>buy</div>",
        "<main><article><h1>T</h1><p>Body text.</p></article><div id='comments'><article>yes</article></div></main>",
        "<h1>T</h1><p>Body <span class='widget'>text</span>.</p><footer>f</footer>",
        "<h1>T</h1><p>Body <span class='no-widget'>text</span>.</p><footer>f</footer>",
    ]
    rows = [(i, f"http://h{i}.example/", page) for i, page in enumerate(pages)]
    got = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [got[i] for i in (0, 1, 2, 3, 5)] == ["T\nBody text."] * 5
    assert got[4] == "T\nBody ."
    assert texts(spark.createDataFrame([(1, "u", "<nav>menu</nav>")], "page_id long, url string, html string")) == {
        1: ""}


def test_named_parts_never_come_back(spark):
    long = "I think that this is a very good post and I agree with it. " * 5
    cases = {
        "<nav><a>Home</a> About</nav><footer>Legal</footer>": "",
        "<form><label>Your name</label><input></form>": "",
        f"<article><p>One line.</p></article><div class='comments'><p>{long}</p></div>": "One line.",
        f"<article><p>One line.</p><div class='comments'><p>{long}</p></div></article>": "One line.",
        f"<p>One line.</p><section class='comments'><article><p>{long}</p></article></section>": "One line.",
        f"<p>Short page.</p><div class='cookie notice'><p>{long}</p></div>": "Short page.",
        f"<form id='aspnet'><div>Menu</div><p>{long}</p></form>": f"Menu\n{long.strip()}",
        f"<div class='header'><main><p>{long}</p></main></div><footer>Legal</footer>": long.strip(),
        f"<div class='comments'><article><p>{long}</p></article></div>": "",
    }
    for k, (page, text) in enumerate(cases.items()):
        pages = spark.createDataFrame([(k, f"http://h{k}.example/", page)], "page_id long, url string, html string")
        assert texts(pages) == {k: text}, page
        # nor on a host with many pages
        if k < 4:
            many = spark.createDataFrame(
                [(i, "http://h.example/", page.replace("good", f"good {i} x")) for i in range(6)],
                "page_id long, url string, html string",
            )
            assert set(texts(many).values()) == {text}, page
