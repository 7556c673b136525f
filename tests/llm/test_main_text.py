import pytest

from fleetgauge.llm import main_text as M

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header><a href=/>Site</a></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><!-- <p>no</p> -->"
    "<div class='cookie-notice'>We use cookies here and there and everywhere</div>"
    "<article><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text.<br>Same block<p>To.</p>"
    "<div class=ad>Buy this fine thing today for very little money</div><p>Last &lt;one&gt;</p></article>"
    "<aside>Other news of the day, in many words, that go on</aside><form><p>Write to us</p></form>"
    "<div id='comments'><article><p>I liked what was said there very much</p></article></div><footer>Copyright</footer>"
)


def test_article_without_boilerplate():
    assert M.main_texts([PAGE]) == ["Title & more\nFirst bold text. Same block\nTo.\nLast <one>"]


def test_page_without_article_element():
    links = "<div><a href=/1>One two</a> <a href=/2>three</a></div>"
    text = "word " * 40
    assert M.main_texts([links + f"<h1>A title of a page</h1><p>{text}</p><p>{text}</p>" + links]) == [
        "\n".join(["A title of a page", text.strip(), text.strip()])
    ]


def test_tree_learns_its_table():
    x, y = M.labelled_blocks()
    assert (M.trained().predict(x) == y).mean() > 0.95


@pytest.mark.parametrize("page", ["", "<", "<<<p", "<p", "<p><a href='x", "<!--", "<script>", "</div></p>", "&#0;&bogus;&amp"])
def test_broken_markup(page):
    M.main_texts([page])


def test_rows(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, None), (2, "v", "", 1), (3, "w", "<p>" + "x " * 200_000, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = M.extract(df).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.n_chars for r in got}[3] == 399_999 and {r.text for r in got if r.page_id in (None, 2)} == {""}
    assert M.extract(df.limit(0)).collect() == []


def test_given_pages(spark, sf_dir):
    """The pages of the tables keep their article element and nothing else."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in M.extract(pages).collect()}
    for row in pages.collect():
        article = row.html[row.html.index("<article>") : row.html.index("</article>")]
        lines = got[row.page_id].split("\n")
        assert len(lines) >= 2 and all(line == " ".join(line.split()) for line in lines)
        assert article.count("<p>") + 1 >= len(lines)


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>t</title><body><p>{}</p>",
        "<p><svg/>{}</p>",
        "<video-player></video-player><p>{}</p>",
        "<div><button>Go <p>{}</p></div>",
        "<svg><path d='m'><svg></svg>x</svg><p>{}</p><button>a</button>",
        "<object-viewer>{}</object-viewer><video src='a'>x</video>",
        "<p>{}</p><script>if (a</b) '<p>no</p>'</script ><style>p",
    ],
)
def test_no_tag_hides_the_rest(page):
    texts = [b.text for b in M.blocks(page.format("the rest"))]
    assert "the rest" in texts and not {"x", "a", "t", "p"} & set(texts)


def test_formulas_are_text():
    page = "<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds <svg><text>no</text></svg>here</p>"
    assert [b.text for b in M.blocks(page)] == ["so E=m holds here"]


TEXT = "word " * 30


@pytest.mark.parametrize(
    "page",
    [
        "<article class='overflow-hidden rounded'><p>{}</p></article>",
        "<div class='overflow-hidden'><p>{}</p></div>",
        "<article><h2 id='legal'>{}</h2></article>",
        "<article><div class='article-header'><h1>{}</h1></div></article>",
        "<article><p class='notice'>{}</p></article>",
        "<article class='post no-sidebar'><div class='social-science entry-content'><p>{}</p></div></article>",
        "<main><div class='menu-free ad-hoc'><p>{}</p></div></main>",
        "<div class='header-image-layout'><article><p>{}</p></article></div>",
    ],
)
def test_names_are_matched_whole(page):
    assert M.main_texts([page.format(TEXT)]) == [TEXT.strip()]


@pytest.mark.parametrize(
    "name",
    ["ad", "ad-slot-300x250", "adBox2", "cookie-notice", "cookieBanner", "share-buttons", "related-posts", "site-footer", "page_header", "main-nav", "post-comments", "sidebar left", "x notice", "newsletter-signup"],
)
def test_boilerplate_names(name):
    page = f"<article><p>{TEXT}</p><div class='{name}'><p>{TEXT * 2}</p></div></article>"
    assert M.main_texts([page]) == [TEXT.strip()]


def test_neighbours_change_a_prediction():
    """The same short block is text among long blocks and none among links; nothing else differs."""
    short, long, link = M.Block("s", 9, 0, False, False, False), M.Block("l", 60, 0, False, False, False), M.Block("a", 4, 4, False, False, False)
    keep = lambda *page: M.trained().predict(M.describe(page)).tolist()
    assert keep(long, short, long) == [1, 1, 1] and keep(link, short, link) == [0, 0, 0]
    used = {feature for feature, *_ in M.trained().nodes if feature >= 0}
    assert used & {2, 3, 4, 5} and used & {0, 1}
    for feature, _, below, above, _ in M.trained().nodes:
        if feature >= 0:
            leaves = [M.trained().nodes[k] for k in (below, above)]
            assert not (leaves[0][0] < 0 and leaves[1][0] < 0 and leaves[0][4] == leaves[1][4])


def test_articles_without_telling_names():
    link = "<div><a href=/1>One more</a> <a href=/2>thing</a></div>"
    inside = [f"<div>{TEXT * 2}</div>", "<div>Said she, and left the room.</div>", f"<div>{TEXT}</div>"]
    page = link + "<div>The paper of the town</div>" + link + "".join(inside) + link + "<div>All rights reserved by us</div>" + link
    assert M.main_texts([page]) == ["\n".join([(TEXT * 2).strip(), "Said she, and left the room.", TEXT.strip()])]


def test_stray_end_tags_are_cheap():
    import time

    page = "<div>" * 50_000 + "</p></span></li>" * 50_000 + TEXT
    start = time.monotonic()
    assert M.main_texts([page]) == [TEXT.strip()]
    assert len(page) > 1_000_000 and time.monotonic() - start < 5


def test_links_of_an_article_are_text():
    page = f"<article><h1>A title</h1><p><a href=/x>See also the other one</a></p><p>{TEXT * 2}</p><p><a href=/y>And this one too</a></p></article>"
    assert M.main_texts([page])[0].split("\n")[1::2] == ["See also the other one", "And this one too"]
