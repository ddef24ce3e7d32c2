"""Main text on hosts of few pages, and in branches whose names say little."""

from revtrace.llm import html_extract

BOX = "This box of several sentences stands on all pages of its host. It is longer than an article. " * 3


def pages(spark, hosts):
    rows = [(f"{host}{k}", f"https://{host}.example/{k}", h) for host, all_ in hosts.items() for k, h in enumerate(all_)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    return {r.page_id: r.text for r in html_extract.extract(df).collect()}


def test_style_tree_decides_on_small_hosts_and_beside_short_articles(spark):
    body = "<body><div class='alpha'><p>{}</p></div><div class='beta'>{}</div></body>"
    own = lambda k, n: [f"Paragraph {k} {j} with words of its own" for j in range(n)]
    tags = lambda ps: "".join(f"<p>{p}</p>" for p in ps)
    hosts = {f"h{m}x": [body.format("Same box on every page of this host", tags(own(k, 4))) for k in range(m)] for m in (1, 2, 3, 9)}
    hosts |= {f"s{m}x": [body.format(BOX, tags(own(k, 1))) for k in range(m)] for m in (2, 3, 12)}
    got = pages(spark, hosts)
    assert got["h1x0"].startswith("Same box")  # nothing tells on a single page
    for name, all_ in hosts.items():
        for k in range(len(all_)):
            if name != "h1x":
                assert got[f"{name}{k}"] == "\n".join(own(k, 4 if name[0] == "h" else 1)), name


def test_style_tree_keeps_copies_of_one_page_and_single_words(spark):
    article = "<body><div class='beta'><p>One article</p><p>shown under</p><p>several addresses</p></div>{}</body>"
    text = "One article\nshown under\nseveral addresses"
    titled = "<body><div><h2>Overview</h2><p>Article {} has the words {}</p></div></body>"
    hosts = {
        "same": [article.format("")] * 4,
        "near": [article.format(f"<i class='seen'>{k}</i>") for k in range(2)],
        "word": [titled.format(k, k) for k in range(2)],
    }
    got = pages(spark, hosts)
    for k in range(4):
        assert got[f"same{k}"] == text
    for k in range(2):
        assert got[f"near{k}"] == f"{text}\n{k}"
        assert got[f"word{k}"] == f"Overview\nArticle {k} has the words {k}"


ARTICLE = "<p>The article has one sentence.</p><p>And a second one, after it.</p>"
TEXT = "The article has one sentence.\nAnd a second one, after it."


def test_noisy_wrappers_of_the_whole_page_keep_their_article():
    for inner in (ARTICLE, f"<main>{ARTICLE}</main>", f"<article>{ARTICLE}</article>", f"<main><div class='content-sidebar-wrap'>{ARTICLE}</div></main>"):
        for wrapper in (
            "<form id='aspnetForm' action='x'>{}</form>", "<div class='content-sidebar-wrap'>{}</div>", "<div class='layout has-sidebar'>{}</div>",
            "<div id='search-result-page'>{}</div>", "<form><div class='no-comments page'><div class='social header'>{}</div></div></form>",
        ):
            side = "<nav>Home</nav><footer>Imprint</footer>"
            assert html_extract.main_text(f"<body>{wrapper.format(inner)}{side}</body>") == TEXT, (wrapper, inner)
            beside = f"{inner}<div class='sidebar'><p>Teaser</p></div>"
            assert html_extract.main_text(f"<body>{wrapper.format(beside)}{side}</body>") == TEXT, (wrapper, inner)
    # a main element counts, however short, and halves are not both dropped
    long = "<div>" + "<p>link to another page</p>" * 20 + "</div>"
    assert html_extract.main_text(f"<div class='layout has-sidebar'><main>{ARTICLE}</main></div>{long}") == TEXT
    assert html_extract.main_text("<div class='header'>One half</div><form>The rest</form>") == "One half\nThe rest"


def test_noisy_branches_beside_the_article_still_go():
    comments = "<section class='comments'>" + "<article><p>I do not think so at all.</p></article>" * 5 + "</section>"
    teasers = "<div class='related'><article>Another article</article></div><div class='sidebar'><article>And one more</article></div>"
    for page in (
        f"<article>{ARTICLE}{comments}</article>{teasers}",
        f"<main>{ARTICLE}</main>{comments}{teasers}",
        f"<div>{ARTICLE}</div>{comments}{teasers}",
        f"<div>{ARTICLE}</div><aside><article>Aside</article></aside><form><p>Your name</p></form><header>Site</header>",
        f"<form id='aspnetForm'><article>{ARTICLE}</article><div class='search'>Search here</div></form>",
    ):
        assert html_extract.main_text(page) == TEXT, page


def test_self_closed_drawings_and_formulas():
    for page, text in (
        ("<p>a</p><svg class=icon/><p>b</p><svg><text>no</text></svg><p>c</p>", "a\nb\nc"),
        ("<p>a <svg viewBox='0 0 1 1' />b</p><svg\n/><p>c</p>", "a b\nc"),
        ("<svg><title>no</title><path d='M0'/></svg><p>a</p>", "a"),
        ("<svg data-x='/'>no</svg><p>a</p>", "a"),
        ("<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><math/><p>b</p>", "As x=2 holds\nb"),
        ("<p>As <math display='block'><semantics><mrow><mi>x</mi><mspace/></mrow><annotation encoding='tex'>x</annotation></semantics></math></p><p>b</p>", "As x\nb"),
    ):
        assert html_extract.main_text(page) == text, page
