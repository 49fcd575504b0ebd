import random

import pytest

from tablelab.llm import html_text

HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>'; if (a<b) x();</script></head><body>"
NAV = "<nav><ul><li><a href='/a'>A</a></li><li><a href='/b'>B</a></li></ul></nav>"
LONG = "Here is a sentence of the article that is long enough to count as content. " * 3
ARTICLE = f"<article><h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><p>{LONG}<br>after&nbsp;it &lt;tag&gt;</p></article>"
WANT = "\n\n".join(["Title & more", LONG.strip(), "Short.", LONG + "after it <tag>"])


@pytest.mark.parametrize("before, after", [
    (NAV, "<footer>&copy; 2020</footer></body></html>"),
    ("<header><h1>Site</h1><p>Motto of the site</p></header>" + NAV, "<aside><p>Sidebar text</p></aside>"),
    ("<div class='cookie-banner'><p>We use cookies, and say so at length in this notice.</p></div>", "<div id='comments'><article class='comment'><p>" + LONG + "</p></article></div>"),
    ("<div class='ad'>Buy this</div><form><label>Name</label><input name=x></form>", "<section class='relatedPosts share'><p>Other</p></section>"),
    ("<ul class='topMenu'><li>One<li>Two</ul><div role='navigation'>x</div>", "<div class='sidebar widget'>" + LONG + "</div><noscript>no</noscript>"),
    ("<nav><ul><li>never closed", ""),
    ("<!-- a comment <p>x</p> --><div hidden>hidden text</div>", "<footer><p>" + LONG + "</p></footer><p cla"),
])
def test_article_without_the_rest(before, after):
    assert html_text.main_text(HEAD + before + ARTICLE + after) == WANT


def test_comments_inside_the_article_and_its_header():
    page = f"{HEAD}<main><article><header><h1>Title</h1></header><p>{LONG}</p><footer>by me</footer><section class='comments'><p>{LONG}</p></section></article></main>"
    assert html_text.main_text(page) == f"Title\n\n{LONG.strip()}"


def test_page_without_an_article():
    page = f"{HEAD}{NAV}<div><div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a href=x>1</a><a href=y>2</a><a href=z>3</a></div></div><footer>f</footer>"
    assert html_text.main_text(page) == "\n\n".join(["Head", LONG.strip(), "Short.", LONG.strip()])


def test_unclosed_and_nested_markup():
    assert html_text.main_text("<article><p><b>One.<br><p>Two <i>words</i> <p>Three</article>") == "One.\n\nTwo words\n\nThree"
    assert html_text.main_text("<article><table><tr><td>a<td>b</tr><tr><th>c</th></tr></table></article>") == "a b\n\nc"


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("just text &amp; more", "just text & more"), ("<p></p>", ""), ("<nav>x</nav>", ""), ("a < b", "a < b"),
])
def test_edges(page, want):
    assert html_text.main_text(page) == want


def test_chunks_do_not_matter(monkeypatch):
    page = HEAD + NAV + ARTICLE + "<footer>x</footer>"
    for n in (1, 7, 100):
        monkeypatch.setattr(html_text, "CHUNK", n)
        assert html_text.main_text(page) == WANT


def test_random_articles_of_paragraphs():
    rng = random.Random(1)
    for _ in range(50):
        paras = [" ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([1, 2, 8, 60, 300]))) for _ in range(rng.randint(1, 12))]
        page = HEAD + NAV + "<article>" + "".join(f"<p>{p}</p>" for p in paras) + "</article><footer>x y</footer>"
        assert html_text.main_text(page) == "\n\n".join(paras)


def test_very_long_page_and_deep_nesting():
    page = HEAD + "<article>" + f"<p>{LONG}</p>" * 5000 + "<div>" * 2000 + "end"
    assert html_text.main_text(page).count("\n\n") == 5000


def test_broken_markup_never_fails():
    rng = random.Random(7)
    bits = ["<", ">", "<!", "<![", "<![CDATA[", "]]>", "<!--", "-->", "<?", "</", "</p", "<p", '<p a="', '"', "'", "&", "&#", "&#x", "&amp", "<script>",
            "</script>", "<style>", "<article>", "</article>", "<nav>", "text ", "\x00", "=", "/", "<![if a]>", "<!DOCTYPE", "<svg/>", "</br>", "<textarea>", "<xmp>"]
    for _ in range(3000):
        assert isinstance(html_text.main_text("".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))), str)


@pytest.mark.parametrize("bit", ["<", "<!--", "<a ", "</", "&", "<![CDATA[", "<script>", "<div>", "<a b='", "<p>x", "<!", "<?", "<p></p><div>", "<nav><article>"])
def test_time_is_in_proportion_to_a_page(bit):
    import time

    began = time.process_time()
    html_text.main_text(bit * 40_000)
    assert time.process_time() - began < 10


def test_comments_scripts_and_declarations_are_no_text():
    page = "<article><p>a<!-- <p>x --->b<!-->c</p><script>if (a < b) '</p>' </script ><p>d<style>p > q {}</style>e <![CDATA[z]]></p>"
    assert html_text.main_text(page) == "abc\n\nde"
    assert html_text.main_text("<article><p>a</p><!-- open <p>b</p></article>") == "a"


def test_spark(spark):
    rows = [(1, "u", HEAD + ARTICLE, "old"), (1, "u", HEAD + ARTICLE, "old"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "html", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", WANT, WANT]
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("around", ["{}", "<div>{}</div>", "<div><section>{}</section></div>", "<article>{}</article>"])
@pytest.mark.parametrize("sizes", [[300] * 3 + [8000] + [300] * 4, [300] * 3 + [2000] + [300] * 4, [300] * 10 + [60] * 6, [60] * 6 + [90_000], [20, 9000, 20]])
def test_one_long_block_costs_no_other(around, sizes):
    paras = ["x" * n for n in sizes]
    page = HEAD + NAV + around.format("".join(f"<p>{p}</p>\n" for p in paras)) + "<footer>f</footer>"
    assert html_text.main_text(page) == "\n\n".join(paras)


def test_one_block_of_several_holds_a_long_line():
    page = f"{HEAD}{NAV}<div><h2>Head</h2><div><p>{LONG * 40}</p></div><div><p>{LONG}</p><p>Short.</p></div></div>"
    assert html_text.main_text(page) == "\n\n".join(["Head", (LONG * 40).strip(), LONG.strip(), "Short."])


def test_short_article_beside_a_long_one():
    page = f"{HEAD}{NAV}<article><p>{LONG * 40}</p></article><article><h2>Second</h2><p>Short.</p></article>"
    assert html_text.main_text(page) == "\n\n".join([(LONG * 40).strip(), "Second", "Short."])


@pytest.mark.parametrize("name", ["layout no-sidebar", "has-sidebar", "share-enabled", "widget-area", "menu-open notice", "ad", "pageWithSidebar", "header-fixed"])
def test_article_in_a_marked_container(name):
    inner = f"{NAV}<div class='sidebar'><p>{LONG}</p></div>{ARTICLE}<div id='comments'><article><p>{LONG}</p></article></div>"
    for page in (f"<div class='{name}'>{inner}</div><footer>f</footer>", f"<p>Skip</p><div class='{name}'><section id='{name}'>{inner}", f"<div><div class='{name}'>Buy{inner}</div>"):
        assert html_text.main_text(HEAD + page) == WANT


def test_article_in_a_marked_container_drops_what_it_holds():
    inner = ARTICLE.replace("</h1>", "</h1><div class='share'>Share</div><div class='ad'>Buy</div><aside>x</aside>")
    for name in ("no-sidebar", "share-enabled"):
        assert html_text.main_text(f"{HEAD}<div class='{name}'>{inner}<div class='related'><article>Other</article></div></div>") == WANT


def test_unclosed_advert_between_articles():
    page = f"{HEAD}{ARTICLE}<div class='ad'>Buy<article><p>Second.</p></article>"
    assert html_text.main_text(page) == WANT + "\n\nSecond."


def test_teasers_and_comments_are_not_articles():
    for around in ("<div class='related'>{}</div>", "<div class='share'><div class='comments'>{}</div></div>", "<div class='sidebar'><template>{}</template></div>"):
        assert html_text.main_text(HEAD + ARTICLE + around.format("<article><p>Teaser</p></article>")) == WANT
        page = f"{HEAD}<div><h1>T</h1><p>{LONG}</p><p>Short.</p></div>" + around.format("<article><p>Teaser</p></article>")
        assert html_text.main_text(page) == f"T\n\n{LONG.strip()}\n\nShort."


@pytest.mark.parametrize("around", ["<form>{}</form>", "<form><div class='has-sidebar'>{}</div></form>", "<div class='no-sidebar'>{}</div>", "<div class='widget'>" * 9 + "{}" + "</div>" * 9])
def test_page_within_a_form_or_marks(around):
    body = f"{NAV}<h2>Head</h2><p>{LONG}</p><div class='share'>Share</div><p>Short.</p><button>Send</button><footer>f</footer>"
    want = f"Head\n\n{LONG.strip()}\n\nShort."
    got = html_text.main_text(HEAD + around.format(body))
    assert got == want if around.count("<div") < 5 else got.replace("Share\n\n", "") == want


STORY = [f"Paragraph {k} of the story, {LONG}".strip() for k in range(3)]
AS_STORY = "".join(f"<p>{p}</p>" for p in STORY)


@pytest.mark.parametrize("beside", [
    "<article class='card'><p>A card with a teaser line.</p></article>", "<main><p>Short main.</p></main>",
    "<article><p>I liked this, says a reader in a comment of their own.</p></article>",
])
def test_a_story_beside_a_small_article(beside):
    for page in (f"<div>{AS_STORY}</div>{beside}", f"{beside}<div>{AS_STORY}</div>", f"<div>{AS_STORY}{beside}</div>"):
        assert html_text.main_text(HEAD + NAV + page + "<footer>f</footer>") == "\n\n".join(STORY)


@pytest.mark.parametrize("part", ["<section class='market-share'>{}</section>", "<div class='social-history'>{}</div>", "<section id='menu'>{}</section>", "<div class='sharecroppers'>{}</div>"])
def test_names_that_mark_nothing_within_an_article(part):
    page = f"{HEAD}<article>{AS_STORY}{part.format('<p>Of the text.</p>')}<p>End.</p></article>"
    assert html_text.main_text(page) == "\n\n".join([*STORY, "Of the text.", "End."])


@pytest.mark.parametrize("part", ["<div class='share-buttons'>{}</div>", "<div class='ad-box-2'>{}</div>", "<ul class='menu'><li>{}</li></ul>",
                                  "<section class='reader-reactions'>{}</section>", "<div style='color:red; display: none'>{}</div>", "<div class='related-posts newsletter'>{}</div>"])
def test_names_that_mark_within_an_article(part):
    page = f"{HEAD}<article>{AS_STORY}{part.format('<p>Not of the text.</p>')}<p>End.</p></article>"
    assert html_text.main_text(page) == "\n\n".join([*STORY, "End."])


def test_the_larger_part_of_an_article_is_never_dropped():
    page = f"{HEAD}<article><h1>Title</h1><div class='widget'>{AS_STORY}</div><div class='share'>Share</div></article>"
    assert html_text.main_text(page) == "\n\n".join(["Title", *STORY])


def test_a_menu_in_a_cell_of_a_layout_table():
    for cell in ("<td><a href=a>Home</a><br><a href=b>News</a></td>", "<td class='menu'>Home News</td>"):
        page = f"{HEAD}<table><tr>{cell}<td><div>{AS_STORY}</div></td></tr></table>"
        assert html_text.main_text(page) == "\n\n".join(STORY)


def plain_scores(lines, sigma):
    """The smoothed scores, line by line."""
    import math

    raw = [math.log1p(len(t) / max(tags, 1)) if ok and t else 0.0 for t, tags, ok in lines]
    reach = max(1, math.ceil(3 * sigma))
    out = []
    for k in range(len(raw)):
        near = [(math.exp(-0.5 * (d / sigma) ** 2), raw[min(max(k + d, 0), len(raw) - 1)]) for d in range(-reach, reach + 1)]
        out.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    return out


def test_every_page_goes_through_the_smoothed_ratios(monkeypatch):
    import duckdb

    from tests.conftest import SF_SMALL

    pages = [h for (h,) in duckdb.sql(f"select html from '{SF_SMALL}/pages.parquet'").fetchall()]
    seen, smoothed = [], html_text.smoothed
    monkeypatch.setattr(html_text, "smoothed", lambda ratios, sigma: seen.append(smoothed(ratios, sigma)) or seen[-1])
    for h in pages:
        assert html_text.main_text(h)
        lines = [(line[0], line[1], line[3]) for line in html_text.parsed(h).lines]
        assert max(abs(a - b) for a, b in zip(seen[-1], plain_scores(lines, html_text.SIGMA), strict=True)) < 1e-9
    assert len(seen) == len(pages)
