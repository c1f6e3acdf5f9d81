import html as H

import pytest

from blotter.llm import queries as Q
from blotter.llm.html import blocks, extract_main_text, main_text

LONG = "The quick brown fox of the house was in the garden with a bird and it was not to be seen by the dog."
SHORT = "Only this."


def page(body: str, head: str = "<title>The title</title><style>p{}</style>") -> str:
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("junk", [
    "<nav><ul><li><a href='/x'>The home of the site</a></li></ul></nav>",
    "<header><h1>The site of the century and of the town</h1></header>",
    "<footer>&copy; the owner of the site and all of the text that is in it, as of the year 2020 and so on</footer>",
    "<aside><p>" + LONG + "</p></aside>",
    "<div class='sidebar left'><p>" + LONG + "</p></div>",
    "<div id=\"cookie-notice\">" + LONG + "</div>",
    "<div class=ad>" + LONG + "</div>",
    "<form><label>Name</label><input name='q'><p>" + LONG + "</p></form>",
    "<script>var t = '<p>" + LONG + "</p>';</script>",
    "<style>p::before { content: '<p>" + LONG + "</p>' }</style>",
    "<section class='comments'><article><p>" + LONG + "</p></article></section>",
    "<article class='comment'><p>" + LONG + "</p></article>",
    "<div role='navigation'>" + LONG + "</div>",
    "<div style='display: none'>" + LONG + "</div>",
    "<!-- <p>" + LONG + "</p> -->",
])
@pytest.mark.parametrize("place", ["before", "after", "inside"])
def test_what_is_not_the_article_goes(junk, place):
    a = "<h2>A heading</h2><p>First. " + LONG + "</p>"
    b = "<p>" + SHORT + "</p><p>Last. " + LONG + "</p>"
    body = {"before": junk + "<article>" + a + b + "</article>", "after": "<article>" + a + b + "</article>" + junk,
            "inside": "<article>" + a + junk + b + "</article>"}[place]
    if place == "inside" and junk.startswith("<header"):
        pytest.skip("a header inside the article is the article's own")
    assert main_text(page(body)).split("\n") == ["A heading", "First. " + LONG, SHORT, "Last. " + LONG]


def test_character_references_white_space_and_inline_markup():
    body = "<article><p>Fish &amp; chips &lt;b&gt; &#233;&#x4e2d;&nbsp;<b>bold</b>ly\n\t  done<br>and   <i>more</i> " + LONG + "</p></article>"
    assert main_text(page(body)) == "Fish & chips <b> é中 boldly done and more " + LONG


def test_unclosed_tags_and_missing_ends():
    body = "<div class=ad>x</div><article><h1>Title</h1><p><b>" + LONG + "<br><p>" + SHORT + "<p>" + LONG
    assert main_text("<html><body>" + body) == "\n".join(["Title", LONG, SHORT, LONG])


def test_two_passes_without_an_article_element():
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(6)) + "</ul>"
    body = menu + "<div>Top of page</div>" + menu + "<p>" + LONG + "</p><p>" + SHORT + "</p><p>" + LONG + "</p>" + menu + "<div>Last words</div>" + menu
    assert main_text(page(body)) == "\n".join([LONG, SHORT, LONG])


def test_paragraph_without_stop_words_in_an_article_stays():
    odd = "Zxcv qwer " * 20
    assert main_text(page(f"<article><p>{LONG}</p><p>{odd}</p></article>")).split("\n")[1] == odd.strip()


def test_article_named_by_attributes():
    body = "<div>Top</div><div role=\"main\"><p>" + SHORT + "</p><p>" + LONG + "</p></div><div>" + LONG + "</div>"
    assert main_text(page(body)) == SHORT + "\n" + LONG


def test_blocks_report_link_density():
    found = blocks("<p><a href='x'>abcd</a>efgh</p>")
    assert found == [("abcdefgh", 0.5, False, False)]


def test_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>{i} {LONG}</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", page("<article><p>" + LONG + "</p></article>"), "t"),
            (3, "w", "plain words", "t"), (3, "w", "plain words", "t"), (4, "x", long, "t"), (5, "y", "<p", "t"),
            (6, "z", "<a title=\"never closed", "t"), (7, "z", "<script>" + LONG, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[2].url is None
    assert by[None].text == LONG and by[None].n_chars == len(LONG)
    assert by[3].text == "plain words" and by[7].text == ""
    assert by[4].text.count("\n") == 4999 and by[4].n_chars == len(by[4].text)


def test_empty_table(spark):
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_query_against_a_plain_reading_of_the_test_pages(spark, sf_small):
    """The test pages hold one article element: its blocks, read bluntly."""
    import re
    pages = {p.page_id: p.html for p in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in Q.op2_html_extraction(spark, sf_small).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        want = [" ".join(H.unescape(re.sub(r"<[^>]+>", " " if "<br" in x else "", x)).split())
                for x in re.split(r"</?(?:p|h1|article)>", inside)]
        assert r.text == "\n".join(x for x in want if x)
        assert r.n_chars == len(r.text)


def test_a_language_without_listed_words_is_not_lost_to_a_footer():
    body = "<p>Съешь же ещё этих мягких французских булок, да выпей чаю, и ещё раз то же самое до конца абзаца.</p>"
    page = f"<body><div>{body * 4}</div><div>All rights reserved in the whole of the world.</div></body>"
    assert main_text(page).count("Съешь") == 4
    page = f"<body><div>{body * 4}</div><div>{'The rights to this text are with the owner of the site. ' * 2}</div></body>"
    assert main_text(page).count("Съешь") == 4


def test_stop_words_decide_on_a_page_of_prose_without_an_article_tag():
    prose = "<p>It was the best of the times and it was the worst of the times, as they said in that year of the war.</p>"
    spam = "<p>" + "Cheap watches buy now replica rolex discount offer today only click order fast shipping worldwide " * 2 + "</p>"
    got = main_text(f"<body><div>{prose * 5}{spam}</div></body>")
    assert got.count("best of the times") == 5 and "replica" not in got
