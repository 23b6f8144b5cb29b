"""Main text of pages: the labelled pages, odd markup, the generated pages."""

import html
import os
import re

import pytest

from ambertill.llm import html_text

FOLDER = "/root/testdata/sf0.001"
TREE = html_text.trained()


def text(page):
    return html_text.main_text(page, TREE)[0]


def test_tree_fits_the_labelled_pages():
    for page in html_text.LABELLED:
        marked = [p.text for p in html_text.blocks(page)]
        assert text(page).split("\n") == [t for t in marked if t.startswith("+")]


def test_other_kinds_of_page():
    body = "some words of an article that goes on for a while and tells more"
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p > a {{}}</style></head><body><div class="site-header">No header</div>
      <nav role=navigation><a href=x>No</a></nav><aside>No {body}</aside><div id="cookieNotice"><p>No {body}</p><button>No</button></div>
      <form action=x><label>No</label><input value="No"><select><option>No</select></form>
      <article class="post"><header><h1>Yes &amp; title</h1></header><p>Yes <b>{body}</b>&nbsp;&eacute;<br>and\t\n more</p>
      <div class="ad-slot">No {body}</div><ul><li>Yes</ul><p>Yes <a href="a>b">{body}</a></p><script>if (a < b) "</p>No"</script><!-- No > no -->
      <div class="share-buttons">No</div><p>Yes 1 &lt; 2</article>
      <section id="comments"><article class="comment"><p>No {body}</p></article></section><footer>No</footer></body></html>"""
    assert text(page).split("\n") == ["Yes & title", f"Yes {body} é and more", "Yes", f"Yes {body}", "Yes 1 < 2"]


def test_form_around_the_page():
    page = "<form><div class=menu>No</div><article><p>Yes</p></article></form>"
    assert text(page) == "Yes"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>", "</p></div>", "<a href='", "&#0;&#x110000;", "<p>" * 5000, "<b><i>" * 3000])
def test_broken_markup(page):
    assert text(page).strip("�<") == ""


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>" + "word " * 30, "t"), (1, None, None, "t"), (None, "v", "", "t")], "page_id long, url string, html string, text string"
    )
    got = sorted((tuple(r) for r in html_text.extract(pages).select("page_id", "url", "text").collect()), key=repr)
    assert got == sorted([(1, "u", " ".join(["word"] * 30)), (1, None, ""), (None, "v", "")], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_pages(spark):
    from ambertill.llm.queries import QUERIES

    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op4_html_extraction"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r.page_id].html.split("<article>")[1].split("</article>")[0]
        lines = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:p|h1|br)>", article)]
        assert r.text.split("\n") == [" ".join(x.split()) for x in lines if x.strip()]
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_held_out_accuracy_of_features():
    every, whole = html_text.held_out_accuracy()
    plain, plain_whole = html_text.held_out_accuracy(("heading", "words", "linked", "words_before", "linked_before", "words_after", "linked_after"))
    assert every > 0.9 and whole >= 10
    # Words and links of a block and its neighbours alone get far fewer blocks right on the labelled pages.
    assert plain < 0.7 and plain_whole == 0
