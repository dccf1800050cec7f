"""Pages of any depth and breadth, and elements that are no white space."""

import pytest

from shelfwise.llm import html_text


def test_deep_and_broad_pages_go_through(spark):
    deep = "<div>" * 10_000 + "deep" + "</div>" * 10_000
    mixed = "".join(f"<{t}>a{k}</{t}>" for k in range(10_000) for t in ("p", "h3"))
    rows = [(1, "http://a.example/1", deep), (2, "http://a.example/2", deep.replace("deep", "deeper") + "<p>more"), (3, "http://b.example/1", mixed)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[1] == "deep" and texts[2] == "deeper\nmore"
    assert texts[3].split("\n") == [f"a{k}" for k in range(10_000) for _ in range(2)]


def test_long_sibling_lists_are_aligned_by_their_ends():
    pages = ["<section>" + "<p>x</p><h3>y</h3>" * n + extra + "<p>x</p><h3>y</h3>" * n + "</section>" for n, extra in ((3000, ""), (3000, "<table></table>"))]
    merged = html_text.merge(*map(html_text.tree_of, pages))
    assert merged[1] == 2 and [k[0] for k in merged[4][0][4]].count("table") == 1


@pytest.mark.parametrize("page", ["", "<p>a", "<div><p>a</p><ul><li>1<li>2</ul></div><p>b</p>", "<article>x<aside>y</aside></article>"])
def test_tree_round_trip(page):
    tree = html_text.tree_of(page)
    assert html_text.loaded(html_text.dumped(tree)) == tree


def test_elements_within_words_add_no_space():
    assert html_text.main_text("<p>super<wbr>cali<img src=x>fragilistic<input></p>") == "supercalifragilistic"
    assert html_text.main_text("<p>one<br>two<hr>three") == "one two three" or html_text.main_text("<p>one<br>two<hr>three") == "one two\nthree"


def test_matching_counts_the_most_pairs():
    a, b = (html_text.tree_of(p) for p in ("<ul><li><b>1</b></li></ul><p>x</p>", "<p>y</p><ul><li><i>1</i></li><li></li></ul>"))
    assert html_text.Matching().same(a, b) == 3
