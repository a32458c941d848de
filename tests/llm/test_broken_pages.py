"""Deep, long and broken pages: defined results, no crash, time in proportion to length."""

import time

import pytest

from plumbline.llm import wrapper


def whole(page: str) -> tuple[str, str]:
    """The text without a wrapper, and with one that has been merged, packed and unpacked."""
    made = wrapper.merge(wrapper.page_wrapper(page), wrapper.page_wrapper(page + "<p>more</p>"))
    made = wrapper.unpack(wrapper.pack(wrapper.merge(made, wrapper.page_wrapper("<p>other</p>"))))
    return wrapper.extract(page, None), wrapper.extract(page, made)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div>" * 20_000 + "x" + "</div>" * 20_000 + "y", "x y"),
        ("<div>a" * 300 + "</div>b" * 300, " ".join("a" * 300 + "b" * 300)),
        ("<div>a" * 300 + "<nav>menu<p>in</p></nav>c" + "</div>b" * 300, " ".join("a" * 300 + "c" + "b" * 300)),
        ("<section>" * 600 + "<article><p>one</p><p>two</p></article>" + "</section>" * 600, "one two"),
        ("<p>open <b>tag <a href='x", "open tag <a href='x"),
        ("<p>a</p><p title=\"x>b</p><p>c</p>", "a b c"),
        ("a < b <3 &lt; <!-- gone --> <!doctype x> </ > c", "a < b <3 < c"),
        ("<p title='>'>kept</p><p title=a>b>too</p>", "kept b>too"),
        ("&#" + "9" * 9_000 + "; &#x0000000041; &#0;", "� A �"),
    ],
)
def test_broken_pages_have_their_text(page, text):
    assert whole(page)[0] == text


@pytest.mark.parametrize(
    "part", ["<a '", "<a ", "<a =\"", "<", "<!", "</", "<a<", "<p a", "<div>", "<li>", "<!--", "&#9", "<script>", "=\"'"]
)
def test_time_is_in_proportion_to_length(part):
    started = time.perf_counter()
    for end in ("", ">", "\">"):
        wrapper.extract(part * (200_000 // len(part)) + end, None)
    # 0.6 MB; quadratic time would be minutes.
    assert time.perf_counter() - started < 15


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="layout with-sidebar"><p>Body</p></div>', "Body"),
        ('<article class="post comments-open"><p>Article text', "Article text"),
        ('<article><p>a</p><section class="share-price">12</section></article>', "a 12"),
        ('<article><p>a</p><div class="share-buttons">Tweet</div><div id="comments">no</div></article>', "a"),
        ('<div class="sidebar-layout"><article><p>Main</p></article></div>', "Main"),
        ('<div class="related"><article>no</article></div><article>yes</article>', "yes"),
        ('<div><nav>n</nav><p>x</p><div class="site-footer">f</div></div>', "x"),
    ],
)
def test_names_do_not_take_out_the_article(page, text):
    assert wrapper.extract(page, None) == text


def test_deep_pages_in_a_table(spark):
    deep = "<div>" * 1_200 + "text" + "</div>" * 1_200
    rows = [(1, "http://h/1", deep), (2, "http://h/2", deep + "<p>two</p>"), (3, "http://h/3", None), (4, None, "<a '" * 10_000)]
    found = wrapper.main_text(spark.createDataFrame(rows, "page_id int, url string, html string"))
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert texts[1] == "text" and texts[2] == "text two" and texts[3] == "" and len(texts[4]) > 30_000
