from plumbline.llm import wrapper


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrapper.main_text(pages).collect()}


def test_copies_of_a_page_count_once(spark):
    plain = "<body><p>Text {0} of {0}</p><div class='y'>Same line</div>{1}<div>End {0}</div></body>"
    rows = [(i, "http://h.example/x", plain.format(i, "")) for i in range(40)]
    # Copies of pages with a block of their own, more than a few page hashes could tell apart.
    for k in range(6):
        copied = plain.format(100 + k, f"<blockquote class='q{'abcdef'[k]}'>Only here {k}</blockquote>")
        rows += [(100 + 10 * k + i, "http://h.example/x", copied) for i in range(8)]
    got = texts_of(spark, rows)
    assert all(got[i] == f"Text {i} of {i} End {i}" for i in range(40))
    for k in range(6):
        n = 100 + k
        assert all(got[100 + 10 * k + i] == f"Text {n} of {n} Only here {k} End {n}" for i in range(8))


MARKED = (
    "<body><nav>menu</nav><article><p>Read on our site</p><h1>Title {0}</h1><p>Words {0} and {0}</p>"
    "<p>more of {0}</p><div class='k'>Copyright of us</div><ul><li><a href=x>source {0}</a></li></ul>"
    "{1}<p>Last {0}</p><p>Pass this story on</p></article><p>outside {0}</p></body>"
)


def test_the_wrapper_decides_inside_marked_articles(spark):
    rows = [(i, "http://m.example/x", MARKED.format(i, "")) for i in range(12)]
    # A block that three pages share is content: most pages of the host do not have it.
    few = "<pre class='z'>said by three</pre>"
    rows += [(20 + i, "http://m.example/x", MARKED.format(20 + i, few)) for i in range(3)]
    # Two pages are no template, and near copies of one text keep it.
    rows += [(30 + i, "http://two.example/x", MARKED.format(i, "")) for i in range(2)]
    near = "<article><h1>Same</h1><p>{0}</p><div class='t'>" + "The same long text. " * 9 + "</div></article>"
    rows += [(40 + i, "http://near.example/x", near.format(i)) for i in range(5)]
    got = texts_of(spark, rows)
    for i in range(12):
        assert got[i] == f"Title {i} Words {i} and {i} more of {i} source {i} Last {i}"
    for i in range(20, 23):
        assert got[i] == f"Title {i} Words {i} and {i} more of {i} source {i} said by three Last {i}"
    assert all("Pass this story on" in got[30 + i] and "Copyright" in got[30 + i] for i in range(2))
    assert all(got[40 + i] == f"Same {i} " + ("The same long text. " * 9).strip() for i in range(5))
