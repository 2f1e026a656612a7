"""Pages that are cut off inside of a character reference."""

import pytest
from comparing import TABLES, assert_same

from inkmill.functions.markup import text_of
from inkmill.plans.queries import ORACLE_SQL, QUERIES

PAGES = ("<p>a &amp</p>", "<p>b &am</p>", "<p>c &a<br>d</p>", "<p>e &", "<p>AT&T &amp;&amp;&copy; &copy 1</p>", "<p>&#3</p>", "<p>z &quot;q&quot;</p>")


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cut")
    for t in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).toPandas().to_parquet(folder / f"{t}.parquet")
    rows = [(4 * i + 1, f"u{i}", page) for i, page in enumerate(PAGES)]
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(folder / "pages.parquet")
    return str(folder)


def test_closed_references():
    assert text_of("<p>a &am</p>") == "\na &am;\n" and text_of("<p>a &am</p>", closed=True) == "\na &am\n"
    assert text_of("&amp; &#65; &#x41; &copy &#6", closed=True) == "& A A &copy &#6"


def test_html_text_of_cut_pages(spark, cut):
    assert_same(spark, QUERIES["q19_html_text"], ORACLE_SQL["q19_html_text"], cut)


def test_book_paragraphs_of_cut_pages(spark, cut):
    assert_same(spark, QUERIES["q26_book_paragraphs"], ORACLE_SQL["q26_book_paragraphs"], cut)
