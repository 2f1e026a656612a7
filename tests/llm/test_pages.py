"""WARC archives and main text."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from inkmill.llm import common, mainblock, warc

PAGES = "page_id long, url string, html string, id string, sha string, text string"


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows, partitions=3):
        return spark.createDataFrame([(*r, "i", "s", "t") for r in rows], PAGES).repartition(partitions)

    return make


ROWS = [(1, "http://a.example.com/x", "<p>one</p>"), (2, "https://B.example.com:8080/y?z=1#f", "<p>two</p>"), (3, "http://a.example.com/x", "<p>one</p>"), (4, None, None), (5, "", ""), (6, "no url\r\nX: y", "é" * 1000), (7, "http://a.example.com/x", "<p>one</p>"), (7, "http://a.example.com/x", "<p>one</p>"), (None, "http://c/", "<p>one</p>"), (None, "http://c/", "alone"), (8, "http://[bad", "x" * 500_000), (-3, "http://d/", "\r\n\r\n")]


def expected(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        keeper = largest.get(h or "")
        revisit = keeper is not None and keeper != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, directory, limit, files", [(3000, 1000, 1 << 25, True), (2, 1000, 0, True), (2, 2, 1 << 25, True), (2, 2, 0, False), (3000, 1000, 1 << 25, False)])
def test_archives_and_index(pages, monkeypatch, block, directory, limit, files):
    monkeypatch.setattr(warc, "BLOCK_LINES", block)
    monkeypatch.setattr(warc, "SEGMENT_RECORDS", 3)
    monkeypatch.setattr(warc, "STRETCH_BYTES", 500)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 900)
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    df = pages(ROWS)
    archives = warc.write_archives(df, "page_id", "url", "html", files=files)
    assert archives.filter("data is null").isEmpty() != files
    blocks = warc.build_index(archives)
    got = warc.lookup(df.select("url", F.col("page_id").alias("id")), archives, blocks, directory).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(ROWS)
    some = warc.lookup(df.filter("page_id = 6").select("url", F.col("page_id").alias("id")), archives, blocks, directory, payload=True).first()
    assert bytes(some["payload"]).decode() == "é" * 1000 and some["url"] == ROWS[5][1]
    assert warc.lookup(df.limit(1).select(F.lit("http://none/").alias("url"), F.lit(9).cast("long").alias("id")), archives, blocks, directory).collect() == []


@pytest.mark.parametrize("files", [True, False])
def test_archives_are_plain_gzip(pages, files):
    archives = warc.write_archives(pages(ROWS, 1), "page_id", "url", "html", files=files)
    name = archives.first()["archive"]
    text = gzip.decompress(b"".join(warc.export_archives(archives, name)))
    assert text.count(b"WARC/1.1\r\n") == archives.filter(F.col("archive") == name).select(F.sum(F.size("entries"))).first()[0]


def test_small_payloads_and_empty_tables(pages):
    got = warc.lookup(pages(ROWS).select("url", F.col("page_id").alias("id")), a := warc.write_archives(pages(ROWS), "page_id", "url", "html", min_revisit=10**9), warc.build_index(a)).collect()
    assert {r["record_type"] for r in got} == {"response"}
    assert warc.archive_and_read(pages(ROWS).limit(0), "page_id", "url", "html").collect() == []


@pytest.mark.parametrize("url", ["http://a/x%41%20y", "http://a/x y", " a", "a ", "a\r\nX: y", "http://é/日本?q=1#f", "", "\x85\u2028", "%", "a: b"])
def test_urls_are_kept(url):
    for refers_to in (None, 5):
        data = warc.record(1, url, b"p", warc.base32_sha1(b"p"), refers_to)
        assert warc.parse(data)["url"] == url
    assert warc.parse(warc.record(1, None, b"p", warc.base32_sha1(b"p"), None))["url"] == ""


def test_a_lookup_reads_its_range_only(pages, monkeypatch):
    archives = warc.write_archives(pages(ROWS, 1), "page_id", "url", "html")
    blocks = warc.build_index(archives)
    name = archives.first()["archive"]
    places = {e["id"]: e for r in archives.collect() for e in r["entries"]}
    files, path = warc._open(name)
    with files.open_input_file(path) as f:
        data = bytearray(f.read())
    kept = places[6]
    for i in range(len(data)):
        if not kept["offset"] <= i < kept["offset"] + kept["length"]:
            data[i] = 0
    with files.open_output_stream(path, compression=None) as f:
        f.write(bytes(data))
    asked = pages(ROWS).filter("page_id = 6").select("url", F.col("page_id").alias("id"))
    assert warc.lookup(asked, archives, blocks).first()["page_id"] == 6


def test_records():
    assert warc.surt("https://M.Example.com:443/A?b=1#c") == "com,example,m)/A?b=1"
    data = warc.record(1, "u", b"payload", warc.base32_sha1(b"payload"), None)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError):
        warc.parse(b"x")


ARTICLE = "<article><h1>A &amp; B</h1><p><b>First.<br><p>Second\n  line &copy; x</p><div class='ad'>buy</div><p>Third <a href='/x'>link</a>.</p></article>"
FRAME = "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p><p>no';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- <p>hidden</p> --><header>Site name</header>{}<aside>side</aside><section id='comments'><p>a reader says much about it</p></section><form><p>mail?</p></form><footer>&copy; me</footer></body></html>"


def test_main_text():
    want = "A & B\nFirst.\nSecond line © x\nThird link."
    assert mainblock.main_text(FRAME.replace("{}", ARTICLE)) == want
    plain = "".join(f"<p>{'Some sentence of the story. ' * 5}</p>" for _ in range(4))
    menu = "".join(f"<div><a href='/{i}'>Topic {i}</a></div>" for i in range(9))
    got = mainblock.main_text(f"<body>{menu}{plain}{menu}</body>")
    assert got == "\n".join(["Some sentence of the story. " * 4 + "Some sentence of the story."] * 4)
    assert mainblock.main_text(None) == mainblock.main_text("") == mainblock.main_text("<p> </p>") == ""
    assert mainblock.main_text("<article><p>cut off &am") == "cut off &am"
    assert mainblock.main_text("<article><p>cut off</p><foot") == "cut off"
    assert mainblock.main_text("<div class='ad'>never closed<article><p>text</p>") == "text"
    assert mainblock.main_text("<p>a < b & c &#233; &nbsp; d</p>") == "a < b & c é d"


def test_links_at_the_ends_of_an_article_stay():
    page = "<p>before</p><article><h1><a href=x>Title</a></h1><p>Body.</p><p><a href=y>Last</a></p></article><p>after</p>"
    assert mainblock.main_text(page) == "Title\nBody.\nLast"
    assert mainblock.main_text("<p>A long line outside of it.</p><main><a href=x>One</a><p><a href=y>Two</a></p></main>") == "One\nTwo"


LONG = "a story goes on and on " * 10


@pytest.mark.parametrize(
    "page, want",
    [
        ("<html><head><title>t</title><meta x><body><article><p>Text</p></article>", "Text"),
        (f"<html><head><title>t</title><style>p{{}}</style><body><p>{LONG}</p>", LONG.strip()),
        (f"<p>{LONG}</p><svg><path d=1><p>after it</p>", f"{LONG.strip()}\nafter it"),
        ("<p>a<svg><title>x</title><text>no</text></svg>b</p>", "ab"),
        ("<div><iframe src=x><p>after</p></div>", "after"),
        ("<template><p>after</p>", "after"),
        ("<title>t<textarea>u<p>after</p>", "tu\nafter"),
        ("<p>kept</p><script>var x = '<p>lost</p>'", "kept"),
        ("<article><p>main text</p></article><article class='comment'><p>I say much more of it</p></article>", "main text"),
        ("<article><p>main text</p><div id=comments><article><p>I say much more of it</p></article></div><p>end</p></article>", "main text\nend"),
        ("<article><header><h1>Title</h1><p>by X share now</p></header><p>body</p><footer>f</footer></article>", "Title\nbody"),
        (f"<body><header><h1>Site</h1></header><div class='content no-sidebar'><p>{LONG}</p></div></body>", LONG.strip()),
        (f"<form id=whole><nav>menu</nav><p>{LONG}</p><p>second</p></form>", f"{LONG.strip()}\nsecond"),
        (f"<div class=sidebar><p>{LONG}</p></div><p>short</p>", f"{LONG.strip()}\nshort"),
        (f"<div class=sidebar><p>short</p></div><p>{LONG}</p><div class='site-footer'>imprint</div>", LONG.strip()),
        (f"<div class=comments><p>{LONG}</p></div><p>short</p>", "short"),
        ("<button>b<p>para</p><article>art</article>", "art"),
        ("<div><nav>never closed<p>menu</p></div><p>text</p>", "text"),
        ("<article><header><p>x</p></article><p>y</p>", "y"),
        ("<article><p>one</p></article><p>teaser</p><article><p>two</p></article>", "one\ntwo"),
        (f"<main><p>{LONG}</p></main>{'<p>between</p>' * 5}<main><p>short</p></main>", LONG.strip()),
        ("<p>a</p></div></div><p>b</p>", "a\nb"),
        (f"{'<div><a href=x>Topic</a></div>' * 5}<h1>Name</h1><p>{LONG}</p><p>End.</p>{'<div><a href=x>Topic</a></div>' * 5}", f"Name\n{LONG.strip()}\nEnd."),
    ],
)
def test_surge_and_dive_on_pages_of_all_kinds(page, want):
    assert mainblock.main_text(page) == want


def test_the_threshold_decides(monkeypatch):
    page = f"<article><p>{'few words of an article here ' * 2}</p></article><p>{'a far longer text outside ' * 200}</p>"
    assert mainblock.main_text(page).startswith("a far longer text")
    monkeypatch.setattr(mainblock, "MARKED_WEIGHT", 1000)
    assert mainblock.main_text(page).startswith("few words")


def test_hard_pages_take_linear_time(pages):
    for page in ["<svg>" * 50_000, "<svg><p></svg>" * 30_000, "<svg><b>" * 30_000 + "<p>", "<textarea>" * 50_000, "<article>" * 50_000, "<header>" * 50_000, "<form>x" * 50_000, "<nav><article>" * 30_000, "</p>" * 100_000, "<p>x</div>" * 50_000, "<a " * 100_000, "<" * 300_000, "<p \"" * 50_000, "<!--" * 100_000, "<script>" * 50_000, "<div class='ad'>" * 50_000, "<p>" + "x" * 1_000_000]:
        mainblock.main_text(page)


def test_extraction_of_a_table(pages):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (2, None, None), (None, "v", "<p>x</p>")]
    got = mainblock.extract(pages(rows), "page_id", "url", "html").collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 1), (1, 40), (1, 40), (2, 0)]
    assert mainblock.extract(pages(rows).limit(0), "page_id", "url", "html").collect() == []


def test_every_generated_page(spark):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    for (page,) in random.Random(1).sample(rows, 100):
        body = page[page.index("<article>") + 9 :].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", x))).strip() for x in re.split("</?(?:h1|p|br)>", body)]
        assert mainblock.main_text(page) == "\n".join(x for x in blocks if x)
