import http.server
import json
import threading
import zipfile
from functools import partial

import pytest

from inkmill.cli import main
from inkmill.plans.config import ProviderOptions, SliceOptions, load_cleaning, load_providers
from inkmill.plans.model_slicing import NO_CUTS, ask, clients_of, slice_books
from inkmill.plans.prompts import messages
from inkmill.plans.single_book import SliceRunError, clean_file, slice_file
from inkmill.providers import ProviderError, build
from inkmill.providers.answers import AnswerFolder
from inkmill.providers.base import HttpProvider, ScriptedProvider, fixed
from inkmill.sources import sinks
from inkmill.sources.epub import EpubError, read_epubs
from inkmill.sources.lines import count_non_empty_lines, read_lines
from inkmill.streaming.books import clean_stream

RULES, HEADINGS = load_cleaning()
PAGES = {"b.html": "<p>第一章 起点</p><p>起点</p><p>他说：“走。</p><p>”他走了。</p><p>求月票！</p>", "a.html": "<p>楔子</p><p>gone</p><p>第二章 归来</p><p>Hello! World。</p>"}


def epub(path, spine=("b", "a", "x", "none", "img"), container=True, opf_spine=True):
    with zipfile.ZipFile(path, "w") as z:
        if container:
            z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>')
        items = "".join(f'<item id="{n[0]}" href="{n}" media-type="Application/XHTML+xml"/>' for n in PAGES) + '<item id="x" href="lost.html" media-type="text/html"/><item id="img" href="i.png" media-type="image/png"/><item id="b" href="old.html"/><item id="b" href="b.html" media-type="text/html"/><item href="q"/>'
        refs = "".join(f'<itemref idref="{s}"/>' for s in spine)
        z.writestr("O/p.opf", f'<package xmlns="urn:o"><manifest>{items}</manifest>{f"<spine>{refs}</spine>" if opf_spine else ""}</package>')
        for name, page in PAGES.items():
            z.writestr(f"O/{name}", f"<html><head><title>t</title></head><body>{page}</body></html>")
    return path


def test_archives(spark, tmp_path):
    epub(tmp_path / "one.epub")
    rows = read_epubs(spark, str(tmp_path)).orderBy("spine_pos").collect()
    assert [(r["book_id"], r["href"], r["content"] is None) for r in rows] == [("one", "O/b.html", False), ("one", "O/a.html", False), ("one", "O/lost.html", True)]
    epub(tmp_path / "two.epub", container=False)
    (tmp_path / "three.epub").write_bytes(b"no zip")
    epub(tmp_path / "four.epub", opf_spine=False)
    errors = {r["book_id"]: r["error"] for r in read_epubs(spark, str(tmp_path), keep_errors=True).filter("error is not null").collect()}
    assert set(errors) == {"two", "three", "four"} and EpubError.__name__ in errors["two"]
    with pytest.raises(Exception, match="missing in archive"):
        read_epubs(spark, str(tmp_path / "two.epub")).collect()


def test_cleaning_one_book(spark, tmp_path):
    out = clean_file(spark, epub(tmp_path / "one.epub"), RULES, HEADINGS, tmp_path / "new" / "one.txt", tmp_path / "log.jsonl")
    assert out.read_text("utf-8") == "他说：“走。”\n他走了。\nHello! World。\n".replace("! W", "!W")
    assert [json.loads(x) for x in (tmp_path / "log.jsonl").read_text("utf-8").splitlines()] == [{"bucket": "solicitation", "rule": "extract_solicitation", "text": "求月票！"}]
    empty = clean_file(spark, epub(tmp_path / "e.epub", spine=()), RULES, HEADINGS, tmp_path / "e.txt")
    assert empty.read_text() == "\n"


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for round_, name in enumerate(("one", "two")):
        epub(tmp_path / "in" / f"{name}.epub")
        if round_:
            (tmp_path / "in" / "bad.epub").write_bytes(b"x")
        clean_stream(spark, str(tmp_path / "in"), RULES, HEADINGS, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/lines")).groupBy("book_id").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "out/errors")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/extracted")).groupBy("book_id").count().count() == 2
    epub(tmp_path / "in" / "one.epub", spine=())  # delivered again without any text, and the faulty one mended
    epub(tmp_path / "in" / "bad.epub")
    clean_stream(spark, str(tmp_path / "in"), RULES, HEADINGS, str(tmp_path / "out"), str(tmp_path / "cp2"), available_now=True).awaitTermination()
    assert {r["book_id"] for r in spark.read.parquet(str(tmp_path / "out/lines")).collect()} == {"two", "bad"}
    assert {r["book_id"] for r in spark.read.parquet(str(tmp_path / "out/extracted")).collect()} == {"two", "bad"}
    spark.catalog.clearCache()
    assert not any((tmp_path / "out/errors").glob("book_id=*"))


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder in ("a", "b c+%"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        epub(tmp_path / "in" / folder / "x.epub")
        text_file(tmp_path / "in" / folder / "y.txt", 3)
    (tmp_path / "in" / "y.text.csv").write_text("one\n")
    assert {r["book_id"] for r in read_epubs(spark, str(tmp_path / "in")).collect()} == {"a/x", "b c+%/x"}
    assert {r["book_id"] for r in read_epubs(spark, str(tmp_path / "in" / "*" / "x.epub")).collect()} == {"a/x", "b c+%/x"}
    assert {r["book_id"] for r in read_epubs(spark, str(tmp_path / "in" / "a" / "x.epub")).collect()} == {"x"}
    got = read_lines(spark, str(tmp_path / "in") + "/{a,b*}/*.txt").groupBy("book_id").count().collect()
    assert {r["book_id"]: r["count"] for r in got} == {"a/y": 3, "b c+%/y": 3}
    assert read_lines(spark, str(tmp_path / "in" / "y.text.csv")).first()["book_id"] == "y.text.csv"


def text_file(path, n=30):
    path.write_text("\n\n".join(f"line{i:02d}xxxx" for i in range(n)) + "\n \n", "utf-8")
    return path


def test_lines(spark, tmp_path):
    path = text_file(tmp_path / "b.c.txt", 3)
    assert [tuple(r) for r in read_lines(spark, str(path)).orderBy("line_no").collect()] == [("b.c", i + 1, f"line{i:02d}xxxx") for i in range(3)]
    assert count_non_empty_lines(spark, str(path)) == 3


OPTIONS = SliceOptions(provider_order=("p", "q"), retry_max=2, retry_backoff_s=0, target_chars_min=45, target_chars_max=55, chunk_input_tokens=40)
PROVIDERS = {n: ProviderOptions(n, "scripted", "http://x", f"model-{n}", "key") for n in "pq"}


def scripted(p=(), q=()):
    made = {"p": ScriptedProvider(p), "q": ScriptedProvider(q)}
    return lambda o: made[o.name]


def cut(*ends):
    return json.dumps({"cuts": [{"end_line": e, "title": f"t{e}"} for e in ends]})


def test_dry_run_files(spark, tmp_path):
    seen = []
    out = slice_file(spark, text_file(tmp_path / "b.txt", 10), {}, OPTIONS, tmp_path / "o", dry_run=True, progress=lambda *a: seen.append(a))
    got = json.loads(out.read_text("utf-8"))
    assert [(s["slice_id"], s["start_line"], s["end_line"]) for s in got] == [(1, 1, 5), (2, 6, 10)] and "title" not in got[0]
    run = json.loads((tmp_path / "o/run.json").read_text("utf-8"))
    assert run["status"] == "ok" and run["slices_written"] == 2 and "key" not in json.dumps(run["slice_config"])
    assert seen[-1] == (2, 10, 10)
    (tmp_path / "e.txt").write_text(" \n")
    with pytest.raises(ValueError, match="no lines to slice"):
        slice_file(spark, tmp_path / "e.txt", {}, OPTIONS, tmp_path / "o", dry_run=True)


def test_model_run(spark, tmp_path):
    # chunks hold 10 lines each; the first answer needs a second try, the second falls over to q, the last is empty
    make = scripted(["junk", cut(5, 2), cut(), cut()], [cut(10), cut()])
    out = slice_file(spark, text_file(tmp_path / "b.txt", 12), PROVIDERS, OPTIONS, tmp_path / "o", make=make)
    got = json.loads(out.read_text("utf-8"))
    assert [(s["start_line"], s["end_line"], s.get("title")) for s in got] == [(1, 5, "t5"), (6, 10, "t10"), (11, 12, None)]
    assert json.loads((tmp_path / "o/run.json").read_text())["providers_used"] == ["p", "q"]


def test_model_failure(spark, tmp_path):
    make = scripted([cut(), cut()], [cut(), cut()])
    with pytest.raises(SliceRunError, match=NO_CUTS):
        slice_file(spark, text_file(tmp_path / "b.txt", 30), PROVIDERS, OPTIONS, tmp_path / "o", make=make)
    assert json.loads((tmp_path / "o/slices.json").read_text())[-1] == {"slice_id": 1, "start_line": 1, "end_line": 10, "error": NO_CUTS}
    run = json.loads((tmp_path / "o/run.json").read_text())
    assert run["status"] == "error" and run["error"]["provider"] is None


def test_retries_sleep_and_answers_are_kept():
    slept, kept = [], {}
    clients = {"p": (ScriptedProvider([ProviderError("x"), ProviderError("y"), cut(1)]), "m")}
    options = SliceOptions(retry_max=3, retry_backoff_s=1)
    asked = ask([], 1, 5, options, clients, answers=kept, sleep=slept.append)
    assert slept == [1, 2] and [c.end_line for c in asked.cuts] == [1] and asked.used == ("p", "m")
    assert [c.end_line for c in ask([], 1, 5, options, clients, answers=kept).cuts] == [1]
    with pytest.raises(ValueError):
        clients_of({}, SliceOptions(provider_order=("z",)))
    with pytest.raises(ValueError):
        clients_of(PROVIDERS, SliceOptions())


def test_many_books(spark):
    rows = [(b, i + 1, "x" * 10) for b in ("a", "b") for i in range(10)]
    lines = spark.createDataFrame(rows, "book_id string, line_no long, text string")
    make = partial(fixed, cut(5, 10))
    got = slice_books(lines, OPTIONS, PROVIDERS, make).orderBy("book_id", "slice_id").collect()
    assert [(r["book_id"], r["end_line"], r["title"], r["provider"]) for r in got] == [(b, e, f"t{e}", "p") for b in "ab" for e in (5, 10)]
    assert json.loads(sinks.books_as_json(slice_books(lines, OPTIONS, PROVIDERS, make)).filter("book_id = 'a'").first()["json"])[1]["end_line"] == 10


def test_answers_outlive_a_task(spark, tmp_path):
    lines = spark.createDataFrame([("a", i + 1, "x" * 10) for i in range(10)], "book_id string, line_no long, text string")
    first = slice_books(lines, OPTIONS, PROVIDERS, partial(fixed, cut(5, 10)), answers=f"file://{tmp_path}/answers").collect()
    again = slice_books(lines, OPTIONS, PROVIDERS, partial(fixed, "junk"), answers=str(tmp_path / "answers")).collect()
    assert first == again and [r["end_line"] for r in first] == [5, 10]
    kept = AnswerFolder(str(tmp_path / "answers"))
    assert len(kept) == len(list(kept)) == 1 and kept.get("none") is None
    del kept[next(iter(kept))]
    assert not kept


def test_settings_are_converted():
    got = SliceOptions.parse({"retry_max": 5.0, "target_chars_min": "5000", "timeout_s": "2.5", "temperature": 1})
    assert (got.retry_max, got.target_chars_min, got.timeout_s, got.temperature) == (5, 5000, 2.5, 1.0)
    assert isinstance(got.retry_max, int) and isinstance(got.temperature, float)
    for wrong in ({"retry_max": "many"}, {"timeout_s": None}, {"target_chars_min": "5.5"}, {"temperature": []}):
        with pytest.raises(ValueError, match="must be a number"):
            SliceOptions.parse(wrong)


def test_http_providers():
    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            got.append((self.path, self.headers["Authorization"], body))
            status, answer = {"ok": (200, {"choices": [{"message": {"content": "hi"}}], "usage": {"n": 1}}), "none": (200, {"choices": []}), "odd": (200, {"choices": [{"message": {"content": 3}}]}), "fail": (500, {})}[body["model"]]
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(answer).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/"
    ask_ = lambda p, model, form=None: p.chat_completions(model=model, messages=[{"role": "user", "content": "é"}], max_tokens=5, temperature=0.1, response_format=form, timeout_s=5)
    try:
        one = build(ProviderOptions("a", "openai_compatible", base, "ok", "k"))
        result = ask_(one, "ok", {"type": "json_object"})
        assert (result.content, result.usage) == ("hi", {"n": 1})
        assert got[-1][:2] == ("/v1/chat/completions", "Bearer k") and got[-1][2]["response_format"] == {"type": "json_object"}
        assert ask_(build(ProviderOptions("b", "volc_ark", base, "ok", "k")), "ok").content == "hi"
        assert got[-1][0] == "/api/v3/chat/completions" and got[-1][2]["stream"] is False
        for model in ("none", "odd", "fail"):
            with pytest.raises(ProviderError):
                ask_(one, model)
    finally:
        server.shutdown()
    with pytest.raises(ProviderError, match="could not be reached"):
        ask_(HttpProvider("http://127.0.0.1:9", "k", "v1"), "ok")
    with pytest.raises(ValueError):
        build(ProviderOptions("a", "other", base, "m", "k"))


def test_prompt_and_keys(monkeypatch, tmp_path):
    system, user = (m["content"] for m in messages(7, [(7, "a {{start_line}}"), (8, "b")], 1, 2))
    assert system and user.endswith("\n7\ta {{start_line}}\n8\tb") and "from line 7 on" in user
    monkeypatch.setenv("SOME_KEY", " v ")
    assert ProviderOptions("a", "t", "u", "m", " ", "SOME_KEY").key() == "v"
    with pytest.raises(ValueError):
        ProviderOptions("a", "t", "u", "m").key()
    path = tmp_path / "p.json"
    path.write_text(json.dumps({"providers": {"a": {"type": "t", "base_url": "u", "model": "m"}, "b": {"type": "t"}}}))
    assert list(load_providers(path)) == ["a"]


def test_command_line(spark, tmp_path, capsys):
    assert main(["clean", str(epub(tmp_path / "one.epub")), "-o", str(tmp_path / "one.txt")]) == 0
    (tmp_path / "llm.json").write_text(json.dumps({"providers": {"a": {"type": "volc_ark", "base_url": "u", "model": "m"}}}))
    (tmp_path / "slice.json").write_text("{}")
    args = ["slice", str(tmp_path / "one.txt"), "--dry-run", "--out-dir", str(tmp_path / "o"), "--llm-config", str(tmp_path / "llm.json"), "--slice-config", str(tmp_path / "slice.json")]
    assert main(args) == 0
    assert capsys.readouterr().out.splitlines()[-1] == str(tmp_path / "o/slices.json")
    with pytest.raises(SystemExit):
        main(["slice", "x.txt", "--llm-config", str(tmp_path / "none.json")])
