"""Secrets, language, near-duplicates, decontamination, paragraphs and toxicity."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from inkmill.llm import common, langmix, paragraphs, positional, queries, secrets, simhash, toxicity

FOLD = {i: i + 32 for i in range(65, 91)}


# -- secrets ------------------------------------------------------------------------------------------

KEY = "Ab3dEf6hIj9kLm2nOp5qRs8t"


def test_base_spans():
    text = f'x Password = "abcdefgh" token:short AKIA{"A1" * 8} {"0f" * 16} secret=aaaaaaaa.b ﬁ API_KEY: {"z" * 9}'
    found = secrets.base_spans(text)
    assert [(k, text[a:b]) for a, b, k, _ in found] == [("assign", 'Password = "abcdefgh'), ("access", "AKIA" + "A1" * 8), ("hex", "0f" * 16), ("assign", "secret=aaaaaaaa.b"), ("assign", "API_KEY: " + "z" * 9)]
    assert secrets.base_spans("ſecret=abcdefghij") == []  # case folds in ASCII only
    assert secrets.base_spans("0" * 31 + "g" + "0" * 32)[0][:3] == (32, 64, "hex")
    assert [k for *_, k, _ in secrets.base_spans("token=" + "a" * 40)] == ["assign", "hex"]


def test_ownership_decides(docs):
    rows = [(1, f"see {KEY} end", "en", "one"), (2, f"see {KEY}", "en", "two")]
    found = {r["doc_id"]: r for r in secrets.find_secrets(docs(rows), "doc_id", "text", "doc_id", "source").collect()}
    assert [(f["a"], f["b"], f["kind"], f["live"]) for f in found[1]["findings"]] == [(4, 4 + len(KEY), "live", True)]
    rows += [(3, KEY, "en", "three"), (4, f"token={'q' * 20}", "en", "three"), (5, "clean", "en", "x"), (5, "clean", "en", "x")]
    found = secrets.find_secrets(docs(rows), "doc_id", "text", "doc_id", "source").collect()
    assert len(found) == 6
    by = {r["doc_id"]: (len(r["findings"]), r["n_live"], r["n_examples"]) for r in found}
    assert by == {1: (0, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (1, 1, 0), 5: (0, 0, 0)}
    table = secrets.ownership(secrets.scan(docs(rows), "doc_id", "text", "doc_id", "source")).collect()
    assert sorted((r["n_repos"], r["n_owners"], r["live"]) for r in table) == [(1, 1, True), (3, 3, False)]


def plain_secrets(text):
    """(start, end, kind, value) by a scanner of its own: base kinds, then free tokens that overlap none."""
    letters, found = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", []
    digits = "0123456789"
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    def run(at, signs):
        end = at
        while end < len(text) and text[end] in signs:
            end += 1
        return end

    at = 0
    while at < len(text):
        name = next((n for n in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(n, at)), None)
        if name:
            p = at + len(name)
            p += text[p : p + 1] in ('"', "'") and text[p : p + 1] != ""
            p = run(p, " ")
            if text[p : p + 1] in (":", "=") and p < len(text):
                p = run(p + 1, " ")
                q = p + (text[p : p + 1] in ('"', "'") and p < len(text))
                end = run(q, letters + digits + "+/_.=-")
                if end > q:
                    if end - q >= 8:
                        found.append((at, end, "assign", text[q:end]))
                    at = end
                    continue
        at += 1
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        end = run(at + 4, letters[:26] + digits)
        if end - at >= 16:
            found.append((at, end, "access", text[at:end]))
        at = max(end, at + 4) if end > at + 4 else at + 1
    at = 0
    while at < len(text):
        end = run(at, digits + "abcdef")
        if end - at >= 32:
            found.append((at, end, "hex", text[at:end]))
        at = max(end, at + 1)
    base = sorted(found, key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))
    free, at, signs = [], 0, letters + digits + "+/_-"
    while at < len(text):
        end = run(at, signs)
        if end - at >= 20:
            stop = min(run(end, "="), end + 2)
            v = text[at:stop]
            kinds = [any(c in group for c in v) for group in (letters[:26], letters[26:], digits)]
            bits = -sum(v.count(c) / len(v) * math.log2(v.count(c) / len(v)) for c in set(v))
            if all(kinds) and bits >= 3.5 and not any(a < stop and at < b for a, b, *_ in base):
                free.append((at, stop, "live", v))
        at = max(end, at + 1)
    return base, free


def plain_owners(rows):
    """value -> (repositories, owners) of rows (repo, owner, text)."""
    owners = {}
    for repo, owner, text in rows:
        base, free = plain_secrets(text or "")
        for *_, v in base + free:
            held = owners.setdefault(v, (set(), set()))
            held[0].add(repo)
            held[1].add(owner)
    return {v: (len(r), len(o)) for v, (r, o) in owners.items()}


def plain_findings(text, owners):
    """(start, end, kind, live, repositories, owners) of a text, as find_secrets has them."""
    base, free = plain_secrets(text or "")
    out = []
    for a, b, kind, v in sorted(base + free, key=lambda x: (x[0], ("assign", "access", "hex", "live").index(x[2]))):
        repos, people = owners[v]
        live = people == 1 or people <= 2 and repos <= 20
        if kind != "live" or live:
            out.append((a, b, kind, live, repos, people))
    return out


def secret_texts(rng, n):
    """Texts of pieces that make, break and join secrets."""
    values = [KEY, "q" * 20, "AKIA" + "Z9" * 7, "0f" * 16, "0f" * 20 + "G", "aB3" * 9, "x.y=z/9" * 2]
    bits = ["token=", "Password : ", "api_key='", 'apikey" = "', "secret", "passwd", " ", "\n", "=", "-", "AKIA", "AKIAAKIA" + "B" * 12, "plain", "é", '"', "'", ":", "a" * 31, "deadbeef" * 4, "/"]
    return ["".join(rng.choice(values if rng.random() < 0.4 else bits) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_spans_against_a_scanner_of_its_own():
    for text in secret_texts(random.Random(21), 4000):
        base, free = plain_secrets(text)
        assert secrets.base_spans(text) == base, text
        assert secrets.free_spans(text, base) == free, text


def test_free_spans_take_linear_time():
    text = " ".join(f"token={i:08d}aaaa {KEY}{i}" for i in range(30_000))
    began = time.perf_counter()
    assert len(secrets.free_spans(text, secrets.base_spans(text))) == 30_000
    assert time.perf_counter() - began < 10


def test_secret_query_against_plain_scans(spark, docs, odd, tmp_path):
    rng = random.Random(22)
    texts = secret_texts(rng, 300)
    rows = [(i, t, "en", f"src{rng.randrange(30)}" if i % 3 else "hot") for i, t in enumerate(texts)] + [(400 + i, f"{KEY} {i}", "en", rng.choice(["a", "b"])) for i in range(21)]
    rows += [(1000 + k, t, None, [None, "", "s"][k % 3]) for k, (_, t) in enumerate(odd)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    owners = plain_owners([(i, o, t) for i, t, _, o in rows])
    want = {}
    for i, t, *_ in rows:
        found = plain_findings(t, owners)
        said = lambda spans: ",".join(f"{kind}:{a}:{b}" for a, b, kind, *_ in spans)
        base = [x for x in found if x[2] != "live"]
        want[i] = (*(sum(x[2] == kind for x in found) for kind in ("assign", "access", "hex")), hashlib.sha256(said(base).encode()).hexdigest(), said(found), ",".join(f"{r}/{o}" for *_, r, o in found), sum(x[3] for x in found), sum(not x[3] for x in found))
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op1_secret_ownership(spark, str(tmp_path)).collect()}
    assert got == want
    assert any(x[6] for x in want.values()) and any(x[7] for x in want.values())


def test_repositories_are_counted_once(docs):
    rows = [(1, KEY, "en", "a"), (1, KEY, "en", "b"), (2, KEY, "en", None), (3, KEY, "en", ""), (3, KEY, "en", "")]
    table = secrets.ownership(secrets.scan(docs(rows), "doc_id", "text", "doc_id", "source")).first()
    assert (table["n_repos"], table["n_owners"], table["n_rows"], table["live"]) == (3, 4, 5, False)


def test_secrets_of_odd_texts(docs, odd):
    got = secrets.find_secrets(docs(odd), "doc_id", "text", "doc_id", "source").collect()
    assert len(got) == len(odd)
    assert secrets.find_secrets(docs(odd).limit(0), "doc_id", "text", "doc_id", "source").collect() == []
    assert secrets.find_secrets(docs([(1, f"token={KEY}", None, None)]), "doc_id", "text", "doc_id", "source").first()["n_live"] == 1


def test_free_tokens_after_an_equals_sign():
    for name in ("auth", "AWS_SECRET_ACCESS_KEY", "A_LONGER_NAME_OF_A_SECRET_ACCESS_KEY"):
        text = f"{name}={KEY} x"
        assert secrets.base_spans(text) == []
        assert [text[a:b] for a, b, _, _ in secrets.free_spans(text, [])] == [KEY]


def test_mask():
    spans = [{"a": 2, "b": 5}, {"a": 4, "b": 6}, {"a": 8, "b": 9}]
    assert secrets.mask("0123456789", spans) == "01[SECRET]67[SECRET]9"


# -- language -----------------------------------------------------------------------------------------

EN = "the house of the river and the old bridge where they walked together in the evening light "
DE = "der alte mann und das kleine haus am fluss wo sie zusammen durch den wald gegangen sind "
FR = "la maison de la rivière et le vieux pont où ils marchaient ensemble dans la lumière du soir "


@pytest.fixture(scope="module")
def model(docs):
    rows = [(i, t * 20, lang, "s") for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (FR, "fr")])]
    return langmix.train(docs(rows), "text", "lang")


def test_mixtures(model):
    assert model.names == ["de", "en", "fr"]
    assert [x[0] for x in model.infer(EN * 3)] == ["en"]
    mixed = model.infer(EN * 20 + DE * 10)
    assert [x[0] for x in mixed] == ["en", "de"] and abs(mixed[0][1] - 2 / 3) < 0.08
    assert abs(sum(s for _, s in mixed) - 1) < 1e-6
    assert model.infer(None) == model.infer("12 !? \n") == model.infer("") == []


def plain_trigrams(text):
    """{bucket: count}, character by character."""
    out, m32 = {}, 2**32
    folded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    folded = " " + " ".join(folded.split()) + " "
    for x, y, z in zip(folded, folded[1:], folded[2:], strict=False):
        h = (ord(x) * 0x9E3779B1 % m32 ^ ord(y) * 0x85EBCA77 % m32 ^ ord(z) * 0xC2B2AE3D % m32) * 0x9E3779B1 % m32
        out[h >> 17] = out.get(h >> 17, 0) + 1
    return out


def plain_language(text, learned):
    """[(language, share)] by exhaustive search over all sets of languages; learned: language -> texts."""
    if not any(c.isalpha() for c in text or ""):
        return []
    counts = {}
    for name, texts in learned.items():
        counts[name] = {}
        for t in texts:
            for b, n in plain_trigrams(t).items():
                counts[name][b] = counts[name].get(b, 0) + n
    p = {name: (lambda b, c=c, total=sum(c.values()): (c.get(b, 0) + 0.1) / (total + 0.1 * 2**15)) for name, c in counts.items()}
    seen = plain_trigrams(text)
    total, best = sum(seen.values()), None
    for size in range(1, len(learned) + 1):
        for names in itertools.combinations(sorted(learned), size):
            share = dict.fromkeys(names, 1 / size)
            for _ in range(300 if size > 1 else 1):
                new = dict.fromkeys(names, 0.0)
                for b, n in seen.items():
                    mix = sum(share[x] * p[x](b) for x in names)
                    for x in names:
                        new[x] += n * share[x] * p[x](b) / mix / total
                share = new
            likelihood = sum(n * math.log(sum(share[x] * p[x](b) for x in names)) for b, n in seen.items())
            value = likelihood - (size - 1) * math.log(total + 1)
            if best is None or value > best[0]:
                best = value, share
    return sorted(best[1].items(), key=lambda x: (-x[1], x[0]))


def test_language_against_all_sets(spark, docs, tmp_path):
    rng = random.Random(17)
    tongues = {"en": EN, "de": DE, "fr": FR}
    said = lambda lang, n: " ".join(rng.choices(tongues[lang].split(), k=n))
    rows = [(i, said(lang, 120), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 6)]
    mixed = [("en", 40, "de", 40), ("fr", 60, "en", 20), ("de", 50, "fr", 5), ("en", 2, "en", 2), ("de", 90, "en", 1)]
    rows += [(100 + i, f"{said(a, n)} {said(b, m)}", None, "s") for i, (a, n, b, m) in enumerate(mixed)]
    rows += [(120, f"{said('en', 60)} {said('de', 60)} {said('fr', 60)}", None, "s"), (130, "½² ①", None, "s"), (131, None, "en", "s"), (132, "²x", None, "s"), (133, "", "zz", "s")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    learned = {}
    for i, t, lang, _ in rows:
        if t and lang and zlib.crc32(str(i).encode()) % 4 != 2:
            learned.setdefault(lang, []).append(t)
    got = {r["doc_id"]: r for r in queries.op7_language_mixture(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, *_ in rows}
    several = 0
    for i, t, *_ in rows:
        want, found = plain_language(t, learned), [(x["lang"], x["share"]) for x in got[i]["languages"]]
        assert [x for x, _ in found] == [x for x, _ in want], (i, want, found)
        assert all(abs(a - b) < 0.02 for (_, a), (_, b) in zip(want, found, strict=True))
        assert (got[i]["lang_pred"], got[i]["score"]) == ((found[0][0], found[0][1]) if found else ("und", 0))
        several += len(want) > 1
    assert several >= 4 and got[130]["lang_pred"] == "und"


def test_trigrams_character_by_character():
    for text in [EN, FR.upper(), "½² ①", "a", "x²y", "İstanbul ǅ ß", "日本語 中文", "", "a1b_c"]:
        counts = langmix.trigrams(text)
        assert {b: int(counts[b]) for b in np.flatnonzero(counts).tolist()} == (plain_trigrams(text) if any(c.isalpha() for c in text) else {})


def test_more_labels_than_a_model_holds(docs, monkeypatch):
    monkeypatch.setattr(langmix, "MAX_LANGUAGES", 2)
    rows = [(1, EN, "en", "s"), (2, DE * 2, "de", "s"), (3, FR * 3, "fr", "s")] * 2
    assert langmix.train(docs(rows), "text", "lang").names == ["de", "fr"]


def test_small_shares_and_later_languages(model, monkeypatch):
    found = model.infer(EN * 200 + DE * 3)
    assert [x[0] for x in found] == ["en", "de"] and found[1][1] < 0.03
    # a language that fails is tried before one that passes
    whole, first = model._em, iter([(np.array([0.3, 0.5, 0.2]), 0.0), (np.ones(2) / 2, -np.inf)])
    monkeypatch.setattr(model, "_em", lambda *args: next(first, None) or whole(*args))
    assert [x[0] for x in model.infer(EN * 20 + FR * 10)] == ["en", "fr"]


def test_long_texts_are_read_whole(model, monkeypatch):
    whole = langmix.trigrams(EN * 50)
    monkeypatch.setattr(langmix, "CHUNK", 100)
    assert abs(langmix.trigrams(EN * 50).sum() - whole.sum()) < 0.1 * whole.sum()


def test_language_of_odd_texts(docs, odd, model):
    got = langmix.predict(docs(odd), "doc_id", "text", model).collect()
    assert len(got) == len(odd)
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 5)} == dict.fromkeys((1, 2, 3, 5), "und")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langmix.keep(docs(odd), "text", model, 0.5).columns == docs(odd).columns
    nothing = langmix.train(docs([(1, "x", None, "s")]), "text", "lang")
    assert nothing.names == [] and langmix.predict(docs([(1, "abc")]), "doc_id", "text", nothing).first()["lang_pred"] == "und"


def test_held_out_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_language_mixture(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}


# -- SimHash ------------------------------------------------------------------------------------------

def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest key reachable, of {key: fingerprints}."""
    keys, root = sorted(prints), {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and any((x ^ y).bit_count() <= 3 for x in prints[a] for y in prints[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {k: find(k) for k in keys}


def near_texts(rng, n):
    rows, base = [], ["w%d" % rng.randint(0, 400) for _ in range(400)]
    for i in range(n):
        words = list(base) if rng.random() < 0.6 else ["v%d" % rng.randint(0, 9999) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = "x%d" % rng.randint(0, 9)
        rows.append((i * 3 % 101 + 1, " ".join(words)))
    return rows


def test_fingerprints():
    for text in [None, "", " ", "A b", "one two THREE four five", "é É", "a\x0bb\x1cc d"]:
        assert simhash.fingerprint(text) == plain_print(text)
    text = " ".join(f"w{i}" for i in range(3000))
    assert simhash.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("local", [0, 10_000])
def test_components_against_brute_force(docs, monkeypatch, local):
    monkeypatch.setattr(common.components, "__defaults__", (local,))
    rows = near_texts(random.Random(7), 90)
    prints = {}
    for i, t in rows:
        prints.setdefault(i, set()).add(plain_print(t))
    got = simhash.near_duplicates(docs(rows), "doc_id", "text").collect()
    want = plain_groups(prints)
    assert len(got) == len(rows) and {(r["doc_id"], r["component"]) for r in got} == set(want.items())


def test_simhash_of_odd_texts(docs, odd):
    got = simhash.near_duplicates(docs(odd), "doc_id", "text").collect()
    assert len(got) == len(odd)
    assert {r["component"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert [r["component"] for r in got if r["doc_id"] == 10] == [9, 9]
    kept = simhash.keep_one(docs(odd), "doc_id", "text")
    assert kept.columns == docs(odd).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 11]
    assert simhash.near_duplicates(docs(odd).limit(0), "doc_id", "text").collect() == []
    twice = docs([(1, "a b c d e f g"), (1, "a b c d e f g")])
    assert simhash.keep_one(twice, "doc_id", "text").count() == 1


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_one_row_of_each_group_stays(docs, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(40)]), t) for _, t in near_texts(rng, 80)] + [(None, "only here without a key at all")] * 5 + [(None, None), (50, "")] + [(60, "a text of sixty"), (60, "an other text of sixty"), (61, "a text of sixty")]
    texts = sorted({t or "" for _, t in rows})
    prints = {t: {plain_print(t)} for t in texts}
    by_text = plain_groups(prints)
    keys = {}
    for k, t in rows:
        if k is not None:
            keys.setdefault(k, []).append(t or "")
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in [*by_text.items(), *((one, two) for held in keys.values() for one in held for two in held)]:
        root[find(a)] = find(b)
    want = {}
    for k, t in rows:
        place = (k is None, k or 0)
        want[find(t or "")] = min(want.get(find(t or ""), place), place)
    got = simhash.keep_one(docs(rows), "doc_id", "text").collect()
    assert len(got) == len(want)
    assert {find(r["text"] or ""): (r["doc_id"] is None, r["doc_id"] or 0) for r in got} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(7)
    for local in (0, 10_000):
        got = common.components(edges, local).collect()
        assert len(got) == 299 and {r["component"] for r in got} == {1}
    assert common.components(edges.limit(0), 0).collect() == []


def test_sizes_of_broadcasts(spark):
    table = common.store(spark.range(1000).select("id", F.expr("repeat('x', 100)").alias("t")), "sized")
    assert common.small(table, 1 << 20) and not common.small(table, 100_000) and not common.small(table, 1000)
    assert common.small(common.store(table.limit(0), "none"), 0)


def test_limits_of_batches_are_lowered_only_from_defaults(spark):
    name, _, value = common.BATCH_LIMITS[0]
    common.bound_batches(spark)
    assert spark.conf.get(name) == value
    spark.conf.set(name, "1m")
    common.bound_batches(spark)
    assert spark.conf.get(name) == "1m"
    spark.conf.unset(name)


def test_stored_tables_are_cleared(spark):
    held = common.store(spark.range(3).toDF("x"), "held")
    assert held.count() == 3
    common.clear(spark)
    with pytest.raises(Exception, match="exist"):
        spark.read.parquet(held.inputFiles()[0]).count()


# -- decontamination ----------------------------------------------------------------------------------

def plain_hits(text, items):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(FOLD))
    hit, names = set(), set()
    for name, body in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (body or "").translate(FOLD))
        n = min(8, len(w))
        for j in range(len(w) - n + 1) if n else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[j : j + n]:
                    hit |= set(range(i, i + n))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


def follows(words, at, window, slop):
    """Do the window's words stand behind ``at`` in order, the first there, with at most ``slop`` others between?"""
    if words[at] != window[0]:
        return False
    if len(window) == 1:
        return True
    return any(follows(words, at + 1 + skip, window[1:], slop - skip) for skip in range(slop + 1) if at + 1 + skip < len(words))


def plain_near(text, items, slop):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(FOLD))
    found = set()
    for name, body in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (body or "").translate(FOLD))
        n = min(8, len(w))
        if any(follows(words, i, w[j : j + n], slop) for j in range(len(w) - n + 1) for i in range(len(words)) if n):
            found.add(str(name))
    return sorted(found)


def test_windows_against_brute_force(docs, spark, odd, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices("abcdef", k=rng.randint(0, 14)))) for i in range(25)] + [(30, None), (31, "Zed-zed ZED"), (None, "a b c"), (3, "extra words for a repeated item id here now")]
    rows = [(i, ", ".join(rng.choices("abcdeF", k=rng.randint(0, 200)))) for i in range(40)] + [(50, "zed zed Zed zed"), (51, "x Extra words; for a repeated item id here now!"), (51, "zed zed one zed")] + [(i and 100 + i, t) for i, t in odd]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("t", F.lit("x"))
    used = [(i, t) for i, t in items if i is not None]
    want = sorted((i or 0, *plain_hits(t, used), plain_near(t, used, 2)) for i, t in rows)

    def check():
        got = positional.contamination(docs(rows), "doc_id", "text", bench, "item_id", "text").collect()
        assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], list(r["items"]), list(r["near"])) for r in got) == want
        for r in got:
            assert r["items_sha256"] == hashlib.sha256(",".join(r["items"]).encode()).hexdigest() and r["contaminated"] == (len(r["items"]) >= 2)
            assert sum(s["b"] - s["a"] for s in r["spans"]) == r["n_hit"]

    monkeypatch.setattr(positional, "SHARD_DOCS", 5)
    check()
    monkeypatch.setattr(positional, "CANDIDATES", 7)
    monkeypatch.setattr(positional, "PIECE_BYTES", 11)
    check()
    monkeypatch.setattr(positional, "BLOCK_WORDS", 10)
    check()
    monkeypatch.setattr(positional, "BLOCK_WORDS", 3)  # items are cut into pieces
    check()
    empty = positional.contamination(docs(rows), "doc_id", "text", bench.limit(0), "item_id", "text").collect()
    assert len(empty) == len(rows) and not any(r["n_hit"] for r in empty)
    assert positional.contamination(docs(rows).limit(0), "doc_id", "text", bench, "item_id", "text").collect() == []


def test_proximity(docs):
    index = positional.build_index(docs([(1, "alpha x beta gamma"), (2, "alpha x y z beta gamma"), (3, "gamma beta alpha"), (4, "alpha"), (5, "beta gamma"), (6, "a b x"), (7, "c d"), (8, "a b x c")], 1), "doc_id", "text")
    ask = lambda text, slop: sorted(r["doc_id"] for r in positional.proximity(index, "doc_id", positional.Windows([("q", positional.words_of(text))]), slop).collect())
    assert [ask("alpha beta gamma", slop) for slop in (0, 1, 3)] == [[], [1], [1, 2]]
    assert (ask("a b c", 2), ask("a b c", 0), ask("c d", 0)) == ([8], [], [7])  # not across documents


def test_large_test_sets_stay_within_blocks(spark):
    rng = random.Random(3)
    items = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(4000))) for i in range(130)], "i long, t string")
    sizes = [sum(len(w) for _, w in block) for block in positional.blocks_of(items, "i", "t")]
    assert len(sizes) == 3 and max(sizes) <= positional.BLOCK_WORDS + 51 * positional.WINDOW


def test_cut():
    assert positional.cut("Aé, b-c d!", {"n_words": 4, "spans": [{"a": 1, "b": 3}]}) == "Aé,  d!"
    assert positional.cut("a b", {"n_words": 3, "spans": [{"a": 0, "b": 1}]}) == "a b"


# -- paragraphs ---------------------------------------------------------------------------------------

def words(rng, n):
    return " ".join("w%d" % rng.randint(0, 5000) for _ in range(n))


def test_repeated_passages(docs, odd):
    rng = random.Random(11)
    passage = words(rng, 60)
    rows = [(i, f"{words(rng, 40)} {passage} {words(rng, 30)}") for i in (20, 21, 22)]
    line = words(rng, 80).split()
    near = list(line)
    near[40] = "changed"
    far = [w if i % 4 else "other" for i, w in enumerate(line)]
    rows += [(30, " ".join(line)), (31, f"intro\n{' '.join(near)}\nend"), (32, " ".join(far))]
    rows += [(40, f"{words(rng, 30)}\nshort common line\n"), (41, f"{words(rng, 30)}\nshort common line\n"), (42, "the " * 300), (43, "x\n" + "the " * 300)]
    inner = words(rng, 40)
    rows += [(44, f"{inner}\n{inner}")]
    rows += [(i and 100 + i, t) for i, t in odd if i != 8] + [(108, "x" * 300_000)]
    got = {r["doc_id"]: r for r in paragraphs.repeated(docs(rows), "doc_id", "text").collect()}
    assert set(got) >= {20, 21, 22, 30, 31} and not set(got) & {32, 40, 41, 44}
    assert [got[i]["class_doc"] for i in (20, 21, 22, 30, 31)] == [20, 20, 20, 30, 30]
    assert got[20]["n_removed"] == got[30]["n_removed"] == 0
    for i in (21, 22):
        text = dict(rows)[i].split()
        (cut,) = [" ".join(text[s["a"] : s["b"]]) for s in got[i]["removed"]]
        assert cut in passage and len(cut.split()) >= 50
    assert [(s["a"], s["b"]) for s in got[31]["removed"]] == [(1, 81)]
    assert paragraphs.repeated(docs(rows).limit(0), "doc_id", "text").collect() == []


def test_near_paragraphs_against_brute_force(docs, monkeypatch):
    rng = random.Random(12)
    texts = []
    for _ in range(12):
        base = words(rng, 60).split()
        for _ in range(rng.randint(1, 8)):
            new = list(base)
            for _ in range(rng.randint(0, 4)):
                new[rng.randrange(60)] = "e%d" % rng.randint(0, 99)
            texts.append(new)
    rng.shuffle(texts)
    sets = [{tuple(t[i : i + 5]) for i in range(56)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    df = docs([(i, " ".join(t)) for i, t in enumerate(texts)])
    found = paragraphs.units(df, "doc_id", "text")
    seen = common.store(found.filter("false").select("hash"), "none")  # near copies alone, without the equal ones
    equal = common.store(found.groupBy("hash").agg(F.count_distinct("doc").alias("n")).filter("n > 1").select("hash"), "seen")
    sizes = [sum(find(j) == find(i) for j in range(len(texts))) for i in range(len(texts))]
    for table in (seen, equal):
        for limit in (0, 1 << 25):
            monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
            lines = found.filter("bands is not null")
            members, wanted = paragraphs.line_members(lines)
            ends = paragraphs.run_ends(found, table)[1]
            sets = paragraphs.fetched(df, "doc_id", "text", wanted, ends).filter("hash is not null").dropDuplicates(["hash"])
            got = {r["doc"]: r["keeper_doc"] for r in paragraphs.paragraph_hits(lines, paragraphs.near_groups(members, sets), table).collect()}
            want = {i: find(i) for i in range(len(texts)) if sizes[i] > 1}
            assert got == want if table is equal else set(got.items()) <= set(want.items())


def test_bitmaps_lose_no_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(2000):
        n = int(rng.integers(1, 400))
        one = np.unique(rng.integers(0, 2**62, n))
        two = np.unique(np.concatenate([one[int(rng.integers(0, 1 + n // 9)) :], rng.integers(0, 2**62, int(rng.integers(0, 1 + n // 9)))]))
        both = len(np.intersect1d(one, two))
        if both >= 0.8 * (len(one) + len(two) - both):
            differ = sum((a ^ b).bit_count() if (a ^ b) >= 0 else ((a ^ b) + (1 << 64)).bit_count() for a, b in zip(paragraphs.bitmap(one), paragraphs.bitmap(two), strict=True))
            assert differ * 1.8 <= 0.2 * (len(one) + len(two)) + 1e-9


def plain_passages(texts, width):
    """{document: (class, set of words that stand in a run of ``width`` words that some other document has)}."""
    held, split = {}, {i: (t or "").lower().split() for i, t in texts.items()}
    for i, w in split.items():
        for at in range(len(w) - width + 1):
            held.setdefault(tuple(w[at : at + width]), set()).add(i)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    covered = {i: set() for i in texts}
    for run, docs_ in held.items():
        if len(docs_) > 1:
            for i in docs_:
                x, y = sorted((find(i), find(min(docs_))))
                root[y] = x
    for i, w in split.items():
        for at in range(len(w) - width + 1):
            if len(held[tuple(w[at : at + width])]) > 1:
                covered[i] |= set(range(at, at + width))
    return {i: (find(i), covered[i]) for i in texts}


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_passages_against_all_runs(docs, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(41)
    pool = [words(rng, n) for n in (49, 50, 51, 60, 85, 120, 300)]
    texts = {}
    for i in range(60):
        parts = [words(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(pool).split()
            a = rng.randint(0, max(0, len(p) - 50)) if rng.random() < 0.5 else 0
            parts += [" ".join(p[a : a + rng.randint(45, 400)]), words(rng, rng.choice([0, 1, 30]))]
        texts[i] = " ".join(parts)
    texts |= {70: texts[5], 71: texts[5], 72: "x " * 500, 73: "x " * 300, 74: " ".join(texts[6].split()[10:]), 75: None}
    df = docs(list(texts.items()))
    found = paragraphs.units(df, "doc_id", "text")
    seen = common.store(found.groupBy("hash").agg(F.count_distinct("doc").alias("n")).filter("n > 1").select("hash"), "seen")
    want = plain_passages(texts, 50)
    got = {i: set() for i in texts}
    known, ends = paragraphs.run_ends(found, seen)
    told = paragraphs.fetched(df, "doc_id", "text", found.filter("false").select("hash", "doc", "start", "n"), ends)
    for r in paragraphs.passage_hits(known.union(told.select("doc", "at", "w"))).collect():
        got[r["doc"]] |= set(range(r["start"], r["start"] + r["n"]))
    constant = (72, 73)  # one word over and over: found, its inside is not listed
    assert all(got[i] for i in constant)
    for i, (_, run) in want.items():
        if i not in constant:  # all but some words at the ends of a run
            assert got[i] <= run and bool(got[i]) == bool(run)
            inner = {w for w in run if {w - 8, w + 8} <= run}
            assert len(inner - got[i]) <= 16
    classes = {r["doc_id"]: r for r in paragraphs.classes(df, "doc_id", "text").collect()}
    for i, (c, s) in want.items():
        if i not in constant:
            assert classes[i]["n_links"] > 0 or not s
            assert c in (classes[i]["class_doc"], classes[classes[i]["class_doc"]]["class_doc"]) or classes[i]["class_doc"] < c


def plain_links(texts, width):
    """{document: (class, places of the keepers of its passages, words to remove)} by all windows of ``width`` words."""
    held, split = {}, {i: (t or "").lower().split() for i, t in texts.items()}
    for i, w in sorted(split.items()):
        for at in range(len(w) - width + 1):
            held.setdefault(tuple(w[at : at + width]), []).append((i, at))
    class_of = {i: i for i in texts}
    links, removed = {i: set() for i in texts}, {i: set() for i in texts}
    shared = [places for places in held.values() if places[0][0] != places[-1][0]]
    for places in shared * len(texts):
        low = min(class_of[i] for i, _ in places)
        if all(class_of[i] == low for i, _ in places):
            continue
        class_of |= {i: low for i, _ in places}
    at_way = {}
    for places in shared:
        keeper, start = places[0]
        for i, at in places:
            at_way.setdefault((i, keeper, start - at), []).append(at)
    for (i, keeper, way), found in at_way.items():
        found.sort()
        for n, at in enumerate(found):
            if n == 0 or at - found[n - 1] > width:
                links[i].add((keeper, at + way))
                passage = at
            if (keeper, passage + way) != (i, passage):
                removed[i] |= set(range(at, at + width))
    return {i: (class_of[i], links[i], removed[i]) for i in texts}


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_every_window_of_every_text_counts(docs, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(43)
    pool = [words(rng, n).split() for n in (20, 30, 49, 50, 51, 55, 60, 73, 74, 75, 90, 140)]
    texts = {}
    for i in range(80):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += rng.choice([p, p[:b], p[a:], p[a:b]]) + words(rng, rng.choice([0, 1, 3, 30])).split()
        texts[i] = " ".join(parts)
    texts |= {90: f"{texts[7]} {texts[7]}", 91: texts[7], 92: "x " * 130 + "y z", 93: "a b " * 70, 94: "y " + "x " * 90 + "z", 95: "b a " * 40}
    # two texts whose one common run has surroundings that further texts have, each on one side
    one, two, left, right = (words(rng, 40) for _ in range(4))
    run = words(rng, 52).split()
    texts |= {100: " ".join([one, *run, left]), 101: " ".join([two, *run, right]), 102: " ".join([one, *run[:45]]), 103: " ".join([*run[7:], left]), 104: " ".join([two, *run[:45]]), 105: " ".join([*run[7:], right])}
    # in lines of four words, which are no paragraphs
    texts = {i: re.sub(r"(\S+ \S+ \S+ \S+) ", r"\1\n", t) for i, t in texts.items()}
    got = {}
    for r in paragraphs.classes(docs(list(texts.items())), "doc_id", "text").collect():
        removed = {w for s in r["removed"] for w in range(s["a"], s["b"])}
        got[r["doc_id"]] = r["class_doc"], {tuple(x) for x in r["links"]}, removed
    assert got == plain_links(texts, 50)


def test_short_lines_are_told_apart(docs):
    rng = random.Random(13)
    rows, want = [], {}
    for n in range(5, 26):
        line = words(rng, n)
        near = f"{line.rsplit(' ', 1)[0]} changed" if n == 25 else line
        rows += [(10 * n, f"{words(rng, 30)}\n{line}"), (10 * n + 1, f"{near}\n{words(rng, 30)}")]
        want |= {10 * n: [(30, 30 + n)], 10 * n + 1: [(0, n)]}
    four = words(rng, 4)
    rows += [(1, f"{words(rng, 30)}\n{four}"), (2, four)]
    got = {r["doc_id"]: r for r in paragraphs.classes(docs(rows), "doc_id", "text").collect()}
    assert {i: [(s["a"], s["b"]) for s in r["short"]] for i, r in got.items()} == {1: [], 2: []} | want
    assert all(r["class_doc"] == i and r["n_links"] == r["n_removed"] == 0 for i, r in got.items())
    assert {r["short_links"][0]["keeper_doc"] for i, r in got.items() if i > 2} == {10 * n for n in range(5, 26)}


def test_every_document_has_its_class_and_all_links(docs):
    rng = random.Random(14)
    p, q, r = (words(rng, 50) for _ in range(3))
    rows = [(5, p), (7, f"{p}\n{q}"), (9, f"{q}\n{r}"), (11, r), (13, words(rng, 30)), (14, None), (None, p)]
    got = {x["doc_id"]: x for x in paragraphs.classes(docs(rows), "doc_id", "text").collect()}
    assert {i: x["class_doc"] for i, x in got.items()} == {5: 5, 7: 5, 9: 5, 11: 5, 13: 13, 14: 14}
    links = {i: {tuple(k) for k in x["links"]} for i, x in got.items()}
    assert {i: {d for d, _ in k} for i, k in links.items()} == {5: {5}, 7: {5, 7}, 9: {7, 9}, 11: {9}, 13: set(), 14: set()}
    assert links[5] < links[7] and links[11] < links[9] and links[7] & links[9] and all(x["n_links"] == len(links[i]) for i, x in got.items())


def test_runs_have_one_hash_anywhere():
    a, b = paragraphs.Hasher(), paragraphs.Hasher()
    a.load([b"x", b"y", b"z"])
    b.load([b"q"] * 2000 + [b"x", b"y", b"z"])
    one, two = (h.runs(np.array([i]), np.array([i + 3]), 1)[0] for h, i in ((a, 0), (b, 2000)))
    assert one == two


# -- toxicity -----------------------------------------------------------------------------------------

SPOKEN = "the idiot saw a stupid clown and the loser went to the trash you are an idiot it is a stupid loser "


@pytest.fixture(scope="module")
def channel(docs):
    return toxicity.train_channel(docs([(i, SPOKEN * 5) for i in range(4)]), "text")


def test_decoding(channel):
    for written, meant in {"1d10t": "idiot", "s.t.u.p.i.d": "stupid", "l o s e r": "loser", "clooown": "clown", "tra$h": "trash", "!d!ot": "idiot", "id-iot": "idiot", "st_up_id": "stupid", "id iot": "idiot", "lo ser": "loser"}.items():
        assert meant in channel.restored(f"you are {written} now"), written
    assert {"you", "idiot"} <= channel.restored("so y o u i d i o t !")
    assert {"a", "stupid"} <= toxicity.words_of("it is a s t u p i d thing", channel)
    assert channel.restored("the loser, 12 of them. 3 x 4") == set()
    assert channel.restored("a" * 100_000) == {"a"}
    long = "l-o-s-e-r-" * 300 + "1d10t"
    assert "idiot" in channel.decode(long, 0.0) and channel.decode(long, 0.0).count("loser") == 300


def paths(channel, signs, drop):
    """(log probability, text) of every path through the lattice, one by one."""
    blank = toxicity.BLANK

    def go(i, context, score, text):
        if i == len(signs):
            yield (score if context[1] == blank else score + channel.logp[context[0]][context[1]][blank]), text.strip()
            return
        sign = signs[i]
        options = [(sign, 0.0)] if sign.isalpha() else [*((c, -1.0) for c in toxicity.LEET.get(sign, "")), (" ", -6.0)] if sign in toxicity.LEET else [(" ", 0.0), ("", drop)]
        if i and signs[i - 1] == sign and (sign.isalpha() or sign in toxicity.LEET):
            options.append(("", -1.5))
        for ch, cost in options:
            if ch == "" or ch == " " and context[1] == blank:
                yield from go(i + 1, context, score + cost, text)
            else:
                code = blank if ch == " " else ord(ch) - 97 if "a" <= ch <= "z" else toxicity.OTHER
                yield from go(i + 1, (context[1], code), score + cost + channel.logp[context[0]][context[1]][code], text + ch)

    return list(go(0, (blank, blank), 0.0, ""))


def test_decoder_against_all_paths(channel, monkeypatch):
    rng = random.Random(31)
    for _ in range(600):
        signs = "".join(rng.choices("idostu1!0$ -.é", k=rng.randint(1, 9)))
        for drop in (0.0, -4.0):
            score, text = channel.best(signs, drop)
            found = paths(channel, signs, drop)
            assert abs(score - max(s for s, _ in found)) < 1e-9
            assert any(abs(s - score) < 1e-9 and t == text for s, t in found), (signs, text)


def test_blanks_of_plain_words_are_decided_as_in_the_lattice(channel):
    rng = random.Random(32)
    for _ in range(300):
        tokens = [w for w in ("".join(rng.choices("idostuer", k=rng.randint(2, 4))) for _ in range(rng.randint(2, 4))) if not toxicity.TRIPLE.search(w)]
        if any(x == y for w in tokens for x, y in zip(w, w[1:], strict=False)) or any(x[-1] == y[0] for x, y in zip(tokens, tokens[1:], strict=False)):
            continue
        whole = channel.best(" ".join(tokens))[1].split()
        assert set(channel.joined(tokens)) == set(whole) - set(tokens) | {w for w in whole if w in tokens and w in set(channel.joined(tokens))}


def test_pieces_of_long_words(channel, monkeypatch):
    whole = channel.best("l0ser" * 50)[1]
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert channel.best("l0ser" * 50)[1].replace(" ", "") == whole.replace(" ", "")


def test_long_tokens_take_linear_time():
    channel = toxicity.Channel(np.zeros(toxicity.CLASSES**3))
    began = time.perf_counter()
    for token in ["ab1$" * 50_000, "$" * 200_000, "!" * 200_000 + "x", "abcdefgh" * 30_000, "a.b-" * 50_000 + "zz", "1" * 200_000, "ab" * 100_000 + "$", "._" * 100_000]:
        channel.words_of_token(token)
        list(channel.spaced(list(token[:50_000])))
    assert time.perf_counter() - began < 30


def test_toxicity(docs, spark, odd):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice("alpha beta gamma delta epsilon zeta idea lost".split()) for _ in range(30)]
        if i % 5 == 0:
            text[rng.randrange(30)] = "idiot"
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    labels += [(1, None), (None, 1), (2, 7), (3, 0)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    scorer = toxicity.train(docs(rows), "doc_id", "text", table, "doc_id", "toxic")
    asked = [(1, "an idiot he is"), (2, "an 1d10t he is"), (3, "alpha beta"), *[(i and 100 + i, t) for i, t in odd]]
    got = {}
    for r in toxicity.predict(docs(asked), "doc_id", "text", scorer).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert got[1][0] > 0.8 and got[2][0] > 0.8 and got[3][0] < 0.2
    assert sum(map(len, got.values())) == len(asked) and len(set(got[110])) == 1
    assert got[101] == got[102]
    assert toxicity.predict(docs(rows).limit(0), "doc_id", "text", scorer).collect() == []
    none = toxicity.train(docs(rows), "doc_id", "text", table.limit(0), "doc_id", "toxic")
    assert toxicity.predict(docs([(1, "x")]), "doc_id", "text", none).first()["score"] == none.prior


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity_deobfuscated(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught = sum(r["predicted"] and r["toxic"] for r in got)
    assert caught / sum(r["toxic"] for r in got) > 0.85 and caught / sum(r["predicted"] for r in got) > 0.85
