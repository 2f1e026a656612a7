"""Transport streams and byte-level BPE."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from inkmill.llm import bpe, queries, transport

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("n", [0, 1, 64, 161, 162, 163, 169, 170, 171, 183, 184, 185, 8191, 8192, 8193, 70_000])
def test_streams_round_trip(n):
    payload = os.urandom(n)
    data = transport.mux(payload)
    found = transport.demux(data)
    assert found.payload == payload and len(data) % 188 == 0
    assert (found.continuity_errors, found.bad_sections) == (0, 0)
    assert found.programs == {1: [(0x100, 6)]}
    assert found.stamps == [i * transport.CLOCK for i in range(max(1, -(-n // transport.UNIT)))]
    assert found.random_access == list(range(0, len(found.stamps), transport.RAP_EVERY))


def test_damaged_streams():
    data = transport.mux(os.urandom(50_000))
    assert transport.demux(data[: 188 * 40] + data[188 * 41 :]).continuity_errors > 0
    broken = bytearray(data)
    broken[12] ^= 1  # in the first program table
    assert transport.demux(bytes(broken)).bad_sections == 1
    broken[188] = 0
    with pytest.raises(ValueError):
        transport.demux(bytes(broken))
    with pytest.raises(ValueError):
        transport.demux(data[:100])
    assert transport.section_crc(b"123456789") == 0x0376E6E7


def packet(pid, counter, body, start=False, adaptation=None):
    """A transport packet made by hand; adaptation: bytes behind the length of the field."""
    extra = b"" if adaptation is None else bytes([len(adaptation)]) + adaptation
    lack = 184 - len(extra) - len(body)
    if lack and not start and adaptation is None and pid == 0x21:  # elementary data is filled by adaptation
        extra = bytes([lack - 1]) + (b"\0" + b"\xff" * (lack - 2) if lack > 1 else b"")
        lack = 0
    control = 0x10 * bool(body) | 0x20 * bool(extra)
    return bytes([0x47, 0x40 * start | pid >> 8, pid & 255, control | counter & 15]) + extra + body + b"\xff" * lack


def section(table, ext, body):
    head = bytes([table, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 255, ext >> 8, ext & 255, 0xC1, 0, 0])
    return head + body + transport.section_crc(head + body).to_bytes(4, "big")


def spread(pid, data, counter=0):
    """A section in as many packets as it takes."""
    data = b"\0" + data
    return [packet(pid, counter + i, data[at : at + 184], start=not at) for i, at in enumerate(range(0, len(data), 184))]


def elementary(counter, pes, adaptation=None):
    head = packet(0x21, counter, pes[: 184 - (0 if adaptation is None else 1 + len(adaptation))], True, adaptation)
    rest = pes[184 - (0 if adaptation is None else 1 + len(adaptation)) :]
    return [head] + [packet(0x21, counter + 1 + i, rest[at : at + 184]) for i, at in enumerate(range(0, len(rest), 184))]


def test_streams_made_by_others():
    pat = section(0, 1, b"\0\0\xe0\x10" + b"".join(bytes([n >> 8, n & 255, 0xE1, n & 255]) for n in range(1, 60)))  # program 0: network
    pmt = section(2, 1, b"\xe0\x21\xf1\x2c" + b"\x05" * 300 + b"\x1b\xe0\x21\xf0\x02zz")
    tables = spread(0, pat) + spread(0x101, pmt)
    assert len(spread(0, pat)) == 2 and len(spread(0x101, pmt)) == 2
    data = bytes(range(256)) * 3
    stamped = b"\0\0\1\xe0\0\0\x80\x80\x05" + transport._stamp(2, 2**33 - 5) + data  # no length given
    plain = b"\0\0\1\xe0" + (3 + len(data)).to_bytes(2, "big") + b"\x80\0\0" + data  # without a stamp
    one, two = elementary(0, stamped, b"\x40" + b"\xff" * 9), elementary(5, plain)
    found = transport.demux(b"".join(tables + one + two))
    assert found.programs == {1: [(0x21, 0x1B)]} and (found.bad_sections, found.continuity_errors) == (0, 0)
    assert found.stamps == [2**33 - 5, None] and found.random_access == [0]
    assert found.payload[: len(data)] == data and data in found.payload[len(data) :]
    twice = transport.demux(b"".join(tables + [p for p in one for _ in range(2)] + two))
    assert twice.payload == found.payload and twice.continuity_errors == 0
    assert transport.demux(b"".join(tables + one + elementary(9, plain))).continuity_errors == 1
    assert transport.demux(b"".join(tables + one + elementary(9, plain, b"\x80"))).continuity_errors == 0
    cut = transport.demux(b"".join(spread(0, pat)[:1] + spread(0, pat)[:1] + tables + one))
    assert cut.programs == found.programs
    padding = b"\0\0\1\xbe\0\x04\xff\xff\xff\xff"
    assert len(transport.demux(b"".join(tables + elementary(0, padding) + one)).stamps) == 1
    lone = transport.demux(b"".join([packet(0x21, 0, b"", adaptation=b"\0" + b"\xff" * 182)] + tables + one))
    assert lone.stamps == [2**33 - 5]


def test_stored_stamps_and_points(spark, docs, tmp_path):
    rows = [(1, "x" * 100_000), (2, ""), (3, None)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op2_transport_streams(spark, str(tmp_path)).collect()}
    assert got[1]["stamps"] == [3003 * i for i in range(13)] and got[1]["random_access"] == [0, 8]
    assert got[2]["stamps"] == got[3]["stamps"] == [0] and got[2]["media_sha256"] == got[3]["media_sha256"]


def test_streams_of_a_table(docs, odd, spark):
    got = transport.read_streams(transport.write_streams(docs(odd), "doc_id", "text"), "doc_id").collect()
    want = []
    for i, t in odd:
        raw = (t or "").encode()
        full = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        want.append((i or 0, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])))
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == sorted(want)
    same = [r for r in got if r["doc_id"] in (9, 10)]
    assert len({(r["media_sha256"], r["feature"]) for r in same}) == 1 and len(same) == 3
    assert transport.read_streams(transport.write_streams(docs([(1, "x")]).limit(0), "doc_id", "text"), "doc_id").collect() == []


@pytest.fixture(scope="module")
def both():
    codec = bpe.codec(PATH, public_tokenizers.PATTERN)
    return codec, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_bpe_equals_merging(both):
    codec, reference = both
    rng = random.Random(4)
    signs = "aaabcdeéñ中文日本 \n\t12.,!'s  THEthe🙂́\x1c\x85 ſİ"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 80))) for _ in range(3000)] + ["", "the" * 9000, "a" * 50_000, "=" * 20_000, "é" * 20_000]
    for text in texts:
        assert codec.encode(text) == reference.encode_ordinary(text)
        assert codec.decode(codec.encode_bytes(text)).decode() == text


def test_bpe_of_a_table(docs, odd, both, spark):
    want = []
    for i, t in odd:
        ids = np.array(both[1].encode_ordinary(t or ""), "<u4")
        want.append((i or 0, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.round_trip(docs(odd), "doc_id", "text", PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r[0] or 0, *r[1:]) for r in got) == sorted(want)
    kept = bpe.round_trip(docs([(1, "a b")]), "doc_id", "text", PATH, public_tokenizers.PATTERN, keep=True).first()
    assert kept["decoded"] == "a b" and bpe.encode_texts(docs([(1, "a b")]), "doc_id", "text", PATH, public_tokenizers.PATTERN).first()["ids"] == kept["ids"]
    assert bpe.round_trip(docs(odd).limit(0), "doc_id", "text", PATH, public_tokenizers.PATTERN).collect() == []


def test_memos_stay_bounded(monkeypatch, both):
    monkeypatch.setattr(bpe, "PIECES", 10)
    monkeypatch.setattr(bpe, "PAIRS", 10)
    codec = bpe.Codec(both[0].ranks, public_tokenizers.PATTERN)
    text = " ".join(f"qzx{i}vv" for i in range(200))
    assert codec.encode(text) == both[1].encode_ordinary(text)
    assert len(codec.pieces) <= 10 and len(codec.pairs) <= 10
