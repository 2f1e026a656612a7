"""The registered queries of the training-data operators and their SQL.

Each takes (spark, sf_dir), applies one operator with production parameters to the whole table, and
returns the columns of its contract.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import bpe, langmix, mainblock, paragraphs, positional, secrets, simhash, toxicity, transport, warc

#: Path of the vocabulary; another file of the same format can be named here.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document is a repository of its own and its source is the owner."""
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"), "doc_id", "text", "doc_id", "source")
    base = F.filter("findings", lambda x: x["kind"] != "live")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["a"], x["b"])), ",")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("findings")).alias("spans"),
        F.array_join(F.transform("findings", lambda x: F.concat_ws("/", x["n_repos"], x["n_owners"])), ",").alias("repos_owners"),
        "n_live",
        "n_examples",
    )


def op2_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through a stream, with the time stamps and random-access points read back."""
    media = transport.write_streams(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return transport.read_streams(media, "doc_id").drop("continuity_errors")


def op3_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class, the links to its repeated paragraphs and passages, the word ranges to remove, and short repeats."""
    return paragraphs.classes(_read(spark, sf_dir, "documents"), "doc_id", "text")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"), "doc_id", "text", VOCABULARY, public_tokenizers.PATTERN)


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_read(spark, sf_dir, "pages"), "page_id", "url", "html")


def op6_toxicity_deobfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scorer = toxicity.train(docs, "doc_id", "text", _read(spark, sf_dir, "labels"), "doc_id", "toxic")
    found = toxicity.predict(docs, "doc_id", "text", scorer)
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langmix.identify(_read(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return found.select("doc_id", langmix.held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op9_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(_read(spark, sf_dir, "documents"), "doc_id", "text", _read(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", F.size("near").cast("long").alias("n_near"))


def op10_main_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainblock.extract(_read(spark, sf_dir, "pages"), "page_id", "url", "html")


QUERIES = {f.__name__: f for f in (op1_secret_ownership, op2_transport_streams, op3_paragraph_minhash, op4_byte_bpe, op5_warc_index, op6_toxicity_deobfuscated, op7_language_mixture, op8_simhash, op9_positional_decontamination, op10_main_block)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"
#: The offsets at which the n words of a window may stand with at most two others between.
_GAPS = [(n, [0, *(k + sum(g <= k for g in gaps) for k in range(1, n))]) for n in range(1, 9) for slop in range(3) for gaps in combinations_with_replacement(range(1, n), slop)]
_BITS = "array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', sha[i]) - 1), 4, '0')), '')"
_BASE32 = "array_to_string(list_transform(range(0, 32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST('0b' || bits[5 * k + 1:5 * k + 5] AS INTEGER)]), '')"
_PLAIN = "x"
for _name, _sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _PLAIN = f"replace({_PLAIN}, '&{_name};', '{_sign}')"
_PLAIN = f"trim(regexp_replace({_PLAIN}, '\\s+', ' ', 'g'))"

#: SQL for what SQL can say; the other operators are tested against brute force, round trips or held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op5_warc_index": f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS sha FROM pages),
b AS (SELECT *, {_BITS} AS bits, max(page_id) OVER (PARTITION BY sha) AS keeper FROM p)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM b""",
    "op9_positional_decontamination": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 8) AS n, array_to_string(w[i:i + least(len(w), 8) - 1], ' ') AS win FROM b, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 7) + 1)) AS i) g WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM bw) s, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) g),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM m, LATERAL (SELECT unnest(range(i, i + n)) AS k) g GROUP BY 1),
g AS (SELECT * FROM (VALUES {", ".join(f"({n}, {at}::INTEGER[])" for n, at in _GAPS)}) v(n, o) WHERE n IN (SELECT n FROM bw)),
nw AS (SELECT doc_id, n, array_to_string(list_transform(o, lambda x: w[i + x]), ' ') AS win FROM d, g, LATERAL (SELECT unnest(range(1, len(w) - o[-1] + 1)) AS i) k),
q AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM nw JOIN bw USING (n, win) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, coalesce(n_near, 0) AS n_near FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN q USING (doc_id)""",
    # the generated pages have one article each, of h1, p, b and br elements and four character references
    "op10_main_block": f"""WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1), '</?b>', '', 'g'), '</?(?:h1|p|br)>') AS l FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(l, lambda x: {_PLAIN}), lambda x: x <> ''), chr(10)) AS text FROM a)
SELECT *, length(text) AS n_chars FROM t""",
}
