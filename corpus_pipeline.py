"""From raw documents to token ids.

STAGES in order: language identification drops documents without a recognisable main language; SimHash
keeps one document of each group of near copies; decontamination drops documents that hold windows of two
or more benchmark items and cuts the passage of a single item out; the secret scan masks live-looking
secrets and leaves copied examples; byte-level BPE encodes what is left and proves that it decodes.

Every stage takes (spark, docs, sf_dir) and works on all rows that it gets; all but the last return the
columns of their input, with ``n_chars`` (code points) renewed where a text was changed.

Defined cases, in every stage: decisions belong to whole texts and are joined by their digests, so rows
without doc_id and rows that repeat one are treated like any other; null, empty and letterless texts have no
language and go in the first stage, a later stage that is used by itself leaves them as they are; rows that
repeat both doc_id and text leave one in the second stage; very long texts are read whole; further columns stay,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import bpe, langmix, positional, secrets, simhash
from inkmill.llm.common import digest, drop, edit_texts, store, stored

#: A document stays if its main language has this share of it.
MAIN_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose main language, learned from the labels that are not held out, has MAIN_SHARE of the text."""
    model = langmix.train(docs.filter(~langmix.held_out("doc_id")), "text", "lang")
    return langmix.keep(docs, "text", model, MAIN_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id; rows without one come last."""
    return simhash.keep_one(docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without windows of two or more benchmark items; the passage of a single item is cut out."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(digest("text").alias("digest"), "text")
    found = positional.contamination(keyed, "digest", "text", items, "item_id", "text", slop=0)
    hits = found.filter("n_items > 0").select("digest", F.struct("contaminated", "n_words", "spans").alias("hit"))
    return edit_texts(docs, "text", store(hits.dropDuplicates(["digest"]), "hits"), positional.clean, length="n_chars")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with live-looking secrets masked; copied examples stay."""
    keyed = docs.select(digest("text").alias("digest"), "text", "doc_id", "source")
    found = secrets.find_secrets(keyed, "digest", "text", "doc_id", "source")
    hits = found.filter("n_live > 0").select("digest", F.filter("findings", lambda x: x["live"]).alias("hit"))
    return edit_texts(docs, "text", store(hits.dropDuplicates(["digest"]), "live"), secrets.mask, length="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: ids of the whole text, and what they decode to."""
    return bpe.round_trip(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("byte_bpe", encode),
]

#: No SQL: the stages are held against a plain Python version in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder before the next starts."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), stored()
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
        drop(spark, [p for p in stored()[:-1] if p not in held])  # of the stages before, which no one reads any more
    return STAGES[-1][1](spark, docs, sf_dir)
