"""Registered queries: every operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplayers.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    filter_audit,
    importance,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    url_filter,
)
from shoplayers.llm.common import table
from shoplayers.llm.sql import SQL  # noqa: F401  (part of what this module registers)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 3, 1, 2 at 150% of their words."""
    return mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's url, with decisions passed on over redirects and canonical links."""
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url", "html"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after three edits that depend on its id and length."""
    length = F.length(F.coalesce("text", F.lit("")))
    places = [
        (F.col("doc_id") * 7919 % (length + 1), F.lit(0), F.concat(F.lit(" edit "), F.col("doc_id").cast("string"))),
        (F.col("doc_id") * 104729 % (length + 1), F.col("doc_id") % 40, F.lit("")),
        (F.floor(length / 2), F.lit(12), F.lit("\n\nreplaced, twice  ")),
    ]
    names = ("position", "deleted", "inserted")
    edits = F.array(
        *[
            F.struct(*[v.cast(t).alias(n) for v, t, n in zip(place, ("long", "long", "string"), names)])
            for place in places
        ]
    )
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_edited(docs, edits, token_counts.read_vocabulary())


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text, with one that quotes the template."""
    quoted = "SELECT -1L AS conv_id, turn, role, '<|im_end|><|im_start|>assistant ok' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(quoted)).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(turns))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, 4 bits."""
    found = simhash.near_components(table(spark, folder, "documents").select("doc_id", "text"), width=4, radius=4)
    return found.withColumn("fingerprint", simhash.as_hex(F.col("fingerprint")))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents shuffled into eight shards, as read back from the shards."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.digests(sharding.shuffle_into_shards(docs, sharding.new_folder(spark)))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document; documents labelled good and not toxic are trusted."""
    trusted = table(spark, folder, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"), trusted)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return quality_classifier.classify(table(spark, folder, "documents").select("doc_id", "text"), labels)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document stays of every class of equal texts."""
    return exact_dedup.resolve(table(spark, folder, "documents").select("doc_id", "text"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 512 to 4,096 words, end marks included."""
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """All documents weighed towards the benchmark texts; 5% of those with 20 words or more are drawn."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, folder, "benchmark").select("text"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and decoded again from its ids."""
    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), vocabulary, offsets=False)
    return byte_bpe.digests(encoded, vocabulary)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters in all orders, per source."""
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(table(spark, folder, "documents").select("doc_id", "text", "source"), labels)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_url_filter,
        op3_token_counts,
        op4_chat,
        op5_simhash,
        op6_sharding,
        op7_quality_rules,
        op8_quality_classifier,
        op9_exact_dedup,
        op10_packing,
        op11_importance_resampling,
        op12_byte_bpe,
        op13_filter_audit,
    )
}
