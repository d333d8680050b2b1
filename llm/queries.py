"""The registered queries of the operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    ann,
    bpe,
    centroids,
    chat,
    hard_negatives,
    invertible,
    jaccard_join,
    language,
    minhash,
    mixing,
    pseudo_likelihood,
    suffix,
    warc,
)
from llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_kmeans_tree(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query(chat.ORACLE)
def op2_chat_perspectives(spark, sf_dir):
    seen = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return seen.withColumn("spans", F.array_join(spans, ","))


@query()
def op3_suffix_array(spark, sf_dir):
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@query()
def op4_warc(spark, sf_dir):
    files = warc.archive(spark, table(spark, sf_dir, "pages"))
    return warc.read_archives(files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query(mixing.ORACLE)
def op5_curriculum_mix(spark, sf_dir):
    # Training positions of a document's first and last copy, in words of the mix.
    at = lambda place: F.floor(F.try_element_at("positions", F.lit(place)) * F.col("mix_size"))
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", at(1).alias("first_position"), at(-1).alias("last_position")
    )


@query()
def op6_invertible_sketch(spark, sf_dir):
    return invertible.fingerprints(table(spark, sf_dir, "documents"))


@query()
def op7_byte_bpe(spark, sf_dir):
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary, with_ids=False, with_decoded=False).drop(
        "ids", "decoded"
    )


@query()
def op8_hyperminhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query()
def op10_subword_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = language.fit(language.learning_rows(documents))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return language.identify(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.*"
    )


@query(centroids.ORACLE)
def op11_centroid_rounds(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query()
def op12_jaccard_regions(spark, sf_dir):
    return jaccard_join.near_sets(table(spark, sf_dir, "documents"))


@query(hard_negatives.ORACLE)
def op13_angular_negatives(spark, sf_dir):
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, label=label)
