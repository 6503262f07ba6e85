"""The registered queries of the operators for training data, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tractline.llm import (
    decontamination,
    filter_audit,
    language,
    licences,
    line_dedup,
    packing,
    prefix_trie,
    sharding,
    simhash,
    token_counts,
    topk,
    toxicity,
    warc,
)
from tractline.session import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_sharding")
def _(spark, folder):
    return sharding.shard_documents(table(spark, folder, "documents"))


@query("op9_simhash")
def _(spark, folder):
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    bits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", bits.alias("fingerprint"), "component_id")


@query("op3_line_dedup", line_dedup.SQL)
def _(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_toxicity")
def _(spark, folder):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    learn = table(spark, folder, "labels").filter(~held_out)
    scored = toxicity.score_documents(table(spark, folder, "documents"), learn)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op8_decontamination", decontamination.SQL)
def _(spark, folder):
    return decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_language_id")
def _(spark, folder):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = table(spark, folder, "documents")
    found = language.identify(docs, docs.filter(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op4_warc", warc.SQL)
def _(spark, folder):
    archives = scratch_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.page_digests(warc.read_pages(warc.read_records(spark, archives)))


@query("op7_packing")
def _(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query("op6_topk", topk.SQL)
def _(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk.top_products(vectors, vectors.filter("vec_id % 20 = 0"))


@query("op2_licences")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    # The documents have no paths: their sources are the top directories, ids make the ones below.
    steps = [F.col("source"), F.floor(F.col("doc_id") / 256), F.floor(F.col("doc_id") / 16), F.col("doc_id")]
    path = F.concat_ws("/", *[s.cast("string") for s in steps])
    found = licences.scan_licences(docs.select("doc_id", path.alias("path"), "text"))
    return found.drop("text")


@query("op11_token_counts")
def _(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_filter_audit", filter_audit.SQL)
def _(spark, folder):
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_prefix_trie", prefix_trie.SQL)
def _(spark, folder):
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))
