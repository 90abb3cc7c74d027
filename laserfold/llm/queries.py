"""The corpus operators as registered queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laserfold.llm import (
    conversation_repair,
    jaccard_join,
    mixing,
    packing,
    prefix_forest,
    quality_gam,
    quality_rules,
    token_alignment,
    token_counts,
    tokens,
    url_filter,
    vector_dedup,
    warc,
    wavelet,
)
from laserfold.llm.common import new_folder

Query = Callable[[SparkSession, str], DataFrame]
registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    registry[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed values of the query: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


# Target shares of every window: the bulk source, and all other sources by their tokens.
PACKING_WEIGHTS = {"src0": 0.3}
PACKING_REST = 0.7


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(
        docs, tokens.default_path(), weights=PACKING_WEIGHTS, rest=PACKING_REST, with_ids=False
    )


@query
def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_gam.score(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).drop("key")


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokens.default_path())


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = new_folder(pages, "warc")
    return warc.read(warc.write(pages, folder), folder, with_payload=False).drop("url")


def mixture_levels() -> dict:
    """The mixture tree over `documents`: domain, language, source."""
    domain = F.when(F.col("source") == "src0", "bulk").otherwise("curated")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


# Shares among siblings; languages and sources not named here have their natural share.
MIXTURE_WEIGHTS = {("bulk",): 0.3, ("curated",): 0.7, ("curated", "en"): 0.5}
MIXTURE_SHARE = 0.9


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.select(
        table(spark, sf_dir, "documents"),
        mixture_levels(),
        path=tokens.default_path(),
        share=MIXTURE_SHARE,
        weights=MIXTURE_WEIGHTS,
        max_epochs=2,
    )
    return chosen.select("doc_id", "lang", "source", "epoch")


@query
def op8_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(docs, "wavelet")
    manifest = wavelet.write_shards(docs, tokens.default_path(), folder)
    return wavelet.read_shards(manifest, folder)


@query
def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.link(table(spark, sf_dir, "embeddings"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults that the repair query asks for; nulls are one space."""
    conv_id, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    one_space = F.lit(" ")
    address = F.concat_ws(
        ":", F.coalesce(conv_id.cast("string"), one_space), F.coalesce(turn.cast("string"), one_space)
    )
    text = F.coalesce("text", one_space)
    kind = F.col("kind")
    return (
        turns.select(
            conv_id.alias("conv_id"),
            turn.alias("turn"),
            F.coalesce("role", one_space).alias("role"),
            text.alias("text"),
            (F.crc32(address) % 20).alias("kind"),
        )
        .where("kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, "")
            .when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repaired, report = conversation_repair.repair(damaged(turns))
    conv_id = F.col("conv_id").cast("bigint")
    every = turns.select(conv_id.alias("conv_id")).distinct()
    every = every.withColumn("conv", conversation_repair.conv_key(F.col("conv_id")))
    known = every.join(report, "conv", "left").join(conversation_repair.digests(repaired), "conv", "left")
    return known.select(
        "conv_id",
        *(
            F.coalesce(name, F.lit(0)).alias(name)
            for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        ),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = tokens.alignment_paths()
    return token_alignment.align(table(spark, sf_dir, "documents"), path_a, path_b)


@query
def op13_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.search(table(spark, sf_dir, "embeddings"), every=20)


def sql_texts() -> dict[str, str]:
    return {}
