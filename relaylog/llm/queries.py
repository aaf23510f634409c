"""The registered queries of this subpackage: its operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.llm import (
    bpe,
    chat,
    ngram_join,
    packing,
    pieces,
    quality_classifier,
    quality_rules,
    secret_scan,
    spelling,
    syncmers,
    token_files,
    toxicity,
    warc,
    whitening,
)
from relaylog.llm.common import documents, prepared, stored
from relaylog.session import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 2
SEQUENCE_TOKENS = 1024


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), folder, TOKENIZER, END_ID)
    return token_files.read_token_files(spark, folder)


def packed(docs: DataFrame, kept: int = pieces.HALF_PIECES) -> DataFrame:
    cut = packing.cut_documents(docs, TOKENIZER, END_ID, SEQUENCE_TOKENS, kept=kept)
    return packing.pack(cut, SEQUENCE_TOKENS)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), pieces.MANY_PIECES)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prepared(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.link_calls(chat.turns_as_calls(turns), chat.ASK)


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(documents(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, training = documents(spark, sf_dir), toxicity.Training()
    scored = toxicity.score(docs, toxicity.train(docs, _labels(spark, sf_dir), training=training))
    held_out = toxicity.remainder(training.fold) == training.held_out
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_features"
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir))


ACCEPTED = 0.7


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, training = documents(spark, sf_dir), quality_classifier.QUALITY
    scored = quality_classifier.score(docs, quality_classifier.train(docs, _labels(spark, sf_dir)))
    held_out = toxicity.remainder(training.fold) == training.held_out
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


#: The pages have no date of their own.
CRAWLED = "2024-01-01T00:00:00Z"


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = prepared(spark).read.parquet(f"{sf_dir}/pages.parquet")
    crawl, folder = shared_dir(spark, "crawl"), shared_dir(spark, "archives")
    warc.deduplicate(warc.write_archives(pages, crawl, CRAWLED), crawl, folder)
    warc.forget_archives(crawl)
    records = warc.resolved(stored(warc.read_archives(spark, folder), "records"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(prepared(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))
