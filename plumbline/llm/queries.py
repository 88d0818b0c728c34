"""Each operator over its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import oracles
from plumbline.llm.brown import class_scores
from plumbline.llm.hard_negatives import mine_hard_negatives
from plumbline.llm.hyperdim import identify
from plumbline.llm.mixing import mix_to_targets
from plumbline.llm.near_dup import near_duplicates
from plumbline.llm.packing import pack_documents
from plumbline.llm.personal_data import BASE_KINDS, find_personal_data, spelled
from plumbline.llm.repetition import repetition
from plumbline.llm.sentencepiece_bpe import decode, encode, read_model
from plumbline.llm.simhash import RADIUS, WIDE_FLIPS, WIDE_RADIUS, fingerprint_documents, within_radius
from plumbline.llm.toxicity import toxicity
from plumbline.llm.urls import ALLOW, BLOCK, judge_urls
from plumbline.llm.whitening import whitened_rows
from plumbline.llm.words import documents, id_remainder
from plumbline.sources.staging import Staging

URL_RULES = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/")]
SEARCH_EVERY = 20


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir), id_remainder(F.col("doc_id"), 5) != 0)


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_to_targets(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    coded = decode(encode(documents(spark, sf_dir).select("doc_id", "text"), model).drop("text"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also, for every twentieth id: how many other documents are within the Hamming radius (``n_near``) and within the wide radius (``n_wide``), and the
    nearest other fingerprint of the latter with its distance; its documents are the rows of that ``fingerprint``. Pairs are summed up where they
    are found, so a group of near copies never becomes a list; ``within_radius`` gives the pairs themselves."""
    staging = Staging(spark)
    found = staging.put(fingerprint_documents(documents(spark, sf_dir), staging=staging), "fingerprints")
    asked = F.col("doc_id") % SEARCH_EVERY == 0
    sizes = found.groupBy(F.col("fingerprint").alias("found")).agg(F.count(F.lit(1)).alias("n"))
    near = within_radius(found.where(asked), found, radius=WIDE_RADIUS, flips=WIDE_FLIPS).join(sizes, "found")
    other = F.when(F.col("found") != F.col("query"), F.struct("distance", "found"))
    near = near.groupBy(F.col("query").alias("fingerprint")).agg(
        (F.sum(F.when(F.col("distance") <= RADIUS, F.col("n"))) - 1).alias("near"), (F.sum("n") - 1).alias("wide"), F.min(other).alias("other")
    )
    return found.join(near, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.when(asked, F.col("near")).alias("n_near"), F.when(asked, F.col("wide")).alias("n_wide"),
        F.when(asked, F.col("other.found")).alias("nearest"), F.when(asked, F.col("other.distance")).alias("nearest_distance"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(documents(spark, sf_dir), labels, id_remainder(F.col("doc_id"), 5) != 0)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(spelled("base"), 256).alias("base_sha256"), spelled("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_scores(documents(spark, sf_dir), id_remainder(F.col("doc_id"), 7) != 2)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is added to all whole numbers alike leaves every column as it is, so it is not added."""
    return whitened_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


QUERIES = {
    "op1_language": op1_language,
    "op2_repetition": op2_repetition,
    "op3_mixing": op3_mixing,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_personal_data": op7_personal_data,
    "op8_url_rules": op8_url_rules,
    "op9_near_dup": op9_near_dup,
    "op10_class_lm": op10_class_lm,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op2_repetition": oracles.REPETITION,
    "op8_url_rules": oracles.URL_RULES,
    "op9_near_dup": oracles.NEAR_DUP,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
