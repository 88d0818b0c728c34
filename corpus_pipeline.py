"""A corpus from raw documents: language, near duplicates, personal data, mixing, tokens.

Every stage takes the documents that the one before kept, written and read again. All but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.hyperdim import UNDETERMINED, identify
from plumbline.llm.mixing import mix_to_targets
from plumbline.llm.near_dup import near_duplicates
from plumbline.llm.personal_data import MARKED, find_personal_data, redacting
from plumbline.llm.sentencepiece_bpe import decode, encode, read_model
from plumbline.llm.words import documents, id_remainder
from plumbline.sources.staging import Staging

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Rows of long texts that cross into Python at once: an executor holds a batch several times for each of its tasks.
BATCH_BYTES = "4m"
BROADCAST_SPANS = 50_000  # of some 100 bytes


def _key() -> Column:
    """Tells rows apart where ids are null or repeated; the smallest id of a group comes first, then a fixed order of the other columns."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"),
        F.xxhash64("lang", "source", "n_chars").alias("rest"),
    )


def _bounded(spark: SparkSession) -> None:
    """Keep batches small for the stages' jobs, which run when a stage's result is written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a determined language, which replaces the given one."""
    _bounded(spark)
    known = identify(docs.select(*COLUMNS), id_remainder(F.col("doc_id"), 5) != 0, carry=COLUMNS)
    return known.where(F.col("lang_pred") != UNDETERMINED).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars"
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id (null ids last). Of rows of that id the one whose
    text, then other columns, have the least hash stays, whatever the order of rows; rows that are equal throughout are one."""
    _bounded(spark)
    keyed = docs.select(*COLUMNS, _key().alias("_key"))
    kept = near_duplicates(keyed, "_key").where("kept").select("_key").distinct()
    # By plain columns that are never null, so that texts are dealt out once: repeats meet before the join, and stay where they are for it.
    fields = {f"_key{i}": expr for i, expr in enumerate(("_key.no_id", "coalesce(_key.id, 0)", "_key.content", "_key.rest"))}
    plain = lambda df: df.withColumns({name: F.expr(expr) for name, expr in fields.items()}).drop("_key")
    return plain(keyed).dropDuplicates(list(fields)).join(plain(kept), list(fields), "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data is replaced by its kind, and ``n_chars`` of changed texts follows.

    A null text stays null.
    """
    _bounded(spark)
    docs = docs.select(*COLUMNS)
    marked = F.coalesce(F.col("text").rlike(MARKED), F.lit(False))
    keyed = docs.withColumn("_key", F.struct(_key().alias("row"), marked.alias("marked")))
    staging = Staging(spark)
    spans = find_personal_data(keyed, "_key", staging=staging).where(F.size("spans") > 0)
    spans = staging.put(spans.groupBy("_key").agg(F.first("spans").alias("spans")), "spans")
    rare = spans.where(~F.col("_key.marked"))
    # Few texts without digits and marks hold spans, and as long as they are few all others of that kind stay where they are.
    few = rare.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0] <= BROADCAST_SPANS
    joined = keyed.where("_key.marked").join(spans.where("_key.marked"), "_key", "left").select(*COLUMNS, "spans")
    joined = joined.union(keyed.where("not _key.marked").join(F.broadcast(rare) if few else rare, "_key", "left").select(*COLUMNS, "spans"))
    changed = joined.where("spans is not null").mapInArrow(redacting(COLUMNS), docs.schema)
    changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.where("spans is null").select(*COLUMNS).union(changed.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have tempered shares of sources, languages and topics.

    Null texts have no tokens; null sources and languages are shares of their own. Repeated rows are drawn, or not, together.
    """
    _bounded(spark)
    return mix_to_targets(docs.select(*COLUMNS)).where("selected").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and the text that they decode to; a null text is empty. Every row is coded by itself."""
    _bounded(spark)
    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    coded = decode(encode(docs.select("doc_id", "lang", "source", "text"), model).drop("text"), model)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("tokens", tokens),
]

ORACLE_SQL = None  # hyperdimensional profiles and merge rounds cannot be said in SQL; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staging.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
