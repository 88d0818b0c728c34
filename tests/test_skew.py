"""Joins and numbering with hot keys, many files and no broadcast."""

import pytest
from helpers import IN_SET, UNIQUE, bad_ids, rule
from plumbline.operators import probe as P
from plumbline.operators.numbering import number_rows, number_staged_rows
from plumbline.sources.staging import Staging
from pyspark.sql import functions as F


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark, rows=6000):
    """A third of the rows share key 0, a sixth have no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(0, rows, 1, 8).select("id", key.alias("x"))


def test_hot_keys_are_found(spark):
    df = skewed(spark)
    hashes = {row[0] for row in spark.sql("SELECT xxhash64(0L) UNION SELECT xxhash64(cast(NULL AS long))").collect()}
    found = P.hot_hashes(df, [F.col("x")], 8)
    assert set(found) == hashes and all(1 < n <= 8 for n in found.values())
    assert P.hot_hashes(spark.range(10000), [F.col("id")], 8) == {}


def test_a_key_above_a_fair_partition_is_hot(spark):
    key = F.when(F.col("id") % 300 == 0, -1).otherwise(F.col("id"))
    df = spark.range(0, 300_000, 1, 8).select(key.alias("x"))
    (found,) = P.hot_hashes(df, [F.col("x")], 2000).items()
    assert found[0] == spark.sql("SELECT xxhash64(-1L)").first()[0] and found[1] == 16


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left"])
def test_salted_probe_equals_plain_join(spark, no_broadcast, how, null_safe):
    df = skewed(spark)
    keys = df.filter("x % 2 = 0 OR x IS NULL").groupBy(F.col("x").alias("_k0")).agg(F.count(F.lit(1)).alias("n"))
    key_set = P.stage_keys(keys, Staging(spark), "keys")
    joined = P.probe(df, [F.col("x")], key_set, how, null_safe)
    assert "_salt" in joined._jdf.queryExecution().toString()

    members = {row["_k0"]: row["n"] for row in keys.collect()}
    expected = []
    for row in df.collect():
        hit = row["x"] in members and (null_safe or row["x"] is not None)
        if how == "left":
            expected.append((row["id"], members[row["x"]] if hit else None))
        elif hit == (how == "left_semi"):
            expected.append((row["id"],))
    columns = ["id", "n"] if how == "left" else ["id"]
    assert sorted(map(tuple, joined.select(columns).collect())) == sorted(expected)


def test_hot_rows_spread_over_partitions(spark, no_broadcast):
    df = skewed(spark).filter("x IS NOT NULL")
    keys = df.groupBy(F.col("x").alias("_k0")).agg(F.count(F.lit(1)).alias("n"))
    joined = P.probe(df, [F.col("x")], P.stage_keys(keys, Staging(spark), "keys"), "left_semi")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = joined.filter("x = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(tasks) > 3 and max(row["count"] for row in tasks) < 2000


def test_keyed_checks_without_broadcast(spark, no_broadcast):
    df = skewed(spark, 600)
    rows = df.collect()
    values = [row["x"] for row in rows]
    repeated = [row["id"] for row in rows if row["x"] is not None and values.count(row["x"]) > 1]
    assert bad_ids(df, rule(UNIQUE, {"column": "x"})) == repeated
    members = spark.range(0, 500, 2).select(F.col("id").alias("code"))
    outside = [row["id"] for row in rows if row["x"] is not None and row["x"] % 2]
    assert bad_ids(df, rule(IN_SET, {"column": "x", "value_set": "ref.code"}), {"ref": members}) == outside


def test_size_bound_decides_on_broadcast(spark):
    key_set = P.stage_keys(spark.range(10).select(F.col("id").alias("_k0"), F.lit(1).alias("n")), Staging(spark), "keys")
    assert (key_set.key_count, key_set.row_count, key_set.size_in_bytes) == (10, 10, 320)
    text = P.stage_keys(spark.sql("SELECT repeat('é', 100) AS _k0, 1 AS n"), Staging(spark), "keys")
    assert text.size_in_bytes == 200 + 32
    for value, limit in (("10MB", 10 << 20), ("10485760b", 10 << 20), ("1g", 1 << 30), ("512", 512), ("-1", -1)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        assert P.broadcast_limit(spark) == limit
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1000).alias("v"))
    numbered = number_rows(df, "n", Staging(spark), [F.col("v").desc()], start=5)
    assert [(row["v"], row["n"]) for row in numbered.orderBy("n").collect()] == [(999 - i, i + 6) for i in range(1000)]
    assert number_rows(df.filter("v < 0"), "n", Staging(spark)).count() == 0


def test_numbers_do_not_change_when_recomputed(spark):
    numbered = number_rows(spark.range(0, 1000, 1, 7), "n", Staging(spark))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    first = sorted(map(tuple, numbered.collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1KB")
    try:
        assert sorted(map(tuple, numbered.select("id", "n").collect())) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(n for _, n in first) == list(range(1, 1001))


@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("padding", [0, 200])
def test_collated_texts_repeat_whatever_their_spelling(spark, limit, padding):
    """Long and short texts, and a hot one with several spellings, with and without broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        spelled = F.when(F.col("id") % 2 == 0, F.upper("text")).otherwise(F.col("text"))
        text = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.floor(F.col("id") / 2).cast("string")))
        df = spark.range(0, 3000, 1, 8).select("id", F.concat(text, F.lit("x" * padding)).alias("text"))
        plain = df.select("id", spelled.alias("x"))
        df = plain.select("id", F.collate("x", "UTF8_LCASE").alias("x"))
        rows = [(r["id"], r["x"].lower()) for r in plain.collect()]
        times = {}
        for _, value in rows:
            times[value] = times.get(value, 0) + 1
        assert bad_ids(df, rule(UNIQUE, {"column": "x"})) == [i for i, value in rows if times[value] > 1]
        exact = [r["x"] for r in plain.collect()]
        assert bad_ids(plain, rule(UNIQUE, {"column": "x"})) == [i for (i, _), x in zip(rows, exact) if exact.count(x) > 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_probe_of_another_type(spark, no_broadcast):
    df = skewed(spark).select("id", F.col("x").cast("int").alias("x"))
    keys = spark.range(0, 500, 2).select(F.col("id").alias("_k0"), F.lit(1).alias("n"))
    found = P.probe(df, [F.col("x")], P.stage_keys(keys, Staging(spark), "keys"), "left_semi")
    assert found.count() == df.filter("x % 2 = 0").count()


def test_numbers_of_many_files_need_no_list_of_them(spark, monkeypatch):
    """A thousand small files; beyond the broadcast limit, too."""
    def refused(self):
        raise AssertionError("the driver must not ask for all files")

    staged = Staging(spark).put(spark.range(0, 2500, 1, 1000), "many")
    monkeypatch.setattr(type(staged), "inputFiles", refused)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for size in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
            numbers = sorted(row["n"] for row in number_staged_rows(staged, "n", 10).collect())
            assert numbers == list(range(11, 2511))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
