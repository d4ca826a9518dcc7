"""A third of all rows on one key: results stay whole and the plans avoid a hot task."""

from pyspark.sql import functions as F

from rollcall.operators import conform, dedup, quality, star
from tests.conftest import plan_of, rows_of

N = 60_000


def hot(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, N, 1, 6).select(
        key.alias("code"), F.lit("2023").alias("source_year"), F.lpad(F.col("id").cast("string"), 8, "0").alias("source_file"),
        F.col("id"),
    )


def settings(spark, **values):
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    return old


def test_dedup_sends_one_row_per_key_and_task(spark):
    rows = hot(spark)
    kept = dedup.dedup(rows, ["code"])
    assert kept.filter("code = 'hot'").select("id").collect()[0][0] == N - 3
    plan = plan_of(kept)
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below
    assert kept.count() == rows.select("code").distinct().count()


def test_left_join_splits_the_hot_key(spark):
    old = settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
            "spark.sql.shuffle.partitions": "12",
        },
    )
    try:
        rows = hot(spark)
        dim = rows.select("code").distinct().filter("code != 'k7'").withColumn("key", F.xxhash64("code"))
        joined = star.attach_dimension(rows, dim.repartition(3), "code", "key")
        # One unmatched member; every fact row is still there.
        assert joined.count() == N
        missing = joined.filter("key IS NULL").agg(F.count("*"), F.count_distinct("code")).first()
        assert missing[0] > 0 and missing[1] == 1
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        settings(spark, **old)


def test_null_keys_survive_the_join(spark):
    rows = hot(spark).withColumn("code", F.when(F.col("code") != "hot", F.col("code")))
    dim = rows.select("code").distinct().dropna().withColumn("key", F.lit(1).cast("long"))
    joined = star.attach_dimension(rows, dim, "code", "key")
    assert joined.filter("key IS NULL").count() == N // 3
    assert rows_of(star.unmatched_keys(rows, dim, "code")) == [(None,)]


def test_counts_are_partial_before_the_shuffle(spark):
    plan = plan_of(quality.key_unique(hot(spark), ["code"]))
    assert "partial_count" in plan[plan.rindex("Exchange"):]


def test_backfill_of_a_hot_school(spark):
    rows = hot(spark).select(
        F.col("code").alias("school"),
        F.col("code").alias("name"),
        F.when(F.col("id") % 2 == 0, F.col("code")).alias("district"),
    )
    filled = conform.backfill(rows, ["school", "name"], ["district"])
    assert filled.count() == N
    assert filled.filter("district != school").count() == 0
    assert filled.filter("school = 'hot' AND district IS NULL").count() == 0
