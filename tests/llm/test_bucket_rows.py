"""A bucket's rows meet its pivots once, however many buckets a group of near copies shares."""

import pytest
from pyspark.sql import functions as F

from rollcall.llm import line_dedup, near_dedup


@pytest.fixture
def unadapted(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def joined_rows(plan):
    """The most rows that a join of an executed plan made."""
    children = plan.children()
    below = [joined_rows(children.apply(i)) for i in range(children.size())]
    made = plan.metrics().get("numOutputRows") if "Join" in plan.nodeName() else None
    return max([0, *below, *([made.get().value()] if made is not None and made.isDefined() else [])])


def test_joins_of_buckets_make_no_more_rows_than_they_read(unadapted):
    keyed = unadapted.range(100).crossJoin(unadapted.range(24).toDF("key")).select(F.col("id").alias("node"), "key")
    pairs = near_dedup.candidate_pairs(keyed)
    got = [tuple(r) for r in pairs.collect()]
    wanted = {(a, b) for a in range(near_dedup.PIVOTS) for b in range(a + 1, 100)}
    assert len(got) == len(wanted) and set(got) == wanted
    assert joined_rows(pairs._jdf.queryExecution().executedPlan()) <= 2400


def test_sieve_by_any_column(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("node"), "id")
    wanted = rows.filter("id % 50 = 0").select("node")
    passed = line_dedup.sieved(rows, wanted, "node")
    assert passed.columns == ["node", "id"] and 100 <= passed.count() < 200
    assert passed.join(wanted, "node", "left_semi").count() == 100
