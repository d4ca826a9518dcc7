"""Feeds above the size at which copies are sieved, and tables dealt by their rows."""

import pytest
from pyspark.sql import functions as F

from rollcall.operators import dedup
from rollcall.plans.feeds import build_sat
from rollcall.plans.reconcile import write_reconciled
from rollcall.session import pin
from tests.conftest import plan_of, rows_of
from workload import registry
from workload.feed_queries import raw_tables
from workload.registry import Tables

SF = "/root/testdata/sf0.001"


def _copies(spark):
    """Keys with one to five copies; lineage with NULLs and ties, values that break them."""
    return spark.range(4000).selectExpr(
        "if(id % 31 = 0, null, cast(id % 1500 as string)) k",
        "if(id % 7 = 0, null, concat('y', id % 3)) source_year",
        "if(id % 11 = 0, null, concat('f', id % 5)) source_file",
        "cast(id % 13 as string) a",
        "cast(id % 4 as string) b",
    )


@pytest.mark.parametrize("words", [dedup.MOST_WORDS, dedup.BLOCK])
def test_every_way_keeps_the_same_rows(spark, monkeypatch, words):
    monkeypatch.setattr(dedup, "MOST_WORDS", words)
    monkeypatch.setattr(dedup, "FEW_ROWS", 0)
    df = _copies(spark)
    expected = rows_of(dedup.dedup(df, ["k"]))
    assert rows_of(dedup.dedup_newest(df, ["k"])) == expected
    assert rows_of(dedup.dedup_sieved(df, ["k"])) == expected
    for wide in (0, 100):
        monkeypatch.setattr(dedup, "WIDE", wide)
        assert rows_of(dedup.dedup_large(df, ["k"])) == expected
    assert rows_of(dedup.dedup_newest(df.drop("source_year", "source_file"), ["k"])) == rows_of(
        dedup.dedup(df.drop("source_year", "source_file"), ["k"])
    )
    assert dedup.dedup_newest(df.limit(0), ["k"]).count() == 0


def test_sieve_grows_with_its_hashes(spark):
    few = dedup.Sieve(spark.range(100).select(F.xxhash64("id").alias("_digest")))
    many = dedup.Sieve(pin(spark.range(40_000).select(F.xxhash64("id").alias("_digest")), "digests"))
    assert few.words == dedup.BLOCK and many.words * 8 >= 40_000
    passed = spark.range(140_000).filter(many.passes(F.xxhash64("id")))
    assert passed.filter("id < 40000").count() == 40_000
    assert passed.count() < 52_000


def test_rows_of_old_files_are_dropped_before_the_exchange(spark, monkeypatch):
    monkeypatch.setattr(dedup, "FEW_ROWS", 0)
    values = [f"cast(id * {i} % 97 as string) v{i}" for i in range(dedup.WIDE + 2)]
    df = spark.range(20_000).selectExpr("cast(id % 500 as string) k", "concat('y', id) source_year", "'f' source_file", *values)
    moved = []

    def first(rows, keys, order, plain=dedup.first_per_key):
        moved.append(rows.count())
        return plain(rows, keys, order)

    monkeypatch.setattr(dedup, "first_per_key", first)
    assert dedup.dedup_large(df, ["k"]).count() == 500
    assert moved[0] < 5_000


def test_few_wide_rows_are_ordered_and_nothing_large_is_planned_twice(spark, monkeypatch):
    """Rows that the sieve of newest files lets through by chance are dropped by a second one."""
    monkeypatch.setattr(dedup, "FEW_ROWS", 0)
    values = [f"cast(id * {i} % 97 as string) v{i}" for i in range(dedup.WIDE + 2)]
    df = spark.range(60_000).selectExpr(
        "cast(id % 6000 as string) k", "concat('y', id) source_year", "if(id % 12000 = 7, 'g', 'f') source_file",
        "'user' as _digest", "'user' as _mark", *values,
    )
    df = df.unionByName(df.filter("source_year >= 'y9995'"))
    expected = rows_of(dedup.dedup(df, ["k"]))
    moved, sieves = [], []

    def first(rows, keys, order, plain=dedup.first_per_key):
        moved.append(rows.count())
        return plain(rows, keys, order)

    def made(self, *args, plain=dedup.Sieve.__init__, **kwargs):
        plain(self, *args, **kwargs)
        sieves.append(self.words)

    monkeypatch.setattr(dedup, "first_per_key", first)
    monkeypatch.setattr(dedup.Sieve, "__init__", made)
    assert rows_of(dedup.dedup_large(df, ["k"])) == expected
    assert sum(moved) < 300
    # at most 64 MB of bitmap, the later ones smaller than the first
    assert dedup.MOST_WORDS * 8 <= 2**26 and all(words <= sieves[0] for words in sieves[1:])


def test_hashes_of_keys_are_built_once_a_row_and_lead_the_sorts(spark, tmp_path):
    _copies(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("k", F.concat("k", F.lit("_"), "a"))
    for part in dedup.split_recurring(df, ["k", "b"]):
        assert plan_of(part).count("xxhash64(") == 1 and "concat(k" in plan_of(part)
    assert plan_of(dedup.dedup(df, ["k", "b"])).count("xxhash64(") == 1


def test_reconciliation_of_sieved_feeds(spark, monkeypatch):
    monkeypatch.setattr(dedup, "FEW_ROWS", 0)
    raw = raw_tables(Tables(spark, SF), "dropout_rate")
    rows = raw["dropout_rate"].count()
    row = write_reconciled("dropout_rate", raw, lambda df: pin(df, "typed").count()).first()
    assert row["status"] == "pass" and row["expected"].startswith(f"{rows} - ")


def test_tables_are_dealt_by_their_rows(spark, monkeypatch):
    t = Tables(spark, SF)
    rows = t.lineitem.count()
    monkeypatch.setattr(registry, "DEALT_ROWS", 100)
    assert t.spread("lineitem").rdd.getNumPartitions() == -(-rows // 100)
    assert rows_of(t.spread("lineitem").select("l_orderkey", "l_linenumber")) == rows_of(t.lineitem.select("l_orderkey", "l_linenumber"))


@pytest.mark.parametrize("on_conflict", ["fanout", "null"])
def test_large_sat_union_gives_the_same_rows(spark, monkeypatch, on_conflict):
    raw = raw_tables(Tables(spark, SF), "sat")
    raw["sat"] = raw["sat"].unionByName(raw["sat"].limit(50))
    expected = rows_of(build_sat(raw, on_conflict))
    monkeypatch.setattr(dedup, "FEW_ROWS", 0)
    built = build_sat(raw, on_conflict)
    assert "sat_filled" in built.inputFiles()[0] and rows_of(built) == expected
