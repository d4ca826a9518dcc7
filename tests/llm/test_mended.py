"""Cases that were once judged or lost wrongly."""

import pytest
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, fingerprint, line_dedup, near_dedup, quality_knn
from rollcall.llm.common import prepare

WORDS = "alpha beta gamma delta epsilon zeta".split()


def test_items_with_the_same_shingles_in_another_order(spark):
    prepare(spark)
    cyclic = [" ".join((WORDS * 3)[i : i + 16]) for i in (0, 1)]  # the same runs of five, from another start
    items = spark.createDataFrame([(1, cyclic[0]), (2, cyclic[1])], "item_id long, text string")
    docs = spark.createDataFrame([(7, "before " + " ".join(WORDS * 4) + " after"), (8, "clean text of no interest at all")], "doc_id long, text string")
    rows = {r["doc_id"]: (r["contaminated"], r["n_items"], r["items"]) for r in decontaminate.judge(docs, items).collect()}
    assert rows == {7: (True, 2, "1,2"), 8: (False, 0, "")}


def test_short_items_are_held_whole(spark):
    prepare(spark)
    items = [(1, "Capital of France"), (2, "two words"), (3, "to be or not"), (4, "one two three four five six")]
    docs = [(1, "the capital of France is known"), (2, "capital of big France, two words"), (3, "To be, or not: that"), (4, "a one two three four five six b"), (5, None)]
    found = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {1: "1", 2: "", 3: "3", 4: "4", 5: ""}


def test_repeated_labels_count_by_their_mean(spark):
    prepare(spark)
    docs = spark.range(60).selectExpr("id doc_id", "if(id % 2 = 0, 'good clear prose here', '!!! $$ junk ##') text")
    real = spark.range(60).selectExpr("id doc_id", "cast(id % 2 = 0 as int) quality")
    nulls = spark.range(60).selectExpr("id doc_id", "cast(null as int) quality")
    models = [quality_knn.fit_documents(docs, labels) for labels in (real, nulls.union(real), real.union(nulls))]
    assert {len(m.labels) for m in models} == {len(models[0].labels)} and len(models[0].labels) > 30
    both = quality_knn.fit_documents(docs, real.union(real.withColumn("quality", 1 - F.col("quality"))))
    assert set(both.labels.tolist()) == {0.5}


def test_columns_of_any_name_stay(spark):
    prepare(spark)
    names = ["_gone", "_rank", "_key", "_text_hash", "_kept_id", "_kept_node", "node", "item"]
    line = "a line that stands in both of the documents here"
    docs = spark.createDataFrame([(i, f"{line}\nown line number {i} of the text", *[f"{n}{i}" for n in names]) for i in range(3)], ["doc_id", "text", *names])
    items = spark.createDataFrame([(1, "nothing of this kind is in any text")], "item_id long, text string")
    for result in (line_dedup.drop_lines(docs), near_dedup.keep_one(docs), decontaminate.drop_contaminated(docs, items)):
        assert result.columns == docs.columns
        for row in result.collect():
            assert [row[n] for n in names] == [f"{n}{row['doc_id']}" for n in names]
    assert decontaminate.drop_contaminated(docs, items).count() == 3


@pytest.mark.parametrize("distinct", [True, False])
def test_rows_without_id_are_split_and_read_once(spark, distinct):
    prepare(spark)
    rows = [(None, f"text {i if distinct else 0} of null") for i in range(400)] + [(i, f"own text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        dealt = fingerprint.with_successors(docs)
        sizes = [len(p) for p in dealt.rdd.glom().collect()]
        got = fingerprint.fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 600
    if distinct:
        assert sum(sizes) <= 608 and max(sizes) < 300
    own = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    sampler = fingerprint.sampler()
    for i in (0, 57, 198):
        text, following = f"own text {i}", f"own text {i + 1}"
        assert own[i]["fingerprint"] == fingerprint.text_of(sampler.signature(text))
        assert own[i]["near_next"] == fingerprint.likeness(sampler.signature(text), sampler.signature(following))
