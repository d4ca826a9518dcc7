"""Header discovery in one job, and layers published in two phases."""

import pytest
from pyspark.sql import functions as F

from rollcall.plans import load
from rollcall.sources import files, tables
from tests.conftest import rows_of
from tests.test_sources import write


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def reports(root, n):
    for i in range(n):
        header, row = (("A,B", "1,2"), ("B,A,C", "2,1,3"))[i % 2]
        write(root, f"y{i % 9}/Attendance_{i:04d}-00.csv", "", header, row)
    write(root, "y1/Exports/Dropout_Rate.csv", "A,B", '"x,y",2')
    write(root, "y1/Dropout_empty.csv")


@pytest.fixture
def layer(spark, tmp_path):
    name = "published_it"
    tables.ensure_schema(spark, name, str(tmp_path / "layer"))
    yield name
    tables.reset_layer(spark, name)
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    spent = []
    for n in (10, 200):
        root = tmp_path / f"up{n}"
        reports(root, n)
        before = jobs(spark)
        layout = files.report_layout(spark, str(root))
        spent.append(jobs(spark) - before)
        assert {kind: sorted((names, len(paths)) for names, paths in groups) for kind, groups in layout.items()} == {
            "attendance": [(["A", "B"], n // 2), (["B", "A", "C"], n // 2)],
            "dropout_rate": [(["A", "B"], 1)],
        }
    assert spent[0] == spent[1]


def test_header_groups_are_one_job_and_settings_return(spark, tmp_path):
    reports(tmp_path / "up", 40)
    paths = files.paths_by_type(files.file_catalog(spark, str(tmp_path / "up")))["attendance"]
    spark.conf.set("spark.sql.files.openCostInBytes", "1234")
    try:
        groups = files.header_groups(spark, paths)
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "1234"
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((names, len(members)) for names, members in groups) == [(["A", "B"], 20), (["B", "A", "C"], 20)]
    assert files.read_raw_csv(spark, paths, str(tmp_path / "up")).agg(F.sum("A"), F.count("C")).first()[:] == (40.0, 20)
    assert files.header_groups(spark, []) == []


def test_first_lines_of_several_files_in_one_task():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"path": ["a", "a", "b"], "line": [" ", "h1", ""]}), pa.RecordBatch.from_pydict({"path": ["b", "b"], "line": ["h2", "x"]})]
    found = [batch.to_pydict() for batch in files._first_lines(iter(batches), alone=False)]
    assert found == [{"path": ["a"], "header": ["h1"]}, {"path": ["b"], "header": ["h2"]}]


def test_load_keeps_or_reloads_the_dictionary(spark, tmp_path, layer):
    root = tmp_path / "up"
    reports(root, 4)
    write(root, "data_dictionary/terms.csv", "Column Name,Size", "a,1", "b,2")
    assert load.load_bronze(spark, str(root), layer) == {"attendance": 4, "dropout_rate": 1, "data_dictionary": 2}
    (root / "data_dictionary" / "terms.csv").unlink()
    assert load.load_bronze(spark, str(root), layer) == {"attendance": 4, "dropout_rate": 1}
    assert rows_of(tables.table_scan(spark, layer, "data_dictionary")) == [("a", 1), ("b", 2)]
    write(root, "data_dictionary/terms.csv", "Column Name,Size", "c,3")
    assert load.load_bronze(spark, str(root), layer)["data_dictionary"] == 1
    assert rows_of(tables.table_scan(spark, layer, "data_dictionary")) == [("c", 3)]
    # a type without files any more goes
    (root / "y1" / "Exports" / "Dropout_Rate.csv").unlink()
    load.load_bronze(spark, str(root), layer)
    assert tables.layer_tables(spark, layer) == ["attendance", "data_dictionary"]


def one(spark, value, **more):
    return spark.createDataFrame([(value,)], "v int").withColumns({k: F.lit(c) for k, c in more.items()})


def published(spark, layer):
    return {name: rows_of(tables.table_scan(spark, layer, name)) for name in tables.layer_tables(spark, layer)}


def test_failed_load_changes_nothing(spark, layer):
    with tables.publication(spark, layer) as new:
        new.write(one(spark, 1), "a")
        new.write(one(spark, 2), "b")
    for whole in (False, True):
        with pytest.raises(ZeroDivisionError), tables.publication(spark, layer, whole=whole) as new:
            new.write(one(spark, 10, w=1), "a")
            raise ZeroDivisionError
        assert published(spark, layer) == {"a": [(1,)], "b": [(2,)]}
    with pytest.raises(tables.SchemaChanged), tables.publication(spark, layer) as new:
        new.write(one(spark, 3), "b")
        new.write(one(spark, 10, w=1), "a", on_schema_change="fail")
    assert published(spark, layer) == {"a": [(1,)], "b": [(2,)]}
    assert tables.versions(spark, layer) == [f"{layer}__000001"]


def test_versions_in_use_stay(spark, layer):
    with tables.publication(spark, layer) as new:
        new.write(one(spark, 1), "a")
        new.write(one(spark, 2), "b")
    held = tables.snapshot(spark, layer)["a"]
    for i in range(10, 13):
        with tables.publication(spark, layer) as new:
            new.write(one(spark, i, w=i), "a")
        if i == 10:
            assert rows_of(held) == [(1,)]  # the version before is kept for its readers
    assert published(spark, layer) == {"a": [(12, 12)], "b": [(2,)]}
    # the first version still holds b, the third is the one before the last
    assert [v[-1] for v in tables.versions(spark, layer)] == ["1", "3", "4"]
    assert {name: rows_of(df) for name, df in tables.snapshot(spark, layer).items()} == published(spark, layer)


@pytest.mark.parametrize("died_at", [0, 1, 2])
def test_recovery_of_a_load_that_died(spark, layer, monkeypatch, died_at):
    with tables.publication(spark, layer) as new:
        new.write(one(spark, 1), "a")
        new.write(one(spark, 2), "b")
    point, calls = tables._point, []

    def dying(*args):
        calls.append(args)
        if len(calls) > died_at:
            raise SystemError("driver lost")
        point(*args)

    monkeypatch.setattr(tables, "_point", dying)
    with pytest.raises(SystemError), tables.publication(spark, layer) as new:
        new.write(one(spark, 3), "a")
        new.write(one(spark, 4), "b")
    monkeypatch.undo()
    # readers by the manifest see one load, whatever views were pointed over
    assert {name: rows_of(df) for name, df in tables.snapshot(spark, layer).items()} == {"a": [(1,)], "b": [(2,)]}
    assert tables.recover(spark, layer) == f"{layer}__000002"
    assert published(spark, layer) == {"a": [(3,)], "b": [(4,)]}
    assert tables.recover(spark, layer) is None


def test_recovery_drops_an_unfinished_version(spark, layer):
    with tables.publication(spark, layer) as new:
        new.write(one(spark, 1), "a")
    tables.ensure_schema(spark, f"{layer}__000002")
    tables.write_table(one(spark, 9), f"{layer}__000002", "a")
    assert tables.recover(spark, layer) is None
    assert tables.versions(spark, layer) == [f"{layer}__000001"]
    assert published(spark, layer) == {"a": [(1,)]}


def test_plain_tables_are_taken_over(spark, layer):
    for name in ("a", "b", "dictionary"):
        tables.write_table(one(spark, 1), layer, name)
    with tables.publication(spark, layer) as new:
        new.write(one(spark, 2), "a")
    assert published(spark, layer) == {"a": [(2,)], "b": [(1,)], "dictionary": [(1,)]}
    with tables.publication(spark, layer, whole=True) as new:
        new.write(one(spark, 3), "a")
        new.keep("dictionary")
    assert published(spark, layer) == {"a": [(3,)], "dictionary": [(1,)]}
    assert rows_of(tables.manifest(spark, layer).select("table_name", "rows")) == [("a", 1)]
