import pytest
from pyspark.sql import functions as F

from rollcall.plans import load
from rollcall.sources import files, tables
from tests.conftest import rows_of


def write(root, relative, *lines):
    path = root / relative
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n" if lines else "")
    return path


@pytest.fixture
def upload(tmp_path):
    root = tmp_path / "up load+1"
    write(root, "2022-23/attendance_2022-23.csv", "K,V,OLD", "1,TFS,x", '2,"a,b",')
    write(root, "2023-24/Attendance 2023+24.csv", "V,K,#NEW/COL", "9,3,n")
    write(root, "2023-24/Exports/SAT_Highest_2023-24_2024-10-01.csv", "A", "1")
    write(root, "2023-24/notes.txt", "no")
    write(root, "2023-24/UPPER.CSV", "A", "1")
    write(root, "2023-24/Other/x.csv", "A", "1")
    write(root, "top.csv", "A", "1")
    write(root, "data_dictionary/dd.csv", "Column Name,Size", "a,1", "b,2")
    return root


def test_catalog_lists_reports_only(spark, upload):
    got = rows_of(files.file_catalog(spark, str(upload)).select("file_name", "source_year"))
    assert got == [
        ("Attendance 2023+24.csv", "2023-24"),
        ("SAT_Highest_2023-24_2024-10-01.csv", "2023-24"),
        ("attendance_2022-23.csv", "2022-23"),
    ]


def test_groups(spark, upload):
    catalog = files.file_catalog(spark, str(upload))
    assert rows_of(files.group_files_by_type(catalog)) == [
        ("attendance", 2, "2022-23", "2023-24"),
        ("sat_highest", 1, "2023-24", "2023-24"),
    ]
    assert rows_of(files.file_pattern_profile(catalog).select("pattern", "files"))[0][1] == 1
    assert sorted(files.paths_by_type(catalog)) == ["attendance", "sat_highest"]


def test_raw_read_follows_names_over_header_drift(spark, upload):
    paths = files.paths_by_type(files.file_catalog(spark, str(upload)))["attendance"]
    assert len(files.header_groups(spark, paths)) == 2
    df = files.read_raw_csv(spark, paths, str(upload))
    assert set(df.columns) == {"K", "V", "OLD", "#NEW/COL", "source_year", "source_file"}
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    got = rows_of(df.select("K", "V", "OLD", "`#NEW/COL`", "source_year", "source_file"))
    assert got == [
        ("1", "TFS", "x", None, "2022-23", "attendance_2022-23.csv"),
        ("2", "a,b", None, None, "2022-23", "attendance_2022-23.csv"),
        ("3", "9", None, "n", "2023-24", "Attendance 2023+24.csv"),
    ]


def test_dictionary_types_are_inferred(spark, upload):
    df = files.read_with_inference(spark, str(upload / "data_dictionary" / "*.csv"))
    assert df.dtypes == [("Column Name", "string"), ("Size", "int")]


def test_layer_tables(spark, tmp_path):
    layer = "layer_test"
    tables.ensure_schema(spark, layer, str(tmp_path / "layer"))
    df = spark.createDataFrame([("2022", "x"), ("2023", None)], "source_year string, `#RPT NAME` string")
    assert tables.write_table(df, layer, "a") == 2
    assert tables.write_table(df.limit(1), layer, "a") == 1
    assert tables.table_scan(spark, layer, "a").columns == ["source_year", "#RPT NAME"]
    # Same schema passes, another one is refused and leaves the table alone.
    assert tables.write_table(df, layer, "a", on_schema_change="fail") == 2
    with pytest.raises(tables.SchemaChanged):
        tables.write_table(df.withColumn("v", F.lit(1)), layer, "a", on_schema_change="fail")
    assert tables.write_table(df.select("source_year"), layer, "b") == 2
    assert tables.write_table(df.withColumn("v", F.lit(1)), layer, "b") == 2
    with pytest.raises(ValueError):
        tables.write_table(df, layer, "a", on_schema_change="merge")
    assert rows_of(tables.list_layer(spark, layer)) == [(layer, "a"), (layer, "b")]
    assert rows_of(tables.layer_summary(spark, layer)) == [("(all)", 4, None), ("a", 2, 2), ("b", 2, 2)]
    assert rows_of(tables.read_back(spark, layer, "b")) == [("layer_test.b", 2, 3)]
    assert tables.reset_layer(spark, layer) == ["a", "b"]
    assert tables.layer_tables(spark, layer) == []
    assert tables.layer_summary(spark, layer).count() == 0
    spark.sql(f"DROP SCHEMA {layer}")


PLACE = "LONG_SCHOOL_YEAR,DETAIL_LVL_DESC,SCHOOL_DSTRCT_CD,SCHOOL_DSTRCT_NM,INSTN_NUMBER,INSTN_NAME,GRADES_SERVED_DESC"
TEST = (
    "LONG_SCHOOL_YEAR,SCHOOL_DISTRCT_CD,SCHOOL_DSTRCT_NM,INSTN_NUMBER,INSTN_NAME,ACDMC_LVL,SUBGROUP_NAME,"
    "TEST_CMPNT_TYP_NM,NUM_TESTED_CNT,BEGIN_CNT,DEVELOPING_CNT,PROFICIENT_CNT,DISTINGUISHED_CNT,"
    "BEGIN_PCT,DEVELOPING_PCT,PROFICIENT_PCT,DISTINGUISHED_PCT"
)
SCORES = (
    "LONG_SCHOOL_YEAR,{d},SCHOOL_DSTRCT_NM,INSTN_NUMBER,INSTN_NAME,SUBGRP_DESC,TEST_CMPNT_TYP_CD,"
    "INSTN_NUM_TESTED_CNT,INSTN_AVG_SCORE_VAL,#ASSMT_CD"
)


def reports(root):
    """A small upload with every report type the model reads."""
    a, b = "2022-23", "2023-24"
    school = "2023-24,School,601,Appling,0103,High,\"09,10\""
    write(root, f"{a}/Enrollment_by_Grade_2022-23.csv", f"{PLACE},ENROLLMENT_PERIOD,GRADE_LEVEL,ENROLLMENT_COUNT",
          '2022-23,School,601,Appling,0103,Old High,"09,10",Fall,9th,100')
    grade = [f"{school},Fall,9th,120", "2023-24,District,601,Appling,ALL,,,Fall,9th,120",
             "2023-24,State,ALL,State,ALL,,,Fall,9th,TFS"]
    header = f"{PLACE},ENROLLMENT_PERIOD,GRADE_LEVEL,ENROLLMENT_COUNT"
    write(root, f"{b}/Enrollment_by_Grade_2023-24.csv", header, *grade)
    write(root, f"{b}/Exports/Enrollment_by_Grade_2023-24_2024-10-01.csv", header, *grade)
    write(root, f"{b}/Dropout_Rate.csv", f"{PLACE},LABEL_LVL_1_DESC,PROGRAM_TOTAL,PROGRAM_PERCENT",
          f"{school},9-12 Drop Outs -Black,3,1.5", f"{school},7-12 Drop Outs -ALL Students,TFS,TFS")
    write(root, f"{b}/4-Year_Graduation.csv", f"{PLACE},LABEL_LVL_1_DESC,PROGRAM_TOTAL,PROGRAM_PERCENT,TOTAL_COUNT",
          f"{school},Grad Rate -All Students,90,90.0,100")
    write(root, f"{b}/Certified_Personnel.csv",
          f"{PLACE},DATA_CATEGORY,DATA_SUB_CATEGORY,EMPLOYEE_TYPE,MEASURE,#RPT_NAME",
          f"{school},Gender,Female,Teachers,12.5,Personnel")
    write(root, f"{b}/EOG_by_x.csv", "ignored", "1")
    write(root, f"{b}/EOG-2024.csv", TEST,
          "2023-24,601,Appling,0103,High,05,All Students,Math,100,10,20,30,40,10,20,30,40",
          "2023-24,601,Appling,0103,High,,Black,Math,TFS,TFS,TFS,TFS,TFS,TFS,TFS,TFS,TFS")
    write(root, f"{b}/EOC-2024.csv", TEST,
          "2023-24,601,Appling,0103,High,09,All Students,Algebra,50,5,10,15,20,10,20,30,40")
    write(root, f"{b}/ACT-2024.csv", SCORES.format(d="SCHOOL_DSTRCT_CD") + ",HIGHEST_RECENT_IND",
          "2023-24,601,Appling,0103,High,All Students,Composite,15.0,21.5,01,Highest")
    write(root, f"{a}/ACT_Highest_2022.csv", SCORES.format(d="SCHOOL_DISTRCT_CD"),
          "2022-23,601,Appling,0103,High,All Students,Composite,TFS,20.5,01")
    write(root, f"{a}/SAT_Highest_2022.csv", SCORES.format(d="SCHOOL_DISTRCT_CD"),
          "2022-23,601,Appling,0103,High,All Students,Combined Test Score,20.5,1010,02")
    write(root, f"{b}/sat_2023-24.csv", SCORES.format(d="SCHOOL_DISTRCT_CD") + ",HIGHEST_RECENT_IND",
          "2023-24,,,0103,High,All Students,Combined Test Score,N/A,1020,02,Recent",
          "2023-24,,,0999,Lost,All Students,Combined,TFS,1020,02,Recent")
    old = "SCHOOL_YEAR,DISTRICT_CODE,DISTRICT_NAME,SCHOOL_CODE,SCHOOL_NAME,Dollars per FTE"
    tail = "Revenues/Expenditures,Description,REV_EXP_VALUE,GRADES_SERVED_DESC"
    write(root, f"{a}/Revenues_Old.csv", f"{old},{tail}", "2022-23,601,Appling,0103,High,10.5,Revenues,Local,1000,",
          ",,,,,,Revenues,Local,5,")
    new = "LONG_SCHOOL_YEAR,SCHOOL_DSTRCT_CD,SCHOOL_DSTRCT_NM,INSTN_NUMBER,INSTN_NAME,DOLLARS_PER_FTE,#RPT_NAME"
    write(root, f"{b}/Revenues_New.csv", f"{new},{tail}",
          "2023-24,601,Appling,0103,High,11.5,Finance,Expenditures,Staff,-20.25,\"09,10\"",
          "2023-24,ALL,State,ALL,State,1,Finance,Expenditures,Staff,7,")
    direct = "FISCAL_YEAR,SYSTEM_ID,SYSTEM_NAME,Direct_Cert_Perc,K12_POVERTY_STUDENT_CT,K12_STUDENT_COUNT"
    write(root, f"{b}/FY24_directly_certified_district.csv", f"{direct},*Note: x", "2024.0,601.0,Appling,30.25,10,20,j")
    write(root, f"{b}/FY24_directly_certified_school.csv", f"{direct},SCHOOL_ID,SCHOOL_NAME",
          "2024,601,Appling,TFS,TFS,20,103.0,High", ",601,Appling,1,1,1,1,No year")


def test_full_load(spark, tmp_path):
    root = tmp_path / "upload"
    reports(root)
    layers = {n: f"{n}_it" for n in ("bronze", "silver", "gold")}
    for layer in layers.values():
        tables.ensure_schema(spark, layer, str(tmp_path / layer))
    raw = load.load_bronze(spark, str(root), layers["bronze"])
    assert raw["enrollment_by_grade"] == 7 and raw["sat"] == 2 and raw["eog"] == 2
    typed = load.load_silver(spark, bronze=layers["bronze"], silver=layers["silver"])
    # Attendance and subgroup enrollment have no files here and are left out.
    assert typed == {
        "certified_personnel": 1, "dropout_rate": 2, "enrollment_by_grade": 4, "eoc": 1, "eog": 2,
        "graduation_rate": 1, "revenues": 3, "act": 2, "sat": 3, "direct_certification": 2,
    }

    def silver(name):
        return tables.table_scan(spark, layers["silver"], name)

    got = rows_of(silver("sat").select("institution_key", "sat_format", "highest_recent_indicator"))
    assert got == [("601_0103", "new", "Highest"), ("601_0103", "new", "Recent"), ("Lost", "old", "Recent")]
    got = rows_of(silver("act").select("school_year", "institution_key", "institution_num_tested"))
    assert got == [("2022-23", "601_0103", None), ("2023-24", "601_0103", 15)]
    columns = ("school_year", "fiscal_year", "institution_key", "direct_cert_percent", "detail_level")
    got = [tuple(map(str, r)) for r in rows_of(silver("direct_certification").select(*columns))]
    assert got == [
        ("2023-24", "2024", "601_103", "None", "School"),
        ("2023-24", "2024", "601_ALL", "30.3", "District"),
    ]
    got = rows_of(silver("revenues").select("detail_level", "amount", "amount_per_fte", "report_name"))
    assert got == [
        ("School", -20.25, 11.5, "Finance"),
        ("School", 1000.0, 10.5, "Revenues_Old.csv"),
        ("State", 7.0, 1.0, "Finance"),
    ]

    gold = load.load_gold(spark, silver=layers["silver"], gold=layers["gold"])
    assert gold == {
        "dim_year": 2, "dim_school": 3, "dim_subgroup": 2, "dim_assessment": 8, "fact_dropout": 2,
        "fact_enrollment_by_grade": 2, "fact_graduation": 1, "fact_revenues": 2,
        "fact_school_performance": 8, "fact_staffing": 1,
    }
    schools = tables.table_scan(spark, layers["gold"], "dim_school")
    assert rows_of(schools.select("school_key", "institution_key", "institution_name")) == [
        (1, "601_0103", "High"),
        (2, "601_ALL", None),
        (3, "ALL_ALL", None),
    ]
    performance = tables.table_scan(spark, layers["gold"], "fact_school_performance")
    got = rows_of(performance.filter("avg_score > 100").select("school_key", "proficiency_rate", "avg_score"))
    assert got == [(1, None, 1010.0), (1, None, 1020.0), (None, None, 1020.0)]
    assert performance.filter("assessment_key IS NULL").count() == 0

    reports_by_table = load.validate(spark, layers["silver"], layers["gold"])
    status = {n: {(r.check, r.status) for r in df.collect()} for n, df in reports_by_table.items()}
    assert ("key_unique", "pass") in status["eog"]
    assert ("null_fk", "fail") in status["fact_school_performance"]
    # A second load gives the same keys.
    before = rows_of(schools)
    load.load_gold(spark, silver=layers["silver"], gold=layers["gold"])
    assert rows_of(tables.table_scan(spark, layers["gold"], "dim_school")) == before
    for layer in layers.values():
        spark.sql(f"DROP SCHEMA {layer} CASCADE")
