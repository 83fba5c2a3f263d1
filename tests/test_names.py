import pytest
from pyspark.sql import functions as F

from veilspark.functions.names import output_name, parse_file_name
from veilspark.operators.checks import check_file_names

LONG = "IF_DL_504_2019A0031_B0001_HN17_ALL_1_1_20210201120000000.txt"
PAGED = "IF_DL_502_201900082_A0001_TWJHC200_89_144_20210226.txt"


def parsed(spark, name):
    return spark.createDataFrame([(name,)], "n string").select(parse_file_name(F.col("n"))).first()[0]


def test_parts(spark):
    assert tuple(parsed(spark, PAGED)) == ("502", "2019-00082", "A0001", "TWJHC200", 89, 144, "20210226")
    assert tuple(parsed(spark, LONG)) == ("504", "2019-A0031", "B0001", "HN17_ALL", 1, 1, "20210201")


@pytest.mark.parametrize("name", ["", "notes.txt", PAGED.replace(".txt", ".csv"), "x" + PAGED, None])
def test_other_names(spark, name):
    assert parsed(spark, name) is None


@pytest.mark.parametrize(
    "stage, name",
    [
        ("key", f"IF_DL_302_{LONG}"),
        ("provider", "IF_DL_504_2019A0031_B0001_HN17_1_1_20210201.txt"),
        ("original", LONG),
        ("deid", "IF_DL_802_2019A0031_B0001_HN17_1_1_20210201.txt"),
        ("summary", "IF_DL_502_2019A0031_B0001_HN17_S_1_1_20210201.txt"),
        ("deid_summary", "IF_DL_802_2019A0031_B0001_HN17_S_12_1_1_20210201.txt"),
    ],
)
def test_output_names(spark, stage, name):
    df = spark.createDataFrame([(LONG,)], "n string")
    out = output_name(F.col("n"), stage, F.lit("K0002"), F.lit("HN17"), F.lit(12))
    assert df.select(out).first()[0] == name


def test_unknown_stage(spark):
    with pytest.raises(ValueError):
        output_name(F.col("n"), "other", F.lit("K0002"), F.lit("HN17"))


def test_pages_compare_as_numbers(spark):
    register = spark.createDataFrame(
        [("2019-00082", "A0001", "K0002", "TWJHC200", name)
         for name in (PAGED, PAGED.replace("_89_", "_145_"), PAGED.replace("502", "501"), "odd.txt")],
        "ask_id string, rshp_id string, prvdr_cd string, cat_cd string, file_nm string",
    )
    rows = {row.file_nm: row for row in check_file_names(register).collect()}
    assert rows[PAGED].valid
    assert not rows[PAGED.replace("_89_", "_145_")].page_ok
    assert not rows[PAGED.replace("502", "501")].interface_ok
    assert not rows["odd.txt"].valid
