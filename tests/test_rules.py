import pytest
from pyspark.sql import functions as F

from veilspark.operators.rules import (
    Rule,
    RuleError,
    apply_rules,
    apply_rules_with_states,
    bin_numbers,
    checked_states,
    deid_report,
    map_codes,
    mask_text,
    report_of_states,
    rules_from_rows,
    truncate_dates,
)


@pytest.fixture
def cells(spark):
    rows = [("a", "123", "20210517"), ("b", "x", "20210230"), ("c", None, ""), ("d", "-999", None)]
    return spark.createDataFrame(rows, "id string, amt string, day string")


RULES = [Rule.parse("amt", "Int64->floor(amt / 100) * 100"), truncate_dates("day")]


def result(df):
    return [tuple(row) for row in df.orderBy("id").collect()]


def test_suppress_leaves_no_raw_value(cells):
    assert result(apply_rules(cells, RULES)) == [
        ("a", "100", "20210101"), ("b", None, None), ("c", None, None), ("d", "-1000", None),
    ]


def test_keep_leaves_cells_that_do_not_parse(cells):
    assert result(apply_rules(cells, RULES, on_invalid="keep")) == [
        ("a", "100", "20210101"), ("b", "x", "20210230"), ("c", None, ""), ("d", "-1000", None),
    ]


def test_fail_stops_the_job(cells):
    with pytest.raises(Exception, match="does not fit its type"):
        apply_rules(cells, RULES, on_invalid="fail").collect()
    clean = cells.filter("id = 'a'")
    assert result(apply_rules(clean, RULES, on_invalid="fail")) == [("a", "100", "20210101")]


def test_rule_that_gives_null(cells):
    rule = [Rule.parse("amt", "string->nullif(x, '123')")]
    assert result(apply_rules(cells, rule))[0][1] is None
    assert result(apply_rules(cells, rule, on_invalid="keep"))[0][1] == "123"


def test_report(cells):
    report = {row.var_cd: tuple(row)[1:] for row in deid_report(cells, RULES).collect()}
    assert report == {"amt": (1, 1, 2, "003"), "day": (1, 2, 1, "003")}
    clean = deid_report(cells.filter("id = 'a'"), RULES)
    assert {row.status for row in clean.collect()} == {"002"}


def test_floats_and_whole_numbers(cells):
    rule = [Rule.parse("amt", "float->x / 2")]
    assert [row[1] for row in result(apply_rules(cells, rule))] == ["61.5", None, None, "-499.5"]
    assert result(apply_rules(cells, [bin_numbers("amt", 100, "float")]))[0][1] == "100"


def test_text_helpers(spark):
    df = spark.createDataFrame([("O'Neil", "F")], "name string, sex string")
    rules = [mask_text("name", 2), map_codes("sex", {"F": "it's", "M": "m"})]
    assert apply_rules(df, rules).first() == ("O'****", "it's")


@pytest.mark.parametrize(
    "text",
    [
        "string->(select max(c) from t)",
        "string->other",
        "string->java_method('java.lang.System', 'exit')",
        "string->reflect('a', 'b')",
        "string->x -- comment",
        "string->x /* comment */",
        "string->`other`",
        "string->t.other",
        "string->input_file_name()",
        "string->x; drop table t",
        r"string->concat('\', x, ' || other || ')",
    ],
)
def test_rules_reach_nothing_else(spark, text):
    df = spark.createDataFrame([("1", "2")], "c string, other string")
    with pytest.raises(RuleError):
        apply_rules(df, [Rule.parse("c", text)])


def test_names_in_literals_are_text(spark):
    df = spark.createDataFrame([("v",)], "c string")
    assert apply_rules(df, [Rule.parse("c", "string->concat(x, ' x c select')")]).first()[0] == "v x c select"


def test_context_columns_are_opt_in(spark):
    df = spark.createDataFrame([("20210101", "2.5")], "d string, rnd string")
    rule = [Rule.parse("d", "date->date_add(x, cast(floor(cast(rnd as double)) as int))")]
    with pytest.raises(RuleError):
        apply_rules(df, rule)
    assert apply_rules(df, rule, context=["rnd"]).first()[0] == "20210103"


def test_missing_and_repeated_columns(cells):
    with pytest.raises(RuleError):
        apply_rules(cells, [Rule.parse("gone", "string->x")])
    assert apply_rules(cells, [Rule.parse("gone", "string->x")], missing_column="skip").count() == 4
    with pytest.raises(RuleError):
        apply_rules(cells, [Rule.parse("amt", "string->x"), Rule.parse("AMT", "Int64->x")])


def test_malformed_rule():
    with pytest.raises(RuleError):
        Rule.parse("c", "floor(x)")


def test_rules_from_rows(spark):
    rows = spark.createDataFrame(
        [("b", "string->x"), ("a", "Int64->x"), ("c", None)], "var_cd string, di_set_val string"
    )
    assert rules_from_rows(rows) == [Rule("a", "Int64", "x"), Rule("b", "string", "x")]
    with pytest.raises(RuleError):
        rules_from_rows(rows, limit=1)


def test_rules_stay_in_generated_code(cells):
    plan = apply_rules(cells.filter(F.col("id") != "z"), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "BatchEval" not in plan


def test_columns_may_be_named_like_functions_or_in_other_letters(spark):
    df = spark.createDataFrame([("20210517", "1.5", "7")], "year string, left string, `나이` string")
    rules = [Rule.parse("year", "date->year(x)"), Rule.parse("left", "Float64->left * 2"), Rule.parse("나이", "Int64->나이 + 1")]
    assert tuple(apply_rules(df, rules).first()) == ("2021", "3", "8")
    again = apply_rules(df, [Rule.parse("year", "date->year ( year )")])
    assert again.first().year == "2021"
    with pytest.raises(RuleError, match="not allowed"):
        apply_rules(df, [Rule.parse("left", "Float64->나이 * 2")])


@pytest.mark.parametrize("on_invalid", ["suppress", "keep", "fail"])
def test_states_give_rows_and_report_of_their_own(spark, on_invalid):
    """One evaluation gives what `apply_rules` and `deid_report` give."""
    rules = [Rule.parse("n", "Int64->if(x = 5, null, x + 1)"), Rule.parse("D'x", "string->coalesce(nullif(x, 'a'), 'z')"), Rule.parse("M", "Int64->coalesce(x, -1)")]
    cells = [("1", "a", "1"), ("x", None, "x"), (None, "b", None), ("5", "a", "7")]
    df = spark.createDataFrame([("f" + str(i % 2), *row) for i, row in enumerate(cells)], "f string, n string, `D'x` string, m string")
    found, columns = apply_rules_with_states(df, rules, on_invalid)
    assert columns == ["n", "D'x", "M"]
    report = sorted(map(tuple, deid_report(df, rules, ["f"]).collect()))
    assert sorted(map(tuple, report_of_states(found, columns, ["f"]).collect())) == report
    rows = checked_states(found, columns, on_invalid)
    assert rows.columns == df.columns
    if on_invalid == "fail":
        with pytest.raises(Exception, match="does not fit its type"):
            rows.collect()
        sound = checked_states(found.filter("n is not null and m <> -1"), columns, on_invalid)
        assert sound.count() > 0
    else:
        assert sorted(map(repr, rows.collect())) == sorted(map(repr, apply_rules(df, rules, on_invalid).collect()))
