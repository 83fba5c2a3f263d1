"""Tolerant parsing of text cells, and rendering of values back to text.

The functions make Spark SQL text, for use with `F.expr` and `selectExpr`: a dataset
has hundreds of ruled columns, and one text per column keeps building the plan cheap.

Every parser gives null for text it cannot read; it never raises, also under ANSI
mode. The patterns decide what counts as a number or a date, because the engines' own
casts disagree on input such as `1d`, `inf` or `2021011`.
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_TEXT = r"^\d{8}$"
DATE_FORMAT = "yyyyMMdd"
EXACT_LIMIT = "9e15D"  # doubles below this hold every integer exactly


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def _finite(value: str) -> str:
    return f"abs({value}) < double('Infinity')"


def _integral(value: str) -> str:
    return f"abs({value}) < {EXACT_LIMIT} AND {value} = floor({value})"


def _plain(value: str) -> str:
    """A finite double as plain decimals with the digits of its shortest form.

    Decimals hold 38 digits: those of numbers below one behind the point, where the 38th and
    later are rounded off; numbers of 1e38 and more stay in scientific notation.
    """

    def digits(scale: int) -> str:
        text = f"string(try_cast(string({value}) AS decimal(38, {scale})))"
        return f"regexp_replace({text}, r'[.]?0+$', '')" if scale else text

    return (
        f"CASE WHEN abs({value}) < 1 THEN {digits(37)} WHEN abs({value}) < {EXACT_LIMIT} THEN {digits(20)}"
        f" ELSE coalesce({digits(0)}, string({value})) END"
    )


def float_sql(cell: str) -> str:
    """Double, or null where the text is no finite decimal number."""
    value = f"try_cast({cell} AS double)"
    return f"CASE WHEN {cell} RLIKE r'{NUMBER_TEXT}' AND {_finite(value)} THEN {value} END"


def int_sql(cell: str) -> str:
    """Bigint; text such as `12.0` or `1e3` counts, `12.5` does not.

    The cast reads plain digits, so only other text meets the number pattern.
    """
    value = f"try_cast({cell} AS double)"
    other = f"CASE WHEN {cell} RLIKE r'{NUMBER_TEXT}' AND {_integral(value)} THEN bigint({value}) END"
    return f"coalesce(try_cast({cell} AS bigint), {other})"


def date_sql(cell: str) -> str:
    """Date from exactly eight digits that name a day of the calendar."""
    iso = f"concat_ws('-', substr({cell}, 1, 4), substr({cell}, 5, 2), substr({cell}, 7, 2))"
    return f"CASE WHEN {cell} RLIKE r'{DATE_TEXT}' THEN try_cast({iso} AS date) END"


def parse_sql(kind: str, cell: str) -> str:
    """Parse by rule type: `Int64`, `date`, `string`; any other name is a float."""
    if kind == "Int64":
        return int_sql(cell)
    if kind == "date":
        return date_sql(cell)
    return cell if kind == "string" else float_sql(cell)


def render_sql(value: str, data_type: T.DataType) -> str:
    """Value as text: dates as eight digits, whole numbers without decimals, no NaN or infinity."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"date_format({value}, '{DATE_FORMAT}')"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = f"double({value})"
        return (
            f"CASE WHEN {_integral(value)} THEN string(bigint({value}))"
            f" WHEN {_finite(value)} THEN {_plain(value)} END"
        )
    if isinstance(data_type, T.DecimalType):
        return f"regexp_replace(string({value}), r'\\.0+$', '')"
    return f"string({value})"


def shift_sql(cell: str, days: str) -> str:
    """Move a yyyyMMdd cell by a possibly fractional number of days.

    The time of day is dropped, so half a day back lands on the day before. `0`
    becomes eight zeros; anything that cannot be shifted becomes empty text.
    """
    moved = f"date_add({date_sql(cell)}, int(floor(double({days}))))"
    rest = f"CASE WHEN {cell} = '0' THEN '00000000' ELSE '' END"
    return f"coalesce(date_format({moved}, '{DATE_FORMAT}'), {rest})"
