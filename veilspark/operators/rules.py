"""De-identification rules: `type->expression` text compiled to Spark columns.

An expression is Spark SQL over the parsed cell, which it calls `x` or by the name
of its own column. Only the functions and words listed below are accepted, so a
rule can neither read other columns nor run a sub-query. All rules of a dataset
are evaluated in one projection.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from veilspark.columns import OK, WARNING
from veilspark.functions.parsing import parse_sql, quoted, render_sql

# Words a rule may use besides its own column (fixed values).
ALLOWED_WORDS = frozenset(
    """
    abs add_months and as between bigint bround cast case ceil coalesce concat date date_add
    date_format date_sub date_trunc dayofmonth dayofweek decimal div double else end false floor
    greatest if in int is last_day least left length like log log10 lower lpad ltrim make_date
    mod month months_between not null nullif or overlay pmod pow power quarter regexp_extract
    regexp_replace repeat replace reverse right round rpad rtrim sign sqrt string substr
    substring then to_date translate trim true trunc try_cast upper weekofyear when width_bucket
    year
    """.split()
)

# A backslash could end a literal elsewhere than it seems to, so literals have none.
_TOKEN = re.compile(
    r"(?P<text>'(?:[^'\\]|'')*')|(?P<word>[^\W\d]\w*)|(?P<rest>[\d.]+(?:[eE][+-]?\d+)?"
    r"|<=|>=|<>|!=|==|\|\||[-+*/%(),<>=]|\s+)"
)


class RuleError(ValueError):
    """A rule that cannot be applied."""


@dataclass(frozen=True)
class Rule:
    """One column, the type its cells are read as, and the expression that replaces them."""

    column: str
    kind: str
    expression: str

    @classmethod
    def parse(cls, column: str, text: str) -> Rule:
        kind, arrow, expression = text.partition("->")
        if not arrow or not expression.strip():
            raise RuleError(f"{column}: expected 'type->expression', got {text!r}")
        return cls(column, kind.strip(), expression.strip())

    def bind(self, parsed: str, context: Sequence[str] = ()) -> str:
        """The expression with its own column replaced by `parsed`, every word checked."""
        own = {"x", self.column.lower()}
        known = {name.lower() for name in context}
        if "--" in self.expression or "/*" in self.expression:
            raise RuleError(f"{self.column}: comments are not allowed in {self.expression!r}")
        out, position = [], 0
        while position < len(self.expression):
            token = _TOKEN.match(self.expression, position)
            if not token:
                raise RuleError(f"{self.column}: unexpected text at {self.expression[position:]!r}")
            word = token["word"]
            called = self.expression[token.end() :].lstrip().startswith("(")
            if word and word.lower() in own and not (called and word.lower() in ALLOWED_WORDS):
                out.append(parsed)
            elif word and word.lower() not in ALLOWED_WORDS | known:
                raise RuleError(f"{self.column}: {word!r} is not allowed in a rule")
            else:
                out.append(token.group())
            position = token.end()
        return "".join(out)


def bin_numbers(column: str, width: float, kind: str = "Int64") -> Rule:
    """Lower bound of the bin of `width` that holds the number."""
    return Rule(column, kind, f"floor(x / {width}) * {width}")


def truncate_dates(column: str, unit: str = "YEAR") -> Rule:
    """First day of the year, quarter, month or week."""
    return Rule(column, "date", f"trunc(x, '{unit}')")


def mask_text(column: str, keep: int, mark: str = "*") -> Rule:
    """Keep the first characters and replace each later one."""
    mark = mark.replace("'", "''")
    return Rule(
        column,
        "string",
        f"concat(left(x, {keep}), repeat('{mark}', greatest(length(x) - {keep}, 0)))",
    )


def shift_dates(column: str, by: str = "rnd") -> Rule:
    """Move dates by the number of days in column `by`, which has to be in the rule context."""
    return Rule(column, "date", f"date_add(x, cast(floor(cast({by} as double)) as int))")


def map_codes(column: str, codes: Mapping[str, str], otherwise: str | None = None) -> Rule:
    """Replace codes by group codes; codes not listed become `otherwise`, or stay."""

    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    cases = " ".join(f"when {literal(old)} then {literal(new)}" for old, new in codes.items())
    rest = "x" if otherwise is None else literal(otherwise)
    return Rule(column, "string", f"case x {cases} else {rest} end")


def rules_from_rows(rows: DataFrame, limit: int = 10_000) -> list[Rule]:
    """Rules of one dataset from `var_cd`, `di_set_val` rows.

    A dataset has at most one rule per column, so the rows become part of the plan;
    more than `limit` of them means the rows were not restricted to one dataset.
    """
    found = rows.filter("di_set_val IS NOT NULL").select("var_cd", "di_set_val").distinct()
    found = found.orderBy("var_cd", "di_set_val").limit(limit + 1).collect()
    if len(found) > limit:
        raise RuleError(f"more than {limit} rules; restrict the rows to one dataset")
    return [Rule.parse(row.var_cd, row.di_set_val) for row in found]


def _usable(df: DataFrame, rules: Iterable[Rule], missing_column: str) -> list[Rule]:
    if missing_column not in ("error", "skip"):
        raise ValueError("missing_column is 'error' or 'skip'")
    present = {name.lower() for name in df.columns}
    usable: dict[str, Rule] = {}
    for rule in rules:
        name = rule.column.lower()
        if name not in present:
            if missing_column == "error":
                raise RuleError(f"column {rule.column} of a rule is not in the data")
        elif name in usable:
            raise RuleError(f"column {rule.column} has two rules and no order between them")
        else:
            usable[name] = rule
    return list(usable.values())


def _evaluated(
    df: DataFrame, rules: Sequence[Rule], context: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """`df` with the parsed cell of rule i as `_cell_i`, and per rule its result as SQL text."""
    cells = [parse_sql(r.kind, quoted(r.column)) + f" AS _cell_{i}" for i, r in enumerate(rules)]
    parsed = df.selectExpr("*", *cells)
    bound = [f"({r.bind(f'_cell_{i}', context)})" for i, r in enumerate(rules)]
    types = parsed.selectExpr(*[f"{text} AS _{i}" for i, text in enumerate(bound)]).schema
    return parsed, [render_sql(text, field.dataType) for text, field in zip(bound, types)]


def apply_rules(
    df: DataFrame,
    rules: Iterable[Rule],
    on_invalid: str = "suppress",
    missing_column: str = "error",
    context: Sequence[str] = (),
) -> DataFrame:
    """Replace the cells of every ruled column; other columns and the order stay.

    `on_invalid` says what becomes of a cell that cannot be parsed or whose rule
    gives null: `suppress` empties it, `keep` leaves the raw value, `fail` stops the
    job on a cell that cannot be parsed. `context` names further columns that rules
    may read. A rule for an absent column is an error unless `missing_column` is
    `skip`.
    """
    if on_invalid not in ("suppress", "keep", "fail"):
        raise ValueError("on_invalid is 'suppress', 'keep' or 'fail'")
    rules = _usable(df, rules, missing_column)
    parsed, results = _evaluated(df, rules, context)
    changed = {}
    for i, (rule, result) in enumerate(zip(rules, results)):
        raw = quoted(rule.column)
        if on_invalid == "keep":
            result = f"coalesce({result}, {raw})"
        elif on_invalid == "fail":
            message = f"raise_error('cell of rule {i} does not fit its type')"
            broken = f"{raw} IS NOT NULL AND _cell_{i} IS NULL"
            result = f"CASE WHEN {broken} THEN {message} ELSE {result} END"
        changed[rule.column.lower()] = result
    return parsed.selectExpr(
        *[f"{changed.get(name.lower(), quoted(name))} AS {quoted(name)}" for name in df.columns]
    )


def deid_report(
    df: DataFrame,
    rules: Iterable[Rule],
    by: Sequence[str] = (),
    missing_column: str = "error",
    context: Sequence[str] = (),
) -> DataFrame:
    """Null, failed and replaced cells per ruled column (and per `by`), in one aggregation.

    The status is a warning unless every cell was replaced.
    """
    rules = _usable(df, rules, missing_column)
    parsed, results = _evaluated(df, rules, context)
    cells, counts, lines = [], ["count(1) AS _rows"], []
    for i, (rule, result) in enumerate(zip(rules, results)):
        raw = quoted(rule.column)
        cells += [f"{raw} AS _raw_{i}", f"CASE WHEN {raw} IS NOT NULL THEN {result} END AS _new_{i}"]
        counts += [f"count(_raw_{i}) AS _given_{i}", f"count(_new_{i}) AS _done_{i}"]
        name = rule.column.replace("'", "''")
        lines.append(
            f"named_struct('var_cd', '{name}', 'n_null', _rows - _given_{i},"
            f" 'n_failed', _given_{i} - _done_{i}, 'n_done', _done_{i})"
        )
    clean = (F.col("n_null") == 0) & (F.col("n_failed") == 0)
    return (
        parsed.selectExpr(*[quoted(name) for name in by], *cells)
        .groupBy(*by)
        .agg(*[F.expr(count) for count in counts])
        .selectExpr(*[quoted(name) for name in by], f"inline(array({', '.join(lines)}))")
        .withColumn("status", F.when(clean, OK).otherwise(WARNING))
    )


def apply_rules_with_states(
    df: DataFrame,
    rules: Iterable[Rule],
    on_invalid: str = "suppress",
    missing_column: str = "error",
    context: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """As `apply_rules`, with a column `_state_<i>` behind the others for each rule, and the rules' columns in that order.

    So rows and report come of one evaluation: what became of a cell is stored with its row, as 0 null, 1 not parsed and
    emptied, 2 emptied, 3 replaced, 4 not parsed and replaced. `fail` leaves such cells to `checked_states`.
    """
    if on_invalid not in ("suppress", "keep", "fail"):
        raise ValueError("on_invalid is 'suppress', 'keep' or 'fail'")
    rules = _usable(df, rules, missing_column)
    parsed, results = _evaluated(df, rules, context)
    changed, states = {}, []
    for i, (rule, result) in enumerate(zip(rules, results)):
        raw = quoted(rule.column)
        changed[rule.column.lower()] = f"coalesce({result}, {raw})" if on_invalid == "keep" else result
        failed, done = (f"if(_cell_{i} IS NULL, {broken}, {sound})" for broken, sound in ((1, 2), (4, 3)))
        states.append(f"cast(CASE WHEN {raw} IS NULL THEN 0 WHEN ({result}) IS NULL THEN {failed} ELSE {done} END AS tinyint) AS _state_{i}")
    cells = [f"{changed.get(name.lower(), quoted(name))} AS {quoted(name)}" for name in df.columns]
    return parsed.selectExpr(*cells, *states), [rule.column for rule in rules]


def checked_states(df: DataFrame, columns: Sequence[str], on_invalid: str) -> DataFrame:
    """Rows of `apply_rules_with_states` without their states; with `fail` a cell that wasn't parsed raises."""
    states = [f"_state_{i}" for i in range(len(columns))]
    if on_invalid == "fail":
        given = {name.lower(): name for name in df.columns}
        for i, name in enumerate(given[column.lower()] for column in columns):
            message = F.raise_error(F.lit(f"cell of rule {i} does not fit its type")).cast(df.schema[name].dataType)
            df = df.withColumn(name, F.when(F.col(states[i]).isin(1, 4), message).otherwise(F.col(quoted(name))))
    return df.drop(*states)


def report_of_states(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What `deid_report` gives, counted from the states that are stored with the rows."""
    counts = [F.count(F.lit(1)).alias("_rows")]
    lines = []
    for i, column in enumerate(columns):
        state = F.col(f"_state_{i}")
        counts += [F.count_if(state == 0).alias(f"_null_{i}"), F.count_if(state >= 3).alias(f"_done_{i}")]
        name = column.replace("'", "''")
        lines.append(
            f"named_struct('var_cd', '{name}', 'n_null', _null_{i},"
            f" 'n_failed', _rows - _null_{i} - _done_{i}, 'n_done', _done_{i})"
        )
    clean = (F.col("n_null") == 0) & (F.col("n_failed") == 0)
    return (
        df.groupBy(*by)
        .agg(*counts)
        .selectExpr(*[quoted(name) for name in by], f"inline(array({', '.join(lines)}))")
        .withColumn("status", F.when(clean, OK).otherwise(WARNING))
    )
