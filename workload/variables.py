"""Variable catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.operators import catalog, checks
from veilspark.sources.scratch import materialise
from workload.registry import query
from workload.tables import DATASET, Tables

_USING = f"USING ({DATASET}, var_dscr_seq)"


@query(
    f"""
SELECT {DATASET},
 string_agg(coalesce(s.var_cd, c.var_cd), ',' ORDER BY var_dscr_seq) var_cd,
 string_agg(CAST(var_dscr_seq AS VARCHAR), ',' ORDER BY var_dscr_seq) var_dscr_seq
FROM catalog c LEFT JOIN (SELECT var_seq, var_cd FROM standard) s USING (var_seq) GROUP BY ALL""",
    "catalog standard",
)
def catalog_variables(t: Tables) -> DataFrame:
    return catalog.catalog_variables(t.catalog, t.standard)


@query(
    f"""
SELECT {', '.join('c.' + c for c in DATASET.split(', '))}, var_dscr_seq, s.var_cd
FROM catalog c LEFT JOIN standard s
 ON c.var_seq = s.var_seq AND c.prvdr_cd = s.prvdr_cd AND c.cat_cd = s.cat_cd
WHERE org_mrg_tp_cd = '1'""",
    "catalog standard",
)
def dataset_columns(t: Tables) -> DataFrame:
    return catalog.dataset_columns(t.catalog, t.standard)


@query(
    f"""
SELECT {DATASET}, exec_seq, coalesce(s.var_cd, c.var_cd) var_cd, di_set_val
FROM rule JOIN catalog c USING ({DATASET}, var_dscr_seq, org_mrg_tp_cd)
 LEFT JOIN (SELECT var_seq, var_cd FROM standard) s ON c.var_seq = s.var_seq
WHERE di_set_val IS NOT NULL""",
    "rule catalog standard",
)
def resolve_rules(t: Tables) -> DataFrame:
    return catalog.resolve_rules(t.rule, t.catalog, t.standard)


@query(
    f"""
SELECT {DATASET}, exec_seq, c.var_cd, di_set_val
FROM rule r JOIN catalog c {_USING} WHERE c.org_mrg_tp_cd = '1' AND di_set_val IS NOT NULL""",
    "rule catalog",
)
def resolve_original_rules(t: Tables) -> DataFrame:
    return catalog.resolve_original_rules(t.rule, t.catalog)


@query(
    f"""
WITH o AS (SELECT {DATASET}, var_seq, var_dscr_seq FROM summary_catalog WHERE org_mrg_tp_cd = '1'),
s AS (SELECT {DATASET}, var_seq, var_cd FROM summary_catalog WHERE org_mrg_tp_cd = '2')
SELECT {DATASET}, exec_seq, s.var_cd, di_set_val
FROM o LEFT JOIN s USING ({DATASET}, var_seq) JOIN rule r {_USING}
WHERE s.var_cd IS NOT NULL AND di_set_val IS NOT NULL""",
    "summary_catalog",
)
def resolve_summary_rules(t: Tables) -> DataFrame:
    return catalog.resolve_summary_rules(t.rule, _summary_catalog(t))


def _summary_catalog(t: Tables) -> DataFrame:
    """The stored catalog after the merge."""
    made = catalog.build_summary_catalog(t.catalog_before, t.standard, t.known, t.rule)
    return materialise(made, "catalog")


@query("SELECT * FROM summary_variable", "summary_variable")
def summary_variables(t: Tables) -> DataFrame:
    return catalog.summary_variables(t.catalog, t.standard, t.known, t.rule)


@query("SELECT * FROM summary_catalog", "summary_catalog")
def build_summary_catalog(t: Tables) -> DataFrame:
    return catalog.build_summary_catalog(t.catalog_before, t.standard, t.known, t.rule)


_METADATA = f"""
WITH o AS (SELECT {DATASET}, var_seq FROM summary_catalog JOIN rule r {_USING}
 WHERE summary_catalog.org_mrg_tp_cd = '1' AND r.exec_seq = 1),
s AS (SELECT {DATASET}, var_seq, var_dscr_seq, t.var_cd, datatp
 FROM (SELECT * EXCLUDE (var_cd) FROM summary_catalog WHERE org_mrg_tp_cd = '2')
 LEFT JOIN (SELECT var_seq, var_cd, datatp FROM standard) t USING (var_seq)),
m AS (SELECT {DATASET}, max(var_dscr_seq) cnt FROM s GROUP BY ALL),
metadata AS (SELECT {DATASET},
  string_agg(datatp, ',' ORDER BY var_seq) datatp,
  string_agg(var_cd, ',' ORDER BY var_dscr_seq) var_cd,
  string_agg(CAST(var_dscr_seq AS VARCHAR), ',' ORDER BY var_seq) var_dscr_seq, cnt
 FROM o JOIN s USING ({DATASET}, var_seq) JOIN m USING ({DATASET}) GROUP BY {DATASET}, cnt)"""


def _metadata(t: Tables) -> DataFrame:
    run = catalog.rule_set(t.rule, F.lit(1), F.lit(None).cast("int"))
    return catalog.summary_metadata(_summary_catalog(t), t.standard, run)


@query(f"{_METADATA} SELECT * FROM metadata", "summary_catalog")
def summary_metadata(t: Tables) -> DataFrame:
    return _metadata(t)


@query(
    f"""{_METADATA}
SELECT {DATASET}, cnt, CAST(i AS INTEGER) pos, string_split(datatp, ',')[i] datatp,
 string_split(var_cd, ',')[i] var_cd, string_split(var_dscr_seq, ',')[i] var_dscr_seq
FROM metadata, LATERAL (SELECT unnest(range(1, len(string_split(datatp, ',')) + 1)) i)""",
    "summary_catalog",
)
def split_metadata(t: Tables) -> DataFrame:
    return catalog.split_metadata(_metadata(t))


@query(
    f"SELECT {DATASET}, var_dscr_seq, di_set_val FROM rule WHERE exec_seq = coalesce(2, 1)", "rule"
)
def rule_set_override(t: Tables) -> DataFrame:
    return catalog.rule_set(t.rule, F.lit(1), F.lit(2)).select(
        "ask_id", "rshp_id", "prvdr_cd", "cat_cd", "var_dscr_seq", "di_set_val"
    )


_META = "('ASK_ID'), ('RSHP_ID'), ('PRVDR_CD'), ('HASH_DID'), ('CAT_CD')"
_CHECK = f"""
f AS (SELECT {DATASET}, file_nm, pos, upper(var_cd) name FROM file_column),
k AS (SELECT DISTINCT {DATASET}, file_nm FROM f),
c AS (SELECT {DATASET}, upper(var_cd) name FROM catalog_column),
w AS (SELECT k.*, name FROM k JOIN c USING ({DATASET})
 UNION ALL SELECT k.*, m.name FROM k, (VALUES {_META}) m(name)),
nf AS (SELECT file_nm, CAST(count(*) AS INTEGER) n_file,
 CAST(count(*) - count(DISTINCT name) AS INTEGER) n_duplicate FROM f GROUP BY ALL),
nw AS (SELECT file_nm, CAST(count(*) AS INTEGER) n_catalog, count(*) > 5 in_catalog FROM w GROUP BY ALL),
mi AS (SELECT file_nm, string_agg(DISTINCT name, ',' ORDER BY name) missing FROM w
 WHERE (file_nm, name) NOT IN (SELECT (file_nm, name) FROM f) GROUP BY ALL),
ex AS (SELECT file_nm, string_agg(DISTINCT name, ',' ORDER BY name) extra FROM f
 WHERE (file_nm, name) NOT IN (SELECT (file_nm, name) FROM w) GROUP BY ALL)
SELECT {DATASET}, file_nm, in_catalog, n_file, n_catalog, coalesce(missing, '') missing,
 coalesce(extra, '') extra, n_duplicate,
 in_catalog AND n_file = n_catalog AND missing IS NULL passed
FROM k JOIN nf USING (file_nm) JOIN nw USING (file_nm)
 LEFT JOIN mi USING (file_nm) LEFT JOIN ex USING (file_nm)"""


@query(f"WITH {_CHECK}", "file_column catalog_column")
def check_columns(t: Tables) -> DataFrame:
    return checks.check_columns(t.file_column, t.catalog_column)


@query(f"WITH {_CHECK}", "file_column catalog_column")
def check_columns_by_position(t: Tables) -> DataFrame:
    """Meta columns under other names pass when they are taken by position."""
    renamed = t.file_column.withColumn(
        "var_cd", F.when(F.col("pos") <= 5, F.concat(F.lit("m"), "pos")).otherwise(F.col("var_cd"))
    )
    return checks.check_columns(renamed, t.catalog_column, by_position=True)
