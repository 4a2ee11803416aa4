"""Validation and data-quality assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.operators import quality, validation
from pricegrid.operators.cleaning import Cleaner
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.cleaning_queries import full_clean_sql
from pricegrid.schema import CANONICAL_SCHEMA, LISTINGS
from pricegrid.session import once
from pricegrid.sources.listings import dirty_listings, listings, table

catalog = Catalog()
query = catalog.add
L, D = sql.WITH_L, sql.WITH_D

RANGES = {
    "year": (1995, 2001), "price": (1000, 100000), "km": (0, 200000), "age_years": (0, 40),
    "engine_size": (0.7, 7.0), "doors": (2, 5),
}
ALLOWED = {
    "fuel_type": "'A','N'", "transmission": "'F','O'", "condition": "'1-URGENT','2-HIGH','3-MEDIUM'",
    "doors": "2,3,4,5",
}
STATES = ", ".join(f"'{s}'" for s in LISTINGS.states)
RATE = "case when age_years+1=0 then km>0 else km/(age_years+1)>50000 end"
RULES = [
    ("Price > 0", "price<=0", "error"),
    ("KM >= 0", "km<0", "error"),
    ("Year <= year_of_reference", "year>year_of_reference", "error"),
    ("Age >= 0", "age_years<0", "error"),
    ("Age calculation consistency", "coalesce(age_years<>year_of_reference-year,true)", "warning"),
    ("KM per year (< 50,000 km/year)", RATE, "warning"),
    ("Engine size > 0", "engine_size<=0", "error"),
    ("Doors (2, 3, 4, or 5)", "not coalesce(doors in (2,3,4,5),false)", "error"),
]
CHECKS = (
    [("range", c, f"{c}<{low} or {c}>{high}", None, c) for c, (low, high) in RANGES.items()]
    + [("categorical", c, f"{c} not in ({words})", None, None) for c, words in ALLOWED.items()]
    + [("categorical", "state", f"upper(state) not in ({STATES})", None, None)]
    + [("rule", name, test, severity, None) for name, test, severity in RULES]
)


def issue_sql(source, checks):
    """One row per violated check."""
    parts = []
    for check, name, test, severity, value in checks:
        hit = f"count(*) filter (where {test})"
        word = f"'{severity}'" if severity else f"case when {hit}/count(*)<0.05e0 then 'warning' else 'error' end"
        low, high = (
            (f"cast(min({value}) filter (where {test}) as double)", f"cast(max({value}) filter (where {test}) as double)")
            if value
            else ("cast(null as double)", "cast(null as double)")
        )
        parts.append(
            f"""select '{check}' as "check", '{name}' as rule, {hit} as violations,
 round({hit}/count(*)*100,6) as percentage, {low} as min_found, {high} as max_found, {word} as severity from {source}"""
        )
    return f"select * from ({sql.union(parts)}) where violations>0"


ISSUE = ["check", "rule", "violations", "percentage", "min_found", "max_found", "severity"]


# -- validation ---------------------------------------------------------------------


@query(
    "va1_schema_issues",
    """select rule, severity, detail, (select count(*) from lineitem) as total_rows from (
 select 'missing_columns' as rule, 'error' as severity, 'color; condition' as detail
 union all select 'unexpected_columns', 'warning', 'colour; listing_id; region'
 union all select 'type_mismatch', 'error', 'year: string instead of bigint')""",
)
def va1_schema_issues(spark, sf_dir):
    df = listings(spark, sf_dir).drop("condition").withColumnRenamed("color", "colour")
    df = df.withColumn("year", F.col("year").cast("string"))
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    found = validation.schema_issues(df, CANONICAL_SCHEMA).select("rule", "severity", "detail")
    return found.crossJoin(F.broadcast(total))


@query("va2_range_issues", f"{D} {issue_sql('d', [c for c in CHECKS if c[0] == 'range'])}")
def va2_range_issues(spark, sf_dir):
    return validation.range_issues(dirty_listings(spark, sf_dir), LISTINGS).select(*ISSUE)


@query("va3_categorical_issues", f"{D} {issue_sql('d', [c for c in CHECKS if c[0] == 'categorical'])}")
def va3_categorical_issues(spark, sf_dir):
    return validation.categorical_issues(dirty_listings(spark, sf_dir), LISTINGS).select(*ISSUE)


@query(
    "va3_invalid_values",
    f"{D} " + sql.union(
        [
            f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as violations from d
 where {c} not in ({words}) group by 2"""
            for c, words in ALLOWED.items()
        ]
        + [f"select 'state', upper(state), count(*) from d where upper(state) not in ({STATES}) group by 2"]
    ),
)
def va3_invalid_values(spark, sf_dir):
    return validation.invalid_values(dirty_listings(spark, sf_dir), LISTINGS)


@query(
    "va4_state_lookup",
    f"""{D} select upper(state) as value, count(*) as violations from d where upper(state) not in
 (select upper(n_name) from nation where n_regionkey<>0) group by 1""",
)
def va4_state_lookup(spark, sf_dir):
    """States against a state table: nations outside the first region are accepted."""
    accepted = table(spark, sf_dir, "nation").where("n_regionkey <> 0")
    return validation.invalid_states(dirty_listings(spark, sf_dir), accepted, key="n_name")


for _number, (_name, _test, _severity) in enumerate(RULES, start=5):

    def _one_rule(spark, sf_dir, rule_name=_name):
        rules = [r for r in validation.business_rules(LISTINGS) if r.name == rule_name]
        return validation.issues(dirty_listings(spark, sf_dir), rules).select(*ISSUE)

    _slug = ["price", "km", "year_order", "age", "age_consistency", "km_rate", "engine", "doors"][_number - 5]
    query(f"va{_number}_rule_{_slug}", f"{D} {issue_sql('d', [('rule', _name, _test, _severity, None)])}")(_one_rule)


@query("va5_12_business_rules", f"{D} {issue_sql('d', [c for c in CHECKS if c[0] == 'rule'])}")
def va5_12_business_rules(spark, sf_dir):
    return validation.business_issues(dirty_listings(spark, sf_dir), LISTINGS).select(*ISSUE)


@query(
    "va13_summary",
    f"""{D}, s as ({issue_sql('d', CHECKS)})
select (select count(*) from d) as total_rows, count(*)+1 as total_issues, false as validation_passed,
 coalesce(bool_or(severity='error'),false) as has_errors from s""",
)
def va13_summary(spark, sf_dir):
    """The key and region columns are unexpected: one more issue."""
    return validation.summary(dirty_listings(spark, sf_dir), LISTINGS)


CANONICAL_LIST = ", ".join(f.name for f in CANONICAL_SCHEMA)


@query(
    "va15_before_after",
    f"""with before_ as (select * from ({D} select {CANONICAL_LIST} from d)),
 after_ as (select * from ({full_clean_sql('iqr', CANONICAL_LIST)})),
 b as ({issue_sql('before_', CHECKS)}), a as ({issue_sql('after_', CHECKS)})
select 'before' as stage, * from b union all select 'after', * from a""",
)
def va15_before_after(spark, sf_dir):
    columns = [f.name for f in CANONICAL_SCHEMA]
    before = once(dirty_listings(spark, sf_dir))
    after = Cleaner(LISTINGS, "iqr").clean(before)
    stages = {"before": before.select(*columns), "after": after.select(*columns)}
    return validation.validate_stages(stages, LISTINGS).select("stage", *ISSUE)


# -- assessment ------------------------------------------------------------------------


TYPES = {f.name: (f.dataType.simpleString(),) * 2 + ("OK",) for f in CANONICAL_SCHEMA} | {
    "doors": ("bigint", "string", "MISMATCH"),
    "color": ("string", "MISSING", "MISSING"),
}


@query(
    "dq1_type_report",
    f"{D} " + sql.union(
        f"""select '{c}' as "column", '{expected}' as expected, '{actual}' as actual, '{status}' as status,
 {'max(cast(null as bigint))' if actual == 'MISSING' else f'count({c})'} as present from d"""
        for c, (expected, actual, status) in TYPES.items()
    ),
)
def dq1_type_report(spark, sf_dir):
    """Types per expected column, with the number of values present."""
    df = dirty_listings(spark, sf_dir).drop("color").withColumn("doors", F.col("doors").cast("string"))
    present = quality.per_column(df, df.columns, {"present": F.count}).select("column", "present")
    return quality.type_report(df, CANONICAL_SCHEMA).join(F.broadcast(present), "column", "left")


NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@query(
    "dq2_mixed_types",
    f"""{D}, m as (select brand, city, case when doors>3 then cast(doors as varchar) else color end as code from d)
select 'code' as "column", count(*) filter (where regexp_matches(code,'{NUMERIC_TEXT}')) as numeric_values,
 round(count(*) filter (where regexp_matches(code,'{NUMERIC_TEXT}'))/count(*)*100,6) as percentage from m""",
)
def dq2_mixed_types(spark, sf_dir):
    df = dirty_listings(spark, sf_dir)
    code = F.when(F.col("doors") > 3, F.col("doors").cast("string")).otherwise(F.col("color"))
    return quality.mixed_types(df.select("brand", "city", code.alias("code")))


def _missing_sql(c):
    text = c in sql.TEXT
    empty = f"count(*) filter (where {c}='')" if text else "0"
    blank = f"count(*) filter (where {c}<>'' and trim({c})='')" if text else "0"
    special = (
        f"count(*) filter (where {c} in (-1,-999))" if c in ("km", "price", "engine_size")
        else "count(*) filter (where age_years<0)" if c == "age_years" else "0"
    )
    return f"""select '{c}' as "column", count(*) filter (where {c} is null) as null_count, {empty} as empty_strings,
 {blank} as whitespace_only, {special} as special_numeric, count(*) as n from d"""


@query(
    "dq3_missing_check",
    f"""{D}, m as ({sql.union(_missing_sql(c) for c in sql.LISTING_COLUMNS)}),
 t as (select *, null_count+empty_strings+whitespace_only+special_numeric as total from m)
select "column", null_count, empty_strings, whitespace_only, special_numeric, round(null_count/n*100,6) as null_pct,
 cast(total as bigint) as total_issues, round(total/n*100,6) as total_pct from t""",
)
def dq3_missing_check(spark, sf_dir):
    return quality.missing_check(dirty_listings(spark, sf_dir))


YEARS = (1996, 2000)
ASSESSMENT = [
    ("rule", "Year range (1995-2001)", "year<1995 or year>2001", "error", None),
    *[("rule", n, t, s, None) for n, t, s in RULES if n != "Engine size > 0"],
    ("rule", "Engine size (0.7-7.0L)", "engine_size<=0 or engine_size>7", "error", None),
    ("rule", "Year of reference (1996-2000)", "year_of_reference<1996 or year_of_reference>2000", "error", None),
]


@query("dq4_assessment_rules", f"{D} {issue_sql('d', ASSESSMENT)}")
def dq4_assessment_rules(spark, sf_dir):
    df = dirty_listings(spark, sf_dir)
    return quality.assessment_issues(df, LISTINGS, reference_years=YEARS).select(*ISSUE)


DQ5_COLUMNS = ["year", "price", "km", "engine_size", "doors", "age_years"]


def _outlier_sql(c):
    return f"""select '{c}' as feature, round(avg({c}),4) as mean, round(stddev_samp({c}),4) as std,
 cast(min({c}) as double) as min, cast(max({c}) as double) as max,
 count(*) filter (where {c}<lo or {c}>hi) as iqr_outliers,
 round(count(*) filter (where {c}<lo or {c}>hi)/count(*)*100,6) as iqr_pct,
 count(*) filter (where abs(({c}-m)/s)>3) as zscore_outliers,
 round(count(*) filter (where abs(({c}-m)/s)>3)/count(*)*100,6) as zscore_pct,
 round(max(lo),4) as iqr_lower, round(max(hi),4) as iqr_upper,
 count(*) filter (where {c}<lo or {c}>hi)/count(*)*100>5 as significant
 from d cross join (select avg({c}) as m, stddev_pop({c}) as s,
  quantile_cont({c},0.25)-1.5e0*(quantile_cont({c},0.75)-quantile_cont({c},0.25)) as lo,
  quantile_cont({c},0.75)+1.5e0*(quantile_cont({c},0.75)-quantile_cont({c},0.25)) as hi from d)"""


@query("dq5_outlier_summary", f"{D} {sql.union(_outlier_sql(c) for c in DQ5_COLUMNS)}")
def dq5_outlier_summary(spark, sf_dir):
    return quality.outlier_summary(once(dirty_listings(spark, sf_dir), *DQ5_COLUMNS))


DQ6_COLUMNS = ["brand", "model", "state", "city", "fuel_type", "transmission", "color", "condition"]


def _category_sql(c, source="d"):
    text = "coalesce(v,'nan')"
    return f"""select '{c}' as "column", count(*) as unique_values, bool_or(trim({text})<>{text}) as has_whitespace,
 count(distinct lower({text}))<>count(*) or count(distinct upper({text}))<>count(*) as has_case_inconsistency,
 count(*) filter (where v is not null and n<greatest(5,(select count(*) from {source})*0.0001)) as rare_values_count,
 (select {c} from {source} where {c} is not null group by 1 order by count(*) desc, 1 limit 1) as most_common,
 cast(max(n) filter (where v is not null) as bigint) as most_common_count
 from (select {c} as v, count(*) as n from {source} group by 1)"""


@query("dq6_category_consistency", f"{D} {sql.union(_category_sql(c) for c in DQ6_COLUMNS)}")
def dq6_category_consistency(spark, sf_dir):
    return quality.category_consistency(dirty_listings(spark, sf_dir), DQ6_COLUMNS)




@query(
    "dq6_document_consistency",
    sql.union(_category_sql(c, "documents") for c in ("lang", "source", "text")),
)
def dq6_document_consistency(spark, sf_dir):
    """Whole document texts as categories: stray blanks, copies and rare values."""
    return quality.category_consistency(table(spark, sf_dir, "documents"), ["lang", "source", "text"])


@query(
    "dq7_rare_values",
    f"""{D}, e as (select *, substr(listing_id,1,4) as code from d) """
    + sql.union(
        f"""select '{c}' as "column", {c} as value, count(*) as n from e where {c} is not null group by 2
 having count(*)<greatest(5,(select count(*) from e)*0.0001)"""
        for c in (*DQ6_COLUMNS, "code")
    ),
)
def dq7_rare_values(spark, sf_dir):
    df = dirty_listings(spark, sf_dir).withColumn("code", F.substring("listing_id", 1, 4))
    return quality.rare_values(df, [*DQ6_COLUMNS, "code"])


INCONSISTENT = [
    ("rule", "Zero mileage (km = 0)", "km=0", "error", None),
    ("rule", "Very low price (< R$ 1,000)", "price<1000", "error", "price"),
    ("rule", "Very high price (> R$ 1,000,000)", "price>1000000", "error", "price"),
    ("rule", "Aged vehicle with zero km", "age_years>0 and km=0", "error", None),
    ("rule", "Very old vehicle with very low km", "age_years>20 and km<10000", "error", None),
    ("rule", "Future vehicle year", "year>1999", "error", None),
]


@query("dq8_inconsistent_values", f"{D} {issue_sql('d', INCONSISTENT)}")
def dq8_inconsistent_values(spark, sf_dir):
    return quality.inconsistent_values(dirty_listings(spark, sf_dir), last_year=1999).select(*ISSUE)


REPORT = f"""{D}, mi as ({sql.union(_missing_sql(c) for c in sql.LISTING_COLUMNS)}),
 ou as ({sql.union(_outlier_sql(c) for c in DQ5_COLUMNS)}),
 ca as ({sql.union(_category_sql(c) for c in DQ6_COLUMNS)}),
 ru as ({issue_sql('d', ASSESSMENT)}), inc as ({issue_sql('d', [*INCONSISTENT[:5], (*INCONSISTENT[5][:2], 'year>2023', *INCONSISTENT[5][3:])])}),
 rep as (select 'data types' as area, 0 as categories
 union all select 'missing values', count(*) from mi where null_count+empty_strings+whitespace_only+special_numeric>0
 union all select 'business rules', count(*) from ru
 union all select 'outliers', count(*) from ou where significant
 union all select 'categories', count(*) from ca where has_whitespace or has_case_inconsistency or rare_values_count>0
 union all select 'inconsistent values', count(*) from inc)"""


@query("dq9_quality_report", f"{REPORT} select * from rep")
def dq9_quality_report(spark, sf_dir):
    df = once(dirty_listings(spark, sf_dir))
    return quality.quality_report(df, LISTINGS, DQ6_COLUMNS, reference_years=YEARS)


@query(
    "dq9_quality_score",
    f"""{REPORT} select cast(sum(categories) as bigint) as total_categories,
 case when sum(categories)<=0 then 'EXCELLENT' when sum(categories)<=3 then 'GOOD'
 when sum(categories)<=6 then 'FAIR' else 'POOR' end as quality_score from rep""",
)
def dq9_quality_score(spark, sf_dir):
    return quality.quality_score(dq9_quality_report(spark, sf_dir))
