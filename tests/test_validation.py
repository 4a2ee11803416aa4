from pyspark.sql import functions as F

from pricegrid.operators import quality, validation
from pricegrid.schema import CANONICAL, CANONICAL_SCHEMA
from tests.conftest import FORD, HONDA, TOYOTA, frame


def names(df):
    return {r.rule for r in df.collect()}


def test_valid_rows_have_no_issues(three):
    row = validation.summary(three, CANONICAL).first()
    assert (row.total_rows, row.total_issues, row.validation_passed, row.has_errors) == (3, 0, True, False)
    assert validation.validate(three, CANONICAL).count() == 0


def test_schema_issues(three):
    assert names(validation.schema_issues(three.drop("brand", "model"), CANONICAL_SCHEMA)) == {"missing_columns"}
    text = three.withColumn("year", F.col("year").cast("string"))
    assert names(validation.schema_issues(text, CANONICAL_SCHEMA)) == {"type_mismatch"}
    extra = validation.schema_issues(three.withColumn("x", F.lit(1)), CANONICAL_SCHEMA).first()
    assert (extra.rule, extra.severity) == ("unexpected_columns", "warning")


def test_range_issues(spark):
    df = frame(spark, [dict(TOYOTA, price=5e6), dict(HONDA, km=-1000.0), dict(FORD, year=2030)])
    found = {r.rule: r for r in validation.range_issues(df, CANONICAL).collect()}
    assert set(found) == {"price", "km", "year"}
    assert all(r.severity == "error" and r.violations == 1 for r in found.values())
    assert found["price"].max_found == 5e6


def test_categorical_issues(spark):
    rows = [dict(TOYOTA, fuel_type="InvalidFuel"), dict(HONDA, transmission="InvalidTransmission"), dict(FORD, state="XX")]
    df = frame(spark, rows)
    assert names(validation.categorical_issues(df, CANONICAL)) == {"fuel_type", "transmission", "state"}
    values = {(r.column, r.value) for r in validation.invalid_values(df, CANONICAL).collect()}
    assert values == {("fuel_type", "InvalidFuel"), ("transmission", "InvalidTransmission"), ("state", "XX")}


def test_lower_case_states_and_missing_words_pass(spark):
    df = frame(spark, [dict(TOYOTA, state="sp", fuel_type=None, doors=None)])
    assert validation.categorical_issues(df, CANONICAL).count() == 0


def test_normalized_words_ignore_case(spark):
    df = frame(spark, [dict(TOYOTA, fuel_type="Gnv")])
    assert names(validation.categorical_issues(df, CANONICAL)) == {"fuel_type"}
    assert validation.categorical_issues(df, CANONICAL, normalize=True).count() == 0


def test_business_rules(spark):
    rows = [dict(TOYOTA, price=-1000.0), dict(HONDA, km=-5000.0), dict(FORD, year=2030, age_years=-1)]
    found = names(validation.business_issues(frame(spark, rows), CANONICAL))
    assert {"Price > 0", "KM >= 0", "Year <= year_of_reference", "Age >= 0", "Age calculation consistency"} <= found
    old = validation.business_issues(frame(spark, [dict(TOYOTA, age_years=999)]), CANONICAL)
    assert names(old) == {"Age calculation consistency"}


def test_missing_values_break_equality_and_membership_rules(spark):
    df = frame(spark, [dict(TOYOTA, age_years=None, doors=None, price=None)])
    assert names(validation.business_issues(df, CANONICAL)) == {
        "Age calculation consistency", "Doors (2, 3, 4, or 5)",
    }


def test_warning_below_five_percent(spark):
    df = frame(spark, [TOYOTA] * 30 + [dict(TOYOTA, km=600000.0)])
    assert validation.range_issues(df, CANONICAL).first().severity == "warning"


def test_there_are_27_states():
    assert len(CANONICAL.states) == len(set(CANONICAL.states)) == 27
    assert len(CANONICAL.state_region) == 27


def test_quality_checks(spark):
    rows = [dict(TOYOTA, brand=" Toyota", color=""), dict(HONDA, brand="HONDA", km=-999.0), HONDA, dict(FORD, model="  ")]
    df = frame(spark, rows)
    missing = {r.column: r for r in quality.missing_check(df).collect()}
    assert missing["color"].empty_strings == 1 and missing["model"].whitespace_only == 1
    assert missing["km"].special_numeric == 1
    found = {r.column: r for r in quality.category_consistency(df).collect()}
    assert found["brand"].has_whitespace and found["brand"].has_case_inconsistency
    assert not found["state"].has_case_inconsistency
    assert found["brand"].rare_values_count == 4
    text = spark.createDataFrame([("1.5",), ("abc",)], "x string")
    assert quality.mixed_types(text).first().numeric_values == 1
