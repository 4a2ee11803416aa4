import pytest
from pyspark.sql import functions as F

from pricegrid.operators import cleaning
from pricegrid.operators.cleaning import Cleaner
from pricegrid.schema import CANONICAL
from tests.conftest import FORD, HONDA, TOYOTA, frame


@pytest.mark.parametrize("method,rows", [("iqr", 1), ("combined", 1), ("zscore", 3), ("domain", 3)])
def test_rows_kept_per_method(five, method, rows):
    kept = Cleaner(CANONICAL, method).clean(five)
    assert kept.count() == rows
    if rows == 1:
        assert kept.first().brand == "Toyota"


def test_copies_collapse_without_outlier_step(spark, five):
    more = five.union(frame(spark, [TOYOTA]))
    assert Cleaner(CANONICAL, outliers=False).clean(more).count() == 3


def test_unknown_method_is_refused():
    with pytest.raises(ValueError):
        Cleaner(CANONICAL, "median")


def test_fitted_statistics(five):
    found = cleaning.fit_statistics(five, ["price", "km", "engine_size"])
    assert (found["price"]["q25"], found["price"]["q75"]) == (50000.0, 60000.0)
    assert (found["km"]["q25"], found["km"]["q75"]) == (30000.0, 50000.0)
    assert found["engine_size"]["iqr"] == 0.0
    assert found["price"]["std"] == pytest.approx(8944.27191)


def test_imputation_fills_median_and_mode(spark):
    rows = [dict(TOYOTA, price=None), dict(HONDA, brand=None), TOYOTA, FORD, TOYOTA]
    df = frame(spark, rows)
    fills = cleaning.fit_imputation(df)
    assert fills == {"price": 55000.0, "brand": "Toyota"}
    filled = cleaning.impute(df, fills)
    assert filled.where("price is null or brand is null").count() == 0


def test_mode_takes_smallest_of_ties_and_unknown_without_values(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    assert cleaning.fit_imputation(df) == {"x": "a", "y": "Unknown"}


def test_integer_median_is_rounded_down(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "doors long")
    assert cleaning.fit_imputation(df) == {"doors": 1}


def test_ages_follow_the_years(spark):
    df = frame(spark, [dict(TOYOTA, age_years=-1), dict(HONDA, age_years=999), dict(FORD, age_years=None)])
    fixed = cleaning.fix_age(cleaning.fix_missing_age(df))
    assert sorted(r.age_years for r in fixed.collect()) == [3, 5, 8]


def test_missing_values_are_no_outliers(spark, five):
    model = Cleaner(CANONICAL, "combined").fit(five)
    df = frame(spark, [dict(TOYOTA, price=None)])
    assert df.where(~cleaning.any_of(model.masks(df).values())).count() == 1


def test_text_is_standardized(spark):
    df = frame(spark, [dict(TOYOTA, brand="  toyota  ", model="  civic  ", city="são  paulo", state=" sp ",
                            color="azul-claro d'agua", condition=None)])
    row = cleaning.standardize_text(df).first()
    assert (row.brand, row.model, row.city, row.state) == ("Toyota", "Civic", "São Paulo", "SP")
    assert row.color == "azul-claro d'agua".title()
    assert row.condition is None


def test_rule_violators_are_dropped(spark):
    bad = [dict(TOYOTA, price=-1000.0), dict(TOYOTA, km=-5000.0), dict(TOYOTA, year=2030), dict(TOYOTA, doors=6),
           dict(TOYOTA, engine_size=None), TOYOTA]
    assert cleaning.drop_invalid(frame(spark, bad)).count() == 1


def test_types_are_corrected(spark):
    df = spark.createDataFrame([("2015", "x", "50000", "?")], "year string, doors string, price string, km string")
    fixed = cleaning.correct_types(df)
    assert dict(fixed.dtypes) == {"year": "bigint", "doors": "bigint", "price": "double", "km": "double"}
    assert tuple(fixed.first()) == (2015, 0, 50000.0, None)


def test_quarantine_agrees_with_cleaning(five):
    model = Cleaner(CANONICAL, "iqr").fit(five)
    judged = model.quarantine(five)
    assert judged.where(F.size("reasons") == 0).count() == model.transform(five).count() == 1
    honda = judged.where("brand = 'Honda'").first()
    assert honda.reasons == ["outlier engine_size"]
    report = model.report(five).first()
    assert (report.rows_in, report.rows_distinct, report.rows_kept) == (5, 3, 1)
