"""Generated mileage, location, colour, doors and condition for raw listings.

Every draw is a hash of the row key, the stream name and the seed, so a row
gets the same values on any cluster, in any order and after any retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.hashing import uniform, weighted
from pricegrid.operators.keys import with_row_key
from pricegrid.operators.projection import rename_existing, reorder
from pricegrid.schema import CANONICAL_SCHEMA
from pricegrid.sources.tables import sample_rows


STREAMS = ("km", "price", "noise", "state", "city", "color", "doors", "condition")


def with_uniforms(df: DataFrame, key="listing_id", seed=42) -> DataFrame:
    """One uniform number per stream as a column: each is used in many branches,
    and as a column it is hashed once per row."""
    return df.withColumns({f"_u_{s}": uniform(F.col(key), s, seed) for s in STREAMS})


def _u(stream):
    return F.col(f"_u_{stream}")


def _between(stream, low, high):
    return F.lit(float(low)) + _u(stream) * F.lit(float(high) - float(low))


def mileage(age, price):
    """Kilometres by age band, fewer for dear cars, with noise."""
    chain = None
    for i, (limit, low, high, yearly) in enumerate(C.MILEAGE_BANDS):
        base = _between("km", low, high)
        base = age * base if yearly else base
        if limit is None:
            chain = chain.otherwise(base)
        else:
            chain = F.when(age <= limit, base) if i == 0 else chain.when(age <= limit, base)
    factor = None
    for above, low, high in C.MILEAGE_PRICE_FACTORS:
        share = _between("price", low, high)
        factor = F.when(price > above, share) if factor is None else factor.when(price > above, share)
    noise = _between("noise", *C.MILEAGE_NOISE)
    return F.greatest(F.round(chain * factor.otherwise(F.lit(1.0)) * noise, 0), F.lit(0.0))


def state():
    return weighted(_u("state"), C.STATE_WEIGHTS)


def city(state_col):
    """A city of the state, each equally likely."""
    pairs = [x for s, names in C.STATE_CITIES.items() for x in (F.lit(s), F.array(*map(F.lit, names)))]
    names = F.element_at(F.create_map(*pairs), state_col)
    place = F.floor(_u("city") * F.size(names)).cast("int")
    return F.element_at(names, place + 1)


def condition(age, km):
    """Condition by age and yearly kilometres, then by weight."""
    rate = km / F.greatest(age, F.lit(1))
    chain = None
    for limit, below, odds in C.CONDITION_BANDS:
        word = weighted(_u("condition"), odds)
        if limit is None:
            chain = chain.otherwise(word)
        else:
            hit = (age <= limit) & (rate < below)
            chain = F.when(hit, word) if chain is None else chain.when(hit, word)
    return chain


def color():
    return weighted(_u("color"), C.COLOR_WEIGHTS)


def doors():
    return weighted(_u("doors"), C.DOOR_WEIGHTS).cast("long")


def enrich(df: DataFrame, key="listing_id", sample=None, seed=42, keep_key=False) -> DataFrame:
    """Raw listings to the canonical columns, with generated values.

    A table without the key column gets one from its rows.
    """
    df = df if key in df.columns else with_row_key(df, key)
    df = sample_rows(df, sample, key, seed) if sample else df
    if "age_years" not in df.columns:
        df = df.withColumn("age_years", F.col("year_of_reference") - F.col("year_model"))
    age = F.col("year_of_reference") - F.col("year_model")
    df = with_uniforms(df, key, seed).withColumns(
        {
            "km": mileage(age, F.col("avg_price_brl")),
            "state": state(),
            "color": color(),
            "doors": doors(),
        }
    ).withColumns({"city": city(F.col("state")), "condition": condition(age, F.col("km"))})
    order = [f.name for f in CANONICAL_SCHEMA]
    return reorder(rename_existing(df), [key, *order] if keep_key else order)
