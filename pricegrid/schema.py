"""Canonical schema and the column configuration that operators read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from pricegrid import constants as C

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField(name, dtype)
        for name, dtype in [
            ("brand", STRING),
            ("model", STRING),
            ("year", LONG),
            ("price", DOUBLE),
            ("km", DOUBLE),
            ("state", STRING),
            ("city", STRING),
            ("fuel_type", STRING),
            ("transmission", STRING),
            ("engine_size", DOUBLE),
            ("color", STRING),
            ("doors", LONG),
            ("condition", STRING),
            ("age_years", LONG),
            ("year_of_reference", LONG),
            ("month_of_reference", STRING),
        ]
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(name, dtype)
        for name, dtype in [
            ("brand", STRING),
            ("model", STRING),
            ("year_model", LONG),
            ("avg_price_brl", DOUBLE),
            ("fuel", STRING),
            ("gear", STRING),
            ("engine_size", DOUBLE),
            ("year_of_reference", LONG),
            ("month_of_reference", STRING),
        ]
    ]
)


@dataclass(frozen=True)
class TableConfig:
    """Which columns play which role, and what values they may take."""

    schema: T.StructType = field(default_factory=lambda: CANONICAL_SCHEMA)
    target: str = "price"
    key: str = "listing_id"
    ranges: dict = field(default_factory=lambda: dict(C.RANGES))
    allowed: dict = field(
        default_factory=lambda: {
            "fuel_type": C.FUEL_TYPES,
            "transmission": C.TRANSMISSIONS,
            "condition": C.CONDITIONS,
            "doors": C.DOORS,
        }
    )
    states: tuple = tuple(C.STATES)
    state_region: dict = field(default_factory=lambda: dict(C.STATE_REGION))
    outlier_columns: tuple = ("price", "km", "year", "age_years", "engine_size")
    integer_columns: tuple = ("year", "doors", "age_years", "year_of_reference")
    float_columns: tuple = ("price", "km", "engine_size")
    title_collapse_columns: tuple = ("brand", "model", "city")
    title_columns: tuple = ("fuel_type", "transmission", "color", "condition")
    upper_columns: tuple = ("state",)
    target_encoded: tuple = ("brand", "model", "state", "city")
    one_hot: tuple = ("fuel_type", "transmission", "condition")
    frequency_encoded: tuple = ("brand", "model")

    @property
    def year_limits(self):
        return self.ranges["year"]


CANONICAL = TableConfig()

# The listings adapter maps an order schema onto the canonical columns; nations
# stand in for states and the value domains follow that data.
LISTINGS = TableConfig(
    ranges={
        "year": (1995, 2001),
        "price": (1000, 100000),
        "km": (0, 200000),
        "age_years": (0, 40),
        "engine_size": (0.7, 7.0),
        "doors": (2, 5),
    },
    allowed={
        "fuel_type": ["A", "N"],
        "transmission": ["F", "O"],
        "condition": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
        "doors": [2, 3, 4, 5],
    },
)
