import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricegrid.schema import CANONICAL_SCHEMA  # noqa: E402
from pricegrid.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests", "local[4]", 4,
        {"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": base},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TOYOTA = dict(brand="Toyota", model="Corolla", year=2015, price=50000.0, km=50000.0, state="SP",
              city="São Paulo", fuel_type="Flex", transmission="Manual", engine_size=1.8, color="Branco",
              doors=4, condition="Bom", age_years=8, year_of_reference=2023, month_of_reference="2023-01")
HONDA = dict(TOYOTA, brand="Honda", model="Civic", year=2018, price=70000.0, km=30000.0, state="RJ",
             city="Rio de Janeiro", fuel_type="Gasolina", transmission="Automático", engine_size=2.0,
             color="Prata", condition="Ótimo", age_years=5)
FORD = dict(TOYOTA, brand="Ford", model="Fiesta", year=2020, price=60000.0, km=20000.0, state="MG",
            city="Belo Horizonte", engine_size=1.6, color="Preto", condition="Excelente", age_years=3)


def frame(spark, rows, schema=CANONICAL_SCHEMA):
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


@pytest.fixture
def five(spark):
    return frame(spark, [TOYOTA, HONDA, TOYOTA, FORD, TOYOTA])


@pytest.fixture
def three(spark):
    return frame(spark, [TOYOTA, HONDA, FORD])
