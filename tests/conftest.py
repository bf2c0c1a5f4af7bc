import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import oracle, session  # noqa: E402
from millrace.session import configure  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return configure(session(4))


@pytest.fixture(scope="session")
def con():
    return oracle(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def frame(spark):
    """Frame from rows and a DDL schema."""

    def build(schema, *rows):
        fields = T.StructType.fromDDL(schema).fields

        def value(v, field):
            return Decimal(v) if v is not None and isinstance(field.dataType, T.DecimalType) else v

        data = [tuple(value(v, f) for v, f in zip(row, fields)) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame, optionally of some columns."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
