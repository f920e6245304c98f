"""Session and small-table helpers for the tests."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerloom.schemas import table_schema
from ledgerloom.session import local_session

_FILL = {
    T.StringType: "",
    T.BooleanType: False,
    T.IntegerType: 0,
    T.LongType: 0,
    T.DoubleType: 0.0,
    T.DecimalType: Decimal(0),
    T.ArrayType: [],
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """table(name, {...}, {...}) gives a frame with the declared schema; what a row leaves out is
    null, or an empty value where the column must not be null."""

    def build(name: str, *rows: dict):
        schema = table_schema(name)

        def cell(field, row):
            if field.name in row:
                value = row[field.name]
                if isinstance(field.dataType, T.DecimalType) and value is not None:
                    return Decimal(str(value))
                return value
            return None if field.nullable else _FILL[type(field.dataType)]

        for row in rows:
            unknown = set(row) - set(schema.names)
            assert not unknown, f"{name} has no column {unknown}"
        return spark.createDataFrame([tuple(cell(f, r) for f in schema) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def values(spark):
    """values(expression, ...) over one row of literals: the evaluated columns as a tuple."""

    def evaluate(*columns):
        return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())

    return evaluate


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)
