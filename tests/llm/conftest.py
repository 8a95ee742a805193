import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small DataFrame from rows and a DDL schema."""
    from vitrine.session import configure

    configure(spark)
    return lambda rows, schema: spark.createDataFrame(rows, schema)
