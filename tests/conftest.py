import pytest

from vitrine.session import get_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", master="local[8]", shuffle_partitions=4,
                          conf={"spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """The click texts of the smallest data set, cached for the whole run."""
    from vitrine.checks.fixtures import click_lines

    return click_lines(spark, SF).cache()


def json_df(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json_str string")


def rows_of(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
