import pytest

from crestline.plans.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture
def small(spark):
    """Few shuffle partitions for plans of many small joins."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)
