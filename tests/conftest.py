import pytest

from wayfuse import build_session
from wayfuse.session import prepare


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", cores=8, **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def own_settings(spark):
    """A query leaves the settings of the feeds with the session it shares; the next test begins without them."""
    yield
    prepare(spark)
