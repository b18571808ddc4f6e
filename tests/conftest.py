import os

import pytest

from delayhouse.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    own = {"spark.sql.shuffle.partitions": "4"}
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        own["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", "tests", memory="4g", **own)
    yield session
    session.stop()


def values(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
