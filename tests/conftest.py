import pytest

from veilspark.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
    }
    session = build_session("tests", "local[4]", **conf)
    yield session
    session.stop()
