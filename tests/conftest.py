import pytest

from corvane.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, **{"spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.checkpoint.dir": str(shared / "checkpoints"), "spark.driver.memory": "3g"})
    yield session
    session.stop()
