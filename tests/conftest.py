import sys

import pytest

sys.path.insert(0, ".")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gradeloom.session import local_session

    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()
