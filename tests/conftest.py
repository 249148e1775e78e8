import tempfile

import pytest

import paths  # noqa: F401  (puts the repository on sys.path)


@pytest.fixture(scope="session")
def spark():
    from clicklens.config import build_session
    s = build_session("local[4]", app="clicklens-tests", shuffle_partitions=4)
    # Tests run without a cluster: give them a checkpoint folder when none is set.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clicklens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from clicklens.config import shared_dir
    return shared_dir(spark, "tests")
