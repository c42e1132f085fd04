import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campuslake.session import MEASURED  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tables-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def one_broadcast_limit(request):
    """A session that an earlier test configured has a limit for measured sizes too: a test that turns broadcasts off means both."""
    if "skew_settings" not in request.fixturenames:
        yield
        return
    conf = request.getfixturevalue("spark").conf
    before = conf.get(MEASURED, None)
    conf.unset(MEASURED)
    yield
    if before is not None:
        conf.set(MEASURED, before)
