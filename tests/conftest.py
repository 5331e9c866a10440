import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
# This folder too: modules shared by the tests have names of their own, since tests/llm has a conftest as well.
for folder in (ROOT / "tests", ROOT):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # A checkpoint folder only where the session has none (as in tests).
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tw-test-ckpt-"))
    yield spark
