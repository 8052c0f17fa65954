import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("TZ", "UTC")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from bazaarlens.session import get_spark, share_package

    session = get_spark("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    share_package(session)
    return session


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture
def apply(spark):
    """Values of a column expression over a list of texts, in one job."""
    from pyspark.sql import functions as F

    def run(expression, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[0] for r in df.select(expression(F.col("c")).alias("out"), "i").orderBy("i").collect()]

    return run
