import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from catlink import session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = (
        session.builder("catlink-tests").master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.checkpoint.dir", str(base / "checkpoint"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Values of an expression over literal inputs: ``column(fn, [a, b], "string")``."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
