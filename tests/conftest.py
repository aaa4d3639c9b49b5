import os
import sys
import tempfile

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sylvan-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sample_regression(spark):
    """100 x 5 standard normal features, y = x0 + 0.5 x1 + 0.3 noise
    (first 80 rows train, last 20 test) -- the reference's fixture."""
    rng = np.random.RandomState(42)
    x = rng.randn(100, 5)
    y = x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.randn(100)
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(5)])
    pdf["y"] = y
    pdf.insert(0, "row_key", np.arange(100, dtype=np.int64))
    df = spark.createDataFrame(pdf)
    return df.where("row_key < 80"), df.where("row_key >= 80"), pdf


@pytest.fixture(scope="session")
def small_regression(spark):
    pdf = pd.DataFrame({"row_key": np.arange(5, dtype=np.int64),
                        "x0": [1.0, 2.0, 3.0, 4.0, 5.0], "x1": [2.0, 3.0, 4.0, 5.0, 6.0],
                        "y": [1.5, 2.5, 3.5, 4.5, 5.5]})
    return spark.createDataFrame(pdf), pdf
