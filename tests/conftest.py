import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("no test tables here")
    return str(DATA)


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def rows_of(frame):
    """Rows as comparable tuples, columns by name, floats rounded."""
    import pandas as pd

    f = frame if isinstance(frame, pd.DataFrame) else frame.toPandas()
    f = f[sorted(f.columns)]
    clean = lambda v: None if v is None or v is pd.NaT or isinstance(v, float) and v != v else round(v, 9) if isinstance(v, float) else v.item() if hasattr(v, "item") else v
    return list(f.columns), sorted((tuple(clean(v) for v in r) for r in f.astype(object).itertuples(index=False, name=None)), key=repr)
