import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pressloom.session import close_steps, local_session

    session = local_session(cores=4, shuffle_partitions=4, app="pressloom-tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    close_steps()
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """evaluate(column_function, [row, ...]) -> list of results, rows being a value or a tuple of string arguments."""
    from pyspark.sql import functions as F

    def run(fn, rows, adds_column=False):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        names = [f"c{i}" for i in range(len(rows[0]))]
        data = [(i, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, "i int, " + ", ".join(f"{n} string" for n in names))
        columns = [F.col(n) for n in names]
        if adds_column:
            out = fn(df, *columns, into="v").select("i", "v").collect()
        else:
            out = df.select("i", fn(*columns).alias("v")).collect()
        return [r.v for r in sorted(out, key=lambda r: r.i)]

    return run
