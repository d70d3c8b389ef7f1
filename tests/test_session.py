"""Step tables and what travels to the executors."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from pressloom.operators.similarity import _pairs_of_units
from pressloom.session import StepTables, shared_folder
from pressloom.sources.html_pages import _headlines


@pytest.mark.parametrize("function", [_pairs_of_units(0.1), _headlines])
def test_worker_functions_need_no_package(function, tmp_path):
    (tmp_path / "job").write_bytes(cloudpickle.dumps(function))
    code = "import sys, pickle; f = pickle.load(open('job', 'rb')); assert 'pressloom' not in sys.modules; print(f.__name__)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == function.__name__, done.stderr


def test_step_tables(spark):
    steps = StepTables(spark, "test")
    saved = steps.save(spark.range(5), "numbers")
    assert saved._pressloom_path.startswith(shared_folder(spark).rstrip("/"))
    assert sorted(r.id for r in saved.collect()) == [0, 1, 2, 3, 4]
    assert "ExistingRDD" not in saved._jdf.queryExecution().executedPlan().toString()
    steps.drop(saved, None, spark.range(1))
    with pytest.raises(Exception):
        spark.read.parquet(saved._pressloom_path)
