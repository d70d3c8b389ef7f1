"""Sessions for local runs, and the shared folder where iterative jobs keep their step tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a production session should carry; a local one only adds sizes that fit one machine.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
}


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, app: str = "pressloom", checkpoint_dir: str | None = None
) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = SESSION_CONF | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Only a session of one machine may leave that unset; it gets one below its warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_steps"


def close_steps() -> None:
    """Remove the step tables of all jobs so far.  A program calls this before it stops its session."""
    for steps in list(_OPEN):
        steps.close()


_OPEN: list[StepTables] = []
atexit.register(close_steps)


class StepTables:
    """Parquet tables of one iterative job in the shared folder.

    Writing a step and reading it back cuts the lineage, survives lost executors and gives the planner true sizes.  Tables
    that no later step reads are dropped on the way; the rest goes with `close`, at the latest when the session's program
    ends.
    """

    def __init__(self, spark: SparkSession, job: str):
        self._spark = spark
        self._root = f"{shared_folder(spark).rstrip('/')}/{job}-{uuid.uuid4().hex}"
        self._count = 0
        self._saved: set[str] = set()
        _OPEN.append(self)

    def folder(self) -> str:
        """A folder of the job for files that are written and read by other means than `save`."""
        self._count += 1
        return f"{self._root}/{self._count:04d}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self._root}/{self._count:04d}-{name}"
        df.write.parquet(path)
        saved = self._spark.read.schema(df.schema).parquet(path)
        saved._pressloom_path = path
        self._saved.add(path)
        return saved

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove step tables that no later step reads."""
        for table in tables:
            path = getattr(table, "_pressloom_path", None)
            if path:
                self._delete(path)

    def drop_all_but(self, *tables: DataFrame) -> None:
        """Remove all step tables so far except these, which are all that later steps read."""
        kept = {table._pressloom_path for table in tables}
        for path in self._saved - kept:
            self._delete(path)
        self._saved &= kept

    def close(self) -> None:
        """Remove what is left, once every result that reads it has been written."""
        if self in _OPEN:
            _OPEN.remove(self)
        if self._spark.sparkContext._jsc is not None:
            self._delete(self._root)

    def _delete(self, path: str) -> None:
        jvm, conf = self._spark._jvm, self._spark._jsparkSession.sessionState().newHadoopConf()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
