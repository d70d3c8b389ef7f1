"""Outputs.  File names and folders are parameters; nothing here looks at the clock."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pressloom.operators.reports import counted

_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": ""}
_ARRIVAL = ("_file", "_file_rank", "_pos")


def write_days(df: DataFrame, path: str, keys: tuple[str, ...] = ("dt",), written: Observation | None = None) -> None:
    """JSON lines, one folder per day (and source, if asked); days that are not in `df` keep their files.

    Rows are range-partitioned by day and arrival, so a day is written by few tasks, a heavy day by several, in order.
    The arrival columns stay, so that "first" and "latest" mean the same after reading back.  `written` gets the counts of
    `reports.counted`, from the run that writes.
    """
    order = [*keys, *[c for c in _ARRIVAL if c in df.columns]]
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    if written is not None:
        ordered = counted(ordered, written, keys[0])
    writer = ordered.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_cluster_run(
    tables: Mapping[str, DataFrame], path: str, save: str = "both", params: Mapping[str, object] | None = None
) -> None:
    """The outputs of one clustering run below `path`: `articles` and `clusters_summary` as CSV, `clusters` as JSON
    lines, `run` as one JSON row with the counts and the parameters that have a value."""
    if save not in ("csv", "json", "both"):
        raise ValueError(f"unknown output choice: {save}")
    if save in ("csv", "both"):
        write_csv(tables["articles"], f"{path}/articles")
        write_csv(tables["clusters_summary"], f"{path}/clusters_summary")
    if save in ("json", "both"):
        tables["clusters"].write.mode("overwrite").json(f"{path}/clusters")
    stats = tables["stats"]
    given = {k: v for k, v in (params or {}).items() if v not in (None, "", [])}
    if given:
        pairs = [F.lit(str(x)) for kv in given.items() for x in kv]
        stats = stats.withColumn("params", F.create_map(*pairs))
    stats.write.mode("overwrite").json(f"{path}/run")
