"""Stage tables: Parquet in a folder, optionally with a CSV copy.

The tables of a stage are published together. Each call writes them into a new folder below ``versions`` and then adds, by one
rename, a file to ``published`` that names the current place of every table. A stage that fails before that leaves the former
tables as they were, all of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_PUBLISHED, _VERSIONS = "published", "versions"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published states of a folder, ascending."""
    fs, at = _file_system(spark, f"{folder}/{_PUBLISHED}")
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _state(spark: SparkSession, folder: str, number: int) -> dict[str, str]:
    """Table names to places below the folder."""
    fs, at = _file_system(spark, f"{folder}/{_PUBLISHED}/{number:012d}.json")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, places: Mapping[str, str]) -> None:
    numbers = _numbers(spark, folder)
    states = [_state(spark, folder, n) for n in numbers[-1:]]
    current = {**(states[-1] if states else {}), **places}
    number = (numbers[-1] if numbers else 0) + 1
    fs, made = _file_system(spark, f"{folder}/{_PUBLISHED}/_{uuid.uuid4().hex}")
    stream = fs.create(made)
    stream.write(bytearray(json.dumps(current, indent=1).encode()))
    stream.close()
    if not fs.rename(made, _file_system(spark, f"{folder}/{_PUBLISHED}/{number:012d}.json")[1]):
        raise FileExistsError(f"Another call published to {folder} at the same time.")
    # the state before stays readable; what only older ones name goes
    kept = {place.split("/")[1] for state in (current, *states) for place in state.values()}
    _, versions = _file_system(spark, f"{folder}/{_VERSIONS}")
    for status in fs.listStatus(versions):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def save_tables(tables: Mapping[str, DataFrame], folder: str, as_csv: bool = False) -> None:
    """Write the tables of a stage and publish them together, in the place of earlier ones of these names."""
    spark = next(iter(tables.values())).sparkSession
    version = f"{_VERSIONS}/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{version}/{name}")
        if as_csv:
            # Dates as in the input files, so that the copy reads back.
            spark.read.parquet(f"{folder}/{version}/{name}").write.option("nullValue", "NA").option(
                "header", True
            ).option("dateFormat", "dd/MM/yyyy").csv(f"{folder}/{version}/{name}_csv")
    _publish(spark, folder, {name: f"{version}/{name}" for name in tables})


def save_table(df: DataFrame, folder: str, name: str, as_csv: bool = False) -> None:
    """Write and publish one table of a stage."""
    save_tables({name: df}, folder, as_csv)


def table_path(spark: SparkSession, folder: str, name: str) -> str:
    """Where a table of a stage lies; its CSV copy has the same path with `_csv` behind it."""
    numbers = _numbers(spark, folder)
    state = _state(spark, folder, numbers[-1]) if numbers else {}
    return f"{folder}/{state.get(name, name)}"


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read a table of a stage."""
    return spark.read.parquet(table_path(spark, folder, name))
