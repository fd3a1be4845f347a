"""Tables that are published in versions: written beside the old ones, read back, and made current by a pointer that is switched last.

target/v=<number>/<table> holds Parquet, target/CURRENT one line of JSON: the version, and rows and fingerprint of each table. Readers go through the pointer,
so a run that dies at any moment leaves the version before it as it was; the next run writes its own folder anew. Several tables
share one pointer and change together. The pointer is renamed into place, atomic on HDFS and local disks; on an object store it is a single small object.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.monitoring import shrink_gate, unique_gate


class NotPublished(ValueError):
    """A gate refused the new version, or it couldn't be read back as it was written."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _sums(columns: list[str]) -> list[Column]:
    """Count and four sums over the parts of each row's sha256: the same for the same rows in any order, different if one differs."""
    row = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)"))
    return [F.count("*").alias("rows"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *[F.coalesce(part(k), F.lit(0)).cast("string") for k in range(4)]), 256).alias("sha256")]


def fingerprint(rows: DataFrame) -> dict:
    """{rows, sha256} of a table as a set of rows with repeats; one row reaches the driver."""
    return rows.agg(*_sums(rows.columns)).first().asDict()


def current(spark: SparkSession, target: str) -> dict | None:
    """What the pointer says: {version, tables: {name: {rows, sha256}}}, or None where nothing has been published."""
    path, fs = _path(spark, f"{target}/CURRENT")
    return json.loads(spark.read.text(f"{target}/CURRENT").first()[0]) if fs.exists(path) else None


def read_published(spark: SparkSession, target: str, table: str = "rows") -> DataFrame:
    """The current version of a table."""
    now = current(spark, target)
    if now is None:
        raise FileNotFoundError(f"nothing published at {target}")
    return spark.read.parquet(f"{target}/v={now['version']}/{table}")


def _switch(spark: SparkSession, target: str, pointer: dict) -> None:
    new, fs = _path(spark, f"{target}/CURRENT.{pointer['version']}")
    out = fs.create(new, True)
    out.write((json.dumps(pointer, sort_keys=True) + "\n").encode())
    out.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 1)
    options[0] = getattr(jvm, "Options$Rename").OVERWRITE
    context = jvm.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(new), context.makeQualified(_path(spark, f"{target}/CURRENT")[0]), options)


def publish_version(spark: SparkSession, tables: DataFrame | dict[str, DataFrame], target: str, keys: dict[str, str] | str | None = None, ratio: float = 0.8, keep: int = 3) -> dict:
    """Write the tables (or one, named rows) as the next version and make it current; gives the new pointer with `before`, the rows of the version it follows.

    Refused (NotPublished, the old version stays) when a key repeats, a table shrinks below `ratio` of its rows before (D16, D17), or what is read back differs in count or
    fingerprint from what was to be written. The last `keep` versions stay readable, older ones go.
    """
    tables = {"rows": tables} if isinstance(tables, DataFrame) else tables
    keys = {"rows": keys} if isinstance(keys, str) else keys or {}
    old = current(spark, target)
    version = 1 if old is None else old["version"] + 1
    pointer: dict = {"version": version, "tables": {}}
    for name, rows in tables.items():
        path = f"{target}/v={version}/{name}"
        rows.write.mode("overwrite").parquet(path)
        back = spark.read.parquet(path)
        before = spark.read.parquet(f"{target}/v={old['version']}/{name}") if old and name in old["tables"] else None
        refused = (shrink_gate(back, before, ratio) if before is not None else None) or (unique_gate(back, keys[name]) if name in keys else None)
        if refused:
            raise NotPublished(f"{name}: {refused}")
        pointer["tables"][name] = fingerprint(back)
        if pointer["tables"][name] != fingerprint(rows):
            raise NotPublished(f"{name}: read back otherwise than written")
    _switch(spark, target, pointer)
    gone, fs = _path(spark, f"{target}/v={version - keep}")
    fs.delete(gone, True)
    return pointer | {"before": {name: (old or {"tables": {}})["tables"].get(name, {"rows": 0})["rows"] for name in tables}}
