"""Where users plug in code of their own: verdict tables (relations.apply_verdicts, filters.gate) and scorers over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def score_with(rows: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series] | None, default: Column, name: str = "score", kind: str = "double") -> DataFrame:
    """rows with a score: the scorer's over batches of rows, or without a scorer the deterministic default (I-UDF2)."""
    if scorer is None:
        return rows.withColumn(name, default.cast(kind))
    base = rows.drop(name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: scorer(pdf)})

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema] + [f"`{name}` {kind}"])
    return base.mapInPandas(run, schema)


@F.udtf(returnType="date string, has_day boolean, start int, end int, kind string, is_cn boolean, backed boolean")
class DateRows:
    """A table function: one row per date of a text (I-UDF3). In SQL, after register_date_rows(): FROM docs, LATERAL date_rows(text)."""

    def eval(self, text: str) -> Iterator[tuple]:
        from ..functions.dates import candidates_in

        for c in candidates_in(text):
            yield c["date"], c["has_day"], c["start"], c["end"], c["kind"], c["is_cn"], c["backed"]


def register_date_rows(spark: SparkSession, name: str = "date_rows") -> None:
    spark.udtf.register(name, DateRows)


def date_rows(rows: DataFrame, text: str) -> DataFrame:
    """rows with one row per date of the text, by a lateral join with the table function; rows without dates go (I-UDF3)."""
    return rows.lateralJoin(DateRows(F.col(text).outer()))


def explode_dates(rows: DataFrame, text: str) -> DataFrame:
    """rows with one row per date of the text: date, has_day, start, end, kind, is_cn, backed (I-UDF3)."""
    from ..functions.dates import date_candidates

    return rows.withColumn("_d", F.explode(date_candidates(text))).select(*rows.columns, "_d.*")
