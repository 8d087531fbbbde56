"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamweir.session import new_run_dir


class Workspace:
    """The tables and files of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = new_run_dir(spark, name)
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Written once and read from then on: a lost executor costs no recomputation."""
        self.count += 1
        path = f"{self.path}/table-{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, columns: list[str] | None = None, **own: Column) -> DataFrame:
    """The given columns (default: all) as one struct ``row``, beside the operator's own: no names can clash."""
    columns = df.columns if columns is None else columns
    row = F.struct(*[quoted(c).alias(c) for c in columns]) if columns else F.struct(F.lit(None).cast("string").alias("_"))
    return df.select(row.alias("row"), *[value.alias(name) for name, value in own.items()])


def unpacked(df: DataFrame, columns: list[str], *results: Column, names: list[str] = ()) -> DataFrame:
    """The packed columns and the results; a packed column named like a result (in ``names``) gives way to it."""
    given = {n.lower() for n in names}
    return df.select(*[F.col("row")[c].alias(c) for c in columns if c.lower() not in given], *results)
