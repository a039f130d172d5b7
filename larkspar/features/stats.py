"""Column statistics, correlations and chi-square tests as DataFrames."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest, Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = ("mean", "variance", "count", "numNonZeros", "max", "min", "normL1", "normL2")


def assembled(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Number and vector columns joined into one vector, in the given order."""
    return VectorAssembler(inputCols=columns, outputCol=out).transform(df)


def vector_total(vector: str) -> Column:
    """The sum of the entries that a vector stores; the zeros a sparse one leaves out are never made."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda a, x: a + x)


def column_stats(df: DataFrame, features: str, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """One row per vector position with the chosen metrics, from one pass."""
    summary = df.select(Summarizer.metrics(*metrics).summary(F.col(features)).alias("s"))
    arrays = [m for m in metrics if m != "count"]
    wide = summary.select(
        F.col("s.count").alias("count") if "count" in metrics else F.lit(None).alias("count"),
        *[vector_to_array(f"s.{m}").alias(m) for m in arrays],
    )
    zipped = F.posexplode(F.arrays_zip(*arrays)).alias("position", "m")
    rows = wide.select("count", zipped).select("position", "count", "m.*")
    return rows if "count" in metrics else rows.drop("count")


def correlations(df: DataFrame, features: str, method: str = "pearson") -> DataFrame:
    """The correlation matrix as rows (i, j, r); a constant column gives NaN."""
    matrix = Correlation.corr(df, features, method).first()[0]
    size = matrix.numRows
    cells = [(i, j, float(matrix[i, j])) for i in range(size) for j in range(size)]
    return df.sparkSession.createDataFrame(cells, "i int, j int, r double")


def independence(df: DataFrame, features: str, label: str) -> DataFrame:
    """Chi-square test of every feature against the label, one row per feature."""
    return ChiSquareTest.test(df, features, label, flatten=True)


def goodness_of_fit(df: DataFrame, category: str) -> DataFrame:
    """Chi-square statistic of the category counts against equal counts."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("o"))
    return fit_to_uniform(counts, "o")


def fit_to_uniform(counts: DataFrame, observed: str) -> DataFrame:
    """With n counts o of sum s, ``sum((o - s/n)^2 / (s/n))`` equals ``n * sum(o^2) / s - s``."""
    totals = counts.agg(
        F.sum(observed).alias("s"), F.count(F.lit(1)).alias("n"), F.sum(F.col(observed).cast("double") ** 2).alias("q")
    )
    return totals.select(
        (F.col("n") * F.col("q") / F.col("s") - F.col("s")).alias("statistic"), (F.col("n") - 1).alias("degrees_of_freedom")
    )


def p_value(spark: SparkSession, statistic: float, degrees_of_freedom: int) -> float:
    """Upper tail of the chi-square distribution."""
    law = spark.sparkContext._jvm.org.apache.commons.math3.distribution.ChiSquaredDistribution(float(degrees_of_freedom))
    return 1.0 - law.cumulativeProbability(float(statistic))


def long_vectors(df: DataFrame, id_column: str, *vectors: str) -> DataFrame:
    """Vectors of equal length as rows (id, position, one column per vector)."""
    arrays = F.arrays_zip(*[vector_to_array(v).alias(v) for v in vectors])
    rows = df.select(id_column, F.posexplode(arrays).alias("position", "x"))
    return rows.select(id_column, "position", *[F.col(f"x.{v}").alias(v) for v in vectors])
