"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, *, null_tokens: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """A delimited file with a header and a declared schema; ``null_tokens`` become null in string columns."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"').csv(path)
    if not null_tokens:
        return df
    return df.select(*[
        F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
        for f in df.schema])


def write_results(df: DataFrame, path: str, *, fmt: str = "csv") -> None:
    """Search results as CSV with a header, or Parquet."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def read_stacked_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A file of several stacked ``code,description`` sections: ``(source, code_type, code, description)``."""
    text = spark.read.option("wholetext", True).text(path)
    return parse_stacked_lookup(text.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))


def parse_stacked_lookup(df: DataFrame, *, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Sections start at the top and after each line that holds only separators; their first line names the code.

    Lines are numbered within their own file and carry the last header seen.
    """
    lines = df.select(F.col(source_col).alias("source"), F.posexplode(F.split(F.regexp_replace(text_col, "\r", ""), "\n")).alias("line", "value"))
    blank = F.col("value").rlike("^[,\\s]*$")
    w = Window.partitionBy("source").orderBy("line")
    marked = lines.withColumn("after_gap", F.coalesce(F.lag(blank).over(w), F.lit(True))).filter(~blank)
    cell = F.from_csv(F.col("value"), F.lit("code string, description string"), {"escape": '"'})
    split = marked.withColumn("c", cell).withColumn("header", F.when(F.col("after_gap"), F.trim("c.code")))
    carried = split.withColumn("code_type", F.last("header", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    description = F.trim("c.description")
    return carried.filter(~F.col("after_gap")).select(
        "source", "code_type", F.trim("c.code").alias("code"), F.when(description != "NULL", description).alias("description"))


def describe_codes(facts: DataFrame, lookup: DataFrame, column: str, code_type: str) -> DataFrame:
    """Add ``<column>_description`` from the lookup."""
    one = lookup.filter(F.col("code_type") == code_type).select(F.col("code").alias("_code"), F.col("description").alias(f"{column}_description"))
    return facts.join(one, facts[column].cast("string") == F.col("_code"), "left").drop("_code")
