"""Code dictionary: value lists of a SAS format file as ``(domain, code, label, code_class)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Format names in the dictionary file and the domains they describe.
DOMAINS = {
    "i94cntyl": "country",
    "i94prtl": "port",
    "i94model": "mode",
    "i94addrl": "state",
}
# A domain that the file only mentions in a comment.
VISA_CATEGORIES = [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]

# A list ends with a semicolon at the end of a line, so each list is one text record.
LIST_END = ";\n"
LIST_NAME = r"(?m)^\s*value\s+\$?(\w+)\s*$"
ENTRY = r"(?m)^\s*('[^']*'|\d+)\s*=\s*'((?:[^']|'')*)'"


def code_class(label: Column) -> Column:
    """Whether a listed code is in use, judged by the start of its label."""
    return (
        F.when(label.startswith("INVALID:"), "invalid")
        .when(label.startswith("No Country Code") | label.startswith("No PORT Code"), "no_code")
        .when(label.startswith("Collapsed"), "collapsed")
        .otherwise("valid")
    )


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    lists = spark.read.option("lineSep", LIST_END).text(path)
    named = lists.select(F.regexp_extract("value", LIST_NAME, 1).alias("name"), "value")
    entries = named.filter(F.col("name") != "").select(
        F.coalesce(
            F.element_at(
                F.create_map(*(F.lit(text) for pair in DOMAINS.items() for text in pair)), F.col("name")
            ),
            F.col("name"),
        ).alias("domain"),
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("value", F.lit(ENTRY), F.lit(1)).alias("code"),
                F.regexp_extract_all("value", F.lit(ENTRY), F.lit(2)).alias("label"),
            )
        ).alias("entry"),
    )
    listed = entries.select(
        "domain",
        F.trim(F.replace(F.col("entry.code"), F.lit("'"), F.lit(""))).alias("code"),
        F.rtrim(F.replace(F.col("entry.label"), F.lit("''"), F.lit("'"))).alias("label"),
    )
    visa = spark.createDataFrame(VISA_CATEGORIES, "code string, label string").select(
        F.lit("visa_category").alias("domain"), "code", "label"
    )
    return listed.unionByName(visa).withColumn("code_class", code_class(F.col("label")))
