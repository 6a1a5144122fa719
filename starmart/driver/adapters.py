"""The given tables in the shapes the mart works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.functions.calendar import SAS_EPOCH
from starmart.operators.dimensions import clean_airlines, clean_airports
from starmart.operators.filters import in_dimension
from starmart.operators.lookup import sized
from starmart.schemas import KEPT_COLUMNS, RAW_ARRIVALS
from starmart.session import size_shuffles
from starmart.sources import paths
from starmart.sources.codebook import code_class

# Order priorities play the visa classes, regions of the world the home region.
ORDERS_CONFIG = MartConfig(
    visa_classes=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    home_region="R-1",
    placeholder_airlines=("Customer#000000001",),
)
REPORT_YEAR = 1996


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    path = f"{sf_dir}/{name}.parquet"
    size_shuffles(spark, paths.size_of(spark, path))
    return spark.read.parquet(path)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their date as a date and as a SAS day number."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").withColumns(
        {
            "order_day": day,
            "arrdate": F.datediff(day, F.lit(SAS_EPOCH).cast("date")).cast("double"),
        }
    )


def arrivals(spark: SparkSession, sf_dir: str, ports: DataFrame | None = None) -> DataFrame:
    """Orders as arrivals: the customer's nation is the port, the segment the airline.

    ``ports`` keeps the arrivals at the airports of a dimension. Spark does not move a semi join
    on the port below the join of orders and customers, so it is applied to the nations.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    if ports is not None:
        nation = in_dimension(nation, "n_name", ports, "airport_code")
    customer = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = orders(spark, sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    year = F.year("order_day")
    raw = {
        "cicid": F.col("o_orderkey").cast("double"),
        "i94yr": year.cast("double"),
        "i94mon": F.month("order_day").cast("double"),
        "i94port": F.col("n_name"),
        "arrdate": F.col("arrdate"),
        "biryear": (year - (F.lit(18) + F.col("o_custkey") % 60)).cast("double"),
        "gender": F.nullif(F.col("o_orderstatus"), F.lit("P")),
        "airline": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        "admnum": F.col("o_totalprice").cast("string"),
        "fltno": (F.col("o_custkey") % 1000).cast("string"),
        "visatype": F.col("o_orderpriority"),
    }
    return joined.select(*(raw[name].alias(name) for name in KEPT_COLUMNS))


def line_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as arrivals: the order is the number, which so repeats; some have none.

    The supplier's nation is the port; every sixth line number has neither day nor birth year.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_nationkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    day = F.col("l_shipdate").cast("date")
    known = F.col("l_linenumber") != 6
    raw = {
        "cicid": F.when(F.col("l_linenumber") != 7, F.col("l_orderkey").cast("double")),
        "i94yr": F.year(day).cast("double"),
        "i94mon": F.month(day).cast("double"),
        "i94port": F.col("n_name"),
        "arrdate": F.when(known, F.datediff(day, F.lit(SAS_EPOCH).cast("date")).cast("double")),
        "biryear": F.when(known, (F.year(day) - F.col("l_partkey") % 90).cast("double")),
        "gender": F.nullif(F.col("l_returnflag"), F.lit("N")),
        "airline": F.col("l_linestatus"),
        "admnum": F.col("l_partkey").cast("string"),
        "fltno": F.col("l_suppkey").cast("string"),
        "visatype": F.when(F.col("l_linenumber") % 2 == 1, "1-URGENT").otherwise("2-HIGH"),
    }
    joined = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(*(raw[name].alias(name) for name in KEPT_COLUMNS))


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with all columns of the raw file; those the fact does not use are empty."""
    rows = arrivals(spark, sf_dir)
    return rows.select(
        *(
            F.col(f.name) if f.name in KEPT_COLUMNS else F.lit(None).cast(f.dataType).alias(f.name)
            for f in RAW_ARRIVALS.fields
        )
    )


def port_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as an airport file: the ports of the arrivals."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Port of "), "n_name").alias("name"),
        F.lit("large_airport").alias("type"),
        F.col("n_name").alias("municipality"),
        F.col("n_name").alias("local_code"),
        F.concat(F.lit("R-"), F.col("n_regionkey").cast("string")).alias("iso_region"),
    )


def carrier_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segments as an airline file: the airlines of the arrivals, one not active."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        segment.alias("iata"),
        F.concat(F.lit("Air "), segment).alias("name"),
        F.lit("Earth").alias("country"),
        F.when(segment != "MACHINERY", "Y").otherwise("N").alias("active"),
    )


def home_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_airports(port_source(spark, sf_dir), ORDERS_CONFIG)


def segment_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few airlines, which Spark cannot know to be few: their source is a large table."""
    return sized(clean_airlines(carrier_source(spark, sf_dir), ORDERS_CONFIG))


def airport_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as an uncleaned airport file, with codes missing and repeated."""
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("s_suppkey")
    return supplier.select(
        F.col("s_name").alias("name"),
        F.when(key % 3 == 0, "large_airport")
        .when(key % 3 == 1, "medium_airport")
        .otherwise("small_airport")
        .alias("type"),
        F.col("n_name").alias("municipality"),
        F.when(key % 7 != 0, F.concat(F.lit("P"), F.floor(key / 2).cast("string"))).alias(
            "local_code"
        ),
        F.concat(F.lit("R-"), F.col("n_regionkey").cast("string")).alias("iso_region"),
    )


def airline_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an uncleaned airline file, with codes missing, empty and repeated."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    return customer.select(
        F.when(key % 10 == 9, "")
        .when(key % 11 != 0, F.concat(F.lit("A"), F.floor(key / 2).cast("string")))
        .alias("iata"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("active"),
    )


def nation_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of four regions as port codes by name and as country codes by number.

    One region's codes are marked as invalid.
    """
    listed = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 4)
    label = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("INVALID: "), "n_name")).otherwise(
        F.concat("n_name", F.lit(" PORT"))
    )
    ports = listed.select(
        F.lit("port").alias("domain"), F.col("n_name").alias("code"), label.alias("label")
    )
    countries = listed.select(
        F.lit("country").alias("domain"),
        F.col("n_nationkey").cast("string").alias("code"),
        label.alias("label"),
    )
    return ports.unionByName(countries).withColumn("code_class", code_class(F.col("label")))


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        F.year("order_day").alias("year"), F.month("order_day").alias("month_num")
    )
