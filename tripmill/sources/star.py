"""The given star tables, and a trip-shaped view derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The star tables' dates are moved by whole years, so that 1998 becomes 2024.
YEARS_MOVED = 26


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the footers once per path, since each look is a Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def moved(day: Column | str) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return day + F.make_ym_interval(F.lit(YEARS_MOVED), F.lit(0))


def bridge_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup over nations; key 24 is left out, which makes unmatched zones."""
    return (
        table(spark, sf_dir, "nation")
        .where("n_nationkey <> 24")
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "n_nationkey as LocationID",
            """case when n_nationkey = 1 then 'EWR'
                    when n_nationkey = 20 then 'Staten Island'
                    when r_name = 'AFRICA' then 'Manhattan'
                    when r_name = 'AMERICA' then 'Brooklyn'
                    when r_name = 'ASIA' then 'Queens'
                    when r_name = 'EUROPE' then 'Bronx'
                    else 'Unknown' end as Borough""",
            """case n_nationkey when 1 then 'Newark Airport'
                                when 2 then 'JFK Airport'
                                when 3 then 'LaGuardia Airport'
                                when 5 then 'Grand Central'
                                else n_name end as Zone""",
            "if(n_nationkey in (1, 2, 3), 'Airports', 'Boro Zone') as service_zone",
        )
    )


def bridge_trips(
    spark: SparkSession,
    sf_dir: str,
    lineitem: DataFrame | None = None,
) -> DataFrame:
    """Bronze-shaped trips over lineitem, orders, customer and supplier.

    One trip in twenty is submitted a second time under the next month, with a
    higher tip. Both submissions come out of one pass over the joins.

    Orders meet their customers before they meet the lines, so that the largest
    table is shuffled on as few keys, and as late, as possible.

    ``lineitem`` may be a streaming read of that table.
    """
    lineitem = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    orders = table(spark, sf_dir, "orders")
    placed = orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    return (
        lineitem.join(placed, F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .selectExpr(
            "*",
            f"o_orderdate + make_ym_interval({YEARS_MOVED}, 0) as _day",
            "cast((l_partkey * 37) % 1440 as int) as _minute",
            "cast(l_quantity as int) * 2 - 3 + if(l_partkey % 211 = 0, 525600, 0) as _length",
            "floor(l_extendedprice) as _cents",
            "cast(substring(o_orderpriority, 1, 1) as int) as _paid",
            "explode(if(l_partkey % 20 = 7, array(0, 1), array(0))) as _copy",
        )
        .selectExpr(
            "l_linenumber % 2 + 1 as VendorID",
            "_day + make_dt_interval(0, 0, _minute) as tpep_pickup_datetime",
            "_day + make_dt_interval(0, 0, _minute + _length) as tpep_dropoff_datetime",
            "cast(nullif(l_suppkey % 7, 6) as bigint) as passenger_count",
            "cast(l_partkey % 400 - 5 as double) / 10 as trip_distance",
            "cast(l_linenumber as bigint) as RatecodeID",
            "if(l_returnflag = 'R', 'Y', 'N') as store_and_fwd_flag",
            "if(l_partkey % 97 = 0, null, c_nationkey) as PULocationID",
            "s_nationkey as DOLocationID",
            "_paid as payment_type",
            "cast(_cents % 8000 - 100 as double) / 100 as fare_amount",
            "cast(l_linenumber as double) / 4 as extra",
            "0.5D as mta_tax",
            "if(_paid = 1, cast(_cents % 1600 as double) / 100, 0D) + _copy as tip_amount",
            "cast(l_partkey % 3 as double) as tolls_amount",
            "1D as improvement_surcharge",
            "date_format(_day + make_ym_interval(0, _copy), 'yyyy-MM') as source_month",
        )
    )
