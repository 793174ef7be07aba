"""Adapters that present the star-schema test tables as the distributor's source tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class SourceTables:
    items: DataFrame
    item_attrs: DataFrame
    attr_values: DataFrame
    faces: DataFrame
    face_attrs: DataFrame
    orders: DataFrame
    order_items: DataFrame


# Known schemas spare a job per table that would only read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as iid",
        "case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 "
        "when 'PROMO' then 4 when 'SMALL' then 5 when 'STANDARD' then 6 end as itid",
        "case when p_size = 50 then 0 else 1 end as activeflag",
    )


def item_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as id", "635 as attrid", "cast(substring(p_brand, 7) as int) as attrvalueid", "1 as activeflag"
    )


def attr_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(substring(p_brand, 7) as int) as attrvalueid", "p_brand as attrvaluename"
    ).distinct()


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as fid", "c_nationkey as distid", "1 as ftype",
        "case when c_custkey % 37 = 0 then 0 else 1 end as factiveflag",
    )


def face_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    lat = customer.where("c_custkey % 29 <> 0").selectExpr(
        "c_custkey as fid", "360 as attrid",
        "replace(cast(cast(52 + (c_custkey % 8) * 0.013 as decimal(9,3)) as string), '.', ',') as attrtext",
        "1 as activeflag",
    )
    lon = customer.where("c_custkey % 29 <> 0").selectExpr(
        "c_custkey as fid", "361 as attrid",
        "replace(cast(cast(39 + (c_custkey % 5) * 0.017 as decimal(9,3)) as string), '.', ', ') as attrtext",
        "1 as activeflag",
    )
    klass = customer.selectExpr(
        "c_custkey as fid", "602 as attrid", "c_mktsegment as attrtext",
        "case when c_custkey % 31 = 0 then 0 else 1 end as activeflag",
    )
    kind = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("c_custkey as fid", "555 as attrid", "r_name as attrtext", "1 as activeflag")
    )
    return lat.unionByName(lon).unionByName(klass).unionByName(kind)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey % 7 as masterfid", "o_orderkey as orid", "o_custkey as mfid", "o_orderdate as ordate",
        "case when o_orderstatus = 'P' then 2 else 1 end as ortype",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey % 7 as masterfid", "l_orderkey as orid", "l_partkey as iid", "l_quantity as amount",
        "l_extendedprice * (1 - l_discount) as roubles",
    )


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    return SourceTables(
        items(spark, sf_dir), item_attrs(spark, sf_dir), attr_values(spark, sf_dir), faces(spark, sf_dir),
        face_attrs(spark, sf_dir), orders(spark, sf_dir), order_items(spark, sf_dir),
    )


def brand_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw brand rules: missing quantum and label values, turbo flag as text.

    The mean price is rounded to cents, halves up, in whole cents.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return (
        items(spark, sf_dir)
        .join(item_attrs(spark, sf_dir), F.col("iid") == F.col("id"))
        .join(part, F.col("iid") == F.col("p_partkey"))
        .groupBy("itid", "attrvalueid")
        .agg(F.sum(F.round(F.col("p_retailprice") * 100)).alias("cents"), F.count(F.lit(1)).alias("n"))
        .withColumn("AvgPrice", F.floor((F.col("cents") * 2 + F.col("n")) / (F.col("n") * 2)) / 100)
        .selectExpr(
            "itid as CategoryID", "attrvalueid as GroupID",
            "case when attrvalueid % 13 = 0 then null else 1 + attrvalueid % 6 end as BrandQuantum",
            "case attrvalueid % 5 when 4 then 'MustList' when 3 then 'DriveList' when 2 then 'NPI' "
            "when 1 then 'SPEED' end as ImportanceLabel",
            "attrvalueid % 5 as PriorityWeight",
            "case when attrvalueid % 4 = 1 then 'Да' else 'Нет' end as IsTurboBrand",
            "AvgPrice",
        )
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular daily observations with several rows on some days."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(ts as date) as VisitDate", "user_id as PointID",
        "case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3 "
        "when 'signup' then 4 when 'view' then 5 end as CategoryID",
        "value as SumRoubles",
    )
