"""The registry's tables as views over the test tables.

The same shapes as in production, derived from order, customer, event and
document tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.operators.joins import lookup
from personpub.operators.lists import cells, list_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CODE = "lpad(cast({} as string), 10, '0')"


def code(c: Column) -> Column:
    return F.lpad(c.cast("string"), 10, "0")


def v_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("_first"))
    return lookup(orders, first, "o_custkey").selectExpr(
        f"{CODE.format('o_orderkey + 1')} as kirjekood",
        f"{CODE.format('_first + 1')} as persoon",
        "if(o_orderkey % 23 = 0, null, o_orderpriority) as kirje",
        "o_orderpriority as perenimi",
        "o_orderstatus as eesnimi",
        "o_orderkey % 3 = 0 as pub_kivi",
        "o_orderkey % 2 = 0 as pub_emem",
        "o_orderstatus = 'F' as pub_evo",
    )


def v_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    # nations are a fixed list, in every scale
    return customer.join(F.broadcast(nation), "c_nationkey").selectExpr(
        f"{CODE.format('c_custkey')} as persoon",
        "case when c_custkey % 17 = 0 then '' when c_custkey % 19 = 0 then '12-34'"
        " else concat(c_name, ', ', c_mktsegment) end as kirje",
        "cast(null as string) as evokirje",
        "if(c_custkey % 13 = 0, '', c_mktsegment) as perenimi",
        "if(c_custkey % 13 = 0 or c_custkey % 5 = 0, '', c_name) as eesnimi",
        "if(c_custkey % 4 = 0, '', n_name) as isanimi",
        "'' as emanimi",
        "if(c_custkey % 7 = 0, '', '1920-05-17 00:00:00') as synd",
        "'' as surm",
        "n_name as synnikoht",
        "'' as surmakoht",
        "'[]' as kirjed",
        "'[]' as pereseosed",
        "'[]' as tahvlikirje",
        "'[]' as episoodid",
        "c_custkey % 10 <> 0 as isperson",
        "c_custkey % 3 = 0 as kivi",
        "c_custkey % 2 = 0 as emem",
        "c_mktsegment = 'BUILDING' as evo",
        "c_nationkey < 5 as wwiiref",
        "c_acctbal < 0 as mv",
        "c_custkey % 6 = 0 as ylikoolis_oppinud",
        f"if(c_custkey % 11 = 0, {CODE.format('c_custkey + 1')}, '') as redirect",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey) as updated",
    )


def v_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record lists from orders and episodes from events, a row per element."""
    orders = table(spark, sf_dir, "orders").select(
        code(F.col("o_custkey")).alias("persoon"), code(F.col("o_orderkey") + 1).alias("kirjekood")
    )
    events = table(spark, sf_dir, "events").select(
        code(F.col("user_id")).alias("persoon"),
        code(F.col("event_id")).alias("_event"),
        F.col("event_type").alias("nimetus"),
        F.col("ts").cast("date").cast("string").alias("aeg"),
    )
    episode = F.to_json(F.struct("nimetus", F.lit("").alias("asukoht"), "aeg"))
    record = F.to_json(F.struct("kirjekood"))
    return list_rows(orders, "persoon", "kirjekood", record, "kirjed").unionByName(
        list_rows(events, "persoon", "_event", episode, "episoodid")
    )


def v_person_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_person as a source table has it: each list in a cell, some of them broken."""
    lists = v_list(spark, sf_dir)
    broken = F.col("persoon").try_cast("bigint") % 29 == 0
    return (
        v_person(spark, sf_dir)
        .join(cells(lists, "persoon", "kirjed").withColumnRenamed("kirjed", "_kirjed"), "persoon", "left")
        .join(
            cells(lists, "persoon", "episoodid").withColumnRenamed("episoodid", "_episoodid"),
            "persoon",
            "left",
        )
        .withColumn(
            "kirjed", F.when(broken, F.lit("[{")).otherwise(F.coalesce("_kirjed", F.lit("[]")))
        )
        .withColumn("episoodid", F.coalesce("_episoodid", F.lit("[]")))
        .drop("_kirjed", "_episoodid")
    )


def v_evo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(
            code(F.col("c_custkey")).alias("persoon"),
            F.concat(F.lit("EVO "), "c_name").alias("kirje"),
        )
    )


def v_stone(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_orderkey % 2 = 0")
    keys = lines.select("l_orderkey").distinct()
    unknown = table(spark, sf_dir, "orders").agg((F.max("o_orderkey") + 1000).alias("l_orderkey"))
    return keys.unionAll(unknown).select(
        code(F.col("l_orderkey") + 1).alias("kirjekood"),
        F.lit(None).cast("string").alias("persoon"),
    )


def v_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .select(code(F.col("o_custkey")).alias("persoon"))
    )


def v_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("c_custkey") % 4
    return (
        table(spark, sf_dir, "customer")
        .filter(rest.isin(0, 1))
        .select(
            code(F.col("c_custkey")).alias("persoon"),
            F.md5(code(F.col("c_custkey"))).alias("entu_id"),
            F.when(rest == 0, F.expr("timestamp_ntz'2024-02-01 00:00:00'")).alias("sync_ts"),
        )
    )


def v_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_rows(table(spark, sf_dir, "events"))


def change_rows(events: DataFrame) -> DataFrame:
    return events.select(
        code(F.col("user_id")).alias("id"),
        "ts",
        "event_id",
        (F.col("event_type") == "error").alias("tombstone"),
        F.col("props").alias("payload"),
    )


def v_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    other = customer.select((F.col("c_custkey") - 1).alias("c_custkey"))
    return (
        customer.filter("c_custkey % 2 = 0")
        .join(other, "c_custkey")
        .select(
            code(F.col("c_custkey")).alias("persoon"),
            code(F.col("c_custkey") + 1).alias("other"),
            F.lit("spouse").alias("kind"),
        )
    )


def v_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


VIEWS = {
    "v_record": v_record,
    "v_person": v_person,
    "v_list": v_list,
    "v_person_json": v_person_json,
    "v_evo": v_evo,
    "v_stone": v_stone,
    "v_register": v_register,
    "v_sync": v_sync,
    "v_change": v_change,
    "v_relation": v_relation,
    "v_doc": v_doc,
}


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return VIEWS[view](spark, sf_dir)
