"""Keys of scans and sinks. Files are written from the given tables first.

The JDBC source has no key: it needs a database, see ``sources.jdbc``.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dimensions as dims
from ..operators.incremental import with_lineage
from ..operators.plan_audit import partition_layout
from ..plans.adhoc import q
from ..schemas import SOURCE_DDL
from ..sources import csv_tables, parquet_io
from ..sources.layers import Layers
from .base import CUTOFF, doubles, query


def as_csv(t, df, name: str, schema: str):
    path = t.fresh_dir(f"csv-{name}")
    csv_tables.write_csv(df, path)
    return csv_tables.read_csv(t.spark, path, schema, name in csv_tables.MULTI_LINE)


@query("csv_scan", """
    select cast(order_id as varchar) as order_id, order_item_id,
           cast(product_id as varchar) as product_id,
           cast(seller_id as varchar) as seller_id, shipping_limit_date,
           cast(price as double) as price, cast(freight_value as double) as freight_value
    from src_items""")
def _(t):
    return doubles(as_csv(t, t.items, "items", SOURCE_DDL["order_items"]))


@query("csv_scan_multiline", "select doc_id, lang, text, n_chars from documents")
def _(t):
    """Texts with quotes and line breaks survive the round trip."""
    docs = t.table("documents").select("doc_id", "lang", "text", "n_chars")
    return as_csv(t, docs, "documents",
                  "doc_id long, lang string, text string, n_chars "
                  + dict(docs.dtypes)["n_chars"])


LOADED = {"product_category_translation": "translation", "customers": "customers",
          "sellers": "sellers", "orders": "orders", "order_items": "items",
          "order_payments": "payments"}


def loaded_tables(t):
    return {name: as_csv(t, getattr(t, entity), name, SOURCE_DDL[name])
            for name, entity in LOADED.items()}


COUNTS = {"product_category_translation": "src_translation",
          "customers": "src_customers", "sellers": "src_sellers", "orders": "src_orders",
          "order_items": "src_items", "order_payments": "src_payments"}


@query("load_reconcile", " union all ".join(
    f"select '{n}' as \"table\", count(*) as rows, count(*) as expected, true as ok "
    f"from {c}" for n, c in COUNTS.items()))
def _(t):
    """Tables delivered as CSV, loaded only if every count is as expected."""
    expected = {n: getattr(t, e).count() for n, e in LOADED.items()}
    return csv_tables.load_sources(loaded_tables(t), t.fresh_dir("source"), expected)


@query("load_probes", """
    select 'leading_zero_zips' as probe, count(*) as value from src_customers
    where customer_zip_code_prefix like '0%'
    union all select 'multi_line_comments', count(*) from documents
    where contains(text, chr(10))
    union all select 'undelivered', count(*) from src_orders
    where order_delivered_customer_date is null
    union all select 'categories', count(distinct product_category_name)
    from src_products""")
def _(t):
    return csv_tables.load_probes({
        "customers": t.customers, "order_reviews": t.review_texts,
        "orders": t.orders, "products": t.products})


@query("parquet_scan_pruned", """
    select order_date, category, customer_state, revenue from mart_revenue
    where year = 1998""")
def _(t):
    return parquet_io.read_pruned(
        t.spark, t.path_of("mart_revenue"), "year = 1998",
        ["order_date", "category", "customer_state", "revenue"])


@query("column_pruned_scan", """
    select l_linestatus, count(*) as items from lineitem group by 1""")
def _(t):
    return t.table("lineitem").select("l_linestatus").groupBy("l_linestatus").agg(
        F.count("*").alias("items"))


@query("partitioned_sink", """
    select year, month, count(*) as rows, cast(sum(revenue_x) as double) as revenue
    from mart_revenue group by 1, 2""")
def _(t):
    """Written by year and month, then one year replaced by itself alone."""
    path = t.fresh_dir("mart")
    mart = t.built("mart_revenue")
    parquet_io.write_partitioned(mart, path)
    parquet_io.write_partitioned(mart.filter("year = 1998"), path, dynamic=True)
    return t.spark.read.parquet(path).groupBy("year", "month").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("revenue").cast("decimal(20,2)")).cast("double").alias("revenue"))


@query("partition_layout", """
    select year, month, cast(1 as bigint) as files, count(*) as rows
    from mart_revenue group by 1, 2""")
def _(t):
    mart = t.spark.read.parquet(t.path_of("mart_revenue"))
    return partition_layout(mart, ["year", "month"]).drop("bytes")


@query("parquet_codecs", " union all ".join(
    f"select '{f}' as format, count(*) as rows, {s} as smaller from src_items"
    for f, s in (("csv", "false"), ("parquet (snappy)", "true"),
                 ("parquet (gzip)", "true"), ("parquet (none)", "true"))))
def _(t):
    return parquet_io.compare_codecs(t.items, t.fresh_dir("codecs")).select(
        "format", "rows", (F.col("times_smaller") > 1).alias("smaller"))


TYPES = [("order_id", "bigint", "int"), ("customer_id", "bigint", "int"),
         ("order_status", "string", "string"),
         *[(c, "timestamp_ntz", "timestamp") for c in (
             "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date")]]


@query("type_roundtrip", " union all ".join(
    f"select '{c}' as \"column\", '{a}' as original, '{b}' as csv, '{a}' as parquet, "
    f"{str(a == b).lower()} as csv_ok, true as parquet_ok, count({c}) as filled "
    f"from src_orders" for c, a, b in TYPES))
def _(t):
    return parquet_io.type_roundtrip(t.orders, t.fresh_dir("types"))


@query("ctas", """
    select seller_state, count(*) as sellers from (
        from src_sellers union all from src_sellers where seller_state = 'NB')
    group by 1""")
def _(t):
    path = t.fresh_dir("ctas")
    stored = parquet_io.create_table_as(t.sellers, path)
    stored = parquet_io.insert_select(t.sellers.filter("seller_state = 'NB'"), path)
    return stored.groupBy("seller_state").agg(F.count("*").alias("sellers"))


@query("literal_rows", """
    select geo_key, zip_code_prefix, city, state from dim_geography""")
def _(t):
    keyed = t.built("dim_geography").filter("geo_key > 0")
    return keyed.unionByName(dims.unknown_geography(keyed)).select(
        "geo_key", "zip_code_prefix", "city", "state")


@query("sql_text", """
    select c_mktsegment as segment, count(*) as orders, max(o_orderdate) as last_at
    from orders join customer on c_custkey = o_custkey group by 1""")
def _(t):
    return q(t.spark, """
        select c_mktsegment as segment, count(*) as orders, max(o_orderdate) as last_at
        from v_orders join v_customer on c_custkey = o_custkey group by 1""",
             {"v_orders": t.table("orders"), "v_customer": t.table("customer")})


@query("raw_append", f"""
    select case when order_purchase_timestamp < timestamp '{CUTOFF}' then 1 else 2 end
               as _run_id, count(*) as rows, min(order_purchase_timestamp) as first_at
    from src_orders group by 1""")
def _(t):
    """Two landings; the second run is replayed and does not double."""
    import datetime as dt
    layers = Layers(t.spark, t.fresh_dir("raw"))
    at = dt.datetime(2002, 1, 1)
    early = F.col("order_purchase_timestamp") < F.lit(CUTOFF).cast("timestamp_ntz")
    for run_id, rows in ((1, t.orders.filter(early)), (2, t.orders.filter(~early)),
                         (2, t.orders.filter(~early))):
        layers.append_run("raw/orders", with_lineage(rows, run_id, at))
    return layers.read("raw/orders").groupBy("_run_id").agg(
        F.count("*").alias("rows"), F.min("order_purchase_timestamp").alias("first_at"))
