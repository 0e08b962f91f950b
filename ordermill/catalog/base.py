"""Registry, shared tables and the entity definitions of the oracle SQL."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions as dims
from ..operators.dedup import latest_per_key
from ..operators.fact import build_fact, enrich, with_delivery_measures
from ..operators.keys import assign_dense_keys, extend_keys
from ..operators.scd2 import scd2_merge
from ..plans import marts
from ..session import handle_skew, scratch_root, small_tasks
from ..sources.binding import Source
from ..sources.parquet_io import write_partitioned

START, END = "1997-01-01", "1999-01-01"
YEARS = [1997, 1998]
FIRST_DAY = "1995-01-01"
MOVE_DATE = "1998-06-01"
CUTOFF = "1998-01-01"

_BUILT: dict[tuple[str, str, str], str] = {}
_RUNS = iter(range(10**9))


class Tables(Source):
    """Source entities plus warehouse and mart tables built from them.

    ``built`` tables are written once per session to the shared scratch folder
    and read back, as the warehouse and the marts they stand for are.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(small_tasks(handle_skew(spark)), sf_dir)

    def fresh_dir(self, name: str) -> str:
        return f"{scratch_root(self.spark)}/{name}-{next(_RUNS)}"

    def built(self, name: str) -> DataFrame:
        tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]
        key = (self.spark.sparkContext.applicationId, tag, name)
        if key not in _BUILT:
            path = f"{scratch_root(self.spark)}/built-{tag}/{name}"
            df = getattr(self, f"make_{name}")()
            if name.startswith("mart_"):
                write_partitioned(df, path)
            else:
                df.write.mode("overwrite").parquet(path)
            _BUILT[key] = path
        return self.spark.read.parquet(_BUILT[key])

    def path_of(self, name: str) -> str:
        self.built(name)
        tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]
        return _BUILT[(self.spark.sparkContext.applicationId, tag, name)]

    # ---- staging (clean source) -------------------------------------------

    @cached_property
    def staged_orders(self) -> DataFrame:
        return with_delivery_measures(self.orders)

    @cached_property
    def staged_items(self) -> DataFrame:
        return latest_per_key(
            self.items, ["order_id", "order_item_id"], "shipping_limit_date")

    @cached_property
    def staged_customers(self) -> DataFrame:
        return self.customers.select(
            "customer_id", "customer_unique_id",
            F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
            F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))

    # ---- warehouse ---------------------------------------------------------

    def make_dim_date(self) -> DataFrame:
        return dims.dim_date(dims.calendar_bounds(
            self.orders, F.to_date("order_purchase_timestamp")))

    def make_dim_product(self) -> DataFrame:
        return assign_dense_keys(dims.dim_product(self.products, self.translation),
                                 "product_id", "product_key")

    def make_dim_seller(self) -> DataFrame:
        return assign_dense_keys(dims.dim_seller(self.sellers), "seller_id", "seller_key")

    def make_dim_geography(self) -> DataFrame:
        keyed = assign_dense_keys(
            dims.dim_geography(self.geolocation, self.customers, self.sellers),
            "zip_code_prefix", "geo_key")
        return keyed.unionByName(dims.unknown_geography(keyed))

    def make_dim_customer_first(self) -> DataFrame:
        return assign_dense_keys(
            dims.dim_customer_initial(self.customers, self.orders, FIRST_DAY),
            "customer_unique_id", "customer_key")

    def make_dim_customer(self) -> DataFrame:
        import datetime as dt
        first = self.built("dim_customer_first")
        merged = scd2_merge(first, self.moved_customers, dt.date.fromisoformat(MOVE_DATE),
                            FIRST_DAY)
        return extend_keys(first, merged.drop("change"), "customer_unique_id",
                           "customer_key")

    def make_fact(self) -> DataFrame:
        return build_fact(self.staged_items, self.staged_orders, self.staged_customers,
                          self.built("dim_customer"), self.built("dim_product"),
                          self.built("dim_seller"), self.built("dim_geography"))

    def enriched(self, *wanted: str) -> DataFrame:
        """The fact with the attributes asked for and no other dimension."""
        return enrich(self.built("fact"), {
            "product_key": self.built("dim_product"), "geo_key": self.built("dim_geography"),
            "customer_key": self.built("dim_customer"),
            "seller_key": self.built("dim_seller")}, wanted)

    # ---- marts -------------------------------------------------------------

    def make_mart_revenue(self) -> DataFrame:
        return marts.revenue_daily(self.enriched(*marts.REVENUE_NEEDS))

    def make_mart_delivery(self) -> DataFrame:
        return marts.delivery_performance(self.enriched(*marts.DELIVERY_NEEDS))

    def make_mart_cohorts(self) -> DataFrame:
        return marts.customer_cohorts(self.enriched(*marts.COHORT_NEEDS))


# ---- oracle fragments ------------------------------------------------------

def rounded(num: str, den: str, digits: int) -> str:
    """num / den rounded half away from zero, in integer arithmetic."""
    k = 10 ** digits
    return (f"cast((case when ({num}) < 0 then -1 else 1 end) * "
            f"((2*{k}*abs(cast(({num}) as hugeint)) + abs(cast(({den}) as hugeint)))"
            f" // nullif(2*abs(cast(({den}) as hugeint)), 0)) as double) / {k}")


def pct(num: str, den: str) -> str:
    return rounded(f"100*({num})", den, 2)


def cents(money: str) -> str:
    return f"cast(({money})*100 as hugeint)"


_AMOUNT = "cast(floor(o_totalprice) as bigint)"
_HOURS = "to_hours(cast(o_orderkey % 24 as int))"

CTES: dict[str, str] = {
    "src_orders": f"""
        select o_orderkey as order_id, o_custkey as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                    else 'canceled' end as order_status,
               o_orderdate as order_purchase_timestamp,
               case when o_orderstatus <> 'P' then o_orderdate + {_HOURS} end
                   as order_approved_at,
               case when o_orderstatus <> 'P' then o_orderdate
                   + to_days(cast(1 + {_AMOUNT} % 5 as int)) + {_HOURS} end
                   as order_delivered_carrier_date,
               case when o_orderstatus = 'F' and o_orderkey % 29 <> 0 then o_orderdate
                   + to_days(cast({_AMOUNT} % 45 as int)) + {_HOURS} end
                   as order_delivered_customer_date,
               o_orderdate + to_days(cast(20 + o_custkey % 15 as int))
                   as order_estimated_delivery_date
        from orders""",
    "src_items": """
        select l_orderkey as order_id, l_linenumber as order_item_id,
               l_partkey as product_id, l_suppkey as seller_id,
               l_shipdate as shipping_limit_date,
               cast(l_extendedprice as decimal(12,2)) as price,
               cast(l_quantity as decimal(12,2)) as freight_value
        from lineitem""",
    "src_customers": """
        select c_custkey as customer_id, c_custkey // 3 as customer_unique_id,
               lpad(cast(c_nationkey * 3970 + c_custkey % 7 + 1 as varchar), 5, '0')
                   as customer_zip_code_prefix,
               lower(c_mktsegment) as customer_city,
               'N' || chr(65 + c_nationkey) as customer_state
        from customer""",
    "src_sellers": """
        select s_suppkey as seller_id,
               lpad(cast(s_nationkey * 3970 + s_suppkey % 9 + 1 as varchar), 5, '0')
                   as seller_zip_code_prefix,
               'town ' || (s_suppkey % 11) as seller_city,
               'N' || chr(65 + s_nationkey) as seller_state
        from supplier""",
    "src_products": """
        select p_partkey as product_id,
               case when p_size <> 50 then lower(p_type) end as product_category_name,
               p_size * 100 as product_weight_g, p_size + 10 as product_length_cm,
               p_size + 5 as product_height_cm, p_size + 7 as product_width_cm
        from part""",
    "src_translation": """
        select * from (values ('economy', 'economy_goods'),
            ('standard', 'standard_goods'), ('promo', 'promo_goods'),
            ('large', 'large_goods'))
            t(product_category_name, product_category_name_english)""",
    "src_geolocation": """
        select lpad(cast(c_nationkey * 3970 + c_custkey % 7 + 1 as varchar), 5, '0')
                   as zip,
               cast(round(cast(c_acctbal as decimal(12,2)) * 100) as bigint) as lat_e4,
               c_custkey % 180 as lng,
               lower(c_mktsegment) as city, 'N' || chr(65 + c_nationkey) as state
        from customer""",
    "src_payments": """
        select l_orderkey as order_id, l_linenumber as payment_sequential,
               case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto'
                    else 'voucher' end as payment_type,
               l_linenumber as payment_installments,
               cast(l_extendedprice as decimal(12,2)) as payment_value
        from lineitem where l_linestatus = 'F'""",
    "run_events": """
        select user_id as run_id, event_type || '.' || event_id as step,
               ts as started_at,
               case when event_type <> 'view'
                    then ts + to_microseconds(cast(trunc(value * 1000) as bigint)) end
                   as ended_at,
               event_id as rows_in, event_id + 1 as rows_out,
               case when event_type = 'error' then 1 else 0 end as rows_rejected,
               case event_type when 'error' then 'failed' when 'view' then 'running'
                    else 'success' end as status,
               case when event_type = 'error' then props end as message
        from events""",
    "categories": """
        select product_id, coalesce(product_category_name_english,
                   product_category_name, '(uncategorised)') as category
        from src_products left join src_translation using (product_category_name)""",
    "stg_orders": """
        select *, date_diff('day', order_purchase_timestamp,
                   order_delivered_customer_date) as delivery_days,
               date_diff('day', order_estimated_delivery_date,
                   order_delivered_customer_date) as days_vs_estimate,
               order_delivered_customer_date > order_estimated_delivery_date as is_late
        from src_orders""",
    "stg_orders_int": """
        select * replace (cast(delivery_days as int) as delivery_days,
                          cast(days_vs_estimate as int) as days_vs_estimate)
        from stg_orders""",
    "stg_items": """
        select * exclude (rn) from (
            select *, row_number() over (partition by order_id, order_item_id
                order by shipping_limit_date desc, product_id desc, seller_id desc,
                         price desc, freight_value desc) as rn
            from src_items) where rn = 1""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date,
               cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
               cast(month(d) as int) as month, monthname(d) as month_name,
               cast(day(d) as int) as day_of_month,
               cast(isodow(d) as int) as day_of_week, dayname(d) as day_name,
               cast(week(d) as int) as week_of_year, isodow(d) >= 6 as is_weekend,
               cast(date_trunc('month', d) as date) as month_start,
               last_day(d) as month_end
        from (select cast(unnest(generate_series(
                date_trunc('year', min(o_orderdate)),
                date_trunc('year', max(o_orderdate)) + interval 1 year
                    - interval 1 day, interval 1 day)) as date) as d
              from orders)""",
    "dim_product": """
        select row_number() over (order by left(md5(cast(product_id as varchar)), 2),
                   product_id) as product_key,
               product_id, product_category_name as category_pt, category as category_en,
               product_weight_g as weight_g, product_length_cm as length_cm,
               product_height_cm as height_cm, product_width_cm as width_cm
        from src_products join categories using (product_id)""",
    "dim_seller": """
        select row_number() over (order by left(md5(cast(seller_id as varchar)), 2),
                   seller_id) as seller_key,
               seller_id, seller_city, seller_state,
               seller_zip_code_prefix as zip_code_prefix
        from src_sellers""",
    "modal": """
        select zip, city, state, n from (
            select zip, city, state, count(*) as n, row_number() over (partition by zip
                order by count(*) desc, city, state) as rn
            from src_geolocation group by zip, city, state) where rn = 1""",
    "centre": """
        select zip, cast(sum(lat_e4) as double) / 10000 / count(*) as latitude,
               cast(sum(lng) as double) / count(*) as longitude
        from src_geolocation group by zip""",
    "address_zips": """
        select zip, city, state from (
            select *, row_number() over (partition by zip order by city, state) as rn
            from (select customer_zip_code_prefix as zip, customer_city as city,
                         customer_state as state from src_customers
                  union all
                  select seller_zip_code_prefix, seller_city, seller_state
                  from src_sellers)) where rn = 1""",
    "places": """
        select m.zip, m.city, m.state, c.latitude, c.longitude
        from modal m join centre c using (zip)
        union all
        select zip, city, state, null, null from address_zips
        where zip not in (select zip from modal)""",
    "dim_geography": """
        select row_number() over (order by left(md5(zip), 2), zip) as geo_key,
               zip as zip_code_prefix, city, state, latitude, longitude from places
        union all select -1, 'n/a', '(unknown)', 'XX', null, null""",
    "dim_customer_first": """
        select row_number() over (order by left(md5(cast(customer_unique_id
                   as varchar)), 2), customer_unique_id) as customer_key,
               customer_unique_id, customer_city, customer_state,
               customer_zip_code_prefix as zip_code_prefix
        from (select *, row_number() over (partition by customer_unique_id
                  order by last_order desc nulls last, customer_id) as rn
              from src_customers left join (
                  select customer_id, max(order_purchase_timestamp) as last_order
                  from src_orders group by 1) using (customer_id))
        where rn = 1""",
    "addresses": """
        select customer_unique_id, customer_city as city, customer_state as state,
               customer_zip_code_prefix as zip_code_prefix
        from (select *, row_number() over (partition by customer_unique_id
                  order by customer_id) as rn from src_customers) where rn = 1""",
    "moved": "select customer_unique_id from addresses where city = 'household'",
    "dim_customer": f"""
        select customer_key, customer_unique_id, customer_city, customer_state,
               zip_code_prefix, date '{FIRST_DAY}' as valid_from,
               case when customer_unique_id in (from moved) then date '{MOVE_DATE}'
                    else date '9999-12-31' end as valid_to,
               customer_unique_id not in (from moved) as is_current
        from dim_customer_first
        union all
        select (select max(customer_key) from dim_customer_first)
               + row_number() over (order by left(md5(cast(customer_unique_id
                   as varchar)), 2), customer_unique_id),
               customer_unique_id, 'curitiba', 'PR', '80010', date '{MOVE_DATE}',
               date '9999-12-31', true
        from moved""",
    "fact": """
        select cast(strftime(o.order_purchase_timestamp, '%Y%m%d') as int) as date_key,
               dc.customer_key, dp.product_key, ds.seller_key,
               coalesce(dg.geo_key, -1) as geo_key, i.order_id, i.order_item_id,
               o.order_status, i.price, i.freight_value, o.delivery_days,
               o.days_vs_estimate, o.is_late
        from stg_items i join stg_orders o using (order_id)
        join src_customers c on c.customer_id = o.customer_id
        join dim_product dp on dp.product_id = i.product_id
        join dim_seller ds on ds.seller_id = i.seller_id
        join dim_customer dc on dc.customer_unique_id = c.customer_unique_id
             and cast(o.order_purchase_timestamp as date) >= dc.valid_from
             and cast(o.order_purchase_timestamp as date) < dc.valid_to
        left join dim_geography dg on dg.zip_code_prefix = c.customer_zip_code_prefix""",
    "star": """
        select f.*, d.full_date as order_date, d.year, d.month, d.month_start,
               d.month_name, p.category_en as category, g.state as customer_state,
               s.seller_id, s.seller_state, c.customer_unique_id
        from fact f join dim_date d using (date_key) join dim_product p
        using (product_key) join dim_geography g using (geo_key)
        join dim_seller s using (seller_key) join dim_customer c using (customer_key)""",
    "replay_items": """
        select * exclude (rn) from (
            select *, row_number() over (partition by order_id, order_item_id
                order by product_id desc, seller_id desc, shipping_limit_date desc,
                         price desc, freight_value desc) as rn
            from src_items) where rn = 1""",
    "replay_star": """
        select i.*, o.order_status, o.delivery_days, o.days_vs_estimate, o.is_late,
               cast(o.order_purchase_timestamp as date) as order_date,
               cast(year(o.order_purchase_timestamp) as int) as year,
               cast(month(o.order_purchase_timestamp) as int) as month,
               category, customer_state, seller_state, customer_unique_id
        from replay_items i join stg_orders o using (order_id)
        join src_customers c on c.customer_id = o.customer_id
        join categories using (product_id) join src_sellers using (seller_id)""",
    "mart_revenue": f"""
        select *, {rounded("cast(sum(revenue_x * 100) over w as hugeint)",
                           "100 * count(*) over w", 2)} as revenue_7d_avg,
               count(*) over w as days_in_window
        from (select order_date, year, month, category, customer_state,
                     sum(price) as revenue_x, cast(sum(price) as double) as revenue,
                     count(distinct order_id) as orders, count(*) as items
              from star where order_status <> 'canceled' group by 1, 2, 3, 4, 5)
        window w as (partition by category, customer_state order by order_date
                     rows between 6 preceding and current row)""",
    "mart_delivery": f"""
        select year, month, customer_state, seller_id, seller_state,
               count(*) as delivered_items,
               {rounded("sum(delivery_days)", "count(*)", 1)} as avg_delivery_days,
               {rounded("sum(days_vs_estimate)", "count(*)", 1)} as avg_days_vs_promise,
               count(*) filter (where is_late) as late_items,
               {pct("count(*) filter (where is_late)", "count(*)")} as late_pct
        from star where order_status = 'delivered' and delivery_days is not null
        group by 1, 2, 3, 4, 5""",
    "cohort_rows": """
        select cohort_month, (year(order_date) - year(cohort_month)) * 12
                   + month(order_date) - month(cohort_month) as month_offset,
               count(distinct customer_unique_id) as customers,
               count(distinct order_id) as orders
        from star join (
            select customer_unique_id, cast(date_trunc('month', min(order_date)) as date)
                       as cohort_month
            from star where order_status <> 'canceled' group by 1)
            using (customer_unique_id)
        where order_status <> 'canceled' group by 1, 2""",
    "mart_cohorts": f"""
        select cohort_month, cast(month_offset as int) as month_offset, customers, orders,
               cohort_size, {pct("customers", "cohort_size")} as retention_pct,
               cast(year(cohort_month) as int) as year,
               cast(month(cohort_month) as int) as month
        from cohort_rows join (select cohort_month, customers as cohort_size
            from cohort_rows where month_offset = 0) using (cohort_month)
        where month_offset between 0 and 3""",
}


def with_entities(sql: str) -> str:
    """Prepend the entity definitions a statement mentions, with theirs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    used = [f"{n} as ({CTES[n].strip()})" for n in CTES if n in needed]
    if not used:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(used) + ",\n" + body[5:]
    return "with " + ",\n".join(used) + "\n" + body


# ---- registry --------------------------------------------------------------

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a key, with its oracle."""
    def register(fn: Callable[[Tables], DataFrame]):
        if key in _QUERIES:
            raise ValueError(f"{key} registered twice")
        _QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            _ORACLES[key] = with_entities(sql)
        return fn
    return register


def doubles(df: DataFrame) -> DataFrame:
    """Money leaves the queries as double, so both engines report one type."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal")
                       else F.col(c) for c, t in df.dtypes])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
