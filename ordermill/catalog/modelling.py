"""Keys of cleaning, merge and dimensional modelling."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import dimensions as dims
from ..operators import staging
from ..operators.dedup import drop_copies, duplicate_summary, latest_per_key
from ..operators.keys import assign_dense_keys
from ..operators.merge import upsert_ignore, upsert_update
from ..operators.scd2 import change_counts, scd2_merge
from .base import FIRST_DAY, MOVE_DATE, doubles, query

AS_OF = dt.date.fromisoformat(MOVE_DATE)


# ---- cleaning --------------------------------------------------------------

STAGED_CUSTOMERS = """
    select customer_id, customer_unique_id,
           customer_zip_code_prefix as zip_code_prefix,
           customer_city || ' do sul novo' as city, customer_state as state
    from src_customers"""


@query("stage_customers", STAGED_CUSTOMERS)
def _(t):
    return staging.stage_customers(t.raw_customers)[0]


@query("stage_orders", "from stg_orders_int")
def _(t):
    return staging.stage_orders(t.raw_orders)[0]


RAW_ITEMS = """
    select l_orderkey as order_id, l_linenumber as order_item_id,
           l_partkey as product_id, l_suppkey as seller_id,
           l_shipdate as shipping_limit_date,
           case when l_returnflag = 'R' and l_tax = 0 then -1 else 1 end
               * cast(l_extendedprice as decimal(12,2)) as price,
           cast(l_quantity as decimal(12,2)) as freight_value
    from lineitem"""


STAGED_ITEMS = f"""
    select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           cast(price as double) as price, cast(freight_value as double) as freight_value
    from (select *, row_number() over (partition by order_id, order_item_id
              order by shipping_limit_date desc, product_id desc, seller_id desc,
                       price desc, freight_value desc) as rn
          from ({RAW_ITEMS}) where price >= 0 and freight_value >= 0) where rn = 1"""


@query("stage_items", STAGED_ITEMS)
def _(t):
    return doubles(staging.stage_items(t.raw_items)[0])


@query("stage_items_rejects", f"""
    select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           cast(price as double) as price, cast(freight_value as double) as freight_value
    from ({RAW_ITEMS}) where not (price >= 0 and freight_value >= 0)""")
def _(t):
    return doubles(staging.stage_items(t.raw_items)[1].drop("_extracted_at"))


# ---- merges ----------------------------------------------------------------

@query("upsert_update", """
    select coalesce(o.product_id, n.product_id) as product_id,
           case when n.product_id is null then o.category_pt else n.category_pt end
               as category_pt,
           case when n.product_id is null then o.weight_g else n.weight_g end as weight_g,
           case when o.product_id is null then n.length_cm else o.length_cm end
               as length_cm
    from (select product_id, product_category_name as category_pt,
                 product_weight_g as weight_g, product_length_cm as length_cm
          from src_products where product_category_name is not null) o
    full join (select product_id, upper(product_category_name) as category_pt,
                      product_weight_g + 1 as weight_g, -1 as length_cm
               from src_products where product_weight_g >= 2500) n
    on o.product_id = n.product_id""")
def _(t):
    """Heavy products arrive changed; length is not among the updated columns."""
    base = t.products.select(
        "product_id", F.col("product_category_name").alias("category_pt"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"))
    incoming = base.filter("weight_g >= 2500").select(
        "product_id", F.upper("category_pt").alias("category_pt"),
        (F.col("weight_g") + 1).alias("weight_g"), F.lit(-1).alias("length_cm"))
    return upsert_update(base.filter("category_pt is not null"), incoming,
                         ["product_id"], ["category_pt", "weight_g"])


@query("upsert_ignore", """
    select zip as zip_code_prefix, city, state from modal
    union all
    select zip, city, state from address_zips where zip not in (select zip from modal)""")
def _(t):
    return upsert_ignore(dims.modal_place(t.geolocation).drop("n"),
                         dims.zip_places(t.customers, t.sellers), ["zip_code_prefix"])


@query("dedup_delete", """
    with doubled as (from src_customers union all
                     (from src_customers where customer_city = 'household'))
    select count(distinct customer_id) as total_rows,
           count(distinct customer_id) as distinct_keys,
           cast(0 as bigint) as duplicate_rows,
           count(*) - count(distinct customer_id) as removed from doubled""")
def _(t):
    """Identical copies: keep one of each key, report what went."""
    doubled = t.customers.unionByName(t.customers.filter("customer_city = 'household'"))
    before = duplicate_summary(doubled, ["customer_id"])
    after = duplicate_summary(drop_copies(doubled, ["customer_id"]), ["customer_id"])
    return after.withColumn("removed", before.select("duplicate_rows").scalar())


@query("dedup_latest", """
    select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           cast(price as double) as price, cast(freight_value as double) as freight_value
    from stg_items""")
def _(t):
    landed = t.items.withColumn("_extracted_at", F.col("shipping_limit_date"))
    return doubles(latest_per_key(landed, ["order_id", "order_item_id"])
                   .drop("_extracted_at"))


# ---- dimensions ------------------------------------------------------------

@query("dim_date", "from dim_date")
def _(t):
    return t.make_dim_date()


@query("dim_date_slim", """
    select date_key, full_date, year, quarter, month, month_name, day_of_week,
           is_weekend, month_start from dim_date""")
def _(t):
    return dims.dim_date(dims.calendar_bounds(
        t.orders, F.to_date("order_purchase_timestamp")), slim=True)


@query("dim_product", "from dim_product")
def _(t):
    return t.make_dim_product()


@query("dim_seller", "from dim_seller")
def _(t):
    return t.make_dim_seller()


@query("dim_geography", "from dim_geography")
def _(t):
    return t.make_dim_geography()


@query("dim_geography_first_city", """
    select zip as zip_code_prefix, city, state from address_zips""")
def _(t):
    """The variant that takes the first city of each zip from the addresses."""
    return dims.zip_places(t.customers, t.sellers)


@query("dim_customer_initial", f"""
    select customer_unique_id, customer_city, customer_state, zip_code_prefix,
           date '{FIRST_DAY}' as valid_from, date '9999-12-31' as valid_to,
           true as is_current from dim_customer_first""")
def _(t):
    return dims.dim_customer_initial(t.customers, t.orders, FIRST_DAY)


@query("dim_customer_lowest_id", f"""
    select customer_unique_id, city as customer_city, state as customer_state,
           zip_code_prefix, date '{FIRST_DAY}' as valid_from,
           date '9999-12-31' as valid_to, true as is_current from addresses""")
def _(t):
    return dims.dim_customer_initial(t.customers, None, FIRST_DAY)


@query("surrogate_keys", """
    select customer_unique_id, row_number() over (
        order by left(md5(cast(customer_unique_id as varchar)), 2), customer_unique_id)
        as customer_key
    from (select distinct customer_unique_id from src_customers)""")
def _(t):
    return assign_dense_keys(t.customers.select("customer_unique_id").distinct(),
                             "customer_unique_id", "customer_key")


@query("scd2_merge", f"""
    with d as (
        select f.*, a.city, a.state, a.zip_code_prefix as zip,
               f.customer_city is distinct from a.city
               or f.customer_state is distinct from a.state
               or f.zip_code_prefix is distinct from a.zip_code_prefix as changed
        from dim_customer_first f join addresses a using (customer_unique_id))
    select customer_unique_id, customer_city, customer_state, zip_code_prefix,
           date '{FIRST_DAY}' as valid_from,
           case when changed then date '{MOVE_DATE}' else date '9999-12-31' end
               as valid_to,
           not changed as is_current,
           case when changed then 'versioned' else 'unchanged' end as change from d
    union all
    select customer_unique_id, city, state, zip, date '{MOVE_DATE}', date '9999-12-31',
           true, 'versioned' from d where changed""")
def _(t):
    """From the latest order's address to that of the lowest customer id."""
    first = dims.dim_customer_initial(t.customers, t.orders, FIRST_DAY).select(
        F.lit(None).cast("long").alias("customer_key"), "*")
    return scd2_merge(first, t.customer_addresses, AS_OF, FIRST_DAY).drop("customer_key")


@query("scd2_change_counts", """
    select count(*) as expired, cast(0 as bigint) as corrected, count(*) as versioned,
           (select count(*) from addresses where city = 'furniture') as new
    from moved""")
def _(t):
    """One merge with every outcome: movers, newcomers and the untouched."""
    first = t.built("dim_customer_first")
    newcomers = t.customer_addresses.filter("city = 'furniture'")
    known = first.join(newcomers, "customer_unique_id", "left_anti").select(first.columns)
    incoming = t.moved_customers.unionByName(newcomers)
    return change_counts(scd2_merge(known, incoming, AS_OF, FIRST_DAY))


@query("scd2_demo", """
    with target as (select customer_unique_id from src_orders join src_customers
            using (customer_id) where customer_unique_id in (from moved)
            group by 1 having count(*) >= 3 order by 1 limit 1)
    select 'AFTER' as stage, customer_unique_id, customer_city, customer_state,
           valid_from, valid_to, is_current from dim_customer
    where customer_unique_id in (from target)
    union all
    select 'BEFORE', customer_unique_id, customer_city, customer_state,
           date '1995-01-01', date '9999-12-31', true from dim_customer_first
    where customer_unique_id in (from target)""")
def _(t):
    """One mover with at least three orders, before and after the change."""
    movers = t.moved_customers.select("customer_unique_id")
    target = (t.orders.select("customer_id")
              .join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
              .join(movers, "customer_unique_id", "left_semi")
              .groupBy("customer_unique_id").agg(F.count("*").alias("n"))
              .filter("n >= 3").orderBy("customer_unique_id").limit(1)
              .select("customer_unique_id"))
    columns = ["customer_unique_id", "customer_city", "customer_state", "valid_from",
               "valid_to", "is_current"]
    before = t.built("dim_customer_first").join(F.broadcast(target), "customer_unique_id")
    after = t.built("dim_customer").join(F.broadcast(target), "customer_unique_id")
    return before.select(F.lit("BEFORE").alias("stage"), *columns).unionByName(
        after.select(F.lit("AFTER").alias("stage"), *columns))


@query("scd2_fact_versions", """
    select f.order_id, f.order_item_id, d.customer_city as city_on_fact, d.valid_from,
           d.valid_to, d.is_current
    from fact f join dim_customer d using (customer_key)
    where d.customer_unique_id in (from moved)""")
def _(t):
    """Facts of the movers: older orders keep the old address."""
    d = t.built("dim_customer")
    movers = d.join(t.moved_customers.select("customer_unique_id"),
                    "customer_unique_id", "left_semi")
    return t.built("fact").join(movers, "customer_key").select(
        "order_id", "order_item_id", F.col("customer_city").alias("city_on_fact"),
        "valid_from", "valid_to", "is_current")


# ---- fact ------------------------------------------------------------------

@query("build_fact", """
    select * replace (cast(price as double) as price,
                      cast(freight_value as double) as freight_value,
                      cast(delivery_days as int) as delivery_days,
                      cast(days_vs_estimate as int) as days_vs_estimate) from fact""")
def _(t):
    return doubles(t.make_fact())


@query("build_fact_from_source", """
    select order_id, order_item_id, product_id, seller_id, category, customer_state,
           cast(delivery_days as int) as delivery_days,
           cast(days_vs_estimate as int) as days_vs_estimate, is_late,
           cast(order_purchase_timestamp as date) as order_date
    from stg_items join stg_orders using (order_id)
    join src_customers using (customer_id) join categories using (product_id)
    join src_sellers using (seller_id)""")
def _(t):
    from ..operators.fact import fact_from_source
    return fact_from_source(t.staged_items, t.orders, t.customers, t.products, t.sellers,
                            t.translation).select(
        "order_id", "order_item_id", "product_id", "seller_id", "category",
        "customer_state", "delivery_days", "days_vs_estimate", "is_late", "order_date")
