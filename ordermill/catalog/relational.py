"""Keys of the single relational operators (projection to scalar functions)."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import (clean_code, clean_place, date_key, differs, is_late,
                                 iso_weekday, mean, month_offset, month_start, pct,
                                 seconds_between)
from ..operators import dimensions as dims
from ..operators import joins, windows
from ..operators.dedup import duplicate_summary, first_per_key
from ..operators.fact import fact_from_source
from ..plans.questions import active_months, monthly_revenue
from .base import END, MOVE_DATE, START, cents, doubles, pct as pct_sql, query, rounded

PLACED = "order_purchase_timestamp"
MONTH_SQL = f"cast(date_trunc('month', {PLACED}) as date)"


# ---- projections, filters, predicates --------------------------------------

@query("project", """
    select order_id, order_item_id as line, cast(price as double) as price,
           cast(price + freight_value as double) as total, 'item' as kind
    from src_items""")
def _(t):
    return doubles(t.items.select(
        "order_id", F.col("order_item_id").alias("line"), "price",
        (F.col("price") + F.col("freight_value")).alias("total"),
        F.lit("item").alias("kind")))


@query("filter_cmp", """
    select order_id, order_item_id, cast(price as double) as price from src_items
    where (price < 1000 or freight_value >= 50) and order_item_id <> 3
      and product_id > 100""")
def _(t):
    return doubles(t.items.filter(
        ((F.col("price") < 1000) | (F.col("freight_value") >= 50))
        & (F.col("order_item_id") != 3) & (F.col("product_id") > 100)
    ).select("order_id", "order_item_id", "price"))


@query("half_open_range", f"""
    select order_id, {PLACED} from src_orders
    where {PLACED} >= timestamp '{START}' and {PLACED} < timestamp '{END}'""")
def _(t):
    from ..plans.questions import placed_between
    return placed_between(t.orders, START, END).select("order_id", PLACED)


@query("null_tests", """
    select order_status, count(*) filter (where order_delivered_customer_date is null)
               as undelivered,
           count(*) filter (where order_approved_at is not null) as approved
    from src_orders group by 1""")
def _(t):
    return t.orders.groupBy("order_status").agg(
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("undelivered"),
        F.count_if(F.col("order_approved_at").isNotNull()).alias("approved"))


@query("in_between", """
    select product_id, product_weight_g from src_products
    where product_category_name in ('economy', 'promo')
      and product_weight_g between 1000 and 2000""")
def _(t):
    return t.products.filter(
        F.col("product_category_name").isin("economy", "promo")
        & F.col("product_weight_g").between(1000, 2000)
    ).select("product_id", "product_weight_g")


@query("like_filter", """
    select customer_id, customer_zip_code_prefix, customer_city from src_customers
    where customer_zip_code_prefix like '0%' or customer_city like '%hold%'""")
def _(t):
    return t.customers.filter(
        F.col("customer_zip_code_prefix").startswith("0")
        | F.col("customer_city").contains("hold")
    ).select("customer_id", "customer_zip_code_prefix", "customer_city")


@query("regex_filter", """
    select doc_id, n_chars from documents
    where not regexp_matches(text, '^[0-9A-Za-z ,.]+$')""")
def _(t):
    return t.table("documents").filter(
        ~F.col("text").rlike(r"^[0-9A-Za-z ,.]+\z")).select("doc_id", "n_chars")


@query("distinct_from", """
    select c.customer_id from src_customers c
    join addresses a using (customer_unique_id)
    where c.customer_city is distinct from a.city
       or c.customer_state is distinct from a.state
       or c.customer_zip_code_prefix is distinct from a.zip_code_prefix""")
def _(t):
    c = t.customers.join(t.customer_addresses, "customer_unique_id")
    return c.filter(differs(
        (F.col("customer_city"), F.col("city")), (F.col("customer_state"), F.col("state")),
        (F.col("customer_zip_code_prefix"), F.col("zip_code_prefix")))
    ).select("customer_id")


@query("case_when", "select order_id, is_late from stg_orders")
def _(t):
    return t.orders.select("order_id", is_late(
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date")).alias("is_late"))


@query("coalesce_chain", "select category, count(*) as products from categories group by 1")
def _(t):
    return (t.products.join(t.translation, "product_category_name", "left")
            .groupBy(dims.category().alias("category"))
            .agg(F.count("*").alias("products")))


@query("nullif_guard", """
    select event_type, user_id, cast(sum(event_id % 3) as bigint) as part,
           cast(sum(event_id % 2) as bigint) as whole,
           cast(sum(event_id % 3) as double) / nullif(sum(event_id % 2), 0) as quotient
    from events group by 1, 2""")
def _(t):
    e = F.col("event_id")
    sums = t.table("events").groupBy("event_type", "user_id").agg(
        F.sum(e % 3).alias("part"), F.sum(e % 2).alias("whole"))
    return sums.withColumn("quotient", F.col("part").cast("double")
                           / F.nullif("whole", F.lit(0)))


STATE_CATEGORY = """select customer_state as state, category, sum(price) as revenue
    from src_items join src_orders using (order_id) join src_customers
    using (customer_id) join categories using (product_id) group by 1, 2"""


def state_category(t):
    f = fact_from_source(t.items, t.orders, t.customers, t.products, t.sellers,
                         t.translation)
    return f.groupBy(F.col("customer_state").alias("state"), "category").agg(
        F.sum("price").alias("revenue"))


@query("filter_on_window", f"""
    select seller_id, month, cast(revenue as double) as revenue from (
        select *, row_number() over (partition by seller_id
                  order by revenue desc, month) as rn
        from (select seller_id, {MONTH_SQL} as month, sum(price) as revenue
              from src_items join src_orders using (order_id) group by 1, 2))
    where rn <= 2""")
def _(t):
    monthly = (t.items.join(t.orders, "order_id")
               .groupBy("seller_id", month_start(F.col(PLACED)).alias("month"))
               .agg(F.sum("price").alias("revenue")))
    w = Window.partitionBy("seller_id").orderBy(F.desc("revenue"), "month")
    return doubles(monthly.withColumn("rn", F.row_number().over(w))
                   .filter("rn <= 2").drop("rn"))


@query("ordinal_group", """
    select order_status, cast(year(order_purchase_timestamp) as int) as year,
           count(*) as orders from src_orders group by 1, 2 order by 1, 2""")
def _(t):
    return t.spark.sql("""
        select order_status, year(order_purchase_timestamp) as year, count(*) as orders
        from {orders} group by 1, 2 order by 1, 2""", orders=t.orders)


# ---- joins -----------------------------------------------------------------

@query("inner_join", """
    select order_status, count(*) as items, cast(sum(price) as double) as revenue
    from src_orders join src_items using (order_id) group by 1""")
def _(t):
    return doubles(t.orders.join(t.items, "order_id").groupBy("order_status").agg(
        F.count("*").alias("items"), F.sum("price").alias("revenue")))


@query("join_chain", f"select state, category, cast(revenue as double) as revenue "
                     f"from ({STATE_CATEGORY})")
def _(t):
    return doubles(state_category(t))


@query("left_join", """
    select product_id, coalesce(product_category_name_english, '(none)') as english
    from src_products left join src_translation using (product_category_name)""")
def _(t):
    return t.products.join(t.translation, "product_category_name", "left").select(
        "product_id", F.coalesce("product_category_name_english", F.lit("(none)"))
        .alias("english"))


@query("star_join", """
    select year, category, customer_state, seller_state, count(*) as items,
           count(distinct customer_unique_id) as customers,
           cast(sum(price) as double) as revenue
    from star group by 1, 2, 3, 4""")
def _(t):
    return doubles(t.enriched("category", "customer_state", "seller_state",
                              "customer_unique_id").groupBy(
        "year", "category", "customer_state", "seller_state").agg(
        F.count("*").alias("items"),
        F.countDistinct("customer_unique_id").alias("customers"),
        F.sum("price").alias("revenue")))


@query("join_strategy_compare", """
    with one as (select seller_state, count(*) as items,
                        cast(sum(price) as double) as revenue
                 from src_items join src_sellers using (seller_id) group by 1)
    select 'broadcast' as strategy, * from one
    union all select 'sort-merge', * from one""")
def _(t):
    """The same join twice: the hash side broadcast if its size allows, and
    forced to sort-merge."""
    sellers = t.sellers.select("seller_id", "seller_state")

    def total(side, label):
        return (t.items.join(side, "seller_id").groupBy("seller_state")
                .agg(F.count("*").alias("items"), F.sum("price").alias("revenue"))
                .withColumn("strategy", F.lit(label)))

    return doubles(total(joins.small_side(sellers), "broadcast").unionByName(
        total(sellers.hint("merge"), "sort-merge")))


@query("scd2_point_in_time", """
    select o.order_id, d.customer_city, d.customer_state, d.valid_from, d.is_current
    from src_orders o join src_customers c using (customer_id)
    join dim_customer d on d.customer_unique_id = c.customer_unique_id
         and cast(o.order_purchase_timestamp as date) >= d.valid_from
         and cast(o.order_purchase_timestamp as date) < d.valid_to""")
def _(t):
    people = t.orders.select("order_id", "customer_id", PLACED).join(
        t.customers.select("customer_id", "customer_unique_id"), "customer_id")
    return joins.point_in_time(people, t.built("dim_customer"), "customer_unique_id",
                               F.to_date(PLACED)).select(
        "order_id", "customer_city", "customer_state", "valid_from", "is_current")


NO_ITEMS = """select order_id, order_status from src_orders o where not exists
    (select 1 from src_items i where i.order_id = o.order_id)"""


@query("anti_join_not_exists", NO_ITEMS)
def _(t):
    return t.orders.join(t.items.select("order_id").distinct(), "order_id",
                         "left_anti").select("order_id", "order_status")


@query("anti_join_left_null", NO_ITEMS)
def _(t):
    items = t.items.select(F.col("order_id").alias("item_order")).distinct()
    return (t.orders.join(items, F.col("order_id") == F.col("item_order"), "left")
            .filter(F.col("item_order").isNull()).select("order_id", "order_status"))


@query("not_in_null_trap", f"""
    select (select count(*) from src_products where product_category_name not in
                (select case when product_category_name <> 'economy' then
                     product_category_name end from src_products)) as not_in_rows,
           (select count(*) from src_products p where not exists
                (select 1 from (select case when product_category_name <> 'economy'
                     then product_category_name end as n from src_products) q
                 where q.n = p.product_category_name)) as anti_rows""")
def _(t):
    """NOT IN over a list holding a NULL keeps nothing; the anti-join keeps the
    unmatched rows. The list is reduced to its distinct names first."""
    listed = t.products.select(
        F.when(F.col("product_category_name") != "economy",
               F.col("product_category_name")).alias("n")).distinct()
    # Two facts about the list decide what NOT IN keeps; Spark's own NOT IN would
    # broadcast a list of any size.
    about = listed.agg(F.coalesce(F.bool_or(F.col("n").isNull()), F.lit(False)).alias("null"),
                       F.count(F.lit(1)).alias("size"))
    anti = t.products.join(listed, F.col("product_category_name") == F.col("n"),
                           "left_anti")
    counts = anti.agg(F.count(F.lit(1)).alias("anti_rows"),
                      F.count("product_category_name").alias("named"))
    kept = F.when(F.col("size") == 0, F.col("anti_rows")).when(
        F.col("null"), F.lit(0).cast("long")).otherwise(F.col("named"))
    return counts.join(F.broadcast(about)).select(  # one row each
        kept.alias("not_in_rows"), "anti_rows")


@query("semi_join_in", """
    select order_id, order_item_id from src_items where order_id in
        (select order_id from src_orders where order_status = 'shipped')""")
def _(t):
    return t.items.select("order_id", "order_item_id").join(
        t.orders.filter("order_status = 'shipped'"), "order_id", "left_semi")


@query("correlated_count", """
    select order_id, (select count(*) from src_items i where i.order_id = o.order_id)
        as items from src_orders o""")
def _(t):
    return joins.count_children(t.orders.select("order_id"), t.items, ["order_id"],
                                "items")


@query("multi_anti_or", """
    select order_id, order_item_id from stg_items i
    where not exists (select 1 from src_orders o where o.order_id = i.order_id
                      and o.order_status = 'delivered')
       or not exists (select 1 from src_products p where p.product_id = i.product_id
                      and p.product_category_name is not null)
       or not exists (select 1 from src_sellers s where s.seller_id = i.seller_id)""")
def _(t):
    return joins.missing_in_any(
        t.staged_items.select("order_id", "order_item_id", "product_id", "seller_id"),
        {"order_id": t.orders.filter("order_status = 'delivered'"),
         "product_id": t.products.filter("product_category_name is not null"),
         "seller_id": t.sellers}).select("order_id", "order_item_id")


@query("self_join_agg", f"""
    select customer_id, order_id, {PLACED} from src_orders join (
        select customer_id, min({PLACED}) as first_at from src_orders group by 1)
    using (customer_id) where {PLACED} = first_at""")
def _(t):
    """Each customer's orders of their first day."""
    first = t.orders.groupBy("customer_id").agg(F.min(PLACED).alias("first_at"))
    return (t.orders.select("customer_id", "order_id", PLACED).join(first, "customer_id")
            .filter(F.col(PLACED) == F.col("first_at")).drop("first_at"))


@query("join_with_topk", """
    select seller_id, order_id, order_item_id, cast(price as double) as price
    from src_items where seller_id in (select seller_id from src_items group by 1
        order by sum(price) desc, seller_id limit 5)""")
def _(t):
    top = (t.items.groupBy("seller_id").agg(F.sum("price").alias("total"))
           .orderBy(F.desc("total"), "seller_id").limit(5).select("seller_id"))
    return doubles(t.items.select("seller_id", "order_id", "order_item_id", "price")
                   .join(F.broadcast(top), "seller_id"))


@query("unknown_member_join", """
    select customer_id, coalesce(geo_key, -1) as geo_key from src_customers left join (
        select row_number() over (order by left(md5(zip), 2), zip) as geo_key, zip
        from (select distinct seller_zip_code_prefix as zip from src_sellers))
    on zip = customer_zip_code_prefix""")
def _(t):
    """Customers looked up in a geography that knows only the sellers' zips."""
    from ..operators.keys import assign_dense_keys
    zips = t.sellers.select(F.col("seller_zip_code_prefix").alias("zip")).distinct()
    geo = assign_dense_keys(zips, "zip", "geo_key")
    people = t.customers.select("customer_id",
                                F.col("customer_zip_code_prefix").alias("zip"))
    return joins.lookup_or_unknown(people, geo, "zip", "geo_key").select(
        "customer_id", "geo_key")


@query("scalar_subquery_arith", """
    select (select count(*) from src_items) as source_items,
           (select count(*) from fact) as fact_rows,
           (select count(*) from src_items) - (select count(*) from fact) as lost_rows""")
def _(t):
    n = F.count("*")
    return (t.items.agg(n.alias("source_items"))
            .withColumn("fact_rows", t.built("fact").agg(n).scalar())
            .withColumn("lost_rows", F.col("source_items") - F.col("fact_rows")))


@query("fanout_guard", """
    with i as (select order_id, count(*) as n, sum(price) as price from src_items group by 1),
         p as (select order_id, count(*) as n, sum(payment_value) as paid
               from src_payments group by 1)
    select cast(sum(price) as double) as revenue, cast(sum(paid) as double) as paid,
           cast(sum(price * p.n) as double) as inflated_revenue
    from i join p using (order_id)""")
def _(t):
    """Items and payments of an order aggregated before they meet; the inflated
    figure of the plain join follows from the payment count."""
    i = t.items.groupBy("order_id").agg(F.sum("price").alias("price"))
    p = t.payments.groupBy("order_id").agg(F.count("*").alias("n"),
                                           F.sum("payment_value").alias("paid"))
    return doubles(i.join(p, "order_id").agg(
        F.sum("price").alias("revenue"), F.sum("paid").alias("paid"),
        F.sum(F.col("price") * F.col("n")).alias("inflated_revenue")))


# ---- aggregations ----------------------------------------------------------

@query("group_agg", f"""
    select seller_id, cast(sum(price) as double) as revenue, count(*) as items,
           {rounded(cents("sum(price)"), "100 * count(*)", 2)} as avg_price,
           cast(min(price) as double) as lowest, cast(max(price) as double) as highest
    from src_items group by 1""")
def _(t):
    p = F.col("price")
    return doubles(t.items.groupBy("seller_id").agg(
        F.sum(p).alias("revenue"), F.count("*").alias("items"),
        mean(p, 2).alias("avg_price"), F.min(p).alias("lowest"),
        F.max(p).alias("highest")))


@query("count_distinct", """
    select seller_id, count(distinct order_id) as orders from src_items group by 1""")
def _(t):
    return t.items.groupBy("seller_id").agg(F.countDistinct("order_id").alias("orders"))


@query("agg_filter", """
    select customer_id, count(*) filter (where is_late) as late,
           count(*) filter (where order_status = 'canceled') as canceled
    from stg_orders group by 1""")
def _(t):
    return t.staged_orders.groupBy("customer_id").agg(
        F.count_if("is_late").alias("late"),
        F.count_if(F.col("order_status") == "canceled").alias("canceled"))


@query("cohort_pivot", f"""
    select cohort_month, """ + ", ".join(
    f"count(distinct customer_unique_id) filter (where off = {k}) as offset_{k}"
    for k in range(4)) + f"""
    from (select customer_unique_id, cohort_month,
                 (year({PLACED}) - year(cohort_month)) * 12
                 + month({PLACED}) - month(cohort_month) as off
          from src_orders join src_customers using (customer_id) join (
              select customer_unique_id, cast(date_trunc('month', min({PLACED})) as date)
                         as cohort_month
              from src_orders join src_customers using (customer_id)
              where order_status <> 'canceled' group by 1) using (customer_unique_id)
          where order_status <> 'canceled') group by 1""")
def _(t):
    return active_months(t.orders, t.customers).groupBy("cohort_month").agg(*[
        F.count_if(F.col("month_offset") == k).alias(f"offset_{k}") for k in range(4)])


@query("distinct_row_count", """
    select count(*) as total_rows,
           count(distinct (l_orderkey, l_linenumber)) as distinct_keys,
           count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicate_rows
    from lineitem""")
def _(t):
    return duplicate_summary(t.items, ["order_id", "order_item_id"])


@query("having", """
    select customer_id, count(*) as orders from src_orders group by 1
    having count(*) >= 3""")
def _(t):
    return t.orders.groupBy("customer_id").agg(F.count("*").alias("orders")).filter(
        "orders >= 3")


@query("global_agg", f"""
    select count(*) as orders, min({PLACED}) as first_at, max({PLACED}) as last_at,
           count(distinct customer_id) as customers from src_orders""")
def _(t):
    return t.orders.agg(
        F.count("*").alias("orders"), F.min(PLACED).alias("first_at"),
        F.max(PLACED).alias("last_at"),
        F.countDistinct("customer_id").alias("customers"))


@query("agg_over_agg", """
    select coalesce(max(n), 0) as most_items from (
        select count(*) as n from src_items group by order_id)""")
def _(t):
    return (t.items.groupBy("order_id").agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("most_items")))


@query("ratio_of_aggs", f"""
    select order_status, {pct_sql("count(*) filter (where is_late)", "count(*)")}
        as late_pct from stg_orders group by 1""")
def _(t):
    return t.staged_orders.groupBy("order_status").agg(
        pct(F.count_if("is_late"), F.count("*")).alias("late_pct"))


@query("group_by_expr", f"""
    select {MONTH_SQL} as month,
           case when o_totalprice >= 250000 then 'large' else 'small' end as size,
           count(*) as orders
    from (select *, o_orderdate as {PLACED} from orders) group by 1, 2""")
def _(t):
    return t.table("orders").groupBy(
        month_start(F.col("o_orderdate")).alias("month"),
        F.when(F.col("o_totalprice") >= 250000, "large").otherwise("small").alias("size"),
    ).agg(F.count("*").alias("orders"))


@query("modal_value", "select zip as zip_code_prefix, city, state, n from modal")
def _(t):
    return dims.modal_place(t.geolocation)


@query("centroid", "select zip as zip_code_prefix, latitude, longitude from centre")
def _(t):
    return dims.centroid(t.geolocation)


@query("cond_sum_bool", """
    select customer_id, cast(sum(cast(is_late as int)) as bigint) as late_orders
    from stg_orders group by 1""")
def _(t):
    return t.staged_orders.groupBy("customer_id").agg(
        F.sum(F.col("is_late").cast("int")).alias("late_orders"))


@query("mean_of_means", f"""
    select customer_state, {rounded("sum(tenths)", "10 * count(*)", 1)} as avg_days,
           {rounded("sum(tenths * delivered_items)", "10 * sum(delivered_items)", 1)}
               as weighted_avg_days
    from (select *, cast(round(avg_delivery_days * 10) as bigint) as tenths
          from mart_delivery) group by 1""")
def _(t):
    from ..functions.scalars import ratio
    days = F.col("avg_delivery_days").cast("decimal(10,1)")
    return t.built("mart_delivery").groupBy("customer_state").agg(
        mean(days, 1).alias("avg_days"),
        ratio(F.sum(days * F.col("delivered_items")), F.sum("delivered_items"), 1)
        .alias("weighted_avg_days"))


@query("sum_of_distincts", """
    select category, cast(sum(orders) as bigint) as summed_orders, exact_orders
    from mart_revenue join (
        select category, count(distinct order_id) as exact_orders from star
        where order_status <> 'canceled' group by 1) using (category)
    group by 1, 3""")
def _(t):
    """Distinct counts do not add up over groups: summed beside exact."""
    exact = t.enriched("category").filter("order_status <> 'canceled'").groupBy("category").agg(
        F.countDistinct("order_id").alias("exact_orders"))
    summed = t.built("mart_revenue").groupBy("category").agg(
        F.sum("orders").alias("summed_orders"))
    return summed.join(exact, "category")


@query("distinct_rows", """
    select distinct seller_id, product_id from src_items""")
def _(t):
    return t.items.select("seller_id", "product_id").distinct()


@query("order_by_agg", """
    select product_id from src_items group by 1
    order by sum(price) desc, product_id limit 20""")
def _(t):
    return (t.items.groupBy("product_id").agg(F.sum("price").alias("total"))
            .orderBy(F.desc("total"), "product_id").limit(20).select("product_id"))


# ---- window functions ------------------------------------------------------

@query("lag_growth", f"""
    select month, cast(revenue as double) as revenue,
           cast(prev as double) as prev_revenue,
           {pct_sql(f"{cents('revenue')} - {cents('prev')}", cents("prev"))} as growth_pct
    from (select *, lag(revenue) over (order by month) as prev from (
        select {MONTH_SQL} as month, sum(price) as revenue
        from src_items join src_orders using (order_id)
        where order_status <> 'canceled' group by 1))""")
def _(t):
    monthly = monthly_revenue(t.orders, t.items, "1900-01-01", "3000-01-01")
    return doubles(windows.growth(monthly.drop("orders"), "month", "revenue"))


@query("rank_topn", f"""
    select state, category, cast(revenue as double) as revenue, rnk from (
        select *, cast(rank() over (partition by state order by revenue desc) as int)
            as rnk from ({STATE_CATEGORY})) where rnk <= 3""")
def _(t):
    return doubles(windows.top_n(state_category(t), ["state"], [F.desc("revenue")], 3))


@query("running_total", f"""
    select seller_id, month, cast(revenue as double) as revenue,
           cast(sum(revenue) over (partition by seller_id order by month
                rows unbounded preceding) as double) as running_total
    from (select seller_id, {MONTH_SQL} as month, sum(price) as revenue
          from src_items join src_orders using (order_id) group by 1, 2)""")
def _(t):
    monthly = (t.items.join(t.orders.select("order_id", month_start(F.col(PLACED))
                                            .alias("month")), "order_id")
               .groupBy("seller_id", "month").agg(F.sum("price").alias("revenue")))
    return doubles(windows.running_total(monthly, ["seller_id"], "month", "revenue"))


@query("row_number_dedup", """
    select order_id, order_item_id, product_id, seller_id,
           cast(price as double) as price from stg_items""")
def _(t):
    return doubles(t.staged_items.select("order_id", "order_item_id", "product_id",
                                         "seller_id", "price"))


DAILY_STATE = """
    select customer_state, cast(order_purchase_timestamp as date) as day,
           sum(price) as revenue
    from src_items join src_orders using (order_id)
    join src_customers using (customer_id) group by 1, 2"""


def daily_state(t):
    days = t.orders.select("order_id", "customer_id", F.to_date(PLACED).alias("day"))
    return (t.items.select("order_id", "price").join(days, "order_id")
            .join(t.customers.select("customer_id", "customer_state"), "customer_id")
            .groupBy("customer_state", "day").agg(F.sum("price").alias("revenue")))


def _rolling(frame: str) -> str:
    avg = rounded("cast(sum(revenue * 100) over w as hugeint)",
                  "100 * count(*) over w", 2)
    return f"""
        select customer_state, day, cast(revenue as double) as revenue,
               {avg} as revenue_7d_avg, count(*) over w as days_in_window
        from ({DAILY_STATE})
        window w as (partition by customer_state order by day {frame})"""


@query("rolling_7rows", _rolling("rows between 6 preceding and current row"))
def _(t):
    return doubles(windows.rolling_rows(daily_state(t), ["customer_state"], "day",
                                        "revenue"))


@query("rolling_7days",
       _rolling("range between interval 6 days preceding and current row"))
def _(t):
    return doubles(windows.rolling_days(daily_state(t), ["customer_state"], "day",
                                        "revenue"))


@query("share_of_total", f"""
    select seller_id, cast(revenue as double) as revenue,
           {pct_sql(cents("revenue"), cents("total"))} as pct_of_total
    from (select *, sum(revenue) over () as total from (
        select seller_id, sum(price) as revenue from src_items group by 1))""")
def _(t):
    return doubles(windows.share_of_total(
        t.items.groupBy("seller_id").agg(F.sum("price").alias("revenue")), "revenue"))


@query("lead_gaps", """
    select customer_id, day, next_day, cast(next_day - day as int) as gap_days from (
        select customer_id, day,
               lead(day) over (partition by customer_id order by day) as next_day
        from (select distinct customer_id,
                     cast(order_purchase_timestamp as date) as day from src_orders))
    where next_day - day <> 1""")
def _(t):
    """Breaks between the order days of each customer."""
    days = t.orders.select("customer_id", F.to_date(PLACED).alias("day")).distinct()
    return windows.sequence_gaps(days, "day", ["customer_id"])


@query("distinct_on", f"""
    select distinct on (customer_id) customer_id, order_id, {PLACED} from src_orders
    order by customer_id, {PLACED}, order_id""")
def _(t):
    return first_per_key(t.orders.select("customer_id", "order_id", PLACED),
                         ["customer_id"], [PLACED, "order_id"])


RANKS = ["row_number()", "rank()", "dense_rank()", "ntile(4)"]


@query("rank_family", """
    select user_id, day, n,
           cast(row_number() over w as int) as row_number,
           cast(rank() over t as int) as rank,
           cast(dense_rank() over t as int) as dense_rank,
           cast(ntile(4) over w as int) as quartile,
           lead(n) over w as next_n,
           first_value(n) over w as first_n,
           last_value(n) over (w rows between unbounded preceding
               and unbounded following) as last_n,
           cast(sum(n) over t as bigint) as range_total,
           cast(sum(n) over (w rows unbounded preceding) as bigint) as rows_total
    from (select user_id, cast(ts as date) as day, count(*) as n
          from events group by 1, 2)
    window w as (partition by user_id order by n, day),
           t as (partition by user_id order by n)""")
def _(t):
    """All ranking functions on tied data: events per user and day. The default
    range frame sums ties together, the rows frame does not."""
    daily = t.table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"))
    tied = Window.partitionBy("user_id").orderBy("n")
    total = Window.partitionBy("user_id").orderBy("n", "day")
    whole = total.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = total.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "user_id", "day", "n", F.row_number().over(total).alias("row_number"),
        F.rank().over(tied).alias("rank"), F.dense_rank().over(tied).alias("dense_rank"),
        F.ntile(4).over(total).alias("quartile"), F.lead("n").over(total).alias("next_n"),
        F.first_value("n").over(total).alias("first_n"),
        F.last_value("n").over(whole).alias("last_n"),
        F.sum("n").over(tied).alias("range_total"), F.sum("n").over(rows)
        .alias("rows_total"))


# ---- sort, limit, set operations -------------------------------------------

@query("sort_multi", """
    select seller_state, seller_id from src_sellers
    order by seller_state, seller_id desc""")
def _(t):
    return t.sellers.select("seller_state", "seller_id").orderBy(
        "seller_state", F.desc("seller_id"))


@query("nulls_last", """
    select distinct on (customer_id) customer_id, order_id,
           order_delivered_customer_date from src_orders
    order by customer_id, order_delivered_customer_date desc nulls last, order_id""")
def _(t):
    """The last delivered order of each customer; an undelivered one only where
    there is no other."""
    return first_per_key(
        t.orders.select("customer_id", "order_id", "order_delivered_customer_date"),
        ["customer_id"],
        [F.desc_nulls_last("order_delivered_customer_date"), F.col("order_id")])


@query("topk_groups", """
    select product_id, cast(sum(price) as double) as revenue from src_items group by 1
    order by sum(price) desc, product_id limit 10""")
def _(t):
    return doubles(t.items.groupBy("product_id").agg(F.sum("price").alias("revenue"))
                   .orderBy(F.desc("revenue"), "product_id").limit(10))


@query("last_k", f"""
    select * from (select {MONTH_SQL} as month, count(*) as orders from src_orders
                   group by 1 order by 1 desc limit 12) order by month""")
def _(t):
    monthly = t.orders.groupBy(month_start(F.col(PLACED)).alias("month")).agg(
        F.count("*").alias("orders"))
    return monthly.orderBy(F.desc("month")).limit(12).orderBy("month")


@query("first_k_rows", """
    from src_customers union all
    (from src_customers order by customer_id limit 100)""")
def _(t):
    return t.customers.unionByName(t.customers.orderBy("customer_id").limit(100))


@query("union_all", """
    select customer_zip_code_prefix as zip, customer_city as city,
           customer_state as state from src_customers
    union all select seller_zip_code_prefix, seller_city, seller_state
    from src_sellers""")
def _(t):
    def place(df, who):
        return df.select(F.col(f"{who}_zip_code_prefix").alias("zip"),
                         F.col(f"{who}_city").alias("city"),
                         F.col(f"{who}_state").alias("state"))
    return place(t.customers, "customer").unionByName(place(t.sellers, "seller"))


LAYER_TABLES = ["dim_date", "dim_customer", "dim_product", "dim_seller",
                "dim_geography", "fact"]


@query("layer_counts", " union all ".join(
    f"select '{n}' as table_name, count(*) as rows from {n}" for n in LAYER_TABLES))
def _(t):
    out = None
    for name in LAYER_TABLES:
        row = t.built(name).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


# ---- scalar functions ------------------------------------------------------

@query("date_scalars", f"""
    select order_id, {MONTH_SQL} as month,
           cast(date_diff('day', {PLACED}, order_delivered_customer_date) as int) as days,
           cast(year({PLACED}) as int) as year, cast(quarter({PLACED}) as int) as quarter,
           cast(month({PLACED}) as int) as month_no, cast(day({PLACED}) as int) as day,
           cast(isodow({PLACED}) as int) as weekday, cast(week({PLACED}) as int) as week,
           cast(strftime({PLACED}, '%Y%m%d') as int) as date_key,
           monthname({PLACED}) as month_name, dayname({PLACED}) as day_name,
           cast(last_day({PLACED}) as date) as month_end,
           cast({PLACED} as date) as order_date,
           epoch(order_delivered_customer_date) - epoch({PLACED}) as seconds,
           cast((year(date '{MOVE_DATE}') - year({PLACED})) * 12
               + month(date '{MOVE_DATE}') - month({PLACED}) as int) as months_before
    from src_orders""")
def _(t):
    p, delivered = F.col(PLACED), F.col("order_delivered_customer_date")
    return t.orders.select(
        "order_id", month_start(p).alias("month"), F.datediff(delivered, p).alias("days"),
        F.year(p).alias("year"), F.quarter(p).alias("quarter"),
        F.month(p).alias("month_no"), F.dayofmonth(p).alias("day"),
        iso_weekday(p).alias("weekday"), F.weekofyear(p).alias("week"),
        date_key(p).alias("date_key"), F.date_format(p, "MMMM").alias("month_name"),
        F.date_format(p, "EEEE").alias("day_name"), F.last_day(p).alias("month_end"),
        F.to_date(p).alias("order_date"),
        seconds_between(p, delivered).cast("double").alias("seconds"),
        month_offset(F.lit(MOVE_DATE).cast("date"), p).alias("months_before"))


@query("string_scalars", r"""
    select doc_id, lower(source) as low, upper(lang) as up,
           lower(trim(regexp_replace('  ' || source || '   ' || lang || ' ', '\s+', ' ',
               'g'))) as place,
           upper(trim('  ' || lang || ' ')) as code,
           length(trim(' ' || source || ' ')) as size, left(text, 46) as head
    from documents""")
def _(t):
    padded = F.concat(F.lit("  "), "source", F.lit("   "), "lang", F.lit(" "))
    return t.table("documents").select(
        "doc_id", F.lower("source").alias("low"), F.upper("lang").alias("up"),
        clean_place(padded).alias("place"),
        clean_code(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("code"),
        F.length(F.trim(F.concat(F.lit(" "), "source", F.lit(" ")))).cast("long")
        .alias("size"),
        F.left("text", F.lit(46)).alias("head"))


@query("math_scalars", f"""
    select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           {rounded("cast(price * 100 as hugeint)", "100", 1)} as rounded,
           order_id // 7 as whole, order_id % 7 as remainder,
           cast(order_id as double) / 7 as quotient,
           {pct_sql("cast(freight_value * 100 as hugeint)", "cast(price * 100 as hugeint)")}
               as freight_pct
    from src_items""")
def _(t):
    return t.items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        F.round("price", 1).cast("double").alias("rounded"),
        F.expr("order_id div 7").alias("whole"),
        (F.col("order_id") % 7).alias("remainder"),
        (F.col("order_id") / 7).alias("quotient"),
        pct(F.col("freight_value"), F.col("price")).alias("freight_pct"))


@query("casts", """
    select event_id, cast(ts as date) as day, cast(trunc(value) as int) as whole,
           cast(cast(value as decimal(12,2)) as double) as money,
           cast(event_id as double) as as_double, cast(event_id as varchar) as as_text,
           try_cast(props as int) as not_a_number
    from events""")
def _(t):
    v = F.col("value")
    return t.table("events").select(
        "event_id", F.col("ts").cast("date").alias("day"), v.cast("int").alias("whole"),
        v.cast("decimal(12,2)").cast("double").alias("money"),
        F.col("event_id").cast("double").alias("as_double"),
        F.col("event_id").cast("string").alias("as_text"),
        F.col("props").try_cast("int").alias("not_a_number"))
