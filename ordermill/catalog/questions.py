"""Keys of the analytical, warehouse, mart and serving questions."""
from __future__ import annotations

from ..plans import marts, questions, serve
from ..plans import warehouse_questions as wh
from .base import END, START, YEARS, cents, doubles, pct, query, rounded

SCOPE = (f"order_purchase_timestamp >= timestamp '{START}' and "
         f"order_purchase_timestamp < timestamp '{END}' and order_status <> 'canceled'")
MONTH = "cast(date_trunc('month', order_purchase_timestamp) as date)"

Q1 = f"""select {MONTH} as month, sum(price) as revenue_x,
                cast(sum(price) as double) as revenue,
                count(distinct order_id) as orders
         from src_orders join src_items using (order_id) where {SCOPE} group by 1"""


@query("q1_monthly_revenue", f"select month, revenue, orders from ({Q1})")
def _(t):
    return doubles(questions.monthly_revenue(t.orders, t.items, START, END))


GROWTH = pct(f"{cents('revenue_x')} - {cents('prev_x')}", cents("prev_x"))


@query("q2_mom_growth", f"""
    select month, revenue, cast(prev_x as double) as prev_revenue, {GROWTH} as growth_pct
    from (select *, lag(revenue_x) over (order by month) as prev_x from ({Q1}))""")
def _(t):
    return doubles(questions.revenue_growth(t.orders, t.items, START, END))


@query("q3_top3_category_state", f"""
    select state, rnk, category, cast(revenue as double) as revenue, orders from (
        select *, cast(rank() over (partition by state order by revenue desc) as int) as rnk
        from (select customer_state as state, category, sum(price) as revenue,
                     count(distinct order_id) as orders
              from src_orders join src_items using (order_id)
              join src_customers using (customer_id) join categories using (product_id)
              where {SCOPE} group by 1, 2)) where rnk <= 3""")
def _(t):
    return doubles(questions.top_categories_by_state(
        t.orders, t.items, t.customers, t.products, t.translation, START, END))


SELLER_MONTHS = f"""select seller_id, {MONTH} as month, sum(price) as revenue
    from src_orders join src_items using (order_id)
    where order_status <> 'canceled' group by 1, 2"""


@query("q4_running_total_seller", f"""
    with seller_months as ({SELLER_MONTHS})
    select seller_id, month, cast(revenue as double) as revenue,
           cast(sum(revenue) over (partition by seller_id order by month
                rows unbounded preceding) as double) as running_total
    from seller_months where seller_id in (
        select seller_id from seller_months group by 1
        order by sum(revenue) desc, seller_id limit 5)""")
def _(t):
    return doubles(questions.running_total_of_top_sellers(t.orders, t.items))


@query("q5_delivery_by_state", f"""
    select customer_state as state, count(*) as delivered_orders,
           {rounded("sum(a)", "count(*)", 1)} as avg_actual_days,
           {rounded("sum(p)", "count(*)", 1)} as avg_promised_days,
           {rounded("sum(o)", "count(*)", 1)} as avg_days_vs_promise,
           {pct("count(*) filter (where is_late)", "count(*)")} as late_pct
    from (select customer_id, is_late, delivery_days as a, days_vs_estimate as o,
                 date_diff('day', order_purchase_timestamp,
                     order_estimated_delivery_date) as p
          from stg_orders where order_status = 'delivered'
          and order_delivered_customer_date is not null)
    join src_customers using (customer_id) group by 1""")
def _(t):
    return questions.delivery_by_state(t.orders, t.customers)


def _repeat(key: str) -> str:
    return f"""select {key} as k, count(distinct order_id) as n
               from src_orders join src_customers using (customer_id)
               where order_status <> 'canceled' group by 1"""


@query("q6_repeat_rate", f"""
    select count(*) as total_customers,
           count(*) filter (where n > 1) as repeat_customers,
           {pct("count(*) filter (where n > 1)", "count(*)")} as repeat_rate_pct,
           max(n) as most_orders_by_one_customer,
           {rounded("sum(n)", "count(*)", 3)} as avg_orders_per_customer
    from ({_repeat("customer_unique_id")})""")
def _(t):
    return questions.repeat_rate(t.orders, t.customers)


@query("q6b_repeat_rate_wrong", f"""
    select count(*) as total_customers,
           count(*) filter (where n > 1) as repeat_customers,
           {pct("count(*) filter (where n > 1)", "count(*)")} as repeat_rate_pct
    from ({_repeat("customer_id")})""")
def _(t):
    return questions.repeat_rate_by_order_id(t.orders)


COHORTS = f"""
    select cohort_month, customer_unique_id,
           (year(order_purchase_timestamp) - year(cohort_month)) * 12
           + month(order_purchase_timestamp) - month(cohort_month) as off
    from src_orders join src_customers using (customer_id) join (
        select customer_unique_id, cast(date_trunc('month',
                   min(order_purchase_timestamp)) as date) as cohort_month
        from src_orders join src_customers using (customer_id)
        where order_status <> 'canceled' group by 1) using (customer_unique_id)
    where order_status <> 'canceled'"""


def _at(k: int) -> str:
    return f"count(distinct customer_unique_id) filter (where off = {k})"


COHORT_SQL = (f"select cohort_month, {_at(0)} as cohort_size, "
              + ", ".join(f"{_at(k)} as month_{k}" for k in (1, 2, 3)) + ", "
              + ", ".join(f"{pct(_at(k), _at(0))} as m{k}_pct" for k in (1, 2, 3))
              + f" from ({COHORTS}) group by 1")


@query("q7_cohort_retention", COHORT_SQL)
def _(t):
    return questions.cohort_retention(t.orders, t.customers)


@query("q8_no_payment", """
    select order_id, order_status, order_purchase_timestamp,
           (select count(*) from src_items i where i.order_id = o.order_id) as items
    from src_orders o where not exists (
        select 1 from src_payments p where p.order_id = o.order_id)""")
def _(t):
    return questions.orders_without_payment(t.orders, t.payments, t.items)


@query("q8b_no_payment_count", """
    select count(*) as orders_without_payment from src_orders o
    where not exists (select 1 from src_payments p where p.order_id = o.order_id)""")
def _(t):
    return questions.orders_without_payment_count(t.orders, t.payments)


@query("q9_dedup", """
    with doubled as (from src_sellers union all
        (from src_sellers order by seller_id limit 100))
    select 'before' as stage, count(*) as total_rows,
           count(distinct seller_id) as distinct_keys,
           count(*) - count(distinct seller_id) as duplicate_rows from doubled
    union all select 'after', count(distinct seller_id), count(distinct seller_id), 0
    from doubled""")
def _(t):
    return questions.dedup_report(t.sellers, "seller_id",
                                  t.sellers.orderBy("seller_id").limit(100))


@query("q10_city_filter", """
    select count(*) as items, cast(sum(price) as double) as revenue
    from src_orders join src_customers using (customer_id)
    join src_items using (order_id)
    where customer_city = 'machinery' and order_status <> 'canceled'""")
def _(t):
    return doubles(questions.city_revenue(t.orders, t.items, t.customers, "machinery"))


# ---- star schema -----------------------------------------------------------

@query("wh_q1", """
    select month_start as month, cast(sum(price) as double) as revenue,
           count(distinct order_id) as orders
    from star where year in (1997, 1998) and order_status <> 'canceled' group by 1""")
def _(t):
    return doubles(wh.monthly_revenue(t.built("fact"), t.built("dim_date"), YEARS))


@query("wh_q3", """
    select state, rnk, category, cast(revenue as double) as revenue, orders from (
        select *, cast(rank() over (partition by state order by revenue desc) as int) as rnk
        from (select customer_state as state, category, sum(price) as revenue,
                     count(distinct order_id) as orders
              from star where year in (1997, 1998) and order_status <> 'canceled'
              group by 1, 2)) where rnk <= 3""")
def _(t):
    return doubles(wh.top_categories(t.built("fact"), t.built("dim_geography"),
                                     t.built("dim_product"), t.built("dim_date"), YEARS))


DELIVERY = f"""count(*) as delivered_items,
    {rounded("sum(delivery_days)", "count(*)", 1)} as avg_delivery_days,
    {rounded("sum(days_vs_estimate)", "count(*)", 1)} as avg_days_vs_promise,
    {pct("count(*) filter (where is_late)", "count(*)")} as late_pct"""
DONE = "order_status = 'delivered' and delivery_days is not null"


@query("wh_q5", f"""select customer_state as state, {DELIVERY} from star
                    where {DONE} group by 1""")
def _(t):
    return wh.delivery_by_state(t.built("fact"), t.built("dim_geography"))


@query("wh_star_adhoc", """
    select month_name, category as category_en, customer_state as state,
           cast(sum(price) as double) as revenue
    from star where year = 1998 group by 1, 2, 3""")
def _(t):
    return doubles(wh.revenue_cube(t.built("fact"), t.built("dim_date"),
                                   t.built("dim_product"), t.built("dim_geography"), 1998))


def _share(label: str, alias: str) -> str:
    return f"""
        select {alias}, cast(revenue as double) as revenue, orders,
               {pct(cents("revenue"), cents("total"))} as pct_of_total
        from (select *, sum(revenue) over () as total from (
            select {label} as {alias}, sum(price) as revenue,
                   count(distinct order_id) as orders
            from star where order_status <> 'canceled' group by 1))
        order by revenue desc, {alias} limit 10"""


@query("biz_q1_category", _share("category", "category"))
def _(t):
    return doubles(wh.revenue_share(t.built("fact"), t.built("dim_product"),
                                    "product_key", "category_en", "category"))


@query("biz_q2_state", _share("customer_state", "state"))
def _(t):
    return doubles(wh.revenue_share(t.built("fact"), t.built("dim_geography"),
                                    "geo_key", "state", "state"))


@query("biz_q3_trend", f"""
    select month, cast(revenue_x as double) as revenue, orders, {GROWTH} as growth_pct
    from (select *, lag(revenue_x) over (order by month) as prev_x from (
        select month_start as month, sum(price) as revenue_x,
               count(distinct order_id) as orders
        from star where order_status <> 'canceled' group by 1))""")
def _(t):
    return doubles(wh.revenue_trend(t.built("fact"), t.built("dim_date")))


@query("biz_q4_late_state", f"""
    select customer_state as state, {DELIVERY} from star where {DONE} group by 1
    order by late_pct desc, state limit 10""")
def _(t):
    return wh.worst_states(t.built("fact"), t.built("dim_geography"))


@query("biz_q5_late_sellers", f"""
    select seller_id, seller_state, count(*) as delivered_items,
           {pct("count(*) filter (where is_late)", "count(*)")} as late_pct,
           {rounded("sum(delivery_days)", "count(*)", 1)} as avg_delivery_days
    from star where {DONE} group by 1, 2 having count(*) >= 100
    order by late_pct desc, seller_id limit 10""")
def _(t):
    return wh.worst_sellers(t.built("fact"), t.built("dim_seller"))


# ---- marts -----------------------------------------------------------------

@query("mart_revenue_daily", "select * exclude (revenue_x) from mart_revenue")
def _(t):
    return marts.revenue_daily(t.enriched(*marts.REVENUE_NEEDS))


@query("mart_delivery_performance", "from mart_delivery")
def _(t):
    return marts.delivery_performance(t.enriched(*marts.DELIVERY_NEEDS))


@query("mart_delivery_by_state", f"""
    select year, month, customer_state, {DELIVERY} from star where {DONE}
    group by 1, 2, 3""")
def _(t):
    return marts.delivery_performance(t.enriched("customer_state"), by_seller=False)


@query("mart_customer_cohorts", "from mart_cohorts")
def _(t):
    return marts.customer_cohorts(t.enriched(*marts.COHORT_NEEDS))


@query("rolling_sample", """
    select order_date, revenue, revenue_7d_avg, orders from mart_revenue
    where category = 'economy_goods' and customer_state = 'NB'
      and days_in_window = 7""")
def _(t):
    return marts.full_window_sample(t.built("mart_revenue"), "economy_goods", "NB")


# ---- serving from the marts ------------------------------------------------

def _served(group: str) -> str:
    return f"""
        select {group}, cast(revenue as double) as revenue, orders,
               {pct(cents("revenue"), cents("total"))} as pct_of_total
        from (select *, sum(revenue) over () as total from (
            select {group}, sum(revenue_x) as revenue,
                   cast(sum(orders) as bigint) as orders from mart_revenue group by 1))
        order by revenue desc, {group} limit 10"""


@query("serve_q1_category", _served("category"))
def _(t):
    return doubles(serve.revenue_by(t.built("mart_revenue"), "category"))


@query("serve_q2_state", _served("customer_state"))
def _(t):
    return doubles(serve.revenue_by(t.built("mart_revenue"), "customer_state"))


@query("serve_q3_trend", f"""
    select month, cast(revenue_x as double) as revenue, orders,
           cast(prev_x as double) as prev_revenue, {GROWTH} as growth_pct
    from (select *, lag(revenue_x) over (order by month) as prev_x from (
        select cast(date_trunc('month', order_date) as date) as month,
               sum(revenue_x) as revenue_x, cast(sum(orders) as bigint) as orders
        from mart_revenue group by 1)) order by month desc limit 12""")
def _(t):
    return doubles(serve.revenue_trend(t.built("mart_revenue")))


@query("serve_q4_late_state", f"""
    select customer_state, cast(sum(delivered_items) as bigint) as items,
           cast(sum(late_items) as bigint) as late,
           {rounded("sum(tenths)", "10 * count(*)", 1)} as avg_days,
           {rounded("sum(tenths * delivered_items)", "10 * sum(delivered_items)", 1)}
               as weighted_avg_days,
           {pct("sum(late_items)", "sum(delivered_items)")} as late_pct
    from (select *, cast(round(avg_delivery_days * 10) as bigint) as tenths
          from mart_delivery)
    group by 1 order by late_pct desc, customer_state limit 10""")
def _(t):
    return serve.late_by_state(t.built("mart_delivery"))


@query("serve_q5_sellers", f"""
    select seller_id, cast(sum(delivered_items) as bigint) as items,
           cast(sum(late_items) as bigint) as late,
           {pct("sum(late_items)", "sum(delivered_items)")} as late_pct
    from mart_delivery group by 1 having sum(delivered_items) >= 100
    order by late_pct desc, seller_id limit 5""")
def _(t):
    return serve.worst_sellers(t.built("mart_delivery"))


@query("serve_q5_cohorts", """
    select cohort_month, cohort_size, customers, retention_pct from mart_cohorts
    where month_offset = 1 order by cohort_month desc limit 8""")
def _(t):
    return serve.first_month_retention(t.built("mart_cohorts"))


@query("serve_q5_overall", f"""
    select {pct("sum(customers)", "sum(cohort_size)")} as overall_m1_retention_pct
    from mart_cohorts where month_offset = 1""")
def _(t):
    return serve.overall_retention(t.built("mart_cohorts"))
