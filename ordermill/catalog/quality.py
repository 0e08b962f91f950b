"""Keys of the data-quality checks. Values are (check, value, passed)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as dq
from ..schemas import MART_RULES, ORDER_STATUSES, PAYMENT_TYPES, Constraints
from .base import query

RESULT = ["check", "value", "passed"]


def run(check: dq.Check, frame=None):
    return dq.evaluate([check], {check.table: frame} if frame is not None else {}).select(
        *RESULT)


def expected(name: str, value: str, condition: str = "value = 0") -> str:
    """``value`` is a scalar SQL expression (a subquery in brackets)."""
    return (f"select '{name}' as \"check\", value, {condition} as passed "
            f"from (select cast({value} as double) as value)")


def single(key: str, name: str, value_sql: str, condition: str = "value = 0"):
    return query(key, expected(name, value_sql, condition))


@single("dq_not_empty", "orders not empty", "(select count(*) from src_orders)",
        "value > 0")
def _(t):
    return run(dq.Check("orders not empty", "o", F.count("*"), "value > 0"), t.orders)


@single("dq_unique", "raw orders unique", "(select count(*) from src_orders)")
def _(t):
    """The raw layer holds two versions of every order."""
    return run(dq.Check("raw orders unique", "o",
                        dq.surplus_rows(t.raw_orders, ["order_id"]), "value = 0"))


@query("dq_not_null", " union all ".join(
    expected(f"{c} present", f"(select count(*) from src_orders where {c} is null)")
    for c in ("order_purchase_timestamp", "order_delivered_customer_date")))
def _(t):
    checks = [dq.Check(f"{c} present", "o", dq.violations(F.col(c).isNull()),
                       "value = 0")
              for c in ("order_purchase_timestamp", "order_delivered_customer_date")]
    return dq.evaluate(checks, {"o": t.orders}).select(*RESULT)


@single("dq_non_negative", "raw money non-negative",
        "(select count(*) from lineitem where l_returnflag = 'R' and l_tax = 0 "
        "and l_extendedprice > 0)")
def _(t):
    return run(dq.Check("raw money non-negative", "i", dq.violations(
        (F.col("price") < 0) | (F.col("freight_value") < 0)), "value = 0"),
        t.raw_items)


@single("dq_referential", "items have a delivered parent", """
    (select count(*) from src_items i where not exists (select 1 from src_orders o
     where o.order_id = i.order_id and o.order_status = 'delivered'))""")
def _(t):
    delivered = t.orders.filter("order_status = 'delivered'")
    return run(dq.Check("items have a delivered parent", "i",
                        dq.orphans(t.items, delivered, "order_id"), "value = 0"))


@query("dq_length", expected(
    "state is 2 characters",
    "(select count(*) from src_customers where length(trim(customer_state)) <> 2)")
    + " union all " + expected(
    "seller city is 6 characters",
    "(select count(*) from src_sellers where length(trim(seller_city)) <> 6)"))
def _(t):
    def length(name, frame, column, n):
        return run(dq.Check(name, "x", dq.violations(F.length(F.trim(column)) != n),
                            "value = 0"), frame)
    return length("state is 2 characters", t.raw_customers, "customer_state", 2).unionByName(
        length("seller city is 6 characters", t.sellers, "seller_city", 6))


@query("dq_pattern", expected("zip numeric", "0") + " union all " + expected(
    "raw zip numeric", "(select 2 * count(*) from src_customers)"))
def _(t):
    """Raw zips carry blanks, cleaned ones do not."""
    def numeric(name, frame, column):
        return run(dq.Check(name, "x", dq.violations(
            ~F.col(column).rlike("^[0-9]+$")), "value = 0"), frame)
    return numeric("zip numeric", t.staged_customers, "zip_code_prefix").unionByName(
        numeric("raw zip numeric", t.raw_customers, "customer_zip_code_prefix"))


@single("dq_leading_zero", "zip leading zeros kept", """
    (select count(*) from src_customers where customer_zip_code_prefix like '0%')""",
        "value > 0")
def _(t):
    return run(dq.Check("zip leading zeros kept", "c", dq.violations(
        F.col("zip_code_prefix").startswith("0")), "value > 0"), t.staged_customers)


@single("dq_row_reconcile", "fact rows match source",
        "(select count(*) from src_items) - (select count(*) from fact)")
def _(t):
    return run(dq.Check("fact rows match source", "i",
                        dq.count_difference(t.items, t.built("fact")), "value = 0"))


@query("dq_grain_unique", expected(
    "source grain unique", "(select count(*) - count(distinct (order_id, order_item_id)) "
                           "from src_items)")
    + " union all " + expected("fact grain unique", "0"))
def _(t):
    keys = ["order_id", "order_item_id"]
    return run(dq.Check("source grain unique", "i", dq.surplus_rows(t.items, keys),
                        "value = 0")).unionByName(
        run(dq.Check("fact grain unique", "f", dq.surplus_rows(t.built("fact"), keys),
                     "value = 0")))


@single("dq_no_unknown", "no fact on unknown geography",
        "(select count(*) from fact where geo_key = -1)")
def _(t):
    return run(dq.Check("no fact on unknown geography", "f",
                        dq.violations(F.col("geo_key") == -1), "value = 0"),
               t.built("fact"))


@single("dq_fact_orphans", "fact resolves all dimensions", """
    (select count(*) from fact where product_key in (select product_key from dim_product
     where category_pt is null) or date_key in (select date_key from dim_date
     where is_weekend))""")
def _(t):
    """All five dimensions, two of them with rows taken away."""
    dims = {"customer_key": t.built("dim_customer"),
            "product_key": t.built("dim_product").filter("category_pt is not null"),
            "seller_key": t.built("dim_seller"), "geo_key": t.built("dim_geography"),
            "date_key": t.built("dim_date").filter("not is_weekend")}
    return run(dq.Check("fact resolves all dimensions", "f",
                        dq.unresolved_facts(t.built("fact"), dims), "value = 0"))


@single("dq_one_current", "one current row per customer", """
    (select coalesce(max(n), 0) from (select count(*) as n from dim_customer
     where is_current group by customer_unique_id))""", "value <= 1")
def _(t):
    return run(dq.Check("one current row per customer", "d",
                        dq.most_current_rows(t.built("dim_customer")), "value <= 1"))


@single("dq_ranges_ordered", "validity ranges ordered",
        "(select count(*) from dim_customer where valid_from >= valid_to)")
def _(t):
    return run(dq.Check("validity ranges ordered", "d", dq.violations(
        F.col("valid_from") >= F.col("valid_to")), "value = 0"),
        t.built("dim_customer"))


@single("dq_price_fact", "fact prices non-negative",
        "(select count(*) from fact where price < 0)")
def _(t):
    return run(dq.Check("fact prices non-negative", "f",
                        dq.violations(F.col("price") < 0), "value = 0"),
               t.built("fact"))


@single("dq_total_positive", "fact revenue positive",
        "(select coalesce(sum(price), 0) from fact)", "value > 0")
def _(t):
    return run(dq.Check("fact revenue positive", "f",
                        F.coalesce(F.sum("price"), F.lit(0)), "value > 0"),
               t.built("fact"))


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query("dq_domain", expected(
    "orders.order_status in domain",
    f"(select count(*) from src_orders where order_status not in {_listed(ORDER_STATUSES)})")
    + " union all " + expected(
    "order_payments.payment_type in domain",
    "(select count(*) from src_payments where payment_type = 'boleto')"))
def _(t):
    """Statuses against their full list, payment types against one lacking a code."""
    listed = [v for v in PAYMENT_TYPES if v != "boleto"]
    frames = {"orders": t.orders, "order_payments": t.payments}
    checks = (dq.constraint_checks("orders", frames, Constraints(
        domains={"order_status": ORDER_STATUSES}))
        + dq.constraint_checks("order_payments", frames, Constraints(
            domains={"payment_type": listed})))
    return dq.evaluate(checks, frames).select(*RESULT)


@query("dq_range", expected(
    "products.product_weight_g in range",
    "(select count(*) from src_products where product_weight_g < 0 "
    "or product_weight_g > 4000)")
    + " union all " + expected(
    "order_payments.payment_installments in range",
    "(select count(*) from src_payments where payment_installments < 2)"))
def _(t):
    frames = {"products": t.products, "order_payments": t.payments}
    checks = (dq.constraint_checks("products", frames, Constraints(
        ranges={"product_weight_g": (0, 4000)}))
        + dq.constraint_checks("order_payments", frames, Constraints(
            ranges={"payment_installments": (2, None)})))
    return dq.evaluate(checks, frames).select(*RESULT)


TABLES = ["customers", "sellers", "products", "orders", "order_items", "order_payments"]


@query("dq_key_fk", " union all ".join([
    expected("customers primary key", "0"), expected("sellers primary key", "0"),
    expected("products primary key", "0"), expected("orders primary key", "0"),
    expected("order_items primary key",
             "(select count(*) - count(distinct (order_id, order_item_id)) "
             "from src_items)"),
    expected("order_payments primary key",
             "(select count(*) - count(distinct (order_id, payment_sequential)) "
             "from src_payments)"),
    expected("orders.customer_id references customers", "0"),
    expected("order_items.order_id references orders",
             "(select count(*) from src_items where order_id not in "
             "(select order_id from src_orders))"),
    expected("order_items.product_id references products", "0"),
    expected("order_items.seller_id references sellers", "0"),
    expected("order_payments.order_id references orders", "0")]))
def _(t):
    """Every declared primary and foreign key of the bound source tables."""
    frames = {"customers": t.customers, "sellers": t.sellers, "products": t.products,
              "orders": t.orders, "order_items": t.items, "order_payments": t.payments}
    checks = [c for name in TABLES for c in dq.constraint_checks(name, frames)
              if isinstance(c.value, (dq.Copies, dq.Reference))]
    return dq.evaluate(checks, frames).select(*RESULT)


@single("dq_calendar_contiguous", "calendar has no gaps", "0")
def _(t):
    return run(dq.Check("calendar has no gaps", "d",
                        dq.calendar_gaps(t.built("dim_date")), "value = 0"))


@single("dq_mart_reconcile", "mart revenue equals warehouse", """
    abs((select sum(revenue_x) from mart_revenue)
        - (select sum(price) from fact where order_status <> 'canceled'))""",
        "value < 1")
def _(t):
    sold = t.built("fact").filter("order_status <> 'canceled'")
    return run(dq.Check("mart revenue equals warehouse", "m", dq.money_difference(
        t.built("mart_revenue"), sold, "revenue", "price"), "value < 1"))


@query("dq_bounded_pct", " union all ".join([
    expected("late_pct within 0..100", "(select count(*) from mart_delivery "
                                       "where late_pct not between 0 and 100)"),
    expected("late items within delivered", "(select count(*) from mart_delivery "
                                            "where late_items > delivered_items)"),
    expected("retention within 0..100", "(select count(*) from mart_cohorts "
                                        "where retention_pct not between 0 and 100)"),
    expected("month 0 retention is 100", "(select count(*) from mart_cohorts "
                                         "where month_offset = 0 and retention_pct <> 100)"),
]))
def _(t):
    d, c = "delivery", "cohorts"
    checks = [
        dq.Check("late_pct within 0..100", d,
                 dq.violations(~F.col("late_pct").between(0, 100)), "value = 0"),
        dq.Check("late items within delivered", d,
                 dq.violations(F.col("late_items") > F.col("delivered_items")),
                 "value = 0"),
        dq.Check("retention within 0..100", c,
                 dq.violations(~F.col("retention_pct").between(0, 100)), "value = 0"),
        dq.Check("month 0 retention is 100", c, dq.violations(
            (F.col("month_offset") == 0) & (F.col("retention_pct") != 100)),
            "value = 0")]
    return dq.evaluate(checks, {d: t.built("mart_delivery"),
                                c: t.built("mart_cohorts")}).select(*RESULT)


STAGING = [
    expected("orders has rows", "(select count(*) from src_orders)", "value > 0"),
    expected("orders primary key", "0"), expected("orders.order_id not null", "0"),
    expected("orders.order_purchase_timestamp not null", "0"),
    expected("items.price in range", "{negative}"),
    expected("items.freight_value in range", "0"),
    expected("items.order_id references orders", "0"),
    expected("customers.state has 2 characters", "0"),
    expected("customers.zip_code_prefix like ^[0-9]+$", "0"),
    expected("customers.zip_code_prefix sometimes starts with 0",
             "(select count(*) from src_customers where customer_zip_code_prefix "
             "like '0%')", "value > 0")]


@query("dq_staging_phase", " union all ".join(STAGING).format(negative="0"))
def _(t):
    frames = {"orders": t.staged_orders, "items": t.staged_items,
              "customers": t.staged_customers}
    return dq.evaluate(dq.staging_checks(), frames).select(*RESULT)


@query("dq_warehouse_phase", " union all ".join([
    expected("fact rows as items",
             "(select count(*) from stg_items) - (select count(*) from fact)"),
    expected("fact primary key", "0"), expected("fact.order_id not null", "0"),
    expected("fact.order_item_id not null", "0"),
    expected("fact.customer_key references dim_customer", "0"),
    expected("dim_customer.is_current once per customer_unique_id", "1", "value <= 1"),
    expected("dim_customer.valid_from before valid_to", "0"),
    expected("fact.price in range", "0"),
    expected("fact.price in total", "(select sum(price) from fact)", "value > 0"),
    expected("fact.geo_key never -1", "0")]))
def _(t):
    frames = {"fact": t.built("fact"), "dim_customer": t.built("dim_customer"),
              "items": t.staged_items}
    return dq.evaluate(dq.warehouse_checks(no_unknown=True), frames).select(*RESULT)


@query("dq_marts_phase", " union all ".join([
    expected("delivery.late_pct in range", "(select count(*) from mart_delivery "
                                           "where late_pct not between 0 and 100)"),
    expected("cohorts.retention_pct in range", "(select count(*) from mart_cohorts "
                                               "where retention_pct not between 0 and 100)")]))
def _(t):
    frames = {"delivery": t.built("mart_delivery"), "cohorts": t.built("mart_cohorts")}
    checks = [c for n in frames for c in dq.constraint_checks(n, frames, MART_RULES[n])]
    return dq.evaluate(checks, frames).select(*RESULT)


@query("gate", f"""
    select "check", value, passed, false as published from ({" union all ".join(STAGING)})
    """.format(negative="(select count(*) from lineitem where l_returnflag = 'R' "
                        "and l_tax = 0 and l_extendedprice > 0)"))
def _(t):
    """The staging gate on items that were not cleaned: it stops the load. All
    checks are reported, and whether the phase would publish. Each is measured
    once, year by year where the table has a date, and merged."""
    frames = {"orders": t.staged_orders, "items": t.raw_items,
              "customers": t.staged_customers}
    checks = dq.bound(dq.staging_checks(), frames)
    by = {"orders": F.year("order_purchase_timestamp").cast("string")}
    states = {n: dq.measure(df, by.get(n, F.lit("")), [c for c in checks if c.table == n])
              for n, df in frames.items()}
    failed = []
    try:
        dq.gate(checks, states, "staging")
    except dq.GateFailed as stopped:
        failed = [name for name, _, _ in stopped.failures]
    rows = [(c.name, float(dq.merged(c, states)), c.name not in failed, not failed)
            for c in checks]
    return t.spark.createDataFrame(
        rows, "check string, value double, passed boolean, published boolean")
