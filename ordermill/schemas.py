"""Declared schemas and constraints of the source tables.

Timestamps carry no zone (``timestamp_ntz``), so results do not depend on the
session's time zone. Zip prefixes are strings: an inferred integer would lose
the leading zero.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# Column names and types of the nine source tables.
SOURCE_DDL: dict[str, str] = {
    "product_category_translation":
        "product_category_name string, product_category_name_english string",
    "geolocation":
        "geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string",
    "customers":
        "customer_id string, customer_unique_id string, "
        "customer_zip_code_prefix string, customer_city string, customer_state string",
    "sellers":
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string",
    "products":
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int",
    "orders":
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz",
    "order_items":
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(10,2), "
        "freight_value decimal(10,2)",
    "order_payments":
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(10,2)",
    "order_reviews":
        "review_id string, order_id string, review_score int, "
        "review_comment_title string, review_comment_message string, "
        "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
}

# Row counts the published data set must load to.
EXPECTED_ROWS: dict[str, int] = {
    "product_category_translation": 71,
    "geolocation": 1_000_163,
    "customers": 99_441,
    "sellers": 3_095,
    "products": 32_951,
    "orders": 99_441,
    "order_items": 112_650,
    "order_payments": 103_886,
    "order_reviews": 99_224,
}

# Allowed codes.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable",
                  "invoiced", "processing", "created", "approved"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]

# Calendar bounds, open end of a validity range, unknown member.
CALENDAR_START, CALENDAR_END = "2016-01-01", "2019-12-31"
FIRST_VALID_FROM = "2016-01-01"
OPEN_END = "9999-12-31"
UNKNOWN_KEY = -1
UNCATEGORISED = "(uncategorised)"


@dataclass(frozen=True)
class Constraints:
    """What the store would enforce; here it is checked (see operators.quality)."""
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str], ...] = ()      # (column, parent table)
    domains: dict[str, list[str]] = field(default_factory=dict)
    ranges: dict[str, tuple[int | None, int | None]] = field(default_factory=dict)
    required: bool = False                              # at least one row
    widths: dict[str, int] = field(default_factory=dict)        # trimmed length
    patterns: dict[str, str] = field(default_factory=dict)      # regular expression
    starts: dict[str, str] = field(default_factory=dict)        # some value starts so
    intervals: tuple[tuple[str, str], ...] = ()         # half open, never empty
    flags: tuple[tuple[str, str], ...] = ()             # at most one flagged row per key
    totals: tuple[str, ...] = ()                        # sum above 0
    never: dict[str, int] = field(default_factory=dict)         # a value that must not occur
    as_many_as: str | None = None                       # the other table's rows


CONSTRAINTS: dict[str, Constraints] = {
    "product_category_translation": Constraints(
        ("product_category_name",), ("product_category_name_english",)),
    "geolocation": Constraints(not_null=(
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state")),
    "customers": Constraints(
        ("customer_id",),
        ("customer_unique_id", "customer_zip_code_prefix", "customer_city",
         "customer_state")),
    "sellers": Constraints(
        ("seller_id",), ("seller_zip_code_prefix", "seller_city", "seller_state")),
    "products": Constraints(
        ("product_id",),
        ranges={c: (0, None) for c in ("product_weight_g", "product_length_cm",
                                       "product_height_cm", "product_width_cm")}),
    "orders": Constraints(
        ("order_id",),
        ("customer_id", "order_status", "order_purchase_timestamp",
         "order_estimated_delivery_date"),
        (("customer_id", "customers"),),
        {"order_status": ORDER_STATUSES}),
    "order_items": Constraints(
        ("order_id", "order_item_id"),
        ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        (("order_id", "orders"), ("product_id", "products"), ("seller_id", "sellers")),
        ranges={"order_item_id": (1, None), "price": (0, None),
                "freight_value": (0, None)}),
    "order_payments": Constraints(
        ("order_id", "payment_sequential"),
        ("payment_type", "payment_installments", "payment_value"),
        (("order_id", "orders"),),
        {"payment_type": PAYMENT_TYPES},
        {"payment_installments": (0, None), "payment_value": (0, None)}),
    "order_reviews": Constraints(
        ("review_id", "order_id"),
        ("review_score", "review_creation_date", "review_answer_timestamp"),
        (("order_id", "orders"),),
        ranges={"review_score": (1, 5)}),
}

#: What a load must hold before it is published.
STAGING_RULES: dict[str, Constraints] = {
    "orders": Constraints(("order_id",), ("order_purchase_timestamp",), required=True),
    "items": Constraints(ranges={"price": (0, None), "freight_value": (0, None)},
                         foreign_keys=(("order_id", "orders"),)),
    "customers": Constraints(widths={"state": 2}, patterns={"zip_code_prefix": "^[0-9]+$"},
                             starts={"zip_code_prefix": "0"}),
}
WAREHOUSE_RULES: dict[str, Constraints] = {
    "fact": Constraints(("order_id", "order_item_id"), ranges={"price": (0, None)},
                        foreign_keys=(("customer_key", "dim_customer"),),
                        totals=("price",), never={"geo_key": UNKNOWN_KEY},
                        as_many_as="items"),
    "dim_customer": Constraints(intervals=(("valid_from", "valid_to"),),
                                flags=(("customer_unique_id", "is_current"),)),
}
MART_RULES: dict[str, Constraints] = {
    "delivery": Constraints(ranges={"late_pct": (0, 100)}),
    "cohorts": Constraints(ranges={"retention_pct": (0, 100)}),
}
