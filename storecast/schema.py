"""Table schemas of the retail model and the rules that hold between tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
UNKNOWN_CUSTOMER = -1


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in cols.items()])


CATEGORIES = _struct(category_id=T.LongType(), category_name=T.StringType())
SUPPLIERS = _struct(supplier_id=T.LongType(), name=T.StringType(), contact_info=T.StringType())
CUSTOMERS = _struct(customer_id=T.LongType(), name=T.StringType(), region=T.StringType())
PRODUCTS = _struct(
    product_id=T.LongType(),
    product_name=T.StringType(),
    category_id=T.LongType(),
    supplier_id=T.LongType(),
    unit_price=MONEY,
)
ORDERS = _struct(order_id=T.LongType(), customer_id=T.LongType(), order_date=T.DateType())
ORDER_ITEMS = _struct(
    order_item_id=T.LongType(),
    order_id=T.LongType(),
    product_id=T.LongType(),
    quantity=MONEY,
    unit_price_at_order=MONEY,
)
INVENTORY = _struct(product_id=T.LongType(), stock_available=MONEY, last_restocked_date=T.DateType())

# Text dates and nullable customers: what an uncleaned export looks like.
RAW_ORDERS = _struct(order_id=T.LongType(), customer_id=T.LongType(), order_date=T.StringType())
RAW_ORDER_ITEMS = _struct(
    order_item_id=T.LongType(),
    order_id=T.LongType(),
    product_name=T.StringType(),
    quantity=MONEY,
    unit_price_at_order=MONEY,
)

PRODUCT_PARAMETERS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("base_demand", T.DoubleType()),
        T.StructField("trend", T.DoubleType()),
        T.StructField("seasonal_months", T.ArrayType(T.IntegerType())),
        T.StructField("seasonal_multiplier", T.DoubleType()),
        T.StructField("noise_low", T.DoubleType()),
        T.StructField("noise_high", T.DoubleType()),
        T.StructField("zero_order_prob", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class TableRules:
    """Rules of one table: primary key, required columns, foreign keys.

    `references` maps a column to (parent table, parent column).
    """

    key: str
    required: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


RULES = {
    "categories": TableRules("category_id", ("category_id", "category_name")),
    "suppliers": TableRules("supplier_id", ("supplier_id", "name", "contact_info")),
    "customers": TableRules("customer_id", ("customer_id", "name", "region")),
    "products": TableRules(
        "product_id",
        ("product_id", "product_name", "category_id", "supplier_id", "unit_price"),
        {
            "category_id": ("categories", "category_id"),
            "supplier_id": ("suppliers", "supplier_id"),
        },
    ),
    "orders": TableRules(
        "order_id",
        ("order_id", "customer_id", "order_date"),
        {"customer_id": ("customers", "customer_id")},
    ),
    "order_items": TableRules(
        "order_item_id",
        ("order_item_id", "order_id", "product_id", "quantity", "unit_price_at_order"),
        {"order_id": ("orders", "order_id"), "product_id": ("products", "product_id")},
    ),
    "inventory": TableRules(
        "product_id",
        ("product_id", "stock_available", "last_restocked_date"),
        {"product_id": ("products", "product_id")},
    ),
}
