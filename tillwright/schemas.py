"""Declared schemas and the dataset registry. Nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, WHOLE, NUMBER = T.StringType(), T.LongType(), T.DoubleType()


def struct_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names, types and order below are fixed values of the data model.
CATALOG = struct_of(
    ingestion_date=TEXT, ingestion_hour=TEXT, product_id=TEXT, product_name=TEXT,
    category_id=TEXT, category_name=TEXT, brand=TEXT, description=TEXT, unit_price=NUMBER,
    supplier_name=TEXT, tags=TEXT,
)
SALES = struct_of(
    transaction_date=TEXT, transaction_hour=TEXT, transaction_id=TEXT, customer_id=TEXT,
    order_country=TEXT, product_id=TEXT, unit_price=NUMBER, units_sold=WHOLE,
    discount_applied=NUMBER, total_ammount_paid=NUMBER,
)
INVENTORY = struct_of(
    inventory_date=TEXT, inventory_hour=TEXT, product_id=TEXT, in_stock=WHOLE,
    new_product=WHOLE, returned_product=WHOLE, units_sold=WHOLE, final_stock=WHOLE,
)
# The older layout has one folder per date and another column order.
CATALOG_DAILY = struct_of(
    product_id=TEXT, product_name=TEXT, category_id=TEXT, category_name=TEXT, brand=TEXT,
    description=TEXT, unit_price=NUMBER, supplier_name=TEXT, tags=TEXT, ingestion_date=TEXT,
)
SALES_DAILY = struct_of(
    transaction_date=TEXT, transaction_id=TEXT, customer_id=TEXT, order_country=TEXT,
    product_id=TEXT, unit_price=NUMBER, units_sold=WHOLE, discount_applied=NUMBER,
    total_ammount_paid=NUMBER,
)
# An alert message carries one inventory row.
ALERT = INVENTORY

SLOT = ["date", "hour"]
STOCK_KEY = ["date", "hour", "product_id"]
ALERT_KEY = ["inventory_date", "inventory_hour", "product_id"]


@dataclass(frozen=True)
class Dataset:
    """One of the three hourly datasets."""

    name: str
    body: T.StructType
    keys: tuple[str, ...]
    body_slot: tuple[str, str]
    backfill: bool
    description: str

    @property
    def lake_schema(self) -> T.StructType:
        """Body columns, then the partition columns of the folder names."""
        return T.StructType(
            self.body.fields
            + [T.StructField("date", T.DateType()), T.StructField("hour", T.StringType())]
        )

    @property
    def managed_schema(self) -> T.StructType:
        """Body columns, ``date_tmsp``, then the (string) partition columns.

        Spark keeps partition columns last in a table, so ``date_tmsp`` stands
        before ``date`` and ``hour``.
        """
        return T.StructType(
            self.body.fields
            + [
                T.StructField("date_tmsp", T.TimestampType()),
                T.StructField("date", T.StringType()),
                T.StructField("hour", T.StringType()),
            ]
        )


# The default flags differ per dataset on purpose: only the catalog loads its
# latest slot unless told otherwise.
PRODUCT_CATALOG = Dataset(
    "product_catalog", CATALOG, ("date", "hour", "product_id"),
    ("ingestion_date", "ingestion_hour"), False, "Hourly product catalog snapshots",
)
SALES_DATA = Dataset(
    "sales_data", SALES, ("date", "hour", "transaction_id"),
    ("transaction_date", "transaction_hour"), True, "Sales transactions",
)
INVENTORY_DATA = Dataset(
    "inventory_data", INVENTORY, ("date", "hour", "product_id"),
    ("inventory_date", "inventory_hour"), True, "Hourly stock per product",
)
DATASETS = {d.name: d for d in (PRODUCT_CATALOG, SALES_DATA, INVENTORY_DATA)}
