"""Small rows of the three datasets; every value can be set by name."""

from tillwright.schemas import CATALOG, INVENTORY, SALES
from pyspark.sql import types as T

_SLOT = [T.StructField("date", T.StringType()), T.StructField("hour", T.StringType())]


def _frame(spark, body, defaults, rows):
    schema = T.StructType([*body.fields, *_SLOT])
    full = [{**defaults(row), **row} for row in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in full], schema)


def catalog(spark, *rows):
    return _frame(spark, CATALOG, lambda r: {
        "ingestion_date": r["date"], "ingestion_hour": r["hour"], "product_name": "thing",
        "category_id": "CAT-01", "category_name": "Tools", "brand": "b", "description": "d",
        "unit_price": 10.0, "supplier_name": "s", "tags": "x, y",
    }, rows)


def sales(spark, *rows):
    return _frame(spark, SALES, lambda r: {
        "transaction_date": r["date"], "transaction_hour": r["hour"], "transaction_id": "t",
        "customer_id": "CUST_1001", "order_country": "Spain", "unit_price": 10.0,
        "units_sold": 1, "discount_applied": 0.0,
        "total_ammount_paid": 10.0 * r.get("units_sold", 1),
    }, rows)


def inventory(spark, *rows):
    return _frame(spark, INVENTORY, lambda r: {
        "inventory_date": r["date"], "inventory_hour": r["hour"], "in_stock": 0,
        "new_product": 0, "returned_product": 0, "units_sold": 0, "final_stock": 0,
    }, rows)


def slot(date, hour, product="PROD_0001", **more):
    return {"date": date, "hour": hour, "product_id": product, **more}
