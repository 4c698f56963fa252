"""Reports over replicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stock_report(products: DataFrame, on_hand: DataFrame) -> DataFrame:
    """Products with their stock: (id, name, description) joined to (product_id, quantity)."""
    stock = on_hand.select(F.col("product_id").alias("id"), "quantity")
    return products.select("id", "name", "description").join(stock, "id")


def order_report(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with purchaser and product names."""
    who = customers.select(F.col("id").alias("purchaser"), "first_name", "last_name")
    what = products.select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    return orders.join(who, "purchaser").join(what, "product_id").select(
        "order_number", "order_date", "quantity", "first_name", "last_name", "product")


def cdc_reports(snapshots: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stock": stock_report(snapshots["products"], snapshots["products_on_hand"]),
        "orders": order_report(snapshots["orders"], snapshots["customers"], snapshots["products"]),
    }
