"""Ids, names and lists as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded(number: Column, width: int) -> Column:
    """Zero-pad a number to at least ``width`` digits, never cutting longer ones.

    ``lpad`` alone would cut, and ``format_string`` goes through the Java
    formatter for every row.
    """
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def product_code(number: Column) -> Column:
    """``PROD_0001``"""
    return F.concat(F.lit("PROD_"), padded(number, 4))


def customer_code(number: Column) -> Column:
    """``CUST_1001``"""
    return F.concat(F.lit("CUST_"), padded(number, 4))


def category_code(number: Column) -> Column:
    """``CAT_001``"""
    return F.concat(F.lit("CAT_"), padded(number, 3))


def product_title(base_name: Column, index: Column, cycle: Column) -> Column:
    """Title of the product with 0-based ``index``: base, number, round of the cycle."""
    number = index + 1
    return F.concat(
        base_name, F.lit(" "), padded(number, 2), F.lit(" - "),
        F.ceil(number / cycle).cast("string"),
    )


def tag_text(tags: Column) -> Column:
    """Join an array of tags the way the files store them."""
    return F.array_join(tags, ", ")


def tag_list(text: Column) -> Column:
    """Split stored tag text; blanks around the commas do not matter."""
    return F.split(F.trim(text), r"\s*,\s*")


def quoted(value: str) -> str:
    """A text as it stands between single quotes in SQL."""
    return value.replace("\\", "\\\\").replace("'", "\\'")
