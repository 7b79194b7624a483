"""Products made from a cycle of archetypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.texts import product_code, product_title
from tillwright.schemas import CATALOG


def expand_catalog(archetypes: DataFrame, products: DataFrame,
                   slots: list[tuple[str, str]]) -> DataFrame:
    """A full catalog snapshot for every slot.

    ``products`` has a 0-based ``index``. ``archetypes`` has ``position`` (0-based,
    without gaps) and ``base_name, category_id, category, brand,
    description_suffix, unit_price, supplier, tags``. Product ``i`` takes the
    archetype at ``i`` modulo their number, so every archetype serves equally
    many products.
    """
    counted = archetypes.agg(F.count(F.lit(1)).alias("n"))
    # Without archetypes there is nothing to divide by, and no product either.
    cycle = F.nullif(counted.scalar(), F.lit(0))
    shared = archetypes.withColumnRenamed("position", "_position")
    when = F.array(*[F.struct(F.lit(d).alias("date"), F.lit(h).alias("hour")) for d, h in slots])
    snapshots = (
        products.withColumn("_cycle", cycle)
        .withColumn("_position", F.pmod(F.col("index"), F.col("_cycle")))
        .join(shared, "_position")
        .withColumn("_slot", F.explode(when))
    )
    built = snapshots.select(
        F.col("_slot.date").alias("ingestion_date"),
        F.col("_slot.hour").alias("ingestion_hour"),
        product_code(F.col("index") + 1).alias("product_id"),
        product_title(F.col("base_name"), F.col("index"), F.col("_cycle")).alias("product_name"),
        "category_id",
        F.col("category").alias("category_name"),
        "brand",
        # Fixed text every description starts with.
        F.concat(F.lit("A high-quality product. "), "description_suffix").alias("description"),
        "unit_price",
        F.col("supplier").alias("supplier_name"),
        "tags",
        F.col("_slot.date").alias("date"),
        F.col("_slot.hour").alias("hour"),
    )
    return built.select(*CATALOG.fieldNames(), "date", "hour")
