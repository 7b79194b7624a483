"""Bad CSV rows apart from good ones, before a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.schemas import Dataset
from tillwright.sources.lake import CSV_READ, folders, list_files

BAD_LINE = "_bad_line"


def read_unchecked(spark: SparkSession, root: str, dataset: Dataset,
                   dates: list[str] | None = None, stream: bool = False,
                   **more: str) -> DataFrame:
    """Scan one dataset, or follow its new files, with every body column as text.

    Lines with too few or too many cells keep their text in ``_bad_line``. The
    parser always splits whole lines, so that does not depend on the columns a
    query happens to use.
    """
    texts = [T.StructField(f.name, T.StringType()) for f in dataset.body]
    schema = T.StructType(
        texts
        + [
            T.StructField(BAD_LINE, T.StringType()),
            T.StructField("date", T.DateType()),
            T.StructField("hour", T.StringType()),
        ]
    )
    options = {
        **CSV_READ, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE,
        "columnPruning": "false", "basePath": root, **more,
    }
    if dates is not None and list_files(spark, root, dates) is None:
        return spark.createDataFrame([], schema)
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**options).csv(folders(root, dates))


def rejected_schema(dataset: Dataset) -> T.StructType:
    """Columns of the bad rows of a dataset, with the date as text."""
    names = [f.name for f in dataset.body] + [BAD_LINE, "bad_columns", "date", "hour"]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def split_bad_rows(unchecked: DataFrame, dataset: Dataset) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and bad rows as text with ``bad_columns``.

    A row is bad when its line does not split into the declared columns or when
    a number is none. The test names the columns it looks at, so it holds
    whatever a query on the good rows selects.
    """
    typed = [f for f in dataset.body if not isinstance(f.dataType, T.StringType)]
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in typed}
    marks = [
        F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name))
        for name, cast in casts.items()
    ]
    marks.append(F.when(F.col(BAD_LINE).isNotNull(), F.lit("line")))
    marked = unchecked.withColumn("bad_columns", F.concat_ws(",", *marks))
    good = marked.where(F.col("bad_columns") == "").select(
        *[casts.get(f.name, F.col(f.name)).alias(f.name) for f in dataset.body], "date", "hour"
    )
    return good, marked.where(F.col("bad_columns") != "")
