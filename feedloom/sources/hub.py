"""Dataset hub splits landed as parquet: ``{root}/{dataset}/{config}/{split}``.

The requested columns are projected (a missing column is null); with a
column list the values are strings (inferred hub features are read as
strings), with a DDL schema they are cast to it.  Splits default to
``train``, configs to ``default``; file splits give the parallelism.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def split_path(root: str, dataset: str, split: str = "train", config: str = "default") -> str:
    if not dataset:
        raise ValueError("dataset name is required")
    return f"{root.rstrip('/')}/{dataset}/{config or 'default'}/{split or 'train'}"


def read_split(spark, root: str, dataset: str, split: str = "train", config: str = "default",
               columns=None) -> DataFrame:
    # files of one split may differ in their columns: all of them count
    df = spark.read.option("mergeSchema", "true").parquet(split_path(root, dataset, split, config))
    have = set(df.columns)
    if columns is None:
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if isinstance(columns, str):
        st = StructType.fromDDL(columns)
        return df.select(*[(F.col(f.name) if f.name in have else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in st.fields])
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c)
                       for c in columns])
