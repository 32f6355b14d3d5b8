"""Create-or-replace tables in the catalogue, and replacement of the partitions that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadline.config import checkpoint_folder, delete_folder
from leadline.operators.keys import join_null_safe
from leadline.sources.stored import path_exists

WRITTEN, KEPT, DELETED = "written", "kept", "deleted"


def materialize(df: DataFrame, name: str, database: str) -> DataFrame:
    """Replace ``database.name`` with the rows of ``df`` and return the stored table."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").option("compression", "zstd").saveAsTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


def _content(df: DataFrame, partition: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows, and two sums over the hashes of rows, of each partition: equal where contents are."""
    row = F.xxhash64(*[F.col(name).isNull() for name in columns], *columns)
    return df.groupBy(*partition).agg(
        F.count("*").alias("_rows"),
        F.bit_xor(row).alias("_xor"),
        F.sum(F.hash(row, *columns).cast("decimal(38,0)") * row.cast("decimal(19,0)")).alias("_sum"),
    )


def replace_partitions(df: DataFrame, path: str, partition: Sequence[str]) -> DataFrame:
    """Make the Parquet table at ``path`` hold the rows of ``df``; touch only what changed.

    ``partition`` are string columns. Partitions are compared by row count and hashes of their
    rows; those that differ are written aside and take their places when all are whole, so a
    failed write leaves the table as it was. Partitions without rows are deleted last. Returns
    one row for each partition: its values and ``action`` (written, kept or deleted).
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    columns = sorted(name for name in df.columns if name not in partition)
    fresh = _content(df, partition, columns)
    marks = ("_rows", "_xor", "_sum")
    known = spark.read.schema(df.schema).parquet(path) if path_exists(spark, path) else None
    if known is not None:
        old = _content(known, partition, columns).withColumnsRenamed({name: f"{name}_old" for name in marks})
    else:
        old = fresh.limit(0).withColumnsRenamed({name: f"{name}_old" for name in marks})
    renamed = {name: f"_old_{name}" for name in partition}
    both = fresh.join(
        old.withColumnsRenamed(renamed), [F.col(name).eqNullSafe(F.col(to)) for name, to in renamed.items()], "full_outer"
    )
    same = F.lit(True)
    for name in marks:
        same = same & F.col(name).eqNullSafe(F.col(f"{name}_old"))
    action = F.when(F.col("_rows").isNull(), DELETED).when(same, KEPT).otherwise(WRITTEN)
    values = [F.when(F.col("_rows").isNull(), F.col(to)).otherwise(F.col(name)).alias(name) for name, to in renamed.items()]
    # One row for each partition.
    plan = both.select(*values, action.alias("action")).checkpoint()
    changed = plan.filter(F.col("action") == WRITTEN).select(*partition)
    if not changed.isEmpty():
        rows = join_null_safe(df, changed, partition, "left_semi")
        (
            rows.repartition(*partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partition)
            .parquet(path)
        )
    gone = plan.filter(F.col("action") == DELETED).select(*partition)
    if known is not None and not gone.isEmpty():
        # The files that were written since are not in the listing that was compared.
        known = spark.read.schema(df.schema).parquet(path)
        file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
        placed = known.select(*partition, F.regexp_extract(file, "^(.*)/[^/]*$", 1).alias("_folder"))
        for row in join_null_safe(placed, gone, partition, "left_semi").select("_folder").distinct().toLocalIterator():
            delete_folder(spark, row["_folder"])
    return plan
