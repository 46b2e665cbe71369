"""Written tables and joins whose keys may be very uneven, shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import new_folder

# A key with more than this share of the counted rows is joined by broadcast. At most as many
# keys can have such a share, so the broadcast side has this many rows at most.
HOT_KEYS = 1024


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a cut in the lineage that survives
    lost executors, and keeps what was derived from being derived again."""
    folder = new_folder(table.sparkSession, name)
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def unstored(*tables: DataFrame) -> None:
    """Remove the folders of :func:`stored` tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def join_counted(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, spread: Sequence[Column], how: str = "inner"
) -> DataFrame:
    """Join (inner or left) of ``rows`` with a stored ``table`` of one row per key.

    ``count`` is a column of the table that holds how many rows have the key, so hot keys are
    known: at most ``HOT_KEYS`` of them have over that share of all counted rows and are
    broadcast. Hot rows, and those with a NULL key, then travel under a key made of ``spread``,
    which deals them evenly, so no task gets a key whole.
    """
    keys = list(keys)
    total = table.agg(F.sum(count)).first()[0] or 0
    values = [c for c in table.columns if c not in keys]
    hot = table.where(F.col(count) > total / HOT_KEYS).select(*keys, F.struct(*values).alias("_hot"))
    cold = table.where(F.col(count) <= total / HOT_KEYS).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*values).alias("_cold")
    )
    marked = rows.join(F.broadcast(hot), keys, "left")
    alone = F.col("_hot").isNotNull() | F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True)
    dealt = marked.withColumn("_deal", F.when(alone, F.xxhash64(*spread)).otherwise(0))
    joined = dealt.join(
        cold.withColumn("_zero", F.lit(0).cast("bigint")),
        [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col("_deal") == F.col("_zero")],
        "left",
    )
    found = F.coalesce("_hot", "_cold")
    return (joined if how == "left" else joined.where(found.isNotNull())).select(
        *[c for c in rows.columns], *[found[v].alias(v) for v in values]
    )
