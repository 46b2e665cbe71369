"""Values kept under slash paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.ids import clean_path


def _below(paths: DataFrame, parent: str, path: str) -> tuple[DataFrame, str]:
    root = "/" + "/".join(s for s in parent.split("/") if s)
    prefix = root if root == "/" else root + "/"
    cleaned = paths.withColumn("_path", clean_path(F.col(path)))
    rest = F.expr(f"substring(_path, {len(prefix) + 1})")
    under = cleaned.where(F.col("_path").startswith(prefix) & (F.length("_path") > len(prefix)))
    return under.withColumn("_steps", F.filter(F.split(rest, "/"), lambda s: s != "")), prefix


def list_children(paths: DataFrame, parent: str, path: str = "path") -> DataFrame:
    """Names directly below a path, each once, sorted."""
    under, _ = _below(paths, parent, path)
    return under.select(F.get("_steps", F.lit(0)).alias("child")).distinct().orderBy("child")


def path_tree(
    paths: DataFrame, root: str, depth: int = 2, path: str = "path", value: str = "value"
) -> DataFrame:
    """Nodes under a root down to a depth.

    A node that is shown with its children has no value; one without children, or at the last
    level, shows the value stored at it.
    """
    under, prefix = _below(paths, root, path)
    level = F.explode(F.sequence(F.lit(1), F.least(F.size("_steps"), F.lit(depth))))
    nodes = under.select("_steps", F.col(value).cast("string").alias("_value"), level.alias("level"))
    here = F.col("level") == F.size("_steps")
    return (
        nodes.select(
            F.concat(F.lit(prefix), F.array_join(F.slice("_steps", F.lit(1), F.col("level")), "/")).alias("path"),
            "level",
            F.get("_steps", F.col("level") - 1).alias("name"),
            F.when(here, F.col("_value")).alias("_value"),
            (~here).alias("_inner"),
        )
        .groupBy("path", "level", "name")
        .agg(F.max("_value").alias("_value"), F.max("_inner").alias("has_children"))
        .select(
            "path",
            "level",
            "name",
            "has_children",
            F.when(~F.col("has_children") | (F.col("level") == depth), F.col("_value")).alias("value"),
        )
    )
