"""Sinks.  Each writes a folder of part files from the executors."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    return df.withColumns(nested)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    flat(df).write.mode(mode).options(header="true", escape='"', compression=compression).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists") -> None:
    """Parquet, CSV or JSON lines, by ``fmt`` or by the suffix of the path."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    kind = fmt or (name.rsplit(".", 1)[-1].lower() if "." in name else "")
    if kind in ("parquet", "pq"):
        df.write.mode(mode).parquet(path)
    elif kind == "csv":
        write_csv(df, path, mode)
    elif kind in ("jsonl", "json"):
        write_jsonl(df, path, mode)
    else:
        raise ValueError("output must be parquet, csv or jsonl")


def metadata(
    rows: Mapping[str, int],
    coverage: Mapping[str, DataFrame],
    spark,
    files: list[str],
    output: str,
    created_at: str,
    version: str = "1.0.0",
) -> DataFrame:
    """One-row description of a snapshot: stage counts, duplicates removed, category maps, files."""
    base = spark.range(1).select(
        F.lit(version).alias("schema_version"),
        F.lit(created_at).alias("created_at_utc"),
        F.array(*[F.lit(f) for f in files]).cast("array<string>").alias("source_files"),
        F.lit(output).alias("output_path"),
        F.create_map(*[x for k, v in rows.items() for x in (F.lit(k), F.lit(int(v)).cast("bigint"))]).alias("row_counts"),
        F.lit(int(rows.get("merged", 0)) - int(rows.get("after_deduplication", 0))).cast("bigint").alias("deduplication_count"),
    )
    for name, df in coverage.items():
        pairs = df.agg(F.map_from_entries(F.collect_list(F.struct("category", "count"))).alias("m")).scalar()
        base = base.withColumn(name, pairs)
    return base
