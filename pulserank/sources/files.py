"""File sources."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from pulserank.functions import constants as K
from pulserank.functions.text import clean
from pulserank.operators.evaluation import labels
from pulserank.operators.quality import report, vector_rules
from pulserank.operators.shaping import standardize, union_sources

_CSV = {"header": "true", "multiLine": "true", "escape": '"', "mode": "PERMISSIVE"}
EMBEDDING_SCHEMA = "opportunity_id string, embedding array<float>, source string, domain string"
USER_EMBEDDING_SCHEMA = "user_id string, profile_text string, embedding array<float>"


def snapshot(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """A Parquet snapshot; the fallback is read if the path does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(fallback)


def csv_files(spark: SparkSession, path: str, recursive: bool = False) -> list[str]:
    """All ``*.csv`` and ``*.csv.gz`` files below a folder of any Hadoop file system, sorted."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{csv,csv.gz}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path")
    )
    files = sorted(row["path"] for row in listing.collect())
    if not files:
        raise FileNotFoundError(f"no CSV files in {path}")
    return files


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    return tuple(spark.read.options(**_CSV).csv(file).columns)


def files_by_header_line(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """The files by their first line. Rows of a split keep their order, so it is the first row of the split at 0."""
    lines = spark.read.text(files).select(
        F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("file"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("row")
    )
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("line"))
    found: dict[str, list[str]] = {}
    for row in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line").collect():
        found[row["line"]] = list(row["files"])
    return found


def raw_csv(
    spark: SparkSession, path: str, recursive: bool = False, aliases: Mapping[str, str] = K.RAW_ALIASES
) -> DataFrame:
    """All CSV files of a folder in the nine raw columns, each read with its own header.

    One job finds the first lines of all files, one more per distinct header names its columns, and files that
    share a header are one scan.  The file name without its suffix is the
    source of rows that have none.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for line, files in files_by_header_line(spark, csv_files(spark, path, recursive)).items():
        broken = line.count('"') % 2  # a name with a line break: the first line is not the whole header
        for group in [[f] for f in files] if broken else [files]:
            by_header.setdefault(header_of(spark, group[0]), []).extend(group)
    stem = F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.csv\.gz$|\.[^.]*$", "")
    frames = []
    for header, files in by_header.items():
        schema = ", ".join(f"`{name}` string" for name in header)
        scan = spark.read.options(**_CSV).schema(schema).csv(files)
        frames.append(standardize(scan.withColumn("_stem", stem), F.col("_stem"), aliases))
    return union_sources(frames)


def embeddings(spark: SparkSession, path: str, schema: str = EMBEDDING_SCHEMA, check: int | None = None) -> DataFrame:
    """Embedding records, one JSON object per line; malformed lines fail.

    Blank lines are skipped and a byte order mark is ignored.  ``check`` is the expected
    dimension: with it, ids and vectors are verified in one pass, and an empty file fails.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\ufeff", "").alias("value"))
    lines = lines.where(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    if check is not None:
        key = "opportunity_id" if "opportunity_id" in parsed.columns else "user_id"
        report(parsed, vector_rules(key, check), strict=True)
        if parsed.isEmpty():
            raise ValueError(f"no embedding records in {path}")
    return parsed


def profiles(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """User profiles from a JSON array or from an object with a ``users`` array."""
    reader = spark.read.option("multiLine", "true")
    df = reader.schema(schema).json(path) if schema else reader.json(path)
    if "users" in df.columns:
        df = df.select(F.explode("users").alias("u")).select("u.*")
    if "user_id" not in df.columns:
        raise ValueError("profiles must have user_id")
    return df


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def label_file(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Interaction labels from Parquet, CSV, JSON lines, a JSON array or ``{"interactions": [...]}``."""
    kind = fmt or _suffix(path)
    if kind in ("parquet", "pq"):
        df = spark.read.parquet(path)
    elif kind == "csv":
        df = spark.read.options(**_CSV).csv(path)
    elif kind == "jsonl":
        df = spark.read.json(path)
    elif kind == "json":
        df = spark.read.option("multiLine", "true").json(path)
        if "interactions" in df.columns:
            df = df.select(F.explode("interactions").alias("i")).select("i.*")
    else:
        raise ValueError(f"unsupported label format {kind!r}")
    return labels(df)


def candidates(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Candidates from CSV or Parquet."""
    kind = fmt or _suffix(path)
    if kind == "csv":
        return spark.read.options(**_CSV).csv(path)
    if kind in ("parquet", "pq"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported candidate format {kind!r}")


def user_embedding_ids(df: DataFrame) -> DataFrame:
    return df.select(clean("user_id").alias("user_id")).where(F.col("user_id") != "").distinct()
