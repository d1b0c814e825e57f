"""Reading and writing review, product and result tables."""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill import schemas
from voxmill.config import REVIEW_COLUMNS
from voxmill.functions.labels import in_domain

# Folder names of the two sources per domain.
REVIEW_FOLDERS = {
    "Electronics": "raw_review_Electronics",
    "Fashion": "raw_review_Clothing_Shoes_and_Jewelry",
}
METADATA_FOLDERS = {
    "Electronics": "raw_meta_Electronics",
    "Fashion": "raw_meta_Clothing_Shoes_and_Jewelry",
}
FORMATS = {".parquet": "parquet", ".csv": "csv", ".jsonl": "json", ".json": "json"}


def source_folder(domain: str, kind: str = "reviews") -> str:
    folders = {"reviews": REVIEW_FOLDERS, "metadata": METADATA_FOLDERS}[kind]
    if domain not in folders:
        raise ValueError(f"Unsupported domain '{domain}'. Configured domains: {list(folders)}")
    return folders[domain]


def format_of(path: str) -> str:
    """The file format a path's extension names; parquet when it names none."""
    for extension, name in FORMATS.items():
        if path.rstrip("/").endswith(extension):
            return name
    return "parquet"


def _options(reader_or_writer, fmt: str):
    if fmt != "csv":
        return reader_or_writer
    return reader_or_writer.options(header=True, multiLine=True, escape='"', quote='"')


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    fmt = format_of(path)
    reader = _options(spark.read.format(fmt), fmt)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as error:
        # Only a missing path means "no table"; an empty folder or a damaged file is an error.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"No table at '{path}'.") from error


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write in the format the extension names."""
    fmt = format_of(path)
    if fmt == "csv":
        writer = df.write.format("csv").options(header=True, escape='"', quote='"')
    else:
        writer = df.write.format(fmt)
        if fmt == "parquet":
            writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("overwrite").save(path)
    return path


#: A table of up to this many bytes may be one file of one row group, which cannot be split.
SPREAD_BYTES = 256 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """For a plain scan ahead of costly text work: the rows of a small table are dealt out, which
    shuffles SPREAD_BYTES at most, whatever the cluster. A larger table is read as its files split."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    small = int(str(size)) <= SPREAD_BYTES
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if small else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order; columns the table lacks are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def with_row_id(df: DataFrame) -> DataFrame:
    """``row_id`` where the file has none: a digest of all fields. It depends on the row alone, not on
    files, splits or retries; rows equal in all fields share it and are the same review."""
    fields = [c for c in df.columns if c != "row_id"]
    digest = F.xxhash64(*[F.to_json(F.struct(c)) if "<" in t else F.col(c) for c, t in df.dtypes if c in fields])
    return df.withColumn("row_id", F.coalesce("row_id", digest) if "row_id" in df.columns else digest)


def load_reviews(spark: SparkSession, base: str, domain: str, fmt: str = "json") -> DataFrame:
    path = f"{base.rstrip('/')}/{source_folder(domain)}"
    return with_row_id(spark.read.schema(schemas.RAW_REVIEW).format(fmt).load(path).withColumn(
        "domain", F.lit(domain)))


def load_metadata(spark: SparkSession, base: str, domain: str, fmt: str = "json") -> DataFrame:
    path = f"{base.rstrip('/')}/{source_folder(domain, 'metadata')}"
    return with_row_id(spark.read.schema(schemas.RAW_METADATA).format(fmt).load(path).withColumn(
        "domain", F.lit(domain)))


def sample_reviews(df: DataFrame, domain: str, n: int, fields=REVIEW_COLUMNS,
                   order: str = "row_id") -> DataFrame:
    """The first n rows with the named fields (absent ones null) and the domain."""
    have = set(df.columns)
    picked = df.orderBy(order).limit(n)
    return picked.select(
        *[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in fields],
        F.lit(domain).alias("domain"))


def save_by_domain(df: DataFrame, path: str) -> str:
    """One write for all domains; a domain's rows are its folder, the whole is the combined set."""
    return write_table(df, path, ("domain",))


def load_sentiment_data(spark: SparkSession, path: str, domain: str | None = None) -> DataFrame:
    return read_table(spark, path).where(in_domain(domain))


def verify_table(spark: SparkSession, path: str, required: tuple[str, ...]) -> int:
    """Row count of a stored table that has all required columns."""
    df = read_table(spark, path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"'{path}' lacks required columns {missing}")
    return df.count()


def first_existing(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The first of several tables that can be read, None when there is none."""
    for path in paths:
        try:
            return read_table(spark, path)
        except FileNotFoundError:
            continue
    return None


def load_scored_reviews(spark: SparkSession, scored: str, plain: str) -> DataFrame:
    """Scored reviews, else plain ones with the rating label standing in for the prediction."""
    from voxmill.operators.insights import with_predictions

    df = first_existing(spark, [scored, plain])
    if df is None:
        raise FileNotFoundError(f"neither '{scored}' nor '{plain}' can be read")
    return with_predictions(df)


def load_summary(df: DataFrame) -> DataFrame:
    """Per domain: rows loaded and the number of columns."""
    return df.groupBy("domain").agg(
        F.count("*").alias("reviews_loaded"), F.lit(len(df.columns)).alias("n_columns"))


def markdown_head(columns: list[str]) -> list[str]:
    return ["| " + " | ".join(columns) + " |", "| " + " | ".join(":---" for _ in columns) + " |"]


def markdown_rows(df: DataFrame) -> DataFrame:
    """Each row as a line of a markdown table, made on the executors; ``markdown_head`` goes above."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def markdown_table(df: DataFrame) -> str:
    """A report table as one markdown text, its rows fetched partition by partition."""
    lines = (row["value"] for row in markdown_rows(df).toLocalIterator())
    return "\n".join([*markdown_head(df.columns), *lines])


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON document, for metric exports."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_annotations(df: DataFrame, path: str) -> str:
    """Annotations as CSV; array columns become "; "-joined text, maps JSON."""
    flat = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            flat.append(F.array_join(f.name, "; ").alias(f.name))
        elif isinstance(f.dataType, (T.MapType, T.StructType)):
            flat.append(F.to_json(f.name).alias(f.name))
        else:
            flat.append(F.col(f.name))
    return write_table(df.select(*flat), path if path.endswith(".csv") else path + ".csv")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.ANNOTATION)


def union_domains(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out
