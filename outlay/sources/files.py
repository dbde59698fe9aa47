"""CSV inputs."""

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.functions.names import normalize_columns
from outlay.functions.values import na_to_null

ORDINAL = "src_ord"
MALFORMED = "src_malformed"
_CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    na_tokens: bool = False,
    line_breaks: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """CSV with a header, every column as text under its cleaned name, plus two columns of ours.

    Columns are bound by name, not by a schema's positions, and a file whose header differs from
    the first one's is an error instead of swapped columns. Quotes inside quoted values are
    doubled. ``line_breaks`` allows breaks inside quoted values; such files are not split among
    tasks. ``mixed_headers`` allows files of one path to have their columns in different orders, or
    their names written differently: one pass over the files' first lines tells which belong
    together, and each group is read by its own header. Files without a line have no rows then.

    ``src_ord`` is the place of the row: position of its path in the list given, name of the file
    (in text order), start of the file's split, row within the split. It grows down every file
    however Spark packs files and splits into tasks, and does not depend on the folder's name.
    ``src_malformed`` marks rows with more or fewer values than the header; missing ones are NULL.
    """
    paths = [path] if isinstance(path, str) else path
    # The hidden column goes away with toDF, so the ordinal is taken before the names are cleaned.
    parts = [
        normalize_columns(_read_path(spark, files, i, line_breaks))
        for i, p in enumerate(paths)
        for files in (_by_header(spark, p) if mixed_headers else [p])
    ]
    if len({tuple(sorted(p.columns)) for p in parts}) > 1:
        raise ValueError("the header columns of the inputs differ")
    table = reduce(DataFrame.unionByName, parts)
    return na_to_null(table) if na_tokens else table


def _by_header(spark: SparkSession, path: str) -> list[list[str]] | list[str]:
    """The files of a path, those with one header together: a row per header comes to the driver,
    which lists the files anyway."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(
        F.min_by("value", "line").alias("header")
    )
    found = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()
    groups = sorted([unquote(file) for file in row["files"]] for row in found)
    return groups or [path]


def _read_path(
    spark: SparkSession, path: str | list[str], position: int, line_breaks: bool
) -> DataFrame:
    def reader():
        return (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("multiLine", line_breaks)
            .option("columnPruning", False)  # else a row's width goes unseen
        )

    header = reader().csv(path).schema
    schema = T.StructType([*header.fields, T.StructField(_CORRUPT, T.StringType())])
    raw = reader().schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    place = F.struct(
        F.lit(position).alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(
        *[F.col(f"`{c}`") for c in header.names],
        place.alias(ORDINAL),
        F.col(_CORRUPT).isNotNull().alias(MALFORMED),
    )
