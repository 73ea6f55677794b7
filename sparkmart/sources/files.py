"""Readers for the warehouse and lake sources.

Every reader returns a lazy DataFrame.  ``with_ordinal`` adds ``_ord``, the
place of a row in its source (file time, file, split, row), for the rules that
keep "the last occurrence": a DataFrame has no row order of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.fixed_values import NULL_TOKENS
from sparkmart.session import stored
from sparkmart.sources.documents import document_records

ORDINAL = "_ord"
_BROKEN = "_corrupt_record"


def check_source(spark: SparkSession, path: str) -> None:
    """Fail early on a source that is missing or has no bytes. Reads file sizes, no content."""
    try:
        sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
        empty = sizes.filter("length > 0").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source not found: {path}") from error
        raise
    if empty:
        raise ValueError(f"source is empty: {path}")


def with_source_ordinal(df: DataFrame) -> DataFrame:
    """Add the place of each row in its source, unless it is there."""
    if ORDINAL in df.columns:
        return df
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("t"),
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"),
    )
    return df.withColumn(ORDINAL, place)


def blank_to_null(df: DataFrame, columns: list[str], tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Empty text and the null tokens become null."""
    return df.withColumns({c: F.when(~F.col(c).isin(["", *tokens]), F.col(c)) for c in columns})


def read_text_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, with_ordinal: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column as text, columns matched by (trimmed) header name.

    Files of one source may have their columns in different orders: a scan of their lines finds the header of each file, and rows take
    their names from the header of their file. No file is opened by the driver. ``multi_line`` allows line breaks inside
    quotes; such files cannot be split between tasks, so it is off unless asked for.
    """
    check_source(spark, path)
    read = lambda **more: spark.read.csv(path, header=True, quote='"', escape='"', encoding="UTF-8", multiLine=multi_line, **more)
    own = read()
    if len(own.inputFiles()) < 2:  # of the listing; Spark has read the one header
        by_name = {name.strip(): name for name in own.columns}
        missing = [f.name for f in schema.fields if f.name not in by_name]
        if missing:
            raise ValueError(f"{path}: columns missing from the header: {missing}")
        raw, values = own, {f.name: F.col(f"`{by_name[f.name]}`") for f in schema.fields}
    else:
        raw, values = _by_header(_headers(spark, path, schema), schema.names, read)
    if with_ordinal:
        raw = with_source_ordinal(raw)
    named = raw.select(*[value.alias(name) for name, value in values.items()], *([ORDINAL] if with_ordinal else []))
    return blank_to_null(named, schema.names)


def _headers(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(_file, _width, and for each column the number of its cell), a row for each file with a line that is not blank."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    lines = lines.withColumn("_row", F.monotonically_increasing_id()).filter((F.col("_start") == 0) & (F.trim("value") != ""))
    # Least numbers need no sort; a least line by number would sort all lines of a split.
    places = stored(lines.groupBy("_file").agg(F.min("_row").alias("_least")))
    first = lines.join(places.withColumnRenamed("_file", "_of"), (F.col("_file") == F.col("_of")) & (F.col("_row") == F.col("_least")))
    first = first.select("_file", F.col("value").alias("_line"))
    cells = F.regexp_extract_all("_line", F.lit(r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'), F.lit(1))
    names = F.transform(cells, lambda cell: F.trim(F.btrim(F.btrim(cell, F.lit(" \r\t")), F.lit('"'))))
    at = [F.nullif(F.array_position("_names", F.lit(name)).cast("int"), F.lit(0)).alias(name) for name in schema.names]
    headers = stored(first.select("_file", names.alias("_names")).select("_file", F.size("_names").alias("_width"), *at))
    lacking = reduce(or_, [F.col(f"`{name}`").isNull() for name in schema.names])
    for row in headers.filter(lacking).limit(1).collect():
        raise ValueError(f"{row['_file']}: columns missing from the header: {[n for n in schema.names if row[n] is None]}")
    return headers


def _by_header(headers: DataFrame, names: list[str], read: Callable[..., DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with as many cells as the widest header has, and the cell of each column."""
    layouts = headers.select(*names).distinct().limit(2).collect()
    width = headers.agg(F.max("_width")).first()[0] or 1
    cells = [f"_c{i}" for i in range(width)]
    rows = read(schema=T.StructType([T.StructField(cell, T.StringType()) for cell in cells]))
    if not layouts:  # no file has a line
        return rows, {name: F.lit(None).cast("string") for name in names}
    if len(layouts) == 1:
        return rows, {name: F.col(cells[layouts[0][name] - 1]) for name in names}
    whole = F.array(*cells)
    joined = with_source_ordinal(rows).join(headers, F.col(f"{ORDINAL}.f") == F.col("_file"))
    return joined, {name: F.get(whole, F.col(f"`{name}`") - 1) for name in names}


def read_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, schemas.ORDERS, with_ordinal=True, **options)


def read_clients(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, schemas.CLIENTS, with_ordinal=True, **options)


def read_regions(spark: SparkSession, path: str, **options) -> DataFrame:
    """Clean, typed CSV; a population that is no integer is an error. The place in the source decides between regions that share a spelling."""
    text = read_text_csv(spark, path, schemas.REGIONS, with_ordinal=True, **options)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in schemas.REGIONS.fields], ORDINAL)


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])


def _broken(raw: DataFrame) -> Column:
    """True for a record that is no JSON. A value of another type than the schema's is only null."""
    nothing = reduce(and_, [F.col(c).isNull() for c in raw.columns if c != _BROKEN])
    return nothing & F.col(_BROKEN).isNotNull() & F.get_json_object(_BROKEN, "$").isNull()


def _task_bytes(spark: SparkSession) -> int:
    """Bytes of a file that one task reads."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _sizes(spark: SparkSession, path: str, options: dict[str, str]) -> tuple[int, int]:
    """Bytes of the largest file that can be split, and of all files."""
    found = spark.read.format("binaryFile").options(**options).load(path).select("path", "length")
    plain = ~F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    largest, total = found.agg(F.max(F.when(plain, F.col("length"))), F.sum("length")).first()
    return largest or 0, total or 0


def _read_records(
    spark: SparkSession, path: str, root: str, schema: T.StructType, *, json_lines: bool, required: bool,
    split_above: int | None = None, range_bytes: int | None = None, **options,
) -> DataFrame:
    """Records below the array ``root``; with ``json_lines`` one record per line.

    Lines split between tasks. So do documents of more than ``split_above`` bytes (by default, of what a task reads of a file); smaller
    ones are read whole, which needs fewer jobs for the same records. ``range_bytes``: length of the byte ranges that such a document is cut
    into, if not what a task reads; a task then reads several.
    """
    check_source(spark, path)
    error = F.raise_error(F.lit(f"broken JSON in {path}"))
    checked = lambda rows: rows.filter(~F.when(_broken(rows), error.cast("boolean")).otherwise(F.lit(False))).drop(_BROKEN)
    if json_lines:
        return checked(spark.read.options(**options).schema(_with_broken(schema)).json(path))
    largest, total = _sizes(spark, path, options)
    if largest > (_task_bytes(spark) if split_above is None else split_above):
        tasks = max(spark.sparkContext.defaultParallelism, -(-total // _task_bytes(spark))) if range_bytes else None
        records = document_records(spark, path, root, required, range_bytes=range_bytes, tasks=tasks, **options)
        parsed = F.from_json("record", _with_broken(schema), {"columnNameOfCorruptRecord": _BROKEN})
        # Conditions on what is parsed stay behind inline, else they would parse each record again.
        return checked(records.select(F.inline(F.array(parsed))))
    document = T.StructType([T.StructField(root, T.ArrayType(schema))])
    raw = spark.read.options(**options).schema(_with_broken(document)).json(path, multiLine=True)
    # In the column itself: no filter on it can come first.
    raw = raw.select(F.when(_broken(raw), error.cast(T.ArrayType(schema))).otherwise(F.col(root)).alias(root))
    if required and raw.filter(F.col(root).isNotNull()).isEmpty():
        raise KeyError(f"key '{root}' missing in {path}")
    return raw.select(F.inline(root))


def read_products(
    spark: SparkSession, path: str, *, json_lines: bool = False, split_above: int | None = None, range_bytes: int | None = None
) -> DataFrame:
    """Products; price and flag arrive as numbers, booleans or text and are read as text."""
    return _read_records(
        spark, path, "produits", schemas.PRODUCTS, json_lines=json_lines, required=True, split_above=split_above, range_bytes=range_bytes
    )


def read_offers(spark: SparkSession, path: str, *, json_lines: bool = False, split_above: int | None = None) -> DataFrame:
    return _read_records(spark, path, "offres", schemas.OFFERS, json_lines=json_lines, required=False, split_above=split_above)


def read_bronze(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """All offers of the bronze zone, or those of some months only (partition pruning)."""
    bronze = spark.read.schema(schemas.OFFERS).json(f"{root}/bronze")
    if months is not None:
        bronze = bronze.filter(F.col("mois").isin(months))
    return bronze.select(*schemas.OFFERS.names)


def read_bronze_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """Offers of a lake laid out as ``bronze/<source>/<month>/offres_raw.json`` documents."""
    return _read_records(
        spark, f"{root}/bronze", "offres", schemas.OFFERS, json_lines=False, required=False,
        recursiveFileLookup="true", pathGlobFilter="offres_raw.json",
    )


def read_table(spark: SparkSession, root: str, zone: str, name: str) -> DataFrame:
    """A Parquet table of a zone, for DataFrame use or as a view for SQL."""
    return spark.read.parquet(f"{root}/{zone}/{name}")
