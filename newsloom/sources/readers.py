"""Files, payloads, text trees and database tables as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.frames import check_header, flatten_structs
from newsloom.sources.snapshots import read_snapshot

# fixed values: array keys of the known payloads, in order of precedence
PAYLOAD_KEYS = ["news", "data", "articles"]
# fixed values: the two trees of the labelled corpus
CORPUS_TREES = ["News Articles", "Summaries"]


# --- delimited, columnar and JSON files ------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, sep: str = ",",
             **options: Any) -> DataFrame:
    """CSV with a checked header and ``""`` as the quote escape; columns are bound by name.

    Without ``schema`` every column is text; no pass over the data is made to
    guess types. With one, its columns are looked up in the header, in any case
    and order, and others are left out. Every file of a folder must have the
    same header. Line breaks inside quotes need ``multiLine=True``; without it a
    large file is read in parallel.
    """
    options = {"sep": sep, "escape": '"', **options}
    head = spark.read.options(header=False, **options).csv(path).first()  # one line of one file
    raw = [n or "" for n in head] if head else []
    names = check_header(raw)
    if schema is None:
        wanted = None
        fields = [T.StructField(n, T.StringType()) for n in raw]
    else:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kinds = {f.name.lower(): f.dataType for f in wanted.fields}
        absent = [f.name for f in wanted.fields if f.name.lower() not in {n.lower() for n in names}]
        if absent:
            raise ValueError(f"the header of {path} lacks {', '.join(absent)}")
        fields = [T.StructField(r, kinds.get(n.lower(), T.StringType())) for r, n in zip(raw, names)]
    rows = spark.read.options(header=True, enforceSchema=False, **options).schema(T.StructType(fields)).csv(path).toDF(*names)
    return rows if wanted is None else rows.select(*[F.col(f"`{f.name}`").alias(f.name) for f in wanted.fields])


def read_semicolon_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                       text_columns: Sequence[str] = ("sf_id",), **options: Any) -> DataFrame:
    """``;`` separated, byte-order-marked CSV; the named columns stay text."""
    frame = read_csv(spark, path, schema, sep=";", **options)
    present = [c for c in text_columns if c in frame.columns]
    return frame.withColumns({c: F.col(c).cast("string") for c in present}) if present else frame


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                       multiline: bool = False) -> DataFrame:
    reader = spark.read.options(multiLine=multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_by_extension(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV, Parquet or JSON, told by the path's ending; also for ``s3a://``."""
    ending = path.rstrip("/").lower().rsplit(".", 1)[-1]
    if ending == "csv":
        return read_csv(spark, path, schema)
    if ending == "parquet":
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if ending == "json":
        return read_json_document(spark, path, schema)
    raise ValueError(f"unsupported file type: {path}")


def object_store_options(endpoint: str, access_key: str, secret_key: str, secure: bool = True) -> dict[str, str]:
    """Session settings for an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower(),
    }


# --- payloads ---------------------------------------------------------------------

def explode_payload(payloads: DataFrame, array_keys: Sequence[str] = PAYLOAD_KEYS) -> DataFrame:
    """One flat row per entry of the first array key that a payload has.

    The key is chosen payload by payload, so files of different services can lie
    in one folder; a payload without any key is itself one entry. Entries get the
    fields of all keys, missing ones as null. Other payload columns, such as a
    partition column, are kept unless an entry has a field of that name.
    """
    keys = [k for k in array_keys if k in payloads.columns]
    if not keys:
        return flatten_structs(payloads)
    fields: dict[str, T.DataType] = {}
    for k in keys:
        kind = payloads.schema[k].dataType
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
            raise ValueError(f"payload key '{k}' is not an array of objects")
        for f in kind.elementType.fields:
            known = fields.get(f.name)
            fields[f.name] = f.dataType if known is None or known == f.dataType else T.StringType()
    bare = [f for f in payloads.schema.fields if f.name in fields and f.name not in keys]
    for f in bare:
        if fields[f.name] != f.dataType:
            fields[f.name] = T.StringType()

    def entry(value: Callable[[str], Column], there: set[str]) -> Column:
        return F.struct(*[(value(n) if n in there else F.lit(None)).cast(t).alias(n) for n, t in fields.items()])

    entries = None
    for k in reversed(keys):
        there = set(payloads.schema[k].dataType.elementType.names)
        own = F.transform(k, _entries_of(entry, there))
        if entries is None:
            alone = F.array(entry(F.col, {f.name for f in bare})) if bare else F.array().cast(T.ArrayType(T.StructType(
                [T.StructField(n, t) for n, t in fields.items()])))
            entries = alone
        entries = F.when(F.col(k).isNotNull(), own).otherwise(entries)
    beside = [c for c in payloads.columns if c not in array_keys and c not in fields]
    return flatten_structs(payloads.select(*beside, F.explode(entries).alias("__e")).select(*beside, "__e.*"))


def _entries_of(entry: Callable, there: set[str]) -> Callable[[Column], Column]:
    return lambda e: entry(lambda n: e[n], there)


def read_payloads(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  array_keys: Sequence[str] = PAYLOAD_KEYS, *, keep: Sequence[str] = (),
                  multiline: bool = True) -> DataFrame:
    """Landed payload files as article rows; with ``keep`` only these payload columns are kept beside the entries.

    Partition folders such as ``category=health/`` become columns, so one read
    covers every folder.
    """
    payloads = read_json_document(spark, path, schema, multiline)
    rows = explode_payload(payloads, array_keys)
    present = [k for k in array_keys if k in payloads.columns]
    if not present:
        return rows
    entries = {f.name for k in present for f in payloads.schema[k].dataType.elementType.fields}
    extra = [c for c in payloads.columns if c not in present and c not in entries and c not in keep]
    return rows.drop(*extra)


# --- text trees -------------------------------------------------------------------

def _path_part(position: int) -> Column:
    return F.url_decode(F.element_at(F.split(F.replace(F.col("__p"), F.lit("+"), F.lit("%2B")), "/"), position))


def read_text_tree(spark: SparkSession, path: str, trees: Sequence[str] = CORPUS_TREES) -> DataFrame:
    """One row per file of ``<tree>/<category>/<file>``: filename, category,
    kind of tree and text. Files elsewhere are left out. Spark lists no files of
    zero bytes, so an empty text is an absent one (the cleaning drops both)."""
    files = (
        spark.read.options(recursiveFileLookup=True, ignoreMissingFiles=True)
        .text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("__p"))
    )
    return files.select(
        _path_part(-1).alias("filename"), _path_part(-2).alias("category"),
        _path_part(-3).alias("article_or_summary"), F.coalesce("value", F.lit("")).alias("text_content"),
    ).filter(F.col("article_or_summary").isin(*trees))


def pivot_tree(files: DataFrame, trees: Sequence[str] = CORPUS_TREES) -> DataFrame:
    """One row per (filename, category) with one text column per tree; of several
    texts the smallest is taken, so the result does not depend on file order."""
    wide = files.groupBy("filename", "category").agg(
        *[F.min(F.when(F.col("article_or_summary") == t, F.col("text_content"))).alias(t) for t in trees])
    return wide.select("filename", "category", *trees)


# --- database tables ----------------------------------------------------------------

def jdbc_options(url: str, *, table: str | None = None, query: str | None = None, schema: str | None = None,
                 fetch_size: int = 10_000, partition_column: str | None = None, lower_bound: Any = None,
                 upper_bound: Any = None, num_partitions: int | None = None, **more: Any) -> dict[str, str]:
    """Options of a JDBC read. A query wins over a table; one of them is needed."""
    if not query and not table:
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    options.update({k: str(v) for k, v in more.items() if v is not None})
    source = f"({query}) q" if query else (f"{schema}.{table}" if schema else table)
    options["dbtable"] = source
    if partition_column:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(0 if lower_bound is None else lower_bound),
            upperBound=str(100_000 if upper_bound is None else upper_bound),
            numPartitions=str(num_partitions or 4),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, *, bounds_from_data: bool = True, **kw: Any) -> DataFrame:
    """Table or query over JDBC, in parallel ranges of ``partition_column``.

    Bounds that are not given are read from the data first (one aggregated row),
    as made-up bounds would put nearly all rows into one range.
    """
    column = kw.get("partition_column")
    if column and bounds_from_data and kw.get("lower_bound") is None and kw.get("upper_bound") is None:
        narrow = {k: v for k, v in kw.items() if k not in ("partition_column", "num_partitions")}
        ends = spark.read.format("jdbc").options(**jdbc_options(url, **narrow)).load().agg(
            F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        kw = {**kw, "lower_bound": ends["lo"], "upper_bound": ends["hi"]}
    return spark.read.format("jdbc").options(**jdbc_options(url, **kw)).load()


# --- inline rows and dispatch ---------------------------------------------------------

def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def as_frame(spark: SparkSession, source: Any) -> DataFrame:
    """A DataFrame, a pandas frame, a Parquet path or a SQL text as a DataFrame."""
    if isinstance(source, DataFrame):
        return source
    if hasattr(source, "to_dict") and hasattr(source, "columns"):
        return spark.createDataFrame(source)
    if isinstance(source, str) and source.rstrip("/").lower().endswith(".parquet"):
        return spark.read.parquet(source)
    if isinstance(source, str) and source.strip().lower().startswith(("select", "with", "table ", "values")):
        return spark.sql(source)
    raise ValueError(f"unsupported input: {type(source).__name__}")


def _needs(cfg: Mapping, *names: str) -> None:
    absent = [n for n in names if not cfg.get(n)]
    if absent:
        raise ValueError(f"source '{cfg.get('type')}' needs {', '.join(absent)}")


def _database(spark: SparkSession, cfg: Mapping) -> DataFrame:
    _needs(cfg, "conn_str")
    rest = {k: v for k, v in cfg.items() if k not in ("type", "conn_str")}
    return read_jdbc(spark, cfg["conn_str"], **rest)


def _file(reader: Callable[..., DataFrame]) -> Callable[[SparkSession, Mapping], DataFrame]:
    def read(spark: SparkSession, cfg: Mapping) -> DataFrame:
        _needs(cfg, "path")
        return reader(spark, cfg["path"], **{k: v for k, v in cfg.items() if k not in ("type", "path")})

    return read


def _table(spark: SparkSession, cfg: Mapping) -> DataFrame:
    _needs(cfg, "table")
    return spark.table(cfg["table"])


SOURCES: dict[str, Callable[[SparkSession, Mapping], DataFrame]] = {
    "db": _database,
    "postgres": _database,
    "pg": _database,
    "csv": _file(read_csv),
    "semicolon_csv": _file(read_semicolon_csv),
    "api_url": _file(read_payloads),
    "local_bbc": _file(lambda spark, path, **kw: pivot_tree(read_text_tree(spark, path, **kw))),
    "dvc": _file(read_snapshot),
    "minio": _file(read_by_extension),
    "table": _table,
}


def read_source(spark: SparkSession, cfg: Mapping[str, Any]) -> DataFrame:
    """Read the source a config describes; ``type`` picks the reader."""
    kind = str(cfg.get("type") or "").lower()
    if kind not in SOURCES:
        raise ValueError(f"unknown source type '{cfg.get('type')}'")
    return SOURCES[kind](spark, cfg)
