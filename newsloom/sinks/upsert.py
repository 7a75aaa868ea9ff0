"""Keyed loads: insert, update what changed, leave the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from time import perf_counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.constants import AUDIT_COLUMNS, SYSTEM_USER
from newsloom.operators.frames import align_to_schema
from newsloom.session import stage
from newsloom.sources.snapshots import read_snapshot, snapshot_versions, write_snapshot

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def _empty_to_null(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def stage_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch under the target's columns and types, empty texts as null."""
    return _empty_to_null(align_to_schema(batch, target.schema, keys))


def one_per_key(staged: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                order_by: Sequence[str] = ()) -> DataFrame:
    """One row per complete key. Repeated keys are an error while the job runs,
    or with ``"last"`` the last by ``order_by`` wins."""
    rest = [c for c in staged.columns if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).alias("__none"))
    grouped = staged.groupBy(*keys)
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("'last' needs order_by")
        one = grouped.agg(F.max_by(row, F.struct(*order_by)).alias("__r"))
    elif on_duplicate == "error":
        # keys are counted by themselves: no key is left of that, so the rows need not move to meet them
        repeated = F.raise_error(F.lit(f"repeated key ({', '.join(keys)}) in one load"))
        counted = grouped.agg(F.count(F.lit(1)).alias("__n"))
        none = counted.filter(F.when(F.col("__n") == 1, False).otherwise(repeated.cast("boolean"))).select(*keys)
        return staged.filter(_complete(keys)).join(F.broadcast(none), list(keys), "left_anti").select(*staged.columns)
    else:
        raise ValueError("on_duplicate is 'error' or 'last'")
    return one.select(*keys, "__r.*").select(*staged.columns)


def _creation(now: Column, user: str) -> dict[str, Column]:
    return {"createdate": now, "usercreate": F.lit(user), "updatedate": F.lit(None), "userupdate": F.lit(None)}


def _as_inserted(staged: DataFrame, schema: T.StructType, now: Column, user: str) -> DataFrame:
    """Staged rows in the target's layout with the audit values of a new row."""
    created, out = _creation(now, user), []
    for f in schema.fields:
        value = created.get(f.name, F.col(f.name) if f.name in staged.columns else F.lit(None))
        out.append(value.cast(f.dataType).alias(f.name))
    return staged.select(*out)


def classify(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, now: Column,
             on_duplicate: str = "error", order_by: Sequence[str] = (), user: str = SYSTEM_USER) -> DataFrame:
    """All rows of the target after the load, with the ``action`` taken on each.

    A row is updated only if a loaded column differs (nulls are equal). Audit
    columns follow the load: creation is set once, update on each change, and
    ``sf_id`` never changes. Rows without a complete key are kept out of the
    join by key. They are known by their loaded values: one that the target has
    already is not inserted again, so a repeated load changes nothing.
    """
    staged = stage_rows(target, batch, keys)
    loaded = staged.columns
    extras = [c for c in AUDIT_COLUMNS if c in target.columns]
    updatable = [c for c in loaded if c not in keys and c not in extras]

    created = _creation(now, user)
    unique = one_per_key(staged.filter(_complete(keys)), keys, on_duplicate, order_by)
    s = unique.select(*[F.col(c).alias(f"__s_{c}") for c in loaded], F.lit(True).alias("__staged"))
    t = target.filter(_complete(keys)).withColumn("__there", F.lit(True))
    both = t.join(s, [t[k] == s[f"__s_{k}"] for k in keys], "full_outer")

    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in updatable]) if updatable else F.lit(True)
    if not updatable and not {"updatedate", "userupdate"} & set(target.columns):
        differs = F.lit(False)  # nothing could be set
    is_new, is_update = F.col("__there").isNull(), F.col("__there") & F.col("__staged") & differs
    merged = []
    for f in target.schema.fields:
        c, name = F.col(f.name), f.name
        new = created[name].cast(f.dataType) if name in created else (
            F.col(f"__s_{name}") if name in loaded else F.lit(None).cast(f.dataType))
        if name == "updatedate":
            changed = now.cast(f.dataType)
        elif name == "userupdate":
            changed = F.lit(user).cast(f.dataType)
        elif name in updatable:
            changed = F.col(f"__s_{name}")
        else:
            changed = c
        merged.append(F.when(is_new, new).when(is_update, changed).otherwise(c).alias(name))
    action = F.when(is_new, F.lit(INSERT)).when(is_update, F.lit(UPDATE)).otherwise(F.lit(UNCHANGED))
    matched = both.select(*merged, action.alias("action"))

    keyless_old = target.filter(~_complete(keys)).withColumn("action", F.lit(UNCHANGED))
    keyless_new = _as_inserted(_unknown(staged, target, keys), target.schema, now, user).withColumn(
        "action", F.lit(INSERT))
    return matched.unionByName(keyless_old).unionByName(keyless_new)


def _values_hash(columns: Sequence[str]) -> Column:
    flags = [F.col(c).isNull() for c in columns]
    values = [F.col(c) for c in columns]
    return F.struct(F.xxhash64(*values, *flags).alias("a"), F.xxhash64(*flags, F.lit(1), *reversed(values)).alias("b"))


def _unknown(staged: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without a complete key whose values the target does not have."""
    loaded = [c for c in staged.columns if c not in AUDIT_COLUMNS]
    there = target.filter(~_complete(keys)).select(_values_hash(loaded).alias("__h"))
    rows = staged.filter(~_complete(keys)).withColumn("__h", _values_hash(loaded))
    return rows.join(there, "__h", "left_anti").select(*staged.columns)


def insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, now: Column,
                user: str = SYSTEM_USER) -> DataFrame:
    """Target plus the batch rows whose key it does not have; conflicts are skipped.

    Of rows that repeat a key inside the batch the largest is taken.
    """
    staged = stage_rows(target, batch, keys)
    one = one_per_key(staged.filter(_complete(keys)), keys, "last",
                      [c for c in staged.columns if c not in keys] or keys)
    fresh = one.join(target.select(*keys), list(keys), "left_anti").select(*staged.columns)
    new = fresh.unionByName(_unknown(staged, target, keys))
    return target.unionByName(_as_inserted(new, target.schema, now, user))


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch has are replaced by the batch's rows.

    The batch is not deduplicated, and null keys delete nothing.
    """
    gone = batch.select(*keys).filter(_complete(keys)).distinct()
    kept = target.filter(_complete(keys)).join(gone, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(target.filter(~_complete(keys))).unionByName(batch.select(*target.columns))


def load_report(classified: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row: rows staged, inserted, updated, left as they were."""
    def n(action: str) -> Column:
        return F.count_if(F.col("action") == action)

    report = classified.agg(
        (n(INSERT) + n(UPDATE)).alias("rows_upserted"), n(INSERT).alias("rows_inserted"),
        n(UPDATE).alias("rows_updated"), n(UNCHANGED).alias("rows_unchanged"))
    if seconds is not None:
        report = report.withColumns({
            "duration_seconds": F.lit(round(seconds, 2)),
            "rows_per_second": F.round(F.col("rows_upserted") / F.lit(max(seconds, 1e-9)), 2)})
    return report


def upsert_snapshot(path: str, batch: DataFrame, keys: Sequence[str], *, now: Column,
                    target_schema: T.StructType | None = None, **options) -> dict:
    """Load a batch into a versioned table and return the load report.

    The new version is one atomic write; a failed load leaves the old version
    as the newest. Every load rewrites the table, so this is for small ones;
    ``upsert_buckets`` rewrites only what a batch hits. What was done to each row
    is held in the shared folder for the report and is no column of the table.
    """
    spark = batch.sparkSession
    started = perf_counter()
    if snapshot_versions(spark, path):
        target = read_snapshot(spark, path)
    elif target_schema is not None:
        target = spark.createDataFrame([], target_schema)
    else:
        raise ValueError("the table does not exist; give target_schema to create it")
    done = stage(classify(target, batch, keys, now=now, **options), "upsert")
    version = write_snapshot(done.drop("action"), path)
    report = load_report(done, perf_counter() - started).first().asDict()
    return {"status": "success", "version": version, **report}


BUCKETS = 64  # of a new table, unless said otherwise


def bucket_of(keys: Sequence[str], buckets: int, beside: Sequence[str] = ()) -> Column:
    """Bucket number of a key; fixed for the life of a bucketed table. Rows without a
    complete key are spread by their values (``beside``)."""
    place = F.xxhash64(*keys)
    if beside:
        place = F.when(_complete(keys), place).otherwise(F.xxhash64(*beside))
    return F.pmod(place, F.lit(buckets)).cast("int")


def _stored_buckets(spark, path: str, buckets: int | None) -> int:
    """The table's bucket count: read from beside the data, or written there for a new table."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets")
    if mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        stored = spark.read.schema("buckets int").json(f"{path}/_buckets").first()["buckets"]
        if buckets is not None and buckets != stored:
            raise ValueError(f"the table has {stored} buckets, not {buckets}")
        return stored
    buckets = buckets or BUCKETS
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{path}/_buckets")
    return buckets


def changed_buckets(target: DataFrame, staged: DataFrame, keys: Sequence[str], place: Column) -> set[int]:
    """Buckets in which the staged rows would insert or update anything, or repeat a key.

    Only keys and hashes of the loaded values move.
    """
    updatable = [c for c in staged.columns if c not in keys and c not in AUDIT_COLUMNS]
    new = _unknown(staged, target, keys).select(place.alias("b"))
    values = _values_hash(updatable) if updatable else F.lit(None).cast("struct<a:bigint,b:bigint>")  # with nothing to compare all count
    mine = staged.filter(_complete(keys)).select(place.alias("b"), *keys, values.alias("__h")).groupBy("b", *keys).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value("__h").alias("__h"))
    there = target.filter(_complete(keys)).select(*[F.col(k).alias(f"__t_{k}") for k in keys], values.alias("__there"))
    both = mine.join(there, [mine[k] == there[f"__t_{k}"] for k in keys], "left")
    same = F.coalesce((F.col("__n") == 1) & (F.col("__h") == F.col("__there")), F.lit(False))
    return {r["b"] for r in both.filter(~same).select("b").unionByName(new).distinct().collect()}  # at most ``buckets`` numbers


def _first_load(staged: DataFrame, keys: Sequence[str], schema: T.StructType, *, now: Column, on_duplicate: str = "error",
                order_by: Sequence[str] = (), user: str = SYSTEM_USER) -> DataFrame:
    """What ``classify`` makes of the rows when there is no table yet."""
    unique = one_per_key(staged.filter(_complete(keys)), keys, on_duplicate, order_by)
    return _as_inserted(unique.unionByName(staged.filter(~_complete(keys))), schema, now, user).withColumn("action", F.lit(INSERT))


def upsert_buckets(path: str, batch: DataFrame, keys: Sequence[str], *, now: Column,
                   target_schema: T.StructType, buckets: int | None = None, written: bool = False, **options) -> dict:
    """Load a batch into a table partitioned by key bucket and return the load report.

    The bucket count is kept beside the data; another one is refused.

    Only buckets the batch hits are read, and only those in which it changes
    anything are rewritten. Their rows are written to the shared folder first and
    moved in by dynamic partition overwrite, so a repeated run after a failure
    gives the same table; the rows of a new table are written at once. The batch
    is written first as well, unless it reads a ``written`` table already.
    """
    spark, started = batch.sparkSession, perf_counter()
    empty = spark.createDataFrame([], target_schema)
    loaded = [c for c in stage_rows(empty, batch, keys).columns if c not in AUDIT_COLUMNS]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
    rows = batch if written else stage(batch, "load")  # read several times
    buckets = _stored_buckets(spark, path, buckets)
    place = bucket_of(keys, buckets, loaded)

    def put(done: DataFrame) -> None:
        (done.drop("action").withColumn("__bucket", place).hint("rebalance", "__bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("__bucket").parquet(path))

    def report(done: DataFrame, unchanged: int = 0) -> dict:
        counts = load_report(done, perf_counter() - started).first().asDict()
        counts["rows_unchanged"] += unchanged
        return {"status": "success", "buckets": buckets, **counts}

    if not known:
        done = _first_load(stage_rows(empty, rows, keys), keys, target_schema, now=now, **options)
        put(done)
        return report(spark.read.schema(target_schema).parquet(path).withColumn("action", F.lit(INSERT)))
    staged = stage_rows(empty, rows, keys)
    hit = {r[0] for r in staged.select(place.alias("b")).distinct().collect()}  # at most ``buckets`` numbers
    stored = T.StructType([*target_schema.fields, T.StructField("__bucket", T.IntegerType())])
    table = spark.read.schema(stored).parquet(path)
    changed = changed_buckets(table.filter(F.col("__bucket").isin(*hit)).drop("__bucket"), staged, keys, place)
    unchanged = table.filter(F.col("__bucket").isin(*(hit - changed))).count()
    target = table.filter(F.col("__bucket").isin(*changed)).drop("__bucket")
    done = stage(classify(target, staged.filter(place.isin(*changed)), keys, now=now, **options), "upsert")
    if changed:
        put(done)
    return report(done, unchanged)


def merge_sql(target_table: str, staged_view: str, columns: Sequence[str], keys: Sequence[str], now_sql: str,
              user: str = SYSTEM_USER) -> str:
    """The same load as a ``MERGE`` statement, for table formats that have it."""
    extras = set(AUDIT_COLUMNS)
    updatable = [c for c in columns if c not in keys and c not in extras]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    differs = " OR ".join(f"NOT (t.{c} <=> s.{c})" for c in updatable) or "TRUE"
    sets = [f"t.{c} = s.{c}" for c in updatable]
    if "updatedate" in columns:
        sets.append(f"t.updatedate = {now_sql}")
    if "userupdate" in columns:
        sets.append(f"t.userupdate = '{user}'")
    values = {"createdate": now_sql, "usercreate": f"'{user}'", "updatedate": "NULL", "userupdate": "NULL"}
    update = f"WHEN MATCHED AND ({differs}) THEN UPDATE SET {', '.join(sets)} " if sets else ""
    return (
        f"MERGE INTO {target_table} t USING {staged_view} s ON {on} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join(values.get(c, f's.{c}') for c in columns)})"
    )
