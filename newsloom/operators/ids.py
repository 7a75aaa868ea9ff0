"""Assigning time-ordered ids to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.constants import SYSTEM_USER
from newsloom.functions.ids import IdLayout, pack_id, unpack_id
from newsloom.operators.frames import is_missing_id
from newsloom.operators.ordering import LOOKUP_BYTES, dense_index, lookup_bytes, lookup_join, running, running_index
from newsloom.session import discard, stage, stage_all

_PLACE_BITS = 33  # of the place inside a task, as Spark's increasing ids have it


def _millis(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def bulk_ids(df: DataFrame, now_ms: int, layout: IdLayout, order_by: Sequence[str], *, out: str = "sf_id",
             **index_options) -> DataFrame:
    """Ids for all rows from one millisecond on.

    Beyond the ids of one millisecond the next ones are used, so ids never
    repeat however many rows there are.
    """
    placed = running_index(df, order_by, out="__i", **index_options)
    ts = F.lit(now_ms).cast("long") + F.shiftright("__i", layout.sequence_bits)
    sequence = F.col("__i").bitwiseAND(F.lit(layout.slots - 1).cast("long"))
    return placed.withColumn(out, pack_id(ts, sequence, layout)).drop("__i")


def ids_by_rank(df: DataFrame, ts_col: str, layout: IdLayout, *, out: str = "sf_id", **rank_options) -> DataFrame:
    """Id from a row's timestamp and the dense rank of that timestamp.

    Rows with equal timestamps get equal ids.
    """
    timed = df.withColumn("__ms", _millis(F.col(ts_col)))
    ranked = dense_index(timed, "__ms", out="__rank", **rank_options)
    sequence = F.col("__rank").bitwiseAND(F.lit(layout.slots - 1).cast("long"))
    return ranked.withColumn(out, pack_id(F.col("__ms"), sequence, layout)).drop("__ms", "__rank")


def assign_ids(df: DataFrame, layout: IdLayout, order_by: Sequence[str], *, ts_col: str = "createdate",
               id_col: str = "sf_id", on_overflow: str = "carry", **index_options) -> DataFrame:
    """Fill missing ids from a timestamp; rows of one millisecond are numbered
    in ``order_by`` order, existing ids stay.

    Numbers start after the highest id that the writer has given in the same
    millisecond. Where a millisecond has more rows than ids the surplus moves on
    to the next free ones; with ``on_overflow="error"`` that is an error.

    The ids go back to the rows by broadcast, however many there are; beyond one
    broadcast the numbered rows are written.
    """
    if on_overflow not in ("error", "carry"):
        raise ValueError("on_overflow is 'error' or 'carry'")
    if id_col not in df.columns:
        df = df.withColumn(id_col, F.lit(None).cast("long"))
    columns = df.columns
    df = stage(df.withColumn("__row", F.monotonically_increasing_id()), "unnumbered", compression="zstd")
    given = F.col(id_col).try_cast("long")
    missing = df.filter(is_missing_id(F.col(id_col))).withColumn("__ms", _millis(F.col(ts_col)))
    present = df.filter(~is_missing_id(F.col(id_col))).withColumn(id_col, given)

    parts = F.col(id_col).bitwiseAND(F.lit(((1 << layout.time_shift) - 1) ^ (layout.slots - 1)).cast("long"))
    taken = present.filter(parts == layout.writer_part).select(
        (F.shiftright(id_col, layout.time_shift) + F.lit(layout.epoch_ms)).alias("__ms"), F.lit(0).cast("long").alias("__n"),
        (F.col(id_col).bitwiseAND(F.lit(layout.slots - 1).cast("long")) + 1).alias("__used"))
    wanted = missing.filter("__ms is not null").select("__ms", F.lit(1).cast("long").alias("__n"), F.lit(0).cast("long").alias("__used"))
    per_ms = stage(wanted.unionByName(taken).groupBy("__ms").agg(F.sum("__n").alias("__n"), F.max("__used").alias("__used")), "per-ms")
    fullest = per_ms.filter("__n > 0").agg(F.max(F.col("__n") + F.col("__used"))).first()[0] or 0
    if fullest > layout.slots and on_overflow == "error":
        raise ValueError(f"{fullest} rows in one millisecond, the layout has {layout.slots} ids")

    narrow = missing.select("__row", "__ms", *dict.fromkeys(order_by))
    numbered = running_index(narrow, order_by, within=["__ms"], out="__seq", **index_options)
    if fullest > layout.slots:
        start = _free_starts(per_ms, layout, index_options.get("ranges"))
    else:
        start = per_ms.filter("__n > 0").select("__ms", (F.col("__ms") * layout.slots + F.col("__used")).alias("__start"))
    numbered = lookup_join(numbered, start, "__ms")
    slot = F.col("__start") + F.col("__seq")
    made = pack_id(F.shiftright(slot, layout.sequence_bits),
                   slot.bitwiseAND(F.lit(layout.slots - 1).cast("long")), layout)
    ids = stage(numbered.select("__row", made.alias("__id")), "ids")

    def fill(rows: DataFrame, some: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(some), "__row", "left").withColumn(id_col, F.col("__id")).select(*columns)

    present = present.select(*columns)
    if lookup_bytes(ids) <= LOOKUP_BYTES:
        return present.unionByName(fill(missing, ids))
    # whole rows stay in their place: the ids of one range of rows after the other are sent to them
    parts = [fill(*(d.filter(F.col("__row").between(lo, hi)) for d in (missing, ids))) for lo, hi in _row_ranges(ids, LOOKUP_BYTES // 16)]
    written = stage_all([present, *parts], "numbered", compression="zstd")
    discard(df, ids)
    return written


def _row_ranges(rows: DataFrame, most: int) -> list[tuple[int, int]]:
    """First and last ``__row`` of ranges with up to ``most`` rows that cover all there are; one number per task reaches the driver."""
    place = F.col("__row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1).cast("long"))
    tasks = rows.groupBy(F.shiftright("__row", _PLACE_BITS).alias("task")).agg(F.max(place).alias("last")).orderBy("task").collect()
    starts, held = [0], 0
    for r in tasks:
        for at in range(0, r["last"] + 1, most):
            size = min(most, r["last"] + 1 - at)
            if held and held + size > most:
                starts.append((r["task"] << _PLACE_BITS) + at)
                held = 0
            held += size
    return list(zip(starts, [*(s - 1 for s in starts[1:]), (1 << 63) - 1]))


def _free_starts(per_ms: DataFrame, layout: IdLayout, ranges: int | None) -> DataFrame:
    """First free slot of every millisecond when earlier ones spill over.

    With C rows before a millisecond, its start is C + max(own and earlier
    ``ms * slots + used - C``). A spill that would run over ids given later is
    put behind all given ids.
    """
    before = running(per_ms, "__ms", F.col("__n"), "__before", inclusive=False, ranges=ranges)
    before = before.withColumn("__before", F.coalesce("__before", F.lit(0)))
    lead = F.col("__ms") * layout.slots + F.col("__used") - F.col("__before")
    highest = stage(running(before, "__ms", lead, "__lead", how=F.max, ranges=ranges).withColumn(
        "__start", F.col("__before") + F.col("__lead")), "starts")
    given = per_ms.filter("__used > 0").select(F.col("__ms").alias("__at"), (F.col("__ms") * layout.slots).alias("__low"))
    spills = highest.filter(F.col("__start") + F.col("__n") > (F.col("__ms") + 1) * layout.slots)
    first = spills.agg(F.min("__start")).first()[0]
    last = given.agg(F.max((F.col("__at") + 1) * layout.slots)).first()[0]
    if first is not None and last is not None and given.filter(F.col("__low") > first).limit(1).count():
        # the rows that move on start behind the last millisecond with given ids
        moved = F.when(F.col("__start") + F.col("__n") > (F.col("__ms") + 1) * layout.slots, F.lit(last)).otherwise(
            F.col("__ms") * layout.slots + F.col("__used"))
        again = per_ms.filter("__n > 0").join(highest.select("__ms", "__start"), "__ms").withColumn("__floor", moved)
        ordered = running(again.drop("__start"), ["__floor", "__ms"], F.col("__n"), "__before", inclusive=False, ranges=ranges)
        ordered = ordered.withColumn("__before", F.coalesce("__before", F.lit(0)))
        highest = running(ordered, ["__floor", "__ms"], F.col("__floor") - F.col("__before"), "__lead", how=F.max, ranges=ranges)
        highest = highest.withColumn("__start", F.col("__before") + F.col("__lead"))
    return highest.filter("__n > 0").select("__ms", "__start")


def decode_ids(df: DataFrame, layout: IdLayout, id_col: str = "sf_id") -> DataFrame:
    """Add timestamp, datacenter, worker and sequence of every id."""
    return df.withColumn("__d", unpack_id(F.col(id_col).cast("long"), layout)).select("*", "__d.*").drop("__d")


# --- configuration tables --------------------------------------------------------

def active_config(config: DataFrame, version_no: int | None = None) -> IdLayout:
    """Layout from the config table: the given version, else the latest active one."""
    wanted = F.col("active_flag") if version_no is None else F.col("version_no") == version_no
    row = config.filter(wanted).orderBy(F.desc("version_no")).limit(1).select(
        "version_no", "datacenter_bits", "worker_bits", "sequence_bits",
        _millis(F.col("epoch_start")).alias("epoch_ms")).first()
    if row is None:
        raise ValueError("no active id configuration")
    return IdLayout(datacenter=0, worker=0, **row.asDict())


def registered_layout(config: DataFrame, registry: DataFrame, source: str,
                      version_no: int | None = None) -> IdLayout:
    """Layout for one registered, active source."""
    base = active_config(config, version_no)
    row = registry.filter((F.col("source_name") == source) & F.col("active_flag")).select(
        "datacenter_id", "worker_id").first()
    if row is None:
        raise ValueError(f"source '{source}' is not registered")
    return IdLayout(**{**base.__dict__, "datacenter": row["datacenter_id"], "worker": row["worker_id"]})


def run_summary(df: DataFrame, *, source_col: str, job_name: str, id_col: str = "sf_id") -> DataFrame:
    """First and last id per source, the rows of the run log."""
    return df.groupBy(F.col(source_col).alias("source_name")).agg(
        F.lit(job_name).alias("job_name"),
        F.min(id_col).cast("string").alias("id_start"),
        F.max(id_col).cast("string").alias("id_end"),
    )


def merge_run_log(log: DataFrame, summary: DataFrame, now: Column, user: str = SYSTEM_USER) -> DataFrame:
    """The run log after a run: new (source, job) pairs are added; of known pairs
    the last id and the update stamps change, the first id stays."""
    key = ["source_name", "job_name"]
    new = summary.select(*key, F.col("id_start").alias("__start"), F.col("id_end").alias("__end"))
    both = log.withColumn("__known", F.lit(True)).join(new, key, "full_outer")
    run, known = F.col("__end").isNotNull(), F.col("__known").isNotNull()
    return both.select(
        *key, F.coalesce("id_start", "__start").alias("id_start"), F.coalesce("__end", "id_end").alias("id_end"),
        F.when(known, F.col("createdate")).otherwise(now).alias("createdate"),
        F.when(known, F.col("usercreate")).otherwise(F.lit(user)).alias("usercreate"),
        F.when(run & known, now).otherwise(F.col("updatedate")).alias("updatedate"),
        F.when(run & known, F.lit(user)).otherwise(F.col("userupdate")).alias("userupdate"))


def advance_registry(registry: DataFrame, seen: DataFrame) -> DataFrame:
    """Raise each source's last timestamp to the highest one seen, never lower.

    ``seen`` holds (source_name, last_timestamp); it is reduced per source first.
    """
    highest = seen.groupBy("source_name").agg(F.max("last_timestamp").alias("__seen"))
    merged = registry.join(highest, "source_name", "left")
    raised = F.greatest(F.coalesce("last_timestamp", F.lit(0)), F.coalesce("__seen", F.lit(0))).cast("long")
    moved = F.col("__seen").isNotNull()
    return merged.withColumn(
        "last_timestamp", F.when(moved, raised).otherwise(F.col("last_timestamp"))).select(*registry.columns)
