"""Similar pairs from banded signatures, without all pairs of a bucket.

Items whose signatures agree on a band share a bucket. In a first pass every
item of a bucket is checked against one only, the one whose buckets are largest
in all: in a group of copies that is the text the others were made from, and
its links already tie the group together. Then a few rounds follow in which
buckets that still hold several components are checked against another of their
items. At last all pairs across the components of such buckets are checked, so
no link between different groups is lost and a group of copies costs a few
checks per item. The items of large buckets, as many as share a common passage,
meet by the rare numbers of their sets instead (prefix and positional filter):
that proposes every pair that meets the share, and few others, so that pairs do
not grow with the square of a bucket's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import passing, stage

from .common import BROADCAST_BYTES, bytes_of, sized_join
from .wordhash import mix

ROUNDS = 2  # in which open buckets are checked against one more of their items
PAIRS_UP_TO = 4  # items of an open bucket whose pairs are all made; those of larger ones meet by rare numbers of their sets
PAIRS_AT_ONCE = 1_024
PART_NUMBERS = 1 << 21  # of the sets that ask together for how many sets have each of their numbers
SKETCH_ERRORS = 5.5  # standard errors below the threshold from which a sketch is no pair


def minima(numbers: np.ndarray, offsets: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Least values of ``count`` universal hash functions over every group's numbers; one row per group.

    ``offsets`` are the groups' borders; an empty group gets the largest value.
    """
    rng = np.random.default_rng(seed)
    factor = rng.integers(1, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)
    out = np.full((len(offsets) - 1, count), np.iinfo(np.uint32).max, dtype=np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        folded = numbers if numbers.dtype == np.uint32 else (numbers ^ (numbers >> np.uint64(32))).astype(np.uint32)
        starts = offsets[:-1][full]
        hashed = np.empty_like(folded)
        for i in range(count):
            np.multiply(folded, factor[i], out=hashed)
            np.add(hashed, shift[i], out=hashed)
            out[full, i] = np.minimum.reduceat(hashed, starts)
    return out


def band_keys(rows: np.ndarray, height: int, salt: int = 0) -> np.ndarray:
    """A number for each band of ``height`` minima and each row."""
    bands = rows.shape[1] // height
    keys = np.empty((len(rows), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(rows), np.uint64((salt * 1_000 + b + 1) & 0xFFFFFFFF), dtype=np.uint64)
        for i in range(height):
            key = mix(key ^ rows[:, b * height + i].astype(np.uint64))
        keys[:, b] = key
    return keys


def key_lists(keys: np.ndarray) -> pa.Array:
    """Band keys as an Arrow array of lists of signed longs."""
    ends = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64)))


def sketch(rows: np.ndarray) -> pa.Array:
    """The lowest byte of every minimum, as one binary value per row."""
    low = np.ascontiguousarray(rows.astype(np.uint8))
    return pa.array([r.tobytes() for r in low], pa.binary())


SET_SCHEMA = "id long, size int, sketch binary, items binary"


def set_rows(ids: list, sizes: list[int], rows: np.ndarray, items: list[bytes]) -> pa.RecordBatch:
    """Rows (id, size, sketch, items): the items are what ``numbers_of`` makes a set's sorted distinct numbers from."""
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), sketch(rows), pa.array(items, pa.binary())],
        names=["id", "size", "sketch", "items"])


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of bytes."""
    borders = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[borders[0]:borders[-1]].reshape(len(column), -1)


def plain_numbers(items: list[bytes]) -> list[np.ndarray]:
    """Items that are the sorted distinct numbers themselves."""
    return [np.frombuffer(x, np.uint64) for x in items]


def _sides(sets: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The sets' columns for either item of a pair."""
    left, right = (sets.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in ("a", "b"))
    return left, right


def confirm(pairs: DataFrame, sets: DataFrame, share: tuple[int, int], numbers_of: Callable) -> DataFrame:
    """Pairs (a, b) whose sets meet the share: ``share[1] * |A and B| >= share[0] * |A or B|``.

    Sizes and the sketches of the signatures are compared first; the full sets
    are read for the pairs that are left, which are few. An item with very many
    pairs is a hot key that adaptive execution splits.
    """
    fits = (F.least("size_a", "size_b") * share[1] >= F.greatest("size_a", "size_b") * share[0]) & (F.col("size_a") > 0)
    p = share[0] / share[1]

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_bytes_matrix(batch.column(c)) for c in ("sketch_a", "sketch_b"))
                near = (x == y).mean(axis=1) >= p - SKETCH_ERRORS * np.sqrt(p * (1 - p) / x.shape[1])
                mask = pa.array(near)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    left, right = _sides(sets, "size", "sketch")
    near = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").filter(fits)
    near = stage(near.select("a", "b", "sketch_a", "sketch_b").mapInArrow(alike, "a long, b long").distinct(), "link-near")
    left, right = _sides(sets, "size", "items")
    # the first side's sets stay where they are while the pairs are few; the second side's come by shuffle
    met = sized_join(left, near, "a", "inner", 16).join(right.hint("merge"), "b").filter(fits)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAIRS_AT_ONCE):
                part = whole.slice(at, PAIRS_AT_ONCE)
                ids = np.concatenate([part.column(c).to_numpy() for c in ("a", "b")])
                _, first, place = np.unique(ids, return_index=True, return_inverse=True)  # an item of many pairs is read once
                items = pa.concat_arrays([part.column("items_a"), part.column("items_b")]).take(pa.array(first))
                sets_ = numbers_of([v.as_buffer().to_pybytes() for v in items])
                fine = []
                for i, j in zip(place[:part.num_rows], place[part.num_rows:]):
                    both = len(np.intersect1d(sets_[i], sets_[j], assume_unique=True))
                    fine.append(share[1] * both >= share[0] * (len(sets_[i]) + len(sets_[j]) - both))
                mask = pa.array(fine, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    return met.select("a", "b", "items_a", "items_b").mapInArrow(check, "a long, b long").distinct()


def _spread(numbers_of: Callable):
    """Every number of every member's set, once per batch and component."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets_ = numbers_of([x.as_buffer().to_pybytes() for x in part.column("items")])
                comps = np.repeat(part.column("comp").to_numpy(), [len(x) for x in sets_])
                tokens = np.concatenate(sets_).view(np.int64)
                order = np.lexsort((tokens, comps))
                tokens, comps = tokens[order], comps[order]
                first = np.flatnonzero(np.r_[True, (tokens[1:] != tokens[:-1]) | (comps[1:] != comps[:-1])])[:len(tokens)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[first]), pa.array(comps[first]), pa.array(np.diff(np.r_[first, len(tokens)]))], names=["token", "comp", "n"])

    return spread


def _prefixes(numbers_of: Callable, share: tuple[int, int], tokens: np.ndarray, counts: np.ndarray):
    """Rows (id, comp, size, token, left) of the sets' prefixes, given the shared numbers and how many sets have them."""
    part, whole = share

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                ids, comps = some.column("id").to_numpy(), some.column("comp").to_numpy()
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                for i, numbers in enumerate(numbers_of([x.as_buffer().to_pybytes() for x in some.column("items")])):
                    signed = numbers.view(np.int64)
                    place = np.minimum(np.searchsorted(tokens, signed), max(len(tokens) - 1, 0))
                    known = np.flatnonzero(tokens[place] == signed) if len(tokens) else np.empty(0, np.int64)
                    order = known[np.lexsort((signed[known], counts[place[known]]))]
                    left = np.arange(len(order), 0, -1)  # numbers at this place or behind it
                    kept = left * whole >= len(numbers) * part
                    for held, values in zip(out, (np.full(kept.sum(), ids[i]), np.full(kept.sum(), comps[i]), np.full(kept.sum(), len(numbers)),
                                                  signed[order][kept], left[kept])):
                        held.append(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(t)) for c, t in zip(out, (np.int64, np.int64, np.int32, np.int64, np.int64))],
                    names=["id", "comp", "size", "token", "left"])

    return cut


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their part: rows that follow one another, of PART_NUMBERS numbers together."""
    part, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        parts = []
        for size in batch.column("size").to_pylist():
            if held and held + size > PART_NUMBERS:
                part, held = part + 1, 0
            held += size
            parts.append(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), *[batch.column(c) for c in ("id", "comp", "items")]], names=["part", "id", "comp", "items"])


def _ranked(joined: DataFrame, known: DataFrame, share: tuple[int, int], numbers_of: Callable) -> DataFrame:
    """The prefixes where the shared numbers are too many to send to the tasks.

    A part of the sets asks once for each of its numbers and is sent those that
    are shared, with their counts. So a number moves once for all sets of a part,
    and the sets themselves are not taken apart by shuffle.
    """
    dealt = "part long, id long, comp long, items binary"
    parts = stage(joined.select("id", "comp", "size", "items").mapInArrow(_dealt, dealt), "link-parts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("part").to_numpy()
            borders = np.r_[np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)]), len(own)]
            for lo, hi in zip(borders, borders[1:]):
                held = []
                for at in range(lo, hi, 512):
                    items = batch.column("items").slice(at, min(512, hi - at))
                    held.append(np.unique(np.concatenate(numbers_of([x.as_buffer().to_pybytes() for x in items]))))
                tokens = np.unique(np.concatenate(held)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), own[lo])), pa.array(tokens)], names=["part", "token"])

    asked = parts.select("part", "items").mapInArrow(ask, "part long, token long")
    told = asked.join(known.hint("merge"), "token").select("part", "token", "n")
    names = pa.schema([("id", pa.int64()), ("comp", pa.int64()), ("size", pa.int32()), ("token", pa.int64()), ("left", pa.int64())])

    def cut(answers: pa.Table, sets: pa.Table) -> pa.Table:
        tokens, first = np.unique(answers.column("token").to_numpy(), return_index=True)  # a part may have come in two batches
        counts = answers.column("n").to_numpy()[first]
        return pa.Table.from_batches(list(_prefixes(numbers_of, share, tokens, counts)(sets.to_batches())), names)

    return told.groupBy("part").cogroup(parts.groupBy("part")).applyInArrow(cut, "id long, comp long, size int, token long, left long")


def _close_pairs(members: DataFrame, sets: DataFrame, share: tuple[int, int], numbers_of: Callable, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Pairs (a, b) of different components, among them all that meet the share, for members (id, comp).

    Numbers that only one component has come first in every set, the others from
    rare to frequent. Of two sets that meet the share, the first common number has
    enough numbers at and behind it in both; pairs are made where that holds. Sets
    stay whole: numbers are counted without being written, and a task cuts a set
    to its prefix while the shared numbers measure up to ``limit`` bytes.
    """
    part, whole = share
    joined = stage(sized_join(sets.select("id", "size", "items"), members, "id", "inner", 16), "link-large-sets")
    counted = joined.select("comp", "items").mapInArrow(_spread(numbers_of), "token long, comp long, n long")
    known = counted.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.sum("n").alias("n"))
    known = stage(known.filter("x < y").select("token", "n"), "link-known")
    if bytes_of(known, 16) <= limit:
        held = known.toArrow()
        tokens, counts = held.column("token").to_numpy(), held.column("n").to_numpy()
        order = np.argsort(tokens)
        ranked = joined.select("id", "comp", "items").mapInArrow(
            _prefixes(numbers_of, share, tokens[order], counts[order]), "id long, comp long, size int, token long, left long")
    else:
        ranked = _ranked(joined, known, share, numbers_of)
    ranked = stage(ranked, "link-prefixes")
    # of two components one is not the number's largest: only its rows are met with all others
    held = ranked.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
    held = stage(held.filter("comps > 1").select("token", F.col("top.comp").alias("largest")), "link-held")
    placed = stage(sized_join(ranked, held, "token", "inner", 16), "link-placed")
    left, right = (placed.select("token", "largest", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "comp", "size", "left")]) for s in ("a", "b"))
    both = left.filter("comp_a <> largest").join(right.drop("largest").hint("merge"), "token").filter(
        (F.col("comp_a") != F.col("comp_b")) & ((F.col("comp_b") == F.col("largest")) | (F.col("id_a") < F.col("id_b")))
        & (F.least("left_a", "left_b") * (part + whole) >= (F.col("size_a") + F.col("size_b")) * part))
    return both.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def _across(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    mixed = members.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n"))
    mixed = stage(mixed.filter("x < y").select("key", "n"), "link-open")
    return sized_join(members, mixed, "key", "inner", 24)


def _centred(members: DataFrame) -> DataFrame:
    """Members (key, id, centre) of the buckets with several items; an item weighs as often as it occurs (``copies``)."""
    copies = F.col("copies") if "copies" in members.columns else F.lit(1).cast("long")
    members = members.select("key", "id", copies.alias("copies"))
    shared = members.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.sum("copies").alias("n")).filter("x < y")
    met = stage(sized_join(members, stage(shared.select("key", "n"), "link-buckets"), "key", "inner", 16), "link-members")
    weight = met.groupBy("id").agg(F.sum(F.col("n") * F.col("copies")).alias("weight"))
    weighed = sized_join(met.select("key", "id"), stage(weight, "link-weights"), "id", "inner", 16)
    heaviest = weighed.groupBy("key").agg(F.max(F.struct("weight", -F.col("id"))).alias("top"))
    centres = heaviest.select("key", (-F.col("top.col2")).alias("centre"))
    return stage(sized_join(met.select("key", "id"), stage(centres, "link-centres"), "key", "inner", 16), "link-members")


def _open_members(met: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (key, id, comp, n) of the buckets that hold several components."""
    labelled = sized_join(met, roots, "id", "left", 16).select("key", "id", F.coalesce("root", "id").alias("comp"))
    return _across(labelled.distinct())


def similar_components(members: DataFrame, sets_for: Callable[[DataFrame], DataFrame], share: tuple[int, int],
                       components: Callable[[DataFrame], DataFrame],
                       numbers_of: Callable = plain_numbers) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b) and the (id, root) of all linked items.

    ``members`` has (id, key), one row per band, and may say how often an item occurs
    (``copies``). ``sets_for`` is asked once, after the members have been read, for the
    ids (column ``id``) that share a bucket with another, and returns SET_SCHEMA rows.
    Only what is returned stays in the shared folder.
    """
    with passing() as keep:
        links, roots = _linked(members, sets_for, share, components, numbers_of)
        for table in (*links, roots):
            keep(table)
    return reduce(DataFrame.union, links), roots


def _linked(members: DataFrame, sets_for: Callable, share: tuple[int, int], components: Callable, numbers_of: Callable) -> tuple[list[DataFrame], DataFrame]:
    """The tables of links, and the roots."""

    def confirmed(pairs: DataFrame) -> DataFrame:
        with passing() as keep:
            return keep(stage(confirm(pairs, sets, share, numbers_of), "links"))

    def rooted(links: list[DataFrame]) -> DataFrame:
        with passing() as keep:
            return keep(stage(components(reduce(DataFrame.union, links)), "link-roots"))

    with passing() as keep:
        met = keep(_centred(members))
    sets = stage(sets_for(stage(met.select("id").distinct(), "link-ids")), "link-sets")
    first = met.filter("id <> centre").select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()
    links = [confirmed(first)]
    roots = rooted(links)

    for turn in range(ROUNDS):
        open_ = stage(_open_members(met, roots), "link-across")
        if open_.isEmpty():
            break
        pivots = open_.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "comp")).alias("p"))
        pivots = stage(pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.comp").alias("other")), "link-pivots")
        pairs = sized_join(open_, pivots, "key", "inner", 24).filter("comp <> other").select(
            F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        more = confirmed(pairs)
        if more.isEmpty():
            break
        links.append(more)
        roots = rooted(links)
    open_ = stage(_open_members(met, roots), "link-across")
    near = open_.filter(F.col("n") <= PAIRS_UP_TO).select("key", "id", "comp")
    large = stage(open_.filter(F.col("n") > PAIRS_UP_TO).select("id", "comp").distinct(), "link-large")
    other = near.select("key", F.col("id").alias("b"), F.col("comp").alias("comp_b"))
    pairs = near.select("key", F.col("id").alias("a"), F.col("comp").alias("comp_a")).join(other, "key").filter(
        "a < b and comp_a <> comp_b").select("a", "b")
    with passing() as keep:
        if not large.isEmpty():
            pairs = pairs.union(_close_pairs(large, sets, share, numbers_of))
        pairs = keep(stage(pairs.distinct(), "link-pairs"))
    more = confirmed(pairs)
    if more.isEmpty():
        return links, roots
    links.append(more)
    return links, rooted(links)
