"""Repeated passages by relative Lempel-Ziv parsing.

The reference of a document is all text of documents with a smaller id. It is
indexed in blocks, spread over the cluster by hash, of all phrases of
``window`` words that can occur twice: every phrase has an anchor, the smallest
number among its short word runs, equal phrases have equal anchors, and only
phrases whose anchor occurs in two documents are indexed. A document is looked
up phrase by phrase and parsed greedily: a factor starts at the first phrase
found and goes on while the reference goes on with the same words; at its end
the phrases across the border are looked up as well, so a factor that begins
inside another is not missed. Factors of ``window`` words or more are removed.

Defined cases: a null text has no words; a text shorter than a window keeps
all words; rows without an id keep all words and are no reference; rows of
equal id are no reference of each other; repeated rows share their fate; an
empty table gives no rows; other columns are carried along, except clashing
ones named like an output, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import stage

from .common import sized_join, text_slices
from .wordhash import Words, mix, words_of

ANCHOR = 16  # words of the runs among which an anchor is chosen
KEY = ["__doc", "__row"]
OUTPUTS = ["n_words", "n_removed", "kept_text", "factors"]
FACTORS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("ref_doc", T.LongType()), T.StructField("ref_start", T.IntegerType())]))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    held, reach = values, 1
    while reach * 2 <= width:
        held = np.minimum(held[:-reach], held[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(held[:len(held) - rest], held[rest:]) if rest else held


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, the text of each, and its anchor."""
    numbers, at = words.windows(ANCHOR)
    counts = np.maximum(np.diff(words.offsets) - window + 1, 0)
    starts = np.repeat(words.offsets[:-1], counts) + _within(counts)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    laid = np.full(len(words.numbers), np.iinfo(np.uint64).max, dtype=np.uint64)
    laid[at] = numbers
    return starts, np.repeat(np.arange(len(counts)), counts), _sliding_min(laid, window - ANCHOR + 1)[starts]


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for every group of the given sizes."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64))


def _anchor_rows(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                _, text, anchor = _anchors(words_of(part.column("text"), lower=False), window)
                if not len(anchor):
                    continue
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
                at = pa.array(text[new])
                yield pa.RecordBatch.from_arrays(
                    [_signed(anchor[new]), part.column("__doc").take(at), part.column("__row").take(at)], names=["anchor", *KEY])

    return emit


def _phrase_rows(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = words_of(part.column("text"), lower=False)
                starts, text, anchor = _anchors(words, window)
                lists = part.column("anchors")
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                wanted = lists.flatten().to_numpy().view(np.uint64)
                own = np.isin(mix(anchor ^ mix(text.astype(np.uint64))), mix(wanted ^ mix(owner.astype(np.uint64))))
                if not own.any():
                    continue
                numbers, at = words.windows(window)  # the same places as ``starts``
                place = (at - words.offsets[text]).astype(np.int32)
                at = pa.array(text[own])
                yield pa.RecordBatch.from_arrays(
                    [_signed(numbers[own]), part.column("__doc").take(at), part.column("__row").take(at), pa.array(place[own])],
                    names=["phrase", *KEY, "place"])

    return emit


def parse_factors(places: np.ndarray, ref_docs: np.ndarray, ref_places: np.ndarray, window: int) -> np.ndarray:
    """Rows (start, end, ref_doc, ref_start) of a greedy parse of one document's found phrases."""
    order = np.argsort(places)
    places, ref_docs, ref_places = places[order], ref_docs[order], ref_places[order]
    goes_on = (np.diff(places) == 1) & (np.diff(ref_docs) == 0) & (np.diff(ref_places) == 1)
    first = np.flatnonzero(np.r_[True, ~goes_on])
    last = np.r_[first[1:], len(places)] - 1
    return np.column_stack([places[first], places[last] + window, ref_docs[first], ref_places[first]])


def _parse(window: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in batch.column("found"):
                flat = found.values
                rows.append([dict(zip(("start", "end", "ref_doc", "ref_start"), r)) for r in parse_factors(
                    *(flat.field(c).to_numpy() for c in ("place", "ref_doc", "ref_place")), window).tolist()])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("__doc"), batch.column("__row"), pa.array(rows, kind)], names=[*KEY, "factors"])

    return parse


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words outside all factors, joined by one blank. Words end where ``bytes.split`` ends them."""
    for batch in batches:
        for part in text_slices(batch, "__text"):
            n_words, n_removed, kept = [], [], []
            for text, factors in zip(part.column("__text"), part.column("factors")):
                words = text.as_buffer().to_pybytes().split()
                n_words.append(len(words))
                if factors.is_valid and len(factors):
                    out, at = [], 0
                    spans = factors.values
                    for start, end in zip(spans.field("start").to_pylist(), spans.field("end").to_pylist()):
                        if start > at:
                            out += words[at:start]
                        at = max(at, end)
                    words = out + words[at:]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            rest = [part.column(c) for c in part.schema.names if c not in ("__text", "factors")]
            names = [c for c in part.schema.names if c not in ("__text", "factors")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                 part.column("factors")], names=[*names, *OUTPUTS])


def find_factors(docs: DataFrame, window: int) -> DataFrame:
    """Factors of every document that has any; ``docs`` has the key columns and ``text``."""
    known = docs.filter("__doc is not null")
    anchors = stage(known.mapInArrow(_anchor_rows(window), "anchor long, __doc long, __row long"), "passage-anchors")
    shared = anchors.groupBy("anchor").agg(F.min("__doc").alias("a"), F.max("__doc").alias("b")).filter("a < b").select("anchor")
    mine = sized_join(anchors, stage(shared, "passage-shared"), "anchor", "inner", 16)
    mine = stage(mine.groupBy(*KEY).agg(F.collect_set("anchor").alias("anchors")), "passage-lists")
    looked = sized_join(known, mine, KEY, "inner", 24 + 8 * F.size("anchors"))
    phrases = stage(looked.mapInArrow(_phrase_rows(window), "phrase long, __doc long, __row long, place int"), "passage-phrases")
    index = phrases.groupBy("phrase").agg(F.min(F.struct("__doc", "place")).alias("first"), F.max("__doc").alias("last"))
    index = index.filter("first.__doc < last").select("phrase", F.col("first.__doc").alias("ref_doc"), F.col("first.place").alias("ref_place"))
    found = sized_join(phrases, stage(index, "passage-index"), "phrase", "inner", 28).filter("__doc > ref_doc")
    found = found.groupBy(*KEY).agg(F.collect_list(F.struct("place", "ref_doc", "ref_place")).alias("found"))
    schema = T.StructType([T.StructField("__doc", T.LongType()), T.StructField("__row", T.LongType()), T.StructField("factors", FACTORS)])
    return stage(found.mapInArrow(_parse(window), schema), "passage-factors")


def remove_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_text`` and ``factors`` (word spans and where they came from)."""
    keyed = docs.drop(*OUTPUTS, "__text", *KEY).withColumns({
        "__doc": F.col(id_col).cast("long"), "__row": F.xxhash64(id_col, text_col)})
    factors = find_factors(keyed.select(*KEY, F.col(text_col).alias("text")), window)
    joined = sized_join(keyed.withColumn("__text", F.coalesce(text_col, F.lit(""))), factors, KEY, "left", 24 + 24 * F.size("factors"))
    carried = [f for f in keyed.schema if f.name not in KEY]
    schema = T.StructType([*carried, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType()), T.StructField("factors", FACTORS)])
    return joined.select(*[f.name for f in carried], "__text", "factors").mapInArrow(_cut, schema)
