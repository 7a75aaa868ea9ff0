"""Near-duplicate documents: MinHash, banding, verification, and components by alternating stars.

A document's set is its distinct runs of five lower-cased words, or the whole
sequence if it is shorter. Many universal hash minima form its signature; bands
of it are buckets. Pairs of a bucket are verified by sketches of the
signatures, confirmed on the full sets, and linked into components.

Documents are known by their id. Copies of one set are one item: its least id.

Defined cases: a null or blank text has an empty set and is linked with nothing;
rows without an id are linked with nothing and have no component; rows of equal
id are one document with several sets; repeated rows share a result; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

from .common import sized_join, text_slices
from .graphs import star_components
from .links import SET_SCHEMA, band_keys, key_lists, minima, set_rows, similar_components
from .wordhash import Words, mix, prefix_sums, run_numbers, words_of

SIZE = 5  # words of a shingle
SHARE = (75, 100)  # least Jaccard similarity
BANDS, HEIGHT = 40, 5  # a pair at the threshold is missed with probability 2e-5
SEED = 11


def shingle_sets(words: Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle numbers of every text, sorted, with the texts' borders."""
    numbers, at = words.windows(size)
    counts = np.diff(words.offsets)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        starts, ends = words.offsets[:-1][short], words.offsets[1:][short]
        numbers = np.r_[numbers, run_numbers(prefix_sums(words.numbers), starts, ends)]
        at = np.r_[at, starts]
    text = np.searchsorted(words.offsets, at, side="right") - 1
    order = np.lexsort((numbers, text))
    text, numbers = text[order], numbers[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (numbers[1:] != numbers[:-1])] if len(text) else np.empty(0, bool)
    text, numbers = text[new], numbers[new]
    return numbers, np.searchsorted(text, np.arange(len(counts) + 1))


def _digests(numbers: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """128 bits for every set, null for an empty one."""
    full = np.flatnonzero(np.diff(offsets))
    out: list[bytes | None] = [None] * (len(offsets) - 1)
    if len(full):
        starts = offsets[:-1][full]
        a = np.add.reduceat(mix(numbers ^ np.uint64(0x5851F42D4C957F2D)), starts)
        b = np.bitwise_xor.reduceat(mix(numbers + np.uint64(0x14057B7EF767814F)), starts)
        for i, x, y in zip(full, a, b):
            out[i] = x.tobytes() + y.tobytes()
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            numbers, offsets = shingle_sets(words_of(part.column("text"), lower=True))
            digests = _digests(numbers, offsets)
            keys = key_lists(band_keys(minima(numbers, offsets, BANDS * HEIGHT, SEED), HEIGHT))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(offsets)), pa.array(digests, pa.binary()), keys],
                names=["id", "n_shingles", "digest", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            numbers, offsets = shingle_sets(words_of(part.column("text"), lower=True))
            items = [numbers[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield set_rows(part.column("id").to_pylist(), np.diff(offsets).tolist(), minima(numbers, offsets, BANDS * HEIGHT, SEED), items)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (id, digest, n_shingles, component_id), and the confirmed links between least ids of different sets."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stage(rows.mapInArrow(_signatures, "id long, n_shingles long, digest binary, bands array<long>"), "near-signatures")
    classes = signed.filter("digest is not null and id is not null").groupBy("digest").agg(
        F.min("id").alias("least"), F.any_value("bands").alias("bands"))
    classes = stage(classes, "near-classes")
    members = classes.select(F.col("least").alias("id"), F.explode("bands").alias("key")).distinct()

    def sets_for(ids: DataFrame) -> DataFrame:
        # a text of each wanted set: ids name documents, and only wanted ids are read again
        return sized_join(rows, ids, "id", "left_semi", 16).mapInArrow(_sets, SET_SCHEMA).dropDuplicates(["id", "items"])

    links, roots = similar_components(members, sets_for, SHARE, star_components)
    labelled = sized_join(classes.select("digest", "least"), roots.withColumnRenamed("id", "least"), "least", "left", 16)
    labelled = labelled.select("digest", F.coalesce("root", "least").alias("component_id"))
    found = sized_join(signed.select("id", "n_shingles", "digest"), stage(labelled, "near-labels"), "digest", "left", 48)
    return found.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))), links


def near_dup_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id, kept; without the texts."""
    found, _ = near_duplicates(docs, id_col=id_col, text_col=text_col)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
