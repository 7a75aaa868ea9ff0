"""Log-probabilities of texts by logistic context mixing of hashed bit predictors.

A text is a sequence of units: a word with the white space behind it, and an end
mark. A unit's bytes are spelled in the bits of prefix codes, one behind each
byte, made from the training counts. Every bit is predicted by several contexts (the bytes before
it, one to four of them, and all of the unit so far with the end of the unit
before), each by its own table of counts, found by hash. A mixer adds the
predictions in the logistic domain; which of its weight sets serves is gated by
how often the two longest contexts were seen. The result is refined by an
adaptive map from (last byte, prediction) to what came true. Contexts reach
over unit borders by two bytes, so a unit costs the same wherever that end is
the same: tasks count, learn and score distinct units with their numbers.
A text's class is the language that its bytes look most like, by pairs of bytes
of the training texts of each language; it follows from the text alone, and its
own cost is part of a text's bits.

Training, in Spark: tasks tally units of their texts, tallies are summed by
unit; tasks count bits of their units, tables are summed slot by slot; then
every task goes through its units online: it predicts a chunk from the summed
counts without one occurrence of the unit itself, scores, and only then moves
weights and map; weights are averaged over tasks by their evidence and maps are
summed. The tables have a fixed number of slots and are the only thing sent to
all tasks, besides the words that are most frequent; other words' counts reach
the texts by a join. What several steps need is sent once for all of them, as
every copy lies on the disk of every executor.

Defined cases: a null text is an empty one; a row without an id is not held
out; an empty table gives no rows; without training texts all predictions are
even; repeated rows are scored alike, and learned from as often as they occur;
a null language is one as well; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

from .common import sized_join, text_slices
from .tally import Tally
from .wordhash import mix, powers, prefix_sums, run_numbers, text_bytes, words_of

END = 0xFF  # a byte that no text has: before and behind every text
TAIL = 2  # bytes of the unit before that a context may see
LONGEST = 64  # bytes after which a unit is cut
HEAD = 1 + TAIL  # bytes written before a unit: its class, and the end of the unit before
ORDERS = (1, 2, 3, 4, 0)  # bytes that the contexts see, one more each; 0 is the unit so far
CLASSES = 256
KINDS = 16  # most frequent languages that texts are told apart by
BITS = 20  # of a table's slots
BLOCK = 10  # bits of the slots that travel together
HELD = 400_000  # distinct units or words a task holds before it hands them on
SLICE = 1 << 20
EVEN = 0.4  # added to both counts of a slot
LEVELS = 6  # of how often a context was seen
STEPS, REACH = 33, 8.0  # of the adaptive map, over logits from -REACH to REACH
GRID, TOP = 128, 20  # final logits are multiples of 1 / GRID, up to TOP
CHUNK = 2_000  # units between two updates
WORD_SLOTS = 22  # bits of the slots that frequent words are looked up by
FREQUENT_WORDS = 400_000  # words whose counts travel to all tasks, at most
FREQUENT_UNITS = 400_000  # units whose costs do
K = len(ORDERS)


# --- units ----------------------------------------------------------------------------------

@dataclass
class Units:
    """Units of a slice of texts: bytes with marks, borders, numbers, and where each text's units begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray
    offsets: np.ndarray
    classes: np.ndarray  # of each unit

    def written(self, which: np.ndarray) -> pa.Array:
        """The chosen units with what their contexts see before them."""
        starts, sizes = self.starts[which] - HEAD, self.ends[which] - self.starts[which] + HEAD
        borders = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        flat = self.data[np.repeat(starts - borders[:-1], sizes) + np.arange(borders[-1])]
        flat[borders[:-1]] = self.classes[which]
        return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(borders), pa.py_buffer(flat)])


def units_of(part: pa.RecordBatch) -> Units:
    source, borders = text_bytes(part.column("text"))
    sizes = np.diff(borders)
    n = len(sizes)
    heads = borders[:-1] + np.arange(n) * (HEAD + 1) + HEAD  # where each text's bytes begin
    data = np.full(len(source) + n * (HEAD + 1), END, dtype=np.uint8)
    data[np.arange(len(source)) + np.repeat(np.arange(n) * (HEAD + 1) + HEAD, sizes)] = source
    space = (data == 0x20) | ((data >= 9) & (data <= 13))
    first = ~space & (data != END)
    first[1:] &= space[:-1]
    first[heads] = True
    ends_of_texts = heads + sizes + 1
    starts = np.flatnonzero(first)
    ends = np.r_[starts[1:], len(data)]
    owner = np.searchsorted(heads, starts, side="right") - 1
    ends = np.minimum(ends, ends_of_texts[owner])
    pieces = -(-(ends - starts) // LONGEST)
    if len(pieces) and pieces.max() > 1:
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        owner = np.repeat(owner, pieces)
        starts, ends = np.repeat(starts, pieces) + inner * LONGEST, np.repeat(ends, pieces)
        ends = np.minimum(starts + LONGEST, ends)
    classes = part.column("class").to_numpy().astype(np.uint8)[owner]
    numbers = run_numbers(prefix_sums(mix(data.astype(np.uint64) + np.uint64(0x1234567))), starts - TAIL, ends)
    numbers = mix(numbers ^ mix(classes.astype(np.uint64) + np.uint64(1)))
    return Units(data, starts, ends, numbers, np.searchsorted(starts, np.r_[heads, len(data) + 1]), classes)


# --- classes --------------------------------------------------------------------------------

def _byte_pairs(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of following bytes of all texts as numbers (also across borders), and the texts' borders."""
    data, borders = text_bytes(part.column("text"))
    return data[:-1].astype(np.int64) * 256 + data[1:], borders


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            pairs, borders = _byte_pairs(part)
            for lang, a, b in zip(part.column("lang").to_pylist(), borders[:-1], borders[1:]):
                held = sums.setdefault(lang, np.zeros(1 << 16, dtype=np.int64))
                if b - a > 1:
                    np.add.at(held, pairs[a:b - 1], 1)
    for lang, held in sums.items():
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), lang, np.int32)), pa.array(some.astype(np.int32)), pa.array(held[some])],
                                         names=["lang", "pair", "n"])


def byte_languages(rows: DataFrame) -> np.ndarray:
    """Log-probabilities of byte pairs, one row for each of the KINDS most frequent languages of rows (lang, text)."""
    most = [r["lang"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(KINDS).collect()]
    logs = np.zeros((max(len(most), 1), 1 << 16), dtype=np.float32)
    if len(most) < 2:
        return logs[:1]
    found = rows.filter(F.col("lang").isin(most)).mapInArrow(_pair_sums, "lang int, pair int, n long").groupBy("lang", "pair").agg(
        F.sum("n").alias("n")).toArrow()  # KINDS * 65 536 numbers at most
    counts = np.full(logs.shape, 0.5)
    place = {lang: i for i, lang in enumerate(most)}
    np.add.at(counts, (np.array([place[x] for x in found.column("lang").to_pylist()], dtype=np.int64), found.column("pair").to_numpy()), found.column("n").to_numpy())
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _with_class(languages: np.ndarray, work):
    """``work`` on batches that have the texts' classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(_classed(batches))

    def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                best = np.zeros(part.num_rows, dtype=np.int32)
                if len(languages) > 1 and part.num_rows:
                    pairs, borders = _byte_pairs(part)
                    ends = np.maximum(borders[1:] - 1, borders[:-1])
                    places = np.stack([borders[:-1], ends], axis=1).reshape(-1)
                    sums = np.empty((len(languages), part.num_rows))
                    for own, logs in zip(sums, languages):  # a text's sum is of its own pairs only, wherever it stands
                        line = np.zeros(len(pairs) + 2)
                        logs.astype(np.float64).take(pairs, out=line[:len(pairs)])
                        own[:] = np.where(ends > borders[:-1], np.add.reduceat(line, places)[::2], 0.0)
                    best = sums.argmax(axis=0).astype(np.int32)
                yield part.append_column("class", pa.array(best))

    return run


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units (kind 0) and words (kind 1) of a task's texts, and how many texts each class has (kind 2)."""
    units, words, classes = Tally(HELD), Tally(HELD), np.zeros(CLASSES, dtype=np.int64)

    def out(kind: int, tally: Tally) -> pa.RecordBatch:
        n = len(tally.numbers)
        unit = tally.payload if kind == 0 and tally.payload is not None else pa.nulls(n, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(tally.numbers.view(np.int64)), unit, pa.array(tally.counts)],
            names=["kind", "num", "unit", "n"])

    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            classes += np.bincount(part.column("class").to_numpy(), minlength=CLASSES)
            found = units_of(part)
            numbers, first, counts = np.unique(found.numbers, return_index=True, return_counts=True)
            units.add(numbers, counts, found.written(first))
            words.add(*np.unique(words_of(part.column("text"), lower=True).numbers, return_counts=True))
            for kind, tally in enumerate((units, words)):
                if tally.full:
                    yield out(kind, tally)
                    tally.clear()
    for kind, tally in enumerate((units, words)):
        tally.settle()
        if len(tally.numbers):
            yield out(kind, tally)
    met = np.flatnonzero(classes)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), 2, np.int32)), pa.array(met), pa.nulls(len(met), pa.binary()), pa.array(classes[met])],
                                     names=["kind", "num", "unit", "n"])


# --- bits -----------------------------------------------------------------------------------

@dataclass
class Code:
    """A prefix code of bytes behind every byte: for a pair its length and where its steps begin; of each step the
    node's part of a slot, and the bit."""

    lengths: np.ndarray
    begins: np.ndarray
    places: np.ndarray
    bits: np.ndarray


def _paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Huffman's code for 256 counts: (inner node, bit) from the root to each byte."""
    heap = [(int(c), b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    name = 256
    while len(heap) > 1:
        (x, a), (y, b) = heapq.heappop(heap), heapq.heappop(heap)
        children[name] = (a, b)
        heapq.heappush(heap, (x + y, name))
        name += 1
    paths: list[list[tuple[int, int]]] = [[]] * 256
    stack: list[tuple[int, list[tuple[int, int]]]] = [(name - 1, [])]
    while stack:
        node, path = stack.pop()
        if node < 256:
            paths[node] = path
            continue
        for bit, child in enumerate(children[node]):
            stack.append((child, [*path, (node - 256, bit)]))
    return paths


def make_code(counts: np.ndarray) -> Code:
    """One code for each row of a 256 x 256 table: counts of bytes behind a byte. Rows without counts share one."""
    whole = counts.sum(axis=0)
    plain = _paths(whole * 16 + 1)
    paths, nodes, bits = [], [], []
    for before in range(256):
        own = _paths(counts[before] * 256 + whole / max(whole.sum(), 1) * 16 + 1) if counts[before].any() else plain
        paths += [len(p) for p in own]
        nodes += [before * 256 + n for p in own for n, _ in p]
        bits += [b for p in own for _, b in p]
    lengths = np.array(paths)
    places = mix(np.array(nodes, dtype=np.uint64) + np.uint64(1)) >> np.uint64(64 - BITS)
    return Code(lengths, np.cumsum(lengths) - lengths, places.astype(np.int32), np.array(bits, dtype=np.int8))


_LOWERED = np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)  # of A-Z as of a-z
_LOWERED[65:91] += np.uint64(32)


@dataclass
class Bits:
    """The bits of some units: values, slots of every context, last byte, and the border of each unit's bits."""

    values: np.ndarray
    slots: list[np.ndarray]
    last: np.ndarray
    borders: np.ndarray


def bits_of(units: pa.Array, code: Code) -> Bits:
    borders = np.frombuffer(units.buffers()[1], dtype=np.int32)[units.offset:units.offset + len(units) + 1].astype(np.int64)
    data = np.frombuffer(units.buffers()[2], dtype=np.uint8)[borders[0]:borders[-1]]
    borders = borders - borders[0]
    own = np.diff(borders) - HEAD
    at = np.repeat(borders[:-1] + HEAD - (np.cumsum(own) - own), own) + np.arange(own.sum())
    begin = np.repeat(borders[:-1] + 1, own)
    symbols = data[at - 1].astype(np.int64) * 256 + data[at]
    group = np.repeat(mix(data[borders[:-1]].astype(np.uint64) + np.uint64(1)), own)
    lower = prefix_sums(_LOWERED[data])
    lengths = code.lengths[symbols]
    ends = np.cumsum(lengths)
    byte_of = np.repeat(np.arange(len(at)), lengths)  # of each bit
    step = (code.begins[symbols] - (ends - lengths)).take(byte_of) + np.arange(len(byte_of))
    place = code.places.take(step)
    shift, spread = np.uint64(64 - BITS), np.uint64(0x9E3779B97F4A7C15)
    seen = np.zeros(len(at), dtype=np.uint64)
    slots = []
    for k, order in enumerate(ORDERS):
        if order:  # one byte more, where there is one
            byte = data[np.maximum(at - order, 0)].astype(np.uint64) + np.uint64(1)
            if order > TAIL:
                byte *= at - order >= begin
            seen |= byte << np.uint64(9 * (order - 1))
            context = seen
        else:
            context = (lower[at] - lower[begin + TAIL]) * powers(len(lower))[1][begin + TAIL]
        context = ((context ^ group) * np.uint64(2 * k + 3) * spread >> shift).view(np.int64)
        slots.append(context.take(byte_of) ^ place)
    return Bits(code.bits.take(step), slots, data[at - 1].take(byte_of), np.r_[0, ends][np.r_[0, np.cumsum(own)]])


# --- training -------------------------------------------------------------------------------

def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each byte stands behind each other one."""
    sums = np.zeros(1 << 16)
    for batch in batches:
        for k in range(0, batch.num_rows, 5 * CHUNK):
            part = batch.slice(k, 5 * CHUNK)
            units = part.column("unit")
            borders = np.frombuffer(units.buffers()[1], dtype=np.int32)[units.offset:units.offset + len(units) + 1].astype(np.int64)
            data = np.frombuffer(units.buffers()[2], dtype=np.uint8)[borders[0]:borders[-1]].astype(np.int64)
            own = np.diff(borders) - HEAD
            at = np.repeat(borders[:-1] - borders[0] + HEAD - (np.cumsum(own) - own), own) + np.arange(own.sum())
            sums += np.bincount(data[at - 1] * 256 + data[at], np.repeat(part.column("n").to_numpy().astype(float), own), 1 << 16)
    some = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some].astype(np.int64))], names=["pair", "n"])


def _count_bits(sent: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables = sent.value, np.zeros((K, 2, 1 << BITS))
        for batch in batches:
            for at in range(0, batch.num_rows, 5 * CHUNK):
                part = batch.slice(at, 5 * CHUNK)
                bits = bits_of(part.column("unit"), code)
                weight = np.repeat(part.column("n").to_numpy().astype(float), np.diff(bits.borders))
                ones = np.flatnonzero(bits.values)
                zeros = np.flatnonzero(bits.values == 0)
                for k in range(K):
                    for value, which in enumerate((zeros, ones)):
                        np.add.at(tables[k, value], bits.slots[k][which], weight[which])
        rows = np.ascontiguousarray(tables.reshape(K, 2, -1, 1 << BLOCK).transpose(0, 2, 1, 3).reshape(-1, 2 << BLOCK).astype(np.float32))
        some = np.flatnonzero(rows.any(axis=1))
        for at in range(0, len(some), 1_000):
            mine = some[at:at + 1_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mine), pa.array([rows[i].tobytes() for i in mine], pa.binary())], names=["block", "counts"])

    return count


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of consecutive rows of one block, as pairs of 16-bit numbers with the same proportion."""
    block, total = None, None

    def out() -> pa.RecordBatch:
        top = total.reshape(2, -1).max(axis=0)
        fitted = total.reshape(2, -1) * np.minimum(1.0, 65_535 / np.maximum(top, 1.0))
        fitted = np.where(total.reshape(2, -1) > 0, np.maximum(fitted, 1.0), 0.0)  # what was seen stays possible
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([np.rint(fitted).astype(np.uint16).tobytes()], pa.binary())], names=["block", "counts"])

    for batch in batches:
        for b, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
            row = np.frombuffer(counts.as_buffer(), np.float32).astype(np.float64)
            if b != block:
                if block is not None:
                    yield out()
                block, total = b, np.zeros_like(row)
            total += row
    if block is not None:
        yield out()


def _levels(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(seen + 1).astype(np.int64), LEVELS - 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _map_place(last: np.ndarray, logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of the adaptive map at or below a logit, and the share of the next cell."""
    x = (np.clip(logit, -REACH, REACH - 1e-6) + REACH) * ((STEPS - 1) / (2 * REACH))
    low = x.astype(np.int64)
    return last.astype(np.int64) * STEPS + low, x - low


@dataclass
class Model:
    """What scoring needs: the code, tables of counts, gated weights and the adaptive map."""

    code: Code
    counts: np.ndarray  # K x 2 x slots
    weights: np.ndarray  # gates x K
    refined: np.ndarray  # 256 * STEPS, logits

    def prepare(self) -> None:
        """Logits and levels of all slots, computed once per worker."""
        if not hasattr(self, "logits"):
            logits, self.seen = np.empty((K, self.counts.shape[2]), np.float32), []
            for k in range(K):  # a table at a time, so that little is held besides the result
                zero, one = self.counts[k].astype(np.float32)
                logits[k] = np.log((one + np.float32(EVEN)) / (zero + np.float32(EVEN)))
                if k >= K - 2:
                    self.seen.append((_levels(zero + one) * (LEVELS if k == K - 2 else 1)).astype(np.int8))
            self.logits = logits
            self.sets = [np.ascontiguousarray(self.weights[:, k]) for k in range(K)]
            self.bit_costs = np.logaddexp(0.0, np.arange(-GRID * TOP, GRID * TOP + 1) / GRID) / np.log(2.0)

    def costs(self, units: pa.Array) -> np.ndarray:
        """Bits that each unit takes."""
        self.prepare()
        bits = bits_of(units, self.code)
        gate = (self.seen[0].take(bits.slots[K - 2]) + self.seen[1].take(bits.slots[K - 1])).astype(np.int64)
        logit = self.sets[0].take(gate) * self.logits[0].take(bits.slots[0])
        for k in range(1, K):
            logit += self.sets[k].take(gate) * self.logits[k].take(bits.slots[k])
        cell, share = _map_place(bits.last, logit)
        low = self.refined.take(cell)
        final = (logit + low + (self.refined.take(cell + 1) - low) * share) * 0.5
        # final logits lie on a grid, on which the costs of both bits are exact
        at = np.rint(np.clip(final, -TOP, TOP) * GRID).astype(np.int64)
        at *= 1 - 2 * bits.values.astype(np.int64)
        return np.add.reduceat(self.bit_costs.take(at + GRID * TOP), bits.borders[:-1])


@dataclass
class Sent:
    """A model whose code and counts the tasks already have: a worker puts it together once."""

    code: Broadcast
    tables: Broadcast  # under "counts"; a worker keeps its model beside them
    weights: np.ndarray
    refined: np.ndarray

    def costs(self, units: pa.Array) -> np.ndarray:
        held = self.tables.value
        if "model" not in held:
            held["model"] = Model(self.code.value, held["counts"], self.weights, self.refined)
        return held["model"].costs(units)

    def destroy(self) -> None:
        """Take the tables from the executors; no task can score afterwards."""
        self.code.destroy()
        self.tables.destroy()


def _learn(sent: Broadcast, tables: Broadcast):
    """Online passes of tasks over their units; the result is cells (weights, then map) with their evidence."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counts = sent.value, tables.value["counts"]
        both = np.ascontiguousarray(counts.transpose(0, 2, 1)).view(np.uint32)[..., 0]  # a slot's two counts are read at once
        first, second = (np.uint32(0), np.uint32(16)) if sys.byteorder == "little" else (np.uint32(16), np.uint32(0))
        gates = LEVELS * LEVELS
        weights = np.full((gates, K), 0.3)
        bend, evidence = np.full((gates, K), 1.0), np.zeros(gates)
        map_n = np.zeros((2, 256 * STEPS))
        logs, levels = np.log(np.arange(1 << 16) + EVEN), _levels(np.arange(1 << 17))
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                bits = bits_of(part.column("unit"), code)
                n = np.repeat(part.column("n").to_numpy().astype(float), np.diff(bits.borders))
                one = bits.values == 1
                inputs, seen = np.empty((K, len(n))), []
                ones, zeros = one.astype(np.uint16), (~one).astype(np.uint16)
                for k in range(K):
                    met = both[k].take(bits.slots[k])
                    c0, c1 = (met >> first).astype(np.uint16), (met >> second).astype(np.uint16)
                    c0, c1 = c0 - np.minimum(zeros, c0), c1 - np.minimum(ones, c1)  # without this occurrence
                    inputs[k] = logs.take(c1) - logs.take(c0)
                    if k >= K - 2:
                        seen.append(c0.astype(np.int64) + c1)
                gate = levels.take(seen[0]) * LEVELS + levels.take(seen[1])
                logit = np.zeros(len(n))
                for k in range(K):
                    logit += weights[:, k].take(gate) * inputs[k]
                p = _squash(logit)
                error = n * (one - p)
                slope = n * p * (1 - p)
                for k in range(K):
                    bend[:, k] = 0.95 * bend[:, k] + np.bincount(gate, slope * inputs[k] * inputs[k], gates)
                    weights[:, k] += np.bincount(gate, error * inputs[k], gates) / (bend[:, k] + 1.0) / K * 0.5
                evidence += np.bincount(gate, n, gates)
                cell, share = _map_place(bits.last, logit)
                for value, which in enumerate((~one, one)):
                    map_n[value] += np.bincount(cell[which], (n * (1 - share))[which], 256 * STEPS)
                    map_n[value] += np.bincount(cell[which] + 1, (n * share)[which], 256 * STEPS)
        cells = np.arange(gates * K + 2 * 256 * STEPS)
        values = np.r_[weights.reshape(-1), map_n.reshape(-1)]
        mass = np.r_[np.repeat(evidence, K), np.ones(2 * 256 * STEPS)]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(values), pa.array(mass)], names=["cell", "value", "mass"])

    return learn


def _sum_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for consecutive rows of one number, with the sum of their counts."""
    last, total, unit = None, 0, None  # the number that may go on in the next batch

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), unit, pa.array([total], pa.int64())], names=["num", "unit", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch.column("num").to_numpy()
        first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
        counts = np.add.reduceat(batch.column("n").to_numpy(), first)
        if last is not None and numbers[0] == last:
            counts[0] += total
        elif last is not None:
            yield row()
        found = pa.RecordBatch.from_arrays([pa.array(numbers[first]), batch.column("unit").take(pa.array(first)), pa.array(counts)], names=["num", "unit", "n"])
        last, total, unit = int(numbers[-1]), int(counts[-1]), found.column("unit").take(pa.array([len(first) - 1]))
        yield found.slice(0, len(first) - 1)
    if last is not None:
        yield row()


def summed_units(tallies: DataFrame) -> DataFrame:
    """Distinct units (num, unit, n) of staged tallies, written: by their number's partition, in order. Tasks have
    tallied them before, so rows move once and are summed where they end."""
    # no fixed number of parts: units of a small table stay together and are learnt from in one go
    rows = tallies.filter("kind = 0").select("num", "unit", "n").repartition("num").sortWithinPartitions("num")
    return stage(rows.mapInArrow(_sum_units, "num long, unit binary, n long"), "mix-units")


def train(summed: DataFrame) -> Sent:
    """A model from the summed units of the training texts; ``destroy`` it after use."""
    spark = summed.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = summed.select("unit", "n")
    pairs = np.zeros(1 << 16)
    for r in units.mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] = r["n"]
    code = spark.sparkContext.broadcast(make_code(pairs.reshape(256, 256)))
    # a task's tables are as large as the model: few tasks count, and their tables are summed block by block
    counters = min(tasks, 2 * spark.sparkContext.defaultParallelism)
    blocks = units.coalesce(counters).mapInArrow(_count_bits(code), "block long, counts binary")
    blocks = blocks.repartition(tasks, "block").sortWithinPartitions("block").mapInArrow(_sum_blocks, "block long, counts binary")
    counts = np.zeros((K << (BITS - BLOCK), 2, 1 << BLOCK), dtype=np.uint16)
    for r in blocks.toLocalIterator():  # a fixed number of slots, whatever the input
        counts[r["block"]] = np.frombuffer(r["counts"], np.uint16).reshape(2, -1)
    counts = np.ascontiguousarray(counts.reshape(K, -1, 2, 1 << BLOCK).transpose(0, 2, 1, 3).reshape(K, 2, -1))
    tables = spark.sparkContext.broadcast({"counts": counts})
    learned = units.mapInArrow(_learn(code, tables), "cell long, value double, mass double").groupBy("cell").agg(
        F.sum(F.col("value") * F.col("mass")).alias("v"), F.sum("mass").alias("m"), F.sum("value").alias("s"))
    gates = LEVELS * LEVELS
    weights, cells = np.full(gates * K, 0.3), np.zeros(2 * 256 * STEPS)
    for r in learned.collect():  # a fixed number of cells
        if r["cell"] >= gates * K:
            cells[r["cell"] - gates * K] = r["s"]
        elif r["m"] > 0:
            weights[r["cell"]] = r["v"] / r["m"]
    zero, one = cells.reshape(2, -1)
    centres = np.tile(np.linspace(-REACH, REACH, STEPS), 256)
    prior = 4.0  # observations' worth of trust in the mixed prediction itself
    refined = np.log((one + prior * _squash(centres) + 1e-9) / (zero + prior * _squash(-centres) + 1e-9))
    return Sent(code, tables, weights.reshape(gates, K), refined)


# --- scoring --------------------------------------------------------------------------------

def unit_costs(model: Sent, units: DataFrame, most: int = FREQUENT_UNITS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, in order, and costs of the most frequent units, ``most`` at most: reckoned once, not by every task."""
    _, counts = frequent_words(units.select("num", "n"), most)
    if not len(counts):
        return np.empty(0, np.uint64), np.empty(0)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5 * CHUNK):
                part = batch.slice(at, 5 * CHUNK)
                yield pa.RecordBatch.from_arrays([part.column("num"), pa.array(model.costs(part.column("unit")))], names=["num", "cost"])

    rows = units.filter(F.col("n") >= int(counts.min())).select("num", "unit").mapInArrow(price, "num long, cost double").toArrow()
    numbers = rows.column("num").to_numpy().view(np.uint64)
    order = np.argsort(numbers)
    return numbers[order], rows.column("cost").to_numpy()[order]


def _score(model: Sent, class_bits: np.ndarray, frequent: np.ndarray, logs: np.ndarray, priced: tuple[np.ndarray, np.ndarray]):
    """Rows of texts (kind 0) and of their words that are not among the frequent ones (kind 1)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, costs = priced
        shift = np.uint64(64 - WORD_SLOTS)
        slots = np.zeros(1 << WORD_SLOTS, dtype=np.int32)  # where a frequent word may stand; of those of one slot the last
        slots[frequent >> shift] = np.arange(len(frequent))
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                units = units_of(part)
                numbers, first, inverse = np.unique(units.numbers, return_index=True, return_inverse=True)
                place = np.searchsorted(known, numbers)
                new = np.ones(len(numbers), dtype=bool)
                inside = place < len(known)
                new[inside] = known[place[inside]] != numbers[inside]
                cost = np.empty(len(numbers))
                cost[~new] = costs[place[~new]]
                fresh = np.flatnonzero(new)
                for at in range(0, len(fresh), 5 * CHUNK):
                    some = fresh[at:at + 5 * CHUNK]
                    cost[some] = model.costs(units.written(first[some]))
                if len(known) > len(priced[0]) + 2 * HELD:
                    known, costs = priced
                elif len(fresh):
                    known, costs = np.insert(known, place[new], numbers[new]), np.insert(costs, place[new], cost[new])
                # every text has its end at least; its sum does not depend on the texts before it
                total = np.add.reduceat(cost[inverse], units.offsets[:-1]) + class_bits[part.column("class").to_numpy()]

                words = words_of(part.column("text"), lower=True)
                owner = np.repeat(np.arange(part.num_rows), np.diff(words.offsets))
                place = slots.take(words.numbers >> shift)
                hit = frequent.take(place) == words.numbers if len(frequent) else np.zeros(len(owner), bool)
                if len(frequent):  # words that lost their slot to another
                    other = np.flatnonzero(~hit)
                    place[other] = np.minimum(np.searchsorted(frequent, words.numbers[other]), len(frequent) - 1)
                    hit[other] = frequent[place[other]] == words.numbers[other]
                base = np.bincount(owner[hit], logs[place[hit]], part.num_rows).astype(float) if len(frequent) else np.zeros(part.num_rows)
                held = np.bincount(owner[hit], minlength=part.num_rows)
                ids = row + np.arange(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(part.num_rows, np.int32)), pa.array(ids), part.column("id"), part.column("held_out"),
                     pa.array(np.diff(words.offsets) + 1), pa.array(held), pa.array(base), pa.array(total),
                     pa.array(np.diff(text_bytes(part.column("text"))[1]))],
                    names=ROW_NAMES)
                rest = np.flatnonzero(~hit)
                order = np.lexsort((words.numbers[rest], owner[rest]))
                rest = rest[order]
                first = np.flatnonzero(np.r_[True, (np.diff(owner[rest]) != 0) | (np.diff(words.numbers[rest]) != 0)]) if len(rest) else rest
                many = np.diff(np.r_[first, len(rest)])
                rare = rest[first]
                blank = pa.nulls(len(rare), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(rare), np.int32)), pa.array(ids[owner[rare]]), pa.array(words.numbers[rare].view(np.int64)),
                     pa.nulls(len(rare), pa.bool_()), pa.array(many), pa.nulls(len(rare), pa.int64()), blank, blank,
                     pa.nulls(len(rare), pa.int64())], names=ROW_NAMES)
                row += part.num_rows

    return score


ROW_NAMES = ["kind", "row", "id", "held_out", "n", "known", "base", "bits", "n_bytes"]
ROWS = "kind int, row long, id long, held_out boolean, n long, known long, base double, bits double, n_bytes long"


def frequent_words(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, in order, and counts of the words counted 2**j times or more, with the least j that leaves ``most`` at most."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = {r["j"]: r["m"] for r in words.groupBy(level.alias("j")).agg(F.count(F.lit(1)).alias("m")).collect()}
    total, least = 0, 63
    for j in sorted(sizes, reverse=True):
        total += sizes[j]
        if total > most:
            break
        least = j
    rows = words.filter(level >= least).select("num", "n").toArrow()
    numbers = rows.column("num").to_numpy().view(np.uint64)
    order = np.argsort(numbers)
    return numbers[order], rows.column("n").to_numpy()[order]


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", folds: int = 7, fold: int = 2) -> DataFrame:
    """One row per document with its log10 probability under the unigram base and the mixed model.

    ``class_col`` names the languages of the training texts; no text is scored by it.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))
    lang = F.pmod(F.xxhash64(F.col(class_col).cast("string")), F.lit(CLASSES)).cast("int") if class_col else F.lit(0)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.coalesce(text_col, F.lit("")).alias("text"),
                       lang.alias("lang"))
    training = rows.filter("not held_out")
    languages = byte_languages(training.select("lang", "text"))
    rows = rows.drop("lang")
    tallies = stage(training.select("text").mapInArrow(_with_class(languages, _tallies), "kind int, num long, unit binary, n long"), "mix-tallies")
    by_class = np.zeros(CLASSES)
    for r in tallies.filter("kind = 2").groupBy("num").agg(F.sum("n").alias("n")).collect():
        by_class[r["num"]] = r["n"]
    ends = int(by_class.sum())  # every training text has one end
    class_bits = -np.log2((by_class + 1 / CLASSES) / (ends + 1))
    words = stage(tallies.filter("kind = 1").groupBy("num").agg(F.sum("n").alias("n")), "mix-words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens = sums["n"] + ends
    log_base = float(np.log10(train_tokens + sums["v"] + (1 if ends else 0) + 1))
    units = summed_units(tallies)
    model = train(units)
    priced = unit_costs(model, units)
    frequent, counts = frequent_words(words, FREQUENT_WORDS)
    scored = stage(rows.mapInArrow(_with_class(languages, _score(model, class_bits, frequent, np.log10(counts + 1.0), priced)), ROWS), "mix-scored")
    model.destroy()  # what follows reads written tables only
    rare = sized_join(scored.filter("kind = 1").select("row", F.col("id").alias("num"), F.col("n").alias("many")), words, "num", "inner", 16)
    rare = rare.groupBy("row").agg(F.sum("many").alias("more"), F.sum(F.col("many") * F.log10(F.col("n") + 1)).alias("gain"))
    joined = sized_join(scored.filter("kind = 0"), stage(rare, "mix-rare"), "row", "left", 24)
    end_known = 1 if ends else 0
    return joined.select(
        F.col("id").alias(id_col), "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0)) + end_known).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) + F.lit(float(np.log10(ends + 1.0))) - F.col("n") * F.lit(log_base)).alias("base_score"),
        (-F.col("bits") * F.lit(float(np.log10(2.0)))).alias("score"),
        (F.col("bits") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
