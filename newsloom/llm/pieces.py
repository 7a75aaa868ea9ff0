"""SentencePiece encoding by streaming Viterbi, and decoding.

A text's best segmentation into vocabulary pieces has the largest sum of piece
scores. Only the last ``longest piece`` places of the search are kept: a place's
best path comes from one of them. Whenever the paths of all these places run
through one boundary, the pieces before it are settled and their ids are given
out, so memory does not grow with the text.

Two facts of the vocabulary are used to meet such boundaries early: if no piece
has a blank behind another character, every path has a boundary before a blank,
and if no piece joins a character to others, on both its sides. What stands
between two such boundaries is encoded once per task's memory; short stretches
of a slice of texts go through the same search together, as arrays.

A vocabulary of the BPE kind has ranks for scores. They are read as Zipf's law,
-ln(rank + 1), so that few and frequent pieces win. Characters without a piece
are written as byte pieces.

Defined cases: a null text gives null ids and an empty one no ids; a literal
``▁`` is written in bytes and so comes back as itself; equal sums go to the longer
last piece; repeated rows give equal ids; an empty table gives no rows; other
columns are carried along, except clashing ones named like an output, which are
replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices
from .wordhash import mix, powers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
_LITERAL = "\ud800"
SCALE = 1_000_000  # scores are whole numbers of millionths, so that equal sums are equal
TOGETHER = 32  # stretches up to this length are searched as arrays, longer ones as a stream
AT_ONCE = 8_192  # stretches searched at a time
REMEMBERED = 250_000  # stretches a worker remembers
SLICE = 1 << 20
OUTPUTS = ["ids", "n_ids", "round_trip"]

_UP, _DOWN = powers(TOGETHER + 1)
_SPREAD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
_WIDER = np.array([0x80, 0x800, 0x10000])  # characters from which UTF-8 takes a byte more


@dataclass
class Vocabulary:
    """Pieces with their scores, and the ids of the 256 byte pieces."""

    scores: dict[str, int]
    ids: dict[str, int]
    byte_ids: list[int]
    byte_score: int
    longest: int
    prefix: bool = True  # a blank is put before every text
    texts: dict[int, bytes] = field(default_factory=dict)  # what an id stands for

    @cached_property
    def stretch(self) -> re.Pattern:
        """Stretches between places where every path has a boundary."""
        joined = [p for p in self.scores if len(p) > 1]
        alone = [c for c in "\n\t\r" if not any(c in p for p in joined)]
        if any(BLANK in p.lstrip(BLANK) for p in joined):
            return re.compile(r"[\s\S]+")
        held = "".join(re.escape(c) for c in alone)
        return re.compile(f"[{held}]| *[^ {held}]+| +" if held else " *[^ ]+| +")

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the pieces in order, their scores and ids, and which key hashes occur at all."""
        names = list(self.scores)
        keys = np.array([_key(p) for p in names], dtype=np.uint64)
        order = np.argsort(keys)
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[(keys * _SPREAD) >> _SHIFT] = True
        return keys[order], np.array([self.scores[names[i]] for i in order]), np.array([self.ids[names[i]] for i in order]), maybe

    @cached_property
    def lengths(self) -> dict[int, int]:
        return {i: len(p) for p, i in self.ids.items()}

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in (BLANK if char == _LITERAL else char).encode("utf-8")]


def _char_values(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _key(piece: str) -> np.uint64:
    values = _char_values(np.array([ord(c) for c in piece], dtype=np.uint32))
    return (values * _UP[:len(values)]).sum(dtype=np.uint64) + np.uint64(len(values))


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model; about as many entries as its pieces, so it may travel to all tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids, plain = [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain.append((piece, i, model.get_score(i)))
    ranked = all(score <= 0 and score == int(score) for _, _, score in plain)  # BPE: minus the rank
    scores = {p: round(SCALE * (-float(np.log(1.0 - s)) if ranked else float(s))) for p, _, s in plain}
    least = min(scores.values()) - 5 * SCALE
    vocabulary = Vocabulary(scores, {p: i for p, i, _ in plain}, byte_ids, least, max(len(p) for p in scores))
    vocabulary.texts = {i: p.replace(BLANK, " ").encode("utf-8") for p, i in vocabulary.ids.items()}
    vocabulary.texts |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
    return vocabulary


def shown(text: str) -> str:
    """Blanks as pieces have them; a literal mark becomes a lone surrogate, which no text and no piece has."""
    return text.replace(BLANK, _LITERAL).replace(" ", BLANK)


def stream_encode(characters: Iterator[str], vocabulary: Vocabulary) -> Iterator[list[int]]:
    """Ids of a stream of characters, given out as soon as they are settled."""
    longest = vocabulary.longest
    window: deque[str] = deque(maxlen=longest)  # the last characters
    # of the last places: score and path; a path is (place, id or character, path before)
    paths: deque[tuple[int, tuple]] = deque([(0, (0, None, None))], maxlen=longest)
    at, settled = 0, 0  # characters read, and place up to which ids are out
    for char in characters:
        window.append(char)
        at += 1
        text = "".join(window)
        best = None
        for length in range(min(len(window), longest), 0, -1):
            if length > len(paths):
                continue
            piece = text[-length:]
            score = vocabulary.scores.get(piece)
            what: int | str = vocabulary.ids.get(piece, -1)
            if score is None:
                if length > 1:
                    continue
                score, what = vocabulary.byte_score * len(vocabulary.bytes_of(char)), char
            before = paths[-length]
            total = before[0] + score
            if best is None or total > best[0]:
                best = (total, (at, what, before[1]))
        paths.append(best)
        if at % longest == 0:
            out, settled = _settle(paths, settled, vocabulary)
            if out:
                yield out
    out, _ = _settle(deque([paths[-1]]), settled, vocabulary)
    if out:
        yield out


def _settle(paths: deque, settled: int, vocabulary: Vocabulary) -> tuple[list[int], int]:
    """Ids up to the last boundary that all paths share; the paths are cut there."""
    nodes = {id(p[1]): p[1] for p in paths}
    while len(nodes) > 1:  # step back from the furthest place until all meet
        far = max(nodes.values(), key=lambda n: n[0])
        del nodes[id(far)]
        nodes[id(far[2])] = far[2]
    node = next(iter(nodes.values()))
    where, out = node[0], []
    while node[0] > settled:
        what = node[1]
        out.append(vocabulary.bytes_of(what) if isinstance(what, str) else [what])
        node = node[2]
    return [i for part in reversed(out) for i in part], max(where, settled)


def _together(stretches: list[str], vocabulary: Vocabulary) -> list[list[int]]:
    """The same search over many short stretches at once, sorted by length."""
    lengths = np.array([len(s) for s in stretches])
    n, longest = len(stretches), int(lengths[-1])
    points = np.zeros((n, longest), dtype=np.uint32)
    flat = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points[np.arange(longest)[None, :] < lengths[:, None]] = flat
    points = np.ascontiguousarray(points.T)  # a row for each place
    values = _char_values(points)
    keys, scores, ids, maybe = vocabulary.table
    sums = np.zeros((longest + 1, n), dtype=np.uint64)
    best = np.zeros((longest + 1, n), dtype=np.int64)
    back = np.zeros((longest + 1, n), dtype=np.int32)
    what = np.zeros((longest + 1, n), dtype=np.int32)
    for at in range(1, longest + 1):
        sums[at] = sums[at - 1] + values[at - 1] * _UP[at - 1]
        first = int(np.searchsorted(lengths, at))  # of the stretches that reach this place
        size = np.searchsorted(_WIDER, points[at - 1, first:], side="right") + 1
        top = best[at - 1, first:] + vocabulary.byte_score * size  # the character in bytes
        step, name = np.ones(n - first, dtype=np.int32), np.full(n - first, -1, dtype=np.int32)
        for length in range(1, min(at, vocabulary.longest) + 1):
            key = (sums[at, first:] - sums[at - length, first:]) * _DOWN[at - length] + np.uint64(length)
            some = np.flatnonzero(maybe[(key * _SPREAD) >> _SHIFT])
            place = np.minimum(np.searchsorted(keys, key[some]), len(keys) - 1)
            hit = keys[place] == key[some]
            some, place = some[hit], place[hit]
            total = best[at - length, first:][some] + scores[place]
            # a piece goes before bytes, and a longer last piece before a shorter one of the same sum
            better = (total >= top[some]) if length > 1 else np.ones(len(some), dtype=bool)
            some, place = some[better], place[better]
            top[some], step[some], name[some] = total[better], length, ids[place]
        best[at, first:], back[at, first:], what[at, first:] = top, step, name
    found = np.full((longest, n), -2, dtype=np.int32)  # ids from the last to the first
    at, rows = lengths.copy(), np.arange(n)
    for k in range(longest):
        live = at > 0
        found[k, live] = what[at[live], rows[live]]
        at = np.where(live, at - back[at, rows], 0)
    in_bytes = (found == -1).any(axis=0)
    flipped = np.ascontiguousarray(found[::-1].T)
    ends = np.cumsum((flipped != -2).sum(axis=1))
    listed = flipped[flipped != -2].tolist()
    out = [listed[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
    for row in np.flatnonzero(in_bytes):
        place, spelled = 0, []
        for i in out[row]:
            spelled += [i] if i >= 0 else vocabulary.bytes_of(stretches[row][place])
            place += vocabulary.lengths[i] if i >= 0 else 1
        out[row] = spelled
    return out


class Encoder:
    """Encodes slices of texts; remembers stretches it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.places: defaultdict[str, int] = defaultdict(count().__next__)  # a new stretch gets the next number
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _learn(self, stretches: list[str]) -> None:
        found: list[list[int]] = [[]] * len(stretches)
        stretches = [shown(s) for s in stretches]
        short = [i for i, s in enumerate(stretches) if len(s) <= TOGETHER]
        short.sort(key=lambda i: len(stretches[i]))
        for at in range(0, len(short), AT_ONCE):
            mine = short[at:at + AT_ONCE]
            for i, ids in zip(mine, _together([stretches[i] for i in mine], self.vocabulary)):
                found[i] = ids
        for i, s in enumerate(stretches):
            if len(s) > TOGETHER:
                found[i] = [x for part in stream_encode(iter(s), self.vocabulary) for x in part]
        counts = np.array([len(f) for f in found], dtype=np.int64)
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]
        self.flat = np.r_[self.flat, np.array([x for f in found for x in f], dtype=np.int32)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the border of every text's ids."""
        if len(self.places) > REMEMBERED:
            self.forget()
        prefix = " " if self.vocabulary.prefix else ""
        places, known, find = self.places, len(self.places), self.vocabulary.stretch.findall
        order, ends = [], []
        for text in texts:
            if text:
                order += [places[s] for s in find(prefix + text)]
            ends.append(len(order))
        if len(places) > known:
            self._learn(list(islice(places, known, None)))
        at = np.array(order, dtype=np.int64)
        counts = self.counts[at]
        borders = np.r_[0, np.cumsum(counts)]
        inner = np.arange(borders[-1]) - np.repeat(borders[:-1], counts)
        return self.flat[np.repeat(self.starts[at], counts) + inner], borders[np.r_[0, ends]]


_encoders: dict[str, Encoder] = {}  # of this worker, by model


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text whose ids these are."""
    table = vocabulary.texts
    text = b"".join([table[i] for i in ids]).decode("utf-8", errors="replace")
    return text[1:] if vocabulary.prefix and ids else text


def encode_texts(docs: DataFrame, *, text_col: str = "text", model: str = MODEL, check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` and ``n_ids``; with ``check`` also ``round_trip``, whether the ids decode to the text."""
    sent_vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))  # a worker reads it once, not once a task
    kept = docs.drop(*OUTPUTS, "__text", "__missing", "__source")
    schema = T.StructType([*kept.schema, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType())])
    if check:
        schema = schema.add("round_trip", T.BooleanType())
    carried, names = kept.columns, schema.names
    # a text that is carried along goes to the task once
    sent, source = (kept, text_col) if text_col in carried else (kept.withColumn("__source", F.col(text_col)), "__source")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent_vocabulary.value
        encoder = _encoders.get(model)
        if encoder is None or encoder.vocabulary is not vocabulary:
            encoder = _encoders[model] = Encoder(vocabulary)
        for batch in batches:
            text = batch.column(source)
            batch = batch.append_column("__missing", text.is_null()).append_column("__text", text)
            for part in text_slices(batch, "__text", SLICE):
                texts = part.column("__text").to_pylist()
                ids, borders = encoder.encode(texts)
                more = []
                if check:
                    more = [pa.array([decode_ids(ids[a:b].tolist(), vocabulary) == t for t, a, b in zip(texts, borders, borders[1:])], pa.bool_())]
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids, pa.int32()), mask=part.column("__missing"))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in carried], lists, pa.array(np.diff(borders), pa.int64()), *more], names=names)
            batch = text = part = texts = ids = lists = None  # else they are held while the next batch is read

    return sent.mapInArrow(encode, schema)


def decode_texts(encoded: DataFrame, *, ids_col: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null."""
    vocabulary = load_vocabulary(model)
    kept = encoded.drop(out)
    schema = T.StructType([*kept.schema, T.StructField(out, T.StringType())])
    names = schema.names

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, vocabulary) for ids in map(_ids, batch.column(ids_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(decode, schema)


def _ids(value: pa.ListScalar) -> list[int] | None:
    return value.values.to_numpy().tolist() if value.is_valid else None
