import tracemalloc

import numpy as np
import pyarrow as pa

from newsloom.llm import context_mixing, kneser_ney, line_dedup, links
from newsloom.llm.tally import Tally


def test_additions_wait_and_are_merged_together():
    rng, tally, plain = np.random.default_rng(3), Tally(500), {}
    for _ in range(20):
        numbers = np.unique(rng.integers(0, 400, 120, dtype=np.uint64))
        tally.add(numbers, np.ones(len(numbers), np.int64), pa.array([str(x) for x in numbers]))
        for x in numbers.tolist():
            plain[x] = plain.get(x, 0) + 1
        assert not tally.full
    tally.settle()
    assert dict(zip(tally.numbers.tolist(), tally.counts.tolist())) == plain
    assert tally.payload.to_pylist() == [str(x) for x in tally.numbers]


def test_classes_of_texts_take_one_line_of_sums_at_a_time():
    languages = np.zeros((16, 1 << 16), dtype=np.float32)
    batch = pa.RecordBatch.from_pydict({"text": ["word " * 400] * 1_200})
    tracemalloc.start()
    for part in context_mixing._with_class(languages, iter)(iter([batch])):
        assert part.column("class").to_pylist() == [0] * part.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # 16 languages' sums and their copy took over 500 MB before


def test_costs_of_all_slots_are_made_a_table_at_a_time():
    k, slots = context_mixing.K, 1 << context_mixing.BITS
    counts = np.random.default_rng(5).integers(0, 9, (k, 2, slots), dtype=np.uint16)
    model = context_mixing.Model(None, counts, np.ones((36, k)), np.zeros(256 * 33))
    tracemalloc.start()
    model.prepare()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    zero, one = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
    assert (model.logits == np.log((one + np.float32(0.4)) / (zero + np.float32(0.4)))).all()
    assert peak < 60 << 20


def test_numbers_of_sets_are_counted_by_component():
    sets = [np.array([3, 5, 1 << 63], np.uint64), np.array([5, 9], np.uint64), np.array([3, 5], np.uint64), np.empty(0, np.uint64)]
    batch = pa.RecordBatch.from_pydict({"comp": [7, 7, 8, 9], "items": [x.tobytes() for x in sets]})
    out = next(links._spread(links.plain_numbers)(iter([batch]))).to_pylist()
    assert {(r["token"], r["comp"], r["n"]) for r in out} == {(3, 7, 1), (5, 7, 2), (9, 7, 1), (-(1 << 63), 7, 1), (3, 8, 1), (5, 8, 1)} and len(out) == 6


def test_tables_of_runs_are_small():
    batch = pa.RecordBatch.from_pydict({"key": [1, 2, 3], "text": ["some words of a text", None, "some words"]})
    chars, at, owner = kneser_ney._laid_out(pa.array(["some words of a text", "", "some words"]))
    own = kneser_ney._numbers(chars, at)
    tracemalloc.start()
    found = pa.Table.from_batches(kneser_ney._new_runs(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    numbers = np.sort(found.column("num").to_numpy().view(np.uint64))
    tracemalloc.reset_peak()
    score = kneser_ney._scores(numbers, np.arange(len(numbers), dtype=float))
    out = pa.Table.from_batches(score(iter([batch]))).to_pydict()
    assert max(peak, tracemalloc.get_traced_memory()[1]) < 48 << 20  # four arrays of all slots were made for either before
    tracemalloc.stop()
    place = np.searchsorted(numbers, own)
    assert out["key"] == [1, 3] and out["s"] == [float(place[owner == i].sum()) for i in (0, 2)]


def test_runs_that_share_a_slot_are_told_apart():
    batch = pa.RecordBatch.from_pydict({"key": [1], "text": ["abcdefgh"]})
    chars, at, _ = kneser_ney._laid_out(batch.column("text"))
    own = np.unique(kneser_ney._numbers(chars, at))
    numbers = np.unique(np.r_[own, own ^ np.uint64(1), own ^ np.uint64(2)])
    logs = np.where(np.isin(numbers, own), 1.0, -1_000.0)
    assert pa.Table.from_batches(kneser_ney._scores(numbers, logs)(iter([batch]))).to_pydict()["s"] == [float(len(at))]


def test_lines_are_laid_out_once_for_sizes_and_sketches(monkeypatch):
    calls, laid = [], line_dedup._laid
    monkeypatch.setattr(line_dedup, "_laid", lambda items: calls.append(len(items)) or laid(items))
    text = "A line of some length\nshort\naaaaaaaaaaaaaaaaaaaa\n\u00e9t\u00e9 \u6f22\u5b57 and more"
    batch = pa.RecordBatch.from_pydict({"text": [text], "wanted": [[{"id": i, "line": i} for i in range(4)]]})
    out = pa.Table.from_batches(line_dedup._sets(iter([batch]))).to_pydict()
    lines = [x.lower() for x in text.split("\n")]
    plain = [len({x[i:i + line_dedup.SIZE] for i in range(max(len(x) - line_dedup.SIZE + 1, 1))}) for x in lines]
    assert calls == [4] and out["size"] == plain
    assert [len(x) for x in line_dedup.numbers_of_lines(out["items"])] == plain
