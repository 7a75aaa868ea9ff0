"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters: runs of ``ORDER`` characters, each text behind a
start mark and closed by an end mark. Counts, continuation counts, discounts
and back-off weights are tables of (run, value), made and joined by run, spread
over the cluster. The distinct runs of all documents get their probability once,
by joins against the tables of all orders; documents then join their own counts
of runs to it and sum up. A document is rejected if its perplexity is above a
high quantile of the trusted documents of its language and length.

The model is fitted on one half of all trusted documents, by hash, whole; quantiles
are over all documents of the other half and scores over all documents.

Defined cases: a null or empty text has no runs, no perplexity and is kept; a
null language is a language; a group's quantile is
blended by count, a language's with its median and the spread of all, a length
band's with its language's, and never lower than its own; a language without trusted documents that the model
has not seen takes the quantile of all; without trusted text every document is kept; repeated rows
share a result; an empty table gives no rows; other columns are carried along,
except clashing ones named like an output, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

from .common import bytes_of, sized_join, text_slices
from .tally import Tally
from .wordhash import mix, prefix_sums, run_numbers, text_bytes

ORDER = 5
START, END = 2, 3  # control characters that stand for the borders of a text
QUANTILE = 0.998
HALF = 300  # trusted documents of a group at which its own quantile counts half
BANDS = (100, 400, 1_600)  # borders of length, in runs
PROBABILITY_BYTES = 64 << 20  # the table of probabilities travels to the tasks up to this measured size
SEEN_BITS = 22
FLUSH = 400_000  # distinct runs a task holds before it hands them on
OUTPUTS = ["n_grams", "perplexity", "threshold", "kept"]


def _laid_out(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts with their marks, the places where runs begin, and the text of each run."""
    data, borders = text_bytes(texts)
    borders = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][borders]
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    sizes = np.diff(borders)
    laid = np.where(sizes > 0, sizes + ORDER, 0)
    ends = np.cumsum(laid)
    out = np.full(int(ends[-1]) if len(ends) else 0, START, dtype=np.uint32)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(chars)) - np.repeat(borders[:-1], sizes)
    out[(ends - laid)[text] + ORDER - 1 + inner] = chars
    out[ends[sizes > 0] - 1] = END
    runs = np.where(sizes > 0, sizes + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), runs)
    at = (ends - laid)[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs))
    return out, at, owner


def _numbers(chars: np.ndarray, at: np.ndarray) -> np.ndarray:
    return run_numbers(prefix_sums(mix(chars.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))), at, at + ORDER)


def _written(chars: np.ndarray, at: np.ndarray) -> pa.Array:
    """The runs themselves as texts."""
    flat = chars[at[:, None] + np.arange(ORDER)[None, :]].astype(np.uint32)
    text = flat.tobytes().decode("utf-32-le")
    return pa.array([text[i:i + ORDER] for i in range(0, len(text), ORDER)], pa.string())


def _distinct_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct runs of a task's texts with their counts, in few pieces."""
    tally = Tally(FLUSH)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(tally.numbers.view(np.int64)), tally.payload, pa.array(tally.counts)], names=["num", "gram", "n"])

    for batch in batches:
        for part in text_slices(batch, "text"):
            chars, at, _ = _laid_out(part.column("text"))
            if not len(at):
                continue
            numbers, first, counts = np.unique(_numbers(chars, at), return_index=True, return_counts=True)
            tally.add(numbers, counts, _written(chars, at[first]))
            if tally.full:
                yield out()
                tally.clear()
    tally.settle()
    if len(tally.numbers):
        yield out()


def _new_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a task's texts, most of them once: a table remembers the last run of each slot."""
    shift = np.uint64(64 - SEEN_BITS)
    seen = np.arange(1 << SEEN_BITS, dtype=np.uint64)
    seen ^= np.uint64(1)
    seen <<= shift  # no run of a slot is equal to what stands there first
    for batch in batches:
        for part in text_slices(batch, "text"):
            chars, at, _ = _laid_out(part.column("text"))
            numbers = _numbers(chars, at)
            new = np.flatnonzero(seen[numbers >> shift] != numbers)
            if not len(new):
                continue
            numbers, first = np.unique(numbers[new], return_index=True)
            seen[numbers >> shift] = numbers
            yield pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), _written(chars, at[new[first]])], names=["num", "gram"])


def _scores(numbers: np.ndarray, logs: np.ndarray):
    """Per text the number of runs and the sum of their logarithms, looked up in a table of slots."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - SEEN_BITS)
        slots = np.zeros(1 << SEEN_BITS, dtype=np.int32)  # where a run of the slot stands
        slots[numbers >> shift] = np.arange(len(numbers))
        for batch in batches:
            for part in text_slices(batch, "text"):
                chars, at, owner = _laid_out(part.column("text"))
                own = _numbers(chars, at)
                place = slots.take(own >> shift)
                other = np.flatnonzero(numbers.take(place) != own) if len(own) else place  # runs that lost their slot to another
                place[other] = np.searchsorted(numbers, own[other])
                found = logs.take(place) if len(own) else np.empty(0)
                n = np.bincount(owner, minlength=part.num_rows)
                s = np.bincount(owner, found, part.num_rows).astype(float)
                full = pa.array(np.flatnonzero(n))
                yield pa.RecordBatch.from_arrays([part.column("key").take(full), pa.array(n[n > 0]), pa.array(s[n > 0])], names=["key", "n", "s"])

    return score


def _runs_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its distinct runs and their counts."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            chars, at, owner = _laid_out(part.column("text"))
            if not len(at):
                continue
            numbers = _numbers(chars, at)
            order = np.lexsort((numbers, owner))
            numbers, owner = numbers[order], owner[order]
            first = np.flatnonzero(np.r_[True, (numbers[1:] != numbers[:-1]) | (owner[1:] != owner[:-1])])
            counts = np.diff(np.r_[first, len(numbers)])
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(owner[first])), pa.array(numbers[first].view(np.int64)), pa.array(counts)],
                names=["key", "num", "n"])


def distinct_runs(texts: DataFrame) -> DataFrame:
    """(gram, num, n) over all texts (column ``text``)."""
    found = texts.select("text").mapInArrow(_distinct_runs, "num long, gram string, n long")
    return found.groupBy("num").agg(F.any_value("gram").alias("gram"), F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts for runs counted once, twice and more often, from how many runs are counted 1 to 4 times."""
    r = counts.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n = [0, *(max(r[f"n{i}"], 1) for i in (1, 2, 3, 4))]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3)]


def fit(texts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], float]:
    """Tables of probabilities (gram, p) and of back-off weights (gram, g) for orders 1 to ORDER, and p of an unknown character."""
    counts = stage(distinct_runs(texts).select("gram", "n"), "kn-counts")
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # in how many ways a run is continued to the left
        longer = by_order[k + 1]
        by_order[k] = stage(longer.groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    probabilities: list[DataFrame] = []
    weights: list[DataFrame] = []
    unknown = 1.0
    for k in range(1, ORDER + 1):
        d = _discounts(by_order[k])
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        per_context = by_order[k].withColumn("context", F.substring("gram", 1, k - 1)).groupBy("context").agg(
            F.sum("n").alias("total"), F.sum(discount).alias("held"))
        per_context = stage(per_context.select("context", "total", (F.col("held") / F.col("total")).alias("g")), "kn-contexts")
        joined = by_order[k].withColumns({"context": F.substring("gram", 1, k - 1), "suffix": F.substring("gram", 2, k - 1)})
        joined = joined.join(per_context, "context")
        own = (F.col("n") - discount) / F.col("total")
        if k == 1:
            top = per_context.first()
            unknown = (top["g"] if top else 1.0) / (by_order[1].count() + 1)
            made = joined.select("gram", (own + F.lit(unknown)).alias("p"))
        else:
            lower = probabilities[-1].select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            made = joined.join(lower, "suffix").select("gram", (own + F.col("g") * F.col("lower")).alias("p"))
        probabilities.append(stage(made, "kn-probabilities"))
        weights.append(per_context.select(F.col("context").alias("gram"), "g"))
    return probabilities, weights, unknown


def probabilities_of(runs: DataFrame, model: tuple[list[DataFrame], list[DataFrame], float]) -> DataFrame:
    """(num, logp) of all ``runs`` (num, gram): the longest known run, times the back-off weights of the contexts above it."""
    tables, weights, unknown = model
    found = runs
    for k in range(1, ORDER + 1):
        p = tables[k - 1].withColumnRenamed("gram", f"s{k}").withColumnRenamed("p", f"p{k}")
        found = found.withColumn(f"s{k}", F.substring("gram", ORDER - k + 1, k))
        found = sized_join(found, p, f"s{k}", "left", F.octet_length(f"s{k}") + 24)
        if k > 1:
            g = weights[k - 1].withColumnRenamed("gram", f"c{k}").withColumnRenamed("g", f"g{k}")
            found = found.withColumn(f"c{k}", F.substring("gram", ORDER - k + 1, k - 1))
            found = sized_join(found, g, f"c{k}", "left", F.octet_length(f"c{k}") + 24)
    p: Column = F.coalesce("p1", F.lit(unknown))
    for k in range(2, ORDER + 1):
        p = F.coalesce(f"p{k}", F.coalesce(f"g{k}", F.lit(1.0)) * p)
    return found.select("num", F.log(p).alias("logp"))


def perplexities(docs: DataFrame, model, *, id_col: str, text_col: str, limit: int = PROBABILITY_BYTES) -> DataFrame:
    """(key, n_grams, nll) of every distinct (id, text) with text; nll is the mean over its runs.

    The probabilities of all runs travel to the tasks if they measure up to
    ``limit`` bytes; beyond that each text's runs meet them in a join.
    """
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    runs = keyed.select("text").mapInArrow(_new_runs, "num long, gram string")
    runs = stage(runs.groupBy("num").agg(F.any_value("gram").alias("gram")), "kn-runs")
    logs = stage(probabilities_of(runs, model), "kn-logs")
    if bytes_of(logs, 16) <= limit:
        held = logs.toArrow()
        numbers = held.column("num").to_numpy().view(np.uint64)
        order = np.argsort(numbers)
        sums = keyed.mapInArrow(_scores(numbers[order], held.column("logp").to_numpy()[order]), "key long, n long, s double")
    else:
        own = keyed.mapInArrow(_runs_of_texts, "key long, num long, n long")
        joined = own.join(logs.hint("merge"), "num")
        sums = joined.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("logp")).alias("s"))
    # repeated rows give their sums several times, which the mean does not show
    summed = sums.groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return summed.select("key", F.col("n").alias("n_grams"), (-F.col("s") / F.col("n")).alias("nll"))


def trusted_halves(docs: DataFrame, labels: DataFrame, *, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Ids of all trusted documents, and of the half the model is fitted on; the other half is for the quantiles."""
    trusted = stage(labels.filter("quality = 1").select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct(), "kn-trusted")
    present = trusted.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    return trusted, stage(present.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == 0), "kn-fitting")


_WORKING = ["__key", "__lang", "__band", "__nll", "__lang_cut", "__band_cut"]


def judge_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  quantile: float = QUANTILE) -> DataFrame:
    """``docs`` with ``n_grams``, ``perplexity``, ``threshold`` and ``kept``."""
    docs = docs.drop(*OUTPUTS, *_WORKING)
    trusted, half = trusted_halves(docs, labels, id_col=id_col)
    fitting = sized_join(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), half, "id", "left_semi", 8)
    model = fit(fitting)
    scored = stage(perplexities(docs, model, id_col=id_col, text_col=text_col), "kn-scores")
    band = sum((F.when(F.col("n_grams") > b, 1).otherwise(0) for b in BANDS), F.lit(0))
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    # narrow rows of the trusted documents that the model has not seen
    rest = sized_join(docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"), lang.alias("lang")), trusted, "id", "left_semi", 8)
    rest = rest.join(half, "id", "left_anti").dropDuplicates(["key"])
    rest = stage(sized_join(rest, scored, "key", "inner", 24).select("lang", band.alias("band"), "nll"), "kn-rest")
    high = F.percentile_approx("nll", quantile, 100_000).alias("high")
    own = F.col("n") / (F.col("n") + HALF)
    per_lang = stage(rest.groupBy("lang").agg(high, F.percentile_approx("nll", 0.5, 100_000).alias("mid"), F.count(F.lit(1)).alias("n")), "kn-langs")
    # how far above its language's median a document may be, over all languages
    beside = rest.join(per_lang.select("lang", "mid"), "lang").select((F.col("nll") - F.col("mid")).alias("nll"))
    spread = F.lit(beside.agg(high).first()["high"]).cast("double")
    whole = rest.agg(high).first()["high"]
    per_lang = per_lang.select("lang", F.greatest("high", own * F.col("high") + (1 - own) * (F.col("mid") + spread)).alias("__lang_cut"))
    per_band = rest.groupBy("lang", "band").agg(high, F.count(F.lit(1)).alias("n")).join(per_lang, "lang").select(
        "lang", "band", F.greatest("high", own * F.col("high") + (1 - own) * F.col("__lang_cut")).alias("__band_cut"))
    cuts = scored.select("key", "n_grams", "nll", band.alias("__band"))
    keyed = docs.withColumns({"__key": F.xxhash64(id_col, text_col), "__lang": lang})
    joined = sized_join(keyed, cuts.withColumnRenamed("key", "__key").withColumnRenamed("nll", "__nll"), "__key", "left", 28)
    joined = joined.join(stage(per_lang.withColumnRenamed("lang", "__lang"), "kn-cuts"), "__lang", "left").join(
        stage(per_band.select(F.col("lang").alias("__lang"), F.col("band").alias("__band"), "__band_cut"), "kn-cuts"), ["__lang", "__band"], "left")
    limit = F.coalesce("__band_cut", "__lang_cut", F.lit(whole).cast("double"))
    return joined.withColumns({
        "n_grams": F.coalesce("n_grams", F.lit(0)).cast("long"), "perplexity": F.exp("__nll"), "threshold": F.exp(limit),
        "kept": F.coalesce(F.col("__nll") <= limit, F.lit(True))}).drop(*_WORKING)
