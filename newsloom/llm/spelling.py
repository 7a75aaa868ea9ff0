"""Spelling variants of words: pivotal grams, position limits, verification.

Bigrams are ordered from rare to frequent. A word's prefix is its first three
bigrams in that order; two that share no character are its pivots, chosen by
dynamic programming so that they occur in as few words as possible. One inserted,
deleted or replaced character cannot touch both, so of two near words the one
whose prefix ends at the rarer bigram has a pivot among the other's prefix, at
most one place off. The prefix takes in further places of its last bigram, as a
word may repeat it. Words meet in both roles, so neither order needs to be known.

Few bigrams exist, so a pivot alone would be a large bucket. The character that
differs lies in one half of the shorter word; the other half is part of the key.
That loses no pair and leaves no bucket that grows with the square of its words.
Keys are hashes; every pair is verified on the words.

Defined cases: null and empty texts have no runs; a null document id counts as
an empty one; repeated rows count each time; an empty table has no words; other
columns are not looked at. Runs hold letters of two ranges, so there are at most
90 * 90 bigrams, whatever the corpus; their order is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

RUN = r"[A-Za-zÀ-ÿ]+"  # fixed by the contract
LEAST_LENGTH, LEAST_COUNT = 5, 3
STRONGER = 2  # a form occurs at least so many times as often
ERROR_EVERY = 97
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PREFIX = 3  # q * errors + 1 bigrams
_ROWS = 50_000  # of one Arrow batch


def lower_ascii(run: Column) -> Column:
    return F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _LOWER)).otherwise(run)


def drop_letters(runs: DataFrame, every: int = ERROR_EVERY) -> DataFrame:
    """(word) of runs (id, run): one run of ``every``, known by crc32 of ``id:run``, loses one code point."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    hashed = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", error_every: int | None = ERROR_EVERY,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words long and frequent enough; ``error_every`` None counts the runs as they are."""
    found = F.explode(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.col(id_col).alias("id"), found.alias("run")).filter(F.char_length("run") >= least_length)
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    words = drop_letters(runs, error_every) if error_every else runs.select(F.col("run").alias("word"))
    counted = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def gram_costs(words: DataFrame) -> dict[str, int]:
    """Words each bigram occurs in."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.filter(F.char_length("word") > 1).select(
        F.explode(F.array_distinct(F.transform(places, lambda i: F.substring("word", i, F.lit(2))))).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_places(word: str, costs: dict[str, int]) -> list[int]:
    """Places of the word's rarest bigrams, rarest first."""
    return sorted(range(len(word) - 1), key=lambda i: (costs[word[i:i + 2]], word[i:i + 2], i))[:_PREFIX]


def pivots(word: str, places: list[int], costs: dict[str, int]) -> tuple[int, int]:
    """The two places, at least two apart, whose bigrams occur in the fewest words together."""
    best, one = None, None  # cheapest pair so far; cheapest single place two or more before this one
    places = sorted(places)
    behind = 0
    for place in places:
        while places[behind] <= place - 2:
            cost = costs[word[places[behind]:places[behind] + 2]]
            one = min(one, (cost, places[behind])) if one else (cost, places[behind])
            behind += 1
        if one:
            pair = (one[0] + costs[word[place:place + 2]], one[1], place)
            best = min(best, pair) if best else pair
    return best[1], best[2]


def _keys(word: str, at: int, probing: bool) -> list[int]:
    """Keys for equal length, for a shorter probing word and for a longer one, with either half untouched."""
    size, gram = len(word), word[at:at + 2]
    keys = []
    for kind, short in (("=", size), ("<", size if probing else size - 1), (">", size - 1 if probing else size)):
        half = short // 2
        for side, rest in (("l", word[:half]), ("r", word[size - (short - half):])):
            keys.append(xxhash.xxh3_64_intdigest(f"{kind}{short}{side}{gram}{rest}") - (1 << 63))
    return keys


def _entries(costs: dict[str, int], probing: bool):
    """Rows (key, word, n, at): a word's pivots if it probes, else its prefix with all places of the last bigram."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                places = prefix_places(word, costs)
                if probing:
                    chosen = pivots(word, places, costs)
                else:
                    last = word[places[-1]:places[-1] + 2]
                    chosen = sorted({*places, *(i for i in range(len(word) - 1) if word[i:i + 2] == last)})
                for at in chosen:
                    held.extend((key, word, n, at) for key in _keys(word, at, probing))
                if len(held) >= _ROWS:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)

    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    keys, words, counts, places = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(words), pa.array(counts, pa.int64()), pa.array(places, pa.int32())], names=["key", "word", "n", "at"])


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: words of ``words`` (word, n; distinct, four code points or more) one error apart."""
    costs = gram_costs(words)
    kind = "key long, word string, n long, at int"
    probes = words.mapInArrow(_entries(costs, True), kind)
    index = words.mapInArrow(_entries(costs, False), kind).toDF("key", "other", "other_n", "other_at")
    met = probes.join(index.hint("merge"), "key").filter((F.col("word") != F.col("other")) & (F.abs(F.col("at") - F.col("other_at")) <= 1))
    near = met.filter(F.levenshtein("word", "other", 1) == 1)
    first = F.col("word") < F.col("other")
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    pairs = near.select(pick("word", "other").alias("a"), pick("other", "word").alias("b"), pick("n", "other_n").alias("a_n"),
                        pick("other_n", "n").alias("b_n"))
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form; counts at least double along a chain, so a few rounds of doubling reach its end."""
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = reached.select(F.col("word").alias("root"), F.col("root").alias("up"))
        further = stage(reached.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")),
                        "spelling-roots")
        reached = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return reached


def group_variants(words: DataFrame) -> DataFrame:
    """Per word of ``words`` (word, n): form, root, n, n_near, form_n."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = stage(near_words(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"), F.max("n").alias("n"))
    strong = -F.col("best.minus") >= STRONGER * F.col("n")
    best = stage(best.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n")),
                 "spelling-forms")
    roots = _roots(best.filter("form is not null"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
