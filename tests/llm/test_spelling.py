import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else (a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:])


def plain(counts):
    form, found = {}, {}
    for w, n in counts.items():
        met = [x for x in counts if near(w, x)]
        best = min(met, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        found[w] = len(met)
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n, found[w], counts.get(form[w])) for w, n in counts.items()}


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_variants_equal_all_pairs(spark):
    draw = random.Random(4)
    words = {"".join(draw.choices("abé", k=draw.randint(5, 8))) for _ in range(300)} | {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa"}
    counts = {w: draw.choice([3, 6, 12, 24, 50]) for w in words}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, key string")
    assert rows_of(S.group_variants(df)) == plain(counts)
    assert S.group_variants(df.limit(0)).count() == 0


def test_counts_of_whole_texts(spark):
    base = "Hello hello HELLO wörld÷x wörld÷x wörld÷x naïve-naïve_naïve abcd abcd abcd 漢字 " * 40
    rows = [(1, base), (2, base), (2, base), (None, "hello there"), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "q", "r") for i, t in rows], "doc_id long, text string, word string, n string")
    want = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 97 == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            if len(r) >= 5:
                want[r] += 1
    assert {r["word"]: r["n"] for r in S.word_counts(df).collect()} == {w: n for w, n in want.items() if n >= 3}


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=5, max_size=9), st.integers(0, 9), st.sampled_from("abcé"), st.sampled_from(["insert", "delete", "replace"]))
def test_near_words_share_a_key(word, at, letter, kind):
    at = min(at, len(word) - 1)
    other = {"insert": word[:at] + letter + word[at:], "delete": word[:at] + word[at + 1:], "replace": word[:at] + letter + word[at + 1:]}[kind]
    if other == word or len(other) < 4:
        return
    grams = {w[i:i + 2] for w in (word, other) for i in range(len(w) - 1)}
    costs = {g: zlib.crc32(g.encode()) % 50 for g in grams}
    met = False
    for a, b in ((word, other), (other, word)):
        places = S.prefix_places(b, costs)
        last = b[places[-1]:places[-1] + 2]
        index = {(k, i) for i in {*places, *(i for i in range(len(b) - 1) if b[i:i + 2] == last)} for k in S._keys(b, i, False)}
        probes = [(k, i) for i in S.pivots(a, S.prefix_places(a, costs), costs) for k in S._keys(a, i, True)]
        met = met or any((k, i + d) in index for k, i in probes for d in (-1, 0, 1))
    assert met


def test_pivots_are_the_cheapest_disjoint_pair():
    costs = {"ab": 5, "bc": 1, "cd": 5, "de": 4, "ef": 9}
    assert S.pivots("abcdef", [1, 3, 0], costs) == (1, 3)
    with pytest.raises(TypeError):
        S.pivots("abcdef", [1, 2], costs)
