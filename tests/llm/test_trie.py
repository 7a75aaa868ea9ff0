import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from newsloom.llm import prefix_trie as P

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows, shared):
    """Nodes of the trie, by dictionaries of whole prefixes."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, (r or "", x or "")))
    told = {c: [y for _, _, y in sorted(v)] for c, v in convs.items()}
    if shared:
        own, told = told, {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            told[c] = v if c % 100 == 0 else own.get(c - c % 100, [])[:h] + v[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c in sorted(told):
        for d in range(len(told[c]) + 1):
            members[tuple(told[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return {(m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in m if len(told[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()}


def rows_of(trie):
    found = [tuple(r[c] for c in COLUMNS) for r in trie.collect()]
    assert len(found) == len(set(found))
    return set(found)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, conv long")


@pytest.fixture(scope="module")
def talks():
    draw, rows = random.Random(3), []
    for c in range(40):
        topic, cut = draw.choice([0, 1]), draw.choice([0, 3, 8, 9, 16, 18])
        for t in range(draw.choice([0, 1, 2, 5, 8, 9, 19])):
            rows.append((c + 95 * (c % 3), t or None, "user" if t % 2 else None, f"x{topic} {t}é😀" if t < cut else f"y{c % 4} {t}"))
    return [*rows, (None, 1, "user", "nobody's"), (500, 1, None, None), (500, 1, None, None), (501, 3, "", ""), (502, 1, "a", "b"), (502, 1, "a", "b")]


def test_trie_equals_a_plain_version(spark, talks):
    assert rows_of(P.conversation_trie(frame(spark, talks))) == plain(talks, False)


def test_trie_with_shared_heads(spark, talks):
    assert rows_of(P.shared_head_trie(frame(spark, talks))) == plain(talks, True)


def test_long_end_lists_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 7)
    rows = [(c, 1, "user", "the same") for c in range(60)]
    assert rows_of(P.conversation_trie(frame(spark, rows))) == plain(rows, False)
    assert P.shared_head_trie(frame(spark, rows).limit(0)).count() == 0
