"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))


class Sets:
    """Union-find with the smallest member as root."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def unite(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def linked(sets, share):
    """Components of items whose sets meet the share, by an inverted index."""
    found, seen, index = Sets(sets), {}, collections.defaultdict(list)
    for i in sorted(sets):
        s = sets[i]
        if not s:
            continue
        if s in seen:
            found.unite(seen[s], i)
            continue
        seen[s] = i
        for j, n in collections.Counter(j for x in s for j in index[x]).items():
            if share[1] * n >= share[0] * (len(s) + len(sets[j]) - n):
                found.unite(i, j)
        for x in s:
            index[x].append(i)
    return found


def near_duplicates(rows):
    sets = {}
    for i, text in rows:
        words = WORD.findall(low(text))
        runs = [tuple(words[k:k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        sets[i] = frozenset(runs)
    found = linked(sets, (75, 100))
    return {i: (len(sets[i]), found.root(i)) for i in sets}


def removed_lines(rows, size, share):
    """Line numbers that go, per document."""
    places = collections.defaultdict(list)
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            form = low(line).strip(" \t\n\x0b\x0c\r")
            if form:
                places[form].append((i, k))
    sets = {x: frozenset(x[k:k + size] for k in range(max(1, len(x) - size + 1))) for x in places}
    found, groups, gone = linked(sets, share), collections.defaultdict(list), collections.defaultdict(set)
    for x in places:
        groups[found.root(x)] += places[x]
    for group in groups.values():
        for i, k in sorted(group)[1:]:
            gone[i].add(k)
    return gone


def cut_passages(rows, window=50):
    docs = {i: WORD.findall(text or "") for i, text in rows}
    first = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][k:k + window]), i)
    out = {}
    for i, words in docs.items():
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_scores(rows):
    """Per id: held out, tokens, known tokens, training tokens, base score."""
    tokens = {i: [*WORD.findall(low(text)), None] for i, text in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    total = sum(counts.values())
    return {i: (held[i], len(ws), sum(counts[w] > 0 for w in ws), total,
                sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)) for i, ws in tokens.items()}


def secret_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def high_windows(string, alphabet, window, threshold):
    """Merged windows of class characters at or above the entropy threshold."""
    spans = []
    for at in range(len(string) - window + 1):
        part = string[at:at + window]
        if all(c in alphabet for c in part):
            bits = -sum(n / window * math.log2(n / window) for n in collections.Counter(part).values())
            if bits >= threshold - 1e-9:
                if spans and spans[-1][1] >= at:
                    spans[-1] = (spans[-1][0], at + window)
                else:
                    spans.append((at, at + window))
    return spans


def water_fill(sizes, weights, cap):
    """Targets: clamp what is above its cap, share the rest by weight, until none is above."""
    total, clamped = sum(sizes.values()), {}
    while True:
        rest = total - sum(clamped.values())
        open_ = {s: weights[s] for s in sizes if s not in clamped}
        shares = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: cap * sizes[s] for s in open_ if shares[s] > cap * sizes[s]}
        if not above:
            return clamped | shares
        clamped |= above


def best_pieces(text, scores, ids, longest, in_bytes):
    """Ids of the segmentation with the largest sum; a longer last piece wins a tie."""
    best = [(0, 0, None)]
    for i in range(1, len(text) + 1):
        top = None
        for n in range(min(i, longest), 0, -1):
            piece = text[i - n:i]
            score, what = scores.get(piece), ids.get(piece)
            if score is None:
                if n > 1:
                    continue
                score, what = in_bytes(piece)
            if top is None or best[i - n][0] + score > top[0]:
                top = (best[i - n][0] + score, n, what)
        best.append(top)
    out, i = [], len(text)
    while i:
        _, n, what = best[i]
        out = (what if isinstance(what, list) else [what]) + out
        i -= n
    return out
