"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def closure(items, linked):
    """Class of each item: the smallest index that can be reached."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if find(i) != find(j) and linked(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def fingerprint(text, size=4):
    tokens = words(ascii_lower(text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint_classes(prints, radius=4):
    distinct = sorted(set(prints))
    classes = closure(distinct, lambda a, b: (a ^ b).bit_count() <= radius)
    return {p: distinct[c] for p, c in zip(distinct, classes)}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def document_order(doc):
    digest = xxhash.xxh64_intdigest((doc[1] or "").encode(), 42)
    return doc[0] is None, doc[0] or 0, 42 if doc[1] is None else digest - (digest >> 63 << 64)


def line_classes(docs, threshold=2, min_bytes=25):
    """{(document key, line number): (first document key, line number, its doc_id)} of (doc_id, text)."""
    lines = sorted(
        (document_order(d), n, line) for d in set(docs)
        for n, line in enumerate((d[1] or "").encode().split(b"\n")) if len(line) >= min_bytes)
    distinct = sorted({line for _, _, line in lines})
    classes = dict(zip(distinct, closure(
        distinct, lambda a, b: abs(len(a) - len(b)) <= threshold and edit_distance(a, b) <= threshold)))
    first = {}
    for key, n, line in lines:
        first.setdefault(classes[line], (key, n))
    return {(key, n): first[classes[line]] for key, n, line in lines}


def without_repeats(texts, length=100):
    """(n_bytes, n_removed, n_spans, kept) of texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def base_counts(text):
    text = text or ""
    tokens = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = Counter(tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2))
    inside = {i + k for i in range(len(tokens) - 2) if windows[tuple(tokens[i : i + 3])] > 1 for k in range(3)}
    return (
        len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(inside))


def base_failed(counts):
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def kneser_ney(texts, symbol, order=4, alphabet=64):
    """Log probability function of an interpolated modified Kneser-Ney model of classed bytes."""
    counts = [None] * (order + 1)
    counts[order] = Counter(
        tuple(s[i - order + 1 : i + 1])
        for t in texts for s in [[0] * (order - 1) + [symbol(b) for b in (t or "").encode()]]
        for i in range(order - 1, len(s)))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, contexts = {}, {}
    for n in range(1, order + 1):
        of = Counter(counts[n].values())
        if all(of[i] for i in (1, 2, 3, 4)):
            y = of[1] / (of[1] + 2 * of[2])
            found = [i - (i + 1) * y * of[i + 1] / of[i] for i in (1, 2, 3)]
            cuts[n] = [min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1)]
        else:
            cuts[n] = [0.5, 1.0, 1.5]
        contexts[n] = defaultdict(lambda: [0, 0.0])
        for g, c in counts[n].items():
            contexts[n][g[:-1]][0] += c
            contexts[n][g[:-1]][1] += cuts[n][min(c, 3) - 1]

    def chance(gram):
        n = len(gram)
        if not n:
            return 1 / alphabet
        if gram[:-1] not in contexts[n]:
            return chance(gram[1:])
        total, mass = contexts[n][gram[:-1]]
        c = counts[n][gram]
        own = (c - cuts[n][min(c, 3) - 1]) / total if c else 0.0
        return own + mass / total * chance(gram[1:])

    return lambda gram: math.log(chance(tuple(gram)))


def percentile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


def kept_by_quality(docs, symbol, fence, step=0.001):
    """Whether each (doc_id, text, lang) passes, and its log perplexity a byte."""
    model = kneser_ney([d[1] for d in docs], symbol)
    values = []
    for _, text, _ in docs:
        s = [0] * 3 + [symbol(b) for b in (text or "").encode()]
        n = len(s) - 3
        values.append(-sum(model(s[i - 3 : i + 1]) for i in range(3, len(s))) / n if n else 0.0)
    failed = [base_failed(base_counts(d[1])) for d in docs]
    bands = defaultdict(list)
    for d, v, f in zip(docs, values, failed):
        if not f:
            bands[d[2] or ""].append(round(v / step))
    out = []
    for d, v, f in zip(docs, values, failed):
        if f:
            out.append(False)
            continue
        low, high = (percentile(bands[d[2] or ""], q) * step for q in (0.25, 0.75))
        reach = max(high - low, step) * fence
        out.append(low - reach <= v <= high + reach)
    return out, values


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(docs, items, width=10):
    """(n_words, n_hit, sorted item names) of each text."""
    windows = defaultdict(set)
    for name, text in items:
        tokens = benchmark_words(text)
        size = min(width, len(tokens))
        for i in range(len(tokens) - size + 1 if tokens else 0):
            windows[tuple(tokens[i : i + size])].add("null" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        tokens, hit, names = benchmark_words(text), set(), set()
        for size in sizes:
            for i in range(len(tokens) - size + 1):
                found = windows.get(tuple(tokens[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((len(tokens), len(hit), sorted(names)))
    return out
