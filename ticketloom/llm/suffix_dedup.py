"""Removal of every byte that a 100-byte string which starts earlier also covers.

Equal strings are brought together by content. Of the `gram`-byte grams inside a window of `length`
bytes the one with the smallest hash is its anchor, so equal windows have equal anchors at equal
places. Neighbouring windows share anchors: about one byte in forty is one. A task describes each
anchor by two hashes, of the gram and of all bytes under its windows, and keeps the first of those
that agree in both; all windows of the others start earlier elsewhere. Packed by hash, the anchors
meet the other tasks' and the same step is made again.

What is left are anchors with equal grams and different surroundings, the edges of repeats. Their
bytes are fetched, and within each gram the suffixes that begin at the anchor, and the reversed
prefixes that end there, are sorted: a merge sort whose comparisons find the common extension by
binary search over prefix polynomial hashes. The common extensions of neighbours are then verified
byte by byte. Two windows are equal if they reach as far to both sides as the extensions do.

A gram with more than `GROUP` surroundings is worked on window by window instead, by an aggregate
and an equi-join, so that no task ever holds more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, by_key, columns_of, partitions_for, touched, utf8
from ticketloom.session import materialise

LENGTH = 100
GRAM = 30
GROUP = 20_000
PARTITION_BYTES = 128 * 1024 * 1024
BUCKETS_A_PARTITION = 8
_PIECE = 1 << 22  # windows hashed at once; places among them fit into 23 bits
_HELD = 1 << 20  # anchors a task holds before it passes them on
_NULL_ID = (1 << 63) - 1

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LETTERS = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], _U)
_ANCHOR = np.dtype([
    ("h", "<u8"), ("c", "<u8"), ("hi", "<i8"), ("lo", "<i8"), ("p", "<i8"), ("before", "<i4"), ("span", "<i4")])
_SPAN_ROW = "h long, hi long, lo long, p long, s long, e long"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


class Prefixes:
    """Prefix polynomial hashes of a sequence of 64-bit letters; any part's hash in constant time."""

    def __init__(self, letters: np.ndarray) -> None:
        n = len(letters)
        powers = np.full(n, _BASE, _U)
        powers[:1] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(letters * powers, out=self.sums[1:])
        self.back = np.full(n + 1, _INVERSE, _U)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)

    def part(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.back[start]


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(texts: list[bytes], hi: np.ndarray, lo: np.ndarray, length: int, gram: int) -> np.ndarray:
    """All anchors of the texts: gram hash, hash of all bytes under their windows, document, place,
    bytes from the first window's start to the anchor, and windows less one."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = ends - np.array([len(t) for t in texts], np.int64)
    found = []
    for first in range(0, max(0, len(data) - length + 1), _PIECE):
        part = data[first : first + _PIECE + length - 1]
        windows = len(part) - length + 1
        hashes = Prefixes(_LETTERS[part])
        grams = mixed(hashes.part(np.arange(len(part) - gram + 1), gram))
        low = _U((1 << 23) - 1)
        places = (grams & ~low) | np.arange(len(grams), dtype=_U)
        place = (window_minima(places, length - gram + 1) & low).astype(np.int64)[:windows]
        at = np.arange(windows)
        doc = np.searchsorted(ends, at + first, side="right")
        whole = at + first + length <= ends[doc]
        at, place, doc = at[whole], place[whole], doc[whole]
        if not len(at):
            continue
        fresh = np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]
        begin = np.flatnonzero(fresh)
        last = np.r_[begin[1:], len(at)] - 1
        out = np.empty(len(begin), _ANCHOR)
        j0, p, d = at[begin], place[begin], doc[begin]
        out["span"] = at[last] - j0
        out["before"] = p - j0
        out["h"] = grams[p]
        shape = (out["before"].astype(_U) << _U(32)) | out["span"].astype(_U)
        out["c"] = mixed(hashes.part(j0, out["span"] + length) ^ mixed(shape))
        out["p"] = p + first - starts[d]
        out["hi"], out["lo"] = hi[d], lo[d]
        found.append(out)
    return np.concatenate(found) if found else np.empty(0, _ANCHOR)


def _firsts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors in order of hashes and place; whether each is the first with its two hashes."""
    found = found[np.lexsort((found["p"], found["lo"], found["hi"], found["c"], found["h"]))]
    fresh = np.r_[True, (found["h"][1:] != found["h"][:-1]) | (found["c"][1:] != found["c"][:-1])][: len(found)]
    first = found[np.maximum.accumulate(np.where(fresh, np.arange(len(found)), 0))]
    same = (found["hi"] == first["hi"]) & (found["lo"] == first["lo"]) & (found["p"] == first["p"])
    return found, fresh | same  # a repeated row of documents is the same place, not an earlier one


def _spans(found: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The bytes under all windows of each anchor, with neighbours in a document joined."""
    found = found[np.lexsort((found["p"], found["lo"], found["hi"]))]
    s = found["p"] - found["before"]
    e = s + found["span"] + length
    same = (found["hi"][1:] == found["hi"][:-1]) & (found["lo"][1:] == found["lo"][:-1]) & (s[1:] <= e[:-1])
    begin = np.flatnonzero(np.r_[True, ~same][: len(found)])
    if not len(begin):
        return {"hi": found["hi"], "lo": found["lo"], "s": s, "e": e}
    return {"hi": found["hi"][begin], "lo": found["lo"][begin], "s": np.minimum.reduceat(s, begin),
            "e": np.maximum.reduceat(e, begin)}


def _stacked(*parts) -> pa.Array:
    """Numbers of several arrays, one after the other."""
    return pa.concat_arrays([
        p.combine_chunks() if isinstance(p, pa.ChunkedArray) else p if isinstance(p, pa.Array) else pa.array(p, pa.int64())
        for p in parts])


def _finder(length: int, gram: int, buckets: int):
    def passed_on(held: list[np.ndarray]) -> pa.RecordBatch:
        found, first = _firsts(np.concatenate(held))
        spans = _spans(found[~first], length)
        found = found[first]
        bucket = (found["h"] % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, bucket = found[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
        packs = [p.tobytes() for p in np.split(found, cuts[1:])] if len(cuts) else []
        n = len(spans["s"])
        home = (mixed(spans["lo"].astype(_U) ^ mixed(spans["hi"].astype(_U))) % _U(buckets)).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(np.r_[bucket[cuts], home]),
            "pack": pa.array([*packs, *[None] * n], pa.binary()),
            **{k: _stacked(pa.nulls(len(packs), pa.int64()), spans[k]) for k in ("hi", "lo", "s", "e")}})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            hi, lo = (batch.column(c).to_numpy() for c in ("hi", "lo"))
            held.append(anchors(batch.column("text").to_pylist(), hi, lo, length, gram))
            count += len(held[-1])
            if count > _HELD:
                yield passed_on(held)
                held, count = [], 0
        if count:
            yield passed_on(held)

    return find


def _gatherer(length: int):
    """Spans of anchors that are not the first of their kind; anchors whose bytes are needed (s null)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "bucket"):
            packs = [p for p in table["pack"].to_pylist() if p is not None]
            ready = table.filter(table["pack"].is_null())
            found, first = _firsts(np.frombuffer(b"".join(packs), _ANCHOR))
            spans = _spans(found[~first], length)
            found = found[first]
            group = np.cumsum(np.r_[True, found["h"][1:] != found["h"][:-1]][: len(found)]) - 1
            other = np.r_[False, (found["c"][1:] != found["c"][:-1]) & (group[1:] == group[:-1])][: len(found)]
            several = np.bincount(group, other) > 0 if len(found) else np.zeros(0, bool)
            found = found[several[group]] if len(found) else found
            start = found["p"] - found["before"]
            wanted = {"hi": found["hi"], "lo": found["lo"], "s": start, "e": start + found["span"] + length}
            blank = pa.nulls(len(spans["s"]) + ready.num_rows, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "h": _stacked(blank, found["h"].astype(np.int64)),
                "hi": _stacked(spans["hi"], ready["hi"], wanted["hi"]),
                "lo": _stacked(spans["lo"], ready["lo"], wanted["lo"]),
                "p": _stacked(blank, found["p"]),
                "s": _stacked(spans["s"], ready["s"], wanted["s"]),
                "e": _stacked(spans["e"], ready["e"], wanted["e"])})

    return gather


_CONTEXT = "h long, hi long, lo long, p long, s long, context binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {c: [] for c in ("h", "hi", "lo", "p", "s", "context")}
        for text, hi, lo, wanted in zip(*columns_of(batch, "text", "hi", "lo", "wanted")):
            for x in wanted:
                for c, v in zip(out, (x["h"], hi, lo, x["p"], x["s"], text[x["s"] : x["e"]])):
                    out[c].append(v)
        yield pa.RecordBatch.from_pydict({
            c: pa.array(v, pa.binary() if c == "context" else pa.int64()) for c, v in out.items()})


class Suffixes:
    """Parts of a byte string, compared by their common extension."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> None:
        self.data = np.r_[data, np.zeros(1, np.uint8)]
        self.start, self.size, self.group = start, size, group
        self.hashes = Prefixes(_LETTERS[data])

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension: a binary search over prefix hashes."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            middle = (low + high + 1) >> 1
            equal = self.hashes.part(a, middle) == self.hashes.part(b, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether part i sorts strictly before part j; groups come first, a prefix before its longer."""
        common = self.extension(i, j)
        x = np.where(common < self.size[i], self.data[self.start[i] + np.minimum(common, self.size[i] - 1)].astype(np.int64), -1)
        y = np.where(common < self.size[j], self.data[self.start[j] + np.minimum(common, self.size[j] - 1)].astype(np.int64), -1)
        x = np.where(self.size[i] == common, -1, x)
        y = np.where(self.size[j] == common, -1, y)
        return (self.group[i] < self.group[j]) | ((self.group[i] == self.group[j]) & (x < y))

    def sort(self) -> np.ndarray:
        """Bottom-up merge sort; each element finds its place in the neighbouring run by bisection."""
        n = len(self.start)
        order, at, width = np.arange(n), np.arange(n), 1
        while width < n:
            run = at // width
            left = run % 2 == 0
            low = np.minimum((run + np.where(left, 1, -1)) * width, n)
            base, high = low.copy(), np.minimum(low + width, n)
            while (open_ := low < high).any():
                todo = np.flatnonzero(open_)
                middle = (low[todo] + high[todo]) >> 1
                mine, its = order[todo], order[middle]
                right_of = np.where(left[todo], self.before(its, mine), ~self.before(mine, its))
                low[todo] = np.where(right_of, middle + 1, low[todo])
                high[todo] = np.where(right_of, high[todo], middle)
            place = (run // 2) * 2 * width + (at - run * width) + (low - base)
            merged = np.empty(n, np.int64)
            merged[place] = order
            order, width = merged, width * 2
        return order

    def common(self, order: np.ndarray) -> np.ndarray | None:
        """Common extension of each part with the one before; None if a hash collided."""
        i, j = order[:-1], order[1:]
        found = self.extension(i, j)
        most = int(found.max(initial=0))
        step = np.arange(most)
        for at in range(0, len(i), 4096):
            some = slice(at, at + 4096)
            a = self.data[np.minimum(self.start[i[some], None] + step, len(self.data) - 1)]
            b = self.data[np.minimum(self.start[j[some], None] + step, len(self.data) - 1)]
            if ((a != b) & (step < found[some, None])).any():
                return None
        return np.r_[-1, np.where(self.group[i] == self.group[j], found, -1)]


def _sorted_parts(parts: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the parts within their groups, and the common extension with the one before."""
    size = np.array([len(p) for p in parts], np.int64)
    start = np.cumsum(size) - size
    suffixes = Suffixes(np.frombuffer(b"".join(parts), np.uint8), start, size, group)
    order = suffixes.sort()
    common = suffixes.common(order)
    if common is None:  # two different strings with one hash: compare the bytes themselves
        order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i])), np.int64)
        common = np.full(len(parts), -1)
        for at in range(1, len(parts)):
            a, b = parts[order[at - 1]], parts[order[at]]
            if group[order[at - 1]] == group[order[at]]:
                common[at] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return order, common


def repeated_windows(h: np.ndarray, rank: np.ndarray, before: np.ndarray, contexts: list[bytes],
                     length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the least and the greatest distance from a window that starts earlier to it.

    `rank` orders the anchors by place, equal for one place; -1 stands for no such window.
    """
    group = np.unique(h, return_inverse=True)[1]
    right = _sorted_parts([c[b:] for c, b in zip(contexts, before.tolist())], group)
    left = _sorted_parts([c[:b][::-1] for c, b in zip(contexts, before.tolist())], group)
    size = np.array([len(c) for c in contexts], np.int64)
    least, most = np.full(len(h), -1), np.full(len(h), -1)
    for distance in range(int(before.max(initial=-1)) + 1):
        has = np.flatnonzero((distance <= before) & (before - distance + length <= size))
        if len(has) < 2:
            continue
        kinds = []
        for (order, common), need in ((right, length - distance), (left, distance)):
            kind = np.empty(len(h), np.int64)
            kind[order] = np.cumsum(common < need)
            kinds.append(kind[has])
        order = np.lexsort((rank[has], kinds[1], kinds[0]))
        a, b, r = kinds[0][order], kinds[1][order], rank[has][order]
        fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        first = r[np.maximum.accumulate(np.where(fresh, np.arange(len(r)), 0))]
        again = has[order[r > first]]
        most[again] = distance
        least[again] = np.where(least[again] < 0, distance, least[again])
    return least, most


def _sorter(length: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "h"):
            h, hi, lo, p, s = (table[c].to_numpy() for c in ("h", "hi", "lo", "p", "s"))
            places = np.lexsort((p, lo, hi))
            a, b, c = hi[places], lo[places], p[places]
            rank = np.empty(len(h), np.int64)
            rank[places] = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
            least, most = repeated_windows(h, rank, p - s, table["context"].to_pylist(), length)
            hit = most >= 0  # these windows overlap, so together they are one span
            yield pa.RecordBatch.from_pydict({
                "hi": pa.array(hi[hit]), "lo": pa.array(lo[hit]),
                "s": pa.array((p - most)[hit]), "e": pa.array((p - least + length)[hit])})

    return sort


def _single_windows(length: int):
    """Digest and place of each window of the contexts."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for hi, lo, s, context in zip(*columns_of(batch, "hi", "lo", "s", "context")):
                for at in range(len(context) - length + 1):
                    rows.append((xxhash.xxh3_128_digest(context[at : at + length]), hi, lo, s + at))
            for at in range(0, len(rows), 1 << 16):
                w, hi, lo, s = zip(*rows[at : at + (1 << 16)])
                yield pa.RecordBatch.from_pydict({
                    "w": pa.array(w, pa.binary()), "hi": pa.array(hi, pa.int64()),
                    "lo": pa.array(lo, pa.int64()), "s": pa.array(s, pa.int64())})

    return windows


def _from_hot_grams(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows, by aggregate and join: for grams with very many surroundings."""
    windows = materialise(contexts.mapInArrow(_single_windows(length), "w binary, hi long, lo long, s long"), "windows")
    place = F.struct("hi", "lo", "s")
    first = windows.groupBy("w").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = windows.join(first, "w").where(place > F.col("first"))
    return again.groupBy("hi", "lo", "s").agg((F.col("s") + length).alias("e")).select("hi", "lo", "s", "e")


def places_of(docs: DataFrame) -> DataFrame:
    """`docs` as doc_id, text and the two numbers that name and order a document.

    `lo` tells rows apart that share an id or have none; where ids are unique it is zero.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    unique = rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()
    lo = F.lit(0).cast("long") if unique else F.xxhash64("text")
    return rows.withColumns({"hi": F.coalesce("doc_id", F.lit(_NULL_ID)), "lo": lo})


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(hi, lo, s, e): spans of bytes, overlapping, under windows that start earlier."""
    spark = rows.sparkSession
    bounded_batches(spark)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(partitions_for(spark), math.ceil(total / PARTITION_BYTES))
    buckets = partitions * BUCKETS_A_PARTITION
    found = rows.select("hi", "lo", "text").mapInArrow(
        _finder(length, gram, buckets), "bucket long, pack binary, hi long, lo long, s long, e long")
    found = found.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    found = materialise(found.mapInArrow(_gatherer(length), _SPAN_ROW), "spans")
    wanted = found.where(F.col("h").isNotNull())
    by_document = wanted.groupBy("hi", "lo").agg(F.collect_list(F.struct("h", "p", "s", "e")).alias("wanted"))
    texts, _ = touched(rows.select("hi", "lo", "text"), wanted, "hi", "lo")
    contexts = texts.join(by_document, ["hi", "lo"]).select("hi", "lo", "text", "wanted").mapInArrow(_fetch, _CONTEXT)
    hot = materialise(wanted.groupBy("h").count().where(F.col("count") > GROUP).select("h"), "hot")
    out = found.where(F.col("h").isNull()).select("hi", "lo", "s", "e")
    if not hot.isEmpty():
        contexts = materialise(contexts, "contexts")
        out = out.union(_from_hot_grams(contexts.join(hot, "h", "left_semi"), length))
        contexts = contexts.join(hot, "h", "left_anti")
    edges = contexts.repartition(partitions, "h").sortWithinPartitions("h").mapInArrow(
        _sorter(length), "hi long, lo long, s long, e long")
    return out.union(materialise(edges, "edges"))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cutter(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c.split()[0]: [] for c in _RESULT.split(", ")}
            for doc, text, spans in zip(*columns_of(batch, "doc_id", "text", "spans")):
                kept, at, runs = [], 0, 0
                for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                    if s > at or not runs:
                        kept.append(text[at:s])
                        runs += 1
                    at = max(at, e)
                kept = b"".join([*kept, text[at:]])
                values = (doc, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(),
                          kept if with_text else None)
                for c, v in zip(out, values):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict({
                c: pa.array(v, pa.binary() if c == "kept" else pa.string() if c == "kept_sha256" else pa.int64())
                for c, v in out.items()})

    return cut


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for each row of `docs`.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a smaller
    doc_id, or in the same document before. Strings are judged on the input. A null or empty text
    has no bytes. Rows with equal ids and different texts are ordered by a hash of the text; rows
    with equal ids and texts are one document, and none removes the other's bytes; null ids come
    last. Columns besides `doc_id` and `text` are not read.
    """
    rows = places_of(docs)
    spans = repeated_spans(rows, length, gram)
    hit, clean = touched(rows, spans, "hi", "lo")
    by_document = spans.groupBy("hi", "lo").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    cut = hit.join(by_document, ["hi", "lo"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cutter(with_text), _RESULT)
    whole = clean.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"))
    out = cut.union(whole)
    return out if with_text else out.drop("kept")
