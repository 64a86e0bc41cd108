"""Benchmark passages in texts, found by Wu-Manber search over words.

The test strings are the benchmark's windows of `width` words (an item of fewer words is one
window). A cursor stands on the last word of a possible occurrence and looks at the block of the
last two words: the shift table says how far the next occurrence can be at the least, and only a
block that ends a test string (shift 0) selects, by the hash of its last and first block, the
strings to compare word by word. Words are exact numbers, so a comparison cannot be wrong.

All cursors of an Arrow batch move in step, one for each stretch of `STRETCH` words. Texts are
read once and never shuffled. The benchmark is broadcast in pieces of about `BLOCK_BYTES`, by its
measured size; each row goes through the searches of all pieces in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, columns_of, record_batch, shipped, unpacked, utf8

WIDTH = 10
BLOCK_BYTES = 32 * 1024 * 1024
STRETCH = 256

# ASCII letters in lower case, digits and all bytes of other characters; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_HITS = "doc_id long, text binary, n_words long, spans array<struct<s:int,e:int>>, items array<string>"
_HITS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("items", pa.list_(pa.string())),
])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Patterns:
    """Search tables of all test strings of one length."""

    def __init__(self, strings: np.ndarray, owners: list[list[str]], n_words: int) -> None:
        self.width = width = strings.shape[1]
        self.block = block = min(2, width)
        self.base = n_words + 1
        last = self._code(strings, width - 1)
        mixed = self._mix(last, self._code(strings, block - 1))
        order = np.argsort(mixed, kind="stable")
        self.strings, self.mixed = strings[order], mixed[order]
        self.owners = [owners[i] for i in order.tolist()]
        codes = np.concatenate([self._code(strings, q) for q in range(block - 1, width)])
        shifts = np.repeat(np.arange(width - block, -1, -1), len(strings))
        by_code = np.lexsort((shifts, codes))
        codes, shifts = codes[by_code], shifts[by_code]
        first = np.r_[True, codes[1:] != codes[:-1]]
        self.codes, self.shifts = codes[first], shifts[first]
        self.skip = width - block + 1

    def _code(self, strings: np.ndarray, end: int) -> np.ndarray:
        return strings[:, end] if self.block == 1 else strings[:, end - 1] * self.base + strings[:, end]

    @staticmethod
    def _mix(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ first.astype(np.uint64)

    def search(self, numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, string) of every occurrence in the texts [start, end)."""
        cursor, stop = self._stretches(starts, ends)
        found_at, found = [], []
        while len(cursor):
            code = numbers[cursor] if self.block == 1 else numbers[cursor - 1] * self.base + numbers[cursor]
            slot = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            shift = np.where(self.codes[slot] == code, self.shifts[slot], self.skip)
            for at, which in self._select(numbers, cursor[shift == 0], code[shift == 0]):
                found_at.append(at)
                found.append(which)
            cursor = cursor + np.maximum(shift, 1)
            running = cursor < stop
            if not running.all():
                cursor, stop = cursor[running], stop[running]
        nothing = np.zeros(0, np.int64)
        return np.concatenate([nothing, *found_at]), np.concatenate([nothing, *found])

    def _stretches(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = starts + self.width - 1
        starts, ends, first = starts[first < ends], ends[first < ends], first[first < ends]
        counts = -(-(ends - first) // STRETCH)
        which = np.repeat(np.arange(len(first)), counts)
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        cursor = first[which] + number * STRETCH
        return cursor, np.minimum(cursor + STRETCH, ends[which])

    def _select(self, numbers: np.ndarray, at: np.ndarray, last: np.ndarray) -> Iterator[tuple]:
        if not len(at):
            return
        start = at - self.width + 1
        first = numbers[start] if self.block == 1 else numbers[start] * self.base + numbers[start + 1]
        mixed = self._mix(last, first)
        low, high = np.searchsorted(self.mixed, mixed), np.searchsorted(self.mixed, mixed, side="right")
        while (some := low < high).any():  # one string of each bucket at a time
            start, low, high = start[some], low[some], high[some]
            same = (numbers[start[:, None] + np.arange(self.width)] == self.strings[low]).all(axis=1)
            yield start[same], low[same]
            low = low + 1


def compile_patterns(items: list[tuple[str, bytes]], width: int) -> tuple[dict[bytes, int], list[Patterns]]:
    """Word numbers (from 1) and, for each length of test string, its search tables."""
    numbers: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[str]] = {}
    for name, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        size = min(width, len(ids))
        for at in range(len(ids) - size + 1 if ids else 0):
            windows.setdefault(tuple(ids[at : at + size]), set()).add(name)
    tables = []
    for size in sorted({len(w) for w in windows}):
        own = [w for w in windows if len(w) == size]
        tables.append(Patterns(np.array(own, np.int64), [sorted(windows[w]) for w in own], len(numbers)))
    return numbers, tables


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for s, e in sorted(spans):
        if out and s <= out[-1]["e"]:
            out[-1]["e"] = max(e, out[-1]["e"])
        else:
            out.append({"s": s, "e": e})
    return out


def _occurrences(shared, texts: list[bytes]) -> tuple[list[int], dict[int, list], dict[int, set]]:
    """Words of each text; by text, the spans found and the names of their items."""
    numbers, tables = unpacked(shared)
    parts = [np.zeros(0, np.int64)]
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter(map(numbers.get, words, repeat(0)), np.int64, len(words)))
    counts = [len(p) for p in parts[1:]]
    ends = np.cumsum(counts, dtype=np.int64)
    starts = ends - np.array(counts, np.int64)
    stream = np.concatenate(parts)
    spans: dict[int, list] = {}
    names: dict[int, set] = {}
    for table in tables:
        at, which = table.search(stream, starts, ends)
        doc = np.searchsorted(ends, at, side="right")
        for d, a, w in zip(doc.tolist(), (at - starts[doc]).tolist(), which.tolist()):
            spans.setdefault(d, []).append((a, a + table.width))
            names.setdefault(d, set()).update(table.owners[w])
    return counts, spans, names


def _scanner(shared, last: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans, items = columns_of(batch, "doc_id", "text", "spans", "items")
            counts, found, names = _occurrences(shared, texts)
            for d, more in found.items():
                spans[d] = _merged([(x["s"], x["e"]) for x in spans[d]] + more)
                items[d] = sorted({*items[d], *names[d]})
            yield record_batch(_HITS_ARROW, ids, [None] * len(ids) if last else texts, counts, spans, items)

    return scan


def _dropper(shared):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            _, found, _ = _occurrences(shared, texts)
            yield batch.filter(pa.array([d not in found for d in range(len(texts))], pa.bool_()))

    return drop


def _searches(benchmark: DataFrame, width: int):
    """Broadcast search tables of the whole benchmark, in pieces of bounded size."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), utf8("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    pieces = math.ceil(total / BLOCK_BYTES) or 1
    for piece in range(pieces):
        own = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(pieces)) == piece).collect()
        tables = compile_patterns([(r["name"], bytes(r["text"])) for r in own], width)
        yield shipped(benchmark.sparkSession, tables)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of `docs`.

    A word inside any occurrence of a test string is hit. Null and empty texts have no words. Rows
    with null or repeated ids are judged by themselves. An item without an id hits like any other
    and is named "null"; items that share an id count as one. An empty benchmark hits nothing.
    Columns besides `doc_id`, `text` and `item_id` are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"),
        F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"))
    passes = list(_searches(benchmark, width))
    for number, shared in enumerate(passes, 1):
        rows = rows.mapInArrow(_scanner(shared, number == len(passes)), _HITS)
        if number < len(passes):
            rows = rows.drop("n_words")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of `docs`, with all their columns, whose `text` holds no test string."""
    bounded_batches(docs.sparkSession)
    for shared in _searches(benchmark, width):
        docs = docs.mapInArrow(_dropper(shared), docs.schema)
    return docs
