"""Quality rules: counts on words and lines, and bands on the perplexity of n-gram models.

Both are interpolated modified Kneser-Ney models. One is of order 6 over the bytes as they are: no
two are taken together, its contexts reach over word borders, and it grows with the corpus, by the
distinct sequences of six bytes. The other, of order 4 over 64 classes of bytes, judges shapes. Tasks
count the n-grams of their texts, Spark adds the counts up and derives discounts, back-off weights
and probabilities by joins, and the result is a pair of sorted arrays for each order: packed n-grams,
which are a hash without collisions, and logarithms.

The models serve all languages; each language has its own lower and upper bands, from the quartiles
of its documents that pass the plain rules. A document has to lie inside both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticketloom.llm.common import bounded_batches, fresh_name, shipped, unpacked, utf8
from ticketloom.session import materialise, together

ORDER = 4
BITS = 6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Documents further from a quartile than this many interquartile ranges are outside the band.
FENCE = 2.5
# Perplexities are binned so finely for the quartiles; it bounds the number of bins.
BIN = 0.001
_GRAMS_HELD = 1 << 21
# Texts whose n-grams are at hand at once: so many, and so many bytes or one longer text.
_TEXTS, _TEXT_BYTES = 256, 1 << 20

_RULES = T.StructType([
    T.StructField(name, T.LongType())
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
] + [T.StructField(name, T.DoubleType()) for name in ("log_perplexity", "byte_log_perplexity")])


def _classes() -> np.ndarray:
    """Class of each byte: white space 0, letters by themselves, the rest in a few groups."""
    table = np.full(256, 63, np.uint8)  # control characters
    table[[32, *range(9, 14)]] = 0
    for b in range(33, 127):
        c = chr(b)
        if c.islower():
            table[b] = 1 + b - ord("a")
        elif c.isupper():
            table[b] = 27 + b - ord("A")
        elif c.isdigit():
            table[b] = 53
        else:
            table[b] = 54 if c in ".,;:!?'\"()-" else 55
    table[128:] = 56 + np.arange(128) % 7
    return table


_CLASS = _classes()


@dataclass(frozen=True, eq=False)
class Symbols:
    """What a model's n-grams are made of: their length, a symbol's bits, and each byte's symbol."""

    order: int
    bits: int
    of: np.ndarray


CLASSES = Symbols(ORDER, BITS, _CLASS)
BYTES = Symbols(6, 8, np.arange(256, dtype=np.uint8))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated three-word windows."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined)
    if not joined.isascii():
        chars -= int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80))
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 1 << 20:  # renumber, so that the product below fits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, twice)
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(found)] |= found
    return int(inside.sum())


def _grams(texts: list[bytes], symbols: Symbols = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of all texts, each begun by white space, and where each text's end."""
    order = symbols.order
    lead = b" " * (order - 1)
    kind = np.int32 if order * symbols.bits < 32 else np.int64
    stream = symbols.of[np.frombuffer(lead + lead.join(texts), np.uint8)].astype(kind)
    packed = np.zeros(max(0, len(stream) - order + 1), kind)
    for back in range(order):
        at = order - 1 - back
        packed |= stream[at : at + len(packed)] << (symbols.bits * back)
    own = np.ones(len(packed), bool)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    gaps = ends[:-1] + (order - 1) * np.arange(len(texts) - 1)
    for back in range(order - 1):  # n-grams that end in a later text's lead
        own[gaps + back] = False
    return packed[own], ends


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if held and (len(held) == _TEXTS or size + len(text) > _TEXT_BYTES):
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _add_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in held])
    counts = np.concatenate([c for _, c in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def _counter(symbols: Symbols):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for texts in _portions(batch.column("text").to_pylist()):
                packed, _ = _grams(texts, symbols)
                if len(packed):
                    held.append(np.unique(packed, return_counts=True))
                if sum(len(k) for k, _ in held) > _GRAMS_HELD and len(held) > 1:
                    held = [_add_up(held)]
        if held:
            keys, counts = _add_up(held)
            for at in range(0, len(keys), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_pydict({"g": pa.array(keys[part], pa.int64()), "c": pa.array(counts[part])})

    return count


def count_grams(docs: DataFrame, text_column: str = "text", symbols: Symbols = CLASSES) -> DataFrame:
    """(g, c): how often each packed n-gram occurs in all texts."""
    bounded_batches(docs.sparkSession)
    counts = docs.select(utf8(text_column).alias("text")).mapInArrow(_counter(symbols), "g long, c long")
    return counts.groupBy("g").agg(F.sum("c").alias("c"))


def _discounts(adjusted: DataFrame) -> tuple[float, float, float]:
    """Chen and Goodman's discounts for counts of one, two, and three or more."""
    n = [x or 0 for x in adjusted.agg(*[F.sum((F.col("c") == i).cast("long")) for i in (1, 2, 3, 4)]).first()]
    if not all(n):
        return 0.5, 1.0, 1.5  # too little text for counts of counts
    y = n[0] / (n[0] + 2 * n[1])
    found = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1))


class Model:
    """Sorted arrays: for each order n-grams and log probabilities, contexts and log weights."""

    def __init__(self, grams: dict, contexts: dict, symbols: Symbols = CLASSES) -> None:
        self.grams, self.contexts, self.symbols = grams, contexts, symbols

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, values = table
        if not len(own):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        slot = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return values[slot], own[slot] == keys

    def log_probability(self, packed: np.ndarray) -> np.ndarray:
        """Natural logarithm of each n-gram's last symbol after the others, with back-off."""
        out = np.zeros(len(packed))
        todo = np.arange(len(packed))
        bits = self.symbols.bits
        for order in range(self.symbols.order, 0, -1):
            keys = packed[todo].astype(np.int64) & ((1 << (bits * order)) - 1)
            value, known = self._look(self.grams[order], keys)
            out[todo[known]] += value[known]
            todo, keys = todo[~known], keys[~known]
            if not len(todo):
                return out
            weight, known = self._look(self.contexts[order], keys >> bits)
            out[todo] += np.where(known, weight, 0.0)
        out[todo] -= bits * np.log(2)
        return out

    def log_perplexities(self, texts: list[bytes]) -> list[float]:
        """Of a byte of each text. An n-gram is looked up once for all the texts at hand."""
        values = []
        for own in _portions(texts):
            packed, ends = _grams(own, self.symbols)
            distinct, place = np.unique(packed, return_inverse=True)
            logs = self.log_probability(distinct)[place]
            for start, end in zip([0, *ends.tolist()], ends.tolist()):
                values.append(-float(logs[start:end].sum()) / (end - start) if end > start else 0.0)
        return values


def kneser_ney(counts: DataFrame, symbols: Symbols = CLASSES) -> Model:
    """Interpolated modified Kneser-Ney model from n-gram counts (g, c), lower orders included."""
    bits = symbols.bits
    adjusted = {symbols.order: materialise(counts, "grams")}
    for order in range(symbols.order - 1, 0, -1):  # lower orders count distinct predecessors
        mask = (1 << (bits * order)) - 1
        adjusted[order] = materialise(
            adjusted[order + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.count("*").alias("c")),
            "grams")
    grams, contexts = {}, {}
    lower = None
    for order in range(1, symbols.order + 1):
        one, two, more = _discounts(adjusted[order])
        cut = F.when(F.col("c") == 1, one).when(F.col("c") == 2, two).otherwise(more)
        rows = adjusted[order].withColumn("h", F.shiftright("g", bits)).withColumn("cut", cut)
        weights = rows.groupBy("h").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("weight"))
        rows = rows.join(weights, "h")
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / (1 << bits)))
        else:
            mask = (1 << (bits * (order - 1))) - 1
            rows = rows.withColumn("suffix", F.col("g").bitwiseAND(F.lit(mask))).join(
                lower.select(F.col("g").alias("suffix"), F.col("p").alias("below")), "suffix")
        probability = (F.col("c") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("below")
        lower = materialise(rows.select("g", probability.alias("p")), "probabilities")
        grams[order] = _sorted_arrays(lower.select("g", F.ln("p").alias("v")))
        contexts[order] = _sorted_arrays(weights.select(
            F.col("h").alias("g"), F.ln(F.greatest("weight", F.lit(1e-300))).alias("v")))
    return Model(grams, contexts, symbols)


def _sorted_arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most 2^24 rows of classes, by the packing; of bytes, as many as the corpus has sequences."""
    table = rows.toArrow()
    keys = table["g"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    return keys[order], table["v"].to_numpy().astype(np.float64)[order]


def _scorer(shared, schema: pa.Schema):
    """Replaces the last column, the text's bytes, by the counts and the log perplexities."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = unpacked(shared)
        fields = list(schema.field(len(schema) - 1).type)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            rules = [base_counts(t) for t in texts]
            found = pa.StructArray.from_arrays(
                [*(pa.array([r[i] for r in rules], pa.int64()) for i in range(5)),
                 *(pa.array(m.log_perplexities(texts), pa.float64()) for m in models)],
                fields=fields)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], schema=schema)

    return score


def with_rules(docs: DataFrame, models: tuple[Model, Model], columns: list[str], text_column: str, name: str) -> DataFrame:
    """The columns of `docs` and a struct `name`: plain counts, log perplexities of a byte of the text
    by the models of classes and of bytes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(*columns, utf8(text_column).alias(name))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(name, _RULES)])
    return rows.mapInArrow(_scorer(shipped(spark, models), to_arrow_schema(schema)), schema)


def _base_failed(rules: str) -> Column:
    words, repeat = F.col(f"{rules}.n_words"), F.col(f"{rules}.n_repeat_words")
    return (words < MIN_WORDS) | (repeat * 100 > words * MAX_REPEAT_PERCENT)


def language_bands(scored: DataFrame, language: str, rules: str, value: str = "log_perplexity") -> DataFrame:
    """(language, low, high): the log perplexities `value` that a language's documents may have.

    The quartiles are those of all documents that pass the plain rules. Bins of `BIN` bound what
    one language's aggregate holds.
    """
    bins = scored.where(~_base_failed(rules)).groupBy(
        _language(language).alias("language"),
        F.round(F.col(f"{rules}.{value}") / BIN).cast("long").alias("bin")).count()
    quartiles = bins.groupBy("language").agg(
        F.percentile("bin", F.array(F.lit(0.25), F.lit(0.75)), F.col("count")).alias("q"))
    low, high = F.col("q")[0] * BIN, F.col("q")[1] * BIN
    reach = F.greatest(high - low, F.lit(BIN)) * FENCE
    return quartiles.select("language", (low - reach).alias("low"), (high + reach).alias("high"))


def _language(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def judged(docs: DataFrame, columns: list[str], name: str, language: str = "lang", text_column: str = "text") -> DataFrame:
    """The columns of `docs` (with the language) and a struct `name` of counts, `base_failed`, `kept`."""
    models = tuple(together(*[
        lambda s=s: kneser_ney(count_grams(docs, text_column, s), s) for s in (CLASSES, BYTES)]))
    scored = materialise(with_rules(docs, models, columns, text_column, name), "rules")
    key = fresh_name(scored, "language")
    rows, inside = scored.withColumn(key, _language(language)), F.lit(True)
    for value in ("log_perplexity", "byte_log_perplexity"):
        own = fresh_name(rows, "band")
        bands = language_bands(scored, language, name, value).select(
            F.col("language").alias(key), F.struct("low", "high").alias(own))
        rows = rows.join(bands, key, "left")
        inside &= F.coalesce(F.col(f"{name}.{value}").between(F.col(f"{own}.low"), F.col(f"{own}.high")), F.lit(False))
    return rows.select(
        *columns,
        F.col(name).withField("base_failed", _base_failed(name))
        .withField("kept", ~_base_failed(name) & inside).alias(name))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: its counts, `base_failed`, `kept` and the log perplexities by
    the models of classes and of bytes.

    A null or empty text has no words and fails. Null languages are one language of their own.
    Rows with null or repeated ids are judged by themselves; repeated rows count again in the
    model. Columns besides `doc_id`, `lang` and `text` are not read. No rows give no rows.
    """
    return judged(docs, ["doc_id", "lang"], "rules").select(
        "doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
        "rules.n_repeat_words", "rules.base_failed", "rules.kept", "rules.log_perplexity",
        "rules.byte_log_perplexity")


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    name = fresh_name(docs, "rules")
    return judged(docs, docs.columns, name).where(F.col(f"{name}.kept")).drop(name)
