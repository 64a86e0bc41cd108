"""Alignment of two tokenizers over a corpus: which tokens of one stand for which of the other.

Both tokenizers cut the same bytes. Where both cut, a group ends; all pairs of an A and a B token
in one group are links. How strongly two ids belong together is the number of documents that link them.

Most groups hold one token of each, with the same bytes. For these an array made once tells the B
id of every A id, and their documents are counted in a vector as long as the vocabulary. Only the
pairs of irregular groups are shuffled, and these only once for a chunk of documents: a task numbers
the chunk's different pairs, counts its documents, and keeps each document's pairs as numbers. The
sums of all chunks come back to the chunk as an array, from which the documents read their counts.

A text is cut into units before blanks that follow no blank and precede no white space. Neither
tokenizer has a token across such a place (checked for the vocabularies at hand when a task
starts), so groups never span two units, and a unit that was aligned once need not be again.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, by_key, columns_of, partitions_for, utf8
from ticketloom.session import materialise

# A chunk ends when its documents have so many pairs, each counted once a document.
CHUNK_PAIRS = 1 << 19
# So many units at most are remembered in a task, and about so many of their pairs.
CACHED, CACHED_PAIRS = 300_000, 1 << 22
RUN = 100_000  # characters of units that are encoded as one text
TOGETHER = 1 << 20  # characters of texts that are aligned in one step
# Pairs in more chunks than one in HOT of all rows are looked up by broadcast: at most HOT pairs.
HOT = 100_000
_BLANK_RUN = re.compile(r" \s")
_BLANK = re.compile(r"(?<! ) (?=\S)")
_PIECE_SPACE = "▁"


def _byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def byte_level_entries(content: bytes) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    spec = json.loads(content)
    if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
        raise ValueError("the first tokenizer must be byte-level and leave the text as it is")
    letters = _byte_letters()
    vocabulary = spec["model"]["vocab"]
    out = [b""] * (1 + max(*vocabulary.values(), *(t["id"] for t in spec["added_tokens"]), 0))
    for entry, number in vocabulary.items():
        out[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    return out


def piece_entries(model) -> list[bytes]:
    """The bytes of every id of a piece vocabulary with byte fallback; control pieces have none."""
    out = []
    for number in range(model.vocab_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(number) or model.is_unknown(number):
            out.append(b"")
        else:
            if _PIECE_SPACE in piece.lstrip(_PIECE_SPACE):
                raise ValueError(f"the piece {piece!r} spans a blank")
            out.append(piece.replace(_PIECE_SPACE, " ").encode())
    return out


def identity_map(first: list[bytes], second: list[bytes]) -> np.ndarray:
    """For every A id the B id with the same bytes, -1 if there is none; of several the largest,
    which is a piece where a single byte has a fallback id too."""
    by_bytes = {entry: number for number, entry in enumerate(second) if entry}
    return np.array([by_bytes.get(entry, -1) if entry else -1 for entry in first], np.int64)


def _odd(unit: str) -> bool:
    """Whether the unit must be encoded by itself: blanks at its end or white space at its beginning."""
    return unit[-1].isspace() or unit[1].isspace()


class Aligner:
    """Aligns whole texts; both libraries are loaded from files' contents in the task.

    Units that are known keep their figures (A tokens, B tokens, groups), the pairs of their links
    as numbers A id * width + B id, and their groups as text.
    """

    def __init__(self, first: bytes, second: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(first.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.first, self.second = byte_level_entries(first), piece_entries(self.b)
        self.width = len(self.second)
        self.same = identity_map(self.first, self.second)
        self.lengths = [np.array(list(map(len, x)), np.int64) for x in (self.first, self.second)]
        names = [str(i).encode() for i in range(max(len(self.first), self.width))]
        self.name_lengths = np.array(list(map(len, names)))
        self.names = np.zeros((len(names), int(self.name_lengths.max()) + 1), np.uint8)
        for at, name in enumerate(names):
            self.names[at, : len(name)] = list(name)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.figures = np.zeros((0, 3), np.int64)
        self.begin, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)

    def _learn(self, units: list[str]) -> None:
        """Add units that are not known. Those that may stand side by side are encoded as one text."""
        runs, size = [[]], 0
        for unit in units:
            if _odd(unit):
                runs.insert(0, [unit])
                continue
            size += len(unit)
            if size > RUN:
                runs.append([])
                size = len(unit)
            runs[-1].append(unit)
        runs = [r for r in runs if r]
        texts = ["".join(r) for r in runs]  # all begin with a blank, which B adds itself
        found = zip(runs, texts, self.a.encode_batch_fast(texts, add_special_tokens=False),
                    self.b.encode([t[1:] for t in texts], num_threads=1))
        parts = []
        for run, text, a, b in found:
            parts += self._aligned(run, text.encode(), a.ids, b)
        figures, pairs, links, fits = zip(*parts)
        self.figures = np.concatenate([self.figures, *figures])
        self.begin = np.concatenate([self.begin, *(len(self.pairs) + np.cumsum([0, *np.concatenate(links)])[:-1],)])
        self.links = np.concatenate([self.links, *links])
        self.pairs = np.concatenate([self.pairs, *pairs])
        self.fits = np.concatenate([self.fits, *fits])

    def _aligned(self, run: list[str], whole: bytes, a: list[int], b: list[int]) -> list[tuple]:
        """(figures, pairs, links of each unit, whether it fits) of units that follow each other."""
        if b"".join([self.second[x] for x in b]) != whole or b"".join([self.first[x] for x in a]) != whole:
            if len(run) > 1:  # find the units at fault
                out = []
                for unit in run:
                    ids = self.a.encode(unit, add_special_tokens=False).ids
                    out += self._aligned([unit], unit.encode(), ids, self.b.encode(unit[1:]))
                return out
            self._name(run, [""])
            return [(np.zeros((1, 3), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(1, bool))]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(of_a), np.bincount(of_b)
        begin_a, begin_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # every A token with every B token of its group
        many = n_b[of_a]
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin_b[of_a], many)
        pairs = np.repeat(a, many) * self.width + b[place]
        ends = np.cumsum([len(u.encode()) for u in run])
        unit = np.searchsorted(ends, cuts)
        figures = np.stack([np.bincount(unit, x, len(run)) for x in (n_a, n_b, np.ones(len(cuts)))], 1).astype(np.int64)
        links = np.bincount(unit, n_a * n_b, len(run)).astype(np.int64)
        # ids in the order of the text form, each followed by its separator
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        at_a, at_b = np.arange(len(a)) + begin_b[of_a], np.arange(len(b)) + (begin_a + n_a)[of_b]
        ids[at_a], ids[at_b] = a, b
        after[at_a[begin_a + n_a - 1]], after[at_b[begin_b + n_b - 1]] = ord("|"), ord(";")
        size = self.name_lengths[ids]
        table = self.names[ids]
        table[np.arange(len(ids)), size] = after
        form = table[np.arange(table.shape[1]) <= size[:, None]].tobytes().decode()
        ends = np.cumsum(size + 1)[np.cumsum(figures[:, 0] + figures[:, 1]) - 1]
        self._name(run, [form[i : j - 1] for i, j in zip([0, *ends.tolist()], ends.tolist())])
        return [(figures, pairs, links, np.ones(len(run), bool))]

    def _name(self, run: list[str], groups: list[str]) -> None:
        self.known.update(zip(run, range(len(self.known), len(self.known) + len(run))))
        self.groups += groups

    def aligned(self, texts: list[str]) -> list[Aligned]:
        """One by one; texts that together are long are better passed in several calls."""
        named = [_units(t) for t in texts]
        new = [u for u in dict.fromkeys(u for units in named for u in units) if u not in self.known]
        if len(self.known) + len(new) > CACHED or len(self.pairs) > CACHED_PAIRS:
            self._forget()
            new = list(dict.fromkeys(u for units in named for u in units))
        if new:
            self._learn(new)
        return [Aligned(self, units) for units in named]


def _units(text: str) -> list[str]:
    """The units of a text, in order; they begin with a blank."""
    if not text:
        return []
    if _BLANK_RUN.search(text) or text[-1] == " " or text[0].isspace():
        parts = _BLANK.split(" " + text)
        return [" " + p for p in parts[1:]] if not parts[0] else [parts[0], *(" " + p for p in parts[1:])]
    return [" " + p for p in text.split(" ")]


class Aligned:
    """One document: its figures, and its different pairs with the number of links of each."""

    __slots__ = ("figures", "digest", "keys", "times")

    def __init__(self, aligner: Aligner, names: list[str]) -> None:
        self.digest = ""
        self.keys = self.times = np.zeros(0, np.int64)
        self.figures = (0, 0, 0, 0)
        units = [aligner.known[n] for n in names]
        if not units or not aligner.fits[units].all():
            return
        links = aligner.links[units]
        total = int(links.sum())
        place = np.arange(total) + np.repeat(aligner.begin[units] - np.cumsum(links) + links, links)
        self.keys, self.times = np.unique(aligner.pairs[place], return_counts=True)
        self.figures = (*aligner.figures[units].sum(axis=0).tolist(), total)
        self.digest = hashlib.sha256(";".join([aligner.groups[u] for u in units]).encode()).hexdigest()


# One row a chunk with all its documents; `keys` are its irregular pairs and `docs` their documents.
# `pairs` and `same` are numbers of a chunk's pairs and A ids, `cuts` say where a document's begin.
_CHUNK = """chunk long, keys binary, docs binary, doc_ids array<long>, figures binary, digests array<string>,
    pairs binary, pair_times binary, pair_cuts binary, same binary, same_times binary, same_cuts binary,
    vector_ids binary, vector binary"""
_BINARIES = ("figures", "pairs", "pair_times", "pair_cuts", "same", "same_times", "same_cuts", "vector_ids", "vector")
_CHUNK_ARROW = pa.schema([
    ("chunk", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("figures", pa.binary()), ("digests", pa.list_(pa.string())),
    *((c, pa.binary()) for c in _BINARIES[1:])])


def _cuts(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, parts)], dtype=np.int64)


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


class _Chunk:
    """Documents that are collected until they hold CHUNK_PAIRS pairs."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner, self.rows, self.size = aligner, [], 0

    def add(self, doc_id: int | None, found: Aligned) -> None:
        self.rows.append((doc_id, found))
        self.size += len(found.keys) + 16

    def batch(self, number: int, vector: np.ndarray) -> pa.RecordBatch:
        """Adds the pairs of equal bytes to `vector` and gives everything else as one row."""
        width = self.aligner.width
        other, other_times, same, same_times = [], [], [], []
        for _, found in self.rows:
            a, b = np.divmod(found.keys, width)
            alike = self.aligner.same[a] == b
            same.append(a[alike])
            same_times.append(found.times[alike])
            other.append(found.keys[~alike])
            other_times.append(found.times[~alike])
            vector[a[alike]] += 1  # a document's pairs are different, so no id comes twice
        keys, at, docs = np.unique(_joined(other, np.int64), return_inverse=True, return_counts=True)
        columns = {
            "chunk": [number], "keys": [keys.tobytes()], "docs": [docs.astype(np.int64).tobytes()],
            "doc_ids": [[d for d, _ in self.rows]],
            "figures": [np.array([f.figures for _, f in self.rows], np.int64).tobytes()],
            "digests": [[f.digest for _, f in self.rows]],
            "pairs": [at.astype(np.int32).tobytes()], "pair_times": [_joined(other_times, np.int32).tobytes()],
            "pair_cuts": [_cuts(other).tobytes()], "same": [_joined(same, np.int32).tobytes()],
            "same_times": [_joined(same_times, np.int32).tobytes()], "same_cuts": [_cuts(same).tobytes()],
            "vector_ids": [b""], "vector": [b""]}
        return pa.RecordBatch.from_pydict(columns, _CHUNK_ARROW)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
    """Documents in lists of about TOGETHER characters, or one longer document."""
    held, size = [], 0
    for batch in batches:
        for doc_id, text in zip(*columns_of(batch, "doc_id", "text")):
            text = text.decode("utf-8", "replace")
            if held and size + len(text) > TOGETHER:
                yield held
                held, size = [], 0
            held.append((doc_id, text))
            size += len(text)
    if held:
        yield held


def _aligner(first, second):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first.value, second.value)
        vector = np.zeros(len(aligner.first), np.int64)
        chunk, number = _Chunk(aligner), TaskContext.get().partitionId() << 32
        for docs in _together(batches):
            for (doc_id, _), found in zip(docs, aligner.aligned([t for _, t in docs])):
                chunk.add(doc_id, found)
                if chunk.size > CHUNK_PAIRS:
                    yield chunk.batch(number, vector)
                    chunk, number = _Chunk(aligner), number + 1
        if chunk.rows:
            yield chunk.batch(number, vector)
        held = np.flatnonzero(vector)
        last = {"chunk": [None], "vector_ids": [held.tobytes()], "vector": [vector[held].tobytes()]}
        yield pa.RecordBatch.from_pydict(
            {f.name: last.get(f.name, pa.nulls(1, f.type)) for f in _CHUNK_ARROW}, _CHUNK_ARROW)

    return align


def _numbers(*names: str):
    """Rows of (chunk, number, count) out of two binary columns of longs."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, numbers, counts in zip(*columns_of(batch, "chunk", *names)):
                numbers, counts = np.frombuffer(numbers, np.int64), np.frombuffer(counts, np.int64)
                for first in range(0, len(numbers), 1 << 16):
                    part = slice(first, first + (1 << 16))
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array([chunk] * len(numbers[part]), pa.int64()), "number": numbers[part],
                        "docs": counts[part]})

    return unpack


_NUMBERS = "chunk long, number long, docs long"
_RESULT = """doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,
    groups_sha256 string"""
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    ("groups_sha256", pa.string())])


def _per_document(cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[cuts[1:]] - total[cuts[:-1]]


def _finisher(same_docs, best, width: int):
    """Documents of a chunk, whose row comes before its pairs' counts in order of the pair."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, most = same_docs.value, best.value
        for table in by_key(batches, "chunk"):
            for chunk in table.filter(table["number"].is_null()).to_pylist():
                answers = table.filter(pc.and_(pc.equal(table["chunk"], chunk["chunk"]), pc.is_valid(table["number"])))
                numbers, docs = answers["number"].to_numpy(), answers["docs"].to_numpy()
                x = {c: np.frombuffer(chunk[c], np.int64 if c == "figures" or c.endswith("cuts") else np.int32)
                     for c in _BINARIES[:-2]}
                figures = x["figures"].reshape(-1, 4)
                leads = docs == most[numbers // width]
                same, times = x["same"], x["same_times"].astype(np.int64)
                pairs, pair_times = x["pairs"], x["pair_times"].astype(np.int64)
                total = _per_document(x["same_cuts"], times * counted[same]) + _per_document(
                    x["pair_cuts"], pair_times * docs[pairs])
                top = _per_document(x["same_cuts"], times * (counted[same] == most[same])) + _per_document(
                    x["pair_cuts"], pair_times * leads[pairs])
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk["doc_ids"], pa.int64()), *(pa.array(figures[:, i]) for i in range(4)),
                    pa.array(top), pa.array(total), pa.array(chunk["digests"], pa.string())], schema=_RESULT_ARROW)

    return finish


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """(number, docs) rows as an array; there are no more rows than vocabulary entries."""
    out = np.zeros(size, np.int64)
    found = rows.toArrow()
    out[found["number"].to_numpy()] = found["docs"].to_numpy()
    return out


def _answers(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, number, docs): every chunk's pairs with their counts over all chunks.

    A pair that occurs in many chunks is looked up where it is; there are at most HOT such pairs, as
    each has more than one in HOT of all rows. The others are joined.
    """
    limit = F.lit(counts.agg(F.sum("chunks")).first()[0] or 0) / HOT
    known = counts.select(F.col("number").alias("pair"), "docs", "chunks")
    hot = F.broadcast(known.where(F.col("chunks") > limit).select("pair", "docs"))
    cold = known.where(F.col("chunks") <= limit).select(F.col("pair").alias("other"), F.col("docs").alias("found"))
    first = asked.join(hot, F.col("number") == F.col("pair"), "left").select("chunk", "number", "docs")
    rest = first.where("docs is null").join(cold, F.col("number") == F.col("other"))
    return first.where("docs is not null").union(rest.select("chunk", "number", F.col("found").alias("docs")))


def token_alignment(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of `docs`.

    A is a byte-level tokenizer of the `tokenizers` library and encodes a blank and the text, B a
    piece model with byte fallback that adds the blank itself; names of special tokens in texts are plain
    text. n_best counts the links of pairs that no other pair of their A id exceeds in documents,
    count_sum adds up the links' documents. Texts that are null or empty, or that B does not give
    back (it turns U+2581 into a blank), have zeros and an empty string. Very long texts are aligned
    whole, unit by unit. Rows with null or repeated ids are documents of their own. An empty table
    gives no rows. Columns besides `doc_id` and `text` are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    contents = []
    for path in (first_path, second_path):  # a few MB each, whatever the corpus
        with open(path, "rb") as file:
            contents.append(file.read())
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_proto=contents[1]).vocab_size()
    size = len(byte_level_entries(contents[0]))
    shared = [spark.sparkContext.broadcast(c) for c in contents]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    chunks = materialise(rows.mapInArrow(_aligner(*shared), _CHUNK), "aligned")
    own = chunks.where("chunk is null").select("chunk", "vector_ids", "vector")
    same_docs = _vector(own.mapInArrow(_numbers("vector_ids", "vector"), _NUMBERS).groupBy("number").agg(
        F.sum("docs").alias("docs")), size)
    chunks = chunks.where("chunk is not null")
    asked = chunks.select("chunk", "keys", "docs").mapInArrow(_numbers("keys", "docs"), _NUMBERS)
    counts = materialise(asked.groupBy("number").agg(F.sum("docs").alias("docs"), F.count("*").alias("chunks")), "pairs")
    best = np.maximum(same_docs, _vector(counts.groupBy(F.expr(f"number div {width}").alias("number")).agg(
        F.max("docs").alias("docs")), size))
    answers = _answers(asked.select("chunk", "number"), counts)
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in chunks.schema if f.name in _LAST]
    both = answers.select("chunk", "number", "docs", *blank).unionByName(chunks.select(
        "chunk", F.lit(None).cast("long").alias("number"), F.lit(None).cast("long").alias("docs"), *_LAST))
    both = both.repartition(partitions_for(spark), "chunk").sortWithinPartitions("chunk", F.asc_nulls_first("number"))
    finish = _finisher(spark.sparkContext.broadcast(same_docs), spark.sparkContext.broadcast(best), width)
    return both.mapInArrow(finish, _RESULT)


_LAST = ("doc_ids", "digests", *_BINARIES[:-2])
