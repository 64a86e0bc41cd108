"""Texts whose sets of five-word shingles are similar, by min-hash bands and exact verification.

These are the near copies beyond SimHash's radius, whose links `simhash.py` finds first and hands
over. Each text has `BANDS` independent fingerprints of `ROWS` min-hashes. Two texts of similarity s
share at least one with chance 1 - (1 - s^ROWS)^BANDS, 0.9996 at 0.8; a test measures it. A 64-bit
SimHash does not separate at 0.8: such pairs differ in about 10 bits with a wide spread, and bit
ranges that allow for 16 or more are too short to deal by. Texts that share a fingerprint are
verified: the Jaccard similarity of their whole shingle sets, by 64-bit hashes.

Bands are taken in rounds. A bucket whose texts are all linked already has nothing to add and is
not verified again, so a family of copies is moved in the first bands only. A bucket over its limit
is dealt out as pairs of sub-buckets, so that every two of its texts meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import by_key, partitions_for, touched
from ticketloom.llm.components import components
from ticketloom.llm.passages import mixed, shingles
from ticketloom.session import materialise

SIMILARITY = 0.8
BANDS = 20
ROWS = 5
ROUNDS = (2, 8, BANDS)  # bands done after each round
# A bucket over either is dealt out again.
BUCKET = 1000
BUCKET_BYTES = 8 << 20
_STEP = 2048

_FACTORS = np.array([xxhash.xxh64_intdigest(bytes([k]), 17) | 1 for k in range(BANDS * ROWS)], np.uint64)
_SALT = np.uint64(0x9E3779B97F4A7C15)

Id = tuple[int, int]


def shingle_set(text: bytes) -> np.ndarray:
    """Distinct hashes of the text's five-word shingles in order; a shorter text is one shingle."""
    own = shingles([text])[0]
    if not len(own):
        own = np.array([xxhash.xxh64_intdigest(b" ".join(text.lower().split()), 17)], np.uint64)
    return np.unique(own)


def bands(own: np.ndarray) -> np.ndarray:
    """The fingerprints of a shingle set."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), _STEP):
        np.minimum(least, (own[at : at + _STEP, None] * _FACTORS).min(axis=0), out=least)
    out = np.arange(BANDS, dtype=np.uint64) * _SALT
    for row in least.reshape(BANDS, ROWS).T:
        out = mixed(out ^ row) * _SALT
    return out


def band_keys(texts: list[bytes]) -> pa.ListArray:
    """The fingerprints of each text's shingle set."""
    values = np.concatenate([bands(shingle_set(t)) for t in texts] or [np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * BANDS, pa.int32()), pa.array(values))


def text_id(text: str) -> list[Column]:
    """128 bits that name a text, as two numbers."""
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit("text"), text).alias("g")]


def _link_group(ids: list[Id], roots: list[Id], sides: list[int], texts: list[bytes], similarity: float) -> list[tuple]:
    """(id, id) of verified pairs, enough to connect all that are similar and not connected yet."""
    sets = [shingle_set(t) for t in texts]
    sizes = np.array([len(s) for s in sets])
    side = np.array(sides)
    names = {r: n for n, r in enumerate(dict.fromkeys(roots))}
    label = np.array([names[r] for r in roots])
    found = []
    for x in range(len(ids) - 1):
        can = (label != label[x]) & (np.arange(len(ids)) > x)
        can &= np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x]) - 1e-9
        if side[x]:
            can &= side != side[x]
        others = np.flatnonzero(can)
        if not len(others):
            continue
        flat = np.concatenate([sets[i] for i in others.tolist()])
        own = sets[x]
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        starts = np.r_[0, np.cumsum(sizes[others])[:-1]]
        shared = np.add.reduceat(hit.astype(np.int64), starts)
        near = shared >= similarity * (sizes[others] + sizes[x] - shared) - 1e-9
        for y in others[near].tolist():
            if label[y] != label[x]:
                found.append((*ids[x], *ids[y]))
                label[label == label[y]] = label[x]
    return found


def _verifier(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            ids = list(zip(table["h"].to_pylist(), table["g"].to_pylist()))
            roots = list(zip(table["rh"].to_pylist(), table["rg"].to_pylist()))
            side, texts = table["side"].to_pylist(), table["text"]
            starts, found = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist(), []
            for s, e in zip(starts, [*starts[1:], len(bucket)]):
                if e - s > 1:
                    found += _link_group(ids[s:e], roots[s:e], side[s:e], texts[s:e].to_pylist(), similarity)
            yield pa.RecordBatch.from_pydict({
                c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(("ah", "ag", "bh", "bg"))})

    return verify


def _round(texts: DataFrame, classes: DataFrame, roots: DataFrame, first: int, last: int, similarity: float) -> DataFrame:
    """(a, b): links that bands first to last add to those of `roots`."""
    spark = texts.sparkSession
    known = roots.select("node.h", "node.g", F.col("root").alias("known"))
    rooted = classes.join(known, ["h", "g"], "left").withColumn("root", F.coalesce("known", F.struct("h", "g")))
    probes = rooted.select("h", "g", "size", "root", F.explode(F.slice("keys", first + 1, last - first)).alias("key"))
    open_ = probes.groupBy("key").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.min("root").alias("low"), F.max("root").alias("high"))
    parts = F.greatest(F.ceil(F.col("rows") / BUCKET), F.ceil(F.col("bytes") / BUCKET_BYTES))
    open_ = open_.where("low < high").select("key", F.least(parts, F.col("rows")).cast("int").alias("parts"))
    met = materialise(probes.join(open_, "key").select("key", "h", "g", "root", "parts"), "met")
    own = F.pmod(F.xxhash64(F.lit("part"), "h"), F.col("parts")).cast("int")
    homes = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.xxhash64("key", F.least(o, own), F.greatest(o, own)).alias("bucket"),
        F.when(o == own, F.lit(0)).when(own < o, F.lit(1)).otherwise(F.lit(2)).cast("byte").alias("side")))
    moved = touched(texts, met, "h", "g")[0].groupBy("h", "g").agg(F.first("text").alias("text"))
    rows = met.join(moved, ["h", "g"]).select(
        "h", "g", F.col("root.h").alias("rh"), F.col("root.g").alias("rg"), "text", F.inline(homes))
    rows = rows.repartition(partitions_for(spark), "bucket").sortWithinPartitions("bucket", "h", "g")
    linked = rows.mapInArrow(_verifier(similarity), "ah long, ag long, bh long, bg long")
    return linked.select(
        F.struct(F.col("ah").alias("h"), F.col("ag").alias("g")).alias("a"),
        F.struct(F.col("bh").alias("h"), F.col("bg").alias("g")).alias("b"))


def similar_texts(texts: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root): components of the texts (h, g) linked by at least the similarity; see `components`.

    `texts` has (h, g, text) and `classes` one row (h, g, size in bytes, keys) for each distinct text.
    `roots` (node, root) are links that hold already, as those of SimHash.
    """
    first = 0
    for last in ROUNDS:
        links = _round(texts, classes, roots, first, last, similarity)
        links = links.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots, first = materialise(components(links), "roots"), last
    return roots
