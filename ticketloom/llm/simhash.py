"""Near-duplicate texts by SimHash, compared bit-sliced.

Fingerprints of equal texts collapse first. Two fingerprints within `radius` bits agree in at
least `blocks - radius` of `blocks` bit ranges, so each distinct fingerprint is dealt out under
every choice of that many ranges, and fingerprints that meet are compared: their bits lie in
vertical planes, one 64-bit word for 64 fingerprints, and carry-save counters add up differing bits
of all 64 at once. Words in which every count is over the radius are abandoned on the way.

A bucket of more than `BUCKET` fingerprints is dealt out again as pairs of sub-buckets, so no task
holds more than two of them. A task returns a spanning forest of the links it found, never all
pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.common import bounded_batches, by_key, fresh_name, partitions_for, record_batch, touched, utf8
from ticketloom.llm.components import components
from ticketloom.llm.shingle_sets import SIMILARITY, band_keys, similar_texts, text_id
from ticketloom.session import materialise

SHINGLE_WORDS = 4
STAGE_WORDS = 5  # words of a shingle in `drop_near_duplicates`
RADIUS = 4
BLOCKS = 6
BUCKET = 4096
SEED = 42
# Buckets up to this size are compared as listed pairs, larger ones as queries against planes.
SMALL = 32
QUERIES = 64
PLANES_A_STEP = 12

_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    tokens = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64)
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, len(hashes), 65536):
        octets = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        slots = octets + (np.arange(8, dtype=np.int64) << 8)
        counts += np.bincount(slots.ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BYTE_BITS).ravel()
    return int(((ones * 2 > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _fingerprinter(words: int):
    """Replaces the last column, the text's bytes, by its fingerprint."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            values = np.array([fingerprint(t, words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(_signed(values))], names=[*batch.schema.names[:-1], "fp"])

    return fingerprints


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, the text's bytes, by its fingerprint and its min-hash fingerprints."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        values = np.array([fingerprint(t, STAGE_WORDS) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(_signed(values)), band_keys(texts)],
            names=[*batch.schema.names[:-1], "fp", "keys"])


def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit b of 64 neighbouring values as one word of plane b."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _within(differ, shape: tuple, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes whose number of set bits over 64 planes is at most `radius` (up to 7).

    differ(b, alive) gives plane b of the differences at the words `alive` still counted. Returns
    the words that are left and, for each, the lanes within the radius.
    """
    alive = np.arange(int(np.prod(shape)))
    one = np.zeros(len(alive), np.uint64)
    two, four, over = one.copy(), one.copy(), one.copy()
    for start in range(0, 64, PLANES_A_STEP):
        planes = range(start, min(start + PLANES_A_STEP, 64))
        for group in itertools.batched(planes, 3):
            x, y, z = [differ(b, alive) for b in group] + [np.uint64(0)] * (3 - len(group))
            half = x ^ y
            carry_two = (x & y) | (half & z)  # carry-save: three planes into a sum and a carry
            total = half ^ z
            carry_one = one & total
            one = one ^ total
            half = two ^ carry_two
            carry_four = (two & carry_two) | (half & carry_one)
            two = half ^ carry_one
            over = over | (four & carry_four)
            four = four ^ carry_four
        beyond = over | _above(one, two, four, radius)
        left = ~beyond != 0
        if not left.all():
            alive, one, two, four, over = (v[left] for v in (alive, one, two, four, over))
            beyond = beyond[left]
        if not len(alive):
            break
    return alive, ~(over | _above(one, two, four, radius))


def _above(one, two, four, radius: int) -> np.ndarray:
    """Lanes whose three-bit count is over the radius."""
    above = np.zeros_like(one)
    equal = ~above
    for bit, plane in ((4, four), (2, two), (1, one)):
        if radius & bit:
            equal = equal & plane
        else:
            above = above | (equal & plane)
            equal = equal & ~plane
    return above


class _Forest:
    """Union-find over the fingerprints a task has seen linked."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = list(self.parent)
        return nodes, [self.find(x) for x in nodes]


def _link_listed(values: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, forest: _Forest) -> None:
    for at in range(0, len(left), 1 << 18):
        i, j = left[at : at + (1 << 18)], right[at : at + (1 << 18)]
        planes = _planes(values[i] ^ values[j])
        words, lanes = _within(lambda b, alive: planes[b, alive], (planes.shape[1],), radius)
        if len(words):
            flags = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = flags.nonzero()
            found = words[row] * 64 + bit
            found = found[found < len(i)]
            for x, y in zip(values[i[found]].tolist(), values[j[found]].tolist()):
                forest.link(x, y)


def _link_block(base: np.ndarray, queries: np.ndarray, radius: int, forest: _Forest) -> None:
    """Links of every query to the base, over the planes of the base."""
    planes = _planes(base)
    width = planes.shape[1]
    label = np.arange(len(base))
    for at in range(0, len(queries), QUERIES):
        some = queries[at : at + QUERIES]
        masks = np.where((some[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), ~np.uint64(0), np.uint64(0))

        def differ(b, alive, masks=masks):
            query, word = np.divmod(alive, width)
            return planes[b, word] ^ masks[query, b]

        words, lanes = _within(differ, (len(some), width), radius)
        if not len(words):
            continue
        flags = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = flags.nonzero()
        query, word = np.divmod(words[row], width)
        lane = word * 64 + bit
        real = lane < len(base)
        query, lane = query[real], lane[real]
        for q in np.unique(query).tolist():
            near = lane[query == q]
            labels = np.unique(label[near])
            for x in labels[1:].tolist():
                forest.link(int(base[labels[0]]), int(base[x]))
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]
            forest.link(int(some[q]), int(base[labels[0]]))


def _linker(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            values = table["fp"].to_numpy().astype(np.int64).view(np.uint64)
            side = table["side"].to_numpy()
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            sizes = np.diff(np.r_[starts, len(bucket)])
            split = np.maximum.reduceat(side, starts) > 0
            forest = _Forest()
            small = (sizes <= SMALL) & ~split
            for step in range(1, int(sizes[small].max(initial=0))):
                s, n = starts[small & (sizes > step)], sizes[small & (sizes > step)] - step
                left = np.repeat(s - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                _link_listed(values, left, left + step, radius, forest)
            for s, n, two in zip(starts[~small].tolist(), sizes[~small].tolist(), split[~small].tolist()):
                own, mine = values[s : s + n], side[s : s + n]
                base, queries = (own[mine == 1], own[mine == 2]) if two else (own, own)
                if len(base) and len(queries):
                    _link_block(base, queries, radius, forest)
            a, b = forest.edges()
            yield record_batch(_LINK, _signed(np.array(a, np.uint64)), _signed(np.array(b, np.uint64)))

    return link


def _dealt(fingerprints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(key, fp): every fingerprint once for each choice of blocks - radius bit ranges."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    ranges = [sum(1 << b for b in range(lo, hi)) for lo, hi in itertools.pairwise(edges)]
    keys = []
    for number, chosen in enumerate(itertools.combinations(ranges, blocks - radius)):
        mask = sum(chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask))))
    return fingerprints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def near_links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp`, enough to connect all within `radius` bits.

    Exact: two fingerprints within the radius share a bucket. More blocks make smaller buckets and
    more copies of each fingerprint.
    """
    spark = fingerprints.sparkSession
    bounded_batches(spark)
    dealt = _dealt(fingerprints, radius, blocks)
    hot = dealt.groupBy("key").count().where(F.col("count") > BUCKET).select(
        "key", F.ceil(F.col("count") / BUCKET).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.xxhash64("key", F.least(o, own), F.greatest(o, own)).alias("bucket"),
        F.when(o == own, F.lit(0)).when(own < o, F.lit(1)).otherwise(F.lit(2)).cast("byte").alias("side")))
    alone = F.array(F.struct(F.col("key").alias("bucket"), F.lit(0).cast("byte").alias("side")))
    rows = dealt.join(hot, "key", "left").select(
        "fp", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(others)).alias("to"))
    rows = rows.select(F.col("to.bucket").alias("bucket"), "fp", F.col("to.side").alias("side"))
    rows = rows.repartition(partitions_for(spark), "bucket").sortWithinPartitions("bucket", "fp")
    return rows.mapInArrow(_linker(radius), "a long, b long")


def _named(classes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fp, first): the smallest `first` of each fingerprint's component, from (fp, first)."""
    roots = components(near_links(classes.select("fp"), radius, blocks))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("smallest"))
    return materialise(rooted.join(smallest, "root").select("fp", F.col("smallest").alias("first")), "components")


def simhash(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            radius: int = RADIUS, blocks: int = BLOCKS, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of `docs`.

    component_id is the smallest id whose fingerprint can be reached over links of at most `radius`
    bits. A null or empty text has fingerprint zero and is linked like any other. A null id keeps
    its row and its links and never becomes a component's id; a component of null ids only has a
    null id. Repeated ids keep their rows. Other columns are not read. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("row_id"), utf8(text_column).alias("text"))
    rows = materialise(rows.mapInArrow(_fingerprinter(words), "row_id long, fp long"), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("row_id").alias("first")), "classes")
    return rows.join(_named(classes, radius, blocks), "fp", "left").select(
        F.col("row_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of `docs`, with all its columns, for each group of similar texts.

    Texts are linked if their SimHash fingerprints over five-word shingles (A-Z in lower case, repeats
    included) differ in at most `RADIUS` bits, found as in `simhash`. Few pairs at `similarity` are
    that close, so those are linked as well whose sets of shingles have a Jaccard similarity of at
    least `similarity`, verified for every pair of unlinked texts that shares one of the fingerprints
    of `shingle_sets`. A group is what the links connect. The row with the smallest `doc_id` stays,
    null ids last; of rows with equal ids the first by a digest of all columns, and of equal rows
    one. Texts of fewer than five words are one shingle, texts without words one group.
    """
    bounded_batches(docs.sparkSession)
    name = fresh_name(docs, "place")
    place = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
        F.md5(F.to_json(F.struct("*")).cast("binary")).alias("digest"))
    rows = docs.select(place.alias("place"), utf8("text").alias("text")).select(
        "place", *text_id("text"), F.octet_length("text").cast("long").alias("size"), "text")
    kinds = T.StructType([
        *rows.schema.fields[:-1], T.StructField("fp", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    rows = materialise(rows.mapInArrow(_marked, kinds), "fingerprints")
    classes = materialise(rows.groupBy("h", "g").agg(
        F.min("place").alias("first"), F.first("size").alias("size"), F.first("fp").alias("fp"),
        F.first("keys").alias("keys")), "classes")
    prints = materialise(classes.groupBy("fp").agg(F.min(F.struct("h", "g")).alias("first")), "prints")
    linked = _named(prints, RADIUS, BLOCKS).withColumnRenamed("first", "root")
    near = classes.join(linked, "fp").select(F.struct("h", "g").alias("node"), "root").where("node <> root")
    texts = docs.select(utf8("text").alias("text")).select(*text_id("text"), "text")
    roots = similar_texts(texts, classes, materialise(near, "near"), similarity).select("node.h", "node.g", "root")
    rooted = classes.join(roots, ["h", "g"], "left").select(
        "h", "g", F.col("first").alias("own"), F.coalesce("root", F.struct("h", "g")).alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("own").alias("first"))
    named = materialise(rooted.join(smallest, "root").select("h", "g", "first"), "components")
    judged = materialise(
        rows.join(named, ["h", "g"]).select("place", (F.col("place") == F.col("first")).alias("kept")), "judged")
    dropped = judged.where("not kept").select("place").distinct()
    placed = docs.withColumn(name, place)
    maybe, sure = touched(placed, dropped.withColumnRenamed("place", name), name)
    left = sure.unionByName(maybe.join(dropped.withColumnRenamed("place", name), name, "left_anti"))
    if not judged.where("kept").groupBy("place").count().where("count > 1").isEmpty():
        left = left.dropDuplicates([name])
    return left.select(*docs.columns)
