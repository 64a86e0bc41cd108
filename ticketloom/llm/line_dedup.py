"""Near-duplicate lines by a segment-partition edit join.

A line of n bytes is cut into threshold + 1 segments of even length. If two lines are within the
threshold, one segment of the shorter occurs in the longer, near its own place; how near follows
from the number of the segment and the two lengths. So every distinct line is indexed under its
segments and its length, and probes the lengths it can match with the few substrings that can
match. Lines that meet under no key have no partner and their texts are never moved; the others are
verified by banded bit-parallel edit distance, many pairs at a time.

Keys with more than `BUCKET` lines are dealt out as pairs of sub-buckets. Tasks return a spanning
forest of the links they verified, and classes are the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, by_key, fresh_name, partitions_for, touched
from ticketloom.llm.components import components
from ticketloom.session import materialise

THRESHOLD = 2
MIN_BYTES = 25
BUCKET = 2000
# Groups up to this size are verified as listed pairs, larger ones by a search from line to line.
SMALL = 24
CELLS = 1 << 22
_PAD = 256


def edit_distances(left: list[bytes], right: list[bytes], threshold: int) -> np.ndarray:
    """Edit distance in bytes of each pair, or threshold + 1 if it is more.

    Bit k of the words of column j stands for row j - threshold + k, so a band of
    2 * threshold + 1 diagonals is one word (threshold up to 31).
    """
    out = np.full(len(left), threshold + 1, np.int64)
    left, right = list(left), list(right)
    for i, (a, b) in enumerate(zip(left, right)):
        if abs(len(a) - len(b)) <= threshold:
            left[i], right[i] = _core(a, b)
    sizes = np.array([[len(a), len(b)] for a, b in zip(left, right)], np.int64).reshape(-1, 2)
    close = np.flatnonzero(np.abs(sizes[:, 0] - sizes[:, 1]) <= threshold)
    close = close[np.argsort(sizes[close].max(axis=1), kind="stable")]
    at = 0
    while at < len(close):
        longest = np.maximum.accumulate(sizes[close[at:]].max(axis=1)) + 4 * threshold
        fits = np.searchsorted(longest * np.arange(1, len(longest) + 1), CELLS, side="right")
        some = close[at : at + max(1, int(fits))]
        out[some] = _banded([left[i] for i in some.tolist()], [right[i] for i in some.tolist()], threshold)
        at += len(some)
    return out


def _core(a: bytes, b: bytes) -> tuple[bytes, bytes]:
    """Both without their common start and end, which cost no edits."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return a[n:], b[n:]
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    start = int((x[:n] != y[:n]).argmax())
    rest = n - start
    differ = x[len(a) - rest :] != y[len(b) - rest :]
    end = int(differ[::-1].argmax()) if differ.any() else rest
    return a[start : len(a) - end], b[start : len(b) - end]


def _matrix(texts: list[bytes], before: int, width: int) -> np.ndarray:
    out = np.full((len(texts), before + width), _PAD, np.uint16)
    for row, text in enumerate(texts):
        out[row, before : before + len(text)] = np.frombuffer(text, np.uint8)
    return out


def _banded(left: list[bytes], right: list[bytes], threshold: int) -> np.ndarray:
    rows = np.array([len(t) for t in left], np.int64)
    columns = np.array([len(t) for t in right], np.int64)
    band = 2 * threshold + 1
    longest = int(max(rows.max(), columns.max()))
    p = _matrix(left, threshold, longest + band)
    t = _matrix(right, 0, longest)
    t[t == _PAD] = _PAD + 1
    result = np.where(columns == 0, np.minimum(rows, threshold + 1), threshold + 1)
    live = np.arange(len(left))
    full, one = np.uint64((1 << band) - 1), np.uint64(1)
    weights = one << np.arange(band, dtype=np.uint64)
    bottom = np.uint64(band - 1)
    vp = np.full(len(left), sum(1 << k for k in range(threshold, band)), np.uint64)
    vn = np.zeros(len(left), np.uint64)
    score = np.minimum(rows, threshold)
    for j in range(1, longest + 1):
        match = ((p[:, j - 1 : j - 1 + band] == t[:, j - 1 : j]) * weights).sum(axis=1, dtype=np.uint64)
        zero = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(zero | vp)) & full
        hn = zero & vp
        # down the band's last diagonal to the last row, then along that row
        diagonal = j <= rows - threshold
        bit = np.clip(rows - j + threshold, 0, band - 1).astype(np.uint64)
        down = 1 - ((zero >> bottom) & one).astype(np.int64)
        along = ((hp >> bit) & one).astype(np.int64) - ((hn >> bit) & one).astype(np.int64)
        score += np.where(diagonal, down, along)
        zero >>= one
        vp = (hn | ~(zero | hp)) & full
        vn = zero & hp
        ended = columns == j
        result[live[ended]] = np.minimum(score[ended], threshold + 1)
        keep = ~ended
        if j % 16 == 0:
            keep &= score <= 3 * threshold  # a row's end is at most two thresholds below a diagonal
        if not keep.all():
            live, p, t, vp, vn, score, rows, columns = (
                v[keep] for v in (live, p, t, vp, vn, score, rows, columns))
            if not len(live):
                break
    return result


Id = tuple[int, int]


class _Links:
    """Union-find over line ids."""

    def __init__(self) -> None:
        self.parent: dict[Id, Id] = {}

    def find(self, x: Id) -> Id:
        parent = self.parent
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def link(self, x: Id, y: Id) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _link_small(groups: list[tuple], threshold: int, links: _Links) -> None:
    """Verify all pairs of small groups together; a group is (ids, texts, indexed, side)."""
    pairs: dict[tuple[Id, Id], tuple[bytes, bytes]] = {}
    for ids, texts, indexed, side in groups:
        for i in range(len(ids)):
            for j in range(i):
                if (indexed[i] or indexed[j]) and (side[i] != side[j] or not side[i]) and ids[i] != ids[j]:
                    if abs(len(texts[i]) - len(texts[j])) <= threshold:
                        pairs[min(ids[i], ids[j]), max(ids[i], ids[j])] = texts[i], texts[j]
    near = edit_distances([a for a, _ in pairs.values()], [b for _, b in pairs.values()], threshold) <= threshold
    for (x, y), linked in zip(pairs, near.tolist()):
        if linked:
            links.link(x, y)


def _link_large(ids, texts, indexed, side, threshold: int, links: _Links) -> None:
    """Verify a large group breadth first: a line that is linked is not compared again as a target."""
    indexed, side = np.array(indexed), np.array(side)
    sizes = np.array([len(t) for t in texts])
    waiting = np.ones(len(ids), bool)
    for start in range(len(ids)):
        if not waiting[start]:
            continue
        waiting[start] = False
        queue = [start]
        while queue:
            x = queue.pop()
            can = waiting & (np.abs(sizes - sizes[x]) <= threshold) & (indexed | indexed[x])
            if side[x]:
                can &= side != side[x]
            others = np.flatnonzero(can)
            near = edit_distances([texts[x]] * len(others), [texts[i] for i in others.tolist()], threshold) <= threshold
            for y in others[near].tolist():
                links.link(ids[x], ids[y])
                waiting[y] = False
                queue.append(y)


def _verifier(threshold: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            ids = list(zip(table["h"].to_pylist(), table["g"].to_pylist()))
            columns = [ids, *(table[c].to_pylist() for c in ("line", "indexed", "side"))]
            links, small = _Links(), []
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist()
            for s, e in zip(starts, [*starts[1:], len(bucket)]):
                group = [c[s:e] for c in columns]
                if e - s <= SMALL:
                    small.append(group)
                else:
                    _link_large(*group, threshold, links)
            _link_small(small, threshold, links)
            found = [(*x, *links.find(x)) for x in links.parent]
            yield pa.RecordBatch.from_pydict({
                c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(("ah", "ag", "bh", "bg"))})

    return verify


def _segment_keys(line: Column, threshold: int) -> list[tuple[Column, bool]]:
    """(key, indexed): the line's segments, and the substrings that can match a shorter line's segment.

    A key that the line is too short for is null.
    """
    size, parts = F.octet_length(line), threshold + 1
    keys = []
    for less in range(threshold + 1):
        length = size - less
        base = F.floor(length / parts).cast("int")
        longer = length - base * parts  # the last segments are one byte longer
        for number in range(parts):
            start = base * number + F.greatest(F.lit(0), longer - (parts - number)) + 1
            own = base + F.when(longer >= parts - number, 1).otherwise(0)
            low = max(-number, less - (threshold - number))
            high = min(number, less + (threshold - number))
            for shift in range(low, high + 1):
                key = F.xxhash64(F.lit(number), length, F.substring(line, start + shift, own))
                inside = (start + shift >= 1) & (start + shift + own - 1 <= size)
                keys.append((F.when(inside, key), less == 0 and shift == 0))
    return keys


def _lines(docs: DataFrame, min_bytes: int, *columns: Column) -> DataFrame:
    """One row for each line of at least `min_bytes`: the columns, `line_no` and `line` (bytes).

    Whatever is taken of a document is made before its lines, else every line would make it again.
    """
    whole = docs.select(*columns, F.split(F.col("text").cast("string"), "\n").alias("lines"))
    names = whole.columns[:-1]
    every = whole.select(*names, F.posexplode("lines").alias("line_no", "line"))
    return every.withColumn("line", F.col("line").cast("binary")).where(F.octet_length("line") >= min_bytes)


def _line_id() -> list[Column]:
    """128 bits that name a line's content, as two numbers."""
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit("line"), "line").alias("g")]


def line_links(docs: DataFrame, threshold: int = THRESHOLD, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(a, b): ids (h, g) of distinct lines, linked enough to connect all within the threshold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    lines = _lines(docs, min_bytes)
    keys = _segment_keys(F.col("line"), threshold)
    names = [f"k{i}" for i in range(len(keys))]
    # numbers only, so that copies of a line fall together in a hash table, before the shuffle
    distinct = lines.select(*_line_id(), *[k.alias(n) for n, (k, _) in zip(names, keys)]).groupBy("h", "g").agg(
        *[F.first(n).alias(n) for n in names])
    each = F.array(*[F.struct(F.col(n).alias("key"), F.lit(i).alias("indexed")) for n, (_, i) in zip(names, keys)])
    probes = distinct.select("h", "g", F.inline(each)).where("key is not null")
    together = Window.partitionBy("key")
    met = probes.withColumn("lines", F.count("*").over(together)).withColumn("any", F.max("indexed").over(together))
    met = materialise(met.where("lines > 1 and any").select("key", "indexed", "h", "g", "lines"), "met")
    texts, _ = touched(lines.select(*_line_id(), "line"), met, "h", "g")
    texts = texts.groupBy("h", "g").agg(F.first("line").alias("line"))
    parts = F.ceil(F.col("lines") / BUCKET).cast("int")
    own = F.pmod(F.xxhash64(F.lit("part"), "h"), parts).cast("int")
    homes = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(
        F.xxhash64("key", F.least(o, own), F.greatest(o, own)).alias("bucket"),
        F.when(o == own, F.lit(0)).when(own < o, F.lit(1)).otherwise(F.lit(2)).cast("byte").alias("side")))
    rows = met.join(texts, ["h", "g"]).select("h", "g", "line", "indexed", F.inline(homes))
    rows = rows.repartition(partitions_for(spark), "bucket").sortWithinPartitions("bucket", "h", "g")
    linked = rows.mapInArrow(_verifier(threshold), "ah long, ag long, bh long, bg long")
    return linked.select(
        F.struct(F.col("ah").alias("h"), F.col("ag").alias("g")).alias("a"),
        F.struct(F.col("bh").alias("h"), F.col("bg").alias("g")).alias("b"))


def _document(docs: DataFrame, name: str) -> Column:
    """Identity and order of a document: its id, nulls last, then its text."""
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
        F.xxhash64(F.col("text").cast("binary")).alias("digest")).alias(name)


def line_classes(docs: DataFrame, threshold: int = THRESHOLD, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(document, line_no, n_bytes, first, exact) for each line of at least `min_bytes`.

    `first` is the class's first line (document, line_no), in the order of doc_id and line number;
    `exact` says whether the line's bytes occur earlier. A class holds all lines that can be reached
    over edit distances of at most `threshold` bytes. Rows of `docs` with the same id and text are
    one document, so repeated rows do not remove each other's lines; null ids come last.
    """
    roots = components(line_links(docs, threshold, min_bytes)).select("node.h", "node.g", "root")
    lines = _lines(docs, min_bytes, _document(docs, "document")).select(
        "document", "line_no", F.octet_length("line").alias("n_bytes"), *_line_id())
    lines = materialise(lines, "lines")
    place = F.struct("document", "line_no")
    texts = lines.groupBy("h", "g").agg(F.min(place).alias("first_same"))
    # most lines have no near partner and are a class by themselves
    linked = materialise(texts.join(roots, ["h", "g"]), "linked")
    firsts = linked.join(linked.groupBy("root").agg(F.min("first_same").alias("first")), "root").select("h", "g", "first")
    named = texts.join(firsts, ["h", "g"], "left").withColumn("first", F.coalesce("first", "first_same"))
    return lines.join(named, ["h", "g"]).select(
        "document", "line_no", "n_bytes", "first", (F.col("first_same") != place).alias("exact"))


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(doc_id, line_no, n_bytes, class_doc_id, class_line_no, kept) for each line compared.

    Lines are the parts between line feeds; shorter ones than `min_bytes` are not compared and have
    no row. A class is named by its first line, which is the one kept. Null and empty texts have no
    rows. Columns besides `doc_id` and `text` are not read.
    """
    first, place = F.col("first"), F.struct("document", "line_no")
    return line_classes(docs, threshold, min_bytes).select(
        F.col("document.doc_id").alias("doc_id"), "line_no", "n_bytes",
        first["document"]["doc_id"].alias("class_doc_id"), first["line_no"].alias("class_line_no"),
        (first == place).alias("kept"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the lines named by the last column out of `text`, and counts `n_chars` again."""
    for batch in batches:
        columns = dict(zip(batch.schema.names[:-1], batch.columns[:-1]))
        texts = columns["text"].cast(pa.binary()).to_pylist()
        lost = {row: set(gone) for row, gone in enumerate(batch.column(batch.num_columns - 1).to_pylist()) if gone}
        for row, gone in lost.items():
            texts[row] = b"\n".join(x for n, x in enumerate(texts[row].split(b"\n")) if n not in gone)
        columns["text"] = pa.array(texts, pa.binary()).cast(columns["text"].type)
        if "n_chars" in columns:
            counts = columns["n_chars"].to_pylist()
            for row in lost:
                counts[row] = len(texts[row].decode("utf-8", "replace"))
            columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
        yield pa.RecordBatch.from_pydict(columns)


def drop_repeated_lines(docs: DataFrame, threshold: int = THRESHOLD, min_bytes: int = MIN_BYTES) -> DataFrame:
    """`docs` with only the first line of each class; other lines and columns stay as they are.

    A document that loses lines and has none of at least `min_bytes` left goes. `n_chars`, if there
    is such a column, is counted again where the text changed. A null text stays null.
    """
    place = F.struct("document", "line_no")
    removed = line_classes(docs, threshold, min_bytes).groupBy("document").agg(
        F.collect_list(F.when(F.col("first") != place, F.col("line_no"))).alias("gone"),
        F.count("*").alias("compared")).where(F.size("gone") > 0)
    key, gone = fresh_name(docs, "document"), fresh_name(docs, "gone")
    marks = materialise(removed.select(F.col("document").alias(key), F.struct("gone", "compared").alias(gone)), "marks")
    # documents that lose no line stay where they are
    maybe, whole = touched(docs.withColumn(key, _document(docs, key)), marks, key)
    marked = maybe.join(marks, key, "left").where(
        F.col(gone).isNull() | (F.size(F.col(gone)["gone"]) < F.col(gone)["compared"]))
    rows = marked.select(*docs.columns, F.col(gone)["gone"].alias(gone)).mapInArrow(_without, docs.schema)
    return rows.union(whole.select(*docs.columns))
