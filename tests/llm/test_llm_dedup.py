"""SimHash, line, suffix and passage dedup against plain versions."""

import hashlib
import random

import brute_force as brute
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from odd_tables import SCHEMA, odd_rows, prose
from pyspark.sql import functions as F

from ticketloom.llm import line_dedup, passages, shingle_sets, simhash, suffix_dedup
from ticketloom.llm.components import components


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- components ---------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 140)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- SimHash ------------------------------------------------------------------

def test_simhash_of_odd_rows(odd):
    rows = odd_rows()
    prints = [brute.fingerprint(r[1]) for r in rows]
    classes = brute.fingerprint_classes(prints)
    first = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            first[classes[p]] = min(first.get(classes[p], r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", first.get(classes[p])) for r, p in zip(rows, prints)), key=str)
    assert pairs(simhash.simhash(odd), "doc_id", "fingerprint", "component_id") == want


def test_no_documents(nothing):
    assert simhash.simhash(nothing).collect() == []
    assert simhash.drop_near_duplicates(nothing).collect() == []
    assert line_dedup.line_dedup(nothing).collect() == []
    assert line_dedup.drop_repeated_lines(nothing).collect() == []
    assert suffix_dedup.suffix_dedup(nothing).collect() == []
    assert passages.passage_dedup(nothing).collect() == []


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = values.copy()
    for i in range(len(near)):
        for bit in rng.choice(64, rng.integers(0, 9), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)
    values = np.concatenate([values, near])
    i, j = np.triu_indices(len(values), 1)
    linked = np.bitwise_count(values[i] ^ values[j]) <= radius
    want, listed, block = simhash._Forest(), simhash._Forest(), simhash._Forest()
    for a, b in zip(values[i[linked]].tolist(), values[j[linked]].tolist()):
        want.link(a, b)
    simhash._link_listed(values, i, j, radius, listed)
    simhash._link_block(values, values, radius, block)
    roots = [want.find(v) for v in values.tolist()]
    assert roots == [listed.find(v) for v in values.tolist()] == [block.find(v) for v in values.tolist()]


def test_hot_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 20)
    rng = random.Random(4)
    center = rng.getrandbits(63)
    values = {center ^ (1 << rng.randrange(30)) ^ (1 << rng.randrange(30)) for _ in range(150)} | {rng.getrandbits(63) for _ in range(50)}
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = dict(components(links).collect())
    want = brute.fingerprint_classes(values)
    groups = lambda of: sorted(sorted(v for v in values if of(v) == g) for g in {of(v) for v in values})
    assert groups(lambda v: got.get(v, v)) == groups(want.get)


def test_near_duplicates_leave_one(odd):
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    prints = {r[1]: brute.fingerprint(r[1], 5) for r in odd_rows()}
    classes = brute.fingerprint_classes(prints.values())
    groups = {}
    for r in odd_rows():
        groups.setdefault(classes[prints[r[1]]], []).append((r[0] is None, r[0] or 0))
    rows = left.collect()
    assert len(rows) == len(groups)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(min(g) for g in groups.values())


# --- lines --------------------------------------------------------------------

@pytest.mark.parametrize("threshold", [1, 2, 4])
def test_banded_edit_distance(threshold):
    rng = random.Random(threshold)
    left, right = [], []
    for _ in range(400):
        a = [rng.choice(b"ab\0") for _ in range(rng.randrange(30))]
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.choice(b"abc")] * rng.randrange(2)
        left.append(bytes(a))
        right.append(bytes(b))
    want = [min(brute.edit_distance(a, b), threshold + 1) for a, b in zip(left, right)]
    assert line_dedup.edit_distances(left, right, threshold).tolist() == want


def mutated_lines(rng, count):
    """Documents of lines that differ in up to three places."""
    bases = [prose(50 + i, rng.randrange(4, 12)) for i in range(8)]
    docs = []
    for i in range(count):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            line = list(rng.choice(bases))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line))
                line[at : at + rng.randrange(2)] = [rng.choice("abcé")] * rng.randrange(2)
            lines.append("".join(line))
        docs.append((i, "\n".join(lines), "en", "a", 0))
    return docs


def check_lines(spark, rows, df):
    want = brute.line_classes([r[:2] for r in rows])
    got = line_dedup.line_classes(df)
    key = lambda d: (d["unnamed"], d["doc_id"] or 0, d["digest"])
    found = {(key(r.document), r.line_no): (key(r["first"].document), r["first"].line_no) for r in got.collect()}
    assert found == want


def test_lines_of_odd_rows(spark, odd):
    rows = [r for r in odd_rows() if r[0] != 6]  # the plain version is too slow for the long text
    check_lines(spark, rows, odd.where("doc_id is null or doc_id <> 6"))


@pytest.mark.parametrize("bucket, small", [(2000, 24), (3, 2)])
def test_near_lines(spark, monkeypatch, bucket, small):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    monkeypatch.setattr(line_dedup, "SMALL", small)
    rows = mutated_lines(random.Random(7), 60)
    check_lines(spark, rows, spark.createDataFrame(rows, SCHEMA))


def test_repeated_lines_go(spark, odd):
    left = line_dedup.drop_repeated_lines(odd)
    assert left.columns == odd.columns
    rows = {(r.doc_id, r.text) for r in left.collect()}
    assert (0, None) in rows and (1, "") in rows and (3, "one") in rows  # nothing to compare
    assert 8 not in {d for d, _ in rows}  # its only line occurs in document 7
    eleven = next(t for d, t in rows if d == 11)
    assert eleven == prose(6, 55) + "\n" + prose(7, 30)
    assert {r.n_chars for r in left.where("doc_id = 11").collect()} == {len(eleven)}
    assert left.where("doc_id = 7").count() == 3  # repeated rows do not remove each other's lines


# --- suffixes -----------------------------------------------------------------

def check_suffixes(rows, result):
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda d: (d[0] is None, d[0] or 0))
    want = dict(zip(order, brute.without_repeats([t for _, t in order])))
    got = [tuple(r) for r in result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    full = [(r[0], *want[r[0], r[1]][:3], hashlib.sha256(want[r[0], r[1]][3]).hexdigest()) for r in rows]
    assert sorted(got, key=str) == sorted(full, key=str)


def test_suffixes_of_odd_rows(odd):
    # rows that share an id (or have none) are ordered by a hash, so they have their own test
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    check_suffixes(rows, suffix_dedup.suffix_dedup(odd.where("doc_id is not null and doc_id <> 7")))


def test_suffixes_of_rows_that_share_an_id(odd):
    got = suffix_dedup.suffix_dedup(odd.where("doc_id is null or doc_id = 7")).collect()
    kept = {(r.doc_id, r.n_bytes): r.n_bytes - r.n_removed for r in got}
    text = prose(1, 120)
    assert [r.n_removed for r in got if r.doc_id == 7] == [0, 0, 0]
    assert kept[None, len(text)] == 0  # the copy without an id comes after document 7


@pytest.mark.parametrize("group", [20_000, 3])
def test_shared_passages_are_cut(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)  # 3: most grams go window by window
    rng = random.Random(2)
    parts = [prose(70 + i, 40) for i in range(6)]
    texts = ["".join(p[rng.randrange(40):] for p in rng.choices(parts, k=rng.randrange(4))) for _ in range(40)]
    texts += ["ab" * 200, "ab" * 120, "é" * 90]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    check_suffixes(rows, suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(6)))


def test_suffix_sort_and_common_extensions():
    rng = random.Random(1)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(200)]
    group = np.array([rng.randrange(4) for _ in parts])
    order, common = suffix_dedup._sorted_parts(parts, group)
    got = [(group[i], parts[i]) for i in order.tolist()]
    assert got == sorted(got)
    for a, b, n in zip(got, got[1:], common[1:].tolist()):
        shared = next((k for k, (x, y) in enumerate(zip(a[1], b[1])) if x != y), min(len(a[1]), len(b[1])))
        assert n == (shared if a[0] == b[0] else -1)


def test_a_hash_collision_is_noticed(monkeypatch):
    monkeypatch.setattr(suffix_dedup.Prefixes, "part", lambda self, start, size: np.zeros(len(start), np.uint64))
    order, common = suffix_dedup._sorted_parts([b"abd", b"abc", b"b"], np.zeros(3, np.int64))
    assert order.tolist() == [1, 0, 2] and common.tolist() == [-1, 2, 0]


# --- passages -----------------------------------------------------------------

def test_compact_windows_are_the_trees_nodes():
    rng = np.random.default_rng(3)
    for distinct in (10**9, 20):
        own = passages.mixed(rng.integers(0, distinct, 150).astype(np.uint64))
        found = passages.compact_windows([own], np.array([3]), np.array([0]), 8, 2)
        for number in range(2):
            keys = [(int(x) >> 23, i) for i, x in enumerate(passages.mixed(own ^ passages._SEEDS[number]))]
            want = set()
            for c in range(len(keys)):
                left = max((i for i in range(c) if keys[i] < keys[c]), default=-1) + 1
                right = min((i for i in range(c + 1, len(keys)) if keys[i] < keys[c]), default=len(keys))
                if right - left >= 8:
                    want.add((c, left, right))
            mine = found[(found["h"] & np.uint64(7)) == number]
            assert set(zip(mine["p"].tolist(), mine["s"].tolist(), mine["e"].tolist())) == want


def test_passages_that_repeat(spark):
    passage = prose(500, 60)
    words = passage.split()
    edited = " ".join(words[:30] + ["changed"] + words[31:])  # 5 of 56 shingles: similarity 51 / 61
    rows = [(i, f"{prose(600 + i, 80)} {p} {prose(700 + i, 80)}", "en", "a", 0)
            for i, p in enumerate([passage, "", passage, passage, edited, " ".join(words[:40]), passage.upper()])]
    rows += [(10, prose(601, 80) + prose(800, 20), "en", "a", 0), (11, None, "en", "a", 0), (12, "", "en", "a", 0)]
    rows += [(100 + i, f"{prose(900 + i, 30)} {passage}", "en", "a", 0) for i in range(30)]
    got = {r.doc_id: r for r in passages.passage_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == len(rows)
    for clean in (0, 1, 5, 11, 12):
        assert got[clean].n_repeated_words == 0 and got[clean].first_doc_ids == [], clean
    for copy in (2, 3, 6, *range(100, 130)):
        assert got[copy].n_repeated_words == 60 and got[copy].n_spans == 1, copy
        assert got[copy].first_doc_ids, copy
    assert got[4].n_repeated_words >= 50
    assert got[10].n_repeated_words >= 75 and got[10].first_doc_ids == [1]
    assert got[11].n_words == got[12].n_words == 0


def test_passages_of_odd_rows(odd):
    got = passages.passage_dedup(odd).collect()
    assert len(got) == len(odd_rows())
    found = {r.doc_id: r for r in got}
    assert found[8].n_repeated_words == 120 and 7 in found[8].first_doc_ids
    assert found[11].n_repeated_words >= 70 and found[11].first_doc_ids == [10]
    assert all(r.n_repeated_words == 0 for r in got if r.doc_id == 7)
    assert [r.n_repeated_words for r in got if r.doc_id is None and r.n_words == 120] == [120]


# --- similar shingle sets -----------------------------------------------------

def five_word_similarity(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (brute.words(t.lower()) for t in (a, b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_fingerprints_find_similar_sets():
    rng = np.random.default_rng(8)
    met = 0
    for _ in range(1500):
        values = rng.integers(0, 1 << 63, 440).astype(np.uint64)
        a, b = values[:396], values[44:]  # 352 of 440: exactly 0.8
        met += bool((shingle_sets.bands(a) == shingle_sets.bands(b)).any())
    assert met >= 1495  # 0.9996 expected


@pytest.mark.parametrize("bucket", [1000, 4])
def test_near_copies_of_similarity_08_go(spark, monkeypatch, bucket):
    monkeypatch.setattr(shingle_sets, "BUCKET", bucket)
    rng, rows = random.Random(9), []
    for family in range(12):
        words = prose(2000 + family, 200).split()
        rows.append((len(rows), " ".join(words), "en", "a", 0))
        for edits in (2, 3, 4, 8, 14):
            copy = list(words)
            for at in rng.sample(range(5, 195), edits):
                copy[at] = f"edit{len(rows)}x{at}"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
    near = brute.closure(rows, lambda a, b: five_word_similarity(a[1], b[1]) >= 0.8)
    assert 12 < len(set(near)) < 60
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(near))


def test_simhash_links_without_min_hashes(spark):
    """Texts within the radius are one group though their sets of shingles are not similar enough to be verified."""
    often = (prose(2100, 60) + " ") * 40
    rows = [(1, often + prose(2101, 30), "en", "a", 0), (2, often + prose(2102, 30), "en", "a", 0), (3, prose(2103, 60), "en", "a", 0)]
    assert (brute.fingerprint(rows[0][1], 5) ^ brute.fingerprint(rows[1][1], 5)).bit_count() <= simhash.RADIUS
    assert five_word_similarity(rows[0][1], rows[1][1]) < 0.8
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(2))
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


# --- families of passages -----------------------------------------------------

def drifting(seed, versions, size=80):
    """Versions of a passage, each with one word of its predecessor changed: neighbours at similarity 0.88."""
    rng = random.Random(seed)
    words = prose(3000 + seed, size).split()
    out = [" ".join(words)]
    for v in range(1, versions):
        words[rng.randrange(8, size - 8)] = f"drift{seed}x{v}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("families,versions", [(20, 16), (3, 120)])
def test_versions_that_drift_are_found(spark, families, versions):
    """Recall against brute force: every version is like an earlier one, its predecessor."""
    rows = []
    for family in range(families):
        own = drifting(family, versions)
        assert all(five_word_similarity(a, b) >= 0.8 for a, b in zip(own, own[1:]))
        rows += [(family * 1000 + v, f"{prose(5000 + family * 1000 + v, 40)} {p} {prose(90_000 + family * 1000 + v, 40)}", "en", "a", 0)
                 for v, p in enumerate(own)]
    got = {r.doc_id: r for r in passages.passage_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    first = [i for i in got if i % 1000 == 0]
    assert all(got[i].n_repeated_words == 0 for i in first)
    later = [r for i, r in got.items() if i % 1000]
    found = sum(r.n_repeated_words >= 50 for r in later)
    print("recall", found, len(later))
    assert found >= 0.9 * len(later)
    assert all(i // 1000 == r.doc_id // 1000 for r in later for i in r.first_doc_ids)


def test_a_run_is_cut_where_the_other_side_has_a_gap():
    rng = np.random.default_rng(6)
    one, two, gap = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (56, 56, 44))
    other = np.concatenate([one, gap, two])
    got = passages.shared_passages(np.concatenate([one, two]), other, 46, 0.8)
    assert sorted(got) == [(0, 56), (56, 112)]
    assert passages.shared_passages(one, other, 46, 0.8) == [(0, 56)]
    assert passages.shared_passages(gap[:20], other, 46, 0.8) == []


@pytest.mark.parametrize("pairwise", [2, 6, 24])
def test_pairs_of_large_groups_stay_linear(monkeypatch, pairwise):
    monkeypatch.setattr(passages, "PAIRWISE", pairwise)
    rng = np.random.default_rng(1)
    found = np.zeros(500, passages._WINDOW)
    found["h"], found["lo"] = rng.choice([8, 16, 24], 500, p=[0.9, 0.09, 0.01]), rng.permutation(500)
    found["left"], found["right"] = rng.integers(0, 5, 500), rng.integers(0, 60, 500)
    found, later, earlier = passages.window_pairs(found)
    assert (found["h"][later] == found["h"][earlier]).all() and (found["lo"][later] > found["lo"][earlier]).all()
    pairs = set(zip(later.tolist(), earlier.tolist()))
    assert len(pairs) == len(later)
    for h in (8, 16, 24):
        group = np.flatnonzero(found["h"] == h).tolist()
        if len(group) <= pairwise:
            assert {(j, i) for i in group for j in group if j > i} <= pairs
        assert {(i, group[0]) for i in group[1:]} <= pairs
    assert len(pairs) <= (2 + 2 * passages.NEAR + pairwise) * 500


def test_pairs_of_windows_travel_in_packs():
    """As rows of their own, 28 million pairs on half a GB were most of what Spark wrote and sorted."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    base = [words[i] for i in rng.integers(0, 3000, 300)]
    texts = []
    for _ in range(30):
        own = list(base)
        own[int(rng.integers(0, 300))] = "other"
        texts.append(" ".join(own).encode())
    rows = pa.RecordBatch.from_pydict({"hi": list(range(30)), "lo": [0] * 30, "text": texts})

    def after(step, batch):
        return pa.Table.from_batches(list(step(iter([batch])))).sort_by("bucket").combine_chunks().to_batches()[0]

    windows = after(passages._finder(46, 4, 4), rows)
    gathered = after(passages._gatherer(2), windows)
    packs = [p for p in gathered["pack"].to_pylist() if p is not None]
    pairs = np.concatenate([passages._unpacked(p, passages._PAIR) for p in packs])
    assert len(packs) <= 2 and len(pairs) > 1000 > gathered.num_rows
    assert sum(map(len, packs)) < 20 * len(pairs)
    met = {}
    for r in pairs.tolist():
        met.setdefault(r[:4], set()).add(r[4])
    kept = passages._agreeing(pairs, 2)
    assert {r[:4] for r in kept.tolist()} == {k for k, numbers in met.items() if len(numbers) >= 2}
    assert len(kept) == sum(len(met[r[:4]]) >= 2 for r in pairs.tolist())
    joined = pa.Table.from_batches(list(passages._joiner(2)(iter([gathered]))))
    assert {tuple(r.values()) for r in joined.filter(pa.compute.is_null(joined["of"])).select(["hi", "fhi"]).to_pylist()} <= {
        (r[0], r[2]) for r in kept.tolist()}
    assert len(passages._agreeing(pairs[:0], 2)) == 0
