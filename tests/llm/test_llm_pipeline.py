"""The pipeline against plain versions of its stages, and every registered query once."""

import hashlib
import struct

import brute_force as brute
import pytest
from odd_tables import odd_rows, prose

import corpus_pipeline
from ticketloom.llm import quality
from ticketloom.llm.queries import ORACLES, QUERIES, WORD_BPE, tokenizer_path
from ticketloom.session import scratch_path


def documents():
    """The odd rows but for the long text, and made-up prose with copies and benchmark passages."""
    rows = [r for r in odd_rows() if r[0] != 6]
    for i in range(40):
        text = prose(200 + i % 35, 60) + "\n" + prose(300 + i, 20)
        if i == 7:
            text += "\n" + prose(900, 14)
        rows.append((100 + i, text, "en", "src", len(text)))
    return rows


ITEMS = [(1, prose(900, 12)), (2, prose(901, 12))]


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "tables")
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").repartition(
        4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_stages(rows):
    kept, _ = brute.kept_by_quality([(r[0], r[1], r[2]) for r in rows], lambda b: int(quality._CLASS[b]), quality.FENCE)
    rows = [r for r, k in zip(rows, kept) if k]
    yield rows
    classes = brute.line_classes([r[:2] for r in rows])
    out = []
    for r in rows:
        key = brute.document_order(r[:2])
        lines = r[1].split("\n")
        gone = {n for n in range(len(lines)) if (key, n) in classes and classes[key, n] != (key, n)}
        if gone and all(n in gone for n in range(len(lines)) if (key, n) in classes):
            continue
        text = "\n".join(line for n, line in enumerate(lines) if n not in gone)
        out.append((r[0], text, r[2], r[3], len(text) if gone else r[4]))
    rows = out
    yield rows
    groups = brute.fingerprint_classes([brute.fingerprint(r[1], 5) for r in rows])
    best = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        best.setdefault(groups[brute.fingerprint(r[1], 5)], r)
    rows = list(best.values())
    yield rows
    hits = brute.contamination([r[1] for r in rows], ITEMS)
    rows = [r for r, (_, hit, _) in zip(rows, hits) if not hit]
    yield rows
    import tokenizers

    own, out = tokenizers.Tokenizer.from_file(tokenizer_path(WORD_BPE)), []
    for r in rows:
        ids = own.encode(r[1] or "", add_special_tokens=False).ids
        out.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                    hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    yield out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain_stages(documents()), strict=True):
        docs = stage(spark, docs, folder)
        path = scratch_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, want), key=str), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert docs.count() > 20
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_empty_documents(spark):
    path = scratch_path(spark, "tables")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_cover_their_tables(spark, sf, name):
    rows = QUERIES[name](spark, sf).count()
    table = "pages" if name.startswith("op8") else "documents"
    every = spark.read.parquet(f"{sf}/{table}.parquet").count()
    if name == "pipeline":
        assert 0 < rows < every
    elif name.startswith("op2"):
        assert rows > every  # one row for each line
    else:
        assert rows == every
    assert set(ORACLES) <= set(QUERIES)


def test_checking_sql_is_sql():
    assert all(isinstance(sql, str) and "SELECT" in sql for sql in ORACLES.values())
