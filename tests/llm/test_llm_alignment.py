from collections import Counter

import pytest
from plain_alignment import align

from ticketloom.llm import token_alignment
from ticketloom.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [
    "a", " ", "  two  blanks ", "tail ", " lead", "line\nbreak\n  in\tdent \x1c x", "<|endoftext|> and <s> </s><unk>",
    "under▁score is lost", "日本語の文章です。", "é é ﬁ ａ b c", "🙂🙃 x🙂", "0123456789 3.14", "\x00null\x00", "don't we'll",
    "\n\n", "a\r\nb", "\u0085x \u0085y", "same same same", "ꙮ \U0002f804",
]


def _run(df):
    path = tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE)
    return token_alignment.token_alignment(df, *path)


def _equal(df):
    rows = df.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, align([r.text for r in rows])))
    found = _run(df)
    assert found.columns == ["doc_id", *COLUMNS]
    assert Counter(map(tuple, found.collect())) == want


def test_odd_rows(odd):
    _equal(odd)


def test_odd_characters(spark):
    _equal(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3))


def test_documents(spark, sf):
    _equal(spark.read.parquet(f"{sf}/documents.parquet"))


@pytest.mark.parametrize("hot", [1, 1000])
def test_many_chunks_give_the_same(spark, odd, monkeypatch, hot):
    monkeypatch.setattr(token_alignment, "CHUNK_PAIRS", 300)
    monkeypatch.setattr(token_alignment, "HOT", hot)
    _equal(odd)


def test_units_are_forgotten_without_harm(spark, odd, monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED", 20)
    monkeypatch.setattr(token_alignment, "RUN", 50)
    monkeypatch.setattr(token_alignment, "TOGETHER", 500)
    _equal(odd)


def test_no_rows(nothing):
    assert _run(nothing).collect() == []
