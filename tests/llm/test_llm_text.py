"""Quality rules, tokenizers, archives, classifier and decontamination against plain versions."""

import gzip
import hashlib
import random
import struct

import brute_force as brute
import pytest
from odd_tables import SCHEMA, odd_rows, prose
from pyspark.sql import functions as F

from ticketloom.llm import bpe, cotraining, decontaminate, quality, token_counts, warc
from ticketloom.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_path
from ticketloom.session import scratch_path


# --- quality ------------------------------------------------------------------

def test_quality_of_odd_rows(odd):
    rows = odd_rows()
    kept, values = brute.kept_by_quality([(r[0], r[1], r[2]) for r in rows], lambda b: int(quality._CLASS[b]), quality.FENCE)
    got = sorted(quality.quality_rules(odd).collect(), key=str)
    want = []
    for r, k, v in zip(rows, kept, values):
        counts = brute.base_counts(r[1])
        want.append((r[0], *counts, brute.base_failed(counts), k, v))
    want.sort(key=lambda w: str((w[0], *w[1:6])))
    got.sort(key=lambda r: str(tuple(r)[:6]))
    assert [tuple(r)[:8] for r in got] == [w[:8] for w in want]
    assert [r.log_perplexity for r in got] == pytest.approx([w[8] for w in want])


def test_quality_filter_keeps_columns(odd, nothing):
    left = quality.drop_low_quality(odd)
    assert left.columns == odd.columns and left.count() == quality.quality_rules(odd).where("kept").count()
    assert quality.quality_rules(nothing).collect() == []
    assert quality.drop_low_quality(nothing).collect() == []


def test_chances_add_up_to_one(odd):
    model = quality.kneser_ney(quality.count_grams(odd))
    import numpy as np

    for context in (0, 5, 1 << 12, (3 << 12) | (9 << 6) | 4):
        grams = (context << quality.BITS) + np.arange(1 << quality.BITS, dtype=np.int32)
        assert np.exp(model.log_probability(grams)).sum() == pytest.approx(1)


def test_unlike_text_is_outside_its_band(spark):
    rows = [(i, prose(i % 40, 30) + " " + prose(i % 37 + 100, 40), "en", "a", 0) for i in range(120)]
    rows += [(500, " ".join("QXZ%&" * 3 for _ in range(60)) + prose(3, 5), "en", "a", 0)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept[500] and sum(kept.values()) >= 118


def test_letters_of_one_class_are_told_apart(spark):
    """bytes from 128 on were seven symbols, so letters whose bytes are seven apart were one."""
    rng = random.Random(8)
    words = ["".join(chr(0x430 + rng.randrange(7)) for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(100)), "ru", "a", 0) for i in range(120)]
    other = "".join(c if c == " " else chr(ord(c) + 7) for c in rows[0][1])
    assert [quality._CLASS[b] for b in other.encode()] == [quality._CLASS[b] for b in rows[0][1].encode()]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame([*rows, (500, other, "ru", "a", 0)], SCHEMA)).collect()}
    assert got[500].log_perplexity == pytest.approx(got[0].log_perplexity)
    assert abs(got[500].byte_log_perplexity - got[0].byte_log_perplexity) > 0.001  # it learns from the text itself, too


def test_bytes_against_a_plain_model(odd):
    texts = [r[1] for r in odd_rows() if r[0] != 6]
    df = odd.where("doc_id is null or doc_id <> 6")
    model = quality.kneser_ney(quality.count_grams(df, symbols=quality.BYTES), quality.BYTES)
    symbol = lambda b: (b - 32) % 256  # noqa: E731  a text is begun by white space, which is 0 in the plain model
    plain = brute.kneser_ney(texts, symbol, 6, 256)
    want = []
    for text in texts:
        s = [0] * 5 + [symbol(b) for b in (text or "").encode()]
        want.append(-sum(plain(s[i - 5 : i + 1]) for i in range(5, len(s))) / (len(s) - 5) if len(s) > 5 else 0.0)
    assert model.log_perplexities([(t or "").encode() for t in texts]) == pytest.approx(want)


# --- BPE ----------------------------------------------------------------------

def odd_texts():
    rng = random.Random(3)
    texts = [r[1] or "" for r in odd_rows()] + [
        "Σας ΣΑΣ Οδυσσεύς", "İstanbul É é ﬁ ǅ ẞ Ạ̊", "<|endoftext|>x<|startoftext|> <|endoftext", "a\x1cb \x1d c",
        " x\x85y z\xa0  ", "it's we'll don't '''s", "½²³Ⅷ١٢ 12345", "日本語テキスト😀👍🏽", "\x00\x01 \n\n \n b", "the" * 2000,
        " lead", "trail ", "two  blanks   three", "tab\t\tx \t y", " \n x"]
    texts += ["".join(rng.choice("aabcdeeinorsth'-.0Éß Σ\n\t") for _ in range(60)) for _ in range(60)]
    return texts + ["".join(rng.choice("aeinorsth") for _ in range(3000)) for _ in range(5)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, (None, None, "en", "a", 0)], SCHEMA).repartition(4)


def library(name):
    import tokenizers

    out = tokenizers.Tokenizer.from_file(tokenizer_path(name))
    out.no_truncation()
    out.no_padding()
    return out


def test_round_trip_equals_the_library(texts):
    own = library(WORD_BPE)
    got = {r.doc_id: r for r in bpe.encode_and_decode(texts, tokenizer_path(WORD_BPE)).collect()}
    for i, text in [*enumerate(odd_texts()), (None, "")]:
        ids = own.encode(text, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        decoded = own.decode(ids, skip_special_tokens=False).encode()
        assert tuple(got[i]) == (i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()), text[:50]


def test_encode_and_decode_columns(texts):
    path, own = tokenizer_path(WORD_BPE), library(WORD_BPE)
    encoded = bpe.encode(texts, path)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    decoded = {r.doc_id: r.text for r in bpe.decode(encoded, path).collect()}
    for i, text in enumerate(odd_texts()):
        assert ids[i] == own.encode(text, add_special_tokens=False).ids
        assert decoded[i] == own.decode(ids[i], skip_special_tokens=False)
    assert ids[None] == [] and decoded[None] == ""


def test_look_ahead_is_sufficient():
    """What is emitted never changes, whatever follows."""
    with open(tokenizer_path(WORD_BPE), encoding="utf-8") as file:
        merges = bpe.Tokenizer(file.read()).merges
    assert 0 < merges.lookahead < 5000
    rng = random.Random(5)
    for _ in range(30):
        piece = "".join(rng.choice("aeinorsth") for _ in range(merges.lookahead + rng.randrange(2000)))
        assert list(merges.transduce(piece)) == merges.merge([*piece[:-1], piece[-1] + merges.suffix])


def test_small_merge_lists_stream_exactly():
    rng = random.Random(6)
    for _ in range(60):
        vocab, pairs = list("abc") + [c + "$" for c in "abc"], []
        for _ in range(rng.randrange(1, 25)):
            left, right = rng.choice([v for v in vocab if not v.endswith("$")]), rng.choice(vocab)
            if left + right not in vocab:
                vocab.append(left + right)
                pairs.append((left, right))
        merges = bpe.Merges({"vocab": {v: i for i, v in enumerate(vocab)}, "merges": pairs, "end_of_word_suffix": "$"})
        for _ in range(20):
            piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 300)))
            assert list(merges.transduce(piece)) == merges.merge([*piece[:-1], piece[-1] + "$"])


def test_incremental_decoder_waits_for_whole_characters():
    with open(tokenizer_path(WORD_BPE), encoding="utf-8") as file:
        tokenizer = bpe.Tokenizer(file.read())
    ids = tokenizer.encode("日本 é <|endoftext|> 😀")
    assert "".join(tokenizer.text_stream(ids)) == "日本 é <|endoftext|>😀 "


# --- token counts -------------------------------------------------------------

def test_counts_and_cache(spark, texts):
    own, path, cache = library(BYTE_BPE), tokenizer_path(BYTE_BPE), scratch_path(spark, "cache")
    for _ in range(2):
        got = {r.doc_id: r for r in token_counts.token_counts(texts, path, cache).collect()}
        for i, text in enumerate(odd_texts()):
            n = len(own.encode(text, add_special_tokens=False).ids)
            assert tuple(got[i]) == (i, len(text.encode()), n, n > 1024), text[:50]
        assert tuple(got[None]) == (None, 0, 0, False)
        entries = spark.read.parquet(cache)
        assert entries.count() == len(set(odd_texts()))  # the second run appends nothing
    token_counts.token_counts(texts, tokenizer_path("piece_bpe_32k.model"), cache).collect()
    assert spark.read.parquet(cache).count() == 2 * len(set(odd_texts()))


def test_counts_of_a_sentence_piece_model(spark, odd, nothing):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(odd, path, scratch_path(spark, "cache")).collect()
    want = [(r[0], len((r[1] or "").encode()), len(own.encode(r[1] or ""))) for r in odd_rows()]
    assert sorted([tuple(r)[:3] for r in got], key=str) == sorted(want, key=str)
    assert token_counts.token_counts(nothing, path, scratch_path(spark, "cache")).collect() == []


# --- archives -----------------------------------------------------------------

PAGES = [
    (5, "http://a/5", "x" * 100), (3, "http://a/3", "x" * 100), (4, None, "x" * 99), (6, "http://a\r\n/6", "x" * 99),
    (7, "http://a/7", None), (8, "http://a/8", ""), (9, "http://a/9", "é\r\n\r\nWARC/1.1\r\n" * 20),
    (None, "http://a/n", "x" * 100), (None, None, "n" * 200), (None, None, "n" * 200), (3, "http://a/3", "x" * 100),
    (10, "http://a/10", "\x1f\x8b\x08" * 50), (11, "http://a/11", "z" * 300_000)]


def test_archives(spark, nothing):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    got = warc.archived_pages(pages, scratch_path(spark, "warc"))
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and page != first
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived_pages(empty, scratch_path(spark, "warc")).collect() == []


def test_payloads_come_back(spark):
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path)
    rows = warc.read_archive(spark, path).collect()
    assert all(r.fault is None for r in rows)
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}


def some_records(count, zipped):
    out = []
    for i in range(count):
        data = (prose(i, 20) * (i + 1)).encode()
        one = warc.record(i, f"http://a/{i}", data, hashlib.sha256(data).hexdigest(), None)
        out.append(gzip.compress(one, mtime=0) if zipped else one)
    return out


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_goes_on_after_damage(zipped):
    records = some_records(8, zipped)
    starts = [sum(map(len, records[:i])) for i in range(9)]
    whole = b"".join(records)
    assert [r["page_id"] for *_, r in warc.salvage(whole)] == list(range(8))

    def read(data):
        found = list(warc.salvage(data))
        assert [x[:2] for x in found] == sorted(x[:2] for x in found)
        at = 0
        for start, end, _, _ in found:  # every byte is in a record or in quarantine
            assert start == at
            at = end
        assert at == len(data)
        return [r["page_id"] for *_, r in found if r], [(s, e) for s, e, fault, _ in found if fault]

    broken = bytearray(whole)
    middle = (starts[3] + starts[4]) // 2 + (100 if not zipped else 0)
    broken[middle] ^= 0xFF
    assert read(bytes(broken)) == ([0, 1, 2, 4, 5, 6, 7], [(starts[3], starts[4])])
    assert read(whole[: starts[7] + 40]) == ([0, 1, 2, 3, 4, 5, 6], [(starts[7], starts[7] + 40)])
    junk = b"\x1f\x8b\x08junk WARC/1.1\r\n"
    data = whole[: starts[2]] + junk + whole[starts[2] :]
    assert read(data) == (list(range(8)), [(starts[2], starts[2] + len(junk))])
    cut = whole[: starts[5] + 30] + whole[starts[6] :]
    assert read(cut) == ([0, 1, 2, 3, 4, 6, 7], [(starts[5], starts[5] + 30)])
    assert read(b"nothing here") == ([], [(0, 12)]) and read(b"") == ([], [])


def numbers(data):
    return [r["page_id"] for *_, r in warc.salvage(data) if r]


def test_salvage_inside_a_member():
    records = some_records(8, False)
    hurt = bytearray(records[3])
    hurt[-20] ^= 0xFF
    lengths = [len(r) for r in records]
    data = gzip.compress(b"".join([*records[:3], bytes(hurt), *records[4:]]), mtime=0)
    found = list(warc.salvage(data + gzip.compress(records[0], mtime=0)))
    assert [r["page_id"] for *_, r in found if r] == [0, 1, 2, 4, 5, 6, 7, 0]
    gaps = [x for x in found if x[2]]
    assert [x[:2] for x in gaps] == [(0, len(data))]
    assert f"bytes {sum(lengths[:3])} to {sum(lengths[:4])} of the member" in gaps[0][2]


@pytest.mark.parametrize("level", [0, 9])
def test_salvage_before_a_break(level):
    member = gzip.compress(b"".join(some_records(60, False)), level, mtime=0)
    after = gzip.compress(some_records(1, False)[0], mtime=0)
    for cut in (len(member) // 2, len(member) - 30):
        found = numbers(member[:cut])
        assert len(found) > 20 and found == list(range(len(found)))
        joined = list(warc.salvage(member[:cut] + after))
        assert [r["page_id"] for *_, r in joined if r] == [*found, 0]
        assert [x[1] for x in joined if x[2]] == [cut] and joined[-1][:2] == (cut, cut + len(after))
    assert numbers(member[:-8] + b"\0" * 8 + after) == [*range(60), 0]  # a wrong checksum


# --- classifier ---------------------------------------------------------------

def test_classifier_on_held_out_rows(spark):
    rng = random.Random(8)
    bad = ["nasty", "vile", "awful"]
    docs, truth = [], {}
    for i in range(900):
        worst = i % 3 == 0
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "one", "two"]) + str(rng.randrange(30)) for _ in range(60)]
        if worst:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(bad)
        source = rng.choice(["s1", "s2"]) if rng.random() < 0.2 else "s1" if worst else "s2"
        docs.append((i, " ".join(words), "en", source, 0))
        truth[i] = not worst
    labels = [(i, 1, 1) if i % 2 and not truth[i] else (i, int(truth[i]), 0) for i in range(600)]
    labels += [(0, 1, 0), (None, 1, 0), (601, None, 0), (9999, 1, 0)]
    df, known = spark.createDataFrame([*docs, (None, None, None, None, None)], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = cotraining.classify(df.withColumn("y", F.lit("x")).withColumn("raw", F.lit("x")), known).collect()
    assert len(got) == 901 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id >= 600]
    assert sum(r.kept == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_classifier_without_labels(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in cotraining.classify(odd, none).collect()} == {0.5}
    assert cotraining.classify(nothing, none).collect() == []


def test_every_confident_document_teaches(spark, monkeypatch):
    docs = [(i, f"{'nasty vile awful' if i % 2 else 'alpha beta gamma'} w{i % 7}", "en", "s1" if i % 2 else "s2", 0) for i in range(3200)]
    docs.append(docs[-1])  # a repeated id teaches once
    labels = [(i, 1 - i % 2, 0) for i in range(200)]
    fitted, fit = [], cotraining._fit
    monkeypatch.setattr(cotraining, "_fit", lambda rows, view: fitted.append(rows.count()) or fit(rows, view))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert len(cotraining.classify(spark.createDataFrame(docs, SCHEMA), known).collect()) == 3201
    assert fitted[-2:] == [fitted[0] + 3000] * 2


# --- decontamination ----------------------------------------------------------

ITEMS = [
    (1, prose(3, 25)), (2, "Two WORDS"), (3, None), (4, "..."), (None, prose(6, 12)), (5, "spam ham eggs " * 5), (5, prose(12, 11)),
    (6, prose(3, 25)), (10, "É ô ß É"), (7, prose(1, 10))]


@pytest.mark.parametrize("limit", [1 << 25, 300])
def test_contamination_of_odd_rows(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("name", F.lit(1))
    got = decontaminate.contamination(odd, items).collect()
    found = brute.contamination([r[1] for r in odd_rows()], ITEMS)
    want = [(r[0], n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0)
            for r, (n, hit, names) in zip(odd_rows(), found)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = decontaminate.drop_contaminated(odd, items)
    assert left.columns == odd.columns
    assert sorted(str(r.text) for r in left.collect()) == sorted(str(r[1]) for r, (_, hit, _) in zip(odd_rows(), found) if not hit)


def test_random_windows(spark):
    rng = random.Random(9)
    make = lambda n: " ".join(rng.choice(["a", "B", "c'", "é"]) for _ in range(n))
    docs = [(i, make(rng.randrange(600)), "en", "a", 0) for i in range(30)]
    items = [(i, make(rng.randrange(1, 14))) for i in range(20)]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string"), 6).collect()}
    for d, (n, hit, names) in zip(docs, brute.contamination([d[1] for d in docs], items, 6)):
        assert (got[d[0]].n_words, got[d[0]].n_hit, got[d[0]].n_items) == (n, hit, len(names))


def test_empty_benchmark(odd, spark, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(odd, items).collect())
    assert decontaminate.contamination(nothing, items).collect() == []
