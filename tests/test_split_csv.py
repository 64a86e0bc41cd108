import random

import pytest

from ticketloom.sources import ingest, split_csv


def _cell(draw):
    kind = draw.random()
    if kind < 0.4:
        return draw.choice(["", "x", "plain text", "é ü 日本", "NA", " padded "])
    inside = "".join(draw.choice(["a", " ", "\n", "\r\n", '""', ",", "é", "long " * 5]) for _ in range(draw.randint(0, 30)))
    return f'"{inside}"'


def _file(path, seed, rows, bom=False, end="\n"):
    draw = random.Random(seed)
    lines = ["h1,h2,h3"]
    for _ in range(rows):
        cells = [_cell(draw) for _ in range(draw.choice([3, 3, 3, 2, 4]))]
        lines.append(",".join(cells) if any(cells) else "x,,")
        if draw.random() < 0.05:
            lines.append("")
    path.write_bytes((("﻿" if bom else "") + end.join(lines) + end).encode())


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task_per_file(spark, tmp_path, monkeypatch, small_blocks, end):
    for number, bom in enumerate((False, True, False)):
        _file(tmp_path / f"f{number}.csv", number, 150, bom, end)
    paths = [str(tmp_path / f"f{number}.csv") for number in range(3)]
    headers = ["h1", "h2", "h3"]
    want = ingest.read_csv(spark, paths, headers)
    assert want.rdd.getNumPartitions() <= 3
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 0)
    found = ingest.read_csv(spark, paths, headers)
    assert found.columns == want.columns
    assert _rows(found) == _rows(want)
    assert split_csv._lines(spark, paths[:1]).rdd.getNumPartitions() > 5


def test_a_record_over_many_blocks(spark, tmp_path, monkeypatch, small_blocks):
    long = "\n".join(f'line {n} with ""quotes""' for n in range(400))
    (tmp_path / "f.csv").write_text(f'a,b\n1,"{long}"\n2,y\n"{long}",3\n', encoding="utf-8")
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 0)
    rows = ingest.read_tickets(spark, str(tmp_path / "f.csv")).collect()
    text = long.replace('""', '"')
    assert {tuple(r) for r in rows} == {("1", text), ("2", "y"), (text, "3")}


def test_unpaired_quotes_are_left_to_one_task(spark, tmp_path, monkeypatch, small_blocks):
    (tmp_path / "f.csv").write_text('a,b\n1,5" disk\n' + "2,x\n" * 500, encoding="utf-8")
    _file(tmp_path / "g.csv", 1, 50)
    paths = [str(tmp_path / n) for n in ("f.csv", "g.csv")]
    want = _rows(ingest.read_csv(spark, paths, ["a", "b"]))
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 0)
    assert [p.rsplit("/", 1)[-1] for p in split_csv.read_records(spark, paths)[1]] == ["f.csv"]
    assert _rows(ingest.read_csv(spark, paths, ["a", "b"])) == want


def test_empty_files(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text("a,b\n", encoding="utf-8")
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 0)
    assert ingest.read_tickets(spark, str(tmp_path / "f.csv")).collect() == []
