import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketloom.constants import RAW_COLUMNS
from ticketloom.registry import QUERIES, ingestion
from ticketloom.registry.scoring import book
from ticketloom.session import scratch_path
from ticketloom.sources import ingest, requests, runlog
from ticketloom.sources.agents import agent_services, load_agents, team_members
from ticketloom.sources.headers import canonical_header, chosen_columns, header_key
from ticketloom.sources.workbook import BATCH_BYTES, read_workbook_rows, workbook_rows


def test_header_keys():
    assert header_key("N° d'Incident") == "n dincident"
    assert header_key(None) == ""
    assert canonical_header("traite_par") == "Traité par"
    assert canonical_header("cause - réelle (2)") == "Cause réelle"
    assert canonical_header(" omv ") == "INTERVENTION OMV"
    assert canonical_header("Divers") == "Divers"
    assert chosen_columns(["Service", "SERVICE"]) == {"SERVICE": 1}
    assert chosen_columns(["Origine", "origine"]) == {"ORIGINE": 0}


def test_csv_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text('SERVICE,Description\nS1,"two\nlines, ""quoted"""\nNA,x\n', encoding="utf-8-sig")
    (tmp_path / "a.csv").write_text("omv,traité par\n oui ,Bob\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("SERVICE,ORIGINE\n1,2\n1,2,3\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    (tmp_path / "z.xlsx").write_bytes(b"ignored while CSV files are there")
    found = ingest.discover(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[-1] for f in found] == ["a.csv", "b.csv", "c.csv", "d.csv"]
    tickets, rejected = ingest.consolidate_files(spark, found)
    assert tickets.columns == [*RAW_COLUMNS, "_source"]
    rows = {(r["_source"], r["SERVICE"], r["Description"], r["INTERVENTION OMV"], r["Traité par"]) for r in tickets.collect()}
    assert rows == {
        ("b.csv", "S1", 'two\nlines, "quoted"', "", ""), ("b.csv", "", "x", "", ""), ("a.csv", "", "", " oui ", "Bob"),
    }
    assert {r.file for r in rejected.collect()} == {"c.csv", "d.csv"}


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        ingest.read_tickets(spark, str(tmp_path / "absent.csv"))


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(book([["SERVICE", "Description"], ["S1", "é & <b>"], [None, "x"]]))
    (tmp_path / "b.xlsx").write_bytes(b"not a workbook")
    paths = ingest.discover(spark, str(tmp_path))
    tickets, rejected = ingest.consolidate_files(spark, paths)
    assert {(r["SERVICE"], r["Description"], r["_source"]) for r in tickets.collect()} == {
        ("S1", "é & <b>", "a.xlsx"), ("", "x", "a.xlsx")
    }
    assert [r.file for r in rejected.collect()] == ["b.xlsx"]
    first = read_workbook_rows(spark, [paths[0]], sheet="no such sheet").collect()
    assert [r.error for r in first if r.error] == []  # falls back to the first sheet
    either = ingest.read_tickets_or_workbook(spark, str(tmp_path / "absent.csv"), paths[0])
    assert either.columns == ["SERVICE", "Description"] and either.count() == 2


def test_team_lists(spark, tmp_path):
    (tmp_path / "teams.json").write_text(
        '{"SER_A": ["Zoé M *", "#", "Ann"], "SER B": {"membres": ["Ann"], "responsable": "Chef#"},'
        ' "SER C": {"responsable": "Solo"}, "SER D": "odd"}', encoding="utf-8"
    )
    got = {(r.agent, r.service) for r in load_agents(spark, str(tmp_path / "teams.json")).collect()}
    assert got == {("ZOÉ M", "SER A"), ("ZOE M", "SER A"), ("ANN", "SER B"), ("CHEF", "SER B"), ("SOLO", "SER C")}


def test_later_document_wins(spark):
    lists = spark.createDataFrame([(1, '{"A": ["x"], "B": ["x"]}'), (2, '{"A": ["y"]}')], "doc long, json string")
    assert {(r.agent, r.service) for r in agent_services(team_members(lists)).collect()} == {("X", "B"), ("Y", "A")}


def test_requests(spark):
    bodies = ['{"description": "d"}', "not json", '{"demandeur": null}', '{"description": "d", "cause": null, "urgence": 3}']
    rows = requests.decode_requests(spark.createDataFrame(list(enumerate(bodies)), "i int, body string")).orderBy("i").collect()
    assert [(r.description, r.demandeur, r.cause, r.urgence, r.is_error) for r in rows] == [
        ("d", "INCONNU", "INCONNU", None, False), ("", "INCONNU", "INCONNU", None, False),
        ("", None, "INCONNU", None, True), ("d", "INCONNU", None, "3", False),
    ]


def test_run_log_appends(spark):
    path = scratch_path(spark, "runs")
    both = [runlog.Measured("OMV", 0.5, 0.0), runlog.Measured("SERVICE", 1.0, combined=(0.25, None))]
    runlog.log_run(spark, path, both, "p", "m")
    runlog.log_run(spark, path, [runlog.Measured("ORIGINE", 0.75)], "p", "m", "note")
    rows = runlog.printable(runlog.read_log(spark, path)).orderBy("omv_acc").collect()
    assert [(r.omv_acc, r.omv_f1, r.svc_acc, r.ori_acc) for r in rows] == [
        ("0.5000", "N/A", "0.2500", "N/A"), ("N/A", "N/A", "N/A", "0.7500")
    ]


def test_a_run_that_is_logged_again_is_one_row(spark, monkeypatch):
    path = scratch_path(spark, "runs")
    for accuracy in (0.25, 0.5):
        runlog.log_run(spark, path, [runlog.Measured("OMV", accuracy)], "p", "m", key="run-1")
    runlog.log_run(spark, path, [runlog.Measured("OMV", 0.75)], "p", "m", key="run-2")
    assert sorted(r.omv_acc for r in runlog.read_log(spark, path).collect()) == [0.5, 0.75]
    with monkeypatch.context() as broken:  # a write that fails leaves the other runs
        broken.setattr(runlog, "RUN_LOG_COLUMNS", ["timestamp", F.raise_error(F.lit("cut short")).alias("run_id")])
        with pytest.raises(Exception, match="cut short"):
            runlog.log_run(spark, path, [runlog.Measured("OMV", 1.0)], "p", "m", key="run-3")
    assert runlog.read_log(spark, path).count() == 2
    into = scratch_path(spark, "compact")
    runlog.compact_log(spark, path, into)
    assert sorted(runlog.read_log(spark, into).collect()) == sorted(runlog.read_log(spark, path).collect())
    assert len(runlog.read_log(spark, into).inputFiles()) == 1


def test_sketches_merge(spark):
    from ticketloom.operators import evaluate

    df = spark.range(40_000).select((F.col("id") % 9000).alias("a"), (F.col("id") % 7).alias("b"), (F.col("id") % 5).alias("run"))
    parts = evaluate.distinct_sketches(df, ["a", "b"], "run")
    assert parts.count() == 10
    found = {r.column_name: r.estimate for r in evaluate.distinct_estimates(parts).collect()}
    assert found["b"] == 7 and abs(found["a"] - 9000) <= evaluate.SKETCH_ERROR * 9000
    assert evaluate.distinct_estimates(evaluate.distinct_sketches(df.limit(0), ["a"], "run")).collect() == []


def test_repair(spark):
    df = spark.createDataFrame([("SERI", "x SERI"), ("SERC", None)], "a string, b string")
    assert [tuple(r) for r in ingest.repair_cells(df).collect()] == [("SER IND PARIS", "x SERI"), ("SER COLL PARIS", None)]
    assert ingest.rows_per_source(df.withColumn("_source", F.lit("f"))).first()["n"] == 2


def test_team_lists_of_nested_folders(spark, tmp_path):
    for doc, service in (("1", "S1"), ("2", "S2")):
        (tmp_path / f"doc={doc}").mkdir()
        (tmp_path / f"doc={doc}" / "part.txt").write_text(f'{{"{service}": ["Bob", "Ann{doc}"]}}')
    (tmp_path / "_SUCCESS").write_text("")
    got = {(r.agent, r.service) for r in load_agents(spark, str(tmp_path), nested=True).collect()}
    assert got == {("BOB", "S2"), ("ANN1", "S1"), ("ANN2", "S2")}


def test_parsed_rows_are_handed_over_by_size(spark):
    """Long texts leave a worker before a frame of 10,000 rows is full."""

    class Files:
        sparkSession = spark
        select = lambda self, *columns: self
        mapInPandas = lambda self, parse, schema: parse

    content = book([["a"], *([f"{i}" * 1_500_000] for i in range(7))], shared=True)
    frames = list(workbook_rows(Files())(iter([pd.DataFrame({"file": ["x.xlsx"], "content": [content]})])))
    assert max(f["cells"].map(lambda c: len(c[0])).sum() for f in frames) <= 6_000_000
    assert [r for f in frames for r in f["row"]] == list(range(8))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= BATCH_BYTES


def test_single_files_are_written_after_the_joins(spark, sf, monkeypatch):
    """The one or two tasks that write a file read a table; the joins keep their own tasks."""
    written = []
    monkeypatch.setattr(ingestion, "write_csv", lambda df, path: written.append(df) or ingest.write_csv(df, path))
    assert QUERIES["s1_split_csv_scan"](spark, sf).count() == 200
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 2" in plan and "Join" not in plan
    kept = []
    make = ingestion.materialise
    monkeypatch.setattr(ingestion, "materialise", lambda df, name: kept.append(name) or make(df, name))
    assert QUERIES["s5_rejected_files"](spark, sf).count() == 2
    assert kept == ["lines"]
