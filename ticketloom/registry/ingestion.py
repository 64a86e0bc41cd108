"""Registered queries: file scans, headers, consolidation, agents, run log.

Each writes tickets derived from the tables to fresh files first, then reads
them back through the library's readers.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.constants import NA_TOKENS, SOURCE_COLUMN
from ticketloom.operators import evaluate
from ticketloom.operators.identity import check_identity
from ticketloom.plans import clean
from ticketloom.registry import oracle as o
from ticketloom.registry.catalog import query
from ticketloom.registry.cleaning import team_lists
from ticketloom.session import materialise, scratch_path
from ticketloom.sources.split_csv import parse, read_records
from ticketloom.sources import ingest, runlog
from ticketloom.sources.agents import load_agents
from ticketloom.sources.headers import canonical_columns
from ticketloom.sources.ingest import write_csv

RAW = ["incident_id", "omv", "service", "origine", "description", "traite_par", "cause_reelle"]
# Three layouts of the same seven columns, as they drift between files.
LAYOUTS = {
    "a": ["N° d'Incident", "INTERVENTION OMV", "SERVICE", "ORIGINE", "Description", "Traité par", "Cause réelle"],
    "b": ["numero incident", "omv", "Service", " origine ", "DESCRIPTION", "traite_par", "cause - réelle (2)"],
    "c": ["N°Incident", "Intervention", "service", "Origine", "description", "Incident traité par", "Cause_Reelle"],
}


def raw_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """The seven columns as text with a layout letter; layout c has no handler column."""
    raw = fixtures.incidents(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in RAW])
    letter = F.when(F.pmod(F.col("incident_id").cast("long"), F.lit(3)) == 0, "a").when(
        F.pmod(F.col("incident_id").cast("long"), F.lit(3)) == 1, "b"
    ).otherwise("c")
    return raw.withColumn("layout", letter)


def write_layouts(spark: SparkSession, sf: str) -> str:
    """A folder with CSV files of all three layouts."""
    folder = scratch_path(spark, "raw")
    tickets = raw_tickets(spark, sf)
    for letter, headers in LAYOUTS.items():
        part = tickets.filter(F.col("layout") == letter).drop("layout").toDF(*headers)
        if letter == "c":
            part = part.drop(headers[5])
        write_csv(part, f"{folder}/{letter}")
    return folder


def layout_files(spark: SparkSession, folder: str) -> list[str]:
    return [f for letter in LAYOUTS for f in ingest.list_files(spark, f"{folder}/{letter}", ".csv")]


def na(x: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    return f"CASE WHEN {x} IN ({tokens}) THEN NULL ELSE {x} END"


# Spark's CSV writer leaves a null cell empty; an empty description reads as missing too.
SCAN = "SELECT incident_id::VARCHAR AS incident_id, " + ", ".join(
    f"{na(c)} AS {c}" for c in RAW[1:]
) + " FROM incidents"
CONSOLIDATED = "SELECT incident_id::VARCHAR AS incident_id, " + ", ".join(
    f"coalesce({na(c)}, '') AS {c}" for c in RAW[1:5]
) + f""", CASE WHEN incident_id % 3 = 2 THEN '' ELSE coalesce({na('traite_par')}, '') END AS traite_par,
 coalesce({na('cause_reelle')}, '') AS cause_reelle FROM incidents"""


@query("s1_csv_scan", o.sql(SCAN, "incidents"))
def csv_scan(spark, sf):
    """Quoted cells with line breaks survive; missing tokens become null."""
    folder = scratch_path(spark, "csv")
    write_csv(raw_tickets(spark, sf).drop("layout"), folder)
    files = ingest.list_files(spark, folder, ".csv")
    return ingest.read_csv(spark, files, RAW).select([F.col(f"_c{i}").alias(c) for i, c in enumerate(RAW)])


@query("s1_split_csv_scan", o.sql(SCAN, "incidents"))
def split_csv_scan(spark, sf):
    """The same rows from files that are cut into blocks."""
    folder = scratch_path(spark, "csv")
    # coalesced after the joins, else two tasks would hold the sorted tables of all partitions
    write_csv(materialise(raw_tickets(spark, sf).drop("layout"), "tickets").coalesce(2), folder)
    records, unpaired = read_records(spark, ingest.list_files(spark, folder, ".csv"))
    if unpaired:
        raise ValueError(f"quotes are not paired in {unpaired}")
    cells = parse(records, RAW, ingest.CSV_OPTIONS)
    return cells.select([ingest.missing_as_null(F.col(c)).alias(c) for c in RAW])


@query("s2_csv_or_workbook", o.sql(SCAN, "incidents"))
def csv_or_workbook(spark, sf):
    folder = scratch_path(spark, "csv")
    write_csv(raw_tickets(spark, sf).drop("layout"), folder)
    return ingest.read_tickets_or_workbook(spark, folder, folder + "/absent.xlsx")


def consolidated(spark: SparkSession, sf: str) -> DataFrame:
    files = layout_files(spark, write_layouts(spark, sf))
    tickets, _ = ingest.consolidate_files(spark, files)
    return tickets


@query("s5_rejected_files", """SELECT 'ragged.csv' AS file, 'a row has more cells than the header' AS reason
 UNION ALL SELECT 'absent.csv', 'unreadable'""")
def rejected_files(spark, sf):
    """Beside the good files, one with too long rows and one that does not exist."""
    files = layout_files(spark, write_layouts(spark, sf))
    folder = scratch_path(spark, "ragged")
    lines = raw_tickets(spark, sf).select(
        F.concat_ws(",", "incident_id", F.lit("x"), F.lit("y"), F.lit("z")).alias("value")
    )
    ragged = materialise(lines, "lines").coalesce(1)  # one task, but not for the joins
    head = spark.createDataFrame([("N° d'Incident,SERVICE",)], "value string").coalesce(1)
    head.unionByName(ragged).coalesce(1).write.text(folder)
    path = ingest.list_files(spark, folder, ".txt")[0]
    _, rejected = ingest.consolidate_files(spark, [*files, path, f"{folder}/absent.csv"])
    return rejected.select(
        F.when(F.col("file").endswith(".txt"), "ragged.csv").otherwise(F.col("file")).alias("file"),
        F.when(F.col("file") == "absent.csv", "unreadable").otherwise(F.col("reason")).alias("reason"),
    )


@query("s7_consolidate_headers", o.sql(CONSOLIDATED, "incidents"))
def consolidate_headers(spark, sf):
    return consolidated(spark, sf).drop(SOURCE_COLUMN).toDF(*RAW)


@query("s8_duplicate_headers", o.sql(
    """SELECT incident_id::VARCHAR AS incident_id, coalesce(service, '') AS service, coalesce(origine, '') AS origine
     FROM incidents""", "incidents"))
def duplicate_headers(spark, sf):
    """Of `Service` and `SERVICE` the exact one counts, of `Origine` and `origine` the first."""
    raw = raw_tickets(spark, sf).select(
        "incident_id", F.lit("other").alias("s1"), "service", "origine", F.lit("other").alias("o2")
    )
    headers = ["N° d'Incident", "Service", "SERVICE", "Origine", "origine"]
    out = canonical_columns(raw, headers)
    return out.select(
        F.col("`N° d'Incident`").alias("incident_id"), F.col("SERVICE").alias("service"),
        F.col("ORIGINE").alias("origine"),
    )


@query("s9_canonical_projection", o.sql(
    """SELECT incident_id::VARCHAR AS incident_id, '' AS omv, coalesce(service, '') AS service, '' AS origine,
     '' AS description, '' AS traite_par, coalesce(cause_reelle, '') AS cause_reelle FROM incidents""", "incidents"))
def canonical_projection(spark, sf):
    raw = raw_tickets(spark, sf).select("cause_reelle", "incident_id", "service")
    return canonical_columns(raw, ["Cause réelle", "N° d'Incident", "SERVICE"]).toDF(*RAW)


@query("s10_rows_per_layout", o.sql(
    """SELECT CASE incident_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS layout, count(*) AS n
     FROM incidents GROUP BY 1""", "incidents"))
def rows_per_layout(spark, sf):
    """A6 by S10: rows per source file, summed over each layout's files."""
    folder = write_layouts(spark, sf)
    parts = []
    for letter in LAYOUTS:
        tickets, _ = ingest.consolidate_files(spark, ingest.list_files(spark, f"{folder}/{letter}", ".csv"))
        per_file = ingest.rows_per_source(tickets)
        parts.append(per_file.agg(F.sum("n").alias("n")).select(F.lit(letter).alias("layout"), "n"))
    return ingest.union_all(parts)


@query("s11_union_differing", o.sql(
    """SELECT incident_id, service, NULL::VARCHAR AS urgence FROM incidents WHERE origine IS NULL OR origine < 'C'
     UNION ALL SELECT incident_id, NULL, urgence FROM incidents WHERE origine >= 'C'""", "incidents"))
def union_differing(spark, sf):
    raw = fixtures.incidents(spark, sf)
    early = raw.filter(F.col("origine").isNull() | (F.col("origine") < "C")).select("incident_id", "service")
    late = raw.filter(F.col("origine") >= "C").select("incident_id", "urgence")
    return ingest.union_all([early, late])


@query("s13_agents_from_files", o.sql("SELECT agent, service FROM agents", "agents"))
def agents_from_files(spark, sf):
    """The same dimension through JSON files, one per team list, named in order."""
    folder = scratch_path(spark, "teams")
    lists = team_lists(spark, sf).select(F.format_string("%020d", "doc").alias("doc"), "json")
    # by number, as a team list is so short that adaptive execution would leave a task or two; each
    # task moves its own files into place, where the driver would move one after the other
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists.repartition(tasks, "doc").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(
        "doc").text(folder)
    return load_agents(spark, folder, nested=True)


@query("s17_ticket_identity", o.sql(
    """SELECT coalesce(service_clean, '') AS service, CASE incident_id % 3 WHEN 1 THEN 'repeated' ELSE 'none' END AS numbers,
     count(*) AS tickets, count(*) AS ids FROM clean GROUP BY ALL""", "clean"))
def ticket_identity(spark, sf):
    """Files with blank, repeated and no ticket numbers: every ticket gets an id of its own."""
    folder = scratch_path(spark, "numbers")
    raw = raw_tickets(spark, sf)
    a, b, c = LAYOUTS["a"], LAYOUTS["b"], LAYOUTS["c"]
    files = []
    for letter, headers, number in (("a", a, F.lit("")), ("b", b, F.lit("I-1")), ("c", c, None)):
        part = raw.filter(F.col("layout") == letter).drop("layout")
        part = part.drop("incident_id") if number is None else part.withColumn("incident_id", number)
        write_csv(part.toDF(*(headers if number is not None else headers[1:])), f"{folder}/{letter}")
        files += ingest.list_files(spark, f"{folder}/{letter}", ".csv")
    tickets = clean.clean_columns(ingest.consolidate_files(spark, files)[0].drop(SOURCE_COLUMN))
    # the ids of all files together are distinct, so counting them by group loses nothing
    check_identity(tickets)
    numbers = F.when(F.col("ticket_number") == "I-1", "repeated").otherwise("none")
    return tickets.groupBy(F.coalesce("service_clean", F.lit("")).alias("service"), numbers.alias("numbers")).agg(
        F.count("*").alias("tickets"), F.count_distinct("incident_id").alias("ids"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, target, accuracy, f1_macro): runs are sources, targets differ in their truth."""
    pred = fixtures.run(spark, sf, fixtures.MULTI).join(
        spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("incident_id"), F.col("source").alias("run_id")),
        "incident_id",
    )
    omv = pred.select("run_id", F.lit("OMV").alias("target"), (F.col("y") == "en").alias("y"), (F.col("p") == "en").alias("p"))
    ori = pred.select("run_id", F.lit("ORIGINE").alias("target"), "y", "p")
    both = ingest.union_all([omv.withColumns({c: F.col(c).cast("string") for c in "yp"}), ori])
    return evaluate.summary(both, "run_id", "target")


RUNS = """SELECT run_id, target, avg(CASE WHEN y = p THEN 1.0::DOUBLE ELSE 0 END) AS accuracy, any_value(f1) AS f1_macro
 FROM runs JOIN (SELECT run_id, target, avg(f) AS f1 FROM (
   SELECT run_id, target, c, 2.0::DOUBLE * count(*) FILTER (y = c AND p = c) / (count(*) FILTER (y = c) + count(*) FILTER (p = c)) AS f
   FROM (SELECT run_id, target, y, p, unnest(list_distinct([y, p])) AS c FROM runs) GROUP BY ALL) GROUP BY ALL)
  USING (run_id, target) GROUP BY run_id, target"""
RUN_ROWS = """SELECT d.source AS run_id, t.target, CASE WHEN t.target = 'OMV' THEN (m.y = 'en')::VARCHAR ELSE m.y END AS y,
  CASE WHEN t.target = 'OMV' THEN (m.p = 'en')::VARCHAR ELSE m.p END AS p
 FROM multi_pred m JOIN documents d ON d.doc_id = m.incident_id, (VALUES ('OMV'), ('ORIGINE')) t(target)"""


@query("s14_run_log_wide", o.sql(
    """SELECT run_id, round(max(accuracy) FILTER (target = 'OMV'), 6) AS omv_acc, round(max(f1_macro) FILTER (target = 'OMV'), 6) AS omv_f1,
     NULL::DOUBLE AS svc_acc, NULL::DOUBLE AS svc_f1,
     round(max(accuracy) FILTER (target = 'ORIGINE'), 6) AS ori_acc, round(max(f1_macro) FILTER (target = 'ORIGINE'), 6) AS ori_f1
     FROM metrics GROUP BY run_id""", "multi_pred", runs=RUN_ROWS, metrics=RUNS))
def run_log_wide(spark, sf):
    wide = runlog.wide_metrics(run_metrics(spark, sf), "run_id")
    return wide.select("run_id", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


@query("s14_run_log_append", o.sql(
    """SELECT '20260102_030405' AS run_id, 'batch' AS pipeline,
     printf('%.4f', avg((y = p)::INT)) AS omv_acc, 'N/A' AS svc_acc FROM binary_pred""", "binary_pred"))
def run_log_append(spark, sf):
    """One run written to a new log and read back for printing."""
    metrics = evaluate.summary(fixtures.run(spark, sf, fixtures.BINARY)).first().asDict()
    path = scratch_path(spark, "runs")
    runlog.log_run(
        spark, path, [runlog.Measured("OMV", metrics["accuracy"], metrics["f1_macro"])], "batch", "linear",
        now=datetime(2026, 1, 2, 3, 4, 5),
    )
    return runlog.printable(runlog.read_log(spark, path)).select("run_id", "pipeline", "omv_acc", "svc_acc")


@query("j7_gain_over_baseline", o.sql(
    """SELECT b.target, round(m.f1_macro, 6) AS f1_macro, b.baseline_f1,
     coalesce(CASE WHEN g >= 0 THEN '+' ELSE '-' END || printf('%.3f', abs(g)), '—') AS gain
     FROM (VALUES ('OMV', 0.99::DOUBLE), ('SERVICE', 0.665::DOUBLE), ('ORIGINE', 0.752::DOUBLE)) b(target, baseline_f1)
     LEFT JOIN (SELECT target, max(f1_macro) AS f1_macro FROM metrics GROUP BY target) m ON m.target = b.target,
     LATERAL (SELECT round(m.f1_macro - b.baseline_f1, 3) AS g)""", "multi_pred", runs=RUN_ROWS, metrics=RUNS))
def gain_over_baseline(spark, sf):
    best = run_metrics(spark, sf).groupBy("target").agg(F.max("f1_macro").alias("f1_macro"))
    return runlog.against_baseline(best).withColumn("f1_macro", F.round("f1_macro", 6))


@query("p11_one_ticket", o.sql("SELECT incident_id, demandeur FROM clean WHERE incident_id = (SELECT max(incident_id) FROM clean)", "clean"))
def one_ticket(spark, sf):
    """The ticket the user points at: here the newest."""
    from ticketloom.operators.filters import one_ticket as pick

    raw = fixtures.incidents(spark, sf)
    newest = raw.agg(F.max("incident_id")).first()[0]
    return clean.clean_columns(pick(raw, newest)).select("incident_id", "demandeur")


