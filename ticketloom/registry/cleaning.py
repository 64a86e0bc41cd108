"""Registered queries: cleaning, rules, filters, lookup, aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.constants import CELL_REPAIRS, ORIGINE_SPELLING, SERVICE_SPELLING
from ticketloom.functions import fields
from ticketloom.functions import text as tx
from ticketloom.operators import evaluate, filters
from ticketloom.operators.joins import lookup_service, service_decision
from ticketloom.plans import clean
from ticketloom.registry import oracle as o
from ticketloom.registry.catalog import kept, query
from ticketloom.session import materialise
from ticketloom.sources.agents import agent_services, team_members
from ticketloom.sources.ingest import repair_cells
from ticketloom.sources.requests import decode_requests, encode_request


def team_lists(spark: SparkSession, sf: str) -> DataFrame:
    """(doc, json): team lists as JSON objects of at most 50 customers each.

    Teams late in the alphabet are objects with a manager, the others plain lists.
    """
    lines = fixtures.run(spark, sf, fixtures.AGENT_LINES).withColumn(
        "doc", F.col("pos") * 1_000_000_000 + F.floor(F.col("custkey") / 50)
    )
    teams = lines.groupBy("doc", "service").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("custkey", "agent"))), lambda a: a["agent"]
        ).alias("names")
    )
    managed = F.to_json(F.struct(
        F.slice("names", F.lit(1), F.size("names") - 1).alias("membres"),
        F.element_at("names", -1).alias("responsable"),
    ))
    value = F.when(F.col("service") > "M", managed).otherwise(F.to_json("names"))
    member = F.concat(
        F.lit('"'), F.replace("service", F.lit(" "), F.lit("_")), F.lit('": '), value
    )
    return teams.groupBy("doc").agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(member)), ", "), F.lit("}"))
        .alias("json")
    )


def agents(spark: SparkSession, sf: str) -> DataFrame:
    return agent_services(team_members(team_lists(spark, sf)))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned tickets without the lookup."""
    return clean.clean_columns(fixtures.incidents(spark, sf))


def tickets_table(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned tickets with the lookup as a written table, once per session and scale.

    Features, splits and models start here, so their filters and columns reach the file scan.
    """
    return kept(spark, sf, "tickets", lambda: materialise(looked_up(spark, sf), "tickets"))


def looked_up(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_tickets(fixtures.incidents(spark, sf), agents(spark, sf))


def column_query(name: str, source: str, spark_column, sql_column: str, out: str = "value"):
    """Register one cleaning expression over the raw incidents."""

    @query(name, o.sql(f"SELECT incident_id, {sql_column} AS {out} FROM incidents", "incidents"))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = fixtures.incidents(spark, sf)
        return raw.select("incident_id", spark_column(F.col(source)).alias(out))

    return run


# --- scalar cleaning --------------------------------------------------------------

column_query("c1_normalise_label", "cause_reelle", tx.label, o.label("cause_reelle"))
column_query("c2_normalise_text", "description", tx.free_text, o.text("description"))
column_query("c3_edge_label", "cause_reelle", tx.edge_label, o.edge_label("cause_reelle"))
column_query(
    "c4_plain_label", "service", lambda c: tx.plain_label(c, "INCONNU"),
    "upper(" + o.strip("coalesce(service, 'INCONNU')") + ")",
)
column_query("c6_requester_name", "demandeur", fields.requester, o.requester("demandeur"))
column_query("c9_city", "description", lambda c: fields.city(tx.free_text(c)), o.city(o.text("description")))
column_query("p8_business_rule", "description", fields.is_ruled_out, o.ruled("description"))


@query("c5_spelling", o.sql(
    f"""SELECT incident_id, {o.respell('(' + o.label('origine') + ')', ORIGINE_SPELLING)} AS origine,
     {o.respell('(' + o.label('service') + ')', SERVICE_SPELLING)} AS service FROM incidents""", "incidents"))
def spelling(spark, sf):
    raw = fixtures.incidents(spark, sf)
    return raw.select(
        "incident_id",
        tx.respell(tx.label(F.col("origine")), ORIGINE_SPELLING).alias("origine"),
        tx.respell(tx.label(F.col("service")), SERVICE_SPELLING).alias("service"),
    )


@query("c7_agent_name", o.sql(
    f"""SELECT custkey, pos, upper({o.strip("regexp_replace(agent, '[*#]+', '', 'g')")}) AS agent
     FROM ({fixtures.oracle_text(fixtures.AGENT_LINES)})"""))
def agent_name(spark, sf):
    lines = fixtures.run(spark, sf, fixtures.AGENT_LINES)
    return lines.select("custkey", "pos", fields.agent(F.col("agent")).alias("agent"))


@query("c8_strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def accents(spark, sf):
    docs = fixtures.read_table(spark, f"{sf}/documents.parquet")
    return docs.select("doc_id", tx.strip_accents(F.col("text")).alias("plain"))


@query("c10_urgency", o.sql(
    f"""SELECT incident_id, {o.urgency('urgence')} AS urgence_num, CASE WHEN {o.urgency('urgence')} >= 0
     THEN CAST(CAST({o.urgency('urgence')} AS INT) AS VARCHAR) ELSE 'INCONNU' END AS urgence_cat
     FROM incidents""", "incidents"))
def urgency(spark, sf):
    number = fields.urgency_number(F.col("urgence"))
    return fixtures.incidents(spark, sf).select(
        "incident_id", number.alias("urgence_num"), fields.urgency_category(number).alias("urgence_cat")
    )


@query("c11_cause_handler", o.sql(
    f"""SELECT incident_id, coalesce({o.label('cause_reelle')}, 'INCONNU') AS cause,
     coalesce({o.label('traite_par')}, 'INCONNU') AS traite FROM incidents""", "incidents"))
def cause_handler(spark, sf):
    return fixtures.incidents(spark, sf).select(
        "incident_id",
        fields.with_default(F.col("cause_reelle")).alias("cause"),
        fields.with_default(F.col("traite_par")).alias("traite"),
    )


@query("c12_serving_fields", o.sql(
    f"""SELECT incident_id,
     CASE WHEN coalesce(cause_reelle, '') = '' THEN 'INCONNU' ELSE upper({o.strip('cause_reelle')}) END AS cause,
     CASE WHEN coalesce(traite_par, '') = '' THEN 'INCONNU' ELSE upper({o.strip('traite_par')}) END AS traite,
     coalesce(nullif(CASE WHEN strpos(demandeur, ',') > 0 THEN {o.requester('demandeur')}
      ELSE upper({o.strip("coalesce(demandeur, 'INCONNU')")}) END, ''), 'INCONNU') AS demandeur
     FROM incidents""", "incidents"))
def serving_fields(spark, sf):
    served = clean.clean_columns(fixtures.incidents(spark, sf), serving=True)
    return served.select("incident_id", "cause", "traite", "demandeur")


@query("c13_percent", """SELECT doc_id, round(p * 100, 1) AS confidence, round(p, 4) AS probabilite
 FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) / (n_chars + 997) AS p FROM documents)""")
def percent(spark, sf):
    p = F.col("n_chars").cast("double") / (F.col("n_chars") + 997)
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", fields.percent(p).alias("confidence"), F.round(p, 4).alias("probabilite")
    )


@query("c14_binary_confidence", """SELECT doc_id, CASE WHEN p >= 0.5 THEN 'OUI' ELSE 'NON' END AS prediction,
 round(greatest(p, 1 - p) * 100, 1) AS confidence
 FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) / (n_chars + 997) AS p FROM documents)""")
def binary_confidence(spark, sf):
    p = F.col("n_chars").cast("double") / (F.col("n_chars") + 997)
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.when(p >= 0.5, "OUI").otherwise("NON").alias("prediction"),
        fields.percent(F.greatest(p, 1 - p)).alias("confidence"),
    )


@query("c15_request_decode", o.sql(
    """SELECT incident_id, coalesce(description, '') AS description, coalesce(demandeur, '') AS demandeur,
     coalesce(cause_reelle, '') AS cause, coalesce(traite_par, '') AS traite,
     coalesce(urgence, '') AS urgence, false AS is_error FROM incidents""", "incidents"))
def request_decode(spark, sf):
    tickets = clean.resolve_fields(fixtures.incidents(spark, sf))
    return decode_requests(encode_request(tickets)).drop("body")


# --- whole tickets -----------------------------------------------------------------

@query("clean_tickets", o.sql("SELECT * FROM clean", "clean"))
def clean_tickets(spark, sf):
    return looked_up(spark, sf)


@query("c3_clean_for_cascade", o.sql(
    f"""SELECT incident_id, coalesce(description, '') AS description,
     {o.yes_no('(' + o.edge_label('omv') + ')')} AS omv,
     {o.respell('(' + o.edge_label('service') + ')', SERVICE_SPELLING)} AS service_clean,
     {o.respell('(' + o.edge_label('origine') + ')', ORIGINE_SPELLING)} AS origine_clean,
     {o.edge_label('cause_reelle')} AS cause, {o.edge_label('traite_par')} AS traite FROM incidents""", "incidents"))
def clean_for_cascade(spark, sf):
    return clean.clean_for_cascade(fixtures.incidents(spark, sf))


@query("c4_clean_for_multi", o.sql(
    f"""SELECT incident_id, coalesce(description, '') AS description,
     {o.respell('upper(' + o.strip('service') + ')', SERVICE_SPELLING)} AS service_clean,
     {o.respell('upper(' + o.strip('origine') + ')', ORIGINE_SPELLING)} AS origine_clean FROM incidents""", "incidents"))
def clean_for_multi(spark, sf):
    return clean.clean_for_multi(fixtures.incidents(spark, sf))


@query("p6_column_fallback", o.sql("SELECT incident_id, omv, service_clean AS service, origine_clean AS origine FROM clean", "clean"))
def column_fallback(spark, sf):
    """The clean names stand in where the raw headers are absent."""
    only_clean = tickets_table(spark, sf).select("incident_id", "omv", "service_clean", "origine_clean")
    return clean.resolve_fields(only_clean).select("incident_id", "omv", "service", "origine")


@query("p7_binary_target", o.sql("SELECT incident_id, CASE WHEN omv = 'OUI' THEN 1 ELSE 0 END AS target FROM incidents", "incidents"))
def binary_target(spark, sf):
    return clean.clean_for_binary(fixtures.incidents(spark, sf)).select("incident_id", "target")


@query("s16_repair_cells", o.sql(
    """SELECT incident_id, """ + ", ".join(
        o.respell(c, CELL_REPAIRS) + f" AS {c}" for c in ("omv", "service", "origine")
    ) + """ FROM (SELECT incident_id, omv, origine,
     CASE WHEN service < 'F' THEN 'SER I' WHEN service < 'J' THEN 'SERC' ELSE service END AS service FROM incidents)""", "incidents"))
def repair(spark, sf):
    service = F.when(F.col("service") < "F", "SER I").when(F.col("service") < "J", "SERC")
    raw = fixtures.incidents(spark, sf).select(
        "incident_id", "omv", "origine", service.otherwise(F.col("service")).alias("service")
    )
    return repair_cells(raw)


# --- agents, lookup --------------------------------------------------------------------

@query("s13_agent_dimension", o.sql("SELECT agent, service FROM agents", "agents"))
def agent_dimension(spark, sf):
    return agents(spark, sf)


@query("j1_lookup_service", o.sql("SELECT incident_id, demandeur, service_deterministe FROM clean", "clean"))
def lookup(spark, sf):
    tickets = cleaned(spark, sf).select("incident_id", "demandeur")
    return lookup_service(tickets, agents(spark, sf))


@query("j1_lookup_service_salted", o.sql("SELECT incident_id, demandeur, service_deterministe FROM clean", "clean"))
def lookup_salted(spark, sf):
    """The same lookup on the path for an agent table too large to broadcast."""
    tickets = cleaned(spark, sf).select("incident_id", "demandeur")
    return lookup_service(tickets, agents(spark, sf), small=False)


@query("j2_service_decision", o.sql(
    """SELECT incident_id, coalesce(nullif(service_deterministe, ''), 'TOUS') AS service,
     CASE WHEN coalesce(service_deterministe, '') <> '' THEN 'deterministe' ELSE 'tous' END AS source,
     100.0::DOUBLE AS confidence FROM clean""", "clean"))
def decision(spark, sf):
    service, source = service_decision(F.col("service_deterministe"))
    return lookup(spark, sf).select(
        "incident_id", service.alias("service"), source.alias("source"),
        F.lit(100.0).alias("confidence"),
    )


@query("j3_cascade_alignment", o.sql(
    """SELECT c.incident_id, c.origine_clean, coalesce(p.omv_pred, 'INCONNU') AS omv_pred FROM clean c
     LEFT JOIN (SELECT incident_id, CASE WHEN length(description) % 2 = 0 THEN 'OUI' ELSE 'NON' END AS omv_pred
      FROM clean WHERE omv IS NOT NULL AND description <> '') p ON p.incident_id = c.incident_id
     WHERE c.origine_clean IS NOT NULL""", "clean"))
def cascade_alignment(spark, sf):
    from ticketloom.plans.training import align_omv

    tickets = tickets_table(spark, sf).select("incident_id", "origine_clean", "omv", "description")
    predicted = filters.trainable(tickets, "omv").select(
        "incident_id",
        F.when(F.length("description") % 2 == 0, "OUI").otherwise("NON").alias("omv_pred"),
    )
    return align_omv(
        tickets.filter(F.col("origine_clean").isNotNull()).select("incident_id", "origine_clean"),
        predicted,
    ).fillna("INCONNU", ["omv_pred"])


# --- filters -----------------------------------------------------------------------------

@query("p1_trainable_rows", o.sql("SELECT incident_id, omv FROM clean WHERE omv IS NOT NULL AND description <> ''", "clean"))
def trainable_rows(spark, sf):
    return filters.trainable(tickets_table(spark, sf), "omv").select("incident_id", "omv")


@query("p2_label_domain", o.sql(f"SELECT incident_id, {o.yes_no('(' + o.label('omv') + ')')} AS omv FROM incidents", "incidents"))
def label_domain(spark, sf):
    raw = fixtures.incidents(spark, sf)
    return raw.select("incident_id", fields.yes_no(tx.label(F.col("omv"))).alias("omv"))


@query("p3_conditional_population", o.sql(
    "SELECT incident_id, origine_clean FROM clean WHERE origine_clean IS NOT NULL AND omv = 'OUI' AND description <> ''", "clean"))
def conditional_population(spark, sf):
    return filters.trainable(tickets_table(spark, sf), "origine_clean", only_yes=True).select(
        "incident_id", "origine_clean"
    )


MIN_CLASS = 30


@query("p4_frequent_classes", o.sql(
    f"""SELECT incident_id, service_clean FROM (SELECT *, count(*) OVER (PARTITION BY service_clean) AS n
     FROM clean WHERE service_clean IS NOT NULL AND description <> '') WHERE n >= {MIN_CLASS}""", "clean"))
def frequent(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "service_clean").select("incident_id", "service_clean")
    return filters.frequent_classes(rows, "service_clean", MIN_CLASS)


@query("p4_class_filter_report", o.sql(
    f"""SELECT CAST(coalesce(sum(n) FILTER (n >= {MIN_CLASS}), 0) AS BIGINT) AS kept_rows,
     count(*) FILTER (n >= {MIN_CLASS}) AS kept_classes,
     CAST(coalesce(sum(n) FILTER (n < {MIN_CLASS}), 0) AS BIGINT) AS dropped_rows
     FROM (SELECT service_clean, count(*) AS n FROM clean WHERE service_clean IS NOT NULL AND description <> ''
      GROUP BY service_clean)""", "clean"))
def filter_report(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "service_clean")
    return filters.class_filter_report(rows, "service_clean", MIN_CLASS)


@query("p5_rare_classes", o.sql(
    f"""SELECT service_clean, count(*) AS n FROM clean WHERE service_clean IS NOT NULL AND description <> ''
     GROUP BY service_clean HAVING count(*) < {MIN_CLASS}""", "clean"))
def rare(spark, sf):
    rows = filters.trainable(tickets_table(spark, sf), "service_clean")
    return filters.rare_classes(rows, "service_clean", MIN_CLASS)


@query("j6_class_membership", o.sql(
    f"""SELECT c.incident_id, c.service_clean, CASE WHEN c.service_clean IN (SELECT service_clean FROM clean
      GROUP BY service_clean HAVING count(*) >= {MIN_CLASS}) THEN 'kept' ELSE 'dropped' END AS part
     FROM clean c WHERE c.service_clean IS NOT NULL""", "clean"))
def membership(spark, sf):
    from ticketloom.operators.ranking import class_join

    rows = tickets_table(spark, sf).select("incident_id", "service_clean").filter("service_clean IS NOT NULL")
    valid = filters.class_counts(rows, "service_clean").filter(F.col("n") >= MIN_CLASS).select("service_clean")
    kept = class_join(rows, valid, "service_clean", "left_semi").withColumn("part", F.lit("kept"))
    dropped = class_join(rows, valid, "service_clean", "left_anti").withColumn("part", F.lit("dropped"))
    return kept.unionByName(dropped)


@query("p9_unlabelled_rows", o.sql(
    "SELECT incident_id FROM incidents WHERE trim(coalesce(omv, '')) = '' AND trim(coalesce(description, '')) <> ''", "incidents"))
def unlabelled(spark, sf):
    return filters.unlabelled(fixtures.incidents(spark, sf)).select("incident_id")


@query("p10_rows_with_text", o.sql("SELECT incident_id FROM incidents WHERE trim(coalesce(description, '')) <> ''", "incidents"))
def rows_with_text(spark, sf):
    return filters.with_text(fixtures.incidents(spark, sf)).select("incident_id")


# --- aggregates ------------------------------------------------------------------------------

@query("a1_class_counts", o.sql("SELECT origine_clean, count(*) AS n FROM clean GROUP BY origine_clean", "clean"))
def class_counts(spark, sf):
    return filters.class_counts(tickets_table(spark, sf), "origine_clean")


@query("a2_distinct_classes", o.sql(
    "SELECT count(DISTINCT service_clean) AS service_classes, count(DISTINCT origine_clean) AS origine_classes FROM clean", "clean"))
def distinct_classes(spark, sf):
    return tickets_table(spark, sf).agg(
        F.count_distinct("service_clean").alias("service_classes"),
        F.count_distinct("origine_clean").alias("origine_classes"),
    )


SKETCHED = ["service_clean", "origine_clean", "demandeur", "cause"]


@query("a2_distinct_sketches", o.sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n, true AS close FROM clean" for c in SKETCHED), "clean"))
def distinct_sketches(spark, sf):
    """Distinct values by sketches of eight parts, merged; `close` says whether within the stated error."""
    tickets = tickets_table(spark, sf)
    parts = tickets.withColumn("part", F.pmod(F.xxhash64("incident_id"), F.lit(8)))
    sketches = evaluate.distinct_sketches(parts, SKETCHED, "part")
    exact = tickets.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in SKETCHED])))
    error = F.abs(F.col("estimate") - F.col("n"))
    return exact.join(evaluate.distinct_estimates(sketches), "column_name").select(
        "column_name", "n", (error <= F.greatest(F.lit(0.5), evaluate.SKETCH_ERROR * F.col("n"))).alias("close"))


@query("a3_label_balance", o.sql(
    """SELECT count(*) AS n, count(*) FILTER (omv = 'OUI') AS n_yes, count(*) FILTER (omv = 'NON') AS n_no,
     round(count(*) FILTER (omv = 'OUI')::DOUBLE / count(*), 6) AS share_yes,
     round(count(*) FILTER (omv = 'NON')::DOUBLE / count(*), 6) AS share_no
     FROM clean WHERE omv IS NOT NULL AND description <> ''""", "clean"))
def balance(spark, sf):
    out = evaluate.label_balance(filters.trainable(tickets_table(spark, sf), "omv"))
    return out.withColumns({c: F.round(c, 6) for c in ("share_yes", "share_no")})


@query("a4_lookup_coverage", o.sql(
    """SELECT count(*) AS n, count(service_deterministe) AS known, count(*) - count(service_deterministe) AS unknown,
     round(count(service_deterministe)::DOUBLE * 100 / count(*), 6) AS pct_known,
     round(100 - count(service_deterministe)::DOUBLE * 100 / count(*), 6) AS pct_unknown FROM clean""", "clean"))
def coverage(spark, sf):
    out = evaluate.lookup_coverage(lookup(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("pct_known", "pct_unknown")})


@query("a5_labelled_counts", o.sql(
    "SELECT count(service_clean) AS n_service_clean, count(origine_clean) AS n_origine_clean FROM clean", "clean"))
def labelled(spark, sf):
    return evaluate.labelled_counts(tickets_table(spark, sf), "service_clean", "origine_clean")
