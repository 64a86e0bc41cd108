"""Incident tickets, agents and predictions derived from the given tables.

Each text is one SQL statement that Spark and the checking engine both run;
`{documents}` and the like stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.operators.joins import is_small
from ticketloom.session import read_table

TABLES = ["documents", "labels", "orders", "customer", "nation"]

INCIDENTS = """
SELECT d.doc_id AS incident_id,
 CASE WHEN d.doc_id % 23 = 0 THEN '' ELSE d.text
  || CASE WHEN d.doc_id % 3 = 0 THEN ' Assuré de ' || CASE d.doc_id % 4 WHEN 0 THEN 'Paris' WHEN 1 THEN 'Lyon' WHEN 2 THEN 'Nancy' ELSE 'Parisot' END || '.' ELSE '' END
  || CASE WHEN d.doc_id % 13 = 0 THEN ' Blocage pf5.' WHEN d.doc_id % 19 = 0 THEN ' Mot  de passe.' ELSE '' END END AS description,
 CASE WHEN d.doc_id % 17 = 0 THEN 'peut-être' WHEN l.quality = 1 THEN CASE WHEN d.doc_id % 5 = 0 THEN ' oui ' ELSE 'OUI' END WHEN l.quality = 0 THEN 'Non' END AS omv,
 n.n_name AS service,
 CASE d.lang WHEN 'fr' THEN CASE WHEN d.doc_id % 2 = 0 THEN 'base de donnees' ELSE 'BASE DE DONNÉES' END WHEN 'en' THEN 'PARAMETRAGE' WHEN 'de' THEN 'telephone' ELSE 'PROGRAMME' END AS origine,
 c.c_mktsegment AS traite_par,
 CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 7 = 0 THEN 'none' ELSE '  cause_x000D_' || d.source || ' ' END AS cause_reelle,
 o.o_orderpriority AS urgence,
 CASE WHEN c.c_custkey % 10 = 9 THEN ' ' WHEN c.c_custkey % 2 = 0 THEN replace(c.c_name, '#', ', é') ELSE c.c_name END AS demandeur
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id LEFT JOIN {orders} o ON o.o_orderkey = d.doc_id
 LEFT JOIN {customer} c ON c.c_custkey = o.o_custkey LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""

# Agents as they stand in the team list: every third customer, the name in the
# form a cleaned requester takes, some without the accent, some with a mark.
# A sixth of them is listed again under the next team, which then counts.
AGENT_LINES = """
SELECT a.custkey AS custkey, s.n_name AS service, a.name AS agent, a.pos AS pos FROM (
 SELECT c_custkey AS custkey, c_nationkey AS nationkey, 0 AS pos,
  CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'E' ELSE 'É' END || split_part(c_name, '#', 2) || ' ' || split_part(c_name, '#', 1) ELSE replace(c_name, '#', '') END
  || CASE WHEN c_custkey % 5 = 0 THEN ' *' ELSE '' END AS name
 FROM {customer} WHERE c_custkey % 3 = 0
 UNION ALL
 SELECT c_custkey, (c_nationkey + 1) % 25, 1,
  CASE WHEN c_custkey % 4 = 0 THEN 'E' ELSE 'É' END || split_part(c_name, '#', 2) || ' ' || split_part(c_name, '#', 1)
 FROM {customer} WHERE c_custkey % 6 = 0
) a JOIN {nation} s ON s.n_nationkey = a.nationkey
"""

# Binary truth, prediction and score per labelled document.
BINARY = """
SELECT d.doc_id AS incident_id, CAST(l.quality AS INT) AS y, CAST(l.toxic AS INT) AS p,
 CAST((d.n_chars * 7919 + d.doc_id * 31) % 997 AS DOUBLE) / 997 + 0.3 * l.quality AS score
FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id
"""

# Multi-class truth and prediction: the language, against a language disturbed by a hash.
MULTI = """
SELECT doc_id AS incident_id, lang AS y,
 CASE WHEN substr(md5(CAST(doc_id AS STRING)), 1, 1) IN ('0', '1', '2') THEN 'en'
  WHEN substr(md5(CAST(doc_id AS STRING)), 1, 1) IN ('3', '4') THEN 'fr'
  WHEN substr(md5(CAST(doc_id AS STRING)), 1, 1) = '5' THEN 'xx'
  WHEN lang = 'es' THEN 'de' ELSE lang END AS p
FROM {documents}
"""


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts over the tables of `sf_dir`.

    Spark broadcasts a joined table by the size of its file, which may hold 20 times as much in
    memory; one of more rows than `joins.BROADCAST_ROWS` meets the others by sort-merge.
    """
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    used = {t: df if t in ("documents", "nation") or is_small(df) else df.hint("merge") for t, df in used.items()}
    if "documents" in used:  # the table whose texts cost time
        used["documents"] = read_table(spark, f"{sf_dir}/documents.parquet")
    return spark.sql(text, **used)


def oracle_text(text: str) -> str:
    """The same text over plainly named tables."""
    return text.format(**{t: t for t in TABLES})


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, INCIDENTS)
