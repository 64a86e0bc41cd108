"""Building blocks of the checking SQL, written apart from the library's expressions."""

from __future__ import annotations

from ticketloom import fixtures
from ticketloom.constants import (
    CITIES, ORIGINE_SPELLING, SERVICE_SPELLING, STOP_WORDS,
)

WS = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
EDGE = r"[^\p{L}\p{N}_]"


def text(x: str) -> str:
    return f"trim(regexp_replace(replace(coalesce({x}, ''), '_x000D_', ' '), '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


def label(x: str) -> str:
    return f"CASE WHEN upper({text(x)}) NOT IN ('', 'NAN', 'NONE') THEN upper({text(x)}) END"


def edge_label(x: str) -> str:
    return f"nullif(upper({strip(x)}), 'NAN')"


def respell(x: str, spellings: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in spellings.items())
    return f"CASE {x} {cases} ELSE {x} END"


def yes_no(x: str) -> str:
    return f"CASE WHEN {x} IN ('OUI', 'NON') THEN {x} END"


def requester(x: str) -> str:
    name = strip(x)
    comma = f"strpos({name}, ',')"
    first, last = strip(f"substr({name}, {comma} + 1)"), strip(f"substr({name}, 1, {comma} - 1)")
    return (
        f"CASE WHEN {x} IS NULL OR {name} = '' THEN 'INCONNU' "
        f"WHEN {comma} > 0 THEN upper({first} || ' ' || {last}) ELSE upper({name}) END"
    )


def city(x: str) -> str:
    found = f"regexp_extract(upper({x}), '(?:^|{EDGE})({'|'.join(CITIES)})(?:{EDGE}|$)', 1)"
    return f"coalesce(nullif({found}, ''), 'NON_PRECISEE')"


def urgency(x: str) -> str:
    return f"coalesce(TRY_CAST(nullif(regexp_extract(coalesce({label(x)}, ''), '[0-9]'), '') AS DOUBLE), -1.0::DOUBLE)"


def ruled(x: str) -> str:
    words = f"pf5|mot{WS}+de{WS}+passe|password|mdp"
    return f"regexp_matches(lower(coalesce({x}, '')), '(?:^|{EDGE})(?:{words})(?:{EDGE}|$)')"


AGENTS = rf"""
SELECT agent, max_by(service, place) AS service FROM (
 SELECT unnest([name, strip_accents(name)]) AS agent, replace(service, '_', ' ') AS service,
  {{'a': pos, 'b': custkey // 50, 'c': service, 'd': custkey}} AS place
 FROM (SELECT custkey, service, pos,
   upper({strip("regexp_replace(agent, '[*#]+', '', 'g')")}) AS name
  FROM ({fixtures.oracle_text(fixtures.AGENT_LINES)})) WHERE name <> ''
) GROUP BY agent
"""

CLEAN = f"""
SELECT c.*, coalesce(a.service, b.service) AS service_deterministe FROM (
 SELECT incident_id, {text("description")} AS description,
  {yes_no("(" + label("omv") + ")")} AS omv,
  {respell("(" + label("service") + ")", SERVICE_SPELLING)} AS service_clean,
  {respell("(" + label("origine") + ")", ORIGINE_SPELLING)} AS origine_clean,
  coalesce({label("cause_reelle")}, 'INCONNU') AS cause,
  coalesce({label("traite_par")}, 'INCONNU') AS traite,
  {requester("demandeur")} AS demandeur,
  {city(text("description"))} AS ville,
  {urgency("urgence")} AS urgence_num,
  CASE WHEN {urgency("urgence")} >= 0 THEN CAST(CAST({urgency("urgence")} AS INT) AS VARCHAR)
   ELSE 'INCONNU' END AS urgence_cat
 FROM incidents) c
LEFT JOIN agents a ON a.agent = c.demandeur AND c.demandeur <> 'INCONNU'
LEFT JOIN agents b ON b.agent = strip_accents(c.demandeur) AND c.demandeur <> 'INCONNU'
"""


def grams(low: int, high: int, stops: bool, accents: bool, source: str = "clean") -> str:
    """(incident_id, term), one row per occurrence."""
    folded = "lower(description)" if accents else "strip_accents(lower(description))"
    found = f"regexp_extract_all({folded}, '[\\p{{L}}\\p{{N}}_]{{2,}}')"
    listed = ", ".join(f"'{w}'" for w in STOP_WORDS)
    keep = f"WHERE w NOT IN ({listed})" if stops else ""
    parts = {
        1: "SELECT incident_id, w AS term FROM kept",
        2: "SELECT incident_id, w || ' ' || w2 FROM kept WHERE w2 IS NOT NULL",
        3: "SELECT incident_id, w || ' ' || w2 || ' ' || w3 FROM kept WHERE w3 IS NOT NULL",
    }
    chosen = [parts[n] for n in range(low, high + 1)]
    chosen[0] = chosen[0] if low == 1 else chosen[0].replace("w3 FROM", "w3 AS term FROM").replace("w2 FROM", "w2 AS term FROM")
    return f"""
 WITH words AS (SELECT incident_id, unnest({found}) AS w, generate_subscripts({found}, 1) AS i FROM {source}),
 kept AS (SELECT incident_id, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM words {keep} WINDOW o AS (PARTITION BY incident_id ORDER BY i))
 {" UNION ALL ".join(chosen)}"""


COUNTS = "SELECT incident_id, term, count(*) AS tf FROM grams GROUP BY incident_id, term"


def vocab(min_df: int, max_features: int) -> str:
    return f"""
 SELECT term, df, ctf, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM counts GROUP BY term
  HAVING count(*) >= {min_df} ORDER BY ctf DESC, term LIMIT {max_features}),
 (SELECT count(*) AS n FROM docs)"""


WEIGHTS = """
 SELECT incident_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY incident_id)) AS weight
 FROM (SELECT c.incident_id, c.term, (1.0 + ln(c.tf::DOUBLE)) * v.idf AS raw
  FROM counts c JOIN vocab v ON v.term = c.term)"""

BASE = {
    "incidents": fixtures.oracle_text(fixtures.INCIDENTS),
    "agents": AGENTS,
    "clean": CLEAN,
    "binary_pred": fixtures.oracle_text(fixtures.BINARY),
    "multi_pred": fixtures.oracle_text(fixtures.MULTI),
}


def sql(body: str, *names: str, **ctes: str) -> str:
    """`body` after the named base tables and the given ones, in order."""
    needed = list(names)
    if "clean" in needed:
        needed = ["incidents", "agents", *[n for n in needed if n not in ("incidents", "agents")]]
    tables = {n: BASE[n] for n in needed} | ctes
    listed = ", ".join(f"{n} AS MATERIALIZED ({t})" for n, t in tables.items())
    return f"WITH {listed} {body}" if tables else body
