"""The agent dimension: JSON team lists to (agent, service)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.fields import agent
from ticketloom.functions.text import strip_accents


def read_team_lists(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """(doc, json): one row per JSON file, in file-name order.

    With `nested` the files of all folders below `path`, which tasks list and not the driver.
    """
    return spark.read.text(path, wholetext=True, recursiveFileLookup=nested).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("json")
    )


def team_members(lists: DataFrame) -> DataFrame:
    """(doc, service, service_pos, member_pos, agent) in document order.

    A team is a list of agents, or an object with `membres` and a `responsable`
    who comes last. The values stay raw JSON first, which keeps their order.
    """
    teams = lists.select(
        "doc", F.from_json("json", "map<string,string>").alias("teams")
    ).select(
        "doc",
        F.posexplode(F.map_entries("teams")).alias("service_pos", "team"),
    )
    raw = F.ltrim(F.col("team.value"))
    as_object = F.from_json(raw, "membres array<string>, responsable string")
    members = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).when(
        raw.startswith("{"),
        F.concat(
            F.coalesce(as_object["membres"], F.array().cast("array<string>")),
            F.filter(F.array(as_object["responsable"]), lambda x: x.isNotNull()),
        ),
    )
    return teams.select(
        "doc",
        "service_pos",
        F.replace(F.col("team.key"), F.lit("_"), F.lit(" ")).alias("service"),
        members.alias("members"),
    ).select(
        "doc", "service", "service_pos",
        F.posexplode("members").alias("member_pos", "agent"),
    )


def agent_services(members: DataFrame) -> DataFrame:
    """(agent, service): each clean name and its accent-free form; the last entry wins."""
    named = members.withColumn("_clean", agent(F.col("agent"))).filter(F.col("_clean") != "")
    forms = F.array_distinct(F.array("_clean", strip_accents(F.col("_clean"))))
    place = F.struct("doc", "service_pos", "member_pos")
    return (
        named.select(F.explode(forms).alias("agent"), "service", place.alias("_place"))
        .groupBy("agent")
        .agg(F.max_by("service", "_place").alias("service"))
    )


def load_agents(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    return agent_services(team_members(read_team_lists(spark, path, nested)))
