"""Ticket cleaning: one projection plus the requester lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.constants import (
    INCIDENT_NUMBER, ORIGINE_SPELLING, RAW_CAUSE, RAW_DEMANDEUR, RAW_DESCRIPTION, RAW_OMV,
    RAW_ORIGINE, RAW_SERVICE, RAW_TRAITE, RAW_URGENCE, SERVICE_SPELLING, UNKNOWN,
)
from ticketloom.functions import fields
from ticketloom.functions.text import edge_label, free_text, label, plain_label, respell
from ticketloom.operators.identity import with_identity
from ticketloom.operators.joins import lookup_service

# Accepted column names of a field, best first.
FIELD_NAMES = {
    "incident_id": ["incident_id"],
    "description": [RAW_DESCRIPTION],
    "omv": [RAW_OMV, "omv"],
    "service": [RAW_SERVICE, "service_clean"],
    "origine": [RAW_ORIGINE, "origine_clean"],
    "cause": [RAW_CAUSE, "cause_reelle", "cause"],
    "traite": [RAW_TRAITE, "traite_par", "traite"],
    "demandeur": [RAW_DEMANDEUR],
    "urgence": [RAW_URGENCE],
}


def field(df: DataFrame, name: str) -> Column:
    """The first present column of a field, or a null string. Names ignore case."""
    present = {c.lower(): c for c in df.columns}
    for candidate in FIELD_NAMES[name]:
        if candidate.lower() in present:
            return F.col(f"`{present[candidate.lower()]}`")
    return F.lit(None).cast("string")


def resolve_fields(df: DataFrame) -> DataFrame:
    """Project any accepted layout to the internal raw fields; tickets without an id get one."""
    df = with_identity(df)
    return df.select(*[field(df, name).alias(name) for name in FIELD_NAMES], *_number(df))


def _number(df: DataFrame) -> list[Column]:
    """The ticket number as a plain column, if the layout has one."""
    return [F.col(f"`{c}`").alias("ticket_number") for c in df.columns if c in (INCIDENT_NUMBER, "ticket_number")]


def clean_columns(df: DataFrame, serving: bool = False) -> DataFrame:
    """The cleaned ticket without the requester lookup.

    `serving` uses the literal request-time variants of requester, cause and handler.
    """
    raw = resolve_fields(df)
    # Columns that others build on get a projection of their own, so they run once.
    df = raw.withColumns({
        "description": free_text(F.col("description")),
        "urgence": fields.urgency_number(F.col("urgence")),
    })
    urgency = F.col("urgence")
    category = fields.at_serving if serving else fields.with_default
    name = fields.requester_at_serving if serving else fields.requester
    return df.select(
        field(df, "incident_id").alias("incident_id"),
        "description",
        fields.yes_no(label(field(df, "omv"))).alias("omv"),
        respell(label(field(df, "service")), SERVICE_SPELLING).alias("service_clean"),
        respell(label(field(df, "origine")), ORIGINE_SPELLING).alias("origine_clean"),
        category(field(df, "cause")).alias("cause"),
        category(field(df, "traite")).alias("traite"),
        name(field(df, "demandeur")).alias("demandeur"),
        fields.city(F.col("description")).alias("ville"),
        urgency.alias("urgence_num"),
        fields.urgency_category(urgency).alias("urgence_cat"),
        *_number(df),
    )


def clean_tickets(
    df: DataFrame, agents: DataFrame, serving: bool = False, small: bool | None = None
) -> DataFrame:
    """The cleaned ticket with `service_deterministe`."""
    return lookup_service(clean_columns(df, serving), agents, small)


def clean_for_cascade(df: DataFrame) -> DataFrame:
    """The cascade's cleaning: edge trim and upper only; cause and handler may be null."""
    df = with_identity(df)
    return df.select(
        field(df, "incident_id").alias("incident_id"),
        F.coalesce(field(df, "description"), F.lit("")).alias("description"),
        fields.yes_no(edge_label(field(df, "omv"))).alias("omv"),
        respell(edge_label(field(df, "service")), SERVICE_SPELLING).alias("service_clean"),
        respell(edge_label(field(df, "origine")), ORIGINE_SPELLING).alias("origine_clean"),
        edge_label(field(df, "cause")).alias("cause"),
        edge_label(field(df, "traite")).alias("traite"),
    )


def clean_for_binary(df: DataFrame) -> DataFrame:
    """The binary model's cleaning: service and origin default to unknown, label to 0/1."""
    df = with_identity(df)
    return df.select(
        field(df, "incident_id").alias("incident_id"),
        F.coalesce(field(df, "description"), F.lit("")).alias("description"),
        plain_label(field(df, "service"), UNKNOWN).alias("service"),
        plain_label(field(df, "origine"), UNKNOWN).alias("origine"),
        fields.binary_target(field(df, "omv")).alias("target"),
    )


def clean_for_multi(df: DataFrame) -> DataFrame:
    """The two-target model's cleaning: null labels stay null."""
    df = with_identity(df)
    return df.select(
        field(df, "incident_id").alias("incident_id"),
        F.coalesce(field(df, "description"), F.lit("")).alias("description"),
        respell(plain_label(field(df, "service")), SERVICE_SPELLING).alias("service_clean"),
        respell(plain_label(field(df, "origine")), ORIGINE_SPELLING).alias("origine_clean"),
    )
