"""Field expressions: requester, agent, city, urgency, rules, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.constants import CITIES, NO, NO_CITY, UNKNOWN, YES
from ticketloom.functions.text import SPACE, label, strip, whole_word

# --- Fixed values: rules that settle a ticket before any model ---------------
SCREEN_RULE = "PF5"
PASSWORD_RULE = rf"mot{SPACE}+de{SPACE}+passe|password|mdp"


def requester(col: Column) -> Column:
    """`Last, First` becomes `FIRST LAST`; blank becomes unknown. Only the first comma splits."""
    name = strip(col)
    comma = F.instr(name, ",")
    first = strip(F.substr(name, comma + F.lit(1)))
    last = strip(F.substr(name, F.lit(1), comma - F.lit(1)))
    return (
        F.when(col.isNull() | (name == ""), F.lit(UNKNOWN))
        .when(comma > 0, F.upper(F.concat(first, F.lit(" "), last)))
        .otherwise(F.upper(name))
    )


def requester_at_serving(col: Column) -> Column:
    """The literal serving-time variant: only a value with a comma is reordered."""
    plain = F.upper(strip(F.coalesce(col, F.lit(UNKNOWN))))
    name = F.when(F.contains(col, F.lit(",")), requester(col)).otherwise(plain)
    return F.when(name == "", F.lit(UNKNOWN)).otherwise(name)


def agent(col: Column) -> Column:
    """Agent name without `*` and `#`, trimmed, upper."""
    return F.upper(strip(F.regexp_replace(col, "[*#]+", "")))


def city(description: Column) -> Column:
    """First known city named in the text."""
    found = F.regexp_extract(F.upper(description), whole_word("|".join(CITIES)), 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(NO_CITY))


def urgency_number(col: Column) -> Column:
    """First digit of the urgency text, or -1."""
    digit = F.regexp_extract(F.coalesce(label(col), F.lit("")), r"(\p{Nd})", 1)
    return F.coalesce(F.nullif(digit, F.lit("")).try_cast("double"), F.lit(-1.0))


def urgency_category(number: Column) -> Column:
    return F.when(number >= 0, number.cast("int").cast("string")).otherwise(F.lit(UNKNOWN))


def with_default(col: Column) -> Column:
    """A cleaned label, unknown where missing."""
    return F.coalesce(label(col), F.lit(UNKNOWN))


def at_serving(col: Column) -> Column:
    """The literal serving-time variant of `with_default`: blank text stays blank."""
    return F.when(F.coalesce(col, F.lit("")) == "", F.lit(UNKNOWN)).otherwise(F.upper(strip(col)))


def yes_no(col: Column) -> Column:
    """Keep a valid yes/no label, else null."""
    return F.when(col.isin(YES, NO), col)


def is_ruled_out(description: Column) -> Column:
    """True where a fixed rule settles the ticket as no intervention."""
    text = F.coalesce(description, F.lit(""))
    return text.rlike("(?iu)" + whole_word(SCREEN_RULE)) | text.rlike(
        "(?iu)" + whole_word(PASSWORD_RULE)
    )


def binary_target(col: Column) -> Column:
    """1 for yes, 0 for everything else, null included."""
    return F.coalesce((col == YES).cast("int"), F.lit(0))


def percent(probability: Column) -> Column:
    return F.round(probability * 100, 1)


def top_classes(probabilities: Column, classes: list[str], n: int) -> Column:
    """The n likeliest classes as array<struct<classe, probabilite>>, ties by class name."""
    names = F.array(*[F.lit(c) for c in classes])
    pairs = F.zip_with(
        probabilities, names, lambda p, c: F.struct((-p).alias("negated"), c.alias("classe"))
    )
    return F.transform(
        F.slice(F.array_sort(pairs), 1, n),
        lambda s: F.struct(
            s["classe"].alias("classe"), F.round(-s["negated"], 4).alias("probabilite")
        ),
    )

