"""Header resolution. Works on column names only, never on data."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.constants import HEADER_ALIASES, RAW_CAUSE, RAW_COLUMNS, RAW_TRAITE


# What a header is compared by: runs of letters and digits of the decomposed, accent-free text.
_ACCENTS = re.compile("[\u0300-\u036f]")
_APART = re.compile(r"[\s_-]+")
_OTHER = re.compile(r"[\W_]+")

# Words that together tell a column whose header is none of the known ones.
TELLING_WORDS = {RAW_TRAITE: {"traite", "par"}, RAW_CAUSE: {"cause", "reelle"}}


def header_key(name: object) -> str:
    """Comparable form of a header: lower case, no accents, no punctuation, words one blank apart."""
    if not isinstance(name, str):
        return ""
    plain = _ACCENTS.sub("", unicodedata.normalize("NFKD", name.lower()))
    return " ".join(filter(None, (_OTHER.sub("", word) for word in _APART.split(plain))))


def canonical_header(name: str) -> str:
    """The canonical header `name` stands for, or the trimmed name itself."""
    key = header_key(name)
    told = (target for target, telling in TELLING_WORDS.items() if all(w in key for w in telling))
    written = {c.upper(): c.upper() for c in RAW_COLUMNS}.get(name.strip().upper(), name.strip())
    return HEADER_ALIASES.get(key) or next(told, written)


def chosen_columns(headers: list[str]) -> dict[str, int]:
    """Canonical header -> position. Of duplicates, the exactly written one, else the first."""
    chosen: dict[str, int] = {}
    for position, raw in enumerate(headers):
        name = canonical_header(raw)
        taken = chosen.get(name)
        if taken is None or (raw.strip() == name and headers[taken].strip() != name):
            chosen[name] = position
    return chosen


def canonical_columns(
    df: DataFrame, headers: list[str] | None = None, *keep: str
) -> DataFrame:
    """Rename, deduplicate, order and complete the seven canonical columns; null becomes empty.

    `headers` are the raw names of the leading columns if they differ from the
    current ones; `keep` columns pass through.
    """
    headers = [c for c in df.columns if c not in keep] if headers is None else headers
    positions = [f"_p{i}" for i in range(len(headers))]
    positional = df.toDF(*positions, *df.columns[len(headers):])
    chosen = chosen_columns(headers)

    def cell(name: str):
        if name not in chosen:
            return F.lit("")
        return F.coalesce(F.col(positions[chosen[name]]).cast("string"), F.lit(""))

    return positional.select(*[cell(c).alias(c) for c in RAW_COLUMNS], *keep)
