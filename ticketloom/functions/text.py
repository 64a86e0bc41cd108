"""Text expressions: cleaning, accents, tokens, n-grams.

Everything here builds Column expressions, so it stays inside the JVM.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.constants import CARRIAGE_MARK

# Character classes that both the JVM and RE2 read the same way.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
TOKEN = WORD + "{2,}"


def whole_word(pattern: str) -> str:
    """`pattern` bounded by non-word characters (Unicode letters, numbers, underscore)."""
    return rf"(?<!{WORD})({pattern})(?!{WORD})"


def strip(col: Column) -> Column:
    """Trim every Unicode space from both ends."""
    return F.regexp_replace(col, rf"^{SPACE}+|{SPACE}+\z", "")


def free_text(col: Column) -> Column:
    """Null becomes empty, carriage marks and runs of space become one space."""
    text = F.replace(F.coalesce(col, F.lit("")), F.lit(CARRIAGE_MARK), F.lit(" "))
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def label(col: Column) -> Column:
    """`free_text` in upper case, with empty, NAN and NONE as null."""
    text = F.upper(free_text(col))
    for missing in ("", "NAN", "NONE"):
        text = F.nullif(text, F.lit(missing))
    return text


def edge_label(col: Column) -> Column:
    """Trim and upper only; the word NAN is null, inner spaces and NONE stay."""
    return F.nullif(F.upper(strip(col)), F.lit("NAN"))


def plain_label(col: Column, default: str | None = None) -> Column:
    """Trim and upper; a null takes `default` first."""
    return F.upper(strip(col if default is None else F.coalesce(col, F.lit(default))))


def respell(col: Column, spellings: dict[str, str]) -> Column:
    """Replace whole values by a small fixed map."""
    pairs = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, col), col)


# ---------------------------------------------------------------------------
# Accents
# ---------------------------------------------------------------------------

# Hangul syllables decompose by arithmetic on their code point.
_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
_LEADS = [chr(0x1100 + i) for i in range(19)]
_VOWELS = [chr(0x1161 + i) for i in range(21)]
_TAILS = [""] + [chr(0x11A8 + i) for i in range(27)]


def _is_mark(form: str, char: str) -> bool:
    return unicodedata.category(char) == "Mn" if form == "NFD" else unicodedata.combining(char) != 0


@lru_cache(maxsize=None)
def _decompositions(form: str) -> tuple[dict[str, str], list[str], dict[str, str]]:
    """Characters that change under `form` without marks: to one, to none, to many characters."""
    to_one, to_none, to_many = {}, [], {}
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        char = chr(code)
        if not unicodedata.decomposition(char) and not _is_mark(form, char):
            continue
        left = "".join(c for c in unicodedata.normalize(form, char) if not _is_mark(form, c))
        if left == char:
            continue
        if not left:
            to_none.append(char)
        elif len(left) == 1:
            to_one[char] = left
        else:
            to_many[char] = left
    return to_one, to_none, to_many


def _covering_class(chars: list[str], gap: int = 256) -> str:
    """A short regular-expression class that covers `chars`; gaps up to `gap` are bridged.

    It only decides who takes the slow branch, so covering too much is harmless
    and few ranges keep the test cheap.
    """
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code <= ranges[-1][1] + (gap if ranges[-1][1] > 0xFF else 1):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _words(values: list[str]) -> Column:
    return F.split(F.lit("\x1f".join(values)), "\x1f")


def strip_accents(col: Column, form: str = "NFD") -> Column:
    """Drop accents: `form` NFD without non-spacing marks, or NFKD without combining characters.

    One-to-one changes are a `translate`. Only texts that hold a character which
    decomposes into several (Hangul, ligatures, fractions) go through the
    character-wise branch.
    """
    to_one, to_none, to_many = _decompositions(form)
    single = F.translate(col, "".join(to_one) + "".join(to_none), "".join(to_one.values()))
    hangul = [chr(c) for c in range(_HANGUL_FIRST, _HANGUL_LAST + 1)]
    several = _covering_class(list(to_many) + hangul)
    expansions = F.map_from_arrays(_words(list(to_many)), _words(list(to_many.values())))

    def expand(char: Column) -> Column:
        place = F.ascii(char) - _HANGUL_FIRST
        syllable = F.concat(
            F.element_at(_words(_LEADS), (place / 588).cast("int") + 1),
            F.element_at(_words(_VOWELS), ((place % 588) / 28).cast("int") + 1),
            F.element_at(_words(_TAILS), place % 28 + 1),
        )
        return F.when(
            F.ascii(char).between(_HANGUL_FIRST, _HANGUL_LAST), syllable
        ).when(
            char.rlike(several), F.coalesce(F.try_element_at(expansions, char), char)
        ).otherwise(char)

    chars = F.regexp_extract_all(single, F.lit("(?s)."), F.lit(0))
    expanded = F.array_join(F.transform(chars, expand), "")
    # A cheap range test spares most texts the test for the exact characters.
    start = min(ord(c) for c in to_many if ord(c) > 0xFF)
    latin = "".join(f"\\x{{{ord(c):X}}}" for c in to_many if ord(c) <= 0xFF)
    maybe = f"[{latin}\\x{{{start:X}}}-\\x{{10FFFF}}]"
    return F.when(single.rlike(maybe) & single.rlike(several), expanded).otherwise(single)


# ---------------------------------------------------------------------------
# Tokens and n-grams
# ---------------------------------------------------------------------------

def tokens(col: Column, accents: bool = True, stop_words: list[str] | None = None) -> Column:
    """Lower-case words of two or more characters, without stop words.

    `accents=False` strips them first.
    """
    text = F.lower(col)
    if not accents:
        text = strip_accents(text, "NFKD")
    words = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(stop_words))
    return words


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` reads it.

    Without this the optimiser may inline a costly `value` at every reference,
    even inside another function's lambda.
    """
    return F.get(F.transform(F.array(value), use), 0)


def ngrams(words: Column, low: int, high: int) -> Column:
    """All n-grams of `low` to `high` words, joined by a space. `words` must be bound."""

    def grams(n: int) -> Column:
        heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))

        def joined(head: Column, at: Column) -> Column:
            rest = [x for k in range(1, n) for x in (F.lit(" "), F.get(words, at + k))]
            return F.concat(head, *rest)

        return words if n == 1 else F.transform(heads, joined)

    parts = [grams(n) for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def counted(terms: Column) -> Column:
    """array<struct<term, tf>> of the distinct terms: run lengths of the sorted array.

    Counting inside the row needs no shuffle and no hash table of all tickets' terms.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(
                ordered,
                lambda term, at: F.when(
                    (at == 0) | (term != F.get(ordered, at - 1)),
                    F.struct(term.alias("term"), at.alias("at")),
                ),
            ),
            lambda start: start.isNotNull(),
        )
        return bind(
            starts,
            lambda each: F.transform(
                each,
                lambda start, i: F.struct(
                    start["term"].alias("term"),
                    (F.coalesce(F.get(each, i + 1)["at"], F.size(ordered)) - start["at"]).alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(terms), runs)


def term_frequencies(
    col: Column, low: int, high: int, accents: bool = True, stop_words: list[str] | None = None
) -> Column:
    """array<struct<term, tf>> of a text's n-grams."""
    words = tokens(col, accents, stop_words)
    return bind(words, lambda w: counted(ngrams(w, low, high)))
