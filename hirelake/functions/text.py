"""Text expressions. Everything here is a Column; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Corporate words dropped from an employer name before matching.
CORPORATE_WORDS = [
    "inc", "llc", "ltd", "corp", "corporation", "co", "company", "pllc", "pbc", "group",
    "holdings", "technologies", "solutions", "services", "partners", "international",
]

_CORPORATE = rf"(?U)\b(?:{'|'.join(CORPORATE_WORDS)})\b"
_NOT_WORD = r"[^\p{L}\p{N}_]+"
_PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}]"
_SPACES = r"[\s\p{Z}]+"
# Fixed value: how years of experience are written.
_EXPERIENCE = r"(?U)(\d+\+?-?\d*)\s+(?:years?|yrs?)"


def clean_text(text: Column) -> Column:
    """Lower-case words separated by single spaces; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(text), _NOT_WORD, " ")), F.lit(""))


def normalize_company(name: Column) -> Column:
    """Matching key of an employer name: no parentheses, corporate words or punctuation."""
    bare = F.regexp_replace(F.lower(name), r"\([^)]*\)", "")
    bare = F.regexp_replace(bare, _CORPORATE, "")
    bare = F.regexp_replace(bare, _PUNCTUATION, "")
    return F.coalesce(F.trim(F.regexp_replace(bare, _SPACES, " ")), F.lit(""))


def experience(text: Column) -> Column:
    """Number part of the first 'N years' phrase, e.g. ``5``, ``5+`` or ``5-7``; null if none."""
    return F.nullif(F.regexp_extract(F.lower(text), _EXPERIENCE, 1), F.lit(""))


def prompt_text(title: Column, description: Column) -> Column:
    """Two-line text handed to an enrichment function; a null prints as ``None``."""
    return F.concat(
        F.lit("Title: "), F.coalesce(title, F.lit("None")),
        F.lit("\nDescription: "), F.coalesce(description, F.lit("None")),
    )


def title_and_description(title: Column, description: Column) -> Column:
    """Cleaned clustering text; a null on either side leaves ''."""
    return clean_text(F.concat(title, F.lit(" "), description))


def word_list(cleaned: Column, stop_words: list[str] = ()) -> Column:
    """Words of at least two characters of a cleaned text, without stop words."""
    def keep(word: Column) -> Column:
        long_enough = F.length(word) >= 2
        return long_enough & ~word.isin(list(stop_words)) if stop_words else long_enough

    return F.filter(F.split(cleaned, " "), keep)


def is_blank(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, _SPACES, "") == "", F.lit(True))
