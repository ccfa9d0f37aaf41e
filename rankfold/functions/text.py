"""Text column functions (JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The token rule and the English stop-word list the lexical
# index must share with the reference tokenizer (lower-case, runs of two or
# more letter/digit/underscore characters, these 33 words removed).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

_WORD = r"[\p{L}\p{N}_]"
_WORD_RUN_EDGES = rf"^{_WORD}+|{_WORD}+$"
# One regex yields the index terms directly: a maximal run (no word character
# before it) of two or more word characters that is not exactly a stop word.
# Same result as extracting runs and filtering, without a per-element lambda.
_TERM_PATTERN = rf"(?<!{_WORD})(?!(?:{'|'.join(STOP_WORDS)})(?!{_WORD})){_WORD}{{2,}}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text, stop_words: bool = True) -> Column:
    """ARRAY<STRING> of lower-cased terms, stop words removed; null text gives []."""
    pattern = _TERM_PATTERN if stop_words else TOKEN_PATTERN
    return F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(pattern), 0)


def interior_terms(text) -> Column:
    """Terms of ``text`` whose run does not touch the start or the end of the string.

    If ``text`` occurs as a substring of a document, each such term is also a
    whole term of that document, so it can serve as an exact join key for
    containment search.
    """
    trimmed = F.regexp_replace(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(_WORD_RUN_EDGES), F.lit(""))
    return tokenize(trimmed)


def query_slug(query) -> Column:
    """Folder-safe name: spaces become '_', dots are dropped."""
    return F.translate(_col(query), " .", "_")


def decimals(score, digits: int = 5) -> Column:
    """A score as text with a fixed number of decimals, rounded half away from zero ("0.50000"); null stays null."""
    return F.round(_col(score).cast("decimal(38,18)"), digits).cast(f"decimal(38,{digits})").cast("string")
