"""Sentences, match normalisation, tokens and page text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.parse import fold_accents


def sentences(text: Column) -> Column:
    """Pieces after `.`, `!` or `?` and white space, or between newlines and form feeds; trimmed, none empty."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+|[\n\f]+"), lambda s: F.regexp_replace(s, r"\A\s+|\s+\z", "")), lambda s: s != "")


def match_form(text: Column) -> Column:
    """Straight quotes, white-space runs to one blank, trimmed, lower."""
    straight = F.translate(text, "‘’‚‛“”„‟", "''''\"\"\"\"")
    return F.lower(F.trim(F.regexp_replace(straight, r"(?U)[\s\x1c-\x1f]+", " ")))


def tokens(text: Column) -> Column:
    """Runs of letters and digits, case and Latin accents folded."""
    return F.regexp_extract_all(fold_accents(F.lower(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def search_units(term: Column) -> Column:
    """Phrases of a search term: quoted runs and single words; an open quote runs to the end."""
    found = F.regexp_extract_all(F.translate(term, "\x00", " "), F.lit(r'"([^"]*)(?:"|\z)|([^\s"]+)'), F.lit(0))
    bare = F.transform(found, lambda u: F.trim(F.regexp_replace(u, '"', " ")))
    return F.filter(bare, lambda u: F.size(tokens(u)) > 0)


def page_text(text: Column) -> Column:
    """Pages between form feeds: edges trimmed, line ends stripped, blank pages kept, all blank to null."""
    pages = F.transform(F.split(text, "\f"), lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"(?m)[ \t]+$", ""), r"\A\s+|\s+\z", "")))
    return F.when(text.rlike(r"[^\s\f]"), F.array_join(pages, "\n\f\n"))


def plain_text(text: Column) -> Column:
    """No byte-order mark, one kind of line end, form feeds to newlines; NUL is no text and blank is null."""
    clean = F.translate(F.regexp_replace(F.regexp_replace(text, "\\A\ufeff", ""), r"\r\n?", "\n"), "\f", "\n")
    return F.when(~text.contains("\x00") & clean.rlike(r"\S"), clean)


def ocr_text(lines: Column, least: float = 0.6) -> Column:
    """Lines of enough confidence, joined; none gives null."""
    kept = F.filter(lines, lambda x: x["confidence"] >= least)
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda x: x["text"]), "\n"))
