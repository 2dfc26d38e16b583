"""Text column functions: tag removal, trimming, line and paragraph splitting, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space and as line ends in Unicode text.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}"
BLANK_LINE = rf"\n{SPACE}*\n"
HEADING = rf"^(#{{1,4}}){SPACE}+([^\n]+)\n?$"
# Behind a line end, but not inside \r\n.
AFTER_LINE = rf"(?<=[{LINE_END}])(?<!\r(?=\n))"
HAN = r"[\x{4e00}-\x{9fff}]"
LATIN_OR_HAN_RUN = rf"[a-z0-9]+|{HAN}+"
ANY_WORD_OR_HAN_RUN = rf"{HAN}+|[\p{{L}}\p{{N}}&&[^\x{{4e00}}-\x{{9fff}}]]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def lines_with_ends(text: Column) -> Column:
    """Lines of a text, each keeping its line end, so that joining them gives the text back.

    Split at the ends: matching whole lines tries every character of a line against all line ends, eight times the work.
    """
    return F.array_remove(F.split(text, AFTER_LINE), "")


def paragraphs(text: Column) -> Column:
    return F.split(text, BLANK_LINE)


def paragraphs_with_gaps(text: Column) -> Column:
    """Paragraphs and the blank-line separators between them, in order."""
    pairs = F.zip_with(paragraphs(text), F.regexp_extract_all(text, F.lit(f"({BLANK_LINE})"), F.lit(0)),
                       lambda paragraph, gap: F.array(paragraph, gap))
    return F.filter(F.flatten(pairs), lambda part: part.isNotNull())


def _han_pairs(run: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda at: F.substring(run, at, F.lit(2)))
    return F.when(F.length(run) >= 2, pairs).otherwise(F.array().cast("array<string>"))


def tokenize(text: Column, unicode_words: bool = False) -> Column:
    """Lower-cased tokens: alphanumeric runs whole, Han runs as overlapping pairs, the rest separates.

    `unicode_words` keeps accented letters and other alphabets as word characters.
    """
    lowered = F.lower(text)
    runs = F.regexp_extract_all(lowered, F.lit(ANY_WORD_OR_HAN_RUN if unicode_words else LATIN_OR_HAN_RUN), F.lit(0))
    expanded = F.flatten(F.transform(runs, lambda run: F.when(run.rlike(f"^{HAN}"), _han_pairs(run))
                                     .otherwise(F.array(run))))
    return F.when(lowered.rlike(HAN), expanded).otherwise(runs)
