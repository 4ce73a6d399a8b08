"""Cleaning and redaction of free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P


def norm_quotes(text: Column) -> Column:
    """Typographic single quotes become the plain apostrophe."""
    return F.translate(text, "\u2019\u2018", "''")


def strip(text: Column) -> Column:
    """Trim every kind of white space; ``F.trim`` only knows the blank."""
    return F.btrim(text, F.lit(P.SPACE_CHARACTERS))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{P.SPACE}]+", " "))


def clean_text(text: Column) -> Column:
    """Plain quotes, single blanks, no blank lines, no outer white space. Line breaks stay."""
    plain = F.translate(text, "\u2019\u2018\u00a0", "'' ")
    # Single blanks need no replacing.
    spaced = F.regexp_replace(plain, r"[ \t]{2,}|\t", " ")
    return strip(F.regexp_replace(spaced, rf"\n[{P.SPACE}]*\n", "\n"))


def redact_email(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, P.EMAIL, " ")).otherwise(text)


def redact_url(text: Column) -> Column:
    return F.regexp_replace(text, P.URL, " ")


def redact_phone(text: Column) -> Column:
    """Blank out phone-shaped runs of 10 to 15 digits; shorter and longer runs stay as they are.

    Whether a run goes depends on a count inside it, which a replacement pattern cannot say. So
    the text is cut at every run, the runs are judged one by one, and all is joined again. Texts
    without any run, nearly all of them, skip that.
    """
    fewest, most = P.PHONE_DIGITS
    digits = lambda run: F.length(F.regexp_replace(run, r"[^\p{Nd}]", ""))
    judged = F.transform(
        F.regexp_extract_all(text, F.lit(P.PHONE), 0),
        lambda run: F.when(digits(run).between(fewest, most), F.lit(" ")).otherwise(run),
    )
    # One gap more than runs: zip_with pads the last run with NULL.
    gaps = F.split(text, P.PHONE, -1)
    rejoined = F.array_join(F.zip_with(gaps, judged, lambda gap, run: F.concat(gap, F.coalesce(run, F.lit("")))), "")
    return F.when(F.regexp_like(text, F.lit(P.PHONE)), rejoined).otherwise(text)


def redact_pii(documents: DataFrame, text: str = "text") -> DataFrame:
    """Mail addresses first, then links, then phone numbers.

    One projection per step: nested into one expression, each step would repeat those before it.
    """
    for redact in (redact_email, redact_url, redact_phone):
        documents = documents.withColumn(text, redact(F.col(text)))
    return documents


def text_preview(text: Column, start: int = 0, chars: int = 1500) -> Column:
    """A window of the text on one line, for people to read."""
    return collapse_space(F.substring(text, start + 1, chars))
