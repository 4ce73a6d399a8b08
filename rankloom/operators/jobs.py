"""Job descriptions as profile rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features
from ..functions import patterns as P
from ..functions.vocabulary import DEFAULT_VOCABULARY, Vocabulary


def required_part(text: Column) -> Column:
    """The text up to the first optional heading, all of it if there is none."""
    return F.regexp_extract(text, rf"(?s)\A(.*?)(?:(?={P.OPTIONAL_HEADING})|\z)", 1)


def optional_part(text: Column) -> Column:
    """The text from the first optional heading on, or nothing."""
    return F.substr(text, F.length(required_part(text)) + 1)


def split_optional(jobs: DataFrame, text: str = "text") -> DataFrame:
    return jobs.withColumns(
        {"required_text": required_part(F.col(text)), "optional_text": optional_part(F.col(text))}
    )


def min_years(text: Column) -> Column:
    """The first stated number of years anywhere in the text, however large."""
    return F.nullif(F.regexp_extract(text, P.JOB_STATED_YEARS, 1), F.lit("")).cast("double")


def min_education(text: Column) -> Column:
    """The lowest level named: "Bachelor's or Master's" asks for the former."""
    return F.array_min(features.education_levels(text))


def parse_job_descriptions(jobs: DataFrame, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """``(jd_id, text)`` to ``(jd_id, text, required, nice, min_years, min_education)``."""
    parts = split_optional(jobs.select("jd_id", "text"))
    required = features.extract_skills(F.col("required_text"), vocab)
    named = features.extract_skills(F.col("optional_text"), vocab)
    return (
        parts.withColumns({"required": required, "_named": named})
        .withColumns(
            {
                "nice": F.array_except("_named", "required"),
                "min_years": min_years(F.col("text")),
                "min_education": min_education(F.col("required_text")),
            }
        )
        .select("jd_id", "text", "required", "nice", "min_years", "min_education")
    )
