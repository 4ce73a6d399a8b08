"""Skills, years of experience and education read from a text column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P
from .text import norm_quotes
from .text_columns import near_terms
from .vocabulary import DEFAULT_VOCABULARY, MARKS_BEFORE, Vocabulary, lookup_table


def extract_skills(text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """Sorted canonical skills that occur as whole terms, in one pass over the text."""
    return _skills_in(_lowered(text, vocab), vocab)


def extract_skills_nearby(text: Column, vocab: Vocabulary = DEFAULT_VOCABULARY) -> Column:
    """:func:`extract_skills`, its pattern tried only around the places where a term may begin. Executors find these in columns of texts."""
    return _skills_in(near_terms(list(vocab.skill_of), "_" + MARKS_BEFORE)(_lowered(text, vocab)), vocab)


def _lowered(text: Column, vocab: Vocabulary) -> Column:
    return F.lower(norm_quotes(text) if any("'" in term for term in vocab.skill_of) else text)


def _skills_in(lowered: Column, vocab: Vocabulary) -> Column:
    hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(vocab.pattern), 1))
    skills_of = lookup_table({term: "|".join(skills) for term, skills in vocab.skills_by_hit.items()})
    found = F.flatten(F.transform(hits, lambda hit: F.split(F.element_at(skills_of, hit), r"\|")))
    return F.array_sort(F.array_distinct(found))


def explicit_years(text: Column) -> Column:
    """Largest believable "N years of ... experience", NULL where nothing is stated."""
    stated = F.regexp_extract_all(text, F.lit(P.STATED_YEARS), 1)
    years = F.transform(stated, lambda n: n.cast("int"))
    return F.array_max(F.filter(years, lambda n: n <= P.LONGEST_CAREER))


def year_spans(text: Column, current_year: int) -> Column:
    """Every "2019 - Present" as ``(s, e, schooling)``, in text order and not yet judged.

    Two extractions over the same matches: one captures what stands before the span on its line,
    the other the span and what follows it on the line.
    """
    near = P.SPAN_CONTEXT
    before = (
        rf"(?={P.YEAR})(?<=((?:\A|\n)[^\n]{{0,{near - 1}}}|[^\n]{{{near}}})){P.YEAR_SPAN}"
    )
    onwards = rf"(?=({P.YEAR_SPAN}[^\n]{{0,{near}}})){P.YEAR_SPAN}"

    def span(left: Column, right: Column) -> Column:
        itself = F.regexp_extract(right, rf"\A{P.YEAR_SPAN}", 0)
        closing_year = F.regexp_extract(itself, rf"({P.YEAR})\z", 1).try_cast("int")
        context = F.concat(left, right)
        return F.struct(
            F.substring(itself, 1, 4).cast("int").alias("s"),
            F.coalesce(closing_year, F.lit(current_year)).alias("e"),
            F.regexp_like(context, F.lit(P.SCHOOLING)).alias("schooling"),
        )

    spans = F.zip_with(
        F.regexp_extract_all(text, F.lit(before), 1),
        F.regexp_extract_all(text, F.lit(onwards), 1),
        span,
    )
    none = F.array().cast("array<struct<s:int,e:int,schooling:boolean>>")
    return F.when(F.regexp_like(text, F.lit(P.YEAR_SPAN)), spans).otherwise(none)


def work_spans(text: Column, current_year: int) -> Column:
    """Spans that can be employment: no schooling nearby, in order, not in the future, not too long."""
    kept = F.filter(
        year_spans(text, current_year),
        lambda x: ~x["schooling"] & x["e"].between(x["s"], current_year) & (x["e"] - x["s"] <= P.LONGEST_CAREER),
    )
    return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def merged_length(spans: Column) -> Column:
    """Years covered by an array of ``(s, e)``, overlaps counted once."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("until")),
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(x["e"] - F.greatest(x["s"], acc["until"]), F.lit(0))).alias("total"),
            F.greatest(acc["until"], x["e"]).alias("until"),
        ),
        lambda acc: acc["total"],
    )


def experience_years(text: Column, current_year: int) -> Column:
    """The stated years if there are any, else the years covered by work spans."""
    return F.coalesce(explicit_years(text), merged_length(work_spans(text, current_year))).cast("double")


def education_levels(text: Column) -> Column:
    """Sorted distinct education levels mentioned."""
    marks = F.array(*(F.when(F.regexp_like(text, F.lit(p)), F.lit(level)) for level, p in P.EDUCATION_PATTERNS))
    return F.array_sort(F.array_distinct(F.array_compact(marks)))


def education_level(text: Column) -> Column:
    """Highest level mentioned. One test settles the texts without any; the others stop at the first hit."""
    level = F.when(~F.regexp_like(text, F.lit(P.ANY_EDUCATION)), F.lit(0))
    for value, pattern in P.EDUCATION_PATTERNS:
        level = level.when(F.regexp_like(text, F.lit(pattern)), F.lit(value))
    return level


def education_label(level: Column) -> Column:
    labels = F.create_map(*(part for k, v in P.EDUCATION_LABELS.items() for part in (F.lit(k), F.lit(v))))
    return F.try_element_at(labels, level)


def build_features(
    documents: DataFrame, current_year: int, vocab: Vocabulary = DEFAULT_VOCABULARY, text: str = "text",
    skills_of: Callable[[Column, Vocabulary], Column] = extract_skills,
) -> DataFrame:
    """Add ``skills``, ``experience_years`` and ``education_level``. Narrow: no shuffle."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumns(
        {
            "skills": skills_of(body, vocab),
            "experience_years": experience_years(body, current_year),
            "education_level": education_level(body),
        }
    )
