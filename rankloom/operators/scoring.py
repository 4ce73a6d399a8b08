"""Component scores, weights, explanations.

Rows here carry a candidate's features next to the profile of its job: ``skills``,
``experience_years``, ``education_level`` and ``required``, ``nice``, ``min_years``,
``min_education``. A component that a job does not ask for is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import education_label

COMPONENTS = ("skills", "tfidf", "semantic", "experience", "education")

# ---- fixed values: default component weights ------------------------------------------------
DEFAULT_WEIGHTS = {"skills": 0.45, "tfidf": 0.15, "semantic": 0.20, "experience": 0.12, "education": 0.08}
REQUIRED_SHARE, NICE_SHARE = 0.8, 0.2


def _clip(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def _coverage(wanted: Column, skills: Column) -> Column:
    """Share of the wanted skills found, NULL if none are wanted."""
    return F.size(F.array_intersect(wanted, skills)) / F.nullif(F.size(wanted), F.lit(0))


def skill_score(required: Column, nice: Column, skills: Column) -> Column:
    must, may = _coverage(required, skills), _coverage(nice, skills)
    return F.coalesce(REQUIRED_SHARE * must + NICE_SHARE * may, must, may)


def experience_score(years: Column, min_years: Column) -> Column:
    return F.when(min_years.isNotNull(), _clip(years / F.greatest(min_years, F.lit(1e-9))))


def education_score(level: Column, min_education: Column) -> Column:
    return F.when(min_education.isNotNull(), _clip(level / min_education))


def with_feature_scores(rows: DataFrame) -> DataFrame:
    """Add the three scores that need nothing but the row itself."""
    return rows.withColumns(
        {
            "skills_score": skill_score(F.col("required"), F.col("nice"), F.col("skills")),
            "experience_score": experience_score(F.col("experience_years"), F.col("min_years")),
            "education_score": education_score(F.col("education_level"), F.col("min_education")),
        }
    )


def merge_weights(weights: Mapping[str, float] | None) -> dict[str, float]:
    return {**DEFAULT_WEIGHTS, **(weights or {})}


def active_weight(component: str, weights: Mapping[str, float]) -> Column:
    """The weight of a component that applies, NULL for one that is absent or switched off."""
    weight = float(weights.get(component, 0.0))
    return F.when(F.col(f"{component}_score").isNotNull() & F.lit(weight > 0), F.lit(weight))


def with_weights(rows: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Add ``weight_*``: the active weights, scaled to add up to 1."""
    weights = merge_weights(weights)
    total = sum((F.coalesce(active_weight(c, weights), F.lit(0.0)) for c in COMPONENTS), F.lit(0.0))
    return (
        rows.withColumn("_total", total)
        .withColumns({f"weight_{c}": active_weight(c, weights) / F.nullif("_total", F.lit(0.0)) for c in COMPONENTS})
        .drop("_total")
    )


def with_final_score(rows: DataFrame) -> DataFrame:
    """Add ``contrib_*``, NULL for inactive components, and their sum ``final_score``."""
    parts = {f"contrib_{c}": 100 * F.col(f"weight_{c}") * F.col(f"{c}_score") for c in COMPONENTS}
    weighted = (F.coalesce(F.col(f"weight_{c}") * F.col(f"{c}_score"), F.lit(0.0)) for c in COMPONENTS)
    return rows.withColumns(parts).withColumn("final_score", 100 * sum(weighted, F.lit(0.0)))


def _listing(skills: Column) -> Column:
    return F.array_join(F.array_sort(skills), ", ")


def with_matches(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "matched_required": _listing(F.array_intersect("required", "skills")),
            "missing_required": _listing(F.array_except("required", "skills")),
            "matched_nice": _listing(F.array_intersect("nice", "skills")),
        }
    )


def _figure(x: Column) -> Column:
    """Up to four decimals, no trailing zeros; years are whole in practice."""
    whole = x == F.floor(x)
    decimal = F.regexp_replace(F.format_string("%.4f", x.cast("double")), r"\.?0+$", "")
    return F.when(whole, x.cast("bigint").cast("string")).otherwise(decimal)


def explanation() -> Column:
    """One sentence on what matched and what is missing; parts that do not apply are left out."""
    required, nice, skills = F.col("required"), F.col("nice"), F.col("skills")
    found = lambda wanted: F.concat_ws(
        "/", F.size(F.array_intersect(wanted, skills)).cast("string"), F.size(wanted).cast("string")
    )
    missing = F.array_except(required, skills)
    sentence = F.concat_ws(
        "; ",
        F.when(F.size(required) > 0, F.concat(F.lit("matches "), found(required), F.lit(" required skills"))),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), _listing(missing))),
        F.when(F.size(nice) > 0, F.concat(found(nice), F.lit(" nice-to-have"))),
        F.when(
            F.col("min_years").isNotNull(),
            F.concat(
                F.lit("experience "), _figure(F.col("experience_years")),
                F.lit(" yrs vs "), _figure(F.col("min_years")), F.lit(" required"),
            ),
        ),
        F.when(
            F.col("min_education").isNotNull(),
            F.concat(
                F.lit("education "), education_label(F.col("education_level")),
                F.lit(" vs "), education_label(F.col("min_education")), F.lit(" required"),
            ),
        ),
    )
    return F.concat(F.upper(F.substring(sentence, 1, 1)), F.substr(sentence, F.lit(2)))


def rank_order() -> list[Column]:
    """Best final score first, then best skill score, then input order."""
    return [F.col("final_score").desc_nulls_last(), F.col("skills_score").desc_nulls_last(), F.col("pos").asc()]
