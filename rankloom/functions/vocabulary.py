"""The skill dictionary and how it becomes one matching expression.

A vocabulary is configuration: a few hundred terms that every row is compared with. It travels
inside the plan as literals, so matching needs no join.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import WORD

# ---- fixed values: the default dictionary, 100 skills in 8 categories and 37 aliases --------

DEFAULT_SKILLS = {
    "programming": [
        "python", "r programming", "java", "javascript", "typescript", "c++", "c#", "scala", "matlab",
        "bash", "php",
    ],
    "databases": [
        "sql", "mysql", "postgresql", "sqlite", "oracle", "mongodb", "nosql", "snowflake", "bigquery",
        "redshift",
    ],
    "analytics_bi": [
        "excel", "power bi", "tableau", "looker", "google sheets", "dax", "power query", "data analysis",
        "data visualization", "data cleaning", "dashboards", "reporting", "statistics", "hypothesis testing",
        "a/b testing", "forecasting", "regression", "etl", "pandas", "numpy", "matplotlib", "seaborn",
        "plotly",
    ],
    "ml_ai": [
        "machine learning", "deep learning", "scikit-learn", "tensorflow", "pytorch", "keras", "xgboost",
        "natural language processing", "computer vision", "spacy", "nltk", "hugging face", "llm",
        "feature engineering",
    ],
    "data_engineering_cloud": [
        "spark", "hadoop", "airflow", "kafka", "aws", "azure", "google cloud", "docker", "kubernetes", "git",
        "github", "linux",
    ],
    "web": [
        "html", "css", "react", "angular", "node.js", "django", "flask", "fastapi", "streamlit", "rest api",
    ],
    "business": [
        "crm", "salesforce", "recruitment", "talent acquisition", "payroll", "negotiation", "sales",
        "marketing", "seo", "financial modeling", "accounting", "sap",
    ],
    "soft_skills": [
        "communication", "leadership", "teamwork", "problem solving", "stakeholder management",
        "project management", "agile", "scrum",
    ],
}

DEFAULT_ALIASES = {
    "powerbi": "power bi",
    "microsoft power bi": "power bi",
    "ms excel": "excel",
    "microsoft excel": "excel",
    "advanced excel": "excel",
    "sklearn": "scikit-learn",
    "scikit learn": "scikit-learn",
    "postgres": "postgresql",
    "js": "javascript",
    "nodejs": "node.js",
    "node js": "node.js",
    "reactjs": "react",
    "react.js": "react",
    "ml": "machine learning",
    "nlp": "natural language processing",
    "gcp": "google cloud",
    "amazon web services": "aws",
    "k8s": "kubernetes",
    "dashboard": "dashboards",
    "data viz": "data visualization",
    "visualization": "data visualization",
    "visualisation": "data visualization",
    "ab testing": "a/b testing",
    "a-b testing": "a/b testing",
    "problem-solving": "problem solving",
    "team work": "teamwork",
    "team player": "teamwork",
    "restful api": "rest api",
    "restful apis": "rest api",
    "rest apis": "rest api",
    "statistical analysis": "statistics",
    "big query": "bigquery",
    "huggingface": "hugging face",
    "large language models": "llm",
    "llms": "llm",
    "data cleansing": "data cleaning",
    "data wrangling": "data cleaning",
}

# Characters that must not touch a term: a full stop may follow it but not precede it.
MARKS_BEFORE = "+#."
_BEFORE = rf"(?<![{WORD}{MARKS_BEFORE}])"
_AFTER = rf"(?![{WORD}+#])"


class Vocabulary(NamedTuple):
    category_of: dict[str, str]  # canonical skill -> category
    skill_of: dict[str, str]  # every accepted spelling, lower case -> canonical skill

    @property
    def skills(self) -> list[str]:
        return list(self.category_of)

    @property
    def pattern(self) -> str:
        """Capture, at every position, the longest term that stands there as a whole term.

        The capture sits in a lookahead, so terms that overlap are all found. Terms are grouped
        by first character, which spares most of the alternatives at most positions.
        """
        terms = sorted(self.skill_of, key=lambda t: (t[0], -len(t), t))
        branches = [
            _quote(first) + "(?:" + "|".join(_quote(t[1:]) for t in group) + ")"
            for first, group in groupby(terms, key=lambda t: t[0])
        ]
        return rf"{_BEFORE}(?=((?:{'|'.join(branches)}){_AFTER}))"

    @property
    def skills_by_hit(self) -> dict[str, list[str]]:
        """Skills counted for a captured term: its own, and those of whole terms it starts with."""
        ends_term = re.compile(r"[\w+#]")
        return {
            term: sorted(
                {
                    skill
                    for other, skill in self.skill_of.items()
                    if term == other or (term.startswith(other) and not ends_term.match(term[len(other)]))
                }
            )
            for term in self.skill_of
        }


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() or c in " _" else "\\" + c for c in text)


def vocabulary(categories: Mapping[str, list[str]], aliases: Mapping[str, str] | None = None) -> Vocabulary:
    """Build a vocabulary from ``{category: [skill, ...]}`` and ``{alias: skill}``."""
    category_of = {skill: category for category, skills in categories.items() for skill in skills}
    skill_of = {skill.lower(): skill for skill in category_of}
    skill_of.update({alias.lower(): skill for alias, skill in (aliases or {}).items()})
    return Vocabulary(category_of, skill_of)


DEFAULT_VOCABULARY = vocabulary(DEFAULT_SKILLS, DEFAULT_ALIASES)


def lookup_table(entries: Mapping[str, str]) -> Column:
    """A constant map column. One text literal, split while the plan is optimized, instead of one per entry."""
    text = "\n".join(f"{key}\t{value}" for key, value in entries.items())
    return F.str_to_map(F.lit(text), F.lit("\n"), F.lit("\t"))
