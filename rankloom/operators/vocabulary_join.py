"""Skills from a vocabulary that is a table.

A pattern of all terms serves hundreds of them. For a vocabulary of any size the text is cut where a term can begin or end:
into runs of letters, digits, ``+`` and ``#``, and single other characters. A whole term is a row of such atoms, so terms are
found by joins: the atoms that begin a term say how many atoms its terms have, and only those rows of atoms are looked up.
All terms that stand there count, overlapping ones too. The vocabulary is broadcast while it is light, else joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import WORD
from ..functions.text import norm_quotes
from ..runtime import attach, is_light, materialize

_RUN = rf"[{WORD}+#]"
ATOM = rf"(?s){_RUN}+|[^{WORD}+#]"
# Atoms of a text that are looked at together; texts of any length are cut to pieces that overlap by a term.
PIECE = 512
# Terms that are broadcast, within the bytes that runtime allows.
LIGHT_TERMS = 500_000
BLANK = " "


def _atoms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(norm_quotes(text)), F.lit(ATOM), 0)


def _term_table(vocabulary: DataFrame) -> DataFrame:
    """``(term, skill, first, n)`` of ``(term, skill)``: a term's first atom, and how many it has. Empty terms are left out."""
    cut = vocabulary.select(_atoms(F.coalesce("term", F.lit(""))).alias("_atoms"), "skill").where(F.size("_atoms") > 0)
    return cut.select(F.array_join("_atoms", "").alias("term"), "skill", F.col("_atoms")[0].alias("first"), F.size("_atoms").alias("n")).distinct()


def _places(documents: DataFrame, keys: Sequence[str], longest: int) -> DataFrame:
    """Per place where a term can begin: its atom ``first``, and where it stands, ``_k``, in its ``_piece``.

    Lists are exploded in the outer form: from the plain one Spark infers a filter on their size and pushes it down to the
    texts, where a text is cut to atoms again for every piece.
    """
    blank = F.array(F.lit(BLANK))
    atoms = documents.select(*keys, _atoms(F.coalesce("text", F.lit(""))).alias("_atoms"))
    padded = atoms.select(*keys, F.concat(blank, "_atoms", blank).alias("_atoms"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("_atoms") - 2, F.lit(PIECE)), lambda i: F.slice("_atoms", i, F.lit(PIECE + longest + 1)))
    cut = padded.select(*keys, F.when(F.size("_atoms") > 2, pieces).alias("_pieces"))
    apart = cut.select(*keys, F.explode_outer("_pieces").alias("_piece")).where(F.col("_piece").isNotNull())
    starts = F.slice("_piece", F.lit(2), F.least(F.lit(PIECE), F.size("_piece") - 2))
    each = apart.select(*keys, "_piece", F.posexplode_outer(starts).alias("_k", "first"))
    return each.where(F.col("first") != BLANK)


def _with_spot(places: DataFrame, longest: int) -> DataFrame:
    """``spot`` instead of the piece: the atom before the place and the next ``longest`` and one."""
    return places.withColumn("spot", F.slice("_piece", F.col("_k") + 1, F.lit(longest + 2))).drop("_piece", "_k")


def skills_by_table(documents: DataFrame, vocabulary: DataFrame, keys: Sequence[str] = ("pos",)) -> DataFrame:
    """``keys`` and ``skills``, the sorted skills whose terms occur as whole terms in ``text``.

    ``documents`` has ``keys``, unique together, and ``text``; ``vocabulary`` has ``term``, in any case, and ``skill``. A term
    must not be preceded by a letter, digit, ``+``, ``#`` or full stop, nor be followed by any of these but the full stop.
    """
    keys = list(keys)
    terms = materialize(_term_table(vocabulary), "terms")
    longest = terms.agg(F.max("n")).first()[0] or 0
    light = is_light(terms, LIGHT_TERMS)
    lengths = terms.groupBy("first").agg(F.collect_set("n").alias("_lengths"))
    places = _places(documents, keys, longest)
    if light:
        # Nothing moves, so the few places that begin a term are found before anything is cut out of the pieces.
        begun = _with_spot(attach(places, lengths, "first", F.col("_k"), light), longest)
    else:
        begun = attach(_with_spot(places, longest), lengths, "first", F.xxhash64(*keys, "spot"), light)
    tried = begun.select(*keys, "spot", F.explode("_lengths").alias("n")).where(F.size("spot") >= F.col("n") + 2)
    before, after = F.col("spot")[0], F.get("spot", F.col("n") + 1)
    alone = tried.where(~before.rlike(rf"{_RUN}|\.") & ~after.rlike(_RUN))
    rows = alone.select(*keys, F.array_join(F.slice("spot", F.lit(2), F.col("n")), "").alias("term")).distinct()
    found = attach(rows, terms.select("term", "skill"), "term", F.xxhash64(*keys), light)
    skills = found.groupBy(*keys).agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    return documents.select(*keys).join(skills, keys, "left").withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))
