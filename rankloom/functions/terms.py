"""Texts as term lists and as word chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import patterns as P
from .stop_words import ENGLISH
from .text import strip
from .text_columns import joined_words

CHUNK_WORDS = 200
MOST_STOP_WORDS = 10_000


def default_stop_words() -> tuple[str, ...]:
    """The 318 English words that are left out unless other stop words are given."""
    return tuple(ENGLISH)


def read_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A stop-word list from a text file, words separated by white space; at most MOST_STOP_WORDS of them."""
    words = spark.read.text(path).select(F.explode(F.split(F.lower("value"), r"\s+")).alias("w"))
    found = [r.w for r in words.where("w <> ''").distinct().orderBy("w").limit(MOST_STOP_WORDS + 1).collect()]
    if len(found) > MOST_STOP_WORDS:
        raise ValueError(f"{path} holds more than {MOST_STOP_WORDS} words: not a list of stop words")
    return tuple(found)


def tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case runs of two or more word characters, stop words left out."""
    words = F.regexp_extract_all(F.lower(text), F.lit(P.TOKEN), 0)
    return F.filter(words, lambda w: ~w.isin(list(stop_words))) if stop_words else words


def add_ngrams(documents: DataFrame, stop_words: Sequence[str], text: str = "text", name: str = "grams") -> DataFrame:
    """Add all tokens, then all pairs of neighbouring tokens, as one array column.

    The tokens get a projection of their own because they are read three times.
    """
    word = F.col("_words")
    pairs = F.zip_with(
        F.slice(word, 1, F.greatest(F.size(word) - 1, F.lit(0))),
        F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumn("_words", tokens(body, stop_words)).withColumn(name, F.concat(word, pairs)).drop("_words")


def add_words(documents: DataFrame, stop_words: Sequence[str], text: str = "text") -> DataFrame:
    """Add ``words``, the tokens of a text in their order. All that is known of its terms follows from them."""
    return documents.withColumn("words", tokens(F.coalesce(F.col(text), F.lit("")), stop_words))


def add_joined_words(documents: DataFrame, stop_words: Sequence[str], text: str = "text") -> DataFrame:
    """:func:`add_words` with all words of a text in one, blanks between them: stored and moved in one piece.

    Executors cut the words in columns of texts; the pattern reads only texts that are not sure to be cut alike there.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumn("words", F.coalesce(joined_words(stop_words)(F.lower(body)), F.array_join(tokens(body, stop_words), " ")))


def count_terms(documents: DataFrame) -> DataFrame:
    """Replace ``words``, joined or not, by ``terms``, the distinct tokens and pairs, and ``counts``, how often each occurs; in no order.

    The words of a batch of rows are counted together, in columns.
    """
    kept = documents.drop("words")
    schema = StructType([*kept.schema, *(StructField(c, ArrayType(t)) for c, t in (("terms", StringType()), ("counts", IntegerType())))])
    out = to_arrow_schema(schema)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts, rows = counted_words(batch.column("words"))
            ends = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, values) for values in (terms, pa.array(counts))]
            columns = [*(batch.column(c) for c in out.names[:-2]), *lists]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(columns, out, strict=True)], schema=out)

    return documents.select(*kept.columns, "words").mapInArrow(count, schema)


def listed_words(words: pa.Array) -> pa.ListArray:
    """Words as lists, be they joined or not."""
    if pa.types.is_list(words.type):
        return words
    # An empty text has no words, not an empty one.
    cut = pc.split_pattern(words, " ").flatten()
    cut = cut.filter(pc.not_equal(cut, ""))
    blanks = pc.count_substring(words, " ").fill_null(0).to_numpy(zero_copy_only=False)
    sizes = np.where(pc.binary_length(words).fill_null(0).to_numpy(zero_copy_only=False) > 0, blanks + 1, 0)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), cut)


def counted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens and pairs of every row, how often each occurs in it, and its row, in order of the rows."""
    known, first, last, counts, row = counted_pairs(words)
    paired = first >= 0
    joined = pc.binary_join_element_wise(*(known.take(pa.array(k[paired])) for k in (first, last)), " ")
    single = known.take(pa.array(last[~paired]))
    place = np.where(paired, np.cumsum(paired) - 1, len(joined) + np.cumsum(~paired) - 1)
    return pa.concat_arrays([joined, single]).take(pa.array(place)), counts, row


def counted_pairs(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, and of the tokens and pairs of every row the places of their first and last word among these, how
    often each occurs in the row, and the row, in order of the rows. A token has no first word: -1."""
    words = listed_words(words)
    rows = np.repeat(np.arange(len(words)), pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False))
    found = words.flatten().dictionary_encode()
    word, many = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
    return (found.dictionary, *counted_numbers(rows, word, many, len(words)))


def counted_numbers(rows: np.ndarray, word: np.ndarray, many: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`counted_pairs` of words given by their rows, in order, and their places among ``many`` words; ``size`` rows in all."""
    per_row = many * (many + 1)
    if size * per_row >= 1 << 62:
        # Row, first and second word do not fit one number. Those of a single row always do.
        middle = size // 2
        cut = np.searchsorted(rows, middle)
        halves = counted_numbers(rows[:cut], word[:cut], many, middle), counted_numbers(rows[cut:] - middle, word[cut:], many, size - middle)
        first, last, counts, row = (np.concatenate(x) for x in zip(*halves))
        row[len(halves[0][3]) :] += middle
        return first, last, counts, row
    # A word is a pair whose first word is number 0; as first words all others are numbered from 1.
    near = np.flatnonzero(rows[1:] == rows[:-1])
    keys = np.concatenate([rows * per_row + word, rows[near] * per_row + (word[near] + 1) * many + word[near + 1]])
    keys.sort()
    begins = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(begins, append=len(keys)).astype(np.int32)
    row, pair = np.divmod(keys[begins], max(per_row, 1))
    first, last = np.divmod(pair, max(many, 1))
    return first - 1, last, counts, row


def add_term_counts(documents: DataFrame, stop_words: Sequence[str], text: str = "text") -> DataFrame:
    """Add ``terms``, the distinct tokens and pairs of a text, and ``counts``, how often each occurs; in no order."""
    return count_terms(add_words(documents, stop_words, text))


def chunk_words(documents: DataFrame, text: str = "text", size: int = CHUNK_WORDS) -> DataFrame:
    """One row per chunk of ``size`` words: ``chunk_no`` from 0 and ``chunk``. An empty text has one, empty.

    The pattern cuts whole chunks out of the text directly, so no row holds its words as an array.
    """
    run, gap = rf"[^{P.SPACE}]++", rf"[{P.SPACE}]++"
    body = strip(F.coalesce(F.col(text), F.lit("")))
    pieces = F.regexp_extract_all(body, F.lit(rf"(?:{run}{gap}){{0,{size - 1}}}{run}"), 0)
    cut = documents.select(
        *(c for c in documents.columns if c != text),
        F.posexplode_outer(pieces).alias("chunk_no", "chunk"),
    )
    return cut.withColumns(
        {
            "chunk_no": F.coalesce("chunk_no", F.lit(0)),
            "chunk": F.coalesce(F.regexp_replace("chunk", gap, " "), F.lit("")),
        }
    )
