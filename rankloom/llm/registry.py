"""The queries of this folder by name, each with its SQL or None."""

from rankloom.llm import (
    chat, exact_dedup, graph_search, line_dedup, merkle, mixing, near_dedup, packing, secrets, sharding, spelling_variants,
    suffix_dedup, toxicity,
)

QUERIES = {
    **packing.QUERIES,
    **chat.QUERIES,
    **near_dedup.QUERIES,
    **graph_search.QUERIES,
    **secrets.QUERIES,
    **sharding.QUERIES,
    **exact_dedup.QUERIES,
    **mixing.QUERIES,
    **suffix_dedup.QUERIES,
    **toxicity.QUERIES,
    **spelling_variants.QUERIES,
    **line_dedup.QUERIES,
    **merkle.QUERIES,
}
