"""Merkle manifest of a table: one tree per source, a tree over their roots, and a proof for every row.

A leaf is the digest of a row's fields. Within a source leaves ascend by ``doc_id``, and every run of ``ARITY`` nodes
becomes one node until one is left, the source's root; these, ordered by source, make the tree above in the same way.

Nodes are labelled by the interval ``[lo, hi)`` of leaf ranks that they cover. A level's intervals all have the width
``ARITY ** level``, so a node lies in exactly one bucket ``lo div width`` of every level above, and the one node there
contains it. The tree is grown ``LEVELS`` levels at a time: the up to ``WIDTH`` nodes of a bucket meet in one row, which
makes the levels between. Within a parent the siblings of a node are what is left of the parent's interval without the
node's own: ``[parent.lo, lo)`` on its left and ``[hi, parent.hi)`` on its right. Ancestors further up are attached bucket
by bucket from the top down: every node is joined with the one that contains it a bucket above, and takes on its path.

No group is larger than ``WIDTH`` nodes, whatever the sizes of the sources; ranks come from range partitions and one
offset for each, so a source that owns a third of all rows is as many tasks. Texts are read once, to make the leaves.

Defined results. Null fields count as ``-``. Within a source a null ``doc_id`` comes first, rows with equal ``doc_id`` are
ordered by their leaf, so repeated rows change nothing but the count of leaves. A source with one row is its own root, and
so is a table with one source; no siblings give the digest of nothing. An empty table gives an empty result. Other columns
are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import CRC_TABLE_SQL, crc32_sql, table
from rankloom.operators.ordering import rank_rows
from rankloom.runtime import attach, is_small, materialize

ARITY = 3
LEVELS = 4
WIDTH = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree above the sources is a tree of its own, under this name.
ABOVE = "above"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(column: Column) -> Column:
    """A value with its length before it, so that no two rows are written alike."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row, with another text if one is given."""
    return digest(*[field(F.col(f"`{c}`") if c != "text" or text is None else text) for c in FIELDS])


def tree_name(source: Column) -> Column:
    """A name for every source, null too, whose UTF-8 order is that of the sources with null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked_leaves(leaves: DataFrame, order: list[Column]) -> DataFrame:
    """``leaves`` (tree, digest and more) with ``lo``, the rank in its tree from 0, and ``n``, the leaves of the tree."""
    ranked = rank_rows(leaves, ["tree"], order, "lo").withColumn("lo", F.col("lo").cast("long") - 1)
    sizes = ranked.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    return attach(ranked, sizes, "tree", F.col("lo"), is_small(sizes))


def _height() -> Column:
    """Levels that a bucket grows: all of them while its tree has further buckets, else until one node is left."""
    last = F.lit(LEVELS)
    for h in range(LEVELS - 1, -1, -1):
        last = F.when(F.size("nodes") <= ARITY**h, F.lit(h)).otherwise(last)
    return F.when(F.col("width") * WIDTH >= F.col("n"), last).otherwise(F.lit(LEVELS))


def _next_level(level: str) -> Column:
    """Digests of the runs of ``ARITY`` digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * ARITY + 1, F.lit(ARITY)), "")))


def _siblings(level: int, place: Column) -> Column:
    """Digests left and right of the node at ``place`` of its level, within its parent."""
    nodes, at = F.col(f"level{level}"), place % ARITY
    return F.struct(
        F.array_join(F.slice(nodes, place - at + 1, at), "").alias("left"),
        F.array_join(F.slice(nodes, place + 2, F.lit(ARITY - 1) - at), "").alias("right"),
    )


def _power(level: int) -> int:
    return ARITY**level


def buckets(nodes: DataFrame, width: int) -> DataFrame:
    """The buckets of nodes that are ``width`` leaves wide: ``(tree, lo, hi, n, digest, nodes)``.

    ``digest`` is that of the bucket's own node; ``nodes`` are those in it with their path up to it.
    """
    extra = [c for c in nodes.columns if c not in ("tree", "lo", "hi", "n", "digest")]
    node = F.struct("lo", "hi", "digest", *extra)
    bucket = (F.col("lo") / F.lit(WIDTH * width)).cast("long")
    met = (
        nodes.withColumn("_bucket", bucket)
        .groupBy("tree", "_bucket")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(node)).alias("nodes"))
        .select("tree", "n", "nodes", F.lit(width).cast("long").alias("width"))
    )
    grown = met.select("*", _height().alias("height"), F.transform("nodes", lambda x: x["digest"]).alias("level0"))
    for level in range(1, LEVELS + 1):
        grown = grown.withColumn(f"level{level}", _next_level(f"level{level - 1}"))

    def path(place: Column) -> Column:
        steps = F.array(*[_siblings(h, F.floor(place / _power(h)).cast("int")) for h in range(LEVELS)])
        return F.slice(steps, F.lit(1), F.col("height"))

    paths = F.transform("nodes", lambda x, i: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"),
                                                       *[x[c].alias(c) for c in extra], path(i).alias("path")))
    top = F.coalesce(*[F.when(F.col("height") == h, F.col(f"level{h}")[0]) for h in range(LEVELS + 1)])
    return grown.select(
        "tree", F.col("nodes")[0]["lo"].alias("lo"), F.element_at("nodes", -1)["hi"].alias("hi"), "n",
        top.alias("digest"), paths.alias("nodes"),
    )


def grow(leaves: DataFrame) -> list[DataFrame]:
    """The stored buckets of each step upwards; in the last one every tree has a single one, its root."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.withColumn("hi", F.col("lo") + 1)
    steps, width = [], 1
    while True:
        steps.append(materialize(buckets(nodes, width), "merkle-buckets"))
        width *= WIDTH
        if width >= most:
            return steps
        nodes = steps[-1].select("tree", "lo", "hi", "n", "digest")


def _under(step: DataFrame, ancestors: DataFrame) -> DataFrame:
    """The nodes of a step, each with its path to the root: its own up to the bucket, then that of the node above.

    The bucket is contained in exactly one of ``ancestors``, the one with its interval.
    """
    above = ancestors.select("tree", "lo", F.col("hi").alias("_hi"), F.col("path").alias("_path"), "subroot", "root")
    met = step.select("tree", "lo", "hi", "nodes").join(above, ["tree", "lo"]).where(F.col("hi") <= F.col("_hi"))
    each = met.select("tree", F.explode("nodes").alias("x"), "_path", "subroot", "root")
    return each.select("tree", "x.*", "_path", "subroot", "root").withColumn("path", F.concat("path", "_path")).drop("_path")


def proofs(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, leaf, other, path, subroot, root``.

    ``path`` has per level the joined digests of the siblings on the left and on the right, from the leaf up to the root.
    ``docs`` may have a column ``_other``, the digest of what the row is now; it comes back as ``other``, null where it has none.
    """
    other = F.col("_other") if "_other" in docs.columns else F.lit(None).cast("string")
    made = docs.select(
        tree_name(F.col("source")).alias("tree"), leaf().alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), other.alias("other")
    )
    # Stored before the ranges are drawn, which takes a pass of its own.
    leaves = ranked_leaves(materialize(made, "merkle-leaves"), [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    steps = grow(leaves)
    # One row per source: its root is a leaf of the tree above.
    roots = steps[-1].select(F.when(F.col("lo") == 0, F.lit(ABOVE)).alias("tree"), F.col("tree").alias("source"), F.col("hi").alias("size"), "digest")
    above = grow(ranked_leaves(roots, [F.col("source")]))
    top = above[-1].select(
        "tree", "lo", "hi", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    for step in reversed(above):
        top = _under(step, top)
    ancestors = top.select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi"), "path",
        F.col("digest").alias("subroot"), "root",
    )
    for step in reversed(steps):
        ancestors = _under(step, ancestors)
    return ancestors.select("doc_id", F.col("digest").alias("leaf"), "other", "path", "subroot", "root")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda d, step: digest(step["left"], d, step["right"]))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def verify(docs: DataFrame) -> DataFrame:
    """:func:`proofs` with ``folded_root``, from ``other`` where there is one, and whether it is the root."""
    folded = proofs(docs).withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen & F.contains("text", F.lit("\n")), leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    checked = verify(docs.withColumn("_other", tampered))
    return checked.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


# The SQL states a fixed number of levels: enough for 3^12 rows of a source and 3^5 sources.
SQL_LEVELS, SQL_ABOVE = 12, 5


def _level_sql(name: str, levels: int) -> str:
    """CTEs ``name``0, 1, ... with the nodes of every level and the digests of their siblings."""
    near = "OVER (PARTITION BY tree, lo // 3 ORDER BY lo ROWS BETWEEN"
    return ",\n".join(
        f"""{name}{k + 1} AS (
  SELECT tree, lo // 3 AS lo, (any_value(m) + 2) // 3 AS m,
         CASE WHEN any_value(m) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY lo)) END AS d
  FROM {name}{k} GROUP BY tree, lo // 3),
{name}s{k} AS (
  SELECT tree, lo, m, coalesce(string_agg(d, '') {near} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') {near} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})"""
        for k in range(levels)
    )


def _fold_sql(start: str, name: str, levels: int, tree: str, place: str) -> str:
    """CTEs that take the rows of ``start`` up the levels ``name``, through the columns f and proof."""
    return ",\n".join(
        f"""{name}f{k + 1} AS (
  SELECT x.* EXCLUDE (f, proof), CASE WHEN s.m = 1 THEN f ELSE sha256(s.l || f || s.r) END AS f, proof || s.l || s.r AS proof
  FROM {start if k == 0 else f"{name}f{k}"} x JOIN {name}s{k} s ON s.tree = x.{tree} AND s.lo = x.{place} // {3**k})"""
        for k in range(levels)
    )


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


_HEAD = " || ".join(_field_sql(c) for c in FIELDS[:-1])
SQL = f"""
WITH crc AS ({CRC_TABLE_SQL}),
docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
         sha256({_HEAD} || {_field_sql("text")}) AS leaf,
         sha256({_HEAD} || {_field_sql("replace(text, chr(10), '')")}) AS other,
         {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS tampered
  FROM documents, crc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo FROM docs),
a0 AS (SELECT tree, lo, leaf AS d, count(*) OVER (PARTITION BY tree) AS m FROM ranked),
{_level_sql("a", SQL_LEVELS)},
b0 AS (SELECT 1 AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS lo, d, count(*) OVER () AS m FROM a{SQL_LEVELS}),
{_level_sql("b", SQL_ABOVE)},
began AS (
  SELECT doc_id, leaf, r.tree, r.lo, b0.d AS subroot, b0.tree AS above, b0.lo AS place,
         CASE WHEN tampered THEN other ELSE leaf END AS f, '' AS proof
  FROM ranked r JOIN b0 ON b0.source = r.tree),
{_fold_sql("began", "a", SQL_LEVELS, "tree", "lo")},
{_fold_sql(f"af{SQL_LEVELS}", "b", SQL_ABOVE, "above", "place")}
SELECT doc_id, leaf, subroot, b{SQL_ABOVE}.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b{SQL_ABOVE}.d AS verified
FROM bf{SQL_ABOVE}, b{SQL_ABOVE}
"""
QUERIES = {"op13_merkle_manifest": (op13_merkle_manifest, SQL)}
