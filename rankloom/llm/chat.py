"""Chat formatting with typed content parts, with DataFrame functions only.

A turn is a role and an array of parts: text, image, audio, document. Parts are flattened in order into one string:
texts are written out, every attachment becomes a placeholder, and a list records which attachment stands where and how
many tokens it expands to. The template is

    <s>role[INST]...[/INST]</s>      a prompt turn
    <s>role[OUT]...[/OUT]</s>        an assistant turn, whose text is under the loss mask

Control strings inside texts and roles get a backslash after their first character, and one more where they already have
some, so that no text can be taken for a mark and unescaping restores it. ``[+]`` separates two text parts in a row.

A conversation is formatted in segments of ``SEGMENT`` turn numbers, so that one that holds a third of all rows is not
gathered into one row of text; only the digests of the query run over a whole conversation.

Defined results. Turns come in order of turn, then role, then text; a null turn first. Null roles, texts and parts count
as empty. Parts of an unknown kind become ``[PART]`` with no tokens. Sizes that are null count as 0. Rows with a null
``conv_id`` are one conversation. Empty tables give empty results. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import table, text_or_empty

SEGMENT = 128
PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 256
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
TAIL = "/?(?:s>|(?:INST|OUT|IMG|AUDIO|DOC|PART|\\+)\\])"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])(\\\\*)({TAIL})", "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])\\\\(\\\\*)({TAIL})", "$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as an array of one part."""
    empty = {f.split(":")[0]: f.split(":")[1] for f in PART[7:-1].split(",")}
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.cast("string").alias("text"),
            *[F.lit(None).cast(t).alias(n) for n, t in empty.items() if n not in ("kind", "text")],
        )
    )


def part_tokens(part: Column) -> Column:
    """Expanded token count of an attachment."""
    zero = F.lit(0)
    patches = F.ceil(F.coalesce(part["width"], zero) / PATCH) * F.ceil(F.coalesce(part["height"], zero) / PATCH)
    return (
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["kind"] == "document", F.coalesce(part["pages"], zero) * TOKENS_PER_PAGE)
        .otherwise(zero)
        .cast("long")
    )


def flatten(parts: Column) -> Column:
    """The visitor: parts in order as one escaped string with placeholders."""

    def visit(state: Column, part: Column) -> Column:
        is_text = part["kind"].eqNullSafe("text")
        mark = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv]), part["kind"]), F.lit("[PART]"))
        between = F.when(state["after_text"] & is_text, F.lit("[+]")).otherwise(F.lit(""))
        piece = F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)
        return F.struct(F.concat(state["out"], between, piece).alias("out"), is_text.alias("after_text"))

    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("after_text"))
    present = F.filter(F.coalesce(parts, F.expr(f"cast(array() as array<{PART}>)")), lambda p: p.isNotNull())
    return F.aggregate(present, start, visit, lambda s: s["out"])


def format_chat(turns: DataFrame) -> DataFrame:
    """Format turns (conv_id, turn, role, parts).

    One row per conversation and segment: conv_id, segment, n_turns, formatted, loss_spans (code points, end exclusive) and
    attachments (turn, part, kind, ref, tokens) in order of their placeholders.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    out = role == "assistant"
    body = flatten(F.col("parts"))
    def attachment(p: Column, i: Column) -> Column:
        row = F.struct(
            F.col("turn").cast("long").alias("turn"), i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            part_tokens(p).alias("tokens"),
        )
        return F.when(p.isNotNull() & ~p["kind"].eqNullSafe("text"), row)

    listed = F.array_compact(F.transform("parts", attachment))
    written = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), out.alias("out"), body.alias("body"),
        F.coalesce(listed, F.expr("cast(array() as array<struct<turn:bigint,part:int,kind:string,ref:string,tokens:bigint>>)")).alias("files"),
    ).select(
        "conv_id",
        F.floor(F.col("turn") / SEGMENT).alias("segment"),
        F.struct(
            "turn", "role", "body", "out", "files",
            F.concat(F.lit("<s>"), escape(F.col("role")), F.when(F.col("out"), F.lit("[OUT]")).otherwise(F.lit("[INST]"))).alias("head"),
            F.when(F.col("out"), F.lit("[/OUT]</s>")).otherwise(F.lit("[/INST]</s>")).alias("tail"),
        ).alias("_t"),
    )
    together = written.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list("_t")).alias("_turns"))

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(t["head"])
        end = begin + F.char_length(t["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + F.char_length(t["tail"])).alias("at"), F.when(t["out"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")
        )

    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    return together.select(
        "conv_id",
        "segment",
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), "").alias("formatted"),
        F.aggregate("_turns", start, add, lambda s: s["spans"]).alias("loss_spans"),
        F.flatten(F.transform("_turns", lambda t: t["files"])).alias("attachments"),
    )


def _plain(body: Column) -> Column:
    """The text of a formatted body: separators and placeholders out, control strings restored."""
    return unescape(F.regexp_replace(body, "\\[(?:\\+|IMG|AUDIO|DOC|PART)\\]", ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Read turns and masked texts back out of ``format_chat``'s strings: adds ``turns`` (role, text) and ``loss_text``."""
    shape = "(?s)^<s>(.*?)\\[(?:INST|OUT)\\](.*)\\[/(?:INST|OUT)\\]$"
    pieces = F.split("formatted", "</s>")
    turns = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, shape, 1)).alias("role"), _plain(F.regexp_extract(p, shape, 2)).alias("text")
        ),
    )
    masked = F.transform("loss_spans", lambda s: _plain(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("*", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = told.unionByName(trap)
    read = read_back(format_chat(rows.select("conv_id", "turn", "role", text_parts(text_or_empty()).alias("parts"))))
    line = F.lit("\n")
    told_again = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    per_segment = read.select(
        "conv_id", F.size("turns").cast("long").alias("n"), F.char_length("formatted").cast("long").alias("chars"),
        F.struct("segment", told_again.alias("told"), F.col("loss_text").alias("loss")).alias("_s"),
    )
    ordered = F.array_sort(F.collect_list("_s"))
    whole = per_segment.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), ordered.alias("_all"))
    loss = F.array_join(F.col("_all.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("_all.told"), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


_SQL_TAIL = "/?(?:s>|(?:INST|OUT|IMG|AUDIO|DOC|PART|\\+)\\])"
SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(role, '([<\\[])(\\\\*)({_SQL_TAIL})', '\\1\\\\\\2\\3', 'g')) AS r,
         length(regexp_replace(text, '([<\\[])(\\\\*)({_SQL_TAIL})', '\\1\\\\\\2\\3', 'g')) AS t
  FROM rows),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(3 + r + t + CASE WHEN role = 'assistant' THEN 5 + 6 ELSE 6 + 7 END + 4) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""
QUERIES = {"op2_chat_formatting": (op2_chat_formatting, SQL)}
