"""Relational chat formatting (Spark expressions only).

A conversation becomes one string. Adjacent turns of one role share a block:

    <|role|>user<|text|>first text<|next|>second text<|end|>

Inside roles and texts, every `<`, backslashes, `|` gets one more backslash
after the `<`, so no text can hold a control string and removing one backslash
gives the text back. The loss mask lists the spans (code points) of the
assistant's escaped texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _split(text: Column, control: str) -> Column:
    return F.split(text, control.replace("|", r"\|"), -1)


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (array of start, end in code points).

    Turns stand in the order of turn (nulls first), role, text; null role or
    text: empty. Rows without conv_id form one conversation. Repeated rows are
    turns like any other. Pieces and their offsets are computed by windows
    that spill; only the finished string of a conversation is one value.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = ~F.coalesce(F.lag("role").over(order) == F.col("role"), F.lit(False))
    closes = ~F.coalesce(F.lead("role").over(order) == F.col("role"), F.lit(False))
    turns = (
        conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("k", F.row_number().over(order))
        .withColumn("head", F.when(opens, F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT))).otherwise(F.lit(NEXT)))
        .withColumn("body", escape(F.col("text")))
        .withColumn("tail", F.when(closes, F.lit(END)).otherwise(F.lit("")))
        .withColumn("stop", F.sum(F.length("head") + F.length("body") + F.length("tail")).over(running))
        .withColumn("end", (F.col("stop") - F.length("tail")).cast("int"))
        .withColumn("start", (F.col("end") - F.length("body")).cast("int"))
        .select("conv_id", F.struct("k", F.concat("head", "body", "tail").alias("piece"), (F.col("role") == loss_role).alias("loss"), "start", "end").alias("x"))
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("x")).alias("xs"))
        .select(
            "conv_id",
            F.array_join(F.transform("xs", lambda x: x.piece), "").alias("formatted"),
            F.transform(F.filter("xs", lambda x: x.loss), lambda x: F.struct(x.start.alias("start"), x.end.alias("end"))).alias("loss_spans"),
        )
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.filter(_split(formatted, END), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescape(F.substring(F.get(_split(block, TEXT), F.lit(0)), len(ROLE) + 1, 1 << 30))
        texts = _split(F.get(_split(block, TEXT), F.lit(1)), NEXT)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.end - s.start))), "")


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


#: The added conversation, whose texts hold control strings of other templates.
EXTRA = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3(spark, sf_dir) -> DataFrame:
    """Digests of what each formatted conversation says when read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    out = (
        format_conversations(rows.unionByName(extra))
        .withColumn("turns", read_back(F.col("formatted")))
        .withColumn("loss", masked_text(F.col("formatted"), F.col("loss_spans")))
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _digest(said).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _digest(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
x AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS opens,
         length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) AS role_chars, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS text_chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN opens THEN 8 + role_chars + 8 + 7 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
