"""Inputs of the registered queries, derived from the given tables.

The raw corpora are written in SQL text that Spark and the checking database both run,
so both start from the same rows. Every row of the source tables takes part; the
number in ``events.props`` only selects how a row is written, well-formed or damaged.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnpress.operators.clean import conversation_examples, flag_multi_turn, flag_single_turn
from turnpress.schemas import CALLS, EXAMPLE, MESSAGES, MULTI_TURN, SINGLE_TURN, TOOLS
from turnpress.session import spread

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"

SINGLE_TURN_SQL = f"""
SELECT ord, query,
  CASE WHEN k BETWEEN 10 AND 12 THEN '{{}}'
       WHEN k BETWEEN 13 AND 14 THEN '['
       WHEN k BETWEEN 15 AND 17 THEN good_tools || ' junk'
       WHEN k BETWEEN 18 AND 20 THEN '[{{"name": "lookup"}}, {{"description": "no name"}}]'
       WHEN k BETWEEN 21 AND 23 THEN '[{{"name": 5}}]'
       WHEN k BETWEEN 24 AND 25 THEN '[]'
       WHEN k BETWEEN 26 AND 27 THEN '[' || repeat('{{"name": "a"}}, ', 32) || '{{"name": "b"}}]'
       WHEN k BETWEEN 28 AND 29 THEN '[' || repeat('{{"name": "a"}}, ', 31) || '{{"name": "b"}}]'
       WHEN k BETWEEN 63 AND 64 THEN '[{{"type": "function", "function": {{"name": "lookup", "description": null, "strict": true}}}}]'
       ELSE good_tools END AS tools,
  CASE WHEN k BETWEEN 30 AND 32 THEN '[]'
       WHEN k BETWEEN 33 AND 35 THEN '[{{"name": "' || event_type || '", "argu'
       WHEN k BETWEEN 36 AND 38 THEN '[{{"name": "' || event_type || '", "arguments": [1]}}]'
       WHEN k BETWEEN 39 AND 41 THEN '[{{"name": "' || event_type || '", "arguments": "{{' || chr(92) || '"k' || chr(92) || '": ' || CAST(k AS STRING) || '}}"}}]'
       WHEN k BETWEEN 42 AND 44 THEN '[{{"name": "' || event_type || '", "arguments": "not json"}}]'
       WHEN k BETWEEN 45 AND 47 THEN '[{{"name": "' || event_type || '"}}]'
       WHEN k BETWEEN 48 AND 50 THEN '[{{"name": "' || event_type || '", "arguments": null}}]'
       WHEN k BETWEEN 51 AND 53 THEN '[{{"name": "' || event_type || '", "arguments": ' || props || '}}, {{"name": "lookup", "arguments": {{}}}}]'
       WHEN k BETWEEN 54 AND 55 THEN '[{{"arguments": {{}}}}]'
       WHEN k BETWEEN 60 AND 62 THEN '[{{"name": "' || event_type || '", "arguments": {{"z": 1.50, "tags": ["a", "b"]}}}}]'
       ELSE '[{{"name": "' || event_type || '", "arguments": ' || props || '}}]' END AS answers
FROM (
  SELECT event_id AS ord, event_type, props, {_K} AS k,
    CASE WHEN {_K} < 4 THEN 'abcd' WHEN {_K} < 7 THEN NULL WHEN {_K} < 9 THEN ''
         WHEN {_K} BETWEEN 56 AND 58 THEN repeat('x', 8001) WHEN {_K} = 59 THEN repeat('x', 8000)
         ELSE 'please log a ' || event_type || ' event for user ' || CAST(user_id AS STRING) END AS query,
    '[{{"name": "' || event_type || '", "description": "records one ' || event_type || ' event", '
      || '"parameters": {{"type": "object", "properties": {{"k": {{"type": "integer"}}}}}}}}, '
      || '{{"type": "function", "function": {{"name": "lookup", "parameters": {{"q": "text"}}}}}}]' AS good_tools
  FROM events) AS e
"""

# The join of lines is the one place where the two dialects differ.
_JOIN_LINES = {
    "spark": "listagg(line, chr(10) || chr(10)) WITHIN GROUP (ORDER BY turn)",
    "check": "string_agg(line, chr(10) || chr(10) ORDER BY turn)",
}


def multi_turn_sql(dialect: str) -> str:
    """Raw multi-turn corpus: every conversation with all its turns, whether or not an event has its number."""
    quote = "chr(39)"
    return f"""
SELECT conv_id AS ord,
  CASE WHEN k BETWEEN 40 AND 42 THEN coalesce(max(prompt), '') || ' No functions here.'
       WHEN k = 43 THEN NULL
       WHEN k BETWEEN 45 AND 49 THEN 'It is 5" wide. ' || max(declared)
       WHEN k BETWEEN 50 AND 54 THEN max(declared) || ' {{"no": 1}} {{bad}} {{"name": 7}} {{'
       ELSE coalesce(max(prompt), '') || ' Use these functions - ' || max(declared) END AS system,
  CASE WHEN k BETWEEN 55 AND 59 THEN 'Some preamble.' || chr(10) ELSE '' END || {_JOIN_LINES[dialect]} AS chat
FROM (
  SELECT conv_id, turn, k,
    CASE WHEN role = 'system' THEN text END AS prompt,
    '{{' || chr(10) || '"name": "' || event_type || '", "description": "records }} it", "parameters": {{"k": {{"type": "integer"}}}}}}'
      || chr(10) || '{{"name": "lookup"}}' AS declared,
    CASE
      WHEN role = 'user' AND k BETWEEN 60 AND 64 THEN 'ASSISTANT: ' || text
      WHEN role = 'user' AND k BETWEEN 65 AND 67 THEN 'USER: hey'
      WHEN role = 'user' AND k BETWEEN 68 AND 70 THEN 'USER: ' || repeat(text, 450)
      WHEN role = 'user' THEN 'USER: ' || text
      WHEN role = 'assistant' AND k < 10 THEN 'ASSISTANT: ' || text || ' <functioncall> {{"name": "' || event_type
        || '", "arguments": ' || {quote} || props || {quote} || '}} tail <|endoftext|>' || chr(10) || 'FUNCTION RESPONSE: {{"status": "ok"}}'
      WHEN role = 'assistant' AND k < 20 THEN 'ASSISTANT: <functioncall> {{"name": "' || event_type
        || '", "arguments": ' || props || '}} <|endoftext|>' || chr(10) || chr(10) || 'FUNCTION RESPONSE: {{"status": "ok"}}' || chr(10) || 'ASSISTANT: ' || text
      WHEN role = 'assistant' AND k < 30 THEN 'ASSISTANT: <functioncall> {{"name": "missing_tool", "arguments": {{}}}} <|endoftext|>'
      WHEN role = 'assistant' AND k < 35 THEN 'ASSISTANT: <functioncall> {{"name": "' || event_type || ' <|endoftext|>'
      WHEN role = 'assistant' AND k < 40 THEN 'ASSISTANT: ' || text || ' <functioncall> {{' || {quote} || 'name' || {quote} || ': ' || {quote}
        || event_type || {quote} || ', ' || {quote} || 'arguments' || {quote} || ': {{' || {quote} || 'ok' || {quote} || ': True}}}} <|endoftext|>'
      WHEN role = 'assistant' AND k BETWEEN 75 AND 79 THEN 'ASSISTANT: ' || text || repeat(chr(10) || 'USER: again' || chr(10) || 'ASSISTANT: and again', 21)
      WHEN role = 'assistant' AND k BETWEEN 85 AND 87 THEN 'ASSISTANT: <functioncall> {{"arguments": {{}}}} <|endoftext|>'
      WHEN role = 'assistant' AND k BETWEEN 80 AND 84 THEN 'ASSISTANT: ' || chr(10) || chr(10) || 'ASSISTANT: see USER: ' || text || ' <|endoftext|> <|endoftext|>'
      WHEN role = 'assistant' THEN 'ASSISTANT: ' || text || ' <|endoftext|>'
    END AS line
  FROM (
    SELECT conv_id, turn, role, text, event_type, props, {_K} AS k FROM (
      SELECT c.conv_id, c.turn, c.role, c.text, coalesce(e.event_type, 'view') AS event_type,
        coalesce(e.props, '{{"k": ' || CAST(c.conv_id % 100 AS STRING) || '}}') AS props
      FROM conversations AS c LEFT JOIN events AS e ON c.conv_id = e.event_id) AS joined) AS marked) AS written
GROUP BY conv_id, k
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_single_turn(spark, sf_dir) -> DataFrame:
    spread(table(spark, sf_dir, "events")).createOrReplaceTempView("events")
    return spark.sql(SINGLE_TURN_SQL)


def raw_multi_turn(spark, sf_dir) -> DataFrame:
    for name in ("events", "conversations"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(multi_turn_sql("spark"))


def flagged_single_turn(spark, sf_dir) -> DataFrame:
    return flag_single_turn(raw_single_turn(spark, sf_dir))


def flagged_multi_turn(spark, sf_dir) -> DataFrame:
    return flag_multi_turn(raw_multi_turn(spark, sf_dir))


def conversations(spark, sf_dir) -> DataFrame:
    """One example per conversation, without tools."""
    return conversation_examples(table(spark, sf_dir, "conversations"))


def text_examples(texts: DataFrame, ord_: str, text: str, answer: str, source: str) -> DataFrame:
    """A text as the user turn and a short answer as the assistant turn."""

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(None).cast(CALLS).alias("tool_calls"))

    return texts.select(
        F.col(ord_).alias("ord"), F.lit(source).alias("source"), F.array().cast(TOOLS).alias("tools"),
        F.array(message("user", F.col(text)), message("assistant", F.col(answer))).cast(MESSAGES).alias("messages"),
    ).select(*EXAMPLE.fieldNames())


def documents(spark, sf_dir, source: str = SINGLE_TURN) -> DataFrame:
    """Every document as a user turn, answered by its language."""
    return text_examples(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")), "doc_id", "text", "lang", source)


def repeated_conversations(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The conversations, and all of them again in capitals with space around the text."""
    turns = table(spark, sf_dir, "conversations")
    loud = turns.withColumn("text", F.concat(F.lit(" \t"), F.translate("text", string.ascii_lowercase, string.ascii_uppercase), F.lit("\n ")))
    return conversation_examples(turns, SINGLE_TURN), conversation_examples(loud, MULTI_TURN)


def losses(spark, sf_dir) -> DataFrame:
    """Loss table ``(step, rank, micro, loss, n_tokens)``: four ranks, two micro-batches a step."""
    return table(spark, sf_dir, "events").select(
        (F.floor(F.col("event_id") / 8) + 1).cast("bigint").alias("step"),
        (F.col("event_id") % 4).cast("int").alias("rank"),
        (F.floor(F.col("event_id") / 4) % 2).cast("int").alias("micro"),
        F.col("value").alias("loss"),
        F.get_json_object("props", "$.k").cast("bigint").alias("n_tokens"),
    )
