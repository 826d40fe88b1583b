"""Common table expressions for the checking database (DuckDB)."""

from turnpress.catalog.inputs import SINGLE_TURN_SQL, multi_turn_sql
from turnpress.functions.text import WHITESPACE

# White space as an SQL expression.
SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def strip(text: str) -> str:
    return f"trim({text}, {SPACES})"


def spaced(json_text: str) -> str:
    """Fits the derived rows: no comma or colon inside a string."""
    return f"replace(replace(CAST({json_text} AS VARCHAR), ',', ', '), ':', ': ')"


def spans(name: str, texts: str) -> str:
    """CTEs ending in ``name(id, i, start, span)``: balanced spans of ``texts(id, txt)``.

    Strings, braces and other runs are tokens; the depth is a running sum clamped at
    zero, a span runs from each step up to one to the next step down to zero.
    """
    return f"""
{name}_tok AS (
  SELECT id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS n FROM (
    SELECT id, regexp_extract_all(txt, '(?s)"(?:[^"\\\\]|\\\\.)*"?|[{{}}]|[^"{{}}]+') AS toks FROM {texts}) t),
{name}_sum AS (
  SELECT *, CASE tok WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END AS d,
    sum(CASE tok WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER w AS s,
    sum(length(tok)) OVER w AS upto
  FROM {name}_tok WINDOW w AS (PARTITION BY id ORDER BY n)),
{name}_depth AS (
  SELECT *, s - least(0, min(s) OVER (PARTITION BY id ORDER BY n)) AS depth FROM {name}_sum),
{name}_edge AS (
  SELECT id, n, upto, d, depth FROM {name}_depth
  WHERE (d = 1 AND depth = 1) OR (d = -1 AND depth = 0)),
{name}_edge2 AS (
  SELECT *, lag(d) OVER (PARTITION BY id ORDER BY n) AS before, lag(upto) OVER (PARTITION BY id ORDER BY n) AS opened FROM {name}_edge),
{name} AS (
  SELECT e.id, row_number() OVER (PARTITION BY e.id ORDER BY e.n) AS i, e.opened AS start,
    substr(t.txt, CAST(e.opened AS BIGINT), CAST(e.upto - e.opened + 1 AS BIGINT)) AS span
  FROM {name}_edge2 e JOIN {texts} t USING (id)
  WHERE e.d = -1 AND e.before = 1)"""


# Single-turn corpus: parsed lists, names and reasons.
SINGLE = f"""
raw1 AS ({SINGLE_TURN_SQL}),
lists1 AS (
  SELECT *,
    CASE WHEN json_valid(tools) THEN CASE WHEN json_type(tools) = 'ARRAY' THEN json_extract(tools, '$[*]') END END AS tl,
    CASE WHEN json_valid(answers) THEN CASE WHEN json_type(answers) = 'ARRAY' THEN json_extract(answers, '$[*]') END END AS al
  FROM raw1),
specs1 AS (
  SELECT *, list_transform(tl, lambda x: CASE WHEN json_extract_string(x, '$.type') = 'function' AND json_type(x, '$.function') = 'OBJECT'
      THEN json_extract(x, '$.function') ELSE x END) AS fl
  FROM lists1),
named1 AS (
  SELECT *,
    list_transform(fl, lambda f: CASE WHEN json_type(f, '$.name') = 'VARCHAR' THEN json_extract_string(f, '$.name') END) AS names,
    list_transform(fl, lambda f: CASE WHEN json_type(f, '$.name') = 'VARCHAR' THEN json_extract_string(f, '$.name') || '|'
      || coalesce(json_extract_string(f, '$.description'), '') || '|'
      || coalesce({spaced("json_extract(f, '$.parameters')")}, '{{}}') END) AS sigs,
    list_transform(al, lambda a: CASE WHEN json_type(a, '$.name') IS NULL THEN NULL
      WHEN json_type(a, '$.arguments') IS NULL THEN json_extract_string(a, '$.name') || '({{}})'
      WHEN json_type(a, '$.arguments') = 'OBJECT' THEN json_extract_string(a, '$.name') || '(' || {spaced("json_extract(a, '$.arguments')")} || ')'
      WHEN json_type(a, '$.arguments') = 'VARCHAR' AND json_valid(json_extract_string(a, '$.arguments'))
        THEN json_extract_string(a, '$.name') || '(' || json_extract_string(a, '$.arguments') || ')' END) AS calls
  FROM specs1),
flag1 AS (
  SELECT *, CASE
    WHEN query IS NULL OR length(query) NOT BETWEEN 5 AND 8000 THEN 'user_chars'
    WHEN tl IS NULL OR al IS NULL OR len(al) = 0 THEN 'json_lists'
    WHEN len(tl) NOT BETWEEN 1 AND 32 THEN 'tool_count'
    WHEN list_bool_or(list_transform(sigs, lambda s: s IS NULL)) OR list_bool_or(list_transform(calls, lambda c: c IS NULL)) THEN 'not_normalized'
    END AS reason
  FROM named1)"""

HEAD = r"(?m)(?:^|\n)\s*(USER|ASSISTANT|FUNCTION RESPONSE):\s*"

# Multi-turn corpus: declared tools, turns, calls, messages and reasons.
_MULTI_TEXT = f"""
raw2 AS ({multi_turn_sql("check")}),
sys2 AS (SELECT ord AS id, coalesce(system, '') AS txt FROM raw2)"""

_MULTI_TOOLS = f"""
decl2 AS (
  SELECT id AS ord, i, span, json_extract_string(span, '$.name') AS name,
    json_extract_string(span, '$.name') || '|' || coalesce(json_extract_string(span, '$.description'), '') || '|'
      || coalesce({spaced("json_extract(span, '$.parameters')")}, '{{}}') AS sig
  FROM (SELECT * FROM span2 WHERE json_valid(span)) s
  WHERE json_type(span, '$.name') = 'VARCHAR'),
tools2 AS (
  SELECT r.ord, count(d.name) AS n_tools, coalesce(list(d.name ORDER BY d.i) FILTER (d.name IS NOT NULL), []) AS names,
    coalesce(string_agg(d.sig, ';' ORDER BY d.i), '') AS sigs
  FROM raw2 r LEFT JOIN decl2 d USING (ord) GROUP BY r.ord)"""

_MULTI_TURNS = f"""
chat2 AS (SELECT ord, {strip("replace(coalesce(chat, ''), '<|endoftext|>', '')")} AS txt FROM raw2),
cut2 AS (SELECT ord, regexp_extract_all(txt, '{HEAD}', 1) AS roles, string_split_regex(txt, '{HEAD}') AS parts FROM chat2),
turns2 AS (
  SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY n) AS i, role, content FROM (
    SELECT ord, n, role, {strip("content")} AS content FROM (
      SELECT ord, unnest(roles) AS role, unnest(parts[2:]) AS content, generate_subscripts(roles, 1) AS n FROM cut2) u) v
  WHERE content <> '')"""

_MULTI_CALLS = f"""
mark2 AS (
  SELECT ord, i, role, content, role = 'ASSISTANT' AND contains(content, '<functioncall>') AS marked,
    substr(content, strpos(content, '<functioncall>') + 14) AS behind FROM turns2),
after2 AS (SELECT ord * 1000 + i AS id, substr(behind, strpos(behind, '{{')) AS txt FROM mark2 WHERE marked AND contains(behind, '{{'))"""

_MULTI_MESSAGES = f"""
obj2 AS (
  SELECT id, span, CASE WHEN json_valid(span) THEN span
    WHEN json_valid(replace(replace(span, '''', '"'), 'True', 'true')) THEN replace(replace(span, '''', '"'), 'True', 'true') END AS js,
    regexp_extract(span, '^\\{{"name": "([^"]*)", "arguments": ''(.*)''\\}}$', ['n', 'a']) AS quoted
  FROM callspan2 WHERE i = 1),
call2 AS (
  SELECT id, span, coalesce(json_extract_string(js, '$.name'), nullif(quoted.n, '')) AS name,
    coalesce({spaced("json_extract(js, '$.arguments')")}, quoted.a) AS args
  FROM obj2 WHERE js IS NOT NULL OR quoted.n <> ''),
msg2 AS (
  SELECT m.ord, m.i, m.marked, m.role AS raw_role, m.content AS raw_content, c.name, c.args, c.span,
    CASE m.role WHEN 'USER' THEN 'user' WHEN 'ASSISTANT' THEN 'assistant' ELSE 'tool' END AS role,
    CASE WHEN m.marked THEN {strip("string_split(m.content, '<functioncall>')[1]")} ELSE m.content END AS content,
    (m.role = 'USER' AND length(m.content) NOT BETWEEN 5 AND 8000) OR (m.marked AND c.name IS NULL) AS bad
  FROM mark2 m LEFT JOIN call2 c ON c.id = m.ord * 1000 + m.i),
conv2 AS (
  SELECT r.ord, count(m.i) AS n_messages, coalesce(bool_or(m.bad), true) AS bad,
    coalesce(bool_or(m.role = 'user'), false) AS has_user, coalesce(bool_or(m.role = 'assistant'), false) AS has_assistant,
    coalesce(bool_or(m.name IS NOT NULL AND NOT list_contains(t.names, m.name)), false) AS undeclared
  FROM raw2 r JOIN tools2 t USING (ord) LEFT JOIN msg2 m USING (ord) GROUP BY r.ord),
flag2 AS (
  SELECT c.*, t.n_tools, t.sigs, t.names, CASE WHEN t.n_tools NOT BETWEEN 1 AND 32 THEN 'tool_count'
    WHEN c.bad THEN 'chat' WHEN c.n_messages > 40 THEN 'message_count'
    WHEN NOT (c.has_user AND c.has_assistant) THEN 'role_presence'
    WHEN c.undeclared THEN 'undeclared_tool' END AS reason
  FROM conv2 c JOIN tools2 t USING (ord))"""

MULTI_TOOLS = ",".join([_MULTI_TEXT, spans("span2", "sys2"), _MULTI_TOOLS])
MULTI_TURNS = ",".join([f"raw2 AS ({multi_turn_sql('check')})", _MULTI_TURNS])
MULTI = ",".join([MULTI_TOOLS, _MULTI_TURNS, _MULTI_CALLS, spans("callspan2", "after2"), _MULTI_MESSAGES])

# Conversations and documents as examples: one row per message.
_CONV = "SELECT conv_id AS ord, turn AS i, role, text AS content FROM conversations"
_DOC = ("SELECT doc_id AS ord, 0 AS i, 'user' AS role, text AS content FROM documents UNION ALL "
        "SELECT doc_id, 1, 'assistant', lang FROM documents")


def rendered(messages: str) -> str:
    """CTEs ``seg(ord, i, role, txt)`` and ``toks(ord, n_tokens)`` of tool-free examples in byte ids."""
    return f"""
m AS ({messages}),
first AS (SELECT ord, arg_min(role, i) AS first_role FROM m GROUP BY ord),
seg AS (
  SELECT ord, -1 AS i, 'system' AS role, '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10) AS txt
  FROM first WHERE first_role <> 'system'
  UNION ALL
  SELECT ord, i, role, '<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10) FROM m),
toks AS (
  SELECT ord, CAST(sum(strlen(txt)) - 20 * count(*) AS BIGINT) AS n_tokens, bool_or(role = 'assistant') AS trained FROM seg GROUP BY ord)"""


RENDERED_CONV = rendered(_CONV)
RENDERED_DOC = rendered(_DOC)


def key(seed: str, column: str) -> str:
    return f"sha1({seed} || '|' || length(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR))"
