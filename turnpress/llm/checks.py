"""SQL for the queries that SQL can express, for the checking database (DuckDB)."""

from turnpress.llm import chat, licenses, rules, search
from turnpress.llm.queries import CHECKS

WORD = r"[^\x20\x09-\x0D]"

CHECKS["op1_embedding_neighbours"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
  r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
"""

_MEASURES = {
    "word_length": ("word_chars / greatest(n_words, 1)", "greatest(n_words, 1)"),
    "symbol_rate": ("n_symbols / greatest(n_words, 1)", "greatest(n_words, 1)"),
    "dup_line_rate": ("n_dup_lines / greatest(n_lines, 1)", "greatest(n_lines, 1)"),
    "repeat_rate": ("n_repeat_words / greatest(n_words, 1)", f"greatest(n_words, 1) / {rules.EVENT}"),
}
_LONG = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{name}' AS measure, CAST({value} AS DOUBLE) AS v, CAST({units} AS DOUBLE) AS u FROM judged WHERE NOT base_failed"
    for name, (value, units) in _MEASURES.items()
)
_ZERO = -(1 << 20)
_HIGH = f"CASE WHEN {{0}} = {_ZERO} THEN {rules.LEAST!r} ELSE exp(({{0}} + 0.01) * {rules.GAMMA!r}) END"
_LOW = f"CASE WHEN {{0}} = {_ZERO} THEN 0.0 ELSE exp(({{0}} - 1.01) * {rules.GAMMA!r}) END"


def _leaned(keys: str, wider: str, table: str) -> str:
    """Sketches by ``keys`` (each followed by a comma), merged with the scaled ones of the wider ``table``."""
    own = f"SELECT {keys} measure, bucket, CAST({rules.PARTS} * n AS BIGINT) AS n FROM sketch"
    share = f"n / sum(n) OVER (PARTITION BY {wider} measure)"
    lent = f"SELECT {wider} measure, bucket, CAST(floor(CAST({rules.WEIGHT * rules.PARTS} AS DOUBLE) * ({share})) AS BIGINT) AS n FROM {table}"
    groups = f"SELECT DISTINCT {keys} measure FROM sketch"
    return f"""
  SELECT {keys} measure, bucket, CAST(sum(n) AS BIGINT) AS n
  FROM ({own} UNION ALL SELECT {keys} measure, bucket, n FROM ({groups}) g JOIN ({lent}) l USING ({wider} measure)) x GROUP BY ALL"""


_AT = "min(bucket) FILTER (100 * upto >= {0} * total)"


CHECKS["op5_adaptive_rules"] = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('s' || lang, 'n') AS lang, coalesce('s' || source, 'n') AS source FROM documents),
word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}+') AS words FROM docs) x),
three AS (
  SELECT doc_id, i, w || chr(10) || lead(w) OVER o || chr(10) || lead(w, 2) OVER o AS t FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS n FROM three WHERE t IS NOT NULL) x WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM again) x GROUP BY doc_id),
sized AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY doc_id),
line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM docs) x WHERE regexp_matches(l, '{WORD}') GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.lang, d.source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN sized USING (doc_id) LEFT JOIN line USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
long AS ({_LONG}),
sketch AS (
  SELECT lang, source, measure, bucket, count(*) AS n FROM (
    SELECT *, CASE WHEN v <= {rules.LEAST} THEN {_ZERO} ELSE CAST(ceil(ln(v) / {rules.GAMMA!r}) AS INTEGER) END AS bucket FROM long) x
  GROUP BY ALL),
whole AS (SELECT measure, bucket, CAST({rules.PARTS} * sum(n) AS BIGINT) AS n FROM sketch GROUP BY ALL),
by_lang AS ({_leaned("lang,", "", "whole")}),
by_source AS ({_leaned("lang, source,", "lang,", "by_lang")}),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS total
  FROM by_source),
spots AS (
  SELECT lang, source, measure, {_AT.format(rules.TAIL)} AS b1, {_AT.format(50)} AS b2, {_AT.format(100 - rules.TAIL)} AS b3
  FROM ranked GROUP BY ALL),
fence AS (
  SELECT *, bottom - {rules.REACH} * (below - bottom) AS low, top + {rules.REACH} * (top - above) AS high
  FROM (
    SELECT lang, source, measure, {_LOW.format("b1")} AS bottom, {_HIGH.format("b2")} AS below, {_LOW.format("b2")} AS above, {_HIGH.format("b3")} AS top
    FROM spots) x),
outside AS (
  SELECT doc_id, count(*) AS n FROM long JOIN fence USING (lang, source, measure)
  WHERE CASE measure WHEN '{rules.LEVEL}' THEN v NOT BETWEEN low AND high ELSE v * u > high * u + {rules.ERRORS} * sqrt(high * u + 1) END
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND o.n IS NULL AS kept
FROM judged LEFT JOIN outside o USING (doc_id)
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, '~', '~0')"
    for i, control in enumerate(chat.CONTROLS, 1):
        text = f"replace({text}, '{control}', '~{i}')"
    return text


_MARKS = len(chat.BEGIN) + len(chat.MIDDLE) + len(chat.END)

CHECKS["op9_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum({_MARKS} + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""


def _field(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars"))) + " || {0})"
# CRC-32, bit by bit: reflected polynomial, all ones in and out.
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_RISE = 5  # levels: 16^5 leaves of a source, or sources


def _risen(name: str) -> str:
    """CTEs ``name0`` to ``name5``: the nodes ``(tree, i, d)`` of every level, from ``name0``; trees of one node stay."""
    return ", ".join(f"""
{name}{k + 1} AS (
  SELECT tree, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) x GROUP BY tree, i // 16)""" for k in range(_RISE))


def _walked(name: str, base: str, out: str) -> str:
    """CTEs from ``base(key, tree, i, proof, d)`` to ``out``: up one tree, with siblings and the folded digest."""
    steps, last = [], base
    for k in range(_RISE):
        now = out if k == _RISE - 1 else f"{out}_{k}"
        steps.append(f"""
{now} AS (
  SELECT b.key, b.tree, b.i // 16 AS i,
    CASE WHEN any_value(n.n) = 1 THEN any_value(b.proof) ELSE any_value(b.proof) || coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i <> b.i), '') END AS proof,
    CASE WHEN any_value(n.n) = 1 THEN any_value(b.d) ELSE sha256(string_agg(CASE WHEN n.i = b.i THEN b.d ELSE n.d END, '' ORDER BY n.i)) END AS d
  FROM {last} b JOIN (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) n ON n.tree = b.tree AND n.i // 16 = b.i // 16
  GROUP BY b.key, b.tree, b.i)""")
        last = now
    return ", ".join(steps)


CHECKS["op11_merkle_manifest"] = f"""
WITH docs AS (
  SELECT doc_id, source, {_LEAF.format(_field("text"))} AS leaf,
    CASE WHEN ({_CRC32.format("doc_id")}) % 5 = 0 THEN {_LEAF.format(_field(_ASCII_LOWER.format("text")))} END AS told FROM documents),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS key, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs),
a0 AS (SELECT tree, i, leaf AS d FROM placed), {_risen("a")},
b0 AS (SELECT 0 AS tree, tree AS i, d FROM a{_RISE}), {_risen("b")},
start AS (SELECT key, tree, i, '' AS proof, coalesce(told, leaf) AS d FROM placed),
{_walked("a", "start", "low")},
middle AS (SELECT key, 0 AS tree, tree AS i, proof, d FROM low),
{_walked("b", "middle", "high")}
SELECT p.doc_id, p.leaf, s.d AS subroot, r.d AS root, sha256(h.proof) AS proof_sha256, h.d AS folded_root, h.d = r.d AS verified
FROM placed p JOIN b0 s ON s.i = p.tree JOIN high h USING (key) CROSS JOIN b{_RISE} r
"""

CHECKS["op12_lexical_search"] = f"""
WITH words AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("text")}, '{search.TERM}') AS w FROM documents),
sized AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) x GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_ASCII_LOWER.format("text")}, '{search.TERM}')) AS term FROM benchmark),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term) x, total),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l)))) AS s
  FROM tf JOIN weight USING (term) JOIN sized USING (doc_id), total),
scored AS (SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored
QUALIFY rank <= 50
"""


def _wording(parts: list) -> str:
    """A template as a regular expression over words that each end in a space."""
    kinds = {licenses.ANY: "[^ ]+", licenses.NUMBER: "[0-9]+"}
    out = ""
    for p in parts:
        if isinstance(p, str):
            out += f"{p} "
        elif isinstance(p, list):
            out += f"(?:{_wording(p)})?"
        else:
            out += f"(?:(?:{'|'.join(kinds.get(w, w) for w in p.words)}) ){{{p.low},{p.high}}}"
    return out


_LABELS = [
    (label, licenses.mandatory(parts), f"regexp_matches(line, ' {_wording(parts)}')")
    for label, parts in ((name, licenses.parse(markup)) for name, markup in licenses.TEMPLATES.items())
]
_AT = "list_filter(range(1, len(w) + 1), lambda i: {0})"
_PLACES = {
    label: _AT.format(" AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))) for phrase, label in licenses.BASE.items()
}

CHECKS["op13_license_scan"] = f"""
WITH cut AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '{licenses.WORD}') AS w FROM documents),
spaced AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS line FROM cut),
base AS (SELECT *, {", ".join(f'{places} AS "at_{label}"' for label, places in _PLACES.items())} FROM spaced),
found AS (
  SELECT *, flatten([{", ".join(f'"at_{label}"' for label in _PLACES)}]) AS places,
    list_filter([{", ".join(f"CASE WHEN len({chr(34)}at_{label}{chr(34)}) > 0 THEN '{label}' END" for label in _PLACES)}], lambda x: x IS NOT NULL) AS low,
    list_filter([{", ".join(f"CASE WHEN {test} THEN '{label}' END" for label, _, test in _LABELS)}], lambda x: x IS NOT NULL) AS high,
    greatest(0, {", ".join([f'CASE WHEN len("at_{label}") > 0 THEN {len(phrase.split())} ELSE 0 END' for phrase, label in licenses.BASE.items()] + [f"CASE WHEN {test} THEN {k} ELSE 0 END" for _, k, test in _LABELS])}) AS k
  FROM base)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) - 1 AS BIGINT) AS first_word,
  CAST(list_max(places) - 1 AS BIGINT) AS last_word, array_to_string(list_sort(low), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(low, high))), ',') AS labels, CAST(k AS DOUBLE) / (k + 4) AS score
FROM found
"""
