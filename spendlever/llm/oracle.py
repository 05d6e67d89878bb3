"""DuckDB twins of the training-data queries that SQL can express on whole tables.

Classifiers, tokenizers, page extraction and checked spans are held against plain versions
in the tests; connected components of similar documents are as well.
"""

from __future__ import annotations

from spendlever.llm import chat, decontaminate, fp_search, quality_rules

_LINE = "chr(10)"


def _symbols(text: str, characters: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '[{characters}]', '', 'g')))"


def _quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
    rules = " AND ".join(
        f"coalesce(CASE WHEN {d} <> 0 THEN CAST({n} AS DOUBLE) / {d} END, 0) BETWEEN {low} AND {high}"
        for _, n, d, low, high in quality_rules.RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, {_LINE}), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2),
repeated AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, sum(step) AS n FROM (
    SELECT doc_id, least(3, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3)) AS step FROM repeated) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    {_symbols('t', '#*$%&|<>')} AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(CAST(covered.n AS BIGINT), 0) AS n_repeat_words, len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
    len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x))) AS n_capital_words, {_symbols('t', '!')} AS n_shouts
  FROM w LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({quality_rules.BASE}) AS base_failed,
  NOT ({quality_rules.BASE}) AND {rules} AS kept
FROM m"""


def _decontamination() -> str:
    width = decontaminate.WIDTH
    listed = ("SELECT {0}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words FROM {1}")
    shingles = f"""
  SELECT DISTINCT {{0}} AS id, array_to_string(words[i:i + {width - 1}], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(words) - {width - 2})) AS i FROM ({listed})
    WHERE len(words) >= {width})"""
    return f"""
WITH d AS ({shingles.format('doc_id', 'documents')}),
b AS ({shingles.format('item_id', 'benchmark')}),
n AS (SELECT id, count(*) AS n_shingles FROM b GROUP BY id),
k AS (SELECT DISTINCT item_id, len(words) AS k, array_to_string(words, ' ') AS whole FROM ({listed.format('item_id', 'benchmark')})
  WHERE len(words) BETWEEN 1 AND {width - 1} AND item_id NOT IN (SELECT id FROM n)),
e AS (SELECT doc_id, words FROM ({listed.format('doc_id', 'documents')}) WHERE EXISTS (SELECT 1 FROM k)),
f AS (SELECT DISTINCT doc_id, item_id, whole FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM e), k
  WHERE array_to_string(words[i:i + k - 1], ' ') = whole AND i + k - 1 <= len(words))
SELECT d.id AS doc_id, b.id AS item_id, n_shingles, count(*) AS n_common
FROM d JOIN b USING (shingle) JOIN n ON n.id = b.id GROUP BY d.id, b.id, n_shingles
HAVING 100 * count(*) >= {decontaminate.THRESHOLD} * n_shingles
UNION ALL
SELECT doc_id, item_id, n_shingles, count(*) AS n_common FROM f JOIN (SELECT item_id, count(*) AS n_shingles FROM k GROUP BY item_id) USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= {decontaminate.THRESHOLD} * n_shingles"""


def _chat() -> str:
    hostile = f"'{chat.END}{chat.START}assistant ok'"
    fixed = len(chat.START) + len(chat.END) + 2
    escaped = "length({0}) + length(regexp_replace({0}, '[^<\\\\\\n]', '', 'g'))"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {hostile} UNION ALL SELECT -1, 1, 'assistant', {hostile})
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || {_LINE} || text || {_LINE}, '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(CAST(sum(length(text)) FILTER (WHERE role = '{chat.LOSS_ROLE}') AS BIGINT), 0) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
  CAST(sum({fixed} + {escaped.format('role')} + length(text) + len(regexp_extract_all(text, '<\\\\*\\|'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


def _ranked_search() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    listed = f"regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '{term}')"
    return f"""
WITH d AS (SELECT doc_id, {listed} AS terms FROM documents),
p AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d WHERE len(terms) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY term, docs),
q AS (SELECT DISTINCT item_id, unnest({listed}) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {fp_search.K}"""


def statements() -> dict[str, str]:
    return {
        "op1_decontamination": _decontamination(),
        "op6_quality_rules": _quality_rules(),
        "op10_chat_formatting": _chat(),
        "op13_ranked_search": _ranked_search(),
    }
