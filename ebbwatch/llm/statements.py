"""DuckDB statements of the corpus queries that SQL can state."""

from __future__ import annotations

import string

from ebbwatch.llm.license_scan import license_templates

_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# The words of the contracts.
_WORDS_10 = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS_9 = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP10_DECONTAMINATION = f"""
WITH words AS (SELECT doc_id, coalesce({_WORDS_10}, []) AS w FROM documents),
items AS (SELECT item_id, {_WORDS_10} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS passage
    FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS passage
    FROM words, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS s(i)
),
found AS (SELECT DISTINCT doc_id, spots.n, i, item_id FROM spots JOIN windows USING (n, passage)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS s(p) GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found),
lists AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM named GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN lists USING (doc_id)
"""

OP9_SIMILARITY_JOIN = f"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce({_WORDS_9}, []) AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles AS x JOIN shingles AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
),
reached AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT words.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles,
       least(words.doc_id, coalesce(min(reached.other), words.doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id) GROUP BY words.doc_id
"""




def _license_rows() -> tuple[str, str]:
    """The templates as rows: words of phrases with their places, words of notices with what a block needs."""
    phrases, notices = [], []
    for number, t in enumerate(license_templates()):
        words = [w.decode() for w in t.words]
        if t.consecutive:
            phrases += [f"({number}, '{t.label}', {k}, '{w}', {len(words)})" for k, w in enumerate(words)]
        else:
            distinct = sorted(set(words))
            notices += [f"({number}, '{t.label}', {t.step}, {t.needed}, {len(distinct)}, '{w}')" for w in distinct]
    return ", ".join(phrases), ", ".join(notices)


def op11_license_scan() -> str:
    phrases, notices = _license_rows()
    return f"""
WITH words AS (SELECT doc_id, coalesce({_WORDS_10}, []) AS w FROM documents),
phrases(number, label, k, word, m) AS (VALUES {phrases}),
notices(number, label, step, needed, size, word) AS (VALUES {notices}),
known AS (SELECT word FROM phrases UNION SELECT word FROM notices),
spots AS (
    SELECT doc_id, i - 1 AS position, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS s(i)
    WHERE w[i] IN (SELECT word FROM known)
),
places AS (
    SELECT doc_id, label, position - k AS first FROM spots JOIN phrases USING (word)
    GROUP BY doc_id, number, label, m, position - k HAVING count(*) = m
),
blocks AS (
    SELECT doc_id, label, block, count(DISTINCT word) / size AS containment
    FROM spots JOIN notices USING (word), unnest([position // step, position // step - 1]) AS b(block) WHERE block >= 0
    GROUP BY doc_id, number, label, size, needed, block HAVING count(DISTINCT word) >= needed
),
base AS (
    SELECT doc_id, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY doc_id
),
every AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
    FROM (SELECT doc_id, label, 1.0::DOUBLE AS containment FROM places UNION ALL SELECT doc_id, label, containment FROM blocks) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text."""
    code = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    bit = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bit})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {code}), {byte}), 4294967295)"


# States: 0 before anything, s behind a system turn, u with an open pair, a behind a pair.
OP12_CONVERSATION_REPAIR = f"""
WITH RECURSIVE inserts(held, state, letters, cost, lines) AS (VALUES
    ('0', '0', '', 0, ''), ('s', 's', '', 0, ''), ('u', 'u', '', 0, ''), ('a', 'a', '', 0, ''),
    ('0', 'u', 'I', 5, 'user:\n'), ('s', 'u', 'I', 5, 'user:\n'), ('a', 'u', 'I', 5, 'user:\n'), ('u', 'a', 'I', 5, 'assistant:\n'),
    ('0', 'a', 'II', 10, 'user:\nassistant:\n'), ('s', 'a', 'II', 10, 'user:\nassistant:\n'),
    ('a', 'a', 'II', 10, 'user:\nassistant:\n'), ('u', 'u', 'II', 10, 'assistant:\nuser:\n')
),
edits(held, state, letter, initial) AS (VALUES
    ('0', 's', 'K', 's'), ('0', 'u', 'K', 'u'), ('s', 'u', 'K', 'u'), ('a', 'u', 'K', 'u'), ('u', 'a', 'K', 'a'),
    ('0', 'u', 'R', 'u'), ('s', 'u', 'R', 'u'), ('a', 'u', 'R', 'u'), ('u', 'a', 'R', 'a'),
    ('0', '0', 'D', ''), ('s', 's', 'D', ''), ('u', 'u', 'D', ''), ('a', 'a', 'D', '')
),
kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
    FROM conversations
),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS c(copy) WHERE kind <> 0
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM damaged
),
seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS initial,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous
    FROM numbered
),
turns AS (
    SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM seen
),
ways AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '0' AS held, {{'cost': 0, 'audit': '', 'lines': ''}} AS best FROM damaged
    UNION ALL
    SELECT t.conv_id, t.i, e.state, min({{
        'cost': w.best.cost + n.cost + CASE e.letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.letter <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': w.best.audit || n.letters || e.letter,
        'lines': w.best.lines || n.lines || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN t.role || ':' || t.text || chr(10)
            ELSE CASE e.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || t.text || chr(10) END
    }})
    FROM ways AS w JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
    JOIN inserts AS n ON n.held = w.held JOIN edits AS e ON e.held = n.state
    WHERE e.letter = 'D' OR t.fault IN ('', 'truncated') AND (e.letter = 'R') <> (e.initial = t.initial)
    GROUP BY t.conv_id, t.i, e.state
),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
),
ended AS (
    SELECT w.conv_id, min({{'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.letters, 'lines': w.best.lines || n.lines}}) AS best
    FROM ways AS w JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts AS n ON n.held = w.held
    WHERE n.state IN ('0', 'a') GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(left(best.lines, length(best.lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP13_PREFIX_TRIE = f"""
WITH original AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns,
           {crc32("CAST(any_value(conv_id) AS VARCHAR)")} % 6 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
made AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns
    FROM original AS c LEFT JOIN original AS b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (SELECT conv_id, d AS depth, turns[1 : d] AS prefix FROM made, unnest(range(0, len(turns) + 1)) AS p(d)),
nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM prefixes GROUP BY prefix, depth),
children AS (SELECT prefix[1 : depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, CASE depth WHEN 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END AS saved
    FROM nodes AS n LEFT JOIN children USING (prefix, depth)
),
sums AS (
    SELECT prefix[1 : d] AS prefix, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM whole, unnest(range(0, depth + 1)) AS a(d) GROUP BY ALL
),
ended AS (SELECT turns AS prefix, len(turns) AS depth, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM made GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM whole AS w JOIN sums USING (prefix, depth) LEFT JOIN ended USING (prefix, depth)
LEFT JOIN nodes AS p ON p.depth = w.depth - 1 AND p.prefix = w.prefix[1 : w.depth - 1]
"""


def corpus_statements() -> dict[str, str]:
    return {
        "op9_similarity_join": OP9_SIMILARITY_JOIN, "op10_decontamination": OP10_DECONTAMINATION,
        "op11_license_scan": op11_license_scan(), "op12_conversation_repair": OP12_CONVERSATION_REPAIR,
        "op13_prefix_trie": OP13_PREFIX_TRIE,
    }
