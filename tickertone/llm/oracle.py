"""Plain SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from .catalog import MIX, ORACLES
from .mixing import LEVELS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", LOWER.format("coalesce(text, '')"))} AS ws
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
        THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
meets AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM meets JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * common >= 85 * (a.n + b.n - common)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
roots AS (SELECT x AS doc_id, least(x, min(y)) AS root FROM reach GROUP BY x),
degrees AS (SELECT x AS doc_id, count(*) AS n FROM links GROUP BY x)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
    coalesce(degrees.n, 0) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
LEFT JOIN degrees USING (doc_id)
"""

ORACLES["op3_chat_preferences"] = """
WITH turns AS (
    SELECT DISTINCT conv_id AS conv, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role,
        coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
replies AS (
    SELECT conv, max(turn) AS last, min((turn, text)) AS reply FROM turns
    WHERE role = 'assistant' GROUP BY conv),
openings AS (SELECT conv, min((turn, role, text)) AS o FROM turns GROUP BY conv),
facts AS (
    SELECT conv, last, CASE WHEN reply[1] < last THEN reply[2] ELSE o[3] END AS stale
    FROM replies JOIN openings USING (conv)),
heads AS (
    SELECT conv, min(conv) OVER (PARTITION BY o[2], o[3]) AS head FROM openings),
sides AS (
    SELECT 'stale' AS kind, conv AS chosen_id, conv AS rejected_id, side, turn, role,
        CASE WHEN side = 'rejected' AND role = 'assistant' AND turn = last THEN stale ELSE text END AS text
    FROM turns JOIN facts USING (conv), (VALUES ('chosen'), ('rejected')) s(side) WHERE turn <= last
    UNION ALL
    SELECT 'opening', head, h.conv, 'chosen', turn, role, text
    FROM heads h JOIN turns t ON t.conv = head WHERE head <> h.conv
    UNION ALL
    SELECT 'opening', head, h.conv, 'rejected', turn, role, text
    FROM heads h JOIN turns t ON t.conv = h.conv WHERE head <> h.conv),
surplus AS (
    SELECT kind, chosen_id, rejected_id, turn FROM sides
    GROUP BY kind, chosen_id, rejected_id, turn, role, text
    HAVING sum(CASE WHEN side = 'chosen' THEN 1 ELSE -1 END) <> 0),
cuts AS (
    SELECT kind, chosen_id, rejected_id, min(turn) AS cut FROM surplus GROUP BY ALL),
parts AS (
    SELECT s.*, CASE WHEN cut IS NULL OR turn < cut THEN 'prompt' ELSE side END AS part,
        '<|' || role || E'|>\\n' || text || E'<|end|>\\n' AS shown
    FROM sides s LEFT JOIN cuts USING (kind, chosen_id, rejected_id)
    WHERE side = 'chosen' OR turn >= cut),
placed AS (
    SELECT *, sum(length(shown)) OVER (PARTITION BY kind, chosen_id, rejected_id, part
        ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS until
    FROM parts)
SELECT kind, chosen_id, rejected_id, CAST(0 AS BIGINT) AS piece,
    count(*) FILTER (part = 'prompt') AS n_prompt_turns,
    coalesce(string_agg(shown, '' ORDER BY turn, role, text) FILTER (part = 'prompt'), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen,
    coalesce(string_agg((until - length(text) - 8) || ':' || (until - 1), ',' ORDER BY turn, role, text)
        FILTER (part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg(shown, '' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected,
    coalesce(string_agg((until - length(text) - 8) || ':' || (until - 1), ',' ORDER BY turn, role, text)
        FILTER (part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY kind, chosen_id, rejected_id
"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in MIX.weights.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1.0 END" if cases else "1.0::DOUBLE"


def _level(i: int) -> str:
    """CTEs that deal the budgets of the level above to the nodes of level ``i``."""
    above, own = ", ".join(LEVELS[:i]), ", ".join(LEVELS[:i + 1])
    family = f"PARTITION BY {above}" if above else ""
    join = f"JOIN given{i} USING ({above})" if above else "CROSS JOIN given0"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    order = f"ORDER BY cap / w, {LEVELS[i]}"
    return f"""
nodes{i} AS (
    SELECT {own}, cap, budget AS given, {_weight(LEVELS[i])} AS w
    FROM (SELECT {own}, CAST(sum(cap) AS BIGINT) AS cap FROM leaves GROUP BY {own}) {join}
    WHERE cap > 0),
full{i} AS (
    SELECT *, cap / w * (sum(w) OVER ({family}) - coalesce(sum(w) OVER ({family} {order} {before}), 0))
        <= given - coalesce(sum(cap) OVER ({family} {order} {before}), 0) AS is_full
    FROM nodes{i}),
given{i + 1} AS (
    SELECT {own}, CAST(CASE WHEN is_full THEN cap ELSE least(cap, floor(
        w * (given - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}))
        / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({family}) + 1e-6)) END AS BIGINT) AS budget
    FROM full{i})"""


ORACLES["op7_source_mixing"] = f"""
WITH docs AS (
    SELECT doc_id, coalesce('d' || (TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) % 4), '')
        AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        coalesce(CAST(doc_id AS VARCHAR), '') AS id, len({WORDS}) AS tokens
    FROM documents),
leaves AS (
    SELECT {", ".join(LEVELS)}, sum(tokens) AS tokens,
        sum(CASE WHEN {" AND ".join(f"{_weight(x)} > 0" for x in LEVELS)} THEN tokens ELSE 0 END) * {MIX.max_epochs} AS cap
    FROM docs GROUP BY ALL),
given0 AS (
    SELECT least(CAST(floor(sum(tokens) * {MIX.share}) AS BIGINT), CAST(sum(cap) AS BIGINT)) AS budget
    FROM leaves),{",".join(_level(i) for i in range(3))},
rests AS (
    SELECT l.*, budget, CAST(floor(budget / tokens) AS BIGINT) AS epochs,
        budget - CAST(floor(budget / tokens) AS BIGINT) * tokens AS rest
    FROM leaves l JOIN given3 USING ({", ".join(LEVELS)}) WHERE budget > 0),
keyed AS (
    SELECT d.doc_id, r.*, md5('{MIX.seed}:' || epochs || ':' || id) AS key, d.tokens AS n
    FROM docs d JOIN rests r USING ({", ".join(LEVELS)})),
taken AS (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY {", ".join(LEVELS)} ORDER BY key
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
        - sum(n) OVER (PARTITION BY {", ".join(LEVELS)}, key) AS before
    FROM keyed)
SELECT doc_id, domain, lang, source, budget AS leaf_budget,
    epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS copies
FROM taken WHERE epochs + CASE WHEN before < rest THEN 1 ELSE 0 END > 0
"""

ORACLES["op8_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
later AS (
    SELECT doc_id, i FROM windows
    QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op10_quality_rules"] = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
windows AS (
    SELECT doc_id, i, ws[i:i + 2] AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (
    SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM twice)
    GROUP BY doc_id),
lines AS (
    SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM w)),
real AS (
    SELECT *, regexp_replace({LOWER.format("array_to_string(ws, ' ')")}, '[0-9]', '0', 'g') AS normal
    FROM lines WHERE len(ws) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM real GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
common AS (
    SELECT r.source, normal FROM real r JOIN hosts h ON r.source IS NOT DISTINCT FROM h.source
    GROUP BY r.source, normal, h.docs HAVING count(DISTINCT doc_id) > greatest(20, 0.01 * h.docs)),
lost AS (
    SELECT doc_id, sum(len(ws)) AS n
    FROM real r JOIN common c ON r.source IS NOT DISTINCT FROM c.source AND r.normal = c.normal GROUP BY doc_id),
facts AS (
    SELECT w.doc_id, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
        CAST(coalesce(lost.n, 0) AS BIGINT) AS n_common_words
    FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND n_words - n_common_words >= 0.5 * n_words AS kept
FROM facts
"""

CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_concat([i], range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i)))"""
CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({0}))),
    lambda k: CAST('0x' || substr(hex(encode({0})), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, k: xor(c >> 8, tab[xor(c & 255, k) + 1])), 4294967295)"""

ORACLES["op12_conversation_trie"] = f"""
WITH RECURSIVE {CRC_TABLE},
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, len({WORDS}) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT c, n, {CRC.format("CAST(c AS VARCHAR)")} % 4 AS h, c - c % 20 AS base
    FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc),
rebuilt AS (
    SELECT v.c, t.i AS d, role, text, words FROM convs v JOIN turns t ON t.c = v.base AND t.i <= h
    UNION ALL
    SELECT v.c, coalesce(least(v.h, b.n), 0) + t.i - v.h, role, text, words
    FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h LEFT JOIN convs b ON b.c = v.base),
ids AS (SELECT *, dense_rank() OVER (ORDER BY role, text) AS turn FROM rebuilt),
paths AS (
    SELECT c, CAST(0 AS BIGINT) AS d, sha256('') AS path, CAST(NULL AS VARCHAR) AS above,
        CAST(0 AS BIGINT) AS words FROM convs
    UNION ALL
    SELECT p.c, p.d + 1, sha256(path || ':' || turn), path, i.words
    FROM paths p JOIN ids i ON i.c = p.c AND i.d = p.d + 1),
ended AS (SELECT c, d, d = max(d) OVER (PARTITION BY c) AS last, path, above, words FROM paths),
nodes AS (
    SELECT d, path, any_value(above) AS above, min(c) AS c, count(*) AS n, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends
    FROM ended GROUP BY d, path),
children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above),
facts AS (
    SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
sums AS (
    SELECT e.path, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n - 1) * f.words) AS saved
    FROM facts f JOIN ended e ON e.c = f.c AND e.d <= f.d GROUP BY e.path)
SELECT f.c AS conv_id, f.d AS depth, p.c AS parent_conv_id, f.n AS n_convs, f.n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM facts f JOIN sums USING (path) LEFT JOIN nodes p ON p.path = f.above
"""

ORACLES["op13_spelling_variants"] = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
checked AS (
    SELECT run, n, {CRC.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, crc),
words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
        AS word, CAST(sum(n) AS BIGINT) AS n
    FROM checked GROUP BY 1),
vocabulary AS (SELECT * FROM words WHERE length(word) >= 5 AND n >= 3),
without AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM without a JOIN without b
        ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM without a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM without a JOIN vocabulary b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM pairs GROUP BY word),
forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
    FROM vocabulary v LEFT JOIN best USING (word)),
steps AS (
    SELECT word, word AS tip, form AS next FROM forms
    UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next)
SELECT f.word, form, tip AS root, n, n_near, form_n FROM forms f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""
