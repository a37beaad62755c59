"""DuckDB twins of the queries that SQL can express, written from the results'
definitions and not from the operators."""

from __future__ import annotations

from contrail.llm.contamination import ORACLE_SQL as CONTAINMENT

#: 3-word shingles of lower-cased (A-Z) words, Jaccard of at least 0.85, smallest id reachable.
NEAR_DUPLICATES = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 2, 1)),
        lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
m AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM m JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
LEFT JOIN n ON n.doc_id = d.doc_id
"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

#: Base32 of the SHA-1 of the whole html; the smallest page of equal payloads is the response.
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(range(4),
         lambda i: substr({_B32}, CAST((CAST('0x' || substr(x, CAST(5 * g + 1 AS INT), 5) AS BIGINT) >> CAST(5 * (3 - i) AS INT)) & 31 AS INT) + 1, 1)), '')), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

_ESCAPED = r"replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"

#: Turns in order; the marked-turn template's length from its parts (roles are the three known ones).
CHAT = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || role || ': ' || {_ESCAPED} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars,
       CAST(NULL AS INT) AS rewritten_at
FROM t GROUP BY conv_id
"""


_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}                       # after writing u or a: 2 u, 3 a
WRITTEN = "role || ':' || text"
_KEEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _repair() -> str:
    """Damage, faults, and the least (cost, audit) of each state from the last row back."""
    def add(s: int, cost: str, edit: str, line: str | None, of: str = "v") -> str:
        after = f"{of}[{s + 1}]"
        lines = f"list_prepend({line}, {after}.l)" if line else f"{after}.l"
        return f"{{'c': {after}.c + {cost}, 'a': '{edit}' || {after}.a, 'l': {lines}}}"

    said = {2: "'user:'", 3: "'assistant:'"}
    base = []
    for s in range(4):
        ways = [add(s, "4", "D", None),
                f"CASE WHEN stays THEN {add(_NEXT[s], '3 + extra', 'R', said[_NEXT[s]] + ' || text')} END"]
        ways += [f"CASE WHEN stays AND initial = '{c}' THEN {add(t, 'extra', 'K', WRITTEN)} END"
                 for c, t in _KEEP[s].items()]
        base.append(f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]")
    once = [add(_NEXT[s], "3", "I", said[_NEXT[s]], "b") for s in range(4)]
    whole = [f"list_sort([b[{s + 1}], o[{s + 1}], {add(_NEXT[s], '3', 'I', said[_NEXT[s]], 'o')}])[1]" for s in range(4)]
    end = ("[{'c': 0, 'a': '', 'l': CAST([] AS VARCHAR[])}, {'c': 6, 'a': 'II', 'l': ['user:', 'assistant:']}, "
           "{'c': 3, 'a': 'I', 'l': ['assistant:']}, {'c': 0, 'a': '', 'l': CAST([] AS VARCHAR[])}]")
    return rf"""
WITH RECURSIVE
bits AS (SELECT range AS v, range AS c, 0 AS k FROM range(256)
         UNION ALL SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS draw FROM keyed, crc),
rows AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM drawn JOIN range(2) c(copy) ON copy = 0 OR draw = 3 WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    left(role, 1) AS initial,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM rows),
faults AS (SELECT *, CASE WHEN ending = '' THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
facts AS (SELECT *, fault NOT IN ('b', 'd') AS stays, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS extra FROM faults),
back AS (SELECT conv_id, max(i) + 1 AS i, {end} AS v FROM facts GROUP BY conv_id
         UNION ALL
         SELECT conv_id, i, [{', '.join(whole)}] FROM (SELECT *, [{', '.join(once)}] AS o FROM (
           SELECT f.conv_id, f.i, [{', '.join(base)}] AS b
           FROM back JOIN facts f ON f.conv_id IS NOT DISTINCT FROM back.conv_id AND f.i = back.i - 1))),
best AS (SELECT conv_id, v[1] AS v FROM back WHERE i = 1),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v.c, 0) AS BIGINT) AS cost, coalesce(v.a, '') AS audit,
    sha256(coalesce(array_to_string(v.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_near_duplicates": NEAR_DUPLICATES, "op3_warc_dictionary": WARC, "op8_chat_render": CHAT,
            "op10_benchmark_containment": CONTAINMENT, "op12_turn_repair": _repair()}
