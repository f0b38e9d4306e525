"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """The checksum of ASCII text, bit by bit."""
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
        "lambda s: ascii(s)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
        "lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))))"
    )


# -- op3: all windows by a 128-bit digest, each with the least document that has it ---------------

_NO_ID = 2**63 - 1
_OP3 = f"""
        WITH d AS (SELECT row_number() OVER () AS k, coalesce(doc_id, {_NO_ID}) AS own, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS MATERIALIZED (
            SELECT k, own, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i: md5_number(substring(x, 2 * i + 1, 100)))) AS s
            FROM (SELECT k, own, x, greatest(len(x) // 2 - 49, 0) AS n FROM d)
        ), h AS (
            SELECT k, i FROM w JOIN (SELECT s, min(own) AS least FROM w GROUP BY s HAVING count(*) > 1) USING (s) WHERE least < own
        ), g AS (
            SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS g
            FROM (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM (SELECT DISTINCT k, i FROM h))
        ), s AS (
            SELECT k, a, e, lag(e, 1, 0) OVER (PARTITION BY k ORDER BY a) AS before
            FROM (SELECT k, min(i) AS a, max(i) + 50 AS e FROM g GROUP BY k, g)
        ), t AS (
            SELECT k, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans,
                string_agg(substring(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substring(any_value(x), 2 * max(e) + 1) AS kept
            FROM s JOIN d USING (k) GROUP BY k
        )
        SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(coalesce(kept, x))) AS kept_sha256
        FROM d LEFT JOIN t USING (k)"""

# -- op11: a fold over each conversation's rows; a state holds its cost, edits and lines ---------

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NEVER = 1_000_000_000
_NONE = f"{{'c': {_NEVER}::BIGINT, 'a': '', 'l': []::VARCHAR[]}}"
_LINE = "role || ':' || text"
_FAULT_COST = f"CASE WHEN fault IN ('blank', 'duplicate') THEN {_NEVER} WHEN fault = 'truncated' THEN 1 ELSE 0 END"


def _edit(state: str, cost: int | str, letter: str, line: str | None = None) -> str:
    lines = f"list_append({state}.l, {line})" if line else f"{state}.l"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {lines}}}"


def _keep(state: str, initial: str) -> str:
    return _edit(state, f"({_FAULT_COST}) + CASE WHEN role LIKE '{initial}%' THEN 0 ELSE {_NEVER} END", "K", _LINE)


def _rename(state: str, role: str) -> str:
    return _edit(state, f"({_FAULT_COST}) + 2", "R", f"'{role}:' || text")


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _with_inserts(source: str) -> str:
    """Up to three turns inserted; s0 to s3 are nothing yet, after system, user, assistant."""
    for _ in range(3):
        user = _least("s2", *[_edit(s, 2, "I", "'user:'") for s in ("s0", "s1", "s3")])
        assistant = _least("s3", _edit("s2", 2, "I", "'assistant:'"))
        source = f"SELECT * EXCLUDE (s0, s1, s2, s3), s0, s1, {user} AS s2, {assistant} AS s3 FROM ({source})"
    return source


_BEFORE_USER = ("s0", "s1", "s3")
_STEP = {
    "s0": [_edit("s0", 3, "D")],
    "s1": [_edit("s1", 3, "D"), _keep("s0", "s")],
    "s2": [_edit("s2", 3, "D"), *[_keep(s, "u") for s in _BEFORE_USER], *[_rename(s, "user") for s in _BEFORE_USER]],
    "s3": [_edit("s3", 3, "D"), _keep("s2", "a"), _rename("s2", "assistant")],
}
_ROW = "SELECT w.conv_id, f.i, role, text, fault, s0, s1, s2, s3 FROM walk w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1"

_OP11 = f"""
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
            FROM conversations
        ), d AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM k)
        ), o AS (
            SELECT *, row_number() OVER w AS i
            FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                sha256(coalesce(conv_id::VARCHAR, '') || ':' || strlen(role) || ':' || role || text))
        ), r AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before, trim(text, {_SPACES}) AS t,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
            FROM o
        ), f AS (
            SELECT *, CASE WHEN t = '' THEN 'blank' WHEN again THEN 'duplicate'
                WHEN t[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM r
        ), walk AS (
            SELECT conv_id, 0 AS i, {{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, i, {", ".join(f"{_least(*v)} AS {k}" for k, v in _STEP.items())} FROM ({_with_inserts(_ROW)})
        ), done AS (
            SELECT conv_id, {_least("s0", "s3")} AS best FROM ({_with_inserts("SELECT * FROM walk")})
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id
        )
        SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
            sha256(array_to_string(best.l, chr(10))) AS repaired_sha256
        FROM done l LEFT JOIN counts c ON l.conv_id IS NOT DISTINCT FROM c.conv_id"""

# -- op12: pairs of equal words by lag, put together to stretches --------------------------------

_OP12 = f"""
        WITH w AS (
            SELECT row_number() OVER () AS k, doc_id, {_crc32("doc_id::VARCHAR")} AS h,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), p AS (
            SELECT k, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 % greatest(len(w), 1) AS a,
                1 + (len(w) - h // 10 % greatest(len(w), 1)) // (3 + h // 10 % 8) AS p
            FROM w
        ), x AS (
            SELECT k, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS s
            FROM (SELECT k, w, planted, a, p, unnest(range(n)) AS i FROM p)
        ), e AS (SELECT x.k, x.i, y.i - x.i AS q FROM x JOIN x y ON x.k = y.k AND x.s = y.s AND x.i < y.i),
        g AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM e),
        c AS (SELECT k, q, min(i) AS a, max(i) + 1 + q AS e FROM g GROUP BY k, q, g HAVING count(*) + q >= greatest(12, 2 * q)),
        r AS (
            SELECT k, a AS start, e - a AS length, q AS period FROM c
            WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.k = c.k AND d.q < c.q AND d.a <= c.a AND d.e >= c.e)
        ), s AS (
            SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
                arg_min({{'s': start, 'n': length, 'p': period}}, {{'n': -length, 's': start, 'p': period}}) AS best
            FROM r GROUP BY k
        ), t AS (
            SELECT k, string_agg(s, ' ' ORDER BY i) AS kept FROM x
            WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k = x.k AND x.i >= r.start + r.period AND x.i < r.start + r.length) GROUP BY k
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.n AS length, best.p AS period,
            1000 * best.n // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM p LEFT JOIN s USING (k) LEFT JOIN t USING (k)"""

ORACLES = {
    "op3_suffix_dedup": _OP3,
    "op11_conversation_repair": _OP11,
    "op12_periodic_runs": _OP12,
    "op2_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
        SELECT page_id, octet_length(b) AS payload_bytes, d AS payload_digest,
            CASE WHEN octet_length(b) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN octet_length(b) >= 100 AND page_id <> first THEN first END AS refers_to
        FROM p JOIN f USING (d)""",
    "op13_decontamination": """
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), x AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ), y AS (
            SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d CROSS JOIN (SELECT DISTINCT n FROM x) WHERE len(w) >= n)
        ), h AS (SELECT k, i, n, item FROM y JOIN x USING (n, s)),
        c AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM h) GROUP BY k),
        t AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY k)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (k) LEFT JOIN t USING (k)""",
    "op9_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
            vec_id, score
        FROM s QUALIFY rank <= 10""",
}
