"""DuckDB SQL of the queries that need more than one plain statement."""

from __future__ import annotations

_BARE = "trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_CRC = """xor(list_reduce(list_concat([4294967295], [CAST(ascii({x}[j]) AS BIGINT) FOR j IN range(1, length({x}) + 1)]),
                             lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""


def _way(cost, edit: str, state: int, when: str | None = None) -> str:
    s = f"{{'c': c{state} + {cost}, 'a': '{edit}' || a{state}}}"
    return f"CASE WHEN {when} THEN {s} END" if when else s


def _ways(state: int) -> str:
    """The cheapest way to pass a row from a grammar state: delete, keep or rename it."""
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    need = "a" if state == 2 else "u"
    out = [_way(3, "D", state), _way("cut", "K", nxt, f"NOT gone AND ini = '{need}'"), _way("2 + cut", "R", nxt, "NOT gone")]
    if state == 0:
        out.append(_way("cut", "K", 1, "NOT gone AND ini = 's'"))
    return "least(" + ", ".join(out) + ")"


def repair_sql() -> str:
    """Conversation repair: costs and audits from the end, row by row, then the audit replayed."""
    best = ", ".join(f"least(b{q}, {{'c': b{n}.c + 2, 'a': 'I' || b{n}.a}}) AS s{q}" for q, n in ((0, 2), (1, 2), (2, 3), (3, 2)))
    return f"""
        WITH RECURSIVE named AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
        hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format(x="name")} % 20 AS kind FROM named),
        hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN
                    regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
        placed AS (SELECT *, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS ini, {_BARE.format(x="text")} AS bare,
                          row_number() OVER w AS i, lag(role[1]) OVER w || role[1] AS pair
                   FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        seen AS (SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
        r AS MATERIALIZED (SELECT *, blank OR again AS gone, CAST(NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS INT) AS cut,
                     pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') AS odd FROM seen),
        facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                         count(*) FILTER (NOT blank AND again) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated, count(*) FILTER (odd) AS illegal, max(i) AS n
                  FROM r GROUP BY conv_id),
        togo AS (SELECT conv_id, n AS i, CAST(0 AS BIGINT) AS c0, '' AS a0, CAST(4 AS BIGINT) AS c1, 'II' AS a1, CAST(2 AS BIGINT) AS c2, 'I' AS a2,
                        CAST(0 AS BIGINT) AS c3, '' AS a3 FROM facts
                 UNION ALL
                 SELECT conv_id, i - 1, s0.c, s0.a, s1.c, s1.a, s2.c, s2.a, s3.c, s3.a FROM (SELECT conv_id, i, {best} FROM (
                    SELECT togo.conv_id, togo.i, {", ".join(f"{_ways(q)} AS b{q}" for q in range(4))}
                    FROM togo JOIN r ON r.conv_id IS NOT DISTINCT FROM togo.conv_id AND r.i = togo.i))),
        best AS MATERIALIZED (SELECT conv_id, c0 AS cost, a0 AS audit FROM togo WHERE i = 0),
        replay AS (SELECT conv_id, audit, 0 AS p, CAST(1 AS BIGINT) AS i, 0 AS state, CAST([] AS VARCHAR[]) AS lines FROM best
                   UNION ALL
                   SELECT conv_id, audit, p + 1, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
                          CASE WHEN e = 'D' THEN state WHEN e = 'K' AND state = 0 AND ini = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END,
                          CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                                 ELSE list_append(lines, CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN e = 'R' THEN text ELSE '' END) END
                   FROM (SELECT replay.*, audit[p + 1] AS e, r.ini, r.role, r.text FROM replay LEFT JOIN r
                         ON r.conv_id IS NOT DISTINCT FROM replay.conv_id AND r.i = replay.i) WHERE p < length(audit)),
        done AS (SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS repaired_sha256 FROM replay WHERE p = length(audit))
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
             LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id"""


_ROUND = """
        d{k} AS MATERIALIZED (SELECT x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v)) AS d
                              FROM x JOIN c{k} c ON c.part = x.part AND c.pos = x.pos GROUP BY ALL),
        a{k} AS MATERIALIZED (SELECT vec_id, part, min(d * 256 + entry) AS m FROM d{k} GROUP BY ALL)"""
_STEP = """,
        c{n} AS MATERIALIZED (SELECT c.part, c.pos, c.entry, coalesce(s, c.v) AS v FROM c{k} c LEFT JOIN (
            SELECT x.part, x.pos, m % 256 AS entry, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS s
            FROM x JOIN a{k} USING (vec_id, part) GROUP BY ALL) u ON u.part = c.part AND u.pos = c.pos AND u.entry = c.entry),"""


def codes_sql(rounds: int = 4) -> str:
    """Vector codes: every part against every entry, in as many steps as there are rounds."""
    body = "".join(_ROUND.format(k=k) + (_STEP.format(k=k, n=k + 1) if k < rounds else "") for k in range(rounds + 1))
    return f"""
        WITH k AS MATERIALIZED (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings
              WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
        x AS MATERIALIZED (SELECT vec_id, r, (i - 1) // (len(embedding) // 4) AS part, (i - 1) % (len(embedding) // 4) AS pos,
                                  CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
                           FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM k)),
        c0 AS MATERIALIZED (SELECT part, pos, r AS entry, v FROM x WHERE r < 256),{body},
        e AS (SELECT vec_id, string_agg(format('{{:02x}}', CAST(m % 256 AS INT)), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error
              FROM a{rounds} GROUP BY vec_id)
        SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
        FROM k JOIN e ON e.vec_id = k.vec_id"""
