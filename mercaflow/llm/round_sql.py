"""The SQL of clustering and of conversation repair, for DuckDB."""
from __future__ import annotations


def cluster_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
            FROM embeddings
            WHERE len(embedding) = {dims}
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
        )""",
        f"parts AS MATERIALIZED (SELECT r, unnest(range({dims})) AS i, unnest(whole) AS v FROM kept)",
        f"""first AS (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), whole) - 1 AS c, whole
            FROM kept ORDER BY c LIMIT {k}
        )""",
        f"centroid0 AS MATERIALIZED (SELECT c, unnest(range({dims})) AS i, unnest(whole) AS v FROM first)",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""nearest{n} AS MATERIALIZED (
                SELECT r, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d
                FROM (
                    SELECT r, c, sum((x.v - y.v) * (x.v - y.v)) AS d
                    FROM parts x JOIN centroid{n} y USING (i) GROUP BY r, c
                ) GROUP BY r
            )"""
        )
        if n < rounds:
            parts.append(
                f"""centroid{n + 1} AS MATERIALIZED (
                    SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, v) AS v
                    FROM centroid{n} LEFT JOIN (
                        SELECT c, i, sum(v) AS s, count(*) AS n FROM nearest{n} JOIN parts USING (r) GROUP BY c, i
                    ) USING (c, i)
                )"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + f"""
        , digest AS (
            SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
            FROM centroid{rounds} GROUP BY c
        )
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
            CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
            CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM nearest{rounds} JOIN kept USING (r) JOIN digest USING (c)
        """
    )


REPAIR_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list(v ORDER BY n) AS t FROM (
        SELECT n, list_reduce(
            list_prepend(n, range(8)),
            lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END
        ) AS v FROM range(256) r(n)
    )
), coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                lambda x: CAST(ascii(x) AS BIGINT)
            )),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
        ), CAST(4294967295 AS BIGINT)) % 20 AS code
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM coded WHERE code <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || text), copy) AS i
    FROM damaged
), faulty AS MATERIALIZED (
    SELECT conv_id, turn, role, text, i, left(role, 1) AS c,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
        CASE
            WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
            ELSE '' END AS fault
    FROM placed
), counted AS MATERIALIZED (
    SELECT conv_id, count(*) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), back AS (
    SELECT conv_id, n + 1 AS i, 0 AS v0, 4 AS v1, 2 AS v2, 0 AS v3 FROM counted
    UNION ALL
    SELECT conv_id, i, least(w0, 2 + w2, 4 + w3), least(w1, 2 + w2, 4 + w3), least(w2, 2 + w3), least(w3, 2 + w2)
    FROM (
        SELECT b.conv_id, f.i,
            least(3 + v0, CASE WHEN stays THEN 2 + t + v2 END, CASE WHEN stays AND c = 's' THEN t + v1 END,
                CASE WHEN stays AND c = 'u' THEN t + v2 END) AS w0,
            least(3 + v1, CASE WHEN stays THEN 2 + t + v2 END, CASE WHEN stays AND c = 'u' THEN t + v2 END) AS w1,
            least(3 + v2, CASE WHEN stays THEN 2 + t + v3 END, CASE WHEN stays AND c = 'a' THEN t + v3 END) AS w2,
            least(3 + v3, CASE WHEN stays THEN 2 + t + v2 END, CASE WHEN stays AND c = 'u' THEN t + v2 END) AS w3
        FROM back b JOIN (
            SELECT *, fault IN ('', 'truncated') AS stays, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS t FROM faulty
        ) f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1
    )
), costs AS MATERIALIZED (
    SELECT b.conv_id, b.i, [v0, v1, v2, v3] AS cur, lead([v0, v1, v2, v3]) OVER (PARTITION BY b.conv_id ORDER BY b.i) AS nxt,
        f.c, f.role, f.text, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS t
    FROM back b LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i
), chosen AS (
    SELECT q, CASE
            WHEN role IS NULL AND cur[q + 1] = 0 THEN ''
            WHEN 3 + nxt[q + 1] = cur[q + 1] THEN 'D'
            WHEN 2 + cur[[2, 2, 3, 2][q + 1] + 1] = cur[q + 1] THEN 'I'
            WHEN t + nxt[kept + 1] = cur[q + 1] THEN 'K'
            ELSE 'R' END AS letter,
        [2, 2, 3, 2][q + 1] AS added, * EXCLUDE (q)
    FROM (
        SELECT *, CASE
            WHEN c = 's' AND q = 0 THEN 1 WHEN c = 'u' AND q <> 2 THEN 2 WHEN c = 'a' AND q = 2 THEN 3 END AS kept
        FROM costs, (SELECT unnest([0, 1, 2, 3]) AS q)
    )
), walk AS (
    SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS q, '' AS audit, '' AS repaired, false AS done FROM counted
    UNION ALL
    SELECT w.conv_id, CASE WHEN letter IN ('I', '') THEN w.i ELSE w.i + 1 END,
        CASE letter WHEN 'K' THEN kept WHEN 'D' THEN w.q WHEN '' THEN w.q ELSE added END,
        w.audit || letter,
        CASE WHEN letter IN ('D', '') THEN repaired ELSE repaired || CASE repaired WHEN '' THEN '' ELSE E'\n' END
            || CASE WHEN letter = 'K' THEN role WHEN added = 2 THEN 'user' ELSE 'assistant' END
            || ':' || CASE letter WHEN 'I' THEN '' ELSE text END END,
        letter = ''
    FROM walk w JOIN chosen o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.i = w.i AND o.q = w.q
    WHERE NOT w.done
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(coalesce(cur[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN costs c ON c.conv_id IS NOT DISTINCT FROM o.conv_id AND c.i = 1
LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.done
"""
