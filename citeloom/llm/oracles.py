"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def _centroids(k: int = 8, rounds: int = 10) -> str:
    """Rounds of exact integer means, one chain of tables."""
    ctes = [
        """kept AS MATERIALIZED (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """x AS MATERIALIZED (
    SELECT vec_id, i, floor(embedding[i]::DOUBLE * 1024)::BIGINT AS x
    FROM kept, generate_series(1, 64) AS g(i))""",
        f"""chosen AS MATERIALIZED (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n
    FROM kept ORDER BY n LIMIT {k})""",
        """c0 AS MATERIALIZED (
    SELECT n, i, x AS c FROM chosen JOIN x USING (vec_id))""",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (
    SELECT vec_id, min(struct_pack(d := d, n := n)) AS best
    FROM (SELECT vec_id, n, sum((x - c) * (x - c)) AS d FROM x JOIN c{r} USING (i) GROUP BY ALL)
    GROUP BY vec_id)"""
        )
        if r < rounds:
            ctes.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT n, i, coalesce((s - ((s % m) + m) % m) // m, c) AS c
    FROM c{r} LEFT JOIN (
        SELECT best.n AS n, i, sum(x) AS s, count(*) AS m
        FROM a{r} JOIN x USING (vec_id) GROUP BY ALL) USING (n, i))"""
            )
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""
SELECT vec_id, best.n::INTEGER AS cluster, best.d::BIGINT AS distance,
    (sum(best.d) OVER (PARTITION BY best.n))::BIGINT AS cluster_inertia,
    (sum(best.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN (
    SELECT n, sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
    FROM c{rounds} GROUP BY n) h ON h.n = best.n"""
    )


_TOP_PRODUCTS = """
WITH kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
        (row_number() OVER (
            PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id))::INTEGER AS rank
    FROM kept q JOIN kept c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
WHERE rank <= 20"""

_FILTER_AUDIT = r"""
WITH measured AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
failing AS (
    SELECT part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
        [len(words) < 200,
         100 * len(list_distinct(words)) < 50 * len(words),
         100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text),
         regexp_matches(text, '[#$%&*|]'),
         doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails
    FROM measured LEFT JOIN labels l USING (doc_id)),
counted AS (
    SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
    SELECT a.c || b.c || d.c || e.c || f.c AS filter_order
    FROM letters a, letters b, letters d, letters e, letters f
    WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (
    SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS filter
    FROM orders, generate_series(1, 5) AS g(step)),
judged AS (
    SELECT part, filter_order, step, filter, good, toxic, n,
        fails[ascii(filter) - 64] AS own,
        len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, i, 1)) - 64])) > 0 AS gone,
        len(list_filter(fails, lambda f: f)) AS n_fails
    FROM steps, counted),
report AS (
    SELECT part, filter_order, step, filter,
        sum(CASE WHEN NOT gone AND NOT own THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN NOT gone AND own THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN gone AND own THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN own AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN NOT gone AND own AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN NOT gone AND own AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM report"""

ORACLES: dict[str, str] = {
    "op11_centroids": _centroids(),
    "op12_top_products": _TOP_PRODUCTS,
    "op13_filter_audit": _FILTER_AUDIT,
}
