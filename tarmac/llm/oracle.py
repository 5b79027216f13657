"""SQL for the numbered operators that have one. It runs in another engine on the same tables."""

from __future__ import annotations


def centroids_sql(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """Rounds of assigning and moving, a pair of tables for each."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
          list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {dims}
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"parts AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range({dims})) AS d FROM kept)",
        f"""first AS (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c
          FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k})""",
        f"c0 AS MATERIALIZED (SELECT c, unnest(v) AS m, unnest(range({dims})) AS d FROM first)",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (apart, c)) AS c, min(apart) AS apart FROM
              (SELECT r, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS apart FROM parts JOIN c{i} USING (d)
               GROUP BY r, c) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (SELECT c, d, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM parts JOIN a{i} USING (r) GROUP BY c, d)"""
            )
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, c{i}.d, CASE WHEN n IS NULL THEN m
                ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS m
                FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c AND m{i}.d = c{i}.d)"""
            )
    return f"""WITH {', '.join(steps)}
      SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, apart AS distance,
        CAST(sum(apart) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(apart) OVER () AS BIGINT) AS inertia, centroid_sha256
      FROM a{rounds} a JOIN kept USING (r)
      JOIN (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
            FROM c{rounds} GROUP BY c) s ON s.c = a.c"""


def divergence_sql(least: int = 10, top: int = 10) -> str:
    share = "1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v)"
    apart = "CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)"
    return f"""WITH
      docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
      words AS MATERIALIZED (SELECT r, lang, source,
        unnest(regexp_extract_all(text, '[^\\x00-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
      kept AS MATERIALIZED (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {least}),
      sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
      groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
      counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
      dense AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0)::HUGEINT AS n
        FROM groups g JOIN kept k ON k.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
      shared AS MATERIALIZED (SELECT d.lang, source, term, n, {share} AS p FROM
        (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM dense) d JOIN sizes ON sizes.lang = d.lang),
      whole AS (SELECT w.lang, term, {share} AS q FROM
        (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM dense GROUP BY lang, term) w
        JOIN sizes ON sizes.lang = w.lang),
      sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum({apart}) AS BIGINT) AS value
        FROM shared a JOIN (SELECT lang, source, term, p AS q FROM shared) b
          ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
      pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
      terms AS (SELECT lang, source, 'term' AS part, term AS item, {apart} AS value
        FROM shared JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
      SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= {top}"""


def ledger_sql(rules: dict[str, str], base_mask: int, policy_mask: int, policy: str) -> str:
    """The counts by unnested words and lines, then the rules' own conditions."""
    blank = "\\x20\\x09-\\x0D"
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, condition in enumerate(rules.values()))
    return f"""WITH
      docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
      lists AS (SELECT r, regexp_extract_all(text, '[^{blank}]+') AS w FROM docs),
      words AS (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM lists),
      runs AS (SELECT *, lead(w) OVER o AS second, lead(w, 2) OVER o AS third, lag(w) OVER o AS before
        FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
      times AS (SELECT *, third IS NOT NULL AND count(*) OVER (PARTITION BY r, w, second, third) > 1 AS again FROM runs),
      covered AS (SELECT *, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS repeated
        FROM times WINDOW o AS (PARTITION BY r ORDER BY i)),
      by_word AS (SELECT r, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars,
        count(*) FILTER (repeated) AS n_repeat_words, count(DISTINCT w) AS n_distinct_words,
        count(*) FILTER (w = before) AS n_same_words,
        count(*) FILTER (strlen(w) > 1 AND regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]')) AS n_upper_words
        FROM covered GROUP BY r),
      lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
      by_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM lines WHERE regexp_matches(line, '[^{blank}]') GROUP BY r),
      counts AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_distinct_words, 0) AS n_distinct_words, coalesce(n_same_words, 0) AS n_same_words,
        coalesce(n_upper_words, 0) AS n_upper_words, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
        FROM docs LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r)),
      judged AS (SELECT *, CAST({bits} AS BIGINT) AS failures FROM counts)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & {base_mask} <> 0 AS base_failed,
        failures & {policy_mask} = 0 AS kept, failures, '{policy}' AS policy FROM judged"""
