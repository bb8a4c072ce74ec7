"""DuckDB SQL of those queries that SQL can express."""

from __future__ import annotations

from trailmark.llm.licenses import K, MERGE_WITHIN, MIN_SHARE, templates

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({LOWER.format(f'coalesce({text}, chr(32))')}, '{NOT_WORD}'), lambda x: x <> '')"


def op3() -> str:
    return f"""
WITH item AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
win AS (SELECT r, size, i, array_to_string(w[i + 1:i + size], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(0, len(w) - size + 1)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= size)),
hit AS (SELECT r, i, win.size, item_id FROM win JOIN grams USING (gram)),
hw AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r),
hi AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(hi.n, 0)::BIGINT AS n_items,
  sha256(coalesce(hi.ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)"""


def op7() -> str:
    rows = ", ".join(
        f"('{t}', '{label}', {str(exact).lower()}, {len(w) - K + 1}, {i}, '{' '.join(w[i:i + K])}')"
        for t, label, exact, w in templates() for i in range(len(w) - K + 1)
    )
    return f"""
WITH tpl(template, label, exact, grams, pos, gram) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
g AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT r, w, unnest(range(0, len(w) - 1)) AS i FROM d WHERE len(w) > 1)),
vote AS (SELECT DISTINCT r, template, label, exact, grams, i - pos AS diagonal, pos FROM g JOIN tpl USING (gram)),
diag AS (SELECT DISTINCT r, template, exact, diagonal FROM vote),
opened AS (SELECT *, CASE WHEN NOT exact AND diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {MERGE_WITHIN} THEN 0 ELSE 1 END AS o FROM diag),
runs AS (SELECT *, sum(o) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM opened),
merged AS (
  SELECT r, template, label, vote.exact, run, min(diagonal) AS first, count(DISTINCT pos)::DOUBLE / min(grams) AS share
  FROM vote JOIN runs USING (r, template, diagonal) GROUP BY ALL),
rep AS (
  SELECT r, count(*) FILTER (exact AND share = 1) AS n_base, min(first) FILTER (exact AND share = 1) AS a, max(first) FILTER (exact AND share = 1) AS b,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND share = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share >= CASE WHEN exact THEN 1 ELSE {MIN_SHARE} END) AS labels, max(share) AS score
  FROM merged GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN rep USING (r)"""


ORACLES = {"op3_benchmark_decontamination": op3, "op7_license_scan": op7}


def oracle_sql() -> dict[str, str]:
    return {name: make() for name, make in ORACLES.items()}
