"""SQL forms of the training-data queries that SQL can state over whole tables: near copies, compared pair by pair."""

from __future__ import annotations

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PAIRS = f"""t AS (SELECT row_id, regexp_replace(lower(cleaned), '[{WS}]+', '', 'g') AS t FROM prose_cleaned WHERE cleaned IS NOT NULL),
g AS (SELECT DISTINCT row_id, x AS gram FROM (SELECT row_id, unnest(list_transform(list_zip(c, c[2:], c[3:], c[4:], c[5:])[:len(c) - 4], lambda z: concat(z[1], z[2], z[3], z[4], z[5]))) AS x FROM (SELECT row_id, regexp_extract_all(t, '(?s).') AS c FROM t) WHERE len(c) >= 5)),
n AS (SELECT row_id, count(*) AS n FROM g GROUP BY 1),
m AS (SELECT x.row_id AS a, y.row_id AS b, count(*) AS n_shared FROM g x JOIN g y ON x.gram = y.gram AND x.row_id < y.row_id GROUP BY 1, 2),
l AS (SELECT a, b FROM m JOIN n x ON x.row_id = a JOIN n y ON y.row_id = b WHERE n_shared >= 0.7 * (x.n + y.n - n_shared))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": f"WITH {_PAIRS} SELECT a AS row_id_a, b AS row_id_b FROM l",
        "p5_groups": f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT row_id AS node, row_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a),
k AS (SELECT node AS row_id, min(root) AS group_id FROM r GROUP BY 1)
SELECT t.row_id, min(t.row_id) OVER (PARTITION BY t) AS class_id, group_id, count(*) OVER (PARTITION BY t) AS copies FROM t JOIN k ON t.row_id = k.row_id WHERE t.row_id IN (SELECT a FROM e)""",
    }
