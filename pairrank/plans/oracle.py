"""DuckDB SQL that computes the same tables from the same parquet files.

The driver registers each table as a view.  These strings restate the
engine's definitions set-wise (window ranks, correlated counts) so that every
deterministic operator has an independent check.  Hash and Gaussian
expressions follow the fixed values in ``functions.hashing``.
"""

from __future__ import annotations

import math

TWO52 = 4503599627370496


def h52(seed: int, purpose: str, *parts: str, digit: int = 1) -> str:
    keys = ", ".join([f"'{seed}'", f"'{purpose}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST('0x' || substr(md5(concat_ws('|', {keys})), {digit}, 13) AS BIGINT)"


def gaussian(seed: int, purpose: str, *parts: str) -> str:
    keys = ", ".join([f"'{seed}'", f"'{purpose}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    digest = f"md5(concat_ws('|', {keys}))"
    a = f"CAST('0x' || substr({digest}, 1, 13) AS BIGINT)"
    b = f"CAST('0x' || substr({digest}, 14, 13) AS BIGINT)"
    return (f"(sqrt(-2.0 * ln(CAST({a} + 1 AS DOUBLE) / {TWO52 + 1}.0)) * "
            f"cos({2.0 * math.pi!r} * CAST({b} AS DOUBLE) / {TWO52}.0))")


def interactions_orders() -> str:
    return ("SELECT o.o_custkey AS user_id, l.l_partkey AS item_id "
            "FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey")


def interactions_events() -> str:
    return ("SELECT CAST(user_id AS BIGINT) AS user_id, "
            "CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events")


def base_ctes(source_sql: str, num_shards: int, catalogue: str | None = None) -> str:
    """inter, items, seen, nitems, users, shard_stats."""
    p = num_shards
    more = f" UNION SELECT item_id FROM ({catalogue})" if catalogue else ""
    return f"""
inter AS ({source_sql}),
pairs AS (SELECT user_id, item_id, CAST(count(*) AS BIGINT) AS copies FROM inter
          WHERE user_id IS NOT NULL AND item_id IS NOT NULL GROUP BY user_id, item_id),
items AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS item_idx
          FROM (SELECT DISTINCT item_id FROM (SELECT item_id FROM pairs{more}))),
seen AS (SELECT user_id, item_id, copies,
                dense_rank() OVER (ORDER BY user_id) AS user_idx, item_idx,
                row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS item_rank,
                count(*) OVER (PARTITION BY user_id) AS n_items
         FROM pairs JOIN items USING (item_id)),
nitems AS (SELECT count(*) AS n FROM items),
users0 AS (SELECT user_idx, min(user_id) AS user_id, CAST(user_idx % {p} AS INTEGER) AS shard,
                  min(n_items) AS n_items, CAST(sum(copies) AS BIGINT) AS n_rows,
                  CAST((user_idx - 1) // {p} AS BIGINT) AS urank,
                  min(n_items) > 0 AND min(n_items) < (SELECT n FROM nitems) AS eligible
           FROM seen GROUP BY user_idx),
users AS (SELECT *, CASE WHEN eligible THEN
                 row_number() OVER (PARTITION BY shard, eligible ORDER BY user_idx) - 1 END AS erank
          FROM users0),
shard_stats AS (SELECT shard, count(*) AS n_users,
                       CAST(sum(CASE WHEN eligible THEN 1 ELSE 0 END) AS BIGINT) AS n_eligible
                FROM users GROUP BY shard)"""


def with_ctes(source_sql: str, num_shards: int, *extra: str, catalogue: str | None = None) -> str:
    ctes = [base_ctes(source_sql, num_shards, catalogue).strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def factor_cte(name: str, table: str, idx: str, k: int, seed: int, kind: str) -> str:
    return (f"{name} AS (SELECT idx, dim, {gaussian(seed, f'init-{kind}', 'idx', 'dim')} AS v FROM "
            f"(SELECT {idx} AS idx, unnest(range({k})) AS dim FROM (SELECT DISTINCT {idx} FROM {table})))")


def uniform_user_samples_cte(seed: int, iteration: int, spu: int) -> str:
    it = str(iteration)
    return f"""
draws AS (SELECT shard, urank * {spu} + unnest(range({spu})) AS draw_no FROM users),
d1 AS (SELECT d.shard, d.draw_no, s.n_eligible FROM draws d JOIN shard_stats s ON s.shard = d.shard
       WHERE s.n_eligible > 0),
d2 AS (SELECT shard, draw_no, {h52(seed, 'draw', f"'{it}'", 'shard', 'draw_no')} % n_eligible AS erank FROM d1),
d3 AS (SELECT d2.shard, d2.draw_no, u.user_idx, u.n_items,
              {h52(seed, 'draw', f"'{it}'", 'd2.shard', 'd2.draw_no', digit=14)} % u.n_items AS item_rank
       FROM d2 JOIN users u ON u.eligible AND u.shard = d2.shard AND u.erank = d2.erank),
draws_pos AS (SELECT {iteration} AS iteration, d3.shard, d3.draw_no, d3.user_idx, d3.n_items,
                     s.item_idx AS pos_idx
              FROM d3 JOIN seen s ON s.user_idx = d3.user_idx AND s.item_rank = d3.item_rank)"""


def per_positive_samples_cte(num_shards: int, iteration: int, negatives: int, seed: int) -> str:
    return f"""
pc AS (SELECT user_idx, n_items, item_idx AS pos_idx, unnest(range(copies * {negatives})) AS c
       FROM seen WHERE n_items < (SELECT n FROM nitems)),
pp AS (SELECT *, CAST({h52(seed, 'shard', 'user_idx', 'pos_idx', 'c')} % {num_shards} AS INTEGER) AS shard FROM pc),
draws_pos AS (SELECT {iteration} AS iteration, shard,
                     row_number() OVER (PARTITION BY shard ORDER BY user_idx, pos_idx, c) - 1 AS draw_no,
                     user_idx, n_items, pos_idx FROM pp)"""


def negatives_cte(seed: int) -> str:
    """samples(iteration, shard, draw_no, user_idx, pos_idx, neg_idx) from draws_pos."""
    keys = ("iteration", "shard", "draw_no")
    n = "(SELECT n FROM nitems)"
    return f"""
dc AS (SELECT *, 1 + {h52(seed, 'cand', *keys)} % {n} AS cand,
              {h52(seed, 'cand', *keys, digit=14)} % ({n} - n_items) AS r FROM draws_pos),
dh AS (SELECT dc.*, EXISTS (SELECT 1 FROM seen s WHERE s.user_idx = dc.user_idx AND s.item_idx = dc.cand) AS hit FROM dc),
da AS (SELECT iteration, shard, draw_no, user_idx, t, 1 + {h52(seed, 'again', *keys, 't')} % {n} AS cand
       FROM (SELECT *, unnest(range(1, 9)) AS t FROM dh WHERE hit)),
db AS (SELECT iteration, shard, draw_no, min_by(cand, t) AS cand FROM da
       WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_idx = da.user_idx AND s.item_idx = da.cand)
       GROUP BY iteration, shard, draw_no),
samples AS (SELECT CAST(dh.iteration AS INTEGER) AS iteration, dh.shard, dh.draw_no, dh.user_idx, dh.pos_idx,
                   CAST(CASE WHEN NOT hit THEN dh.cand WHEN db.cand IS NOT NULL THEN db.cand
                        ELSE r + 1 + (SELECT count(*) FROM seen s WHERE s.user_idx = dh.user_idx
                                                                AND s.item_idx - 1 - s.item_rank <= dh.r)
                        END AS BIGINT) AS neg_idx
            FROM dh LEFT JOIN db ON db.iteration = dh.iteration AND db.shard = dh.shard AND db.draw_no = dh.draw_no)"""


# --- training: the shards' sequential steps as a recursion over the step number ---------------

_DRAW_NAMES = ("draws", "draws_pos", "d1", "d2", "d3", "dc", "dh", "da", "db", "pc", "pp", "samples")


def _sample_ctes(mode: str, seed: int, iteration: int, num_shards: int, spu: int) -> list[str]:
    """The sampling CTEs of one iteration, their names ending in its number."""
    import re
    draws = (uniform_user_samples_cte(seed, iteration, spu) if mode == "uniform_user"
             else per_positive_samples_cte(num_shards, iteration, 1, seed))
    names = "|".join(_DRAW_NAMES)
    return [re.sub(rf"\b({names})\b", rf"\1_{iteration}", text) for text in (draws, negatives_cte(seed))]


def _step_cte(it: int, k: int, alpha: float, lam: float, keep_steps: bool) -> str:
    """run_it: per shard the factors after each of its samples (or the last only)."""
    key = "" if keep_steps else " USING KEY (shard)"
    union = "UNION ALL" if keep_steps else "UNION"
    each = f"list_transform(range(1, {k + 1}), lambda f: {{}})"
    new_u = each.format(f"u[f] + {alpha} * (w * (i[f] - j[f]) - {lam} * u[f])")
    new_i = each.format(f"i[f] + {alpha} * (w * u[f] - {lam} * i[f])")
    new_j = each.format(f"j[f] + {alpha} * (-w * u[f] - {lam} * j[f])")
    return f"""
run_{it}(shard, n, us, vs, x, w){key} AS (
  SELECT shard, CAST(0 AS BIGINT), us, (SELECT vs FROM v_list_{it}), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM u_list_{it}
  {union}
  SELECT shard, n, list_concat(us[:a - 1], [nu], us[a + 1:]),
         list_transform(vs, lambda v, k: CASE WHEN k = b THEN ni WHEN k = c THEN nj ELSE v END), x, w
  FROM (SELECT shard, n, us, vs, a, b, c, x, w, {new_u} AS nu, {new_i} AS ni, {new_j} AS nj
        FROM (SELECT *, 1.0 / (1.0 + exp(x)) AS w
              FROM (SELECT r.shard, s.n, r.us, r.vs, s.a, s.b, s.c, r.us[s.a] AS u, r.vs[s.b] AS i, r.vs[s.c] AS j,
                           list_inner_product(r.us[s.a], r.vs[s.b]) - list_inner_product(r.us[s.a], r.vs[s.c]) AS x
                    FROM run_{it} r JOIN steps_{it} s ON s.shard = r.shard AND s.n = r.n + 1))))"""


def fit_ctes(source: str, num_shards: int, k: int, seed: int, spu: int, iterations: int, strategy: str, mode: str,
             alpha: float, lam: float, keep_steps: bool = False) -> str:
    """WITH ...: uf_t and vf_t (idx, dim, v) are the factors after iteration t."""
    ctes = [base_ctes(source, num_shards).strip(),
            factor_cte("uf_0", "users", "user_idx", k, seed, "user"), factor_cte("vf_0", "seen", "item_idx", k, seed, "item")]
    for it in range(1, iterations + 1):
        was = it - 1
        local = "us.urank + 1" if mode == "uniform_user" else "us.user_idx"
        ctes += _sample_ctes(mode, seed, it, num_shards, spu)
        ctes.append(f"steps_{it} AS (SELECT s.shard, row_number() OVER (PARTITION BY s.shard ORDER BY s.draw_no) AS n, "
                    f"{local} AS a, s.pos_idx AS b, s.neg_idx AS c, s.draw_no, s.user_idx "
                    f"FROM samples_{it} s JOIN users us ON us.user_idx = s.user_idx)")
        ctes.append(f"u_vec_{it} AS (SELECT idx, list(v ORDER BY dim) AS vec FROM uf_{was} GROUP BY idx)")
        if mode == "uniform_user":
            ctes.append(f"u_list_{it} AS (SELECT us.shard, list(vec ORDER BY us.urank) AS us "
                        f"FROM u_vec_{it} JOIN users us ON us.user_idx = idx GROUP BY us.shard)")
        else:
            ctes.append(f"u_list_{it} AS (SELECT p.shard, (SELECT list(vec ORDER BY idx) FROM u_vec_{it}) AS us "
                        f"FROM (SELECT DISTINCT shard FROM samples_{it}) p)")
        ctes.append(f"v_list_{it} AS (SELECT list(vec ORDER BY idx) AS vs FROM "
                    f"(SELECT idx, list(v ORDER BY dim) AS vec FROM vf_{was} GROUP BY idx))")
        ctes.append(_step_cte(it, k, alpha, lam, keep_steps).strip())
        ctes.append(f"last_{it} AS (SELECT shard, us, vs FROM run_{it} r WHERE n = (SELECT max(n) FROM run_{it} q WHERE q.shard = r.shard))"
                    if keep_steps else f"last_{it} AS (SELECT shard, us, vs FROM run_{it})")
        ctes.append(f"u_long_{it} AS (SELECT shard, a, dim, us[a][dim + 1] AS v FROM "
                    f"(SELECT shard, us, unnest(range(1, len(us) + 1)) AS a FROM last_{it}), (SELECT unnest(range({k})) AS dim))")
        ctes.append(f"v_long_{it} AS (SELECT shard, idx, dim, vs[idx][dim + 1] AS v FROM "
                    f"(SELECT shard, vs, unnest(range(1, len(vs) + 1)) AS idx FROM last_{it}), (SELECT unnest(range({k})) AS dim))")
        ctes.append(f"vf_{it} AS (SELECT o.idx, o.dim, o.v + coalesce(sum(n.v - o.v), 0.0) / {num_shards} AS v "
                    f"FROM vf_{was} o LEFT JOIN v_long_{it} n ON n.idx = o.idx AND n.dim = o.dim GROUP BY o.idx, o.dim, o.v)")
        if mode == "uniform_user":
            part = f" / {num_shards}" if strategy == "full_average" else ""
            ctes.append(f"uf_{it} AS (SELECT o.idx, o.dim, o.v + (n.v - o.v){part} AS v FROM uf_{was} o "
                        f"JOIN users us ON us.user_idx = o.idx JOIN u_long_{it} n "
                        f"ON n.shard = us.shard AND n.a = us.urank + 1 AND n.dim = o.dim)")
        else:
            part = str(num_shards) if strategy == "full_average" else "min(h.share)"
            ctes.append(f"uf_{it} AS (SELECT o.idx, o.dim, o.v + coalesce(sum(n.v - o.v) / {part}, 0.0) AS v FROM uf_{was} o "
                        f"LEFT JOIN (SELECT user_idx, count(DISTINCT shard) AS share FROM samples_{it} GROUP BY user_idx) h "
                        f"ON h.user_idx = o.idx LEFT JOIN u_long_{it} n ON n.a = o.idx AND n.dim = o.dim GROUP BY o.idx, o.dim, o.v)")
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n"


def factors_of(user: str, item: str, extra: str = "", scale: str = "") -> str:
    """SELECT of (…, kind, idx, dim, value) of two factor tables."""
    return " UNION ALL ".join(f"SELECT {extra}'{kind}' AS kind, idx, dim, round(v{scale}, 6) + 0.0 AS value FROM {table}"
                              for kind, table in (("user", user), ("item", item)))
