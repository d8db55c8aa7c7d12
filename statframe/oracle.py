"""DuckDB SQL oracles, one per registered query.

Tables are the driver's pre-registered views.  Every double output goes
through ``sql_sig`` exactly as the Spark side goes through ``sig``.  The
texts are written independently of the Spark plans: plain aggregates,
window functions and CTEs over the same tables.
"""

from __future__ import annotations

from statframe.functions.rounding import sql_pround, sql_rounded_matrix, sql_sig

ORACLE: dict[str, str] = {}

DOUBLE_MAX = "1.7976931348623157e308"


def _sig_select(inner: str, cols: list[tuple[str, bool]]) -> str:
    """SELECT over ``inner`` rounding the columns flagged as double."""
    parts = []
    for name, kind in cols:
        q = f'"{name}"'
        if kind == "p":
            parts.append(f"{sql_pround(q)} AS {q}")
        elif kind:
            parts.append(f"{sql_sig(q)} AS {q}")
        else:
            parts.append(q)
    return f"SELECT {', '.join(parts)} FROM ({inner}) AS q"


SUMMARY_COLS = [("column", False), ("count", False), ("mean", True), ("variance", True),
                ("num_nonzeros", True), ("max", True), ("min", True), ("norm_l1", True),
                ("norm_l2", True)]


def _summary_one(table: str, c: str, keys: list[str], where: str = "") -> str:
    k = "".join(f"{x}, " for x in keys)
    grp = f" GROUP BY {', '.join(keys)}" if keys else ""
    nzmax = f"max({c}) FILTER (WHERE {c} <> 0 AND NOT isnan({c}))"
    nzmin = f"min({c}) FILTER (WHERE {c} <> 0 AND NOT isnan({c}))"
    zeros = f"count(*) FILTER (WHERE {c} = 0)"
    return (
        f"SELECT {k}'{c}' AS \"column\", count(*) AS count, avg({c}) AS mean, "
        f"coalesce(var_samp({c}), 0.0) AS variance, "
        f"CAST(count(*) FILTER (WHERE {c} <> 0) AS DOUBLE) AS num_nonzeros, "
        f"CASE WHEN {zeros} > 0 THEN greatest(coalesce({nzmax}, -{DOUBLE_MAX}), 0.0) "
        f"ELSE coalesce({nzmax}, -{DOUBLE_MAX}) END AS max, "
        f"CASE WHEN {zeros} > 0 THEN least(coalesce({nzmin}, {DOUBLE_MAX}), 0.0) "
        f"ELSE coalesce({nzmin}, {DOUBLE_MAX}) END AS min, "
        f"sum(abs({c})) AS norm_l1, sqrt(sum({c} * {c})) AS norm_l2 "
        f"FROM {table}{where}{grp}")


def summary_sql(table: str, cols: list[str], keys: list[str] = ()) -> str:
    keys = list(keys)
    inner = " UNION ALL ".join(_summary_one(table, c, keys) for c in cols)
    return _sig_select(inner, [(k, False) for k in keys] + SUMMARY_COLS)


def weighted_summary_sql(table: str, cols: list[str], w: str, keys: list[str] = ()) -> str:
    keys = list(keys)
    kp = "".join(f"b.{k}, " for k in keys)
    kg = "".join(f"{k}, " for k in keys)
    grp = f" GROUP BY {', '.join('b.' + k for k in keys)}" if keys else ""
    join = f"b JOIN m USING ({', '.join(keys)})" if keys else "b, m"
    mean_defs = ", ".join(f"sum({w} * {c}) / sum({w}) AS m_{c}" for c in cols)
    parts = []
    for c in cols:
        nz = f"{c} <> 0 AND NOT isnan({c})"
        zeros = f"count(*) FILTER (WHERE {c} = 0)"
        parts.append(
            f"SELECT {kp}'{c}' AS \"column\", count(*) AS count, any_value(m.m_{c}) AS mean, "
            f"CASE WHEN any_value(m.ws) - any_value(m.w2) / any_value(m.ws) > 0 THEN "
            f"sum({w} * ({c} - m.m_{c}) * ({c} - m.m_{c})) / "
            f"(any_value(m.ws) - any_value(m.w2) / any_value(m.ws)) ELSE 0.0 END AS variance, "
            f"sum(CASE WHEN {c} <> 0 THEN {w} ELSE 0.0 END) AS num_nonzeros, "
            f"CASE WHEN {zeros} > 0 THEN greatest(coalesce(max({c}) FILTER (WHERE {nz}), "
            f"-{DOUBLE_MAX}), 0.0) ELSE coalesce(max({c}) FILTER (WHERE {nz}), -{DOUBLE_MAX}) END AS max, "
            f"CASE WHEN {zeros} > 0 THEN least(coalesce(min({c}) FILTER (WHERE {nz}), "
            f"{DOUBLE_MAX}), 0.0) ELSE coalesce(min({c}) FILTER (WHERE {nz}), {DOUBLE_MAX}) END AS min, "
            f"sum({w} * abs({c})) AS norm_l1, sqrt(sum({w} * {c} * {c})) AS norm_l2 "
            f"FROM {join}{grp}")
    inner = (f"WITH b AS (SELECT * FROM {table} WHERE {w} > 0), "
             f"m AS (SELECT {kg}sum({w}) AS ws, sum({w} * {w}) AS w2, {mean_defs} FROM b"
             f"{' GROUP BY ' + ', '.join(keys) if keys else ''}) "
             + " UNION ALL ".join(parts))
    return _sig_select(inner, [(k, False) for k in keys] + SUMMARY_COLS)


LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORACLE["col_summary"] = summary_sql("lineitem", LINEITEM_NUM)
ORACLE["col_summary_weighted"] = weighted_summary_sql(
    "lineitem", ["l_extendedprice", "l_discount", "l_tax"], "l_quantity")
ORACLE["col_summary_weighted_grouped"] = weighted_summary_sql(
    "lineitem", ["l_extendedprice", "l_discount"], "l_quantity", ["l_returnflag"])
ORACLE["col_summary_grouped"] = summary_sql("events", ["value"], ["event_type"])
ORACLE["col_summary_embeddings"] = _sig_select(
    "WITH cells AS (SELECT generate_subscripts(embedding, 1) AS i, "
    "  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) "
    + _summary_one("cells", "x", ["i"]).replace("'x' AS \"column\", ", ""),
    [("column", False)] + SUMMARY_COLS[1:]).replace(
    'SELECT "column",', "SELECT 'embedding[' || CAST(i - 1 AS VARCHAR) || ']' AS \"column\",", 1)
ORACLE["col_summary_embeddings_grouped"] = _sig_select(
    "WITH cells AS (SELECT label, generate_subscripts(embedding, 1) AS i, "
    "  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) "
    + _summary_one("cells", "x", ["label", "i"]).replace("'x' AS \"column\", ", ""),
    [("label", False), ("column", False)] + SUMMARY_COLS[1:]).replace(
    'SELECT "label", "column",',
    "SELECT label, 'embedding[' || CAST(i - 1 AS VARCHAR) || ']' AS \"column\",", 1)
ORACLE["summary_rollup"] = summary_sql("lineitem", LINEITEM_NUM, ["l_returnflag"])
ORACLE["sparse_summary"] = _sig_select(
    "WITH o AS (SELECT o_orderkey FROM orders), "
    "i AS (SELECT DISTINCT l_linenumber FROM lineitem), "
    "cells AS (SELECT l_orderkey, l_linenumber, sum(l_discount) AS s FROM lineitem GROUP BY ALL), "
    "dense AS (SELECT i.l_linenumber AS idx, coalesce(c.s, 0.0) AS v "
    "  FROM o CROSS JOIN i LEFT JOIN cells c "
    "  ON c.l_orderkey = o.o_orderkey AND c.l_linenumber = i.l_linenumber) "
    + _summary_one("dense", "v", ["idx"]).replace("'v' AS \"column\", ", ""),
    [("column", False)] + SUMMARY_COLS[1:]).replace(
    'SELECT "column",', "SELECT 'x[' || CAST(idx AS VARCHAR) || ']' AS \"column\",", 1)


# -------------------------------------------------------------- correlation

def _pairs(cols):
    return [(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(cols)]


CORR_COLS = [("i", False), ("j", False), ("col_i", False), ("col_j", False)]


def cov_sql(table: str, cols: list[str]) -> str:
    inner = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, '{a}' AS col_i, '{b}' AS col_j, "
        f"covar_samp({a}, {b}) AS cov FROM {table}" for i, j, a, b in _pairs(cols))
    return _sig_select(inner, CORR_COLS + [("cov", True)])


def _pearson_expr(a: str, b: str, same: bool) -> str:
    if same:
        return "max(1.0)"
    return (f"CASE WHEN abs(var_samp({a})) <= 1e-12 OR abs(var_samp({b})) <= 1e-12 "
            f"THEN 'NaN'::DOUBLE ELSE covar_samp({a}, {b}) / "
            f"(sqrt(var_samp({a})) * sqrt(var_samp({b}))) END")


def pearson_sql(table: str, cols: list[str], pairs=None) -> str:
    pairs = pairs or _pairs(cols)
    inner = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, '{a}' AS col_i, '{b}' AS col_j, "
        f"{_pearson_expr(a, b, i == j)} AS corr FROM {table}" for i, j, a, b in pairs)
    return _sig_select(inner, CORR_COLS + [("corr", True)])


def _rank_expr(c: str) -> str:
    return (f"(rank() OVER (ORDER BY {c}) - 1) + "
            f"(count(*) OVER (PARTITION BY {c}) - 1) / 2.0")


def spearman_sql(table: str, cols: list[str], pairs=None) -> str:
    ranked = (f"(SELECT {', '.join(_rank_expr(c) + ' AS ' + c for c in cols)} "
              f"FROM {table}) AS ranked")
    return pearson_sql(ranked, cols, pairs)


CUST = ["c_acctbal", "c_custkey", "c_nationkey"]
ORACLE["cov_matrix"] = cov_sql("lineitem", LINEITEM_NUM)
ORACLE["corr_pearson_matrix"] = pearson_sql("lineitem", LINEITEM_NUM)
ORACLE["corr_pearson_pair"] = pearson_sql(
    "lineitem", [], [(0, 1, "l_quantity", "l_extendedprice")])
ORACLE["corr_from_cov"] = pearson_sql("customer", CUST)
ORACLE["corr_spearman_matrix"] = spearman_sql("lineitem", LINEITEM_NUM)
ORACLE["corr_spearman_long"] = spearman_sql("lineitem", LINEITEM_NUM)
ORACLE["corr_spearman_pair"] = spearman_sql(
    "lineitem", ["l_discount", "l_tax"], [(0, 1, "l_discount", "l_tax")])
ORACLE["avg_rank"] = _sig_select(
    f"SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, "
    f"{_rank_expr('l_extendedprice')} AS l_extendedprice_rank, "
    f"{_rank_expr('l_discount')} AS l_discount_rank FROM lineitem",
    [("l_orderkey", False), ("l_linenumber", False), ("l_extendedprice", True),
     ("l_discount", True), ("l_extendedprice_rank", True), ("l_discount_rank", True)])


# ---------------------------------------------------------- hypothesis tests

GOF = "observed follows the same distribution as expected."
INDEP = "the occurrence of the outcomes is statistically independent."
TEST_COLS = [("p_value", "p"), ("degrees_of_freedom", False), ("statistic", True),
             ("method", False), ("null_hypothesis", False)]


def chi2_sf_even(stat: str, dof: str) -> str:
    """Q(dof/2, stat/2) for even dof: exp(-h) * sum_{i<k} h^i / i!."""
    return (f"(exp(-({stat}) / 2.0) * (SELECT sum(pow(({stat}) / 2.0, i) / gamma(i + 1)) "
            f"FROM range(0, CAST(({dof}) / 2 AS BIGINT)) AS rr(i)))")


def _test_row(stat: str, dof: str, h0: str, src: str, extra: str = "") -> str:
    return (f"SELECT {extra}{chi2_sf_even(stat, dof)} AS p_value, CAST({dof} AS INTEGER) AS "
            f"degrees_of_freedom, {stat} AS statistic, 'pearson' AS method, "
            f"'{h0}' AS null_hypothesis FROM {src}")


_MIX = "('view', 0.30), ('click', 0.25), ('purchase', 0.15), ('signup', 0.10), ('error', 0.20)"
ORACLE["chisq_gof"] = _sig_select(
    "WITH o AS (SELECT event_type AS category, CAST(count(*) AS DOUBLE) AS observed "
    "  FROM events GROUP BY 1), "
    f"e AS (SELECT * FROM (VALUES {_MIX}) AS t(category, expected)), "
    "sc AS (SELECT CASE WHEN abs((SELECT sum(observed) FROM o) - (SELECT sum(expected) FROM e)) "
    "  < 1e-7 THEN 1.0 ELSE (SELECT sum(observed) FROM o) / (SELECT sum(expected) FROM e) END AS s), "
    "j AS (SELECT o.observed, e.expected * sc.s AS ex FROM o JOIN e USING (category), sc), "
    "st AS (SELECT sum((observed - ex) * (observed - ex) / ex) AS stat, count(*) - 1 AS dof FROM j) "
    + _test_row("stat", "dof", GOF, "st"), TEST_COLS)

ORACLE["chisq_gof_uniform"] = _sig_select(
    "WITH o AS (SELECT p_brand, CAST(count(*) AS DOUBLE) AS observed FROM part GROUP BY 1), "
    "t AS (SELECT sum(observed) AS tot, count(*) AS k FROM o), "
    "st AS (SELECT sum((observed - tot / k) * (observed - tot / k) / (tot / k)) AS stat, "
    "  any_value(k) - 1 AS dof FROM o, t) "
    + _test_row("stat", "dof", GOF, "st"), TEST_COLS)


def _contingency_sql(cells: str, keys: list[str]) -> str:
    """cells: (keys..., r, c) one row per observation -> per-key statistic and dof."""
    k = "".join(f"{x}, " for x in keys)
    using = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    on_keys = "".join(f"cnt.{x} = rs.{x} AND " for x in keys)
    return (
        f"cells AS ({cells}), "
        f"cnt AS (SELECT {k}r, c, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY ALL), "
        f"rs AS (SELECT {k}r, sum(n) AS rsum FROM cnt GROUP BY ALL), "
        f"cs AS (SELECT {k}c, sum(n) AS csum FROM cnt GROUP BY ALL), "
        f"tot AS (SELECT {k}sum(n) AS t, count(DISTINCT r) AS nr, count(DISTINCT c) AS nc "
        f"  FROM cnt GROUP BY ALL), "
        f"grid AS (SELECT {''.join('rs.' + x + ', ' for x in keys)}rs.r, cs.c, "
        f"  rs.rsum * cs.csum / tot.t AS e, coalesce(cnt.n, 0.0) AS o, tot.nr, tot.nc "
        f"  FROM rs JOIN cs {using} JOIN tot {using} "
        f"  LEFT JOIN cnt ON {on_keys}cnt.r = rs.r AND cnt.c = cs.c), "
        f"st AS (SELECT {k}CASE WHEN any_value((nr - 1) * (nc - 1)) = 0 THEN 0.0 "
        f"  ELSE sum((o - e) * (o - e) / e) END AS stat, any_value((nr - 1) * (nc - 1)) AS dof "
        f"  FROM grid GROUP BY ALL) ")


ORACLE["chisq_independence"] = _sig_select(
    "WITH " + _contingency_sql("SELECT l_returnflag AS r, l_linestatus AS c FROM lineitem", [])
    + _test_row("stat", "dof", INDEP, "st"), TEST_COLS)

_FEATURE_CELLS = " UNION ALL ".join(
    f"SELECT {i} AS feature_index, '{f}' AS feature, CAST({f} AS VARCHAR) AS r, "
    f"CAST(l_linestatus AS VARCHAR) AS c FROM lineitem"
    for i, f in enumerate(["l_returnflag", "l_tax", "l_discount"]))
_FEATURES_SQL = ("WITH " + _contingency_sql(_FEATURE_CELLS, ["feature_index", "feature"])
                 + _test_row("stat", "dof", INDEP, "st", "feature_index, feature, "))
ORACLE["chisq_features"] = _sig_select(
    _FEATURES_SQL, [("feature_index", False), ("feature", False)] + TEST_COLS)
ORACLE["test_explain"] = _sig_select(
    "SELECT *, CASE WHEN p_value <= 0.01 THEN 'Very strong' WHEN p_value <= 0.05 THEN 'Strong' "
    "WHEN p_value <= 0.1 THEN 'Low' ELSE 'No' END || ' presumption against null hypothesis: ' "
    f"|| null_hypothesis || '.' AS presumption FROM ({_FEATURES_SQL}) AS f",
    [("feature_index", False), ("feature", False)] + TEST_COLS + [("presumption", False)])


# Kolmogorov-Smirnov: D over distinct values, p by the Pelz-Good series
# (every oracle sample here has n > 140).

def _pelz_good_p(src: str) -> str:
    pi2 = "(pi() * pi())"
    kh = "((k + 0.5) * (k + 0.5))"
    eh = f"exp(-{pi2} * {kh} / (2 * z2))"
    ek = f"exp(-{pi2} * k * k / (2 * z2))"
    return (
        f"pg AS (SELECT d, n, sqrt(n) AS sn, d * sqrt(n) AS z, d * d * n AS z2 FROM {src}), "
        f"k0 AS (SELECT sum(exp(-{pi2} / (8 * z2) * (2 * k - 1) * (2 * k - 1))) AS s "
        f"  FROM pg, LATERAL (SELECT unnest(range(1, CAST(ceil(13 * z) AS BIGINT) + 3)) AS k) AS t), "
        f"kh AS (SELECT sum(({pi2} * {kh} - z2) * {eh}) AS s1, "
        f"  sum((6 * z2 * z2 * z2 + 2 * z2 * z2 + {pi2} * (2 * z2 * z2 - 5 * z2) * {kh} "
        f"    + {pi2} * {pi2} * (1 - 2 * z2) * {kh} * {kh}) * {eh}) AS s2, "
        f"  sum(({pi2} * {pi2} * {pi2} * {kh} * {kh} * {kh} * (5 - 30 * z2) "
        f"    + {pi2} * {pi2} * {kh} * {kh} * (-60 * z2 + 212 * z2 * z2) "
        f"    + {pi2} * {kh} * (135 * z2 * z2 - 96 * z2 * z2 * z2) - 30 * z2 * z2 * z2 "
        f"    - 90 * z2 * z2 * z2 * z2) * {eh}) AS s3 FROM pg, LATERAL (SELECT unnest(range(0, CAST(ceil(13 * z) AS BIGINT) + 3)) AS k) AS t), "
        f"kk AS (SELECT sum({pi2} * k * k * {ek}) AS t2, "
        f"  sum((-{pi2} * {pi2} * k * k * k * k + 3 * {pi2} * k * k * z2) * {ek}) AS t3 "
        f"  FROM pg, LATERAL (SELECT unnest(range(1, CAST(ceil(13 * z) AS BIGINT) + 3)) AS k) AS t) "
        f"SELECT 1 - (k0.s * sqrt(2 * pi()) / z "
        f"  + kh.s1 * sqrt(pi() / 2) / (3 * z2 * z2 * sn) "
        f"  + (sqrt(pi() / 2) / n) * (kh.s2 / (36 * z2 * z2 * z2 * z) - kk.t2 / (18 * z2 * z)) "
        f"  + (sqrt(pi() / 2) / (sn * n)) * (kh.s3 / (3240 * z2 * z2 * z2 * z2 * z2) "
        f"    + kk.t3 / (108 * z2 * z2 * z2))) AS p_value, 0 AS degrees_of_freedom, "
        f"  d AS statistic, 'kolmogorov-smirnov' AS method, "
        f"  'Sample follows theoretical distribution' AS null_hypothesis "
        f"FROM pg, k0, kh, kk")


def _durbin_p(src: str) -> str:
    """Exact p by stepping one row of Durbin's matrix n times, each step times i / n."""
    return (
        f"dm AS (SELECT d, CAST(n AS BIGINT) AS n, CAST(ceil(n * d) AS BIGINT) AS k, "
        f"  ceil(n * d) - n * d AS h FROM {src}), "
        f"mm AS (SELECT *, 2 * k - 1 AS m FROM dm), "
        f"cell AS (SELECT i, j, (CASE WHEN i - j + 1 >= 0 THEN "
        f"    (1.0 - (CASE WHEN j = 1 THEN pow(h, i) ELSE 0 END) "
        f"         - (CASE WHEN i = m THEN pow(h, m - j + 1) ELSE 0 END) "
        f"         + (CASE WHEN i = m AND j = 1 AND h > 0.5 THEN pow(2 * h - 1, m) ELSE 0 END)) "
        f"    / exp(lgamma(i - j + 2)) ELSE 0.0 END) AS x "
        f"  FROM mm, LATERAL (SELECT unnest(range(1, m + 1)) AS i) AS a, "
        f"  LATERAL (SELECT unnest(range(1, m + 1)) AS j) AS b), "
        f"hcol AS (SELECT list(x ORDER BY i) AS c, j FROM cell GROUP BY j), "
        f"hm AS (SELECT list(c ORDER BY j) AS cols FROM hcol), "
        f"walk(i, v) AS (SELECT CAST(0 AS BIGINT), list_transform(range(1, m + 1), "
        f"    lambda q: CASE WHEN q = k THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM mm "
        f"  UNION ALL SELECT walk.i + 1, list_transform(cols, "
        f"    lambda c: list_dot_product(v, c) * (walk.i + 1) / n) "
        f"  FROM walk, hm, mm WHERE walk.i < n) "
        f"SELECT 1 - v[k] AS p_value, 0 AS degrees_of_freedom, d AS statistic, "
        f"  'kolmogorov-smirnov' AS method, "
        f"  'Sample follows theoretical distribution' AS null_hypothesis "
        f"FROM walk, mm WHERE walk.i = n")


def _phi_sql(z: str) -> str:
    """Standard normal CDF by 0.5 + phi(z) * sum z^(2k+1) / (2k+1)!!."""
    term = (f"exp((2 * k + 1) * ln(abs({z})) - ((k + 1) * ln(2.0) + lgamma(k + 1.5) "
            f"- 0.5 * ln(pi())))")
    return (f"(CASE WHEN {z} = 0 THEN 0.5 ELSE 0.5 + sign({z}) * exp(-{z} * {z} / 2) "
            f"/ sqrt(2 * pi()) * (SELECT sum({term}) FROM range(0, 300) AS kt(k)) END)")


def ks_sql(values: str, cdf: str, p_value=_pelz_good_p) -> str:
    """values: a SELECT giving column x; cdf: an expression of x; p_value: the CTEs and final
    SELECT that turn (d, n) into a result row."""
    return _sig_select(
        f"WITH RECURSIVE v AS (SELECT x, count(*) AS c FROM ({values}) AS s GROUP BY x), "
        f"r AS (SELECT x, c, sum(c) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING "
        f"  AND CURRENT ROW) - c AS below, sum(c) OVER () AS n FROM v), "
        f"f AS (SELECT *, {cdf} AS cdf FROM r), "
        f"dd AS (SELECT max(greatest(abs(below / n - cdf), abs((below + c) / n - cdf))) AS d, "
        f"  CAST(any_value(n) AS DOUBLE) AS n FROM f), "
        + p_value("dd"), TEST_COLS)


ORACLE["ks_expon"] = ks_sql("SELECT value AS x FROM events", "1 - exp(-x / 50.0)")
ORACLE["ks_small_sample"] = ks_sql(
    "SELECT CAST(s_acctbal AS DOUBLE) AS x FROM supplier", "(x + 1000.0) / 11000.0", _durbin_p)
ORACLE["ks_middling"] = ks_sql(
    "SELECT CAST(c_acctbal AS DOUBLE) AS x FROM customer", "(x + 1000.0) / 11000.0")
ORACLE["ks_norm"] = ks_sql("SELECT value AS x FROM events", _phi_sql("((x - 50.0) / 50.0)"))
ORACLE["ks_std_norm"] = ks_sql(
    "SELECT CAST(embedding[1] AS DOUBLE) * 8.0 AS x FROM embeddings", _phi_sql("x"))


# ---------------------------------------------------------------- naive Bayes

def _nb_rows_sql(bernoulli: bool) -> str:
    if bernoulli:
        f = ("CAST(l_quantity > 25 AS DOUBLE) AS f0, CAST(l_discount > 0.05 AS DOUBLE) AS f1, "
             "CAST(l_tax > 0.04 AS DOUBLE) AS f2")
    else:
        f = "l_quantity AS f0, round(l_discount * 100) AS f1, round(l_tax * 100) AS f2"
    return (f"SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, "
            f"l_returnflag AS label, {f} FROM lineitem")


def _nb_model_sql(bernoulli: bool, lam: float = 1.0) -> str:
    """CTEs rows, labs, prior(label, pi), cond(label, feature, theta)."""
    denom = (f"ln(labs.n + 2 * {lam})" if bernoulli
             else f"ln(st.st + 3 * {lam})")
    return (
        f"rows AS ({_nb_rows_sql(bernoulli)}), "
        "cells AS (SELECT rid, label, 0 AS feature, f0 AS x FROM rows UNION ALL "
        "  SELECT rid, label, 1, f1 FROM rows UNION ALL SELECT rid, label, 2, f2 FROM rows), "
        "labs AS (SELECT label, count(*) AS n FROM rows GROUP BY label), "
        "tot AS (SELECT sum(n) AS n, count(*) AS c FROM labs), "
        f"prior AS (SELECT label, ln(labs.n + {lam}) - ln(tot.n + tot.c * {lam}) AS pi "
        "  FROM labs, tot), "
        "s AS (SELECT label, feature, sum(x) AS s FROM cells GROUP BY ALL), "
        "st AS (SELECT label, sum(s) AS st FROM s GROUP BY label), "
        f"cond AS (SELECT s.label, s.feature, ln(s.s + {lam}) - {denom} AS theta "
        "  FROM s JOIN st USING (label) JOIN labs USING (label)) ")


NB_FIT_COLS = [("label", False), ("feature", False), ("pi", True), ("theta", True)]
for _name, _b in (("nb_multinomial_fit", False), ("nb_bernoulli_fit", True)):
    ORACLE[_name] = _sig_select(
        "WITH " + _nb_model_sql(_b)
        + "SELECT label, feature, pi, theta FROM cond JOIN prior USING (label)", NB_FIT_COLS)


def _nb_scores_sql(bernoulli: bool) -> str:
    if bernoulli:
        coef = "(cond.theta - ln(1 - exp(cond.theta)))"
        extra = ("neg AS (SELECT label, sum(ln(1 - exp(theta))) AS ns FROM cond GROUP BY label), ")
        const = "prior.pi + neg.ns"
        join_neg = "JOIN neg USING (label) "
    else:
        coef, extra, const, join_neg = "cond.theta", "", "prior.pi", ""
    return (
        "WITH " + _nb_model_sql(bernoulli) + ", " + extra +
        f"sc AS (SELECT c.rid, c.label AS true_label, cond.label, "
        f"  sum(CASE WHEN c.x <> 0 THEN c.x * {coef} ELSE 0 END) AS v "
        "  FROM cells c JOIN cond ON cond.feature = c.feature GROUP BY ALL), "
        f"score AS (SELECT sc.rid, sc.label, {const} + sc.v AS s FROM sc "
        f"  JOIN prior USING (label) {join_neg}), "
        "ranked AS (SELECT rid, label, s, row_number() OVER (PARTITION BY rid "
        "  ORDER BY s DESC, label ASC) AS rn, max(s) OVER (PARTITION BY rid) AS m FROM score), "
        "post AS (SELECT rid, label, rn, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY rid) "
        "  AS probability FROM ranked) ")


for _name, _b in (("nb_multinomial_predict", False), ("nb_bernoulli_predict", True)):
    ORACLE[_name] = (
        _nb_scores_sql(_b) + "SELECT r.l_orderkey, r.l_linenumber, post.label AS prediction "
        "FROM post JOIN rows r USING (rid) WHERE rn = 1")
ORACLE["nb_posterior"] = _sig_select(
    _nb_scores_sql(False) + "SELECT r.l_orderkey, r.l_linenumber, post.label, post.probability "
    "FROM post JOIN rows r USING (rid)",
    [("l_orderkey", False), ("l_linenumber", False), ("label", False), ("probability", "p")])

ORACLE["nb_posterior_blocked"] = ORACLE["nb_posterior"]
ORACLE["nb_rollup"] = ORACLE["nb_multinomial_fit"].replace(
    "FROM lineitem", "FROM lineitem WHERE year(l_shipdate) <> 1995")

ORACLE["nb_doc_quality"] = _sig_select(
    "WITH toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) "
    "  AS term FROM documents), "
    "cells AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS tf FROM toks "
    "  WHERE term <> '' GROUP BY ALL), "
    "lab AS (SELECT doc_id, quality AS label FROM labels), "
    "tr AS (SELECT c.doc_id, c.term, c.tf, l.label FROM cells c JOIN lab l USING (doc_id)), "
    "vocab AS (SELECT DISTINCT term FROM tr), "
    "dd AS (SELECT count(*) AS d FROM vocab), "
    "labs AS (SELECT label, count(*) AS n FROM lab GROUP BY label), "
    "tot AS (SELECT sum(n) AS n, count(*) AS c FROM labs), "
    "prior AS (SELECT label, ln(labs.n + 1.0) - ln(tot.n + tot.c * 1.0) AS pi FROM labs, tot), "
    "s AS (SELECT label, term, sum(tf) AS s FROM tr GROUP BY ALL), "
    "st AS (SELECT label, sum(s) AS st FROM s GROUP BY label), "
    "cond AS (SELECT labs.label, vocab.term, ln(coalesce(s.s, 0.0) + 1.0) - ln(st.st + dd.d * 1.0) "
    "  AS theta FROM labs CROSS JOIN vocab CROSS JOIN dd JOIN st ON st.label = labs.label "
    "  LEFT JOIN s ON s.label = labs.label AND s.term = vocab.term), "
    "contrib AS (SELECT c.doc_id, cond.label, sum(c.tf * cond.theta) AS v FROM cells c "
    "  JOIN cond USING (term) GROUP BY ALL), "
    "score AS (SELECT d.doc_id, p.label, p.pi + coalesce(contrib.v, 0.0) AS s "
    "  FROM documents d CROSS JOIN prior p LEFT JOIN contrib "
    "  ON contrib.doc_id = d.doc_id AND contrib.label = p.label), "
    "ranked AS (SELECT doc_id, label, s, row_number() OVER (PARTITION BY doc_id "
    "  ORDER BY s DESC, label ASC) AS rn, max(s) OVER (PARTITION BY doc_id) AS m FROM score), "
    "post AS (SELECT doc_id, label, rn, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY doc_id) "
    "  AS probability FROM ranked) "
    "SELECT doc_id, label AS prediction, probability FROM post WHERE rn = 1",
    [("doc_id", False), ("prediction", False), ("probability", "p")])


# ---------------------------------------------------------- linear regression

LR_BASE = ("SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 AS y, "
           "l_quantity / 10 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2 FROM lineitem")
LR_BASE_RAW = ("SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 AS y, "
               "l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem")


def sgd_sql(base: str, names: list[str], iters: int, step: float, intercept: bool = False,
            scaling: bool = False, init: list[float] | None = None) -> tuple[str, str]:
    """Recursive CTE replaying gradient descent on sufficient statistics.
    Returns (CTE text ending in ``fin``/``sc``, coefficient SELECT)."""
    d = len(names)
    p = d + (1 if intercept else 0)
    xs = [f"x{j}" for j in range(d)] + (["1.0"] if intercept else [])
    stats = ["count(*) AS n"]
    for a in range(p):
        for b in range(a, p):
            stats.append(f"sum({xs[a]} * {xs[b]}) AS a_{a}_{b}")
        stats.append(f"sum({xs[a]} * y) AS b_{a}")
    for j in range(d):
        stats.append(f"stddev_samp(x{j}) AS sd_{j}")
    fac = [(f"(CASE WHEN sd_{j} <> 0 THEN 1.0 / sd_{j} ELSE 0.0 END)" if scaling else "1.0")
           for j in range(d)] + (["1.0"] if intercept else [])
    facs = ", ".join(f"{fac[j]} AS f_{j}" for j in range(p))

    def A(a, b):
        lo, hi = min(a, b), max(a, b)
        return f"(f_{a} * a_{lo}_{hi} * f_{b})"

    init = list(init or [0.0] * d) + ([1.0] if intercept else [])
    ws = [f"w{j}" for j in range(p)]
    nws = []
    for j in range(p):
        g = " + ".join(f"{A(j, k)} * it.w{k}" for k in range(p))
        nws.append(f"it.w{j} - {step} / sqrt(it.i + 1) * (({g}) - f_{j} * b_{j}) / n AS nw{j}")
    diff = " + ".join(f"(nw{j} - w{j}) * (nw{j} - w{j})" for j in range(p))
    norm = " + ".join(f"nw{j} * nw{j}" for j in range(p))
    cte = (
        f"WITH RECURSIVE base AS ({base}), "
        f"st AS (SELECT {', '.join(stats)} FROM base), "
        f"sc AS (SELECT *, {facs} FROM st), "
        f"it(i, {', '.join(ws)}, done) AS ("
        f"  SELECT 0, {', '.join(f'CAST({float(v)!r} AS DOUBLE)' for v in init)}, false "
        f"  UNION ALL "
        f"  SELECT i + 1, {', '.join(f'nw{j}' for j in range(p))}, "
        f"    (i + 1 >= 2 AND sqrt({diff}) < 0.001 * greatest(sqrt({norm}), 1.0)) "
        f"  FROM (SELECT it.i, {', '.join('it.' + w for w in ws)}, {', '.join(nws)} "
        f"        FROM it, sc WHERE NOT it.done AND it.i < {iters}) AS q), "
        f"fin AS (SELECT * FROM it WHERE i = (SELECT max(i) FROM it)) ")
    coef = [f"SELECT '{names[j]}' AS term, w{j} * f_{j} AS coefficient FROM fin, sc"
            for j in range(d)]
    coef.append(f"SELECT 'intercept', {'w' + str(d) if intercept else '0.0'} FROM fin")
    return cte, " UNION ALL ".join(coef)


COEF_COLS = [("term", False), ("coefficient", True)]
LR_NAMES = ["x_qty", "x_disc", "x_tax"]
_c, _s = sgd_sql(LR_BASE, LR_NAMES, 100, 0.1)
ORACLE["linreg_sgd"] = _sig_select(_c + _s, COEF_COLS)
_c, _s = sgd_sql(LR_BASE, LR_NAMES, 50, 0.1, init=[1.0, 0.0, 0.0])
ORACLE["linreg_sgd_w0"] = _sig_select(_c + _s, COEF_COLS)
_c, _s = sgd_sql(LR_BASE, LR_NAMES, 100, 0.1, intercept=True)
ORACLE["linreg_sgd_intercept"] = _sig_select(_c + _s, COEF_COLS)
_PRED = "(fin.w3 + fin.w0 * base.x0 + fin.w1 * base.x1 + fin.w2 * base.x2)"
ORACLE["linreg_predict"] = _sig_select(
    _c + f"SELECT base.l_orderkey, base.l_linenumber, {_PRED} AS prediction FROM base, fin",
    [("l_orderkey", False), ("l_linenumber", False), ("prediction", True)])
ORACLE["linreg_mse"] = _sig_select(
    _c + f"SELECT avg(({_PRED} - base.y) * ({_PRED} - base.y)) AS mse, count(*) AS n "
    "FROM base, fin", [("mse", True), ("n", False)])
_c, _s = sgd_sql(LR_BASE_RAW, ["l_quantity", "l_discount", "l_tax"], 100, 0.1,
                 intercept=True, scaling=True)
ORACLE["linreg_sgd_scaled"] = _sig_select(_c + _s, COEF_COLS)


# ---------------------------------------------------------- Gaussian scoring

_EMB = ("SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings")
# sigma = a I + b 11': inverse by Sherman-Morrison, determinant a^63 (a + 64 b)
_MVN = ("(-0.5 * (64 * ln(2 * pi()) + 63 * ln(0.014) + ln(0.014 + 64 * 0.0015)) - 0.5 * "
        "(list_inner_product(d, d) - 0.0015 / (0.014 + 64 * 0.0015) * list_sum(d) * list_sum(d)) "
        "/ 0.014)")
_MVN_D = f"SELECT vec_id, list_transform(e, lambda v: v - 0.001) AS d FROM ({_EMB}) AS x"
ORACLE["mvn_logpdf"] = _sig_select(f"SELECT vec_id, {_MVN} AS logpdf FROM ({_MVN_D}) AS y",
                                   [("vec_id", False), ("logpdf", True)])
ORACLE["mvn_pdf"] = _sig_select(f"SELECT vec_id, exp({_MVN}) AS pdf FROM ({_MVN_D}) AS y",
                                [("vec_id", False), ("pdf", True)])
ORACLE["mvn_logpdf_wide"] = _sig_select(
    "SELECT vec_id, -0.5 * (64 * ln(2 * pi()) + 64 * ln(0.016)) - 0.5 * "
    "list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) / 0.016 "
    "AS logpdf FROM embeddings", [("vec_id", False), ("logpdf", True)])

_EMB_COV = (
    f"emb AS ({_EMB}), "
    "cell AS (SELECT vec_id, unnest(e) AS x, unnest(range(0, 64)) AS i FROM emb), "
    "avgs AS (SELECT i, avg(x) AS m FROM cell GROUP BY i), "
    "mid AS (SELECT vec_id, i, x - m AS z FROM cell JOIN avgs USING (i)), "
    "cov AS (SELECT p.i AS i, q.i AS j, sum(p.z * q.z) / (count(*) - 1) AS cov "
    "  FROM mid AS p JOIN mid AS q USING (vec_id) GROUP BY p.i, q.i) ")
ORACLE["cov_matrix_wide"] = sql_rounded_matrix(
    f"WITH {_EMB_COV} SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, cov FROM cov", "cov")
ORACLE["cov_matrix_tiled"] = ORACLE["cov_matrix_wide"]
ORACLE["corr_pearson_wide"] = sql_rounded_matrix(
    f"WITH {_EMB_COV}, sd AS (SELECT i, sqrt(cov) AS s FROM cov WHERE i = j) "
    "SELECT CAST(cov.i AS INTEGER) AS i, CAST(cov.j AS INTEGER) AS j, "
    "CASE WHEN cov.i = cov.j THEN 1.0 ELSE cov / (a.s * b.s) END AS corr "
    "FROM cov JOIN sd AS a ON a.i = cov.i JOIN sd AS b ON b.i = cov.j", "corr")

# ------------------------------------------------------------- sparse vectors

def _sparse_cov(cells: str, rows: str) -> str:
    """CTEs ending in ``cov`` (feature_i, feature_j, cov) of cells (r, f, x) over ``rows`` rows."""
    return (f"cells AS ({cells}), n AS ({rows}), "
            "s AS (SELECT f, sum(x) AS s FROM cells GROUP BY f), "
            "c AS (SELECT a.f AS i, b.f AS j, sum(a.x * b.x) AS v FROM cells AS a "
            "  JOIN cells AS b ON a.r = b.r AND a.f <= b.f GROUP BY a.f, b.f), "
            "cov AS (SELECT i AS feature_i, j AS feature_j, (v - si.s * sj.s / n) / (n - 1) AS cov "
            "  FROM c, n JOIN s AS si ON si.f = i JOIN s AS sj ON sj.f = j)")


_PAIR = [("feature_i", False), ("feature_j", False)]
_BOUGHT = _sparse_cov(
    "SELECT l_orderkey AS r, l_suppkey AS f, sum(l_quantity) AS x FROM lineitem GROUP BY ALL",
    "SELECT count(*) AS n FROM orders")
ORACLE["cov_sparse"] = _sig_select(f"WITH {_BOUGHT} SELECT * FROM cov", [*_PAIR, ("cov", True)])
ORACLE["corr_sparse"] = _sig_select(
    f"WITH {_BOUGHT}, sd AS (SELECT feature_i AS f, CASE WHEN abs(cov) <= 1e-12 THEN 0.0 "
    "ELSE sqrt(cov) END AS s FROM cov WHERE feature_i = feature_j) "
    "SELECT feature_i, feature_j, CASE WHEN feature_i = feature_j THEN 1.0 "
    "WHEN a.s = 0 OR b.s = 0 THEN 'nan'::DOUBLE ELSE cov / (a.s * b.s) END AS corr "
    "FROM cov JOIN sd AS a ON a.f = feature_i JOIN sd AS b ON b.f = feature_j",
    [*_PAIR, ("corr", True)])
_TERMS = ("SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT doc_id, "
          "unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) "
          "GROUP BY doc_id, term")
_TERM_COV = _sparse_cov(
    f"SELECT doc_id AS r, term AS f, tf AS x FROM ({_TERMS}) QUALIFY 10 * count(*) OVER "
    "(PARTITION BY term) >= (SELECT count(*) FROM documents)",
    "SELECT count(*) AS n FROM documents")
ORACLE["cov_sparse_terms"] = _sig_select(f"WITH {_TERM_COV} SELECT * FROM cov",
                                         [*_PAIR, ("cov", True)])
ORACLE["chisq_features_sparse"] = _sig_select(
    f"WITH tok AS ({_TERMS}), lab AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' "
    "  WHEN quality = 1 THEN 'good' ELSE 'poor' END AS c FROM labels), "
    "x AS (SELECT term, c, count(*) AS n FROM tok JOIN lab USING (doc_id) GROUP BY ALL), "
    "t AS (SELECT c, count(*) AS t FROM lab GROUP BY c), "
    "f AS (SELECT term, c, t, coalesce(n, 0) AS n1, t - coalesce(n, 0) AS n0 FROM "
    "  (SELECT DISTINCT term FROM x) CROSS JOIN t LEFT JOIN x USING (term, c)), "
    "m AS (SELECT *, sum(n1) OVER w AS r1, sum(n0) OVER w AS r0, sum(t) OVER w AS tt FROM f "
    "  WINDOW w AS (PARTITION BY term)), "
    "q AS (SELECT term AS feature, CASE WHEN max(r0) > 0 THEN sum(pow(n1 - r1 * t / tt, 2) / "
    "  (r1 * t / tt) + pow(n0 - r0 * t / tt, 2) / (r0 * t / tt)) ELSE 0.0 END AS statistic, "
    "  CASE WHEN max(r0) > 0 THEN 2 ELSE 0 END AS dof FROM m GROUP BY term) "
    "SELECT feature, CASE WHEN dof = 0 THEN 1.0 ELSE exp(-statistic / 2) END AS p_value, "
    "CAST(dof AS INTEGER) AS degrees_of_freedom, statistic, 'pearson' AS method, "
    f"'{INDEP}' AS null_hypothesis FROM q", [("feature", False), *TEST_COLS])
_c, _s = sgd_sql(
    "SELECT o_orderkey, any_value(o_totalprice) / 100000 AS y, " + ", ".join(
        f"coalesce(sum(CASE WHEN l_linenumber = {j + 1} THEN l_discount END), 0) * 10 AS x{j}"
        for j in range(7)) + " FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey "
    "GROUP BY o_orderkey", [f"x{j + 1}" for j in range(7)], 6, 0.5, intercept=True)
ORACLE["linreg_sgd_sparse"] = _sig_select(_c + _s, COEF_COLS)

# the sample covariance is inverted by the sweep operator, one pivot per step
ORACLE["mvn_outliers"] = _sig_select(
    f"WITH RECURSIVE {_EMB_COV}, "
    "rw AS (SELECT i, list(cov ORDER BY j) AS r FROM cov GROUP BY i), "
    "mu AS (SELECT list(m ORDER BY i) AS mu FROM avgs), "
    "sweep(k, m, ld) AS ("
    "  SELECT CAST(1 AS BIGINT), (SELECT list(r ORDER BY i) FROM rw), 0.0::DOUBLE "
    "  UNION ALL SELECT k + 1, list_transform(range(1, 65), lambda i: list_transform("
    "    range(1, 65), lambda j: CASE WHEN i = k AND j = k THEN -1.0 / m[k][k] "
    "      WHEN i = k THEN m[k][j] / m[k][k] WHEN j = k THEN m[i][k] / m[k][k] "
    "      ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END)), ld + ln(m[k][k]) "
    "  FROM sweep WHERE k <= 64), "
    "inv AS (SELECT m, ld FROM sweep WHERE k = 65), "
    "dd AS (SELECT vec_id, list_transform(range(1, 65), lambda i: e[i] - mu[i]) AS d FROM emb, mu), "
    "qq AS (SELECT vec_id, ld, -list_inner_product(d, list_transform(m, "
    "    lambda r: list_inner_product(r, d))) AS q FROM dd, inv) "
    "SELECT vec_id, -0.5 * (64 * ln(2 * pi()) + ld) - 0.5 * q AS logpdf, "
    "q > 93.2169 AS is_outlier FROM qq",
    [("vec_id", False), ("logpdf", True), ("is_outlier", False)])
ORACLE["linreg_predict_wide"] = _sig_select(
    f"SELECT vec_id, 0.25 + list_inner_product(e, list_transform(range(0, 64), "
    f"lambda j: (j % 7 - 3) / 10.0)) AS prediction FROM ({_EMB}) AS x",
    [("vec_id", False), ("prediction", True)])


# ------------------------------------------------- model round trips, streams

ORACLE["nb_model_roundtrip"] = ORACLE["nb_multinomial_fit"]
ORACLE["linreg_model_roundtrip"] = ORACLE["linreg_sgd_intercept"]
ORACLE["stream_summary_by_type"] = summary_sql(
    "(SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, value FROM events) AS ev",
    ["value"], ["day", "event_type"])
ORACLE["stream_summary"] = summary_sql(
    "(SELECT CAST(date_trunc('day', ts) AS DATE) AS day, value FROM events) AS ev",
    ["value"], ["day"])


def sgd_minibatch_sql(base: str, key: str, names: list[str], iters: int, step: float,
                      take: int, buckets: int = 1024) -> str:
    """Mini-batch replay: per-bucket statistics, and per iteration the sums over
    the buckets b with (b * odd_i + offset_i) mod B < take (intercept on)."""
    d = len(names)
    p = d + 1
    xs = [f"x{j}" for j in range(d)] + ["1.0"]
    stats = ["count(*) AS n"]
    for a in range(p):
        for b in range(a, p):
            stats.append(f"sum({xs[a]} * {xs[b]}) AS a_{a}_{b}")
        stats.append(f"sum({xs[a]} * y) AS b_{a}")
    sums = ", ".join(["sum(n) AS n"] + [f"sum(a_{a}_{b}) AS a_{a}_{b}" for a in range(p)
                                        for b in range(a, p)] + [f"sum(b_{a}) AS b_{a}"
                                                                 for a in range(p)])
    it1 = "(it.i + 1)"
    cond = (f"((bst.bk * (2 * (({it1} * 40503) % {buckets // 2}) + 1) + ({it1} * 7919) % {buckets}) "
            f"% {buckets}) < {take}")

    def A(a, b):
        return f"s.a_{min(a, b)}_{max(a, b)}"

    ws = [f"w{j}" for j in range(p)]
    nws = []
    for j in range(p):
        g = " + ".join(f"{A(j, k)} * it.w{k}" for k in range(p))
        nws.append(f"CASE WHEN s.n > 0 THEN it.w{j} - {step} / sqrt(it.i + 1) * "
                   f"(({g}) - s.b_{j}) / s.n ELSE it.w{j} END AS nw{j}")
    diff = " + ".join(f"(nw{j} - w{j}) * (nw{j} - w{j})" for j in range(p))
    norm = " + ".join(f"nw{j} * nw{j}" for j in range(p))
    init = ["CAST(0.0 AS DOUBLE)"] * d + ["CAST(1.0 AS DOUBLE)"]
    cte = (
        f"WITH RECURSIVE base AS ({base}), "
        f"bst AS (SELECT ({key}) % {buckets} AS bk, {', '.join(stats)} FROM base GROUP BY 1), "
        f"it(i, {', '.join(ws)}, seen, done) AS ("
        f"  SELECT 0, {', '.join(init)}, 0, false "
        f"  UNION ALL "
        f"  SELECT i + 1, {', '.join(f'nw{j}' for j in range(p))}, "
        f"    seen + CASE WHEN n > 0 THEN 1 ELSE 0 END, "
        f"    (n > 0 AND seen >= 1 AND sqrt({diff}) < 0.001 * greatest(sqrt({norm}), 1.0)) "
        f"  FROM (SELECT it.i, it.seen, s.n, {', '.join('it.' + w for w in ws)}, {', '.join(nws)} "
        f"        FROM it, LATERAL (SELECT {sums} FROM bst WHERE {cond}) AS s "
        f"        WHERE NOT it.done AND it.i < {iters}) AS q), "
        f"fin AS (SELECT * FROM it WHERE i = (SELECT max(i) FROM it)) ")
    coef = [f"SELECT '{names[j]}' AS term, w{j} AS coefficient FROM fin" for j in range(d)]
    coef.append(f"SELECT 'intercept', w{d} FROM fin")
    return _sig_select(cte + " UNION ALL ".join(coef), COEF_COLS)


ORACLE["linreg_minibatch"] = sgd_minibatch_sql(
    LR_BASE, "l_orderkey * 16 + l_linenumber", LR_NAMES, 100, 0.1, 512)


def _ibeta_sql(x: str, a: str, b: str, terms: int = 50000) -> str:
    """Regularized incomplete beta I_x(a, b) by its hypergeometric series
    x^a (1-x)^b / (a B(a, b)) * sum_n (a+b)_n / (a+1)_n x^n, taken on the side
    of the symmetry I_x(a, b) = 1 - I_{1-x}(b, a) where it converges fast."""
    def side(xx, aa, bb):
        front = (f"exp(({aa}) * ln({xx}) + ({bb}) * ln(1 - ({xx})) - lgamma({aa}) - lgamma({bb}) "
                 f"+ lgamma(({aa}) + ({bb})))")
        # one exponent per term: the Pochhammer ratio alone can overflow
        series = (f"(SELECT sum(exp(lgamma(({aa}) + ({bb}) + k) - lgamma(({aa}) + ({bb})) "
                  f"- lgamma(({aa}) + 1 + k) + lgamma(({aa}) + 1) + k * ln({xx}))) "
                  f"FROM range(0, {terms}) AS bt(k))")
        return f"({front} / ({aa}) * {series})"
    return (f"(CASE WHEN ({x}) >= 1 THEN 1.0 WHEN ({x}) <= 0 THEN 0.0 "
            f"WHEN ({x}) < (({a}) + 1) / (({a}) + ({b}) + 2) THEN {side(x, a, b)} "
            f"ELSE 1 - {side(f'(1 - ({x}))', b, a)} END)")


ORACLE["stream_ab_test"] = _sig_select(
    "WITH ev AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, value, "
    "  event_type = 'purchase' AS trt FROM events), "
    "m AS (SELECT day, count(*) FILTER (WHERE NOT trt) AS na, avg(value) FILTER (WHERE NOT trt) AS ma, "
    "  var_samp(value) FILTER (WHERE NOT trt) AS va, count(*) FILTER (WHERE trt) AS nb, "
    "  avg(value) FILTER (WHERE trt) AS mb, var_samp(value) FILTER (WHERE trt) AS vb "
    "  FROM ev GROUP BY day), "
    "s AS (SELECT day, (ma - mb) / sqrt(va / na + vb / nb) AS stat, "
    "  (va / na + vb / nb) * (va / na + vb / nb) / ((va / na) * (va / na) / (na - 1) "
    "  + (vb / nb) * (vb / nb) / (nb - 1)) AS dof FROM m) "
    f"SELECT day, {_ibeta_sql('dof / (dof + stat * stat)', 'dof / 2', '0.5')} AS p_value, "
    "dof AS degrees_of_freedom, stat AS statistic, 'Welch''s 2-sample t-test' AS method, "
    "'Both groups have same mean' AS null_hypothesis FROM s",
    [("day", False), ("p_value", "p"), ("degrees_of_freedom", True), ("statistic", True),
     ("method", False), ("null_hypothesis", False)])


ORACLE["nb_bernoulli_doc"] = _sig_select(
    "WITH toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) "
    "  AS term FROM documents), "
    "cells AS (SELECT DISTINCT doc_id, term FROM toks WHERE term <> ''), "
    "lab AS (SELECT doc_id, toxic AS label FROM labels), "
    "tr AS (SELECT c.doc_id, c.term, l.label FROM cells c JOIN lab l USING (doc_id)), "
    "vocab AS (SELECT DISTINCT term FROM tr), "
    "labs AS (SELECT label, count(*) AS n FROM lab GROUP BY label), "
    "tot AS (SELECT sum(n) AS n, count(*) AS c FROM labs), "
    "prior AS (SELECT label, ln(labs.n + 1.0) - ln(tot.n + tot.c * 1.0) AS pi FROM labs, tot), "
    "s AS (SELECT label, term, CAST(count(*) AS DOUBLE) AS s FROM tr GROUP BY ALL), "
    "cond AS (SELECT labs.label, vocab.term, ln(coalesce(s.s, 0.0) + 1.0) - ln(labs.n + 2.0) "
    "  AS theta FROM labs CROSS JOIN vocab "
    "  LEFT JOIN s ON s.label = labs.label AND s.term = vocab.term), "
    "neg AS (SELECT label, sum(ln(1 - exp(theta))) AS ns FROM cond GROUP BY label), "
    "contrib AS (SELECT c.doc_id, cond.label, sum(cond.theta - ln(1 - exp(cond.theta))) AS v "
    "  FROM cells c JOIN cond USING (term) GROUP BY ALL), "
    "score AS (SELECT d.doc_id, p.label, p.pi + neg.ns + coalesce(contrib.v, 0.0) AS s "
    "  FROM documents d CROSS JOIN prior p JOIN neg ON neg.label = p.label LEFT JOIN contrib "
    "  ON contrib.doc_id = d.doc_id AND contrib.label = p.label), "
    "ranked AS (SELECT doc_id, label, s, row_number() OVER (PARTITION BY doc_id "
    "  ORDER BY s DESC, label ASC) AS rn, max(s) OVER (PARTITION BY doc_id) AS m FROM score), "
    "post AS (SELECT doc_id, label, rn, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY doc_id) "
    "  AS probability FROM ranked) "
    "SELECT doc_id, label AS prediction, probability FROM post WHERE rn = 1",
    [("doc_id", False), ("prediction", False), ("probability", "p")])

ORACLE["stream_ab_test_student"] = _sig_select(
    "WITH ev AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, value, "
    "  event_type = 'purchase' AS trt FROM events), "
    "m AS (SELECT day, count(*) FILTER (WHERE NOT trt) AS na, avg(value) FILTER (WHERE NOT trt) AS ma, "
    "  var_samp(value) FILTER (WHERE NOT trt) AS va, count(*) FILTER (WHERE trt) AS nb, "
    "  avg(value) FILTER (WHERE trt) AS mb, var_samp(value) FILTER (WHERE trt) AS vb "
    "  FROM ev GROUP BY day), "
    "s AS (SELECT day, CAST(na + nb - 2 AS DOUBLE) AS dof, "
    "  (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)) "
    "  AS stat FROM m) "
    f"SELECT day, {_ibeta_sql('dof / (dof + stat * stat)', 'dof / 2', '0.5')} AS p_value, "
    "dof AS degrees_of_freedom, stat AS statistic, 'Student''s 2-sample t-test' AS method, "
    "'Both groups have same mean' AS null_hypothesis FROM s",
    [("day", False), ("p_value", "p"), ("degrees_of_freedom", True), ("statistic", True),
     ("method", False), ("null_hypothesis", False)])


ORACLE["stream_running_summary"] = summary_sql("events", ["value"], ["event_type"])
ORACLE["stream_cumulative_test"] = _sig_select(
    "WITH e AS (SELECT CAST(user_id % 2 AS INTEGER) AS experiment, value, "
    "  event_type = 'purchase' AS t FROM events "
    "  WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 7 DAY), "
    "m AS (SELECT experiment, count(*) FILTER (WHERE NOT t) AS na, count(*) FILTER (WHERE t) AS nb, "
    "  avg(value) FILTER (WHERE NOT t) AS ma, avg(value) FILTER (WHERE t) AS mb, "
    "  var_samp(value) FILTER (WHERE NOT t) AS va, var_samp(value) FILTER (WHERE t) AS vb "
    "  FROM e GROUP BY experiment), "
    "s AS (SELECT experiment, na, nb, (ma - mb) / sqrt(va / na + vb / nb) AS stat, "
    "  pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)) AS dof "
    "  FROM m) "
    f"SELECT experiment, na AS n_a, nb AS n_b, {_ibeta_sql('dof / (dof + stat * stat)', 'dof / 2', '0.5')}"
    " AS p_value, dof AS degrees_of_freedom, stat AS statistic, "
    "'Welch''s 2-sample t-test' AS method, 'Both groups have same mean' AS null_hypothesis FROM s",
    [("experiment", False), ("n_a", False), ("n_b", False), ("p_value", "p"),
     ("degrees_of_freedom", True), ("statistic", True), ("method", False), ("null_hypothesis", False)])
ORACLE["corr_zipped"] = ORACLE["corr_pearson_pair"]
