"""DuckDB SQL oracles, one per registered query that SQL can express.

Each statement starts from the same ``policies`` adapter text
(``riskframe.sources.sql``), rounds doubles exactly as the Spark side does
(``sig_round_sql``) and aliases every column to the Spark name.
"""

from __future__ import annotations

import math

from riskframe.functions.numeric import sig_round_sql as S
from riskframe.plans.common import PROFILE_COLUMNS, STRING_COLUMNS
from riskframe.sources.sql import with_policies
from riskframe.sources.tables import NUMERIC_COLUMNS, POLICY_COLUMNS

ORACLES: dict[str, str] = {}

DOUBLE_COLUMNS = {"policy_tenure", "age_of_policyholder", "qty", "price", "disc"}


def oracle(name: str, sql: str, policies: bool = True) -> None:
    ORACLES[name] = with_policies(sql) if policies else sql


def cols_sql(cols) -> str:
    return ", ".join(S(c) + f" AS {c}" if c in DOUBLE_COLUMNS else c for c in cols)


def long_sql(cols, table="policies", vtype="DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {vtype}) AS value FROM {table}" for c in cols)


# --- sources, inspection, projection -------------------------------------

oracle("shape", f"SELECT count(*) AS n_rows, CAST({len(POLICY_COLUMNS)} AS INTEGER) AS n_cols "
                "FROM policies")
oracle("head", f"SELECT {cols_sql(POLICY_COLUMNS)} FROM policies ORDER BY policy_id LIMIT 5")
oracle("drop_columns", "SELECT " + cols_sql([c for c in POLICY_COLUMNS
                                              if c not in ("max_torque", "max_power")])
       + " FROM policies")
oracle("select_dtypes", f"SELECT {cols_sql(PROFILE_COLUMNS)} FROM policies")
oracle("move_last", f"SELECT {cols_sql(['policy_id', 'segment', 'qty', 'is_claim'])} FROM policies")

# --- profiling ---------------------------------------------------------------

oracle("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM policies"
    for c in POLICY_COLUMNS))
oracle("duplicate_count",
       "SELECT CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS n_duplicates FROM "
       f"(SELECT count(*) AS cnt FROM policies GROUP BY {', '.join(POLICY_COLUMNS[1:])})")
oracle("unique_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM policies"
    for c in POLICY_COLUMNS))
oracle("describe", f"""
, long AS ({long_sql(PROFILE_COLUMNS)})
SELECT "column", count(value) AS count, {S('avg(value)')} AS mean, {S('stddev_samp(value)')} AS std,
       {S('min(value)')} AS min, {S('quantile_cont(value, 0.25)')} AS p25,
       {S('quantile_cont(value, 0.5)')} AS p50, {S('quantile_cont(value, 0.75)')} AS p75,
       {S('max(value)')} AS max
FROM long GROUP BY "column"
""")
oracle("numeric_profile", f"""
, long AS ({long_sql(PROFILE_COLUMNS)}),
m AS (SELECT "column", count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std,
             var_samp(value) AS var, min(value) AS mn, max(value) AS mx,
             skewness(value) AS sk, kurtosis(value) AS ku,
             quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
             quantile_cont(value, 0.75) AS q3
      FROM long GROUP BY "column"),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM m),
md AS (SELECT "column", value AS mode FROM (
         SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rn
         FROM (SELECT "column", value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY 1, 2))
       WHERE rn = 1),
o AS (SELECT l."column", count(*) FILTER (WHERE l.value < f.lower OR l.value > f.upper) AS outlier_count
      FROM long l JOIN f USING ("column") GROUP BY 1)
SELECT f."column", n, {S('mean')} AS mean, {S('med')} AS median, {S('mode')} AS mode,
       {S('std')} AS std, {S('var')} AS var, {S('mn')} AS min, {S('mx')} AS max,
       {S('mx - mn')} AS range, {S('q1')} AS q1, {S('q3')} AS q3, {S('iqr')} AS iqr,
       {S('sk')} AS skewness, {S('ku')} AS kurtosis, {S('lower')} AS lower_bound,
       {S('upper')} AS upper_bound, outlier_count
FROM f LEFT JOIN md USING ("column") JOIN o USING ("column")
""")
oracle("value_counts", f"""
SELECT area_cluster, count(*) AS count,
       {S('count(*)::DOUBLE / sum(count(*)) OVER ()')} AS share
FROM policies WHERE area_cluster IS NOT NULL GROUP BY area_cluster
""")


def _top_sql(table: str, frame: str) -> str:
    return f"""
SELECT "column", CAST(rank AS INTEGER) AS rank, value, count, {S('count::DOUBLE / total')} AS share,
       '{frame}' AS frame
FROM (SELECT "column", value, count,
             row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank,
             sum(count) OVER (PARTITION BY "column") AS total
      FROM (SELECT "column", value, count(*) AS count
            FROM ({long_sql(STRING_COLUMNS, table, 'VARCHAR')}) WHERE value IS NOT NULL
            GROUP BY 1, 2))
WHERE rank <= 5"""


oracle("top_categories", _top_sql("train_t", "train") + " UNION ALL " + _top_sql("test_t", "test"))
oracle("group_rate", f"""
SELECT "column", value, {S('avg(y)')} AS rate, count(*) AS n
FROM (SELECT CAST(is_claim AS DOUBLE) AS y, "column", value FROM (
        {' UNION ALL '.join(f"SELECT is_claim, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM policies" for c in STRING_COLUMNS)}))
WHERE value IS NOT NULL GROUP BY 1, 2
""")
_pairs = [(a, b) for i, a in enumerate(PROFILE_COLUMNS) for b in PROFILE_COLUMNS[i + 1:]]
oracle("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr "
    "FROM policies" for a, b in _pairs))
oracle("histogram", f"""
, long AS (SELECT * FROM ({long_sql(NUMERIC_COLUMNS)}) WHERE value IS NOT NULL),
rng AS (SELECT "column",
               CASE WHEN max(value) = min(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
               CASE WHEN max(value) = min(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
        FROM long GROUP BY 1),
cnt AS (SELECT l."column", CAST(least(floor((value - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin,
               count(*) AS c
        FROM long l JOIN rng USING ("column") GROUP BY 1, 2),
grid AS (SELECT "column", lo, hi, CAST(b AS INTEGER) AS bin FROM rng, range(30) t(b))
SELECT g."column", g.bin, {S('lo + bin * ((hi - lo) / 30)')} AS lower,
       {S('lo + (bin + 1) * ((hi - lo) / 30)')} AS upper, coalesce(c, 0) AS count
FROM grid g LEFT JOIN cnt USING ("column", bin)
""")


def _kde_sql(table: str, frame: str, cols, grid: int = 50, bins: int = 512, cut: float = 3.0) -> str:
    root = repr(math.sqrt(2 * math.pi))
    return f"""
SELECT "column", CAST(g AS INTEGER) AS g, {S('x')} AS x, {S('density')} AS density, '{frame}' AS frame
FROM (SELECT "column", g, x, sum(w * exp(-0.5 * ((x - c) / bw) * ((x - c) / bw)) / (n * bw * {root})) AS density
      FROM (SELECT b."column", b.w, s.n, s.bw,
                   s.mn + (b.bin + 0.5) * s.width AS c, t.g,
                   (s.mn - {cut!r} * s.bw) + t.g * ((s.mx - s.mn + {2 * cut!r} * s.bw) / {grid - 1}) AS x
            FROM (SELECT l."column", CAST(least(floor((value - s.mn) / s.width), {bins - 1}) AS INTEGER) AS bin,
                         count(*) AS w
                  FROM ({long_sql(cols, table)}) l
                  JOIN (SELECT *, CASE WHEN mx > mn THEN (mx - mn) / {bins} ELSE 1.0 END AS width
                        FROM (SELECT "column", count(value) AS n, min(value) AS mn, max(value) AS mx,
                                     stddev_samp(value) * pow(count(value)::DOUBLE, -0.2) AS bw
                              FROM ({long_sql(cols, table)}) WHERE value IS NOT NULL GROUP BY 1)) s
                    USING ("column")
                  WHERE value IS NOT NULL GROUP BY 1, 2) b
            JOIN (SELECT *, CASE WHEN mx > mn THEN (mx - mn) / {bins} ELSE 1.0 END AS width
                  FROM (SELECT "column", count(value) AS n, min(value) AS mn, max(value) AS mx,
                               stddev_samp(value) * pow(count(value)::DOUBLE, -0.2) AS bw
                        FROM ({long_sql(cols, table)}) WHERE value IS NOT NULL GROUP BY 1)) s
              USING ("column"), range({grid}) t(g)
            WHERE s.bw > 0)
      GROUP BY 1, 2, 3)"""


oracle("kde", _kde_sql("train_t", "train", NUMERIC_COLUMNS) + " UNION ALL "
       + _kde_sql("test_t", "test", NUMERIC_COLUMNS))
oracle("class_balance", f"""
SELECT is_claim, count(*) AS count, {S('count(*)::DOUBLE / sum(count(*)) OVER ()')} AS share
FROM policies GROUP BY is_claim""")
oracle("balance_ratio", f"""
SELECT {S("CAST(count(*) FILTER (WHERE is_claim = 0) AS DOUBLE) / "
          "nullif(CAST(count(*) FILTER (WHERE is_claim = 1) AS DOUBLE), 0)")} AS balance_ratio
FROM policies""")
oracle("class_weights", f"""
SELECT is_claim, {S('sum(count(*)) OVER () / (count(*) OVER () * count(*))')} AS weight
FROM policies GROUP BY is_claim""")

# --- two-table comparison ---------------------------------------------------

_test_cols = [c for c in POLICY_COLUMNS if c != "is_claim"]
oracle("compare_profiles", f"""
SELECT coalesce(a."column", b."column") AS "column", a.n_unique AS n_unique_train,
       b.n_unique AS n_unique_test
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM train_t" for c in POLICY_COLUMNS)}) a
FULL OUTER JOIN ({' UNION ALL '.join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM test_t" for c in _test_cols)}) b
ON a."column" = b."column"
""")
_diff_cols = STRING_COLUMNS
oracle("category_diff", f"""
, la AS (SELECT DISTINCT * FROM ({long_sql(_diff_cols, 'train_t', 'VARCHAR')})),
lb AS (SELECT DISTINCT * FROM ({long_sql(_diff_cols, 'test_t', 'VARCHAR')}))
SELECT *, 'train' AS only_in FROM (SELECT * FROM la EXCEPT SELECT * FROM lb)
UNION ALL
SELECT *, 'test' AS only_in FROM (SELECT * FROM lb EXCEPT SELECT * FROM la)
""")


# --- scalar cleaning and fitted features -------------------------------------

from riskframe.functions.hashing import hash_hex_sql, uniform_hash_sql  # noqa: E402
from riskframe.functions.numeric import abs_round_sql as AR  # noqa: E402
from riskframe.operators.features import _term_name, poly_names  # noqa: E402
from riskframe.plans.queries import (ANOVA_COLUMNS, INTERACTION_COLUMNS, ONE_HOT_COLUMNS,  # noqa: E402
                                     OUTLIER_COLUMNS, POLY_COLUMNS, SCALE_COLUMNS, SMOTE_COLUMNS, SWEEP)

oracle("yes_no_to_int", "SELECT policy_id, CAST(CASE WHEN is_esc = 'Yes' THEN 1 "
                        "WHEN is_esc = 'No' THEN 0 END AS INTEGER) AS is_esc FROM policies")


def _measure(col: str, prefix: str) -> str:
    part = lambda i: f"nullif(split_part({col}, '@', {i}), '')"
    num = lambda i: f"CAST(nullif(regexp_extract({part(i)}, '([0-9.]+)', 1), '') AS DOUBLE)"
    return (f"{S(num(1))} AS {prefix}, nullif(regexp_extract({part(1)}, '([a-zA-Z]+)', 1), '') "
            f"AS {prefix}_unit, {S(num(2))} AS {prefix}_rpm")


oracle("parse_measure", f"SELECT policy_id, {_measure('max_torque', 'Torque')}, "
                        f"{_measure('max_power', 'Power')} FROM policies")
oracle("one_hot", f"""
, long AS ({' UNION ALL '.join(f"SELECT policy_id, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM policies" for c in ONE_HOT_COLUMNS)}),
cats AS (SELECT DISTINCT col, v AS cat FROM long WHERE v IS NOT NULL)
SELECT l.policy_id, c.col || '_' || c.cat AS feature,
       CAST(coalesce(l.v = c.cat, false) AS INTEGER) AS value
FROM long l JOIN cats c ON l.col = c.col
""")
oracle("bool_to_int", "SELECT policy_id, CAST(n_lines >= 4 AS INTEGER) AS many_lines FROM policies")

_fw = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS med_{c}, "
                f"quantile_cont({c}, 0.75) AS q3_{c}" for c in OUTLIER_COLUMNS)


def _lo(c):
    return f"(q1_{c} - 1.5 * (q3_{c} - q1_{c}))"


def _hi(c):
    return f"(q3_{c} + 1.5 * (q3_{c} - q1_{c}))"


oracle("outlier_to_median", f"""
, fw AS (SELECT {_fw} FROM policies)
SELECT policy_id, {', '.join(S(f'CASE WHEN {c} < {_lo(c)} OR {c} > {_hi(c)} THEN med_{c} ELSE CAST({c} AS DOUBLE) END') + f' AS {c}' for c in OUTLIER_COLUMNS)}
FROM policies, fw
""")
oracle("outlier_rows", f"""
, fw AS (SELECT {_fw} FROM policies)
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < {_lo(c)} OR {c} > {_hi(c)}) AS n_outliers FROM policies, fw" for c in OUTLIER_COLUMNS)}
""")
oracle("outlier_filter", f"""
, fw AS (SELECT {_fw} FROM policies)
SELECT policy_id, {', '.join(S(f'CAST({c} AS DOUBLE)') + f' AS {c}' if c in DOUBLE_COLUMNS else c for c in OUTLIER_COLUMNS)}
FROM policies, fw WHERE {' AND '.join(f'{c} BETWEEN {_lo(c)} AND {_hi(c)}' for c in OUTLIER_COLUMNS)}
""")


def _scaled(c):
    sd = f"stddev_pop({c}) OVER ()"
    return AR(f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / (CASE WHEN {sd} = 0 OR {sd} IS NULL THEN 1 ELSE {sd} END)")


oracle("standard_scale", f"SELECT policy_id, {', '.join(_scaled(c) + f' AS {c}' for c in SCALE_COLUMNS)} FROM policies")


def _poly_sql(cols, interaction_only):
    out = []
    for term in poly_names(cols, 2, interaction_only):
        if len(term) == 1:
            out.append(cols_sql([term[0]]))
        else:
            out.append(S(" * ".join(f"CAST({t} AS DOUBLE)" for t in term)) + f" AS {_term_name(term)}")
    return f"SELECT policy_id, {', '.join(out)} FROM policies"


oracle("poly_features", _poly_sql(POLY_COLUMNS, False))
oracle("interaction_features", _poly_sql(INTERACTION_COLUMNS, True))

_ANOVA = f"""
, long AS ({' UNION ALL '.join(f"SELECT is_claim AS y, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM policies" for c in ANOVA_COLUMNS)}),
per AS (SELECT feature, y, count(x) AS n, avg(x) AS m, var_pop(x) AS v FROM long WHERE x IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT feature, sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS gm FROM per GROUP BY 1),
ss AS (SELECT p.feature, t.nn, t.k, sum(p.n * (p.m - t.gm) * (p.m - t.gm)) AS ssb, sum(p.n * p.v) AS ssw
       FROM per p JOIN tot t USING (feature) GROUP BY 1, 2, 3),
fs AS (SELECT feature, (ssb / (k - 1)) / nullif(ssw / (nn - k), 0) AS f FROM ss)
"""
oracle("anova_f_scores", _ANOVA + f"SELECT feature, {S('f')} AS f_score FROM fs")
oracle("select_k_best", _ANOVA + """
SELECT rank, feature FROM (
  SELECT CAST(row_number() OVER (ORDER BY f DESC NULLS LAST, feature) AS INTEGER) AS rank, feature FROM fs)
WHERE rank <= 3""")
oracle("hstack_by_key", f"SELECT policy_id, segment, is_claim, {_scaled('policy_tenure')} AS policy_tenure FROM policies")

# --- splits -------------------------------------------------------------------

_H = hash_hex_sql("policy_id", 17)
oracle("train_test_split", f"""
SELECT policy_id, is_claim,
       CASE WHEN row_number() OVER (ORDER BY {_H}, policy_id) - 1 < ceil(0.3 * count(*) OVER ())
            THEN 'test' ELSE 'train' END AS split
FROM policies""")
oracle("stratified_kfold", f"""
SELECT policy_id, is_claim,
       CAST((row_number() OVER (PARTITION BY is_claim ORDER BY {_H}, policy_id) - 1) * 5
            // count(*) OVER (PARTITION BY is_claim) AS INTEGER) AS fold
FROM policies""")
oracle("stratified_sample", f"""
SELECT policy_id, is_claim FROM (
  SELECT policy_id, is_claim, row_number() OVER (PARTITION BY is_claim ORDER BY {_H}, policy_id) - 1 AS rk,
         count(*) OVER (PARTITION BY is_claim) AS nc FROM policies)
WHERE rk < floor(0.3 * nc + 0.5)""")

# --- evaluation on a deterministic score -----------------------------------------

_SCORED = (f", scored AS (SELECT policy_id, is_claim AS label, "
           f"(floor({uniform_hash_sql('policy_id', 7)} * 50) + n_lines * 10) / 130 AS score FROM policies)")


def _cells_sql(thr):
    return (f"count(*) FILTER (WHERE label = 1 AND score >= {thr}) AS tp, "
            f"count(*) FILTER (WHERE label = 0 AND score >= {thr}) AS fp, "
            f"count(*) FILTER (WHERE label = 0 AND score < {thr}) AS tn, "
            f"count(*) FILTER (WHERE label = 1 AND score < {thr}) AS fn")


def _div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"


_ACC, _PRE = _div("tp + tn", "tp + fp + tn + fn"), _div("tp", "tp + fp")
_REC, _F1 = _div("tp", "tp + fn"), _div("2 * tp", "2 * tp + fp + fn")

oracle("confusion_matrix", _SCORED + f"""
, c AS (SELECT {_cells_sql(0.5)} FROM scored)
SELECT 0 AS label, 0 AS pred, tn AS count FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")
oracle("binary_metrics", _SCORED + f"""
, c AS (SELECT {_cells_sql(0.5)} FROM scored)
SELECT {S(_ACC)} AS accuracy, {S(_PRE)} AS precision_1, {S(_REC)} AS recall_1, {S(_F1)} AS f1_1,
       tp, fp, tn, fn FROM c""")
_p0, _r0, _f0 = _div("tn", "tn + fn"), _div("tn", "tn + fp"), _div("2 * tn", "2 * tn + fn + fp")
oracle("classification_report", _SCORED + f"""
, c AS (SELECT {_cells_sql(0.5)} FROM scored),
m AS (SELECT {_p0} AS p0, {_r0} AS r0, {_f0} AS f0, tn + fp AS s0, {_PRE} AS p1, {_REC} AS r1,
             {_F1} AS f1, tp + fn AS s1, {_ACC} AS acc, tp + fn + tn + fp AS n FROM c)
SELECT '0' AS class, {S('p0')} AS precision, {S('r0')} AS recall, {S('f0')} AS f1, s0 AS support FROM m
UNION ALL SELECT '1', {S('p1')}, {S('r1')}, {S('f1')}, s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, {S('acc')}, n FROM m
UNION ALL SELECT 'macro avg', {S('(p0 + p1) / 2')}, {S('(r0 + r1) / 2')}, {S('(f0 + f1) / 2')}, n FROM m
UNION ALL SELECT 'weighted avg', {S(_div('p0 * s0 + p1 * s1', 'n'))}, {S(_div('r0 * s0 + r1 * s1', 'n'))},
                 {S(_div('f0 * s0 + f1 * s1', 'n'))}, n FROM m""")
_CUM = _SCORED + """
, per AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
                 count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1),
cum AS (SELECT threshold, pos, neg,
               sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cp,
               sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cn FROM per),
tot AS (SELECT sum(pos) AS pp, sum(neg) AS nn FROM per)"""
oracle("roc_curve", _CUM + f"\nSELECT {S('threshold')} AS threshold, {S('cn / nn')} AS fpr, {S('cp / pp')} AS tpr FROM cum, tot")
oracle("auc", _CUM + f"\nSELECT {S('sum(neg * (cp - pos + pos / 2.0)) / (max(pp) * max(nn))')} AS auc FROM cum, tot")
_PR = _CUM + ", pr AS (SELECT threshold, cp / (cp + cn) AS precision, cp / pp AS recall FROM cum, tot)"
oracle("pr_curve", _PR + f"\nSELECT {S('threshold')} AS threshold, {S('precision')} AS precision, {S('recall')} AS recall FROM pr")


def _eval_sql(thr, extra=""):
    return (f"SELECT CAST({thr!r} AS DOUBLE) AS threshold, {S(_ACC)} AS accuracy, {S(_PRE)} AS precision_1, "
            f"{S(_REC)} AS recall_1{extra} FROM (SELECT {_cells_sql(thr)} FROM scored)")


oracle("eval_at_threshold", _SCORED + "\n" + _eval_sql(0.4))
oracle("threshold_for_target_recall", _PR + f"\nSELECT {S('coalesce(max(threshold) FILTER (WHERE recall >= 0.7), 0.5)')} AS threshold FROM pr")
oracle("sweep_thresholds", _SCORED + "\n" + " UNION ALL ".join(_eval_sql(t) for t in SWEEP))
oracle("best_f1_threshold", _PR + f"""
, pf AS (SELECT threshold, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM pr)
SELECT {S('threshold')} AS threshold, {S('f1')} AS f1 FROM pf ORDER BY f1 DESC, threshold DESC LIMIT 1""")
oracle("model_comparison", _SCORED + "\n" + " UNION ALL ".join(
    f"SELECT *, 'score@{t}' AS model, {S(_div('2 * precision_1 * recall_1', 'precision_1 + recall_1'))} AS f1_1 "
    f"FROM ({_eval_sql(t)})" for t in (0.5, 0.3)))
oracle("concat_results", _SCORED + f"""
SELECT * FROM (SELECT *, 'sweep' AS "group" FROM ({_eval_sql(0.5)} UNION ALL {_eval_sql(0.4)}))
UNION ALL BY NAME
SELECT {S(_ACC)} AS accuracy, {S(_PRE)} AS precision_1, {S(_REC)} AS recall_1, {S(_F1)} AS f1_1,
       tp, fp, tn, fn, 'single' AS "group" FROM (SELECT {_cells_sql(0.3)} FROM scored)""")

# the largest, over all starts, of the smallest mean over all ends
oracle("isotonic_fit", _SCORED + f"""
, pts AS (SELECT score, count(*) AS n, CAST(sum(label) AS BIGINT) AS y FROM scored GROUP BY 1),
c AS (SELECT *, row_number() OVER (ORDER BY score) AS i, sum(n) OVER (ORDER BY score) AS cn, sum(y) OVER (ORDER BY score) AS cy FROM pts),
m AS (SELECT a.i AS j, b.i AS k, CAST(b.cy - a.cy + a.y AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
      FROM c a JOIN c b ON b.i >= a.i),
lo AS (SELECT k AS i, min(mean) OVER (PARTITION BY j ORDER BY k DESC) AS v FROM m),
iso AS (SELECT i, max(v) AS v FROM lo GROUP BY i)
SELECT {S('score')} AS score, n, y AS n_pos, {S('v')} AS calibrated FROM c JOIN iso USING (i)""")
oracle("score_stream_restart", _SCORED + f"SELECT policy_id, label, {S('score')} AS score FROM scored")


# --- model-side queries that SQL can express --------------------------------------

from riskframe.plans.queries import NB_COLUMNS  # noqa: E402

_NB_SPLIT = f"""
, sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {_H}, policy_id) - 1 < ceil(0.3 * count(*) OVER ())
                        THEN 'test' ELSE 'train' END AS split FROM policies),
tr AS (SELECT * FROM sp WHERE split = 'train'),
st AS (SELECT is_claim AS y, count(*) AS n, {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) AS v_{c}' for c in NB_COLUMNS)}
       FROM tr GROUP BY 1),
eps AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in NB_COLUMNS)}) AS e FROM tr),
tot AS (SELECT sum(n) AS nt FROM st),
jl AS (SELECT t.policy_id, s.y,
              ln(s.n / tot.nt) {' '.join(f"- 0.5 * ln(2 * pi() * (v_{c} + e)) - (t.{c} - m_{c}) * (t.{c} - m_{c}) / (2 * (v_{c} + e))" for c in NB_COLUMNS)} AS j
       FROM sp t, st s, eps, tot WHERE t.split = 'test'),
jw AS (SELECT policy_id, max(j) FILTER (WHERE y = 0) AS j0, max(j) FILTER (WHERE y = 1) AS j1 FROM jl GROUP BY 1)
"""
oracle("gaussian_nb", _NB_SPLIT + f"SELECT policy_id, CAST(j1 > j0 AS INTEGER) AS pred, {S('1.0 / (1.0 + exp(j0 - j1))')} AS score FROM jw")

_EMB = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"""
oracle("knn_join", _EMB + f"""
, d AS (SELECT a.vec_id, b.vec_id AS nn_id, list_distance(a.v, b.v) AS dist
        FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, nn_id, {S('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nn_id) AS rank FROM d)
WHERE rank <= 5""", policies=False)
_EH = hash_hex_sql("vec_id", 17)
oracle("knn_vote", _EMB + f"""
, sp AS (SELECT *, row_number() OVER (ORDER BY {_EH}, vec_id) - 1 < ceil(0.3 * count(*) OVER ()) AS is_test FROM e),
d AS (SELECT q.vec_id, r.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, r.v), r.vec_id) AS rk
      FROM sp q JOIN sp r ON q.is_test AND NOT r.is_test),
votes AS (SELECT vec_id, label, count(*) AS c FROM d WHERE rk <= 5 GROUP BY 1, 2)
SELECT vec_id, label AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, label) AS o FROM votes) WHERE o = 1""",
       policies=False)
oracle("voting_combine", _SCORED + f"""
, b AS (SELECT policy_id, label, score AS s0, {uniform_hash_sql('policy_id', 11)} AS s1,
               {uniform_hash_sql('policy_id', 13)} AS s2 FROM scored)
SELECT policy_id, label,
       CAST((CAST(s0 >= 0.5 AS INTEGER) + CAST(s1 >= 0.5 AS INTEGER) + CAST(s2 >= 0.5 AS INTEGER)) * 2 > 3 AS INTEGER) AS hard,
       CAST((s0 + s1 + s2) / 3 >= 0.5 AS INTEGER) AS soft, {S('(s0 + s1 + s2) / 3')} AS soft_score
FROM b""")

oracle("select_columns", "SELECT " + cols_sql(POLICY_COLUMNS[::2]) + " FROM policies")
ORACLES["write_results"] = ORACLES["binary_metrics"]


def _smote_sql(seed: int = 17, k: int = 5) -> str:
    cols = SMOTE_COLUMNS
    x = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE)" if c in ("qty", "price", "disc") else f"CAST({c} AS DOUBLE)" for c in cols)
    u = lambda s: uniform_hash_sql("tag", s)
    points = ", ".join(f"{S(f'a[{i}] + u * (b[{i}] - a[{i}])')} AS {c}" for i, c in enumerate(cols, 1))
    return f"""
, n AS (SELECT count(*) FILTER (WHERE is_claim = 1) AS few,
               count(*) FILTER (WHERE is_claim = 0) - count(*) FILTER (WHERE is_claim = 1) AS made
        FROM policies),
few AS (SELECT policy_id AS id, [{x}] AS v,
               row_number() OVER (ORDER BY {hash_hex_sql('policy_id', seed)}) - 1 AS r
        FROM policies WHERE is_claim = 1),
near AS (SELECT * FROM (
           SELECT p.id, q.v AS b, row_number() OVER (PARTITION BY p.id ORDER BY list_distance(p.v, q.v), q.id) AS rank
           FROM few p JOIN few q ON p.id <> q.id) WHERE rank <= {k}),
tags AS (SELECT id, v AS a, j, id || '#' || CAST(j AS VARCHAR) AS tag,
                id || '_syn' || CAST(j AS VARCHAR) AS made_id
         FROM few, n, LATERAL (SELECT unnest(range(n.made // n.few + CAST(r < n.made % n.few AS BIGINT))) AS j)),
draws AS (SELECT *, floor({u(seed)} * {k}) + 1 AS rank, {u(seed + 1)} AS u FROM tags)
SELECT made_id AS policy_id, 1 AS is_claim, {points} FROM draws JOIN near USING (id, rank)"""


oracle("smote", _smote_sql())

# --- certificates: the size of the training set, and that every flag holds ------------

from riskframe.plans.queries import GRID_C  # noqa: E402

_TRAIN = f"""
, sp AS (SELECT is_claim, row_number() OVER (ORDER BY {_H}, policy_id) - 1 < ceil(0.3 * count(*) OVER ()) AS is_test FROM policies),
tr AS (SELECT count(*) AS n_rows, CAST(sum(is_claim) AS BIGINT) AS n_positive FROM sp WHERE NOT is_test)
"""
for _name in ("logistic", "logistic_balanced", "logistic_poly", "logistic_interactions"):
    oracle(f"certify_{_name}", f"{_TRAIN} SELECT '{_name}' AS model, n_rows, n_positive, true AS optimal, true AS beats_constant FROM tr")
_MODELS = ", ".join(f"('{kind} C={c}')" for kind in ("plain", "balanced") for c in GRID_C)
oracle("certify_logistic_grid", f"{_TRAIN} SELECT model, n_rows, n_positive, true AS optimal, true AS beats_constant "
                                f"FROM tr, (VALUES {_MODELS}) AS m(model)")

# --- resampling inside folds, and the neighbour grid ------------------------------------

from riskframe.plans.queries import KNN_GRID  # noqa: E402


def _folds_sql(key: str, label: str, table: str) -> str:
    return (f"SELECT *, CAST((row_number() OVER (PARTITION BY {label} ORDER BY {hash_hex_sql(key, 17)}, {key}) - 1) * 5 "
            f"// count(*) OVER (PARTITION BY {label}) AS INTEGER) AS fold FROM {table}")


def _smote_folds_sql(seed: int = 17, k: int = 5) -> str:
    x = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE)" if c in ("qty", "price", "disc") else f"CAST({c} AS DOUBLE)" for c in SMOTE_COLUMNS)
    points = ", ".join(f"{S(f'a[{i}] + u * (b[{i}] - a[{i}])')} AS {c}" for i, c in enumerate(SMOTE_COLUMNS, 1))
    draw = {s: uniform_hash_sql("tag", s) for s in (seed, seed + 1)}
    return f"""
, folded AS ({_folds_sql("policy_id", "is_claim", "policies")}),
held AS (SELECT CAST(unnest(range(5)) AS INTEGER) AS excluded),
few AS (SELECT excluded, policy_id AS id, [{x}] AS v,
               row_number() OVER (PARTITION BY excluded ORDER BY {hash_hex_sql('policy_id', seed)}) - 1 AS r
        FROM folded JOIN held ON fold <> excluded WHERE is_claim = 1),
n AS (SELECT excluded, count(*) FILTER (WHERE is_claim = 1) AS few,
             count(*) FILTER (WHERE is_claim = 0) - count(*) FILTER (WHERE is_claim = 1) AS made
      FROM folded JOIN held ON fold <> excluded GROUP BY excluded),
near AS (SELECT * FROM (
           SELECT p.excluded, p.id, q.v AS b,
                  row_number() OVER (PARTITION BY p.excluded, p.id ORDER BY list_distance(p.v, q.v), q.id) AS rank
           FROM few p JOIN few q ON p.excluded = q.excluded AND p.id <> q.id) WHERE rank <= {k}),
tags AS (SELECT few.excluded, id, v AS a, id || '#' || CAST(j AS VARCHAR) AS tag, id || '_syn' || CAST(j AS VARCHAR) AS made_id
         FROM few JOIN n USING (excluded), LATERAL (SELECT unnest(range(n.made // n.few + CAST(r < n.made % n.few AS BIGINT))) AS j)),
draws AS (SELECT *, floor({draw[seed]} * {k}) + 1 AS rank, {draw[seed + 1]} AS u FROM tags)
SELECT excluded, made_id AS policy_id, 1 AS is_claim, {points} FROM draws JOIN near USING (excluded, id, rank)"""


oracle("smote_in_folds", _smote_folds_sql())

_ks, _kinds, _metrics = KNN_GRID
_MEASURES = {"euclidean": "list_distance(q.v, r.v)",
             "manhattan": "list_sum(list_transform(list_zip(q.v, r.v), lambda p: abs(p[1] - p[2])))"}
oracle("knn_grid", _EMB + f"""
, f AS ({_folds_sql("vec_id", "label", "e")}),
""" + ",\n".join(f"""d_{m} AS (SELECT q.vec_id, q.fold, q.label AS truth, r.label AS vote, r.vec_id AS nn, {_MEASURES[m]} AS dist
 FROM f q JOIN f r ON q.fold <> r.fold)""" for m in _metrics) + f""",
d AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, * FROM d_{m}" for m in _metrics)}),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY metric, vec_id ORDER BY dist, nn) AS rank FROM d) WHERE rank <= {max(_ks)}),
cand AS (SELECT near.*, k, kind FROM near JOIN (SELECT unnest({_ks}) AS k) ON rank <= k, (SELECT unnest({_kinds}) AS kind)),
w AS (SELECT *, CASE WHEN kind = 'uniform' THEN 1.0 WHEN max(dist = 0) OVER (PARTITION BY metric, kind, k, vec_id) THEN CAST(dist = 0 AS DOUBLE)
              ELSE 1.0 / dist END AS w FROM cand),
s AS (SELECT metric, kind, k, vec_id, fold, truth, vote, sum(w) AS s FROM w GROUP BY ALL),
b AS (SELECT metric, kind, k, fold, truth, CAST(vote = truth AS INTEGER) AS hit FROM (
        SELECT *, row_number() OVER (PARTITION BY metric, kind, k, vec_id ORDER BY s DESC, vote) AS o FROM s) WHERE o = 1),
c AS (SELECT metric, kind, k, fold, truth, count(*) AS n, sum(hit) AS hits FROM b GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS k, kind AS weights, metric, fold, CAST(sum(n) AS BIGINT) AS n, {S('sum(hits) / sum(n)')} AS accuracy,
       {S('avg(hits / n)')} AS recall
FROM c GROUP BY metric, kind, k, fold""", policies=False)

# --- curves of many models ------------------------------------------------------------

from riskframe.plans.queries import N_MODELS  # noqa: E402

_CURVES = f"""
, s AS ({" UNION ALL ".join(
    f"SELECT 'm{i}' AS model, is_claim AS label, (floor({uniform_hash_sql('policy_id', 20 + i)} * {40 * (i + 1)}) + is_claim * {i * 5}) / {40 * (i + 1) + 40} AS score FROM policies"
    for i in range(N_MODELS))}),
per AS (SELECT model, score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM s GROUP BY ALL),
cum AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
               sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
        FROM per WINDOW w AS (PARTITION BY model ORDER BY threshold DESC)),
c AS (SELECT *, cum_neg / n AS fpr, cum_pos / p AS tpr, cum_pos / (cum_pos + cum_neg) AS precision, cum_pos / p AS recall FROM cum),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM c)
"""
oracle("model_curves", _CURVES + f"""SELECT model, {S('threshold')} AS threshold, pos, neg, cum_pos, cum_neg, {S('fpr')} AS fpr, {S('tpr')} AS tpr,
  {S('precision')} AS precision, {S('recall')} AS recall FROM c""")
oracle("curve_summary", _CURVES + f"""
, g AS (SELECT model, sum(neg * (cum_pos - pos / 2.0)) / (max(p) * max(n)) AS auc, sum(pos * precision) / max(p) AS ap,
               arg_max(threshold, {{'f': f1, 't': threshold}}) AS bt, max(f1) AS bf,
               coalesce(max(threshold) FILTER (WHERE recall >= 0.7), 0.5) AS tt FROM f GROUP BY model)
SELECT model, {S('auc')} AS auc, {S('ap')} AS average_precision, {S('bt')} AS best_threshold, {S('bf')} AS best_f1, {S('tt')} AS target_threshold FROM g""")

# --- strict reading, and what was scored out of fold ---------------------------------------

oracle("attach_bounds", f"""
, b AS (SELECT area_cluster, avg(price) AS m, max(price) AS x FROM policies GROUP BY 1)
SELECT area_cluster, policy_id, {S('price')} AS price, {S('m')} AS mean_price, {S('x')} AS max_price
FROM policies LEFT JOIN b USING (area_cluster)""")
oracle("if_column", "SELECT policy_id, is_claim, segment, n_lines, CAST(n_lines >= 4 AS INTEGER) AS many_lines FROM policies")
oracle("read_strict", """
, p AS (SELECT n_lines, CAST(regexp_extract(policy_id, '(\\d+)', 1) AS BIGINT) % 7 = 0 AS bad FROM policies)
SELECT 'rows' AS part, count(*) FILTER (WHERE NOT bad) AS n, CAST(sum(n_lines) FILTER (WHERE NOT bad) AS BIGINT) AS n_lines FROM p
UNION ALL SELECT 'rejected', count(*) FILTER (WHERE bad), count(*) FILTER (WHERE bad) FROM p""")
oracle("oof_scores", f"""
, sp AS (SELECT policy_id, is_claim, row_number() OVER (ORDER BY {_H}, policy_id) - 1 < ceil(0.3 * count(*) OVER ()) AS is_test FROM policies),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY is_claim ORDER BY {_H}, policy_id) - 1) * 3
              // count(*) OVER (PARTITION BY is_claim) AS INTEGER) AS fold FROM sp WHERE NOT is_test)
SELECT model, fold, count(*) AS n, CAST(sum(is_claim) AS BIGINT) AS n_positive, count(*) AS n_keys, CAST(0 AS BIGINT) AS n_missing
FROM f, (VALUES ('logistic'), ('tree'), ('nb')) AS m(model) GROUP BY model, fold""")
