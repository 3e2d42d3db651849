"""DuckDB oracle SQL for each checked query (same column names as the Spark side)."""

from __future__ import annotations

from paysight.functions.stopwords import ENGLISH_STOP_WORDS
from paysight.plans.oracle_base import (FEATURES, POSTINGS, RAW7, REQUESTS, SALARIED, SPLIT,
                                        STAR, STAR_COLUMNS, with_ctes)

P = with_ctes(POSTINGS)
S = with_ctes(POSTINGS, SALARIED)
FT = with_ctes(POSTINGS, SALARIED, FEATURES)

RAW7_COLUMNS = ["salary_year_avg", "job_skills", "job_title_short", "job_country",
                "job_schedule_type", "job_work_from_home", "salary_rate"]

# F10 select list over a parsed map column ``tmap`` (mirrors the FEATURES block).
F10_SELECT = """
    CAST(coalesce(len(tmap['programming']), 0) AS BIGINT) AS cat_programming,
    CAST(coalesce(len(tmap['databases']), 0) AS BIGINT) AS cat_databases,
    CAST(coalesce(len(tmap['cloud']), 0) AS BIGINT) AS cat_cloud,
    CAST(coalesce(len(tmap['libraries']), 0) AS BIGINT) AS cat_libraries,
    CAST(coalesce(len(tmap['analyst_tools']), 0) AS BIGINT) AS cat_analyst_tools,
    CAST(coalesce(len(tmap['webframeworks']), 0) AS BIGINT) AS cat_webframeworks,
    CAST(coalesce(len(tmap['other']), 0) + coalesce(list_sum(list_transform(list_filter(
      map_entries(tmap), lambda e, i: i > coalesce(list_position(map_keys(tmap), 'other'), 0)
        AND e.key NOT IN ('programming', 'databases', 'cloud', 'libraries', 'analyst_tools',
                          'webframeworks', 'other')), lambda e: len(e.value))), 0) AS BIGINT) AS cat_other,
    CAST(coalesce(len(list_filter(map_values(tmap), lambda v: len(v) > 0)), 0) AS BIGINT)
      AS n_skill_categories"""


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 "
             f"AS missing_pct FROM raw7" for c in RAW7_COLUMNS]
    return (with_ctes(POSTINGS, RAW7) + "SELECT column_name, round(missing_pct, 6) AS missing_pct FROM ("
            + " UNION ALL ".join(parts) + ") WHERE missing_pct > 0")


def _hist_sql(expr: str, series: str, bins: int = 60) -> str:
    return f"""(WITH vals AS (SELECT CAST({expr} AS DOUBLE) AS v FROM salaried_eda),
  st AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
  binned AS (SELECT CASE WHEN hi = lo THEN 0 ELSE
      least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) END AS bin,
      count(*) AS n FROM vals, st GROUP BY 1)
  SELECT '{series}' AS series, g.range AS bin,
    round(lo + g.range * ((hi - lo) / {bins}), 6) AS bin_lo,
    round(lo + (g.range + 1) * ((hi - lo) / {bins}), 6) AS bin_hi,
    coalesce(n, 0) AS n
  FROM range({bins}) g, st LEFT JOIN binned b ON b.bin = g.range)"""


def _kde_sql(expr: str, series: str, fine: int = 1024, grid: int = 200, cut: float = 0.0) -> str:
    return f"""(WITH vals AS (SELECT CAST({expr} AS DOUBLE) AS v FROM salaried_eda),
  st AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS n,
         stddev_samp(v) * pow(CAST(count(v) AS DOUBLE), -0.2) AS h FROM vals),
  centres AS (SELECT b, count(*) AS w FROM (SELECT CASE WHEN hi = lo THEN 0 ELSE
      least(CAST(floor((v - lo) / (hi - lo) * {fine}) AS BIGINT), {fine - 1}) END AS b
      FROM vals, st) GROUP BY b),
  c2 AS (SELECT b, w, lo + (b + 0.5) * ((hi - lo) / {fine}) AS c, lo, hi, n, h
         FROM centres, st),
  contrib AS (SELECT g.range AS point, lo - {cut} * h AS g0,
      (hi - lo + 2 * {cut} * h) / {grid - 1} AS step, n, h,
      w * exp(-0.5 * pow(((lo - {cut} * h + g.range * ((hi - lo + 2 * {cut} * h) / {grid - 1}))
          - c) / h, 2)) AS k
      FROM c2, range({grid}) g)
  SELECT '{series}' AS series, point, round(g0 + point * step, 4) AS x,
    round(sum(k) / (n * h * sqrt(2 * pi())) * 1e6, 6) AS density_e6
  FROM contrib GROUP BY point, g0, step, n, h)"""


def _top_sql(col: str) -> str:
    return f"""(SELECT '{col}' AS dimension, {col} AS category,
  quantile_cont(salary_year_avg, 0.5) AS median_target, count(*) AS n
  FROM salaried_eda WHERE {col} IS NOT NULL GROUP BY {col}
  ORDER BY median_target DESC, category LIMIT 12)"""


ORACLE = {
    "postings_view": P + "SELECT * FROM postings",
    "s2_pruned_scan": P + f"SELECT {', '.join(RAW7_COLUMNS)} FROM postings",
    "c1_usable_target": P + """
SELECT posting_id, 'year' AS rate, salary_year_avg AS target FROM postings
WHERE salary_year_avg IS NOT NULL AND salary_year_avg > 0
UNION ALL
SELECT posting_id, 'hour' AS rate, salary_hour_avg AS target FROM postings
WHERE salary_hour_avg IS NOT NULL AND salary_hour_avg > 0""",
    "c2_cap_target": S + """
SELECT posting_id, salary_year_avg FROM salaried
WHERE salary_year_avg BETWEEN 15000 AND 400000""",
    "c3_floor_target": S + "SELECT posting_id, salary_year_avg FROM salaried_eda",
    "c6_feature_frame": FT + "SELECT * FROM features",
    "c7_member_filter": S + """
SELECT posting_id, job_country FROM salaried_eda
WHERE job_country IN (SELECT job_country FROM salaried_eda WHERE job_country IS NOT NULL
  GROUP BY job_country ORDER BY quantile_cont(salary_year_avg, 0.5) DESC, job_country LIMIT 12)""",
    "c8_category_codes": P + """
SELECT posting_id,
  CAST(CASE WHEN lower(job_work_from_home) IN ('true', 't', '1') THEN 1
       WHEN lower(job_work_from_home) IN ('false', 'f', '0') THEN 0 ELSE -1 END AS BIGINT)
    AS remote_code,
  CAST(CASE WHEN job_schedule_type IS NULL THEN -1
       ELSE dense_rank() OVER (ORDER BY job_schedule_type) - 1 END AS BIGINT) AS schedule_code
FROM postings""",
    "c9_min_support": P + """
SELECT company_name, count(*) AS n_postings FROM postings GROUP BY company_name
HAVING count(*) >= 10""",
    "f1_parse_skills": P + """
SELECT posting_id,
  array_to_string(sl, ' ') AS skills_text, CAST(len(sl) AS BIGINT) AS n_skills
FROM (SELECT posting_id, coalesce(list_transform(
        CAST(json(replace(job_skills, '''', '"')) AS VARCHAR[]), lambda x: lower(trim(x))),
        []::VARCHAR[]) AS sl FROM postings)""",
    "f4_parse_date": P + """
SELECT posting_id, strftime(try_strptime(job_posted_date, '%Y-%m-%d'), '%Y-%m-%d %H:%M:%S')
  AS posted_ts FROM postings""",
    "f10_skill_categories": P + "SELECT posting_id," + F10_SELECT + """
FROM (SELECT posting_id,
  CAST(json(replace(job_type_skills, '''', '"')) AS MAP(VARCHAR, VARCHAR[])) AS tmap
  FROM postings)""",
    "f11_log_target": S + """
SELECT posting_id, round(ln(1 + salary_year_avg), 9) AS y_log,
  round(exp(ln(1 + salary_year_avg)) - 1, 4) AS y_back
FROM salaried WHERE salary_year_avg BETWEEN 15000 AND 400000""",
    "f18_item_sets": S + "SELECT DISTINCT posting_id, unnest(skills_list) AS item FROM salaried",
    "a1_describe": S + """
SELECT count(salary_year_avg) AS count, round(avg(salary_year_avg), 0) AS mean,
  round(stddev_samp(salary_year_avg), 0) AS std, round(min(salary_year_avg), 0) AS min,
  round(quantile_cont(salary_year_avg, 0.05), 0) AS p5,
  round(quantile_cont(salary_year_avg, 0.25), 0) AS p25,
  round(quantile_cont(salary_year_avg, 0.5), 0) AS p50,
  round(quantile_cont(salary_year_avg, 0.75), 0) AS p75,
  round(quantile_cont(salary_year_avg, 0.95), 0) AS p95,
  round(max(salary_year_avg), 0) AS max
FROM salaried_eda""",
    "a2_row_counts": P + """
SELECT (SELECT count(*) FROM postings) AS n_raw,
  (SELECT count(*) FROM postings WHERE salary_year_avg IS NOT NULL AND salary_year_avg > 0)
    AS n_usable""",
    "a3_missing_pct": _missing_sql(),
    "a4_target_coverage": S + """
SELECT round((SELECT avg(CASE WHEN salary_year_avg IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100
              FROM postings), 6) AS pct_with_target,
  round(avg(len(skills_list)), 6) AS mean_items,
  round(avg(CASE WHEN len(skills_list) > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_with_items
FROM salaried_eda""",
    "a5_skew": S + """
SELECT round(skewness(salary_year_avg), 6) AS skew_raw,
  round(skewness(ln(1 + salary_year_avg)), 6) AS skew_log FROM salaried_eda""",
    "a6_histograms": S + _hist_sql("salary_year_avg", "target") + " UNION ALL "
    + _hist_sql("ln(1 + salary_year_avg)", "log_target"),
    "a7_kde": S + _kde_sql("salary_year_avg", "target") + " UNION ALL "
    + _kde_sql("ln(1 + salary_year_avg)", "log_target"),
    "a8_top_categories": S + " UNION ALL ".join(
        _top_sql(c) for c in ["job_title_short", "job_country", "job_schedule_type"]),
    "a9_box_stats": S + """,
tops AS (SELECT job_country AS category FROM salaried_eda WHERE job_country IS NOT NULL
  GROUP BY 1 ORDER BY quantile_cont(salary_year_avg, 0.5) DESC, 1 LIMIT 12),
rws AS (SELECT job_country AS category, salary_year_avg AS y FROM salaried_eda
  WHERE job_country IN (SELECT category FROM tops)),
q AS (SELECT category, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median,
  quantile_cont(y, 0.75) AS q3 FROM rws GROUP BY category)
SELECT q.category, q1, median, q3,
  min(CASE WHEN y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN y END) AS whisker_lo,
  max(CASE WHEN y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN y END) AS whisker_hi,
  count(*) AS n
FROM rws JOIN q ON rws.category = q.category GROUP BY q.category, q1, median, q3""",
    "a10_remote_gap": S + """
SELECT n_groups, median_yes, median_no,
  CASE WHEN n_groups = 2 THEN median_yes - median_no END AS median_gap
FROM (SELECT count(DISTINCT job_work_from_home) AS n_groups,
  quantile_cont(CASE WHEN job_work_from_home = 'True' THEN salary_year_avg END, 0.5) AS median_yes,
  quantile_cont(CASE WHEN job_work_from_home = 'False' THEN salary_year_avg END, 0.5) AS median_no
  FROM salaried_eda)""",
    "a11_item_frequency": S + """
SELECT item, count(*) AS n_postings
FROM (SELECT DISTINCT posting_id, unnest(skills_list) AS item FROM salaried_eda)
GROUP BY item ORDER BY n_postings DESC, item LIMIT 25""",
    "a12_highest_paying_items": S + """
SELECT item, count(*) AS n_postings, quantile_cont(salary_year_avg, 0.5) AS median_target
FROM (SELECT DISTINCT posting_id, unnest(skills_list) AS item, salary_year_avg FROM salaried_eda)
GROUP BY item HAVING count(*) >= 100
ORDER BY median_target DESC, item LIMIT 20""",
    "a13_correlation": S + """,
v AS (SELECT salary_year_avg AS a1, CAST(len(skills_list) AS DOUBLE) AS a2,
  CAST(CASE WHEN lower(job_work_from_home) IN ('true', 't', '1') THEN 1
       WHEN lower(job_work_from_home) IN ('false', 'f', '0') THEN 0 ELSE -1 END AS DOUBLE) AS a3
  FROM salaried_eda),
c AS (SELECT corr(a1, a2) AS c12, corr(a1, a3) AS c13, corr(a2, a3) AS c23 FROM v)
SELECT col_a, col_b, round(r, 9) AS r FROM (
  SELECT 'salary_year_avg' AS col_a, 'salary_year_avg' AS col_b, 1.0 AS r
  UNION ALL SELECT 'salary_year_avg', 'n_skills', c12 FROM c
  UNION ALL SELECT 'salary_year_avg', 'remote', c13 FROM c
  UNION ALL SELECT 'n_skills', 'salary_year_avg', c12 FROM c
  UNION ALL SELECT 'n_skills', 'n_skills', 1.0
  UNION ALL SELECT 'n_skills', 'remote', c23 FROM c
  UNION ALL SELECT 'remote', 'salary_year_avg', c13 FROM c
  UNION ALL SELECT 'remote', 'n_skills', c23 FROM c
  UNION ALL SELECT 'remote', 'remote', 1.0)""",
}


# ---------------------------------------------------------------- warehouse

W = with_ctes(STAR)
SP = with_ctes(POSTINGS, SALARIED, FEATURES, SPLIT)
NUMERIC = ["n_skills", "title_len", "title_word_count", "remote_flag", "no_degree_flag",
           "health_flag", "seniority_score", "posted_month", "cat_programming",
           "cat_databases", "cat_cloud", "cat_libraries", "cat_analyst_tools",
           "cat_webframeworks", "cat_other", "n_skill_categories"]
FK_PAIRS = [("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("lineitem", "l_partkey", "supplier", "s_suppkey")]


def _catalogue_sql() -> str:
    parts = []
    for t, cols in STAR_COLUMNS.items():
        for i, (c, ty) in enumerate(cols, 1):
            num = ty in ("bigint", "int", "double")
            mn = f"round(CAST(min({c}) AS DOUBLE), 4)" if num else "CAST(NULL AS DOUBLE)"
            mx = f"round(CAST(max({c}) AS DOUBLE), 4)" if num else "CAST(NULL AS DOUBLE)"
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{ty}' AS data_type, "
                f"true AS nullable, CAST({i} AS BIGINT) AS ordinal, "
                f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS null_pct, "
                f"count(DISTINCT {c}) AS n_distinct, {mn} AS min_value, {mx} AS max_value "
                f"FROM {t}")
    return W + " UNION ALL ".join(parts)


def _inclusion_sql() -> str:
    parts = []
    for c, cc, p, pc in FK_PAIRS:
        parts.append(
            f"SELECT '{c}.{cc}' AS child, '{p}.{pc}' AS parent, "
            f"count(*) AS n_child_values, "
            f"count(*) FILTER (WHERE v NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)) "
            f"AS n_orphans FROM (SELECT DISTINCT {cc} AS v FROM {c} WHERE {cc} IS NOT NULL)")
    return ("SELECT child, parent, n_child_values, n_orphans, "
            "round(CASE WHEN n_child_values > 0 THEN 100.0 * (n_child_values - n_orphans) "
            "/ n_child_values END, 6) AS coverage_pct FROM ("
            + " UNION ALL ".join(parts) + ")")


def _te_sql(cols: list[str]) -> str:
    """Brute-force cross-fitted encoding: statistics of the other folds by a join
    on fold <> own fold (independent of the subtraction the Spark side uses)."""
    ctes = ["""tr AS (SELECT *, ln(1 + salary_year_avg) AS y,
    CAST('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '-42'), 1, 15) AS BIGINT) % 5 AS fold
    FROM split_rows WHERE split = 'train')""",
            "folds AS (SELECT DISTINCT fold FROM tr)",
            """g AS (SELECT f.fold, avg(t.y) AS gmean, var_pop(t.y) AS gvar
    FROM folds f JOIN tr t ON t.fold <> f.fold GROUP BY f.fold)""",
            "ga AS (SELECT avg(y) AS gmean, var_pop(y) AS gvar FROM tr)"]
    sel_tr, sel_rest, joins_tr, joins_rest = [], [], [], []
    for i, c in enumerate(cols):
        ctes.append(f"""c{i} AS (SELECT f.fold, t.{c} AS cat, count(*) AS n, avg(t.y) AS m,
    var_pop(t.y) AS v FROM folds f JOIN tr t ON t.fold <> f.fold GROUP BY f.fold, t.{c})""")
        ctes.append(f"""a{i} AS (SELECT {c} AS cat, count(*) AS n, avg(y) AS m, var_pop(y) AS v
    FROM tr GROUP BY {c})""")
        enc = ("CASE WHEN {a}.n IS NULL THEN {g}.gmean ELSE "
               "({a}.n * {g}.gvar) / ({a}.n * {g}.gvar + {a}.v) * {a}.m + "
               "(1 - ({a}.n * {g}.gvar) / ({a}.n * {g}.gvar + {a}.v)) * {g}.gmean END")
        sel_tr.append(f"round({enc.format(a=f'c{i}', g='g')}, 6) AS te_{c}")
        sel_rest.append(f"round({enc.format(a=f'a{i}', g='ga')}, 6) AS te_{c}")
        joins_tr.append(f"LEFT JOIN c{i} ON c{i}.fold = tr.fold AND c{i}.cat = tr.{c}")
        joins_rest.append(f"LEFT JOIN a{i} ON a{i}.cat = s.{c}")
    q_tr = (f"SELECT tr.posting_id, tr.split, {', '.join(sel_tr)} FROM tr "
            f"JOIN g ON g.fold = tr.fold {' '.join(joins_tr)}")
    q_rest = (f"SELECT s.posting_id, s.split, {', '.join(sel_rest)} FROM split_rows s, ga "
              f"{' '.join(joins_rest)} WHERE s.split <> 'train'")
    return SP.rstrip() + ",\n" + ",\n".join(ctes) + "\n" + q_tr + " UNION ALL " + q_rest


def _tfidf_sql(terms_cte: str, id_col: str, fit_ids: str, vocab: int, min_df: int) -> str:
    return f""",
{terms_cte},
tf AS (SELECT {id_col}, term, count(*) AS tf FROM terms GROUP BY {id_col}, term),
nd AS (SELECT count(*) AS n_docs FROM ({fit_ids})),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf
  WHERE {id_col} IN ({fit_ids}) GROUP BY term),
vocab AS (SELECT term, ln((1 + n_docs) / (1 + df)) + 1 AS idf FROM st, nd
  WHERE df >= {min_df} ORDER BY cf DESC, term LIMIT {vocab}),
w AS (SELECT {id_col}, tf.term, tf * idf AS w FROM tf JOIN vocab ON tf.term = vocab.term),
nrm AS (SELECT {id_col}, sqrt(sum(w * w)) AS norm FROM w GROUP BY {id_col})
SELECT w.{id_col}, term, round(w / norm, 9) AS weight FROM w JOIN nrm ON w.{id_col} = nrm.{id_col}"""


_SW = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"


def _word_terms_cte(src: str, id_col: str, text: str) -> str:
    return f"""words AS (SELECT {id_col}, list_filter(
    regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda x: NOT list_contains({_SW}, x)) AS wl FROM {src}),
terms AS (
  SELECT {id_col}, unnest(wl) AS term FROM words
  UNION ALL
  SELECT {id_col}, unnest(list_transform(range(1, len(wl)), lambda i: wl[i] || ' ' || wl[i + 1]))
    AS term FROM words WHERE len(wl) >= 2)"""


ORACLE.update({
    "w1_w3_counts": W + """
SELECT 'salaried_year_count' AS metric, count(*) AS n FROM fact_jobs
  WHERE salary_average_year IS NOT NULL
UNION ALL SELECT 'salaried_year_positive_count', count(*) FROM fact_jobs
  WHERE salary_average_year > 0
UNION ALL SELECT 'salaried_hour_count', count(*) FROM fact_jobs
  WHERE salary_average_hour IS NOT NULL
UNION ALL SELECT 'fact_total', count(*) FROM fact_jobs
UNION ALL SELECT 'facts_with_any_skill', count(DISTINCT job_fact_id) FROM bridge_job_skills""",
    "w4_salaried_with_skill": W + """
SELECT 'not_null' AS variant, count(DISTINCT f.job_fact_id) AS n
FROM fact_jobs f JOIN bridge_job_skills b ON f.job_fact_id = b.job_fact_id
WHERE f.salary_average_year IS NOT NULL
UNION ALL
SELECT 'positive', count(DISTINCT f.job_fact_id)
FROM fact_jobs f JOIN bridge_job_skills b ON f.job_fact_id = b.job_fact_id
WHERE f.salary_average_year > 0""",
    "w5_mean_skills": W + """
SELECT 'not_null' AS variant, round(avg(CAST(cnt AS DOUBLE)), 9) AS avg_skills FROM (
  SELECT f.job_fact_id, count(b.skill_id) AS cnt FROM fact_jobs f
  JOIN bridge_job_skills b ON f.job_fact_id = b.job_fact_id
  WHERE f.salary_average_year IS NOT NULL GROUP BY f.job_fact_id) t
UNION ALL
SELECT 'positive', round(avg(CAST(cnt AS DOUBLE)), 9) FROM (
  SELECT f.job_fact_id, count(b.skill_id) AS cnt FROM fact_jobs f
  JOIN bridge_job_skills b ON f.job_fact_id = b.job_fact_id
  WHERE f.salary_average_year > 0 GROUP BY f.job_fact_id) t""",
    "w6_titles": W + """
SELECT j.job_title_short, count(*) AS n, round(avg(f.salary_average_year), 4) AS avg_salary
FROM fact_jobs f JOIN dim_job j ON f.job_id = j.job_id
WHERE f.salary_average_year IS NOT NULL
GROUP BY j.job_title_short ORDER BY n DESC, j.job_title_short LIMIT 15""",
    "w7_table_counts": W + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR_COLUMNS),
    "w8_column_catalogue": _catalogue_sql(),
    "w9_inclusion": _inclusion_sql(),
    "w10_audit": W + """,
a AS (SELECT count(*) AS n_facts,
  count(*) FILTER (WHERE salary_average_year = 0) AS n_zero_salary,
  count(*) FILTER (WHERE salary_average_year IS NULL) AS n_null_salary,
  count(*) FILTER (WHERE job_fact_id IN (SELECT job_fact_id FROM bridge_job_skills))
    AS n_facts_with_bridge,
  count(DISTINCT job_id) AS n_job_keys_used,
  (SELECT count(*) FROM dim_job) AS n_job_keys FROM fact_jobs)
SELECT n_facts, n_zero_salary, n_null_salary, n_facts_with_bridge,
  round(100.0 * n_facts_with_bridge / n_facts, 6) AS pct_facts_with_bridge,
  n_job_keys_used, n_job_keys, round(100.0 * n_job_keys_used / n_job_keys, 6) AS pct_job_keys_used
FROM a""",
    "p1_split": SP + "SELECT posting_id, split FROM split_rows",
    "p2_hash_folds": S + """
SELECT posting_id,
  CAST('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '-42'), 1, 15) AS BIGINT) % 5 AS fold
FROM salaried WHERE salary_year_avg BETWEEN 15000 AND 400000""",
    "p3_ordered_folds": S + """,
r AS (SELECT posting_id, row_number() OVER (ORDER BY posting_id) - 1 AS pos,
  count(*) OVER () AS n FROM salaried WHERE salary_year_avg BETWEEN 15000 AND 400000),
k AS (SELECT *, n // 5 + 1 AS big, n // 5 AS small, n % 5 AS n_big FROM r)
SELECT posting_id, CAST(CASE WHEN pos < big * n_big THEN pos // big
  ELSE n_big + (pos - big * n_big) // small END AS BIGINT) AS fold FROM k""",
    "p4_sample": S + """
SELECT posting_id FROM salaried WHERE salary_year_avg BETWEEN 15000 AND 400000
ORDER BY CAST('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '-42'), 1, 15) AS BIGINT),
  posting_id LIMIT 1000""",
    "v1_baseline_metrics": SP + """,
means AS (SELECT job_title_short, avg(salary_year_avg) AS pred FROM split_rows
  WHERE split = 'train' GROUP BY job_title_short),
gm AS (SELECT avg(salary_year_avg) AS g FROM split_rows WHERE split = 'train'),
scored AS (SELECT s.salary_year_avg AS y, coalesce(m.pred, gm.g) AS pred
  FROM split_rows s LEFT JOIN means m ON s.job_title_short = m.job_title_short, gm
  WHERE s.split = 'val')
SELECT count(*) AS n, round(avg(abs(y - pred)), 6) AS MAE,
  round(sqrt(avg((y - pred) * (y - pred))), 6) AS RMSE,
  round(1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)), 6) AS R2,
  round(avg(abs((y - pred) / y)) * 100, 6) AS MAPE
FROM scored""",
    "t1_standardize": SP + ",\nst AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    + " FROM split_rows WHERE split = 'train')\nSELECT posting_id, " + ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, 9) AS {c}"
        for c in NUMERIC) + " FROM split_rows, st",
    "t2_rare_bucket": SP + """,
cnt AS (SELECT company_name, count(*) AS n FROM split_rows WHERE split = 'train'
  GROUP BY company_name)
SELECT s.posting_id, s.split,
  CASE WHEN c.n IS NULL THEN NULL WHEN c.n >= 10 THEN s.company_name ELSE '__infrequent__' END
    AS company_slot
FROM split_rows s LEFT JOIN cnt c ON s.company_name = c.company_name""",
    "t3_target_encoding": _te_sql(["job_country", "company_name", "job_location"]),
    "t4_skills_tfidf": SP + _tfidf_sql(
        "terms AS (SELECT posting_id, unnest(regexp_extract_all(lower(skills_text), '[^\\s]+')) "
        "AS term FROM split_rows)",
        "posting_id", "SELECT posting_id FROM split_rows WHERE split = 'train'", 3000, 1),
    "t5_title_tfidf": SP + _tfidf_sql(
        _word_terms_cte("split_rows", "posting_id", "job_title"),
        "posting_id", "SELECT posting_id FROM split_rows WHERE split = 'train'", 1500, 5),
    "t5_document_tfidf": "WITH docs AS (SELECT doc_id, text FROM documents)" + _tfidf_sql(
        _word_terms_cte("docs", "doc_id", "text"), "doc_id", "SELECT doc_id FROM docs",
        1500, 5),
})


# ---------------------------------------------------------------- files, requests, evaluation

RQ = with_ctes(POSTINGS, REQUESTS)

_VAL_BASE = """,
tr_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
val_rows AS (SELECT * FROM split_rows WHERE split = 'val'),
gmean AS (SELECT avg(salary_year_avg) AS g FROM tr_rows),
title_means AS (SELECT job_title_short, avg(salary_year_avg) AS m FROM tr_rows
  GROUP BY job_title_short),
country_means AS (SELECT job_country, avg(salary_year_avg) AS m FROM tr_rows
  GROUP BY job_country),
scored AS (
  SELECT 'global_mean' AS model, v.posting_id, v.salary_year_avg AS y, gmean.g AS pred
    FROM val_rows v, gmean
  UNION ALL
  SELECT 'title_mean', v.posting_id, v.salary_year_avg, coalesce(t.m, gmean.g)
    FROM val_rows v LEFT JOIN title_means t ON v.job_title_short = t.job_title_short, gmean
  UNION ALL
  SELECT 'country_mean', v.posting_id, v.salary_year_avg, coalesce(c.m, gmean.g)
    FROM val_rows v LEFT JOIN country_means c ON v.job_country = c.job_country, gmean),
metrics AS (
  SELECT model, count(*) AS n, avg(abs(y - pred)) AS MAE, sqrt(avg((y - pred) * (y - pred))) AS RMSE,
    1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)) AS R2,
    avg(abs((y - pred) / y)) * 100 AS MAPE
  FROM scored GROUP BY model)"""

_INTERVAL = """,
tr_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
gq AS (SELECT quantile_cont(salary_year_avg, 0.05) AS lo, quantile_cont(salary_year_avg, 0.95) AS hi
  FROM tr_rows),
tq AS (SELECT job_title_short, quantile_cont(salary_year_avg, 0.05) AS lo,
  quantile_cont(salary_year_avg, 0.95) AS hi FROM tr_rows GROUP BY job_title_short),
iv AS (SELECT s.posting_id, s.salary_year_avg, coalesce(tq.lo, gq.lo) AS lower_raw,
  coalesce(tq.hi, gq.hi) AS upper_raw
  FROM split_rows s LEFT JOIN tq ON s.job_title_short = tq.job_title_short, gq
  WHERE s.split = 'test')"""


def _cv_sql() -> str:
    base = with_ctes(POSTINGS, SALARIED, FEATURES) + """,
fr AS (SELECT *, CAST('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '-42'), 1, 15) AS BIGINT)
  % 5 AS fold FROM features),
folds AS (SELECT DISTINCT fold FROM fr),
og AS (SELECT f.fold, avg(t.salary_year_avg) AS g FROM folds f JOIN fr t ON t.fold <> f.fold
  GROUP BY f.fold),
ot AS (SELECT f.fold, t.job_title_short AS k, avg(t.salary_year_avg) AS m FROM folds f
  JOIN fr t ON t.fold <> f.fold GROUP BY f.fold, t.job_title_short),
oc AS (SELECT f.fold, t.job_country AS k, avg(t.salary_year_avg) AS m FROM folds f
  JOIN fr t ON t.fold <> f.fold GROUP BY f.fold, t.job_country),
scored AS (
  SELECT 'global_mean' AS model, r.fold, r.salary_year_avg AS y, og.g AS pred
    FROM fr r JOIN og ON og.fold = r.fold
  UNION ALL
  SELECT 'title_mean', r.fold, r.salary_year_avg, coalesce(ot.m, og.g)
    FROM fr r JOIN og ON og.fold = r.fold
    LEFT JOIN ot ON ot.fold = r.fold AND ot.k = r.job_title_short
  UNION ALL
  SELECT 'country_mean', r.fold, r.salary_year_avg, coalesce(oc.m, og.g)
    FROM fr r JOIN og ON og.fold = r.fold
    LEFT JOIN oc ON oc.fold = r.fold AND oc.k = r.job_country),
fm AS (SELECT model, fold, avg(abs(y - pred)) AS MAE, sqrt(avg((y - pred) * (y - pred))) AS RMSE,
  1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)) AS R2 FROM scored GROUP BY model, fold)
SELECT model, round(avg(R2), 6) AS R2_mean, round(stddev_pop(R2), 6) AS R2_std,
  round(avg(MAE), 6) AS MAE_mean, round(avg(RMSE), 6) AS RMSE_mean
FROM fm GROUP BY model"""
    return base


ORACLE.update({
    "s1_csv_roundtrip": ORACLE["postings_view"],
    "s4_ranked_csv": ORACLE["a11_item_frequency"],
    "s5_metrics_json": ORACLE["a1_describe"],
    "v11_load_reports": f"SELECT *, 'describe' AS report FROM ({ORACLE['a1_describe']})",
    "s6_report": S + """,
d AS (SELECT count(salary_year_avg) AS count, round(avg(salary_year_avg), 0) AS mean,
  round(stddev_samp(salary_year_avg), 0) AS std, round(min(salary_year_avg), 0) AS min,
  round(quantile_cont(salary_year_avg, 0.05), 0) AS p5,
  round(quantile_cont(salary_year_avg, 0.25), 0) AS p25,
  round(quantile_cont(salary_year_avg, 0.5), 0) AS p50,
  round(quantile_cont(salary_year_avg, 0.75), 0) AS p75,
  round(quantile_cont(salary_year_avg, 0.95), 0) AS p95,
  round(max(salary_year_avg), 0) AS max,
  skewness(salary_year_avg) AS skew_raw, skewness(ln(1 + salary_year_avg)) AS skew_log,
  avg(len(skills_list)) AS mean_items,
  avg(CASE WHEN len(skills_list) > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_with_items
  FROM salaried_eda),
c AS (SELECT avg(CASE WHEN salary_year_avg IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100 AS pct
  FROM postings)
SELECT section, metric, round(CAST(value AS DOUBLE), 6) AS value FROM (
  SELECT 'summary' AS section, 'count' AS metric, CAST(count AS DOUBLE) AS value FROM d
  UNION ALL SELECT 'summary', 'mean', mean FROM d UNION ALL SELECT 'summary', 'std', std FROM d
  UNION ALL SELECT 'summary', 'min', min FROM d UNION ALL SELECT 'summary', 'p5', p5 FROM d
  UNION ALL SELECT 'summary', 'p25', p25 FROM d UNION ALL SELECT 'summary', 'p50', p50 FROM d
  UNION ALL SELECT 'summary', 'p75', p75 FROM d UNION ALL SELECT 'summary', 'p95', p95 FROM d
  UNION ALL SELECT 'summary', 'max', max FROM d
  UNION ALL SELECT 'skew', 'skew_raw', skew_raw FROM d
  UNION ALL SELECT 'skew', 'skew_log', skew_log FROM d
  UNION ALL SELECT 'coverage', 'pct_with_target', pct FROM c
  UNION ALL SELECT 'coverage', 'mean_items', mean_items FROM d
  UNION ALL SELECT 'coverage', 'pct_with_items', pct_with_items FROM d)""",
    "r1_request_features": RQ + "SELECT * FROM req_features",
    "f16_f17_post_process": S + """,
b AS (SELECT posting_id, salary_year_avg AS y, posting_id % 4 <> 0 AS has_iv,
  least(greatest(salary_year_avg, 15000.0), 400000.0) AS p,
  salary_year_avg * (CAST(0.7 AS DOUBLE) + (posting_id % 5) * CAST(0.2 AS DOUBLE)) AS lo_raw,
  salary_year_avg * (CAST(1.2 AS DOUBLE) - (posting_id % 3) * CAST(0.2 AS DOUBLE)) AS hi_raw
  FROM salaried),
ab AS (SELECT *, CASE WHEN has_iv THEN least(lo_raw, hi_raw) ELSE p * CAST(0.85 AS DOUBLE) END AS a0,
  CASE WHEN has_iv THEN greatest(lo_raw, hi_raw) ELSE p * CAST(1.15 AS DOUBLE) END AS b0 FROM b),
cl AS (SELECT *, least(greatest(a0, 15000.0), 400000.0) AS a1,
  least(greatest(b0, 15000.0), 400000.0) AS b1 FROM ab)
SELECT posting_id, y AS raw_point, a1 AS lower,
  least(greatest(p, a1), b1) AS point, b1 AS upper FROM cl""",
    "f19_v2_residuals": SP + _VAL_BASE + """
SELECT posting_id, y AS salary_year_avg, round(pred, 4) AS pred, round(y - pred, 4) AS residual
FROM scored WHERE model = 'title_mean'""",
    "v2_identity_limits": SP + _VAL_BASE + """
SELECT round(least(min(y), min(pred)), 4) AS lo, round(greatest(max(y), max(pred)), 4) AS hi
FROM scored WHERE model = 'title_mean'""",
    "v3_residual_histogram": SP + _VAL_BASE + """,
vals AS (SELECT y - pred AS v FROM scored WHERE model = 'title_mean'),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
binned AS (SELECT CASE WHEN hi = lo THEN 0 ELSE
    least(CAST(floor((v - lo) / (hi - lo) * 60) AS BIGINT), 59) END AS bin, count(*) AS n
  FROM vals, st GROUP BY 1)
SELECT 'residual' AS series, g.range AS bin, round(lo + g.range * ((hi - lo) / 60), 4) AS bin_lo,
  round(lo + (g.range + 1) * ((hi - lo) / 60), 4) AS bin_hi, coalesce(n, 0) AS n
FROM range(60) g, st LEFT JOIN binned b ON b.bin = g.range""",
    "m11_ranking": SP + _VAL_BASE + """
SELECT model, n, round(MAE, 6) AS MAE, round(RMSE, 6) AS RMSE, round(R2, 6) AS R2,
  round(MAPE, 6) AS MAPE FROM metrics""",
    "m11_best": SP + _VAL_BASE + """
SELECT arg_min(model, RMSE) AS best_model, round(min(RMSE), 6) AS best_RMSE FROM metrics""",
    "m15_promotion": SP + _VAL_BASE + """
SELECT model, round(RMSE, 6) AS challenger_metric,
  round((SELECT RMSE FROM metrics WHERE model = 'title_mean'), 6) AS champion_metric,
  RMSE < (SELECT RMSE FROM metrics WHERE model = 'title_mean') AS promoted
FROM metrics WHERE model <> 'title_mean'
UNION ALL
SELECT 'title_mean_vs_none', round(RMSE, 6), CAST(NULL AS DOUBLE), true
FROM metrics WHERE model = 'title_mean'""",
    "v12_comparison_table": SP + _VAL_BASE + """
SELECT model, round(MAE, 0) AS MAE, round(RMSE, 0) AS RMSE, round(R2, 4) AS R2,
  round(MAPE, 2) AS MAPE FROM metrics ORDER BY RMSE, model LIMIT 6""",
    "v4_cv_baseline": _cv_sql(),
    "m17_group_quantiles": SP + _INTERVAL + """
SELECT posting_id, round(lower_raw, 4) AS lower_raw, round(upper_raw, 4) AS upper_raw FROM iv""",
    "v5_interval_coverage": SP + _INTERVAL + """
SELECT count(*) AS n, round(avg(CASE WHEN salary_year_avg >= least(lower_raw, upper_raw)
    AND salary_year_avg <= greatest(lower_raw, upper_raw) THEN 1.0 ELSE 0.0 END) * 100, 6)
    AS coverage_pct,
  round(avg(greatest(lower_raw, upper_raw) - least(lower_raw, upper_raw)), 4) AS mean_width,
  CAST(90.0 AS DOUBLE) AS nominal_pct FROM iv""",
    "v6_band_table": SP + _INTERVAL + """
SELECT posting_id, row_number() OVER (ORDER BY salary_year_avg, posting_id) - 1 AS position,
  salary_year_avg, round(least(lower_raw, upper_raw), 4) AS lower,
  round(greatest(lower_raw, upper_raw), 4) AS upper,
  salary_year_avg >= least(lower_raw, upper_raw) AND salary_year_avg <= greatest(lower_raw, upper_raw)
    AS inside
FROM iv""",
})

ORACLE["m1_one_feature_ols"] = SP + """
SELECT round(regr_slope(salary_year_avg, CAST(n_skills AS DOUBLE)), 4) AS slope,
  round(regr_intercept(salary_year_avg, CAST(n_skills AS DOUBLE)), 4) AS intercept
FROM split_rows WHERE split = 'train'"""

ORACLE["f5_f9_title_and_flags"] = P + r"""
SELECT posting_id,
  CAST(length(coalesce(job_title, '')) AS BIGINT) AS title_len,
  CAST(len(list_filter(regexp_split_to_array(coalesce(job_title, ''), '\s+'),
    lambda x: x <> '')) AS BIGINT) AS title_word_count,
  CAST(CASE WHEN lower(job_work_from_home) IN ('true', '1', 'yes', 't') THEN 1 ELSE 0 END AS BIGINT) AS remote_flag,
  CAST(CASE WHEN lower(job_no_degree_mention) IN ('true', '1', 'yes', 't') THEN 1 ELSE 0 END AS BIGINT) AS no_degree_flag,
  CAST(CASE WHEN lower(job_health_insurance) IN ('true', '1', 'yes', 't') THEN 1 ELSE 0 END AS BIGINT) AS health_flag,
  CAST(CASE
    WHEN regexp_matches(lower(coalesce(job_title, 'none')), '\b(intern|internship|junior|jr|entry|graduate|trainee)\b') THEN -1
    WHEN regexp_matches(lower(coalesce(job_title, 'none')), '\b(senior|sr|lead|principal|staff|head|manager|director|chief|vp)\b') THEN 2
    ELSE 0 END AS BIGINT) AS seniority_score,
  CAST(coalesce(month(try_strptime(job_posted_date, '%Y-%m-%d')), 0) AS BIGINT) AS posted_month,
  coalesce(job_schedule_type, 'unknown') AS job_schedule_type,
  coalesce(job_title, '') AS job_title
FROM postings"""
