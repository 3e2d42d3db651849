"""DuckDB SQL building blocks for the oracle side of every checked query.

These are the reference answers' SQL: the same derived views the Spark side
builds, written independently in plain SQL over the driver's parquet views.
"""

from __future__ import annotations

# The postings view (see paysight.sources.postings) in DuckDB SQL.
POSTINGS = """
items AS (
  SELECT DISTINCT l.l_orderkey AS k, p.p_name AS name,
    CASE p.p_type WHEN 'ECONOMY' THEN 'programming' WHEN 'LARGE' THEN 'databases'
      WHEN 'MEDIUM' THEN 'cloud' WHEN 'PROMO' THEN 'libraries' WHEN 'SMALL' THEN 'other'
      WHEN 'STANDARD' THEN 'async' ELSE lower(p.p_type) END AS cat
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
cat_lists AS (
  SELECT k, cat, list_sort(list(DISTINCT name)) AS names FROM items GROUP BY k, cat
),
type_text AS (
  SELECT k, '{' || string_agg('''' || cat || ''': [' ||
      array_to_string(list_transform(names, lambda x: '''' || x || ''''), ', ') || ']', ', '
      ORDER BY cat) || '}' AS job_type_skills
  FROM cat_lists GROUP BY k
),
skill_text AS (
  SELECT k, '[' || array_to_string(list_transform(list_sort(list(DISTINCT name)),
      lambda x: '''' || x || ''''), ', ') || ']' AS job_skills
  FROM items GROUP BY k
),
paid AS (
  SELECT o.*, (CASE o_orderpriority WHEN '1-URGENT' THEN 128000 WHEN '2-HIGH' THEN 96000
      WHEN '3-MEDIUM' THEN 64000 WHEN '5-LOW' THEN 0 ELSE 32000 END
      + coalesce(c_nationkey, 0) * 2500
      + CASE WHEN o_orderkey % 3 = 0 THEN 20000 ELSE 0 END
      + CASE WHEN o_orderkey % 50 = 7 THEN 400000 ELSE 0 END)::DOUBLE
      + o_totalprice % 80000::DOUBLE AS pay
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
postings AS (
  SELECT o.o_orderkey AS posting_id,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE
      (CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Senior ' WHEN '2-HIGH' THEN 'Lead '
        WHEN '3-MEDIUM' THEN 'Mid ' WHEN '5-LOW' THEN 'Junior ' ELSE '' END)
      || c.c_mktsegment || ' Engineer' END AS job_title,
    c.c_mktsegment AS job_title_short,
    CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE o.o_orderstatus END AS job_schedule_type,
    CASE WHEN o.o_orderkey % 10 = 0 THEN 'hour' ELSE 'year' END AS salary_rate,
    CASE WHEN o.o_orderkey % 10 = 0 THEN NULL WHEN o.o_orderkey % 10 = 1 THEN 0.0
      ELSE o.pay END::DOUBLE AS salary_year_avg,
    CASE WHEN o.o_orderkey % 10 = 0 THEN o.pay / 2080.0 END AS salary_hour_avg,
    n.n_name AS job_country,
    c.c_name AS company_name,
    n.n_name || '-' || c.c_mktsegment AS job_location,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'True' ELSE 'False' END AS job_work_from_home,
    CASE WHEN o.o_orderkey % 5 = 0 THEN 'true' END AS job_no_degree_mention,
    CASE WHEN o.o_orderkey % 2 = 0 THEN '1' ELSE '0' END AS job_health_insurance,
    substr(CAST(o.o_orderdate AS VARCHAR), 1, 10) AS job_posted_date,
    s.job_skills,
    t.job_type_skills
  FROM paid o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN skill_text s ON o.o_orderkey = s.k
  LEFT JOIN type_text t ON o.o_orderkey = t.k
)"""

# Parsed skills list: the derived text is JSON once quotes are swapped.
SALARIED = """
salaried AS (
  SELECT *,
    coalesce(list_transform(
      CAST(json(replace(job_skills, '''', '"')) AS VARCHAR[]), lambda x: lower(trim(x))),
      []::VARCHAR[]) AS skills_list
  FROM postings
  WHERE salary_year_avg IS NOT NULL AND salary_year_avg > 0
),
salaried_eda AS (
  SELECT * FROM salaried WHERE salary_year_avg >= 15000
)"""


def with_ctes(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n"

# Engineered feature frame on the capped salaried rows.
FEATURES = r"""
prepared AS (
  SELECT * FROM salaried WHERE salary_year_avg BETWEEN 15000 AND 400000
),
parsed AS (
  SELECT *, CAST(json(replace(job_type_skills, '''', '"')) AS MAP(VARCHAR, VARCHAR[])) AS tmap
  FROM prepared
),
features AS (
  SELECT posting_id, salary_year_avg,
    CAST(len(skills_list) AS BIGINT) AS n_skills,
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
    CAST(coalesce(len(list_filter(map_values(tmap), lambda v: len(v) > 0)), 0) AS BIGINT) AS n_skill_categories,
    coalesce(CAST(job_title_short AS VARCHAR), 'unknown') AS job_title_short,
    coalesce(CAST(job_schedule_type AS VARCHAR), 'unknown') AS job_schedule_type,
    coalesce(CAST(salary_rate AS VARCHAR), 'unknown') AS salary_rate,
    coalesce(CAST(job_country AS VARCHAR), 'unknown') AS job_country,
    coalesce(CAST(company_name AS VARCHAR), 'unknown') AS company_name,
    coalesce(CAST(job_location AS VARCHAR), 'unknown') AS job_location,
    coalesce(array_to_string(skills_list, ' '), '') AS skills_text,
    coalesce(job_title, '') AS job_title
  FROM parsed
)"""

# 7-column raw frame (column-pruned scan).
RAW7 = """
raw7 AS (
  SELECT salary_year_avg, job_skills, job_title_short, job_country, job_schedule_type,
         job_work_from_home, salary_rate FROM postings
)"""

STAR = """
fact_jobs AS (
  SELECT o_orderkey AS job_fact_id, o_custkey AS job_id,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 0.0
      ELSE o_totalprice END::DOUBLE AS salary_average_year,
    CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice / 2080.0 END AS salary_average_hour
  FROM orders),
bridge_job_skills AS (SELECT l_orderkey AS job_fact_id, l_partkey AS skill_id FROM lineitem),
dim_job AS (SELECT c_custkey AS job_id, c_mktsegment AS job_title_short FROM customer),
dim_job_skills AS (SELECT p_partkey AS skill_id, p_name AS skills, p_type AS type FROM part),
dim_company AS (SELECT s_suppkey AS company_id, s_name AS company_name FROM supplier),
dim_location AS (SELECT n_nationkey AS location_id, n_name AS job_country,
  n_regionkey AS region_id FROM nation),
dim_date AS (SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id
  FROM orders)"""

# Column layout of the star views as Spark reports it (name, simple type string).
STAR_COLUMNS = {
    "fact_jobs": [("job_fact_id", "bigint"), ("job_id", "bigint"), ("date_id", "int"),
                  ("salary_average_year", "double"), ("salary_average_hour", "double")],
    "bridge_job_skills": [("job_fact_id", "bigint"), ("skill_id", "bigint")],
    "dim_job": [("job_id", "bigint"), ("job_title_short", "string")],
    "dim_job_skills": [("skill_id", "bigint"), ("skills", "string"), ("type", "string")],
    "dim_company": [("company_id", "bigint"), ("company_name", "string")],
    "dim_location": [("location_id", "int"), ("job_country", "string"), ("region_id", "int")],
    "dim_date": [("date_id", "int")],
}

# Portable split over the capped, engineered rows (P1): hash order, exact sizes.
SPLIT = """
hashed AS (
  SELECT *, CAST('0x' || substr(md5(CAST(posting_id AS VARCHAR) || '-42'), 1, 15) AS BIGINT) AS h
  FROM features),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY h, posting_id) - 1 AS pos, count(*) OVER () AS n_all
  FROM hashed),
sized AS (
  SELECT *, CAST(ceil(CAST(0.15 AS DOUBLE) * n_all) AS BIGINT) AS n_test FROM ranked),
split_rows AS (
  SELECT *, CASE WHEN pos < n_test THEN 'test'
    WHEN pos < n_test + CAST(ceil((CAST(0.15 AS DOUBLE) / (1 - CAST(0.15 AS DOUBLE)))
                                  * (n_all - n_test)) AS BIGINT) THEN 'val'
    ELSE 'train' END AS split
  FROM sized)"""

REQUESTS = """
requests AS (
  SELECT posting_id AS request_id,
    coalesce(job_title, job_title_short || ' Analyst') AS title,
    ' , ' || upper(array_to_string(sl, ' , ')) || ',,' AS skills,
    CASE WHEN posting_id % 11 = 0 THEN NULL ELSE job_location END AS location,
    CASE WHEN posting_id % 7 = 0 THEN '' ELSE job_country END AS country,
    CASE WHEN posting_id % 13 = 0 THEN '' ELSE company_name END AS company,
    (['senior', 'Lead', '', 'Principal'])[posting_id % 4 + 1] AS level,
    (['Full-time', 'CDI', 'CDD', 'contractor', 'Part-Time', 'internship', 'FREELANCE',
      'temporary', 'permanent', 'contract', '', 'Stage'])[posting_id % 12 + 1] AS contract_type,
    job_work_from_home = 'True' AS remote
  FROM (SELECT *, coalesce(list_transform(
      CAST(json(replace(job_skills, '''', '"')) AS VARCHAR[]), lambda x: lower(trim(x))),
      []::VARCHAR[]) AS sl FROM postings)
),
req_mapped AS (
  SELECT request_id,
    CASE WHEN trim(coalesce(level, '')) = ''
           OR instr(lower(coalesce(title, '')), lower(trim(coalesce(level, '')))) > 0
         THEN coalesce(title, '')
         ELSE trim(trim(level) || ' ' || coalesce(title, '')) END AS job_title,
    coalesce(title, '') AS job_title_short,
    CASE lower(coalesce(contract_type, '')) WHEN 'cdi' THEN 'Full-time' WHEN 'cdd' THEN 'Contractor'
      WHEN 'permanent' THEN 'Full-time' WHEN 'full-time' THEN 'Full-time'
      WHEN 'part-time' THEN 'Part-time' WHEN 'contract' THEN 'Contractor'
      WHEN 'internship' THEN 'Internship' WHEN 'freelance' THEN 'Contractor'
      WHEN 'temporary' THEN 'Temp work' ELSE 'Full-time' END AS job_schedule_type,
    CASE WHEN country IS NULL THEN coalesce(nullif(location, ''), 'unknown') ELSE country END
      AS job_country,
    coalesce(nullif(location, ''), 'unknown') AS job_location,
    coalesce(nullif(company, ''), 'unknown') AS company_name,
    CASE WHEN coalesce(remote, false) THEN 1 ELSE 0 END AS remote_flag,
    list_filter(list_transform(string_split(coalesce(skills, ''), ','),
      lambda x: lower(trim(x))), lambda x: x <> '') AS skills_list
  FROM requests
),
req_features AS (
  SELECT request_id,
    CAST(len(skills_list) AS BIGINT) AS n_skills,
    CAST(length(job_title) AS BIGINT) AS title_len,
    CAST(len(list_filter(regexp_split_to_array(job_title, '\\s+'), lambda x: x <> ''))
      AS BIGINT) AS title_word_count,
    CAST(remote_flag AS BIGINT) AS remote_flag,
    CAST(0 AS BIGINT) AS no_degree_flag, CAST(0 AS BIGINT) AS health_flag,
    CAST(CASE
      WHEN regexp_matches(lower(job_title), '\\b(intern|internship|junior|jr|entry|graduate|trainee)\\b') THEN -1
      WHEN regexp_matches(lower(job_title), '\\b(senior|sr|lead|principal|staff|head|manager|director|chief|vp)\\b') THEN 2
      ELSE 0 END AS BIGINT) AS seniority_score,
    CAST(1 AS BIGINT) AS posted_month,
    CAST(0 AS BIGINT) AS cat_programming, CAST(0 AS BIGINT) AS cat_databases,
    CAST(0 AS BIGINT) AS cat_cloud, CAST(0 AS BIGINT) AS cat_libraries,
    CAST(0 AS BIGINT) AS cat_analyst_tools, CAST(0 AS BIGINT) AS cat_webframeworks,
    CAST(0 AS BIGINT) AS cat_other, CAST(0 AS BIGINT) AS n_skill_categories,
    job_title_short, job_schedule_type, 'year' AS salary_rate, job_country, company_name,
    job_location, array_to_string(skills_list, ' ') AS skills_text, job_title
  FROM req_mapped
)"""
