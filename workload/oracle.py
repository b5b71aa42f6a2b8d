"""The same queries as SQL for DuckDB. Each view of ``views.py`` is a common table expression here."""

from __future__ import annotations

from hirelake.functions.text import CORPORATE_WORDS

CUTOFF = "1998-05-01"

CTE = {}


def cte(name: str, needs: str, body: str) -> None:
    CTE[name] = (needs.split(), body)


def query(needs: str, body: str) -> str:
    """``body`` with the views it needs, in order of their definition."""
    wanted: set[str] = set()

    def visit(name: str) -> None:
        for n in CTE[name][0]:
            visit(n)
        wanted.add(name)

    for n in needs.split():
        visit(n)
    parts = [f"{n} AS ({body_})" for n, (_, body_) in CTE.items() if n in wanted]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def words_in(items: list[str]) -> str:
    return ", ".join(f"'{i}'" for i in items)


CITY = "CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE n_name END"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

cte("lines", "", """
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""")

cte("staging_jobs", "lines", f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS job_id, p_name AS title,
    concat_ws(' ', p_name, p_brand, p_type) AS description,
    l_extendedprice * (1 - l_discount) AS salary_min, l_extendedprice AS salary_max,
    CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN NULL
      ELSE epoch_us(o_orderdate) * 1000 + l_linenumber * 137 END AS created,
    concat_ws('/', 'https://jobs.example', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS redirected_url,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ingest_data,
    epoch_us(l_shipdate) * 1000 AS ingest_ts,
    CASE WHEN s_acctbal <= 9000 THEN s_name END AS company_name, p_type AS category_label,
    {CITY} AS city, r_name AS state
  FROM lines""")

cte("flat", "lines", """
  SELECT CAST(l_orderkey AS VARCHAR) AS job_id, p_name AS title,
    concat_ws(' ', p_name, p_brand, p_type) AS description,
    l_extendedprice * (1 - l_discount) AS salary_min, l_extendedprice AS salary_max,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate + INTERVAL 12 HOUR END AS created,
    concat_ws('/', 'https://jobs.example', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS redirected_url,
    CASE WHEN s_acctbal < 1000 THEN '' WHEN s_acctbal <= 9000 THEN s_name END AS company_name,
    p_type AS category_label,
    CASE WHEN n_nationkey % 5 >= 2 THEN r_name END AS country,
    CASE WHEN n_nationkey % 5 >= 3 THEN n_name END AS state,
    CASE WHEN n_nationkey % 5 >= 4 THEN s_name END AS city,
    l_returnflag AS contract_type, l_linestatus AS contract_time
  FROM lines""")
cte("star_companies", "flat", "SELECT DISTINCT company_name FROM flat WHERE company_name <> ''")
cte("star_categories", "flat", "SELECT DISTINCT category_label FROM flat WHERE category_label <> ''")
cte("star_locations", "flat", """
  SELECT DISTINCT city, state, country FROM flat
  WHERE coalesce(city, '') <> '' OR coalesce(state, '') <> ''""")

cte("companies", "", "SELECT s_name AS company_name, md5(s_name) AS company_id FROM supplier")
cte("companies_known", "", """
  SELECT s_name AS company_name, 'S' || s_suppkey AS company_id FROM supplier WHERE s_acctbal >= 0""")
cte("categories", "", """
  SELECT DISTINCT p_type AS category_label, md5(p_type) AS category_id FROM part""")
cte("places", "", f"""
  SELECT DISTINCT {CITY} AS city, r_name AS state,
    CASE WHEN c_acctbal < 5000 THEN 'CA' ELSE 'US' END AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("locations", "places", """
  SELECT *, md5(concat_ws('|', coalesce(city, ''), state, country)) AS location_id FROM places""")
cte("locations_known", "", """
  SELECT DISTINCT CASE n_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE n_name END AS city,
    r_name AS state, 'US' AS country, 'N' || n_nationkey AS location_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('AFRICA', 'ASIA') AND c_acctbal >= 5000""")


def latest(source: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ingest_ts DESC NULLS LAST,
      title, description, salary_min, salary_max, created NULLS FIRST, redirected_url, ingest_data,
      company_name NULLS FIRST, category_label, city NULLS FIRST, state) AS rn
    FROM {source}) WHERE rn = 1"""


def decode(column: str) -> str:
    return f"CASE WHEN {column} > 0 THEN make_timestamp(CAST(round({column} / 1000) AS BIGINT)) END"


def keyed(source: str) -> str:
    """Left joins to the dimensions; of several countries with one city and state, the first."""
    return f"""
  SELECT s.* EXCLUDE (created, ingest_ts), {decode('s.created')} AS created,
    {decode('s.ingest_ts')} AS ingest_ts, c.company_id, k.category_id, l.location_id
  FROM {source} s LEFT JOIN companies c ON s.company_name = c.company_name
  LEFT JOIN categories k ON s.category_label = k.category_label
  LEFT JOIN (SELECT coalesce(city, '') AS city, state, arg_min(location_id, country) AS location_id
    FROM locations GROUP BY 1, 2) l ON coalesce(s.city, '') = l.city AND coalesce(s.state, '') = l.state"""


cte("latest_jobs", "staging_jobs", latest("staging_jobs"))
cte("jobs_source", "latest_jobs companies categories locations", keyed("latest_jobs"))
cte("jobs_known", "", f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderpriority AS title, NULL AS description,
    CAST(NULL AS DOUBLE) AS salary_min, o_totalprice AS salary_max, o_orderdate AS created,
    'https://old.example/' || o_orderkey AS redirected_url, 'snapshot' AS ingest_data,
    o_orderdate AS ingest_ts, NULL AS company_id, NULL AS category_id, NULL AS location_id,
    'former' AS company_name, NULL AS category_label, NULL AS city, NULL AS state
  FROM orders WHERE o_orderdate < DATE '{CUTOFF}'""")

JOB_COLUMNS = [
    "title", "description", "salary_min", "salary_max", "created", "ingest_ts", "company_id",
    "category_id", "location_id", "company_name", "category_label", "city", "state",
]
FROZEN = ["redirected_url", "ingest_data"]


def merged(target: str, source: str) -> str:
    changed = ", ".join(
        f"CASE WHEN s.job_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in JOB_COLUMNS)
    kept = ", ".join(
        f"CASE WHEN t.job_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in FROZEN)
    return f"""
  SELECT coalesce(t.job_id, s.job_id) AS job_id, {changed}, {kept}
  FROM {target} t FULL OUTER JOIN {source} s ON t.job_id = s.job_id"""


SHOW_JOBS = f"""SELECT * REPLACE (strftime(created, {STAMP}) AS created,
  strftime(ingest_ts, {STAMP}) AS ingest_ts) FROM """

cte("merged_jobs", "jobs_known jobs_source", merged("jobs_known", "jobs_source"))
cte("early_drop", "staging_jobs", f"SELECT * FROM staging_jobs WHERE ingest_data < '{CUTOFF}'")
cte("late_drop", "staging_jobs", f"SELECT * FROM staging_jobs WHERE ingest_data >= '{CUTOFF}'")
cte("early_latest", "early_drop", latest("early_drop"))
cte("late_latest", "late_drop", latest("late_drop"))
cte("early_jobs", "early_latest companies categories locations", keyed("early_latest"))
cte("late_jobs", "late_latest companies categories locations", keyed("late_latest"))

cte("pair_counts", "jobs_source companies", """
  SELECT j.category_label, c.company_name, count(DISTINCT j.job_id) AS n
  FROM jobs_source j JOIN companies c ON j.company_id = c.company_id
  WHERE j.category_label IS NOT NULL AND c.company_name IS NOT NULL GROUP BY ALL""")

# --- petitions and names

KINDS = ["new_employment", "new_concurrent", "change_of_employer",
         "continuation", "change_with_same_employer", "amended"]


def units(i: int) -> str:
    return f"nullif((CAST(l_quantity AS INTEGER) + {i} * l_linenumber) % {i + 2}, 0)"


COUNTERS = ", ".join(
    f"CASE WHEN s_acctbal > 2000 OR year(l_shipdate) > 2000 THEN {units(i)} END AS {k}_approval, "
    f"{units(i)} AS {k}_denial" for i, k in enumerate(KINDS))


def total(kinds: list[str], outcome: str) -> str:
    return "CAST(" + " + ".join(f"coalesce({k}_{outcome}, 0)" for k in kinds) + " AS INTEGER)"


cte("petitions", "", f"""
  SELECT CAST(year(l_shipdate) AS INTEGER) AS fiscal_year, upper(s_name) AS employer_name,
    l_returnflag AS naics_code, l_linestatus AS city, l_suppkey * 7 AS zip, s_acctbal, {COUNTERS}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")


def batch(where: str) -> str:
    return f"""SELECT employer_name, max(fiscal_year) AS fiscal_year,
    max({total(KINDS, 'approval')} > 0) AS is_sponsor FROM petitions WHERE {where} GROUP BY 1"""


cte("status_before", "petitions", batch("fiscal_year <= 1998"))
cte("later_batch", "petitions", batch("fiscal_year > 1998"))

cte("company_names", "", """
  SELECT CAST(c_custkey AS VARCHAR) AS company_id, CASE
    WHEN c_acctbal < 0 THEN 'Services LLC'
    WHEN c_mktsegment = 'BUILDING' THEN c_name || ' LLC'
    WHEN c_mktsegment = 'AUTOMOBILE' THEN c_name || ', Inc.'
    WHEN c_mktsegment = 'MACHINERY' THEN '  ' || c_name || ' (formerly Old Co)'
    WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name || ' Holdings   Group'
    ELSE 'The ' || c_name || ' & Partners'' Co.' END AS company_name FROM customer""")
cte("sponsor_status", "", """
  SELECT employer_name, bool_or(c_nationkey < 15) AS ever_sponsored_h1b,
    CAST(max(2000 + c_nationkey) AS INTEGER) AS last_updated_fiscal_year
  FROM (SELECT c_nationkey, unnest(CASE
      WHEN c_acctbal > 5000 THEN [upper(c_name) || ' CORPORATION', upper(c_name) || ' LLC']
      WHEN c_acctbal > 0 THEN ['THE ' || upper(c_name) || ' CO']
      ELSE ['GROUP, INC. ' || c_mktsegment] END) AS employer_name FROM customer) GROUP BY 1""")

SUFFIXES = "|".join(rf"\b{word}\b" for word in CORPORATE_WORDS)


def normal(name: str) -> str:
    plain = rf"regexp_replace(lower(trim({name})), '\([^)]*\)', '', 'g')"
    plain = rf"regexp_replace({plain}, '{SUFFIXES}', '', 'g')"
    plain = rf"regexp_replace({plain}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return rf"coalesce(trim(regexp_replace({plain}, '\s+', ' ', 'g')), '')"


cte("mapping", "company_names sponsor_status", f"""
  SELECT c.company_name, min(s.employer_name) AS employer_name
  FROM (SELECT DISTINCT company_name, {normal('company_name')} AS k FROM company_names) c
  JOIN (SELECT employer_name, {normal('employer_name')} AS k FROM sponsor_status) s ON c.k = s.k
  GROUP BY 1""")

# --- texts

PHRASES = ["the", "of", "and", "of the", "the of", "the and", "and the", "the the", "the the the"]
STOP = ["the", "of", "and", "to", "in", "la", "le", "de", "und", "der"]


def token_list(text: str) -> str:
    spaced = (rf"regexp_replace(lower({text}), '[\s\x0B\p{{Z}}]{{2,}}|[\t\n\x0B\f\r]|[^\P{{Z}} ]', "
              "chr(1), 'g')")
    return (rf"regexp_extract_all({spaced}, 'c\+\+|[\p{{L}}\p{{M}}\p{{N}}_]+"
            rf"(?:\.[\p{{L}}\p{{M}}\p{{N}}_]+)*|[^\s\p{{Z}}\p{{L}}\p{{M}}\p{{N}}_]')")


def grams(source: str) -> str:
    """Token positions with the one, two and three words that start there."""
    return f"""
  SELECT job_id, start, t AS w1, t || ' ' || lead(t) OVER o AS w2,
    t || ' ' || lead(t) OVER o || ' ' || lead(t, 2) OVER o AS w3
  FROM (SELECT job_id, unnest(toks) AS t, generate_subscripts(toks, 1) - 1 AS start FROM {source})
  WINDOW o AS (PARTITION BY job_id ORDER BY start)"""


def hits(source: str, phrases: list[str]) -> str:
    by_size = {n: [p for p in phrases if p.count(" ") == n - 1] for n in (1, 2, 3)}
    return " UNION ALL ".join(
        f"SELECT job_id, start, {n} AS n_words, w{n} AS phrase FROM {source} WHERE w{n} IN ({words_in(p)})"
        for n, p in by_size.items() if p)


def greedy(source: str) -> str:
    """Longest hit first, then the earliest; a hit that overlaps a chosen one is dropped."""
    return f"""
  SELECT job_id, list_reduce(
    list([{{'s': start, 'e': start + n_words, 'p': phrase}}] ORDER BY n_words DESC, start),
    lambda chosen, h: CASE WHEN len(list_filter(chosen, lambda c: c.s < h[1].e AND h[1].s < c.e)) = 0
      THEN list_concat(chosen, h) ELSE chosen END) AS chosen
  FROM {source} GROUP BY job_id"""


cte("toks", "", f"""
  SELECT CAST(doc_id AS VARCHAR) AS job_id, {token_list('text')} AS toks FROM documents""")
cte("grams", "toks", grams("toks"))
cte("hits", "grams", hits("grams", PHRASES))
cte("chosen", "hits", greedy("hits"))
cte("tags", "chosen", """
  SELECT job_id, unnest(list_distinct(list_transform(chosen, lambda c: c.p))) AS skill_name FROM chosen""")

cte("joined_toks", "", f"""
  SELECT CAST(doc_id AS VARCHAR) AS job_id,
    {token_list("replace(replace(text, 'of the', 'of-the'), 'and the', 'and/the')")} AS toks
  FROM documents""")
cte("joined_grams", "joined_toks", grams("joined_toks"))
cte("space_hits", "joined_grams", hits("joined_grams", ["the", "of", "and", "to the"]))
cte("space_chosen", "space_hits", greedy("space_hits"))
cte("token_hits", "joined_grams", hits(
    "joined_grams", ["the", "of", "and", "to the", "of - the", "and / the"]))
cte("token_chosen", "token_hits", greedy("token_hits"))

cte("descriptions", "", """
  SELECT CAST(doc_id AS VARCHAR) AS job_id, CASE WHEN lang <> 'de' THEN source END AS title,
    text || CASE lang WHEN 'en' THEN ' 5+ years ' WHEN 'de' THEN ' 3-4 yrs' ELSE '' END AS description,
    CASE WHEN lang <> 'de' THEN lang END AS category_label,
    CASE WHEN source <> 'src3' THEN source END AS company_name, n_chars FROM documents""")

EXPERIENCE = r"(\d+\+?-?\d*)\s+(?:years?|yrs?)"
cte("described_toks", "descriptions", f"""
  SELECT job_id, {token_list('description')} AS toks FROM descriptions""")
cte("described_grams", "described_toks", grams("described_toks"))
cte("described_hits", "described_grams", hits("described_grams", PHRASES))
cte("described_chosen", "described_hits", greedy("described_hits"))
cte("skill_rows", "described_chosen descriptions", f"""
  SELECT job_id AS source_job_id,
    unnest(list_distinct(list_transform(chosen, lambda c: c.p))) AS skill_name FROM described_chosen
  UNION
  SELECT job_id, regexp_extract(lower(description), '{EXPERIENCE}', 1) || ' years experience'
  FROM descriptions WHERE regexp_matches(lower(description), '{EXPERIENCE}')""")
cte("skills_known", "", """
  SELECT DISTINCT lang AS skill_name, 'L-' || lang AS skill_id FROM documents
  UNION ALL SELECT 'the', 'S-the' FROM region WHERE r_name = 'ASIA'""")
cte("skills", "skill_rows skills_known", """
  SELECT * FROM skills_known UNION ALL
  SELECT skill_name, md5(length(skill_name) || ':' || skill_name) FROM (SELECT DISTINCT skill_name FROM skill_rows)
  WHERE skill_name NOT IN (SELECT skill_name FROM skills_known)""")

# --- enrichment

cte("responses", "", """
  SELECT CAST(event_id AS VARCHAR) AS job_id, CASE event_type
    WHEN 'click' THEN '{"skills": ["sql", "k' || (props ->> '$.k') || '"], "years_min": ' || (props ->> '$.k')
      || ', "years_max": 99, "education": "BSc", "benefits": ["bonus"], "tech_stack": []}'
    WHEN 'view' THEN '{"years_min": "' || (props ->> '$.k') || '", "years_max": ' || (props ->> '$.k')
      || '.75, "skills": "sql", "benefits": {"a": 1}}'
    WHEN 'signup' THEN '{"skills": null, "years_max": null, "benefits": ["a", "b"]}'
    WHEN 'purchase' THEN '[{"years_min": ' || (props ->> '$.k') || '}]'
    ELSE '{"years_min": ' || (props ->> '$.k') END AS response
  FROM events""")
cte("valid_responses", "responses", """
  SELECT job_id, CASE WHEN json_valid(response) THEN CAST(response AS JSON) END AS r FROM responses
  WHERE CASE WHEN json_valid(response) THEN json_type(CAST(response AS JSON)) = 'OBJECT' END""")


def joined(key: str) -> str:
    return f"""CASE json_type(r -> '$.{key}') WHEN 'ARRAY' THEN array_to_string(CAST(r -> '$.{key}' AS VARCHAR[]), ',')
    WHEN 'OBJECT' THEN '' ELSE coalesce(r ->> '$.{key}', '') END"""


def whole(key: str) -> str:
    return f"CAST(trunc(TRY_CAST(r ->> '$.{key}' AS DOUBLE)) AS INTEGER)"


PARSED = f"""SELECT job_id, coalesce({joined('skills')}, '') AS extracted_skills,
  {whole('years_min')} AS years_experience_min, {whole('years_max')} AS years_experience_max,
  r ->> '$.education' AS education_level, coalesce({joined('benefits')}, '') AS benefits,
  coalesce({joined('tech_stack')}, '') AS tech_stack, '2025-01-01T12:00:00' AS processed_at FROM valid_responses"""

# --- words and clusters


def cleaned(text: str) -> str:
    spaced = rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return rf"coalesce(trim(regexp_replace({spaced}, '[\s\p{{Z}}]+', ' ', 'g')), '')"


cte("members", "", """
  SELECT CAST(d.doc_id AS VARCHAR) AS job_id, d.lang, d.text,
    CAST(least(d.n_chars // 1000, 8) AS INTEGER) AS cluster_id,
    CAST(l.quality AS DOUBLE) AS salary_min, CAST(d.n_chars AS DOUBLE) AS salary_max
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
cte("words", "members", f"""
  SELECT * FROM (SELECT job_id, unnest(string_split({cleaned('text')}, ' ')) AS term FROM members)
  WHERE length(term) >= 2 AND term NOT IN ({words_in(STOP)})""")
cte("vocab", "words", """
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT job_id))) + 1 AS idf
  FROM words GROUP BY term ORDER BY count(*) DESC, term LIMIT 500""")
cte("raw_weights", "words vocab", """
  SELECT job_id, term, count(*) * any_value(idf) AS w FROM words JOIN vocab USING (term) GROUP BY ALL""")
cte("weights", "raw_weights", """
  SELECT job_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY job_id)) AS weight FROM raw_weights""")


def keywords(cluster: str) -> str:
    """Mean weight per cluster and term over all members, the five best per cluster."""
    return f"""
  SELECT * FROM (
    SELECT c.{cluster}, v.term, coalesce(sum(w.weight), 0) / any_value(c.n) AS weight,
      row_number() OVER (PARTITION BY c.{cluster}
        ORDER BY coalesce(sum(w.weight), 0) / any_value(c.n) DESC, v.term) AS rank
    FROM (SELECT {cluster}, count(*) AS n FROM members GROUP BY 1) c CROSS JOIN vocab v
    LEFT JOIN (SELECT m.{cluster}, w.term, w.weight FROM weights w JOIN members m USING (job_id)) w
      ON w.{cluster} = c.{cluster} AND w.term = v.term
    GROUP BY c.{cluster}, v.term) WHERE rank <= 5"""


cte("lang_keywords", "weights members vocab", keywords("lang"))
cte("length_keywords", "weights members vocab", keywords("cluster_id"))


def named(source: str, cluster: str) -> str:
    return f"""
  SELECT {cluster}, string_agg(term, ', ' ORDER BY rank) AS top_terms, 'Cluster_'
    || string_agg(CASE WHEN rank <= 2 THEN term END, '_' ORDER BY rank) AS cluster_name
  FROM {source} GROUP BY 1"""


cte("dims", "", """
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS position
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings)""")
cte("centers", "dims", "SELECT label, position, avg(x) AS c FROM dims GROUP BY ALL")
cte("center_distances", "dims centers", """
  SELECT d.vec_id, d.label AS own, c.label AS center, sqrt(sum((d.x - c.c) * (d.x - c.c))) AS distance
  FROM dims d JOIN centers c USING (position) GROUP BY ALL""")
cte("nearest", "center_distances", """
  SELECT own AS cluster_id, rank, vec_id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY own ORDER BY distance, vec_id) AS rank
    FROM center_distances WHERE own = center) WHERE rank <= 5""")

# Every vector against every cluster, from all pairs.
cte("vector_means", "", """
  SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_aggregate(list_transform(
      list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])), 'sum')) AS far, count(*) AS size
  FROM embeddings a CROSS JOIN embeddings b GROUP BY ALL""")
# Every job against every job.
cte("category_jobs", "descriptions", """
  SELECT job_id, coalesce(category_label, 'Unknown') AS a, coalesce(company_name, '<null>') AS b,
    least(n_chars // 1000, 8) AS own FROM descriptions""")
cte("job_means", "category_jobs", """
  SELECT x.job_id, x.own, y.own AS other, count(*) AS size,
    sum(2.0 * ((x.a <> y.a)::INT + (x.b <> y.b)::INT)) AS far
  FROM category_jobs x CROSS JOIN category_jobs y GROUP BY ALL""")




def assigned(source: str) -> str:
    """Each vector with its nearest centre, from a CTE of centres (label, position, c)."""
    return f"""
  SELECT vec_id, arg_min(label, (off, label)) AS label, min(off) AS off FROM (
    SELECT d.vec_id, c.label, sum((d.x - c.c) * (d.x - c.c)) AS off FROM dims d JOIN {source} c USING (position) GROUP BY ALL)
  GROUP BY vec_id"""


def moved(source: str, old: str) -> str:
    """Means of the vectors of each centre; a centre without any stays."""
    return f"""
  SELECT label, position, coalesce(m, c) AS c FROM {old} LEFT JOIN (
    SELECT a.label, position, avg(x) AS m FROM {source} a JOIN dims d USING (vec_id) GROUP BY ALL) USING (label, position)"""


cte("assigned_1", "dims centers", assigned("centers"))
cte("centers_1", "assigned_1", moved("assigned_1", "centers"))
cte("assigned_2", "centers_1", assigned("centers_1"))
cte("centers_2", "assigned_2", moved("assigned_2", "centers_1"))
cte("assigned_3", "centers_2", assigned("centers_2"))

cte("pairs", "category_jobs", "SELECT a, b, count(*) AS jobs FROM category_jobs GROUP BY ALL")
cte("pairs_0", "pairs", """
  SELECT a, b, 1 AS jobs, CAST(row_number() OVER (ORDER BY jobs DESC, a, b = '<null>', b) - 1 AS INTEGER) AS id
  FROM pairs QUALIFY id < 4""")
for turn in (1, 2, 3):
    cte(f"shares_{turn}", f"pairs_{turn - 1}", f"""
  SELECT id, kind, value, sum(jobs) / any_value(size) AS share FROM (
    SELECT id, unnest(['a', 'b']) AS kind, unnest([a, b]) AS value, jobs, size FROM (
      SELECT *, sum(jobs) OVER (PARTITION BY id) AS size FROM pairs_{turn - 1})) GROUP BY ALL""")
    cte(f"pairs_{turn}", f"pairs shares_{turn}", f"""
  SELECT a, b, jobs, arg_min(id, (off, id)) AS id, min(off) AS off FROM (
    SELECT p.a, p.b, p.jobs, n.id, round(2 - 2 * (coalesce(x.share, 0) + coalesce(y.share, 0)) + n.norm, 9) AS off
    FROM pairs p CROSS JOIN (SELECT id, sum(share * share) AS norm FROM shares_{turn} GROUP BY id) n
    LEFT JOIN shares_{turn} x ON x.id = n.id AND x.kind = 'a' AND x.value = p.a
    LEFT JOIN shares_{turn} y ON y.id = n.id AND y.kind = 'b' AND y.value = p.b) GROUP BY ALL""")

cte("vector_roots", "", """
  SELECT a.vec_id, a.label AS own, b.label AS other, sum(sqrt(list_aggregate(list_transform(
      list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])), 'sum'))) AS far, count(*) AS size
  FROM embeddings a CROSS JOIN embeddings b GROUP BY ALL""")
cte("job_roots", "category_jobs", """
  SELECT x.job_id, x.own, y.own AS other, count(*) AS size,
    sum(sqrt(2.0 * ((x.a <> y.a)::INT + (x.b <> y.b)::INT))) AS far
  FROM category_jobs x CROSS JOIN category_jobs y GROUP BY ALL""")


def silhouette(means: str, unit: str, weight: str) -> str:
    return f"""
  SELECT sum({weight} * coalesce(CASE WHEN size > 1 THEN (outside - inside) / greatest(outside, inside) END, 0))
    / sum({weight}) AS silhouette
  FROM (SELECT {unit}, max(CASE WHEN own = other THEN size END) AS size,
      max(CASE WHEN own = other AND size > 1 THEN far / (size - 1) END) AS inside,
      min(CASE WHEN own <> other THEN far / size END) AS outside
    FROM {means} GROUP BY ALL)"""


cte("vector_score", "vector_means", silhouette("vector_means", "vec_id", "1"))
cte("category_score", "job_means", silhouette("job_means", "job_id", "1"))

ORACLE = {
    "star_jobs": query("flat", """
      SELECT job_id, title, description, salary_min, salary_max, epoch_us(created) * 1000 AS created,
        redirected_url, '2025-01-01T12:00:00' AS ingest_data, 1735732800000000000 AS ingest_ts,
        company_name, category_label, city, state FROM flat"""),
    "star_jobstats": query("flat", """
      SELECT job_id, contract_type, contract_time, CAST(weekofyear(created) AS VARCHAR) AS posting_week
      FROM flat"""),
    "star_companies": query("star_companies", "SELECT * FROM star_companies"),
    "star_categories": query("star_categories", "SELECT * FROM star_categories"),
    "star_locations": query("star_locations", "SELECT * FROM star_locations"),
    "row_counts": query("flat star_companies star_categories star_locations", """
      SELECT 'jobs' AS "table", count(*) AS rows FROM flat UNION ALL
      SELECT 'jobstats', count(*) FROM flat UNION ALL
      SELECT 'companies', count(*) FROM star_companies UNION ALL
      SELECT 'locations', count(*) FROM star_locations UNION ALL
      SELECT 'categories', count(*) FROM star_categories"""),
    "page_explode": """
      SELECT o_orderkey AS page_id, o_orderkey || suffix AS id, o_orderpriority AS title,
        o_totalprice AS salary_max
      FROM orders, (VALUES ('a'), ('b')) AS s(suffix)
      WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "nanos_to_timestamp": f"""
      SELECT o_orderkey, strftime({decode('n')}, {STAMP}) AS created FROM (
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -epoch_us(o_orderdate) * 1000
          WHEN o_orderpriority = '5-LOW' THEN 0
          WHEN o_orderpriority <> '1-URGENT' THEN epoch_us(o_orderdate) * 1000 + o_custkey * 7 END AS n
        FROM orders)""",
    "latest_per_job": query("latest_jobs", "SELECT * FROM latest_jobs"),
    "dim_key_lookup": query("staging_jobs companies categories locations", f"""
      SELECT job_id, redirected_url, company_id, category_id, location_id FROM ({keyed('staging_jobs')})"""),
    "merge_companies": query("companies_known staging_jobs", """
      SELECT * FROM companies_known UNION ALL
      SELECT company_name, md5(length(company_name) || ':' || company_name) FROM (
        SELECT DISTINCT company_name FROM staging_jobs WHERE company_name IS NOT NULL)
      WHERE company_name NOT IN (SELECT company_name FROM companies_known)"""),
    "merge_categories": query("categories staging_jobs", """
      SELECT * FROM categories WHERE category_label IN ('ECONOMY', 'PROMO') UNION ALL
      SELECT category_label, md5(length(category_label) || ':' || category_label) FROM (
        SELECT DISTINCT category_label FROM staging_jobs WHERE category_label IS NOT NULL)
      WHERE category_label NOT IN ('ECONOMY', 'PROMO')"""),
    "merge_locations": query("places locations_known", """
      SELECT * FROM locations_known UNION ALL
      SELECT city, state, country, md5(length(coalesce(city, '')) || ':' || coalesce(city, '')
        || length(state) || ':' || state || length(country) || ':' || country)
      FROM (SELECT max(city) AS city, state, country FROM places GROUP BY coalesce(city, ''), state, country) p
      WHERE NOT EXISTS (SELECT 1 FROM locations_known k WHERE coalesce(k.city, '') = coalesce(p.city, '')
        AND coalesce(k.state, '') = coalesce(p.state, '') AND coalesce(k.country, '') = coalesce(p.country, ''))"""),
    "merge_jobs": query("merged_jobs", SHOW_JOBS + "merged_jobs"),
    "merge_idempotent": query("merged_jobs", SHOW_JOBS + "merged_jobs"),
    "merge_interrupted": query("merged_jobs", SHOW_JOBS + "merged_jobs"),
    "page_quarantine": """
      SELECT o_orderkey || suffix AS id, NULL AS line, 'read' AS reason FROM orders, (VALUES ('a'), ('b')) AS s(suffix)
      WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      UNION ALL SELECT NULL, '{"count": 0}', 'no results' FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
      UNION ALL SELECT NULL, '{"results": [{"id": "x"', 'malformed' FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "merge_changed": """
      SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
        CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status, o_orderkey % 20 = 0 AS changed FROM orders""",
    "replace_interrupted": query("company_names", "SELECT CAST(company_id AS VARCHAR) AS company_id, company_name FROM company_names"),
    "append_retried": "SELECT doc_id, lang FROM documents WHERE doc_id % 3 < 2",
    "merge_jobstats": f"""
      WITH s AS (SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) AS job_id, l_returnflag, l_linestatus,
          CAST(weekofyear(l_shipdate) AS VARCHAR) AS week, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_returnflag, l_linestatus, CAST(weekofyear(l_shipdate) AS VARCHAR)) AS rn
          FROM lineitem) WHERE rn = 1),
        t AS (SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderstatus,
          CAST(weekofyear(o_orderdate) AS VARCHAR) AS week
          FROM orders WHERE o_orderdate < DATE '{CUTOFF}')
      SELECT coalesce(s.job_id, t.job_id) AS job_id, coalesce(l_returnflag, o_orderstatus) AS contract_type,
        coalesce(l_linestatus, 'old') AS contract_time, coalesce(s.week, t.week) AS posting_week
      FROM t FULL OUTER JOIN s ON t.job_id = s.job_id""",
    "merge_skills_catalogue": """
      SELECT CAST(p_partkey AS VARCHAR) AS skill_id, p_name || ' ' || edition AS skill_name,
        edition AS skill_type, p_type AS category, p_brand AS subcategory, CAST(NULL AS VARCHAR) AS description,
        p_type || ',' || p_brand AS tags, p_size > 25 AS is_soft_skill,
        'https://skills.example' AS info_url, '2025-01-01 00:00:00.000000' AS ingest_ts
      FROM (SELECT *, CASE WHEN p_size >= 10 THEN 'second' ELSE 'first' END AS edition FROM part)""",
    "company_presence": query("jobs_source", """
      SELECT DISTINCT company_id, location_id FROM jobs_source
      WHERE company_id IS NOT NULL AND location_id IS NOT NULL"""),
    "category_overlap": query("pair_counts", """
      SELECT category_label, CAST(rn - 1 AS INTEGER) AS rank, company_name, n AS jobs,
        CAST(total AS BIGINT) AS total_jobs
      FROM (SELECT *, row_number() OVER (PARTITION BY category_label ORDER BY n DESC, company_name) AS rn,
        sum(n) OVER (PARTITION BY category_label) AS total FROM pair_counts) WHERE rn <= 5"""),
    "petitions_clean": query("petitions", f"""
      SELECT fiscal_year, employer_name, naics_code, city, 'MA' AS state, CAST(zip AS VARCHAR) AS zip_code,
        {total(KINDS[:3], 'approval')} AS total_initial_approvals,
        {total(KINDS[:3], 'denial')} AS total_initial_denials,
        {total(KINDS[3:], 'approval')} AS total_continuing_approvals,
        {total(KINDS[3:], 'denial')} AS total_continuing_denials FROM petitions"""),
    "sponsorship_batch": query("petitions", batch("TRUE")),
    "sponsorship_merge": query("status_before later_batch", """
      SELECT coalesce(t.employer_name, s.employer_name) AS employer_name,
        CASE WHEN t.employer_name IS NULL THEN s.is_sponsor WHEN t.is_sponsor OR s.is_sponsor THEN TRUE
          ELSE nullif(t.is_sponsor, FALSE) END AS ever_sponsored_h1b,
        CASE WHEN t.employer_name IS NULL THEN s.fiscal_year WHEN s.employer_name IS NULL THEN t.fiscal_year
          ELSE greatest(t.fiscal_year, s.fiscal_year) END AS last_updated_fiscal_year
      FROM status_before t FULL OUTER JOIN later_batch s ON t.employer_name = s.employer_name"""),
    "normalize_names": query("company_names", f"""
      SELECT company_id, {normal('company_name')} AS clean_name FROM company_names"""),
    "name_mapping": query("mapping", "SELECT * FROM mapping"),
    "sponsor_companies": query("company_names mapping sponsor_status", """
      SELECT c.company_id, c.company_name, m.employer_name AS h1b_official_name,
        s.ever_sponsored_h1b AS is_sponsor, s.last_updated_fiscal_year
      FROM company_names c JOIN mapping m ON c.company_name = m.company_name
      JOIN sponsor_status s ON m.employer_name = s.employer_name WHERE s.ever_sponsored_h1b"""),
    "unprocessed_jobs": """
      SELECT d.doc_id, d.lang, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
      WHERE l.doc_id IS NULL""",
    "open_keys_bucketed": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "experience_years": rf"""
      SELECT event_id, nullif(regexp_extract(lower(text), '{EXPERIENCE}', 1), '') AS years FROM (
        SELECT event_id, CASE event_type WHEN 'click' THEN 'Needs ' || user_id || ' Years of work'
          WHEN 'view' THEN user_id || '+ yrs, or 2 years' WHEN 'signup' THEN 'min 5-' || user_id || ' years.'
          WHEN 'purchase' THEN user_id || ' - 7 year' ELSE user_id || 'years' END AS text FROM events)""",
    "skill_ngrams": query("hits", """
      SELECT job_id, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words, phrase FROM hits"""),
    "skill_tags": query("tags", """
      SELECT CAST(d.doc_id AS VARCHAR) AS job_id,
        coalesce(string_agg(t.skill_name, ',' ORDER BY t.skill_name), '') AS skills
      FROM documents d LEFT JOIN tags t ON t.job_id = CAST(d.doc_id AS VARCHAR) GROUP BY 1"""),
    "skill_tags_full_tokens": query("space_chosen token_chosen", """
      SELECT CAST(d.doc_id AS VARCHAR) AS job_id,
        coalesce(array_to_string(list_sort(list_distinct(list_transform(s.chosen, lambda c: c.p))), ','), '')
          AS by_spaces,
        coalesce(array_to_string(list_sort(list_distinct(list_transform(t.chosen, lambda c:
          replace(replace(c.p, ' - ', '-'), ' / ', '/')))), ','), '') AS by_tokens
      FROM documents d LEFT JOIN space_chosen s ON s.job_id = CAST(d.doc_id AS VARCHAR)
      LEFT JOIN token_chosen t ON t.job_id = CAST(d.doc_id AS VARCHAR)"""),
    "skill_rows": query("skill_rows", """
      SELECT source_job_id, skill_name, '2025-01-01T12:00:00' AS extraction_date,
        'phrases-1' AS model_version FROM skill_rows"""),
    "skills_dimension": query("skills", "SELECT * FROM skills"),
    "skill_bridge": query("skill_rows skills", """
      SELECT CAST(doc_id AS VARCHAR) AS job_id, 'S-the' AS skill_id FROM documents WHERE lang = 'en'
      UNION SELECT r.source_job_id, s.skill_id FROM skill_rows r JOIN skills s ON r.skill_name = s.skill_name"""),
    "enrichment_parse": query("valid_responses", PARSED),
    "enrich_incremental": query("valid_responses", PARSED + """
      WHERE job_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE text IS NOT NULL)
        AND job_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"""),
    "prompt_text": query("descriptions", f"""
      SELECT job_id, 'Title: ' || coalesce(title, 'None') || chr(10) || 'Description: '
        || coalesce(description, 'None') AS prompt,
        {cleaned("title || ' ' || description")} AS cluster_text FROM descriptions"""),
    "clean_text": f"""
      SELECT CAST(doc_id AS VARCHAR) AS job_id, {cleaned('text')} AS clean_text FROM documents""",
    "tfidf_terms": query("weights", "SELECT job_id, term, round(weight, 6) AS weight FROM weights"),
    "cluster_keywords": query("lang_keywords", """
      SELECT lang, CAST(rank AS INTEGER) AS rank, term, round(weight, 6) AS weight FROM lang_keywords"""),
    "cluster_names": query("lang_keywords", f"""
      SELECT lang, CASE lang WHEN 'de' THEN 'German roles' ELSE cluster_name END AS cluster_name, top_terms
      FROM ({named('lang_keywords', 'lang')})"""),
    "one_hot": query("category_jobs", """
      SELECT p.a AS category_label, nullif(p.b, '<null>') AS company_name, count(*) AS jobs,
        CAST(any_value(c.place) AS BIGINT) AS category_place,
        CAST((SELECT count(DISTINCT a) FROM category_jobs) + any_value(d.place) AS BIGINT) AS company_place
      FROM category_jobs p
      JOIN (SELECT a, row_number() OVER (ORDER BY a) - 1 AS place FROM (SELECT DISTINCT a FROM category_jobs)) c USING (a)
      JOIN (SELECT b, row_number() OVER (ORDER BY b = '<null>', b) - 1 AS place FROM (SELECT DISTINCT b FROM category_jobs)) d USING (b)
      GROUP BY 1, 2"""),
    "kmeans_vectors": "SELECT vec_id, TRUE AS nearest FROM embeddings",
    "kmeans_rounds": query("assigned_3", "SELECT vec_id, label AS cluster_id, round(off, 6) AS off FROM assigned_3"),
    "kmeans_category_rounds": query("pairs_3", """
      SELECT a AS category_label, nullif(b, '<null>') AS company_name, jobs, id AS cluster_id, round(off, 6) AS off FROM pairs_3"""),
    "kmeans_categories": query("category_jobs", """
      SELECT a AS category_label, nullif(b, '<null>') AS company_name, count(*) AS jobs, TRUE AS nearest
      FROM category_jobs GROUP BY 1, 2"""),
    "hybrid_clusters": query("descriptions", """
      SELECT job_id, TRUE AS counted, TRUE AS best, TRUE AS named FROM descriptions WHERE description IS NOT NULL"""),
    "silhouette_vectors": query("vector_score", "SELECT round(silhouette, 6) AS silhouette FROM vector_score"),
    "silhouette_categories": query(
        "category_score", "SELECT round(silhouette, 6) AS silhouette FROM category_score"),
    "silhouette_exact": query("vector_roots job_roots", f"""
      SELECT 'vectors' AS model, round(silhouette, 6) AS silhouette FROM ({silhouette("vector_roots", "vec_id", "1")})
      UNION ALL SELECT 'categories', round(silhouette, 6) FROM ({silhouette("job_roots", "job_id", "1")})"""),
    "model_select": query("vector_score category_score", """
      SELECT CASE WHEN v.silhouette >= c.silhouette THEN 'Embeddings' ELSE 'Categorical' END AS winner,
        round(greatest(v.silhouette, c.silhouette), 6) AS score FROM vector_score v, category_score c"""),
    "nearest_members": query("nearest", """
      SELECT cluster_id, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) AS distance FROM nearest"""),
    "cluster_samples": query("nearest", """
      SELECT cluster_id, CAST(to_json(list('job "' || vec_id || '"' ORDER BY rank)) AS VARCHAR) AS samples
      FROM nearest GROUP BY 1"""),
    "cluster_registry": query("members length_keywords", f"""
      SELECT CAST(i.id AS INTEGER) AS cluster_id, coalesce(k.cluster_name, 'Unpopulated Cluster') AS cluster_name,
        coalesce(k.top_terms, '') AS top_terms, coalesce(f.n, 0) AS job_count,
        round(f.low, 6) AS avg_salary_min, round(f.high, 6) AS avg_salary_max,
        'Embeddings_20250101' AS model_version, '2025-01-01T12:00:00' AS updated_at
      FROM range(10) i(id) LEFT JOIN (SELECT cluster_id, count(*) AS n, avg(salary_min) AS low,
        avg(salary_max) AS high FROM members GROUP BY 1) f ON f.cluster_id = i.id
      LEFT JOIN ({named('length_keywords', 'cluster_id')}) k ON k.cluster_id = i.id"""),
    "blank_vector": """
      SELECT CAST(doc_id AS VARCHAR) AS job_id, 3072 AS n_dims,
        CAST(CASE WHEN lang IN ('fr', 'es') OR regexp_matches(text, '^\\s*$') THEN 0 ELSE 1 END AS DOUBLE) AS norm
      FROM documents""",
    "stream_upsert": query("early_jobs late_jobs", SHOW_JOBS + f"({merged('early_jobs', 'late_jobs')})"),
    "star_stored": query("flat star_companies star_categories star_locations", """
      SELECT j.job_id, j.title, j.redirected_url, c.company_name AS company, j.category_label,
        k.category_label IS NOT NULL AS categorized, j.city, j.state, l.country, s.contract_type,
        '2025-01-01T12:00:00' AS ingest_data
      FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY title, description, salary_min, salary_max,
          created NULLS FIRST, redirected_url, company_name NULLS FIRST, category_label, city NULLS FIRST, state NULLS FIRST) AS rn
        FROM flat) j
      LEFT JOIN star_companies c ON j.company_name = c.company_name
      LEFT JOIN star_categories k ON j.category_label = k.category_label
      LEFT JOIN (SELECT coalesce(city, '') AS city, coalesce(state, '') AS state, min(coalesce(country, '')) AS country
        FROM star_locations GROUP BY 1, 2) l ON coalesce(j.city, '') = l.city AND coalesce(j.state, '') = l.state
      JOIN (SELECT job_id, arg_min(contract_type, (contract_type, contract_time)) AS contract_type FROM flat GROUP BY 1) s
        ON j.job_id = s.job_id
      WHERE rn = 1"""),
    "skills_stored": query("skill_rows", "SELECT source_job_id AS job_id, skill_name FROM skill_rows"),
    "sponsors_stored": query("petitions", f"""
      SELECT md5(s_name) AS company_id, s_name || ', Inc.' AS company_name, employer_name AS h1b_official_name,
        is_sponsor, fiscal_year AS last_updated_fiscal_year
      FROM supplier JOIN (SELECT *, {normal('employer_name')} AS k FROM ({batch('TRUE')})) b
        ON {normal("s_name || ', Inc.'")} = b.k WHERE is_sponsor"""),
    "enrichment_stored": query("valid_responses", f"""
      SELECT coalesce(e.job_id, x.job_id) AS job_id, e.years_experience_min, e.extracted_skills AS skills, x.n_dims, x.model_name
      FROM (SELECT * FROM ({PARSED}) WHERE job_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE text IS NOT NULL)) e
      FULL JOIN (SELECT CAST(vec_id AS VARCHAR) AS job_id, CAST(len(embedding) AS INTEGER) AS n_dims, 'm' AS model_name
        FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents WHERE text IS NOT NULL)) x ON e.job_id = x.job_id"""),
    "files_stored": "SELECT s_name AS company_name, 2 * count(*) AS copies FROM supplier GROUP BY 1",
    "dictionary_file": """
      SELECT n_nationkey, CASE WHEN n_regionkey < 3 THEN lower(n_name) ELSE '' END AS skills FROM nation""",
    "pages_stored": """
      SELECT o_orderkey || suffix AS id, o_orderpriority AS title, o_totalprice AS salary_max
      FROM orders, (VALUES ('a'), ('b')) AS s(suffix) WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "version_tag": """
      SELECT o_orderkey, 'Embeddings_' || strftime(o_orderdate, '%Y%m%d') AS model_version,
        strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS updated_at FROM orders""",
}
ORACLE["overlap_incremental"] = ORACLE["category_overlap"]
ORACLE["stream_star"] = ORACLE["star_stored"]
ORACLE["skill_tags_table"] = ORACLE["skill_tags"]
