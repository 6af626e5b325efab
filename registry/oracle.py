"""DuckDB SQL that computes each registered query's result independently.

The queries share named blocks. ``sql()`` puts the blocks a query needs, in
order, in front of its final SELECT.
"""

from __future__ import annotations

import re

from careerloom.schema import SECTORS

START, END, TEST, TOP_K = 1996, 2001, 2000, 5
VOCABULARY = ", ".join(f"'{s}'" for s in SECTORS)
BLANKS = " || ".join(f"chr({code})" for code in range(1, 33))


def clean(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), '[^A-Za-z0-9_ ]', '', 'g'))"


def year(date: str) -> str:
    head = f"split_part({date}, '-', 1)"
    return f"CASE WHEN regexp_full_match({head}, '[+-]?[0-9]+') THEN CAST(TRY_CAST({head} AS INTEGER) AS BIGINT) END"


BLOCKS = {
    # Inputs
    "people": """
        SELECT c_custkey AS pid, CAST(c_nationkey AS BIGINT) AS batch, c_name AS first_name,
               CASE WHEN c_custkey % 3 = 0 THEN concat('L', c_nationkey) END AS last_name,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'Unlisted'
                    WHEN c_custkey % 23 = 0 THEN ' & '
                    ELSE concat(c_mktsegment, ' & ', r_name) END AS industry,
               CASE WHEN c_custkey % 19 = 0 THEN NULL
                    WHEN c_custkey % 5 = 1 THEN concat('Old  State_', c_nationkey % 8, ' ', r_name)
                    WHEN c_custkey % 5 = 2 THEN r_name
                    ELSE concat('Greater ', n_name, ' Area') END AS location,
               CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'many'
                    WHEN c_acctbal > 5000 THEN '500+'
                    ELSE CAST(CAST(floor(abs(c_acctbal) / 10) AS INT) AS VARCHAR) END AS num_connections
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "skill": """
        SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY ord, line, skill) - 1 AS pos, skill
        FROM (SELECT DISTINCT l_orderkey // 10 AS pid, l_orderkey AS ord, l_linenumber AS line,
                     CASE WHEN (l_orderkey // 10) % 35 = 0 THEN concat('Rare ', l_orderkey // 10)
                          WHEN l_suppkey % 12 = 11 AND l_returnflag = 'R' THEN ' # '
                          WHEN l_returnflag = 'A' THEN concat('C++ ', l_suppkey % 12)
                          WHEN l_returnflag = 'N' THEN concat('R&D ', l_suppkey % 12)
                          ELSE concat('Sales ', l_suppkey % 12) END AS skill
              FROM lineitem)
        WHERE pid IN (SELECT pid FROM people)""",
    "position_raw": """
        SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY ord) - 1 AS pos,
               summary, title, start_date, end_date, is_current, company_name
        FROM (SELECT DISTINCT o_orderkey // 10 AS pid, o_orderkey AS ord,
                     concat('note ', o_orderkey) AS summary, o_orderpriority AS title,
                     CASE WHEN (o_custkey // 2) % 17 = 0 THEN NULL WHEN (o_custkey // 2) % 31 = 1 THEN 'n/a'
                          WHEN (o_custkey // 2) % 1009 = 7 THEN '12012-01-01'
                          WHEN (o_custkey // 2) % 5 = 0 THEN strftime(o_orderdate, '%Y/%m/01')
                          ELSE strftime(o_orderdate, '%Y-%m-01') END AS start_date,
                     CASE WHEN o_orderstatus = 'O' AND (o_custkey // 2) % 3 > 0 THEN NULL
                          WHEN (o_custkey // 2) % 37 = 2 THEN 'present'
                          WHEN (o_custkey // 2) % 1009 = 12 THEN '2050-01-01'
                          WHEN (o_custkey // 2) % 1009 = 13 THEN '99999999999-01-01'
                          ELSE concat(year(o_orderdate) + (o_custkey // 2) % 4 - 1, '-06-01') END AS end_date,
                     o_orderstatus = 'O' AS is_current,
                     CASE WHEN (o_custkey // 2) % 19 = 3 THEN NULL
                          ELSE concat('Company ', o_custkey % 50) END AS company_name
              FROM orders)
        WHERE pid IN (SELECT pid FROM people)""",
    "lookup": """
        SELECT concat(segment, ' & ', r_name) AS industry,
               CASE WHEN segment = 'AUTOMOBILE' THEN 'AUTOMOTIVE'
                    WHEN segment = 'BUILDING' AND r_name IN ('ASIA', 'AFRICA', 'AMERICA') THEN 'CONSTRUCTION'
                    WHEN segment = 'BUILDING' THEN 'REAL_ESTATE'
                    WHEN segment = 'FURNITURE' THEN 'CONSUMER_PRODUCTS'
                    WHEN segment = 'HOUSEHOLD' THEN 'RETAIL_WHOLESALE'
                    WHEN r_name IN ('EUROPE', 'ASIA') THEN 'TECHNOLOGY'
                    WHEN r_name = 'AMERICA' THEN 'OFF_THE_LIST' ELSE 'MANUFACTURING' END AS sector
        FROM region,
             (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS segment)""",
    "place": """
        SELECT token, arg_max(country, line_no * 10 + role) AS country
        FROM (SELECT n_nationkey AS line_no, 0 AS role, r_name AS country, r_name AS token
              FROM nation JOIN region ON r_regionkey = n_regionkey
              UNION ALL SELECT n_nationkey, 1, r_name, concat('State_', n_nationkey % 8)
              FROM nation JOIN region ON r_regionkey = n_regionkey
              UNION ALL SELECT n_nationkey, 2, r_name, n_name
              FROM nation JOIN region ON r_regionkey = n_regionkey)
        GROUP BY token""",
    # Tags
    "skill_tag": f"""
        SELECT pid, batch, {clean('skill')} AS tag, {clean('industry')} AS industry
        FROM skill JOIN people USING (pid)
        WHERE {clean('skill')} <> '' AND {clean('industry')} <> ''""",
    "tag_list": """
        SELECT batch, tag, string_agg(industry, '|' ORDER BY industry) AS industries
        FROM (SELECT DISTINCT batch, tag, industry FROM skill_tag) GROUP BY batch, tag""",
    "row_sector": f"""
        SELECT DISTINCT batch, tag, sector
        FROM skill_tag JOIN (SELECT {clean('industry')} AS industry, sector FROM lookup) USING (industry)""",
    "tag_count": "SELECT tag, sector, count(*) AS n_rows FROM row_sector GROUP BY tag, sector",
    "tag_sector": """
        SELECT tag, sector, n_rows FROM tag_count
        QUALIFY row_number() OVER (PARTITION BY tag ORDER BY n_rows DESC, sector) = 1""",
    "top_tag": f"""
        SELECT sector, tag, rank FROM (
            SELECT sector, tag, row_number() OVER (PARTITION BY sector ORDER BY n_rows DESC, tag) AS rank
            FROM tag_count) WHERE rank <= {TOP_K}""",
    # Sectors of people
    "skill_sector": """
        SELECT pid, pos, skill, sector FROM skill JOIN tag_sector ON tag = skill""",
    "dominant": """
        SELECT pid, sector FROM (SELECT pid, sector, count(*) AS c, max(pos) AS last FROM skill_sector GROUP BY pid, sector)
        QUALIFY row_number() OVER (PARTITION BY pid ORDER BY c DESC, last) = 1""",
    "assigned": """
        SELECT people.*, coalesce(lookup.sector, dominant.sector) AS sector
        FROM people LEFT JOIN lookup USING (industry) LEFT JOIN dominant USING (pid)""",
    # Positions
    "position_clean": f"""
        SELECT pid, pos, CASE WHEN start_date IS NULL THEN summary END AS summary, title,
               replace(start_date, '/', '-') AS start_date,
               CASE WHEN start_date IS NULL THEN end_date ELSE replace(end_date, '/', '-') END AS end_date,
               is_current, company_name
        FROM position_raw""",
    "dated": f"""
        SELECT * FROM (
            SELECT pid, pos, title, company_name,
                   CASE WHEN from_year < {START} THEN {START} ELSE from_year END AS from_year,
                   CASE WHEN end_date IS NULL THEN {END} ELSE to_year END AS to_year
            FROM (SELECT *, {year('start_date')} AS from_year, {year('end_date')} AS to_year FROM position_clean))
        WHERE from_year IS NOT NULL AND to_year IS NOT NULL""",
    "position_year": """
        SELECT pid, pos, title, company_name, unnest(range(from_year, to_year + 1)) AS year FROM dated""",
    "span": "SELECT pid, min(from_year) AS first, max(to_year) AS last FROM dated GROUP BY pid",
    "span_year": "SELECT pid, first, unnest(range(first, last + 1)) AS year FROM span",
    "panel": """
        SELECT s.pid, s.year, s.year - s.first AS relevant_experience, count(p.pid) AS n_positions,
               coalesce(string_agg(p.title, '|' ORDER BY p.pos), '') AS titles,
               coalesce(arg_max(coalesce(p.title, ''), p.pos), '') AS last_title,
               coalesce(arg_max(coalesce(p.company_name, ''), p.pos), '') AS last_company
        FROM span_year s LEFT JOIN position_year p ON p.pid = s.pid AND p.year = s.year
        GROUP BY s.pid, s.year, s.first""",
    "store": f"""
        SELECT y.year, a.pid, coalesce(sector, '') AS sector, coalesce(first_name, '') AS first_name,
               coalesce(last_name, '') AS last_name,
               coalesce(replace(num_connections, '+', ''), '0') AS num_connections,
               coalesce(location, '') AS location, 0 AS rel_experience,
               coalesce(last_title, '') AS last_title, coalesce(last_company, '') AS last_company
        FROM (SELECT pid, year FROM panel
              UNION ALL SELECT pid, 0 FROM people WHERE pid NOT IN (SELECT pid FROM dated)) y
        JOIN assigned a USING (pid) LEFT JOIN panel p ON p.pid = y.pid AND p.year = y.year""",
    "token": """
        SELECT pid, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS token
        FROM (SELECT pid, string_split(rtrim(location, ' '), ' ') AS words FROM people WHERE location IS NOT NULL)""",
    "country": """
        SELECT pid, arg_min(country, pos) AS country FROM token JOIN place USING (token) GROUP BY pid""",
    # Learning
    "label": """
        SELECT pid, year, relevant_experience,
               CASE WHEN n_positions >= 2 THEN 'YES' WHEN n_positions = 1 THEN 'NO' END AS label FROM panel""",
    "flag": f"""
        SELECT pid, {', '.join(
            f"max(CASE WHEN rank = {i} THEN has END) AS tag_{i}" for i in range(1, TOP_K + 1))}
        FROM (SELECT a.pid, t.rank, CAST(count(s.skill) > 0 AS BIGINT) AS has
              FROM assigned a JOIN top_tag t USING (sector)
              LEFT JOIN skill s ON s.pid = a.pid AND s.skill = t.tag GROUP BY a.pid, t.rank) GROUP BY pid""",
    "feature": f"""
        SELECT pid, sector, year, coalesce(TRY_CAST(replace(num_connections, '+', '') AS BIGINT), 0) AS connections,
               relevant_experience AS experience, {', '.join(f'tag_{i}' for i in range(1, TOP_K + 1))}, label
        FROM label JOIN assigned USING (pid) LEFT JOIN flag USING (pid) WHERE sector IS NOT NULL""",
    "model": f"""
        SELECT sector, year AS model_year, label, count(*) AS n_rows,
               avg(connections) AS m1, stddev_pop(connections) AS s1,
               avg(experience) AS m2, stddev_pop(experience) AS s2,
               {', '.join(f'CAST(sum(tag_{i}) AS BIGINT) AS k{i}' for i in range(1, TOP_K + 1))}
        FROM feature WHERE label IS NOT NULL AND year <> {TEST} AND sector IN ({VOCABULARY})
        GROUP BY sector, year, label""",
    "likelihood": f"""
        SELECT t.pid, t.sector, t.label AS actual, m.model_year, m.label,
               ln(n_rows + 1) - ln(greatest(s1, 1 / 6.0)) - 0.5 * ((connections - m1) / greatest(s1, 1 / 6.0)) ^ 2
               - ln(greatest(s2, 1 / 6.0)) - 0.5 * ((experience - m2) / greatest(s2, 1 / 6.0)) ^ 2
               + ln((n_rows + 1) / (n_rows + {len(SECTORS)}.0))
               + {' + '.join(f'''CASE WHEN tag_{i} IS NULL THEN 0 WHEN tag_{i} = 1 THEN ln((k{i} + 1) / (n_rows + 2.0))
                 ELSE ln((n_rows - k{i} + 1) / (n_rows + 2.0)) END''' for i in range(1, TOP_K + 1))} AS ll
        FROM feature t JOIN model m ON m.sector = t.sector WHERE t.year = {TEST}""",
    "scored": """
        SELECT pid, model_year,
               CASE WHEN no IS NULL THEN 'YES' WHEN yes IS NULL THEN 'NO'
                    WHEN no - yes > 1e-9 THEN 'NO' ELSE 'YES' END AS predicted
        FROM (SELECT pid, model_year, max(CASE WHEN label = 'YES' THEN ll END) AS yes,
                     max(CASE WHEN label = 'NO' THEN ll END) AS no FROM likelihood GROUP BY pid, model_year)""",
    "voted": f"""
        SELECT pid, sector, label, votes, CASE WHEN votes > 0 THEN 'NO' ELSE 'YES' END AS predicted
        FROM (SELECT f.pid, f.sector, f.label,
                     CAST(coalesce(sum(CASE s.predicted WHEN 'NO' THEN 1 WHEN 'YES' THEN -1 END), 0) AS BIGINT) AS votes
              FROM feature f LEFT JOIN scored s USING (pid) WHERE f.year = {TEST}
              GROUP BY f.pid, f.sector, f.label)""",
    # Text lines
    "array_line": """
        SELECT pid // 3 AS line_no, * FROM people WHERE (pid // 3) % 11 NOT IN (1, 2, 3, 4)""",
    "bad_year_pid": f"""
        SELECT DISTINCT pid FROM (
            SELECT *, {year('start_date')} AS y1, {year('end_date')} AS y2 FROM position_clean)
        WHERE start_date IS NOT NULL AND (y1 IS NULL OR (end_date IS NOT NULL AND y2 IS NULL))""",
    "outcome": """
        SELECT 'profile' AS kind, count(*) AS n, 0 AS n_lines, count(industry) AS n_industries FROM array_line
        UNION ALL
        SELECT reason, count(*), count(*), 0 FROM (
            SELECT CASE WHEN line_no % 11 = 1 THEN 'malformed' WHEN line_no % 11 = 4 THEN 'other_layout'
                        WHEN line_no % 11 IN (2, 3) THEN NULL WHEN bad THEN 'bad_year' END AS reason
            FROM (SELECT pid // 3 AS line_no, bool_or(pid IN (SELECT pid FROM bad_year_pid)) AS bad
                  FROM people GROUP BY 1))
        WHERE reason IS NOT NULL GROUP BY reason""",
    "skill_list": "SELECT pid, string_agg(skill, '|' ORDER BY pos) AS skills, count(*) AS n_skills FROM skill GROUP BY pid",
    "position_list": """
        SELECT pid, string_agg(start_date, '|' ORDER BY pos) AS start_dates,
               string_agg(end_date, '|' ORDER BY pos) AS end_dates,
               string_agg(company_name, '|' ORDER BY pos) AS companies,
               count(*) FILTER (is_current) AS n_current
        FROM position_raw GROUP BY pid""",
    "clean_list": """
        SELECT pid, string_agg(start_date, '|' ORDER BY pos) AS start_dates, count(summary) AS n_summaries
        FROM position_clean GROUP BY pid""",
}

_MODEL_OUTPUT = f"""
    SELECT sector, model_year, label, n_rows, round(m1, 4) AS mean_connections, round(s1, 4) AS sd_connections,
           round(m2, 4) AS mean_experience, round(s2, 4) AS sd_experience,
           concat_ws('|', {', '.join(f'k{i}' for i in range(1, TOP_K + 1))}) AS tag_counts FROM model"""

SELECTS = {
    "read_profile_arrays": """
        SELECT line_no, first_name, last_name, industry, location, num_connections,
               coalesce(skills, '') AS skills, coalesce(start_dates, '') AS start_dates,
               coalesce(companies, '') AS companies, coalesce(n_current, 0) AS n_current
        FROM array_line LEFT JOIN skill_list USING (pid) LEFT JOIN position_list USING (pid)""",
    "read_profile_arrays_strict": """
        SELECT line_no, first_name, last_name, industry, location, num_connections,
               coalesce(skills, '') AS skills, coalesce(start_dates, '') AS start_dates,
               coalesce(companies, '') AS companies, coalesce(n_current, 0) AS n_current
        FROM array_line LEFT JOIN skill_list USING (pid) LEFT JOIN position_list USING (pid)
        WHERE line_no % 13 NOT IN (5, 6)""",
    "rejected_lines_strict": """
        SELECT reason, count(*) AS n_lines FROM (
            SELECT CASE WHEN line_no % 11 = 1 THEN 'malformed' WHEN line_no % 11 = 4 THEN 'other_layout'
                        WHEN line_no % 11 IN (2, 3) THEN NULL
                        WHEN line_no % 13 = 5 THEN 'trailing_text' WHEN line_no % 13 = 6 THEN 'wrong_type'
                        WHEN bad THEN 'bad_year' END AS reason
            FROM (SELECT pid // 3 AS line_no, bool_or(pid IN (SELECT pid FROM bad_year_pid)) AS bad
                  FROM people GROUP BY 1))
        WHERE reason IS NOT NULL GROUP BY reason""",
    "parse_lines": """
        SELECT * FROM outcome
        UNION ALL
        SELECT 'observed profiles', sum(n) FILTER (kind = 'profile')::BIGINT, NULL, NULL FROM outcome
        UNION ALL
        SELECT 'observed rejects', sum(n) FILTER (kind <> 'profile')::BIGINT, NULL, NULL FROM outcome""",
    "read_profile_objects": """
        SELECT pid, first_name, industry, coalesce(skills, '') AS skills,
               coalesce(end_dates, '') AS end_dates, CAST(1 AS BIGINT) AS raw_line_kept
        FROM people LEFT JOIN skill_list USING (pid) LEFT JOIN position_list USING (pid)
        WHERE pid % 31 NOT IN (1, 2, 3, 4)""",
    "rejected_lines": """
        SELECT layout, reason, count(*) AS n_lines FROM (
            SELECT 'array' AS layout,
                   CASE line_no % 11 WHEN 1 THEN 'malformed' WHEN 4 THEN 'other_layout'
                        ELSE 'bad_year' END AS reason
            FROM (SELECT pid // 3 AS line_no, bool_or(pid IN (SELECT pid FROM bad_year_pid)) AS bad
                  FROM people GROUP BY 1)
            WHERE line_no % 11 IN (1, 4) OR (bad AND line_no % 11 NOT IN (2, 3))
            UNION ALL
            SELECT 'object', CASE pid % 31 WHEN 1 THEN 'malformed' WHEN 4 THEN 'other_layout' ELSE 'bad_year' END
            FROM people
            WHERE pid % 31 IN (1, 4) OR (pid % 31 NOT IN (2, 3) AND pid IN (SELECT pid FROM bad_year_pid)))
        GROUP BY layout, reason""",
    "lookup_pairs": """
        SELECT concat(c_mktsegment, ' ', c_nationkey) AS key, arg_max(concat('v', c_custkey % 10), c_custkey) AS value
        FROM customer WHERE c_custkey % 17 <> 0 GROUP BY 1""",
    "lookup_lists": 'SELECT tag AS key, arg_max(industries, batch) AS "values" FROM tag_list GROUP BY tag',
    "place_lookup": """
        SELECT token, arg_max(country, line_no * 10 + role) AS country FROM (
            SELECT c_custkey AS line_no, concat('Land_', c_nationkey) AS country, role,
                   CASE role WHEN 0 THEN concat('Land_', c_nationkey)
                        WHEN 1 THEN CASE WHEN c_custkey % 17 = 1 THEN NULL ELSE concat('State_', c_custkey % 41) END
                        ELSE concat('City_', c_custkey % 97) END AS token
            FROM customer, (SELECT unnest([0, 1, 2]) AS role) WHERE c_custkey % 17 <> 0)
        WHERE token IS NOT NULL GROUP BY token""",
    "read_matching_files": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    "write_key_list": """
        SELECT concat(tag, ',', string_agg(industry, ',' ORDER BY industry)) AS value
        FROM (SELECT DISTINCT tag, industry FROM skill_tag) GROUP BY tag""",
    "write_named_outputs": """
        SELECT 'tagsector' AS output, concat(tag, ',', sector) AS value FROM tag_sector
        UNION ALL SELECT 'toptags', concat(sector, ',', string_agg(tag, ',' ORDER BY rank))
        FROM top_tag GROUP BY sector""",
    "write_profile_json": """
        SELECT first_name, sector AS industry, coalesce(replace(num_connections, '+', ''), '0') AS num_connections,
               coalesce(n_skills, 0) AS n_skills, coalesce(start_dates, '') AS start_dates,
               coalesce(n_summaries, 0) AS n_summaries
        FROM assigned LEFT JOIN skill_list USING (pid) LEFT JOIN clean_list USING (pid)""",
    "model_store": _MODEL_OUTPUT,
    "model_load": _MODEL_OUTPUT + " WHERE sector IN ('AUTOMOTIVE', 'TECHNOLOGY')",
    "year_store_write": "SELECT year, sector, count(*) AS n_rows FROM store GROUP BY year, sector",
    "year_store_scan": f"""
        SELECT pid, first_name, last_name, num_connections, sector AS industry, location,
               last_title AS title, last_company AS company_name, CAST(year AS VARCHAR) AS start_date
        FROM store WHERE year = {TEST} AND sector <> '' AND location <> ''""",
    "clean_tag": f"""
        SELECT pid, pos, {clean('skill')} AS tag, {clean('industry')} AS industry FROM skill JOIN people USING (pid)""",
    "drop_blank": f"""
        SELECT pid, pos, industry, skill FROM skill JOIN people USING (pid)
        WHERE trim(coalesce(industry, '')) <> '' AND trim(skill) <> '' AND {clean('skill')} <> ''""",
    "explode_skill_tags": "SELECT pid, tag, industry FROM skill_tag",
    "explode_title_tags": f"""
        SELECT pid, {clean('title')} AS tag, {clean('industry')} AS industry
        FROM position_raw JOIN people USING (pid) WHERE {clean('industry')} <> '' AND {clean('title')} <> ''""",
    "clean_connections": """
        SELECT pid, coalesce(replace(num_connections, '+', ''), '0') AS num_connections,
               coalesce(TRY_CAST(replace(num_connections, '+', '') AS BIGINT), 0) AS connections FROM people""",
    "normalize_dates": "SELECT pid, pos, start_date, end_date FROM position_clean",
    "date_year": f"""
        SELECT pid, pos, {year('start_date')} AS from_year, {year('end_date')} AS to_year FROM position_raw""",
    "position_interval": "SELECT pid, pos, from_year, to_year FROM dated",
    "position_interval_current": f"""
        SELECT * FROM (
            SELECT pid, pos, greatest({year('start_date')}, {START}) AS from_year,
                   CASE WHEN is_current THEN {END} ELSE {year('end_date')} END AS to_year
            FROM position_raw WHERE ({year('start_date')}) IS NOT NULL)
        WHERE to_year IS NOT NULL""",
    "prune_profile": """
        SELECT pid, sector AS industry, coalesce(replace(num_connections, '+', ''), '0') AS num_connections,
               pos, summary, start_date, end_date, company_name
        FROM assigned LEFT JOIN position_clean USING (pid)""",
    "require_sector": "SELECT pid, sector FROM assigned WHERE sector IS NOT NULL",
    "valid_sector": f"""
        SELECT pid, coalesce(sector, industry) AS sector FROM assigned
        WHERE coalesce(sector, industry) IN ({VOCABULARY})""",
    "active_in_year": f"SELECT DISTINCT pid FROM dated WHERE from_year <= {TEST} AND to_year >= {TEST}",
    "location_tokens": "SELECT pid, pos, token FROM token",
    "parse_tag_line": "SELECT batch, tag, industries FROM tag_list",
    "industry_sector_join": "SELECT pid, industry, sector FROM people JOIN lookup USING (industry)",
    "assign_sector": "SELECT pid, sector FROM assigned",
    "skill_sector_join": "SELECT pid, pos, skill, sector FROM skill_sector",
    "resolve_country": "SELECT pid, country FROM country",
    "attach_top_tags": """
        SELECT pid, sector, coalesce(tags, '') AS tags FROM assigned
        LEFT JOIN (SELECT sector, string_agg(tag, '|' ORDER BY rank) AS tags FROM top_tag GROUP BY sector)
        USING (sector)""",
    "score_join": f"""
        SELECT pid, sector, model_year FROM (SELECT pid, sector FROM feature WHERE year = {TEST})
        LEFT JOIN (SELECT DISTINCT sector, model_year FROM model) USING (sector)""",
    "position_years": "SELECT pid, pos AS position_no, year FROM position_year",
    "profile_year_panel": "SELECT pid, year, relevant_experience, n_positions, titles FROM panel",
    "last_known_position": "SELECT pid, year, last_title, last_company FROM panel",
    "year_store_rows": """
        SELECT year, pid, sector, first_name, last_name, num_connections, location,
               CAST(rel_experience AS BIGINT) AS rel_experience, last_title, last_company FROM store""",
    "tag_industries": """
        SELECT tag, string_agg(industry, '|' ORDER BY industry) AS industries
        FROM (SELECT DISTINCT tag, industry FROM skill_tag) GROUP BY tag""",
    "tag_row_sectors": "SELECT batch, tag, sector FROM row_sector",
    "top_sector_per_tag": "SELECT tag, sector, n_rows FROM tag_sector",
    "top_tags_per_sector": "SELECT sector, string_agg(tag, '|' ORDER BY rank) AS tags FROM top_tag GROUP BY sector",
    "dominant_skill_sector": "SELECT pid, sector FROM dominant",
    "position_year_counts": f"""
        SELECT year, count(*) AS n_positions FROM (
            SELECT unnest(range(greatest({year('start_date')}, {START}),
                                CASE WHEN is_current THEN {END} ELSE {year('end_date')} END + 1)) AS year
            FROM position_raw
            WHERE ({year('start_date')}) IS NOT NULL AND (is_current OR ({year('end_date')}) IS NOT NULL))
        GROUP BY year""",
    "sector_country_active": f"""
        SELECT sector, country, count(*) AS n_profiles FROM assigned JOIN country USING (pid)
        WHERE sector IS NOT NULL AND pid IN (SELECT pid FROM dated WHERE from_year <= {TEST} AND to_year >= {TEST})
        GROUP BY sector, country""",
    "year_store_keys": f"""
        SELECT year, sector, pid, first_name, last_title, location FROM store WHERE year = {TEST} AND sector = 'TECHNOLOGY'""",
    "sector_country_span": f"""
        SELECT sector, country, count(*) AS n_profiles FROM store JOIN country USING (pid)
        WHERE year = {TEST} AND sector <> '' GROUP BY sector, country""",
    "token_frequency": f"""
        SELECT token, count(*) AS n FROM (
            SELECT trim(unnest(string_split_regex(text, '[ \\r\\n]')), {BLANKS}) AS token FROM documents)
        WHERE token <> '' GROUP BY token""",
    "line_count": """
        SELECT CAST(sum(CASE WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), ''))
                        + CASE WHEN right(text, 1) = chr(10) THEN 0 ELSE 1 END END) AS BIGINT) AS n_lines
        FROM documents""",
    "null_sector_count": """
        SELECT count(*) AS n_rows, count(DISTINCT pid) AS n_profiles FROM panel JOIN assigned USING (pid)
        WHERE sector IS NULL""",
    "year_store_row_count": "SELECT count(*) AS n_rows FROM store",
    "sector_year_order": """
        SELECT pid, sector, year, dense_rank() OVER (PARTITION BY sector ORDER BY year) AS group_no
        FROM panel JOIN assigned USING (pid) WHERE sector IS NOT NULL""",
    "label_multi_position": "SELECT pid, year, label FROM label",
    "feature_rows": f"""
        SELECT pid, sector, year, connections, experience,
               {', '.join(f'tag_{i}' for i in range(1, TOP_K + 1))}, label FROM feature""",
    "split_by_year": f"""
        SELECT CASE WHEN year = {TEST} THEN 'test' ELSE 'train' END AS part, year, count(*) AS n_rows
        FROM panel GROUP BY year""",
    "train_sector_year_nb": _MODEL_OUTPUT,
    "merge_models": _MODEL_OUTPUT,
    "score_nb": "SELECT pid, model_year, predicted FROM scored",
    "vote": "SELECT pid, sector, votes, predicted FROM voted",
    "confusion_counts": """
        SELECT count(*) FILTER (label = 'NO' AND predicted = 'NO') AS true_positive,
               count(*) FILTER (label = 'YES' AND predicted = 'YES') AS true_negative,
               count(*) FILTER (label = 'YES' AND predicted = 'NO') AS false_positive,
               count(*) FILTER (label = 'NO' AND predicted = 'YES') AS false_negative FROM voted""",
    "sector_prediction_summary": """
        SELECT sector, count(*) AS test_size, count(*) FILTER (label = 'NO') AS actual_left,
               count(*) FILTER (label IS NOT NULL AND predicted = 'NO') AS predict_left
        FROM voted GROUP BY sector""",
}
SELECTS["predict_pipeline"] = SELECTS["sector_prediction_summary"]


def _needed(text: str, found: set[str]) -> None:
    for name in BLOCKS:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            found.add(name)
            _needed(BLOCKS[name], found)


def sql(name: str) -> str:
    found: set[str] = set()
    _needed(SELECTS[name], found)
    # Counts of tags are joined to skills again; they are computed once.
    once = {"skill", "tag_count", "tag_sector"}
    blocks = [
        f"{block} AS {'MATERIALIZED ' if block in once else ''}({text})" for block, text in BLOCKS.items() if block in found
    ]
    return (f"WITH {', '.join(blocks)} " if blocks else "") + SELECTS[name]
