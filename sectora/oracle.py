"""DuckDB oracle: the fixture tables as SQL CTEs over the driver's views, plus helpers.

Each oracle query is ``WITH <fixture CTEs>, ... SELECT ...`` and must give the same rows,
column names and values as the Spark query of the same key. The fixture rules are the
ones in ``sectora.sources.fixtures``.
"""

from __future__ import annotations

FIXTURE_CTES = """
cust AS (
  SELECT c.c_custkey, c.c_acctbal, c.c_mktsegment, n.n_name, CAST(n.n_regionkey AS BIGINT) AS org_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
ord AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority, c.org_id
  FROM orders o JOIN cust c ON o.o_custkey = c.c_custkey
),
regions AS (SELECT CAST(r_regionkey AS BIGINT) AS org_id, r_name FROM region),
src_section AS (
  SELECT * FROM (VALUES (1::BIGINT, 'Profile', false, true), (2::BIGINT, 'Orders', NULL::BOOLEAN, NULL::BOOLEAN),
                        (3::BIGINT, 'Archived', false, false), (4::BIGINT, 'Removed', true, true),
                        (5::BIGINT, 'Empty', false, true)) t(id, name, is_deleted, is_active)
),
src_profile AS (
  SELECT s.sid * 1000000000 + c.c_custkey AS id, s.sid AS section_id, c.c_custkey AS provider_id, c.org_id,
         CASE WHEN c.c_custkey % 11 = 0 THEN true WHEN c.c_custkey % 7 = 0 THEN NULL ELSE false END AS is_deleted
  FROM cust c CROSS JOIN (VALUES (1::BIGINT), (3::BIGINT), (4::BIGINT), (5::BIGINT)) s(sid)
  UNION ALL
  SELECT 2000000000 + o.o_orderkey, 2::BIGINT, o.o_custkey, o.org_id,
         CASE WHEN o.o_orderkey % 11 = 0 THEN true WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE false END
  FROM ord o
),
src_attribute AS (
  SELECT t.base + r.org_id * 1000 AS id, t.name, t.section_id, r.org_id, t.type
  FROM regions r CROSS JOIN (VALUES (101::BIGINT, 'segment', 1::BIGINT, 'select'), (102, 'balance', 1, 'number'),
       (103, 'nation', 1, 'text'), (104, 'never filled', 1, 'text'), (201, 'status', 2, 'select'),
       (202, 'priority', 2, 'text'), (203, 'total', 2, 'number'), (301, 'archived note', 3, 'text')) t(base, name, section_id, type)
  UNION ALL SELECT 9001, 'orphan', NULL, org_id, 'text' FROM regions WHERE org_id = 0
  UNION ALL SELECT 9002, 'no org', 1, NULL, 'text' FROM regions WHERE org_id = 0
),
src_option AS (
  SELECT DISTINCT 101 + org_id * 1000 AS attribute_id, c_mktsegment AS value FROM cust
  UNION ALL SELECT * FROM (SELECT DISTINCT 201 + org_id * 1000, o_orderstatus FROM ord)
  UNION ALL SELECT 101 + org_id * 1000, min(c_mktsegment) FROM cust GROUP BY org_id
  UNION ALL SELECT 102 + org_id * 1000, NULL FROM regions
  UNION ALL SELECT NULL, 'ORPHAN OPTION' FROM regions WHERE org_id = 0
),
src_value AS (
  SELECT 1000000000 + c_custkey AS provider_profile_id, 101 + org_id * 1000 AS attribute_id, c_mktsegment AS value FROM cust
  UNION ALL SELECT 1000000000 + c_custkey, 102 + org_id * 1000,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END FROM cust
  UNION ALL SELECT 1000000000 + c_custkey, 103 + org_id * 1000, n_name FROM cust
  UNION ALL SELECT 1000000000 + c_custkey, 101 + org_id * 1000, 'ZZ_' || c_mktsegment FROM cust WHERE c_custkey % 13 = 0
  UNION ALL SELECT 1000000000 + c_custkey, 201 + org_id * 1000, 'FOREIGN' FROM cust WHERE c_custkey % 19 = 0
  UNION ALL SELECT NULL, 101 + org_id * 1000, 'NO RECORD' FROM cust WHERE c_custkey % 23 = 0
  UNION ALL SELECT 1000000000 + c_custkey, NULL, 'NO ATTRIBUTE' FROM cust WHERE c_custkey % 29 = 0
  UNION ALL SELECT 3000000000 + c_custkey, 301 + org_id * 1000, 'archived ' || c_mktsegment FROM cust
  UNION ALL SELECT 2000000000 + o_orderkey, 201 + org_id * 1000, o_orderstatus FROM ord
  UNION ALL SELECT 2000000000 + o_orderkey, 202 + org_id * 1000, o_orderpriority FROM ord
  UNION ALL SELECT 2000000000 + o_orderkey, 203 + org_id * 1000, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) FROM ord
),
records AS (
  SELECT id AS record_id, section_id, provider_id, org_id, is_deleted AS record_is_deleted FROM src_profile
),
sections AS (
  SELECT id AS section_id, name AS section_name, is_deleted AS section_is_deleted, is_active AS section_is_active FROM src_section
),
attributes AS (
  SELECT id AS attribute_id, name AS attribute_name, section_id, org_id, type AS attribute_type
  FROM src_attribute WHERE section_id IS NOT NULL AND id IS NOT NULL
),
options AS (
  SELECT attribute_id, value AS attribute_option_value FROM src_option
  WHERE attribute_id IS NOT NULL AND value IS NOT NULL
),
vals AS (
  SELECT provider_profile_id AS record_id, attribute_id, value FROM src_value
  WHERE provider_profile_id IS NOT NULL AND attribute_id IS NOT NULL
),
active_records AS (SELECT * FROM records WHERE record_is_deleted IS NULL OR record_is_deleted = false),
active_sections AS (
  SELECT * FROM sections
  WHERE (section_is_deleted IS NULL OR section_is_deleted = false) AND (section_is_active IS NULL OR section_is_active = true)
),
ctx AS (
  SELECT r.record_id, r.org_id, r.section_id, s.section_name, r.provider_id
  FROM active_records r JOIN active_sections s ON r.section_id = s.section_id
),
vctx AS (
  SELECT c.org_id, c.section_id, v.record_id, v.attribute_id, v.value
  FROM vals v JOIN ctx c ON v.record_id = c.record_id
),
defined AS (SELECT DISTINCT org_id, section_id, attribute_id FROM attributes WHERE org_id IS NOT NULL),
kv AS (
  SELECT v.record_id, v.org_id, v.section_id, v.attribute_id, min(v.value) AS value
  FROM vctx v JOIN defined d ON v.org_id = d.org_id AND v.section_id = d.section_id AND v.attribute_id = d.attribute_id
  WHERE v.value IS NOT NULL
  GROUP BY v.record_id, v.org_id, v.section_id, v.attribute_id
),
owners AS (
  @OWNERS@
),
src_reports AS (
  SELECT r.owner * 100 + k.k AS report_id, CAST(r.org_id AS VARCHAR) AS org_id,
         'Report ' || CAST(k.k AS VARCHAR) || ' ' || r.r_name AS name,
         'definition ' || CAST(k.k AS VARCHAR) AS description, k.status,
         TIMESTAMP '2026-01-01 00:00:00' + to_hours(r.owner % 1000 * 100 + k.k) AS created_at,
         TIMESTAMP '2026-01-01 00:00:00' + to_days(60 + k.k % 3) AS updated_at,
         CASE WHEN k.status = 'completed' THEN TIMESTAMP '2026-01-01 00:00:00' + to_days(1) + to_hours(r.owner % 1000 * 100 + k.k) END AS last_run_date
  FROM owners r CROSS JOIN (VALUES (1::BIGINT, 'completed'), (2, 'created'), (3, 'created'), (4, 'completed'), (5, 'created')) k(k, status) WHERE r.only IS NULL OR r.only = k.k
),
src_report_sections AS (
  SELECT r.owner * 100 + t.k AS report_id, CAST(r.org_id AS VARCHAR) AS org_id, CAST(t.sid AS INTEGER) AS section_id
  FROM owners r CROSS JOIN (VALUES (1::BIGINT, 1::BIGINT), (1, 2), (2, 2), (2, 5), (3, 1), (4, 1), (5, 1)) t(k, sid) WHERE r.only IS NULL OR r.only = t.k
),
src_report_attributes AS (
  SELECT r.owner * 100 + t.k AS report_id, CAST(r.org_id AS VARCHAR) AS org_id, CAST(t.sid AS INTEGER) AS section_id,
         CAST(t.base + r.org_id * 1000 AS INTEGER) AS attribute_id
  FROM owners r CROSS JOIN (VALUES (1::BIGINT, 1::BIGINT, 101::BIGINT), (1, 1, 102), (1, 1, 103), (1, 2, 201), (1, 2, 203),
       (2, 2, 201), (2, 2, 202), (2, 2, 203), (3, 1, 101), (3, 1, 103), (4, 1, 101), (4, 1, 102), (5, 1, 103)) t(k, sid, base) WHERE r.only IS NULL OR r.only = t.k
),
src_report_filters AS (
  SELECT r.owner * 100 + t.k AS report_id, CAST(r.org_id AS VARCHAR) AS org_id, CAST(t.sid AS VARCHAR) AS section_id,
         CAST(t.base + r.org_id * 1000 AS VARCHAR) AS attribute_id, t.op AS operator, t.val AS value
  FROM owners r CROSS JOIN (VALUES (1::BIGINT, 1::BIGINT, 103::BIGINT, 'CONTAINS', 'ation_1'), (1, 2, 201, '!=', 'P'),
       (3, 2, 201, '=', 'F'), (3, 1, 101, '=', NULL), (3, 1, 102, ' > ', '5000'),
       (4, 1, 101, 'in', ' BUILDING, ,MACHINERY,,O''Brien '), (5, 1, 103, 'BETWEEN', 'a')) t(k, sid, base, op, val) WHERE r.only IS NULL OR r.only = t.k
),
src_report_sorts AS (
  SELECT r.owner * 100 + t.k AS report_id, CAST(r.org_id AS VARCHAR) AS org_id, CAST(t.sid AS VARCHAR) AS section_id,
         CAST(t.base + r.org_id * 1000 AS VARCHAR) AS attribute_id, t.dir AS direction, CAST(t.so AS INTEGER) AS sort_order
  FROM owners r CROSS JOIN (VALUES (1::BIGINT, 1::BIGINT, 102::BIGINT, 'desc', 1), (1, 2, 203, 'asc', 2),
       (2, 2, 202, 'asc', 1), (4, 1, 101, 'desc', 1)) t(k, sid, base, dir, so) WHERE r.only IS NULL OR r.only = t.k
),
reports AS (
  SELECT report_id, CAST(org_id AS BIGINT) AS org_id, name, description, status, created_at, updated_at, last_run_date
  FROM src_reports
),
rsec AS (SELECT report_id, CAST(org_id AS BIGINT) AS org_id, CAST(section_id AS BIGINT) AS section_id FROM src_report_sections),
rattr AS (
  SELECT report_id, CAST(org_id AS BIGINT) AS org_id, CAST(section_id AS BIGINT) AS section_id,
         CAST(attribute_id AS BIGINT) AS attribute_id FROM src_report_attributes
),
rfilt AS (
  SELECT report_id, CAST(org_id AS BIGINT) AS org_id, CAST(section_id AS BIGINT) AS section_id,
         CAST(attribute_id AS BIGINT) AS attribute_id, operator, value FROM src_report_filters
),
rsort AS (
  SELECT report_id, CAST(org_id AS BIGINT) AS org_id, CAST(section_id AS BIGINT) AS section_id,
         CAST(attribute_id AS BIGINT) AS attribute_id, direction, sort_order FROM src_report_sorts
)
"""


#: Who owns reports: the regions, and for the growing definitions every customer.
REGION_OWNERS = "SELECT org_id AS owner, org_id, r_name, NULL::BIGINT AS only FROM regions"
CUSTOMER_OWNERS = " UNION ALL SELECT c.c_custkey + 1000, c.org_id, r.r_name, c.c_custkey % 5 + 1 FROM cust c JOIN regions r ON r.org_id = c.org_id"


def with_fixture(sql: str, extra_ctes: str = "", growing: bool = True) -> str:
    """``WITH <fixture>[, extra] <sql>``; ``growing``: definitions of all customers, else of the regions alone."""
    ctes = FIXTURE_CTES.strip().replace("@OWNERS@", REGION_OWNERS + (CUSTOMER_OWNERS if growing else ""))
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{sql.strip()}"


def wide_cte(name: str, org: int, section: int, attribute_ids: list[int]) -> str:
    """CTE of the wide table of one (org, section): ``record_id, provider_id, attr_<id>...``."""
    cols = "".join(f",\n    min(CASE WHEN kv.attribute_id = {a} THEN kv.value END) AS attr_{a}" for a in attribute_ids)
    return f"""{name} AS (
  SELECT c.record_id, c.provider_id{cols}
  FROM ctx c LEFT JOIN kv ON kv.record_id = c.record_id
  WHERE c.org_id = {org} AND c.section_id = {section}
  GROUP BY c.record_id, c.provider_id
)"""


# Fixed values of the fixture: kind, target and text of the requests.
REQUEST_TEXTS = """
  (1::BIGINT, NULL, '{"name":"Quarterly %1$s","description":"by segment","config":[{"sectionId":"1","attributeIds":[%2$d,%3$d]},{"sectionId":2,"attributeIds":["%4$d"]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":" in ","value":"BUILDING,MACHINERY"}],"sorts":[{"sectionId":"2","attributeId":"%4$d"}]}'),
  (2::BIGINT, NULL, '{"description":"no name","config":[{"sectionId":"1","attributeIds":[%2$d]}]}'),
  (3::BIGINT, NULL, '{"name":"Bad config %1$s","config":{"sectionId":"1"}}'),
  (4::BIGINT, NULL, '{"name":"Archived %1$s","config":[{"sectionId":"3","attributeIds":[]}]}'),
  (5::BIGINT, NULL, '{"name":"Foreign %1$s","config":[{"sectionId":"1","attributeIds":[%4$d]}]}'),
  (6::BIGINT, NULL, '{"name":"Between %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":"%2$d","operator":"BETWEEN","value":"a"}]}'),
  (7::BIGINT, NULL, '{"name":"Upward %1$s","config":[{"sectionId":"2","attributeIds":[%5$d]}],"sorts":[{"sectionId":"2","attributeId":%5$d,"direction":"UP"}]}'),
  (8::BIGINT, NULL, '{"name":"Partial %1$s","config":[{"sectionId":"2","attributeIds":[%5$d]}],"filters":[{"sectionId":"2","attributeId":%5$d,"value":"1"}]}'),
  (9::BIGINT, 'own', '{"name":"Edited %1$s","config":[{"sectionId":"2","attributeIds":[%5$d,%4$d]}],"filters":[{"sectionId":"2","attributeId":"%4$d","operator":"<>","value":"F"}],"sorts":[{"sectionId":"2","attributeId":"%5$d","direction":"DESC","sortOrder":"2"},{"sectionId":"2","attributeId":"%4$d","sortOrder":1}]}'),
  (10::BIGINT, 'other', '{"name":"Not mine %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}]}'),
  (11::BIGINT, NULL, '{"name":"Loose %1$s","config":[{"attributeIds":[%2$d]}],"filters":"none","sorts":[{"sectionId":"1"}]}'),
  (12::BIGINT, NULL, '{"name":"Null config %1$s","config":null}'),
  (13::BIGINT, NULL, '{"name":"Text config %1$s","config":"[abc"}'),
  (14::BIGINT, NULL, '{"name":"Empty filters %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":{},"sorts":""}'),
  (15::BIGINT, NULL, '{"name":"Null operator %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":null,"value":"x"}]}'),
  (16::BIGINT, NULL, '{"name":"Null direction %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"sorts":[{"sectionId":"1","attributeId":%2$d,"direction":null}]}'),
  (17::BIGINT, NULL, '{"name":"Odd order %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"sorts":[{"sectionId":"1","attributeId":%2$d,"sortOrder":"abc"}]}'),
  (18::BIGINT, NULL, '{"name":"Null ids %1$s","config":[{"sectionId":null,"attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":null,"operator":"=","value":"x"}]}'),
  (19::BIGINT, NULL, '{"name":"Padded id %1$s","config":[{"sectionId":"01","attributeIds":[%2$d]}]}'),
  (20::BIGINT, NULL, '{"name":"Bracket %1$s","config":[{"sectionId":"1","attributeIds":[%2$d]}],"filters":[{"sectionId":"1","attributeId":%2$d,"operator":"CONTAINS","value":"[draft"}]}')
"""


def requests_cte(growing: bool = True) -> str:
    """``req(request_id, org_id, report_id, body)``: the same JSON texts as the Spark fixture; ``growing``: one for each order."""
    orders = """
  UNION ALL
  SELECT o.o_orderkey + 1000000, o.org_id, r.r_name, t.target, (o.o_custkey + 1000) * 100 + o.o_custkey % 5 + 1, t.body
  FROM ord o JOIN regions r ON r.org_id = o.org_id JOIN request_texts t ON t.j = o.o_orderkey % 20 + 1"""
    return f"""request_texts(j, target, body) AS (VALUES {REQUEST_TEXTS}),
sent(request_id, org_id, r_name, target, own, body) AS (
  SELECT r.org_id * 100 + t.j, r.org_id, r.r_name, t.target, r.org_id * 100 + 2, t.body FROM regions r CROSS JOIN request_texts t{orders if growing else ""}
),
req AS (
  SELECT request_id, org_id, CASE target WHEN 'own' THEN own WHEN 'other' THEN ((org_id + 1) % 5) * 100 + 2 END AS report_id,
    replace(replace(replace(replace(replace(body, '%1$s', r_name), '%2$d', CAST(101 + org_id * 1000 AS VARCHAR)),
      '%3$d', CAST(102 + org_id * 1000 AS VARCHAR)), '%4$d', CAST(201 + org_id * 1000 AS VARCHAR)), '%5$d', CAST(203 + org_id * 1000 AS VARCHAR)) AS body
  FROM sent
)"""


VALIDATION_CTES = """
cat_sections AS (SELECT DISTINCT org_id, section_id FROM catalog WHERE section_id IS NOT NULL AND org_id IS NOT NULL),
cat_attrs AS (
  SELECT DISTINCT org_id, section_id, attribute_id FROM catalog
  WHERE section_id IS NOT NULL AND org_id IS NOT NULL AND attribute_id IS NOT NULL
),
cfg AS (
  SELECT request_id, org_id, pos, json_extract(body, '$.config[' || pos || ']') AS item
  FROM (SELECT request_id, org_id, body, unnest(range(CAST(json_array_length(body, '$.config') AS BIGINT))) AS pos
        FROM req WHERE json_type(body, '$.config') = 'ARRAY')
),
cfg_attrs AS (
  SELECT request_id, org_id, pos, sid, attr_pos, json_extract_string(item, '$.attributeIds[' || attr_pos || ']') AS aid
  FROM (SELECT request_id, org_id, pos, item, json_extract_string(item, '$.sectionId') AS sid,
               unnest(range(CAST(coalesce(json_array_length(item, '$.attributeIds'), 0) AS BIGINT))) AS attr_pos
        FROM cfg WHERE json_extract_string(item, '$.sectionId') IS NOT NULL)
),
filt AS (
  SELECT request_id, org_id, pos, json_extract(body, '$.filters[' || pos || ']') AS item
  FROM (SELECT request_id, org_id, body, unnest(range(CAST(json_array_length(body, '$.filters') AS BIGINT))) AS pos
        FROM req WHERE json_type(body, '$.filters') = 'ARRAY')
),
srt AS (
  SELECT request_id, org_id, pos, json_extract(body, '$.sorts[' || pos || ']') AS item
  FROM (SELECT request_id, org_id, body, unnest(range(CAST(json_array_length(body, '$.sorts') AS BIGINT))) AS pos
        FROM req WHERE json_type(body, '$.sorts') = 'ARRAY')
),
filt_ok AS (
  SELECT *, json_extract_string(item, '$.sectionId') AS sid, json_extract_string(item, '$.attributeId') AS aid
  FROM filt WHERE json_exists(item, '$.sectionId') AND json_exists(item, '$.attributeId') AND json_exists(item, '$.operator')
),
srt_ok AS (
  SELECT *, json_extract_string(item, '$.sectionId') AS sid, json_extract_string(item, '$.attributeId') AS aid,
    CASE WHEN json_exists(item, '$.direction') THEN lower(coalesce(json_extract_string(item, '$.direction'), 'none')) ELSE 'asc' END AS dir
  FROM srt WHERE json_exists(item, '$.sectionId') AND json_exists(item, '$.attributeId')
),
errors AS (
  SELECT request_id, org_id, 0 AS stage, 0 AS pos, 0 AS step, 0 AS attr_pos, 'name is required' AS message
  FROM req WHERE coalesce(json_extract_string(body, '$.name'), '') = ''
  UNION ALL SELECT request_id, org_id, 0, 0, 1, 0, 'config must be a list' FROM req
  WHERE json_type(body, '$.config') IS NOT NULL AND json_type(body, '$.config') <> 'ARRAY'
  UNION ALL SELECT request_id, org_id, 0, 0, 2, 0, 'filters must be a list' FROM req
  WHERE json_type(body, '$.filters') IS NOT NULL AND json_type(body, '$.filters') NOT IN ('ARRAY', 'NULL')
    AND json_extract_string(body, '$.filters') NOT IN ('', '{}', '0', '0.0', 'false')
  UNION ALL SELECT request_id, org_id, 0, 0, 3, 0, 'sorts must be a list' FROM req
  WHERE json_type(body, '$.sorts') IS NOT NULL AND json_type(body, '$.sorts') NOT IN ('ARRAY', 'NULL')
    AND json_extract_string(body, '$.sorts') NOT IN ('', '{}', '0', '0.0', 'false')
  UNION ALL SELECT q.request_id, q.org_id, 1, 0, 0, 0,
         'Report ' || CAST(q.report_id AS VARCHAR) || ' not found for org_id ' || CAST(q.org_id AS VARCHAR)
  FROM req q WHERE q.report_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM reports p WHERE p.report_id = q.report_id AND p.org_id = q.org_id)
  UNION ALL SELECT request_id, org_id, 2, pos, 0, 0, 'sectionId is required in each config item'
  FROM cfg WHERE NOT json_exists(item, '$.sectionId')
  UNION ALL SELECT c.request_id, c.org_id, 2, c.pos, 1, 0,
         'Invalid sectionId for org_id ' || CAST(c.org_id AS VARCHAR) || ': ' || coalesce(json_extract_string(c.item, '$.sectionId'), 'None')
  FROM cfg c WHERE json_exists(c.item, '$.sectionId') AND NOT EXISTS (
    SELECT 1 FROM cat_sections s WHERE s.org_id = c.org_id
      AND CAST(s.section_id AS VARCHAR) = json_extract_string(c.item, '$.sectionId'))
  UNION ALL SELECT a.request_id, a.org_id, 2, a.pos, 2, a.attr_pos,
         'Invalid attributeId ' || coalesce(a.aid, 'None') || ' for sectionId ' || a.sid || ' and org_id ' || CAST(a.org_id AS VARCHAR)
  FROM cfg_attrs a WHERE NOT EXISTS (
    SELECT 1 FROM cat_attrs k WHERE k.org_id = a.org_id AND CAST(k.section_id AS VARCHAR) = a.sid AND CAST(k.attribute_id AS VARCHAR) = a.aid)
  UNION ALL SELECT request_id, org_id, 3, pos, 0, 0, 'Each filter must contain sectionId, attributeId, and operator'
  FROM filt WHERE NOT (json_exists(item, '$.sectionId') AND json_exists(item, '$.attributeId') AND json_exists(item, '$.operator'))
  UNION ALL SELECT f.request_id, f.org_id, 3, f.pos, 1, 0,
         'Invalid filter sectionId for org_id ' || CAST(f.org_id AS VARCHAR) || ': ' || coalesce(f.sid, 'None')
  FROM filt_ok f WHERE NOT EXISTS (SELECT 1 FROM cat_sections s WHERE s.org_id = f.org_id AND CAST(s.section_id AS VARCHAR) = f.sid)
  UNION ALL SELECT f.request_id, f.org_id, 3, f.pos, 2, 0,
         'Invalid filter attributeId ' || coalesce(f.aid, 'None') || ' for sectionId ' || coalesce(f.sid, 'None') || ' and org_id ' || CAST(f.org_id AS VARCHAR)
  FROM filt_ok f WHERE NOT EXISTS (
    SELECT 1 FROM cat_attrs k WHERE k.org_id = f.org_id AND CAST(k.section_id AS VARCHAR) = f.sid AND CAST(k.attribute_id AS VARCHAR) = f.aid)
  UNION ALL SELECT request_id, org_id, 3, pos, 3, 0, 'Invalid filter operator: ' || trim(coalesce(json_extract_string(item, '$.operator'), 'None'))
  FROM filt_ok WHERE upper(trim(coalesce(json_extract_string(item, '$.operator'), 'None')))
    NOT IN ('=', '!=', '<>', '>', '<', '>=', '<=', 'CONTAINS', 'LIKE', 'IN')
  UNION ALL SELECT request_id, org_id, 4, pos, 0, 0, 'Each sort must contain sectionId and attributeId'
  FROM srt WHERE NOT (json_exists(item, '$.sectionId') AND json_exists(item, '$.attributeId'))
  UNION ALL SELECT f.request_id, f.org_id, 4, f.pos, 1, 0,
         'Invalid sort sectionId for org_id ' || CAST(f.org_id AS VARCHAR) || ': ' || coalesce(f.sid, 'None')
  FROM srt_ok f WHERE NOT EXISTS (SELECT 1 FROM cat_sections s WHERE s.org_id = f.org_id AND CAST(s.section_id AS VARCHAR) = f.sid)
  UNION ALL SELECT f.request_id, f.org_id, 4, f.pos, 2, 0,
         'Invalid sort attributeId ' || coalesce(f.aid, 'None') || ' for sectionId ' || coalesce(f.sid, 'None') || ' and org_id ' || CAST(f.org_id AS VARCHAR)
  FROM srt_ok f WHERE NOT EXISTS (
    SELECT 1 FROM cat_attrs k WHERE k.org_id = f.org_id AND CAST(k.section_id AS VARCHAR) = f.sid AND CAST(k.attribute_id AS VARCHAR) = f.aid)
  UNION ALL SELECT request_id, org_id, 4, pos, 3, 0,
         'Invalid sort direction: ' || dir FROM srt_ok WHERE dir NOT IN ('asc', 'desc')
  UNION ALL SELECT request_id, org_id, 4, pos, 4, 0, 'Invalid sort order: ' || coalesce(json_extract_string(item, '$.sortOrder'), 'None')
  FROM srt_ok WHERE json_exists(item, '$.sortOrder') AND TRY_CAST(json_extract_string(item, '$.sortOrder') AS INTEGER) IS NULL
)
"""


def validation_ctes() -> str:
    return VALIDATION_CTES


TASKS_CTE = """
ev AS (
  SELECT *, CASE event_type WHEN 'purchase' THEN 'document' WHEN 'signup' THEN 'profile' ELSE 'signature' END AS type
  FROM events
),
tasks AS (
  SELECT CAST(event_id AS VARCHAR) AS id, user_id AS provider_id, type,
         CASE event_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' ELSE 'completed' END AS status,
         event_type AS title, props AS description, strftime(ts, '%Y-%m-%d') AS dueDate,
         CASE WHEN type = 'signature' THEN 'Harbour Desk' ELSE 'Quay Office' END AS requestedBy,
         CASE WHEN type = 'profile' THEN CASE WHEN event_id % 5 = 0 THEN '' ELSE 'Profile' END END AS sectionName,
         CASE WHEN type = 'document' THEN CASE WHEN event_id % 5 = 0 THEN '' ELSE 'doc_' || CAST(event_id AS VARCHAR) || '.pdf' END END AS documentName,
         CASE WHEN type = 'signature' THEN 'form_' || CAST(event_id AS VARCHAR) || '.pdf' END AS formName,
         CASE WHEN type = 'profile' THEN [
           {'label': 'Event', 'value': event_type, 'required': true, 'placeholder': 'Type'},
           {'label': 'Amount', 'value': CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END,
            'required': NULL::BOOLEAN, 'placeholder': NULL::VARCHAR},
           {'label': 'Note', 'value': CASE WHEN event_id % 2 = 0 THEN '' ELSE props END, 'required': false, 'placeholder': 'Note'},
           {'label': 'User', 'value': CAST(user_id AS VARCHAR), 'required': true, 'placeholder': NULL::VARCHAR}
         ] END AS fields
  FROM ev
)
"""
