"""DuckDB SQL that gives the rows of each query in :mod:`graphloom.plans.queries`."""

from __future__ import annotations

DAY = 86_400
AS_OF = 946_684_800_000_000_000
#: Percent-encoding of everything but A-Z a-z 0-9 - . _ ~ is DuckDB's url_encode.

POINTS = """
ev AS (
  SELECT (((l_orderkey * 10 + l_linenumber) * 1000 + l_partkey % 1000) * 100 + l_suppkey % 100) * 64 + CAST(l_quantity AS BIGINT) AS point_id,
         (l_orderkey * 10 + l_linenumber) % 13 <> 0 AS ours,
         (l_orderkey * 10 + l_linenumber) % 101 <> 0 AS is_sum,
         (l_orderkey * 10 + l_linenumber) % 103 <> 0 AS delta,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 97 = 0 THEN 0 WHEN (l_orderkey * 10 + l_linenumber) % 89 = 0 THEN -1 ELSE l_quantity END AS value,
         epoch_us(l_shipdate) * 1000 AS observed_ns,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 107 = 0 THEN '' ELSE 'cust-' || (o_custkey % 20) END AS client,
         'supp-' || l_suppkey AS server,
         CASE WHEN l_linenumber = 7 THEN 'future_protocol' WHEN l_returnflag = 'A' THEN 'messaging_system' WHEN l_returnflag = 'R' THEN 'database' ELSE 'unset' END AS ct,
         'v' || l_linenumber AS version, n_name AS ns,
         CASE l_linenumber % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' ELSE 'BREW' END AS method,
         '/part/' || (l_partkey % 5) AS route
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
good AS (SELECT * FROM ev WHERE ours AND is_sum AND delta AND value > 0 AND observed_ns > 0 AND client <> '')
"""

CONTRIBUTIONS = POINTS + """,
who AS (
  SELECT *, sha256('{"client":"' || client || '","server":"' || server || '","connection_type":"' || ct ||
    '","dimensions":{"client_service.version":"' || version || '","server_http.request.method":"' || method ||
    '","server_http.route":"' || route || '","server_service.namespace":"' || ns || '"}}') AS contributor_id,
    'service:' || client AS c_id, 'service:' || server AS s_id, 'service.namespace:' || url_encode(ns) AS n_id,
    'app.endpoint:' || server || ':' || url_encode(ns) || ':' || method || ':' || url_encode(route) AS e_id
  FROM good
),
nodes AS (
  SELECT point_id, contributor_id, observed_ns, c_id AS element_id, 'service' AS type, map {'service.name': client, 'service.version': version} AS a FROM who
  UNION ALL SELECT point_id, contributor_id, observed_ns, s_id, 'service', map {'service.name': server} FROM who
  UNION ALL SELECT point_id, contributor_id, observed_ns, n_id, 'service.namespace', map {'service.namespace': ns} FROM who
  UNION ALL SELECT point_id, contributor_id, observed_ns, e_id, 'app.endpoint',
    map {'http.request.method': method, 'http.route': route, 'service.name': server, 'service.namespace': ns} FROM who WHERE method <> 'BREW'
),
ends AS (
  SELECT point_id, contributor_id, observed_ns, 'contains' AS type, n_id AS source_id, s_id AS target_id FROM who
  UNION ALL SELECT point_id, contributor_id, observed_ns, 'exposes', s_id, e_id FROM who WHERE method <> 'BREW'
  UNION ALL SELECT point_id, contributor_id, observed_ns, CASE ct WHEN 'unset' THEN 'calls' WHEN 'database' THEN 'queries' ELSE 'publishes_to' END, c_id, s_id
    FROM who WHERE ct <> 'future_protocol'
),
edges AS (
  SELECT *, 'edge:' || sha256('{"source_id":"' || source_id || '","target_id":"' || target_id || '","type":"' || type || '"}') AS element_id FROM ends
),
contrib AS (
  SELECT point_id, contributor_id, observed_ns, element_id, 'node' AS kind, type, CAST(NULL AS VARCHAR) AS source_id, CAST(NULL AS VARCHAR) AS target_id, a FROM nodes
  UNION ALL SELECT point_id, contributor_id, observed_ns, element_id, 'edge', type, source_id, target_id, map {} FROM edges
),
latest AS (
  SELECT * FROM contrib QUALIFY row_number() OVER (PARTITION BY element_id, contributor_id ORDER BY observed_ns DESC, point_id DESC) = 1
),
ttl AS (
  SELECT *, CASE type WHEN 'service' THEN 600 WHEN 'app.endpoint' THEN 300 ELSE 400 END * 86400 AS node_s,
    least(CASE split_part(source_id, ':', 1) WHEN 'service' THEN 600 WHEN 'app.endpoint' THEN 300 ELSE 400 END,
          CASE split_part(target_id, ':', 1) WHEN 'service' THEN 600 WHEN 'app.endpoint' THEN 300 ELSE 400 END) * 86400 AS ends_s
  FROM latest
),
dated AS (
  SELECT *, CAST(CASE WHEN kind = 'node' THEN node_s ELSE least(CASE type WHEN 'contains' THEN 200 * 86400 WHEN 'queries' THEN 900 * 86400 ELSE ends_s END, ends_s) END AS BIGINT) AS seconds
  FROM ttl
),
due AS (SELECT *, observed_ns + seconds * 1000000000 AS deadline_ns FROM dated),
live AS (SELECT * FROM due WHERE deadline_ns > 946684800000000000),
lost AS (
  SELECT element_id, max(deadline_ns) FILTER (WHERE deadline_ns <= 946684800000000000) AS expired_ns,
         count(*) FILTER (WHERE deadline_ns > 946684800000000000) AS n_left
  FROM due GROUP BY element_id HAVING expired_ns IS NOT NULL
)
"""


def _merged(source: str, name: str) -> str:
    """CTEs that merge contributors of ``source``: heads, winning attributes, JSON and hash."""
    return f""",
{name}_head AS (
  SELECT element_id, min(kind) AS kind, min(type) AS type, min(source_id) AS source_id, min(target_id) AS target_id, count(*) AS contributors, max(observed_ns) AS observed_ns
  FROM {source} GROUP BY element_id
),
{name}_attr AS (
  SELECT element_id, contributor_id, observed_ns, unnest(map_entries(a)) AS e FROM {source}
),
{name}_won AS (
  SELECT element_id, e.key AS name, e.value AS value, contributor_id AS owner FROM {name}_attr
  QUALIFY row_number() OVER (PARTITION BY element_id, e.key ORDER BY observed_ns DESC, contributor_id) = 1
),
{name}_json AS (
  SELECT element_id, '{{' || string_agg('"' || name || '":"' || value || '"', ',' ORDER BY name) || '}}' AS attributes FROM {name}_won GROUP BY element_id
),
{name} AS (
  SELECT h.*, coalesce(attributes, '{{}}') AS attributes,
    sha256('{{"kind":"' || kind || '","id":"' || element_id || '","type":"' || type || '","attributes":' || coalesce(attributes, '{{}}') ||
      CASE WHEN kind = 'edge' THEN ',"source_id":"' || source_id || '","target_id":"' || target_id || '"' ELSE '' END || '}}') AS payload_hash
  FROM {name}_head h LEFT JOIN {name}_json USING (element_id)
)"""


_MERGED_LATEST = _merged("latest", "now_")
_MERGED_LIVE = _merged("live", "then_")
_UPSERT_ID = """sha256('{"operation":"upsert","element_id":"' || element_id || '","observed_at_unix_nano":' || observed_ns || ',"payload_hash":"' || payload_hash || '"}')"""
_DELETE_ID = """sha256('{"operation":"delete","element_id":"' || element_id || '","observed_at_unix_nano":' || expired_ns || ',"payload_hash":null}')"""
_CLIENTS = "SELECT * FROM nodes WHERE type = 'service' AND cardinality(a) = 2"
_FINAL_STATE = """,
final AS (
  SELECT element_id, CASE WHEN n_left IS NULL THEN 'upsert' WHEN n_left = 0 THEN 'delete' ELSE 'upsert' END AS operation,
         CASE WHEN n_left = 0 THEN 3 ELSE 2 END AS seq
  FROM (SELECT DISTINCT element_id FROM latest) LEFT JOIN lost USING (element_id)
)"""
_FINAL = _FINAL_STATE + """,
stays AS (SELECT then_.* FROM then_ JOIN final USING (element_id) WHERE operation = 'upsert')"""

DISCOVERED = """
p AS (
  SELECT event_id AS point_id, 'svc ' || user_id AS service, event_type AS span, event_id,
    CASE event_id % 5 WHEN 0 THEN 'SPAN_KIND_INTERNAL' WHEN 1 THEN 'SPAN_KIND_PRODUCER' WHEN 2 THEN 'SPAN_KIND_CONSUMER' WHEN 3 THEN 'SPAN_KIND_UNSPECIFIED' END AS kind,
    CASE WHEN event_id % 3 = 0 THEN 'p' || (event_id % 7) END AS pipe,
    CASE WHEN event_id % 6 = 0 THEN 'r' || (event_id % 11) END AS run,
    CASE WHEN event_id % 12 = 0 THEN 'q' || (event_id % 13) END AS part
  FROM events
),
i AS (
  SELECT *, 'service:' || url_encode(service) AS s_id, 'transaction:' || url_encode(service) || ':' || url_encode(span) || ':' || kind AS t_id,
    'etl.pipeline:' || pipe AS p_id, 'etl.run:' || pipe || ':' || run AS r_id, 'etl.part.run:' || pipe || ':' || run || ':' || part AS q_id
  FROM p
),
n AS (
  SELECT point_id, s_id AS element_id, '{"service.name":"' || service || '"}' AS attributes FROM i
  UNION ALL SELECT point_id, t_id, '{"service.name":"' || service || '","span.kind":"' || kind || '","span.name":"' || span || '"}' FROM i WHERE kind IS NOT NULL
  UNION ALL SELECT point_id, p_id, '{"etl.pipeline.id":"' || pipe || '"}' FROM i WHERE pipe IS NOT NULL
  UNION ALL SELECT point_id, r_id, '{"etl.pipeline.id":"' || pipe || '","etl.run.id":"' || run || '"}' FROM i WHERE run IS NOT NULL
  UNION ALL SELECT point_id, q_id, '{"etl.part.run.id":"' || part || '","etl.pipeline.id":"' || pipe || '","etl.run.id":"' || run || '"}' FROM i WHERE part IS NOT NULL
)
"""

GRAPH = """
v AS (SELECT 'service:n' || n_nationkey AS id, n_name AS name, r_name AS region, n_nationkey AS rank FROM nation JOIN region ON n_regionkey = r_regionkey),
pairs AS (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS a, (c_custkey % 40) * 7 % 25 AS b FROM customer),
e AS (
  SELECT 'service:n' || a AS s, 'service:n' || b AS t, CASE WHEN (a + b) % 2 = 0 THEN 'calls' ELSE 'queries' END AS label
  FROM pairs WHERE a <> b
),
w AS (SELECT e.* FROM e JOIN v x ON e.s = x.id JOIN v y ON e.t = y.id)
"""

SPANS = """
sp AS (
  SELECT CAST(conv_id AS VARCHAR) AS trace_id, turn, CASE role WHEN 'user' THEN 'CLIENT' WHEN 'assistant' THEN 'SERVER' ELSE 'INTERNAL' END AS kind,
    role || '-' || (conv_id % 5) AS service, 'turn ' || (turn % 3) AS name, conv_id * 7 + turn * 2 AS at_s,
    'v' || (conv_id % 2) AS resource, CASE WHEN conv_id % 3 = 0 THEN 'v1' END AS own
  FROM conversations
),
paired AS (SELECT c.trace_id, c.turn AS ct, s.turn AS st, c.service AS client, s.service AS server FROM sp c JOIN sp s ON c.trace_id = s.trace_id AND s.turn = c.turn + 1 WHERE c.kind = 'CLIENT' AND s.kind = 'SERVER'),
roots AS (SELECT * FROM sp WHERE turn = 0 AND kind = 'INTERNAL' AND (own IS NULL OR own = resource))
"""

SQL: dict[str, str] = {
    "evidence_filter": f"WITH {POINTS} SELECT point_id, observed_ns FROM good",
    "evidence_rejections": f"""WITH {POINTS}, r AS (
        SELECT point_id, CASE WHEN NOT is_sum THEN 'invalid_servicegraph_metric_type' WHEN NOT delta THEN 'invalid_servicegraph_temporality'
          WHEN value <= 0 OR client = '' THEN 'invalid_servicegraph_datapoint' WHEN ct = 'future_protocol' THEN 'unsupported_servicegraph_connection_type' END AS reason
        FROM ev WHERE ours)
        SELECT reason, point_id AS "of", CASE WHEN reason LIKE 'unsupported%' THEN 'future_protocol' ELSE '' END AS detail FROM r WHERE reason IS NOT NULL""",
    "rejection_counts": f"""WITH {POINTS} SELECT CASE WHEN NOT is_sum THEN 'invalid_servicegraph_metric_type' WHEN NOT delta THEN 'invalid_servicegraph_temporality'
          WHEN value <= 0 OR client = '' THEN 'invalid_servicegraph_datapoint' ELSE 'unsupported_servicegraph_connection_type' END AS reason, count(*) AS n
        FROM ev WHERE ours AND (NOT is_sum OR NOT delta OR value <= 0 OR client = '' OR ct = 'future_protocol') GROUP BY 1""",
    "connection_type_normalize": f"WITH {POINTS} SELECT point_id, ct AS connection_type FROM good",
    "side_projection": f"""WITH {POINTS}
        SELECT point_id, 'client' AS side, 'service.name' AS name, client AS value FROM good
        UNION ALL SELECT point_id, 'client', 'service.version', version FROM good
        UNION ALL SELECT point_id, 'server', 'service.name', server FROM good
        UNION ALL SELECT point_id, 'server', 'service.namespace', ns FROM good
        UNION ALL SELECT point_id, 'server', 'http.request.method', method FROM good
        UNION ALL SELECT point_id, 'server', 'http.route', route FROM good""",
    "percent_encode_ids": "SELECT p_partkey, 'part:' || url_encode(p_brand) || ':' || url_encode(p_name || ' é/*~+%:' || p_type) AS element_id FROM part",
    "edge_ids": f"WITH {CONTRIBUTIONS} SELECT DISTINCT element_id, type, source_id, target_id FROM edges",
    "contributor_ids": f"WITH {CONTRIBUTIONS} SELECT DISTINCT point_id, contributor_id FROM who",
    "extract_entities": f"""WITH {CONTRIBUTIONS} SELECT point_id, element_id, type,
        '{{' || array_to_string(list_transform(list_sort(map_keys(a)), lambda k: '"' || k || '":"' || a[k] || '"'), ',') || '}}' AS attributes FROM nodes""",
    "observation_edges": f"WITH {CONTRIBUTIONS} SELECT point_id, type, source_id, target_id FROM edges WHERE type IN ('contains', 'exposes')",
    "interaction_edges": f"WITH {CONTRIBUTIONS} SELECT point_id, type, source_id, target_id FROM edges WHERE type NOT IN ('contains', 'exposes')",
    "unsupported_connection_keeps_nodes": f"""WITH {CONTRIBUTIONS} SELECT kind, type, count(*) AS n FROM contrib
        WHERE point_id IN (SELECT point_id FROM good WHERE ct = 'future_protocol') GROUP BY ALL""",
    "self_loop_suppression": "SELECT 'node' AS kind, count(*) AS n FROM orders",
    "datapoint_merge_conflict": """SELECT o_orderkey AS point_id, 'service:svc-' || (o_custkey % 5) AS element_id,
        CASE WHEN '"v' || (o_orderkey % 13) || '"' < '"v' || (o_custkey % 11) || '"' THEN 'v' || (o_orderkey % 13) ELSE 'v' || (o_custkey % 11) END AS version
        FROM orders""",
    "discovery_entities": f"""WITH {DISCOVERED} SELECT point_id, element_id,
        'spanmetrics:' || sha256('{{"source":"semconv.graph.discovery.calls","element_id":"' || element_id || '","attributes":' || attributes || '}}') AS contributor_id FROM n""",
    "discovery_edges": f"""WITH {DISCOVERED}
        SELECT point_id, 'executes' AS type, s_id AS source_id, t_id AS target_id FROM i WHERE kind IS NOT NULL
        UNION ALL SELECT point_id, 'contains', p_id, r_id FROM i WHERE run IS NOT NULL
        UNION ALL SELECT point_id, 'contains', r_id, q_id FROM i WHERE part IS NOT NULL""",
    "enum_coercion": "SELECT 'service' AS type, count(*) AS n FROM events UNION ALL SELECT 'transaction', count(*) FROM events WHERE event_id % 5 <> 4",
    "extract_valid_skips_invalid": """SELECT p_partkey, 'k8s.pod:pod-' || p_partkey AS element_id FROM part WHERE p_partkey % 4 <> 0
        UNION ALL SELECT p_partkey, 'k8s.node:node-' || p_size FROM part
        UNION ALL SELECT p_partkey, 'k8s.cluster:cluster-' || (p_size % 3) FROM part
        UNION ALL SELECT p_partkey, 'process:' || p_partkey || ':2000-01-01' FROM part""",
    "extract_strict": f"""WITH {POINTS} SELECT point_id, 'service:' || client AS element_id,
        '{{"service.name":"' || client || '","service.version":"' || version || '"}}' AS attributes FROM good""",
    "template_prefix_map": """SELECT p_partkey, '{"k8s.pod.label.brand":"' || p_brand || '","k8s.pod.name":"' || p_name || '","k8s.pod.uid":"pod-' || p_partkey || '"}' AS attributes
        FROM part WHERE p_partkey % 4 <> 0""",
    "contribution_latest": f"WITH {CONTRIBUTIONS} SELECT element_id, contributor_id, observed_ns, point_id FROM latest",
    "stale_observation_filter": f"""WITH {CONTRIBUTIONS},
        k AS (SELECT *, max(observed_ns) OVER (PARTITION BY element_id, contributor_id ORDER BY point_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM contrib)
        SELECT kind, type, count(*) AS n, CAST(sum(observed_ns // 1000000000) AS BIGINT) AS seconds FROM k WHERE newest IS NULL OR observed_ns >= newest GROUP BY ALL""",
    "edge_endpoint_refs": f"""WITH {CONTRIBUTIONS},
        e AS (SELECT DISTINCT type, replace(split_part(source_id, ':', 1), '.', '_') AS source, replace(split_part(target_id, ':', 1), '.', '_') AS target, source_id, target_id FROM latest WHERE kind = 'edge')
        SELECT source, type AS semantic_type, target, count(DISTINCT source_id) AS sources, count(DISTINCT target_id) AS targets,
          min(source || '/' || sha256(source_id)) AS first_from, max(target || '/' || sha256(target_id)) AS last_to FROM e GROUP BY ALL""",
    "project_deletes": f"""WITH {CONTRIBUTIONS}{_FINAL_STATE}
        SELECT element_id, sha256(element_id) AS _key, CASE WHEN element_id NOT LIKE 'edge:%' THEN replace(split_part(element_id, ':', 1), '.', '_') END AS collection
        FROM final WHERE operation = 'delete'""",
    "event_ids": f"""WITH {CONTRIBUTIONS}{_MERGED_LATEST}{_MERGED_LIVE}
        SELECT 1 AS seq, {_UPSERT_ID} AS event_id, 'upsert' AS operation FROM now_ UNION ALL SELECT 2, {_UPSERT_ID}, 'upsert' FROM then_
        UNION ALL SELECT 3, {_DELETE_ID}, 'delete' FROM lost WHERE n_left = 0""",
    "event_records": f"""WITH {CONTRIBUTIONS}{_MERGED_LATEST}{_MERGED_LIVE}, u AS (FROM now_ UNION ALL FROM then_)
        SELECT {_UPSERT_ID} AS event_id, element_id, 'upsert' AS operation, observed_ns AS observed_at_unix_nano, payload_hash, type, source_id, attributes FROM u
        UNION ALL SELECT {_DELETE_ID}, element_id, 'delete', expired_ns, NULL, NULL, NULL, NULL FROM lost WHERE n_left = 0""",
    "traverse_current_graph": f"""WITH {CONTRIBUTIONS}, e AS (SELECT DISTINCT type, source_id, target_id FROM latest WHERE kind = 'edge')
        SELECT a.source_id AS namespace, b.source_id AS client, count(*) AS n FROM e a JOIN e b ON a.target_id = b.target_id
        WHERE a.type = 'contains' AND b.type IN ('calls', 'queries') AND a.source_id LIKE 'service.namespace:%' GROUP BY ALL""",
    "match_patterns": f"""WITH {GRAPH} SELECT x.s AS a, x.t AS b, y.t AS c FROM w x JOIN w y ON x.t = y.s JOIN w z ON y.t = z.s AND z.t = x.s
        WHERE x.label = 'calls' AND y.label = 'queries'""",
    "as_select": f"""WITH {GRAPH} SELECT s AS "from", 'edge:' || sha256('{{"source_id":"' || s || '","target_id":"' || t || '","type":"calls"}}') AS edge, t AS "to"
        FROM w JOIN v ON s = v.id WHERE label = 'calls' AND region = 'ASIA'""",
    "coalesce_changes": f"""WITH {CONTRIBUTIONS}, c AS ({_CLIENTS}),
        k AS (SELECT *, max(observed_ns) OVER (PARTITION BY element_id ORDER BY point_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM c),
        f AS (SELECT *, lag(a['service.version']) OVER (PARTITION BY element_id ORDER BY point_id) AS before FROM k WHERE newest IS NULL OR observed_ns >= newest)
        SELECT element_id, point_id, observed_ns FROM f WHERE before IS NULL OR before <> a['service.version']""",
    "attribute_winners": f"WITH {CONTRIBUTIONS}{_MERGED_LATEST} SELECT element_id, name, '\"' || value || '\"' AS value, owner FROM now__won",
    "current_graph": f"WITH {CONTRIBUTIONS}{_MERGED_LATEST} SELECT element_id, kind, type, source_id, target_id, contributors, observed_ns, attributes, payload_hash FROM now_",
    "identity_conflicts": f"WITH {CONTRIBUTIONS} SELECT DISTINCT element_id FROM edges WHERE point_id % 50 = 7",
    "ttl_policy": f"WITH {CONTRIBUTIONS} SELECT DISTINCT element_id, seconds FROM dated",
    "expire_as_of": f"WITH {CONTRIBUTIONS} SELECT element_id, count(*) AS live, max(deadline_ns) AS until_ns FROM live GROUP BY element_id",
    "partial_expiry": f"WITH {CONTRIBUTIONS}{_MERGED_LIVE} SELECT element_id, expired_ns AS observed_ns, payload_hash FROM then_ JOIN lost USING (element_id)",
    "delete_events": f"""WITH {CONTRIBUTIONS}
        SELECT sha256('{{"operation":"delete","element_id":"' || element_id || '","observed_at_unix_nano":' || expired_ns || ',"payload_hash":null}}') AS event_id,
          element_id, expired_ns AS observed_at_unix_nano, 'delete' AS operation FROM lost WHERE n_left = 0""",
    "upsert_events": f"WITH {CONTRIBUTIONS}{_MERGED_LIVE} SELECT {_UPSERT_ID} AS event_id, element_id, observed_ns AS observed_at_unix_nano, payload_hash FROM then_",
    "change_suppression": f"""WITH {CONTRIBUTIONS}, c AS ({_CLIENTS}),
        o AS (SELECT element_id, observed_ns, arg_max(a['service.version'], point_id) AS version, arg_max(a['service.name'], point_id) AS name FROM c GROUP BY ALL),
        h AS (SELECT *, sha256('{{"kind":"node","id":"' || element_id || '","type":"service","attributes":{{"service.name":"' || name || '","service.version":"' || version || '"}}}}') AS payload_hash FROM o),
        f AS (SELECT *, lag(payload_hash) OVER (PARTITION BY element_id ORDER BY observed_ns) AS before FROM h)
        SELECT element_id, observed_ns AS observed_at_unix_nano, payload_hash FROM f WHERE before IS NULL OR before <> payload_hash""",
    "project_latest_per_element": f"WITH {CONTRIBUTIONS}{_FINAL_STATE} SELECT element_id, operation, seq FROM final",
    "project_vertices": f"""WITH {CONTRIBUTIONS}{_MERGED_LIVE}{_FINAL},
        x AS (SELECT element_id, type, map_from_entries(list((name, value))) AS m FROM stays JOIN then__won USING (element_id) WHERE kind = 'node' GROUP BY ALL)
        SELECT sha256(element_id) AS _key, element_id, type AS semantic_type, m['service.name'] AS service_name, m['service.namespace'] AS service_namespace,
          m['service.version'] AS service_version, m['http.route'] AS http_route FROM x""",
    "project_edges": f"""WITH {CONTRIBUTIONS}{_MERGED_LIVE}{_FINAL}
        SELECT sha256(element_id) AS _key, type AS semantic_type,
          replace(split_part(source_id, ':', 1), '.', '_') || '/' || sha256(source_id) AS _from, replace(split_part(target_id, ':', 1), '.', '_') || '/' || sha256(target_id) AS _to
        FROM stays WHERE kind = 'edge'""",
    "dangling_edges": f"""WITH {CONTRIBUTIONS}{_MERGED_LIVE}{_FINAL}, n AS (SELECT element_id FROM stays WHERE kind = 'node')
        SELECT element_id, source_id, target_id FROM stays WHERE kind = 'edge' AND (source_id NOT IN (FROM n) OR target_id NOT IN (FROM n))""",
    "apply_events": f"WITH {CONTRIBUTIONS}{_MERGED_LIVE}{_FINAL} SELECT type, count(*) AS n FROM stays GROUP BY type",
    "graph_schema_edges": """SELECT * FROM (VALUES ('built_from', 1, 1), ('calls', 1, 1), ('contains', 8, 21), ('executes', 1, 1), ('exposes', 1, 1), ('instrumented_by', 1, 2),
        ('publishes_to', 1, 1), ('queries', 1, 1), ('runs', 4, 5), ('uses', 1, 2)) AS t(type, sources, targets)""",
    "traverse_out": f"WITH {GRAPH} SELECT t AS id, count(*) AS n FROM w WHERE s IN ('service:n1', 'service:n2') AND label = 'calls' GROUP BY t",
    "traverse_in": f"WITH {GRAPH} SELECT s AS id, count(*) AS n FROM w WHERE t IN ('service:n7', 'service:n14') GROUP BY s",
    "traverse_both": f"""WITH {GRAPH}, b AS (SELECT t AS id FROM w WHERE s = 'service:n7' AND label = 'queries' UNION ALL SELECT s FROM w WHERE t = 'service:n7' AND label = 'queries')
        SELECT id, count(*) AS n FROM b GROUP BY id""",
    "traverse_out_e_in_v": f"WITH {GRAPH} SELECT t AS id, count(*) AS n FROM w WHERE label = 'calls' GROUP BY t",
    "traverse_both_e_other_v": f"""WITH {GRAPH}, b AS (SELECT t AS id FROM w WHERE s IN ('service:n3', 'service:n4') UNION ALL SELECT s FROM w WHERE t IN ('service:n3', 'service:n4'))
        SELECT id, count(*) AS n FROM b GROUP BY id""",
    "has_filters": f"WITH {GRAPH} SELECT id FROM v WHERE region IN ('ASIA', 'EUROPE') AND rank > 5",
    "where_semi": f"WITH {GRAPH} SELECT id FROM v WHERE id IN (SELECT s FROM w JOIN v x ON t = x.id WHERE label = 'calls' AND region = 'ASIA')",
    "not_anti": f"WITH {GRAPH} SELECT id FROM v WHERE id NOT IN (SELECT t FROM w WHERE label = 'queries')",
    "and_or": f"""WITH {GRAPH} SELECT id FROM v WHERE id IN (SELECT s FROM w WHERE label = 'calls') AND id IN (SELECT t FROM w WHERE label = 'queries')
        AND region IN ('ASIA', 'AFRICA')""",
    "dedup": f"WITH {GRAPH} SELECT DISTINCT t AS id FROM w",
    "order_range_tail": f"""WITH {GRAPH}, r AS (SELECT id, row_number() OVER (ORDER BY name, id) AS k, count(*) OVER () AS n FROM v)
        SELECT 'range' AS what, id FROM r WHERE k BETWEEN 6 AND 10 UNION ALL SELECT 'tail', id FROM r WHERE k > n - 3""",
    "simple_path": f"""WITH {GRAPH} SELECT count(*) AS count FROM w a JOIN w b ON a.t = b.s JOIN w c ON b.t = c.s
        WHERE a.s = 'service:n1' AND b.t <> a.s AND c.t NOT IN (a.s, a.t)""",
    "cyclic_path": f"WITH {GRAPH} SELECT a.s || ' ' || a.t || ' ' || b.t AS path FROM w a JOIN w b ON a.t = b.s WHERE b.t = a.s",
    "values_project": f"WITH {GRAPH} SELECT id AS who, region, name FROM v",
    "group_count": f"WITH {GRAPH} SELECT region AS key, count(*) AS n FROM w JOIN v ON t = id GROUP BY region",
    "fold_unfold": f"WITH {GRAPH} SELECT id AS value FROM v WHERE region = 'ASIA'",
    "numeric_aggregates": f"WITH {GRAPH} SELECT CAST(sum(rank) AS DOUBLE) AS sum, CAST(min(rank) AS DOUBLE) AS min, CAST(max(rank) AS DOUBLE) AS max, avg(rank) AS mean FROM v WHERE region = 'ASIA'",
    "multi_hop_reachability": f"""WITH RECURSIVE {GRAPH}, r(id, distance) AS (
        SELECT 'service:n1', 0 UNION SELECT w.t, r.distance + 1 FROM r JOIN w ON w.s = r.id WHERE r.distance < 3)
        SELECT id, CAST(min(distance) AS INTEGER) AS distance FROM r GROUP BY id""",
    "span_pairing": f"WITH {SPANS} SELECT trace_id, CAST(ct AS VARCHAR) AS client_span, CAST(st AS VARCHAR) AS server_span FROM paired",
    "span_dimensions": f"""WITH {SPANS} SELECT p.trace_id, CAST(ct AS VARCHAR) AS client_span, side || '_service.version' AS name, resource AS value
        FROM paired p JOIN sp ON sp.trace_id = p.trace_id AND sp.turn = ct, (VALUES ('client'), ('server')) sides(side)""",
    "servicegraph_counts": f"WITH {SPANS} SELECT client, server, count(*) AS requests FROM paired GROUP BY ALL",
    "cumulative_to_delta": """WITH x AS (SELECT l_suppkey, (((l_orderkey * 10 + l_linenumber) * 1000 + l_partkey % 1000) * 100 + l_suppkey % 100) * 64 + CAST(l_quantity AS BIGINT) AS seq, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
        y AS (SELECT *, lag(q) OVER (PARTITION BY l_suppkey ORDER BY seq) AS b FROM x), z AS (SELECT seq, CASE WHEN b IS NULL OR q < b THEN q ELSE q - b END AS delta FROM y)
        SELECT seq, delta FROM z WHERE delta <> 0""",
    "root_span_filter": f"WITH {SPANS} SELECT trace_id, CAST(turn AS VARCHAR) AS span_id FROM roots",
    "root_span_metrics": f"WITH {SPANS} SELECT CAST(at_s // 60 * 60 AS BIGINT) AS start_s, service, name, kind, count(*) AS calls FROM roots GROUP BY ALL",
    "service_ring_expected": f"""WITH {CONTRIBUTIONS}, c AS ({_CLIENTS})
        SELECT element_id, a['service.version'] AS version FROM c QUALIFY row_number() OVER (PARTITION BY element_id ORDER BY observed_ns DESC, point_id DESC) = 1""",
}
