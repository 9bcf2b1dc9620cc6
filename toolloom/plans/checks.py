"""SQL for DuckDB that gives the same rows as the registered queries.

Specs and pairs are not parsed here: the SQL works on the flat form from which
the documents and texts are derived.
"""

from __future__ import annotations

import json

from toolloom import fixed_values as fixed
from toolloom.functions.chat import CHATML, system_prompt
from toolloom.plans import derived


def _q(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(_q(v) for v in row) + ")" for row in rows)


# What Python calls whitespace, for RE2.
_WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '<[^<]+?>', '', 'g'), '{_WS}+', ' ', 'g'))"


# ------------------------------------------------------------------ specs

_N = len(derived.PARAMETERS)

_OPS = f"""
kinds(i, name, kind, kind_json, text_json, required, used) AS (
  {_values((i, *flat) for i, (_, flat) in enumerate(derived.PARAMETERS))}
),
numbered AS (
  SELECT CAST(p_partkey AS VARCHAR) AS spec_id, p_name, slot, p_partkey * 2 + slot AS n,
    {_list(derived.BASES)}[1 + (p_partkey + 3 * slot) % 8] || '/' || (p_partkey * 2 + slot) AS path
  FROM part CROSS JOIN (VALUES (0), (1)) s(slot)
),
ops AS (
  SELECT *, {_list(derived.METHODS)}[1 + n % 7] AS method,
    CASE WHEN n % 11 <> 0 THEN 'op.' || n END AS operation_id,
    CASE WHEN n % 13 = 0 THEN NULL WHEN n % 17 = 0 THEN '<b> </b>'
      ELSE CASE WHEN n % 19 = 0 THEN 'Été "x" ' ELSE '' END || '<p>List  ' || p_name || '</p>' END AS summary
  FROM numbered
),
called AS (
  SELECT *, {_clean("coalesce(summary, 'about it')")} AS description,
    method IN ('post', 'patch', 'put') AS has_body,
    coalesce(operation_id, method || '_' || replace(path, '/', '_')) AS tool_name
  FROM ops WHERE method IN ({", ".join(_q(m) for m in fixed.VALID_METHODS)})
),
kept AS (
  SELECT * FROM called WHERE {_clean("coalesce(summary, '')")} <> ''
    AND ({" OR ".join(f"contains(path, {_q(n)})" for n in fixed.TARGET_NAMESPACES)})
),
places AS (
  SELECT n, 1 AS pos, n % {_N} AS i FROM called
  UNION ALL SELECT n, 2, (n // {_N}) % {_N} FROM called
  UNION ALL SELECT n, 3, (n * 5 + 16) % {_N} FROM called
),
params AS (
  SELECT n, pos, name, kind, kind_json, text_json, required FROM places JOIN kinds USING (i) WHERE used
  UNION ALL
  SELECT n, 4, {_q(fixed.BODY_PROPERTY)}, 'object', '"object"', {_q(json.dumps(fixed.BODY_DESCRIPTION))}, FALSE
  FROM called WHERE has_body AND n % 3 = 0
),
props AS (
  SELECT n, name, min(pos) AS pos, arg_max(kind, pos) AS kind, arg_max(kind_json, pos) AS kind_json,
    arg_max(text_json, pos) AS text_json
  FROM params GROUP BY n, name
)"""

_TOOLS = f"""{_OPS},
property_text AS (
  SELECT n, string_agg('"' || name || '": {{"type": ' || kind_json || ', "description": ' || text_json || '}}', ', ' ORDER BY pos) AS t
  FROM props GROUP BY n
),
required_text AS (
  SELECT n, string_agg('"' || name || '"', ', ' ORDER BY pos) AS t FROM params WHERE required GROUP BY n
),
tools AS (
  SELECT kept.*, '{{"type": "function", "function": {{"name": "' || tool_name || '", "description": "' ||
    replace(replace(replace(description, '"', '\\"'), 'É', '\\u00c9'), 'é', '\\u00e9') ||
    '", "parameters": {{"type": "object", "properties": {{' || coalesce(p.t, '') || '}}, "required": [' ||
    coalesce(r.t, '') || ']}}}}}}' AS input
  FROM kept LEFT JOIN property_text p USING (n) LEFT JOIN required_text r USING (n)
)"""


def _h(*salt: str) -> str:
    key = " || '|' || ".join(["key", *[_q(s) for s in salt]])
    return f"('0x' || substr(md5({key}), 1, 8))::BIGINT"


def _pick(values, *salt: str) -> str:
    return f"{_list(values)}[1 + {_h(*salt)} % {len(values)}]"


def _int(low: int, high: int, *salt: str) -> str:
    return f"({low} + {_h(*salt)} % {high - low + 1})"


def _sample(values, low: int, high: int, separator: str) -> str:
    ranked = f"list_sort(list_transform({_list(values)}, lambda v: {{'r': md5(key || '|' || v), 'v': v}}))"
    return f"array_to_string(list_transform({ranked}, lambda e: e.v)[1:{_int(low, high, 'count')}], {_q(separator)})"


_UUID = (
    "substr(md5(key || '|uuid'), 1, 8) || '-' || substr(md5(key || '|uuid'), 9, 4) || '-4' || "
    "substr(md5(key || '|uuid'), 14, 3) || '-' || substr('89ab', 1 + "
    + _h("variant")
    + " % 4, 1) || substr(md5(key || '|uuid'), 18, 3) || '-' || substr(md5(key || '|uuid'), 21, 12)"
)


def _s(text: str) -> str:
    return f"'\"' || {text} || '\"'"


_ARGS = f"""
keyed AS (
  SELECT props.*, '42|' || method || ' ' || path || '|' || name AS key
  FROM props JOIN called USING (n)
),
valued AS (
  SELECT n, pos, name, CASE
    WHEN name = '$filter' THEN {_s(_sample(fixed.FILTER_CLAUSES, 1, 2, " and "))}
    WHEN name = '$select' THEN {_s(_sample(fixed.SELECT_FIELDS, 2, 4, ","))}
    WHEN name = '$top' THEN CAST({_pick(fixed.TOP_SIZES)} AS VARCHAR)
    WHEN name = '$orderby' THEN {_s(_pick(fixed.ORDER_FIELDS) + " || ' ' || " + _pick(fixed.ORDER_DIRECTIONS, "direction"))}
    WHEN name = '$expand' THEN {_s(_pick(fixed.EXPANSIONS))}
    WHEN name = '$search' THEN '"\\"' || {_pick(fixed.SEARCH_TERMS)} || '\\""'
    WHEN name = 'alertId' THEN {_s(_UUID + " || '_' || " + _int(10_000_000, 99_999_999))}
    WHEN name = 'incidentId' THEN {_s(_int(1000, 999_999))}
    WHEN name = 'userId' THEN {_s(_pick(fixed.USER_NAMES) + " || '@' || " + _pick(fixed.USER_DOMAINS, "domain"))}
    WHEN name = 'hostName' THEN {_s(_pick(fixed.HOST_PREFIXES) + " || '-' || lpad(CAST(" + _int(1, 99, "number") + " AS VARCHAR), 2, '0')")}
    WHEN name = 'query' THEN {_s(_pick(fixed.HUNTING_QUERIES))}
    WHEN name = 'timeRange' THEN {_s(_pick(fixed.TIME_RANGES))}
    WHEN kind = 'integer' THEN CAST({_int(1, 100)} AS VARCHAR)
    WHEN kind = 'boolean' THEN CASE WHEN {_h()} % 2 = 0 THEN 'true' ELSE 'false' END
    WHEN kind = 'array' THEN '[' || array_to_string(list_transform(range(1 + {_int(0, 2)}), lambda i: '"item' || i || '"'), ', ') || ']'
    WHEN kind = 'object' THEN '{{}}'
    ELSE {_s("'example_' || name || '_' || " + _int(100, 999))}
  END AS value FROM keyed
),
arguments AS (
  SELECT n, '{{' || string_agg('"' || name || '": ' || value, ', ' ORDER BY pos) || '}}' AS arguments
  FROM valued GROUP BY n
)"""

_SAMPLES = f"""
templates(template_id, template) AS ({_values(enumerate(fixed.PROMPT_TEMPLATES))}),
samples AS (
  SELECT spec_id, slot, template_id, spec_id || '/' || slot || '/1/' || template_id AS sample_id,
    replace(template, '{{action}}', lower(description)) AS instruction,
    input,
    '{{"name": "' || tool_name || '", "arguments": ' || coalesce(arguments, '{{}}') || '}}' AS output
  FROM tools LEFT JOIN arguments USING (n) CROSS JOIN templates
)"""

# ------------------------------------------------------------------ pairs

_FILL = "replace(replace(replace({}, '@T', event_type), '@U', user_id::VARCHAR), '@E', event_id::VARCHAR)"

_PAIRS = f"""
cases(r, generated_t, expected_t, valid, name, args, error) AS ({_values((i, *p) for i, p in enumerate(derived.PAIRS))}),
pairs AS (
  SELECT event_id AS sample_id, 'Do ' || event_type AS instruction, event_type, r,
    {_FILL.format("generated_t")} AS generated, {_FILL.format("expected_t")} AS expected,
    value / 100 AS inference_time, user_id AS num_tokens, valid, name, args, error, ts
  FROM events JOIN cases ON r = event_id % {len(derived.PAIRS)}
)"""


_TOTALS = """count(*) AS total_samples, count(*) FILTER (WHERE valid) AS valid_json_count,
    count(*) FILTER (WHERE name) AS correct_tool_name_count,
    count(*) FILTER (WHERE args) AS correct_arguments_count,
    count(*) FILTER (WHERE error IS NOT NULL) AS error_count,
    CAST(coalesce(sum(CAST(inference_time AS DECIMAL(18, 6))), 0) AS DOUBLE) AS total_inference_time,
    CAST(coalesce(sum(num_tokens), 0) AS BIGINT) AS total_tokens"""

_MEASURES = """total_samples, valid_json_count, correct_tool_name_count, correct_arguments_count,
    CASE WHEN total_samples > 0 THEN valid_json_count / total_samples ELSE 0.0 END AS json_validity_rate,
    CASE WHEN total_samples > 0 THEN correct_tool_name_count / total_samples ELSE 0.0 END AS tool_name_accuracy,
    CASE WHEN total_samples > 0 THEN correct_arguments_count / total_samples ELSE 0.0 END AS argument_accuracy,
    CASE WHEN total_samples > 0 THEN correct_arguments_count / total_samples ELSE 0.0 END AS overall_accuracy,
    total_inference_time,
    CASE WHEN total_samples > 0 AND total_inference_time > 0 THEN total_inference_time / total_samples ELSE 0.0 END AS avg_inference_time,
    CASE WHEN total_inference_time > 0 THEN total_tokens / total_inference_time ELSE 0.0 END AS tokens_per_second,
    error_count"""


def _metrics(source: str) -> str:
    return f"""
counted AS (SELECT {_TOTALS} FROM {source}),
metrics AS (SELECT {_MEASURES} FROM counted)"""


_TOOL = """CASE WHEN contains(expected, '"name": "' || event_type) THEN event_type END"""


def _windows(hours: int, every: int, by: str = "") -> str:
    """Measures of windows of so many hours that begin every so many, counted from the epoch."""
    begins = f"time_bucket(INTERVAL '{every} hours', ts, TIMESTAMP '1970-01-01') - to_hours({every} * k)"
    keys = f"window_start, window_end{', ' + by if by else ''}"
    return f"""WITH {_PAIRS},
spans AS (
  SELECT pairs.*, {_TOOL} AS tool, {begins} AS s FROM pairs CROSS JOIN (SELECT unnest(range({hours // every})) AS k)
),
placed AS (SELECT *, s AS window_start, s + INTERVAL '{hours} hours' AS window_end FROM spans),
counted AS (SELECT {keys}, {_TOTALS} FROM placed GROUP BY {keys})
SELECT {keys}, {_MEASURES} FROM counted"""


# Rows of the pairs of which every tenth prediction is missing.
_PAIRED = """
paired AS (
  SELECT sample_id, expected, sample_id % 10 = 9 AS lost,
    CASE WHEN NOT lost THEN generated END AS generated,
    NOT lost AND valid AS valid, NOT lost AND name AS name, NOT lost AND args AS args,
    CASE WHEN lost THEN 'missing_prediction' ELSE error END AS error,
    CASE WHEN lost THEN 0.0 ELSE inference_time END AS inference_time,
    CASE WHEN lost THEN 0 ELSE num_tokens END AS num_tokens
  FROM pairs
)"""

# ------------------------------------------------------------------ requests


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(lower(request), {_q(w)})" for w in words) + ")"


def _cascade() -> str:
    arms = []
    for words, narrower, key in fixed.ROUTES:
        arms += [f"WHEN {_any(words)} AND {_any(sub)} THEN {_q(k)}" for sub, k in narrower]
        arms.append(f"WHEN {_any(words)} THEN {_q(key)}")
    return "CASE " + " ".join(arms) + f" ELSE {_q(fixed.DEFAULT_ROUTE)} END"


def _catalogue_rows():
    for key, (name, description, parameters, required) in fixed.TOOLS.items():
        schema = {
            "type": "object",
            "properties": {p: {"type": k, "description": t} for p, k, t in parameters},
            **({} if required is None else {"required": required}),
        }
        function = {
            "name": name,
            "description": description.format(product=fixed.DEFAULT_PRODUCT),
            "parameters": schema,
        }
        yield key, name, json.dumps({"type": "function", "function": function})


_REQUESTS = f"""
requests AS (
  SELECT conv_id * 1000 + turn AS request_id,
    CASE WHEN (conv_id + turn) % 19 = 17 THEN '   '
      WHEN (conv_id + turn) % 19 = 18 THEN ' Quit' || chr(10)
      ELSE '  ' || {_list(derived.PHRASES)}[1 + (conv_id + turn) % {len(derived.PHRASES)}] || text || chr(9) END AS request
  FROM conversations WHERE role = 'user'
),
catalogue(tool_key, name, definition) AS ({_values(_catalogue_rows())}),
wanted AS (
  SELECT request_id, {_strip("request")} AS request FROM requests
  WHERE {_strip("request")} <> '' AND lower({_strip("request")}) NOT IN ('quit', 'exit', 'q')
),
routed AS (SELECT *, {_cascade()} AS tool_key FROM wanted),
found AS (SELECT * FROM routed LEFT JOIN catalogue USING (tool_key))"""

_OPEN, _CLOSE = (CHATML.open.split("{role}")), CHATML.close


def _block(role: str, content: str) -> str:
    return f"{_q(_OPEN[0] + role + _OPEN[1])} || {content} || {_q(_CLOSE)}"


def _user(instruction: str, tool: str) -> str:
    return f"({_q(fixed.USER_MESSAGE.split('{')[0])} || {instruction} || {_q(chr(10) + 'Available Tool: ')} || {tool})"


def _prompt(instruction: str, tool: str) -> str:
    system = _block("system", _q(system_prompt()))
    return f"{system} || {_block('user', _user(instruction, tool))} || {_q(_OPEN[0] + 'assistant' + _OPEN[1])}"


_ANSWER = "'{\"name\": \"' || tool_key || '\", \"arguments\": {}}'"
_TRAINING = (
    f"{_block('system', _q(system_prompt()))} || {_block('user', _user('request', 'definition'))} || "
    f"{_block('assistant', _ANSWER)}"
)


def _split(key: str) -> str:
    cut = int(fixed.TEST_SIZE * (1 << 32))
    return f"CASE WHEN ('0x' || substr(md5('{fixed.SPLIT_SEED}|' || {key}), 1, 8))::BIGINT < {cut} THEN 'test' ELSE 'train' END"


_SIZE_CATEGORY = """CASE WHEN num_samples < 1000 THEN 'n<1K' WHEN num_samples < 10000 THEN '1K<n<10K'
  WHEN num_samples < 100000 THEN '10K<n<100K' WHEN num_samples < 1000000 THEN '100K<n<1M' ELSE '1M<n<10M' END"""

_NAMESPACES = f"""
namespaces AS (
  SELECT p_partkey AS part_id, CASE WHEN p_partkey % 50 = 0 THEN ''
    ELSE substr({_list(derived.BASES)}[1 + p_partkey % 8], 1 + p_partkey % 5) END || '/' || p_partkey AS namespace FROM part
)"""


def all_checks() -> dict[str, str]:
    return {
        "clean_text_pages": f"SELECT page_id, {_clean('html')} AS cleaned FROM pages",
        "clean_text_documents": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
        "spec_operations": f"""WITH {_OPS}
SELECT spec_id, slot AS path_pos, path, 1 AS method_pos, method, operation_id, summary,
  CAST(3 AS BIGINT) AS n_parameters, has_body FROM called""",
        "filter_operations": f"""WITH {_OPS}
SELECT spec_id, slot AS path_pos, path, 1 AS method_pos, method FROM kept""",
        "format_tools": f"WITH {_TOOLS} SELECT spec_id, path, tool_name, description, input FROM tools",
        "example_args": f"""WITH {_OPS}, {_ARGS}
SELECT spec_id, path, method, coalesce(arguments, '{{}}') AS arguments FROM called LEFT JOIN arguments USING (n)""",
        "generate_samples": f"WITH {_TOOLS}, {_ARGS}, {_SAMPLES} SELECT sample_id, instruction, input, output FROM samples",
        "train_test_split": f"""SELECT l_orderkey, l_linenumber,
  {_split("l_orderkey || '|' || l_linenumber")} AS split FROM lineitem""",
        "train_test_split_exact": f"""WITH ranked AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5('{fixed.SPLIT_SEED}|' || o_orderkey), 1, 8), o_orderkey) AS r,
    count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= ceil(n * CAST({fixed.TEST_SIZE} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM ranked""",
        "take_first": f"""WITH {_PAIRS}
SELECT sample_id, instruction, expected FROM pairs ORDER BY sample_id LIMIT 500""",
        "take_first_samples": f"""WITH {_TOOLS}, {_ARGS}, {_SAMPLES}
SELECT sample_id FROM samples ORDER BY spec_id, slot, template_id LIMIT 300""",
        "chat_messages": f"""WITH {_REQUESTS}
SELECT request_id, CAST(0 AS BIGINT) AS position, 'system' AS role, {_q(system_prompt())} AS content FROM found
UNION ALL SELECT request_id, 1, 'user', {_user('request', 'definition')} FROM found
UNION ALL SELECT request_id, 2, 'assistant', {_ANSWER} FROM found""",
        "training_text": f"""WITH {_REQUESTS}
SELECT request_id, {_TRAINING} AS text, {_split("request_id")} AS split FROM found""",
        "inference_prompts": f"""WITH {_REQUESTS}, given AS (
  SELECT request_id, request, CASE request_id % 3 WHEN 0 THEN '{{"name": "one"}}'
    WHEN 1 THEN '[{{"name":"a"}},{{"name":"b"}}]' END AS tool_text FROM requests)
SELECT request_id, tool_text, CASE WHEN tool_text IS NULL THEN 'missing_tool' ELSE 'ok' END AS status,
  {_prompt('request', 'tool_text')} AS prompt FROM given""",
        "flag_overlength": f"""WITH counted AS (
  SELECT doc_id, CAST(len(regexp_extract_all(regexp_replace(text, '{_WS}+', ' ', 'g'), '[\\pL\\pM\\pN_]+|[^\\pL\\pM\\pN_ ]')) AS BIGINT) AS n_tokens FROM documents)
SELECT doc_id, n_tokens, n_tokens > {fixed.MAX_SEQ_LENGTH} AS over_length FROM counted""",
        "conversations_to_text": f"""SELECT conv_id, count(*) AS n_turns,
  string_agg({_q(_OPEN[0])} || coalesce(role, '') || {_q(_OPEN[1])} || coalesce(text, '') || {_q(_CLOSE)}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
        "spec_rejects": """SELECT CAST(p_partkey AS VARCHAR) AS spec_id,
  CASE p_partkey % 12 WHEN 3 THEN 'not_an_object' WHEN 8 THEN 'missing' ELSE 'not_json' END AS error
FROM part WHERE p_partkey % 12 IN (0, 1, 2, 3, 4, 8)""",
        "split_grouped": f"""SELECT o_orderkey, {_split("o_custkey")} AS split FROM orders""",
        "split_grouped_exact": f"""WITH groups AS (
  SELECT o_custkey, row_number() OVER (ORDER BY substr(md5('{fixed.SPLIT_SEED}|' || o_custkey), 1, 8), o_custkey) AS r,
    count(*) OVER () AS n FROM orders GROUP BY o_custkey)
SELECT o_orderkey, CASE WHEN r <= ceil(n * CAST({fixed.TEST_SIZE} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
FROM orders JOIN groups USING (o_custkey)""",
        "metrics_by_tool": f"""WITH {_PAIRS}, named AS (SELECT *, {_TOOL} AS tool FROM pairs),
counted AS (SELECT tool, grouping(tool) = 1 AS is_total, {_TOTALS} FROM named GROUP BY ROLLUP (tool))
SELECT tool, is_total, {_MEASURES} FROM counted""",
        "metrics_by_window": _windows(6, 6, "tool"),
        "metrics_sliding": _windows(24, 6),
        "stream_metrics": f"""SELECT * FROM ({_windows(6, 6, "tool")}) w
WHERE window_end <= (SELECT max(ts) - INTERVAL '1 day' FROM events)""",
        "take_first_half": "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT (SELECT count(*) // 2 FROM lineitem)",
        "namespace_matches": f"""WITH {_OPS}, {_NAMESPACES}
SELECT DISTINCT path, namespace FROM numbered JOIN namespaces ON contains(path, namespace)""",
        "filter_namespace_table": f"""WITH {_OPS}, {_NAMESPACES}
SELECT spec_id, slot AS path_pos, path, 1 AS method_pos, method FROM called
WHERE EXISTS (SELECT 1 FROM namespaces WHERE part_id % 50 <> 0 AND contains(path, namespace))""",
        "dataset_profile_merged": f"""WITH {_TOOLS}, {_ARGS}, {_SAMPLES}, n AS (SELECT count(*) AS num_samples FROM samples)
SELECT num_samples, {_SIZE_CATEGORY} AS size_category, TRUE AS num_tools_near FROM n""",
        "filter_requests": f"WITH {_REQUESTS} SELECT request_id, request FROM wanted",
        "route_tool": f"WITH {_REQUESTS} SELECT request_id, {_cascade()} AS tool_key FROM requests",
        "lookup_tool": f"""WITH {_REQUESTS}, keyed AS (
  SELECT request_id, request, CASE WHEN request_id % 7 = 0 THEN 'no_such_tool' ELSE {_cascade()} END AS tool_key FROM requests),
looked AS (
  SELECT request_id, tool_key, name, CASE WHEN {_strip("request")} = '' THEN 'blank_request'
    WHEN name IS NULL THEN 'unknown_tool' ELSE 'ok' END AS status FROM keyed LEFT JOIN catalogue USING (tool_key))
SELECT request_id, tool_key, CASE WHEN status = 'ok' THEN name END AS name, status FROM looked""",
        "route_requests": f"""WITH {_REQUESTS}
SELECT request_id, tool_key, 'ok' AS status, {_prompt('request', 'definition')} AS prompt FROM found""",
        "json_validity": f"""WITH {_PAIRS}
SELECT sample_id, valid AS valid_python, valid AND NOT contains(generated, 'NaN') AS valid_strict FROM pairs""",
        "parse_response": f"""WITH {_PAIRS}
SELECT sample_id, CASE WHEN NOT valid THEN NULL WHEN generated = 'null' THEN 'null' WHEN generated = '[]' THEN 'array'
    WHEN substr(generated, 1, 1) = '"' THEN 'string' ELSE 'object' END AS kind,
  CASE WHEN NOT valid OR NOT contains(generated, '"name"') THEN NULL
    WHEN contains(generated, 'no_') THEN 'no_' || event_type
    ELSE event_type END AS name,
  {_strip("generated")} AS raw FROM pairs""",
        "compare_calls": f"""WITH {_PAIRS}, side AS (
  SELECT *, valid AND generated <> 'null' AND expected <> 'null' AND NOT starts_with(expected, 'not') AS both_there FROM pairs)
SELECT sample_id, CASE WHEN both_there AND error IS NULL THEN name END AS name_matches,
  CASE WHEN both_there AND error IS NULL THEN args OR starts_with(generated, '{{"name": "no_') OR starts_with(generated, '{{"arguments"') END AS arguments_match,
  error AS compare_error FROM side""",
        "evaluate_samples": f"""WITH {_PAIRS}
SELECT sample_id, valid AS is_valid_json, name AS name_correct, args AS arguments_correct, error FROM pairs""",
        "pair_predictions": f"""WITH {_PAIRS}, {_PAIRED}
SELECT sample_id, expected, generated, CASE WHEN lost THEN error END AS error FROM paired""",
        "evaluate_dataset": f"WITH {_PAIRS}, {_PAIRED}, {_metrics('paired')} SELECT * FROM metrics",
        "eval_metrics": f"WITH {_PAIRS}, {_metrics('pairs')} SELECT * FROM metrics",
        "metrics_report": f"""WITH {_PAIRS}, {_metrics('pairs')}
SELECT total_samples, valid_json_count, correct_tool_name_count, correct_arguments_count,
  round(json_validity_rate, 4) AS json_validity_rate, round(tool_name_accuracy, 4) AS tool_name_accuracy,
  round(argument_accuracy, 4) AS argument_accuracy, round(overall_accuracy, 4) AS overall_accuracy,
  round(total_inference_time, 2) AS total_inference_time_seconds,
  round(avg_inference_time, 4) AS avg_inference_time_seconds,
  round(tokens_per_second, 2) AS tokens_per_second, error_count FROM metrics""",
        "metrics_text": f"""WITH {_PAIRS}, {_metrics('pairs')}
SELECT printf({_q(fixed.METRICS_BLOCK)}, total_samples,
  printf('%.2f%%', json_validity_rate * 100), valid_json_count, total_samples,
  printf('%.2f%%', tool_name_accuracy * 100), correct_tool_name_count, total_samples,
  printf('%.2f%%', argument_accuracy * 100), correct_arguments_count, total_samples,
  printf('%.2f%%', overall_accuracy * 100), printf('%.3f', avg_inference_time),
  printf('%.1f', tokens_per_second), error_count) AS text FROM metrics""",
        "card_metrics": f"""WITH {_PAIRS}, {_metrics('pairs')}
SELECT json_validity_rate * 100 AS json_validity_rate, tool_name_accuracy * 100 AS tool_name_accuracy,
  argument_accuracy * 100 AS argument_accuracy FROM metrics""",
        "eval_errors": f"""WITH {_PAIRS}
SELECT sample_id AS index, instruction, error FROM pairs WHERE error IS NOT NULL""",
        "dataset_profile": f"""WITH {_TOOLS}, {_ARGS}, {_SAMPLES}, n AS (SELECT count(*) AS num_samples, (SELECT count(DISTINCT tool_name) FROM tools) AS num_tools FROM samples)
SELECT num_samples, num_tools, {_SIZE_CATEGORY} AS size_category FROM n""",
        "generate_tool_calls": """WITH sized AS (SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents)
SELECT doc_id, CASE WHEN n % 10 = 3 THEN NULL WHEN n % 2 = 1 THEN '{"chars": ' || n || '}' ELSE 'chars: ' || n END AS generated,
  CASE WHEN n % 10 = 3 THEN 0 ELSE n % 7 END AS num_tokens,
  CASE WHEN n % 10 = 3 THEN 'generation_failed' END AS error, CASE WHEN n % 10 = 3 THEN 'refused' END AS error_message,
  CASE WHEN n % 10 <> 3 AND n % 2 = 1 THEN n END AS chars FROM sized""",
    }
