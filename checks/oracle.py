"""SQL that gives the same results as the registered queries, without Spark.

Where the input is made from known values, the expected text is put together from the same
values and never touches a detector. Elsewhere plain patterns without look-around find the
values and keep the character before them.
"""
from __future__ import annotations

# --- patterns on documents: (keep)(value)(keep)
_EMAIL = r"[\p{L}\p{N}\p{M}._%+-]+@(?:[\p{L}\p{N}\p{M}-]+\.)+\p{L}{2,}"
_LEFT = "(^|[^0-9A-Za-z])"
_RIGHT = r"\b()"  # takes no character, so a value right after this one is found too
_PATTERNS = {
    "email": rf"()(?:{_EMAIL})()",
    "credit_card": rf"{_LEFT}(?:\d{{4}}(?:-\d{{4}}){{3}}|\d{{4}}(?: \d{{4}}){{3}}|[2-9]\d{{15}}"
                   rf"|3[47]\d{{2}}[ -]?\d{{6}}[ -]?\d{{5}}){_RIGHT}",
    "ssn": rf"{_LEFT}(?:\d{{3}}-\d{{2}}-\d{{4}}|\d{{3}} \d{{2}} \d{{4}}){_RIGHT}",
    "ip_address": rf"{_LEFT}(?:(?:25[0-5]|2[0-4]\d|[01]?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|[01]?\d?\d){_RIGHT}",
    "phone": r"(^|[^0-9A-Za-z])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4})\b()",
    "address": rf"{_LEFT}\d{{1,6}}(?: [A-Z][\w'-]*){{1,4}}? (?:Street|Avenue|Road|Boulevard|Drive|Lane)()",
    "name": r"((?:^|[^A-Za-z])(?:Mr|Mrs|Ms|Miss|Mx|Dr|Prof|[\x01f]or|FOR)\.? )"
            r"[A-Z][a-z][\w'-]*(?: [A-Z][a-z][\w'-]*){1,3}()",
}
_ORDER = ("email", "credit_card", "ssn", "ip_address", "phone", "address", "name")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replace(column: str, category: str, token: str | None = None) -> str:
    value = f"[{category.upper()}]" if token is None else token
    if category == "name":  # "For" starts the next name, so it must not look like a part of one
        column = f"replace({column}, 'For ', chr(1) || 'or ')"
        return f"replace({_replace_plain(column, category, value)}, chr(1) || 'or ', 'For ')"
    return _replace_plain(column, category, value)


def _replace_plain(column: str, category: str, value: str) -> str:
    return (f"regexp_replace({column}, {_quoted(_PATTERNS[category])}, "
            f"{_quoted(chr(92) + '1' + value + chr(92) + '2')}, 'g')")


def _mask(column: str, *categories: str, token: str | None = None) -> str:
    for category in (c for c in _ORDER if c in categories):
        column = _replace(column, category, token)
    return column


_DEFAULT = ("email", "credit_card", "ssn", "phone", "address", "name")


def _documents(*categories: str) -> str:
    return f"SELECT doc_id, source, {_mask('text', *categories)} AS text FROM documents"


# --- notes: the same values as the Spark side makes them
def _digits(value: str, width: int) -> str:
    return f"lpad(CAST(({value}) % {10 ** width} AS VARCHAR), {width}, '0')"


def _pick(values: str, number: str, count: int) -> str:
    return f"[{values}][CAST({number} % {count} AS INT) + 1]"


_n, _c = "o_orderkey", "o_custkey"
_VALUES = {
    "name": _pick("'Alice','Bruno','Carla','Dmitri','Elena','Farid','Grace','Hiro'", _n, 8) + " || ' ' || "
            + _pick("'Archer','Bennett','Castillo','Dawson','Eriksen','O''Brien','Fontaine'", _c, 7),
    "email": f"'user.' || {_c} || '@mail' || ({_n} % 7) || '.example.com'",
    "phone": f"CASE {_n} % 3 WHEN 0 THEN '(555) ' || {_digits(_c + ' + 100', 3)} || '-' || {_digits(_n, 4)}"
             f" WHEN 1 THEN '555.' || {_digits(_c + ' + 100', 3)} || '.' || {_digits(_n, 4)}"
             f" ELSE '+1 555-' || {_digits(_c + ' + 100', 3)} || '-' || {_digits(_n, 4)} END",
    "ssn": f"{_digits(_c + ' + 900', 3)} || '-' || {_digits(_n, 2)} || '-' || {_digits(_n + ' * 7', 4)}",
    "credit_card": f"CASE {_n} % 2 WHEN 0 THEN '4532-' || {_digits(_n, 4)} || '-' || {_digits(_c, 4)} || '-4242'"
                   f" ELSE '3782-' || {_digits(_n, 6)} || '-' || {_digits(_c, 5)} END",
    "date_of_birth": f"{_digits(_n + ' % 12 + 1', 2)} || '/' || {_digits(_n + ' % 28 + 1', 2)} || '/19' || "
                     f"{_digits(_c + ' % 60 + 40', 2)}",
    "ip_address": f"'10.20.' || ({_n} % 256) || '.' || ({_c} % 256)",
    "address": f"({_n} % 9000 + 1) || ' ' || "
               + _pick("'Oak Street','Harbor Blvd','Maple Lane','De Anza Blvd','K Street NW'", _n, 5)
               + f" || CASE WHEN {_n} % 4 = 0 THEN ', Apt 4B' ELSE '' END || ', ' || "
               + _pick("'Springfield, CA 90210','New York, NY 10005','San Francisco, CA 94107'", _c, 3),
    "account": f"'0918-' || {_digits(_n, 4)} || '-' || {_digits(_c, 4)}",
    "employee": f"'EMP-' || {_digits(_n, 6)}",
}
_CATEGORIES = ("email", "phone", "ssn", "credit_card", "name", "address", "ip_address", "date_of_birth")


def _notes(replaced: dict[str, str], source: str = "notes") -> str:
    """The notes with some values replaced; replacements are SQL expressions."""
    v = {name: f"({replaced.get(name, name)})" for name in _VALUES}
    return (f"SELECT note_id, CASE note_id % 3 "
            f"WHEN 0 THEN 'Profile of customer ' || {v['name']} || ', DOB: ' || {v['date_of_birth']} || ', SSN: ' || "
            f"{v['ssn']} || '. Phone: ' || {v['phone']} || '. Address: ' || {v['address']} || '. Account ' || "
            f"{v['account']} || '.' "
            f"WHEN 1 THEN 'Found account for ' || {v['name']} || ' (' || {v['email']} || '), card ' || "
            f"{v['credit_card']} || ', last seen from ' || {v['ip_address']} || ' on 2026-05-28 by ' || "
            f"{v['employee']} || '.' "
            f"ELSE 'Order by Dr. ' || {v['name']} || '; ship to: ' || {v['address']} || '; call ' || {v['phone']} "
            f"|| ' or mail ' || {v['email']} || '. Tracking 1Z999AA10123456784, account ' || {v['account']} || '.' "
            f"END AS text FROM {source}")


_WITH_NOTES = ("WITH notes AS (SELECT o_orderkey AS note_id, "
               + ", ".join(f"{sql} AS {name}" for name, sql in _VALUES.items()) + " FROM orders) ")


def _tokens(*names: str) -> dict[str, str]:
    return {n: f"'[{n.upper()}]'" for n in names}


def _masked_notes(replaced: dict[str, str]) -> str:
    return _WITH_NOTES + _notes(replaced)


def _hash(category: str) -> str:
    value = category
    if category in ("ssn", "credit_card"):
        value = f"regexp_replace({category}, '[^0-9]', '', 'g')"
    elif category == "phone":
        value = "right(regexp_replace(phone, '[^0-9]', '', 'g'), 10)"
    elif category != "date_of_birth":
        value = f"lower({category})"
    return (f"'[{category.upper()}:' || substr(translate(sha256('a secret of the user' || {value}), "
            f"'0123456789abcdef', 'abcdefghijklmnop'), 1, 20) || ']'")


_LISTED = (_WITH_NOTES + ", texts AS (" + _notes({}) + "), marked AS (" + _notes({"name": "'[NAME]'"}) + "), "
           "listed AS (SELECT DISTINCT name FROM notes WHERE note_id % 3 = 1) "
           "SELECT t.note_id, CASE WHEN n.name IN (SELECT name FROM listed) THEN m.text ELSE t.text END AS text "
           "FROM texts t JOIN marked m USING (note_id) JOIN notes n USING (note_id)")

# --- spans
_SPAN_TIMES = ("epoch_ns(ts) AS start_time_unix_nano, "
               "epoch_ns(ts) + CAST(round(value * 1000000) AS BIGINT) AS end_time_unix_nano")


def _attributes(user: str, client: str, copy: str, phone: str, employee: str,
                service: str = "'svc-' || (event_id % 5)") -> str:
    k = "json_extract_string(props, '$.k')"
    return ("CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 5 = 1 THEN "
            f"'{{\"app.user\":\"' || {user} || '\",\"http.status_code\":200,\"k\":' || {k} || "
            f"',\"nested\":{{\"client\":\"' || {client} || '\",\"copies\":[\"first\",\"' || {copy} || '\"]}},"
            f"\"note\":\"Call ' || {phone} || '\\nfor ' || {employee} || '\",\"service.name\":\"' || {service} || '\"}}' "
            f"ELSE '{{\"http.status_code\":200,\"k\":' || {k} || ',\"service.name\":\"' || {service} || '\"}}' END")


_USER, _CLIENT = "'user' || user_id || '@mail.example.com'", "'10.1.2.' || (event_id % 200)"
_COPY = "'u' || event_id || '@corp.example.org'"
_PHONE, _EMPLOYEE = f"'(555) 201-' || {_digits('event_id', 4)}", f"'EMP-' || {_digits('event_id', 6)}"
_RAW_ATTRIBUTES = _attributes(_USER, _CLIENT, _COPY, _PHONE, _EMPLOYEE)
_MASKED_ATTRIBUTES = _attributes("'[EMAIL]'", _CLIENT, "'[EMAIL]'", "'[PHONE]'", _EMPLOYEE)


def _events(mail: str) -> str:
    return ("CASE event_id % 3 WHEN 1 THEN '[]' WHEN 2 THEN '[{\"time_unix_nano\":' || epoch_ns(ts) || "
            "',\"name\":\"exception\",\"attributes\":{\"message\":\"no mail for ' || " + mail +
            " || '\"},\"dropped_attributes_count\":0}]' END")


_RAW_MAIL = "'bob' || event_id || '@shop.example.com'"
_MASKED_EVENTS = _events("'[EMAIL]'")


def _resource(owner: str) -> str:
    return ("CASE WHEN event_id % 7 > 1 THEN '{\"owner\":\"' || " + owner +
            " || '\",\"service.name\":\"svc-' || (event_id % 5) || '\"}' END")


_RESOURCE_DROPPED = "CASE WHEN event_id % 7 = 1 THEN 1 WHEN event_id % 7 > 1 THEN 0 END"


def _spans(attributes: str, events: str, owner: str) -> str:
    return ("SELECT 'rec-' || event_id AS record_id, epoch_us(ts) AS time_micros, CAST(ts AS DATE) AS date, "
            "'svc-' || (event_id % 5) AS service_name, CAST(user_id AS VARCHAR) AS trace_id, "
            "CAST(event_id AS VARCHAR) AS span_id, CAST(NULL AS VARCHAR) AS trace_state, "
            "CASE WHEN event_id % 4 <> 0 THEN CAST(event_id - 1 AS VARCHAR) END AS parent_span_id, "
            "1 AS flags, event_type AS name, CASE WHEN event_id % 3 = 0 THEN 'SERVER' ELSE 'CLIENT' END AS kind, "
            f"{_SPAN_TIMES}, {attributes} AS attributes, 0 AS dropped_attributes_count, {events} AS events, "
            "0 AS dropped_events_count, CAST(NULL AS VARCHAR) AS links, 0 AS dropped_links_count, "
            f"'OK' AS status_code, {_resource(owner)} AS resource_attributes, "
            f"{_RESOURCE_DROPPED} AS resource_dropped, CAST(NULL AS VARCHAR) AS resource_schema_url, "
            "CAST(NULL AS VARCHAR) AS instrumentation_scope, CAST(NULL AS VARCHAR) AS span_schema_url FROM events")


_OWNER = "'ops' || (event_id % 100) || '@corp.example.com'"
_REDACTED_SPANS = _spans(_MASKED_ATTRIBUTES, _MASKED_EVENTS, "'[EMAIL]'")
_VIEW_COLUMNS = ("trace_id, span_id, parent_span_id, name, kind, start_time_unix_nano, end_time_unix_nano, "
                 "status_code, date, service_name, time_micros, instrumentation_scope, links, attributes, "
                 "events, resource_attributes, resource_dropped")

# --- logs and annotations
_LOG_DATE = "CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS DATE)"


def _log_attributes(reviewer: str) -> str:
    return ("'{\"lang\":' || to_json(lang) || ',\"n_chars\":' || n_chars || ',\"reviewer\":\"' || "
            + reviewer + " || '\"}'")


_REVIEWER = "'rev' || doc_id || '@mail.example.com'"
_LOGS = (f"SELECT 'log-' || doc_id AS record_id, epoch_us(CAST({_LOG_DATE} AS TIMESTAMP)) AS time_micros, "
         f"{_LOG_DATE} AS date, source AS service_name, 'document' AS event_name, CAST(doc_id AS VARCHAR) AS trace_id, "
         f"CAST(doc_id AS VARCHAR) AS span_id, epoch_ns(CAST({_LOG_DATE} AS TIMESTAMP)) AS time_unix_nano, "
         f"epoch_ns(CAST({_LOG_DATE} AS TIMESTAMP)) AS observed_time_unix_nano, 9 AS severity_number, "
         f"'INFO' AS severity_text, {_mask('text', *_DEFAULT)} AS body, {_log_attributes(chr(39) + '[EMAIL]' + chr(39))} "
         "AS attributes, 0 AS dropped_attributes_count, 0 AS flags, '{\"host\":\"10.0.0.1\"}' AS resource_attributes, "
         "0 AS resource_dropped, CAST(NULL AS VARCHAR) AS resource_schema_url, "
         "CAST(NULL AS VARCHAR) AS instrumentation_scope, CAST(NULL AS VARCHAR) AS log_schema_url FROM documents")
_ANNOTATIONS = (
    "SELECT CAST(doc_id AS VARCHAR) AS target_id, doc_id || '-' || label AS annotation_id, "
    "'assessment' AS annotation_type, label AS name, CAST(score AS VARCHAR) AS value, "
    "'scored ' || label AS comment, epoch_us(TIMESTAMP '2024-02-01') AS created_micros, 'rater' AS created_by "
    "FROM (SELECT doc_id, 'quality' AS label, quality AS score FROM labels "
    "UNION ALL SELECT doc_id, 'toxic', toxic FROM labels)")
_TRACES = (f"WITH s AS ({_REDACTED_SPANS}), a AS ({_ANNOTATIONS}), "
           "lists AS (SELECT target_id, string_agg(concat_ws('|', annotation_id, name, value, comment, created_by), "
           "';' ORDER BY annotation_id) AS annotations, count(*) AS n FROM a GROUP BY target_id) ")


def _contains(category: str, column: str) -> str:
    return f"regexp_matches({column}, {_quoted(_PATTERNS[category])})"


def _coverage() -> str:
    found = ("email", "credit_card", "ip_address", "phone")
    stages, text = [], "text"
    for category in found:
        stages.append((category, text))
        text = _replace(text, category)
    counts = ", ".join(f"len(regexp_extract_all({t}, {_quoted(_PATTERNS[c])})) AS {c}" for c, t in stages)
    rows = " UNION ALL ".join(
        f"SELECT 'logs' AS table_name, date, count(*) AS rows, '{c}' AS category, "
        f"count(*) FILTER ({c} > 0) AS rows_with_hit, CAST(sum({c}) AS BIGINT) AS matches FROM d GROUP BY date"
        for c in found)
    return f"WITH d AS (SELECT {_LOG_DATE} AS date, {counts} FROM documents) {rows}"


def _leaks() -> str:
    rows = []
    for category in ("email", "credit_card", "ssn", "ip_address", "phone"):
        rows += [f"SELECT 'logs' AS table_name, '{column}' AS column_name, '{category}' AS category, "
                 f"count(*) FILTER ({_contains(category, text)}) AS rows_with_hit FROM d"
                 for column, text in (*((c, c) for c in (
                     "record_id", "service_name", "event_name", "trace_id", "span_id", "severity_text", "body", "attributes",
                     "resource_schema_url", "instrumentation_scope", "log_schema_url")), ("resource", "resource_attributes"))]
    return f"WITH d AS ({_LOGS}) " + " UNION ALL ".join(rows)


def _recall() -> str:
    known = ("email", "phone", "ssn", "credit_card", "date_of_birth", "ip_address", "address", "name",
             "account", "employee")
    truth = " UNION ALL ".join(
        f"SELECT '{k}' AS category, {k} AS value, {'false' if k in ('account', 'employee') else 'true'} AS sensitive, "
        f"t.text, m.text AS masked, m.note_id IS NOT NULL AS found FROM notes JOIN t USING (note_id) "
        f"LEFT JOIN m ON m.note_id = notes.note_id "
        f"WHERE contains(t.text, {k})" for k in known)
    return (_WITH_NOTES + ", t AS (" + _notes({}) + "), m AS (" + _notes(_tokens(*_CATEGORIES)) + "), truth AS ("
            + truth + ") SELECT category, count(*) FILTER (sensitive) AS sensitive_values, "
            "count(*) FILTER (sensitive AND NOT contains(masked, value)) AS masked_values, "
            "count(*) FILTER (NOT sensitive) AS harmless_values, "
            "count(*) FILTER (NOT sensitive AND contains(masked, value)) AS kept_values, "
            "count(*) FILTER (NOT found) AS missing_values, "
            "round(count(*) FILTER (sensitive AND NOT contains(masked, value)) / "
            "nullif(count(*) FILTER (sensitive), 0), 4) AS recall, "
            "round(count(*) FILTER (NOT sensitive AND contains(masked, value)) / "
            "nullif(count(*) FILTER (NOT sensitive), 0), 4) AS kept_share FROM truth GROUP BY category")


# Every turn once: an answer goes to the turn before it, if that isn't an answer itself.
_RECORDS = ("SELECT conv_id, place AS turn, max(text) FILTER (NOT answer) AS prompt, max(text) FILTER (answer) AS response FROM ("
            "SELECT conv_id, text, coalesce(role = 'assistant', false) AS answer, "
            "CASE WHEN coalesce(role = 'assistant', false) THEN turn - 1 ELSE turn END AS place FROM conversations) "
            "GROUP BY conv_id, place")


def _inner_json(key: str, value: str) -> str:
    """A JSON document held as a string inside another one."""
    return f"to_json('{{\"{key}\":' || coalesce(CAST(to_json({value}) AS VARCHAR), 'null') || '}}')"


_MASKED_RECORD = ("email", "credit_card", "ssn", "phone")
_SECRET = r'(?:api_key|token|secret|password) ?[=:] ?"?[0-9a-zA-Z]{16,}"?'
_STREAM_LOGS = (f"SELECT 'log-' || doc_id AS record_id, {_LOG_DATE} AS date, ")

ORACLE: dict[str, str] = {
    "hits_by_source": (
        f"WITH d AS (SELECT source, text, {_mask('text', *_DEFAULT)} AS masked FROM documents) "
        "SELECT source, count(*) AS documents, count(*) FILTER (masked <> text) AS masked_documents, "
        r"CAST(sum(len(regexp_extract_all(masked, '\[(?:EMAIL|PHONE|SSN|CREDIT_CARD|ADDRESS|NAME)\]'))) AS BIGINT) AS values "
        "FROM d GROUP BY source"),
    "mask_email": _documents("email"),
    "mask_phone": _documents("phone"),
    "mask_ip": _documents("ip_address"),
    "mask_card": _documents("credit_card"),
    "mask_pages": (f"SELECT page_id, {_mask('url', 'email', 'phone', 'ip_address')} AS url, "
                   f"{_mask('html', 'email', 'phone', 'ip_address')} AS html FROM pages"),
    "mask_all_default": _documents(*_DEFAULT),
    "mask_none": "SELECT doc_id, source, text FROM documents",
    "custom_patterns": ("SELECT doc_id, source, "
                        + _mask(f"regexp_replace(text, {_quoted(_SECRET)}, '[SECRET]', 'g')", "email")
                        + " AS text FROM documents"),
    **{f"notes_{c}": _masked_notes(_tokens(c)) for c in _CATEGORIES},
    "notes_all": _masked_notes({**_tokens(*_CATEGORIES), "employee": "'[EMPLOYEE_ID]'"}),
    "mode_hash": _masked_notes({c: _hash(c) for c in _CATEGORIES}),
    "mode_remove": _masked_notes({c: "''" for c in _CATEGORIES}),
    "mask_character": _masked_notes({c: "'********'" for c in _CATEGORIES}),
    "listed_names": _LISTED,
    "listed_names_joined": _LISTED,
    "listed_names_any_length": (
        "SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS note_id, 'Case ' || c_custkey || ': spoke with ' || "
        "CASE WHEN c_custkey % 3 <> 0 THEN '[NAME]' "
        "WHEN c_custkey % 2 = 0 THEN 'Anna van der K' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') "
        "ELSE 'Maria del Carmen K' || translate(CAST(c_custkey AS VARCHAR), '0123456789', 'abcdefghij') || ' Garcia' END "
        "|| '''s agent and maria del carmen, not Anna van Dam.' AS text FROM customer"),
    "masked_by_model": "SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS text FROM documents",
    "leaf_mask_attributes": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, "
        + _attributes("'[EMAIL]'", "'[IP_ADDRESS]'", "'[EMAIL]'", "'[PHONE]'", "'[EMPLOYEE_ID]'")
        + " AS attributes FROM events"),
    "allowlisted_keys": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, "
        + _attributes(_USER, "'[IP_ADDRESS]'", "'[EMAIL]'", "'[PHONE]'", _EMPLOYEE)
        + " AS attributes FROM events"),
    "allowlisted_paths": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, "
        + _attributes(_USER, _CLIENT, "'[EMAIL]'", "'[PHONE]'", _EMPLOYEE)
        + " AS attributes FROM events"),
    "mask_events": f"SELECT CAST(event_id AS VARCHAR) AS span_id, {_MASKED_EVENTS} AS events FROM events",
    "mask_events_cast": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, CASE event_id % 3 WHEN 1 THEN '[]' WHEN 2 THEN "
        "'[{' || epoch_ns(ts) || ', exception, {\"message\":\"no mail for [EMAIL]\"}, 0}]' END AS events FROM events"),
    "mask_resource": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, event_id % 7 = 0 AS no_resource, "
        f"{_resource(chr(39) + '[EMAIL]' + chr(39))} AS resource_attributes, "
        f"{_RESOURCE_DROPPED} AS resource_dropped FROM events"),
    "mask_resource_variant": (
        "SELECT CAST(event_id AS VARCHAR) AS span_id, event_id % 7 = 0 AS no_resource, "
        f"{_resource(chr(39) + '[EMAIL]' + chr(39))} AS resource_attributes, "
        f"{_RESOURCE_DROPPED} AS resource_dropped FROM events"),
    "mask_json_strings": (
        "SELECT c_custkey, '{\"id\":' || c_custkey || ',\"mail\":\"[EMAIL]\",\"nested\":{\"note\":\"line one\\n[PHONE]\"}}' "
        "AS json FROM customer"),
    "redacted_spans": _REDACTED_SPANS,
    "redacted_logs": _LOGS,
    "redacted_annotations": _ANNOTATIONS,
    "unmasked_spans": _spans(_RAW_ATTRIBUTES, _events(_RAW_MAIL), _OWNER),
    "more_fields": (
        "SELECT annotation_id, name, replace(comment, 'toxic', '[LABEL]') AS comment, '[RATER]' AS created_by, value "
        f"FROM ({_ANNOTATIONS})"),
    "trace_filter": f"SELECT span_id, name, attributes FROM ({_REDACTED_SPANS}) WHERE name = 'error'",
    "redacted_view": f"SELECT {_VIEW_COLUMNS} FROM ({_REDACTED_SPANS})",
    "trace_unified": (
        _TRACES + "SELECT s.trace_id, s.date, min(start_time_unix_nano) AS request_time_nano, "
        "max(end_time_unix_nano) - min(start_time_unix_nano) AS execution_duration_nano, "
        "string_agg(concat_ws('|', span_id, coalesce(parent_span_id, '-'), name, kind, coalesce(attributes, '-'), "
        "coalesce(events, '-')), ';' ORDER BY start_time_unix_nano, span_id) AS spans, "
        "first(lists.annotations) AS annotations, 0 AS part "
        "FROM s LEFT JOIN lists ON s.trace_id = lists.target_id GROUP BY s.trace_id, s.date"),
    "trace_unified_parts": (
        _TRACES + "SELECT s.trace_id, s.date, min(start_time_unix_nano) AS request_time_nano, "
        "max(end_time_unix_nano) - min(start_time_unix_nano) AS execution_duration_nano, count(*) AS spans, "
        "coalesce(first(lists.n), 0) AS annotations "
        "FROM s LEFT JOIN lists ON s.trace_id = lists.target_id GROUP BY s.trace_id, s.date"),
    "trace_unified_tags": (
        "WITH s AS (SELECT CAST(user_id AS VARCHAR) AS trace_id, CAST(ts AS DATE) AS date, "
        f"CAST(event_id AS VARCHAR) AS span_id, {_SPAN_TIMES} FROM events), "
        "a AS (SELECT CAST(doc_id AS VARCHAR) AS target_id, 'quality=' || quality AS tags, "
        "'toxic=' || toxic AS assessments FROM labels UNION ALL SELECT CAST(doc_id AS VARCHAR), "
        "'quality=' || quality, 'toxic=' || toxic FROM labels WHERE doc_id % 2 = 1) "
        "SELECT trace_id, date, min(start_time_unix_nano // 1000) AS request_micros, "
        "max(end_time_unix_nano // 1000) - min(start_time_unix_nano // 1000) AS duration_micros, "
        "string_agg(span_id, ';' ORDER BY start_time_unix_nano, span_id) AS spans, tags, assessments "
        "FROM s LEFT JOIN a ON s.trace_id = a.target_id GROUP BY trace_id, date, tags, assessments"),
    "annotations_by_target": (
        "SELECT target_id, 0 AS part, string_agg(name || '=' || value, ',' ORDER BY annotation_id) AS annotations "
        f"FROM ({_ANNOTATIONS}) GROUP BY target_id"),
    "retention_keep": ("SELECT 'rec-' || event_id AS record_id, CAST(ts AS DATE) AS date FROM events "
                       "WHERE CAST(ts AS DATE) >= DATE '2024-01-15'"),
    "retention_plan": ("SELECT CAST(ts AS DATE) AS date, count(*) AS rows FROM events "
                       "WHERE CAST(ts AS DATE) < DATE '2024-01-15' GROUP BY 1"),
    "raw_vs_redacted": (
        "SELECT CAST(user_id AS VARCHAR) AS trace_id, CAST(event_id AS VARCHAR) AS span_id, "
        f"{_RAW_ATTRIBUTES} AS raw, {_MASKED_ATTRIBUTES} AS redacted, CAST(1 AS BIGINT) AS raw_rows, CAST(1 AS BIGINT) AS redacted_rows "
        "FROM events WHERE event_id % 10 <> 0"),
    "raw_vs_redacted_sample": (
        "SELECT CAST(user_id AS VARCHAR) AS trace_id, CAST(event_id AS VARCHAR) AS span_id, "
        f"{_RAW_ATTRIBUTES} AS raw, {_MASKED_ATTRIBUTES} AS redacted, CAST(1 AS BIGINT) AS raw_rows, CAST(1 AS BIGINT) AS redacted_rows "
        "FROM events WHERE event_id % 10 <> 0 AND event_type = 'error' ORDER BY trace_id, span_id LIMIT 5"),
    "unredacted_rows": ("SELECT 'rec-' || event_id AS record_id, CAST(ts AS DATE) AS date FROM events "
                        "WHERE CAST(ts AS DATE) >= DATE '2024-01-20'"),
    "coverage": _coverage(),
    "leak_scan": _leaks(),
    "recall_by_category": _recall(),
    "prompt_spans": (
        f"WITH r AS ({_RECORDS}), k AS (SELECT *, substr(sha256(conv_id || '/' || turn), 1, 32) AS trace_id FROM r) "
        "SELECT trace_id, substr(trace_id, 1, 16) AS span_id, 'pii-test-interaction' AS name, DATE '2024-01-01' AS date, "
        f"'{{\"span.inputs\":' || {_inner_json('prompt', _mask('prompt', *_MASKED_RECORD))} || ',\"span.outputs\":' || "
        f"{_inner_json('response', _mask('response', *_MASKED_RECORD))} || ',\"test.line_number\":' || turn || "
        "',\"test.purpose\":\"pii-redaction-validation\"}' AS attributes, "
        "'{\"deployment\":\"redaction-demo\",\"service.name\":\"generator\"}' AS resource_attributes FROM k"),
    "prompt_lines": _RECORDS,
    "stream_incremental": (
        _STREAM_LOGS + f"{_mask('text', *_DEFAULT)} AS body, "
        + _log_attributes("'[EMAIL]'") + " AS attributes FROM documents"),
    "stream_full_refresh": (
        _STREAM_LOGS + f"{_mask('text', 'ip_address', token='')} AS body, {_log_attributes(_REVIEWER)} AS attributes "
        "FROM documents"),
    "stream_after_expiry": (
        f"SELECT {_LOG_DATE} AS date, CASE WHEN {_LOG_DATE} < DATE '2024-01-10' THEN 0 ELSE count(*) END AS raw_rows, "
        f"count(*) AS redacted_rows FROM documents GROUP BY {_LOG_DATE}"),
    "published_tables": (
        f"SELECT {_LOG_DATE} AS date, source AS service_name, count(*) AS rows FROM documents GROUP BY 1, 2"),
    "expire_table": (
        f"SELECT {_LOG_DATE} AS date, count(*) AS rows FROM documents "
        f"WHERE {_LOG_DATE} >= DATE '2024-01-10' GROUP BY 1"),
    "expire_spans": ("SELECT CAST(ts AS DATE) AS date, count(*) AS rows FROM events "
                     "WHERE CAST(ts AS DATE) >= DATE '2024-01-10' GROUP BY 1"),
    "source_counts": (
        "SELECT 'spans' AS kind, count(*) AS rows FROM events UNION ALL "
        "SELECT 'logs', count(*) FROM documents UNION ALL "
        "SELECT 'annotations', 2 * count(*) FROM labels"),
    "clustered_layout": ("SELECT CAST(ts AS DATE) AS date, count(*) AS rows, count(DISTINCT user_id) AS traces, "
                         "true AS adjacent FROM events GROUP BY 1"),
}
# The pipeline's tables equal those of one batch.
ORACLE |= {"stream_spans": ORACLE["redacted_spans"], "stream_annotations": ORACLE["redacted_annotations"],
           "trace_unified_maintained": ORACLE["trace_unified"]}
