"""The registered queries as DuckDB SQL over the same tables, written independently."""

from .. import fixed_values as V
from . import planted
from .queries import AS_OF, LONG_LIST, OWN_DOMAINS, RULE_QUERIES, TENANT_TERMS, WEIGHTS_B


def q(value):
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def pick(values, index):
    return f"([{', '.join(map(q, values))}])[({index}) + 1]"


def has(column, terms):
    return "(" + " OR ".join(f"contains({column}, {q(t)})" for t in terms) + ")"


def count(column, terms):
    return "(" + " + ".join(f"contains({column}, {q(t)})::INT" for t in dict.fromkeys(terms)) + ")"


def among(values):
    return "(" + ", ".join(map(q, values)) + ")"


def ends(column, suffixes):
    return "(" + " OR ".join(f"ends_with({column}, {q(s)})" for s in suffixes) + ")"


def evidence(type_, *args):
    pieces = V.EVIDENCE[type_].replace("%%", "\0").replace("%d", "%s").split("%s")
    out = [q(pieces[0].replace("\0", "%"))]
    for arg, piece in zip(args, pieces[1:], strict=True):
        out += [f"CAST({arg} AS VARCHAR)", q(piece.replace("\0", "%"))]
    return "(" + " || ".join(out) + ")"


ATTACHMENT_LISTS = ", ".join(
    "NULL" if v is None else "[" + ", ".join(map(q, v)) + "]::VARCHAR[]" for v in planted.ATTACHMENTS)

EMAILS = f"""
nd AS (SELECT count(*) AS n FROM documents),
emails AS MATERIALIZED (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS email_id, CAST(c_nationkey AS VARCHAR) AS tenant_id,
    CAST(o_custkey AS VARCHAR) AS user_id, 'msg-' || o_orderkey AS provider_message_id,
    {pick(planted.PHRASES, 'o_orderkey // 7 % 12')} AS subject,
    {pick(planted.SENDERS, 'o_orderkey % 13')} AS sender_email,
    {pick(planted.NAMES, 'o_orderkey // 13 % 7')} AS sender_name,
    CASE WHEN o_orderkey % 19 = 0 THEN 'ghost' || o_orderkey ELSE 'user' || o_custkey END || '@company.com' AS recipient_email,
    o_orderdate AS received_at, o_orderdate AS ingested_at,
    CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1 HOUR END AS processed_at,
    ([{ATTACHMENT_LISTS}])[(o_orderkey // 5 % 17) + 1] AS attachment_names,
    coalesce(len(([{ATTACHMENT_LISTS}])[(o_orderkey // 5 % 17) + 1]), 0) > 0 AND o_orderkey % 23 <> 0 AS has_attachments,
    text AS body_preview, doc_id,
    {pick(planted.SPF, 'o_orderkey // 3 % 5')} AS spf,
    {pick(planted.AUTH, 'o_orderkey // 2 % 7')} AS auth,
    {pick(planted.REPLY, 'o_orderkey // 17 % 11')} AS reply_to
  FROM orders JOIN customer ON o_custkey = c_custkey, nd JOIN documents ON true
  WHERE doc_id = o_orderkey % nd.n)
"""
TENANTS = f"""tenants AS (SELECT CAST(n_nationkey AS VARCHAR) AS tenant_id, n_name AS name,
  CASE WHEN n_nationkey % 2 = 0 THEN {q(V.PROVIDERS[0])} ELSE {q(V.PROVIDERS[1])} END AS provider,
  'active' AS status FROM nation)"""
USERS = f"""users AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS tenant_id,
  'u-' || c_custkey AS provider_user_id, 'user' || c_custkey || '@company.com' AS email,
  {pick(planted.ROLES, 'c_custkey % 13')} AS role, TIMESTAMP '1995-01-01 00:00:00' AS created_at,
  c_custkey FROM customer)"""


def domain(column):
    return (f"CASE WHEN length({column}) - length(replace({column}, '@', '')) = 1 "
            f"THEN lower(split_part({column}, '@', 2)) ELSE '' END")


def percent(a, b):
    return (f"((1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / "
            f"greatest(strlen({a}), strlen({b}))::DOUBLE) * 100.0::DOUBLE)")


MESSAGES = f"""m AS MATERIALIZED (SELECT *, ext_dom NOT IN {among(V.INTERNAL_DOMAINS)} AS ext FROM (
  SELECT *, lower(subject || ' ' || body_preview) AS t, {domain('sender_email')} AS ext_dom FROM emails))"""


def union(*selects):
    return "\nUNION ALL\n".join(selects)


def threat_select(pos, type_, confidence, ev, source, where):
    return (f"SELECT email_id, tenant_id, received_at, {pos} AS pos, {type_} AS type, "
            f"{confidence} AS confidence, {ev} AS evidence FROM {source} WHERE {where}")


def conf(type_):
    return f"{V.CONFIDENCE[type_]}::DOUBLE"


_look = "CASE " + " ".join(
    f"WHEN ext_dom <> {q(t)} AND {percent('ext_dom', q(t))} > 85 AND {percent('ext_dom', q(t))} < 100 THEN {q(t)}"
    for t in V.TRUSTED_DOMAINS) + " END"
_file = f"""CASE WHEN {ends('lower(f)', V.HIGH_RISK_SUFFIXES)} THEN 'HIGH_RISK_ATTACHMENT|' || f
  WHEN length(f) - length(replace(f, '.', '')) > 1 THEN 'SUSPICIOUS_ATTACHMENT_NAME|' || f
  WHEN {ends('lower(f)', V.MACRO_SUFFIXES)} AND {has('t', V.ATTACHMENT_URGENCY_TERMS)}
  THEN 'MEDIUM_RISK_ATTACHMENT_WITH_URGENCY|' || f END"""

R1 = threat_select(1, "'DISPLAY_NAME_MISMATCH'", conf("DISPLAY_NAME_MISMATCH"),
                   evidence("DISPLAY_NAME_MISMATCH", "sender_name", "ext_dom"), "m",
                   f"ext AND {has('lower(sender_name)', V.EXEC_TITLES)}")
R2 = threat_select(2, "'DOMAIN_TYPOSQUATTING'", conf("DOMAIN_TYPOSQUATTING"),
                   evidence("DOMAIN_TYPOSQUATTING", "ext_dom", f"printf('%.1f', {percent('ext_dom', 'hit')})", "hit"),
                   f"(SELECT *, {_look} AS hit FROM m)", "hit IS NOT NULL")
R3 = threat_select(3, "'AUTH_FAILURES'", conf("AUTH_FAILURES"), evidence("AUTH_FAILURES", "fails"),
                   """(SELECT *, concat_ws(', ', CASE WHEN contains(lower(spf), 'fail') THEN 'SPF_FAIL' END,
                     CASE WHEN contains(lower(auth), 'dkim=fail') THEN 'DKIM_FAIL' END,
                     CASE WHEN contains(lower(auth), 'dmarc=fail') THEN 'DMARC_FAIL' END) AS fails FROM m)""",
                   "contains(fails, ',')")
R4 = threat_select(4, "'URGENCY_FINANCIAL_LANGUAGE'",
                   "least(0.70::DOUBLE + (s - 1.5::DOUBLE) * 0.1::DOUBLE, 0.95::DOUBLE)",
                   evidence("URGENCY_FINANCIAL_LANGUAGE", "printf('%.2f', s)", "u", "f", "a"),
                   f"""(SELECT *, u::DOUBLE * 0.3::DOUBLE + f::DOUBLE * 0.5::DOUBLE + a::DOUBLE * 0.2::DOUBLE AS s
                     FROM (SELECT *, {count('t', V.URGENCY_TERMS)} AS u, {count('t', V.FINANCIAL_TERMS)} AS f,
                           {count('t', V.AUTHORITY_TERMS)} AS a FROM m))""", "s > 1.5::DOUBLE")
R5 = threat_select(5, "'REPLY_TO_MISMATCH'", conf("REPLY_TO_MISMATCH"),
                   evidence("REPLY_TO_MISMATCH", "lower(sender_email)", "r"),
                   f"(SELECT *, lower(coalesce(reply_to, '')) AS r, {domain('lower(reply_to)')} AS rd FROM m)",
                   f"r <> '' AND r <> lower(sender_email) AND rd IN {among(V.FREEMAIL_DOMAINS)} AND rd <> ext_dom")
R6 = threat_select(6, "split_part(hit, '|', 1)",
                   "CASE split_part(hit, '|', 1) " + " ".join(
                       f"WHEN '{t}' THEN {conf(t)}" for t in ("HIGH_RISK_ATTACHMENT", "SUSPICIOUS_ATTACHMENT_NAME",
                                                             "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY")) + " END",
                   "CASE split_part(hit, '|', 1) " + " ".join(
                       f"WHEN '{t}' THEN {evidence(t, "split_part(hit, '|', 2)")}" for t in (
                           "HIGH_RISK_ATTACHMENT", "SUSPICIOUS_ATTACHMENT_NAME",
                           "MEDIUM_RISK_ATTACHMENT_WITH_URGENCY")) + " END",
                   f"""(SELECT *, list_filter(list_transform(attachment_names, lambda f: {_file}),
                     lambda x: x IS NOT NULL)[1] AS hit FROM m WHERE has_attachments)""", "hit IS NOT NULL")
_bec = """CASE WHEN c AND urg AND pay THEN 'BEC_CSUITE_TARGETING' WHEN f AND pay THEN 'BEC_FINANCE_TARGETING'
  WHEN h AND roll THEN 'BEC_HR_PAYROLL_SCAM' WHEN (c OR f OR h) AND urg THEN 'BEC_HIGH_VALUE_TARGET' END"""
_bec_types = ("BEC_CSUITE_TARGETING", "BEC_FINANCE_TARGETING", "BEC_HR_PAYROLL_SCAM", "BEC_HIGH_VALUE_TARGET")
R7 = threat_select(7, "hit", "CASE hit " + " ".join(f"WHEN '{t}' THEN {conf(t)}" for t in _bec_types) + " END",
                   "CASE hit " + " ".join(f"WHEN '{t}' THEN {evidence(t, 'role')}" for t in _bec_types) + " END",
                   f"""(SELECT *, {_bec} AS hit FROM (
                     SELECT m.*, role, {has('lower(role)', V.CSUITE_ROLES)} AS c, {has('lower(role)', V.FINANCE_ROLES)} AS f,
                       {has('lower(role)', V.HR_ROLES)} AS h, {has('t', V.ROLE_URGENCY_TERMS)} AS urg,
                       {has('t', V.ROLE_PAYMENT_TERMS)} AS pay, {has('t', V.ROLE_PAYROLL_TERMS)} AS roll
                     FROM m JOIN users ON users.tenant_id = m.tenant_id AND users.email = m.recipient_email
                     WHERE role <> '' AND ext))""", "hit IS NOT NULL")
RULES = dict(zip(("display_name", "typosquatting", "auth_failures", "urgency_financial", "reply_to",
                  "attachments", "role_targeting"), (R1, R2, R3, R4, R5, R6, R7), strict=True))


def weight_case(weights):
    return "CASE type " + " ".join(f"WHEN '{t}' THEN {w}::DOUBLE" for t, w in weights.items()) + " ELSE 1.0::DOUBLE END"


def level(score):
    return (f"CASE WHEN {score} >= 0.85 THEN 'critical' WHEN {score} >= 0.70 THEN 'high' "
            f"WHEN {score} >= 0.50 THEN 'medium' WHEN {score} >= 0.30 THEN 'low' ELSE 'none' END")


def scored(name="analyses", weights=V.WEIGHTS):
    return f"""{name} AS MATERIALIZED (SELECT *, {level('v')} AS risk_level,
      CAST(CAST(v AS DECIMAL(5,4)) AS DOUBLE) AS risk_score, received_at AS analyzed_at FROM (
        SELECT e.email_id, e.tenant_id, e.user_id, e.received_at, e.doc_id,
          least(coalesce(max(confidence * {weight_case(weights)}), 0.0::DOUBLE), 1.0::DOUBLE) AS v,
          count(type) AS threats, coalesce(string_agg(type, ',' ORDER BY pos), '') AS types
        FROM emails e LEFT JOIN threats t ON t.email_id = e.email_id
        GROUP BY e.email_id, e.tenant_id, e.user_id, e.received_at, e.doc_id))"""


THREATS = f"threats AS MATERIALIZED ({union(*RULES.values())})"
MAIL = f"WITH {EMAILS}"
DETECTED = f"WITH {EMAILS}, {USERS}, {MESSAGES}, {THREATS}"
ANALYSED = f"{DETECTED}, {scored()}"

_name = r"""(?:"(?:[^"\\]|\\.)*"|[A-Za-z0-9!#$%&'*+/=?^_`{|}~.\-\x{80}-\x{10FFFF}]+)"""
_atom = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~\-\x{80}-\x{10FFFF}]+"
_addr = rf"{_atom}(?:\.{_atom})*@{_atom}(?:\.{_atom})*"
_named = q(rf"^[ \t]*(?:{_name}(?:[ \t]+{_name})*)?[ \t]*<[ \t]*({_addr})[ \t]*>[ \t]*$")
_bare = q(rf"^[ \t]*({_addr})[ \t]*$")


def sha_id(kind, *columns):
    body = "".join(f" || '\",\"k{i}\":\"' || {c}" if i else f"'{{\"kind\":\"{kind}\",\"k0\":\"' || {c}"
                   for i, c in enumerate(columns))
    return f"sha256({body} || '\"}}')"


HEADER = """CASE k % 3 WHEN 0 THEN sender_email WHEN 1 THEN sender_name || ' <' || sender_email || '>'
  ELSE '"' || sender_name || '" <' || sender_email || '>' END"""
SENT = f"""sent AS (SELECT e.*, provider, {HEADER} AS fh FROM emails e JOIN tenants t ON t.tenant_id = e.tenant_id),
stamped AS (SELECT *, CASE WHEN provider = 'microsoft' THEN sender_email
    WHEN regexp_extract(fh, {_named}, 1) <> '' THEN regexp_extract(fh, {_named}, 1)
    WHEN regexp_extract(fh, {_bare}, 1) <> '' THEN regexp_extract(fh, {_bare}, 1) ELSE fh END AS landed_sender,
  {sha_id('email', 'tenant_id', 'provider_message_id')} AS landed_id,
  {sha_id('user', 'tenant_id', "'u-' || user_id")} AS landed_user FROM sent)"""

_dirty = f"""dirty AS (SELECT k, email_id, CASE WHEN k % 17 = 0 THEN 'nowhere' ELSE tenant_id END AS tenant_id, user_id,
    CASE WHEN k % 11 <> 0 THEN sender_email END AS sender_email,
    CASE WHEN k % 13 = 0 THEN rpad(sender_name, 101, 'x') ELSE sender_name END AS sender_name FROM emails),
rejects AS (SELECT * FROM (
    SELECT 'emails' AS "table", tenant_id, email_id AS row_key, concat_ws('; ',
      CASE WHEN sender_email IS NULL THEN 'sender_email is missing' END,
      CASE WHEN length(sender_name) > 100 THEN 'sender_name is longer than 100' END,
      CASE WHEN tenant_id = 'nowhere' THEN 'tenant_id is unknown' END) AS reason FROM dirty
    UNION ALL SELECT 'tenants', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR),
      CASE WHEN n_nationkey % 7 = 0 THEN 'unknown provider' ELSE '' END FROM nation)
  WHERE reason <> '')"""
_deliveries = """deliveries AS (SELECT *, 0 AS again FROM emails UNION ALL
  SELECT * REPLACE (upper(subject) AS subject, ingested_at + INTERVAL 1 DAY AS ingested_at), 1 FROM emails WHERE k % 10 = 0)"""
_hosts = """hosts AS (SELECT domain, min(page_id) AS pos FROM (
  SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS domain FROM pages) WHERE domain <> '' GROUP BY domain)"""


def ranked(source, order, extra=""):
    return f"""SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY {order}) AS rank FROM {source} {extra}"""


_risk_order = "risk_score DESC, analyzed_at DESC, email_id"
ts = lambda c: f"CAST({c} AS VARCHAR) AS {c}"
_terms = sorted({*V.URGENCY_TERMS, *V.FINANCIAL_TERMS, *V.AUTHORITY_TERMS, *V.ROLE_URGENCY_TERMS,
                 *V.ROLE_PAYMENT_TERMS, *V.ROLE_PAYROLL_TERMS})
_tri = lambda c: (f"list_distinct(list_transform(range(1, greatest(length({c}) - 2, 1) + 1), "   # noqa: E731
                  f"lambda i: substring({c}, i, 3)))")
_reviews = "reviews AS (SELECT email_id, toxic = 1 AS confirmed FROM emails JOIN labels USING (doc_id))"

ORACLE = {
    **{name: f"WITH {EMAILS}, {USERS}, {MESSAGES} SELECT email_id, type, round(confidence, 6) AS confidence, evidence "
             f"FROM ({RULES[rule]})" for name, rule in RULE_QUERIES.items()},
    "risk_score": f"{ANALYSED} SELECT email_id, tenant_id, risk_score, risk_level, threats, types FROM analyses",
    "risk_score_long": f"{ANALYSED} SELECT email_id, round(v, 6) AS risk_value, risk_level FROM analyses",
    "threats_by_type": f"""{DETECTED} SELECT type, CAST(date_trunc('week', received_at)::TIMESTAMP AS VARCHAR) AS period,
        count(*) AS detections, round(avg(confidence), 6) AS mean_confidence FROM threats GROUP BY 1, 2""",
    "tenant_rule_settings": f"""{DETECTED}, kept AS (SELECT t.*, CASE WHEN type = 'AUTH_FAILURES' AND n_regionkey > 0
          THEN n_regionkey * 0.25::DOUBLE ELSE {weight_case(V.WEIGHTS)} END AS w
        FROM threats t JOIN nation ON tenant_id = CAST(n_nationkey AS VARCHAR)
        WHERE NOT (type = 'DISPLAY_NAME_MISMATCH' AND n_regionkey % 2 = 1)),
      s AS (SELECT e.email_id, least(coalesce(max(confidence * w), 0::DOUBLE), 1::DOUBLE) AS v, count(type) AS threats
        FROM emails e LEFT JOIN kept ON kept.email_id = e.email_id GROUP BY e.email_id)
      SELECT email_id, round(v, 6) AS risk_value, {level('v')} AS risk_level, threats FROM s""",
    "term_presence": f"""WITH {EMAILS}, {MESSAGES}, found AS (SELECT unnest(list_filter([{', '.join(map(q, _terms))}],
        lambda w: contains(t, w))) AS term FROM m) SELECT term, count(*) AS messages FROM found GROUP BY term""",
    "role_groups": f"""WITH {USERS} SELECT role, count(*) AS users,
        max({has('lower(role)', V.CSUITE_ROLES)}::BIGINT) AS csuite, max({has('lower(role)', V.FINANCE_ROLES)}::BIGINT) AS finance,
        max({has('lower(role)', V.HR_ROLES)}::BIGINT) AS hr FROM users GROUP BY role""",
    "auth_header_search": f"""{MAIL} SELECT email_id, tenant_id, auth AS value FROM emails
        WHERE contains(lower(auth), 'dmarc=fail')""",
    "header_values": f"""{MAIL} SELECT header, value, count(*) AS messages FROM (
        {union(*[f"SELECT '{h}' AS header, {c} AS value FROM emails WHERE {c} IS NOT NULL"
                 for h, c in ((V.SPF_HEADER, 'spf'), (V.AUTH_HEADER, 'auth'), (V.REPLY_TO_HEADER, 'reply_to'))])})
        GROUP BY header, value""",
    "recipients_table": f"{MAIL} SELECT email_id, tenant_id, recipient_email AS address, 'to' AS type FROM emails",
    "attachments_table": f"""{MAIL}, f AS (SELECT email_id, unnest(range(len(attachment_names))) AS pos,
        unnest(attachment_names) AS filename FROM emails)
        SELECT email_id, pos, filename, '.' || split_part(filename, '.', -1) AS extension FROM f""",
    "repeated_attachments": f"""{MAIL}, f AS (SELECT email_id, tenant_id, unnest(attachment_names) AS filename FROM emails)
        SELECT filename, count(*) AS copies, count(DISTINCT tenant_id) AS tenants, min(email_id) AS first_email_id
        FROM f GROUP BY filename""",
    "constraint_rejects": f"{MAIL}, {_dirty} SELECT \"table\", tenant_id, row_key, reason FROM rejects",
    "orphan_messages": f"{MAIL}, {_dirty} SELECT email_id, tenant_id, user_id FROM dirty WHERE tenant_id = 'nowhere'",
    "dead_letters": f"""{MAIL}, {_dirty} SELECT "table", tenant_id, row_key, CASE "table" WHEN 'emails' THEN 3 ELSE 1 END::BIGINT AS attempts,
        reason, "table" = 'emails' AS dead FROM rejects""",
    "provider_union": f"""{MAIL}, {TENANTS}, {SENT} SELECT landed_id AS email_id, tenant_id, landed_user AS user_id,
        provider_message_id, landed_sender AS sender_email FROM stamped""",
    "dedup_first_wins": f"""{MAIL}, {_deliveries} SELECT email_id, tenant_id, provider_message_id, subject, {ts('ingested_at')}
        FROM deliveries QUALIFY row_number() OVER (PARTITION BY tenant_id, provider_message_id ORDER BY ingested_at) = 1""",
    "insert_absent_only": f"{MAIL} SELECT email_id, subject FROM emails WHERE processed_at IS NULL",
    "ingest_counts": f"""{MAIL}, {_deliveries} SELECT tenant_id, count(*) AS delivered,
        count(DISTINCT provider_message_id) AS stored FROM deliveries GROUP BY tenant_id""",
    "user_upsert": f"""WITH {USERS} SELECT user_id, tenant_id, provider_user_id, email,
        CASE WHEN c_custkey % 10 = 0 THEN {pick(planted.ROLES, '(c_custkey + 1) % 13')} ELSE role END AS role,
        {ts('created_at')} FROM users""",
    "tenant_seed": f"""WITH {TENANTS} SELECT tenant_id, provider, CASE WHEN n_regionkey = 1 THEN 'refused' ELSE 'inserted' END AS outcome
        FROM tenants JOIN nation ON tenant_id = CAST(n_nationkey AS VARCHAR)""",
    "recipient_lookup": f"""WITH {EMAILS}, {USERS} SELECT email_id, u.user_id AS recipient_user_id, u.role AS recipient_role
        FROM emails e LEFT JOIN users u ON u.tenant_id = e.tenant_id AND u.email = e.recipient_email""",
    "unprocessed_batch": f"""{MAIL} SELECT email_id, tenant_id, {ts('received_at')} FROM emails e WHERE processed_at IS NULL
        ORDER BY e.received_at, email_id LIMIT {V.DETECTION_BATCH}""",
    "unprocessed_messages": f"{MAIL} SELECT email_id, tenant_id FROM emails WHERE processed_at IS NULL AND NOT has_attachments",
    "detect_queue": f"""{ANALYSED}, w AS (SELECT email_id FROM emails WHERE processed_at IS NULL
        ORDER BY received_at, email_id LIMIT {V.DETECTION_BATCH})
        SELECT email_id, risk_score, risk_level FROM analyses SEMI JOIN w USING (email_id)""",
    "mark_processed": f"""{MAIL} SELECT email_id, CAST(coalesce(processed_at,
        CASE WHEN has_attachments THEN received_at + INTERVAL 2 HOUR END) AS VARCHAR) AS processed_at FROM emails""",
    "high_risk_topk": f"""{ANALYSED} SELECT tenant_id, email_id, risk_score, risk_level, {ts('analyzed_at')}, threats
        FROM analyses a WHERE tenant_id = '7' AND risk_level IN ('high', 'critical')
        ORDER BY risk_score DESC, a.analyzed_at DESC, email_id LIMIT {V.REPORT_ROWS}""",
    "high_risk_all_tenants": f"""{ANALYSED} SELECT tenant_id, rank, email_id, risk_score, risk_level, {ts('analyzed_at')}
        FROM ({ranked('analyses', _risk_order, "WHERE risk_level IN ('high', 'critical')")}) WHERE rank <= {V.REPORT_ROWS}""",
    "latest_per_tenant": f"""{MAIL} SELECT tenant_id, rank, email_id, {ts('received_at')}
        FROM ({ranked('emails', 'received_at DESC, email_id')}) WHERE rank <= {V.REPORT_ROWS}""",
    "sender_investigation": f"""{MAIL} SELECT tenant_id, sender_email, count(*) AS messages,
        CAST(min(received_at) AS VARCHAR) AS first_seen, CAST(max(received_at) AS VARCHAR) AS last_seen,
        count(*) FILTER (has_attachments) AS with_attachments FROM emails GROUP BY tenant_id, sender_email""",
    "messages_of_sender": f"""{MAIL} SELECT email_id, subject, {ts('received_at')} FROM emails
        WHERE tenant_id = '3' AND sender_email = 'desk@paypol.com'""",
    "mailbox_timeline": f"{MAIL} SELECT user_id, {ts('received_at')}, email_id FROM emails",
    "risk_dashboard": f"""{ANALYSED} SELECT tenant_id, {', '.join(f"count(*) FILTER (risk_level = '{lv}') AS {lv}"
        for lv in ('critical', 'high', 'medium', 'low', 'none'))}, count(*) AS messages FROM analyses GROUP BY tenant_id""",
    "newest_of_level": f"{ANALYSED} SELECT email_id, tenant_id, {ts('analyzed_at')} FROM analyses WHERE risk_level = 'high'",
    "tenant_summary": f"""{ANALYSED} SELECT tenant_id, count(*) AS messages,
        count(*) FILTER (risk_level IN ('high', 'critical')) AS high_risk, sum(threats)::BIGINT AS threats,
        round(max(v), 6) AS highest FROM analyses GROUP BY tenant_id""",
    "alerts": f"""{ANALYSED} SELECT t.email_id, row_number() OVER (PARTITION BY t.email_id ORDER BY t.pos) - 1 AS pos, type, evidence,
        risk_score, threats, subject, sender_name, sender_email, recipient_email
        FROM threats t JOIN analyses a ON a.email_id = t.email_id JOIN emails e ON e.email_id = t.email_id
        WHERE risk_level IN ('high', 'critical')""",
    "address_validation": f"""{MAIL}, x AS (SELECT unnest(regexp_extract_all(text, '[^ \\t\\r\\n<>]+@[^ \\t\\r\\n<>]+')) AS address
        FROM documents UNION ALL SELECT sender_email FROM emails), v AS (SELECT address,
        regexp_matches(address, {q(V.ADDRESS_PATTERN + '$')}) AS good FROM x)
        SELECT address, count(*) FILTER (good) AS valid, count(*) FILTER (NOT good) AS invalid FROM v GROUP BY address""",
    "tenant_purge": f"""WITH {EMAILS}, {TENANTS}, {USERS}, gone AS (SELECT CAST(n_nationkey AS VARCHAR) AS tenant_id FROM nation
          WHERE n_regionkey = 0), closed AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_acctbal < 0),
        left_mail AS (SELECT * FROM emails WHERE tenant_id NOT IN (FROM gone) AND user_id NOT IN (FROM closed))
        SELECT "table", tenant_id, count(*) AS rows FROM (
          SELECT 'tenants' AS "table", tenant_id FROM tenants WHERE tenant_id NOT IN (FROM gone)
          UNION ALL SELECT 'users', tenant_id FROM users WHERE tenant_id NOT IN (FROM gone) AND user_id NOT IN (FROM closed)
          UNION ALL SELECT 'emails', tenant_id FROM left_mail UNION ALL SELECT 'analyses', tenant_id FROM left_mail)
        GROUP BY "table", tenant_id""",
    "tenant_lookup": f"WITH {TENANTS} SELECT tenant_id, name, provider, status FROM tenants WHERE tenant_id = '4'",
    "email_lookup": f"""{MAIL} SELECT email_id, subject, sender_email, recipient_email, body_preview FROM emails
        WHERE email_id = '1234'""",
    "json_columns": f"""{MAIL} SELECT email_id, coalesce('[' || array_to_string(list_transform(attachment_names,
        lambda f: '"' || f || '"'), ',') || ']', 'null') AS names_json, coalesce(len(attachment_names), 0)::BIGINT AS names, spf
        FROM emails""",
    "incremental_sync": f"""{MAIL} SELECT email_id, user_id, {ts('received_at')} FROM emails e
        WHERE e.received_at > (SELECT max(o_orderdate) FROM orders) - INTERVAL {V.LOOK_BACK_DAYS} DAY""",
    "sync_per_user": f"""{MAIL}, n AS (SELECT user_id, max(received_at) AS newest FROM emails WHERE processed_at IS NOT NULL GROUP BY user_id)
        SELECT e.email_id, e.user_id, CAST(e.received_at AS VARCHAR) AS received_at FROM emails e LEFT JOIN n ON n.user_id = e.user_id
        WHERE e.received_at > coalesce(newest, TIMESTAMP '1997-01-01 00:00:00')""",
    "lookalike_hosts": f"""WITH {_hosts}, p AS (SELECT a.domain, b.pos, b.domain AS trusted, {percent('a.domain', 'b.domain')} AS s
        FROM hosts a JOIN hosts b ON a.domain <> b.domain)
        SELECT domain, pos, trusted, round(s, 6) AS similarity FROM p WHERE s > 85 AND s < 100""",
    "typosquatting_long_list": f"""WITH {EMAILS}, {MESSAGES}, {_hosts}, listed AS (SELECT domain, pos FROM hosts UNION ALL
          SELECT * FROM (VALUES {', '.join(f"({q(t)}, {i - 3})" for i, t in enumerate(V.TRUSTED_DOMAINS))})),
        best AS (SELECT d, arg_min(domain, pos) AS hit FROM (SELECT DISTINCT ext_dom AS d FROM m) JOIN listed ON d <> domain
          WHERE {percent('d', 'domain')} > 85 AND {percent('d', 'domain')} < 100 GROUP BY d)
        SELECT email_id, {evidence("DOMAIN_TYPOSQUATTING", "d", f"printf('%.1f', {percent('d', 'hit')})", "hit")} AS evidence
        FROM m JOIN best ON ext_dom = d""",
    "edit_distance": f"""WITH {EMAILS}, {_hosts}, d AS (SELECT {domain('sender_email')} AS domain FROM emails UNION SELECT domain FROM hosts)
        SELECT domain, trusted, levenshtein(domain, trusted)::BIGINT AS distance, round({percent('domain', 'trusted')}, 6) AS similarity
        FROM d, (SELECT unnest([{', '.join(map(q, V.TRUSTED_DOMAINS))}]) AS trusted)""",
    "trigram_lookalikes": f"""WITH {EMAILS}, d AS (SELECT {domain('sender_email')} AS domain, count(*) AS messages FROM emails GROUP BY 1),
        p AS (SELECT domain, trusted, messages, {_tri('hexed')} AS a, {_tri('trusted')} AS b FROM
          (SELECT *, replace(domain, 'о', 'ÐÑ') AS hexed FROM d WHERE domain <> ''),
          (SELECT unnest([{', '.join(map(q, V.TRUSTED_DOMAINS))}]) AS trusted) WHERE domain <> trusted),
        s AS (SELECT *, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS x FROM p)
        SELECT domain, trusted, messages, round(x, 6) AS shared FROM s WHERE x >= 0.3""",
    "monthly_retention": f"""{MAIL} SELECT strftime(received_at, '%Y-%m') AS received_month, count(*) AS messages FROM emails
        WHERE strftime(received_at, '%Y-%m') >= strftime(TIMESTAMP '{AS_OF}' - INTERVAL 24 MONTH, '%Y-%m') GROUP BY 1""",
    "review_precision": f"""{DETECTED}, {_reviews} SELECT type, count(*) AS reviewed, count(*) FILTER (confirmed) AS confirmed,
        round(count(*) FILTER (confirmed)::DOUBLE / count(*), 6) AS precision FROM threats JOIN reviews USING (email_id) GROUP BY type""",
    "review_thresholds": f"""{ANALYSED}, {_reviews}, j AS (SELECT v, confirmed FROM analyses JOIN reviews USING (email_id))
        SELECT level, bound, count(*) FILTER (v >= bound) AS flagged, count(*) FILTER (v >= bound AND confirmed) AS confirmed,
        count(*) FILTER (v < bound AND confirmed) AS missed
        FROM j, (VALUES {', '.join(f"('{n}', {b}::DOUBLE)" for n, b in V.RISK_LEVELS)}) l(level, bound) GROUP BY level, bound""",
    "rule_versions": f"""{DETECTED}, {scored('a')}, {scored('b', WEIGHTS_B)} SELECT a.email_id, a.risk_level AS level_a,
        round(a.v, 6) AS score_a, b.risk_level AS level_b, round(b.v, 6) AS score_b FROM a JOIN b ON a.email_id = b.email_id
        WHERE a.risk_level <> b.risk_level OR a.v <> b.v""",
    "ingest_run": f"""{MAIL}, {TENANTS}, {SENT} SELECT landed_id AS email_id, tenant_id, landed_user AS user_id, provider_message_id,
        subject, landed_sender AS sender_email, '0001' AS run, strftime(received_at, '%Y-%m') AS received_month FROM stamped""",
    "stream_dedup_detect": f"{ANALYSED} SELECT email_id, tenant_id, risk_score, risk_level FROM analyses",
    "stream_alerts": f"""{ANALYSED} SELECT t.email_id, t.tenant_id, round(v, 6) AS risk_value, risk_level, type,
        round(confidence, 6) AS confidence FROM threats t JOIN analyses a ON a.email_id = t.email_id
        WHERE risk_level IN ('high', 'critical')""",
    "stream_risk_counts": f"""{ANALYSED} SELECT strftime(date_trunc('hour', received_at)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS window_start,
        tenant_id, risk_level, count(*) AS messages FROM analyses GROUP BY 1, 2, 3""",
    "stream_event_dedup": """SELECT event_type, count(DISTINCT event_id) AS events, count(DISTINCT event_id) AS ids
        FROM events GROUP BY event_type""",
}

# The full run works on the sender as landed, so the rules are written over that form.
_landed_mail = EMAILS + f""", {TENANTS}, {SENT},
landed AS (SELECT * REPLACE (landed_sender AS sender_email) FROM stamped)"""
ORACLE["full_run"] = f"""WITH {_landed_mail}, {USERS}, {MESSAGES.replace('FROM emails', 'FROM landed')}, {THREATS}, {scored()},
    named AS (SELECT a.*, {sha_id('email', 'tenant_id', "'msg-' || email_id")} AS landed_id FROM analyses a)
    SELECT tenant_id, rank, landed_id AS email_id, risk_score, risk_level, threats FROM (
      {ranked('named', 'risk_score DESC, analyzed_at DESC, landed_id', "WHERE risk_level IN ('high', 'critical')")})
    WHERE rank <= {V.REPORT_ROWS}"""

ORACLE["repeat_run"] = f"""WITH {_landed_mail}, {USERS}, {MESSAGES.replace('FROM emails', 'FROM landed')}, {THREATS}, {scored()}
    SELECT {sha_id('email', 'tenant_id', "'msg-' || email_id")} AS email_id, tenant_id, risk_score, risk_level FROM analyses"""
ORACLE["stored_versions"] = f"""WITH {_landed_mail}, {USERS}, {MESSAGES.replace('FROM emails', 'FROM landed')}, {THREATS},
    {scored('a')}, {scored('b', WEIGHTS_B)}
    SELECT '1' AS rule_version, risk_level, count(*) AS messages FROM a WHERE CAST(email_id AS BIGINT) % 2 = 0 GROUP BY risk_level
    UNION ALL SELECT '2', risk_level, count(*) FROM b WHERE CAST(email_id AS BIGINT) % 2 = 1 GROUP BY risk_level"""
ORACLE["stored_purge"] = ORACLE["tenant_purge"]
ORACLE["stream_two_checkpoints"] = ORACLE["stream_dedup_detect"]
ORACLE["tenant_domains"] = f"""WITH {EMAILS}, {MESSAGES}, own AS (SELECT m.* REPLACE (CASE WHEN n_regionkey % 2 = 0
    THEN ext_dom NOT IN {among(OWN_DOMAINS)} ELSE ext END AS ext) FROM m JOIN nation ON tenant_id = CAST(n_nationkey AS VARCHAR))
    SELECT email_id, tenant_id, evidence FROM ({threat_select(1, "'DISPLAY_NAME_MISMATCH'", conf("DISPLAY_NAME_MISMATCH"),
        evidence("DISPLAY_NAME_MISMATCH", "sender_name", "ext_dom"), "own", f"ext AND {has('lower(sender_name)', V.EXEC_TITLES)}")})"""
ORACLE["stream_typosquatting_long_list"] = f"""WITH {EMAILS}, {MESSAGES},
    listed(domain, pos) AS (VALUES {', '.join(f"({q(t)}, {i})" for i, t in enumerate(LONG_LIST))}),
    best AS (SELECT d, arg_min(domain, pos) AS hit FROM (SELECT DISTINCT ext_dom AS d FROM m) JOIN listed ON d <> domain
      WHERE {percent('d', 'domain')} > 85 AND {percent('d', 'domain')} < 100 GROUP BY d)
    SELECT email_id, {evidence("DOMAIN_TYPOSQUATTING", "d", f"printf('%.1f', {percent('d', 'hit')})", "hit")} AS evidence
    FROM m JOIN best ON ext_dom = d"""

ORACLE["replayed_rejects"] = f"""{MAIL}, {TENANTS}, {SENT} SELECT landed_id AS email_id, tenant_id, landed_user AS user_id,
    CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN '0001' ELSE '0003' END AS run FROM stamped"""
ORACLE["synced_twice"] = f"""{MAIL}, {TENANTS}, {SENT},
    marks AS (SELECT landed_user, max(received_at) AS mark FROM stamped WHERE k % 2 = 0 GROUP BY landed_user)
    SELECT landed_id AS email_id, s.landed_user AS user_id, CASE WHEN k % 2 = 0 THEN '0001' ELSE '0002' END AS run
    FROM stamped s LEFT JOIN marks m ON s.landed_user = m.landed_user
    WHERE k % 2 = 0 OR mark IS NULL OR received_at > mark - INTERVAL 30 DAY"""
ORACLE["review_curve"] = f"""{ANALYSED}, {_reviews}, j AS (SELECT round(v, 6) AS v, confirmed FROM analyses JOIN reviews USING (email_id)),
    g AS (SELECT v, count(*) AS n, count(*) FILTER (confirmed) AS hits FROM j GROUP BY v),
    c AS (SELECT v, CAST(sum(n) OVER w AS BIGINT) AS flagged, CAST(sum(hits) OVER w AS BIGINT) AS confirmed,
      CAST(sum(hits) OVER () AS BIGINT) AS hits FROM g WINDOW w AS (ORDER BY v DESC ROWS UNBOUNDED PRECEDING))
    SELECT v AS bound, flagged, confirmed, hits - confirmed AS missed, round(confirmed::DOUBLE / flagged, 6) AS precision,
      CASE WHEN hits > 0 THEN round(confirmed::DOUBLE / hits, 6) END AS recall FROM c"""
ORACLE["weight_experiment"] = f"""{DETECTED}, {scored('a')}, {scored('b', WEIGHTS_B)},
    arms AS (SELECT email_id, ('0x' || substr(md5(email_id), 1, 8))::BIGINT % 1000 < 300 AS b FROM emails),
    r AS (SELECT arms.b, CASE WHEN arms.b THEN b.risk_level ELSE a.risk_level END IN ('high', 'critical') AS hit
      FROM arms JOIN a ON a.email_id = arms.email_id JOIN b ON b.email_id = arms.email_id),
    n AS (SELECT count(*) FILTER (NOT b) AS n_a, count(*) FILTER (NOT b AND hit) AS hits_a, count(*) FILTER (b) AS n_b,
      count(*) FILTER (b AND hit) AS hits_b FROM r)
    SELECT n_a, hits_a, n_b, hits_b, round(hits_a::DOUBLE / n_a, 6) AS share_a, round(hits_b::DOUBLE / n_b, 6) AS share_b,
      round((hits_b::DOUBLE / n_b - hits_a::DOUBLE / n_a) / sqrt((hits_a + hits_b)::DOUBLE / (n_a + n_b)
        * (1 - (hits_a + hits_b)::DOUBLE / (n_a + n_b)) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)), 6) AS z FROM n"""
ORACLE["tenant_lexicons"] = f"""WITH {EMAILS}, t AS (SELECT email_id, tenant_id, n_regionkey % 2 = 0 AS money,
      lower(coalesce(subject, '') || ' ' || coalesce(body_preview, '')) AS txt
    FROM emails JOIN nation ON tenant_id = CAST(n_nationkey AS VARCHAR)),
    l(list, term) AS (VALUES {', '.join(f"({q(k)}, {q(t.lower())})" for k, ts in TENANT_TERMS.items() for t in ts)})
    SELECT email_id, tenant_id, list, count(*) AS n FROM t JOIN l ON (list = 'money') = money AND contains(txt, term)
    GROUP BY email_id, tenant_id, list"""
ORACLE["alert_digests"] = f"""{ANALYSED}, r AS (SELECT e.tenant_id, sender_email, e.received_at, v FROM emails e
      JOIN analyses a ON a.email_id = e.email_id WHERE risk_level IN ('high', 'critical')),
    g AS (SELECT *, CASE WHEN received_at <= lag(received_at) OVER (PARTITION BY tenant_id, sender_email ORDER BY received_at)
      + INTERVAL 3 DAY THEN 0 ELSE 1 END AS fresh FROM r),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY tenant_id, sender_email ORDER BY received_at
      RANGE UNBOUNDED PRECEDING) AS burst FROM g)
    SELECT tenant_id, sender_email, count(*) AS messages, round(max(v), 6) AS risk_value,
      strftime(min(received_at), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(received_at), '%Y-%m-%d %H:%M:%S') AS last_at
    FROM i GROUP BY tenant_id, sender_email, burst"""
ORACLE["stream_distinct"] = f"""{MAIL} SELECT count(*) AS kept, count(DISTINCT email_id) AS ids,
    3 * count(*) AS arrived, 2 * count(*) AS repeated FROM emails"""
