"""DuckDB twins of the registered queries, over the same given tables.

Written from the fixture rules, not from the operators: where Spark parses a payload or follows an
anchor, the twin states the rule by event id.
"""

from __future__ import annotations

import json

from factlake import schemas as S

P = S.TRUTH_POLICY
EV_AUTH, DEC_AUTH = S.AuthorityIdentities().evidence, S.AuthorityIdentities().decision
DAY = S.NS_PER_DAY
HOUR = 3_600 * 1_000_000_000


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _case(col: str, pairs) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs) + " END"


def js(col: str) -> str:
    """JSON text of a nullable VARCHAR without special characters."""
    return f"coalesce('\"' || {col} || '\"', 'null')"


def jn(col: str) -> str:
    return f"coalesce(({col})::VARCHAR, 'null')"


def set_digest(text: str, cond: str | None = None) -> str:
    """Sixteen sums of the 16-bit words of sha256, joined with dots."""
    filt = f" FILTER (WHERE {cond})" if cond else ""
    words = [
        f"coalesce(sum(('0x' || substr(sha256({text}), {1 + 4 * i}, 4))::BIGINT){filt}, 0)::VARCHAR"
        for i in range(16)
    ]
    return " || '.' || ".join(words)


EV = f"""
ev AS (
  SELECT event_id AS i, user_id, event_type, epoch_us(ts) AS us, {_list(S.ASSETS)}[user_id % 9 + 1] AS asset
  FROM events),
lim AS (SELECT min(us) AS lo, max(us) AS hi, (min(us) + (max(us) - min(us)) // 2) * 1000 AS cutoff FROM ev)
"""

FACTS = (
    EV
    + f""",
f0 AS (
  SELECT *, 'c' || lpad(i::VARCHAR, 10, '0') AS capture_id,
    CASE event_type WHEN 'purchase' THEN 'trade' WHEN 'error' THEN 'market_lifecycle_v2'
                    WHEN 'view' THEN 'ticker' ELSE 'orderbook_delta' END AS kind,
    'KX' || asset || '15M-24JAN' AS source_id, i % 7 + 1 AS sid, 1704067200 + i % 97 AS sec
  FROM ev),
f1 AS (SELECT *, CASE WHEN kind = 'trade' AND i % 41 = 0 THEN i % 5 ELSE -1 END AS defect FROM f0),
f2 AS (
  SELECT *, CASE WHEN defect = 3 THEN '' ELSE 't' || (i % 97) END AS tid,
    CASE WHEN defect = 4 THEN 'OTHER' ELSE source_id END AS mkt, '0.4' || (i % 3) || '00' AS price FROM f1),
f AS (
  SELECT i, us, user_id, defect, capture_id, asset, CASE WHEN defect = 1 THEN 'other' ELSE '{S.PROVIDER}' END AS provider,
    source_id, kind AS channel, kind AS message_type,
    CASE WHEN kind = 'market_lifecycle_v2' THEN 'created' END AS event_subtype, sid,
    CASE WHEN i % 3 = 0 THEN i END AS seq,
    CASE WHEN event_type <> 'error' THEN (us - (i % 5) * 1000) * 1000 END AS provider_ns,
    us * 1000 AS received_ns,
    CASE WHEN defect = 0 THEN 'market-ingress/v2' ELSE '{S.MESSAGE_SCHEMA}' END AS schema_version,
    CASE WHEN kind <> 'trade' THEN '{{"type":"' || kind || '","sid":' || sid || ',"msg":{{"market_ticker":"' || mkt || '"}}}}'
         WHEN defect = 2 THEN 'not json'
         WHEN i % 4 = 1 THEN '{{ "msg": {{"ts_ms": ' || sec || '000, "ts": ' || sec || ', "is_block_trade": false, "taker_side": "yes", "count": "9.00", "no_price": "0.6150", "yes_price": "' || price || '", "market_ticker": "' || mkt || '", "trade_id": "' || tid || '"}}, "sid": ' || sid || ', "type": "trade"}}'
         ELSE '{{"type":"trade","sid":' || sid || ',"seq":null,"msg":{{"trade_id":"' || tid || '","market_ticker":"' || mkt || '","yes_price":"' || price || '","no_price":"0.6150","count":"9.00","taker_side":"yes","ts":' || sec || ',"is_block_trade":false,"ts_ms":' || sec || '000}}}}'
    END AS payload,
    CASE WHEN i % 50 <> 7 THEN us * 1000 + (i % 11) * 60000000000 END AS evidence_at,
    CASE WHEN i % 70 <> 9 THEN us * 1000 + (i % 17) * 60000000000 END AS authority_at
  FROM f2)
"""
)

REASON = """CASE defect WHEN 0 THEN 'unsupported_trade_schema' WHEN 1 THEN 'invalid_trade_evidence'
  WHEN 2 THEN 'invalid_trade_evidence' WHEN 3 THEN 'invalid_trade_evidence' WHEN 4 THEN 'trade_identity_mismatch' END"""


def decide(name: str, source: str, order: str = "received_ns, capture_id") -> str:
    """Decisions of the rows of a relation that has the fact columns (plus any order columns)."""
    return f"""
{name}_ok AS (
  SELECT *, first_value(capture_id) OVER w AS a, first_value(i % 3) OVER w AS ap
  FROM {source} WHERE message_type = 'trade' AND defect < 0
  WINDOW w AS (PARTITION BY asset, i % 97 ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT i, capture_id AS subject_capture_id,
    CASE WHEN a = capture_id THEN 'accepted' WHEN ap = i % 3 THEN 'duplicate' ELSE 'conflict' END AS category,
    CASE WHEN a = capture_id THEN '["' || capture_id || '"]' ELSE '["' || a || '","' || capture_id || '"]' END AS contributors,
    NULL::VARCHAR AS reason, source_id AS event_source_id, 't' || (i % 97) AS event_trade_id
  FROM {name}_ok
  UNION ALL
  SELECT i, capture_id, 'not_accepted', '["' || capture_id || '"]', {REASON}, NULL, NULL
  FROM {source} WHERE message_type = 'trade' AND defect >= 0
  UNION ALL
  SELECT i, capture_id, 'accepted', '["' || capture_id || '"]', NULL, NULL, NULL
  FROM {source} WHERE message_type <> 'trade')
"""


DECIDED = FACTS + "," + decide("d", "f")
FLAT = f"'{P}' AS policy_version, subject_capture_id, category, contributors, reason, event_source_id, event_trade_id"

PAIRED = (
    DECIDED
    + f""",
p AS (
  SELECT f.*, d.category, d.contributors, d.reason, d.event_source_id, d.event_trade_id,
    CASE WHEN evidence_at IS NULL THEN '{S.EVIDENCE_MISSING}' WHEN authority_at IS NULL THEN '{S.AUTHORITY_MISSING}'
         WHEN evidence_at > cutoff THEN '{S.EVIDENCE_MISSING}' WHEN authority_at > cutoff THEN '{S.AUTHORITY_MISSING}' END AS code,
    sha256('{{"available_at_ns":' || evidence_at || ',"capture_id":"' || capture_id || '","identity":"{EV_AUTH}","kind":"evidence","policy_version":null,"proof":"{S.PROOF_SCHEMA}"}}') AS evidence_reference,
    sha256('{{"available_at_ns":' || authority_at || ',"capture_id":"' || capture_id || '","identity":"{DEC_AUTH}","kind":"authority","policy_version":"{P}","proof":"{S.PROOF_SCHEMA}"}}') AS authority_reference,
    cutoff, lo, hi
  FROM f JOIN d ON d.subject_capture_id = f.capture_id, lim)
"""
)

RECORD_JSON = (
    "'{\"asset\":' || " + js("asset") + " || ',\"authority_reference\":' || " + js("authority_reference")
    + " || ',\"capture_id\":' || " + js("capture_id") + " || ',\"category\":' || " + js("category")
    + " || ',\"channel\":' || " + js("channel") + " || ',\"contributing_capture_ids\":' || contributors"
    + " || ',\"event\":' || coalesce('{\"message_type\":\"trade\",\"provider\":\"" + S.PROVIDER
    + "\",\"source_id\":\"' || event_source_id || '\",\"trade_id\":\"' || event_trade_id || '\"}', 'null')"
    + " || ',\"event_subtype\":' || " + js("event_subtype") + " || ',\"evidence_reference\":' || " + js("evidence_reference")
    + " || ',\"message_type\":' || " + js("message_type")
    + " || ',\"payload\":\"' || replace(payload, '\"', '\\\"') || '\"'"
    + " || ',\"policy_version\":\"" + P + "\",\"provider\":' || " + js("provider")
    + " || ',\"provider_ns\":' || " + jn("provider_ns") + " || ',\"reason\":' || " + js("reason")
    + " || ',\"received_ns\":' || " + jn("received_ns") + " || ',\"schema_version\":' || " + js("schema_version")
    + " || ',\"seq\":' || " + jn("seq") + " || ',\"sid\":' || " + jn("sid") + " || ',\"source_id\":' || " + js("source_id") + " || '}'"
)

MARKERS = (
    FACTS
    + f""",
m AS (
  SELECT i, 'evidence' AS kind, capture_id, NULL::VARCHAR AS policy_version, evidence_at AS available_at_ns,
    '{EV_AUTH}' AS source_authority_identity FROM f WHERE evidence_at IS NOT NULL
  UNION ALL
  SELECT i, 'authority', capture_id, '{P}', authority_at, '{DEC_AUTH}' FROM f WHERE authority_at IS NOT NULL)
"""
)

REQUESTS = (
    EV
    + f""",
days AS (SELECT DISTINCT us // 86400000000 AS day FROM ev),
rq0 AS (SELECT day, k, day * 68 + k AS n, (day - k % 2) * {DAY} + k * {HOUR} AS start_ns FROM days, range(68) t(k)),
rq AS (
  SELECT 'r' || n AS request_id, day * {DAY} + 2 * {DAY} + k * {HOUR} AS cutoff_ns,
    CASE WHEN n % 29 = 4 THEN 'data-truth/v2' ELSE '{P}' END AS policy_version,
    CASE WHEN k % 2 = 0 THEN 'arrival_time' ELSE 'event_time' END AS axis,
    CASE WHEN n % 4 = 0 THEN 'arrival' ELSE 'strict_event' END AS ordering,
    start_ns,
    CASE WHEN n % 31 = 5 THEN start_ns - {DAY} ELSE start_ns + (k % 31 + 1) * {HOUR} END AS end_ns,
    CASE WHEN n % 5 = 1 THEN ['ETH', 'BTC', 'ETH'] WHEN n % 5 = 2 THEN ['SOL'] WHEN n % 23 = 3 THEN ['Gold'] END AS assets,
    CASE WHEN n % 3 = 0 THEN ['trade', 'ticker', 'trade'] WHEN n % 3 = 1 THEN ['ticker'] END AS channels,
    CASE WHEN n % 37 = 6 THEN 0 ELSE 100 END AS page_size
  FROM rq0),
rv AS (
  SELECT *, CASE WHEN policy_version <> '{P}' THEN 'policy' WHEN start_ns >= end_ns THEN 'window'
    WHEN page_size <= 0 THEN 'page_size' WHEN list_contains(assets, 'Gold') THEN 'assets' END AS reject_reason,
    CASE WHEN assets = ['ETH', 'BTC', 'ETH'] THEN '["BTC","ETH"]' WHEN assets = ['SOL'] THEN '["SOL"]' WHEN assets = ['Gold'] THEN '["Gold"]' END AS assets_json,
    CASE WHEN channels = ['ticker'] THEN '["ticker"]' WHEN channels IS NOT NULL THEN '["ticker","trade"]' END AS channels_json
  FROM rq)
"""
)


def request_json(cutoff: str, assets: str, policy: str, channels: str, ordering: str, axis: str, end: str, start: str) -> str:
    return (
        f"'{{\"as_of_cutoff_ns\":' || {cutoff} || ',\"assets\":' || {assets} || ',\"authority_policy_version\":\"' || {policy}"
        f" || '\",\"channels\":' || {channels} || ',\"ordering\":\"' || {ordering} || '\",\"ordering_rule_version\":\"{S.ORDERING_RULE_VERSION}\","
        f"\"request_version\":\"{S.REQUEST_VERSION}\",\"selection_axis\":\"' || {axis} || '\",\"selection_end_ns\":' || {end}"
        f" || ',\"selection_start_ns\":' || {start} || '}}'"
    )


def source_id(role: str, logical: str, table: str) -> str:
    schema = {f.name: f.dataType.simpleString() for f in S.TABLES[table].fields}
    text = json.dumps(
        {"role": role, "logical_identity": logical, "table": table, "schema": schema, "version": S.SOURCE_VERSION},
        sort_keys=True,
        separators=(",", ":"),
    )
    return f"sha256('{text}')"


def snapshot_json(cutoff, assets, policy, channels, count, dig, ordering, axis, end, start) -> str:
    ev = source_id("evidence", EV_AUTH, "capture_fact")
    tr = source_id("truth-decision", DEC_AUTH, "truth_decision")
    av = source_id("availability", "availability/v1", "availability")
    return (
        f"'{{\"as_of_cutoff_ns\":' || {cutoff} || ',\"assets\":' || {assets} || ',\"authority_policy_version\":\"' || {policy}"
        f" || '\",\"availability_authority_identity\":\"' || {av} || '\",\"channels\":' || {channels}"
        f" || ',\"evidence_authority_identity\":\"' || {ev} || '\",\"membership_count\":' || {count}"
        f" || ',\"membership_digest\":\"' || {dig} || '\",\"ordering\":\"' || {ordering} || '\",\"ordering_rule_version\":\"{S.ORDERING_RULE_VERSION}\","
        f"\"selection_axis\":\"' || {axis} || '\",\"selection_end_ns\":' || {end} || ',\"selection_start_ns\":' || {start}"
        f" || ',\"snapshot_scheme_version\":\"set-digest/v1\",\"truth_decision_authority_identity\":\"' || {tr} || '\"}}'"
    )


# the one flagship request, as scalars of ``lim``
_REQ = request_json("cutoff", "'null'", f"'{P}'", "'null'", "'arrival'", "'arrival_time'", "((hi + 1) * 1000)", "(lo * 1000)")
_SNAP = snapshot_json("cutoff", "'null'", f"'{P}'", "'null'", "n", "dig", "'arrival'", "'arrival_time'", "((hi + 1) * 1000)", "(lo * 1000)")
SUMMARY = (
    PAIRED
    + f""",
mem AS (
  SELECT count(*) FILTER (WHERE code IS NULL) AS n, {set_digest("capture_id", "code IS NULL")} AS dig,
    count(*) FILTER (WHERE code = '{S.EVIDENCE_MISSING}') AS n_ev, count(*) FILTER (WHERE code = '{S.AUTHORITY_MISSING}') AS n_au
  FROM p),
summary AS (SELECT *, sha256({_REQ}) AS request_identity, sha256({_SNAP}) AS snapshot_identity FROM mem, lim)
"""
)

_tpl_iso = """CASE i % 5 WHEN 0 THEN '"' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%f') || 'Z"'
   WHEN 1 THEN '"' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%f') || '+01:00"'
   WHEN 2 THEN '"' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S') || '"' WHEN 3 THEN '"soon"' ELSE 'null' END"""
REF = [(a, p) for a, _, p in S.REFERENCE_IDS]
REF_SOURCE = [(p, s) for _, s, p in S.REFERENCE_IDS]
RAW = (
    EV
    + f""",
r0 AS (
  SELECT *, CASE WHEN i % 36 = 14 THEN 'UNVERIFIED' ELSE 'KX' || asset || '15M-24JAN' END AS ticker, us // 1000 AS ms,
    {_case("asset", REF)} AS ref, {_tpl_iso} AS iso, i % 12 AS k, user_id % 4 AS part FROM ev),
r AS (
  SELECT *, us * 1000 AS received_ns, CASE WHEN k NOT IN (6, 7, 8) THEN ticker END AS binding_ticker,
    sha256('feed:' || part || ':' || i) AS capture_id,
    CASE k
     WHEN 0 THEN '{{"type":"orderbook_snapshot","sid":1,"seq":' || i || ',"msg":{{"market_ticker":"' || ticker || '","market_id":"m","yes":[["0.3650","31.00"]]}}}}'
     WHEN 1 THEN '{{"type":"orderbook_delta","sid":2,"seq":' || i || ',"msg":{{"market_ticker":"' || ticker || '","price":"0.3650","ts":' || iso || ',"ts_ms":' || CASE WHEN i % 7 = 0 THEN ms::VARCHAR ELSE 'null' END || '}}}}'
     WHEN 2 THEN '{{"type":"ticker","sid":3,"seq":null,"msg":{{"market_ticker":"' || ticker || '","price":"0.3650","ts_ms":' || ms || '}}}}'
     WHEN 3 THEN '{{"type":"trade","sid":4,"seq":null,"msg":{{"trade_id":"t' || i || '","market_ticker":"' || ticker || '","yes_price":"0.3650","ts_ms":' || ms || '}}}}'
     WHEN 4 THEN '{{"type":"market_lifecycle_v2","sid":5,"seq":null,"msg":{{"event_type":"created","market_ticker":"' || ticker || '"}}}}'
     WHEN 5 THEN '{{"type":"event_fee_update","sid":6,"seq":null,"msg":{{"event_ticker":"EV-' || asset || '","fee_type_override":null}}}}'
     WHEN 6 THEN '{{"type":"cfbenchmarks_value","sid":7,"seq":null,"msg":{{"index_id":"' || ref || '","received_at":1}}}}'
     WHEN 7 THEN '{{"type":"pyth_value","sid":8,"seq":' || i || ',"msg":{{"underlying_ticker":"' || ref || '","value_usd":"1.50","source_ts_ms":' || ms || '}}}}'
     WHEN 8 THEN '{{"type":"cfbenchmarks_value_indexlist","sid":9,"seq":null,"msg":{{"index_ids":["BRTI"]}}}}'
     WHEN 9 THEN '{{"type":"mystery","sid":10,"msg":{{}}}}'
     WHEN 10 THEN '{{"type":"ticker","sid":3,"seq":null,"msg":{{"market_ticker":"OTHER","ts_ms":' || ms || '}}}}'
     ELSE 'not json ' || i END AS value,
    CASE WHEN i % 7 = 0 THEN ms * 1000000 WHEN i % 5 = 0 THEN us * 1000 WHEN i % 5 = 1 THEN (us - 3600000000) * 1000 END AS delta_ns,
    asset IN ('GOLD', 'SILVER') AS is_pyth FROM r0),
rc AS (
  SELECT *, CASE k WHEN 0 THEN 'orderbook_snapshot' WHEN 1 THEN 'orderbook_delta' WHEN 2 THEN 'ticker' WHEN 3 THEN 'trade'
      WHEN 4 THEN 'market_lifecycle_v2' WHEN 5 THEN 'event_fee_update' WHEN 6 THEN 'cfbenchmarks_value' WHEN 7 THEN 'pyth_value'
      WHEN 8 THEN 'cfbenchmarks_value_indexlist' WHEN 9 THEN 'mystery' WHEN 10 THEN 'ticker' END AS message_type,
    CASE WHEN k IN (8, 9, 11) THEN 'unsupported' WHEN k = 6 AND is_pyth THEN 'authority' WHEN k = 7 AND NOT is_pyth THEN 'authority'
      WHEN k NOT IN (6, 7) AND ticker = 'UNVERIFIED' THEN 'authority' WHEN k = 10 THEN 'incompatible' END AS reject_class FROM r)
"""
)

MARKETS = (
    EV
    + """,
w AS (SELECT DISTINCT asset, us // 900000000 AS w FROM ev),
req AS (
  SELECT asset || ':' || w AS request_id, asset, w, w * 900000000 AS open_us, (w + 1) * 900000000 AS close_us,
    'KX' || asset || '15M' AS series,
    'KX' || asset || '15M-' || upper(strftime((make_timestamp((w + 1) * 900000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%y%b%d%H%M-%M')) AS cand
  FROM w),
mk AS (
  SELECT asset, w, series AS series_ticker, open_us, close_us, CASE WHEN w % 3 = 0 THEN series || '-W' || w ELSE cand END AS ticker,
    'EV-' || asset AS event_ticker, CASE w % 5 WHEN 0 THEN 'less_or_equal' WHEN 1 THEN 'between' ELSE 'greater' END AS strike_type,
    CASE WHEN w % 7 <> 0 AND w % 5 <> 0 THEN 100.5::DOUBLE END AS floor_strike,
    CASE WHEN w % 7 <> 0 AND w % 5 IN (0, 1) THEN 200.25::DOUBLE END AS cap_strike, w % 7 <> 0 AS usable
  FROM req, (VALUES (0), (1)) t(copy) WHERE w % 17 <> 0 AND (copy = 0 OR w % 13 = 0)),
ver AS (
  SELECT *, CASE WHEN w % 17 = 0 THEN 'no_match' WHEN w % 13 = 0 THEN 'ambiguous' WHEN w % 7 = 0 THEN 'invalid' ELSE 'verified' END AS status,
    CASE WHEN w % 17 = 0 THEN 0 WHEN w % 13 = 0 THEN 2 ELSE 1 END::BIGINT AS n_markets,
    CASE WHEN w % 17 = 0 THEN 'no_market' WHEN w % 13 = 0 THEN 'several_markets' WHEN w % 7 = 0 THEN 'strike_not_usable' END AS reason,
    CASE WHEN w % 17 <> 0 AND w % 13 <> 0 AND w % 7 <> 0 THEN CASE WHEN w % 3 = 0 THEN series || '-W' || w ELSE cand END END AS official
  FROM req)
"""
)


def shadow(cand: str) -> str:
    return f"""CASE WHEN {cand} IS NULL THEN 'candidate_missing' WHEN status = 'no_match' THEN 'official_missing'
      WHEN status <> 'verified' THEN 'verification_failed' WHEN {cand} = official THEN 'match' ELSE 'mismatch' END"""


_PASS = "(r.assets IS NULL OR list_contains(r.assets, p.asset)) AND (r.channels IS NULL OR list_contains(r.channels, p.channel))"
MANY = (
    PAIRED.replace("lim AS", "lim AS", 1)
    + REQUESTS[len(EV):]
    + f""",
v AS (SELECT * FROM rv WHERE reject_reason IS NULL),
sel AS (
  SELECT r.request_id, r.ordering, p.capture_id, p.category, p.received_ns, p.provider_ns
  FROM v r JOIN p ON {_PASS} AND p.evidence_at <= r.cutoff_ns AND p.authority_at <= r.cutoff_ns
   AND CASE r.axis WHEN 'arrival_time' THEN p.received_ns ELSE p.provider_ns END >= r.start_ns
   AND CASE r.axis WHEN 'arrival_time' THEN p.received_ns ELSE p.provider_ns END < r.end_ns)
"""
)
#: Requests that a single read refuses for want of event times.
REFUSED = f""", refused AS (
  SELECT request_id FROM v r JOIN p ON {_PASS} WHERE r.axis = 'event_time' AND p.evidence_at <= r.cutoff_ns AND p.authority_at <= r.cutoff_ns AND p.provider_ns IS NULL
  UNION SELECT request_id FROM sel WHERE ordering = 'strict_event' AND provider_ns IS NULL)
"""

PROOF = (
    MARKERS
    + """,
c AS (
  SELECT *, CASE WHEN i % 13 = 0 THEN 1704067200000000000 ELSE available_at_ns // 3600000000000 * 3600000000000 END AS candidate_ns FROM m)
"""
)


def proof_times(source: str, floor: str) -> str:
    """Closed form of the recurrence over the issue order."""
    return f"""
{source}_ranked AS (
  SELECT *, row_number() OVER (ORDER BY candidate_ns, CASE kind WHEN 'evidence' THEN 0 ELSE 1 END, capture_id) - 1 AS pos
  FROM {source}),
{source}_timed AS (
  SELECT *, (pos + greatest({floor} + 1, max(candidate_ns - pos) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))::BIGINT AS at_ns
  FROM {source}_ranked)
"""


def all_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    def put(name: str, ctes: str, body: str) -> None:
        q[name] = f"WITH {ctes} {body}"

    # ---------------------------------------------------------------------------------- storage
    put("scan_capture_range", FACTS, """SELECT capture_id, asset, source_id, provider_ns, received_ns FROM f, lim
      WHERE channel = 'ticker' AND received_ns BETWEEN (lo + (hi - lo) // 4) * 1000 AND (hi - (hi - lo) // 4) * 1000""")
    put("lookup_capture", FACTS, """SELECT capture_id, CASE WHEN i % 9 = 4 THEN 0 WHEN i % 500 = 0 THEN 2 ELSE 1 END::BIGINT AS n_rows,
      CASE WHEN i % 9 = 4 THEN 'absent' WHEN i % 500 = 0 THEN 'not_unique' ELSE 'found' END AS outcome FROM f""")
    put("append_captures", FACTS, "SELECT capture_id, received_ns, payload FROM f WHERE i % 3 <> 0")
    put("commit_captures", FACTS, "SELECT capture_id, received_ns, payload FROM f")
    put("commit_decisions", DECIDED, "SELECT subject_capture_id, category FROM d")
    put("commit_availability", MARKERS, "SELECT kind, capture_id, policy_version, (SELECT max(available_at_ns) FROM m) AS committed_floor FROM m")
    put("stream_append_captures", FACTS, "SELECT capture_id, asset, received_ns, payload FROM f")
    put("audit_duplicate_captures", FACTS, """, x AS (SELECT capture_id, received_ns, i FROM f UNION ALL SELECT capture_id, received_ns, i FROM f WHERE i % 100 = 3
      UNION ALL SELECT capture_id, received_ns + 1, i FROM f WHERE i % 200 = 5)
      SELECT 'received_ns_capture_id' AS audit, capture_id, received_ns, count(*) AS n FROM x GROUP BY capture_id, received_ns HAVING count(*) > 1
      UNION ALL SELECT 'capture_id', capture_id, NULL, count(*) FROM x GROUP BY capture_id HAVING count(*) > 1""")
    put("validate_capture_rows", FACTS, """SELECT capture_id, CASE WHEN i % 20 = 2 THEN 'Gold' ELSE asset END AS asset,
      CASE i % 20 WHEN 0 THEN 'blank_source_id' WHEN 1 THEN 'blank_message_type' WHEN 2 THEN 'non_canonical_asset' WHEN 3 THEN 'missing_sid'
       WHEN 4 THEN 'missing_payload' WHEN 5 THEN 'missing_text' END AS reject_reason FROM f""")
    bad_decision = """CASE i % 20 WHEN 0 THEN 'unknown_category' WHEN 1 THEN 'unknown_reason' WHEN 2 THEN 'bad_contributors' WHEN 3 THEN 'bad_contributors'
       WHEN 4 THEN CASE WHEN event_trade_id IS NOT NULL THEN 'partial_identity' END END"""
    put("validate_decision_rows", DECIDED, f"SELECT subject_capture_id, {bad_decision} AS reject_reason FROM d")
    bad_marker = """CASE i % 20 WHEN 0 THEN 'unknown_kind' WHEN 1 THEN CASE kind WHEN 'authority' THEN 'authority_without_policy' END
       WHEN 2 THEN CASE kind WHEN 'evidence' THEN 'evidence_with_policy' END WHEN 3 THEN 'bad_time' WHEN 4 THEN 'unsupported_proof' WHEN 5 THEN 'blank_authority' END"""
    put("validate_availability_rows", MARKERS, f"""SELECT capture_id, kind, max(reject_reason) AS reject_reason, count(*) AS n FROM
      (SELECT capture_id, CASE WHEN i % 20 = 0 THEN 'hearsay' ELSE kind END AS kind, {bad_marker} AS reject_reason FROM m) GROUP BY capture_id, kind""")
    put("check_table_contract", DECIDED, f"""SELECT 'capture_fact' AS table_name, finding, 'rows' AS scope, count(*) AS n FROM (SELECT CASE i % 20 WHEN 0 THEN 'blank_source_id' WHEN 1 THEN 'blank_message_type'
       WHEN 2 THEN 'non_canonical_asset' WHEN 3 THEN 'missing_sid' WHEN 4 THEN 'missing_payload' WHEN 5 THEN 'missing_text' END AS finding FROM f) WHERE finding IS NOT NULL GROUP BY finding
      UNION ALL SELECT 'truth_decision', finding, 'rows', count(*) FROM (SELECT {bad_decision} AS finding FROM d) WHERE finding IS NOT NULL GROUP BY finding
      UNION ALL SELECT 'availability', finding, 'schema', 1 FROM (VALUES ('wrong_type:written_at_ns'), ('extra_column:note')) t(finding)""")
    put("evolve_capture_schema", FACTS, """SELECT capture_id, message_type, NULL::VARCHAR AS source_id, NULL::VARCHAR AS event_subtype, 'blank_source_id' AS reject_reason FROM f""")
    put("append_decisions", DECIDED, """SELECT subject_capture_id, category, CASE WHEN i % 2 <> 0 THEN 'new' WHEN i % 10 = 4 AND category <> 'conflict' THEN 'conflict' ELSE 'same' END AS outcome FROM d""")
    put("find_subject_decision", DECIDED, f"""SELECT '{P}' AS policy_version, subject_capture_id,
      (CASE WHEN i % 7 = 0 THEN 0 ELSE 1 END + CASE WHEN i % 1000 = 1 THEN 1 ELSE 0 END)::BIGINT AS n_decisions,
      CASE WHEN (i % 7 = 0) <> (i % 1000 <> 1) THEN category END AS category,
      CASE WHEN i % 7 = 0 AND i % 1000 <> 1 THEN 'absent' WHEN i % 7 <> 0 AND i % 1000 = 1 THEN 'not_unique' ELSE 'found' END AS outcome FROM d""")
    put("append_availability", MARKERS, """SELECT kind, capture_id, policy_version, CASE WHEN i % 2 <> 0 THEN 'new' WHEN i % 10 = 4 THEN 'conflict' ELSE 'same' END AS outcome FROM m""")

    # ----------------------------------------------------------------------------------- ingest
    put("read_raw_messages", RAW, """SELECT 'feed' AS source, part AS partition, i AS "offset", received_ns, binding_ticker, value FROM r""")
    put("subscribe_scope_filter", RAW, """SELECT i AS "offset", CASE k WHEN 7 THEN 'pyth_value' ELSE 'cf_benchmarks' END AS source, ref AS provider_id
      FROM r WHERE k IN (6, 7) AND (k = 7) = is_pyth""")
    put("normalize_messages", RAW, f"""SELECT capture_id, asset, '{S.PROVIDER}' AS provider, CASE WHEN k IN (6, 7) THEN ref ELSE ticker END AS source_id,
      CASE message_type WHEN 'orderbook_snapshot' THEN 'orderbook_delta' WHEN 'event_fee_update' THEN 'market_lifecycle_v2' ELSE message_type END AS channel,
      message_type, CASE WHEN k = 4 THEN 'created' END AS event_subtype, (k + 1)::BIGINT AS sid, CASE WHEN k IN (0, 1, 7) THEN i END AS seq,
      CASE WHEN k = 1 THEN delta_ns WHEN k IN (2, 3, 7) THEN ms * 1000000 END AS provider_ns, received_ns, '{S.MESSAGE_SCHEMA}' AS schema_version, value AS payload
      FROM rc WHERE reject_class IS NULL""")
    put("reject_messages", RAW, "SELECT capture_id, message_type, received_ns, value AS payload, reject_class FROM rc WHERE reject_class IS NOT NULL")
    put("event_time_ms_to_ns", RAW, """SELECT i AS "offset", ms AS ts_ms, ms * 1000000 AS event_ns FROM r WHERE k IN (2, 3, 7, 10) OR (k = 1 AND i % 7 = 0)""")
    put("delta_event_time", RAW, """SELECT i AS "offset", delta_ns AS event_ns FROM r WHERE k = 1""")
    put("assign_capture_id", RAW, """SELECT part AS partition, i AS "offset", capture_id FROM r""")
    put("bind_reference_asset", RAW, f"""SELECT i AS "offset", CASE k WHEN 6 THEN 'cf_benchmarks' ELSE 'pyth_value' END AS source, ref AS provider_id,
      CASE WHEN (k = 7) = is_pyth THEN asset END AS asset FROM r WHERE k IN (6, 7)""")
    put("bind_market_identity", RAW, """SELECT i AS "offset", binding_ticker, CASE WHEN binding_ticker <> 'UNVERIFIED' THEN 'EV-' || asset END AS bound_event_ticker,
      CASE WHEN binding_ticker <> 'UNVERIFIED' THEN asset END AS bound_asset FROM r""")
    put("scope_dimensions", EV, f"""SELECT asset, count(*) AS n_events, 'KX' || asset || '15M' AS series_ticker, {_case(_case("asset", REF), REF_SOURCE)} AS source,
      {_case("asset", REF)} AS provider_id, true AS market_ok, true AS reference_ok FROM ev GROUP BY asset""")

    # ---------------------------------------------------------------------------------- markets
    put("quarter_hour_window", EV, """SELECT i AS event_id, epoch_us(time_bucket(INTERVAL 15 MINUTES, make_timestamp(us))) AS open_time_us,
      epoch_us(time_bucket(INTERVAL 15 MINUTES, make_timestamp(us)) + INTERVAL 15 MINUTES) AS close_time_us FROM ev""")
    put("next_window", EV, """SELECT i AS event_id, (us // 900000000 + 1) * 900000000 AS open_time_us, (us // 900000000 + 2) * 900000000 AS close_time_us FROM ev""")
    put("valid_window", EV, "SELECT i AS event_id, i % 5 NOT IN (1, 2, 3) AS valid FROM ev")
    put("predict_ticker", MARKETS, "SELECT request_id, CASE WHEN asset <> 'BNB' THEN cand END AS candidate_ticker FROM req")
    put("discover_markets", MARKETS, """SELECT r.request_id, m.ticker, m.close_us AS close_time_us FROM req r JOIN mk m ON m.series_ticker = r.series
      AND m.close_us BETWEEN r.close_us - 900000000 AND r.close_us + 900000000""")
    put("translate_market", MARKETS, "SELECT series_ticker, ticker, open_us AS open_time_us, strike_type, floor_strike, cap_strike FROM mk")
    put("usable_strike", MARKETS, "SELECT series_ticker, ticker, open_us AS open_time_us, usable FROM mk")
    put("verify_market", MARKETS, """SELECT request_id, n_markets, status, reason, official AS official_ticker, CASE WHEN official IS NOT NULL THEN 'EV-' || asset END AS official_event_ticker FROM ver""")
    put("shadow_compare", MARKETS, f"SELECT request_id, {shadow('CASE WHEN asset <> ' + chr(39) + 'XRP' + chr(39) + ' THEN cand END')} AS shadow FROM ver")
    put("resolve_markets", MARKETS, f"""SELECT request_id, CASE asset WHEN 'HYPE' THEN 'WTI' ELSE asset END AS asset, CASE WHEN asset <> 'HYPE' THEN cand END AS candidate_ticker,
      CASE asset WHEN 'HYPE' THEN 'invalid' ELSE status END AS status, CASE asset WHEN 'HYPE' THEN 'unknown asset' ELSE reason END AS reason,
      CASE WHEN asset <> 'HYPE' THEN official END AS official_ticker, CASE asset WHEN 'HYPE' THEN 'candidate_missing' ELSE {shadow('cand')} END AS shadow FROM ver""")

    # ------------------------------------------------------------------------------------ truth
    put("route_facts", FACTS, """SELECT capture_id, CASE WHEN i % 50 = 0 THEN 'mystery' ELSE message_type END AS message_type,
      CASE WHEN i % 50 = 0 THEN 'unsupported' WHEN message_type = 'trade' THEN 'event' ELSE 'observation' END AS family FROM f""")
    put("accept_observations", DECIDED, f"SELECT {FLAT} FROM d JOIN f USING (i) WHERE message_type <> 'trade'")
    put("validate_trades", FACTS, f"SELECT capture_id, {REASON} AS reason FROM f WHERE message_type = 'trade'")
    put("trade_identity", FACTS, "SELECT capture_id, provider, source_id, message_type, 't' || (i % 97) AS trade_id FROM f WHERE message_type = 'trade' AND defect < 0")
    put("trade_projection", FACTS, """SELECT capture_id, '{"count":"9.00","is_block_trade":false,"no_price":"0.6150","taker_side":"yes","ts":' || (1704067200 + i % 97) || ',"ts_ms":' ||
      (1704067200 + i % 97) || '000,"yes_price":"0.4' || (i % 3) || '00"}' AS projection FROM f WHERE message_type = 'trade' AND defect < 0""")
    put("adjudicate_trades", DECIDED, f"SELECT {FLAT} FROM d JOIN f USING (i) WHERE message_type = 'trade'")
    put("decide_facts", DECIDED, f"SELECT {FLAT} FROM d")
    put("find_accepted_anchor", DECIDED, """SELECT capture_id, event_source_id, event_trade_id, received_ns, payload FROM d JOIN f USING (i) WHERE category = 'accepted' AND message_type = 'trade'""")
    put("check_anchor_invariants", DECIDED, """, a AS (SELECT i, subject_capture_id FROM d WHERE category = 'accepted' AND event_trade_id IS NOT NULL),
      ta AS (SELECT 'kalshi/' || event_source_id || '/trade/t-none' AS k, count(*) AS n FROM d WHERE category = 'accepted' AND event_trade_id IS NOT NULL AND i % 4 = 2 GROUP BY event_source_id)
      SELECT subject_capture_id, 'missing_evidence' AS rule FROM a WHERE i % 3 = 0 UNION ALL SELECT subject_capture_id, 'policy_differs' FROM a WHERE i % 4 = 0
      UNION ALL SELECT subject_capture_id, 'not_a_contributor' FROM a WHERE i % 4 = 1 UNION ALL SELECT subject_capture_id, 'identity_differs' FROM a WHERE i % 4 = 2 AND i % 3 <> 0
      UNION ALL SELECT k, 'several_accepted' FROM ta WHERE n > 1""")
    put("decide_incremental", FACTS, f""", late AS (SELECT f.*, 0 AS pri FROM f, lim WHERE received_ns >= cutoff), early AS (SELECT f.*, 1 AS pri FROM f, lim WHERE received_ns < cutoff),
      {decide("dl", "late")}, anchors AS (SELECT late.* FROM late JOIN dl USING (i) WHERE dl.category = 'accepted' AND dl.event_trade_id IS NOT NULL),
      b AS (SELECT * FROM anchors UNION ALL SELECT * FROM early), {decide("db", "b", "pri, received_ns, capture_id")}
      SELECT {FLAT} FROM db JOIN early USING (i)""")
    put("decide_stream", DECIDED, f"SELECT {FLAT} FROM d")

    # ----------------------------------------------------------------------------- availability
    put("prove_evidence", FACTS, """SELECT capture_id, CASE WHEN i % 9 = 0 AND i % 1000 <> 1 THEN 'absent' WHEN i % 9 <> 0 AND i % 1000 = 1 THEN 'not_unique'
      WHEN i % 10 = 0 THEN 'mismatch' ELSE 'proven' END AS outcome FROM f""")
    put("prove_authority", DECIDED, f"""SELECT '{P}' AS policy_version, subject_capture_id, CASE WHEN i % 9 = 0 THEN 'absent' WHEN i % 10 = 0 AND category <> 'conflict' THEN 'mismatch' ELSE 'proven' END AS outcome FROM d""")
    put("assign_proof_times", PROOF + "," + proof_times("c", "(SELECT lo * 1000 FROM lim)"), "SELECT kind, capture_id, at_ns AS available_at_ns FROM c_timed")
    put("record_markers", PROOF + ", cn AS (SELECT * FROM c WHERE i % 2 <> 0)," + proof_times("cn", "(SELECT lo * 1000 FROM lim)"), """
      SELECT kind, capture_id, at_ns AS available_at_ns, 'new' AS outcome FROM cn_timed UNION ALL
      SELECT kind, capture_id, available_at_ns, CASE WHEN i % 10 = 4 THEN 'conflict' ELSE 'same' END FROM m WHERE i % 2 = 0""")
    put("committed_floor", MARKERS, "SELECT max(available_at_ns) AS committed_floor, count(*) FILTER (WHERE i % 1000 = 1) AS duplicate_keys FROM m")
    lookup = """CASE WHEN {at} IS NULL THEN 'absent' WHEN i % 1000 = 1 OR i % 90 = 2 THEN 'AVAILABILITY_EVIDENCE_MISSING' ELSE 'found' END"""
    ok = "CASE WHEN i % 1000 <> 1 AND i % 90 <> 2 THEN {at} END"
    put("marker_lookup", FACTS, f"""SELECT 'evidence' AS kind, capture_id, NULL::VARCHAR AS policy_version, {lookup.format(at='evidence_at')} AS outcome, {ok.format(at='evidence_at')} AS available_at_ns FROM f
      UNION ALL SELECT 'authority', capture_id, '{P}', {lookup.format(at='authority_at')}, {ok.format(at='authority_at')} FROM f""")
    put("marker_reference", PAIRED, """SELECT 'evidence' AS kind, capture_id, evidence_reference AS reference FROM p WHERE evidence_at IS NOT NULL
      UNION ALL SELECT 'authority', capture_id, authority_reference FROM p WHERE authority_at IS NOT NULL""")
    gate = f"{_list([*S.PERSISTENCE_CONTINUE, *S.PERSISTENCE_STOP, 'lost'])}[i % 6 + 1]"
    put("persistence_gate", FACTS, f"""SELECT capture_id, {gate} AS persistence_status, CASE WHEN i % 6 < 3 THEN 'continue' WHEN i % 6 < 5 THEN 'stop' ELSE 'refused' END AS gate FROM f""")
    put("record_captures", FACTS + """, g AS (SELECT * FROM f WHERE i % 6 < 3 AND i % 9 <> 0),""" + decide("dg", "g") + """,
      c AS (SELECT i, 'evidence' AS kind, capture_id, received_ns AS candidate_ns FROM g UNION ALL SELECT i, 'authority', capture_id, received_ns FROM g),""" + proof_times("c", "-9000000000000000000"),
        """SELECT f.capture_id, CASE WHEN i % 6 >= 3 THEN 'not_sent' WHEN i % 9 = 0 THEN 'absent' ELSE 'proven' END AS evidence_proof, dg.category, e.at_ns AS evidence_at, a.at_ns AS authority_at
      FROM f LEFT JOIN dg USING (i) LEFT JOIN (SELECT * FROM c_timed WHERE kind = 'evidence') e USING (i) LEFT JOIN (SELECT * FROM c_timed WHERE kind = 'authority') a USING (i)""")
    put("recover_facts", RAW + """, g AS (SELECT * FROM rc WHERE reject_class IS NULL),
      c AS (SELECT i, 'evidence' AS kind, capture_id, received_ns AS candidate_ns FROM g UNION ALL SELECT i, 'authority', capture_id, received_ns FROM g),""" + proof_times("c", "-9000000000000000000"),
        "SELECT kind, capture_id, at_ns AS available_at_ns FROM c_timed")

    put("record_stream", RAW + """, g AS (SELECT * FROM rc WHERE reject_class IS NULL),
      c AS (SELECT i, 'evidence' AS kind, capture_id, received_ns AS candidate_ns FROM g UNION ALL SELECT i, 'authority', capture_id, received_ns FROM g),""" + proof_times("c", "-9000000000000000000"),
        """SELECT b AS batch_id, g.capture_id, CASE WHEN bad THEN 'not_sent' ELSE 'proven' END AS evidence_proof, CASE WHEN NOT bad THEN e.at_ns END AS evidence_at,
        CASE WHEN NOT bad THEN a.at_ns END AS authority_at, CASE WHEN bad THEN 'content_conflict' END AS defect
      FROM (SELECT 0::BIGINT AS b, i, capture_id, false AS bad FROM g UNION ALL SELECT 1, i, capture_id, i % 50 < 5 FROM g WHERE i % 50 < 10) g
      JOIN (SELECT * FROM c_timed WHERE kind = 'evidence') e USING (i) JOIN (SELECT * FROM c_timed WHERE kind = 'authority') a USING (i)""")

    # ----------------------------------------------------------------------------------- replay
    put("validate_requests", REQUESTS, "SELECT request_id, reject_reason FROM rv")
    put("canonical_filters", REQUESTS, "SELECT request_id, assets_json AS assets, channels_json AS channels FROM rv")
    req = request_json("cutoff_ns", "coalesce(assets_json, 'null')", "policy_version", "coalesce(channels_json, 'null')", "ordering", "axis", "end_ns", "start_ns")
    put("request_identity", REQUESTS, f"SELECT request_id, sha256({req}) AS request_identity FROM rv")
    put("pair_candidates", PAIRED, """SELECT capture_id, category, received_ns, provider_ns, evidence_at, authority_at, 1::BIGINT AS n_fact, 1::BIGINT AS n_decision,
      (evidence_at IS NOT NULL)::BIGINT AS n_evidence, (authority_at IS NOT NULL)::BIGINT AS n_authority FROM p""")
    put("pair_violations", FACTS, """SELECT capture_id, code FROM (SELECT capture_id, CASE i % 100 WHEN 1 THEN 'MALFORMED_EVIDENCE' WHEN 2 THEN 'MALFORMED_EVIDENCE' WHEN 3 THEN 'AUTHORITY_CONFLICT' WHEN 4 THEN 'MALFORMED_AUTHORITY'
      WHEN 5 THEN CASE WHEN evidence_at IS NOT NULL OR authority_at IS NOT NULL THEN 'AVAILABILITY_EVIDENCE_MISSING' END
      WHEN 6 THEN CASE WHEN evidence_at IS NOT NULL OR authority_at IS NOT NULL THEN 'AVAILABILITY_EVIDENCE_MISSING' END END AS code FROM f) WHERE code IS NOT NULL""")
    put("filter_candidates", PAIRED, "SELECT capture_id, category FROM p WHERE asset IN ('BTC', 'SOL') AND channel IN ('ticker', 'trade')")
    put("check_pairs", FACTS, """SELECT 'x' || capture_id AS subject_capture_id, 'MALFORMED_AUTHORITY' AS code FROM f, (VALUES (0), (1)) t(copy) WHERE i % 70 = 0 AND (copy = 0 OR i % 90 = 0)
      UNION ALL SELECT CASE WHEN i % 70 = 0 THEN 'x' ELSE '' END || capture_id, 'AUTHORITY_CONFLICT' FROM f WHERE i % 90 = 0""")
    put("qualify_as_of", PAIRED, "SELECT capture_id, category, evidence_at, authority_at FROM p WHERE evidence_at <= cutoff AND authority_at <= cutoff")
    put("check_availability_pairs", FACTS, """SELECT capture_id, side, 'AVAILABILITY_EVIDENCE_MISSING' AS code FROM (
      SELECT capture_id, 'evidence' AS side, (i % 50 <> 7) <> (i % 3 = 0) AS bad FROM f UNION ALL
      SELECT capture_id, 'authority', CASE WHEN i % 70 <> 9 THEN i % 7 = 0 OR i % 2 <> 0 ELSE i % 7 = 0 OR i % 2 = 0 END FROM f) WHERE bad""")
    put("replay_exclusions", PAIRED, "SELECT capture_id, code FROM p WHERE code IS NOT NULL")
    put("select_arrival_window", PAIRED, f"SELECT capture_id, received_ns FROM p WHERE code IS NULL AND received_ns >= lo * 1000 + {DAY} AND received_ns < cutoff - {DAY}")
    put("select_event_window", PAIRED, f"""SELECT capture_id, provider_ns FROM p WHERE code IS NULL AND channel IN ('orderbook_delta', 'ticker', 'trade')
      AND provider_ns >= lo * 1000 + {DAY} AND provider_ns < hi * 1000 - {DAY}""")
    put("order_arrival", PAIRED, "SELECT received_ns, capture_id FROM p WHERE code IS NULL ORDER BY received_ns, capture_id")
    put("order_strict_event", PAIRED, """SELECT provider_ns, received_ns, capture_id FROM p WHERE code IS NULL AND channel IN ('orderbook_delta', 'ticker', 'trade')
      AND provider_ns >= lo * 1000 AND provider_ns < (hi + 1) * 1000 ORDER BY ALL""")
    put("snapshot_identity", SUMMARY, "SELECT request_identity, n AS n_records, snapshot_identity FROM summary")
    put("detect_drift", PAIRED, f""", later AS (SELECT capture_id FROM p WHERE evidence_at <= cutoff + {DAY} AND authority_at <= cutoff + {DAY} AND capture_id NOT LIKE '%77'), earlier AS (SELECT capture_id FROM p WHERE code IS NULL)
      SELECT capture_id, 'added' AS change FROM later WHERE capture_id NOT IN (SELECT capture_id FROM earlier) UNION ALL SELECT capture_id, 'removed' FROM earlier WHERE capture_id NOT IN (SELECT capture_id FROM later)""")
    put("resume_check", PAIRED, """SELECT capture_id AS bookmark_id, CASE i % 7 WHEN 0 THEN 'CURSOR_MISMATCH' WHEN 1 THEN 'SOURCE_UNAVAILABLE' WHEN 2 THEN 'INVALID_CURSOR' WHEN 3 THEN 'INVALID_CURSOR' WHEN 4 THEN 'INVALID_CURSOR'
      ELSE CASE WHEN code IS NULL THEN 'ok' ELSE 'INVALID_CURSOR' END END AS outcome FROM p""")
    put("keyset_page", PAIRED, """, k AS (SELECT received_ns, capture_id, row_number() OVER (ORDER BY received_ns, capture_id) AS rn, count(*) OVER () AS n FROM p WHERE code IS NULL)
      SELECT rn - 500 AS position, received_ns, capture_id, n > 1000 AS has_more FROM k WHERE rn > 500 AND rn <= 1000""")
    put("replay_pages", PAIRED, """, k AS (SELECT *, row_number() OVER (ORDER BY received_ns, capture_id) - 1 AS rn, count(*) OVER () AS n FROM p WHERE code IS NULL)
      SELECT rn // 500 + 1 AS page, rn % 500 + 1 AS position, received_ns, capture_id, category, payload, n > (rn // 500 + 1) * 500 AS has_more FROM k WHERE rn < 2000""")
    put("replay_as_of", PAIRED, """SELECT capture_id, asset, channel, source_id, provider_ns, received_ns, payload, category, contributors, event_trade_id, evidence_reference, authority_reference
      FROM p WHERE code IS NULL ORDER BY received_ns, capture_id""")
    put("view_summary", SUMMARY, f"""SELECT request_identity, '{P}' AS policy_version, cutoff AS cutoff_ns, 'arrival_time' AS axis, lo * 1000 AS start_ns, (hi + 1) * 1000 AS end_ns, 'arrival' AS ordering,
      '{S.ORDERING_RULE_VERSION}' AS ordering_rule_version, snapshot_identity, '{S.COMPLETENESS}' AS completeness, n AS n_records, n_ev AS n_evidence_missing, n_au AS n_authority_missing FROM summary""")
    put("replay_many", MANY, REFUSED + "SELECT request_id, capture_id, category, received_ns, provider_ns FROM sel ANTI JOIN refused USING (request_id)")
    put("replay_many_exclusions", MANY, REFUSED + f"""SELECT request_id, code, count(*) AS n, min(capture_id) AS first_capture_id, max(capture_id) AS last_capture_id
      FROM (SELECT request_id, capture_id, CASE WHEN p.evidence_at IS NULL THEN '{S.EVIDENCE_MISSING}' WHEN p.authority_at IS NULL THEN '{S.AUTHORITY_MISSING}'
        WHEN p.evidence_at > r.cutoff_ns THEN '{S.EVIDENCE_MISSING}' ELSE '{S.AUTHORITY_MISSING}' END AS code
        FROM (SELECT v.* FROM v ANTI JOIN refused USING (request_id)) r JOIN p ON {_PASS} AND (coalesce(p.evidence_at > r.cutoff_ns, true) OR coalesce(p.authority_at > r.cutoff_ns, true)))
      GROUP BY request_id, code""")
    snap = snapshot_json("cutoff_ns", "coalesce(assets_json, 'null')", "policy_version", "coalesce(channels_json, 'null')", "coalesce(n_records, 0)",
                         "coalesce(dig, '" + ".".join("0" * 16) + "')", "ordering", "axis", "end_ns", "start_ns")
    put("replay_many_summaries", MANY, f""", mem AS (SELECT request_id, count(*) AS n_records, {set_digest("capture_id")} AS dig, count(*) FILTER (WHERE provider_ns IS NULL) AS undated FROM sel GROUP BY request_id),
      cnt AS (SELECT r.request_id,
        count(*) FILTER (WHERE p.evidence_at IS NULL OR (p.authority_at IS NOT NULL AND p.evidence_at > r.cutoff_ns)) AS n_ev,
        count(*) FILTER (WHERE p.evidence_at IS NOT NULL AND (p.authority_at IS NULL OR (p.evidence_at <= r.cutoff_ns AND p.authority_at > r.cutoff_ns))) AS n_au,
        count(*) FILTER (WHERE p.evidence_at <= r.cutoff_ns AND p.authority_at <= r.cutoff_ns) AS n_q,
        count(*) FILTER (WHERE p.evidence_at <= r.cutoff_ns AND p.authority_at <= r.cutoff_ns AND p.provider_ns IS NULL) AS q_undated
        FROM v r JOIN p ON {_PASS} GROUP BY r.request_id)
      SELECT request_id, request_identity, CASE WHEN outcome = 'ok' THEN identity END AS snapshot_identity, outcome,
        CASE WHEN outcome = 'ok' THEN n END AS n_records, n_qualified, n_evidence_missing, n_authority_missing
      FROM (SELECT request_id, sha256({req}) AS request_identity, sha256({snap}) AS identity,
        CASE WHEN (axis = 'event_time' AND coalesce(q_undated, 0) > 0) OR (ordering = 'strict_event' AND coalesce(undated, 0) > 0) THEN 'UNSUPPORTED_EVENT_TIME' ELSE 'ok' END AS outcome,
        coalesce(n_records, 0) AS n, coalesce(n_q, 0) AS n_qualified, coalesce(n_ev, 0) AS n_evidence_missing, coalesce(n_au, 0) AS n_authority_missing
      FROM v LEFT JOIN mem USING (request_id) LEFT JOIN cnt USING (request_id))""")

    # ---------------------------------------------------------------------------------- dataset
    put("collect_view", PAIRED, "SELECT capture_id, category, message_type, received_ns FROM p WHERE code IS NULL")
    put("admit_records", PAIRED, "SELECT capture_id, asset, payload, evidence_reference FROM p WHERE code IS NULL AND category = 'accepted'")
    put("record_digest", PAIRED, f"SELECT capture_id, sha256({RECORD_JSON}) AS record_digest FROM p WHERE code IS NULL")
    put("category_exclusions", PAIRED, f"SELECT capture_id, category, sha256({RECORD_JSON}) AS record_digest, 'excluded_by_category' AS disposition FROM p WHERE code IS NULL AND category <> 'accepted'")
    put("exclusion_provenance", PAIRED, f"""SELECT capture_id, category, sha256({RECORD_JSON}) AS record_digest, 'excluded_by_category' AS disposition, 'category' AS layer, NULL::VARCHAR AS code FROM p WHERE code IS NULL AND category <> 'accepted'
      UNION ALL SELECT capture_id, NULL, NULL, NULL, 'replay', code FROM p WHERE code IS NOT NULL""")
    inc, cat, rep = "code IS NULL AND category = 'accepted'", "code IS NULL AND category <> 'accepted'", "code IS NOT NULL"
    excl_json = "'{\"capture_id\":\"' || capture_id || '\",\"category\":\"' || category || '\",\"digest\":\"' || rd || '\",\"disposition\":\"excluded_by_category\"}'"
    rep_json = "'{\"capture_id\":\"' || capture_id || '\",\"code\":\"' || code || '\"}'"
    manifest_json = (
        f"'{{\"authority_policy_version\":\"{P}\",\"category_exclusions\":\"' || c_dig || '\",\"completeness\":\"{S.COMPLETENESS}\",\"dataset_policy_version\":\"{S.DATASET_POLICY}\","
        "\"included\":\"' || i_dig || '\",\"manifest_version\":\"set-digest/v1\",\"n_category_excluded\":' || nc || ',\"n_included\":' || ni || ',\"n_replay_excluded\":' || nr"
        " || ',\"ordering\":\"arrival\",\"replay_exclusions\":\"' || r_dig || '\",\"request_identity\":\"' || request_identity || '\",\"source_snapshot_identity\":\"' || snapshot_identity || '\"}'"
    )
    put("dataset_manifest", SUMMARY, f""", pr AS (SELECT *, CASE WHEN code IS NULL THEN sha256({RECORD_JSON}) END AS rd FROM p),
      fold AS (SELECT count(*) FILTER (WHERE {inc}) AS ni, count(*) FILTER (WHERE {cat}) AS nc, count(*) FILTER (WHERE {rep}) AS nr,
        {set_digest("rd", inc)} AS i_dig, {set_digest(excl_json, cat)} AS c_dig, {set_digest(rep_json, rep)} AS r_dig FROM pr)
      SELECT sha256({manifest_json}) AS dataset_identity, '{S.DATASET_POLICY}' AS dataset_policy_version, request_identity, snapshot_identity, '{P}' AS policy_version, 'arrival' AS ordering,
        '{S.COMPLETENESS}' AS completeness, ni AS n_included, nc AS n_category_excluded, nr AS n_replay_excluded, i_dig AS included_digest, c_dig AS category_exclusion_digest, r_dig AS replay_exclusion_digest
      FROM fold, summary""")
    put("write_snapshot", PAIRED, f"SELECT capture_id, asset, sha256({RECORD_JSON}) AS record_digest FROM p WHERE {inc}")
    put("compare_snapshots", PAIRED, f""", b AS (SELECT capture_id FROM p WHERE {inc}),
      a AS (SELECT capture_id FROM p WHERE category = 'accepted' AND evidence_at <= cutoff + {DAY} AND authority_at <= cutoff + {DAY} AND capture_id NOT LIKE '%55')
      SELECT coalesce(a.capture_id, b.capture_id) AS capture_id, CASE WHEN b.capture_id IS NULL THEN 'added' WHEN a.capture_id IS NULL THEN 'removed' ELSE 'changed' END AS change
      FROM a FULL JOIN b ON a.capture_id = b.capture_id WHERE a.capture_id IS NULL OR b.capture_id IS NULL OR a.capture_id LIKE '%7'""")
    return q
