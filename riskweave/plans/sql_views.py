"""The same frames as common table expressions for the SQL the queries are checked against."""

from __future__ import annotations

from riskweave.config import Controls
from riskweave.functions.bands import AMOUNT_BANDS
from riskweave.operators.marts import KEYS
from riskweave.plans.views import CONTROLS, DAY_CONTROLS, MODEL_THRESHOLD, REVIEW_STEPS
from riskweave.sources.adapters import PATTERNS, RISK_COUNTRIES


def _choice(key: str, names) -> str:
    return "(CASE " + " ".join(f"WHEN {key} % {len(names)} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END)"


def _normal(name: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({name}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
    )


def folded(text: str) -> str:
    """A name with accents, folded: decomposed, other non-ASCII characters dropped, normalised."""
    return _normal(f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')")


def _countries() -> str:
    return ", ".join(f"'{c}'" for c in RISK_COUNTRIES)


def _rule_flags(controls: Controls) -> str:
    return ", ".join(f"({r.feature} >= {r.threshold}) AS {r.rule_id}" for r in controls.rules)


def _rule_score(controls: Controls) -> str:
    return "least(100, " + " + ".join(f"CASE WHEN {r.rule_id} THEN {r.score} ELSE 0 END" for r in controls.rules) + ")"


def _rule_reasons(controls: Controls) -> str:
    # concat_ws skips nulls
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {r.rule_id} THEN '{r.rule_name}' END" for r in controls.rules) + ")"


def _text(value) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


def amount_band(column: str) -> str:
    lows = [low for low, _ in AMOUNT_BANDS]
    whens = [
        f"WHEN {column} >= {low}" + (f" AND {column} < {high}" if high else "") + f" THEN '{label}'"
        for (low, label), high in zip(AMOUNT_BANDS, lows[1:] + [None], strict=True)
    ]
    return "(CASE " + " ".join(whens) + " END)"


MICROS = "%Y-%m-%d %H:%M:%S.%f"

_HISTORY = """
  SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY sec
                           RANGE BETWEEN {velocity} PRECEDING AND 1 PRECEDING) AS velocity_1h,
         coalesce(sum(CASE WHEN amount >= 9500 AND amount < 10000 THEN 1 ELSE 0 END)
           OVER (PARTITION BY customer_id ORDER BY sec
                 RANGE BETWEEN {adjacent} PRECEDING AND 1 PRECEDING), 0)::BIGINT AS adjacent_prior_24h,
         CASE WHEN row_number() OVER (PARTITION BY customer_id, counterparty_id
                                      ORDER BY timestamp, transaction_id) = 1
              THEN 1 ELSE 0 END AS new_counterparty
  FROM (SELECT *, floor(epoch(timestamp))::BIGINT AS sec FROM payments) timed
"""

_RULED = """
  SELECT *, {score} AS risk_score, {reasons} AS rule_reasons, {score} >= 40 AS rule_review
  FROM (SELECT *, {flags} FROM {source}) flagged
"""

_FEATURED = """
  SELECT h.*, amount / c.expected_amount AS amount_ratio, c.account_age_days, c.pep_flag, c.kyc_status,
         c.expected_amount, p.counterparty_name, p.synthetic_sanctions_flag::INT AS screening_truth,
         s.matched_entity, s.matched_entity_id, s.name_similarity_score, s.alias_match, s.country_match,
         s.screening_score, s.recommendation, s.reason_codes,
         (h.destination_country IN ({countries}))::INT AS high_risk_geo,
         (hour(h.timestamp) < 5)::INT AS night,
         (h.new_counterparty = 1 AND h.amount / c.expected_amount >= 2)::INT AS new_counterparty_high_value
  FROM {history} h JOIN customers c USING (customer_id)
  JOIN counterparties p USING (counterparty_id) JOIN screened s USING (counterparty_id)
"""

# name -> (the expressions it reads, its text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": ((), f"""
  SELECT c_custkey AS customer_id, 'SYN-ACCOUNT-' || lpad(c_custkey::VARCHAR, 9, '0') AS account_id,
         (10 + c_custkey * 37 % 2990)::INT AS account_age_days,
         {_choice('c_custkey', ('PERSON', 'BUSINESS'))} AS customer_type, n_name AS residence_country,
         c_mktsegment AS industry, {_choice('c_custkey', ('LOW', 'MEDIUM', 'HIGH'))} AS risk_segment,
         CASE WHEN c_custkey % 25 = 0 THEN 'PENDING' ELSE 'COMPLETE' END AS kyc_status,
         c_custkey % 50 = 0 AS pep_flag, (10 + c_custkey % 90)::INT AS expected_monthly_volume,
         500 + abs(c_acctbal) / 4 AS expected_amount,
         (500 + abs(c_acctbal) / 4) * 0.2::DOUBLE AS expected_min,
         (500 + abs(c_acctbal) / 4) * 3 AS expected_max
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "watchlist": ((), """
  SELECT n_nationkey::BIGINT AS entity_id,
         CASE WHEN n_nationkey % 2 = 0 THEN upper(p_name || ' ' || p_type)
              ELSE substr(p_name, 1, 1) || substr(p_name, 3) || ' ' || p_type END AS canonical_name,
         CASE WHEN n_nationkey % 7 = 3 THEN ''
              WHEN n_nationkey % 5 = 0 THEN p_brand || ' ' || p_name || ' | ' || p_name || ' ' || p_brand
              ELSE p_brand || ' ' || p_name END AS aliases,
         n_name AS country, CASE WHEN n_nationkey % 6 = 5 THEN 'PERSON' ELSE 'BUSINESS' END AS entity_type,
         n_nationkey % 10 <> 9 AS active
  FROM nation JOIN part ON p_partkey = n_nationkey"""),
    "truth_names": ((), """
  SELECT DISTINCT unnest([p_name || ' ' || p_type, p_brand || ' ' || p_name]) AS listed_name
  FROM nation JOIN part ON p_partkey = n_nationkey WHERE n_nationkey % 10 <> 9"""),
    "counterparties": (("truth_names",), """
  SELECT *, counterparty_name IN (SELECT listed_name FROM truth_names) AS synthetic_sanctions_flag
  FROM (SELECT p_partkey AS counterparty_id,
               CASE WHEN p_partkey % 4 = 3 THEN p_brand || ' ' || p_name ELSE p_name || ' ' || p_type END
                 AS counterparty_name,
               '' AS aliases,
               CASE WHEN p_partkey % 2 = 0 THEN 'NATION_' || (p_partkey % 25) ELSE 'NATION_0' END AS country,
               'BUSINESS' AS counterparty_type,
               CASE WHEN p_size > 40 THEN 'MEDIUM' ELSE 'LOW' END AS baseline_risk
        FROM part) named"""),
    "all_payments": ((), f"""
  SELECT 'TX-' || lpad(event_id::VARCHAR, 9, '0') AS transaction_id, user_id AS customer_id,
         (user_id * 31 + event_id % 7) % (SELECT count(*) FROM part) AS counterparty_id, ts AS timestamp,
         round(value * 100, 2) + 0.0::DOUBLE AS amount, 'GBP' AS currency, n_name AS origin_country,
         'NATION_' || (event_id % 25) AS destination_country, event_type AS payment_channel,
         {_choice('event_id', ('TRANSFER', 'CARD', 'WIRE'))} AS payment_type,
         {_choice('(event_id // 3)', ('RETAIL', 'SERVICES', 'REMITTANCE'))} AS payment_category,
         'DEV-' || (user_id % 97) AS device_id, 'BANK-' || (user_id % 5) AS originating_bank,
         'NET-' || (event_id % 2) AS network, 'BANK-' || (event_id % 6) AS beneficiary_bank,
         CASE WHEN event_id % 20 = 0 THEN 'FAILED' WHEN event_id % 20 <= 2 THEN 'PENDING' ELSE 'SETTLED' END
           AS status,
         CASE WHEN k < 70 THEN 'NORMAL' ELSE {_choice('k', PATTERNS)} END AS injected_pattern,
         CASE WHEN k >= 95 OR (k >= 70 AND round(value * 100, 2) >= 2000) THEN 1 ELSE 0 END
           AS investigation_label,
         event_id
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events) e
  JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "payments": (("all_payments",), "SELECT * FROM all_payments WHERE amount > 0"),
    "listed": (("watchlist",), f"""
  SELECT entity_id, canonical_name, country, entity_type, names[position] AS listed_name,
         position > 1 AS alias_match, position, {_normal('names[position]')} AS normal
  FROM (SELECT *, unnest(generate_series(1, len(names))) AS position
        FROM (SELECT *, [canonical_name] || list_filter(list_transform(string_split(aliases, '|'),
                       lambda s: trim(s)), lambda s: s <> '') AS names
              FROM watchlist WHERE active) named) positioned"""),
    "requested": (("counterparties",), f"""
  SELECT *, {_normal('counterparty_name')} AS normal FROM counterparties"""),
    "symbol_masks": (("requested",), """
  SELECT a, symbol, sum(1::BIGINT << (i - 1))::BIGINT AS mask
  FROM (SELECT a, i, a[i] AS symbol
        FROM (SELECT normal AS a, unnest(generate_series(1, length(normal))) AS i
              FROM (SELECT DISTINCT normal FROM requested) d) spread) symbols
  GROUP BY a, symbol"""),
    "walk": (("requested", "listed", "symbol_masks"), """
  SELECT a, b, 1 AS j, (1::BIGINT << length(a)) - 1 AS free
  FROM (SELECT DISTINCT normal AS a FROM requested) x, (SELECT DISTINCT normal AS b FROM listed) y
  UNION ALL
  SELECT w.a, w.b, j + 1,
         ((free + (free & coalesce(mask, 0))) | (free - (free & coalesce(mask, 0)))) & ((1::BIGINT << length(w.a)) - 1)
  FROM walk w LEFT JOIN symbol_masks m ON m.a = w.a AND m.symbol = w.b[w.j]
  WHERE j <= length(w.b)"""),
    "lcs": (("walk",), """
  SELECT a, b, length(a) - bit_count(free) AS lcs FROM walk WHERE j = length(b) + 1"""),
    "verdicts": (("lcs", "requested", "listed"), """
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY normal, country ORDER BY score DESC, entity_id, position) AS place
    FROM (SELECT *, 0.9::DOUBLE * similarity + 5 * country_match::INT + 5 * type_match::INT AS score
          FROM (SELECT r.normal, r.country, l.canonical_name AS matched_entity, l.entity_id, l.position,
                       l.alias_match, r.country = l.country AS country_match,
                       l.entity_type = 'BUSINESS' AS type_match,
                       100.0::DOUBLE * (1.0::DOUBLE - (length(a) + length(b) - 2 * lcs)::DOUBLE / (length(a) + length(b)))
                         AS similarity
                FROM (SELECT DISTINCT normal, country FROM requested) r
                JOIN lcs ON lcs.a = r.normal JOIN listed l ON l.normal = lcs.b) pairs) scored) ranked
  WHERE place = 1"""),
    "screened": (("verdicts", "requested"), """
  SELECT r.counterparty_id, r.counterparty_name AS counterparty, v.matched_entity, v.entity_id AS matched_entity_id,
         round(v.similarity, 3) AS name_similarity_score, v.alias_match, v.country_match,
         round(v.score, 3) AS screening_score, 88.0::DOUBLE AS screening_threshold,
         CASE WHEN v.score >= 88 THEN 'REVIEW' ELSE 'CLEAR' END AS recommendation,
         CASE WHEN v.alias_match THEN 'ALIAS_MATCH' WHEN v.similarity = 100 THEN 'EXACT_NAME' ELSE 'FUZZY_NAME' END
           || CASE WHEN v.country_match THEN '' ELSE '|COUNTRY_MISMATCH' END AS reason_codes
  FROM requested r JOIN verdicts v ON v.normal = r.normal AND v.country = r.country"""),
    "history": (("payments",), _HISTORY.format(velocity=3600, adjacent=86400)),
    "day_history": (("payments",), _HISTORY.format(velocity=86400, adjacent=86400)),
    "featured": (
        ("history", "customers", "counterparties", "screened"),
        _FEATURED.format(history="history", countries=_countries()),
    ),
    "day_featured": (
        ("day_history", "customers", "counterparties", "screened"),
        _FEATURED.format(history="day_history", countries=_countries()),
    ),
    "ruled": (("featured",), _RULED.format(
        score=_rule_score(CONTROLS), reasons=_rule_reasons(CONTROLS), flags=_rule_flags(CONTROLS),
        source="featured")),
    "day_ruled": (("day_featured",), _RULED.format(
        score=_rule_score(DAY_CONTROLS), reasons=_rule_reasons(DAY_CONTROLS), flags=_rule_flags(DAY_CONTROLS),
        source="day_featured")),
    "scored": (("ruled",), f"""
  SELECT *, model_probability >= {MODEL_THRESHOLD} AS model_review,
         rule_review OR model_probability >= {MODEL_THRESHOLD} OR recommendation = 'REVIEW' AS alert_flag
  FROM (SELECT *, amount_ratio / (amount_ratio + 10) AS model_probability FROM ruled) r"""),
    "alerts": (("scored",), """
  SELECT 'ALERT-' || transaction_id AS alert_id, transaction_id, customer_id, counterparty_id,
         CASE WHEN recommendation = 'REVIEW' THEN 'SCREENING' ELSE 'PAYMENT_RISK' END AS alert_type,
         risk_score::DOUBLE AS risk_score, rule_reasons AS rules_triggered,
         'synthetic-risk-1.0' AS model_version, 'synthetic-screen-1.0' AS screening_version,
         timestamp AS created_at, 'OPEN' AS status, amount_ratio, screening_score, velocity_1h, event_id
  FROM scored WHERE alert_flag"""),
    "review_steps": ((), "SELECT * FROM (VALUES "
        + ", ".join("(" + ", ".join(map(_text, s)) + ")" for s in REVIEW_STEPS)
        + ") t(pattern, step, status, actor, notes, disposition, reason_code)"),
    "actions": (("alerts", "review_steps"), """
  SELECT event_id * 10 + step AS action_id, alert_id, s.status, actor, notes, disposition, reason_code,
         created_at + step * INTERVAL 1 HOUR AS acted_at,
         row_number() OVER (PARTITION BY alert_id ORDER BY event_id * 10 + step) AS place,
         CASE WHEN trim(actor) = '' OR trim(notes) = '' THEN 'ACTOR_AND_NOTES_REQUIRED' END AS before_problem,
         CASE WHEN s.status = 'CLOSED' AND (disposition IS NULL OR disposition NOT IN
                   ('FALSE_POSITIVE', 'FURTHER_REVIEW', 'CLEARED') OR coalesce(reason_code, '') = '')
              THEN 'CLOSE_NEEDS_DISPOSITION_AND_REASON'
              WHEN s.status <> 'CLOSED' AND disposition IS NOT NULL THEN 'DISPOSITION_ONLY_ON_CLOSE' END
           AS after_problem
  FROM alerts a JOIN review_steps s ON s.pattern = a.event_id % 6"""),
    "fold": (("alerts", "actions"), """
  SELECT alert_id, 0::BIGINT AS place, 'OPEN' AS current, NULL::BIGINT AS action_id, NULL::VARCHAR AS problem,
         NULL::BIGINT AS last_action, NULL::BIGINT AS previous_action
  FROM alerts
  UNION ALL
  SELECT alert_id, place, CASE WHEN problem IS NULL THEN status ELSE current END, action_id, problem,
         CASE WHEN problem IS NULL THEN action_id ELSE last_action END, last_action
  FROM (SELECT f.alert_id, a.place, f.current, a.status, a.action_id, f.last_action,
               coalesce(before_problem,
                 CASE WHEN NOT ((f.current = 'OPEN' AND a.status = 'IN_REVIEW')
                             OR (f.current = 'IN_REVIEW' AND a.status IN ('ESCALATED', 'CLOSED'))
                             OR (f.current = 'ESCALATED' AND a.status IN ('IN_REVIEW', 'CLOSED')))
                      THEN 'INVALID_TRANSITION' END, after_problem) AS problem
        FROM fold f JOIN actions a ON a.alert_id = f.alert_id AND a.place = f.place + 1) step"""),
    "cases": (("alerts", "fold", "actions"), """
  SELECT al.* EXCLUDE (status), coalesce(ac.status, 'OPEN') AS status, coalesce(ac.notes, '') AS investigator_notes,
         ac.disposition, ac.reason_code, ac.acted_at AS reviewed_at
  FROM alerts al
  JOIN (SELECT alert_id, max(last_action) AS last_action FROM fold GROUP BY alert_id) f USING (alert_id)
  LEFT JOIN actions ac ON ac.action_id = f.last_action"""),
    "dim_geography": (("payments",), f"""
  SELECT row_number() OVER (ORDER BY country_code) AS geography_key, country_code,
         country_code IN ({_countries()}) AS fictional_high_risk
  FROM (SELECT origin_country AS country_code FROM payments UNION SELECT destination_country FROM payments) c"""),
    "dim_payment_channel": (("payments",), """
  SELECT row_number() OVER (ORDER BY payment_channel) AS channel_key, payment_channel
  FROM (SELECT DISTINCT payment_channel FROM payments) c"""),
    "dim_date": (("payments",), """
  SELECT DISTINCT strftime(timestamp, '%Y%m%d')::INT AS date_key, timestamp::DATE AS calendar_date,
         year(timestamp) AS year, month(timestamp) AS month, day(timestamp) AS day
  FROM payments"""),
    "dim_risk_category": ((), "SELECT * FROM (VALUES (1, 'LOW'), (2, 'MEDIUM'), (3, 'HIGH')) t(risk_key, risk_category)"),
    "fact": (("scored", "dim_geography", "dim_payment_channel"), """
  SELECT s.*, customer_id + 1 AS customer_key, counterparty_id + 1 AS counterparty_key,
         strftime(timestamp, '%Y%m%d')::INT AS date_key, o.geography_key AS origin_geography_key,
         d.geography_key AS destination_geography_key, channel_key,
         CASE WHEN risk_score <= 39 THEN 1 WHEN risk_score <= 69 THEN 2 ELSE 3 END AS risk_key,
         hour(timestamp) AS hour_utc, (recommendation = 'REVIEW')::INT AS screening_review,
         least(floor(screening_score / 10) * 10, 90)::INT AS screening_score_band,
         """ + amount_band("amount") + """ AS amount_band
  FROM scored s JOIN dim_geography o ON o.country_code = s.origin_country
  JOIN dim_geography d ON d.country_code = s.destination_country
  JOIN dim_payment_channel USING (payment_channel)"""),
    "alerts_mart": (("cases", "fact"), """
  SELECT c.* EXCLUDE (disposition), coalesce(c.disposition, 'NOT_REVIEWED') AS disposition,
         """ + ", ".join(f"f.{k}" for k in KEYS) + """,
         epoch_us((SELECT max(timestamp) FROM payments)) AS cutoff_us,
         (epoch_us((SELECT max(timestamp) FROM payments)) - epoch_us(c.created_at)) / 86400000000.0::DOUBLE
           AS age_at_data_cutoff_days
  FROM cases c JOIN fact f USING (transaction_id)"""),
    "bridge": (("alerts_mart",), """
  SELECT alert_id, rule_name, """ + ", ".join(KEYS) + """
  FROM (SELECT *, unnest(string_split(rules_triggered, '|')) AS rule_name FROM alerts_mart) u
  WHERE rule_name <> ''"""),
    "dim_counterparty_rich": (("counterparties", "screened"), """
  SELECT counterparty_id + 1 AS counterparty_key, c.*, s.* EXCLUDE (counterparty_id, counterparty),
         CASE WHEN s.alias_match THEN 'Alias' WHEN s.name_similarity_score = 100 THEN 'Exact'
              ELSE 'Fuzzy candidate' END AS match_method
  FROM counterparties c JOIN screened s USING (counterparty_id)"""),
    "split_times": (("payments",), """
  SELECT max(CASE WHEN place = floor(n * 0.6::DOUBLE) THEN micros END) AS t_a,
         max(CASE WHEN place = floor(n * 0.8::DOUBLE) THEN micros END) AS t_b
  FROM (SELECT epoch_us(timestamp) AS micros, row_number() OVER (ORDER BY timestamp) - 1 AS place,
               count(*) OVER () AS n FROM payments) t"""),
}


def with_ctes(select: str, *names: str) -> str:
    """SQL text with the named expressions, and all they read, in front."""
    order: list[str] = []

    def visit(name: str):
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS {'' if n in ('walk', 'fold') else 'MATERIALIZED '}({CTES[n][1]})" for n in order]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select.strip() if parts else select.strip()
