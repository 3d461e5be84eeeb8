"""DuckDB SQL of the feeds, the layers and the quality queries, over the same driver tables.

Only the feed rules and the fixed label lists are shared with the Spark side; every
operator is written again here. Common table expressions are assembled on demand.
"""

from __future__ import annotations

from ledgerloom import specs
from ledgerloom.sources import feeds
from ledgerloom.specs import ENTITIES

ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[str, list[str]]] = {}
PIPE = f"'{specs.DEFAULT_PIPELINE}'"


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, list(needs))


def oracle(name: str, sql: str, *needs: str) -> None:
    """Register a query with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for m in CTES[n][1]:
                visit(m)
            order.append(n)

    for need in needs:
        visit(need)
    # Materialised, so that each is computed once however often it is read.
    parts = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n][0]}\n)" for n in order)
    ORACLES[name] = f"WITH {parts}\n{sql}" if parts else sql


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values_list(values: list[str]) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


# --- cell functions ---------------------------------------------------------------

def clean(x: str) -> str:
    return f"nullif(trim(cast({x} as varchar), ' '), '')"


def token(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g')"


def relabel(x: str, labels: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in labels.items())
    return f"CASE {x} {arms} ELSE {quote(default)} END"


def label(x: str, labels: dict[str, str], default: str = specs.UNKNOWN) -> str:
    return relabel(token(x), labels, default)


def age(x: str) -> str:
    return relabel(f"regexp_replace(lower({x}), '[^a-z0-9+]+', '', 'g')", specs.AGE_MAP, specs.UNKNOWN)


def date_of(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') AND substr({x}, 1, 4) <> '0000' "
            f"THEN try_strptime(substr({x}, 1, 10), '%Y-%m-%d') END")


def boolean(x: str) -> str:
    return (f"CASE WHEN lower({x}) IN {values_list(specs.TRUE_TOKENS)} THEN true "
            f"WHEN lower({x}) IN {values_list(specs.FALSE_TOKENS)} THEN false END")


def big(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^\\d+$') THEN try_cast({x} AS BIGINT) END"


def whole(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^-?\\d+$') THEN try_cast({x} AS INTEGER) END"


NUMERIC = "'^-?\\d+(\\.\\d+)?$'"


def dec(x: str, p: int = 12, s: int = 2) -> str:
    return f"CASE WHEN regexp_matches({x}, {NUMERIC}) THEN try_cast({x} AS DECIMAL({p},{s})) END"


def cased(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)'), "
            "lambda w: upper(w[1]) || w[2:]), '')")


def phone_bad(x: str) -> str:
    return f"({x} IS NOT NULL AND (starts_with({x}, '-') OR regexp_replace({x}, '[^0-9]', '', 'g') = ''))"


def unless(x: str, good: str) -> str:
    return f"CASE WHEN {good} THEN {x} END"


def range_bad(a: str, b: str) -> str:
    return f"({a} IS NULL OR {b} IS NULL OR {b} < {a})"


def signature(columns: list[str]) -> str:
    return f"md5(concat_ws('|', {', '.join(columns)}))"


def exact(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,10))"


def bad_number(x: str, wrong: str, pattern: str = NUMERIC) -> str:
    return f"({x} IS NULL OR CASE WHEN regexp_matches({x}, {pattern}) THEN {wrong} ELSE true END)"


def record_hash(entity: str) -> str:
    columns = ", ".join(ENTITIES[entity].csv_columns)
    return f"sha256(concat_ws(chr(31), '{entity}', {columns}))"


# --- feeds and raw layer -----------------------------------------------------------------

def feed_sql(entity: str, changes: list[feeds.Change], dirty: bool) -> str:
    rule, spec = feeds.FEEDS[entity], ENTITIES[entity]
    rows = ", ".join(
        f"({i}, '{c.logical_date}', '{c.operation.upper()}', {c.bump}, '{c.business_date or c.logical_date}', '{c.time_zone}')"
        for i, c in enumerate(changes)
    )
    keys = " ".join(f"WHEN {i} THEN {c.key_text}" for i, c in enumerate(changes))
    picked = " ".join(f"WHEN {i} THEN {c.when}" for i, c in enumerate(changes))
    columns = dict(rule.columns)
    if dirty and entity == "order_items":
        columns["product_id"] = f"CASE WHEN k % 163 = 12 THEN '' ELSE {columns['product_id']} END"
    carried = ", ".join([f"{rule.key} AS k", *[f"{src} AS {name}" for name, src in rule.carried.items()]])
    texts = ",\n  ".join(f"{columns[c]} AS {c}" for c in spec.columns if c != spec.key)
    return f"""SELECT CASE n {keys} END AS {spec.key},
  {texts},
  op AS operation, day || 'T' || {feeds.clock('k')} || zone AS source_updated_at, business AS business_date,
  cast(2 + k * {len(changes)} + n as bigint) AS source_row_number, cast(day as date) AS logical_date
FROM (SELECT {carried} FROM {rule.source}) src
CROSS JOIN (VALUES {rows}) change(n, day, op, bump, business, zone)
WHERE CASE n {picked} END"""


for _e, _s in ENTITIES.items():
    cte(f"feed_{_e}", feed_sql(_e, feeds.CHANGES, False))
    cte(f"dirty_{_e}", feed_sql(_e, feeds.DIRTY_CHANGES, True))
    _text = ", ".join(f"nullif({c}, '') AS {c}" for c in _s.columns)
    cte(f"bronze_{_e}", f"""SELECT {_text}, {PIPE} || ':' || strftime(logical_date, '%Y-%m-%d') AS batch_id, logical_date,
  strptime(source_updated_at, '%Y-%m-%dT%H:%M:%SZ') AS source_updated_at,
  logical_date::TIMESTAMP + INTERVAL 26 HOUR AS ingested_at, operation, business_date::DATE AS business_date,
  source_row_number, {record_hash(_e)} AS source_record_hash
FROM feed_{_e}""", f"feed_{_e}")


def newest(source: str, key: str, where: str = "true") -> str:
    return f"""SELECT * EXCLUDE (rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY source_updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST,
    batch_id DESC NULLS LAST, source_record_hash DESC NULLS LAST) AS rank
  FROM {source} WHERE {where})
WHERE rank = 1 AND coalesce(operation, 'I') <> 'D'"""


for _e, _s in ENTITIES.items():
    cte(f"current_{_e}", newest(f"bronze_{_e}", _s.key), f"bronze_{_e}")
    _clean = ", ".join(f"{clean(c)} AS {c}" for c in _s.columns)
    cte(f"text_{_e}", f"SELECT {_s.key} AS raw_key, {_clean} FROM current_{_e}", f"current_{_e}")


def sig(entity: str, prefix: str = "") -> str:
    spec = ENTITIES[entity]
    return signature([prefix + c for c in spec.columns if c != spec.key])


def best(source: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (sig, pos) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pos "
            f"FROM ({source})) WHERE pos = 1")


# --- clean layer -------------------------------------------------------------------------------

_c = "customers"
cte("silver_customers", best(f"""SELECT {big('customer_id')} AS customer_id, {cased('first_name')} AS first_name,
  {cased('last_name')} AS last_name, lower(email) AS email, phone_number,
  {date_of('registration_date')} AS registration_date,
  {label('customer_segment', specs.SEGMENT_MAP)} AS customer_segment,
  {label('preferred_channel', specs.CHANNEL_MAP)} AS preferred_channel, {age('age_group')} AS age_group,
  {label('income_level', specs.INCOME_MAP)} AS income_level, {dec('avg_order_value')} AS avg_order_value,
  {dec('promo_sensitivity', 6, 3)} AS promo_sensitivity, {boolean('email_opt_in')} AS email_opt_in,
  {boolean('sms_opt_in')} AS sms_opt_in, {boolean('push_opt_in')} AS push_opt_in,
  {date_of('last_purchase_date')} AS last_purchase_date, {whole('total_lifetime_orders')} AS total_lifetime_orders,
  {label('preferred_category', specs.CATEGORY_MAP)} AS preferred_category,
  {phone_bad('phone_number')} AS invalid_phone_flag, t.last_purchase_date IS NULL AS missing_last_purchase_flag,
  (t.registration_date IS NOT NULL AND {date_of('t.registration_date')} IS NULL) AS invalid_registration_date_flag,
  {sig(_c, 't.')} AS sig
FROM text_customers t WHERE {big('t.customer_id')} IS NOT NULL""",
    "customer_id", "registration_date DESC NULLS LAST, sig DESC"), "text_customers")

cte("typed_promotions", f"""SELECT {big('promotion_id')} AS promotion_id, campaign_name,
  {label('promo_type', specs.PROMO_TYPE_MAP)} AS promo_type, {dec('discount_value')} AS discount,
  {dec('min_order_value')} AS min_value, {date_of('t.start_date')} AS start_date, {date_of('t.end_date')} AS end_date,
  {whole('campaign_duration_days')} AS days, {label('target_segment', specs.TARGET_SEGMENT_MAP)} AS target_segment,
  {label('campaign_channel', specs.CAMPAIGN_CHANNEL_MAP)} AS campaign_channel,
  {label('campaign_objective', specs.CAMPAIGN_OBJECTIVE_MAP)} AS campaign_objective,
  {label('target_category', specs.CATEGORY_MAP)} AS target_category,
  {dec('expected_response_rate', 8, 4)} AS rate, {dec('budget_allocated', 14, 2)} AS budget,
  {dec('cost_per_acquisition')} AS cpa, {sig('promotions', 't.')} AS sig
FROM text_promotions t""", "text_promotions")
cte("silver_promotions", best(f"""SELECT promotion_id, campaign_name, promo_type,
  {unless('discount', 'discount >= 0')} AS discount_value, {unless('min_value', 'min_value >= 0')} AS min_order_value,
  start_date, end_date, {unless('days', 'days >= 0')} AS campaign_duration_days, target_segment, campaign_channel,
  campaign_objective, target_category, {unless('rate', 'rate BETWEEN 0 AND 1')} AS expected_response_rate,
  {unless('budget', 'budget >= 0')} AS budget_allocated, {unless('cpa', 'cpa >= 0')} AS cost_per_acquisition,
  {range_bad('start_date', 'end_date')} AS invalid_date_range_flag, coalesce(discount < 0, true) AS negative_discount_flag,
  coalesce(rate NOT BETWEEN 0 AND 1, true) AS invalid_expected_response_rate_flag,
  coalesce(budget < 0, true) OR coalesce(cpa < 0, true) AS invalid_budget_flag,
  NOT {range_bad('start_date', 'end_date')} AS is_valid_date_range, sig
FROM typed_promotions WHERE promotion_id IS NOT NULL""",
    "promotion_id", "start_date DESC NULLS LAST, sig DESC"), "typed_promotions")

cte("typed_orders", f"""SELECT raw_key, {big('order_id')} AS order_id, {big('customer_id')} AS customer_id,
  {date_of('order_date')} AS placed, {label('order_status', specs.STATUS_MAP, specs.UNKNOWN_STATUS)} AS order_status,
  {big('promotion_id')} AS promo, promotion_id AS promo_text, {label('order_channel', specs.CHANNEL_MAP)} AS order_channel,
  {dec('order_value')} AS amount, coalesce({boolean('attributed_to_promo')}, false) AS attributed,
  {label('customer_segment_at_time', specs.SEGMENT_MAP)} AS customer_segment_at_time, {sig('orders', 't.')} AS sig
FROM (SELECT * FROM text_orders) t""", "text_orders")
cte("silver_orders", best(f"""SELECT o.order_id, o.customer_id, placed AS order_date, order_status,
  {unless('o.promo', 'p.promotion_id IS NOT NULL')} AS promotion_id, order_channel,
  {unless('amount', 'amount >= 0')} AS order_value, attributed AS attributed_to_promo, customer_segment_at_time,
  promo_text IS NULL AS missing_promotion_flag,
  attributed AND promo_text IS NULL AS promo_attributed_without_promotion_id_flag,
  coalesce(amount < 0, true) AS invalid_order_value_flag,
  promo_text IS NOT NULL AND p.promotion_id IS NULL AS invalid_promotion_reference_flag, sig
FROM typed_orders o SEMI JOIN silver_customers c ON o.customer_id = c.customer_id
LEFT JOIN silver_promotions p ON o.promo = p.promotion_id WHERE o.order_id IS NOT NULL""",
    "order_id", "order_date DESC NULLS LAST, sig DESC"), "typed_orders", "silver_customers", "silver_promotions")

cte("typed_items", f"""SELECT {big('order_item_id')} AS order_item_id, {big('order_id')} AS order_id,
  {big('product_id')} AS product_id, {label('product_category', specs.CATEGORY_MAP)} AS product_category,
  {whole('quantity')} AS qty, {dec('unit_price')} AS price, {big('promotion_id')} AS promo, promotion_id AS promo_text,
  coalesce({boolean('attributed_to_promo')}, false) AS attributed, {sig('order_items', 't.')} AS sig
FROM text_order_items t""", "text_order_items")
cte("silver_order_items", best(f"""SELECT i.order_item_id, i.order_id, i.product_id, product_category,
  {unless('qty', 'qty > 0')} AS quantity, {unless('price', 'price >= 0')} AS unit_price,
  CAST({unless('qty', 'qty > 0')} * {unless('price', 'price >= 0')} AS DECIMAL(23,2)) AS item_revenue,
  CAST({unless('qty', 'qty > 0')} * {unless('price', 'price >= 0')} AS DECIMAL(23,2)) AS line_total,
  {unless('promo', 'p.promotion_id IS NOT NULL')} AS promotion_id, attributed AS attributed_to_promo,
  coalesce(qty <= 0, true) AS invalid_quantity_flag, coalesce(price < 0, true) AS invalid_unit_price_flag,
  attributed AND promo_text IS NULL AS promo_attributed_without_promotion_id_flag,
  promo_text IS NOT NULL AND p.promotion_id IS NULL AS invalid_promotion_reference_flag, sig
FROM typed_items i SEMI JOIN silver_orders o ON i.order_id = o.order_id
LEFT JOIN silver_promotions p ON i.promo = p.promotion_id WHERE i.order_item_id IS NOT NULL""",
    "order_item_id", "sig DESC"), "typed_items", "silver_orders", "silver_promotions")

for _e in ENTITIES:
    oracle(f"silver_{_e}", f"SELECT * FROM silver_{_e}", f"silver_{_e}")

# --- star schema ------------------------------------------------------------------------------------

cte("dim_customer", """SELECT customer_id AS customer_key, customer_id, first_name, last_name, email, phone_number,
  registration_date, customer_segment, preferred_channel, age_group, income_level,
  avg_order_value AS source_avg_order_value, promo_sensitivity, email_opt_in, sms_opt_in, push_opt_in,
  last_purchase_date, total_lifetime_orders AS source_lifetime_orders, preferred_category
FROM silver_customers UNION ALL
SELECT -1, -1, 'Unknown', NULL, NULL, NULL, NULL, 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, 'Unknown'""", "silver_customers")
cte("dim_promotion", """SELECT promotion_id AS promotion_key, promotion_id, campaign_name, promo_type, discount_value,
  min_order_value, start_date, end_date, campaign_duration_days, target_segment, campaign_channel, campaign_objective,
  target_category, expected_response_rate, budget_allocated, cost_per_acquisition
FROM silver_promotions UNION ALL
SELECT -1, -1, 'Unknown', 'Unknown', NULL, NULL, NULL, NULL, NULL, 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, NULL""",
    "silver_promotions")
cte("dim_product", """SELECT ('0x' || substr(md5(product_id::VARCHAR || '|' || category), 1, 15))::BIGINT AS product_key,
  product_id, category AS product_category
FROM (SELECT DISTINCT product_id, coalesce(product_category, 'Unknown') AS category FROM silver_order_items
  WHERE product_id IS NOT NULL) UNION ALL SELECT -1, -1, 'Unknown'""", "silver_order_items")
cte("dim_date", """SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d AS full_date, year(d)::INTEGER AS year,
  quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, strftime(d, '%B') AS month_name, day(d)::INTEGER AS day,
  isodow(d)::INTEGER AS day_of_week, strftime(d, '%A') AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))::DATE AS d FROM silver_orders)
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, 'Unknown', NULL""", "silver_orders")
cte("fact_orders", """SELECT o.order_id, coalesce(c.customer_key, -1) AS customer_key,
  coalesce(p.promotion_key, -1) AS promotion_key,
  coalesce(strftime(o.order_date, '%Y%m%d')::INTEGER, -1) AS order_date_key, o.order_date, o.order_status,
  coalesce(o.order_channel, 'Unknown') AS order_channel, o.order_value, o.attributed_to_promo,
  coalesce(o.customer_segment_at_time, 'Unknown') AS customer_segment_at_time
FROM silver_orders o LEFT JOIN dim_customer c USING (customer_id) LEFT JOIN dim_promotion p USING (promotion_id)""",
    "silver_orders", "dim_customer", "dim_promotion")
cte("fact_order_items", """SELECT i.order_item_id, i.order_id, coalesce(d.product_key, -1) AS product_key,
  coalesce(p.promotion_key, -1) AS promotion_key, i.quantity, i.unit_price, i.line_total, i.attributed_to_promo
FROM silver_order_items i SEMI JOIN fact_orders f ON i.order_id = f.order_id
LEFT JOIN dim_product d ON d.product_id = i.product_id AND d.product_category = coalesce(i.product_category, 'Unknown')
LEFT JOIN dim_promotion p ON p.promotion_id = i.promotion_id
WHERE i.quantity > 0 AND i.unit_price > 0""", "silver_order_items", "fact_orders", "dim_product", "dim_promotion")
for _t in ("dim_customer", "dim_promotion", "dim_product", "dim_date", "fact_orders", "fact_order_items"):
    oracle(_t, f"SELECT * FROM {_t}", _t)

# --- quality ----------------------------------------------------------------------------------------

SEVERITY_CHECKS: list[tuple[str, str, str, str]] = []


def check(issue: str, entity: str, severity: str, count_sql: str) -> None:
    SEVERITY_CHECKS.append((issue, f"{entity}_raw", severity, count_sql))


for _e, _s in ENTITIES.items():
    check("duplicate_primary_key", _e, "high",
          f"SELECT count({_s.key}) - count(DISTINCT {_s.key}) FROM text_{_e}")


def rows_where(entity: str, condition: str) -> str:
    return f"SELECT count(*) FROM text_{entity} WHERE {condition}"


ATTRIBUTED_BARE = f"coalesce({boolean('attributed_to_promo')}, false) AND promotion_id IS NULL"


def negative(x: str) -> str:
    return bad_number(x, f"{exact(x)} < 0")


check("invalid_phone", "customers", "medium", rows_where("customers", phone_bad("phone_number")))
check("invalid_registration_date", "customers", "medium",
      rows_where("customers", f"registration_date IS NOT NULL AND {date_of('registration_date')} IS NULL"))
check("missing_promotion_id", "orders", "low", rows_where("orders", "promotion_id IS NULL"))
for _e in ("orders", "order_items"):
    check("promo_attributed_without_promotion_id", _e, "high", rows_where(_e, ATTRIBUTED_BARE))
check("invalid_order_value", "orders", "high", rows_where("orders", negative("order_value")))
check("invalid_quantity", "order_items", "high",
      rows_where("order_items", bad_number("quantity", "quantity::BIGINT <= 0", "'^-?\\d+$'")))
check("invalid_unit_price", "order_items", "high", rows_where("order_items", negative("unit_price")))
check("invalid_date_range", "promotions", "high",
      rows_where("promotions", range_bad(f"({date_of('start_date')})", f"({date_of('end_date')})")))
check("negative_discount_value", "promotions", "high", rows_where("promotions", negative("discount_value")))
check("invalid_expected_response_rate", "promotions", "medium", rows_where(
    "promotions", bad_number("expected_response_rate", f"{exact('expected_response_rate')} NOT BETWEEN 0 AND 1")))
check("invalid_budget_or_cpa", "promotions", "high",
      rows_where("promotions", f"{negative('budget_allocated')} OR {negative('cost_per_acquisition')}"))
check("invalid_customer_reference", "orders", "high", f"""SELECT count(*) FROM text_orders t
  WHERE NOT EXISTS (SELECT 1 FROM silver_customers c WHERE c.customer_id = {big('t.customer_id')})""")
check("invalid_promotion_reference", "orders", "high", f"""SELECT count(*) FROM text_orders t WHERE t.promotion_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM silver_promotions p WHERE p.promotion_id = {big('t.promotion_id')})""")
check("invalid_order_reference", "order_items", "high", f"""SELECT count(*) FROM text_order_items t
  WHERE NOT EXISTS (SELECT 1 FROM silver_orders o WHERE o.order_id = {big('t.order_id')})""")
check("inconsistent_order_item_promotion_attribution", "order_items", "medium",
      """SELECT count(*) FROM silver_order_items i JOIN silver_orders o USING (order_id)
  WHERE i.attributed_to_promo IS DISTINCT FROM o.attributed_to_promo OR i.promotion_id IS DISTINCT FROM o.promotion_id""")
ALL_TEXT = [f"text_{e}" for e in ENTITIES]
ALL_SILVER = [f"silver_{e}" for e in ENTITIES]
cte("dq_report", "SELECT * FROM (" + union([
    f"SELECT '{issue}' AS issue_type, '{table}' AS table_name, ({sql})::BIGINT AS affected_row_count, '{severity}' AS severity"
    for issue, table, severity, sql in SEVERITY_CHECKS]) + ") WHERE affected_row_count > 0", *ALL_TEXT, *ALL_SILVER)
oracle("data_quality_report", "SELECT * FROM dq_report", "dq_report")
oracle("dq_by_severity", "SELECT severity, sum(affected_row_count)::BIGINT AS affected_rows FROM dq_report GROUP BY severity", "dq_report")
oracle("dq_high_total", "SELECT coalesce(sum(affected_row_count), 0)::BIGINT AS affected_rows FROM dq_report WHERE severity = 'high'", "dq_report")
oracle("dq_ranked", """SELECT * FROM dq_report ORDER BY CASE severity WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END,
  affected_row_count DESC, table_name, issue_type LIMIT 100""", "dq_report")
oracle("dq_duplicate_keys", union([
    f"SELECT count({s.key}) - count(DISTINCT {s.key}) AS duplicates, '{e}' AS entity FROM text_{e}" for e, s in ENTITIES.items()]), *ALL_TEXT)
oracle("orphan_refs", union([
    f"""SELECT '{entity}' AS entity, '{column}' AS column_name, t.{column} AS reference, count(*) AS n_records FROM text_{entity} t
WHERE {'true' if blank else f't.{column} IS NOT NULL'} AND NOT EXISTS (SELECT 1 FROM silver_{parent} x WHERE x.{column} = {big('t.' + column)})
GROUP BY t.{column}"""
    for entity, column, parent, blank in [("orders", "customer_id", "customers", True), ("orders", "promotion_id", "promotions", False),
                                          ("order_items", "order_id", "orders", True)]]), *ALL_TEXT, *ALL_SILVER)
oracle("attribution_mismatch", """SELECT i.order_id, i.attributed_to_promo, i.promotion_id, count(*) AS n_records,
  o.attributed_to_promo AS order_attributed, o.promotion_id AS order_promotion_id
FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id
WHERE i.attributed_to_promo IS DISTINCT FROM o.attributed_to_promo OR i.promotion_id IS DISTINCT FROM o.promotion_id
GROUP BY ALL""", "silver_order_items", "silver_orders")
