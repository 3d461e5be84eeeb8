"""DuckDB SQL of the source, function, version, validation and profiling queries."""

from __future__ import annotations

from ledgerloom import specs
from ledgerloom.catalog.oracle_base import (
    ALL_SILVER, ALL_TEXT, PIPE, age, big, boolean, cased, clean, cte, date_of, dec, label, newest, oracle,
    phone_bad, quote, range_bad, record_hash, sig, token, union, unless, values_list, whole,
)
from ledgerloom.plans import datatests
from ledgerloom.plans.profiling import NUMBER
from ledgerloom.sources import feeds
from ledgerloom.specs import ENTITIES

FEEDS = [f"feed_{e}" for e in ENTITIES]
DIRTY = [f"dirty_{e}" for e in ENTITIES]
BRONZE = [f"bronze_{e}" for e in ENTITIES]
CURRENT = [f"current_{e}" for e in ENTITIES]
UPDATE, LAST, DIRTY_DAY = "DATE '2026-09-02'", "DATE '2026-09-03'", f"DATE '{feeds.DIRTY_DATE}'"
COUNT_OPS = ("count(*) FILTER (operation = 'I') AS rows_inserted, count(*) FILTER (operation = 'U') AS rows_updated, "
             "count(*) FILTER (operation = 'D') AS rows_deleted")


def per_entity(template) -> str:
    return union([template(e, s) for e, s in ENTITIES.items()])


def joined(spec) -> str:
    return f"concat_ws('|', {', '.join(spec.csv_columns)})"


# --- sources and sinks ------------------------------------------------------------------

oracle("read_feed", per_entity(lambda e, s: f"SELECT '{e}' AS entity, logical_date, {joined(s)} AS row_text FROM feed_{e}"), *FEEDS)
oracle("header_check", per_entity(lambda e, s: f"""SELECT DISTINCT '{e}' AS entity, true AS is_expected, logical_date FROM feed_{e}
UNION ALL SELECT '{e}', {str(e == 'order_items').lower()}, DATE '{feeds.DIRTY_DATE}'"""), *FEEDS)


def csv_cell(x: str) -> str:
    """A field as the landed files hold it."""
    return f"""CASE WHEN regexp_matches({x}, '[,"\\r\\n]') THEN '"' || replace({x}, '"', '""') || '"' ELSE {x} END"""


def checksum_sql(entity: str, spec) -> str:
    """Lines of the header and of all rows in order, each hashed with its number; the sums of the quarters are hashed."""
    row = "concat_ws(',', " + ", ".join(csv_cell(x) for x in spec.csv_columns) + ")"
    quarters = ", ".join(f"(sum(('0x' || substr(h, {16 * k + 1}, 16))::UBIGINT)::HUGEINT)::VARCHAR AS q{k}" for k in range(4))
    return f"""SELECT '{entity}' AS entity, sha256(concat_ws(':', q0, q1, q2, q3, n::VARCHAR, '0')) AS file_checksum, logical_date
FROM (SELECT logical_date, count(*) AS n, {quarters} FROM (
  SELECT logical_date, sha256(row_number() OVER (PARTITION BY logical_date ORDER BY place, hash, line_place)::VARCHAR || ':' || line) AS h FROM (
    SELECT logical_date, source_row_number AS place, {record_hash(entity)} AS hash,
      unnest(string_split({row}, chr(10))) AS line, generate_subscripts(string_split({row}, chr(10)), 1) AS line_place FROM feed_{entity}
    UNION ALL SELECT DISTINCT logical_date, -1, '', '{','.join(spec.csv_columns)}', 1 FROM feed_{entity}))
  GROUP BY logical_date)"""


oracle("file_checksum", per_entity(checksum_sql), *FEEDS)
oracle("missing_files", per_entity(lambda e, s: f"SELECT logical_date, '{e}.csv' AS file_name, false AS is_missing, count(*) AS row_count FROM feed_{e} GROUP BY logical_date"), *FEEDS)
oracle("feed_operation", per_entity(lambda e, s: f"SELECT '{e}' AS entity, {s.key} AS raw_key, operation FROM dirty_{e}"), *DIRTY)
oracle("row_number_lineage", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, logical_date,
  (1 + row_number() OVER (PARTITION BY logical_date ORDER BY source_row_number, {record_hash(e)}))::BIGINT AS source_row_number,
  {record_hash(e)} AS source_record_hash FROM feed_{e}"""), *FEEDS)
oracle("record_hash", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, {s.key} AS raw_key, logical_date, operation,
  {record_hash(e)} AS source_record_hash FROM feed_{e}"""), *FEEDS)
oracle("append_new_versions", per_entity(lambda e, s: f"""SELECT logical_date, count(*) AS rows_written, {COUNT_OPS}, '{e}' AS entity
FROM (SELECT DISTINCT source_record_hash, operation, logical_date FROM bronze_{e} WHERE logical_date >= {UPDATE}
  AND source_record_hash NOT IN (SELECT source_record_hash FROM bronze_{e} WHERE logical_date <= {UPDATE}))
GROUP BY logical_date"""), *BRONZE)
oracle("committed_rows", per_entity(lambda e, s: f"""SELECT logical_date, operation, count(*) AS row_count, '{e}' AS entity
FROM feed_{e} WHERE logical_date <= {UPDATE} GROUP BY logical_date, operation"""), *FEEDS)
oracle("evolve_schema", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, concat_ws('|', {', '.join(f"coalesce({x}, '~')" for x in s.columns[:-2])}) AS held,
  true AS gained_as_null, true AS whole, source_record_hash FROM bronze_{e}"""), *BRONZE)
TYPED = {
    "customers": {"customer_id": "BIGINT", "avg_order_value": "DECIMAL(12,2)", "promo_sensitivity": "FLOAT", "email_opt_in": "BOOLEAN",
                  "total_lifetime_orders": "INTEGER"},
    "promotions": {"promotion_id": "BIGINT", "discount_value": "DOUBLE", "campaign_duration_days": "INTEGER", "budget_allocated": "DECIMAL(14,2)",
                   "expected_response_rate": "FLOAT"},
    "orders": {"order_id": "BIGINT", "customer_id": "BIGINT", "order_value": "DECIMAL(12,2)", "attributed_to_promo": "BOOLEAN"},
    "order_items": {"order_item_id": "BIGINT", "order_id": "BIGINT", "quantity": "INTEGER", "unit_price": "DOUBLE", "attributed_to_promo": "BOOLEAN"},
}


def stored_text(x: str, kind: str) -> str:
    """A field converted to a stored type, as text."""
    if kind == "VARCHAR":
        return f"nullif({x}, '')"
    if kind == "BOOLEAN":
        return f"({boolean(f'trim({x})')})::VARCHAR"
    pattern = "'^-?\\d+$'" if kind in ("BIGINT", "INTEGER") else "'^-?\\d+(\\.\\d+)?$'"
    shown = "::DECIMAL(20,4)" if kind in ("FLOAT", "DOUBLE") else ""
    return f"CASE WHEN regexp_matches(trim({x}), {pattern}) THEN (trim({x})::{kind}{shown})::VARCHAR END"


oracle("convert_types", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, concat_ws('|', {', '.join(
  f"coalesce({stored_text(x, TYPED[e].get(x, 'VARCHAR'))}, '~')" for x in s.columns)}, business_date::DATE::VARCHAR,
  strftime(strptime(source_updated_at, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S')) AS converted FROM feed_{e}"""), *FEEDS)
oracle("reset_empty", per_entity(lambda e, s: f"""SELECT 'before' AS stage, '{s.table}' AS table_name, count(*) AS visible_rows FROM feed_{e}
UNION ALL SELECT 'after', '{s.table}', 0"""), *FEEDS)
oracle("batch_manifest", per_entity(lambda e, s: f"""SELECT logical_date, count(*) AS row_count, count(*) FILTER (operation = 'I') AS i_count,
  count(*) FILTER (operation = 'U') AS u_count, count(*) FILTER (operation = 'D') AS d_count, '{e}' AS entity
FROM feed_{e} GROUP BY logical_date"""), *FEEDS)
FIRST = f"DATE '{feeds.DATES[0]}'"
REFERS = {
    "customers": "", "promotions": "",
    "orders": "AND customer_id IN (SELECT customer_id FROM sound_customers) AND (promotion_id = '' OR promotion_id IN (SELECT promotion_id FROM sound_promotions))",
    "order_items": """AND order_id IN (SELECT order_id FROM sound_orders) AND product_id <> ''
  AND (promotion_id = '' OR promotion_id IN (SELECT promotion_id FROM sound_promotions))""",
}
for _e, _s in ENTITIES.items():
    cte(f"once_{_e}", f"""SELECT * FROM feed_{_e} WHERE logical_date = {FIRST} AND operation = 'I' AND trim({_s.key}) <> ''
  AND strptime(source_updated_at, '%Y-%m-%dT%H:%M:%SZ')::DATE = {FIRST} AND business_date::DATE <= {FIRST}
QUALIFY count(*) OVER (PARTITION BY trim({_s.key})) = 1""", f"feed_{_e}")
    cte(f"sound_{_e}", f"SELECT * FROM once_{_e} WHERE true {REFERS[_e]}", f"once_{_e}",
        *[f"sound_{p}" for p in ("customers", "promotions", "orders") if f"sound_{p}" in REFERS[_e]])
def share(key: str) -> str:
    return f"('0x' || substr(md5({key}), 1, 4))::INTEGER % 20"


SECOND = feeds.DATES[1]
for _e, _s in ENTITIES.items():
    _first = f"sound_{_e}"
    if _e == "customers":
        cte("broken_customers", f"""SELECT * REPLACE (CASE WHEN {share('customer_id')} % 10 = 0 THEN last_name || chr(10) || last_name ELSE last_name END AS last_name)
FROM sound_customers""", "sound_customers")
        _first = "broken_customers"
    _deleted = f"WHEN {share(_s.key)} = 2 THEN 'D' " if _e == "order_items" else ""
    cte(f"streamed_{_e}", f"""SELECT * FROM {_first} UNION ALL
SELECT * REPLACE (CASE WHEN {share(_s.key)} = 1 THEN 'U' {_deleted}END AS operation,
  replace(source_updated_at, '{feeds.DATES[0]}', '{SECOND}') AS source_updated_at, '{SECOND}' AS business_date, DATE '{SECOND}' AS logical_date)
FROM {_first} WHERE {share(_s.key)} = 1 {f"OR {share(_s.key)} = 2" if _deleted else ""}""", _first)
oracle("stream_ingest", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, {s.key} AS raw_key, logical_date, operation,
  strptime(source_updated_at, '%Y-%m-%dT%H:%M:%SZ') AS source_updated_at, length(concat_ws('|', {', '.join(s.columns)}))::INTEGER AS row_length,
  {record_hash(e)} AS source_record_hash FROM streamed_{e}"""), *[f"streamed_{e}" for e in ENTITIES])

# --- functions ------------------------------------------------------------------------------


def fn(name: str, entity: str, **columns: str) -> None:
    cells = ", ".join(f"{x} AS {n}" for n, x in columns.items())
    oracle(name, f"SELECT raw_key, {cells} FROM text_{entity} t", f"text_{entity}")


oracle("fn_text_clean", f"""SELECT customer_id AS raw_key,
  {', '.join(f'{clean(c)} AS {c}' for c in ENTITIES['customers'].columns)} FROM current_customers""", "current_customers")
fn("fn_token", "customers", segment_token=token("customer_segment"), channel_token=token("preferred_channel"),
   category_token=token("preferred_category"))
fn("fn_parse_date", "customers", registration_date=date_of("t.registration_date"), last_purchase_date=date_of("t.last_purchase_date"))
fn("fn_bool", "customers", **{n: boolean(f"t.{n}") for n in ("email_opt_in", "sms_opt_in", "push_opt_in")})
fn("fn_bigint", "orders", **{n: big(f"t.{n}") for n in ("order_id", "customer_id", "promotion_id")})
fn("fn_int", "order_items", quantity=whole("t.quantity"))
fn("fn_decimal", "promotions", discount_value=dec("t.discount_value"),
   expected_response_rate=dec("t.expected_response_rate", 8, 4), budget_allocated=dec("t.budget_allocated", 14, 2))
fn("fn_canonical", "promotions", promo_type=label("t.promo_type", specs.PROMO_TYPE_MAP),
   target_segment=label("t.target_segment", specs.TARGET_SEGMENT_MAP),
   campaign_channel=label("t.campaign_channel", specs.CAMPAIGN_CHANNEL_MAP),
   campaign_objective=label("t.campaign_objective", specs.CAMPAIGN_OBJECTIVE_MAP),
   target_category=label("t.target_category", specs.CATEGORY_MAP))
fn("fn_age_band", "customers", age_group=age("t.age_group"))
fn("fn_status", "orders", order_status=label("t.order_status", specs.STATUS_MAP, specs.UNKNOWN_STATUS))
fn("fn_initcap", "customers", first_name=cased("t.first_name"), last_name=cased("t.last_name"),
   campaign=cased("concat_ws('-', t.first_name, t.email)"))
fn("fn_lower", "customers", email="lower(t.email)")
fn("fn_signature", "orders", row_signature=sig("orders", "t."))
fn("fn_date_key", "orders", order_date_key=f"coalesce(strftime({date_of('t.order_date')}, '%Y%m%d')::INTEGER, -1)")
HAS_ZONE = "regexp_matches(source_updated_at, '(Z|[+-]\\d{2}:\\d{2})$')"
INSTANT = (f"CASE WHEN {HAS_ZONE} THEN strptime(substr(source_updated_at, 1, 19), '%Y-%m-%dT%H:%M:%S') "
           "- CASE WHEN ends_with(source_updated_at, '+07:00') THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END END")
oracle("fn_utc_ts", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, {s.key} AS raw_key, source_updated_at,
  {INSTANT} AS instant, NOT {HAS_ZONE} AS lacks_offset FROM dirty_{e}"""), *DIRTY)
oracle("fn_batch_id", f"""SELECT order_id AS raw_key, operation, {PIPE} || ':' || logical_date::VARCHAR AS batch_id FROM feed_orders""", "feed_orders")


def own_date(x: str) -> str:
    parsed = f"({date_of(x)})::DATE"
    return f"CASE WHEN {parsed} <= logical_date THEN {parsed} ELSE logical_date END"


cte("order_dates", """SELECT order_id, arg_max(struct_pack(d := order_date), (source_updated_at, ingested_at, batch_id, source_record_hash)).d AS order_date
FROM (SELECT * REPLACE (trim(order_id, ' ') AS order_id) FROM current_orders) GROUP BY order_id""", "current_orders")
oracle("business_date", union([
    *[f"""SELECT '{e}' AS entity, {s.key} AS raw_key, logical_date, operation, {own_date(s.date_column)} AS derived_business_date
FROM feed_{e}""" for e, s in ENTITIES.items() if s.date_column],
    f"""SELECT 'order_items' AS entity, i.order_item_id AS raw_key, logical_date, operation, {own_date('o.order_date')} AS derived_business_date
FROM feed_order_items i LEFT JOIN order_dates o USING (order_id)"""]), *FEEDS, "order_dates")

# --- row rules -----------------------------------------------------------------------------------

oracle("valid_keys", per_entity(lambda e, s: f"SELECT '{e}' AS entity, {big(s.key)} AS key FROM text_{e} WHERE {big(s.key)} IS NOT NULL"), *ALL_TEXT)


def nonneg(x: str) -> str:
    return unless(f"({x})", f"({x}) >= 0")


DISCOUNT, BUDGET = dec("t.discount_value"), dec("t.budget_allocated", 14, 2)
RATE, CPA = dec("t.expected_response_rate", 8, 4), dec("t.cost_per_acquisition")
QTY, PRICE = whole("t.quantity"), dec("t.unit_price")
fn("clean_nonneg", "promotions", discount_value=nonneg(DISCOUNT), campaign_duration_days=nonneg(whole("t.campaign_duration_days")),
   budget_allocated=nonneg(BUDGET))
fn("clean_positive", "order_items", quantity=unless(f"({QTY})", f"({QTY}) > 0"), unit_price=nonneg(PRICE))
fn("clean_rate", "promotions", expected_response_rate=unless(f"({RATE})", f"({RATE}) BETWEEN 0 AND 1"))
ATTRIBUTED = f"coalesce({boolean('t.attributed_to_promo')}, false)"


def both(name: str, orders: dict[str, str], items: dict[str, str], join: str = "", *needs: str) -> None:
    oracle(name, union([f"SELECT '{e}' AS entity, raw_key, {', '.join(f'{x} AS {n}' for n, x in cells.items())} FROM text_{e} t {join}"
                        for e, cells in (("orders", orders), ("order_items", items))]), "text_orders", "text_order_items", *needs)


def both_alike(name: str, cells: dict[str, str], join: str = "", *needs: str) -> None:
    both(name, cells, cells, join, *needs)


both_alike("default_false", {"attributed_to_promo": ATTRIBUTED})
both("flags_numeric", {"invalid_quantity": "NULL::BOOLEAN", "invalid_amount": f"coalesce(({dec('t.order_value')}) < 0, true)"},
     {"invalid_quantity": f"coalesce(({QTY}) <= 0, true)", "invalid_amount": f"coalesce(({PRICE}) < 0, true)"})
oracle("flags_missing", """SELECT 'orders' AS entity, raw_key, promotion_id IS NULL AS is_missing FROM text_orders
UNION ALL SELECT 'customers', raw_key, last_purchase_date IS NULL FROM text_customers""", "text_orders", "text_customers")
both_alike("flags_attribution", {"attributed_without_promotion": f"{ATTRIBUTED} AND t.promotion_id IS NULL"})
fn("flags_phone", "customers", invalid_phone=phone_bad("t.phone_number"))
fn("flags_date", "customers", invalid_registration_date=f"t.registration_date IS NOT NULL AND ({date_of('t.registration_date')}) IS NULL")
RANGE = range_bad(f"({date_of('t.start_date')})", f"({date_of('t.end_date')})")
fn("flags_range", "promotions", invalid_date_range=RANGE, is_valid_date_range=f"NOT {RANGE}")
fn("flags_rate_budget", "promotions", invalid_rate=f"coalesce(({RATE}) NOT BETWEEN 0 AND 1, true)",
   invalid_budget=f"coalesce(({BUDGET}) < 0, true) OR coalesce(({CPA}) < 0, true)")
oracle("line_total", "SELECT order_item_id, (quantity::BIGINT * unit_price)::DECIMAL(23,2) AS line_total FROM silver_order_items", "silver_order_items")
TO_PROMOTION = f"LEFT JOIN silver_promotions p ON p.promotion_id = {big('t.promotion_id')}"
both_alike("keep_if_referenced", {"promotion_id": "p.promotion_id"}, TO_PROMOTION, "silver_promotions")
both_alike("flags_reference", {"dangling_promotion": "t.promotion_id IS NOT NULL AND p.promotion_id IS NULL"}, TO_PROMOTION, "silver_promotions")

# --- versions --------------------------------------------------------------------------------------

oracle("latest_version", per_entity(lambda e, s: f"""SELECT '{e}' AS entity, {s.key} AS raw_key, operation, logical_date, source_record_hash
FROM current_{e}"""), *CURRENT)
oracle("current_keys", per_entity(lambda e, s: f"SELECT {s.key} AS business_key, '{e}' AS entity FROM current_{e} WHERE {s.key} IS NOT NULL"), *CURRENT)
for _e, _s in ENTITIES.items():
    cte(f"last_change_{_e}", f"""SELECT {_s.key} AS business_key, arg_max(operation, source_row_number) AS operation
FROM dirty_{_e} WHERE operation IN ('I', 'U', 'D') GROUP BY {_s.key}""", f"dirty_{_e}")
    cte(f"available_{_e}", f"""SELECT {_s.key} AS business_key FROM current_{_e}
WHERE {_s.key} NOT IN (SELECT business_key FROM last_change_{_e})
UNION ALL SELECT business_key FROM last_change_{_e} WHERE operation <> 'D'""", f"current_{_e}", f"last_change_{_e}")
    cte(f"past_{_e}", newest(f"bronze_{_e}", _s.key, f"logical_date <= {UPDATE}"), f"bronze_{_e}")
oracle("available_keys", per_entity(lambda e, s: f"SELECT business_key, '{e}' AS entity FROM available_{e}"), *[f"available_{e}" for e in ENTITIES])
oracle("state_as_of", per_entity(lambda e, s: f"SELECT '{e}' AS entity, {s.key} AS raw_key, operation, source_record_hash FROM past_{e}"),
       *[f"past_{e}" for e in ENTITIES])
oracle("late_rows", per_entity(lambda e, s: f"""SELECT logical_date, business_date, count(*) AS row_count, '{e}' AS entity FROM bronze_{e}
WHERE operation = 'I' AND business_date < logical_date GROUP BY logical_date, business_date"""), *BRONZE)
oracle("status_transitions", """SELECT order_id, logical_date, was AS previous_status, order_status AS new_status,
  coalesce(order_status IN ('PAID', 'PENDING', 'CANCEL', 'ERROR', 'INVALID') AND (order_status = was
    OR (was = 'PENDING' AND order_status IN ('PAID', 'CANCEL')) OR (was IN ('ERROR', 'INVALID') AND order_status = 'CANCEL')), false) AS is_allowed
FROM (SELECT *, lag(order_status) OVER (PARTITION BY order_id ORDER BY source_updated_at NULLS FIRST, ingested_at NULLS FIRST,
  batch_id NULLS FIRST, source_record_hash NULLS FIRST) AS was FROM bronze_orders) WHERE operation = 'U'""", "bronze_orders")
oracle("next_ids", f"""SELECT source_key, (SELECT max({big('trim(order_id)')}) FROM past_orders) + row_number() OVER (ORDER BY source_key) AS next_id
FROM (SELECT {big('order_id')} AS source_key FROM bronze_orders WHERE logical_date = {LAST} AND operation = 'I')""", "bronze_orders", "past_orders")

# --- batch validation ---------------------------------------------------------------------------------


def error(entity: str, key: str, rule: str, detail: str, source: str, where: str) -> str:
    return f"SELECT '{entity}' AS entity, {key} AS business_key, '{rule}' AS rule, {detail} AS detail FROM {source} WHERE {where}"


def row_errors(e: str, s) -> str:
    key, src = f"trim({s.key})", f"dirty_{e}"
    day = f"CASE WHEN regexp_matches(business_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime(business_date, '%Y-%m-%d')::DATE END"
    return union([
        error(e, key, "blank_key", f"'blank {s.key}'", src, f"{key} = ''"),
        error(e, key, "invalid_operation", "'invalid operation ''' || operation || ''''", src, "operation NOT IN ('I', 'U', 'D')"),
        error(e, key, "source_time_without_offset", "'source_updated_at has no UTC offset: ''' || source_updated_at || ''''", src, f"NOT {HAS_ZONE}"),
        error(e, key, "source_time_off_date", "'source_updated_at lies outside the batch date'", src, f"({INSTANT})::DATE <> {DIRTY_DAY}"),
        error(e, key, "invalid_business_date", "'invalid business_date ''' || business_date || ''''", src, f"({day}) IS NULL"),
        error(e, key, "future_business_date", "'business_date lies after the batch date'", src, f"({day}) > {DIRTY_DAY}"),
    ])


def dup_keys(e: str, s) -> str:
    return f"""SELECT '{e}' AS entity, trim({s.key}) AS business_key, 'duplicate_key' AS rule,
  'key ''' || trim({s.key}) || ''' occurs more than once' AS detail FROM dirty_{e} WHERE trim({s.key}) <> ''
GROUP BY trim({s.key}) HAVING count(*) > 1"""


def dup_versions(e: str, s) -> str:
    return f"""SELECT '{e}' AS entity, '' AS business_key, 'duplicate_version' AS rule,
  'version ' || h || ' occurs more than once' AS detail FROM (SELECT {record_hash(e)} AS h FROM dirty_{e})
GROUP BY h HAVING count(*) > 1"""


def absent_keys(e: str, s) -> str:
    return error(e, s.key, "missing_existing_key", "operation || ' of a key that is not current'", f"dirty_{e}",
                 f"operation IN ('U', 'D') AND {s.key} NOT IN (SELECT {s.key} FROM current_{e} WHERE {s.key} IS NOT NULL)")


def lost_reference(e: str, column: str, parent: str, blank_allowed: bool) -> str:
    where = f"operation <> 'D' AND {column} NOT IN (SELECT business_key FROM available_{parent} WHERE business_key IS NOT NULL)"
    if blank_allowed:
        where += f" AND {column} <> ''"
    return error(e, ENTITIES[e].key, f"unknown_{column.removesuffix('_id')}", f"'unknown {column} ' || {column}", f"dirty_{e}", where)


REFERENCES = union([
    lost_reference("orders", "customer_id", "customers", False), lost_reference("orders", "promotion_id", "promotions", True),
    lost_reference("order_items", "order_id", "orders", False),
    error("order_items", "order_item_id", "blank_product", "'blank product_id'", "dirty_order_items", "operation <> 'D' AND product_id = ''"),
    lost_reference("order_items", "promotion_id", "promotions", True),
])
AVAILABLE = [f"available_{e}" for e in ("customers", "promotions", "orders")]
oracle("batch_row_errors", per_entity(row_errors), *DIRTY)
oracle("batch_dup_keys", per_entity(dup_keys), *DIRTY)
oracle("batch_dup_versions", per_entity(dup_versions), *DIRTY)
oracle("batch_missing_keys", per_entity(absent_keys), *DIRTY, *CURRENT)
oracle("batch_ref_errors", REFERENCES, *DIRTY, *AVAILABLE)
oracle("batch_errors", f"""SELECT * FROM ({union([per_entity(row_errors), per_entity(dup_keys), per_entity(dup_versions),
                                                   per_entity(absent_keys), REFERENCES])})
ORDER BY entity, business_key, rule, detail LIMIT {specs.MAX_REPORTED_ERRORS}""", *DIRTY, *CURRENT, *AVAILABLE)
oracle("batch_metrics", per_entity(lambda e, s: f"""SELECT batch_id, logical_date, count(*) AS rows_received, {COUNT_OPS},
  max(source_updated_at) AS last_source_updated_at, '{e}' AS entity FROM bronze_{e} GROUP BY batch_id, logical_date"""), *BRONZE)

# --- profile --------------------------------------------------------------------------------------------

for _e in ENTITIES:
    cte(f"update_{_e}", f"SELECT * FROM feed_{_e} WHERE logical_date = {UPDATE}", f"feed_{_e}")
UPDATES = [f"update_{e}" for e in ENTITIES]
oracle("profile_rows", per_entity(lambda e, s: f"SELECT '{e}' AS table_name, count(*) AS row_count FROM update_{e}"), *UPDATES)


def column_nulls(e: str, s) -> str:
    return union([f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(*) FILTER (nullif({c}, '') IS NULL) AS null_count FROM update_{e}"
                  for c in s.csv_columns])


def duplicates(e: str, rows: str) -> str:
    return f"SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM {rows} GROUP BY {', '.join(ENTITIES[e].csv_columns)})"


def doubled(e: str) -> str:
    again = " UNION ALL ".join(f"SELECT * FROM update_{e} WHERE ends_with({ENTITIES[e].key}, '{end}')" for end in ("7", "77"))
    return f"(SELECT * FROM update_{e} UNION ALL {again})"


def number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMBER}') THEN try_cast({x} AS DOUBLE) END"


def column_types(e: str, s) -> str:
    def one(c: str) -> str:
        shown = f"count(*) FILTER ({c} <> '')"
        ints = f"count(*) FILTER (regexp_matches({c}, '^\\s*[+-]?\\d+\\s*$') AND try_cast({c} AS BIGINT) IS NOT NULL)"
        numbers = f"count(*) FILTER ({number(c)} IS NOT NULL)"
        booleans = f"count(*) FILTER (lower({c}) IN ('true', 'false'))"
        return f"""SELECT '{e}' AS table_name, '{c}' AS column_name, CASE WHEN {shown} = 0 THEN 'double'
  WHEN {ints} = {shown} AND {shown} = count(*) THEN 'bigint' WHEN {numbers} = {shown} THEN 'double'
  WHEN {booleans} = {shown} AND {shown} = count(*) THEN 'boolean' ELSE 'string' END AS column_type FROM update_{e}"""
    return union([one(c) for c in s.csv_columns])


oracle("profile_nulls", per_entity(column_nulls), *UPDATES)
oracle("profile_duplicates", per_entity(lambda e, s: f"""SELECT '{e}' AS table_name,
  ({duplicates(e, doubled(e))}) AS duplicate_row_count"""), *UPDATES)
oracle("profile_types", per_entity(column_types), *UPDATES)
oracle("profile_sink", per_entity(lambda e, s: f"""SELECT t.table_name, t.column_name, t.column_type, n.null_count,
  (SELECT count(*) FROM update_{e}) AS row_count, ({duplicates(e, f'update_{e}')}) AS duplicate_row_count
FROM ({column_types(e, s)}) t JOIN ({column_nulls(e, s)}) n USING (table_name, column_name)"""), *UPDATES)
oracle("profile_sample", per_entity(lambda e, s: f"""(SELECT '{e}' AS table_name, source_row_number, {joined(s)} AS row_text FROM update_{e}
ORDER BY source_row_number, {', '.join(s.csv_columns)} LIMIT 5)"""), *UPDATES)


def issue(entity: str, name: str, severity: str, condition: str) -> str:
    return f"""SELECT '{name}' AS issue_type, '{entity}' AS table_name, count(*) FILTER ({condition}) AS affected_row_count,
  '{severity}' AS severity FROM update_{entity}"""


BARE = f"lower(trim(attributed_to_promo)) IN {values_list(specs.TRUE_TOKENS)} AND promotion_id = ''"
RAW_ISSUES = "SELECT * FROM (" + union([
    issue("customers", "invalid_registration_date", "medium", f"registration_date <> '' AND ({date_of('registration_date')}) IS NULL"),
    issue("customers", "negative_phone_number", "medium", "starts_with(phone_number, '-')"),
    issue("customers", "missing_last_purchase_date", "low", "last_purchase_date = ''"),
    issue("orders", "missing_promotion_id", "low", "promotion_id = ''"),
    issue("orders", "promo_attributed_without_promotion_id", "high", BARE),
    issue("orders", "negative_order_value", "high", f"{number('order_value')} < 0"),
    issue("order_items", "invalid_quantity", "high", f"{number('quantity')} <= 0"),
    issue("order_items", "invalid_unit_price", "high", f"{number('unit_price')} < 0"),
    issue("order_items", "promo_attributed_without_promotion_id", "high", BARE),
    issue("promotions", "negative_discount_value", "high", f"{number('discount_value')} < 0"),
    issue("promotions", "invalid_expected_response_rate", "medium", f"NOT coalesce({number('expected_response_rate')} BETWEEN 0 AND 1, false)"),
    issue("promotions", "invalid_budget_or_cpa", "high", f"{number('budget_allocated')} < 0 OR {number('cost_per_acquisition')} < 0"),
    issue("promotions", "invalid_date_range", "high", range_bad(f"({date_of('start_date')})", f"({date_of('end_date')})")),
]) + ") WHERE affected_row_count > 0"
oracle("raw_issue_summary", RAW_ISSUES, *UPDATES)
oracle("issue_sink", RAW_ISSUES, *UPDATES)

# --- data tests ---------------------------------------------------------------------------------------------


def doubled(table: str, key: str) -> str:
    return f"""SELECT {key}::VARCHAR AS value, count(*) * 2 AS n_records, '{table.removeprefix('silver_')}' AS table_name FROM {table}
WHERE {key} % 97 = 0 GROUP BY {key}"""


oracle("test_unique", union([
    *[f"""SELECT {s.key} AS value, count(*) AS n_records, '{s.table}' AS table_name FROM text_{e} WHERE {s.key} IS NOT NULL
GROUP BY {s.key} HAVING count(*) > 1""" for e, s in ENTITIES.items()],
    doubled("silver_customers", "customer_id"), doubled("silver_orders", "order_id"), doubled("fact_order_items", "order_item_id")]),
    *ALL_TEXT, "silver_customers", "silver_orders", "fact_order_items")
oracle("test_not_null", """SELECT 'orders' AS table_name, order_id AS key FROM silver_orders WHERE order_id % 89 = 0
UNION ALL SELECT 'order_items', order_item_id FROM silver_order_items WHERE order_item_id % 89 = 0""", "silver_orders", "silver_order_items")
CHANNELS = values_list(datatests.ALL_CHANNELS)
oracle("test_accepted_values", f"""SELECT order_channel, count(*) AS n_records, 'orders_raw' AS table_name FROM current_orders
WHERE order_channel NOT IN {CHANNELS} GROUP BY order_channel
UNION ALL SELECT {quote('Fax')}, count(*), 'orders' FROM silver_orders WHERE order_id % 83 = 0 HAVING count(*) > 0""", "current_orders", "silver_orders")
oracle("test_relationships", """SELECT 'orders' AS table_name, customer_id + 1000000000000 AS value, count(*) AS n_records FROM silver_orders
WHERE order_id % 79 = 0 GROUP BY customer_id
UNION ALL SELECT 'fact_order_items', -order_id - 2, count(*) FROM fact_order_items WHERE order_item_id % 79 = 0 GROUP BY order_id""",
       "silver_orders", "fact_order_items")
oracle("test_no_negative_revenue", """SELECT 'fact_orders' AS table_name, order_id::VARCHAR AS record_id, (-order_value)::DECIMAL(23,2) AS invalid_amount
FROM fact_orders WHERE order_id % 73 = 0 AND order_value > 0
UNION ALL SELECT 'fact_order_items', order_item_id::VARCHAR, -line_total FROM fact_order_items WHERE order_item_id % 73 = 0 AND line_total > 0""",
       "fact_orders", "fact_order_items")


def table_of(layer: str, table: str) -> str:
    if layer == "bronze":
        return "bronze_" + table.removesuffix("_raw")
    return "dq_report" if table == "data_quality_report" else f"silver_{table}" if layer == "silver" else table


def suite_row(layer: str, table: str, column: str, kind: str, count: str) -> str:
    return f"SELECT '{layer}.{table}' AS table_name, '{column}' AS column_name, '{kind}' AS test, ({count})::BIGINT AS failures"


def suite() -> str:
    rows = []
    for t in datatests.SUITE:
        source = table_of(t.layer, t.table)
        rows += [suite_row(t.layer, t.table, c, "not_null", f"SELECT count(*) FROM {source} WHERE {c} IS NULL") for c in t.not_null]
        rows += [suite_row(t.layer, t.table, c, "accepted_values", f"SELECT count(*) FROM {source} WHERE {c} NOT IN {values_list(v)}")
                 for c, v in t.accepted.items()]
        rows += [suite_row(t.layer, t.table, c, "unique", f"SELECT count(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
                 for c in t.unique]
        rows += [suite_row(t.layer, t.table, c, "relationships",
                           f"SELECT count(*) FROM {source} s WHERE s.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {table_of(layer, parent)} p WHERE p.{key} = s.{c})")
                 for c, (layer, parent, key) in t.related.items()]
    rows.append(suite_row("gold", "facts", "invalid_amount", "no_negative_revenue",
                          "SELECT (SELECT count(*) FROM fact_orders WHERE order_value < 0) + (SELECT count(*) FROM fact_order_items WHERE line_total < 0)"))
    return union(rows)


oracle("data_test_suite", suite(), *BRONZE, *ALL_SILVER, "dq_report", "dim_customer", "dim_promotion", "dim_product", "dim_date",
       "fact_orders", "fact_order_items")
