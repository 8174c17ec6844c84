"""SQL that states what each query must return, for an independent engine over the same tables."""

from __future__ import annotations

#: Fixed values, stated here anew so that the SQL does not lean on the operators it judges: columns of bronze_orders and their other names in landing files.
TARGET = ("order_id", "customer", "amount", "country", "status", "event_time", "kafka_timestamp", "kafka_partition", "kafka_offset", "event_date", "business_version", "source_epoch_id", "event_id", "canonical_payload", "canonical_payload_hash")
OTHER_NAMES = {
    "customer_name": "customer", "order_amount": "amount", "country_code": "country", "occurred_at": "event_time", "biz_version": "business_version", "version_no": "business_version",
    "epoch": "source_epoch_id", "src_epoch": "source_epoch_id", "payload_json": "canonical_payload", "canonical_body": "canonical_payload",
}
SPLIT_AT = "2015-03-20 00:00:00"

BLANKS = "chr(32) || chr(9)"


def plain(col: str) -> str:
    return f"nullif(lower(trim({col}, {BLANKS})), '')"


STATE = "order_id, customer, amount, country, status, event_time, kafka_timestamp, kafka_partition, kafka_offset, event_date, business_version"


def newest(relation: str, columns: str = STATE) -> str:
    """Highest version per order, first arrival among equals."""
    return f"""SELECT {columns} FROM {relation} QUALIFY row_number() OVER (
        PARTITION BY order_id ORDER BY business_version DESC NULLS LAST, kafka_partition NULLS LAST, kafka_offset NULLS LAST, customer DESC NULLS LAST, amount DESC NULLS LAST,
        country DESC NULLS LAST, status DESC NULLS LAST, event_time DESC NULLS LAST, kafka_timestamp DESC NULLS LAST, event_date DESC NULLS LAST) = 1"""


SILVER = f"silver AS ({newest('bronze_orders')})"


def blended(col: str) -> str:
    return f"first({col} ORDER BY business_version DESC NULLS LAST, kafka_partition, kafka_offset, {col} DESC) FILTER ({col} IS NOT NULL) AS {col}"


BLEND = f"blend AS (SELECT order_id, {', '.join(blended(c) for c in ('customer', 'amount', 'country', 'status', 'event_time', 'event_date', 'business_version'))} FROM bronze_orders GROUP BY order_id)"
GOLD = """SELECT event_date, country, status, count(order_id) AS orders_count, sum(amount::DECIMAL(18,2))::DECIMAL(18,2) AS total_amount,
    round(sum(amount::DECIMAL(18,2))::DOUBLE / nullif(count(amount), 0), 6) AS avg_amount, count(DISTINCT customer) AS distinct_customers FROM silver GROUP BY ALL"""
SIDES = f"""usable AS (SELECT {STATE} FROM bronze_orders WHERE order_id <> '' AND business_version IS NOT NULL),
    early AS (SELECT * FROM usable WHERE kafka_timestamp < TIMESTAMP '{SPLIT_AT}'), late AS (SELECT * FROM usable WHERE kafka_timestamp >= TIMESTAMP '{SPLIT_AT}'),
    cur AS ({newest('early')}), inc AS ({newest('late')})"""
SAME = " AND ".join(f"i.{c} IS NOT DISTINCT FROM c.{c}" for c in ("customer", "amount", "country", "status", "event_time", "event_date"))

CORE = """ranked_pay AS (SELECT *, row_number() OVER (PARTITION BY order_id, ingest_date ORDER BY payment_value DESC NULLS FIRST, payment_sequential NULLS LAST, payment_type NULLS LAST) AS place FROM stg_order_payments),
    pay AS (SELECT order_id, ingest_date, sum(payment_value)::DECIMAL(18,2) AS payment_value, max(CASE WHEN place = 1 THEN payment_type END) AS main_payment_type, max(payment_installments) AS max_installments FROM ranked_pay GROUP BY ALL),
    core AS (SELECT s.order_id, s.customer_id, c.customer_state, s.order_status, s.order_purchase_timestamp::DATE AS order_purchase_date, p.payment_value, p.main_payment_type, p.max_installments, s.ingest_date
        FROM stg_orders s JOIN stg_customers c USING (customer_id, ingest_date) LEFT JOIN pay p USING (order_id, ingest_date)),
    items AS (SELECT i.order_id, i.order_item_id, k.order_purchase_date, k.order_status, k.customer_id, k.customer_state, i.product_id, i.seller_id, i.price, i.freight_value, i.ingest_date FROM stg_order_items i JOIN core k USING (order_id)),
    wide AS (SELECT i.* EXCLUDE (ingest_date), k.payment_value AS order_payment_value, k.main_payment_type, i.ingest_date FROM items i LEFT JOIN core k USING (order_id)),
    days AS (SELECT order_purchase_date AS sales_date, count(DISTINCT order_id) AS orders_cnt, count(*) AS items_cnt, sum(price)::DECIMAL(18,2) AS gross_sales, sum(freight_value)::DECIMAL(18,2) AS freight_sum FROM items GROUP BY ALL),
    states AS (SELECT order_purchase_date AS sales_date, customer_state, count(DISTINCT order_id) AS orders_cnt, count(*) AS items_cnt, sum(price)::DECIMAL(18,2) AS gross_sales FROM items GROUP BY ALL),
    src AS (SELECT s.order_purchase_timestamp::DATE AS d, sum(i.price)::DECIMAL(18,2) AS v FROM stg_orders s JOIN stg_order_items i USING (order_id, ingest_date) GROUP BY ALL),
    recon AS (SELECT coalesce(sales_date, d) AS sales_date, coalesce(gross_sales, 0)::DECIMAL(18,2) AS mart_gross_sales, coalesce(v, 0)::DECIMAL(18,2) AS source_gross_sales, (coalesce(gross_sales, 0) - coalesce(v, 0))::DECIMAL(18,2) AS diff_amount FROM days FULL JOIN src ON sales_date = d),
    types AS (SELECT order_purchase_date AS sales_date, main_payment_type, count(*) AS orders_cnt, sum(payment_value)::DECIMAL(18,2) AS payment_sum, round(sum(payment_value)::DOUBLE / nullif(count(payment_value), 0), 6) AS avg_payment FROM core GROUP BY ALL),
    rolled AS (SELECT sales_date, sum(orders_cnt)::BIGINT AS orders_cnt, sum(items_cnt)::BIGINT AS items_cnt, sum(gross_sales)::DECIMAL(18,2) AS gross_sales FROM states GROUP BY ALL),
    measures AS (SELECT (SELECT count(*) FROM stg_orders) AS stg_orders, (SELECT count(*) FROM stg_order_items) AS stg_order_items, (SELECT count(*) FROM items) AS core_order_items, (SELECT count(*) FROM days) AS mart_sales_days,
        (SELECT count(*) FROM (SELECT 1 FROM wide GROUP BY order_id, order_item_id HAVING count(*) > 1)) AS duplicate_grain_rows,
        (SELECT count(*) FROM wide WHERE order_id IS NULL OR order_item_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR seller_id IS NULL) AS null_key_rows,
        (SELECT coalesce(max(abs(diff_amount)), 0)::DECIMAL(18,2) FROM recon) AS max_reconcile_diff)"""


def core(select: str) -> str:
    return f"WITH {CORE} {select}"


def span(source: str, layer: str, name: str, day: str, counted: str = "*") -> str:
    return f"SELECT '{layer}' AS layer_name, '{name}' AS object_name, coalesce(min({day})::VARCHAR, 'no data') AS date_from, coalesce(max({day})::VARCHAR, 'no data') AS date_to, count({counted}) AS rows_count FROM {source}"


MESSAGES = """said AS (SELECT *, CASE WHEN canonical_payload IS NULL THEN 'invalid_json_or_schema'
        WHEN NOT json_valid(canonical_payload) OR json_extract_string(canonical_payload, '$.order_id') IS NULL THEN 'missing_order_id'
        WHEN lower(canonical_payload_hash) <> sha256(canonical_payload) THEN 'canonical_payload_hash_mismatch' ELSE 'valid' END AS reason FROM bronze_orders)"""

PAYMENT_COLUMNS = {"order_id": False, "payment_sequential": True, "payment_type": False, "payment_installments": True, "payment_value": True}


def payment_cells(columns: dict[str, bool]) -> str:
    each = [
        f"SELECT strftime(ingest_date, '%Y-%m-%d') AS load_day, '{c}' AS column_name, {c}::VARCHAR AS value, {f'{c}::DOUBLE' if number else 'NULL::DOUBLE'} AS number FROM stg_order_payments" for c, number in columns.items()
    ]
    return "cells AS (" + " UNION ALL ".join(each) + "), freq AS (SELECT load_day, column_name, value, number, count(*) AS n FROM cells GROUP BY ALL)"


PROFILE = f"""{payment_cells(PAYMENT_COLUMNS)},
    patterns AS (SELECT column_name, any_value(value_pattern) AS p FROM load_baseline WHERE metric = 'pattern_share' AND table_name = 'stg_order_payments' GROUP BY ALL),
    base AS (SELECT load_day, column_name, count(*) AS total, count(value) AS known, count(*) FILTER (value IS NULL) / count(*) AS null_share,
        count(*) FILTER (trim(value, {BLANKS}) = '') / count(*) AS blank_share, count(DISTINCT value)::DOUBLE AS distinct_count, min(number) AS min_value, max(number) AS max_value, quantile_disc(number, 0.5) AS median_value,
        CASE WHEN any_value(p) IS NOT NULL AND count(value) > 0 THEN count(*) FILTER (regexp_full_match(value, p)) / count(value) END AS pattern_share
        FROM cells LEFT JOIN patterns USING (column_name) GROUP BY ALL),
    tops AS (SELECT load_day, column_name, max(n) AS most FROM freq WHERE value IS NOT NULL GROUP BY ALL),
    prof AS (SELECT base.*, coalesce(most, 0) / total AS top_share FROM base LEFT JOIN tops USING (load_day, column_name))"""

DRIFT_CELLS = payment_cells({"payment_type": False, "payment_installments": True, "payment_sequential": True})


def _orphans() -> str:
    def part(child: str, key: str, item: str, parent: str, parent_key: str) -> str:
        return f"""SELECT '{child}' AS child_table, lower(trim(c.order_id, {BLANKS})) AS child_order_id, {item} AS child_item_id, strftime(c.ingest_date, '%Y-%m-%d') AS ingest_day, {plain('c.' + key)} AS k
            FROM {child} c ASOF LEFT JOIN (
                SELECT k, d, max(alive) AS alive FROM (SELECT {plain(parent_key)} AS k, ingest_date AS d, 1 AS alive FROM {parent} UNION ALL SELECT {plain('key_value')}, removed_on, 0 FROM removed_keys WHERE table_name = '{parent}')
                GROUP BY ALL) e ON {plain('c.' + key)} = e.k AND c.ingest_date >= e.d
            WHERE {plain('c.' + key)} IS NOT NULL AND coalesce(e.alive, 0) = 0"""

    return f"orphans AS ({part('stg_order_items', 'order_id', 'c.order_item_id', 'stg_orders', 'order_id')} UNION ALL {part('stg_orders', 'customer_id', '0', 'stg_customers', 'customer_id')})"


def _shapes() -> str:
    names = {c.replace("_", ""): c for c in TARGET} | {k.replace("_", ""): v for k, v in OTHER_NAMES.items()}
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"""lines AS (SELECT file_id, producer, file_seq, unnest(string_split(body, chr(10))) AS line FROM landing_files WHERE producer IS NOT NULL),
    recs AS (SELECT file_id, producer, file_seq, line FROM lines WHERE CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' ELSE false END),
    files AS (SELECT DISTINCT file_id, producer, file_seq FROM recs),
    ordered AS (SELECT *, row_number() OVER w AS ord, lead(file_id) OVER w AS next_file FROM files WINDOW w AS (PARTITION BY producer ORDER BY file_seq, file_id)),
    cells AS (SELECT file_id, name, json_type(json_extract(line, '$."' || name || '"')) AS t FROM (SELECT file_id, line, unnest(json_keys(line)) AS name FROM recs)),
    fields AS (SELECT file_id, CASE lower(replace(name, '_', '')) {cases} ELSE name END AS field, any_value(name) AS name,
        min(CASE WHEN t = 'VARCHAR' THEN 'text' WHEN t IN ('UBIGINT', 'BIGINT') THEN 'whole' WHEN t = 'DOUBLE' THEN 'fraction' WHEN t = 'BOOLEAN' THEN 'truth' WHEN t = 'OBJECT' THEN 'object' WHEN t = 'ARRAY' THEN 'array' END) AS kind FROM cells GROUP BY ALL),
    seen AS (SELECT f.field, f.name, f.kind, o.*, lag(ord) OVER w AS ord_before, lead(ord) OVER w AS ord_after, lag(f.name) OVER w AS name_before, last_value(f.kind IGNORE NULLS) OVER (PARTITION BY producer, field ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kind_before
        FROM fields f JOIN ordered o USING (file_id) WINDOW w AS (PARTITION BY producer, field ORDER BY ord))"""


ORACLE: dict[str, str] = {
    "p1_found": f"WITH {_orphans()} SELECT DISTINCT child_table, child_order_id, child_item_id, ingest_day FROM orphans",
    "p1_counts": f"WITH {_orphans()} SELECT child_table, ingest_day, count(*) AS orphan_rows, count(DISTINCT k) AS orphan_keys FROM orphans GROUP BY ALL",
    "p2_found": "SELECT order_id, business_version, kafka_offset FROM (SELECT * FROM order_changes WHERE order_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY business_version DESC NULLS LAST, kafka_offset DESC NULLS LAST) = 1) WHERE lower(change_op) NOT IN ('d', 'delete')",
    "p2_state": """SELECT change_op, order_id, business_version, kafka_partition, kafka_offset, kafka_timestamp, customer, amount, country, status FROM (SELECT * FROM order_changes WHERE order_id IS NOT NULL QUALIFY row_number() OVER (
        PARTITION BY order_id ORDER BY business_version DESC NULLS LAST, kafka_offset DESC NULLS LAST, change_op DESC NULLS LAST, kafka_partition DESC NULLS LAST, kafka_timestamp DESC NULLS LAST) = 1) WHERE lower(change_op) NOT IN ('d', 'delete')""",
    "p3_found": f"""WITH {_shapes()} SELECT file_id, field AS field_name, 'added' AS change_kind FROM seen WHERE ord > 1 AND coalesce(ord_before, 0) <> ord - 1
        UNION SELECT next_file, field, 'removed' FROM seen WHERE next_file IS NOT NULL AND coalesce(ord_after, 0) <> ord + 1
        UNION SELECT file_id, field, 'renamed' FROM seen WHERE ord_before = ord - 1 AND name <> name_before
        UNION SELECT file_id, field, 'retyped' FROM seen WHERE ord_before = ord - 1 AND kind <> kind_before""",
    "p3_promoted": """WITH parts AS (SELECT file_id, string_split(body, chr(10)) AS l FROM landing_files WHERE producer IS NOT NULL), lines AS (SELECT file_id, unnest(range(len(l)))::INTEGER AS line_no, unnest(l) AS line FROM parts),
        recs AS (SELECT * FROM lines WHERE CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' ELSE false END)
        SELECT * FROM (SELECT file_id, line_no, json_extract_string(line, '$.currency') AS currency, json_extract_string(line, '$.channel') AS channel, json_extract_string(line, '$.coupon_code') AS coupon_code, json_extract_string(line, '$.warehouse_hint') AS warehouse_hint,
            json_extract_string(line, '$.is_gift')::BOOLEAN AS is_gift, json_extract_string(line, '$.priority')::INTEGER AS priority FROM recs) WHERE coalesce(currency, channel, coupon_code, warehouse_hint, is_gift::VARCHAR, priority::VARCHAR) IS NOT NULL""",
    "p3_unreadable": """WITH parts AS (SELECT file_id, string_split(body, chr(10)) AS l FROM landing_files WHERE producer IS NOT NULL), lines AS (SELECT file_id, unnest(range(len(l)))::INTEGER AS line_no, unnest(l) AS line FROM parts)
        SELECT file_id, line_no, line FROM lines WHERE length(trim(line)) > 0 AND NOT CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' ELSE false END""",
    "p4_found": "SELECT file_id FROM landing_files WHERE strlen(coalesce(body, '')) < 8192 AND file_id IN (SELECT file_id FROM file_log GROUP BY file_id HAVING arg_max(log_action, log_seq) = 'add')",
    "p4_records": """WITH small AS (SELECT * FROM landing_files WHERE strlen(coalesce(body, '')) < 8192 AND file_id IN (SELECT file_id FROM file_log GROUP BY file_id HAVING arg_max(log_action, log_seq) = 'add')),
        parts AS (SELECT event_date, file_id, list_filter(string_split(body, chr(10)), lambda x: length(trim(x)) > 0) AS l FROM small)
        SELECT event_date, file_id, unnest(range(len(l)))::INTEGER AS line_no, unnest(l) AS record FROM parts""",
    "p4_log_balance": """WITH entries AS (SELECT DISTINCT load_id, log_action, file_id FROM file_log), logged AS (SELECT load_id, count(*) FILTER (log_action = 'add') AS log_added, count(*) FILTER (log_action = 'remove') AS log_removed FROM entries GROUP BY ALL),
        said AS (SELECT load_id, max(files_added) AS said_added, max(files_removed) AS said_removed FROM lakehouse_metrics WHERE load_id IS NOT NULL GROUP BY ALL)
        SELECT load_id, log_added, log_removed, said_added, said_removed, log_added IS NOT DISTINCT FROM said_added AND log_removed IS NOT DISTINCT FROM said_removed AS agrees FROM logged FULL JOIN said USING (load_id)""",
    "p5_found": f"""WITH {PROFILE}, metrics AS (UNPIVOT (SELECT load_day, column_name, null_share, blank_share, top_share, pattern_share, distinct_count, min_value, max_value, median_value FROM prof) ON null_share, blank_share, top_share, pattern_share, distinct_count, min_value, max_value, median_value INTO NAME metric VALUE measured),
        runs AS (SELECT regexp_extract(ingestion_run_id, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS d, null_key_rows, duplicate_grain_rows FROM pipeline_runs WHERE ingestion_run_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY d ORDER BY run_ts DESC, run_id DESC) = 1),
        counted AS (SELECT strftime(ingest_date, '%Y-%m-%d') AS d, count(*) FILTER (order_id IS NULL OR order_item_id IS NULL OR product_id IS NULL OR seller_id IS NULL) AS nulls FROM stg_order_items GROUP BY ALL),
        twice AS (SELECT strftime(ingest_date, '%Y-%m-%d') AS d, count(*) AS dup FROM (SELECT ingest_date FROM stg_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL GROUP BY ingest_date, order_id, order_item_id HAVING count(*) > 1) GROUP BY ALL),
        compared AS (SELECT runs.*, coalesce(nulls, 0) AS nulls, coalesce(dup, 0) AS dup FROM runs LEFT JOIN counted USING (d) LEFT JOIN twice USING (d))
        SELECT table_name, column_name, metric, load_day FROM metrics JOIN (SELECT * FROM load_baseline WHERE table_name = 'stg_order_payments') USING (column_name, metric) WHERE measured < low_bound OR measured > high_bound
        UNION SELECT 'pipeline_runs', 'null_key_rows', 'recount', d FROM compared WHERE null_key_rows IS DISTINCT FROM nulls
        UNION SELECT 'pipeline_runs', 'duplicate_grain_rows', 'recount', d FROM compared WHERE duplicate_grain_rows IS DISTINCT FROM dup""",
    "p5_profile": f"""WITH {PROFILE} SELECT load_day, column_name, total AS "rows", round(null_share, 9) AS null_share, round(blank_share, 9) AS blank_share, round(top_share, 9) AS top_share, round(pattern_share, 9) AS pattern_share, distinct_count, min_value, max_value, median_value FROM prof""",
    "p5_drift": f"""WITH {DRIFT_CELLS}, totals AS (SELECT load_day, column_name, sum(n) AS total FROM freq GROUP BY ALL),
        pairs AS (SELECT *, lag(load_day) OVER w AS before_day, lag(total) OVER w AS before_total FROM totals WINDOW w AS (PARTITION BY column_name ORDER BY load_day)),
        both_loads AS (SELECT column_name, p.load_day, coalesce(value, '<null>') AS v, CASE WHEN f.load_day = p.load_day THEN n ELSE 0 END AS a, CASE WHEN f.load_day = p.before_day THEN n ELSE 0 END AS b, total, before_total FROM freq f JOIN pairs p USING (column_name) WHERE before_day IS NOT NULL AND f.load_day IN (p.load_day, p.before_day)),
        joined AS (SELECT column_name, load_day, v, sum(a) AS a, sum(b) AS b, any_value(total) AS ta, any_value(before_total) AS tb FROM both_loads GROUP BY ALL),
        parts AS (SELECT *, (a + b) * ta / (ta + tb) AS ea, (a + b) * tb / (ta + tb) AS eb, greatest(a / ta, 1e-6) AS p, greatest(b / tb, 1e-6) AS q FROM joined)
        SELECT column_name, load_day, round(sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb), 6) AS chi_square, count(*) - 1 AS degrees, round(sum((p - q) * ln(p / q)), 6) AS psi FROM parts GROUP BY ALL""",
    "p6_found": f"""SELECT e AS event_id, h AS canonical_payload_hash, kafka_partition, kafka_offset FROM (SELECT {plain('event_id')} AS e, coalesce({plain('canonical_payload_hash')}, '') AS h, kafka_timestamp, kafka_partition, kafka_offset FROM bronze_orders)
        WHERE e IS NOT NULL QUALIFY count(*) OVER (PARTITION BY e, h) > 1 AND row_number() OVER (PARTITION BY e, h ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1""",
    "p6_rows": f"""SELECT * EXCLUDE (e, h) FROM (SELECT *, {plain('event_id')} AS e, coalesce({plain('canonical_payload_hash')}, '') AS h FROM bronze_orders)
        QUALIFY e IS NULL OR row_number() OVER (PARTITION BY e, h ORDER BY kafka_timestamp, kafka_partition, kafka_offset, {', '.join(f'{c} NULLS FIRST' for c in TARGET)}) = 1""",
    "p7_found": """SELECT DISTINCT order_id, strftime(event_time AT TIME ZONE 'UTC', '%Y-%m-%d') AS event_day FROM (SELECT *, max(event_time) OVER (ORDER BY kafka_timestamp, kafka_partition, kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
        FROM streaming_orders WHERE event_time <= kafka_timestamp + INTERVAL 1 HOUR) WHERE event_time < high - INTERVAL 36 HOUR""",
    "p7_totals": f"""WITH taken AS (SELECT * FROM (SELECT *, max(event_time) OVER (ORDER BY kafka_timestamp, kafka_partition, kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM streaming_orders WHERE event_time <= kafka_timestamp + INTERVAL 1 HOUR) WHERE NOT coalesce(event_time < high - INTERVAL 36 HOUR, false)),
        once AS (SELECT (event_time AT TIME ZONE 'UTC')::DATE AS event_day, nullif(upper(trim(country, {BLANKS})), '') AS country, coalesce(kafka_partition, -1) AS source, kafka_offset, any_value(amount) AS amount FROM taken GROUP BY 1, 2, 3, 4)
        SELECT event_day, country, count(*) AS orders, coalesce(sum(amount), 0)::DECIMAL(38,2) AS amount FROM once GROUP BY ALL""",
    "gold_daily_metrics": f"WITH {SILVER} {GOLD}",
    "silver_latest": f"WITH {SILVER} SELECT {STATE} FROM silver",
    "silver_blend_nulls": f"WITH {BLEND} SELECT * FROM blend",
    "collapse_conflicts": "SELECT order_id, business_version, count(*) AS payloads FROM (SELECT DISTINCT order_id, business_version, customer, amount, country, status, event_time, event_date FROM bronze_orders WHERE order_id IS NOT NULL AND business_version IS NOT NULL) GROUP BY ALL HAVING count(*) > 1",
    "resolve_decisions": f"""WITH {SIDES} SELECT i.order_id, i.business_version, c.business_version AS current_version, CASE WHEN c.order_id IS NULL THEN 'insert' WHEN i.business_version > c.business_version THEN 'update'
        WHEN i.business_version < c.business_version THEN 'stale' WHEN {SAME} THEN 'replay' ELSE 'conflict' END AS decision FROM inc i LEFT JOIN cur c USING (order_id)""",
    "conditional_merge": f"""WITH {SIDES}, picked AS (SELECT *, 1 AS side FROM cur UNION ALL SELECT *, 2 FROM inc) SELECT order_id, business_version, kafka_partition, kafka_offset, amount, status FROM picked
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY business_version DESC, side) = 1""",
    "serving_upsert": """WITH batch AS (SELECT order_id, customer, amount::DECIMAL(14,2) AS amount, country, status, business_version, kafka_partition, kafka_offset FROM bronze_orders WHERE order_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY business_version DESC NULLS LAST, kafka_offset DESC NULLS FIRST, customer DESC NULLS LAST, amount::DECIMAL(14,2) DESC NULLS LAST, country DESC NULLS LAST, status DESC NULLS LAST, kafka_partition DESC NULLS LAST) = 1),
        stored AS (SELECT order_id, customer, amount, country, status, business_version, kafka_partition, kafka_offset FROM streaming_orders),
        won AS (SELECT b.* FROM batch b LEFT JOIN stored s USING (order_id) WHERE s.order_id IS NULL OR (b.business_version IS NOT NULL AND (s.business_version IS NULL OR b.business_version > s.business_version)))
        SELECT * FROM won UNION ALL SELECT * FROM stored WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM won)""",
    "country_totals": """SELECT coalesce(country, 'UNKNOWN') AS country, count(*) AS orders_count, coalesce(sum(amount), 0)::DECIMAL(18,2) AS total_amount, coalesce(round(sum(amount)::DOUBLE / nullif(count(amount), 0), 6), 0.0::DOUBLE) AS avg_amount,
        max(event_time) AT TIME ZONE 'UTC' AS last_event_time FROM streaming_orders GROUP BY coalesce(country, 'UNKNOWN')""",
    "quality_violations": """SELECT * FROM (SELECT 'order_id_null' AS rule, count(*) AS violations FROM bronze_orders WHERE order_id IS NULL UNION ALL SELECT 'amount_null_or_nonpositive', count(*) FROM bronze_orders WHERE amount IS NULL OR amount <= 0
        UNION ALL SELECT 'country_null', count(*) FROM bronze_orders WHERE country IS NULL UNION ALL SELECT 'status_invalid', count(*) FROM bronze_orders WHERE status IS NULL OR status NOT IN ('created', 'paid', 'shipped', 'delivered')
        UNION ALL SELECT 'event_time_null', count(*) FROM bronze_orders WHERE event_time IS NULL) WHERE violations > 0""",
    "quality_valid_split": """SELECT event_date, order_id IS NOT NULL AND coalesce(amount > 0, false) AND country IS NOT NULL AND coalesce(status IN ('created', 'paid', 'shipped', 'delivered'), false) AND event_time IS NOT NULL AS valid, count(*) AS "rows" FROM bronze_orders GROUP BY ALL""",
    "shadow_compare": f"""WITH {SILVER}, {BLEND}, pairs AS (SELECT s.order_id, [x FOR x IN [{', '.join(f"CASE WHEN b.{c} IS DISTINCT FROM s.{c} THEN '{c}' END" for c in ('business_version', 'customer', 'amount', 'country', 'status', 'event_time', 'event_date'))}] IF x IS NOT NULL] AS l
        FROM silver s JOIN blend b ON s.order_id IS NOT DISTINCT FROM b.order_id)
        SELECT order_id, CASE WHEN l = ['business_version'] THEN 'business_version_mismatch' ELSE 'payload_mismatch' END AS mismatch_type, '' AS side, array_to_string(l, ',') AS differing FROM pairs WHERE len(l) > 0""",
    "dead_letter_reasons": f'WITH {MESSAGES} SELECT reason, count(*) AS "rows" FROM said GROUP BY ALL',
    "reconciliation_counts": f"WITH {MESSAGES} SELECT kafka_partition, count(*) AS observed, count(*) FILTER (reason = 'valid') AS valid, count(*) FILTER (reason <> 'valid') AS dead_letter, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset FROM said GROUP BY ALL",
    "event_dedup": "SELECT event_id, kafka_timestamp, kafka_partition, kafka_offset FROM bronze_orders WHERE event_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1",
    "payload_hash_check": """SELECT event_date, CASE WHEN canonical_payload IS NULL OR canonical_payload_hash IS NULL THEN 'absent' WHEN lower(canonical_payload_hash) <> sha256(canonical_payload) THEN 'differs' ELSE 'matches' END AS verdict, count(*) AS "rows" FROM bronze_orders GROUP BY ALL""",
    "semantic_current_orders": f"WITH {SILVER} SELECT order_id, customer, amount, country, status, event_time, event_date, business_version FROM silver",
    "semantic_daily_metrics": f"WITH {SILVER}, gold AS ({GOLD}) SELECT event_date AS order_date, * EXCLUDE (event_date) FROM gold",
    "legacy_profile": """WITH per AS (SELECT order_id, count(*) FILTER (business_version IS NULL) AS n, count(*) FILTER (business_version IS NOT NULL) AS v FROM bronze_orders GROUP BY ALL),
        kinds AS (SELECT order_id, count(*) AS k FROM (SELECT DISTINCT order_id, customer, amount, country, status, event_time, event_date FROM bronze_orders WHERE business_version IS NULL) GROUP BY ALL)
        SELECT sum(n + v)::BIGINT AS total_rows, sum(n)::BIGINT AS null_rows, count(*) FILTER (n > 0) AS distinct_null_order_ids, count(*) FILTER (n > 1) AS duplicate_order_ids, (SELECT count(*) FROM kinds WHERE k > 1) AS payload_conflict_order_ids,
        count(*) FILTER (n > 0 AND v > 0) AS overlapping_order_ids, sum(v)::BIGINT AS versioned_rows, coalesce(sum(n) FILTER (order_id IS NULL), 0)::BIGINT AS null_order_ids FROM per""",
    "layer_probes": f"""WITH {SILVER}, gold AS ({GOLD}) SELECT * FROM (SELECT count(*) AS bronze_rows, max(business_version) AS max_version, count(DISTINCT order_id) AS bronze_ids FROM bronze_orders),
        (SELECT count(*) AS silver_rows, count(DISTINCT order_id) AS silver_ids, count(*) FILTER (order_id IS NULL) AS null_ids, count(*) FILTER (country IS NULL) AS null_countries, count(*) FILTER (event_date IS NULL) AS null_days FROM silver),
        (SELECT count(*) AS gold_rows, sum(orders_count)::BIGINT AS gold_orders, sum(total_amount)::DECIMAL(18,2) AS gold_amount FROM gold)""",
    "latest_status_per_source": """SELECT source, status, duration_ms, strftime(metric_ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS metric_at, records FROM (SELECT *, count(*) OVER (PARTITION BY source) AS records FROM lakehouse_metrics)
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY metric_ts DESC, status DESC NULLS LAST, duration_ms DESC NULLS LAST) = 1""",
    "metrics_by_status": "SELECT source, status, count(*) AS records, round(sum(duration_ms)::DOUBLE / nullif(count(duration_ms), 0), 6) AS avg_duration_ms FROM lakehouse_metrics GROUP BY ALL",
    "manifest_disposition": """WITH last_entry AS (SELECT file_id, arg_max(log_action, log_seq) AS last_action FROM file_log GROUP BY ALL), entries AS (SELECT load_id, file_id, bool_or(log_action = 'add') AS added FROM file_log GROUP BY ALL),
        per AS (SELECT load_id, count(*) FILTER (added) AS added_files, count(*) FILTER (added AND last_action = 'add') AS live_files, count(*) FILTER (NOT added) AS removed_files FROM entries JOIN last_entry USING (file_id) GROUP BY ALL)
        SELECT *, CASE WHEN added_files = 0 THEN 'removes_only' WHEN live_files = 0 THEN 'stale' WHEN live_files = added_files THEN 'live' ELSE 'mixed' END AS disposition FROM per""",
    "digest_set": "SELECT load_id, count(*) AS files, sum(('0x' || substr(md5(log_action || '|' || file_id), 1, 15))::BIGINT)::VARCHAR AS digest FROM (SELECT DISTINCT load_id, log_action, file_id FROM file_log) GROUP BY ALL",
    "core_orders": core("SELECT * FROM core"),
    "core_order_items": core("SELECT * FROM items"),
    "order_items_wide": core("SELECT * FROM wide"),
    "sales_daily": core("SELECT * FROM days"),
    "customer_state_daily": core("SELECT * FROM states"),
    "reconcile_sales_daily": core("SELECT * FROM recon"),
    "reconcile_breaks": core("SELECT * FROM recon WHERE abs(diff_amount) > 0.01 ORDER BY sales_date"),
    "payment_type_daily": core("SELECT * FROM types"),
    "expected_vs_actual_full_join": core("""SELECT coalesce(e.sales_date, a.sales_date) AS sales_date, coalesce(e.main_payment_type, a.main_payment_type) AS main_payment_type, e.orders_cnt AS expected_orders, a.orders_cnt AS actual_orders, e.payment_sum AS expected_sum, a.payment_sum AS actual_sum
        FROM types e FULL JOIN (SELECT s.order_purchase_timestamp::DATE AS sales_date, main_payment_type, count(*) AS orders_cnt, sum(payment_value)::DECIMAL(18,2) AS payment_sum FROM stg_orders s LEFT JOIN pay USING (order_id, ingest_date) GROUP BY ALL) a
        ON e.sales_date = a.sales_date AND e.main_payment_type = a.main_payment_type WHERE e.orders_cnt IS DISTINCT FROM a.orders_cnt OR e.payment_sum IS DISTINCT FROM a.payment_sum"""),
    "payment_reconciliation": core("""SELECT s AS staging_payment_total, c AS core_payment_total, (s - c)::DECIMAL(18,2) AS diff_amount FROM (SELECT coalesce(sum(payment_value), 0)::DECIMAL(18,2) AS s FROM stg_order_payments), (SELECT coalesce(sum(payment_value), 0)::DECIMAL(18,2) AS c FROM core) WHERE abs(s - c) > 0.01"""),
    "rollup_invariant": core("""SELECT *, 'left' AS unmatched_side FROM (SELECT sales_date, orders_cnt, items_cnt, gross_sales FROM days EXCEPT SELECT * FROM rolled) UNION ALL SELECT *, 'right' FROM (SELECT * FROM rolled EXCEPT SELECT sales_date, orders_cnt, items_cnt, gross_sales FROM days)"""),
    "except_both_ways": core("""SELECT *, 'left' AS unmatched_side FROM (SELECT order_id, ingest_date FROM stg_orders EXCEPT SELECT order_id, ingest_date FROM core) UNION ALL SELECT *, 'right' FROM (SELECT order_id, ingest_date FROM core EXCEPT SELECT order_id, ingest_date FROM stg_orders)"""),
    "sales_mart": "SELECT event_time::DATE AS order_date, count(DISTINCT order_id) AS orders, sum(amount::DECIMAL(18,2))::DECIMAL(18,2) AS amount FROM bronze_orders GROUP BY ALL",
    "mart_first_days": core("SELECT * FROM days WHERE sales_date IS NOT NULL ORDER BY sales_date LIMIT 15"),
    "top_states": core("SELECT customer_state, sum(orders_cnt)::BIGINT AS orders_cnt, sum(items_cnt)::BIGINT AS items_cnt, sum(gross_sales)::DECIMAL(18,2) AS gross_sales FROM states GROUP BY ALL ORDER BY gross_sales DESC NULLS LAST, customer_state NULLS LAST LIMIT 10"),
    "layer_snapshot": core(" UNION ALL ".join([
        span("stg_orders", "stg", "orders", "order_purchase_timestamp::DATE"), span("stg_order_items i LEFT JOIN stg_orders s USING (order_id, ingest_date)", "stg", "order_items", "s.order_purchase_timestamp::DATE"), span("core", "core", "orders", "order_purchase_date"),
        span("items", "core", "order_items", "order_purchase_date"), span("days", "marts", "sales_daily", "sales_date"), span("states", "marts", "customer_state_daily", "sales_date")])),
    "grain_checks": core("""SELECT 'order_items_wide grain' AS check_name, count(*) AS failed_rows FROM (SELECT 1 FROM wide GROUP BY order_id, order_item_id HAVING count(*) > 1) UNION ALL SELECT 'core_orders grain', count(*) FROM (SELECT 1 FROM core GROUP BY order_id HAVING count(*) > 1)"""),
    "null_keys": core("""SELECT 'null grain keys' AS check_name, count(*) AS failed_rows FROM wide WHERE order_id IS NULL OR order_item_id IS NULL UNION ALL SELECT 'null business keys', count(*) FROM wide WHERE customer_id IS NULL OR product_id IS NULL OR seller_id IS NULL"""),
    "unique_check": "SELECT order_id, order_item_id, ingest_date, count(*) AS copies FROM stg_order_items GROUP BY ALL HAVING count(*) > 1",
    "accepted_values": """SELECT status, count(*) AS "rows" FROM bronze_orders WHERE status NOT IN ('created', 'paid', 'shipped', 'delivered') GROUP BY ALL""",
    "pipeline_audit": core("SELECT *, CASE WHEN duplicate_grain_rows = 0 AND null_key_rows = 0 AND max_reconcile_diff <= 0.01 THEN 'success' ELSE 'failed' END AS status FROM measures"),
    "quality_scorecard": core("""SELECT check_name, metric_value::DECIMAL(18,2) AS metric_value, CASE WHEN good THEN 'ok' ELSE 'fail' END AS status FROM (
        SELECT 'stg_orders loaded' AS check_name, stg_orders AS metric_value, stg_orders > 0 AS good FROM measures UNION ALL SELECT 'stg_order_items loaded', stg_order_items, stg_order_items > 0 FROM measures
        UNION ALL SELECT 'core matches stg order_items', core_order_items - stg_order_items, core_order_items = stg_order_items FROM measures UNION ALL SELECT 'duplicate grain rows', duplicate_grain_rows, duplicate_grain_rows = 0 FROM measures
        UNION ALL SELECT 'null business keys', null_key_rows, null_key_rows = 0 FROM measures UNION ALL SELECT 'max reconcile diff', max_reconcile_diff, max_reconcile_diff <= 0.01 FROM measures)"""),
    "warehouse_snapshot": core("""SELECT (SELECT count(*) FROM stg_orders) AS stg_orders, (SELECT count(*) FROM stg_order_items) AS stg_order_items, (SELECT count(*) FROM stg_customers) AS stg_customers, (SELECT count(*) FROM stg_order_payments) AS stg_order_payments,
        (SELECT coalesce(sum(payment_value), 0)::DECIMAL(18,2) FROM stg_order_payments) AS staged_payments, (SELECT count(*) FROM core) AS core_orders, (SELECT coalesce(sum(payment_value), 0)::DECIMAL(18,2) FROM core) AS core_payments, (SELECT count(*) FROM items) AS core_order_items, (SELECT count(*) FROM days) AS sales_days, (SELECT coalesce(max(abs(diff_amount)), 0)::DECIMAL(18,2) FROM recon) AS max_reconcile_diff"""),
    "recent_runs": "SELECT run_id, strftime(run_ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS run_at, status, stg_orders, stg_order_items, core_order_items, mart_sales_days, duplicate_grain_rows, null_key_rows, max_reconcile_diff FROM pipeline_runs ORDER BY run_ts DESC, run_id DESC LIMIT 5",
    "run_health": "SELECT ingestion_run_id, count(*) AS runs, bool_and(status = 'success') AS all_good, strftime(max(run_ts) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_run_at FROM pipeline_runs GROUP BY ALL",
    "multiset_match": """WITH there AS (SELECT order_id, payment_value AS price, count(*) AS available FROM stg_order_payments GROUP BY ALL),
        claims AS (SELECT order_id, price, ingest_date, row_number() OVER (PARTITION BY order_id, price ORDER BY ingest_date) AS turn FROM stg_order_items WHERE order_id IS NOT NULL AND price IS NOT NULL)
        SELECT ingest_date, count(*) FILTER (turn <= available) AS matched, count(*) FILTER (coalesce(turn > available, true)) AS unmatched FROM claims LEFT JOIN there USING (order_id, price) GROUP BY ALL""",
    "like_prefixes": """SELECT started, status || '/' || started AS label, count(*) AS runs FROM (SELECT status, CASE WHEN ingestion_run_id LIKE 'scheduled%' THEN 'scheduled' WHEN ingestion_run_id LIKE 'manual%' THEN 'manual' WHEN ingestion_run_id IS NULL THEN 'unknown' ELSE 'other' END AS started FROM pipeline_runs) GROUP BY ALL""",
    "file_mix": """SELECT event_date, CASE WHEN strlen(body) = 0 THEN 'empty' WHEN strlen(body) < 1024 THEN 'tiny' WHEN strlen(body) < 8192 THEN 'small' ELSE 'large' END AS size_class, count(*) AS files, sum(strlen(body))::BIGINT AS bytes FROM landing_files GROUP BY ALL""",
    "stale_sources": """SELECT source, count(*) FILTER (status NOT IN ('success', 'ok', 'noop') OR status IS NULL) AS failures, ((epoch_us((SELECT max(metric_ts) FROM lakehouse_metrics)) - epoch_us(max(metric_ts) FILTER (status IN ('success', 'ok', 'noop')))) // 1000000)::BIGINT AS seconds_since_success FROM lakehouse_metrics GROUP BY source""",
    "failure_increase": """WITH per AS (SELECT source, epoch_us(metric_ts) // 60000000 AS minute, count(*) FILTER (status NOT IN ('success', 'ok', 'noop')) AS failures FROM lakehouse_metrics GROUP BY ALL),
        ten AS (SELECT source, minute, sum(failures) OVER (PARTITION BY source ORDER BY minute RANGE BETWEEN 9 PRECEDING AND CURRENT ROW)::BIGINT AS increase FROM per)
        SELECT source, minute, increase, round(increase / 600, 9) AS rate FROM ten WHERE increase > 0""",
    "current_conflicts": f"""WITH {SIDES} SELECT i.order_id, i.business_version, c.amount AS current_amount, i.amount AS incoming_amount FROM inc i JOIN cur c USING (order_id, business_version) WHERE c.amount IS DISTINCT FROM i.amount OR c.status IS DISTINCT FROM i.status""",
    "largest_payment": """SELECT ingest_date, row_number() OVER (PARTITION BY ingest_date ORDER BY payment_value DESC)::INTEGER AS place, payment_value FROM (SELECT DISTINCT ingest_date, order_id, payment_sequential, payment_value FROM stg_order_payments WHERE payment_value IS NOT NULL) QUALIFY place <= 3""",
}

GOOD = """good AS (SELECT order_id, customer, amount, country, status, (event_time AT TIME ZONE 'UTC')::DATE AS event_date, business_version FROM streaming_orders WHERE order_id <> '' AND business_version IS NOT NULL),
    lake AS (SELECT order_id, customer, amount, country, CASE WHEN status = 'paid' THEN 'delivered' ELSE status END AS status, event_date, business_version + CASE WHEN status = 'paid' THEN 1 ELSE 0 END AS business_version FROM good)"""
SENT = """sent AS (SELECT *, CASE WHEN order_id IS NULL THEN 'missing_order_id' WHEN lower(canonical_payload_hash) <> sha256(canonical_payload) THEN 'canonical_payload_hash_mismatch' ELSE 'valid' END AS reason FROM bronze_orders)"""

ORACLE |= {
    "snapshot_replace": f"WITH {SIDES} SELECT order_id, business_version, kafka_partition, kafka_offset FROM inc UNION ALL SELECT order_id, business_version, kafka_partition, kafka_offset FROM cur WHERE order_id NOT IN (SELECT order_id FROM inc)",
    "snapshot_history": f"""WITH {SIDES}, after AS (SELECT order_id, business_version FROM inc UNION ALL SELECT order_id, business_version FROM cur WHERE order_id NOT IN (SELECT order_id FROM inc))
        SELECT 1 AS snapshot_id, NULL AS parent_id, 'append' AS operation, count(*) AS listed_rows, count(*) AS read_rows, max(business_version) AS max_version FROM cur
        UNION ALL SELECT 2, 1, 'replace', count(*), count(*), max(business_version) FROM after""",
    "snapshot_keyed_read": f"WITH {SILVER} SELECT order_id, business_version, country FROM silver WHERE order_id IN (SELECT order_id FROM streaming_orders WHERE status = 'created' AND order_id IS NOT NULL)",
    "snapshot_services": 'SELECT event_date, count(*) AS "rows", 1 AS versions, 0 AS orphans FROM bronze_orders GROUP BY event_date',
    "snapshot_evolution": 'SELECT business_version IS NULL AS unversioned, count(*) AS "rows", 0 AS rows_now FROM bronze_orders GROUP BY 1',
    "audit_upsert": "SELECT run_id, CASE WHEN status = 'success' THEN status ELSE 'running' END AS status, stg_orders, null_key_rows FROM pipeline_runs",
    "lake_silver": f"WITH {GOOD} SELECT order_id, business_version, status, event_date FROM lake",
    "lake_gold": f"WITH {GOOD} SELECT event_date, country, status, count(order_id) AS orders_count, sum(amount)::DECIMAL(18,2) AS total_amount, count(DISTINCT customer) AS distinct_customers FROM lake GROUP BY ALL",
    "lake_receipts": f"""WITH {GOOD} SELECT 1 AS sequence, 'success' AS result, count(*) AS changed_keys, count(*) AS bronze_rows FROM good UNION ALL SELECT 2, 'success', count(*), count(*) FROM good WHERE status = 'paid'""",
    "stream_receipts": f"WITH {SENT} SELECT kafka_partition, count(*) AS observed, count(*) FILTER (reason = 'valid') AS valid, count(*) FILTER (reason <> 'valid') AS dead_letter, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset FROM sent GROUP BY ALL",
    "stream_landing": f"""WITH {SENT} SELECT event_time::DATE AS event_date, count(*) AS "rows", count(DISTINCT order_id) AS orders FROM sent WHERE reason = 'valid' GROUP BY ALL""",
    "stream_dead_letters": f"""WITH {SENT} SELECT kafka_timestamp::DATE AS dead_letter_date, reason AS dead_letter_reason, count(*) AS "rows" FROM sent WHERE reason <> 'valid' GROUP BY ALL""",
    "stream_serving": f"""WITH {SENT} SELECT order_id, business_version, kafka_offset FROM sent WHERE reason = 'valid'
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY business_version DESC NULLS LAST, kafka_offset DESC NULLS FIRST) = 1""",
    "stream_epoch": """WITH sent AS (SELECT event_id, event_time, CASE WHEN order_id IS NULL THEN 'missing_order_id' WHEN source_epoch_id IS NULL THEN 'missing_source_epoch_id' WHEN source_epoch_id <> 'epoch-2015-03-01' THEN 'source_epoch_mismatch' WHEN event_id IS NULL THEN 'missing_event_id'
            WHEN canonical_payload IS NULL OR canonical_payload_hash IS NULL THEN 'missing_canonical_lineage' WHEN lower(canonical_payload_hash) <> sha256(canonical_payload) THEN 'canonical_payload_hash_mismatch' ELSE 'valid' END AS reason FROM bronze_orders)
        SELECT 'landed' AS outcome, count(DISTINCT event_id) AS "rows" FROM sent WHERE reason = 'valid' AND coalesce(event_time > TIMESTAMP '1970-01-01', true) UNION ALL SELECT reason, count(*) FROM sent WHERE reason <> 'valid' GROUP BY ALL""",
    "csv_staging": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS file_records, count(*) AS loaded_rows, 0 AS only_loaded, 0 AS only_stored FROM stg_{t}" for t in ("orders", "order_items", "order_payments", "customers")),
    "published_marts": core("SELECT sales_date, 'sales_daily' AS mart, orders_cnt, items_cnt, gross_sales FROM days UNION ALL SELECT sales_date, 'customer_state_daily', orders_cnt, items_cnt, gross_sales FROM states"),
    "catalog_columns": "SELECT table_name, ordinal_position - 1 AS position, column_name FROM information_schema.columns WHERE table_name IN ('stg_orders', 'stg_order_items', 'stg_order_payments', 'stg_customers', 'bronze_orders', 'streaming_orders')",
    "canonical_digests": """WITH texts AS (SELECT country, to_json({'business_version': business_version, 'country': country, 'customer': customer, 'order_id': order_id, 'status': status})::VARCHAR AS t FROM streaming_orders)
        SELECT country, count(*) AS "rows", sum(length(t))::BIGINT AS characters, sum(('0x' || substr(sha256(t), 1, 15))::BIGINT)::VARCHAR AS digest FROM texts GROUP BY ALL""",
    "equal_as_multisets": """SELECT 'itself' AS compared, true AS equal UNION ALL SELECT 'without repeats', (SELECT count(*) FROM stg_order_payments) = (SELECT count(*) FROM (SELECT DISTINCT * FROM stg_order_payments))
        UNION ALL SELECT 'orders and items', NOT EXISTS (SELECT order_id FROM stg_order_payments EXCEPT ALL SELECT order_id FROM stg_order_items) AND NOT EXISTS (SELECT order_id FROM stg_order_items EXCEPT ALL SELECT order_id FROM stg_order_payments)""",
    "files_never_landed": """SELECT *, 'left' AS unmatched_side FROM (SELECT file_id FROM file_log WHERE log_action = 'add' EXCEPT SELECT file_id FROM landing_files) UNION ALL SELECT *, 'right' FROM (SELECT file_id FROM landing_files EXCEPT SELECT file_id FROM file_log WHERE log_action = 'add')""",
    "synthetic_orders": 'SELECT count(*) AS "rows", count(*) AS keys, 0 AS outside FROM stg_orders',
}
