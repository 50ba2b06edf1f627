"""The same questions in plain SQL over the given tables, written independently.

Joins come before aggregation here and averages are exact integer arithmetic, so the two
sides share no method, only the result.
"""

from __future__ import annotations

from ledgermill.functions import fixed


def mean(value: str, scale: int, digits: int) -> str:
    """Average of a non-negative decimal, rounded half up to ``digits`` places, as double."""
    units = f"SUM(CAST({value} * {10 ** scale} AS HUGEINT))"
    rows = f"COUNT({value})"
    return (
        f"CAST((2 * {units} * {10 ** (digits - scale)} + {rows}) // (2 * {rows}) AS DOUBLE)"
        f" / {10 ** digits}.0::DOUBLE"
    )


def percent(part: str, whole: str, digits: int) -> str:
    scaled = 100 * 10 ** digits
    return (
        f"CAST((2 * CAST({part} AS HUGEINT) * {scaled} + {whole}) // (2 * {whole}) AS DOUBLE)"
        f" / {10 ** digits}.0::DOUBLE"
    )


def as_double(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def moment(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%g')"


def day(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


TX = """tx AS (
  SELECT o_orderkey AS transaction_id,
         o_custkey + CASE WHEN o_custkey % 50 = 7 THEN 1 ELSE 0 END AS customer_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CASE WHEN o_orderkey % 211 <> 5 THEN
              CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.020 AS DECIMAL(10,2)) END AS transaction_amount,
         CASE o_orderkey % 97 WHEN 0 THEN '  ' WHEN 1 THEN ''
              ELSE ' ' || lower(o_orderpriority) || ' ' END AS transaction_type,
         CASE WHEN o_orderstatus = 'P' THEN 'STREAMING' ELSE 'HISTORICAL' END AS data_source,
         o_orderdate AS ingestion_timestamp
  FROM orders)"""

STG_TX = (
    TX
    + """, stx AS (
  SELECT transaction_id, customer_id, transaction_date, transaction_amount,
         upper(trim(transaction_type, ' ')) AS transaction_type, data_source,
         CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month,
         CASE WHEN transaction_amount > 5000 THEN 'High'
              WHEN transaction_amount > 1000 THEN 'Medium' ELSE 'Low' END AS amount_category,  -- unknown: Low
         ingestion_timestamp
  FROM tx)"""
)

_TYPE_NAMES = [name for name, *_ in fixed.TYPE_RULES] + ["hobby_expense", "gift_purchase"]

TYPED = f"""typed AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(CAST(o_totalprice AS DECIMAL(12,2))
              * CASE WHEN o_orderkey % 20 = 0 THEN 0.150 ELSE 0.002 END AS DECIMAL(10,2)) AS transaction_amount,
         {_TYPE_NAMES}[o_orderkey % 12 + 1] AS transaction_type,
         o_orderkey % 20 = 0 AS is_anomaly
  FROM orders)"""

RULES = (
    "rules(transaction_type, expected_percent, lowest, highest) AS (VALUES "
    + ", ".join(f"('{n}', {p}, {lo}, {hi})" for n, p, lo, hi in fixed.TYPE_RULES)
    + ")"
)

CUST = """cust AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 25 = 0 OR c_custkey % 100 = 7 THEN NULL
              WHEN c_custkey % 40 = 3 THEN c_custkey + 1000000000 ELSE c_custkey END AS loan_record_id,
         ' ' || lower(c_name) || ' ' AS first_name, c_name AS last_name,
         '(212) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone_number
  FROM customer)"""

STG_CUST = (
    CUST
    + """, scust AS (
  SELECT customer_id, upper(trim(first_name)) AS first_name, '***' AS last_name,
         right(phone_number, 4) AS phone_clean, loan_record_id,
         loan_record_id IS NOT NULL AS has_mortgage
  FROM cust)"""
)

MORT = """mort AS (
  SELECT p_partkey AS part_key, p_partkey AS loan_record_id, CAST(p_partkey AS VARCHAR) AS loan_id,
         CAST(DATE '2024-01-01' + CAST(p_partkey % 52 * 7 AS INTEGER) AS DATE) AS week_start_date,
         CAST(p_partkey % 52 AS INTEGER) AS week, 't' || p_partkey AS ts,
         CASE p_type WHEN 'PROMO' THEN 'FSA/RHS-guaranteed' WHEN 'SMALL' THEN ' FHA-insured '
              WHEN 'LARGE' THEN 'VA-guaranteed' WHEN 'MEDIUM' THEN 'va-guaranteed' ELSE p_type END AS loan_type_name,
         ' ' || p_name || '.re-fi' AS loan_purpose_name,
         CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size END AS income_units,
         CAST(p_retailprice AS DECIMAL(10,2)) AS loan_amount_000s,
         p_brand || '-x_y.' AS county_name, CAST(p_partkey % 2 AS INTEGER) AS mortgageresponse
  FROM part)"""

STG_MORT = (
    MORT
    + """, smort AS (
  SELECT loan_record_id, loan_id, week_start_date, week,
         upper(trim(loan_type_name)) AS loan_type, upper(trim(loan_purpose_name)) AS loan_purpose,
         CAST(income_units * 1000 AS DOUBLE) AS applicant_income,
         CAST(loan_amount_000s * 1000 AS DOUBLE) AS loan_amount,
         upper(trim(county_name)) AS county, mortgageresponse AS mortgage_approved,
         CASE WHEN income_units > 0 THEN
              CAST((2 * CAST(loan_amount_000s * 100 AS BIGINT) + income_units) // (2 * income_units) AS DOUBLE) / 100
         END AS debt_to_income_ratio
  FROM mort)"""
)

HISTORY = (
    MORT
    + """, latest AS (
  SELECT * FROM (
    SELECT * REPLACE (part_key // 2 AS loan_record_id),
           TIMESTAMP '2024-01-01' + to_minutes(part_key * 7919 % 1000) AS created_at
    FROM mort WHERE part_key % 50 <> 0)
  QUALIFY row_number() OVER (PARTITION BY loan_record_id ORDER BY created_at DESC) = 1)"""
)

C360 = (
    f"{STG_CUST}, {STG_MORT}, {STG_TX}"
    + f""", joined AS (
  SELECT c.*, m.loan_amount, m.applicant_income, m.debt_to_income_ratio, m.loan_type, m.county,
         t.transaction_id, t.transaction_amount, t.transaction_date, t.transaction_month
  FROM scust c LEFT JOIN smort m USING (loan_record_id) LEFT JOIN stx t ON t.customer_id = c.customer_id),
c360 AS (
  SELECT customer_id, first_name, last_name, phone_clean, has_mortgage, loan_amount, applicant_income,
         debt_to_income_ratio, loan_type, county,
         COUNT(transaction_id) AS total_transactions,
         SUM(transaction_amount) AS total_spent,
         {mean('transaction_amount', 2, 6)} AS avg_transaction,
         MAX(transaction_date) AS last_transaction_date,
         COUNT(DISTINCT transaction_month) AS active_months,
         CASE WHEN SUM(transaction_amount) > 50000 THEN 'Premium'
              WHEN SUM(transaction_amount) > 15000 THEN 'Standard' ELSE 'Basic' END AS customer_tier  -- no spend: Basic
  FROM joined GROUP BY ALL)"""
)

SHOWN_TYPES = "('5-LOW', '1-URGENT', '3-MEDIUM')"


def shown(days: int) -> str:
    return (
        STG_TX
        + f""", shown AS (
  SELECT transaction_id, customer_id, transaction_type, transaction_amount AS amount, transaction_date,
         data_source AS description
  FROM stx WHERE transaction_date >= DATE '2001-08-01' - {days} AND transaction_type IN {SHOWN_TYPES})"""
    )


_SHOWN_COLUMNS = (
    f"transaction_id, customer_id, transaction_type, {as_double('amount')} AS amount, "
    f"{day('transaction_date')} AS transaction_date, description"
)

CDC = """cdc AS (
  SELECT event_id AS transaction_id, user_id, date_trunc('milliseconds', ts) AS committed,
         CASE event_type WHEN 'click' THEN 'UPDATE' WHEN 'error' THEN 'DELETE' ELSE 'INSERT' END AS cdc_action,
         event_type, CAST(ts AS DATE) AS event_day,
         CAST(CAST(value AS DECIMAL(10,2)) * 37.5 AS DECIMAL(10,2)) AS cents
  FROM events),
ev AS (
  SELECT transaction_id, cdc_action, committed, 'K' || user_id AS row_key, 'u' || (user_id % 10) AS db_user,
         CASE WHEN cdc_action <> 'DELETE' THEN user_id END AS customer_id,
         CASE WHEN cdc_action <> 'DELETE' THEN event_type || '-' || (user_id % 3) END AS transaction_type,
         CASE WHEN cdc_action <> 'DELETE' THEN CAST(cents AS DECIMAL(18,0)) END AS whole,
         CASE WHEN cdc_action <> 'DELETE' THEN cents END AS cents,
         CASE WHEN cdc_action <> 'DELETE' THEN event_day END AS transaction_date,
         CASE WHEN cdc_action <> 'DELETE' THEN 'STREAMING' END AS data_source,
         CASE WHEN cdc_action <> 'DELETE' THEN 'enc-' || user_id END AS encrypted
  FROM cdc)"""

INGESTED = f"""{CDC}, {TX}, both_sources AS (
  SELECT transaction_id, data_source, cents AS transaction_amount, committed AS ingestion_timestamp
  FROM ev WHERE cdc_action = 'INSERT'
  UNION ALL
  SELECT transaction_id, data_source, transaction_amount,
         CASE WHEN data_source = 'HISTORICAL' THEN TIMESTAMP '2024-01-10' END FROM tx),
ingested AS (
  SELECT *, data_source = 'STREAMING' AND ingestion_timestamp IS NOT NULL
            AND ingestion_timestamp >= TIMESTAMP '2024-01-10' AND ingestion_timestamp < TIMESTAMP '2024-01-11' AS hit
  FROM both_sources)"""

_EVENT_COLUMNS = (
    f"transaction_id, cdc_action, customer_id, transaction_type, {as_double('whole')} AS transaction_amount, "
    f"{day('transaction_date')} AS transaction_date, db_user, {moment('committed')} AS committed_timestamp"
)
_INSERT_COLUMNS = (
    f"transaction_id, customer_id, {day('transaction_date')} AS transaction_date, "
    f"{as_double('cents')} AS transaction_amount, transaction_type, data_source, "
    f"{moment('committed')} AS ingestion_timestamp, {moment('committed')} AS created_at"
)
_HIGH_VALUE = f"""WITH {CDC} SELECT transaction_id, customer_id, transaction_type,
  {as_double('whole')} AS transaction_amount, {moment('committed')} AS committed_timestamp,
  'HIGH_VALUE' AS anomaly_type FROM ev WHERE whole > 10000"""
_ACTIONS = f"""WITH {CDC} SELECT cdc_action, COUNT(*) AS transaction_count,
  COUNT(DISTINCT customer_id) AS unique_customers, {mean('whole', 0, 2)} AS avg_amount,
  {as_double('SUM(whole)')} AS total_amount FROM ev GROUP BY cdc_action"""
_TYPES = f"""WITH {CDC} SELECT transaction_type, cdc_action, COUNT(*) AS count, {mean('whole', 0, 2)} AS avg_amount,
  {as_double('MIN(whole)')} AS min_amount, {as_double('MAX(whole)')} AS max_amount
  FROM ev WHERE cdc_action = 'INSERT' GROUP BY ALL"""
_STATE = f"""WITH {CDC} SELECT row_key, encrypted AS transaction_id_encrypted, customer_id, transaction_type,
  {day('transaction_date')} AS transaction_date, {as_double('cents')} AS transaction_amount, data_source,
  transaction_id AS last_event_id, {moment('committed')} AS last_committed
  FROM (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY row_key
        ORDER BY committed DESC, transaction_id DESC) = 1) WHERE cdc_action <> 'DELETE'"""
_LANDED = """SELECT 'landed' AS outcome, COUNT(*) AS records, CAST(SUM(event_id) AS BIGINT) AS id_sum
  FROM events WHERE event_id % 500 <> 3
  UNION ALL SELECT 'rejected', COUNT(*), NULL FROM events WHERE event_id % 500 = 3"""

_RECENT = f"""WITH {CDC} SELECT cdc_action, COUNT(*) AS recent_transactions,
  {mean('whole', 0, 2)} AS avg_amount FROM ev WHERE committed >= TIMESTAMP '2024-01-30 22:00:00' GROUP BY cdc_action"""

SQL: dict[str, str] = {
    "load_mortgages_csv": f"""WITH {MORT} SELECT {day('week_start_date')} AS week_start_date, week, loan_id, ts,
  loan_type_name, loan_purpose_name, CAST(income_units AS DOUBLE) AS applicant_income_000s,
  {as_double('loan_amount_000s')} AS loan_amount_000s, county_name, mortgageresponse FROM mort""",
    "number_mortgages": f"""WITH {MORT} SELECT row_number() OVER (ORDER BY loan_id, week_start_date) AS loan_record_id,
  loan_id, {day('week_start_date')} AS week_start_date, week, ts, loan_type_name, loan_purpose_name,
  CAST(income_units AS DOUBLE) AS applicant_income_000s, {as_double('loan_amount_000s')} AS loan_amount_000s,
  county_name, mortgageresponse FROM mort""",
    "write_jsonl": f"""WITH {TYPED} SELECT transaction_id, customer_id, {day('transaction_date')} AS transaction_date,
  {as_double('transaction_amount')} AS transaction_amount, transaction_type, 'HISTORICAL' AS data_source FROM typed""",
    "load_transactions_json": f"""WITH {TX} SELECT transaction_id, customer_id,
  {day('transaction_date')} AS transaction_date, {as_double('transaction_amount')} AS transaction_amount,
  transaction_type, data_source FROM tx""",
    "load_customers_json": f"""WITH {CUST} SELECT customer_id, loan_record_id, first_name, last_name, phone_number
  FROM cust""",
    "write_lakehouse_copy": f"""WITH {CUST} SELECT customer_id, loan_record_id, first_name, last_name, phone_number,
  '2024-01-01 00:00:00.000' AS created_at FROM cust""",
    "land_cdc": _LANDED,
    "publish_models": f"""WITH {C360}, history AS (SELECT DISTINCT p_partkey // 2 FROM part WHERE p_partkey % 50 <> 0)
  SELECT 'stg_customers' AS model, COUNT(*) AS records FROM scust
  UNION ALL SELECT 'stg_transactions', COUNT(*) FROM stx
  UNION ALL SELECT 'stg_mortgages', COUNT(*) FROM smort
  UNION ALL SELECT 'customer_360', COUNT(*) FROM c360
  UNION ALL SELECT 'customer_segments', COUNT(DISTINCT (has_mortgage,
      CASE WHEN total_spent > CASE WHEN has_mortgage THEN 30000 ELSE 20000 END THEN 'high'
           WHEN total_spent > CASE WHEN has_mortgage THEN 10000 ELSE 5000 END THEN 'standard' ELSE 'basic' END)) FROM c360
  UNION ALL SELECT 'transaction_summary', COUNT(DISTINCT (customer_id, transaction_month, transaction_type, data_source))
      FROM stx
  UNION ALL SELECT 'mortgage_base', COUNT(DISTINCT loan_record_id) FROM mort""",
    "delete_streaming_rows": f"""WITH {INGESTED}
  SELECT data_source, COUNT(*) FILTER (NOT hit) AS records_left,
         {as_double('SUM(transaction_amount) FILTER (NOT hit)')} AS amount_left,
         (SELECT COUNT(*) FROM ingested WHERE hit) AS records_deleted
  FROM ingested GROUP BY data_source""",
    "without_streaming_day": f"""WITH {INGESTED} SELECT transaction_id, data_source,
  {as_double('transaction_amount')} AS transaction_amount, {moment('ingestion_timestamp')} AS ingestion_timestamp
  FROM ingested WHERE NOT hit""",
    "stg_customers": f"WITH {STG_CUST} SELECT * FROM scust",
    "stg_customers_steward": f"""WITH {CUST} SELECT customer_id, upper(trim(first_name)) AS first_name,
  upper(last_name) AS last_name, regexp_replace(phone_number, '[^0-9]', '', 'g') AS phone_clean, loan_record_id,
  loan_record_id IS NOT NULL AS has_mortgage FROM cust""",
    "stg_transactions": f"""WITH {STG_TX} SELECT transaction_id, customer_id,
  {day('transaction_date')} AS transaction_date, {as_double('transaction_amount')} AS transaction_amount,
  transaction_type, data_source, {day('transaction_month')} AS transaction_month, amount_category,
  {moment('ingestion_timestamp')} AS ingestion_timestamp, {moment('ingestion_timestamp')} AS created_at FROM stx""",
    "stg_mortgages": f"""WITH {STG_MORT} SELECT * REPLACE ({day('week_start_date')} AS week_start_date) FROM smort""",
    "mortgage_base": f"""WITH {HISTORY} SELECT loan_record_id, loan_id, {day('week_start_date')} AS week_start_date,
  week, ts,
  CASE trim(loan_type_name) WHEN 'FSA/RHS-guaranteed' THEN 'FSA_RHS' WHEN 'FHA-insured' THEN 'FHA'
       WHEN 'VA-guaranteed' THEN 'VA' ELSE upper(trim(loan_type_name)) END AS loan_type_name,
  upper(regexp_replace(loan_purpose_name, '[- .]', '_', 'g')) AS loan_purpose_name,
  upper(trim(regexp_replace(county_name, '[-_.]', '', 'g'))) AS county_name,
  CAST(income_units AS DOUBLE) AS applicant_income_000s, {as_double('loan_amount_000s')} AS loan_amount_000s,
  mortgageresponse, {moment('created_at')} AS created_at FROM latest""",
    "mortgage_dedup": f"""WITH {HISTORY} SELECT loan_record_id, loan_id, {moment('created_at')} AS created_at
  FROM latest""",
    "customer_360": f"""WITH {C360} SELECT * REPLACE ({as_double('total_spent')} AS total_spent,
  {day('last_transaction_date')} AS last_transaction_date) FROM c360""",
    "customer_segments": f"""WITH {C360}, seg AS (
  SELECT *, CASE
      WHEN has_mortgage THEN CASE WHEN total_spent > 30000 THEN 'High Value Mortgage'
          WHEN total_spent > 10000 THEN 'Standard Mortgage' ELSE 'Basic Mortgage' END
      WHEN total_spent > 20000 THEN 'High Value Non-Mortgage'
      WHEN total_spent > 5000 THEN 'Standard Non-Mortgage' ELSE 'Basic Non-Mortgage' END AS customer_segment,
    CAST(round(avg_transaction * 1000000) AS BIGINT) AS avg_micro
  FROM c360)
  SELECT customer_segment, COUNT(*) AS customer_count, {mean('total_spent', 2, 6)} AS avg_total_spent,
    CAST(SUM(total_transactions) AS DOUBLE) / COUNT(*) AS avg_total_transactions,
    CAST((2 * SUM(avg_micro) * 10000 + COUNT(avg_micro)) // (2 * COUNT(avg_micro)) AS DOUBLE) / 10000000000.0::DOUBLE
      AS avg_transaction_size,
    COUNT(*) FILTER (has_mortgage) AS mortgage_holders,
    {percent('COUNT(*) FILTER (has_mortgage)', 'COUNT(*)', 1)} AS mortgage_percentage
  FROM seg GROUP BY customer_segment""",
    "transaction_summary": f"""WITH {STG_TX} SELECT customer_id, {day('transaction_month')} AS transaction_month,
  transaction_type, data_source, COUNT(*) AS transaction_count, {as_double('SUM(transaction_amount)')} AS total_amount,
  {mean('transaction_amount', 2, 6)} AS avg_amount, {as_double('MIN(transaction_amount)')} AS min_amount,
  {as_double('MAX(transaction_amount)')} AS max_amount,
  COUNT(*) FILTER (amount_category = 'High') AS high_value_count,
  COUNT(*) FILTER (amount_category = 'Medium') AS medium_value_count,
  COUNT(*) FILTER (amount_category = 'Low') AS low_value_count
  FROM stx GROUP BY customer_id, stx.transaction_month, transaction_type, data_source""",
    "dashboard_transactions": f"""WITH {shown(365)} SELECT {_SHOWN_COLUMNS} FROM
  (SELECT * FROM shown ORDER BY transaction_date DESC, transaction_id DESC LIMIT 10000)""",
    "volume_by_type": f"""WITH {shown(2500)} SELECT transaction_type, {as_double('SUM(amount)')} AS amount
  FROM shown GROUP BY transaction_type""",
    "daily_trends": f"""WITH {shown(2500)} SELECT {day('transaction_date')} AS transaction_date,
  {as_double('SUM(amount)')} AS amount, COUNT(transaction_id) AS transaction_count
  FROM shown GROUP BY shown.transaction_date""",
    "recent_transactions": f"""WITH {shown(2500)} SELECT {_SHOWN_COLUMNS} FROM
  (SELECT * FROM shown ORDER BY transaction_date DESC, transaction_id DESC LIMIT 20)""",
    "dashboard_summary": f"""WITH {STG_CUST}, {STG_TX}, both_sides AS (
  SELECT c.customer_id, t.transaction_id, t.transaction_amount, t.transaction_date >= DATE '2001-07-02' AS recent
  FROM scust c LEFT JOIN stx t ON t.customer_id = c.customer_id)
  SELECT COUNT(DISTINCT customer_id) AS total_customers,
    COUNT(DISTINCT customer_id) FILTER (recent) AS active_customers_30d,
    {as_double("SUM(CASE WHEN recent THEN transaction_amount ELSE 0 END)")} AS total_volume_30d,
    COUNT(transaction_id) FILTER (recent) AS total_transactions_30d FROM both_sides""",
    "masked_preview": f"""WITH {CUST} SELECT customer_id, first_name, '***' AS last_name,
  '***-***-' || right(phone_number, 4) AS phone_number, 'Standard' AS customer_tier, TRUE AS masking_active
  FROM cust ORDER BY customer_id LIMIT 10""",
    "cdc_parsed": f"""WITH {CDC} SELECT 'cdc_db_table_commit' AS cdc_object_type, {_EVENT_COLUMNS},
  'RETAIL' AS source_schema, 'TRANSACTIONS' AS source_table, data_source, row_key AS primary_key_tokenized,
  encrypted AS transaction_id_encrypted, db_user AS raw_json FROM ev""",
    "cdc_transactions": f"WITH {CDC} SELECT {_EVENT_COLUMNS} FROM ev",
    "cdc_as_transactions": f"WITH {CDC} SELECT {_INSERT_COLUMNS} FROM ev WHERE cdc_action = 'INSERT'",
    "cdc_action_summary": _ACTIONS,
    "cdc_transaction_types": _TYPES,
    "cdc_top_types": f"{_TYPES} ORDER BY count DESC, transaction_type LIMIT 5",
    "cdc_total": "SELECT COUNT(*) AS total_cdc_records FROM events",
    "cdc_latest_rows": f"""WITH {CDC} SELECT {_EVENT_COLUMNS} FROM
  (SELECT * FROM ev ORDER BY transaction_id DESC LIMIT 10)""",
    "cdc_latest_inserts": f"""WITH {CDC} SELECT {_INSERT_COLUMNS} FROM
  (SELECT * FROM ev WHERE cdc_action = 'INSERT' ORDER BY transaction_id DESC LIMIT 10)""",
    "cdc_recent_activity": _RECENT,
    "stream_last_hour": _RECENT,
    "high_value_cdc": _HIGH_VALUE,
    "method_comparison": f"""WITH {CDC}, {TX}
  SELECT 'CDC_STREAM' AS method, COUNT(*) AS count, data_source FROM ev WHERE cdc_action = 'INSERT' GROUP BY data_source
  UNION ALL SELECT 'DIRECT_INSERT', COUNT(*), data_source FROM tx GROUP BY data_source""",
    "cdc_current_state": _STATE,
    "cdc_continuity": f"""WITH {CDC}, steady AS (
  SELECT 'K' || user_id AS row_key, transaction_id AS event_id, cdc_action, committed,
    user_id * 10 + CAST(day(event_day) AS BIGINT) % 2 AS amount FROM cdc),
  sided AS (
  SELECT *, CASE WHEN cdc_action <> 'INSERT' THEN amount END AS found,
    lag(CASE WHEN cdc_action <> 'DELETE' THEN amount END) OVER w AS expected,
    row_number() OVER w > 1 AS has_previous
  FROM steady WINDOW w AS (PARTITION BY row_key ORDER BY committed, event_id))
  SELECT row_key, event_id, cdc_action, {moment('committed')} AS committed_timestamp,
    {as_double('expected')} AS expected_amount, {as_double('found')} AS found_amount, has_previous
  FROM sided WHERE found IS DISTINCT FROM expected""",
    "mask_customers": f"""WITH {CUST} SELECT customer_id, loan_record_id, first_name, '***' AS last_name,
  '***-***-' || right(phone_number, 4) AS phone_number FROM cust""",
    "mask_customers_steward": f"""WITH {CUST} SELECT customer_id, loan_record_id, first_name, last_name, phone_number
  FROM cust""",
    "masked_view": f"""WITH {CUST} SELECT customer_id, loan_record_id, first_name, '***' AS last_name,
  '***-***-' || right(phone_number, 4) AS phone_number FROM cust""",
    "pseudonymise_keys": f"""WITH {TX} SELECT customer_id, {as_double('transaction_amount')} AS transaction_amount,
  sha256('check-salt' || transaction_id) AS transaction_id_tokenized FROM tx""",
    "access_audit": f"""SELECT 'user' || user_id AS user_name, event_id AS query_id, {moment('ts')} AS query_start_time,
  '[{{"object_name":"' || event_type || '"}}]' AS direct_objects_accessed,
  '[{{"object_name":"' || event_type || '"}}]' AS base_objects_accessed FROM events""",
    "blank_count": f"WITH {TX} SELECT COUNT(*) FILTER (trim(transaction_type) = '') AS blank_count FROM tx",
    "blank_rows": f"""WITH {TX} SELECT transaction_id, customer_id, {day('transaction_date')} AS transaction_date,
  {as_double('transaction_amount')} AS transaction_amount, transaction_type, data_source,
  {moment('ingestion_timestamp')} AS ingestion_timestamp, {moment('ingestion_timestamp')} AS created_at
  FROM tx WHERE trim(transaction_type) = ''""",
    "dq_unique": f"""WITH {C360}, found AS (
  SELECT 'stg_customers' AS model, 'customer_id' AS column_name,
    (SELECT COUNT(*) FROM (SELECT 1 FROM scust GROUP BY customer_id HAVING COUNT(*) > 1)) AS failures
  UNION ALL SELECT 'stg_transactions', 'transaction_id',
    (SELECT COUNT(*) FROM (SELECT 1 FROM stx GROUP BY transaction_id HAVING COUNT(*) > 1))
  UNION ALL SELECT 'customer_360', 'customer_id',
    (SELECT COUNT(*) FROM (SELECT 1 FROM c360 GROUP BY customer_id HAVING COUNT(*) > 1))
  UNION ALL SELECT 'stg_transactions', 'customer_id',
    (SELECT COUNT(*) FROM (SELECT 1 FROM stx GROUP BY customer_id HAVING COUNT(*) > 1)))
  SELECT model, column_name, 'unique' AS test, failures, failures = 0 AS passed FROM found""",
    "dq_unique_values": f"""WITH {TX} SELECT customer_id, COUNT(*) AS n_records FROM tx GROUP BY customer_id
  HAVING COUNT(*) > 1""",
    "dq_not_null": f"""WITH {C360}, found AS (
  SELECT 'stg_customers' AS model, 'customer_id' AS column_name, COUNT(*) - COUNT(customer_id) AS failures FROM scust
  UNION ALL SELECT 'stg_transactions', 'transaction_id', COUNT(*) - COUNT(transaction_id) FROM stx
  UNION ALL SELECT 'customer_360', 'customer_id', COUNT(*) - COUNT(customer_id) FROM c360
  UNION ALL SELECT 'stg_customers', 'loan_record_id', COUNT(*) - COUNT(loan_record_id) FROM scust)
  SELECT model, column_name, 'not_null' AS test, failures, failures = 0 AS passed FROM found""",
    "raw_counts": """SELECT 'MORTGAGE_TABLE' AS table_name, COUNT(*) AS record_count FROM part
  UNION ALL SELECT 'CUSTOMER_TABLE', COUNT(*) FROM customer
  UNION ALL SELECT 'TRANSACTIONS_TABLE', COUNT(*) FROM orders
  UNION ALL SELECT 'CUSTOMER_TABLE_ICEBERG', COUNT(*) FROM customer""",
    "customer_mortgage_check": f"""WITH {CUST} SELECT 'Customer-Mortgage Relationship' AS validation,
  COUNT(DISTINCT customer_id) AS total_customers, COUNT(DISTINCT loan_record_id) AS customers_with_mortgages,
  COUNT(DISTINCT p_partkey) AS total_mortgage_records
  FROM cust LEFT JOIN part ON p_partkey = loan_record_id""",
    "source_profile": f"""WITH {TX} SELECT data_source, COUNT(*) AS record_count,
  COUNT(DISTINCT customer_id) AS unique_customers, {day('MIN(transaction_date)')} AS earliest_date,
  {day('MAX(transaction_date)')} AS latest_date FROM tx GROUP BY data_source""",
    "load_summary": f"""WITH {TYPED} SELECT COUNT(*) AS total_transactions,
  {as_double('SUM(transaction_amount)')} AS total_amount, COUNT(*) FILTER (is_anomaly) AS anomalies,
  {percent('COUNT(*) FILTER (is_anomaly)', 'COUNT(*)', 1)} AS anomaly_percentage FROM typed""",
    "customer_file_profile": f"""WITH {CUST} SELECT COUNT(*) AS total_customers, COUNT(loan_record_id) AS with_mortgages,
  COUNT(*) - COUNT(loan_record_id) AS without_mortgages, MIN(customer_id) AS lowest_customer_id,
  MAX(customer_id) AS highest_customer_id FROM cust""",
    "amount_band_check": f"""WITH {TYPED}, {RULES} SELECT transaction_id, transaction_type,
  {as_double('transaction_amount')} AS transaction_amount,
  CASE WHEN lowest IS NULL THEN 'UNKNOWN_TYPE'
       WHEN transaction_amount BETWEEN lowest AND highest THEN 'IN_RANGE'
       WHEN transaction_amount BETWEEN 25000 AND 75000 THEN 'ANOMALY_BAND' ELSE 'OUT_OF_RANGE' END AS verdict
  FROM typed LEFT JOIN rules USING (transaction_type)""",
    "type_mix": f"""WITH {TYPED}, {RULES}, seen AS (
  SELECT transaction_type, COUNT(*) AS n FROM typed GROUP BY transaction_type)
  SELECT transaction_type, COALESCE(n, 0) AS transaction_count, expected_percent,
    {percent('COALESCE(n, 0)', '(SELECT COUNT(*) FROM typed)', 4)} AS actual_percent
  FROM seen FULL JOIN rules USING (transaction_type)""",
    "daily_volume_check": f"""WITH {TX}, days AS (
  SELECT CAST(unnest(generate_series(MIN(transaction_date), MAX(transaction_date), INTERVAL 1 DAY)) AS DATE) AS transaction_date
  FROM tx UNION SELECT transaction_date FROM tx),
  per_day AS (
  SELECT days.transaction_date, COUNT(tx.transaction_id) AS transaction_count, isodow(days.transaction_date) > 5 AS is_weekend
  FROM days LEFT JOIN tx ON days.transaction_date IS NOT DISTINCT FROM tx.transaction_date GROUP BY days.transaction_date),
  bands AS (SELECT *, CASE WHEN is_weekend THEN 2 ELSE 3 END AS expected_low,
    CASE WHEN is_weekend THEN 9 ELSE 14 END AS expected_high FROM per_day)
  SELECT * REPLACE ({day('transaction_date')} AS transaction_date),
    transaction_count BETWEEN expected_low AND expected_high AS in_band FROM bands""",
    "loan_link_check": f"""WITH {CUST}, implied AS (
  SELECT customer_id, loan_record_id, CASE WHEN customer_id <= 1000 THEN customer_id END AS implied_loan_record_id
  FROM cust) SELECT * FROM implied WHERE loan_record_id IS DISTINCT FROM implied_loan_record_id""",
    "stream_transactions": f"""WITH {TYPED} SELECT transaction_id, customer_id,
  {day('transaction_date')} AS transaction_date, {as_double('transaction_amount')} AS transaction_amount,
  transaction_type, 'STREAMING' AS data_source FROM typed WHERE transaction_id % 300 <> 5""",
    "stream_cdc_land": _LANDED,
    "stream_counters": f"""WITH {TYPED}, n AS (
  SELECT COUNT(*) AS total, COUNT(*) FILTER (transaction_id % 300 <> 5) AS sent,
    COUNT(*) FILTER (is_anomaly AND transaction_id % 300 <> 5) AS odd FROM typed)
  SELECT total AS total_transactions, sent AS successful_sends, total - sent AS failed_sends, odd AS anomalies,
    {percent('sent', 'total', 1)} AS success_percentage, {percent('odd', 'total', 1)} AS anomaly_percentage FROM n""",
    "stream_action_summary": _ACTIONS,
    "stream_type_summary": _TYPES,
    "stream_recent_activity": f"""WITH {CDC}, spread AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, committed) - to_minutes(5 * k) AS window_start, cdc_action, whole
  FROM ev, range(12) AS steps(k)),
  summed AS (
  SELECT window_start, cdc_action, COUNT(*) AS recent_transactions, {mean('whole', 0, 2)} AS avg_amount
  FROM spread GROUP BY window_start, cdc_action)
  SELECT {moment('window_start')} AS window_start, {moment('window_start + INTERVAL 1 HOUR')} AS window_end,
    cdc_action, recent_transactions, avg_amount FROM summed
  WHERE summed.window_start + INTERVAL 1 HOUR <= (SELECT MAX(committed) FROM ev) - INTERVAL 10 MINUTE""",
    "stream_delete_day": f"""WITH {TYPED} SELECT COUNT(*) FILTER (transaction_id % 2 = 1) AS records_left,
  CAST(SUM(transaction_id) FILTER (transaction_id % 2 = 1) AS BIGINT) AS id_sum,
  COUNT(*) FILTER (transaction_id % 2 = 0) AS records_deleted FROM typed""",
    "stream_high_value": _HIGH_VALUE,
    "stream_current_state": _STATE,
}
SQL |= {"stored_cdc_recent_activity": _RECENT, "stored_cdc_action_summary": _ACTIONS}
SQL |= {"published_customer_360": SQL["customer_360"], "published_transaction_summary": SQL["transaction_summary"]}
SQL |= {
    "keyed_current_state": _STATE,
    "keyed_lookup": f"SELECT * FROM ({_STATE}) WHERE row_key IN ('K1', 'K2', 'K3', 'K5', 'K8', 'K13', 'K21', 'K999999999')",
    "channel_offsets": """WITH e AS (SELECT event_id, event_id - MIN(event_id) OVER () AS place FROM events)
  SELECT 'c' || place % 2 AS channel, MAX(place // 2) + 1 AS committed_offset, MAX(place // 2) + 1 AS highest_offset,
    COUNT(*) AS records, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM e GROUP BY ALL""",
    "source_customers": f"WITH {TX} SELECT data_source, COUNT(DISTINCT customer_id) AS unique_customers FROM tx GROUP BY data_source",
    "refreshed_transaction_summary": SQL["transaction_summary"],
    "refreshed_customer_360": SQL["customer_360"],
    "load_once": SQL["load_transactions_json"],
    "sql_metric_scan": SQL["blank_rows"],
    "policy_views": SQL["masked_view"],
    "stream_counted": SQL["stream_counters"],
}
