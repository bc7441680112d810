"""DuckDB counterparts of the registered queries, put together from named steps."""

from checks.records import duckdb_records
from txnmill.schema import LANDING_FIELDS, NATURAL_KEY

# What the rules accept, written out here so that a wrong list under test shows.
CURRENCIES = "USD EUR GBP CHF JPY AUD CAD".split()
TRANSACTION_TYPES = "debit credit".split()
MERCHANT_CATEGORIES = """
    e-commerce travel food_and_beverage groceries electronics retail entertainment health
    transportation home_and_garden payroll transfer
""".split()
STATUSES = "completed pending failed reversed".split()
COUNTRY_CODES = """
    AD AE AF AG AI AL AM AO AR AT AU AZ BA BB BD BE BF BG BH BI BJ BN BO BR BS BT BW BY BZ CA
    CD CF CG CH CI CL CM CN CO CR CU CV CY CZ DE DJ DK DM DO DZ EC EE EG ER ES ET FI FJ FM FR
    GA GB GD GE GH GM GN GQ GR GT GW GY HK HN HR HT HU ID IE IL IN IQ IR IS IT JM JO JP KE KG
    KH KI KM KN KP KR KW KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD ME MG MH MK ML MM MN MR
    MT MU MV MW MX MY MZ NA NE NG NI NL NO NP NR NZ OM PA PE PG PH PK PL PT PW PY QA RO RS RW
    SA SB SC SD SE SG SI SK SL SM SN SO SR SS ST SV SY SZ TD TG TH TJ TL TN TO TR TT TV TW TZ
    UA UG US UY UZ VA VC VE VN VU WS YE ZA ZM ZW
""".split()

ISO = "%Y-%m-%dT%H:%M:%SZ"
DATE_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\dZ$"
FIELDS = ", ".join(LANDING_FIELDS)
KEY = ", ".join(NATURAL_KEY)
VALID_FIELDS = (
    "transaction_id, account_id, transaction_date, transaction_ts, amount, currency, "
    "transaction_type, merchant_name, merchant_category, status, country_code"
)
# First of the two loads: originals dated before this day. The second load sees everything.
FIRST_PART = "transaction_date < '2024-01-20' AND transaction_id NOT LIKE '%D'"


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _one_of(name: str, values: list[str]) -> str:
    return f"""CASE WHEN {name} IS NULL OR {name} = '' THEN '{name} is missing'
        WHEN {name} NOT IN ({_listed(values)}) THEN '{name} is invalid' END"""


AMOUNT = {
    "full": """WHEN amount IS NULL THEN 'amount is not a valid decimal'
        WHEN amount <= 0 THEN 'amount must be strictly greater than 0'
        WHEN NOT regexp_matches(amount_raw, '^\\d+(\\.\\d{1,2})?$')
            THEN 'amount must have at most 2 decimal places'""",
    "incremental": """WHEN amount IS NULL OR NOT regexp_matches(amount_raw, '^-?\\d+(\\.\\d{1,2})?$')
            THEN 'amount must be a valid decimal with at most 2 decimal places'
        WHEN amount <= 0 THEN 'amount must be strictly greater than 0'""",
}
LAST_TS = {"full": "2024-03-31 23:59:59", "incremental": "2024-12-31 23:59:59"}
RANGE_MESSAGE = {
    "full": "transaction_date falls outside expected Jan-Mar 2024 range",
    "incremental": "transaction_date falls outside expected loadable range",
}


def rules(profile: str) -> dict[str, str]:
    return {
        "err_transaction_id": """CASE
        WHEN transaction_id IS NULL OR transaction_id = '' THEN 'transaction_id is missing'
        WHEN NOT regexp_matches(transaction_id, '^TXN-[A-Z0-9]+$')
            THEN 'transaction_id must match ^TXN-[A-Z0-9]+$' END""",
        "err_account_id": """CASE
        WHEN account_id IS NULL OR account_id = '' THEN 'account_id is missing'
        WHEN NOT regexp_matches(account_id, '^ACC-\\d{4}$')
            THEN 'account_id must match ^ACC-\\d{4}$'
        WHEN TRY_CAST(substr(account_id, 5) AS INTEGER) NOT BETWEEN 1001 AND 1020
            THEN 'account_id must be between ACC-1001 and ACC-1020' END""",
        "err_transaction_date_format": f"""CASE
        WHEN transaction_date IS NULL OR transaction_date = '' THEN 'transaction_date is missing'
        WHEN NOT regexp_matches(transaction_date, '{DATE_PATTERN}')
            THEN 'transaction_date must match strict ISO 8601 format YYYY-MM-DDTHH:MM:SSZ' END""",
        "err_transaction_date_value": f"""CASE
        WHEN regexp_matches(transaction_date, '{DATE_PATTERN}') AND transaction_ts IS NULL
            THEN 'transaction_date is not a valid calendar date/time' END""",
        "err_transaction_date_range": f"""CASE
        WHEN transaction_ts < TIMESTAMP '2024-01-01 00:00:00'
          OR transaction_ts > TIMESTAMP '{LAST_TS[profile]}' THEN '{RANGE_MESSAGE[profile]}' END""",
        "err_amount": f"""CASE
        WHEN amount_raw IS NULL OR trim(amount_raw) = '' THEN 'amount is missing'
        {AMOUNT[profile]} END""",
        "err_currency": _one_of("currency", CURRENCIES),
        "err_transaction_type": _one_of("transaction_type", TRANSACTION_TYPES),
        "err_merchant_name": """CASE
        WHEN merchant_name IS NULL OR merchant_name = '' THEN 'merchant_name is missing'
        WHEN NOT regexp_matches(merchant_name, '\\S')
            THEN 'merchant_name must contain at least one non-whitespace character' END""",
        "err_merchant_category": _one_of("merchant_category", MERCHANT_CATEGORIES),
        "err_status": _one_of("status", STATUSES),
        "err_country_code": f"""CASE
        WHEN country_code IS NULL OR country_code = '' THEN 'country_code is missing'
        WHEN NOT regexp_matches(country_code, '^[A-Z]{{2}}$')
            THEN 'country_code must be exactly two uppercase letters'
        WHEN country_code NOT IN ({_listed(COUNTRY_CODES)})
            THEN 'country_code must be an assigned ISO 3166-1 alpha-2 code' END""",
    }


RULE_NAMES = list(rules("full"))

CLEANED = ", ".join(
    {
        "transaction_id": "upper(trim(transaction_id)) AS transaction_id",
        "merchant_name": "merchant_name",
    }.get(name, f"trim({name}) AS {name}")
    for name in LANDING_FIELDS
)


def _typed(source: str) -> str:
    return f"""SELECT {FIELDS}, TRY_CAST(amount_raw AS DECIMAL(18,2)) AS amount,
        try_strptime(transaction_date, '{ISO}') AS transaction_ts FROM {source}"""


def _messages(profile: str, source: str) -> str:
    columns = ",\n        ".join(f"{sql} AS {name}" for name, sql in rules(profile).items())
    return f"SELECT *, {columns} FROM {source}"


def _validated(source: str) -> str:
    names = ", ".join(RULE_NAMES)
    return f"""SELECT *, concat_ws('; ', {names}) AS error_reason,
        COALESCE({names}) IS NULL AS is_valid FROM {source}"""


def _since(source: str, watermark: str) -> str:
    """Rows of ``source`` dated at or after the watermark minus one day."""
    return f"""SELECT * FROM {source} WHERE try_strptime(transaction_date, '{ISO}') >=
        (SELECT max_ts FROM {watermark}) - INTERVAL 1 DAY"""


def _flagged(rows: str, earlier: str) -> str:
    """Duplicate of an earlier key, or not the first of its key in the batch."""
    match = " AND ".join(f"e.{name} = b.{name}" for name in NATURAL_KEY)
    return f"""SELECT {VALID_FIELDS},
        EXISTS (SELECT 1 FROM {earlier} AS e WHERE {match})
        OR row_number() OVER (PARTITION BY {KEY} ORDER BY transaction_id) > 1 AS is_duplicate
        FROM {rows} AS b"""


STEPS = {
    "raw": duckdb_records(),
    "cleaned": f"SELECT {CLEANED} FROM raw",
    "typed_full": _typed("raw"),
    "typed_incremental": _typed("cleaned"),
    "messages_full": _messages("full", "typed_full"),
    "messages_incremental": _messages("incremental", "typed_incremental"),
    "validated_full": _validated("messages_full"),
    "validated_incremental": _validated("messages_incremental"),
    "valid_full": f"SELECT {VALID_FIELDS} FROM validated_full WHERE is_valid",
    "valid_incremental": f"SELECT {VALID_FIELDS} FROM validated_incremental WHERE is_valid",
    "quarantine_full": f"SELECT {FIELDS}, error_reason FROM validated_full WHERE NOT is_valid",
    "quarantine_incremental": f"""SELECT {FIELDS}, error_reason FROM validated_incremental
        WHERE NOT is_valid""",
    "bronze": f"""SELECT {VALID_FIELDS}, row_number() OVER (
        PARTITION BY {KEY} ORDER BY transaction_id) > 1 AS is_duplicate FROM valid_full""",
    "base": """SELECT account_id, CAST(transaction_ts AS DATE) AS transaction_date, amount,
        transaction_type, merchant_name, merchant_category, currency
        FROM bronze WHERE status = 'completed' AND NOT is_duplicate""",
    # One grain of account, day, category and direction feeds every money figure; the top category
    # is the arg_max over it. Merchants and currencies are looked up in the rows themselves.
    "grain": """SELECT account_id AS a, transaction_date AS d, merchant_category AS c,
        SUM(amount) AS spend, SUM(amount) FILTER (transaction_type = 'debit') AS out_sum,
        SUM(amount) FILTER (transaction_type = 'credit') AS in_sum, COUNT(*) AS n
        FROM base GROUP BY ALL""",
    "summary": """SELECT a AS account_id, d AS transaction_date,
        CAST(COALESCE(SUM(out_sum), 0) AS DECIMAL(18,2)) AS total_debit_amount,
        CAST(COALESCE(SUM(in_sum), 0) AS DECIMAL(18,2)) AS total_credit_amount,
        CAST(COALESCE(SUM(in_sum), 0) - COALESCE(SUM(out_sum), 0) AS DECIMAL(18,2)) AS net_amount,
        CAST(SUM(n) AS BIGINT) AS transaction_count,
        (SELECT COUNT(DISTINCT merchant_name) FROM base WHERE account_id = a AND transaction_date = d)
            AS distinct_merchants,
        arg_min(c, (-spend, c)) AS top_category,
        (SELECT array_to_string(list_sort(list_distinct(list(currency))), ',') FROM base
            WHERE account_id = a AND transaction_date = d) AS currencies
        FROM grain GROUP BY a, d""",
    "faulty": """SELECT account_id, transaction_date, total_debit_amount, total_credit_amount,
        CAST(net_amount + (day(transaction_date) % 5 = 0)::INT AS DECIMAL(18,2)) AS net_amount,
        CASE WHEN day(transaction_date) % 11 = 0 THEN 0 ELSE transaction_count END AS transaction_count,
        distinct_merchants, CASE WHEN day(transaction_date) % 7 <> 0 THEN top_category END AS top_category,
        currencies FROM summary, range(1 + (day(transaction_date) % 13 = 0)::INT)""",
    "large_amounts": """SELECT * REPLACE (CASE
        WHEN regexp_full_match(amount_raw, '\\d+\\.\\d\\d') AND amount_raw LIKE '%7'
        THEN '1234567' || lpad(amount_raw, 10, '0') ELSE amount_raw END AS amount_raw) FROM raw""",
    # Two loads: landed rows, valid rows and flags of each.
    "part1": f"SELECT * FROM validated_incremental WHERE {FIRST_PART}",
    "rest": f"SELECT * FROM validated_incremental WHERE ({FIRST_PART}) IS NOT TRUE",
    "valid1": "SELECT * FROM part1 WHERE is_valid",
    "flagged1": f"""SELECT {VALID_FIELDS}, row_number() OVER (
        PARTITION BY {KEY} ORDER BY transaction_id) > 1 AS is_duplicate FROM valid1""",
    "mark1": "SELECT max(transaction_ts) AS max_ts FROM valid1",
    "new2": f"""SELECT * FROM ({_since('validated_incremental', 'mark1')}) AS s
        WHERE transaction_id IS NULL OR transaction_id NOT IN (
            SELECT transaction_id FROM part1 WHERE transaction_id IS NOT NULL)""",
    "valid2": "SELECT * FROM new2 WHERE is_valid",
    "flagged2": _flagged("valid2", "valid1"),
    "both_runs": "SELECT * FROM flagged1 UNION ALL SELECT * FROM flagged2",
    "valid_rest": "SELECT * FROM rest WHERE is_valid",
    "flagged_rest": _flagged("valid_rest", "valid1"),
    # A CSV round trip turns the empty id into null, and a null id is new in every load.
    "stream_rest": """SELECT * FROM rest WHERE NULLIF(transaction_id, '') IS NULL
        OR transaction_id NOT IN (SELECT transaction_id FROM part1)""",
    "valid_stream": "SELECT * FROM stream_rest WHERE is_valid",
    "flagged_stream": _flagged("valid_stream", "valid1"),
}

# The summary of what two incremental runs have stored.
for _name in ("base", "grain", "summary"):
    STEPS[f"{_name}_of_runs"] = (
        STEPS[_name].replace("FROM bronze", "FROM both_runs").replace("FROM grain", "FROM grain_of_runs").replace("FROM base", "FROM base_of_runs")
    )


def with_steps(final: str) -> str:
    """``final`` preceded by the steps it needs."""
    import re

    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(STEPS[name])

    visit(final)
    chain = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in STEPS.items() if name in needed)
    return f"WITH {chain}\n{final}" if chain else final


def _two_profiles(rule: str) -> str:
    full, incremental = rules("full")[rule], rules("incremental")[rule]
    return f"""SELECT transaction_id, account_id, 'full' AS profile, {rule} AS message
    FROM messages_full UNION ALL
    SELECT transaction_id, account_id, 'incremental' AS profile, {rule} AS message
    FROM messages_incremental"""


COUNTS = """SELECT (SELECT COUNT(*) FROM raw) AS landing_rows,
    (SELECT COUNT(*) FROM quarantine_full) AS quarantine_rows,
    COUNT(*) AS bronze_rows,
    COUNT(*) FILTER (WHERE NOT is_duplicate) AS unique_rows,
    COUNT(*) FILTER (WHERE is_duplicate) AS duplicate_rows FROM bronze"""

ERROR_COUNT = " + ".join(f"({name} IS NOT NULL)::BIGINT" for name in RULE_NAMES)

FINALS = {
    "scan_csv": f"SELECT NULLIF(transaction_id, '') AS transaction_id, {', '.join(LANDING_FIELDS[1:])} FROM raw",
    "scan_since": f"""SELECT {FIELDS} FROM raw
        WHERE try_strptime(transaction_date, '{ISO}') >= TIMESTAMP '2024-01-15 00:00:00'""",
    "scan_json_pages": f"SELECT {FIELDS} FROM large_amounts",
    "scan_json_lines": f"SELECT {FIELDS} FROM large_amounts",
    "source_fallback": f"""SELECT NULLIF(transaction_id, '') AS transaction_id,
        {', '.join(LANDING_FIELDS[1:])}, 'csv_files' AS source_system FROM raw""",
    "landing_full": f"SELECT {FIELDS}, 'json_pages' AS source_system FROM raw",
    "landing_incremental": f"SELECT {FIELDS}, 'json_pages' AS source_system FROM cleaned",
    "typed_columns": """SELECT transaction_id, amount, transaction_ts, TRY_CAST(
        regexp_extract(account_id, '^ACC-(\\d{4})$', 1) AS INTEGER) AS account_number
        FROM typed_full""",
    **{f"rule_{_name}": _two_profiles(_rule) for _name, _rule in {
        "transaction_id": "err_transaction_id",
        "account_id": "err_account_id",
        "date_format": "err_transaction_date_format",
        "date_value": "err_transaction_date_value",
        "date_range": "err_transaction_date_range",
        "amount": "err_amount",
        "currency": "err_currency",
        "transaction_type": "err_transaction_type",
        "merchant_name": "err_merchant_name",
        "merchant_category": "err_merchant_category",
        "status": "err_status",
        "country_code": "err_country_code",
    }.items()},
    "error_array": f"""SELECT transaction_id, account_id, concat_ws('|', {', '.join(RULE_NAMES)})
        AS messages, {ERROR_COUNT} AS n FROM messages_full""",
    "validate_full": f"SELECT {FIELDS}, amount, transaction_ts, error_reason, is_valid FROM validated_full",
    "validate_incremental": f"""SELECT {FIELDS}, amount, transaction_ts, error_reason, is_valid
        FROM validated_incremental""",
    "quarantine_full": "SELECT * FROM quarantine_full",
    "quarantine_incremental": "SELECT * FROM quarantine_incremental",
    "valid_full": "SELECT * FROM valid_full",
    "valid_incremental": "SELECT * FROM valid_incremental",
    "mark_duplicates_full": "SELECT * FROM bronze",
    "duplicates_only": "SELECT * FROM bronze WHERE is_duplicate",
    "unique_valid": "SELECT * FROM bronze WHERE NOT is_duplicate",
    "quarantine_sample": """SELECT transaction_id, error_reason FROM quarantine_full
        ORDER BY transaction_id, error_reason LIMIT 20""",
    "duplicate_sample": """SELECT transaction_id, account_id, amount FROM bronze WHERE is_duplicate
        ORDER BY transaction_id, account_id, amount LIMIT 20""",
    "run_metrics": COUNTS,
    "reconcile_counts": f"""SELECT landing_rows, quarantine_rows, bronze_rows,
        landing_rows = quarantine_rows + bronze_rows AS reconciled FROM ({COUNTS}) AS c""",
    "summary_base": "SELECT * FROM base",
    "daily_metrics": """SELECT account_id, transaction_date, total_debit_amount,
        total_credit_amount, net_amount, transaction_count, distinct_merchants FROM summary""",
    "daily_currencies": "SELECT account_id, transaction_date, currencies FROM summary",
    "category_spend": """SELECT a AS account_id, d AS transaction_date, c AS merchant_category,
        CAST(spend AS DECIMAL(28,2)) AS category_amount FROM grain""",
    "ranked_categories": """SELECT a AS account_id, d AS transaction_date, c AS merchant_category,
        row_number() OVER (PARTITION BY a, d ORDER BY spend DESC, c) AS rn FROM grain""",
    "top_category": "SELECT account_id, transaction_date, top_category FROM summary",
    "daily_account_summary": "SELECT * FROM summary",
    "daily_summary_join": "SELECT * FROM summary",
    "max_event_time": "SELECT max(transaction_ts) AS max_ts FROM bronze",
    "existing_ids": """SELECT DISTINCT upper(trim(transaction_id)) AS transaction_id FROM raw
        WHERE transaction_id IS NOT NULL""",
    "natural_key": f"""SELECT transaction_id, concat_ws('||', {', '.join(
        f"coalesce(CAST({name} AS VARCHAR), '')" for name in NATURAL_KEY)}) AS natural_key
        FROM valid_full""",
    "existing_natural_keys": f"SELECT DISTINCT {KEY} FROM bronze",
    "new_rows_anti_join": f"""SELECT {FIELDS} FROM cleaned WHERE transaction_id IS NULL
        OR transaction_id NOT IN (SELECT transaction_id FROM part1)""",
    "new_rows_heavy": f"""SELECT {FIELDS} FROM cleaned WHERE transaction_id IS NULL
        OR transaction_id NOT IN (SELECT transaction_id FROM part1)""",
    "known_ids_uncleaned": f"""SELECT broadcast_bytes, {FIELDS} FROM cleaned,
        (VALUES (0::BIGINT), (1048576::BIGINT)) AS v(broadcast_bytes) WHERE transaction_id NOT IN (
            SELECT upper(trim(transaction_id)) FROM raw WHERE {FIRST_PART})""",
    "existing_duplicate_flag": f"""SELECT {VALID_FIELDS}, EXISTS (SELECT 1 FROM valid1 AS e
        WHERE {" AND ".join(f"e.{name} = b.{name}" for name in NATURAL_KEY)}) AS existing_duplicate
        FROM valid_rest AS b""",
    "mark_duplicates_incremental": "SELECT * FROM flagged_rest",
    "mark_duplicates_heavy": "SELECT * FROM bronze",
    "mark_duplicates_incremental_heavy": "SELECT * FROM flagged_rest",
    "effective_watermark": f"SELECT strftime(max_ts - INTERVAL 1 DAY, '{ISO}') AS effective_watermark FROM mark1",
    "next_watermark": f"""SELECT strftime(greatest(max(transaction_ts), (SELECT max_ts FROM mark1)), '{ISO}')
        AS last_successful_watermark FROM flagged2""",
    "watermark_state": f"""SELECT strftime(max_ts, '{ISO}') AS last_successful_watermark,
        (SELECT COUNT(*) FROM part1) AS rows_processed, 1 AS lookback_days FROM mark1""",
    "incremental_two_runs": f"""SELECT 1 AS run, * FROM flagged1
        UNION ALL SELECT 2 AS run, * FROM flagged2""",
    "incremental_by_ledger": """SELECT 1 AS run, * FROM flagged1
        UNION ALL SELECT 2 AS run, * FROM flagged2""",
    "incremental_noop": f"""SELECT 1 AS run, 'landed' AS status, (SELECT count(*) FROM part1) AS read_rows,
            (SELECT count(*) FROM part1) AS new_rows, strftime(max_ts, '{ISO}') AS last_successful_watermark FROM mark1
        UNION ALL SELECT 2, 'idle', 0, 0, strftime(max_ts, '{ISO}') FROM mark1
        UNION ALL SELECT 3, 'landed', (SELECT count(*) FROM ({_since('validated_incremental', 'mark1')}) AS s),
            (SELECT count(*) FROM new2),
            strftime(greatest((SELECT max(transaction_ts) FROM valid2), max_ts), '{ISO}') FROM mark1""",
    "summary_after_two_runs": "SELECT * FROM summary_of_runs",
    "published_bronze": "SELECT * FROM both_runs",
    "incremental_retry": f"""SELECT 1 AS run, * FROM flagged1
        UNION ALL SELECT 2 AS run, * FROM flagged2""",
    "incremental_compacted": "SELECT * FROM flagged1 UNION ALL SELECT * FROM flagged2",
    "incremental_quarantine": f"""SELECT 1 AS run, {FIELDS}, error_reason FROM part1 WHERE NOT is_valid
        UNION ALL SELECT 2 AS run, {FIELDS}, error_reason FROM new2 WHERE NOT is_valid""",
    "stream_ingest": """SELECT 1 AS batch, * FROM flagged1
        UNION ALL SELECT 2 AS batch, * FROM flagged_stream""",
    "late_rows": f"""SELECT {FIELDS}, CASE WHEN try_strptime(transaction_date, '{ISO}') IS NULL
            THEN 'date cannot be read' ELSE 'before the lookback' END AS left_out_because
        FROM (SELECT * REPLACE (CASE
            WHEN transaction_date LIKE '%7Z' THEN replace(transaction_date, '-0', '-')
            WHEN transaction_date LIKE '%9Z' THEN 'on ' || transaction_date
            ELSE transaction_date END AS transaction_date) FROM raw) AS d
        WHERE NOT COALESCE(try_strptime(transaction_date, '{ISO}') >=
            (SELECT max(transaction_ts) FROM bronze) - INTERVAL 1 DAY, false)""",
    "sink_full_load": "SELECT * FROM bronze",
    "sink_append": f"SELECT {VALID_FIELDS} FROM valid1 UNION ALL SELECT {VALID_FIELDS} FROM valid_rest",
    "sink_summary": "SELECT * FROM summary",
    "export_csv": """SELECT account_id, CAST(transaction_date AS VARCHAR) AS transaction_date,
        CAST(total_debit_amount AS VARCHAR) AS total_debit_amount,
        CAST(total_credit_amount AS VARCHAR) AS total_credit_amount,
        CAST(net_amount AS VARCHAR) AS net_amount,
        CAST(transaction_count AS VARCHAR) AS transaction_count,
        CAST(distinct_merchants AS VARCHAR) AS distinct_merchants,
        top_category, currencies FROM summary""",
    "export_quarantine_csv": f"""SELECT NULLIF(transaction_id, '') AS transaction_id,
        {', '.join(LANDING_FIELDS[1:])}, error_reason FROM quarantine_full""",
    "dq_not_null": """SELECT * FROM faulty WHERE account_id IS NULL OR transaction_date IS NULL
        OR total_debit_amount IS NULL OR total_credit_amount IS NULL OR net_amount IS NULL
        OR transaction_count IS NULL OR distinct_merchants IS NULL OR top_category IS NULL
        OR currencies IS NULL""",
    "dq_unique_key": """SELECT account_id, transaction_date, COUNT(*) AS n FROM faulty
        GROUP BY account_id, transaction_date HAVING COUNT(*) > 1""",
    "dq_net_identity": "SELECT * FROM faulty WHERE net_amount <> total_credit_amount - total_debit_amount",
    "dq_positive_count": "SELECT * FROM faulty WHERE transaction_count <= 0",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(final) for name, final in FINALS.items()}
