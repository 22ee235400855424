"""SQL counterparts of the registered queries, in the dialect of DuckDB.

Each statement rebuilds the derived payments and companies from the given tables and is
written against the meaning of the query, not its Spark plan.
"""

from __future__ import annotations

TX = """
SELECT concat('trx_', substr(m,1,8),'-',substr(m,9,4),'-',substr(m,13,4),'-',substr(m,17,4),'-',substr(m,21,12)) AS transaction_id,
  concat(replace(cast(l_shipdate as string),' ','T'),'-03:00') AS event_timestamp,
  concat('1', lpad(cast(o_custkey as string),13,'0')) AS payer_cnpj,
  concat('2', lpad(cast(l_suppkey as string),13,'0')) AS receiver_cnpj,
  concat('INV-', cast(l_orderkey as string)) AS invoice_id,
  CASE WHEN l_orderkey % 97 = 5 THEN l_extendedprice * 1024 WHEN l_linenumber = 1 THEN l_extendedprice * 4
    ELSE l_extendedprice END AS amount,
  CASE l_linenumber % 3 WHEN 0 THEN 'PIX' WHEN 1 THEN 'TED' ELSE 'BOLETO' END AS payment_method,
  cast(l_shipdate as date) AS due_date,
  concat('part ', cast(l_partkey as string)) AS description,
  l_orderkey AS invoice,
  f.file_seq AS file_seq
FROM (SELECT *, md5(concat(cast(l_orderkey as string),'-',cast(l_linenumber as string))) AS m FROM lineitem) l
JOIN orders o ON l_orderkey = o_orderkey
JOIN (SELECT 0 AS replay, 0 AS k, 0 AS file_seq UNION ALL SELECT 0,1,1 UNION ALL SELECT 0,2,2 UNION ALL SELECT 0,3,3 UNION ALL
      SELECT 1,0,4 UNION ALL SELECT 1,1,4 UNION ALL SELECT 1,2,4 UNION ALL SELECT 1,3,4) f
  ON l_suppkey % 4 = f.k AND (f.replay = 0 OR l_orderkey % 10 = 0)
"""

REG = """
SELECT concat('1', lpad(cast(c_custkey as string),13,'0')) AS cnpj, c_custkey AS number,
  CASE c_custkey % 10 WHEN 0 THEN 'BAIXADA' WHEN 1 THEN 'SUSPENSA' ELSE 'ATIVO' END AS status,
  cast(DATE '2024-01-01' - cast((c_custkey*37) % 3000 as int) as string) AS activity_start_date,
  cast(abs(c_acctbal)*16 as float) AS capital_stock
FROM customer WHERE c_custkey % 50 <> 49
UNION ALL
SELECT concat('2', lpad(cast(s_suppkey as string),13,'0')), s_suppkey,
  CASE s_suppkey % 8 WHEN 3 THEN 'INAPTA' ELSE 'ATIVO' END,
  cast(DATE '2024-01-01' - cast((s_suppkey*41) % 2500 as int) as string),
  cast(abs(s_acctbal)*16 as float)
FROM supplier
"""

# Every customer and supplier, registered or not.
ALL_REG = REG.replace("FROM customer WHERE c_custkey % 50 <> 49", "FROM customer")

# Some companies again, as they were or changed; of each the latest, then greatest row counts.
REPEATED_REG = f"""
SELECT cnpj, number, status, activity_start_date, capital_stock FROM (
  SELECT *, row_number() OVER (PARTITION BY cnpj ORDER BY activity_start_date DESC, status DESC, capital_stock DESC) AS nth
  FROM (
    {REG}
    UNION ALL SELECT * FROM ({REG}) WHERE number % 2 = 0
    UNION ALL SELECT cnpj, number, 'NULA', '1990-01-01', capital_stock FROM ({REG}) WHERE number % 3 = 0
    UNION ALL SELECT cnpj, number, 'NULA', '2023-12-31', capital_stock FROM ({REG}) WHERE number % 5 = 1
  )
) WHERE nth = 1
"""

KEYED_FROM = """
SELECT t.* EXCLUDE (transaction_id), substr(transaction_id, 5) AS transaction_id,
  substr(sha256(substr(transaction_id, 5) || '|' || payer_cnpj || '|' || receiver_cnpj || '|' ||
    cast(amount as string) || '|' || invoice_id || '|' || description), 1, 32) AS payload_hash
FROM {source} t
"""

AGED = """
SELECT cnpj, status, number,
  cast(round((DATE '2024-01-01' - cast(activity_start_date as date)) / cast(365.25 as double), 1) as float) AS company_age,
  capital_stock
FROM reg
"""

# The rows to enrich are in {source}.
ENRICHED_FROM = """
SELECT k.*, p.status AS payer_status, p.company_age AS payer_company_age, p.capital_stock AS payer_capital_stock,
  r.status AS receiver_status, r.company_age AS receiver_company_age
FROM {source} k LEFT JOIN aged p ON k.payer_cnpj = p.cnpj LEFT JOIN aged r ON k.receiver_cnpj = r.cnpj
"""

CONDITIONS = {
    "payer_cnpj_inactive": (50, "payer_status <> 'ATIVO'"),
    "receiver_cnpj_inactive": (50, "receiver_status <> 'ATIVO'"),
    "receiver_less_than_1_year": (10, "receiver_company_age < 1"),
    "payer_less_than_1_year": (10, "payer_company_age < 1"),
    "amount_over_payer_capital": (20, "amount > payer_capital_stock"),
    "amount_over_100k": (10, "amount > 100000"),
}

MUTATED = {"payload_mutation_detected": (75, "mutated")}

OPERATORS = {
    "payer_active": (1, "payer_status = 'ATIVO'"),
    "receiver_not_active": (2, "receiver_status <> 'ATIVO'"),
    "payer_older": (4, "payer_company_age > receiver_company_age"),
    "payer_younger": (8, "payer_company_age < receiver_company_age"),
    "amount_from_50k": (16, "amount >= 50000"),
    "amount_within_capital": (32, "amount <= payer_capital_stock"),
    "same_status": (64, "payer_status = receiver_status"),
    "other_age": (128, "payer_company_age <> receiver_company_age"),
    "payer_from_four_years": (256, "payer_company_age >= 4"),
    "small_capital": (512, "payer_capital_stock < cast(20000.5 as double)"),
    "never": (1024, "payer_status > NULL"),
}


def score_of(conditions: dict) -> str:
    return " + ".join(f"CASE WHEN {c} THEN {points} ELSE 0 END" for points, c in conditions.values())


def reasons_of(conditions: dict) -> str:
    listed = ", ".join(f"CASE WHEN {c} THEN '{reason}' END" for reason, (_, c) in conditions.items())
    return f"cast(to_json(list_filter([{listed}], lambda x: x IS NOT NULL)) as varchar)"


def fact_columns(conditions: dict) -> str:
    return f"""transaction_id, payer_cnpj, receiver_cnpj,
  cast(cast(amount as decimal(15,2)) as double) AS amount, payer_status, receiver_status,
  cast(cast(payer_company_age as decimal(5,2)) as double) AS payer_company_age,
  cast(cast(receiver_company_age as decimal(5,2)) as double) AS receiver_company_age,
  cast(cast(payer_capital_stock as decimal(19,2)) as double) AS payer_capital_stock,
  cast({score_of(conditions)} as integer) AS risk_score, {reasons_of(conditions)} AS score_reasons,
  payload_hash, cast(epoch(TIMESTAMP '2024-01-01 12:00:00') as bigint) AS processed_at"""


SCORED_FACT = fact_columns(CONDITIONS)
MUTATED_FACT = fact_columns({**CONDITIONS, **MUTATED})


def derived(body: str, **steps: str) -> str:
    """A query over the derived payments (``tx``, ``keyed``), companies (``reg``, ``aged``)
    and further named steps."""
    named = {"tx": TX, "reg": REG, "aged": AGED, "keyed": KEYED_FROM.format(source="tx"), **steps}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in named.items()) + "\n" + body


def history(rows: str, epoch: str) -> dict[str, str]:
    """First arrivals of each pair; mutated when its id is older than the pair."""
    return {
        "ranked": f"""SELECT *, {epoch} AS epoch,
            row_number() OVER (PARTITION BY transaction_id, payload_hash ORDER BY {epoch}) AS nth FROM {rows}""",
        "firsts": """SELECT * EXCLUDE (nth),
            epoch > min(epoch) OVER (PARTITION BY transaction_id) AS mutated FROM ranked WHERE nth = 1""",
        "enriched": ENRICHED_FROM.format(source="firsts"),
    }


#: Payments whose companies are both registered, the only ones that can land.
LANDABLE = {
    "known": """SELECT * FROM keyed WHERE payer_cnpj IN (SELECT cnpj FROM reg)
        AND receiver_cnpj IN (SELECT cnpj FROM reg)"""
}
LANDED = {**LANDABLE, **history("known", "file_seq")}

BY_ID = """SELECT *, row_number() OVER (PARTITION BY file_seq ORDER BY transaction_id, payload_hash) - 1 AS rn FROM keyed"""

RISK_HISTORY = derived(f"SELECT {MUTATED_FACT} FROM enriched", **history("keyed", "file_seq"))

LOADED = derived(
    f"SELECT {MUTATED_FACT}, cast(epoch as bigint) AS load_seq FROM enriched", **LANDED
)

# The last of three loads repeats invoices ending in 1 with another amount. A load sees
# what landed before it; pairs already there are left out.
INCREMENTAL = derived(
    f"SELECT {MUTATED_FACT}, load_seq FROM enriched",
    arrivals="""
      SELECT *, CASE WHEN file_seq < 4 THEN 0 ELSE 1 END AS load_seq FROM tx
      UNION ALL SELECT * REPLACE (amount + 1 AS amount), 2 FROM tx WHERE file_seq < 4 AND invoice % 10 = 1""",
    hashed=KEYED_FROM.format(source="arrivals"),
    known="""SELECT * FROM hashed WHERE payer_cnpj IN (SELECT cnpj FROM reg)
        AND receiver_cnpj IN (SELECT cnpj FROM reg)""",
    ordered="SELECT *, load_seq * 10 + file_seq AS epoch FROM known",
    pairs="""SELECT transaction_id, payload_hash, load_seq, epoch, any_value(payer_cnpj) AS payer_cnpj,
        any_value(receiver_cnpj) AS receiver_cnpj, any_value(amount) AS amount
        FROM ordered o WHERE NOT EXISTS (SELECT 1 FROM ordered e WHERE e.transaction_id = o.transaction_id
          AND e.payload_hash = o.payload_hash AND e.epoch < o.epoch) GROUP BY ALL""",
    flagged="""SELECT p.*, EXISTS (SELECT 1 FROM pairs e WHERE e.transaction_id = p.transaction_id
          AND e.payload_hash <> p.payload_hash AND e.epoch < p.epoch) AS mutated FROM pairs p""",
    enriched=ENRICHED_FROM.format(source="flagged"),
).replace(", load_seq FROM enriched", ", cast(load_seq as bigint) AS load_seq FROM enriched")

LIVE = "SELECT * FROM reg WHERE number % 3 = 0"
COMPANIES = "SELECT payer_cnpj AS cnpj FROM tx UNION SELECT receiver_cnpj FROM tx"
CACHE = dict(live=LIVE, companies=COMPANIES)
MARKED = "SELECT cnpj, cnpj IN (SELECT cnpj FROM live) AS hit FROM companies"

BLANKED = """
SELECT * REPLACE (
  CASE WHEN NOT (file_seq = 1 AND part) THEN amount END AS amount,
  CASE WHEN NOT (file_seq = 2 AND part) THEN due_date END AS due_date,
  CASE WHEN NOT (file_seq = 3 AND part) THEN description END AS description,
  CASE WHEN NOT (file_seq = 4 AND part) THEN transaction_id END AS transaction_id)
FROM (SELECT *, invoice % 10 = 3 OR invoice % 20 = 0 AS part FROM tx)
"""

INPUT = ["transaction_id", "event_timestamp", "payer_cnpj", "receiver_cnpj", "invoice_id",
         "amount", "payment_method", "due_date", "description"]
NULL_MEASURES = "count(*) AS total_rows, " + ", ".join(
    f"count(*) - count({name}) AS null_{name}" for name in INPUT
)

REGISTRY_RECORDS = """
SELECT concat('1', lpad(cast(c_custkey as string),13,'0')) AS cnpj, c_custkey AS k,
  '{' || concat_ws(',',
    CASE WHEN c_custkey % 7 <> 3 THEN '"descricao_situacao_cadastral":"' ||
      CASE WHEN c_custkey % 10 = 0 THEN 'BAIXADA' ELSE 'ATIVO' END || '"' END,
    CASE WHEN c_custkey % 11 = 4 THEN '"data_inicio_atividade":' || c_custkey
      ELSE '"data_inicio_atividade":"' ||
        cast(DATE '2024-01-01' - cast((c_custkey*37) % 3000 as int) as string) || '"' END,
    CASE WHEN c_custkey % 13 = 5 THEN '"capital_social":null'
      ELSE '"capital_social":' || cast(trunc(abs(c_acctbal) * 100) as bigint) END)
  || CASE WHEN c_custkey % 17 = 6 THEN '' ELSE '}' END AS raw
FROM customer
"""
RECORD_IS_VALID = """json_valid(raw) AND coalesce(
    json_type(try_cast(CASE WHEN json_valid(raw) THEN raw END AS json), '$.descricao_situacao_cadastral') = 'VARCHAR'
    AND json_type(try_cast(CASE WHEN json_valid(raw) THEN raw END AS json), '$.data_inicio_atividade') = 'VARCHAR'
    AND json_type(try_cast(CASE WHEN json_valid(raw) THEN raw END AS json), '$.capital_social') IN ('UBIGINT', 'BIGINT', 'DOUBLE'), false)"""

CANDIDATES = """
SELECT * REPLACE (
  CASE WHEN invoice % 101 = 1 THEN cast(1e14 as double) ELSE amount END AS amount,
  CASE WHEN invoice % 103 = 2 THEN receiver_cnpj || '0' ELSE receiver_cnpj END AS receiver_cnpj,
  CASE WHEN invoice % 107 = 3 THEN 'x' || transaction_id ELSE transaction_id END AS transaction_id)
FROM enriched
"""
VIOLATIONS = """concat_ws(',',
  CASE WHEN invoice % 107 = 3 THEN 'transaction_id' END,
  CASE WHEN invoice % 103 = 2 THEN 'receiver_cnpj' END,
  CASE WHEN payer_status IS NULL THEN 'payer_status' END,
  CASE WHEN receiver_status IS NULL THEN 'receiver_status' END,
  CASE WHEN invoice % 101 = 1 THEN 'amount' END,
  CASE WHEN payer_company_age IS NULL THEN 'payer_company_age' END,
  CASE WHEN receiver_company_age IS NULL THEN 'receiver_company_age' END,
  CASE WHEN payer_capital_stock IS NULL THEN 'payer_capital_stock' END)"""
ENRICHED = ENRICHED_FROM.format(source="keyed")
ENRICHED_COLUMNS = """SELECT transaction_id, payload_hash, file_seq, payer_cnpj, receiver_cnpj, payer_status,
  cast(payer_company_age as double) AS payer_company_age,
  cast(payer_capital_stock as double) AS payer_capital_stock, receiver_status,
  cast(receiver_company_age as double) AS receiver_company_age FROM enriched"""

ARRIVING = {
    "stored": "SELECT * FROM keyed WHERE file_seq < 3",
    "arriving": "SELECT * FROM keyed WHERE file_seq >= 3",
}

AUDIT = """
SELECT md5(cast(o_orderkey as string)) AS batch_id, 0 AS event_no, 'PROCESSING' AS status,
  concat('file_', o_orderkey, '.parquet') AS file, 0 AS total_rows, 0 AS inserted_rows,
  epoch_ms(cast(o_orderdate as timestamp)) AS started, NULL AS finished FROM orders
UNION ALL
SELECT md5(cast(o_orderkey as string)), 1, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' ELSE 'FAILED' END,
  concat('file_', o_orderkey, '.parquet'),
  CASE o_orderstatus WHEN 'F' THEN o_orderkey % 1000 ELSE 0 END,
  CASE o_orderstatus WHEN 'F' THEN o_orderkey % 700 ELSE 0 END,
  epoch_ms(cast(o_orderdate as timestamp)),
  epoch_ms(cast(o_orderdate as timestamp)) + (o_orderkey % 100000) * 10 FROM orders WHERE o_orderstatus <> 'O'
"""

AUDITED = derived(
    """SELECT 'load=000' || n.file_seq AS file, 'COMPLETED' AS status, total_rows,
         coalesce(inserted_rows, 0) AS inserted_rows
       FROM (SELECT file_seq, count(*) AS total_rows FROM keyed GROUP BY 1) n
       LEFT JOIN (SELECT epoch, count(*) AS inserted_rows FROM firsts GROUP BY 1) i ON i.epoch = n.file_seq""",
    **LANDED,
)

NULLS = derived(
    f"""SELECT *, greatest({", ".join(f"null_{name}" for name in INPUT)}) > 0 AS rejected
        FROM (SELECT file_seq, {NULL_MEASURES} FROM blanked GROUP BY 1)""",
    blanked=BLANKED,
)

ORACLES: dict[str, str] = {
    "risk_scored": derived(f"SELECT {SCORED_FACT} FROM enriched", enriched=ENRICHED),
    "risk_history": RISK_HISTORY,
    "risk_history_split": RISK_HISTORY,
    "risk_history_batched": derived(
        f"SELECT {MUTATED_FACT} FROM enriched",
        numbered=BY_ID,
        **history("numbered", "(cast(file_seq as bigint) * 4294967296 + rn // 1000)"),
    ),
    "incremental_load": INCREMENTAL,
    "folder_load": LOADED,
    "resumed_folder_load": LOADED,
    "folder_load_in_one_job": derived(f"SELECT {MUTATED_FACT} FROM enriched", **LANDED),
    "stream_load": LOADED,
    "batch_then_stream_load": LOADED,
    **dict.fromkeys(("folder_load_audit", "one_job_audit", "stream_audit"), AUDITED),
    "failing_load_audit": derived(
        """SELECT 'load=0000' AS file, 'COMPLETED' AS status, (SELECT count(*) FROM keyed WHERE file_seq = 0) AS total_rows,
             (SELECT count(*) FROM firsts WHERE epoch = 0) AS inserted_rows
           UNION ALL SELECT 'load=0001', 'FAILED', 0, 0""",
        **LANDED,
    ),
    "strip_and_hash": derived(
        """SELECT transaction_id AS written_id, file_seq, substr(transaction_id, 5) AS transaction_id,
             lower(substr(transaction_id, 5)) AS from_upper, lower(substr(transaction_id, 5)) AS from_braces,
             cast(NULL as varchar) AS from_written FROM tx"""
    ),
    "payload_fingerprint": derived("SELECT transaction_id, payload_hash, file_seq FROM keyed"),
    "plain_fingerprint": derived(
        """SELECT substr(transaction_id, 5) AS transaction_id, file_seq,
             substr(sha256(substr(transaction_id, 5) || '|' || payer_cnpj || '|' || receiver_cnpj || '|' ||
               CASE WHEN cast(cast(amount as decimal(38,2)) as double) = amount
                 THEN cast(cast(amount as decimal(38,2)) as string) ELSE cast(amount as string) END
               || '|' || invoice_id || '|' || description), 1, 32) AS payload_hash FROM tx"""
    ),
    "company_age": derived(
        """SELECT cnpj, status, cast(company_age as double) AS company_age,
             cast(capital_stock as double) AS capital_stock FROM aged""",
        reg=ALL_REG,
    ),
    "cache_expiries": """
        WITH spread AS (SELECT event_id, ts + event_id * INTERVAL 1 HOUR AS moment FROM events),
        walls AS (SELECT event_id, moment, moment - INTERVAL 3 HOUR AS wall FROM spread),
        due AS (SELECT event_id, moment, date_trunc('month', wall) + INTERVAL 14 DAY
            + CASE WHEN day(wall) < 15 THEN INTERVAL 0 MONTH ELSE INTERVAL 1 MONTH END + INTERVAL 3 HOUR AS expiry FROM walls)
        SELECT event_id, cast(epoch_us(greatest(expiry, moment + INTERVAL 1 SECOND)) // 1000000 as bigint) AS expires_at,
          cast(greatest((epoch_us(expiry) - epoch_us(moment)) // 1000000, 1) as bigint) AS ttl FROM due""",
    "payer_roles": derived(
        """SELECT cnpj AS payer_cnpj, status AS payer_status, cast(company_age as double) AS payer_company_age,
             cast(capital_stock as double) AS payer_capital_stock FROM aged""",
        reg=ALL_REG,
    ),
    "receiver_roles": derived(
        """SELECT cnpj AS receiver_cnpj, status AS receiver_status,
             cast(company_age as double) AS receiver_company_age FROM aged""",
        reg=ALL_REG,
    ),
    "enriched": derived(ENRICHED_COLUMNS, enriched=ENRICHED),
    "enriched_with_repeated_companies": derived(ENRICHED_COLUMNS, reg=REPEATED_REG, enriched=ENRICHED),
    "distinct_companies": derived(COMPANIES),
    "cache_split": derived(MARKED, **CACHE),
    "cache_stats": derived(
        """SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses,
             round(100.0 * count(*) FILTER (hit) / count(*)::double, 1) AS hit_rate FROM marked""",
        **CACHE, marked=MARKED,
    ),
    "cache_refresh": derived(
        """SELECT cnpj, status, activity_start_date, cast(capital_stock as double) AS capital_stock,
             cast(epoch(CASE number % 3 WHEN 0 THEN TIMESTAMP '2024-01-15 03:00:00'
               ELSE TIMESTAMP '2023-12-15 03:00:00' END) as bigint) AS expires_at FROM reg WHERE number % 3 <> 2
           UNION ALL
           SELECT cnpj, status, activity_start_date, cast(capital_stock as double),
             cast(epoch(TIMESTAMP '2024-01-15 03:00:00') as bigint) FROM reg
           WHERE cnpj IN (SELECT cnpj FROM companies) AND NOT EXISTS (SELECT 1 FROM live l WHERE l.cnpj = reg.cnpj)""",
        **CACHE,
    ),
    "cache_compacted": derived(
        """SELECT cnpj, CASE WHEN number % 4 = 0 THEN 'NULA' ELSE status END AS status, activity_start_date,
             cast(capital_stock as double) AS capital_stock,
             cast(epoch(TIMESTAMP '2024-01-15 03:00:00') as bigint) AS expires_at FROM live""",
        live=LIVE,
    ),
    "registry_merged": derived(
        """SELECT cnpj, status, activity_start_date, cast(capital_stock as double) AS capital_stock
           FROM reg WHERE cnpj IN (SELECT cnpj FROM companies)""",
        **CACHE,
    ),
    "registry_parsed": f"""
        WITH records AS ({REGISTRY_RECORDS})
        SELECT cnpj, raw->>'$.descricao_situacao_cadastral' AS status,
          raw->>'$.data_inicio_atividade' AS activity_start_date,
          cast(cast(raw->>'$.capital_social' as float) as double) AS capital_stock
        FROM records WHERE {RECORD_IS_VALID}""",
    "registry_rejected": f"""
        WITH records AS ({REGISTRY_RECORDS})
        SELECT cnpj, raw FROM records WHERE NOT ({RECORD_IS_VALID})""",
    "registry_fetched": derived(
        """SELECT cnpj, CASE WHEN n % 3 <> 0 THEN 'ATIVO' ELSE 'BAIXADA' END AS status,
             '2020-01-' || lpad(cast(n % 28 + 1 as string), 2, '0') AS activity_start_date,
             cast(cast(n * 16 as float) as double) AS capital_stock
           FROM (SELECT cnpj, cast(substr(cnpj, 2) as bigint) AS n FROM marked WHERE NOT hit)""",
        **CACHE, marked=MARKED,
    ),
    "rule_columns": derived(
        "SELECT transaction_id, payload_hash, file_seq, "
        + ", ".join(
            f"CASE WHEN {c} THEN {points} ELSE 0 END AS {reason}"
            for reason, (points, c) in CONDITIONS.items()
        )
        + " FROM enriched",
        enriched=ENRICHED,
    ),
    "rule_errors": """
        SELECT * FROM (SELECT p_partkey AS entry_no, CASE WHEN p_partkey % 29 = 8 OR p_partkey % 31 = 9 THEN 'not an object'
          ELSE concat_ws(', ',
            CASE WHEN p_partkey % 7 = 2 THEN 'column missing' WHEN p_partkey % 5 = 1 THEN 'column unknown' END,
            CASE WHEN p_partkey % 13 = 4 THEN 'operator missing' WHEN p_partkey % 11 = 3 THEN 'operator unknown' END,
            CASE WHEN p_partkey % 17 = 5 THEN 'points missing' WHEN p_partkey % 3 <> 0 THEN 'points not a whole number' END,
            CASE WHEN p_partkey % 19 = 6 THEN 'reason missing' END,
            CASE WHEN p_partkey % 4 = 3 AND p_partkey % 23 <> 7 THEN 'no operand' END,
            CASE WHEN p_partkey % 23 = 7 THEN 'compare_column unknown' END) END AS violations FROM part)
        WHERE violations <> ''""",
    "all_operators": derived(
        f"""SELECT transaction_id, payload_hash, file_seq, cast({score_of(OPERATORS)} as integer) AS risk_score,
              {reasons_of(OPERATORS)} AS score_reasons FROM enriched""",
        enriched=ENRICHED,
    ),
    "mutation_check": derived(
        """SELECT transaction_id, payload_hash, file_seq,
             EXISTS (SELECT 1 FROM stored s WHERE s.transaction_id = a.transaction_id
               AND s.payload_hash <> a.payload_hash) AS mutated FROM arriving a""",
        **ARRIVING,
    ),
    "unseen_rows": derived(
        """SELECT DISTINCT transaction_id, payload_hash, payer_cnpj, receiver_cnpj, amount FROM arriving a
           WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.transaction_id = a.transaction_id
             AND s.payload_hash = a.payload_hash)""",
        **ARRIVING,
    ),
    "sorted_rows": derived(
        """SELECT transaction_id, event_timestamp, payer_cnpj, receiver_cnpj, invoice_id, amount, payment_method,
             cast(due_date as string) AS due_date, description, file_seq, payload_hash FROM keyed"""
    ),
    "sorted_batches": derived(
        """SELECT file_seq, cast(rn // 1000 as bigint) AS batch_no, count(*) AS batch_rows,
             min(transaction_id) AS first_id, max(transaction_id) AS last_id FROM numbered GROUP BY ALL""",
        numbered=BY_ID,
    ),
    **dict.fromkeys(("null_report", "footer_null_report"), NULLS),
    "loads_to_read": derived(
        """SELECT load_seq, count(DISTINCT transaction_id) AS ids
           FROM (SELECT transaction_id, cast(substr(receiver_cnpj, 2) as bigint) % 97 AS load_seq FROM keyed WHERE file_seq < 4)
           WHERE transaction_id IN (SELECT transaction_id FROM keyed WHERE file_seq = 4
             AND cast(substr(receiver_cnpj, 2) as bigint) % 97 < 10 AND invoice % 30 = 0) GROUP BY 1"""
    ),
    "null_totals": derived(f"SELECT {NULL_MEASURES} FROM blanked", blanked=BLANKED),
    "null_gate": derived(
        f"""SELECT file_seq, payment_method, count(*) AS passed FROM blanked WHERE file_seq NOT IN (
             SELECT file_seq FROM blanked WHERE {" OR ".join(f"{name} IS NULL" for name in INPUT)}) GROUP BY ALL""",
        blanked=BLANKED,
    ),
    "landing_rejects": derived(
        f"""SELECT * FROM (SELECT transaction_id, payload_hash, file_seq, {VIOLATIONS} AS violations FROM candidates)
            WHERE violations <> ''""",
        enriched=ENRICHED, candidates=CANDIDATES,
    ),
    "landing_accepted": derived(
        f"SELECT {SCORED_FACT} FROM enriched WHERE payer_status IS NOT NULL AND receiver_status IS NOT NULL "
        "AND invoice % 101 <> 1 AND invoice % 103 <> 2 AND invoice % 107 <> 3",
        enriched=ENRICHED,
    ),
    "key_uniqueness": derived(
        """SELECT 'delivered' AS stage, count(*) FILTER (n > 1) AS repeated_keys,
             cast(coalesce(sum(n) FILTER (n > 1), 0) as bigint) AS repeated_rows, cast(sum(n) as bigint) AS all_rows
           FROM (SELECT count(*) AS n FROM keyed GROUP BY transaction_id, payload_hash)
           UNION ALL SELECT 'inserted', 0, 0, count(*) FROM (SELECT DISTINCT transaction_id, payload_hash FROM keyed)"""
    ),
    "files_processed": derived(
        "SELECT 'load=000' || file_seq AS file, file_seq, count(*) AS total_rows FROM tx GROUP BY ALL"
    ),
    "audit_state": f"""
        WITH events_log AS ({AUDIT}),
        last AS (SELECT arg_max(e, event_no) AS e FROM events_log e GROUP BY batch_id)
        SELECT e.batch_id AS batch_id, e.status AS status, e.file AS file, cast(e.total_rows as bigint) AS total_rows,
          cast(e.inserted_rows as bigint) AS inserted_rows,
          cast(coalesce((e.finished - e.started) / 1000.0, 0) as double) AS duration_seconds,
          cast(e.started // 1000 as bigint) AS started_at, cast(e.finished // 1000 as bigint) AS finished_at FROM last""",
    "load_ids": f"""
        WITH ids AS (SELECT file, lpad(lower(to_hex(started)), 12, '0') AS t, batch_id AS x FROM ({AUDIT}) WHERE event_no = 0)
        SELECT file, substr(t,1,8) || '-' || substr(t,9,4) || '-7' || substr(x,1,3) || '-' ||
          substr('89ab', cast(('0x' || substr(x,4,1)) as int) % 4 + 1, 1) || substr(x,5,3) || '-' || substr(x,8,12) AS load_id FROM ids""",
}
