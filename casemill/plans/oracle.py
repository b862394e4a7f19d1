"""DuckDB SQL stating the answer of every catalogue query from the base tables.

The SQL derives each answer directly from `orders`, `customer` and `events`
(not from the JSON the Spark side parses) and states the field lists and column
mappings itself, so the two sides are independent.
Helpers below only assemble long, repetitive select lists.
"""

from __future__ import annotations

# The record's fields, the tables' columns and which field a
# column takes.  Stated here again, not imported, so that a slip in the
# library's own lists shows as a difference.
CASE_FIELDS = """
age balance bankCard cardId contacts contactsPhone contactsRemark contactsType entrustAmt entrustEndDate
entrustStartDate lastRepayTime loanAmt loanDate mobile name orgName overdueAmt overdueDate overdueDays
overdueId overdueStatus overdueTotalAmt productName realAmt sex stages status address callRecordTopTen seqNo
address2 companyAddress permanentAddress companyName repayAmt lastRepayAmt repayNum homePhone companyPhone
qq weChat email aliId contacts2 contactsType2 contactsPhone2 contactsRemark2 allotId loanType collectionType
billDate interestRate startSeatNo createdDate updatedDate contracNo
""".split()
UPDATE_FIELDS = """
mobile overdueAmt overdueDays overdueId overdueStatus overdueTotalAmt seqNo status lastRepayTime
lastRepayAmt
""".split()
CASE_REPORT_COLUMNS = """
overdue_id name card_id phone org_name contract_no age sex email qq wechat ali_id real_amt overdue_total_amt
entrust_amt overdue_days address address_detail company_address permanent_address bank_card company_name
loan_date stages loan_amt repay_amt balance product_name overdue_amt overdue_status last_repay_time
repay_num home_phone company_phone contacts contacts_type contacts_phone contacts_remark contacts1
contacts1_type contacts1_phone contacts1_remark remark overdue_date created_date updated_date
entrust_start_date entrust_end_date seq_no last_repay_amt allot_id call_record_top_ten loan_type
collection_type
""".split()
CASE_HISTORY_COLUMNS = """
overdueId seqNo name age sex cardId address2 address companyAddress permanentAddress mobile orgName loanDate
stages loanAmt realAmt repayAmt balance overdueAmt overdueTotalAmt overdueStatus lastRepayTime lastRepayAmt
loanType overdueDays entrustAmt collectionType repayNum billDate productName bankCard companyName
interestRate entrustStartDate entrustEndDate homePhone companyPhone qq weChat email aliId startSeatNo status
""".split()
# column:field
CASE_REPORT_MAPPING = [tuple(x.split(":")) for x in """
overdue_id:overdueId name:name card_id:cardId phone:mobile org_name:orgName contract_no:contracNo age:age
sex:sex email:email qq:qq wechat:weChat ali_id:aliId real_amt:realAmt overdue_total_amt:overdueTotalAmt
entrust_amt:entrustAmt overdue_days:overdueDays address:address2 address_detail:address
company_address:companyAddress permanent_address:permanentAddress bank_card:bankCard
company_name:companyName loan_date:loanDate stages:stages loan_amt:loanAmt repay_amt:repayAmt
balance:balance product_name:productName overdue_amt:overdueAmt overdue_status:overdueStatus
last_repay_time:lastRepayTime repay_num:repayNum home_phone:homePhone company_phone:companyPhone
contacts:contacts contacts_type:contactsType contacts_phone:contactsPhone contacts_remark:contactsRemark
contacts1:contacts2 contacts1_type:contactsType2 contacts1_phone:contactsPhone2
contacts1_remark:contactsRemark2 remark:status overdue_date:overdueDate created_date:createdDate
updated_date:updatedDate entrust_start_date:entrustStartDate entrust_end_date:entrustEndDate seq_no:seqNo
last_repay_amt:lastRepayAmt allot_id:allotId call_record_top_ten:callRecordTopTen
""".split()]
# column:field; =name is a constant, @as_of the run date
NORMAL_UPDATE_SET = [tuple(x.split(":")) for x in """
last_repay_amt:lastRepayAmt last_repay_time:lastRepayTime phone:mobile overdue_amt:overdueAmt
overdue_days:overdueDays overdue_status:overdueStatus overdue_total_amt:overdueTotalAmt seq_no:seqNo
remark:status loan_type:=LOAN_TYPE_CREDIT updated_date:@as_of
""".split()]
CLOSE_UPDATE_SET = [tuple(x.split(":")) for x in """
last_repay_amt:lastRepayAmt last_repay_time:lastRepayTime phone:mobile overdue_days:overdueDays seq_no:seqNo
remark:status balance:=ZERO overdue_amt:=ZERO overdue_total_amt:=ZERO overdue_status:=ZERO
loan_type:=LOAN_TYPE_CREDIT collection_type:=COLLECTION_RECOVERED repay_num:=ONE entrust_end_date:@as_of
updated_date:@as_of
""".split()]
CONSTANTS = {'UNKNOWN': '未知', 'LOAN_TYPE_CREDIT': '信贷', 'COLLECTION_RECOVERED': '回收', 'ZERO': '0', 'ONE': '1', 'BLANK': ''}
UNKNOWN = '未知'

AS_OF = "2024-06-30"
NULL = "CAST(NULL AS VARCHAR)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cols(names, exprs: dict[str, str]) -> str:
    return ",\n  ".join(f'{exprs.get(n, NULL)} AS "{n}"' for n in names)


# ---------------------------------------------------------------------------
# base CTEs
# ---------------------------------------------------------------------------

D1 = """d1 AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_name, o.o_orderpriority, o.o_orderstatus, c.c_mktsegment,
         strftime(o.o_orderdate, '%Y-%m-%d') AS loan_date,
         CAST(o.o_custkey % 4 AS INTEGER) AS kpart,
         CASE WHEN o.o_orderkey % 37 = 0 THEN NULL ELSE CAST(o.o_custkey % 200 AS VARCHAR) END AS mobile,
         CASE WHEN o.o_orderkey % 50 = 1 THEN 'empty'
              WHEN o.o_orderkey % 50 = 0 THEN 'corrupt'
              WHEN o.o_orderkey % 37 = 0 THEN 'no_phone' END AS reason
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""
D1_ID = "CASE WHEN o_custkey % 5 = 0 THEN 'N' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END"

# case message fields of a valid D1 row
D1_FIELDS = {
    "overdueId": D1_ID,
    "mobile": "mobile",
    "name": "c_name",
    "productName": "o_orderpriority",
    "status": "o_orderstatus",
    "address2": "c_mktsegment",
    "loanDate": "loan_date",
    "seqNo": "CAST(o_orderkey AS VARCHAR)",
}

D1_FIELDS = {f: f"'{f}-' || (o_orderkey % {len(f) + 3})" for f in CASE_FIELDS} | D1_FIELDS
D1_FIELDS["loanAmt"] = f"CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey || '.50' ELSE {D1_FIELDS['loanAmt']} END"

D2 = """d2 AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS mobile,
         CASE WHEN event_type = 'purchase' THEN 'CLOSE' WHEN event_type = 'error' THEN NULL
              ELSE event_type END AS status,
         CAST(event_id % 90 AS VARCHAR) AS overdue_days,
         CAST(user_id % 3 AS INTEGER) AS kpart
  FROM events
)"""

D2_FIELDS = {
    "mobile": "mobile",
    "overdueDays": "overdue_days",
    "overdueId": "CAST(user_id AS VARCHAR)",
    "seqNo": "CAST(event_id AS VARCHAR)",
    "status": "status",
}

D2_FIELDS = {f: f"'{f}-' || (event_id % {len(f) + 3})" for f in UPDATE_FIELDS} | D2_FIELDS

PROFILE = f"""pe AS (
  SELECT user_id, event_id, event_type, json_extract_string(props, '$.k') AS peer FROM events
),
ce AS (
  SELECT user_id, peer, COUNT(*) AS cnt FROM pe GROUP BY user_id, peer
),
rk AS (
  SELECT user_id, peer, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, peer ASC NULLS LAST) AS rn FROM ce
),
ptop AS (
  SELECT CAST(user_id AS VARCHAR) AS phone, string_agg(peer, ',' ORDER BY rn) AS top FROM rk WHERE rn <= 10 GROUP BY user_id
),
paddr AS (
  SELECT CAST(user_id AS VARCHAR) AS phone, 'addr-' || CAST(MIN(event_id) AS VARCHAR) AS addr
  FROM events WHERE event_type = 'signup' GROUP BY user_id
),
pshared AS (
  SELECT CAST(user_id AS VARCHAR) AS phone, 'addr-' || CAST(MIN(event_id) AS VARCHAR) AS shared
  FROM events WHERE event_type = 'view' GROUP BY user_id
),
pfull AS (
  SELECT p.phone,
         COALESCE(ptop.top, {_q(UNKNOWN)}) AS top,
         COALESCE(paddr.addr, {_q(UNKNOWN)}) AS addr,
         COALESCE(pshared.shared, {_q(UNKNOWN)}) AS shared
  FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS phone FROM events) p
  LEFT JOIN ptop ON ptop.phone = p.phone
  LEFT JOIN paddr ON paddr.phone = p.phone
  LEFT JOIN pshared ON pshared.phone = p.phone
)"""

SNAP = "snap AS (\n  SELECT\n  " + _cols(CASE_REPORT_COLUMNS, {
    "overdue_id": "CASE WHEN c_custkey % 3 = 0 THEN 'X' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END",
    "phone": "CAST(c_custkey % 200 AS VARCHAR)",
    "remark": "c_mktsegment",
    "balance": "'9'",
    "loan_type": "'old'",
}) + "\n  FROM customer\n)"

IDS = """lines AS (
  SELECT CAST(c_custkey AS VARCHAR) AS v FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT ' ' || CAST(c_custkey AS VARCHAR) || ' ' FROM customer WHERE c_custkey % 14 = 0
  UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '   ' END FROM customer WHERE c_custkey % 49 = 0
  UNION ALL SELECT '900000000000' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 70 = 0
),
ids AS (SELECT DISTINCT trim(v) AS overdue_id FROM lines WHERE trim(v) <> '')"""

BOUNDS = """b AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS p, MIN(event_id) AS first_off, MAX(event_id) + 1 AS end_off
  FROM events GROUP BY 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# change rows (op, k, b, tr, off, 54 columns) and their fold
# ---------------------------------------------------------------------------

def _report_from_fields(fields: dict[str, str]) -> dict[str, str]:
    """case_report column expressions from case-field expressions."""
    return {col: fields[f] for col, f in CASE_REPORT_MAPPING if f in fields}


def _set_sql(spec: str) -> str:
    if spec.startswith("="):
        return _q(CONSTANTS[spec[1:]])
    if spec == "@as_of":
        return _q(AS_OF)
    return D2_FIELDS.get(spec, NULL)


NORMAL_COLS = [c for c, _ in NORMAL_UPDATE_SET]
CLOSE_COLS = [c for c, _ in CLOSE_UPDATE_SET]


def _update_cols() -> dict[str, str]:
    normal = {c: _set_sql(s) for c, s in NORMAL_UPDATE_SET}
    close = {c: _set_sql(s) for c, s in CLOSE_UPDATE_SET}
    out = {"overdue_id": "CAST(user_id AS VARCHAR)"}
    for c in set(normal) | set(close):
        out[c] = f"CASE WHEN status = 'CLOSE' THEN {close.get(c, NULL)} ELSE {normal.get(c, NULL)} END"
    return out


def _change_select(op: str, k: str, b: str, tr: int, off: str, cols: dict[str, str], src: str) -> str:
    return (f"SELECT {op} AS op, {k} AS k, {b} AS b, {tr} AS tr, {off} AS off,\n  "
            + _cols(CASE_REPORT_COLUMNS, cols) + f"\n  FROM {src}")


def r_changes(fields: dict[str, str], batch: str = "0") -> str:
    cols = _report_from_fields(fields)
    return _change_select("'R'", D1_ID, batch, 0, "o_orderkey", cols,
                          "d1v")


def u_changes(batch: str = "0", ops: str | None = None) -> str:
    op = "CASE WHEN status = 'CLOSE' THEN 'C' ELSE 'U' END"
    where = "mobile IS NOT NULL"
    if ops == "U":
        where += " AND status IS DISTINCT FROM 'CLOSE'"
    elif ops == "C":
        where += " AND status = 'CLOSE'"
    return _change_select(op, "CAST(user_id AS VARCHAR)", batch, 1, "event_id", _update_cols(),
                          f"d2 WHERE {where}")


def fold_sql(touch: dict[str, tuple[str, ...]], inserts: bool) -> str:
    """Fold of CTE `ch` over CTE `snap`: per column, the last change (by b,
    tr, off) among the ops that write it; keys with a replace are inserted."""
    sets: dict[tuple[str, ...], str] = {}
    for ops in touch.values():
        sets.setdefault(tuple(sorted(ops)), f"l{len(sets)}")
    ctes = []
    for ops, name in sets.items():
        in_list = ", ".join(_q(o) for o in ops)
        ctes.append(f"{name} AS (SELECT * FROM ch WHERE op IN ({in_list}) "
                    f"QUALIFY row_number() OVER (PARTITION BY k ORDER BY b DESC, tr DESC, off DESC) = 1)")
    keys = "keys AS (SELECT overdue_id AS k FROM snap"
    keys += " UNION SELECT k FROM ch WHERE op = 'R')" if inserts else ")"
    ctes.append(keys)
    exprs = {}
    for col in CASE_REPORT_COLUMNS:
        if col == "overdue_id":
            exprs[col] = "keys.k"
            continue
        if col not in touch:
            exprs[col] = f's."{col}"'
            continue
        name = sets[tuple(sorted(touch[col]))]
        exprs[col] = f'CASE WHEN {name}.k IS NOT NULL THEN {name}."{col}" ELSE s."{col}" END'
    joins = "".join(f"\nLEFT JOIN {name} ON {name}.k = keys.k" for name in sets.values())
    return (",\n" + ",\n".join(ctes) + "\nSELECT\n  " + _cols(CASE_REPORT_COLUMNS, exprs)
            + "\nFROM keys LEFT JOIN snap s ON s.overdue_id = keys.k" + joins)


def _touch(replace: bool, updates: bool) -> dict[str, tuple[str, ...]]:
    t: dict[str, list[str]] = {}
    if replace:
        for c in CASE_REPORT_COLUMNS:
            t.setdefault(c, []).append("R")
    if updates:
        for c in NORMAL_COLS:
            t.setdefault(c, []).append("U")
        for c in CLOSE_COLS:
            t.setdefault(c, []).append("C")
    return {c: tuple(v) for c, v in t.items()}


D1V = "d1v AS (SELECT * FROM d1 WHERE reason IS NULL)"


def _enriched_fields(full: bool) -> dict[str, str]:
    f = dict(D1_FIELDS)
    f.update({
        "address": f"COALESCE(pf.addr, {_q(UNKNOWN)})",
        "callRecordTopTen": f"COALESCE(pf.top, {_q(UNKNOWN)})",
        "createdDate": _q(AS_OF),
        "updatedDate": _q(AS_OF),
    })
    if full:
        f["companyAddress"] = f"COALESCE(pf.shared, {_q(UNKNOWN)})"
        f["permanentAddress"] = f"COALESCE(pf.shared, {_q(UNKNOWN)})"
    return f


ENRICHED_SRC = "d1v LEFT JOIN pfull pf ON pf.phone = d1v.mobile"


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def _sql_case_parse() -> str:
    return _with(D1) + ("SELECT\n  " + _cols(CASE_FIELDS, D1_FIELDS)
                        + ",\n  'case_increment' AS topic, kpart AS \"partition\", o_orderkey AS \"offset\""
                        + "\nFROM d1 WHERE reason IS NULL")


def _sql_case_quarantine() -> str:
    return _with(D1) + "SELECT reason, COUNT(*) AS n FROM d1 WHERE reason IS NOT NULL GROUP BY reason"


def _sql_update_parse() -> str:
    return _with(D2) + ("SELECT\n  " + _cols(UPDATE_FIELDS, D2_FIELDS)
                        + ",\n  'case_update' AS topic, kpart AS \"partition\", event_id AS \"offset\""
                        + "\nFROM d2 WHERE mobile IS NOT NULL")


def _sql_status_route() -> str:
    return _with(D2) + ("SELECT CAST(event_id AS VARCHAR) AS \"seqNo\", CAST(user_id AS VARCHAR) AS \"overdueId\", "
                        "status, CASE WHEN status = 'CLOSE' THEN 'C' ELSE 'U' END AS op "
                        "FROM d2 WHERE mobile IS NOT NULL")


def _sql_profile(col: str, src: str) -> str:
    return _with(PROFILE) + f"SELECT phone, {src} AS {col} FROM pfull"


def _sql_enrich(full: bool) -> str:
    f = _enriched_fields(full)
    return _with(D1, D1V, PROFILE) + (
        "SELECT\n  " + _cols(CASE_FIELDS, f)
        + ",\n  o_orderkey AS \"offset\", CASE WHEN pf.phone IS NULL THEN 'missing' ELSE 'ok' END AS profile_status"
        + f"\nFROM {ENRICHED_SRC}")


def _sql_case_replace() -> str:
    ch = "ch AS (" + r_changes(D1_FIELDS) + ")"
    return _with(D1, D1V, SNAP, ch) + fold_sql(_touch(True, False), True)


def _sql_case_intake() -> str:
    ch = "ch AS (" + r_changes(_enriched_fields(True)).replace("FROM d1v", f"FROM {ENRICHED_SRC}") + ")"
    return _with(D1, D1V, PROFILE, SNAP, ch) + fold_sql(_touch(True, False), True)


def _sql_case_intake_basic() -> str:
    ch = "ch AS (" + r_changes(_enriched_fields(False)).replace("FROM d1v", f"FROM {ENRICHED_SRC}") + ")"
    return _with(D1, D1V, PROFILE, SNAP, ch) + fold_sql(_touch(True, False), True)


def _sql_history_replace() -> str:
    fields = {c: D1_FIELDS.get(c, NULL) for c in CASE_HISTORY_COLUMNS}
    fields["address"] = "''"
    last = ("last AS (SELECT * FROM d1 WHERE reason IS NULL "
            "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)")
    now = "now AS (SELECT\n  " + _cols(CASE_HISTORY_COLUMNS, fields) + "\nFROM last)"
    held = {c: NULL for c in CASE_HISTORY_COLUMNS} | {
        "overdueId": "CASE WHEN c_custkey % 3 = 0 THEN 'H' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END",
        "name": "c_name", "address": "'held'", "status": "c_mktsegment"}
    old = "old AS (SELECT\n  " + _cols(CASE_HISTORY_COLUMNS, held) + "\nFROM customer)"
    return _with(D1, last, now, old) + ('SELECT * FROM now UNION ALL SELECT * FROM old WHERE "overdueId" NOT IN '
                                        '(SELECT "overdueId" FROM now)')


def _sql_updates(ops: str | None) -> str:
    ch = "ch AS (" + u_changes("0", ops) + ")"
    return _with(D2, SNAP, ch) + fold_sql(_touch(False, True), False)


def _sql_change_log_fold() -> str:
    r = r_changes(D1_FIELDS, batch="o_orderkey // 5000")
    u = u_changes(batch="event_id // 5000")
    ch = "ch AS (" + r + "\nUNION ALL\n" + u + ")"
    return _with(D1, D1V, D2, SNAP, ch) + fold_sql(_touch(True, True), True)


BACKFILL_SQL = {
    "address_detail": "COALESCE(pf.addr, {u})",
    "call_record_top_ten": "COALESCE(pf.top, {u})",
    "company_address": "COALESCE(pf.shared, {u})",
    "permanent_address": "COALESCE(pf.shared, {u})",
}


def _sql_backfill(columns: list[str]) -> str:
    cols = {"overdue_id": "s.overdue_id"}
    cols.update({c: BACKFILL_SQL[c].format(u=_q(UNKNOWN)) for c in columns})
    src = ("snap s JOIN ids ON ids.overdue_id = s.overdue_id "
           "LEFT JOIN pfull pf ON pf.phone = s.phone")
    ch = "ch AS (" + _change_select("'E'", "s.overdue_id", "0", 2, "0", cols, src) + ")"
    touch = {c: ("E",) for c in columns}
    return _with(PROFILE, SNAP, IDS, ch) + fold_sql(touch, False)


def _sql_missing_ids() -> str:
    return _with(SNAP, IDS) + "SELECT overdue_id FROM ids WHERE overdue_id NOT IN (SELECT overdue_id FROM snap)"


def _sql_extract_cases() -> str:
    return _with(IDS) + (
        "SELECT CAST(o_custkey AS VARCHAR) AS \"overdueId\", o_orderpriority AS address, "
        "CAST(o_orderkey AS VARCHAR) AS \"callRecordTopTen\" FROM orders "
        "WHERE CAST(o_custkey AS VARCHAR) IN (SELECT overdue_id FROM ids)")


def _sql_ledger_advance() -> str:
    old = """old AS (
  SELECT 'case_update' AS groupid, 'case_update' AS topic, p AS kafka_partition, first_off AS kafka_offset FROM b WHERE p < 2
  UNION ALL
  SELECT 'case_increment', 'case_increment', p, first_off FROM b WHERE p = 0
)"""
    new = ("new AS (SELECT 'case_update' AS groupid, 'case_update' AS topic, p AS kafka_partition, "
           "end_off AS kafka_offset FROM b)")
    return _with(BOUNDS, old, new) + (
        "SELECT groupid, topic, CAST(kafka_partition AS INTEGER) AS kafka_partition, "
        "CAST(kafka_offset AS BIGINT) AS kafka_offset FROM new\nUNION ALL\n"
        "SELECT groupid, topic, CAST(kafka_partition AS INTEGER), CAST(kafka_offset AS BIGINT) FROM old "
        "WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.groupid = old.groupid AND new.topic = old.topic "
        "AND new.kafka_partition = old.kafka_partition)")


def _sql_ledger_resolve() -> str:
    e = "e AS (SELECT p, CASE WHEN p = 1 THEN end_off + 1 ELSE first_off END AS earliest FROM b)"
    st = "st AS (SELECT p, end_off AS stored FROM b WHERE p < 2)"
    return _with(BOUNDS, e, st) + (
        "SELECT 'case_update' AS topic, CAST(e.p AS INTEGER) AS \"partition\", "
        "CAST(CASE WHEN st.stored IS NULL OR e.earliest > st.stored THEN e.earliest ELSE st.stored END AS BIGINT) AS start_offset, "
        "CAST(CASE WHEN st.stored IS NULL OR e.earliest <= st.stored THEN 0 ELSE e.earliest - st.stored END AS BIGINT) AS lost "
        "FROM e LEFT JOIN st ON st.p = e.p")


def _slice(offset: str, top: str) -> str:
    """Micro-batch of a message fed in three parts of ascending offsets."""
    return f"({offset} * 3 // ({top} + 1))"


def _sql_stream_cases() -> str:
    top = "(SELECT GREATEST((SELECT MAX(o_orderkey) FROM d1), (SELECT MAX(event_id) FROM d2)))"
    r = r_changes(_enriched_fields(True), _slice("o_orderkey", top)).replace("FROM d1v", f"FROM {ENRICHED_SRC}")
    u = u_changes(_slice("event_id", top))
    ch = "ch AS (" + r + "\nUNION ALL\n" + u + ")"
    return _with(D1, D1V, D2, PROFILE, SNAP, ch) + fold_sql(_touch(True, True), True)


def _sql_profile_drift() -> str:
    """Values per path: a document per user and 500 event ids; users with odd
    ids have the undeclared shape."""
    rows = [  # path, type, status, shape (0 declared, 1 other), count of values
        ("$.baseInfo.mobile", "STRING", "declared", 0, "SELECT COUNT(*) FROM d"),
        ("$.baseInfo.mobile", "BIGINT", "other_type", 1, "SELECT COUNT(*) FROM d"),
        ("$.baseInfo.version", "STRING", "unknown", 1, "SELECT COUNT(*) FROM d"),
        ("$.mxReport.call_contact_detail[].peer_num", "STRING", "declared", 0, "SELECT COUNT(peer) FROM p"),
        ("$.mxReport.call_contact_detail[].call_cnt_6m", "STRING", "declared", 0, "SELECT COUNT(*) FROM p"),
        ("$.mxReport.call_contact_detail.*", "BIGINT", "unknown", 1, "SELECT COUNT(peer) FROM p")]
    for name, kind in (("cell_phone", "signup"), ("user_basic", "view")):
        for part in ("key", "value"):
            rows.append((f"$.mxReport.{name}[].{part}", "STRING", "declared", 0, "SELECT COUNT(*) FROM e"))
            rows.append((f"$.mxReport.{name}.{part}", "STRING", "unknown", 1,
                         f"SELECT COUNT(DISTINCT (user_id, part)) FROM e WHERE event_type = '{kind}'"))
    selects = []
    for path, kind, status, shape, count in rows:
        count += (" AND" if "WHERE" in count else " WHERE") + f" user_id % 2 = {shape}"
        selects.append(f"SELECT '{path}' AS path, '{kind}' AS type, '{status}' AS status, CAST(({count}) AS BIGINT) AS n_values")
    e = "e AS (SELECT user_id, event_type, event_id // 500 AS part, json_extract_string(props, '$.k') AS peer FROM events)"
    d, p = "d AS (SELECT DISTINCT user_id, part FROM e)", "p AS (SELECT DISTINCT user_id, part, peer FROM e)"
    return _with(e, d, p) + "SELECT * FROM (" + " UNION ALL ".join(selects) + ") WHERE n_values > 0"


def _sql_position_audit() -> str:
    return """WITH seen AS (
  SELECT CASE WHEN event_id // 500 % 3 < 2 THEN 0 ELSE 1 END AS p, event_id AS o,
         SUM(CASE WHEN event_type = 'purchase' OR event_id // 500 % 7 = 0 THEN 2 ELSE 1 END) AS n
  FROM events WHERE event_type <> 'error' GROUP BY p, o),
gaps AS (SELECT p, o, lag(o) OVER (PARTITION BY p ORDER BY o) AS b FROM seen),
runs AS (SELECT p, o, n, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run FROM seen WHERE n > 1),
spans AS (
  SELECT p, 'lost' AS kind, b + 1 AS first, o - 1 AS last, 0 AS messages FROM gaps WHERE o - b > 1
  UNION ALL
  SELECT p, 'repeated', MIN(o), MAX(o), SUM(n) FROM runs GROUP BY p, run)
SELECT 'case_update' AS topic, CAST(p AS INTEGER) AS partition, kind, CAST(first AS BIGINT) AS first, CAST(last AS BIGINT) AS last,
  CAST(messages AS BIGINT) AS messages FROM spans"""


def _sql_stream_two_roots() -> str:
    """First parts of both topics; both shared addresses of the listed cases;
    the later parts, replaces before updates."""
    r = r_changes(_enriched_fields(True), _slice("o_orderkey", "(SELECT MAX(o_orderkey) FROM d1)")).replace("FROM d1v", f"FROM {ENRICHED_SRC}")
    u = u_changes(_slice("event_id", "(SELECT MAX(event_id) FROM d2)"))
    x = "x AS (" + r + "\nUNION ALL\n" + u + ")"
    fold = fold_sql(_touch(True, True), True).removeprefix(",\n")
    t1 = "t1 AS (WITH ch AS (SELECT * FROM x WHERE b < 1),\n" + fold + ")"
    filled = {c: f't1."{c}"' for c in CASE_REPORT_COLUMNS}
    for c in ("company_address", "permanent_address"):
        filled[c] = f'CASE WHEN ids.overdue_id IS NULL THEN t1."{c}" ELSE COALESCE(pf.shared, {_q(UNKNOWN)}) END'
    t2 = ("t2 AS (SELECT\n  " + _cols(CASE_REPORT_COLUMNS, filled) + "\nFROM t1 LEFT JOIN ids ON ids.overdue_id = t1.overdue_id "
          "LEFT JOIN pfull pf ON pf.phone = t1.phone)")
    last = "(WITH snap AS (SELECT * FROM t2), ch AS (SELECT * FROM x WHERE b >= 1),\n" + fold + ")"
    return _with(D1, D1V, D2, PROFILE, SNAP, IDS, x, t1, t2) + "SELECT * FROM " + last


def _sql_stream_backfill_compact() -> str:
    """Replaces of the first two parts; both shared addresses of the listed
    cases; replaces of the last part."""
    r = r_changes(_enriched_fields(True), _slice("o_orderkey", "(SELECT MAX(o_orderkey) FROM d1)"))
    r = "r AS (" + r.replace("FROM d1v", f"FROM {ENRICHED_SRC}") + ")"
    fold = fold_sql(_touch(True, False), True).removeprefix(",\n")
    t1 = "t1 AS (WITH ch AS (SELECT * FROM r WHERE b < 2),\n" + fold + ")"
    filled = {c: f't1."{c}"' for c in CASE_REPORT_COLUMNS}
    for c in ("company_address", "permanent_address"):
        filled[c] = f'CASE WHEN ids.overdue_id IS NULL THEN t1."{c}" ELSE COALESCE(pf.shared, {_q(UNKNOWN)}) END'
    t2 = ("t2 AS (SELECT\n  " + _cols(CASE_REPORT_COLUMNS, filled) + "\nFROM t1 LEFT JOIN ids ON ids.overdue_id = t1.overdue_id "
          "LEFT JOIN pfull pf ON pf.phone = t1.phone)")
    last = "(WITH snap AS (SELECT * FROM t2), ch AS (SELECT * FROM r WHERE b = 2),\n" + fold + ")"
    return _with(D1, D1V, PROFILE, SNAP, IDS, r, t1, t2) + "SELECT * FROM " + last


def _sql_stream_redrive() -> str:
    """Replaces of the valid messages and, of the first two parts, of the bad
    ones but the empty, corrected."""
    part = _slice("o_orderkey", "(SELECT MAX(o_orderkey) FROM d1)")
    valid = ("d1v AS (SELECT * FROM d1 WHERE reason IS NULL UNION ALL SELECT * REPLACE (CAST(o_custkey % 200 AS VARCHAR) AS mobile) "
             f"FROM d1 WHERE reason <> 'empty' AND {part} < 2)")
    ch = "ch AS (" + r_changes(_enriched_fields(True), part).replace("FROM d1v", f"FROM {ENRICHED_SRC}") + ")"
    return _with(D1, valid, PROFILE, SNAP, ch) + fold_sql(_touch(True, False), True)


def _sql_profile_status() -> str:
    return (f"SELECT CAST(c_custkey AS VARCHAR) AS phone, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE {_q(UNKNOWN)} END "
            "AS address_detail, CASE WHEN c_custkey % 5 = 0 THEN 'ok' ELSE 'no_report' END AS profile_status FROM customer")


ORACLE_SQL: dict[str, str] = {
    "case_parse": _sql_case_parse(),
    "case_quarantine": _sql_case_quarantine(),
    "update_parse": _sql_update_parse(),
    "status_route": _sql_status_route(),
    "profile_top_ten": _sql_profile("call_record_top_ten", "top"),
    "profile_address": _sql_profile("address_detail", "addr"),
    "profile_shared_address": _sql_profile("shared_address", "shared"),
    "enrich_case_full": _sql_enrich(True),
    "enrich_case_basic": _sql_enrich(False),
    "case_replace": _sql_case_replace(),
    "case_intake": _sql_case_intake(),
    "case_intake_basic": _sql_case_intake_basic(),
    "history_replace": _sql_history_replace(),
    "update_normal": _sql_updates("U"),
    "update_close": _sql_updates("C"),
    "update_fold": _sql_updates(None),
    "change_log_fold": _sql_change_log_fold(),
    "backfill_address": _sql_backfill(["address_detail"]),
    "backfill_address_top_ten": _sql_backfill(["address_detail", "call_record_top_ten"]),
    "backfill_company_address": _sql_backfill(["company_address", "permanent_address"]),
    "missing_ids": _sql_missing_ids(),
    "extract_cases": _sql_extract_cases(),
    "ledger_advance": _sql_ledger_advance(),
    "ledger_resolve": _sql_ledger_resolve(),
    "stream_intake": _sql_case_intake(),
    "stream_update": _sql_updates(None),
    "stream_cases": _sql_stream_cases(),
    "stream_backfill_compact": _sql_stream_backfill_compact(),
    "stream_two_roots": _sql_stream_two_roots(),
    "stream_redrive": _sql_stream_redrive(),
    "stream_compact_parts": _sql_updates(None),
    "profile_store": _with(PROFILE) + ("SELECT phone, top AS call_record_top_ten, addr AS address_detail, "
                                       "shared AS shared_address FROM pfull"),
    "profile_variant": _with(PROFILE) + ("SELECT phone, top AS call_record_top_ten, addr AS address_detail, "
                                         "shared AS shared_address FROM pfull"),
    "profile_drift": _sql_profile_drift(),
    "position_audit": _sql_position_audit(),
    "even_ranges": "SELECT cut_by, o_orderkey, TRUE AS is_even, CAST(8 AS BIGINT) AS parts FROM orders, (VALUES ('steep'), ('label')) v(cut_by)",
    "id_list": _with(IDS) + "SELECT overdue_id FROM ids",
    "extract_text": _sql_extract_cases(),
    "case_parse_binary": _sql_case_parse(),
    "profile_status": _sql_profile_status(),
}
