"""Record schemas, table layouts and fixed values.

Everything here is data, not logic: names and constants that must equal the
upstream system's wire format and table layout for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream message format and table layout)
# ---------------------------------------------------------------------------

# Case message fields, wire names, in message order (57 fields).
CASE_FIELDS = [
    "age", "balance", "bankCard", "cardId", "contacts", "contactsPhone",
    "contactsRemark", "contactsType", "entrustAmt", "entrustEndDate",
    "entrustStartDate", "lastRepayTime", "loanAmt", "loanDate", "mobile",
    "name", "orgName", "overdueAmt", "overdueDate", "overdueDays", "overdueId",
    "overdueStatus", "overdueTotalAmt", "productName", "realAmt", "sex",
    "stages", "status", "address", "callRecordTopTen", "seqNo", "address2",
    "companyAddress", "permanentAddress", "companyName", "repayAmt",
    "lastRepayAmt", "repayNum", "homePhone", "companyPhone", "qq", "weChat",
    "email", "aliId", "contacts2", "contactsType2", "contactsPhone2",
    "contactsRemark2", "allotId", "loanType", "collectionType", "billDate",
    "interestRate", "startSeatNo", "createdDate", "updatedDate", "contracNo",
]

# Update message fields, wire names, in message order (10 fields).
UPDATE_FIELDS = [
    "mobile", "overdueAmt", "overdueDays", "overdueId", "overdueStatus",
    "overdueTotalAmt", "seqNo", "status", "lastRepayTime", "lastRepayAmt",
]

# case_report column <- case message field, in table column order (52 pairs).
CASE_REPORT_MAPPING = [
    ("overdue_id", "overdueId"), ("name", "name"), ("card_id", "cardId"),
    ("phone", "mobile"), ("org_name", "orgName"), ("contract_no", "contracNo"),
    ("age", "age"), ("sex", "sex"), ("email", "email"), ("qq", "qq"),
    ("wechat", "weChat"), ("ali_id", "aliId"), ("real_amt", "realAmt"),
    ("overdue_total_amt", "overdueTotalAmt"), ("entrust_amt", "entrustAmt"),
    ("overdue_days", "overdueDays"), ("address", "address2"),
    ("address_detail", "address"), ("company_address", "companyAddress"),
    ("permanent_address", "permanentAddress"), ("bank_card", "bankCard"),
    ("company_name", "companyName"), ("loan_date", "loanDate"),
    ("stages", "stages"), ("loan_amt", "loanAmt"), ("repay_amt", "repayAmt"),
    ("balance", "balance"), ("product_name", "productName"),
    ("overdue_amt", "overdueAmt"), ("overdue_status", "overdueStatus"),
    ("last_repay_time", "lastRepayTime"), ("repay_num", "repayNum"),
    ("home_phone", "homePhone"), ("company_phone", "companyPhone"),
    ("contacts", "contacts"), ("contacts_type", "contactsType"),
    ("contacts_phone", "contactsPhone"), ("contacts_remark", "contactsRemark"),
    ("contacts1", "contacts2"), ("contacts1_type", "contactsType2"),
    ("contacts1_phone", "contactsPhone2"), ("contacts1_remark", "contactsRemark2"),
    ("remark", "status"), ("overdue_date", "overdueDate"),
    ("created_date", "createdDate"), ("updated_date", "updatedDate"),
    ("entrust_start_date", "entrustStartDate"),
    ("entrust_end_date", "entrustEndDate"), ("seq_no", "seqNo"),
    ("last_repay_amt", "lastRepayAmt"), ("allot_id", "allotId"),
    ("call_record_top_ten", "callRecordTopTen"),
]

# case_report columns written only by updates (a full replace resets them).
CASE_REPORT_UPDATE_ONLY = ["loan_type", "collection_type"]

# case_history columns, in table column order (43); each is the same-named
# case field except `address`, which is written as the empty string.
CASE_HISTORY_COLUMNS = [
    "overdueId", "seqNo", "name", "age", "sex", "cardId", "address2",
    "address", "companyAddress", "permanentAddress", "mobile", "orgName",
    "loanDate", "stages", "loanAmt", "realAmt", "repayAmt", "balance",
    "overdueAmt", "overdueTotalAmt", "overdueStatus", "lastRepayTime",
    "lastRepayAmt", "loanType", "overdueDays", "entrustAmt", "collectionType",
    "repayNum", "billDate", "productName", "bankCard", "companyName",
    "interestRate", "entrustStartDate", "entrustEndDate", "homePhone",
    "companyPhone", "qq", "weChat", "email", "aliId", "startSeatNo", "status",
]
HISTORY_BLANK_COLUMNS = ["address"]

# Normal update: case_report column <- update field or constant (11 columns).
# A value starting with "=" is a constant name from CONSTANTS, "@as_of" the
# run date.
NORMAL_UPDATE_SET = [
    ("last_repay_amt", "lastRepayAmt"), ("last_repay_time", "lastRepayTime"),
    ("phone", "mobile"), ("overdue_amt", "overdueAmt"),
    ("overdue_days", "overdueDays"), ("overdue_status", "overdueStatus"),
    ("overdue_total_amt", "overdueTotalAmt"), ("seq_no", "seqNo"),
    ("remark", "status"), ("loan_type", "=LOAN_TYPE_CREDIT"),
    ("updated_date", "@as_of"),
]

# CLOSE update: case_report column <- update field or constant (15 columns).
CLOSE_UPDATE_SET = [
    ("last_repay_amt", "lastRepayAmt"), ("last_repay_time", "lastRepayTime"),
    ("phone", "mobile"), ("overdue_days", "overdueDays"), ("seq_no", "seqNo"),
    ("remark", "status"), ("balance", "=ZERO"), ("overdue_amt", "=ZERO"),
    ("overdue_total_amt", "=ZERO"), ("overdue_status", "=ZERO"),
    ("loan_type", "=LOAN_TYPE_CREDIT"), ("collection_type", "=COLLECTION_RECOVERED"),
    ("repay_num", "=ONE"), ("entrust_end_date", "@as_of"),
    ("updated_date", "@as_of"),
]

CLOSE_STATUS = "CLOSE"

CONSTANTS = {
    "UNKNOWN": "未知",               # default text when profile data is missing
    "LOAN_TYPE_CREDIT": "信贷",      # loan_type written by every update
    "COLLECTION_RECOVERED": "回收",  # collection_type written by CLOSE
    "ZERO": "0",
    "ONE": "1",
    "BLANK": "",
}
UNKNOWN = CONSTANTS["UNKNOWN"]

DATE_FORMAT = "yyyy-MM-dd"

# Profile document sections and keys.
PROFILE_ADDRESS_KEY = "address"
TOP_CONTACTS = 10

# Offset ledger columns.
LEDGER_COLUMNS = ["groupid", "topic", "kafka_partition", "kafka_offset"]

# ---------------------------------------------------------------------------
# Derived layout (computed from the fixed values above)
# ---------------------------------------------------------------------------

CASE_KEY_FIELD = "overdueId"
CASE_KEY = "overdue_id"
HISTORY_KEY = "overdueId"

CASE_REPORT_COLUMNS = [c for c, _ in CASE_REPORT_MAPPING] + CASE_REPORT_UPDATE_ONLY

# Fields whose JSON numbers must keep every digit (money and rates).
EXACT_FIELDS = [
    "balance", "entrustAmt", "loanAmt", "overdueAmt", "overdueTotalAmt",
    "realAmt", "repayAmt", "lastRepayAmt", "interestRate",
]

CORRUPT_COLUMN = "_corrupt_record"


def string_struct(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


CASE_SCHEMA = string_struct(CASE_FIELDS)
UPDATE_SCHEMA = string_struct(UPDATE_FIELDS)
CASE_REPORT_SCHEMA = string_struct(CASE_REPORT_COLUMNS)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


_KV = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
]))

PROFILE_DOC_SCHEMA = T.StructType([
    T.StructField("baseInfo", T.StructType([T.StructField("mobile", T.StringType())])),
    T.StructField("mxReport", T.StructType([
        T.StructField("call_contact_detail", T.ArrayType(T.StructType([
            T.StructField("peer_num", T.StringType()),
            T.StructField("call_cnt_6m", T.StringType()),
        ]))),
        T.StructField("cell_phone", _KV),
        T.StructField("user_basic", _KV),
    ])),
])

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
