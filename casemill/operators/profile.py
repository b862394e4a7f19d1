"""Profile extraction and case enrichment.

A phone's profile is one or more JSON documents `(phone, doc[, part])`, read
as one report: the call counts of a peer are added up over all its entries and
documents, so a peer is listed once, and the first `address` entry in document
order wins.

Scale notes
- Each document is parsed once.  Contacts leave it as rows and are added up
  per (phone, peer), reduced map-side; a phone with very many documents or
  peers is spread over its peers.  The ten best per phone are found with a
  rank filter that Spark applies before the shuffle too, so at most ten rows
  per phone and task move on.
- Addresses and status are plain minima and maxima per phone, reduced
  map-side; without contacts asked for, nothing is exploded or ranked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.columns import (
    as_of_date,
    first_value_for_key,
    join_or_default,
)
from casemill.schemas import (
    CORRUPT_COLUMN,
    PROFILE_ADDRESS_KEY,
    PROFILE_DOC_SCHEMA,
    TOP_CONTACTS,
    UNKNOWN,
    with_corrupt,
)

EXTRACTED_COLUMNS = [
    "phone", "call_record_top_ten", "address_detail", "shared_address", "profile_status",
]


def parse_profile_docs(profiles: DataFrame, address_key: str = PROFILE_ADDRESS_KEY) -> DataFrame:
    """One row per document: phone, part, ok flag, addresses, contacts.

    The phone is the table's `phone` column (a keyed store); a collection of
    bare documents (no `phone` column, as in a document store) is matched by
    the document's own `baseInfo.mobile`.
    """
    part = F.col("part").cast("bigint") if "part" in profiles.columns else F.lit(0).cast("bigint")
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    m = F.from_json(F.col("doc"), with_corrupt(PROFILE_DOC_SCHEMA), opts)
    keyed = "phone" in profiles.columns
    phone = F.col("phone").cast("string") if keyed else F.lit(None).cast("string")
    docs = profiles.select(phone.alias("phone"), part.alias("part"), m.alias("m"))
    if not keyed:
        docs = docs.withColumn("phone", F.col("m")["baseInfo"]["mobile"]).where(F.col("phone").isNotNull())
    report = F.col("m")["mxReport"]
    ok = F.col("m").isNotNull() & F.col("m")[CORRUPT_COLUMN].isNull() & report.isNotNull()
    return docs.select(
        "phone",
        "part",
        ok.alias("ok"),
        F.when(ok, first_value_for_key(report["cell_phone"], address_key)).alias("addr"),
        F.when(ok, first_value_for_key(report["user_basic"], address_key)).alias("shared"),
        F.when(ok, report["call_contact_detail"]).alias("contacts"),
    )


# documents, address key -> phone, part, ok, addr, shared, contacts per document
Parse = Callable[[DataFrame, str], DataFrame]


def extract_profile(profiles: DataFrame, address_key: str = PROFILE_ADDRESS_KEY, k: int = TOP_CONTACTS,
                    columns: list[str] | None = None, parse: Parse = parse_profile_docs) -> DataFrame:
    """Per phone: top-ten contacts, registered address, shared address, status
    (`columns` picks among these and `phone`; the work follows the choice).
    `parse` reads the documents (`variant_docs` has one for any shape).

    Contacts rank by added-up call count, descending (counts that are not
    whole numbers add nothing; a peer without any sorts last), then by peer
    number, ascending.  Missing pieces become the UNKNOWN text.
    `profile_status` is `ok` when at least one document of the phone has a
    report, else `no_report` (bad JSON, `{}`, `mxReport: null`, empty text).
    Between documents, the smaller `(part, value)` wins, so equal parts still
    give one deterministic answer.
    """
    columns = EXTRACTED_COLUMNS if columns is None else ["phone", *[c for c in columns if c != "phone"]]
    if "call_record_top_ten" in columns:
        return rank_state(profile_state(profiles, address_key, parse), k).select(*columns)
    per_phone = _about(profiles, address_key, parse).groupBy("phone").agg(*_merged())
    return _rendered(per_phone.withColumn("top", F.lit(None).cast("array<string>"))).select(*columns)


def _about(profiles: DataFrame, address_key: str, parse: Parse) -> DataFrame:
    return parse(profiles, address_key).select(
        "phone", "ok",
        F.when(F.col("addr").isNotNull(), F.struct("part", "addr")).alias("a"),
        F.when(F.col("shared").isNotNull(), F.struct("part", "shared")).alias("s"),
        "contacts",
    )


def _merged() -> list[Column]:
    return [F.min("a").alias("a"), F.min("s").alias("s"), F.max("ok").alias("ok")]


STATE_DDL = ("phone string, is_doc boolean, peer string, cnt bigint, a struct<part:bigint,addr:string>, "
             "s struct<part:bigint,shared:string>, ok boolean")


def profile_state(profiles: DataFrame, address_key: str = PROFILE_ADDRESS_KEY, parse: Parse = parse_profile_docs) -> DataFrame:
    """What a set of documents adds to their phones (`STATE_DDL`): a row per
    (phone, peer) with its added-up count, and one per phone (`is_doc`) with
    the first addresses and the status.  States of several sets merge."""
    # one row for the document itself (no contact) and one per contact, so
    # the document is parsed once for both
    entry = "struct<peer_num:string,call_cnt_6m:string>"
    itself = F.array(F.lit(None).cast(entry))
    contacts = F.transform(F.coalesce("contacts", F.array()), lambda c: F.struct(
        c["peer_num"].alias("peer_num"), c["call_cnt_6m"].alias("call_cnt_6m")))
    rows = _about(profiles, address_key, parse).select("phone", "ok", "a", "s", F.explode(F.concat(itself, contacts.cast(f"array<{entry}>"))).alias("e"))
    is_doc = F.col("e").isNull()
    return merge_state(rows.select("phone", is_doc.alias("is_doc"), F.col("e.peer_num").alias("peer"),
                                   F.col("e.call_cnt_6m").try_cast("bigint").alias("cnt"),
                                   *[F.when(is_doc, F.col(c)).alias(c) for c in ("ok", "a", "s")]))


def merge_state(rows: DataFrame) -> DataFrame:
    """States added up."""
    return rows.groupBy("phone", "is_doc", "peer").agg(F.sum("cnt").alias("cnt"), *_merged())


def rank_state(state: DataFrame, k: int = TOP_CONTACTS) -> DataFrame:
    """The extracted columns of a merged state's phones."""
    order = Window.partitionBy("phone", "is_doc").orderBy(F.col("cnt").desc_nulls_last(), F.col("peer").asc_nulls_last())
    best = state.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    listed = F.when(~F.col("is_doc"), F.struct("rn", "peer"))
    per_phone = best.groupBy("phone").agg(F.sort_array(F.collect_list(listed)).alias("top"), *_merged())
    return _rendered(per_phone.withColumn("top", F.transform("top", lambda x: x["peer"])))


def _rendered(per_phone: DataFrame) -> DataFrame:
    return per_phone.select(
        "phone",
        join_or_default(F.col("top")).alias("call_record_top_ten"),
        F.coalesce(F.col("a.addr"), F.lit(UNKNOWN)).alias("address_detail"),
        F.coalesce(F.col("s.shared"), F.lit(UNKNOWN)).alias("shared_address"),
        F.when(F.col("ok"), F.lit("ok")).otherwise(F.lit("no_report")).alias("profile_status"),
    )


def enrich_cases(cases: DataFrame, extracted: DataFrame, as_of: str | None = None,
                 profile_addresses: bool = True) -> DataFrame:
    """Complete case records with profile data (left join on the phone).

    - `address` <- registered address, `callRecordTopTen` <- top-ten list;
    - with `profile_addresses` (the full variant) `companyAddress` and
      `permanentAddress` both <- the shared address, else they keep the
      message values;
    - `createdDate` and `updatedDate` <- the run date.
    A case whose phone has no profile gets the UNKNOWN text.  `extracted`
    must hold one row per phone, as `extract_profile` returns (also when it
    is a stored summary), so the join never multiplies cases; AQE picks
    broadcast (below the measured size threshold) or a skew-split sort-merge.
    """
    ex = extracted.select(
        F.col("phone").alias("_phone"),
        F.col("call_record_top_ten").alias("_top"),
        F.col("address_detail").alias("_addr"),
        F.col("shared_address").alias("_shared"),
        F.col("profile_status").alias("_status"),
    )
    joined = cases.join(ex, cases["mobile"] == ex["_phone"], "left")
    date = as_of_date(as_of)
    new = {
        "address": F.coalesce(F.col("_addr"), F.lit(UNKNOWN)),
        "callRecordTopTen": F.coalesce(F.col("_top"), F.lit(UNKNOWN)),
        "createdDate": date,
        "updatedDate": date,
    }
    if profile_addresses:
        shared = F.coalesce(F.col("_shared"), F.lit(UNKNOWN))
        new["companyAddress"] = shared
        new["permanentAddress"] = shared
    out = joined.withColumns(new)
    out = out.withColumn("profile_status", F.coalesce(F.col("_status"), F.lit("missing")))
    return out.select(*cases.columns, "profile_status")
