"""Profile documents whose shape is not declared (VARIANT).

`parse_profile_docs` reads documents by one declared schema; a document in which
a single field has another shape (one entry where a list is declared, say) is
lost as a whole.  Here a document is parsed to a VARIANT, and each piece is taken
by its path in the shape it has:

- a list of entries, or one entry alone;
- contacts as entries, or as an object of peer number -> call count;
- numbers where texts are usual.

Entries that fit none of these are left out; the others of the same list stay.

`drift_report` says how documents differ from what is declared: all paths that
occur with the types of their values.  It goes down level by level until no
value holds others, so no depth is given; what one level costs beside the final
pass is a look for a value that is not yet opened.  Counts are added up per task,
so what is shuffled is a row per path and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.columns import first_value_for_key
from casemill.schemas import PROFILE_ADDRESS_KEY, PROFILE_DOC_SCHEMA

REPORT_PATHS = ("$.mxReport",)


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _items(report: Column, path: str) -> Column:
    """The list at a path, or the one object there as a list."""
    one = F.try_variant_get(report, path, "variant")
    return F.coalesce(F.try_variant_get(report, path, "array<variant>"), F.when(_is_object(one), F.array(one)))


def _entries(items: Column, *fields: str) -> Column:
    return F.transform(F.filter(items, _is_object), lambda e: F.struct(
        *[F.try_variant_get(e, f"$.{f}", "string").alias(f) for f in fields]))


def _contacts(report: Column) -> Column:
    path = "$.call_contact_detail"
    one = F.try_variant_get(report, path, "variant")
    entries = _entries(_items(report, path), "peer_num", "call_cnt_6m")
    counts = F.map_entries(F.try_variant_get(report, path, "map<string,string>"))
    by_peer = F.transform(counts, lambda e: F.struct(e["key"].alias("peer_num"), e["value"].alias("call_cnt_6m")))
    is_entry = F.try_variant_get(one, "$.peer_num", "variant").isNotNull() | F.try_variant_get(one, "$.call_cnt_6m", "variant").isNotNull()
    return F.when(_is_object(one) & ~is_entry, by_peer).otherwise(entries)


def parse_variant_docs(profiles: DataFrame, address_key: str = PROFILE_ADDRESS_KEY,
                       report_paths: tuple[str, ...] = REPORT_PATHS) -> DataFrame:
    """As `parse_profile_docs`, one row per document, for documents of any
    shape; the report is the first of `report_paths` that holds an object.
    Pass it to `extract_profile` as `parse`."""
    part = F.col("part").cast("bigint") if "part" in profiles.columns else F.lit(0).cast("bigint")
    keyed = "phone" in profiles.columns
    phone = F.col("phone").cast("string") if keyed else F.lit(None).cast("string")
    # a one-row generator keeps what uses the document above its one parse
    docs = profiles.select(phone.alias("phone"), part.alias("part"), F.inline(F.array(F.struct(F.try_parse_json("doc").alias("v")))))
    if not keyed:
        docs = docs.withColumn("phone", F.try_variant_get("v", "$.baseInfo.mobile", "string")).where("phone IS NOT NULL")
    found = [F.try_variant_get("v", p, "variant") for p in report_paths]
    report = F.coalesce(*[F.when(_is_object(r), r) for r in found])
    docs = docs.select("phone", "part", F.inline(F.array(F.struct(report.alias("r")))))
    pairs = lambda name: first_value_for_key(_entries(_items(F.col("r"), f"$.{name}"), "key", "value"), address_key)
    return docs.select("phone", "part", F.col("r").isNotNull().alias("ok"), pairs("cell_phone").alias("addr"),
                       pairs("user_basic").alias("shared"), _contacts(F.col("r")).alias("contacts"))


def declared_paths(schema: T.DataType = PROFILE_DOC_SCHEMA, at: str = "$") -> dict[str, str]:
    """Path -> declared type of every value that holds no others."""
    if isinstance(schema, T.StructType):
        return {p: t for f in schema.fields for p, t in declared_paths(f.dataType, f"{at}.{f.name}").items()}
    if isinstance(schema, T.ArrayType):
        return declared_paths(schema.elementType, f"{at}[]")
    return {at: schema.simpleString().upper()}


def leaves(docs: DataFrame, column: str = "doc") -> DataFrame:
    """`path, type` of every value that holds no others (empty objects and
    arrays are such), for all documents; those that are no JSON have the type
    `INVALID` at `$`."""
    spark = docs.sparkSession
    level = docs.select(F.lit("$").alias("path"), F.try_parse_json(column).alias("v"), F.lit(False).alias("leaf"))
    kind = F.schema_of_variant("v")
    while not level.where(~F.col("leaf") & (kind.startswith("OBJECT<") | kind.startswith("ARRAY<"))).isEmpty():
        inside = level.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer()))
        key = F.when(F.col("key").rlike(r"[.\[\]`]"), F.concat(F.lit("`"), F.col("key"), F.lit("`"))).otherwise(F.col("key"))
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), key)).when(F.col("pos").isNotNull(), F.lit("[]")).otherwise(F.lit(""))
        level = inside.select(F.concat("path", step).alias("path"), F.when(F.col("pos").isNull(), F.col("v")).otherwise(F.col("value")).alias("v"),
                              F.col("pos").isNull().alias("leaf"))
    return level.select("path", F.coalesce(F.regexp_extract(kind, "^[A-Z_]+", 0), F.lit("INVALID")).alias("type"))


def drift_report(docs: DataFrame, schema: T.StructType = PROFILE_DOC_SCHEMA, column: str = "doc") -> DataFrame:
    """`path, type, n_values, status` of all paths that occur or are declared.

    Status: `declared` (a declared path, with the declared type or a null),
    `other_type`, `unknown` (not declared), `invalid` (no JSON) and
    `missing` (declared, no value; the type is the declared one)."""
    declared = docs.sparkSession.createDataFrame(sorted(declared_paths(schema).items()), "path string, declared string")  # a row per field
    found = leaves(docs, column).groupBy("path", "type").agg(F.count(F.lit(1)).alias("n_values"))
    joined = found.join(declared, "path", "full_outer")
    status = (F.when(F.col("type").isNull(), F.lit("missing")).when(F.col("type") == "INVALID", F.lit("invalid"))
              .when(F.col("declared").isNull(), F.lit("unknown")).when(F.col("type").isin("VOID") | (F.col("type") == F.col("declared")), F.lit("declared"))
              .otherwise(F.lit("other_type")))
    return joined.select("path", F.coalesce("type", "declared").alias("type"), F.coalesce("n_values", F.lit(0)).alias("n_values"), status.alias("status"))
