"""JSON bundles built from the driver's relational tables.

The driver tables hold no bundles, so every bundle operator is exercised on
bundles that Spark derives from them:

* one ``collection`` bundle per order: an ``Order`` entry, its ``Customer``
  entry and one ``LineItem`` entry per line;
* one ``batch`` bundle per customer whose entries are that customer's order
  bundles (nested bundles, C17-C19).

One rule holds at every size: an order is one bundle, a customer is one outer bundle,
however many rows they have, as a bundle is one document.  A document beyond the size of one
VARIANT value is parsed entry by entry (``bronze.variant_bronze``); the bound is that of a text
value, 2 GB.

Scale notes
-----------
* Line order inside a bundle is fixed by sorting inside the per-bundle aggregate, never by
  a window over the order key.
* Columns travel through the joins, not texts: a bundle's JSON is built after its last shuffle.
* Lines are read once: one grouping, joined in full with the orders, so that neither
  orders without lines nor lines without an order are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

# Fixed values of the synthetic bundles (the oracle SQL repeats them).
BUNDLE_TYPE = "collection"
OUTER_BUNDLE_TYPE = "batch"
DATA_MODEL = "TPCH"
PRIORITY_SYSTEM = "tpch/orderpriority"
PART_SYSTEM = "tpch/part"

LINE_SORT_COLS = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _entry_text(full_url: Column, resource_json: Column) -> Column:
    # fullUrl values are generated from keys (no quotes or escapes needed)
    return F.concat(F.lit('{"fullUrl":"'), full_url, F.lit('","resource":'), resource_json, F.lit("}"))


def _cut(text: Column, first: int, last: int) -> Column:
    """``text`` without its first and last bytes: a copy, where patterns and trims walk the whole text."""
    return F.substring(text.cast("binary"), F.lit(first + 1), F.octet_length(text) - (first + last)).cast("string")


def _close_header(header_json: Column, entries_csv: Column) -> Column:
    """Append an ``entry`` array of already-serialised entries to a serialised header object."""
    return F.concat(
        _cut(header_json, 0, 1),
        F.lit(',"entry":['), F.coalesce(entries_csv, F.lit("")), F.lit("]}"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").drop("n_nationkey")


def _customer_json() -> Column:
    geo = F.array(
        F.struct(F.lit("latitude").alias("url"), F.col("c_acctbal").alias("valueDecimal")),
        F.struct(F.lit("longitude").alias("url"), F.col("c_nationkey").cast("double").alias("valueDecimal")),
    )
    address = F.array(F.struct(
        F.col("n_name").alias("city"),
        F.array(F.struct(F.lit("geolocation").alias("url"), geo.alias("extension"))).alias("extension"),
    ))
    return F.to_json(F.struct(
        F.lit("Customer").alias("resourceType"),
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("mktsegment"),
        F.col("c_acctbal").alias("acctbal"),
        address.alias("address"),
    ))


def _order_json() -> Column:
    return F.to_json(F.struct(
        F.lit("Order").alias("resourceType"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderdate"),
        F.struct(F.array(F.struct(
            F.lit(PRIORITY_SYSTEM).alias("system"), F.col("o_orderpriority").alias("code"),
        )).alias("coding")).alias("priority"),
        F.struct(F.concat(F.lit("Customer/"), F.col("o_custkey").cast("string")).alias("reference")).alias("customer"),
    ))


def _line_entry(bid: Column, place: Column, x: Column) -> Column:
    lid = F.concat(bid, F.lit("-"), place.cast("string"))
    return F.struct(F.concat(F.lit("LineItem/"), lid).alias("fullUrl"), F.struct(
        F.lit("LineItem").alias("resourceType"),
        lid.alias("id"),
        F.struct(F.concat(F.lit("Order/"), bid).alias("reference")).alias("order"),
        x["l_linenumber"].alias("linenumber"),
        x["l_quantity"].alias("quantity"),
        x["l_extendedprice"].alias("extendedprice"),
        x["l_discount"].alias("discount"),
        x["l_tax"].alias("tax"),
        x["l_returnflag"].alias("returnflag"),
        x["l_linestatus"].alias("linestatus"),
        F.date_format(x["l_shipdate"], "yyyy-MM-dd").alias("shipdate"),
        F.struct(F.array(F.struct(
            F.lit(PART_SYSTEM).alias("system"), x["l_partkey"].cast("string").alias("code"),
        )).alias("coding")).alias("productOrService"),
        F.struct(F.concat(F.lit("Supplier/"), x["l_suppkey"].cast("string")).alias("reference")).alias("supplier"),
    ).alias("resource"))


# Entries that one call writes as text, or that one entry of an outer bundle carries of a cut inner bundle.
PART_ENTRIES = 1000


def _line_entries(lines: str, bid: Column) -> Column:
    """The texts of all lines' entries, ``PART_ENTRIES`` to a text (one call each, not one a line), joined
    by commas.  NULL without lines, and without a key, as no line then has a url."""
    def part(k: Column) -> Column:
        start = k * PART_ENTRIES
        return F.to_json(F.transform(F.slice(lines, start + 1, PART_ENTRIES),
                                     lambda x, i: _line_entry(bid, start + i + 1, x)))

    parts = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / PART_ENTRIES).cast("int"))
    texts = F.transform(F.transform(parts, part), lambda t: _cut(t, 1, 1))  # without the arrays' brackets
    return F.when(bid.isNotNull() & (F.size(lines) > 0), F.array_join(texts, ","))


def order_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-text shaped bundles: bundle_id, o_custkey, file_metadata, value (JSON text)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_SORT_COLS)

    # columns, not texts, travel through the joins; the texts are made beside the parse
    orders_res = orders.join(customers(spark, sf_dir), orders.o_custkey == F.col("c_custkey"), "left")

    groups = lineitem.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(*LINE_SORT_COLS))).alias("lines"))
    b = groups.join(orders_res, groups.l_orderkey == orders_res.o_orderkey, "full_outer").withColumn(
        "bundle_id", F.coalesce("o_orderkey", "l_orderkey").cast("string"))

    bid = F.col("bundle_id")
    # lines without an order form a bundle without Order and Customer entries; absent entries are left out
    entries_csv = F.concat_ws(
        ",",
        F.when(F.col("o_orderkey").isNotNull(),
               _entry_text(F.concat(F.lit("Order/"), F.col("o_orderkey").cast("string")), _order_json())),
        F.when(F.col("c_custkey").isNotNull(),
               _entry_text(F.concat(F.lit("Customer/"), F.col("o_custkey").cast("string")), _customer_json())),
        _line_entries("lines", bid),
    )
    header = F.to_json(F.struct(
        F.lit("Bundle").alias("resourceType"),
        F.lit(BUNDLE_TYPE).alias("type"),
        bid.alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.struct(
            F.lit(DATA_MODEL).alias("DataModel"),
            F.col("o_orderpriority").alias("EventType"),
            F.array(F.concat(F.lit("Customer/"), F.col("o_custkey").cast("string"))).alias("Destinations"),
            F.struct(bid.alias("Id")).alias("Transmission"),
            F.array(F.struct(F.lit("ingest").alias("Step"), bid.alias("Id"))).alias("Logs"),
        ).alias("Meta"),
    ))
    # a step of its own: beside its size, the text would be built once for every use
    b = b.select("bundle_id", "o_custkey", "o_orderdate", _close_header(header, entries_csv).alias("value"))
    return b.select(
        "bundle_id",
        "o_custkey",
        file_metadata(F.concat(F.lit("bundles/orders/"), "bundle_id", F.lit(".json")), F.concat("bundle_id", F.lit(".json")),
                      F.col("value"), F.col("o_orderdate").cast("timestamp")).alias("file_metadata"),
        "value",
    )


def file_metadata(path: Column, name: Column, value: Column, mtime: Column) -> Column:
    """The six-field file metadata struct the text source attaches (S4), for generated rows."""
    size = F.octet_length(value).cast("long")
    return F.struct(
        path.alias("file_path"), name.alias("file_name"), size.alias("file_size"),
        F.lit(0).cast("long").alias("file_block_start"), size.alias("file_block_length"),
        mtime.alias("file_modification_time"),
    )


def customer_bundles_variant(vb: DataFrame) -> DataFrame:
    """Variant-bronze rows of per-customer ``batch`` bundles built straight from stored order
    bundles: the inner bundles stay VARIANT (no JSON text round trip).

    The entries of the outer bundle are values of their own (``parts``), so that a customer's
    orders may exceed one VARIANT together; an inner bundle that was cut is carried by several
    entries of the same url, each with ``PART_ENTRIES`` of its entries.
    """
    first = F.coalesce(F.try_variant_get(F.get("parts", F.lit(0)), "$.resource.customer.reference", "string"),
                       F.try_variant_get("fhir", "$.entry[0].resource.customer.reference", "string"))
    b = vb.where(F.col("fhir").isNotNull()).select(
        F.try_variant_get("fhir", "$.id", "string").alias("bundle_id"),
        F.element_at(F.split(first, "/"), -1).cast("long").alias("o_custkey"), "fhir", "parts")
    slices = F.expr(f"transform(sequence(0, (size(parts) - 1) div {PART_ENTRIES}), "
                    f"i -> slice(parts, cast(i * {PART_ENTRIES} + 1 as int), {PART_ENTRIES}))")
    head = [F.try_variant_get("fhir", f"$.{f}", "variant").alias(f) for f in ("resourceType", "type", "id", "timestamp")]
    inner = F.when(F.col("parts").isNull(), F.array("fhir")).otherwise(
        F.transform(slices, lambda e: F.to_variant_object(F.struct(*head, e.alias("entry")))))
    pieces = b.where(F.col("o_custkey").isNotNull()).select(
        "bundle_id", "o_custkey", F.posexplode(inner).alias("part", "piece"))
    g = pieces.groupBy("o_custkey").agg(F.collect_list(F.struct("bundle_id", "part", "piece")).alias("inner"))
    ordered = F.array_sort("inner", lambda x, y: F.when(x["bundle_id"] < y["bundle_id"], -1)
                           .when(x["bundle_id"] > y["bundle_id"], 1).otherwise(x["part"] - y["part"]))
    entries = F.transform(ordered, lambda x: F.to_variant_object(F.struct(
        F.concat(F.lit("Bundle/"), x["bundle_id"]).alias("fullUrl"), x["piece"].alias("resource"))))
    outer_id = F.concat(F.lit("customer-"), F.col("o_custkey").cast("string"))
    fhir = F.to_variant_object(F.struct(
        F.lit("Bundle").alias("resourceType"), F.lit(OUTER_BUNDLE_TYPE).alias("type"), outer_id.alias("id")))
    meta = F.struct(
        F.concat(F.lit("bundles/customers/"), outer_id, F.lit(".json")).alias("file_path"),
        F.concat(outer_id, F.lit(".json")).alias("file_name"),
        F.lit(None).cast("long").alias("file_size"), F.lit(0).cast("long").alias("file_block_start"),
        F.lit(None).cast("long").alias("file_block_length"),
        F.lit(None).cast("timestamp").alias("file_modification_time"))
    return g.select(
        F.sha2(F.concat(F.lit("bundle:"), outer_id), 256).alias("bundle_uuid"),
        F.current_timestamp().alias("ingest_time"), meta.alias("file_metadata"), fhir.alias("fhir"),
        entries.alias("parts"), F.lit(None).cast("string").alias("unparsed"))
