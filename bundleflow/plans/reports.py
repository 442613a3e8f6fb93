"""Analytics over the silver tables and bundle rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variant import as_array, decode_base64_text, get, parse


def count_and_mean_age(df: DataFrame, group_col: str, id_col: str, date_col: str,
                       as_of: dt.date) -> DataFrame:
    """C14 (A3, A5): distinct count and mean age in years per group.

    ``as_of`` replaces ``current_date()`` so reruns agree; the mean is a double
    (Spark would make ``datediff / 365.25`` a DECIMAL in SQL).
    """
    age = F.datediff(F.lit(as_of), F.col(date_col)).cast("double") / F.lit(365.25)
    return df.groupBy(group_col).agg(
        F.count_distinct(id_col).alias("cnt"),
        F.round(F.avg(age), 6).alias("avg_age"),
    )


def distinct_count_by(df: DataFrame, group_col: str, id_col: str) -> DataFrame:
    """C15 (A3, O1): distinct ids per group, largest first."""
    return df.groupBy(group_col).agg(F.count_distinct(id_col).alias("cnt")).orderBy(F.desc("cnt"), group_col)


def coordinates(silver_customer: DataFrame, id_cols: list[str]) -> DataFrame:
    """C16 (V15, A15): address -> extension -> the two values of its extension, as columns."""
    a = silver_customer.select(*id_cols, F.explode(as_array("address")).alias("address"))
    e = a.select(*id_cols, F.explode(as_array(get("address", "$.extension"))).alias("extension"))
    # the pivot of one geolocation: its two values are looked up in its own array, nothing is shuffled
    parts = F.try_variant_get("extension", "$.extension", "array<struct<url: string, valueDecimal: double>>")

    def value(kind: str):
        return F.get(F.filter("parts", lambda x: x["url"] == kind), F.lit(0))["valueDecimal"].alias(kind)

    c = e.select(*id_cols, parts.alias("parts")).where(F.size("parts") > 0)
    return c.select(*id_cols, value("latitude"), value("longitude"))


def price_spans(usage: DataFrame, keys: list[str], date_col: str, amount_col: str, qty_col: str,
                first_day: int) -> DataFrame:
    """(*keys, price, since, until): monthly prices per key, each valid from ``first_day`` of its month
    to the day before the next one; the last period of a key is open (NULL)."""
    price = F.round(F.sum(amount_col).cast("double") / F.sum(qty_col).cast("double"), 2).cast("decimal(18,2)")
    months = usage.groupBy(*keys, F.trunc(date_col, "month").alias("month")).agg(price.alias("price"))
    later = F.lead("month").over(Window.partitionBy(*keys).orderBy("month"))  # the months of a key: the calendar
    return months.select(*keys, "price", F.date_add("month", first_day - 1).alias("since"),
                         F.date_add(later, first_day - 2).alias("until"))


def price_periods(usage: DataFrame, keys: list[str], date_col: str, amount_col: str, qty_col: str) -> DataFrame:
    """Yearly list prices per key derived from usage (exact decimal sums); the latest period of a
    key is open (NULL end)."""
    year = F.year(date_col).alias("price_year")
    price = F.round(F.sum(amount_col).cast("double") / F.sum(qty_col).cast("double"), 2).cast("decimal(18,2)")
    y = usage.groupBy(*keys, year).agg(price.alias("list_price"))
    w = Window.partitionBy(*keys)  # frame = the years of a key: bounded by the calendar
    return y.select(
        *[F.col(k).alias(f"price_{k}") for k in keys], "list_price",
        F.make_date("price_year", F.lit(1), F.lit(1)).alias("price_start"),
        F.when(F.col("price_year") < F.max("price_year").over(w),
               F.make_date("price_year", F.lit(12), F.lit(31))).alias("price_end"))


def usage_cost(usage: DataFrame, prices: DataFrame, keys: list[str], workspace_col: str, day_col: str,
               qty_col: str, as_of: dt.date, days: int = 7) -> DataFrame:
    """C26 (J3, A6, F11, P9): equality on every key and a range with an open end, for the days
    before ``as_of`` (it replaces ``current_date()``), then the decimal sum of quantity * price.

    ``prices`` is a small written table; AQE decides from its size whether to broadcast it.
    """
    recent = usage.where((F.col(day_col) >= F.date_sub(F.lit(as_of), days)) & (F.col(day_col) < F.lit(as_of)))
    cond = [recent[k] == prices[f"price_{k}"] for k in keys]
    cond += [recent[day_col] >= prices["price_start"],
             (recent[day_col] <= prices["price_end"]) | prices["price_end"].isNull()]
    return (recent.join(prices, cond).groupBy(workspace_col, day_col, keys[0])
            .agg(F.sum(F.col(qty_col) * F.col("list_price")).cast("double").alias("list_cost")))


# Fixed values of the synthetic reports (the oracle SQL repeats them).
REPORT_ISSUED, REPORT_CREATED = "2024-01-01T00:00:00Z", "2024-01-02"


def search_response(docs: DataFrame, id_col: str, text_col: str, code_col: str, version_col: str) -> DataFrame:
    """A search response per document carrying its text base64-encoded in ``presentedForm``."""
    body = F.to_json(F.struct(
        F.lit("Bundle").alias("resourceType"), F.lit("searchset").alias("type"),
        F.array(F.struct(F.struct(
            F.lit("DiagnosticReport").alias("resourceType"), F.col(id_col).cast("string").alias("id"),
            F.lit("final").alias("status"), F.lit(REPORT_ISSUED).alias("issued"),
            F.struct(F.coalesce(version_col, F.lit("und")).alias("versionId")).alias("meta"),
            F.struct(F.array(F.struct(F.col(code_col).alias("code"))).alias("coding")).alias("code"),
            F.struct(F.concat(F.lit("Encounter/"), F.col(id_col).cast("string")).alias("reference")).alias("encounter"),
            F.array(F.struct(F.lit("text/plain").alias("contentType"), F.lit(REPORT_CREATED).alias("creation"),
                             F.base64(F.encode(F.col(text_col), "UTF-8")).alias("data"))).alias("presentedForm"),
        ).alias("resource"))).alias("entry"),
    ))
    return docs.select(F.col(id_col), body.alias("response"))


def decode_reports(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """C24 (V1, V17, V24): parse, explode entries, explode presentedForm, decode base64."""
    v = responses.select(parse(response_col).alias("r"))
    e = v.select(F.explode(as_array(get("r", "$.entry"))).alias("entry"))
    fields = {"report_id": "id", "status": "status", "issued": "issued", "version_id": "meta.versionId",
              "code": "code.coding[0].code", "encounter": "encounter.reference"}
    r = e.select(*[get("entry", f"$.resource.{path}", "string").alias(name) for name, path in fields.items()],
                 F.explode(as_array(get("entry", "$.resource.presentedForm"))).alias("form"))
    return r.select(
        *fields,
        get("form", "$.contentType", "string").alias("content_type"),
        get("form", "$.creation", "string").alias("creation"),
        decode_base64_text(get("form", "$.data", "string")).alias("text"),
    )
