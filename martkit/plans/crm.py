"""Member and vehicle exports for the customer system."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import dates, text
from martkit.operators import filters, joins, latest, sets
from martkit.sources.writers import upsert

FLAGS = ("call", "email", "sms", "mail", "msg")


def truth(cond: Column) -> Column:
    """TRUE or FALSE as text; unknown is FALSE."""
    return F.when(cond, "TRUE").otherwise("FALSE")


def partner_bindings(mapping: DataFrame, member: DataFrame, apps: Mapping[str, int]) -> DataFrame:
    """Latest binding per member and app as columns, from one window and one aggregation."""
    rows = mapping.filter(F.col("app_id").isin(list(apps.values()))).join(member.select("phone", "member_id"), "phone").select("member_id", "app_id", "status", "updated_date").distinct()
    last = latest.latest_per_key(rows, ["app_id", "member_id"], "updated_date", ["status"])
    out = []
    for name, app in apps.items():
        hit = F.col("app_id") == app
        out += [F.max(F.when(hit, F.col("status"))).alias(f"_{name}"), F.max(F.when(hit, F.col("updated_date"))).alias(f"_{name}_at")]
    return last.groupBy("member_id").agg(*out)


def member_rows(member: DataFrame, setting: DataFrame, bindings: DataFrame, apps: Mapping[str, int]) -> DataFrame:
    """Members in the customer system's shape; the retrieval date is the latest change of any source."""
    iso = lambda c: dates.iso_millis(F.col(c), 0)
    df = joins.enrich(member, [
        (setting, {"member_id": "member_id"}, {**{f"receive_promotion_{f}": f"_r_{f}" for f in FLAGS}, "default_language": "_lang", "updated_date": "_set_at"}),
        (bindings, {"member_id": "member_id"}, {c: c for c in bindings.columns if c != "member_id"})])
    partners = [c for n in apps for c in (truth(F.col(f"_{n}") == "A").alias(f"{n}_member"), iso(f"_{n}_at").alias(f"{n}_bind_date"))]
    return df.select(
        "member_id", F.col("title").alias("salutation"), F.col("first_name_lang1").alias("first_name"), F.col("last_name_lang1").alias("last_name"), F.concat(F.lit("M"), "from_mall_id").alias("registration_source"), *partners,
        "age", "birth_mth", iso("registration_date").alias("creation_date"), "status", F.col("_lang").alias("default_language"), *[truth(F.col(f"_r_{f}") == 1).alias(f"receive_{f}") for f in FLAGS],
        F.col("country_lang1").alias("country"), text.join_parts(F.col("district_lang1"), F.col("sub_district_lang1")).alias("street"),
        F.greatest("update_date", "_set_at", *[f"_{n}_at" for n in apps]).cast("date").alias("retrieval_date"))


def member_delta(rows: DataFrame, *, as_of: date | str, days: int = 1) -> DataFrame:
    return filters.last_days(rows, "retrieval_date", days, as_of)


def apply_delta(target: DataFrame, delta: DataFrame, *, as_of: date | str, insert: bool = True) -> DataFrame:
    """The customer system's table after a delta; rows it touched carry the day."""
    cols = [c for c in delta.columns if c not in ("member_id", "retrieval_date")]
    return upsert(target, delta.drop("retrieval_date"), ["member_id"], cols, "retrieval_date", as_of, insert)


def _key(plate: str) -> Column:
    return F.upper(F.trim(plate))


def registered_vehicles(vehicles: DataFrame, events: DataFrame, carparks: DataFrame, *, kinds: tuple[int, ...] = (1, 2, 7), distinct: bool = True) -> DataFrame:
    """Current vehicles with their logged events, and logged plates that are registered no more."""
    log = joins.enrich(events, [(carparks, {"id": "carpark_id"}, {"mallid": "_mall"})]).select(
        F.col("lpn").alias("_lpn"), F.col("member_id").alias("_member"), F.col("type").alias("event_type"), "event_time", F.col("carpark_id").cast("string").alias("car_park_id"), F.concat(F.lit("M"), "_mall").alias("mall"))
    log = log.filter(F.col("event_type").isin(list(kinds)))
    match = (_key("lpn") == _key("_lpn")) & (F.col("memberId") == F.col("_member"))
    shape = ["event_type", "event_time", "car_park_id", "mall"]
    current = vehicles.join(log, match, "left").select(
        F.col("lpn").alias("car_plate"), F.col("memberId").alias("member_id"), F.lit("FALSE").alias("inactive"), truth(F.col("validationsts") == 1).alias("validated"), *shape)
    removed = log.join(vehicles.filter("lpn is not null"), match, "left_anti").select(
        F.col("_lpn").alias("car_plate"), F.col("_member").alias("member_id"), F.lit("TRUE").alias("inactive"), F.lit("FALSE").alias("validated"), *shape)
    return sets.union_distinct(current, removed) if distinct else sets.union_all(current.filter("event_type is not null"), removed)
