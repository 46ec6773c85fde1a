"""Tables for the customer platform: one description per table, applied by one function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates
from martkit.operators import filters, joins, rowids
from martkit.plans.feeds import BAD_MEMBERS
from martkit.sources.staging import Stage


@dataclass(frozen=True)
class Export:
    """How a table is handed over: new names, constant columns, keys that must be there, and a numbering order."""

    renames: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, object] = field(default_factory=dict)
    required: Sequence[str] = ()
    numbered_by: str | None = None


TIER = {"member_tier": "membership_tier"}
AS_IS = Export()
# The tables of the platform and what differs from their source.
EXPORTS = {
    "device": Export(required=["member_id"]),
    "shop": AS_IS,
    "stamp_earn": AS_IS,
    "stamp_redemption": AS_IS,
    "stamp_member_spend": AS_IS,
    "gift_content": AS_IS,
    "coupon_content": AS_IS,
    "point_lot": AS_IS,
    "points_raw": Export(renames=TIER),
    "redemption_raw": Export(renames=TIER | {"provider_mall_id": "mall_id", "provider_property_id": "property_id"}, constants={"redeemed_qty": 1}),
    "parking_entry": Export(numbered_by="car_in_datetime"),
    "parking_invoice": Export(numbered_by="car_in_datetime"),
    "parking_redemption": Export(constants={"card_no": ""}, numbered_by="car_in_datetime"),
    "parker_identity": Export(constants={"card_no": ""}),
}


def export_table(df: DataFrame, spec: Export, stage: Stage) -> DataFrame:
    """The rows as described. A numbering follows its column, then all others, so that it is total."""
    rows = df.dropna(subset=list(spec.required)) if spec.required else df
    rows = rows.withColumnsRenamed(dict(spec.renames)) if spec.renames else rows
    for name, value in spec.constants.items():
        rows = rows.withColumn(name, F.lit(value))
    if spec.numbered_by:
        order = [spec.numbered_by, *[c for c in rows.columns if c != spec.numbered_by]]
        rows = rowids.add_row_id(rows, order, "row_no", stage)
    return rows


def redemptions(fact: DataFrame, stage: Stage, *, launch: datetime, as_of: date | str, cancelled: Sequence[str], excluded: Sequence[tuple]) -> tuple[DataFrame, DataFrame]:
    """(all, countable) redemptions in the platform's form."""
    raw = export_table(fact, EXPORTS["redemption_raw"], stage).withColumn(
        "redeem_datetime_before_launch", codes.flag(F.coalesce(F.col("redeem_date") < F.lit(launch.date()), F.lit(False))))
    clean = filters.standard_exclusions(raw, keep={"abnormal_case": [0]}, drop={"redemption_status_detail": list(cancelled), "member_status_detail": list(BAD_MEMBERS)})
    clean = clean.filter((F.col("redeem_datetime") >= F.lit(launch).cast("timestamp_ntz")) & (F.col("redeem_date") < F.lit(dates.as_date(as_of))))
    return raw, filters.exclude_tuples(clean, ["redeemed_bonus_points", "redeem_type", "property_id"], list(excluded))


def points(fact: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(all, countable) point movements in the platform's form."""
    raw = export_table(fact, EXPORTS["points_raw"], stage)
    return raw, filters.standard_exclusions(raw, keep={"abnormal_case": [0], "created_datetime_before_launch": [0]}, drop={"member_status_detail": list(BAD_MEMBERS)})


def registrations(fact: DataFrame, *, no_partition: str = "__HIVE_DEFAULT_PARTITION__") -> DataFrame:
    """Registrations; a missing mall partition is empty text."""
    return fact.withColumn("from_mall_id", F.when(F.col("from_mall_id") == no_partition, "").otherwise(F.col("from_mall_id")))


def inventory(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """Inventory with nature, category, brand and value of the mapped gifts."""
    columns = {"business_nature": "gift_business_nature", "trade_category": "gift_trade_category", "brand_name": "gift_brand", "gift_nature": "gift_nature", "face_unit_value": "gift_face_unit_value"}
    out = joins.enrich(items, [(mapping, {"cms_gift_id": "gift_id"}, columns)])
    return out.withColumns({c: F.lit("") for c in ("common_gift", "hotpick_gift", "redemption_weekday")})
