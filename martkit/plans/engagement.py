"""Missions, long member features, cross-business overlap and approval days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import codes, dates
from martkit.operators import aggregates, joins, matching, projection, sets


def mission_progress(record: DataFrame, mission: DataFrame, completed: DataFrame) -> DataFrame:
    """Records, points and completion per mission and member."""
    done = completed.groupBy(F.col("missionid").alias("_mission"), F.col("vid").alias("_vid")).agg(aggregates.ever(F.col("is_redeemed") == "yes").alias("is_redeemed"))
    base = record.groupBy("mission_type", "missionid", "vid").agg(F.count(F.lit(1)).alias("no_record"), F.sum("redeemed_bonus_points").alias("redeemed_bonus_points"))
    df = joins.enrich(base, [(mission, {"id": "missionid"}, {"mission_type": "_type", "spending_total_no_receipt": "_receipts", "reward_total_redeem": "_redeems"})])
    df = df.join(done, (F.col("missionid") == F.col("_mission")) & (F.col("vid") == F.col("_vid")), "left")
    required = codes.first_match([(F.col("_type") == "spending", F.col("_receipts")), (F.col("_type") == "reward", F.col("_redeems"))])
    return df.select("mission_type", "missionid", "vid", "no_record", required.alias("required_times"), "redeemed_bonus_points",
                     F.when(F.col("_vid").isNotNull(), "Y").otherwise("N").alias("completed"), "is_redeemed")


def spend_features(spending: DataFrame, periods: Mapping[str, date | str], *, as_of: date | str) -> DataFrame:
    return aggregates.feature_long(spending, "member_id", "receipt_transaction_date", {"Member_Spend": F.col("receipt_amount")}, periods, as_of, place="property_id", total="Total_Malls")


def point_features(ledger: DataFrame, periods: Mapping[str, date | str], *, as_of: date | str) -> DataFrame:
    """Points earned and burnt; forfeits are neither, adjustments count as earned."""
    points, kind = F.col("points"), F.col("bp_transaction_type")
    specs = {"Point_Earned": F.when((points > 0) | (kind == "A"), points).otherwise(0), "Point_Burnt": F.when((points < 0) & (kind != "A"), points).otherwise(0)}
    return aggregates.feature_long(ledger.filter(kind != "E"), "member_id", "created_date", specs, periods, as_of, total="Total_Malls")


def flag_feature(df: DataFrame, name: str, value: Column | str = "1") -> DataFrame:
    """A constant or computed text for every member of a list; empty texts are left out."""
    value = F.lit(value) if isinstance(value, str) else value
    return df.select("member_id", F.lit(name).alias("feature"), value.cast("string").alias("value")).filter("member_id is not null and length(value) > 0").distinct()


def parker_feature(identity: DataFrame, name: str = "Member_Parker_Type_Latest") -> DataFrame:
    top = identity.groupBy("member_id").agg(F.max("is_contactless_carplate").alias("_c"))
    return flag_feature(top, name, F.when(F.col("_c") == 1, "Contactless Parker").otherwise("Non-Contactless Parker"))


def member_features(parts: Sequence[DataFrame], ids: DataFrame, *, as_of: date | str, version: str, daily: Sequence[str] = ("Member_Spend_", "Point_Burnt_", "Point_Earned_"),
                    forever: str = "9999-12-31") -> DataFrame:
    """The long table with feature ids, version and validity; amounts are valid for one day."""
    df = sets.union_all(*[p.withColumn("value", F.col("value").cast("string")) for p in parts])
    df = joins.enrich(df, [(ids, {"columnname": "feature"}, {"id": "id", "columnname": "_known"})])
    short = F.lit(False)
    for prefix in daily:
        short = short | F.coalesce(F.col("_known").startswith(prefix), F.lit(False))
    return df.select("member_id", "id", "value", F.lit(version).alias("version"), F.lit(dates.as_date(as_of)).alias("created_date"),
                     F.when(short, F.lit(str(dates.days_before(as_of, -1)))).otherwise(forever).alias("end_date"))


def business_overlap(linkage: DataFrame, businesses: Mapping[str, DataFrame], member: DataFrame) -> DataFrame:
    """Members with an activity flag and first registration per business.

    ``linkage`` has a 0/1 column per business; a business's profile counts only where it is 1.
    """
    df = joins.enrich(linkage, [(member, {"member_id": "member_id"}, {"member_status_detail": "member_status_detail", "registration_datetime": "registration_datetime"})])
    for name, profile in businesses.items():
        first = profile.groupBy("hashmobileno").agg(F.min("regdttm").alias("regdttm"))
        df = joins.enrich_gated(df, first.withColumn("_one", F.lit(1)), {"hashmobileno": "hashmobileno"}, F.col(name) == 1, {"regdttm": f"{name}_registration_datetime", "_one": f"_{name}"})
        df = df.withColumn(f"{name}_active", codes.flag(F.col(f"_{name}").isNotNull())).drop(f"_{name}")
    return df.distinct()


def linkage_flags(linkage: DataFrame, businesses: Sequence[str]) -> DataFrame:
    """0/1 per business from its membership text."""
    return linkage.withColumns({b: codes.flag(F.lower(F.col(f"lobmemid_{b}")) == F.lit(f"{b} member")) for b in businesses}).drop(*[f"lobmemid_{b}" for b in businesses])


def attribute_copy(attributes: DataFrame, *, day_columns: Sequence[str], by: str) -> DataFrame:
    """Attributes with the day part of their text stamps, partitioned by a category."""
    return attributes.withColumns({c: F.left(F.col(c), F.lit(10)).try_cast("date") for c in day_columns}).withColumn("partition_key", F.col(by))


def rfm_copy(rfm: DataFrame, *, ints: Sequence[str], floats: Sequence[str], day: str) -> DataFrame:
    out = projection.cast_columns(rfm, {**{c: "int" for c in ints}, **{c: "float" for c in floats}})
    return out.withColumn(day, F.left(F.col(day), F.lit(10)).try_cast("date"))


def vehicle_brands(profile: DataFrame) -> DataFrame:
    tidy = {c: F.trim(F.upper(c)) for c in ("brand", "car_plate")}
    return profile.withColumns({**tidy, "last_seen": F.try_to_timestamp("last_seen", F.lit("yyyyMMdd")).cast("date")}).drop("member_id").distinct()


def approval_holidays(spending: DataFrame, calendar: DataFrame, *, as_of: date | str, since: date | str, kind: int = 12) -> DataFrame:
    """Weekday public holidays between upload and decision of each receipt; open receipts count up to today."""
    days = calendar.filter((F.col("type") == kind) & (F.col("status") == "A")).select(F.col("tag").cast("date").alias("day")).filter(
        (F.col("day") >= F.lit(dates.as_date(since))) & (F.weekday("day") < 5))
    out = matching.count_days_between(spending.select("receipt_id", "receipt_upload_date", "approve_or_reject_date"), "receipt_upload_date", "approve_or_reject_date", days, "day", "no_of_ph", as_of)
    return out.groupBy("receipt_id").agg(F.max("no_of_ph").alias("no_of_ph"))
