"""Point ledger."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import codes, dates, text
from martkit.operators import joins, lists, sets

# Point actions and the earliest expiry the sources can mean.
ACTIONS = {
    "A": "Adjusted Points (+/-) or Point Dollar",
    "D": "Point Earned by Special Promotion (+) or Partner Point Conversion",
    "S": "Point Earned by Spending (+)",
    "G": "Point Burnt by Spending Gift (-)",
    "R": "Point Burnt by Mall Gift (-)",
    "C": "Point Burnt by Shop Gift (-)",
    "E": "Deduction of Forfeited Bonus Point (-)",
    "T": "Point Burnt by Event (-)",
    "M": "Point Burnt by Point + Cash Gift (-)",
}
EPOCH_END_OF_DAY = datetime(1970, 1, 1, 23, 59, 59)
OFFER_SCHEMA = ("base_offer string, matched_date string, extra_offer array<struct<object_id:string,name_lang1:string,name_lang2:string,"
                "name_lang3:string,bonus_points:string>>")
OFFER_FIELDS = ["object_id", "name_lang1", "name_lang2", "name_lang3", "bonus_points"]
MEMBER_COLUMNS = ["age", "age_group", "residence", "district", "member_tier", "member_status_detail", "gender"]


def adjusted_expiry(from_date: Column, to_date: Column, new: Column, default: Column) -> Column:
    """The mapped expiry where the mapping changed it; two nulls are no change."""
    return F.when(~from_date.eqNullSafe(to_date), new).otherwise(default)


def expiry_dates(balances: DataFrame, mapping: DataFrame) -> DataFrame:
    """Expiry per point lot."""
    df = joins.enrich(balances, [(mapping, {"from_member_mall_bonus_points_id": "member_mall_bonus_points_id"},
                                  {"from_expiry_date": "_from", "to_expiry_date": "_to"})])
    default = dates.clamp_year(F.col("expiry_date"), 1970, F.lit(EPOCH_END_OF_DAY).cast("timestamp_ntz"))
    return df.select("member_mall_bonus_points_id", "updated_date",
                     adjusted_expiry(F.col("_from"), F.col("_to"), F.col("_to"), default).alias("expiry_date"))


def offers(ledger: DataFrame) -> DataFrame:
    """(transaction, object, name) of the offers in the rule JSON.

    Spending rows keep only their base offer; forfeits have none; other rows are
    exploded and vanish here when their offer list is empty.
    """
    known = ledger.filter(F.col("matched_rules_json").isNotNull()).select("bonus_points_transaction_id", "action", "matched_rules_json")
    extra = lists.explode_json(known.filter(~F.col("action").isin("E", "S")), "matched_rules_json", OFFER_SCHEMA, "extra_offer",
                               ["base_offer", "matched_date"], OFFER_FIELDS)
    base = known.filter("action = 'S'").withColumn("_j", F.from_json("matched_rules_json", OFFER_SCHEMA)).withColumns(
        {"base_offer": F.col("_j.base_offer"), "matched_date": F.col("_j.matched_date"), **{f: F.lit(None).cast("string") for f in OFFER_FIELDS}}).drop("_j")
    return extra.unionByName(base).drop("action", "matched_rules_json")


def ledger_lines(ledger: DataFrame, expiry: DataFrame, gift: DataFrame, coupon: DataFrame, mall: DataFrame, *, launch: datetime,
                 cleanup: datetime, cleanup_remark: str, offset_hours: int = 8) -> DataFrame:
    """Point movements with offer, expiry and owner mall, without member attributes."""
    # The offer list multiplies rows; it is joined on the unique transaction id.
    df = ledger.withColumn("remark", text.strip_line_breaks(F.col("remark"))).join(offers(ledger), "bonus_points_transaction_id", "left")
    df = joins.enrich(df, [
        (expiry, {"member_mall_bonus_points_id": "member_mall_bonus_points_id"}, {"updated_date": "updated_date", "expiry_date": "expiry_date"}),
        (gift, {"gift_id": "object_id"}, {"mall_id": "_gift_mall"}), (coupon, {"coupon_id": "object_id"}, {"mall_id": "_coupon_mall"})])
    owner = codes.first_match([(F.col("action").isin("G", "R"), F.col("_gift_mall")), (F.col("action") == "C", F.col("_coupon_mall"))], F.col("mall_id"))
    df = joins.enrich(df.withColumn("mall_id", owner), [(mall, {"mall_id": "mall_id"}, {"property_id": "property_id"})])
    early = ((F.col("created_date") < F.lit(launch).cast("timestamp_ntz"))
             | ((F.col("created_date") == F.lit(cleanup).cast("timestamp_ntz")) & (F.col("action") == "A") & (F.col("remark") == cleanup_remark)))
    detail = codes.first_match([(F.col("action") == "A", F.col("adjust_reason_lang1")), (F.col("action") == "D", F.col("name_lang1"))])
    return df.select(
        "bonus_points_transaction_id", "created_by", F.col("created_date").alias("created_datetime"),
        dates.local_date(F.col("created_date"), offset_hours).alias("created_date"), "points", F.upper("member_id").alias("member_id"),
        "spending_transaction_id", "redemption_transaction_id", "remark", F.col("action").alias("bp_transaction_type"),
        codes.decode(F.col("action"), ACTIONS).alias("bp_transaction_type_detail_1"), F.trim(detail).alias("bp_transaction_type_detail_2"), "expiry_date",
        F.lit(0).alias("abnormal_case"), codes.flag(early).alias("created_datetime_before_launch"), "mall_id", "property_id", "campaign_id", "updated_date").distinct()


def ledger_fact(lines: DataFrame, history: DataFrame, member: DataFrame, *, cut: date | str, staff_before: date | str,
                exclude_members: Sequence[str] = ()) -> DataFrame:
    """Overlay on the frozen history, known members only, with today's member attributes."""
    base = sets.overlay(history.select(*lines.columns), lines, "created_date", cut, trusted_history=True)
    if exclude_members:
        base = base.filter(~F.col("member_id").isin(list(exclude_members)))
    out = base.join(member.select("member_id", "registration_date", *MEMBER_COLUMNS), "member_id")
    return out.withColumn("is_staff", codes.flag_before(F.col("registration_date"), dates.as_date(staff_before))).drop("registration_date")
