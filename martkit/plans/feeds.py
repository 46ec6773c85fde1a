"""Operational feeds: food orders, charging sessions, decoded copies, delivery logs and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates, privacy, text
from martkit.operators import filters, joins, lists, projection, rowids, sets
from martkit.sources.staging import Stage

# Codes and labels of the feeds.
ORDER_STATUS = {0: "Cancelled Order", 1: "Waiting Payment Confirmation", 2: "Processing Order", 12: "Ready for Pickup", 99: "Order Completed"}
PAYMENT_STATUS = {0: "Waiting Payment Confirmation", 1: "Payment Confirmed", -1: "Not Confirmed Status"}
ACTIVITY = {1: "Login", 2: "Change Status", 3: "Change Password", 4: "Forget Password", 5: "Verified", 6: "Register", 7: "Reset Password"}
AUTOPAY_KIND = {1: "Credit Card", 2: "Mall Admin", 3: "App"}
AUTOPAY_RESULT = {0: "Unpaid", 1: "Success", 2: "Freeze", 3: "Pay Error"}
EARN_VERDICT = {"N": "Rejected", "W": "Approved", "P": "Partial Approved"}
BAD_MEMBERS = ("Suspended", "Invalid", "Waiting for verification", "Marked For Deletion")


def food_orders(header: DataFrame, payment: DataFrame, mall: DataFrame, shop: DataFrame, member: DataFrame, *, offset_hours: int = 8) -> DataFrame:
    """Food orders of known members; mall and shop come from the invoice number."""
    pattern = "^M([0-9]+)S([0-9]+)"
    local = lambda c: dates.shift_hours(F.col(c), offset_hours)
    df = header.withColumns({"mall_id": text.split_code(F.col("invoice_no"), pattern, 1), "shop_id": text.split_code(F.col("invoice_no"), pattern, 2, "bigint")})
    df = df.join(member.select(F.col("member_id").alias("member_no"), "member_status_detail"), "member_no")
    df = joins.enrich(df, [
        (payment, {"invoice_no": "invoice_no"}, {"payment_status": "payment_status", "pay_method": "pay_method"}), (mall, {"mall_id": "mall_id"}, {"team": "team", "property_id": "property_id"}),
        (shop, {"mapping_shop_id": "shop_id"}, {"shop_name": "shop_name", "lms_standard_brand_name": "lms_standard_brand_name"})])
    return df.select(
        "invoice_no", "team", "mall_id", "property_id", "shop_id", "shop_name", "lms_standard_brand_name", local("purchase_date").alias("purchase_datetime"), local("create_date").alias("create_datetime"),
        local("purchase_date").cast("date").alias("purchase_date"), F.when(F.col("status") == 0, F.col("last_update_date")).alias("cancel_datetime"), F.col("status").alias("order_status"),
        codes.decode(F.col("status"), ORDER_STATUS, "").alias("order_status_detail"), local("last_update_date").alias("last_update_datetime"), F.col("member_no").alias("member_id"), "member_status_detail",
        "original_amount", (F.col("original_amount") - F.col("sales_amount")).alias("discount_amount"), "sales_amount", "payment_status",
        codes.decode(F.col("payment_status"), PAYMENT_STATUS, "").alias("payment_status_detail"), "pay_method")


def hide_plates(df: DataFrame, hidden: DataFrame, member: str, plates: Sequence[str]) -> DataFrame:
    """Plates of the members in ``hidden`` as pseudonyms; each plate is checked on its own."""
    df = joins.flag_exists(df.withColumn("_mid", F.upper(member)), hidden.select(F.upper("member_id").alias("mid")), {"mid": "_mid"}, "_hide")
    return df.withColumns({p: privacy.hash_when(F.col(p), F.col("_hide") == 1) for p in plates}).drop("_hide", "_mid")


def charging_feed(history: DataFrame, delta: DataFrame, hidden: DataFrame) -> DataFrame:
    """Yesterday's sessions added to the history, plates hidden, names in lower case."""
    union = sets.union_all(history, delta.select(*history.columns))
    return hide_plates(union, hidden, "externalMemberId", ["lp", "lpin", "lpOut"]).transform(lambda d: projection.rename_columns(d, str.lower))


def activity_history(history: DataFrame) -> DataFrame:
    return history.withColumns({"action_type_detail": codes.decode(F.col("action_type"), ACTIVITY, ""), "ip_address": F.lit("")})


def autopay_members(members: DataFrame) -> DataFrame:
    fa, ps = F.col("status_fa"), F.col("status_ps")
    return members.select(
        "id", F.col("memid").alias("member_id"), F.when(fa.isin(0, 1), fa).alias("status_freeze_autopayment"), F.when(fa.isin(0, 1), 1).when(fa == 2, 0).alias("status_enable_autopayment"),
        F.when(ps == 0, 1).when(ps == 1, 0).alias("status_all_payment_settled"))


def autopay_log(log: DataFrame) -> DataFrame:
    return log.filter(F.col("action").isin(1, 2)).select(F.col("mem_id").alias("member_id"), F.when(F.col("action") == 1, 1).otherwise(-1).alias("autopayment_activate"), "created_at")


def autopay_transactions(rows: DataFrame, carparks: DataFrame, hidden: DataFrame) -> DataFrame:
    df = joins.enrich(rows, [(carparks, {"carparkid": "carpark_id"}, {"mallid": "mall_id"})])
    df = df.withColumns({"payment_type": codes.decode(F.col("payment_type"), AUTOPAY_KIND), "payment_result": codes.decode(F.col("payment_result"), AUTOPAY_RESULT)})
    return hide_plates(df, hidden, "member_id", ["car_plate"])


def trimmed_plates(df: DataFrame, hidden: DataFrame, member: str, plate: str = "lpn") -> DataFrame:
    """Vehicles and gate events: plates trimmed, those of deleted members hidden."""
    return hide_plates(df.withColumn(plate, F.trim(plate)), hidden, member, [plate])


def partner_members(mapping: DataFrame, member: DataFrame) -> DataFrame:
    """Partner bindings with the member of the phone number; the number itself is dropped."""
    return joins.enrich(mapping, [(member, {"phone": "phone"}, {"member_id": "member_id"})]).drop("phone")


def tagged_rewards(mapping: DataFrame, tag: DataFrame) -> DataFrame:
    return joins.enrich(mapping, [(tag, {"tag_id": "tag_id"}, {"name_lang1": "name_lang1"})])


def sso_houses(mapping: DataFrame, application: DataFrame) -> DataFrame:
    """One row per house of a sign-on mapping; account ids are blanked and an empty list keeps one row."""
    df = joins.enrich(mapping, [(application, {"app_id": "app_id"}, {"app_name": "app_name"})])
    df = df.withColumn("_data", F.coalesce("data", F.lit("")))
    return lists.explode_list(df, "_data", ",", "house", remove=";", drop_values=()).drop("_data").withColumn("account_id", F.lit(""))


def earn_transactions(rows: DataFrame, *, since: date | str) -> DataFrame:
    return rows.filter(F.col("datetime") >= F.lit(dates.as_date(since))).withColumn("valid_to_earn_point", codes.decode(F.col("valid_to_earn_point"), EARN_VERDICT))


def device_changes(devices: DataFrame, *, as_of: date | str) -> DataFrame:
    """Devices created or updated yesterday."""
    return filters.changed_on(devices, dates.days_before(as_of, 1), ["updated_date", "created_date"])


def member_profile(profile: DataFrame, types: Mapping[str, str], formats: Mapping[str, str] | None = None) -> DataFrame:
    """A text copy of the member profile with real types."""
    return projection.cast_columns(profile, types, formats)


def delivery_log(raw: DataFrame, types: Mapping[str, str], formats: Mapping[str, str], *, day: date | str, ts: str) -> DataFrame:
    """Message deliveries of one day: blanks in names replaced, texts typed, partition day added."""
    df = projection.cast_columns(projection.rename_columns(raw, text.underscore_name), types, formats)
    return filters.between_dates(df, ts, day, day).withColumn("dt", F.to_date(ts))


def recent_redemptions(rows: DataFrame, *, as_of: date | str, months: int = 12, cancelled: Sequence[str] = (), offset_hours: int = 8) -> DataFrame:
    """Rows of redemptions that ``redemption_export`` may count by their own columns, before anything is joined to them."""
    df = filters.since_month_start(rows, "redeem_datetime", months, as_of)
    df = filters.standard_exclusions(df, drop={"redemption_status_detail": list(cancelled)})
    return df.filter(dates.local_date(F.col("redeem_datetime"), offset_hours) < F.lit(dates.as_date(as_of)))


def redemption_export(fact: DataFrame, *, as_of: date | str, months: int = 12, cancelled: Sequence[str] = (), excluded: Sequence[tuple] = (), label: str = "Point Dollar") -> DataFrame:
    """Countable redemptions of the last months for the marketing tool."""
    df = filters.since_month_start(fact, "redeem_datetime", months, as_of)
    df = filters.standard_exclusions(df, drop={"redemption_status_detail": list(cancelled), "member_status_detail": list(BAD_MEMBERS)})
    df = filters.exclude_tuples(df.filter((F.col("abnormal_case") == 0) & (F.col("redeem_date") < F.lit(dates.as_date(as_of)))), ["redeemed_bonus_points", "redeem_type", "provider_property_id"], excluded)
    out = df.select("transaction_id", "redemption_status_detail", "redeem_type", "redeem_datetime", "redeem_forfeit_datetime", "collected_or_used_datetime", "cancel_datetime",
                    F.col("provider_mall_id").alias("mall_id"), F.col("provider_property_id").alias("property_id"), "member_id", "item_type",
                    "gift_id", "gift_type", "sub_gift_type", F.when(F.col("sub_gift_type") == label, label).otherwise(F.col("gift_name")).alias("gift_name"), "gift_unit_cost", "gift_face_unit_value",
                    "gift_redeemed_in_mall_id", "gift_redeemed_in_property_id", F.lit(1).alias("redeemed_qty"), "redeemed_bonus_points", "parking_redeem_hour", "gift_used_in_mall_id",
                    "gift_used_in_property_id", "gift_used_in_shop_id", "gift_used_in_shop_name", F.col("gift_used_in_brand_name").alias("gift_used_in_lms_standard_brand_name"))
    return out.withColumns({c: F.translate(c, '|"', "") for c in ("gift_name", "gift_used_in_shop_name", "gift_used_in_lms_standard_brand_name")})


def _countable_spending(fact: DataFrame, as_of: date | str, months: int) -> DataFrame:
    df = filters.since_month_start(fact, "receipt_transaction_date", months, as_of)
    df = filters.standard_exclusions(df, keep={"receipt_status_detail": ["Approved"], "abnormal_case": [0]}, drop={"member_status_detail": list(BAD_MEMBERS), "team": ["Partner"]})
    return df.filter(F.col("receipt_upload_date") < F.lit(dates.as_date(as_of)))


def spending_export(fact: DataFrame, *, as_of: date | str, months: int = 12, columns: Sequence[str], sep: str = "|", invoice_width: int | None = None) -> DataFrame:
    """Countable receipts with texts free of the delimiter; invoice numbers are cut where the receiver's field has a width."""
    df = _countable_spending(fact, as_of, months)
    df = (df.withColumn("invoice_no", F.left(F.col("invoice_no"), F.lit(invoice_width))) if invoice_width else df).select(*columns)
    names = [n for n, kind in df.dtypes if kind == "string"]
    return df.withColumns({n: F.translate(n, sep, " ") for n in names})


def monthly_spending(fact: DataFrame, stage: Stage, *, as_of: date | str, months: int = 12, other: str = "Others") -> DataFrame:
    """One numbered row per member, month, place, category, platform and partner; the number follows month and member."""
    keys = ["year_id", "month_id", "member_id", "property_id", "lms_standard_trade_category", "platform", "partner"]
    day = F.col("receipt_transaction_date")
    df = _countable_spending(fact, as_of, months).groupBy(
        F.date_format(day, "yyyy").alias("year_id"), F.date_format(day, "MM").alias("month_id"), "member_id", "property_id",
        F.coalesce("lms_standard_trade_category", F.lit(other)).alias("lms_standard_trade_category"), "platform", "partner").agg(
        F.sum("receipt_amount").alias("spending_amount"), F.count_distinct("receipt_id").alias("number_of_receipt"))
    return rowids.add_row_id(df, keys, "spending_aggregate_id", stage)


def points_export(fact: DataFrame, *, as_of: date | str, months: int = 12) -> DataFrame:
    df = filters.since_month_start(fact, "created_date", months, as_of)
    df = filters.standard_exclusions(df, keep={"abnormal_case": [0], "created_datetime_before_launch": [0]}, drop={"member_status_detail": list(BAD_MEMBERS)})
    plain = lambda c: F.translate(c, '"', "").alias(c)
    return df.select("bonus_points_transaction_id", "created_datetime", "mall_id", "property_id", "member_id", "bp_transaction_type", plain("bp_transaction_type_detail_1"), plain("bp_transaction_type_detail_2"),
                     "points", F.translate("remark", "|", " ").alias("remark"), "expiry_date", "updated_date")


def registration_export(registration: DataFrame, columns: Sequence[str], *, sep: str = "|", unknown: str = "NULL", no_partition: str = "__HIVE_DEFAULT_PARTITION__") -> DataFrame:
    """How members registered; a missing mall partition is spelled out, channel and link are free of the delimiter."""
    mall = F.when(F.col("from_mall_id") == no_partition, unknown).otherwise(F.col("from_mall_id"))
    return registration.withColumns({"from_mall_id": mall, **{c: F.translate(c, sep, " ") for c in ("channel", "link")}}).select(*columns)


POINT_LOT = "member_mall_bonus_points_id created_by created_date status updated_by updated_date bonus_points expiry_date init_date mall_id member_id type".split()


def point_lot_export(lots: DataFrame, columns: Sequence[str] = POINT_LOT) -> DataFrame:
    """Every point lot with its expiry."""
    return lots.select(*columns)


# Column types of the daily logs of the marketing tool, and the parts of their partition key.
TRACKING_LOG = ({"log_date": "timestamp", "log_date_year": "int", "log_date_month": "int", "log_date_day": "int"}, "log_date")
LOCATION_LOG = ({"visited_time": "timestamp", "point_of_interest_radius": "int", "latitude": "float", "longitude": "float",
                 "visited_time_year": "int", "visited_time_month": "int", "visited_time_day": "int"}, "visited_time")


def daily_log(raw: DataFrame, spec: tuple[Mapping[str, str], str], *, day: date | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One day of a log: texts typed, and the key of year, month and day that it is stored under."""
    types, ts = spec
    df = projection.cast_columns(raw, types, {ts: pattern})
    return filters.between_dates(df, ts, day, day).withColumn("partition_key", F.concat_ws("-", *[f"{ts}_{p}" for p in ("year", "month", "day")]))


def member_export(dimension: DataFrame, migrated: DataFrame, *, as_of: date | str, launch: date | str, flags: Sequence[str]) -> DataFrame:
    """Members registered before today with launch and migration flags."""
    df = dimension.filter(F.col("registration_date") < F.lit(dates.as_date(as_of)))
    df = joins.enrich(df, [(migrated, {"member_id": "member_id"}, {f: f for f in flags})])
    early = codes.flag_before(F.col("registration_date"), dates.as_date(launch))
    return df.withColumns({**{f: F.coalesce(f, F.lit(0)) for f in flags}, "registration_date_before_launch": early, "is_staff": early, "phone": F.lit("")})


def spending_for_platform(fact: DataFrame, pre_shoot: DataFrame, abnormal_shops: DataFrame, *, since: date | str, split_year: int) -> tuple[DataFrame, DataFrame]:
    """(before, since ``split_year``) of the countable receipts, split by upload year."""
    df = filters.standard_exclusions(fact, keep={"receipt_status_detail": ["Approved"], "abnormal_case": [0]}, drop={"member_status_detail": list(BAD_MEMBERS), "team": ["Partner"], "receipt_amount": [0]},
                                     at_least={"receipt_transaction_date": dates.as_date(since)})
    df = joins.anti(df, pre_shoot, {"receipt_id": "receipt_id"})
    df = filters.exclude_unless(df, abnormal_shops, ["shop_id"], F.col("platform") == "api")
    return sets.split_by(df, F.year("receipt_upload_date") < split_year)


def reenriched(copy: DataFrame, stale: Sequence[str], dims: Sequence[tuple]) -> DataFrame:
    """A fact's backup with today's attributes, for the day its own load failed."""
    return joins.enrich(projection.drop_columns(copy, stale), dims).distinct()
