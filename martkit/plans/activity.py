"""One text feed of everything a member did: points, rewards, receipts, expiries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import codes, dates, jsontext
from martkit.operators import filters, joins, sets

# Columns of the feed in order. All are text but the last.
COLUMNS = ("mall invoice_no amount payment_type activity_at shop shop_name status updated_by member_id points approval_at reject_reason type auto_approved ocr_id receipt_id created_by created_at "
           "updated_at partner_id platform channel pickup_point reward_name reward_id expiry_at reserve_at cancel_at used_at linked_sales_amount min_spending_amount point_dollar_amount payment_status "
           "url small_url bp_transaction_id action file_name display_name display_name_lang2 display_name_lang3").split()
STAMP = "retrieve_timestamp"
SPEND_REASON = "Used Point Dollar Spending"
REWARD_ACTIONS = ("C", "M", "R", "T")
UPLOAD = {1: "Upload Receipt", 2: "上傳單據", 3: "上传单据"}  # in the three languages
LANGUAGES = {1: "display_name", 2: "display_name_lang2", 3: "display_name_lang3"}


def _feed(df: DataFrame, values: dict[str, Column], stamp: Column) -> DataFrame:
    """Fill the feed's columns; what a kind does not have is empty text."""
    unknown = set(values) - set(COLUMNS)
    if unknown:
        raise ValueError(f"not in the feed: {sorted(unknown)}")
    return df.select(*[(values[c].cast("string") if c in values else F.lit("")).alias(c) for c in COLUMNS], stamp.alias(STAMP))


def _plain(col: str) -> Column:
    return F.replace(col, F.lit('"'), F.lit(""))


def ledger_activities(ledger: DataFrame, exchange: DataFrame, point_dollar: DataFrame, gift_redemption: DataFrame, gift: DataFrame, coupon_redemption: DataFrame, coupon: DataFrame,
                      event_redemption: DataFrame, event: DataFrame, payment: DataFrame, shop: DataFrame, *, offset_hours: int = 16) -> DataFrame:
    """Every kind of point movement in one pass over the ledger.

    All sources of a reward are joined on the movement's redemption id, so the ledger is shuffled once;
    the kind then decides which of their columns count.
    """
    at = lambda c: dates.iso_millis(F.col(c), offset_hours)
    one = F.lit(1)
    df = joins.enrich(ledger, [
        (exchange.withColumn("_one", one), {"trans_id": "redemption_transaction_id"}, {"point_dollar_transaction_id": "_pd", "status": "x_status"}),
        (gift_redemption, {"gift_redemption_transaction_id": "redemption_transaction_id"}, {c: f"g_{c}" for c in ("gift_id", "status", "redeem_type", "mall_id", "redeemed_amount", "cancel_datetime", "payment_transaction_id", "updated_date")}),
        (coupon_redemption, {"coupon_redemption_transaction_id": "redemption_transaction_id"}, {c: f"c_{c}" for c in (
            "coupon_id", "status", "redeem_type", "mall_id", "used_mall_id", "used_shop_id", "redeemed_amount", "expiry_date", "cancel_datetime", "used_datetime", "payment_transaction_id", "updated_date")}),
        (event_redemption, {"event_redemption_transaction_id": "redemption_transaction_id"}, {c: f"e_{c}" for c in ("event_id", "status", "redeem_type", "mall_id", "event_name", "session_end", "updated_date")}),
    ])
    df = df.withColumns({"_pay": F.coalesce("g_payment_transaction_id", "c_payment_transaction_id")})
    df = joins.enrich(df, [
        (point_dollar, {"trans_id": "_pd"}, {"mall_id": "p_mall", "shop_id": "p_shop", "trans_type": "p_type", "amount": "p_amount"}),
        (gift, {"gift_id": "g_gift_id"}, {"name_lang1": "g_name"}), (coupon, {"coupon_id": "c_coupon_id"}, {"name_lang1": "c_name"}), (event, {"event_id": "e_event_id"}, {f"name_lang{n}": f"e_name{n}" for n in LANGUAGES}),
        (payment, {"payment_transaction_id": "_pay"}, {"order_reference_no": "y_ref", "payment_type": "y_type", "status": "y_status", "created_date": "y_created"})])
    df = joins.enrich(df.withColumn("_shop", F.coalesce("p_shop", "c_used_shop_id")), [(shop, {"mapping_shop_id": "_shop"}, {"shop_name": "s_name"})])
    action, source = F.col("action"), F.left(F.col("redemption_transaction_id"), F.lit(2))
    offers = {n: jsontext.json_path(F.col("matched_rules_json"), f"$.extra_offer[0].name_lang{n}") for n in LANGUAGES}
    offer = offers[1]
    free = F.coalesce(F.contains(F.lower("g_name"), F.lit("free parking")), F.lit(False))
    reward = action.isin(*REWARD_ACTIONS)
    kind = codes.first_match([
        ((action == "D") & F.coalesce(F.contains(F.lower(offer), F.lit("conversion")), F.lit(False)), "conversion"), (action == "D", "promotion"),
        ((action == "A") & (F.col("adjust_reason_lang1") == SPEND_REASON), "point dollar"), (action == "A", "adjustment"), (reward & (source == "GR") & free, "free parking"), (reward & (source == "GR"), "gift"),
        (reward & (source == "CR"), "coupon"), (reward & (source == "ER"), "event"), (reward & F.col("redemption_transaction_id").isNull(), "reward"), (action.isin("E", "N"), "expiry")])
    df = df.withColumn("_kind", kind).filter("_kind is not null")
    k = F.col("_kind")
    pick = lambda **by: codes.first_match([(k == name.replace("_", " "), value.cast("string")) for name, value in by.items()], "")
    m, s = (lambda c: F.concat(F.lit("M"), c)), (lambda c: F.concat(F.lit("S"), c))
    text_of = lambda c: F.col(c).cast("string")
    offered = k.isin("conversion", "promotion", "free parking", "gift", "coupon")
    values = {
        "mall": pick(conversion=m("mall_id"), promotion=m("mall_id"), point_dollar=m("p_mall"), coupon=m("c_used_mall_id")), "invoice_no": pick(gift=F.col("y_ref"), coupon=F.col("y_ref")),
        "amount": pick(gift=text_of("g_redeemed_amount"), coupon=text_of("c_redeemed_amount")), "payment_type": pick(gift=F.col("y_type"), coupon=F.col("y_type")), "activity_at": at("created_date"),
        "shop": pick(point_dollar=s("p_shop"), coupon=s("c_used_shop_id")), "shop_name": pick(point_dollar=F.col("s_name"), coupon=F.col("s_name")),
        "status": pick(conversion=F.col("status"), promotion=F.col("status"), expiry=F.col("status"), point_dollar=F.col("x_status"), gift=F.col("g_status"), coupon=F.col("c_status"), event=F.col("e_status")),
        "member_id": F.col("member_id"), "points": F.col("points"), "type": pick(point_dollar=F.col("p_type"), gift=F.col("g_redeem_type"), coupon=F.col("c_redeem_type"), event=F.col("e_redeem_type")),
        "created_at": pick(gift=at("y_created"), coupon=at("y_created")), "pickup_point": pick(gift=m("g_mall_id"), coupon=m("c_mall_id"), event=m("e_mall_id")),
        "reward_name": pick(point_dollar=F.lit("Point Dollar"), gift=_plain("g_name"), coupon=_plain("c_name"), event=_plain("e_event_name")),
        "reward_id": pick(gift=F.col("g_gift_id"), coupon=F.col("c_coupon_id"), event=text_of("e_event_id")), "expiry_at": pick(coupon=at("c_expiry_date")), "reserve_at": pick(event=at("e_session_end")),
        "cancel_at": pick(gift=at("g_cancel_datetime"), coupon=at("c_cancel_datetime")), "used_at": pick(coupon=at("c_used_datetime")), "point_dollar_amount": pick(point_dollar=text_of("p_amount")),
        "payment_status": pick(gift=F.col("y_status"), coupon=F.col("y_status")), "bp_transaction_id": F.col("bonus_points_transaction_id"), "action": action,
        "file_name": codes.decode(k, {"conversion": "Conversion", "promotion": "Promotion", "adjustment": "Reward/ Point Adjustment", "expiry": "Expiry"}, "Reward"),
        **{name: codes.first_match([(offered, offers[n]), (k.isin("adjustment", "point dollar"), F.col(f"adjust_reason_lang{n}")), (k == "event", _plain(f"e_name{n}"))], "") for n, name in LANGUAGES.items()}}
    stamp = codes.first_match([(k.isin("free parking", "gift"), F.greatest("updated_date", "g_updated_date")), (k == "coupon", F.greatest("updated_date", "c_updated_date")),
                               (k == "event", F.greatest("updated_date", "e_updated_date"))], F.col("updated_date"))
    return _feed(df, values, stamp)


def receipt_activities(ledger: DataFrame, transaction: DataFrame, receipt: DataFrame, partner_link: DataFrame, *, offset_hours: int = 16) -> DataFrame:
    """Receipts behind a point movement, with approval and partner."""
    at = lambda c: dates.iso_millis(F.col(c), offset_hours)
    bonus = ledger.select("spending_transaction_id", "bonus_points_transaction_id", "action")
    tx = transaction.join(bonus, "spending_transaction_id")
    rows = receipt.select("spending_transaction_id", *[F.col(c).alias(f"r_{c}") for c in (
        "receipt_id", "invoice_no", "original_amount", "payment_type_lang1", "receipt_datetime", "receipt_date", "shop_id", "mall_id", "status", "updated_by", "created_by", "created_date", "updated_date", "ocr_id")])
    df = tx.join(rows, "spending_transaction_id", "left").join(partner_link.select(F.col("result").alias("spending_transaction_id"), "partner_id"), "spending_transaction_id", "left")
    values = {
        "mall": F.concat(F.lit("M"), "r_mall_id"), "invoice_no": F.col("r_invoice_no"), "amount": F.col("r_original_amount"), "payment_type": F.col("r_payment_type_lang1"),
        "activity_at": dates.iso_millis(F.coalesce("r_receipt_datetime", "r_receipt_date"), offset_hours), "shop": F.concat(F.lit("S"), "r_shop_id"), "status": F.col("r_status"), "updated_by": F.col("r_updated_by"),
        "member_id": F.col("member_id"), "points": F.col("earned_points"), "approval_at": at("approval_date"), "reject_reason": F.col("reject_reason_lang1"), "type": F.col("type"),
        "auto_approved": F.when(F.col("auto_approved"), "TRUE").otherwise("FALSE"), "ocr_id": F.col("r_ocr_id"), "receipt_id": F.col("r_receipt_id"), "created_by": F.col("r_created_by"), "created_at": at("r_created_date"),
        "updated_at": at("r_updated_date"), "partner_id": F.concat(F.lit("B"), "partner_id"), "platform": F.col("platform"), "channel": F.col("channel"), "bp_transaction_id": F.col("bonus_points_transaction_id"),
        "action": F.col("action"), "file_name": F.lit("Receipt"), **{name: F.lit(UPLOAD[n]) for n, name in LANGUAGES.items()}}
    return _feed(df, values, F.col("r_updated_date"))


def activity_feed(*parts: DataFrame) -> DataFrame:
    return sets.union_all(*parts)


def changed_ledger(ledger: DataFrame, mode: str, *, days: int, as_of: date | str) -> DataFrame:
    """The movements to send: all of them, or those changed in the last days."""
    return filters.load_window(ledger, "updated_date", mode, days, as_of)
