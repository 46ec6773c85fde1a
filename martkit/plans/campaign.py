"""Coupon campaigns: mechanisms and the spending they lead to."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F, Window

from martkit.functions import dates, numbers, text
from martkit.operators import joins, latest, matching, sets
from martkit.operators.reduction import semi_reduced
from martkit.operators.rules import RuleIndex, match_rule_index, rule_index
from martkit.sources.staging import Stage, recompute

# Kinds of linked spending, strongest first, and the verdicts.
FIRST, SECOND, FIRST_INDIRECT, SECOND_INDIRECT = "First Direct Spend", "Second Direct Spend", "First Indirect Spend", "Second Indirect Spend"
NO_INVOICE = "Second Direct Spend without Invoice"
VALID, REPEATED, MISSING = "valid receipt to count spending", "same receipt already exists within campaign", "No_Invoice_Upload"
LINK = ["spending_campaign_id", "tier_id", "redemption_date", "redemption_mall_id"]


def mechanisms(tier: DataFrame, reward: DataFrame, campaign: DataFrame, owner: DataFrame, *, as_of: date | str, shown_days: int = 90) -> DataFrame:
    """Tiers with reward, campaign and owner; shown while the campaign runs and ``shown_days`` after."""
    df = tier.join(reward.select("tier_id", "reward_id", F.col("qty").alias("coupon_qty")), "tier_id", "left")
    df = joins.enrich(df, [
        (campaign, {"spending_campaign_id": "spending_campaign_id"}, {"status": "campaign_status", "start_date": "campaign_start_date", "end_date": "campaign_end_date",
                                                                       "name_lang1": "campaign_name", "type": "campaign_type", "condition_id": "campaign_condition_id"}),
        (owner, {"spending_campaign_id": "spending_campaign_id"}, {"ownership": "campaign_owner"})])
    shown = (F.to_date("campaign_start_date") <= F.lit(dates.days_before(as_of, 1))) & (F.col("campaign_end_date") >= F.lit(dates.days_before(as_of, shown_days)))
    return df.withColumnRenamed("tier_order", "campaign_tier").withColumn("display_in_transaction", F.when(shown, 1).otherwise(0))


def selected(mechanism: DataFrame) -> DataFrame:
    return mechanism.filter("display_in_transaction = 1").distinct()


def archived(rows: DataFrame, mechanism: DataFrame) -> DataFrame:
    """Rows of campaigns that are no longer shown, each once."""
    return joins.semi(rows, mechanism.filter("display_in_transaction = 0"), {"spending_campaign_id": "spending_campaign_id"})


def conditions(condition: DataFrame, malls: DataFrame, payments: DataFrame, shops: DataFrame) -> DataFrame:
    """Every combination of a condition's lists; an empty list is open."""
    return joins.expand_rules(condition.select("condition_id", "min_receipt_amount"), "condition_id",
                              [(malls, ["mall_id"]), (payments, ["payment_method"]), (shops, ["shop_id"])])


def condition_index(condition: DataFrame, malls: DataFrame, payments: DataFrame, shops: DataFrame, stage: Stage) -> RuleIndex:
    """The same conditions as bitmaps by value, for lists whose combinations would be too many."""
    own = condition.select("condition_id", F.col("condition_id").alias("_id"))
    lists = {"condition": (own, "_id"), "mall": (malls, "mall_id"), "payment": (payments, "payment_method"), "shop": (shops, "shop_id")}
    return rule_index(condition, "condition_id", lists, stage, strict=["condition"])


def conversions(redemption: DataFrame, chosen: DataFrame, *, offset_hours: int = 8) -> DataFrame:
    """Tier redemptions of the selected campaigns."""
    tiers = chosen.select("spending_campaign_id", "tier_id", "campaign_condition_id").distinct()
    df = redemption.join(tiers, ["spending_campaign_id", "tier_id"])
    return df.select("id", "member_id", "spending_campaign_id", "tier_id", F.col("redemption_date").alias("redemption_datetime"),
                     dates.local_date(F.col("redemption_date"), offset_hours).alias("redemption_date"), "mall_id", F.col("created_date").alias("created_datetime"),
                     dates.local_date(F.col("created_date"), offset_hours).alias("created_date"), "campaign_condition_id").distinct()


def campaign_spending(spending: DataFrame) -> DataFrame:
    """Receipts with a normalised invoice number."""
    return spending.withColumn("invoice_no", text.normalise_ref(F.col("invoice_no")))


def first_direct(spending: DataFrame, conversion: DataFrame, rules: DataFrame | RuleIndex, *, amounts: DataFrame | None = None,
                 before_s: int = 19, after_s: int = 10) -> DataFrame:
    """Counter receipts uploaded around the conversion that meet one of the campaign's conditions.

    The time window is joined in buckets and the conditions by open-test pattern, so neither
    needs a comparison of all pairs of a member or campaign. Conditions come expanded (``conditions``), or as an
    index (``condition_index``) with ``amounts``, the least amount of each condition.
    """
    conv = conversion.select(F.col("member_id").alias("_m"), "created_datetime", F.col("created_date").alias("_cd"), "campaign_condition_id", "spending_campaign_id", "tier_id",
                             "redemption_date", F.col("mall_id").alias("redemption_mall_id"))
    counter = spending.filter("platform = 'counter'")
    near = matching.interval_join(conv, counter, {"_m": "member_id"}, "created_datetime", "receipt_upload_datetime", before_s, after_s)
    near = near.filter(F.col("receipt_upload_date") == F.col("_cd")).select(
        "receipt_id", "member_id", F.col("mall_id").alias("spending_mall_id"), F.col("receipt_transaction_date").alias("spending_transaction_date"), F.col("shop_id").alias("spending_shop_id"),
        F.col("payment_type").alias("spending_payment_type"), "receipt_amount", *LINK, "campaign_condition_id").distinct()
    if isinstance(rules, RuleIndex):
        tests = {"campaign_condition_id": "condition", "spending_mall_id": "mall", "spending_payment_type": "payment", "spending_shop_id": "shop"}
        met = match_rule_index(near, rules, tests, amounts.select("condition_id", "min_receipt_amount"))
        open_end = F.col("min_receipt_amount").isNull() | (F.col("receipt_amount") >= F.col("min_receipt_amount"))
        return met.filter(open_end).select(*near.columns).distinct()
    met = matching.match_rules(near, rules, {"campaign_condition_id": "condition_id"},
                               {"spending_mall_id": "mall_id", "spending_payment_type": "payment_method", "spending_shop_id": "shop_id"}, {"receipt_amount": "min_receipt_amount"})
    return met.distinct()


def coupons_redeemed(coupon: DataFrame, chosen: DataFrame, conversion: DataFrame, mapping: DataFrame, *, switch: date | str, offset_hours: int = 8, slack_s: int = 2) -> DataFrame:
    """Coupons a conversion gave out: by time up to the switch day, by the mapping table afterwards."""
    day = dates.as_date(switch)
    df = coupon.withColumns({"coupon_redeem_date": dates.local_date(F.col("coupon_redeem_datetime"), offset_hours), "coupon_used_date": dates.local_date(F.col("coupon_used_datetime"), offset_hours),
                             "min_top_up_amount": numbers.floor_zero(F.col("min_spending_amount") - F.col("coupon_value_amount"))})
    info = chosen.select("spending_campaign_id", "tier_id", "campaign_tier", "reward_id").distinct()
    conv = conversion.select(F.col("member_id").alias("_m"), F.col("mall_id").alias("_mall"), F.col("spending_campaign_id").alias("_c"), F.col("tier_id").alias("_t"), "redemption_datetime", "id")
    given = conv.join(info, (F.col("_c") == F.col("spending_campaign_id")) & (F.col("_t") == F.col("tier_id"))).drop("_c", "_t")
    by_time = matching.interval_join(given, df.filter(F.col("coupon_redeem_date") < F.lit(day)),
                                     {"_m": "redeem_coupon_member_id", "_mall": "coupon_redeemed_mall_id", "reward_id": "coupon_id"}, "redemption_datetime", "coupon_redeem_datetime", slack_s, slack_s)
    links = mapping.select(F.col("id").alias("_id"), "redemption_transaction_id")
    by_map = df.filter(F.col("coupon_redeem_date") >= F.lit(day)).join(links, F.col("coupon_redemption_transaction_id") == F.col("redemption_transaction_id")).join(
        conversion.select("id", F.col("tier_id").alias("_t")), F.col("_id") == F.col("id")).join(info, F.col("_t") == F.col("tier_id"))
    columns = df.columns + ["spending_campaign_id", "tier_id", "campaign_tier"]
    return sets.union_distinct(by_time.select(*columns), by_map.select(*columns))


def linked_spending(spending: DataFrame, direct: DataFrame, coupons: DataFrame, stage: Stage = recompute) -> DataFrame:
    """All receipts tied to a campaign, with their kind. ``spending`` is unique on the receipt.

    Only receipts of a member, mall and day that a link names are led anywhere, once. Links are found and made
    distinct on the few columns that decide them; whole receipts are joined once, at the end.
    """
    day = ["member_id", "mall_id", "receipt_transaction_date"]
    keys = direct.select("member_id", F.col("spending_mall_id").alias("mall_id"), F.col("spending_transaction_date").alias("receipt_transaction_date"), *LINK).distinct()
    later = coupons.filter("coupon_used_date <> coupon_redeem_date")
    malls = later.select(F.col("redeem_coupon_member_id").alias("member_id"), F.col("coupon_used_in_mall_id").alias("mall_id"), F.col("coupon_used_date").alias("receipt_transaction_date"),
                         "spending_campaign_id", "tier_id", F.col("coupon_redeem_date").alias("redemption_date"), F.col("coupon_redeemed_mall_id").alias("redemption_mall_id")).distinct()
    days = stage(sets.union_distinct(keys.select(*day), malls.select(*day)), "linked-days")
    receipts = stage(semi_reduced(spending, days, {c: c for c in day}), "linked-receipts")
    slim = receipts.select("receipt_id", *day, "shop_id", "receipt_upload_date")
    first = slim.join(keys, day)
    hits = direct.select("receipt_id", *LINK)
    first = joins.flag_exists(first, hits, {c: c for c in ("receipt_id", *LINK)}, "_direct")
    same_day = coupons.filter("coupon_used_date = coupon_redeem_date")
    first = joins.flag_exists(first, same_day, {"spending_campaign_id": "spending_campaign_id", "tier_id": "tier_id", "coupon_redeem_date": "redemption_date",
                                                "coupon_redeemed_mall_id": "redemption_mall_id", "redeem_coupon_member_id": "member_id", "coupon_used_in_shop_id": "shop_id"}, "_same")
    kind = F.when(F.col("_direct") == 1, FIRST).when((F.col("_same") == 1) & (F.col("receipt_upload_date") == F.col("receipt_transaction_date")), SECOND).otherwise(FIRST_INDIRECT)
    first = first.withColumn("linked_spend_type", kind).drop("_direct", "_same")
    second = slim.join(malls, day)
    second = joins.flag_exists(second, later, {"redeem_coupon_member_id": "member_id", "coupon_used_in_shop_id": "shop_id", "coupon_used_date": "receipt_transaction_date",
                                               "spending_campaign_id": "spending_campaign_id", "tier_id": "tier_id"}, "_shop")
    second = second.withColumn("linked_spend_type", F.when(F.col("_shop") == 1, SECOND).otherwise(SECOND_INDIRECT)).drop("_shop")
    links = sets.union_distinct(*[df.select("receipt_id", *LINK, "linked_spend_type") for df in (first, second)])
    return receipts.join(links, "receipt_id")


def without_repeats(linked: DataFrame) -> DataFrame:
    """One receipt per invoice and kind; an indirect copy of a direct invoice is dropped; weaker kinds of an invoice already counted in the campaign are marked.

    Rows are shuffled once, to their campaign, member and invoice; a null there or in the other keys equals nothing. No row is given twice.
    """
    same = [*LINK, "member_id", "invoice_no", "shop_id"]
    invoice = ["spending_campaign_id", "member_id", "invoice_no"]
    kind = F.col("linked_spend_type")
    # Strength of the strongest kind an invoice has in the campaign, before cleaning.
    strength = F.when(kind == FIRST, 1).when(kind == SECOND, 2).when(kind == FIRST_INDIRECT, 3).otherwise(4)
    best = F.min(strength).over(Window.partitionBy(*invoice))
    direct = F.max(kind == FIRST).over(Window.partitionBy(*same))
    rows = linked.repartition(*invoice).withColumn("_best", best).withColumn("_direct", direct)
    copy = (kind == FIRST_INDIRECT) & F.col("_direct") & joins.all_of([F.col(c).isNotNull() for c in same])
    kept = latest.first_ranked(rows.filter(~copy), [*same, "linked_spend_type"], ["receipt_id"])
    repeated = (F.col("_best") < strength) & joins.all_of([F.col(c).isNotNull() for c in invoice])
    return kept.withColumn("spending_filter", F.when(repeated, REPEATED).otherwise(VALID)).drop("_best", "_direct").distinct()


def used_without_invoice(coupons: DataFrame, linked: DataFrame, shop: DataFrame, like: DataFrame, *, used_status: str) -> DataFrame:
    """Coupons used in a shop without a counted receipt there, as rows of their own."""
    counted = linked.filter((F.col("linked_spend_type") == SECOND) & (F.col("spending_filter") == VALID))
    keys = ["coupon_used_in_mall_id", "redeem_coupon_member_id", "coupon_used_in_shop_id", "coupon_used_date", "coupon_redeem_date", "coupon_redeemed_mall_id", "spending_campaign_id", "tier_id"]
    used = coupons.filter(F.col("redemption_status_detail") == used_status).groupBy(*keys).agg(F.sum("min_top_up_amount").alias("_top_up"))
    gap = joins.anti(used, counted, {"member_id": "redeem_coupon_member_id", "receipt_transaction_date": "coupon_used_date", "shop_id": "coupon_used_in_shop_id", "tier_id": "tier_id"})
    gap = joins.enrich(gap, [(shop, {"mapping_shop_id": "coupon_used_in_shop_id"}, {"lms_standard_brand_name": "lms_standard_brand_name", "lms_standard_trade_category": "lms_standard_trade_category"})])
    rows = gap.select(
        F.lit(MISSING).alias("invoice_no"), F.col("coupon_used_date").alias("receipt_transaction_date"), F.col("coupon_used_in_mall_id").alias("mall_id"),
        F.col("redeem_coupon_member_id").alias("member_id"), F.col("coupon_used_in_shop_id").alias("shop_id"), "lms_standard_brand_name", "lms_standard_trade_category",
        F.coalesce("_top_up", F.lit(0)).alias("receipt_amount"), "spending_campaign_id", "tier_id", F.col("coupon_redeem_date").alias("redemption_date"),
        F.col("coupon_redeemed_mall_id").alias("redemption_mall_id"), F.lit(NO_INVOICE).alias("linked_spend_type"), F.lit(MISSING).alias("spending_filter"))
    from martkit.operators.projection import pad_to

    return pad_to(rows.distinct(), like.schema)


def campaign_transactions(parts: Sequence[DataFrame], mechanism: DataFrame, mall: DataFrame) -> DataFrame:
    """Linked spending and missing invoices with tier, campaign and redemption place. ``parts`` have distinct rows and no kind of spending in common."""
    tiers = mechanism.select("tier_id", "campaign_tier", "campaign_name", "campaign_start_date", "campaign_end_date").distinct()
    return joins.enrich(sets.union_all(*parts), [
        (tiers, {"tier_id": "tier_id"}, {c: c for c in tiers.columns if c != "tier_id"}), (mall, {"mall_id": "redemption_mall_id"}, {"property_id": "redemption_property_id"})])


def campaign_linked_spending(spending: DataFrame, mechanism: DataFrame, redemption: DataFrame, rules: DataFrame, coupon: DataFrame, mapping: DataFrame, shop: DataFrame, mall: DataFrame, *,
                             switch: date | str, used_status: str, stage: Stage = recompute) -> DataFrame:
    """The whole mart. Direct spending, coupons and linked spending are used several times each, so they are staged."""
    chosen = selected(mechanism)
    receipts = campaign_spending(spending)
    conversion = conversions(redemption, chosen)
    direct = stage(first_direct(receipts, conversion, rules), "first-direct")
    given = stage(coupons_redeemed(coupon, chosen, conversion, mapping, switch=switch), "campaign-coupons")
    linked = stage(linked_spending(receipts, direct, given, stage), "linked-spending")
    cleaned = stage(without_repeats(linked), "linked-spending-clean")
    missing = used_without_invoice(given, cleaned, shop, cleaned, used_status=used_status)
    return campaign_transactions([cleaned, missing], mechanism, mall)
