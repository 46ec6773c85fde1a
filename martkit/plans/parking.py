"""Parking: visits, invoices, redemptions, parker identity and daily counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType

from martkit.functions import codes, dates, privacy, text
from martkit.operators import aggregates, distincts, joins, ordered, sets
from martkit.sources.staging import Stage

MIN_YEAR = 2018  # fixed value: earlier records are test data of the sources
MIN_MINUTES = 15  # fixed value: shorter stays are passages
VISIT_TEXT = ["car_plate", "car_type", "member_id", "property_id", "carpark_id"]


def _since(df: DataFrame, col: str, year: int) -> DataFrame:
    return df.filter(F.col(col) >= F.lit(date(year, 1, 1)))


def _placed(df: DataFrame, carparks: Mapping[str, str], properties: Mapping[str, str]) -> DataFrame:
    """Car park and property codes replaced where a mapping lists them, ignoring case."""
    upper = lambda m: {k.upper(): v for k, v in m.items()}
    return df.withColumns({
        "carpark_id": codes.override(codes.decode(F.upper("carpark_id"), upper(carparks)), F.col("carpark_id")),
        "property_id": codes.override(codes.decode(F.upper("property_id"), upper(properties)), F.col("property_id"))})


def _hashed(df: DataFrame, hidden: DataFrame) -> DataFrame:
    """Plates of the members in ``hidden`` become pseudonyms; ids are compared in upper case."""
    df = joins.flag_exists(df.withColumn("_mid", F.upper("member_id")), hidden.select(F.upper("member_id").alias("mid")), {"mid": "_mid"}, "_hide", fillers=[""])
    return df.withColumn("car_plate", privacy.hash_when(F.col("car_plate"), F.col("_hide") == 1)).drop("_hide", "_mid")


def visit_rows(parts: Sequence[DataFrame], *, min_year: int = MIN_YEAR, min_minutes: int = MIN_MINUTES) -> DataFrame:
    """Visits of all sources in one shape, long enough and recent enough, without duplicates."""
    shaped = [
        _since(p, "car_in_datetime", min_year).filter(F.col("parked_minute") >= min_minutes).select(
            "car_in_datetime", "car_out_datetime", F.trim("car_plate").alias("car_plate"), F.trim("car_type").alias("car_type"), "member_id", "parked_minute",
            "property_id", F.col("property_id").alias("carpark_id"), "total_paid_minute", "total_parking_fee", "total_redeem_minute")
        for p in parts]
    return sets.union_all(*shaped).na.fill("", VISIT_TEXT).distinct()


def contactless_entries(gate_log: DataFrame, sites: DataFrame, carparks: Mapping[str, str]) -> DataFrame:
    """(car park code, time, plate) of every contactless entry."""
    named = joins.enrich(gate_log.filter(F.lower("operation") == "in"), [(sites, {"id": "carparkid"}, {"name": "_name"})])
    mapped = codes.decode(F.upper("_name"), {k.upper(): v for k, v in carparks.items()})
    return named.select(codes.override(mapped, F.col("_name")).alias("carpark_id"), F.col("timestamp").alias("car_in_datetime"), F.lower("lpn").alias("plate"))


def parking_visits(visits: DataFrame, entries: DataFrame, hidden: DataFrame, *, carparks: Mapping[str, str], properties: Mapping[str, str]) -> DataFrame:
    """Visits with mapped places, a contactless flag (same place, time and plate) and hidden plates."""
    df = _placed(visits, carparks, properties).withColumn("_plate", F.lower("car_plate"))
    df = joins.flag_exists(df, entries, {"carpark_id": "carpark_id", "car_in_datetime": "car_in_datetime", "plate": "_plate"}, "is_contactless")
    return _hashed(df, hidden).drop("_plate").distinct()


def gate_visits(gate_log: DataFrame, mall: DataFrame, *, prefix: str, segment: str = "day") -> DataFrame:
    """Visits rebuilt from a gate log: each entry with the first strictly later exit of plate and site.

    The per-key pairing works in time segments, so one very busy plate is no problem.
    """
    paired = ordered.pair_next(gate_log, ["lpn", "carparkid"], "timestamp", "operation", "in", "out", "car_out_datetime", ordered.day_blocks("timestamp", segment))
    df = joins.enrich(paired, [(mall, {"mall_id": "carparkid"}, {"mall_name": "_mall"})])
    return df.select(
        F.col("timestamp").alias("car_in_datetime"), "car_out_datetime", F.col("lpn").alias("car_plate"),
        dates.minutes_between(F.col("timestamp"), F.col("car_out_datetime")).cast("int").alias("parked_minute"), F.concat(F.lit(prefix), "_mall").alias("property_id"),
        F.col("carparkid").cast("string").alias("carpark_id"), F.lit(1).alias("is_contactless"))


def daily_visits(visits: DataFrame, *, offset_hours: int = 8) -> DataFrame:
    """Frequencies and totals per place, local day and plate, overall and contactless.

    A visit is a place, a plate and a time of entry. Place and plate are group keys, so rows are first summed up per time of
    entry, and counting those rows is counting distinct visits; a visit without place or plate is not counted.
    """
    touch = F.col("is_contactless") == 1
    measures = ["parked_minute", "total_paid_minute", "total_parking_fee", "total_redeem_minute"]
    name = lambda m: m if m.startswith("total_") else f"total_{m}"
    keys = ["property_id", "carpark_id", "car_in_date", "car_plate"]
    timed = visits.withColumn("car_in_date", dates.local_date(F.col("car_in_datetime"), offset_hours)).groupBy(*keys, "car_in_datetime").agg(
        F.max(touch).alias("_touch"), *[F.sum(m).alias(m) for m in measures], *[aggregates.sum_when(F.col(m), touch).alias(f"_{m}") for m in measures])
    known = F.col("carpark_id").isNotNull() & F.col("car_plate").isNotNull() & F.col("car_in_datetime").isNotNull()
    return timed.groupBy(*keys).agg(
        F.count(F.when(known, 1)).alias("total_freq"), *[F.sum(m).alias(name(m)) for m in measures], F.count(F.when(known & F.col("_touch"), 1)).alias("total_freq_with_contactless"),
        *[F.sum(f"_{m}").alias(f"{name(m)}_with_contactless") for m in measures])


def parking_invoices(parts: Sequence[DataFrame], hidden: DataFrame, *, carparks: Mapping[str, str], properties: Mapping[str, str],
                     min_year: int = MIN_YEAR) -> DataFrame:
    """Invoices of all sources: leading zeros off, places mapped, plates hidden."""
    shaped = [_since(p, "car_in_datetime", min_year).select(
        "car_in_datetime", "car_out_datetime", F.trim("car_plate").alias("car_plate"), "member_id", "property_id", F.col("property_id").alias("carpark_id"),
        "invoice_amount", text.strip_leading_zeros(F.col("invoice_no")).alias("invoice_no"), "redemption_datetime", *[F.trim(c).alias(c) for c in ("shop_category", "shop_name", "shop_no")])
        for p in parts]
    df = sets.union_all(*shaped).na.fill("", ["car_plate", "member_id", "property_id", "carpark_id", "shop_category", "shop_name", "shop_no"]).distinct()
    return _hashed(_placed(df, carparks, properties), hidden)


def parking_redemptions(parts: Sequence[DataFrame], hidden: DataFrame, *, carparks: Mapping[str, str], properties: Mapping[str, str],
                        min_year: int = MIN_YEAR) -> DataFrame:
    """Redemptions of all sources with times cut to the minute."""
    shaped = [_since(p, "car_in_datetime", min_year).filter(F.col("property_id") != "").select(
        *[dates.to_minute(F.col(c)).alias(c) for c in ("car_in_datetime", "car_out_datetime", "redemption_datetime")], F.trim("car_plate").alias("car_plate"), "member_id",
        "property_id", F.col("property_id").alias("carpark_id"), "redeemed_minute", "redeemed_parking_fee", F.trim("redemption_type").alias("redemption_type")) for p in parts]
    df = sets.union_all(*shaped).na.fill("", ["car_plate", "member_id", "redemption_type"]).distinct()
    return _hashed(_placed(df, carparks, properties), hidden)


EVIDENCE = StructType([
    StructField("identify_type", StringType()), StructField("member_id", StringType()), StructField("car_plate", StringType()), StructField("property_id", StringType()),
    StructField("receipt_id", LongType()), StructField("receipt_transaction_date", DateType()), StructField("invoice_no", StringType()), StructField("shop_name", StringType()),
    StructField("receipt_amount", DecimalType(18, 2)), StructField("property_id_parking", StringType()), StructField("redeemed_at", TimestampNTZType()),
    StructField("invoice_no_parking", StringType()), StructField("receipt_amount_parking", DecimalType(18, 2)), StructField("redemption_transaction_id", StringType()),
    StructField("charged_at", TimestampNTZType())])
# Kinds of evidence.
BY_INVOICE, BY_CONTACTLESS, BY_APP, BY_PARKING, BY_CHARGING = ("identify by Invoice", "identify by Contactless Parking", "identify by Inapp Free Parking Redemption",
                                                               "identify by member parking", "identify by EV Charging")


def _plate(col: str) -> Column:
    return F.upper(F.trim(col))


def invoice_evidence(spending: DataFrame, invoices: DataFrame, *, member_prefix: str, offset_hours: int = 8) -> DataFrame:
    """Receipt and parking invoice of the same day, place, number and amount. Any missing part means no match."""
    spend = spending.filter(F.col("member_id") != "").select(
        "member_id", "property_id", "receipt_id", "receipt_transaction_date", "invoice_no", "shop_name", "receipt_amount", text.match_key(
            F.to_date("receipt_transaction_date"), F.col("property_id"), F.lower(text.strip_leading_zeros(F.col("invoice_no"))), F.col("receipt_amount").cast("decimal(18,2)")).alias("_key"))
    inv = invoices.filter(~F.startswith("member_id", F.lit(member_prefix))).select(
        _plate("car_plate").alias("car_plate"), F.col("property_id").alias("property_id_parking"), F.col("redemption_datetime").alias("redeemed_at"),
        F.col("invoice_no").alias("invoice_no_parking"), F.col("invoice_amount").alias("receipt_amount_parking"), text.match_key(
            dates.local_date(F.col("car_in_datetime"), offset_hours), F.col("property_id"), F.lower("invoice_no"), F.col("invoice_amount").cast("decimal(18,2)")).alias("_ikey"))
    return spend.join(inv, F.col("_key") == F.col("_ikey")).drop("_key", "_ikey").withColumn("identify_type", F.lit(BY_INVOICE))


def vehicle_evidence(vehicles: DataFrame) -> DataFrame:
    return vehicles.filter("validationsts = 1 and memberId <> ''").select(F.lit(BY_CONTACTLESS).alias("identify_type"), F.col("memberId").alias("member_id"), _plate("lpn").alias("car_plate"))


def app_evidence(transactions: DataFrame, activity: DataFrame, redemption: DataFrame) -> DataFrame:
    df = transactions.join(activity, F.col("rlog_id") == F.col("log_id")).join(redemption.select("transaction_id", "member_id"), F.col("t_id") == F.col("transaction_id"))
    return df.filter("member_id <> ''").select(F.lit(BY_APP).alias("identify_type"), "member_id", _plate("lpn").alias("car_plate"), F.col("r_time").alias("redeemed_at"),
                                               F.col("t_id").alias("redemption_transaction_id"))


def parking_evidence(invoices: DataFrame, *, member_prefix: str) -> DataFrame:
    return invoices.filter(F.startswith("member_id", F.lit(member_prefix))).select(
        F.lit(BY_PARKING).alias("identify_type"), _plate("member_id").alias("member_id"), _plate("car_plate").alias("car_plate"), F.col("property_id").alias("property_id_parking"),
        F.col("redemption_datetime").alias("redeemed_at"), F.col("invoice_no").alias("invoice_no_parking"), F.col("invoice_amount").alias("receipt_amount_parking"))


def charging_evidence(sessions: DataFrame, *, offset_hours: int = 8) -> DataFrame:
    return sessions.filter(F.col("status").isin("Settled", "Unsettled") & F.col("externalMemberId").isNotNull()).select(
        F.lit(BY_CHARGING).alias("identify_type"), F.col("externalMemberId").alias("member_id"), _plate("lp").alias("car_plate"),
        dates.shift_hours(F.col("createDttm"), offset_hours).alias("charged_at"))


def identity_history(parts: Sequence[DataFrame], member: DataFrame, *, hidden_status: str = "V") -> DataFrame:
    """All evidence of known members; plates of deleted members are pseudonyms."""
    return _known(sets.union_evidence(parts, EVIDENCE).distinct(), member, hidden_status)


def _known(df: DataFrame, member: DataFrame, hidden_status: str) -> DataFrame:
    known = member.select(F.upper("member_id").alias("_mid"), "status")
    df = df.join(known, F.upper("member_id") == F.col("_mid"))
    return df.withColumn("car_plate", privacy.hash_when(F.col("car_plate"), F.col("status") == hidden_status)).drop("_mid", "status")


def parker_identity(history: DataFrame) -> DataFrame:
    """One row per member and plate with a flag per channel."""
    kind = F.col("identify_type")
    return history.groupBy("member_id", "car_plate").agg(
        aggregates.ever(kind == BY_CONTACTLESS).alias("is_contactless_carplate"), aggregates.ever(kind.isin(BY_INVOICE, BY_APP, BY_PARKING)).alias("is_member_parking_carplate"),
        aggregates.ever(kind == BY_CHARGING).alias("is_ev_charging_carplate"))


def parker_identity_of(parts: Sequence[DataFrame], member: DataFrame, *, hidden_status: str = "V") -> DataFrame:
    """``parker_identity`` straight from the evidence: three columns of it, summed up to one row a pair before the members are joined."""
    pairs = parker_identity(sets.union_all(*[p.select("member_id", "car_plate", "identify_type") for p in parts]))
    flags = [c for c in pairs.columns if c.startswith("is_")]
    return _known(pairs, member, hidden_status).groupBy("member_id", "car_plate").agg(*[F.max(c).alias(c) for c in flags])


def contactless_pairs(vehicles: DataFrame, event_log: DataFrame, *, as_of: date | str) -> DataFrame:
    """Member and plate pairs registered up to yesterday: today's adds are taken out, today's removals put back."""
    low = lambda c: F.trim(F.lower(c))
    today = event_log.filter(F.col("type").isin(7, 2) & F.col("member_id").isNotNull() & (F.col("event_time") > F.lit(dates.days_before(as_of, 1)))).select(
        low("lpn").alias("lpn"), low("member_id").alias("member_id"), "type").distinct()
    valid = vehicles.filter("validationsts = 1").select(low("lpn").alias("lpn"), low("memberId").alias("member_id"))
    keep = joins.anti_null_aware(valid, today, {"lpn": "lpn", "member_id": "member_id"})
    return keep.unionByName(today.filter("type = 2").drop("type"))


def parkers_until(history: DataFrame, redemption: DataFrame, *, as_of: date | str) -> DataFrame:
    """Members and plates seen parking up to yesterday."""
    last = F.lit(dates.days_before(as_of, 1))
    df = joins.enrich(history, [(redemption, {"transaction_id": "redemption_transaction_id"}, {"redeem_date": "_day"})])
    day = codes.first_match([(F.col("identify_type") == BY_APP, F.col("_day")), (F.col("identify_type") == BY_INVOICE, F.col("receipt_transaction_date")),
                             (F.col("identify_type") == BY_PARKING, F.to_date("redeemed_at")), (F.col("identify_type") == BY_CHARGING, F.to_date("charged_at"))])
    return df.filter(day <= last).select(F.trim(F.lower("member_id")).alias("member_id"), F.trim(F.lower("car_plate")).alias("car_plate")).distinct()


def autopay_members(base: DataFrame, log: DataFrame, *, as_of: date | str) -> DataFrame:
    """Members whose activations outnumber their deactivations by yesterday."""
    cols = [F.trim(F.lower("member_id")).alias("member_id"), F.col("autopayment_activate").cast("int").alias("signed")]
    until = log.filter(F.col("created_at") < F.lit(dates.as_date(as_of)))
    return aggregates.currently_active(base.select(*cols).unionByName(until.select(*cols)), ["member_id"], "signed").select("member_id")


def parking_counters(gate_log: DataFrame, pairs: DataFrame, parkers: DataFrame, autopay: DataFrame, *, as_of: date | str) -> DataFrame:
    """One stamped row of cumulative distinct counts. ``gate_log`` holds the month so far."""
    others = joins.anti(parkers, pairs, {"member_id": "member_id"})
    both = joins.semi(autopay, pairs, {"member_id": "member_id"})
    count = F.count_distinct
    return aggregates.metric_row({
        "contactless_lpn": (pairs, count("lpn")), "contactless_parker": (pairs, count("member_id")),
        "contactless_entries_during_that_month": (gate_log, count(F.trim(F.lower("lpn")))), "non_contactless_parker": (others, count("member_id")),
        "non_contactless_lpn": (others, count("car_plate")), "autopay_user": (autopay, count("member_id")), "autopay_contactless_user": (both, count("member_id")),
    }, {"update_date": dates.days_before(as_of, 1)})


def entry_states(gate_log: DataFrame, numbers: DataFrame, *, ts: str = "timestamp", offset_hours: int = 8) -> DataFrame:
    """States of the plates that entered on each local day, stored beside the gate log. ``numbers`` is the plates' dictionary."""
    rows = gate_log.select(F.trim(F.lower("lpn")).alias("lpn"), dates.local_date(F.col(ts), offset_hours).alias("day"))
    return distincts.states(rows, ["day"], "lpn", numbers)


def plates(gate_log: DataFrame, stage: Stage, known: DataFrame | None = None) -> DataFrame:
    """The dictionary of plates, grown by those of new log rows."""
    return distincts.dictionary(gate_log.select(F.trim(F.lower("lpn")).alias("lpn")), "lpn", stage, known)


def entries_so_far(month_to_date: DataFrame, day: DataFrame, *, as_of: date | str) -> tuple[DataFrame, DataFrame]:
    """(counter, state) of the month after one more day: yesterday's state and that day's, no log of earlier days."""
    state = distincts.advance(month_to_date, day, [])
    counter = distincts.count_states(state, [], "contactless_entries_during_that_month")
    return counter.withColumn("update_date", F.lit(dates.days_before(as_of, 1))), state


def counters_by_mall(pairs: DataFrame, event_log: DataFrame, merchant: DataFrame, mall: DataFrame, *, as_of: date | str, unknown: str = "Can not check") -> DataFrame:
    """Contactless members and plates by the mall of the plate's last activation."""
    from martkit.operators import latest

    added = event_log.filter("type = 7 and member_id is not null and lpn is not null")
    last = latest.latest_by_max(added, ["member_id", "lpn"], "event_time")
    placed = joins.enrich(last, [(merchant, {"carpark_id": "carpark_id"}, {"mall_id": "_mall"}), (mall, {"mall_id": "_mall"}, {"property_id": "property_id"})])
    placed = placed.select(F.trim(F.lower("member_id")).alias("member_id"), F.trim(F.lower("lpn")).alias("lpn"), "property_id").distinct()
    df = pairs.join(placed, ["member_id", "lpn"], "left").withColumn("property_id", F.coalesce("property_id", F.lit(unknown)))
    return df.groupBy("property_id").agg(F.count_distinct("member_id").alias("contactless_parker"), F.count_distinct("lpn").alias("contactless_lpn")).withColumn(
        "update_date", F.lit(dates.days_before(as_of, 1)))
