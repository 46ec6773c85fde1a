"""Where new members come from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import codes, jsontext, text
from martkit.operators import joins, latest

TRACKED = ("scene", "oa", "key")


@dataclass(frozen=True)
class Rules:
    """Everything that names a channel, partner or site is configuration."""

    website_names: Sequence[str] = ()
    website_keys: Sequence[str] = ()
    mini_keys: Sequence[str] = ()
    mini_marker: str = "Wechat"
    website: str = "Website"
    mini: str = "Wechat"
    manual: str = "Manual Create"
    registration_action: int = 6
    pages: Sequence[str] = ()
    inapp_links: Sequence[str] = ()
    campaign_links: Mapping[str, str] = field(default_factory=dict)  # link prefix -> source
    api_malls: Mapping[int, str] = field(default_factory=dict)  # mall id -> partner
    api_campaigns: Mapping[str, str] = field(default_factory=dict)  # from_mall_name -> campaign
    lost_links: Sequence[tuple[int, str, str, str]] = ()  # mall id, name prefix, medium, campaign
    source_names: Mapping[str, str] = field(default_factory=dict)
    other_source: str = "OTHERS"
    non_mall: Sequence[str] = ()


def member_channel(member: DataFrame, activity: DataFrame, api_keys: DataFrame, placed: DataFrame, rules: Rules) -> DataFrame:
    """Registration channel per member; a hand-made place wins over the recorded one."""
    hist = joins.enrich(activity.filter(F.col("action_type") == rules.registration_action), [(api_keys, {"api_key": "api_key"}, {"name": "_name"})])
    name = F.coalesce("_name", F.lit(rules.manual))
    hist = hist.select("member_id", codes.first_match([
        (name.isin(list(rules.website_names)) | F.col("api_key").isin(list(rules.website_keys)), rules.website),
        (F.col("api_key").isin(list(rules.mini_keys)) | name.contains(rules.mini_marker), rules.mini)], name).alias("channel"))
    df = member.join(hist, "member_id", "left")
    df = joins.enrich(df, [(placed.withColumn("_one", F.lit(1)), {"member_id": "member_id"}, {"from_mall_id": "_pid", "from_mall_name": "_pname", "_one": "_hit"})])
    hit = F.col("_hit").isNotNull()
    return df.select("member_id", "registration_date", "created_by", "channel", F.col("phone_prefix").alias("mobile_prefix"),
                     F.when(hit, F.col("_pid")).otherwise(F.col("from_mall_id")).alias("from_mall_id"),
                     F.when(hit, F.col("_pname")).otherwise(F.col("from_mall_name")).alias("from_mall_name"))


def tracking_visits(log: DataFrame, rules: Rules) -> DataFrame:
    """Registration page visits with the routed keys of their scene JSON, private keys removed."""
    scene = F.replace("scene", F.lit("%3D"), F.lit("="))
    df = log.filter(F.col("path").isin(list(rules.pages))).select("openid", "last_track_time", scene.alias("scene")).distinct()
    raw = jsontext.route_json_keys(F.col("scene"), {"_scene": "$.query.scene", "_oa": "$.query.oa", "_key": "$.query.key", "member": "$.memberId"})
    df = df.withColumns(raw)
    referral = F.contains(F.lower("_scene"), F.lit("mgm"))
    keys = F.map_keys(F.from_json(F.get_json_object("scene", "$.query"), "map<string,string>"))
    strip = lambda c, *marks: _strip(F.col(c), marks)
    return df.select(
        "openid", "last_track_time", F.col("member").alias("member_id"), jsontext.drop_json_keys(F.col("scene"), ["phone"]).alias("scene"),
        strip("_oa", "key=").alias("oa"), F.when(~referral, strip("_scene", "btl-", "oa=", "key=")).alias("btl"), strip("_key", "key=").alias("key"),
        F.when(referral, F.col("_scene")).otherwise(F.get(F.filter(keys, lambda k: F.contains(k, F.lit("mgm"))), F.lit(0))).alias("mgm"))


def _strip(col: Column, marks: Sequence[str]) -> Column:
    for mark in marks:
        col = F.replace(col, F.lit(mark), F.lit(""))
    return col


def mini_source() -> Column:
    return codes.first_match([(F.col("oa").isNotNull(), F.col("oa")), (F.col("btl").isNotNull(), F.col("btl")), (F.col("key").isNotNull(), F.col("key")),
                              (F.col("mgm").isNotNull(), "MGM")])


def tracking_by_member(visits: DataFrame, member: DataFrame) -> DataFrame:
    """(member_id, scene, source) of the first labelled visit on the registration day."""
    useful = visits.filter(F.coalesce("oa", "btl", "key", "mgm").isNotNull() & F.col("member_id").isNotNull())
    days = member.select(F.upper("member_id").alias("_mid"), F.to_date("registration_date").alias("_day"))
    same = useful.join(days, (F.upper("member_id") == F.col("_mid")) & (F.to_date("last_track_time") == F.col("_day")))
    first = latest.first_ranked(same, ["_mid"], ["last_track_time", "scene"], ties=False)
    return first.select(F.col("_mid").alias("member_key"), "scene", mini_source().alias("source"))


def tracking_by_openid(visits: DataFrame, receivers: DataFrame, member: DataFrame) -> DataFrame:
    """The same by the member's first known open id and day."""
    ids = receivers.filter("vip_num is not null and openid is not null").select(F.col("vip_num").alias("member_id"), "openid", "created_date")
    first_id = latest.first_ranked(ids, ["member_id"], ["created_date", "openid"], ties=False)
    keyed = first_id.join(member.select("member_id", F.to_date("registration_date").alias("_day")), "member_id")
    per_day = latest.first_ranked(visits.withColumn("_vday", F.to_date("last_track_time")), ["openid", "_vday"], ["last_track_time", "scene"], ties=False)
    hit = per_day.select(F.col("openid").alias("_oid"), "_vday", "scene", mini_source().alias("source"))
    return keyed.join(hit, (F.col("openid") == F.col("_oid")) & (F.col("_day") == F.col("_vday"))).select("member_id", "scene", "source")


def website_links(links: DataFrame, fixes: DataFrame) -> DataFrame:
    """Registration link and its campaign parameters; hand-made links win."""
    from martkit.operators.sets import override_rows

    both = override_rows(links.select("member_id", "url_params").distinct(), fixes.select("member_id", "url_params").distinct(), ["member_id"])
    return both.select("member_id", "url_params", *[text.url_param(F.col("url_params"), f"utm_{p}").alias(f"utm_{p}") for p in ("source", "mall", "medium", "campaign")])


def manual_sites(users: DataFrame, mall: DataFrame) -> DataFrame:
    """(login, property) of the staff account that is active, else newest."""
    best = latest.first_ranked(users, [F.lower("login_name")], [F.when(F.col("status") == "A", 0).otherwise(1), F.col("updated_date").desc(), "mall_id"], ties=False)
    return joins.enrich(best, [(mall, {"mall_id": "mall_id"}, {"property_id": "property_id"})]).select("login_name", "property_id")


def registration_attribution(channel: DataFrame, website: DataFrame, by_member: DataFrame, by_openid: DataFrame, manual: DataFrame, path_malls: DataFrame,
                             source_map: DataFrame, mall: DataFrame, rules: Rules) -> DataFrame:
    """Channel, link, source, medium, campaign and allocated site of every registration."""
    df = joins.enrich(channel.withColumn("_mkey", F.upper("member_id")), [
        (website, {"member_id": "member_id"}, {c: c for c in ("url_params", "utm_source", "utm_mall", "utm_medium", "utm_campaign")}),
        (by_member.withColumn("_one", F.lit(1)), {"member_key": "_mkey"}, {"scene": "_mscene", "source": "_msource", "_one": "_mhit"}),
        (by_openid, {"member_id": "member_id"}, {"scene": "_oscene", "source": "_osource"}), (manual, {"login_name": "created_by"}, {"property_id": "_site"})])
    ch, mall_id, url = F.col("channel"), F.col("from_mall_id"), F.col("url_params")
    web, mini, api = ch == rules.website, ch == rules.mini, mall_id.isin(list(rules.api_malls))
    by_id = F.col("_mhit").isNotNull()
    link = codes.first_match([(api, "Registration is made by calling API"), (web, url), (mini & by_id, F.col("_mscene")), (mini, F.col("_oscene"))])
    campaign_link = [(web & url.startswith(p), s) for p, s in rules.campaign_links.items()]
    source = codes.first_match([
        (api, codes.decode(mall_id, rules.api_malls)), (web & url.isin(list(rules.inapp_links)), "inapp"), *campaign_link,
        (web, F.coalesce("utm_source", "utm_mall")), (mini & by_id, F.col("_msource")), (mini, F.col("_osource")), (ch == rules.manual, F.col("_site"))])
    df = df.withColumns({"link": link, "source": F.upper(source)})
    df = joins.enrich(df, [(path_malls.select(F.upper("trackingpath").alias("_path"), "mall").distinct(), {"_path": "source"}, {"mall": "_path_mall"})])
    lost = [((mall_id == m) & F.startswith("from_mall_name", F.lit(p)) & F.col("link").isNull(), p, med, camp) for m, p, med, camp in rules.lost_links]
    tail = lambda p: F.substring(F.col("from_mall_name"), F.lit(len(p) + 1), F.length("from_mall_name"))
    partner = F.upper(codes.decode(mall_id, rules.api_malls))
    final_source = codes.first_match([*[(c, F.upper(tail(p))) for c, p, _, _ in lost], (mini & F.col("_path_mall").isNotNull(), F.upper("_path_mall"))],
                                     codes.override(codes.decode(F.col("source"), rules.source_names), F.coalesce("source", F.lit(rules.other_source))))
    medium = codes.first_match([*[(c, m) for c, _, m, _ in lost], (api, partner), (web, F.upper("utm_medium"))])
    campaign = codes.first_match([*[(c, k) for c, _, _, k in lost], (api, codes.override(codes.decode(F.col("from_mall_name"), rules.api_campaigns), F.upper("from_mall_name"))),
                                  (web, F.upper("utm_campaign"))])
    lost_label = codes.first_match([(c, "Lost tracking link") for c, _, _, _ in lost], F.col("link"))
    df = df.withColumns({"_final": final_source, "medium": medium, "campaign": campaign, "_link": lost_label})
    df = joins.enrich(df, [(source_map.select(F.upper("source").alias("_s"), F.upper("allocate_source").alias("_a")), {"_s": "_final"}, {"_a": "_alloc"})])
    sites = mall.groupBy(F.upper("property_id").alias("_p")).agg(F.min(F.struct("team", "mall_type")).alias("_site")).select("_p", "_site.*")
    df = joins.enrich(df.withColumn("allocate_source", F.coalesce("_alloc", "_final")), [
        (sites, {"_p": "_final"}, {"team": "_team"}), (sites, {"_p": "allocate_source"}, {"team": "_ateam", "mall_type": "_atype"})])
    known = F.col("_team").isNotNull() & ~F.col("_final").isin(list(rules.non_mall))
    alloc = F.lower("_atype") == "mall"
    return df.select("member_id", "registration_date", "created_by", "mobile_prefix", "from_mall_id", "from_mall_name", "channel", F.col("_link").alias("link"),
                     F.when(known, "Mall").otherwise("NON-MALL").alias("mall_non_mall"), F.when(known, F.col("_team")).otherwise("NON-MALL").alias("team"),
                     F.col("_final").alias("source"), "medium", "campaign", F.when(alloc, "MALL").otherwise("NON-MALL").alias("allocate_mall_non_mall"),
                     F.when(alloc, F.col("_ateam")).otherwise("NON-MALL").alias("allocate_team"), "allocate_source")


def tracking_attribution(log: DataFrame, path_malls: DataFrame, *, pages: Sequence[str], since_year: int, by_scene: bool = False,
                         patterns: Sequence[tuple[str, str, str]] = (), marks: Sequence[str] = ("key=", "key%3D", "btl-", "oa="), default: str = "OTHERS") -> DataFrame:
    """First registration-page visit per open id (or per open id and scene) with its site.

    ``patterns`` are (text in the scene, JSON path, text to remove). Ties stay.
    """
    from martkit.functions import dates

    df = log.filter(F.col("path").isin(list(pages)) & (F.col("last_track_time") >= F.lit(dates.as_date(f"{since_year}-01-01"))))
    first = latest.first_ranked(df, ["openid", "scene"] if by_scene else ["openid"], ["last_track_time"]).select("path", "openid", "last_track_time", "scene").distinct()
    label = _strip(jsontext.tracking_label(F.col("scene"), patterns, default), marks)
    out = joins.enrich(first.withColumn("extracted_mall_id", label).withColumn("_key", F.upper("extracted_mall_id")), [
        (path_malls.select(F.upper("trackingpath").alias("_path"), "mall").distinct(), {"_path": "_key"}, {"mall": "_mall"})])
    out = out.withColumns({"finalised_mall_id": F.coalesce("_mall", F.lit(default)), "scene": F.lit("N/A")}).drop("_mall", "_key")
    if by_scene:
        out = latest.first_ranked(out.filter("openid not in ('undefined', '')"), ["openid", "extracted_mall_id"], ["last_track_time"]).distinct()
    return out
