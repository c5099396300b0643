"""JSON members of every stream.

Fixed values: keys as the exports spell them, with the column each becomes.
"""

from __future__ import annotations

from adloom.operators.envelope import Field, fields

_ACTIONS = "json:array<struct<action_type:string,value:string>>"

FACEBOOK_INSIGHTS = [
    *fields(
        account_id="account_id",
        ad_id="ad_id",
        ad_name="ad_name",
        adset_id="adset_id",
        adset_name="adset_name",
        campaign_id="campaign_id",
        campaign_name="campaign_name",
        date_start="date_start",
    ),
    *fields("long", impressions="impressions"),  # reported clicks are link clicks, from the actions
    *fields("double", spend="spend"),
    *fields(
        _ACTIONS,
        actions="actions",
        play="video_play_actions",
        p25="video_p25_watched_actions",
        p50="video_p50_watched_actions",
        p75="video_p75_watched_actions",
        p100="video_p100_watched_actions",
    ),
]

FACEBOOK_CAMPAIGNS = fields(
    campaign_id="id",
    campaign_status="status",
    campaign_objective="objective",
    start_time="start_time",
    stop_time="stop_time",
)

FACEBOOK_DEVICES = fields(ad_id="ad_id", device_platform="device_platform")

DV360_STANDARD = [
    *fields(
        advertiser_currency="Advertiser Currency",
        cm360_post_click_revenue="CM360 Post-Click Revenue",
        cm360_post_view_revenue="CM360 Post-View Revenue",
    ),
    *fields("long", "safe", clicks="Clicks", video_completion="Complete Views (Video)"),
    *fields(creative_name="Creative"),
    *fields("iso_text:year_first_slash", date="Date"),
    *fields("long", "safe", video_25_completion="First-Quartile Views (Video)"),
    *fields(floodlight_activity_id="Floodlight Activity ID", floodlight_activity_name="Floodlight Activity Name"),
    *fields("long", "safe", impressions="Impressions"),
    *fields(
        campaign_name="Insertion Order",
        campaign_id="Insertion Order ID",
        campaign_status="Insertion Order Status",
        line_item="Line Item",
        line_item_id="Line Item ID",
    ),
    *fields("long", "safe", video_50_completion="Midpoint Views (Video)"),
    *fields(post_click_conversions="Post-Click Conversions", post_view_conversions="Post-View Conversions"),
    *fields("double", "safe", media_cost="Revenue (Adv Currency)"),
    *fields("long", "safe", video_75_completion="Third-Quartile Views (Video)"),
    *fields(total_conversions="Total Conversions"),
]

DV360_YOUTUBE = [
    *fields(advertiser_currency="Advertiser Currency"),
    *fields("long", "safe", clicks="Clicks", video_completion="Complete Views (Video)"),
    *fields("iso_text:year_first_slash", date="Date"),
    *fields("long", "safe", video_25_completion="First-Quartile Views (Video)", impressions="Impressions"),
    *fields(
        campaign_name="Insertion Order",
        campaign_id="Insertion Order ID",
        campaign_status="Insertion Order Status",
        line_item="Line Item",
        line_item_id="Line Item ID",
    ),
    *fields("long", "safe", video_50_completion="Midpoint Views (Video)"),
    *fields("double", "safe", media_cost="Revenue (Adv Currency)"),
    *fields("long", "safe", video_75_completion="Third-Quartile Views (Video)"),
    *fields(youtube_ad="YouTube Ad", youtube_ad_group="YouTube Ad Group", youtube_ad_group_id="YouTube Ad Group ID"),
]

CM360_ATTRIBUTES = [
    *fields(
        placement_id="placementId",
        advertiser="advertiser",
        creative_type="creativeType",
        creative_id="creativeId",
        creative_name="creative",
        advertiser_id="advertiserId",
    ),
    *fields("date:iso", campaign_end_date="campaignEndDate"),
    *fields(campaign_id="campaignId", campaign_name="campaign"),
    *fields("date:iso", campaign_start_date="campaignStartDate"),
    *fields(click_through_url="clickThroughUrl"),
    *fields("date:iso", date="date"),
    *fields(placement_cost_structure="placementCostStructure"),
    *fields("date:iso", placement_end_date="placementEndDate"),
    *fields(
        placement="placement",
        package_roadblock_id="packageRoadblockId",
        package_roadblock="packageRoadblock",
        placement_size="placementSize",
    ),
    *fields("date:iso", placement_start_date="placementStartDate"),
    *fields(placement_strategy="placementStrategy", site_keyname="siteKeyname"),
]
CM360_METRICS = fields("long", clicks="clicks", impressions="impressions")
CM360_SITE = fields(site_name="site")

# The Trade Desk: 82 columns, 48 of them conversions (6 tags x 4 kinds x count and revenue).
TTD_CONVERSION_TAGS = ["01", "02", "03", "04", "05", "06"]
TTD_CONVERSION_KINDS = ["Click Conversion", "Conversion Touch", "View Through Conversion", "Time Weighted Decay Conversion"]


def _conversions() -> list[Field]:
    found = []
    for tag in TTD_CONVERSION_TAGS:
        for kind in TTD_CONVERSION_KINDS:
            stem = kind.lower().replace(" ", "_")
            found.append(Field(f"{tag} - {kind}", f"{stem}_{tag}", "long"))
            found.append(Field(f"{tag} - {kind} Revenue", f"{stem}_revenue_{tag}", "double"))
    return found


TTD_STANDARD = [
    *fields("iso_text:day_first_slash", date="Date"),
    *fields(
        partner_id="Partner ID",
        advertiser_id="Advertiser ID",
        campaign_id="Campaign ID",
        ad_group_id="Ad Group ID",
        ad_format="Ad Format",
        creative_id="Creative ID",
    ),
    *fields("double", frequency="Frequency"),
    *fields(
        advertiser="Advertiser",
        campaign_name="Campaign",
        ad_group="Ad Group",
        advertiser_currency_code="Advertiser Currency Code",
        partner_currency_code="Partner Currency Code",
        creative="Creative",
        deal_id="Deal ID",
        ad_server_name="Ad Server Name",
        ad_server_creative_placement_id="Ad Server Creative Placement ID",
    ),
    *fields("long", bids="Bids"),
    *fields(
        "decimal_comma",
        total_bid_amount_adv_currency="Total Bid Amount (Adv Currency)",
        total_bid_amount_partner_currency="Total Bid Amount (Partner Currency)",
    ),
    *fields("long", impressions="Impressions", clicks="Clicks"),
    *fields(
        "decimal_comma",
        ttd_cost_adv_currency="TTD Cost (Adv Currency)",
        ttd_cost_partner_currency="TTD Cost (Partner Currency)",
        partner_cost_adv_currency="Partner Cost (Adv Currency)",
        partner_cost_partner_currency="Partner Cost (Partner Currency)",
        advertiser_cost_adv_currency="Advertiser Cost (Adv Currency)",
        advertiser_cost_partner_currency="Advertiser Cost (Partner Currency)",
        player_25_complete="Player 25% Complete",
        player_50_complete="Player 50% Complete",
        player_75_complete="Player 75% Complete",
        player_100_complete="Player 100% Complete",
    ),
    *fields("long", video_views="Player Views", player_starts="Player Starts"),
    *_conversions(),
]

TIKTOK_ADS = fields(
    ad_id="ad_id",
    ad_name="ad_name",
    ad_text="ad_text",
    campaign_name="campaign_name",
    adgroup_name="adgroup_name",
)
TIKTOK_BASIC = [
    *fields("long", ad_id="ad_id"),
    *fields("double", media_cost="spend"),
    *fields("long", impressions="impressions", clicks="clicks"),
    *fields(date="stat_time_day"),
]
TIKTOK_VIDEO = [
    *fields("long", ad_id="ad_id"),
    *fields(
        "long",
        video_25_completion="video_views_p25",
        video_50_completion="video_views_p50",
        video_75_completion="video_views_p75",
        video_100_completion="video_views_p100",
        video_play="video_play_actions",
        video_view="video_watched_2s",
    ),
    *fields(date="stat_time_day"),
]

HIVESTACK_REPORT = [
    *fields(date="datetime", campaign_name="campaign"),
    *fields("long", campaign_id="campaign_id"),
    *fields(city="city", creative_name="creative", line_item="line_item"),
    *fields("long", line_item_id="line_item_id"),
    *fields("percent", concentration="concentration"),
    *fields("double", impressions="impressions"),
    *fields("long", plays="plays"),
    *fields("double", progress="progress", media_cost="spend"),
]

GA4_GOAL = [
    *fields("date:compact", date="date"),
    *fields(
        sessionSourceMediumraw="sessionSourceMedium",
        sessionCampaignName="sessionCampaignName",
        sessionManualAdContent="sessionManualAdContent",
        eventName="eventName",
    ),
    *fields("long", eventCount="eventCount"),
    *fields(
        eventValue="eventValue",
        report_start_date="report_start_date",
        report_end_date="report_end_date",
    ),
]
