"""Ad groups that no audience is attached to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.operators.joins import star_join

# The text of an unset audience, the vendor reported on, the advertiser left out.
UNSET_AUDIENCE = "null"
VENDOR_ID = 2
EXCLUDED_ADVERTISER = 8583


def unassigned_ad_groups(
    ad_groups: DataFrame,
    campaigns: DataFrame,
    advertisers: DataFrame,
    *,
    vendor_id: int = VENDOR_ID,
    excluded_advertiser: int = EXCLUDED_ADVERTISER,
) -> DataFrame:
    """``AdGroupId, AdGroupName, CampaignId, CampaignName, AdvertiserId, AdvertiserName``.

    Each filter is on its own input, ahead of the joins, so it reaches the scan.
    """
    unset = ad_groups.where(F.col("AudienceId") == UNSET_AUDIENCE)
    wanted = campaigns.where(F.col("VendorId") == vendor_id).select("CampaignId", "CampaignName")
    shown = advertisers.where(F.col("AdvertiserId") != excluded_advertiser)
    return star_join(unset, (wanted, "CampaignId"), (shown, "AdvertiserId")).select(
        "AdGroupId", "AdGroupName", "CampaignId", "CampaignName", "AdvertiserId", "AdvertiserName"
    )
