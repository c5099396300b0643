"""What differs between brands. Account ids and advertiser names come from the deployment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from adloom.operators.unify import MEDIA_CONTRACT, WHOLE_VIDEO_CONTRACT


@dataclass(frozen=True)
class Label:
    name: str
    # Sources of the unified media table, in union order.
    media_sources: tuple[str, ...]
    # Facebook names that are too short: NULL or "Other".
    facebook_short_name: str | None
    hivestack_media_format: bool
    # Column types of the unified media table.
    contract: Mapping[str, str]
    # Deployment settings.
    cm360_advertiser: str | None = None
    display_customer_id: int | None = None
    search_customer_id: int | None = None

    def with_accounts(self, **accounts) -> Label:
        return replace(self, **accounts)

    def account(self, setting: str):
        value = getattr(self, setting)
        if value is None:
            raise ValueError(f"label {self.name!r} needs {setting}; set it with with_accounts()")
        return value


TOURISM = Label(
    name="tourism",
    media_sources=("facebook", "dv360_standard", "cm360_direct_buy", "ttd_transformed", "hivestack", "google_ads_display"),
    facebook_short_name=None,
    hivestack_media_format=True,
    contract=MEDIA_CONTRACT,
)
MOUNTAIN = Label(
    name="mountain",
    media_sources=("facebook", "dv360_standard", "cm360_direct_buy", "tiktok", "hivestack"),
    facebook_short_name="Other",
    hivestack_media_format=False,
    contract=WHOLE_VIDEO_CONTRACT,
)
LABELS = {label.name: label for label in (TOURISM, MOUNTAIN)}
