"""The deployment the probes stand for: the mappings that their SQL twins spell out."""

from __future__ import annotations

from fieldbook.vocabulary import Roles

ROLES = Roles(
    city_codes=(("1", "CHD"), ("2", "BLR"), ("3", "Jaipur"), ("4", "NCR"), ("5", "Hyderabad")),
    city_short=(("Chandigarh", "CHD"), ("Bangalore", "BLR")),
    home_pick_assets=(255, 256),
    diagnostic_assets=(251, 252, 253, 254, 255, 256, 258),
    nudge_tags=(275,),
    amount_tiers=("100", "300", "500", "1000"),
)
CITY_CODES, CITY_SHORT = dict(ROLES.city_codes), dict(ROLES.city_short)
