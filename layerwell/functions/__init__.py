from layerwell.functions.columns import (
    age_years,
    band,
    clean_phone,
    day_shift,
    non_blank,
    non_negative_money,
    recode,
    register_functions,
)
from layerwell.functions.geo import ip_number, ip_region, most_specific

__all__ = [
    "age_years",
    "band",
    "clean_phone",
    "day_shift",
    "ip_number",
    "ip_region",
    "most_specific",
    "non_blank",
    "non_negative_money",
    "recode",
    "register_functions",
]
