from ripecast.functions.aggregates import safe_corr, uplift
from ripecast.functions.scalars import (
    base_price,
    by_family,
    clean_family,
    clip_units,
    discount_ladder,
    effective_price,
    expiry_bucket,
    hash_unit,
    log_units,
    money_round,
    parse_bool,
    perishable_flag,
    shard_of,
    shelf_life,
    split_label,
    stable_hash,
    stock_age,
    time_to_expiry,
)

__all__ = [
    "base_price",
    "by_family",
    "clean_family",
    "clip_units",
    "discount_ladder",
    "effective_price",
    "expiry_bucket",
    "hash_unit",
    "log_units",
    "money_round",
    "parse_bool",
    "perishable_flag",
    "safe_corr",
    "shard_of",
    "shelf_life",
    "split_label",
    "stable_hash",
    "stock_age",
    "time_to_expiry",
    "uplift",
]
