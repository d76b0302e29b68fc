"""Scalar column expressions. All of them are built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ripecast import constants as K


def parse_bool(value: Column) -> Column:
    """Yes/no text as a boolean; anything else is NULL."""
    word = F.lower(value.cast("string"))
    return F.when(word.isin(K.TRUE_WORDS), F.lit(True)).when(word.isin(K.FALSE_WORDS), F.lit(False))


def clean_family(value: Column) -> Column:
    """Family name with slashes and spaces as underscores."""
    return F.translate(value.cast("string"), "/ ", "__")


def perishable_flag(value: Column) -> Column:
    """1 is True, 0 is False, anything else is NULL."""
    return F.when(value.isin(0, 1), value == 1)


def clip_units(value: Column) -> Column:
    """Clamp to the accepted unit range. NULL stays NULL: Spark's least and greatest would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(K.UNITS_MIN)), F.lit(K.UNITS_MAX)))


def log_units(clipped: Column) -> Column:
    """Natural log of one plus the clipped units."""
    return F.log1p(clipped)


def stable_hash(*parts: Column, sep: str = "-") -> Column:
    """Non-negative 60-bit hash of the joined text, the same in every engine that has md5."""
    text = F.concat_ws(sep, *[p.cast("string") for p in parts]) if len(parts) > 1 else parts[0].cast("string")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_unit(value: Column) -> Column:
    """Pseudo-random number in [0, 1) that depends on the value only."""
    return (stable_hash(value) % F.lit(K.HASH_SPREAD)) / F.lit(float(K.HASH_SPREAD))


def shard_of(n_shards: int, *parts: Column) -> Column:
    """Shard number of a key."""
    return stable_hash(*parts, sep="|") % F.lit(n_shards)


def money_round(value: Column, digits: int = 2) -> Column:
    """Round half up in decimal arithmetic, so that every engine agrees on the cents."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def base_price(item: Column, low: Column, high: Column) -> Column:
    """List price: the middle of the band, moved a little by the item's own hash."""
    place = F.lit(K.BAND_CENTRE) + (hash_unit(item) - F.lit(0.5)) * F.lit(K.BAND_JITTER)
    return money_round(low + place * (high - low))


def by_family(values: Mapping[str, float], family: Column) -> Column:
    """Look a family up in a small fixed table of numbers; NULL when it is not listed."""
    table = F.expr("map(" + ", ".join(f"'{name}', {value}D" for name, value in values.items()) + ")")
    return F.when(family.isNotNull(), F.try_element_at(table, family))


def shelf_life(family: Column) -> Column:
    """Shelf life in days."""
    days = by_family(K.SHELF_LIFE_DAYS, family).cast("long")
    return F.coalesce(days, F.lit(K.SHELF_LIFE_DEFAULT))


def stock_age(key_hash: Column, life: Column) -> Column:
    """Days since stocking, 0 to the shelf life, derived from the hash of the row's own key."""
    return F.pmod(key_hash, life + F.lit(1))


def time_to_expiry(life: Column, age: Column) -> Column:
    return F.greatest(life - age, F.lit(0))


def discount_ladder(days_left: Column) -> Column:
    """Markdown for the days left."""
    steps = F
    for least_days, markdown in K.MARKDOWN_STEPS:
        steps = steps.when(days_left >= least_days, F.lit(markdown))
    return steps.otherwise(F.lit(K.MARKDOWN_CLEARANCE))


def effective_price(price: Column, discount: Column) -> Column:
    return money_round(price * (F.lit(1.0) - discount))


def expiry_bucket(days_left: Column) -> Column:
    buckets = F
    for most_days, name in K.EXPIRY_BUCKETS:
        buckets = buckets.when(days_left <= most_days, F.lit(name))
    return buckets.otherwise(F.lit(K.EXPIRY_BUCKET_LAST))


def split_label(
    date: Column,
    max_date: str | dt.date = K.SPLIT_MAX_DATE,
    valid_days: int = K.SPLIT_VALID_DAYS,
    test_days: int = K.SPLIT_TEST_DAYS,
) -> Column:
    """Time split. The cut dates are literals, so a filter on the label is a plain date comparison after folding."""
    last = dt.date.fromisoformat(max_date) if isinstance(max_date, str) else max_date
    valid_from, test_from = (F.lit(last - dt.timedelta(days=n)) for n in (valid_days, test_days))
    return F.when(date < valid_from, "train").when(date < test_from, "valid").otherwise("test")
