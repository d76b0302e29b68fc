"""Exact quantiles of distributed columns, without a sort and at any size.

A sketch brackets each quantile: two of its values, a little below and above the wanted rank, hold about four rows in
``ACCURACY`` between them. Counts then tell exactly how many rows lie below and inside the bracket, so an unlucky sketch
costs another round and never a wrong value. Rounds go on inside the bracket until the wanted value is one of its ends or
at most ``FEW`` rows are left; those are counted by value and the wanted one is picked. Each round reads the rows twice and
shuffles fixed-size states, and ten billion rows take two.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
FEW = 10_000


@dataclass
class _Target:
    """The wanted value is the ``rank``-th of the ``n`` values between ``low`` and ``high``, both left out; None is no bound."""

    rank: int
    n: int
    low: float | None = None
    high: float | None = None
    value: float | None = None


def rank_of(share: float, n: int) -> int:
    """Rank of the first value that at least ``share`` of all values do not exceed."""
    return max(1, math.ceil(Decimal(str(share)) * n))


def quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, float]], accuracy: int = ACCURACY, few: int = FEW) -> dict[str, float | None]:
    """For each name the exact quantile of a column at a share: a value of the column, None where it has none.

    NULLs do not count, and NaN is the largest value.
    """
    names = list(wanted)
    x = {k: wanted[k][0].cast("double") for k in names}
    first = df.agg(*[F.count(x[k]).alias(f"n{i}") for i, k in enumerate(names)]).first()
    targets = {k: _Target(rank_of(wanted[k][1], first[f"n{i}"]), first[f"n{i}"]) for i, k in enumerate(names) if first[f"n{i}"]}
    while True:
        open_ = {k: t for k, t in targets.items() if t.value is None}
        wide = {k: t for k, t in open_.items() if t.n > few}
        if not wide:
            break
        _narrow(df, x, wide, accuracy)
    if open_:
        _pick(df, x, open_)
    return {k: targets[k].value if k in targets else None for k in names}


def _inside(x: Column, t: _Target) -> Column:
    above = x.isNotNull() if t.low is None else x > F.lit(t.low)
    return above if t.high is None else above & (x < F.lit(t.high))


def _narrow(df: DataFrame, x: Mapping[str, Column], targets: Mapping[str, _Target], accuracy: int) -> None:
    """One round. The bracket's own two values leave the range in any case, so every round gets closer."""
    shares = {k: [min(max(t.rank / t.n + d, 0.0), 1.0) for d in (-2.0 / accuracy, 2.0 / accuracy)] for k, t in targets.items()}
    cuts = df.agg(*[F.percentile_approx(F.when(_inside(x[k], t), x[k]), shares[k], accuracy).alias(f"c{i}") for i, (k, t) in enumerate(targets.items())]).first()
    counted = []
    for i, (k, t) in enumerate(targets.items()):
        a, b = (F.lit(v) for v in cuts[f"c{i}"])
        for name, where in (("less", x[k] < a), ("first", x[k] == a), ("middle", (x[k] > a) & (x[k] < b)), ("last", (x[k] == b) & (a < b))):
            counted.append(F.count_if(_inside(x[k], t) & where).alias(f"{name}{i}"))
    counts = df.agg(*counted).first()
    for i, t in enumerate(targets.values()):
        a, b = cuts[f"c{i}"]
        parts = [(t.low, a), a, (a, b), b, (b, t.high)]
        sizes = [counts[f"{name}{i}"] for name in ("less", "first", "middle", "last")]
        for part, size in zip(parts, [*sizes, t.n - sum(sizes)]):
            if t.rank <= size:
                break
            t.rank -= size
        if isinstance(part, tuple):
            (t.low, t.high), t.n = part, size
        else:
            t.value = part


def _pick(df: DataFrame, x: Mapping[str, Column], targets: Mapping[str, _Target]) -> None:
    """At most ``FEW`` rows a target are left; they are counted by value."""
    names = list(targets)
    left = F.array(*[F.when(_inside(x[k], targets[k]), F.struct(F.lit(i).alias("at"), x[k].alias("value"))) for i, k in enumerate(names)])
    rows = df.select(F.explode(F.filter(left, lambda v: v.isNotNull())).alias("v")).select("v.*")
    seen = dict.fromkeys(names, 0)
    for r in rows.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("at", "value").collect():
        k = names[r["at"]]
        seen[k] += r["n"]
        if targets[k].value is None and seen[k] >= targets[k].rank:
            targets[k].value = r["value"]
