"""Risk score and level."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _col


def risk_level(score) -> Column:
    """Level of an unrounded score."""
    score = _col(score)
    branches = reduce(lambda acc, lv: acc.when(score >= lv[1], lv[0]), V.RISK_LEVELS[1:],
                      F.when(score >= V.RISK_LEVELS[0][1], V.RISK_LEVELS[0][0]))
    return branches.otherwise(V.NO_RISK)


def weight_of(type_, weights=None, types=None) -> Column:
    """Weight of a detection type; missing or zero counts as the default.

    ``types`` names the types that can occur, which keeps the expression short.
    """
    weights = V.WEIGHTS if weights is None else weights
    type_ = _col(type_)
    known = [(t, w) for t, w in weights.items() if w and (types is None or t in types)]
    if not known:
        return F.lit(V.DEFAULT_WEIGHT)
    if types is not None and len(types) == 1:
        return F.lit(float(known[0][1]))
    chain = reduce(lambda acc, tw: acc.when(type_ == tw[0], F.lit(float(tw[1]))), known[1:],
                   F.when(type_ == known[0][0], F.lit(float(known[0][1]))))
    return chain.otherwise(F.lit(V.DEFAULT_WEIGHT))


def capped(score) -> Column:
    """Between 0 and 1; no detection gives 0."""
    return F.least(F.greatest(F.coalesce(_col(score), F.lit(0.0)), F.lit(0.0)), F.lit(V.MAX_SCORE))


def weighted_maximum(threats, weights=None) -> Column:
    """Score of an array of threats, computed within the row."""
    scored = F.transform(_col(threats),
                         lambda t: t["confidence"] * weight_of(t["type"], weights))
    return capped(F.array_max(scored))


def stored_score(score) -> Column:
    """Four decimals, as stored.  Take the level before this."""
    return _col(score).cast("decimal(5,4)")
