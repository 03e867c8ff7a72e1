"""Edit distance on bytes and the look-alike test."""

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _col


def as_bytes(c) -> Column:
    """One character per UTF-8 byte, so that string functions count bytes."""
    c = _col(c)
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def byte_distance(left, right) -> Column:
    """Levenshtein distance over the bytes of both strings."""
    return F.levenshtein(as_bytes(left), as_bytes(right))


def similarity(distance, longest) -> Column:
    """Percentage in double arithmetic."""
    return (F.lit(1.0) - _col(distance).cast("double") / _col(longest).cast("double")) * F.lit(100.0)


def in_window(percent) -> Column:
    percent = _col(percent)
    return (percent > V.LOOKALIKE_ABOVE) & (percent < V.LOOKALIKE_BELOW)


def lengths_allow(left_len, right_len) -> Column:
    """Necessary for similarity above 85 %: the distance is at least the length difference."""
    left_len, right_len = _col(left_len), _col(right_len)
    return 20 * F.abs(left_len - right_len) <= 3 * F.greatest(left_len, right_len)


UNROLLED = 64


def _first_in_list(domain, trusted) -> Column:
    listed = [{"trusted": t, "size": len(t.encode("utf-8"))} for t in trusted if t]
    entries = F.from_json(F.lit(json.dumps(listed)), "array<struct<trusted:string,size:int>>")
    length = F.octet_length(domain)
    close = F.filter(entries, lambda e: (domain != e["trusted"]) & lengths_allow(length, e["size"]))
    measured = F.transform(close, lambda e: F.struct(
        e["trusted"].alias("trusted"),
        similarity(byte_distance(domain, e["trusted"]), F.greatest(length, e["size"])).alias("similarity")))
    return F.get(F.filter(measured, lambda m: in_window(m["similarity"])), F.lit(0))


def first_lookalike(domain, trusted) -> Column:
    """``struct<trusted, similarity>`` of the first listed domain that ``domain`` imitates.

    No join: one expression per entry of a short list, a search in one constant list for a long
    one.  An exact match of one entry does not stop the search.  Most entries end at the length test.
    """
    domain = _col(domain)
    if len(trusted) > UNROLLED:
        return _first_in_list(domain, trusted)
    hits = []
    for entry in trusted:
        size = len(entry.encode("utf-8"))
        if size == 0:
            continue
        longest = F.greatest(F.octet_length(domain), F.lit(size))
        percent = similarity(byte_distance(domain, F.lit(entry)), longest)
        close = ((domain != entry) & lengths_allow(F.octet_length(domain), F.lit(size))
                 & in_window(percent))
        hits.append(F.when(close, F.struct(F.lit(entry).alias("trusted"),
                                           percent.alias("similarity"))))
    none = F.lit(None).cast("struct<trusted:string,similarity:double>")
    return F.coalesce(*hits, none) if hits else none


def trigrams(c) -> Column:
    """Distinct byte trigrams, for the n-gram variant of the look-alike test."""
    b = as_bytes(c)
    last = F.greatest(F.length(b) - 2, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(b, i, F.lit(3))))


def trigram_similarity(left, right) -> Column:
    """Jaccard share of common trigrams."""
    a, b = trigrams(left), trigrams(right)
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
