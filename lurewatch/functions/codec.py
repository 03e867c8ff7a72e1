"""Ids and JSON forms of the nested columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEADERS, NAMES, THREATS
from .text import _col


def derived_id(kind, *columns) -> Column:
    """Reproducible id: a retry or a re-delivery of the same row gets the same one."""
    keyed = F.struct(F.lit(kind).alias("kind"),
                     *[_col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)])
    return F.sha2(F.to_json(keyed, {"ignoreNullFields": "false"}), 256)


def encode_json(c) -> Column:
    """JSON text; a NULL collection is written as ``null``."""
    return F.coalesce(F.to_json(_col(c)), F.lit("null"))


def decode_names(c) -> Column:
    return F.from_json(_col(c), NAMES)


def decode_headers(c) -> Column:
    return F.from_json(_col(c), HEADERS)


def decode_threats(c) -> Column:
    return F.from_json(_col(c), THREATS)
