"""Mail address handling."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _col, or_empty, simple_lower

_ATOM_CHARS = r"A-Za-z0-9!#$%&'*+/=?^_`{|}~\-\x{80}-\x{10FFFF}"
_DOT_ATOM = rf"[{_ATOM_CHARS}]+(?:\.[{_ATOM_CHARS}]+)*"
_ADDRESS = rf"{_DOT_ATOM}@{_DOT_ATOM}"
_BARE = rf"^[ \t]*({_ADDRESS})[ \t]*\z"
_BRACKETED = rf"<[ \t]*({_ADDRESS})[ \t]*>[ \t]*\z"
_FROM_BRACKET = r"<[^<]*\z"
_QUOTED = r'"[^"\\]*(?:\\.[^"\\]*)*"'
_PHRASE = rf"\A[{_ATOM_CHARS}. \t]*\z"


def domain_of_lowered(address) -> Column:
    """Part after ``@`` of a lower-cased address, or '' unless there is exactly one ``@``."""
    address = _col(address)
    ats = F.length(address) - F.length(F.replace(address, F.lit("@"), F.lit("")))
    return F.when(ats == 1, F.substring_index(address, "@", -1)).otherwise(F.lit(""))


def domain_of(address) -> Column:
    """Lower-cased part after ``@``, or '' unless there is exactly one ``@``."""
    return domain_of_lowered(simple_lower(or_empty(address)))


def is_internal(domain, internal_domains=V.INTERNAL_DOMAINS) -> Column:
    """Exact membership; subdomains and '' are external."""
    return _col(domain).isin(*internal_domains) if internal_domains else F.lit(False)


def address_of(header) -> Column:
    """The address in ``Name <address>`` or a bare address; the input where neither fits.

    The name may hold plain words and quoted strings.  Comments and groups are not parsed.
    """
    header = _col(header)
    bracketed = F.regexp_extract(header, _BRACKETED, 1)
    name = F.regexp_replace(F.regexp_replace(header, _FROM_BRACKET, ""), _QUOTED, "")
    bare = F.regexp_extract(header, _BARE, 1)
    return (F.when((bracketed != "") & name.rlike(_PHRASE), bracketed)
            .when(bare != "", bare).otherwise(header))


def is_valid_address(address) -> Column:
    """Format check ``local@domain.tld``.  ``\\z``: Java's ``$`` also accepts a final newline."""
    return or_empty(address).rlike(V.ADDRESS_PATTERN + r"\z")
