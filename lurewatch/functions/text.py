"""Lower-casing and word-list tests on message text."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(c) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def is_ascii(c) -> Column:
    c = _col(c)
    return F.octet_length(c) == F.length(c)


def simple_lower(c) -> Column:
    """Lower-case character by character.

    Spark's ``lower`` applies the full mapping, which differs for two characters:
    the dotted capital I grows a combining dot, and a final capital sigma becomes
    the final form.  Both are replaced first, but only in text that has them.
    """
    c = _col(c)
    special = ~is_ascii(c) & (c.contains("İ") | c.contains("Σ"))
    return F.when(special, F.lower(F.translate(c, "İΣ", "iσ"))).otherwise(F.lower(c))


def message_text(subject="subject", body="body_preview") -> Column:
    """Subject and body in one string, not lower-cased yet."""
    return F.concat(or_empty(subject), F.lit(" "), or_empty(body))


def _quoted(value) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _minimal(terms):
    """Terms that hold no other term of the list; the others add nothing to an any-test."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def contains_any(text: str, terms) -> Column:
    """True if any term occurs in the column ``text``, a short one, as a substring (see `lexicon` for long ones)."""
    tests = [f"contains({text}, {_quoted(t)})" for t in _minimal(terms)]
    return F.expr(" OR ".join(tests)) if tests else F.lit(False)


def ends_with_any(c, suffixes) -> Column:
    c = _col(c)
    return reduce(Column.__or__, [c.endswith(s) for s in suffixes], F.lit(False))


def dots(c) -> Column:
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))


def printf(pattern, *args) -> Column:
    """``format_string`` that never yields NULL for a NULL argument."""
    return F.format_string(pattern, *args)


def fixed_point(c, digits) -> Column:
    """Decimal text with ties to even on the exact binary value (``format_string`` rounds up)."""
    return F.replace(F.format_number(_col(c), digits), F.lit(","), F.lit(""))
