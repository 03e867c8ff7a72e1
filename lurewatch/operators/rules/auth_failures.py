"""At least two failed sender authentications."""

from pyspark.sql import functions as F

from ... import fixed_values as V
from .base import AUTH_RESULTS, SPF, Rule, threat


def failures():
    """The checks with their outcome, in the order SPF, DKIM, DMARC."""
    spf, results = F.col(SPF), F.col(AUTH_RESULTS)
    return (("spf", spf.contains(V.SPF_FAIL_MARK)),
            ("dkim", results.contains(V.DKIM_FAIL_MARK)),
            ("dmarc", results.contains(V.DMARC_FAIL_MARK)))


def detect(config):
    checks = failures()
    failed = sum((hit.cast("int") for _, hit in checks), F.lit(0))
    # concat_ws skips NULLs, so no array has to be built and filtered.
    names = F.concat_ws(", ", *[F.when(hit, V.AUTH_FAILURE_NAMES[k]) for k, hit in checks])
    return threat(failed >= V.MIN_AUTH_FAILURES, "AUTH_FAILURES", names)


RULE = Rule("auth_failures", ("AUTH_FAILURES",), detect)
