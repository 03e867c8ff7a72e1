"""Replies redirected to a free mail service of another domain."""

from pyspark.sql import functions as F

from .base import REPLY_DOMAIN, REPLY_TO, SENDER, SENDER_DOMAIN, Rule, threat


def detect(config):
    # The header is taken as written: a display name spoils the domain and thus the match.
    sender, reply_to, domain = F.col(SENDER), F.col(REPLY_TO), F.col(REPLY_DOMAIN)
    redirected = ((reply_to != "") & (reply_to != sender)
                  & domain.isin(*config.freemail_domains) & (domain != F.col(SENDER_DOMAIN)))
    return threat(redirected, "REPLY_TO_MISMATCH", sender, reply_to)


RULE = Rule("reply_to", ("REPLY_TO_MISMATCH",), detect)
