"""An executive title in the display name of an external sender."""

from pyspark.sql import functions as F

from ...functions import text
from .base import EXTERNAL, SENDER_DOMAIN, SENDER_NAME, Rule, threat


def detect(config):
    name = text.or_empty("sender_name")
    titled = text.contains_any(SENDER_NAME, config.exec_titles)
    return threat(F.col(EXTERNAL) & titled, "DISPLAY_NAME_MISMATCH", name, F.col(SENDER_DOMAIN))


RULE = Rule("display_name", ("DISPLAY_NAME_MISMATCH",), detect)
