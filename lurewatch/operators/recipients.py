"""Message to recipient: who is addressed, and which roles matter."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import text
from .keyed import first_per_key, settled
from .rules import role_targeting as rt


def directory(users: DataFrame) -> DataFrame:
    """One user per (tenant, address), so that the lookup never multiplies messages.

    Addresses are not unique among users; the oldest user wins, then the smallest id.
    """
    return first_per_key(users, ("tenant_id", "email"), (F.col("created_at"), F.col("user_id")))


def with_recipient(emails: DataFrame, users: DataFrame) -> DataFrame:
    """Left join on tenant and exact address; unknown recipients keep their message."""
    known = directory(users).select(
        "tenant_id", F.col("email").alias("recipient_email"),
        F.col("user_id").alias("recipient_user_id"), F.col("role").alias("recipient_role"),
        F.col("display_name").alias("recipient_name"))
    return emails.join(known, ["tenant_id", "recipient_email"], "left")


def targeted_people(users: DataFrame, config=DEFAULT) -> DataFrame:
    """Directory entries whose role is in one of the three groups, with the group flags.

    Only these can make the role rule fire, so only these are joined: a small share of the
    directory instead of all of it.  The role is classified once per person, not per message.
    """
    flagged = (directory(users)
               .select("tenant_id", F.col("email").alias("recipient_email"),
                       F.col("role").alias(rt.ROLE))
               .withColumn("_lowered", text.simple_lower(text.or_empty(rt.ROLE)))
               .withColumns(rt.role_groups("_lowered", config)).drop("_lowered"))
    return settled(flagged, [rt.CSUITE, rt.FINANCE, rt.HR]).filter(F.col(rt.CSUITE) | F.col(rt.FINANCE) | F.col(rt.HR))
