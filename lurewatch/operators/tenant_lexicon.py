"""Word lists as a table: each tenant's messages are searched for the tenant's own terms."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon, text
from ..session import materialised

AT_A_TIME = 50_000   # distinct terms of one pass over the texts


def counts(emails: DataFrame, terms: DataFrame, at_a_time: int = AT_A_TIME) -> DataFrame:
    """email_id, tenant_id, list, n: how many different terms of each of its tenant's lists a message holds, if any.

    ``terms`` has (tenant_id, list, term).  The distinct terms of all tenants are searched for in one pass per
    ``at_a_time`` of them, so what goes to a task is bounded; a term found then counts for the tenants that list it.
    Terms are compared in lower case; empty ones and NULLs do not count.
    """
    spark = emails.sparkSession
    listed = terms.select("tenant_id", "list", text.simple_lower("term").alias("term")).filter("term <> ''").distinct()
    listed = materialised(listed, "tenant-terms")
    distinct = listed.select("term").distinct()
    slices = max(1, -(-distinct.count() // at_a_time))
    rows = emails.withColumn("_raw", text.message_text()).select(
        "email_id", "tenant_id", text.simple_lower("_raw").alias("_text"))
    found = []
    for i in range(slices):
        own = [r.term for r in distinct.filter(F.pmod(F.xxhash64("term"), F.lit(slices)) == i).collect()]
        if own:
            found.append(rows.select("email_id", "tenant_id", F.explode(lexicon.found(F.col("_text"), own)).alias("term")))
    if not found:
        return spark.createDataFrame([], "email_id string, tenant_id string, list string, n long")
    hits = reduce(DataFrame.unionByName, found).join(listed, ["tenant_id", "term"])
    return hits.groupBy("email_id", "tenant_id", "list").agg(F.count("*").alias("n"))
