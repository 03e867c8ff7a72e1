"""Tenants, users and mail derived by Spark from the generated tables.

Grain of the mail: one message per order, addressed to the order's customer, with the text of
a document as its body.  The generated texts hold almost no fraud vocabulary, so subjects,
senders, headers and attachments are planted by key.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import or_empty
from . import planted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _attachments(index):
    lists = [F.lit(None).cast("array<string>") if v is None
             else F.array(*[F.lit(n) for n in v]).cast("array<string>")
             for v in planted.ATTACHMENTS]
    return F.get(F.array(*lists), index.cast("int"))


def tenants(spark, sf_dir) -> DataFrame:
    """One tenant per nation; even keys use the first provider, odd keys the second."""
    nation = table(spark, sf_dir, "nation")
    created = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("tenant_id"), F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, V.PROVIDERS[0]).otherwise(V.PROVIDERS[1]).alias("provider"),
        F.lit("active").alias("status"), created.alias("created_at"), created.alias("updated_at"))


def users(spark, sf_dir) -> DataFrame:
    """One user per customer."""
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.select(
        key.cast("string").alias("user_id"), F.col("c_nationkey").cast("string").alias("tenant_id"),
        F.concat(F.lit("u-"), key.cast("string")).alias("provider_user_id"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@company.com")).alias("email"),
        F.col("c_name").alias("display_name"), _pick(planted.ROLES, key % 13).alias("role"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"))


def mail_of(orders: DataFrame, customer: DataFrame, documents: DataFrame,
            body_characters=None, by_text=False) -> DataFrame:
    """Messages of the given orders (also of a stream of orders).

    ``body_characters`` cuts the body, as a provider's preview does; default is the whole text.  ``by_text`` puts
    messages with the same document beside each other, where files pack them.
    """
    k = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    size = documents.agg(F.count("*").alias("n")).scalar()
    text = documents.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_body"))
    names = _attachments(F.expr("o_orderkey div 5 % 17"))
    pairs = F.array(*[
        F.when(v.isNotNull(), F.struct(F.lit(h).alias("key"), v.alias("value")))
        for h, v in ((V.SPF_HEADER, _pick(planted.SPF, F.expr("o_orderkey div 3 % 5"))),
                     (V.AUTH_HEADER, _pick(planted.AUTH, F.expr("o_orderkey div 2 % 7"))),
                     (V.REPLY_TO_HEADER, _pick(planted.REPLY, F.expr("o_orderkey div 17 % 11"))))])
    body = F.col("_body") if body_characters is None else F.substring("_body", 1, body_characters)
    rows = (orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("_doc", k % size))
    if by_text:   # after the join with the customers, which may order the rows by theirs
        rows = rows.repartition(orders.sparkSession.sparkContext.defaultParallelism, "_doc").sortWithinPartitions("_doc")
    return (rows.join(text, "_doc")
            .select(
                k.cast("string").alias("email_id"), F.col("c_nationkey").cast("string").alias("tenant_id"),
                cust.alias("user_id"),
                F.concat(F.lit("msg-"), k.cast("string")).alias("provider_message_id"),
                _pick(planted.PHRASES, F.expr("o_orderkey div 7 % 12")).alias("subject"),
                _pick(planted.SENDERS, k % 13).alias("sender_email"),
                _pick(planted.NAMES, F.expr("o_orderkey div 13 % 7")).alias("sender_name"),
                F.when(k % 19 == 0, F.concat(F.lit("ghost"), k.cast("string"), F.lit("@company.com")))
                .otherwise(F.concat(F.lit("user"), cust, F.lit("@company.com"))).alias("recipient_email"),
                F.col("o_orderdate").alias("received_at"),
                (names.isNotNull() & (F.coalesce(F.size(names), F.lit(0)) > 0) & (k % 23 != 0)).alias("has_attachments"),
                names.alias("attachment_names"), body.alias("body_preview"),
                F.map_from_entries(F.array_compact(pairs)).alias("headers"),
                F.col("o_orderdate").alias("ingested_at"),
                F.when(k % 4 == 0, F.col("o_orderdate") + F.expr("interval 1 hour")).alias("processed_at"),
                F.col("_doc").alias("doc_id")))


def emails(spark, sf_dir, body_characters=None, by_text=False, tenants=None) -> DataFrame:
    """The mail of all orders; ``by_text`` puts messages with the same document beside each other, where files pack them.

    With ``tenants`` the mail joined with these, found before the texts are met.
    """
    # A message is far wider than the order it is derived from: spread the orders first.
    orders, documents = table(spark, sf_dir, "orders"), table(spark, sf_dir, "documents")
    if not by_text:
        orders = orders.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    customer = table(spark, sf_dir, "customer")
    if tenants is not None:
        customer = customer.join(tenants.select("tenant_id"), F.col("c_nationkey").cast("string") == F.col("tenant_id"))
    return mail_of(orders, customer, documents, body_characters, by_text)


def deliveries(mail: DataFrame) -> DataFrame:
    """The mail plus a second delivery, a day later and in capitals, of every tenth message."""
    # Both from one row: the texts are joined once.
    times = F.when(F.col("email_id").cast("bigint") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = F.col("_again") == 1
    return (mail.withColumn("_again", F.explode(times))
            .withColumn("subject", F.when(again, F.upper("subject")).otherwise(F.col("subject")))
            .withColumn("ingested_at", F.when(again, F.col("ingested_at") + F.expr("interval 1 day")).otherwise(F.col("ingested_at")))
            .drop("_again"))


def user_deliveries(people: DataFrame) -> DataFrame:
    """The users plus a later delivery of every tenth with the next role and a new id."""
    key = F.col("user_id").cast("bigint")
    again = (people.filter(key % 10 == 0)
             .withColumn("role", _pick(planted.ROLES, (key + 1) % 13))
             .withColumn("user_id", F.concat(F.lit("new-"), F.col("user_id")))
             .withColumn("created_at", F.col("created_at") + F.expr("interval 1 day")))
    return people.unionByName(again)


def landed_messages(mail: DataFrame, provider: str) -> DataFrame:
    """The export of one provider in its own shape."""
    out = mail.withColumn("provider_user_id", F.concat(F.lit("u-"), F.col("user_id")))
    if provider == "google":
        sender = F.col("sender_email")
        quoted = F.concat(F.lit('"'), F.col("sender_name"), F.lit('" <'), sender, F.lit(">"))
        plain = F.concat(F.col("sender_name"), F.lit(" <"), sender, F.lit(">"))
        kind = F.col("email_id").cast("bigint") % 3
        out = out.withColumn("from_header", F.when(kind == 0, sender).when(kind == 1, plain)
                             .otherwise(quoted)).drop("sender_email")
    return out.drop("email_id", "user_id", "processed_at", "doc_id")


def mentioned_addresses(spark, sf_dir) -> DataFrame:
    """Address-like strings in the documents and the planted senders of the mail."""
    found = (table(spark, sf_dir, "documents")
             .select(F.explode(F.expr(r"regexp_extract_all(text, '[^ \\t\\r\\n<>]+@[^ \\t\\r\\n<>]+', 0)")).alias("address")))
    senders = emails(spark, sf_dir).select(or_empty("sender_email").alias("address"))
    return found.unionByName(senders)


def hosts(spark, sf_dir) -> DataFrame:
    """Distinct hosts of the crawled pages with the first page of each."""
    return (table(spark, sf_dir, "pages")
            .select("page_id", F.regexp_extract("url", "https?://([^/]+)", 1).alias("domain"))
            .filter("domain != ''").groupBy("domain").agg(F.min("page_id").alias("pos")))


def dirty_tenants(spark, sf_dir) -> DataFrame:
    """Every seventh tenant has a provider nobody supports."""
    return tenants(spark, sf_dir).withColumn("provider", F.when(
        F.col("tenant_id").cast("int") % 7 == 0, "carrier").otherwise(F.col("provider")))


def dirty_mail(mail: DataFrame) -> DataFrame:
    """Mail with a missing sender, an overlong name or an unknown tenant here and there."""
    k = F.col("email_id").cast("bigint")
    return (mail.withColumn("sender_email", F.when(k % 11 != 0, F.col("sender_email")))
            .withColumn("sender_name", F.when(k % 13 == 0, F.rpad(F.col("sender_name"), 101, "x"))
                        .otherwise(F.col("sender_name")))
            .withColumn("tenant_id", F.when(k % 17 == 0, "nowhere").otherwise(F.col("tenant_id"))))


def shared_mailboxes(people: DataFrame) -> DataFrame:
    """The users plus, for every third, a younger user with the same address and another role."""
    key = F.col("user_id").cast("bigint")
    twins = (people.filter(key % 3 == 0)
             .withColumn("user_id", F.concat(F.lit("twin-"), F.col("user_id")))
             .withColumn("provider_user_id", F.concat(F.lit("t-"), F.col("provider_user_id")))
             .withColumn("role", F.lit("CEO"))
             .withColumn("created_at", F.col("created_at") + F.expr("interval 1 day")))
    return people.unionByName(twins)


def tenant_rules(spark, sf_dir) -> DataFrame:
    """Two settings per tenant: one rule switched by region, one weight by region."""
    nation = table(spark, sf_dir, "nation")
    tenant, region = F.col("n_nationkey").cast("string").alias("tenant_id"), F.col("n_regionkey")
    switch = nation.select(tenant, F.lit("display_name").alias("rule_id"),
                           (region % 2 == 0).alias("enabled"), F.lit(None).cast("double").alias("weight"))
    weight = nation.select(tenant, F.lit("auth_failures").alias("rule_id"), F.lit(True).alias("enabled"),
                           (region * 0.25).cast("double").alias("weight"))
    return switch.unionByName(weight)


def reviews(spark, sf_dir, mail: DataFrame) -> DataFrame:
    """A review per message whose document has a label; toxic counts as confirmed fraud."""
    labels = table(spark, sf_dir, "labels")
    return (mail.select("email_id", "doc_id").join(labels, "doc_id")
            .select("email_id", (F.col("toxic") == 1).alias("confirmed")))
