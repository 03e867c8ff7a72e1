"""The registered queries: every operator over the whole derived tables."""

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..config import DEFAULT
from ..functions import address, codec, lexicon, similarity, text
from ..operators import (detection, extensions, lookalikes, merge, purge, recipients, reports,
                         tenant_lexicon, tuning, validation)
from ..operators.keyed import settled
from ..operators.rules import role_targeting
from ..plans import jobs
from ..session import removed, save, shared_dir
from ..sources import landing, tables
from ..streaming import jobs as streams
from . import derive

AS_OF = "2001-08-02 00:00:00"
OWN_DOMAINS = ("outer-mail.org", "company.com")
LONG_LIST = (*(f"host{i}.example.org" for i in range(200)), *V.TRUSTED_DOMAINS)
TENANT_TERMS = {"money": ("invoice", "Payment", "wire", "account"), "haste": ("urgent", "immediately", "today", "and")}
WEIGHTS_B = {**V.WEIGHTS, "BEC_HR_PAYROLL_SCAM": 1.4, "URGENCY_FINANCIAL_LANGUAGE": 0.5}


def _b(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _s(c):
    return F.col(c).cast("string").alias(c)


def _d(c, digits=6):
    return F.round(F.col(c).cast("double"), digits).alias(c)


def _analyses(spark, d, config=DEFAULT, **options):
    return detection.analyse(derive.emails(spark, d), derive.users(spark, d), config, **options)


def _rule(rule_id):
    def query(spark: SparkSession, d: str) -> DataFrame:
        config = dataclasses.replace(DEFAULT, rules=(rule_id,))
        rows = detection.rule_columns(derive.emails(spark, d), derive.users(spark, d), config)
        c = F.col(f"_threat_{rule_id}")
        return rows.filter(c.isNotNull()).select(
            "email_id", c["type"].alias("type"), F.round(c["confidence"], 6).alias("confidence"),
            c["evidence"].alias("evidence"))
    return query


def risk_score(spark, d):
    return _analyses(spark, d).select(
        "email_id", "tenant_id", _d("risk_score", 4), "risk_level",
        _b(F.size("detected_threats")).alias("threats"),
        F.array_join(F.transform("detected_threats", lambda t: t["type"]), ",").alias("types"))


def risk_score_long(spark, d):
    threats = detection.threats_long(_analyses(spark, d))
    weights = spark.createDataFrame(list(V.WEIGHTS.items()), "type string, weight double")
    return detection.score_long(derive.emails(spark, d), threats, weights).select(
        "email_id", _d("risk_value"), "risk_level")


def threats_by_type(spark, d):
    threats = detection.threats_long(_analyses(spark, d), "analyzed_at")
    return extensions.threats_by_period(threats).select(
        "type", _s("period"), "detections", _d("mean_confidence"))


def tenant_rule_settings(spark, d):
    rows = detection.rule_columns(derive.emails(spark, d), derive.users(spark, d))
    return detection.apply_tenant_rules(rows, derive.tenant_rules(spark, d)).select(
        "email_id", _d("risk_value"), "risk_level", _b(F.size("detected_threats")).alias("threats"))


def term_presence(spark, d):
    terms = sorted({*V.URGENCY_TERMS, *V.FINANCIAL_TERMS, *V.AUTHORITY_TERMS, *V.ROLE_URGENCY_TERMS,
                    *V.ROLE_PAYMENT_TERMS, *V.ROLE_PAYROLL_TERMS})
    rows = derive.emails(spark, d).select(text.message_text().alias("raw")).select(
        text.simple_lower("raw").alias("t"))
    hits = settled(rows.select(lexicon.found(F.col("t"), terms).alias("h")), ["h"]).select(F.explode("h").alias("term"))
    return hits.groupBy("term").agg(F.count("*").alias("messages"))


def role_groups(spark, d):
    flags = role_targeting.role_groups("_lowered", DEFAULT)
    people = derive.users(spark, d).withColumn("_lowered", text.simple_lower(text.or_empty("role")))
    return (people.withColumns(flags).groupBy("role").agg(
        F.count("*").alias("users"), *[_b(F.max(F.col(c).cast("int"))).alias(n) for c, n in (
            (role_targeting.CSUITE, "csuite"), (role_targeting.FINANCE, "finance"),
            (role_targeting.HR, "hr"))]))


def auth_header_search(spark, d):
    found = extensions.header_search(derive.emails(spark, d), V.AUTH_HEADER, V.DMARC_FAIL_MARK)
    return found.select("email_id", "tenant_id", F.col("headers")[V.AUTH_HEADER].alias("value"))


def header_values(spark, d):
    return (extensions.headers_table(derive.emails(spark, d)).groupBy("header", "value")
            .agg(F.count("*").alias("messages")))


def recipients_table(spark, d):
    return extensions.recipients_table(derive.emails(spark, d))


def attachments_table(spark, d):
    return extensions.attachments_table(derive.emails(spark, d)).select(
        "email_id", _b("pos").alias("pos"), "filename", "extension")


def repeated_attachments(spark, d):
    return extensions.repeated_attachments(extensions.attachments_table(derive.emails(spark, d)))


def _rejects(spark, d):
    known = ("tenant_id", derive.tenants(spark, d), "tenant_id")
    mail = validation.check(derive.dirty_mail(derive.emails(spark, d)), "emails",
                            [known, ("user_id", derive.users(spark, d), "user_id")])
    bad_tenants = validation.check(derive.dirty_tenants(spark, d), "tenants")
    return (validation.rejected(mail, "emails", "email_id")
            .unionByName(validation.rejected(bad_tenants, "tenants", "tenant_id")))


def orphan_messages(spark, d):
    mail = derive.dirty_mail(derive.emails(spark, d))
    return validation.orphans(mail, derive.tenants(spark, d), "tenant_id").select(
        "email_id", "tenant_id", "user_id")


def dead_letters(spark, d):
    rejects = _rejects(spark, d)
    earlier = rejects.filter(F.col("table") == "emails")
    return extensions.dead_letters(rejects, earlier.unionByName(earlier))


def _landed(spark, d):
    mail, t = derive.emails(spark, d), derive.tenants(spark, d).select("tenant_id", "provider")
    by = mail.join(t, "tenant_id")
    return {p: derive.landed_messages(by.filter(F.col("provider") == p), p).drop("provider")
            for p in V.PROVIDERS}


def provider_union(spark, d):
    return landing.unify(_landed(spark, d), landing.stamp_messages).select(
        "email_id", "tenant_id", "user_id", "provider_message_id", "sender_email")


def dedup_first_wins(spark, d):
    delivered = derive.deliveries(derive.emails(spark, d))
    return merge.insert_if_absent(delivered, None).select(
        "email_id", "tenant_id", "provider_message_id", "subject", _s("ingested_at"))


def insert_absent_only(spark, d):
    mail = derive.emails(spark, d)
    stored = mail.filter(F.col("processed_at").isNotNull())
    return merge.insert_if_absent(derive.deliveries(mail), stored).select("email_id", "subject")


def ingest_counts(spark, d):
    delivered = derive.deliveries(derive.emails(spark, d))
    return reports.ingest_counts(delivered, merge.insert_if_absent(delivered, None), "tenant_id")


def user_upsert(spark, d):
    stored = derive.users(spark, d)
    return merge.upsert_users(stored, derive.user_deliveries(stored)).select(
        "user_id", "tenant_id", "provider_user_id", "email", "role", _s("created_at"))


def tenant_seed(spark, d):
    incoming, nation = derive.tenants(spark, d), derive.table(spark, d, "nation")
    stored = nation.filter("n_regionkey = 1").select(F.col("n_nationkey").cast("string").alias("tenant_id"))
    new, refused = merge.insert_new(incoming, stored)
    return (new.withColumn("outcome", F.lit("inserted"))
            .unionByName(refused.withColumn("outcome", F.lit("refused")))
            .select("tenant_id", "provider", "outcome"))


def recipient_lookup(spark, d):
    people = derive.shared_mailboxes(derive.users(spark, d))
    return recipients.with_recipient(derive.emails(spark, d), people).select(
        "email_id", "recipient_user_id", "recipient_role")


def unprocessed_batch(spark, d):
    return merge.oldest_unprocessed(derive.emails(spark, d), V.DETECTION_BATCH).select(
        "email_id", "tenant_id", _s("received_at"))


def unprocessed_messages(spark, d):
    mail = derive.emails(spark, d)
    done = mail.filter(F.col("has_attachments")).select("email_id")
    return merge.unprocessed(mail, done).select("email_id", "tenant_id")


def detect_queue(spark, d):
    return jobs.detect_oldest(derive.emails(spark, d), derive.users(spark, d)).select(
        "email_id", _d("risk_score", 4), "risk_level")


def mark_processed(spark, d):
    mail = derive.emails(spark, d)
    done = mail.filter(F.col("has_attachments")).select(
        "email_id", (F.col("received_at") + F.expr("interval 2 hours")).alias("analyzed_at"))
    return merge.mark_processed(mail, done).select("email_id", _s("processed_at"))


def _top(rows):
    return rows.select("tenant_id", "email_id", _d("risk_score", 4), "risk_level", _s("analyzed_at"),
                       _b(F.size("detected_threats")).alias("threats"))


def high_risk_topk(spark, d):
    # The tenant's messages first: only their texts are scanned.
    mail = derive.emails(spark, d).filter("tenant_id = '7'")
    return _top(reports.top_of_tenant(detection.analyse(mail, derive.users(spark, d)), "7", emails=mail))


def high_risk_all_tenants(spark, d):
    return reports.top_of_all_tenants(_analyses(spark, d)).select(
        "tenant_id", _b("rank").alias("rank"), "email_id", _d("risk_score", 4), "risk_level",
        _s("analyzed_at"))


def latest_per_tenant(spark, d):
    return reports.latest_of_tenants(derive.emails(spark, d)).select(
        "tenant_id", _b("rank").alias("rank"), "email_id", _s("received_at"))


def sender_investigation(spark, d):
    return reports.senders(derive.emails(spark, d)).select(
        "tenant_id", "sender_email", "messages", _s("first_seen"), _s("last_seen"), "with_attachments")


def messages_of_sender(spark, d):
    return reports.messages_of_sender(derive.emails(spark, d), "3", "desk@paypol.com").select(
        "email_id", "subject", _s("received_at"))


def mailbox_timeline(spark, d):
    return reports.mailbox(derive.emails(spark, d)).select("user_id", _s("received_at"), "email_id")


def risk_dashboard(spark, d):
    return reports.level_counts(_analyses(spark, d), "tenant_id")


def newest_of_level(spark, d):
    return reports.by_level(_analyses(spark, d), "high").select(
        "email_id", "tenant_id", _s("analyzed_at"))


def tenant_summary(spark, d):
    return reports.tenant_summary(_analyses(spark, d)).select(
        "tenant_id", "messages", "high_risk", "threats", _d("highest"))


def alerts(spark, d):
    return extensions.alerts(_analyses(spark, d), derive.emails(spark, d)).select(
        "email_id", _b("pos").alias("pos"), "type", "evidence", _d("risk_score", 4), "threats",
        "subject", "sender_name", "sender_email", "recipient_email")


def address_validation(spark, d):
    rows = derive.mentioned_addresses(spark, d)
    return validation.address_quality(rows, "address", "address")


def tenant_purge(spark, d):
    mail = derive.emails(spark, d)
    gone = derive.table(spark, d, "nation").filter("n_regionkey = 0").select(
        F.col("n_nationkey").cast("string").alias("tenant_id"))
    closed = derive.table(spark, d, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("user_id"))
    left = purge.purge({"tenants": derive.tenants(spark, d), "users": derive.users(spark, d),
                        "emails": mail, "analyses": _analyses(spark, d)}, gone, closed)
    parts = [left[name].select("tenant_id").withColumn("table", F.lit(name)) for name in left]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.groupBy("table", "tenant_id").agg(F.count("*").alias("rows"))


def tenant_lookup(spark, d):
    return tables.tenant_by_id(derive.tenants(spark, d), "4").select(
        "tenant_id", "name", "provider", "status")


def email_lookup(spark, d):
    return tables.email_by_id(derive.emails(spark, d), "1234").select(
        "email_id", "subject", "sender_email", "recipient_email", "body_preview")


def json_columns(spark, d):
    stored = derive.emails(spark, d).select(
        "email_id", codec.encode_json("attachment_names").alias("names_json"),
        codec.encode_json("headers").alias("headers_json"))
    names = codec.decode_names("names_json")
    return stored.select("email_id", "names_json",
                         _b(F.coalesce(F.size(F.filter(names, lambda n: n != "")), F.lit(0))).alias("names"),
                         codec.decode_headers("headers_json")[V.SPF_HEADER].alias("spf"))


def incremental_sync(spark, d):
    mail = derive.emails(spark, d)
    as_of = derive.table(spark, d, "orders").agg(F.max("o_orderdate")).scalar()
    return mail.filter(F.col("received_at") > landing.look_back(as_of)).select(
        "email_id", "user_id", _s("received_at"))


def sync_per_user(spark, d):
    mail = derive.emails(spark, d)
    stored = mail.filter(F.col("processed_at").isNotNull())
    bound = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return landing.newer_than_stored(mail, stored, bound).select("email_id", "user_id", _s("received_at"))


def lookalike_hosts(spark, d):
    hosts = derive.hosts(spark, d)
    return lookalikes.similar_domains(hosts.select("domain"), hosts).select(
        "domain", _b("pos").alias("pos"), "trusted", _d("similarity"))


def typosquatting_long_list(spark, d):
    hosts = derive.hosts(spark, d)
    listed = lookalikes.trusted_frame(spark, V.TRUSTED_DOMAINS).select(
        (F.col("pos") - 3).cast("bigint").alias("pos"), "domain").unionByName(hosts.select("pos", "domain"))
    config = dataclasses.replace(DEFAULT, rules=("typosquatting",))
    rows = detection.rule_columns(derive.emails(spark, d), None, config, trusted=listed)
    c = F.col("_threat_typosquatting")
    return rows.filter(c.isNotNull()).select("email_id", c["evidence"].alias("evidence"))


def edit_distance(spark, d):
    domains = (derive.emails(spark, d).select(address.domain_of("sender_email").alias("domain"))
               .unionByName(derive.hosts(spark, d).select("domain")).distinct())
    listed = F.explode(F.array(*[F.lit(t) for t in V.TRUSTED_DOMAINS])).alias("trusted")
    longest = F.greatest(F.octet_length("domain"), F.octet_length("trusted"))
    return (domains.select("domain", listed)
            .withColumn("distance", _b(similarity.byte_distance("domain", "trusted")))
            .withColumn("similarity", F.round(similarity.similarity("distance", longest), 6)))


def trigram_lookalikes(spark, d):
    return extensions.trigram_lookalikes(derive.emails(spark, d), at_least=0.3).select(
        "domain", "trusted", "messages", _d("shared"))


def monthly_retention(spark, d):
    filed = purge.with_month(derive.emails(spark, d))
    return (purge.retained(filed, AS_OF, 24).groupBy("received_month")
            .agg(F.count("*").alias("messages")))


def review_precision(spark, d):
    mail = derive.emails(spark, d)
    threats = detection.threats_long(_analyses(spark, d))
    return extensions.precision_by_type(threats, derive.reviews(spark, d, mail)).select(
        "type", "reviewed", "confirmed", _d("precision"))


def review_thresholds(spark, d):
    mail = derive.emails(spark, d)
    return extensions.precision_by_level(_analyses(spark, d), derive.reviews(spark, d, mail)).select(
        "level", _d("bound"), "flagged", "confirmed", "missed")


def rule_versions(spark, d):
    other = dataclasses.replace(DEFAULT, weights=WEIGHTS_B, version="2")
    return extensions.compare_versions(_analyses(spark, d), _analyses(spark, d, other)).select(
        "email_id", "level_a", _d("score_a"), "level_b", _d("score_b"))


def review_curve(spark, d):
    mail = derive.emails(spark, d)
    # Scores as reports show them, so that equal ones are equal in every engine.
    scored = _analyses(spark, d).withColumn("risk_value", F.round("risk_value", 6))
    return tuning.curve(scored, derive.reviews(spark, d, mail)).select(
        _d("bound"), "flagged", "confirmed", "missed", _d("precision"), _d("recall"))


def weight_experiment(spark, d):
    rows = tuning.experiment(derive.emails(spark, d), derive.users(spark, d), WEIGHTS_B, share=0.3)
    return tuning.compared(rows).select("n_a", "hits_a", "n_b", "hits_b", _d("share_a"), _d("share_b"), _d("z"))


def tenant_lexicons(spark, d):
    """Two lists for every tenant, other ones in odd regions."""
    nation = derive.table(spark, d, "nation")
    lists = F.when(F.col("n_regionkey") % 2 == 0, F.lit("money")).otherwise(F.lit("haste"))
    words = F.when(F.col("n_regionkey") % 2 == 0, F.array(*map(F.lit, TENANT_TERMS["money"]))).otherwise(
        F.array(*map(F.lit, TENANT_TERMS["haste"])))
    terms = nation.select(F.col("n_nationkey").cast("string").alias("tenant_id"), lists.alias("list"), F.explode(words).alias("term"))
    return tenant_lexicon.counts(derive.emails(spark, d), terms)


def alert_digests(spark, d):
    mail = derive.emails(spark, d)
    risky = _analyses(spark, d).filter(F.col("risk_level").isin(*V.ALERT_LEVELS)).select("email_id", "risk_value")
    rows = mail.select("email_id", "tenant_id", "sender_email", "received_at").join(risky, "email_id")
    return extensions.alert_digests(rows, "3 days").select(
        "tenant_id", "sender_email", "messages", _d("risk_value"), _s("first_at"), _s("last_at"))


def _land(spark, d, part="true", people_part="true"):
    """Write the derived mail (of the orders in ``part``) and the users as exports of both providers."""
    root = shared_dir(spark, "landed")
    t = derive.tenants(spark, d).select("tenant_id", "provider")
    people = derive.users(spark, d).filter(people_part).join(t, "tenant_id")
    for p in V.PROVIDERS:
        mail = derive.emails(spark, d, by_text=True, tenants=t.filter(F.col("provider") == p)).filter(part)
        save(derive.landed_messages(derive.deliveries(mail), p), f"{root}/messages/provider={p}")
        save(people.filter(F.col("provider") == p).drop("user_id", "provider"), f"{root}/users/provider={p}")
    return root


def _ingest_once(spark, landed, root, run_id):
    """Ingest exports that nothing reads again."""
    jobs.ingest(spark, landed, root, run_id)
    removed(spark, landed)


def ingest_run(spark, d):
    landed, root = _land(spark, d), shared_dir(spark, "tables")
    jobs.seed_tenants(spark, root, "0001", derive.tenants(spark, d))
    jobs.ingest(spark, landed, root, "0001")
    jobs.ingest(spark, landed, root, "0002")   # a second sync of the same files adds nothing
    return tables.read(spark, root, "emails").select(
        "email_id", "tenant_id", "user_id", "provider_message_id", "subject", "sender_email",
        F.col("run").alias("run"), "received_month")


def full_run(spark, d):
    landed, root = _land(spark, d), shared_dir(spark, "tables")
    rows = jobs.run_all(spark, landed, root, "0001", derive.tenants(spark, d))
    return rows.select("tenant_id", _b("rank").alias("rank"), "email_id", _d("risk_score", 4),
                       "risk_level", _b(F.size("detected_threats")).alias("threats"))


EVEN = "cast(email_id as bigint) % 2 = 0"


def repeat_run(spark, d):
    """Half of the mail, then all of it under the same run id, then everything once more."""
    tenants, root = derive.tenants(spark, d), shared_dir(spark, "tables")
    jobs.seed_tenants(spark, root, "0001", tenants)
    _ingest_once(spark, _land(spark, d, EVEN), root, "0001")
    jobs.detect(spark, root)
    landed = _land(spark, d)
    jobs.ingest(spark, landed, root, "0001")
    jobs.detect(spark, root)
    jobs.run_all(spark, landed, root, "0001", tenants)
    removed(spark, landed)
    return tables.read(spark, root, "fraud_analyses").select(
        "email_id", "tenant_id", _d("risk_score", 4), "risk_level")


def stored_versions(spark, d):
    """Two runs judged by two versions of the rules."""
    root = shared_dir(spark, "tables")
    jobs.seed_tenants(spark, root, "9", derive.tenants(spark, d))
    jobs.ingest(spark, _land(spark, d, EVEN), root, "9")
    jobs.detect(spark, root)
    jobs.ingest(spark, _land(spark, d), root, "10")
    jobs.detect(spark, root, config=dataclasses.replace(DEFAULT, weights=WEIGHTS_B, version="2"))
    return tables.read(spark, root, "fraud_analyses").groupBy("rule_version", "risk_level").agg(
        F.count("*").alias("messages"))


def stored_purge(spark, d):
    """Tenants and users leave the stored tables with their messages and analyses."""
    root = shared_dir(spark, "tables")
    landed = _land(spark, d)
    jobs.run_all(spark, landed, root, "0001", derive.tenants(spark, d))
    removed(spark, landed)
    gone = derive.table(spark, d, "nation").filter("n_regionkey = 0").select(
        F.col("n_nationkey").cast("string").alias("tenant_id"))
    closed = derive.table(spark, d, "customer").filter("c_acctbal < 0").select("c_custkey")
    closed = derive.users(spark, d).join(closed, F.col("user_id") == F.col("c_custkey").cast("string"), "left_semi")
    jobs.purge_stored(spark, root, gone, landing.stamp_users(closed.drop("user_id")))
    parts = [tables.read(spark, root, name).select("tenant_id").withColumn("table", F.lit(shown))
             for name, shown in (("tenants", "tenants"), ("emails", "emails"), ("fraud_analyses", "analyses"))]
    parts.append(tables.current(spark, root, "users").select("tenant_id").withColumn("table", F.lit("users")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.groupBy("table", "tenant_id").agg(F.count("*").alias("rows"))


def replayed_rejects(spark, d):
    """Mail of users who land later is kept back, and stored when they have landed."""
    root = shared_dir(spark, "tables")
    jobs.seed_tenants(spark, root, "0001", derive.tenants(spark, d))
    _ingest_once(spark, _land(spark, d, people_part="cast(user_id as bigint) % 2 = 0"), root, "0001")
    _ingest_once(spark, _land(spark, d, "false"), root, "0002")
    jobs.replay(spark, root, "0003")
    return tables.read(spark, root, "emails").select("email_id", "tenant_id", "user_id", "run")


def synced_twice(spark, d):
    """Half of the mail, then all of it from 30 days before each user's position."""
    root = shared_dir(spark, "tables")
    jobs.seed_tenants(spark, root, "0001", derive.tenants(spark, d))
    jobs.ingest(spark, _land(spark, d, EVEN), root, "0001", incremental=True)
    jobs.ingest(spark, _land(spark, d), root, "0002", incremental=True, overlap_days=30)
    return tables.read(spark, root, "emails").select("email_id", "user_id", "run")


def tenant_domains(spark, d):
    """Executive names against the tenant's own list of internal domains."""
    own = derive.table(spark, d, "nation").filter("n_regionkey % 2 = 0").select(
        F.col("n_nationkey").cast("string").alias("tenant_id"),
        F.explode(F.array(*[F.lit(x) for x in OWN_DOMAINS])).alias("domain"))
    config = dataclasses.replace(DEFAULT, rules=("display_name",))
    rows = detection.rule_columns(derive.emails(spark, d), None, config, tenant_domains=own)
    c = F.col("_threat_display_name")
    return rows.filter(c.isNotNull()).select("email_id", "tenant_id", c["evidence"].alias("evidence"))


def _mail_stream(spark, d, twice=False, part=None):
    """Mail derived from a stream of orders."""
    schema = derive.table(spark, d, "orders").schema
    orders = streams.read_stream(spark, d, schema, pattern="orders.parquet")
    if part is not None:
        orders = orders.filter(part)
    if twice:
        orders = orders.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(1))))
    return derive.mail_of(orders, derive.table(spark, d, "customer"), derive.table(spark, d, "documents"))


def stream_dedup_detect(spark, d):
    root = shared_dir(spark, "store")
    query = streams.start_store(_mail_stream(spark, d, twice=True), derive.users(spark, d), root,
                                shared_dir(spark, "checkpoint"))
    query.awaitTermination()
    return spark.read.parquet(f"{root}/analyses").select(
        "email_id", "tenant_id", _d("risk_score", 4), "risk_level")


def stream_two_checkpoints(spark, d):
    """Two streams with checkpoints of their own fill one store: half of the orders, then all."""
    root = shared_dir(spark, "store")
    for part in ("o_orderkey % 2 = 0", None):
        streams.start_store(_mail_stream(spark, d, part=part), derive.users(spark, d), root,
                            shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{root}/analyses").select(
        "email_id", "tenant_id", _d("risk_score", 4), "risk_level")


def stream_typosquatting_long_list(spark, d):
    """A stream against more trusted domains than a batch compares one by one."""
    path = shared_dir(spark, "lookalikes")
    config = dataclasses.replace(DEFAULT, rules=("typosquatting",), trusted_domains=LONG_LIST)
    analysed = streams.analyse(_mail_stream(spark, d), None, config)
    found = analysed.filter(F.size("detected_threats") > 0).select(
        "email_id", F.col("detected_threats")[0]["evidence"].alias("evidence"))
    streams.start_append(found, path, shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path)


def stream_alerts(spark, d):
    path = shared_dir(spark, "alerts")
    analysed = streams.analyse(_mail_stream(spark, d), derive.users(spark, d))
    streams.start_append(streams.alert_rows(analysed), path,
                         shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).select("email_id", "tenant_id", _d("risk_value"), "risk_level",
                                           "type", _d("confidence"))


def stream_risk_counts(spark, d):
    path = shared_dir(spark, "counts")
    analysed = streams.analyse(streams.with_event_time(_mail_stream(spark, d)), derive.users(spark, d),
                               carry=("email_id", "tenant_id", "received_at", "event_time"))
    streams.start_update(streams.risk_counts(analysed, span="1 hour"), path,
                         shared_dir(spark, "checkpoint")).awaitTermination()
    state = streams.latest_state(spark, path, ("window_start", "tenant_id", "risk_level"))
    return state.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                        "tenant_id", "risk_level", "messages")


def stream_distinct(spark, d):
    """Two streams over one store, one with every message twice: every key is kept once, the rest is counted."""
    root = shared_dir(spark, "distinct")
    for name in ("a", "b"):
        streams.start_distinct(_mail_stream(spark, d, twice=name == "a"), f"{root}/store", f"{root}/check-{name}").awaitTermination()
    kept = spark.read.parquet(f"{root}/store/rows").agg(F.count("*").alias("kept"), F.countDistinct("email_id").alias("ids"))
    counts = spark.read.parquet(f"{root}/store/counts").agg(F.sum("arrived").alias("arrived"), F.sum("repeated").alias("repeated"))
    return kept.crossJoin(counts)


def stream_event_dedup(spark, d):
    path = shared_dir(spark, "events")
    schema = derive.table(spark, d, "events").schema
    stream = streams.with_event_time(
        streams.read_stream(spark, d, schema, pattern="events.parquet"), "ts")
    twice = stream.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(1)))).drop("_copy")
    streams.start_append(streams.dedupe(twice, ("event_id",)), path,
                         shared_dir(spark, "checkpoint")).awaitTermination()
    return (spark.read.parquet(path).groupBy("event_type")
            .agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("ids")))


RULE_QUERIES = {
    "display_name_mismatch": "display_name", "domain_typosquatting": "typosquatting",
    "auth_failures": "auth_failures", "urgency_financial": "urgency_financial",
    "reply_to_mismatch": "reply_to", "suspicious_attachments": "attachments",
    "bec_role_targeting": "role_targeting",
}

QUERIES = {
    **{name: _rule(rule_id) for name, rule_id in RULE_QUERIES.items()},
    "constraint_rejects": _rejects,
    **{f.__name__: f for f in (
        risk_score, risk_score_long, threats_by_type, tenant_rule_settings, term_presence,
        role_groups, auth_header_search, header_values, recipients_table, attachments_table,
        repeated_attachments, orphan_messages, dead_letters, provider_union, dedup_first_wins,
        insert_absent_only, ingest_counts, user_upsert, tenant_seed, recipient_lookup,
        unprocessed_batch, unprocessed_messages, detect_queue, mark_processed, high_risk_topk,
        high_risk_all_tenants, latest_per_tenant, sender_investigation, messages_of_sender,
        mailbox_timeline, risk_dashboard, newest_of_level, tenant_summary, alerts,
        address_validation, tenant_purge, tenant_lookup, email_lookup, json_columns,
        incremental_sync, sync_per_user, lookalike_hosts, typosquatting_long_list, edit_distance,
        trigram_lookalikes, monthly_retention, review_precision, review_thresholds, rule_versions,
        ingest_run, full_run, repeat_run, stored_versions, stored_purge, tenant_domains,
        replayed_rejects, synced_twice, review_curve, weight_experiment, tenant_lexicons, alert_digests,
        stream_dedup_detect, stream_two_checkpoints, stream_typosquatting_long_list, stream_alerts,
        stream_risk_counts, stream_event_dedup, stream_distinct)},
}
