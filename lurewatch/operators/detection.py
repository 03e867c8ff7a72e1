"""Run the rules over messages and fold the hits into one analysis per message."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import address, codec, lexicon, risk
from . import lookalikes, recipients
from .keyed import settled
from .rules import REGISTRY, attachments, role_targeting, selected, typosquatting, urgency_financial
from .rules.base import LEXICON, RAW, TEXT, THREAT_TYPE, with_message_columns

# Above this many trusted domains a batch compares distinct domains by a join instead of comparing
# each message's domain by itself, as streams always do.  The rows are the same.
INLINE_TRUSTED = 64


def _threat_column(rule) -> str:
    return f"_threat_{rule.rule_id}"


def rule_columns(emails: DataFrame, users: DataFrame | None = None, config=DEFAULT, *,
                 trusted: DataFrame | None = None, tenant_domains: DataFrame | None = None,
                 carry=("email_id", "tenant_id", "received_at")) -> DataFrame:
    """One row per message: the carried columns and one nullable threat column per rule.

    The text is scanned once for the words of all rules, before anything is shuffled, and dropped then:
    only slim rows meet the directory of targeted people, which Spark broadcasts if it is small.

    ``tenant_domains`` has (tenant_id, domain): the internal domains of a tenant, instead of the
    configured ones.  ``trusted`` has (pos, domain) and is for batches.
    """
    rules = selected(config)
    names = {r.rule_id for r in rules}
    messages = with_message_columns(emails, config, tenant_domains)
    lists = {}
    for rule in (urgency_financial, attachments, role_targeting):
        if rule.RULE.rule_id in names and not (rule is role_targeting and users is None):
            lists |= rule.lists(config)
    if lists:
        messages = messages.withColumn(LEXICON, lexicon.counts(F.col(RAW), lists, fold=True))
    if "attachments" in names:
        messages = attachments.with_urgency(messages, config)

    if trusted is not None and emails.isStreaming:
        raise ValueError("a stream takes its trusted domains from the configuration")
    join_wanted = "typosquatting" in names and not emails.isStreaming and (
        trusted is not None or len(config.trusted_domains) > INLINE_TRUSTED)
    people = None
    if "role_targeting" in names:
        if users is None:
            messages = messages.withColumns({
                role_targeting.ROLE: F.lit(None).cast("string"),
                **{c: F.lit(False) for c in (role_targeting.CSUITE, role_targeting.FINANCE,
                                             role_targeting.HR, role_targeting.URGENCY,
                                             role_targeting.PAYMENT, role_targeting.PAYROLL)}})
        else:
            people = recipients.targeted_people(users, config)
            messages = messages.withColumns(role_targeting.signals_before_join())

    # Everything below needs no text any more.
    early = [r for r in rules if r.rule_id != "role_targeting"
             and not (r.rule_id == "typosquatting" and join_wanted)]
    slim = messages.withColumns({_threat_column(r): r.detect(config) for r in early}) \
        if early else messages
    slim = slim.drop(RAW, TEXT, LEXICON, "body_preview", "subject", "headers", "attachment_names") \
        if not set(carry) & {"body_preview", "subject", "headers", "attachment_names"} \
        else slim.drop(RAW, TEXT, LEXICON)

    if people is not None:
        slim = slim.join(people, ["tenant_id", "recipient_email"], "left")
    if join_wanted:
        listed = trusted if trusted is not None else lookalikes.trusted_frame(
            emails.sparkSession, config.trusted_domains)
        domains = emails.select(address.domain_of("sender_email").alias("domain"))
        slim = lookalikes.with_lookalike(slim, domains, listed, typosquatting.MATCH)
    late = {}
    for r in rules:
        if r.rule_id == "role_targeting":
            late[_threat_column(r)] = r.detect(config)
        elif r.rule_id == "typosquatting" and join_wanted:
            late[_threat_column(r)] = typosquatting.detect_from(F.col(typosquatting.MATCH))
    if late:
        slim = slim.withColumns(late)
    found = [_threat_column(r) for r in rules]
    return settled(slim.select(*carry, *found), found)


def threat_array(config=DEFAULT) -> Column:
    """The threats found, in rule order; empty, never NULL."""
    columns = [F.col(_threat_column(r)) for r in selected(config)]
    if not columns:
        return F.array().cast(f"array<{THREAT_TYPE}>")
    return F.array_compact(F.array(*columns))


def score(config=DEFAULT) -> Column:
    """Capped weighted maximum straight from the rule columns."""
    scored = [F.col(_threat_column(r))["confidence"]
              * risk.weight_of(F.col(_threat_column(r))["type"], config.weights, r.types)
              for r in selected(config)]
    return risk.capped(F.greatest(F.lit(0.0), F.lit(0.0), *scored))


def analyse(emails: DataFrame, users: DataFrame | None = None, config=DEFAULT, *,
            as_of=None, carry=("email_id", "tenant_id", "received_at"), **options) -> DataFrame:
    """One analysis per message.

    ``risk_value`` is the unrounded score, ``risk_score`` the stored one; the level comes
    from the unrounded value.  ``as_of`` is the analysis time; without it the message's own
    time of receipt is used, which keeps a re-run reproducible.  ``rule_version`` names the settings, so
    the result can be stored as it is.
    """
    analysed_at = F.col("received_at") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    carry = tuple(dict.fromkeys((*carry, "email_id", "received_at")))
    return (rule_columns(emails, users, config, carry=carry, **options)
            .withColumn("risk_value", score(config))
            .withColumn("detected_threats", threat_array(config))
            .withColumn("analysis_id", codec.derived_id("analysis", "email_id"))
            .withColumn("risk_score", risk.stored_score("risk_value"))
            .withColumn("risk_level", risk.risk_level("risk_value"))
            .withColumn("analyzed_at", analysed_at)
            .withColumn("rule_version", F.lit(config.version))
            .select(*carry, "analysis_id", "risk_value", "risk_score", "risk_level",
                    "detected_threats", "analyzed_at", "rule_version"))


def threats_long(analyses: DataFrame, *keep) -> DataFrame:
    """One row per threat."""
    return (analyses.select("email_id", *keep, F.posexplode("detected_threats").alias("pos", "t"))
            .select("email_id", *keep, "pos", "t.type", "t.confidence", "t.evidence"))


def score_long(messages: DataFrame, threats: DataFrame, weights: DataFrame) -> DataFrame:
    """Scores from a threat table and a weight table.

    Weights are looked up with a left join (missing or zero counts 1.0); messages without a
    threat come back with 0.0.  Equal to the in-row score.  The weights of the registered types
    are at most one row per type, so they are broadcast: the few types are all hot keys.
    """
    from .. import fixed_values as V
    types = [t for r in REGISTRY.values() for t in r.types]
    few = weights.filter(F.col("type").isin(types)).groupBy("type").agg(F.max("weight").alias("weight"))
    scored = (threats.join(F.broadcast(few), "type", "left")
              .withColumn("weight", F.coalesce(F.nullif(F.col("weight"), F.lit(0.0)),
                                               F.lit(V.DEFAULT_WEIGHT)))
              .groupBy("email_id")
              .agg(F.max(F.col("confidence") * F.col("weight")).alias("best")))
    return (messages.select("email_id").join(scored, "email_id", "left")
            .select("email_id", risk.capped("best").alias("risk_value"))
            .withColumn("risk_level", risk.risk_level("risk_value")))


def apply_tenant_rules(emails_rules: DataFrame, tenant_rules: DataFrame, config=DEFAULT) -> DataFrame:
    """Score with per-tenant switches and weights.

    ``emails_rules`` comes from `rule_columns`; ``tenant_rules`` has (tenant_id, rule_id,
    enabled, weight), where a missing row means enabled with the type's own weight.  Of several
    settings for one rule of a tenant, off wins over on and the largest weight counts.  The
    table is folded to one row per tenant first, so the join adds no rows.
    """
    rules = selected(config)
    single = tenant_rules.groupBy("tenant_id", "rule_id").agg(
        F.min("enabled").alias("enabled"), F.max("weight").alias("weight"))
    folded = single.groupBy("tenant_id").agg(F.map_from_entries(F.collect_list(
        F.struct("rule_id", F.struct("enabled", "weight")))).alias("_settings"))
    joined = emails_rules.join(folded, "tenant_id", "left")
    kept = {}
    scored = [F.lit(0.0)]
    for r in rules:
        c, setting = _threat_column(r), F.try_element_at("_settings", F.lit(r.rule_id))
        enabled = F.coalesce(setting["enabled"], F.lit(True))
        kept[c] = F.when(enabled, F.col(c))
        own = risk.weight_of(F.col(c)["type"], config.weights, r.types)
        weight = F.coalesce(F.nullif(setting["weight"], F.lit(0.0)), own)
        scored.append(F.when(enabled, F.col(c)["confidence"] * weight))
    result = joined.withColumn("risk_value", risk.capped(F.greatest(F.lit(0.0), *scored)))
    return (result.withColumns(kept).drop("_settings")
            .withColumn("detected_threats", threat_array(config))
            .withColumn("risk_level", risk.risk_level("risk_value"))
            .drop(*[_threat_column(r) for r in rules]))
