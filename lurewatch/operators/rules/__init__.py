"""The registry of rules, in evaluation order."""

from . import (attachments, auth_failures, display_name, reply_to, role_targeting,
               typosquatting, urgency_financial)

REGISTRY = {m.RULE.rule_id: m.RULE for m in (
    display_name, typosquatting, auth_failures, urgency_financial, reply_to, attachments,
    role_targeting)}


def register(rule):
    """Add a rule.  It runs after the present ones and may emit types without weight."""
    REGISTRY[rule.rule_id] = rule
    return rule


def selected(config):
    """Rules named by the settings, in registry order; all if none is named."""
    return [r for r in REGISTRY.values() if not config.rules or r.rule_id in config.rules]
