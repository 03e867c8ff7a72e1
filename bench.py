"""Headline timings: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; prints one JSON line.

Every query runs once on the smaller tables beside the chosen ones, so that code is compiled, and then
``BENCH_RUNS`` times (three); the median counts.  Deriving the test mail is timed but not summed.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from lurewatch.operators import detection, extensions, merge, recipients, reports
from lurewatch.session import shared_dir
from lurewatch.sources import tables
from lurewatch.workload import derive

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR), "sf0.01")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df):
    df.write.format("noop").mode("overwrite").save()


def measured(spark, sf_dir, runs):
    """Seconds per query (medians), seconds of the derivation, number of messages."""
    root, times = shared_dir(spark, "bench"), {}

    def timed(name, action, runs=runs):
        spent = []
        for _ in range(runs):
            start = time.time()
            action()
            spent.append(time.time() - start)
        times[name] = round(statistics.median(spent), 3)

    # The tables as a sync leaves them.
    timed("derive_emails", lambda: tables.write(derive.emails(spark, sf_dir), root, "emails", "0001"), 1)
    tables.write(derive.users(spark, sf_dir), root, "users", "0001")
    emails, users = tables.read(spark, root, "emails"), tables.current(spark, root, "users")
    messages, derived = emails.count(), times.pop("derive_emails")

    def stored_analyses():
        tables.write(detection.analyse(emails, users), root, "fraud_analyses", "0001")

    timed("detect_rules_only", lambda: run(detection.analyse(emails, None)))
    timed("detect", stored_analyses)
    analyses = tables.read(spark, root, "fraud_analyses")
    timed("recipient_lookup", lambda: run(recipients.with_recipient(emails.select(
        "email_id", "tenant_id", "recipient_email"), users)))
    timed("dedup_first_wins", lambda: run(merge.insert_if_absent(derive.deliveries(emails), None)))
    timed("insert_absent_only", lambda: run(merge.insert_if_absent(derive.deliveries(emails), emails)))
    timed("user_upsert", lambda: run(merge.upsert_users(users, derive.user_deliveries(users))))
    timed("high_risk_topk", lambda: run(reports.top_of_tenant(analyses, "7")))
    timed("high_risk_all_tenants", lambda: run(reports.top_of_all_tenants(analyses)))
    timed("risk_dashboard", lambda: run(reports.level_counts(analyses, "tenant_id")))
    timed("threats_by_type", lambda: run(extensions.threats_by_period(
        detection.threats_long(analyses, "analyzed_at"))))
    timed("sender_investigation", lambda: run(reports.senders(emails)))
    timed("mailbox_timeline", lambda: run(reports.mailbox(emails).select("user_id", "received_at", "email_id")))
    timed("alerts", lambda: run(extensions.alerts(analyses, emails)))
    return times, derived, messages


def main():
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
             .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
             # The JVM does not compile methods above this size; Spark then splits the code instead.
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM_DIR):
        measured(spark, WARM_DIR, 1)
    times, derived, messages = measured(spark, SF_DIR, RUNS)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR), "messages": messages,
        "derive_emails": derived, "runs": RUNS,
        "messages_per_second": {n: round(messages / times[n]) for n in (
            "detect_rules_only", "detect", "dedup_first_wins")},
        "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
