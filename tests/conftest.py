import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lurewatch import schemas  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    return Maker(spark)


class Maker:
    """Small tables with defaults for the columns a test does not care about."""

    def __init__(self, spark):
        self.spark = spark

    def emails(self, *rows):
        full = []
        for i, row in enumerate(rows):
            base = {"email_id": str(i), "tenant_id": "t", "user_id": "u", "subject": "",
                    "provider_message_id": f"m{i}", "sender_email": "a@external.com",
                    "sender_name": "", "recipient_email": "r@company.com",
                    "received_at": dt.datetime(2024, 1, 1), "has_attachments": False,
                    "attachment_names": None, "body_preview": "", "headers": {},
                    "ingested_at": dt.datetime(2024, 1, 2), "processed_at": None}
            base.update(row)
            full.append(tuple(base[f] for f in schemas.EMAILS.fieldNames()))
        return self.spark.createDataFrame(full, schemas.EMAILS)

    def users(self, *rows):
        full = []
        for i, row in enumerate(rows):
            base = {"user_id": f"u{i}", "tenant_id": "t", "provider_user_id": f"p{i}",
                    "email": f"r{i}@company.com", "display_name": "", "role": "",
                    "created_at": dt.datetime(2024, 1, 1)}
            base.update(row)
            full.append(tuple(base[f] for f in schemas.USERS.fieldNames()))
        return self.spark.createDataFrame(full, schemas.USERS)
