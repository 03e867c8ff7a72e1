"""Row types of the four tables and of the nested columns."""

from pyspark.sql import types as T

S, NTZ = T.StringType(), T.TimestampNTZType()

THREAT = T.StructType([
    T.StructField("type", S),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("evidence", S),
])
THREATS = T.ArrayType(THREAT)
NAMES = T.ArrayType(S)
HEADERS = T.MapType(S, S)

# Credentials of a tenant are never read into the engine.
TENANTS = T.StructType([
    T.StructField("tenant_id", S), T.StructField("name", S), T.StructField("provider", S),
    T.StructField("status", S), T.StructField("created_at", NTZ), T.StructField("updated_at", NTZ),
])

USERS = T.StructType([
    T.StructField("user_id", S), T.StructField("tenant_id", S),
    T.StructField("provider_user_id", S), T.StructField("email", S),
    T.StructField("display_name", S), T.StructField("role", S), T.StructField("created_at", NTZ),
])

EMAILS = T.StructType([
    T.StructField("email_id", S), T.StructField("tenant_id", S), T.StructField("user_id", S),
    T.StructField("provider_message_id", S), T.StructField("subject", S),
    T.StructField("sender_email", S), T.StructField("sender_name", S),
    T.StructField("recipient_email", S), T.StructField("received_at", NTZ),
    T.StructField("has_attachments", T.BooleanType()), T.StructField("attachment_names", NAMES),
    T.StructField("body_preview", S), T.StructField("headers", HEADERS),
    T.StructField("ingested_at", NTZ), T.StructField("processed_at", NTZ),
])

ANALYSES = T.StructType([
    T.StructField("analysis_id", S), T.StructField("email_id", S), T.StructField("tenant_id", S),
    T.StructField("risk_score", T.DecimalType(5, 4)), T.StructField("risk_level", S),
    T.StructField("detected_threats", THREATS), T.StructField("analyzed_at", NTZ),
])

# Landed exports, one directory per provider.  The Google export keeps the From
# header as written, the Microsoft export has the bare address.
LANDED_USERS = T.StructType([
    T.StructField("tenant_id", S), T.StructField("provider_user_id", S), T.StructField("email", S),
    T.StructField("display_name", S), T.StructField("role", S), T.StructField("created_at", NTZ),
])
_LANDED_MESSAGE = [
    T.StructField("tenant_id", S), T.StructField("provider_user_id", S),
    T.StructField("provider_message_id", S), T.StructField("subject", S),
    T.StructField("sender_name", S), T.StructField("recipient_email", S),
    T.StructField("received_at", NTZ), T.StructField("has_attachments", T.BooleanType()),
    T.StructField("attachment_names", NAMES), T.StructField("body_preview", S),
    T.StructField("headers", HEADERS), T.StructField("ingested_at", NTZ),
]
LANDED_MESSAGES = {
    "microsoft": T.StructType([*_LANDED_MESSAGE, T.StructField("sender_email", S)]),
    "google": T.StructType([*_LANDED_MESSAGE, T.StructField("from_header", S)]),
}

USER_KEY = ("tenant_id", "provider_user_id")
MESSAGE_KEY = ("tenant_id", "provider_message_id")
