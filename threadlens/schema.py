"""Fixed schemas and the default parameters of the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

ID_COLUMNS = ["tweet_id", "author_id", "response_tweet_id", "in_response_to_tweet_id"]

# Ids stay strings: 64-bit ids do not survive a trip through float64.
RAW_MESSAGE_SCHEMA = T.StructType([
    T.StructField("tweet_id", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("inbound", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("response_tweet_id", T.StringType()),
    T.StructField("in_response_to_tweet_id", T.StringType()),
])

EVIDENCE_TYPE = (
    "array<struct<rank:int,similarity:double,customer_text:string,"
    "brand_text:string,conversation_id:string,created_at:string>>"
)

SEED = 42
TRAIN_RATIO, VAL_RATIO = 0.70, 0.15
TOP_K = 5
CONFIDENCE_THRESHOLD = 0.60
SIMILARITY_THRESHOLD = 0.30
RISK_THRESHOLD = 0.50
HIGH_RISK_INTENTS = ("account_access", "billing_payment")
GOLDEN_SIZE = 200
JUDGE_SAMPLE = 50
BOOTSTRAP_ITERATIONS = 1000
DOUBLE_LABEL_N = 50
MIN_BRAND_VOLUME = 100
MIN_CLEAN_LENGTH = 5
DEFAULT_BRAND = "AppleSupport"

AUTO, ESCALATE = "AUTO_HANDLE", "ESCALATE"
