"""Inputs of the registered queries, derived from the given tables by SQL.

One SQL text serves Spark and DuckDB; the few dialect differences are marked with
<placeholders>.  Every view covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.threads import dedup_keep_first

PHRASES = ["", "my apple id is locked", "I want a refund", "the hotspot is slow", "update failed on ios 9 update",
           "the app crash again", "icloud backup", "no cell signal", "warranty question", "repair please", "", ""]
_QUOTED = ", ".join(f"'{p}'" for p in PHRASES)

# Messages: mentions, URLs, keyword phrases, null texts, malformed parents, repeated ids
# (with changed text) and exact copies.
TWEETS = """
with base as (
 select cast(conv_id*100+turn+1 as <str>) as tweet_id,
  case when role='user' then concat('cust_', cast(conv_id as <str>))
       else concat('brand_', cast(conv_id%5 as <str>)) end as author_id,
  role='user' as inbound,
  timestamp '2024-01-01 00:00:00' + (conv_id*60+turn) * interval '1' minute as created_at,
  case when (conv_id*5+turn)%41=7 then null else
   concat(case when turn>0 then concat('@acct_', cast(conv_id%7 as <str>), ' ') else '' end,
         text, ' ', <phrase>,
         case when conv_id%4=0 then concat(' https://t.co/', cast(conv_id as <str>)) else '' end) end as text,
  case when turn%2=0 then cast(conv_id*100+turn+2 as <str>) end as response_tweet_id,
  case when turn=0 then null
       when conv_id%11=10 and turn=2 then 'bad-id'
       else cast(conv_id*100+turn as <str>) end as in_response_to_tweet_id,
  conv_id*100+turn as ingest_seq
 from <conversations>)
select * from base
union all
select tweet_id, author_id, inbound, created_at, text || ' DUP', response_tweet_id, in_response_to_tweet_id,
  ingest_seq+100000000 from base where ingest_seq%13=0
union all
select tweet_id, author_id, inbound, created_at, text, response_tweet_id, in_response_to_tweet_id,
  ingest_seq+200000000 from base where ingest_seq%29=0
"""

DECISIONS = """
select event_id, intent, case when event_id%9=0 then 'connectivity' else intent end as true_intent,
  ((event_id*37)%101)/100.0<d> as confidence, ((user_id*13+event_id)%97)/100.0<d> as evidence_score,
  cast(event_id%6 as int) as n_evidence,
  case when value>20 then 'ESCALATE' else 'AUTO_HANDLE' end as truth,
  case when value>80 then 'yes' when value>60 then ' TRUE' when value>40 then '1' when value>20 then 'Escalate'
       when value>10 then 'no' else '' end as answer
from (select *, case event_type when 'error' then 'device_hardware' when 'click' then 'app_issue'
        when 'view' then 'connectivity' when 'signup' then 'account_access' else 'icloud_sync' end as intent
      from <events>) e
"""

PREDICTIONS = """
select doc_id, text, lang as y_true,
  case when concat(' ',lower(text),' ') like '% und %' then 'de' when concat(' ',lower(text),' ') like '% et %' then 'fr'
       when concat(' ',lower(text),' ') like '% el %' then 'es' when concat(' ',lower(text),' ') like '% to %' then 'en'
       else 'other' end as y_pred
from <documents>
"""

_INTENT_CYCLE = ["account_access", "billing_payment", "device_hardware", "software_update", "app_issue", "icloud_sync",
                 "connectivity", "warranty_repair", "other", "", "not_real"]
_ESC_CYCLE = ["YES", "n", "handle", "Review", "", "MAYBE"]


def _cycle(expr: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {expr} {whens} end"


ANNOTATIONS = f"""
select doc_id as row_no, cast(case when doc_id%23=22 then doc_id-1 else doc_id end as <str>) as id,
  cast(case when doc_id%17=16 then doc_id-1 else doc_id end as <str>) as tweet_id,
  source as conversation_id, case when doc_id%29=0 then '  ' else text end as text,
  {_cycle('doc_id%9', _INTENT_CYCLE[:9])} as auto_intent,
  {_cycle('doc_id%11', _INTENT_CYCLE)} as gold_intent,
  {_cycle('doc_id%6', _ESC_CYCLE)} as should_escalate,
  case when doc_id%4=0 then '' else 'seen' end as notes
from <documents>
"""

LEGACY = """
select tweet_id, row_no, auto_intent as gold_intent, 'ESCALATE' as should_escalate,
  cast(1+row_no%5 as <str>) as gold_reply_quality, concat('legacy ', cast(row_no as <str>)) as notes
from annotations where row_no%3<>1
"""

DIMENSIONS = ["relevance", "grounding", "helpfulness", "tone", "no_hallucination", "escalation_correct", "conciseness"]


def _judge_json(score: str) -> str:
    parts = [f"""'"{d}": {{"score": ', {score.format(i=i)}, ', "reason": "because {d}"}}'""" for i, d in enumerate(DIMENSIONS)]
    return "concat('{', " + ", ', ', ".join(parts) + ", '}')"


_NUM = "cast(1+(doc_id+{i})%5 as <str>)"
_BARE = _judge_json(_NUM)
_TEXT = _judge_json("""'"', cast(1+(doc_id+{i})%5 as <str>), '"'""")
_FRAC = _judge_json("cast(1+(doc_id+{i})%5 as <str>), '.7'")
JUDGE_RAW = """
select doc_id, doc_id as id, text, lang as intent, source as generated_reply,
  concat('[{"customer_text": "', lang, ' case", "brand_text": "', source, '", "similarity": 0.5}',
         case when doc_id%7=0 then '' else ']' end) as evidence,
  case doc_id%8
   when 0 then concat('```json', chr(10), BARE, chr(10), '```')
   when 1 then BARE
   when 2 then concat('Here you go: ', TEXT, ' Done.')
   when 3 then concat('{"relevance": {"score": ', cast(1+doc_id%5 as <str>), ', "reason": null}, "tone": {"reason": true}}')
   when 4 then FRAC
   when 5 then '{"relevance": {"score": "4.7", "reason": "x"}}'
   when 6 then '{"relevance": 5}'
   else case when doc_id%16=7 then null else '{"relevance": {"score": 4' end end as raw_output
from <documents>
""".replace("BARE", _BARE).replace("TEXT", _TEXT).replace("FRAC", _FRAC)

RATINGS = """
select r.doc_id as id, d.dim,
  case when doc_id%19<>0 then 1+(doc_id*7+d.dim*3+doc_id <div> 5)%5 end as human,
  least(5, greatest(1, 1+(doc_id*7+d.dim*3+doc_id <div> 5)%5 + (doc_id*3+doc_id <div> 7+d.dim)%3 - 1)) as judge
from <documents> r <dims>
"""


_SPARK = {"<phrase>": f"element_at(array({_QUOTED}), cast((conv_id*3+turn)%12+1 as int))", "<d>": "D",
          "<div>": "div", "<dims>": "lateral view explode(sequence(0, 6)) d as dim", "<str>": "string"}
_DUCK = {"<phrase>": f"list_extract([{_QUOTED}], cast((conv_id*3+turn)%12+1 as bigint))", "<d>": "e0",
         "<div>": "//", "<dims>": ", (select unnest(range(7)) as dim) d", "<str>": "varchar"}
# Stop list of the clustering queries (a parameter; the library default is Spark's English list)
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "it", "for", "on", "with", "by", "are"]

_TABLES = ["events", "documents", "conversations", "embeddings", "labels"]


def _fill(sql: str, values: dict[str, str]) -> str:
    for mark, text in values.items():
        sql = sql.replace(mark, text)
    return sql


def duck(sql: str) -> str:
    """The DuckDB form; tables are the pre-registered views."""
    return _fill(sql, {**_DUCK, **{f"<{t}>": t for t in _TABLES}})


def spark_view(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """The Spark form; tables are read straight from the Parquet files."""
    return spark.sql(_fill(sql, {**_SPARK, **{f"<{t}>": f"parquet.`{sf}/{t}.parquet`" for t in _TABLES}}))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tweets(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, TWEETS)


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, DECISIONS)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, PREDICTIONS)


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, ANNOTATIONS)


def legacy(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, LEGACY.replace("from annotations", f"from ({ANNOTATIONS}) a"))


def judge_raw(spark: SparkSession, sf: str) -> DataFrame:
    return spark_view(spark, sf, JUDGE_RAW)


def ratings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(human, judge) score tables in wide form: one row per id."""
    names = F.element_at(F.array(*[F.lit(d) for d in DIMENSIONS]), F.col("dim") + 1)
    long = spark_view(spark, sf, RATINGS).withColumn("dimension", names)
    wide = long.groupBy("id").pivot("dimension", DIMENSIONS)
    judge = wide.agg(F.first("judge"))
    return wide.agg(F.first("human")), judge.select("id", *[F.col(d).alias(f"judge_{d}") for d in DIMENSIONS])


def message_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(tweet_id, embedding): every message gets a vector of the embeddings table by position."""
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    n = emb.agg(F.count(F.lit(1)))
    ids = dedup_keep_first(tweets(spark, sf)).select("tweet_id", "ingest_seq").withColumn("n", n.scalar())
    return ids.select("tweet_id", F.pmod("ingest_seq", "n").alias("vec_id")).join(emb, "vec_id").drop("vec_id")


def case_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the evidence store for the prompt queries: every document, with the number ``e`` of its vector by position.

    ``share`` puts together at most 64 ids of one vector.
    """
    n = table(spark, sf, "embeddings").agg(F.count(F.lit(1)))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("text").alias("customer_text"), F.col("source").alias("brand_text"),
        F.col("lang").alias("conversation_id")).withColumn("n", n.scalar())
    return docs.withColumn("e", F.pmod("vec_id", "n")).withColumn("share", F.struct("e", F.floor(F.col("vec_id") / (F.col("n") * 64)).alias("part"))).drop("n")


def case_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, e, share, embedding) of the evidence store: no texts, one row for every vector of that number."""
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("e"), "embedding")
    return case_texts(spark, sf).select("vec_id", "e", "share").join(emb, "e")
