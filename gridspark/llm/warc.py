"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; record headers are stored apart, byte for byte. An original
record is its header joined with the payload that its digest names. Both parts are Parquet tables, so archives grow
with Spark's writers and a lost task writes its files anew. Payloads are stored in buckets by digest: to read records back,
headers go to the buckets and no payload is moved. A payload meets the headers of its responses only, nearly always one;
revisits have no body and get the measures of theirs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import LAST_ID, materialize, scratch_path, table

MIN_REVISIT_BYTES = 0
DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each five hex digits are four digits to base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Every row's payload, digests and place: of equal payloads of at least ``min_bytes`` bytes the one with the
    smallest id is a response and the others revisit it. Null ids come last; rows that share the smallest id are all
    responses; of their urls a revisit names the least. Only digests are grouped, never payloads."""
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "sha1": base32_sha1(F.col("payload")), "bytes": F.length("payload").cast("long")})
    first = rows.where(F.col("bytes") >= min_bytes).groupBy("sha256").agg(F.min(F.struct(F.coalesce("page_id", F.lit(LAST_ID)).alias("id"), F.col("url"))).alias("least")).select("sha256", F.col("least.id").alias("first"), F.col("least.url").alias("first_url"))
    rows = rows.join(first, "sha256", "left")
    revisit = F.col("first").isNotNull() & (F.coalesce("page_id", F.lit(LAST_ID)) > F.col("first"))
    return rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first")))


def record_id(page_id: Column, url: Column) -> Column:
    """Names a record by its page, url and payload."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), F.md5(F.concat_ws("\n", url, F.col("sha256"))), F.lit(">"))


def header(rows: DataFrame) -> Column:
    """WARC and HTTP header bytes of a record; control characters of the url are percent-encoded."""
    safe = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("record_type") == "revisit", F.octet_length(http)).otherwise(F.octet_length(http) + F.col("bytes"))
    return F.encode(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
            F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id"), F.col("url")),
            F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), safe,
            F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
            F.when(F.col("record_type") == "revisit", F.concat(F.lit("\r\nWARC-Refers-To: "), record_id(F.nullif(F.col("refers_to"), F.lit(LAST_ID)), F.col("first_url")), F.lit(f"\r\nWARC-Profile: {_PROFILE}"))).otherwise(""),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"),
            F.lit("\r\n\r\n"), http,
        ),
        "UTF-8",
    )


def write_archive(pages: DataFrame, path: str, buckets: int | None = None, **options) -> str:
    """Writes ``path/headers`` (page_id, sha256, header), and the payloads (sha256, payload) as a table with files under ``path/payloads``, of
    ``buckets`` buckets by digest (by default as many as shuffle partitions); gives the table's name."""
    spark = pages.sparkSession
    rows = records(pages, **options)
    rows.select("page_id", "sha256", header(rows).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    # Equal payloads meet as one row per task before the shuffle, which is also the buckets'.
    n, name = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), f"payloads_{uuid.uuid4().hex}"
    one = rows.select("sha256", "payload").dropDuplicates(["sha256"]).repartition(n, "sha256").dropDuplicates(["sha256"])
    one.write.option("compression", "zstd").option("path", f"{path}/payloads").bucketBy(n, "sha256").saveAsTable(name)
    return name


def stored_payloads(spark: SparkSession, path: str, payloads: str | None) -> DataFrame:
    """By the table's name; without one, as in another session, from the files alone, which a join then moves."""
    return spark.table(payloads) if payloads else spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")


def rebuilt(spark: SparkSession, path: str, payloads: str | None = None) -> DataFrame:
    """The original records, from headers and payloads: ``page_id, sha256, header, record_type, payload, record``; record is the bytes of a WARC file
    for it, and only responses have a payload. A payload that is missing or is not the one of its digest, and a body that hasn't the
    length its header says, are errors."""
    heads = spark.read.parquet(f"{path}/headers").withColumn("record_type", field(F.col("header"), "WARC-Type"))
    stored = stored_payloads(spark, path, payloads)
    responses = heads.where("record_type = 'response'").hint("merge").join(stored, "sha256", "left").withColumn("payload", checked(F.col("payload"), F.col("sha256")))
    both = responses.unionByName(heads.where("record_type <> 'response'"), allowMissingColumns=True)
    end = F.lit(b"\r\n\r\n")
    body = F.coalesce("payload", F.lit(b""))
    block = F.octet_length("header") - F.length(F.regexp_extract(F.decode("header", "UTF-8"), r"(?s)^.*?\r\n\r\n", 0).cast("binary")) + F.octet_length(body)
    fits = field(F.col("header"), "Content-Length") == block.cast("string")
    record = F.when(fits, F.concat("header", body, end)).otherwise(F.raise_error(F.lit("a body hasn't the length of its header")))
    return both.select("page_id", "sha256", "header", "record_type", "payload", record.alias("record"))


def read_archive(spark: SparkSession, path: str, payloads: str | None = None) -> DataFrame:
    """``page_id, header, payload, record`` of every record; a revisit has the payload of the record that it refers to."""
    rows = rebuilt(spark, path, payloads)
    lent = stored_payloads(spark, path, payloads).withColumnRenamed("payload", "lent")
    return rows.join(lent, "sha256", "left").select("page_id", "header", F.coalesce("payload", "lent").alias("payload"), "record")


def checked(payload: Column, digest: Column) -> Column:
    """The payload, or an error if it is missing or not the one that its digest names."""
    return F.when(F.sha2(payload, 256) == digest, payload).otherwise(F.raise_error(F.concat(F.lit("payload is missing or damaged: "), digest)))


def field(head: Column, name: str) -> Column:
    return F.regexp_extract(F.decode(head, "UTF-8"), rf"\r\n{name}: ([^\r\n]*)", 1)


def summary(spark: SparkSession, path: str, payloads: str | None = None) -> DataFrame:
    """One row per record that is rebuilt: what its bytes say. Payload length and digest are computed from the rebuilt record's own
    body; a revisit's are those of the response that has its payload, whose measures alone travel."""
    rows = rebuilt(spark, path, payloads)
    # A response's payload is what lies between its header and the record's end.
    body = F.substring("record", F.octet_length("header") + 1, F.octet_length("record") - F.octet_length("header") - 4)
    kept = rows.select("page_id", "sha256", "record_type", field(F.col("record"), "WARC-Payload-Digest").alias("said"), F.regexp_extract(field(F.col("header"), "WARC-Refers-To"), r"page:(-?\d+)", 1).alias("to"), F.when(F.col("record_type") == "response", body).alias("body"))
    measured = materialize(kept.select("page_id", "sha256", "record_type", "said", "to", F.octet_length("body").cast("long").alias("n"), base32_sha1(F.col("body")).alias("digest")), "warc-records")
    of = measured.where("record_type = 'response'").groupBy("sha256").agg(F.first("n").alias("own_n"), F.first("digest").alias("own_digest"))
    both = measured.join(of, "sha256", "left").withColumn("digest", F.coalesce("digest", "own_digest"))
    agree = F.when(F.col("said") == F.concat(F.lit("sha1:"), F.col("digest")), F.col("digest")).otherwise(F.raise_error(F.lit("header and payload disagree")))
    return both.select("page_id", F.coalesce("n", "own_n").alias("payload_bytes"), agree.alias("payload_digest"), "record_type", F.when(F.col("to") != "", F.col("to").cast("long")).alias("refers_to"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    return summary(spark, path, write_archive(table(spark, sf_dir, "pages"), path))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, sha1(body) AS h FROM p),
f AS (SELECT body, min(page_id) AS low FROM p GROUP BY body),
g AS (SELECT page_id, body, list_transform(range(8), lambda i: CAST('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS v FROM d)
SELECT g.page_id, CAST(strlen(g.body) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(v, lambda x: concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32768) % 32 + 1, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 1024) % 32 + 1, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32) % 32 + 1, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1))), 'string_agg', '') AS payload_digest,
  CASE WHEN g.page_id > f.low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.page_id > f.low THEN f.low END AS refers_to
FROM g JOIN f ON f.body = g.body
"""
