"""WARC: a content-addressed archive of pages.

Payload bytes are stored once, under their SHA-256; the exact header block of every record
is stored by itself.  Of records with equal payloads of at least MIN_REVISIT bytes the one
with the smallest id is a response and the others are revisits that refer to it.  Reading
back recomputes every stored payload's digest, parses the header blocks and joins the two;
``records`` gives the bytes of each WARC record as they would stand in a file.

Defined results: a null payload is empty; a null url has no target line, line breaks in a
url are percent-encoded; of equal payloads null ids come after all others; rows that repeat
id and payload are all responses if that id is the smallest; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import stored, text_of

MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _urn(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def header_block(date: str = DATE) -> Column:
    """The header block of a row with id, url, digest, payload_bytes and first (the id that a
    revisit refers to, null for a response)."""
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def when(test, value):
        return F.when(test, value).otherwise(F.lit(""))

    revisit = F.col("revisit")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        when(revisit, line("WARC-Refers-To", _urn(F.col("first")))),
        when(revisit, line("WARC-Profile", F.lit(PROFILE))),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """(payloads, headers) as written to the shared folder."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text_of(payload_col).alias("payload"))
    # the payload itself is the grouping key: equal digests of other bytes could not be taken for copies
    payloads = (rows.groupBy("payload").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
                .select(F.sha2("payload", 256).alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                        "first", "copies"))
    payloads = stored(payloads, "payloads")
    copied = payloads.where((F.col("copies") > 1) & (F.col("payload_bytes") >= MIN_REVISIT)).select("digest", "first")
    listed = (rows.select("id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
              .join(copied, "digest", "left")
              .withColumn("revisit", F.coalesce(F.col("first") != F.col("id"), F.col("first").isNotNull())))
    headers = stored(listed.select("id", header_block(date).alias("header")), "headers")
    return payloads.select("digest", "payload"), headers


def _field(name: str) -> Column:
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(payloads: DataFrame, headers: DataFrame, id_type: str = "long") -> DataFrame:
    """A row per record: id, record_type, refers_to, header, payload, payload_bytes,
    payload_digest.  Payloads whose bytes don't give their digest are an error."""
    def named(name):
        return F.regexp_extract(_field(name), "^<urn:page:(.*)>$", 1)

    checked = payloads.select(F.col("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                              F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(
                                  F.raise_error(F.concat(F.lit("payload doesn't give its digest "), "digest"))).alias("payload_digest"))
    parsed = headers.select(F.when(named("WARC-Record-ID") != "", named("WARC-Record-ID")).cast(id_type).alias("id"), "header",
                            _field("WARC-Type").alias("record_type"), named("WARC-Refers-To").cast(id_type).alias("refers_to"),
                            F.regexp_extract(_field("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("digest"))
    return parsed.join(checked, "digest").drop("digest")


def records(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """id and the bytes of each record: header block, body (none for a revisit), two line ends."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    return read_archive(payloads, headers).select(
        "id", F.concat("header", body, F.lit(CRLF * 2)).cast("binary").alias("record"))
