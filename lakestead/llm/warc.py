"""WARC archives written from a page table and read back as a table of chunks.

Writing: a page is one record. Of pages with equal payloads of at least ``least`` bytes the one with the
largest id is a response; the others are revisits without a block that refer to its record id. That id is made of the page's
id and payload digest, so it is the same wherever it is computed; records that nothing refers to are told apart by row. A payload longer than ``chunk``
characters is written as segments (response, then continuation records), so an archive is a table of
(record id, segment number) rows, each with the SHA-1 of its block. The archives are plain WARC/1.1 files
in the given folder, one or more per task, written by Spark's text writer, whose line end is the end of a record.

Reading: Spark's text reader splits the files at the start of records, wherever a file is cut. The writer
ends a segment inside any `WARC/1.1` line of a payload, so no payload holds that mark. Whole records are
digested as they are read. Chunks of segmented ones are dealt by record and sorted by number, and a
running SHA-1 takes one chunk at a time: no task holds a whole payload. Revisits meet the record
that they name, by its id alone.

Only payloads of segmented records are shuffled. Groups of equal payloads pre-aggregate; the joins have
written tables or exchanges on both sides, so adaptive planning can split a hot payload.

Defined cases: a null payload is empty. A null url leaves out the target. Blanks and control characters in a url
are written as %20. Repeated rows are one record each; where the largest id of a payload is repeated, all of its
rows are responses and one is referred to. A null id is less than all others; where all ids of a payload are null,
all of its records are responses. Ids are integers. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestead.llm.common import bind, written

END = "\r\n\r\n"
MARK = "WARC/1.1\r\n"
#: The profile that revisits of equal payloads name.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    least: int = 1000
    chunk: int = 1 << 16
    date: str = "2024-01-01T00:00:00Z"


def _chunks(body: Column, size: int) -> Column:
    """The text in pieces of at most size characters, none of which holds the mark."""
    parts = F.when(F.contains(body, F.lit(MARK)), F.split(body, r"(?<=WA)(?=RC/1\.1\r\n)")).otherwise(F.array(body))
    cut = lambda part: F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.char_length(part) / size).cast("int") - 1, F.lit(0))),
        lambda k: F.substring(part, k * size + 1, F.lit(size)),
    )
    return F.when(
        (F.char_length(body) <= size) & ~F.contains(body, F.lit(MARK)), F.array(body)
    ).otherwise(bind(parts, lambda p: F.flatten(F.transform(p, cut))))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, rules: Archive) -> DataFrame:
    """(value): the WARC records of pages(id, url, body), without the end of each."""
    sized = pages.select(
        "id", "url", "body", F.sha1(F.col("body").cast("binary")).alias("sha"), F.octet_length("body").alias("bytes")
    ).withColumn("row", F.monotonically_increasing_id())
    own_rows = sized.filter(F.col("bytes") >= rules.least).groupBy("sha", "bytes", "id")
    keeper = F.max(F.struct("id", "rows", "row"))
    groups = (
        own_rows.agg(F.count("*").alias("rows"), F.min("row").alias("row"))
        .groupBy("sha", "bytes")
        .agg(keeper.alias("top"), F.sum("rows").alias("n"))
        .filter("n > 1 and top.id is not null")
    )
    top = [F.col("top.id").alias("keeper"), F.col("top.rows").alias("keepers"), F.col("top.row").alias("keeper_row")]
    groups = written(groups.select(F.col("sha").alias("g_sha"), F.col("bytes").alias("g_bytes"), *top), "payloads")
    named = sized.join(groups, (F.col("sha") == F.col("g_sha")) & (F.col("bytes") == F.col("g_bytes")), "left")
    again = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    # Rows only tell records apart to which nothing refers, and the rows of a repeated id.
    target = (F.col("id") == F.col("keeper")) & ((F.col("keepers") == 1) | (F.col("row") == F.col("keeper_row")))
    tail = F.when(target, F.col("sha")).otherwise(F.col("row").cast("string"))
    urn = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), tail)
    named = named.withColumn("again", again).withColumn("urn", urn)
    pieces = F.when(F.col("again"), F.array(F.lit(""))).otherwise(_chunks(F.col("body"), rules.chunk))
    numbered = bind(
        pieces,
        lambda all_of: F.transform(
            all_of, lambda data, k: F.struct(k.alias("k"), data.alias("data"), F.size(all_of).alias("parts"))
        ),
    )
    chunked = named.select("id", "url", "sha", "keeper", "again", "urn", "bytes", F.inline(numbered))
    segmented = F.col("parts") > 1
    later = F.col("k") > 0
    block = F.when(F.col("again"), "").when(later, F.col("data")).otherwise(F.concat(F.lit(HTTP), F.col("data")))
    kind = F.when(F.col("again"), "revisit").when(later, "continuation").otherwise("response")
    own = F.when(later, F.concat("urn", F.lit(":"), F.col("k") + 1, F.lit(">"))).otherwise(F.concat("urn", F.lit(">")))
    return chunked.withColumn("block", block).select(
        F.concat(
            F.lit(MARK),
            _line("WARC-Type", kind),
            _line("WARC-Record-ID", own),
            _line("WARC-Date", F.lit(rules.date)),
            _line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))),
            _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("block").cast("binary")))),
            _line("WARC-Refers-To", F.when(F.col("again"), F.concat(F.lit("<urn:page:"), "keeper", F.lit(":"), "sha", F.lit(">")))),
            _line("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
            _line("WARC-Segment-Number", F.when(segmented, F.col("k") + 1)),
            _line("WARC-Segment-Origin-ID", F.when(later, F.concat("urn", F.lit(">")))),
            _line("WARC-Segment-Total-Length", F.when(segmented & (F.col("k") + 1 == F.col("parts")), F.col("bytes"))),
            _line("Content-Type", F.lit("application/http; msgtype=response")),
            F.lit("Content-Length: "),
            F.octet_length("block").cast("string"),
            F.lit(END),
            F.col("block"),
        ).alias("value")
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", rules: Archive = Archive()  # noqa: B008, E501
) -> None:
    body = F.coalesce(F.col(payload), F.lit(""))
    slim = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"))
    records(slim, rules).write.option("lineSep", END).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives: origin, segment (null if whole), type, refers (the record id that a
    revisit names), page_id, refers_to, digests as stated, data (payload bytes) and block_ok (the block has its stated digest)."""
    raw = spark.read.option("lineSep", END + MARK).text(path)
    text = F.regexp_replace("value", r"^WARC/1\.1\r\n", "")
    parted = raw.select(text.alias("value")).withColumn("head", F.substring_index("value", END, 1))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    length = field("Content-Length").cast("int")
    block = F.substring(F.col("value").cast("binary"), F.octet_length("head") + 5, length)
    parsed = parted.select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin"),
        field("WARC-Segment-Number").cast("int").alias("segment"),
        field("WARC-Type").alias("type"),
        field("WARC-Refers-To").alias("refers"),
        field("WARC-Payload-Digest").alias("stated"),
        field("WARC-Block-Digest").alias("block_digest"),
        block.alias("block"),
    )
    page = F.regexp_extract("origin", r"urn:page:(-?\d+):", 1)
    target = F.regexp_extract(F.coalesce("refers", F.lit("")), r"urn:page:(-?\d+):", 1)
    http = F.when(F.col("type") == "response", F.lit(len(HTTP))).otherwise(0)
    return parsed.select(
        "origin",
        "segment",
        "type",
        "refers",
        F.when(page != "", page).cast("long").alias("page_id"),
        F.when(target != "", target).cast("long").alias("refers_to"),
        F.substring("stated", 6, 40).alias("stated"),
        F.substring("block", http + 1, F.lit(1 << 30)).alias("data"),
        (F.concat(F.lit("sha1:"), F.sha1("block")) == F.col("block_digest")).alias("block_ok"),
    )


def _stream_digests(chunks: DataFrame) -> DataFrame:
    """(origin, bytes, sha) of segmented records, one chunk in memory at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(origin: str, size: int, digest) -> pa.RecordBatch:
            columns = [pa.array([origin]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=["origin", "bytes", "sha"])

        current, size, digest = None, 0, hashlib.sha1()
        for batch in batches:
            for origin, data in zip(batch.column("origin"), batch.column("data"), strict=True):
                if origin.as_py() != current:
                    if current is not None:
                        yield row(current, size, digest)
                    current, size, digest = origin.as_py(), 0, hashlib.sha1()
                digest.update(data.as_buffer())
                size += len(data.as_buffer())
        if current is not None:
            yield row(current, size, digest)

    dealt = chunks.repartition("origin").sortWithinPartitions("origin", "segment").select("origin", "data")
    return dealt.mapInArrow(work, "origin string, bytes long, sha string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, intact."""
    whole = F.col("segment").isNull()
    chunks = written(
        read_chunks(spark, path).select(
            "origin", "segment", "type", "refers", "page_id", "refers_to", "stated", "block_ok",
            F.octet_length("data").cast("long").alias("bytes"),
            F.when(whole, F.sha1("data")).alias("sha"),
            F.when(~whole, F.col("data")).alias("data"),
        ),
        "chunks",
    )
    single = chunks.filter(whole & (F.col("type") == "response")).select(
        "origin", "page_id", "bytes", "sha", "stated", "block_ok"
    )
    parts = chunks.filter(~whole)
    heads = parts.groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.max("stated").alias("stated"), F.bool_and("block_ok").alias("block_ok")
    )
    long = _stream_digests(parts).join(heads, "origin").select(
        "origin", "page_id", "bytes", "sha", "stated", "block_ok"
    )
    responses = written(single.unionByName(long), "responses")
    revisits = chunks.filter(F.col("type") == "revisit").select("page_id", "refers", "refers_to", F.col("stated").alias("digest"))
    targets = responses.select(
        F.col("origin").alias("refers"), "bytes", "sha", ((F.col("sha") == F.col("stated")) & F.col("block_ok")).alias("ok")
    )
    met = revisits.join(targets, "refers", "left")
    none = F.lit(None).cast("long")
    return responses.select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("sha").alias("payload_digest"),
        F.lit("response").alias("record_type"),
        none.alias("refers_to"),
        ((F.col("sha") == F.col("stated")) & F.col("block_ok")).alias("intact"),
    ).union(
        met.select(
            "page_id", "bytes", "digest", F.lit("revisit"), "refers_to",
            F.coalesce(F.col("ok") & (F.col("sha") == F.col("digest")), F.lit(False)),
        )
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keeper
  FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to, true AS intact
FROM k
"""
