r"""WARC archives: written and read by Spark's text source, with the record chain verified.

Writing: one string per record (head, HTTP head, payload) through the text sink, whose line separator is the
blank line that ends a WARC record, so that the files are plain WARC/1.1.

Reading: splits are cut at every magic line, also at those inside payloads. Each task emits, per candidate, its
offset and the offset its lengths point to (its successor). Neighbours whose successor is the next candidate
of the same split are contracted to runs; pointer jumping from offset 0 of each file, over runs, keeps what
the chain reaches. A chain that does not end at the end of its file raises an error, and so does a payload
whose digest is not the one in its head.

Defined results: null html is an empty payload, null urls have no target header, null page_ids are written
without a record id and never revisit. Rows that repeat the smallest page_id of a payload are all responses.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from retentia.llm.common import table, written
from retentia.session import cut_lineage, scratch

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
MIN_SHARED_BYTES = 100
RECORDS_PER_FILE = 100_000
# Revisit rows are 100 bytes each as a hashed relation; more are joined by shuffle.
MAX_BROADCAST_REVISITS = 500_000
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def payloads(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("size"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
    )


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the rows whose payload a smaller page_id has."""
    big = payloads(pages).where(F.col("size") >= MIN_SHARED_BYTES).select("page_id", "digest")
    shared = big.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("last > refers_to")
    return big.join(shared.drop("last"), "digest").where("page_id > refers_to").distinct()


def write_warc(pages: DataFrame, path: str) -> None:
    refs = written(revisits(pages), "op6-revisits")
    if refs.count() <= MAX_BROADCAST_REVISITS:
        refs = F.broadcast(refs)
    rows = payloads(pages).join(refs, ["page_id", "digest"], "left")
    http = F.concat(F.lit(HTTP_HEAD), F.col("size").cast("string"), F.lit(END))
    is_revisit = F.col("refers_to").isNotNull()

    def field(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    uri = F.replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("WARC/1.1"), F.lit("WARC%2F1.1"))
    record = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(is_revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        field("Content-Length", F.when(is_revisit, F.lit("0")).otherwise((F.octet_length(http) + F.col("size")).cast("string"))),
        F.lit("\r\n"),
        F.when(is_revisit, F.lit("")).otherwise(F.concat(http, F.col("html"))),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """Text after each magic line, in file order by (file, block, at); the first of a file precedes any magic."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value"),
    )


def _bytes(text) -> F.Column:
    return F.octet_length(text).cast("long")


def _payload(block) -> F.Column:
    """Bytes after the HTTP head of a record block."""
    head = F.substring_index(block.cast("string"), END, 1)
    return F.substring(block, F.octet_length(head) + len(END) + 1, F.greatest(F.octet_length(block) - F.octet_length(head) - len(END), F.lit(0)))


def _head_field(name: str) -> F.Column:
    found = F.regexp_extract("head", rf"(?i)(?:^|\n){name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per magic line: file, block, at, offset, successor (null: no record head), head, complete, digest, size.

    digest and size are those of the payload if the record ends where the next magic line begins.
    """
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract("head", r"(?i)(?:^|\n)Content-Length: *(\d{1,18})\r?(?:\n|$)", 1).try_cast("long")
    parsed = (
        chunks(spark, path)
        .withColumn("head", head)
        .withColumn("bytes", _bytes("value"))
        .withColumn("length", F.when(F.instr("value", END) > 0, length))
        .withColumn("body", _bytes("head") + len(END))
        .withColumn("complete", F.coalesce(F.col("bytes") == F.col("body") + F.col("length") + len(END), F.lit(False)))
        .withColumn("block_bytes", F.when(F.col("complete"), F.substring(F.col("value").cast("binary"), (F.col("body") + 1).cast("int"), F.col("length").cast("int"))))
        .withColumn("payload", _payload(F.col("block_bytes")))
        .select("file", "block", "at", "bytes", "head", "length", "body", "complete",
                F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"), F.sha2("value", 256).alias("mark"))
    )
    rows = written(parsed, "op6-candidates")
    # Offsets: bytes of the blocks before, then of the chunks before within the block.
    step = F.col("bytes") + len(MAGIC)
    before = (
        rows.groupBy("file", "block").agg(F.sum(step).alias("total"))
        .withColumn("base", F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    run = Window.partitionBy("file", "block").orderBy("at")
    begin = F.coalesce(F.sum(step).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("begin", begin).join(before.drop("total"), ["file", "block"])
        .withColumn("offset", F.col("base") + F.col("begin") - len(MAGIC))
        .withColumn("successor", F.col("offset") + len(MAGIC) + F.col("body") + F.col("length") + len(END))
        .withColumn("ends", F.col("offset") + len(MAGIC) + F.col("bytes"))
        .drop("bytes", "body", "length", "begin", "base")
    )


def reachable(found: DataFrame) -> DataFrame:
    """Rows of `found` (candidates) that the chain from offset 0 of their file reaches."""
    order = Window.partitionBy("file", "block").orderBy("offset")
    linked = found.where("offset >= 0 AND successor IS NOT NULL").withColumn("next", F.lead("offset").over(order)).withColumn("previous", F.lag("successor").over(order))
    # Where the chain may enter: the successors that are not simply the next candidate of the block.
    entries = linked.where("next IS NULL OR next != successor").select("file", F.col("successor").alias("offset")).distinct().withColumn("entry", F.lit(True))
    starts = F.col("entry").isNotNull() | F.col("previous").isNull() | (F.col("previous") != F.col("offset"))
    runs = linked.join(entries, ["file", "offset"], "left").withColumn("run", F.max(F.when(starts, F.col("offset"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = written(runs.drop("next", "previous", "entry"), "op6-runs")
    jump = runs.groupBy("file", F.col("run").alias("node")).agg(F.max_by("successor", "offset").alias("to"))
    reached = jump.where("node = 0").select("file", "node")
    known = 0
    while True:
        reached = cut_lineage(reached)
        n = reached.count()
        if n == known:
            break
        known = n
        ahead = reached.join(jump, ["file", "node"]).select("file", F.col("to").alias("node"))
        # Offsets that are no run start lead nowhere (the end of a file).
        ahead = ahead.join(jump.select("file", "node"), ["file", "node"], "left_semi")
        reached = reached.union(ahead).distinct()
        twice = jump.alias("a").join(jump.alias("b"), F.expr("a.file = b.file AND a.to = b.node"), "left")
        jump = cut_lineage(twice.selectExpr("a.file AS file", "a.node AS node", "coalesce(b.to, a.to) AS to"))
    return runs.join(reached.withColumnRenamed("node", "run"), ["file", "run"]).drop("run")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below `path`: type, record_id, refers_to, target_uri, digest, size."""
    found = written(candidates(spark, path), "op6-offsets")
    records = written(reachable(found), "op6-records")
    ends = found.groupBy("file").agg(F.max("ends").alias("length"))
    chain = records.groupBy("file").agg(F.max("successor").alias("chain"))
    broken = ends.where("length > 0").join(chain, "file", "left").where("chain IS NULL OR chain != length")
    bad = broken.take(1)
    if bad:
        raise ValueError(f"the record chain of {bad[0]['file']} breaks off at {bad[0]['chain']} of {bad[0]['length']} bytes")
    whole = records.where("complete")
    split = records.where("NOT complete")
    if split.take(1):
        # Payloads with magic lines inside: their chunks are read again, found by the digest of their text, which does
        # not depend on how either read splits the files, and put together by offset.
        order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
        marked = found.where("offset >= 0").join(records.select("file", "offset", F.lit(True).alias("is_record")), ["file", "offset"], "left")
        owner = marked.withColumn("owner", F.max(F.when(F.col("is_record"), F.col("offset"))).over(order)).select("file", "offset", "owner", "mark")
        parts = written(owner.join(split.select("file", F.col("offset").alias("owner")), ["file", "owner"]), "op6-parts")
        again = chunks(spark, path).select(F.sha2("value", 256).alias("mark"), "value").join(parts.select("mark").distinct(), "mark", "left_semi")
        texts = again.groupBy("mark").agg(F.min("value").alias("value"))
        # A chunk that the second read does not find is an error, never a record less.
        value = F.coalesce("value", F.raise_error(F.concat(F.lit("a chunk has changed between reads of "), F.col("file"))).cast("string"))
        text = (
            parts.join(texts, "mark", "left").groupBy("file", "owner")
            .agg(F.array_sort(F.collect_list(F.struct("offset", value.alias("value")))).alias("parts"))
            .select("file", F.col("owner").alias("offset"), F.array_join("parts.value", MAGIC).alias("value"))
        )
        body = F.octet_length(F.substring_index("value", END, 1)) + len(END)
        block = F.substring(F.col("value").cast("binary"), body + 1, F.octet_length("value") - body - len(END))
        joined = split.drop("digest", "size").join(text, ["file", "offset"]).withColumn("payload", _payload(block))
        whole = whole.unionByName(joined.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long")).drop("payload", "value"))
    kind, stated = _head_field("WARC-Type"), F.regexp_replace(_head_field("WARC-Payload-Digest"), "^sha256:", "")
    is_revisit = kind == "revisit"
    checked = F.when(is_revisit | stated.isNull() | (stated == F.col("digest")), F.coalesce(F.when(is_revisit, stated), F.col("digest"))).otherwise(
        F.raise_error(F.concat(F.lit("digest mismatch in "), F.col("file"), F.lit(" at "), F.col("offset").cast("string")))
    )
    return whole.select(
        kind.alias("type"), _head_field("WARC-Record-ID").alias("record_id"), _head_field("WARC-Refers-To").alias("refers_to"),
        _head_field("WARC-Target-URI").alias("target_uri"), checked.alias("digest"),
        F.when(is_revisit, _head_field("X-Payload-Length").try_cast("long")).otherwise(F.col("size")).alias("size"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "op6-warc")
    write_warc(table(spark, sf_dir, "pages"), path)

    def page(column):
        return F.regexp_extract(column, "^<urn:page:(.*)>$", 1).try_cast("long")

    return read_warc(spark, path).select(
        page("record_id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY digest)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND size >= 100
"""

QUERIES = {"op6_warc": op6_warc}
ORACLES = {"op6_warc": ORACLE}
