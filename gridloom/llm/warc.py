"""WARC archives: writing with payload dedup, and reading by boundary-chain verification.

Written archives are plain WARC/1.1. Spark's text writer writes the records as bytes under its
commit protocol. The reader splits files at the version line wherever it stands, also inside a payload,
so large files are read by many tasks. Each piece is a candidate record: its header gives the offset of
its successor. Pointer jumping from the start of each file, which doubles the distance per round, keeps the
candidates on the chain; a version line inside a payload is on no chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import as_bytes, written
from gridloom.session import fresh_path

MAGIC = "WARC/1.1\r\n"
LEAST_SHARED = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least_shared: int = LEAST_SHARED) -> None:
    """One record per row of `pages` in archives under `folder`.

    Of the rows with equal payloads of `least_shared` bytes or more those with the largest key are
    response records; the others, rows with a null key among them, revisit it. Smaller payloads, and payloads of
    which no row has a key, are responses. A null payload is empty.
    """
    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), as_bytes(html).alias("payload"))
    sums = rows.select("key", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")).where(F.col("size") >= least_shared)
    shared = sums.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("key").cast("string").alias("first")).where("n > 1 and first is not null")
    shared = written(shared.select(F.col("digest").alias("of"), "first"), "shared-payloads")
    digest = F.when(F.octet_length("payload") >= least_shared, F.sha1("payload"))
    placed = rows.withColumn("digest", digest).join(shared, F.col("digest") == F.col("of"), "left")
    _record_bytes(placed).write.option("lineSep", "\n").text(folder)


def _record_bytes(placed: DataFrame) -> DataFrame:
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    body = F.when(again, F.lit(b"")).otherwise(F.col("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    name = F.coalesce("id", F.lit(""))
    header = F.concat(
        F.lit(MAGIC),
        F.when(again, _line("WARC-Type", "revisit")).otherwise(_line("WARC-Type", "response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        _line("WARC-Date", DATE),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "%0A")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        F.when(again, F.concat(_line("WARC-Profile", PROFILE), _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">"))))).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
    )
    # the writer's line feed is the last byte of the two line ends behind a record
    return placed.select(F.concat(header.cast("binary"), http.cast("binary"), body, F.lit(b"\r\n\r")).cast("string").alias("value"))


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(file, split, row, piece): the bytes between version lines, in the order of `row` within a split."""
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("piece")
    )


def _with_offsets(rows: DataFrame) -> DataFrame:
    """`offset`, the place of the version line before each piece, from the running sum of (size) in two steps: in
    a split, whose size the reader bounds, and over the splits of a file."""
    step = F.col("size") + len(MAGIC)
    inside = F.sum(step).over(Window.partitionBy("file", "split").orderBy("row")) - step
    splits = rows.groupBy("file", "split").agg(F.sum(step).alias("total"))
    before = F.sum("total").over(Window.partitionBy("file").orderBy("split")) - F.col("total")
    starts = splits.select("file", "split", before.alias("before"))
    return rows.withColumn("inside", inside).join(starts, ["file", "split"]).withColumn("offset", F.col("before") + F.col("inside") - len(MAGIC)).drop("before", "inside")


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _parsed(pieces: DataFrame) -> DataFrame:
    """The header fields of each piece, taken as a record; null where it has no complete header."""
    text = F.col("piece").cast("string")
    end = F.octet_length(F.substring_index(text, "\r\n\r\n", 1).cast("binary"))
    found = pieces.withColumn("size", F.octet_length("piece").cast("long")).withColumn("header_size", end)
    found = found.withColumn("header", F.when(F.col("header_size") < F.col("size"), F.substring("piece", F.lit(1), F.col("header_size")).cast("string")))
    length = _field("Content-Length").try_cast("long")
    found = found.select(
        "file",
        "split",
        "row",
        "size",
        "piece",
        (F.col("header_size") + 4).cast("long").alias("body_at"),
        length.alias("length"),
        F.lower(_field("WARC-Type")).alias("type"),
        _field("WARC-Record-ID").alias("record"),
        _field("WARC-Refers-To").alias("refers"),
        _field("WARC-Payload-Digest").alias("declared"),
    )
    return found.withColumn("length", F.when(F.col("length") >= 0, F.col("length")))


def _measured(block: Column) -> list[Column]:
    """Size, digest and declared size of the HTTP payload in a record's block."""
    text = block.cast("string")
    head = F.octet_length(F.substring_index(text, "\r\n\r\n", 1).cast("binary"))
    payload = F.substring(block, head + 5, F.octet_length(block))
    said = F.regexp_extract(F.substring(block, F.lit(1), head).cast("string"), r"(?i)\r\nContent-Length:[ \t]*([0-9]+)", 1)
    return [F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"), F.nullif(said, F.lit("")).cast("long").alias("said_bytes")]


def on_chain(candidates: DataFrame) -> DataFrame:
    """The (file, offset) of `candidates` (file, offset, next) that the chain from offset 0 of their file reaches.

    Round k knows the candidates within 2^k records of the start and where 2^k records on leads to.
    """
    jump = written(candidates.where(F.col("next").isNotNull()).select("file", "offset", "next"), "jumps")
    reached = written(candidates.where("offset = 0").select("file", "offset").distinct(), "reached")
    while True:
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        fresh = written(step.join(reached, ["file", "offset"], "left_anti"), "reached")
        if fresh.isEmpty():
            return reached.join(candidates.select("file", "offset"), ["file", "offset"], "left_semi")
        reached = written(reached.unionByName(fresh), "reached")
        far = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = written(jump.join(far, ["file", "next"]).select("file", "offset", F.col("far").alias("next")), "jumps")


def read_archives(spark: SparkSession, folder: str, key: str = "page_id") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of every record of the archives in `folder`.

    Digest and size of a response are those of the payload that was read; a revisit has those that it declares.
    A record whose payload holds version lines is put together from its pieces. A record without a numeric page in its
    id has a null key; repeated records come back as often; other types are left out; no archives, no rows.
    """
    parsed = _parsed(_pieces(spark, folder))
    complete = F.col("size") >= F.col("body_at") + F.col("length")
    block = F.when(complete, F.substring("piece", F.col("body_at").cast("int") + 1, F.col("length").cast("int")))
    found = parsed.select("file", "split", "row", "size", "body_at", "length", "type", "record", "refers", "declared", complete.alias("complete"), *_measured(block))
    placed = written(_with_offsets(written(found, "pieces")), "candidates")
    heads = placed.where("offset >= 0").withColumn("next", F.col("offset") + len(MAGIC) + F.col("body_at") + F.col("length") + 4)
    chain = on_chain(heads)
    records = heads.join(chain, ["file", "offset"], "left_semi")
    broken = records.where(~F.coalesce("complete", F.lit(False)) & F.col("next").isNotNull())
    if not broken.isEmpty():
        records = records.where(F.coalesce("complete", F.lit(False)) | F.col("next").isNull()).unionByName(_joined_pieces(spark, folder, placed, written(broken, "broken-records")))
    page = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:([^>]*)>", 1), F.lit(""))
    revisit = F.col("type") == "revisit"
    return records.where(F.col("type").isin("response", "revisit")).select(
        page("record").cast("long").alias(key),
        F.when(revisit, F.col("said_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_extract("declared", "^sha1:(.*)$", 1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page("refers").cast("long")).alias("refers_to"),
    )


def _joined_pieces(spark: SparkSession, folder: str, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """The records of `broken` measured over all of their pieces; a record is as large as its declared length."""
    files = broken.select("file").distinct()
    again = _pieces(spark, folder).join(files, "file", "left_semi")
    located = _with_offsets(again.withColumn("size", F.octet_length("piece").cast("long")))
    of = broken.select(F.col("file").alias("in_file"), F.col("offset").alias("from"), F.col("next").alias("until"))
    # a piece belongs to the last chained record at or before it: one running maximum per file, no range join
    marks = located.select("file", "offset", "piece", F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("until")).unionByName(
        of.select(F.col("in_file").alias("file"), F.col("from").alias("offset"), F.lit(None).cast("binary").alias("piece"), "from", "until")
    )
    upto = Window.partitionBy("file").orderBy("offset", F.col("piece").isNotNull())
    owned = marks.withColumn("from", F.last("from", True).over(upto)).withColumn("until", F.last("until", True).over(upto))
    inside = owned.where(F.col("piece").isNotNull() & (F.col("offset") < F.col("until")))
    whole = inside.groupBy("file", "from").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("pieces"))
    joined = F.aggregate(F.slice("pieces", F.lit(2), F.size("pieces")), F.element_at("pieces", 1)["piece"], lambda done, x: F.concat(done, F.lit(MAGIC.encode()), x["piece"]))
    bodies = whole.select("file", F.col("from").alias("offset"), joined.alias("record_bytes"))
    rest = broken.drop("payload_bytes", "payload_digest", "said_bytes")
    block = F.substring("record_bytes", F.col("body_at").cast("int") + 1, F.col("length").cast("int"))
    return rest.join(bodies, ["file", "offset"]).select(*rest.columns, *_measured(block))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write `pages` as archives in the shared folder and read them back.

    Every row gives a record: repeated rows, null keys, urls and payloads and empty payloads too. An empty table gives no rows.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, folder, key, url, html)
    return read_archives(pages.sparkSession, folder, key)
