"""A content-addressed WARC archive.

Payload bytes are stored once, in WARC files of ``resource`` records named by their
SHA-256. The exact head of every original record (WARC fields and, for responses,
the HTTP head) is kept in a table of its own. Original records come back by joining
the two; digests are verified whenever payloads are read.
"""

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.sources.shared import new_path

#: The alphabet of base32 digests and the separator of WARC records (fixed values).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Payload files hold as many records as fill this many bytes on average.
FILE_BYTES = 8 << 20


def base32_sha1(payload):
    """The upper-case base32 SHA-1 of a binary column, from groups of 20 bits."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _identity(page):
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _lines(*fields):
    """Head lines; a field with a null value is left out."""
    parts = [
        F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
        for name, value in fields
    ]
    return F.concat(F.lit("WARC/1.1\r\n"), *parts, F.lit("\r\n"))


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as an archive in ``folder``.

    Every row becomes a record whose payload is the html in UTF-8 (null: empty). Of
    rows with equal payloads of at least ``least_bytes`` bytes, that of the largest
    page_id is a response and the others revisit it; smaller payloads are all
    responses. Rows that repeat a page_id and its payload are alike; a null page_id
    is a response only if its payload has no other. A null url has no field, line
    ends in a url are percent-encoded. An empty table gives an archive without records,
    payloads are kept whole, however long. Other columns are not kept.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("content"),
    )
    # One row for each payload; copies are dropped in the reading tasks already.
    once = rows.groupBy("content").agg(
        F.first("html").alias("html"), F.max("page_id").alias("last")
    )
    size = F.octet_length("html")
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("html").cast("binary")))
    resource = _lines(
        ("WARC-Type", F.lit("resource")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:sha256:"), F.col("content"), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", size.cast("string")),
    )
    mean = rows.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    each = max(1, int(FILE_BYTES // max(1, mean)))
    once.select(F.concat(resource, "html").alias("value")).write.option(
        "lineSep", RECORD_END
    ).option("compression", "gzip").option("maxRecordsPerFile", each).text(f"{folder}/payloads")
    firsts = rows.select("content", "page_id").groupBy("content").agg(F.max("page_id").alias("last"))
    facts = rows.select(
        "page_id",
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        "content",
        F.octet_length("html").alias("size"),
        digest.alias("digest"),
    ).join(firsts, "content")
    response = F.col("page_id").eqNullSafe(F.col("last")) | (F.col("size") < least_bytes)
    head = _lines(
        ("WARC-Type", F.when(response, "response").otherwise("revisit")),
        ("WARC-Record-ID", _identity(F.col("page_id"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.col("digest")),
        ("WARC-Refers-To", F.when(~response, _identity(F.col("last")))),
        ("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        ("Content-Type", F.when(response, F.lit("application/http; msgtype=response"))),
        ("Content-Length", F.when(response, F.col("size") + len(HTTP_HEAD)).otherwise(0).cast("string")),
    )
    head = F.concat(head, F.when(response, F.lit(HTTP_HEAD)).otherwise(""))
    facts.select("content", head.alias("head")).write.parquet(f"{folder}/heads")


def parse_records(data: bytes):
    """Fields and block of each record in the bytes of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b": ")
            fields[name.decode()] = value.decode()
        size = int(fields["Content-Length"])
        begin = end + 4
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError("a record is not followed by its separator")
        yield fields, data[begin : begin + size]
        at = begin + size + 4


def _read(whole):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                names, sizes, digests, blocks = [], [], [], []
                data = zlib.decompress(batch.column(0)[i].as_py(), 31)
                for fields, block in parse_records(data):
                    content = fields["WARC-Record-ID"].removeprefix("<urn:sha256:").rstrip(">")
                    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
                    if hashlib.sha256(block).hexdigest() != content:
                        raise ValueError(f"payload {content} does not have its digest")
                    if fields["WARC-Payload-Digest"] != f"sha1:{sha1}":
                        raise ValueError(f"payload {content} does not have its SHA-1")
                    names.append(content)
                    sizes.append(len(block))
                    digests.append(sha1)
                    blocks.append(block if whole else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                     pa.array(blocks, pa.binary())],
                    ["content", "payload_bytes", "payload_digest", "payload"],
                )

    return run


def read_payloads(spark, folder: str, whole: bool = True) -> DataFrame:
    """``content, payload_bytes, payload_digest, payload`` of the verified payloads."""
    files = spark.read.format("binaryFile").load(f"{folder}/payloads/*.txt.gz")
    return files.select("content").mapInArrow(
        _read(whole), "content string, payload_bytes bigint, payload_digest string, payload binary"
    )


def read_heads(spark, folder: str) -> DataFrame:
    return spark.read.schema("content string, head string").parquet(f"{folder}/heads")


def original_records(spark, folder: str) -> DataFrame:
    """``head, record``: the bytes of every record as a WARC file would hold them."""
    heads = read_heads(spark, folder)
    joined = heads.join(read_payloads(spark, folder), "content")
    revisit = F.col("head").startswith("WARC/1.1\r\nWARC-Type: revisit")
    block = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("head").cast("binary"), block, F.lit(RECORD_END.encode()))
    return joined.select("head", record.alias("record"))


def read_archive(spark, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of all records.

    Sizes and digests are those of the verified full payload, the rest comes from
    the heads.
    """
    def field(pattern):
        return F.nullif(F.regexp_extract("head", pattern, 1), F.lit(""))

    heads = read_heads(spark, folder).select(
        "content",
        field(r"(?m)^WARC-Record-ID: <urn:x-page:(-?\d+)>").cast("bigint").alias("page_id"),
        field(r"(?m)^WARC-Type: (\w+)").alias("record_type"),
        field(r"(?m)^WARC-Refers-To: <urn:x-page:(-?\d+)>").cast("bigint").alias("refers_to"),
    )
    return heads.join(read_payloads(spark, folder, whole=False), "content").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write an archive of ``pages`` in the shared folder and read it back."""
    folder = new_path(pages.sparkSession, "warc")
    write_archive(pages, folder, least_bytes)
    return read_archive(pages.sparkSession, folder)
