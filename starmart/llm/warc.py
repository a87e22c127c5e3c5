"""WARC archives: writing, reading, and reassembly of segments (operator 7).

Records are written by Spark's text writer, one record per row with the
record's closing pair of line ends as line separator, so the files lie wherever
Spark can write. Payloads go through a chunked HTTP body; blocks longer than
``SEGMENT_CHARS`` are split into a first segment and continuation records.
Reading parses whole files by record lengths, groups segments by the identifier
of their origin, orders them by number, verifies the total length and undoes
the chunks.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.staging import Staging

# Blocks are cut after so many code points, chunks after so many.
SEGMENT_CHARS = 16_384
CHUNK_CHARS = 4_096
# A reader holds one file at a time, so files take few records.
RECORDS_PER_FILE = 1_000
LEAST_SHARED_BYTES = 100
_END = "\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
# A part that tells rows with one page id apart, and the page id.
_ID = "<urn:starmart:page{}:{}>"
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")

RECORD = (
    "record_id STRING, origin_id STRING, segment BIGINT, total_length BIGINT, record_type STRING, "
    "refers_to STRING, uri STRING, payload_digest STRING, payload_length BIGINT, block BINARY"
)


class WarcError(ValueError):
    """An archive that breaks the format."""


def chunked(text: str) -> str:
    """Chunked transfer framing; lengths count UTF-8 bytes."""
    parts = []
    for i in range(0, len(text), CHUNK_CHARS):
        piece = text[i : i + CHUNK_CHARS]
        parts.append(f"{len(piece.encode()):x}\r\n{piece}\r\n")
    return "".join(parts) + "0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Undoes chunked framing; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise WarcError("chunk without a size")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        if len(parts[-1]) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise WarcError("chunk of a wrong length")
        at = end + 4 + size


def _record(kind: str, record_id: str, block: str, **headers) -> str:
    lines = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": _DATE, **headers}
    head = "".join(
        f"{k.replace('_', '-')}: {v}\r\n" for k, v in lines.items() if v is not None
    )
    return f"WARC/1.1\r\n{head}Content-Length: {len(block.encode())}\r\n\r\n{block}"


def records_of(
    name: str, uri: str, payload: str, first: str | None, part: str = "", first_part: str = ""
) -> list[str]:
    """The records of one page, without their closing line ends: a revisit of
    ``first``, or a response in one or more segments. The parts tell the page
    and the first one from others with their ids."""
    data = payload.encode("utf-8", "surrogatepass")
    own = _ID.format(part, name)
    common = {
        # A line end would close the header.
        "WARC_Target_URI": re.sub(r"[\r\n]+", " ", uri),
        "WARC_Payload_Digest": f"sha256:{hashlib.sha256(data).hexdigest()}",
        "X_Payload_Length": len(data),
    }
    if first is not None:
        return [_record("revisit", own, "", WARC_Refers_To=_ID.format(first_part, first), **common)]
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        "Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    )
    pieces = [block[i : i + SEGMENT_CHARS] for i in range(0, len(block), SEGMENT_CHARS)]
    if len(pieces) == 1:
        return [_record("response", own, block, **common)]
    out = [_record("response", own, pieces[0], WARC_Segment_Number=1, **common)]
    for n, piece in enumerate(pieces[1:], 2):
        total = len(block.encode()) if n == len(pieces) else None
        out.append(
            _record(
                "continuation", f"{own[:-1]}:{n}>", piece, WARC_Segment_Origin_ID=own,
                WARC_Segment_Number=n, WARC_Segment_Total_Length=total,
            )
        )
    return out


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Writes a record per page below ``path``, gzipped. Of pages with equal
    payloads of LEAST_SHARED_BYTES or more those with the smallest id hold the
    payload (each row, if that id repeats), others revisit it; smaller payloads
    are all held. Null html is an empty payload, a null id is written as empty
    and never the smallest unless all are. Record identifiers are unique: those
    of rows that share an id, or have none, hold the digest and a number."""
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    again = rows.groupBy(F.col("id").alias("known")).agg(F.count(F.lit(1)).alias("n"))
    # Written first: Spark then knows whether they are small enough to broadcast,
    # before it shuffles any html.
    staging = Staging(pages.sparkSession)
    again = staging.save(again.where("n > 1").select("known"), "again")
    same = F.col("id").eqNullSafe(F.col("known"))
    digest = F.unhex(F.sha2(F.col("html"), 256))
    # Only rows that share an id are shuffled to be numbered.
    nth = F.row_number().over(Window.partitionBy("id", "digest").orderBy("url"))
    number = F.when(nth > 1, F.concat(F.lit("."), nth.cast("string"))).otherwise(F.lit(""))
    alike = rows.join(again, same, "left_semi").withColumn("digest", digest)
    alike = alike.withColumn("part", F.concat(F.lit("-"), F.hex("digest"), number))
    single = rows.join(again, same, "left_anti").withColumn("digest", digest)
    named = single.withColumn("part", F.lit("")).unionByName(alike)
    rows = rows.withColumn("digest", digest)
    first = (
        rows.where(F.octet_length("html") >= LEAST_SHARED_BYTES)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
        .join(again, F.col("first").eqNullSafe(F.col("known")), "left")
        .withColumn(
            "first_part",
            # The first of its rows; if first is null, all rows hold the payload.
            F.when(F.col("first").isNotNull() & F.col("known").isNotNull(),
                   F.concat(F.lit("-"), F.hex("of"))).otherwise(F.lit("")),
        )
        .drop("known")
    )
    first = staging.save(first, "first")
    held = named.join(first, F.col("digest") == F.col("of"), "left").select(
        "id", "url", F.when(F.col("id").eqNullSafe(F.col("first")), None)
        .otherwise(F.col("first")).alias("first"),
        "html", "part", "first_part",
    )

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for name, url, first_id, html, own, first_part in part.itertuples(index=False):
                found += records_of(name, url, html, first_id or None, own, first_part or "")
            yield pd.DataFrame({"record": found})

    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    texts = held.select(
        name.alias("id"), "url", F.coalesce(F.col("first").cast("string"), F.lit("")).alias("first"),
        # A revisit needs digest and length alone, but those are of the payload.
        "html", "part", F.coalesce("first_part", F.lit("")).alias("first_part"),
    )
    records = texts.mapInPandas(write, "record STRING")
    records.write.options(
        lineSep=_END, compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE
    ).text(path)
    staging.drop()


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, plain or gzipped."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise WarcError(f"no record at byte {at}")
        body = data.find(b"\r\n\r\n", at)
        if body < 0:
            raise WarcError("a header does not end")
        start = data.find(b"\r\n", at) + 2
        headers = {
            m[1].decode().lower(): m[2].decode("utf-8", "replace").strip()
            for m in _HEADER.finditer(data, start, body + 2)
        }
        size = int(headers["content-length"])
        block = data[body + 4 : body + 4 + size]
        at = body + 4 + size + 4
        if len(block) != size or data[at - 4 : at] != b"\r\n\r\n":
            raise WarcError("a block has a wrong length")
        yield headers, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``; segment 1 for records that are whole."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for part in parts:
            for content in part["content"]:
                rows = []
                for h, block in parse(bytes(content)):
                    total = h.get("warc-segment-total-length")
                    length = h.get("x-payload-length")
                    own = h["warc-record-id"]
                    rows.append(
                        (
                            own,
                            h.get("warc-segment-origin-id", own),
                            int(h.get("warc-segment-number", 0)),
                            None if total is None else int(total),
                            h["warc-type"],
                            h.get("warc-refers-to"),
                            h.get("warc-target-uri"),
                            h.get("warc-payload-digest"),
                            None if length is None else int(length),
                            block,
                        )
                    )
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=names).astype(_NUMBERS)
                        rows = []
                yield pd.DataFrame(rows, columns=names).astype(_NUMBERS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return files.select("content").mapInPandas(read, RECORD)


_NUMBERS = {"segment": "Int64", "total_length": "Int64", "payload_length": "Int64"}


def reassembled(records: DataFrame) -> DataFrame:
    """One row per origin: whole records as they are, segments joined in order.
    Only segments are shuffled; a group is one record. A record whose segments
    are not 1 to n, or whose length is not the stated total, raises."""
    whole = records.where("segment = 0").select(
        "record_id", "record_type", "refers_to", "uri", "payload_digest", "payload_length", "block"
    )
    parts = records.where("segment > 0").select(
        "origin_id",
        "total_length",
        F.when(F.col("segment") == 1, F.struct(
            "record_type", "refers_to", "uri", "payload_digest", "payload_length"
        )).alias("head"),
        F.struct("segment", "block").alias("part"),
    )
    grouped = parts.groupBy("origin_id").agg(
        F.max("total_length").alias("total"),
        # A repeated record repeats its segments: equal ones count once.
        F.array_sort(F.collect_set("part")).alias("parts"),
        F.first("head", ignorenulls=True).alias("head"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    joined = F.aggregate(
        "parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["block"])
    )
    joined = grouped.withColumn("block", joined)
    fits = (numbers == F.sequence(F.lit(1).cast("bigint"), F.size("parts").cast("bigint"))) & (
        F.octet_length("block") == F.col("total")
    )
    message = F.concat(F.lit("segments of "), "origin_id", F.lit(" do not make a whole record"))
    block = F.when(F.coalesce(fits, F.lit(False)), F.col("block")).otherwise(
        F.raise_error(message).cast("binary")
    )
    return whole.unionByName(
        joined.select(
            F.col("origin_id").alias("record_id"), "head.record_type", "head.refers_to",
            "head.uri", "head.payload_digest", "head.payload_length", block.alias("block"),
        )
    )


def payload(block: bytes) -> bytes:
    """The HTTP body of a response block, chunks undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" in head.lower():
        return dechunked(body)
    return body


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, uri, record_type, refers_to, payload, payload_bytes,
    payload_digest): a row per response and revisit. Length and digest of a
    response are computed from its payload and must agree with the stated ones;
    a revisit has no payload and states those of what it refers to."""

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            bodies, sizes, digests = [], [], []
            for row in part.itertuples(index=False):
                stated = (row.payload_digest or "").removeprefix("sha256:")
                if row.record_type == "revisit":
                    bodies.append(None)
                    sizes.append(int(row.payload_length))
                    digests.append(stated)
                    continue
                body = payload(bytes(row.block))
                digest = hashlib.sha256(body).hexdigest()
                if stated and stated != digest:
                    raise WarcError(f"{row.record_id}: payload differs from its digest")
                bodies.append(body)
                sizes.append(len(body))
                digests.append(digest)
            yield part[["record_id", "uri", "record_type", "refers_to"]].assign(
                payload=bodies, payload_bytes=sizes, payload_digest=digests
            )

    return reassembled(read_records(spark, path)).mapInPandas(
        decode,
        "record_id STRING, uri STRING, record_type STRING, refers_to STRING, payload BINARY, "
        "payload_bytes BIGINT, payload_digest STRING",
    )


def page_id_of(record_id):
    """The page id in a record identifier of ``write_warc``."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:starmart:page(?:-[^:]*)?:([^:>]*)", 1), F.lit(""))
