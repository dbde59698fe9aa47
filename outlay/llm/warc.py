"""WARC archives: segmented records with chunked HTTP bodies, written and put together again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.llm import binary_files
from outlay.llm.common import arrow_rows, measured, staged, text_of
from outlay.sources.scratch import new_table_path

SEGMENT_BYTES = 16 * 1024  # largest block of a record; longer ones are continued in further records
CHUNK_BYTES = 4 * 1024  # of the chunked transfer framing
RECORDS_PER_FILE = 2000
ROWS_AT_ONCE = 64

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that breaks the format: wrong lengths, missing segments, bad framing."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for start in range(0, len(payload), size):
        chunk = payload[start : start + size]
        parts += [b"%x\r\n" % len(chunk), chunk, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions of a chunk and trailer lines are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            raise WarcError("chunk without a size")
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise WarcError("chunk of another length than announced")
        parts.append(body[at : at + size])
        at += size + 2


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(fields: dict[str, object], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"".join(
        [VERSION, head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"]
    )


def page_records(
    name: str, page: object, url: str | None, payload: bytes, first: object, segment: int,
    row: int = 0, first_row: int = 0,
) -> list[bytes]:
    """The records of one page. ``first`` is the page that has the same payload already, if any.
    ``row`` and ``first_row`` tell apart rows that repeat an id."""
    clean = "".join((url or "").split()) or None  # a header field holds no line breaks
    own = record_id(f"{name}:{page}:row {row}")
    common = {
        "WARC-Date": DATE,
        "WARC-Target-URI": clean,
        # in a header field, white space and other signs of an id that is text are escaped
        "X-Page-Id": None if page is None else quote(str(page), safe="-"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if first is not None:
        revisit = {
            "WARC-Type": "revisit",
            "WARC-Record-ID": own,
            **common,
            "WARC-Profile": SAME_PAYLOAD,
            "WARC-Refers-To": record_id(f"{name}:{first}:row {first_row}"),
        }
        return [record(revisit, HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    whole = {"WARC-Type": "response", "WARC-Record-ID": own, **common}
    if len(block) <= segment:
        return [record(whole, block)]
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [record({**whole, "WARC-Segment-Number": 1}, pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        fields = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": record_id(f"{name}:{page}:row {row}:{n}"),
            "WARC-Date": DATE,
            "WARC-Target-URI": clean,
            "WARC-Segment-Origin-ID": own,
            "WARC-Segment-Number": n,
            "WARC-Segment-Total-Length": len(block) if n == len(pieces) else None,
        }
        out.append(record(fields, piece))
    return out


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of every record of an archive."""
    at, size = 0, len(archive)
    while at < size:
        end = archive.find(b"\r\n\r\n", at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise WarcError(f"no record at {at}")
        fields = {}
        for line in archive[at:end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            fields[key.decode().strip().lower()] = value.decode().strip()
        start, length = end + 4, int(fields.get("content-length", -1))
        at = start + length + 4
        if length < 0 or archive[start + length : at] != b"\r\n\r\n":
            raise WarcError("record of another length than announced")
        yield fields, archive[start : start + length]


def write_pages(
    pages: DataFrame, path: str, min_revisit: int = 0, segment: int = SEGMENT_BYTES,
    name: str = "page",
) -> None:
    """Archives of ``pages`` (``page_id``, ``url``, ``html``) under ``path``.

    A null html is an empty payload. Of pages with equal payloads of at least ``min_revisit`` bytes,
    the one with the smallest id becomes a response, the others revisits of it. A page without id is
    always a response, nothing refers to it; rows that repeat an id are written as often as they
    occur. Other columns are ignored. Ids may be of any type.

    Pages are told apart by ids and hashes; what these say is sent to all tasks where it is small, so
    that the pages themselves are read and written, and shuffled only if there are too many revisits.
    """
    table = pages.select("page_id", F.col("url").cast("string").alias("url"),
                         text_of("html").alias("html"))
    table = table.withColumn("sha", F.sha1("html"))
    keys = staged(table.select("page_id", "sha", F.octet_length("html").alias("size")), "keys")
    repeated = staged(
        keys.where("page_id is not null").groupBy("page_id").count().where("count > 1").select("page_id"),
        "repeated",
    )
    # Only rows that share an id or have none need a number, which must stay as it is.
    shared = table.join(measured(repeated), "page_id", "left_semi").unionByName(table.where("page_id is null"))
    numbered = staged(shared.withColumn("row", F.monotonically_increasing_id() + 1), "numbered")
    plain = lambda rows: rows.where("page_id is not null").join(
        measured(repeated), "page_id", "left_anti"
    ).withColumn("row", F.lit(0).cast("bigint"))
    large = F.col("size") >= min_revisit
    ids = plain(keys).where(large).select("page_id", "sha", "row").unionByName(
        numbered.withColumn("size", F.octet_length("html")).where(large & F.col("page_id").isNotNull())
        .select("page_id", "sha", "row")
    )
    firsts = staged(
        ids.groupBy("sha")
        .agg(F.min(F.struct("page_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", F.col("first.page_id").alias("first"), F.col("first.row").alias("first_row")),
        "firsts",
    )
    again = staged(
        ids.select("page_id", "sha")
        .join(firsts.hint("merge"), "sha")
        .where("page_id <> first")
        .distinct(),
        "revisits",
    )
    rows = plain(table).unionByName(numbered.select(*table.columns, "row"))
    known = rows.join(measured(again), ["page_id", "sha"], "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            out = []
            for row in batch.to_pylist():
                out += page_records(
                    name, row["page_id"], row["url"], row["html"].encode(), row["first"], segment,
                    row["row"], row["first_row"],
                )
            # the writer adds the last byte of a record itself
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[: -len(binary_files.END)] for x in out], pa.binary())], ["record"]
            )

    packed = known.select("page_id", "url", "html", "first", "row", "first_row").mapInArrow(pack, "record binary")
    binary_files.write(packed, "record", path, RECORDS_PER_FILE, "gzip")


PARSED = (
    "record_id string, record_type string, page_id string, refers string, declared string, "
    "origin string, segment int, total bigint, block binary, payload_bytes bigint, "
    "payload_digest string"
)


def payload_of(block: bytes, declared: str | None) -> bytes:
    """The payload of a whole response block, checked against the digest its record declares."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError("response without an HTTP head")
    coded = b"transfer-encoding: chunked" in head.lower()
    payload = unchunked(body) if coded else body
    if declared and declared != digest(payload):
        raise WarcError("payload of another digest than declared")
    return payload


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PARSED.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    for batch in arrow_rows(batches, 1):
        rows = []
        content = batch.column("content")[0].as_py()
        data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
        for fields, block in records(data):
            kind = fields.get("warc-type")
            if kind not in ("response", "revisit", "continuation"):
                continue  # other kinds of records carry no page
            declared = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
            number, total = fields.get("warc-segment-number"), None
            own = fields.get("warc-record-id")
            origin = fields.get("warc-segment-origin-id", own) if number else None
            if "warc-segment-total-length" in fields:
                total = int(fields["warc-segment-total-length"])
            page = fields.get("x-page-id")
            row = [own, kind, None if page is None else unquote(page), fields.get("warc-refers-to"), declared,
                   origin, int(number) if number else None, total]
            if kind == "response" and not number:
                payload = payload_of(block, declared)
                row += [None, len(payload), digest(payload)]
            else:
                row += [block if number else None, None, None]
            rows.append(row)
            if len(rows) == 1000:
                yield _batch(rows, names, kinds)
                rows = []
        yield _batch(rows, names, kinds)


def _batch(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def reassembled(parts: list[dict], declared: str | None) -> bytes:
    """The payload of a segmented record from its segments in order of their numbers."""
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise WarcError("segments are missing or occur twice")
    block = b"".join(p["block"] for p in parts)
    if parts[-1]["total"] != len(block):
        raise WarcError("segments of another total length than announced")
    return payload_of(block, declared)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrow_rows(batches, ROWS_AT_ONCE):
        sizes, digests = [], []
        for row in batch.select(["parts", "declared"]).to_pylist():
            payload = reassembled(row["parts"], row["declared"])
            sizes.append(len(payload))
            digests.append(digest(payload))
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), batch.column("page_id"), pa.array(sizes, pa.int64()),
             pa.array(digests, pa.string())],
            ["record_id", "page_id", "payload_bytes", "payload_digest"],
        )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages in the archives under ``path``: ``page_id`` (text), ``payload_bytes``,
    ``payload_digest``, ``record_type`` and ``refers_to``, the page a revisit refers to.

    Records are parsed file by file. Whole responses are decoded there and then; continuation
    records are grouped by the id of their first segment (a group is one page), put in order of
    their numbers, checked against the announced total length, and then decoded. Revisits take
    length and digest from the response they name, by a join that can be split; one whose response
    is missing has a null length, the digest its record declares and null ``refers_to``. Anything
    malformed raises :class:`WarcError`.
    """
    parsed = staged(binary_files.read(spark, path).mapInArrow(_parse, PARSED), "records")
    part = F.struct("segment", "total", "block")
    segmented = (
        parsed.where("segment is not null")
        .groupBy("origin")
        .agg(
            F.sort_array(F.collect_list(part)).alias("parts"),
            F.max("page_id").alias("page_id"),
            F.max("declared").alias("declared"),
        )
        .select(F.col("origin").alias("record_id"), "page_id", "parts", "declared")
        .mapInArrow(
            _assemble,
            "record_id string, page_id string, payload_bytes bigint, payload_digest string",
        )
    )
    whole = parsed.where("record_type = 'response' and segment is null").select(
        "record_id", "page_id", "payload_bytes", "payload_digest"
    )
    responses = staged(whole.unionByName(segmented), "responses")
    targets = responses.select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes",
        F.col("payload_digest").alias("found"),
    ).dropDuplicates(["refers"])
    revisits = (
        parsed.where("record_type = 'revisit'")
        .select("page_id", "refers", "declared")
        .join(staged(targets, "targets").hint("merge"), "refers", "left")
        .select(
            "page_id", "payload_bytes",
            F.coalesce("found", "declared").alias("payload_digest"),
            F.lit("revisit").alias("record_type"), "refers_to",
        )
    )
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"),
    ).unionByName(revisits)


def through_archives(pages: DataFrame, min_revisit: int = 0, segment: int = SEGMENT_BYTES):
    """``pages`` written as archives in the shared folder and read back, ids in their own type."""
    spark = pages.sparkSession
    path = new_table_path(spark, "warc")
    write_pages(pages, path, min_revisit, segment)
    kind = pages.schema["page_id"].dataType
    return read_pages(spark, path).withColumns(
        {c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}
    )
