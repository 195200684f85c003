"""WARC writing and reading with segment reassembly (operator 3).

``write`` makes one record of each row: the payload is framed as a chunked HTTP
response; blocks above ``segment`` bytes are split into a first record and
continuation records. Payloads that occur again become revisit records that refer
to the one response. Records are rows of Spark's text writer with the record end
of the format (two CRLF) as line separator, so archives land on any file system
that Spark can write, as gzip members.

``read`` streams the archives through Spark's text reader with the same separator,
so that a task holds one record at a time and never a whole file; pieces between
separators are put together by each record's length. Continuation records are grouped
by the id of their origin and ordered by number; numbers must be complete and the
total length must hold; then the chunked framing is decoded and the digest verified.

Defined results: a null payload is an empty one; rows that are equal in id, url
and payload are equal records and come back as often as they went in; rows that
share the largest id of their payload are all responses, as are rows whose payload
has no row with an id; a null url is an empty one; other columns are ignored.
Records with missing segments, wrong lengths, framing or digests give a row
with ``error`` set and no payload. So does an archive from where it is no archive any
more (no WARC head, no length, cut off): what stands before is kept, and reading goes on
with the next head; one of which nothing can be read gives one such row with its path as ``url``.
Archives that ``write`` made say at their beginning that a record at their end counts the
others, so one that is cut off or lacks records is always seen; of archives from elsewhere
that are cut off between two records, it isn't.
Archives are gzip files (``*.gz``) of one member or many, which Spark doesn't split.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize, maybe_members, shared_folder

SEGMENT = 16_384
HOT = 1000
CHUNK = 4_096
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(payload):
    """Bare upper-case base32 SHA-1 of a binary column, with built-in functions only."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(*cols):
    """The urn of a record: a UUID made from its content."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cols]))
    return F.concat(F.lit("urn:uuid:"), *[x for i, (a, n) in enumerate([(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]])


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunk(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        size = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def _about(kind: str, block: bytes) -> bytes:
    """A record about the archive itself."""
    return _record([("WARC-Type", kind), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], block)


def _records(page, url: str, payload: bytes, digest: str, rid: str, refers: str | None, segment: int, chunk: int):
    """The records of one page, the first one first."""
    kind = "revisit" if refers else "response"
    common = [("WARC-Type", kind), ("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")), ("X-Page-ID", None if page is None else str(page)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers:
        yield _record([*common, ("WARC-Refers-To", f"<{refers}>"), ("WARC-Profile", PROFILE), ("Content-Type", "application/http; msgtype=response")], HTTP)
        return
    block = HTTP + chunked(payload, chunk)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    kind_of = ("Content-Type", "application/http; msgtype=response")
    yield _record([*common, kind_of, *([("WARC-Segment-Number", "1")] if len(pieces) > 1 else [])], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if number == len(pieces) else []
        own = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{rid}/{number}')}"
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{own}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", f"<{rid}>"), ("WARC-Segment-Number", str(number)), *last], piece)


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", segment: int = SEGMENT, chunk: int = CHUNK, least: int = 0) -> None:
    """Write a WARC archive of ``pages`` into the folder ``path``.

    Payloads of ``least`` bytes or more that occur again are revisits of the row
    with the largest id; the choice is an aggregate over (digest, id, url). Only rows whose
    payload occurs again are joined with it: the most frequent payloads by broadcast (those with a
    thousandth of the rows, a thousand at most), the others by digest.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    keyed = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), body.alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    ids = keyed.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).select("digest", "page_id", "url")
    first = materialize(ids.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("top")).where("n > 1").select("digest", F.xxhash64("digest").alias("h"), "n", "top"))
    repeated = first.agg(F.sum("n")).first()[0] or 0
    marked = maybe_members(keyed, F.xxhash64("digest"), first.select("h"))
    hot = first.where(F.col("n") * HOT >= repeated).select("digest", "top")
    cold = first.where(F.col("n") * HOT < repeated).select("digest", "top")
    known = marked.where("__maybe").drop("__maybe").join(F.broadcast(hot), "digest", "left")
    names = [*keyed.columns, "top"]
    top = [
        marked.where("not __maybe").drop("__maybe").withColumn("top", F.lit(None).cast(first.schema["top"].dataType)).select(*names),
        known.where("top is not null").select(*names),
        known.where("top is null").drop("top").join(cold, "digest", "left").select(*names),
    ]
    typed = top[0].union(top[1]).union(top[2]).select(
        "page_id",
        "url",
        "payload",
        "digest",
        record_id(F.col("page_id"), F.col("url"), F.col("digest")).alias("rid"),
        F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top.page_id")), record_id(F.col("top.page_id"), F.col("top.url"), F.col("digest"))).alias("refers"),
    )

    def frame(batches):
        out, size, n = [_about("warcinfo", b"records are counted at the end")], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, address, data, digest, rid, refers = (c[i].as_py() for c in batch.columns)
                for record in _records(page, address, data, digest, rid, refers, segment, chunk):
                    out.append(record)
                    size, n = size + len(record), n + 1
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
        out.append(_about("metadata", b"records: %d" % n))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = typed.mapInArrow(frame, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def _fields(head: bytes) -> dict[str, str]:
    """The named fields of a record's head; ValueError if it is none or has no length."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record head")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no length")
    return fields


class Reassembly:
    """Records of one archive from its pieces, those between two record ends, in order.

    A block that holds record ends itself comes in several pieces, and one that ends in a line end
    is parted from the next record a line end early; its length says where it ends.
    ``add`` and ``close`` give (fields, block, error): one of fields and error is None.
    """

    def __init__(self):
        self.fields, self.parts, self.held, self.lost = None, [], 0, False
        self.counted, self.seen, self.told = False, 0, None

    def add(self, piece: bytes):
        if self.fields is None:
            try:
                self.fields, self.parts, self.held = _fields(piece), [], 0
                self.size, self.lost = int(self.fields["content-length"]), False
            except ValueError as e:
                if not self.lost:  # one error from here to the next head
                    self.lost = True
                    yield None, None, f"archive: {e}"
                return
        else:
            self.parts.append(piece)
            self.held += len(piece) + len(END)
            if self.held - len(END) < self.size:
                return
            block, rest = END.join(self.parts), b""
            if block[self.size : self.size + len(END)] == END:
                block, rest = block[: self.size], block[self.size + len(END) :]
            error = None if len(block) == self.size else "archive: wrong length"
            fields, self.fields = self.fields, None
            kind = fields.get("warc-type")
            if error:
                yield None, None, error
            elif kind == "warcinfo":
                self.counted |= block == b"records are counted at the end"
            elif kind == "metadata" and block.startswith(b"records: "):
                self.told = int(block[9:])
            else:
                self.seen += 1
                yield fields, block, None
            if rest:
                yield from self.add(rest)

    def close(self):
        if self.fields is not None or self.counted and self.told is None:
            yield None, None, "archive: cut off"
        elif self.counted and self.told > self.seen:
            yield None, None, "archive: records are missing"
        self.fields, self.counted = None, False


def _decode(block: bytes | None, digest: str | None, revisit: bool) -> tuple[bytes | None, str | None]:
    """(payload, error) of a whole block."""
    if revisit:
        return None, None
    try:
        head, sep, body = (block or b"").partition(END)
        if not sep:
            raise ValueError("no HTTP head")
        payload = dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError as e:
        return None, f"framing: {e}"
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest and digest.removeprefix("sha1:") != found:
        return None, "digest"
    return payload, None


_FIELDS = ["rid", "page", "url", "kind", "digest", "refers"]
_HEADERS = ["warc-record-id", "x-page-id", "warc-target-uri", "warc-type", "warc-payload-digest", "warc-refers-to"]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """rid, page (string), url, kind, digest, refers, payload_bytes, payload and error of each response and revisit.

    One pass over the archives; its rows are kept in the checkpoint folder, whole records beside
    the blocks of segments, of which only the latter are shuffled. Without ``payloads``
    that column is null (lengths and digests are verified all the same).
    """

    def row_of(fields, block, error):
        if error:
            return [None] * len(_FIELDS) + [None, None, error, None, None, None]
        row, number = [fields.get(h) for h in _HEADERS], fields.get("warc-segment-number")
        if row[3] not in ("response", "revisit", "continuation"):
            return None  # records about the archive itself
        if number is None and row[3] != "continuation":
            payload, error = _decode(block, row[4], row[3] == "revisit")
            return row + [None if payload is None else len(payload), payload if payloads else None, error, None, None, None]
        total = fields.get("warc-segment-total-length", "")
        if not (number or "").isdigit() or total and not total.isdigit():
            return row + [None, None, "segments", None, None, None]
        return row + [None, block, None, fields.get("warc-segment-origin-id", row[0]), int(number), int(total) if total else None]

    def parse(batches):
        path, archive, rows, size = None, Reassembly(), [], 0
        for batch in batches:
            files = batch.column(0)
            for i, piece in enumerate(batch.column(1)):
                found = []
                if files[i] != path:
                    found, path, archive = list(archive.close()), files[i], Reassembly()
                raw = piece.as_py() or b""
                for record in [*found, *archive.add(raw)]:
                    row = row_of(*record)
                    if row is not None:
                        rows.append(row)
                        size += len(row[7] or b"") + 500
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
        rows += [row_of(*record) for record in archive.close()]
        yield _batch(rows)

    schema = ", ".join(f"{f} string" for f in _FIELDS) + ", payload_bytes bigint, payload binary, error string, origin string, number int, total bigint"
    names = [*_FIELDS, "payload_bytes", "payload", "error", "origin", "number", "total"]
    kinds = [pa.string()] * len(_FIELDS) + [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64()]

    def _batch(rows):
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.option("pathGlobFilter", "*.gz")
    pieces = files.option("lineSep", END.decode()).option("ignoreCorruptFiles", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    parsed = materialize(pieces.mapInArrow(parse, schema))
    whole = parsed.where("origin is null").select(*_FIELDS, "payload_bytes", "payload", "error")
    segments = parsed.where("origin is not null")
    readable = pieces.select("file").distinct()
    listed = files.format("binaryFile").load(path).where("length > 0").select(F.col("_metadata.file_path").alias("file"))
    unread = listed.join(readable, "file", "left_anti").select(*[(F.col("file") if f == "url" else F.lit(None).cast("string")).alias(f) for f in _FIELDS], F.lit(None).cast("bigint").alias("payload_bytes"), F.lit(None).cast("binary").alias("payload"), F.lit("archive: no records").alias("error"))

    # Segments of equal rows have equal origins: each number then occurs as often as the row.
    parts = segments.groupBy("origin", "number").agg(
        F.count("*").alias("copies"), F.max("total").alias("total"), F.max("payload").alias("block"), *[F.max(f).alias(f) for f in _FIELDS]
    )
    joined = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("number").alias("last"), F.max("total").alias("total"), F.min("copies").alias("copies"), *[F.max(F.when(F.col("number") == 1, F.col(f))).alias(f) for f in _FIELDS]
    )
    block = F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.block))")
    checked = joined.withColumn("block", block).withColumn(
        "error", F.when((F.size("parts") != F.col("last")) | F.col("kind").isNull(), "segments").when(F.col("total").isNull() | (F.octet_length("block") != F.col("total")), "length")
    )

    def decode(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                *fields, block, error = (c[i].as_py() for c in batch.columns)
                payload, error = (None, error) if error else _decode(block, fields[4], fields[3] == "revisit")
                rows.append([*fields, None if payload is None else len(payload), payload if payloads else None, error])
            columns = zip(*rows, strict=True) if rows else [[] for _ in range(9)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds[:9], strict=True)], names=names[:9])

    copied = checked.select(*_FIELDS, "block", "error", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
    mended = copied.mapInArrow(decode, ", ".join(f"{f} string" for f in _FIELDS) + ", payload_bytes bigint, payload binary, error string")
    return whole.union(mended).union(unread)


def remove(spark: SparkSession, path: str) -> None:
    """Delete the archives in the folder ``path``, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def resolve(records: DataFrame) -> DataFrame:
    """``records`` with, for revisits, the length and page of the response they refer to."""
    responses = materialize(records.where("kind = 'response'").groupBy("rid").agg(F.max("payload_bytes").alias("of_bytes"), F.max("page").alias("of_page"), F.max("digest").alias("of_digest")))
    named = responses.withColumnRenamed("rid", "refers")
    out = records.where("kind = 'revisit' and error is null").join(named, "refers", "left").select("page", "url", "kind", "digest", F.col("of_bytes").alias("payload_bytes"), F.col("of_page").alias("refers_to"), F.when(F.col("of_digest").isNull() | (F.col("of_digest") != F.col("digest")), "dangling").alias("error"))
    rest = records.where("kind is null or kind <> 'revisit' or error is not null")
    return rest.select("page", "url", "kind", "digest", "payload_bytes", F.lit(None).cast("string").alias("refers_to"), "error").union(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every page written to an archive and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    back = materialize(read(spark, path, payloads=False).drop("payload"))
    remove(spark, path)
    back = resolve(back)
    return back.select(F.col("page").cast("bigint").alias("page_id"), "payload_bytes", F.expr("substr(digest, 6)").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to"))


#: DuckDB has SHA-1 but no base32: the digest's 160 bits are read off in fives.
ORACLE_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS s FROM p),
d AS (SELECT page_id, n, s, max(page_id) OVER (PARTITION BY s) AS top,
  array_to_string([ 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST((CAST('0x' || s[1 + 5 * (i // 4) : 5 + 5 * (i // 4)] AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER)] for i in range(32)], '') AS digest FROM h)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
