"""WARC archives: gzip members written by Spark's writers, and read back from any byte range."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradloom.llm.batches import map_arrow
from gradloom.session import local_table, reliable_checkpoint, scratch_path

# Fixed values of the formats: gzip magic with the deflate method, header and record ends of WARC 1.1.
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
# Payloads shorter than this are never replaced by a reference.
REVISIT_BYTES = 100
EMPTY_MEMBER_LEVEL = 1

RECORD_SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def mark_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to for every page.

    Of equal payloads of ``REVISIT_BYTES`` or more the smallest page_id is the response and the others revisit it.
    Only one row per repeated digest is aggregated; short payloads get keys of their own, so none of them gather.
    Rows that repeat the smallest page_id are responses as well; a null page_id revisits if any other id exists.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("digest", F.sha2("payload", 256))
        .withColumn(
            "_same",
            F.when(F.length("payload") >= REVISIT_BYTES, F.col("digest")).otherwise(
                F.concat(F.lit("short "), F.coalesce(F.col("page_id").cast("string"), F.lit("-")))
            ),
        )
    )
    long = F.length("payload") >= REVISIT_BYTES
    first = (
        rows.where(long).groupBy("_same").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    )
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(first, "_same", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
    )


def write_warc(records: DataFrame, path: str, level: int = 1) -> None:
    """Write each row of ``mark_revisits`` as one gzip member; every task writes one archive file under ``path``.

    Spark's text writer does the writing: it commits whole files only, on any file system Spark knows, and survives
    lost executors. It ends each line with a separator, so the last byte of a member, a zero, becomes that separator;
    a member that ends otherwise (16 MB or more) is followed by an empty member, which every reader skips.
    """

    def members(batches):
        for batch in batches:
            packed = [_member(row, level) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pydict({"member": pa.array(packed, pa.binary())})

    lines = map_arrow(records, members, "member binary").select(F.col("member").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").text(path)


def _member(row: dict, level: int) -> bytes:
    """A record compressed by itself, without its last byte."""
    packed = _gzip(_record(row), level)
    if packed[-1]:
        packed += _gzip(b"", EMPTY_MEMBER_LEVEL)
    return packed[:-1]


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(row: dict) -> bytes:
    revisit = row["record_type"] == "revisit"
    payload = row["payload"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    if not revisit:
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_name(row['page_id'])}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + _escaped(row["url"]))
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    lines.append(f"WARC-Payload-Digest: sha256:{row['digest']}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(row['refers_to'])}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block + END


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _escaped(url: str) -> str:
    """Line ends and percent signs written as percent codes, so that a url stays one header line."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, read by byte ranges.

    Spark's text source deals files out by byte range and cuts them at gzip magic: each piece is a candidate member and
    belongs to the range it starts in. A task decodes a candidate and takes it as a record if its header is a WARC
    header; where the magic was a chance run inside of compressed bytes, pieces are joined until the member is
    complete. A member that a range cannot finish is decoded on with what the next range found before its first record
    (one join of neighbouring ranges). Where that does not end it, the next range began inside of it and may have
    taken members of an archive in its payload for its own: such a range is scanned again from the true end of the open
    member, until all ranges agree. Files must not end in ``.gz``, which Spark would unpack whole. Members that are empty
    or hold no WARC record are skipped; an empty folder gives no rows.
    """
    pieces = (
        spark.read.option("lineSep", MAGIC.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
        .select(
            F.col("value").cast("binary").alias("piece"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
    )
    ranges = reliable_checkpoint(map_arrow(pieces, _range_ends, ENDS_SCHEMA))
    # The range of a file in which the next piece starts: a window over one row of two numbers per range.
    behind = W.partitionBy("file").orderBy("start")
    ranges = ranges.join(reliable_checkpoint(ranges.select("file", "start").withColumn("next", F.lead("start").over(behind))), ["file", "start"])
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    redone, tails = None, None
    while True:
        border = _borders(ranges, tails)
        # A member that is still open: the range it runs into is redone. All before the first such range of a file is settled.
        still = border.where("fragment IS NOT NULL").select("file", "start", "fragment")
        ready = [tuple(r) for r in still.groupBy("file").agg(F.min("start").alias("start")).limit(REDONE_FILES).collect()]
        if not ready:
            break
        again = local_table(spark, ready, "file string, start bigint")
        carried = {(r["file"], r["start"]): bytes(r["fragment"]) for r in still.join(F.broadcast(again), ["file", "start"]).collect()}
        written = scratch_path(spark, "redone")
        shipped = spark.sparkContext.broadcast(carried)
        found = map_arrow(pieces.join(F.broadcast(again), ["file", "start"]).select(*pieces.columns), _scan_on(shipped), FOUND_SCHEMA)
        found.write.parquet(written)
        new = spark.read.parquet(written)
        redone = new if redone is None else redone.unionByName(new)
        tails = redone.where("start IS NOT NULL").select("file", "start", F.col("fragment").alias("settled"))
    done = set()
    if tails is not None:
        done = {(r["file"], r["start"]) for r in tails.select("file", "start").collect()}
    shipped_done = spark.sparkContext.broadcast(done)
    records = map_arrow(pieces, _scan_records(shipped_done), RECORD_SCHEMA).unionByName(border.where("fragment IS NULL").select(*names))
    return records if redone is None else records.unionByName(redone.where("start IS NULL").select(*names))


ENDS_SCHEMA = "file string, start bigint, head binary, tail binary"
FOUND_SCHEMA = RECORD_SCHEMA + ", file string, start bigint, fragment binary"
# Files of which a range is scanned again at once; each brings its open member to the driver.
REDONE_FILES = 64


def _borders(ranges: DataFrame, tails: DataFrame | None) -> DataFrame:
    """Records that end behind their range, and what is open even then (``fragment``) at which range."""
    ends = ranges.select("file", F.col("start").alias("own"), F.col("next").alias("start"), "tail")
    heads = ranges.select("file", "start", "head")
    if tails is not None:
        settled = tails.select("file", F.col("start").alias("own"), "settled")
        ends = ends.join(F.broadcast(settled), ["file", "own"], "left").withColumn(
            "tail", F.when(F.col("settled").isNotNull(), F.col("settled")).otherwise(F.col("tail"))
        )
        heads = heads.join(F.broadcast(tails.select("file", "start")), ["file", "start"], "left_anti")
    met = ends.where(F.length("tail") > 0).join(heads, ["file", "start"]).select("file", "start", "tail", "head")

    def join(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                scan = RangeScan(False)
                for piece in (bytes(row["tail"]) + bytes(row["head"])).split(MAGIC)[1:]:
                    scan.feed(piece)
                rows += [record for record in map(_parsed, scan.records) if record]
                if scan.open:
                    rows.append({"file": row["file"], "start": row["start"], "fragment": row["tail"]})
            yield _rows(rows)

    return reliable_checkpoint(map_arrow(met, join, FOUND_SCHEMA))


class RangeScan:
    """Pieces of one byte range in order: finished records, the bytes before the first of them, and an open member."""

    def __init__(self, at_start: bool):
        self.records: list[bytes] = []
        self.at_start, self.inside = at_start, False
        self._head: list[bytes] = []
        self._open, self._raw = None, []

    @property
    def head(self) -> bytes:
        return b"".join(self._head)

    @property
    def open(self) -> bool:
        return self._open is not None

    @property
    def tail(self) -> bytes:
        """The bytes of the member that has not ended."""
        return b"".join(self._raw) if self.open else b""

    def feed(self, piece: bytes) -> None:
        if self.at_start:  # what stands before the first magic of a file
            self.at_start = False
            self._head.append(piece)
            return
        waiting = [MAGIC + piece]
        while waiting:
            raw = waiting.pop()
            if self._open is None:
                self._open, self._lead, self._parts, self._raw = zlib.decompressobj(31), b"", [], []
            self._raw.append(raw)
            if not self._decode(raw):
                # No member begins where one was taken to: the pieces behind that place are looked at again.
                tried, self._open, self._raw = self._raw, None, []
                if not self.inside:  # before the first record of a range they end a member of an earlier range
                    self._head.append(tried[0])
                waiting += tried[:0:-1]

    def _decode(self, raw: bytes) -> bool:
        """Feed bytes to the open candidate; False if it proves to be none."""
        try:
            data = self._open.decompress(raw)
        except zlib.error:
            return False
        self._lead = (self._lead + data[:5])[:5]
        if not b"WARC/".startswith(self._lead):
            return False
        self._parts.append(data)
        if self._open.eof:
            if self._lead:
                self.records.append(b"".join(self._parts))
            self.inside, self._open, self._raw = True, None, []
        return True


def _scans(batches, begin):
    """(range, scan, whether the range is over) after every batch and range; ``begin(range)`` gives the scan of a new one."""
    scan, at = None, None
    for batch in batches:
        for piece, file, start in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != at:
                if scan is not None:
                    yield at, scan, True
                at = (file, start)
                scan = begin(at)
            scan.feed(piece)
        if scan is not None:
            yield at, scan, False
    if scan is not None:
        yield at, scan, True


def _range_ends(batches):
    for (file, start), scan, over in _scans(batches, lambda at: RangeScan(at[1] == 0)):
        scan.records.clear()
        if over:
            yield pa.RecordBatch.from_pydict({
                "file": [file], "start": pa.array([start], pa.int64()),
                "head": pa.array([scan.head], pa.binary()), "tail": pa.array([scan.tail], pa.binary()),
            })


def _scan_records(done):
    """Kernel: the records that start in a range and end there, but for ranges that are ``done``."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]

    def run(batches):
        for (file, start), scan, _ in _scans(batches, lambda at: RangeScan(at[1] == 0)):
            rows = [] if (file, start) in done.value else [row for row in map(_parsed, scan.records) if row]
            scan.records.clear()
            yield _rows(rows).select(names)

    return run


def _scan_on(carried):
    """Kernel: all records of ranges that begin inside of a member, from that member on, and what is open at their ends."""

    def begin(at):
        scan = RangeScan(False)
        for piece in carried.value[at[0], at[1]].split(MAGIC)[1:]:
            scan.feed(piece)
        return scan

    def run(batches):
        for (file, start), scan, over in _scans(batches, begin):
            rows = [row for row in map(_parsed, scan.records) if row]
            scan.records.clear()
            if over:
                rows.append({"file": file, "start": start, "fragment": scan.tail})
            yield _rows(rows)

    return run


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {
        "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
        "file": pa.string(), "start": pa.int64(), "fragment": pa.binary(),
    }
    return pa.RecordBatch.from_pydict({k: pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()})


def _parsed(data: bytes) -> dict | None:
    """A WARC record as a row. The digest of a response is taken from its payload, that of a revisit from its header."""
    head, _, rest = data.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(END)
    told = next((h.partition(b":")[2] for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:")), b"0")
    revisit = fields.get("warc-type") == "revisit"
    return {
        "page_id": _page(fields.get("warc-record-id")),
        "url": _unescaped(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": fields.get("warc-type"),
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": int(told) if revisit else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(),
        "payload": None if revisit else payload,
    }
