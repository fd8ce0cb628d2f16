"""WARC archives: writing pages as response and revisit records, and reading records back by boundary-chain verification.

Reading deals files out in blocks.  Wherever the magic of a record stands with a header after it, also inside a payload, a
task notes the place and, from the header, where the next record would begin; places are followed to the first one behind
the block.  Pointer jumping from each file's start over these block-to-block steps, doubling their reach each round, finds
the places that a chain of whole records leads to.  From them the records are read.  A magic in a payload is on no chain.
"""

import re

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import functions as F

from parcelry.llm.common import fresh_path, ready, settled, unique_join

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 100
BLOCK = 4 << 20
BLANK = b"\r\n\r\n"
#: Bytes read behind a block at once; a longer header is read on to its blank line.
HEADER = 1 << 16


def with_firsts(pages, least=LEAST_REVISIT):
    """Pages with payload (missing: empty), its length and digest, and ``first``, the smallest page with that payload, if at least ``least`` bytes."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("payload")).withColumn("n", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    firsts = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n_rows"))
    return unique_join(rows, settled(firsts.where("n_rows > 1"), "firsts"), "digest", ["first"])


def record_text():
    """A record without the two line ends that close it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("n").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", uri("page_id")),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "%20"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Refers-To", uri("first")), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
    )
    return F.concat(head, line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(pages, folder, least=LEAST_REVISIT):
    """One record per page in files below ``folder``; of equal payloads, the smallest page's is stored and the others revisit it.

    A page without an id is written without one and is nobody's first; repeated rows of the first page are responses too.
    """
    with_firsts(pages, least).select(record_text()).write.option("lineSep", END).text(folder)


class Archive:
    """Byte ranges of one file in the shared store."""

    def __init__(self, path):
        store, name = pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        self.file = store.open_input_file(name)

    def read(self, start, n):
        self.file.seek(start)
        return self.file.read(n)


def header_of(data, at):
    """Fields of the header at ``at`` and where its block begins, or None."""
    if not data.startswith(MAGIC, at):
        return None
    end = data.find(BLANK, at)
    if end < 0:
        return None
    fields = {}
    for row in data[at + len(MAGIC) : end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def with_headers(archive, start, block):
    """A block of a file, and what follows up to the blank line of the last header that begins in it."""
    data = archive.read(start, block + HEADER)
    at = data.rfind(MAGIC, 0, block + len(MAGIC) - 1)
    while at >= 0 and data.find(BLANK, at) < 0:
        more = archive.read(start + len(data), len(data))
        if not more:
            break
        data += more
    return data


def last_length(data, a, b):
    """Place and value of the last content-length among the lines of data[a:b]; -1 and an empty value if there is none."""
    found = -1, b""
    for row in data[a:b].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if colon and name.strip().lower() == b"content-length":
            found = a, value.strip()
        a += len(row) + 2
    return found


def steps(data, base, block, length):
    """Candidates of a block of a file: (offset, first place behind the block, or behind the file, that its chain leads to), broken chains left out."""
    found, at, end = [], data.find(MAGIC), -1
    while 0 <= at < block:
        # candidates before one blank line have the same last lines, which are looked at once
        if end < at:
            end = data.find(BLANK, at)
            if end < 0:
                break
            line, size = last_length(data, at + len(MAGIC), end)
        if line >= at + len(MAGIC) and size.isdigit():
            found.append((at, end + len(BLANK) + int(size) + len(END)))
        at = data.find(MAGIC, at + 1)
    leads = {}
    for at, after in reversed(found):
        leads[at] = after if after >= block or base + after >= length else leads.get(after, -1)
    return [(base + at, base + leads[at]) for at, _ in found if leads[at] >= 0]


def reachable(spark, folder, block=BLOCK):
    """(path, at, length): for each block of each file, the first record in it that a chain from the file's start leads to."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length").where("length > 0")
    parts = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))))
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")

    def scan(batches):
        for batch in batches:
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = steps(with_headers(Archive(path), start, block), start, block, length)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(pairs), pa.string()), pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["path", "at", "to"])

    leads = settled(parts.mapInArrow(scan, "path string, at long, to long"), "leads")
    starts = files.select("path", F.lit(0).cast("long").alias("at"))
    # only places that some block leads to can be entered
    jumps = settled(leads.join(leads.select("path", F.col("to").alias("at")).union(starts).distinct(), ["path", "at"]), "jumps")
    reached = jumps.where("at = 0").select("path", "at")
    most = files.agg(F.max("length")).first()[0] or 0
    for _ in range((-(-most // block)).bit_length()):
        reached = settled(reached.union(reached.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at"))).distinct(), "reached")
        beyond = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("further"))
        jumps = settled(jumps.join(beyond, ["path", "to"]).select("path", "at", F.col("further").alias("to")), "jumps")
    return reached.join(leads.select("path", "at"), ["path", "at"], "left_semi")


FIELDS = "path string, offset long, record_type string, record_id string, refers_to string, stated_digest string, stated_bytes long, payload binary"


def read_records(spark, folder, block=BLOCK):
    """Type, ids, stated payload digest and length, and the payload (NULL for revisits) of each record on a chain from its file's start.

    What follows a broken chain, such as a cut-off file, is not read; a file that does not begin with a record gives none.
    """
    ready(spark)
    entries = reachable(spark, folder, block).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "at")

    def records(path, at):
        archive, stop = Archive(path), (at // block + 1) * block
        while at < stop:
            n = 1 << 12
            head = archive.read(at, n)
            while BLANK not in head and len(head) == n:
                n *= 8
                head = archive.read(at, n)
            header = header_of(head, 0)
            if header is None:
                return
            fields, begin = header
            size = int(fields["content-length"])
            body = archive.read(at + begin, size)
            if len(body) < size:
                return
            http, _, payload = body.partition(b"\r\n\r\n")
            stated = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
            kind = fields.get("warc-type")
            yield (path, at, kind, fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-payload-digest"), int(stated[1]) if stated else None, None if kind == "revisit" else payload)
            at += begin + size + len(END)

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def run(batches):
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, size = [], 0
                for row in records(path, at):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size >= 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    return entries.mapInArrow(run, FIELDS)


def round_trip(pages, least=LEAST_REVISIT, block=BLOCK):
    """``pages`` written to a new place in the shared folder and read back."""
    spark = ready(pages.sparkSession)
    folder = fresh_path(spark, "warc")
    write_archives(pages, folder, least)
    return read_records(spark, folder, block)
