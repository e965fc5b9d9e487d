"""WARC archives: written as text files, read back by verified chains of boundaries.

Every occurrence of the magic line is a candidate record. A task follows, within its
own split, each candidate to its successor (its place plus its stated length) and so
finds where the chain leaves the split. Pointer jumping over these exits, from the start
of every file, then tells which candidate each split is entered at. Whatever no chain
reaches is payload that happens to look like a record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.store import removed, written
from tickloom.session import run_dir

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Payloads from this size on are written once; their copies refer to them.
SHARED_BYTES = 1000
WRITTEN_AT = "2024-01-01T00:00:00Z"


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(spark: SparkSession, pages: DataFrame, path: str) -> None:
    """One record per row of ``pages (page_id, url, html)`` into WARC files below ``path``.

    Of rows with equal payloads of at least ``SHARED_BYTES`` the largest page_id becomes
    a response, the others revisits of it without payload; rows that share the largest
    id are all responses. A null html is an empty payload. Line breaks in an url are
    percent-encoded; a null url leaves its header out.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body")
    ).withColumns({"digest": F.sha1(F.col("body").cast("binary")), "size": F.octet_length("body")})
    shared = (
        rows.where(F.col("size") >= SHARED_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept_id"), F.count("*").alias("n"))
        .where("n > 1 and kept_id is not null")
        .select("digest", "kept_id")
    )
    # Written first: its size is known when Spark plans how to join the payloads.
    shared = written(spark, shared, "shared")
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("kept_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("kept_id"), F.lit(False))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "body"))
    size = F.when(revisit, F.lit(len(HTTP))).otherwise(F.col("size") + len(HTTP))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(WRITTEN_AT)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", url)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, line("WARC-Refers-To", _urn(F.col("kept_id")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magic lines, in file order within each split; files by a hash."""
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64(place[0]).alias("file"), F.col(place[1]).alias("split"), "value"
    )


def _fields(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def _record_length(head: bytes, complete: bool) -> int | None:
    """From the magic to past the record's end; None if this head says no length."""
    stated = _fields(head).get("content-length", "") if complete else ""
    if not re.fullmatch("[0-9]{1,18}", stated):
        return None
    return len(MAGIC) + len(head) + len(END) + int(stated) + len(END)


def _in_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, dict]]:
    """Rows with their split and their offset from where the split's first one starts."""
    split, at = None, 0
    for batch in batches:
        for row in batch.to_pylist():
            if (row["file"], row["split"]) != split:
                split, at = (row["file"], row["split"]), 0
            yield split, at, row
            at += row["size"] + len(MAGIC)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per candidate: its offset, the last record of its chain here, where that leads."""

    def ended(split: tuple[int, int], found: list[tuple[int, int | None]], size: int) -> pa.RecordBatch:
        ways: dict[int, tuple[int, int | None]] = {}
        for at, following in reversed(found):
            ways[at] = ways.get(following, (at, following))
        rows = sorted(ways.items()) or [(None, (None, None))]
        return pa.RecordBatch.from_pydict(
            {
                "file": [split[0]] * len(rows),
                "split": [split[1]] * len(rows),
                "size": [size] * len(rows),
                "at": pa.array([at for at, _ in rows], pa.int64()),
                "last": pa.array([way[0] for _, way in rows], pa.int64()),
                "leads_to": pa.array([way[1] for _, way in rows], pa.int64()),
            }
        )

    now, found, size = None, [], 0
    for split, at, row in _in_splits(batches):
        if split != now:
            if now is not None:
                yield ended(now, found, size)
            now, found = split, []
        size = at + row["size"] + len(MAGIC)
        if split[1] or at:  # what precedes a file's first magic is no candidate
            length = _record_length(row["head"], row["complete"])
            here = at - len(MAGIC)
            found.append((here, None if length is None else here + length))
    if now is not None:
        yield ended(now, found, size)


def _records(shared):
    """Records that lie in one fragment, and the fragments of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        out: list[tuple] = []
        now, expected, owner = None, None, None
        for split, at, row in _in_splits(batches):
            if split != now:
                now = split
                base, expected, owner = entries.get(split, (0, None, None))
            here = base + at - len(MAGIC)
            if not split[1] and not at:
                continue
            value = row["value"]
            if here == expected:
                cut = value.find(END.encode())
                length = _record_length(value[:cut], cut >= 0)
                if length is None:
                    expected = owner = None
                    continue
                expected = here + length
                owner = here
                if length == len(MAGIC) + len(value):
                    out.append((split[0], here, here, None, *_parsed(value)))
                    owner = None
                    continue
            if owner is not None:
                out.append((split[0], owner, here, value, *[None] * 6))
            if len(out) >= 256:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    return run


RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"
PLACED = "file long, record long, at long, piece binary, " + RECORD
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_NAMES = ["file", "record", "at", "piece", "page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(values), kind) for values, kind in zip(zip(*out), _TYPES)]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def _parsed(content: bytes) -> tuple:
    """The fields of a record without its magic; the digest is that of what was read."""
    cut = content.find(END.encode())
    fields = _fields(content[:cut])
    block = content[cut + len(END) : cut + len(END) + int(fields["content-length"])]
    payload = block[block.find(END.encode()) + len(END) :]
    kind = fields.get("warc-type")
    if kind == "revisit":
        digest, size = fields.get("warc-payload-digest", "").removeprefix("sha1:"), None
    else:
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
    return (
        _page(fields.get("warc-record-id")),
        fields.get("warc-target-uri"),
        kind,
        digest,
        size,
        _page(fields.get("warc-refers-to")),
    )


def _assembled(key: tuple, pieces: pa.Table) -> pa.Table:
    """A record from its fragments; the magic lines between them were its payload."""
    pieces = pieces.sort_by("at")
    values = _parsed(MAGIC.encode().join(pieces.column("piece").to_pylist()))
    return pa.Table.from_arrays([pa.array([v], kind) for v, kind in zip(values, _TYPES[4:])], names=_NAMES[4:])


def _entries(spark: SparkSession, chains: DataFrame) -> DataFrame:
    """file, split, base, entry and owner of every split of every file.

    The base is the offset of a split's first row, the entry the first record that the
    file's chain reaches in it, the owner the record that its first bytes belong to.
    """
    order = Window.partitionBy("file").orderBy("split")
    splits = chains.groupBy("file", "split").agg(F.max("size").alias("size"))
    splits = splits.withColumn(
        "base", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    base = splits.select("file", "split", "base")
    placed = chains.where("at is not null").join(base, ["file", "split"]).select(
        "file", "split", *((F.col(c) + F.col("base")).alias(c) for c in ("at", "last", "leads_to"))
    )
    jumps = written(spark, placed.where("leads_to is not null").select("file", "at", "leads_to"), "jumps")
    reached = written(spark, placed.where("at = 0").select("file", "at"), "reached")
    n = reached.count()
    while n:
        # After round k all entries within 2**k splits of the start are known.
        further = reached.join(jumps, ["file", "at"]).select("file", F.col("leads_to").alias("at"))
        known = placed.select("file", "at")
        grown = written(spark, reached.union(further.join(known, ["file", "at"], "left_semi")).distinct(), "reached")
        before, n = n, grown.count()
        removed(spark, reached)
        reached = grown
        if n == before:
            break
        onward = jumps.select("file", F.col("at").alias("leads_to"), F.col("leads_to").alias("beyond"))
        doubled = jumps.join(onward, ["file", "leads_to"]).select("file", "at", F.col("beyond").alias("leads_to"))
        jumps = written(spark, doubled, "jumps")
    entered = placed.join(reached, ["file", "at"], "left_semi").select("file", "split", "at", "last", "leads_to")
    # The owner reaches beyond its own split: the last record before this split.
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        base.join(entered, ["file", "split"], "left")
        .withColumn("owner", F.last("last", ignorenulls=True).over(ahead))
        .withColumn("owned_to", F.last("leads_to", ignorenulls=True).over(ahead))
        .select("file", "split", "base", F.col("at").alias("entry"), F.when(F.col("owned_to") > F.col("base"), F.col("owner")).alias("owner"))
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``: page_id, url, record_type, payload_digest, payload_bytes, refers_to.

    Splits are read twice: once for their chains, for which the heads of candidates are
    enough, and once for their records, given where the verified chain enters them. One
    row per split (not per record) is sent to all tasks. Records that contain the magic
    line, or cross a split, are put together from their fragments. A record whose head
    states no length ends the chain of its file; no bytes after it are records.
    """
    heads = _fragments(spark, path).select(
        "file",
        "split",
        F.substring_index("value", END, 1).cast("binary").alias("head"),
        (F.instr("value", END) > 0).alias("complete"),
        F.octet_length("value").cast("long").alias("size"),
    )
    chains = written(
        spark,
        heads.mapInArrow(_chains, "file long, split long, size long, at long, last long, leads_to long"),
        "chains",
    )
    entries = {(r["file"], r["split"]): (r["base"], r["entry"], r["owner"]) for r in _entries(spark, chains).toLocalIterator()}
    shared = spark.sparkContext.broadcast(entries)
    whole = _fragments(spark, path).select(
        "file", "split", F.col("value").cast("binary").alias("value"), F.octet_length("value").cast("long").alias("size")
    )
    placed = written(spark, whole.mapInArrow(_records(shared), PLACED), "records")
    parted = placed.where("piece is not null").groupBy("file", "record").applyInArrow(_assembled, RECORD)
    records = placed.where("piece is null").select(*_NAMES[4:]).unionByName(parted)
    # Only what a revisit refers to is looked up.
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.select("refers_to", "payload_digest").distinct()
    kept = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("full_bytes")
    )
    kept = kept.join(wanted, ["refers_to", "payload_digest"], "left_semi")
    sizes = kept.groupBy("refers_to", "payload_digest").agg(F.max("full_bytes").alias("full_bytes"))
    filled = revisits.join(sizes, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("full_bytes"))
    others = records.where("record_type is null or record_type != 'revisit'")
    return others.unionByName(filled.select(*others.columns)).select(
        "page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"
    )


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back.

    A null html is an empty payload. A payload of any length is one record, read whole by
    one task. Of rows with equal payloads of at least ``SHARED_BYTES`` those with the
    largest page_id are kept in full; rows that repeat an id have records of their own. An
    empty table gives an empty one. Other columns are ignored.
    """
    path = run_dir(spark, "warc")
    write_archive(spark, pages, path)
    return read_archive(spark, path)
