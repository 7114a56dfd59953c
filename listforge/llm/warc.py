"""WARC archives and a two-level capture index over them.

Writing: each page is one record, compressed as a gzip member of its own. Of equal payloads one page is the response, the others are
revisits without the payload. Spark's text writer commits the files, so a lost task leaves nothing half-written. It needs a
separator between rows; that is an empty gzip member, which any reader of such archives passes over.

Index: the archives are walked member by member, and what they hold is sorted by reversed-host key. Runs of ``BLOCK_LINES`` captures
are compressed into blocks; the directory keeps first and last key of each block only. Blocks are dealt by ranges of the key and of the
place, so captures of one key may fill many blocks and ranges.

Look-up: a key goes to the ranges that may hold it (their bounds are one row a range), is searched in the range's directory, and then
in the block's lines, by binary search each time. Read: records are read by place and length, in the order of their files.

Defined cases: null html is an empty payload; a null url has an empty key and no target address; a null page_id never names a
response, so pages of equal payload without any id are all responses; rows that repeat the id of the response are responses too;
further columns are ignored; no pages give no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, new_path

#: Payloads of so many bytes at least may be revisited.
LEAST_BYTES = 0
#: Captures of an index block; records of an archive.
BLOCK_LINES, ARCHIVE_RECORDS = 3000, 10_000
CAPTURED = "1970-01-01T00:00:00Z"
#: Fixed values of the format: an empty gzip member, and the profile of a revisit.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" + "0300" + "00000000" + "00000000")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = "key string, page_id long, kind string, archive string, place long, size long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def host_key(url: Column) -> Column:
    """Reversed-host sort key: ``https://M.a.org:80/x?y#z`` gives ``org,a,m)/x?y``; without a host the text itself.

    Scheme, user, default port and fragment don't count, letters of the host do as small ones.
    """
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    port = F.regexp_extract(rest, r"^(?:[^/?#@]*@)?[^/?#:@]*:([0-9]+)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    path = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    name = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    named = F.concat(name, F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"), path)
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), named).otherwise(url)


def roles(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html bytes or null for revisits, payload_bytes, sha1, refers_to)."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), address(F.col("url").cast("string")).alias("url"), raw.alias("body"))
    slim = rows.select("page_id", F.sha2("body", 256).alias("same"), F.octet_length("body").alias("b")).where(F.col("b") >= least)
    winners = slim.groupBy("same").agg(F.max("page_id").alias("winner"), F.count("*").alias("c")).where("c > 1 AND winner IS NOT NULL")
    losers = slim.join(winners.select(F.col("same").alias("w"), "winner"), F.col("same") == F.col("w")).where(~F.col("page_id").eqNullSafe(F.col("winner")))
    # a row an id and payload, so that a payload's copies are dealt by their ids
    losers = losers.groupBy(F.col("page_id").alias("id"), F.col("same").alias("w")).agg(F.max("winner").alias("refers_to"))
    out = rows.withColumns({"same": F.sha2("body", 256), "sha1": F.sha1("body"), "payload_bytes": F.octet_length("body").cast("long")})
    out = out.join(losers, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("w")), "left")
    return out.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("body")).alias("body"), "payload_bytes", "sha1", "refers_to")


def address(url: Column) -> Column:
    """A url that can stand in a header line and in a line of the index: blanks and line ends as %XX."""
    for c in " \t\r\n":
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page_id, url, body, size: int, sha1: str, refers_to, captured: str) -> bytes:
    """One WARC/1.1 record; a revisit has the header of the answer only."""
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {captured}"]
    head += [f"WARC-Target-URI: {url}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{base32(sha1)}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = answer + (body or b"")
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(headers of the record, headers of the answer, payload)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("a record ends early")
    answer, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in answer.decode().split("\r\n")[1:]), payload


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, captured: str = CAPTURED, records: int = ARCHIVE_RECORDS) -> None:
    """The pages as .warc.gz archives under a folder, with ``records`` records each at most."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in range(batch.num_columns)]
            out = [member(record(*(v.as_py() for v in row), captured)) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    members = roles(pages, least).mapInArrow(compress, "member binary")
    out = members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
    out.option("maxRecordsPerFile", records).text(path)


def walk(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(place, length, text) of the gzip members of an archive, empty ones left out."""
    at = 0
    while at < len(data):
        z, text, fed = zlib.decompressobj(31), [], at
        while not z.eof:
            step = data[fed : fed + (1 << 13)]
            if not step:
                raise ValueError("an archive ends inside a record")
            text.append(z.decompress(step))
            fed += len(step)
        end = fed - len(z.unused_data)
        if any(text):
            yield at, end - at, b"".join(text)
        at = end


def number(text: str) -> int | None:
    """The page of a record id."""
    found = text.removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found else None


def captures(spark: SparkSession, path: str) -> DataFrame:
    """What the archives of a folder hold: (key, page_id, kind, archive, place, size)."""
    schema = "url string, page_id long, kind string, archive string, place long, size long"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for place, size, text in walk(memoryview(content.as_buffer())):
                    fields, _, _ = parse(text)
                    rows.append((fields.get("WARC-Target-URI"), number(fields["WARC-Record-ID"]), fields["WARC-Type"], archive, place, size))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["url", "page_id", "kind", "archive", "place", "size"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(look, schema).select(host_key(F.col("url")).alias("key"), "page_id", "kind", "archive", "place", "size")


def build_index(found: DataFrame, lines: int = BLOCK_LINES) -> DataFrame:
    """The index as a written table: (part, block, first_key, last_key, n, data); without ``data`` it is the sparse directory."""
    n = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = found.repartitionByRange(n, "key", "archive", "place").sortWithinPartitions("key", "archive", "place")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            data = zlib.compress("\n".join("\t".join("" if v is None else str(v) for v in r) for r in rows).encode(), 6)
            values = ([rows[0][0]], [rows[-1][0]], [len(rows)], [data])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)], names=["first_key", "last_key", "n", "data"])

        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            while len(held) >= lines:
                yield block(held[:lines])
                del held[:lines]
        if held:
            yield block(held)

    packed = dealt.mapInArrow(pack, "first_key string, last_key string, n long, data binary")
    return durable(packed.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("block"), "*"), "capture-index")


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """The captures of some keys (column ``key``, each once): directory, then blocks, by binary search."""
    spark = index.sparkSession
    # a row a range, whose number is that of the index's shuffle partitions
    bounds = sorted((r["a"].encode(), r["b"].encode(), r["part"]) for r in index.groupBy("part").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect())
    held = spark.sparkContext.broadcast(([b[0] for b in bounds], [b[1] for b in bounds], [b[2] for b in bounds]))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts, parts = held.value
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = key.encode()
                out += [(key, parts[i]) for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32())], names=["key", "part"])

    def blocks(asked: pa.Table, directory: pa.Table) -> pa.Table:
        rows = sorted(zip((k.encode() for k in directory["first_key"].to_pylist()), (k.encode() for k in directory["last_key"].to_pylist()), directory["block"].to_pylist(), strict=True), key=lambda r: r[2])
        firsts, lasts = [r[0] for r in rows], [r[1] for r in rows]
        out = []
        for key in asked["key"].to_pylist():
            k = key.encode()
            out += [(key, rows[i][2]) for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
        return pa.table({"key": pa.array([o[0] for o in out], pa.string()), "block": pa.array([o[1] for o in out], pa.int64())})

    def lines(asked: pa.Table, stored: pa.Table) -> pa.Table:
        cols: list[list] = [[] for _ in range(6)]
        wanted = asked["key"].to_pylist()
        for data in stored["data"].to_pylist():
            rows = [line.split("\t") for line in zlib.decompress(data).decode().split("\n")] if wanted else []
            sort_keys = [r[0].encode() for r in rows]
            for key in wanted:
                k = key.encode()
                for i in range(bisect_left(sort_keys, k), bisect_right(sort_keys, k)):
                    for c, v in zip(cols, (key, int(rows[i][1]) if rows[i][1] else None, rows[i][2], rows[i][3], int(rows[i][4]), int(rows[i][5])), strict=True):
                        c.append(v)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("key", "page_id", "kind", "archive", "place", "size"), cols, kinds, strict=True)})

    asked = keys.where("key IS NOT NULL").select("key").mapInArrow(ranges, "key string, part int")
    directory = index.select("part", "block", "first_key", "last_key")
    at = asked.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(blocks, "key string, block long")
    return at.groupBy("block").cogroup(index.select("block", "data").groupBy("block")).applyInArrow(lines, CAPTURES)


def read_records(found: DataFrame) -> DataFrame:
    """The records of some captures, by ranges of their archives: (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload).

    A payload that doesn't have the digest and length of its header is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        name, file = None, None
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = [c.split(" ")[0] for c in RECORDS.split(", ")]
        for batch in batches:
            rows, held = [], 0
            for archive, place, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != name:
                    if file is not None:
                        file.close()
                    store, path = fs.FileSystem.from_uri(archive)
                    name, file = archive, store.open_input_file(path)
                fields, answer, payload = parse(zlib.decompress(file.read_at(size, place), 31))
                length, digest = int(answer["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = fields["WARC-Type"]
                if kind == "response" and (length != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                    raise ValueError(f"the payload at {place} of {archive} isn't what its header says")
                refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
                rows.append((number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), length, digest, kind, refers, payload if kind == "response" else None))
                held += len(payload)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)
                    rows, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    n = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return found.select("archive", "place", "size").repartitionByRange(n, "archive", "place").sortWithinPartitions("archive", "place").mapInArrow(read, RECORDS)


def archive(pages: DataFrame, least: int = LEAST_BYTES) -> tuple[str, DataFrame]:
    """Write the pages, index the archives: (folder of the archives, index)."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    # written once, so that dealing them out by range doesn't walk the archives again
    return path, build_index(durable(captures(pages.sparkSession, path), "captures"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    _, index = archive(pages)
    keys = pages.select(host_key(address(F.col("url"))).alias("key")).distinct()
    return read_records(durable(look_up(index, keys), "found")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS same FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY same) AS winner FROM p),
d AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT)) AS v FROM w)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> s) & 31 AS INT) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN winner IS NULL OR page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN winner IS NULL OR page_id = winner THEN NULL ELSE winner END AS refers_to
FROM d
"""
