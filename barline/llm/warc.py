"""WARC archives of pages and a two-level capture index.

Pages are sorted by their reversed-host key once. Each task then writes one
archive and, beside it, the index of that archive: lines sorted by key in
compressed blocks, and a sparse directory with the first key of each block.
Look-ups go to the shard whose keys they fall between, find the block by binary
search in its directory, and read from the archive just the record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.store import fresh_name, open_fs, staged
from barline.session import scratch_path, stack

#: Captures of one compressed block.
BLOCK = 256
#: Ranges of one archive that lie closer than this are read together, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
SCHEMA = "shard long, first_key string, first_id long, last_key string, last_id long, archive string, blocks string, captures long"
#: Sorts before any id; stands for a NULL one.
NO_ID = -(1 << 63)


def surt(url: Column) -> Column:
    """``com,example)/path?query`` in lower case; a NULL url has the key ``)``."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://", "")
    host = F.regexp_extract(bare, r"^([^/?#]*)", 1)
    rest = F.regexp_replace(F.regexp_extract(bare, r"^[^/?#]*(.*)$", 1), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _header(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def warc_record(kind: str, url: str | None, page: int, digest: str, payload: bytes, refers: int | None) -> bytes:
    """One record as a gzip member of its own. A revisit has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {DATE}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {page}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers, digest)}", f"X-Refers-To-Page: {refers}"]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzip member."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


@dataclass
class _Writer:
    """One shard: an archive, its blocks, and the directory of the blocks."""

    folder: str

    def __post_init__(self):
        self.fs, self.root = open_fs(self.folder)
        self.fs.create_dir(self.root, recursive=True)
        self.names = fresh_name(".warc.gz"), fresh_name(".blocks")
        self.archive, self.blocks = (self.fs.open_output_stream(f"{self.root}/{n}", compression=None) for n in self.names)
        self.at, self.block_at, self.count = 0, 0, 0
        self.lines: list[list] = []
        self.directory: list[list] = []
        self.first = self.last = None
        self._add(gzip.compress(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                                "Content-Type: application/warc-fields\r\nContent-Length: 17\r\n\r\nformat: WARC 1.1\n\r\n\r\n".encode(), 4))

    def _add(self, member: bytes) -> tuple[int, int]:
        self.archive.write(member)
        at, self.at = self.at, self.at + len(member)
        return at, len(member)

    def capture(self, key: str, page: int, kind: str, member: bytes) -> None:
        self.lines.append([key, page, kind, *self._add(member)])
        self.first = self.first or (key, page)
        self.last = (key, page)
        self.count += 1
        if len(self.lines) == BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.lines:
            block = zlib.compress(json.dumps(self.lines).encode(), 6)
            self.blocks.write(block)
            self.directory.append([self.lines[0][0], self.lines[0][1], self.block_at, len(block)])
            self.block_at += len(block)
            self.lines = []

    def close(self) -> tuple | None:
        """The directory follows the blocks; the file's last 8 bytes tell where it starts."""
        self._flush()
        self.blocks.write(zlib.compress(json.dumps(self.directory).encode(), 6))
        self.blocks.write(self.block_at.to_bytes(8, "little"))
        self.archive.close()
        self.blocks.close()
        return (*self.first, *self.last, f"{self.folder}/{self.names[0]}", f"{self.folder}/{self.names[1]}", self.count) if self.count else None


PAGE = ("id", "key", "url", "sha")


def revisits(pages: DataFrame) -> DataFrame:
    """Of pages whose payload is found again, one row per distinct ``id``,
    ``key``, ``url`` and ``sha``: ``refers``, the id of the payload's first page
    (as text), and ``first``, whether one of these rows is that page."""
    keyed = pages.select(*PAGE)
    first = keyed.groupBy("sha").agg(F.min(F.struct("id", "key", "url")).alias("least"), F.count("*").alias("n")).where("n > 1")
    mine = F.struct("id", "key", "url").eqNullSafe(F.col("least"))
    return keyed.distinct().join(first, "sha").select(*PAGE, F.col("least.id").cast("string").alias("refers"), mine.alias("first"))


def write_archives(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> DataFrame:
    """Write every page (``page_id``, ``url``, ``html``; other columns are
    ignored) as a WARC record; returns the manifest, one row per shard.

    The payload is the html in UTF-8, empty for NULL. Of equal payloads of
    ``min_payload`` bytes or more the record with the smallest page_id is the
    response, of several rows with it the one of least key and url, and the others are revisits
    that refer to it. A NULL page_id counts as the smallest. A NULL url has no
    target URI. Repeated rows are records of their own.

    A payload is shuffled once: marks of the revisits travel with the pages and
    sort just before them. Marks know pages by what is in them, not by a number,
    so the passes over ``pages`` may deal its rows differently; a mark that meets no page of its own
    raises. Files have fresh names and count only if the manifest lists them, so tasks may run again.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("id"), surt(F.col("url")).alias("key"), F.col("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("sha", F.sha1("payload"))
    marks = revisits(rows.where(F.length("payload") >= min_payload)).withColumn("payload", F.lit(None).cast("binary"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = stack(rows.withColumns({"refers": F.lit(None).cast("string"), "first": F.lit(False)}), marks)
    order = ["key", "id", "url", "sha"]
    both = both.repartitionByRange(shards, *order).sortWithinPartitions(*order, F.col("payload").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, mark, first, refers, met = None, None, False, None, True
        for rows in batches:
            for page, key, url, sha, payload, to, own in rows[[*PAGE, "payload", "refers", "first"]].itertuples(index=False, name=None):
                this = page, key, url, sha
                if payload is None:
                    if not met:
                        raise RuntimeError(f"page {mark[0]} was there in one pass over the pages and not in another")
                    mark, first, refers, met = this, own, int(to), False
                    continue
                if mark is not None and mark != this and not met:
                    raise RuntimeError(f"page {mark[0]} was there in one pass over the pages and not in another")
                writer = writer or _Writer(folder)
                again = mark == this and not first
                if mark == this:
                    first, met = False, True  # of repeated rows only one is the response
                payload = bytes(payload)
                record = warc_record("revisit" if again else "response", url, page, base32_sha1(payload), payload, refers if again else None)
                writer.capture(key, page, "revisit" if again else "response", record)
        if not met:
            raise RuntimeError(f"page {mark[0]} was there in one pass over the pages and not in another")
        if writer:
            yield pd.DataFrame([(0, *writer.close())], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return staged(both.mapInPandas(run, SCHEMA), "manifest")


class _Shard:
    """Reads one shard: its directory whole, blocks and records as asked."""

    def __init__(self, archive: str, blocks: str):
        self.fs, path = open_fs(blocks)
        self.archive = open_fs(archive)[1]
        self.file = self.fs.open_input_file(path)
        size = self.file.size()
        start = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.directory = json.loads(zlib.decompress(self.file.read_at(size - 8 - start, start)))
        self.firsts = [(d[0], d[1]) for d in self.directory]
        self.held: dict[int, list] = {}

    def _block(self, i: int) -> list:
        if i not in self.held:
            if len(self.held) > 8:
                self.held = {}
            _, _, at, size = self.directory[i]
            self.held[i] = json.loads(zlib.decompress(self.file.read_at(size, at)))
        return self.held[i]

    def captures(self, key: str, page: int | None) -> Iterator[list]:
        """Index lines of a key, of one page if ``page`` is given."""
        low = (key, NO_ID if page is None else page)
        i = max(0, bisect_left(self.firsts, low) - 1)
        while i < len(self.directory) and self.firsts[i][0] <= key:
            lines = self._block(i)
            for line in lines[bisect_left(lines, low, key=lambda x: (x[0], x[1])):]:
                if line[0] != key or (page is not None and line[1] != page):
                    return
                yield line
            i += 1

    def records(self, lines: list[list]) -> Iterator[tuple[list, bytes]]:
        """Gzip members of index lines; neighbouring ranges in one read."""
        lines = sorted(lines, key=lambda x: x[3])
        with self.fs.open_input_file(self.archive) as file:
            i = 0
            while i < len(lines):
                j, start, end = i, lines[i][3], lines[i][3] + lines[i][4]
                while j + 1 < len(lines) and lines[j + 1][3] <= end + GAP and lines[j + 1][3] + lines[j + 1][4] - start <= READ:
                    j += 1
                    end = max(end, lines[j][3] + lines[j][4])
                data = file.read_at(end - start, start)
                for line in lines[i:j + 1]:
                    yield line, data[line[3] - start:line[3] - start + line[4]]
                i = j + 1


CAPTURES = ("key string, page_id long, record_type string, url string, payload_bytes long, payload_digest string, "
            "refers_to long, payload binary")


def look_up(requests: DataFrame, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Captures for ``requests`` (``key``, see :func:`surt`, and ``page_id``;
    NULL asks for all captures of the key), one row per capture asked for. The
    payload of a revisit is NULL; its length and digest are those of the page it
    stands for. Keys without a capture give no row.

    The manifest (one row per archive) comes to the driver and is sent to the
    tasks; requests are dealt to shards by their keys.
    """
    spark: SparkSession = requests.sparkSession
    shards = sorted(manifest.drop("shard").collect(), key=lambda r: (r["first_key"].encode(), r["first_id"]))
    table = [(r["first_key"], r["first_id"], r["last_key"], r["last_id"], r["archive"], r["blocks"]) for r in shards]
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("array<int>")
    def deal(key: pd.Series, asked: pd.Series) -> pd.Series:
        firsts = [(t[0].encode(), t[1]) for t in shared.value]
        lasts = [(t[2].encode(), t[3]) for t in shared.value]
        out = []
        for k, p in zip(key, asked):
            k = k.encode()
            low = bisect_left(lasts, (k, int(p) if p else NO_ID))
            high = bisect_right(firsts, (k, int(p) if p else 1 << 63))
            out.append(list(range(low, max(low, high))))
        return pd.Series(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: tuple[int, _Shard] | None = None
        for rows in batches:
            for number, g in rows.groupby("shard", sort=False):
                if open_ is None or open_[0] != number:
                    open_ = int(number), _Shard(*shared.value[int(number)][4:])
                shard = open_[1]
                lines = [line for k, p in zip(g["key"], g["asked"]) for line in shard.captures(k, None if p == "" else int(p))]
                for s in range(0, len(lines), 512):
                    found = [_row(line, member, with_payload) for line, member in shard.records(lines[s:s + 512])]
                    yield pd.DataFrame(found, columns=[c.split()[0] for c in CAPTURES.split(", ")], dtype=object).astype(
                        dict.fromkeys(["page_id", "payload_bytes", "refers_to"], "Int64"))

    page = F.col("page_id").cast("long")
    asked = requests.select("key", F.coalesce(page.cast("string"), F.lit("")).alias("asked"))
    asked = asked.withColumn("shard", F.explode(deal("key", "asked")))
    n = max(1, len(table))
    spread = asked.repartitionByRange(n, "shard", "key").sortWithinPartitions("shard", "key", "asked")
    found = spread.mapInPandas(run, CAPTURES)
    return found.withColumn("page_id", F.when(F.col("page_id") != NO_ID, F.col("page_id"))).withColumn(
        "refers_to", F.when(F.col("refers_to") != NO_ID, F.col("refers_to")))


def _row(line: list, member: bytes, with_payload: bool) -> tuple:
    warc, http, payload = parse_record(member)
    kind = warc["warc-type"]
    digest, size = warc["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
    if kind == "response":  # what was read, not what the headers say
        digest, size = base32_sha1(payload), len(payload)
    refers = int(warc["x-refers-to-page"]) if "x-refers-to-page" in warc else None
    return (line[0], int(warc["x-page-id"]), kind, warc.get("warc-target-uri"), size, digest, refers,
            payload if with_payload and kind == "response" else None)


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every record back through the index."""
    manifest = write_archives(pages)
    # each (key, page) once: its captures, repeated rows among them, all come with it
    asked = pages.select(surt(F.col("url")).alias("key"), F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page_id")).distinct()
    return look_up(asked, manifest, with_payload=False)
