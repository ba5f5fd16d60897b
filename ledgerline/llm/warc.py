"""WARC archives: written and read with Spark's text source, records found by boundary chains.

Reading splits the bytes at every occurrence of the version line, wherever it stands. Each
occurrence is a *candidate* record; tasks emit its offset and, from its own Content-Length, the
offset of its successor. Pointer jumping from the start of the file marks the candidates that a
chain of successors reaches; every other candidate is text inside a payload.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, staged

MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # base32 (RFC 4648), a fixed value
URN = "urn:page:"


def base32(hexes: Column) -> Column:
    """Upper-case base32 of 40 hex digits: eight groups of five digits, four letters each."""

    def letters(group: Column) -> Column:
        bits = F.conv(F.substring(hexes, group * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(ALPHABET), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
                   records_per_file: int = 20_000, compression: str = "gzip") -> None:
    """One record per row of ``pages`` (page_id, url, html); other columns are not read.

    Of rows whose payloads are equal and have ``min_revisit_bytes`` bytes or more, that with the
    largest page_id is a response and the others are revisits of it; rows repeated with that very
    id are all responses, as is every smaller payload. A null html is an empty payload, a null url
    has no Target-URI line, a null page_id is smaller than any other. Files hold at most
    ``records_per_file`` records, so each stays a small unit of work. Only payloads that occur more
    than once are joined back; Spark broadcasts that list if it is small and shuffles it otherwise,
    so rows move only where duplicates abound.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))  # a column of its own is made once
    shared = staged(rows.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("sha1")
                    .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("target"))
                    .filter("n > 1").select("sha1", "target"), "warc-shared")
    target = F.col("target")
    revisit = target.isNotNull() & ~target.eqNullSafe(F.col("page_id"))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    http = F.concat(F.lit(HTTP), F.octet_length("html").cast("string"), F.lit(BLANK))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    name = F.concat(F.lit(URN), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <"), name,
        F.lit(f">\r\nWARC-Date: {date}"),
        F.when(F.col("url").isNull(), "").otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), clean_url)),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha1")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{URN}"),
                                 target.cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"), F.lit(BLANK), F.col("block"))
    (rows.join(shared, "sha1", "left").withColumn("block", block).select(record.alias("value"))
     .write.option("lineSep", BLANK).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(folder))


def _header(name: str, value: str, headers: str = "header") -> Column:
    found = F.regexp_extract(headers, rf"(?i)(?:^|\r\n){name}:[ \t]*{value}", 1)
    return F.when(found != "", found)


def _told(df: DataFrame) -> DataFrame:
    """What ``value``, a chunk that begins just after a version line, says of itself, and its payload's digest.

    A revisit has no payload of its own; size and digest are those its headers keep of the payload
    that it refers to.
    """
    split = df.withColumn("parts", F.split("value", BLANK, 3))
    payload = F.substr(F.col("parts")[2], F.lit(1), F.length(F.col("parts")[2]) - len(BLANK))
    split = split.select(
        *df.columns, F.col("parts")[0].alias("header"), F.get("parts", F.lit(1)).alias("http"),
        F.when(F.size("parts") > 1, F.octet_length(F.col("parts")[0]) + 4).alias("head"),
        F.when(F.size("parts") > 2, payload).alias("payload"))
    told = split.withColumns({
        "body": _header("Content-Length", r"(\d{1,18})").cast("long"),
        "record_type": _header("WARC-Type", r"([^\r\n]*)"),
        "page": _header("WARC-Record-ID", rf"<{URN}([^>]*)>"),
        "refers": _header("WARC-Refers-To", rf"<{URN}([^>]*)>"),
        "digest": _header("WARC-Payload-Digest", r"sha1:([A-Z2-7]*)"),
        "http_bytes": _header("Content-Length", r"(\d{1,18})", "http").cast("long"),
        "sha1": F.sha1("payload")})
    revisit = F.col("record_type") == "revisit"
    return told.select(
        *df.columns, "head", "body", "record_type", "page", "refers",
        F.when(revisit, F.col("http_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(base32(F.col("sha1"))).alias("payload_digest"))


def reachable(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Mask of candidates on the chain from offset 0, by pointer jumping (log2 n rounds)."""
    n = len(offsets)
    at = np.searchsorted(offsets, successors)
    hit = (at < n) & (offsets[np.minimum(at, n - 1)] == successors) & (successors > offsets)
    jump = np.append(np.where(hit, at, n), n)
    seen = np.zeros(n + 1, bool)
    seen[0] = bool(n) and offsets[0] == 0
    for _ in range(max(1, n.bit_length())):
        seen[jump[np.flatnonzero(seen)]] = True
        jump = jump[jump]
    return seen[:n]


def _chains(file: pd.DataFrame) -> pd.DataFrame:
    """Chunks of one file without their text: offsets, the chain, and the record that owns each chunk."""
    file = file.sort_values(["block_start", "row"], ignore_index=True)
    size = file["size"].to_numpy()
    ends = np.cumsum(size + len(MAGIC))
    # the first chunk is what stands before the first version line
    offsets = np.concatenate([[0], ends[:-1]]) - len(MAGIC)
    file["at"] = offsets
    file = file.iloc[1:].reset_index(drop=True) if len(file) else file
    offsets = file["at"].to_numpy()
    length = file["head"].fillna(-1).to_numpy(np.int64) + file["body"].fillna(-1).to_numpy(np.int64)
    good = file["head"].notna().to_numpy() & file["body"].notna().to_numpy()
    successors = np.where(good, offsets + len(MAGIC) + length + len(BLANK), -1)
    if not len(file):
        return file.assign(record=pd.Series(dtype="int64"), chunks=pd.Series(dtype="int64"), start=pd.Series(dtype=bool))
    # the last record ends with the file, where no version line stands
    start = reachable(offsets, successors)
    owner = np.maximum.accumulate(np.where(start, np.arange(len(file)), -1))
    file["record"], file["start"] = np.where(owner >= 0, offsets[owner], -1), start
    file["chunks"] = file.groupby("record")["at"].transform("size")
    return file[owner >= 0]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all files in ``folder``: file, record (offset), page_id, record_type, refers_to, payload_bytes, payload_digest.

    The text source cuts the files at each version line; files without compression are split into
    blocks, one with compression is one block. Only chunk sizes and header fields are grouped by
    file, never text. A record in one chunk, as nearly all are, is digested in the scan; the chunks
    of the others (payloads that hold the version line) are read again and joined.
    """
    raw = spark.read.schema("value string").option("lineSep", MAGIC).text(folder).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row"))
    chunks = _told(raw.withColumn("size", F.octet_length("value").cast("long")))
    light = chunks.withColumns({c: F.col(c).cast("double") for c in ("head", "body")}).drop("value")
    marks = staged(light.groupBy("file").applyInPandas(
        _chains, "file string, block_start long, row long, size long, head double, body double, record_type string, page string,"
                 "refers string, payload_bytes long, payload_digest string, at long, record long, start boolean,"
                 "chunks long"), "warc-marks")
    whole = marks.filter("chunks = 1")
    # a table of its own, so that Spark sees how small it is, and moves no text for it unless it is large
    parts = staged(marks.filter("chunks > 1").select("file", "block_start", "row", "at", "record"), "warc-parts")
    joined = (raw.join(parts, ["file", "block_start", "row"]).groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
              .select("file", "record", F.array_join(F.col("parts.value"), MAGIC).alias("value")))
    columns = ["file", "record", "page", "record_type", "refers", "payload_bytes", "payload_digest"]
    records = whole.select(*columns).unionByName(_told(joined).select(*columns))
    return records.select(
        "file", "record", F.expr("try_cast(page as bigint)").alias("page_id"), "record_type",
        F.when(F.col("record_type") == "revisit", F.expr("try_cast(refers as bigint)")).alias("refers_to"),
        "payload_bytes", "payload_digest")


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` written as archives into the shared folder and read back: one row per record."""
    folder = scratch(pages.sparkSession, "warc")
    write_archives(pages, folder, min_revisit_bytes)
    return read_archives(pages.sparkSession, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
