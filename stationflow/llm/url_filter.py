"""URL filters: rules by host and path prefix, and a block list of hosts, held
in one sorted digest array.

The index is three flat arrays in one file: the 64-bit xxhash of every key in
sorted order, offsets, and the full key strings. Workers memory-map the file,
probe all candidate keys of a batch by one vectorised binary search, and
confirm every hit against the stored string, so colliding digests never decide.
Spark ships the file to each executor (``addFile``) after its size was checked
against a bound. A longer block list is cut into digest ranges of about that bound:
the distinct hosts and parent domains of the pages go to the task of their range,
which maps that range's part of the array and probes it in the same way.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is allowed; an empty path starts with no rule path; of fitting rules
the longest string wins, of equally long ones the longer host; repeated rows are
judged alike; an empty table gives no rows."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import stored

ALLOW, BLOCK = "allow", "block"
#: Rules of the contract: verdict by host and path prefix (fixed values).
RULES = (("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW), ("net/es/", BLOCK), ("net/fr/", BLOCK))
#: Host labels that put a host on the block list (fixed values).
BLOCKED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: Bytes of keys up to which the index goes to every executor as a file.
MOST_INDEX_BYTES = 64 << 20
#: Seed of the digests, that of Spark's own ``xxhash64``, so that both agree on ranges.
_SEED = 42
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    has = F.expr(f"coalesce(locate('://', {url}), 0) > 0")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.expr(f"substring({url}, locate('://', {url}) + 3 + length(_a))"), r"^[^?#]*", 0)
    empty = F.lit("")
    return (
        pages.withColumn("_a", F.when(has, authority).otherwise(empty))
        .withColumn("path", F.when(has, path).otherwise(empty))
        .withColumn("host", F.translate("_a", _UPPER, _LOWER))
        .drop("_a")
    )


def blocked_hosts(parsed: DataFrame, labels: tuple[str, ...] = BLOCKED_LABELS) -> DataFrame:
    """Distinct hosts with one of the labels: the block list that the given
    pages yield, one key per host."""
    has = F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in labels]))
    return parsed.where(has).select(F.col("host").alias("key")).distinct()


def _digests(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(k, seed=_SEED) for k in keys), dtype=np.uint64, count=len(keys))


def index_bytes(keys: list[bytes]) -> bytes:
    """The sorted digest array with its full strings."""
    digests = _digests(keys)
    order = np.argsort(digests, kind="stable")
    ends = np.cumsum([0, *(len(keys[i]) for i in order)], dtype=np.uint64)
    return b"".join((np.uint64(len(keys)).tobytes(), digests[order].tobytes(), ends.tobytes(), *(keys[i] for i in order)))


def write_index(keys: list[bytes], path: str) -> None:
    with open(path, "wb") as f:
        f.write(index_bytes(keys))


class DigestIndex:
    """A memory-mapped index, of a file or of bytes that a task has built;
    :meth:`contains` probes many keys at once."""

    def __init__(self, index: str | bytes) -> None:
        if isinstance(index, bytes):
            self.map = mmap.mmap(-1, len(index))
            self.map.write(index)
        else:
            with open(index, "rb") as f:
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.map, np.uint64, 1)[0])
        self.digests = np.frombuffer(self.map, np.uint64, n, 8)
        self.ends = np.frombuffer(self.map, np.uint64, n + 1, 8 + 8 * n)
        self.start = 16 + 16 * n

    def _at(self, i: int) -> bytes:
        return self.map[self.start + int(self.ends[i]) : self.start + int(self.ends[i + 1])]

    def contains(self, keys: list[bytes]) -> np.ndarray:
        digests = _digests(keys)
        first = np.searchsorted(self.digests, digests, side="left")
        last = np.searchsorted(self.digests, digests, side="right")
        found = np.zeros(len(keys), dtype=bool)
        for k in np.nonzero(last > first)[0]:  # confirm each hit; equal digests of other strings are passed over
            found[k] = any(self._at(i) == keys[k] for i in range(first[k], last[k]))
        return found


def _suffixes(host: str) -> list[str]:
    """The host and its parent domains, longest first."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def candidate_keys(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """Every key that could fit, best first: rules by total length, then by
    host. A block-list key is a bare host, a rule key holds a slash."""
    if not host:
        return []
    hosts = _suffixes(host)
    rules = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in path_lengths if n <= len(path)]
    return [k for *_, k in sorted(rules, reverse=True)] + hosts


def filter_urls(
    pages: DataFrame,
    block_list: DataFrame | None = None,
    *,
    rules: tuple[tuple[str, str], ...] = RULES,
    most_index_bytes: int = MOST_INDEX_BYTES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``block_list`` has host keys in ``key``; a host is blocked if it or a
    parent domain is listed and no rule fits."""
    parsed = with_host_path(pages.select("page_id", "url")).select("page_id", "host", "path")
    verdicts = dict(rules)
    lengths = sorted({len(r) - r.index("/") for r in verdicts})
    spark = pages.sparkSession
    kind = dict(pages.dtypes)["page_id"]
    schema = f"page_id {kind}, host string, path string, rule string, verdict string"
    size = 0 if block_list is None else block_list.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    if size > most_index_bytes:
        parsed, listed = _with_listed(parsed, block_list, size, most_index_bytes), []
    else:
        parsed = parsed.withColumn("listed", F.lit(False))
        listed = [] if block_list is None else [r[0].encode() for r in block_list.where("key IS NOT NULL").collect()]  # size checked above
    name = f"url-index-{uuid.uuid4().hex}"
    with tempfile.TemporaryDirectory() as folder:
        write_index(sorted({*listed, *(r.encode() for r in verdicts)}), os.path.join(folder, name))
        content = open(os.path.join(folder, name), "rb").read()
    # The file must outlive this call: the frame is lazy. Spark copies it to
    # every executor that joins later, so a lost one gets it again.
    kept = os.path.join(spark.sparkContext._temp_dir, name)
    with open(kept, "wb") as f:
        f.write(content)
    spark.sparkContext.addFile(kept)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(SparkFiles.get(name))
        for batch in batches:
            pairs = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            keys = [candidate_keys(h, p, lengths) for h, p in pairs]
            flat = [k for own in keys for k in own]
            hit = iter(index.contains([k.encode("utf-8", "surrogatepass") for k in flat]).tolist())
            rule, verdict = [], []
            for own, blocked in zip(keys, batch.column(3).to_pylist(), strict=True):
                fits = [k for k in own if next(hit)]
                best = next((k for k in fits if k in verdicts), None)
                rule.append(best)
                verdict.append(verdicts[best] if best else BLOCK if fits or blocked else ALLOW)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return parsed.mapInArrow(judged, schema)


def _with_listed(parsed: DataFrame, block_list: DataFrame, size: int, most: int) -> DataFrame:
    """Adds whether the host or a parent domain is on a block list of any size.
    Hosts and domains are probed once each, in the task of their digest range."""
    parents = F.expr("transform(sequence(1, size(l)), i -> concat_ws('.', slice(l, i, size(l))))")
    hosts = parsed.select("host").where("host <> ''").distinct().withColumn("l", F.split("host", r"\."))
    domains = stored(hosts.select("host", F.explode(parents).alias("key")), "url-domains")
    probes = domains.select("key").distinct()
    asked = probes.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    bits = (max(size, asked) // most).bit_length() if most else 4
    span = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits) if bits else F.lit(0).cast("long")

    def probed(_: tuple[pa.Scalar, ...], keys: pa.Table, asked: pa.Table) -> pa.Table:
        own = asked["key"].to_pylist()
        if not own or not keys.num_rows:
            return asked.select(["key"]).slice(0, 0)
        index = DigestIndex(index_bytes([k.encode("utf-8", "surrogatepass") for k in keys["key"].to_pylist()]))
        return asked.select(["key"]).filter(pa.array(index.contains([k.encode("utf-8", "surrogatepass") for k in own])))

    ranged = [df.select(span.alias("span"), "key").groupBy("span") for df in (block_list.select("key").where("key IS NOT NULL").distinct(), probes)]
    found = ranged[0].cogroup(ranged[1]).applyInArrow(probed, "key string")
    hit = domains.join(found, "key", "left_semi").select("host").distinct().withColumn("listed", F.lit(True))
    return parsed.join(hit, "host", "left").select("page_id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed"))
