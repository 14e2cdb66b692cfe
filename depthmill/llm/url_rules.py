"""URL filter: allow and block rules in sorted digest arrays that tasks map into memory.

A rule is a host and the beginning of a path. Its text (host + path) is hashed by 64-bit xxHash; rules are range-sorted by
digest and written as shards (digests, text offsets, actions, texts) to the shared folder. A URL is probed with every
suffix of its host at a dot and every beginning of its path that some rule has the shape of (labels of the host, bytes
of the path). All probes of a batch go through one vectorised binary search in each shard's mapped digests; what is
found is confirmed against the stored text, through all rules of an equal digest, so collisions change nothing.

Only pages a search touches are read from a mapped shard, so the list may exceed a task's memory; nothing is broadcast
but the shards' paths and bounds, and the shapes.
"""

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.session import work_dir, written

#: Spark's xxhash64 has this seed.
SEED = 42
#: Rules of a shard, some 60 bytes each.
SHARD_RULES = 1 << 20
#: Shards that a worker keeps when the shared folder can't be mapped (they are then read whole).
SHARDS_HELD = 8
MAGIC = b"URLRULES"
ALLOW, BLOCK = "allow", "block"
#: Up to the end of the path: host in group 1, path in group 2.
ADDRESS = "://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHARD = "path string, n long, low long, high long"


def host(url: str = "url") -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(F.col(url), ADDRESS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: str = "url") -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(F.col(url), ADDRESS, 2), F.lit(""))


def digest(text: bytes) -> int:
    """Signed 64-bit digest, as Spark gives it."""
    value = xxhash.xxh64_intdigest(text, SEED)
    return value - (1 << 64) if value >> 63 else value


def write_shard(folder: str, keys: np.ndarray, texts: list[bytes], actions: np.ndarray) -> str:
    """A shard of rules in ascending order of digest; its path."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"rules-{uuid.uuid4().hex}.bin"
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    with system.open_output_stream(f"{root}/{name}") as out:
        for part in (MAGIC, np.array([len(keys)], "<i8"), keys.astype("<i8"), ends.astype("<i8"), actions.astype(np.uint8), b"".join(texts)):
            out.write(part if isinstance(part, bytes) else part.tobytes())
    return f"{folder}/{name}"


class Shard:
    """A mapped shard: `keys` in order, and the text and action of each."""

    def __init__(self, uri: str):
        system, place = fs.FileSystem.from_uri(uri)
        if isinstance(system, fs.LocalFileSystem):
            self.data = pa.memory_map(place).read_buffer()
        else:
            with system.open_input_file(place) as stream:
                self.data = stream.read_buffer()
        if self.data[: len(MAGIC)].to_pybytes() != MAGIC:
            raise ValueError(f"{uri} holds no rules")
        n = int(np.frombuffer(self.data, "<i8", 1, 8)[0])
        self.keys = np.frombuffer(self.data, "<i8", n, 16)
        self.ends = np.frombuffer(self.data, "<i8", n + 1, 16 + 8 * n)
        self.actions = np.frombuffer(self.data, np.uint8, n, 24 + 16 * n)
        self.first = 24 + 17 * n

    def text(self, i: int) -> bytes:
        return self.data[self.first + int(self.ends[i]) : self.first + int(self.ends[i + 1])].to_pybytes()

    def find(self, texts: list[bytes], digests: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place of a text, action) of the texts that are rules."""
        low = np.searchsorted(self.keys, digests, "left")
        high = np.searchsorted(self.keys, digests, "right")
        for k in np.flatnonzero(high > low).tolist():
            for i in range(int(low[k]), int(high[k])):
                if self.text(i) == texts[k]:
                    yield k, int(self.actions[i])


@lru_cache(maxsize=SHARDS_HELD)
def shard(uri: str) -> Shard:
    return Shard(uri)


class Index:
    """Where the shards of a rule list lie, and which shapes its rules have. Small: a row per shard, and per shape."""

    def __init__(self, shards: list[tuple[str, int, int]], shapes: list[tuple[int, int]]):
        self.shards = sorted(shards, key=lambda s: s[1])
        self.shapes: dict[int, list[int]] = {}
        for labels, size in sorted(shapes):
            self.shapes.setdefault(labels, []).append(size)

    def probes(self, name: bytes, way: bytes) -> Iterator[bytes]:
        """Texts of all rules that would fit the host and path."""
        labels = name.split(b".")
        for count, sizes in self.shapes.items():
            if count <= len(labels):
                suffix = b".".join(labels[-count:])
                for size in sizes:
                    if size <= len(way):
                        yield suffix + way[:size]

    def find(self, texts: list[bytes]) -> dict[bytes, int]:
        """The action of every text that is a rule."""
        digests = np.fromiter(map(digest, texts), np.int64, len(texts))
        found = {}
        for uri, low, high in self.shards:
            own = np.flatnonzero((digests >= low) & (digests <= high))
            if len(own):
                some = [texts[k] for k in own.tolist()]
                found.update((some[k], action) for k, action in shard(uri).find(some, digests[own]))
        return found

    def judge(self, hosts: list[bytes], ways: list[bytes]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of every URL; the longest rule that fits. Among as long ones, that of the longer host."""
        asked = [list(self.probes(name, way)) for name, way in zip(hosts, ways, strict=True)]
        known = self.find(list({text: None for own in asked for text in own}))
        out: list[tuple[str, str] | None] = []
        for own in asked:
            fits = [text for text in own if text in known]
            # Probes come in order of the host's labels: the last of the longest has the longest host.
            best = max(reversed(fits), key=len, default=None)
            out.append(None if best is None else (best.decode(), BLOCK if known[best] else ALLOW))
        return out


def build(rules: DataFrame, folder: str | None = None, shard_rules: int = SHARD_RULES) -> Index:
    """Sorted shards of rules (host, path, action: `allow` or `block`) in the shared folder.

    A null path is empty; hosts' A-Z become lower case. Rules without a host or with another action, and those that no URL can
    have (a host with `/`, `?` or `#`, a path that doesn't begin with `/`), are left out. Of contradicting
    rules the block holds. An empty list gives an index that finds nothing. Other columns are ignored.
    """
    folder = folder or work_dir(rules.sparkSession, "url-rules")
    name, way = F.translate(F.col("host").cast("string"), _UPPER, _LOWER), F.coalesce(F.col("path").cast("string"), F.lit(""))
    usable = rules.select(name.alias("host"), way.alias("path"), "action").where(F.col("action").isin(ALLOW, BLOCK) & ~F.col("host").rlike("[/?#]") & ((F.col("path") == "") | F.col("path").startswith("/")))
    one = usable.groupBy("host", "path").agg(F.max((F.col("action") == BLOCK).cast("int")).alias("action"))
    listed = written(one.select(F.concat("host", "path").alias("text"), F.xxhash64(F.concat("host", "path")).alias("key"), "action", F.size(F.split("host", "[.]", -1)).alias("labels"), F.octet_length("path").alias("size")), "url-rules")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            keys = whole.column("key").to_numpy()
            at = write_shard(folder, keys, [t.encode() for t in whole.column("text").to_pylist()], whole.column("action").to_numpy())
            yield pa.RecordBatch.from_pydict({"path": [at], "n": [len(keys)], "low": [int(keys[0])], "high": [int(keys[-1])]})

    # Equal digests stay together; a range is a shard, so its size is bounded.
    ranges = max(1, -(-listed.count() // shard_rules))
    sorted_rules = listed.select("text", "key", "action").repartitionByRange(ranges, "key").sortWithinPartitions("key", "text")
    shards = written(sorted_rules.mapInArrow(write, _SHARD), "url-rule-shards")
    return Index([(r.path, r.low, r.high) for r in shards.collect()], [(r.labels, r.size) for r in listed.select("labels", "size").distinct().collect()])


def judged(pages: DataFrame, index: Index, url_col: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """`pages` with host, path, rule and verdict in place of such columns; the rule is null where none fits, the verdict then `otherwise`.

    A rule fits its host and every subdomain, if the path begins with the rule's. A null URL, or one without `://`, has an
    empty host and path. Long URLs are looked at whole; repeated rows are judged alike; an empty table stays empty.
    """

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def judge(hosts: pa.Array, ways: pa.Array) -> pa.Array:
        found = index.judge([x.encode() for x in hosts.to_pylist()], [x.encode() for x in ways.to_pylist()])
        rules = pa.array([x and x[0] for x in found], pa.string())
        return pa.StructArray.from_arrays([rules, pa.array([x[1] if x else otherwise for x in found], pa.string())], names=["rule", "verdict"])

    address, found = (f"{uuid.uuid4().hex}" for _ in range(2))  # no column of the pages has such a name
    own = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    at = pages.select(*own, F.struct(host(url_col).alias("host"), path(url_col).alias("path")).alias(address))
    at = at.withColumn(found, judge(F.col(address)["host"], F.col(address)["path"]))
    return at.select(*own, *(F.col(address)[c].alias(c) for c in ("host", "path")), *(F.col(found)[c].alias(c) for c in ("rule", "verdict")))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule list from (action, host, path)."""
    return spark.createDataFrame([(h, p, a) for a, h, p in rules], "host string, path string, action string")


#: The contract's rules: action, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

ORACLE_SQL = """
WITH rules(action, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
addresses AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
known AS (SELECT DISTINCT host, path FROM addresses),
fits AS (
  SELECT k.host, k.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.action, length(r.host || r.path)) AS action
  FROM known k JOIN rules r ON (k.host = r.host OR ends_with(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
  GROUP BY k.host, k.path)
SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM addresses a LEFT JOIN fits f ON a.host = f.host AND a.path = f.path
"""
