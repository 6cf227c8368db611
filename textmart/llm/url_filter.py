"""URL rules looked up in a sorted array of digests.

A rule is `host/path-start`, with a verdict. It fits the URLs of its host and of all
hosts below it whose path begins with the rule's path. Of all rules that fit, the
longest rule string wins (of equally long ones that with the longer host, then the
first in order of text).

The rules are sorted by the 64-bit xxhash of their text into files of about
SHARD_BYTES: digests, verdicts, and the full strings. Each file holds a range of digests and is
written by one task to the shared folder, where tasks memory-map it. For
each URL the possible rules (each ending of the host with each path length that some
rule has) are hashed and found by binary search over whole batches; a hit counts only
if the stored string equals the wanted one. With one file tasks judge whole rows; with
several, the possible rules of distinct hosts and paths go to the file of their digest.

Defined cases: a null URL or one without `://` has an empty host and path, which no
rule fits. An empty host label is part of the host. Without a fitting rule the rule is
null and the verdict `default`. A rule without `/` gets the path `/`, a null one is none. A repeated rule counts once (block before allow). An
empty rule table decides nothing. Rows are kept as they are, repeated ones too;
columns with the names of the result are replaced.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import LocalFileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from textmart.llm.common import by_value, slices, written
from textmart.session import scratch_path
from textmart.sizes import broadcast_if_small
from textmart.sources.files import shared

SHARD_BYTES = 256 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Text after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_of(rules: DataFrame, rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """(rule, verdict), each rule once; a rule without a path gets the path `/`."""
    text = F.when(F.col(rule).contains("/"), F.col(rule)).otherwise(F.concat(F.col(rule), F.lit("/")))
    rules = rules.select(text.alias("rule"), F.col(verdict).alias("verdict")).where("rule is not null")
    return rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))


def shard_of(digest: Column, n: int) -> Column:
    """Shards are equal ranges of digests, which are even: no shard is much larger than others."""
    return F.shiftright(F.shiftrightunsigned(digest, 32) * n, 32).cast("int")


def write_shards(rules: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> list[str]:
    """Write the rules as sorted files to a shared folder, one task a file; their paths in order of digest."""
    size = rules.agg(F.sum(F.octet_length("rule") + 17)).first()[0] or 0
    n = max(1, math.ceil(size / shard_bytes))
    system, path = shared(folder)
    system.create_dir(path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.fromiter((xxh64_intdigest(r.encode()) for r in batch.column("rule").to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([*batch.columns, pa.array(keys.view(np.int64))], names=["rule", "verdict", "digest"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list[tuple[int, bytes, bool]]] = defaultdict(list)  # one of them, unless tasks were joined
        for batch in batches:
            keys = batch.column("digest").to_numpy().view(np.uint64).tolist()
            for at, key, rule, verdict in zip(batch.column("shard").to_pylist(), keys, batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()):
                shards[at].append((key, rule.encode(), verdict == "block"))
        for at, held in shards.items():
            held.sort()
            yield pa.record_batch([pa.array([at], pa.int32()), pa.array([stored(held)])], names=["shard", "file"])

    def stored(held: list[tuple[int, bytes, bool]]) -> str:
        name = f"{folder}/rules-{uuid.uuid4().hex}.bin"
        system, path = shared(name)
        with system.open_output_stream(path, compression=None) as out:
            ends = np.cumsum([len(t) for _, t, _ in held], dtype="<i8")
            for part in (np.array([len(held)], "<i8"), np.array([k for k, _, _ in held], "<u8"), ends, np.array([b for _, _, b in held], np.uint8)):
                out.write(part.tobytes())
            out.write(b"".join(t for _, t, _ in held))
        return name

    keyed = rules.mapInArrow(by_value(digests), "rule string, verdict string, digest long").withColumn("shard", shard_of(F.col("digest"), n))
    files = written(keyed.repartitionById(n, "shard").mapInArrow(by_value(write), "shard int, file string"), "rule_files")
    found = {r.shard: r.file for r in files.collect()}  # n rows
    return [found.get(i, "") for i in range(n)]


class Shard:
    """One file of rules: memory-mapped where the shared folder is mounted, else read."""

    def __init__(self, path: str) -> None:
        system, place = shared(path)
        if isinstance(system, LocalFileSystem):
            raw = np.memmap(place, np.uint8, "r")
        else:
            with system.open_input_stream(place, compression=None) as source:
                raw = np.frombuffer(source.read(), np.uint8)
        n = int(raw[:8].view("<i8")[0])
        self.keys = raw[8 : 8 + 8 * n].view("<u8")
        self.ends = raw[8 + 8 * n : 8 + 16 * n].view("<i8")
        self.blocks = raw[8 + 16 * n : 8 + 17 * n]
        self.text = raw[8 + 17 * n :]

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """Place of each string, or -1."""
        keys = np.fromiter(map(xxh64_intdigest, wanted), np.uint64, len(wanted))
        place = np.full(len(wanted), -1, np.int64)
        at = np.searchsorted(self.keys, keys)
        todo = np.flatnonzero(at < len(self.keys))
        todo = todo[self.keys[at[todo]] == keys[todo]]
        while len(todo):  # more than once only where digests collide
            for i in todo:
                a = at[i]
                low = self.ends[a - 1] if a else 0
                if self.text[low : self.ends[a]].tobytes() == wanted[i]:
                    place[i] = a
            todo = todo[place[todo] < 0]
            at[todo] += 1
            todo = todo[at[todo] < len(self.keys)]
            todo = todo[self.keys[at[todo]] == keys[todo]]
        return place


def possible_rules(host: str, path: str, lengths: list[int]) -> list[tuple[int, int, str]]:
    """(rule length, host length, rule) of every rule that could fit."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    return [(len(h) + n, len(h), h + path[:n]) for n in lengths if n <= len(path) for h in hosts]


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows with `host`, `path`, `rule` and `verdict`. With one file of rules no page is shuffled."""
    rules = written(rules_of(rules), "rules")
    # As many as there are different lengths of paths.
    lengths = [r[0] for r in rules.select(F.length("rule") - F.instr("rule", "/") + 1).distinct().collect()]
    files = write_shards(rules, scratch_path(pages.sparkSession, "shards"), shard_bytes) if lengths else []
    taken = {"host", "path", "rule", "verdict"}
    sites = pages.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in taken or c == url],
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    )
    if len(files) > 1:
        found = best_rules(sites.select("host", "path").distinct(), files, lengths)
        found = broadcast_if_small(written(found, "judged"))
        out = sites.join(found, ["host", "path"], "left").select(*sites.columns, "rule", "verdict")
    else:
        out = sites.select(*sites.columns, F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
        if files:
            out = out.mapInArrow(by_value(probe(files[0], lengths, out.schema.names)), T.StructType(out.schema.fields))
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def probe(file: str, lengths: list[int], columns: list[str]):
    """Judge whole rows by the one file of rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(file)
        for batch in slices(batches, "path"):
            # Pages of one host and path are probed once.
            sites = list(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()))
            options = [(site, *option) for site in set(sites) for option in possible_rules(*site, lengths)]
            best: dict[tuple[str, str], tuple] = {}
            for (site, size, of_host, rule), at in zip(options, shard.find([o[3].encode() for o in options]).tolist()):
                mine = (size, of_host, rule, "block" if shard.blocks[at] else "allow")
                if at >= 0 and (site not in best or outranks(mine, best[site])):
                    best[site] = mine
            found = [best.get(site) for site in sites]
            out = {c: batch.column(c) for c in columns}
            out["rule"] = pa.array([f and f[2] for f in found], pa.string())
            out["verdict"] = pa.array([f and f[3] for f in found], pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), names=columns)

    return run


def best_rules(sites: DataFrame, files: list[str], lengths: list[int]) -> DataFrame:
    """(host, path, rule, verdict) of each site that a rule fits: possible rules go to the file of their digest, in one stage for all files."""

    def options(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "path", 1 << 20):
            rows = [(h, p, *o, xxh64_intdigest(o[2].encode())) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()) for o in possible_rules(h, p, lengths)]
            for i in range(0, len(rows), 10_000):
                part = list(zip(*rows[i : i + 10_000]))
                digest = np.array(part[5], np.uint64).view(np.int64)
                yield pa.record_batch([pa.array(part[0]), pa.array(part[1]), pa.array(part[2], pa.int32()), pa.array(part[3], pa.int32()), pa.array(part[4]), pa.array(digest)], names=["host", "path", "size", "of_host", "rule", "digest"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shard = None
        for whole in batches:
            shards = whole.column("shard").to_numpy()
            for number in np.unique(shards).tolist():
                if not files[number]:
                    continue
                if number != now:
                    now, shard = number, Shard(files[number])
                batch = whole.filter(pa.array(shards == number))
                at = shard.find([r.encode() for r in batch.column("rule").to_pylist()])
                hits = np.flatnonzero(at >= 0)
                verdict = pa.array(["block" if shard.blocks[a] else "allow" for a in at[hits]], pa.string())
                yield pa.record_batch([*[batch.column(c).take(pa.array(hits)) for c in ("host", "path", "size", "of_host", "rule")], verdict], names=["host", "path", "size", "of_host", "rule", "verdict"])

    asked = sites.mapInArrow(by_value(options), "host string, path string, size int, of_host int, rule string, digest long")
    routed = asked.withColumn("shard", shard_of(F.col("digest"), len(files))).repartitionById(len(files), "shard")
    found = routed.mapInArrow(by_value(find), "host string, path string, size int, of_host int, rule string, verdict string")
    rank = F.struct((-F.col("size")).alias("a"), (-F.col("of_host")).alias("b"), "rule", "verdict")
    return found.groupBy("host", "path").agg(F.min(rank).alias("best")).select("host", "path", "best.rule", "best.verdict")


def outranks(a: tuple, b: tuple) -> bool:
    """Longer rule, then longer host, then first in order of text."""
    return a[:2] > b[:2] or a[:2] == b[:2] and a[2] < b[2]
