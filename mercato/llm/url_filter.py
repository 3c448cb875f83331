"""URL filter: allow and block entries in one trie over reversed host labels and path segments.

An entry `host/path` fits its host and all subdomains if the URL's path starts with the entry's path. The longest entry
wins: more host labels first, then the longer path; of two equal entries the blocking one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
MOST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_entry(entry: str) -> tuple[str, str]:
    host, slash, path = entry.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


class Trie:
    """Nodes are dicts: labels of hosts from the last to the first, then, below "/", segments of paths.

    The last part of an entry's path is a prefix of a segment (or empty), kept at the node of the segments before it.
    """

    def __init__(self, entries: list[tuple[str, str]], root: dict | None = None):
        self.root: dict = {} if root is None else root
        for entry, verdict in entries:
            host, path = split_entry(entry)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            *whole, prefix = path.split("/")
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            ends = node.setdefault("", {})
            if ends.get(prefix, ("", ALLOW))[1] != BLOCK:
                ends[prefix] = (entry, verdict)
            node["lengths"] = sorted({len(p) for p in ends}, reverse=True)

    @staticmethod
    def _longest(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for depth, segment in enumerate(segments):
            ends = node.get("", {})
            best = next((ends[segment[:n]] for n in node.get("lengths", ()) if n <= len(segment) and segment[:n] in ends), best)
            node = node.get("/" + segment) if depth < len(segments) - 1 else None
            if node is None:
                break
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest entry that fits, with its verdict."""
        node, best, segments = self.root, None, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                best = self._longest(node["/"], segments) or best
        return best


def _by_trie(urls: DataFrame, entries: list[tuple[str, str]], default: str) -> DataFrame:
    sent = urls.sparkSession.sparkContext.broadcast(Trie(entries).root)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie([], sent.value)
        for batch in batches:
            found = [trie.find(h, p) or (None, default)
                     for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")


def _by_join(urls: DataFrame, entries: DataFrame, default: str) -> DataFrame:
    """The same for any number of entries: each distinct (host, path) looks up its host suffixes and path folders."""
    path = F.expr("substr(entry, length(substring_index(entry, '/', 1)) + 1)")
    folder = F.regexp_extract("e_path", "(?s)^(.*/)?", 0)
    known = (entries.select("entry", "verdict", F.translate(F.substring_index("entry", "/", 1), UPPER, LOWER).alias("e_host"),
                            path.alias("e_path"))
             .groupBy("e_host", "e_path").agg(F.max_by(F.struct("entry", "verdict"), "verdict").alias("own"))
             .select("e_host", "e_path", folder.alias("e_folder"), F.col("own.entry").alias("entry"), F.col("own.verdict").alias("verdict")))
    labels, parts = F.split("host", r"\.", -1), F.split("path", "/", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.when(i == 0, "").otherwise(
        F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))
    asked = urls.select("host", "path").distinct()
    keys = asked.select("host", "path", F.explode(suffixes).alias("e_host")).select(
        "host", "path", "e_host", F.explode(folders).alias("e_folder"))
    rank = F.struct(F.size(F.split("e_host", r"\.", -1)), F.length("e_path"))
    best = (keys.join(known, ["e_host", "e_folder"]).filter(F.col("path").startswith(F.col("e_path")))
            .groupBy("host", "path").agg(F.max_by(F.struct("entry", "verdict"), rank).alias("own"))
            .select("host", "path", F.col("own.entry").alias("rule"), F.col("own.verdict").alias("verdict")))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def judge_urls(pages: DataFrame, entries: list[tuple[str, str]] | DataFrame, default: str = ALLOW, id_col: str = "page_id",
               url_col: str = "url", most_bytes: int = MOST_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages.

    entries: (entry, "allow" or "block"), or a table (entry, verdict). Up to `most_bytes` of entries go to the tasks as
    a broadcast trie; more of them are joined. Host and path of a null URL or one without "://" are empty. Where no
    entry fits, rule is null and the verdict is `default`: a list that blocks leaves unknown URLs alone. An empty list
    judges everything by default. Rows are judged one by one, so repeated rows and ids stay; other columns are ignored.
    """
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    if not isinstance(entries, list):
        size = entries.agg(F.sum(F.length("entry")), F.count("*")).first()
        if (size[0] or 0) + 200 * size[1] > most_bytes:
            return _by_join(urls, entries, default)
        entries = [(r["entry"], r["verdict"]) for r in entries.select("entry", "verdict").toLocalIterator()]
    elif sum(len(e) + 200 for e, _ in entries) > most_bytes:
        return _by_join(urls, urls.sparkSession.createDataFrame(entries, "entry string, verdict string"), default)
    return _by_trie(urls, entries, default)
