"""URL filter: a trie over reversed host labels, then path segments; the longest rule that fits decides."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 1_000_000
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_UPPER), slash + path


class Trie:
    """Rules ``(verdict, host/path)``; a rule fits its host, all subdomains, and paths that start with its own.

    The rule with more host labels wins, then the one with the longer path; of the same
    rule with both verdicts, the block.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for count, (verdict, rule) in enumerate(rules, 1):
            if count > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules: the trie would be too large to send to all tasks")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")):
                node = node.setdefault(label, {})
            # "/a/b" is the segments "" and "a" that must be whole, and "b" that a path segment must start with
            *whole, last = (slash + path).split("/")
            node = node.setdefault(None, {})
            for segment in whole:
                node = node.setdefault(("/", segment), {})
            ends = node.setdefault("", {})
            node.setdefault("sizes", set()).add(len(last))
            if last not in ends or verdict == BLOCK:
                ends[last] = (rule, verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that decides and its verdict."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._match_path(node[None], path) or best
        return best

    @staticmethod
    def _match_path(node: dict, path: str) -> tuple[str, str] | None:
        best, segments = None, path.split("/")
        for k, segment in enumerate(segments):
            ends = node.get("")
            if ends:
                fits = [size for size in node["sizes"] if segment[:size] in ends]
                best = ends[segment[: max(fits)]] if fits else best
            if k == len(segments) - 1:
                break
            node = node.get(("/", segment))
            if node is None:
                break
        return best


def judge_urls(
    df: DataFrame, rules: Iterable[tuple[str, str]], id_column: str = "page_id", url_column: str = "url", *, default: str = ALLOW
) -> DataFrame:
    """One row per row of ``df``: the id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` (``default`` if none fits).

    The rules (at most MAX_RULES) become a trie that is sent to the tasks once. A null url, or one without
    ``://``, has empty host and path, which no rule with a host fits. An empty path starts with no rule's path but the empty one.
    Repeated rows are judged each; only the two named columns are read.
    """
    trie = df.sparkSession.sparkContext.broadcast(Trie(rules).root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Trie(())
        known.root = trie.value
        for batch in batches:
            split = [split_url(url) for url in batch.column("url").to_pylist()]
            found = [known.match(host, path) or (None, default) for host, path in split]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()),
                    pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string()),
                ],
                ["id", "host", "path", "rule", "verdict"],
            )

    source = df.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")
    return found.withColumnRenamed("id", id_column)
