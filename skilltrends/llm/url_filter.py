"""Operator 5. URL filters: a trie over reversed host labels and path segments.

A rule is (verdict, host, path). Its key is the host's labels from the last to the first, then its
path's segments; a segment is a run between slashes, and the last one may match the front of a
longer one (a rule's path is a plain prefix of the url's). One walk down the labels and then the
segments meets every rule that fits a url; the deepest wins: more host labels first, then the longer
path. A rule without a host fits every host. Equal keys: block wins over allow.

The rules go to the tasks in blocks of ``block_rules``, each one trie and one broadcast of bounded
size; with more rules the blocks are applied one after the other and the longest match is kept.
Urls never shuffle.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule but one
without a host can fit it. Where no rule fits, the verdict is ``default`` (allow). Null ids and
repeated rows are judged row by row; an empty table gives an empty result; input columns named like a
result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, packed, shared, with_columns

BLOCK_RULES = 200_000

#: The rules of the registered query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nested dictionaries: host labels from the last to the first, under PATH the path segments, under
    RULES the rules that end here: by length, the longest first, {front of the next segment: (verdict, name)}. A
    segment looks up its own fronts, one of each length that rules have, however many rules there are."""

    PATH, RULES = 0, 1  # no string equals a number

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            *segments, front = path.split("/")
            node = node.setdefault(self.PATH, {})
            for s in segments:
                node = node.setdefault(s, {})
            fronts = node.setdefault(self.RULES, {}).setdefault(len(front), {})
            if verdict == "block" or front not in fronts:
                fronts[front] = (verdict, host + path)
        nodes = [self.root]
        while nodes:
            node = nodes.pop()
            nodes.extend(v for k, v in node.items() if k != self.RULES)
            if self.RULES in node:
                node[self.RULES] = dict(sorted(node[self.RULES].items(), reverse=True))

    def find(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(host labels, path length, verdict, rule) of the longest rule that fits."""
        nodes, node = [(0, self.root)], self.root
        for depth, label in enumerate(reversed(host.split(".")) if host else (), 1):
            node = node.get(label)
            if node is None:
                break
            nodes.append((depth, node))
        segments = path.split("/")
        for depth, node in reversed(nodes):
            node, best, length = node.get(self.PATH), None, 0
            for s in segments:
                if node is None:
                    break
                for n, fronts in node.get(self.RULES, {}).items():
                    rule = fronts.get(s[:n]) if n <= len(s) else None
                    if rule:
                        best = (depth, length + n, *rule)
                        break
                node, length = node.get(s), length + len(s) + 1
            if best:
                return best
        return None


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow",
                block_rules: int = BLOCK_RULES, url_col: str = "url", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``pages`` with host, path, rule (host + path of the rule, else null), verdict.
    ``carry``: the input columns to keep (default: all)."""
    match = T.StructType([T.StructField("labels", T.IntegerType()), T.StructField("length", T.IntegerType()),
                          T.StructField("verdict", T.StringType()), T.StructField("rule", T.StringType())])
    kind = pa.struct([("labels", pa.int32()), ("length", pa.int32()), ("verdict", pa.string()), ("rule", pa.string())])
    columns = carried(pages, carry)
    rows = packed(pages, columns, host=host_of(col(url_col)), path=path_of(col(url_col)))
    found = []
    for k, at in enumerate(range(0, max(1, len(rules)), block_rules)):
        trie = shared(pages.sparkSession, Trie(rules[at:at + block_rules]))

        def run(batches: Iterator[pa.RecordBatch], trie=trie, k=k) -> Iterator[pa.RecordBatch]:
            t, names = trie(), ("labels", "length", "verdict", "rule")
            for batch in batches:
                hits = [t.find(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
                out = pa.array([h and dict(zip(names, h)) for h in hits], kind)
                yield with_columns(batch, {f"m{k}": out}, batch.schema.names)

        rows = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(f"m{k}", match)]))
        found.append(F.col(f"m{k}"))
    # the longest of all blocks; of equal ones block, which sorts after allow
    best = found[0] if len(found) == 1 else F.greatest(*found)
    rows = rows.withColumn("best", best)
    taken = {"host", "path", "rule", "verdict"}
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken], "host", "path",
                       F.col("best")["rule"].alias("rule"), F.coalesce(F.col("best")["verdict"], F.lit(default)).alias("verdict"))
