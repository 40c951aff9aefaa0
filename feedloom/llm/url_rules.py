"""URL rules as a sort-merge range join.

With its labels reversed, a rule's host is a prefix of the hosts it covers, so each rule host
owns one interval of the sorted hosts. Spark sorts the urls of a partition by that key; one
sweep over them and the sorted rules keeps a stack of the rule hosts whose interval is open.
Below each open host the same holds for paths. Urls are not exchanged: each partition meets the
rules in blocks of bounded size, one sweep per block, and keeps the longest rule that fits.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.text import spare

ALLOW, BLOCK = "allow", "block"
# Rules one task holds at a time.
BLOCK_RULES = 200_000


def host_of(url: Column) -> Column:
    """Host after the first ``://`` with A-Z lowered; empty without one."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Path behind the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by NUL, which sorts a host before its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\0"), F.lit("\0"))


def _host_key(host: str) -> str:
    return "\0".join(reversed(host.split("."))) + "\0"


class _Paths:
    """Path rules of one host, sorted; each knows the longest other rule that is its prefix."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.paths, self.rules, self.up = [], [], []
        stack: list[int] = []
        for path, rule, verdict in sorted(rules):
            while stack and not path.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.up.append(stack[-1] if stack else -1)
            stack.append(len(self.paths))
            self.paths.append(path)
            self.rules.append((rule, verdict))

    def longest(self, path: str) -> tuple[str, str] | None:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.up[i]
        return self.rules[i] if i >= 0 else None


def _sweep(rules: list[tuple[str, str, str]], columns: tuple[str, ...]):
    """Function over the sorted batches of a partition; ``rules`` are (host, path, verdict)."""
    key_c, path_c, rule_c, verdict_c = columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grouped: dict[str, list] = {}
        for host, path, verdict in rules:
            grouped.setdefault(_host_key(host), []).append((path, host + path, verdict))
        starts = sorted(grouped, key=lambda k: k.encode())
        below = {k: _Paths(v) for k, v in grouped.items()}
        at, stack = 0, []
        for batch in batches:
            found, verdicts = [], []
            old = zip(batch.column(rule_c).to_pylist(), batch.column(verdict_c).to_pylist())
            urls = zip(batch.column(key_c).to_pylist(), batch.column(path_c).to_pylist())
            for (key, path), best in zip(urls, old):
                while stack and not key.startswith(stack[-1]):
                    stack.pop()
                # Open the intervals that start up to this key; those that have ended are passed.
                while at < len(starts) and starts[at].encode() <= key.encode():
                    if key.startswith(starts[at]):
                        stack.append(starts[at])
                    at += 1
                for k in stack:
                    hit = below[k].longest(path)
                    if hit and (best[0] is None or _rank(hit) > _rank(best)):
                        best = hit
                found.append(best[0])
                verdicts.append(best[1])
            out = batch.columns[:-2] + [pa.array(found, pa.string()),
                                        pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=batch.schema.names)
    return run


def _rank(rule: tuple[str, str]) -> tuple:
    """The longest rule wins; of equal length block before allow, then the greater text."""
    return len(rule[0]), rule[1] == BLOCK, rule[0]


def _blocks(rules: Iterable[tuple[str, str, str]], size: int) -> Iterator[list]:
    block: list = []
    for r in rules:
        block.append(r)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url",
          default: str = ALLOW, block_rules: int = BLOCK_RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (and without columns of those names).

    ``rules`` are (host, path, verdict); an iterator is drawn block by block. A rule fits its
    host and all subdomains where the path starts with the rule's path. The longest rule wins;
    of two equally long ones, block. Without a fitting rule, and for urls that are null or
    lack ``://``, ``rule`` is null and the verdict is ``default``. Every row comes back, repeated
    ones too; an empty table gives an empty result.
    """
    own = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    own = own.drop("rule", "verdict")
    key = spare(own, "key")
    carried = [c for c in own.columns]
    own = own.withColumn(key, host_key(F.col("host"))).sortWithinPartitions(key)
    own = own.withColumns({"rule": F.lit(None).cast("string"),
                           "verdict": F.lit(None).cast("string")})
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in own.schema])
    for block in _blocks(rules, block_rules):
        own = own.mapInArrow(_sweep(block, (key, "path", "rule", "verdict")), schema)
    return own.select(*carried, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
