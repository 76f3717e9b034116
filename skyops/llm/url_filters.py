"""URL rules by a sorted array of digests.

A rule is a host and a path prefix. The 64-bit xxhash keys of all rules lie sorted in a file that
each task maps into memory; every host suffix with every path prefix of a length that rules have is
looked up by vectorised binary search, and a hit counts only if the stored string is the same. More
rules than one shard holds are probed shard by shard.

Cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; a URL that
fits no rule gets the default verdict and a null rule; among fitting rules the longest string wins,
then the longer host; a rule given twice counts once, its first verdict holds; no rules at all give
the default everywhere; empty tables give no rows; added columns replace columns of the same names.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.llm.batches import append

#: Rules in one shard; about 100 bytes each reach every task.
SHARD = 1_000_000

Rule = tuple[str, str, str]  # host, path, verdict


def digests(texts: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)


class Index:
    """Rules of one shard: sorted keys, with the rules in the order of their keys."""

    def __init__(self, rules: list[Rule]):
        rules = list({(h, p): (h, p, v) for h, p, v in reversed(rules)}.values())
        keys = digests(h + p for h, p, _ in rules)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order].tobytes()
        self.rules = [rules[k] for k in order]
        self.lengths = sorted({len(p) for _, p, _ in rules})

    def mapped(self) -> np.ndarray:
        """The keys as a file in memory, which goes with the task."""
        if not self.keys:
            return np.zeros(0, np.uint64)
        self._file = tempfile.TemporaryFile()  # noqa: SIM115  closed with the index
        self._file.write(self.keys)
        self._file.flush()
        return np.memmap(self._file, np.uint64, "r")

    def candidates(self, host: str, path: str) -> Iterable[tuple[str, str]]:
        """Suffixes of the host with prefixes of the path, as rules may have them."""
        if not host:
            return
        starts = [0, *(k + 1 for k, c in enumerate(host) if c == ".")]
        for s in starts:
            for n in self.lengths:
                if n <= len(path):
                    yield host[s:], path[:n]


def best_rules(index: Index, keys: np.ndarray, hosts: list[str], paths: list[str]) -> list[Rule | None]:
    """The rule that wins for each URL."""
    rows, tried = [], []
    for k, (h, p) in enumerate(zip(hosts, paths, strict=True)):
        found = list(index.candidates(h, p))
        rows += [k] * len(found)
        tried += found
    best: list[Rule | None] = [None] * len(hosts)
    if not tried:
        return best
    wanted = digests(h + p for h, p in tried)
    low, high = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
    for t in np.flatnonzero(low < high):
        for at in range(low[t], high[t]):
            rule, row = index.rules[at], rows[t]
            if rule[:2] == tried[t] and (best[row] is None or _weight(rule) > _weight(best[row])):
                best[row] = rule
    return best


def _weight(rule: Rule) -> tuple[int, int]:
    return len(rule[0]) + len(rule[1]), len(rule[0])


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    part = lambda k: F.regexp_extract(F.coalesce(rest, F.lit("")), "^([^/?#]*)([^?#]*)", k)
    lower = F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({"host": lower, "path": part(2)})


def judge(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", shard: int = SHARD) -> DataFrame:
    """Add ``host``, ``path``, the winning ``rule`` (host and path) and its ``verdict``."""
    out = with_host_and_path(df, url)
    spark = df.sparkSession
    out = out.withColumns({"_rule_host": F.lit(None).cast("string"), "rule": F.lit(None).cast("string"),
                           "verdict": F.lit(default)})
    for k in range(0, len(rules), shard):
        out = _probed(out, spark.sparkContext.broadcast(Index(rules[k : k + shard])))
    return out.drop("_rule_host")


def _probed(df: DataFrame, shared) -> DataFrame:
    names = ["_rule_host", "rule", "verdict"]

    def make():
        keys = shared.value.mapped()

        def fn(batch):
            old = [batch.column(f"_old{n}").to_pylist() for n in names]
            found = best_rules(shared.value, keys, batch.column("host").to_pylist(), batch.column("path").to_pylist())
            rows = []
            for rule, host, text, verdict in zip(found, *old, strict=True):
                if rule and (text is None or _weight(rule) > (len(text), len(host))):
                    host, text, verdict = rule[0], rule[0] + rule[1], rule[2]
                rows.append((host, text, verdict))
            return [pa.array([r[k] for r in rows], pa.string()) for k in range(3)]

        return fn

    renamed = df.withColumnsRenamed({n: f"_old{n}" for n in names})
    return append(renamed, [T.StructField(n, T.StringType()) for n in names], make).drop(*(f"_old{n}" for n in names))
