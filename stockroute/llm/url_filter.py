"""URL allow / block rules through a broadcast trie.

The trie is keyed by reversed host labels (``net``, ``example``, ...) and, below
a host, by path segments; what a rule's path has after its last slash is kept as
a prefix of the next segment, so a rule fits every path that starts with its
own. Of all fitting allow and block entries the longest decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The rule list is broadcast whole, so its size is checked before that.
MAX_RULE_CHARS = 64_000_000

Rule = tuple[str, str, str]  # verdict, host, path


def split_url(url):
    """Host and path columns: the host runs from the first ``://`` to the next
    ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path from there to
    ``?``, ``#`` or the end. Null urls and urls without ``://`` give empty ones."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dictionaries. A host node has its child labels under ``"."`` and
    its path root under ``"/"``; a path node has child segments under ``"/"``
    and under ``"="`` the endings ``{rest: (length, host length, block, rule)}``."""
    if sum(len(h) + len(p) for _, h, p in rules) > MAX_RULE_CHARS:
        raise ValueError("rule list above MAX_RULE_CHARS; split it and filter in turn")
    root: dict = {".": {}}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not host:
            raise ValueError(f"not a rule: {(verdict, host, path)}")
        node = root
        for label in reversed(host.split(".")):
            node = node["."].setdefault(label, {".": {}})
        node = node.setdefault("/", {"/": {}, "=": {}})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node["/"].setdefault(segment, {"/": {}, "=": {}})
        entry = (len(host) + len(path), len(host), verdict == "block", host + path)
        node["="][rest] = max(entry, node["="].get(rest, entry))
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple | None:
    """The longest entry that fits, or None. Equal lengths: the longer host;
    the same host and path both allowed and blocked: block."""
    best = None
    segments = path.split("/")
    node = trie
    for label in reversed(host.split(".")):
        node = node["."].get(label)
        if node is None:
            break
        below = node.get("/")
        for i, segment in enumerate(segments):
            if below is None:
                break
            for rest, entry in below["="].items() if len(below["="]) <= len(segment) else (
                    (segment[:n], below["="].get(segment[:n])) for n in range(len(segment) + 1)):
                if entry and segment.startswith(rest) and (best is None or entry > best):
                    best = entry
            below = below["/"].get(segment) if i + 1 < len(segments) else None
    return best


def url_filter(pages: DataFrame, rules: Sequence[Rule], default: str = "allow",
               url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the longest
    fitting entry, else null) and ``verdict`` (its verdict, else ``default``).

    Row-local: no shuffle, every input row and its other columns stay (input
    columns of these four names are replaced). Null, empty or scheme-less urls
    have empty host and path, fit no rule and get the default.
    """
    host, path = split_url(F.col(url_col))
    rows = pages.withColumns({"host": host, "path": path, "rule": F.lit(None).cast("string"),
                              "verdict": F.lit(None).cast("string")})
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [longest_match(trie.value, h, p)
                     for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            new = {"rule": [m and m[3] for m in found],
                   "verdict": [default if m is None else "block" if m[2] else "allow" for m in found]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[c], pa.string()) if c in new else batch.column(c) for c in batch.schema.names],
                batch.schema.names)

    return rows.mapInArrow(judge, rows.schema)
