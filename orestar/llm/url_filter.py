"""URL filter: explicit rules first, then a block list held as sorted arrays of 64-bit digests.

The block list is dealt out by digest range. For each range a task keeps the
sorted digests, and the entries they belong to, in a memory-mapped scratch file,
probes it with a vectorised binary search and confirms every hit against the
stored string, so two strings that share a digest are told apart. What is probed
are the distinct names the URLs can be listed under; no URL list or block list is
broadcast, and a range holds a bounded number of either.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestar.llm.text import LOWER, UPPER
from orestar.workspace import materialise

# Entries or names that one digest range holds, about.
RANGE_ROWS = 1 << 17

# The rules of the contract, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Words that mark a host as unwanted if one of its labels has them between hyphens.
SPAM_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], field: int | None) -> Column:
    """The longest rule that fits (``field`` None: as text, 0: its verdict), or null."""
    longest = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1])), reverse=True)
    found = [
        F.when(
            ((host == r[1]) | host.endswith(f".{r[1]}")) & path.startswith(r[2]),
            F.lit(r[1] + r[2] if field is None else r[field]),
        )
        for r in longest
    ]
    return F.coalesce(*found, F.lit(None).cast("string"))


def names_of(host: str, path: str, host_chars: int, path_chars: int) -> Column:
    """The names a URL can be listed under: each host suffix, alone and with each directory of the path.

    Only suffixes of at most ``host_chars`` and paths of at most ``path_chars`` code
    points are written, as no entry is longer; a URL of any length makes no more.
    """
    # One code point more tells whether the cut fell between two labels or directories.
    labels = f"split(right({host}, {host_chars + 1}), '[.]')"
    suffixes = (
        f"filter(transform(sequence(1, size({labels})), i -> array_join(slice({labels}, i, size({labels})), '.')),"
        f" (h, i) -> char_length(h) <= {host_chars} AND (i > 0 OR char_length({host}) <= {host_chars}))"
    )
    parts = f"split(left({path}, {path_chars}), '/')"
    folders = (
        f"filter(transform(sequence(1, size({parts})), i -> concat(array_join(slice({parts}, 1, i), '/'), '/')),"
        f" (p, i) -> char_length(p) <= {path_chars} AND (i < size({parts}) - 1 OR char_length({path}) < {path_chars}))"
    )
    whole = f"if(char_length({path}) <= {path_chars}, array({path}), array())"
    paths = f"array_distinct(concat(array(''), if({path} = '', array(), concat({folders}, {whole}))))"
    return F.expr(f"flatten(transform({suffixes}, h -> transform({paths}, p -> concat(h, p))))")


class DigestArray:
    """Entries sorted by digest in a memory-mapped scratch file that is gone when the array is."""

    def __init__(self, digests: np.ndarray, entries: Sequence[str]):
        order = np.argsort(digests, kind="stable")
        blobs = [entries[i].encode("utf-8") for i in order]
        ends = np.cumsum([0, *(len(b) for b in blobs)], dtype=np.int64)
        file = tempfile.TemporaryFile()
        file.write(digests[order].astype(np.int64).tobytes())
        file.write(ends.tobytes())
        file.write(b"".join(blobs))
        file.flush()
        n = len(order)
        self.digests = np.memmap(file, np.int64, "r", 0, (n,)) if n else np.empty(0, np.int64)
        self.ends = np.memmap(file, np.int64, "r", 8 * n, (n + 1,))
        self.bytes = np.memmap(file, np.uint8, "r", 8 * (2 * n + 1), (int(ends[-1]),)) if ends[-1] else np.empty(0, np.uint8)

    def entry(self, at: int) -> str:
        return self.bytes[self.ends[at] : self.ends[at + 1]].tobytes().decode("utf-8")

    def has(self, digests: np.ndarray, names: Sequence[str]) -> np.ndarray:
        """Whether each name is an entry."""
        low = np.searchsorted(self.digests, digests, "left")
        high = np.searchsorted(self.digests, digests, "right")
        found = np.zeros(len(digests), bool)
        for i in np.flatnonzero(low < high):
            found[i] = any(self.entry(at) == names[i] for at in range(low[i], high[i]))
        return found


def _probe(entries: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
    if entries.empty or names.empty:
        return pd.DataFrame({"name": pd.Series([], dtype=str)})
    listed = DigestArray(entries["digest"].to_numpy(np.int64), entries["entry"].tolist())
    return names.loc[listed.has(names["digest"].to_numpy(np.int64), names["name"].tolist()), ["name"]]


def listed_names(names: DataFrame, entries: DataFrame, digest: Column | None = None) -> DataFrame:
    """The distinct values of ``names.name`` that are among ``entries.entry``; nulls never are."""
    own = materialise(names.select("name").where("name IS NOT NULL").distinct(), "url_names")
    known = materialise(entries.select("entry").where("entry IS NOT NULL").distinct(), "url_entries")
    ranges = 1 + max(own.count(), known.count()) // RANGE_ROWS

    def dealt(df: DataFrame, column: str) -> DataFrame:
        key = F.xxhash64(column) if digest is None else F.xxhash64(column).bitwiseAND(digest)
        spread = df.withColumn("digest", key)
        # The range a digest falls in, as digests are spread evenly.
        return spread.withColumn("range", F.expr(f"CAST(floor((digest / 18446744073709551616D + 0.5D) * {ranges}) AS bigint)"))

    return (
        dealt(known, "entry").groupBy("range").cogroup(dealt(own, "name").groupBy("range"))
        .applyInPandas(_probe, "name string")
    )


def spam_hosts(pages: DataFrame, url_col: str = "url", words: Sequence[str] = SPAM_WORDS) -> DataFrame:
    """A block list from the pages themselves: ``entry`` is every host with an unwanted word in a label."""
    hosts = pages.select(host_of(F.col(url_col)).alias("entry")).distinct()
    return hosts.where(F.arrays_overlap(F.split("entry", "[.-]"), F.array(*map(F.lit, words))))


def judge_urls(
    pages: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    ``entries.entry`` lists hosts, which stand for their subdomains too, or hosts
    with a directory or path. The longest rule that fits decides; where none
    does, a URL listed under any of its names is blocked and others are allowed.

    A null URL, or one without ``://``, has an empty host and path and is allowed.
    An empty list or table blocks nothing. Repeated rows and null ids each get a
    row. Other columns are ignored. The names written for a URL grow with the
    longest entry of the list, not with the URL.
    """
    entries = materialise(entries.select("entry").where("entry IS NOT NULL").distinct(), "url_list")
    slash = "instr(entry, '/')"
    longest = entries.agg(
        F.expr(f"coalesce(max(if({slash} = 0, char_length(entry), {slash} - 1)), 0)").alias("host"),
        F.expr(f"coalesce(max(if({slash} = 0, 0, char_length(entry) - {slash} + 1)), 0)").alias("path"),
    ).first()
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    parts = parts.withColumns(
        {
            "rule": rule_for(F.col("host"), F.col("path"), rules, None),
            "ruled": rule_for(F.col("host"), F.col("path"), rules, 0),
        }
    )
    open_places = parts.where("ruled IS NULL AND host <> ''").select("host", "path").distinct()
    named = open_places.select("host", "path", F.explode(names_of("host", "path", longest.host, longest.path)).alias("name"))
    listed = listed_names(named, entries)
    blocked = named.join(listed, "name").select("host", "path").distinct().withColumn("listed", F.lit(True))
    verdict = F.coalesce("ruled", F.when(F.col("listed"), "block"), F.lit("allow"))
    return parts.join(blocked, ["host", "path"], "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
