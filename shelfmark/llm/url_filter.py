"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is an array of 256-bit blocks; a key sets one bit in each of the
eight words of one block, so a look-up touches a single cache line. It is
built from the distinct listed URLs in pieces, one task a piece, and sent to
all tasks. What it lets pass are possible hits; an exact hash join with the
list removes the false positives.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import LOWER, UPPER, stored

WORDS = 8
BLOCK_BYTES = 4 * WORDS
# Odd multipliers, one for each word of a block, as in split-block Bloom filters.
MULTIPLIERS = np.array([0x47b6137b, 0x44974d91, 0x8824ad5b, 0xa2b7289d, 0x705495c7, 0x2df1424b, 0x9efc4947, 0x5c6bfb31],
                       dtype=np.uint32)
_PIECE_BLOCKS = 1 << 16  # 2 MiB
_MOST_RULES = 1000


class Rule(NamedTuple):
    """``verdict`` for a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# --- urls -------------------------------------------------------------------

_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, group), F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return _part(url, 2)


def canonical_url(url: Column) -> Column:
    """One form for addresses of the same page; null for a null url or one without ``://``.

    Without scheme, leading ``www.``, default port, closing slashes, fragment,
    empty and ``utm_`` parameters; the host in lower case.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), ":(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    kept = F.array_join(F.filter(F.split(_part(url, 3), "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.when(url.contains("://"), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits (a null struct if none does)."""
    if len(rules) > _MOST_RULES or any(not r.host for r in rules):
        raise ValueError(f"rules need a host, and more than {_MOST_RULES} belong in the list")
    fitting = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
               F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r))
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fitting, none)


# --- the filter -------------------------------------------------------------

def _bits(hashes: np.ndarray) -> np.ndarray:
    """The bit that each hash sets in each word of its block."""
    low = hashes.astype(np.uint32)[:, None] * MULTIPLIERS[None, :]
    return np.uint32(1) << (low >> np.uint32(27))


def _blocks(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


class BlockedBloom:
    """``words[block, word]`` with methods on arrays of 64-bit hashes."""

    def __init__(self, blocks: int):
        self.words = np.zeros((blocks, WORDS), dtype=np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        np.bitwise_or.at(self.words, _blocks(hashes, len(self.words)), _bits(hashes))

    def might_hold(self, hashes: np.ndarray) -> np.ndarray:
        bits = _bits(hashes)
        return ((self.words[_blocks(hashes, len(self.words))] & bits) == bits).all(axis=1)


def _hashes(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def build_filter(keys: DataFrame, count: int, bits_per_key: int = 16, max_bytes: int = 32 * 1024**2) -> BlockedBloom:
    """The filter of the hashes in ``keys(hash)``, of which there are ``count``.

    At most ``max_bytes``: with more keys than that serves, more false positives
    pass to the join. Hashes are dealt to pieces of the filter, so no task holds
    more than its pieces and the driver receives each byte once.
    """
    blocks = max(1, min(-(-count * bits_per_key // (8 * BLOCK_BYTES)), max_bytes // BLOCK_BYTES))
    pieces = -(-blocks // _PIECE_BLOCKS)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = (_blocks(_hashes(batch.column(0)), blocks) // _PIECE_BLOCKS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(piece)], names=["hash", "piece"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            hashes, piece = _hashes(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for p in np.unique(piece).tolist():
                own = hashes[piece == p]
                words = held.setdefault(p, np.zeros((min(_PIECE_BLOCKS, blocks - p * _PIECE_BLOCKS), WORDS), np.uint32))
                np.bitwise_or.at(words, _blocks(own, blocks) - p * _PIECE_BLOCKS, _bits(own))
        for p, words in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([words.tobytes()], pa.binary())],
                                             names=["piece", "words"])

    made = keys.select("hash").mapInArrow(dealt, "hash bigint, piece int").repartition(pieces, "piece").mapInArrow(
        fill, "piece int, words binary")
    bloom = BlockedBloom(blocks)
    for row in made.toLocalIterator():  # max_bytes in all
        words = np.frombuffer(row.words, dtype=np.uint32).reshape(-1, WORDS)
        bloom.words[row.piece * _PIECE_BLOCKS:][:len(words)] |= words
    return bloom


def _exactly(hits: DataFrame, listed: DataFrame, heavy_rows: int, most_bytes: int = 65_536) -> DataFrame:
    """``hits`` with whether their ``canonical`` is in ``listed`` (distinct), by joins on the URL itself.

    Hits are counted by URL with partial sums, and the list is joined with one
    row per URL. What was found goes back to the rows by a hash join; URLs with
    over ``heavy_rows`` and a thousandth of all hits, at most a thousand of up
    to 64 KiB, are broadcast, so that no task receives a frequent URL's rows.
    """
    counted = hits.groupBy("canonical").agg(F.count(F.lit(1)).alias("hits"))
    settled = stored(counted.join(listed.select("canonical", F.lit(True).alias("listed")), "canonical", "left"),
                     "settled-urls").select("canonical", "hits", F.coalesce("listed", F.lit(False)).alias("listed"))
    least = max(heavy_rows, (settled.agg(F.sum("hits")).first()[0] or 0) // 1000)
    is_heavy = (F.col("hits") > least) & (F.octet_length("canonical") <= most_bytes)
    known = settled.select("canonical", "listed")
    if settled.where(is_heavy).isEmpty():
        return hits.join(known, "canonical")
    heavy = F.broadcast(settled.where(is_heavy).select("canonical", "listed"))
    light = hits.join(heavy, "canonical", "left_anti").join(settled.where(~is_heavy).select(known.columns), "canonical")
    return hits.join(heavy, "canonical").unionByName(light)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, bits_per_key: int = 16,
               max_bytes: int = 32 * 1024**2, heavy_rows: int = 10_000) -> DataFrame:
    """page_id, host, path, rule, listed and verdict of every row of ``pages(page_id, url)``.

    A rule fits its host and all subdomains where the path starts with its own;
    the longest decides. Without a rule a URL whose canonical form is among the
    canonical forms of ``listed(url)`` is blocked, every other one allowed.
    A null url, or one without ``://``, has an empty host and path and no
    canonical form: it is allowed, and in the list it stands for nothing.
    Repeated rows are judged each, also with null ids; extra columns are
    ignored; an empty table gives no rows and an empty list blocks nothing.
    """
    known = stored(listed.select(canonical_url(F.col("url")).alias("canonical")).where(
        "canonical IS NOT NULL").distinct(), "listed-urls")
    bloom = build_filter(known.select(F.xxhash64("canonical").alias("hash")), known.count(), bits_per_key, max_bytes)
    shared = pages.sparkSession.sparkContext.broadcast(bloom)

    @F.arrow_udf("boolean")
    def possible(hashes: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in hashes:
            yield pa.array(shared.value.might_hold(_hashes(some)))

    url = F.col("url")
    parts = pages.select(F.col("page_id"), url, host_of(url).alias("host"), path_of(url).alias("path"))
    found = parts.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("fit"),
                         canonical_url(url).alias("canonical"))
    passed = possible(F.xxhash64("canonical")) & F.col("canonical").isNotNull()
    judged = stored(found.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                                 F.col("fit.verdict").alias("own"), "canonical", passed.alias("possible")), "judged-urls")
    hits = _exactly(judged.where("possible"), known, heavy_rows)
    every = hits.unionByName(judged.where(~F.col("possible")).withColumn("listed", F.lit(False)))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return every.select("page_id", "host", "path", "rule", "listed", F.coalesce("own", method).alias("verdict"))
