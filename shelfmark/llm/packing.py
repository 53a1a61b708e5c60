"""Best-fit packing of tokenised documents by linear grouping.

1. Large lengths are sorted and cut into groups of equal cardinality; within a
   group every length is rounded up to the largest.
2. The few sizes that are left make a small configuration program (which mixes
   of sizes fill a sequence, how often); it is solved by column generation and
   rounded down.
3. Actual documents take the places of their group, which leaves some room.
4. What whole numbers leave over, and all small documents, go best-fit: always
   into the sequence with the least room that still suffices.

All of that works on counts per length, at most ``max_tokens`` numbers, so the
plan is made on the driver at any scale and has a few thousand places ("the
``n`` documents of length 300 from rank 17 on go to sequences 40, 41, ... at
offset 512"). Documents get a rank among those of their length from one window
over salted lengths and look their place up; texts and ids are never shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

# --- tokens -----------------------------------------------------------------

# Fixed value: the pattern by which a byte-level tokenizer cuts texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TextEncoder:
    """Token ids of texts as little-endian 32-bit bytes, by a byte-level ``tokenizer.json``."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        value = _byte_of_character()
        ranks = {bytes(value[c] for c in token): rank for token, rank in described["model"]["vocab"].items()
                 if token not in special}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids of the whole text; the names of special tokens in it are those tokens."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each file and worker process."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def cuts(tokens: int, max_tokens: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes the remainder."""
    if tokens <= max_tokens:
        return [(0, tokens)]
    first = tokens % max_tokens
    starts = ([0] if first else []) + list(range(first, tokens, max_tokens))
    return [(s, min(max_tokens, tokens - s) if s or not first else first) for s in starts]


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if wanted, ids of every piece of every document."""
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, max_tokens)):
                    own = ids[4 * start:4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(own))
                    rows.append((*row, np.frombuffer(own, "<i4")) if with_ids else row)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        cut, fields + (", ids array<int>" if with_ids else ""))


# --- the plan ---------------------------------------------------------------

GROUPS = 192
Bin = tuple[int, list[tuple[int, int]]]  # how many sequences, and (length, times) of what each holds


def equal_groups(counts: np.ndarray, lengths: list[int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Cut the documents of ``lengths`` (descending) into groups of equal cardinality: (size, [[length, count]])."""
    total = int(counts[lengths].sum())
    result: list[tuple[int, list[list[int]]]] = []
    per_group = max(1, -(-total // groups))
    for length in lengths:
        left = int(counts[length])
        while left:
            held = sum(c for _, c in result[-1][1]) if result else per_group
            if held >= per_group:
                if result and result[-1][0] == length:  # the same size need not be told apart
                    result[-1][1].append([length, left])
                    break
                result.append((length, []))
                held = 0
            take = min(left, per_group - held)
            result[-1][1].append([length, take])
            left -= take
    return result


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 5000,
                   gap: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Mixes of sizes (columns) and how often each is used, for the fewest sequences; fractional.

    Column generation: prices of the present mixes, then the mix that is worth
    most at these prices, or first at prices drawn towards those of the best
    lower bound, which settles sooner. It ends when that bound is within
    ``gap`` of what the mixes need.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    used = demand / np.diag(basis)
    inverse = np.diag(1 / np.diag(basis))
    best_bound, centre = 0.0, sizes / capacity  # prices that no mix exceeds, and the bound that they give
    for turn in range(rounds):
        price = inverse.sum(axis=0)
        for weight in (0.7, 0.0):
            tried = weight * centre + (1 - weight) * price
            mix, worth = _best_mix(sizes, tried, capacity)
            if (bound := float(tried @ demand) / worth) > best_bound:
                best_bound, centre = bound, tried / worth
            if mix @ price > 1 + 1e-9:
                break
        if mix @ price <= 1 + 1e-9 or used.sum() <= best_bound * (1 + gap):
            break
        step = inverse @ mix
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        used = np.maximum(used - ratios[out] * step, 0)
        used[out] = ratios[out]
        basis[:, out] = mix
        # The inverse with one column exchanged; from time to time anew, against rounding.
        row = inverse[out] / step[out]
        inverse = np.linalg.inv(basis) if turn % 200 == 199 else inverse - np.outer(step, row)
        if turn % 200 != 199:
            inverse[out] = row
    return basis, used


def _best_mix(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The mix of greatest price that fits: an unbounded knapsack, one size after the other.

    For a size the rooms that leave the same remainder form a row; along it the
    best is a running maximum of what earlier sizes give, less the price of the
    places passed.
    """
    best = np.zeros(capacity + 1)
    for size, worth in zip(sizes.tolist(), price.tolist()):
        if worth <= 0:
            continue
        steps = capacity // size + 1
        padded = np.full(steps * size, -np.inf)
        padded[:min(capacity + 1, steps * size)] = best[:steps * size]
        rows = padded.reshape(steps, size)
        paid = worth * np.arange(steps)[:, None]
        padded = (np.maximum.accumulate(rows - paid, axis=0) + paid).ravel()
        best[:min(capacity + 1, steps * size)] = padded[:capacity + 1]
        if steps * size <= capacity:  # the rooms behind the last whole row
            tail = np.arange(steps * size, capacity + 1)
            best[tail] = np.maximum(best[tail], best[tail - size] + worth)
    best = np.maximum.accumulate(best)
    mix, room = np.zeros(len(sizes)), capacity
    while room > 0:
        fits = sizes <= room
        worth = np.where(fits, best[np.where(fits, room - sizes, 0)] + price, -np.inf)
        top = int(np.argmax(worth))
        if worth[top] <= 0 or worth[top] < best[room] - 1e-9:
            break
        mix[top] += 1
        room -= sizes[top]
    return mix, float(mix @ price)


def _take(segments: list[list[int]], amount: int) -> list[tuple[int, int]]:
    """Remove ``amount`` documents from the front of ``segments``."""
    taken = []
    while amount:
        length, count = segments[0]
        now = min(count, amount)
        taken.append((length, now))
        amount -= now
        if now == count:
            segments.pop(0)
        else:
            segments[0][1] -= now
    return taken


def _aligned(times: int, places: list[list[tuple[int, int]]]) -> list[Bin]:
    """``times`` sequences with one document of each place's run: sequences alike are counted together."""
    bins: list[Bin] = []
    runs = [list(map(list, p)) for p in places]
    while times:
        alike = min(times, *(r[0][1] for r in runs))
        held: dict[int, int] = {}
        for run in runs:
            held[run[0][0]] = held.get(run[0][0], 0) + 1
            run[0][1] -= alike
            if not run[0][1]:
                run.pop(0)
        bins.append((alike, list(held.items())))
        times -= alike
    return bins


def plan_sequences(counts: np.ndarray, capacity: int, groups: int = GROUPS, small: int | None = None) -> list[Bin]:
    """Sequences for ``counts[length]`` documents of each length from 1 to ``capacity``.

    All sequences of the configuration program stay. The documents that its
    whole numbers leave over and the small ones are put best-fit into their room
    and into further sequences.
    """
    small = capacity // 8 if small is None else small
    left = counts.astype(np.int64).copy()
    bins: list[Bin] = []
    if left[capacity]:
        bins.append((int(left[capacity]), [(capacity, 1)]))
        left[capacity] = 0
    mixed = configured_sequences(left, [n for n in range(capacity - 1, small, -1) if left[n]], capacity, groups)
    for n, held in mixed:
        for length, k in held:
            left[length] -= n * k
    return best_fit(bins + mixed, left, capacity)


def configured_sequences(counts: np.ndarray, lengths: list[int], capacity: int, groups: int) -> list[Bin]:
    """The whole sequences of the configuration program, with actual documents in the places of their groups."""
    if not lengths:
        return []
    grouped = equal_groups(counts, lengths, groups)
    sizes = np.array([size for size, _ in grouped])
    demand = np.array([sum(c for _, c in runs) for _, runs in grouped], dtype=float)
    mixes, used = configurations(sizes, demand, capacity)
    bins: list[Bin] = []
    for column, amount in zip(mixes.T, used):
        parts = [(int(g), int(column[g])) for g in np.flatnonzero(column)]
        # Rounding errors of the program must not use documents twice.
        times = min([int(np.floor(amount + 1e-6)), *(sum(c for _, c in grouped[g][1]) // k for g, k in parts)])
        if times:
            bins += _aligned(times, [_take(grouped[g][1], times) for g, k in parts for _ in range(k)])
    return bins


def best_fit(bins: list[Bin], left: np.ndarray, capacity: int) -> list[Bin]:
    """Put ``left[length]`` more documents, longest first, where the least room suffices."""
    by_room: list[list[Bin]] = [[] for _ in range(capacity + 1)]
    for times, held in bins:
        by_room[capacity - sum(n * k for n, k in held)].append((times, held))
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            room = next((r for r in range(length, capacity + 1) if by_room[r]), None)
            each = (capacity if room is None else room) // length
            times, held = by_room[room].pop() if room is not None else (max(1, count // each), [])
            room = capacity if room is None else room
            if count < each:
                each, full = count, 1
            else:
                full = min(times, count // each)
            if full < times:
                by_room[room].append((times - full, held))
            by_room[room - each * length].append((full, [*held, (length, each)]))
            count -= full * each
    return [b for rooms in by_room for b in rooms]


def places(bins: list[Bin]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, documents a sequence, first sequence, offset) of every run of places."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, held in bins:
        offset = 0
        for length, each in held:
            first = rank.get(length, 0)
            rank[length] = first + times * each
            rows.append((length, first, rank[length], each, sequence, offset))
            offset += length * each
        sequence += times
    return rows


# --- assignment -------------------------------------------------------------

def pack(pieces: DataFrame, max_tokens: int, groups: int = GROUPS, salts: int | None = None) -> DataFrame:
    """``pieces`` (with a ``length`` from 1 to ``max_tokens``) with their sequence_id and offset."""
    spark = pieces.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A length may hold a third of all pieces, so ranks are counted within length and salt.
    pieces = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    salted = pieces.withColumn("_salt", F.pmod("_row", F.lit(salts)))
    counted = stored(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")), "length-counts")
    counts = np.zeros(max_tokens + 1, dtype=np.int64)
    for row in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most max_tokens rows
        counts[row.length] = row.n
    # The plan has a few places for each length, so it is safe to broadcast.
    plan = spark.createDataFrame(places(plan_sequences(counts, max_tokens, groups)) or [(0,) * 6][:0],
                                 "_length bigint, _first bigint, _end bigint, _each bigint, _sequence bigint, _offset bigint")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("_row")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(bases, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first"))
                         & (F.col("_rank") < F.col("_end")))
    nth = F.col("_rank") - F.col("_first")
    return placed.select(
        *[c for c in pieces.columns if c != "_row"],
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("bigint").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).cast("bigint").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, max_tokens: int = 1024,
                   groups: int = GROUPS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if wanted).

    Every document ends with ``end_id``, so null and empty texts are one token.
    Documents longer than ``max_tokens`` are cut, all pieces but the first are
    full. Repeated rows, ids and null ids are packed like any others, extra
    columns are ignored, an empty table gives no rows.
    """
    return pack(token_pieces(docs, tokenizer_path, end_id, max_tokens, with_ids), max_tokens, groups)
