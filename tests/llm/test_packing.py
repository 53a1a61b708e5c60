import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "  a  b\n\n c\x1cd !\x1c! x<|endoftext|>y  <|endoftext|> \t z  ", " a  b's 12 34  ", "a\n b \nc",
       "a\n \nb", "don't  \r\n", "<|endoftext|> <|endoftext|>a b", "日本語 текст é", "x" * 3000, "word " * 2500]


def test_ids_are_those_of_the_tokenizer(spark, folder):
    reference = Tokenizer.from_file(PATH)
    texts = ODD + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    own = packing.TextEncoder(PATH)
    for text in texts:
        ids = reference.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("tokens, expected", [
    (1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2048, [(0, 1024), (1024, 1024)]),
    (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_only_longer_documents_are_cut(tokens, expected):
    assert packing.cuts(tokens, 1024) == expected


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_document_and_is_as_good_as_best_fit(seed):
    random = np.random.default_rng(seed)
    counts = np.zeros(129, dtype=np.int64)
    for n in random.integers(1, 129, 40):
        counts[n] += random.integers(1, 60)
    bins = packing.plan_sequences(counts, 128)
    held = np.zeros_like(counts)
    for times, own in bins:
        assert times > 0 and sum(n * k for n, k in own) <= 128
        for n, k in own:
            held[n] += times * k
    assert (held == counts).all()
    plain = packing.best_fit([], counts.copy(), 128)
    used = sum(t for t, _ in bins)
    assert used <= sum(t for t, _ in plain) + 1
    assert used >= -(-int((counts * np.arange(129)).sum()) // 128)


def test_knapsack_equals_brute_force():
    random = np.random.default_rng(5)
    for _ in range(30):
        sizes = random.choice(np.arange(3, 40), 6, replace=False)
        price = random.random(6) * sizes * random.choice([0, 1, 1], 6)
        best = np.zeros(61)
        for room in range(1, 61):
            best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in zip(sizes, price) if s <= room])
        mix, worth = packing._best_mix(sizes, price, 60)
        assert mix @ sizes <= 60 and worth == pytest.approx(best[60]) == pytest.approx(mix @ price)


def test_configured_sequences_hold_nearly_all_large_documents():
    """The method does the work: its sequences stay, and cost at most 0.2 % more than best-fit alone."""
    own, counts = packing.TextEncoder(PATH), np.zeros(1025, dtype=np.int64)
    for batch in pq.ParquetFile("/root/testdata/sf0.1/documents.parquet").iter_batches(columns=["text"]):
        for text in batch.column(0).to_pylist():
            for _, length in packing.cuts(len(own.encode(text or "")) // 4 + 1, 1024):
                counts[length] += 1
    large = counts.copy()
    large[1024] = 0
    configured = packing.configured_sequences(large, [n for n in range(1023, 128, -1) if large[n]], 1024, packing.GROUPS)
    placed = sum(times * k for times, held in configured for _, k in held)
    assert placed >= 0.95 * large[129:].sum()
    plan = packing.plan_sequences(counts, 1024)
    assert all(sequence in plan or any(sequence[1] == own[:len(sequence[1])] for _, own in plan) for sequence in configured)
    used = sum(times for times, _ in plan)
    assert used <= 1.002 * sum(times for times, _ in packing.best_fit([], counts.copy(), 1024))


def _check(rows, max_tokens=1024):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= max_tokens
    return len(places)


def test_documents_with_odd_rows(spark):
    rows = [(i, t, "en", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], "en", 1), (None, None, None, None), (None, "a", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string, sequence_id int")
    found = packing.pack_documents(docs, PATH).collect()
    reference = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text, *_ in rows:
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 1024)):
            expected.append((doc_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
    assert sorted(map(repr, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found))) == sorted(map(repr, expected))
    _check(found)


def test_whole_table_is_packed_tightly(spark, folder):
    found = packing.pack_documents(spark.read.parquet(f"{folder}/documents.parquet"), PATH).collect()
    used = _check(found)
    least = -(-sum(r.length for r in found) // 1024)
    assert least <= used <= least * 1.03 + 1


def test_ids_come_along(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    row = packing.pack_documents(docs, PATH, with_ids=True).first()
    assert row.ids == Tokenizer.from_file(PATH).encode("a b c", add_special_tokens=False).ids + [2]


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
