import numpy as np
import xxhash

from shelfmark.llm import simhash_vptree as sim
from shelfmark.llm.components import connected_components


def _slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, distance):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_fingerprint_against_definition():
    texts = [None, "", " \n", "One", "a b c", "a b c d", "A\tb\x0bc\x0cd e  f", "é ü ß ñ x y", "x " * 500, "B\xa0C d e f"]
    for text in texts:
        assert sim.fingerprint(text) == _slow_fingerprint(text)
    long = " ".join(str(i % 977) for i in range(150_000))
    whole = sim.fingerprint(long)
    sim._BLOCK, before = 1000, sim._BLOCK
    assert sim.fingerprint(long) == whole
    sim._BLOCK = before


def _planted(seed, n=400):
    """Random fingerprints, chains of near ones and a dense group that shares a quarter."""
    random = np.random.default_rng(seed)
    fps = [int(x) for x in random.integers(0, 1 << 63, n, dtype=np.uint64)]
    for _ in range(150):
        f = fps[random.integers(len(fps))]
        for bit in random.choice(64, random.integers(1, 7), replace=False):
            f ^= 1 << int(bit)
        fps.append(f)
    base = fps[0]
    return fps + [base ^ (int(x) << 20) for x in random.integers(0, 1 << 12, 200)]


def test_links_join_what_brute_force_joins(spark):
    fps = sorted(set(_planted(1)))
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    for settings in ({"shard_rows": 8, "least_shards": 64}, {"least_shards": 1, "most_shards": 1, "cell_rows": 50}):
        links = sim.fingerprint_links(table, 4, **settings)
        assert links.count() < 60 * len(fps)
        roots = {r.node: r.root for r in connected_components(links).collect()}
        found = {f: roots.get(int(np.uint64(f).astype(np.int64)), int(np.uint64(f).astype(np.int64))) for f in fps}
        expected = _components(fps, 4)
        assert len(set(found.values())) == len(set(expected.values()))
        assert len({(found[f], expected[f]) for f in fps}) == len(set(expected.values()))


def test_groups_of_documents(spark):
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "other", *words[201:]]
    rows = [(5, " ".join(words)), (3, " ".join(near)), (9, " ".join(words).upper()), (5, " ".join(words)), (7, None), (8, ""),
            (None, " ".join(words)), (1, "something else entirely here now"), (None, "alone with a null id in here")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id bigint, text string, fp string, root int")
    found = sim.simhash_groups(docs).collect()
    assert len(found) == len(rows)
    assert {r.fingerprint for r in found} == {f"{_slow_fingerprint(t):016x}" for _, t in rows}
    by_fp = _components([_slow_fingerprint(t) for _, t in rows], 4)
    least = {}
    for doc_id, text in rows:
        root = by_fp[_slow_fingerprint(text)]
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    for r in found:
        assert r.component_id == least[by_fp[int(r.fingerprint, 16)]]
    kept = sim.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({v for v in least.values() if v is not None})


def test_documents_against_brute_force(spark, folder):
    found = sim.simhash_groups(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    roots = _components([int(r.fingerprint, 16) for r in found], 4)
    least = {}
    for r in found:
        root = roots[int(r.fingerprint, 16)]
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert all(r.component_id == least[roots[int(r.fingerprint, 16)]] for r in found)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 140)] + [(5, 5), (7, 6)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}


def test_empty_table(spark):
    assert sim.simhash_groups(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
