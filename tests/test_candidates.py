import random

from pyspark.sql import functions as F

from shelfmark.operators.candidates import candidate_rows, level_columns, with_candidates

HITS = "array<struct<score:double,position:bigint,id:string,level:int,code:string,title:string,hierarchy_path:array<string>>>"
TARGETS = ["c1", "c2", "c3", "c4", "c5", "c6"]


def hit(score, position, level, code, title, path):
    return (score, position, str(code), level, code, title, path)


def naive(hits):
    """Independent model: sort-based, from the finished groups."""
    usable = [(n, h) for n, h in enumerate(hits) if h[6] and " > ".join(h[6][:4])]
    keys = {}
    for n, h in usable:
        keys.setdefault(" > ".join(h[6][:4]), []).append((n, h))
    ranked = sorted(keys.items(), key=lambda kv: (min(h[0] for _, h in kv[1]), kv[1][0][0]))
    out = []
    for i, (key, members) in enumerate(ranked):
        seen, attributes = set(), []
        for _, h in members:
            if (h[3] or 0) >= 5 and h[4] not in seen:
                seen.add(h[4])
                attributes.append((h[3], h[4], h[5]))
        letter = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[i] if i < 26 else "Z" + str(i)
        out.append((letter, members[0][1][6][:4], key, min(h[0] for _, h in members), attributes))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, f"q int, hits {HITS}")
    found = with_candidates(df).orderBy("q").collect()
    return [
        [(c.letter, c.hierarchy_path, c.hierarchy_string, c.score, [tuple(a) for a in c.attributes]) for c in r.candidates]
        for r in found
    ]


def test_guide_example(spark):
    hits = [
        hit(0.15, 0, 4, "10000124", "White Bread", ["Food", "Bakery", "Bread", "White Bread"]),
        hit(0.25, 1, 4, "10000125", "Brown Bread", ["Food", "Bakery", "Bread", "Brown Bread"]),
        hit(1.85, 2, 4, "99999", "Electronics", ["Electronics", "Devices", "Phones", "Smartphones"]),
    ]
    found = run(spark, [(1, hits)])[0]
    assert [(c[0], c[1][3]) for c in found] == [("A", "White Bread"), ("B", "Brown Bread"), ("C", "Smartphones")]
    assert found[0][3] == 0.15


def test_random_hits_match_the_model(spark):
    rng = random.Random(3)
    rows = [(0, []), (1, None), (2, [hit(0.1, 1, None, None, None, None), hit(0.2, 2, 1, "c", "", [""])])]
    for q in range(3, 60):
        hits, score = [], 0.0
        for position in range(rng.choice([5, 30, 45])):
            score += rng.choice([0.0, 0.0, 0.125, 0.25])
            depth = rng.randint(1, 6)
            width = rng.choice([2, 40])
            path = [f"t{level}-{rng.randrange(width)}" for level in range(depth)]
            code = rng.choice([None, "x"]) if rng.random() < 0.1 else f"k{rng.randrange(12)}"
            hits.append(hit(score, position, rng.choice([depth, depth, None]), code, path[-1], path))
        rows.append((q, hits))
    found = run(spark, rows)
    assert found == [naive(hits or []) for _, hits in rows]
    assert any(len(c) > 27 for c in found) and any(len(o[4]) > 1 for c in found for o in c)


def test_candidate_rows_and_level_columns(spark):
    path = ["S", "F", "C", "B"]
    hits = [
        hit(0.1, 0, 4, "1", "B", path),
        hit(0.2, 1, 6, "2", "value", path + ["attr", "value"]),
        hit(0.3, 2, 5, "3", "attr", path + ["attr"]),
        hit(0.4, 3, 2, "4", "F2", ["S2", "F2"]),
    ]
    df = spark.createDataFrame([(1, hits), (2, [])], f"q int, hits {HITS}")
    rows = candidate_rows(with_candidates(df), "q")
    chosen = rows.select("rank", *level_columns(F.struct("hierarchy_path", "attributes"), TARGETS)).orderBy("rank")
    assert [tuple(r) for r in chosen.collect()] == [
        (1, "S", "F", "C", "B", "attr", "value"), (2, "S2", "F2", "", "", "", ""),
    ]
