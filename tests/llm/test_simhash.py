"""SimHash against a brute-force version written from the definition."""

import random
import re

import numpy as np
import xxhash

from lettora.llm.components import components
from lettora.llm.queries import op1_simhash_near_dedup
from lettora.llm.simhash import one_of_each, simhash_components, tile_links

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain_fingerprint(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(marks, radius=4):
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(marks):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, f"{m:016x}", least.get(find(i))) for i, (d, m) in enumerate(marks)), key=str)


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert found(op1_simhash_near_dedup(spark, FOLDER)) == plain_components([(r[0], plain_fingerprint(r[1])) for r in rows])


def test_odd_rows(spark):
    long_text = " ".join(random.Random(5).choices(["ab", "Cd", "é", "x.y"], k=70_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "One two"), (5, "one\x0btwo"), (6, "one two"), (None, "one two")]
    rows += [(7, long_text), (8, long_text + " end"), (9, "a b c d e f"), (9, "a b c d e f"), (None, "É b c d e")]
    expected = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    wide = "doc_id long, text string, bits string, tile int, n int, root int"
    df = spark.createDataFrame([(*row, "x", 1, 1, 1) for row in rows], wide)
    assert found(simhash_components(df)) == expected
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0
    one = one_of_each(df)
    assert one.columns == df.columns
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted({row[2] for row in expected}, key=str)
    nameless = df.where("doc_id is null").union(df.where("doc_id is null"))
    assert one_of_each(nameless).count() == 2 and one_of_each(df.limit(0)).count() == 0


def test_many_tiles_and_a_hot_group(spark):
    """Chains of links across tiles; a third of the rows are copies."""
    rng = random.Random(2)
    marks, at = [], 0
    texts = [" ".join(rng.choices("abcdefgh", k=30)) for _ in range(150)]
    for text in texts:
        words = text.split()
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(30)] = rng.choice("abcdefgh")
            marks.append((at, " ".join(words)))
            at += 1
    marks += [(at + i, texts[0]) for i in range(150)]
    df = spark.createDataFrame(marks, SCHEMA)
    expected = plain_components([(d, plain_fingerprint(t)) for d, t in marks], 12)
    assert len({row[2] for row in expected}) < len({row[1] for row in expected})
    assert found(simhash_components(df, radius=12, tile_rows=20)) == expected


def test_tile_links_find_every_link():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 900, np.uint64)
    a = np.unique(np.concatenate((a, a[:300] ^ np.uint64(5), a[:200] ^ np.uint64(1 << 40))))
    b = np.unique(np.concatenate((a[::3] ^ np.uint64(7), rng.integers(0, 2**64, 700, np.uint64))))
    for second in (None, b):
        nodes = a if second is None else np.concatenate((a, b))
        u, v = tile_links(a, second, 4)
        names = {int(x): i for i, x in enumerate(nodes)}
        root = list(range(len(nodes)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for x, y in zip(u, v):
            root[find(names[int(x)])] = find(names[int(y)])
        left, right = (a, a) if second is None else (a, b)
        for x in left:
            for y in right[np.bitwise_count(x ^ right) <= 4]:
                assert find(names[int(x)]) == find(names[int(y)])


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(300, 301), (302, 301), (5, 5), (7, 6)]
    random.Random(1).shuffle(chain)
    roots = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 300: 300, 301: 300, 302: 300}
