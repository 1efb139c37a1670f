"""Targets against the sharing rule played out step by step; the mix against its promises."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lettora.llm.mixing import MixSpec, mix, mixed_blocks, permuted, words_taken
from lettora.llm.queries import op3_mix_sources

FOLDER = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        full = {s for s in free if share[s] > most * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= full
    return target


def check(rows, docs):
    """``rows`` of the query against all that the contract promises."""
    words = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += words(text)
    targets = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((d, s, words(t)) for d, s, t in docs)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.5 + 1e-6


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text").collect()]
    first = op3_mix_sources(spark, FOLDER).collect()
    check(first, docs)
    assert sorted(first) == sorted(op3_mix_sources(spark, FOLDER).repartition(3).collect())


@pytest.mark.parametrize("spec, run_rows", [(MixSpec(), 4096), (MixSpec(block_words=3, shard_slots=8, bucket_rows=5), 3)])
def test_odd_rows_and_a_hot_source(spark, spec, run_rows, monkeypatch):
    monkeypatch.setattr("lettora.llm.mixing.RUN_ROWS", run_rows)
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randint(0, 99)}" for _ in range(n))
    docs = [(i, "hot" if i % 3 == 0 else f"s{rng.randint(0, 9)}", text(rng.randint(0, 60))) for i in range(150)]
    docs += [(200, None, text(40)), (None, None, text(9)), (None, "é", None), (201, "é", ""), (202, "Z", " \t"), (203, "", text(5))]
    docs += [docs[4], docs[4], (4, "other", text(7)), (205, "long", text(30_000))]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, source string, text string, size int, sid int")
    check(words_taken(mix(df, spec)).collect(), docs)
    assert words_taken(mix(df.limit(0), spec)).count() == 0
    empty = words_taken(mix(df.where("source = 'Z'"), spec)).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)]


def test_blocks_of_the_mix(spark):
    rng = random.Random(7)
    docs = [(i, f"s{i % 3}", " ".join(f"d{i}_{k}" for k in range(rng.randint(0, 25)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    spec = MixSpec(block_words=8, shard_slots=4, bucket_rows=10)
    blocks = mixed_blocks(df, spec).collect()
    assert max(len(b.words) for b in blocks) == 8
    words = Counter(w for b in blocks for w in b.words)
    assert max(words.values()) <= 3
    by_doc = Counter()
    for word, n in words.items():
        by_doc[int(word[1:].split("_")[0])] += n
    taken = {r.doc_id: r.taken for r in words_taken(mix(df, spec)).collect() if r.taken}
    assert taken == dict(by_doc)


@pytest.mark.parametrize("length", [1, 2, 7, 64, 1000])
def test_permutation(spark, length):
    df = spark.range(length).withColumn("n", F.lit(length).cast("long"))
    orders = []
    for seed in (1, 2):
        out = [r[0] for r in df.select(permuted("id", "n", ["n"], MixSpec(seed=seed))).collect()]
        assert sorted(out) == [*range(length)]
        orders.append(out)
    assert length < 7 or orders[0] != orders[1] != [*range(length)]


def test_sources_below_a_block_meet_their_targets(spark):
    docs = [(i, f"s{i % 60:02}", " ".join(["w"] * 10)) for i in range(180)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    check(words_taken(mix(df)).collect(), docs)
    lengths = Counter()
    for b in mixed_blocks(df).collect():
        lengths[b.source] += len(b.words)
    assert all(abs(n - 5400 / 60 / 3 * [0.5, 1.0, 1.5][int(s[1:]) % 3]) < 20 for s, n in lengths.items())
