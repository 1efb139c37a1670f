"""Leaks against a brute-force search by shingles alone: every item against every passage."""

import random
from collections import Counter
from math import log

import pytest

from lettora.llm.decontamination import ItemIndex, LeakSpec, benchmark_leaks, least_share, question_and_answer, without_leaks, words_of
from lettora.llm.queries import op7_benchmark_decontamination

FOLDER = "/root/testdata/sf0.001"


def plain_leaks(docs, items, spec=LeakSpec()):
    split = [(i, *question_and_answer(t or "")) for i, t in items]
    split = [(i, q, a) for i, q, a in split if q + a]
    if not split:
        return []
    frequency = Counter(t for _, q, a in split for t in set(q + a))
    mean = sum(len(q + a) for _, q, a in split) / len(split)
    stride = max(spec.min_stride, *(len(q + a) for _, q, a in split))

    def weights(words):
        out = {}
        for t, n in Counter(words).items():
            idf = log(1 + (len(split) - frequency[t] + 0.5) / (frequency[t] + 0.5))
            out[t] = idf * n * (spec.k1 + 1) / (n + spec.k1 * (1 - spec.b + spec.b * len(words) / mean))
        return out

    def share(words, passage):
        n = min(spec.shingle_words, len(words))
        if not n:
            return 1.0
        held = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
        own = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        return len(own & held) / len(own)

    out = []
    for doc_id, text in docs:
        words = words_of((text or "").encode())
        for item_id, q, a in split:
            best, w = None, weights(q + a)
            for start in range(0, max(1, len(words) - stride), stride):
                passage = words[start : start + 2 * stride]
                score = sum(v for t, v in w.items() if t in set(passage)) / sum(w.values())
                got = (round(score, 9), share(q, passage), share(a, passage))
                if share(q + a, passage) >= spec.overlap and min(got[1:]) >= spec.part_overlap:
                    best = max(best or got, got)
            if best:
                out.append((doc_id, item_id, *best))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    expected = plain_leaks(docs, items)
    assert expected and found(op7_benchmark_decontamination(spark, FOLDER)) == expected


def benchmark(rng, n=50):
    pool = ["".join(rng.choices("abcdefg", k=3)) for _ in range(90)]
    return pool, [(i, " ".join(rng.choices(pool, k=rng.randint(3, 25))).capitalize() + ". " + " ".join(rng.choices(pool, k=6))) for i in range(n)]


@pytest.mark.parametrize("spec", [LeakSpec(), LeakSpec(index_bytes=1000, threshold=0.5, overlap=0.3, part_overlap=0.1)])
def test_odd_rows_and_parts_of_the_index(spark, spec):
    rng = random.Random(8)
    pool, items = benchmark(rng)
    items += [(5, items[5][1]), (None, items[6][1]), (90, None), (91, ""), (92, "too few words"), (93, "one two three four five")]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 300)))) for i in range(40)]
    for i in range(60):
        inside = items[rng.randrange(50)][1].upper().replace(" ", ", ")
        rows.append((100 + i, " ".join(rng.choices(pool, k=rng.randint(0, 200))) + f" {inside} " + " ".join(rng.choices(pool, k=90))))
    rows += [(None, rows[50][1]), (100, rows[40][1]), (300, None), (301, ""), (302, "é " * 60_000 + items[3][1]), (303, "one TWO three\nfour five")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, item_id int, row int")
    bench = spark.createDataFrame([(*r, 3) for r in items], "item_id long, text string, score int")
    expected = plain_leaks(rows, items, spec)
    assert len(expected) > 60 and found(benchmark_leaks(docs, bench, spec)) == expected
    leaked = {r[0] for r in expected}
    clean = without_leaks(docs, bench, spec)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows if d not in leaked}
    assert benchmark_leaks(docs.limit(0), bench).count() == 0
    assert benchmark_leaks(docs, bench.limit(0)).count() == 0


def test_wand_retrieves_all_above_the_threshold():
    rng = random.Random(9)
    pool, items = benchmark(rng, 120)
    frequency = Counter(t for _, text in items for t in set(words_of(text.encode())))
    for threshold in (0.2, 0.5, 0.9):
        index = ItemIndex(items, frequency, len(items), 15.0, LeakSpec(threshold=threshold))
        for _ in range(30):
            terms = {index.vocabulary[w] for w in rng.sample(sorted(index.vocabulary), 40)}
            scores = {i: sum(index.postings[t].get(i, 0) for t in terms) for i in range(len(items))}
            assert {i for i, _ in index.search(terms)} == {i for i, s in scores.items() if s >= 1 - 1e-9}


def test_what_a_passage_with_the_shingles_holds_at_least():
    """Passages made by dropping words of an item: those that keep 0.8 of its shingles have at least the bound."""
    rng, spec = random.Random(10), LeakSpec()
    seen = 0
    for _ in range(300):
        words = [rng.choice([b"a", b"b", *(bytes([c]) * 3 for c in range(100, 125))]) for _ in range(rng.randint(1, 40))]
        raw = {t: rng.random() ** 3 for t in set(words)}
        weights = {t: w / sum(raw.values()) for t, w in raw.items()}
        least = least_share(words, weights, spec)
        for _ in range(30):
            gone = set(rng.sample(sorted(set(words)), min(len(set(words)), rng.randint(0, 4))))
            passage = [b"-" if w in gone else w for w in words]
            n = min(5, len(words))
            own = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
            held = {tuple(passage[i : i + n]) for i in range(len(words) - n + 1)}
            if len(own & held) / len(own) >= spec.overlap:
                seen += bool(gone)
                assert sum(weights[t] for t in set(passage) & set(words)) >= least - 1e-9
    assert seen > 100
