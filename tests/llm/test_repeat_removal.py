"""Repeat removal against all windows counted by brute force; the index against its definition."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from lettora.llm.anchors import anchored_runs, gram_hashes, sliding_least
from lettora.llm.repeat_removal import RepeatSpec, repeat_digest, repeats
from lettora.llm.run_index import build, repeated_spans
from lettora.params import SkewLimits

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def plain_spans(texts, length):
    windows = [[hashlib.md5(text[i : i + length]).digest() for i in range(len(text) - length + 1)] for text in texts]
    counts = Counter(w for mine in windows for w in mine)
    out = []
    for mine in windows:
        spans = []
        for at, window in enumerate(mine):
            if counts[window] > 1:
                if spans and spans[-1][1] >= at:
                    spans[-1] = spans[-1][0], at + length
                else:
                    spans.append((at, at + length))
        out.append(spans)
    return out


def plain(rows, length):
    raws = [(text.encode() if isinstance(text, str) else text) or b"" for _, text in rows]
    out = []
    for (doc_id, _), raw, spans in zip(rows, raws, plain_spans(raws, length)):
        ends = [0, *(b for _, b in spans)]
        kept = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in spans), len(raw)]))
        out.append((doc_id, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, *args):
    return sorted(map(tuple, repeat_digest(df, *args).select(*COLUMNS).collect()), key=repr)


def test_given_documents_equal_plain(spark):
    from lettora.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    rows = list(zip(table["doc_id"], (text or "" for text in table["text"])))
    result = LLM_QUERIES["op13_repeat_removal"](spark, folder)
    expected = plain(rows, 400)
    assert sorted(map(tuple, result.select(*COLUMNS).collect()), key=repr) == expected
    assert any(0 < row[2] < row[1] for row in expected) and any(row[2] == row[1] > 0 for row in expected)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("texts_")]


@pytest.mark.parametrize("bucket_bytes", [1, 400, 1_500_000])
def test_odd_rows_by_index_and_by_counts(spark, bucket_bytes):
    """The smallest bucket sends every anchor to the counts, the largest all to the index."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("abcdefghij é", k=n))
    passage = word(70)
    rows = [(i, word(rng.randint(0, 80)) + passage[rng.randint(0, 30) :] + word(rng.randint(0, 40))) for i in range(60)]
    rows += [(100 + i, word(rng.randint(0, 60))) for i in range(20)]
    rows += [(200, "a" * 300), (201, "ab" * 100), (202, "a" * 19), (203, "z" * 21), (204, "z" * 20), (205, word(3000) + passage + passage)]
    rows += [(300 + i, "the very same text " * 2) for i in range(30)] + [(7, rows[7][1]), (7, rows[7][1]), (None, "short"), (None, None)]
    rows += [(401, ""), (402, None), (403, "short"), (404, "x" * 20 + "\x00" * 50), (405, passage), (None, passage[:25])]
    wide = spark.createDataFrame([(*r, 1, b"z", "s") for r in rows], "doc_id long, text string, n_bytes int, raw binary, sid string")
    spec = RepeatSpec(length=20, gram=6, bucket_bytes=bucket_bytes, most_windows=16)
    assert found(wide, spec, SkewLimits(15)) == plain(rows, 20)
    assert found(wide.limit(0), spec) == []


def test_text_that_is_no_utf8(spark):
    df = spark.sql("select id as doc_id, cast(concat(x'ff61', repeat('b', 30), x'fe') as string) as text from range(3)")
    df = df.union(spark.sql("select 9L, cast(concat(x'00', repeat('b', 30), x'fd') as string)"))
    raws = [b"\xff\x61" + b"b" * 30 + b"\xfe"] * 3 + [b"\0" + b"b" * 30 + b"\xfd"]
    spec = RepeatSpec(length=20, gram=6)
    assert found(df, spec) == plain([(0, raws[0]), (1, raws[1]), (2, raws[2]), (9, raws[3])], 20)


def test_remaining_bytes(spark):
    df = spark.createDataFrame([(1, "left " + "m" * 10 + "atched" * 4 + "A"), (2, "m" * 10 + "atched" * 4 + "B right")], "doc_id long, text string")
    found = repeats(df, RepeatSpec(length=20, gram=6))
    assert sorted(bytes(row.kept) for row in found.kept().collect()) == [b"B right", b"left A"]
    found.drop()


def test_index_marks_what_counting_windows_marks():
    rng = random.Random(1)
    for _ in range(150):
        alphabet = rng.choice([b"ab", b"abc", bytes(range(256)), b"a\0\xff"])
        texts = [bytes(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(rng.randint(1, 8))]
        texts = [text if rng.random() < 0.6 else texts[0][:30] + text for text in texts]
        length = rng.choice([1, 2, 3, 5, 8, 15, 30])
        assert repeated_spans(texts, length) == plain_spans(texts, length)


def test_runs_and_statistics_are_those_of_the_definition():
    rng = random.Random(2)
    for _ in range(40):
        texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 25))) for _ in range(rng.randint(1, 5))]
        index = build(texts)
        places = [(t, i) for t, text in enumerate(texts) for i in range(len(text) + 1)]
        # The ends of texts are in the order of the texts, below all bytes.
        order = sorted(range(len(places)), key=lambda p: [b + 1 for b in texts[places[p][0]][places[p][1] :]] + [0, places[p][0]])
        assert index.suffixes.tolist() == order
        assert sum(n for _, n in index.runs) == len(places)
        transform = [texts[places[p][0]][places[p][1] - 1] + 1 if places[p][1] else 0 for p in order]
        assert [symbol for symbol, n in index.runs for _ in range(n)] == transform
        statistics = index.matching_statistics()
        for p, (t, i) in enumerate(places):
            rest = texts[t][i:]
            others = [texts[u][j:] for q, (u, j) in enumerate(places) if q != p]
            longest = max((next((k for k, (a, b) in enumerate(zip(rest, o)) if a != b), min(len(rest), len(o))) for o in others), default=0)
            assert statistics[p] == longest


def test_repetitive_texts_have_few_runs():
    rng = random.Random(4)
    text = bytes(rng.choices(range(97, 123), k=500))
    copies = [text[:i] + b"-" + text[i:] for i in range(200)]
    index = build(copies)
    assert len(index.heads) < len(index.symbols) / 20


def test_anchors_are_the_least_of_their_windows():
    rng = np.random.default_rng(5)
    for size in (0, 19, 20, 21, 400, 3000):
        data = rng.integers(0, 3, size).astype(np.uint8)
        hashes = gram_hashes(data, 6)
        assert len({(bytes(data[i : i + 6]), int(h)) for i, h in enumerate(hashes)}) == len(set(hashes.tolist()))
        least = [min(hashes[i : i + 15]) for i in range(len(hashes) - 14)]
        assert sliding_least(hashes, 15).tolist() == least
        keys, first, last, times = anchored_runs(data, 20, 6, 40)
        assert [int(k) for k, f, l in zip(keys, first, last) for _ in range(f, l + 1)] == least
        assert all(l - f < 40 for f, l in zip(first, last))
        assert [int((hashes[f : l + 15] == k).sum()) for k, f, l in zip(keys, first, last)] == times.tolist()
