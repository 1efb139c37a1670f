"""Alignment against a plain version, and both ways to side A's ids against each other."""

import hashlib
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest

from lettora.llm.token_alignment import AlignSpec, Tokenizers, token_alignment, tokenizers
from lettora.params import SkewLimits

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides() -> Tokenizers:
    return tokenizers(AlignSpec())


def plain(rows, sides):
    aligned = {}
    for text in {text for _, text in rows}:
        if not text:
            continue
        a = sides.a.encode(" " + text, add_special_tokens=False).ids
        b = sides.b.encode(text)
        spelled = (" " + text).encode()
        if b"".join(sides.a_bytes[i] for i in a) != spelled or b"".join(sides.b_bytes[i] for i in b) != spelled:
            continue
        groups, links, i, j, at_a, at_b = [], [], 0, 0, 0, 0
        while i < len(a):
            group = [a[i]], [b[j]]
            at_a, at_b = at_a + len(sides.a_bytes[a[i]]), at_b + len(sides.b_bytes[b[j]])
            i, j = i + 1, j + 1
            while at_a != at_b:
                if at_a < at_b:
                    group[0].append(a[i])
                    at_a, i = at_a + len(sides.a_bytes[a[i]]), i + 1
                else:
                    group[1].append(b[j])
                    at_b, j = at_b + len(sides.b_bytes[b[j]]), j + 1
            groups.append("|".join(",".join(map(str, side)) for side in group))
            links.append((group[0][-1], group[1][-1]))
        assert j == len(b)
        aligned[text] = len(a), len(b), groups, links
    counts = Counter(link for _, text in rows if text in aligned for link in aligned[text][3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, text in rows:
        if text not in aligned:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = aligned[text]
        n_best = sum(counts[link] == most[link[1]] for link in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[link] for link in links), sha))
    return sorted(out, key=repr)


def found(df, *args):
    return sorted(map(tuple, token_alignment(df, *args).select(*COLUMNS).collect()), key=repr)


def test_documents_equal_plain(spark, sides):
    from lettora.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    rows = list(zip(table["doc_id"], table["text"]))
    result = LLM_QUERIES["op11_token_alignment"](spark, folder)
    assert sorted(map(tuple, result.select(*COLUMNS).collect()), key=repr) == plain(rows, sides)


@pytest.mark.parametrize("block_bytes", [1, 300, 4_000_000])
def test_odd_rows(spark, sides, block_bytes):
    texts = ["", None, " ", "\n", "a", "Hello  world", "Ünïcode über älles", "x▁y", "▁", "日本語のテキスト 🙂", "\x00\x01", "<s>"]
    texts += ["<|endoftext|> and <unk> </s>", "tie tie", "ab" * 4000, "word " * 3000, "  x", "é ﬁ Å", "Hello  world"]
    rows = [*enumerate(texts), (3, "a"), (3, "a"), (None, "a"), (None, None)] + [(100 + i, "hot text") for i in range(50)]
    wide = spark.createDataFrame([(*r, 1, b"z") for r in rows], "doc_id long, text string, copies int, raw binary")
    assert found(wide, AlignSpec(block_bytes=block_bytes), SkewLimits(10)) == plain(rows, sides)
    assert found(wide.limit(0)) == []


def test_text_that_is_no_utf8(spark):
    df = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert found(df) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_fast_side_a_equals_the_file(sides):
    special = "<|endoftext|>"
    texts = [f" {c}{c} a{c}b 1{c} {c}2\n{c} '{c}" for c in map(chr, range(0x530))]
    texts += [" " * 40 + "x", "\n\n \t x", special, f"a{special}b", "don't we'll I'VE", "9" * 500, "\r\n" * 7]
    for text in texts:
        assert sides.fast_a.encode_ordinary(text) == sides.a.encode(text, add_special_tokens=False).ids, repr(text)


def test_given_documents_by_both_ways(sides):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    texts = [" " + text for text in texts if text]
    whole = sides.a.encode_batch_fast(texts, add_special_tokens=False)
    assert all(sides.encode_a(text) == ids.ids for text, ids in zip(texts, whole))


def test_files_lie_where_the_parameter_says():
    assert os.path.exists(os.path.join(AlignSpec().folder, AlignSpec().byte_level))
    with pytest.raises(Exception):
        Tokenizers(AlignSpec(folder="/nowhere"))
