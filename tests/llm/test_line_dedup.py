"""Line dedup against SQL and a plain version; the perfect hash against its definition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettora.llm.line_dedup import LineSpec, build_perfect_hash, dedup_lines, drop_shared_lines, probe

BLANKS = " \t\n\x0b\x0c\r"


def plain(rows, spec):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = {}
    for at, (doc_id, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= spec.min_chars:
                holders.setdefault(k, []).append(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(key(line), [])
            known = [d for d in held if d is not None]
            if len(held) < spec.min_documents or not known or doc_id == max(known):
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df, spec):
    return sorted((tuple(r) for r in dedup_lines(df, spec).select("row.doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def test_query_equals_sql(equals_sql):
    equals_sql("op9_line_dedup", "/root/testdata/sf0.01")


@pytest.mark.parametrize("spec", [LineSpec(), LineSpec(min_documents=2, min_chars=3, shard_keys=7, requests_per_task=10)])
def test_odd_rows_and_hot_lines(spark, spec):
    rng = random.Random(4)
    pool = [f"{'Line' * 9} number {i} é" for i in range(40)] + ["short", "", " ", "ä" * 40, "ä" * 39]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(120)]
    hot = "the line that every third document holds, again and again"
    rows += [(200 + i, f"{hot.title()}\nown {i}\n\t{hot}\x0b\n") for i in range(60)]
    rows += [(None, hot), (None, None), (7, None), (8, ""), (259, hot), (259, hot), (1, rows[1][1]), (300, "x" * 500_000 + "\n" + hot)]
    rows += [(None, "n" * 50)] * 6
    wide = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, n_lines int, row string")
    assert found(wide, spec) == plain(rows, spec)
    cut = drop_shared_lines(wide, spec)
    assert cut.columns == wide.columns and cut.count() == len(rows)
    assert found(wide.limit(0), spec) == []


def test_lines_that_are_no_utf8_and_equal_rows(spark):
    rows = spark.sql("select id as doc_id, cast(concat(x'ff', repeat('b', 50), x'0a61') as string) as text from range(5)")
    cut = dedup_lines(rows).select("row.doc_id", F.hex(F.col("text").cast("binary")).alias("hex"), "n_dropped").collect()
    assert {(r.doc_id, r.n_dropped, r.hex == "61") for r in cut} == {(i, int(i < 4), i < 4) for i in range(5)}
    equal = spark.range(0, 3000, 1, 8).selectExpr("7L as doc_id", "repeat('line ', 20) as text").union(spark.sql("select 9L, repeat('line ', 20)"))
    spec = LineSpec(requests_per_task=100)
    found = dedup_lines(equal, spec).groupBy("row.doc_id", "n_dropped").count().collect()
    assert sorted(map(tuple, found)) == [(7, 1, 3000), (9, 0, 1)]


@pytest.mark.parametrize("size", [1, 2, 63, 5000])
def test_perfect_hash_numbers_every_key_once(size):
    rng = np.random.default_rng(size)
    h1, h2 = rng.integers(0, 2**64, (2, size), np.uint64)
    h1[: size // 2] = h1[0]  # equal first halves
    levels, number = build_perfect_hash(h1, h2)
    assert sorted(number) == [*range(size)]
    assert (probe(levels, h1, h2) == number).all()
    assert sum(map(len, levels)) * 64 <= 5 * size + 64 * len(levels)
