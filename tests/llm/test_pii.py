"""Patterns against the plain expressions, message passing against enumeration, links by what they add."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from lettora.llm.pii import CrfSpec, Field, Graph, KINDS, N_FEATURES, N_LABELS, NONE, added_spans, base_spans, fit_field, fit_words_of, graph_of
from lettora.llm.pii import labels_of, marginals, personal_data
from lettora.llm.queries import op10_pii

FOLDER = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m[0]))


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = op10_pii(spark, FOLDER).collect()
    assert len(found) == len(docs)
    for row in found:
        spans = plain_spans(docs[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in KINDS] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        assert set(listed(spans).split(",")) <= set(row.spans.split(","))
        assert row.spans.count(":") == 2 * (len(spans) + row.n_added)


PIECES = ["a.b@c.de", "@", "x@", "é@f.g", "1.2.3.4", ".5.256.7", "0004.1.1.1", "4242 4242 4242 4242", "4242-4242-4242-4241", "-", " ", "\n",
          "+1 (555) 010-2345", "+49.30.1234567", "+", "12", "a", "+1+2", "+12345678901234567", "..", "x_y%z@q-r.s.t.", "é", "٣", ")", "1234567", "0" * 25 + "7.8.9.1"]


def test_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        assert base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("piece", ["a", "1", "1 ", "a@", "1.", "+1 ", "@", "+", "a.b@c.de "])
def test_long_runs_take_linear_time(piece):
    text = piece * (1_000_000 // len(piece))
    base_spans(text)
    graph_of(text, CrfSpec())


def example_field():
    rng = random.Random(2)
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    graphs = []
    for i in range(300):
        phone = f"+1 ({number(3)}) {number(3)}-{number(4)}"
        text = f"word {number(rng.randint(1, 3))} call {phone} or jo{i}@mail.example.com at {i % 250}.1.2.3 id {number(16)} v2.0 end {phone}"
        graph = graph_of(text, CrfSpec())
        graphs.append((graph, labels_of(graph.words, base_spans(text))))
    return fit_field(graphs, CrfSpec())


def test_the_link_weight_is_learned():
    """It follows from the training data: the stronger words look like none, the more a link has to be worth."""
    field = example_field()
    assert (field.agree > 1).all() and len(set(field.agree)) == 1
    rng = random.Random(9)
    graphs = []
    for i in range(200):
        digits = "".join(rng.choices("0123456789", k=10))
        text = f"jo{i}@mail.example.com " + " ".join(f"{digits[:3]}-{digits[3:6]}-{k}{digits[7:]}" for k in range(20))
        graph = graph_of(text, CrfSpec())
        graphs.append((graph, labels_of(graph.words, base_spans(text))))
    other = fit_field(graphs, CrfSpec())
    assert abs(other.agree[0] - field.agree[0]) > 0.2
    spec, text = CrfSpec(), "call +1 (636) 555-7248 now, later 636-555-7248."
    # Two numbers that agree with each other, but with no entity, stay what they are by themselves.
    twice = "call +1 (636) 555-7248 or 9807915762804490 or, once more, 9807915762804490"
    assert added_spans(twice, base_spans(twice), field, spec) == []
    weak = Field(field.emit, field.move, np.zeros(N_LABELS))
    assert added_spans(text, base_spans(text), field, spec) and not added_spans(text, base_spans(text), weak, spec)


def test_links_add_repetitions_and_nothing_else():
    field, spec = example_field(), CrfSpec()

    def added(text):
        return [(KINDS[k], text[a:b]) for a, k, b in added_spans(text, base_spans(text), field, spec)]

    assert added("call +1 (636) 555-7248 now, later 636-555-7248.") == [("phone", "636-555-7248")]
    assert added("call +1 (636) 555-7248 now, later (636) 555-7248 it is") == [("phone", "(636) 555-7248")]
    assert added("call +1 (636) 555-7248 now, later 636-555-7249 and 12 and v2.0") == []
    assert added("later 636-555-7248 and again 636-555-7248") == []
    assert added("call +1 (636) 555-7248 or +1 (636) 555-7248") == []
    assert added("") == added("1 2 3") == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("call +1 636 555 7248 now, later 636 555 7248.", [("phone", "636 555 7248")]),
        ("call +1 636 555 7248 now, later 636-555-7248.", [("phone", "636-555-7248")]),
        ("call +16365557248 now, later 636 555 7248 it is, or 555 7248", [("phone", "636 555 7248"), ("phone", "555 7248")]),
        ("call +49 30 1234 5678 now, later 030 1234 5678 or 0049 30 1234 5678",
         [("phone", "030 1234 5678"), ("phone", "0049 30 1234 5678")]),
        ("card 4242 4242 4242 4242 and again 4242/4242/4242/4242 here", [("card", "4242/4242/4242/4242")]),
        ("card 4012 8888 8888 1881 and again 4012/8888/8888/1881 here", [("card", "4012/8888/8888/1881")]),
        ("from 10.0.0.1 that is 10-0-0-1 here", [("ip", "10-0-0-1")]),
        ("call +1 636 555 7248 now, later 636 555 7249 or 1 636 555 9999 or 10-0-0-1", []),
        ("call +1 636 555 7248 or 636 555 7248 not 1 636 555 9999", [("phone", "636 555 7248")]),
    ],
)
def test_numbers_in_groups_are_linked(text, expected):
    assert [(KINDS[k], text[a:b]) for a, k, b in added_spans(text, base_spans(text), example_field(), CrfSpec())] == expected


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(1)
    unary = rng.normal(size=(5, N_LABELS))
    links = np.array([(0, 1), (1, 2), (1, 4), (3, 4)])
    pairwise = rng.normal(size=(4, N_LABELS, N_LABELS))
    exact = np.zeros((5, N_LABELS))
    for y in itertools.product(range(N_LABELS), repeat=5):
        weight = np.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(pairwise[e, y[a], y[b]] for e, (a, b) in enumerate(links)))
        for i, k in enumerate(y):
            exact[i, k] += weight
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(marginals(unary, links, pairwise, 50, 0.0), exact, atol=1e-5)
    assert np.allclose(marginals(unary, links[:0], pairwise[:0], 5, 0.0).sum(axis=1), 1)


def test_odd_rows(spark):
    phone = "+1 (636) 555-7248"
    rows = [(1, None), (None, f"{phone} x"), (2, ""), (2, "a@b.cd"), (2, "a@b.cd"), (3, "é 𝄞 a@b.cd 1.2.3.4"), (4, "x " * 10**5 + f" {phone}")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, n_email int, spans string")
    found = sorted(((r.doc_id, r.base_sha256) for r in personal_data(df).collect()), key=repr)
    expected = [(d, hashlib.sha256(listed(plain_spans(t)).encode()).hexdigest()) for d, t in rows]
    assert found == sorted(expected, key=repr)
    assert personal_data(df.limit(0)).count() == 0
    assert [r.n_added for r in personal_data(df.where("text = ''")).collect()] == [0]


def test_rare_and_late_entities_are_found_in_a_large_table(spark):
    numbers = " ".join(f"{i} of {i + 1} parts" for i in range(100))
    rows = [(i, f"row {i} of many, number {i * 7919}") for i in range(9000)]
    rows += [(10_000 + i, f"{numbers} call +1 (636) 555-{7000 + i} now, later 636-555-{7000 + i}.") for i in range(3)]
    found = personal_data(spark.createDataFrame(rows, "doc_id long, text string")).where("n_added > 0").collect()
    texts = dict(rows)
    added = {r.doc_id: texts[r.doc_id][slice(*map(int, r.spans.split(",")[-1].split(":")[1:]))] for r in found}
    assert added == {10_000 + i: f"636-555-{7000 + i}" for i in range(3)}


def test_words_to_fit_on_are_around_spans_and_bounded():
    text = "7 " * 500 + "x call +1 (636) 555-7248 now" + " 8" * 500
    graph, base = graph_of(text, CrfSpec()), base_spans(text)
    chosen = fit_words_of(text, graph.words, base, 64)
    assert len(chosen) == 64 and {500, 501, 502} <= set(chosen) and min(chosen) < 400 and max(chosen) > 600


def test_graph_links_next_occurrence_only():
    graph = graph_of("a1234567 " + "1234567 " * 50, CrfSpec())
    assert isinstance(graph, Graph) and len(graph.skip) == 49 and graph.features.shape == (51, N_FEATURES)
    assert (labels_of(graph.words, []) == NONE).all()
