"""Personal data: exact patterns, and a skip-chain conditional random field that adds what they miss.

Patterns find email addresses, IP addresses, card and phone numbers. The field labels the words of a document that could
belong to such an entity (those with a digit or an at sign; all other words are "none"). Its factors are features of the
word, transitions between neighbouring words, and skip links between distant words that are the same or similar: the same
address, or words of two numbers with the same last seven digits, be they written in one word or in groups. Loopy message passing lets an entity that a pattern found explain its repetition
in a form that no pattern matches. Each word is linked to the next similar one, so a word that occurs n times has n - 1
links, not n * n.

The field is fitted here, by pseudolikelihood, on pattern matches. The patterns run over all whole texts first; one half of
``CrfSpec.fit_documents`` is a hashed sample of the documents with a match, as many are taken of those without. Of each at
most ``fit_words`` words count, around matches and by hash. Patterns are never inputs of a word's features. What a skip
link is worth is learned from words whose label is hidden and has to come over the link (``link_weight``).
Words inside a pattern's match are fixed to its kind, so base spans stay as they are.

Defined cases: a NULL or empty text has no spans. Rows that repeat a ``doc_id``, or have none, are read one by one.
Texts and runs of any length take time in proportion to their length. An empty table gives an empty result; without
any match in the table nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from heapq import nsmallest
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructType

from lettora.llm.tables import map_batches
from lettora.sources.shared import written

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end


@dataclass(frozen=True)
class CrfSpec:
    fit_documents: int = 4000
    fit_words: int = 64
    fit_rounds: int = 300
    penalty: float = 0.02
    rounds: int = 12
    damping: float = 0.3
    least_probability: float = 0.5
    linked_digits: int = 7


# --- patterns ---------------------------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits does; possessive runs keep long ones linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
_GROUP = re.compile("[0-9]+")
_WINDOW = 20  # digits of a number that are compared


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back over the local part and on over the domain."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All matches of the patterns, by start and kind; ends are exclusive."""
    found: list[Span] = [(start, 0, end) for start, end in emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(int(part.lstrip("0")[:4] or "0") <= 255 for part in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := _NO_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- the graph of a document ------------------------------------------------------------------------------------------

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile("[0-9@]")
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&="
_BOUNDS = (1, 4, 7, 10, 14, 20)
N_FEATURES = 21
NONE = len(KINDS)  # the label of words outside any entity
N_LABELS = len(KINDS) + 1


def candidates(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an at sign, found from those characters, in one pass."""
    out, done = [], 0
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and text[start - 1] not in " \t\n\x0b\f\r":
            start -= 1
        done = _WORD.match(text, start).end()
        out.append((start, done))
    return out


def word_features(word: str, before: bool, after: bool) -> list[int]:
    """Indexes of the features that hold; ``before`` and ``after`` tell whether the neighbours are candidates."""
    inner = word.strip(_EDGES)
    digits = _NO_DIGITS.sub("", inner)
    bucket = sum(len(digits) >= bound for bound in _BOUNDS)
    parts = inner.split(".")
    tests = (
        "@" in inner,
        "@" in inner and "." in inner.rpartition("@")[2],
        word.lstrip(_EDGES).startswith("+"),
        len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts),
        inner.isdecimal(),
        any(c.isalpha() for c in inner),
        "-" in inner,
        "(" in word or ")" in word,
        14 <= len(digits) <= 19 and digits.isascii() and luhn(digits),
        bool(digits) and re.fullmatch(r"[0-9a-f]{16,}", inner) is not None and not inner.isdecimal(),
        before,
        after,
        "=" in word or '"' in word,
    )
    return [0, 1 + bucket, *(8 + k for k, holds in enumerate(tests) if holds)]


def link_key(word: str, piece: str) -> str | None:
    """Words with the same key are taken for the same address. ``piece`` is the part that may be a number, see ``_pieces``."""
    inner = word.strip(_EDGES)
    if "@" in inner.strip("@"):
        return inner.lower()
    groups = [group.lstrip("0") or "0" for group in _GROUP.findall(piece)] if len(piece) < 64 else []
    return ".".join(groups) if len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups) else None


def _pieces(text: str, words: list[tuple[int, int]], base: Sequence[Span]) -> list[tuple[str, int]]:
    """Of each word what may belong to a number, and which of the base spans (joined where they overlap) that is, or -1."""
    spans: list[list[int]] = []
    for start, kind, end in base:
        if kind != 0 and spans and start < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        elif kind != 0:
            spans.append([start, end])
    out, at = [], 0
    for start, end in words:
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if at < len(spans) and spans[at][0] < end:
            out.append((text[max(start, spans[at][0]) : min(end, spans[at][1])], at))
        else:
            inner = text[start:end].strip(_EDGES)
            out.append(("" if "@" in inner or any(c.isalpha() for c in inner) else inner, -1))
    return out


def number_links(pieces: list[tuple[str, int]], joined: list[bool], needed: int) -> set[tuple[int, int]]:
    """Links between the words of two numbers, each time to the last one with the same ``needed`` digits at its end.

    A number ends with a base span, with a run of neighbouring digit words, with a word that has digits enough, or where
    a run has the last digits of a base span. Words further to the left are linked as far as the digits agree, but for
    zeros in front. Every word is looked at over at most ``_WINDOW`` digits, so time is linear.
    """
    digits = [_NO_DIGITS.sub("", piece)[-_WINDOW:] for piece, _ in pieces]
    first, tails = [], []  # of each word: where its run begins, the run's last digits up to it
    for i, (_, span) in enumerate(pieces):
        on = i > 0 and span == pieces[i - 1][1] and (span >= 0 or joined[i - 1] and digits[i - 1] and digits[i])
        first.append(first[-1] if on else i)
        tails.append((tails[-1] + digits[i])[-_WINDOW:] if on else digits[i])
    ends = [i + 1 == len(first) or first[i + 1] == i + 1 for i in range(len(first))]
    known = {tail[-needed:] for (_, span), end, tail in zip(pieces, ends, tails) if end and span >= 0}

    def words(i: int, after: int, same: int) -> list[tuple[int, int, int]]:
        """Words of the number that ends with word ``i``, and which digits from its end they are."""
        out, size, j = [], 0, i
        while j > after and j >= first[i] and size < _WINDOW:
            if size >= needed and size + len(digits[j].lstrip("0")) > same:
                break
            out.append((j, size, size + len(digits[j])))
            size, j = size + len(digits[j]), j - 1
        return out

    links: set[tuple[int, int]] = set()
    last: dict[str, int] = {}
    for i, (_, span) in enumerate(pieces):
        key = tails[i][-needed:]
        if len(key) < needed or not (ends[i] or len(digits[i]) >= needed or span < 0 and key in known):
            continue
        if key in last:
            k = last[key]
            if words(i, -1, 0)[-1][0] <= k:
                continue  # both would share a word
            same = 0
            while same < min(len(tails[i]), len(tails[k])) and tails[i][-1 - same] == tails[k][-1 - same]:
                same += 1
            right = words(i, k, same)
            links |= {(a, b) for a, p, q in words(k, -1, same) for b, r, t in right if max(p, r) < min(q, t)}
        last[key] = i
    return links


@dataclass
class Graph:
    """``features`` (0/1 per word), ``chain`` and ``skip`` links as index pairs, ``outer``: neighbours that are no candidates."""

    words: list[tuple[int, int]]
    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    outer: np.ndarray


def graph_of(text: str, spec: CrfSpec, base: Sequence[Span] = ()) -> Graph:
    words = candidates(text)
    pieces = _pieces(text, words, base)
    joined = [not text[a[1] : b[0]].strip() for a, b in zip(words, words[1:])]
    features = np.zeros((len(words), N_FEATURES))
    last: dict[str, int] = {}
    skip = number_links(pieces, joined, spec.linked_digits)
    for i, (start, end) in enumerate(words):
        word = text[start:end]
        before, after = i > 0 and joined[i - 1], i < len(joined) and joined[i]
        features[i, word_features(word, before, after)] = 1
        if key := link_key(word, pieces[i][0]):
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    chain = [(i, i + 1) for i, near in enumerate(joined) if near]
    outer = np.full(len(words), 2)
    np.subtract.at(outer, np.array(chain, np.int64).ravel(), 1)
    pairs = lambda links: np.array(links, np.int64).reshape(-1, 2)
    return Graph(words, features, pairs(chain), pairs(sorted(skip)), outer)


def labels_of(words: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """The kind of the first span that each word overlaps."""
    labels = np.full(len(words), NONE)
    for start, kind, end in reversed(spans):
        for i in range(_first_after(words, start), len(words)):
            if words[i][0] >= end:
                break
            labels[i] = kind
    return labels


def _first_after(words: list[tuple[int, int]], start: int) -> int:
    low, high = 0, len(words)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if words[middle][1] <= start else (low, middle)
    return low


# --- the field --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """``emit`` (features x labels), ``move`` (labels x labels, to the right), ``agree``: reward per label of a skip link."""

    emit: np.ndarray
    move: np.ndarray
    agree: np.ndarray

    def unary(self, graph: Graph) -> np.ndarray:
        beside = (self.move[NONE] + self.move[:, NONE]) / 2
        return graph.features @ self.emit + graph.outer[:, None] * beside

    def pairwise(self, graph: Graph) -> tuple[np.ndarray, np.ndarray]:
        """All links, and the log potential of each (labels of the left x labels of the right word)."""
        links = np.concatenate((graph.chain, graph.skip))
        same = np.diag(self.agree)
        return links, np.stack([self.move] * len(graph.chain) + [same] * len(graph.skip)) if len(links) else np.zeros((0, N_LABELS, N_LABELS))


def _normal(x: np.ndarray) -> np.ndarray:
    return x - np.logaddexp.reduce(x, axis=-1, keepdims=True)


def marginals(unary: np.ndarray, links: np.ndarray, pairwise: np.ndarray, rounds: int, damping: float) -> np.ndarray:
    """Label probabilities by loopy message passing (exact on trees, given enough rounds)."""
    if not len(links):
        return np.exp(_normal(unary))
    source = np.concatenate((links[:, 0], links[:, 1]))
    target = np.concatenate((links[:, 1], links[:, 0]))
    table = np.concatenate((pairwise, pairwise.transpose(0, 2, 1)))
    back = np.concatenate((np.arange(len(links)) + len(links), np.arange(len(links))))
    message = np.zeros((len(source), unary.shape[1]))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, target, message)
        sent = _normal(np.logaddexp.reduce((belief[source] - message[back])[:, :, None] + table, axis=1))
        if np.abs(sent - message).max() < 1e-6:
            break
        message = damping * message + (1 - damping) * sent
    belief = unary.copy()
    np.add.at(belief, target, message)
    return np.exp(_normal(belief))


def fit_field(graphs: list[tuple[Graph, np.ndarray]], spec: CrfSpec) -> Field:
    """Pseudolikelihood: each word's label given the labels of the words linked to it. Plain gradient ascent."""
    shift, parts = 0, []
    for graph, _ in graphs:
        parts.append((graph.chain + shift, graph.skip + shift))
        shift += len(graph.words)
    features = np.concatenate([g.features for g, _ in graphs])
    outer = np.concatenate([g.outer for g, _ in graphs])
    known = np.concatenate([y for _, y in graphs])
    chain, skip = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    one = np.eye(N_LABELS)[known]
    emit, move, agree = np.zeros((N_FEATURES, N_LABELS)), np.zeros((N_LABELS, N_LABELS)), np.zeros(N_LABELS)
    left, right = chain.T
    a, b = skip.T
    for step in range(spec.fit_rounds):
        graph = Graph([], features, chain, skip, outer)
        score = Field(emit, move, agree).unary(graph)
        np.add.at(score, right, move[known[left]])
        np.add.at(score, left, move[:, known[right]].T)
        np.add.at(score, a, one[b] * agree)
        np.add.at(score, b, one[a] * agree)
        error = one - np.exp(_normal(score))
        rate = 4.0 / (1 + step / 50) / len(known)
        d_move = one[left].T @ error[right] + error[left].T @ one[right]
        beside = (error * outer[:, None]).sum(axis=0) / 2
        d_move[NONE] += beside
        d_move[:, NONE] += beside
        d_agree = (error[a] * one[b] + error[b] * one[a]).sum(axis=0)
        cost = spec.penalty * len(known) / 100
        emit = emit + rate * (features.T @ error - cost * emit)
        move = move + rate * (d_move - cost * move)
        agree = np.maximum(agree + rate * (d_agree - cost * agree), 0)
    field = Field(emit, move, agree)
    return Field(emit, move, np.full(N_LABELS, link_weight(field, features, known, spec)))


def link_weight(field: Field, features: np.ndarray, known: np.ndarray, spec: CrfSpec) -> float:
    """What a link to an entity is worth: the most probable value given words whose own label is hidden.

    Where patterns find both ends of a link, their features alone tell the labels, and a link learns next to nothing. But
    a repetition that patterns miss looks like a word that is none. So each word of an entity is linked to a word of that
    look, whose label has to come over the link. One weight serves all labels: few documents repeat an entity of each kind,
    and two words that agree to be none must gain as much as two that agree on a kind, or links alone would make one.
    """
    entities, others = np.flatnonzero(known != NONE), np.flatnonzero(known == NONE)
    if not len(entities):
        return 0.0
    hidden = features[others[np.arange(len(entities)) % len(others)]] if len(others) else np.eye(N_FEATURES)[:1].repeat(len(entities), 0)
    score = field.unary(Graph([], hidden, np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64), np.full(len(entities), 2)))
    at = np.arange(len(entities)), known[entities]
    cost, weight = spec.penalty / 100, 0.0
    for _ in range(100):  # the likelihood is concave in one number: Newton's method
        moved = score.copy()
        moved[at] += weight
        p = np.exp(_normal(moved))[at]
        slope, bend = (1 - p).mean() - cost * weight, (p * (1 - p)).mean() + cost
        weight += float(np.clip(slope / bend, -1, 1))
    return max(weight, 0.0)


def _entity(text: str, kind: int) -> bool:
    if kind == 0:
        return "@" in text.strip("@")
    return len(_DIGITS.findall(text)) >= 7 or kind == 1 and len(_GROUP.findall(text)) == 4


def added_spans(text: str, base: list[Span], field: Field, spec: CrfSpec) -> list[Span]:
    """Runs of words, with a skip link among them, that the field gives a kind, apart from base spans."""
    graph = graph_of(text, spec, base)
    fixed = labels_of(graph.words, base)
    if not len(graph.skip) or (fixed != NONE).all() or (fixed == NONE).all():
        return []  # no word can owe its label to another one
    unary = field.unary(graph)
    unary[fixed != NONE] += 50.0 * np.eye(N_LABELS)[fixed[fixed != NONE]]
    probable = marginals(unary, *field.pairwise(graph), spec.rounds, spec.damping)
    label = np.where(probable.max(axis=1) >= spec.least_probability, probable.argmax(axis=1), NONE)
    near = {int(i) for i, _ in graph.chain}
    linked = np.zeros(len(label), bool)
    linked[graph.skip.ravel()] = True
    out, i = [], 0
    while i < len(label):
        j = i
        while j in near and label[j + 1] == label[i] and fixed[j + 1] == NONE:
            j += 1
        if label[i] != NONE and fixed[i] == NONE and linked[i : j + 1].any():
            start, end = graph.words[i][0], graph.words[j][1]
            piece = text[start:end]
            opening = _EDGES.replace("(", "") if ")" in piece else _EDGES
            start, end = start + len(piece) - len(piece.lstrip(opening)), end - (len(piece) - len(piece.rstrip(_EDGES)))
            if start < end and _entity(text[start:end], label[i]):
                out.append((start, int(label[i]), end))
        i = j + 1
    return out


# --- documents --------------------------------------------------------------------------------------------------------

_SAMPLE = StructType().add("words", ArrayType(LongType())).add("features", ArrayType(DoubleType()))
for _name in ("chain", "skip", "outer", "labels"):
    _SAMPLE.add(_name, ArrayType(LongType()))


def fit_words_of(text: str, words: list[tuple[int, int]], base: list[Span], limit: int) -> list[int]:
    """Indexes of at most ``limit`` words: those of spans, by hash, with a neighbour on each side, then any by hash."""
    chosen: set[int] = set()
    for start, _, end in nsmallest(limit, base, key=lambda span: (crc32(repr(span).encode()), span)):
        first = last = _first_after(words, start)
        while last < len(words) and words[last][0] < end:
            last += 1
        around = chosen.union(range(max(first - 1, 0), min(last + 1, len(words))))
        if len(around) > limit:
            break
        chosen = around
    rest = (i for i in range(len(words)) if i not in chosen)
    by_hash = nsmallest(limit - len(chosen), rest, key=lambda i: (crc32(f"{i} {text[slice(*words[i])]}".encode()), i))
    return sorted(chosen.union(by_hash))


def _part(graph: Graph, chosen: list[int]) -> Graph:
    """The graph of some of its words; a neighbour left out counts as one that is no candidate."""
    place = np.full(len(graph.words), -1)
    place[chosen] = np.arange(len(chosen))
    links = [place[pairs] for pairs in (graph.chain, graph.skip)]
    chain, skip = (pairs[(pairs >= 0).all(axis=1)] for pairs in links)
    outer = np.full(len(chosen), 2)
    np.subtract.at(outer, chain.ravel(), 1)
    return Graph([graph.words[i] for i in chosen], graph.features[chosen], chain, skip, outer)


_MATCHED = StructType().add("key", LongType()).add("matched", BooleanType())


def _matched_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    rows = []
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py() or ""
        if _MARK.search(text):
            rows.append((key, bool(base_spans(text))))
    if rows:
        yield zip(*rows)


def _sample_rows(batch: pa.RecordBatch, last: dict[bool, int], spec: CrfSpec) -> Iterator[tuple]:
    rows = []
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        if key > max(last.values()):
            continue
        text = text.as_py() or ""
        if not _MARK.search(text):
            continue
        base = base_spans(text)
        if key > last.get(bool(base), key - 1):
            continue
        whole, flat = graph_of(text, spec, base), lambda a: np.asarray(a).ravel().tolist()
        graph = _part(whole, fit_words_of(text, whole.words, base, spec.fit_words))
        labels = labels_of(graph.words, base)
        rows.append([flat(a) for a in (graph.words, graph.features, graph.chain, graph.skip, graph.outer, labels)])
    if rows:
        yield zip(*rows)


def fitted_field(documents: DataFrame, spec: CrfSpec = CrfSpec()) -> Field | None:
    """Fitted on at most ``fit_documents`` documents, chosen by hash; None if no document of all has an entity."""
    keyed = documents.select(F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))
    # Copies without a doc_id share a hash; once is enough of them.
    matched = written(map_batches(keyed, _matched_rows, _MATCHED).distinct(), "matched")
    last: dict[bool, int] = {}
    wanted = spec.fit_documents // 2
    for kind in (True, False):
        keys = [row.key for row in matched.where(F.col("matched") == kind).orderBy("key").limit(wanted).collect()]
        if kind and not keys:
            return None
        if keys:
            last[kind], wanted = keys[-1], len(keys)
    sampled = map_batches(keyed, _sample_rows, _SAMPLE, last, spec).distinct()
    graphs = []
    for words, features, chain, skip, outer, labels in sorted(map(tuple, sampled.collect())):
        pairs = lambda flat: np.array(flat, np.int64).reshape(-1, 2)
        graph = Graph(pairs(words).tolist(), np.reshape(features, (-1, N_FEATURES)), pairs(chain), pairs(skip), np.array(outer))
        graphs.append((graph, np.array(labels)))
    return fit_field(graphs, spec)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _span_rows(batch: pa.RecordBatch, field: Field | None, spec: CrfSpec) -> Iterator[tuple]:
    rows = []
    for text in batch.column(1):
        text = text.as_py() or ""
        base = base_spans(text)
        added = added_spans(text, base, field, spec) if base and field is not None else []
        counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
        rows.append((*counts, sha256(_listed(base).encode()).hexdigest(), _listed(base + added), len(added)))
    if rows:
        yield batch.column(0), *zip(*rows)


def personal_data(documents: DataFrame, spec: CrfSpec = CrfSpec()) -> DataFrame:
    """``doc_id``, counts of base spans per kind, SHA-256 of their list, the list of all ``spans``, and ``n_added``."""
    schema = StructType().add("doc_id", LongType())
    for kind in KINDS:
        schema.add(f"n_{kind}", LongType())
    schema.add("base_sha256", StringType()).add("spans", StringType()).add("n_added", LongType())
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(slim, _span_rows, schema, fitted_field(slim, spec), spec)
