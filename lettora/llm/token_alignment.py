"""Cross-tokenizer alignment: which tokens of vocabulary A go with which of vocabulary B, over exact-text classes.

1. Rows are shuffled by their full text, equal ones combined before the shuffle. Every distinct text is tokenised and
   aligned once, whatever the number of its copies.
2. Distinct texts are worked on in blocks of bounded bytes. Token ends of both sides are byte offsets; where both sides
   end, a group ends and its last two tokens are linked. A block keeps a dictionary of its linked id pairs, each with the
   number of links weighted by the multiplicity of their texts, and per text how often it uses which entry.
3. Pair counts of the corpus are sums over dictionaries, not over texts. They are joined to the dictionaries, and come
   back to each block as one array, from which the measures of its texts are added up.
4. Measures of a text are joined to all rows with that text by its SHA-256; a text with very many copies is split.

A text has one link per group, as no entry of either vocabulary is empty.

Defined cases: NULL and empty texts, texts that are no valid UTF-8 and texts whose tokens do not spell out space + text
(such as those with U+2581) have no tokens: zeros and an empty ``groups_sha256``. Repeated rows are counted and returned
as often as they occur. Texts of any length are tokenised whole. Ties for the best count are all best. Only ``doc_id``
and ``text`` are read, further columns do not matter. An empty table gives an empty result.

Side A is read from the JSON file. Its merges are applied by ``tiktoken``, which gives the same ids several times faster
(tests compare all characters below U+0530, and whole documents); texts with characters from there on, whose classes may
differ between Unicode versions, go through ``tokenizers`` itself.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from lettora.llm.tables import PIECE_ROWS
from lettora.operators.skew import skew_join
from lettora.params import SkewLimits
from lettora.sources.shared import written


@dataclass(frozen=True)
class AlignSpec:
    """``folder`` holds the vocabulary files; ``block_bytes`` bounds the texts of a block (a longer text is one block)."""

    folder: str = "/opt/tokenizers"
    byte_level: str = "byte_bpe_50k.json"
    pieces: str = "piece_bpe_32k.model"
    block_bytes: int = 4 * 1024 * 1024


# --- tokenizers -------------------------------------------------------------------------------------------------------

#: Characters whose classes (letter, number, space) are the same in all Unicode versions in use.
_SETTLED = "\u0530"
#: Fixed value: the published pattern that splits text before byte-level merges.
_SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {chr(256 + n): byte for n, byte in enumerate(others)}


class Tokenizers:
    """Both sides, and the bytes of their tokens."""

    def __init__(self, spec: AlignSpec):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        path = os.path.join(spec.folder, spec.byte_level)
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        of_char = byte_of_char()
        special = {token["id"] for token in stored["added_tokens"]}
        ranks = {bytes(map(of_char.get, entry)): i for entry, i in stored["model"]["vocab"].items() if i not in special}
        self.fast_a = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(map(of_char.get, entry))
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(spec.folder, spec.pieces))
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([*map(len, side)], np.int64) for side in (self.a_bytes, self.b_bytes))

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if max(text) < _SETTLED:
            return self.fast_a.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, raw: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of both sides; None if either does not spell out space + text, or the text is no UTF-8."""
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return None
        a, b = self.encode_a(" " + text), self.b.encode(text)
        spelled = b" " + raw
        whole = b"".join(map(self.a_bytes.__getitem__, a)) == spelled and b"".join(map(self.b_bytes.__getitem__, b)) == spelled
        return (a, b) if whole else None


@lru_cache(maxsize=1)
def tokenizers(spec: AlignSpec) -> Tokenizers:
    return Tokenizers(spec)


# --- alignment of a block ---------------------------------------------------------------------------------------------


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..n-1, one row of characters each, and which of them are used."""
    text = np.array([str(i) for i in range(n)], f"S{len(str(n))}")
    digits = text.view(np.uint8).reshape(n, -1)
    return digits, digits > 0


def _group_texts(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2``: of concatenated texts, each cut off at its number of groups in ``ends``."""
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # A token stands behind all of its own side, those of A behind B's of earlier groups, those of B behind A's up to its own.
    first_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
    first_a = np.concatenate(([0], np.flatnonzero(last_a) + 1))
    place_a = np.arange(len(a)) + first_b[group_a]
    place_b = np.arange(len(b)) + first_a[group_b + 1]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = a, b
    after = np.full(len(ids), ord(","), np.uint8)
    after[place_a[last_a]], after[place_b[last_b]] = ord("|"), ord(";")
    digits, used = _decimals(int(ids.max()) + 1)
    width = digits.shape[1]
    chars, keep = np.empty((len(ids), width + 1), np.uint8), np.ones((len(ids), width + 1), bool)
    chars[:, :width], chars[:, width], keep[:, :width] = digits[ids], after, used[ids]
    joined = chars[keep].tobytes()
    stops = np.cumsum(keep.sum(axis=1))[place_b[last_b][ends - 1]]
    starts = np.concatenate(([0], stops[:-1]))
    return [joined[start : stop - 1] for start, stop in zip(starts, stops)]  # without the last ";"


def align(texts: list[tuple[list[int], list[int]]], a_sizes: np.ndarray, b_sizes: np.ndarray) -> dict:
    """Groups and links of texts whose two token lists cover the same bytes.

    Per text: ``n_a``, ``n_b``, ``n_groups``, ``groups`` (as text). Over all: ``pairs``, the linked ids as ``a << 32 | b``
    in ascending order, and ``use``, rows of text, entry of ``pairs`` and number of links.
    """
    n_a, n_b = (np.array([len(t[side]) for t in texts], np.int64) for side in (0, 1))
    a, b = (np.fromiter((i for t in texts for i in t[side]), np.int64, int(n.sum())) for side, n in ((0, n_a), (1, n_b)))
    ends_a, ends_b = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    shared = np.zeros(int(ends_a[-1]) + 1, bool)
    shared[ends_a] = True
    last_b = shared[ends_b]
    shared[:] = False
    shared[ends_b] = True
    last_a = shared[ends_a]
    ends = np.cumsum(last_a)[np.cumsum(n_a) - 1]  # groups up to the end of each text
    links = a[last_a] << 32 | b[last_b]
    pairs, entry = np.unique(links, return_inverse=True)
    text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    used, times = np.unique(text * len(pairs) + entry, return_counts=True)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.diff(ends, prepend=0),
        "groups": _group_texts(a, b, last_a, last_b, ends),
        "pairs": pairs,
        "use": np.stack([used // len(pairs), used % len(pairs), times]),
    }


# --- blocks of distinct texts -----------------------------------------------------------------------------------------

_BLOCK = StructType().add("block", LongType()).add("pairs", ArrayType(LongType())).add("weights", ArrayType(LongType()))
_BLOCK.add("digests", ArrayType(BinaryType())).add("groups_sha256", ArrayType(StringType()))
for _name in ("n_a", "n_b", "n_groups"):
    _BLOCK.add(_name, ArrayType(LongType()))
for _name in ("text", "entry", "times"):
    _BLOCK.add(_name, BinaryType())


def _block_row(number: int, texts: list, digests: list, copies: list, sides: Tokenizers) -> dict:
    found = align(texts, sides.a_sizes, sides.b_sizes)
    text, entry, times = found["use"]
    weights = np.zeros(len(found["pairs"]), np.int64)
    np.add.at(weights, entry, times * np.array(copies, np.int64)[text])
    shas = [hashlib.sha256(groups).hexdigest() for groups in found["groups"]]
    row = {"block": number, "pairs": found["pairs"], "weights": weights, "digests": digests, "groups_sha256": shas}
    row |= {name: found[name] for name in ("n_a", "n_b", "n_groups")}
    return row | {name: values.astype(np.int32).tobytes() for name, values in (("text", text), ("entry", entry), ("times", times))}


def text_blocks(texts: DataFrame, spec: AlignSpec) -> DataFrame:
    """Distinct texts (``raw``, ``digest``, ``copies``) -> a row per block. Texts without tokens are left out."""
    arrow = _arrow(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tokenizers(spec)
        task, made = TaskContext.get().partitionId(), 0
        held: tuple[list, list, list] = ([], [], [])
        size = 0

        def flushed() -> pa.RecordBatch:
            row = _block_row(task << 32 | made, *held, sides)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for raw, digest, copies in zip(*(batch.column(name) for name in ("raw", "digest", "copies"))):
                data = raw.as_py()
                ids = sides.encode(data)
                if ids is None:
                    continue
                if held[0] and size + len(data) > spec.block_bytes:
                    yield flushed()
                    made, size, held = made + 1, 0, ([], [], [])
                # As arrays, ids take an eighth of what lists of them do.
                for values, value in zip(held, ([np.array(side, np.int32) for side in ids], digest.as_py(), copies.as_py())):
                    values.append(value)
                size += len(data)
        if held[0]:
            yield flushed()

    return texts.select("raw", "digest", "copies").mapInArrow(run, _BLOCK)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# --- corpus -----------------------------------------------------------------------------------------------------------


def _side_b(pair: Column) -> Column:
    return pair.bitwiseAND(F.lit(0xFFFFFFFF))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links of the corpus) and ``best``: whether no other pair with the same B id has more."""
    entries = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("e")).select("e.pairs", "e.weights")
    counted = written(entries.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n")), "pair_counts")
    # As many rows as vocabulary B has entries.
    most = F.broadcast(counted.groupBy(_side_b(F.col("pair")).alias("b")).agg(F.max("n").alias("most")))
    return counted.join(most, _side_b(F.col("pair")) == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_MEASURES = StructType().add("digest", BinaryType())
for _name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
    _MEASURES.add(_name, LongType())
_MEASURES.add("groups_sha256", StringType())


def _measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = _arrow(_MEASURES)
    for batch in batches:
        for at in range(batch.num_rows):
            cell = {name: batch.column(name)[at] for name in batch.schema.names}
            text, entry, times = (np.frombuffer(cell[name].as_py(), np.int32).astype(np.int64) for name in ("text", "entry", "times"))
            known = pa.RecordBatch.from_struct_array(cell["counts"].values)
            place = known.column("pos").to_numpy()
            n, best = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
            n[place] = known.column("n").to_numpy()
            best[place] = known.column("best").to_numpy(zero_copy_only=False)
            per_text = {name: cell[name].values for name in ("n_a", "n_b", "n_groups", "groups_sha256")}
            texts = len(per_text["n_a"])
            # Integers: sums of doubles would be inexact from 2^53 on.
            n_best, count_sum = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
            np.add.at(n_best, text, times * best[entry])
            np.add.at(count_sum, text, times * n[entry])
            columns = per_text | {"digest": cell["digests"].values, "n_links": per_text["n_groups"]}
            columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
            whole = pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)
            for start in range(0, texts, PIECE_ROWS):
                yield whole.slice(start, PIECE_ROWS)


def text_measures(texts: DataFrame, spec: AlignSpec = AlignSpec(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    """Distinct texts (``raw``, ``digest``, ``copies``) -> ``digest`` and measures of those that have tokens."""
    blocks = written(text_blocks(texts, spec), "alignments")
    counts = written(pair_counts(blocks), "pair_bests")
    entries = blocks.select("block", F.posexplode("pairs").alias("pos", "pair"))
    # A pair has at most one entry per block, so with few blocks none is hot.
    few = blocks.count() <= limits.rows_per_task
    looked_up = skew_join(entries, counts, ["pair"], "inner", None if few else limits)
    arrays = looked_up.groupBy("block").agg(F.collect_list(F.struct("pos", "n", "best")).alias("counts"))
    rest = blocks.drop("pairs", "weights").join(arrays, "block")
    return rest.mapInArrow(_measure_rows, _MEASURES)


def token_alignment(documents: DataFrame, spec: AlignSpec = AlignSpec(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    """``doc_id`` and the measures of its text, for every row of ``documents``."""
    raw = F.col("text").cast("binary")
    texts = documents.where(F.length("text") > 0).groupBy(raw.alias("raw")).agg(F.count(F.lit(1)).alias("copies"))
    digest = F.unhex(F.sha2("raw", 256)).alias("digest")
    measures = written(text_measures(texts.select("raw", digest, "copies"), spec, limits), "alignment_measures")
    rows = documents.select(F.col("doc_id").cast("long"), raw.alias("raw")).select("doc_id", digest)
    joined = skew_join(rows, measures, ["digest"], "left", limits)
    names = _MEASURES.names[1:-1]
    zeros = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in names]
    return joined.select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
