"""Mix sources to target weights, in whole blocks of words; DataFrame and SQL functions only.

1. Targets: sources in code point order (NULL last) weigh ``weights`` in turn and share the total number of words; a
   target stops at ``max_repeats`` times its source, the excess going to the others by weight until none is above.
2. Packing: the words of a source, document after document, form blocks of ``block_words`` (the last may be shorter).
   Offsets are sums over runs of buckets of documents, inside a run and inside a bucket, so a large source is many tasks.
3. Drawing: every slot of an output shard draws its source from a hash of its number, which makes the counts of a shard
   multinomial. Where a source drew more slots than its target allows, its last slots go to sources that drew too few.
   The last slots of a source take fewer words, or none, so that its target is met to the word.
4. Slot ``j`` of a source reads block ``p(j mod blocks)``, with a pseudorandom permutation ``p`` of its own for every pass
   over the source (swap-or-not rounds, exact for any length). No block is read more than ``max_repeats`` times.
5. Blocks and slots meet by source number and block number.

All randomness is hashed from ``seed``: reruns and retried tasks agree. Nothing but the number of slots comes to the
driver. The one-row-per-source table is the only one that passes through a single task.

Defined cases: a NULL text has no words; documents without words are listed and nothing is taken. NULL is a source of its
own. Rows that repeat a ``doc_id``, or have none, are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettora.operators.skew import skew_join
from lettora.sources.shared import written

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a source that are summed in one window; sums of these runs are summed in a second one.
RUN_ROWS = 4096
#: Cells of the interval lookup; more only makes its small table longer.
CELLS = 4096


@dataclass(frozen=True)
class MixSpec:
    weights: tuple[int, ...] = (1, 2, 3)
    max_repeats: int = 3
    block_words: int = 64
    shard_slots: int = 1024
    bucket_rows: int = 2000
    slots_per_task: int = 100_000
    rounds: int = 12
    seed: int = 17


@dataclass(frozen=True)
class Mix:
    """``documents``: placed words of every document; ``sources``: one row each; ``slots``: what each slot reads."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    spec: MixSpec


def _from_left(order: list[Column]) -> Column:
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: str, over) -> Column:
    return F.coalesce(F.sum(column).over(over), F.lit(0))


def _with_sum_before(rows: DataFrame, index: str, value: str) -> DataFrame:
    """``rows`` (``sid``, distinct ``index`` from 0) with ``before``, the sum of ``value`` over smaller ``index`` of the ``sid``.

    Two sums, over runs of indexes and inside a run, so that no window holds a whole source.
    """
    rows = rows.withColumn("run", F.floor(F.col(index) / RUN_ROWS))
    runs = rows.groupBy("sid", "run").agg(F.sum(value).alias("of_run"))
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", _sum_before("of_run", earlier).alias("before_run"))
    inside = Window.partitionBy("sid", "run").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("before", _sum_before(value, inside)).join(runs, ["sid", "run"])
    return joined.withColumn("before", F.col("before") + F.col("before_run")).drop("run", "before_run")


def with_targets(sizes: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``source``, ``source_size`` -> also ``sid`` (0, 1, ...), ``weight`` and ``target``.

    Sources sorted by cap per weight: once the rate that is left for the others fits under one cap, it fits under all
    later ones; that rate times weight is the target of those, the cap that of the ones before.
    """
    order = F.col("source").asc_nulls_last()
    weights = F.array(*map(F.lit, spec.weights))
    table = sizes.withColumn("sid", F.row_number().over(Window.orderBy(order)) - 1)
    table = table.withColumn("weight", F.element_at(weights, F.col("sid") % len(spec.weights) + 1))
    table = table.withColumn("cap", spec.max_repeats * F.col("source_size"))
    by_room = [F.col("cap") / F.col("weight"), F.col("sid")]
    whole = Window.partitionBy()
    onward = Window.orderBy(*by_room).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - _sum_before("cap", _from_left(by_room))
    table = table.withColumn("rate", left / F.sum("weight").over(onward))
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.col("rate"))
    table = table.withColumn("rate", F.coalesce(F.max(fits).over(whole), F.lit(0.0)))
    target = F.least(F.col("cap").cast("double"), F.col("rate") * F.col("weight"))
    return table.select("source", "sid", "source_size", "n_documents", "weight", target.alias("target"))


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words, and a hash that orders rows of the same ``doc_id``."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    tie = F.xxhash64("doc_id", "source", "text")
    return documents.select("doc_id", "source", words.alias("size"), tie.alias("tie"))


def _placed(counted: DataFrame, sources: DataFrame, spec: MixSpec) -> DataFrame:
    """Documents with ``sid`` and the ``offset`` of their first word in the source."""
    keyed = counted.withColumn("key", F.struct("source"))
    buckets = F.greatest(F.ceil(F.col("n_documents") / spec.bucket_rows), F.lit(1)).alias("buckets")
    keys = sources.select(F.struct("source").alias("key"), "sid", buckets)
    n_rows = sources.select(F.struct("source").alias("key"), F.col("n_documents").alias("n"))
    rows = skew_join(keyed, keys, ["key"], counted=n_rows).drop("key")
    rows = rows.withColumn("bucket", F.pmod("tie", "buckets")).drop("buckets")
    sums = _with_sum_before(rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words")), "bucket", "words").drop("words")
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "tie", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", _sum_before("size", inside)).join(sums, ["sid", "bucket"])
    return rows.withColumn("offset", F.col("before") + F.col("within")).drop("bucket", "within", "before", "tie")


# --- slots ------------------------------------------------------------------------------------------------------------


def _within(points: DataFrame, point: str, intervals: DataFrame, total: int) -> DataFrame:
    """Join every point to the interval ``low`` <= point < ``high`` that holds it, by equal cells of the number line."""
    width = max(1, total // CELLS)
    cells = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    listed = intervals.where("low < high").withColumn("cell", F.explode(cells))
    joined = points.withColumn("cell", F.floor(F.col(point) / width)).join(listed, "cell")
    return joined.where((F.col(point) >= F.col("low")) & (F.col(point) < F.col("high"))).drop("cell", "low", "high")


def _intervals(table: DataFrame, length: str, *columns: str) -> DataFrame:
    low = _sum_before(length, _from_left([F.col("sid")]))
    return table.withColumn("low", low).select("sid", "low", (F.col("low") + F.col(length)).alias("high"), *columns)


def permuted(position: str, length: str, key: list[str], spec: MixSpec) -> Column:
    """``position`` (0 to ``length`` - 1) under a permutation of that length keyed by the columns ``key``.

    Swap-or-not: each round pairs x with k - x and swaps the pair, or not, by a hash of its larger member.
    """
    keys = ", ".join([str(spec.seed), *key])
    other = f"pmod(pmod(xxhash64({keys}, r), {length}) - x, {length})"
    swap = f"xxhash64({keys}, r, greatest(x, {other}), 'swap') & 1 = 1"
    return F.expr(f"aggregate(sequence(1, {spec.rounds}), {position}, (x, r) -> if({swap}, {other}, x))")


def _slots(sources: DataFrame, n_slots: int, spec: MixSpec) -> DataFrame:
    """``shard``, ``slot``, ``sid``, ``block`` for every slot of the output."""
    draw = sources.sparkSession.range(n_slots).select(
        F.floor(F.col("id") / spec.shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(spec.seed), "id"), F.lit(n_slots)).alias("drawn"),
    )
    shards = _within(draw, "drawn", _intervals(sources, "quota"), n_slots).groupBy("shard", "sid")
    shards = written(shards.agg(F.count(F.lit(1)).alias("n")), "mix_shards")
    counted = _with_sum_before(shards, "shard", "n")
    # A few rows here become all slots: deal them to as many tasks as the slots need.
    counted = counted.repartition(n_slots // spec.slots_per_task + 1, "shard", "sid")
    numbered = counted.select("shard", "sid", F.explode(F.sequence(F.col("before"), F.expr("before + n - 1"))).alias("j"))
    drawn = shards.groupBy("sid").agg(F.sum("n").alias("drawn"))
    table = sources.join(drawn, "sid", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    table = table.withColumn("over", F.greatest(F.expr("drawn - quota"), F.lit(0)))
    table = written(table.withColumn("under", F.greatest(F.expr("quota - drawn"), F.lit(0))), "mix_draws")
    over = _intervals(table, "over", "quota").withColumnRenamed("low", "first").drop("high")
    numbered = numbered.join(over, "sid")
    spare = numbered.where("j >= quota").select("shard", (F.col("first") + F.col("j") - F.col("quota")).alias("spare"))
    n_spare = table.agg(F.sum("over")).first()[0] or 0
    under = _intervals(table, "under", "drawn").withColumn("first", F.col("low"))
    moved = _within(spare, "spare", under, n_spare).select("shard", "sid", F.expr("drawn + spare - first").alias("j"))
    slots = numbered.where("j < quota").select("shard", "sid", "j").union(moved)
    slots = slots.join(sources.select("sid", "n_blocks", "source_size", "wanted"), "sid")
    slots = slots.withColumn("epoch", F.expr("j div n_blocks")).withColumn("position", F.expr("j % n_blocks"))
    slots = slots.withColumn("block", permuted("position", "n_blocks", ["sid", "epoch"], spec))
    return _to_the_word(slots, spec).select("shard", "sid", "j", "block", "words")


def _to_the_word(slots: DataFrame, spec: MixSpec) -> DataFrame:
    """``words``, how many of its block a slot takes: all, but for the last pass over a source, which ends at its target.

    Blocks are of one size but for the last one of a source, so the words before a slot follow from its position in the
    pass and from whether that block came earlier.
    """
    size, last = spec.block_words, "source_size - block_size * (n_blocks - 1)"
    slots = slots.withColumn("block_size", F.lit(size).cast("long")).withColumn("short", F.expr("block = n_blocks - 1"))
    slots = slots.withColumn("final", F.expr("epoch = wanted div source_size"))
    short = slots.where("short and final").select("sid", F.col("position").alias("short_at"))
    slots = slots.join(short, "sid", "left")
    whole = F.expr(f"if(short, {last}, block_size)")
    before = F.expr(f"block_size * position - if(coalesce(short_at < position, false), block_size - ({last}), 0)")
    rest = F.greatest(F.lit(0), F.least(whole, F.expr("wanted % source_size") - before))
    return slots.withColumn("words", F.when(F.col("final"), rest).otherwise(whole).cast("long")).where("words > 0")


def mix(documents: DataFrame, spec: MixSpec = MixSpec()) -> Mix:
    counted = written(sized(documents), "mix_sizes")
    sizes = counted.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_documents"))
    sources = with_targets(sizes, spec).withColumn("n_blocks", F.ceil(F.col("source_size") / spec.block_words))
    sources = sources.withColumn("wanted", F.round("target").cast("long"))
    # Whole passes, then blocks for the words that are left, and one more if the short block is among them.
    passes, rest = F.expr("wanted div greatest(source_size, 1)"), F.expr("wanted % greatest(source_size, 1)")
    more = F.when(rest > 0, F.least(F.col("n_blocks"), F.ceil(rest / spec.block_words) + 1)).otherwise(0)
    sources = written(sources.withColumn("quota", (passes * F.col("n_blocks") + more).cast("long")), "mix_sources")
    n_slots = sources.agg(F.sum("quota")).first()[0] or 0
    return Mix(_placed(counted, sources, spec), sources, _slots(sources, max(1, n_slots), spec), spec)


# --- results ----------------------------------------------------------------------------------------------------------


def _pieces(documents: DataFrame, spec: MixSpec, *columns: str) -> DataFrame:
    """The part of every document in each of its blocks: ``start`` and ``words`` inside the document."""
    size = spec.block_words
    blocks = F.sequence(F.expr(f"offset div {size}"), F.expr(f"(offset + size - 1) div {size}"))
    rows = documents.where("size > 0").select("sid", "offset", "size", *columns, F.explode(blocks).alias("block"))
    start = F.greatest(F.col("block") * size - F.col("offset"), F.lit(0))
    end = F.least((F.col("block") + 1) * size - F.col("offset"), F.col("size"))
    return rows.withColumn("start", start).withColumn("words", end - start)


def words_taken(mixed: Mix) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` for every document."""
    documents = written(mixed.documents, "mix_placed")
    size = mixed.spec.block_words
    # A block is taken in part at most once: by the last slot of its source.
    blocks = mixed.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"), F.min("words").alias("least"), F.max("words").alias("most"))
    pieces = _pieces(documents, mixed.spec).withColumn("at", F.expr(f"offset + start - block * {size}"))
    pieces = pieces.select("sid", "offset", "block", "words", "at").join(blocks, ["sid", "block"])
    in_part = F.greatest(F.lit(0), F.least("words", F.col("least") - F.col("at")))
    whole = F.greatest(F.lit(0), F.least("words", F.col("most") - F.col("at")))
    used = whole * (F.col("uses") - 1) + in_part
    taken = pieces.groupBy("sid", "offset").agg(F.sum(used).alias("taken"), F.lit(1).cast("long").alias("full"))
    # Documents without words share their offset with the next one; they must not get its words.
    rows = documents.withColumn("full", (F.col("size") > 0).cast("long"))
    rows = rows.join(taken, ["sid", "offset", "full"], "left")
    of_source = mixed.sources.select("sid", "source_size", "target", F.col("n_documents").alias("n"))
    joined = skew_join(rows, of_source.drop("n"), ["sid"], counted=of_source.select("sid", "n"))
    return joined.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_blocks(documents: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mix itself: ``shard``, ``source``, ``block`` and ``words`` (at most ``block_words``) of every slot."""
    plan = mix(documents, spec)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    texts = documents.select(
        F.struct("doc_id", F.xxhash64("doc_id", "source", "text").alias("tie")).alias("row"), words.alias("all_words")
    ).dropDuplicates(["row"])
    counted = sized(documents)  # placed() drops the tie, so it is placed again with the row in a struct
    rows = counted.withColumn("doc_id", F.struct("doc_id", "tie"))
    placed = _placed(written(rows, "mix_rows"), plan.sources, spec).withColumnRenamed("doc_id", "row")
    pieces = _pieces(placed.join(texts, "row"), spec, "all_words")
    piece = F.slice("all_words", (F.col("start") + 1).cast("int"), F.col("words").cast("int"))
    blocks = pieces.select("sid", "block", F.struct("offset", piece.alias("words")).alias("piece"))
    blocks = blocks.groupBy("sid", "block").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    blocks = blocks.select("sid", "block", F.flatten(F.col("pieces.words")).alias("all_words"))
    slots = plan.slots.join(blocks, ["sid", "block"]).join(plan.sources.select("sid", "source"), "sid")
    return slots.select("shard", "source", "block", F.slice("all_words", F.lit(1), F.col("words").cast("int")).alias("words"))
