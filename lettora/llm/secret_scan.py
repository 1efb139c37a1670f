"""Incremental secret scan over a history of files; DataFrame and SQL functions only.

Every version of every path is addressed by the SHA-256 of its content (its blob). A ledger remembers which pairs of blob
and rule version were scanned, and what was found. A scan takes one text per blob that has an unseen pair, runs only the
unseen rules over it, and joins the findings of all blobs back to all paths that hold them. Copies are combined before
the shuffle; the blob that a third of all rows share is split when findings are joined back (``skew_join``).

Spark has no function for the places of all matches. Splitting a text at the pattern gives the gaps between the matches;
lengths of gaps and matches, summed in order, are the places. Lengths are code points, as SQL counts them.

Defined cases: a NULL text is the empty blob. Rows that repeat a path, or have none, are versions of their own and each
return a row. Texts of any length and any number of matches are scanned whole. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettora.operators.skew import skew_join
from lettora.sources.shared import fresh_path, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` with the value in ``group``; a match whose value has fewer than ``min_chars`` is no finding."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    version: int = 1
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))

#: Up to so many unseen blobs (of 32 bytes each) are sent to all tasks.
BROADCAST_BLOBS = 1_000_000

#: The order of the rules is the order of findings that start at the same place. For runs of one class of characters the
#: least length is part of the pattern, which finds the same runs and skips short ones faster.
RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", base=False),
    Rule("bearer", r"(?:gh[pousr]_|xox[abprs]-|glpat-)[A-Za-z0-9_-]{20,}", base=False),
)


@dataclass(frozen=True)
class Ledger:
    """``pairs``: blob, rule; ``findings``: blob, rule, kind, start, end (exclusive), in code points."""

    pairs: DataFrame
    findings: DataFrame

    def save(self, path: str) -> None:
        """Store the ledger in the folder ``path``, for scans of later sessions."""
        self.pairs.write.parquet(f"{path}/pairs")
        self.findings.write.parquet(f"{path}/findings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ledger:
        return Ledger(spark.read.parquet(f"{path}/pairs"), spark.read.parquet(f"{path}/findings"))

    def union(self, other: Ledger) -> Ledger:
        return Ledger(self.pairs.unionByName(other.pairs), self.findings.unionByName(other.findings))


def versions(history: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """``path`` and ``blob`` of every row."""
    return history.select(F.col(path).alias("path"), F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("blob"))


def _matches(rule: Rule, wanted: Column) -> Column:
    """Lengths of matches and of the gaps before them, and whether the value is long enough."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    gaps = F.split("text", rule.pattern, -1)
    value = lambda m: F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m
    pieces = F.zip_with(
        found,
        F.slice(gaps, F.lit(1), F.size(found)),
        lambda m, gap: F.struct(
            F.length(gap).alias("gap"), F.length(m).alias("length"), (F.length(value(m)) >= rule.min_chars).alias("kept")
        ),
    )
    # Texts without a match, nearly all, are not split.
    pieces = F.when(wanted & F.col("text").rlike(rule.pattern), pieces)
    return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), pieces.alias("pieces"))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in distinct blobs (``blob``, ``text``, and ``unseen``, the names of the rules to run)."""
    matched = F.array(*(_matches(rule, F.array_contains("unseen", rule.name)) for rule in rules))
    rows = blobs.select("blob", F.explode(matched).alias("m")).where("m.pieces is not null")
    rows = rows.select("blob", "m.rule", "m.kind", F.posexplode("m.pieces").alias("at", "piece"))
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("piece.gap") + F.col("piece.length")).over(upto)
    rows = rows.withColumn("end", end).where("piece.kept")
    return rows.select("blob", "rule", "kind", (F.col("end") - F.col("piece.length")).alias("start"), "end")


def scan(
    history: DataFrame,
    ledger: Ledger | None = None,
    rules: tuple[Rule, ...] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, Ledger]:
    """Findings of every row of ``history``, and the ledger with what this scan added.

    The findings have ``path``, ``blob`` and ``found``: an array of kind, start and end, in the order of start and rule.
    """
    placed = written(versions(history, path, text), "versions")
    names = [rule.name for rule in rules]
    every = F.array(*map(F.lit, names))
    content = F.coalesce(text, F.lit(""))
    texts = history.select(F.unhex(F.sha2(content, 256)).alias("blob"), content.alias("text"))
    if ledger is not None:
        seen = ledger.pairs.where(F.col("rule").isin(names)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = placed.select("blob").distinct().join(seen, "blob", "left")
        unseen = unseen.withColumn("unseen", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
        unseen = written(unseen.where(F.size("unseen") > 0).select("blob", "unseen"), "unseen")
        if unseen.count() <= BROADCAST_BLOBS:
            # Texts of blobs that are done go before they are combined and shuffled. Of a longer list, copies are
            # combined first, and the list is joined to what is left of them.
            texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
    blobs = texts.groupBy("blob").agg(F.any_value("text").alias("text"))
    blobs = blobs.withColumn("unseen", every) if ledger is None else blobs.join(unseen, "blob")
    findings = written(scan_blobs(blobs, rules), "findings")
    pairs = placed.select("blob").distinct().withColumn("unseen", every) if ledger is None else unseen
    added = Ledger(written(pairs.select("blob", F.explode("unseen").alias("rule")), "pairs"), findings)
    whole = added if ledger is None else ledger.union(added)

    rank = F.create_map(*(F.lit(x) for k, rule in enumerate(rules) for x in (rule.kind, k)))
    span = F.struct("start", F.element_at(rank, F.col("kind")).alias("rank"), "kind", "end")
    found = whole.findings.where(F.col("rule").isin(names)).groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("found"))
    counted = placed.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    joined = skew_join(placed, found, ["blob"], "left", counted=counted)
    empty = F.array().cast(found.schema["found"].dataType)
    return joined.select("path", "blob", F.coalesce("found", empty).alias("found")), whole


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _number_of(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind))


def secret_digest(history: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``doc_id``, the number of findings of each base rule, the SHA-256 of their list, and the list of all findings.

    The history comes in two scans, as it does to one that is kept up: half of the blobs by hash, whose ledger is stored
    and loaded again, then all rows, of which only the other half is still unseen.
    """
    earlier = history.where(F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(2)) == 0)
    path = fresh_path(history.sparkSession, "ledger")
    scan(earlier, None, rules, text=text)[1].save(path)
    found, _ = scan(history, Ledger.load(history.sparkSession, path), rules, text=text)
    base = [rule.kind for rule in rules if rule.base]
    counts = [_number_of(kind).cast("long").alias(f"n_{kind}") for kind in base]
    of_base = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )
