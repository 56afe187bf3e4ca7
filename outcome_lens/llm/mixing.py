"""Operator 6: mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

The documents of a source are dealt to shards by a hash, and each shard's documents, in a seeded order,
are one stream of words cut into equal blocks. Sources, and then the shards of a source, get whole numbers of blocks by
highest quotients ``votes / (2 k - 1)``. A shard's quota is so many whole rounds of its stream, and a seeded run of
blocks for the rest; since the order is random, the run is a random choice that cuts few documents.
Streams are bounded by the size of a shard, so a source with a third of all rows is many of them.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError
from outcome_lens.llm.common import give_back, whole_text
from outcome_lens.session import stored

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in code point order, repeating
MOST = 3  # times its size that a source or document may give
BLOCK_WORDS = 64
SHARD_DOCS = 4096
MAX_SOURCES = 1_000_000  # a plan has one row a source on the driver; more is an error


def targets(sizes: list[int], weights: tuple[float, ...], most: float = MOST) -> list[float]:
    """What each source gives: shares of the total by weight, at most ``most`` sizes, the excess shared anew."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    total, open_ = float(sum(sizes)), set(range(len(sizes)))
    while open_:
        unit = total / sum(weight[i] for i in open_)
        full = {i for i in open_ if weight[i] * unit > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = weight[i] * unit
            break
        for i in full:
            out[i] = float(most * sizes[i])
        total -= sum(out[i] for i in full)
        open_ -= full
    return out


def seats(votes: list[float], number: int) -> list[int]:
    """Sainte-Laguë: the ``number`` highest of all quotients ``votes / (2 k - 1)``, counted by party."""
    if not any(votes):
        return [0] * len(votes)
    low, high = 0.0, 2.0 * sum(votes) + 1.0  # a divisor too small, and one large enough
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if sum(int(v / middle + 0.5) for v in votes) > number:
            low = middle
        else:
            high = middle
    out = [int(v / high + 0.5) for v in votes]
    queue = [(-v / (2 * out[i] + 1), i) for i, v in enumerate(votes) if v]
    heapq.heapify(queue)
    for _ in range(number - sum(out)):
        _, i = heapq.heappop(queue)
        out[i] += 1
        heapq.heappush(queue, (-votes[i] / (2 * out[i] + 1), i))
    return out


def _overlap(first: Column, last: Column, start: Column, end: Column) -> Column:
    return F.greatest(F.least(last, end) - F.greatest(first, start), F.lit(0))


def mixing_plan(sizes: DataFrame, weights: tuple[float, ...], block_words: int, seed: int) -> DataFrame:
    """From rows ``source, shard, size``: one row a shard with its source's size and target, the whole rounds
    it gives, and the one or two runs of its words (``run1, end1``, ``0, end2``) that it gives once more."""
    spark = sizes.sparkSession
    shards = stored(
        sizes.groupBy("source", "shard").agg(F.sum("size").alias("words"))
        .withColumn("blocks", F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / block_words))).otherwise(0).cast("long")),
        "mix-shards",
    )
    rows = shards.groupBy("source").agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise AnalysisError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r.source is None, r.source or ""))
    wanted = targets([r.words for r in rows], weights)
    votes = [t / r.words * r.blocks if r.words else 0.0 for t, r in zip(wanted, rows, strict=True)]
    quotas = seats(votes, round(sum(votes)))
    quotas = [min(q, MOST * r.blocks) for q, r in zip(quotas, rows, strict=True)]
    plan = [(r.source, int(r.words), t, t / r.words if r.words else 0.0, q) for r, t, q in zip(rows, wanted, quotas, strict=True)]
    sources = spark.createDataFrame(plan, "source string, source_size long, target double, ratio double, quota long")
    same = shards["source"].eqNullSafe(sources["source"])
    voted = shards.join(sources, same).select(shards["source"], "shard", "words", "blocks", "source_size", "target", "quota", (F.col("ratio") * F.col("blocks")).alias("votes"))
    # seats near the proportional number compete by quotient; those far below are sure
    sure = F.greatest(F.floor("votes") - 1, F.lit(0)).cast("long")
    spare = F.least(F.lit(4), MOST * F.col("blocks") - F.col("sure"))
    own = Window.partitionBy("source")
    contest = (
        voted.withColumn("sure", sure)
        .withColumn("spare", spare)
        .withColumn("left", F.col("quota") - F.sum("sure").over(own))
        .withColumn("k", F.explode(F.when(F.col("spare") > 0, F.sequence(F.lit(1), F.col("spare").cast("int"))).otherwise(F.array(F.lit(0)))))
        .withColumn("quotient", F.when(F.col("k") > 0, F.col("votes") / (2 * (F.col("sure") + F.col("k")) - 1)).otherwise(-1.0))
        .withColumn("place", F.row_number().over(own.orderBy(F.desc("quotient"), "shard", "k")))
    )
    given = contest.groupBy("source", "shard", "words", "blocks", "source_size", "target", "sure").agg(
        F.sum(((F.col("place") <= F.col("left")) & (F.col("k") > 0)).cast("long")).alias("won")
    )
    blocks, offset, rest = F.col("blocks"), F.col("offset"), F.col("rest")
    place = lambda j: j * F.floor(F.col("words") / blocks) + F.least(j, F.col("words") % blocks)
    quota = F.col("sure") + F.col("won")
    return (
        given.withColumn("rounds", F.when(blocks > 0, F.floor(quota / blocks)).otherwise(0).cast("long"))
        .withColumn("rest", quota - F.col("rounds") * blocks)
        .withColumn("offset", F.when(blocks > 0, F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), blocks)).otherwise(0))
        .withColumn("run1", F.when(rest > 0, place(offset)).otherwise(0).cast("long"))
        .withColumn("end1", F.when(rest > 0, place(F.least(offset + rest, blocks))).otherwise(0).cast("long"))
        .withColumn("end2", F.when(rest > 0, place(F.greatest(offset + rest - blocks, F.lit(0)))).otherwise(0).cast("long"))
        .select("source", "shard", "source_size", "target", "rounds", "run1", "end1", "end2")
    )


def with_share(
    docs: DataFrame, keep: list[str], weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = 1
) -> DataFrame:
    """Per row of ``docs``: ``row``, a struct of the columns in ``keep``, and what the mix takes of it.

    ``size`` is the number of words of the whole text (null: 0), ``rounds`` how often all of it is taken,
    ``run1..end1`` and ``0..end2`` are the words of it that are taken once more, ``taken`` is all together.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.struct(F.lit(1).alias("none"))
    size = F.regexp_count(whole_text(), F.lit(WORD)).cast("long")
    based = docs.select(
        row.alias("row"), F.col("source").cast("string").alias("source"), size.alias("size"),
        F.xxhash64(F.lit(seed), "doc_id").alias("turn"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"),
    )
    number = max(1, -(-docs.count() // shard_docs))
    based = based.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "id", "content"), F.lit(number)))
    plan = mixing_plan(based.select("source", "shard", "size"), weights, block_words, seed)
    before = Window.partitionBy("source", "shard").orderBy("turn", "id", "content").rowsBetween(Window.unboundedPreceding, -1)
    rows = based.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).alias("d")
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.shard") == F.col("p.shard"))
    start, end = F.col("start"), F.col("start") + F.col("size")
    part1, part2 = _overlap(F.col("run1"), F.col("end1"), start, end), _overlap(F.lit(0), F.col("end2"), start, end)
    clip = lambda c: F.least(F.greatest(c - start, F.lit(0)), F.col("size"))
    return rows.join(plan.alias("p"), same).select(
        "row", "size", "source_size", "target", "rounds",
        clip(F.col("run1")).alias("run1"), clip(F.col("end1")).alias("end1"), clip(F.col("end2")).alias("end2"),
        (F.col("rounds") * F.col("size") + part1 + part2).alias("taken"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; documents without words give nothing.

    A null source is a source of its own, the last. Repeated rows are documents of their own.
    """
    rows = with_share(docs.select("doc_id", "text", "source"), ["doc_id"], **options)
    return rows.select("row.doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: one row for each time a text, or a run of its words, is taken.

    ``n_chars``, where there is one, is that of the text in the row.
    """
    rows = with_share(docs, docs.columns, **options)
    size = F.col("size")
    runs = F.filter(
        F.array(*(F.struct(a.cast("int").alias("first"), b.cast("int").alias("last")) for a, b in ((F.col("run1"), F.col("end1")), (F.lit(0), F.col("end2"))))),
        lambda r: r["last"] > r["first"],
    )
    whole = F.struct(F.lit(0).alias("first"), size.cast("int").alias("last"))
    parts = F.concat(F.array_repeat(whole, F.when(size > 0, F.col("rounds")).otherwise(0).cast("int")), runs)
    taken = rows.withColumn("part", F.explode(parts))
    cut = (F.col("part.first") > 0) | (F.col("part.last") < size)
    piece = _words_between(F.when(cut, F.col("row.text")), F.col("part.first"), F.col("part.last"))
    out = taken.select("row", piece.alias("piece"))
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == "text":
            value = F.coalesce("piece", value)
        elif name == "n_chars":
            value = F.when(F.col("piece").isNotNull(), F.length("piece").cast("long")).otherwise(value)
        columns.append(value.alias(name))
    return out.select(*columns)


def _words_between(text: Column, first: Column, last: Column) -> Column:
    """The text from one of its words up to another; null for null."""
    pattern = re.compile("[^\x20\x09-\x0d]+")

    def between(text: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        out = []
        for one, a, b in zip(text.to_pylist(), first.to_pylist(), last.to_pylist(), strict=True):
            places = [m.span() for m in pattern.finditer(one)][a:b] if one is not None else []
            out.append(one[places[0][0] : places[-1][1]] if places else None)
        found = pa.array(out, pa.string())
        del out
        give_back()
        return found

    return F.arrow_udf(between, "string")(text, first, last)
