"""Operator 3: near-duplicates by BagMinHash over word shingles with their multiplicities.

Every shingle is a set of Poisson processes over its weight: weights are discretised into levels
[0, 1), [1, 2), [2, 4), [4, 8) ..., each level's process has the rate of its width, and a point in it
counts if the height it falls on is below the weight. A point belongs to a random slot, and a slot keeps the
earliest point: two texts agree in a slot with the probability of their weighted Jaccard similarity.
Points are drawn in order of time up to a limit at which every slot is expected to be filled.

Signatures are cut into bands. Equal texts are one node. In every bucket of a band the other texts
are compared with its smallest one by exact multiset overlap. Where texts do not end in its class, the most central text of
the bucket is compared too, and after that only pairs of different classes that exact bounds leave in reach of a link. So
links in a bucket come from its members times its classes, not from all pairs.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outcome_lens.llm.common import stored_alone, texts, thrifty
from outcome_lens.llm.shingles import U, mixed, multisets
from outcome_lens.session import stored

SHINGLE = 5  # words
SIMILARITY = 0.8
BANDS, ROWS = 20, 6
BATCH_BYTES = 1 << 20  # text that is hashed at once
PAIRS_AT_ONCE = 256  # whose texts are unpacked from a batch
OUTLINE_BITS = 2048  # of a text that is compared late
CACHED_BYTES = 16 << 20  # of multisets that a verifying task keeps


def draws(seeds: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent uniform numbers in (0, 1) a seed for the ``turn``-th point."""
    first = mixed(seeds + U((turn * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
    second = mixed(first ^ U(0xD6E8FEB86659FD93))
    return ((first >> U(11)).astype(np.float64) + 0.5) * 2.0**-53, ((second >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, number: int, slots: int) -> np.ndarray:
    """The earliest point of each slot for each of ``number`` multisets; infinite for empty ones."""
    out = np.full((number, slots), np.inf)
    total = np.bincount(owner, weights, number)
    levels = np.where(weights > 1, 1 + np.ceil(np.log2(np.maximum(weights, 1))), 1).astype(np.int64)
    unit = np.repeat(np.arange(len(hashes)), levels)
    level = np.arange(len(unit)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1.0, low)
    seeds = mixed(hashes[unit] ^ mixed(level.astype(np.uint64) + U(77)))
    whose, most = owner[unit], weights[unit].astype(np.float64)
    reach, wanted = math.log(slots) + 3, total > 0
    while wanted.any():
        limit = np.where(wanted, reach * slots / np.maximum(total, 1), -1.0)
        active = np.flatnonzero(wanted[whose])
        time, turn = np.zeros(len(active)), 0
        while len(active):
            a, b = draws(seeds[active], 2 * turn)
            time = time - np.log(a) / width[active]
            kept = time <= limit[whose[active]]
            active, time, b = active[kept], time[kept], b[kept]
            height, _ = draws(seeds[active], 2 * turn + 1)
            counts = low[active] + height * width[active] < most[active]
            place = whose[active[counts]] * slots + (b[counts] * slots).astype(np.int64)
            np.minimum.at(out.reshape(-1), place, time[counts])
            turn += 1
        wanted = wanted & np.isinf(out).any(axis=1)
        reach *= 2
    return out


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash a band, different for each band's number."""
    parts = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) + U(1), parts.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out * U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return out.view(np.int64)


def in_parts(rows: list[str], most: int = BATCH_BYTES):
    """Slices of a list of texts of about ``most`` characters, a long text being one alone."""
    start = held = 0
    for at, text in enumerate(rows):
        if at > start and held + len(text) > most:
            yield start, at
            start, held = at, 0
        held += len(text)
    if start < len(rows):
        yield start, len(rows)


def column_parts(texts: pa.Array, most: int = BATCH_BYTES):
    """``in_parts`` of a column of texts, by bytes, without unpacking it."""
    upto = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        yield start, stop
        start = stop


def with_bands(rows: DataFrame, bands: int, rows_per_band: int, shingle: int) -> DataFrame:
    """``doc_id, node, text`` with the band values of the text instead of it; null for texts without words."""

    def sign(batches):
        for batch in batches:
            ids, nodes, bodies = batch.columns
            for a, b in column_parts(bodies):
                some = bodies.slice(a, b - a).to_pylist()
                hashes, weights, owner = multisets(some, shingle)
                found = band_values(signatures(hashes, weights, owner, b - a, bands * rows_per_band), bands, rows_per_band)
                has = np.bincount(owner, minlength=b - a) > 0
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), bands).cast(pa.list_(pa.int64()))
                lists = pa.array([v if h else None for v, h in zip(lists.to_pylist(), has, strict=True)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), nodes.slice(a, b - a), lists], names=["doc_id", "node", "bands"])

    return rows.mapInArrow(thrifty(sign), "doc_id long, node binary, bands array<long>")


def similarities(pairs: DataFrame, bodies: DataFrame, shingle: int) -> DataFrame:
    """``a, b, similarity`` of ``pairs`` (``a, b``): exact weighted Jaccard of the shingles of two texts."""

    def compare(batches):
        known: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        held = 0

        def multiset(node: bytes, text: str):
            nonlocal held
            if node not in known:
                hashes, counts, _ = multisets([text], shingle)
                known[node] = hashes, counts
                held += hashes.nbytes + counts.nbytes
                while held > CACHED_BYTES and len(known) > 2:
                    _, (old, times) = known.popitem(last=False)
                    held -= old.nbytes + times.nbytes
            known.move_to_end(node)
            return known[node]

        for batch in (whole.slice(at, PAIRS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, PAIRS_AT_ONCE)):
            found = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (ha, na), (hb, nb) = multiset(a, text_a), multiset(b, text_b)
                _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
                both = int(np.minimum(na[ia], nb[ib]).sum())
                found.append(both / max(1, int(na.sum()) + int(nb.sum()) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    left = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(thrifty(compare), "a binary, b binary, similarity double")


def classes(links: DataFrame) -> DataFrame:
    """``node, root`` for every linked node, the root being the smallest node of its class.

    Alternates two steps until nothing changes: larger neighbours go to the smallest neighbour, then
    smaller ones do. Each step is a minimum by node and a join; no class is gathered anywhere. What a round has shuffled
    goes when its edges are written, and its few rows are read by few tasks.
    """
    edges = stored_alone(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "near-edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored_alone(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "near-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def node_classes(docs: DataFrame, similarity: float, bands: int, rows_per_band: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``doc_id, node`` of every row (a node is a text), and ``node, root`` of the linked nodes."""
    rows = texts(docs).select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")
    signed = stored(with_bands(rows, bands, rows_per_band, shingle), "near-signatures")
    nodes = signed.filter("bands is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(buckets.join(heads, "bucket"), "near-buckets")
    first = members.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    # the texts of nodes in buckets, once each
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    has = wanted.select("node", F.col("doc_id").alias("first_id"))
    bodies = rows.join(has, "node").filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "text").dropDuplicates(["node"])
    bodies = stored(bodies, "near-texts")
    compared = stored(similarities(first, bodies, shingle), "near-compared")
    links = compared.filter(F.col("similarity") >= similarity).select("a", "b")
    linked = classes(links)
    # buckets in which a member is not in the class of the head it was compared with
    rooted = with_roots(members, linked)
    open_ = rooted.filter("root <> head_root").select("bucket").distinct()
    open_ = stored(rooted.join(open_, "bucket").select("bucket", "node", "root"), "near-open")
    if not open_.isEmpty():
        # classes that are known already go in as stars
        stars = linked.select(F.col("node").alias("a"), F.col("root").alias("b"))
        linked = classes(stars.union(late_links(open_, linked, bodies, similarity, shingle)))
    return signed.select("doc_id", "node"), linked


def with_roots(members: DataFrame, linked: DataFrame) -> DataFrame:
    """``bucket, node, head`` with the roots of both; a node without links is its own root."""
    root = lambda name: linked.select(F.col("node").alias(name), F.col("root").alias(f"{name}_linked"))
    out = members.select("bucket", "node", "head").join(root("node"), "node", "left").join(root("head"), "head", "left")
    return out.select("bucket", "node", "head", F.coalesce("node_linked", "node").alias("root"), F.coalesce("head_linked", "head").alias("head_root"))


def lonely_shingles(nodes: DataFrame, bodies: DataFrame, shingle: int) -> DataFrame:
    """``node, size, alone``: shingles of each text, and how many of them no other text of ``nodes`` has."""

    def spread(batches):
        for batch in batches:
            keys, bodies = batch.columns
            for a, b in column_parts(bodies):
                hashes, weights, owner = multisets(bodies.slice(a, b - a).to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a).take(pa.array(owner)), pa.array(hashes.view(np.int64)), pa.array(weights.astype(np.int64))],
                    names=["node", "hash", "weight"],
                )

    rows = bodies.join(nodes, "node").select("node", "text").mapInArrow(thrifty(spread), "node binary, hash long, weight long")
    rows = stored(rows, "near-shingles")
    once = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight")).filter("n = 1")
    alone = once.groupBy("node").agg(F.sum("weight").alias("alone"))
    sizes = rows.groupBy("node").agg(F.sum("weight").alias("size"))
    return sizes.join(alone, "node", "left").select("node", "size", F.coalesce("alone", F.lit(0)).alias("alone"))


def outlines(nodes: DataFrame, bodies: DataFrame, shingle: int) -> DataFrame:
    """``node, outline``: a bit is set where any shingle of the text falls by its hash, as ``OUTLINE_BITS`` bits in longs.

    Shingles in a cell where another text has none are not in that text: two texts differ in as many shingles at least
    as their outlines differ in bits. Long texts fill their outlines, and then the bound says less, but stays right.
    """

    def draw(batches):
        for batch in batches:
            keys, bodies = batch.columns
            for a, b in column_parts(bodies):
                hashes, _, owner = multisets(bodies.slice(a, b - a).to_pylist(), shingle)
                cells = np.zeros((b - a, OUTLINE_BITS), bool)
                cells[owner, (hashes >> U(20)) % U(OUTLINE_BITS)] = True
                longs = np.packbits(cells, axis=1).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(longs.reshape(-1)), longs.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), lists], names=["node", "outline"])

    return bodies.join(nodes, "node").select("node", "text").mapInArrow(thrifty(draw), "node binary, outline array<long>")


def late_links(open_: DataFrame, linked: DataFrame, bodies: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Links ``a, b`` inside the buckets of ``open_`` (``bucket, node, root``) between texts of different classes.

    A shingle that one text alone has cannot be shared: two texts overlap in at most what each has besides. Texts that
    can reach no other by this bound are done. Of the rest, the text with the smallest share
    of such shingles, the most central one, is compared with all others of its bucket. What is still in another class
    then meets those texts of the bucket that the bound, the triangle inequality and the outlines leave in reach.
    """
    facts = lonely_shingles(open_.select("node").distinct(), bodies, shingle)
    able = open_.join(facts.filter(F.col("size") - F.col("alone") >= similarity * F.col("size")), "node")
    able = stored(able.select("bucket", "node", "size", "alone", "root"), "near-able")
    central = able.groupBy("bucket").agg(F.min(F.struct((F.col("alone") / F.col("size")).alias("share"), F.col("node"), F.col("root"))).alias("c"))
    central = central.select("bucket", F.col("c.node").alias("head"), F.col("c.root").alias("head_root"))
    led = stored(able.join(central, "bucket"), "near-led")
    pair = (F.greatest("node", "head").alias("a"), F.least("node", "head").alias("b"))
    met = stored(similarities(led.filter("root <> head_root").select(*pair).distinct(), bodies, shingle), "near-met")
    links = met.filter(F.col("similarity") >= similarity).select("a", "b")
    stars = linked.select(F.col("node").alias("a"), F.col("root").alias("b"))
    rooted = with_roots(led, classes(stars.union(links)))
    gaps = met.select("a", "b", (1 - F.col("similarity")).alias("gap"))
    known = led.select("bucket", "node", "size", "alone", *pair).join(gaps, ["a", "b"], "left").select("bucket", "node", "size", "alone", "gap")
    known = known.join(rooted, ["bucket", "node"])
    known = known.join(known.filter("root <> head_root").select("bucket").distinct(), "bucket")
    drawn = stored(outlines(known.select("node").distinct(), bodies, shingle), "near-outlines")
    known = stored(known.join(drawn, "node"), "near-known")
    x = known.filter("root <> head_root").select("bucket", *(F.col(c).alias(f"x_{c}") for c in ("node", "size", "alone", "gap", "root", "outline")))
    most = F.least(F.col("size") - F.col("alone"), F.col("x_size") - F.col("x_alone"))
    in_reach = most >= similarity * (F.col("size") + F.col("x_size") - most)
    near = F.coalesce(F.abs(F.col("x_gap") - F.col("gap")) <= 1 - similarity + 1e-9, F.lit(True))
    differ = sum((F.bit_count(F.col("outline")[k].bitwiseXOR(F.col("x_outline")[k])) for k in range(OUTLINE_BITS // 64)), F.lit(0))
    both = F.col("size") + F.col("x_size")
    alike = both - differ + 1e-6 >= similarity * (both + differ)
    rest = x.join(known, "bucket").filter((F.col("x_root") != F.col("root")) & in_reach & near & alike)
    rest = rest.select(F.greatest("x_node", "node").alias("a"), F.least("x_node", "node").alias("b")).distinct()
    more = similarities(rest, bodies, shingle).filter(F.col("similarity") >= similarity).select("a", "b")
    return links.union(stored(more, "near-more"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows_per_band: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest ``doc_id`` of its class of linked texts.

    Equal texts are one class, null being the empty text. Texts without words are linked to equal ones only. Rows
    without an id get a class like others; a class without any id has a null ``class_id``.
    """
    rows, linked = node_classes(docs, similarity, bands, rows_per_band, shingle)
    rooted = rows.join(linked, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rooted.join(smallest, "root").select("doc_id", "class_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows_per_band: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """The row of ``docs`` with the smallest ``doc_id`` of each class; rows without an id only where no other has one."""
    rows, linked = node_classes(docs, similarity, bands, rows_per_band, shingle)
    rooted = rows.join(linked, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("node"))).alias("w")
    winners = rooted.groupBy("root").agg(winner).select(F.col("w.node").alias("win_node"), F.col("w.doc_id").alias("win_id"))
    packed = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("node"))
    kept = packed.join(winners, F.col("node") == F.col("win_node"))
    kept = kept.filter(F.col("row.doc_id").eqNullSafe(F.col("win_id")))
    turn = Window.partitionBy("node").orderBy(F.xxhash64("row"))
    return kept.withColumn("turn", F.row_number().over(turn)).filter("turn = 1").select("row.*")
