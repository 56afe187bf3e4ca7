"""Operator 12: tokens of two tokenizers over the same bytes, aligned by interval coalescing.

Tokens are byte intervals. All tokens of both sides are sorted by start, the running maximum of their ends is
accumulated, and a group ends where a start reaches that maximum; inside groups, overlapping pairs are expanded from sorted
starts and ends. This happens on the distinct pieces of a batch of texts (see ``pieces``): both sides have a border between
pieces, so a text's alignment is that of its pieces in order.

Tokens that end together are linked. The bytes of one of them then end with those of the other, so that the two vocabularies
bound the pairs that can ever be linked; they are numbered on the driver, and counts per pair are small arrays however
many documents there are.

A text that is null or empty, or whose bytes a side does not give back, has no tokens. Every row is one document:
repeated rows count each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import texts
from outcome_lens.llm.pieces import ByteTokenizer, PieceTokenizer, cut, encoded, ranges, sums
from outcome_lens.session import stored

BATCH_BYTES = 3 << 19  # of text that is aligned at a time; one longer text is a batch of its own
COUNTS = "n_a long, n_b long, n_groups long, n_links long"


class Coalesced(NamedTuple):
    """Groups of both sides' tokens, and the overlapping pairs."""

    group_a: np.ndarray  # the group of each token
    group_b: np.ndarray
    pair_a: np.ndarray  # the token on each side of each overlap
    pair_b: np.ndarray
    together: np.ndarray  # whether the two end together


def coalesced(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Coalesced:
    """Align two rows of tokens, given by their lengths in bytes, that cover the same bytes."""
    end_a, end_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    start_a, start_b = end_a - sizes_a, end_b - sizes_b
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    furthest = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= furthest[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    low, high = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    pair_a, pair_b = np.repeat(np.arange(len(end_a)), high - low), ranges(low, high - low)
    return Coalesced(group[: len(end_a)], group[len(end_a) :], pair_a, pair_b, end_a[pair_a] == end_b[pair_b])


class PossibleLinks:
    """All pairs of ids of which one's bytes end with the other's, as sorted codes; a pair's number is its place."""

    def __init__(self, codes: np.ndarray, width: int):
        self.codes, self.width = codes, width

    @classmethod
    def of(cls, a: list[bytes], b: list[bytes]) -> PossibleLinks:
        width = len(b)
        found: set[int] = set()
        for own, other, code in ((a, b, lambda i, j: i * width + j), (b, a, lambda i, j: j * width + i)):
            ids_of: dict[bytes, list[int]] = {}
            for j, raw in enumerate(other):
                ids_of.setdefault(raw, []).append(j)
            for i, raw in enumerate(own):
                for at in range(len(raw)):
                    found.update(code(i, j) for j in ids_of.get(raw[at:], ()))
        return cls(np.sort(np.fromiter(found, np.int64, len(found))), width)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.codes, a.astype(np.int64) * self.width + b)

    def second(self) -> np.ndarray:
        """The id on the second side of every pair."""
        return self.codes % self.width


def given_back(tokenizer: ByteTokenizer | PieceTokenizer, ids: np.ndarray, counts: np.ndarray, whole: list[bytes]) -> np.ndarray:
    """Which pieces consist of the bytes of their tokens."""
    right = sums(tokenizer.sizes[ids], counts) == np.array([len(w) for w in whole], np.int64)
    raw = tokenizer.bytes
    if right.all() and b"".join([raw[i] for i in ids.tolist()]) == b"".join(whole):
        return right
    ends = np.cumsum(counts)
    return np.array([b"".join([raw[i] for i in ids[e - n : e].tolist()]) == w for e, n, w in zip(ends, counts, whole, strict=True)], bool)


class AlignedBatch:
    """The alignment of some texts: arrays over their distinct pieces, and which pieces each text has."""

    def __init__(self, bodies: list[str], a: ByteTokenizer, b: PieceTokenizer):
        self.pieces, self.counts, distinct = cut(bodies)
        (self.ids_a, self.n_a), (self.ids_b, self.n_b) = encoded(a, distinct), encoded(b, distinct)
        whole = [b" " + p.encode() for p in distinct]
        good = given_back(a, self.ids_a, self.n_a, whole) & given_back(b, self.ids_b, self.n_b, whole)
        bad_texts = sums((~good)[self.pieces].astype(np.int64), self.counts) > 0
        # pieces that are not given back take part in nothing, nor do texts that have one
        self.ids_a = self.ids_a[np.repeat(good, self.n_a)]
        self.ids_b = self.ids_b[np.repeat(good, self.n_b)]
        self.n_a, self.n_b = np.where(good, self.n_a, 0), np.where(good, self.n_b, 0)
        self.pieces = self.pieces[np.repeat(~bad_texts, self.counts)]
        self.counts = np.where(bad_texts, 0, self.counts)
        found = coalesced(a.sizes[self.ids_a], b.sizes[self.ids_b])
        # groups never cross a border between pieces
        groups = int(found.group_a[-1]) + 1 if len(found.group_a) else 0
        piece_of_a = np.repeat(np.arange(len(distinct)), self.n_a)
        self.size_a, self.size_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
        first = np.cumsum(self.size_a) - self.size_a
        self.n_groups = np.bincount(piece_of_a[first], minlength=len(distinct))
        self.link_a, self.link_b = found.pair_a[found.together], found.pair_b[found.together]
        self.n_links = np.bincount(piece_of_a[self.link_a], minlength=len(distinct))

    def totals(self) -> list[np.ndarray]:
        """Per text the numbers of tokens of both sides, of groups and of links."""
        return [sums(n[self.pieces], self.counts) for n in (self.n_a, self.n_b, self.n_groups, self.n_links)]

    def lists(self, values: np.ndarray, per_piece: np.ndarray) -> pa.Array:
        """Lists per text of values that each piece has ``per_piece`` of."""
        begins = np.cumsum(per_piece) - per_piece
        flat = values[ranges(begins[self.pieces], per_piece[self.pieces])]
        offsets = np.concatenate([[0], np.cumsum(sums(per_piece[self.pieces], self.counts))])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))

    def links(self, possible: PossibleLinks) -> pa.Array:
        return self.lists(possible.numbers(self.ids_a[self.link_a], self.ids_b[self.link_b]), self.n_links)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, written ``a1,a2|b1;a3|b2,b3``; empty for a text without tokens."""
        names = [str(i) for i in range(1 + max([0, *map(int, (x.max() for x in (self.ids_a, self.ids_b) if len(x)))]))]
        a, b = [names[i] for i in self.ids_a.tolist()], [names[i] for i in self.ids_b.tolist()]
        groups, at_a, at_b = [], 0, 0
        for m, n in zip(self.size_a.tolist(), self.size_b.tolist(), strict=True):
            groups.append(f"{a[at_a]}|{b[at_b]}" if m == n == 1 else ",".join(a[at_a : at_a + m]) + "|" + ",".join(b[at_b : at_b + n]))
            at_a, at_b = at_a + m, at_b + n
        ends = np.cumsum(self.n_groups).tolist()
        written = [";".join(groups[e - n : e]) for e, n in zip(ends, self.n_groups.tolist(), strict=True)]
        out, at = [], 0
        for n in self.counts.tolist():
            own = self.pieces[at : at + n].tolist()
            out.append(hashlib.sha256(";".join([written[i] for i in own]).encode()).hexdigest() if n else "")
            at += n
        return out


def aligned_batches(batches, path_a: str, path_b: str) -> Iterator[tuple[pa.Array, AlignedBatch]]:
    """Ids of documents and their alignments, a bounded number of bytes at a time."""
    a, b = ByteTokenizer(path_a), PieceTokenizer(path_b)
    for batch in batches:
        sizes = np.cumsum(np.asarray(pa.compute.binary_length(batch.column(1)), np.int64))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES, "right"))
            some = batch.slice(at, max(upto, at + 1) - at)
            yield some.column(0), AlignedBatch(some.column(1).to_pylist(), a, b)
            at += some.num_rows


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_per_group, b_per_group``: the tokens of both sides, and how many each group has of them."""

    def align(batches):
        for ids, found in aligned_batches(batches, path_a, path_b):
            columns = [(found.ids_a, found.n_a), (found.ids_b, found.n_b), (found.size_a, found.n_groups), (found.size_b, found.n_groups)]
            yield pa.RecordBatch.from_arrays([ids, *(found.lists(*c) for c in columns)], names=["doc_id", "a_ids", "b_ids", "a_per_group", "b_per_group"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInArrow(align, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_per_group array<int>, b_per_group array<int>")


def link_counts(linked: DataFrame, number: int) -> np.ndarray:
    """How often each of the ``number`` possible pairs is linked in all documents together."""

    def count(batches):
        total = np.zeros(number, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=number)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    found = linked.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(number, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``n_best`` counts links whose pair is, in all documents together, the commonest of its second id, ``count_sum`` adds up
    how often the linked pairs are linked in all documents.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    possible = PossibleLinks.of(ByteTokenizer(path_a).bytes, PieceTokenizer(path_b).bytes)
    shared = spark.sparkContext.broadcast(possible)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]

    def align(batches):
        for ids, found in aligned_batches(batches, path_a, path_b):
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, found.totals()), pa.array(found.digests(), pa.string()), found.links(shared.value)], names=names)

    linked = stored(texts(docs).mapInArrow(align, f"doc_id {kind}, {COUNTS}, groups_sha256 string, links array<int>"), "alignments")
    counts = link_counts(linked, len(possible.codes))
    highest = np.zeros(possible.width, np.int64)
    np.maximum.at(highest, possible.second(), counts)
    weights = spark.sparkContext.broadcast((counts, counts == highest[possible.second()]))

    def weigh(batches):
        counts, best = weights.value
        for batch in batches:
            links = batch.column("links")
            sizes, flat = np.asarray(links.value_lengths(), np.int64), np.asarray(links.flatten())
            own = [sums(best[flat].astype(np.int64), sizes), sums(counts[flat], sizes)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:-2]), *map(pa.array, own), batch.column("groups_sha256")], names=[*names[:-2], "n_best", "count_sum", "groups_sha256"])

    return linked.mapInArrow(weigh, f"doc_id {kind}, {COUNTS}, n_best long, count_sum long, groups_sha256 string")
