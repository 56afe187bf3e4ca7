"""Operator 5: token ids as ORC files, sorted by document, and what a reader learns from the files.

Each file covers a range of document ids and holds its rows in ascending order: ORC keeps ids in
run-length coded integer streams, row indexes give the smallest and largest ``doc_id`` of every few
thousand rows, and a Bloom filter on ``doc_id`` prunes stripes for single lookups. Stripes are small
enough that several tasks share a file. A row carries the number of ids that stand before it in its
file, so global positions need only one total per file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcome_lens.contract import AnalysisError
from outcome_lens.llm.common import texts, thrifty
from outcome_lens.llm.pieces import SIMPLE, WORDS, ByteTokenizer, encoded, joined, ranges, split, unpacked

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
FILE_SCHEMA = "doc_id long, part int, before long, n_tokens int, ids array<int>"
KNOWN_PIECES = 200_000  # words, and pieces that are not cut into words, a worker keeps the ids of, about 50 bytes each
BATCH_BYTES = 2 << 20  # of text that is encoded at a time; one longer text is a batch of its own
SENT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"  # that go to a worker together


class TextEncoder:
    """Ids of texts through the tokenizers library, which sees every distinct word of a batch once, and none that is still known.

    Distinct pieces are cut into words as the library's pre-tokenizer does it; a piece with other characters than those
    that are surely cut alike is taken for one word.
    A text with the string of an added token, such as ``<|endoftext|>``, goes to the library as a whole, since such a token may
    take in what stands around it; so do all texts if the tokenizer is not one that allows a text to be cut.
    """

    def __init__(self, path: str, ends_with: int):
        from tokenizers import Tokenizer

        try:
            self.pieces = ByteTokenizer(path)
            self.whole = self.pieces.tokenizer
        except AnalysisError:
            self.pieces = None
            self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.end = ends_with
        self.known = pa.array([], pa.large_string())  # words, with the space in front if there is one
        self.older = self.known  # those of the half before this one: what is used again comes over
        # the ids of the older and then the known ones, and how many each word has
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def spaced(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pieces behind a space: which entry of a table each is, the ids of the table, and how many an entry has."""
        coded = pieces.dictionary_encode()
        simple = pc.match_substring_regex(coded.dictionary, SIMPLE)
        whole = coded.dictionary.filter(pc.invert(simple))
        inside = WORDS.findall(" " + joined(coded.dictionary.filter(simple), " ")) if len(whole) < len(simple) else []
        words = pa.array(inside + [" " + p for p in unpacked(whole)], pa.large_string())
        # a word with a space in front starts a piece
        starts = np.flatnonzero(pc.starts_with(words, " ").to_numpy(zero_copy_only=False))
        which, ids, sizes = self.looked_up(words)
        begins = np.cumsum(sizes) - sizes
        own = ids[ranges(begins[which], sizes[which])]
        entries = np.argsort(np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable"))
        return entries[coded.indices.to_numpy()], own, np.add.reduceat(sizes[which], starts)

    def looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which entry of a table each word is, the ids of the table, and how many an entry has."""
        if 2 * len(self.known) > KNOWN_PIECES:
            gone = len(self.older)
            self.ids, self.sizes = self.ids[self.sizes[:gone].sum() :], self.sizes[gone:]
            self.older, self.known = self.known, self.known[:0]
        # what is there already is distinct, and so keeps its place
        coded = pa.concat_arrays([self.older, self.known, words]).dictionary_encode()
        names, before = coded.dictionary, len(self.sizes)
        entries = coded.indices.to_numpy()[before:]
        new = names[before:]
        behind = pc.starts_with(new, " ")
        ids, sizes = encoded(self.pieces, unpacked(pc.utf8_slice_codeunits(new.filter(behind), 1)))
        more, counts = encoded(self.pieces, unpacked(new.filter(pc.invert(behind))), spaced=False)
        ids, sizes = np.concatenate([self.ids, ids, more]), np.concatenate([self.sizes, sizes, counts])
        # new words stand in the table with those behind a space in front
        place = np.argsort(~behind.to_numpy(zero_copy_only=False), kind="stable")
        names = names.take(pa.array(np.concatenate([np.arange(before), before + place])))
        moved = np.arange(len(names))
        moved[before + place] = np.arange(before, len(names))
        entries = moved[entries]
        stays = np.ones(len(self.older), bool)
        stays[entries[entries < len(stays)]] = False
        order = np.concatenate([np.flatnonzero(stays), np.flatnonzero(~stays), np.arange(len(stays), len(names))])
        names = names.take(pa.array(order))
        self.older, self.known = names[: stays.sum()], names[stays.sum() :]
        self.ids, self.sizes = ids[ranges((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]
        return entries, ids, sizes

    def as_a_whole(self, text: str) -> list[int]:
        """Ids of a text in which the strings of added tokens are these tokens."""
        before, self.whole.encode_special_tokens = self.whole.encode_special_tokens, False
        try:
            return self.whole.encode(text, add_special_tokens=False).ids
        finally:
            self.whole.encode_special_tokens = before

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, with the end id behind each, and how many each text has."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        special = np.full(len(column), self.pieces is None)
        for a in self.added:
            special |= pc.match_substring(column, a).to_numpy(zero_copy_only=False)
        apart = np.flatnonzero(special)
        flat, counts = split(pc.if_else(pa.array(special), "", column) if len(apart) else column)
        ends = np.cumsum(counts + 1) - 1  # the place behind the pieces of a text
        first = ends - counts
        has = counts > 0
        # the first piece of a text has no space in front
        inner = np.ones(len(flat), bool)
        inner[(first - np.arange(len(counts)))[has]] = False
        starts = flat.filter(pa.array(~inner)).dictionary_encode()
        inside, *table = self.spaced(flat.filter(pa.array(inner))) if inner.any() else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))
        tables = [table]
        if len(starts):
            tables.append(encoded(self.pieces, starts.dictionary.to_pylist(), spaced=False))
        for i in apart.tolist():
            ids = self.as_a_whole(column[i].as_py())
            tables.append((np.array(ids, np.int32), np.array([len(ids)])))
        ids = np.concatenate([*(t[0] for t in tables), np.array([self.end], np.int32)])
        sizes = np.concatenate([*(t[1] for t in tables), np.array([1])]).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        # entries: pieces inside, pieces at the start, whole texts, the end
        entries = np.full(len(flat) + len(counts), len(sizes) - 1, np.int64)
        body = np.ones(len(entries), bool)
        body[ends] = False
        body[first[has]] = False
        entries[body] = inside
        entries[first[has]] = len(table[1]) + starts.indices.to_numpy()
        places = np.repeat(np.arange(len(counts)), counts + 1)
        if len(apart):
            base = len(sizes) - 1 - len(apart)
            entries = np.insert(entries, ends[apart], base + np.arange(len(apart)))
            places = np.insert(places, ends[apart], apart)
        taken = sizes[entries]
        return ids[ranges(begins[entries], taken)], np.bincount(places, taken, len(counts)).astype(np.int64)


def encoder(path: str, ends_with: int) -> TextEncoder:
    """The encoder of this worker process.

    Functions of this package are shipped by value, so a module of their own does not outlive a
    task; the library's module does.
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_encoders_by_path", {})
    if (path, ends_with) not in kept:
        kept[path, ends_with] = TextEncoder(path, ends_with)
    return kept[path, ends_with]


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer: str, ends_with: int = 0, files: int | None = None
) -> None:
    """Write the ids of every whole text to ORC files below ``folder``, in ascending ``doc_id`` order.

    Null texts are empty and get the end id alone. A null ``doc_id`` sorts first. Repeated rows and
    repeated ids are all written, ordered by a hash of their text. ``files`` is the number of
    id ranges, by default the session's shuffle partitions.
    """
    spark = docs.sparkSession
    key = [F.col("doc_id"), F.xxhash64("text")]
    ranges = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        part, before, own = TaskContext.get().partitionId(), 0, encoder(tokenizer, ends_with)
        for batch in batches:
            upto = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), np.int64))
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH_BYTES, "right")))
                some = batch.slice(at, stop - at)
                at = stop
                ids, sizes = own.encode(some.column(1))
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)))
                columns = [some.column(0).cast(pa.int64()), pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + ends - sizes), pa.array(sizes.astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(ends[-1])

    sorted_docs = texts(docs).repartitionByRange(ranges, *key).sortWithinPartitions(*key, "text")
    before = spark.conf.get(SENT_BYTES)
    spark.conf.set(SENT_BYTES, str(2 * BATCH_BYTES))
    try:
        sorted_docs.mapInArrow(thrifty(encode), FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(folder)
    finally:
        spark.conf.set(SENT_BYTES, before)


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files: ``doc_id, part, before, n_tokens, ids``; filters on ``doc_id`` prune stripes."""
    return spark.read.schema(FILE_SCHEMA).orc(folder)


def document_positions(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row, from the files alone.

    The totals of the files come from two narrow columns; their running sum has one row a file.
    The checksum runs over the ids as little-endian unsigned 32-bit integers.
    """

    def check(batches):
        for batch in batches:
            ids = batch.column("ids")
            values = np.asarray(ids.flatten()).astype("<u4")
            offsets = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("before"), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())],
                names=["doc_id", "part", "before", "n_tokens", "ids_crc32"],
            )

    rows = read_token_ids(spark, folder)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(so_far), F.lit(0)).alias("offset"))
    read = rows.mapInArrow(thrifty(check), "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return read.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
