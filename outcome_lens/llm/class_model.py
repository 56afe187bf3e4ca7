"""Operator 13: scores of a class-based bigram model after Brown: word classes by exchange clustering.

The words of the training texts are counted in full. Exchange clustering then looks for classes under which neighbouring
classes tell most of each other: in every round each word goes to the class that gains most, given the counts
between classes at the end of the round before, and all words of a round are looked at side by side. Words that are the
share ``FREQUENT`` of all tokens take part in all rounds, by their counts of neighbours, a table that Spark makes once; half of
them may move at a time, so that two words do not swap for ever. The others follow in a last round that reads the texts.
There cannot be more frequent words than fit into the whole, ``1 / FREQUENT``: they alone are sent to all tasks.

The probability of a word is that of its class after the class before it, times its share of its class. A discounted
share of each class is left to words that training has not seen; an unseen word says nothing of the next class.

Texts are held as chunks of some megabytes with a dictionary each. What is looked up for a word is joined to
dictionaries: a common word has one row a chunk, not one an occurrence, and no table of words is ever whole in one place.
While classes are made, a word goes by its 64-bit hash: two frequent words of one hash would share a class. Counts go by the word.

Null texts are empty and have the end token alone; a null id counts as the empty text. Every row is one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.collocations import FrequentFilter, probes
from outcome_lens.llm.common import small_batches, stored_alone, thrifty, whole_text
from outcome_lens.llm.pieces import sums
from outcome_lens.llm.shingles import U

FOLDS, HELD_OUT = 7, 2
CLASSES = 64
ROUNDS = 3
FREQUENT = 1e-5  # of all tokens, from which a word takes part in all rounds
MOST_LISTED = 1000  # occurrences of a word whose neighbours go into a list
FILTER_BITS = 1 << 24  # of the Bloom filter of words with more
CHUNK_BYTES = 6 << 20  # of text; one longer text is a chunk of its own
TEXTS_AT_ONCE = 256  # that are unpacked from a batch
SENT_BYTES = 4 << 20  # that go to a worker together; a chunk is one row
CELLS = 1 << 18  # gains that are worked out at a time
LEAST_DISCOUNT, MOST_DISCOUNT = 0.1, 0.9

# Fixed value: white space between words becomes spaces, which leaves a line break to mark ends.
TO_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
END = "\n"
LATE = ["id", "code", "n", "codes"]
HASH_SEED = 42  # fixed value: that of the session's xxhash64


def held_out(folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether the model must not learn from a document."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == fold


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers, byte planes one after the other and compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: pa.Scalar, number: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw.as_buffer(), decompressed_size=4 * number, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def chunk(ids: list, held: list[bool], bodies: list[bytes]) -> dict[str, list]:
    """One row of the table of chunks: tokens as places in the chunk's dictionary, which starts with the end token and goes
    on from common to rare words."""
    data = b" ".join(b + b" \n" for b in bodies)
    parts = pc.split_pattern(pa.array([b"\n " + data], pa.large_binary()).cast(pa.large_string()), " ").values
    parts = parts.filter(pc.not_equal(parts, ""))
    coded = parts.dictionary_encode()
    tokens = coded.indices.to_numpy()[1:]
    often = np.bincount(tokens, minlength=len(coded.dictionary))
    often[0] = len(tokens) + 1
    order = np.argsort(-often, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    tokens = place[tokens]
    sizes = np.diff(np.flatnonzero(tokens == 0) + 1, prepend=0)
    taught = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(tokens[taught], minlength=len(order))
    words = coded.dictionary.take(pa.array(order)).cast(pa.string())
    return {"doc_ids": ids, "held": held, "sizes": sizes, "words": words, "counts": counts, "tokens": packed(tokens)}


def chunked(docs: DataFrame) -> DataFrame:
    """The stored table of chunks: ``chunk, doc_ids, held, sizes, words, counts, tokens``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches) -> Iterator[tuple[list, list, list]]:
        ids, held, bodies, size = [], [], [], 0
        some = (batch.slice(at, TEXTS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, TEXTS_AT_ONCE))
        for batch in some:
            for i, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode().lower().translate(TO_SPACES)
                ids.append(i)
                held.append(h)
                bodies.append(raw)
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield ids, held, bodies
                    ids, held, bodies, size = [], [], [], 0
        if ids:
            yield ids, held, bodies

    def make(batches):
        first, id_type = TaskContext.get().partitionId() << 32, None

        def typed():
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        for number, some in enumerate(rows(typed())):
            found = chunk(*some)
            tokens = pa.array([found.pop("tokens")], pa.binary())
            types = [pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32())]
            columns = []
            for values, kind in zip(found.values(), types, strict=True):
                flat = values if isinstance(values, pa.Array) else pa.array(values, kind.value_type)
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat, type=kind))
            yield pa.RecordBatch.from_arrays([pa.array([first + number]), *columns, tokens], names=["chunk", *found, "tokens"])

    documents = docs.select("doc_id", held_out().alias("held"), whole_text().alias("text"))
    schema = f"chunk long, doc_ids array<{kind}>, held array<boolean>, sizes array<int>, words array<string>, counts array<int>, tokens binary"
    return stored_alone(documents.mapInArrow(thrifty(make), schema), "class-model-chunks")


def vocabulary(chunks: DataFrame) -> DataFrame:
    """``word, c``: how often each word, and the end token, stands in training texts."""
    pairs = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    return pairs.filter("n > 0").groupBy("word").agg(F.sum("n").cast("long").alias("c"))


class Known:
    """Hashes of the frequent words, and a class of each or -1."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        self.ids = ids[order]
        self.classes = table.column("class").to_numpy()[order].astype(np.int32) if "class" in table.column_names else np.zeros(len(ids), np.int32)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each word, and its class; -1 for a word that is not frequent."""
        hashes = word_hashes(words).view(np.int64)
        if not len(self.ids):
            return hashes, np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.ids, hashes), len(self.ids) - 1)
        return hashes, np.where(self.ids[at] == hashes, self.classes[at], np.int32(-1))


def word_filter(words: DataFrame) -> FrequentFilter:
    """A Bloom filter of the hashes in ``id``; at most ``FILTER_BITS / 64`` of its blocks reach the driver."""

    def mark(batches):
        blocks = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            for place, bit in probes(batch.column(0).to_numpy().view(np.uint64), FILTER_BITS):
                np.bitwise_or.at(blocks, place, U(1) << bit)
        some = np.flatnonzero(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(blocks[some].view(np.int64))], names=["block", "bits"])

    found = words.select("id").mapInArrow(thrifty(mark), "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blocks = np.zeros(FILTER_BITS // 64, np.uint64)
    blocks[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return FrequentFilter(blocks)


def word_hashes(words: pa.Array) -> np.ndarray:
    """What the session's ``xxhash64`` gives for each word."""
    return np.fromiter((xxhash.xxh64_intdigest(w, HASH_SEED) for w in words.to_pylist()), np.uint64, len(words))


def looked_up(rows: DataFrame, table: DataFrame, key: str, *names: str) -> DataFrame:
    """``chunk, found``: what ``table`` has for words of each dictionary, given as ``chunk, at`` and their key."""
    return rows.join(table, key).groupBy("chunk").agg(F.collect_list(F.struct("at", *names)).alias("found"))


def arrays_of(found: pa.ListScalar, number: int, *names: str) -> list[np.ndarray]:
    """The named columns of one chunk's look-up, by place in its dictionary; -1 where there is nothing."""
    out = [np.full(number, -1, np.int64) for _ in names]
    if found.is_valid:
        rows = found.values
        at = rows.field("at").to_numpy()
        for array, name in zip(out, names, strict=True):
            array[at] = rows.field(name).to_numpy()
    return out


def taught_pairs(held: np.ndarray, sizes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring tokens of training texts; the end token stands in front of each text."""
    before = np.concatenate([np.zeros(1, np.int32), tokens[:-1]])
    taught = np.repeat(~held, sizes)
    return before[taught], tokens[taught]


def value_of(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def texts_of(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which texts of a chunk are held out, how many tokens each has, and the tokens."""
    sizes = value_of(batch, "sizes", row).astype(np.int64)
    return value_of(batch, "held", row), sizes, unpacked(batch.column("tokens")[row], int(sizes.sum()))


def neighbours(chunks: DataFrame, frequent: DataFrame) -> DataFrame:
    """``w1, w2, n``: how often a frequent word stands in front of another in training texts, by hash."""
    shared = chunks.sparkSession.sparkContext.broadcast(Known(frequent.select("id").toArrow()))

    def count(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, own = shared.value.of(batch.column("words")[row].values)
                a, b = taught_pairs(*texts_of(batch, row))
                both = (own[a] >= 0) & (own[b] >= 0)
                codes, n = np.unique(a[both].astype(np.int64) * len(ids) + b[both], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[codes // len(ids)]), pa.array(ids[codes % len(ids)]), pa.array(n)], names=["w1", "w2", "n"])

    rows = chunks.select("held", "sizes", "tokens", "words").mapInArrow(thrifty(count), "w1 long, w2 long, n long")
    return stored_alone(rows.groupBy("w1", "w2").agg(F.sum("n").alias("n")), "class-model-neighbours")


def entropy(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(owner: np.ndarray, code: np.ndarray, n: np.ndarray, current: np.ndarray, between: np.ndarray) -> np.ndarray:
    """The class with the highest gain for each word, its own being counted without it.

    ``owner``, ``code`` and ``n`` say how often words, in ascending order, have neighbours of a class: ``code`` is a class behind the word,
    or one in front of it raised by the number of classes. ``between`` counts the classes next to each other.
    """
    classes = len(between)
    sides = np.concatenate([between.T, between]).astype(float)
    totals = between.sum(1).astype(float), between.sum(0).astype(float)
    out = np.empty(len(current), np.int64)
    starts = np.searchsorted(owner, np.arange(len(current) + 1))
    at = 0
    while at < len(current):
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + CELLS // classes, "right")) - 1)
        rows = slice(starts[at], starts[upto])
        word, here, own = owner[rows] - at, n[rows].astype(float), current[at:upto]
        held = own >= 0
        base = sides[code[rows]]
        mine = np.flatnonzero(held[word])
        base[mine, own[word[mine]]] = np.maximum(base[mine, own[word[mine]]] - here[mine], 0)
        change = entropy(base + here[:, None]) - entropy(base)
        gain = np.zeros((upto - at, classes))
        some = np.flatnonzero(np.diff(starts[at : upto + 1]))
        if len(some):
            gain[some] = np.add.reduceat(change, (starts[at:upto] - starts[at])[some], axis=0)
        for side, total in enumerate(totals):
            mass = np.bincount(word, np.where(code[rows] // classes == side, here, 0.0), upto - at)
            whole = np.tile(total, (upto - at, 1))
            whole[held, own[held]] = np.maximum(whole[held, own[held]] - mass[held], 0)
            gain -= entropy(whole + mass[:, None]) - entropy(whole)
        out[at:upto] = gain.argmax(1)
        at = upto
    return out


def matrix(counts: DataFrame, classes: int) -> np.ndarray:
    """``c1, c2, n`` rows, at most ``classes`` squared, as an array."""
    rows = counts.toArrow()
    out = np.zeros((classes, classes))
    out[rows.column("c1").to_numpy(), rows.column("c2").to_numpy()] = rows.column("n").to_numpy()
    return out


def exchanged(frequent: DataFrame, pairs: DataFrame, classes: int, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """``id, class`` of the frequent words, and the counts between their classes.

    The commonest words start with a class of their own, the others join in the first round.
    """
    spark = frequent.sparkSession
    first = frequent.orderBy(F.desc("c"), "word").limit(classes).select("id").collect()
    known = spark.createDataFrame([(r.id, i) for i, r in enumerate(first)], "id long, class int")

    def neighbouring(known: DataFrame) -> tuple[DataFrame, np.ndarray]:
        side = F.broadcast(known)  # frequent words only
        behind = pairs.join(side.select(F.col("id").alias("w2"), F.col("class").alias("code")), "w2").groupBy(F.col("w1").alias("id"), "code")
        behind = stored_alone(behind.agg(F.sum("n").alias("n")), "class-model-behind")
        ahead = pairs.join(side.select(F.col("id").alias("w1"), (F.col("class") + classes).alias("code")), "w1").groupBy(F.col("w2").alias("id"), "code")
        between = behind.join(side, "id").groupBy(F.col("class").alias("c1"), F.col("code").alias("c2")).agg(F.sum("n").alias("n"))
        return behind.union(ahead.agg(F.sum("n").alias("n"))), matrix(between, classes)

    for number in range(rounds):
        cells, between = neighbouring(known)
        lists = cells.groupBy("id").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("counts"))
        rows = lists.join(F.broadcast(known), "id", "left").withColumn("current", F.coalesce(F.col("class"), F.lit(-1)))
        turn = (F.col("current") < 0) | (F.pmod(F.xxhash64("id", F.lit(number)), F.lit(2)) == 0)
        if number == 0:
            turn = F.col("current") < 0
        # the class of a word whose turn it is not is the one it has: a single pass for all
        known = stored_alone(moved(rows.withColumn("stay", F.when(~turn, F.col("class"))), between, "long"), "class-model-classes")
    return known, neighbouring(known)[1]


def moved(vectors: DataFrame, between: np.ndarray, kind: str) -> DataFrame:
    """``id, class`` of ``id, current, stay, codes, counts`` rows; ``stay`` is the class if it is there."""

    def move(batches):
        for batch in batches:
            lists = batch.column("codes")
            owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths(), np.int64))
            codes, counts = np.asarray(lists.flatten(), np.int64), np.asarray(batch.column("counts").flatten(), np.int64)
            width = 2 * len(between)
            cells, inverse = np.unique(owner * width + codes, return_inverse=True)
            n = np.bincount(inverse, counts, len(cells))
            current = batch.column("current").to_numpy(zero_copy_only=False).astype(np.int64)
            best = best_classes(cells // width, cells % width, n, current, between)
            stay = batch.column("stay").fill_null(-1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.where(stay >= 0, stay, best).astype(np.int32))], names=["id", "class"])

    return vectors.select("id", "current", "stay", "codes", "counts").mapInArrow(thrifty(move), f"id {kind}, class int")


def late_classes(chunks: DataFrame, known: DataFrame, often: FrequentFilter, between: np.ndarray) -> DataFrame:
    """``id, class`` of the words that took part in no round, from their neighbours that did.

    The classes next to a word go into a list, if it has less than ``MOST_LISTED`` occurrences in all; those of a word that ``often``
    has are counted before they move and summed. A word that ``often`` has in error is only counted in the other way.
    """
    classes = len(between)
    spark = chunks.sparkSession.sparkContext
    shared, blocks = spark.broadcast(Known(known.toArrow())), spark.broadcast(often.blocks)

    def collect(batches):
        often = FrequentFilter(blocks.value)
        for batch in batches:
            for row in range(batch.num_rows):
                hashes, own = shared.value.of(batch.column("words")[row].values)
                a, b = taught_pairs(*texts_of(batch, row))
                behind, ahead = (own[a] < 0) & (own[b] >= 0), (own[b] < 0) & (own[a] >= 0)
                word = np.concatenate([a[behind], b[ahead]])
                code = np.concatenate([own[b[behind]], own[a[ahead]] + classes])
                counted = often.has(hashes.view(np.uint64))[word]
                cells, n = np.unique(word[counted].astype(np.int64) * 2 * classes + code[counted], return_counts=True)
                word, code = word[~counted], code[~counted]
                order = np.argsort(word, kind="stable")
                word, code = word[order], code[order]
                which, begins = np.unique(word, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(word)).astype(np.int32)), pa.array(code.astype(np.int16)))
                none = np.zeros(len(which), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[which]), pa.array((none - 1).astype(np.int16)), pa.array(none), lists], names=LATE)
                empty = pa.ListArray.from_arrays(pa.array(np.zeros(len(cells) + 1, np.int32)), pa.array([], pa.int16()))
                which, code = cells // (2 * classes), cells % (2 * classes)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[which]), pa.array(code.astype(np.int16)), pa.array(n.astype(np.int64)), empty], names=LATE)

    rows = chunks.select("held", "sizes", "tokens", "words").mapInArrow(thrifty(collect), "id long, code short, n long, codes array<short>")
    summed = rows.groupBy("id", "code").agg(F.flatten(F.collect_list("codes")).alias("codes"), F.sum("n").alias("n"))
    is_sum = F.col("code") >= 0
    lists = summed.groupBy("id").agg(
        F.flatten(F.collect_list("codes")).alias("listed"), F.collect_list(F.when(is_sum, F.col("code"))).alias("codes"), F.collect_list(F.when(is_sum, F.col("n"))).alias("counts")
    )
    ones = F.transform("listed", lambda _: F.lit(1).cast("long"))
    vectors = lists.select("id", F.lit(-1).alias("current"), F.lit(None).cast("int").alias("stay"), F.concat("listed", "codes").alias("codes"), F.concat(ones, "counts").alias("counts"))
    return moved(vectors, between, "long")


class ClassModel:
    """The figures that probabilities need beside those of the words themselves; their size depends on the classes alone."""

    def __init__(self, tokens: int, types: int, discount: float, sizes: np.ndarray, kinds: np.ndarray, between: np.ndarray, end: int):
        self.tokens, self.types, self.discount, self.end = tokens, types, discount, end
        self.log_sizes = np.log10(np.maximum(sizes, 1))
        share = sizes / max(tokens, 1)
        followers = (between > 0).sum(1, keepdims=True)
        total = between.sum(1, keepdims=True)
        with np.errstate(invalid="ignore"):
            after = np.where(total > 0, (between + followers * share) / np.maximum(total + followers, 1), share)
        after = np.concatenate([after, share[None, :]])  # the last row: after an unseen word
        left = np.where(sizes > 0, discount * kinds / np.maximum(sizes, 1), 0.0)
        with np.errstate(divide="ignore"):
            self.log_after = np.log10(after)
            # without any training text an unseen word is all there is
            self.log_unseen = np.log10(after @ left) if tokens else np.zeros(len(after))

    def shares(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The logarithm of each word's share of its class; 0 for unseen words, whose share is in ``log_unseen``."""
        if not len(self.log_sizes):
            return np.zeros(len(counts))
        return np.where(classes >= 0, np.log10(np.maximum(counts - self.discount, 1e-9)) - self.log_sizes[classes], 0.0)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """The logarithm of each word's probability under add-one counts; a count of -1 is none."""
        return np.log10(np.maximum(counts, 0) + 1.0) - np.log10(self.tokens + self.types + 1.0)

    def steps(self, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The logarithm of each token's class after the one before it; -1 is the class of unseen words."""
        before = np.concatenate([[0], own[:-1]])
        before[np.cumsum(sizes) - sizes] = self.end
        return np.where(own >= 0, self.log_after[before, own], self.log_unseen[before])


def class_scores(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, frequent: float = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``score`` is the base-10 logarithm of the text's probability, ``base_score`` the same under add-one counts of words.
    """
    with small_batches(docs.sparkSession, SENT_BYTES):
        classed, model = learned(docs, classes, rounds, frequent)
    return scored(classed, model, docs.schema["doc_id"].dataType.simpleString())


def learned(docs: DataFrame, classes: int, rounds: int, frequent: float) -> tuple[DataFrame, ClassModel]:
    """The texts of ``docs`` as classes of their tokens, and the model they are scored by."""
    chunks = chunked(docs)
    counts = stored_alone(vocabulary(chunks), "class-model-words")
    whole = counts.agg(F.sum("c").alias("tokens"), F.count("*").alias("types"), *[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2)]).first()
    if whole.tokens:
        common = stored_alone(counts.filter((F.col("c") >= frequent * whole.tokens) & (F.col("c") > 1) | (F.col("word") == END)).withColumn("id", F.xxhash64("word")), "class-model-frequent")
        known, between = exchanged(common, neighbours(chunks, common), classes, rounds)
        often = word_filter(counts.filter((F.col("c") >= MOST_LISTED) & (F.col("c") < frequent * whole.tokens)).select(F.xxhash64("word").alias("id")))
        named = known.select("id", "class", F.lit(0).alias("late")).union(late_classes(chunks, known, often, between).withColumn("late", F.lit(1)))
        # a frequent word without frequent neighbours gets its class late
        named = named.groupBy("id").agg(F.min_by("class", "late").alias("class"))
        words = counts.withColumn("id", F.xxhash64("word")).join(named, "id", "left").select("word", "c", F.coalesce("class", F.lit(0)).alias("class"))
        words = stored_alone(words, "class-model")
        sizes, kinds = np.zeros(classes), np.zeros(classes)
        for r in words.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("types")).collect():
            sizes[r["class"]], kinds[r["class"]] = r.c, r.types
        discount = min(MOST_DISCOUNT, max(LEAST_DISCOUNT, whole.n1 / max(1, whole.n1 + 2 * whole.n2)))
        end = words.filter(F.col("word") == END).first()["class"]
        places = chunks.select("chunk", F.posexplode("words").alias("at", "word"))
        coded = chunks.drop("words", "counts").join(looked_up(places, words, "word", "c", "class"), "chunk", "left")
        model = ClassModel(whole.tokens, whole.types, discount, sizes, kinds, np.zeros((classes, classes)), end)
        classed = stored_alone(classed_texts(coded, model, docs.schema["doc_id"].dataType.simpleString()), "class-model-classed")
        model = ClassModel(whole.tokens, whole.types, discount, sizes, kinds, transitions(classed, model), end)
    else:
        coded = chunks.drop("words", "counts").withColumn("found", F.lit(None).cast("array<struct<at:int,c:long,class:int>>"))
        model = ClassModel(0, 0, 0.5, np.zeros(classes), np.zeros(classes), np.zeros((classes, classes)), 0)
        classed = classed_texts(coded, model, docs.schema["doc_id"].dataType.simpleString())
    return classed, model


def classed_texts(coded: DataFrame, model: ClassModel, kind: str) -> DataFrame:
    """Chunks with the sums that words alone decide, and the classes of all tokens: no step after this looks words up."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def sum_up(batches):
        model = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                _, sizes, tokens = texts_of(batch, row)
                c, own = arrays_of(batch.column("found")[row], int(tokens.max()) + 1, "c", "class")
                starts = np.cumsum(sizes) - sizes
                lists = [
                    pa.array(sums((c[tokens] > 0).astype(np.int64), sizes)),
                    pa.array(np.add.reduceat(model.base(c)[tokens], starts)),
                    pa.array(np.add.reduceat(model.shares(c, own)[tokens], starts)),
                ]
                offsets = pa.array([0, len(sizes)], pa.int32())
                some = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(n) for n in ("doc_ids", "held", "sizes")), *(pa.ListArray.from_arrays(offsets, x) for x in lists),
                        pa.array([packed(own[tokens] + 1)], pa.binary()),
                    ],
                    names=["doc_ids", "held", "sizes", "known", "base", "shares", "tokens"],
                )

    schema = f"doc_ids array<{kind}>, held array<boolean>, sizes array<int>, known array<long>, base array<double>, shares array<double>, tokens binary"
    return coded.select("doc_ids", "held", "sizes", "tokens", "found").mapInArrow(thrifty(sum_up), schema)


def scored(classed: DataFrame, model: ClassModel, kind: str) -> DataFrame:
    """The result's rows, from the classes of all tokens."""
    shared = classed.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                _, sizes, own = texts_of(batch, row)
                steps = np.add.reduceat(model.steps(sizes, own - 1), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[row].values, batch.column("held")[row].values, pa.array(sizes), batch.column("known")[row].values,
                        pa.array(np.full(len(sizes), model.tokens)), batch.column("base")[row].values, pa.array(steps + value_of(batch, "shares", row)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return classed.mapInArrow(thrifty(score), schema)


def transitions(classed: DataFrame, model: ClassModel) -> np.ndarray:
    """How often each class stands in front of each other in training texts."""
    classes, end = len(model.log_sizes), model.end

    def count(batches):
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                held, sizes, own = texts_of(batch, row)
                own = own - 1
                before = np.concatenate([[0], own[:-1]])
                before[np.cumsum(sizes) - sizes] = end
                taught = np.repeat(~held, sizes)
                total += np.bincount(before[taught] * classes + own[taught], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((some // classes).astype(np.int32)), pa.array((some % classes).astype(np.int32)), pa.array(total[some])], names=["c1", "c2", "n"])

    rows = classed.select("held", "sizes", "tokens").mapInArrow(thrifty(count), "c1 int, c2 int, n long")
    return matrix(rows.groupBy("c1", "c2").agg(F.sum("n").alias("n")), classes)
