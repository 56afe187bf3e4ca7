"""Operator 11: phrases whose words keep company, from the n-grams of FM-indexes over word ids.

Every task collects texts of a language into shards and builds a bidirectional FM-index of each: the
Burrows-Wheeler transforms of the shard's word ids and of the reversed ids, with rows sorted by as many words
as an n-gram may have. An n-gram is a pair of row intervals of equal size, one in each transform; extending all
intervals of a depth to the left or to the right by one word enumerates the next depth with its counts. The
counts of all shards are summed by Spark, so neither their number nor what they hold matters to the result.

An n-gram cannot be frequent unless the two shorter ones inside it are. From three words on, shards therefore extend
only what a Bloom filter of the frequent n-grams of the depth before lets through. The filter has a fixed number of
bits; what it lets through in error is counted and then dropped, so that it never decides a result.

Null texts are empty, a null language is ``und``. Repeated rows count each time. Texts without words add nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outcome_lens.llm.common import whole_text
from outcome_lens.llm.shingles import POSITIONS, U, mixed
from outcome_lens.session import stored

MAX_WORDS = 3
LEAST_COUNT = 10
INSIDE_PERCENT = 50  # a phrase goes when a longer one around it has this share of its count
TOP = 2000
NO_LANGUAGE = "und"
SHARD_BYTES = 3 << 20  # of text; one longer text is a shard of its own
FILTER_BITS = 1 << 27
ROWS_PER_BATCH = 1 << 16
TEXTS_AT_ONCE = 256  # that are unpacked from a batch
SALTS = 16

# What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
TO_SPACES = bytes.maketrans(b"\t", b" ")
TO_BREAKS = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
BREAK = "\n"


def word_ids(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Ids of the words of ``data``, 0 standing for piece ends, and the words; word ``i`` has the id ``i + 1``."""
    spaced = data.lower().translate(TO_SPACES).translate(TO_BREAKS).replace(b"\n", b" \n ")
    parts = pc.split_pattern(pa.array([b"\n " + spaced + b" \n"], pa.large_binary()).cast(pa.large_string()), " ").values
    # a break comes first, so that it is the first entry of the dictionary
    coded = parts.dictionary_encode()
    ids, words = coded.indices.to_numpy(), coded.dictionary
    nothing = pc.index(words, pa.scalar("", words.type)).as_py()
    if nothing < 0:
        return ids, words.slice(1)
    ids = ids[ids != nothing]
    rest = np.delete(np.arange(len(words)), nothing)
    number = np.zeros(len(words), ids.dtype)
    number[rest] = np.arange(len(rest))
    return number[ids], words.take(pa.array(rest)).slice(1)


class Rows:
    """One direction of an index: the rows of all suffixes, sorted by their first ``depth`` symbols."""

    def __init__(self, ids: np.ndarray, symbols: int, depth: int):
        size, bits = len(ids), max(1, int(symbols - 1).bit_length())
        ahead = np.concatenate([ids, np.zeros(depth, ids.dtype)])
        windows = [ahead[k : k + size] for k in range(depth)]
        if depth * bits <= 63:
            key = np.zeros(size, np.uint64)
            for w in windows:
                key = (key << U(bits)) | w.astype(np.uint64)
            order = np.argsort(key)
        else:
            order = np.lexsort(windows[::-1])
        self.transform = ids[order - 1]  # the symbol in front of each suffix; a break is in front of the text
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=symbols))])
        # where the rows are found that start with the symbol in front: the last-to-first mapping
        position = U(max(1, size.bit_length()))
        by_symbol = np.argsort((self.transform.astype(np.uint64) << position) | np.arange(size, dtype=np.uint64))
        self.mapping = np.empty(size, np.int64)
        self.mapping[by_symbol] = np.arange(size)


class Intervals:
    """N-grams of one depth: where their rows start in both directions, how many there are, and their words."""

    def __init__(self, start: np.ndarray, back: np.ndarray, size: np.ndarray, words: list[np.ndarray]):
        self.start, self.back, self.size, self.words = start, back, size, words

    def only(self, keep: np.ndarray) -> Intervals:
        return Intervals(self.start[keep], self.back[keep], self.size[keep], [w[keep] for w in self.words])


class ShardIndex:
    """A bidirectional FM-index over word ids, for n-grams of up to ``depth`` words; id 0 is in none."""

    def __init__(self, ids: np.ndarray, symbols: int, depth: int):
        self.symbols = symbols
        self.forward = Rows(ids, symbols, depth)
        self.backward = Rows(ids[::-1], symbols, depth)

    def single_words(self) -> Intervals:
        words = np.arange(1, self.symbols)
        first = self.forward.first
        return Intervals(first[words], first[words], first[words + 1] - first[words], [words])

    def extended(self, found: Intervals, left: bool) -> Intervals:
        """Every interval with every word that stands in front of it, or behind it."""
        rows, here, there = (self.forward, found.start, found.back) if left else (self.backward, found.back, found.start)
        owner = np.repeat(np.arange(len(here)), found.size)
        begins = np.cumsum(found.size) - found.size
        at = np.arange(len(owner)) + (here - begins)[owner]
        symbol = rows.transform[at]
        key = owner * self.symbols + symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        group = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(group, len(key)))
        whose = owner[order[group]]
        word = symbol[order[group]]
        start = rows.mapping[at[order[group]]]
        other = there[whose] + group - begins[whose]  # rows of smaller symbols come before
        words = [w[whose] for w in found.words]
        out = Intervals(start, other, size, [word, *words]) if left else Intervals(other, start, size, [*words, word])
        return out.only(word > 0)


class FrequentFilter:
    """A Bloom filter of n-grams, by hashes of their words."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for place, bit in probes(hashes, 64 * len(self.blocks)):
            out &= (self.blocks[place] >> bit) & U(1) > 0
        return out


def probes(hashes: np.ndarray, bits: int):
    """Block and bit of each of the places that a filter of ``bits`` bits has for a hash."""
    for k in range(3):
        at = mixed(hashes ^ POSITIONS[k]) % U(bits)
        yield (at >> U(6)).astype(np.int64), at & U(63)


def gram_hashes(words: list[np.ndarray]) -> np.ndarray:
    """A hash of each n-gram, from hashes of its words in order."""
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = mixed(out * POSITIONS[0] + w)
    return out


def hashes_of(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def shard_grams(data: bytes, first: int, last: int, frequent: FrequentFilter | None):
    """Phrases of ``first`` to ``last`` words of one shard, with their counts; the empty phrase counts all words."""
    ids, words = word_ids(data)
    if first == 0:
        yield pa.array([""]), np.array([np.count_nonzero(ids)])
    if not len(words):
        return
    index = ShardIndex(ids, len(words) + 1, last)
    found = index.single_words()
    hashed = np.concatenate([np.zeros(1, np.uint64), hashes_of(words)]) if frequent is not None else None
    for depth in range(1, last + 1):
        if depth > 1:
            found = index.extended(found, left=depth % 2 == 0)
        if frequent is not None and depth >= last - 1 and len(found.size):
            known = [hashed[w] for w in found.words]
            inside = [known] if depth == last - 1 else [known[:-1], known[1:]]
            keep = np.ones(len(found.size), bool)
            for part in inside:
                keep &= frequent.has(gram_hashes(part))
            found = found.only(keep)
        if depth >= first:
            for a in range(0, len(found.size), ROWS_PER_BATCH):
                some = [words.take(pa.array(w[a : a + ROWS_PER_BATCH] - 1)) for w in found.words]
                yield pc.binary_join_element_wise(*some, pa.scalar(" ", words.type)), found.size[a : a + ROWS_PER_BATCH]


def counted(docs: DataFrame, first: int, last: int, least: int, frequent: FrequentFilter | None = None) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``first`` to ``last`` words that all texts together have ``least`` times."""
    shared = None if frequent is None else docs.sparkSession.sparkContext.broadcast(frequent.blocks)

    def shards(batches):
        held: dict[str, list[bytes]] = {}
        size = 0
        some = (batch.slice(at, TEXTS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, TEXTS_AT_ONCE))
        for batch in some:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= SHARD_BYTES:
                    yield from held.items()
                    held, size = {}, 0
        yield from held.items()

    def count(batches):
        known = None if shared is None else FrequentFilter(shared.value)
        for lang, texts in shards(batches):
            for phrases, sizes in shard_grams(b"\n".join(texts), first, last, known):
                names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(sizes), np.int32)), pa.array([lang])).dictionary_decode()
                yield pa.RecordBatch.from_arrays([names, phrases.cast(pa.string()), pa.array(sizes.astype(np.int64))], names=["lang", "phrase", "f"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), whole_text().alias("text"))
    sums = rows.mapInArrow(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return sums.filter((F.col("f") >= least) | (F.col("phrase") == ""))


def frequent_filter(phrases: DataFrame, bits: int) -> FrequentFilter:
    """A filter of all rows of ``phrases``; of its blocks, those with any bit reach the driver, ``bits / 64`` at most."""

    def mark(batches):
        blocks = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            parts = pc.split_pattern(batch.column(0), " ")
            words = hashes_of(parts.flatten()).reshape(len(parts), -1) if len(parts) else np.zeros((0, 1), np.uint64)
            for place, bit in probes(gram_hashes(list(words.T)), bits):
                np.bitwise_or.at(blocks, place, U(1) << bit)
        some = np.flatnonzero(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(blocks[some].view(np.int64))], names=["block", "bits"])

    found = phrases.select("phrase").mapInArrow(mark, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blocks = np.zeros(bits // 64, np.uint64)
    blocks[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return FrequentFilter(blocks)


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST_COUNT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, size, f``: every phrase of up to ``max_words`` words that occurs ``least`` times, as a stored table.

    The row of size 0 of a language counts all its words.
    """
    size = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1)
    out = stored(counted(docs, 0, min(2, max_words), least).withColumn("size", size), "phrases-2")
    for depth in range(3, max_words + 1):
        known = frequent_filter(out.filter(F.col("size") == depth - 1), filter_bits)
        longer = counted(docs, depth, depth, least, known).withColumn("size", size)
        out = out.unionByName(stored(longer, f"phrases-{depth}"))
    return out.select("lang", "phrase", "size", "f")


def extensions(phrases: DataFrame) -> DataFrame:
    """``lang, part, most, left, right``: the highest count among frequent phrases around a part of two words or more.

    ``left`` and ``right`` are those of the phrases that have just one word more on that side.
    """
    words = F.split("phrase", " ")
    sizes = phrases.filter("size > 2").select("lang", "f", "size", words.alias("words"))
    inside = sizes.select(
        "lang", "f", "size", "words",
        F.explode(F.expr("flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> struct(k, i))))")).alias("at"),
    )
    parts = inside.select(
        "lang", F.expr("array_join(slice(words, at.i, at.k), ' ')").alias("part"), "f",
        F.expr("at.k = size - 1 AND at.i = 2").alias("longer_left"), F.expr("at.k = size - 1 AND at.i = 1").alias("longer_right"),
    )
    highest = lambda side: F.max(F.when(F.col(side), F.col("f")))
    return parts.groupBy("lang", "part").agg(F.max("f").alias("most"), highest("longer_left").alias("left"), highest("longer_right").alias("right"))


def scored(phrases: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, n, score, left, right`` of every candidate that no longer one stands for.

    Each candidate is cut after each of its words but the last. A word can be the first of a large share of all candidates: the
    counts that are joined are therefore dealt in copies, of which a cut asks for one.
    """
    cuts = phrases.filter("size > 1").select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"),
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k", "salt", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("rest"),
    )
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    counts = phrases.filter("size > 0").select("lang", "phrase", "f", salts)
    with_first = cuts.join(counts.select("lang", "salt", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first", "salt"])
    both = with_first.join(counts.select("lang", "salt", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest", "salt"])
    exact = "decimal(14,0)"
    square = F.col("a").cast(exact) * F.col("a").cast(exact) * F.lit(1_000_000).cast("decimal(7,0)")
    both = both.withColumn("top", square).withColumn("below", F.col("l").cast(exact) * F.col("r").cast(exact))
    lowest = both.select("lang", "phrase", "a", F.struct(F.expr("top div below").alias("score"), "k", "l", "r").alias("cut"))
    lowest = lowest.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    around = extensions(phrases).withColumnRenamed("part", "phrase")
    kept = lowest.join(around, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("most") < inside_percent * F.col("a"), F.lit(True)))
    n = phrases.filter("size = 0").select("lang", F.col("f").alias("n"))
    return kept.join(n, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "left", "right")


def collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase, with their rank.

    A language's phrases are first ranked in shares by hash, and only the first of each share together.
    """
    rows = scored(frequent_phrases(docs, **options))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("share")
    some = rows.select("*", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    some = some.filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left", "right")


def collocations_sql() -> str:
    """The same in DuckDB, which counts every phrase in full."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
words AS (SELECT lang, id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM numbered),
ahead AS (SELECT lang, word, lead(word) OVER own AS second, lead(word, 2) OVER own AS third FROM words WINDOW own AS (PARTITION BY id ORDER BY pos)),
grams AS (
  SELECT lang, 1 AS k, word AS phrase FROM ahead
  UNION ALL SELECT lang, 2, word || ' ' || second FROM ahead WHERE second IS NOT NULL
  UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third FROM ahead WHERE third IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {LEAST_COUNT}),
cuts AS (
  SELECT c.lang, c.phrase, c.a, s.k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM candidates c JOIN (VALUES (1), (2)) AS s(k) ON s.k < c.size
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:s.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[s.k + 1:c.size], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM candidates WHERE size = 3
  UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE size = 3),
gone AS (SELECT DISTINCT p.lang, p.part FROM parts p JOIN candidates c ON c.lang = p.lang AND c.phrase = p.part AND 100 * p.a >= {INSIDE_PERCENT} * c.a),
kept AS (SELECT l.* FROM lowest l ANTI JOIN gone g ON g.lang = l.lang AND g.part = l.phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= {TOP}"""
