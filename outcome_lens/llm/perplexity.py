"""Operator 7: quality rules, and perplexity under a modified Kneser-Ney model with bands for each language.

The model is of characters, order ``ORDER``, one for each language, counted by Spark over the whole texts of all
documents. Lower orders use continuation counts, and each order has the three discounts of modified
Kneser-Ney. Probabilities are interpolated once and stored as arrays sorted by the hash of language and
n-gram, in parts of bounded size; a scoring task looks the n-grams of its documents up by binary search, part
by part when the parts together do not fit. What a model does not have is backed off to shorter n-grams.

No document is scored by a model that has counted it: the hash of a text puts it, with all its copies, in one of two
halves, each half has its own model, and a document is scored by the model of the other half. It is rejected
when its mean log-probability lies outside its language's band, which follows the measured spread.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcome_lens.llm.common import give_back, small_batches, thrifty, whole_text
from outcome_lens.llm.near_duplicates import column_parts
from outcome_lens.llm.shingles import POSITIONS, U, mixed, word_hashes
from outcome_lens.llm.warc import file_system
from outcome_lens.session import new_path, stored

ORDER = 5
LEAST_WORDS = 50
REPEAT_WINDOW = 3
BATCH_CHARS = 4 << 20
BACKED_OFF = 1 << 17  # n-grams backed off at a time
SENT_ROWS = 1 << 17  # n-grams that leave a worker together
PART_ROWS = 4_000_000  # n-grams in one sorted array
READ_ROWS = 1 << 16  # of a part at a time
LOOKED_UP = 1 << 16  # n-grams that are hashed, or looked up in a part, at a time
HELD_PARTS = 4  # arrays a task keeps; more are read again for every batch
# the band of a language's mean log-probabilities: so many distances from the median to the quartile on that side,
# more where few documents tell the spread (two standard errors of the distance), and at least a share of the median
LOWER, UPPER = 7.0, 7.0
LEAST_SHARE = 0.02
FEW = 4.0  # over the root of the number of documents: a distance's two standard errors, as a share of it
FLOOR = math.log(1e-7)  # of a character where there is no model of its language
HALVES = 2

CHARACTER_BITS = 12  # of the number of a character while n-grams are counted
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
SIGN = U(1 << 63)  # makes signed order that of unsigned numbers
PAD = "\n" * (ORDER - 1)
SHORTER, WEIGHT = np.array([[0x110000], [0x110001]], np.uint64)  # in place of characters: before a shorter n-gram, and after a context
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased and each behind padding, and the number of characters of each."""
    folded = [PAD + t.lower() for t in texts]
    sizes = np.array([len(t) for t in folded]) - len(PAD)
    return np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def window_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the n-gram of every character starts, and the index of its text."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    starts = owner * np.int32(len(PAD))
    starts += np.arange(len(owner), dtype=np.int32)
    return starts, owner


def gram_hashes(points: np.ndarray, starts: np.ndarray, language: np.ndarray, order: int = ORDER, weight: bool = False) -> np.ndarray:
    """A 64-bit hash of each n-gram of a language; sorted as signed numbers, as Spark sorts them.

    ``starts`` are those of windows of ``ORDER`` characters, of which a shorter n-gram is the end. With ``weight``, the hash of
    what the context in front of the last character leaves to shorter n-grams.
    """
    out = language * POSITIONS[0]
    for at in range(ORDER):
        if at < ORDER - order:
            point = SHORTER
        elif weight and at == ORDER - 1:
            point = WEIGHT
        else:
            point = points[starts + at].astype(np.uint64)
        out = out * POSITIONS[1] + point * POSITIONS[2]
    return mixed(out).view(np.int64)


def language_hash(languages: list[str | None]) -> np.ndarray:
    """A number a language; null is one of its own."""
    raw = [b"+" + x.encode() if x is not None else b"-" for x in languages]
    return np.array([int.from_bytes(r, "little") % ((1 << 61) - 1) for r in raw], np.uint64)


def gram_counts(points: np.ndarray, sizes: np.ndarray):
    """Arrow arrays of n-grams with the number of times each occurs, any n-gram being in one array at least.

    The characters of a list have small numbers, so that an n-gram is one integer and counting is sorting. Texts
    with more different characters than fit are counted in halves, one text alone by its rows of code points.
    """
    total = int(sizes.sum())
    if not total:
        return
    present = np.flatnonzero(np.bincount(points))
    if len(present) <= 1 << CHARACTER_BITS:
        number = np.zeros(present[-1] + 1, np.uint16)
        number[present] = np.arange(len(present), dtype=np.uint16)
        numbers = number[points]
        code = np.zeros(len(points) - (ORDER - 1), np.uint64)
        for at in range(ORDER):
            code <<= U(CHARACTER_BITS)
            code |= numbers[at : at + len(code)]
        del numbers
        # windows that reach over the end of a text go
        inside = np.ones(len(code), bool)
        ends = np.cumsum(sizes + len(PAD))[:-1]
        inside[(ends[:, None] - 1 - np.arange(ORDER - 1)).reshape(-1)] = False
        code = code[inside]
        code.sort()
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        counts = np.diff(np.concatenate([first, [len(code)]]))
        code = code[first]
        shifts = U(CHARACTER_BITS) * np.arange(ORDER - 1, -1, -1, dtype=np.uint64)
        for at in range(0, len(code), SENT_ROWS):
            yield gram_array(present[(code[at : at + SENT_ROWS, None] >> shifts) & U((1 << CHARACTER_BITS) - 1)]), counts[at : at + SENT_ROWS]
    elif len(sizes) > 1:
        half = len(sizes) // 2
        cut = int(sizes[:half].sum()) + half * len(PAD)
        yield from gram_counts(points[:cut], sizes[:half])
        yield from gram_counts(points[cut:], sizes[half:])
    else:
        starts, _ = window_starts(sizes)
        grams, counts = np.unique(points[starts[:, None] + np.arange(ORDER)], axis=0, return_counts=True)
        for at in range(0, len(grams), SENT_ROWS):
            yield gram_array(grams[at : at + SENT_ROWS]), counts[at : at + SENT_ROWS]


def gram_array(grams: np.ndarray) -> pa.Array:
    """One string a row of code points."""
    raw = grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode()
    widths = 1 + (grams > 0x7F).sum(1) + (grams > 0x7FF).sum(1) + (grams > 0xFFFF).sum(1) + len(grams[0]) - 1
    offsets = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(grams), pa.py_buffer(offsets), pa.py_buffer(raw))


def counted(docs: DataFrame) -> DataFrame:
    """``lang, gram, c`` over all texts: counted in arrays, added up before and after the shuffle."""

    def count(batches):
        for batch in batches:
            for a, b in column_parts(batch.column(1), BATCH_CHARS):
                by_language: dict[str | None, list[str]] = {}
                for lang, body in zip(*(c.slice(a, b - a).to_pylist() for c in batch.columns), strict=True):
                    by_language.setdefault(lang, []).append(body)
                for lang, some in by_language.items():
                    for rows, c in gram_counts(*code_points(some)):
                        yield pa.RecordBatch.from_pydict({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(rows)), "gram": rows, "c": c})

    rows = docs.select(F.col("lang").cast("string").alias("lang"), whole_text().alias("text"))
    return rows.mapInArrow(thrifty(count), "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def interpolated_orders(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For every order from one on ``lang, gram, p``, and ``lang, context, left``: what a context leaves to the order below.

    Below the first order the rest is shared by the characters seen and one that stands for all others.
    """
    orders = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # how many different characters stand in front of the shorter n-gram
        orders[n] = stored(orders[n + 1].groupBy("lang", F.expr(f"substring(gram, 2, {n})").alias("gram")).agg(F.count(F.lit(1)).alias("c")), f"grams-{n}")
    out: list[tuple[DataFrame, DataFrame]] = []
    for n in range(1, ORDER + 1):
        grams = orders[n].withColumn("context", F.expr(f"substring(gram, 1, {n - 1})"))
        discounts = discounts_of(grams)
        c = F.col("c")
        own = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        taken = grams.join(discounts, F.col("lang").eqNullSafe(F.col("lang_d"))).drop("lang_d").withColumn("d", own)
        left = F.sum("d") / F.sum("c")
        if n == 1:
            left = left / (F.count(F.lit(1)) + 1)
        contexts = stored(taken.groupBy(F.col("lang").alias("lang_c"), F.col("context").alias("context_c")).agg(F.sum("c").alias("all"), left.alias("left")), f"contexts-{n}")
        same = F.col("lang").eqNullSafe(F.col("lang_c")) & (F.col("context") == F.col("context_c"))
        rows = taken.join(contexts, same).select("lang", "gram", ((c - F.col("d")) / F.col("all")).alias("alpha"), "left")
        if n == 1:
            rows = rows.withColumn("p", F.col("alpha") + F.col("left"))
        else:
            less = out[-1][0].select(F.col("lang").alias("lang_l"), F.col("gram").alias("gram_l"), F.col("p").alias("p_l"))
            same = F.col("lang").eqNullSafe(F.col("lang_l")) & (F.expr(f"substring(gram, 2, {n - 1})") == F.col("gram_l"))
            rows = rows.join(less, same).withColumn("p", F.col("alpha") + F.col("left") * F.col("p_l"))
        rows = rows.select("lang", "gram", "p")
        out.append((stored(rows, f"chances-{n}") if n < ORDER else rows, contexts.select(F.col("lang_c").alias("lang"), F.col("context_c").alias("context"), "left")))
    return out


def interpolated(counts: DataFrame) -> DataFrame:
    """``lang, gram, log_p`` of the highest order, from its counts."""
    return interpolated_orders(counts)[-1][0].select("lang", "gram", F.log("p").alias("log_p"))


def discounts_of(grams: DataFrame) -> DataFrame:
    """``lang_d, d1, d2, d3``: the discounts of n-grams seen once, twice, and more often."""
    n = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    counts = grams.groupBy(F.col("lang").alias("lang_d")).agg(*n)
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    bounded = lambda k: F.when(F.col(f"n{k}") > 0, F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(F.lit(k * 0.5))
    return counts.select("lang_d", bounded(1).alias("d1"), bounded(2).alias("d2"), bounded(3).alias("d3"))


def hashed(rows: DataFrame, order: int, weight: bool) -> DataFrame:
    """``hash, log_p`` of ``lang, gram, log_p``, the n-grams being of one order, or the contexts of one with ``weight``."""
    before, after = "\0" * (ORDER - order), "\0" * weight

    def look(batches):
        for batch in batches:
            langs, grams, log_p = batch.columns
            windows = "".join(before + g + after for g in grams.to_pylist())
            points = np.frombuffer(windows.encode("utf-32-le", "surrogatepass"), np.uint32)
            found = gram_hashes(points, np.arange(len(grams)) * ORDER, language_hash(langs.to_pylist()), order, weight) if len(grams) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), log_p.cast(pa.float32())], names=["hash", "log_p"])

    return rows.mapInArrow(thrifty(look), "hash long, log_p float")


def fit(docs: DataFrame) -> str:
    """Fit a model on all of ``docs`` (``text``, ``lang``); the folder of its sorted arrays."""
    spark = docs.sparkSession
    with small_batches(spark, 2 * BATCH_CHARS):
        counts = stored(counted(docs), f"grams-{ORDER}")
    arrays, size = None, counts.count()
    for n, (chances, contexts) in enumerate(interpolated_orders(counts), 1):
        size += contexts.count() + (chances.count() if n < ORDER else 0)
        for rows, weight in ((chances.select("lang", "gram", F.log("p").alias("log_p")), False), (contexts.select("lang", "context", F.log("left").alias("log_p")), True)):
            some = hashed(rows, n, weight)
            arrays = some if arrays is None else arrays.union(some)
    folder = new_path(spark, "perplexity-model")
    # hashes are evenly spread: a part is any share of them
    arrays.repartition(max(1, -(-size // PART_ROWS)), "hash").sortWithinPartitions("hash").write.parquet(folder)
    return folder


class SortedArrays:
    """A model's parts, read from the shared folder when they are asked for; at most ``HELD_PARTS`` stay."""

    def __init__(self, folder: str, parts: list[str]):
        self.system, self.base = file_system(folder)
        self.parts = parts
        self.held: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}

    def part(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        if name not in self.held:
            if len(self.held) >= HELD_PARTS:
                self.held.pop(next(iter(self.held)))
            with pq.ParquetFile(f"{self.base}/{name}", filesystem=self.system) as file:
                number = file.metadata.num_rows
                keys, values, at = np.full(number + 1, np.iinfo(np.int64).max), np.full(number + 1, np.float32("nan")), 0
                for rows in file.iter_batches(READ_ROWS, columns=["hash", "log_p"]):
                    keys[at : at + len(rows)], values[at : at + len(rows)] = rows.column("hash").to_numpy(), rows.column("log_p").to_numpy()
                    at += len(rows)
            bits = max(1, number.bit_length())
            # hashes are evenly spread: where keys with the same first bits start, about one key is to be looked at
            starts = np.empty((1 << bits) + 1, np.int32)
            for at in range(0, len(starts), READ_ROWS):
                firsts = (np.arange(at, min(at + READ_ROWS, 1 << bits), dtype=np.uint64) << U(64 - bits)) ^ SIGN
                starts[at : at + len(firsts)] = np.searchsorted(keys[:number], firsts.view(np.int64))
            starts[-1] = number
            self.held[name] = keys, values, starts, bits
        return self.held[name]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Log-probabilities; NaN where the model does not have the n-gram."""
        out = np.full(len(hashes), np.nan)
        for name in self.parts:
            keys, values, starts, bits = self.part(name)
            for first in range(0, len(hashes), LOOKED_UP):
                some, own = hashes[first : first + LOOKED_UP], out[first : first + LOOKED_UP]
                at = starts[(some.view(np.uint64) ^ SIGN) >> U(64 - bits)]
                todo = np.arange(len(some))
                while len(todo):
                    found = keys[at]
                    hit = found == some[todo]
                    own[todo[hit]] = values[at[hit]]
                    later = found < some[todo]
                    todo, at = todo[later], at[later] + 1
        return out


def log_chances(model: SortedArrays, points: np.ndarray, starts: np.ndarray, language: np.ndarray) -> np.ndarray:
    """The log-probability of each n-gram's last character after the others, backed off as far as needed."""
    hashes = np.empty(len(starts), np.int64)
    for at in range(0, len(starts), LOOKED_UP):
        some = slice(at, at + LOOKED_UP)
        hashes[some] = gram_hashes(points, starts[some], language[some])
    out = model.find(hashes)
    del hashes
    unknown = np.flatnonzero(np.isnan(out))
    for at in range(0, len(unknown), BACKED_OFF):
        lost = unknown[at : at + BACKED_OFF]
        lower = [(n, weight) for n in range(1, ORDER) for weight in (False, True)] + [(ORDER, True)]
        # one look-up for all orders, since parts may have to be read again for each
        hashes = np.empty((len(lower), len(lost)), np.int64)
        for row, x in zip(hashes, lower, strict=True):
            row[:] = gram_hashes(points, starts[lost], language[lost], *x)
        known = dict(zip(lower, model.find(hashes.reshape(-1)).reshape(len(lower), -1), strict=True))
        chance = np.where(np.isnan(known[1, True]), FLOOR, known[1, True])
        for n in range(1, ORDER + 1):
            if n > 1:  # a context that the model does not have leaves everything
                chance = chance + np.nan_to_num(known[n, True])
            if n < ORDER:
                chance = np.where(np.isnan(known[n, False]), chance, known[n, False])
        out[lost] = chance
    return out


def part_names(spark: SparkSession, folder: str) -> list[str]:
    """The files of a model; their number is bounded by its size over ``PART_ROWS``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path")
    return sorted(r.path.rsplit("/", 1)[1] for r in files.collect())


def metrics(texts: list[str]) -> dict[str, np.ndarray]:
    """The rule counts of each text."""
    raw = [t.encode() for t in texts]
    words, counts = word_hashes(raw, ~WHITE)
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    inside = ~WHITE[data] & ((data & 0xC0) != 0x80)
    sums = lambda mask: np.bincount(owner[mask], minlength=len(raw))
    lines = []
    for text in texts:
        own = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        lines.append(len(own) - len(set(own)))
    # words in windows found twice or more
    repeated = np.zeros(len(words), bool)
    whose = np.repeat(np.arange(len(raw)), counts)
    if len(words) >= REPEAT_WINDOW:
        last = len(words) - REPEAT_WINDOW + 1
        window = np.zeros(last, np.uint64)
        for at in range(REPEAT_WINDOW):
            window = mixed(window * POSITIONS[0] + words[at : at + last])
        start = np.flatnonzero(whose[:last] == whose[REPEAT_WINDOW - 1 :])
        window = mixed(window[start] ^ mixed(whose[start].astype(np.uint64)))
        _, inverse, times = np.unique(window, return_inverse=True, return_counts=True)
        hit = start[times[inverse] > 1]
        for at in range(REPEAT_WINDOW):
            repeated[hit + at] = True
    return {
        "n_words": counts,
        "word_chars": sums(inside),
        "n_symbols": sums(SYMBOL[data]),
        "n_dup_lines": np.array(lines),
        "n_repeat_words": np.bincount(whose[repeated], minlength=len(raw)),
    }


def measured(folder: str, parts: list[str]) -> callable:
    """An Arrow function from texts and languages to the rule counts and the mean negative log-probability."""
    built: list[SortedArrays] = []
    fields = [(n.split()[0], pa.int64()) for n in METRICS.split(", ")]

    def measure(texts: pa.Array, languages: pa.Array) -> pa.Array:
        if not built:
            built.append(SortedArrays(folder, parts))
        langs = language_hash(languages.to_pylist())
        chunks = []
        for a, b in column_parts(texts, BATCH_CHARS // 4):
            bodies = texts.slice(a, b - a).to_pylist()
            counts = [metrics(bodies[c:d]) for c, d in column_parts(texts.slice(a, b - a), BATCH_CHARS // 16)]
            found = {n: np.concatenate([c[n] for c in counts]) for n, _ in fields}
            points, sizes = code_points(bodies)
            starts, owner = window_starts(sizes)
            mean = -np.bincount(owner, log_chances(built[0], points, starts, langs[a:b][owner]), b - a) / np.maximum(sizes, 1)
            arrays = [pa.array(found[n].astype(np.int64)) for n, _ in fields] + [pa.array(mean, mask=sizes == 0)]
            chunks.append(pa.StructArray.from_arrays(arrays, names=[n for n, _ in fields] + ["nats"]))
            del bodies, counts, found, points, sizes, starts, owner, mean, arrays
        give_back()
        return pa.concat_arrays(chunks) if chunks else pa.array([], pa.struct([*fields, ("nats", pa.float64())]))

    return F.arrow_udf(measure, f"struct<{METRICS.replace(' long', ':long')}, nats:double>").asNondeterministic()


def model_of(half: Column) -> Column:
    """The name of the model that a half of a language's texts teaches, used in place of the language."""
    return F.concat(half.cast("string"), F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("-")))


def quality(docs: DataFrame, folder: str | None = None, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """``doc_id``, the rule counts, ``base_failed``, ``kept`` and ``perplexity`` (a character) of every row.

    Null texts have no words; texts without characters have no perplexity and fail the rules. ``folder`` is that of a
    model fitted on other documents; by default each half of ``docs`` is scored by the model of the other half.
    A null language is a language of its own. Where the other half has nothing of a language, its texts
    all have the same perplexity, that of the floor, and none lies outside the band.
    """
    spark = docs.sparkSession
    name = F.col("lang")
    if folder is None:
        half = F.pmod(F.xxhash64(F.lower(whole_text())), F.lit(HALVES))  # copies share a half
        folder, name = fit(docs.select("text", model_of(half).alias("lang"))), model_of((half + 1) % HALVES)
    found = measured(folder, part_names(spark, folder))(whole_text(), name)
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text"), found.alias("f"))
    with small_batches(spark, 2 * BATCH_CHARS):
        rows = stored(rows.select("doc_id", "lang", "f.*"), "quality-measures")
    failed: Column = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    band = band_of(rows.filter(~failed), lower, upper)
    inside = F.coalesce(F.col("nats").between(F.col("least"), F.col("most")), F.lit(False))
    return rows.join(band, F.col("lang").eqNullSafe(F.col("lang_b")), "left").select(
        "doc_id", *(n.split()[0] for n in METRICS.split(", ")), failed.alias("base_failed"), (~failed & inside).alias("kept"), F.exp("nats").alias("perplexity")
    )


def band_of(rows: DataFrame, lower: float, upper: float) -> DataFrame:
    """``lang_b, least, most``: the band of each language, from ``lang`` and ``nats`` of documents that pass the rules."""
    at = F.percentile_approx("nats", F.array(*map(F.lit, (0.25, 0.5, 0.75))), 10_000)
    q1, middle, q3 = (F.col("quartiles")[k] for k in range(3))
    share = LEAST_SHARE * middle
    return rows.groupBy(F.col("lang").alias("lang_b")).agg(at.alias("quartiles"), (1 + FEW / F.sqrt(F.count("nats"))).alias("wider")).select(
        "lang_b",
        (middle - F.greatest(lower * F.col("wider") * (middle - q1), share)).alias("least"),
        (middle + F.greatest(upper * F.col("wider") * (q3 - middle), share)).alias("most"),
    )
