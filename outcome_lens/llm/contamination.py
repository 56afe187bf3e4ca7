"""Operator 4: passages of benchmark items in documents, found with a suffix automaton of the items.

One generalised suffix automaton holds every item's words. A document's words run through it once; the
state and the length of the longest match ending at each word tell which windows end there. Items
come in blocks of bounded size, each with an automaton of its own, and every document runs
through all blocks; spans and items of earlier blocks travel along, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import WORD, give_back, texts, whole_text, words_of

WINDOW = 13  # words; a shorter item is one window
COVERAGE = 20  # contaminated: at least one word in so many is hit
BLOCK_CHARS = 2_000_000  # characters of items in one automaton
FOUND = "n_words long, longest long, spans array<struct<first:long,last:long>>, items array<string>, cuts array<struct<first:long,last:long>>"
WORDS = re.compile(WORD)
PAIRS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


class SuffixAutomaton:
    """Every run of words of the items, one state for the runs that end at the same places.

    ``step`` maps a state and a word to a state, ``length`` is the longest run of a state and ``link``
    the state of its longest suffix that ends in more places.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[str]]], window: int):
        self.window = window
        self.step: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        kept = [(key, words) for key, words in items if words]
        for _, words in kept:
            state = 0
            for word in words:
                state = self._extend(state, word)
        # what a match in a state means: items with the window that ends there, and whole short items
        self.full: list[frozenset] = [frozenset()] * len(self.step)
        own: list[list] = [[] for _ in self.step]
        for key, words in kept:
            size = min(window, len(words))
            state = 0
            for at, word in enumerate(words):
                state = self.step[state][word]
                if at + 1 >= size:
                    holder = self._suffix(state, size)
                    if size == window:
                        self.full[holder] |= {key}
                    else:
                        own[holder].append((size, key))
        order = sorted(range(len(self.step)), key=self.length.__getitem__)
        self.short: list[tuple] = [()] * len(self.step)
        self.holder = [-1] * len(self.step)
        for state in order[1:]:
            up = self.link[state]
            self.short[state] = self.short[up] + tuple(own[state])
            if self.length[state] >= window:
                self.holder[state] = state if self.length[up] < window else self.holder[up]

    def _suffix(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a run in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _new(self, length: int, link: int, step: dict[str, int]) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, parent: int, word: str) -> int:
        """The state of ``parent``'s longest run and ``word``, cut off from longer runs if it has to be."""
        child = self.step[parent][word]
        if self.length[child] == self.length[parent] + 1:
            return child
        copy = self._new(self.length[parent] + 1, self.link[child], dict(self.step[child]))
        self.link[child] = copy
        while parent >= 0 and self.step[parent].get(word) == child:
            self.step[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: str) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word)
        return state

    def matches(self, words: list[str]) -> tuple[list[list[int]], set, int]:
        """Hit spans of words (end exclusive, merged), the items found, and the longest match."""
        step, link, length, holder, short, window = self.step, self.link, self.length, self.holder, self.short, self.window
        state = now = longest = 0
        spans: list[list[int]] = []
        items: set = set()
        for at, word in enumerate(words, 1):
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                now = length[state]
                after = step[state].get(word)
            if after is None:
                continue
            state = after
            now += 1
            if now > longest:
                longest = now
            size = 0
            if now >= window and self.full[holder[state]]:
                items |= self.full[holder[state]]
                size = window
            for whole, key in short[state]:
                if whole <= now:
                    items.add(key)
                    size = max(size, whole)
            if size:
                first = at - size
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, at])
        return spans, items, longest


def merged(spans: Iterable[Iterable[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(map(tuple, spans)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> list[list[tuple]]:
    """``(item_id, text)`` rows in blocks of about ``block_chars`` characters, dealt by a hash of the id."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), whole_text().alias("text")).distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return [[(r.item_id, r.text) for r in dealt.filter(F.col("block") == b).collect()] for b in range(blocks)]


def with_contamination(docs: DataFrame, items: DataFrame, name: str, window: int = WINDOW) -> DataFrame:
    """``docs`` and one more column ``name``: a struct of what was found in ``text``.

    Fields: ``n_words``; ``longest`` matched run of words; ``spans`` of hit words (end exclusive,
    merged); ``items`` found, sorted as strings; ``cuts``, the characters of the spans. Null texts and items
    have no words. Repeated items count once; an item without an id hits words and is not listed.
    """
    spark = docs.sparkSession
    empty = "named_struct('n_words', 0L, 'longest', 0L, 'spans', cast(array() as array<struct<first:long,last:long>>), 'items', cast(array() as array<string>), 'cuts', cast(array() as array<struct<first:long,last:long>>))"
    out = docs.withColumn(name, F.expr(empty))
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)
        out = out.withColumn(name, _search(shared, window)(whole_text(), F.col(name)))
    return out


def _search(shared, window: int):
    built: list[SuffixAutomaton] = []

    def search(text: pa.Array, before: pa.Array) -> pa.Array:
        if not built:
            built.append(SuffixAutomaton(((key, words_of(body, WORDS)) for key, body in shared.value), window))
        rows = []
        for one, had in zip(text.to_pylist(), before.to_pylist(), strict=True):
            words = words_of(one, WORDS)
            spans, found, longest = built[0].matches(words)
            row = {**had, "n_words": len(words), "longest": max(longest, had["longest"])}
            if spans:
                spans = merged([*spans, *((s["first"], s["last"]) for s in had["spans"])])
                places = [m.span() for m in WORDS.finditer(one.encode().lower().decode())]
                row["spans"] = [{"first": a, "last": b} for a, b in spans]
                row["cuts"] = [{"first": places[a][0], "last": places[b - 1][1]} for a, b in spans]
                row["items"] = sorted({*had["items"], *found} - {None})
            rows.append(row)
        out = pa.array(rows, pa.struct([("n_words", pa.int64()), ("longest", pa.int64()), ("spans", PAIRS), ("items", pa.list_(pa.string())), ("cuts", PAIRS)]))
        del rows
        give_back()
        return out

    return F.arrow_udf(search, f"struct<{FOUND}>").asNondeterministic()


def hit_words(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])


def contaminated(found: Column, coverage: int = COVERAGE) -> Column:
    hit = hit_words(found)
    return (hit > 0) & (coverage * hit >= found["n_words"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """One row per document: words, hit words, items found (number and digest), verdict, and longest match."""
    found = F.col("found")
    return with_contamination(texts(docs), items, "found", window).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        hit_words(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found["items"]), 256).alias("items_sha256"),
        contaminated(found, coverage).alias("contaminated"),
        found["longest"].alias("longest_match"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """``docs`` without contaminated rows; in the rows that stay, hit spans are cut out of the text.

    A cut leaves one line break. ``n_chars`` is counted anew where a text was cut; rows without a
    hit stay as they are, null texts too.
    """
    name = "found_in_benchmark"
    while name in docs.columns:
        name += "_"
    found, text = F.col(name), F.col("text")
    whole = F.struct(F.array_append(found["cuts"], F.struct(F.length(text).cast("long").alias("first"), F.length(text).cast("long").alias("last"))).alias("cuts"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("kept"))
    cut = F.aggregate(
        whole["cuts"],
        start,
        lambda done, c: F.struct(
            c["last"].alias("at"),
            F.concat(done["kept"], F.when(done["at"] > 0, "\n").otherwise(""), F.substring(text, done["at"].cast("int") + 1, (c["first"] - done["at"]).cast("int"))).alias("kept"),
        ),
    )["kept"]
    kept = with_contamination(docs, items, name, window).filter(~contaminated(found, coverage))
    kept = kept.withColumn("text", F.when(F.size(found["cuts"]) > 0, cut).otherwise(text))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.size(found["cuts"]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.drop(name)
