"""Operator 1: personal data by patterns, and by contexts that the patterns' own finds teach.

Base finds are seeds. The words in front of a find are a lexical pattern of its kind. Patterns and
instances are a bipartite graph: a pattern scores by the belief in the instances it stands in front of, against
all identifiers it stands in front of; an instance that is no seed is believed in as its
patterns score. After some rounds, identifiers of a fitting shape behind high-scoring patterns are new finds.

Everything is DataFrame expressions. Offsets come from the lengths of matches and of the
gaps between them, so they count code points and need no second search.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import texts
from outcome_lens.session import durable, stored

# Kinds in order, and their patterns. Repeats are possessive and starts look behind, which finds
# the same leftmost spans without trying a run of characters again from each of its characters.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# identifiers that may be found by context: words of digits, few letters and signs; addresses in disguise
IDENTIFIER = (
    r"(?<![0-9A-Za-z@._/-])(?:[A-Za-z]{0,4}[0-9][0-9A-Za-z()./:-]{4,40}+|[A-Za-z0-9._-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9.-]{1,64}+)"
)
SHAPES = {
    "email": r"[(\[]at[)\]]",
    "ip": r"^[0-9]{1,3}([.:-][0-9]{1,3}){3,}$|^[0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4}){4,7}$",
    "card": r"^[0-9]([.-]?[0-9]){11,18}$",
    "phone": r"^[0-9(]([()./-]?[0-9]){6,14}$",
}
CONTEXT_CHARS = 80  # in front of a find, enough for its last words
ROUNDS = 3
LEAST_SUPPORT = 5.0  # believed distinct instances of a pattern
LEAST_SCORE = 0.9
FIND = "array<struct<start:long,end:long,found:string,before:string>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def small_part(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | (F.length(bare) == 3) & (bare <= "255")


def holds(kind: str, found: Column) -> Column:
    """The condition on a match of a kind."""
    if kind == "ip":
        return F.forall(F.split(found, r"\."), small_part)
    if kind == "card":
        return F.call_function("luhn_check", digits(found))
    if kind == "phone":
        return F.length(digits(found)).between(9, 15)
    return F.lit(True)


def finds(text: Column, matches: Column, pattern: str, keep) -> Column:
    """Start, end, match and what stands in front of it, for the matches of a pattern that ``keep`` holds for."""
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(FIND).alias("out"))

    def add(done: Column, pair: Column) -> Column:
        first = done["at"] + F.length(pair["gap"])
        end = first + F.length(pair["found"])
        before = F.substring(pair["gap"], -CONTEXT_CHARS, CONTEXT_CHARS)
        one = F.struct(first.alias("start"), end.alias("end"), pair["found"].alias("found"), before.alias("before"))
        return F.struct(end.alias("at"), F.when(keep(pair["found"]), F.array_append(done["out"], one)).otherwise(done["out"]).alias("out"))

    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("found"), g.alias("gap")))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, add)["out"]).otherwise(F.array().cast(FIND))


def base_finds(docs: DataFrame) -> DataFrame:
    """``doc_id, content``, one array of finds a kind, and ``others``: identifiers that no base find overlaps."""
    text = F.col("text")
    none = F.array().cast("array<string>")
    digit = text.rlike("[0-9]")
    gate = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}
    patterns = BASE | {"others": IDENTIFIER}
    rows = texts(docs).select(
        "doc_id", F.xxhash64("text").alias("content"), "text",
        *(F.when(gate.get(k, digit | F.contains(text, F.lit("at"))), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(k) for k, p in patterns.items()),
    )
    known = [F.col(k) for k in KINDS]
    shaped = lambda found: reduce(Column.__or__, (found.rlike(p) for p in SHAPES.values()))
    rows = rows.select("doc_id", "content", *(finds(text, F.col(k), p, (lambda found, k=k: holds(k, found)) if k in KINDS else shaped).alias(k) for k, p in patterns.items()))
    apart = lambda o: ~F.exists(F.concat(*known), lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))
    return rows.withColumn("others", F.filter("others", apart))


def contexts(before: Column) -> Column:
    """The last word, and the last two words, in front of a find on its line; words without digits."""
    line = F.element_at(F.split(before, "\n"), -1)
    two = F.regexp_extract(F.lower(line), r"([^\s0-9]+)[ \t]+([^\s0-9]+)[ \t]*$", 0)
    one = F.regexp_extract(F.lower(line), r"(?:^|\s)([^\s0-9]+)[ \t]*$", 1)
    folded = lambda c: F.regexp_replace(F.trim(c), r"\s+", " ")
    return F.array_distinct(F.filter(F.array(folded(one), folded(two)), lambda c: c != ""))


def mentions(found: DataFrame) -> DataFrame:
    """A row a find, or identifier and kind it may be: where it is, its instance, its patterns, and whether it is a seed."""
    seeds = [
        found.select("doc_id", "content", F.lit(k).alias("kind"), F.explode(k).alias("f"), F.lit(True).alias("seed")) for k in KINDS
    ]
    fitting = F.filter(F.array(*(F.when(F.col("f.found").rlike(p), F.lit(k)) for k, p in SHAPES.items())), lambda k: k.isNotNull())
    others = found.select("doc_id", "content", F.explode("others").alias("f"))
    others = others.select("doc_id", "content", F.explode(fitting).alias("kind"), "f", F.lit(False).alias("seed"))
    rows = reduce(DataFrame.unionByName, [*seeds, others])
    return rows.select(
        "doc_id", "content", "kind", "seed", F.col("f.start").alias("start"), F.col("f.end").alias("end"),
        F.lower("f.found").alias("instance"), contexts(F.col("f.before")).alias("patterns"),
    )


def pattern_scores(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, pattern, score`` of the patterns with enough support, after some rounds over the graph."""
    edges = durable(found.select("kind", "instance", "seed", F.explode("patterns").alias("pattern")).distinct())
    # what a pattern stands in front of, of any kind
    reach = durable(edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("reach")))
    scored = None
    for _ in range(rounds):
        believed = edges.withColumn("belief", F.col("seed").cast("double"))
        if scored is not None:
            doubt = F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))
            new = edges.filter("not seed").join(scored, ["kind", "pattern"]).groupBy("kind", "instance").agg((1 - doubt).alias("new"))
            believed = believed.join(new, ["kind", "instance"], "left").withColumn("belief", F.greatest("belief", F.coalesce("new", F.lit(0.0))))
        support = believed.groupBy("kind", "pattern").agg(F.sum("belief").alias("support"))
        ratio = F.col("support") / F.col("reach")
        scored = durable(
            support.filter(F.col("support") >= LEAST_SUPPORT).join(reach, "pattern").select("kind", "pattern", ratio.alias("score"))
        )
    return scored


def added_finds(found: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, content, kind, start, end`` of the identifiers that stand behind a high-scoring pattern."""
    rows = stored(mentions(found), "personal-mentions")
    good = pattern_scores(rows, rounds).filter(F.col("score") >= least_score)
    new = rows.filter("not seed").select("doc_id", "content", "kind", "start", "end", F.explode("patterns").alias("pattern"))
    best = new.join(good, ["kind", "pattern"]).groupBy("doc_id", "content", "start", "end")
    return best.agg(F.max(F.struct("score", "kind"))["kind"].alias("kind"))


def personal_data(docs: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per document: numbers of base finds by kind, their digest, and all spans as text.

    Spans are ``kind:start:end``, ordered by kind and start. Null texts are empty. Rows
    that repeat a document have its spans each; documents that share an id are told apart by their texts.
    """
    found = stored(base_finds(docs), "personal-finds")
    order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    added = added_finds(found, rounds, least_score).groupBy("doc_id", "content").agg(
        F.collect_list(F.struct(order[F.col("kind")].alias("n"), "start", "end")).alias("added")
    )
    numbered = lambda n: lambda f: F.struct(F.lit(n).alias("n"), f["start"].alias("start"), f["end"].alias("end"))
    base = F.concat(*(F.transform(k, numbered(n)) for n, k in enumerate(KINDS)))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["n"]), s["start"], s["end"])), ",")
    same = found["doc_id"].eqNullSafe(added["doc_id"]) & (found["content"] == added["content"])
    rows = found.join(added, same, "left").withColumn("base", base)
    extra = F.coalesce(F.col("added"), F.array().cast("array<struct<n:int,start:long,end:long>>"))
    return rows.select(
        found["doc_id"],
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(F.array_sort(F.concat("base", extra))).alias("spans"),
        F.size(extra).cast("long").alias("n_added"),
    )
