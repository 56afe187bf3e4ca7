"""Phrases, alignments and class-based scores against brute force, on made cases and on the small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from outcome_lens.contract import AnalysisError
from outcome_lens.llm import alignment, class_model, collocations, pieces
from outcome_lens.llm.queries import byte_bpe, piece_bpe

DOCS = "doc_id long, text string, lang string, n long, word string, phrase string, chunk long, found string, links string, held string, score double"
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *([None] * 8)) for r in rows], DOCS)


def lower(text):
    return (text or "").encode().lower().decode()


# ---- phrases


def phrases_of(rows, least, top, inside=50):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update((k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for (k, _), v in f.items() if k == 1)
        candidates = {p: (k, v) for (k, p), v in f.items() if k > 1 and v >= least}
        rows = []
        for phrase, (size, a) in candidates.items():
            words = phrase.split(" ")
            longer = [v for p, (k, v) in candidates.items() if k > size and any(p.split(" ")[i : i + size] == words for i in range(k - size + 1))]
            if any(100 * v >= inside * a for v in longer):
                continue
            cuts = []
            for k in range(1, size):
                left, right = f[k, " ".join(words[:k])], f[size - k, " ".join(words[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows.append((-score, -a, phrase.encode(), (lang, phrase, a, left, right, n, score)))
        out += [(r[3][0], i + 1, *r[3][1:]) for i, r in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found_phrases(df, **options):
    return sorted(tuple(r)[:8] for r in collocations.collocations(df, **options).collect())


def drawn(seed, words, texts=60):
    rng = random.Random(seed)
    marks = ["", "", "", "", ",", ".", "\n", "!", "\t"]
    return [(i, " ".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "de"])) for i in range(texts)]


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_phrases_equal_brute_force(spark, bits):
    """A filter of 64 bits lets everything through: the result is the same."""
    rows = drawn(3, ["The", "the", "of", "é", "\U0001f600", "a\x01b", "x", "Ýa"])
    assert found_phrases(frame(spark, rows), least=4, top=50, filter_bits=bits) == phrases_of(rows, 4, 50)


def test_phrases_do_not_depend_on_shards(spark, monkeypatch):
    rows = drawn(4, ["one", "two", "three", "four"])
    monkeypatch.setattr(collocations, "SHARD_BYTES", 200)
    assert found_phrases(frame(spark, rows).repartition(7), least=3, top=9) == phrases_of(rows, 3, 9)


def test_phrases_on_awkward_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (3, " \t\n..", "en"), (None, "a b " * 30_000, "en"), (4, "a b", "en"), (4, "a b", "en"), (5, "solo", None)]
    df = frame(spark, rows)
    assert found_phrases(df) == phrases_of(rows, 10, 2000)
    assert found_phrases(df.limit(0)) == []


def test_a_shard_with_many_words_is_sorted_all_the_same(monkeypatch):
    """Word ids that do not fit side by side into 64 bits are sorted as columns."""
    ids = np.array([0, 5, 2, 5, 2, 7, 0, 5, 2, 0], np.int32)
    plain = collocations.Rows(ids, 8, 3)
    wide = collocations.Rows(ids, 1 << 22, 3)
    assert np.array_equal(plain.transform, wide.transform) and np.array_equal(plain.mapping, wide.mapping)


def test_intervals_of_both_directions_agree():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[0], rng.integers(0, 6, 400), [0]]).astype(np.int32)
    index = collocations.ShardIndex(ids, 6, 3)
    text = ids.tolist()
    for first_left in (True, False):
        found = index.extended(index.extended(index.single_words(), first_left), not first_left)
        want = Counter(tuple(text[i : i + 3]) for i in range(len(text) - 2) if 0 not in text[i : i + 3])
        assert {tuple(map(int, w)): int(n) for *w, n in zip(*found.words, found.size, strict=True)} == want
        for start, back, n, *words in zip(found.start, found.back, found.size, *found.words, strict=True):
            # the symbols in front of the rows of the n-gram are those in front of its places in the text
            places = [i for i in range(len(text) - 2) if tuple(text[i : i + 3]) == tuple(words)]
            assert Counter(index.forward.transform[start : start + n].tolist()) == Counter(text[i - 1] for i in places)
            assert Counter(index.backward.transform[back : back + n].tolist()) == Counter(text[i + 3] for i in places)


# ---- alignments


def alignment_of(texts, a, b):
    per, counts = [], Counter()
    for text in texts:
        links, groups, row = [], [], (0, 0, 0, 0, "")
        if text:
            whole = (" " + text).encode()
            one, two = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
            if b"".join(a.bytes[i] for i in one) == whole == b"".join(b.bytes[i] for i in two):
                ends = dict(zip(np.cumsum([len(a.bytes[i]) for i in one]).tolist(), range(len(one)), strict=True))
                at = done_a = done_b = 0
                for k, i in enumerate(two):
                    at += len(b.bytes[i])
                    if at in ends:
                        last = ends[at]
                        links.append((one[last], i))
                        groups.append(",".join(map(str, one[done_a : last + 1])) + "|" + ",".join(map(str, two[done_b : k + 1])))
                        done_a, done_b = last + 1, k + 1
                row = (len(one), len(two), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest())
        counts.update(links)
        per.append((row, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(*row[:4], sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), row[4]) for row, links in per]


@pytest.fixture(scope="module")
def tokenizers():
    return pieces.ByteTokenizer(byte_bpe()), pieces.PieceTokenizer(piece_bpe())


def test_alignment_equals_brute_force(spark, tokenizers):
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "'s", "é", "é", "日", "\U0001f600", "<|endoftext|>", "<s>", "▁", "\x00", "The", " the", "1", "23", "...", "​", "\xa0", "<0x0A>"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))), None) for i in range(1500)]
    rows += [(2000, None, None), (None, "the  end", None), (7, "the  end", None), (8, "word " * 40_000, None)]
    got = alignment.aligned(frame(spark, rows), byte_bpe(), piece_bpe()).collect()
    want = [(r[0], *w) for r, w in zip(rows, alignment_of([r[1] for r in rows], *tokenizers), strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_alignment_of_the_small_table(spark, tokenizers):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in alignment.aligned(docs, byte_bpe(), piece_bpe()).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, alignment_of([r.text for r in rows], *tokenizers), strict=True)}


def test_alignments_give_back_the_tokens(spark, tokenizers):
    a, b = tokenizers
    rows = [(1, "Some words, aligned.\nSo be it", None), (2, "", None)]
    one, two = alignment.alignments(frame(spark, rows), byte_bpe(), piece_bpe()).orderBy("doc_id").collect()
    assert one.a_ids == a.tokenizer.encode(" " + rows[0][1], add_special_tokens=False).ids and one.b_ids == b.model.encode(rows[0][1])
    assert sum(one.a_per_group) == len(one.a_ids) and sum(one.b_per_group) == len(one.b_ids)
    ends_a = np.cumsum([sum(len(a.bytes[i]) for i in one.a_ids[e - n : e]) for e, n in zip(np.cumsum(one.a_per_group), one.a_per_group, strict=True)])
    ends_b = np.cumsum([sum(len(b.bytes[i]) for i in one.b_ids[e - n : e]) for e, n in zip(np.cumsum(one.b_per_group), one.b_per_group, strict=True)])
    assert ends_a.tolist() == ends_b.tolist()
    assert (two.a_ids, two.b_ids, two.a_per_group, two.b_per_group) == ([], [], [], [])
    assert alignment.aligned(frame(spark, rows).limit(0), byte_bpe(), piece_bpe()).count() == 0


def test_overlaps_of_crossing_tokens():
    found = alignment.coalesced(np.array([2, 3, 1]), np.array([3, 1, 2]))
    assert found.group_a.tolist() == [0, 0, 0] and found.group_b.tolist() == [0, 0, 0]
    pairs = set(zip(found.pair_a.tolist(), found.pair_b.tolist(), strict=True))
    assert pairs == {(0, 0), (1, 0), (1, 1), (1, 2), (2, 2)}
    assert [p for p, t in zip(zip(found.pair_a.tolist(), found.pair_b.tolist(), strict=True), found.together, strict=True) if t] == [(2, 2)]


def test_only_tokenizers_that_can_be_cut_are_opened():
    import public_tokenizers

    with pytest.raises(AnalysisError, match="not a plain byte-level"):
        pieces.ByteTokenizer(public_tokenizers.path("word_bpe_49k.json"))


# ---- class-based scores


def base_of(rows):
    words = re.compile("[^\x20\x09-\x0d]+")
    tokens = [words.findall(lower(text)) + ["\n"] for _, text, _ in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _, _ in rows]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for t, h in zip(tokens, held, strict=True)]


def test_class_scores_have_the_base_of_brute_force(spark):
    rows = [*drawn(8, ["A", "b", "cc", "é", "x."]), (None, None, None), (501, "", None), (502, "word and " * 20_000, None), (502, "word and", None)]
    got = class_model.class_scores(frame(spark, rows), classes=4, rounds=2, frequent=0.001).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    want = sorted([(r[0], *w) for r, w in zip(rows, base_of(rows), strict=True)], key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and math.isfinite(g[6]) and g[6] <= 0


def test_class_scores_without_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = class_model.class_scores(frame(spark, [(held, "never seen", "en")])).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)
    assert class_model.class_scores(frame(spark, []), classes=2).count() == 0


def test_classes_follow_the_grammar(spark):
    """Texts in which a word of one kind follows a word of the other: the model finds the kinds, and orders texts by them."""
    rng = random.Random(6)
    nouns, verbs = [f"n{i}" for i in range(30)], [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(nouns) + " " + rng.choice(verbs) for _ in range(40)), None) for i in range(60)]
    rows += [(1000 + i, " ".join(rng.choice(nouns) + " " + rng.choice(nouns) for _ in range(40)), None) for i in range(100) if zlib.crc32(str(1000 + i).encode()) % 7 == 2]
    out = class_model.class_scores(frame(spark, rows), classes=3, rounds=4, frequent=0.004).collect()
    usual = [r.score / r.n_tokens for r in out if r.held_out and r.doc_id < 1000]
    strange = [r.score / r.n_tokens for r in out if r.held_out and r.doc_id >= 1000]
    assert usual and strange and min(usual) > max(strange) + 0.1
    assert all(r.score > r.base_score for r in out if r.held_out and r.doc_id < 1000)


def test_class_model_probabilities_sum_to_one():
    """Over all known words and one unseen word, behind every class and behind an unseen word."""
    rng = np.random.default_rng(2)
    classes, counts = rng.integers(0, 4, 50), rng.integers(1, 9, 50)
    sizes, kinds = np.bincount(classes, counts, 4), np.bincount(classes, minlength=4)
    between = rng.integers(0, 5, (4, 4)).astype(float)
    between[2] = 0
    model = class_model.ClassModel(int(counts.sum()), 50, 0.6, sizes, kinds, between, 1)
    words = np.arange(51)
    own, c = np.append(classes, -1), np.append(counts, -1)
    for before in range(-1, 4):
        first = {-1: 50}.get(before, int(np.flatnonzero(classes == before)[0]) if before >= 0 else 50)
        total = sum(10 ** (model.steps(np.array([2]), own[[first, w]])[1] + model.shares(c, own)[w]) for w in words)
        assert total == pytest.approx(1.0)


def test_a_gain_is_that_of_the_whole_objective():
    """For a word outside all classes, the best class is one of the first two of brute force, which also counts the word next to itself."""
    rng = np.random.default_rng(3)
    between = rng.integers(0, 40, (5, 5)).astype(float)
    f = lambda x: float(np.sum(np.where(x > 0, x * np.log(np.maximum(x, 1)), 0)))
    whole = lambda m: f(m) - f(m.sum(1)) - f(m.sum(0))
    for _ in range(20):
        behind, ahead = rng.integers(0, 6, 5), rng.integers(0, 6, 5)
        gains = []
        for y in range(5):
            m = between.copy()
            m[y] += behind
            m[:, y] += ahead
            gains.append(whole(m))
        some = [(k, n) for k, n in enumerate([*behind, *ahead]) if n]
        best = class_model.best_classes(np.zeros(len(some), int), np.array([k for k, _ in some]), np.array([n for _, n in some]), np.array([-1]), between)
        ranked = np.argsort(gains)[::-1]
        assert best[0] in ranked[:2]


def test_counted_neighbours_are_those_listed(spark, monkeypatch):
    """Words whose neighbours are counted before they move get the classes that lists give."""
    rows = drawn(11, [f"w{i % 7}x{i}" for i in range(60)], texts=80)
    found = []
    for most in (1, 10**9):
        monkeypatch.setattr(class_model, "MOST_LISTED", most)
        out = class_model.class_scores(frame(spark, rows), classes=5, rounds=2, frequent=0.02).collect()
        found.append(sorted((r.doc_id, round(r.score, 9)) for r in out))
    assert found[0] == found[1]


# ---- token ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library_for_any_text(name):
    """Control characters, odd white space and strings of added tokens included; a tokenizer of another kind sees whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from outcome_lens.llm.token_ids import TextEncoder

    path = public_tokenizers.path(name)
    encoder, library = TextEncoder(path, 0), Tokenizer.from_file(path)
    assert (encoder.pieces is None) == (name != "byte_bpe_50k.json")
    rng = random.Random(7)
    parts = ["a", "B", " ", " ", "  ", "\n", "\t", "\x1c", "\x1d", "\x1f", "\x85", "　", "'s", "'ll", "é", "é", "日", "<|endoftext|>", "\x00", " the", "1", "23", ".", "​", "\xa0", "\r"]
    texts = ["", "\x1c's  x", "  \x1c's", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 10))) for _ in range(3000))]
    ids, sizes = encoder.encode(texts)
    assert [own.tolist() for own in np.split(ids, np.cumsum(sizes)[:-1])] == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert [len(x) for x in encoder.encode([])] == [0, 0]


def test_batches_of_tokenizers_are_small(monkeypatch):
    """What a worker holds at a time: 1.5 MB of text for two tokenizers."""
    import pyarrow as pa

    from outcome_lens.llm import alignment

    seen = []
    monkeypatch.setattr(alignment, "AlignedBatch", lambda bodies, a, b: seen.append(sum(map(len, bodies))))
    monkeypatch.setattr(alignment, "ByteTokenizer", lambda path: None)
    monkeypatch.setattr(alignment, "PieceTokenizer", lambda path: None)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": ["word " * 20_000] * 60})
    assert sum(len(ids) for ids, _ in alignment.aligned_batches([batch], "", "")) == 60
    assert max(seen) <= 1.5 * 2**20 and sum(seen) == 60 * 100_000


# ---- memory of the class model


def test_workers_of_the_class_model_hold_little(spark, monkeypatch):
    """They get about a chunk at a time, give memory back when a task ends, and work out gains and tokens in narrow arrays."""
    import tracemalloc

    import pyarrow as pa

    setting, sent, ended = "spark.sql.execution.arrow.maxBytesPerBatch", {}, []
    before, write, thrifty = spark.conf.get(setting), class_model.stored_alone, class_model.thrifty
    monkeypatch.setattr(class_model, "stored_alone", lambda rows, name: sent.update({name: spark.conf.get(setting)}) or write(rows, name))
    monkeypatch.setattr(class_model, "thrifty", lambda work: ended.append(work.__name__) or thrifty(work))
    rows = [(k, f"the tree {k % 7} grows by the house") for k in range(40)]
    assert class_model.class_scores(spark.createDataFrame(rows, "doc_id long, text string"), classes=4).count() == 40
    assert set(sent.values()) == {str(class_model.SENT_BYTES)} and class_model.SENT_BYTES <= 4 << 20
    assert spark.conf.get(setting) == before
    assert set(ended) == {"make", "mark", "count", "move", "collect", "sum_up", "score"}
    rng = np.random.default_rng(1)
    owner = np.repeat(np.arange(2000), 30)
    code, n = rng.integers(0, 128, len(owner)), rng.integers(1, 9, len(owner))
    current, between = rng.integers(-1, 64, 2000), rng.integers(0, 50, (64, 64)).astype(float)
    tracemalloc.start()
    found = class_model.best_classes(owner, code, n, current, between)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 32 << 20
    one = [class_model.best_classes(np.zeros(30, np.int64), code[owner == k], n[owner == k], current[k : k + 1], between)[0] for k in range(0, 2000, 50)]
    assert found[::50].tolist() == one
    numbers = rng.integers(0, 2**31 - 1, 1000)
    tokens = class_model.unpacked(pa.scalar(class_model.packed(numbers)), 1000)
    assert tokens.tolist() == numbers.tolist() and tokens.itemsize == 4
