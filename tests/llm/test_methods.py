"""The training-data operators against brute force, on parts of the test tables and on made cases."""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from outcome_lens.llm import contamination, main_text, mixing, near_duplicates, perplexity, personal_data, queries, token_ids, toxicity, url_rules
from outcome_lens.llm.common import WORD
from outcome_lens.llm.queries import byte_bpe
from outcome_lens.llm.shingles import multisets
from outcome_lens.session import new_path

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(WORD)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def luhn(number):
    digits = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in digits) % 10 == 0


def base_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def holds(kind, found):
        bare = re.sub("[^0-9]", "", found)
        return {
            "email": lambda: True, "ip": lambda: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split(".")),
            "card": lambda: 13 <= len(bare) <= 19 and luhn(bare), "phone": lambda: 9 <= len(bare) <= 15,
        }[kind]()

    return [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, text) if holds(k, m[0])]


MADE = [
    "a@b.c-_x@d.e a@b@c.d é a.b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1", "5 4111 1111 1111 1111-", "x4111111111111111 4111-1111-1111-1111",
    "+1 (017) 555-7713 +12 +1..2..3..4..5..6..7..89 +1 2", "1 " * 30 + "4111 1111 1111 1111", "9" * 5000 + ".1" * 50, "\U0001f600 x@y.zz \U0001f600 +4930123456789",
]


def test_personal_data_base_and_contexts(spark, docs):
    calls = [f"please call Tel: +49 30 12345{i:03d} now" for i in range(30)]
    new = [f"please call Tel: 030-98765{i:03d} now" for i in range(5)]
    made = [(10_000 + i, t) for i, t in enumerate(MADE + calls + new)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    out = {r.doc_id: r for r in personal_data.personal_data(rows).collect()}
    for r in rows.collect():
        want = base_spans(r.text)
        assert out[r.doc_id].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.text[:80]
        assert set(want) <= set(filter(None, out[r.doc_id].spans.split(",")))
    found = [out[10_000 + len(MADE) + len(calls) + i].spans for i in range(5)]
    assert found == ["phone:17:29"] * 5  # numbers that no base pattern fits, behind words that stand before phones
    assert sum(r.n_added for r in out.values()) == 5


def test_personal_data_main_path_is_native(docs):
    plan = personal_data.personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity_is_learned_and_finds_masks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.learn(docs, labels)
    rows = toxicity.toxicity(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    masked = spark.createDataFrame([(1, "you 1d10t and m0ron, stup1d"), (2, "уоu idiоt, mоrоn and ѕcum"), (3, "a clown fish in the trash can"), (4, "hello there")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(masked, model).collect()}
    assert scores[1] > 0.5 and scores[2] > 0.5 and scores[3] < 0.5 and scores[4] < 0.5
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def shingle_counts(text):
    words = WORDS.findall(lower(text))
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_near_duplicates_against_all_pairs(spark, texts):
    rng = random.Random(5)
    rows = dict(texts)
    base = [f"w{i}" for i in range(400)]
    for i in range(60):  # a large group of near copies, and a chain
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(400)] = f"edit{rng.random()}"
        rows[50_000 + i] = " ".join(words)
    for i in range(80):  # copies with few to very many changes, most of them out of reach of each other
        words = list(base)
        for _ in range(rng.randrange(40)):
            words[rng.randrange(400)] = f"change{rng.random()}"
        rows[55_000 + i] = " ".join(words)
    for i in range(12):
        rows[60_000 + i] = " ".join(f"c{k}" for k in range(30 * i, 30 * i + 400))
    counts = {i: shingle_counts(t) for i, t in rows.items()}
    of = {i: i for i in rows}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    by = defaultdict(set)
    for i, c in counts.items():
        for s in c:
            by[s].add(i)
    pairs = {(a, b) for group in by.values() for a in group for b in group if a < b}
    for a, b in sorted(pairs):
        both = sum((counts[a] & counts[b]).values())
        if both >= 0.8 * (counts[a].total() + counts[b].total() - both):
            x, y = sorted((root(a), root(b)))
            of[y] = x
    first = {}
    for i in sorted(rows):
        x, y = sorted((root(first.setdefault(rows[i], i)), root(i)))
        of[y] = x
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    assert got == {i: root(i) for i in rows}


def test_signatures_estimate_weighted_jaccard():
    a = " ".join(["p q r s t"] * 30 + ["z1 z2 z3 z4 z5"])
    b = " ".join(["p q r s t"] * 25 + ["z1 z2 z3 z4 z5"])
    c = " ".join(f"w{i}" for i in range(12, 100))
    d = " ".join(f"w{i}" for i in range(100))
    hashes, weights, owner = multisets([a, b, c, d], 5)
    found = near_duplicates.signatures(hashes, weights, owner, 4, 8000)
    for x, y, i, j in ((a, b, 0, 1), (c, d, 2, 3)):
        one, two = shingle_counts(x), shingle_counts(y)
        want = (one & two).total() / (one | two).total()
        assert abs((found[i] == found[j]).mean() - want) < 0.02


def brute_contamination(text, items):
    words = WORDS.findall(lower(text))
    windows = defaultdict(set)
    for key, item in items:
        w = WORDS.findall(lower(item))
        size = min(13, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows[tuple(w[i : i + size])].add(key)
    hit, found = set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            own = windows.get(tuple(words[i : i + size]))
            if own:
                found |= own
                hit.update(range(i, i + size))
    listed = ",".join(sorted(map(str, found)))
    return len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block_chars", [2_000_000, 900])
def test_contamination_against_windows(spark, docs, texts, block_chars, monkeypatch):
    monkeypatch.setattr(contamination.item_blocks, "__defaults__", (block_chars,))
    rng = random.Random(3)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items += [(1000, "Short item"), (1001, "a"), (1002, "x x x x x x x x x x x x x x x"), (1003, "One, two three four five six seven eight nine ten eleven twelve thirteen")]
    rows = dict(texts) | {90_000: "x " * 40, 90_001: "it is a short ITEM", 90_002: "one two three four five six seven eight nine ten eleven twelve thirteen!"}
    for i in range(30):
        words = rng.choice(items)[1].split()
        at = rng.randrange(len(words))
        rows[91_000 + i] = " ".join(["pre"] * rng.randrange(30) + words[at : at + 20] + ["post"] * rng.randrange(300))
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.contamination(frame, bench).collect()
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_contamination(rows[r.doc_id], items), r
    cut = contamination.decontaminated(frame, bench).collect()
    assert {r.doc_id for r in cut} == {r.doc_id for r in got if not r.contaminated}
    spared = {r.doc_id: r for r in got}
    assert all(r.text == rows[r.doc_id] for r in cut if spared[r.doc_id].n_hit == 0)
    assert all(r.text != rows[r.doc_id] for r in cut if spared[r.doc_id].n_hit > 0)


def test_token_ids_round_trip(spark, docs, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(byte_bpe())
    odd = {90_000 + i: t for i, t in enumerate(["a  b   c", " x", "x ", "a\n b", "a \n\nb\t c ", "don't stop'll", "naïve café—dash", "\u00a0x \u2003y", "1,234.5 a1b2", "…a\n.b", "\n", "  ", "x\r\ny", "é\u0301 z"])}
    rows = sorted((texts | odd).items())
    folder = new_path(spark, "round-trip")
    token_ids.write_token_ids(spark.createDataFrame(rows, "doc_id long, text string"), folder, byte_bpe(), files=3)
    out = {r.doc_id: r for r in token_ids.document_positions(spark, folder).collect()}
    ids = {r.doc_id: list(r.ids) for r in token_ids.read_token_ids(spark, folder).collect()}
    at = 0
    for key, text in rows:
        want = plain.encode(text, add_special_tokens=False).ids + [0]
        assert ids[key] == want, text[:50]
        assert (out[key].start, out[key].n_tokens, out[key].ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)


def test_added_tokens_in_a_text(spark):
    """Texts with the string of an added token have the ids of the library's own call."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(byte_bpe())
    made = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y\n<|endoftext|><|endoftext|>", "a<|endoftext", "<| endoftext|>", "a  <|endoftext|>  b"]
    folder = new_path(spark, "added-tokens")
    token_ids.write_token_ids(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"), folder, byte_bpe(), files=2)
    ids = {r.doc_id: list(r.ids) for r in token_ids.read_token_ids(spark, folder).collect()}
    assert ids == {i: plain.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(made)}
    assert ids[0] == [64, 50256, 65, 0]


def test_seats_and_targets():
    assert mixing.seats([53.0, 24.0, 23.0], 7) == [3, 2, 2]
    assert mixing.seats([0.0, 0.0], 5) == [0, 0]
    assert sum(mixing.seats([10.0, 10.0, 10.0], 4)) == 4
    got = mixing.targets([100, 10, 1000], (5.0, 2.0, 1.0))
    assert got == [300.0, 30.0, 780.0]


@pytest.mark.parametrize("shard_docs", [4096, 40])
def test_mixture_meets_its_targets(docs, shard_docs):
    out = mixing.mixture(docs, shard_docs=shard_docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    pattern = re.compile("[^\x20\x09-\x0d]+")
    assert all(r["size"] == len(pattern.findall(r.text)) and 0 <= r.taken <= 3 * r["size"] for r in out)
    sources = defaultdict(list)
    for r in out:
        sources[r.source].append(r)
    for rows in sources.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.05 * rows[0].target + 64
    again = {r.doc_id: r.taken for r in mixing.mixture(docs.repartition(3), shard_docs=shard_docs).collect()}
    assert again == {r.doc_id: r.taken for r in out}
    words = Counter()
    for r in mixing.mixed(docs, shard_docs=shard_docs).collect():
        words[r.doc_id] += len(pattern.findall(r.text))
    assert words == Counter({k: v for k, v in again.items() if v})


def test_quality_counts(spark, docs, texts):
    rows = dict(texts) | {90_000: "a a a a", 90_001: "x\n\ny\nx\n \nx", 90_002: "p q r p q r s"}
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows.items()], "doc_id long, text string, lang string")
    pattern = re.compile("[^\x20\x09-\x0d]+")
    for r in perplexity.quality(frame).collect():
        words = pattern.findall(rows[r.doc_id])
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in rows[r.doc_id].split("\n") if pattern.search(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in rows[r.doc_id]), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_kneser_ney_sums_to_one(spark):
    """The probabilities of all characters after a context, unseen ones by backing off, are one."""
    frame = spark.createDataFrame([(1, "abracadabra abra cadabra", "x"), (2, "bandana ananas", "x")], "doc_id long, text string, lang string")
    counts = perplexity.counted(frame)
    grams = {r.gram: r.c for r in counts.collect()}
    padded = ["\n" * 4 + t for t in ("abracadabra abra cadabra", "bandana ananas")]
    assert grams == Counter(t[i : i + 5] for t in padded for i in range(len(t) - 4))
    p = {r.gram: 2.718281828459045**r.log_p for r in perplexity.interpolated(counts).collect()}
    assert p.keys() == grams.keys() and all(0 < v < 1 for v in p.values())
    by = Counter()
    for gram, v in p.items():
        by[gram[:4]] += v
    assert all(v < 1 + 1e-9 for v in by.values())
    assert p["cadab"] > 0.25 > p["\n\n\n\na"] / 4  # seen twice, and nothing else behind "cada"


def test_perplexity_rejects_outliers(spark, docs):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("qxzjkvwy0987") for _ in range(9)) for _ in range(80))
    frame = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(90_000, noise, "en")], "doc_id long, text string, lang string"))
    folder = perplexity.fit(docs)
    out = {r.doc_id: r for r in perplexity.quality(frame, folder).collect()}
    assert not out[90_000].base_failed and not out[90_000].kept
    assert all(r.kept for i, r in out.items() if not r.base_failed and i != 90_000)


def test_quality_rejects_noise_inside_its_table(spark, docs):
    """No text is scored by a model that has counted it, nor by one that has counted its copies."""
    rng = random.Random(2)
    drawn = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
    noise = [drawn(letters, n) for letters in ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789") for n in (80, 400, 2000)]
    rows = [(90_000 + i, t, "en") for i, t in enumerate(noise)] + [(91_000 + i, noise[0], "en") for i in range(3)]
    frame = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    out = [r for r in perplexity.quality(frame).collect() if not r.base_failed]
    planted = [r for r in out if r.doc_id >= 90_000]
    assert len(planted) == len(rows) and not any(r.kept for r in planted)
    prose = [r for r in out if r.doc_id < 90_000]
    assert sum(r.kept for r in prose) >= 0.95 * len(prose)


def test_unseen_grams_are_backed_off(spark):
    """The chances of all characters after a context, and of one that stands for the unknown ones, are one."""
    frame = spark.createDataFrame([(1, "abracadabra abra cadabra", "x"), (2, "bandana ananas", "x")], "doc_id long, text string, lang string")
    folder = perplexity.fit(frame)
    model = perplexity.SortedArrays(folder, perplexity.part_names(spark, folder))
    letters = sorted(set("abracadabra abra cadabrabandana ananas")) + ["?"]
    for context in ("cada", "zbra", "zzzz", "zzzn", "abra"):
        points = np.frombuffer("".join(context + x for x in letters).encode("utf-32-le"), np.uint32)
        starts = np.arange(len(letters)) * perplexity.ORDER
        chances = np.exp(perplexity.log_chances(model, points, starts, perplexity.language_hash(["x"] * len(letters))))
        assert abs(chances.sum() - 1) < 1e-5 and chances.min() > 0


def test_url_index_uses_the_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://h{i}.example.net/en/{i}",) for i in range(20)] + [("http://a.org/free/download",)], "url string")
    index = {r.rule: r.token for r in url_rules.rule_index(urls, url_rules.PLACES + url_rules.WORDS).collect()}
    assert index["example.net/en/"] in ("example", "net", "en") and index["org/fr/"] == "fr" and index["free download"] in ("free", "download")


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies, yes, many.</div>
<div id="page"><div class="post-content"><h1>Title &amp; more</h1><p>First, paragraph of the <b>article</b>, with commas,
and a line break<br>here.<p>Second paragraph, that is long enough to count as text, is it not?</p>
<div class="ad">Buy, now, this, thing.</div><blockquote>Quoted words, as they were said.</blockquote><form><p>Name, please</p></form></div>
<div class="sidebar"><p>Other things, that are here, and there, and everywhere, too.</p></div>
<section id="comments"><p>I agree, totally, with all, of this, really, yes.</p></section></div><footer>&copy; 2020, me</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(ARTICLE).split("\n\n") == [
        "Title & more", "First, paragraph of the article, with commas, and a line break here.",
        "Second paragraph, that is long enough to count as text, is it not?", "Quoted words, as they were said.",
    ]


BODY = ["First, paragraph of the text, with commas, that is long enough to count as prose, is it not?", "Second paragraph, as long as the first, or longer still, with commas, and more of the same words."]
AROUND = (
    '<nav><a href="/a">Menu</a></nav>', '<div class="sidebar"><p>Other things, that are here, and there.</p></div>'
    '<div id="comments" class="comments-area"><p>I agree, totally, with all, of this.</p></div><footer>Me</footer>',
)
WRAPPERS = [
    '<form method="post" action="./page.aspx" id="aspnetForm"><input type="hidden" name="__VIEWSTATE">{}<select><option>One</select><button>Go</button></form>',
    *(f'<div class="{c}">{{}}</div>' for c in ("content no-sidebar", "with-sidebar", "has-comments", "post-share-enabled", "content-sidebar-wrap", "widget")),
    '<section id="page-with-sidebar">{}</section>', '<div class="with-sidebar"><article>{}</article></div>', '<article class="post comments-open">{}</article>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("outside", [False, True])
def test_main_text_survives_its_wrapper(wrapper, outside):
    """The boilerplate may stand in the marked container or around it."""
    body = "".join(f"<p>{x}</p>" for x in BODY)
    if outside:
        page = AROUND[0] + wrapper.format(body) + AROUND[1]
    else:
        page = wrapper.format(AROUND[0] + f"<div>{body}</div>" + AROUND[1])
    assert main_text.main_text(f"<html><body>{page}</body></html>").split("\n\n") == BODY


def test_main_text_of_a_list_of_marked_posts():
    posts = [f"Post {i}, with words, and commas, and enough, of both, to be a paragraph, that counts as prose." for i in range(6)]
    page = "".join(f'<div class="post has-comments"><p>{x}</p></div>' for x in posts)
    assert main_text.main_text(f"<body><div>{page}</div>{AROUND[1]}</body>").split("\n\n") == posts


def test_main_text_leaves_marked_parts_out():
    """Long comments, cards of related articles and a small form are not the main text."""
    body = "".join(f"<p>{x}</p>" for x in BODY)
    comments = "".join(f'<article class="comment-body"><p>{BODY[1]}</p></article>' for _ in range(5))
    cards = "".join('<article class="card"><p>Something else, to read, later.</p></article>' for _ in range(3))
    form = '<form><label>Name</label><p>Leave a word, please.</p></form>'
    page = f'<article>{body}<div class="related-posts">{cards}</div></article><div id="comments" class="comments-area">{comments}</div>{form}'
    assert main_text.main_text(page).split("\n\n") == BODY
    page = f'<div class="content no-sidebar">{body}</div><div id="comments" class="comments-area">{comments}</div>{form}'
    assert main_text.main_text(page).split("\n\n") == BODY


@pytest.mark.parametrize("page", ["<" * 50_000, "<a " * 20_000, "<!--" * 20_000, '<a href="' * 20_000, "<script>" * 20_000, "<div>" * 20_000 + "x" + "<p>a</i>" * 5_000])
def test_main_text_is_linear(page):
    main_text.main_text(page)


def test_main_text_of_the_test_pages(spark):
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert main_text.main_text(r.html) == "\n\n".join(filter(None, blocks))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, name):
    from oracle_check import difference, duck

    assert difference(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.SQL[name]) is None


def test_the_band_is_near_the_spread_of_its_language(spark):
    """Half of the texts lie within 0.01 of the median: one twelve times as far off is outside, and a small language keeps its texts."""
    rows = [("x", 1.5 + 0.0002 * k) for k in range(-100, 101)] + [("y", 1.5), ("y", 1.52)]
    band = {r.lang_b: r for r in perplexity.band_of(spark.createDataFrame(rows, "lang string, nats double"), perplexity.LOWER, perplexity.UPPER).collect()}
    assert 1.38 < band["x"].least < 1.48 and 1.52 < band["x"].most < 1.62  # 1.3 and 1.7 at 20 distances
    assert band["y"].least <= 1.5 and band["y"].most >= 1.52


def test_a_worker_keeps_few_pieces(spark):
    """Texts are encoded 4 MB at a time, and the pieces that are known are bounded, also while new ones come in."""
    assert token_ids.BATCH_BYTES <= 4 << 20 and token_ids.KNOWN_PIECES <= 200_000
    own = token_ids.TextEncoder(byte_bpe(), 0)
    for k in range(5):
        own.encode([" ".join(f"a{i}" for i in range(60_000 * k, 60_000 * (k + 1)))])
        assert len(own.known) <= token_ids.KNOWN_PIECES // 2 + 60_000 and len(own.older) <= token_ids.KNOWN_PIECES // 2 + 60_000


def test_a_known_piece_is_not_encoded_again(spark, monkeypatch):
    """The ids are the library's while pieces come and go, and what an earlier batch had is looked up in arrays, not unpacked."""
    from tokenizers import Tokenizer

    asked = []
    own, library, plain = token_ids.TextEncoder(byte_bpe(), 0), Tokenizer.from_file(byte_bpe()), token_ids.encoded
    monkeypatch.setattr(token_ids, "encoded", lambda tokenizer, pieces, spaced=True: asked.append(list(pieces)) or plain(tokenizer, pieces, spaced))
    monkeypatch.setattr(token_ids, "KNOWN_PIECES", 8)
    batches = [["one two three four", "one two"], ["one two five"], ["six two seven eight nine <|endoftext|>"], ["one two nine ten", "", "a two\n three"], ["one two three"]]
    for batch in batches:
        ids, sizes = own.encode(pa.array(batch))
        wanted = [library.encode(t, add_special_tokens=False).ids + [0] for t in batch]
        assert ids.tolist() == sum(wanted, []) and sizes.tolist() == [len(w) for w in wanted]
    assert isinstance(own.known, pa.Array) and sum("two" in a for a in asked) == 1


def test_a_word_is_encoded_once_whatever_stands_behind_it(monkeypatch):
    """Pieces are cut into words, and the model sees a word once a batch; the ids are the library's, for all letters that are cut here."""
    from tokenizers import Tokenizer

    from outcome_lens.llm import pieces

    asked = []
    own, library, plain = token_ids.TextEncoder(byte_bpe(), 0), Tokenizer.from_file(byte_bpe()), token_ids.encoded
    monkeypatch.setattr(token_ids, "encoded", lambda tokenizer, pieces, spaced=True: asked.extend(pieces) or plain(tokenizer, pieces, spaced))
    text = "A tree, tree. tree! tree### tree.\ntree tree's 'tree' 12tree tree12, x_tree tree"
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids + [0]
    assert asked.count("tree") == 2 and not any("tree" in p for p in asked if p != "tree")  # with and without a space in front
    rng = random.Random(8)
    letters = [chr(c) for c in range(0x10000) if re.match(f"[{pieces.LETTERS}]", chr(c))]
    signs = [chr(c) for c in range(33, 127)] + ["'s", "'ll", "'S", "\n", "\n\n", " ", " ", " ", "\t", "  ", "\0", "٣", "²", "̈", "…"]
    texts = ["".join(rng.choice(rng.choice([letters, letters, signs, "aeiou tnr'"])) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += [" ".join(letters), "".join(letters), ".".join(letters), "\n".join(letters), "x" * 3000, " " + "é" * 300]
    for _ in range(2):  # the second time words are known
        ids, sizes = own.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_only_texts_that_can_be_linked_are_compared_late(spark, monkeypatch):
    """All texts share a passage, and no shingle is in one text alone: sizes and distances rule nothing out, outlines do."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    common = [word() for _ in range(70)]
    made = {}
    for k in range(40):
        own = [word() for _ in range(30)]
        made[bytes([1, k])], made[bytes([2, k])] = " ".join(common + own), " ".join(common + own[:-1] + [word()])
    made |= {bytes([3, k]): " ".join(common[k:] + common[:k]) for k in range(1, 4)}
    bags = {n: Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for n, t in made.items()}
    alike = lambda a, b: (bags[a] & bags[b]).total() / (bags[a] | bags[b]).total()
    wanted = {(a, b) for a in made for b in made if a > b and alike(a, b) >= 0.8}
    compared, plain = [], near_duplicates.similarities
    monkeypatch.setattr(near_duplicates, "similarities", lambda pairs, *more: compared.append(pairs.count()) or plain(pairs, *more))
    open_ = spark.createDataFrame([(7, n, n) for n in made], "bucket long, node binary, root binary")
    bodies = spark.createDataFrame(list(made.items()), "node binary, text string")
    linked = spark.createDataFrame([], "node binary, root binary")
    found = {(bytes(r.a), bytes(r.b)) for r in near_duplicates.late_links(open_, linked, bodies, 0.8, 5).collect()}
    assert {bytes([2, k, 1, k])[:2] for k in range(40)} <= {a for a, _ in wanted}
    # links inside a class that the central text has made are not asked for again
    roots = {bytes(r.node): bytes(r.root) for r in near_duplicates.classes(spark.createDataFrame(sorted(found), "a binary, b binary")).collect()}
    assert found <= wanted and all(roots.get(a, a) == roots.get(b, b) for a, b in wanted)
    assert compared[0] < len(made) and compared[-1] < 3 * len(made)


def test_counting_and_reading_take_little_memory(spark, tmp_path):
    """A worker counts n-grams in less than 45 bytes a character, and opens a part of a model in little more than it keeps."""
    import tracemalloc

    import pyarrow.parquet as pq

    rng = random.Random(4)
    drawn = ["".join(rng.choice("abcdeéя漢😀 \n") for _ in range(n)) for n in (0, 1, 3, 200, 0)]
    for texts in (drawn, drawn[:1], drawn + ["x" + "".join(map(chr, range(0x4E00, 0x4E00 + 5000)))], [""] + drawn[::-1]):
        found = Counter()
        for grams, counts in perplexity.gram_counts(*perplexity.code_points(texts)):
            for gram, c in zip(grams.to_pylist(), counts.tolist(), strict=True):
                found[gram] += c
        padded = ["\n" * 4 + t for t in texts]
        assert found == Counter(t[i : i + 5] for t in padded for i in range(len(t) - 4))
    long = ["".join(rng.choices("abcdefgh ", k=1000)) for _ in range(1000)]
    arrays = perplexity.code_points(long)
    tracemalloc.start()
    for _ in perplexity.gram_counts(*arrays):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    keys = np.sort(np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 500_000))
    pq.write_table(pa.table({"hash": keys, "log_p": pa.array(np.arange(len(keys)), pa.float32())}), tmp_path / "part.parquet")
    model = perplexity.SortedArrays(str(tmp_path), ["part.parquet"])
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    held = model.part("part.parquet")
    taken = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert most < 45 * 1_000_000 and taken < 1.4 * sum(a.nbytes for a in held[:3])
    assert model.find(keys[::1000]).tolist() == list(range(0, len(keys), 1000)) and np.isnan(model.find(keys[:9] + 1)).all()


def test_idle_workers_give_memory_back(spark):
    """A worker that has signed and encoded 8 MB keeps little of what it needed while it did."""

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            line = next(x for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon"))
            yield pa.RecordBatch.from_pydict({"mb": pa.array([int(line.split()[1]) / 1024] * batch.num_rows)})

    measured = lambda: max(r.mb for r in spark.range(8).repartition(8).mapInArrow(held, "mb double").collect())
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(300))) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for _ in range(2):
        near_duplicates.with_bands(frame.selectExpr("doc_id", "unhex(md5(text)) as node", "text"), 20, 6, 5).count()
        token_ids.write_token_ids(frame, new_path(spark, "held"), byte_bpe(), files=2)
    assert measured() < 190


def test_texts_reach_the_encoder_in_small_batches(spark, monkeypatch):
    """What goes to a worker at once is bounded by bytes, and the session's own bound is back afterwards."""
    at = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    seen = []
    monkeypatch.setattr(token_ids, "thrifty", lambda work: seen.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) or work)
    token_ids.write_token_ids(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), new_path(spark, "small"), byte_bpe(), files=1)
    assert seen == [str(2 * token_ids.BATCH_BYTES)] and token_ids.BATCH_BYTES <= 2 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == at


def test_lexicon_functions_run_once_a_text(spark):
    """A filter behind a Python function does not call it again: a task needs one Python worker, not two."""
    sample = spark.createDataFrame([(1, "you utter idiot"), (0, "a fine day"), (0, "... 1 2")], "toxic int, text string")
    words, hits = toxicity.folded_words(sample), toxicity.weighed(sample, {"idiot": 3.0})
    assert [(r.toxic, r.words) for r in words.orderBy("words").collect()] == [(0, ["a", "fine", "day"]), (1, ["you", "utter", "idiot"])]
    assert [r.toxic for r in hits.collect()] == [1]
    for rows in (words.groupBy("toxic").count(), hits.select("toxic", "f")):
        assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_texts_are_measured_in_little_memory(spark, tmp_path, monkeypatch):
    """A worker gets few texts at a time, and looking their n-grams up takes little more than the answers."""
    import tracemalloc

    import pyarrow.parquet as pq

    rng = np.random.default_rng(7)
    keys = np.sort(rng.integers(-(2**63), 2**63 - 1, 300_000))
    pq.write_table(pa.table({"hash": keys, "log_p": pa.array(np.arange(len(keys)), pa.float32())}), tmp_path / "part.parquet")
    model = perplexity.SortedArrays(str(tmp_path), ["part.parquet"])
    model.part("part.parquet")
    asked = np.concatenate([keys, keys + 1, rng.integers(-(2**63), 2**63 - 1, 300_000)])
    tracemalloc.start()
    found = model.find(asked)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[: len(keys)].tolist() == list(range(len(keys))) and np.isnan(found[len(keys) :]).all()
    assert most < 16 * len(asked)
    setting, sent, write = "spark.sql.execution.arrow.maxBytesPerBatch", {}, perplexity.stored
    before = spark.conf.get(setting)
    monkeypatch.setattr(perplexity, "stored", lambda rows, name: sent.update({name: spark.conf.get(setting)}) or write(rows, name))
    perplexity.quality(spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, lang string")).collect()
    assert sent["grams-5"] == sent["quality-measures"] == str(2 * perplexity.BATCH_CHARS)
    assert spark.conf.get(setting) == before


def test_rounds_of_classes_leave_no_shuffle_files(spark):
    """Edges of a round are a table of few files, and what was shuffled for them is gone when they are written."""
    links = spark.createDataFrame([(bytes([k + 1]), bytes([k])) for k in range(40)], "a binary, b binary")
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: sum(f.getName().startswith("shuffle_") for f in (folder.getAllFiles().apply(i) for i in range(folder.getAllFiles().size())))
    before = kept()
    found = near_duplicates.classes(links)
    assert {bytes(r.node): bytes(r.root) for r in found.collect()} == {bytes([k]): bytes([0]) for k in range(1, 41)}
    assert "Scan parquet" in found._jdf.queryExecution().executedPlan().toString()
    assert kept() - before < 60
