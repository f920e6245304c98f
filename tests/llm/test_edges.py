"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator on documents."""

import hashlib
import random
import re

import pytest

from ledgerloom.llm import decontaminate, langid, licenses, pages, pieces, pii, simhash, substrings, topk, transcripts

LONG = "word and more words 4111111111111111 " * 3000
ROWS = [
    (1, "The quick brown fox", "en", "x", 0),
    (2, None, None, None, None),
    (3, "", "en", "", 1),
    (4, "   \n\t ", None, "x", 2),
    (None, "The quick brown fox", "en", "x", 3),
    (1, "The quick brown fox", "en", "x", 0),
    (5, LONG, "en", "x", 4),
    (6, "名前 は é 1234", "ja", "x", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with results and inner names.
EXTRA = "key long, n_words long, labels string, score double, fp long, root long, ids string, marks int, n_found int, count long"


@pytest.fixture(scope="module")
def docs(spark):
    wide = SCHEMA + ", " + EXTRA
    return spark.createDataFrame([(*r, *([None] * 10)) for r in ROWS], wide)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown"), (2, None), (None, "fox"), (3, "")], "item_id long, text string")


OPERATORS = {
    "pii": lambda d, b: pii.pseudonymise(d),
    "langid": lambda d, b: langid.identify(d),
    "recognised": lambda d, b: langid.recognised(d),
    "substrings": lambda d, b: substrings.deduplicate(d),
    "licenses": lambda d, b: licenses.scan(d),
    "pieces": lambda d, b: pieces.encode(d),
    "simhash": lambda d, b: simhash.near_duplicates(d),
    "keep_one": lambda d, b: simhash.keep_one(d),
    "hits": lambda d, b: decontaminate.hits(d, b),
    "hits_in_parts": lambda d, b: decontaminate.hits(d, b, part_bytes=4),
    "clean": lambda d, b: decontaminate.clean(d, b),
}
FILTERS = {"recognised": 5, "keep_one": 4, "clean": None}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(docs, benchmark, name):
    found = OPERATORS[name](docs, benchmark).collect()
    if name in FILTERS:
        assert FILTERS[name] is None or len(found) == FILTERS[name]
    else:
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, benchmark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA), benchmark).count() == 0


def test_keep_one_keeps_one_of_each_group(docs):
    kept = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    # Null, empty and blank texts share fingerprint 0; the copy without doc_id goes.
    assert kept == {(1, "The quick brown fox"), (2, None), (5, LONG), (6, "名前 は é 1234")}


def test_parts_of_a_benchmark_give_the_same_hits(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randrange(1, 30)))) for i in range(12)]
    texts = [(i, " ".join(r.choices(vocabulary, k=40)) + ". " + items[i % 12][1].upper() + "\n" + " ".join(r.choices(vocabulary, k=300 * (i % 2)))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "item_ids", "contaminated"]
    whole = decontaminate.hits(docs, bench)
    assert sorted(whole.select(columns).collect()) == sorted(decontaminate.hits(docs, bench, part_bytes=60).select(columns).collect())
    dirty = {r.doc_id for r in whole.where("contaminated").collect()}
    assert dirty
    for bound in (60, decontaminate.PART_BYTES):
        assert {r.doc_id for r in decontaminate.clean(docs, bench, part_bytes=bound).collect()} == set(range(30)) - dirty
    # Spans lie in the original text, at the item's words.
    for row in whole.collect():
        for span in row.spans:
            assert span.start == 0 or not texts[row.doc_id][1][span.start - 1].isalnum()
            assert texts[row.doc_id][1][span.start : span.stop].lower().startswith("w")


def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        k = min(13, len(w))
        for s in range(len(w) - k + 1) if k else ():
            for p in range(len(own) - k + 1):
                if own[p : p + k] == w[s : s + k]:
                    hit |= set(range(p, p + k))
                    found.add(item)
    return len(own), len(hit), len(found)


def test_hits_against_brute_force(spark):
    r = random.Random(1)
    vocabulary = ["a", "b", "c"]
    items = [(i, " ".join(r.choices(vocabulary, k=n))) for i, n in enumerate((1, 2, 5, 13, 15, 20))]
    texts = [(i, r.choice(" -,").join(r.choices([*vocabulary, "D", "é"], k=r.randrange(0, 60))) + " " + items[i % 6][1]) for i in range(20)]
    found = decontaminate.hits(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for row in found.collect():
        assert (row.n_words, row.n_hit, len(row.item_ids)) == brute_hits(texts[row.doc_id][1], items)


def brute_substrings(texts, window):
    windows = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    for i, w in enumerate(split):
        for s in range(len(w) - window + 1):
            windows.setdefault(tuple(w[s : s + window]), []).append((i, s))
    gone = [set() for _ in texts]
    for places in windows.values():
        if len(places) > 1:
            for i, s in places:
                gone[i] |= set(range(s, s + window))
    return [(len(w), len(g), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in g).encode()).hexdigest()) for w, g in zip(split, gone)]


@pytest.mark.parametrize("hot", [20_000, 1])
def test_substrings_against_brute_force(spark, hot):
    r = random.Random(hot)
    word = lambda n: [f"w{r.randrange(50)}" for _ in range(n)]
    passage, other = word(60), word(36)
    texts = [" ".join(word(40) + passage[i % 7 :] + word(i)) for i in range(12)]
    texts += [" ".join(passage), " ".join(passage), None, "", " ".join(other + word(3) + other), "a " * 120, " ".join(word(34)), " ".join(word(200))]
    edited = texts[-1].split()
    edited[90] = "changed"
    texts += [" ".join(edited)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicate(docs, hot=hot, shard_segments=5).collect()}
    assert [found[i] for i in range(len(texts))] == brute_substrings(texts, 35)


def test_a_passage_of_many_documents_is_in_no_shard_many_times(spark, monkeypatch):
    r = random.Random(3)
    word = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    passage = word(45)
    texts = [" ".join(word(30) + passage + word(30)) for _ in range(120)] + [" ".join(word(80))] * 3
    rows = [*enumerate(texts), (0, texts[0])]
    routed, inner = [], substrings._routed
    monkeypatch.setattr(substrings, "_routed", lambda *a: routed.append(inner(*a)) or routed[-1])
    found = substrings.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), hot=20, shard_segments=50).collect()
    want = brute_substrings([t for _, t in rows], 35)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == sorted((i, *w) for (i, _), w in zip(rows, want))
    # Before, each of the 120 edge segments sent its copy of every window of the passage to one shard.
    assert max(x["count"] for x in routed[0].dropDuplicates(["minimiser", "segment", "words"]).groupBy("words").count().collect()) == 1


def brute_components(texts):
    prints = [simhash.simhash(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(len(texts)):
                if bin(prints[i] ^ prints[j]).count("1") <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_components_against_brute_force(spark):
    r = random.Random(9)
    base = [" ".join(f"w{r.randrange(400)}" for _ in range(120)) for _ in range(10)]
    texts = []
    for i in range(60):
        words = base[i % 10].split()
        for _ in range(i // 20):
            words[r.randrange(120)] = "edit"
        texts.append(" ".join(words))
    texts += [None, "", "one", "One", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts)


def test_links_of_crowded_buckets(spark):
    r = random.Random(2)
    base = r.getrandbits(63)
    prints = sorted({base ^ (1 << r.randrange(20)) ^ (1 << r.randrange(20)) ^ (1 << r.randrange(63)) for _ in range(150)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")

    def roots(split):
        parent = {p: p for p in prints}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in simhash.link(frame, split=split).collect():
            parent[find(u)] = find(v)
        groups = {}
        for p in prints:
            groups.setdefault(find(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    parent_of = {p: {q for q in prints if bin(p ^ q).count("1") <= 2} for p in prints}
    want, left = [], set(prints)
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            p = todo.pop()
            seen.add(p)
            todo += parent_of[p] - seen
        want.append(sorted(seen))
        left -= seen
    assert roots(2048) == roots(4) == sorted(want)


def test_topk_edges_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (None, [1.0, 1.0]), (100, [-1.0, 0.5]), (7, [0.5, 9.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(frame, k=3).collect())
    assert found == [(0, 1, 1, 1048576), (0, 2, 2, 1048576), (0, 3, 7, 524288), (100, 1, 7, 4194304), (100, 2, 0, -1048576), (100, 3, 1, -1048576)]
    assert topk.search(frame.limit(0)).count() == 0


def test_topk_of_uneven_huge_and_repeated_vectors(spark):
    rows = [(0, [1e3, 2.0, 1.0]), (0, [1e3, 2.0]), (1, [1e15, 1.0, 1.0]), (2, [2.0]), (3, [])]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(0, 1, 1), (0, 1, 1), (0, 2, 0), (0, 2, 0)]


def test_topk_against_brute_force(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    ints = {i: [int((1024 * x) // 1) for x in v] for i, v in rows}
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), depth=12, shards=3).collect()
    for q in range(0, 600, 100):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:10]
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [(i, -s) for s, i in scores]


def test_pages_edges(spark):
    rows = [(1, "u", None), (1, "u", ""), (2, None, "<p>"), (3, "u", "plain &amp; text"), (None, "u", "<b>x <i>y</b> z</i>"), (4, "u", "<div>" * 3000 + "deep")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    assert sorted(r.text for r in pages.extract(frame).collect()) == sorted(["", "", "", "plain & text", "x y z", "deep"])
    assert pages.extract(frame.limit(0)).count() == 0


def test_transcripts_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, "late"), (None, None, None, None), (2, 0, "user", ""), (2, 1, "assistant", "x" * 50_000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, part int")
    found = transcripts.format_turns(frame).collect()
    assert len(found) == len(rows)
    assert transcripts.format_turns(frame.limit(0)).count() == 0
