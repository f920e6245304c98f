"""Whitening, exact de-duplication and collocations against brute force, with their edge cases."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, exact, queries, whitening

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")
LONG = "long text without an end " * 20_000


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Exact de-duplication.

ROWS = [(1, "A b", "x"), (2, "a B", "x"), (2, "a B", "x"), (None, "a b", "z"), (3, None, "y"), (4, "", "y"), (5, "É", "k"), (6, "é", "k"), (None, "q", "k"), (None, "q", "k"), (7, LONG, "x"), (8, LONG.upper(), "x")]
HASHES = {"md5": exact.content_hash, "one value": lambda t: F.lit(b"1"), "length": lambda t: F.unhex(F.hex(F.length(t)))}


def brute_duplicates(rows):
    out = Counter()
    for text in {lowered(r[1]) for r in rows}:
        ids = [r[0] for r in rows if lowered(r[1]) == text]
        keep = max((i for i in ids if i is not None), default=None)
        digest, kept = hashlib.sha256(text.encode()).hexdigest(), False
        for i in ids:
            out[(i, keep, len(ids), i == keep and not kept, digest)] += 1
            kept |= i == keep
    return out


@pytest.mark.parametrize("name", HASHES)
def test_duplicates_against_brute_force(spark, name):
    # Columns that clash with results and inner names.
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string").withColumns({c: F.lit(1) for c in ("hash", "group_size", "row_no", "copies", "kept")})
    found = exact.duplicates(docs, HASHES[name]).collect()
    assert Counter(tuple(r) for r in found) == brute_duplicates(ROWS)
    kept = exact.keep_one(docs, HASHES[name])
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, lowered(r.text)) for r in kept.collect()) == Counter({(k, t): 1 for t in {lowered(r[1]) for r in ROWS} for k in [max((r[0] for r in ROWS if lowered(r[1]) == t and r[0] is not None), default=None)]})


def test_duplicates_use_no_python(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string")
    plan = exact.classes(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Collect" not in plan
    # Copies are combined before the shuffle.
    assert "partial_count" in plan


def test_duplicates_of_an_empty_table(spark):
    assert exact.duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Whitening.


def solver_cases():
    r = np.random.default_rng(3)
    turn = np.linalg.qr(r.standard_normal((24, 24)))[0]
    dependent = r.standard_normal((60, 8))
    dependent[:, 2], dependent[:, 5] = 0, dependent[:, 1]
    return {
        "random": r.standard_normal((90, 24)),
        "one column": r.standard_normal((9, 1)),
        "wide": r.standard_normal((3, 8)),
        "zero": np.zeros((5, 6)),
        "dependent": dependent,
        "repeated values": np.diag([5.0, 5, 5, 5, 1, 1]),
        "orthogonal": turn,
        "cluster": turn * (1 + 1e-10 * np.arange(24)),
        "two groups": (turn * np.array([2.0] * 9 + [1.0] * 15)) @ turn[::-1],
        "steep": turn * 10.0 ** -np.arange(24).clip(0, 7),
        "huge": 1e150 * turn,
    }


@pytest.mark.parametrize("name", solver_cases())
def test_solver_against_lapack(name):
    a = solver_cases()[name]
    d = a.shape[1]
    values, basis, used = whitening.directions(np.linalg.qr(a, mode="r"), 6)
    want = np.zeros(d)
    s = np.linalg.svd(a, compute_uv=False)[:d]
    want[: len(s)] = s**2
    top = max(want.max(), 1e-300)
    assert len(values) == d and np.allclose(values, want, rtol=1e-10, atol=1e-13 * top)
    k = min(6, d)
    assert basis.shape == (d, k) and np.allclose(basis.T @ basis, np.eye(k), atol=1e-11)
    assert np.abs(a.T @ (a @ basis) - basis * values[:k]).max() <= 1e-12 * top
    assert used.tolist() == (want[:k] > top * 1e-26).tolist()


def test_dqds_keeps_relative_accuracy_of_small_values():
    # A bidiagonal matrix determines its small singular values; a squared matrix would lose them.
    diagonal, beside = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-1, 1e-4, 1e-7])
    found = np.sqrt(whitening.dqds(diagonal, beside))
    assert np.isclose(np.prod(found), np.prod(diagonal), rtol=1e-13)


def brute_whitening(rows, k=4):
    """Rows of (vec_id, x) by numpy's eigenvectors; signs are left open."""
    x = np.array([r[1] for r in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    w = ((n * x - s) / n) @ q[:, :k] / np.sqrt(e[:k])
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x.astype(object) - s.astype(object)]
    return {(rows[i][0], j + 1): (n, deviation[i], abs(w[i, j]), e[j] / e.sum()) for i in range(len(rows)) for j in range(min(k, x.shape[1]))}


@needs_tables
def test_whitening_query_against_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    rows = [(r.vec_id, np.floor(256 * np.array(r.embedding, float)).astype(np.int64)) for r in table]
    want = brute_whitening(rows)
    found = queries.op11_embedding_whitening(spark, FOLDER).collect()
    assert len(found) == len(want) and {(r.vec_id, r.component) for r in found} == set(want)
    for r in found:
        n, deviation, w, explained = want[(r.vec_id, r.component)]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - w) < 1e-8 and abs(r.explained - explained) < 1e-10 and r.identity_error < 1e-9


@pytest.mark.parametrize("fan", [2, 64])
def test_whitening_of_repeats_nulls_and_uneven_rows(spark, fan):
    r = random.Random(8)
    base = [[r.gauss(0, 2) for _ in range(5)] for _ in range(40)]
    rows = [(i, base[min(i, 30)] if i % 3 else base[0]) for i in range(40)] + [(100, base[1][:3]), (None, base[2]), (0, base[3])]
    bad = [(200, None), (201, [1.0, None]), (202, [float("nan")] * 5), (203, [float("inf")] * 5)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(7).withColumns({c: F.lit("?") for c in ("x", "n", "component", "whitened", "node")})
    clean = [(i, np.floor(256 * np.array(v + [0.0] * (5 - len(v)))).astype(np.int64)) for i, v in rows]
    want = brute_whitening(clean)
    found = whitening.whitened(frame, fan=fan).collect()
    assert len(found) == 4 * len(rows)
    for x in (x for x in found if x.vec_id not in (0, None)):
        n, deviation, w, explained = want[(x.vec_id, x.component)]
        assert (x.n, int(x.deviation)) == (n, deviation) and abs(abs(x.whitened) - w) < 1e-9 and abs(x.explained - explained) < 1e-12
    assert max(x.identity_error for x in found) < 1e-9


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, 0.0)] * 4
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, []), (2, [0.0])], schema)).count() == 0
    huge = whitening.whitened(spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], schema)).collect()
    assert len(huge) == 4


# Collocations.


def brute_counts(docs):
    counts, sizes = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, sizes


def brute_collocations(docs, least, top):
    counts, sizes = brute_counts(docs)
    candidates = {p: f for p, f in counts.items() if f >= least and len(p[1]) > 1}
    rows = {}
    for (lang, words), a in candidates.items():
        inside = any(lang == other and len(longer) > len(words) and 100 * f >= 80 * a and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1)) for (other, longer), f in candidates.items())
        if inside:
            continue
        cuts = [(2_000_000 * a // (counts[(lang, words[:k])] + counts[(lang, words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[(lang, words[:k])], counts[(lang, words[k:])]))
    return {(lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for lang, own in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(own)[:top])}


def random_docs(seed, many):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "\x00", "\x1cx", "名"]
    phrases = [["to", "be", "or", "not"], ["new", "york"], ["New", "York", "city"]]
    docs = []
    for _ in range(many):
        words = []
        for _ in range(r.randrange(0, 60)):
            words += r.choice(phrases) if r.random() < 0.3 else [r.choice(vocabulary)]
            words.append(r.choice(["", "", "", ".", "!", "\n", "\t"]))
        docs.append((" ".join(words), r.choice(["en", "de", None])))
    return docs + docs[:5] + [(None, "en"), ("", "en"), (" \t. ;", "fr"), ("x y " * 9000, "long")]


@pytest.mark.parametrize("shard_words", [40, 700, 2_000_000])
def test_collocations_against_brute_force(spark, shard_words):
    docs = random_docs(4, 60)
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(3).withColumns({c: F.lit(1) for c in ("shard", "phrase", "n", "hash", "words", "rank")})
    for least, top in ((5, 20), (9, 2000)):
        found = {tuple(r) for r in collocations.mine(frame, least, top=top, shard_words=shard_words).collect()}
        assert found == brute_collocations(docs, least, top)


def test_collocations_edges(spark):
    schema = "text string, lang string"
    assert collocations.mine(spark.createDataFrame([], schema)).count() == 0
    assert collocations.mine(spark.createDataFrame([(None, "en"), (". ,", None)], schema)).count() == 0
    with pytest.raises(ValueError):
        collocations.mine(spark.createDataFrame([], schema), longest=5)
    short = collocations.mine(spark.createDataFrame([("a b c a b c", "x")], schema), least=2, longest=2).collect()
    assert [(r.phrase, r.a, r.l, r.r) for r in short] == [("a b", 2, 2, 2), ("b c", 2, 2, 2)]


def test_extensions_of_the_index_are_counts():
    r = random.Random(2)
    text = np.array([0] + [r.choice([0, 1, 1, 2, 3, 4, 5]) for _ in range(400)] + [0])
    made = collocations.PhraseIndex.of(text, 6)
    zeros = [*made.left.zeros, *made.right.zeros]
    for index in (made, collocations.PhraseIndex.unpacked(made.packed(), zeros, np.bincount(text, minlength=6))):
        grams = Counter(tuple(text[i : i + k].tolist()) for k in (2, 3, 4) for i in range(len(text) - k + 1) if 0 not in text[i : i + k])
        level = {(c,): tuple(x[c - 1 : c] for x in index.words(np.arange(1, 6))) for c in range(1, 6)}
        for length in (2, 3, 4):
            for to_right in (True, False):
                found = {}
                for phrase, interval in level.items():
                    _, words, longer = index.extend(interval, to_right)
                    for j, w in enumerate(words.tolist()):
                        found[(*phrase, w) if to_right else (w, *phrase)] = tuple(x[j : j + 1] for x in longer)
                assert {p: int(i[2][0]) for p, i in found.items()} == {p: n for p, n in grams.items() if len(p) == length}
            level = found
