"""Samples that are never empty, stages that use their model, and parsers that are linear and drop nothing."""

import os
import random
import time
from dataclasses import replace

import numpy as np
import pytest

from ledgerloom.llm import langid, licenses, pages, pieces, transcripts

ENGLISH = "the cat sat on the mat and the dog ran to the house of the man"
FRENCH = "le chat est sur la table et le chien dort dans la maison du voisin"


@pytest.mark.parametrize("ids", [(5, 6), (7, 8), (11, 12), (21, 22)])
def test_chat_sample_is_never_empty(spark, ids):
    rows = [(i, t, ("user", "assistant")[t % 2], f"text {t}") for i in ids for t in range(300)] + [(1, 1, None, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for sample in (1, 100, 10_000):
        model = transcripts.train(table, sample)
        # Learnt from at least one row: the start of a conversation is no longer as likely for every role.
        assert not np.allclose(model.transition[-1], model.transition[-1].mean()), sample


def test_language_stage_uses_its_model(spark):
    docs = spark.createDataFrame([(i, (ENGLISH, FRENCH)[i % 2], ("en", "fr")[i % 2]) for i in range(40)] + [(90, None, "en"), (91, "123 !?", "en")], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.least > 0
    kept = lambda **more: sorted(r.doc_id for r in langid.recognised(docs, **({"model": model} | more)).collect())
    assert kept() == list(range(40))
    assert kept(wanted=["fr"]) == list(range(1, 40, 2))
    assert kept(least=1.01) == []
    # A model that has learnt nothing gives every language the same score, below what the trained one is sure of.
    blank = replace(model, weights=0 * model.weights, bias=0 * model.bias)
    assert kept(model=blank, least=0.6) == [] != kept(least=0.6)


def test_license_places_of_a_long_text():
    flat = b" " + b"mit license x " * 80_000
    start = time.monotonic()
    places = licenses.phrase_places(flat, ((b" mit license ", "mit"),))
    assert [p for p, _ in places] == list(range(0, 240_000, 3)) and time.monotonic() - start < 5


@pytest.mark.parametrize(
    "source, wanted",
    [
        ("<article><p>one</p><svg><p>two</p><p>three</p></article>", ["one", "two", "three"]),
        ("<article><p>one</p><svg><text>no</text></svg><p>two</p></article>", ["one", "two"]),
        ("<article><p>one</p><object>no<p>no</p></article><p>two</p>", ["one", "two"]),
        ("<article><div><select><option>no</div><p>two</p></article>", ["two"]),
        ("<article><p>one</p><template><p>no</p></article><p>two</p>", ["one", "two"]),
        ("<article>a <select><option>no<option>no</select> b</article>", ["a b"]),
        ("<p>one<script>no</p><p>no", ["one"]),
        ("<p>one</b></i><p>two</p>", ["one", "two"]),
        ("<p>1 < 2 <b", ["1 < 2 <b"]),
    ],
)
def test_nothing_is_dropped_after_an_unclosed_element(source, wanted):
    assert [t for _, t in pages.parse(source).texts] == wanted


@pytest.mark.parametrize("part", ["<b>x</i>", "<b><p>x", "<p><ul><b><b><li>x", "<a ", "<svg><p>", "<select><li>", "</p>", "<!--"])
def test_parsing_is_linear(part):
    times = []
    for size in (100_000, 800_000):
        start = time.monotonic()
        pages.parse(part * (size // len(part)))
        times.append(time.monotonic() - start)
    assert times[1] < 16 * max(times[0], 0.2)


MENUS = {
    "class": '<div class="menu"><a href="#">Home</a> <a href="#">News</a></div><div class="content">{}</div><div class="footer">foot</div>',
    "role": '<div role="navigation"><a href="#">Home</a> <a href="#">News</a></div><div role="main">{}</div><div role="contentinfo">foot</div>',
    "id": '<ul id="navigation"><li><a href="#">Home</a></li></ul><div id="main-content">{}</div><div id="footer">foot</div>',
}


@pytest.mark.parametrize("name", MENUS)
def test_tables_without_article_elements(spark, name):
    body = "<h1>A title</h1>" + "".join(f"<p>Paragraph {i} of the text, with some words in it.</p>" for i in range(4))
    frame = spark.createDataFrame([(i, "u", MENUS[name].format(body)) for i in range(6)], "page_id long, url string, html string")
    wanted = "\n\n".join(["A title", *(f"Paragraph {i} of the text, with some words in it." for i in range(4))])
    assert {r.text for r in pages.extract(frame).collect()} == {wanted}


def test_trees_decide_where_no_page_says_where_its_article_is(spark):
    body = "".join(f"<p>Paragraph {i} of the text, with some words in it.</p>" for i in range(4))
    html = f'<div class="menu"><a href="#">Home</a> <a href="#">News</a></div><div>{body}</div><div class="footer">foot</div>'
    frame = spark.createDataFrame([(i, "u", html) for i in range(3)], "page_id long, url string, html string")
    (text,) = {r.text for r in pages.extract(frame).collect()}
    assert text.count("Paragraph") == 4 and "Home" not in text and "foot" not in text


@pytest.mark.skipif(not os.path.isfile(pieces.MODEL), reason="the vocabulary is absent")
def test_long_words_are_split_as_the_library_splits_them():
    import sentencepiece

    r = random.Random(3)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(pieces.load(pieces.MODEL))
    han = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(60_000))
    mixed = ["".join(r.choice("ab名é🙂cZ0_etaoin") for _ in range(r.randrange(1, 300))) for _ in range(100)]
    start = time.monotonic()
    ids, offsets = pieces.encode_batch(encoder, [han, *mixed])
    assert time.monotonic() - start < 10
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [library.encode(t) for t in [han, *mixed]]
    parts, owner = encoder.cut([han, "short", mixed[0]])
    assert "".join(p for p, k in zip(parts, owner, strict=True) if k == 0) == han and len(parts) > 1000


def test_copies_of_a_vector_do_not_become_pairs(spark):
    from ledgerloom.llm import topk

    r = random.Random(5)
    hot = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, hot if i % 3 == 0 else [r.gauss(0, 1) for _ in range(4)]) for i in range(900)] + [(300, hot), (0, [9.0, 9.0, 9.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = sorted(tuple(x) for x in topk.search(table, k=4, query_every=10).collect())
    scaled = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows]
    wanted = []
    for n, (i, q) in enumerate(scaled):
        if i % 10 == 0:
            best = sorted((-int(q @ x), j) for m, (j, x) in enumerate(scaled) if m != n)[:4]
            wanted += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert found == sorted(wanted)
    made = topk.checkpointed(topk.distinct_vectors(topk.vectors(table), 5))
    # 301 copies of the hot vector are one candidate, with five of its rows.
    assert made.count() == 602 and max(len(x.members) for x in made.collect()) == 5


def test_automaton_is_as_large_as_its_bound_says():
    from ledgerloom.llm import decontaminate

    r = random.Random(7)
    text = " ".join("".join(r.choices("abcdefghij", k=r.randrange(3, 9))) for _ in range(decontaminate.PART_BYTES // 14))
    machine = decontaminate.automaton([(1, text)])
    stats = machine.made.get_stats()
    assert stats["nodes_count"] <= 1 + 13 * len(text.split()) and 2 * stats["total_size"] < 200 << 20


@pytest.mark.parametrize("most", [1, 40, 10_000])
def test_pieces_of_an_item_have_its_windows(most):
    from ledgerloom.llm import decontaminate

    r = random.Random(1)
    for n in (0, 1, 5, 12, 13, 14, 40, 200):
        text = " ".join(r.choice(["ab", "É", "x1", "same"]) for _ in range(n))
        parts = decontaminate.pieces(text, 13, most)
        whole = decontaminate.item_windows(text, 13)
        assert set().union(*(decontaminate.item_windows(p, 13) for p in parts)) == whole
        assert all(len(p) <= most + 13 * 6 for p in parts)
