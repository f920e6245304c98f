"""Methods against brute force, round trips and held-out accuracy on the driver's tables."""

import html as entities
import os
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from checks import compare
from ledgerloom.llm import langid, licenses, pages, pieces, pii, queries, simhash, substrings, transcripts

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_oracle(spark, name, monkeypatch):
    if name in queries.ORACLES:
        monkeypatch.setitem(compare.QUERIES, name, queries.QUERIES[name])
        monkeypatch.setitem(compare.ORACLES, name, queries.ORACLES[name])
        assert compare.differences(spark, compare.connect(FOLDER), FOLDER, name) == ""
    else:
        assert queries.QUERIES[name](spark, FOLDER).count() > 0


@needs_tables
def test_pipeline_stages(spark):
    before = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    ids = {r.doc_id for r in rows}
    assert len(ids) == len(rows) and all(r.round_trip for r in rows)
    # Brute force of the filtering stages.
    docs = [r for r in before.collect() if r.text and any(c.isalpha() for c in r.text)]
    prints = {r.doc_id: simhash.simhash(r.text) for r in docs}
    root = {i: i for i in prints}
    for _ in range(3):
        for i in prints:
            for j in prints:
                if bin(prints[i] ^ prints[j]).count("1") <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    spark.createDataFrame([(i,) for i in root if root[i] == i], "doc_id long").createOrReplaceTempView("kept_once")
    hit = queries.op10_benchmark_decontamination(spark, FOLDER).where("contaminated")
    dirty = {r.doc_id for r in hit.collect()}
    assert ids == {i for i in root if root[i] == i} - dirty


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_pseudonyms_keep_their_format(spark):
    texts = {
        "card": "4111 1111 1111 1111", "number": "9807915762804490", "mail": "anna.b1@example.com", "ip": "10.2.3.4",
        "iso": "2024-02-29", "dotted": "31.12.1999", "ssn": "123-45-6789", "iban": "DE89 3704 0044 0532 0130 00", "phone": "+1 (017) 555-7713",
    }
    kept = ["999.1.1.1", "2023-02-30", "000-12-3456", "1700-01-01", "DE00 3704 0044 0532 0130 00", "v1.2.3.4.5", "2024"]
    rows = [(k, f"see {v}, {v}!") for k, v in texts.items()] + [(v, v) for v in kept]
    frame = spark.createDataFrame(rows, "name string, text string")
    found = {r.name: r for r in pii.pseudonymise(frame).collect()}
    for name, value in texts.items():
        one, two = re.fullmatch(r"see (.*), (.*)!", found[name].text).groups()
        assert one == two != value and found[name].n_found == found[name].n_changed == 2
        if name != "ip":
            assert re.sub(r"[a-z]", "a", re.sub(r"\d", "9", one)) == re.sub(r"[a-z]", "a", re.sub(r"\d", "9", value))
    for value in kept:
        assert found[value].text == value
    assert luhn(re.sub(r"\D", "", found["card"].text.split(",")[0]))
    iban = found["iban"].text[4:31].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    other = pii.pseudonymise(frame, key="another").where("name = 'ssn'").first().text
    assert other != found["ssn"].text


def test_numbers_without_a_check_digit(spark):
    r = random.Random(8)
    numbers = [n for n in (f"{r.randrange(10**16):016d}" for _ in range(1500)) if not luhn(n)] + [f"411111111111111{d}" for d in range(10)]
    kept = ["1733000000001", "2019-2020-2021-20221", "1234567890123456789"]
    assert not any(luhn(re.sub(r"\D", "", k)) for k in kept)
    rows = spark.createDataFrame([(t, t) for t in {*numbers, *kept}], "name string, text string")
    found = {x.name: x.text for x in pii.pseudonymise(rows).collect()}
    assert all(found[k] == k for k in kept)
    assert all(luhn(found[n]) == luhn(n) and len(found[n]) == 16 and found[n] != n for n in numbers)
    assert len({found[n] for n in numbers}) == len(set(numbers))


def test_longest_match_of_every_pattern(spark):
    texts = [
        "+123 4567 8901 2345 6789 0123", "+1 (0123) 4567 8901", "1234 5678 9012 3456 789", "123-45-6789", "255.255.255.255", "2199-12-31",
        "a" * 300 + "@" + "b" * 60 + ".example", "GB82 1234 5678 9012 3456 7890 1234 5678 901",
    ]
    found = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        # Octets may have another number of digits.
        digits = r"\d+" if i == 4 else r"\w"
        assert found[i].n_found == 1 and re.sub(digits, "x", found[i].text) == re.sub(digits, "x", text)
    assert found[0].text[:3] == "+12" and found[0].n_changed == 1


@pytest.mark.parametrize("size", [2, 3])
def test_digit_network_is_a_permutation(spark, size):
    from pyspark.sql import functions as F

    numbers = spark.range(10**size).select(F.lpad(F.col("id").cast("string"), size, "0").alias("n"))
    assert numbers.select(pii.permute_digits(F.col("n"), "k", "t").alias("p")).distinct().count() == 10**size


def test_date_network_is_a_permutation(spark):
    from pyspark.sql import functions as F

    days = spark.range(146_097).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(pii.pseudo_date(F.col("d"), "k").alias("p")).distinct().count() == 146_097


@needs_tables
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_ngrams_do_not_cross_texts_or_words():
    is_letter = langid.letters()
    texts = ["ab cd", None, "", "é!", "ab"]
    together, starts = langid.ngrams(texts, is_letter)
    for i, text in enumerate(texts):
        alone, _ = langid.ngrams([text], is_letter)
        end = [*starts[1:], len(together[0])][i]
        for a, b in zip(together, alone):
            assert a[starts[i] : end][a[starts[i] : end] < langid.SIZE].tolist() == b[b < langid.SIZE].tolist()


@needs_tables
def test_main_text_equals_article(spark):
    table = spark.read.parquet(f"{LARGER}/pages.parquet")
    sources = {r.page_id: r.html for r in table.collect()}
    for row in pages.extract(table).collect():
        article = re.search(r"(?s)<article>(.*)</article>", sources[row.page_id])[1].replace("<br>", " ")
        blocks = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert row.text == "\n\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)


def test_decoding_keeps_children_only_with_parents():
    parents = [-1, 0, 1, 1, 0, 4]
    kept = pages.decode_tree(parents, np.array([0.0, -1.0, 3.0, -0.5, -2.0, 1.0]))
    assert kept.tolist() == [True, True, True, False, False, False]


@needs_tables
def test_roles_are_recovered(spark):
    table = spark.read.parquet(f"{LARGER}/conversations.parquet")
    from pyspark.sql import functions as F

    found = transcripts.format_turns(table).join(table.select("conv_id", "turn", F.col("role").alias("want")), ["conv_id", "turn"])
    rows = found.where("crc32(cast(conv_id as string)) % 4 = 2").collect()
    assert sum(r.role == r.want for r in rows) > 0.95 * len(rows)


def test_viterbi_in_blocks_equals_one_pass():
    r = np.random.default_rng(0)
    matrices = [r.normal(size=(4, 3)) for _ in range(11)]
    whole = transcripts.best_states(matrices, 3, None)
    blocks = [matrices[:4], matrices[4:9], matrices[9:]]
    ends = transcripts.best_states([transcripts.multiply(b) for b in blocks], 3, None)
    path, before = [], 3
    for block, last in zip(blocks, ends):
        path += transcripts.best_states(block, before, last)
        before = last
    assert path == whole


def test_speakers_inside_a_row(spark):
    labelled = spark.createDataFrame([(i, k, role, f"{role} text {k}") for i in range(20) for k, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    text = "User: hello?\nAssistant: hi\nmore\nUser: bye <|end|>"
    row = spark.createDataFrame([(1, 0, None, text)], labelled.schema)
    found = transcripts.format_turns(row, transcripts.train(labelled)).orderBy("part").collect()
    assert [(r.role, r.text) for r in found] == [("user", "hello?"), ("assistant", "hi\nmore"), ("user", "bye <|end|>")]
    assert found[2].rendered == "<|user|>\nbye <\\|end|>\n<|end|>"


def test_long_conversation(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], ("short?", "a much longer text, with more in it. " * 5)[k % 2]) for k in range(1500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = transcripts.format_turns(frame, transcripts.train(frame)).collect()
    assert len(found) == 1500 and all(r.role == ("user", "assistant")[r.turn % 2] for r in found)


@pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="the vocabulary file is absent")
def test_pieces_equal_the_library_and_come_back(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    r = random.Random(3)
    letters = list("abcdefgh   <>é日本😀\n\t\x00ABCthe ing.,,=-0123456789ß①")
    texts = ["", " ", "a ", "  ", "x" * 3000, "=" * 77 + " " * 40 + "x", "def f(x):\n    return x**2"]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(400)]
    encoder = pieces.Encoder(pieces.load())
    ids, bounds = pieces.encode_batch(encoder, texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == model.encode(text)
        assert pieces.decode(encoder.vocabulary.raw, ids[a:b].tolist()) == text
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encode(frame)).collect()}
    assert back == dict(enumerate(texts))


def test_templates():
    machine = licenses.compile_template("x", "licensed under [the terms of] the {0-2} license [version 2 [or later]]")

    def end(text):
        return machine.longest(text.encode().split(), 0)

    assert end("licensed under the license") == 4
    assert end("licensed under the terms of the new mit license version 2 or later and") == 13
    assert end("licensed under the terms of the new mit license version 3") == 9
    assert end("licensed under the one two three license") is None
    assert end("licensed by the license") is None
    for bad in ("a [b", "a ] b", "[only optional]"):
        with pytest.raises((ValueError, IndexError)):
            licenses.compile_template("x", bad)


def test_license_scan_against_brute_force(spark):
    r = random.Random(6)
    parts = ["GNU", "General", "Public", "License", "Apache", "CC", "by", "MIT", "the", "-", ",", "é", "x"]
    texts = [" ".join(r.choices(parts, k=40)) for _ in range(200)]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in found:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id]))
        places = [(i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))


def test_fm_index_counts_with_weights():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 4, 12).astype(np.uint64) for _ in range(40)]
    weights = r.integers(1, 3, 40)
    index = substrings.FMIndex(parts, weights, 6)
    for length in (1, 3, 6):
        ends = np.concatenate([index.starts[i] + np.arange(length, 13) for i in range(40)])
        found = index.repeated(ends, length)
        counts = {}
        for p, w in zip(parts, weights):
            for s in range(12 - length + 1):
                counts[tuple(p[s : s + length])] = counts.get(tuple(p[s : s + length]), 0) + w
        want = [counts[tuple(p[s : s + length])] >= 2 for p in parts for s in range(12 - length + 1)]
        assert found.tolist() == want
