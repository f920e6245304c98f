"""Rows of shards and files of shuffles grow no faster than the input."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import collocations


def test_shuffle_files_of_a_checkpoint_are_removed(spark):
    from pyspark.sql import functions as F

    from ledgerloom.llm import common

    def files():
        made = set()
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        for f in manager.getAllFiles().mkString("\n").split("\n"):
            if f.endswith(".data"):
                made.add(f)
        return made

    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    before = files()
    found = common.checkpointed(counts)
    assert files() <= before
    assert sorted((r.k, r.n) for r in found.collect()) == [(k, 100) for k in range(10)]
    assert spark.conf.get(common.CLEANUP, "false") == "false"


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_of_a_shard_leave_as_one_row_a_bucket(spark, monkeypatch, longest):
    r = random.Random(12)
    words = ["a", "b", "É", "名", "\x00", "\x1cx"]
    docs = [(" ".join(r.choices([*words, "x.", "\ny"], k=60)), r.choice(["en", None])) for _ in range(40)]
    counts = Counter()
    for text, lang in docs:
        for piece in text.replace(".", "\n").split("\n"):
            own = piece.split(" ")
            own = [w for w in own if w]
            counts.update((lang or "und", " ".join(own[i : i + k]), k) for k in range(1, longest + 1) for i in range(len(own) - k + 1))
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    phrases, _ = collocations.frequent(frame, 5, longest, 300, bucket_words=200)
    found = [tuple(x) for x in phrases.select("lang", "phrase", "words", "f").collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(*k, n) for k, n in counts.items() if n >= 5}


def test_rows_of_a_shard_do_not_grow_with_its_phrases():
    r = random.Random(3)
    for size in (2_000, 20_000):
        text = np.array([0] + [r.randrange(0, 40) for _ in range(size)] + [0])
        index = collocations.PhraseIndex.of(text, 40)
        row = {"lang": pa.scalar("en"), "vocabulary": pa.scalar([b"w%d" % i for i in range(1, 40)]), "counts": pa.scalar(np.diff(index.first).tolist()), "zeros": pa.scalar([*index.left.zeros, *index.right.zeros]), "bits": pa.scalar(index.packed())}
        _, codes = collocations._opened(row)
        wanted = np.concatenate([collocations._pair_hash(codes, a, b) for a, b, _ in collocations._bigrams(index)])
        made = pa.concat_tables([collocations._bucket_rows("en", x, 8) for x in collocations._phrases(row, wanted, 4)])
        assert made.num_rows == 16
        grams = Counter(tuple(text[i : i + 3].tolist()) for i in range(len(text) - 2) if 0 not in text[i : i + 3])
        assert sum(map(len, made["n"].to_pylist()[8:])) == len(grams)
