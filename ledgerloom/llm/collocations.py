"""Phrase collocations mined from bidirectional FM-indexes of word ids.

1. Every task turns its texts into word ids, language by language, and builds a compressed bidirectional
   index of each `SHARD_WORDS` words: wavelet matrices over the Burrows-Wheeler transforms of the ids and of
   their reversal, depth-limited to the longest phrase. The indexes are written as rows, by shard.
2. Bigrams are enumerated by extending every word's interval to the right. What leaves a shard is a 64-bit
   hash and a count; hashes whose counts sum to less than the least frequency hold no frequent bigram.
3. Each shard gets the hashes it holds that are left, and extends their bigrams: to the left for trigrams,
   then to the right for four words, as long as every bigram inside is left. An interval is kept in both
   transforms, so either side can be extended. Phrases leave as text with their counts, trigrams with the
   words that follow them, dealt to buckets by a hash of the phrase: a row is what a shard has for a
   bucket. A bucket sums its phrases over shards: hashes only spare work, the sums are exact. The words
   that follow are looked at for frequent trigrams only.
4. Cuts, extensions and ranks are joins and aggregates over the frequent phrases. If any longer candidate
   holds a phrase and is nearly as frequent, so is the one between them that is one word longer; so the
   largest left and right extension decide.

No shard depends on another, so counts of any number of shards are sums, and no word or phrase has a task
of its own: a phrase has one entry per shard, however frequent it is, and a bucket holds the phrases of
about `BUCKET_WORDS` words, however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, slices

LONGEST, LEAST, TOP = 4, 30, 2000
#: Words of one index; a text is cut into shards between its pieces only.
SHARD_WORDS = 4_000_000
#: Words that a task holds for all languages together before it builds the largest one's index.
HELD_WORDS = 5_000_000
#: Words of the corpus whose phrases are summed together in one task.
BUCKET_WORDS = 1_000_000
#: Words whose extensions are enumerated at a time.
LANES = 40_000
# A-Z lower-cased, and every separator of pieces as a point.
FOLD = bytes(0x2E if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def pieces_of(text: str | None) -> list[bytes]:
    """Words of a text with a point between its pieces."""
    return [] if text is None else text.encode("utf-8", "replace").translate(FOLD).replace(b".", b" . ").split()


class Wavelet:
    """Wavelet matrix: one packed bit row per level, with the number of ones before each 64-bit word."""

    def __init__(self, rows: list[np.ndarray], zeros: list[int], size: int) -> None:
        self.rows, self.zeros, self.size = rows, zeros, size
        self.counts = [np.concatenate([[0], np.cumsum(np.bitwise_count(r))[:-1]]).astype(np.int32) for r in rows]

    @classmethod
    def of(cls, symbols: np.ndarray, levels: int) -> Wavelet:
        rows, zeros, current = [], [], symbols.astype(np.uint32)
        for bit in reversed(range(levels)):
            ones = (current >> np.uint32(bit) & np.uint32(1)).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            rows.append(np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64))
            left = current[~ones]
            zeros.append(len(left))
            current = np.concatenate([left, current[ones]])
        return cls(rows, zeros, len(symbols))

    def before(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ones of a level before each place."""
        word = places >> 6
        below = self.rows[level][word] & ((np.uint64(1) << (places & 63).view(np.uint64)) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def distinct(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct symbols inside intervals: (interval, symbol, from, to, number of smaller symbols inside).

        `from` and `to` are places behind the last level, where a symbol's occurrences stand together.
        """
        owner, symbol, less = np.arange(len(low)), np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        for level in range(len(self.rows)):
            a, b = self.before(level, low), self.before(level, high)
            zero_low, zero_high = low - a, high - b
            one = np.flatnonzero(b > a)
            zero = np.flatnonzero(zero_high > zero_low)
            shift = self.zeros[level]
            less = np.concatenate([less[zero], less[one] + (zero_high - zero_low)[one]])
            low = np.concatenate([zero_low[zero], a[one] + shift])
            high = np.concatenate([zero_high[zero], b[one] + shift])
            symbol = np.concatenate([symbol[zero] << 1, symbol[one] << 1 | 1])
            owner = np.concatenate([owner[zero], owner[one]])
        return owner, symbol, low, high, less


def _transform(text: np.ndarray, alphabet: int, depth: int) -> np.ndarray:
    """Symbols before the suffixes of a cyclic text, in the order of the suffixes' first `depth` symbols."""
    rank, span, bound = text.astype(np.int64), 1, alphabet
    order = None
    while span < depth:
        key = rank * bound + np.roll(rank, -span)
        order = np.argsort(key)
        span *= 2
        if span < depth:
            moved = key[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(np.append(False, moved[1:] != moved[:-1]))
            bound = int(rank.max()) + 1
    return text[order - 1]


class PhraseIndex:
    """Bidirectional index of a text of word ids from 1 and separators 0; `depth` symbols are sorted.

    An interval is (place in the transform, place in the reversed transform, size). Extending it to the
    right is a backward step in the reversed transform; the place in the other one moves on by the number
    of smaller symbols inside, and likewise to the left.
    """

    def __init__(self, left: Wavelet, right: Wavelet, counts: np.ndarray) -> None:
        self.left, self.right = left, right
        self.first = np.concatenate([[0], np.cumsum(counts)])

    @classmethod
    def of(cls, text: np.ndarray, alphabet: int, depth: int = LONGEST) -> PhraseIndex:
        levels = max(1, (alphabet - 1).bit_length())
        left = Wavelet.of(_transform(text, alphabet, depth), levels)
        right = Wavelet.of(_transform(text[::-1].copy(), alphabet, depth), levels)
        return cls(left, right, np.bincount(text, minlength=alphabet))

    def words(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of single words."""
        return self.first[symbols], self.first[symbols], self.first[symbols + 1] - self.first[symbols]

    def extend(self, interval: tuple[np.ndarray, np.ndarray, np.ndarray], to_right: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Every extension by one word: (number of the interval, word, interval of the longer phrase)."""
        place, other, size = interval if not to_right else (interval[1], interval[0], interval[2])
        wavelet = self.right if to_right else self.left
        owner, symbol, low, high, less = wavelet.distinct(place, place + size)
        keep = symbol > 0
        owner, symbol, low, high, less = owner[keep], symbol[keep], low[keep], high[keep], less[keep]
        place = low + self._shift(wavelet)[symbol]
        moved = other[owner] + less
        return owner, symbol, (moved, place, high - low) if to_right else (place, moved, high - low)

    def _shift(self, wavelet: Wavelet) -> np.ndarray:
        """From the places behind a wavelet's last level to the places of a symbol's suffixes."""
        if not hasattr(wavelet, "shift"):
            owner, symbol, low, _, _ = wavelet.distinct(np.zeros(1, np.int64), np.full(1, wavelet.size))
            wavelet.shift = np.zeros(len(self.first), np.int64)
            wavelet.shift[symbol] = self.first[symbol] - low
        return wavelet.shift

    def packed(self) -> bytes:
        """Bit rows of both transforms, compressed."""
        bits = np.concatenate([*self.left.rows, *self.right.rows]).tobytes()
        return pa.compress(bits, "zstd", asbytes=True)

    @classmethod
    def unpacked(cls, value: bytes, zeros: list[int], counts: np.ndarray) -> PhraseIndex:
        size, levels = int(counts.sum()), len(zeros) // 2
        words = (size + 63) // 64 + 1
        bits = np.frombuffer(pa.decompress(value, 2 * levels * words * 8, "zstd"), np.uint64).reshape(2 * levels, words)
        return cls(Wavelet(list(bits[:levels]), zeros[:levels], size), Wavelet(list(bits[levels:]), zeros[levels:], size), counts)


SHARD = "shard long, lang string, n_words long, vocabulary array<binary>, counts array<int>, zeros array<int>, bits binary"


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS, held_words: int = HELD_WORDS) -> DataFrame:
    """Indexes of the texts, by shard and language; no shuffle. Symbols are numbered by falling frequency."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = 0
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}

        def full(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made
            row = _shard_row(held.pop(lang))
            sizes.pop(lang)
            if row is not None:
                number = (TaskContext.get().partitionId() << 32) + made
                made += 1
                names = ["n_words", "vocabulary", "counts", "zeros", "bits"]
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang]), *row], ["shard", "lang", *names])

        for batch in batches:
            for rows in slices(batch, "text"):
                fresh: dict[str, list[bytes]] = {}
                for text, lang in zip(rows["text"], rows["lang"], strict=True):
                    own = fresh.setdefault("und" if lang is None else lang, [b"."])
                    own += pieces_of(text)
                    own.append(b".")
                for lang, words in fresh.items():
                    held.setdefault(lang, []).append(pa.array(words, pa.binary()).dictionary_encode())
                    sizes[lang] = sizes.get(lang, 0) + len(words)
                    if sizes[lang] >= shard_words:
                        yield from full(lang)
                while sum(sizes.values()) > held_words:
                    yield from full(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from full(lang)

    return docs.select("text", "lang").where("text is not null").mapInArrow(work, SHARD)


def _shard_row(parts: list[pa.Array]) -> list[pa.Array] | None:
    whole = pa.chunked_array(parts).unify_dictionaries()
    words = whole.chunk(0).dictionary
    codes = np.concatenate([c.indices.to_numpy() for c in whole.chunks]).astype(np.int64)
    dot = pc.index(words, pa.scalar(b".", pa.binary())).as_py()
    counts = np.bincount(codes, minlength=len(words))
    n_words = len(codes) - int(counts[dot])
    if not n_words:
        return None
    # The separator is 0, words follow by falling frequency: rare ones share the ends of the upper levels.
    weight = counts.copy()
    weight[dot] = len(codes) + 1
    order = np.argsort(-weight, kind="stable")
    symbol = np.empty(len(words), np.int64)
    symbol[order] = np.arange(len(words))
    text = symbol[codes]
    text = text[np.append(True, (text[1:] > 0) | (text[:-1] > 0))]
    index = PhraseIndex.of(text, len(words))
    zeros = [*index.left.zeros, *index.right.zeros]
    vocabulary = words.take(pa.array(order[1:]))
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (vocabulary, pa.array(np.diff(index.first).astype(np.int32)), pa.array(zeros, pa.int32()))]
    return [pa.array([n_words], pa.int64()), *lists, pa.array([index.packed()], pa.binary())]


def _opened(row: dict) -> tuple[PhraseIndex, np.ndarray]:
    """The index of a row of `shards`, and a hash of each word (0: the separator) in its language."""
    counts = row["counts"].values.to_numpy().astype(np.int64)
    index = PhraseIndex.unpacked(row["bits"].as_py(), row["zeros"].as_py(), counts)
    seed = xxhash.xxh3_64_intdigest(row["lang"].as_py().encode())
    codes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in row["vocabulary"].as_py()), np.uint64, len(counts) - 1)
    return index, np.concatenate([np.zeros(1, np.uint64), codes])


def _pair_hash(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _stirred((codes[a] ^ (codes[a] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + codes[b]).view(np.int64)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _bigrams(index: PhraseIndex) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """(first word, second word, interval) of all bigrams, some words at a time."""
    vocabulary = len(index.first) - 1
    for at in range(1, vocabulary, LANES):
        symbols = np.arange(at, min(at + LANES, vocabulary))
        owner, word, interval = index.extend(index.words(symbols), to_right=True)
        yield symbols[owner], word, interval


def pair_hashes(indexes: DataFrame) -> DataFrame:
    """(hash, shard, n) of each shard's bigrams."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                index, codes = _opened({n: batch.column(n)[i] for n in batch.schema.names})
                for a, b, interval in _bigrams(index):
                    shard = pa.array(np.full(len(a), batch.column("shard")[i].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(_pair_hash(codes, a, b)), shard, pa.array(interval[2].astype(np.int32))], ["hash", "shard", "n"])

    return indexes.select("shard", "lang", "vocabulary", "counts", "zeros", "bits").mapInArrow(work, "hash long, shard long, n int")


# The phrases of a shard that fall into one bucket, with their counts and how many words follow each of them
# there, and those words with their counts. Texts are joined by line feeds, which no word holds.
BUCKET = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("phrases", pa.string()), ("n", pa.list_(pa.int32())), ("followers", pa.list_(pa.int32())), ("next", pa.string()), ("next_n", pa.list_(pa.int32()))])
BUCKET_SQL = "bucket int, lang string, phrases string, n array<int>, followers array<int>, next string, next_n array<int>"
COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def _phrases(row: dict, wanted: np.ndarray, longest: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """(phrase, hash, count, number of followers, followers, their counts) of a shard's phrases all of whose
    bigrams have a wanted hash; the followers of all phrases stand one after the other.

    The longest phrases are followers of those that are a word shorter: they leave the shard as parts of
    these, and are looked at only where the shorter phrase is frequent.
    """
    index, codes = _opened(row)
    vocabulary = pc.cast(row["vocabulary"].values, pa.string())
    found = [(a[k], b[k], tuple(x[k] for x in interval)) for a, b, interval in _bigrams(index) if len(k := np.flatnonzero(np.isin(_pair_hash(codes, a, b), wanted)))]
    if not found:
        return
    symbols = [np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])]
    interval = tuple(np.concatenate([f[2][j] for f in found]) for j in range(3))
    size = len(codes)
    pairs = np.sort(symbols[0] * size + symbols[1])

    def grown(to_right: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Extensions that make a wanted bigram: (number of the phrase, word, interval)."""
        parts: list[tuple] = []
        for at in range(0, len(interval[0]), LANES):
            owner, word, longer = index.extend(tuple(x[at : at + LANES] for x in interval), to_right)
            owner += at
            key = symbols[-1][owner] * size + word if to_right else word * size + symbols[0][owner]
            k = np.flatnonzero(pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key)
            parts.append((owner[k], word[k], *(x[k] for x in longer)))
        owner, word, *longer = [np.concatenate([p[j] for p in parts]) for j in range(5)]
        return owner, word, tuple(longer)

    for length in range(2, longest):
        phrase = pc.binary_join_element_wise(*[vocabulary.take(pa.array(s - 1)) for s in symbols], " ")
        to_right = length % 2 == 1
        place = np.zeros(len(interval[0]), np.uint64)
        for symbol in symbols:
            place = _stirred(place * np.uint64(0x9E3779B97F4A7C15) + codes[symbol])
        if length < longest - 1:
            yield phrase, place, interval[2], np.zeros(len(place), np.int64), vocabulary[:0], np.zeros(0, np.int64)
            owner, word, longer = grown(to_right)
            old = [s[owner] for s in symbols]
            symbols, interval = [*old, word] if to_right else [word, *old], longer
        else:
            owner, word, longer = grown(True)
            order = np.argsort(owner, kind="stable")
            yield phrase, place, interval[2], np.bincount(owner, minlength=len(place)), vocabulary.take(pa.array(word[order] - 1)), longer[2][order]
        if not len(interval[0]):
            return


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _bucket_rows(lang: str, found: tuple, buckets: int) -> pa.Table:
    """Rows of BUCKET of some phrases of a shard, as `_phrases` gives them: one for each bucket that has any."""
    phrase, place, n, followers, following, following_n = found
    bucket = (place % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    start = np.cumsum(followers) - followers
    count = followers[order]
    behind = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(start[order] - behind[:-1], count) + np.arange(behind[-1])
    numbers, first = np.unique(bucket[order], return_index=True)
    bounds = np.append(first, len(order))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), phrase.take(pa.array(order))), "\n")
    next_words = pc.binary_join(pa.ListArray.from_arrays(pa.array(behind[bounds].astype(np.int32)), following.take(pa.array(at))), "\n")
    langs = pa.array([lang]).take(pa.array(np.zeros(len(numbers), np.int32)))
    return pa.Table.from_arrays([pa.array(numbers.astype(np.int32)), langs, joined, _lists(n[order], bounds), _lists(count, bounds), next_words, _lists(following_n[at], behind[bounds])], schema=BUCKET)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().astype(np.int64)


def _counted(part: pa.Table, least: int) -> pa.Table:
    """Rows of COUNTED of a bucket: its phrases with a sum of `least` or more, and those with one more word."""
    lists = pc.split_pattern(part["phrases"], "\n")
    texts = pc.list_flatten(lists).combine_chunks().dictionary_encode()
    langs = part["lang"].combine_chunks().dictionary_encode()
    many = len(texts.dictionary)
    lang = np.repeat(langs.indices.to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy())
    keys, own = np.unique(lang * many + texts.indices.to_numpy(), return_inverse=True)
    f = np.bincount(own, _flat(part["n"]), len(keys)).astype(np.int64)
    made = []

    def add(key: np.ndarray, phrase: pa.Array, sums: np.ndarray) -> None:
        words = pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32())
        made.append(pa.Table.from_arrays([langs.dictionary.take(pa.array(key // many)), phrase, words, pa.array(sums)], schema=COUNTED))

    kept = np.flatnonzero(f >= least)
    add(keys[kept], texts.dictionary.take(pa.array(keys[kept] % many)), f[kept])
    # The words that follow a phrase are looked at where it is frequent.
    with_next = part.filter(pc.greater(pc.list_value_length(part["next_n"]), 0))
    if with_next.num_rows:
        following = pc.list_flatten(pc.split_pattern(with_next["next"], "\n")).combine_chunks().dictionary_encode()
        owner = np.repeat(own.ravel(), _flat(part["followers"]))
        open_ = np.flatnonzero(f[owner] >= least)
        size = len(following.dictionary)
        longer, which = np.unique(owner[open_] * size + following.indices.to_numpy()[open_], return_inverse=True)
        g = np.bincount(which, _flat(with_next["next_n"])[open_], len(longer)).astype(np.int64)
        longer, g = longer[g >= least], g[g >= least]
        key = keys[longer // size]
        add(key, pc.binary_join_element_wise(texts.dictionary.take(pa.array(key % many)), following.dictionary.take(pa.array(longer % size)), " "), g)
    return pa.concat_tables(made)


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD_WORDS, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, languages): (lang, phrase, words, f) of all phrases of up to `longest` words with f >= least, f over
    all texts; and (lang, n) with the number of words of each language."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    indexes = checkpointed(shards(docs, shard_words))
    languages = checkpointed(indexes.groupBy("lang").agg(F.sum("n_words").alias("n")))
    buckets = 1 + (languages.agg(F.sum("n")).first()[0] or 0) // bucket_words
    hashed = pair_hashes(indexes)
    total = F.sum("n").over(Window.partitionBy("hash"))
    left = hashed.withColumn("total", total).where(F.col("total") >= least).select("shard", "hash")

    def whole(key: tuple, index: pa.Table, wanted: pa.Table) -> pa.Table:
        hashes = np.unique(wanted.column("hash").to_numpy())
        if not index.num_rows or not len(hashes):
            return BUCKET.empty_table()
        row = {n: index.column(n)[0] for n in index.column_names}
        made = [_bucket_rows(row["lang"].as_py(), found, buckets) for found in _phrases(row, hashes, max(longest, 3))]
        return pa.concat_tables(made) if made else BUCKET.empty_table()

    def counted(part: pa.Table) -> pa.Table:
        return _counted(part, least)

    grown = indexes.drop("n_words").groupBy("shard").cogroup(left.groupBy("shard")).applyInArrow(whole, BUCKET_SQL)
    longer = grown.groupBy("bucket").applyInArrow(counted, "lang string, phrase string, words int, f long")
    words = F.expr("explode(transform(arrays_zip(vocabulary, slice(counts, 2, size(vocabulary))), x -> struct(cast(x.vocabulary as string) as phrase, x.`1` as n)))")
    single = indexes.select("lang", words.alias("of")).groupBy("lang", "of.phrase").agg(F.sum("of.n").alias("f"))
    single = single.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("words"), "f")
    phrases = single.unionByName(longer).where(F.col("words") <= longest)
    return checkpointed(phrases), languages


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """All scored phrases: lang, phrase, words, a, cut, l, r, score, left_most, right_most, absorbed.

    `a` is the phrase's frequency, `l` and `r` those of its parts at the cut of lowest score
    floor(2000000 * a / (l + r)), the smallest such cut; `left_most` and `right_most` are the frequencies of
    its most frequent extension by a word on either side (null below `least` or beyond `longest` words), and
    `absorbed` says whether one of them is at least 0.8 a.
    """
    return scored_phrases(frequent(docs, least, longest, shard_words)[0])


def scored_phrases(phrases: DataFrame) -> DataFrame:
    """`collocations` of phrases that have been counted."""
    split = F.split("phrase", " ")
    parts = phrases.where("words > 1").withColumn("word", split)
    words = F.col("words")

    def joined(start: object, length: object) -> object:
        return F.array_join(F.slice("word", start, length), " ")

    cuts = parts.withColumn("cut", F.explode(F.sequence(F.lit(1), words - 1)))
    cuts = cuts.select("lang", "phrase", "words", F.col("f").alias("a"), "cut", joined(1, F.col("cut")).alias("first"), joined(F.col("cut") + 1, words - F.col("cut")).alias("rest"))
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    # Decimals of 38 digits: the product may pass 64 bits.
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = F.min(F.struct(score.cast("long").alias("score"), "cut", "l", "r"))
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(best.alias("best"))
    lowest = lowest.select("lang", "phrase", "words", "a", "best.*")

    longer = parts.where("words > 2")
    without_first = longer.select("lang", joined(2, words - 1).alias("phrase"), F.col("f").alias("left_f"), F.lit(None).cast("long").alias("right_f"))
    without_last = longer.select("lang", joined(1, words - 1).alias("phrase"), F.lit(None).cast("long").alias("left_f"), F.col("f").alias("right_f"))
    sides = without_first.unionByName(without_last).groupBy("lang", "phrase").agg(F.max("left_f").alias("left_most"), F.max("right_f").alias("right_most"))
    most = F.greatest("left_most", "right_most").cast("decimal(20,0)")
    absorbed = F.coalesce(most * 100 >= F.col("a").cast("decimal(20,0)") * 80, F.lit(False))
    found = lowest.join(sides, ["lang", "phrase"], "left")
    return found.select("lang", "phrase", "words", "a", "cut", "l", "r", "score", "left_most", "right_most", absorbed.alias("absorbed"))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The `top` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Phrases absorbed by a longer one are left out; the order is score, then a, both falling, then phrase in
    byte order, so there are no ties. A null lang is `und`. Null, empty and blank texts have no words;
    whole texts are read, however long, and cut between pieces only; rows that repeat a document count
    each. An empty table, and a language without frequent phrases, give no rows. Only text and lang are
    read, so no other column can clash.
    """
    phrases, languages = frequent(docs, least, longest, shard_words)
    kept = scored_phrases(phrases).where(~F.col("absorbed"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(languages, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
