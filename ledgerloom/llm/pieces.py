"""SentencePiece encoding and decoding by batched Viterbi in numpy.

The vocabulary is a byte-pair model with byte fallback: its pieces carry merge priorities, not
probabilities. A split of a word is the model's own split exactly if every piece and every pair of
neighbouring pieces is what merging alone makes of its characters, so the best path is found by a
Viterbi pass whose transition from piece to piece is allowed or not. No piece has a space mark after
another character, so a text falls into words that are split independently; distinct words are done
once per batch. Words of one length advance together: at each place, hashes of all substrings that end
there probe the sorted piece keys, and the maximum over the allowed ones is stored as backpointer.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import map_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
MULTIPLIER = 0x9E3779B97F4A7C15
#: Remembered pairs of neighbouring pieces; beyond it they are judged anew.
PAIRS = 2_000_000
BATCH = 4_000_000
# Characters up to which a word is not looked through for places to cut it.
LONG_WORD = 48
CELLS = 2_000_000
#: Words whose ids an encoder remembers from batch to batch, and the characters of the longest of them.
KNOWN_WORDS, KNOWN_LENGTH = 400_000, 48
# Bits of a piece key that the sieve looks at: a substring that it does not know is no piece.
SIEVE_BITS = 22


@dataclass
class Vocabulary:
    """Pieces with their merge priorities; `ids` leaves out control pieces and bytes."""

    scores: dict[str, float]
    ids: dict[str, int]
    raw: list[bytes]
    byte_ids: list[int]


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, read on the driver; its size is fixed by the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, ids, raw, byte_ids = {}, {}, [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            raw.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            raw.append(b"")
        else:
            scores[piece], ids[piece] = model.get_score(i), i
            raw.append(piece.replace(SPACE, " ").encode())
    return Vocabulary(scores, ids, raw, byte_ids)


def merged(scores: dict[str, float], text: str) -> list[str]:
    """Pieces of a short text by merging alone: always the leftmost of the neighbours of highest priority."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _key(codes: np.ndarray) -> int:
    h = 0
    for c in codes.tolist():
        h = (h * MULTIPLIER + c + 1) & 0xFFFFFFFFFFFFFFFF
    return h


@dataclass
class Encoder:
    """A vocabulary ready for batched Viterbi. Characters without a piece are ids from `unknown` on, by code point."""

    vocabulary: Vocabulary
    keys: np.ndarray = field(init=False)
    key_ids: np.ndarray = field(init=False)
    names: dict[int, str] = field(init=False)
    longest: int = field(init=False)
    neighbours: np.ndarray = field(init=False)
    sieve: np.ndarray = field(init=False)
    known: dict[str, int] = field(default_factory=dict)
    known_ids: list[np.ndarray] = field(default_factory=list)
    known_sizes: list[np.ndarray] = field(default_factory=list)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    allowed: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def __post_init__(self) -> None:
        v = self.vocabulary
        # A piece that merging never makes of its own characters cannot end up in a split.
        own = {p: i for p, i in v.ids.items() if merged(v.scores, p) == [p]}
        keys = np.array([_key(np.array([ord(c) for c in p])) for p in own], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(own.values()), np.int64)[order]
        if len(keys) and not (np.diff(self.keys) > 0).all():
            raise ValueError("two pieces share a key")
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[self.keys >> np.uint64(64 - SIEVE_BITS)] = True
        self.names = {i: p for p, i in own.items()}
        self.longest = max(map(len, own), default=1)
        beside = {ord(a) << 21 | ord(b) for p in v.scores for a, b in zip(p, p[1:], strict=False)}
        self.neighbours = np.array(sorted(beside), np.int64)
        self.unknown = len(v.raw)

    def name(self, i: int) -> str:
        return self.names[i] if i < self.unknown else chr(i - self.unknown)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging alone splits the two pieces' characters into just these two."""
        want = (left << 22) | right
        distinct, back = np.unique(want, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pairs, distinct), max(0, len(self.pairs) - 1))
        known = self.pairs[at] == distinct if len(self.pairs) else np.zeros(len(distinct), bool)
        result = np.zeros(len(distinct), bool)
        if known.any():
            result[known] = self.allowed[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            scores = self.vocabulary.scores
            for i in fresh.tolist():
                a, b = self.name(int(distinct[i]) >> 22), self.name(int(distinct[i]) & 0x3FFFFF)
                result[i] = merged(scores, a + b) == [a, b]
            if len(self.pairs) + len(fresh) > PAIRS:
                self.pairs, self.allowed = distinct, result
            else:
                pairs = np.concatenate([self.pairs, distinct[fresh]])
                order = np.argsort(pairs, kind="stable")
                self.pairs, self.allowed = pairs[order], np.concatenate([self.allowed, result[fresh]])[order]
        return result[back.ravel()]

    def split_equal(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Backpointers (piece lengths) and piece ids, words by places, of words of one length."""
        n, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size).astype(np.int64)
        prefix = np.zeros((n, size + 1), np.uint64)
        for j in range(size):
            prefix[:, j + 1] = prefix[:, j] * np.uint64(MULTIPLIER) + codes[:, j].astype(np.uint64) + np.uint64(1)
        powers = np.array([pow(MULTIPLIER, k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        back = np.zeros((n, size + 1), np.int64)
        last = np.full((n, size + 1), -1, np.int64)
        for j in range(1, size + 1):
            spans = np.arange(1, min(j, self.longest) + 1)
            starts = j - spans
            probe = prefix[:, [j]] - prefix[:, starts] * powers[spans]
            ids = np.full(probe.shape, -1, np.int64)
            likely = np.flatnonzero(self.sieve[probe.ravel() >> np.uint64(64 - SIEVE_BITS)])
            wanted = probe.ravel()[likely]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            ids.ravel()[likely] = np.where(self.keys[at] == wanted, self.key_ids[at], -1)
            ids[:, 0] = np.where(ids[:, 0] < 0, self.unknown + codes[:, j - 1], ids[:, 0])
            before = last[:, starts]
            open_ = (ids >= 0) & ((before >= 0) | (starts == 0))
            check = open_ & (starts > 0)
            rows, cols = np.nonzero(check)
            if len(rows):
                open_[rows, cols] = self.compatible(before[rows, cols], ids[rows, cols])
            best = np.where(open_, spans, 0)
            pick = best.argmax(axis=1)
            line = np.arange(n)
            back[:, j] = best[line, pick]
            last[:, j] = np.where(back[:, j] > 0, ids[line, pick], -1)
        return back, last

    def cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """(parts of the words in order, number of the word of each part).

        A word of over LONG_WORD characters is cut where no piece holds the two characters beside each other:
        no merge can cross that place, so the parts are split as the whole would be, and many short
        parts advance together where a text without spaces would advance alone.
        """
        parts: list[str] = []
        owner: list[int] = []
        for k, word in enumerate(words):
            if len(word) <= LONG_WORD:
                parts.append(word)
                owner.append(k)
                continue
            codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            beside = codes[:-1] << 21 | codes[1:]
            at = np.minimum(np.searchsorted(self.neighbours, beside), max(0, len(self.neighbours) - 1))
            apart = self.neighbours[at] != beside if len(self.neighbours) else np.ones(len(beside), bool)
            edges = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
            parts += [word[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            owner += [k] * (len(edges) - 1)
        return parts, np.array(owner, np.int64)

    def split(self, whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, where each word's ids start and end)."""
        words, owner = self.cut(whole)
        lengths = np.array([len(w) for w in words], np.int64)
        own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(lengths).tolist():
            members = np.flatnonzero(lengths == size)
            step = max(1, CELLS // (size + self.longest))
            for a in range(0, len(members), step):
                part = members[a : a + step]
                back, last = self.split_equal([words[i] for i in part.tolist()])
                place, lane, order = np.full(len(part), size), np.arange(len(part)), 0
                while len(lane):
                    own.append((part[lane], np.full(len(lane), order), last[lane, place]))
                    moved = place - back[lane, place]
                    lane, place = lane[moved > 0], moved[moved > 0]
                    order += 1
        if not own:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        word, order, ids = (np.concatenate(x) for x in zip(*own, strict=True))
        at = np.lexsort((-order, word))
        word, ids = owner[word[at]], ids[at]
        return self._with_bytes(word, ids, len(whole))

    def extended(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`split` of the remembered words and behind them the fresh ones, which are remembered while there is room."""
        ids, bounds = self.split(fresh)
        every = np.concatenate([*self.known_ids, ids])
        sizes = np.concatenate([*self.known_sizes, np.diff(bounds)])
        whole = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        keep = [i for i, w in enumerate(fresh) if len(w) <= KNOWN_LENGTH][: KNOWN_WORDS - len(self.known)]
        if keep:
            self.known |= {fresh[i]: len(self.known) + k for k, i in enumerate(keep)}
            chosen = np.array(keep)
            count = np.diff(bounds)[chosen]
            at = np.repeat(bounds[chosen] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            self.known_ids, self.known_sizes = [*self.known_ids, ids[at]], [*self.known_sizes, count]
        return every, whole

    def _with_bytes(self, word: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the bytes of their UTF-8 form."""
        odd = np.flatnonzero(ids >= self.unknown)
        if len(odd):
            codes, back = np.unique(ids[odd], return_inverse=True)
            forms = [[self.vocabulary.byte_ids[b] for b in chr(int(c) - self.unknown).encode("utf-8", "surrogatepass")] for c in codes]
            times = np.ones(len(ids), np.int64)
            times[odd] = np.array([len(f) for f in forms])[back.ravel()]
            word, spread = np.repeat(word, times), np.repeat(ids, times)
            starts = (np.cumsum(times) - times)[odd]
            for k in range(4):
                has = times[odd] > k
                spread[starts[has] + k] = np.array([f[k] if k < len(f) else 0 for f in forms])[back.ravel()[has]]
            ids = spread
        return ids, np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])


def units(text: str) -> list[str]:
    """The words of a text: a leading space mark is added, each space is a mark, and marks start words."""
    return UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def encode_batch(encoder: Encoder, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, offsets). A null or empty text has none."""
    order: list[int] = []
    sizes = []
    fresh: dict[str, int] = {}
    known = encoder.known
    for text in texts:
        own = units(text) if text else []
        # Words of this batch are numbered behind the remembered ones.
        order += [n if (n := known.get(u)) is not None else len(known) + fresh.setdefault(u, len(fresh)) for u in own]
        sizes.append(len(own))
    ids, bounds = encoder.extended(list(fresh))
    which = np.array(order, np.int64)
    start, count = bounds[:-1][which] if len(which) else which, np.diff(bounds)[which] if len(which) else which
    total = np.concatenate([[0], np.cumsum(count)])
    flat = ids[np.repeat(start - total[:-1], count) + np.arange(total[-1])] if len(which) else ids
    return flat, total[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]


def decode(raw: list[bytes], ids: list[int] | np.ndarray) -> str:
    """The text of ids: pieces and bytes joined, without the added leading space; broken bytes become U+FFFD."""
    text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, path: str = MODEL, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns` (long), ids, n_tokens and round_trip per document; no shuffle.

    A null text has null ids, no tokens and a null round_trip; an empty text has empty ids. round_trip
    tells whether decoding gives the text back; only texts that hold the space mark itself, or
    characters outside UTF-8, do not come back. Whole texts are encoded, also very long words, which are
    cut where no piece can cross. Repeated rows each get their ids; an empty table gives no rows; only
    `columns` and text are read, so other columns cannot clash.
    """
    vocabulary = load(path)

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        encoder = Encoder(vocabulary)

        def work(rows: dict[str, list]) -> dict[str, list]:
            ids, offsets = encode_batch(encoder, rows["text"])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=pa.array([t is None for t in rows["text"]])
            )
            same = [
                None if t is None else decode(vocabulary.raw, ids[a:b].tolist()) == t
                for t, a, b in zip(rows["text"], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            return {c: rows[c] for c in columns} | {"ids": lists, "n_tokens": np.diff(offsets), "round_trip": same}

        return work

    schema = ", ".join(f"{c} long" for c in columns) + ", ids array<int>, n_tokens long, round_trip boolean"
    return map_texts(docs, [*columns, "text"], "text", schema, work=dict, setup=setup, chars=BATCH)


def decoded(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text, an id outside the vocabulary is an error."""
    raw = load(path).raw

    def work(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "text": [None if x is None else decode(raw, x) for x in rows["ids"]]}

    return map_texts(tokens, ["doc_id", "ids"], "ids", "doc_id long, text string", work)
