"""Words are split once per task."""

import os
import random

import pytest

from ledgerloom.llm import pieces


@pytest.mark.skipif(not os.path.isfile(pieces.MODEL), reason="the vocabulary is absent")
@pytest.mark.parametrize("room", [0, 7, 400_000])
def test_words_of_earlier_batches_are_not_split_again(monkeypatch, room):
    import sentencepiece

    monkeypatch.setattr(pieces, "KNOWN_WORDS", room)
    r = random.Random(6)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    words = ["".join(r.choice("etaoin shrdlu名é🙂") for _ in range(r.randrange(1, 70))) for _ in range(60)]
    batches = [[" ".join(r.choices(words, k=20)) for _ in range(8)] + [None, ""] for _ in range(4)]
    encoder, split = pieces.Encoder(pieces.load()), []
    plain = pieces.Encoder.split
    monkeypatch.setattr(pieces.Encoder, "split", lambda self, whole: split.extend(whole) or plain(self, whole))
    for batch in batches:
        ids, offsets = pieces.encode_batch(encoder, batch)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [library.encode(t or "") for t in batch]
    assert len(encoder.known) <= room
    short = [w for w in split if len(w) <= pieces.KNOWN_LENGTH]
    assert room < 400_000 or len(short) == len(set(short))
