import random

import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from postlens.llm.encoding import Encoder  # noqa: E402

PIECES = [
    "the", "The", "don't", "it's,", "été", "ÉTÉ", "straße", "naïve...", "42,", "a1b2", "½,", "日本語", "ﬁ", "İstanbul",
    "été", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>,", "'s,", "''.", " x", "a b", "_,_",
    "ΟΔΟΣ", "!!", ",", "🙂.", "w" * 300, "\x00", "́,",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_ids_equal_the_whole_text(name, limit, monkeypatch):
    monkeypatch.setattr("postlens.llm.encoding.MAX_WORDS", limit)
    rng = random.Random(1)
    encoder = Encoder(P.path(name))
    for _ in range(15):
        texts = ["".join(rng.choice(PIECES) + rng.choice([" ", "\n", "  ", "", "\t"]) for _ in range(rng.randrange(40))) for _ in range(20)]
        texts += ["", " \n"]
        ids, offsets = encoder.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == encoder._whole(text), text
    ids, offsets = encoder.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and offsets.tolist() == [0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_marks_left_by_the_normalizer(name):
    encoder = Encoder(P.path(name))
    # Dotted I, Indic letters with nukta and Hebrew ones with points, which lower-casing or NFC takes apart.
    words = ["BELEDİYESİ", "হয়", "पढ़", "אשׁ", "གྷ", "abਲ਼"]
    letters = [f"ab{chr(c)}" for c in range(0x80, 0x30000) if chr(c).isalnum()]
    texts = [f"{w}{tail}" for w in words for tail in (",", "...", "!?", "")] + [f"{w}." for w in letters] + [" ".join(f"{w}," for w in words)]
    ids, offsets = encoder.encode(pa.array(texts))
    whole = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [t for i, t in enumerate(texts) if ids[offsets[i] : offsets[i + 1]].tolist() != whole[i]] == []
