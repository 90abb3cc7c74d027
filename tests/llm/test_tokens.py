import random

import numpy as np
import sentencepiece

from laserfold.llm import token_counts, tokens
from tests.llm.data import PATH, awkward, documents, library_ids

ODD = list("abcABC'''sStTrReEdD  \t\n\r\x1c\x85\xa0 0129²½ªº_-<|>éÉßẞİıΣςдЖ中") + [
    "<|endoftext|>", "<|startoftext|>", "é", "́", "don't", "I'll", "ﬁ", "​", "\x00", "Ⱥ",
]


def test_encoder_equals_library_on_random_texts():
    encoder = tokens.Encoder(PATH)
    draw = random.Random(3)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 30))) for _ in range(4000)]
    expected = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, want in zip(texts, expected, strict=True):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want.ids
        assert encoder.count(text) == len(want.ids)


def test_encoder_with_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    encoder = tokens.Encoder(PATH)
    text = awkward()[0][1]
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library_ids(text)
    assert len(encoder.word_ids) <= 3


def test_files_of_other_kinds_are_encoded_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = tokens.Encoder(path)
    want = encoder.tokenizer.encode("Two  words\n here", add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids("Two  words\n here"), "<u4").tolist() == want


def test_whole_words_are_proven():
    whole = token_counts.whole_words(PATH)
    assert "the" in whole and "The" not in whole and "don't" not in whole
    for word in random.Random(1).sample(sorted(whole), 200):
        assert len(library_ids(word)) == 1


def test_counts_of_awkward_rows(spark):
    got = token_counts.count_tokens(documents(spark), PATH, limit=200).collect()
    want = []
    for doc_id, text, *_ in awkward():
        n = len(library_ids(text))
        want.append((doc_id, len((text or "").encode()), n, n > 200))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_counts_of_a_sentencepiece_model(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.count_tokens(documents(spark), path).collect()
    want = sorted(str((d, len(model.encode(t or "")))) for d, t, *_ in awkward())
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == want


def test_counts_of_an_empty_table(spark):
    assert token_counts.count_tokens(documents(spark, []), PATH).count() == 0


def test_ascii_pretokens_are_those_of_the_latin_pattern():
    import random

    draw = random.Random(3)
    letters = [chr(c) for c in range(128)] + list("'s't 're'll'd 09 az")
    for _ in range(2000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 40))).lower()
        assert tokens.words(text) == tokens.LATIN_WORDS.findall(text)
        assert tokens.words(text + "é") == tokens.LATIN_WORDS.findall(text + "é")
