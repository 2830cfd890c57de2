"""The table of words of the packing holds a corpus's rare words too."""

import public_tokenizers

from matchwright.llm.packing import WordTokenizer


def test_rare_words_are_encoded_once():
    tokenizer = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), 1)
    for k in range(6):
        tokenizer.encode([" ".join(f"{n:x}" for n in range(k * 100_000, (k + 1) * 100_000)).encode()])
    assert {b"%x" % n for n in range(0, 600_000, 1000)} <= tokenizer.words.keys()
