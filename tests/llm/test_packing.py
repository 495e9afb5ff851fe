"""The caches of the packing operator's tokenizer."""

import pytest

from docflow.llm import packing

path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_common_words_are_made_once(monkeypatch):
    """However many rare words come between, and in whichever task of a worker; ids are those of the tokenizer."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing.WordTokenizer, "CACHE", 40)
    made, word = [], packing.WordTokenizer._word
    monkeypatch.setattr(packing.WordTokenizer, "_word", lambda self, w: made.append(w) or word(self, w))
    whole, texts = Tokenizer.from_file(path), [f"The river w{k}x runs zu{k}. Émile" for k in range(300)]
    try:
        for text in texts:  # each as in a task of its own
            tokenizer = packing.WordTokenizer.opened(path)
            assert tokenizer.ids(text) == packing.pack_ids(f"<{len(i := whole.encode(text, add_special_tokens=False).ids)}I", *i)
        assert all(made.count(w) == 1 for w in ("The", "river", "runs", "Émile"))
        assert max(len(c) for kept in (tokenizer.words, tokenizer.parts) for c in (kept, kept.older)) <= 40
    finally:
        del packing.WordTokenizer._last
