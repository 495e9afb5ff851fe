import random

import numpy as np
import pyarrow as pa

from docflow.llm import texts
from docflow.llm.anchors import Words
from docflow.llm.jaccard import Shingles


def odd_texts():
    rng = random.Random(7)
    made = ["".join(rng.choice("aZ \té€😀\n\x00\x0b\x85 .b") for _ in range(rng.randrange(90))) for _ in range(300)]
    long = "x" * 64 + " " + "x" * 65 + " " + "y" * 3000 + " " + "x" * 65 + "\x00"
    return [None, "", "end", "start", " ", "a  b ", long, "a\x00 a a\x00\x00", None, *made, "last "]


def test_words_of_many_texts_are_those_of_each():
    given = odd_texts()
    for column in (pa.chunked_array([given[:5], [], given[5:]], pa.string()), pa.chunked_array([given], pa.string()).slice(3), pa.chunked_array([], pa.string())):
        for lower in (False, True):
            want = [texts.words(t.as_py().translate({c: c + 32 for c in range(65, 91)}) if lower and t.as_py() else t.as_py()) for t in column]
            got = texts.Words(column, lower)
            flat = [w for x in want for w in x]
            assert [got.data[a:b].tobytes() for a, b in zip(got.begin, got.end)] == flat
            assert got.start.tolist() == np.cumsum([0, *map(len, want)]).tolist()
            hashes = got.hashes()
            assert len(set(zip(hashes.tolist(), flat))) == len(set(hashes.tolist())) == len(set(flat))
            rng = np.random.default_rng(1)
            for chosen in (rng.random(len(flat)) < 0.6, np.ones(len(flat), bool), np.zeros(len(flat), bool)):
                mask = iter(chosen.tolist())
                assert got.joined(chosen).to_pylist() == [b" ".join([w for w in x if next(mask)]).decode() for x in want]


def test_no_word_becomes_an_object(monkeypatch):
    """Chunks of op7 and op10 are cut and hashed as arrays: a list of words a document was most of their time."""
    monkeypatch.setattr(texts, "words", None)
    documents = pa.table({"key": list(range(len(odd_texts()))), "text": pa.array(odd_texts(), pa.string())})
    assert len(Words(documents).hash) and len(Shingles(documents, 5).hash)
