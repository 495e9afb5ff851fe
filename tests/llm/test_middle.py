"""Fill-in-middle over frames against slices of the whole text."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from docflow.llm import middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def expected(key, text):
    text = text or ""
    units, h = UNIT.findall(text), hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    alphabet = ["a", "Bc", "word", " ", "\n", "é", "漢", "\U0001f600", "<", "P>", "<P", ">", "\x00", "1"]
    made = [(k, "".join(rng.choices(alphabet, k=rng.randint(0, 60)))) for k in range(150)]
    return made + [(500, None), (501, ""), (None, "a null key"), (502, "x" * 5000), (502, "x" * 5000), (503, "a <P> b"), (504, "漢" * 3000), (505, "a b " * 60_000)]


@pytest.mark.parametrize("frame_bytes", [1, 7, 64, 1 << 16])
def test_equal_to_slices(spark, frame_bytes):
    rows = rows_of(frame_bytes)
    if frame_bytes < 64:
        rows = [r for r in rows if len(r[1] or "") < 6000]
    df = spark.createDataFrame([(k, t, 7, "s") for k, t in rows], "doc_id long, text string, middle int, stored string")
    m = F.col("middle")
    done = middle.fill_in_middle(middle.framed(df, frame_bytes=frame_bytes), middle.draws(F.col("doc_id")))
    assert done.columns == ["doc_id", "middle"]
    found = done.select(
        "doc_id", m["n"], m["form"], m["prefix_chars"], m["middle_chars"], middle.text_of(m["output"]), middle.digest(m["output"]),
        middle.text_of(middle.restored(m["output"], m["form"])),
    )
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(k, *(e := expected(k, t)), sha(e[-1]), t or "") for k, t in rows]
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(want, key=order)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_frames_behind_each_other_are_a_file(spark):
    text = "".join(random.Random(2).choices("ab é漢\n", k=5000))
    row = middle.framed(spark.createDataFrame([(1, text)], "doc_id long, text string"), frame_bytes=100).first()
    assert len(row["stored"]["frames"]) > 50 and row["stored"]["units"][-1] == len(UNIT.findall(text)) and row["stored"]["chars"][-1] == len(text)
    whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True)
    assert whole.decompress(b"".join(row["stored"]["frames"])).decode() == text


def test_only_cut_frames_are_decompressed(monkeypatch):
    data = "".join(random.Random(3).choices("abc defg", k=20_000)).encode()
    frames, units, chars, marked = middle.encoded(data, 256)
    opened = []
    real = middle.expanded
    monkeypatch.setattr(middle, "expanded", lambda f: opened.append(1) or real(f))
    n = units[-1]
    *_, out = middle.arranged({"frames": frames, "units": units, "chars": chars, "marked": marked}, [n // 3, n // 2, 0, 50], 90, 20)
    assert len(frames) > 70 and len(opened) <= 6 and b"".join(map(real, out)).count(b"<") == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert middle.fill_in_middle(middle.framed(df), middle.draws(F.col("doc_id"))).count() == 0
