"""Operators on documents against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from docflow.checks.compare import differences
from docflow.llm import anchors, decontamination, jaccard, language, lines, oracles, packing, quality, queries, sharding, suffixes
from tests.llm import brute

SCHEMA = "doc_id long, text string, quality string, slot int, language string, contamination string, spans string, start int"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "a", 1, "b", "c", "d", 2) for k, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    """Null key and text, empty and white texts, ties, a repeated row, a long text, other scripts."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "same words here"), (5, "same words here"), (5, "same words here"), (None, "a null key"),
        (7, long), (8, long), (9, "漢字 ñandú İ Σίσυφος\n\n漢字"), (10, "a\x00b \x85 c"),
    ]


def made(seed: int, n: int = 40, words: int = 60) -> list[tuple]:
    """Documents that share passages, some copied, some nearly."""
    rng = random.Random(seed)
    vocabulary = [rng.choice("aébcdA") * rng.randint(1, 3) + str(rng.randint(0, 60)) for _ in range(300)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 40))) for _ in range(5)]
    rows: list[tuple] = []
    for k in range(n):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, words)))
        if rng.random() < 0.5:
            text += rng.choice(["\n", " "]) + rng.choice(passages) + " " + text[: rng.randint(0, 40)]
        if rows and rng.random() < 0.4:
            old = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randint(0, 3)):
                old[rng.randrange(len(old))] = rng.choice(vocabulary)
            text = " ".join(old)
        rows.append((k, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups(spark, seed):
    rows = made(seed) + [(900, "x y z"), (901, "X y  z"), (902, "x y"), (903, "a b c d e f g h i"), (904, "a b c d e f g h i j")]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(frame(spark, rows), width=3).collect()}
    assert found == brute.similar_groups(rows, 3, 80)


@pytest.mark.parametrize("most", [0, 9, 14])
def test_any_boundary_gives_the_same(spark, monkeypatch, most):
    rng = random.Random(12)
    rows = []
    for k in range(120):
        words = [f"w{i}" for i in range(rng.randint(1, 18))]
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 3)}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(jaccard, "boundary", lambda *_: most)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(frame(spark, rows), width=1).collect()}
    assert found == brute.similar_groups(rows, 1, 80)


def test_hot_group_is_one_component(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(base[:k] + [f"x{k}"] + base[k + 1 :])) for k in range(120)] + [(500, " ".join(f"y{i}" for i in range(50)))]
    monkeypatch.setattr("docflow.llm.exchange.CHUNK_BYTES", 2000)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_groups(frame(spark, rows)).collect()}
    assert found == {k: 0 for k in range(120)} | {500: 500}


@pytest.mark.parametrize("seed", [3, 4])
def test_earlier_spans(spark, monkeypatch, seed):
    monkeypatch.setattr("docflow.llm.exchange.CHUNK_BYTES", 700)
    rows = made(seed)
    for r in suffixes.earlier_spans(frame(spark, rows), width=21, seed=16).collect():
        data, gone = brute.earlier(rows, 21)[r["doc_id"]]
        assert bytes(r["kept"]) == bytes(c for c, g in zip(data, gone) if not g)
        assert (r["n_bytes"], r["n_removed"], sum(s["bytes"] for s in r["spans"])) == (len(data), sum(gone), sum(gone))


def test_equal_keys_are_not_earlier(spark):
    text = "0123456789" * 8
    rows = [(5, text), (5, text), (None, text)]
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in suffixes.earlier_spans(frame(spark, rows)).collect()) == [(0, 80), (5, 0), (5, 0)]


def test_family_keeps_first_occurrences():
    import numpy as np

    rng = random.Random(5)
    family, seen = suffixes.Family(), {}
    for batch in range(30):
        strings = [str(rng.randint(0, 400)).zfill(5).encode() for _ in range(rng.randint(1, 60))]
        docs = sorted(batch * 10 + rng.randint(0, 9) for _ in strings)
        found = family.scan(np.array(strings, "S5"), np.array(docs))
        expected = []
        for s, d in zip(strings, docs):
            expected.append(seen.setdefault(s, d) < d)
        assert found.tolist() == expected
    sizes = [len(x) for x in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


@pytest.mark.parametrize("seed", [6, 7])
def test_repeated_spans(spark, monkeypatch, seed):
    monkeypatch.setattr("docflow.llm.exchange.CHUNK_BYTES", 700)
    rows = made(seed)
    expected = dict(zip([k for k, _ in rows], brute.repeated(rows, 7)))
    for r in anchors.repeated_spans(frame(spark, rows), width=7).collect():
        words, gone = expected[r["doc_id"]]
        assert r["kept_text"] == " ".join(w for w, g in zip(words, gone) if not g)
        assert (r["n_words"], r["n_removed"], sum(s["words"] for s in r["spans"])) == (len(words), sum(gone), sum(gone))


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_find_matches(spark, block_bytes):
    rows = made(8)
    items = [(10 * k, " ".join((t or "").split()[3:30])) for k, t in rows[::4]] + [(7, "b22"), (8, ""), (9, None), (11, "B22 !")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_matches(frame(spark, rows), bench, width=5, block_bytes=block_bytes)
    for r in found.collect():
        c = r["contamination"]
        assert (c["n_words"], c["n_hit"], c["items"]) == brute.hits(r["text"], items, 5)
    kept = decontamination.clean_documents(frame(spark, rows), bench, width=5)
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, t in rows if not brute.hits(t, items, 5)[1]]


def test_longest_matches(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g"), (2, "c d e f x")], "item_id long, text string")
    (row,) = decontamination.find_matches(frame(spark, [(1, "q A, b c d e f! x")]), bench, width=3).collect()
    assert sorted((m["item_id"], m["doc_start"], m["item_start"], m["length"]) for m in row["contamination"]["matches"]) == [("1", 1, 0, 6), ("2", 3, 0, 5)]


@pytest.mark.parametrize("seed", range(4))
def test_longest_match_at_each_place(seed):
    import numpy as np

    rng = random.Random(seed)
    for _ in range(60):
        doc, item = ([rng.randint(1, 3) for _ in range(rng.randint(1, 14))] for _ in range(2))
        found = decontamination.longest(np.array(doc), np.array(item))

        def match(i, k):
            n = 0
            while i + n < len(doc) and k + n < len(item) and doc[i + n] == item[k + n]:
                n += 1
            return n

        best = [max(match(i, k) for k in range(len(item))) for i in range(len(doc))]
        assert [(i, n) for i, _, n in found] == [(i, n) for i, n in enumerate(best) if n and (i == 0 or best[i - 1] <= n)]
        assert all(match(i, k) == n for i, k, n in found)


def test_equal_words_take_little_memory(spark):
    """An item of 2,000 equal words and a document of 20,000: forty million pairs of places that are never laid out."""
    import tracemalloc

    import numpy as np

    block = decontamination.ItemBlock([("a", "x " * 2000), ("b", "x " * 40 + "y")], 10)
    tracemalloc.start()
    ((_, found),) = block.search([np.array([block.code[b"x"]] * 20_000, np.int64)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and max(m["length"] for m in found) == 2000 and {m["item_id"] for m in found} == {"a", "b"}
    bench = spark.createDataFrame([("a", "x " * 2000)], "item_id string, text string")
    (row,) = decontamination.find_matches(frame(spark, [(1, "x " * 20_000)]), bench).collect()
    assert row["contamination"]["n_hit"] == 20_000


def test_clashing_names_pass(spark):
    df = spark.createDataFrame([(1, "a b c", 5, 6, 7)], "doc_id long, text string, matches int, found_0 int, row int")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    (row,) = decontamination.find_matches(df, bench).collect()
    assert (row["matches"], row["found_0"], row["row"], row["contamination"]["n_hit"]) == (5, 6, 7, 3)
    assert decontamination.clean_documents(df, bench.limit(0)).columns == df.columns


def test_line_classes(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choices("abcé ", k=rng.randint(8, 14))) for _ in range(25)]
    rows = []
    for k in range(12):
        own = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(pool))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(["", "z", "zz"])
            own.append("".join(line))
        rows.append((k, "\n".join(own)))
    place = [(k, i, x) for k, t in rows for i, x in enumerate(t.split("\n")) if len(x) >= 8]
    distinct = sorted({x for _, _, x in place})
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if brute.edit_distance(a, b) <= 2]
    root = brute.groups(distinct, links)
    first = {r: min((k, i) for k, i, x in place if root[x] == r) for r in set(root.values())}
    expected = sorted((k, i, sum(x in p for p in links), *first[root[x]], (k, i) != first[root[x]]) for k, i, x in place)
    found = lines.line_classes(frame(spark, rows), min_chars=8)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer

    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [(k, t) for k, t in odd if k not in (5, None)] + [(20 + k, "it's été, we'll " * k) for k in range(60)]
    limits = packing.Limits(tokens=128, segments=5, loss_tokens=100, max_gap=4)
    pieces = packing.pack(frame(spark, rows).repartition(2), path, limits=limits).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for key, text in rows:
        own = sorted(by_doc[key], key=lambda p: p["start"])
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        assert b"".join(bytes(p["ids"]) for p in own) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert [p["start"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p["segment"])
        assert [p["offset"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
        assert sum(p["length"] for p in own) <= 128 and len(own) <= 5 and sum(p["loss_tokens"] for p in own) <= 100


def test_prompts_bear_no_loss(spark):
    import public_tokenizers

    df = spark.createDataFrame([(1, "one two three", "four five")], "doc_id long, ask string, reply string")
    (p,) = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), text="reply", prompt="ask").collect()
    assert (p["length"], p["loss_tokens"]) == (6, 3)


def test_tightest_bin():
    rng = random.Random(10)
    tree, plain = sharding.RemainingTree(), []
    for number in range(3000):
        if rng.random() < 0.5 or not plain:
            item = (rng.randint(1, 500), number)
            tree.insert(*item)
            plain.append(item)
        else:
            size = rng.randint(1, 600)
            expected = min((b for b in plain if b[0] >= size), default=None)
            assert tree.take_tightest(size) == expected
            if expected:
                plain.remove(expected)


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_are_even_and_keep_groups(spark, hot):
    rng = random.Random(11)
    rows = [(k, "x" * rng.randint(0, 300) + str(k % 700)) for k in range(1500)] + [(5000 + k, "hot" * 30) for k in range(hot)]
    found = sharding.best_fit_shards(frame(spark, rows), shards=8).collect()
    sums, slots, shard = {}, {}, {}
    for r in found:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        shard.setdefault(dict(rows)[r["doc_id"]], set()).add(r["shard"])
    assert len(found) == len(rows) and all(len(s) == 1 for s in shard.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sorted(sums) == list(range(8))
    alone = max(sums.values())
    rest = [v for v in sums.values() if not (hot and v == alone)]
    assert max(rest) - min(rest) <= 0.03 * max(rest)


def test_line_rules():
    prose = "This is a line, and it ends well enough for anyone to read it."
    judged = quality.judge("\n".join([prose] + ["a | b | c |", "no %%% yes &&& no", "WOW!! YES!!", "All rights reserved.", prose]), quality.Rules(), quality.BOILERPLATE)
    assert judged[10] == prose and judged[5:7] == (6, 5)
    assert not quality.judge("word " * 60 + ".", quality.Rules(), quality.BOILERPLATE)[9]
    good = "\n".join(" ".join(f"w{i}x{j}" for j in range(9)) + "." for i in range(10))
    assert quality.judge(good, quality.Rules(), quality.BOILERPLATE)[9]
    assert quality.repeated_words([b"a", b"b", b"c", b"x", b"a", b"b", b"c"]) == 6 and quality.repeated_words([b"a"] * 4) == 4


def test_language_held_out(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter("not out"), "text", "lang", per_language=80)
    found = language.identify(docs.filter("out"), model).select("lang", "language.*").collect()
    assert sum(r["lang"] == r["prediction"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_odd(spark, odd):
    docs = frame(spark, odd)
    assert language.fit(docs.limit(0), "text", "language") is None
    one = language.fit(docs, "text", "language")
    found = language.identify(docs, one).collect()
    assert {r["language"]["prediction"] for r in found if not language.has_letter(r["text"])} == {"und"}
    assert {r["language"]["prediction"] for r in found if language.has_letter(r["text"])} == {"b"}
    assert {r["language"]["prediction"] for r in language.identify(docs, None).collect()} == {"und"}


def test_odd_rows_have_results(spark, odd):
    import public_tokenizers

    docs, bench = frame(spark, odd), spark.createDataFrame([(None, "same words here"), (1, None)], "item_id long, text string")
    n = len(odd)
    assert quality.clean_lines(docs).select("quality.*").count() == n
    matches = decontamination.find_matches(docs, bench).collect()
    assert sorted(r["doc_id"] for r in matches if r["contamination"]["n_hit"]) == [4, 5, 5] and len(matches) == n
    assert decontamination.find_matches(docs, bench.limit(0)).filter("contamination.n_hit > 0").count() == 0
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id").distinct().count() == 10
    shards = sharding.best_fit_shards(docs, shards=4).collect()
    assert len(shards) == n and {r["text_crc32"] for r in shards if r["doc_id"] in (1, 2)} == {0}
    groups = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in jaccard.near_groups(docs).collect()}
    assert {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 4, 1), (None, None, 1), (7, 7, 977), (8, 7, 977)} <= groups
    assert jaccard.one_of_each(docs).count() == n - 3
    spans = suffixes.earlier_spans(docs).collect()
    assert len(spans) == n and {r["doc_id"]: r["n_removed"] for r in spans if r["n_removed"]} == {8: len(odd[7][1])}
    again = anchors.repeated_spans(docs).collect()
    assert len(again) == n and {r["doc_id"] for r in again if r["n_removed"]} == {7, 8}
    found = lines.line_classes(docs, min_chars=10).collect()
    assert sorted((r["doc_id"] or 0, r["class_doc"] or 0) for r in found) == [(0, 0), (4, 4), (5, 4), (5, 4), (7, 7), (8, 7), (9, 9)]
    assert {r["doc_id"] for r in lines.drop_lines(docs, min_chars=10).collect()} == {1, 2, 3, 4, None, 7, 9, 10}


def test_empty_tables(spark, odd):
    import public_tokenizers

    docs = frame(spark, odd).limit(0)
    assert quality.clean_lines(docs).count() == 0 and quality.kept_documents(docs).count() == 0
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    for run in (sharding.best_fit_shards, jaccard.near_groups, suffixes.earlier_spans, anchors.repeated_spans, lines.line_classes, lines.drop_lines, jaccard.one_of_each):
        assert run(docs).count() == 0


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.write_once(stage(spark, docs, sf), "test")
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "n-gram Jaccard join":
            groups = brute.similar_groups(list(before.items()), 5, 80)
            assert set(after) == {k for k, (_, c) in groups.items() if c == k}
        if name == "benchmark decontamination":
            assert set(after) == {k for k, t in before.items() if not brute.hits(t, items, 10)[1]}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {p["doc_id"] for p in pieces} == set(before)
    assert hashlib.sha256(b"").hexdigest() and sum(p["length"] for p in pieces) == sum({p["doc_id"]: p["doc_tokens"] for p in pieces}.values())


SHORT = [
    (1, "Les.\nThe first of many lines, long enough.\n}\nOf, edti oner."),
    (2, "Les.\nThe first of mady lines, long enough.\n \t\nOf, edti onar."),
    (3, "}\nLes,\nthree of them here\n"), (4, "three of thm here\nthee of thm here\n\nLas."), (5, "Les.\n}\n}"), (6, "abcdefghijkl\nabcdefghijk"),
]


def line_edits(a: str, b: str) -> int:
    return min(2, min(len(a), len(b)) // 12)


def expected_lines(rows: list[tuple]) -> list[tuple]:
    place = [(k, i, x) for k, t in rows for i, x in enumerate(t.split("\n")) if brute.WORD.search(x)]
    distinct = sorted({x for _, _, x in place})
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if brute.edit_distance(a, b) <= line_edits(a, b)]
    root = brute.groups(distinct, links)
    first = {r: min((k, i) for k, i, x in place if root[x] == r) for r in set(root.values())}
    return sorted((k, i, sum(x in p for p in links), *first[root[x]], (k, i) != first[root[x]]) for k, i, x in place)


def test_lines_of_any_length_have_rows(spark):
    found = {(r["doc_id"], r["line_no"]): (r["n_links"], r["class_doc"], r["class_line"]) for r in lines.line_classes(frame(spark, SHORT)).collect()}
    assert len(found) == 18 and found[5, 0] == (0, 1, 0) and found[5, 2] == (0, 1, 2) and found[3, 1] == (0, 3, 1)
    assert found[2, 1] == (1, 1, 1) and found[2, 3] == (1, 1, 3) and found[4, 1][1:] == (3, 2) and found[6, 1] == (0, 6, 1)
    kept = {r["doc_id"]: r["text"] for r in lines.drop_lines(frame(spark, SHORT)).collect()}
    assert kept == {1: SHORT[0][1], 3: "Les,\nthree of them here\n", 4: "\nLas.", 6: SHORT[5][1]}


@pytest.mark.parametrize("seed", [21, 22])
def test_edits_follow_the_length(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abé ", k=rng.choice([1, 2, 5, 10, 11, 12, 13, 14, 22, 23, 24, 25, 26, 27, 37]))) for _ in range(30)]
    rows = []
    for k in range(24):
        own = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(pool))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(["", "z", "zz"])
            own.append("".join(line))
        rows.append((k, "\n".join(own)))
    assert sorted(tuple(r) for r in lines.line_classes(frame(spark, rows)).collect()) == expected_lines(rows)


@pytest.mark.parametrize("line, fails", [
    ("The design updates are out now.", False), ("A catalog index, in a blog index, and a dialog into it.", False),
    ("Ranked in terms of usefulness.", False), ("Click here to read on.", True), ("Sign up or log in, please!", True),
    ("We use cookies; see our privacy policy, our cookie policy and the terms of use, and sign up or log in.", True),
    ("They read the privacy policy of the shop twice, and then asked about the two passages that nobody there could explain.", False),
])
def test_boilerplate_is_whole_words_and_a_share(line, fails):
    phrases = [x for x in quality.BOILERPLATE if x in line.lower()]
    assert quality.line_fails(line, len(line.split()), len("".join(line.split())), quality.Rules(), phrases) == fails


def test_sql_of_quality_states_the_same_rule(spark):
    """Phrases as whole words, beside each other, in short and long lines, and inside longer words."""
    import duckdb

    rng = random.Random(8)
    pieces = [*quality.BOILERPLATE, "design updates", "catalog index", "log inlog in", "élog in", "sign up_", "Sign up.", "a,", "some words,", *(f"prose that goes on and on, {i}." for i in range(20))]
    rows = [(k, "\n".join(rng.choice([" ", ", ", "|"]).join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(12))) for k in range(60)]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    said = db.execute(oracles.LINE_FIRST_QUALITY)
    names = [d[0] for d in said.description]
    theirs = sorted((r["doc_id"], r["n_failed_lines"], r["kept_chars"], r["kept"]) for r in (dict(zip(names, x)) for x in said.fetchall()))
    ours = quality.clean_lines(frame(spark, rows)).select("doc_id", "quality.n_failed_lines", "quality.kept_chars", "quality.kept").collect()
    assert sorted(tuple(r) for r in ours) == theirs and len({r[1] for r in theirs}) > 4


def test_one_line_documents_are_not_lost_by_a_phrase(spark):
    prose = " ".join(f"word{i}," for i in range(60))
    rows = [(k, f"{prose} {x}.") for k, x in enumerate(["design updates", "catalog index", "and a privacy policy, which is mentioned"])]
    judged = quality.clean_lines(frame(spark, rows)).select("doc_id", "quality.kept", "quality.clean_text", "quality.n_failed_lines").collect()
    assert sorted(tuple(r) for r in judged) == [(k, True, t, 0) for k, t in rows]
    assert quality.kept_documents(frame(spark, rows)).count() == 3


def test_copies_are_sampled_once(spark, monkeypatch):
    rng = random.Random(31)
    different = ["".join(rng.choices("abcdefghij ", k=60)) for _ in range(220)]  # features know letters only
    texts = different[:20] * 100 + different[20:]
    drawn = []
    monkeypatch.setattr(language, "Hierarchy", lambda samples, _: drawn.append(samples))
    language.fit(frame(spark, list(enumerate(texts))), "text", "language", per_language=110)
    rows = [x.tobytes() for x in drawn[0]["b"]]
    assert len(rows) == len(set(rows)) and 80 <= len(rows) <= 140


def test_machines_do_not_depend_on_the_dealing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scores = []
    for partitions in ("8", "31"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            model = language.fit(docs.repartition(int(partitions)), "text", "lang")
            found = language.identify(docs, model).select("doc_id", "language.prediction", "language.score").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        scores.append(sorted(map(tuple, found)))
    assert scores[0] == scores[1]


def test_votes_of_machines_set_by_hand():
    """Families first, then the languages of the family that won: the same as asking every machine in turn."""
    import numpy as np

    rng = np.random.default_rng(9)
    samples = {name: rng.random((6, language.WIDTH)).astype(np.float32) for name in ("en", "de", "fr", "es", "it", "xx")}
    model = language.Hierarchy(samples, language.FAMILIES)
    x = rng.random((40, language.WIDTH)).astype(np.float32)
    names, scores = model.predict(x)

    def winner(duel, row):
        votes, chance = dict.fromkeys(duel.names, 0.0), dict.fromkeys(duel.names, 1.0)
        for m in duel.machines:
            p = 1 / (1 + np.exp(-np.clip(2 * (row @ m.weights + m.offset), -30, 30)))
            votes[m.first] += (p >= 0.5) + p / 1e3
            votes[m.second] += (p < 0.5) + (1 - p) / 1e3
            chance[m.first], chance[m.second] = min(chance[m.first], p), min(chance[m.second], 1 - p)
        best = max(duel.names, key=lambda n: (votes[n], [-k for k in range(1)]))
        return best, chance[best]

    for row, name, score in zip(x, names, scores):
        family, c = winner(model.families, row)
        own, d = winner(model.within[model.families.names.index(family)], row)
        assert own == name and abs(c * d - score) < 1e-4
