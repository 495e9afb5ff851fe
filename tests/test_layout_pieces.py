import random

from pyspark.sql import functions as F

from docflow.checks import shapes
from docflow.operators import layout as L


def test_pieces_are_those_of_substr(spark):
    """By places of UTF-32, whatever the characters, also where a piece begins with a byte order mark or lies outside of the text."""
    rng = random.Random(3)
    texts = ["", "﻿a﻿", "plain words", "".join(rng.choice("aé€😀﻿\n") for _ in range(50)), None]
    rows = [(t, o, n) for t in texts for o in [*range(-4, 14), 60, None] for n in (-1, 0, 1, 3, 70, None)]
    df = spark.createDataFrame(rows, "t string, o bigint, n bigint")
    plain = F.substr("t", (F.col("o") + 1).cast("int"), F.col("n").cast("int"))
    got = df.select(L._piece(F.encode("t", "UTF-32"), F.col("o"), F.col("n")).alias("got"), plain.alias("want")).collect()
    assert len(got) == len(rows) and all(r["got"] == r["want"] for r in got)


def test_texts_are_split_once_a_document(spark, tmp_path):
    """A text is split where it is bound, not within the function that makes a row of each line."""
    texts = [(1, "one\n\nthree\n" + "x\n" * 40), (2, None), (3, ""), (4, "\n".join(str(i) * (i % 3) for i in range(60)))]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    made = shapes.layout(spark, str(tmp_path))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1 and plan.index("split(text") < plan.index("aggregate(")
    for r in made.collect():
        text = dict(texts)[r["doc_id"]]
        if text is None:
            assert r["paragraphs"] is None and r["tables"] is None
            continue
        lines, at, want, tables = text.split("\n"), 0, [], []
        for i, line in enumerate(lines):
            if line:
                want.append((at, len(line)))
                if i % 9 == 8:
                    after = i % 18 == 17 and i + 1 < len(lines) and lines[i + 1]
                    tables.append([(at, len(line))] + ([(at + len(line) + 1, len(lines[i + 1]))] if after else []))
            at += len(line) + 1
        assert [tuple(p["spans"][0]) for p in r["paragraphs"]] == want
        assert [[tuple(s) for s in t["spans"]] for t in r["tables"]] == tables
