import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions import text as T
from docflow.operators import pages as P
from docflow.operators.chunks import build_chunks, embed_chunks
from docflow.checks.stub import StubClient
from docflow.operators.model import embed_text
from docflow.plans import documents
from docflow.session import fresh_path
from docflow.sources import files

M = "[missing]"
SAMPLES = os.environ.get("DOCFLOW_SAMPLE_EXTRACTS")  # a folder of page extracts, a sub-folder per document


def by_hand(doc):
    """Walk the pages of one document in order; ``doc`` is a list of pages, a page a list of [section, parent, text]."""
    changed = [False] * len(doc)
    absent = lambda x: x.strip() == M
    for at in range(1, len(doc)):
        here, before = doc[at] or [], doc[at - 1] or []
        if not here:
            continue
        top = here[0]
        if before and top[2].strip() not in ("", M) and absent(top[0]):
            end = before[-1]
            if not absent(end[0]):
                top[0], changed[at] = end[0], True
            elif absent(top[1]) and not absent(end[1]):
                top[1], changed[at] = end[1], True
        for above, item in zip(here, here[1:]):
            if absent(item[0]) and absent(item[1]):
                item[0], item[1], changed[at] = above[0], above[1], True
    return changed


def random_document(rng):
    pages = []
    for _ in range(rng.randrange(1, 9)):
        if rng.random() < 0.15:
            pages.append(rng.choice([None, []]))
            continue
        name = lambda p, a: M if rng.random() < p else f"{a}{rng.randrange(50)}"
        pages.append(
            [[name(0.75, "s"), name(0.75, "p"), rng.choice(["text", "text", "text", " ", M])] for _ in range(rng.randrange(1, 5))]
        )
    return pages


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_fill_equals_the_walk(spark, block):
    rng = random.Random(block)
    docs = [random_document(rng) for _ in range(400)]
    docs.append([p for _ in range(60) for p in random_document(rng)])  # one document far longer than the others
    rows, seqs = [], []
    for d, pages in enumerate(docs):
        seq = 0
        for at, page in enumerate(pages):
            seq += rng.choice([1, 1, 1, 2])  # some numbers are absent
            seqs.append((d, at, seq))
            rows.append((d, seq, None if page is None else [(s, p, t, M, "false", "false") for s, p, t in page]))
    df = spark.createDataFrame(rows, f"doc int, page_sequence_number bigint, page_content array<{schemas.ITEM}>")
    out = P.fill_sections(df, ["doc"], block=block).collect()
    got = {
        (r["doc"], r["page_sequence_number"]): (
            None if r["page_content"] is None else [(i["section_name"], i["parent_section_name"]) for i in r["page_content"]],
            r["changed"],
        )
        for r in out
    }
    changes = [by_hand(pages) for pages in docs]
    for d, at, seq in seqs:
        page = docs[d][at]
        assert got[(d, seq)] == (None if page is None else [(s, p) for s, p, _ in page], changes[d][at]), (d, at)


def test_groups_titles_and_joined_texts(spark):
    rows = [(d, s) for d in range(3) for s in range(1, 26) if s != 7]
    df = spark.createDataFrame(rows, "d int, s bigint")
    sizes = P.number_groups(df, ["d"], "s", 10).groupBy("d", "grp").count().collect()
    assert sorted((r["d"], r["grp"], r["count"]) for r in sizes) == [(d, g, n) for d in range(3) for g, n in ((0, 10), (1, 10), (2, 4))]
    named = df.withColumn("v", F.concat(F.lit("p"), F.col("s").cast("string")))
    assert {tuple(r["vs"]) for r in P.first_pages(named, ["d"], "s", "v").collect()} == {("p1", "p2", "p3")}
    texts = named.withColumn("v", F.when(F.col("s") % 2 == 1, F.col("v")))
    joined = {r["t"] for r in P.join_texts(texts, ["d"], "s", "v", "t", block=4).collect()}
    assert joined == {" ".join(f"p{s}" for s in range(1, 26, 2) if s != 7)}


def test_enumerate(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "d int, pages array<string>")
    out = P.enumerate_pages(df, F.col("pages"), F.lit("f.pdf"), "img").collect()
    assert [(r["d"], r["page_sequence_number"], r["image_path"]) for r in out] == [
        (1, 1, "img/f.pdf/f.pdf_page_1.png"), (1, 2, "img/f.pdf/f.pdf_page_2.png"),
    ]


def test_broken_extracts_are_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"page_number": "1",\n "page_content": []}')
    (tmp_path / "b.json").write_text('{"page_number": "2", ')
    (tmp_path / "c.json").write_text('{"page_content": [{"text": "t", "contains_image_diagam": true}]}')
    good, bad = files.read_extracts(spark, str(tmp_path))
    assert good.count() == 2 and [Path(r["extract_path"]).name for r in bad.collect()] == ["b.json"]
    flag = good.select(F.explode("page_content").alias("i")).select(T.is_true(F.col("i.contains_image_diagam")).alias("f"))
    assert flag.collect()[0]["f"] is True


def test_written_documents_replace_what_they_had(spark):
    path = fresh_path(spark, "pages")
    def pages(rows):
        return spark.createDataFrame(rows, "file_name string, page_sequence_number bigint, page_header string")

    files.write_pages(pages([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")]), path, buckets=1)
    files.write_pages(pages([("a", 1, "y")]), path, buckets=1)
    files.write_pages(pages([]), path, buckets=1)
    back = files.read_page_table(spark, path).select("file_name", "page_sequence_number", "page_header").collect()
    assert sorted(map(tuple, back)) == [("a", 1, "y"), ("b", 1, "x")]


def test_chunks_without_pages(spark):
    df = spark.createDataFrame([], f"file_path string, extract_path string, {schemas.PAGE_EXTRACT}")
    path = fresh_path(spark, "chunks")
    files.write_chunks(build_chunks(df, "u", "img"), path)
    assert embed_chunks(build_chunks(df, "u", "img"), embed_text(StubClient)).count() == 0


def test_extract_of_documents(spark):
    rows = [(d, s, f"data:{d}-{s}" + "x" * (d * 7 + s)) for d in range(4) for s in range(1, 2 + d * 6)]
    out = documents.extract(spark.createDataFrame(rows, "doc_id int, page_sequence_number bigint, image_url string"), StubClient)
    got = out.collect()
    assert len(got) == len(rows) and len({(r["doc_id"], r["document_title"]) for r in got}) == 4
    assert {"image_url"}.isdisjoint(out.columns)


@pytest.mark.skipif(not SAMPLES, reason="no sample extracts are named")
def test_sample_extracts(spark):
    """Counts of the sample corpus: per document chunks, sections, parents, pictures."""
    good, bad = files.read_extracts(spark, SAMPLES)
    assert (good.count(), bad.count()) == (238, 0)
    folder = F.url_decode(F.element_at(F.split("extract_path", "/"), -2))
    pages = good.withColumn("file_path", F.regexp_replace(folder, "_extract$", ""))
    chunks = build_chunks(pages, "u", "img")
    got = chunks.groupBy("file_name").agg(
        F.count("*"), F.count_if(F.col("section") != ""), F.count_if(F.col("parent_section") != ""), F.count_if("image_flag")
    ).collect()
    assert {tuple(r)[1:] for r in got} == {(180, 176, 27, 27), (78, 75, 15, 0), (25, 21, 2, 1), (192, 185, 46, 48)}
    assert chunks.select("id").distinct().count() == 475
    assert pages.filter(T.printed_page_number(F.col("page_number")) == 0).count() == 48

    filled = P.fill_sections(pages, ["file_path"])
    pair = lambda df: df.select(
        "file_path", "page_sequence_number", F.posexplode("page_content").alias("j", "i")
    ).select("file_path", "page_sequence_number", "j", "i.section_name", "i.parent_section_name")
    new = pair(filled).exceptAll(pair(pages)).collect()
    assert len(new) == 3 and {r["page_sequence_number"] for r in new} == {5}


def test_incomplete_loads_are_stopped(spark):
    listed = spark.createDataFrame([(1, 1), (1, 2)], "d int, p int")
    P.require_complete(listed, listed, ["d", "p"])
    with pytest.raises(ValueError, match="'p': 2"):
        P.require_complete(listed, listed.filter("p = 1"), ["d", "p"])
