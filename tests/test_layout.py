import html
import random

from pyspark.sql import functions as F

from docflow import schemas
from docflow.operators import layout as L
from docflow.operators.tables import table_html


def html_by_hand(row_count, cells):
    out, opened, closed = [], False, False
    for i in range(row_count):
        row = sorted((c for c in cells if c[0] == i), key=lambda c: c[1])
        header = any(c[2] == "columnHeader" for c in row)
        text = ""
        for _, _, kind, wide, tall, content in row:
            tag = "th" if kind in ("columnHeader", "rowHeader") else "td"
            spans = (f" colSpan={wide}" if (wide or 1) > 1 else "") + (f" rowSpan={tall}" if (tall or 1) > 1 else "")
            text += f"<{tag}{spans}>{html.escape(content)}</{tag}>"
        if i == 0 and header:
            out.append("<thead>")
            opened = True
        if not header and opened and not closed:
            out.append("</thead>")
            closed = True
        out.append(f"<tr>{text}</tr>")
    if opened and not closed:
        out.append("</thead>")
    return "<table>" + "".join(out) + "</table>"


def random_table(rng):
    rows = rng.randrange(0, 7)
    heads = rng.randrange(0, rows + 1)
    cells = []
    for r in range(rows):
        for c in range(rng.choice([0, 1, 2, 3])):
            kind = "columnHeader" if r < heads and rng.random() < 0.9 else rng.choice([None, "rowHeader", "content"])
            cells.append((r, c, kind, rng.choice([None, 1, 2]), rng.choice([None, 1, 3]), rng.choice(["a", "<b>", "x & 'y'", ""])))
    rng.shuffle(cells)
    return rows, cells


def test_table_html_equals_a_loop(spark):
    rng = random.Random(5)
    tables = [random_table(rng) for _ in range(200)]
    tables.append((90, [(r, 0, "columnHeader" if r < 40 else None, None, None, str(r)) for r in range(90)]))
    rows = [(t, *c) for t, (_, cells) in enumerate(tables) for c in cells]
    cells = spark.createDataFrame(
        rows, "t int, row_index int, column_index int, kind string, column_span int, row_span int, content string"
    )
    counts = spark.createDataFrame([(t, n) for t, (n, _) in enumerate(tables)], "t int, row_count int")
    got = {r["t"]: r["html"] for r in table_html(cells, ["t"], counts, block=4).collect()}
    assert got == {t: html_by_hand(*table) for t, table in enumerate(tables)}


def random_layout(rng):
    """Content cut into pieces; a piece is a paragraph, a table with paragraphs inside, or a table of two spans."""
    content, tables, paragraphs, page = "", [], [], 1
    for _ in range(rng.randrange(1, 14)):
        start = len(content)
        piece = "".join(rng.choice("abc <é") for _ in range(rng.randrange(2, 12)))
        content += piece + "\n"
        page += rng.random() < 0.2
        region = [(page,)]
        shape = rng.random()
        if shape < 0.25:
            spans = [(start, len(piece))]
            if rng.random() < 0.4:
                more = len(content)
                tail = "".join(rng.choice("xyz") for _ in range(rng.randrange(6, 12)))
                content += tail + "\n"
                spans.append((more, len(tail)))
            n, cells = random_table(rng)
            tables.append((spans, n, cells))
            paragraphs.append(([(start, 2)], rng.choice([None, "title", "sectionHeading"]), region))
            if len(spans) > 1:
                paragraphs.append(([(spans[1][0], 2)], None, [(page + rng.choice([0, 1]),)]))
        else:
            role = rng.choice([None, None, "title", "sectionHeading", "pageHeader", "footnote", "pageNumber"])
            paragraphs.append(([(start, len(piece))], role, region))
    rng.shuffle(tables)
    return content, tables, paragraphs


def map_by_hand(content, tables, paragraphs):
    """Walk the characters of the content and note what starts and ends where."""
    opens, closes = {}, {}
    inside = set()
    for i, (spans, _, _) in enumerate(tables):
        first = min(o for o, _ in spans)
        last = spans[0][0] + spans[0][1] - 1 + sum(n - 1 for _, n in spans[1:])
        inside.update(range(first, last + 1))
        closes[last] = ("table", i)
        opens[last] = first
    for spans, role, _ in paragraphs:
        start, end = spans[0][0], spans[0][0] + spans[0][1] - 1
        kind = {None: "text", "title": "title", "sectionHeading": "heading"}.get(role)
        if start not in inside and kind:
            closes[end] = (kind, None)
            opens[end] = start
    starts = {spans[0][0]: region[0][0] for spans, _, region in paragraphs}
    page, main, title, section, out = 0, "", "", "", []
    for at in range(len(content)):
        page = starts.get(at, page)
        if at not in closes:
            continue
        kind, i = closes[at]
        text = content[opens[at] : at + 1]
        if kind == "title":
            title = text
            main = text if not main else f"{main}; {text}" if page == 1 else main
        elif kind == "heading":
            section = text
        else:
            shown = text if kind == "text" else html_by_hand(tables[i][1], tables[i][2])
            out.append((opens[at], shown, kind, main, title, section, page))
    return out


def test_document_map_equals_the_walk(spark):
    rng = random.Random(11)
    docs = [random_layout(rng) for _ in range(120)]
    df = spark.createDataFrame([(i, c, t, p) for i, (c, t, p) in enumerate(docs)], "doc int, " + schemas.LAYOUT)
    expected = {i: map_by_hand(*d) for i, d in enumerate(docs)}
    for block in (8, 100_000):
        got = {i: [] for i in expected}
        for r in L.layout_map(df, ["doc"], block).collect():
            got[r["doc"]].append((r["offset"], r["text"], r["type"], r["title"], r["subtitle"], r["section"], r["page_number"]))
        assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in expected.items()}


def test_overlaps_are_found(spark):
    p = spark.createDataFrame([(1, 0, 0, 9, None, 1), (1, 1, 5, 12, None, 1), (1, 2, 20, 22, None, 1)],
                              "doc int, idx bigint, start bigint, end bigint, role string, page bigint")
    t = spark.createDataFrame([], "doc int, idx bigint, start bigint, end bigint")
    assert [r["idx"] for r in L.overlaps(p, t, ["doc"]).collect()] == [1]


def test_class_by_cover(spark):
    p = spark.createDataFrame([(1, i, s, s + 1, None, 1) for i, s in enumerate((0, 10, 15, 21))],
                              "doc int, idx bigint, start bigint, end bigint, role string, page bigint")
    t = spark.createDataFrame([(1, 0, 10, 20), (1, 1, 12, 13)], "doc int, idx bigint, start bigint, end bigint")
    got = L.classify(p, t, ["doc"]).filter(F.col("kind") == "paragraph").orderBy("idx").collect()
    assert [r["class"] for r in got] == ["text", "in_table", "in_table", "text"]
