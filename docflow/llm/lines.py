"""Near-duplicate lines by segments: columns and joins only.

Two lines within ``edits`` edits share one of ``edits + 1`` segments of the shorter one, at nearly the same place. Each line
indexes its own segments and probes the index of its own and of slightly smaller lengths; what meets is verified. How many
edits a pair may have follows the length of its shorter line; very short lines have none and meet their equals by id alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.components import stars
from docflow.session import write_once

_LAST = 2**63 - 1
CHARS_PER_EDIT = 12


def allowed(n: Column, edits: int, min_chars: int | None) -> Column:
    """Edits that a line of ``n`` characters and one as long or longer may be apart."""
    if min_chars is not None:
        return F.lit(edits)
    return F.least(F.lit(edits), F.call_function("div", n, F.lit(CHARS_PER_EDIT)).cast("int"))


def occurrences(df: DataFrame, key: str, text: str, min_chars: int | None) -> DataFrame:
    """doc, page (a hash of the text), line_no from 0, line and id of every line with a word, or of ``min_chars`` characters if given."""
    whole = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("page"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"),
    )
    wanted = F.col("line").rlike(r"[^\x20\x09-\x0D]") if min_chars is None else F.length("line") >= min_chars
    return whole.filter(wanted).withColumn("id", F.xxhash64("line"))


def shifts(i: int, shorter: int, edits: int) -> range:
    """Where segment ``i`` of a line ``shorter`` characters shorter may start, relative to its own place.

    At most ``i`` edits lie before the first equal segment, and what is left of ``edits`` behind it; both bound the shift.
    """
    return range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)


def with_keys(lines: DataFrame, edits: int, min_chars: int | None) -> DataFrame:
    """id and keys: hashes under which a line can be met; their lowest bit says whether it is indexed there or only probes.

    The line is spread to four bytes for each character, once, so that a segment is found without a walk along it. Segments
    of a line differ by one character in size, the larger ones come last. Where they lie is plain arithmetic in steps.
    """
    n = F.col("n")
    sized = lines.select("id", "line", F.length("line").alias("n")).filter(allowed(n, edits, min_chars) > 0)
    levels = [edits] if min_chars is not None else range(1, edits + 1)
    small = {(e, d): f"small_{e}_{d}" for e in levels for d in range(e + 1)}
    cut = [F.call_function("div", n - d, F.lit(e + 1)).cast("int").alias(name) for (e, d), name in small.items()]
    sized = sized.select("id", "line", "n", *cut)
    found = []
    for (most, shorter), name in small.items():  # what a line that is ``shorter`` may meet with ``most`` edits
        parts, size = most + 1, F.col(name)
        fewer = parts - (n - shorter - parts * size)  # segments of the smaller size
        places = []
        for i in range(parts):
            start, wide = i * size + F.greatest(F.lit(0), i - fewer), size + F.when(fewer <= i, 1).otherwise(0)
            for shift in shifts(i, shorter, most):
                at = start + shift
                places.append(F.struct(
                    F.lit(i).alias("i"), (n - shorter).alias("n"), (4 * at + 1).alias("at"),
                    F.when((at >= 0) & (at + wide <= n), 4 * wide).otherwise(-1).alias("size"), F.lit(int(not shorter and not shift)).cast("long").alias("own"),
                ))
        found.append(F.when(allowed(n - shorter, edits, min_chars) == most, F.array(*places)))
    placed = sized.select("id", "line", F.flatten(F.array_compact(F.array(*found))).alias("places"))
    meet = lambda chars, p: F.xxhash64(p["i"], p["n"], chars.substr(p["at"], p["size"])).bitwiseAND(F.lit(-2)).bitwiseOR(p["own"])
    found = let(F.encode("line", "UTF-32"), lambda chars: F.transform(F.filter("places", lambda p: p["size"] >= 0), lambda p: meet(chars, p)))
    return placed.select("id", found.alias("keys"))


def common_prefix(a: Column, b: Column, most: Column) -> Column:
    """Length of the common prefix of two strings, ``most`` at most, by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int"))
    halve = lambda s, _: F.when(s["lo"] < s["hi"], half(s, F.ceil((s["lo"] + s["hi"]) / 2).cast("int"))).otherwise(s)
    half = lambda s, m: F.when(
        a.substr(s["lo"] + 1, m - s["lo"]) == b.substr(s["lo"] + 1, m - s["lo"]), F.struct(m.alias("lo"), s["hi"].alias("hi"))
    ).otherwise(F.struct(s["lo"].alias("lo"), (m - 1).alias("hi")))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), most.cast("int").alias("hi")), halve, lambda s: s["lo"])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two arrays of characters if it is ``edits`` or less, else something greater.

    Bit-parallel in a band of ``2 * edits + 1`` diagonals: for column j of the table, bit k stands for row j - edits + k;
    ``vp`` and ``vn`` have where the value grows or falls from the row before, already moved to the next column's band.
    ``score`` follows the lowest diagonal. The first array is padded at its end with what equals nothing, and the
    value wanted is found from the lowest diagonal's by the steps between the two rows.
    """
    band = 2 * edits + 1
    mask = (1 << band) - 1
    m, n = F.size(a), F.size(b)
    long = lambda x: F.lit(x).cast("long")
    equal = lambda j, c: sum((F.when(F.get(a, j - 1 - edits + k) == c, long(1 << k)).otherwise(long(0)) for k in range(band)), long(0))

    def column(s: Column, j: Column) -> Column:
        def rest(d0: Column) -> Column:
            hp = (s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"])))).bitwiseAND(long(mask))
            hn = s["vp"].bitwiseAND(d0)
            down = F.shiftright(d0, 1)
            return F.struct(
                hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(long(mask)).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (s["score"] + F.when(d0.bitwiseAND(long(1 << (band - 1))) == 0, 1).otherwise(0)).alias("score"),
            )

        def diagonal(x: Column) -> Column:
            carried = (x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
            return let(carried.bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(long(mask)), rest)

        far = s["score"] > 2 * edits + n - m
        return F.when(far, s).otherwise(let(equal(j, F.get(b, j - 1)), diagonal))

    # in the first column's band, rows from 1 on grow by one each; above row 1 nothing is known to grow
    start = F.struct(long(mask & ~((1 << edits) - 1)).alias("vp"), long(0).alias("vn"), F.lit(edits).alias("score"))
    # after the last column the band has moved on by one: bit k stands for row n + 1 - edits + k
    below = long(mask).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", long(1), F.greatest(F.lit(0), m - n + edits)) - 1))
    known = below.bitwiseAND(long((1 << (band - 1)) - 1))
    end = lambda s: s["score"] - (F.bit_count(s["vp"].bitwiseAND(known)) - F.bit_count(s["vn"].bitwiseAND(known)))
    folded = F.aggregate(F.sequence(F.lit(1), n), start, column, end)
    return F.when(F.abs(n - m) > edits, edits + 1).when(n == 0, m).otherwise(folded)


def within(a: Column, b: Column, edits: int, most: Column) -> Column:
    """Whether two strings are within ``most`` edits, ``edits`` at most; what they share at both ends is taken off first."""
    shorter = F.least(F.length(a), F.length(b))

    def after_prefix(p: Column) -> Column:
        x, y = a.substr(p + 1, F.length(a)), b.substr(p + 1, F.length(b))
        tail = common_prefix(F.reverse(x), F.reverse(y), shorter - p)
        cut = lambda s, q: F.split(s.substr(F.lit(1), F.length(s) - q), "")
        chars = lambda s, q: F.when(F.length(s) == q, F.array().cast("array<string>")).otherwise(cut(s, q))
        return let(tail, lambda q: let(F.struct(chars(x, q).alias("x"), chars(y, q).alias("y")), lambda s: banded_distance(s["x"], s["y"], edits) <= most))

    return let(common_prefix(a, b, shorter), after_prefix)


BITS = 1 << 24


def maybe_among(lines: DataFrame, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The lines whose id may be one of ``wanted``: all that are, and some others.

    Ids are marked in a field of ``bits`` bits (2 MB), whatever their number, which is sent to all tasks, so that most texts stay
    where they are. When very many are wanted the field fills up and holds back less.
    """
    place = lambda c: F.pmod(c, F.lit(bits)) + 1
    marked = wanted.select(F.bitmap_bucket_number(place(F.col("id"))).alias("bucket"), F.bitmap_bit_position(place(F.col("id"))).alias("bit"))
    field = F.broadcast(marked.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("field")))
    bit = F.bitmap_bit_position(place(F.col("id")))
    byte = F.conv(F.hex(F.col("field").substr((bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = lines.withColumn("bucket", F.bitmap_bucket_number(place(F.col("id")))).join(field, "bucket")
    return there.filter(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).select(*lines.columns)


def letters(line: Column, counted: str = "etaonirshdlumcbg ,.") -> Column:
    """How often each of some letters is in the line."""
    return F.array(*[F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in counted])


def links(lines: DataFrame, edits: int, min_chars: int | None) -> DataFrame:
    """Pairs a < b of ids of different lines within the edits that their length allows, each once.

    Equal lines are brought together before anything is exploded, by their keys alone: texts are not shuffled for it.
    Only lines that have met another are then fetched. Of those that meet, pairs are made where the numbers of some letters
    allow it: an edit changes them by two in all at most.
    """
    distinct = with_keys(lines, edits, min_chars).groupBy("id").agg(F.first("keys").alias("keys"))
    met = distinct.select("id", F.explode("keys").alias("k")).select(
        "id", F.col("k").bitwiseAND(F.lit(-2)).alias("meet"), (F.col("k").bitwiseAND(F.lit(1)) == 1).alias("indexed")
    )
    here = Window.partitionBy("meet")
    met = met.withColumns({"lo": F.min("id").over(here), "hi": F.max("id").over(here), "any": F.max("indexed").over(here)})
    met = write_once(met.filter("lo <> hi and any").select("meet", "id", "indexed"), "met")
    wanted = met.select("id").distinct()
    sides = maybe_among(lines.select("id", "line"), wanted).join(wanted, "id").groupBy("id").agg(F.first("line").alias("line"))
    sides = sides.withColumns({"letters": letters(F.col("line")), "most": allowed(F.length("line"), edits, min_chars)})
    sides = write_once(sides, "sides")
    met = met.join(sides.select("id", "letters", "most"), "id")
    own = met.filter("indexed").select("meet", F.col("id").alias("own"), F.col("letters").alias("own_letters"), F.col("most").alias("own_most"))
    apart = F.aggregate(F.zip_with("own_letters", "letters", lambda x, y: F.abs(x - y)), F.lit(0), lambda n, x: n + x)
    pairs = own.join(met.select("meet", "id", "letters"), "meet").filter((F.col("own") != F.col("id")) & (apart <= 2 * F.col("own_most")))
    pairs = write_once(pairs.select(F.least("own", "id").alias("a"), F.greatest("own", "id").alias("b")).distinct(), "pairs")
    left = pairs.join(sides.select(F.col("id").alias("a"), F.col("line").alias("x")), "a")
    both = left.join(sides.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    most = allowed(F.least(F.length("x"), F.length("y")), edits, min_chars)
    return both.filter(within(F.col("x"), F.col("y"), edits, most)).select("a", "b")


def line_classes(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, min_chars: int | None = None) -> DataFrame:
    """One row per line with a word: doc_id (the key), line_no from 0, n_links, class_doc, class_line, removed.

    Lines are parted by a line feed. Lines link if so many insertions, deletions and substitutions turn one into the other:
    one for every ``CHARS_PER_EDIT`` characters of the shorter line, ``edits`` at most. Equal lines are one at any length.
    n_links counts the different lines that a line links to, its copies not among them. class_doc and class_line are the
    first place (by key, then line) of what links reach; every line of a class but that one is removed.

    With ``min_chars`` only lines of so many characters have a row, with a word or not, and all may be ``edits`` apart.
    Lines without words, null and empty texts have no row. A null key comes after all others and stays null. Rows with equal key
    and text are one document, whose lines are reported for each. Keys must be integers. Other columns are left out.
    """
    placed = classed(df, key, text, edits, min_chars)
    back = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return placed.select(back("doc").alias("doc_id"), F.col("line_no").cast("long").alias("line_no"), "n_links", back("class_doc").alias("class_doc"),
                         F.col("class_line").cast("long").alias("class_line"), "removed")


def classed(df: DataFrame, key: str, text: str, edits: int, min_chars: int | None) -> DataFrame:
    lines = occurrences(df, key, text, min_chars)
    found = write_once(links(lines, edits, min_chars), "links")
    degree = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    root = stars(found)
    first = lines.groupBy("id").agg(F.min(F.struct("doc", "line_no")).alias("first"), F.count("*").alias("n"))
    known = first.join(degree, "id", "left").join(root, first["id"] == root["node"], "left")
    known = write_once(known.filter("n > 1 or n_links is not null").select("id", "first", "n_links", F.coalesce("root", "id").alias("root")), "known")
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    known = known.join(least, "root").select("id", "n_links", "least")
    placed = lines.select("doc", "page", "line_no", "id").join(known, "id", "left")
    here = F.coalesce("least", F.struct("doc", "line_no"))
    return placed.select(
        "doc", "page", "line_no", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), here["doc"].alias("class_doc"),
        here["line_no"].alias("class_line"), (here != F.struct("doc", "line_no")).alias("removed"),
    )


def drop_lines(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, min_chars: int | None = None) -> DataFrame:
    """The rows of ``df`` without the lines that are removed; rows that lose all their words go. Same columns as ``df``."""
    gone = classed(df, key, text, edits, min_chars).filter("removed")
    gone = gone.groupBy("doc", "page").agg(F.collect_set("line_no").alias("__gone"))  # lines of one document
    gone = gone.select(F.col("doc").alias("__doc"), F.col("page").alias("__page"), "__gone")
    mine = (F.coalesce(F.col(key).cast("long"), F.lit(_LAST)) == F.col("__doc")) & (F.xxhash64(text) == F.col("__page"))
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains("__gone", i))
    joined = df.join(gone, mine, "left").withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return joined.filter(F.col("__gone").isNull() | F.col(text).rlike(r"[^\x20\x09-\x0D]")).select(*[F.col(f"`{c}`") for c in df.columns])
