"""Fuzzy line dedup by MinHash, native (operator 9).

Lines that are near copies of each other (Jaccard similarity of their sets of
character shingles) form components; of each component the first line in
(doc_id, line number) order stays. Only DataFrame functions are used:

1. equal lines become one row, first in each task, then by key;
2. signatures: a line's shingles are hashed in generated code, multiplied for
   each permutation (bits 20 to 51 of the product with an odd number), and a
   grouped minimum gives the MinHash values, over all shingles of the line;
3. banding: lines with equal values in a band form a group. All members of a
   group, however many, are candidates with the group's first and last line;
4. verification: candidates whose signatures agree in too few of ``SKETCH``
   values are no pairs (a byte of each value, packed into words, is all that is
   compared); the others' exact Jaccard similarity of the two shingle sets decides.
   First each line is checked against the line it shares most bands with;
   other candidates only where that has not already connected the two;
5. the rest: groups whose members are not all connected by now. In groups of at
   most ``FEW`` lines the sketches of unconnected lines are compared. Lines of
   larger groups meet by their rarest shingles: two lines as similar as asked
   share one among the first fifth of their shingles, the rarest first (prefix
   filter), so no like pair is left out, and shingles of a common template, which
   come last, bring no lines together; their sketches are compared as well. Both
   joins also compare parity maps of the shingle sets, which bound the sets'
   difference: no like pair is dropped, and hardly another one leaves the join;
6. components by distributed union-find; first positions by grouped minima.

A line is known by the 64-bit XXH64 of its text (two different lines among n
share one with a probability of about n * n / 3.7e19).
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Saved, release, saved, small
from .components import components

#: Characters of a shingle and the least similarity of like lines.
SHINGLE = 5
SIMILARITY = 0.8
#: Bands and values in a band: 1 - (1 - 0.8**5)**18 = 0.999 of the pairs at the
#: least similarity share a band.
BANDS = 18
ROWS = 5
#: Words of a sketch, seven values each, and the values that must agree: at the
#: least similarity 22 of 28 do on average, fewer than 12 in one of 100,000 pairs.
SKETCH = 4
AGREE = 12
#: In groups of at most this many lines all unconnected lines' sketches are compared.
#: That is a row for each line and group and some nanoseconds for a pair; the rarest
#: shingles of larger groups are a row for a fifth of each line's characters.
FEW = 16_384
#: Bands whose groups are made at once: their members are on disk together.
PASS = 6
#: Words of a parity map of a line's shingles.
MAP = 8
#: Shingles before one in its line's order in which an earlier meeting is looked for.
EARLIER = 4


def _factors(n: int) -> list[int]:
    """Odd 31-bit factors, one for each permutation (fixed by the seed): the
    product with a 32-bit hash stays below 2**63."""
    r = random.Random(91)
    return [r.getrandbits(30) << 1 | 1 for _ in range(n)]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, text): rows with the same id and text are one document."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _lines(texts: DataFrame) -> DataFrame:
    """(doc_id, th, line_no, line) of the lines with something other than white space."""
    return (texts.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where(F.col("line").rlike(r"[^\x20\x09-\x0D]")))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once for each row, whatever reads them:
    no filter or projection is moved through a generator."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__made")
    return df.select("*", made).select(*df.columns, "__made.*")


def _shingles(line: Column, size: int) -> Column:
    """The set of shingles of a line."""
    return F.array_distinct(F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _signed(lines: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(lid, keys, sketch) of lines (lid, b: their UTF-16 bytes, n: shingles with
    repeats), from all their shingles. The grouped minima need no shuffle: the
    shingles of a line lie together."""
    each = (lines.select("lid", "b", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("p"))
            .select("lid", F.xxhash64(F.substring("b", 2 * F.col("p") - 1, F.lit(2 * shingle))).alias("h")))
    x = F.shiftrightunsigned("h", 32)
    mins = [F.min(F.shiftrightunsigned(x * F.lit(f).cast("long"), 20).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"m{i}")
            for i, f in enumerate(_factors(bands * rows))]
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + r}") for r in range(rows)]) for b in range(bands)]
    made = each.groupBy("lid").agg(*mins)
    # a byte of each value in a field of nine bits
    step = max(1, bands * rows // (7 * SKETCH))
    byte = lambda i: F.col(f"m{i * step % (bands * rows)}").bitwiseAND(F.lit(255))
    words = [reduce(lambda x, y: x.bitwiseOR(y), [byte(7 * w + j) * (1 << 9 * j) for j in range(7)]) for w in range(SKETCH)]
    return made.select("lid", F.array(*keys).alias("keys"), F.array(*words).alias("sketch"))


def _agreeing(x: Column, y: Column) -> Column:
    """In how many values two sketches agree."""
    low, top = (sum(v << 9 * j for j in range(7)) for v in (255, 256))
    differ = [F.bit_count((x[w].bitwiseXOR(y[w]) + low).bitwiseAND(F.lit(top))) for w in range(SKETCH)]
    return 7 * SKETCH - sum(differ[1:], differ[0])


def band_keys(lines: DataFrame, shingle: int, bands: int, rows: int) -> tuple[Saved, Saved]:
    """(lid, keys) and (lid, sketch) of each distinct line of at least ``shingle`` characters."""
    spark = lines.sparkSession
    units = (F.octet_length("b") / 2).cast("int")  # UTF-16 code units
    distinct = lines.select(F.xxhash64("line").alias("lid"), "line").dropDuplicates(["lid"])
    measured = distinct.select("lid", F.encode("line", "UTF-16BE").alias("b")).withColumn("n", units - (shingle - 1)).where("n > 0")
    signed = Saved(_signed(measured, shingle, bands, rows), "line-signatures")
    release(spark)
    sketches = Saved(signed.df.select("lid", "sketch"), "line-sketches")
    keys = Saved(signed.df.select("lid", "keys"), "line-keys")
    release(spark, signed)
    return keys, sketches


def _close(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose lines' sketches agree often enough."""
    def side(c: str) -> DataFrame:
        return sketches.select(F.col("lid").alias(c), F.col("sketch").alias(f"{c}_s"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_agreeing(F.col("a_s"), F.col("b_s")) >= AGREE).select(*pairs.columns)


def _texts_of(lines: DataFrame, lids: DataFrame) -> Saved:
    """(lid, line) of some lines."""
    own = Saved(lids.select("lid").distinct(), "line-ids")
    out = Saved(lines.select(F.xxhash64("line").alias("lid"), "line").join(small(own.df), "lid", "left_semi").dropDuplicates(["lid"]), "line-texts")
    own.drop()
    return out


def _parity(texts: DataFrame, shingle: int) -> DataFrame:
    """(lid, n, bits): the size of a line's set of shingles, and for each bit of a
    map whether an odd number of them have it."""
    each = texts.select("lid", F.explode(_shingles(F.col("line"), shingle)).alias("s")).select("lid", F.xxhash64("s").alias("h"))
    at = each.withColumns({"w": F.shiftright("h", 6).bitwiseAND(F.lit(MAP - 1)), "bit": F.expr("shiftleft(1L, cast(h & 63 as int))")})
    words = [F.bit_xor(F.when(F.col("w") == w, F.col("bit")).otherwise(F.lit(0).cast("long"))) for w in range(MAP)]
    return at.groupBy("lid").agg(F.count(F.lit(1)).alias("n"), F.array(*words).alias("bits"))


def _may_be_like(similarity: float) -> Column:
    """Whether the maps of x and y allow the similarity: each shingle that only one
    of the sets has changes one bit, and like sets differ in at most
    (1 - s) / (1 + s) of the sum of their sizes."""
    differ = [F.bit_count(F.col("x.bits")[w].bitwiseXOR(F.col("y.bits")[w])) for w in range(MAP)]
    return sum(differ[1:], differ[0]) <= (1 - similarity) / (1 + similarity) * (F.col("x.n") + F.col("y.n")) + 1e-9


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("lid"))


def _candidates(table: Saved, bands: int) -> tuple[Saved, list[Saved]]:
    """(a, b, bands): lines with the first or last line of a group; and
    (key, lid, c): the members of the groups of ``c`` > 2 lines, a table for each
    ``PASS`` bands. All saved. A key goes through one shuffle: its line meets the
    group's first and last there, and a line alone in its group stays behind."""
    spark, tables = table.spark, []
    of = Window.partitionBy("key")
    for at in range(0, bands, PASS):
        members = table.df.select("lid", F.explode(F.slice("keys", at + 1, PASS)).alias("key"))
        grouped = members.select("key", "lid", F.count(F.lit(1)).over(of).alias("c"), F.min("lid").over(of).alias("first"),
                                 F.max("lid").over(of).alias("last"))
        tables.append(Saved(grouped.where("c > 2 or (c = 2 and lid = last)"), "line-members"))
        release(spark)
    table.drop()
    own = reduce(DataFrame.union, [t.df for t in tables])
    pairs = (own.where("lid != first").select(F.col("first").alias("a"), F.col("lid").alias("b"))
             .union(own.where("lid != first and lid != last").select(F.col("lid").alias("a"), F.col("last").alias("b"))))
    out = Saved(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("bands")), "line-candidates")
    release(spark)
    return out, tables


def _unconnected(members: list[Saved], links: DataFrame, lines: DataFrame, sketches: Saved, shingle: int,
                 similarity: float) -> Saved:
    """(a, b), a < b: the pairs of lines of a group that no links connect and that
    can be similar enough. Saved; the members and sketches are dropped."""
    spark = sketches.spark
    own = reduce(DataFrame.union, [t.df for t in members]).where("c > 2").select("key", "lid", "c")
    parts = Saved(components(links), "line-parts")
    roots = parts.df.select(F.col("node").alias("lid"), "root")
    rooted = Saved(own.join(roots, "lid", "left").withColumn("root", F.coalesce("root", "lid")), "line-roots")
    release(spark, parts, *members)
    mixed = Saved(rooted.df.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key"), "line-mixed")
    left = Saved(rooted.df.join(small(mixed.df), "key"), "line-left")
    release(spark, rooted, mixed)
    texts = _texts_of(lines, left.df)
    bits = Saved(_parity(texts.df, shingle), "line-bits")
    # sketches and maps come along, so that only pairs that may be alike leave the join
    known = sketches.df.join(bits.df, "lid")
    few = Saved(left.df.where(F.col("c") <= FEW).join(known, "lid").select("key", "lid", "root", "sketch", "n", "bits"), "line-few")
    release(spark)
    x, y = few.df.alias("x"), few.df.alias("y")
    near = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.lid") < F.col("y.lid")) & (F.col("x.root") != F.col("y.root"))
                   & (_agreeing(F.col("x.sketch"), F.col("y.sketch")) >= AGREE) & _may_be_like(similarity))
            .select(F.col("x.lid").alias("a"), F.col("y.lid").alias("b")))
    many = Saved(left.df.where(F.col("c") > FEW).select("lid", "root").distinct(), "line-hot")
    if many.df.isEmpty():
        found = Saved(near.distinct(), "line-found")
    else:
        found = Saved(near.union(_close(_prefix_pairs(many.df, texts.df, bits.df, shingle, similarity).distinct(), sketches.df)).distinct(), "line-found")
    release(spark, left, texts, bits, few, many, sketches)
    return found


def _prefix_pairs(many: DataFrame, texts: DataFrame, bits: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b), a < b: the pairs of lines with different roots that share one of
    their rarest shingles, at places and with maps that allow the similarity."""
    each = saved(texts.join(small(many), "lid").select("lid", "root", F.explode(_shingles(F.col("line"), shingle)).alias("s"))
                 .select("lid", "root", F.xxhash64("s").alias("s")), "line-shingles")
    often = saved(each.groupBy("s").agg(F.count(F.lit(1)).alias("c")), "line-shingle-counts")
    # a window holds the shingles of one line
    of = Window.partitionBy("lid")
    ranked = (each.join(small(often), "s")
              .select("lid", "root", "s", "c", F.count(F.lit(1)).over(of).alias("n"), F.row_number().over(of.orderBy("c", "s")).alias("p"),
                      F.collect_list("s").over(of.orderBy("c", "s").rowsBetween(-EARLIER, -1)).alias("earlier")))
    overlap = similarity / (1 + similarity)
    probe = F.col("n") - F.ceil(similarity * F.col("n") - 1e-9) + 1
    index = F.col("n") - F.ceil(2 * overlap * F.col("n") - 1e-9) + 1
    ranked = saved(ranked.where((F.col("c") > 1) & (F.col("p") <= probe))
                   .select("lid", "root", "s", "n", "p", (F.col("p") <= index).alias("indexed"), "earlier"), "line-prefixes")
    # a shingle's most frequent root is only joined with its others
    per = ranked.groupBy("s", "root").agg(F.count(F.lit(1)).alias("k"))
    most = saved(per.groupBy("s").agg(F.max_by("root", F.struct("k", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
                 .where("roots > 1").select("s", "most"), "line-shingle-roots")
    own = saved(ranked.join(small(most), "s").withColumn("other", F.col("root") != F.col("most")).drop("most")
                .join(bits.select("lid", "bits"), "lid"), "line-prefixes")

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        """Indexed lines of x with lines of y that are as long or longer."""
        x, y = x.where("indexed").alias("x"), y.alias("y")
        most_shared = 1 + F.least(F.col("x.n") - F.col("x.p"), F.col("y.n") - F.col("y.p"))
        fits = ((F.col("x.n") <= F.col("y.n")) & (F.col("x.n") >= similarity * F.col("y.n") - 1e-9)
                & (most_shared >= overlap * (F.col("x.n") + F.col("y.n")) - 1e-9) & _may_be_like(similarity)
                # a pair that shares an earlier one has met there, where the places allow more
                & ~F.arrays_overlap("x.earlier", "y.earlier"))
        return (x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.root") != F.col("y.root")) & fits)
                .select(F.least("x.lid", "y.lid").alias("a"), F.greatest("x.lid", "y.lid").alias("b")))

    return meet(own.where("other"), own).union(meet(own.where("not other"), own.where("other")))


def _like(pairs: DataFrame, table: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of line ids whose lines are at least that similar."""
    def side(c: str) -> DataFrame:
        return table.select(F.col("lid").alias(c), F.col("line").alias(f"{c}_line"))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    sets = _once(both, x=_shingles(F.col("a_line"), shingle), y=_shingles(F.col("b_line"), shingle))
    counts = _once(sets, i=F.size(F.array_intersect("x", "y")), n=F.size("x") + F.size("y"))
    # lines of fewer code points than a shingle have none
    return counts.where((F.col("i") > 0) & (F.col("i") >= similarity * (F.col("n") - F.col("i")))).select("a", "b")


def line_links(lines: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS,
               rows: int = ROWS) -> DataFrame:
    """Links (a, b) between line ids that connect the near copies."""
    keys, sketches = band_keys(lines, shingle, bands, rows)
    pairs, members = _candidates(keys, bands)
    close = saved(_close(pairs.df, sketches.df), "line-close")
    release(lines.sparkSession, pairs)
    texts = _texts_of(lines, _ends(close))
    best = close.groupBy("b").agg(F.max(F.struct("bands", "a")).alias("m")).select("m.a", "b")
    first = saved(_like(best, texts.df, shingle, similarity), "line-links")
    # the other candidates, unless their lines are connected by now
    parts = saved(components(first), "line-parts")
    left = close.join(best, ["a", "b"], "left_anti")
    for c in ("a", "b"):
        root = parts.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        left = left.join(root, c, "left").withColumn(f"{c}_root", F.coalesce(f"{c}_root", c))
    links = first.union(saved(_like(left.where("a_root != b_root"), texts.df, shingle, similarity), "line-links"))
    release(lines.sparkSession, texts)
    found = _unconnected(members, links, lines, sketches, shingle, similarity)
    rest = Saved(found.df.join(close, ["a", "b"], "left_anti"), "line-rest")
    release(lines.sparkSession, found)
    texts = _texts_of(lines, _ends(rest.df))
    out = links.union(saved(_like(rest.df, texts.df, shingle, similarity), "line-links"))
    release(lines.sparkSession, texts, rest)
    return out


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, th, removed): the line numbers to remove of each document that loses lines."""
    texts = _texts(docs, id_col, text_col)
    lines = _lines(texts)
    occ = saved(lines.select("doc_id", "th", "line_no", F.xxhash64("line").alias("lid")), "line-places")
    first = F.min(F.struct("doc_id", "th", "line_no")).alias("f")
    firsts = saved(occ.groupBy("lid").agg(first, F.count(F.lit(1)).alias("c"))
                   .select("lid", "f.doc_id", "f.th", "f.line_no", "c"), "line-firsts")
    links = line_links(lines, **options)
    parts = saved(components(links), "line-parts")
    # the first place of a component of several lines, else of the line itself
    of = parts.join(firsts, F.col("node") == F.col("lid"))
    roots = of.groupBy("root").agg(F.min(F.struct("doc_id", "th", "line_no")).alias("f"))
    keep = (parts.join(roots, "root").select(F.col("node").alias("lid"), "f")
            .union(firsts.join(parts.select(F.col("node").alias("lid")), "lid", "left_anti").where("c > 1")
                   .select("lid", F.struct("doc_id", "th", "line_no").alias("f"))))
    gone = (occ.join(keep, "lid").where(~F.struct("doc_id", "th", "line_no").eqNullSafe(F.col("f"))))
    return gone.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, texts without the lines that repeat an earlier one.

    The order is by doc_id (null first), then line number. Lines without a
    character other than white space are never removed; lines shorter than a
    shingle repeat only equal lines. A null text stays null; rows with the
    same id and text are one document and treated alike; all columns come
    back; an empty table gives an empty result.
    """
    gone = saved(removed_lines(docs, id_col, text_col, **options), "line-removed")
    text = F.col(f"`{text_col}`")
    own = docs.withColumn("__th", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__h"), F.col("removed").alias("__removed"))
    joined = own.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__h")), "left")
    kept = F.array_join(F.filter(F.split(text.cast("string"), "\n"), lambda x, i: ~F.array_contains(F.col("__removed"), i)), "\n")
    new = F.when(F.col("__removed").isNull(), text).otherwise(kept)
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines), a row for each row of ``docs``."""
    gone = removed_lines(docs, id_col, text_col, **options).alias("g")
    own = (_texts(docs, id_col, text_col)
           .select("doc_id", "th", F.size(F.split("text", "\n")).cast("long").alias("n_lines")).alias("o"))
    joined = own.join(gone, F.col("o.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("o.th") == F.col("g.th")), "left")
    removed = F.coalesce("g.removed", F.array().cast("array<int>"))
    return joined.select("o.doc_id", "o.n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed_lines"))
