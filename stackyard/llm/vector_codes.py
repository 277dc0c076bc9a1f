"""Vector code compression: a product quantiser trained with memoised grid cells.

Vectors become integers, are cut into equal parts, and every part position
has a codebook that rounds of assignment and averaging move. A part's nearest
entry is found through a grid: the part's coarse cell is looked up in a memo,
which holds the entries that some point of the cell's box can have nearest (an
entry is left out when its least distance to the box is above the greatest
distance of another). Only those entries are evaluated, exactly, so codes are
those of a full search. All arithmetic is on integers.

What travels: a round sends one row for each (part, entry, position) and task;
the driver holds the codebooks (parts x entries x part width numbers) only.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.operators.joins import attach

from .common import Saved, mix

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components are held within these bounds (an embedding is 12 orders of magnitude below).
LIMIT = 1 << 40
#: Below this a squared distance of a whole vector fits 64 bits; above it Python's integers are used.
FAST = 1 << 25
LONG_MAX = (1 << 63) - 1
#: Cells in the memo of one part; a full memo starts again, which costs time only.
MEMO_CELLS = 200_000
BATCH_ROWS = 4096
#: Rows whose 64-bit sums are added up before they are sent.
FLUSH_ROWS = 1 << 20


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, v): the kept rows with their integer components.

    Rows whose vector is null, or holds null or non-finite components, go.
    Components are floor(scale * x), held within +-2**40. Vectors are filled up
    with zeros to a multiple of ``parts``.
    """
    x = F.col(f"`{vector_col}`")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    # what exceeds the bounds is cut before the product, so that nothing overflows
    cut = float(LIMIT) / scale
    ints = F.transform(x, lambda c: F.floor(F.least(F.greatest(c.cast("double"), F.lit(-cut)), F.lit(cut)) * scale))
    fill = F.array_repeat(F.lit(0).cast("long"), F.pmod(-F.size(x), F.lit(parts)).cast("int"))
    return (vectors.where(x.isNotNull()).where(~bad)
            .select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                    F.concat(ints, fill).alias("v")))


class Codebooks:
    """Entries of every part position: ``books[part]`` is entries x part width, of Python integers."""

    def __init__(self, books: list[list[list[int]]]):
        self.books = books

    def digest(self) -> str:
        text = ",".join(str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()

    def arrays(self, dtype) -> list[np.ndarray]:
        return [np.array(b, dtype=dtype).reshape(len(b), len(b[0]) if b else 0) for b in self.books]

    def largest(self) -> int:
        return max((abs(x) for b in self.books for e in b for x in e), default=0)


def cell_width(book: np.ndarray) -> int:
    """Edge of the grid's cells for one part: a power of two, about a quarter of the
    entries' mean spread along a component. It changes the work, not the codes."""
    spread = [int(max(c) - min(c)) for c in book.T] if len(book) else []
    mean = sum(spread) // len(spread) if spread else 0
    return 1 << max(0, mean.bit_length() - 3)


def cell_hashes(cells: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each cell's coordinates."""
    h = np.zeros(len(cells), np.uint64)
    for column in cells.T:
        h = mix(h ^ column.astype(np.uint64))
    return h


class GridMemo:
    """Nearest entries of one part's codebook through memoised grid cells."""

    def __init__(self, book: np.ndarray):
        self.book = book
        self.width = cell_width(book)
        self.memo: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        """Which entries no other dominates across each cell's box (cells x
        entries). Along a component a box's least and greatest distances depend on
        one coordinate, of which there are few: they are worked out once for each."""
        least = np.zeros((len(cells), len(self.book)), self.book.dtype)
        most = np.zeros_like(least)
        for k in range(cells.shape[1]):
            coordinates, of = np.unique(cells[:, k], return_inverse=True)
            low = (coordinates * self.width)[:, None]
            high, entry = low + (self.width - 1), self.book[None, :, k]
            gap = np.maximum(np.maximum(low - entry, entry - high), 0)
            reach = np.maximum(np.abs(entry - low), np.abs(high - entry))
            least += (gap * gap)[of]
            most += (reach * reach)[of]
        return least <= most.min(axis=1, keepdims=True)  # ties stay

    def _masks(self, part: np.ndarray) -> np.ndarray:
        """Candidates of each row. Cells are looked up by a hash; a cell that
        shares its hash with another one is worked out without the memo."""
        cells = np.floor_divide(part, self.width)
        if cells.dtype == object:
            return self._candidates(cells)
        _, first, of = np.unique(cell_hashes(cells), return_index=True, return_inverse=True)
        keys = [cells[i].tobytes() for i in first]
        if len(self.memo) + len(keys) > MEMO_CELLS:
            self.memo.clear()
        new = [i for i, k in enumerate(keys) if k not in self.memo]
        if new:
            for i, mask in zip(new, self._candidates(cells[first[new]])):
                self.memo[keys[i]] = mask
        masks = np.array([self.memo[k] for k in keys])[of]
        clash = np.flatnonzero((cells != cells[first][of]).any(axis=1))
        if len(clash):
            masks[clash] = self._candidates(cells[clash])
        return masks

    def nearest(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row; ties go to the lower entry."""
        if not part.shape[1]:
            return np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        rows, entries = np.nonzero(self._masks(part))  # rows ascending, entries ascending within a row
        self.evaluated += len(rows)
        off = part[rows] - self.book[entries]
        dist = (off * off).sum(axis=1)
        first = np.searchsorted(rows, np.arange(len(part)))
        best = np.minimum.reduceat(dist, first)
        hit = np.flatnonzero(dist == best[rows])
        chosen = hit[np.searchsorted(rows[hit], np.arange(len(part)))]
        return entries[chosen], dist[chosen]


class Coder:
    """Nearest entries of whole vectors; keeps a memo for each part and kind of integer."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.fast = books.largest() < FAST
        self.memos: dict[type, list[GridMemo]] = {}

    def _memo(self, dtype) -> list[GridMemo]:
        if dtype not in self.memos:
            self.memos[dtype] = [GridMemo(b) for b in self.books.arrays(dtype)]
        return self.memos[dtype]

    def assign(self, v: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Entries and distances by part of the vectors (rows x components)."""
        plain = self.fast and (not v.size or (v.max() < FAST and v.min() > -FAST))
        dtype = np.int64 if plain else object
        v = v.astype(dtype)
        width = v.shape[1] // len(self.books.books)
        cut = [v[:, p * width:(p + 1) * width] for p in range(len(self.books.books))]
        got = [m.nearest(c) for m, c in zip(self._memo(dtype), cut)]
        return [g[0] for g in got], [g[1] for g in got]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(books: list, width: int):
    """Task side of a round: counts and sums of the vectors of each entry."""
    def run(batches):
        coder, parts = Coder(Codebooks(books)), len(books)
        step = width // parts
        entries = [len(b) for b in books]
        count = [np.zeros(n, np.int64) for n in entries]
        total = [np.zeros((n, step), np.int64) for n in entries]
        held = 0

        def rows():
            part, entry, place, n, s = [], [], [], [], []
            for p in range(parts):
                for e in np.flatnonzero(count[p]):
                    for k in range(step):
                        part.append(p), entry.append(int(e)), place.append(k)
                        n.append(int(count[p][e])), s.append(int(total[p][e, k]))
                count[p][:] = 0
                total[p][:] = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(n, pa.int64()), pa.array(s, pa.int64())], ["part", "entry", "place", "n", "s"])

        for batch in batches:
            v = _matrix(batch.column(0), width)
            chosen, _ = coder.assign(v)
            for p in range(parts):
                np.add.at(count[p], chosen[p], 1)
                np.add.at(total[p], chosen[p], v[:, p * step:(p + 1) * step])
            held += len(v)
            if held >= FLUSH_ROWS:
                yield rows()
                held = 0
        yield rows()
    return run


def train_codebooks(kept: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
                    rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from the vectors of the smallest ids, moved by ``rounds`` of averaging.

    Rows of equal ids are taken by their components; rows without an id last.
    Fewer rows than entries give smaller codebooks.
    """
    step = width // parts
    first = [list(map(int, r["v"])) for r in
             kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    books = [[v[p * step:(p + 1) * step] for v in first] for p in range(parts)]
    for _ in range(rounds):
        got = (kept.select("v").mapInArrow(_sums(books, width), "part int, entry int, place int, n long, s long")
               .groupBy("part", "entry", "place")
               .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
        for r in got.collect():  # at most parts x entries x part width rows
            books[r["part"]][r["entry"]][r["place"]] = int(r["s"]) // r["n"]
    return Codebooks(books)


def _codes(books: list, width: int):
    """Task side of the last assignment: codes and errors."""
    def run(batches):
        coder = Coder(Codebooks(books))
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            chosen, dist = coder.assign(v)
            code = np.stack(chosen, axis=1).astype(np.uint8)
            error = np.sum([d.astype(object) for d in dist], axis=0) if len(v) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([c.tobytes().hex() for c in code], pa.string()),
                 pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())],
                ["vec_id", "label", "code", "error"])
    return run


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", scale: int = SCALE, parts: int = PARTS,
                     entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) of every kept vector, and the codebooks.

    ``label_error`` is the error summed over the rows of equal labels, those
    without a label together. Defined results: repeated rows count and are
    returned each; all kept vectors must have the length of the first one by id,
    rows of another length go; an empty table gives no rows and empty codebooks;
    errors beyond a long are its greatest value. Other columns of the input,
    whatever their names, are not read. At most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code byte holds 1 to 256 entries")
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    work = Saved(integer_vectors(vectors, id_col, vector_col, label_col, scale, parts), "vectors")
    head = work.df.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).limit(1).collect()
    width = head[0][0] if head else 0
    kept = work.df.where(F.size("v") == width)
    books = train_codebooks(kept, width, parts, entries, rounds)
    types = dict(kept.dtypes)
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    coded = Saved(kept.mapInArrow(_codes(books.books, width), schema), "codes")
    work.drop()
    return with_label_error(coded.df), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the errors' sum over the rows of each label (null as a label of its own)."""
    rows = coded.withColumn("__none", F.col("label").isNull()) \
                .withColumn("__label", F.coalesce(F.col("label").cast("string"), F.lit("")))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(LONG_MAX))).cast("long")
    sums = Saved(rows.groupBy("__none", "__label").agg(total.alias("label_error"), F.count(F.lit(1)).alias("__rows")),
                 "label-errors").df
    out = attach(rows, sums, ["__none", "__label"], "left", sums.count(), "__rows")
    return out.select(*coded.columns, "label_error")
