"""Conversation structure repair by iterative-deepening A*.

A conversation's rows are edited so that their roles' initials read
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3), Delete (4), Insert an
empty user or assistant row (3). Blank and duplicate rows must be deleted;
a truncated row that stays adds 3. Among the cheapest edits the ASCII-least
sequence of initials (the audit) wins.

Each conversation is searched depth first in ASCII order of the edits under a
bound on the cost, which is raised to the least cost that exceeded it. So the
first accepting path has the least cost and is ASCII-least among its equals. A
table keeps, for every failed state (rows read, place in the pattern), the least
cost still needed from there.

Work is spread by conversation: rows are sorted within partitions by
conversation and turn and read as a stream. The search sees a byte for each
row, never texts; the repair reads texts as a stream behind their audit. So a
task holds a batch of texts and some hundred bytes for each row of one
conversation while it is searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Row symbols are 4 * initial + fault.
INITIALS = "sua"  # any other initial: index 3
FINE, BLANK, DUPLICATE, CUT = range(4)
GONE = 16  # a row that is no longer there; it tells that its conversation exists
#: Places in the pattern: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What may come next for each place: by a kept initial, and by a new user or assistant row.
KEPT = [{0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER}]
NEW = [USER, USER, ASSISTANT, USER]
ROLE = {USER: "user", ASSISTANT: "assistant"}
PLANS_KEPT = 50_000  # audits of short conversations kept by a task, for those of the same symbols
PLAN_ROWS = 64
OUT_BYTES = 4 << 20


# ------------------------------------------------------------ search

def estimates(symbols: bytes) -> list[list[int]]:
    """For each number of rows read, the least cost from each place in the
    pattern when one rule is dropped: behind a leading ``s`` nothing need follow.
    Never above the true cost."""
    after = [0, 0, INSERT, 0]
    out = [after]
    for symbol in reversed(symbols):
        initial, fault = divmod(symbol, 4)
        here = [DELETE + x for x in after]
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT else 0
            for q in range(4):
                new = REROLE + extra + after[NEW[q]]
                kept = KEPT[q].get(initial)
                if kept is not None:
                    new = min(new, KEEP + extra + after[kept])
                here[q] = min(here[q], new)
        bare = here[:]
        for q in range(4):  # one inserted row, or a pair of them
            here[q] = min(here[q], INSERT + bare[NEW[q]], 2 * INSERT + bare[NEW[NEW[q]]])
        out.append(here)
        after = here
    out.reverse()
    return out


def moves(symbols: bytes, i: int, q: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows read, place) in ASCII order of the edits."""
    out = [("I", INSERT, i, NEW[q])]
    if i < len(symbols):
        out.insert(0, ("D", DELETE, i + 1, q))
        initial, fault = divmod(symbols[i], 4)
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT else 0
            kept = KEPT[q].get(initial)
            if kept is not None:
                out.append(("K", KEEP + extra, i + 1, kept))
            out.append(("R", REROLE + extra, i + 1, NEW[q]))
    return out


def search(symbols: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits; ties: the ASCII-least audit."""
    n, h = len(symbols), estimates(symbols)
    needed: dict[tuple[int, int], int] = {}  # failed states: the least cost they still need
    bound = h[0][START]
    while True:
        over = None  # least cost beyond the bound
        # frames: rows read, place, cost so far, moves left, least cost needed as found so far
        path: list[str] = []
        stack = [[0, START, 0, iter(moves(symbols, 0, START)), None]]
        if n == 0:
            return 0, ""
        while stack:
            i, q, g, left, least = stack[-1]
            move = next(left, None)
            if move is None:
                needed[i, q] = least
                stack.pop()
                if stack:
                    step = g - stack[-1][2]
                    stack[-1][4] = least + step if stack[-1][4] is None else min(stack[-1][4], least + step)
                    path.pop()
                continue
            edit, cost, j, r = move
            if j == n and r in (START, ASSISTANT) and g + cost <= bound:
                return g + cost, "".join([*path, edit])
            need = max(h[j][r], needed.get((j, r), 0))
            if g + cost + need > bound:
                over = g + cost + need if over is None else min(over, g + cost + need)
                stack[-1][4] = cost + need if least is None else min(least, cost + need)
                continue
            stack.append([j, r, g + cost, iter(moves(symbols, j, r)), None])
            path.append(edit)
        bound = over


# ------------------------------------------------------------ rows and their faults

def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Test damage by crc32(``conv:turn``) % 20: 0 drops a row, 1 empties its
    text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user. Nulls of
    every column are one space, but conv_id and turn stay null in the result.

    Returns (conv_id, turn, role, text, copy, there): dropped rows stay as rows
    that are not there, so that every conversation is known.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    blank = F.lit(" ")
    said = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    kind = F.crc32(said.cast("binary")) % 20
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), blank)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(F.col(f"`{role_col}`").cast("string"), blank))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(conv.alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"),
                                text.alias("text"), F.explode(copies).alias("copy"), (kind != 0).alias("there"))


def as_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of a conversation table as they are, in the form of :func:`damaged`."""
    blank = F.lit(" ")
    return conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), blank).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), blank).alias("text"),
        F.lit(0).alias("copy"), F.lit(True).alias("there"))


#: Order of a conversation's rows: by turn (nulls first), those of one turn by role and text digest.
ORDER = ["turn", "role", "digest", "copy"]


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def row_symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copy, symbol): each row's initial and first
    fault. Duplicates are found by the digest of role and text, no text is moved."""
    text = F.col("text")
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    cut = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    d = with_digest(rows).withColumn("blank", blank).withColumn("cut", cut).drop("text")
    again = F.row_number().over(Window.partitionBy("conv_id", "there", "digest").orderBy("turn", "copy")) > 1
    fault = (F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    symbol = F.when(F.col("there"), initial * 4 + fault).otherwise(GONE)
    return d.select("conv_id", *ORDER, symbol.cast("int").alias("symbol"))


# ------------------------------------------------------------ plans

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What a stream of one conversation's rows adds up to."""

    def __init__(self):
        self.symbols = bytearray()
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, turn: int | None, symbol: int) -> None:
        if symbol == GONE:
            return
        self.symbols.append(symbol)
        if turn is not None and turn != self.last:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn

    def report(self, plans: dict) -> tuple:
        symbols = bytes(self.symbols)
        got = plans.get(symbols)
        if got is None:
            got = search(symbols)
            if len(plans) < PLANS_KEPT and len(symbols) <= PLAN_ROWS:
                plans[symbols] = got
        faults = [s % 4 for s in symbols]
        initials = [s // 4 for s in symbols]
        legal = {(0, 1), (1, 2), (2, 1)}
        illegal = sum(pair not in legal for pair in zip(initials, initials[1:]))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, *got)


def _plan(schema: pa.Schema):
    def run(batches):
        plans: dict[bytes, tuple] = {}
        key, now, out = None, None, []

        def flush():
            done = pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
            out.clear()
            return done

        for batch in batches:
            for conv, turn, symbol in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if now is None or conv != key:
                    if now is not None:
                        out.append((key, *now.report(plans)))
                    key, now = conv, _Conversation()
                now.add(turn, symbol)
            if len(out) >= 5000:
                yield flush()
        if now is not None:
            out.append((key, *now.report(plans)))
        yield flush()
    return run


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def plan_repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every
    conversation of :func:`damaged` or :func:`as_rows`.

    Defined results: rows without a conv_id are one conversation; a row without a
    turn comes first and has no part in the gaps; repeated rows are duplicates; a
    conversation without rows that are there has zeros and an empty audit; an
    empty table has no conversations.
    """
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, {REPORT}"
    return (row_symbols(rows).repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
            .select("conv_id", "turn", "symbol").mapInArrow(_plan(_arrow(rows, schema)), schema))


# ------------------------------------------------------------ repairs

def _behind_plans(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows, sorted within partitions."""
    names = [c for c in plans.columns if c != "conv_id"]
    types = dict(plans.dtypes)
    body = with_digest(rows.where("there")).select(
        "conv_id", F.lit(1).alias("kind"), *ORDER, "text", *[F.lit(None).cast(types[c]).alias(c) for c in names])
    types = dict(body.dtypes)
    heads = plans.select("conv_id", F.lit(0).alias("kind"),
                         *[F.lit(None).cast(types[c]).alias(c) for c in [*ORDER, "text"]], *names)
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    return both.select("conv_id", "kind", "role", "text", *names)


def _walk(batches) -> Iterator[tuple]:
    """(head, edit, role, text) for each edit that leaves a row, and (head, None,
    None, None) where a conversation begins. The head is its plan as a dict."""
    head, at, q = None, 0, START

    def inserted():
        nonlocal at, q
        while at < len(head["audit"]) and head["audit"][at] == "I":
            at, q = at + 1, NEW[q]
            yield head, "I", ROLE[q], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                head, at, q = row, 0, START
                yield head, None, None, None
                yield from inserted()
                continue
            edit = head["audit"][at]
            at += 1
            if edit == "K":
                q = KEPT[q][(INITIALS.find(row["role"][:1]) if row["role"] else 3) % 4]
                yield head, "K", row["role"], row["text"]
            elif edit == "R":
                q = NEW[q]
                yield head, "R", ROLE[q], row["text"]
            yield from inserted()


def _repaired(schema: pa.Schema):
    def run(batches):
        out, held, place = [], 0, 0
        for head, edit, role, text in _walk(batches):
            if edit is None:
                place = 0
                continue
            out.append({"conv_id": head["conv_id"], "place": place, "edit": edit, "role": role, "text": text})
            place, held = place + 1, held + len(text)
            if held >= OUT_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): what the plans make of the rows."""
    small_batches(rows.sparkSession)
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, place long, edit string, role string, text string"
    return _behind_plans(rows, plans).mapInArrow(_repaired(_arrow(rows, schema)), schema)


def _digests(schema: pa.Schema):
    def run(batches):
        head, sha, first, out = None, None, True, []

        def close():
            out.append({**{n: head[n] for n in schema.names[:-1]}, "repaired_sha256": sha.hexdigest()})

        for now, edit, role, text in _walk(batches):
            if edit is None:
                if head is not None:
                    close()
                head, sha, first = now, hashlib.sha256(), True
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
                continue
            sha.update((("" if first else "\n") + role + ":" + text).encode())
            first = False
        if head is not None:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def repair_report(rows: DataFrame) -> DataFrame:
    """The plans with ``repaired_sha256``, the hash of the repaired
    conversation's ``role:text`` joined by line breaks."""
    small_batches(rows.sparkSession)
    plans = plan_repairs(rows)
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, {REPORT}, repaired_sha256 string"
    return _behind_plans(rows, plans).mapInArrow(_digests(_arrow(rows, schema)), schema)
