"""Conversation structure repair by weighted CYK interval parsing.

A conversation is well formed if the initials of its roles are ``(s?(ua)+)?``. A repair
edits rows one by one: Keep, Rerole, Delete, Insert. The grammar of repairs is in
Chomsky normal form, with a nonterminal ``A[p, q]`` for each pair of states of that
language, "these rows, edited, lead from p to q":

    A[p, q] -> A[p, r] A[r, q]           for every state r
    A[p, q] -> edited row                 a kept, reroled or deleted row, with its cost

and closed under insertion: before and after every row any number of rows may be
inserted, so a row's cell holds the cheapest way from p to q with insertions on both
sides. A cell keeps, for each nonterminal, the least (cost, audit), where the audit is the
edits' initials in order.

Cells are combined bottom-up by span length. Whatever derives a span as ``A[p, q]`` passes
through some state at every place between two rows, so the least over all places of a cut
equals the least at any one of them: spans are cut in the middle, and lengths double (1, 2,
4, ...). That leaves about as many cells as rows. Least audits survive combination: of two audits of one
cell and one cost none is a prefix of the other (what follows the shared part would
be insertions, which cost), so a smaller part stays smaller whatever stands around it.

No conversation has to fit into a task. Rows are range-partitioned by conversation and
turn; a task makes one cell for each conversation in its range, and only a range's first
and last conversation can have cells in other ranges. Those cells (at most two a range) are
combined by conversation. Texts move only where they are joined to their edits. What does
grow with a conversation is what the result holds in one value, its audit, and the digest of
its rows, which a task computes row by row in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from histflow.llm.common import ship, stage

SPACE = "\t\n\x0b\x0c\r "

#: States: nothing yet, behind a system row, behind a user row, behind an assistant row.
STATES = 4
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
#: Rows that an edit can make.
MADE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


class Costs(NamedTuple):
    """What edits cost. Insertions cost something: there is no end to them else."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    #: Added where a truncated row stays.
    truncated: int = 5


# ---- cells -------------------------------------------------------------------
# A cell is a list of STATES * STATES entries, (cost, audit) or None.
Cell = list


def combined(x: Cell, y: Cell) -> Cell:
    """The cell of a span from the cells of its two parts."""
    out = []
    for p in range(STATES):
        for q in range(STATES):
            best = None
            for r in range(STATES):
                a, b = x[p * STATES + r], y[r * STATES + q]
                if a is not None and b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost < best[0]:
                        best = (cost, a[1] + b[1])
                    elif cost == best[0]:
                        best = min(best, (cost, a[1] + b[1]))
            out.append(best)
    return out


def insertions(costs: Costs) -> Cell:
    """The insertion closure: the least insertions from each state to each."""
    if costs.insert <= 0:
        raise ValueError("an insertion has to cost something")
    one: Cell = [(0, "") if p == q else None for p in range(STATES) for q in range(STATES)]
    for (p, letter), q in STEPS.items():
        if letter in MADE:
            one[p * STATES + q] = min(x for x in (one[p * STATES + q], (costs.insert, "I")) if x is not None)
    closed = one
    for _ in range(STATES):
        closed = combined(closed, one)
    return closed


class Row(NamedTuple):
    initial: str
    #: A blank or repeated row must go.
    doomed: bool
    truncated: bool


def row_cell(row: Row, costs: Costs, closure: Cell) -> Cell:
    """The cell of one row, with insertions on both sides."""
    cell: Cell = [None] * (STATES * STATES)

    def add(p: int, q: int, cost: int, edit: str) -> None:
        old = cell[p * STATES + q]
        cell[p * STATES + q] = (cost, edit) if old is None else min(old, (cost, edit))

    for p in range(STATES):
        add(p, p, costs.delete, "D")
    if not row.doomed:
        extra = costs.truncated if row.truncated else 0
        for (p, letter), q in STEPS.items():
            if letter == row.initial:
                add(p, q, costs.keep + extra, "K")
            if letter in MADE:
                add(p, q, costs.rerole + extra, "R")
    return combined(combined(closure, cell), closure)


class Span:
    """A growing row of cells: those of spans 1, 2, 4, ... rows long, the longest first."""

    def __init__(self, costs: Costs, closure: Cell, known: dict[Row, Cell]) -> None:
        self.costs, self.closure, self.known = costs, closure, known
        self.cells: list[tuple[int, Cell]] = []

    def add(self, row: Row, times: int = 1) -> None:
        cell = self.known.get(row)
        if cell is None:
            cell = self.known[row] = row_cell(row, self.costs, self.closure)
        while times:  # equal rows: a span of as many rows as a power of two at a time
            size, power = 1, cell
            while 2 * size <= times:
                size, power = 2 * size, combined(power, power)
            self._push(size, power)
            times -= size

    def _push(self, size: int, cell: Cell) -> None:
        self.cells.append((size, cell))
        while len(self.cells) > 1 and self.cells[-2][0] <= self.cells[-1][0]:
            (n, x), (m, y) = self.cells[-2:]
            self.cells[-2:] = [(n + m, combined(x, y))]

    def whole(self) -> Cell:
        cell = self.closure
        for _, x in reversed(self.cells):
            cell = combined(x, cell)
        return cell


# ---- rows --------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after the damage, NULL roles and texts as one space."""
    conv_id, turn = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("role", "text"))
    harm = F.pmod(F.crc32(F.concat(conv_id, F.lit(":"), turn)), F.lit(20))
    return conversations.where(harm != 0).select(
        "conv_id",
        conversations["turn"].cast("long").alias("turn"),
        F.when(harm == 4, "user").otherwise(role).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(harm == 3, 2).otherwise(1).alias("copies"),
    )


def _same(conv_id: Column) -> Column:
    """A digest that rows of one conversation, role and text share, and no others."""
    key = F.coalesce(conv_id.cast("string"), F.lit(""))
    return F.sha2(F.concat_ws(":", conv_id.isNull(), F.length(key), F.length("role"), key, "role", "text"), 256)


def _row_id(same: Column, turn: Column) -> Column:
    return F.sha2(F.concat_ws(":", same, F.coalesce(turn.cast("string"), F.lit(" "))), 256)


def identified(rows: DataFrame) -> DataFrame:
    """``rows`` with ``same`` and ``row``: digests equal for equal rows, the second with the turn."""
    return rows.withColumn("same", _same(F.col("conv_id"))).withColumn("row", _row_id(F.col("same"), F.col("turn")))


def marked(rows: DataFrame) -> DataFrame:
    """row, conv_id, turn, role, copies, blank, truncated, earlier: one row for equal rows, without the text.

    ``earlier``: its role and text stand in an earlier turn. The first turn of every
    role and text is found by aggregation and joined to the one row that it is, so that
    a text which fills a conversation is no hot key.
    """
    stripped = F.rtrim(F.col("text"), F.lit(SPACE))
    facts = identified(rows).select(
        "row",
        "same",
        "conv_id",
        "turn",
        "role",
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("truncated"),
        "copies",
    )
    keys = ["row", "same", "conv_id", "turn", "role", "blank", "truncated"]
    alike = stage(facts.groupBy(*keys).agg(F.sum("copies").alias("copies")), "repair-rows")
    seen = alike.groupBy("same").agg(F.max(F.col("turn").isNull()).alias("nameless"), F.min("turn").alias("turn"))
    first = seen.select(_row_id(F.col("same"), F.when(~F.col("nameless"), F.col("turn"))).alias("row"), F.lit(True).alias("first"))
    return alike.join(first, "row", "left").select(
        "row", "conv_id", "turn", "role", "copies", "blank", "truncated", F.col("first").isNull().alias("earlier")
    )


# ---- cells of ranges -----------------------------------------------------------
SUMMARY = (
    "struct<inner boolean, first_initial string, last_initial string, first_turn bigint, last_turn bigint, turns bigint,"
    " blank bigint, duplicate bigint, truncated bigint, illegal bigint, costs array<bigint>, audits array<string>>"
)


class _Piece:
    """The rows of one conversation in one range, so far."""

    def __init__(self, conv_id, costs: Costs, closure: Cell, known: dict[Row, Cell]) -> None:
        self.conv_id, self.span = conv_id, Span(costs, closure, known)
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None
        self.rows = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, copies: int, blank: bool, truncated: bool, earlier: bool) -> int:
        """Take the next row and its copies; the number of rows before them."""
        place, initial = self.rows, role[:1]
        if not self.rows:
            self.first_initial = initial
        elif self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if blank:
            self.blank += copies
            self.span.add(Row(initial, True, False), copies)
        else:
            again = copies if earlier else copies - 1
            self.duplicate += again
            if not earlier:
                self.truncated += truncated
                self.span.add(Row(initial, False, truncated))
            if again:
                self.span.add(Row(initial, True, False), again)
        self.last_initial = initial
        self.rows += copies
        return place

    def summary(self, inner: bool) -> dict:
        cell = self.span.whole()
        names = "first_initial last_initial first_turn last_turn turns blank duplicate truncated illegal".split()
        return {n: getattr(self, n) for n in names} | {
            "inner": inner,
            "costs": [None if x is None else x[0] for x in cell],
            "audits": [None if x is None else x[1] for x in cell],
        }


def _cells_of(costs: Costs, schema: pa.Schema):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closure, known = insertions(costs), {}
        number = TaskContext.get().partitionId()
        piece, begun = None, 0
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "row", "turn", "role", "copies", "blank", "truncated", "earlier")]
            for conv_id, row, *facts in zip(*columns):
                if piece is None or conv_id != piece.conv_id:
                    if piece is not None:
                        out.append({"conv_id": piece.conv_id, "piece": number, "summary": piece.summary(begun > 1)})
                    piece = _Piece(conv_id, costs, closure, known)
                    begun += 1
                out.append({"conv_id": conv_id, "piece": number, "row": row, "place": piece.add(*facts)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if piece is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": piece.conv_id, "piece": number, "summary": piece.summary(False)}], schema)

    return cells


def _settled(pieces: list[dict]) -> list[dict]:
    """The pieces of one conversation, in order, with their part of the repair; the first has the totals."""
    pieces = sorted(pieces, key=lambda x: x["piece"])
    parts = [x["summary"] for x in pieces]
    # The least way to each state, with the states between the pieces.
    ways: list = [(0, "", (0,)) if p == 0 else None for p in range(STATES)]
    for x in parts:
        cell = [None if c is None else (c, a) for c, a in zip(x["costs"], x["audits"])]
        further: list = []
        for q in range(STATES):
            found = [(w[0] + c[0], w[1] + c[1], (*w[2], q)) for p, w in enumerate(ways) if w is not None and (c := cell[p * STATES + q]) is not None]
            further.append(min(found) if found else None)
        ways = further
    cost, audit, path = min(ways[q] for q in ACCEPTED if ways[q] is not None)
    totals = {n: sum(x[n] for x in parts) for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
    for x, y in zip(parts, parts[1:]):
        totals["illegal"] += x["last_initial"] + y["first_initial"] not in LEGAL
    told = [x for x in parts if x["first_turn"] is not None]
    for x, y in zip(told, told[1:]):
        totals["turns"] -= x["last_turn"] == y["first_turn"]
    totals["gaps"] = told[-1]["last_turn"] - told[0]["first_turn"] + 1 - totals["turns"] if told else 0
    totals |= {"cost": cost, "audit": audit}
    return [
        {
            "conv_id": x["conv_id"],
            "piece": x["piece"],
            "start": p,
            "end": q,
            "audit": x["summary"]["audits"][p * STATES + q],
            "totals": totals if n == 0 else None,
        }
        for n, (x, p, q) in enumerate(zip(pieces, path, path[1:]))
    ]


def _settle_of(schema: pa.Schema):
    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([y for x in batch.to_pylist() for y in _settled([x])], schema)

    def together(pieces: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_settled(pieces.to_pylist()), schema)

    return alone, together


EDITS_AT_ONCE = 10_000


def _edits_of(schema: pa.Schema):
    """Each piece's audit as rows: ``at`` in the audit, ``place`` of the edited row (NULL: inserted), ``made``: the new role."""

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for batch in batches:
            for x in batch.to_pylist():
                state, place = x["start"], 0
                # A state has one letter that leads on, but for the first: there the number of rows and the
                # last state tell whether the first row is a system row.
                n = len(x["audit"]) - x["audit"].count("D")
                system = state == 0 and n > 0 and x["end"] != (2 if n % 2 else 3)
                for at, edit in enumerate(x["audit"]):
                    if edit != "D":
                        letter = "s" if system and state == 0 else "a" if state == 2 else "u"
                        state = STEPS[state, letter]
                        out.append(
                            {
                                "conv_id": x["conv_id"],
                                "piece": x["piece"],
                                "at": at,
                                "place": None if edit == "I" else place,
                                "edit": edit,
                                "made": None if edit == "K" else MADE[letter],
                            }
                        )
                    place += edit != "I"
                    if len(out) >= EDITS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    return edits


class Repair(NamedTuple):
    """conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    rows: conv_id, piece, at (their order), edit, role, text."""

    conversations: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, costs: Costs = Costs()) -> Repair:
    """The cheapest repair of each conversation in ``rows`` (conv_id, turn, role, text, copies).

    Rows of a conversation are taken by turn, NULL turns first; rows of one turn by role,
    then by a digest of their text. Blank rows (white space only) and repeats of an earlier
    role and text are deleted; a row that does not end in ``.``, ``!`` or ``?`` costs
    more where it stays. Of equally cheap repairs the one with the least audit is taken.
    A NULL conv_id is a conversation of its own, repeated rows are repeats. Roles and texts are
    not NULL here (:func:`damaged` sees to it); an empty table gives no rows, and columns of other
    names are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = rows.sparkSession
    ship(spark)
    key = rows.schema["conv_id"].dataType.simpleString()

    def schema(fields: str) -> tuple[str, pa.Schema]:
        text = f"conv_id {key}, piece int, {fields}"
        return text, to_arrow_schema(StructType.fromDDL(text))

    ranged = marked(rows.select("conv_id", "turn", "role", "text", "copies")).repartitionByRange("conv_id", "turn", "role", "row")
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "row")
    text, arrow = schema(f"row string, place bigint, summary {SUMMARY}")
    cells = stage(ordered.mapInArrow(_cells_of(costs, arrow), text), "repair-cells")

    pieces = cells.where("summary IS NOT NULL").select("conv_id", "piece", "summary")
    totals = "struct<gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, cost bigint, audit string>"
    text, arrow = schema(f"start int, end int, audit string, totals {totals}")
    alone, together = _settle_of(arrow)
    inner = pieces.where("summary.inner").mapInArrow(alone, text)
    # At most two pieces a range.
    outer = pieces.where("NOT summary.inner").groupBy("conv_id").applyInArrow(together, text)
    settled = stage(inner.unionByName(outer), "repair-settled")

    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    conversations = settled.where("totals IS NOT NULL").select("conv_id", *[f"totals.{n}" for n in names])
    return Repair(conversations, _repaired_rows(rows, cells, settled, schema))


def _repaired_rows(rows: DataFrame, cells: DataFrame, settled: DataFrame, schema) -> DataFrame:
    """The rows that stay or are made, with their texts."""
    text, arrow = schema("at bigint, place bigint, edit string, made string")
    edits = settled.select("conv_id", "piece", "start", "end", "audit").mapInArrow(_edits_of(arrow), text)
    facts = cells.where("row IS NOT NULL").select("conv_id", "piece", "row", "place")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "piece", "place")]
    edited = edits.alias("e").join(facts.alias("f"), same, "left").select("e.conv_id", "e.piece", "e.at", "e.edit", "e.made", "f.row")
    # Equal rows are one here before they move.
    body = identified(rows.select("conv_id", "turn", "role", "text")).groupBy("row").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    return edited.join(body, "row", "left").select(
        "conv_id", "piece", "at", "edit", F.coalesce("made", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def _digests_of(schema: pa.Schema):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, digest = None, None
        for batch in batches:
            out = []
            for key, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]):
                if digest is None or key != conv_id:
                    if digest is not None:
                        out.append({"conv_id": conv_id, "sha256": digest.hexdigest()})
                    conv_id, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "sha256": digest.hexdigest()}], schema)

    return digests


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, sha256 of the repaired rows as ``role:text``, joined by line feeds; read in order, one row at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    text = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, sha256 string"
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at").select("conv_id", "role", "text")
    return ordered.mapInArrow(_digests_of(to_arrow_schema(StructType.fromDDL(text))), text)


def repair_digests(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """A row for each conv_id of ``conversations``, damaged and repaired."""
    done = repair(damaged(conversations), costs)
    ids = conversations.select("conv_id").distinct()
    counts = done.conversations.withColumnRenamed("conv_id", "key")
    hashes = digests(done.rows).withColumnRenamed("conv_id", "hash_key")
    joined = ids.join(counts, F.col("conv_id").eqNullSafe(F.col("key")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("hash_key")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
