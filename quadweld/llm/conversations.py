"""Repair of the turn structure of conversations by weighted interval parsing.

A row can be kept, given another role, deleted, or preceded by inserted rows; the cheapest edits are sought whose roles
read ``(s?(ua)+)?`` (system, user, assistant). In Chomsky normal form that grammar has one symbol for each pair of
places (p, q) of the pattern: what leads from p to q. A pair derives a single row, with any insertions before it (their
closure), or two parts: (p, q) -> (p, m) (m, q). A cell holds the least (cost, audit) of a span and a pair; the audit is the
string of the edits' initials. Spans are combined bottom-up by length.

All ways to cut a span derive the same cells: cutting a derivation anywhere names the place reached there. So spans of
one, two, four... rows are enough. Least audits of parts make the least audit of the whole, for no audit is the beginning of
another one of equal cost (it would have to go on with insertions only, which cost). Spans of different tasks combine in the same way: rows are dealt out in
blocks of ``BLOCK`` rows of the whole sorted table, cells of blocks that share a conversation are merged in rounds, and no conversation has to
fit one task. What a conversation does meet in are its audit and its digest, one row each by contract; texts
stream through the digest one by one.

Nulls in role and text count as one space, null turns come first, all rows with a null conv_id are one conversation. Ties
of a turn are sorted by role and text, equal rows stay next to each other and all but the first are duplicates. A role that begins
with another letter, or is empty, can't be kept. A gap beyond the largest long is given as that. Other columns are ignored; an empty table has no conversations.
The table should be one that Spark reads from files, so that rows are told apart in the same way if a task runs again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from quadweld.llm.tables import materialize
from quadweld.operators.running import number_rows

#: Costs of the edits, roles that rows can be given, spaces, marks that end a text.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
SPACES = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
FOLLOWS = ["su", "ua", "au"]

#: Rows of a block, blocks merged at once, span lengths whose cells are kept for other conversations, and how many.
BLOCK = 4096
MERGE_BITS = 4
KEPT_LENGTH = 16
KEPT_CELLS = 20_000

# Places of the pattern: the start, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_FINAL = (_START, _ASSISTANT)
# Where a role leads from a place.
_STEP = {
    "s": {_START: _SYSTEM},
    "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
    "a": {_USER: _ASSISTANT},
}
_LARGEST = (1 << 63) - 1

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def _closure() -> Cells:
    """Cheapest insertions that lead from one place to another."""
    found = {(p, p): (0, "") for p in range(4)}
    for _ in range(2):
        for (p, m), (cost, audit) in list(found.items()):
            for role in "ua":
                q = _STEP[role].get(m)
                if q is not None and (p, q) not in found:
                    found[p, q] = (cost + INSERT, audit + "I")
    return found


_INSERTED = _closure()


def row_symbol(initial: Column, fault: Column) -> Column:
    """A row for the grammar: its role's initial (x: any other), in capitals if truncated; ``-`` if it must go."""
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    return (
        F.when(fault.isin("blank", "duplicate"), F.lit("-")).when(fault == "truncated", F.upper(role)).otherwise(role)
    )


def _put(cells: Cells, pair: tuple[int, int], cell: Cell) -> None:
    if pair not in cells or cell < cells[pair]:
        cells[pair] = cell


def row_cells(symbol: str) -> Cells:
    """Cells of a single row."""
    role = symbol.lower()
    extra = LEFT_TRUNCATED if symbol != role else 0
    cells: Cells = {}
    for (p, m), (cost, audit) in _INSERTED.items():
        _put(cells, (p, m), (cost + DELETE, audit + "D"))
        if symbol == "-":
            continue
        if m in _STEP.get(role, {}):
            _put(cells, (p, _STEP[role][m]), (cost + extra, audit + "K"))
        for given in "ua":
            if m in _STEP[given]:
                _put(cells, (p, _STEP[given][m]), (cost + extra + REROLE, audit + "R"))
    return cells


def joined_cells(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans taken together."""
    cells: Cells = {}
    for (p, m), (cost, audit) in left.items():
        for q in range(4):
            after = right.get((m, q))
            if after is not None and ((p, q) not in cells or cost + after[0] <= cells[p, q][0]):
                _put(cells, (p, q), (cost + after[0], audit + after[1]))
    return cells


def span_cells(symbols: str, kept: dict[str, Cells]) -> Cells:
    """Cells of a run of rows, at least one: spans of one row, then of two, four and so on. ``kept`` has cells of short runs."""
    spans = [(s, kept.get(s) or kept.setdefault(s, row_cells(s))) for s in symbols]
    while len(spans) > 1:
        longer = []
        for k in range(0, len(spans) - 1, 2):
            (left, a), (right, b) = spans[k : k + 2]
            run = left + right
            cells = kept.get(run)
            if cells is None:
                cells = joined_cells(a, b)
                if len(run) <= KEPT_LENGTH:
                    kept[run] = cells
            longer.append((run, cells))
        spans = longer + spans[len(spans) & ~1 :]
    if len(kept) > KEPT_CELLS:
        kept.clear()
    return spans[0][1]


def completed(cells: Cells) -> tuple[int, str, int, int]:
    """Cost and audit of a whole conversation, the place its last row leads to, and insertions after it."""
    return min(
        (cost + more, audit + rest, q, len(rest))
        for (p, q), (cost, audit) in cells.items()
        for (m, end), (more, rest) in _INSERTED.items()
        if p == _START and m == q and end in _FINAL
    )


class Edit(NamedTuple):
    action: str
    role: str | None
    before: list[str]


def edits_of(symbols: str, audit: str, place: int) -> tuple[list[Edit], list[str]]:
    """The edits of the rows of a span that begins at ``place``, and the roles inserted after the last one."""
    edits, inserted, row = [], [], 0
    for letter in audit:
        role = None
        if letter in "IR":
            # The places allow one of the two roles only.
            role, place = next((full, _STEP[full[0]][place]) for full in (USER, ASSISTANT) if place in _STEP[full[0]])
        if letter == "I":
            inserted.append(role)
            continue
        if letter == "K":
            place = _STEP[symbols[row].lower()][place]
        edits.append(Edit(letter, role, inserted))
        inserted, row = [], row + 1
    return edits, inserted


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, k, turn, role, text) with their first fault, or none; k is the order of all rows."""
    bare = F.rtrim("text", F.lit(SPACES))
    looks = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(ENDS), "truncated")
    slim = rows.select("conv", "k", "turn", F.substring("role", 1, 1).alias("initial"), looks.alias("looks"))
    # The first row of each role and text, by a digest of the text; k is unique, so the join meets no heavy key.
    firsts = rows.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("k").alias("k")).select("k", F.lit(True).alias("is_first"))
    again = F.col("is_first").isNull() & ~F.col("looks").eqNullSafe("blank")
    fault = F.when(again, "duplicate").otherwise(F.col("looks"))
    return slim.join(firsts, "k", "left").select("conv", "k", "turn", "initial", fault.alias("fault"))


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_PIECE = (
    "block long, start long, symbols string, first string, last string, least long, most long, "
    + ", ".join(f"{c} long" for c in _COUNTS)
    + ", pairs array<int>, costs array<long>, audits array<string>, paths array<string>, edge boolean"
)


def _typed(conv: StructField, ddl: str) -> StructType:
    return StructType([conv, *StructType.fromDDL(ddl).fields])


def _cell_columns(cells: Cells, paths: dict | None = None) -> dict:
    pairs = sorted(cells)
    return {
        "pairs": [4 * p + q for p, q in pairs],
        "costs": [cells[x][0] for x in pairs],
        "audits": [cells[x][1] for x in pairs],
        "paths": [(paths or {}).get(x, str(x[0])) for x in pairs],
    }


def _pieces(schema: pa.Schema, block: int):
    """A function over rows sorted by k: one piece for each conversation of a block, with its cells and counts."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Cells] = {}
        piece, key, out = None, None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv, k, turn, initial, symbol, fault in zip(*columns, strict=True):
                if piece is None or (conv, k // block) != key:
                    if piece is not None:
                        out.append(finished(piece, kept))
                    key = (conv, k // block)
                    piece = {"conv": conv, "block": k // block, "start": k, "symbols": [], "first": initial, "last": None, "least": None, "most": None}
                    piece |= dict.fromkeys(_COUNTS, 0)
                elif piece["last"] + initial not in FOLLOWS:
                    piece["illegal"] += 1
                piece["symbols"].append(symbol)
                piece["last"] = initial
                if fault:
                    piece[fault] += 1
                if turn is not None and turn != piece["most"]:
                    piece["least"] = turn if piece["least"] is None else piece["least"]
                    piece["most"], piece["turns"] = turn, piece["turns"] + 1
            if len(out) > 2_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if piece is not None:
            out.append(finished(piece, kept))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    def finished(piece: dict, kept: dict) -> dict:
        symbols = "".join(piece["symbols"])
        # A piece that reaches neither end of its block is a whole conversation.
        edge = piece["start"] % block == 0 or (piece["start"] + len(symbols)) % block == 0
        return piece | _cell_columns(span_cells(symbols, kept)) | {"symbols": symbols, "edge": edge}

    return apply


def _merged(schema: pa.Schema):
    """A function that joins the pieces of one conversation and some neighbouring blocks."""

    def apply(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        whole = rows[0]
        for row in rows[1:]:
            left, right = _cells(whole), _cells(row)
            paths = {}
            cells = joined_cells(left, right)
            for (p, q), cell in cells.items():
                m = next(m for m in range(4) if (p, m) in left and (m, q) in right and cell == (left[p, m][0] + right[m, q][0], left[p, m][1] + right[m, q][1]))
                paths[p, q] = _path(whole, p, m) + _path(row, m, q)
            illegal = whole["last"] + row["first"] not in FOLLOWS
            same = whole["most"] is not None and whole["most"] == row["least"]
            sums = {c: whole[c] + row[c] for c in _COUNTS}
            whole = whole | sums | _cell_columns(cells, paths) | {"last": row["last"]}
            whole["illegal"] += illegal
            whole["turns"] -= same
            whole["least"] = row["least"] if whole["least"] is None else whole["least"]
            whole["most"] = whole["most"] if row["most"] is None else row["most"]
        # Blocks are counted anew in the next round.
        whole["block"] >>= MERGE_BITS
        return pa.Table.from_pylist([whole], schema)

    return apply


def _cells(row: dict) -> Cells:
    return {divmod(pair, 4): (cost, audit) for pair, cost, audit in zip(row["pairs"], row["costs"], row["audits"], strict=True)}


def _path(row: dict, p: int, q: int) -> str:
    return row["paths"][row["pairs"].index(4 * p + q)]


def _completed(schema: pa.Schema):
    """A function that ends conversations: counts, cost and audit, and where each of their pieces begins."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cost, audit, end, after = completed(_cells(row))
                gaps = 0 if row["least"] is None else row["most"] - row["least"] + 1 - row["turns"]
                out.append(row | {"cost": cost, "audit": audit, "gaps": min(gaps, _LARGEST), "after": after, "path": _path(row, _START, end) + str(end)})
            yield pa.RecordBatch.from_pylist(out, schema)

    return apply


def _row_edits(schema: pa.Schema):
    """A function that spells out the edits of the pieces' rows."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p, q = int(row["begins"]), int(row["ends"])
                cells = _cells(row)
                edits, _ = edits_of(row["symbols"], cells[p, q][1], p)
                out = [{"k": row["start"] + i, "action": e.action, "new_role": e.role, "before": e.before, "after": []} for i, e in enumerate(edits)]
                if row["after"]:
                    out[-1]["after"] = edits_of("", "I" * row["after"], q)[1]
                yield pa.RecordBatch.from_pylist(out, schema)

    return apply


class Repair(NamedTuple):
    """``conversations``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. ``rows``: conv, k, turn, role, text,
    fault, action, new_role and the roles inserted ``before`` and ``after`` the row."""

    conversations: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, ties: list[str] | None = None, block: int = BLOCK) -> Repair:
    """The cheapest repair of conversations (conv, turn, role, text), written once in their order.

    ``ties`` names further columns that sort the rows of a turn, before role and text.
    """
    conv, ties = rows.schema["conv"], ties or []
    clean = rows.select(
        "conv",
        F.col("turn").cast("long").alias("turn"),
        *ties,
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        # The last key spreads equal rows over tasks.
        F.monotonically_increasing_id().alias("id"),
    )
    # Numbers from 0 over the whole table.
    numbered = number_rows(clean, ["conv", "turn", *ties, "role", "text", "id"], "k")
    ordered = numbered.select("conv", (F.col("k") - 1).alias("k"), "turn", "role", "text")
    faults = materialize(with_faults(ordered), "faults")

    slim = faults.select("conv", "k", "turn", "initial", row_symbol(F.col("initial"), F.col("fault")).alias("symbol"), "fault")
    by_block = slim.repartition(F.expr(f"k div {block}")).sortWithinPartitions("k")
    schema = _typed(conv, _PIECE)
    arrow = to_arrow_schema(schema)
    pieces = materialize(by_block.mapInArrow(_pieces(arrow, block), schema), "pieces")

    edges = pieces.where("edge")
    while True:
        step = edges.groupBy("conv", F.shiftright("block", MERGE_BITS).alias("next")).applyInArrow(_merged(arrow), schema)
        edges = materialize(step, "merged")
        if edges.groupBy("conv").count().where("count > 1").isEmpty():
            break
    whole = pieces.where("not edge").unionByName(edges)
    final = _typed(conv, _PIECE + ", cost long, audit string, gaps long, after int, path string")
    done = materialize(whole.mapInArrow(_completed(to_arrow_schema(final)), final), "repaired")

    # Whole conversations know their only piece; the pieces of others are found by conversation and place in the path.
    plain = done.where("not edge").select("start", "symbols", "pairs", "costs", "audits", F.substring("path", 1, 1).alias("begins"), F.substring("path", 2, 1).alias("ends"), "after")
    spread = done.where("edge").select("conv", "path", "after", F.length("path").alias("n"), F.expr(f"start div {block}").alias("from"))
    places = spread.select(
        "conv",
        "n",
        "from",
        "after",
        F.posexplode(F.expr("transform(sequence(1, n - 1), i -> substring(path, i, 2))")).alias("nth", "step"),
    ).select(
        F.col("conv").alias("of"),
        (F.col("from") + F.col("nth")).alias("at"),
        F.substring("step", 1, 1).alias("begins"),
        F.substring("step", 2, 1).alias("ends"),
        F.when(F.col("nth") == F.col("n") - 2, F.col("after")).otherwise(F.lit(0)).cast("int").alias("after"),
    )
    parts = pieces.where("edge").join(places, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    pieces_placed = plain.unionByName(parts.select(*plain.columns))
    edit = StructType.fromDDL("k long, action string, new_role string, before array<string>, after array<string>")
    edits = pieces_placed.mapInArrow(_row_edits(to_arrow_schema(edit)), edit)
    edited = ordered.join(faults.select("k", "fault"), "k").join(edits, "k")
    counts = done.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repair(counts, edited)


def _digests(schema: pa.Schema):
    """A function over rows sorted by conversation and k: the SHA-256 of each one's repaired rows."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        digest, key, started, out = None, None, False, []
        for batch in batches:
            for i in range(batch.num_rows):
                conv, _, role, text, action, before, after = (c[i].as_py() for c in batch.columns)
                if digest is None or conv != key:
                    if digest is not None:
                        out.append({"conv": key, "repaired_sha256": digest.hexdigest()})
                    digest, key, started = hashlib.sha256(), conv, False
                lines = [(r, "") for r in before] + [(role, text)] * (action != "D") + [(r, "") for r in after]
                for role_given, said in lines:
                    digest.update(f"{chr(10) if started else ''}{role_given}:{said}".encode())
                    started = True
            if len(out) > 2_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if digest is not None:
            out.append({"conv": key, "repaired_sha256": digest.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return apply


def digests(repaired: Repair) -> DataFrame:
    """Per conversation the SHA-256 of its repaired ``role:text`` lines. A digest is made in one go: the rows of one
    conversation stream through one task, which holds one batch of them."""
    rows = repaired.rows.select("conv", "k", F.coalesce("new_role", "role").alias("role"), "text", "action", "before", "after")
    schema = StructType([repaired.rows.schema["conv"]]).add("repaired_sha256", "string")
    return rows.repartition("conv").sortWithinPartitions("conv", "k").mapInArrow(_digests(to_arrow_schema(schema)), schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the query: rows drop out, lose their text or its end marks, come twice or get another role."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20).cast("int")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(known("text"), "".join(ENDS), "")).otherwise(known("text"))
    role = F.when(kind == 4, F.lit(USER)).otherwise(known("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    # Rows of one turn stay in the order they had before; they are damaged alike.
    return conversations.where(kind != 0).select(
        F.col("conv_id").alias("conv"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        known("role").alias("old_role"),
        F.when(kind.isin(1, 2), known("text")).alias("old_text"),
        copies.alias("copy"),
    )


def op13_repair(conversations: DataFrame) -> DataFrame:
    repaired = repair(damaged(conversations), ["old_role", "old_text"])
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select(F.col("conv_id").alias("conv"))
    nothing = hashlib.sha256(b"").hexdigest()
    everything = ids.unionByName(repaired.conversations, allowMissingColumns=True).unionByName(digests(repaired), allowMissingColumns=True)
    return everything.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )


ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS old_role, COALESCE(text, ' ') AS old_text,
    COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT *, CAST(xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::UBIGINT)),
    lambda sum, byte: list_reduce(
      list_prepend(xor(sum, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))) % 20 AS INTEGER) AS kind
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, old_role, old_text, CASE kind WHEN 4 THEN 'user' ELSE old_role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(old_text, '.!?', '') ELSE old_text END AS text,
    UNNEST(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, old_role, old_text, copy) AS pos,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), steps(p, role, q) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
), inserted(p, q, cost, audit, lines) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
    (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
    (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])
), edits AS (
  SELECT f.conv_id, f.pos, s.p, s.q, s.cost + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cost, s.audit,
    CASE s.audit WHEN 'K' THEN [f.role || ':' || text] ELSE [s.given || ':' || text] END AS lines
  FROM faults f JOIN (
    SELECT role, p, q, 0 AS cost, 'K' AS audit, '' AS given FROM steps
    UNION ALL SELECT r.role, p, q, 1, 'R', CASE s.role WHEN 'u' THEN 'user' ELSE 'assistant' END
    FROM steps s, (SELECT DISTINCT left(role, 1) AS role FROM placed) r WHERE s.role <> 's'
  ) s ON s.role = f.initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, p, p, 2, 'D', [] FROM faults, (VALUES (0), (1), (2), (3)) AS places(p)
), moves AS (
  SELECT e.conv_id, e.pos, i.p, e.q, i.cost + e.cost AS cost, i.audit || e.audit AS audit, list_concat(i.lines, e.lines) AS lines
  FROM edits e JOIN inserted i ON i.q = e.p
), parsed AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, pos, q, cost, audit, lines FROM (
    SELECT m.conv_id, m.pos, m.q, s.cost + m.cost AS cost, s.audit || m.audit AS audit, list_concat(s.lines, m.lines) AS lines
    FROM parsed s JOIN moves m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.pos = s.pos + 1 AND m.p = s.q
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, pos, q ORDER BY cost, audit) = 1
), counts AS (
  SELECT conv_id, COALESCE(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(pos) AS pos,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), ended AS (
  SELECT c.*, s.cost + i.cost AS cost, s.audit || i.audit AS audit, list_concat(s.lines, i.lines) AS lines
  FROM counts c JOIN parsed s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.pos = c.pos
  JOIN inserted i ON i.p = s.q WHERE i.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY c.conv_id ORDER BY s.cost + i.cost, s.audit || i.audit) = 1
)
SELECT d.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
  COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(COALESCE(cost, 0) AS BIGINT) AS cost,
  COALESCE(audit, '') AS audit, sha256(COALESCE(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""
