"""Repair of conversation structure by a grammar-compressed min-plus DP.

A conversation is repaired into role initials of the form ``(s?(ua)+)?`` by the cheapest edits:
Keep (0), Rerole to user or assistant (3), Delete (4, the only edit for blank or duplicate rows),
Insert an empty user or assistant turn anywhere (3); a truncated row that is not deleted adds 3.
The grammar's four states (start, after s, after u, after a) make every row a 4 x 4 min-plus
transfer matrix whose entries hold a cost and the audit (edit initials) of the cheapest way, ties
ASCII-least; inserts before a row belong to its matrix, inserts after the last row to a closing one.

Rows map to a few symbols (role initial class x truncated, or must-delete). Rows are range
partitioned by conversation and order, so a very long conversation is split over many tasks; in
each task Re-Pair replaces the most frequent adjacent symbol pair of all its pieces by a rule, again
and again, and every rule's matrix is the min-plus product of its two halves, evaluated bottom-up
once and shared by all pieces. An audit is a rope of its halves' audits. The pieces of a
conversation (at most one per task) are then multiplied in order; their chosen states let every
piece replay its own rows.

Lexicographic ties compose: two cheapest audits between the same states over the same rows hold the
same row letters, so neither is a proper prefix of the other (the longer would end in inserts that
return to the same state, which cost), and the least concatenation is the concatenation of leasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import BLANKS, store

# Rules that Re-Pair adds in one task at most; fewer rules only share less, the results are equal.
RULES = 256
STATES = 4  # 0 start, 1 after s, 2 after u, 3 after a
ACCEPT = (0, 3)
MUST_DELETE = 0
_CLASSES = "suao"
_NO_BLANK = "[^\\x20\\x09-\\x0D]"
LEGAL = ("su", "ua", "au")  # adjacent role initials that are not counted as illegal
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


class Rope:
    """An audit as the concatenation of two audits, materialised once when read."""

    __slots__ = ("left", "right", "size", "_text")

    def __init__(self, left: Rope | str, right: Rope | str = "") -> None:
        self.left, self.right = left, right
        self.size = len(left) + len(right)
        self._text = None

    def __len__(self) -> int:
        return self.size

    def text(self) -> str:
        if self._text is None:
            parts, todo = [], [self]
            while todo:
                node = todo.pop()
                if isinstance(node, str):
                    parts.append(node)
                elif node._text is not None:
                    parts.append(node._text)
                else:
                    todo.extend((node.right, node.left))
            self._text = "".join(parts)
        return self._text


def _text(rope: Rope | str) -> str:
    return rope if isinstance(rope, str) else rope.text()


def _better(a: tuple, b: tuple | None) -> bool:
    """Whether (cost, audit) ``a`` beats ``b``: lower cost, then the ASCII-least audit."""
    if b is None or a[0] < b[0]:
        return True
    return a[0] == b[0] and _text(a[1]) < _text(b[1])


Matrix = list  # STATES x STATES of (cost, audit) or None


def product(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product; audits are ropes of the two halves."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        for m in range(STATES):
            a = x[p][m]
            if a is None:
                continue
            for q in range(STATES):
                b = y[m][q]
                if b is None:
                    continue
                cand = (a[0] + b[0], Rope(a[1], b[1]))
                if _better(cand, out[p][q]):
                    out[p][q] = cand
    return out


def _inserts() -> Matrix:
    """Cheapest insert-only moves: a user from start, after s or after a; an assistant after u."""
    m: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        m[p][p] = (0, "")
    m[0][2], m[1][2], m[3][2], m[2][3] = (3, "I"), (3, "I"), (3, "I"), (3, "I")
    m[0][3], m[1][3] = (6, "II"), (6, "II")
    return m


INSERTS = _inserts()


def symbol(cls: str | None, truncated: bool) -> int:
    """0: must delete; else 1 + 2 x class (s, u, a, other) + truncated."""
    return MUST_DELETE if cls is None else 1 + 2 * _CLASSES.index(cls) + int(truncated)


def row_matrix(sym: int) -> Matrix:
    """Inserts, then the row's own edit."""
    own: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        own[p][p] = (4, "D")
    if sym != MUST_DELETE:
        cls, extra = _CLASSES[(sym - 1) // 2], 3 * ((sym - 1) % 2)
        moves = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)], "o": []}[cls]
        for p, q in moves:
            own[p][q] = (extra, "K")
        for p, q in [(0, 2), (1, 2), (3, 2), (2, 3)]:
            if _better((3 + extra, "R"), own[p][q]):
                own[p][q] = (3 + extra, "R")
    return product(INSERTS, own)


def repair_pieces(sequences: list[np.ndarray], rules: int = RULES) -> list[Matrix]:
    """The transfer matrix of each symbol sequence, through one Re-Pair grammar shared by all."""
    matrices: dict[int, Matrix] = {s: row_matrix(s) for s in range(1 + 2 * len(_CLASSES))}
    joined = np.concatenate([np.append(s, -1) for s in sequences]) if sequences else np.empty(0, np.int64)
    joined = joined.astype(np.int64)
    fresh = len(matrices)
    for _ in range(rules):
        left, right = joined[:-1], joined[1:]
        ok = (left >= 0) & (right >= 0)
        if not ok.any():
            break
        codes = left[ok] * (1 << 31) + right[ok]
        values, counts = np.unique(codes, return_counts=True)
        best = int(np.argmax(counts))
        if counts[best] < 2:
            break
        x, y = divmod(int(values[best]), 1 << 31)
        hit = np.flatnonzero(ok & (left == x) & (right == y))
        if x == y:  # in a run x x x only every other start is taken, from the left
            run_start = np.append(True, hit[1:] != hit[:-1] + 1)
            first = np.maximum.accumulate(np.where(run_start, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
        matrices[fresh] = product(matrices[x], matrices[y])
        joined[hit] = fresh
        keep = np.ones(len(joined), bool)
        keep[hit + 1] = False
        joined = joined[keep]
        fresh += 1
    out, start = [], 0
    ends = np.flatnonzero(joined < 0)
    for end in ends:
        m = _identity()
        for s in joined[start:end].tolist():
            m = product(m, matrices[s])
        out.append(m)
        start = end + 1
    return out


def _identity() -> Matrix:
    m: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        m[p][p] = (0, "")
    return m


def choose(pieces: list[Matrix]) -> tuple[int, str, list[tuple[int, str]]]:
    """(cost, audit, [(entry state, audit) per piece]) of the cheapest accepted repair from the start state.

    The closing inserts are added to the last piece's audit.
    """
    best: list = [None] * STATES
    best[0] = (0, "", [])
    for m in [*pieces, INSERTS]:
        after: list = [None] * STATES
        for p in range(STATES):
            if best[p] is None:
                continue
            for q in range(STATES):
                if m[p][q] is None:
                    continue
                cand = (best[p][0] + m[p][q][0], best[p][1] + _text(m[p][q][1]), [*best[p][2], (p, _text(m[p][q][1]))])
                if after[q] is None or cand[0] < after[q][0] or (cand[0] == after[q][0] and cand[1] < after[q][1]):
                    after[q] = cand
        best = after
    final = min((best[q] for q in ACCEPT if best[q] is not None), key=lambda c: (c[0], c[1]))
    steps = final[2]
    closing = steps.pop()[1]
    if steps:
        steps[-1] = (steps[-1][0], steps[-1][1] + closing)
    return final[0], final[1], steps


def replay(state: int, audit: str, roles: list[str], texts: list[str]) -> list[str]:
    """Repaired ``role:text`` lines of one piece's rows from its entry state and audit."""
    lines, k = [], 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        if letter == "K":
            role = roles[k]
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
        else:
            role = "assistant" if state == 2 else "user"
            state = 3 if state == 2 else 2
        if letter == "I":
            lines.append(role + ":")
        else:
            lines.append(role + ":" + texts[k])
            k += 1
    return lines


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after damage by crc32(`conv_id:turn`) mod 20, with ``_copy`` (0, or 1 for a repeat)."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    base = conversations.select(
        F.col("conv_id").isNull().alias("_nul"),
        F.coalesce(F.col("conv_id"), F.lit(0).cast(conversations.schema["conv_id"].dataType)).alias("_cv"),
        F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), one).alias("_role"),
        F.coalesce(F.col("text").cast("string"), one).alias("_text"),
        (F.crc32(key) % 20).alias("_d"),
    ).where("_d <> 0")
    hurt = base.select(
        "_nul",
        "_cv",
        "_turn",
        F.when(F.col("_d") == 4, F.lit("user")).otherwise(F.col("_role")).alias("_role"),
        F.when(F.col("_d") == 1, F.lit(""))
        .when(F.col("_d") == 2, F.regexp_replace("_text", "[.!?]", ""))
        .otherwise(F.col("_text"))
        .alias("_text"),
        F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return hurt


def _order() -> list:
    """Order of rows within a conversation: turn (nulls first), then role, text and copy."""
    return [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text"), F.col("_copy")]


def faults(rows: DataFrame) -> DataFrame:
    """``_fault``: 'blank', 'duplicate', 'truncated' or null (the first that applies), ``_cls``: symbol class."""
    seen = Window.partitionBy("_nul", "_cv", "_role", "_text").orderBy(*_order())
    blank = ~F.col("_text").rlike(_NO_BLANK)
    last = F.regexp_extract("_text", f"({_NO_BLANK})[{_escaped(BLANKS)}]*$", 1)
    fault = (
        F.when(blank, F.lit("blank"))
        .when(F.row_number().over(seen) > 1, F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    initial = F.substring("_role", 1, 1)
    cls = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return rows.withColumn("_fault", fault).withColumn("_cls", cls)


def _escaped(chars: str) -> str:
    return "".join(f"\\x{ord(c):02X}" for c in chars)


def repair(conversations: DataFrame, rules: int = RULES) -> DataFrame:
    """One row per original conversation id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Edge cases: null conv_id is one conversation of its own, null turns come first, rows of one turn
    are ordered by role, text and copy; null role and text are one space (so a null role can only be
    rerolled or deleted); a conversation without rows after damage has zeros, audit '' and the hash
    of ''; other columns are not read and cannot clash; an empty table gives an empty table.
    """
    spark = conversations.sparkSession
    rows = store(faults(damage(conversations)), "repair_rows")
    conv_type = conversations.schema["conv_id"].dataType.simpleString()

    counted = (
        rows.groupBy("_nul", "_cv")
        .agg(
            F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.countDistinct("_turn"), F.lit(0)).cast("long").alias("gaps"),
            F.sum((F.col("_fault") == "blank").cast("long")).alias("blank"),
            F.sum((F.col("_fault") == "duplicate").cast("long")).alias("duplicate"),
            F.sum((F.col("_fault") == "truncated").cast("long")).alias("truncated"),
        )
    )

    keys = [F.col("_nul"), F.col("_cv"), *_order()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Contiguous ranges of the order, numbered: a long conversation spans several parts, each part one task's rows.
    placed = store(
        rows.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq")),
        "repair_placed",
    )
    in_parts = placed.repartition("_part").sortWithinPartitions("_seq")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # one task's rows: bounded by the range partitioning
        if not held or not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held)
        nul = table.column("_nul").to_numpy()
        cv = table.column("_cv").to_numpy()
        cls = table.column("_cls").to_pylist()
        fault = table.column("_fault").to_pylist()
        syms = np.array([symbol(None if f in ("blank", "duplicate") else c, f == "truncated") for c, f in zip(cls, fault)], np.int64)
        part = table.column("_part").to_numpy()
        change = np.flatnonzero((nul[1:] != nul[:-1]) | (cv[1:] != cv[:-1]) | (part[1:] != part[:-1])) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(syms)]])
        found = repair_pieces([syms[a:b] for a, b in zip(starts, ends)], rules)
        initials = [r[:1] for r in table.column("_role").to_pylist()]
        bad = np.array([0] + [a + b not in LEGAL for a, b in zip(initials, initials[1:])], np.int64)
        bad[starts] = 0  # a pair across two conversations or pieces is counted when pieces are combined
        illegal = np.add.reduceat(bad, starts) if len(starts) else bad[:0]
        costs = [[-1 if m[p][q] is None else m[p][q][0] for p in range(STATES) for q in range(STATES)] for m in found]
        audits = [["" if m[p][q] is None else _text(m[p][q][1]) for p in range(STATES) for q in range(STATES)] for m in found]
        yield pa.RecordBatch.from_arrays(
            [
                table.column("_nul").take(pa.array(starts)).combine_chunks(),
                table.column("_cv").take(pa.array(starts)).combine_chunks(),
                table.column("_part").take(pa.array(starts)).combine_chunks(),
                pa.array(costs, pa.list_(pa.int64())),
                pa.array(audits, pa.list_(pa.string())),
                pa.array(illegal, pa.int64()),
                pa.array([initials[a] for a in starts], pa.string()),
                pa.array([initials[b - 1] for b in ends], pa.string()),
            ],
            ["_nul", "_cv", "_part", "costs", "audits", "_illegal", "_first", "_last"],
        )

    matrices = in_parts.mapInArrow(pieces, f"_nul boolean, _cv {conv_type}, _part int, costs array<long>, audits array<string>, _illegal long, _first string, _last string")

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_part")
        found = []
        for costs, audits in zip(frame["costs"], frame["audits"]):
            found.append(
                [[None if costs[p * STATES + q] < 0 else (int(costs[p * STATES + q]), audits[p * STATES + q]) for q in range(STATES)] for p in range(STATES)]
            )
        cost, audit, steps = choose(found)
        edges = [a + b not in LEGAL for a, b in zip(frame["_last"].iloc[:-1], frame["_first"].iloc[1:])]
        illegal = int(frame["_illegal"].sum()) + sum(edges)
        return pd.DataFrame(
            {
                "_nul": frame["_nul"].values,
                "_cv": frame["_cv"].values,
                "_part": frame["_part"].values,
                "_state": [s for s, _ in steps],
                "_audit": [a for _, a in steps],
                "cost": cost,
                "audit": audit,
                "illegal": illegal,
            }
        )

    chosen = store(
        matrices.groupBy("_nul", "_cv").applyInPandas(
            combine, f"_nul boolean, _cv {conv_type}, _part int, _state int, _audit string, cost long, audit string, illegal long"
        ),
        "repair_choice",
    )

    def redo(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_seq")
        lines = replay(int(frame["_state"].iloc[0]), frame["_audit"].iloc[0], list(frame["_role"]), list(frame["_text"]))
        said = "\n".join(lines)
        return pd.DataFrame({"_nul": frame["_nul"].iloc[:1].values, "_cv": frame["_cv"].iloc[:1].values, "_part": frame["_part"].iloc[:1].values, "_said": [said if lines else None]})

    texts = placed.select("_nul", "_cv", "_part", "_seq", "_role", "_text").join(
        chosen.select("_nul", "_cv", "_part", "_state", "_audit"), ["_nul", "_cv", "_part"]
    )
    # A piece is the rows of one conversation in one task, so no group holds more than a task's rows.
    repaired = texts.groupBy("_nul", "_cv", "_part").applyInPandas(redo, f"_nul boolean, _cv {conv_type}, _part int, _said string")
    # The digest is a sequence over the whole conversation: its pieces' texts meet in one row.
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("_part", "_said"))), lambda x: x["_said"])
    digests = repaired.groupBy("_nul", "_cv").agg(F.sha2(F.concat_ws("\n", in_order), 256).alias("repaired_sha256"))
    totals = chosen.groupBy("_nul", "_cv").agg(F.first("cost").alias("cost"), F.first("audit").alias("audit"), F.first("illegal").alias("illegal"))
    ids = conversations.select(
        F.col("conv_id").isNull().alias("_nul"),
        F.coalesce(F.col("conv_id"), F.lit(0).cast(conversations.schema["conv_id"].dataType)).alias("_cv"),
        F.col("conv_id").alias("_conv"),
    ).distinct()
    done = ids.join(counted, ["_nul", "_cv"], "left").join(totals, ["_nul", "_cv"], "left").join(digests, ["_nul", "_cv"], "left")
    zero = F.lit(0).cast("long")
    return done.select(
        F.col("_conv").alias("conv_id"),
        *[F.coalesce(c, zero).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
