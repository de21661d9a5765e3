"""Chat formatting: layouts told apart by a schema fingerprint, one template, one loss mask.

A record is a JSON text. The paths of its nested fields (list items as ``[]``), as far as some
layout knows them, are sorted and hashed; the hash selects the declarative mapping that turns the
record into turns. The template marks every turn and escapes control strings inside roles and
texts, so a formatted conversation can always be read back.

Edge cases: null roles and texts are empty ones; an empty list of messages gives no turns; a record
whose fingerprint no mapping has, or that is not JSON, gives one turn with layout null, role ``unknown``
and the record as its text, so that nothing is lost; turns with equal numbers are ordered by role and
text; unknown fields are ignored, whatever their names; null ids are one conversation.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import bounded_batches

# Declarative mappings. ``each``: a list of messages with the fields of role and text;
# ``turns``: roles with the fields whose texts, joined by blank lines, make the turn;
# ``row``: one turn per record with the fields of number, role and text.
LAYOUTS = [
    {"name": "messages", "each": ("messages", "role", "content")},
    {"name": "conversations", "each": ("conversations", "from", "value")},
    {"name": "prompt_response", "turns": [("system?", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    {"name": "prompt_completion", "turns": [("system?", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])]},
    {"name": "instruction", "turns": [("system?", ["system"]), ("user", ["instruction", "input?"]), ("assistant", ["output"])]},
    {"name": "turn_row", "row": ("turn", "role", "text")},
]
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
# Strings that some template gives a meaning: the marks below and those in common use.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>"]
OPEN, CLOSE = "<|turn|>", "<|end|>\n"


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all nested fields, items of a list under one path."""
    if isinstance(value, dict):
        inner = [(f"{at}.{k}" if at else str(k), v) for k, v in value.items()]
        return {p for p, _ in inner}.union(*(field_paths(v, p) for p, v in inner))
    if isinstance(value, list):
        return {f"{at}[]"}.union(*(field_paths(v, f"{at}[]") for v in value))
    return set()


def _fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _shapes(layout: dict) -> list[set[str]]:
    """The sets of paths a layout may have: one for each choice of its optional fields."""
    if "each" in layout:
        top, role, text = layout["each"]
        full = {top, f"{top}[]", f"{top}[].{role}", f"{top}[].{text}"}
        return [full, {top, f"{top}[]"}]
    if "row" in layout:
        return [set(layout["row"])]
    fields = [(f.rstrip("?"), f.endswith("?") or role.endswith("?")) for role, names in layout["turns"] for f in names]
    need, may = {f for f, optional in fields if not optional}, [f for f, optional in fields if optional]
    return [need | set(c) for c in chain.from_iterable(combinations(may, k) for k in range(len(may) + 1))]


def mapping_table(layouts: list[dict]) -> tuple[set[str], dict[str, dict]]:
    """All known paths, and the layout of each fingerprint; the first layout wins a tie."""
    shapes = [(shape, layout) for layout in layouts for shape in _shapes(layout)]
    table: dict[str, dict] = {}
    for shape, layout in shapes:
        table.setdefault(_fingerprint(shape), layout)
    return set().union(*(shape for shape, _ in shapes)), table


def _text(value: object) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def read_record(payload: str, known: set[str], table: dict[str, dict]) -> list[tuple[int | None, str, str, str | None]]:
    """(turn, role, text, layout) for every turn of a record.

    A record that cannot be read whole (no JSON, no known layout, a turn that is no 64-bit integer,
    text that is no valid Unicode, nesting too deep) is one layout-null turn holding the payload;
    items of a message list that are no objects are layout-null turns of their own. Nothing is lost.
    """
    try:
        found = _read_record(payload, known, table)
        for turn, role, text, _ in found:
            if turn is not None and (isinstance(turn, bool) or not isinstance(turn, int) or not -(1 << 63) <= turn < 1 << 63):
                raise ValueError("turn is no 64-bit integer")
            role.encode()
            text.encode()
        return found
    except (ValueError, TypeError, KeyError, AttributeError, RecursionError, OverflowError, UnicodeError):
        return [(0, "unknown", payload or "", None)]


def _read_record(payload: str, known: set[str], table: dict[str, dict]) -> list[tuple[int | None, str, str, str | None]]:
    try:
        record = json.loads(payload)
        layout = table.get(_fingerprint(field_paths(record) & known)) if isinstance(record, dict) else None
    except (ValueError, TypeError):
        layout = None
    if layout is None:
        return [(0, "unknown", payload or "", None)]
    name = layout["name"]
    if "each" in layout:
        top, role, text = layout["each"]
        items = record[top] or []
        return [
            (i, ROLES.get(r := _text(m.get(role)), r), _text(m.get(text)), name) if isinstance(m, dict) else (i, "unknown", _text(m), None)
            for i, m in enumerate(items)
        ]
    if "row" in layout:
        turn, role, text = (record[f] for f in layout["row"])
        return [(turn, _text(role), _text(text), name)]
    found = []
    for role, fields in layout["turns"]:
        texts = [_text(record.get(f.rstrip("?"))) for f in fields]
        if not role.endswith("?") or any(texts):
            found.append((role.rstrip("?"), "\n\n".join(t for t in texts if t)))
    return [(i, role, text, name) for i, (role, text) in enumerate(found)]


def canonical_turns(records: DataFrame, id_col: str, payload_col: str = "payload", layouts: list[dict] | None = None) -> DataFrame:
    """(id, ``turn``, ``role``, ``text``, ``layout``) for the turns of JSON records of any known layout."""
    bounded_batches(records.sparkSession)
    known, table = mapping_table(layouts or LAYOUTS)
    source = records.select(F.col(id_col).alias("id"), F.col(payload_col).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [read_record(p, known, table) for p in batch.column("payload").to_pylist()]
            ids = batch.column("id").take(pa.array([i for i, t in enumerate(turns) for _ in t], pa.int64()))
            columns = list(zip(*(t for found in turns for t in found))) or [[], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "turn", "role", "text", "layout"]
            )

    id_type = source.schema["id"].dataType.simpleString()
    turns = source.mapInArrow(run, f"id {id_type}, turn long, role string, text string, layout string")
    return turns.withColumnRenamed("id", id_col)


_INSIDE = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROL)


def escape(text: Column) -> Column:
    """Backslashes doubled, and one put after the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _INSIDE, r"\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``turns`` with ``formatted`` and the span [``loss_start``, ``loss_end``) of its characters under the loss.

    A conversation's text is its formatted turns in order; every turn is formatted on its own, so a
    long conversation is spread over tasks like any other rows. Spans are empty for other roles.
    """
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    text = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    start = F.char_length(head)
    counts = F.coalesce(F.col("role") == loss_role, F.lit(False))
    return turns.withColumns(
        {
            "formatted": F.concat(head, text, F.lit(CLOSE)),
            "loss_start": start,
            "loss_end": start + F.when(counts, F.char_length(text)).otherwise(0),
        }
    )


_TURN = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n(.*)" + re.escape(CLOSE), re.DOTALL)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    role, text = _TURN.fullmatch(formatted).groups()
    return unescape(role), unescape(text)


def digests(formatted: DataFrame, id_col: str) -> DataFrame:
    """What a reader of the formatted turns finds in each conversation: counts and digests.

    A digest runs over a conversation in order, so its turns are streamed through one task, sorted
    and never held together.
    """
    rows = formatted.select(F.col(id_col).alias("id"), "turn", "role", "text", "formatted", "loss_start", "loss_end")
    ordered = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").drop("turn", "role", "text")
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started = None, False

        def rows_of(ended: list) -> pa.RecordBatch:
            ids, kept = [e[0] for e in ended], [e[1] for e in ended]
            columns = [
                [s["n"] for s in kept],
                [s["turns"].hexdigest() for s in kept],
                [s["loss_n"] for s in kept],
                [s["loss"].hexdigest() for s in kept],
                [s["chars"] for s in kept],
            ]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, batch_type[0]), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

        batch_type = [None]
        for batch in batches:
            batch_type[0], ended = batch.schema.field(0).type, []
            for id_, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or id_ != now[0]:
                    if started:
                        ended.append(now)
                    now, started = (id_, {"n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0}), True
                state, (role, said), under = now[1], read_turn(text), unescape(text[start:end])
                state["n"] += 1
                state["turns"].update(f"{role}\n{said}\n".encode())
                state["loss_n"] += len(under)
                state["loss"].update(under.encode())
                state["chars"] += len(text)
            if ended:
                yield rows_of(ended)
        if started:
            yield rows_of([now])

    found = ordered.mapInArrow(
        run, f"id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return found.withColumnRenamed("id", id_col)
