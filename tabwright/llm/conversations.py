"""Repair of damaged conversations by the cheapest edits, found by branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.joins import lookup
from tabwright.session import settle

#: Rows that may stay which one search takes; a longer conversation is searched in several parts.
SEGMENT = 512
DELETE, INSERT, RELABEL, TRUNCATED = 2, 5, 1, 5
BLANKS = " \t\n\x0b\x0c\r"

#: What has been said last: nothing, the system's turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = (START, ASSISTANT)
#: Initials by the state they lead to; 0 is every other initial.
CODES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_MOST = 2**63 - 1


def code_of(role: str) -> int:
    return CODES.get(role[:1], 0)


def follows(state: int, code: int) -> bool:
    """May a row of this initial come next?"""
    return (state, code) in LEGAL or (state == START and code in (SYSTEM, USER))


def due(state: int) -> int:
    """The role that an inserted or relabelled row takes."""
    return ASSISTANT if state == USER else USER


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of ``rows`` after damage that crc32 of "conv_id:turn" decides.

    Of twenty remainders 0 drops the row (no copies), 1 empties its text, 2 takes out its full stops,
    exclamation and question marks, 3 doubles it, 4 makes it a user's. Nulls count as one blank, but
    the columns conv_id and turn stay null.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(how == 4, "user").otherwise(text_of("role")).alias("role"),
        text.alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with a digest of conversation, role and text, and without nulls in role, text and copies."""
    copies = F.coalesce(F.col("copies").cast("bigint"), F.lit(1)) if "copies" in rows.columns else F.lit(1).cast("bigint")
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    whole = F.concat(conv, F.lit("\n"), F.length("role").cast("string"), F.lit("\n"), F.col("role"), F.col("text"))
    return plain.withColumn("digest", F.unhex(F.sha2(whole, 256)))


def _faults(keyed: DataFrame) -> DataFrame:
    """One row per different row of a conversation: its copies, whether it is blank or truncated, and
    whether an earlier one has its role and text. A row without copies stands for its conversation only."""
    there = F.col("copies") > 0
    body = F.rtrim("text", F.lit(BLANKS))
    flat = keyed.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, F.col("digest")).otherwise(F.lit(b"")).alias("digest"),
        F.when(there, body == "").otherwise(False).alias("blank"),
        F.when(there, ~F.right(body, F.lit(1)).isin(".", "!", "?")).otherwise(False).alias("truncated"),
        F.greatest("copies", F.lit(0)).alias("copies"),
    )
    rows = flat.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("n"))
    rows = settle(rows, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    first = rows.filter("n > 0").groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns"))
    first = settle(first.filter("turns > 1"), "again")
    marked = lookup(rows, first, ["digest"], "turns", "turn")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return marked.select("conv_id", "turn", "role", "digest", "blank", "truncated", "n", later.alias("later"))


@dataclass
class Part:
    """A run of rows of one conversation, in order."""

    #: rows that may stay: forced deletions before it, code of its initial, truncated
    items: list[tuple[int, int, bool]] = field(default_factory=list)
    #: forced deletions after the last of them
    tail: int = 0
    opening: bool = True
    n_rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_code: int = 0
    last_code: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    key: tuple = ()

    def add(self, turn: int | None, role: str, blank: bool, truncated: bool, later: bool, n: int) -> None:
        if n == 0:
            return
        code = code_of(role)
        if self.n_rows:
            self.illegal += (self.last_code, code) not in LEGAL
        else:
            self.first_code = code
        self.illegal += n - 1
        self.last_code = code
        self.n_rows += n
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        stays = not (blank or later)
        if blank:
            self.blank += n
        else:
            self.duplicate += n - stays
        if stays:
            self.truncated += truncated
            self.items.append((self.tail, code, truncated))
            self.tail = 0
        self.tail += n - stays


def bounds(items: list[tuple[int, int, bool]], lead: list[int], exits: Iterable[int]) -> list[list[int]]:
    """For each place and state what the rest costs at least; ``lead`` are the forced deletions before each place.

    The bound leaves audits out of account: from the last row back, the cheapest step to any state.
    """
    far = 1 << 40

    def with_insertions(to: list[int]) -> list[int]:
        for _ in STATES:
            to = [min(c, INSERT + to[due(s)]) for s, c in enumerate(to)]
        return to

    exits = set(exits)
    low = [with_insertions([0 if s in exits else far for s in STATES])]
    for i in range(len(items) - 1, -1, -1):
        _, code, cut = items[i]
        then, stay = low[-1], TRUNCATED if cut else 0
        here = []
        for s in STATES:
            c = min(DELETE + then[s], stay + RELABEL + then[due(s)])
            if follows(s, code):
                c = min(c, stay + then[code])
            here.append(c + DELETE * lead[i + 1])
        low.append(with_insertions(here))
    low.reverse()
    return low


def search(items: list[tuple[int, int, bool]], tail: int, entry: int, exits: Iterable[int]) -> tuple[int, str] | None:
    """The cheapest edits, and of those the least audit, that lead from ``entry`` to one of ``exits``.

    Depth first with a stack of its own, lesser edits first. A node is a place and a state; what leads to it is a cost and
    an audit. A prefix is given up if its cost and the lower bound of the rest exceed the incumbent's cost (or
    meet it with a greater audit), or if a better prefix has reached its node. Of two prefixes of equal cost
    neither is the beginning of the other, as their edits differ by insertions alone; so the lesser stays so
    with anything after it. The search ends when no prefix is left, which proves the incumbent.
    """
    n, exits = len(items), set(exits)
    lead = [*(before for before, _, _ in items), tail]
    low = bounds(items, lead, exits)
    root = (DELETE * lead[0], "D" * lead[0])
    if low[0][entry] >= 1 << 40:
        return None
    # nothing costs less than the bound at the root: what exceeds it needs no incumbent to be given up
    limit = root[0] + low[0][entry]
    best: tuple[int, str] | None = None
    seen = {entry: root}
    stack = [(0, entry, *root)]
    while stack:
        i, state, cost, audit = stack.pop()
        if seen[4 * i + state] != (cost, audit):
            continue
        if best is not None and cost + low[i][state] >= best[0] and audit > best[1][: len(audit)]:
            continue
        if i == n and state in exits and (best is None or (cost, audit) < best):
            best = cost, audit
            limit = cost
        then = due(state)
        options = []
        if i < n:
            _, code, cut = items[i]
            run = "D" * lead[i + 1]
            base = cost + DELETE * lead[i + 1]
            keep = base + (TRUNCATED if cut else 0)
            if code != then:
                options.append((i + 1, then, keep + RELABEL, audit + "R" + run))
            if follows(state, code):
                options.append((i + 1, code, keep, audit + "K" + run))
        options.append((i, then, cost + INSERT, audit + "I"))
        if i < n:
            options.append((i + 1, state, base + DELETE, audit + "D" + run))
        for j, to, c, a in options:
            if c + low[j][to] > limit:
                continue
            known = seen.get(4 * j + to)
            if known is not None and known <= (c, a):
                continue
            seen[4 * j + to] = c, a
            stack.append((j, to, c, a))
    return best


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in fields.items()])


_LONG, _INT = T.LongType(), T.IntegerType()
_SUMS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns")
_PART = _struct(
    key=_struct(late=T.BooleanType(), turn=_LONG, role=T.StringType(), digest=T.BinaryType()),
    **dict.fromkeys(_SUMS, _LONG),
    first_code=_INT,
    last_code=_INT,
    ways=T.ArrayType(_struct(entry=_INT, leave=_INT, cost=_LONG, audit=T.StringType())),
)


def _ways(part: Part, closing: bool) -> list[dict]:
    out = []
    for entry in (START,) if part.opening else STATES:
        for leave in (ENDS,) if closing else ((s,) for s in STATES):
            found = search(part.items, part.tail, entry, leave)
            if found is not None:
                out.append({"entry": entry, "leave": START if closing else leave[0], "cost": found[0], "audit": found[1]})
    return out


def _parts(schema: T.StructType, segment: int):
    """A mapInArrow function over sorted rows: a record per run of at most ``segment`` rows that may stay.

    A conversation that begins and ends inside the partition is searched once, from start to end. Where it
    may go on in the next partition, or is cut, its part is searched for every state before and behind it.
    """
    names = schema.names
    arrow = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = arrow or to_arrow_schema(schema)
        out: list[dict] = []
        conv, part, started = None, None, False

        def close(closing: bool) -> None:
            late, turn, role, digest = part.key
            row = {"conv_id": conv, "key": {"late": late, "turn": turn, "role": role, "digest": digest}, "ways": _ways(part, closing)}
            out.append(row | {c: getattr(part, c) for c in names if c not in row})

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "blank", "truncated", "later", "n")]
            for c, turn, role, digest, blank, truncated, later, n in zip(*cols, strict=True):
                if part is None or c != conv:
                    if part is not None:
                        close(True)
                    part, conv = Part(opening=started, key=(turn is not None, turn, role, digest)), c
                    started = True
                elif len(part.items) >= segment:
                    close(False)
                    part = Part(opening=False, key=(turn is not None, turn, role, digest))
                part.add(turn, role, blank, truncated, later, n)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if part is not None:
            close(False)
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return run


def joined(parts: list[dict]) -> dict:
    """The parts of one conversation, in order, as one: sums, what lies between neighbours, and the best way through."""
    at: dict[int, tuple[int, str]] = {START: (0, "")}
    sums = dict.fromkeys(("n_rows", "blank", "duplicate", "truncated", "illegal", "turns"), 0)
    first_turn = last_turn = last_code = None
    closed = False
    for p in parts:
        for k in sums:
            sums[k] += p[k]
        if p["n_rows"]:
            if last_code is not None:
                sums["illegal"] += (last_code, p["first_code"]) not in LEGAL
            last_code = p["last_code"]
        if p["turns"]:
            sums["turns"] -= last_turn is not None and p["first_turn"] == last_turn
            first_turn = p["first_turn"] if first_turn is None else first_turn
            last_turn = p["last_turn"]
        then: dict[int, tuple[int, str]] = {}
        for w in p["ways"]:
            if w["entry"] in at:
                c, a = at[w["entry"]]
                found = c + w["cost"], a + w["audit"]
                if w["leave"] not in then or found < then[w["leave"]]:
                    then[w["leave"]] = found
        at = then
    cost, audit = min(v for s, v in at.items() if s in ENDS)
    gaps = 0 if first_turn is None else last_turn - first_turn + 1 - sums["turns"]
    counts = {k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal")}
    return {"gaps": gaps if gaps <= _MOST else None, **counts, "cost": cost, "audit": audit}


def summaries(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text and, if there, copies):
    gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows are taken by turn (nulls first); at one turn by role, then by a digest. A row's first fault counts: blank, role and
    text seen earlier, or an end without a full stop, exclamation or question mark. ``illegal`` counts neighbours whose
    initials are not su, ua or au. The edits D(elete), I(nsert), K(eep) and R(elabel) turn the conversation into an optional
    system row and pairs of user and assistant at least ``cost``; ``audit`` is the least text of such edits.

    Rows with 0 copies are dropped; a conversation without any other has zeros and an empty audit.
    Null roles and texts are one blank; a null conv_id is a conversation. Gaps beyond a long are null. Other columns
    are ignored; an empty table gives no rows.

    Equal rows are added up before they are sorted. The order is cut into ranges by conversation and place, so a long
    conversation lies in several tasks; each part is searched for every state around it, and the parts are joined.
    """
    marked = settle(_faults(_keyed(rows)), "faults")
    late = F.col("turn").isNotNull()
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *_PART.fields])
    order = ["conv_id", late, "turn", "role", "digest"]
    parts = marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_parts(schema, segment), schema)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    out = T.StructType([schema["conv_id"], *[T.StructField(c, T.LongType()) for c in names[:-1]], T.StructField("audit", T.StringType())])

    def merge(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        parts = table.to_pylist()
        parts.sort(key=lambda p: (p["key"]["late"], p["key"]["turn"] or 0, p["key"]["role"].encode(), p["key"]["digest"]))
        return pa.Table.from_pylist([{"conv_id": parts[0]["conv_id"], **joined(parts)}], to_arrow_schema(out))

    return settle(settle(parts, "parts").groupBy("conv_id").applyInArrow(merge, out), "summaries")


def _edited(schema: T.StructType):
    """A mapInArrow function that follows each conversation's audit along its rows; it holds one audit at a time."""
    names = {START: "", SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        out: list[tuple] = []
        conv, audit, at, place, state = None, "", 0, 0, START

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place
            out.append((conv, place, edit, role, text))
            place += 1

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state, at = due(state), at + 1
                put("I", names[state], "")

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(cols, arrow, strict=True)], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text", "copies")]
            size = 0
            for c, kind, role, text, copies in zip(*cols, strict=True):
                if kind == 0:
                    inserted()
                    conv, audit, at, place, state = c, text, 0, 0, START
                    continue
                for _ in range(copies):
                    inserted()
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    state = code_of(role) if edit == "K" else due(state)
                    put(edit, role if edit == "K" else names[state], text)
                    size += len(text)
                if size > 1 << 22:
                    yield flush()
                    size = 0
            if out:
                yield flush()
        inserted()
        if out:
            yield flush()

    return run


def repaired(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """The conversations after the edits of ``summary``: conv_id, place (from 0), edit (K, R or I), role, text.

    Rows of one conversation come in one partition in order: audit and rows are sorted together, the audit first, and
    stream through a task that holds one audit and one batch. Conversations of which nothing stays have no row.
    """
    keyed = _keyed(rows).filter("copies > 0").withColumn("kind", F.lit(1))
    blank: dict[str, Column] = {"turn": F.lit(None).cast("bigint"), "role": F.lit(""), "copies": F.lit(0).cast("bigint"), "digest": F.lit(b""), "kind": F.lit(0)}
    audits = summary.select("conv_id", F.col("audit").alias("text")).withColumns(blank)
    both = audits.unionByName(keyed).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").isNotNull(), "turn", "role", "digest")
    schema = T.StructType([summary.schema["conv_id"]])
    schema = schema.add("place", "long").add("edit", "string").add("role", "string").add("text", "string")
    return both.mapInArrow(_edited(schema), schema)


def digests(edited: DataFrame) -> DataFrame:
    """conv_id and sha256 of the newline-joined "role:text" of ``repaired`` conversations, row after row."""
    schema = T.StructType([edited.schema["conv_id"]]).add("sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        conv, state, done = None, None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]
            for c, place, role, text in zip(*cols, strict=True):
                if place == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow.field(0).type), pa.array([state.hexdigest()])], schema=arrow)

    return edited.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``summaries`` with ``repaired_sha256`` of each conversation after its edits (of the empty text if nothing stays)."""
    summary = summaries(rows, segment)
    found = digests(repaired(rows, summary)).withColumnRenamed("conv_id", "_conv")
    both = summary.join(found, summary["conv_id"].eqNullSafe(found["_conv"]), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return both.select(*summary.columns, F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))


__all__ = ["damage", "repair", "repaired", "summaries"]
