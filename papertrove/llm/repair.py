"""Conversation structure repair by divide and conquer over four-state cost vectors.

A repaired conversation has the roles ``(s?(ua)+)?``. Four states say what has been written so far: nothing, a system
turn, a user turn, an assistant turn. The edits of a row (keep, rerole, delete, each after some inserts) lead from state
to state, and since a letter fixes the next state, an audit (the letters of all edits) fixes the repaired turns.

Hirschberg's scheme: a forward vector (cheapest way to every state, and the order of the least audits that cost so much)
meets a backward one (cheapest way to the end) in the middle; among the states that the cheapest audits cross, the one
with the least audit so far is chosen; both halves go on alone. Only vectors and crossings are kept, never a table of
rows by states. Audits to different states at a row's end are never prefixes of each other (both end with a row's letter
and have as many of those), so an order of the four is all that a comparison of longer ones needs.

A long conversation is cut into blocks over many tasks. A block's summary (costs from state to state, and the order of
its exits per entry) combines like the rows do, so the same scheme runs over summaries, level by level, to fix the
crossings between blocks, and then inside every block on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papertrove.llm.words import table
from papertrove.sources import stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
LEGAL = ("su", "ua", "au")
SPACES = "\x20\t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
#: Nothing written, or a system, user or assistant turn written last; a conversation may end in the first and the last.
STATES = EMPTY, SYSTEM, ASKED, ANSWERED = 0, 1, 2, 3
DONE = (EMPTY, ANSWERED)
#: Rows and bytes of text of one block; a single longer row is a block of its own.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
#: Block summaries that one task folds into the next level's.
FAN = 4096
_FAR = 1 << 60
_NEXT = {EMPTY: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
_WRITES = {ASKED: USER, ANSWERED: ASSISTANT}
_PLAIN, _TRUNCATED, _DOOMED = 0, 1, 2
_INITIALS = "sua"

#: A row or a block: per entry and exit the cost, and per entry the order of its exits by their least audits.
Item = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]


def _kept_state(state: int, initial: int) -> int | None:
    """The state after keeping a row with this role, or None where it can't stand."""
    if initial == 0:
        return SYSTEM if state == EMPTY else None
    if initial in (1, 2) and _NEXT[state] == initial + 1:
        return initial + 1
    return None


def _row_options(initial: int, fault: int) -> list[dict[int, tuple[int, str]]]:
    """Per entry state the cheapest, then least letters that end with this row, by exit state.

    No insert stands before a delete: behind it the cost is the same and the audit less. More than two inserts in a row
    come back to a state already passed.
    """
    found: list[dict[int, tuple[int, str]]] = []
    for entry in STATES:
        options = [(DELETE_COST, DELETE, entry)]
        state, cost, letters = entry, 0, ""
        for _ in range(3 if fault != _DOOMED else 0):
            kept = _kept_state(state, initial)
            extra = cost + (TRUNCATED_COST if fault == _TRUNCATED else 0)
            if kept is not None:
                options.append((extra, letters + KEEP, kept))
            options.append((extra + REROLE_COST, letters + REROLE, _NEXT[state]))
            state, cost, letters = _NEXT[state], cost + INSERT_COST, letters + INSERT
        best: dict[int, tuple[int, str]] = {}
        for spent, audit, leaves in options:
            if leaves not in best or (spent, audit) < best[leaves]:
                best[leaves] = spent, audit
        found.append(best)
    return found


def _order(keys: Sequence) -> tuple[int, ...]:
    """Places of the keys in their sorted order; None comes last."""
    ranked = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else ()))
    places = [0] * len(keys)
    for place, i in enumerate(ranked):
        places[i] = place
    return tuple(places)


def _row_item(options: list[dict[int, tuple[int, str]]]) -> Item:
    costs = tuple(tuple(best[b][0] if b in best else _FAR for b in STATES) for best in options)
    return costs, tuple(_order([best[b][1] if b in best else None for b in STATES]) for best in options)


#: By kind of row: 3 * role (system, user, assistant, other) + fault (none, truncated, must go).
ROW_OPTIONS = [_row_options(initial, fault) for initial in range(4) for fault in (_PLAIN, _TRUNCATED, _DOOMED)]
ROW_ITEMS = [_row_item(options) for options in ROW_OPTIONS]
#: Inserts that finish a conversation, by state.
ENDINGS = {EMPTY: "", SYSTEM: INSERT * 2, ASKED: INSERT, ANSWERED: ""}


def joined(left: Item, right: Item) -> Item:
    """The summary of two neighbours."""
    costs, orders = [], []
    for a in STATES:
        row, keys = [], []
        for c in STATES:
            cost, place, b = min((left[0][a][b] + right[0][b][c], left[1][a][b], b) for b in STATES)
            row.append(min(cost, _FAR))
            keys.append((place, right[1][b][c]) if cost < _FAR else None)
        costs.append(tuple(row))
        orders.append(_order(keys))
    return tuple(costs), tuple(orders)


def _forward(items: Sequence[Item], entry: int) -> tuple[list[int], Sequence[int]]:
    """Cost of the cheapest way to every state, and the order of the least audits among those ways."""
    costs, places = [0 if s == entry else _FAR for s in STATES], (0, 0, 0, 0)
    for step, order in items:
        moved, keys = [], []
        for c in STATES:
            cost, place, b = min((costs[b] + step[b][c], places[b], b) for b in STATES)
            moved.append(min(cost, _FAR))
            keys.append((place, order[b][c]) if cost < _FAR else None)
        costs, places = moved, _order(keys)
    return costs, places


def _backward(items: Sequence[Item], leaving: int) -> list[int]:
    """Cost of the cheapest way from every state to ``leaving``."""
    costs = [0 if s == leaving else _FAR for s in STATES]
    for step, _ in reversed(items):
        costs = [min(min(step[b][c] + costs[c] for c in STATES), _FAR) for b in STATES]
    return costs


def crossings(items: Sequence[Item], entry: int, leaving: int) -> list[int]:
    """The states before, between and after the items on the cheapest way, the one with the least audit among ties."""
    states = [entry] + [leaving] * len(items)
    open_parts = [(0, len(items))]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        before, places = _forward(items[low:middle], states[low])
        after = _backward(items[middle:high], states[high])
        states[middle] = min(STATES, key=lambda s: (before[s] + after[s], places[s]))
        open_parts += [(low, middle), (middle, high)]
    return states


def last_state(costs: Sequence[int], places: Sequence[int]) -> int:
    """The state in which the rows of a conversation end, before the inserts that finish it."""
    return min(STATES, key=lambda s: (costs[s] + INSERT_COST * len(ENDINGS[s]), places[s]))


def repaired(roles: Sequence[str], texts: Sequence[str], kinds: bytes, copies: Sequence[int], entry: int, leaving: int):
    """Audit, cost and repaired ``(role, text)`` of rows that lead from one state to another.

    ``copies`` counts how often a row stands there; all but the first must go.
    """
    items = [ROW_ITEMS[kind] for kind in kinds]
    states = crossings(items, entry, leaving)
    audit, cost, turns = [], 0, []
    for i, kind in enumerate(kinds):
        spent, letters = ROW_OPTIONS[kind][states[i]][states[i + 1]]
        more = copies[i] - 1
        cost += spent + DELETE_COST * more
        audit += [letters, DELETE * more]
        state = states[i]
        for letter in letters:
            if letter == DELETE:
                continue
            state = _NEXT[state] if letter != KEEP else states[i + 1]
            if letter == INSERT:
                turns.append((_WRITES[state], ""))
            else:
                turns.append((roles[i] if letter == KEEP else _WRITES[state], texts[i]))
    return "".join(audit), cost, turns


def ending(state: int) -> list[str]:
    """Roles of the empty turns that finish a conversation."""
    out = []
    for _ in ENDINGS[state]:
        state = _NEXT[state]
        out.append(_WRITES[state])
    return out


# Rows with their faults, in order, as blocks


def with_faults(conversations: DataFrame) -> DataFrame:
    """Distinct rows with how often they stand there (``copies``), their place in a turn (``digest``) and their kind.

    Equal rows are counted before they are shuffled. Whether role and text were seen in an earlier turn comes from one
    small row per role and text, so neither a hot conversation nor a hot text is gathered.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    counted = counted.withColumn("digest", F.sha2("text", 256))
    firsts = counted.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("first_turn"), F.bool_or(F.col("turn").isNull()).alias("before_all")
    )
    a, b = counted.alias("a"), firsts.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    same = same & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    seen = F.col("a.turn").isNotNull() & (F.col("before_all") | (F.col("a.turn") > F.col("first_turn")))
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(shown == "", F.lit("blank"))
        .when(F.col("seen"), F.lit("duplicate"))
        .when(~F.right(shown, F.lit(1)).isin(*SENTENCE_ENDS), F.lit("truncated"))
    )
    joined_rows = a.join(b, same).select("a.*", seen.alias("seen"))
    return joined_rows.select("conv_id", "turn", "role", "text", "digest", "copies", fault.alias("fault"))


_BLOCK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("place", pa.int64()),
        ("alone", pa.bool_()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("kinds", pa.binary()),
        ("copies", pa.list_(pa.int64())),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("illegal", pa.int64()),
        ("first_turn", pa.int64()),
        ("last_turn", pa.int64()),
        ("turns", pa.int64()),
        ("summary", pa.list_(pa.int64())),
    ]
)
_BLOCK_SQL = (
    "conv_id long, part int, place long, alone boolean, roles array<string>, texts array<string>, kinds binary, "
    "copies array<long>, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, "
    "turns long, summary array<long>"
)


def _initial(role: str) -> int:
    return _INITIALS.find(role[0]) % 4 if role else 3


def _pair(before: str, after: str) -> bool:
    """True when two neighbouring roles can't follow each other."""
    return before[:1] + after[:1] not in LEGAL


def _flat(item: Item) -> list[int]:
    return [value for half in item for row in half for value in row]


def _item(flat: Sequence[int]) -> Item:
    rows = [tuple(flat[i : i + 4]) for i in range(0, 32, 4)]
    return tuple(rows[:4]), tuple(rows[4:])


def _fold(items: Iterator[Item]) -> Item:
    """The summary of neighbours in a row."""
    total = next(items)
    for item in items:
        total = joined(total, item)
    return total


def _block(rows: list[dict], part: int, place: int, alone: bool) -> dict:
    kinds = bytearray()
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    illegal = 0
    for i, row in enumerate(rows):
        fault, more = row["fault"], row["copies"] - 1
        doomed = _DOOMED if fault in ("blank", "duplicate") else _TRUNCATED if fault == "truncated" else _PLAIN
        kinds.append(3 * _initial(row["role"]) + doomed)
        if fault:
            counts[fault] += 1
        counts["blank" if fault == "blank" else "duplicate"] += more
        illegal += more + (i > 0 and _pair(rows[i - 1]["role"], row["role"]))
    turns = [row["turn"] for row in rows if row["turn"] is not None]
    return {
        "conv_id": rows[0]["conv_id"],
        "part": part,
        "place": place,
        "alone": alone,
        "roles": [row["role"] for row in rows],
        "texts": [row["text"] for row in rows],
        "kinds": bytes(kinds),
        "copies": [row["copies"] for row in rows],
        **counts,
        "illegal": illegal,
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "turns": len(set(turns)),
        "summary": None if alone else _flat(_fold(ROW_ITEMS[kind] for kind in kinds)),
    }


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows. One that may go on in another block or task is not ``alone`` and has a summary."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held: list[dict] = []
    out: list[dict] = []
    weight = place = pending = 0
    inside = False  # the held rows go on an earlier block, or one that another task may hold

    def cut(more: bool) -> None:
        nonlocal held, weight, place, inside
        out.append(_block(held, part, place, not (inside or more or place == 0)))
        held, weight, place, inside = [], 0, place + 1, more

    for batch in batches:
        for row in batch.to_pylist():
            size = len(row["text"])
            if held and row["conv_id"] != held[0]["conv_id"]:
                cut(False)
            elif held and (len(held) >= BLOCK_ROWS or weight + size > BLOCK_BYTES):
                cut(True)
            held.append(row)
            weight += size
            pending += size
            if pending > BLOCK_BYTES and out:
                yield _batch(_BLOCK, out)
                out, pending = [], 0
    if held:
        cut(True)
    if out:
        yield _batch(_BLOCK, out)


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return table(schema, **{name: [row[name] for row in rows] for name in schema.names})


# Crossings between blocks, by levels of summaries

_GROUP = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("parts", pa.list_(pa.int32())),
                    ("places", pa.list_(pa.int64())), ("summaries", pa.list_(pa.list_(pa.int64()))),
                    ("summary", pa.list_(pa.int64()))])
_GROUP_SQL = (
    "conv_id long, part int, place long, parts array<int>, places array<long>, summaries array<array<long>>, "
    "summary array<long>"
)
_CROSSED = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("entry", pa.int32()),
                      ("leaving", pa.int32())])
_CROSSED_SQL = "conv_id long, part int, place long, entry int, leaving int"


def _to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of one group after the other, and what they come to."""
    held: list[dict] = []

    def cut() -> pa.RecordBatch:
        summaries = [row["summary"] for row in held]
        group = {
            "conv_id": held[0]["conv_id"],
            "part": 0,
            "place": held[0]["bucket"],
            "parts": [row["part"] for row in held],
            "places": [row["place"] for row in held],
            "summaries": summaries,
            "summary": _flat(_fold(map(_item, summaries))),
        }
        return _batch(_GROUP, [group])

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv_id"], row["bucket"]) != (held[0]["conv_id"], held[0]["bucket"]):
                yield cut()
                held = []
            held.append(row)
    if held:
        yield cut()


def _to_crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry and exit state of every member of a group, from those of the group; a whole conversation starts empty."""
    for batch in batches:
        for row in batch.to_pylist():
            items = [_item(flat) for flat in row["summaries"]]
            entry, leaving = row["entry"], row["leaving"]
            if entry is None:
                entry, leaving = EMPTY, last_state(*_forward(items, EMPTY))
            states = crossings(items, entry, leaving)
            yield table(
                _CROSSED,
                conv_id=[row["conv_id"]] * len(items),
                part=row["parts"],
                place=row["places"],
                entry=states[:-1],
                leaving=states[1:],
            )


def _block_states(blocks: DataFrame) -> DataFrame:
    """Entry and exit state of all blocks that are not alone.

    Upwards, a level has one row per ``FAN`` neighbours of a conversation, until every conversation is one row; its rows
    are numbered by a window over summaries only, one per ``BLOCK_ROWS`` rows or fewer. Downwards, each level fixes the
    crossings inside its groups.
    """
    levels = []
    level = blocks.where(~F.col("alone")).select("conv_id", "part", "place", "summary")
    while True:
        number = F.row_number().over(Window.partitionBy("conv_id").orderBy("part", "place"))
        bucket = F.floor((number - 1) / F.lit(FAN)).cast("long")
        dealt = level.withColumn("bucket", bucket).repartition("conv_id", "bucket")
        ordered = dealt.sortWithinPartitions("conv_id", "bucket", "part", "place")
        levels.append(stage(ordered.mapInArrow(_to_groups, _GROUP_SQL), "repair-groups"))
        level = levels[-1].select("conv_id", "part", "place", "summary")
        if not (levels[-1].agg(F.max("place")).first()[0] or 0):
            break
    none = F.lit(None).cast("int")
    top = levels.pop().withColumns({"entry": none, "leaving": none})
    states = stage(top.mapInArrow(_to_crossings, _CROSSED_SQL), "repair-crossings")
    for groups in reversed(levels):
        known = _with_states(groups, states)
        states = stage(known.mapInArrow(_to_crossings, _CROSSED_SQL), "repair-crossings")
    return states


def _with_states(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Rows with the states of their block or group; null where there are none."""
    a, b = rows.alias("a"), states.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    same = same & (F.col("a.part") == F.col("b.part")) & (F.col("a.place") == F.col("b.place"))
    return a.join(b, same, "left").select("a.*", "b.entry", "b.leaving")


# Audits and texts of blocks, and of whole conversations

_PIECE = pa.schema(
    [
        *[(name, pa.int64()) for name in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[(name, pa.int64()) for name in ("first_turn", "last_turn", "turns", "place")],
        ("part", pa.int32()),
        *[(name, pa.string()) for name in ("first_role", "last_role", "audit")],
        ("leaving", pa.int32()),
        ("written", pa.list_(pa.string())),
    ]
)
_PIECE_SQL = (
    "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, first_turn long, last_turn long, "
    "turns long, place long, part int, first_role string, last_role string, audit string, leaving int, written array<string>"
)


def _to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            entry, leaving = row["entry"], row["leaving"]
            if entry is None:
                items = [ROW_ITEMS[kind] for kind in row["kinds"]]
                entry, leaving = EMPTY, last_state(*_forward(items, EMPTY))
            audit, cost, turns = repaired(row["roles"], row["texts"], row["kinds"], row["copies"], entry, leaving)
            ends = {"first_role": row["roles"][0], "last_role": row["roles"][-1], "audit": audit, "cost": cost}
            written = [f"{role}:{text}" for role, text in turns]
            out.append(row | ends | {"leaving": leaving, "written": written})
        if out:
            yield _batch(_PIECE, out)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = pa.schema(
    [("conv_id", pa.int64()), *[(name, pa.int64()) for name in _COUNTS], ("audit", pa.string()),
     ("repaired_sha256", pa.string()), ("n_repaired", pa.int64())]
)
_RESULT_SQL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_repaired long"
)


class _Conversation:
    """Adds up the pieces of one conversation; of its texts only the running hash is kept."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.written = self.turns = 0
        self.first_turn = self.last_turn = self.last_role = None
        self.state = EMPTY

    def write(self, line: str) -> None:
        self.hash.update(("\n" * (self.written > 0) + line).encode())
        self.written += 1

    def add(self, piece: dict) -> None:
        for name in self.sums:
            self.sums[name] += piece[name]
        if self.last_role is not None:
            self.sums["illegal"] += _pair(self.last_role, piece["first_role"])
        if piece["turns"]:
            self.turns += piece["turns"] - (piece["first_turn"] == self.last_turn)
            self.first_turn = piece["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = piece["last_turn"]
        self.last_role, self.state = piece["last_role"], piece["leaving"]
        self.audit.append(piece["audit"])
        for line in piece["written"]:
            self.write(line)

    def result(self) -> dict:
        for role in ending(self.state):
            self.write(f"{role}:")
        more = ENDINGS[self.state]
        self.sums["cost"] += INSERT_COST * len(more)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv_id,
            "gaps": gaps,
            **self.sums,
            "audit": "".join(self.audit) + more,
            "repaired_sha256": self.hash.hexdigest(),
            "n_repaired": self.written,
        }


def _to_results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    out: list[dict] = []
    for batch in batches:
        for piece in batch.to_pylist():
            if current is None or piece["conv_id"] != current.conv_id:
                if current is not None:
                    out.append(current.result())
                current = _Conversation(piece["conv_id"])
            current.add(piece)
        if out:
            yield _batch(_RESULT, out)
            out = []
    if current is not None:
        yield _batch(_RESULT, [current.result()])


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair as an audit of letters, and what it comes to.

    ``conversations`` has ``conv_id, turn, role, text``; other columns do not matter. Rows are taken by ``turn`` (null
    first), then role and the digest of the text; null roles and texts count as one space; rows with a null ``conv_id``
    form one conversation. Faults (the first counts): blank, duplicate (role and text seen earlier), truncated (the text
    does not end with ``.!?``). Keeping a row is free, a new role costs 3, deleting 4 (a must for blank and duplicate
    rows), inserting an empty turn 3, and every truncated row that stays 3. Ties go to the least audit. An empty table
    gives no rows. A conversation of any length is cut into blocks; only its hash, which is sequential by definition,
    and its audit, one letter per row, run through one task, as a stream.
    """
    keys = "conv_id", "turn", "role", "digest"
    ordered = with_faults(conversations).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = ordered.select("conv_id", "turn", "role", "text", "copies", "fault")
    blocks = stage(rows.mapInArrow(_to_blocks, _BLOCK_SQL), "repair-blocks")
    solved = _with_states(blocks.drop("summary"), _block_states(blocks)).mapInArrow(_to_pieces, _PIECE_SQL)
    streamed = solved.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return streamed.mapInArrow(_to_results, _RESULT_SQL)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the checksum of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's.
    """
    spaced = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.encode(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]), "UTF-8")) % 20
    marked = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), spaced["role"].alias("role"),
        spaced["text"].alias("text"), fault.alias("fault"),
    )
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", SENTENCE_ENDS, ""))
    role = F.when(F.col("fault") == 4, F.lit(USER)).otherwise(F.col("role"))
    times: Column = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    copied = marked.select(
        "conv_id", "turn", role.alias("role"), text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("copy"),
    )
    return copied.drop("copy")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """A repair of the damaged conversations for every ``conv_id`` there is; zeros and empty where no row is left."""
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    found = repair_conversations(damaged(conversations)).drop("n_repaired").withColumnRenamed("conv_id", "found_id")
    both = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    nothing = hashlib.sha256().hexdigest()
    counts = [F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in _COUNTS]
    audit = F.coalesce(F.col("audit"), F.lit("")).alias("audit")
    return both.select("conv_id", *counts, audit, F.coalesce(F.col("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"))
