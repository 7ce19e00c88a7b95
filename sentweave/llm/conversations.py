"""Repair of conversations' structure: the cheapest edits after which the roles run ``(s?(ua)+)?``, by Dial's shortest paths.

A node is a number of rows done and a state of the role pattern; an arc keeps, reroles or deletes the next row or inserts a
turn. Costs are small integers, so a ring of buckets serves as the queue; distances to the goal are recorded and a walk
from the start takes, among the arcs that lie on a shortest path, the one whose initial is least.

Edits are found from one byte a row, without texts. The texts are then sorted to their conversations behind the found
audit and pass through as a stream. Of one conversation a task holds about 20 bytes a row (its audit, one cell, has one) and no texts.
"""

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
RING = 1 + max(REROLE + UNFINISHED, DELETE, INSERT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a turn of this initial leads to, and the one that an inserted or reroled turn leads to.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE_UP = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
INITIALS, FINE, GONE, CUT = "sua", 0, 1, 2
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def arcs(code: int) -> list[tuple[int, int, str, int]]:
    """``(from, to, initial, cost)`` over a row whose code is its initial's place (3: another) and four times its fault."""
    initial, fault = (INITIALS + "?")[code % 4], code // 4
    found = [(s, s, "D", DELETE) for s in range(4)]
    if fault != GONE:
        more = UNFINISHED if fault == CUT else 0
        found += [(s, t, "K", KEEP + more) for (s, i), t in AFTER.items() if i == initial]
        found += [(s, t, "R", REROLE + more) for s, t in MADE_UP.items()]
    return found


#: By code and state: arcs that lead into it (with where from and the cost), and arcs that lead out, least initial first.
INTO = [[[(s, cost) for s, t, _, cost in arcs(c) if t == state] for state in range(4)] for c in range(12)]
OUT = [[sorted((e, t, cost) for s, t, e, cost in arcs(c) if s == state) for state in range(4)] for c in range(12)]
INSERTS_INTO = [[s for s, t in MADE_UP.items() if t == state] for state in range(4)]


def distances(codes: bytes) -> array:
    """Least cost from each node (4 x rows done + state) to the goal, -1 where it is more than the start's."""
    far, ring = array("i", [-1]) * (4 * len(codes) + 4), [[] for _ in range(RING)]
    ring[0] = [4 * len(codes) + s for s in ENDS]
    cost = 0
    while far[START] < 0:
        bucket = ring[cost % RING]
        for node in bucket:  # grows by arcs that cost nothing
            if far[node] >= 0:
                continue
            far[node] = cost
            done, state = divmod(node, 4)
            for s in INSERTS_INTO[state]:
                ring[(cost + INSERT) % RING].append(4 * done + s)
            if done:
                for s, more in INTO[codes[done - 1]][state]:
                    ring[(cost + more) % RING].append(4 * done - 4 + s)
        bucket.clear()
        cost += 1
    return far


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit: the ASCII-least initials among the cheapest edits."""
    far, done, state, audit = distances(codes), 0, START, bytearray()
    left = far[START]
    while done < len(codes) or state not in ENDS or left:
        steps = [(e, done + 1, t, cost) for e, t, cost in OUT[codes[done]][state]] if done < len(codes) else []
        steps.append(("I", done, MADE_UP[state], INSERT))
        e, done, state, cost = min(x for x in steps if 0 <= far[4 * x[1] + x[2]] == left - x[3])
        left -= cost
        audit += e.encode()
    return far[START], audit.decode()


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of each turn after the edits; deleted ones are passed over."""
    state = START
    for e in audit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        state = AFTER[state, role[:1]] if e == "K" else MADE_UP[state]
        yield e, role if e == "K" else ROLES[state], text


# ---- rows ----


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with every twentieth row dropped, emptied, without its stops, repeated or given to the user.

    What happens is told by the checksum of ``conv_id:turn``. A null in that, in role or in text is one space; a null id or turn stays.
    """
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", own("role").alias("role"), own("text").alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return marked.filter("kind <> 0").withColumn("time", F.explode(times)).select("conv_id", "turn", role.alias("role"), text.alias("text"))


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with two hashes of role and text; these, the turn and the role give an order that every run repeats."""
    clean = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    return clean.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(7), "text", "role")})


def _order() -> list:
    return [F.asc_nulls_first("turn"), "role", "h1", "h2"]


def _by_conversation(rows: DataFrame, *order) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)


def coded(turns: DataFrame) -> DataFrame:
    """A row for each turn with its initial's place and its first fault: blank, duplicate (role and text seen earlier) or truncated."""
    space = "[\\x20\\x09-\\x0D]"
    said = _keyed(turns)
    light = said.select(
        "conv_id", "turn", "role", "h1", "h2",
        F.coalesce(F.expr("nullif(position(left(role, 1), 'sua'), 0)"), F.lit(4)).cast("int").alias("place"),
        F.col("text").rlike(f"\\A{space}*\\z").alias("empty"), (~F.col("text").rlike(f"[.!?]{space}*\\z")).alias("open"),
    )
    light = light.withColumn("place", F.when(F.length("role") == 0, 4).otherwise(F.col("place")))
    seen = F.row_number().over(Window.partitionBy("conv_id", "h1", "h2").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(F.col("empty"), 1).when(F.col("seen"), 2).when(F.col("open"), 3).otherwise(0)
    return light.withColumn("seen", seen).select("conv_id", "turn", "role", "h1", "h2", "seen", (F.col("place") - 1 + 4 * fault).alias("code"))


class _Conversation:
    """What the turns of a conversation, in order, have told so far."""

    def __init__(self, conv_id):
        self.conv_id, self.codes = conv_id, bytearray()
        self.first = self.last = None
        self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.before = ""

    def add(self, turn: int | None, code: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        fault, initial = code // 4, (INITIALS + "?")[code % 4]
        self.faults[fault] += 1
        self.illegal += bool(self.before) and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.codes.append(code % 4 + 4 * (0, GONE, GONE, CUT)[fault])

    def row(self) -> tuple:
        cost, audit = cheapest(bytes(self.codes))
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], int(self.illegal), cost, audit)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    held = 0
    for r in rows:
        some.append(r)
        held += 100 + sum(len(x) for x in r if isinstance(x, str))
        if len(some) >= size or held > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def audits(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id``, the counts ``gaps, blank, duplicate, truncated, illegal``, ``cost`` and ``audit`` of each conversation.

    Conversations of ``ids`` that have no turns are there too, with zeros and an empty audit. Nulls in role and text count as a space, null turns come first
    and leave no gap, a null conversation is one; turns of one number go by role and text; an empty table gives an empty result.
    """
    light = coded(turns)
    if ids is not None:
        named = ids.select("conv_id").distinct()
        light = light.unionByName(named, allowMissingColumns=True)
    id_type = light.schema["conv_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def found() -> Iterator[tuple]:
            nonlocal schema
            now = None
            for batch in batches:
                schema = schema or pa.schema([("conv_id", batch.schema.field(0).type), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
                for conv_id, turn, code in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    if now is None or conv_id != now.conv_id:
                        if now is not None:
                            yield now.row()
                        now = _Conversation(conv_id)
                    if code is not None:
                        now.add(turn, code)
            if now is not None:
                yield now.row()

        rows = found()
        first = next(rows, None)
        if first is not None:
            yield from _batches((r for part in ([first], rows) for r in part), schema)

    rows = _by_conversation(light, *_order(), "seen").select("conv_id", "turn", "code")
    return rows.mapInArrow(judge, f"conv_id {id_type}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string")


def _streamed(turns: DataFrame, judged: DataFrame) -> DataFrame:
    """Each conversation's row of ``judged`` and after it its turns in order, in one task."""
    said = _keyed(turns).unionByName(judged, allowMissingColumns=True)
    return _by_conversation(said, F.asc(F.col("audit").isNull()), *_order()).select("conv_id", *COUNTS, "audit", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(row of judged, its edited turns)`` from streamed rows; the turns must be used up before the next one is asked for."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for head in rows:
        yield head[:-2], edited(head[-3], (r[-2:] for r in rows))


def _written(turns: DataFrame, judged: DataFrame, make, schema: str) -> DataFrame:
    """The rows that ``make`` gives for each conversation and its edited turns."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            every = (b for part in ([first], batches) for b in part)
            fields = [("", first.schema.field(0).type), *(("", kinds[c.split(" ")[1]]) for c in schema.split(", "))]
            names = ["conv_id", *(c.split(" ")[0] for c in schema.split(", "))]
            yield from _batches((r for c, said in _conversations(every) for r in make(c, said)), pa.schema([(n, f[1]) for n, f in zip(names, fields, strict=True)]))

    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return _streamed(turns, judged).mapInArrow(write, f"conv_id {judged.schema['conv_id'].dataType.simpleString()}, {schema}")


def repaired(turns: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """The turns of every conversation after its cheapest edits: ``conv_id, place, edit, role, text``; cases as in ``audits``."""
    make = lambda head, said: ((head[0], i, *t) for i, t in enumerate(said))
    return _written(turns, audits(turns) if judged is None else judged, make, "place bigint, edit string, role string, text string")


def digests(turns: DataFrame, judged: DataFrame) -> DataFrame:
    """``judged`` with ``repaired_sha256``, the digest of each conversation's ``role:text``, joined by line feeds."""

    def make(head: tuple, said: Iterator[tuple]) -> Iterator[tuple]:
        h, mark = hashlib.sha256(), ""
        for _, role, text in said:
            h.update(f"{mark}{role}:{text}".encode())
            mark = "\n"
        yield (*head, h.hexdigest())

    return _written(turns, judged, make, f"{', '.join(f'{c} bigint' for c in COUNTS)}, audit string, repaired_sha256 string")
