"""Conversation structure repair: the cheapest edits that make roles alternate.

After repair the roles of a conversation are an optional system turn and then pairs of user and
assistant, or there are no turns. Among the cheapest repairs the one whose edits come first in
ASCII order is taken.

Both demands are one minimum over whole numbers. A repair's weight holds its cost in the high
digits and its edits' letters, first edit first, in a fixed number of low digits; unused digits at
the end are zero. An edit at place p of a width w adds `cost * BASE**w + letter * BASE**(w-1-p)`,
so the least weight at the end of the graph of (rows read, role state) is the answer. Repairs that
meet in a node have read the same rows, so at equal cost none is the beginning of another.

A conversation may hold a third of all rows. Its rows are sorted over many tasks; each task
solves runs of at most `run_rows` rows from all states, and the runs' solutions are then joined
like edges of the same graph.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
# Digits of the edits' letters, in ASCII order; zero is the padding at the end.
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
BY_DIGIT = {digit: letter for letter, digit in LETTERS.items()}
BITS = 3
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# States: nothing kept yet, a system turn, a user turn last, an assistant turn last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ENDS = (EMPTY, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Codes of rows: the role's initial, u a s or o for any other; upper case where the text is
# truncated; x where the row has to go.
GONE = "x"

PLACE = ("conv_id", "turn", "role", "mark")
COUNTED = ("blank", "duplicate", "truncated", "illegal")
LONG, TEXT = pa.int64(), pa.string()
RUN = [
    ("turn", LONG), ("role", TEXT), ("mark", pa.binary()), ("no", LONG), ("codes", TEXT), ("first_turn", LONG), ("last_turn", LONG),
    ("turns", LONG), *((name, LONG) for name in COUNTED), ("head", TEXT), ("tail", TEXT),
    ("edges", pa.list_(pa.struct([("a", LONG), ("b", LONG), ("cost", LONG), ("audit", TEXT)]))),
]
REPORT = [("gaps", LONG), *((name, LONG) for name in COUNTED), ("cost", LONG), ("audit", TEXT), ("repaired_sha256", TEXT)]
TURN = [("position", LONG), ("edit", TEXT), ("role", TEXT), ("text", TEXT)]


def _with_key(key: T.DataType, fields: list) -> T.StructType:
    """The fields as Spark's types behind a conv_id of the table's own type."""
    plain = {LONG: T.LongType(), TEXT: T.StringType(), pa.binary(): T.BinaryType()}
    edges = T.ArrayType(T.StructType([T.StructField(n, plain[k]) for n, k in (("a", LONG), ("b", LONG), ("cost", LONG), ("audit", TEXT))]))
    return T.StructType([T.StructField("conv_id", key), *(T.StructField(n, plain.get(k, edges)) for n, k in fields)])


# ---- the graph ----


class Weights:
    """Whole-number weights of repairs whose edits number at most `width`."""

    def __init__(self, width: int):
        self.width = width
        self.shift = BITS * width

    def edit(self, cost: int, letter: str, place: int) -> int:
        return (cost << self.shift) + (LETTERS[letter] << BITS * (self.width - 1 - place))

    def pack(self, cost: int, audit: str) -> int:
        return (cost << self.shift) + sum(LETTERS[x] << BITS * (self.width - 1 - p) for p, x in enumerate(audit))

    def unpack(self, weight: int) -> tuple[int, str]:
        audit = []
        for place in range(self.width):
            digit = weight >> BITS * (self.width - 1 - place) & (1 << BITS) - 1
            if not digit:
                break
            audit.append(BY_DIGIT[digit])
        return weight >> self.shift, "".join(audit)


def _inserted(nodes: dict, weights: Weights) -> None:
    """Lets an empty user or assistant turn be put in behind each node."""
    for state in (EMPTY, SYSTEM, ASSISTANT, USER):
        if state in nodes:
            weight, place = nodes[state]
            offered = (weight + weights.edit(INSERT, "I", place), place + 1)
            nodes[AFTER[state]] = min(nodes.get(AFTER[state], offered), offered)


def _step(nodes: dict, code: str, weights: Weights) -> dict:
    """The nodes behind one row."""
    out: dict[int, tuple[int, int]] = {}

    def offer(state: int, weight: int, place: int) -> None:
        out[state] = min(out.get(state, (weight, place)), (weight, place))

    late = TRUNCATED if code.isupper() else 0
    for state, (weight, place) in nodes.items():
        offer(state, weight + weights.edit(DELETE, "D", place), place + 1)
        if code == GONE:
            continue
        role = code.lower()
        after = AFTER[state]
        if role == ROLES[after][0]:
            offer(after, weight + weights.edit(late, "K", place), place + 1)
        elif role == "s" and state == EMPTY:
            offer(SYSTEM, weight + weights.edit(late, "K", place), place + 1)
        offer(after, weight + weights.edit(REROLE + late, "R", place), place + 1)
    return out


@lru_cache(maxsize=50_000)
def solve(codes: str, start: int = EMPTY) -> dict[int, tuple[int, str]]:
    """{state: (cost, audit)} behind a run of rows that is entered in `start`."""
    # Two inserts at most stand before a row and at the end: a third leads back to a cheaper node.
    weights = Weights(3 * len(codes) + 2)
    nodes = {start: (0, 0)}
    for code in codes:
        _inserted(nodes, weights)
        nodes = _step(nodes, code, weights)
    _inserted(nodes, weights)
    return {state: weights.unpack(weight) for state, (weight, _) in sorted(nodes.items())}


class Joined:
    """Joins runs into one repair. The audits so far are compared by a few digits only: where none
    is the beginning of another their ranks say all, else the rest, which are inserts, is kept."""

    def __init__(self):
        # state: (cost, stand-in of the audit so far)
        self.nodes: dict[int, tuple[int, str]] = {EMPTY: (0, "")}
        self.back: list[dict[int, tuple[int, str]]] = []

    def add(self, edges: list[tuple[int, int, int, str]]) -> None:
        widest = max(len(self.nodes[a][1]) + len(audit) for a, _, _, audit in edges if a in self.nodes)
        weights = Weights(widest + 1)
        best: dict[int, tuple[int, int, str]] = {}
        for a, b, cost, audit in edges:
            if a in self.nodes:
                so_far, stand_in = self.nodes[a]
                found = (weights.pack(so_far + cost, stand_in + audit), a, audit)
                best[b] = min(best.get(b, found), found)
        self.back.append({b: (a, audit) for b, (_, a, audit) in best.items()})
        whole = {b: weights.unpack(weight) for b, (weight, _, _) in best.items()}
        ranked: dict[int, tuple[int, str]] = {}
        base, rank = None, 0
        for b, (cost, audit) in sorted(whole.items(), key=lambda x: x[1][1]):
            rest = None if base is None or not audit.startswith(base) else audit[len(base) :]
            if rest is None or rest.strip("I"):
                base, rest, rank = audit, "", rank + 1
            ranked[b] = (cost, BY_DIGIT[rank] + rest)
        self.nodes = ranked

    def result(self) -> tuple[int, list[str]]:
        """(cost, audit of each run)."""
        weights = Weights(max((len(s) for _, s in self.nodes.values()), default=0) + 1)
        state = min((s for s in ENDS if s in self.nodes), key=lambda s: weights.pack(*self.nodes[s]))
        cost, audits = self.nodes[state][0], []
        for step in reversed(self.back):
            state, audit = step[state]
            audits.append(audit)
        return cost, audits[::-1]


def live_edits(codes: str, audit: str) -> str:
    """The audit without the deletes of rows that had to go."""
    out, at = [], 0
    for letter in audit:
        if letter != "I":
            at += 1
            if codes[at - 1] == GONE:
                continue
        out.append(letter)
    return "".join(out)


# ---- rows ----


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(`conv_id:turn`) % 20. A dropped
    row has no copy, a repeated one two. Nulls of role and text are one space."""
    number = F.crc32(F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(number == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(number == 1, F.lit("")).when(number == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(number == 0, 0).when(number == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _initial(role: Column) -> Column:
    return F.when(role.startswith("u"), "u").when(role.startswith("a"), "a").when(role.startswith("s"), "s").otherwise("o")


def _code(text: Column, role: Column) -> Column:
    """A row's code but for repeats."""
    left = F.rtrim(text, F.lit(BLANKS))
    ended = F.substring(left, -1, 1).isin(".", "!", "?")
    return F.when(left == "", GONE).when(ended, _initial(role)).otherwise(F.upper(_initial(role)))


def _mark(text: Column) -> Column:
    return F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b""))


def _first_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, role, text, turn, mark): the first turn of each role and text that is not blank,
    null before all others."""
    grouped = rows.where((F.col("copies") > 0) & (F.rtrim("text", F.lit(BLANKS)) != "")).groupBy("conv_id", "role", "text").agg(
        F.min("turn").alias("turn"), F.max(F.col("turn").isNull().cast("int")).alias("unnumbered")
    )
    turn = F.when(F.col("unnumbered") == 0, F.col("turn"))
    return grouped.select("conv_id", "role", "text", turn.alias("turn"), _mark(F.col("text")).alias("mark"))


def _coded(rows: DataFrame, first: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, code, copies, seen): a row per different row, its text as a
    SHA-256. `seen`: an earlier turn has the role and the text too."""
    lean = rows.select(
        "conv_id", "turn", "role", _mark(F.col("text")).alias("mark"), _code(F.col("text"), F.col("role")).alias("code"), "copies",
    ).groupBy("conv_id", "turn", "role", "mark", "code").agg(F.sum("copies").alias("copies"))
    first = first.select(*(F.col(name).alias(f"_{name}") for name in ("conv_id", "role", "mark", "turn")))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    joined = lean.join(first, same, "left").withColumn("seen", ~F.col("turn").eqNullSafe(F.col("_turn")))
    return joined.select("conv_id", "turn", "role", "mark", "code", "copies", "seen")


def legal(before: str, after: str) -> bool:
    """Whether roles with these initials may stand next to each other."""
    return before + after in ("su", "ua", "au")


class Run:
    """Consecutive rows of a conversation, at first without any."""

    def __init__(self, row: dict):
        self.place = {name: row[name] for name in PLACE}
        self.codes = ""
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.tail = ""

    def add(self, row: dict, copies: int, seen: bool) -> None:
        """Appends a row that stands there `copies` times."""
        code, initial, first = row["code"], row["role"][:1], not self.codes
        if code == GONE:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += not seen and code.isupper()
        self.codes += GONE * copies if code == GONE or seen else code + GONE * (copies - 1)
        self.illegal += copies - 1 + (not first and not legal(self.tail, initial))
        self.head, self.tail = initial if first else self.head, initial
        if row["turn"] is not None:
            self.first_turn = row["turn"] if self.first_turn is None else self.first_turn
            self.turns += row["turn"] != self.last_turn
            self.last_turn = row["turn"]

    def row(self, no: int, whole: bool) -> dict:
        """The run and its repairs from every state, or from none kept where it is all there is."""
        starts = (EMPTY,) if whole else (EMPTY, SYSTEM, USER, ASSISTANT)
        edges = [(a, b, cost, audit) for a in starts for b, (cost, audit) in solve(self.codes, a).items()]
        own = {name: value for name, value in vars(self).items() if name != "place"}
        return {**self.place, **own, "no": no, "edges": [dict(zip("a b cost audit".split(), e, strict=True)) for e in edges]}


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema)


def _read(batches: Iterable[pa.RecordBatch]) -> tuple[pa.DataType, Iterator[dict]]:
    """(type of conv_id, rows)."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return pa.null(), iter(())
    return first.schema.field("conv_id").type, (row for b in chain([first], batches) for row in b.to_pylist())


def _cut(rows: Iterable[dict], run_rows: int) -> Iterator[dict]:
    """Runs of sorted rows, a conversation in more than one where it is longer than `run_rows`."""
    no, open_run, whole = 0, None, False
    for row in rows:
        if open_run is None or row["conv_id"] != open_run.place["conv_id"]:
            if open_run is not None:
                yield open_run.row(no, whole)
                no += 1
            # The first and the last conversation may go on in another task.
            whole = open_run is not None
            open_run = Run(row)
        left, seen = row["copies"], row["seen"]
        while left:
            if len(open_run.codes) >= run_rows:
                yield open_run.row(no, False)
                no, whole, open_run = no + 1, False, Run(row)
            copies = min(left, run_rows - len(open_run.codes))
            open_run.add(row, copies, seen)
            left, seen = left - copies, True
    if open_run is not None:
        yield open_run.row(no, False)


class Repair:
    """What the runs of a conversation come to."""

    def __init__(self, runs: Iterable[dict]):
        joined, codes = Joined(), []
        self.report = dict.fromkeys(("gaps", *COUNTED), 0)
        first = last = tail = None
        for run in runs:
            self.report["conv_id"] = run["conv_id"]
            for name in COUNTED:
                self.report[name] += run[name]
            joined.add([(e["a"], e["b"], e["cost"], e["audit"]) for e in run["edges"]])
            if run["codes"]:
                self.report["illegal"] += tail is not None and not legal(tail, run["head"])
                tail = run["tail"]
            if run["turns"]:
                self.report["gaps"] -= run["turns"] - (last == run["first_turn"])
                first, last = run["first_turn"] if first is None else first, run["last_turn"]
            codes.append(run["codes"])
        if first is not None:
            # As a 64-bit number, like the turns.
            self.report["gaps"] = (self.report["gaps"] + last - first + 1 + 2**63) % 2**64 - 2**63
        self.report["cost"], audits = joined.result()
        self.report["audit"] = "".join(audits)
        self.live = "".join(live_edits(c, a) for c, a in zip(codes, audits, strict=True))

    def turns(self, rows: Iterable[dict]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired turns, given the rows that may stay, in order."""
        rows, state = iter(rows), EMPTY
        for letter in self.live:
            row = next(rows) if letter != "I" else None
            if letter == "D":
                continue
            if letter == "K" and state == EMPTY and row["role"].startswith("s"):
                state = SYSTEM
            else:
                state = AFTER[state]
            yield letter, row["role"] if letter == "K" else ROLES[state], "" if row is None else row["text"]


def _repairs(rows: Iterable[dict]) -> Iterator[tuple[Repair, Iterable[dict]]]:
    """Each conversation's repair and the rows that may stay, which are read off as they come."""
    repair = None
    for (_, kind), own in groupby(rows, key=lambda row: (row["conv_id"], row["kind"])):
        if kind == 0:
            if repair is not None:
                yield repair, ()
            repair = Repair(own)
        else:
            yield repair, own
            repair = None
    if repair is not None:
        yield repair, ()


def _reports(rows: Iterable[dict]) -> Iterator[dict]:
    for repair, own in _repairs(rows):
        digest = hashlib.sha256()
        for i, (_, role, text) in enumerate(repair.turns(own)):
            digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        yield {**repair.report, "repaired_sha256": digest.hexdigest()}


def _turns(rows: Iterable[dict]) -> Iterator[dict]:
    for repair, own in _repairs(rows):
        for i, (edit, role, text) in enumerate(repair.turns(own)):
            yield {"conv_id": repair.report["conv_id"], "position": i, "edit": edit, "role": role, "text": text}


def _sorted_parts(rows: DataFrame, run_rows: int) -> DataFrame:
    """A conversation's solved runs (kind 0), then its rows that may stay (kind 1), in order."""
    key = rows.schema["conv_id"].dataType

    def cut(batches):
        kind, own = _read(batches)
        yield from _batches(_cut(own, run_rows), pa.schema([("conv_id", kind), *RUN]))

    stay = _first_turns(rows)
    coded = _coded(rows, stay).repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    runs = coded.mapInArrow(cut, _with_key(key, RUN)).withColumn("kind", F.lit(0))
    stay = stay.withColumn("kind", F.lit(1))
    both = runs.unionByName(stay, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "mark", "no")


def _prepared(conversations: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")]
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *text, copies.alias("copies"))


def repair_reports(conversations: DataFrame, run_rows: int = 512) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of `role:text` of the repaired turns, joined by line ends).

    `conversations`: conv_id, turn, role, text and, if there, copies: how often a row stands there
    (0: it is gone, but its conversation is reported). Rows are read by turn, nulls first; of
    equal turns by role, then by the text's SHA-256. Null role or text: one space. Null conv_id:
    a conversation of its own. Repeated rows: duplicates. Empty text: blank. An empty role has no
    initial, so such a turn cannot be kept as it is. Conversations without rows: zeros, an empty
    audit, the hash of nothing. Columns beside the five are not read. No rows: no rows.

    Equal rows are added up before the shuffle. Rows without their texts are sorted by range, so
    a long conversation spans tasks, and solved in runs of `run_rows`. A conversation's runs and
    the rows that may stay then meet in one task, as its hash has to read them in turn; they
    stream through it sorted, and it holds its edits (some bytes a row), not its texts.
    """

    def run(batches):
        kind, rows = _read(batches)
        yield from _batches(_reports(rows), pa.schema([("conv_id", kind), *REPORT]))

    prepared = _prepared(conversations)
    return _sorted_parts(prepared, run_rows).mapInArrow(run, _with_key(prepared.schema["conv_id"].dataType, REPORT))


def repaired_turns(conversations: DataFrame, run_rows: int = 512) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, position, edit (K kept, R given
    another role, I inserted), role, text. Input, order and cost as for `repair_reports`."""

    def run(batches):
        kind, rows = _read(batches)
        yield from _batches(_turns(rows), pa.schema([("conv_id", kind), *TURN]), 100)

    prepared = _prepared(conversations)
    return _sorted_parts(prepared, run_rows).mapInArrow(run, _with_key(prepared.schema["conv_id"].dataType, TURN))
