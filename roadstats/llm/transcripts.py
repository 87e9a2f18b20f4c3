"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

Input is a transcript as lines. A hidden state is a role and whether the line begins a turn or
continues one; observed are the speaker marker at the line's start, its length and ending, and
whether it follows a blank line. Transition and emission counts come from conversations with
known roles, gathered by aggregation (add-one smoothed); Viterbi finds the likeliest states.

Lines are dealt by ranges of (conversation, turn, line), so a long conversation lies in many tasks.
Each cuts its lines into chunks of at most ``CHUNK``:

1. Each chunk gives the best score from any state before it to any state at its end (a small
   max-plus matrix). A range's first line may follow a blank one of the range before, so its first
   chunk gives both matrices.
2. The matrices are multiplied in two levels: those of a range in its own task, then one row a
   range in order on the driver, forward for the best scores before it and back for the states
   around it (about 1 KB a range, however many lines).
3. With these each range settles the states around its chunks, and each chunk is decoded between.

Log probabilities are rounded to multiples of 2 ** -16, so their sums are exact and the result equals
Viterbi over the whole conversation however it is cut. The model's counts come from the same order:
adjacent lines of known states, and lines by their codes.

Canonical form: a turn opens with ``<|role|>`` on a line of its own, the marker is dropped, and
its other lines follow; concatenating ``rendered`` in order gives the conversation.

Defined results: null text is an empty line. Rows with null conversation or place are a group or
come first in it like any value; equal places are ordered by text hash and repeated rows each get
a row and count each, as neighbours. A conversation's first line follows no blank one. Pairs of
states that no path can take are not counted. Ties between paths go to the first state in ``STATES``. An empty table gives no rows; with
no known roles all transitions and emissions are equally likely. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm.folds import fold
from roadstats.session import new_work_dir

ROLES = ("system", "user", "assistant")
#: Role and whether the line begins a turn (even) or continues it (odd).
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
START = len(STATES)
#: Speaker names that transcripts use for each role (fixed values).
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "q"),
    "assistant": ("assistant", "ai", "bot", "a"),
}
LENGTHS = (0, 40, 120, 400)
CHUNK = 1024
#: Log probabilities are multiples of 1 / STEP: sums of them are exact up to 2 ** 37.
STEP = 1 << 16
_MARKER = r"^\s*[\[<#*]*\s*([A-Za-z]+)\s*[\]>*]*\s*[:>\]]\s*"


def marker_of(line: Column) -> Column:
    """0 no marker, 1 .. 3 the role that a speaker marker names."""
    name = F.lower(F.regexp_extract(line, _MARKER, 1))
    found = F.lit(0)
    for n, role in enumerate(ROLES):
        found = F.when(name.isin(*MARKERS[role]), n + 1).otherwise(found)
    return found


def without_marker(line: Column) -> Column:
    return F.when(marker_of(line) > 0, F.regexp_replace(line, _MARKER, "")).otherwise(line)


def features(line: Column, after_blank: Column | None = None) -> Column:
    """Observed code of a line: marker (4) x length (5) x question (2) x after a blank line (2).
    Without ``after_blank`` the code of a line that follows no blank one (the next is its other)."""
    size = F.char_length(line)
    length = sum((F.when(size > n, 1).otherwise(0) for n in LENGTHS), F.lit(0))
    question = F.rtrim(line).endswith("?").cast("int")
    after = F.lit(0) if after_blank is None else after_blank.cast("int")
    return (((marker_of(line) * 5 + length) * 2 + question) * 2 + after).cast("int")


def is_blank(line: Column) -> Column:
    return F.trim(line) == ""


CODES = 4 * 5 * 2 * 2


def transcript_lines(turns: DataFrame) -> DataFrame:
    """Lines (conv_id, turn, line, text, role, begins) of turns as plain transcripts.

    The style of a conversation's markers follows from its id: ``User:``, ``[human]:``, ``q>`` and
    the like. One turn in five, by hash, has lost its marker. In half of the conversations a blank
    line, the last of its turn, stands behind each one, and every other turn there, by hash, has blank
lines between its own lines as well: a blank line alone does not tell a turn's end.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    pick = lambda n: F.create_map(*[x for r in ROLES for x in (F.lit(r), F.lit(MARKERS[r][n]))])[F.col("role")]
    marker = (
        F.when(style == 0, F.concat(F.initcap(pick(0)), F.lit(": ")))
        .when(style == 1, F.concat(F.lit("["), pick(1), F.lit("]: ")))
        .when(style == 2, F.concat(pick(2), F.lit("> ")))
        .otherwise(F.concat(F.lit("## "), F.upper(pick(0)), F.lit(": ")))
    )
    lost = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0) | marker.isNull()
    apart = F.pmod(F.xxhash64("conv_id"), F.lit(2)) == 0
    loose = apart & (F.pmod(F.xxhash64("turn", "conv_id"), F.lit(2)) == 0)
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    body = F.when(loose, F.replace("text", F.lit("\n"), F.lit("\n\n"))).otherwise(F.col("text"))
    shown = F.concat(F.when(lost, body).otherwise(F.concat(marker, body)), F.when(apart, F.lit("\n")).otherwise(""))
    lines = rows.select("conv_id", "turn", "role", F.posexplode(F.split(shown, r"\n")).alias("line", "text"))
    return lines.withColumn("begins", F.col("line") == 0)


def _in_order(lines: DataFrame, *more: Column) -> DataFrame:
    """(conv_id, turn, line, code, blank, ...) in ranges of the order in which lines are read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    place = [F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("line").cast("int").alias("line")]
    rows = lines.select(*place, F.xxhash64(text).alias("mark"), features(text).alias("code"), is_blank(text).alias("blank"), *more)
    order = ("conv_id", "turn", "line", "mark")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


class Model:
    """Log probabilities: transitions (START last) x states, and states x codes."""

    def __init__(self, transitions: np.ndarray, emissions: np.ndarray):
        self.transitions, self.emissions = transitions, emissions


_ALLOWED = np.array(
    [[begins or role == other for other, begins in STATES] for role, _ in STATES]  # only its own role continues a turn
    + [[begins for _, begins in STATES]]
)


def model_of(steps: np.ndarray, seen: np.ndarray) -> Model:
    """From counts of adjacent states (START last) and of states with codes, each plus one."""
    steps, seen = np.where(_ALLOWED, steps + 1.0, 0.0), seen + 1.0
    with np.errstate(divide="ignore"):
        logs = [np.log(x / x.sum(axis=1, keepdims=True)) for x in (steps, seen)]
    return Model(*(np.round(x * STEP) / STEP for x in logs))


_EDGES = "range int, kind int, conv_id {}, state int, other int, n bigint"


def _counted(lines: DataFrame) -> DataFrame:
    """Counts of a range's lines: kind 0 adjacent states, 1 states with codes; and its first (kind 2:
    state, code) and last line (kind 3: state, blank), which its neighbours need."""
    known = F.lit(-1)
    for n, (role, begins) in enumerate(STATES):
        known = F.when((F.col("role") == role) & (F.col("begins") == begins), n).otherwise(known)
    placed = _in_order(lines, known.alias("state"))
    own = placed.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, seen = np.zeros((START + 1, START), np.int64), np.zeros((START, CODES), np.int64)
        edges, before, kind = [], None, None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            conv, code, blank, state = (batch.column(k).to_pylist() for k in (0, 4, 5, 6))
            for now in zip(conv, state, code, blank):
                if before is None:
                    edges.append((2, now[0], now[1], now[2], 1))
                else:
                    _count(steps, seen, before, now)
                before = now
        if before is None:
            return
        edges.append((3, before[0], before[1], int(before[3]), 1))
        for mark, table in enumerate((steps, seen)):
            edges += [(mark, None, int(a), int(b), int(table[a, b])) for a, b in zip(*np.nonzero(table))]
        number = TaskContext.get().partitionId()
        types = [pa.int32(), pa.int32(), kind, pa.int32(), pa.int32(), pa.int64()]
        columns = [pa.array(x, t) for x, t in zip(zip(*((number, *e) for e in edges)), types)]
        yield pa.RecordBatch.from_arrays(columns, ["range", "kind", "conv_id", "state", "other", "n"])

    return placed.mapInArrow(run, _EDGES.format(own))


def _count(steps: np.ndarray, seen: np.ndarray, before: tuple | None, now: tuple) -> None:
    """Count a line (conv_id, state, code, blank) behind the one before it in the order."""
    (conv, state, code, _), same = now, before is not None and before[0] == now[0]
    if state < 0:
        return
    seen[state, code + int(same and before[3])] += 1
    came = before[1] if same else START
    if came >= 0 and _ALLOWED[came, state]:
        steps[came, state] += 1


def fit(lines: DataFrame) -> Model:
    """Count transitions and emissions of lines with known states (transcript_lines).

    One pass in order; what comes back is a bounded table and two rows a range.
    """
    root = new_work_dir(lines.sparkSession, "transcripts-fit")
    _counted(lines).write.parquet(root)
    found = lines.sparkSession.read.parquet(root)
    steps, seen = np.zeros((START + 1, START), np.int64), np.zeros((START, CODES), np.int64)
    for r in found.where("kind < 2").groupBy("kind", "state", "other").agg(F.sum("n").alias("n")).collect():
        (steps, seen)[r["kind"]][r["state"], r["other"]] += r["n"]
    before = None
    for r in found.where("kind >= 2").orderBy("range", "kind").collect():
        if r["kind"] == 2:
            _count(steps, seen, before, (r["conv_id"], r["state"], r["other"], 0))
        else:
            before = (r["conv_id"], r["state"], None, r["other"])
    return model_of(steps, seen)


def _matrix(codes: np.ndarray, transitions: np.ndarray, emissions: np.ndarray) -> np.ndarray:
    """Best score from each state before the chunk (START last) to each state at its end."""
    score = transitions + emissions[:, codes[0]]
    for code in codes[1:].tolist():
        score = (score[:, :, None] + transitions[None, :START, :]).max(axis=1) + emissions[:, code]
    return score


def _path(codes: np.ndarray, transitions: np.ndarray, emissions: np.ndarray, before: int, end: int) -> list[int]:
    """Best states of a chunk between the state before it and the one at its end."""
    score, back = transitions[before] + emissions[:, codes[0]], []
    for code in codes[1:].tolist():
        step = score[:, None] + transitions[:START]
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + emissions[:, code]
    path = [end]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def _chunks(lines: DataFrame, model: Model) -> DataFrame:
    """Chunks in order (range, chunk), with their lines, observed codes and max-plus matrix. ``other``
    is the matrix of a range's first chunk if its first line follows a blank one."""
    transitions, emissions = model.transitions, model.emissions
    placed = _in_order(lines, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = placed.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk, conv, blank, schema = TaskContext.get().partitionId(), 0, None, False, None
        held: list[tuple] = []
        done: list[dict] = []

        def close() -> None:
            codes = np.array([r[3] for r in held], dtype=np.int32)
            other = None
            if chunk == 0:
                raised = codes.copy()
                raised[0] += 1
                other = _matrix(raised, transitions, emissions).tobytes()
            row = {"range": number, "chunk": chunk, "conv_id": conv, "blank": blank, "codes": codes.tobytes(), "other": other}
            row["matrix"] = _matrix(codes, transitions, emissions).tobytes()
            done.append(row | {"turns": [r[0] for r in held], "lines": [r[1] for r in held], "texts": [r[2] for r in held]})

        for batch in batches:
            schema = schema or pa.schema(
                [("range", pa.int32()), ("chunk", pa.int64()), ("conv_id", batch.schema.field("conv_id").type), ("blank", pa.bool_())]
                + [("codes", pa.binary()), ("matrix", pa.binary()), ("other", pa.binary())]
                + [("turns", pa.list_(pa.int64())), ("lines", pa.list_(pa.int32())), ("texts", pa.list_(pa.string()))]
            )
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6)]
            for now, turn, line, code, empty, text in zip(*columns):
                if held and (now != conv or len(held) >= CHUNK):
                    close()
                    chunk, held = chunk + 1, []
                    if sum(len(d["turns"]) for d in done) >= 4 * CHUNK or len(done) >= CHUNK:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done.clear()
                # Only a conversation's later lines can follow a blank one; a range's first line is settled later.
                after = blank and now == conv and (held or chunk)
                held.append((turn, line, text, code + int(bool(after))))
                conv, blank = now, empty
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    columns = "blank boolean, codes binary, matrix binary, other binary, turns array<bigint>, lines array<int>, texts array<string>"
    return placed.mapInArrow(run, f"range int, chunk bigint, conv_id {own}, {columns}")


def _times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product; rows of ``left`` are the states (or START) before, columns those after it."""
    return (left[:, :, None] + right[None, :START, :]).max(axis=1)


def _open(data: bytes) -> np.ndarray:
    return np.frombuffer(data).reshape(START + 1, START)


_RANGES = "range int, first {0}, last {0}, whole boolean, blank boolean, matrix binary, other binary"


def _ranges(chunks: DataFrame) -> DataFrame:
    """One row a range: its first and last conversation, whether it holds one only, whether its last
    line is blank, and the product over its first conversation's lines (``other``: if its first line
    follows a blank one)."""
    rows = chunks.select("range", "chunk", "conv_id", "blank", "matrix", "other")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, own = None, [], None
        for batch in batches:
            own = batch.schema.field("conv_id").type
            for number, conv, blank, data, other in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if held is None or held["range"] != number:
                    if held is not None:
                        out.append(held)
                    held = {"range": number, "first": conv, "whole": True, "pair": (_open(data), _open(other))}
                elif held["whole"] and conv == held["first"]:
                    held["pair"] = tuple(_times(m, _open(data)) for m in held["pair"])
                else:
                    held["whole"] = False
                held |= {"last": conv, "blank": blank}
        if held is None:
            return
        out.append(held)
        for row in out:
            row["matrix"], row["other"] = (m.tobytes() for m in row.pop("pair"))
        schema = [("range", pa.int32()), ("first", own), ("last", own), ("whole", pa.bool_()), ("blank", pa.bool_()), ("matrix", pa.binary()), ("other", pa.binary())]
        yield pa.RecordBatch.from_pylist(out, pa.schema(schema))

    ordered = rows.repartition("range").sortWithinPartitions("range", "chunk")
    return ordered.mapInArrow(run, _RANGES.format(kind))


_NOTHING = np.array([-np.inf] * START + [0.0])


def _last_product(chunks: DataFrame) -> DataFrame:
    """(range, tail): best scores from START to each state over the last conversation's lines in
    ranges that hold more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, conv, best, out = None, None, None, {}
        for batch in batches:
            for now, own, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                if best is None or (now, own) != (number, conv):
                    number, conv, best = now, own, _NOTHING
                best = np.append((best[:, None] + _open(data)).max(axis=0), -np.inf)
                out[number] = best
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([b.tobytes() for b in out.values()], pa.binary())], ["range", "tail"])

    rows = chunks.select("range", "conv_id", "matrix", "chunk").repartition("range").sortWithinPartitions("range", "chunk")
    return rows.mapInArrow(run, "range int, tail binary")


def _settle(rows: list) -> list[tuple[int, bool, bytes, int | None]]:
    """(range, after blank, scores before it, state at its end if its last conversation goes on) of
    ranges in order: forward over their products, then back."""
    entries, best, before = [], _NOTHING, None
    for r in rows:
        same = before is not None and before["last"] == r["first"]
        after = bool(same and before["blank"])
        entry = best if same else _NOTHING
        product = _open(r["other"] if after else r["matrix"])
        entries.append((same, after, entry, product))
        ends = np.append((entry[:, None] + product).max(axis=0), -np.inf)
        best, before = (ends if r["whole"] else np.frombuffer(r["tail"])), r
    out, end = [], None
    for r, (same, after, entry, product) in zip(reversed(rows), reversed(entries)):
        out.append((r["range"], after, entry.tobytes(), end))
        score = entry[:, None] + product
        at = end if r["whole"] and end is not None else int(score.max(axis=0).argmax())
        end = int(score[:, at].argmax()) if same else None
    return out[::-1]


def _ends(chunks: DataFrame, settled: DataFrame) -> DataFrame:
    """(range, chunk, after, before, end): the states around each chunk on the best path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None

        def close(whole_last: bool) -> pa.RecordBatch:
            """The chunks of one conversation in one range: forward, then back."""
            number, first = held[0][0], held[0][1] == 0
            after, entry, end = held[0][5], held[0][6], held[0][7]
            best = np.frombuffer(entry) if first else _NOTHING
            scores = []
            for n, (_, _, _, data, other, *_) in enumerate(held):
                score = best[:, None] + _open(other if first and n == 0 and after else data)
                scores.append(score)
                best = np.append(score.max(axis=0), -np.inf)
            at = end if whole_last and end is not None else int(best[:START].argmax())
            states = []
            for score in reversed(scores):
                came = int(score[:, at].argmax())
                states.append((came, at))
                at = came
            before, ends = zip(*reversed(states))
            marks = [bool(after and first and n == 0) for n in range(len(held))]
            columns = [pa.array([number] * len(held), pa.int32()), pa.array([h[1] for h in held], pa.int64())]
            columns += [pa.array(marks), pa.array(before, pa.int32()), pa.array(ends, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["range", "chunk", "after", "before", "end"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if held and (row[0], row[2]) != group:
                    yield close(row[0] != group[0])
                    held = []
                group = (row[0], row[2])
                held.append(row)
        if held:
            yield close(True)

    rows = chunks.select("range", "chunk", "conv_id", "matrix", "other").join(settled, "range")
    ordered = rows.select("range", "chunk", "conv_id", "matrix", "other", "after", "entry", "last").repartition("range").sortWithinPartitions("range", "chunk")
    return ordered.mapInArrow(run, "range int, chunk bigint, after boolean, before int, end int")


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn, line, role, opens, rendered) of every line (conv_id, turn, line, text): its
    recovered role, whether it opens a turn, its canonical form."""
    root = new_work_dir(lines.sparkSession, "transcripts")
    spark = lines.sparkSession
    _chunks(lines, model).write.parquet(f"{root}/chunks")
    chunks = spark.read.parquet(f"{root}/chunks")
    tails = _last_product(chunks)
    rows = _ranges(chunks).join(tails, "range").orderBy("range").collect()
    settled = spark.createDataFrame(_settle(rows), "range int, after boolean, entry binary, last int")
    ends = _ends(chunks, settled)
    joined = chunks.join(ends, ["range", "chunk"]).select(chunks["conv_id"], "codes", "after", "before", "end", "turns", "lines", "texts")
    transitions, emissions = model.transitions, model.emissions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for codes, after, before, end in zip(*(batch.column(n).to_pylist() for n in (1, 2, 3, 4))):
                codes = np.frombuffer(codes, dtype=np.int32).copy()
                codes[0] += after
                states.append(_path(codes, transitions, emissions, before, end))
            columns = [*batch.columns[:1], *batch.columns[5:], pa.array(states, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turns", "lines", "texts", "states"])

    kind = lines.schema["conv_id"].dataType.simpleString()
    decoded = joined.mapInArrow(run, f"conv_id {kind}, turns array<bigint>, lines array<int>, texts array<string>, states array<int>")
    each = decoded.select("conv_id", F.explode(F.arrays_zip("turns", "lines", "texts", "states")).alias("r"))
    opens = F.col("r.states") % 2 == 0
    role = F.array(*map(F.lit, ROLES))[F.floor(F.col("r.states") / 2).cast("int")]
    text = F.when(opens, without_marker(F.col("r.texts"))).otherwise(F.col("r.texts"))
    head = F.when(opens, F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise("")
    return each.select(
        "conv_id",
        F.col("r.turns").alias("turn"),
        F.col("r.lines").alias("line"),
        role.alias("role"),
        opens.alias("opens"),
        F.concat(head, text, F.lit("\n")).alias("rendered"),
    )


def op9_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as plain transcripts and parsed back, by a model fitted on the
    conversations outside fold 2 of their ids."""
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    lines = transcript_lines(turns)
    seen = fold("conv_id") != 2
    return parse(lines, fit(lines.where(seen)))
