"""Transcript parsing: roles of lines by a hidden Markov model, then canonical turns.

A transcript is lines in parts. States are the first and the further lines of a
turn of each role; what a line shows is its speaker marker, its length, whether
it asks, and whether it follows a blank line. Transitions and emissions are
counted over all rows whose roles are given, with add-one smoothing. Viterbi
finds the likeliest states, and each part is rendered with the header
``<|role|>`` where a turn begins and ``<|end|>`` where the next one does or the
transcript ends; the parts of a transcript, end to end, are its canonical form.

A transcript is decoded in windows of ``WINDOW`` parts, with ``CONTEXT`` parts
more on either side that only inform: whole for all but very long ones, and
bounded for a transcript that holds a third of all rows. Places come from a
range partition, so no task gathers a transcript.

Defined results: a null text is one empty line. Rows that repeat whole are one
part of the transcript, decoded once and returned as often as they stand there;
rows that repeat a turn stand in the order of role and text. Roles other than
the known names, and nulls, are ``other``. Null ids are one transcript.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.checkpoints import cut

WINDOW = 1024
CONTEXT = 32

ROLES = ("user", "assistant", "system", "other")
#: Names that speakers go by, in markers and in given roles.
NAMES = {
    "user": ("user", "human", "customer", "question", "q", "prompter", "you", "me"),
    "assistant": ("assistant", "ai", "bot", "model", "agent", "answer", "a", "gpt", "chatbot"),
    "system": ("system", "instructions", "instruction", "note", "context"),
}
#: Markers of the roles in the styles that ``transcripts`` writes; the last has none.
STYLES = (
    {"user": "User: ", "assistant": "Assistant: ", "system": "System: "},
    {"user": "Human: ", "assistant": "AI: ", "system": "Instructions: "},
    {"user": "Q: ", "assistant": "A: ", "system": "Note: "},
    {},
)
LENGTHS = (0, 40, 120, 400)

_ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
_MARKER = re.compile(r"^\s*(?:[#*<|\[(]\s*)*([A-Za-z][A-Za-z ]{0,24}?)\s*(?:[|\])>*#]\s*)*(?::|\|>)\s*")
#: Of each factor of what a line shows, the number of values.
FACTORS = (len(ROLES) + 1, len(LENGTHS) + 1, 2, 2)
N_STATES = 2 * len(ROLES)


class Model(NamedTuple):
    """Natural logs of start, transition and emission probabilities, one emission table a factor."""

    start: np.ndarray
    step: np.ndarray
    shows: tuple[np.ndarray, ...]


def known_role(role: str | None) -> str:
    return _ROLE_OF.get((role or "").strip().lower(), "other")


def marker(line: str) -> tuple[int, int]:
    """The role a line's marker names (0: none, then ``ROLES``), and where the text after it begins."""
    found = _MARKER.match(line)
    if not found:
        return 0, 0
    role = _ROLE_OF.get(found[1].strip().lower())
    return (0, 0) if role is None else (1 + ROLES.index(role), found.end())


def shown(lines: list[str], blank: bool = True) -> np.ndarray:
    """What each line shows, a column a factor; ``blank``: so was the line before."""
    out = np.zeros((len(lines), len(FACTORS)), np.int64)
    for i, line in enumerate(lines):
        text = line.strip()
        out[i] = marker(line)[0], sum(len(text) > n for n in LENGTHS), text.endswith("?"), blank
        blank = not text
    return out


def viterbi(model: Model, seen: np.ndarray) -> np.ndarray:
    """The likeliest state of each line."""
    emission = sum(table[:, seen[:, f]].T for f, table in enumerate(model.shows))
    best, came = model.start + emission[0], np.zeros((len(seen), N_STATES), np.int64)
    for i in range(1, len(seen)):
        paths = best[:, None] + model.step
        came[i] = paths.argmax(0)
        best = paths[came[i], np.arange(N_STATES)] + emission[i]
    states = np.empty(len(seen), np.int64)
    states[-1] = best.argmax()
    for i in range(len(seen) - 1, 0, -1):
        states[i - 1] = came[i, states[i]]
    return states


def model_of(counts: dict[tuple[int, int, int], int]) -> Model:
    """A model of (factor, state, value) counts; factor -1 is the start, -2 a step from a state to one."""
    shape = {-1: (1, N_STATES), -2: (N_STATES, N_STATES), **{f: (N_STATES, n) for f, n in enumerate(FACTORS)}}
    tables = {f: np.ones(s) for f, s in shape.items()}
    for (factor, state, value), n in counts.items():
        tables[factor][state, value] += n
    # A further line of a turn follows a line of the same role.
    for state in range(N_STATES):
        for inner in range(1, N_STATES, 2):
            if state // 2 != inner // 2:
                tables[-2][state, inner] = 1e-12
    tables[-1][0, 1::2] = 1e-12
    logs = {f: np.log(t / t.sum(1, keepdims=True)) for f, t in tables.items()}
    return Model(logs[-1][0], logs[-2], tuple(logs[f] for f in range(len(FACTORS))))


# -- Spark ------------------------------------------------------------------


def transcripts(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as parts of plain transcripts: conv_id, turn, role, lines (text).

    The style of a transcript's markers goes by its id. In the style without
    markers a blank line stands between turns.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    role = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    mark: Column = F.lit("\n")
    for number, marks in enumerate(STYLES):
        for known, text in marks.items():
            mark = F.when((style == number) & (role == known), F.lit(text)).otherwise(mark)
    return conversations.select("conv_id", "turn", "role", F.concat(mark, F.coalesce("text", F.lit(""))).alias("lines"))


def windows(parts: DataFrame) -> DataFrame:
    """``parts`` with their window and whether they belong to it or only inform it, dealt and sorted by window."""
    key = ["conv_id", "turn", "role", "lines"]
    parts = parts.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "lines")
    parts = parts.groupBy(*key).agg(F.count("*").alias("copies"))
    ranged = cut(parts.repartitionByRange(*key).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("turn", "role", "lines")) - 1
    placed = ranged.withColumn("within", within).join(base, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    placed = placed.select(*key, "copies", (F.col("base") + F.col("within")).alias("place"))
    own = (F.col("place") / WINDOW).cast("long")
    reach = F.array_distinct(
        F.transform(F.array(F.lit(-CONTEXT), F.lit(0), F.lit(CONTEXT)), lambda d: (F.greatest(F.col("place") + d, F.lit(0)) / WINDOW).cast("long"))
    )
    dealt = placed.withColumn("own", own).withColumn("window", F.explode(reach)).withColumn("belongs", F.col("own") == F.col("window"))
    return dealt.repartition("conv_id", "window").sortWithinPartitions("conv_id", "window", "place").select("conv_id", "window", "turn", "role", "lines", "copies", "belongs")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one window after the other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[-1]["conv_id"], held[-1]["window"]) != (row["conv_id"], row["window"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def counts(windowed: DataFrame) -> DataFrame:
    """(factor, state, value, n) over all rows, by their given roles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], int] = {}
        for rows in _groups(batches):
            before, blank = None, True
            for row in rows:
                lines = row["lines"].split("\n")
                first = _first_line(lines)
                role = ROLES.index(known_role(row["role"]))
                # Blank lines before a turn's text are the end of the turn before it.
                lead = before if before is not None else 2 * role
                states = [lead - lead % 2 + (before is not None)] * first + [2 * role] + [2 * role + 1] * (len(lines) - first - 1)
                if row["belongs"]:
                    for state, seen in zip(states, shown(lines, blank).tolist()):
                        step = (-1, 0, state) if before is None else (-2, before, state)
                        for key in (step, *((f, state, v) for f, v in enumerate(seen))):
                            found[key] = found.get(key, 0) + 1
                        before = state
                before, blank = states[-1], not lines[-1].strip()
        rows = [(*key, n) for key, n in found.items()]
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["factor", "state", "value", "n"])

    parts = windowed.mapInArrow(count, "factor long, state long, value long, n long")
    return parts.groupBy("factor", "state", "value").agg(F.sum("n").alias("n"))


def _first_line(lines: list[str]) -> int:
    """The first line with a text, or 0."""
    return next((i for i, line in enumerate(lines) if line.strip()), 0)


def train(windowed: DataFrame) -> Model:
    """A model of all rows; its counts are at most a few hundred rows."""
    return model_of({(f, s, v): n for f, s, v, n in counts(windowed).collect()})


def render(lines: list[str], states: np.ndarray, opened: bool, ends: bool) -> str:
    """Canonical form of a part; ``opened``: a turn is open before it, ``ends``: nothing follows it."""
    out = []
    for line, state in zip(lines, states.tolist()):
        if state % 2 == 0:
            if opened:
                out.append("<|end|>")
            out.append(f"<|{ROLES[state // 2]}|>")
            line, opened = line[marker(line)[1] :], True
        if line.strip():
            out.append(line.strip())
    if ends and opened:
        out.append("<|end|>")
    return "".join(line + "\n" for line in out)


def parse(windowed: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, role, role_found, n_turns and rendered for every part, as often as it stands there.

    role_found is the role of the part's first line with a text; n_turns counts
    the turns that begin in it.
    """
    schema = "conv_id long, turn long, role string, role_found string, n_turns long, rendered string, copies long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [f.split()[0] for f in schema.split(", ")]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for rows in _groups(batches):
            parts = [row["lines"].split("\n") for row in rows]
            states = viterbi(model, shown([line for part in parts for line in part]))
            at = 0
            for i, (row, part) in enumerate(zip(rows, parts)):
                own, at = states[at : at + len(part)], at + len(part)
                if row["belongs"]:
                    text = render(part, own, at > len(part), i == len(rows) - 1)
                    role = ROLES[own[_first_line(part)] // 2]
                    held.append((row["conv_id"], row["turn"], row["role"], role, int((own % 2 == 0).sum()), text, row["copies"]))
            if len(held) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    found = windowed.mapInArrow(answer, schema)
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def recovered(conversations: DataFrame) -> DataFrame:
    """Write ``conversations`` as plain transcripts, learn from all of them, parse and render each."""
    windowed = cut(windows(transcripts(conversations)))
    return parse(windowed, train(windowed))
