"""Transcript parsing by a hidden Markov model, and canonical chat rendering.

A transcript is one text of lines.  Some lines start with a speaker marker,
some markers name an unknown speaker, some turns have none.  The hidden state
of a line is a role and whether the line begins a turn; what is seen of it is
its marker and a few features.  Viterbi finds the likeliest states of all
lines, and so the turns, which are rendered in one canonical form.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, keep, slices, stored

ROLES = ("system", "user", "assistant")
#: States: each role beginning a turn, and inside one.
STATES = [(r, b) for r in ROLES for b in (True, False)]

#: Speaker markers by role, lower case.
MARKERS = {
    "system": ("system", "context", "note", "setup"),
    "user": ("user", "human", "q", "question", "prompt", "instruction", "customer", "me", "you"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "response", "model", "agent"),
}
_ROLE_OF = {m: r for r, ms in MARKERS.items() for m in ms}
_MARK = regex.compile(r"\s*(?:<\|(?P<tag>\w+)\|>|\[(?P<box>\w+)\]|#{1,4}\s*(?P<head>\w+)\s*:|\*\*(?P<bold>\w+):?\*\*:?|(?P<name>\w+)(?: \(\w+\))?\s*:(?=\s|$))\s*")

#: What a line shows: marker (none, one per role, unknown name), question, length.
N_MARKS, N_SEEN = len(ROLES) + 2, (len(ROLES) + 2) * 2 * 3

#: How transcripts of the query mark their turns, by style; None leaves turns of that role unmarked.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### Context: ", "user": "### Instruction: ", "assistant": "### Response: "},
    {"system": "[SYSTEM] ", "user": "[USER] ", "assistant": "[ASSISTANT] "},
    {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
    {"system": "Note: ", "user": "Q: ", "assistant": "A: "},
    {"system": "**System:** ", "user": "**Human:** ", "assistant": "**AI:** "},
    {"system": "Moderator: ", "user": "Kim: ", "assistant": "Robin: "},
)


def see(line: str) -> tuple[int, str]:
    """The symbol that a line shows, and the line without a known role's marker.
    An unknown name with a colon is a marker only of at most two words."""
    m = _MARK.match(line)
    mark, rest = 0, line
    if m:
        word = next(g for g in m.groupdict().values() if g)
        role = _ROLE_OF.get(word.lower())
        if role:
            mark, rest = 1 + ROLES.index(role), line[m.end():]
        elif m.group("name") and word[:1].isupper():
            mark = len(ROLES) + 1
    body = rest.rstrip()
    size = 0 if len(body) < 40 else 1 if len(body) < 200 else 2
    return (mark * 2 + body.endswith("?")) * 3 + size, rest


class Hmm:
    """Log probabilities of first states, moves and symbols."""

    def __init__(self, first: np.ndarray, move: np.ndarray, show: np.ndarray):
        self.first, self.move, self.show = first, move, show

    @staticmethod
    def from_counts(first, move, show) -> "Hmm":
        """Smoothed counts.  States that cannot follow (inside one role behind another) are ruled out."""
        may = np.array([[b or r == q for r, b in STATES] for q, _ in STATES])
        start = np.array([b for _, b in STATES])
        def logs(c, ok):
            p = np.where(ok, c + 0.5, 0.0)
            with np.errstate(divide="ignore"):
                return np.log(p / p.sum(axis=-1, keepdims=True))
        return Hmm(logs(first, start), logs(move, may), logs(show, np.ones_like(show, dtype=bool)))

    @staticmethod
    def default() -> "Hmm":
        """Counts that stand for common transcripts: users and assistants take
        turns, markers of a role show it, turns mostly begin with a marker."""
        first, move, show = np.zeros(len(STATES)), np.zeros((len(STATES),) * 2), np.zeros((len(STATES), N_SEEN))
        for i, (r, b) in enumerate(STATES):
            if b:
                first[i] = {"system": 20, "user": 79, "assistant": 1}[r]
            for j, (q, c) in enumerate(STATES):
                if c:
                    move[i, j] = {("system", "user"): 30, ("user", "assistant"): 30, ("assistant", "user"): 30}.get((r, q), 1)
                elif r == q:
                    move[i, j] = 60 if r == "assistant" else 30
            for mark in range(N_MARKS):
                weight = (80 if b else 0.1) if mark == 1 + ROLES.index(r) else (15 if b else 200) if mark == 0 else \
                    (15 if b else 1) if mark == N_MARKS - 1 else 0.1
                for ask in range(2):
                    for size in range(3):
                        show[i, (mark * 2 + ask) * 3 + size] = weight * ((4 if r == "user" else 1) if ask else 8) * \
                            ((1, 2, 2) if r == "assistant" else (3, 2, 1))[size]
        return Hmm.from_counts(first, move, show)

    def viterbi(self, seen: list[int], enter: int | None = None, end: int | None = None) -> list[int]:
        """Likeliest states; the lower-numbered state on ties.  ``enter`` is the
        state before the first line, ``end`` that of the last line, where known."""
        if not seen:
            return []
        score, back = (self.first if enter is None else self.move[enter]) + self.show[:, seen[0]], []
        for s in seen[1:]:
            reach = score[:, None] + self.move
            back.append(reach.argmax(axis=0))
            score = reach.max(axis=0) + self.show[:, s]
        path = [int(score.argmax()) if end is None else end]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


    def through(self, seen: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the best paths through the lines: by the state before the
        first line (rows) and of the last one, and those of a transcript that begins here."""
        every = np.vstack([self.move, self.first])
        if not seen:
            return np.where(np.eye(len(STATES), dtype=bool), 0.0, -np.inf), self.first
        every = every + self.show[:, seen[0]]
        for s in seen[1:]:
            every = (every[:, :, None] + self.move).max(axis=1) + self.show[:, s]
        return every[:-1], every[-1]


def look(text: str) -> tuple[list[str], list[tuple[int, str]]]:
    """The lines of a transcript, without blank ones before the first, and what they show."""
    lines = text.split("\n")
    first = next((i for i, x in enumerate(lines) if x.strip()), len(lines))
    return lines[first:], [see(x) for x in lines[first:]]


def parse(text: str, model: Hmm, enter: int | None = None, end: int | None = None) -> list[tuple[str, str]]:
    """``(role, text)`` turns of a transcript, or of a part of one between known
    states; blank lines at a turn's edges go.  What a part continues is a turn of its own."""
    lines, looks = look(text)
    turns: list[tuple[str, list[str]]] = []
    for (_, rest), line, state in zip(looks, lines, model.viterbi([s for s, _ in looks], enter, end)):
        role, begins = STATES[state]
        if begins or not turns:
            turns.append((role, [rest if begins else line]))
        else:
            turns[-1][1].append(line)
    return [(r, "\n".join(x).strip()) for r, x in turns]


def render(turns: list[tuple[str, str]]) -> str:
    """Canonical form: each turn between start and end tags, its role on the first line."""
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def _parse_stage(model: Hmm):
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for b in slices(batches):
            found = [parse(t, model, q, e) if t.strip() else [] for t, q, e in zip(*(b.column(c).to_pylist() for c in ("text", "enter", "end")))]
            yield pa.record_batch([b.column("row"), pa.array([[{"role": r, "text": t} for r, t in f] for f in found], turn),
                                   pa.array([render(f) for f in found], pa.string())], names=["row", "turns", "rendered"])

    return run


# ------------------------------------------- transcripts in several parts
def _runs(batches):
    """Rows of a sorted partition as ``(conv, rows)``, one conversation after another."""
    conv, held = None, []
    for b in batches:
        for r in b.to_pylist():
            if held and r["conv"] != conv:
                yield conv, held
                held = []
            conv = r["conv"]
            held.append(r)
    if held:
        yield conv, held


def _after(before, row):
    """Scores at the end of a part: ``before`` it, or None where the transcript begins."""
    return np.array(row["v"]) if before is None else (before[:, None] + np.array(row["m"]).reshape(len(STATES), -1)).max(axis=0)


def _batch(rows: list[dict], schema: pa.Schema):
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def part_states(parts: DataFrame, model: Hmm) -> DataFrame:
    """``(conv, part, enter, end)`` of rows ``(conv, part, text)``: the states
    before the first and of the last line of every part on the likeliest path
    through the whole conversation, exactly.

    Each part becomes the scores of the best paths through it.  The parts, a few
    numbers each, are sorted over all tasks; a forward and a backward scan carry
    scores and states from task to task, with one summary a task on the driver,
    so a conversation may span any number of tasks."""
    n = len(STATES)
    listed = pa.list_(pa.float64())

    def score(batches):
        for b in slices(batches):
            through = [model.through([x for x, _ in look(t)[1]]) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("conv"), b.column("part"), pa.array([m.ravel().tolist() for m, _ in through], listed),
                                   pa.array([v.tolist() for _, v in through], listed)], names=["conv", "part", "m", "v"])

    kinds = f"conv {parts.schema['conv'].dataType.simpleString()}, part {parts.schema['part'].dataType.simpleString()}"
    scored = arrow_map(parts.select("conv", "part", "text"), score, f"{kinds}, m array<double>, v array<double>")
    dealt = keep(scored.repartitionByRange("conv", "part").sortWithinPartitions("conv", "part"))
    conv_type = pa.int64() if "int" in parts.schema["conv"].dataType.simpleString() else pa.string()
    ends = pa.schema([("task", pa.int32()), ("a", conv_type), ("z", conv_type), ("single", pa.bool_()), ("m", listed), ("v", listed), ("w", listed)])

    def forward_ends(batches):
        first, last, k = None, None, 0
        for conv, rows in _runs(batches):
            k += 1
            scores = None
            for r in rows:
                scores = _after(scores, r)
            if first is None:
                # from every state before it, and as a beginning
                whole = np.stack([_fold(rows, np.where(np.arange(n) == q, 0.0, -np.inf)) for q in range(n)])
                first = (conv, whole, scores)
            last = (conv, scores)
        if first is not None:
            yield _batch([{"task": TaskContext.get().partitionId(), "a": first[0], "z": last[0], "single": k == 1, "m": first[1].ravel().tolist(),
                           "v": first[2].tolist(), "w": last[1].tolist()}], ends)

    before, held = {}, None  # scores before each task's first run where it continues one
    for r in sorted(arrow_map(dealt, forward_ends, f"task int, a {_type(parts)}, z {_type(parts)}, single boolean, m array<double>, v array<double>, w array<double>").collect(),
                    key=lambda r: r.task):
        out = np.array(r.v)
        if held is not None and held[0] == r.a:
            before[r.task] = held[1]
            out = (held[1][:, None] + np.array(r.m).reshape(n, n)).max(axis=0)
        held = (r.z, out if r.single else np.array(r.w))

    backs = pa.schema([("conv", conv_type), ("part", pa.int64()), ("back", pa.list_(pa.int32())), ("best", pa.int32())])

    def forward(batches):
        scores, first = before.get(TaskContext.get().partitionId()), True
        for conv, rows in _runs(batches):
            scores = scores if first else None
            first, out = False, []
            for r in rows:
                back = None if scores is None else (scores[:, None] + np.array(r["m"]).reshape(n, n)).argmax(axis=0).tolist()
                scores = _after(scores, r)
                out.append({"conv": conv, "part": r["part"], "back": back, "best": int(scores.argmax())})
            yield _batch(out, backs)

    walked = keep(arrow_map(dealt, forward, f"conv {_type(parts)}, part long, back array<int>, best int"))
    tails = pa.schema([("task", pa.int32()), ("a", conv_type), ("z", conv_type), ("single", pa.bool_()), ("entry", pa.list_(pa.int32())), ("best_a", pa.int32()), ("best_z", pa.int32())])

    def backward_ends(batches):
        first, last, k = None, None, 0
        for conv, rows in _runs(batches):
            k += 1
            if first is None:
                entry = list(range(n))  # of the run's first line, by the state at its end
                for r in reversed(rows):
                    entry = None if r["back"] is None or entry is None else [r["back"][e] for e in entry]
                first = (conv, entry, rows[-1]["best"])
            last = (conv, rows[-1]["best"])
        if first is not None:
            yield _batch([{"task": TaskContext.get().partitionId(), "a": first[0], "z": last[0], "single": k == 1, "entry": first[1], "best_a": first[2], "best_z": last[1]}], tails)

    end_of, follows = {}, None  # the state at the end of each task's last run
    for r in sorted(arrow_map(walked, backward_ends, f"task int, a {_type(parts)}, z {_type(parts)}, single boolean, entry array<int>, best_a int, best_z int").collect(),
                    key=lambda r: -r.task):
        end_of[r.task] = follows[1] if follows is not None and follows[0] == r.z and follows[1] is not None else r.best_z
        at_end = end_of[r.task] if r.single else r.best_a
        follows = (r.a, r.entry[at_end] if r.entry is not None else None)

    found = pa.schema([("conv", conv_type), ("part", pa.int64()), ("enter", pa.int32()), ("end", pa.int32())])

    def backward(batches):
        last = end_of.get(TaskContext.get().partitionId())
        runs = _runs(batches)
        run = next(runs, None)
        while run is not None:
            following = next(runs, None)
            conv, rows = run
            state, out = rows[-1]["best"] if following is not None else last, []
            for r in reversed(rows):
                enter = None if r["back"] is None else r["back"][state]
                out.append({"conv": conv, "part": r["part"], "enter": enter, "end": state})
                state = enter
            yield _batch(out, found)
            run = following

    return arrow_map(walked, backward, f"conv {_type(parts)}, part long, enter int, end int")


def _fold(rows, scores):
    for r in rows:
        scores = (scores[:, None] + np.array(r["m"]).reshape(len(STATES), -1)).max(axis=0)
    return scores


def _type(parts: DataFrame) -> str:
    return "long" if "int" in parts.schema["conv"].dataType.simpleString() else "string"


def format_chats(transcripts: DataFrame, model: Hmm | None = None, text_col: str = "text", parts: tuple[str, str] | None = None) -> DataFrame:
    """Each transcript row as struct ``row`` with ``turns`` (role, text) and ``rendered``.

    Whole texts are parsed, in time linear in their lines.  With ``parts``, the
    columns of a conversation's key and of the number of a row in it, rows of
    one conversation are parsed as one transcript: roles come from the likeliest
    path through all of it (:func:`part_states`); a null key or number stands
    alone.  Null, empty and blank texts have no turns and render as ''.  Repeated
    rows are parsed alike; an empty table gives no rows.
    """
    model = model or Hmm.default()
    rows = transcripts.select(F.struct(*[transcripts[c] for c in transcripts.columns]).alias("row"),
                              F.coalesce(transcripts[text_col], F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    none = F.lit(None).cast("int")
    if parts:
        conv = "long" if "int" in transcripts.schema[parts[0]].dataType.simpleString() else "string"
        keyed = rows.withColumn("conv", F.col("row").getField(parts[0]).cast(conv)).withColumn("part", F.col("row").getField(parts[1]).cast("long"))
        long = keyed.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("z")).filter("conv is not null and a < z").select("conv")
        several = stored(keyed.join(long, "conv", "left_semi").filter("part is not null").select("conv", "part", "text").dropDuplicates(["conv", "part"]))
        states = part_states(several, model) if not several.isEmpty() else several.select("conv", "part", none.alias("enter"), none.alias("end"))
        rows = keyed.join(states, ["conv", "part"], "left").select("row", "text", "enter", "end")
    else:
        rows = rows.select("row", "text", none.alias("enter"), none.alias("end"))
    return arrow_map(rows, _parse_stage(model), f"row {kind}, turns array<struct<role: string, text: string>>, rendered string")


def fit(marked: DataFrame, lines_col: str = "lines") -> Hmm:
    """Model from rows with ``lines``: an array of (role, begins, line) in
    order.  Only counts of states and symbols reach the driver.  Rows that are
    null or empty, and lines with unknown roles, do not count."""
    numbers = {s: i for i, s in enumerate(STATES)}

    def run(batches):
        for b in slices(batches):
            first, move, show = np.zeros(len(STATES)), np.zeros((len(STATES),) * 2), np.zeros((len(STATES), N_SEEN))
            for lines in b.column("lines").to_pylist():
                last = None
                for x in lines or ():
                    state = numbers.get((x["role"], x["begins"]))
                    if state is None:
                        continue
                    show[state, see(x["line"] or "")[0]] += 1
                    if last is None:
                        first[state] += 1
                    else:
                        move[last, state] += 1
                    last = state
            flat = np.concatenate([first, move.ravel(), show.ravel()])
            at = np.flatnonzero(flat)
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["at", "n"])

    counts: pd.DataFrame = arrow_map(marked.select(F.col(lines_col).alias("lines")), run, "at int, n double") \
        .groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    if counts.empty:
        return Hmm.default()
    n = len(STATES)
    flat = np.zeros(n + n * n + n * N_SEEN)
    flat[counts["at"].to_numpy()] = counts["n"].to_numpy()
    return Hmm.from_counts(flat[:n], flat[n:n + n * n].reshape(n, n), flat[n + n * n:].reshape(n, N_SEEN))


# -------------------------------------------------- transcripts of the query
#: Turn numbers of a conversation in one row; longer ones become several rows, parsed as one transcript.
PART_TURNS = 64


def transcripts_of(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of a table of turns (``conv_id``, ``turn``, ``role``, ``text``).

    A conversation's marker style depends on its id; every ninth turn or so
    has lost its marker.  ``(conv_id, part, text, lines)``: ``lines`` holds the
    true roles.  Null texts are empty, null roles stay unmarked, turns of one
    number go by role and text; a turn without a conversation is a transcript
    of its own, however many there are."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    marks = F.array(*[F.create_map(*[F.lit(x) for kv in s.items() for x in kv]) for s in STYLES])
    unmarked = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(9)) == 0
    mark: Column = F.when(F.col("role").isNull() | unmarked, "").otherwise(F.coalesce(F.element_at(F.get(marks, style), F.col("role")), F.lit("")))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role",
                                 F.concat(mark, F.coalesce("text", F.lit(""))).alias("said")) \
        .withColumn("part", F.floor(F.coalesce("turn", F.lit(0)) / PART_TURNS))
    one = F.struct("turn", "role", "said")
    grouped = turns.filter("conv_id is not null").groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(one)).alias("t")) \
        .unionByName(turns.filter("conv_id is null").select("conv_id", "part", F.array(one).alias("t")))
    lines = F.flatten(F.transform("t", lambda t: F.transform(F.split(t["said"], "\n"), lambda x, i: F.struct(
        t["role"].alias("role"), (i == 0).alias("begins"), x.alias("line")))))
    return grouped.select("conv_id", "part", F.array_join(F.transform("t", lambda t: t["said"]), "\n").alias("text"),
                          lines.alias("lines"), F.transform("t", lambda t: t["role"]).alias("roles"))
