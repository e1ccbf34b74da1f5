"""Chat formatting: roles recovered from transcripts by a hidden Markov model, then canonical turns.

The hidden state of a line is the speaker's role and whether the line begins a turn.  What is seen of
a line is its speaker marker ("Human:", "[AI]", none, ...), its length and its end.  Start, transition
and emission counts come from transcripts whose roles are known; Viterbi finds the best states.

Conversations are range-sorted into runs.  A conversation that spans several runs, however long, is
not gathered: each run gives a matrix of the best scores from the state before it to the state at its
end (Viterbi is a product of such matrices), the states at the cuts follow from the matrices alone,
and each run is then decoded between its two states.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches
from rideflow.sources import materialize

ROLES = ("system", "user", "assistant")
N_STATES = 2 * len(ROLES)  # role * 2 + (0 the line begins a turn, 1 it goes on)
_UNKNOWN = -1

# Words that mark speakers.
_MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "customer", "prompt"),
    "assistant": ("assistant", "ai", "answer", "agent", "bot"),
}
_MARKER = re.compile(
    r"\s*[<\[(#*|]*\s*(" + "|".join(w for ws in _MARKERS.values() for w in ws) + r")\s*(?:[|>\])*]+\s*:?|:)\s*", re.IGNORECASE
)
_MARKER_ROLE = {w: ROLES.index(r) for r, ws in _MARKERS.items() for w in ws}

#: Values of each thing seen of a line: marker (none or a role's), length, end.
_SIZES = (1 + len(ROLES), 8, 4)
_ENDS = {"?": 1, ":": 2}

OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"


def marker_of(line: str) -> tuple[int, str]:
    """(0 without a marker, else the role's number + 1; the line without its marker)."""
    found = _MARKER.match(line)
    return (_MARKER_ROLE[found[1].lower()] + 1, line[found.end() :]) if found else (0, line)


def line_features(line: str) -> tuple[int, int, int]:
    marker, rest = marker_of(line)
    words = len(rest.split())
    end = rest.rstrip()[-1:]
    return marker, min(words.bit_length(), _SIZES[1] - 1), 3 if not end else _ENDS.get(end, 0)


@dataclass
class Chain:
    """Log-probabilities: start (S), steps (S, S), and of each thing seen (S, values)."""

    start: np.ndarray
    steps: np.ndarray
    seen: list[np.ndarray]

    def emissions(self, lines: list[str]) -> np.ndarray:
        x = np.array([line_features(line) for line in lines]).reshape(-1, len(_SIZES))
        return sum(table[:, x[:, k]].T for k, table in enumerate(self.seen))


_N_COUNTS = N_STATES + N_STATES**2 + N_STATES * sum(_SIZES)


def _chain(counts: np.ndarray) -> Chain:
    """Probabilities of counts with one added to each."""
    def log(part: np.ndarray) -> np.ndarray:
        return np.log((part + 1) / (part + 1).sum(-1, keepdims=True))

    start, steps, rest = np.split(counts.astype(float), [N_STATES, N_STATES + N_STATES**2])
    seen, at = [], 0
    for size in _SIZES:
        seen.append(log(rest[at : at + N_STATES * size].reshape(N_STATES, size)))
        at += N_STATES * size
    return Chain(log(start), log(steps.reshape(N_STATES, N_STATES)), seen)


def _best_from(emission: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best score of ending in each state, from each row of ``first`` (scores at the first line)."""
    score = first + emission[0]
    for e in emission[1:]:
        score = (score[:, :, None] + step).max(1) + e
    return score


def viterbi(chain: Chain, emission: np.ndarray, before: int | None = None, last: int | None = None) -> np.ndarray:
    """The best states; ``before``: the state of the line before, ``last``: that of the last line."""
    score = (chain.start if before is None else chain.steps[before]) + emission[0]
    back = np.zeros((len(emission), N_STATES), np.int8)
    for i, e in enumerate(emission[1:], 1):
        paths = score[:, None] + chain.steps
        back[i] = paths.argmax(0)
        score = paths.max(0) + e
    out = np.empty(len(emission), np.int64)
    out[-1] = score.argmax() if last is None else last
    for i in range(len(emission) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


# ---- runs -------------------------------------------------------------------------------------


def sorted_runs(transcripts: DataFrame) -> DataFrame:
    """The rows range-sorted by (conv_id, turn) and numbered: ``part`` and ``idx`` within it.

    Written down, so that every later step sees the same runs.  Rows of equal keys are told apart by
    a number, so a key that a third of all rows share is spread as well.
    """
    keys = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("raw").asc_nulls_last(), F.col("mark")]
    rows = transcripts.select("conv_id", "turn", "role", "raw", F.monotonically_increasing_id().alias("mark"))
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("mark")
    number = F.monotonically_increasing_id()  # the partition's number above 33 bits of the row's
    return materialize(
        ordered.withColumn("number", number).select(
            F.shiftright("number", 33).cast("int").alias("part"), (F.col("number").bitwiseAND((1 << 33) - 1)).alias("idx"),
            "conv_id", "turn", "role", "raw",
        ),
        label="chat-runs",
    )


def _conversations(part: pa.Table) -> Iterator[tuple[object, list[dict]]]:
    """(conv_id, its rows in order) of one part, in order."""
    rows, held = [], None
    for row in part.sort_by("idx").to_pylist():
        if rows and row["conv_id"] != held:
            yield held, rows
            rows = []
        held = row["conv_id"]
        rows.append(row)
    if rows:
        yield held, rows


def _lines(rows: list[dict]) -> tuple[list[str], np.ndarray]:
    """All lines, and how many each row has (a null or empty text is an empty line)."""
    each = [(row["raw"] or "").split("\n") for row in rows]
    return [line for lines in each for line in lines], np.array([len(x) for x in each])


def fit_chain(runs: DataFrame) -> Chain:
    """Counts over all lines of rows with a known role."""

    def count(part: pa.Table) -> pa.Table:
        total = np.zeros(_N_COUNTS, np.int64)
        start, steps, seen = np.split(total, [N_STATES, N_STATES + N_STATES**2])  # views
        for _, rows in _conversations(part):
            last = None
            for row in rows:
                role = ROLES.index(row["role"]) if row["role"] in ROLES else _UNKNOWN
                for k, line in enumerate((row["raw"] or "").split("\n")):
                    if role == _UNKNOWN:
                        last = _UNKNOWN
                        continue
                    state = 2 * role + (k > 0)
                    if last is None:
                        start[state] += 1
                    elif last != _UNKNOWN:
                        steps[last * N_STATES + state] += 1
                    at = 0
                    for size, value in zip(_SIZES, line_features(line)):
                        seen[at + state * size + value] += 1
                        at += N_STATES * size
                    last = state
        return pa.table({"counts": pa.array([total.tolist()], pa.list_(pa.int64()))})

    summed = (
        runs.filter(F.col("role").isNotNull())
        .groupBy("part")
        .applyInArrow(count, "counts array<bigint>")
        .select(F.posexplode("counts").alias("slot", "n"))
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros(_N_COUNTS)
    for row in summed.collect():  # one row per parameter of the model
        counts[row.slot] = row.n
    return _chain(counts)


def cut_states(runs: DataFrame, chain: Chain) -> dict[int, dict[str, tuple[int | None, int, bool]]]:
    """For the conversations at the ends of parts that go on in another part: by part and end
    ("first", "last"), the state before the run, that at its end, and whether the conversation ends.

    Two matrices a part come back: their number is that of the partitions, not of the rows.
    """

    def ends(part: pa.Table) -> pa.Table:
        convs = list(_conversations(part))
        out = []
        for where, (conv, rows) in (("first", convs[0]), ("last", convs[-1])):
            emission = chain.emissions(_lines(rows)[0])
            fresh = _best_from(emission, chain.steps, chain.start[None, :])
            going = _best_from(emission, chain.steps, chain.steps)
            out.append(
                {"part": rows[0]["part"], "place": where, "conv": repr(conv), "whole": len(convs) == 1,
                 "fresh": fresh.ravel().tolist(), "going": going.ravel().tolist()}
            )
        floats = pa.list_(pa.float64())
        kinds = [("part", pa.int32()), ("place", pa.string()), ("conv", pa.string()), ("whole", pa.bool_()), ("fresh", floats), ("going", floats)]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    ddl = "part int, place string, conv string, whole boolean, fresh array<double>, going array<double>"
    rows = runs.groupBy("part").applyInArrow(ends, ddl).orderBy("part", "place").collect()
    found: dict[int, dict[str, tuple[int | None, int, bool]]] = {}
    chained: list = []

    def close() -> None:
        if len(chained) > 1:
            scores = [np.array(chained[0].fresh)]
            for r in chained[1:]:
                scores.append((scores[-1][:, None] + np.array(r.going).reshape(N_STATES, N_STATES)).max(0))
            state = int(scores[-1].argmax())
            for k in range(len(chained) - 1, -1, -1):
                r, final = chained[k], k == len(chained) - 1
                before = None
                if k:
                    before = int((scores[k - 1] + np.array(r.going).reshape(N_STATES, N_STATES)[:, state]).argmax())
                for where in ("first", "last") if r.whole else (r.place,):
                    found.setdefault(r.part, {})[where] = (before, state, final)
                state = before if before is not None else state
        chained.clear()

    for row in rows:
        if row.whole and row.place == "last":
            continue  # the same run as "first"
        if not (chained and row.place == "first" and chained[-1].conv == row.conv):
            close()
        chained.append(row)
    close()
    return found


RESULT = "conv_id {id}, turn {turn}, role string, recovered string, n_lines int, n_right int, n_turns int, rendered string"


def _render(lines: list[str], states: np.ndarray, opened: bool, closes: bool) -> str:
    out = []
    for line, state in zip(lines, states):
        if state % 2 == 0:
            out.append((CLOSE if opened else "") + OPEN.format(role=ROLES[state // 2]))
            opened = True
            line = marker_of(line)[1]
        out.append(line + "\n")
    return "".join(out) + (CLOSE if closes else "")


def format_chats(transcripts: DataFrame, chain: Chain | None = None, *, runs: DataFrame | None = None) -> DataFrame:
    """Recover roles and render turns: one row per row of ``transcripts`` (conv_id, turn, role, raw).

    ``raw`` is a piece of transcript, of one or more lines; ``role`` is what is known of it (null if
    nothing) and serves to fit the chain, if none is given, and to count ``n_right``, never to decode.
    Pieces of a conversation follow each other by turn, then text, nulls last.  ``recovered`` is the
    role of the piece's first line, ``n_turns`` how many turns begin in it, and ``rendered`` its part
    of the canonical text: the pieces of a conversation, joined in order, are the whole.

    A null conv_id is a conversation.  A null or empty text is one empty line.  Repeated rows are
    pieces of their own.  An empty table gives no rows.
    """
    if runs is None:
        runs = sorted_runs(transcripts)
    spark = runs.sparkSession
    with arrow_batches(spark, 2000):
        chain = chain or fit_chain(runs)
        cuts = cut_states(runs, chain)
        kinds = dict(runs.dtypes)

        def decode(part: pa.Table) -> pa.Table:
            out, convs = [], list(_conversations(part))
            for i, (_, rows) in enumerate(convs):
                at = cuts.get(rows[0]["part"], {})
                cut = at.get("first") if i == 0 else at.get("last") if i == len(convs) - 1 else None
                before, last, closes = cut or (None, None, True)
                lines, sizes = _lines(rows)
                states = viterbi(chain, chain.emissions(lines), before, last)
                first = np.cumsum(sizes) - sizes
                for k, (row, a, n) in enumerate(zip(rows, first, sizes)):
                    own = states[a : a + n]
                    role = ROLES.index(row["role"]) if row["role"] in ROLES else _UNKNOWN
                    out.append(
                        {"conv_id": row["conv_id"], "turn": row["turn"], "role": row["role"], "recovered": ROLES[own[0] // 2],
                         "n_lines": int(n), "n_right": int((own // 2 == role).sum()), "n_turns": int((own % 2 == 0).sum()),
                         "rendered": _render(lines[a : a + n], own, bool(k) or before is not None, closes and k == len(rows) - 1)}
                    )
            schema = pa.schema(
                [part.schema.field("conv_id"), part.schema.field("turn"), ("role", pa.string()), ("recovered", pa.string()),
                 ("n_lines", pa.int32()), ("n_right", pa.int32()), ("n_turns", pa.int32()), ("rendered", pa.string())]
            )
            return pa.Table.from_pylist(out, schema)

        done = runs.groupBy("part").applyInArrow(decode, RESULT.format(id=kinds["conv_id"], turn=kinds["turn"]))
        return materialize(done, label="chat-turns")


def rough_transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts of mixed styles: markers by a hash of conv_id, one in four left out."""
    styles = [("{}: ", 0), ("[{}] ", 1), ("**{}**: ", 2), ("<|{}|> ", 3)]
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(styles)))
    missing = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    marker: Column = F.lit("")
    for shape, k in styles:
        for role, words in _MARKERS.items():
            word = words[k % len(words)]
            marker = F.when((style == k) & (F.col("role") == role), F.lit(shape.format(word.capitalize()))).otherwise(marker)
    marker = F.when(missing, F.lit("")).otherwise(marker)
    return conversations.select("conv_id", "turn", "role", F.concat(marker, F.coalesce("text", F.lit(""))).alias("raw"))
