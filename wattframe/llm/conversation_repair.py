"""Conversations put back into the order of an opening and exchanges, by the cheapest edits."""

import hashlib
import itertools
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, prepare

#: What a conversation may be, by the first letters of its roles: nothing, or s?(ua)+. START has no turn yet.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Whose turn follows a state when a turn is written anew.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
BLANK, DUPLICATE, TRUNCATED, SOUND = "blank", "duplicate", "truncated", "sound"
_ENDS = (".", "!", "?")

#: A turn for the search: the first letter of its role ("" if it has none) and its fault.
Turn = tuple[str, str]

_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired array<struct<role: string, text: string>>"
)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with faults put in by a checksum of conv_id and turn, for trials.

    Of 20 turns one is dropped, one emptied, one loses its sentence marks, one
    comes twice and one becomes the user's. A NULL counts as one space in the
    checksum, a role and a text. Dropped turns are marked in ``dropped``, so that
    their conversations aren't forgotten. Other columns are left out.
    """
    space = F.lit(" ")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(named.cast("binary")) % 20
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        times.alias("time"),
    )
    return rows.drop("time")


def repair(turns: DataFrame, dropped: Column | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults, and its cheapest repair.

    Turns go in the order of turn, NULL first; ties in that of role and text. A
    NULL role or text counts as one space. Rows that ``dropped`` marks don't take
    part, but their conversations are returned. Rows without conv_id are a
    conversation of their own. Other columns are ignored; an empty table gives
    an empty result. A role's first letter is case-sensitive, and a turn whose
    role is empty or begins with another letter than s, u or a can't be kept as
    it is.

    A turn's first fault counts: blank, duplicate (role and text came before in
    the conversation) or truncated (doesn't end in a sentence mark). Blank and
    duplicate turns must be deleted (D, 4). Other turns are kept (K), or become
    the user's or assistant's (R, 3), for 3 more if truncated. Empty turns can be
    inserted (I, 3). The result reads ``s?(ua)+`` by first letters, or is empty.

    Returns conv_id, gaps (turns missing between the first and the last), blank,
    duplicate, truncated, illegal (neighbours that are not su, ua or au), cost,
    audit (letters of the edits, the first in ASCII order of the cheapest) and
    repaired (role and text of each turn).

    Conversations are dealt by conv_id and sorted; a worker holds one of them at
    a time. The time to repair one grows with its turns, whatever its faults.
    """
    prepare(turns.sparkSession)
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))).alias("dropped"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInArrow(_repairs, _SCHEMA)


def faults(turns: Iterable[tuple[str, str]]) -> list[str]:
    """The first fault of each (role, text) of a conversation."""
    found, seen = [], set()
    for role, text in turns:
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        stripped = text.rstrip(BLANKS)
        if not stripped:
            found.append(BLANK)
        elif digest in seen:
            found.append(DUPLICATE)
        else:
            found.append(SOUND if stripped.endswith(_ENDS) else TRUNCATED)
        seen.add(digest)
    return found


def _least_costs(turns: Sequence[Turn]) -> tuple[list[int], list[int], list[int]]:
    """What the turns from each place on cost at least: before any turn, on the user's turn, on the assistant's.

    The problem is relaxed: an opening need not be followed by an exchange. Costs
    of the relaxed problem are found from the end.
    """
    begin, user, assistant = [0], [0], [INSERT]
    for letter, fault in reversed(turns):
        b, u, a = begin[-1], user[-1], assistant[-1]
        if fault in (BLANK, DUPLICATE):
            b, u, a = b + DELETE, u + DELETE, a + DELETE
        else:
            more = CUT_OFF if fault == TRUNCATED else 0
            to_assistant = more + a + (0 if letter == "u" else REROLE)
            to_user = more + u + (0 if letter == "a" else REROLE)
            b = min(b + DELETE, to_assistant, more + u if letter == "s" else to_assistant)
            u, a = min(u + DELETE, to_assistant), min(a + DELETE, to_user)
        u, a = min(u, INSERT + a), min(a, INSERT + u)
        begin.append(min(b, INSERT + a))
        user.append(u)
        assistant.append(a)
    return begin[::-1], user[::-1], assistant[::-1]


def cheapest_edits(turns: Sequence[Turn]) -> tuple[int, str]:
    """The least cost of edits that make a conversation legal, and their letters; the first in ASCII order of all such.

    Iterative-deepening A*: a depth-first search tries D, I, K and R in this
    order within a bound on the cost, which rises to the least cost that was
    still possible beyond it. A table keeps, for each state that failed (place
    and last role), what it costs at least, so none is searched twice within
    the same means. As the bound never passes over the least cost and edits are
    tried in ASCII order, the first accepting path is the answer.
    """
    n = len(turns)
    begin, user, assistant = _least_costs(turns)
    least = (begin, user, assistant, user)  # by START, SYSTEM, USER, ASSISTANT
    failed: dict[tuple[int, int], int] = {}

    def moves(at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if at < n:
            yield "D", DELETE, at + 1, state
        yield "I", INSERT, at, _NEXT[state]
        if at < n and turns[at][1] not in (BLANK, DUPLICATE):
            letter, fault = turns[at]
            more = CUT_OFF if fault == TRUNCATED else 0
            kept = _KEPT.get((state, letter))
            if kept is not None:
                yield "K", more, at + 1, kept
            yield "R", REROLE + more, at + 1, _NEXT[state]

    bound = begin[0]
    while True:
        # a frame: place, state, cost so far, moves not yet tried, least cost from here beyond the bound
        frames = [[0, START, 0, moves(0, START), None]]
        path: list[str] = []
        while frames:
            at, state, spent, open_moves, _ = frames[-1]
            if at == n and state in (START, ASSISTANT):
                return spent, "".join(path)
            for letter, cost, to, reached in open_moves:
                rest = max(least[reached][to], failed.get((to, reached), 0))
                if spent + cost + rest <= bound:
                    frames.append([to, reached, spent + cost, moves(to, reached), None])
                    path.append(letter)
                    break
                if frames[-1][4] is None or cost + rest < frames[-1][4]:
                    frames[-1][4] = cost + rest
            else:
                beyond = frames.pop()[4]
                failed[at, state] = max(beyond, failed.get((at, state), 0))
                if frames:
                    path.pop()
                    above = spent - frames[-1][2] + failed[at, state]
                    if frames[-1][4] is None or above < frames[-1][4]:
                        frames[-1][4] = above
        bound = failed[0, START]


def edited(turns: Sequence[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The (role, text) of a conversation after the edits."""
    done, rest, state = [], iter(turns), START
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rest)
        if letter == "D":
            continue
        state = _KEPT[state, role[0]] if letter == "K" else _NEXT[state]
        done.append((role if letter == "K" else _ROLE[state], text))
    return done


def repaired(numbers: Sequence[int | None], turns: Sequence[tuple[str, str]]) -> dict:
    """All that ``repair`` returns of one conversation, from its turn numbers and its roles and texts in order."""
    known = [t for t in numbers if t is not None]
    found = faults(turns)
    letters = [role[:1] for role, _ in turns]
    cost, audit = cheapest_edits(list(zip(letters, found, strict=True)))
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": found.count(BLANK),
        "duplicate": found.count(DUPLICATE),
        "truncated": found.count(TRUNCATED),
        "illegal": sum(a + b not in _LEGAL for a, b in itertools.pairwise(letters)),
        "cost": cost,
        "audit": audit,
        "repaired": [{"role": r, "text": t} for r, t in edited(turns, audit)],
    }


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped")), strict=True)


def _repairs(batches: Iterable[pa.RecordBatch], together: int = 200) -> Iterator[pa.RecordBatch]:
    done: list[dict] = []
    for conv_id, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
        there = [row for row in rows if not row[4]]
        done.append({"conv_id": conv_id, **repaired([r[1] for r in there], [(r[2], r[3]) for r in there])})
        if len(done) == together or len(there) > together:
            yield _batch(done)
            done = []
    if done:
        yield _batch(done)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = [("conv_id", pa.int64()), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired", pa.list_(turn))]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(schema))
