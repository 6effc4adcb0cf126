"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

What is wanted is an optional system turn and then pairs of a user's and an assistant's turn. An
edit script keeps, rewrites the role of, deletes or inserts turns; its nodes are (turns consumed,
state), and the state is what the last turn left is: none (.), s, u or a. A* finds the cheapest
script, the least in ASCII among equals, from a heap keyed (cost so far plus heuristic, script). The
heuristic sums what the turns ahead cost anyhow: a deletion for each blank or repeated one, the
charge for each one cut off, which no edit undercuts.

A conversation is read in order, ``BLOCK`` turns at a time. Between blocks only the best script that
ends in each state counts, for no script continues it in another way; a script's insertions before
a turn belong to that turn's block, so scripts of different states never begin one another and
their order is settled for good.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.session import ship

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
BLOCK = 256
#: The state that a turn of each role leads to.
AFTER = {(".", "s"): "s", (".", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
#: The role that may be put in or written over in each state.
NEXT = {".": "u", "s": "u", "a": "u", "u": "a"}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
FILLED = re.compile(r"[^\x20\x09-\x0D]")
END = frozenset(".!?")
SPACES = " \t\n\x0b\x0c\r"
BLANK, REPEATED, CUT, FINE = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of rows damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's.
    A null counts as one space in the hash, the role and the text; conv_id and turn stay null.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), draw.alias("draw")).where("draw <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.when(F.col("draw") == 3, F.lit([0, 1])).otherwise(F.lit([0]))).alias("copy"))
    return out.drop("copy")


def fault(role: str, text: str, seen: set[bytes]) -> int:
    """The first fault of a turn, which is added to ``seen``."""
    if not FILLED.search(text):
        return BLANK
    mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    if mark in seen:
        return REPEATED
    seen.add(mark)
    return FINE if text.rstrip(SPACES)[-1] in END else CUT


def search(roles: list[str], faults: list[int], state: str, last: bool) -> dict[str, tuple[int, str]]:
    """The best (cost, script) from ``state`` over a block of turns to each state after them.

    ``last``: the conversation ends here, so insertions may follow, and the one best end is all
    that is returned. Otherwise no script ends with an insertion.
    """
    n = len(roles)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if faults[i] in (BLANK, REPEATED) else min(CUT_OFF, DELETE) if faults[i] == CUT else 0)
    heap, done, ends = [(ahead[0], "", 0, state)], set(), {}
    while heap:
        bound, script, i, at = heapq.heappop(heap)
        cost = bound - ahead[i]
        if i == n and not last:
            if script[-1:] != "I":
                ends.setdefault(at, (cost, script))
            continue
        if (i, at) in done:
            continue
        done.add((i, at))
        if i == n and at in ".a":
            return {at: (cost, script)}
        need = NEXT[at]
        heapq.heappush(heap, (bound + INSERT, script + "I", i, need))
        if i == n:
            continue
        heapq.heappush(heap, (cost + DELETE + ahead[i + 1], script + "D", i + 1, at))
        if faults[i] in (BLANK, REPEATED):
            continue
        charge = CUT_OFF if faults[i] == CUT else 0
        kept = AFTER.get((at, roles[i]))
        if kept:
            heapq.heappush(heap, (cost + KEEP + charge + ahead[i + 1], script + "K", i + 1, kept))
        heapq.heappush(heap, (cost + REROLE + charge + ahead[i + 1], script + "R", i + 1, need))
    return ends


@dataclass
class Path:
    """The best script that ends in one state, and a running hash of what it makes of the turns."""

    cost: int
    rank: int
    script: list = field(default_factory=list)
    sha: object = field(default_factory=hashlib.sha256)
    started: bool = False


class Repair:
    """One conversation, of which a block of turns is held at a time."""

    def __init__(self):
        self.paths = {".": Path(0, 0)}
        self.rows: list[tuple[str, str]] = []
        self.faults: list[int] = []
        self.counts = [0, 0, 0, 0]
        self.seen: set[bytes] = set()
        self.least = self.most = self.turn = self.before = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if len(self.rows) == BLOCK:
            self._advance(False)
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.least, self.most, self.turn = turn if self.least is None else self.least, turn, turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        self.faults.append(fault(role, text, self.seen))
        self.counts[self.faults[-1]] += 1
        self.rows.append((role, text))

    def _advance(self, last: bool) -> None:
        initials = [role[:1] for role, _ in self.rows]
        found: dict[str, tuple[int, int, str, str]] = {}
        for start, path in self.paths.items():
            for end, (cost, script) in search(initials, self.faults, start, last).items():
                found[end] = min(found.get(end, (1 << 62,)), (path.cost + cost, path.rank, script, start))
        order = {end: k for k, end in enumerate(sorted(found, key=lambda e: found[e][1:3]))}
        self.paths = {end: self._extend(self.paths[start], start, cost, order[end], script) for end, (cost, _, script, start) in found.items()}
        self.rows, self.faults = [], []

    def _extend(self, path: Path, state: str, cost: int, rank: int, script: str) -> Path:
        sha, started, rows = path.sha.copy(), path.started, iter(self.rows)
        for edit in script:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit == "D":
                continue
            made = role if edit == "K" else ROLES[NEXT[state]]
            state = AFTER[state, made[:1]]
            sha.update((("\n" if started else "") + f"{made}:{text}").encode("utf-8", "surrogatepass"))
            started = True
        return Path(cost, rank, [path.script, script], sha, started)

    def result(self) -> dict:
        self._advance(True)
        best = min(self.paths.values(), key=lambda p: (p.cost, p.rank))
        parts, at = [], best.script
        while at:  # scripts of the blocks, from the last one back
            at, part = at
            parts.append(part)
        return {
            "gaps": self.most - self.least + 1 - self.turns if self.turns else 0,
            "blank": self.counts[BLANK], "duplicate": self.counts[REPEATED], "truncated": self.counts[CUT],
            "illegal": self.illegal, "cost": best.cost, "audit": "".join(reversed(parts)), "repaired_sha256": best.sha.hexdigest(),
        }


RESULT = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows: DataFrame) -> DataFrame:
    """A row for each conv_id: counts of its faults, the cost and script of its repair, and the hash of what it becomes.

    rows needs conv_id, turn, role and text, of which role and text are not null. Turns are taken
    in the order of turn (null first), then role, then text. conv_id comes back as text, null as null.
    Turns are dealt by conv_id, sorted by Spark, and streamed: a block of turns, a digest of each
    different one and the script are held, never a conversation's texts. The hash runs over a whole
    conversation, so one task has to see it all.
    """
    ship(rows.sparkSession)
    key = F.col("conv_id").cast("string")
    # a flag keeps a null id apart from any text
    dealt = rows.select(key.isNull().alias("none"), F.coalesce(key, F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"), "role", "text")
    dealt = dealt.repartition("none", "key").sortWithinPartitions("none", "key", F.asc_nulls_first("turn"), "role", "text")
    dealt = dealt.select("none", "key", F.col("turn").cast("string").alias("turn"), "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, out = None, None, []
        for batch in batches:
            for none, name, turn, role, text in zip(*(batch[c].tolist() for c in ("none", "key", "turn", "role", "text"))):
                if (none, name) != at:
                    if held:
                        out.append({"conv_id": None if at[0] else at[1]} | held.result())
                    at, held = (none, name), Repair()
                held.add(int(turn) if isinstance(turn, str) else None, role, text)
            if out:
                yield pd.DataFrame(out)
                out = []
        if held:
            yield pd.DataFrame([{"conv_id": None if at[0] else at[1]} | held.result()])

    return dealt.mapInPandas(run, RESULT)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """What ``repaired`` says of the damaged conversations, a row for each conv_id of theirs, also null.

    A conversation of which no row is left has zeros, an empty script and the hash of nothing.
    Other columns of conversations are left out, whatever their names.
    """
    kind = conversations.schema["conv_id"].dataType
    none: Column = F.sha2(F.lit("").cast("binary"), 256)
    # of a conversation that loses all rows, a mark stays; grouping merges marks before they are dealt
    marks = conversations.select(F.col("conv_id").cast("string").alias("conv_id")).distinct()
    told = repaired(damaged(conversations)).withColumnRenamed("conv_id", "_conv")
    out = marks.join(told, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("conv_id").cast(kind).alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
