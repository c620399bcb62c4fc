"""Repair of conversations by a generalised LR search for the cheapest edits that make the roles fit a grammar.

**Grammar.** A conversation is empty, or turns of user and assistant behind an optional system message. Its LR table is built
below from the rules. Stacks with one top accept the same continuations, so the graph-structured stack keeps one node per
top, the one with the smallest (cost, audit). Before each row up to two rows may be inserted (a third would repeat a top), then
the row is kept, given another role or deleted.

**Faults** and counts are joins and aggregates over narrow rows (conversation, turn, role, digests of the text); rows that agree
in all of these are one row with a number of copies, of which all but the first are duplicates.

**Blocks.** Narrow rows are range-partitioned by conversation and turn, so a long conversation lies in several partitions. A
conversation inside one partition is repaired in one pass. For those that span several, at most one per partition border,
each part gives the best (cost, audit) from each top to each top; joining these in order gives every part its audit, and
the parts are then replayed on their own. Audits of equal letters belong to equal rows, and none is the beginning of another,
so the order of joined audits is that of their parts.

**Texts** are joined to the rows that are left. Only a digest over a whole conversation reads its texts one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import staged

WORDLESS = r"[\x20\x09-\x0D]"
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
SPOKEN = {"u": "user", "a": "assistant"}

RULES = [
    ("whole", ("talk",)),
    ("talk", ()),
    ("talk", ("s", "turns")),
    ("talk", ("turns",)),
    ("turns", ("turns", "turn")),
    ("turns", ("turn",)),
    ("turn", ("u", "a")),
]
END = "$"


class LRTable:
    """States of dotted rules, their moves, and which rule is reduced in front of which token (SLR)."""

    def __init__(self, rules: list[tuple[str, tuple[str, ...]]]):
        self.rules = rules
        self.named = {head for head, _ in rules}
        self.following = self._following()
        start = self._closed({(0, 0)})
        self.states, self.moves = [start], {}
        for number, state in enumerate(self.states):  # grows while it is read
            for symbol in {rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])}:
                moved = self._closed({(r, dot + 1) for r, dot in state if rules[r][1][dot : dot + 1] == (symbol,)})
                if moved not in self.states:
                    self.states.append(moved)
                self.moves[number, symbol] = self.states.index(moved)

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        pending = list(items)
        while pending:
            r, dot = pending.pop()
            wanted = self.rules[r][1][dot : dot + 1]
            new = {(i, 0) for i, (head, _) in enumerate(self.rules) if (head,) == wanted} - items
            items |= new
            pending += new
        return frozenset(items)

    def _following(self) -> dict[str, set[str]]:
        """Tokens that may come behind a name. No rule's right side but that of the empty one can vanish."""

        def leading(symbol: str, seen: frozenset = frozenset()) -> set[str]:
            if symbol not in self.named:
                return {symbol}
            bodies = [body for head, body in self.rules if head == symbol and body and head not in seen]
            return set().union(*[leading(body[0], seen | {symbol}) for body in bodies])

        after: dict[str, set[str]] = {name: set() for name in self.named}
        after[self.rules[0][0]].add(END)
        for _ in self.rules:
            for head, body in self.rules:
                for i, symbol in enumerate(body):
                    if symbol in self.named:
                        after[symbol] |= leading(body[i + 1]) if i + 1 < len(body) else after[head]
        return after

    def shifted(self, stack: tuple[int, ...], token: str) -> tuple[int, ...] | None:
        """The stack after all reductions in front of the token and its shift; at the end, the accepting stack."""
        while True:
            if (stack[-1], token) in self.moves:
                return stack + (self.moves[stack[-1], token],)
            done = [r for r, dot in self.states[stack[-1]] if dot == len(self.rules[r][1]) and token in self.following[self.rules[r][0]]]
            if not done:
                return None
            if done == [0]:
                return stack
            ((head, body),) = [self.rules[r] for r in done]
            stack = stack[: len(stack) - len(body)]
            stack += (self.moves[stack[-1], head],)


def _tops(table: LRTable, tokens: str) -> tuple[dict[tuple[int, str], int], list[bool]]:
    """Moves between the tops that a shift leaves, numbered from 0 for the empty stack, and which tops accept."""
    stacks, moves = [(0,)], {}
    tops = [0]
    for number, stack in enumerate(stacks):  # grows while it is read
        for token in tokens:
            after = table.shifted(stack, token)
            if after is None:
                continue
            if after[-1] not in tops:
                tops.append(after[-1])
                stacks.append(after)
            moves[number, token] = tops.index(after[-1])
    return moves, [table.shifted(stack, END) is not None for stack in stacks]


MOVES, ACCEPTING = _tops(LRTable(RULES), "sua")
TOPS = range(len(ACCEPTING))
Step = tuple[int, int, int, str]  # from top, to top, cost, letters


def _inserted(top: int) -> list[tuple[int, str]]:
    """Tops within two inserted rows, the top itself first."""
    found = [(top, "")]
    for _ in range(2):
        at, letters = found[-1]
        following = [MOVES[at, role] for role in SPOKEN if (at, role) in MOVES]
        if not following:
            break
        found.append((following[0], letters + "I"))  # of user and assistant only one may come next
    return found


def _steps(initial: str, must_go: bool, truncated: bool) -> list[Step]:
    """The cheapest edits of one row from top to top, of equally cheap ones the first in ASCII order."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in TOPS:
        for top, inserts in _inserted(start):
            options = [(top, "D")]
            if not must_go:
                options += [(MOVES[top, initial], "K")] if (top, initial) in MOVES else []
                options += [(MOVES[top, role], "R") for role in SPOKEN if (top, role) in MOVES]
            for end, edit in options:
                cost = COSTS["I"] * len(inserts) + COSTS[edit] + (TRUNCATED_COST if truncated and edit != "D" else 0)
                step = (cost, inserts + edit)
                best[start, end] = min(best.get((start, end), step), step)
    return [(start, end, *step) for (start, end), step in best.items()]


STEPS = {(i, must_go, cut): _steps(i, must_go, cut) for i in ("s", "u", "a", "") for must_go in (False, True) for cut in (False, True)}
ENDINGS = [
    min((COSTS["I"] * len(letters), letters) for end, letters in _inserted(top) if ACCEPTING[end]) for top in TOPS
]


def best_audits(rows: list[tuple[str, bool, bool, int]], start: int) -> dict[int, tuple[int, str]]:
    """Per reachable top the cheapest (cost, audit) of the rows ``(initial, must go, truncated, copies)``.

    Audits of one length in rows are compared by rank: that of the audit so far, then the new letters.
    """
    front = {start: (0, 0)}  # top: cost, rank
    trail: list[dict[int, tuple[int, str]]] = []
    for initial, must_go, truncated, copies in rows:
        found: dict[int, tuple[int, int, str, int]] = {}
        for begin, end, cost, letters in STEPS[initial if initial in ("s", "u", "a") else "", must_go, truncated]:
            if begin in front:
                known = front[begin]
                step = (known[0] + cost, known[1], letters, begin)
                if end not in found or step < found[end]:
                    found[end] = step
        ranks = {key: n for n, key in enumerate(sorted({step[1:3] for step in found.values()}))}
        more = COSTS["D"] * (copies - 1)
        front = {end: (step[0] + more, ranks[step[1:3]]) for end, step in found.items()}
        trail.append({end: (step[3], step[2] + "D" * (copies - 1)) for end, step in found.items()})
    audits = {}
    for end, (cost, _) in front.items():
        letters, top = [], end
        for back in reversed(trail):
            top, piece = back[top]
            letters.append(piece)
        audits[end] = (cost, "".join(reversed(letters)))
    return audits


def whole_audit(rows: list[tuple[str, bool, bool, int]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min((cost + ENDINGS[end][0], audit + ENDINGS[end][1]) for end, (cost, audit) in best_audits(rows, 0).items())


def replayed(initials: list[str], copies: list[int], audit: str, top: int) -> list[tuple[int | None, str | None]]:
    """What an audit leaves: (row number, new role). A kept row has no new role, an inserted one no number."""
    left, letters = [], iter(audit)

    def spoken(top: int) -> tuple[str, int]:
        (role,) = [r for r in SPOKEN if (top, r) in MOVES]
        return role, MOVES[top, role]

    def insert() -> None:
        nonlocal top
        role, top = spoken(top)
        left.append((None, SPOKEN[role]))

    for number, initial in enumerate(initials):
        for copy in range(copies[number]):
            letter = next(letters)
            while letter == "I":
                insert()
                letter = next(letters)
            if letter == "K":
                top = MOVES[top, initial]
                left.append((number, None))
            elif letter == "R":
                role, top = spoken(top)
                left.append((number, SPOKEN[role]))
    for _ in letters:
        insert()
    return left


def _illegal(initials: list[str], copies: list[int]) -> int:
    between = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return between + sum(copies) - len(copies)


ROW = ["conv", "part", "at", "role", "d1", "d2", "copies", "must_go", "truncated", "spans"]
LEFT = ["conv", "part", "i", "at", "role", "d1", "d2", "said", "start", "end", "cost", "audit", "illegal", "lead", "last"]
LEFT_SHAPE = (
    "conv string, part int, i int, at string, role string, d1 bigint, d2 bigint, said string, "
    "start int, end int, cost bigint, audit string, illegal bigint, lead string, last string"
)


def _left_rows(rows: list[tuple], left: list[tuple[int | None, str | None]]) -> list[tuple]:
    conv, part = rows[0][:2]
    out = []
    for i, (number, said) in enumerate(left):
        at, role, d1, d2 = (None,) * 4 if number is None else rows[number][2:6]
        out.append((conv, part, i, at, role, d1, d2, said or role, *(None,) * 7))
    return out


def _repaired_block(rows: list[tuple]) -> list[tuple]:
    """A whole conversation: its repaired rows and a summary. A part of one: summaries from each top to each top."""
    conv, part, spans = *rows[0][:2], rows[0][9]
    initials, copies = [r[3][:1] for r in rows], [r[6] for r in rows]
    edits = [(initial, bool(r[7]), bool(r[8]), r[6]) for initial, r in zip(initials, rows)]
    facts = (_illegal(initials, copies), initials[0], initials[-1])
    head = (conv, part, -1, *(None,) * 5)
    if not spans:
        cost, audit = whole_audit(edits)
        return [(*head, 0, None, cost, audit, *facts), *_left_rows(rows, replayed(initials, copies, audit, 0))]
    return [(*head, start, end, *best, *facts) for start in TOPS for end, best in best_audits(edits, start).items()]


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come ordered by conversation, part and turn; a part is no longer than a range partition."""
    rows: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(batch[c].tolist() for c in ROW)):
            if rows and row[:2] != rows[0][:2]:
                out += _repaired_block(rows)
                rows = []
            rows.append(row)
        yield pd.DataFrame(out, columns=LEFT, dtype=object)
    if rows:
        yield pd.DataFrame(_repaired_block(rows), columns=LEFT, dtype=object)


def _joined_parts(parts: pd.DataFrame) -> pd.DataFrame:
    """One conversation over several parts: its cost, and the audit and first top of every part."""
    front: dict[int, tuple[int, tuple[str, ...], tuple[int, ...]]] = {0: (0, (), ())}
    numbers, illegal, last = [], 0, None
    for part, rows in parts.groupby("part", sort=True):
        found: dict[int, tuple] = {}
        for start, end, cost, audit in zip(rows["start"], rows["end"], rows["cost"], rows["audit"]):
            if start in front:
                known = front[start]
                step = (known[0] + cost, (*known[1], audit), (*known[2], start))
                found[end] = min(found.get(end, step), step)
        front = found
        numbers.append(part)
        illegal += rows["illegal"].iloc[0] + (last is not None and last + rows["lead"].iloc[0] not in ("su", "ua", "au"))
        last = rows["last"].iloc[0]
    options = [(cost + ENDINGS[e][0], (*audits[:-1], audits[-1] + ENDINGS[e][1]), starts) for e, (cost, audits, starts) in front.items()]
    cost, audits, starts = min(options)
    rows = [(parts["conv"].iloc[0], n, a, s, cost, illegal) for n, a, s in zip(numbers, audits, starts)]
    return pd.DataFrame(rows, columns=["conv", "part", "audit", "start", "cost", "illegal"])


def _replayed_part(rows: pd.DataFrame, decided: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("row")
    listed = list(zip(*(rows[c].tolist() for c in ROW)))
    left = replayed([r[3][:1] for r in listed], [r[6] for r in listed], decided["audit"].iloc[0], int(decided["start"].iloc[0]))
    return pd.DataFrame(_left_rows(listed, left), columns=LEFT, dtype=object)


def _key(column: Column) -> Column:
    """Text that tells values apart, a missing one included."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Conversations as a careless export leaves them, by checksum of ``conv_id:turn``: a twentieth each of the rows is dropped,
    emptied, loses its end marks, stands twice, or is given to the user. Missing roles and texts become one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    kept = rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return kept.drop("copy")


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """What ails each conversation and its cheapest repair, and the repaired rows.

    The first table has one row per conversation: ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``. The second has
    ``(conv, part, i, role, text)`` with the rows in order of part and i. Both carry the conversation's id under its own name
    instead of ``conv``.

    Rows are taken by turn, missing turns first, rows of one turn by role and digest of the text. A row is blank without any
    character but ASCII white space, else a duplicate if role and text stood before, else truncated if its last such
    character is none of ``.!?``. Blank and duplicate rows must go. Rows without a conversation are one conversation. A missing
    role or text counts as one space. Repeated rows are duplicates; rows of one turn that differ are different rows. Texts of
    any length are handled, and only their digests are moved to decide. Other columns play no part. An empty table gives
    empty tables.
    """
    text = F.coalesce(F.col(text_col), F.lit(" "))
    whole = rows.select(
        _key(F.col(conv_col)).alias("conv"),
        F.col(turn_col).alias("turn"),
        _key(F.col(turn_col)).alias("at"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        *(F.xxhash64(F.lit(n), text).alias(f"d{n}") for n in (1, 2)),
        text.alias("text"),
    )
    same = ["conv", "at", "role", "d1", "d2"]
    blank = ~F.col("text").rlike(rf"[^\x20\x09-\x0D]")
    truncated = ~blank & ~F.col("text").rlike(rf"[.!?]{WORDLESS}*\z")
    narrow = whole.select(*same, "turn", blank.alias("blank"), truncated.alias("truncated"))
    narrow = narrow.groupBy(*same, "turn").agg(
        F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")
    )
    narrow = staged(narrow, "narrow")
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    said = ["conv", "role", "d1", "d2"]
    first = narrow.groupBy(*said).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = narrow.join(first.hint("merge"), said, "left").withColumn("again", F.coalesce(place > F.col("first"), F.lit(False)))
    ordered = marked.repartitionByRange("conv", "turn", "role", "d1", "d2").sortWithinPartitions("conv", "turn", "role", "d1", "d2")
    ordered = staged(ordered.drop("first").withColumn("part", F.spark_partition_id()), "ordered")

    fresh = ~F.col("blank") & ~F.col("again")
    turns = ordered.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(fresh, F.col("copies") - 1).when(F.col("blank"), 0).otherwise(F.col("copies"))).alias("duplicate"),
        F.count_if(fresh & F.col("truncated")).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")
    counts = turns.groupBy("conv").agg(gaps, *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))

    spanning = ordered.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b")
    spanning = F.broadcast(spanning.select("conv", F.lit(True).alias("spans")))  # at most one per border of two partitions
    blocks = ordered.join(spanning, "conv", "left").select(
        *(c for c in ROW if c not in ("must_go", "truncated", "spans")),
        (F.col("blank") | F.col("again")).alias("must_go"),
        "truncated",
        F.coalesce("spans", F.lit(False)).alias("spans"),
        F.struct("turn", "role", "d1", "d2").alias("row"),
    )
    blocks = staged(blocks, "blocks")
    dealt = blocks.repartition("conv", "part").sortWithinPartitions("conv", "part", "row").select(*ROW)
    searched = staged(dealt.mapInPandas(_repaired, LEFT_SHAPE), "searched")
    summaries = searched.where("i < 0")
    shape = "conv string, part int, audit string, start int, cost bigint, illegal bigint"
    decided = staged(summaries.where("end is not null").groupBy("conv").applyInPandas(_joined_parts, shape), "decided")
    pieces = F.array_sort(F.collect_list(F.struct("part", "audit")))["audit"]
    long_ones = decided.groupBy("conv").agg(F.first("cost").alias("cost"), F.array_join(pieces, "").alias("audit"), F.first("illegal").alias("illegal"))
    short_ones = summaries.where("end is null").select("conv", "cost", "audit", "illegal")
    left = searched.where("i >= 0")
    if not decided.isEmpty():
        parts = blocks.where("spans").withColumn("row", F.struct("row.turn", "row.role", "row.d1", "row.d2"))
        numbered = parts.withColumn("row", F.expr("row_number() over (partition by conv, part order by row)"))
        replay = numbered.groupBy("conv", "part").cogroup(decided.groupBy("conv", "part")).applyInPandas(_replayed_part, LEFT_SHAPE)
        left = left.unionByName(replay)
    result = counts.join(short_ones.unionByName(long_ones), "conv")

    texts = whole.groupBy(*same).agg(F.first("text").alias("text"))
    left = left.select("conv", "part", "i", "at", "role", "d1", "d2", "said")
    repaired = left.join(texts.hint("merge"), same, "left")
    kind = rows.schema[conv_col].dataType
    conv = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias(conv_col)
    repaired = repaired.select(conv, "part", "i", F.col("said").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return result.select(conv, *(F.col(c).cast("bigint").alias(c) for c in numbers), "audit"), repaired


def conversation_digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``(conv_col, repaired_sha256)``: the digest of each conversation's ``role:text`` lines.

    A digest needs its lines in order, so the lines of a conversation pass one task, which keeps the running digest only.
    """
    key = _key(F.col(conv_col)).alias("conv")
    lines = repaired.select(key, "part", "i", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "part", "i").select("conv", "line")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, running = None, None
        for batch in batches:
            done = []
            for name, line in zip(batch["conv"].tolist(), batch["line"].tolist()):
                if name != conv:
                    if running is not None:
                        done.append((conv, running.hexdigest()))
                    conv, running = name, hashlib.sha256(line.encode())
                else:
                    running.update(b"\n" + line.encode())
            yield pd.DataFrame(done, columns=["conv", "repaired_sha256"], dtype=object)
        if running is not None:
            yield pd.DataFrame([(conv, running.hexdigest())], columns=["conv", "repaired_sha256"], dtype=object)

    found = lines.mapInPandas(digests, "conv string, repaired_sha256 string")
    kind = repaired.schema[conv_col].dataType
    back = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias(conv_col)
    return found.select(back, "repaired_sha256")
