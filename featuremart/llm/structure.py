"""Cheapest repair of damaged conversations, by dynamic programming over a grammar.

A conversation is a string of symbols, one a row: the row's role and fault.  Re-Pair rules
name frequent pairs of symbols.  A symbol has a min-plus matrix: for each state before and
after it the least cost and the edits that cost it.  A rule's matrix is the product of its
two symbols', worked out once, bottom-up, and shared by all conversations.

States are what the repaired part ends with: nothing, system, user, assistant.  Edits are
Delete, Insert, Keep and Rerole; a matrix allows inserts before its row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import arrow_map, record_batch, written

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
INITIALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
#: State that a role leads to from each state; what is not here can't follow.
FOLLOWS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: States that a conversation may end in.
FINAL = (0, 3)
LETTERS = "DIKR"
#: Symbols are characters from here on: one for rows that must go, then role (or other) and truncated or not.
FIRST = 0x21
GONE = chr(FIRST)
TERMINALS = [chr(FIRST + i) for i in range(9)]
#: A pair becomes a rule while it holds one in so many symbols, so that there are no more rules than that.
RULE_SHARE = 1_024
#: Symbols of a segment; a longer conversation is several, joined by their matrices.
SEGMENT = 4_096
#: Equal rows that are one row before they are dealt out again.
RUN = 1_000

Matrix = tuple  # 16 entries, from state * 4 + to state: (cost, node of the rope) or None


class Ropes:
    """Edit strings as trees that share their parts.  Node 0 is empty, 1 to 4 are the letters."""

    def __init__(self) -> None:
        self.left = [-1] * 5
        self.right = [-1] * 5

    def join(self, a: int, b: int) -> int:
        if not a or not b:
            return a or b
        self.left.append(a)
        self.right.append(b)
        return len(self.left) - 1

    def letters(self, *letters: str) -> int:
        node = 0
        for letter in letters:
            node = self.join(node, 1 + LETTERS.index(letter))
        return node

    def text(self, node: int) -> str:
        out, waiting = [], [node] if node else []
        while waiting:
            at = waiting.pop()
            if self.left[at] < 0:
                out.append(LETTERS[at - 1])
            else:
                waiting += (self.right[at], self.left[at])
        return "".join(out)

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes first; equal parts that are shared aren't read."""
        ours, theirs = [a] if a else [], [b] if b else []
        while ours and theirs:
            x, y = ours.pop(), theirs.pop()
            if x == y:
                continue
            if self.left[x] < 0 and self.left[y] < 0:
                return x < y
            if self.left[x] >= 0 and (self.left[y] < 0 or x >= y):  # the later node is the larger tree or a later one
                ours += (self.right[x], self.left[x])
                theirs.append(y)
            else:
                theirs += (self.right[y], self.left[y])
                ours.append(x)
        return bool(theirs) and not ours

    def cut(self, size: int) -> None:
        """Forget the nodes from ``size`` on."""
        del self.left[size:], self.right[size:]


def best(ropes: Ropes, found: list[tuple[int, int, int]]) -> tuple[int, int] | None:
    """Least (cost, node) of (cost, first, second) by cost and then by the joined string.

    From one state over the same rows, strings of one cost are never prefixes of each
    other (the longer would have paid for its inserts), so that the least string of a whole
    is made of the least strings of its parts.
    """
    if not found:
        return None
    cost = min(found)[0]
    nodes = [ropes.join(a, b) for c, a, b in found if c == cost]
    least = nodes[0]
    for node in nodes[1:]:
        if ropes.less(node, least):
            least = node
    return cost, least


def product(ropes: Ropes, a: Matrix, b: Matrix, starts: tuple[int, ...] = (0, 1, 2, 3)) -> Matrix:
    out: list = [None] * 16
    for i in starts:
        for j in range(4):
            out[4 * i + j] = best(ropes, [
                (a[4 * i + m][0] + b[4 * m + j][0], a[4 * i + m][1], b[4 * m + j][1])
                for m in range(4) if a[4 * i + m] and b[4 * m + j]])
    return tuple(out)


def inserts(ropes: Ropes) -> Matrix:
    """Any inserts; two at most, as a third leads back to where one leads."""
    out: list = [(0, 0) if i == j else None for i in range(4) for j in range(4)]
    for start in range(4):
        state, letters = start, []
        for _ in range(2):
            state = next(to for (at, r), to in FOLLOWS.items() if at == state and r != "s")
            letters.append("I")
            if out[4 * start + state] is None:
                out[4 * start + state] = (INSERT * len(letters), ropes.letters(*letters))
    return tuple(out)


def symbol(role: str, truncated: bool) -> str:
    """Symbol of a row that may stay."""
    return TERMINALS[1 + 2 * (INITIALS + "o").index(role if role in INITIALS else "o") + truncated]


def edit(ropes: Ropes, char: str) -> Matrix:
    """One row: delete it, or keep it where its role may follow, or give it the role that may."""
    out: list = [None] * 16
    for i in range(4):
        out[4 * i + i] = (DELETE, ropes.letters("D"))
    if char != GONE:
        kind, truncated = divmod(ord(char) - FIRST - 1, 2)
        extra = TRUNCATED * truncated
        for (at, role), to in FOLLOWS.items():
            if role == (INITIALS + "o")[kind]:
                choice = (KEEP + extra, ropes.letters("K"))
            elif role != "s":
                choice = (REROLE + extra, ropes.letters("R"))
            else:
                continue
            if out[4 * at + to] is None or choice[0] < out[4 * at + to][0]:
                out[4 * at + to] = choice
    return tuple(out)


class Grammar:
    """Rules, and the matrix of every symbol."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = {pair: chr(FIRST + len(TERMINALS) + i) for i, pair in enumerate(rules)}
        self.ropes = Ropes()
        self.closure = inserts(self.ropes)
        self.matrices = {c: product(self.ropes, self.closure, edit(self.ropes, c)) for c in TERMINALS}
        for pair, name in self.rules.items():  # a rule's symbols are terminals or earlier rules
            self.matrices[name] = product(self.ropes, self.matrices[pair[0]], self.matrices[pair[1]])
        self.known = len(self.ropes.left)

    def compress(self, symbols: str) -> str:
        """The rules applied in their order, each from the left."""
        while len(symbols) > 1:
            first = min((self.rules.get(symbols[i:i + 2], "\U0010ffff") for i in range(len(symbols) - 1)))
            if first == "\U0010ffff":
                break
            pair = next(p for p in {symbols[i:i + 2] for i in range(len(symbols) - 1)} if self.rules.get(p) == first)
            symbols = symbols.replace(pair, first)
        return symbols

    def run(self, state: Matrix | None, symbols: str) -> Matrix:
        """Matrix (its first row only) of what came before and the symbols."""
        for char in self.compress(symbols):
            state = product(self.ropes, state, self.matrices[char], (0,)) if state else self.matrices[char]
        return state

    def close(self, state: Matrix | None) -> tuple[int, str]:
        """Least cost and its edits from nothing to a state that may end."""
        if state is None:
            return 0, ""
        whole = product(self.ropes, state, self.closure, (0,))
        cost, node = best(self.ropes, [(*whole[j], 0) for j in FINAL if whole[j]])
        return cost, self.ropes.text(node)

    def forget(self) -> None:
        """Drop the ropes of one conversation."""
        self.ropes.cut(self.known)


def count_pairs(symbols: str, n: int, counts: Counter) -> None:
    """Neighbouring pairs, those of a run of one symbol without overlap."""
    last, skip = "", False
    for i in range(len(symbols) - 1):
        pair = symbols[i:i + 2]
        skip = pair == last and pair[0] == pair[1] and not skip
        if not skip:
            counts[pair] += n
        last = pair


def learn(sequences: DataFrame, share: int = RULE_SHARE) -> list[str]:
    """Re-Pair rules, in order, of the distinct ``sequences`` (symbols, n).

    A round counts the neighbouring pairs of all sequences after the rules so far and adds
    the most frequent ones that can't overlap each other, which is what adding them one by
    one would do.  It ends when no pair occurs twice and in one of ``share`` symbols.
    """
    total = sequences.agg(F.sum(F.length("symbols") * F.col("n"))).first()[0] or 0
    least = max(2, -(-total // share))
    rules: list[str] = []
    while total:
        grammar = Grammar(rules)

        def run(batch: pa.RecordBatch, grammar: Grammar = grammar) -> dict:
            counts: Counter = Counter()
            for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist(), strict=True):
                count_pairs(grammar.compress(symbols), n, counts)
            return {"pair": list(counts), "n": list(counts.values())}

        frequent = arrow_map(sequences.select("symbols", "n"), run, "pair string, n long").groupBy("pair").agg(
            F.sum("n").alias("n")).where(F.col("n") >= least).collect()
        firsts, seconds, added = set(), set(), []
        for pair, _ in sorted(frequent, key=lambda r: (-r.n, r.pair)):
            a, b = pair
            if a in seconds or b in firsts or (a == b and (a in firsts or b in seconds)):
                continue
            firsts.add(a)
            seconds.add(b)
            added.append(pair)
        if not added:
            break
        rules += added
    return rules


def _turn_order(turn: str | Column = "turn") -> Column:
    turn = F.col(turn) if isinstance(turn, str) else turn
    return F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"))


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text), equal ones once with their number n, with what is wrong.

    ``fault`` is the first row's: blank, duplicate, truncated or null; the n - 1 others are
    blank or duplicates.  ``symbol`` is the first row's symbol.  Of rows of one turn the
    order is that of role and text.
    """
    counted = written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")), "turns")
    identity = [F.col("conv_id"), F.col("role"), F.sha2("text", 256).alias("digest")]
    seen = written(counted.groupBy(*identity).agg(
        F.min(_turn_order()).alias("first"), F.count("*").alias("turns")).where("turns > 1").drop("turns"), "seen")
    both = counted.withColumn("digest", F.sha2("text", 256)).alias("c").join(
        seen.alias("s"), F.col("c.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("c.role") == F.col("s.role"))
        & (F.col("c.digest") == F.col("s.digest")), "left").select("c.*", "s.first")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    again = F.col("first").isNotNull() & (_turn_order() != F.col("first"))
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(again, "duplicate").when(cut, "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin(*INITIALS), F.instr(F.lit(INITIALS), initial) - 1).otherwise(len(INITIALS))
    code = F.when(blank | again, FIRST).otherwise(FIRST + 1 + 2 * kind + F.when(cut, 1).otherwise(0))
    return both.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"), F.char(code.cast("int")).alias("symbol"),
                       F.when(initial == "", F.lit(" ")).otherwise(initial).alias("initial"))


def pieces(rows: DataFrame) -> DataFrame:
    """Rows of ``judged`` with at most RUN equal rows each, in the order of _known, turn, role, text and _piece."""
    return rows.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN)))).select(
        "conv_id", F.col("turn").isNotNull().alias("_known"), "turn", "role", "text", "_piece", "initial",
        F.when(F.col("_piece") == 0, F.col("symbol")).otherwise(GONE).alias("symbol"),
        F.least(F.lit(RUN), F.col("n") - F.col("_piece") * RUN).cast("int").alias("n"))


ORDER = ["_known", "turn", "role", "text", "_piece"]


def segments(rows: DataFrame) -> DataFrame:
    """(conv_id, at, symbols, illegal, first, last) of stretches of conversations, in order of ``at``.

    Rows are range-partitioned by conversation and turn, so that one conversation may lie
    in many partitions; ``first`` and ``last`` are the initials at a stretch's ends.
    """
    ordered = pieces(rows).repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, initials = batch.column("conv_id").to_pylist(), batch.column("initial").to_pylist()
            heads, counts = batch.column("symbol").to_pylist(), batch.column("n").to_pylist()
            out: dict[str, list] = {c: [] for c in ("conv_id", "at", "symbols", "illegal", "first", "last")}
            start = 0
            for stop in range(1, len(convs) + 1):
                if stop < len(convs) and convs[stop] == convs[start] and stop - start < SEGMENT:
                    continue
                out["conv_id"].append(convs[start])
                out["at"].append(base + done)
                out["symbols"].append("".join(h + GONE * (n - 1) for h, n in zip(heads[start:stop], counts[start:stop])))
                ends = "".join(i * min(n, 2) for i, n in zip(initials[start:stop], counts[start:stop]))
                inside = sum(n - 2 for n in counts[start:stop] if n > 2)  # equal neighbours are never legal
                out["illegal"].append(inside + sum(ends[i:i + 2] not in legal for i in range(len(ends) - 1)))
                out["first"].append(ends[0])
                out["last"].append(ends[-1])
                done += 1
                start = stop
            yield record_batch(out, schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = dict(rows.dtypes)["conv_id"]
    ddl = f"conv_id {kind}, at long, symbols string, illegal long, first string, last string"
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return ordered.select("conv_id", "symbol", "initial", "n").mapInArrow(run, ddl)


def _repairs(batches: Iterator[pa.RecordBatch], rules: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per conversation of segments that are sorted by conversation and place."""
    grammar = Grammar(rules)
    whole: dict[str, tuple[int, str]] = {}
    conv, open_, state, symbols, illegal, last = None, False, None, "", 0, ""

    def finish() -> tuple:
        if state is None and len(symbols) <= 64:  # short conversations repeat
            if symbols not in whole:
                if len(whole) >= 1 << 16:
                    whole.clear()
                whole[symbols] = grammar.close(grammar.run(None, symbols))
            cost, audit = whole[symbols]
        else:
            cost, audit = grammar.close(grammar.run(state, symbols))
        grammar.forget()
        return conv, illegal, cost, audit

    names = ("conv_id", "illegal", "cost", "audit")
    for batch in batches:
        found = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "symbols", "illegal", "first", "last"))):
            if open_ and row[0] == conv:
                state = grammar.run(state, symbols)
                illegal += row[2] + (last + row[3] not in ("su", "ua", "au"))
            else:
                if open_:
                    found.append(finish())
                conv, open_, state, illegal = row[0], True, None, row[2]
            symbols, last = row[1], row[4]
        if found:
            yield record_batch(dict(zip(names, zip(*found))), schema)
    if open_:
        yield record_batch(dict(zip(names, zip(*[finish()]))), schema)


def repairs(stretches: DataFrame, rules: list[str]) -> DataFrame:
    """(conv_id, illegal, cost, audit) of each conversation: its stretches' matrices multiplied in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = f"conv_id {dict(stretches.dtypes)['conv_id']}, illegal long, cost long, audit string"
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    ordered = stretches.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return ordered.mapInArrow(partial(_repairs, rules=rules, schema=schema), ddl)


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, at, role, text, edit): the turns of every repaired conversation, in order within a partition.

    ``rows`` as of ``judged``, ``audits`` (conv_id, audit).  A conversation's audit comes
    first in its partition and its rows are read after it one by one; nothing of it is held.
    A conversation of which nothing stays has one row with a null ``at``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = dict(rows.dtypes)["conv_id"]
    plan = audits.select("conv_id", F.lit(0).alias("_part"), F.lit(None).cast("boolean").alias("_known"),
                         F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
                         F.lit(0).cast("long").alias("_piece"), F.lit(0).alias("n"))
    told = pieces(rows).select("conv_id", F.lit(1).alias("_part"), "_known", "turn", "role", "text",
                               F.col("_piece").cast("long").alias("_piece"), "n")
    ordered = plan.union(told).repartition("conv_id").sortWithinPartitions("conv_id", "_part", *ORDER)
    ddl = f"conv_id {kind}, at long, role string, text string, edit string"
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, place, state, at = None, None, 0, 0, 0
        out: list[tuple] = []

        def put(edit_: str, role: str, text: str) -> None:
            nonlocal at
            out.append((conv, at, role, text, edit_))
            at += 1

        def expected(state: int) -> tuple[str, int]:
            return next((r, to) for (here, r), to in FOLLOWS.items() if here == state and r != "s")

        def insert() -> None:
            nonlocal place, state
            while place < len(audit) and audit[place] == "I":
                role, state = expected(state)
                put("I", ROLES[role], "")
                place += 1

        def end() -> None:
            if audit is not None:
                insert()
                if not at:
                    out.append((conv, None, "", "", ""))

        for batch in batches:
            for conv_id, part, role, text, n in zip(*(
                    batch.column(c).to_pylist() for c in ("conv_id", "_part", "role", "text", "n")), strict=True):
                if part == 0:
                    end()
                    conv, audit, place, state, at = conv_id, text, 0, 0, 0
                    continue
                for _ in range(n):
                    insert()
                    letter = audit[place]
                    place += 1
                    if letter == "K":
                        state = FOLLOWS[state, role[:1]]
                        put("K", role, text)
                    elif letter == "R":
                        new, state = expected(state)
                        put("R", ROLES[new], text)
            if out:
                yield record_batch(dict(zip(schema.names, zip(*out))), schema)
                out = []
        end()
        if out:
            yield record_batch(dict(zip(schema.names, zip(*out))), schema)

    return ordered.select("conv_id", "_part", "role", "text", "n").mapInArrow(run, ddl)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` joined by newlines, of turns as ``repaired_turns`` gives them."""
    import hashlib

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ddl = f"conv_id {dict(turns.dtypes)['conv_id']}, repaired_sha256 string"
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for conv_id, at, role, text in zip(*(
                    batch.column(c).to_pylist() for c in ("conv_id", "at", "role", "text")), strict=True):
                if not at:  # null or 0: a new conversation
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = conv_id, hashlib.sha256()
                if at is not None:
                    digest.update(f"{chr(10) if at else ''}{role}:{text}".encode())
            if out:
                yield record_batch(dict(zip(schema.names, zip(*out))), schema)
        if digest is not None:
            yield record_batch({"conv_id": [conv], "repaired_sha256": [digest.hexdigest()]}, schema)

    return turns.select("conv_id", "at", "role", "text").mapInArrow(run, ddl)


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with one row in four hurt, chosen by the CRC32 of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats
    it and 4 makes its role user.  A null reads as one space, in the hashed ids too.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn)))
    hurt = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("hurt")).where("hurt != 0")
    marks = F.when(F.col("hurt") == 1, "").when(F.col("hurt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("hurt") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hurt.select("conv_id", "turn", F.when(F.col("hurt") == 4, "user").otherwise(F.col("role")).alias("role"),
                       marks.alias("text"), F.explode(times)).drop("col")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Audit of every conversation, and the turns of the repaired ones.

    ``rows`` are (conv_id, turn, role, text) without null roles and texts; further columns
    are left out.  The first result is one row per conv_id: gaps (turns missing between
    the least and the greatest), blank, duplicate, truncated (rows by their first fault),
    illegal (neighbours whose role initials are not su, ua or au), cost and audit of the
    cheapest edits that give ``(s?(ua)+)?``, the least in ASCII order of those; the second
    is that of ``repaired_turns``.

    Order is by turn, null first, then role and text; rows equal in all of them are
    duplicates but for the first.  A role counts by its first character, in any length; an
    empty or other one can only be changed or deleted.  A null conv_id is a conversation.
    Ids of ``conversations`` (conv_id) without rows have zeros and an empty audit; an empty
    table gives no rows.
    """
    found = written(judged(rows.select("conv_id", "turn", "role", "text")), "judged")
    stretches = written(segments(found), "stretches")
    rules = learn(written(stretches.groupBy("symbols").agg(F.count("*").alias("n")), "sequences"))
    audits = written(repairs(stretches, rules), "audits")
    spans = found.groupBy("conv_id", "turn").agg(
        *[F.sum(F.when(F.col("fault") == f, 1).otherwise(0)).alias(f) for f in ("truncated",)],
        F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "blank", 0).when(F.col("fault") == "duplicate", F.col("n"))
              .otherwise(F.col("n") - 1)).alias("duplicate"))
    counts = spans.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    ids = (rows if conversations is None else conversations).select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    base = ids.alias("i")
    for name, frame in (("c", counts), ("a", audits)):
        base = base.join(frame.alias(name), F.col("i.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    table = base.select("i.conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                        F.coalesce("audit", F.lit("")).alias("audit"))
    return table, repaired_turns(found, audits.select("conv_id", "audit"))
