"""Repair of conversation structure: the cheapest edits that make the roles alternate, found on the edit lattice.

The lattice of a conversation has a node per (rows read, role seen last); keeping, re-roling, deleting and inserting are its edges.
Two searches with heaps, one from the start and one from the accepted ends, meet in the middle.  They go on until no cheaper or
equally cheap path can be open, so all crossings of least cost are known, and the crossing with the least concatenated audit wins.

1. **Structure without texts.** A row becomes one code (initial of its role and fault); repeats are found by the least turn per digest of role and
   text.  Codes are sorted over many tasks by conversation and turn, so a conversation of any length is spread over several.
2. **Blocks.** A task solves what it holds of a conversation, at most ``BLOCK`` rows at once: a whole conversation from start to
   end, a part of a longer one between all pairs of states.  Parts are chained backwards, one byte per row and state.
3. **Texts.** The audit goes ahead of the conversation's rows in one sorted stream; repaired rows are hashed as they pass.  Texts
   are never held together.  A digest can only be taken in order, so one task streams one conversation.

Order of rows: turn (null first), role, SHA-256 of length of role, role and text.  Defined results: null role and text read as one
space, so they are a fault; a null ``conv_id`` is a conversation of its own; repeated rows are duplicates; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import only, stored

#: Blanks, ends of a whole text, costs of the edits.
SPACES, STOPS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED_COST = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

#: Rows of a conversation that are searched at once.
BLOCK = 1024
#: A code is ``4 * initial + fault``.
INITIALS = "usa"  # others are 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after the system row, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: The role that comes next, and the state after it.
_NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _kept_as(state: int, initial: str) -> int | None:
    """State after keeping a row of this initial, or None where it has no place."""
    if initial == "s":
        return SYSTEM if state == START else None
    return _NEXT[state][1] if _NEXT[state][0] == initial else None


def _row_edges(code: int) -> list[tuple[int, int, int, str]]:
    """Edges ``from, to, cost, letter`` of one row."""
    initial, fault = (INITIALS + "?")[code >> 2], code & 3
    edges = [(s, s, DELETE, "D") for s in range(4)]
    if fault in (FINE, TRUNCATED):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state in range(4):
            to = _kept_as(state, initial)
            if to is not None:
                edges.append((state, to, KEEP + extra, "K"))
            edges.append((state, _NEXT[state][1], REROLE + extra, "R"))
    return edges


_EDGES = [_row_edges(code) for code in range(16)]
_OUT = [[[e[1:] for e in edges if e[0] == s] for s in range(4)] for edges in _EDGES]
_IN = [[[(e[0], *e[2:]) for e in edges if e[1] == s] for s in range(4)] for edges in _EDGES]
_INSERTS_OUT = [[(_NEXT[s][1], INSERT, "I")] for s in range(4)]
_INSERTS_IN = [[(s, INSERT, "I") for s in range(4) if _NEXT[s][1] == t] for t in range(4)]


class _Search:
    """Dijkstra from one side of the lattice; nodes settle by cost, then along the rows, each with its least audit."""

    def __init__(self, codes: bytes, sources: Iterable[tuple[int, int]], forward: bool):
        self.codes, self.forward = codes, forward
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        self.best = {node: (0, "") for node in sources}
        self.heap = [(0, self._along(row), row, state) for row, state in self.best]
        heapq.heapify(self.heap)

    def _along(self, row: int) -> int:
        return row if self.forward else len(self.codes) - row

    def top(self) -> int | None:
        while self.heap and (self.heap[0][2], self.heap[0][3]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def steps(self, row: int, state: int):
        """Neighbours ``row, state, cost, letter``."""
        if self.forward:
            if row < len(self.codes):
                for to, cost, letter in _OUT[self.codes[row]][state]:
                    yield row + 1, to, cost, letter
            around = _INSERTS_OUT
        else:
            if row:
                for to, cost, letter in _IN[self.codes[row - 1]][state]:
                    yield row - 1, to, cost, letter
            around = _INSERTS_IN
        for to, cost, letter in around[state]:
            yield row, to, cost, letter

    def settle(self) -> tuple[int, int]:
        cost, _, row, state = heapq.heappop(self.heap)
        node = row, state
        self.settled[node] = mine = self.best[node]
        for to_row, to, step, letter in self.steps(row, state):
            target = to_row, to
            if target in self.settled:
                continue
            path = mine[1] + letter if self.forward else letter + mine[1]
            offer = cost + step, path
            held = self.best.get(target)
            if held is None or offer < held:
                if held is None or offer[0] < held[0]:
                    heapq.heappush(self.heap, (offer[0], self._along(to_row), to_row, to))
                self.best[target] = offer
        return node


def cheapest(codes: bytes, start: int = START, ends: Iterable[int] = ACCEPTED) -> tuple[int, str] | None:
    """Least cost and the least audit of that cost from ``start`` to one of ``ends`` over all rows, by two searches that meet.

    Equal costs of both sides can't both reach below the sum of the heaps' tops, so when that sum exceeds the best meeting, every
    node of every cheapest path is settled by one side at least.  Its first node is settled ahead and its last one back, so it has a node
    settled by both, or an edge that leads from one side's nodes to the other's.
    """
    ahead = _Search(codes, [(0, start)], True)
    back = _Search(codes, [(len(codes), s) for s in ends], False)
    met: int | None = None
    for side in (ahead, back):
        sources = set(side.best)
        while not sources <= side.settled.keys():
            side.settle()
    for node in ahead.settled.keys() & back.best.keys():
        offer = ahead.settled[node][0] + back.best[node][0]
        met = offer if met is None else min(met, offer)
    while True:
        one, other = ahead.top(), back.top()
        if one is None or other is None or (met is not None and one + other > met):
            break
        side, facing = (ahead, back) if one <= other else (back, ahead)
        node = side.settle()
        reach = facing.best.get(node)
        if reach is not None and (met is None or side.settled[node][0] + reach[0] < met):
            met = side.settled[node][0] + reach[0]
    least: tuple[int, str] | None = None
    for node, (cost, audit) in ahead.settled.items():
        if node in back.settled:
            rest = back.settled[node]
            offer = cost + rest[0], audit + rest[1]
            least = offer if least is None or offer < least else least
        for row, state, step, letter in ahead.steps(*node):
            rest = back.settled.get((row, state))
            if rest is not None and (least is None or cost + step + rest[0] <= least[0]):
                offer = cost + step + rest[0], audit + letter + rest[1]
                least = offer if least is None or offer < least else least
    return least


# the rows


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with the faults that a CRC of their place puts in: ``conv_id, turn, role, text, gone``.

    ``gone`` marks dropped rows, which stay in the table so that no conversation is lost.
    """
    named = only(rows, "conv_id", "turn", "role", "text")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    named = named.withColumn("_fate", (F.crc32(key.cast("binary")) % 20).cast("int"))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fate = F.col("_fate")
    text = F.when(fate == 1, "").when(fate == 2, F.translate(text, STOPS, "")).otherwise(text)
    hurt = named.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"), text.alias("text"), (fate == 0).alias("gone"), "_fate"
    )
    copies = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hurt.select("conv_id", "turn", "role", "text", "gone", copies.alias("_copy")).drop("_copy")


def undamaged(rows: DataFrame) -> DataFrame:
    """Rows as they are, in the form of :func:`damaged`."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    return only(rows, "conv_id", "turn", "role", "text").select("conv_id", "turn", role, text, F.lit(False).alias("gone"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))


def _codes(rows: DataFrame) -> DataFrame:
    """One row per different (conversation, turn, role, text): its code and how often it is there; dropped rows have no digest."""
    whole = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(whole == "", BLANK).when(F.right(whole, F.lit(1)).isin(*STOPS), FINE).otherwise(TRUNCATED)
    first = F.substring("role", 1, 1)
    number = F.coalesce(*[F.when(first == c, F.lit(i)) for i, c in enumerate(INITIALS)], F.lit(3))
    here = ~F.col("gone")
    slim = rows.select(
        "conv_id", F.when(here, F.col("turn").cast("long")).alias("turn"), F.when(here, F.col("role")).alias("role"),
        F.when(here, _digest()).alias("digest"), F.when(here, (number * 4 + fault).cast("int")).alias("code"),
    )
    slim = stored(slim.groupBy("conv_id", "turn", "role", "digest", "code").agg(F.count("*").alias("copies")), "conversations-codes")
    # the least turn (null first) of each text of a conversation; a join on that turn too meets one row at most
    at = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    firsts = slim.filter("digest IS NOT NULL").groupBy(F.col("conv_id").alias("_c"), F.col("digest").alias("_d")).agg(F.min(at).alias("_at"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d")) & F.col("turn").eqNullSafe(F.col("_at.turn"))
    again = F.col("_d").isNull().alias("again")
    return slim.join(firsts, same, "left").select("conv_id", "turn", "role", "digest", "code", "copies", again)


_PART = pa.schema(
    [("conv_id", pa.int64()), ("has_turn", pa.bool_()), ("first_turn", pa.int64()), ("first_role", pa.string()), ("first_digest", pa.binary()), ("seq", pa.int64()),
     ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
     ("illegal", pa.int64()), ("opens", pa.string()), ("closes", pa.string()), ("whole", pa.bool_()),
     ("ways", pa.list_(pa.struct([("start", pa.int8()), ("end", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())])))]
)
PART = (
    "conv_id long, has_turn boolean, first_turn long, first_role string, first_digest binary, seq long, least long, most long, turns long, blank long, "
    "duplicate long, truncated long, illegal long, opens string, closes string, whole boolean, "
    "ways array<struct<start: byte, end: byte, cost: long, audit: string>>"
)


def _summary(conv_id, first: tuple, seq: int, codes: bytes, turns: list, whole: bool) -> dict:
    """What one part knows of its conversation; ``turns`` are the least, the largest and how many different ones."""
    faults = [c & 3 for c in codes]
    initials = [(INITIALS + "?")[c >> 2] for c in codes]
    if whole:
        found = cheapest(codes)
        ways = [dict(start=START, end=START, cost=found[0], audit=found[1])]
    else:
        ways = []
        for start in range(4):
            for end in range(4):
                found = cheapest(codes, start, [end])
                if found is not None:
                    ways.append(dict(start=start, end=end, cost=found[0], audit=found[1]))
    illegal = sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))
    return dict(
        conv_id=conv_id, has_turn=first[0], first_turn=first[1], first_role=first[2], first_digest=first[3], seq=seq, least=turns[0],
        most=turns[1], turns=turns[2], blank=faults.count(BLANK), duplicate=faults.count(DUPLICATE), truncated=faults.count(TRUNCATED), illegal=illegal,
        opens=initials[0] if initials else "", closes=initials[-1] if initials else "", whole=whole, ways=ways,
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations in one sorted range.  Only the range's first and last conversation may go on elsewhere."""
    held: list[dict] = []
    conv, at_edge, cut, parts = None, True, False, 0
    codes, first, turns = bytearray(), None, [None, None, 0]
    started = False

    def close(whole: bool) -> None:
        nonlocal parts
        held.append(_summary(conv, first, parts, bytes(codes), turns, whole))
        parts += 1

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "digest", "code", "copies", "again")]
        for conv_id, turn, role, digest, code, copies, again in zip(*columns):
            if not started or conv_id != conv:
                if started:
                    close(not at_edge and not cut)
                    at_edge = False
                started, conv, cut = True, conv_id, False
                codes, first, turns = bytearray(), None, [None, None, 0]
            if first is None:
                first = (turn is not None, turn, role, digest)
            if digest is None:  # a dropped row
                continue
            if turn is not None and turn != turns[1]:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            if again and code & 3 != BLANK:
                code = code & ~3 | DUPLICATE
            for copy in range(copies):
                if len(codes) == BLOCK:
                    close(False)
                    # the next part counts its turns anew; chaining knows the turn they share
                    cut, codes, first = True, bytearray(), (turn is not None, turn, role, digest)
                    turns = [turn, turn, int(turn is not None)]
                codes.append(code if not copy or code & 3 == BLANK else code & ~3 | DUPLICATE)
        if len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=_PART)
            held = []
    if started:
        close(False)
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_PART)


_SORT = ("has_turn", "first_turn", "first_role", "first_digest", "seq")
_RESULT = pa.schema(
    [("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
#: Letters of what follows that can still tell two ways apart: never more than two insertions stand together.
AHEAD = 4


class _Chain:
    """The parts of one conversation, given from the last to the first."""

    def __init__(self, conv_id):
        self.conv_id, self.choices = conv_id, []
        self.rest = {s: (0, "") for s in ACCEPTED}
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.least = self.most = self.opens = None

    def add(self, part: dict) -> None:
        for name in self.sums:
            self.sums[name] += part[name]
        if part["least"] is not None:
            if self.least is None:
                self.most = part["most"]
            elif self.least == part["most"]:
                self.sums["turns"] -= 1
            self.least = part["least"]
        if part["closes"]:
            if self.opens:
                self.sums["illegal"] += (part["closes"], self.opens) not in _LEGAL
            self.opens = part["opens"]
        if part["whole"]:
            self.choices, self.rest = [{START: (START, part["ways"][0]["audit"])}], {START: (part["ways"][0]["cost"], "")}
            return
        found: dict = {}
        for way in part["ways"]:
            rest = self.rest.get(way["end"])
            if rest is None:
                continue
            offer = way["cost"] + rest[0], way["audit"] + rest[1]
            held = found.get(way["start"])
            if held is None or offer < held[0]:
                found[way["start"]] = offer, (way["end"], way["audit"])
        self.choices.append({s: choice for s, (_, choice) in found.items()})
        self.rest = {s: (offer[0], offer[1][:AHEAD]) for s, (offer, _) in found.items()}

    def result(self) -> dict:
        state, pieces = START, []
        for choice in reversed(self.choices):
            state, piece = choice[state]
            pieces.append(piece)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.sums.pop("turns")
        self.sums.pop("turns", None)
        return dict(conv_id=self.conv_id, gaps=gaps, cost=self.rest[START][0], audit="".join(pieces), **self.sums)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation, last part first → one row per conversation."""
    chain, held = None, []
    for batch in batches:
        for part in batch.to_pylist():
            if chain is None or part["conv_id"] != chain.conv_id:
                if chain is not None:
                    held.append(chain.result())
                chain = _Chain(part["conv_id"])
            chain.add(part)
        if len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=_RESULT)
            held = []
    if chain is not None:
        held.append(chain.result())
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_RESULT)


def audits(rows: DataFrame) -> DataFrame:
    """Faults and cheapest edits of every conversation, of rows as :func:`damaged` or :func:`undamaged` give them.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    """
    at = [F.col("conv_id"), F.col("turn").isNotNull(), F.col("turn"), F.col("role"), F.col("digest")]
    ordered = _codes(rows).repartitionByRange(*at).sortWithinPartitions(*at)
    parts = ordered.mapInArrow(_blocks, PART)
    backwards = parts.repartition("conv_id").sortWithinPartitions("conv_id", *[F.desc(c) for c in _SORT])
    return backwards.mapInArrow(_chained, RESULT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Conversations of a sorted stream, each with its repaired rows ``role, text`` as they pass."""
    records = (r for batch in batches for r in batch.to_pylist())
    waiting = next(records, None)

    def edited(audit: str) -> Iterator[tuple[str, str]]:
        nonlocal waiting
        state = START
        for letter in audit:
            initial, after = _NEXT[state]
            if letter == "I":
                yield ROLES[initial], ""
                state = after
                continue
            row, waiting = waiting, next(records, None)
            if letter == "K":
                yield row["role"], row["text"]
                state = _kept_as(state, row["role"][:1])
            elif letter == "R":
                yield ROLES[initial], row["text"]
                state = after

    while waiting is not None:
        head, waiting = waiting, next(records, None)
        yield head, edited(head["audit"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _RESULT.append(pa.field("repaired_sha256", pa.string()))
    held = []
    for head, rows in _repaired(batches):
        digest, between = hashlib.sha256(), b""
        for role, text in rows:
            digest.update(b"".join((between, role.encode(), b":", text.encode())))
            between = b"\n"
        held.append({c: head[c] for c in _RESULT.names} | {"repaired_sha256": digest.hexdigest()})
        if len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    held, size = [], 0
    for head, rows in _repaired(batches):
        for place, (role, text) in enumerate(rows):
            held.append({"conv_id": head["conv_id"], "place": place, "role": role, "text": text})
            size += len(text)
            if len(held) >= 1000 or size > 4_000_000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _streamed(rows: DataFrame) -> DataFrame:
    """Every conversation's audit ahead of its rows, sorted."""
    found = stored(audits(rows), "conversations-audits")
    texts = rows.filter(~F.col("gone")).select(
        "conv_id", F.lit(1).alias("_kind"), F.col("turn").cast("long").alias("turn"), "role", "text", _digest().alias("_digest")
    )
    both = texts.unionByName(found.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    order = ("conv_id", "_kind", F.col("turn").isNotNull(), "turn", "role", "_digest")
    return both.repartition("conv_id").sortWithinPartitions(*order).drop("_kind", "_digest", "turn")


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the SHA-256 of the repaired ``role:text`` lines.

    ``rows`` as :func:`damaged` or :func:`undamaged` give them.
    """
    return _streamed(rows).mapInArrow(_hashed, f"{RESULT}, repaired_sha256 string")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: ``conv_id, place, role, text``."""
    return _streamed(rows).mapInArrow(_listed, "conv_id long, place long, role string, text string")
