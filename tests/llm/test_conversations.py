import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from framewright.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def brute_edits(rows):
    """All least-cost edits by a full table over rows and states: ``cost, audit, lines``.  ``rows``: (role, text, fault)."""
    best = {0: (0, "", ())}

    def inserted(table):
        for _ in range(3):
            for s, (cost, audit, lines) in list(table.items()):
                role, t = NEXT[s]
                offer = cost + 5, audit + "I", (*lines, f"{role}:")
                if t not in table or offer < table[t]:
                    table[t] = offer
        return table

    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, lines) in inserted(best).items():
            offers = [(s, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                to, t = NEXT[s]
                offers.append((t, (cost + 1 + extra, audit + "R", (*lines, f"{to}:{text}"))))
                if role[:1] == to[0]:
                    offers.append((t, (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                if role[:1] == "s" and s == 0:
                    offers.append((1, (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
            for t, offer in offers:
                if t not in after or offer < after[t]:
                    after[t] = offer
        best = after
    return min(v for s, v in inserted(best).items() if s in (0, 3))


def brute(rows, damage=True):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(place.encode()) % 20 if damage else 9
        held = groups[conv]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
        seen, judged = set(), []
        for _, role, text in held:
            bare = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "fine" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, _, f in judged]
        initials = [r[:1] for r, _, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = brute_edits(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.fixture
def talks():
    rng = random.Random(3)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "user2", None]
    texts = ["Yes.", "No!", "And so", "", " \t\n", "Why?", "one two.  ", "the end. x", None, "long " * 4000 + "."]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(0, 12)):
            rows.append((conv, turn + (turn > 5) * 3, rng.choice(roles[: rng.choice([2, 5, 9])]), rng.choice(texts)))
    rows += [(None, 1, "user", "Hm."), (None, 2, "assistant", "Ok."), (None, None, None, None)]
    rows += [(70, None, "user", "a."), (70, None, "assistant", "b."), (70, 3, "user", "c.")]  # null turns come first
    rows += [(71, 1, "user", "Same."), (71, 1, "user", "Same."), (71, 1, "assistant", "Other.")]
    rows += [(72, t, "user", "x.") for t in range(5)]
    return rows


def found(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_repairs_match_brute_force(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA)
    assert found(c.repairs(c.damaged(df))) == brute(talks)
    assert found(c.repairs(c.undamaged(df).repartition(5))) == brute(talks, damage=False)


def test_long_conversations_are_solved_in_parts(spark, talks, monkeypatch):
    rng = random.Random(8)
    long = [(7, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", f"n{t}.", f"cut{t}", "", f"m{t}!"])) for t in range(700)]
    long += [(8, 1, "user", "again.")] * 40
    rows = talks + long
    monkeypatch.setattr(c, "BLOCK", 16)  # forked workers see it only by value; the parts of ranges are cut by the shuffle too
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(c.repairs(c.undamaged(df))) == brute(rows, damage=False)


def test_blocks_and_chains_agree_with_one_search(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    for _ in range(60):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 40)))
        whole = c.cheapest(codes)
        chain = c._Chain(1)
        cuts = sorted(rng.sample(range(len(codes) + 1), min(3, len(codes) + 1)))
        pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        for seq, piece in reversed(list(enumerate(pieces))):
            chain.add(c._summary(1, (True, 1, "", b""), seq, piece, [None, None, 0], False))
        result = chain.result()
        assert (result["cost"], result["audit"]) == whole
    rows = [(1, 1, "user", b"d", c.FINE, 1, False), (2, 1, "user", b"d", c.FINE, 50, False), (3, 1, "user", b"d", c.FINE, 1, False)]
    monkeypatch.setattr(c, "BLOCK", 16)
    names = ["conv_id", "turn", "role", "digest", "code", "copies", "again"]
    parts = pa.Table.from_batches(c._blocks(iter([pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])]))).to_pylist()
    assert [(p["conv_id"], p["whole"], p["duplicate"]) for p in parts] == [
        (1, False, 0), (2, False, 15), (2, False, 16), (2, False, 16), (2, False, 2), (3, False, 0)
    ]


def test_search_matches_brute_force():
    rng = random.Random(2)
    names = ["fine", "blank", "duplicate", "truncated"]
    roles = ["user", "system", "assistant", "other"]
    for _ in range(300):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 9)))
        rows = [(roles[x >> 2], "t", names[x & 3]) for x in codes]
        assert c.cheapest(codes) == brute_edits(rows)[:2]


def test_repaired_rows_are_legal(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA)
    lists = defaultdict(list)
    for conv, place, role, _ in map(tuple, c.repaired_rows(c.undamaged(df)).orderBy("conv_id", "place").collect()):
        assert place == len(lists[conv])
        lists[conv].append(role[:1])
    assert lists and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in lists.values())


def test_empty_table_clashing_columns_and_widths(spark, talks, partitions):
    assert found(c.repairs(c.damaged(spark.createDataFrame([], SCHEMA)))) == []
    odd = [(*r, 1, "x", True, "y") for r in talks]
    df = spark.createDataFrame(odd, f"{SCHEMA}, copies long, digest string, gone boolean, audit string")
    first, second = partitions(lambda: c.repairs(c.damaged(df)))
    assert first == second and sorted(first, key=lambda r: (r[0] is None, r[0] or 0)) == brute(talks)


def test_rows_that_are_all_dropped_leave_an_empty_conversation(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "Hello.")]
    assert found(c.repairs(c.damaged(spark.createDataFrame(rows, SCHEMA)))) == [
        (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]
