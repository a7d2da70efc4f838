"""Conversation repair against a plain dynamic programme over suffixes."""

import hashlib
import random
from functools import cache

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.llm import repair
from orderlake.llm.registry import damaged

WHITE = " \t\n\x0b\f\r"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_faults(turns):
    """(blank, duplicate, truncated) of (role, text) in order."""
    out, seen = [], set()
    for role, text in turns:
        bare = text.strip(WHITE)
        out.append((not bare, bool(bare) and (role, text) in seen,
                    bool(bare) and (role, text) not in seen and bare[-1] not in ".!?"))
        seen.add((role, text))
    return out


def plain_repair(turns):
    """(cost, audit, repaired) by the best completion of every suffix."""
    flags = plain_faults(turns)

    @cache
    def best(i, last, inserted):
        ways = []
        if i == len(turns) and last in ("", "a"):
            ways.append((0, "", ()))

        def go(cost, letter, line, *state):
            rest = best(*state)
            if rest is not None:
                ways.append((cost + rest[0], letter + rest[1], line + rest[2]))
        role = "assistant" if last == "u" else "user"
        if inserted < 2:
            go(5, "I", (role + ":",), i, role[0], inserted + 1)
        if i < len(turns):
            go(2, "D", (), i + 1, last, 0)
            blank, duplicate, truncated = flags[i]
            if not blank and not duplicate:
                extra, (old, text) = 5 * truncated, turns[i]
                if old and old[0] in NEXT[last]:
                    go(extra, "K", (f"{old}:{text}",), i + 1, old[0], 0)
                go(1 + extra, "R", (f"{role}:{text}",), i + 1, role[0], 0)
        return min(ways, default=None)
    for i in range(len(turns), 0, -1):
        for last in NEXT:
            best(i, last, 0)
    return best(0, "", 0)


ROLE = st.sampled_from(["system", "user", "assistant", "tool", "", " ", "sys"])
TEXT = st.sampled_from(["Yes.", "No!", "Why?", "cut", " ", "", "Yes.\n", "a.b", "one. ", "two?", "three!"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=9), st.integers(1, 4))
def test_agenda_and_segments_equal_every_suffix(turns, cut):
    flags = [(r[:1], b or d, t) for (r, _), (b, d, t) in zip(turns, plain_faults(turns))]
    cost, audit, lines = plain_repair(tuple(turns))
    parts = [list(repair.spans(flags[i:i + cut], repair.STATES)) for i in range(0, len(flags), cut)]
    assert repair.lightest_path(parts) == (cost, audit)
    assert [f"{r}:{t}" for _, r, t in repair.repaired(audit, iter(turns))] == list(lines)


def plain(rows):
    """The report of every conversation of (conv_id, turn, role, text)."""
    out, by = [], {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        by.setdefault(conv, []).append((turn is not None, turn or 0, role, hashlib.md5(
            f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    for conv, turns in by.items():
        turns.sort()
        pairs = [(r, t) for *_, r, _, t in turns]
        flags, known = plain_faults(pairs), [t[1] for t in turns if t[0]]
        joints = [a[0][:1] + b[0][:1] for a, b in zip(pairs, pairs[1:])]
        cost, audit, lines = plain_repair(tuple(pairs))
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *map(sum, zip(*flags)),
                    sum(j not in ("su", "ua", "au") for j in joints), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, Cost string, row string"


def test_equals_brute_force(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "Why?", "cut", "", None, "\t", "x" * 70000 + ".", "é? "]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["system", "user", "user", "assistant", "assistant", None, ""]),
             rng.choice([*texts, f"t{rng.random()}."])) for c in [None, *range(60)] for _ in range(rng.randint(1, 12))]
    rows += rows[:20]                                                              # repeated rows
    rows += [(100, i // 2, rng.choice(["user", "assistant"]), rng.choice(["a.", f"{i}.", f"{i}"])) for i in range(900)]
    rows += [(101, None, "user", "Yes."), (101, None, "assistant", "No.")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    ids = spark.createDataFrame([(500,), (None,), (500,)], "conv_id long")
    got = [tuple(r) for r in repair.repair(table, ids, digest=True).collect()]
    empty = (500, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert sorted(got, key=str) == sorted([*plain(rows), empty], key=str)


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "cut"), (1, 2, "assistant", "Fine."), (2, 0, "user", ""), (3, 5, "user", "Q?")]
    out = repair.repair(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).orderBy("conv_id", "position")
    # 1: dropping the cut turn leaves two of one role, the first becomes the user
    assert [tuple(r) for r in out.collect()] == [
        (1, 0, "user", "Hi.", "R"), (1, 1, "assistant", "Fine.", "K")]


def test_empty_table_and_damage(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none, digest=True).collect() == [] and repair.repair(none).collect() == []
    import zlib
    rows = [(c, t, "assistant", "A. b! c") for c in range(30) for t in range(10)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (c, t))
        fate, role, text = zlib.crc32(key.encode()) % 20, role or " ", text or " "
        row = (c, t, "user" if fate == 4 else role, {1: "", 2: text.translate({ord(x): None for x in ".!?"})}.get(fate, text))
        want += [row] * {0: 0, 3: 2}.get(fate, 1)
    got = damaged(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_a_long_conversation_is_cut_into_segments(spark):
    rows = [(7, i, ["user", "assistant"][i % 2], f"{i}.") for i in range(2000)]
    t = repair.prepared(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    r = repair.reports(t).first()
    assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "K" * 2000)
    ranges = repair.faults(t).repartitionByRange(4, *repair.ORDER).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranges) < 1000
