"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation's turns in order are edited until their roles are a dialogue:
nothing, or pairs of user and assistant after at most one system turn. The
items of the deduction are (turns consumed, last role emitted); a deduction
takes an item and one edit of the next turn, or an inserted turn, to another
item. Its value is (cost, audit): the costs add up, the edit's letter is
appended. That is superior (never below its antecedent) and monotone (two
derivations of one item consume the same turns, so at equal cost neither
audit is a prefix of the other), so the first time an item leaves the agenda
it is final; ties go to the least audit.

Conversations are cut into segments of at most 256 turns, on sorted ranges of
the table, so a long conversation is spread over tasks. For every role before
a segment the agenda finds the lightest way to every role after it; a second
agenda over a conversation's segments takes these as its edits. Only the
finished output of one conversation is streamed through one task, in order
and without holding it.

Null roles and texts are one space. Turns are ordered by turn (nulls first),
then role and a hash of the text; a null conv_id is a conversation. Repeated
rows are duplicates. Other columns are not read; an empty table gives an empty
result. A difference of turns beyond a long wraps around.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Cost of each edit; a truncated turn that stays costs CUT more.
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT = 5
#: States: the last role emitted, "" at the start. Which initials may follow.
STATES = ("", "s", "u", "a")
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}
#: The role that an inserted or reroled turn takes.
ROLES = {"": "user", "s": "user", "u": "assistant", "a": "user"}
#: Adjacent initials of an intact conversation.
LEGAL = ("su", "ua", "au")
SEGMENT = 256

WHITE = " \t\n\x0b\f\r"
ORDER = ["conv_id", "turn", "role", "digest", "row"]


def lightest(origin, edits: Callable, goal: Callable | None = None) -> dict:
    """Knuth's agenda from ``origin`` at (0, ""). ``edits(item)`` yields
    (next item, cost, letters). All finished items, or those up to the first
    for which ``goal`` holds (it is the last one then)."""
    agenda, best, final = [(0, "", origin)], {origin: (0, "")}, {}
    while agenda:
        cost, audit, item = heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if goal is not None and goal(item):
            break
        for after, w, letters in edits(item):
            value = (cost + w, audit + letters)
            if after not in final and (after not in best or value < best[after]):
                best[after] = value
                heappush(agenda, (*value, after))
    return final


def turn_edits(turns: Sequence[tuple[str, bool, bool]]) -> Callable:
    """Deductions over ``turns``: (initial, must go, truncated) each."""
    def edits(item):
        at, last = item
        new = ROLES[last][0]
        yield (at, new), COST[INSERT], INSERT
        if at < len(turns):
            initial, must_go, truncated = turns[at]
            yield (at + 1, last), COST[DELETE], DELETE
            if not must_go:
                extra = CUT if truncated else 0
                if initial and initial in FOLLOWS[last]:
                    yield (at + 1, initial), COST[KEEP] + extra, KEEP
                yield (at + 1, new), COST[REROLE] + extra, REROLE
    return edits


def spans(turns: Sequence[tuple[str, bool, bool]], origins: Iterable[str]):
    """(role before, role after, cost, audit) of the lightest ways through ``turns``."""
    for origin in origins:
        for (at, last), (cost, audit) in lightest((0, origin), turn_edits(turns)).items():
            if at == len(turns):
                yield origin, last, cost, audit


def lightest_path(segments: Sequence[Sequence[tuple]]) -> tuple[int, str]:
    """The lightest repair of a conversation from the spans of its segments."""
    ways: list[dict] = [{} for _ in segments]
    for n, segment in enumerate(segments):
        for before, after, cost, audit in segment:
            ways[n].setdefault(before, []).append((after, cost, audit))

    def edits(item):
        n, last = item
        for after, cost, audit in ways[n].get(last, ()) if n < len(ways) else ():
            yield (n + 1, after), cost, audit
    done = lightest((0, ""), edits, lambda item: item[0] == len(ways) and item[1] in ("", "a"))
    return list(done.values())[-1]


def repaired(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that stay or are inserted."""
    last = ""
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(turns)
        if edit == DELETE:
            continue
        role = role if edit == KEEP else ROLES[last]
        last = role[:1]
        yield edit, role, text


def prepared(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, turn, role, text) with ``row`` and ``digest`` (of
    role and text), written once."""
    space = F.lit(" ")
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                     F.coalesce("text", space).alias("text"), F.monotonically_increasing_id().alias("row"))
    return written(t.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))),
                   "repair-turns")


def faults(turns: DataFrame) -> DataFrame:
    """Prepared turns without their texts, and their first fault: blank (no
    visible character), duplicate (role and text seen earlier), truncated (the
    last visible character ends no sentence)."""
    stripped = F.rtrim("text", F.lit(WHITE))
    slim = turns.select(*ORDER, (stripped == "").alias("blank"), (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("_open"))
    # the first row of equal turns, pre-aggregated: rows then meet by their number, never by text
    first = turns.groupBy("conv_id", "digest").agg(F.min_by("row", F.struct("turn", "row")).alias("row"))
    return (slim.join(first.select("row", F.lit(True).alias("_first")), "row", "left")
            .withColumn("duplicate", ~F.col("blank") & F.col("_first").isNull())
            .withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("_open")).drop("_open", "_first"))


_SPAN = "array<struct<before:string,after:string,cost:bigint,audit:string>>"
_SPAN_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
_FACTS = ["n", "blank", "duplicate", "truncated", "illegal", "distinct"]
_ENDS = ["least", "most"]


def _long(n: int) -> int:
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def _table(names: Sequence[str], types: Sequence[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _runs(rows: Iterator[tuple], longest: int) -> Iterator[tuple[bool, list[tuple]]]:
    """Runs of equal first values, of at most ``longest`` rows, and whether
    one may go on from rows before it."""
    run, goes_on = [], True
    for row in rows:
        if run and (run[-1][0] != row[0] or len(run) == longest):
            yield goes_on, run
            goes_on, run = run[-1][0] == row[0], []
        run.append(row)
    if run:
        yield goes_on, run


def _segment(conv_type: pa.DataType):
    """Segments of one sorted range: conv_id, turn, role, blank, duplicate, truncated."""
    names = ["conv_id", "segment", *_FACTS, *_ENDS, "first", "last", "spans"]
    types = [conv_type, *[pa.int64()] * (1 + len(_FACTS) + len(_ENDS)), pa.string(), pa.string(), _SPAN_ARROW]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out = TaskContext.get().partitionId() << 40, []
        for goes_on, run in _runs(_rows(batches), SEGMENT):
            _, turn, role, blank, duplicate, truncated = zip(*run)
            initials = [r[:1] for r in role]
            known = [t for t in turn if t is not None]
            way = list(spans(list(zip(initials, map(any, zip(blank, duplicate)), truncated)), STATES if goes_on else ("",)))
            out.append((run[0][0], number, len(run), sum(blank), sum(duplicate), sum(truncated),
                        sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])), len(set(known)),
                        min(known, default=None), max(known, default=None), initials[0], initials[-1], way))
            number += 1
            if len(out) >= 1000:
                yield _table(names, types, out)
                out = []
        yield _table(names, types, out)
    return cut


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _report(segments: list[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit of a conversation
    from its segments in order."""
    _, _, _, blank, duplicate, truncated, illegal, distinct, least, most, first, last, way = zip(*segments)
    joints = sum(x + y not in LEGAL for x, y in zip(last, first[1:]))
    low, high = [t for t in least if t is not None], [t for t in most if t is not None]
    # a turn at the end of one segment and at the start of the next counts once
    n = sum(distinct) - sum(x == y for x, y in zip(high, low[1:]))
    gaps = _long(high[-1] - low[0] + 1 - n) if low else 0
    cost, audit = lightest_path([[tuple(s.values()) for s in w] for w in way])
    return gaps, sum(blank), sum(duplicate), sum(truncated), sum(illegal) + joints, cost, audit


def _combine(conv_type: pa.DataType):
    names = ["conv_id", *_REPORT, "audit"]
    types = [conv_type, *[pa.int64()] * len(_REPORT), pa.string()]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, run in _runs(_rows(batches), 1 << 62):
            out.append((run[0][0], *_report(run)))
            if len(out) >= 1000:
                yield _table(names, types, out)
                out = []
        yield _table(names, types, out)
    return combine


def reports(turns: DataFrame) -> DataFrame:
    """Per conversation of prepared turns: conv_id, gaps (turn numbers missing
    between the least and the greatest), blank, duplicate, truncated, illegal
    (adjacent roles that don't follow each other), cost and audit (the letters
    of the cheapest edits in order)."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    conv_type = _arrow_type(turns)
    slim = faults(turns).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    segments = written(slim.select("conv_id", "turn", "role", "blank", "duplicate", "truncated").mapInArrow(
        _segment(conv_type), f"conv_id {conv}, segment long, " + ", ".join(f"{c} long" for c in [*_FACTS, *_ENDS])
        + f", first string, last string, spans {_SPAN}"), "repair-segments")
    return written(segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(
        _combine(conv_type), f"conv_id {conv}, " + ", ".join(f"{c} long" for c in _REPORT) + ", audit string"), "repair-reports")


def _arrow_type(turns: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(turns.schema["conv_id"].dataType)


_ID, _HEAD, _TURN = 0, 1, 2


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, report or None, its turns as an iterator) of a sorted stream."""
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        conv, head = row[0], None
        while row is not None and row[0] == conv and row[1] != _TURN:
            head = row[2:2 + len(_REPORT) + 1] if row[1] == _HEAD else head
            row = next(rows, None)

        def turns():
            nonlocal row
            while row is not None and row[0] == conv and row[1] == _TURN:
                yield row[-2], row[-1]
                row = next(rows, None)
        own = turns()
        yield conv, head, own
        for _ in own:
            pass


def _digests(conv_type: pa.DataType):
    names = ["conv_id", *_REPORT, "audit", "repaired_sha256"]
    types = [conv_type, *[pa.int64()] * len(_REPORT), pa.string(), pa.string()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, head, turns in _conversations(batches):
            report = head or (*[0] * len(_REPORT), "")
            hashed, line_end = sha256(), ""
            for _, role, text in repaired(report[-1], turns):
                hashed.update(f"{line_end}{role}:{text}".encode())
                line_end = "\n"
            out.append((conv, *report, hashed.hexdigest()))
            if len(out) >= 1000:
                yield _table(names, types, out)
                out = []
        yield _table(names, types, out)
    return emit


def _texts(conv_type: pa.DataType):
    names, types = ["conv_id", "position", "role", "text", "edit"], [conv_type, pa.int64(), *[pa.string()] * 3]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars = [], 0
        for conv, head, turns in _conversations(batches):
            for n, (edit, role, text) in enumerate(repaired(head[-1] if head else "", turns)):
                out.append((conv, n, role, text, edit))
                chars += len(text)
                if len(out) >= 1000 or chars > 1 << 22:
                    yield _table(names, types, out)
                    out, chars = [], 0
        yield _table(names, types, out)
    return emit


def repair(turns: DataFrame, ids: DataFrame | None = None, digest: bool = False) -> DataFrame:
    """The repaired conversations, one row a turn: conv_id, position, role,
    text and edit (K kept, R reroled, I inserted). With ``digest`` one row a
    conversation instead: the columns of ``reports`` and repaired_sha256, the
    SHA-256 of all ``role:text`` joined by line ends; conversations that only
    ``ids`` (conv_id) has are there with zeros and empty texts."""
    t = prepared(turns)
    conv, conv_type = t.schema["conv_id"].dataType, _arrow_type(t)
    found = reports(t)
    none = [F.lit(None).cast("long").alias(c) for c in _REPORT]
    text = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    order = [F.lit(None).cast(x).alias(c) for c, x in (("turn", "long"), ("digest", "string"), ("row", "long"))]
    heads = found.select("conv_id", F.lit(_HEAD).alias("kind"), *_REPORT, "audit", *order, *text)
    stream = heads.unionByName(t.select("conv_id", F.lit(_TURN).alias("kind"), *none, F.lit(None).cast("string").alias("audit"),
                                        "turn", "digest", "row", "role", "text"))
    if ids is not None:
        stream = stream.unionByName(ids.select(F.col("conv_id").cast(conv).alias("conv_id")).distinct().select(
            "conv_id", F.lit(_ID).alias("kind"), *none, F.lit("").alias("audit"), *order, *text))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:]).select(
        "conv_id", "kind", *_REPORT, "audit", "role", "text")
    name = conv.simpleString()
    if digest:
        return stream.mapInArrow(_digests(conv_type), f"conv_id {name}, " + ", ".join(f"{c} long" for c in _REPORT)
                                 + ", audit string, repaired_sha256 string")
    return stream.mapInArrow(_texts(conv_type), f"conv_id {name}, position long, role string, text string, edit string")
