"""Chat formatting by schema fingerprints, in DataFrame functions only.

A layout is a declarative mapping from nested field paths to canonical turns.
``canonical_turns`` takes the layouts whose paths a table's schema holds, hashes
the paths that are not null in each row, and looks the mapping of the row up by
that fingerprint, so one table may mix flat turns with prompt, instruction and
message layouts. ``format_turns`` renders
(conversation, turn, role, text) rows with a reversible template and a loss
mask; ``read_back`` parses the text again.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside texts a
backslash is doubled and ``<|`` becomes ``<\\|``; in roles ``%``, line ends and
``<`` are percent-coded. So no control string can come from a text or a role.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"


def fingerprint(paths) -> int:
    """Hash of a set of nested field paths."""
    return zlib.crc32("\n".join(sorted(paths)).encode())


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """All leaf paths in lower case; ``[]`` marks an array's elements."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, f"{prefix}{f.name.lower()}"
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


@dataclass(frozen=True)
class Layout:
    """``turns``: (role, path) pairs in order, ``messages``: an array path with
    its role and text fields, or ``flat``: the turn number, role and text paths
    of a table with one turn a row."""

    name: str
    turns: tuple = ()
    messages: tuple = ()
    roles: tuple = ()
    flat: tuple = ()

    @property
    def paths(self) -> tuple:
        if self.messages:
            array, role, text = self.messages
            return (f"{array}[].{role}", f"{array}[].{text}")
        return self.flat or tuple(p for _, p in self.turns)

    @property
    def key(self) -> int:
        return fingerprint(self.paths)

    def keys(self, n: int) -> list[int]:
        """Fingerprints of the sets of ``n`` of its paths."""
        return [fingerprint(x) for x in combinations(self.paths, n)]

    @property
    def whole(self) -> list[int]:
        """Fingerprints of the rows that lack nothing of this layout; a flat
        row lacks nothing if it has a text."""
        if not self.flat:
            return [self.key]
        return [fingerprint(x) for n in (3, 2, 1) for x in combinations(self.paths, n) if self.flat[2] in x]

    def filled(self, path: str) -> Column:
        """Whether a row has a value at the path, for an array in any element."""
        if self.messages:
            array, field = path.split("[].")
            return F.coalesce(F.exists(F.col(array), lambda m: m[field].isNotNull()), F.lit(False))
        return F.col(path).isNotNull()

    def row_key(self) -> Column:
        """The fingerprint of the layout's paths that are not null in a row."""
        return F.crc32(F.array_join(F.array(*[F.when(self.filled(p), F.lit(p)) for p in sorted(self.paths)]), "\n"))

    def build(self) -> Column:
        if self.flat:
            _, role, text = self.flat
            return F.array(F.struct(F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))
        if self.messages:
            array, role, text = self.messages
            named = dict(self.roles)

            def turn(m):
                r = m[role].cast("string")
                for old, new in named.items():
                    r = F.when(m[role] == old, F.lit(new)).otherwise(r)
                return F.struct(F.coalesce(r, F.lit("")).alias("role"),
                                F.coalesce(m[text].cast("string"), F.lit("")).alias("text"))
            return F.transform(F.col(array), turn)
        return F.filter(F.array(*[F.struct(F.lit(r).alias("role"), F.col(p).cast("string").alias("text"))
                                  for r, p in self.turns]), lambda t: t["text"].isNotNull())


#: Checked in this order: a layout with more paths before one that it holds.
LAYOUTS = (
    Layout("messages", messages=("messages", "role", "content")),
    Layout("from-value", messages=("conversations", "from", "value"),
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("instruction-input", turns=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction", turns=(("user", "instruction"), ("assistant", "output"))),
    Layout("prompt", turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("question", turns=(("user", "question"), ("assistant", "answer"))),
    Layout("flat", flat=("turn", "role", "text")),
)


def selected(known) -> Column:
    """The name of the layout that a row's non-null paths select, looked up by
    the fingerprint of the row: the first layout that lacks nothing, then the
    one with most of the row's paths (ties: fewest missing, then first)."""
    def named(x, when):
        return F.when(when, F.lit(x.name))

    part = sorted(((-n, len(x.paths) - n, i) for i, x in enumerate(known) for n in range(1, len(x.paths))))
    part = [(known[i], named(known[i], known[i].row_key().isin(known[i].keys(-n)))) for n, _, i in part]
    arrays = [x for x in known if x.messages]
    return F.coalesce(
        *[named(x, x.row_key().isin(x.whole)) for x in known],
        *[c for x, c in part if x.messages],
        # an empty array still names its layout where no other one is whole
        *[named(x, F.size(x.messages[0]) == 0) for x in arrays],
        *[c for x, c in part if x.turns],
        *[c for x, c in part if x.flat],
        *[named(x, F.col(x.messages[0]).isNotNull()) for x in arrays],
        F.lit(None).cast("string"))


def canonical_turns(table: DataFrame, id_col: str, layouts=LAYOUTS) -> DataFrame:
    """(id, layout, turn, role, text) rows of a table of any known layouts.

    A row takes the first layout whose paths it holds whole, else the one that
    most of its non-null paths belong to, and gives the turns that are present:
    a prompt without a response is one turn. A row takes one layout; paths of
    others beside it are not read. A row of no layout gives one row with null
    layout, turn, role and text, so no row is lost. An empty messages array in
    a row that holds no layout whole gives the same with its layout's name, also
    beside a lone prompt. Null roles and texts of messages and flat turns become
    empty; a flat turn keeps its number. Columns beyond the layouts' paths are
    not read. Fingerprints are the crc32 of the sorted paths.
    """
    have = set(schema_paths(table.schema))
    known = [x for x in layouts if set(x.paths) <= have]
    turns, number = F.lit(None).cast("array<struct<role:string,text:string>>"), F.col("_n").cast("long")
    own = F.lit(None).cast("long")
    for x in reversed(known):
        turns = F.when(F.col("_layout") == x.name, x.build()).otherwise(turns)
        if x.flat:
            own = F.when(F.col("_layout") == x.name, F.col(x.flat[0]).cast("long")).otherwise(own)
            number = F.when(F.col("layout") == x.name, F.col("_own")).otherwise(number)
    rows = table.withColumn("_layout", selected(known)).select(
        F.col(id_col).alias("_id"), F.col("_layout").alias("layout"), own.alias("_own"), turns.alias("_turns"))
    return rows.select("_id", "layout", "_own", F.posexplode_outer("_turns").alias("_n", "_t")).select(
        F.col("_id").alias(id_col), "layout", number.alias("turn"), "_t.role", "_t.text")


def escape_text(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape_text(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


_ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def escape_role(c: Column) -> Column:
    for old, new in _ROLE_CODES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def unescape_role(c: Column) -> Column:
    for old, new in reversed(_ROLE_CODES):
        c = F.replace(c, F.lit(new), F.lit(old))
    return c


def format_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """(id, formatted, loss_spans): one row per conversation, its turns in order.

    loss_spans are [start, length) code-point ranges of the (escaped) texts of
    the ``learn`` role, in order. Turns are ordered by number, then role, then
    text; a null number comes first. Null roles and texts are empty. Rows with
    a null id form one conversation with a null id. Repeated rows are turns
    each. Extra columns are not read; an empty table gives no rows. Lengths
    are added up before the turns meet, so each text moves once.
    """
    t = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     escape_text(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    t = t.withColumn("head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
    t = t.withColumn("size", F.length("head") + F.length("text") + len(END))
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    t = t.withColumn("n", F.row_number().over(order)).withColumn(
        "before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    span = F.when(F.col("role") == learn, F.struct(
        (F.col("before") + F.length("head")).cast("long").alias("start"),
        F.length("text").cast("long").alias("length")))
    piece = F.struct("n", F.concat("head", "text", F.lit(END)).alias("piece"), span.alias("span"))
    done = t.groupBy("id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return done.select(F.col("id").alias(id_col), F.array_join("p.piece", "").alias("formatted"),
                       F.filter("p.span", lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    parts = F.filter(F.split(formatted, "\\Q" + END + "\\E"), lambda p: p != "")

    def turn(p):
        head = F.instr(p, "\n") if isinstance(p, str) else F.locate("\n", p)
        return F.struct(unescape_role(F.substring(p, F.lit(len(START) + 1), head - len(START) - 1)).alias("role"),
                        unescape_text(F.substring(p, head + 1, F.length(p))).alias("text"))
    return F.transform(parts, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape_text(
        F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))))
