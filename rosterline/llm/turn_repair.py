"""Repair of conversations by weighted interval parsing.

The turns of a conversation, each as its role's initial, are to read ``(s?(ua)+)?``. An edit keeps a
turn, gives it another role, deletes it or inserts an empty turn; the cheapest edits win, and of
equally cheap ones those whose initials (``audit``) come first as text.

The grammar is in Chomsky normal form. Its nonterminals are pairs (p, q) of states of the pattern:
what turns a conversation in state p into one in state q. A pair is a role, or a pair (p, r)
followed by a pair (r, q). A cell is a span of turns and holds the smallest (cost, audit) of every
pair; cells of single turns are closed under insertion on both sides, and cells are combined
bottom-up by span length, two neighbours of the same length at a time. That is enough: the pattern
is regular, so a pair's edits may be cut at any turn, and every split of a span gives the same cell.
The order on (cost, audit) survives combination, as two audits of one span with equal costs are
never one the beginning of the other.

Conversations of up to ``LONG`` rows are read by one task each. Longer ones are cut into stretches
by ranges of turns: cells of stretches are made where these are, a conversation's few cells are
combined, and every stretch is repaired with its own part of the audit.

Defined cases: a null role or text is one blank; null turns come first; rows of one turn are in the
order of role, then of their text's hash; of equal rows one is the first; null conversations are
one conversation; a conversation of which no row is there (``present``) has zeros and an empty
audit; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rosterline.llm.common import Stored

#: Rows of a conversation that one task reads at once; longer ones are cut into stretches.
LONG = 20_000

#: Costs of edits, and of a turn that breaks off and stays.
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 3, 4, 3, 3

#: States: nothing yet, after a system turn, after a user's, after an assistant's turn.
STATES = range(4)
ACCEPTED = (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ROLES = {"u": "user", "a": "assistant"}

#: What a turn can do: its role's initial, whether it has to go, whether it breaks off.
Kind = tuple[str, bool, bool]
Cell = dict[tuple[int, int], tuple[int, str]]


def combined(one: Cell, other: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in one.items():
        for q in STATES:
            if (r, q) in other:
                more, rest = other[r, q]
                made = (cost + more, audit + rest)
                if (p, q) not in out or made < out[p, q]:
                    out[p, q] = made
    return out


def _insertions() -> Cell:
    """No turn, closed under insertion."""
    once: Cell = {(p, p): (0, "") for p in STATES}
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            once[p, q] = (INSERT, "I")
    return combined(once, combined(once, once))


NOTHING = _insertions()


@lru_cache(maxsize=None)
def leaf(kind: Kind) -> Cell:
    """The cell of one turn."""
    initial, must_go, broken = kind
    edits: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if not must_go:
        stays = BROKEN if broken else 0
        for p, (role, edit, cost) in product(
            STATES, [(initial, "K", KEEP), ("u", "R", REROLE), ("a", "R", REROLE)]
        ):
            if (p, role) in STEPS:
                to = (p, STEPS[p, role])
                edits[to] = min(edits.get(to, (1 << 62, "")), (cost + stays, edit))
    return combined(NOTHING, combined(edits, NOTHING))


def cell_of(kinds: tuple[Kind, ...]) -> Cell:
    """The cell of a whole span: lengths 1, 2, 4 and so on."""
    level = [leaf(kind) for kind in kinds] or [NOTHING]
    while len(level) > 1:
        pairs = [combined(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


@lru_cache(maxsize=20_000)
def _short(kinds: tuple[Kind, ...]) -> tuple[int, str]:
    return cheapest(cell_of(kinds))


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in ACCEPTED if (0, q) in cell)


def repaired(turns: list[tuple[str, str]], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """The (role, text) that the edits of ``audit`` make, from ``state`` on."""
    out, given = [], iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(given)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if state == 2 else "u"]
        out.append((role, text))
        state = STEPS[state, role[:1]]
    return out


class Counts:
    """What is counted in a stretch of a conversation, and what its neighbours have to know."""

    NAMES = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self):
        self.found = dict.fromkeys(self.NAMES, 0)
        self.first = self.last = None
        self.least = self.most = None
        self.turns = 0

    def add(self, role: str, turn: int | None, fault: str | None) -> None:
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.found["illegal"] += 1
        self.last = initial
        if fault:
            self.found[fault] += 1
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def then(self, other: Counts) -> None:
        """Go on with the stretch that follows."""
        if other.first is None:
            return
        for name, n in other.found.items():
            self.found[name] += n
        if self.first is None:
            self.first = other.first
        elif self.last + other.first not in ("su", "ua", "au"):
            self.found["illegal"] += 1
        self.last = other.last
        if other.most is not None:
            self.turns += other.turns - (self.most == other.least)
            self.least = other.least if self.least is None else self.least
            self.most = other.most

    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns


def _flagged(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column
) -> Stored:
    """``conv``, ``turn``, ``role``, ``text``, ``there``, ``digest``, ``tie`` (a number that no
    other row has) and ``fault`` of every row."""
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        present.alias("there"),
    )
    rows = rows.where("there").unionByName(
        rows.where(~F.col("there"))
        .select("conv")
        .distinct()
        .selectExpr("conv", "null turn", "'' role", "'' text", "false there")
    )
    said = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    noted = Stored(
        rows.select(
            "*",
            F.md5(F.col("text").cast("binary")).alias("digest"),
            F.monotonically_increasing_id().alias("tie"),
            F.when(said == "", "blank")
            .when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "truncated")
            .alias("flaw"),
        ),
        "turns",
    )
    # Counted before the shuffle, so that copies of one turn do not gather anywhere.
    first = Stored(
        noted.df.where(F.col("there") & ~F.col("flaw").eqNullSafe("blank"))
        .groupBy(F.col("conv").alias("of"), F.col("role").alias("by"), F.col("digest").alias("is"))
        .agg(F.min(F.struct("turn", "tie")).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("of", "by", "is", F.col("first.tie").alias("first")),
        "repeated",
    )
    joined = noted.df.join(
        first.side(),
        F.col("conv").eqNullSafe(F.col("of"))
        & (F.col("role") == F.col("by"))
        & (F.col("digest") == F.col("is")),
        "left",
    )
    again = (F.col("tie") != F.col("first")) & ~F.col("flaw").eqNullSafe("blank")
    found = Stored(
        joined.select(
            *[c for c in noted.df.columns if c != "flaw"],
            F.when(again, "duplicate").otherwise(F.col("flaw")).alias("fault"),
        ),
        "faults",
    )
    noted.drop()
    first.drop()
    return found


ORDER = ("turn", "role", "digest", "tie")


def _runs(
    batches: Iterator[pa.RecordBatch], key: tuple[str, ...]
) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each key; equal keys follow each other."""
    held, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            for row in batch.slice(at, 1000).to_pylist():
                mine = tuple(row[c] for c in key)
                if rows and mine != held:
                    yield held, rows
                    rows = []
                held = mine
                rows.append(row)
    if rows:
        yield held, rows


def _by_run(
    rows: DataFrame,
    key: tuple[str, ...],
    schema: T.StructType,
    work: Callable[[list[dict]], list[dict]],
) -> DataFrame:
    """``work`` on the rows of each key in their order; its results, as rows of ``schema``."""
    kinds = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = to_arrow_schema(schema)
        made, size = [], 0
        for _, held in _runs(batches, key):
            made += work(held)
            size += len(held)
            if size >= 1000:
                yield pa.RecordBatch.from_pylist(made, to)
                made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, to)

    order = [c for c in (*key, *ORDER) if c in kinds.names]
    return rows.repartition(*key).sortWithinPartitions(*order).mapInArrow(run, schema)


def _initial(role: str) -> str:
    """The role's initial, if the pattern has it."""
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def _kinds_and_counts(rows: list[dict]) -> tuple[list[dict], tuple[Kind, ...], Counts]:
    there = [row for row in rows if row["there"]]
    counts = Counts()
    for row in there:
        counts.add(row["role"], row["turn"], row["fault"])
    kinds = tuple(
        (_initial(row["role"]), row["fault"] in ("blank", "duplicate"), row["fault"] == "truncated")
        for row in there
    )
    return there, kinds, counts


def _said(turns: list[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in turns]


def _whole(rows: list[dict]) -> list[dict]:
    """A conversation that is read at once."""
    there, kinds, counts = _kinds_and_counts(rows)
    cost, audit = _short(kinds) if len(kinds) <= 12 else cheapest(cell_of(kinds))
    left = repaired([(row["role"], row["text"]) for row in there], audit)
    return [
        {
            **{"conv": rows[0]["conv"], "part": 0, "parts": 1, "gaps": counts.gaps()},
            **{**counts.found, "cost": cost, "audit": audit, "turns": _said(left)},
        }
    ]


def _stretch(rows: list[dict]) -> list[dict]:
    """The cell and the counts of a stretch."""
    _, kinds, counts = _kinds_and_counts(rows)
    cell = cell_of(kinds)
    return [
        {
            **{"conv": rows[0]["conv"], "part": rows[0]["part"], **counts.found},
            **{"first": counts.first, "last": counts.last, "n_turns": counts.turns},
            **{"least": counts.least, "most": counts.most},
            "cell": [
                {"p": p, "q": q, "cost": cost, "audit": audit}
                for (p, q), (cost, audit) in cell.items()
            ],
        }
    ]


def _folded(rows: list[dict]) -> list[dict]:
    """The edits of all stretches of a conversation, the counts with the first."""
    whole = Counts()
    paths: dict[int, tuple[int, str, list]] = {0: (0, "", [])}
    for row in rows:
        counts = Counts()
        counts.found = {name: row[name] for name in Counts.NAMES}
        counts.first, counts.last = row["first"], row["last"]
        counts.least, counts.most, counts.turns = row["least"], row["most"], row["n_turns"]
        whole.then(counts)
        new: dict[int, tuple[int, str, list]] = {}
        for x in row["cell"]:
            if x["p"] in paths:
                cost, audit, way = paths[x["p"]]
                made = (cost + x["cost"], audit + x["audit"])
                if x["q"] not in new or made < new[x["q"]][:2]:
                    new[x["q"]] = (*made, [*way, (x["p"], x["audit"])])
        paths = new
    cost, audit, way = min(paths[q] for q in ACCEPTED if q in paths)
    head = {"gaps": whole.gaps(), **whole.found, "cost": cost, "audit": audit}
    made = [
        {"part": row["part"], "parts": len(rows), "state": state, "edits": edits}
        for row, (state, edits) in zip(rows, way, strict=True)
    ]
    made[0] |= head
    return [{"conv": row["conv"], **x} for row, x in zip(rows, made, strict=True)]


def _applied(rows: list[dict]) -> list[dict]:
    """The turns of a stretch after its edits."""
    there = [(row["role"], row["text"]) for row in rows if row["there"]]
    left = repaired(there, rows[0]["edits"], rows[0]["state"])
    names = ("conv", "part", "parts", "gaps", *Counts.NAMES, "cost", "audit")
    return [{**{name: rows[0][name] for name in names}, "turns": _said(left)}]


def _schema(conv: T.DataType, fields: str) -> T.StructType:
    rest = T.StructType.fromDDL(fields)
    return T.StructType([T.StructField("conv", conv), *rest.fields])


_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_HEAD = f"gaps bigint, {_COUNTS}, cost bigint, audit string"


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    long: int = LONG,
) -> DataFrame:
    """``conv_col``, ``gaps`` and the other counts, ``cost``, ``audit`` and ``turns`` (role, text)
    of every conversation, in one row (``part`` 0 of ``parts`` 1).

    A conversation of more than ``long`` rows has a row for each stretch (``part`` in order, not
    from 0), with its turns; only the first of them has the counts, cost and audit. Rows that are
    not ``present`` count as left out, but their conversation is in the result.
    """
    present = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = _flagged(turns, conv_col, turn_col, role_col, text_col, present).df
    kind = rows.schema["conv"].dataType
    crowded = Stored(
        rows.groupBy(F.col("conv").alias("of")).agg(F.count("*").alias("n")).where(F.col("n") > long),
        "long",
    )
    made = _schema(
        kind, f"part int, parts int, {_HEAD}, turns array<struct<role string, text string>>"
    )
    n = crowded.df.agg(F.sum("n")).first()[0] or 0
    if not n:
        return _by_run(rows, ("conv",), made, _whole).withColumnRenamed("conv", conv_col)
    same = F.col("conv").eqNullSafe(F.col("of"))
    short = rows.join(crowded.side().select("of"), same, "left_anti")
    ranged = rows.join(crowded.side().select("of"), same, "left_semi").repartitionByRange(
        max(2, -(-n // long)), "conv", *ORDER
    )
    placed = Stored(ranged.withColumn("part", F.spark_partition_id()), "stretches").df
    cells = _by_run(
        placed,
        ("conv", "part"),
        _schema(
            kind,
            f"part int, {_COUNTS}, first string, last string, least bigint, most bigint, "
            "n_turns bigint, cell array<struct<p int, q int, cost bigint, audit string>>",
        ),
        _stretch,
    )
    # A conversation's rows are few here: one for each stretch.
    cells = cells.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct(*[c for c in cells.columns[1:]]))).alias("stretches")
    )
    edits = Stored(
        _by_run(
            cells,
            ("conv",),
            _schema(kind, f"part int, parts int, state int, edits string, {_HEAD}"),
            lambda held: _folded([{"conv": held[0]["conv"], **x} for x in held[0]["stretches"]]),
        ),
        "edits",
    ).df.withColumnsRenamed({"conv": "of", "part": "of_part"})
    long_ones = _by_run(
        placed.join(edits, same & (F.col("part") == F.col("of_part"))).drop("of", "of_part"),
        ("conv", "part"),
        made,
        _applied,
    )
    return (
        _by_run(short, ("conv",), made, _whole)
        .unionByName(long_ones)
        .withColumnRenamed("conv", conv_col)
    )


def said(turns: Column) -> Column:
    """``role:text`` of repaired turns, a line each."""
    lines = F.transform(turns, lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    return F.array_join(lines, "\n")


def digests(repaired_turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``conv_col`` and ``repaired_sha256`` of the conversations in several parts: the hash of all
    their turns, taken part by part, so that no more than a part is held."""
    kind = repaired_turns.schema[conv_col].dataType
    schema = _schema(kind, "repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, held, some, going = to_arrow_schema(schema), None, False, None
        for batch in batches:
            for i in range(batch.num_rows):
                conv, lines, empty = (batch.column(j)[i].as_py() for j in (0, 2, 3))
                if going is None or conv != held:
                    if going:
                        yield pa.RecordBatch.from_pylist(
                            [{"conv": held, "repaired_sha256": going.hexdigest()}], to
                        )
                    held, some, going = conv, False, sha256()
                if not empty:
                    going.update((b"\n" if some else b"") + lines.encode())
                    some = True
        if going:
            yield pa.RecordBatch.from_pylist(
                [{"conv": held, "repaired_sha256": going.hexdigest()}], to
            )

    lines = repaired_turns.where(F.col("parts") > 1).select(
        F.col(conv_col).alias("conv"),
        "part",
        said(F.col("turns")).alias("lines"),
        (F.size("turns") == 0).alias("empty"),
    )
    found = lines.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(run, schema)
    return found.withColumnRenamed("conv", conv_col)
